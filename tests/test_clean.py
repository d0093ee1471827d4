import json

import pytest
from pyspark.sql import functions as F

from notegrove.operators.clean import KEYWORD, VECTOR, VECTOR_PLACE, good_rows, parse, quarantine, to_integer, to_number
from notegrove.schema import REVIEW
from notegrove.sources.readers import read_lines

BASE = {
    "id": 1,
    "points": "90",
    "title": "A title",
    "description": "Some text",
    "price": 30,
    "designation": "Reserve",
    "variety": "Red Blend",
    "winery": "W",
    "country": "Xland",
    "province": "P",
    "region_1": None,
    "region_2": None,
    "taster_name": None,
    "taster_twitter_handle": None,
}


def lines(spark, *records):
    rows = [(r if isinstance(r, str) else json.dumps(r), "f") for r in records]
    return spark.createDataFrame(rows, "line string, input_file string")


def with_(**changes):
    return {**BASE, **changes}


def without(*keys, **changes):
    return {k: v for k, v in {**BASE, **changes}.items() if k not in keys}


def clean(spark, profile, *records):
    return good_rows(parse(lines(spark, *records), profile)).orderBy("id").collect()


def test_types_and_schema(spark):
    df = good_rows(parse(lines(spark, BASE)))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in REVIEW]
    row = df.first()
    assert (row.id, row.points, row.price) == (1, 90, 30.0)


@pytest.mark.parametrize("value, kept", [("90", 90), (90, 90), ("90.0", 90), (" 90 ", 90)])
def test_points_are_read_leniently(spark, value, kept):
    assert clean(spark, KEYWORD, with_(points=value))[0].points == kept


def test_rename_accepts_both_names(spark):
    rows = clean(spark, KEYWORD, BASE, without("designation", id=2, vineyard="Reserve"))
    assert [r.vineyard for r in rows] == ["Reserve", "Reserve"]
    assert rows[0]["_extra"] == {}


def test_incoming_name_wins_even_when_null(spark):
    assert clean(spark, KEYWORD, with_(designation=None, vineyard="V"))[0].vineyard is None


@pytest.mark.parametrize(
    "profile, expected",
    [(KEYWORD, ["Unknown", "Unknown", "", "Unknown"]), (VECTOR, ["Unknown", "null", "Unknown", "Unknown"])],
)
def test_country_fill_differs_by_profile(spark, profile, expected):
    records = [with_(id=i, country=c) for i, c in enumerate([None, "null", ""])]
    rows = clean(spark, profile, *records, without("country", id=9))
    assert [r.country for r in rows] == expected


def test_fill_looks_at_unstripped_value(spark):
    assert clean(spark, KEYWORD, with_(country=" null "))[0].country == "null"


def test_all_whitespace_is_stripped(spark):
    row = clean(spark, KEYWORD, with_(province="  A  B\t\n"))[0]
    assert row.province == "A  B"


def test_embedding_text(spark):
    rows = clean(
        spark,
        VECTOR_PLACE,
        with_(id=1, country=None),
        without("country", id=2),
        with_(id=3, variety="", description=None, title=" T "),
    )
    assert rows[0].to_vectorize == "Red Blend P A title Some text"
    assert rows[1].to_vectorize == "Red Blend Unknown P A title Some text"
    assert rows[2].to_vectorize == "Xland P  T"
    assert clean(spark, VECTOR, BASE)[0].to_vectorize == "Red Blend A title Some text"
    assert clean(spark, KEYWORD, BASE)[0].to_vectorize is None


def test_extra_fields_are_kept(spark):
    assert clean(spark, KEYWORD, with_(lot=7, note="n"))[0]["_extra"] == {"lot": "7", "note": "n"}


def test_bad_rows_are_set_aside_and_others_load(spark):
    parsed = parse(
        lines(
            spark,
            BASE,
            with_(points="7.5"),
            with_(points="x"),
            without("designation"),
            "not json",
            with_(title=None),
            without("id"),
            with_(price="cheap"),
            with_(points=3_000_000_000),
        )
    )
    assert good_rows(parsed).count() == 1
    reasons = sorted(r.reason for r in quarantine(parsed).collect())
    assert reasons == sorted(
        ["type:points"] * 3
        + ["missing:vineyard", "not_json", "null:title", "missing:id", "type:price"]
    )


def test_text_fields_hold_text_only(spark):
    parsed = parse(
        lines(spark, with_(title=5), with_(winery=True), with_(designation={"a": 1}), with_(lot=[1]))
    )
    reasons = [r.reason for r in quarantine(parsed).collect()]
    assert reasons == ["type:title", "type:winery", "type:vineyard"]
    assert good_rows(parsed).first()["_extra"] == {"lot": "[1]"}


def test_repeated_key_keeps_its_last_value(spark):
    line = json.dumps(BASE)[:-1] + ', "points": "95", "title": "Later"}'
    row = clean(spark, KEYWORD, line)[0]
    assert (row.points, row.title, row.winery) == (95, "Later", "W")


def test_gzip_glob(spark, tmp_path):
    import gzip

    for n in range(3):
        with gzip.open(tmp_path / f"part{n}.jsonl.gz", "wt") as f:
            f.write(json.dumps(with_(id=n)) + "\n\n")
    read = read_lines(spark, f"{tmp_path}/*.jsonl.gz")
    assert read.select("input_file").distinct().count() == 3
    assert sorted(r.id for r in good_rows(parse(read)).collect()) == [0, 1, 2]


def test_lines_are_parsed_once(spark, plan):
    text = plan(good_rows(parse(lines(spark, BASE))))
    assert text.count("from_json") == 2  # once for the texts, once for their types


@pytest.mark.parametrize("flaw", ['{whole}{{"id": 1}}', "{whole} and more", "{whole}] and [more", "[{whole}", "{whole},{whole}", "{single}", ""])
def test_a_line_is_one_value(spark, flaw):
    whole = json.dumps(BASE)
    bad = lines(spark, BASE).select(F.lit(flaw.format(whole=whole, single=whole.replace('"', "'"))).alias("line"), "input_file")
    assert [r.reason for r in parse(bad).collect()] == ["not_json"]


def test_types_of_repeated_keys(spark):
    whole = json.dumps(BASE)
    again = whole[:-1] + ', "title": "again", "country": 5}'
    kept = whole[:-1] + ', "title": 5, "title": "again"}'
    rows = lines(spark, BASE).select(F.explode(F.array(F.lit(again), F.lit(kept))).alias("line"), "input_file")
    assert [r.reason for r in parse(rows).collect()] == ["type:country", None]


@pytest.mark.parametrize("spelling", ["90d", "90f", "1e2", "0x10", "Infinity", "NaN", "9 0", "", "+", "."])
def test_no_odd_numbers(spark, spelling):
    row = spark.range(1).select(to_integer(F.lit(spelling)).alias("i"), to_number(F.lit(spelling)).alias("x")).first()
    assert row.i is None and row.x == (100.0 if spelling == "1e2" else None)
