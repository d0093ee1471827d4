"""Prefixes and JSON arrays without a task that grows with the input."""

import json
import random

import pytest
from pyspark.sql import functions as F

from notegrove.sources import json_arrays, readers
from notegrove.sources.json_arrays import array_records, array_to_rows
from notegrove.sources.readers import first_rows


@pytest.mark.parametrize("n", [0, 1, 250, 1000, 5000])
def test_prefix(spark, n):
    rows = spark.range(1000).select(((F.col("id") * 37) % 1000 - 500).alias("id"), F.lit("x").alias("t")).repartition(7)
    got = sorted(r.id for r in first_rows(rows, n).collect())
    assert got == list(range(-500, 500))[: n or None]


def test_prefix_of_odd_values(spark, monkeypatch):
    monkeypatch.setattr(readers, "RANGES", 1000)
    values = [None, None, 2**63 - 1, -(2**63), 5, 5, 5, 5, 6, 0, 2**40]
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "id long, i int")
    there = sorted(v for v in values if v is not None)
    for n in (1, 4, 9, 11):
        got = first_rows(rows, n).collect()
        assert len(got) == len({r.i for r in got}) == n
        assert sorted(r.id for r in got if r.id is not None) == there[:n]
    equal = spark.createDataFrame([(3, "a")] * 50, "id long, t string")
    assert first_rows(equal, 20).count() == 20
    assert first_rows(equal.limit(0), 3).count() == 0


def test_prefix_is_a_pushed_filter(spark, plan, tmp_path):
    spark.range(5000).select("id", F.lit("t").alias("t")).write.parquet(str(tmp_path / "p"))
    text = plan(first_rows(spark.read.parquet(str(tmp_path / "p")), 1000))
    assert "LessThan(id,999)" in text and "TakeOrdered" not in text and "Sort" not in text


TRICKY = ['}', '{', '"', "\\", '"}', '\\"}{', "[]", "}]", "a\nb", "\u2028", "é\U0001f600", "", "x" * 3000, '{"a": [1, {"b": "}"}]}']


def records(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        nested = {"deep": [{"t": rnd.choice(TRICKY)}, [], [[{"u": rnd.choice(TRICKY)}]]]}
        out.append({"key": i, "t": "".join(rnd.choices(TRICKY[:-2], k=rnd.randrange(4))), "nested": nested if rnd.random() < 0.5 else {}})
    out[n // 2]["t"] = "}" * 500 + "y" * 9000  # longer than several ranges
    return out


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_is_many_tasks(spark, tmp_path, small_ranges, indent):
    """Records, borders and ids as a parser of the whole file finds them."""
    made = {name: records(25, name) for name in ("b", "a", "c")}
    for name, rows in made.items():
        (tmp_path / f"{name}.json").write_text(" \n" + json.dumps(rows, indent=indent, ensure_ascii=name == "a"))
    (tmp_path / "0.json").write_text("[]")
    path = str(tmp_path)
    assert json_arrays.fragments(spark, path).select("file", "start").distinct().count() > 12
    got = [json.loads(r.text) for r in array_records(spark, path).orderBy("id").collect()]
    assert got == made["a"] + made["b"] + made["c"]
    rows = array_to_rows(spark, path, "key long, t string").orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, 76))
    assert [(r.key, r.t) for r in rows] == [(r["key"], r["t"]) for r in got]
    assert {f.name for f in array_to_rows(spark, path).schema} == {"id", "key", "t", "nested"}


@pytest.mark.parametrize("keep", [True, False])
def test_null_fields_are_kept_or_left_out(spark, tmp_path, keep):
    rows = spark.createDataFrame([(1, None, 2.5), (2, "a", None), (3, None, None)], "id long, title string, price double")
    readers.write_lines(rows, str(tmp_path / "lines"), keep_nulls=keep)
    lines = readers.read_lines(spark, str(tmp_path / "lines" / "*.gz"))
    got = {v["id"]: v for v in (json.loads(r.line) for r in lines.collect())}
    whole = {r.id: r.asDict() for r in rows.collect()}
    assert got == {i: {k: x for k, x in v.items() if keep or x is not None} for i, v in whole.items()}
    read = lines.select(F.from_json("line", rows.schema).alias("r")).select("r.*")
    assert sorted(map(tuple, read.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
