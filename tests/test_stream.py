import json

from pyspark.sql import functions as F

from notegrove.operators.clean import good_rows, parse
from notegrove.streaming.file_drop import compact, current, ingest_files


def drop(path, name, records):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def run(spark, tmp_path):
    query = ingest_files(
        spark,
        str(tmp_path / "in"),
        str(tmp_path / "log"),
        str(tmp_path / "cp"),
        lambda lines: lines.select(F.from_json("value", "id long, v long, t string").alias("r")).select("r.*"),
    )
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "log"))


def test_files_become_upserts(spark, tmp_path):
    for i in range(7):
        drop(tmp_path / "in", f"f{i}.json", [{"id": 1, "v": i, "t": f"t{i}"}, {"id": 10 + i, "v": 0, "t": "x"}])
    log = run(spark, tmp_path)
    sizes = {r.batch_id: r["count"] for r in log.groupBy("batch_id").count().collect()}
    assert sizes == {0: 10, 1: 4}
    state = current(log, "id", ["v"])
    assert state.count() == 8 and state.where("id = 1").first().t == "t6"

    # A second run takes only what is new.
    drop(tmp_path / "in", "late.json", [{"id": 1, "v": 99, "t": "late"}])
    log = run(spark, tmp_path)
    assert log.count() == 15
    assert current(log, "id", ["v"]).where("id = 1").first().t == "late"
    folded = compact(spark, str(tmp_path / "log"), str(tmp_path / "base"), "id", ["v"])
    assert folded.count() == 8


def test_cleaning_runs_on_the_stream(spark, tmp_path):
    record = dict.fromkeys(
        "id points title description price designation variety winery country province region_1 "
        "region_2 taster_name taster_twitter_handle".split()
    )
    drop(tmp_path / "in", "a.json", [{**record, "id": 1, "points": "90", "title": "t"}, {"id": 2}])

    def clean(lines):
        named = lines.select(F.col("value").alias("line"), F.lit("in").alias("input_file"))
        return good_rows(parse(named)).drop("_extra")

    ingest_files(
        spark, str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "cp"), clean
    ).awaitTermination()
    assert [r.id for r in spark.read.parquet(str(tmp_path / "log")).collect()] == [1]
