import json

from pyspark.sql import functions as F

from notegrove.sources.json_arrays import array_to_rows
from notegrove.sources.readers import first_rows, replay
from notegrove.sources.tables import (
    latest,
    load_report,
    open_alias,
    part_of,
    publish,
    replace_table,
    row_index,
    unique_violations,
    upsert,
    upsert_parts,
    upsert_table,
    write_parts,
)
from notegrove.workspace import shared_folder


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, price double, title string, v int")


def test_replace_and_merge_differ_on_null(spark):
    old = table(spark, (1, 5.0, "a", 0), (2, 6.0, "b", 0))
    new = table(spark, (1, None, "c", 1), (3, 7.0, None, 1))
    replaced = {r.id: (r.price, r.title) for r in upsert(old, new, "id").collect()}
    merged = {r.id: (r.price, r.title) for r in upsert(old, new, "id", mode="merge").collect()}
    assert replaced == {1: (None, "c"), 2: (6.0, "b"), 3: (7.0, None)}
    assert merged == {1: (5.0, "c"), 2: (6.0, "b"), 3: (7.0, None)}


def test_newest_of_a_delta_wins(spark):
    old = table(spark, (1, 1.0, "old", 99))
    new = table(spark, (1, 2.0, "x", 1), (1, 3.0, "y", 2))
    assert upsert(old, new, "id", ["v"]).first().price == 3.0


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(table(spark, (1, 5.0, "a", 0), (2, 6.0, "b", 0)), path)
    delta = table(spark, (2, None, "c", 1), (3, 7.0, "d", 1))
    once = upsert_table(spark, "idem", path, delta, "id")
    twice = upsert_table(spark, "idem", once, delta, "id")
    a, b = spark.read.parquet(once), spark.table("idem")
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert twice != once and spark.read.parquet(path).count() == 2


def test_hot_key_combines_before_the_shuffle(spark, plan):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"), F.col("id").alias("v")
    )
    newest = latest(rows, "id", ["v"])
    assert newest.where("id = 0").first().v == 2997
    text = plan(newest)
    assert "partial_max_by" in text and "Window" not in text


def test_violations(spark):
    df = table(spark, (1, 1.0, "a", 0), (1, 1.0, "a", 0), (2, 1.0, "a", 0))
    assert [(r.id, r["count"]) for r in unique_violations(df, "id").collect()] == [(1, 2)]
    assert unique_violations(df.dropDuplicates(["id"]), "id").count() == 0


def test_row_index_is_dense(spark):
    df = spark.range(0, 5000, 7).repartition(5).withColumnRenamed("id", "k")
    rows = row_index(df, "k").orderBy("k").collect()
    assert [r.row_no for r in rows] == list(range(len(rows)))


def test_load_report(spark):
    df = spark.range(10).selectExpr("id * 10 as id", "id = 4 as bad")
    got = [tuple(r) for r in load_report(df, "id", 4, F.col("bad")).orderBy("batch_id").collect()]
    assert got == [(0, 0, 30, 4, 0), (1, 40, 70, 4, 1), (2, 80, 90, 2, 0)]


def test_array_files_get_dense_ids_in_file_order(spark, tmp_path):
    sizes = [3, 40, 1, 0, 17]
    n = 0
    for i, size in enumerate(sizes):
        records = [{"title": f"t{n + j}", "points": n + j} for j in range(size)]
        (tmp_path / f"f{i}.json").write_text(json.dumps(records, indent=1))
        n += size
    rows = array_to_rows(spark, str(tmp_path)).orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, n + 1))
    assert [r.points for r in rows] == list(range(n))


def test_replay_and_prefix(spark):
    assert replay(spark.range(4), 3).groupBy("replay").count().count() == 3
    assert [r.id for r in first_rows(spark.range(9), 2).collect()] == [0, 1]
    assert first_rows(spark.range(9), 0).count() == 9


def test_ties_do_not_hang_on_row_order(spark):
    old = table(spark, (1, 1.0, "a", 0))
    rows = [(1, 3.0, "b", 1), (1, 2.0, "d", 1), (1, None, "c", 1)]
    for mode in ("replace", "merge"):
        results = {
            tuple(upsert(old, table(spark, *order).coalesce(1), "id", ["v"], mode).first())
            for order in (rows, rows[::-1], [rows[1], rows[0], rows[2]])
        }
        assert results == {(1, 3.0, "b", 1)}


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "keyed")
    rows = spark.range(400).selectExpr("id", "cast(id as double) price", "'x' title", "0 v")
    write_parts(rows, path, "id", 8)

    def files():
        return {f.parent.name: f.stat().st_mtime_ns for f in (tmp_path / "keyed").rglob("*.parquet")}

    before = files()
    part = rows.where("id = 17").select(part_of("id", 8)).first()[0]
    changed = table(spark, (17, -1.0, "new", 1))
    assert upsert_parts(spark, path, changed, "id", 8) == [part]
    after = files()
    assert {k for k in before if before[k] != after[k]} == {f"part={part}"}
    now = spark.read.parquet(path)
    assert now.count() == 400 and now.where("id = 17").first().price == -1.0
    assert upsert_parts(spark, path, changed.limit(0), "id", 8) == []


def test_alias_is_kept_beside_the_tables(spark, tmp_path):
    base = str(tmp_path)
    for n in (1, 2):
        replace_table(table(spark, (n, 1.0, "a", 0)), f"{base}/{n}")
        publish(spark, "stock", f"{base}/{n}", base)
    assert open_alias(spark.newSession(), "stock", base).first().id == 2


def test_reports_leave_only_their_result(spark):
    from pathlib import Path

    root = Path(shared_folder(spark).removeprefix("file:"))
    before = {p.name for p in root.iterdir()}
    report = load_report(spark.range(100), "id", 30)
    left = {p.name for p in root.iterdir()} - before
    assert report.count() == 4 and len(left) == 1 and left.pop().startswith("load-report")
