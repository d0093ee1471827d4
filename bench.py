"""Times the catalog's queries and prints one JSON line.

Folder: ``$BENCH_SF_DIR``; cores: ``$BENCH_CPUS``. Every query runs to the end (all rows,
all columns) after one untimed warm-up of the session. The indexes are built first and
timed as queries of their own; the embedding rate is reported per core.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from notegrove.operators.embed import HashedEmbedder, embed  # noqa: E402
from notegrove.plans import catalog  # noqa: E402
from notegrove.workspace import spread  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(run) -> float:
        start = time.perf_counter()
        run()
        return round(time.perf_counter() - start, 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    warm = spark.read.parquet(f"{folder}/documents.parquet")
    drain(spread(warm).mapInArrow(lambda batches: batches, warm.schema))
    drain(warm.groupBy("lang").count())

    times: dict[str, float] = {}
    for name, build in (
        ("build_text_index", catalog.text_index),
        ("build_ann_index", catalog.ann_index),
        ("build_doc_vectors", catalog.doc_vectors),
        ("build_doc_ann_index", catalog.doc_ann_index),
        ("build_word_index", catalog.word_index),
        ("build_doc_store", lambda s, f: catalog.store_of(s, f, "docs")),
        ("build_people_store", lambda s, f: catalog.store_of(s, f, "people")),
        ("build_people_graph", catalog.people_graph),
        ("build_doc_graph", catalog.docs_graph),
        ("build_supply_graph", catalog.supply_graph),
    ):
        times[name] = timed(lambda build=build: build(spark, folder))
    for name, run in catalog.QUERIES.items():
        if not only or name in only:
            times[name] = timed(lambda run=run: drain(run(spark, folder)))

    texts = spread(warm.select("doc_id", "text"))
    n = warm.count()
    seconds = timed(lambda: drain(embed(texts, "text", HashedEmbedder())))
    print(
        json.dumps(
            {
                "metric": "total wall time of all index builds and queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
                "embed_records_per_sec": round(n / seconds, 1),
                "embed_records_per_sec_per_core": round(n / seconds / int(cpus), 1),
            }
        )
    )


if __name__ == "__main__":
    main()
