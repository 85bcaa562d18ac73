"""Time headline queries on a replicated documents table.

    python tools/scale_bench.py [records] [sf_dir] [query ...]

Every document is written ``records / rows`` times with ids that follow on (the
text whole, in row groups of 16 MB so that all cores read), then each query is
built and run once into the ``noop`` sink. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from vulnsift.queries import queries  # noqa: E402
from vulnsift.session import local_session  # noqa: E402

HEADLINE = ("merge_dedup", "ingest_counts", "stratified_sample", "training_final", "filter_summary", "score_summary", "callout_facts")


def main() -> None:
    records = int(sys.argv[1]) if len(sys.argv) > 1 else 1_000_000
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    names = sys.argv[3:] or HEADLINE
    spark = local_session(shuffle_partitions=64, app="vulnsift-scale")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = docs.count()
    root = tempfile.mkdtemp(prefix="run-scale-")
    copies = docs.repartition(64).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(records // n - 1))))
    grown = copies.withColumn("doc_id", F.col("doc_id") + F.col("copy") * n).drop("copy")
    grown.write.option("parquet.block.size", 16 << 20).parquet(f"{root}/documents.parquet")
    rows, chars = spark.read.parquet(f"{root}/documents.parquet").agg(F.count("*"), F.sum(F.length("text"))).first()
    seconds = {}
    for name in names:
        t0 = time.perf_counter()
        queries()[name](spark, root).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - t0, 2)
    print(json.dumps({"records": rows, "text_chars": chars, "seconds": seconds, "records_per_sec": {k: round(rows / v) for k, v in seconds.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()
