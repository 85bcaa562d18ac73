"""Time the stage runner end to end on feeds landed from the driver tables.

    python tools/stage_bench.py [sf_dir]

Lands the derived primary pages (JSON lines, a page on each) and mirror rows
(Parquet) in a fresh scratch folder, then times ingest, score, filter and report
(Parquet stage files) one stage at a time. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vulnsift.plans.stages import StagePaths, run_stages  # noqa: E402
from vulnsift.session import local_session  # noqa: E402
from vulnsift.sources.fixture import mirror_rows, primary_pages  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    root = tempfile.mkdtemp(prefix="run-stages-")
    # Landing set-up (not timed): JSON lines with a page on each, Parquet mirror rows.
    pages, mirror = os.path.join(root, "landing", "pages"), os.path.join(root, "landing", "mirror")
    primary_pages(spark, sf_dir, only_source="nvd").write.json(pages)
    mirror_rows(spark, sf_dir, exclude_source="nvd").write.parquet(mirror)

    paths = StagePaths(os.path.join(root, "work"))
    timings, results = {}, {}
    for stage in ("ingest", "score", "filter", "report"):
        t0 = time.perf_counter()
        out = run_stages(spark, stage, paths, pages, mirror, "parquet", False, scored_at="2025-01-01T00:00:00Z")
        timings[stage] = round(time.perf_counter() - t0, 3)
        results[stage] = getattr(out, stage)
    print(json.dumps({"sf_dir": sf_dir, "stage_seconds": timings, "total": round(sum(timings.values()), 3),
                      "ingest": results["ingest"], "filter": results["filter"]}))
    spark.stop()


if __name__ == "__main__":
    main()
