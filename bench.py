"""Benchmark: runs the headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line with per-query seconds.

Every query is forced to completion with a no-op write (full computation, nothing collected) and runs
cold: the shared building blocks (scaled rows, centers, density labels) are dropped before each.
``segmentation_run`` is the whole job (EDA tables, k-sweep with all restarts, four algorithms, validation).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "profile_kmeans",      # flagship: join + clean + scale + Lloyd + profiles
    "describe",
    "outlier_report",
    "correlations",
    "histogram30",
    "null_report",
    "category_shares",
    "cluster_insights",
    "recommendation_rows",
    "cluster_scores",
    "silhouette_exact",
    "ari_table",
    "gmm_bic_aic",
    "k_distance_eps",
    "dbscan_labels",
    "dbscan_summary",
    "silhouette_embeddings",
    "sweep_lloyd",
    "comparison",
    "kmeans_fit",
    "gmm_fit",
    "ward_labels",
    "segmentation_run",    # the full run that the published 2-3 minutes are about
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("cohortlens-bench")
             .config("spark.sql.shuffle.partitions", str(max(4, int(cpus) * 2)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from cohortlens.plans.catalog import QUERIES
    from cohortlens.plans.context import forget

    names = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        forget()
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
