"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)

Light queries: one warm-up, then the median of three runs. Heavy ones run once. No query reads what
another one left; what they store goes with the run's folder.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cityweave.operators import models  # noqa: E402
from cityweave.session import local_session, work_path  # noqa: E402
from workload import feeds  # noqa: E402
from workload.queries import REGISTRY, ROW_KEY, trained  # noqa: E402

LIGHT = [
    "align_topics", "clean_traffic", "profile_outliers", "boxplot_stats", "profile_nulls", "anova_f", "dedupe_rows",
    "kde_curve", "histogram20", "latest_per_key", "label_encode", "robust_scale", "bbox_assign", "kmeans_assign",
    "stream_dedupe",
]
HEAVY = ["kmeans_fit", "classify_pollution", "stream_align", "stream_upsert", "concat_json"]
# The tuned forest takes minutes at this scale; the tests fit it on smaller tables.
TRAINED = ["lr", "dt", "rf"]


def seconds(run: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def measure(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    times = {}
    for name in LIGHT:
        run = partial(REGISTRY[name], spark, sf_dir)
        seconds(run)
        times[name] = statistics.median(seconds(run) for _ in range(3))
    for name in HEAVY:
        times[name] = seconds(partial(REGISTRY[name], spark, sf_dir))
    # Training and scoring read a stored table and a stored model that are made before and not timed.
    rows = feeds.combined(spark, sf_dir)
    for kind in TRAINED:
        times[f"train_{kind}"] = seconds(lambda kind=kind: trained(rows, kind).metrics)
    path = work_path(spark, "model")
    models.save_model(trained(rows, "dt").model, path)
    times["score_batch"] = seconds(lambda: models.score(models.load_model(path), rows.drop(models.LABEL), keep=ROW_KEY))
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"), **{"spark.checkpoint.dir": folder})
        times = measure(spark, sf_dir)
        spark.stop()
    total = round(sum(times.values()), 3)
    scale = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
