"""Benchmark: run the registered queries on ``$BENCH_SF_DIR`` with
``local[$BENCH_CPUS]`` and print one JSON line.

Each batch query is fully executed with the ``noop`` sink (every row is
produced, nothing is collected to the driver); the reported time per query
is the best of ``$BENCH_REPEAT`` runs (default 3).  Streaming queries replay
files through micro-batches and are reported separately.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
WITH_STREAMS = os.environ.get("BENCH_STREAMS", "1") != "0"
# Untimed warm-ups read the smallest scale factor next to the benchmarked one.
_SMALLEST = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
WARMUP_DIR = _SMALLEST if os.path.isdir(_SMALLEST) else SF_DIR


def _sf_of(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def reference_workloads(spark):
    """The workload parameters the reference's jobs run by default
    10 descent rounds over the 21 built-in points, word count of the
    built-in text.  Timed separately from the registered queries."""
    from pyspark.sql import functions as F

    from floe.operators.counts import word_count
    from floe.operators.ratio import indicator_ratio, inside_unit_circle, unit_hash
    from floe.operators.regression import descend
    from floe.sources.builtin import default_points, default_text
    from floe.sources.sequence import integer_sequence

    def timed(build):
        def go():
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        return go

    def circle():
        ids = integer_sequence(spark, 1, 1_000_000)
        x = unit_hash((F.col("id"), 2654435761), modulus=2**32)
        y = unit_hash((F.col("id"), 1442695041), modulus=2**32)
        pts = ids.select(x.alias("x"), y.alias("y"))
        return indicator_ratio(pts, inside_unit_circle(F.col("x"), F.col("y")), 4.0)

    return {
        "ratio_1m_samples": timed(circle),
        "descent_21_points_10_rounds": timed(lambda: descend(default_points(spark), 10)),
        "word_count_default_text": timed(lambda: word_count(default_text(spark))),
    }


def main() -> None:
    from floe.plans import REGISTRY
    from floe.session import build_session

    spark = build_session(
        f"local[{CPUS}]",
        "floe-bench",
        shuffle_partitions=max(8, CPUS * 2),
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="floe-bench-ckpt-")},
    )

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name].build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # JVM / codegen warm-up on the smallest input, not timed.
    REGISTRY["word_count"].build(spark, WARMUP_DIR).write.format(
        "noop"
    ).mode("overwrite").save()

    # Streaming warm-up, not timed: the first stateful stream of a session
    # starts the Python state workers and loads the RocksDB library.
    if WITH_STREAMS:
        REGISTRY["stream_track_change"].build(spark, WARMUP_DIR).write.format(
            "noop"
        ).mode("overwrite").save()

    batch, streams, stream_rate = {}, {}, {}
    for name in REGISTRY:
        if name.startswith("stream_"):
            if WITH_STREAMS:
                secs = run(name)
                streams[name] = round(secs, 3)
                source = "orders" if name in ("stream_proc_time", "stream_proc_time_once", "stream_ttl_totals") else "events"
                rows = spark.read.parquet(f"{SF_DIR}/{source}.parquet").count()
                stream_rate[name] = round(rows / secs)
            continue
        batch[name] = round(min(run(name) for _ in range(REPEAT)), 3)

    workloads = {k: round(min(fn() for _ in range(REPEAT)), 3) for k, fn in reference_workloads(spark).items()}

    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_batch_query_time",
                "value": round(sum(batch.values()), 3),
                "unit": "sec",
                "queries": batch,
                "stream_queries": streams,
                "stream_total": round(sum(streams.values()), 3),
                "stream_rows_per_sec": stream_rate,
                "reference_workloads": workloads,
                "sf": _sf_of(SF_DIR),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
