"""Time the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gaugeflow.queries import QUERIES  # noqa: E402
from gaugeflow.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        f"local[{cpus}]",
        app_name="gaugeflow-bench",
        shuffle_partitions=8,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("count(*)").collect()

    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)

    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    rates = {
        name: round(events / seconds[name])
        for name in ("stream_ingest", "upsert_latest", "upsert_stream", "keyed_previous")
        if name in seconds
    }
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "events_per_second": rates,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
