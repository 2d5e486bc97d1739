"""Timings of both runs and of their heaviest operators; prints one JSON line.

The derived input tables are written first, outside the timings, as a real run
would find them: the master in buckets, as the delivery before left it. Each query runs twice;
the faster time counts.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from authorlink import MasterStore, Workspace, run_full_refresh, run_incremental
from authorlink.job import SETTINGS
from authorlink.verify.fixtures import Fixtures
from authorlink.verify.steps import IncrementalSteps

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("authorlink-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(map=SETTINGS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _seconds(query: Callable[[], DataFrame]) -> float:
    times = []
    for _ in range(2):
        start = time.perf_counter()
        query().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    spark = _session()
    workspace = Workspace(spark)
    inputs = Fixtures(spark, SF_DIR).inputs(workspace)
    store = MasterStore(spark, f"{workspace.path}/store")
    store.publish(inputs.matched_author_isbn13, buckets=int(CPUS))
    inputs = replace(inputs, matched_author_isbn13=store.master())
    steps = IncrementalSteps(inputs, workspace)

    def again(name: str) -> Callable[[], DataFrame]:
        """One operator, on what the operators before it left."""

        def query() -> DataFrame:
            vars(steps).pop(name, None)
            return getattr(steps, name)

        return query

    queries = {
        "p45_run_incremental": lambda: run_incremental(inputs, workspace).master,
        "p44_run_full_refresh": lambda: run_full_refresh(inputs, workspace).master,
        "p06_delta_classify": again("classified"),
        "p12_residual_after_isni": again("residual_1"),
        "p33_allocate_ids": again("allocated"),
        "p41_merge_upsert": again("merged"),
    }
    for name in ("work", "by_name", "combined_known", "stage"):
        getattr(steps, name)
    times = {name: _seconds(query) for name, query in queries.items()}
    store.close()
    workspace.drop()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of both runs and four operators, from written input tables",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
