"""A run as a Spark job.

    spark-submit --py-files authorlink.zip authorlink/job.py prepare --mode incremental --folder IN --out MATCH
    spark-submit --py-files authorlink.zip authorlink/job.py incremental --folder IN --work MATCH/work --master-out V2

    spark-submit --py-files authorlink.zip authorlink/job.py incremental --folder IN --store ROOT

``prepare`` writes what the matcher reads. The runs need the matcher's output among
their inputs: the five tables, as parquet under a folder or in a catalog schema. The
new master goes to a new path; the staging table is replaced after that. With a store
(``MasterStore``) the master is read from it, and master and staging table are published together.
"""

from __future__ import annotations

import argparse
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink import (
    Inputs,
    MasterStore,
    Options,
    Workspace,
    prepare_matching,
    run_bootstrap,
    run_full_refresh,
    run_incremental,
)
from authorlink.sources.tables import publish_stage, write_snapshot

_RUNS = {"full-refresh": run_full_refresh, "incremental": run_incremental}

#: Settings that the plans are made for; each can be overridden on the command line of spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Split skewed joins in front of other steps too, at the price of a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Joins on more columns than those of a table's buckets leave it where it is.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A sorted join becomes a hash join where every partition's side was seen to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Recording the Python line of every column costs more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="authorlink.job")
    parser.add_argument("run", choices=[*_RUNS, "bootstrap", "prepare"])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--folder", help="folder of parquet tables, or the prior delivery of a bootstrap")
    source.add_argument("--schema", help="catalog schema of the tables")
    parser.add_argument("--mode", choices=_RUNS, default="incremental", help="the run that prepare is for")
    parser.add_argument("--out", help="folder for the tables names, holders and work of prepare")
    parser.add_argument("--work", help="work set that prepare wrote")
    parser.add_argument("--master-out", help="new path for the next master")
    parser.add_argument("--stage-out", help="path of the staging table")
    parser.add_argument("--store", help="root of a store of versions, in place of --master-out and --stage-out")
    parser.add_argument("--buckets", type=int, help="buckets of the master in a new store")
    parser.add_argument("--id-floor", type=int, help="highest id taken to be in use when there is none")
    parser.add_argument("--transformation-id", type=int, default=Options.transformation_id)
    parser.add_argument("--run-ts", type=datetime.fromisoformat, help="time stamped on rows")
    parser.add_argument("--audit", action="append", default=[], metavar="COLUMN=VALUE", help="constant column of the staging table")
    for flag in ("null-safe-keys", "keep-placeholder-rows", "strict-merge", "null-safe-merge"):
        parser.add_argument(f"--{flag}", action="store_true")
    args = parser.parse_args(argv)
    if args.run == "prepare" and not args.out:
        parser.error("prepare needs --out")
    if args.run != "prepare" and bool(args.store) == bool(args.master_out):
        parser.error(f"{args.run} needs either --master-out or --store")
    return args


def _options(args: argparse.Namespace) -> Options:
    return Options(
        transformation_id=args.transformation_id,
        run_ts=args.run_ts,
        audit=dict(pair.split("=", 1) for pair in args.audit) or None,
        id_floor=args.id_floor,
        null_safe_keys=args.null_safe_keys,
        keep_placeholder_rows=args.keep_placeholder_rows,
        strict_merge=args.strict_merge,
        null_safe_merge=args.null_safe_merge,
    )


def _run(spark: SparkSession, args: argparse.Namespace, workspace: Workspace, store: MasterStore | None) -> None:
    options, matched = _options(args), args.run != "prepare"
    if args.schema:
        inputs = Inputs.from_catalog(spark, args.schema, matched)
    else:
        inputs = Inputs.from_folder(spark, args.folder, matched)
    before = store.current() if store else None
    if before:
        inputs = replace(inputs, matched_author_isbn13=store.master(before))
    if not matched:
        for name, table in prepare_matching(inputs, workspace, args.mode == "incremental")._asdict().items():
            table.write.mode("errorifexists").parquet(f"{args.out}/{name}")
        return
    work = spark.read.parquet(args.work) if args.work else None
    result = _RUNS[args.run](inputs, workspace, options, work=work)
    if store:
        store.publish(result.master, _inserted(result.stage, options), args.buckets, before)
        return
    write_snapshot(result.master, args.master_out)
    if args.stage_out:
        # Last, so that a failed run leaves the staging table of the one before.
        publish_stage(_inserted(result.stage, options), args.stage_out)


def _inserted(stage: DataFrame, options: Options) -> DataFrame:
    inserted = F.lit(options.run_ts) if options.run_ts else F.current_timestamp()
    return stage.withColumn("etl_date_inserted", inserted.cast("timestamp_ntz"))


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.config(map=SETTINGS).getOrCreate()
    store = MasterStore(spark, args.store) if args.store else None
    if args.run == "bootstrap":
        if args.schema:
            prior = spark.table(f"{args.schema}.book_ref_prior")
        else:
            prior = spark.read.parquet(args.folder)
        master = run_bootstrap(prior, _options(args))
        store.publish(master, buckets=args.buckets) if store else write_snapshot(master, args.master_out)
        return
    workspace = Workspace(spark)
    try:
        _run(spark, args, workspace, store)
    finally:
        if store:
            store.close()
        workspace.drop()


if __name__ == "__main__":
    main()
