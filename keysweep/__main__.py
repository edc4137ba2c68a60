"""Command line for one cleanup.

    python -m keysweep --run-folder ... --manifest ...
    python -m keysweep --run-folder ... --store-client package.module:make_client [--look] [--ledger ...]
    python -m keysweep --manifest ... --init export.parquet | --versions | --report 7 | --expire 2 | --remove-orphans 604800
    spark-submit --py-files keysweep.zip keysweep/__main__.py --run-folder ... --manifest ...

Uses the session that ``spark-submit`` (or the local ``pyspark``) provides
and prints the report line.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession

from keysweep.plans.job import check_run_lines, run_cleanup, run_store_cleanup
from keysweep.sinks.snapshot import expire_snapshots, init_manifest, remove_orphans, run_report
from keysweep.sources.manifest import commit_numbers, is_torn, part_folder, read_commit


def parse_args(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="keysweep", description="Clean a duplicate manifest after a failed load.")
    parser.add_argument("--run-folder", default=None,
                        help="folder of the run's enriched part-* files (s3://, s3a://, hdfs://, file path)")
    parser.add_argument("--manifest", default=None, help="manifest root holding the versions")
    parser.add_argument("--store-client", metavar="MODULE:CALLABLE", default=None,
                        help="delete in an external keyed store instead: a callable that makes a client")
    parser.add_argument("--parallelism", type=int, default=None, help="with --store-client: number of tasks and clients")
    parser.add_argument("--concurrency", type=int, default=1, help="with --store-client: calls in flight per task")
    parser.add_argument("--look", action="store_true",
                        help="with --store-client: look every key up before the first delete; totals are then exact whatever fails")
    parser.add_argument("--ledger", default=None,
                        help="with --store-client: folder of the outcomes; one that a broken-off call has left is resumed")
    parser.add_argument("--time", default=None,
                        help="ETL time for orphan events, yyyy-MM-dd-HH-mm-ss (UTC); replaces every event's")
    parser.add_argument("--dry-run", action="store_true", help="count only; publish nothing")
    parser.add_argument("--check-keys", action="store_true",
                        help="fail when a key pair of the rows to delete is stored more than once")
    parser.add_argument("--verify", action="store_true", help="recount the deletes before publishing")
    parser.add_argument("--keep-snapshots", type=int, default=None,
                        help="after publishing, remove all but this many newest snapshots")
    parser.add_argument("--check-lines", metavar="OUT", default=None,
                        help="only write the run's malformed / bad-timestamp lines to OUT (parquet) and count them")
    upkeep = parser.add_mutually_exclusive_group()
    upkeep.add_argument("--init", metavar="EXPORT", default=None,
                        help="publish a parquet export (eventId, fingerprint, etlTime) as the first version of --manifest")
    upkeep.add_argument("--versions", action="store_true", help="list the versions of --manifest")
    upkeep.add_argument("--report", metavar="VERSION", type=int, default=None,
                        help="print again what the cleanup that published a version of --manifest printed")
    upkeep.add_argument("--expire", metavar="KEEP", type=int, default=None, help="remove all but this many newest versions of --manifest")
    upkeep.add_argument("--remove-orphans", metavar="SECONDS", type=int, default=None,
                        help="remove what no version of --manifest needs and what is older than this")
    args = parser.parse_args(argv)
    if upkeep_asked(args):
        if args.manifest is None or args.run_folder is not None:
            parser.error("--init, --versions, --report, --expire and --remove-orphans take --manifest and no --run-folder")
        return args
    if args.run_folder is None:
        parser.error("--run-folder is needed")
    if args.manifest is None and args.store_client is None and args.check_lines is None:
        parser.error("one of --manifest, --store-client or --check-lines is needed")
    if args.store_client is not None:
        if args.manifest is not None or args.check_keys or args.verify or args.keep_snapshots is not None:
            parser.error("--manifest, --check-keys, --verify and --keep-snapshots don't go with --store-client")
        if args.dry_run and args.ledger is not None:
            parser.error("--dry-run sends nothing and keeps no ledger")
    elif args.look or args.ledger is not None or args.parallelism is not None:
        parser.error("--look, --ledger and --parallelism need --store-client")
    return args


def upkeep_asked(args: argparse.Namespace) -> bool:
    return args.versions or any(x is not None for x in (args.init, args.report, args.expire, args.remove_orphans))


def upkeep(spark: SparkSession, args: argparse.Namespace) -> None:
    """The commands on a manifest that aren't a cleanup."""
    root = args.manifest
    if args.init is not None:
        print(f"published manifest version {init_manifest(spark, spark.read.parquet(args.init), root)}")
    elif args.versions:
        for number in commit_numbers(spark, root):
            if is_torn(spark, root, number):
                print(f"{number}: torn, not a version")
            else:
                commit = read_commit(spark, root, number)
                print(f"{number}: {commit.rows} rows in {len({(w, part_folder(w, p)) for p, (w, _) in commit.days.items()})} folders" + (f", run {commit.run['folder']}" if commit.run else ""))
    elif args.report is not None:
        print(run_report(spark, root, args.report))
    elif args.expire is not None:
        print(f"removed versions: {expire_snapshots(spark, root, args.expire) or 'none'}")
    else:
        print(f"removed: {', '.join(remove_orphans(spark, root, args.remove_orphans)) or 'nothing'}")


def client_factory(name: str):
    """The callable that ``module:callable`` names."""
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"--store-client must be module:callable, not {name!r}")
    return getattr(importlib.import_module(module), attribute)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("keysweep").getOrCreate()
    if upkeep_asked(args):
        upkeep(spark, args)
        return 0
    if args.check_lines:
        counts = check_run_lines(spark, args.run_folder, args.check_lines, override_time=args.time)
        print(f"lines that would fail the cleanup: {counts or 'none'} (written to {args.check_lines})")
        return 1 if counts else 0
    if args.store_client:
        done = run_store_cleanup(spark, args.run_folder, client_factory(args.store_client), override_time=args.time,
                                 parallelism=args.parallelism, concurrency=args.concurrency, publish=not args.dry_run,
                                 ledger=args.ledger, look=args.look)
        if not done.exact:
            print(f"of {done.unknown} keys a first call may have deleted the row: between {done.deleted} and "
                  f"{done.deleted + done.unknown} events were deleted")
        if done.ledger is not None:
            print(f"outcomes are in {done.ledger}")
        return 0
    result = run_cleanup(spark, args.run_folder, args.manifest, override_time=args.time,
                         publish=not args.dry_run, check_keys=args.check_keys, verify=args.verify,
                         keep_snapshots=args.keep_snapshots)
    if result.version is not None:
        print(f"published manifest version {result.version}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
