"""Command line: ``python -m pointstream.cli --datadir DIR (--dry-run | --url URL)``."""

from __future__ import annotations

import argparse
import os
import sys
import tempfile
import uuid

from .functions.units import HIGHEST, LOWEST, PRECISIONS, parse_byte_size, parse_rename, parse_time, show_time
from .operators.chunking import DEFAULT_BYTES, MOST_BYTES
from .sources import bolt, catalog


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pointstream", description="Recovers points from column files and logs and delivers them.")
    p.add_argument("--datadir", required=True)
    p.add_argument("--waldir")
    p.add_argument("--bolt", help="metadata file with the names of buckets; beside the engine's folder if not given")
    p.add_argument("--database", action="append", default=[])
    p.add_argument("--include-internal", action="store_true")
    p.add_argument("--start", type=parse_time, default=LOWEST)
    p.add_argument("--end", type=parse_time, default=HIGHEST)
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--sample", type=int, default=5)
    p.add_argument("--url")
    p.add_argument("--database-header", default="x-database", help="request header that the target reads the database from")
    p.add_argument("--token", default=os.environ.get("POINTSTREAM_TOKEN", ""))
    p.add_argument("--db-map", action="append", default=[], metavar="OLD=NEW")
    p.add_argument("--precision", choices=sorted(PRECISIONS), default="ns")
    p.add_argument("--chunk-bytes", type=parse_byte_size, default=DEFAULT_BYTES)
    p.add_argument("--workers", type=int, default=2)
    p.add_argument("--ledger", default="pointstream-ledger", help="folder that the driver and all executors share")
    p.add_argument("--staging", help="folder for lines meanwhile that all executors share; below spark.checkpoint.dir if not given")
    p.add_argument("--verbose", action="store_true", help="a line for each chunk and shard")
    return p


def staging(spark, given: str | None) -> str:
    """A new folder that all executors see: below the one given or ``spark.checkpoint.dir``; a temporary one on a local master only."""
    top = given or spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise SystemExit("--staging or spark.checkpoint.dir must name a folder that all executors share")
        top = tempfile.gettempdir()
    return f"{top.rstrip('/')}/staging-{uuid.uuid4().hex}"


def remove(spark, folder: str) -> None:
    """Through Spark's file systems, as the folder may be in any store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def find_shards(args) -> list[catalog.Shard]:
    data, layout = catalog.detect(args.datadir)
    if layout == catalog.UNKNOWN:
        raise SystemExit(f"no databases in {args.datadir}")
    if layout == catalog.V1:
        return catalog.shards(data, args.waldir, args.database, args.include_internal)
    try:
        rows = bolt.load(args.bolt or bolt.default_path(data))
    except bolt.Damaged as e:
        print(f"names of buckets can't be read ({e}); ids are used", file=sys.stderr)
        rows = []
    names, system = {i: n for i, n, _ in rows}, {i for i, _, kind in rows if kind}
    if len(set(names.values())) < len(names):
        print("several buckets have the same name and go to one database", file=sys.stderr)
    found = [s._replace(database=names.get(s.source_id, s.source_id)) for s in catalog.shards(data, args.waldir, (), args.include_internal) if args.include_internal or s.source_id not in system]
    return [s for s in found if not args.database or s.database in args.database]


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if not args.dry_run and not args.url:
        raise SystemExit("--url or --dry-run is needed")
    if args.chunk_bytes >= MOST_BYTES:
        raise SystemExit(f"--chunk-bytes must be below {MOST_BYTES}")
    if args.start > args.end:
        raise SystemExit("--start is after --end")
    from pyspark.sql import SparkSession

    from .plans import load
    from .sinks.http import Sink
    from .sinks.ledger import Ledger

    spark = SparkSession.builder.appName("pointstream").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    shards = find_shards(args)
    settings = load.Settings(args.start, args.end, args.chunk_bytes, args.precision, parse_rename(args.db_map), args.workers)
    if args.verbose:
        for s in shards:
            print(f"{s.database}/{s.retention}/{s.shard_id}: {len(s.tsm_files)} column files, {len(s.wal_files)} logs")
    if args.dry_run:
        found = load.dry_run(spark, shards, settings, args.sample)
        keys = {r["database"]: r for r in found["database_keys"].collect()}  # a row for each database, as all tables here
        samples = found["samples"].orderBy("database", "nth").collect()
        for r in found["databases"].orderBy("database").collect():
            target, k = settings.rename.get(r["database"], r["database"]), keys[r["database"]]
            print(f"{r['database']}" + (f" to {target}" if target != r["database"] else "") + f": {r['shards']} shards, {r['points']} points, {r['fields']} fields, {k['keys']} keys, {k['wal_keys']} keys in logs, {k['skipped']} keys skipped, {show_time(r['min_ts'])} to {show_time(r['max_ts'])}")
            for x in samples:
                if x["database"] == r["database"]:
                    print(x["lp"], end="")
        total = found["total"].first()
        print(f"in all: {total['points']} points, {total['fields']} fields, {total['databases']} databases")
        return 0
    ledger, folder = Ledger(args.ledger), staging(spark, args.staging)
    try:
        done = load.load(spark, shards, Sink(args.url, args.token, args.precision, database_header=args.database_header), ledger, settings, folder, verbose=args.verbose)
    finally:
        remove(spark, folder)
    print(done, "ledger:", ledger.summary(spark))
    return 0


if __name__ == "__main__":
    sys.exit(main())
