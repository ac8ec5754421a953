"""One call for a whole run: scan, seek, reconcile, fold expiries, sort out, load or print, count, and say where to go on."""

from __future__ import annotations

import argparse
import importlib
import sys
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import scalars
from siltbed.functions.places import Order
from siltbed.operators import reconcile, scan_range, sink, ttl
from siltbed.operators.shared import new_folder
from siltbed.sources.sstable.datasource import File, find_files, read_files

#: Records of a target; of a table with clustering columns each row is a record of its own.
RECORD = "key binary, bins map<string, binary>, ttl long"
WIDE_RECORD = "key binary, clustering array<binary>, is_static boolean, bins map<string, binary>, ttl long"
KEY, WIDE_KEY = ["key"], ["key", "clustering", "is_static"]


@dataclass
class Run:
    """records has a row for every row that is read (key, token, columns, expiry, status, bins, ttl); summary one row."""

    records: DataFrame
    summary: DataFrame
    namespace: str
    set_name: str
    warnings: list[str]

    @property
    def key(self) -> list[str]:
        """The columns that identify a record: the key, and for tables with clustering columns the row in it."""
        return WIDE_KEY if "clustering" in self.records.columns else KEY

    def exported(self) -> DataFrame:
        """(key, bins, ttl) of what a load writes; with clustering (empty for static rows) and is_static after the key if the table has
        clustering columns."""
        return self.records.where("status = 'exported'").select(*self.key, "bins", "ttl")

    def cursor(self, last: tuple | None = None) -> DataFrame:
        """The key to resume from: the first beyond ``last`` (token, key), or the first of all; no row if nothing is left."""
        at = self.records if last is None else scan_range.seek(self.records, F.lit(last[0]), F.lit(last[1]), inclusive=False)
        return scan_range.first_key(at)

    def lines(self) -> DataFrame:
        """The rows as text, in the order of their tokens."""
        kept = self.records.where("status <> 'skipped'").orderBy(*_order(self.records))
        return kept.select(sink.record_text().alias("value"))


def _order(df: DataFrame) -> list[str]:
    return [c for c in ("token", "key", "clustering") if c in df.columns]


def records(cells: DataFrame, now: int, min_ttl: int = 1, eternal: int | None = None, expiry: str = "latest", target: DataFrame | None = None, drop_expired_cells: bool = False, wide: bool = False, order: Order | None = None, combine: bool = True, bare: DataFrame | None = None) -> DataFrame:
    """Every row of cells with columns, expiry, status, bins and ttl (null for never, or ``eternal``).

    Rows that are deleted and empty come with the status skipped. With ``wide`` every row of a partition is a record, identified by key,
    clustering (empty for static rows and partitions) and is_static, in the target as well; ``order`` is that of the clustering columns. For ``combine`` and ``bare`` see reconcile.
    """
    ttl.check_min_ttl(min_ttl)
    at = now if drop_expired_cells else None
    if wide:
        rows = reconcile.reconcile_wide(cells, at, keep_deleted=True, order=order, combine=combine, bare=bare).withColumn("clustering", F.coalesce("clustering", F.array().cast("array<binary>")))
    else:
        rows = reconcile.reconcile(cells, ("token", "key") if "token" in cells.columns else ("key",), at, keep_deleted=True, combine=combine)
    out = rows.withColumn("expiry", ttl.expiry("columns", expiry))
    skipped = F.col("del_ts").isNotNull() & (F.size("columns") == 0)
    ended = sink.with_status(out, target, WIDE_KEY if wide else KEY, skipped, ttl.is_alive("expiry", now, min_ttl))
    left = F.coalesce(F.col("expiry") - F.lit(now), F.lit(eternal).cast("long"))
    return ended.withColumn("bins", sink.bins()).withColumn("ttl", left)


def load_table(
    spark: SparkSession,
    paths: list[str],
    *,
    keyspace: str | None = None,
    table: str | None = None,
    namespace: str | None = None,
    set_name: str | None = None,
    start_key: bytes | None = None,
    min_ttl: int = 1,
    eternal: int | None = None,
    expiry: str = "latest",
    now: int | None = None,
    checksum: bool = True,
    drop_expired_cells: bool = False,
    ts_epoch: int = 0,
    target: DataFrame | None = None,
    on_target: Callable[[DataFrame], None] | None = None,
    files: list[File] | None = None,
) -> Run:
    """Read the files of one table, reconcile all rows and, if on_target is given, hand it the records that are to be written.

    now is in epoch seconds (by default the clock's); target holds what is there already (the columns of Run.key), so that records
    are created only. Several runs over the same files write nothing twice. Files are listed once, unless they are given.
    """
    files = find_files(paths, keyspace, table, ts_epoch=ts_epoch) if files is None else files
    about, header = files[0].table, files[0].meta.header
    given = {"checksum": checksum, "start_key_hex": start_key.hex() if start_key is not None else None}
    cells, bare = read_files(spark, files, **given), read_files(spark, files, values=False, **given) if header.clustering else None
    now = int(time.time()) if now is None else now
    space, set_, warnings = sink.target_names(about.keyspace, about.table, namespace, set_name)
    recs = records(cells, now, min_ttl, eternal, expiry, target, drop_expired_cells, wide=bool(header.clustering), order=header.order, combine=False, bare=bare)
    run = Run(recs, sink.summary(recs), space, set_, warnings)
    if on_target is not None:
        on_target(run.exported())
    return run


VERSION = "0.2"


def options(args: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser("siltbed", description="Load a table's files into a target, or print them.", add_help=False)
    p.add_argument("--help", action="help", help="show this text")
    p.add_argument("-v", action="version", version=f"siltbed {VERSION}", help="show the version")
    p.add_argument("-i", dest="paths", action="append", required=True, metavar="DIR", help="folder with data files; may be repeated")
    p.add_argument("-o", dest="target", metavar="DIR", help="Parquet folder to load into")
    p.add_argument("-h", dest="hosts", action="append", default=[], metavar="HOST[:PORT]", help="host of a key-value store to load into (needs -k); may be repeated")
    p.add_argument("-k", dest="client", metavar="MODULE:NAME", help="what connects to it: called with hosts, user, password, namespace and set_name, gives a client with put and close")
    p.add_argument("-u", dest="user", help="user of the store")
    p.add_argument("-p", dest="password", help="password of the store")
    p.add_argument("-e", dest="threads", type=int, default=4, help="threads that write, for each task")
    p.add_argument("-a", dest="in_flight", type=int, default=100, help="records in flight at once, for each thread")
    p.add_argument("-n", dest="namespace", help="target namespace, by default the keyspace")
    p.add_argument("-t", dest="set_name", help="target set, by default the table")
    p.add_argument("-C", dest="checksum", action="store_false", help="don't verify checksums")
    p.add_argument("-s", dest="start_text", metavar="KEY", help="start at this key")
    p.add_argument("-S", dest="start_hex", metavar="HEX", help="start at this key, in hex digits")
    p.add_argument("-L", dest="min_ttl", type=int, default=1, help="leave out records with fewer seconds to live")
    p.add_argument("-x", dest="eternal", action="store_const", const=0, help="records that never expire take the target's default")
    p.add_argument("-f", dest="expiry", action="store_const", const="nearest", default="latest", help="a record expires with its first column, not its last")
    p.add_argument("-D", dest="dry_run", action="store_true", help="print rows instead of loading them")
    got = p.parse_args(args)
    if got.start_text is not None and got.start_hex is not None:
        p.error("-s and -S exclude each other")
    try:
        got.start_key = got.start_text.encode() if got.start_text is not None else bytes.fromhex(got.start_hex) if got.start_hex is not None else None
        ttl.check_min_ttl(got.min_ttl)
        sink.WritePolicy(threads=got.threads, in_flight=got.in_flight)
    except ValueError as e:
        p.error(str(e))
    if got.dry_run + bool(got.target) + bool(got.hosts) != 1 and not (got.dry_run and got.target):
        p.error("one of -o, -h and -D is needed")
    if bool(got.hosts) != bool(got.client):
        p.error("-h and -k go together")
    return got


def write_to_store(spark: SparkSession, run: Run, o: argparse.Namespace) -> DataFrame:
    """(key, status, reason) of all exported records, written once to the shared folder."""
    module, _, name = o.client.partition(":")
    hosts = [(h["host"], h["port"]) for h in (r["h"] for r in spark.createDataFrame([(x,) for x in o.hosts], "x string").select(scalars.host_and_port(F.col("x")).alias("h")).collect())]

    given = {"hosts": hosts, "user": o.user, "password": o.password, "namespace": run.namespace, "set_name": run.set_name}

    def connect():
        return getattr(importlib.import_module(module), name)(**given)

    key = sink.row_key() if run.key == WIDE_KEY else F.col("key")
    policy = sink.WritePolicy(threads=o.threads, in_flight=o.threads * o.in_flight)
    where = new_folder(spark, "statuses")
    written = sink.write_records(run.exported().select(key.alias("key"), "bins", "ttl"), connect, policy)
    written.write.mode("overwrite").parquet(where)
    return spark.read.schema(written.schema).parquet(where)


def hint(at: DataFrame) -> str:
    """How to go on from a cursor: the options, or nothing if no key is left."""
    found = at.select(sink.resume_hint().alias("h")).first()
    return found["h"] if found else ""


def main(args: list[str] | None = None) -> int:
    """The command line. A run that is interrupted cancels its tasks and says from which key to go on; so does one that failed to
    write some records. Targets are create-only, so going on earlier than needed does no harm."""
    o = options(sys.argv[1:] if args is None else args)
    spark = SparkSession.builder.appName("siltbed").getOrCreate()
    if o.dry_run:
        run = load_table(spark, o.paths, start_key=o.start_key, min_ttl=o.min_ttl, eternal=o.eternal, expiry=o.expiry, checksum=o.checksum)
        for r in run.lines().toLocalIterator():
            print(r["value"])
        return 0
    files = find_files(o.paths)
    wide = bool(files[0].meta.header.clustering)
    place = sink.TableTarget(spark, o.target, WIDE_RECORD if wide else RECORD, WIDE_KEY if wide else KEY) if o.target else None

    def planned() -> Run:
        there = place.read() if place else None
        return load_table(spark, o.paths, files=files, namespace=o.namespace, set_name=o.set_name, start_key=o.start_key, min_ttl=o.min_ttl, eternal=o.eternal, expiry=o.expiry, checksum=o.checksum, target=there)

    run = planned()
    for w in run.warnings:
        print(f"warning: {w}", file=sys.stderr)
    try:
        if place:
            n, failed = place.create(run.records), ""
        else:
            statuses = write_to_store(spark, run, o)
            n = run.summary.first().asDict() | {r["status"]: r["count"] for r in [{"status": s, "count": 0} for s in ("exported", "existing", "failed")] + statuses.groupBy("status").count().collect()}
            keys = run.records.where("status = 'exported'").withColumn("written", sink.row_key() if wide else F.col("key"))
            lost = statuses.where("status = 'failed'").select(F.col("key").alias("written"))
            failed = hint(scan_range.first_key(keys.join(lost, "written", "left_semi"))) if n["failed"] else ""
    except KeyboardInterrupt:
        spark.sparkContext.cancelAllJobs()
        rest = planned()
        at = hint(scan_range.first_key(rest.records.where("status = 'exported'")))
        print(f"Stopped. {f'Go on with {at}' if at else 'Nothing is left.'}", file=sys.stderr)
        return 130
    print(f"Exported {n['exported']} records, failed to write {n['failed']}, skipped {n['skipped']} deleted and {n['expired']} expired ones and {n['existing']} that were there.")
    if failed:
        print(f"Go on with {failed}", file=sys.stderr)
    return 1 if failed else 0
