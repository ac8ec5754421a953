"""Loading a target create-only, with a status for every row, counters, a cursor and a text form."""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, as_completed, wait
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.scalars import display, is_printable, to_hex

#: Every row read has exactly one of these.
STATUSES = ("exported", "failed", "skipped", "expired", "existing")


def insert_if_absent(df: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key the target lacks (an anti join; Spark broadcasts the keys only if they are few)."""
    return df.join(target.select(*key), key, "left_anti")


def existing(df: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """The complement: rows whose key the target has."""
    return df.join(target.select(*key), key, "left_semi")


def with_status(rows: DataFrame, target: DataFrame | None, key: list[str], skipped: Column, alive: Column, failed: Column | None = None) -> DataFrame:
    """rows with a status column: skipped (deleted), expired, existing, failed or exported, the first that holds.

    Columns of the key hold no nulls."""
    flagged = rows
    if target is not None:
        flagged = rows.join(target.select(*key).distinct().withColumn("_there", F.lit(True)), key, "left")
    there = F.coalesce(F.col("_there"), F.lit(False)) if target is not None else F.lit(False)
    status = F.when(skipped, "skipped").when(~alive, "expired").when(there, "existing").when(failed if failed is not None else F.lit(False), "failed").otherwise("exported")
    out = flagged.withColumn("status", status)
    return out.drop("_there") if target is not None else out


def summary(rows: DataFrame) -> DataFrame:
    """One row of counters, one for each status."""
    return rows.agg(*counters())


def first_unsent(rows: DataFrame, ordinal: str = "ordinal", key: str = "key") -> DataFrame:
    """The key of the failed row that comes first; no row if none failed."""
    return rows.where("status = 'failed'").agg(F.min_by(key, ordinal).alias("key"), F.min(ordinal).alias("ordinal")).where("ordinal is not null")


def bins(columns: Column | str = "columns") -> Column:
    """map<name, value> of a reconciled row's columns; write times and expiries stay behind."""
    return F.map_from_entries(F.transform(columns, lambda c: F.struct(c["name"], c["value"])))


def record_text(key: Column | str = "key", columns: Column | str = "columns") -> Column:
    """A row as text: ``key:`` and a line for each column, ``name=value`` and `` (timeout=n)`` if it expires; hex where
    bytes aren't printable."""

    def line(c: Column) -> Column:
        timeout = F.when(c["expires_at"].isNotNull(), F.concat(F.lit(" (timeout="), c["expires_at"].cast("string"), F.lit(")"))).otherwise("")
        return F.concat(c["name"], F.lit("="), display(c["value"]), timeout)

    head = F.concat(display(key), F.lit(":"))
    return F.array_join(F.concat(F.array(head), F.transform(columns, line)), "\n")


def resume_hint(key: Column | str = "key") -> Column:
    """Arguments with which a run goes on from a key: ``-s`` and the text, or ``-S`` and hex digits."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(is_printable(key), F.concat(F.lit("-s "), display(key))).otherwise(F.concat(F.lit("-S "), to_hex(key)))


def target_names(keyspace: str, table: str, namespace: str | None = None, set_name: str | None = None) -> tuple[str, str, list[str]]:
    """Namespace and set of the target, by default those of the source, and warnings if they differ."""
    warnings = [f"{what} {given} differs from {own}" for what, given, own in (("namespace", namespace, keyspace), ("set", set_name, table)) if given and given != own]
    return namespace or keyspace, set_name or table, warnings


def counters(status: Column | str = "status") -> list[Column]:
    """One counter for each status, for an aggregation or to observe rows that pass by."""
    s = F.col(status) if isinstance(status, str) else status
    return [F.count_if(s == x).alias(x) for x in STATUSES]


class TableTarget:
    """A Parquet folder as target: creates records, never changes them. Loading the same rows again adds nothing."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str]):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key

    def read(self) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def load(self, rows: DataFrame) -> None:
        """Append the rows whose key isn't there; of rows with one key any one."""
        insert_if_absent(rows.dropDuplicates(self.key), self.read(), self.key).write.mode("append").parquet(self.path)

    def create(self, rows: DataFrame) -> dict[str, int]:
        """Append the rows whose status is exported and give the counters of all, in one pass over rows. Their status tells already what is
        there, and no two of them have one key."""
        seen = Observation()
        told = rows.observe(seen, *counters())
        columns = [f.name for f in T.StructType.fromDDL(self.schema)]
        told.where("status = 'exported'").select(*columns).write.mode("append").parquet(self.path)
        return seen.get


class Retry(Exception):
    """Raised by a client for what may work later: timeouts, full queues, lost connections."""


class Exists(Exception):
    """Raised by a client if the record is there already (or busy)."""


@dataclass
class WritePolicy:
    """How records are written: attempts for one, seconds before a new one (doubled each time, up to the last), seconds that all
    attempts of a record may take, records that are in flight at once and threads that write them.

    With one thread records are written one after the other, and ``in_flight`` bounds those that wait for a further attempt. With
    more, so many writes run at once, and at most ``in_flight`` records have been taken and not settled; the client has to be safe
    for threads.
    """

    retries: int = 14
    pause: float = 0.01
    longest_pause: float = 0.15
    in_flight: int = 100
    sleep: Callable[[float], None] = field(default=time.sleep, repr=False)
    timeout: float | None = None
    threads: int = 1

    def __post_init__(self):
        if self.retries < 0 or self.in_flight < 1 or self.threads < 1:
            raise ValueError("retries is 0 or more, in_flight and threads are 1 or more")

    def wait(self, tries: int) -> None:
        self.sleep(min(self.longest_pause, self.pause * 2 ** (tries - 1)) * (0.5 + random.random() / 2))

    def is_over(self, tries: int, began: float) -> bool:
        return tries >= self.retries or self.timeout is not None and time.monotonic() - began >= self.timeout


def _attempt(client, row) -> tuple:
    """(key, status, reason) of one attempt; the status is None if another may help."""
    try:
        client.put(bytes(row["key"]), row["bins"], row["ttl"])
        return row["key"], "exported", None
    except Exists:
        return row["key"], "existing", None
    except Retry as e:
        return row["key"], None, str(e)
    except Exception as e:  # a client's other errors concern one record
        return row["key"], "failed", str(e)


def write_partition(rows: Iterator, connect: Callable[[], object], policy: WritePolicy) -> Iterator[tuple]:
    """Write a partition's (key, bins, ttl) through a client and yield (key, status, reason).

    connect() gives a client with put(key, bins, ttl), which creates a record or raises Exists, Retry or another error, and
    close(). Records that wait for a further attempt go before new ones, and bound how many new ones are taken.
    """
    client = connect()
    try:
        yield from (_write_at_once if policy.threads > 1 else _write_in_turn)(rows, client, policy)
    finally:
        client.close()


def _write_in_turn(rows: Iterator, client, policy: WritePolicy) -> Iterator[tuple]:
    waiting: list = []

    def attempt(row, tries: int, began: float) -> tuple | None:
        key, status, reason = _attempt(client, row)
        if status is None and not policy.is_over(tries, began):
            waiting.append((row, tries + 1, began))
            return None
        return key, status or "failed", reason

    def settle(most: int) -> Iterator[tuple]:
        while len(waiting) > most:
            again, waiting[:] = list(waiting), []
            policy.wait(min(t for _, t, _ in again))
            for item in again:
                if (done := attempt(*item)) is not None:
                    yield done

    for row in rows:
        if (done := attempt(row, 0, time.monotonic())) is not None:
            yield done
        yield from settle(policy.in_flight - 1)
    yield from settle(0)


def _write_at_once(rows: Iterator, client, policy: WritePolicy) -> Iterator[tuple]:
    def write(row) -> tuple:
        began = time.monotonic()
        for tries in itertools.count():
            key, status, reason = _attempt(client, row)
            if status is not None or policy.is_over(tries, began):
                return key, status or "failed", reason
            policy.wait(tries + 1)

    with ThreadPoolExecutor(policy.threads) as pool:
        flying = set()
        for row in rows:
            flying.add(pool.submit(write, row))
            if len(flying) >= policy.in_flight:
                done, flying = wait(flying, return_when=FIRST_COMPLETED)
                yield from (d.result() for d in done)
        yield from (d.result() for d in as_completed(flying))


def write_records(records: DataFrame, connect: Callable[[], object], policy: WritePolicy | None = None) -> DataFrame:
    """(key, status, reason) of records (key, bins, ttl) written through a client, one connection a partition.

    Records are created only, so a task that runs again finds what it had written as existing. Run it once (write or
    checkpoint the result): every action on the result writes again. Statuses leave a task as they come.
    """
    policy = policy or WritePolicy()

    def run(batches):
        import pyarrow as pa

        rows = (r for b in batches for r in pa.Table.from_batches([b]).to_pylist())
        written = write_partition(({**r, "bins": dict(r["bins"] or [])} for r in rows), connect, policy)
        while got := list(itertools.islice(written, 4096)):
            yield pa.record_batch([pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.string())], names=["key", "status", "reason"])

    return records.select("key", "bins", "ttl").mapInArrow(run, "key binary, status string, reason string")


def row_key(key: Column | str = "key", clustering: Column | str = "clustering", is_static: Column | str = "is_static") -> Column:
    """One binary key of a row of a table with clustering columns, for targets that know keys only: the parts as [u16 length][bytes][0], a
    null as length 65535, a static row's key alone with a last byte of 1. Parts are shorter than 65535 bytes."""
    key, clustering, is_static = (F.col(c) if isinstance(c, str) else c for c in (key, clustering, is_static))

    def part(x: Column) -> Column:
        size = F.unhex(F.lpad(F.hex(F.coalesce(F.octet_length(x), F.lit(0xFFFF))), 4, "0"))
        return F.concat(size, F.coalesce(x, F.lit(b"")), F.lit(b"\x00"))

    rest = F.aggregate(F.coalesce(clustering, F.array().cast("array<binary>")), F.lit(b""), lambda a, x: F.concat(a, part(x)))
    return F.concat(part(key), rest, F.when(is_static, F.lit(b"\x01")).otherwise(F.lit(b"")))
