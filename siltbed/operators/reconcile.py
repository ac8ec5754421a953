"""Merging versions of cells: last write wins, tombstones, row assembly.

All functions take cells in the long form of ``siltbed.schema`` (only the columns that they name are needed) and a list of
columns that identify a row. They are group-bys with partial aggregation and equi-joins, so they scale with the number of
rows; what a task holds is one row's columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions import places
from siltbed.functions.places import Order

ROW = ("key",)
#: What a column keeps of its winning version.
KEPT = ("ts", "deleted", "ttl", "expires_at", "value")


def union_sources(*sources: DataFrame) -> DataFrame:
    """Cells of several sources in one frame; with the group-bys below this is their N-way merge."""
    return reduce(DataFrame.unionByName, sources)


def _newest(prefix: str = "") -> Column:
    """What a version is judged by: the greatest ts, of equals the lowest source, then the lowest position."""
    return F.struct(F.col(f"{prefix}ts"), (-F.col(f"{prefix}src")).alias("s"), (-F.col(f"{prefix}pos")).alias("p"))


def latest(cells: DataFrame, row: tuple[str, ...] = ROW, kept: tuple[str, ...] = KEPT) -> DataFrame:
    """Last write wins: the newest version of each cell (row, name), tombstones included; range and row deletions take no part."""
    picked = cells.where(F.col("kind") == "cell").groupBy(*row, "name").agg(F.max_by(F.struct(*kept), _newest()).alias("w"))
    return picked.select(*row, "name", *[F.col(f"w.{c}").alias(c) for c in kept])


def latest_by_window(cells: DataFrame, row: tuple[str, ...] = ROW, kept: tuple[str, ...] = KEPT) -> DataFrame:
    """The same as ``latest`` by a window: no partial aggregation, for when versions are few or all columns are wanted."""
    w = Window.partitionBy(*row, "name").orderBy(F.col("ts").desc(), "src", "pos")
    return cells.where(F.col("kind") == "cell").withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*row, "name", *kept)


def merge_two_by_two(sources: list[DataFrame], row: tuple[str, ...] = ROW) -> DataFrame:
    """The same as ``latest`` over the union, as a chain of full outer joins of sources with one version of a cell each."""
    on = [*row, "name"]
    one = [latest(s, row, ("ts", "src", "pos", "value")).withColumn(f"w{i}", F.struct("ts", (-F.col("src")).alias("s"), (-F.col("pos")).alias("p"), "value")).select(*on, f"w{i}") for i, s in enumerate(sources)]
    joined = reduce(lambda a, b: a.join(b, on, "full_outer"), one)
    top = F.array_max(F.array_compact(F.array(*[F.col(f"w{i}") for i in range(len(one))])))
    return joined.withColumn("w", top).select(*on, "w.ts", (-F.col("w.s")).alias("src"), "w.value")


def live_cells(winners: DataFrame) -> DataFrame:
    """Winners that are no tombstones and have a name. Only after the choice of winners: else older versions come back."""
    return winners.where(~F.col("deleted") & (F.col("name") != ""))


def deletions(cells: DataFrame, row: tuple[str, ...] = ROW) -> DataFrame:
    """(row, del_ts): the newest deletion of each row that has one."""
    return cells.where(F.col("kind") == "row_deletion").groupBy(*row).agg(F.max("ts").alias("del_ts"))


def ranges(cells: DataFrame, row: tuple[str, ...] = ROW) -> DataFrame:
    """(row, lo, hi, rts): range tombstones, the newest of each range."""
    return cells.where(F.col("kind") == "range_tombstone").groupBy(*row, F.col("name").alias("lo"), F.col("range_end").alias("hi")).agg(F.max("ts").alias("rts"))


def drop_deleted_rows(winners: DataFrame, dels: DataFrame, row: tuple[str, ...] = ROW) -> DataFrame:
    """Cells that are newer than their row's deletion, if it has one; a deletion wins ties."""
    return winners.join(dels, list(row), "left").where(F.col("del_ts").isNull() | (F.col("del_ts") < F.col("ts"))).drop("del_ts")


def drop_covered(winners: DataFrame, rts: DataFrame, row: tuple[str, ...] = ROW) -> DataFrame:
    """Cells that no range tombstone covers: an anti join with equality on the row and an interval on the name."""
    on = reduce(lambda a, b: a & b, [F.col(f"c.{k}") == F.col(f"r.{k}") for k in row])
    inside = F.col("c.name").between(F.col("r.lo"), F.col("r.hi")) & (F.col("c.ts") <= F.col("r.rts"))
    return winners.alias("c").join(rts.alias("r"), on & inside, "left_anti")


def drop_covered_by_arrays(winners: DataFrame, rts: DataFrame, row: tuple[str, ...] = ROW) -> DataFrame:
    """The same with each row's ranges as an array; for rows with few ranges, one equi-join without an interval."""
    arrays = rts.groupBy(*row).agg(F.collect_list(F.struct("lo", "hi", "rts")).alias("rs"))
    return winners.join(arrays, list(row), "left").where(~F.coalesce(_is_covered(F.col("name"), F.col("ts"), F.col("rs")), F.lit(False))).drop("rs")


def _is_covered(name: Column, ts: Column, rs: Column) -> Column:
    return F.exists(rs, lambda r: name.between(r["lo"], r["hi"]) & (ts <= r["rts"]))


def merge(cells: DataFrame, row: tuple[str, ...] = ROW) -> DataFrame:
    """Live columns after all rules, in long form: the newest versions without cell, row and range tombstones."""
    w = drop_deleted_rows(live_cells(latest(cells, row)), deletions(cells, row), row)
    return drop_covered(w, ranges(cells, row), row)


def reconcile(cells: DataFrame, row: tuple[str, ...] = ROW, drop_expired_at: int | None = None, keep_deleted: bool = False, combine: bool = True) -> DataFrame:
    """(row, columns, del_ts): one row for each row of any source that is returned, columns in byte order of their names.

    A row with a deletion and no live column is dropped (unless keep_deleted); a row without a deletion comes back even if no
    column is left.
    drop_expired_at (epoch seconds) also drops columns that have expired by then, which by default only the record's expiry
    decides.

    The scan is read once: versions are reduced by (row, kind, name, range_end) with partial aggregation, then each row is
    put together with its deletion and ranges at hand. If cells are partitioned by the row already, both steps use that. Without
    ``combine`` they are first: for scans whose tasks see one version of a cell, as those of table files do, so that there is nothing to
    reduce before the shuffle and values move once instead of twice.
    """
    if not combine:
        cells = cells.repartition(*row)
    reduced = cells.groupBy(*row, "kind", "name", "range_end").agg(F.max_by(F.struct(*KEPT), _newest()).alias("w"), F.max("ts").alias("top"))
    is_cell = (F.col("kind") == "cell") & ~F.col("w.deleted") & (F.col("name") != "")
    held = reduced.groupBy(*row).agg(
        F.collect_list(F.when(is_cell, F.struct("name", "w.value", "w.ts", "w.ttl", "w.expires_at"))).alias("cs"),
        F.max(F.when(F.col("kind") == "row_deletion", F.col("top"))).alias("del_ts"),
        F.collect_list(F.when(F.col("kind") == "range_tombstone", F.struct(F.col("name").alias("lo"), F.col("range_end").alias("hi"), F.col("top").alias("rts")))).alias("rs"),
    )

    def lives(c: Column) -> Column:
        keep = (F.col("del_ts").isNull() | (F.col("del_ts") < c["ts"])) & ~_is_covered(c["name"], c["ts"], F.col("rs"))
        if drop_expired_at is not None:
            keep = keep & (c["expires_at"].isNull() | (c["expires_at"] > F.lit(drop_expired_at).cast("long")))
        return keep

    by_name = F.array_sort(F.filter("cs", lives), lambda a, b: F.when(a["name"] < b["name"], F.lit(-1)).when(a["name"] > b["name"], F.lit(1)).otherwise(F.lit(0)))
    rows = held.select(*row, by_name.alias("columns"), "del_ts")
    return rows if keep_deleted else rows.where(F.col("del_ts").isNull() | (F.size("columns") > 0))


def reconcile_wide(cells: DataFrame, drop_expired_at: int | None = None, keep_deleted: bool = False, order: Order | None = None, combine: bool = True, bare: DataFrame | None = None) -> DataFrame:
    """Like reconcile, for tables with clustering columns: a row is (key, clustering, is_static). Deletions of a whole partition (no
    clustering) and of ranges of rows (rows_deletion) reach their rows through one join by key; static rows are in no range.

    ``order`` says how the clustering columns are ordered; without it, or with types of another order, a rows_deletion is an error. A partition's rows are each tested
    against all its deletions and ranges, of which a table's files hold few for a key. ``bare`` holds the same cells without values, if
    they can be read so: deletions and rows are looked up there.
    """
    whole = (F.col("kind") == "row_deletion") & F.col("clustering").isNull() & ~F.col("is_static")
    of_rows = F.col("kind") == "rows_deletion"
    bare = cells if bare is None else bare
    if order is None or not places.is_known(order):
        order = None
        bare = bare.where(F.when(of_rows, F.raise_error(F.lit("ranges of rows need the order of the clustering columns")).cast("boolean")).otherwise(F.lit(True)))
    row = ("key", "clustering", "is_static")
    marks = bare.where(whole | of_rows).groupBy("key", F.when(of_rows, F.col("name")).alias("lo"), F.when(of_rows, F.col("range_end")).alias("hi")).agg(F.max("ts").alias("p"))
    parts, seen = (c.where(~(whole | of_rows)) for c in (cells, bare))
    at = places.place("clustering", order) if order else F.lit(None).cast("string")
    rows = seen.select(*row).distinct().withColumn("_at", at)
    marks = marks.withColumnRenamed("key", "_key")
    found = rows.join(marks, (F.col("key") == F.col("_key")) & (F.col("hi").isNull() | F.col("_at").between(F.col("lo"), F.col("hi"))))
    extra = found.select(*row, F.lit("row_deletion").alias("kind"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("range_end"), F.col("p").alias("ts"))
    return reconcile(parts.unionByName(extra, allowMissingColumns=True), row, drop_expired_at, keep_deleted, combine)


def exploded(rows: DataFrame, row: tuple[str, ...] = ROW) -> DataFrame:
    """Rows in long form again, one line a column; rows without columns are left out."""
    return rows.select(*row, F.explode("columns").alias("c")).select(*row, "c.*")


def row_text(columns: Column | str = "columns") -> Column:
    """name=value of all columns in order, parted by commas."""
    return F.array_join(F.transform(columns, lambda c: F.concat(c["name"], F.lit("="), c["value"].cast("string"))), ",")
