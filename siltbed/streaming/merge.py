"""Streams of cells: last write wins as they come in, and loading new rows batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.operators import reconcile
from siltbed.operators.sink import TableTarget


def latest_of_stream(cells: DataFrame, row: tuple[str, ...] = reconcile.ROW) -> DataFrame:
    """The newest version of each cell so far (output mode update or complete).

    Which version wins depends on its own ts, not on when it comes in, so late cells need no watermark; the state is one
    version for each cell.
    """
    return reconcile.latest(cells, row)


def load_stream(rows: DataFrame, target: TableTarget, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """Load a stream of rows create-only: each batch adds the rows whose key the target lacks.

    A batch that runs again after a failure finds its rows there, so every key is written once.
    """

    def load(batch: DataFrame, number: int) -> None:
        target.load(prepare(batch) if prepare else batch)

    return rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)


def expire_stream(rows: DataFrame, now: F.Column | None = None) -> DataFrame:
    """Rows of a stream that have not expired when they come in; by default the clock says when that is."""
    at = now if now is not None else F.unix_timestamp(F.current_timestamp())
    return rows.where(F.col("expiry").isNull() | (F.col("expiry") > at))
