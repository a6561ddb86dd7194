"""Lookup tables whose size is known before a row is joined with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import output_dir, write_table

BROADCAST_ROWS_KEY = "chronofit.broadcast_rows"
DEFAULT_BROADCAST_ROWS = 2_000_000


def broadcast_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(BROADCAST_ROWS_KEY, str(DEFAULT_BROADCAST_ROWS)))


def stored_table(table: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``table`` written to the shared folder, and its rows."""
    stored = write_table(table, output_dir(table.sparkSession, name))
    return stored, stored.count()


def counted_lookup(table: DataFrame, name: str) -> DataFrame:
    """``table`` written and counted: broadcast up to ``chronofit.broadcast_rows`` rows.

    Joining rows with a few-valued key (equipment, fold, city) by a shuffle would send a
    third of them to one task; beyond the bound the key has many values and a shuffle
    join with skew handling is right.
    """
    stored, n = stored_table(table, name)
    return F.broadcast(stored) if n <= broadcast_rows(stored) else stored
