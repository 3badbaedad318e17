"""Rows as delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "NULL"
# File size the row estimate aims at.
BLOCK_BYTES = 128_000_000


def csv_line(columns: Sequence[str]) -> Column:
    """One unquoted line per row; nulls keep their place as the null token."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in columns])


def fields(line: Column) -> Column:
    """Fields of an unquoted line, empty ones included."""
    return F.split(line, ",", -1)
