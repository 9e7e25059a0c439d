"""Broadcasting behind a check of size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Thin rows (a key or two) up to this many are broadcast; more are joined by shuffling.
BROADCAST_ROWS = 500_000


def few(keys: DataFrame) -> DataFrame:
    """``keys`` (read from storage), to be broadcast where a count of its rows allows it."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
