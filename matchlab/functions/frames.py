"""Array helper of the ranged windows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def last_n(arr: Column, n: int) -> Column:
    """Last ``n`` elements of an array (all of it when shorter)."""
    return F.slice(arr, F.greatest(F.size(arr) - n + 1, F.lit(1)), n)
