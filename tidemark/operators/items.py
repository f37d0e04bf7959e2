"""Item de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import blank

ITEM_IDENTITY = ("name", "grade", "price", "image_url")


def drop_blank_items(items: DataFrame) -> DataFrame:
    """Keep items that have a name or a price."""
    return items.filter((blank("name") != "") | (blank("price") != ""))


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in the given order.

    An aggregation, so copies collapse before the shuffle however many there are.
    """
    rest = [c for c in rows.columns if c not in keys]
    ordered = [*order, *[c for c in rest if c not in order]]
    first = F.min(F.struct(*ordered)).alias("_first")
    return rows.groupBy(*keys).agg(first).select(
        *[F.col(c) if c in keys else F.col(f"_first.`{c}`").alias(c) for c in rows.columns])


def dedup_items(items: DataFrame, order: Sequence[str] = ("page", "pos")) -> DataFrame:
    """One row per name, grade, price and image: the first seen. Stock and status do not count."""
    return first_per_key(items, ITEM_IDENTITY, order)
