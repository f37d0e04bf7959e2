"""Search requests built from unresolved rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.urls import quote


def build_search_requests(rows: DataFrame, templates: Sequence[str], key: str = "検索キー") -> DataFrame:
    """One URL per row and template, in template order; ``{q}`` takes the encoded key."""
    encoded = quote(key)
    urls = F.array(*[F.replace(F.lit(t), F.lit("{q}"), encoded) for t in templates])
    return rows.select("*", F.posexplode(urls).alias("template_no", "url"))
