"""Duplicate codes and the preparation of rows for resolving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.functions.text import (
    add_note, blank, build_search_key, drop_note, normalize_code, normalize_name)


def duplicate_codes(rows: DataFrame, code: str = "品番") -> DataFrame:
    """Normalised non-blank codes that occur more than once."""
    return (rows.select(normalize_code(code).alias("code")).filter(F.col("code") != "")
            .groupBy("code").agg(F.count("*").alias("times")).filter(F.col("times") > 1))


def flag_duplicate_codes(rows: DataFrame) -> DataFrame:
    """Normalise code and name, build the search key, set or clear the duplicate remark.

    Duplicates are counted by aggregation and joined back, not by a window: one code
    may stand in any share of the rows. The joined side has one row per duplicated code.
    """
    code, name = normalize_code("品番"), normalize_name("名前")
    clean = (rows.withColumn("品番", code).withColumn("名前", name)
             .withColumn("検索キー", build_search_key("品番", "名前")))
    dups = (clean.filter(F.col("品番") != "").groupBy("品番").agg(F.count("*").alias("_times"))
            .filter(F.col("_times") > 1))
    note = (F.when(F.col("_times").isNotNull(), add_note("備考", V.NOTE_DUPLICATE_CODE))
            .otherwise(drop_note("備考", V.NOTE_DUPLICATE_CODE)))
    # blank codes are no duplicates: they go around the join, where they would meet under one key
    joined = clean.filter(F.col("品番") != "").join(dups, "品番", "left").withColumn("備考", note).select(*clean.columns)
    blank_codes = clean.filter(F.coalesce(F.col("品番"), F.lit("")) == "").withColumn("備考", drop_note("備考", V.NOTE_DUPLICATE_CODE))
    return joined.unionByName(blank_codes)


def unresolved(rows: DataFrame) -> DataFrame:
    """Rows that have a search key and no url yet."""
    return rows.filter((F.trim(blank("product_url")) == "") & (blank("検索キー") != ""))


def resolved(rows: DataFrame) -> DataFrame:
    return rows.filter(F.trim(blank("product_url")) != "")


def apply_resolution(rows: DataFrame, results: DataFrame, resolved_at) -> DataFrame:
    """Write search results back: hits set url and time and drop the no-hit remark, misses add it.

    ``results`` has one row per searched key: 検索キー, link (null or "" for a miss).
    """
    searched = results.select("検索キー", blank("link").alias("_link"))
    # every row of a result carries its marker: a left join alone cannot tell "miss" from "not searched"
    # only open rows with a search key can match; the others go around the join
    can = (F.trim(blank("product_url")) == "") & (blank("検索キー") != "")
    joined = rows.filter(can).join(searched.filter(blank("検索キー") != ""), "検索キー", "left")
    open_row = (F.trim(blank("product_url")) == "") & F.col("_link").isNotNull()
    hit = open_row & (F.col("_link") != "")
    written = joined.select(*[
        F.when(hit, F.col("_link")).otherwise(F.col("product_url")).alias(c) if c == "product_url"
        else F.when(hit, resolved_at).otherwise(F.col("解決日時")).alias(c) if c == "解決日時"
        else (F.when(hit, drop_note("備考", V.NOTE_NO_HIT)).when(open_row, add_note("備考", V.NOTE_NO_HIT))
              .otherwise(F.col("備考")).alias(c)) if c == "備考"
        else F.col(c)
        for c in rows.columns])
    return written.unionByName(rows.filter(~can))
