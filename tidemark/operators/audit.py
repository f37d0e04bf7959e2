"""Completeness, extraction failures, pattern coverage, JSON shapes, robots rules."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed_values as V
from tidemark.functions.text import blank
from tidemark.functions.urls import host_of, path_of
from tidemark.session import ship_package
from tidemark.sources.rowwise import expand_text


def completeness_audit(items: DataFrame, declared: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct items against declared totals per source; no or zero total means no check."""
    seen = items.groupBy(*by).agg(F.count("*").alias("items"))
    total = declared.groupBy(*by).agg(F.max("declared").alias("declared"))
    joined = total.join(seen, list(by), "left").withColumn("items", F.coalesce("items", F.lit(0)))
    checked = F.coalesce(F.col("declared") > 0, F.lit(False))
    return (joined.withColumn("checked", checked)
            .withColumn("short", checked & (F.col("items") < F.col("declared"))))


def extraction_failures(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """Rows without any value, and whether that is all of them."""
    nothing = F.lit(True)
    for v in values:
        nothing = nothing & (blank(F.col(f"`{v}`")) == "")
    return rows.agg(F.count("*").alias("rows"), F.count_if(nothing).alias("failed")).withColumn(
        "all_failed", (F.col("rows") > 0) & (F.col("failed") == F.col("rows")))


def pattern_coverage(pages: DataFrame, patterns: Mapping[str, Sequence[str]], text: str) -> DataFrame:
    """Per pattern: pages hit, hits and the least sample.

    All patterns are applied to a page in one pass; the few results per page are summed
    before the shuffle.
    """
    tests = [F.struct(F.lit(label).alias("label"), F.lit(no).alias("pattern_no"), F.lit(p).alias("pattern"),
                      F.regexp_extract_all(blank(text), F.lit(p), F.lit(0)).alias("found"))
             for label, listed in patterns.items() for no, p in enumerate(listed)]
    each = pages.select(F.explode(F.array(*tests)).alias("t")).select("t.*")
    return (each.groupBy("label", "pattern_no", "pattern")
            .agg(F.count("*").alias("pages"), F.count_if(F.size("found") > 0).alias("pages_hit"),
                 F.sum(F.size("found")).cast("bigint").alias("hits"),
                 F.min(F.array_min("found")).alias("sample")))


_SCALARS = {"BIGINT": "int", "DOUBLE": "float", "STRING": "str", "BOOLEAN": "bool", "VOID": "NoneType"}


def _shape(text: Column, depth: int, shown: int | None) -> Column:
    if depth > 2:
        return F.lit("...")
    keys = F.json_object_keys(text)
    some = F.array_join(keys if shown is None else F.slice(keys, 1, shown), ", ")
    more = F.lit("}") if shown is None else F.when(F.size(keys) > shown, "...}").otherwise("}")
    size = F.json_array_length(text)
    first = F.to_json(F.try_variant_get(F.try_parse_json(text), "$[0]", "variant"))
    head = F.when(size > 0, _shape(first, depth + 1, shown)).otherwise("")
    kind = F.schema_of_variant(F.try_parse_json(text))
    scalar = F.when(kind.startswith("DECIMAL"), "float")
    for spark_name, name in _SCALARS.items():
        scalar = F.when(kind == spark_name, name).otherwise(scalar)
    return (F.when(kind.startswith("OBJECT"), F.concat(F.lit("{"), some, more))
            .when(kind.startswith("ARRAY"), F.concat(F.lit("["), size.cast("string"), F.lit("件 "), head, F.lit("]")))
            .otherwise(scalar))


def json_shape(c: Column | str, shown: int | None = None) -> Column:
    """Shape of a JSON text at a glance: keys, array sizes, types; null for bad JSON.

    ``shown`` shortens the list of keys for display; shapes are then equal by what is shown.
    """
    return _shape(F.col(c) if isinstance(c, str) else c, 0, shown)


def json_shape_profile(docs: DataFrame, json: str, shown: int | None = None) -> DataFrame:
    return (docs.select(json_shape(json, shown).alias("shape")).groupBy("shape")
            .agg(F.count("*").alias("documents")))


def _cut(structure: str | None, depth: int) -> str | None:
    """A structure with the types inside ``depth`` brackets, and all below them, as dots."""
    out, level = [], 0
    for piece in re.split("([<>])", structure or ""):
        level -= piece == ">"
        if level < depth:
            out.append(piece)
        elif level == depth and piece not in "<>":
            out.append(re.sub(r"(^|: )[A-Z]+(?:\([0-9,]*\))?", r"\1...", piece))
        level += piece == "<"
    return None if structure is None else "".join(out)


def json_structure(c: Column | str) -> Column:
    """Whole nested structure of a JSON text, to any depth; null for bad JSON."""
    return F.schema_of_variant(F.try_parse_json(F.col(c) if isinstance(c, str) else c))


def json_structure_profile(docs: DataFrame, json: str, depth: int | None = None) -> DataFrame:
    """Documents per nested structure: structure, documents. ``depth`` shows deeper parts as dots.

    Documents are counted by their whole structure first, so only distinct structures are cut.
    """
    counted = docs.select(json_structure(json).alias("structure")).groupBy("structure").agg(F.count("*").alias("documents"))
    if depth is None:
        return counted
    ship_package(docs.sparkSession)

    @F.pandas_udf("string")
    def shorter(structures: pd.Series) -> pd.Series:
        return structures.map(lambda s: _cut(s, depth))

    return counted.select(shorter("structure").alias("structure"), "documents").groupBy("structure").agg(F.sum("documents").alias("documents"))


def json_common_structure(docs: DataFrame, json: str, by: Sequence[str] = ()) -> DataFrame:
    """The structure that holds all documents of a group, merged before the shuffle: by, structure, documents.

    Where documents disagree the merged structure says VARIANT.
    """
    parsed = docs.select(*by, F.try_parse_json(json).alias("_v"))
    return parsed.groupBy(*by).agg(F.schema_of_variant_agg("_v").alias("structure"), F.count("_v").alias("documents"))


_RULES = T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("allow", T.BooleanType())]))


def _parsed_rules(agent: str):
    def rules_for(parser: RobotFileParser, name: str):
        for entry in parser.entries:
            if entry.applies_to(name):
                return entry
        return parser.default_entry

    def expand(text: str):
        parser = RobotFileParser()
        parser.parse(text.splitlines())
        yield tuple([(line.path, bool(line.allowance)) for line in entry.rulelines] if entry else []
                    for entry in (rules_for(parser, agent), rules_for(parser, "*")))
    return expand


def robots_rules(robots: DataFrame, agent: str, host: str = "host", text: str = "robots_txt") -> DataFrame:
    """Per host the ordered rules that apply to ``agent`` and to everyone. One file is one row."""
    out = T.StructType([T.StructField("own_rules", _RULES), T.StructField("any_rules", _RULES)])
    return expand_text(robots.filter(F.col(text).isNotNull()), text, [host], out, _parsed_rules(agent))


def _decides(rules: str, path: Column) -> Column:
    """Allowance of the first rule in file order that matches; none matching allows."""
    hit = F.filter(rules, lambda r: (r["path"] == "*") | path.startswith(r["path"]))
    return F.coalesce(F.get(hit, F.lit(0))["allow"], F.lit(True))


def robots_filter(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add ``allowed``: false if the agent's or the general rules deny, null without rules.

    The rules side has one row per host, so a host that owns a third of all urls is split
    by the skew join; nothing is gathered per host.
    """
    rules = rules.withColumnRenamed("host", "_host")
    joined = urls.withColumn("_host", host_of(url)).withColumn("_path", path_of(url)).join(rules, "_host", "left")
    path = F.col("_path")
    allowed = F.when(F.col("any_rules").isNotNull(), _decides("own_rules", path) & _decides("any_rules", path))
    return joined.withColumn("allowed", allowed).drop("_host", "_path", "own_rules", "any_rules")


def may_read(flags: DataFrame) -> DataFrame:
    """Unknown counts as allowed."""
    return flags.filter(F.coalesce("allowed", F.lit(True)))
