"""Ranked matching of a watch list against a catalogue, and target planning.

Rules, strongest first: id from a URL or equal id 100, equal code 90, equal name
80, name starts with 60, name contains 40, code contains 30.

None of this compares every query with every card. Cards are first reduced to
their distinct (code, name) pairs with a count and the best card, so any number
of copies of a card costs one row. Equality rules are hash joins. "Contains" is
an equality join too: a text can only contain a query if it contains each short
substring (gram) of it, so each query is looked up under its rarest gram and the
few candidates are then tested in full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.functions.text import (
    blank, compact_name, normalize_code, normalize_name, strip)
from tidemark.functions.urls import slug_from_url
from tidemark.operators.series import last_n, series_metrics
from tidemark.operators.trend import TrendLimits, with_trend
from tidemark.session import materialized

GRAM = 3


def _grams(text: Column, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.when(F.length(text) >= size,
                  F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))
                  ).otherwise(F.array().cast("array<string>"))


def substring_join(queries: DataFrame, texts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All pairs (q, text) in which the text contains q, within equal ``by`` columns.

    Exact, by equality joins only: each query is looked up under its rarest gram. Blanks
    match nothing. ``queries`` has the column q, ``texts`` the column text.
    """
    by = list(by)
    queries = queries.filter(F.col("q") != "").select(*by, "q").distinct()
    texts = texts.filter(F.col("text") != "").select(*by, "text").distinct()
    # grams carry the number of a text, not the text: what is exchanged grows with the length of texts, not its square
    numbered = texts.withColumn("_tid", F.xxhash64(*by, "text"))
    sizes = [_grams(F.col("text"), size) for size in range(1, GRAM + 1)]
    text_grams = numbered.select(*by, "_tid", F.explode(F.array_distinct(F.concat(*sizes))).alias("gram"))
    by_size = F.lit(None).cast("array<string>")
    for size in range(1, GRAM + 1):
        at_size = (F.length("q") >= size) if size == GRAM else (F.length("q") == size)
        by_size = F.when(at_size, _grams(F.col("q"), size)).otherwise(by_size)
    query_grams = queries.select(*by, "q", F.explode(F.array_distinct(by_size)).alias("gram"))
    wanted = query_grams.select(*by, "gram").distinct()
    spread = text_grams.join(wanted, [*by, "gram"], "left_semi").groupBy(*by, "gram").count()
    rarest = (query_grams.join(spread, [*by, "gram"], "left").groupBy(*by, "q")
              .agg(F.min_by("gram", F.struct(F.coalesce("count", F.lit(0)), "gram")).alias("gram")))
    # equal numbers of different texts only bring a text along that is tested like the others
    held = text_grams.join(rarest, [*by, "gram"]).select(*by, "_tid", "q").distinct()
    return (held.join(numbered, [*by, "_tid"])
            .filter(F.contains(F.col("text"), F.col("q"))).select(*by, "q", "text"))


def overlapping_names(left: DataFrame, right: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pairs (a, b) of compact names of which one contains the other, within equal ``by`` columns.

    ``left`` has the column a, ``right`` the column b. Only pairs that may overlap are formed.
    """
    by = list(by)
    a_as = lambda name: left.select(*by, F.col("a").alias(name))
    b_as = lambda name: right.select(*by, F.col("b").alias(name))
    b_holds_a = substring_join(a_as("q"), b_as("text"), by).select(*by, F.col("q").alias("a"), F.col("text").alias("b"))
    a_holds_b = substring_join(b_as("q"), a_as("text"), by).select(*by, F.col("text").alias("a"), F.col("q").alias("b"))
    return b_holds_a.unionByName(a_holds_b).distinct()


def _prepared_cards(cards: DataFrame) -> DataFrame:
    return cards.select(
        "card_id", "card_name", "hinban", "url", "seq",
        strip(blank("card_id")).alias("_cid"), normalize_code("hinban").alias("_code"),
        F.lower(normalize_name("card_name")).alias("_name"))


def _prepared_queries(queries: DataFrame) -> DataFrame:
    q = strip(blank("query"))
    is_url = F.contains(q, F.lit("/")) & F.contains(q, F.lit("://"))
    return (queries.select("query", q.alias("_q")).filter(F.col("_q") != "").distinct()
            .withColumn("_qcode", normalize_code("_q"))
            .withColumn("_qname", F.lower(normalize_name("_q")))
            .withColumn("_qslug", F.when(is_url, slug_from_url("_q")).otherwise("")))


def _text_score() -> Column:
    code, name, qcode, qname = (F.col(c) for c in ("_code", "_name", "_qcode", "_qname"))
    return (F.when((code != "") & (code == qcode), 90)
            .when((name != "") & (name == qname), 80)
            .when((name != "") & (qname != "") & name.startswith(qname), 60)
            .when((name != "") & (qname != "") & F.contains(name, qname), 40)
            .when((code != "") & (qcode != "") & F.contains(code, qcode), 30)
            .otherwise(0))


def _is_id_hit() -> Column:
    cid = F.col("_cid")
    return (cid != "") & ((cid == F.col("_qslug")) | (F.lower(cid) == F.lower(F.col("_q"))))


def _id_hits(queries: DataFrame, cards: DataFrame) -> DataFrame:
    """Cards named by id or by the id inside a URL; two equality joins, no pair twice."""
    wanted = (queries.withColumn("_ref", F.explode(F.array_distinct(
        F.array(F.lower("_q"), F.lower("_qslug"))))).filter(F.col("_ref") != ""))
    return (cards.withColumn("_ref", F.lower("_cid")).filter(F.col("_ref") != "")
            .join(wanted, "_ref").filter(_is_id_hit()).drop("_ref")
            .dropDuplicates(["query", "seq", "card_id"]))


def _card_groups(cards: DataFrame) -> DataFrame:
    first = F.min(F.struct(blank("card_name").alias("card_name"), "seq", "card_id", "url"))
    return (cards.groupBy("_code", "_name")
            .agg(F.count("*").alias("_cards"), first.alias("_first")))


def _text_hits(queries: DataFrame, groups: DataFrame) -> DataFrame:
    """(query, card group) pairs with a score; each pair comes from exactly one branch."""
    same_code = (queries.join(groups, queries["_qcode"] == groups["_code"])
                 .withColumn("_score", _text_score()).filter(F.col("_score") == 90))
    names = substring_join(queries.select(F.col("_qname").alias("q")),
                           groups.select(F.col("_name").alias("text")))
    by_name = (names.join(queries, names["q"] == queries["_qname"])
               .join(groups, names["text"] == groups["_name"]).drop("q", "text")
               .withColumn("_score", _text_score()).filter(F.col("_score").isin(80, 60, 40)))
    codes = substring_join(queries.select(F.col("_qcode").alias("q")),
                           groups.select(F.col("_code").alias("text")))
    by_code = (codes.join(queries, codes["q"] == queries["_qcode"])
               .join(groups, codes["text"] == groups["_code"]).drop("q", "text")
               .withColumn("_score", _text_score()).filter(F.col("_score") == 30))
    return same_code.unionByName(by_name).unionByName(by_code)


def match_cards(queries: DataFrame, cards: DataFrame) -> DataFrame:
    """Every hit of every query with its score.

    ``queries``: query; ``cards``: card_id, card_name, hinban, url, seq. The rank of a
    hit is its place under ``(score desc, card_name, seq)``; see :func:`top_matches`.
    """
    q, c = _prepared_queries(queries), _prepared_cards(cards)
    hits = _text_hits(q, _card_groups(c)).select("query", "_q", "_qslug", "_code", "_name", "_score")
    by_text = hits.join(c, ["_code", "_name"]).filter(~_is_id_hit())
    columns = ["query", "_score", "card_id", "card_name", "hinban", "url", "seq"]
    by_id = _id_hits(q, c).withColumn("_score", F.lit(100))
    return (by_id.select(*columns).unionByName(by_text.select(*columns))
            .withColumnRenamed("_score", "score"))


def top_matches(hits: DataFrame, n: int) -> DataFrame:
    """The first ``n`` hits per query; the limit is applied in every task before the shuffle."""
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), blank("card_name"), "seq")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def best_matches(queries: DataFrame, cards: DataFrame, n: int) -> DataFrame:
    """``top_matches`` of ``match_cards`` without forming all hits.

    Each card group has a card before all cards of the groups after it, and all cards of a higher score come first. So
    per query only its first ``n`` groups count, and of each no more cards than places are left.
    """
    q, c = _prepared_queries(queries), _prepared_cards(cards)
    hits = _text_hits(q, _card_groups(c)).select("query", "_q", "_qslug", "_code", "_name", "_score", "_cards", "_first")
    inside = Window.partitionBy("query").orderBy(F.col("_score").desc(), "_first")
    first = hits.withColumn("_place", F.row_number().over(inside)).filter(F.col("_place") <= n)
    score = Window.partitionBy("query").orderBy(F.col("_score").desc())
    higher = F.coalesce(F.sum("_cards").over(score.rangeBetween(Window.unboundedPreceding, Window.currentRow))
                        - F.sum("_cards").over(Window.partitionBy("query", "_score")), F.lit(0))
    same = F.row_number().over(Window.partitionBy("query", "_score").orderBy("_place")) - 1
    open_groups = first.withColumn("_left", F.lit(n) - higher - same).filter(F.col("_left") > 0).drop("_cards", "_first")
    in_group = Window.partitionBy("_code", "_name").orderBy(blank("card_name"), "seq")
    leading = c.withColumn("_turn", F.row_number().over(in_group)).filter(F.col("_turn") <= n)
    by_text = open_groups.join(leading, ["_code", "_name"]).filter((F.col("_turn") <= F.col("_left")) & ~_is_id_hit())
    columns = ["query", "_score", "card_id", "card_name", "hinban", "url", "seq"]
    by_id = _id_hits(q, c).withColumn("_score", F.lit(100))
    found = by_id.select(*columns).unionByName(by_text.select(*columns)).withColumnRenamed("_score", "score")
    return top_matches(found, n)


def resolve_watchlist(watch: DataFrame, master: DataFrame) -> DataFrame:
    """Fill card_id and url of watch rows from the catalogue; rows with an id stay as they are.

    The code is the query, or the name without one. With both, hits whose name also
    overlaps are preferred; if there are none, all hits count. A url typed by hand is kept.
    """
    code, name = F.col("品番"), F.col("名前")
    has_code, has_name = blank(code) != "", blank(name) != ""
    rows = watch.select(
        "*", F.when(has_code, code).otherwise(blank(name)).alias("query"),
        F.when(has_code & has_name, compact_name(name)).otherwise("").alias("_cname"))
    open_rows = rows.filter(blank("card_id") == "").select("query", "_cname").distinct()

    c, q = _prepared_cards(master), _prepared_queries(open_rows)
    rank = lambda score, first: F.struct((-score).alias("order"), first.alias("card"))
    texts = _text_hits(q, _card_groups(c)).select(
        "query", "_name", F.col("_cards").alias("_n"), rank(F.col("_score"), F.col("_first")).alias("_rank"))
    ids = _id_hits(q, c).select(
        "query", "_name",
        # a card that its code or name finds as well is already counted in its group
        F.when(_text_score() > 0, 0).otherwise(1).cast("bigint").alias("_n"),
        rank(F.lit(100), F.struct(blank("card_name").alias("card_name"), "seq", "card_id", "url")).alias("_rank"))
    # hits of a query with the same compact name count as one row from here on; used four times
    hits = materialized(
        texts.unionByName(ids).withColumn("b", compact_name("_name")).groupBy("query", "b")
        .agg(F.sum("_n").alias("_n"), F.min("_rank").alias("_rank")), "hits")
    every = hits.groupBy("query").agg(F.sum("_n").alias("_all"), F.min("_rank").alias("_best_all"))
    pairs = overlapping_names(open_rows.select("query", F.col("_cname").alias("a")), hits.select("query", "b"), ["query"])
    both = (pairs.join(hits, ["query", "b"]).withColumnRenamed("a", "_cname").groupBy("query", "_cname")
            .agg(F.sum("_n").alias("_both"), F.min("_rank").alias("_best_both")))
    chosen = open_rows.join(every, "query").join(both, ["query", "_cname"], "left").select(
        "query", "_cname", F.coalesce("_both", "_all").alias("_hits"),
        F.coalesce("_best_both", "_best_all").alias("_best"))
    best = F.col("_best")["card"]
    is_open, found_one = blank("card_id") == "", F.col("_hits").isNotNull()
    head, tail = V.MEMO_CANDIDATES
    memo = (F.when(is_open & ~found_one, V.MEMO_NOT_FOUND)
            .when(is_open & (F.col("_hits") > 1),
                  F.concat(F.lit(head), F.col("_hits").cast("string"), F.lit(tail)))
            .otherwise(F.col("メモ")))
    out = rows.join(chosen, ["query", "_cname"], "left")
    return out.select(
        *[x for x in watch.columns if x not in ("card_id", "url", "メモ")],
        F.when(is_open & found_one, best["card_id"]).otherwise(F.col("card_id")).alias("card_id"),
        F.when(is_open & found_one & (blank("url") == ""), best["url"]).otherwise(F.col("url")).alias("url"),
        memo.alias("メモ"))


def plan_targets(watch: DataFrame, master: DataFrame, limit: int = 0, crawl_all: bool = False) -> DataFrame:
    """Cards to read: catalogue rows that are watched, then watch rows that only have a url.

    Without a watch list nothing is read unless ``crawl_all`` asks for everything.
    """
    fields = ["card_id", "card_name", "hinban", "url"]
    catalogue = master.select(*fields, F.lit(0).alias("_part"), "seq")
    ids = watch.filter(blank("card_id") != "").select("card_id").distinct()
    by_id = catalogue.join(ids, "card_id", "left_semi")
    typed = watch.filter(blank("url") != "").join(
        master.filter(blank("card_id") != "").select("card_id").distinct(), "card_id", "left_anti")
    by_url = typed.select(
        F.when(blank("card_id") != "", F.col("card_id")).otherwise(slug_from_url("url")).alias("card_id"),
        F.col("名前").alias("card_name"), F.col("品番").alias("hinban"), "url",
        F.lit(1).alias("_part"), "seq")
    targets = by_id.unionByName(by_url)
    if crawl_all and watch.isEmpty():
        targets = catalogue
    targets = targets.filter(blank("url") != "")
    if limit > 0:
        targets = targets.orderBy("_part", "seq").limit(limit)
    return targets.select(*fields, "_part", "seq")


def known_cards(history: DataFrame) -> DataFrame:
    """Distinct cards of a history with the name and code of their first row."""
    first = F.min(F.struct("seq", "card_name", "hinban"))
    return (history.filter(blank("card_id") != "").groupBy("card_id").agg(first.alias("_f"))
            .select("card_id", "_f.card_name", "_f.hinban", F.lit("").alias("url"), F.col("_f.seq").alias("seq")))


def report_hits(history: DataFrame, query: str, hits: int = V.REPORT_HITS) -> DataFrame:
    """The first few cards of a history that a query names."""
    queries = history.sparkSession.createDataFrame([(query,)], "query string")
    return best_matches(queries, known_cards(history), hits).orderBy("rank").drop("rank")


def card_report(history: DataFrame, query: str, hits: int = V.REPORT_HITS, show_days: int = V.SHOW_DAYS,
                limits: TrendLimits = TrendLimits(), seq: Sequence[str] = ("seq",)
                ) -> tuple[DataFrame, DataFrame]:
    """(metrics per hit and condition, last rows per hit and condition) for one query."""
    from tidemark.operators.series import mark_imputed, observed_points

    found = report_hits(history, query, hits).select(
        "card_id", "card_name", F.col("hinban").alias("code"), "score")
    keys = ["card_id", "condition"]
    rows = observed_points(history, keys).join(F.broadcast(found.select("card_id")), "card_id", "left_semi")
    rows = rows.withColumn("condition", blank("condition"))
    metrics = with_trend(series_metrics(rows, keys, seq, trail=V.TRAIL_DAYS), limits)
    summary = metrics.join(F.broadcast(found), "card_id")
    detail = last_n(mark_imputed(rows, keys, seq), keys, show_days)
    return summary, detail
