"""Repeated runs of lines by a suffix array over line ids; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import apart, discard, store

LEAST_WORDS = 50
BROADCAST_POSITIONS = 2_000_000


def text_mark(text: str | Column = "text") -> Column:
    """Tells rows that repeat a ``doc_id`` with other texts apart."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


#: Characters of scripts that are written without spaces between words.
UNSPACED = "[\\u0e00-\\u0eff\\u1000-\\u109f\\u1780-\\u17ff\\u3040-\\u30ff\\u3400-\\u4dbf\\u4e00-\\u9fff\\uf900-\\ufaff]"


def words_in(line: Column) -> Column:
    """Number of parts between white space, and of characters of scripts without spaces, each of which counts as a word."""
    parts = F.size(F.array_remove(F.split(F.translate(line, "\t\x0b\x0c\r", "    "), " "), ""))
    # such a character takes three bytes, so lines of letters of two at most need no search
    wide = F.octet_length(line) >= F.length(line) + 2
    return parts + F.when(wide, F.regexp_count(line, F.lit(UNSPACED))).otherwise(0)


def _lines(docs: DataFrame) -> DataFrame:
    """``doc, mark, pos, l1, l2, w``: every line as a 128-bit hash, and its words."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), text_mark().alias("mark"), F.col("text").cast("string").alias("text"))
    each = texts.where("doc IS NOT NULL AND text IS NOT NULL").select("doc", "mark", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return each.select("doc", "mark", "pos", F.xxhash64("line").alias("l1"), F.xxhash64(F.lit(1), F.reverse("line")).alias("l2"),
                       words_in(F.col("line")).cast("long").alias("w"))


def _ranked(pairs: DataFrame, first: str, second: str) -> DataFrame:
    """Pairs that occur more than once, with a rank ``new`` in the order of the pairs; ready for a join on ``k1``, ``k2``."""
    repeated = pairs.groupBy(first, second).agg(F.count("*").alias("n")).where("n > 1")
    ordered = repeated.orderBy(first, second).select(first, second, F.monotonically_increasing_id().alias("new"))
    return ordered.select(apart(first).alias("k1"), F.col(second).alias("k2"), "new")


def repeated_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc, mark, pos, rank, w, island, at``: lines that occur more than once, as ids in the order of the line hashes.

    Consecutive ones form an island; islands of fewer than ``least_words`` words are left out, since a repeated
    run and its copies lie inside islands. ``at`` counts the words before the line in its island.
    """
    lines = _lines(docs)
    ids = _ranked(lines, "l1", "l2")
    named = lines.join(ids, (F.col("l1") == F.col("k1")) & (F.col("l2") == F.col("k2"))).select("doc", "mark", "pos", F.col("new").alias("rank"), "w")
    by_doc = Window.partitionBy("doc", "mark").orderBy("pos")
    # rows equal in id and text are one document: each of its lines counts once
    islands = named.withColumn("island", F.col("pos") - F.dense_rank().over(by_doc)).withColumn(
        "again", F.col("pos").eqNullSafe(F.lag("pos").over(by_doc))).where("NOT again").drop("again")
    one = Window.partitionBy("doc", "mark", "island")
    sized = islands.withColumn("total", F.sum("w").over(one)).where(F.col("total") >= least_words).drop("total")
    until = one.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return sized.withColumn("at", F.coalesce(F.sum("w").over(until), F.lit(0)).cast("long"))


def suffix_ranks(lines: DataFrame, longest: int) -> list[tuple[DataFrame, str]]:
    """Ranks of runs of 1, 2, 4, ... lines up to ``longest``, as stored tables ``doc, mark, pos, rank``.

    Prefix doubling: a run of 2n lines is a pair of runs of n, and pairs are ranked in sorted order, so the last
    table orders the suffixes by their first lines. Only runs that occur more than once go on: all others are
    unique whatever follows. Each table is grouped before it is joined, so a frequent run is split over tasks.
    """
    tables = [store(lines.select("doc", "mark", "pos", "rank"), "ranks")]
    step = 1
    while 2 * step <= longest:
        after = Window.partitionBy("doc", "mark").orderBy("pos").rangeBetween(step, step)
        pairs = tables[-1][0].withColumn("next", F.first("rank").over(after)).where("next IS NOT NULL")
        ids = _ranked(pairs, "rank", "next")
        doubled = pairs.join(ids, (F.col("rank") == F.col("k1")) & (F.col("next") == F.col("k2"))).select(
            "doc", "mark", "pos", F.col("new").alias("rank"))
        tables.append(store(doubled, "ranks"))
        step *= 2
    return tables


def _shortest_runs(lines: DataFrame, least_words: int) -> DataFrame:
    """``doc, mark, start, size``: for every line the shortest run of enough words that begins, and that ends, with it."""
    keys = ["doc", "mark", "island"]
    ends = lines.select(*keys, (F.col("at") + F.col("w")).alias("key"), (F.col("pos") + 1).alias("end"), F.lit(None).cast("int").alias("ask"))
    forward = ends.union(lines.select(*keys, (F.col("at") + least_words).alias("key"), F.lit(None).cast("int").alias("end"), F.col("pos").alias("ask")))
    # Word counts descending, ends before questions: the last end seen is the nearest one with enough words.
    order = Window.partitionBy(*keys).orderBy(F.desc("key"), F.col("ask").isNotNull(), F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    forward = forward.withColumn("to", F.last("end", ignorenulls=True).over(order)).where("ask IS NOT NULL AND to IS NOT NULL").select(
        "doc", "mark", F.col("ask").alias("start"), (F.col("to") - F.col("ask")).alias("size"))
    starts = lines.select(*keys, F.col("at").alias("key"), F.col("pos").alias("begin"), F.lit(None).cast("int").alias("ask"))
    backward = starts.union(lines.select(*keys, (F.col("at") + F.col("w") - least_words).alias("key"), F.lit(None).cast("int").alias("begin"), F.col("pos").alias("ask")))
    order = Window.partitionBy(*keys).orderBy("key", F.col("ask").isNotNull(), "begin").rowsBetween(Window.unboundedPreceding, 0)
    backward = backward.withColumn("from", F.last("begin", ignorenulls=True).over(order)).where("ask IS NOT NULL AND from IS NOT NULL").select(
        "doc", "mark", F.col("from").alias("start"), (F.col("ask") + 1 - F.col("from")).alias("size"))
    return forward.union(backward).where("size > 0").distinct()


def later_copies(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc, mark, pos``: lines inside a run of at least ``least_words`` words whose lines also occur, in order, earlier.

    Earlier means at a smaller (doc_id, text hash, line number). The suffixes that share the lines of a run form
    one interval of the suffix array, the longest-common-prefix interval of its length; it is named by the ranks of
    the two runs of 2**k lines that cover it, its first member is the first copy, all others are later ones.
    A line of a longest repeated run is inside a shortest run of enough words that begins at the run's first line
    or ends at the line itself, so shortest runs in both directions cover exactly all longest ones.
    """
    spark = docs.sparkSession
    lines, lines_path = store(repeated_lines(docs, least_words), "lines")
    runs, runs_path = store(_shortest_runs(lines, least_words), "runs")
    longest = runs.agg(F.max("size")).first()[0] or 0
    tables = suffix_ranks(lines, longest)
    ranks = None
    for k, (one, _) in enumerate(tables):
        part = one.select(F.lit(k).alias("k"), "doc", "mark", "pos", "rank")
        ranks = part if ranks is None else ranks.union(part)
    level = F.floor(F.log2(F.col("size") + F.lit(0.5))).cast("int")
    asked = runs.withColumn("k", level).withColumn("pos", F.col("start"))
    asked = asked.join(ranks, ["k", "doc", "mark", "pos"]).select(
        "k", "doc", "mark", "start", "size", F.col("rank").alias("head"),
        (F.col("start") + F.col("size") - F.pow(F.lit(2.0), F.col("k")).cast("int")).alias("pos"))
    named = asked.join(ranks, ["k", "doc", "mark", "pos"]).select("doc", "mark", "start", "size", "head", F.col("rank").alias("tail"))
    named, named_path = store(named, "named-runs")
    place = F.struct("doc", "mark", "start")
    first = named.groupBy("head", "tail", "size").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(apart("head").alias("h"), F.col("tail").alias("t"), F.col("size").alias("s"), "first")
    copies = named.join(first, (F.col("head") == F.col("h")) & (F.col("tail") == F.col("t")) & (F.col("size") == F.col("s"))).where(
        place > F.col("first"))
    cover = copies.groupBy("doc", "mark", "start").agg(F.max("size").alias("size"))
    found, _ = store(_covered(cover), "later-copies")
    discard(spark, lines_path, runs_path, named_path, *(p for _, p in tables))
    return found


def _covered(cover: DataFrame) -> DataFrame:
    """Positions of overlapping ranges, each once: what a range adds to those that begin before it."""
    before = Window.partitionBy("doc", "mark").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = cover.withColumn("done", F.max(F.col("start") + F.col("size")).over(before)).select(
        "doc", "mark", F.greatest("start", F.coalesce("done", "start")).alias("a"), (F.col("start") + F.col("size") - 1).alias("b"))
    return fresh.where("a <= b").select("doc", "mark", F.explode(F.sequence("a", "b")).alias("pos"))


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` with ``text`` rebuilt without the lines ``removed(doc, mark, pos)``, and ``n_lines``, ``n_removed``.

    While the positions are few they go to every task and texts stay where they are; otherwise documents are
    exchanged by id. Line numbers are subtracted as sets, so a long document costs in proportion to its lines.
    """
    few = removed.count() <= BROADCAST_POSITIONS
    gone = removed.groupBy("doc", "mark").agg(F.collect_list("pos").alias("__gone")).withColumnsRenamed({"doc": "__doc", "mark": "__mark"})
    joined = docs.join(F.broadcast(gone) if few else gone, (docs["doc_id"].cast("long") == F.col("__doc")) & (text_mark(docs["text"]) == F.col("__mark")), "left")
    lines = F.split(docs["text"], "\n")
    count = F.when(docs["text"].isNull(), 0).otherwise(F.size(lines))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    rest = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    text = F.when(F.col("__gone").isNull(), docs["text"]).otherwise(rest)
    own = [text.alias("text") if c == "text" else docs[c] for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(*own, count.alias("n_lines"), F.coalesce(F.size("__gone"), F.lit(0)).alias("n_removed"))


def deduplicate_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs(doc_id, text, ...)`` with later copies of repeated line runs deleted, ``n_lines`` and ``n_removed``.

    Lines lie between line feeds; words between white space, characters of scripts without spaces count as words. See ``later_copies`` for what is deleted; runs may also
    repeat inside a document. A text whose every line goes is empty. Null texts have no lines and stay null; a
    null ``doc_id`` has no place in the order, its text stays; rows equal in id and text are one document and
    are treated alike. All other columns pass through; ``n_lines`` and ``n_removed`` of the input are replaced.
    """
    return without_lines(docs, later_copies(docs.select("doc_id", "text"), least_words))
