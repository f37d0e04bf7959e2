"""Links between members of shared buckets, without pairing a bucket with itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import apart, connected_components, discard, store

PAIRS_PER_ROW = 4


def linked_components(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], smallest_share: float,
                      hub_rounds: int = 8) -> DataFrame:
    """``buckets(h long, id long, n long, ahead long, score double)`` -> ``(node, component)`` of the links that ``verify`` confirms.

    ``n`` is the size of a member's set and ``ahead`` how many of its values come before ``h`` in a common order of
    all values, so two members whose first common value is ``h`` share at most the smaller of their ``n - ahead``. Equal to verifying every pair of members of a bucket that can
    reach ``smallest_share`` by this bound, and taking components; but a pair inside one component need not be
    looked at. In each round every bucket that still spans several components gets one hub, at first the member of highest
    ``score`` (its values are the commonest), then another one, the same in as many buckets as possible, and its members outside the hub's component are compared with the hub: as many pairs as rows. Rounds end when
    what is left has at most ``PAIRS_PER_ROW`` pairs a row, when a round settles less than a third of the pairs, or
    after ``hub_rounds``; all pairs across components that are left and were not compared yet are then compared.
    So no link is lost whatever the buckets.
    ``verify`` takes distinct pairs ``(a long, b long)`` with a < b and returns the linked ones; members of a bucket
    are distinct.
    """
    spark = buckets.sparkSession
    rows, rows_path = store(buckets.select("h", "id", "n", "ahead", "score"), "buckets")
    scratch, links, tested, labels, before = [rows_path], [], [], None, 0

    for turn in range(hub_rounds + 1):
        if labels is None:
            live, sizes = rows.withColumn("c", F.col("id")), rows.groupBy("h").agg(F.count("*").alias("all")).withColumn("inside", F.col("all"))
        else:
            live, live_path = store(_live(rows, labels), "live")
            scratch.append(live_path)
            sizes = live.groupBy("h", "c").agg(F.count("*").alias("k")).groupBy("h").agg(
                F.sum("k").alias("all"), F.sum(F.col("k") * F.col("k")).alias("inside"))
        left = sizes.agg(F.sum("all").alias("rows"), F.sum((F.col("all") * F.col("all") - F.col("inside")) / 2).alias("pairs")).first()
        if not left["rows"]:
            break
        last = turn == hub_rounds or left["pairs"] <= PAIRS_PER_ROW * left["rows"] or (turn and left["pairs"] > 0.67 * before)
        before = left["pairs"]
        pairs = _across(live, smallest_share) if last else _with_hub(live, smallest_share, turn)
        pairs = pairs.distinct()
        for done in tested:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs, path = store(pairs, "pairs")
        scratch.append(path)
        tested.append(pairs)
        found, path = store(verify(pairs), "links")
        scratch.append(path)
        links.append(found)
        every = links[0]
        for more in links[1:]:
            every = every.union(more)
        labels = connected_components(every)
        if last:
            break
    if labels is None:
        labels = spark.createDataFrame([], "node long, component long")
    labels, _ = store(labels, "components")
    discard(spark, *scratch)
    return labels


def _live(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of buckets that span several components, with the component as ``c``."""
    named = rows.join(
        labels.withColumnRenamed("node", "id"), "id", "left").select(
        "h", "id", "n", "ahead", "score", F.coalesce("component", "id").alias("c"))
    several = named.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    return named.join(several.select(apart("h").alias("k")), F.col("h") == F.col("k"), "left_semi")


def _fits(share: float):
    shared = F.least(F.col("n") - F.col("ahead"), F.col("m") - F.col("other_ahead"))
    return shared + 1e-6 >= share * (F.col("n") + F.col("m") - shared)


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _with_hub(live: DataFrame, share: float, turn: int) -> DataFrame:
    order = (-F.col("score") if not turn else F.xxhash64("id", F.lit(turn)).cast("double")).alias("r")
    hub = live.groupBy("h").agg(F.min(F.struct(order, F.col("id").alias("hub"), F.col("c").alias("hc"), F.col("n").alias("m"),
                                               F.col("ahead").alias("other_ahead"))).alias("s"))
    hub = hub.select(apart("h").alias("k"), "s.hub", "s.hc", "s.m", "s.other_ahead")
    return live.join(hub, F.col("h") == F.col("k")).where((F.col("c") != F.col("hc")) & _fits(share)).select(*_pair("id", "hub"))


def _across(live: DataFrame, share: float) -> DataFrame:
    other = live.select(F.col("h").alias("k"), F.col("id").alias("other"), F.col("c").alias("hc"), F.col("n").alias("m"),
                        F.col("ahead").alias("other_ahead"))
    return live.join(other, (F.col("h") == F.col("k")) & (F.col("id") < F.col("other")) & (F.col("c") != F.col("hc"))
                     & _fits(share)).select(*_pair("id", "other"))
