"""Prefix trie of conversations: shared beginnings, what they save, in balanced parentheses per shard."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import apart, discard, store
from tidemark.llm.ranks import ranked
from tidemark.session import ship_package

#: Nodes of more members are spine nodes; every subtree below the spine lies in one shard.
MEMBERS = 64
#: A shard's trees are encoded together in runs of about so many nodes.
NODES = 50_000
#: Spine nodes up to this count are broadcast, more are joined by exchange.
BROADCAST_ROWS = 100_000
#: Depths are summed in blocks of so many turns.
DEPTHS = 1024
#: Conversations listed together in one piece of a digest.
IDS = 256
HEAD = 9
FAMILY = 5


class Parentheses:
    """Balanced parentheses of a forest in preorder, with a tree of least excess over blocks.

    ``find_close`` descends that tree, ``leaves`` ranks the pairs "()", ``weight`` subtracts cumulative sums over
    the opening parentheses.
    """

    BLOCK, FAN = 256, 16

    def __init__(self, opens: np.ndarray, weights: np.ndarray):
        """``opens``: 1 for an opening, 0 for a closing parenthesis; ``weights``: one per opening, in their order."""
        self.opens = opens.astype(np.int8)
        self.excess = np.cumsum(2 * self.opens.astype(np.int64) - 1)
        self.levels = []
        low, size = self.excess, self.BLOCK
        while len(low) > 1:
            low = np.minimum.reduceat(low, np.arange(0, len(low), size))
            self.levels.append(low)
            size = self.FAN
        pairs = np.zeros(len(opens) + 1, np.int64)
        if len(opens) > 1:
            pairs[1:-1] = np.cumsum((self.opens[:-1] == 1) & (self.opens[1:] == 0))
            pairs[-1] = pairs[-2]
        self.pairs = pairs
        self.rank = np.concatenate([[0], np.cumsum(self.opens, dtype=np.int64)])
        self.sums = np.concatenate([[0], np.cumsum(weights, dtype=np.int64)])

    def find_close(self, at: int) -> int:
        """Where the parenthesis opened at ``at`` is closed: the first later place whose excess falls below its own."""
        below = self.excess[at] - 1
        end = min((at // self.BLOCK + 1) * self.BLOCK, len(self.opens))
        found = np.flatnonzero(self.excess[at + 1:end] == below)
        if len(found):
            return at + 1 + int(found[0])
        block, level = at // self.BLOCK + 1, 0
        while True:  # up, until a later sibling reaches low enough
            low = self.levels[level]
            until = min(-(-block // self.FAN) * self.FAN, len(low))
            hit = np.flatnonzero(low[block:until] <= below)
            if len(hit):
                block += int(hit[0])
                break
            block, level = until // self.FAN if until % self.FAN == 0 else len(low), level + 1
        while level:  # down to the block
            level -= 1
            low = self.levels[level][block * self.FAN:(block + 1) * self.FAN]
            block = block * self.FAN + int(np.flatnonzero(low <= below)[0])
        start = block * self.BLOCK
        return start + int(np.flatnonzero(self.excess[start:start + self.BLOCK] == below)[0])

    def leaves(self, at: int, close: int) -> int:
        """Leaf pairs from ``at`` to ``close``."""
        return int(self.pairs[close] - self.pairs[at])

    def weight(self, at: int, close: int) -> int:
        """Sum of the weights of the parentheses opened from ``at`` to ``close``."""
        return int(self.sums[self.rank[close]] - self.sums[self.rank[at]])


def encode(keys: list, parents: list, weights: np.ndarray) -> tuple[Parentheses, list[int], list[int]]:
    """Forest of nodes with their parents' keys -> its encoding, the place of each node's opening, and each parent's place in the list (-1: none)."""
    index = {k: i for i, k in enumerate(keys)}
    above = [index.get(p, -1) for p in parents]
    children: list[list[int]] = [[] for _ in keys]
    roots = []
    for i, p in enumerate(above):
        (roots if p < 0 else children[p]).append(i)
    opens, place, order = [], [0] * len(keys), []
    stack = [(r, True) for r in reversed(roots)]
    while stack:
        node, entering = stack.pop()
        if entering:
            place[node] = len(opens)
            order.append(node)
            opens.append(1)
            stack.append((node, False))
            stack.extend((c, True) for c in reversed(children[node]))
        else:
            opens.append(0)
    return Parentheses(np.array(opens, np.int8), weights[order]), place, above


def _turns(conversations: DataFrame) -> DataFrame:
    """``c, turn, key, bytes``: each turn by a digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("c"), "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("tie")).where("c IS NOT NULL")


def _rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rebuilt turns ``c, d, rlen, key, bytes``, and all conversations ``c, rlen`` with the rebuilt length."""
    turns, first = ranked(_turns(conversations), ["c"], [F.col("turn").asc_nulls_first(), F.col("key").asc(), F.col("tie").asc()], "turns")
    length = turns.groupBy("c").agg(F.count(F.lit(1)).alias("len"))
    head = F.crc32(F.col("c").cast("string")) % HEAD
    own = length.select("c", "len", head.alias("h"), (F.col("c") - F.col("c") % FAMILY).alias("base"))
    base = length.select(apart("c").alias("base"), F.col("len").alias("base_len"))
    taken = F.least("h", F.coalesce("base_len", F.lit(0)))
    convs, second = store(own.join(base, "base", "left").select(
        "c", "h", "base", taken.alias("taken"), (taken + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("rlen")), "conversations")
    heads = turns.where((F.col("pos") < HEAD - 1) & (F.col("c") % FAMILY == 0)).select(F.col("c").alias("base"), "pos", "key", "bytes").join(
        convs, "base").where("pos < h").select("c", (F.col("pos") + 1).alias("d"), "rlen", "key", "bytes")
    rest = turns.join(convs.select(apart("c").alias("k"), "h", "taken", "rlen"), F.col("c") == F.col("k")).where("pos >= h").select(
        "c", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("d"), "rlen", "key", "bytes")
    return heads.unionByName(rest), convs.select("c", "rlen"), [first, second]


def _lanes() -> list[Column]:
    """Two 64-bit hashes of a turn at its depth as four halves: their sums along a conversation stay exact."""
    one, two = F.xxhash64("key", "d"), F.xxhash64(F.lit(1), "key", "d")
    low = F.lit(0xFFFFFFFF)
    return [F.shiftright(one, 32), one.bitwiseAND(low), F.shiftright(two, 32), two.bitwiseAND(low)]


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """``c, d, rlen, bytes, k1, k2, p1, p2``: a 128-bit name of each prefix and of the one before it; the root is (0, 0).

    A prefix is named by the sum of its turns' hashes, each bound to its depth, so blocks of depths are summed apart
    and a conversation of any length is spread over tasks.
    """
    lanes = [f"s{i}" for i in range(4)]
    rows = rebuilt.withColumn("block", ((F.col("d") - 1) / DEPTHS).cast("long")).select(
        "c", "d", "rlen", "bytes", "block", *(x.alias(f"t{i}") for i, x in enumerate(_lanes())))
    along = Window.partitionBy("c", "block").orderBy("d")
    near = lambda part: part.select("*", *(F.sum(f"t{i}").over(along).alias(s) for i, s in enumerate(lanes)))
    totals = rows.where(F.col("rlen") > DEPTHS).groupBy("c", "block").agg(*(F.sum(f"t{i}").alias(s) for i, s in enumerate(lanes)))
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select("c", "block", *(F.sum(s).over(before).alias(f"a{i}") for i, s in enumerate(lanes)))
    late = near(rows.where("block > 0")).join(ahead, ["c", "block"]).select(
        "c", "d", "rlen", "bytes", "block", *(f"t{i}" for i in range(4)), *((F.col(s) + F.col(f"a{i}")).alias(s) for i, s in enumerate(lanes)))
    both = near(rows.where("block = 0")).unionByName(late)

    def name(sums: list[Column], depth: Column) -> list[Column]:
        return [F.xxhash64(sums[0], sums[1], depth), F.xxhash64(sums[2], sums[3], F.lit(7), depth)]

    own = name([F.col(s) for s in lanes], F.col("d"))
    above = name([F.col(s) - F.col(f"t{i}") for i, s in enumerate(lanes)], F.col("d") - 1)
    return both.select("c", "d", "rlen", "bytes", own[0].alias("k1"), own[1].alias("k2"), *(
        F.when(F.col("d") > 1, x).otherwise(F.lit(0).cast("long")).alias(n) for x, n in zip(above, ("p1", "p2"))))


_SHARD = "c long, d long, p1 long, p2 long, k1 long, k2 long, n long, n_ends long, first_end long, rlen long, parent long, n_children long, n_leaves long, saved long, top boolean"


def _shards(nodes: DataFrame) -> DataFrame:
    """Subtrees below the spine, each whole in one task, encoded and measured; ``g1, g2`` name the subtree of a node."""
    names = ["g1", "g2", "d", "c", "k1", "k2", "p1", "p2", "n", "bytes", "n_ends", "first_end", "rlen"]

    def measure(columns: dict[str, np.ndarray]):
        import pyarrow as pa

        keys = list(zip(columns["k1"].tolist(), columns["k2"].tolist()))
        bits, place, above = encode(keys, list(zip(columns["p1"].tolist(), columns["p2"].tolist())), (columns["n"] - 1) * columns["bytes"])
        closes = [bits.find_close(a) for a in place]
        kids = np.bincount([p for p in above if p >= 0], minlength=len(keys)) if any(p >= 0 for p in above) else np.zeros(len(keys), np.int64)
        kids = np.where(columns["n"] == 1, columns["rlen"] > columns["d"], kids)
        owner = columns["c"].tolist()
        out = [pa.array(columns[k], pa.int64()) for k in ("c", "d", "p1", "p2", "k1", "k2", "n", "n_ends")]
        out += [pa.array(columns["first_end"], pa.int64(), from_pandas=True, mask=columns["n_ends"] == 0), pa.array(columns["rlen"], pa.int64()),
                pa.array([owner[p] if p >= 0 else None for p in above], pa.int64()), pa.array(kids.astype(np.int64)),
                pa.array([bits.leaves(a, z) for a, z in zip(place, closes)], pa.int64()),
                pa.array([bits.weight(a, z) for a, z in zip(place, closes)], pa.int64()), pa.array([p < 0 for p in above], pa.bool_())]
        return pa.RecordBatch.from_arrays(out, names=[x.split(" ")[0] for x in _SHARD.split(", ")])

    def run(batches: Iterator) -> Iterator:
        held: list[dict[str, np.ndarray]] = []
        size = 0
        for batch in batches:
            columns = {k: batch.column(k).fill_null(0).to_numpy(zero_copy_only=False) for k in names}
            if not batch.num_rows:
                continue
            if size + batch.num_rows > NODES and held:  # up to the last whole subtree
                joined = {k: np.concatenate([h[k] for h in held] + [columns[k]]) for k in names}
                ends = np.flatnonzero((joined["g1"][1:] != joined["g1"][:-1]) | (joined["g2"][1:] != joined["g2"][:-1])) + 1
                cut = int(ends[-1]) if len(ends) else 0
                if cut:
                    yield measure({k: v[:cut] for k, v in joined.items()})
                held, size = [{k: v[cut:] for k, v in joined.items()}], len(joined["d"]) - cut
            else:
                held.append(columns)
                size += batch.num_rows
        if size:
            yield measure({k: np.concatenate([h[k] for h in held]) for k in names})

    return nodes.select(*names).repartition("g1", "g2").sortWithinPartitions("g1", "g2", "d", "c").mapInArrow(run, _SHARD)


def _digests(ends: DataFrame) -> DataFrame:
    """``ends(c, k1, k2)`` -> ``k1, k2, sha``: SHA-256 of the ascending, comma-joined ids of each name that has more than one.

    Ids are listed in pieces of bounded length; the pieces of a name then run through one hash state in their order.
    """
    pieces = ends.groupBy("k1", "k2", F.floor(F.col("c") / IDS).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, state, several = None, None, False
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if (k1, k2) == key:
                    state.update(b"," + ids.encode())
                    several = True
                    continue
                if several:
                    done.append((*key, state.hexdigest()))
                key, state, several = (k1, k2), hashlib.sha256(ids.encode()), "," in ids
            yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "sha"), x)) for x in done], schema=shape())
        if several:
            yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "sha"), (*key, state.hexdigest())))], schema=shape())

    def shape():
        import pyarrow as pa

        return pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("sha", pa.string())])

    return pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "piece").mapInArrow(run, "k1 long, k2 long, sha string")


def prefix_trie(conversations: DataFrame, members: int = MEMBERS) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` -> a row for each distinct beginning of the rebuilt conversations.

    Conversation c is rebuilt of the first h original turns of conversation c - c % 5 (all if it has fewer, none if it
    is absent) and its own turns after its first h, h = crc32(c as text) % 9. Turns go by ``turn`` (null first), then
    by a digest of role and text; a repeated row is a turn of its own. Null role and text are empty, rows without
    ``conv_id`` are left out, an empty table gives no node. A very long text counts only by its digest and length.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``; (conv_id, depth) is unique.

    Nodes of at most ``members`` members lie with their whole subtree in one shard and are measured there on balanced
    parentheses. The nodes above, the spine, are shared by shards and add up what hangs below them. A conversation's
    own tail, which no other shares, is written down without any tree. Copies are one path, whatever their number;
    a shard's memory follows the shared turns of at most ``members`` conversations.
    """
    spark = conversations.sparkSession
    ship_package(spark)
    rebuilt, convs, scratch = _rebuilt(conversations)
    rows, _ = store(_prefixes(rebuilt), "prefixes")
    ends_here = F.col("d") == F.col("rlen")
    nodes, _ = store(rows.groupBy("k1", "k2").agg(
        F.min("d").alias("d"), F.min("c").alias("c"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.count_if(ends_here).alias("n_ends"),
        F.min(F.when(ends_here, F.col("c"))).alias("first_end"), F.min("rlen").alias("rlen")), "nodes")
    spine, _ = store(nodes.where(F.col("n") > members), "spine")
    few = spine.count() <= BROADCAST_ROWS
    sized = F.broadcast if few else (lambda df: df)

    below = rows.join(sized(spine.select("k1", "k2")), ["k1", "k2"], "left_anti").groupBy("c").agg(
        F.min(F.struct("d", "k1", "k2")).alias("g")).select(apart("c").alias("own"), F.col("g.k1").alias("g1"), F.col("g.k2").alias("g2"))
    single = nodes.where("n = 1").groupBy("c").agg(F.min(F.struct(
        "d", "k1", "k2", "p1", "p2", "n", "bytes", "n_ends", "first_end", "rlen")).alias("x")).select("c", "x.*")
    tails, _ = store(single, "tails")
    inner = nodes.where(F.col("n").between(2, members)).unionByName(tails)
    measured, _ = store(_shards(inner.join(below, F.col("c") == F.col("own"))), "shards")

    hanging = measured.where("top").groupBy("p1", "p2").agg(
        F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count(F.lit(1)).alias("kids"))
    forks = spine.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("forks"))
    named = lambda df: df.withColumnsRenamed({"p1": "k1", "p2": "k2"})
    zero = F.lit(0).cast("long")
    own, _ = store(spine.join(named(hanging), ["k1", "k2"], "left").join(named(forks), ["k1", "k2"], "left").select(
        "k1", "k2", "c", "d", "p1", "p2", "n", "n_ends", "first_end", (F.coalesce("kids", zero) + F.coalesce("forks", zero)).alias("n_children"),
        (F.coalesce("leaves", zero) + F.when(F.coalesce("kids", "forks").isNull(), 1).otherwise(0)).alias("leaves"),
        ((F.col("n") - 1) * F.col("bytes") + F.coalesce("saved", zero)).alias("saved")), "spine-sums")
    sums = rows.select("c", "d", "k1", "k2").join(
        sized(own.select(F.col("c").alias("from"), F.col("d").alias("depth"), "leaves", "saved")),
        (F.col("c") == F.col("from")) & (F.col("d") <= F.col("depth"))).groupBy("k1", "k2").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    shared = own.drop("leaves", "saved").join(sums, ["k1", "k2"])

    # The root adds up the spine and the subtrees that hang on itself.
    columns = {"n": zero, "c": F.lit(None).cast("long"), "n_ends": zero, "first_end": F.lit(None).cast("long"), "leaves": zero, "saved": zero, "kids": zero}
    part = lambda df: df.select(*(F.col(k).alias(k) if k in df.columns else v.alias(k) for k, v in columns.items()))
    at_root = (F.col("p1") == 0) & (F.col("p2") == 0)
    root = part(convs.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c"), F.count_if(F.col("rlen") == 0).alias("n_ends"),
                          F.min(F.when(F.col("rlen") == 0, F.col("c"))).alias("first_end"))).union(
        part(own.select("leaves", "saved"))).union(part(hanging.where(at_root))).union(
        part(forks.where(at_root).select(F.col("forks").alias("kids")))).agg(
        F.sum("n").alias("n"), F.min("c").alias("c"), F.sum("n_ends").alias("n_ends"), F.min("first_end").alias("first_end"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.sum("kids").alias("n_children")).where("n > 0").select(
        zero.alias("k1"), zero.alias("k2"), zero.alias("d"), "c", "n", "n_ends", "first_end", "n_children",
        F.greatest("leaves", F.lit(1).cast("long")).alias("n_leaves"), "saved")
    root, _ = store(root, "root")

    owners = spine.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("c").alias("owner")).unionByName(
        root.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("c").alias("owner")))
    fields = ["k1", "k2", "c", "d", "parent", "n", "n_ends", "first_end", "n_children", "n_leaves", "saved"]
    outer = measured.where("top").drop("parent").unionByName(shared, allowMissingColumns=True).join(
        sized(owners), ["p1", "p2"], "left").withColumnRenamed("owner", "parent")
    everything = measured.where("NOT top").select(*fields).unionByName(outer.select(*fields)).unionByName(
        root.withColumn("parent", F.lit(None).cast("long")).select(*fields))

    finals = rows.where(ends_here).select("c", "k1", "k2").unionByName(
        convs.where("rlen = 0").select("c", zero.alias("k1"), zero.alias("k2")))
    none = F.sha2(F.lit(""), 256)
    several = everything.where("n_ends > 1").join(_digests(finals), ["k1", "k2"])
    sole = everything.where("n_ends <= 1").withColumn(
        "sha", F.when(F.col("n_ends") == 1, F.sha2(F.col("first_end").cast("string"), 256)).otherwise(none))
    out = lambda df: df.select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))
    blocks = tails.where("rlen > d").select("c", "d", "rlen", F.explode(F.sequence(zero, F.floor((F.col("rlen") - F.col("d") - 1) / DEPTHS))).alias("block"))
    spread = blocks.where("block = 0").unionByName(blocks.where("block > 0").repartition("c", "block"))
    one = F.lit(1).cast("long")
    deeper = spread.select("c", "rlen", F.explode(F.sequence(
        F.col("d") + 1 + F.col("block") * DEPTHS, F.least("rlen", F.col("d") + (F.col("block") + 1) * DEPTHS))).alias("d")).select(
        "c", "d", F.col("c").alias("parent"), one.alias("n"), F.when(F.col("d") < F.col("rlen"), 1).otherwise(0).cast("long").alias("n_children"),
        one.alias("n_leaves"), zero.alias("saved"),
        F.when(F.col("d") < F.col("rlen"), none).otherwise(F.sha2(F.col("c").cast("string"), 256)).alias("sha"))
    discard(spark, scratch[0])
    return out(sole).unionByName(out(several)).unionByName(out(deeper))
