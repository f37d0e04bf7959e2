"""Collocations: frequent phrases by three-way quicksort of suffix pointers, scored by their weakest cut."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import apart, binary, store
from tidemark.llm.hashing import BLOCK, hash_block, mix, word_hashes
from tidemark.llm.ranks import ranked
from tidemark.session import ship_package

LEAST = 100
TOP = 2000
LONGEST = 5
#: Words after which a task hands on what it has.
FLUSH = 400_000
#: Suffixes of one bucket, on average.
BUCKET = 250_000
#: So many of the commonest words have short codes, known to every task. With a run's other words, codes stay below 2**21.
CODED = 1 << 18
#: A prefix of more than this share of all words is routed by one word more; there can be no more than three times its inverse.
SHARE = 1 / 65536
#: Bits of the filter of frequent words.
FILTER_BITS = 24

#: A piece ends at each of these.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_WORDS = bytes(32 if b in BREAKS or b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BREAK = np.isin(np.arange(256), list(BREAKS))
_STEP = np.uint64(0x9FB21C651E98DF25)


def _blocks(langs: list, texts: list) -> Iterator[tuple[list[bytes], list]]:
    """Texts as blocks of parts, each part closed by a line break, or by a space where its text goes on."""
    parts, own, size = [], [], 0
    for lang, text in zip(langs, texts):
        text, at = text or b"", 0
        while at < len(text):
            end = len(text)
            if end - at > BLOCK:
                end = max(text.rfind(b" ", at, at + BLOCK), at)
                if end == at:  # one run without a space fills the block
                    end = text.find(b" ", at + BLOCK)
                    end = len(text) if end < 0 else end
            part = text[at:end] + (b"\n" if end == len(text) else b" ")
            if parts and size + len(part) > BLOCK:
                yield parts, own
                parts, own, size = [], [], 0
            parts.append(part)
            own.append(lang)
            size += len(part)
            at = end
    if parts:
        yield parts, own


def _sliced(batches: Iterator) -> Iterator:
    """Batches of few rows: what a task holds as Python objects stays small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            yield batch.slice(lo, 256)


def _salt(lang: str) -> np.uint64:
    return word_hashes([lang.encode() + b"!"], bytes(range(256)))[0][:1].view(np.uint64)[0] if lang else np.uint64(0)


def _ids(hashes: np.ndarray, salts) -> np.ndarray:
    """Words of a language as 64-bit ids; 0 stands for no word."""
    ids = mix(hashes ^ salts)
    ids[ids == 0] = 1
    return ids


class _Stream:
    """Word ids and piece numbers of a task's texts, handed on in runs; the last words of a run stay for the next."""

    def __init__(self):
        self.ids, self.pieces, self.size, self.piece, self.salts = [], [], 0, 0, {}

    def add(self, parts: list[bytes], langs: list[str]) -> None:
        block = b"".join(parts)
        hashes, starts = hash_block(block.translate(_WORDS))
        breaks = np.cumsum(_BREAK[np.frombuffer(block, np.uint8)])
        for lang in set(langs) - self.salts.keys():
            self.salts[lang] = _salt(lang)
        salts = np.array([self.salts[x] for x in langs], np.uint64)
        of = np.searchsorted(np.cumsum([len(p) for p in parts]), starts, side="right")
        self.ids.append(_ids(hashes, salts[of]))
        self.pieces.append(breaks[starts] + self.piece)
        self.piece += int(breaks[-1])
        self.size += len(starts)

    def take(self, last: bool) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids, pieces, and how many of the words begin a window now."""
        ids = np.concatenate(self.ids) if self.ids else np.empty(0, np.uint64)
        pieces = np.concatenate(self.pieces) if self.pieces else np.empty(0, np.int64)
        begun = len(ids) if last else max(len(ids) - (LONGEST - 1), 0)
        self.ids, self.pieces = [ids[begun:]], [pieces[begun:]]
        self.size = len(ids) - begun
        return ids, pieces, begun


def _chain(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(prefix * _STEP + word)


def _common_prefixes(ids: np.ndarray, pieces: np.ndarray, begun: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefixes of two to four words that take more than ``SHARE`` of this run, and their counts."""
    least = max(8, int(begun * SHARE))
    prefix, at, keys, counts = ids[:begun], np.arange(begun), [], []
    for _ in range(LONGEST - 2):
        depth = len(keys) + 1
        on = at + depth < len(ids)
        at, prefix = at[on], prefix[on]
        on = pieces[at] == pieces[at + depth]
        at = at[on]
        prefix = _chain(prefix[on], ids[at + depth])
        found, n = np.unique(prefix, return_counts=True)
        keys.append(found[n >= least])
        counts.append(n[n >= least])
    return np.concatenate(keys), np.concatenate(counts)


def _count(texts: DataFrame) -> DataFrame:
    """``texts(lang, text)`` -> counts of words ``lang, word, id, n``, and of common prefixes, which have no word."""

    def rows(words: list[tuple], keys: np.ndarray, counts: np.ndarray):
        import pyarrow as pa

        ids = np.empty(0, np.uint64)
        if words:
            hashes = word_hashes([b" ".join(w for _, w, _ in words)], bytes(range(256)))[0]
            salts = {x: _salt(x) for x in {w[0] for w in words}}
            ids = _ids(hashes, np.array([salts[w[0]] for w in words], np.uint64))
        empty = [None] * len(keys)
        return pa.RecordBatch.from_arrays([
            pa.array([w[0] for w in words] + empty, pa.string()), pa.array([w[1] for w in words] + empty, pa.binary()),
            pa.array(np.concatenate([ids, keys]).view(np.int64)), pa.array(np.concatenate([np.array([w[2] for w in words], np.int64), counts]))],
            names=["lang", "word", "id", "n"])

    def run(batches: Iterator) -> Iterator:
        stream, counted = _Stream(), {}
        for batch in _sliced(batches):
            for parts, own in _blocks(batch.column(0).to_pylist(), binary(batch.column(1))):
                stream.add(parts, own)
                for part, lang in zip(parts, own):
                    counted.setdefault(lang, Counter()).update(part.translate(_WORDS).split())
                if stream.size > FLUSH:
                    yield rows([], *_common_prefixes(*stream.take(False)))
                if sum(map(len, counted.values())) > 200_000:
                    for lang, c in counted.items():
                        yield rows([(lang, w, n) for w, n in c.items()], np.empty(0, np.uint64), np.empty(0, np.int64))
                    counted = {}
        yield rows([(lang, w, n) for lang, c in counted.items() for w, n in c.items()], *_common_prefixes(*stream.take(True)))

    return texts.mapInArrow(run, "lang string, word binary, id long, n long")


def _suffixes(texts: DataFrame, coded: np.ndarray, frequent: np.ndarray | None, common: np.ndarray, buckets: int) -> DataFrame:
    """Windows of frequent words from each place, packed by the bucket of their leading words: ``bucket, packed``.

    A window ends before the first infrequent word, at the end of its piece, or after five words. ``coded`` are the ids of the
    commonest words by falling count, ``frequent`` a filter of the others where there are more. Equal windows of a run are
    one with a count. The leading words that choose the bucket are the shortest prefix, of two words at least, that is
    not common.
    """
    order = np.argsort(coded)
    held = texts.sparkSession.sparkContext.broadcast((coded, coded[order], (order + 1).astype(np.int32), frequent, np.sort(common)))

    def codes_of(ids, coded, ordered, code, frequent):
        """Code of each word (0: infrequent), and the names of all codes."""
        spot = np.minimum(np.searchsorted(ordered, ids), max(len(ordered) - 1, 0))
        out = np.where(ordered[spot] == ids, code[spot], 0) if len(ordered) else np.zeros(len(ids), np.int32)
        names = np.concatenate([np.zeros(1, np.uint64), coded])
        if frequent is not None:
            cell = ids & np.uint64((1 << FILTER_BITS) - 1)
            other = (out == 0) & ((frequent[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1)
            more, inverse = np.unique(ids[other], return_inverse=True)
            out[other] = len(names) + inverse
            names = np.concatenate([names, more])
        return out, names

    def windows(ids, pieces, begun, coded, ordered, code, frequent, common):
        found, names = codes_of(ids, coded, ordered, code, frequent)
        codes = np.zeros(len(ids) + LONGEST, np.int32)
        codes[:len(ids)] = found
        link = np.zeros(len(ids) + LONGEST, bool)
        link[:max(len(ids) - 1, 0)] = (found[:-1] > 0) & (found[1:] > 0) & (pieces[:-1] == pieces[1:])
        at = np.flatnonzero(link[:begun])
        table, on = [codes[at], codes[at + 1]], np.ones(len(at), bool)
        for j in range(2, LONGEST):
            on = on & link[at + j - 1]
            table.append(np.where(on, codes[at + j], 0))
        wide = [c.astype(np.int64) for c in table]
        high, low = wide[0] << 21 | wide[1], wide[2] << 42 | wide[3] << 21 | wide[4]
        del wide
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])) if len(order) else order
        counts = np.diff(np.append(first, len(order)))
        table = np.column_stack([c[order][first] for c in table]) if len(first) else np.empty((0, LONGEST), np.int32)
        # how far a window's prefixes are common, and the prefix that routes it
        prefix, route, depth, going = names[table[:, 0]], None, np.ones(len(table), np.uint8), np.ones(len(table), bool)
        for j in range(1, LONGEST):
            there = table[:, j] > 0
            prefix = np.where(there, _chain(prefix, names[table[:, j]]), prefix)
            route = prefix if route is None else np.where(going & there, prefix, route)
            spot = np.searchsorted(common, prefix)
            hit = (common[np.minimum(spot, len(common) - 1)] == prefix) & (spot < len(common)) if len(common) else np.zeros(len(table), bool)
            going = going & there & hit & (j < LONGEST - 1)
            depth[going] = j + 1
        return names, table, counts, depth, (route % np.uint64(buckets)).astype(np.int64) if len(table) else np.empty(0, np.int64)

    def packed(names, table, counts, depth, bucket):
        import pyarrow as pa
        import zstandard

        tool = zstandard.ZstdCompressor(level=1, write_content_size=True, write_checksum=False)
        order = np.argsort(bucket, kind="stable")
        ends = np.flatnonzero(np.diff(bucket[order])) + 1
        keys, blobs, short = [], [], len(held.value[0])
        for own in np.split(order, ends) if len(order) else []:
            codes = table[own]
            rest = codes > short
            local = np.empty(0, np.uint64)
            if rest.any():
                used, inverse = np.unique(codes[rest], return_inverse=True)
                codes[rest] = short + 1 + inverse
                local = names[used]
            # one plane per byte of a column: the upper ones are nearly empty
            planes = np.column_stack([codes, counts[own].astype(np.int32)]).astype("<u4").view("u1").reshape(len(own), -1)
            raw = b"".join([np.array([len(own), len(local)], "<u4").tobytes(), local.astype("<u8").tobytes(),
                            np.ascontiguousarray(planes.T).tobytes(), depth[own].tobytes()])
            keys.append(int(bucket[own[0]]))
            blobs.append(tool.compress(raw))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "packed"])

    def run(batches: Iterator) -> Iterator:
        stream, known = _Stream(), held.value
        for batch in _sliced(batches):
            for parts, own in _blocks(batch.column(0).to_pylist(), binary(batch.column(1))):
                stream.add(parts, own)
                if stream.size > FLUSH:
                    yield packed(*windows(*stream.take(False), *known))
        yield packed(*windows(*stream.take(True), *known))

    return texts.mapInArrow(run, "bucket long, packed binary")


def quicksorted(table: np.ndarray, counts: np.ndarray, least: int) -> Iterator[tuple[int, int, int, int]]:
    """Multikey three-way quicksort of pointers to the rows of ``table`` -> (row, depth, rows, count) of each prefix that has ``least``.

    A partition is split by its pivot at one depth into less, equal and greater; the equal one goes on to the next
    depth, and its size, in counts, is the count of its prefix. Partitions below ``least`` are abandoned unsorted. 0 ends a row.
    """
    pointers = np.arange(len(table))
    columns = [np.ascontiguousarray(table[:, j]) for j in range(table.shape[1])]
    stack = [(0, len(pointers), 0)]
    while stack:
        lo, hi, depth = stack.pop()
        own = pointers[lo:hi]
        if int(counts[own].sum()) < least:
            continue
        keys = columns[depth][own]
        a, b, c = int(keys[0]), int(keys[len(keys) // 2]), int(keys[-1])
        pivot = max(min(a, b), min(max(a, b), c))
        less, same = keys < pivot, keys == pivot
        lower, equal, upper = own[less], own[same], own[~(less | same)]
        pointers[lo:hi] = np.concatenate([lower, equal, upper])
        mid, end = lo + len(lower), lo + len(lower) + len(equal)
        if len(lower):
            stack.append((lo, mid, depth))
        if len(upper):
            stack.append((end, hi, depth))
        if pivot:
            total = int(counts[equal].sum())
            if total >= least:
                yield int(equal[0]), depth + 1, len(equal), total
                if depth + 1 < table.shape[1]:
                    stack.append((mid, end, depth + 1))


def _phrases(packed: DataFrame, coded: np.ndarray, least: int) -> DataFrame:
    """Frequent phrases of each bucket as arrays of word ids, ``p, n``; those of common prefixes are parts of counts."""
    held = packed.sparkSession.sparkContext.broadcast(coded)

    def unpacked(blobs: list[bytes]):
        import zstandard

        tool, coded = zstandard.ZstdDecompressor(), held.value
        tables, counts, depths, extra = [], [], [], []
        size = 4 * (LONGEST + 1)
        for blob in blobs:
            raw = tool.decompress(blob)
            n, m = np.frombuffer(raw, "<u4", 2).tolist()
            at = 8 + 8 * m
            numbers = np.ascontiguousarray(np.frombuffer(raw, "u1", size * n, at).reshape(size, n).T).view("<u4")
            codes = numbers[:, :LONGEST].astype(np.int32)
            if m:  # names of its own: numbered anew, blob after blob
                codes[codes > len(coded)] += sum(map(len, extra))
                extra.append(np.frombuffer(raw, "<u8", m, 8))
            tables.append(codes)
            counts.append(numbers[:, LONGEST].astype(np.int64))
            depths.append(np.frombuffer(raw, "u1", n, at + size * n))
        table = np.concatenate(tables)
        names = np.concatenate([np.zeros(1, np.uint64), coded])
        if extra:
            more, inverse = np.unique(np.concatenate(extra), return_inverse=True)
            own = table > len(coded)
            table[own] = len(names) + inverse[table[own] - len(names)]
            names = np.concatenate([names, more])
        return names, table, np.concatenate(counts), np.concatenate(depths)

    def found(blobs: list[bytes]):
        import pyarrow as pa

        names, table, counts, depths = unpacked(blobs)
        phrases, totals = [], []
        for row, depth, _, total in quicksorted(table, counts, least):
            if depth > 1 and depth > depths[row]:
                phrases.append(names[table[row, :depth]].view(np.int64).tolist())
                totals.append(total)
        for depth in range(2, LONGEST):
            own = np.flatnonzero(depths >= depth)
            if len(own):
                rows, inverse = np.unique(table[own, :depth], axis=0, return_inverse=True)
                phrases += names[rows].view(np.int64).tolist()
                totals += np.bincount(inverse.ravel(), weights=counts[own]).astype(np.int64).tolist()
        return pa.RecordBatch.from_arrays([pa.array(phrases, pa.list_(pa.int64())), pa.array(totals, pa.int64())], names=["p", "n"])

    def run(batches: Iterator) -> Iterator:
        bucket, held = None, []
        for batch in batches:
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b != bucket and held:
                    yield found(held)
                    held = []
                bucket = b
                held.append(blob)
        if held:
            yield found(held)

    parts = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "p array<long>, n long")
    return parts.groupBy("p").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``docs(lang, text)`` -> the first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lowered in A-Z, split into pieces at ``[.,;:!?]`` and line breaks, and into words at spaces and tabs. A candidate is a
    phrase of 2 to 5 words that occurs ``a >= least`` times in pieces of a language, overlaps included. Its score is the least
    ``floor(1000 a n / (l r))`` over its cuts (ties: the first cut), in exact decimals. Candidates inside a longer one of the
    same count are dropped. Order: score and a descending, phrase in byte order.

    Null texts have no words; a null language is ``und``; repeated rows count each; no texts, no rows; other columns
    are ignored. Words are told apart by 64-bit hashes with their language. Two passes read the texts: the first counts
    words and finds prefixes that are common everywhere; the second sends windows of frequent words to buckets by their
    leading words, equal ones of a task as one with a count, and each bucket is sorted just as far as partitions stay
    frequent. What tasks are sent is bounded: codes of at most 2**18 words, a filter of 2**24 bits for the others, which only
    saves work, and at most three times 65536 common prefixes.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    counted, _ = store(_count(texts), "counts")
    words, _ = store(counted.where("word IS NOT NULL").groupBy("lang", "word", "id").agg(F.sum("n").alias("n")), "words")
    total = words.agg(F.sum("n").alias("n")).first()["n"] or 0
    common = counted.where("word IS NULL").groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= max(least, total * SHARE)).select("id").collect()
    frequent = words.where(F.col("n") >= least)
    coded = np.array([r["id"] for r in frequent.orderBy(F.col("n").desc(), "id").limit(CODED).select("id").collect()], np.int64).view(np.uint64)
    filter_ = None
    if len(coded) == CODED:
        cell = F.col("id").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
        bits = frequent.groupBy(F.shiftright(cell, 6).alias("at")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(id & 63L as int))")).alias("bits")).collect()
        filter_ = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        filter_[[r["at"] for r in bits]] = [r["bits"] for r in bits]
        filter_ = filter_.view(np.uint64)
    buckets = max(64, int(total / BUCKET) + 1)
    packed = _suffixes(texts, coded, filter_, np.array([r["id"] for r in common], np.int64).view(np.uint64), buckets)
    phrases, _ = store(_phrases(packed, coded, least), "phrases")

    size = F.size("p")
    inner = phrases.where(size > 2).select("n", F.explode(F.array(
        F.slice("p", F.lit(1), size - 1), F.slice("p", F.lit(2), size - 1))).alias("q")).groupBy("q").agg(F.max("n").alias("longer"))
    kept, _ = store(phrases.join(inner, F.col("p") == F.col("q"), "left").where("longer IS NULL OR longer < n").select("p", F.col("n").alias("a")), "candidates")
    grams = phrases.select("p", "n").unionByName(frequent.select(F.array("id").alias("p"), "n"))
    left, right = (grams.select(F.col("p").alias(f"{x}_p"), F.col("n").alias(x)) for x in ("l", "r"))
    cuts = kept.select("p", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "p", "a", "k", F.slice("p", F.lit(1), F.col("k")).alias("q"), F.slice("p", F.col("k") + 1, size - F.col("k")).alias("s"))
    named = frequent.select(apart("id").alias("word_id"), "lang", F.col("word").cast("string").alias("word"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    spelt = kept.select("p", "a", F.posexplode("p").alias("i", "id")).join(named, F.col("id") == F.col("word_id")).groupBy("p").agg(
        F.min("lang").alias("lang"), F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]).alias("w")).select(
        "p", "lang", F.array_join("w", " ").alias("phrase"))
    whole = cuts.join(left, F.col("q") == F.col("l_p")).join(right, F.col("s") == F.col("r_p")).select("p", "a", "k", "l", "r")
    whole = whole.join(spelt.join(totals, "lang").withColumnRenamed("p", "spelt"), F.col("p") == F.col("spelt"))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    exact = whole.withColumn("over", (F.lit(1000).cast("decimal(4,0)") * big("a") * F.col("total").cast("decimal(15,0)")).cast("decimal(38,0)")).withColumn(
        "under", (big("l") * big("r")).cast("decimal(38,0)")).withColumn("score", F.expr("over div under"))
    scored = exact.groupBy("p").agg(F.min(F.struct("score", "k", "l", "r", "a", "lang", "phrase", "total")).alias("x")).select("x.*")
    placed, _ = ranked(scored.select("lang", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"), ["lang"],
                       [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()], "collocations")
    return placed.where(F.col("pos") < top).select("lang", (F.col("pos") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")
