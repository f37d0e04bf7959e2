"""Toxicity by a subsequence string kernel with Nyström landmarks and a linear support vector machine."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.tokens import Memory
from tidemark.session import ship_package

ORDER = 3
DECAY = 0.7
LETTERS = 64
LONGEST = 20
LANDMARKS = 160
SAMPLE = 3000
#: Subsequences looked at together; they bound the memory of a task.
BLOCK = 250_000


@lru_cache(maxsize=20_000)
def plain(token: str) -> str:
    """Letters and digits of a token; marks between them are left out."""
    return token if token.isalnum() else "".join(c for c in token if c.isalnum())


def pieces(word: str) -> list[str]:
    """A word, or for a long one its overlapping parts of ``LONGEST`` characters."""
    if len(word) <= LONGEST:
        return [word]
    step = LONGEST // 2
    return [word[i:i + LONGEST] for i in range(0, len(word) - step, step)]


@lru_cache(maxsize=64)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all subsequences of three among n characters, and their weights by span."""
    at = np.array(list(combinations(range(n), ORDER)), dtype=np.int64).reshape(-1, ORDER)
    return at, (DECAY ** (at[:, -1] - at[:, 0] + 1)).astype(np.float64) if len(at) else np.empty(0)


def _codes(words: list[str]) -> np.ndarray:
    """Characters of words of one length as numbers below ``LETTERS``; a-z and 0-9 have their own."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    out = np.where((flat >= 97) & (flat <= 122), flat - 96, 37 + flat % 27)
    return np.where((flat >= 48) & (flat <= 57), flat - 48 + 27, out).reshape(len(words), -1)


def features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(places, subsequences, weights)`` of words by length; weights have unit norm per word.

    The subsequence kernel of order three is the inner product of these: each occurrence of a subsequence weighs
    ``DECAY`` to the power of its span, so gaps and inserted characters cost, but do not break, similarity.
    """
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for n, group in groupby(order, key=lambda i: len(words[i])):
        group = list(group)
        at, weight = _triples(n)
        if not len(at):
            continue
        step = max(1, min(4096, BLOCK // len(at)))
        for lo in range(0, len(group), step):
            places = np.array(group[lo:lo + step])
            codes = _codes([words[i] for i in places])
            ids = (codes[:, at[:, 0]] * LETTERS + codes[:, at[:, 1]]) * LETTERS + codes[:, at[:, 2]]
            yield places, ids, weight / np.sqrt(_self_kernel(codes))[:, None]


def _self_kernel(codes: np.ndarray) -> np.ndarray:
    """Kernel of each word with itself, by the usual recursion over pairs of positions."""
    n = codes.shape[1]
    same = (codes[:, :, None] == codes[:, None, :]).astype(np.float64)
    fall = np.tril(DECAY ** (np.arange(n)[:, None] - np.arange(n)[None, :]).clip(0))
    before = np.ones_like(same)
    for _ in range(ORDER - 1):
        step = DECAY * DECAY * same * before
        run = fall @ step @ fall.T
        before = np.zeros_like(run)
        before[:, 1:, 1:] = run[:, :-1, :-1]
    return (DECAY * DECAY * same * before).sum(axis=(1, 2))


def tokens_of(text: str) -> set[str]:
    """Lowered tokens between white space, and runs of three or more single characters as one."""
    parts = text.lower().split()
    out = set(parts)
    if sum(len(p) == 1 for p in out) > 2:
        run: list[str] = []
        for part in [*parts, ""]:
            if len(part) == 1:
                run.append(part)
            else:
                if len(run) > 2:
                    out.add("".join(run))
                run = []
    return out


@dataclass
class Model:
    """Weight of each subsequence, bias, and slope and shift of the probability."""

    weights: np.ndarray | None
    bias: float
    slope: float
    shift: float

    def decisions(self, tokens: list[str]) -> np.ndarray:
        """Decision value of each token: the largest of its pieces."""
        parts, owner = [], []
        for i, token in enumerate(tokens):
            for piece in pieces(plain(token)):
                parts.append(piece)
                owner.append(i)
        values = np.full(len(parts), self.bias)
        for places, ids, weights in features(parts):
            values[places] += (self.weights[ids] * weights).sum(axis=1)
        out = np.full(len(tokens), -np.inf)
        np.maximum.at(out, owner, values)
        return out

    def probability(self, decision: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * decision + self.shift, -40, 40))))


def _newton_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 25) -> np.ndarray:
    """Linear squared-hinge machine with bias (last coefficient) by Newton steps on the margin violators."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge * weight.sum())
    penalty[-1] = 1e-6
    v = np.zeros(x.shape[1])
    active = np.ones(len(x), bool)
    for _ in range(rounds):
        a, w = x[active], weight[active]
        v = np.linalg.solve(a.T @ (a * w[:, None]) + np.diag(penalty), a.T @ (w * y[active]))
        now = y * (x @ v) < 1
        if (now == active).all():
            break
        active = now
    return v


class _Landmarks:
    """Kernel values with landmark words."""

    def __init__(self, words: list[str]):
        self.words = words
        self.index = np.zeros(LETTERS ** ORDER, dtype=np.int32)
        found = list(features(words))
        used = np.unique(np.concatenate([ids.ravel() for _, ids, _ in found]))
        self.index[used] = np.arange(1, len(used) + 1)
        self.table = np.zeros((len(used) + 1, len(words)))
        for places, ids, weights in found:
            for p, row, w in zip(places, self.index[ids], weights):
                np.add.at(self.table[:, p], row, w)

    def kernel(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.words)))
        for places, ids, weights in features(words):
            for lo in range(0, len(places), 256):
                rows = self.table[self.index[ids[lo:lo + 256]]]
                out[places[lo:lo + 256]] = np.einsum("ws,wsm->wm", weights[lo:lo + 256], rows)
        return out

    def fold(self, coefficients: np.ndarray) -> np.ndarray:
        """One weight per subsequence that gives the same decision as all landmarks."""
        return np.concatenate([[0.0], (self.table @ coefficients)[1:]])[self.index].astype(np.float32)


def train(texts: list[str], labels: list[int], landmarks: int = LANDMARKS, rounds: int = 3, share: float = 0.6) -> Model:
    """Learns which words make a labelled text toxic.

    A label speaks of a whole text, so words stand for texts: a toxic one has the word of most evidence (root of
    the likelihood ratio) at first, later the one of highest decision value; words of at least ``share`` of the
    usual evidence always take part. Landmarks are the words of most evidence and the commonest clean words.
    The other side are common clean words and, after the first round, the word of each clean text that came
    nearest. A fifth of the texts is kept for the probability.
    """
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        return Model(None, 0.0, 0.0, float(np.clip(8 * (y.mean() if len(y) else 0) - 4, -4, 4)))
    bags = [[p for p in {q for t in tokens_of(text) for q in pieces(plain(t))} if len(p) >= ORDER] for text in texts]
    held = np.zeros(len(y), bool)
    for k in (0, 1):  # every fifth of either class
        held[np.flatnonzero(y == k)[4::5]] = True
    if len({*y[held]}) < 2:
        held[:] = False
    seen = [Counter(w for bag, c, h in zip(bags, y, held) if c == k and not h for w in bag) for k in (0, 1)]
    n0, n1 = (int(((y == k) & ~held).sum()) for k in (0, 1))
    strength = {w: _evidence(c, n1, seen[0][w], n0) for w, c in seen[1].items() if c > 1}
    witness = [max((w for w in bag if w in strength), key=lambda w: (strength[w], w), default=None)
               for bag, c, h in zip(bags, y, held) if c == 1 and not h]
    counted = Counter(w for w in witness if w is not None)
    least = share * float(np.median([strength[w] for w in witness if w is not None])) if counted else 0.0
    speaking = sorted((w for w, z in strength.items() if z > 0), key=lambda w: (-strength[w], w))
    strong = [w for w in speaking if strength[w] >= least]
    common = [w for w, _ in sorted(seen[0].items(), key=lambda x: (-x[1], x[0]))]
    if not speaking or not common:
        return Model(None, 0.0, 0.0, float(np.log((n1 + 1) / (n0 + 1))))
    marks = speaking[:landmarks // 2] + common[:landmarks - min(landmarks // 2, len(speaking))]
    kernel = _Landmarks(marks)
    values, vectors = np.linalg.eigh(kernel.kernel(marks))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    negatives = [w for w in common[:12_000] if strength.get(w, 0) < least]
    toxic_bags = [own for bag, c, h in zip(bags, y, held) if c == 1 and not h and (own := [w for w in bag if w in strength])]
    clean_bags = [bag for bag, c, h in zip(bags, y, held) if c == 0 and not h and bag]
    cache: dict[str, float] = {}

    def top(bag: list[str]) -> str:
        fresh = [w for w in bag if w not in cache]
        cache.update(zip(fresh, model.decisions(fresh).tolist() if fresh else []))
        return max(bag, key=lambda w: (cache[w], w))

    for turn in range(rounds):
        support = counted + Counter({w: seen[1][w] for w in strong})
        positives = sorted(support)
        sign = np.array([1.0] * len(positives) + [-1.0] * len(negatives))
        total = sum(support.values())
        weight = np.array([support[w] / total for w in positives] + [1 / max(1, len(negatives))] * len(negatives))
        v = _newton_svm(kernel.kernel(positives + negatives) @ root, sign, weight * len(sign))
        model = Model(kernel.fold(root @ v[:-1]), float(v[-1]), 1.0, 0.0)
        cache.clear()
        if turn + 1 < rounds:
            nearest = Counter(top(bag) for bag in clean_bags)
            counted = Counter(top(bag) for bag in toxic_bags)
            counted = Counter({w: c for w, c in counted.items() if c > nearest[w]})
            negatives = list(dict.fromkeys([*(w for w in nearest if w not in counted), *negatives]))
    use = held if held.any() else ~held
    scores = np.array([cache[top(bag)] if bag else model.bias for bag, u in zip(bags, use) if u])
    model.slope, model.shift = _platt(scores, y[use])
    return model


def _evidence(c1: int, n1: int, c0: int, n0: int) -> float:
    """Signed root of the likelihood ratio of a word's shares in toxic and clean texts."""
    total = (c1 + c0) / (n1 + n0)
    ratio = sum(c * np.log(c / (n * total)) + (n - c) * np.log(max(n - c, 1e-9) / (n * (1 - total) + 1e-9))
                for c, n in ((c1, n1), (c0, n0)) if c) + sum(n * np.log(1 / (1 - total + 1e-9)) for c, n in ((c1, n1), (c0, n0)) if not c)
    return float(np.sign(c1 / n1 - c0 / n0) * np.sqrt(max(0.0, 2 * ratio)))


def _platt(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift with smoothed targets (Platt 1999), by Newton steps; the slope stays positive."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([scores, np.ones(len(scores))])
    v = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -40, 40)))
        w = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve(x.T @ (x * w[:, None]) + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * v)
        v = v + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(v[0], 1e-3)), float(v[1])


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[str], list[int]]:
    """At most ``sample`` texts of either label, by hash order; rows with crc32(doc_id as text) mod 5 = 0 are held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    picked = None
    for k in (0, 1):
        part = known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = part if picked is None else picked.union(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text")).collect()
    rows.sort(key=lambda r: (hash_order(r["doc_id"]), r["text"]))
    return [r["text"] for r in rows], [r["toxic"] for r in rows]


def hash_order(doc_id: int) -> int:
    return (doc_id * 0x9E3779B97F4A7C15) & (2**64 - 1)


def _scorer(model: Model, limit: int = 100_000):
    """Scores of texts; decision values of tokens seen lately are remembered, in bounded memory."""
    memory = Memory(limit)

    def score(texts: list[str | None]) -> list[float]:
        if model.weights is None:
            return [model.probability(0.0)] * len(texts)
        bags = [tokens_of(t) if t else set() for t in texts]
        unseen = memory.missing(set().union(*bags)) if bags else []
        if unseen:
            memory.new.update(zip(unseen, model.decisions(unseen).tolist()))
        known = memory.new
        return [model.probability(max(map(known.__getitem__, bag), default=model.bias)) for bag in bags]

    return score


def score_texts(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with ``name`` (0 to 1): the probability by the most toxic word of the whole text.

    Nulls and texts without words get the score of the bias. A column ``name`` that is there already is replaced.
    """
    ship_package(docs.sparkSession)
    base = docs.drop(name)
    names = base.columns
    place = names.index("text")
    schema = StructType([*base.schema.fields, StructField(name, DoubleType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        score = _scorer(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                scores, held, size = [], [], 0
                for text in part.column(place).to_pylist():
                    held.append(text)
                    size += len(text or "")
                    if size > 500_000:
                        scores += score(held)
                        held, size = [], 0
                scores += score(held)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*names, name])

    return base.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs(doc_id, text)``, ``labels(doc_id, toxic)`` -> ``doc_id, held_out, score, predicted`` for every row.

    The model is fitted on the driver on at most ``sample`` labelled texts of either class and sent to the tasks
    as one weight per subsequence of three characters; every whole text is then scored where it lies, without a
    shuffle. Neither labels nor language, source or id enter a score. Without labels of both classes all scores
    are one constant. A null ``doc_id`` is held out: it has no remainder.
    """
    model = train(*training_rows(docs, labels, sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return score_texts(texts, model).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
