"""Document quality by a regularised quadratic discriminant over transformed statistics of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tidemark.llm.common import apart, binary, store
from tidemark.llm.hashing import BLOCK, SPACED, hash_block
from tidemark.session import ship_package

#: What is counted in a text, in this order; every count is a sum, so long texts are counted block by block.
COUNTS = ("bytes", "upper", "digit", "stop", "sign", "beyond", "line", "words", "length", "square", "repeat", "near", "signed", "loud")
FEATURES = 13
#: Counts for and against added to each share, so that a few words alone say little.
PRIOR_BYTES, PRIOR_WORDS = (0.5, 30.0), (0.1, 10.0)
#: Decision values are squashed to (-1, 1) and counted in so many bins for the calibration.
BINS = 400
#: One in so many training rows is kept from the fit, for the calibration.
KEPT = 5


def _class_table() -> np.ndarray:
    """Byte classes as columns: upper, digit, stop or comma, other sign, beyond ASCII, line break."""
    table = np.zeros((256, 6))
    table[65:91, 0] = 1
    table[48:58, 1] = 1
    table[[44, 46], 2] = 1
    table[33:127, 3] = 1
    table[:, 3] -= table[:, 0] + table[:, 1] + table[:, 2]
    table[97:123, 3] = 0
    table[128:, 4] = 1
    table[[10, 11, 12, 13], 5] = 1
    return table


_CLASSES = _class_table()


def _block_counts(parts: list[bytes], last: list[np.ndarray]) -> np.ndarray:
    """Counts of each part. ``last`` are the hashes of the three words before each part, where it goes on with a text."""
    block = b"\n".join(parts)
    arr = np.frombuffer(block, np.uint8)
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes + 1)
    owner = np.repeat(np.arange(len(parts)), sizes + 1)[:len(arr)]
    out = np.zeros((len(parts), len(COUNTS)))
    out[:, 0] = sizes
    out[:, 1:7] = np.bincount(owner * 256 + arr, minlength=256 * len(parts)).reshape(-1, 256) @ _CLASSES
    out[:-1, 6] -= 1  # the line break between two parts
    plain = block.translate(SPACED)
    hashes, starts = hash_block(plain)
    if not len(starts):
        return out
    inside = np.frombuffer(plain, np.uint8) != 32
    lengths = np.flatnonzero(np.diff(np.append(inside, False).astype(np.int8)) == -1) + 1 - starts
    of = np.searchsorted(ends, starts, side="right")
    sums = lambda x: np.bincount(of, weights=x, minlength=len(parts))
    first = np.searchsorted(of, np.arange(len(parts)))
    same = []
    for back in (1, 2, 3):
        before = np.concatenate([np.zeros(back, np.uint64), hashes[:-back]]) if len(hashes) > back else np.zeros(len(hashes), np.uint64)
        known = np.arange(len(hashes)) - first[of] >= back
        for p in np.flatnonzero([len(x) > 0 for x in last]):
            for j in range(min(back, len(last[p]))):
                at = first[p] + back - 1 - j
                if at < len(of) and of[at] == p:
                    before[at], known[at] = last[p][-1 - j], True
        same.append((before == hashes) & known)
    loud, letters, signs = (np.add.reduceat(x.astype(np.int64), starts) for x in (
        (arr >= 65) & (arr <= 90), ((arr | 32) >= 97) & ((arr | 32) <= 122), _CLASSES[arr, 3] > 0))
    out[:, 7], out[:, 8], out[:, 9] = sums(np.ones(len(starts))), sums(lengths), sums(lengths.astype(float) ** 2)
    out[:, 10], out[:, 11] = sums(same[0]), sums((same[1] | same[2]) & ~same[0])
    out[:, 12], out[:, 13] = sums(signs > 0), sums((letters > 1) & (loud == letters))
    return out


def count_texts(texts: list[bytes | None]) -> np.ndarray:
    """``COUNTS`` of whole texts, a row each; null counts as empty."""
    out = np.zeros((len(texts), len(COUNTS)))
    held, places, size = [], [], 0

    def flush() -> None:
        nonlocal held, places, size
        if held:
            out[places] += _block_counts(held, [np.empty(0, np.uint64)] * len(held))
        held, places, size = [], [], 0

    for i, text in enumerate(texts):
        text = text or b""
        if len(text) > BLOCK:
            at, last = 0, np.empty(0, np.uint64)
            while at < len(text):
                end = len(text) if at + BLOCK >= len(text) else text.rfind(b" ", at, at + BLOCK) + 1
                end = end if end > at else at + BLOCK
                part = text[at:end]
                out[i] += _block_counts([part], [last])[0]
                last = np.concatenate([last, hash_block(part[-4096:].translate(SPACED))[0]])[-3:]
                at = end
            continue
        if size + len(text) > BLOCK:
            flush()
        held.append(text)
        places.append(i)
        size += len(text) + 1
    flush()
    return out


def transform(counts: np.ndarray) -> np.ndarray:
    """Features of counts: logarithms of sizes, smoothed log-odds of shares."""
    c = dict(zip(COUNTS, counts.T))
    odds = lambda part, whole, prior: np.log((part + prior[0]) / (np.maximum(whole - part, 0) + prior[1]))
    mean = (c["length"] + 1) / (c["words"] + 1)
    spread = np.sqrt(np.maximum(c["square"] / np.maximum(c["words"], 1) - (c["length"] / np.maximum(c["words"], 1)) ** 2, 0))
    return np.column_stack([
        np.log1p(c["words"]), np.log(mean), np.log1p(spread),
        *(odds(c[k], c["bytes"], PRIOR_BYTES) for k in ("upper", "digit", "stop", "sign", "beyond", "line")),
        *(odds(c[k], c["words"], PRIOR_WORDS) for k in ("repeat", "near", "signed", "loud"))])


def document_statistics(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, stats``: the features of each whole text, for every row, where it lies."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                values = transform(count_texts(binary(part.column(1))))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * FEATURES, pa.int32()), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "stats"])

    return texts.mapInArrow(run, StructType([texts.schema["doc_id"], StructField("stats", ArrayType(DoubleType()))]))


@dataclass
class Model:
    """Means, inverted Cholesky factors and log-determinants of both classes, and slope and shift of the probability."""

    means: np.ndarray
    factors: np.ndarray
    logdets: np.ndarray
    slope: float
    shift: float

    def decisions(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, squashed to (-1, 1) in its root's scale."""
        far = [((x - m) @ f.T) ** 2 for m, f in zip(self.means, self.factors)]
        raw = 0.5 * (far[0].sum(axis=1) + self.logdets[0] - far[1].sum(axis=1) - self.logdets[1])
        return raw / (np.abs(raw) + 10)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.decisions(x) + self.shift, -40, 40)))


def shrunk(cov: np.ndarray, n: float) -> np.ndarray:
    """Oracle approximating shrinkage of a covariance towards a multiple of the unit matrix (Chen et al. 2010)."""
    p = len(cov)
    trace, square = np.trace(cov), np.sum(cov * cov)
    low = (n + 1 - 2 / p) * (square - trace ** 2 / p)
    rho = 1.0 if low <= 0 else min(1.0, ((1 - 2 / p) * square + trace ** 2) / low)
    return (1 - rho) * cov + (rho * trace / p + 1e-3) * np.eye(p)


def discriminant(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled_share: float = 0.1) -> Model:
    """Model of ``class -> (count, sums, sums of products)``: class covariances, in units of the pooled deviation,
    drawn ``pooled_share`` of the way to their average, then shrunk."""
    counts = np.array([moments[k][0] for k in (0, 1)])
    means = np.array([moments[k][1] / moments[k][0] for k in (0, 1)])
    covs = np.array([moments[k][2] / moments[k][0] - np.outer(m, m) for k, m in zip((0, 1), means)])
    scale = np.sqrt(np.maximum((covs[0].diagonal() + covs[1].diagonal()) / 2, 1e-6))
    covs = covs / np.outer(scale, scale)
    covs = (1 - pooled_share) * covs + pooled_share * covs.mean(axis=0)
    lows = [np.linalg.cholesky(shrunk(c, n)) for c, n in zip(covs, counts)]
    factors = np.array([np.linalg.inv(low) / scale for low in lows])
    return Model(means, factors, np.array([2 * np.log(low.diagonal()).sum() for low in lows]), 1.0, 0.0)


def calibrate(values: np.ndarray, classes: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift over weighted decision values, by Newton steps with a small ridge; the slope stays positive."""
    x = np.column_stack([values, np.ones(len(values))])
    v = np.array([1.0, 0.0])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -40, 40)))
        w = np.maximum(p * (1 - p), 1e-9) * weights
        step = np.linalg.solve(x.T @ (x * w[:, None]) + 0.1 * np.eye(2), x.T @ (weights * (classes - p)) - 0.1 * v)
        v = v + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(v[0], 1e-3)), float(v[1])


def _rows(batch) -> np.ndarray:
    return np.asarray(batch.column("stats").flatten()).reshape(-1, FEATURES)


def fit(training: DataFrame) -> Model | float:
    """``training(stats, label, keep boolean)`` -> the model; with fewer than two classes to fit, the share of label 1.

    Every row takes part: tasks send sums of products, Spark adds them, and the driver gets a matrix per class. Rows
    with ``keep`` are not in those sums; their decision values, counted in bins, give slope and shift.
    """
    ship_package(training.sparkSession)
    size = FEATURES * FEATURES + FEATURES + 1

    def sums(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((2, size))
        for batch in batches:
            x, y = _rows(batch), np.asarray(batch.column("label"))
            for k in (0, 1):
                own = x[y == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        for k in (0, 1):
            if total[k, 0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, k)), pa.array(np.arange(size)), pa.array(total[k])], names=["k", "i", "v"])

    found: dict[int, np.ndarray] = {}
    for row in training.where("NOT keep").select("stats", "label").mapInArrow(sums, "k long, i long, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).collect():
        found.setdefault(row["k"], np.zeros(size))[row["i"]] = row["v"]
    if len(found) < 2:
        share = training.agg(F.avg("label").alias("p")).first()["p"]
        return 0.5 if share is None else float(share)
    model = discriminant({k: (v[0], v[1:FEATURES + 1], v[FEATURES + 1:].reshape(FEATURES, FEATURES)) for k, v in found.items()})

    def bins(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            at = np.clip(((model.decisions(_rows(batch)) + 1) * BINS / 2).astype(np.int64), 0, BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("label")], names=["b", "label"])

    counted = training.where("keep").select("stats", F.col("label").cast("long").alias("label")).mapInArrow(
        bins, "b long, label long").groupBy("b", "label").count().collect()
    if len({r["label"] for r in counted}) == 2:
        at, y, n = (np.array([float(r[c]) for r in counted]) for c in ("b", "label", "count"))
        model.slope, model.shift = calibrate((at + 0.5) * 2 / BINS - 1, y, n)
    else:
        model.slope = 10.0
    return model


def score_statistics(stats: DataFrame, model: Model | float) -> DataFrame:
    """``stats(doc_id, stats)`` -> ``doc_id, score`` (0 to 1, higher: better)."""
    ship_package(stats.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            scores = np.full(batch.num_rows, model) if isinstance(model, float) else model.scores(_rows(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, StructType([stats.schema["doc_id"], StructField("score", DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs(doc_id, text)``, ``labels(doc_id, quality)`` -> ``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Labels of 0 and 1 are learnt where crc32(doc_id as text) mod 4 is not 2, all of them; a doc_id with both labels
    counts as 1, a repeated row counts as often as it is there. Only the text enters a score: null is scored as the
    empty text, which has zero counts. Without labels of both classes every score is the share of label 1 (0.5 without
    any). A null ``doc_id`` is held out: it has no remainder. Other columns are ignored; empty tables give no rows.
    """
    stats, _ = store(document_statistics(docs), "statistics")
    code = F.crc32(F.col("doc_id").cast("string"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where(
        "doc_id IS NOT NULL AND label IN (0, 1)").where(code % 4 != 2).groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.select(apart("doc_id").alias("known_id"), "label")
    training = stats.join(known, F.col("doc_id") == F.col("known_id")).select(
        "stats", F.col("label").cast("long").alias("label"), ((code / 4).cast("long") % KEPT == 0).alias("keep"))
    model = fit(training)
    return score_statistics(stats, model).select(
        "doc_id", F.coalesce(code % 4 == 2, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
