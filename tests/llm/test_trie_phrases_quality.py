"""Prefix trie, collocations, quality: brute force, held-out accuracy, odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import phrases, prefix_trie, quality, ranks
from tidemark.llm.common import table

SMALL = "/root/testdata/sf0.01"


# --- positions

def test_ranked_counts_across_tasks(spark):
    rows = [(k, v) for k in (None, 1, 2) for v in range(400)] + [(3, 7)] * 50
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "k long, v long").repartition(7)
    got, _ = ranks.ranked(df, ["k"], [F.col("v").desc()], "test-ranks")
    rows = got.collect()
    assert len(rows) == 1250
    assert all(r["pos"] == 399 - r["v"] for r in rows if r["k"] != 3)
    assert sorted(r["pos"] for r in rows if r["k"] == 3) == list(range(50))


# --- trie

def brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append((turn is not None, turn or 0, name, role, text))
    whole = {c: [(r, x) for *_, r, x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c in whole:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = whole.get(c - int(math.fmod(c, 5)), [])[:h] + whole[c][h:]
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((own[0], len(p), members[p[:-1]][0] if p else None, len(own), kids[p], leaves[p], saved[p], hashlib.sha256(
        ",".join(str(c) for c in own if len(rebuilt[c]) == len(p)).encode()).hexdigest()) for p, own in members.items())


def trie_rows(df, **options):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df, **options).collect()), key=lambda r: (r[0], r[1]))


ODD = "conv_id long, turn long, role string, text string"


def odd_conversations(rng):
    rows = [(c if c < 60 else None, rng.choice([None, 0, 1, 2, 2]), rng.choice(["u", None, "a"]), rng.choice(["", "x", None, "éé"]))
            for c in range(-12, 64) for _ in range(rng.randint(1, 12))]
    return rows + rows[:5] + [(c, i, "u", f"long {i % 3}") for c in (700, 705) for i in range(90)]


@pytest.mark.parametrize("members", [1, 3, 64])
def test_trie_equals_brute_force(spark, monkeypatch, members):
    monkeypatch.setattr(prefix_trie, "DEPTHS", 32)
    monkeypatch.setattr(prefix_trie, "IDS", 4)
    rows = odd_conversations(random.Random(5))
    df = spark.createDataFrame(rows, ODD).withColumn("parent", F.lit("own")).withColumn("depth", F.lit(1))
    assert trie_rows(df, members=members) == brute_trie(rows)


def test_trie_of_the_small_table(spark):
    df = table(spark, SMALL, "conversations")
    assert trie_rows(df) == brute_trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_trie_without_conversations(spark):
    assert trie_rows(spark.createDataFrame([], ODD)) == []
    assert trie_rows(spark.createDataFrame([(None, 1, "u", "x")], ODD)) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=700), st.randoms())
def test_parentheses_equal_walking_the_tree(seeds, rng):
    shape = rng.choice([1, 3, 10**9])
    parents = [None if i == 0 or s % 17 == 0 else max(0, i - 1 - s % min(i, shape)) for i, s in enumerate(seeds)]
    weights = np.array([s % 100 for s in seeds])
    bits, place, above = prefix_trie.encode(list(range(len(seeds))), parents, weights)
    total, leaf, has = weights.astype(object).copy(), [0] * len(seeds), {p for p in parents if p is not None}
    for i in reversed(range(len(seeds))):
        leaf[i] += i not in has
        if parents[i] is not None:
            total[parents[i]] += total[i]
            leaf[parents[i]] += leaf[i]
    for i, at in enumerate(place):
        close = bits.find_close(at)
        assert (bits.leaves(at, close), bits.weight(at, close)) == (leaf[i], total[i])


# --- collocations

def brute_phrases(rows, least, top):
    pieces = defaultdict(list)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            pieces[lang or "und"].append(re.findall("[^\x20\x09]+", piece))
    out = []
    for lang, own in pieces.items():
        f = Counter(tuple(w[i:i + k]) for w in own for k in range(1, 6) for i in range(len(w) - k + 1))
        n = sum(map(len, own))
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {p[i:j] for p, a in frequent.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and a >= f[p[i:j]]}
        scored = []
        for p, a in frequent.items():
            if p not in inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def phrase_rows(df, **options):
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def odd_texts(rng):
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice(["A", "b", "é", "Cc", "日"]) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "!"])
                                                     for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    return rows + [("en", None), ("en", ""), (None, " . "), ("fr", "one two three four five six " * 40)] + rows[:20] + [("und", "a b a b")]


@pytest.mark.parametrize("flush, coded", [(400_000, 1 << 18), (300, 3)])
def test_phrases_equal_brute_force(spark, monkeypatch, flush, coded):
    monkeypatch.setattr(phrases, "FLUSH", flush)
    monkeypatch.setattr(phrases, "CODED", coded)
    rows = odd_texts(random.Random(2))
    df = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, n int, p string")
    for least, top in ((2, 50), (9, 2000)):
        assert phrase_rows(df, least=least, top=top) == brute_phrases(rows, least, top)


def test_prefixes_common_everywhere_are_routed_deeper(spark, monkeypatch):
    seen = []
    plain = phrases._suffixes
    monkeypatch.setattr(phrases, "SHARE", 0.02)
    monkeypatch.setattr(phrases, "_suffixes", lambda t, c, f, common, b: seen.append(len(common)) or plain(t, c, f, common, b))
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choice(["a b c", "a b d", "a b c d e", "f", "g"]) for _ in range(40))) for _ in range(60)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert phrase_rows(df, least=5) == brute_phrases(rows, 5, 2000)
    assert seen and seen[0] > 3


def test_a_text_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 500)
    rng = random.Random(6)
    rows = [("en", " ".join(rng.choice("abcde") for _ in range(3000)) + "x" * 1200 + " a b. c")]
    assert phrase_rows(spark.createDataFrame(rows, "lang string, text string"), least=3) == brute_phrases(rows, 3, 2000)


def test_phrases_without_texts(spark):
    for rows in ([], [("en", None)], [("en", "a")]):
        assert phrase_rows(spark.createDataFrame(rows, "lang string, text string")) == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 3)] * 4), max_size=60), st.integers(1, 6))
def test_quicksort_counts_prefixes(rows, least):
    rows = [tuple(r[:r.index(0)]) + (0,) * (4 - r.index(0)) if 0 in r else r for r in rows]
    counts = np.array([1 + i % 3 for i in range(len(rows))], np.int64)
    got = {rows[row][:depth]: total for row, depth, _, total in phrases.quicksorted(
        np.array(rows, np.int32).reshape(-1, 4), counts, least)}
    want = Counter()
    for r, c in zip(rows, counts.tolist()):
        for d in range(1, 5):
            if r[d - 1]:
                want[r[:d]] += c
    assert got == {p: n for p, n in want.items() if n >= least}


# --- quality

def test_quality_of_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    found = quality.quality(docs, labels).join(labels, "doc_id").where("held_out")
    right, n = found.agg(F.count_if(F.col("predicted") == F.col("quality")), F.count(F.lit(1))).first()
    assert n > 800 and right / n > 0.98
    bad = found.where("quality = 0").agg(F.avg("predicted")).first()[0]
    assert bad < 0.05


def test_quality_of_odd_rows(spark):
    rows = [(i, f"Some plain words in a line, number {i} of them.", "x") for i in range(40)]
    rows += [(i, "LOUD!! WORDS!! " * (i - 38), "x") for i in range(40, 80)]
    rows += [(None, "no id", "x"), (90, None, "x"), (91, "", "x"), (92, "word " * 400_000, "x"), (3, rows[3][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)] + [(5, None), (None, 1), (6, 7)], "doc_id long, quality int")
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    by = {r["doc_id"]: r["score"] for r in got}
    assert min(by[i] for i in range(40)) > max(by[i] for i in range(42, 80))
    assert by[90] == by[91]


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.quality(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int")
    assert {r["score"] for r in quality.quality(docs, ones).collect()} == {1.0}
    assert quality.quality(docs.limit(0), ones).count() == 0


def test_counts_of_a_long_text_do_not_depend_on_blocks(monkeypatch):
    rng = random.Random(3)
    text = " ".join(rng.choice(["ab", "Cd!", "EF", "7"]) for _ in range(4000)).encode()
    whole = quality.count_texts([text])
    monkeypatch.setattr(quality, "BLOCK", 600)
    assert (quality.count_texts([b"x", text, None])[1] == whole[0]).all()


def test_discriminant_equals_densities():
    rng = np.random.default_rng(1)
    p = quality.FEATURES
    data = {k: rng.normal(size=(500, p)) @ rng.normal(size=(p, p)) * (1 + k) + k for k in (0, 1)}
    model = quality.discriminant({k: (len(x), x.sum(0), x.T @ x) for k, x in data.items()})
    covs = [np.linalg.inv(f.T @ f) for f in model.factors]
    x = rng.normal(size=(20, p))
    dens = [-0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) - 0.5 * np.linalg.slogdet(c)[1] for m, c in zip(model.means, covs)]
    raw = dens[1] - dens[0]
    assert np.allclose(model.decisions(x), raw / (np.abs(raw) + 10), atol=1e-6)
