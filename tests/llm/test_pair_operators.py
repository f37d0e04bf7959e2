"""Near duplicates, paragraphs, line runs, vectors, components and the pipeline: brute force and odd input."""

import random
import time
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import bottomk, bucket_links, common, grid_join, hashing, line_runs, paragraphs


class Groups(dict):
    """Union-find whose roots are the smallest members."""

    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self[b] = a


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    random.seed(4)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(500, i) for i in range(80)],
             "random": [(random.randint(0, 200), random.randint(0, 200)) for _ in range(150)] + [(3, 3), (None, 4)], "none": []}[shape]
    groups = Groups()
    for a, b in edges:
        if a is not None and a != b:
            groups.link(a, b)
    got = {r["node"]: r["component"] for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: groups.root(x) for x in list(groups)}


def test_hub_rounds_lose_no_link(spark, monkeypatch):
    random.seed(2)
    buckets = [(h, random.randint(0, 150), 10) for h in range(12) for _ in range(50)]
    linked = {(a, b) for a in range(151) for b in range(a + 1, 151) if random.random() < 0.01}
    groups, members = Groups(), defaultdict(set)
    for h, i, _ in buckets:
        members[h].add(i)
    for own in members.values():
        for a, b in linked:
            if a in own and b in own:
                groups.link(a, b)
    links = spark.createDataFrame(sorted(linked), "a long, b long")
    df = spark.createDataFrame([(*b, 0, 1.0) for b in sorted(set(buckets))], "h long, id long, n long, ahead long, score double")
    for limit in (0, 10**6):
        monkeypatch.setattr(bucket_links, "PAIRS_PER_ROW", limit)
        got = {r["node"]: r["component"] for r in bucket_links.linked_components(df, lambda p: p.join(links, ["a", "b"], "left_semi"), 0.8).collect()}
        assert got == {x: groups.root(x) for x in list(groups)}


def test_hashes_of_long_texts_and_long_words():
    text = b"Abc  def\tghi " * 150_000 + b"x" * (3 << 20) + b" end"
    h, n = hashing.word_hashes([text, b"", b"abc END"], hashing.SPACED)
    assert n.tolist() == [450_002, 0, 2] and h[0] == h[-2] and h[450_001] == h[-1] and len(set(h.tolist())) == 5
    assert [len(s) for s in hashing.shingle_sets([text, b"", b"a b", None], hashing.SPACED, 4)][1:] == [0, 1, 0]


def test_shingles_tell_the_order_of_words():
    from itertools import permutations, product
    runs = {*product("abc", repeat=4), *permutations("abcdef", 4)}
    assert len({hashing.shingle_sets([" ".join(r).encode()], hashing.SPACED, 4)[0][0] for r in runs}) == len(runs)


def near_texts(seed, n=120):
    random.seed(seed)
    word = lambda: random.choice("abcdefgh") + random.choice("xyz") + str(random.randint(0, 30))
    bases = [[word() for _ in range(random.randint(3, 80))] for _ in range(15)]
    passage = [word() for _ in range(30)]
    out = []
    for i in range(n):
        w = list(random.choice(bases))
        for _ in range(random.randint(0, 4)):
            w[random.randrange(len(w))] = word()
        if i % 3 == 0:
            w = passage + [word() for _ in range(random.randint(2, 30))]
        out.append(" ".join(w))
    return out + ["", None, "one", "One", "one two three", "a b c d", "A B\tC  D"]


def shingles(text, width):
    w = (text or "").encode().lower().split()
    if len(w) >= width:
        return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("k, fine", [(48, 512), (512, 512)])
def test_near_duplicates_against_brute_force(spark, k, fine):
    texts = near_texts(k)
    sets, groups = [shingles(t, 4) for t in texts], Groups()
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                groups.link(a, b)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)] + [(None, texts[0], 1, 2)], "doc_id long, text string, n_shingles int, kept int")
    got = {r["doc_id"]: r for r in bottomk.near_duplicates(df, k=k, fine=fine).collect()}
    assert len(got) == len(texts) + 1 and got[None]["component_id"] is None and got[None]["kept"]
    for i, s in enumerate(sets):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(s), groups.root(i), groups.root(i) == i)
    assert bottomk.near_duplicates(df.limit(0)).count() == 0


def running_words(seed, n):
    rng = random.Random(seed)
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def paragraph_rows():
    """Texts of invented words with planted passages that begin anywhere, copies with edits, repeated rows and odd rows."""
    random.seed(9)
    passages = [running_words(1000 + i, 51 + 7 * i) for i in range(6)]
    docs = []
    for i in range(50):
        body = running_words(i, random.randint(0, 150))
        if i % 3 == 0:
            at, passage = random.randint(0, len(body)), list(passages[i // 3 % 6])
            if i % 9 == 0:
                passage[-1] = "edited"
            body[at:at] = passage
        docs.append((i, "".join(w + random.choice([" ", " ", "\n", ".\t"]) for w in body)))
    docs += [(100, None), (101, ""), (102, docs[3][1]), (102, docs[6][1]), (102, docs[6][1]), (None, docs[0][1]), (103, " \n la" * 200)]
    return docs


def test_paragraphs_against_brute_force(spark):
    docs = paragraph_rows()
    parts, groups = [], Groups()
    for i, t in {(i, t) for i, t in docs if i is not None and t}:
        own = t.lower().split()
        hashes, _ = hashing.word_hashes([t.encode()], hashing.SPACED)
        values = hashing.combined(hashes, 5)
        for start in paragraphs.beginnings(values, 36, 5, 16).tolist():
            parts.append((i, t, start, shingles(" ".join(own[start:start + 36]), 5), own[start:start + 5]))
        for lo in range(len(own) - 50):
            assert any(lo <= p[2] and p[2] + 36 <= lo + 51 for p in parts if p[:2] == (i, t))
    for a in range(len(parts)):
        for b in range(a):
            x, y = parts[a][3], parts[b][3]
            if parts[a][4] == parts[b][4] and 100 * len(x & y) >= 80 * len(x | y):
                groups.link(a, b)
    sizes = defaultdict(list)
    for a in range(len(parts)):
        sizes[groups.root(a)].append(a)
    want = sorted((parts[a][0], parts[a][2]) for g in sizes.values() if len(g) > 1 for a in g)
    df = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, n_removed int")
    rows = paragraphs.repeated_paragraphs(df, bands=40).collect()
    assert sorted((r["doc"], r["start"]) for r in rows) == want
    assert sum(r["kept"] for r in rows) == sum(len(g) > 1 for g in sizes.values())
    assert sorted((r["doc"], r["start"]) for r in paragraphs.repeated_paragraphs(df).collect()) == want
    assert paragraphs.repeated_paragraphs(df.limit(0)).count() == 0


def test_sets_are_taken_only_of_paragraphs_that_can_be_linked(spark, monkeypatch):
    rows, keep = {}, paragraphs.store

    def counted(df, purpose):
        out = keep(df, purpose)
        rows[purpose] = out[0].count()
        return out

    monkeypatch.setattr(paragraphs, "store", counted)
    random.seed(9)
    docs = []
    for i in range(40):
        base = [f"w{random.randrange(10**6)}" for _ in range(70)]
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:35] + [f"edit{i}"] + base[36:]))]
    found = paragraphs.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string")).count()
    assert found and rows["paragraph-sets"] * 3 < rows["paragraph-heads"]


def test_paragraphs_that_begin_alone_are_not_kept(spark, monkeypatch):
    rows, keep = {}, paragraphs.store

    def counted(df, purpose):
        stored = keep(df, purpose)
        rows[purpose] = stored[0].count()
        return stored

    monkeypatch.setattr(paragraphs, "store", counted)
    texts = [" ".join(running_words(i, 200)) for i in range(20)]
    df = spark.createDataFrame([*enumerate(texts), (50, texts[3])], "doc_id long, text string")
    found = {(r["doc"], r["start"]) for r in paragraphs.repeated_paragraphs(df).collect()}
    assert {d for d, _ in found} == {3, 50} and rows["paragraphs"] == len(found) < rows["all-paragraphs"] / 5


def test_passages_go_and_clean_texts_stay(spark):
    docs = paragraph_rows()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = paragraphs.deduplicate_paragraphs(df).collect()
    assert len(out) == len(docs)

    def runs(t):
        own = t.lower().split()
        return {tuple(own[i:i + 51]) for i in range(len(own) - 50)}

    held = defaultdict(set)
    for i, t in docs:
        for r in runs(t or "") if i is not None else ():
            held[r].add((i, t))
    dirty = {i for r in held.values() if len(r) > 1 for i, _ in r} | {103}
    left = defaultdict(set)
    for r in out:
        if r["doc_id"] is not None and r["text"] is not None:
            for x in runs(r["text"]):
                left[x].add((r["doc_id"], r["text"]))
            before = next(t for i, t in docs if i == r["doc_id"] and (i != 102 or len(t.split()) == r["n_words"]))
            assert r["n_words"] == len(before.split()) and len(r["text"].split()) == r["n_words"] - r["n_removed"]
            assert (r["n_repeated"] > 0) == (r["doc_id"] in dirty)
    assert all(len(r) == 1 for r in left.values())
    assert {(r["doc_id"], r["text"]) for r in out if r["doc_id"] in (None, 100, 101)} == {(None, docs[0][1]), (100, None), (101, "")}


def without_copies(rows, least):
    """Texts without lines inside a run of enough words that occurs at an earlier place, by trying all runs."""
    lines = {d: t.split("\n") for d, t in rows}
    count = {d: [len([x for x in line.split(" ") if x]) for line in own] for d, own in lines.items()}
    first, gone = {}, defaultdict(set)
    for d in sorted(lines):
        for p in range(len(lines[d])):
            for q in range(p + 1, len(lines[d]) + 1):
                first.setdefault(tuple(lines[d][p:q]), (d, p))
    for d, own in lines.items():
        for p in range(len(own)):
            for q in range(p + 1, len(own) + 1):
                if sum(count[d][p:q]) >= least and first[tuple(own[p:q])] < (d, p):
                    gone[d].update(range(p, q))
    return {d: ("\n".join(x for i, x in enumerate(own) if i not in gone[d]), len(gone[d])) for d, own in lines.items()}


@pytest.mark.parametrize("least, few", [(6, True), (11, False)])
def test_line_runs_against_all_runs(spark, monkeypatch, least, few):
    monkeypatch.setattr(line_runs, "BROADCAST_POSITIONS", 10**6 if few else -1)
    random.seed(least)
    rows = [(i, "\n".join(random.choice(["a b", "c d e", "f", "", "g h i j", "k  l"]) for _ in range(random.randint(1, 25)))) for i in range(60)]
    rows += [(70, ""), (71, "a b c d e f g h i j k l"), (72, "a b c d e f g h i j k l")]
    want = without_copies(rows, least)
    df = spark.createDataFrame([(i, t, "p", 3) for i, t in rows] + [(99, None, "p", 3), (None, rows[0][1], "p", 3)], "doc_id long, text string, pos string, n_lines int")
    got = {r["doc_id"]: r for r in line_runs.deduplicate_lines(df, least).collect()}
    assert {d: (got[d]["text"], got[d]["n_removed"]) for d in want} == want
    assert got[99]["text"] is None and got[None]["text"] == rows[0][1] and got[72]["text"] == "" and got[70]["n_lines"] == 1
    assert line_runs.deduplicate_lines(df.limit(0)).count() == 0


def test_line_runs_stay_in_dataframe_functions(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b")], "doc_id long, text string")
    assert "Python" not in line_runs.deduplicate_lines(df, 1)._jdf.queryExecution().executedPlan().toString()


def test_suffix_ranks_are_in_order(spark):
    df = spark.createDataFrame([(1, "x y\nz w\nx y\nz w\nx y"), (2, "z w\nx y\nz w")], "doc_id long, text string")
    lines = line_runs.repeated_lines(df, 1).cache()
    names = {(r["doc"], r["pos"]): r["rank"] for r in lines.collect()}
    for k, (table, _) in enumerate(line_runs.suffix_ranks(lines, 4)):
        ranks = {(r["doc"], r["pos"]): r["rank"] for r in table.collect()}
        runs = {p: tuple(names[p[0], p[1] + i] for i in range(2**k)) for p in ranks}
        assert sorted(runs, key=lambda p: (runs[p], p)) == sorted(runs, key=lambda p: (ranks[p], p))


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 5))
    x = np.vstack([base + rng.normal(size=(30, 5)) * 0.15 for _ in range(12)] + [base[:5], base[:5] * 3])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    groups = Groups()
    for a, b in zip(*np.nonzero(close)):
        groups.link(int(a), int(b))
    odd = [(5000, None), (5001, [0.0] * 5), (5002, [1.0, None, 2.0, 1.0, 1.0]), (5003, [float("nan")] * 5), (5004, [1.0, 2.0]), (5005, [2.0, 4.0]),
           (None, [1.0] * 5), (5006, []), (5007, [float("inf"), 1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)] + [(*o, 1) for o in odd], "vec_id long, embedding array<double>, n_links int")
    for interval, block in ((50, 8), (4096, 512)):
        got = {r["vec_id"]: r for r in grid_join.similar_vectors(df, interval=interval, block=block).collect()}
        assert len(got) == len(x) + len(odd)
        for i in range(len(x)):
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (close[i].sum(), groups.root(i), groups.root(i) == i)
        assert got[5005]["component_id"] == 5004 and got[5004]["n_links"] == 1
        assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (5000, 5001, 5002, 5003, 5006, 5007, None))
    assert grid_join.similar_vectors(df.limit(0)).count() == 0


def test_distant_intervals_do_not_meet(spark):
    rows = [(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(np.linspace(0, 3, 400))]
    df = grid_join.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    directions = grid_join.principal_directions(df, 2, 2)
    intervals, _ = common.store(grid_join._ordered(df, directions, 0.1, 2, 20, 400), "i")
    assert grid_join._near_intervals(intervals, 0.01).count() < intervals.count() ** 2 / 4


def test_pipeline_stages_on_a_small_corpus(spark, tmp_path):
    random.seed(11)
    word = lambda: "".join(random.choice(["ba", "ke", "li", "mo", "nu", "ra", "si"]) for _ in range(random.randint(2, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, labels = [], []
    for i in range(300):
        toxic = i % 4 == 0
        rows.append((i, text(80) + (" grubzop wretchk" if toxic else "")))
        labels.append((i, 1, int(toxic)))
    passage, near, leak = text(60), text(200).split(), text(40)
    rows += [(1000, text(30) + "\n" + passage), (1001, text(30) + "\n" + passage), (1002, passage), (1003, " ".join(near)),
             (1004, " ".join(near[:100] + ["zzz"] + near[101:])), (1005, text(20) + " " + leak[10:] + " " + text(20)), (1006, None), (1007, ""), (1008, "grubzop ba ke")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out, _ = common.store(stage(spark, docs, str(tmp_path)), "stage")
        if name != "packing":
            assert out.columns == columns
        seen[name] = {r["doc_id"]: r for r in out.collect()}
        docs = out
    clean = {i for i, t in rows if i < 1000 and i % 4} | {1000, 1001, 1002, 1003, 1004, 1005, 1006, 1007}
    assert set(seen["toxicity"]) == clean
    assert set(seen["line dedup"]) == clean - {1002} and passage not in seen["line dedup"][1001]["text"] and passage in seen["line dedup"][1000]["text"]
    assert seen["line dedup"][1001]["n_chars"] == len(seen["line dedup"][1001]["text"])
    assert set(seen["near duplicates"]) == clean - {1002, 1004}
    assert set(seen["decontamination"]) == set(seen["packing"]) == clean - {1002, 1004, 1005}
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in whole} == set(seen["packing"])


def test_registry_holds_every_operator():
    import __spark_entry__ as entry_points

    names = list(entry_points.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_repeated_rows_are_one_document_of_lines(spark):
    run = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) for i in range(6))
    rows = [(1, run), (1, run), (2, "intro\n" + run), (3, "one\t" * 30 + "\n" + "字" * 60), (4, "head\n" + "one\t" * 30 + "\n" + "字" * 60)]
    got = line_runs.deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(1, 0), (1, 0), (2, 6), (3, 0), (4, 2)]


def test_near_duplicate_stage_decides_by_row(spark):
    text = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"else{i}" for i in range(40))
    rows = [(5, text, 1), (5, text, 2), (5, other, 3), (6, text + " more", 4), (7, None, 5), (7, None, 6), (None, text, 7), (8, "", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = corpus_pipeline.near_duplicate_groups(spark, docs, "").collect()
    kept = sorted((r["doc_id"] or 0, (r["text"] or "")[:5], r["n_chars"]) for r in got)
    assert [k[:2] for k in kept] == [(0, "word0"), (5, "else0"), (5, "word0"), (7, ""), (7, ""), (8, "")]
    assert got[0].asDict().keys() == {"doc_id", "text", "n_chars"}


def test_short_items_remove_nothing_from_the_corpus(spark):
    from tidemark.llm.decontaminate import without_contaminated
    docs = spark.createDataFrame([(1, "the a b c d e f"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([("i", "the"), ("j", "x y z a b c")], "item_id string, text string")
    assert without_contaminated(docs, items).count() == 2
    assert without_contaminated(docs, spark.createDataFrame([("i", "b c d e f")], "item_id string, text string")).count() == 1


def test_shuffle_files_of_a_stored_table_go_before_the_next(spark):
    place = spark._jsc.sc().env().blockManager().diskBlockManager()
    held = lambda: {f for f in place.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before, df = held(), spark.range(5000).repartition(3).groupBy((common.F.col("id") % 7).alias("k")).count()
    stored, path = common.store(df, "shuffled")
    for _ in range(20):  # what the last query left is let go with a delay
        common.discard(spark, common.store(spark.range(1), "next")[1])
        left = held() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert sum(r["count"] for r in stored.collect()) == sum(r["count"] for r in df.collect()) == 5000
    common.discard(spark, path)


def test_pieces_of_the_pipeline_are_made_from_small_batches(spark, monkeypatch):
    sizes, name = [], "spark.sql.execution.arrow.maxRecordsPerBatch"
    keep, before = corpus_pipeline.store, spark.conf.get(name)
    monkeypatch.setattr(corpus_pipeline, "store", lambda df, purpose: sizes.append(int(spark.conf.get(name))) or keep(df, purpose))
    docs = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id long, text string")
    pieces = corpus_pipeline.packing(spark, docs, "").collect()
    assert sizes == [1000] and spark.conf.get(name) == before
    assert sorted(r["doc_id"] for r in pieces if r["start"] == 0) == [1, 2]


def test_stages_that_hand_whole_rows_to_python_use_small_batches(spark, monkeypatch, tmp_path):
    sizes, keep = {}, corpus_pipeline.store
    monkeypatch.setattr(corpus_pipeline, "store", lambda df, purpose: sizes.update(
        {purpose: int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))}) or keep(df, purpose))
    docs = spark.createDataFrame([(1, "one two a b c d e"), (2, None), (2, "one")], "doc_id long, text string")
    spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i", "a b c d e")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.toxicity(spark, docs, str(tmp_path))
    left = corpus_pipeline.decontamination(spark, clean, str(tmp_path))
    assert sizes == {"not-toxic": 1000, "uncontaminated": 1000}
    assert clean.count() == 3 and sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == [(2, ""), (2, "one")]
