"""Packing, token files, decontamination, toxicity, surrogates, archives: brute force, round trips, odd input."""

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import decontaminate, packing, surrogates, token_files, tokens, toxicity, warc
from tidemark.session import scratch_dir

TEXTS = [None, "", " ", "one", "A b.", "x\ty", "foo.\nBar, baz!\n\nqux ", "é è, à. " * 50, "a  b", "don't ... 1.5,2 (x). y", "<|endoftext|> z",
         "日本 語。", "same text here", "same text here"]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "en", f"s{i}") for i, t in enumerate(TEXTS)] + [(None, "no id", "en", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, start string")


@pytest.fixture(scope="module")
def tool():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.tokenizer_path())


def ids_of(tool, text, end):
    return tool.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abzÉé .,\n'!_12\t()%&") + ["日", "́", "\x00", "\x01"]), max_size=30))
def test_encoder_equals_the_whole_text(text):
    tool = tokens.encoder(tokens.tokenizer_path())
    assert tool([text])[0] == tool.whole(text)


def test_encoder_forgets_and_learns_again():
    tool = tokens.Encoder(tokens.tokenizer_path(), limit=20)
    random.seed(1)
    texts = [" ".join("".join(random.choice("abcd!") for _ in range(random.randint(1, 5))) + random.choice([".", ",", ""]) for _ in range(30)) for _ in range(40)]
    for _ in range(2):
        for t in texts:
            assert tool([t])[0] == tool.whole(t)


def test_encoder_calls_little_for_each_new_word():
    import cProfile
    import pstats

    random.seed(4)
    words = list({"".join(random.choice("abcdefgh") for _ in range(9)) + end for _ in range(3000) for end in ("", "-4", "!!")})
    tool, profile = tokens.Encoder(tokens.tokenizer_path(), limit=5000), cProfile.Profile()
    got = [profile.runcall(tool, [" ".join(words[i:i + 3000])])[0] for i in range(0, len(words), 3000)]
    assert got == [tool.whole(" ".join(words[i:i + 3000])) for i in range(0, len(words), 3000)]
    assert pstats.Stats(profile).total_calls < 9 * len(words)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=40))
def test_balanced_packing_covers_everything_without_padding(lengths):
    placed, sizes = packing.balanced(lengths, 64)
    rooms = {}
    for i, start, n, s, offset in placed:
        rooms.setdefault(s, []).append((offset, n))
    for i, total in enumerate(lengths):
        at = 0
        for start, n in sorted((p[1], p[2]) for p in placed if p[0] == i):
            assert start == at
            at += n
        assert at == total
    for s, parts in rooms.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == sizes[s] and (at == 64 or at & (at - 1) == 0)


def test_packing_prefers_the_cheapest_open_sequence():
    placed, _ = packing.balanced([40, 40, 20, 20, 4, 4], 64)
    assert len({s for i, _, _, s, _ in placed if i in (0, 1)}) == 2
    assert all(sum(n for *_, n, s, _ in [(p[0], p[1], p[2], p[3], p[4]) for p in placed] if s == k) == 64 for k in (0, 1))


def test_pack_documents(docs, tool):
    rows = packing.pack_documents(docs, window_tokens=100, capacity=32, with_ids=True).collect()
    for i, text in enumerate(TEXTS):
        want, at = ids_of(tool, text, 0), 0
        for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(want))
            part = want[at:at + r["length"]]
            assert list(r["ids"]) == part and r["ids_crc32"] == crc(part)
            at += r["length"]
        assert at == len(want)
    assert sum(r["length"] for r in rows if r["doc_id"] is None) == len(ids_of(tool, "no id", 0))
    assert packing.pack_documents(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs, capacity=1000)


@pytest.mark.parametrize("delta", [False, True])
def test_token_files_round_trip(spark, docs, tool, delta):
    path = scratch_dir(spark, "t")
    token_files.write_token_files(docs, path, delta=delta)
    rows = sorted(token_files.with_checksums(token_files.read_token_files(spark, path)).collect(), key=lambda r: r["start"])
    assert rows[0]["doc_id"] is None
    at = 0
    for r, (i, text) in zip(rows, [(None, "no id"), *enumerate(TEXTS)]):
        want = ids_of(tool, text, 2)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(want), crc(want))
        at += len(want)


def test_token_files_are_indexed_and_selective(spark, docs):
    import glob

    import pyarrow.parquet as pq

    path = scratch_dir(spark, "t")
    token_files.write_token_files(docs, path, page_rows=2)
    files = [pq.ParquetFile(f) for f in glob.glob(f"{path}/*.parquet")]
    groups = [f.metadata.row_group(g).column(3) for f in files for g in range(f.metadata.num_row_groups)]
    assert groups and all(c.has_offset_index and c.has_column_index and "RLE_DICTIONARY" in c.encodings for c in groups)
    plan = token_files.read_token_files(spark, path).where("doc_id = 3").select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids:" not in plan.split("ReadSchema")[1].split("\n")[0]
    empty = scratch_dir(spark, "t")
    token_files.write_token_files(docs.limit(0), empty)
    assert token_files.with_checksums(token_files.read_token_files(spark, empty)).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_contamination_against_brute_force(spark, block):
    random.seed(5)
    pick = lambda n: " ".join(random.choice(["a", "B", "c", "Éa", "x-y", "q7"]) for _ in range(n))
    items = [(1, pick(12)), (2, pick(3)), (3, None), (4, ""), (5, pick(6)), (10, "a"), (None, pick(5)), (2, pick(4))]
    texts = [(i, pick(random.randint(0, 60))) for i in range(40)] + [(100, None), (101, ""), (102, "q7"), (7, "a a a"), (None, "a b")]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in texts], "doc_id long, text string, n_hit int, spans string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = WORD.findall(low(t))
        if i is not None:
            for x in decontaminate.windows_of(w, 5):
                windows.setdefault(x, set()).add(i)
    want, clean = [], 0
    for i, t in texts:
        w, hit, found = WORD.findall(low(t)), set(), set()
        for x, ids in windows.items():
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k:k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    found |= ids
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        want.append((str(i), len(w), len(hit), len(found), sha, bool(hit)))
        clean += not hit
    got = decontaminate.contamination(docs, bench, width=5, block_bytes=block).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    left = decontaminate.without_contaminated(docs, bench, width=5, block_bytes=block)
    assert left.count() == clean and left.columns == docs.columns
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs, bench.limit(0)).collect())


def ssk(s, t, n=toxicity.ORDER, decay=toxicity.DECAY):
    """Subsequence kernel by its definition."""
    from itertools import combinations

    def phi(w):
        out = {}
        for at in combinations(range(len(w)), n):
            key = "".join(w[i] for i in at)
            out[key] = out.get(key, 0) + decay ** (at[-1] - at[0] + 1)
        return out
    a, b = phi(s), phi(t)
    return sum(v * b.get(k, 0) for k, v in a.items())


def test_landmark_kernel_equals_its_definition():
    words = ["idiot", "idxiot", "banana", "aab", "abcdefgh", "noise"]
    kernel = toxicity._Landmarks(words).kernel(words)
    want = [[ssk(a, b) / np.sqrt(ssk(a, a) * ssk(b, b)) for b in words] for a in words]
    assert np.allclose(kernel, want)


def sentences(n, seed):
    random.seed(seed)
    word = lambda: "".join(random.choice(["ba", "ke", "li", "mo", "nu", "ra", "si"]) for _ in range(random.randint(1, 4)))
    out = []
    for i in range(n):
        toxic = i % 3 == 0
        text = [word() for _ in range(random.randint(5, 30))]
        if toxic:
            text.insert(random.randint(0, len(text)), random.choice(["wretchk", "grubzop", "fthump"]))
        out.append((i, " ".join(text), int(toxic)))
    return out


def test_toxicity_learns_and_tolerates_gaps(spark):
    rows = sentences(600, 1)
    docs = spark.createDataFrame([(i, t, "c", 9.0) for i, t, _ in rows] + [(1000, None, "c", 9.0), (1001, "", "c", 9.0), (None, "ba ke", "c", 9.0),
                                 (1002, "ba g-r-u-b-z-o-p li", "c", 9.0), (1003, "ba w r e t c h k li", "c", 9.0), (1004, "grubbzop", "c", 9.0)],
                                 "doc_id long, text string, label string, score double")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(5, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == len(rows) + 6
    held = [(got[i]["predicted"], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    assert np.mean([p == y for p, y in held]) > 0.97
    assert got[1002]["predicted"] == got[1003]["predicted"] == got[1004]["predicted"] == 1
    assert got[1000]["predicted"] == got[1001]["predicted"] == 0 and got[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    one = toxicity.toxicity(docs, labels.where("toxic = 0")).collect()
    assert len({r["score"] for r in one}) == 1
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0 and toxicity.toxicity(docs, labels.limit(0)).count() == len(got)


def replaced(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_entities int")
    return {r["doc_id"]: (r["text"], r["n_entities"]) for r in surrogates.pseudonymize(df, key).collect()}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def test_surrogates_keep_type_format_and_coreference(spark):
    got = replaced(spark, ["a Ann.Lee-7@mail5.example.com b ann.lee-7@MAIL5.example.com c", "card 4111 1111 1111 1111, 4111111111111111",
                           "Mrs. Anna Smith, Mr Smith; Госпожа Иванова. Frau MEIER", "ip 10.2.3.4.", None, "", "no data 12 1.2.3", "bob@mail5.example.com 10.2.3.4",
                           "+49 30 1234567 and +49-30-1234567 and 123-45-6789", 'key "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'])
    first, second = re.findall(r"\S+@\S+", got[0][0])
    assert first.lower() == second.lower() and "ann" not in first.lower() and re.fullmatch(r"[A-Z][a-z]{2}\.[A-Z][a-z]{2}-\d@[a-z]{4}\d\.[a-z]{7}\.com", first)
    a, b = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}), (\d{16})", got[1][0]).groups()
    assert a.replace(" ", "") == b != "4111111111111111" and luhn(b)
    assert re.fullmatch(r"Mrs\. [A-Z][a-z]+a [A-Z][a-z]+, Mr [A-Z][a-z]+o; Госпожа [А-Я][а-я]+а\. Frau [A-Z]+A", got[2][0])
    address = re.fullmatch(r"ip ((?:\d{1,3}\.){3}\d{1,3})\.", got[3][0])[1]
    assert got[4] == (None, 0) and got[5] == ("", 0) and got[6] == ("no data 12 1.2.3", 0)
    assert got[7][0].split()[1] == address and got[7][0].split("@")[1].split()[0].lower() == first.split("@")[1].lower()
    assert re.sub(r"\D", "", got[8][0].split(" and ")[0]) == re.sub(r"\D", "", got[8][0].split(" and ")[1])
    assert re.fullmatch(r'key "[0-9a-f]{40}"', got[9][0]) and got[0][1] == 2
    assert replaced(spark, ["bob@mail5.example.com"], "other")[0] != replaced(spark, ["bob@mail5.example.com"])[0]


def test_surrogates_stay_distinct(spark, monkeypatch):
    texts = [f"{i:02d}@x.io" for i in range(15)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [r["text"] for r in surrogates.pseudonymize(df, "k").orderBy("doc_id").collect()]
    assert len(set(want)) == 15 and not set(want) & set(texts) and all(re.fullmatch(r"\d\d@[a-z]\.io", t) for t in want)
    monkeypatch.setattr(surrogates, "LITERAL_EXCEPTIONS", -1)
    assert [r["text"] for r in surrogates.pseudonymize(df, "k").orderBy("doc_id").collect()] == want


def test_surrogates_of_full_formats(spark, monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [f"{c}@x.io {c.upper()}@X.io" for c in letters] + [f"{i:02d}@mail.org" for i in range(100)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(surrogates.colliding, "__defaults__", (2, 2048))
    got = [r["text"] for r in surrogates.pseudonymize(df, "k").orderBy("doc_id").collect()]
    pairs = [t.split() for t in got[:26]]
    assert all(a.lower() == b.lower() for a, b in pairs) and len({a for a, _ in pairs}) == 26 == len(set(got[:26]))
    # another host leaves every value of both formats free: each is used once, and none is longer
    assert {a.split("@")[0] for a, _ in pairs} == set(letters) and len({a.split("@")[1] for a, _ in pairs}) == 1
    assert {t.split("@")[0] for t in got[26:]} == {f"{i:02d}" for i in range(100)}
    # numbers that fill their format leave none free: all are longer
    things = spark.createDataFrame([("social", f"{i:02d}", f"{i:02d}") for i in range(100)], "kind string, canon string, mention string")
    again = surrogates.colliding(things, "k", turns=1, draws=64).collect()
    made = surrogates._assigned(things.join(spark.createDataFrame(again), ["kind", "canon"]).selectExpr("*", "1 AS turn"), "k").collect()
    values = {r["made"] for r in made}
    assert len(made) == 100 == len(values) and all(3 <= len(v) <= 5 and v.isdigit() for v in values)


def iban_rest(text):
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def test_surrogates_keep_account_check_digits(spark):
    good, other = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    got = replaced(spark, [f"{good} and {good.replace(' ', '')}", other, "DE89370400440532013001"])
    a, b = got[0][0].split(" and ")
    assert a.replace(" ", "") == b != good.replace(" ", "") and re.fullmatch(r"DE\d\d( \d{4}){4} \d\d", a) and iban_rest(a) == 1
    assert re.fullmatch(r"GB\d\d[A-Z]{4}\d{14}", got[1][0]) and got[1][0] != other and iban_rest(got[1][0]) == 1
    assert re.fullmatch(r"DE\d{20}", got[2][0]) and got[2][0] not in (b, good.replace(" ", ""))


def test_surrogates_find_whole_entities(spark, monkeypatch):
    token = "9233A8EC24BE64439E3E49CF46B2D7C9"
    texts = [f"t {token} t {token.lower()} t", "p +1 (826) 555-4081 190.137.223.204 p", "p +1 (826) 555-4081 2019 p +1 826 555 4081 12.50 p",
             "p 190.137.223.204 p +49 30 123456 2019, +49 30 123456", "+44 20 7946 2012 ok +4420 79462012 5",
             "Anna Smith. Mrs. Anna Smith, Smithy: Anna Smith's; Anna Smith-Jones. Dr. Anna Smith", "Anna Smith"]
    got = replaced(spark, texts)
    a, b = re.fullmatch(r"t ([0-9A-F]{32}) t ([0-9a-f]{32}) t", got[0][0]).groups()
    assert a.lower() == b != token.lower() and got[0][1] == 2
    phone, address = re.fullmatch(r"p (\+\d \(\d{3}\) \d{3}-\d{4}) (\d+\.\d+\.\d+\.\d+) p", got[1][0]).groups()
    assert got[2][0].startswith(f"p {phone} 2019 p ") and got[2][0].endswith(" 12.50 p") and got[1][1] == got[2][1] == 2
    assert re.sub(r"\D", "", got[2][0].split(" 2019 p ")[1][:-8]) == re.sub(r"\D", "", phone)
    assert re.fullmatch(re.escape(f"p {address} p ") + r"(\+\d\d \d\d \d{6}) 2019, \1", got[3][0])
    one, two = re.fullmatch(r"(\+\d\d \d\d \d{4} \d{4}) ok (\+\d{4} \d{8}) 5", got[4][0]).groups()
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two)
    name = re.search(r"Mrs\. (\w+ \w+),", got[5][0])[1]
    assert got[5][0].startswith(f"{name}. Mrs. {name}, Smithy: {name}'s; Anna Smith-Jones. Dr. ") and got[5][1] == 4 and got[6] == ("Anna Smith", 0)
    monkeypatch.setattr(surrogates, "LITERAL_EXCEPTIONS", -1)
    assert replaced(spark, texts) == got


def test_surrogates_keep_scripts(spark):
    zeros = {"arabic": 0x660, "devanagari": 0x966, "full-width": 0xFF10}
    write = lambda t, zero: "".join(chr(zero + int(c)) if c.isdigit() else c for c in t)
    texts = [f"{write('4111 1111 1111 1111', z)} ip {write('10.2.3.4', z)}" for z in zeros.values()] + [
        "4111111111111111 ip 10.2.3.4", "иван.ПЕТРОВ@почта.рф", "νίκος7@x.gr", "משה@x.il", "王山@x.cn"]
    got = replaced(spark, texts)
    plain = got[3][0].split(" ip ")
    assert luhn(plain[0]) and plain[0] != "4111111111111111"
    for i, z in enumerate(zeros.values()):
        card, address = got[i][0].split(" ip ")
        assert all(ord(c) in range(z, z + 10) for c in (card + address).replace(" ", "").replace(".", ""))
        assert "".join(str(int(c)) for c in card.replace(" ", "")) == plain[0]
        assert ".".join(str(int(o)) for o in address.split(".")) == plain[1]
    assert re.fullmatch(r"[а-я]{4}\.[А-Я]{6}@[а-я]{5}\.рф", got[4][0]) and got[4][0] != texts[4]
    assert re.fullmatch(r"[α-ω]{5}\d@[a-z]\.gr", got[5][0]) and re.fullmatch(r"[א-ת]{3}@[a-z]\.il", got[6][0])
    assert re.fullmatch(r"[一-鿿]{2}@[a-z]\.cn", got[7][0])


def test_surrogates_of_empty_table_and_native_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string, kind string")
    out = surrogates.pseudonymize(df, "k")
    assert out.count() == 0 and "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_archives_round_trip(spark):
    big = "<p>" + "long page é " * 200
    rows = [(1, "http://a/ b", big), (2, None, big), (3, "http://c", "short"), (4, "http://d", "short"), (5, "u", None), (6, "u", ""), (None, "n", big), (9, "x", big[:-1])]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string")
    path = scratch_dir(spark, "w")
    assert warc.write_archives(pages, path) == len(rows)
    got = {r["page_id"]: r for r in warc.read_archives(spark, path).collect()}
    for i, url, html in rows:
        raw = (html or "").encode()
        other = len(raw) >= 1000 and html == big and i != 2
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", 2) if other else ("response", None))
        assert r["payload"] == (None if other else raw)
    empty = scratch_dir(spark, "w")
    assert warc.write_archives(pages.limit(0), empty) == 0 and warc.read_archives(spark, empty).count() == 0


def test_archive_layout_and_damage():
    import zstandard

    dictionary = zstandard.train_dictionary(4000, [f"<html>{i} common words of a page {i * 7}</html>".encode() * 3 for i in range(300)]).as_bytes()
    head = warc._dictionary_frame(dictionary)
    assert struct.unpack("<I", head[:4])[0] == 0x184D2A5D
    body = b"<html>common words of a page</html>"
    record = warc._record(7, "u", body, hashlib.sha1(body).hexdigest(), None, "2020-01-01T00:00:00Z")
    frame = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True).compress(record)
    assert list(warc.frames(head + frame + frame)) == [record, record] and warc.parse_record(record)[0] == 7
    for bad in (frame, head[:6], head + frame[:-5]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.frames(bad))
    for bad in (record[:-1], record.replace(b"Content-Length: 1", b"Content-Length: 2", 1), record.replace(b"common", b"uncomm"), record.replace(b"WARC-Date", b"X-Date"), b"x"):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_subsequences_come_in_bounded_blocks():
    words = ["abcdefghijklmnopqrst"[:n] for n in (3, 12, 20) for _ in range(1000)]
    blocks = list(toxicity.features(words))
    assert max(ids.size for _, ids, _ in blocks) <= toxicity.BLOCK
    assert sorted(p for places, _, _ in blocks for p in places.tolist()) == list(range(len(words)))
