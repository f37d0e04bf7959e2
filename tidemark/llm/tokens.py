"""Token ids of whole texts with a public byte-level BPE tokenizer."""

from __future__ import annotations

import os
import re

import numpy as np

DEFAULT = "byte_bpe_50k.json"


def tokenizer_path(name: str = DEFAULT) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Full stop, comma and line break cut off from the letters before them.
_SIGNS = ("\0.", "\0,", "\0\n")


class Memory:
    """Two generations of at most ``limit`` entries: what is not asked for during one generation is forgotten."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}
        self.flagged, self.old_flagged = set(), set()

    def missing(self, keys: set) -> list:
        """Keys that are not known; known ones are in ``new`` afterwards."""
        unseen = keys.difference(self.new)
        if len(self.new) + len(unseen) > self.limit:
            self.old, self.new = self.new, {}
            self.old_flagged, self.flagged = self.flagged, set()
            unseen = keys
        out = unseen.difference(self.old)
        again = unseen.difference(out)
        self.new.update(zip(again, map(self.old.__getitem__, again)))
        self.flagged |= again & self.old_flagged
        return list(out)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to encoding each whole text.

    The pre-tokenizer of a byte-level BPE never joins across a single space between two non-space
    characters, around a single line break, nor around a lone full stop or comma, so plain texts are cut there:
    a part after a space stands as it is, one that follows nothing is marked with ``\\1``, a stop, comma or line
    break with ``\\0``. Parts not seen lately are encoded together. Texts where a cut might not be one (other
    white space, marks side by side) are encoded whole. Memory is bounded by ``limit`` parts, whatever the texts.
    """

    _marked = re.compile(r"([^\W\d_]+)([^\w\s]+)").fullmatch

    def __init__(self, path: str, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        if type(self.tool.pre_tokenizer).__name__ != "ByteLevel" or self.tool.normalizer is not None:
            raise ValueError("a byte-level tokenizer without a normalizer is expected")
        self.memory = Memory(limit)
        size = self.tool.get_vocab_size(with_added_tokens=True)
        self.leads = np.array([(self.tool.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.newline = int(np.frombuffer(self.whole("\n"), "<u4")[0])

    def whole(self, text: str) -> bytes:
        return np.array(self.tool.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str], keys: list[str], lead: str) -> None:
        """Ids of runs of letters, each with a leading space or none, found by encoding them as one text."""
        if not words:
            return
        text = lead + (lead or "\n").join(words)
        ids = np.array(self.tool.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        if lead:
            first = np.flatnonzero(self.leads[ids])
            end = np.append(first[1:], len(ids))
        else:
            at = np.flatnonzero(ids == self.newline)
            first, end = np.append(0, at + 1), np.append(at, len(ids))
        raw = ids.tobytes()
        if len(first) == len(words):
            self.memory.new.update(zip(keys, map(raw.__getitem__, map(slice, (4 * first).tolist(), (4 * end).tolist()))))
        else:
            self.memory.new.update((k, self.whole(lead + w)) for k, w in zip(keys, words))

    def _learn_parts(self, parts: set) -> None:
        spaced, bare, other, marked, memory = [], [], [], {}, self.memory
        for part in memory.missing(parts):
            if part.isalpha():
                spaced.append(part)
            elif part[:1] == "\1" and part[1:].isalpha():
                bare.append(part)
            elif not _stands_alone(part):
                memory.new[part] = None
            else:
                if not part[-1].isalnum() and part not in _SIGNS:
                    memory.flagged.add(part)
                m = self._marked(part)
                if m and m[1].isalpha():
                    marked[part] = (m[1], m[2])
                else:
                    other.append(part)
        if marked:
            have = set(spaced)
            spaced += [w for w in {w for w, _ in marked.values()} if w not in memory.new and w not in have]
        self._learn(spaced, spaced, " ")
        self._learn([p[1:] for p in bare], bare, "")
        tails = list({m for _, m in marked.values()})
        texts = [p[1:] if p[0] in "\0\1" else " " + p for p in other]
        made = self._encode_all(texts + tails)
        memory.new.update(zip(other, made))
        ends = dict(zip(tails, made[len(other):]))
        memory.new.update((p, memory.new[w] + ends[m]) for p, (w, m) in marked.items())

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        made = self.tool.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, dtype="<u4").tobytes() for e in made]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null and empty texts have none. Long texts go in runs of bounded size."""
        out, held, size = [], [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size > 400_000:
                out += self._run(held)
                held, size = [], 0
        return out + self._run(held)

    def _run(self, texts: list[str]) -> list[bytes]:
        cut = [_cut(t) if t else () for t in texts]
        every = set().union(*filter(None, cut))
        self._learn_parts(every)
        known, flagged, out, entire = self.memory.new, self.memory.flagged & every, [], []
        for i, parts in enumerate(cut):
            if parts and flagged and not flagged.isdisjoint(parts) and any(
                    b[:2] in ("\0.", "\0,") and a in flagged for a, b in zip(parts, parts[1:])):
                parts = None
            try:
                out.append(b"".join(map(known.__getitem__, parts)))
            except TypeError:  # not cut, or a part that does not stand alone
                out.append(None)
                entire.append(i)
        for i, ids in zip(entire, self._encode_all([texts[i] for i in entire])):
            out[i] = ids
        return out


def _cut(text: str) -> list[str] | None:
    for marks in ("\0", "\1", "..", ",,", ".,", ",."):
        if marks in text:
            return None
    return ("\1" + text.replace(".", " \0.").replace(",", " \0,").replace("\n", " \0\n \1")).split(" ")


def _stands_alone(part: str) -> bool:
    """Whether a part is no sign of white space next to other white space; if it ends with a mark, what follows counts too."""
    return part in _SIGNS or part != "\1" and part.split() == [part]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
