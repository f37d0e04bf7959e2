"""Outermost JSON values inside free text, in time linear in the text."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

_DECODER = json.JSONDecoder()
#: An opening that something may follow; others begin no value and are stepped over without a call.
_OPENING = re.compile(r'\[(?=[ \t\n\r]*+[]\[{"0-9tfnNI-])|\{(?=[ \t\n\r]*+["}])')
_TOKEN = re.compile(
    r"[ \t\n\r]*+(?:"
    r'("(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+")'
    r"|([\[{])|([\]}])|(,)|(:)"
    r"|(-?(?:0|[1-9][0-9]*+)(?![.eE][-+0-9]))"
    r"|(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][-+]?[0-9]++)?+|true|false|null|NaN|-?Infinity))")
_STRING, _OPEN, _CLOSE, _COMMA, _COLON, _WHOLE, _PLAIN = range(1, 8)

#: The parser is tried at so many openings that turn out broken: each failure makes it count lines from the start of the text.
_TRIES = 32

#: What may come next inside a container.
_FIRST, _ITEM, _AFTER, _NAME, _MEAN = range(5)


def scan(text: str) -> Iterator[str]:
    """Outermost JSON values in ``text``, leftmost first, as text; an opening that begins none is stepped over.

    A value that ends is read by the parser. Where one does not, ``_settle`` reads on from its opening to the
    place that breaks it and settles every opening on the way at once: those still open break at the same place, those
    closed before are values. Only openings inside strings of a broken value are read again, by the other
    reading of its quotes, so no character is read more than a few times.
    """
    settled: dict[int, int] = {}
    broken: bytearray | None = None
    tries = _TRIES
    at = _OPENING.search(text)
    while at:
        start, end = at.start(), None
        if start in settled:
            end = settled.pop(start)
        elif tries:
            try:
                end = _DECODER.raw_decode(text, start)[1]
            except (ValueError, RecursionError):
                tries -= 1
        if end is None:
            if broken is None:
                broken = bytearray(len(text))
            end = _settle(text, start, settled, broken)
        if end is not None:
            yield text[start:end]
        else:
            end = start + 1
        if broken is not None and end < len(text) and broken[end]:
            end = broken.find(0, end)
            end = len(text) if end < 0 else end
        at = _OPENING.search(text, end)
        while at and broken is not None and broken[at.start()]:
            end = broken.find(0, at.start())
            at = _OPENING.search(text, end) if end >= 0 else None


def _settle(text: str, start: int, settled: dict[int, int], broken: bytearray) -> int | None:
    """End of the value at ``start``, or None; then every opening it runs over is in ``settled`` (its end) or ``broken``."""
    opens, closed = [start], []
    state, at, match, is_object = _FIRST, start + 1, _TOKEN.match, text[start] == "{"
    digits = sys.get_int_max_str_digits() or sys.maxsize
    while True:
        token = match(text, at)
        if token is None:
            break
        kind, at = token.lastindex, token.end()
        if kind == _CLOSE:
            if not (state == _FIRST or state == _AFTER) or (text[at - 1] == "}") != is_object:
                break
            begun = opens.pop()
            if not opens:
                return at
            while closed and closed[-1][0] > begun:  # inside this one
                closed.pop()
            closed.append((begun, at))
            is_object = text[opens[-1]] == "{"
            state = _AFTER
        elif kind == _COMMA:
            if state != _AFTER:
                break
            state = _NAME if is_object else _ITEM
        elif kind == _COLON:
            if state != _MEAN:
                break
            state = _ITEM
        elif state == _AFTER or state == _MEAN:
            break
        elif state == _NAME or (state == _FIRST and is_object):
            if kind != _STRING:
                break
            state = _MEAN
        elif kind == _OPEN:
            begun = at - 1
            if broken[begun]:
                break
            if begun in settled:
                at = settled[begun]
                closed.append((begun, at))
                state = _AFTER
            else:
                opens.append(begun)
                is_object = text[begun] == "{"
                state = _FIRST
        elif kind == _WHOLE and at - token.start(_WHOLE) > digits:
            break  # a whole number longer than the parser takes
        else:
            state = _AFTER
    for begun in opens:
        broken[begun] = 1
    settled.update(closed)
    return None
