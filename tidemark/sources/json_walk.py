"""Small walkers over one parsed JSON value of unknown shape."""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator
from datetime import date, datetime
from zoneinfo import ZoneInfo

from tidemark import fixed_values as V

_ZONE = ZoneInfo(V.ZONE)
_FULL_DATE = re.compile(V.FULL_DATE_PATTERN)


def load(text: str):
    """Parsed value, or None where the text is not JSON or nested beyond what the parser can read."""
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return None


def readable(text: str) -> bool:
    """Whether a text is JSON; repeated keys and NaN are."""
    try:
        json.loads(text)
    except (ValueError, RecursionError):
        return False
    return True


@functools.lru_cache(4096)  # documents repeat few names
def _plain(key: str) -> str:
    return re.sub(r"[_\-\s]", "", key).lower()


_ROLES = {role: [_plain(k) for k in keys] for role, keys in
          (("date", V.DATE_KEYS), ("price", V.PRICE_KEYS), ("count", V.COUNT_KEYS))}


def whole(value) -> int | None:
    """Whole number of a JSON value; None where there is none."""
    if value is None:
        return None
    if isinstance(value, (int, float)):
        return int(value) if abs(value) < 2 ** 63 else None
    text = unicodedata.normalize("NFKC", str(value)).strip()
    digits = re.sub("[^0-9]", "", text)
    if not digits or len(digits.lstrip("0")) > 19 or int(digits[-19:]) >= 2 ** 63:
        return None
    digits = digits[-19:]
    return -int(digits) if text[0] in V.MINUS_SIGNS else int(digits)


def day(value) -> date | None:
    """Date of a JSON value: epoch seconds or milliseconds, or text with a full date."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        seconds = value / 1000.0 if value > 1e11 else value
        try:
            return datetime.fromtimestamp(seconds, _ZONE).date() if seconds > 1e8 else None
        except (ValueError, OverflowError, OSError):
            return None  # beyond the calendar
    return _day_in(str(value or ""))


@functools.lru_cache(65536)  # and few dates
def _day_in(text: str) -> date | None:
    found = _FULL_DATE.search(unicodedata.normalize("NFKC", text))
    try:
        return date(*map(int, found.groups())) if found else None
    except ValueError:
        return None


def points(values: list) -> list[tuple]:
    """(date, price, count) of the dicts that have a date and a price; a missing count is None."""
    out = []
    for item in values:
        if not isinstance(item, dict):
            continue
        by_name = {_plain(k): v for k, v in item.items()}
        pick = lambda role: next((by_name[k] for k in _ROLES[role] if k in by_name), None)
        when, price = day(pick("date")), whole(pick("price"))
        if when is not None and price is not None:
            out.append((when, price, whole(pick("count"))))
    return out


def _children(value, path: str):
    if isinstance(value, dict):
        return ((f"{path}.{k}" if path else str(k), v) for k, v in value.items())
    if isinstance(value, list):
        return ((f"{path}[{i}]", v) for i, v in enumerate(value))
    return ()


def _walk(value, enter) -> Iterator:
    """What ``enter(value, path)`` finds, in document order; it returns (results, whether to go deeper).

    The stack is explicit, so any depth that the parser can read is walked.
    """
    stack = [iter([("", value)])]
    while stack:
        path, here = next(stack[-1], (None, None))
        if path is None:
            stack.pop()
            continue
        results, deeper = enter(here, path)
        yield from results
        if deeper:
            stack.append(iter(_children(here, path)))


def series(value) -> Iterator[tuple[str, list[tuple]]]:
    """(path, points) of every array that reads as a series of two points or more."""
    def enter(here, path):
        found = points(here) if isinstance(here, list) else ()
        return ([(path or "$", found)], False) if len(found) >= 2 else ((), True)

    return _walk(value, enter)


_CHART_PRICES = [column for _, column in V.CHART_PRICE_COLUMNS]


def _is_wide(rows) -> bool:
    """A list of dicts of which one has a date next to a wide price column."""
    names = [r.keys() for r in rows if isinstance(r, dict)] if isinstance(rows, list) else []
    complete = bool(names) and len(names) == len(rows)
    return complete and any("date" in n and not n.isdisjoint(_CHART_PRICES) for n in names)


def charts(value) -> Iterator[tuple[str, list[dict]]]:
    """(path, rows) of arrays of dicts with a date and wide price columns, nested ones too."""
    return _walk(value, lambda here, path: ([(path, here)] if _is_wide(here) else (), True))


def item_records(value) -> Iterator[dict]:
    """Dicts with a slug and a name; a match is not searched further."""
    def enter(here, path):
        fields = here if isinstance(here, dict) else {}
        match = fields.get("strSlug") and fields.get("strName")
        return ([fields], False) if match else ((), True)

    return _walk(value, enter)
