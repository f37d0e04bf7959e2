"""Normalisation of codes and names, notes, pattern lookups.

Codes and names use different dash sets on purpose: the long-vowel mark is a
dash inside a code and a letter inside a name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as V

# Unicode white space and the ASCII separators other than the plain space.
_ODD_SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_SPACES = " " + _ODD_SPACES
_ASCII_MARKS = "!\"#$%&'()*+,-./:;<=>?@\\^_`{|}~"
_NORMALIZER = "com.ibm.icu.text.Normalizer"

_jvm_nfkc: dict[str, bool] = {}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Column | str) -> Column:
    """Text with null as the empty string."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Trim every Unicode space (``trim`` removes only U+0020)."""
    return F.btrim(col(c), F.lit(_SPACES))


def _nfkc_arrow(text: Column) -> Column:
    @F.pandas_udf("string")
    def normalized(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKC")

    return normalized(text)


def _has_jvm_nfkc() -> bool:
    """Whether the Unicode library that Spark ships for collations is on the class path."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return False
    app = spark.conf.get("spark.app.id", "")
    if app not in _jvm_nfkc:
        try:
            spark.sql(f"SELECT java_method('{_NORMALIZER}', 'compose', 'x', true)").schema
            _jvm_nfkc[app] = True
        except Exception:
            _jvm_nfkc[app] = False
    return _jvm_nfkc[app]


def nfkc(c: Column | str) -> Column:
    """Compatibility composition; null becomes "".

    Plain ASCII is its own normal form and skips the call. ``java_method`` keeps
    the rest in the JVM; where it cannot be used an Arrow UDF does the same work.
    Spark treats the call as non-deterministic, so filters written after it are
    not pushed below it: filter first, normalise after.
    """
    text = blank(c)
    if not _has_jvm_nfkc():
        return _nfkc_arrow(text)
    composed = F.java_method(F.lit(_NORMALIZER), F.lit("compose"), text, F.lit(True))
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(composed)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _translate(c: Column, *pairs: tuple[str, str]) -> Column:
    """One pass over the text: each character set to one character, or to nothing (given last)."""
    found = "".join(chars for chars, _ in pairs)
    return F.translate(c, found, "".join(to * len(chars) for chars, to in pairs))


def normalize_code(c: Column | str) -> Column:
    """NFKC, every dash and long-vowel mark to "-", no spaces, upper case."""
    return F.upper(_translate(nfkc(c), (V.COMMON_HYPHENS + V.LONG_VOWEL_MARKS, "-"), (_SPACES, "")))


def normalize_name(c: Column | str) -> Column:
    """NFKC, common dashes to "-", space runs to one space. Long vowels survive."""
    return _squeeze(_translate(nfkc(c), (V.COMMON_HYPHENS, "-"), (_ODD_SPACES, " ")))


def squeeze_spaces(c: Column) -> Column:
    """Every run of white space to one plain space, none at the ends."""
    return _squeeze(_translate(c, (_ODD_SPACES, " ")))


def _squeeze(c: Column) -> Column:
    """Runs of plain spaces to one, none at the ends; most texts have no run to look for."""
    return F.trim(let(c, lambda t: F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, "  +", " ")).otherwise(t)))


def code_view(c: Column | str) -> Column:
    """Comparison form of a name under the code dash rule; never shown."""
    return F.upper(_translate(nfkc(c), (V.COMMON_HYPHENS + V.LONG_VOWEL_MARKS, "-")))


_OPEN, _CLOSE = r"[（(\[【]", r"[)）\]】]"
_MEMO = rf"(?U){_OPEN}?\s*(?:{'|'.join(V.STORE_MEMO_WORDS)})\s*{_CLOSE}?"
_EMPTY_BRACKETS = rf"(?U){_OPEN}\s*{_CLOSE}"


def strip_store_memo(c: Column | str) -> Column:
    without = F.regexp_replace(blank(c), _MEMO, " ")
    return squeeze_spaces(F.regexp_replace(without, _EMPTY_BRACKETS, " "))


def build_search_key(code: Column | str, name: Column | str) -> Column:
    """Code and name in one key; the name alone when it already holds the code."""
    def joined(pair: Column) -> Column:
        c, n = pair["c"], pair["n"]
        return (F.when(c == "", n)
                .when(n == "", c)
                .when(F.contains(code_view(n), c), n)
                .otherwise(F.concat_ws(" ", c, n)))

    return let(F.struct(normalize_code(code).alias("c"),
                        strip_store_memo(normalize_name(name)).alias("n")), joined)


def compact_name(c: Column | str) -> Column:
    """Letters and digits only, bracketed parts dropped - for containment tests.

    The dashes and spaces that a name is tidied of are dropped here in any case.
    """
    lowered = F.lower(nfkc(c))
    bare = F.regexp_replace(lowered, r"\[[^\]]*\]", "")
    # the common marks go in one plain pass, which leaves the pattern little to replace
    return F.regexp_replace(_translate(bare, (_SPACES + _ASCII_MARKS, "")), r"[^0-9a-zぁ-んァ-ヶ一-龠々]+", "")


def compact_overlap(a: Column | str, b: Column | str) -> Column:
    """One compact name holds the other and neither is blank."""
    left, right = col(a), col(b)
    return ((left != "") & (right != "")
            & (F.contains(left, right) | F.contains(right, left)))


def extract_code(c: Column | str) -> Column:
    """First ``NNN/NNN`` code in the text, "" if none."""
    found = F.regexp_extract(nfkc(c), "(?U)" + V.CODE_PATTERN, 1)
    return F.replace(found, F.lit(" "), F.lit(""))


def set_of_code(c: Column | str) -> Column:
    """Text after the last "/" of a code; "" for a blank code."""
    return F.element_at(F.split(blank(c), "/"), -1)


def guess_condition(c: Column | str) -> Column:
    """Condition named by the first hint group found in the path."""
    def pick(path: Column) -> Column:
        result = F.lit(V.CONDITION_UNKNOWN)
        for label, hints in reversed(V.CONDITION_HINTS):
            hit = path.rlike("|".join(re.escape(h.lower()) for h in hints))
            result = F.when(hit, F.lit(label)).otherwise(result)
        return result

    return let(F.lower(blank(c)), pick)


def status_from_stock(stock: Column | str, closed_flag: Column | str) -> Column:
    closed = F.coalesce(col(closed_flag), F.lit(False)) | F.contains(blank(stock), F.lit(V.STATUS_CLOSED))
    return F.when(closed, V.STATUS_CLOSED).otherwise(V.STATUS_OPEN)


def digits_only(c: Column | str) -> Column:
    """ASCII digits only, no NFKC: full-width digits vanish."""
    return F.regexp_replace(blank(c), "[^0-9]", "")


def first_match(text: Column | str, patterns: Sequence[str]) -> Column:
    """Digits of group 1 of the first pattern that matches, "" if none does."""
    body = blank(text)
    hit = F.lit("")
    for pattern in reversed(list(patterns)):
        hit = F.when(body.rlike(pattern), digits_only(F.regexp_extract(body, pattern, 1))).otherwise(hit)
    return hit


def _note_parts(note: Column | str) -> Column:
    return F.filter(F.transform(F.split(blank(note), "/"), lambda p: strip(p)), lambda p: p != "")


def add_note(note: Column | str, text: Column | str) -> Column:
    """Append a remark unless it is there already."""
    text = F.lit(text) if isinstance(text, str) else text
    parts = _note_parts(note)
    return F.array_join(
        F.when(F.array_contains(parts, text), parts).otherwise(F.array_append(parts, text)), " / ")


def drop_note(note: Column | str, text: Column | str) -> Column:
    """Remove every copy of a remark."""
    text = F.lit(text) if isinstance(text, str) else text
    return F.array_join(F.filter(_note_parts(note), lambda p: p != text), " / ")


def trend_mark(trend: Column | str) -> Column:
    out = F.lit(V.TREND_MARK_DEFAULT)
    for label, mark in V.TREND_MARKS.items():
        out = F.when(col(trend) == label, mark).otherwise(out)
    return out


def trend_urgency(trend: Column | str) -> Column:
    out = F.lit(V.TREND_URGENCY_DEFAULT)
    for label, rank in V.TREND_URGENCY.items():
        out = F.when(col(trend) == label, rank).otherwise(out)
    return out


def upsert_key(c: Column | str) -> Column:
    """Key part as trimmed text; null is blank, 0 is a value."""
    return F.coalesce(strip(col(c).cast("string")), F.lit(""))
