"""Numbers, differences and dates out of text. A missing value is null, never 0."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.functions.text import col, let, nfkc, strip

_MINUS = "[" + re.escape(V.MINUS_SIGNS) + "]"
_SIGN = "[" + re.escape(V.MINUS_SIGNS) + "+]"
_SIGN_OR_EITHER = "[" + re.escape(V.MINUS_SIGNS) + "+±]"
_PCT = rf"(?U)({_SIGN}?)\s*([0-9][0-9,]*(?:\.[0-9]+)?)\s*%"
_YEN = rf"(?U)({_SIGN_OR_EITHER}?)\s*([0-9][0-9,]*)\s*円"
_PLAIN = rf"(?U)({_SIGN_OR_EITHER}?)\s*([0-9][0-9,]*)"
_FULL_DATE = "(?U)" + V.FULL_DATE_PATTERN
_DAY_OF_YEAR = "(?U)" + V.DAY_OF_YEAR_PATTERN


def _clean(c: Column | str) -> Column:
    return strip(nfkc(c))


def parse_price(c: Column | str) -> Column:
    """Whole number in a text: ``152,443円`` -> 152443, ``-`` -> null, ``0`` -> 0."""
    def number(text: Column) -> Column:
        digits = F.regexp_replace(text, "[^0-9]", "").try_cast("bigint")
        return F.when(text.rlike("^" + _MINUS), -digits).otherwise(digits)

    return let(_clean(c), number)


def whole_number(c: Column | str) -> Column:
    """Numeric input of :func:`parse_price`: truncated toward zero, NaN and infinities null."""
    # whole numbers are taken as they are: a double has only 53 bits for them
    return F.coalesce(F.when(col(c).cast("string").rlike(r"^[-+]?[0-9]+$"), col(c).cast("string").try_cast("bigint")),
                      col(c).cast("double").try_cast("bigint"))


def _signed(text: Column, pattern: str, as_type: str) -> Column:
    number = F.regexp_replace(F.regexp_extract(text, pattern, 2), ",", "").try_cast(as_type)
    return F.when(F.regexp_extract(text, pattern, 1).rlike(_MINUS), -number).otherwise(number)


def parse_pct(c: Column | str) -> Column:
    """First percentage in a text; ▲ and △ are minus signs."""
    return let(_clean(c), lambda text: _signed(text, _PCT, "double"))


def parse_diff(c: Column | str) -> Column:
    """Struct(amount, pct): the number before 円, else the first one before "("."""
    def both(text: Column) -> Column:
        head = F.split_part(text, F.lit("("), F.lit(1))
        amount = (F.when(text.rlike(_YEN), _signed(text, _YEN, "bigint"))
                  .otherwise(_signed(head, _PLAIN, "bigint")))
        return F.struct(amount.alias("amount"), _signed(text, _PCT, "double").alias("pct"))

    return let(_clean(c), both)


def parse_date(c: Column | str, default_year: int | Column | None = None) -> Column:
    """Date in a text; without a year only if ``default_year`` is given; impossible -> null."""
    def dated(text: Column) -> Column:
        full = F.regexp_extract(text, _FULL_DATE, 0)
        result = F.when(full != "", F.regexp_replace(full, _FULL_DATE, "$1-$2-$3"))
        if default_year is not None:
            year = (F.lit(default_year) if isinstance(default_year, int) else default_year).cast("string")
            short = F.regexp_extract(text, _DAY_OF_YEAR, 0)
            result = result.when(short != "", F.concat_ws(
                "-", F.lpad(year, 4, "0"), F.regexp_replace(short, _DAY_OF_YEAR, "$1-$2")))
        return result.try_cast("date")

    return let(_clean(c), dated)


def epoch_date(c: Column | str) -> Column:
    """Japan date of an epoch number: above 1e11 milliseconds, above 1e8 seconds, else null."""
    value = col(c).cast("double")
    seconds = F.when(value > 1e11, value / 1000.0).otherwise(value)
    return F.when(seconds > 1e8, to_zone(F.timestamp_seconds(seconds)).cast("date"))


def to_zone(ts: Column | str) -> Column:
    """Wall-clock time in Japan, independent of host and session zones."""
    return F.convert_timezone(F.lit("UTC"), F.lit(V.ZONE), F.to_utc_timestamp(
        col(ts), F.current_timezone()).cast("timestamp_ntz"))


def stamp(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in Japan time, for export."""
    return F.date_format(to_zone(ts), V.STAMP_FORMAT)


def pct_change(new: Column | str, old: Column | str) -> Column:
    """Percent change; null for a null operand or an old value of 0."""
    return (F.try_divide(col(new).cast("double"), col(old).cast("double")) - 1.0) * 100.0


def rounded_texts(values: np.ndarray, digits: int) -> np.ndarray:
    """Texts of doubles rounded to ``digits`` places, half to even on the exact binary value; blank where not finite.

    The product with the power of ten is taken without error as a sum of two doubles, so ties are seen as they are.
    """
    finite = np.isfinite(values)
    v = np.where(finite, values, 0.0)
    scale = 10.0 ** digits
    with np.errstate(over="ignore", invalid="ignore"):
        high = v * scale
        split = lambda x: (lambda c: c - (c - x))(134217729.0 * x)
        v1, s1 = split(v), split(np.float64(scale))
        v2, s2 = v - v1, scale - s1
        low = ((v1 * s1 - high) + v1 * s2 + v2 * s1) + v2 * s2
        whole = np.floor(high)
        over = (high - whole) - 0.5
        odd = np.mod(whole, 2.0) == 1.0
        up = (over > 0) | ((over == 0) & ((low > 0) | ((low == 0) & odd)))
        near = np.copysign((whole + up) / scale, v)
    # beyond 2**50 units a double has no places left to round, or so few that it is read by itself
    large = ~(np.abs(v) < 2.0 ** 50 / scale) | ((v != 0) & (np.abs(v) < 1e-280))
    out = near.astype(str).astype(object)
    for i in np.flatnonzero(large & finite):
        out[i] = str(round(float(v[i]), digits))
    out[~finite] = ""
    return out


def fmt(c: Column | str, digits: int = 2) -> Column:
    """Export text of a double: half-even on the exact binary value, blank for null, NaN, Inf.

    Spark's own rounding works on the decimal text of a double (2.675 -> 2.68), so
    this one step runs in an Arrow UDF, on whole columns. It belongs at export: one row per series.
    """

    @F.pandas_udf("string")
    def _fmt(values: pd.Series) -> pd.Series:
        return pd.Series(rounded_texts(values.to_numpy(dtype=float, na_value=float("nan")), digits))

    return _fmt(col(c).cast("double"))
