"""Scalar column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the source semantics.
SENTIMENT_ORDINAL = {"negative": 0, "neutral": 1, "positive": 2}
SENTIMENT_DEFAULT = 1
BOOL_TEXT = {"true": True, "1": True, "false": False, "0": False}
SECONDS_PER_DAY = 86400
WHITESPACE = " \t\n\r\x0b\x0c"     # what str.strip() removes from ASCII text


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_lower(c) -> Column:
    """``str(x).strip().lower()``: trims every ASCII whitespace kind, not only spaces."""
    return F.lower(F.trim(_c(c).cast("string"), F.lit(WHITESPACE)))


def normalize_key(c) -> Column:
    """Join-key normalisation (string, strip, lower)."""
    return strip_lower(c)


def normalize_category(c, missing: str = "unknown") -> Column:
    """Categorical normalisation; missing -> ``unknown``."""
    return F.coalesce(strip_lower(c), F.lit(missing))


def to_double(c) -> Column:
    """Numeric coercion, bad text and NaN -> NULL."""
    d = _c(c).try_cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def to_timestamp_ntz(c, fmt: str | None = None) -> Column:
    """Timestamp coercion, bad text -> NULL (NTZ values kept as they are); with
    ``fmt`` the pattern is tried first."""
    col = _c(c)
    parsed = col.try_cast("timestamp_ntz")
    if fmt:
        parsed = F.coalesce(
            F.try_to_timestamp(col.cast("string"), F.lit(fmt)).cast("timestamp_ntz"), parsed)
    return parsed


def bool_text(c) -> Column:
    """P5: true/false/1/0 (any case) -> boolean, anything else -> false."""
    m = F.create_map(*[x for k, v in BOOL_TEXT.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, F.lower(_c(c).cast("string"))), F.lit(False))


def sentiment_ordinal(c) -> Column:
    """negative/neutral/positive -> 0/1/2, anything else -> 1."""
    m = F.create_map(*[x for k, v in SENTIMENT_ORDINAL.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, strip_lower(c)), F.lit(SENTIMENT_DEFAULT))


def elapsed_days(ref_ts: str, c) -> Column:
    """Whole elapsed 24h periods from ``c`` to ``ref_ts``, floored toward -inf.

    Not ``datediff`` (calendar days) and not ``timestampdiff`` (truncates to 0).
    """
    ref = F.unix_timestamp(F.lit(ref_ts).cast("timestamp_ntz").cast("timestamp"))
    x = F.unix_timestamp(_c(c).cast("timestamp"))
    return F.floor((ref - x) / F.lit(SECONDS_PER_DAY)).cast("bigint")


def first_present(df: DataFrame, keys, default: float) -> Column:
    """First non-null numeric among the columns that exist, else default."""
    cols = [F.col(k).cast("double") for k in keys if k in df.columns]
    return F.coalesce(*cols, F.lit(float(default)))


def round_half_even(c, digits: int = 0) -> Column:
    """Round half-to-even on the binary value scaled by 10^digits (the numeric-array
    library rule: 2.675 -> 2.67). ``bround`` rounds the decimal text instead (-> 2.68)."""
    s = float(10 ** digits)
    return F.rint(_c(c) * F.lit(s)) / F.lit(s)


def percent_text(c) -> Column:
    """``87%``; the percentage is rounded half-to-even (12.5 -> ``12%``)."""
    return F.concat(F.rint(_c(c) * 100).cast("bigint").cast("string"), F.lit("%"))


def stable_round(c, digits: int = 6) -> Column:
    """Double -> decimal(38,9) -> half-even at ``digits`` -> double. NaN/inf pass through."""
    x = _c(c)
    bad = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, x).otherwise(
        F.bround(x.cast("decimal(38,9)"), digits).cast("double"))

