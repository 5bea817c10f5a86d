"""Cleaning operators: P1-P9, P13, T1, P10 (winsorize)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (normalize_category, normalize_key, strip_lower, to_double,
                                 to_timestamp_ntz)
from ..session import materialize
from .observed import written
from .quantiles import quantile_values


def distinct_keep_first(df: DataFrame, ord_col: str = "src_ord") -> DataFrame:
    """Whole-row distinct (NULLs equal) keeping the first source ordinal.

    Grouping on every non-ordinal column is a map-side-combined aggregate, so
    repeated rows collapse before the shuffle.
    """
    others = [c for c in df.columns if c != ord_col]
    if ord_col not in df.columns:
        return df.dropDuplicates()
    return df.groupBy(*others).agg(F.min(ord_col).alias(ord_col)).select(*df.columns)


def rename_if_present(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename only the columns that exist."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def normalize_profiles(raw: DataFrame) -> DataFrame:
    """P1-P3 on the social-profile table (before distinct)."""
    return raw.select(
        normalize_key("customer_id").alias("customer_id"),
        strip_lower("social_media_platform").alias("social_media_platform"),
        to_double("engagement_score").alias("engagement_score"),
        to_double("purchase_interest_score").alias("purchase_interest_score"),
        strip_lower("review_sentiment").alias("review_sentiment"),
        F.col("src_ord").cast("bigint").alias("src_ord"))


def distinct_profiles(raw: DataFrame) -> DataFrame:
    """Normalised, distinct rows with the categories filled; numbers keep their NULLs. What
    counts rows, keys or categories needs no more."""
    d = distinct_keep_first(normalize_profiles(raw))
    return d.withColumns({c: normalize_category(c) for c in ("social_media_platform", "review_sentiment")})


def clean_profiles(raw: DataFrame, exact: bool = True) -> DataFrame:
    """Normalise -> distinct -> fill: categoricals ``unknown``, numerics with the median
    of the deduplicated table (P6). The medians are two scalars (bounded); NULLs are counted
    in the written table, and only a column that has one costs a median."""
    cols = ["engagement_score", "purchase_interest_score"]
    d, nulls = written(distinct_keep_first(normalize_profiles(raw)), "profiles-dedup",
                       {c: F.count_if(F.col(c).isNull()) for c in cols})
    need = [c for c in cols if nulls[c]]
    med = quantile_values(d, need, [0.5], exact) if need else {}
    fill = {c: F.coalesce(c, F.lit(med.get(c, [None])[0]).cast("double")).alias(c) for c in cols}
    return d.select(
        "customer_id",
        normalize_category("social_media_platform").alias("social_media_platform"),
        fill["engagement_score"], fill["purchase_interest_score"],
        normalize_category("review_sentiment").alias("review_sentiment"),
        "src_ord")


def median_fill_values(df: DataFrame, cols: list[str], exact: bool = True) -> dict:
    """P6 medians, computed only for columns that have a NULL to fill (one cheap
    counting pass first; the order-statistic job runs only when needed)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    need = [c for c in cols if counts[c]]
    med = quantile_values(df, need, [0.5], exact) if need else {}
    return {c: med.get(c, [None]) for c in cols}


def normalize_transactions(raw: DataFrame) -> DataFrame:
    """Key normalised, then T1 on raw values, then P3/P4 coercion and category lower."""
    keyed = raw.withColumn("customer_id", normalize_key("customer_id"))
    d = distinct_keep_first(keyed)
    return (d.withColumn("amount", to_double("amount"))
             .withColumn("timestamp", to_timestamp_ntz("timestamp"))
             .withColumn("category", strip_lower("category")))


def with_reject_reason(tx: DataFrame) -> DataFrame:
    """First failing check per row (``bad_amount`` before ``bad_timestamp``)."""
    return tx.withColumn(
        "reject_reason",
        F.when(F.col("amount").isNull() | (F.col("amount") <= 0), F.lit("bad_amount"))
        .when(F.col("timestamp").isNull(), F.lit("bad_timestamp")))


def valid_transactions(raw: DataFrame) -> DataFrame:
    """Normalised transactions that pass P9."""
    t = with_reject_reason(normalize_transactions(raw))
    return t.where(F.col("reject_reason").isNull()).drop("reject_reason")


def reject_counts(raw: DataFrame) -> DataFrame:
    """P9 report: rows per reason, ``ok`` for kept rows."""
    t = with_reject_reason(normalize_transactions(raw))
    return t.groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def winsor_bounds(df: DataFrame, col: str, lo_q: float = 0.01, hi_q: float = 0.99,
                  exact: bool = True) -> tuple[float, float]:
    lo, hi = quantile_values(df, col, [lo_q, hi_q], exact)[col]
    return lo, hi


def winsorize(df: DataFrame, col: str, lo: float, hi: float,
              flag_col: str | None = None) -> DataFrame:
    """P10: clip to [lo, hi]; NULL stays NULL (``greatest`` would skip it)."""
    c = F.col(col)
    out = df
    if flag_col:
        out = out.withColumn(flag_col, (c < F.lit(lo)) | (c > F.lit(hi)))
    return out.withColumn(col, F.when(c.isNull(), c).otherwise(
        F.greatest(F.least(c, F.lit(hi)), F.lit(lo))))


#: Q3 on valid transactions: rows that must not be.
TRANSACTION_FAULTS = {
    "tx_customer_id_not_null": "customer_id IS NULL",
    "tx_amount_positive": "amount IS NULL OR amount <= 0",
    "tx_timestamp_not_null": "timestamp IS NULL",
}


def written_transactions(raw: DataFrame) -> tuple[DataFrame, dict]:
    """The valid transactions, written once, with the number of rows at fault per check."""
    return written(valid_transactions(raw), "transactions-valid",
                   {k: F.count_if(F.expr(bad)) for k, bad in TRANSACTION_FAULTS.items()})


def winsorized(valid: DataFrame, exact: bool = True) -> DataFrame:
    lo, hi = winsor_bounds(valid, "amount", exact=exact)
    return winsorize(valid, "amount", lo, hi)


def clean_transactions(raw: DataFrame, exact: bool = True) -> DataFrame:
    """Distinct -> coerce -> filter -> winsorize on the survivors only. The survivors are
    written once; the order-statistic passes then read only ``amount``."""
    return winsorized(materialize(valid_transactions(raw), "transactions-valid"), exact)


def fill_typed_defaults(df: DataFrame, numeric=0, text: str = "Unknown") -> DataFrame:
    """Numerics -> 0, strings -> ``Unknown`` (columns chosen from the schema)."""
    num = [f.name for f in df.schema.fields
           if f.dataType.typeName() in ("double", "float", "integer", "long", "short",
                                        "decimal")]
    txt = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    out = df
    if num:
        out = out.fillna(numeric, subset=num)
    if txt:
        out = out.fillna(text, subset=txt)
    return out


def drop_if_present(df: DataFrame, cols) -> DataFrame:
    """Drop target / key / leaky columns that exist."""
    return df.drop(*[c for c in cols if c in df.columns])


def split_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """(categorical columns, numeric columns) from the schema."""
    cat, num = [], []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t == "string":
            cat.append(f.name)
        elif t in ("double", "float", "integer", "long", "short", "decimal"):
            num.append(f.name)
    return cat, num
