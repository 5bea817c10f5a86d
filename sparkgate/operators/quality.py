"""Data-quality operators Q1-Q9 as DataFrames of findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINDINGS_SCHEMA = "check string, passed boolean, observed bigint"


def _stack(df: DataFrame, names: list[str], name_col: str, value_col: str) -> DataFrame:
    """Unpivot one wide row into (name, value) rows."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias(name_col), F.col(n).cast("bigint").alias(value_col))
        for n in names])).alias("_kv")).select(f"_kv.{name_col}", f"_kv.{value_col}")


def profile_table(df: DataFrame, id_col: str) -> DataFrame:
    """Q1: rows, columns, duplicate rows, duplicate ids, unique ids, nulls per column.

    Whole-row duplicates are counted from a grouped pass (map-side combine), not
    with ``count(distinct a, b, ...)``, which would skip rows holding a NULL.
    """
    cols = df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    aggs = [F.sum("_m").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"),
            F.sum(F.when(F.col(id_col).isNotNull(), F.col("_m"))).alias("_id_rows"),
            F.countDistinct(id_col).alias("unique_ids")]
    aggs += [F.sum(F.when(F.col(c).isNull(), F.col("_m")).otherwise(0)).alias(f"null_{c}")
             for c in cols]
    a = g.agg(*aggs).select(
        "rows", F.lit(len(cols)).alias("columns"),
        (F.col("rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        (F.coalesce(F.col("_id_rows"), F.lit(0)) - F.col("unique_ids")).alias("duplicate_ids"),
        "unique_ids", *[f"null_{c}" for c in cols])
    names = ["rows", "columns", "duplicate_rows", "duplicate_ids", "unique_ids"] + [
        f"null_{c}" for c in cols]
    return _stack(a, names, "metric", "value")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Q2: value distribution (order applied by the consumer: count desc, value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))


def expect_zero(df: DataFrame, name: str, bad: Column) -> DataFrame:
    """Q3: passes when no row satisfies ``bad``."""
    return df.agg(F.count_if(bad).alias("observed")).select(
        F.lit(name).alias("check"), (F.col("observed") == 0).alias("passed"),
        F.col("observed").cast("bigint").alias("observed"))


def expect_no_nulls(df: DataFrame, name: str) -> DataFrame:
    """Q3: no NULL cell in any listed column."""
    total = reduce(lambda a, b: a + b,
                   [F.count_if(F.col(c).isNull()) for c in df.columns])
    return df.agg(total.alias("observed")).select(
        F.lit(name).alias("check"), (F.col("observed") == 0).alias("passed"),
        F.col("observed").cast("bigint").alias("observed"))


def expect_unique(df: DataFrame, name: str, key: str) -> DataFrame:
    """Q3: unique key; observed = rows - distinct keys."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("_m"))
    return g.agg((F.sum("_m") - F.count(F.lit(1))).alias("observed")).select(
        F.lit(name).alias("check"), (F.coalesce("observed", F.lit(0)) == 0).alias("passed"),
        F.coalesce("observed", F.lit(0)).cast("bigint").alias("observed"))


def expect_same_count(after: DataFrame, before: DataFrame, name: str) -> DataFrame:
    """Q4: row count preserved across a join chain; observed = after - before."""
    a = after.agg(F.count(F.lit(1)).alias("n")).withColumn("_s", F.lit(1))
    b = before.agg((-F.count(F.lit(1))).alias("n")).withColumn("_s", F.lit(-1))
    d = a.unionByName(b).agg(F.sum("n").alias("observed"))
    return d.select(F.lit(name).alias("check"), (F.col("observed") == 0).alias("passed"),
                    F.col("observed").cast("bigint").alias("observed"))


def expectations(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys on each side and in both, via one grouped pass over the
    union (no join)."""
    u = (a.select(F.col(key).alias("k"), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
         .unionByName(b.select(F.col(key).alias("k"), F.lit(0).alias("_a"), F.lit(1).alias("_b")))
         .where(F.col("k").isNotNull()))
    per = u.groupBy("k").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return per.agg(F.sum("_a").cast("bigint").alias("n_left_keys"),
                   F.sum("_b").cast("bigint").alias("n_right_keys"),
                   F.count_if((F.col("_a") == 1) & (F.col("_b") == 1)).cast("bigint")
                   .alias("n_overlap"))


def match_rate(df: DataFrame, flag_col: str, minimum: float) -> DataFrame:
    """Q5: share of rows whose join found a partner, with the minimum-rate verdict."""
    return df.agg(F.avg(F.col(flag_col).cast("double")).alias("match_rate")).withColumn(
        "passed", F.col("match_rate") >= F.lit(minimum))


def leakage_overlap(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Q7: keys present on both sides of a split (must be empty)."""
    return train.select(key).distinct().join(test.select(key).distinct(), key, "left_semi")


def banned_columns_present(columns: list[str], banned) -> list[str]:
    """Q8: leaky columns still among the features."""
    return [c for c in columns if c in set(banned)]


def min_class_check(df: DataFrame, label: str, minimum: int = 2) -> DataFrame:
    """Q9: at least ``minimum`` known classes."""
    return df.agg(F.countDistinct(label).alias("observed")).select(
        F.lit(f"min_{minimum}_classes").alias("check"),
        (F.col("observed") >= minimum).alias("passed"),
        F.col("observed").cast("bigint").alias("observed"))


# Fixed values of sample triage (Q10): supported extensions, file-header magic
# numbers (hex) and the user-safe messages.
IMAGE_EXTENSIONS = ["png", "jpg", "jpeg", "gif", "bmp"]
AUDIO_EXTENSIONS = ["wav"]
IMAGE_MAGIC = [b"\x89PNG", b"\xff\xd8\xff", b"GIF87a", b"GIF89a", b"BM", b"RIFF"]
AUDIO_MAGIC = [b"RIFF"]
TRIAGE_MESSAGES = {
    "missing": "The requested file could not be found.",
    "invalid_path": "The file path provided is not valid.",
    "unsupported_format": "That file format is not supported.",
    "corrupted": "The file appears to be corrupted and could not be read.",
}


def triage_samples(df: DataFrame, path_col: str, content_col: str, kind: str = "image"
                   ) -> DataFrame:
    """Q10: classify each submitted sample as ok / invalid_path / missing /
    unsupported_format / corrupted (header magic), with the user-safe message.
    ``content`` NULL means the file does not exist."""
    exts = IMAGE_EXTENSIONS if kind == "image" else AUDIO_EXTENSIONS
    magic = IMAGE_MAGIC if kind == "image" else AUDIO_MAGIC
    p = F.col(path_col)
    ext = F.lower(F.regexp_extract(p, r"\.([^./]+)$", 1))
    head = F.substring(F.col(content_col).cast("binary"), 1, 8)
    bad_path = p.isNull() | (F.trim(p) == "") | p.endswith("/")
    known_header = F.lit(False)
    for m in magic:
        known_header = known_header | F.startswith(head, F.lit(m))
    status = (F.when(bad_path, "invalid_path").when(F.col(content_col).isNull(), "missing")
              .when(~ext.isin(*exts), "unsupported_format")
              .when(~known_header, "corrupted").otherwise("ok"))
    msg = F.create_map(*[x for k, v in TRIAGE_MESSAGES.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn("status", status).withColumn("message", F.element_at(msg, status))


def distinct_counts(df: DataFrame, cols: list[str], approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct values per column (exact, or HyperLogLog++ with relative error
    ``rsd`` — a mergeable sketch, no shuffle of the values)."""
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    return df.agg(F.count(F.lit(1)).alias("rows"), *[fn(c).alias(c) for c in cols])


def model_input_checks(df: DataFrame, label: str, features: list[str], banned,
                       minimum_classes: int = 2) -> DataFrame:
    """Q3 + Q8 + Q9 before training: required features present, no leaky column among
    the features, at least ``minimum_classes`` classes, no NULL in the features."""
    spark = df.sparkSession
    missing = [c for c in features if c not in df.columns]
    leaks = banned_columns_present(features, banned)
    schema_rows = spark.createDataFrame(
        [("required_features_present", not missing, len(missing)),
         ("no_leaky_features", not leaks, len(leaks))], FINDINGS_SCHEMA)
    present = [c for c in features if c in df.columns]
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in present]) \
        if present else F.lit(0)
    data_rows = df.agg(F.countDistinct(label).alias("_k"), nulls.alias("_nulls")).select(
        F.explode(F.array(
            F.struct(F.lit(f"min_{minimum_classes}_classes").alias("check"),
                     (F.col("_k") >= minimum_classes).alias("passed"),
                     F.col("_k").cast("bigint").alias("observed")),
            F.struct(F.lit("features_not_null").alias("check"), (F.col("_nulls") == 0)
                     .alias("passed"), F.col("_nulls").cast("bigint").alias("observed"))))
        .alias("r")).select("r.*")
    return schema_rows.unionByName(data_rows)


class ExpectationError(AssertionError):
    """One or more expectations failed (all failures are listed)."""


def assert_expectations(findings: DataFrame) -> DataFrame:
    """Q3 optional raise: fail with every failed check listed; the findings table has
    one row per check (bounded), so it is safe to bring to the driver."""
    failed = [f"{r['check']} (observed {r['observed']})"
              for r in findings.where(~F.col("passed")).collect()]
    if failed:
        raise ExpectationError("failed expectations: " + "; ".join(failed))
    return findings
