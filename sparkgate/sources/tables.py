"""Table sources and sinks: S1-S4, S7-S9, S11."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TESTDATA_TABLES = ("region nation customer supplier part orders lineitem events documents "
                   "embeddings pages benchmark labels conversations").split()


class MissingSourceError(FileNotFoundError):
    """One or more input sources are absent (all of them are listed)."""


class SchemaError(ValueError):
    """Required columns are missing or the table is empty."""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def check_sources(spark: SparkSession, paths: dict[str, str]) -> None:
    """Report every missing source at once, before anything is read."""
    missing = [f"{n}: {p}" for n, p in paths.items() if not _exists(spark, p)]
    if missing:
        raise MissingSourceError("missing sources: " + "; ".join(missing))


def require_columns(df: DataFrame, required, name: str = "table") -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaError(f"{name}: missing required columns {missing}")
    return df


def load_csv(spark: SparkSession, path: str, required=(), name: str = "table",
             schema: T.StructType | None = None, check_empty: bool = True) -> DataFrame:
    """Header CSV, UTF-8, comma. Missing file, missing columns (all listed) and an
    empty table fail early. Without a schema every column is read as text and
    coerced by the cleaning operators (no inference pass over the data)."""
    check_sources(spark, {name: path})
    r = spark.read.option("header", True).option("encoding", "UTF-8").option("sep", ",")
    df = r.schema(schema).csv(path) if schema is not None else r.csv(path)
    require_columns(df, required, name)
    if check_empty and df.isEmpty():
        raise SchemaError(f"{name}: empty table")
    return df


def first_available(spark: SparkSession, primary: str, fallback: str, reader, dedupe):
    """S3: prefer the primary source, else read the fallback and reduce it with ``dedupe``."""
    if _exists(spark, primary):
        return reader(primary)
    return dedupe(reader(fallback))


def feature_columns(df: DataFrame, prefix: str | None = None, exclude=()) -> list[str]:
    """Feature columns by prefix, or every column not excluded."""
    if prefix is not None:
        return [c for c in df.columns if c.startswith(prefix)]
    return [c for c in df.columns if c not in set(exclude)]


def assemble_features(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Wide columns -> one ``ARRAY<DOUBLE>``, with a row-level null flag."""
    arr = F.array(*[F.col(c).cast("double") for c in cols])
    return df.withColumn(out, arr).withColumn(
        f"{out}_has_null", F.exists(F.col(out), lambda x: x.isNull()))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    """Overwrite sink (CSV with header, no index)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def readback_checks(spark: SparkSession, path: str, columns: list[str], key: str,
                    fmt: str = "parquet", spend_col: str | None = "total_spent",
                    expected_rows: int | None = None) -> DataFrame:
    """Re-read and check columns, spend non-null/non-negative, unique key, row count
    in one aggregate. Returns rows (check, passed, observed)."""
    r = spark.read.format(fmt).option("header", True).load(path)
    same_cols = list(r.columns) == list(columns)
    aggs = [F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("nk")]
    if spend_col:
        sp = F.col(spend_col).cast("double")
        aggs += [F.count_if(sp.isNull()).alias("spend_null"),
                 F.count_if(sp < 0).alias("spend_negative")]
    a = r.agg(*aggs).first()
    rows = [("same_columns", same_cols, len(r.columns)),
            ("unique_key", a["n"] == a["nk"], a["n"] - a["nk"])]
    if spend_col:
        rows += [("spend_not_null", a["spend_null"] == 0, a["spend_null"]),
                 ("spend_non_negative", a["spend_negative"] == 0, a["spend_negative"])]
    if expected_rows is not None:
        rows.append(("row_count", a["n"] == expected_rows, a["n"]))
    return spark.createDataFrame(rows, "check string, passed boolean, observed long")


def write_verification_config(spark: SparkSession, profile: DataFrame, path: str,
                              threshold: float, margin: float, feature_columns_: list[str]):
    """S7 sink: the class profile as Parquet plus a small JSON of scalar settings."""
    profile.write.mode("overwrite").parquet(os.path.join(path, "class_profile"))
    cfg = {"unknown_threshold": threshold, "distance_margin": margin,
           "feature_columns": list(feature_columns_)}
    spark.createDataFrame([(json.dumps(cfg),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(os.path.join(path, "settings"))


def read_verification_config(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """S7 source."""
    prof = spark.read.parquet(os.path.join(path, "class_profile"))
    txt = spark.read.text(os.path.join(path, "settings")).first()["value"]
    return prof, json.loads(txt)


def metrics_table(spark: SparkSession, run: str, split: str, values: dict) -> DataFrame:
    """Tidy metric rows ``(run, split, metric, value)``."""
    rows = [(run, split, k, None if v is None else float(v)) for k, v in values.items()]
    return spark.createDataFrame(rows, "run string, split string, metric string, value double")


def preview(df: DataFrame, want: list[str], prefix: str | None = None, first_n: int = 5,
            key: str | None = None, value: str | None = None) -> DataFrame:
    """The wanted columns that exist, plus the first ``first_n`` columns of a prefix
    family, optionally for one key value (case-insensitive)."""
    cols = [c for c in want if c in df.columns]
    if prefix:
        cols += [c for c in df.columns if c.startswith(prefix) and c not in cols][:first_n]
    out = df
    if key is not None and value is not None:
        out = out.where(F.lower(F.trim(F.col(key).cast("string"))) == str(value).strip().lower())
    return out.select(*cols)


class ModelNotAvailableError(FileNotFoundError):
    """A persisted model directory is missing or unreadable."""


def save_model(model, path: str) -> None:
    """Persist a fitted ``PipelineModel`` (labels live in its indexer stages)."""
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str):
    """Load a ``PipelineModel``; a missing or corrupt directory is a typed error."""
    from pyspark.ml import PipelineModel
    if not _exists(spark, path):
        raise ModelNotAvailableError(f"model not available: {path}")
    try:
        return PipelineModel.load(path)
    except Exception as e:  # noqa: BLE001 - re-raised as the typed error
        raise ModelNotAvailableError(f"model not readable: {path} ({e})") from e
