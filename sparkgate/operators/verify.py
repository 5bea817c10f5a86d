"""Open-set identity verification: A6, A7, V1-V4, W4, U2.

The class profile (centroid and radius per class) stays a table of any size. Its classes are
packed into blocks of about ``BLOCK_BYTES``; a sample is scored against a block by one fold
whose state is mergeable: the nearest class so far and the sum of exponentials relative to it
(a log-sum-exp with a running maximum). With one block, the usual case, that is the result.
With more, every sample goes to every block, its states are merged in an aggregate by sample,
and nothing of the size of the profile meets in one row or on the driver. The blocks are
broadcast while they take at most ``BROADCAST_BYTES`` (measured), and joined by shuffle, in
salted copies, beyond. Scores of another model need only its predicted class and confidence:
the class's row is joined for the distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import l2_distance, sq_distance
from ..session import materialize
from .ranking import join_apart

# Fixed values of the verification rule.
UNKNOWN_THRESHOLD = 0.6
DISTANCE_MARGIN = 1.5
UNKNOWN_LABEL = "UNKNOWN"
REASON_LOW_CONFIDENCE = "low_confidence"
REASON_TOO_FAR = "outside_class_radius"
REASON_NO_SAMPLE = "no_sample"

#: Centroid bytes of a block of classes, and of all blocks up to which they are broadcast.
BLOCK_BYTES, BROADCAST_BYTES = 1_000_000, 8_000_000
#: Copies of the blocks in a join by shuffle, a share of the samples each.
COPIES = 64

STATE = "struct<d2: double, label: string, max_dist: double, mass: double>"


def class_centroids_long(df: DataFrame, label: str, vec_col: str) -> DataFrame:
    """Mean vector per class as rows (label, pos, value); partial aggregation keeps
    the shuffle at (partitions x classes x dims) rows."""
    e = df.select(label, F.posexplode(vec_col).alias("pos", "x"))
    return e.groupBy(label, "pos").agg(F.avg("x").alias("value"))


def centroid_arrays(long: DataFrame, label: str) -> DataFrame:
    """(label, centroid ARRAY<DOUBLE>) ordered by position (dims per class: bounded)."""
    return long.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("pos", "value")))
                                   .alias("_c")).select(
        label, F.transform("_c", lambda s: s["value"]).alias("centroid"))


def intra_class_max(df: DataFrame, label: str, vec_col: str, centroids: DataFrame) -> DataFrame:
    """Largest distance of a class member to its centroid."""
    j = df.select(label, vec_col).join(centroids, label)
    return j.groupBy(label).agg(F.max(l2_distance(vec_col, "centroid"))
                                .alias("max_intra_class_distance"))


def class_profile(df: DataFrame, label: str, vec_col: str) -> DataFrame:
    """V2: (label, centroid, max_intra_class_distance)."""
    c = centroid_arrays(class_centroids_long(df, label, vec_col), label)
    return c.join(intra_class_max(df, label, vec_col, c), label)


def _profile(profile, spark=None, label: str = "person") -> DataFrame:
    """``label, centroid, max_dist`` of a profile table or of a list of such rows."""
    if not isinstance(profile, DataFrame):
        return spark.createDataFrame(profile, "label string, centroid array<double>, max_dist double")
    return profile.select(F.col(label).cast("string").alias("label"), "centroid",
                          F.col("max_intra_class_distance").alias("max_dist"))


def class_blocks(profile: DataFrame, block_bytes: int | None = None) -> tuple[DataFrame, int, int]:
    """``_block, _classes`` (by label), written once, with the number of blocks and their bytes."""
    size = profile.agg(F.count("*").alias("n"), F.max(F.size("centroid")).alias("d")).first()
    of_class = 8 * (size.d or 0) + 64
    blocks = max(1, -(-size.n * of_class // (block_bytes or BLOCK_BYTES)))
    rows = profile.withColumn("_block", F.pmod(F.xxhash64("label"), F.lit(blocks)).cast("int"))
    packed = rows.groupBy("_block").agg(F.array_sort(F.collect_list(F.struct("label", "centroid", "max_dist")))
                                        .alias("_classes"))
    return materialize(packed, "class-blocks"), blocks, size.n * of_class


def _state(d2: Column, label: Column, max_dist: Column, mass: Column) -> Column:
    return F.struct(d2.alias("d2"), label.alias("label"), max_dist.alias("max_dist"), mass.alias("mass")).cast(STATE)


def _merged(a: Column, b: Column) -> Column:
    """The state of two sets of classes; the first wins ties."""
    nearer = _state(b["d2"], b["label"], b["max_dist"], a["mass"] * F.exp(b["d2"] - a["d2"]) + b["mass"])
    kept = _state(a["d2"], a["label"], a["max_dist"], a["mass"] + b["mass"] * F.exp(a["d2"] - b["d2"]))
    return F.when(b["d2"] < a["d2"], nearer).otherwise(kept)


def _none() -> Column:
    return _state(F.lit(float("inf")), F.lit(None), F.lit(None), F.lit(0.0))


def block_state(vec: Column, classes: Column) -> Column:
    """What a block of classes says of a vector: its nearest class and the mass of all."""
    def one(c: Column) -> Column:
        return _state(sq_distance(vec, c["centroid"]), c["label"], c["max_dist"], F.lit(1.0))
    return F.aggregate(F.transform(classes, one), _none(), _merged)


def nearest_class(df: DataFrame, vec_col: str, profile, label: str = "person") -> DataFrame:
    """Adds ``predicted`` (the nearest class, the first by name in ties), ``confidence``
    (its share of the softmax of negative squared distances), ``distance`` and ``_max_dist``."""
    blocks, n, size = class_blocks(_profile(profile, df.sparkSession, label))
    state = F.when(F.col(vec_col).isNotNull(), block_state(F.col(vec_col), F.col("_classes"))).alias("_state")
    if n == 1:
        # always 0, but not a literal, by which the join would become a product
        keyed = df.withColumn("_block", F.pmod(F.xxhash64(vec_col), F.lit(1)).cast("int"))
        out = keyed.join(F.broadcast(blocks) if size <= BROADCAST_BYTES else blocks, "_block", "left").select(
            *df.columns, state)
    else:
        rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "gate-samples")
        sent = rows.select("_row", F.col(vec_col), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_block"))
        if size <= BROADCAST_BYTES:
            met = sent.join(F.broadcast(blocks), "_block")
        else:
            salted = blocks.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
            met = sent.withColumn("_copy", F.pmod(F.xxhash64("_row"), F.lit(COPIES)).cast("int")).join(
                salted, ["_block", "_copy"])
        states = met.select("_row", state).groupBy("_row").agg(F.array_sort(F.collect_list("_state")).alias("_states"))
        merged = states.select("_row", F.when(F.size("_states") > 0, F.aggregate("_states", _none(), _merged)).alias("_state"))
        out = rows.join(merged, "_row", "left").select(*df.columns, "_state")
    s = F.col("_state")
    known = s["label"].isNotNull()
    return out.withColumns({
        "predicted": s["label"], "confidence": F.when(known, 1.0 / s["mass"]),
        "distance": F.when(known, F.sqrt(s["d2"])), "_max_dist": s["max_dist"]}).drop("_state")


def _gated(df: DataFrame, missing: Column, threshold: float, margin: float, use_distance: bool) -> DataFrame:
    """V1 and V3: ``reject_reason`` and ``person`` (NULL when rejected)."""
    low = F.col("confidence") < F.lit(float(threshold))
    far = (F.col("distance") > F.col("_max_dist") * F.lit(float(margin))) if use_distance else F.lit(False)
    reason = (F.when(missing, F.lit(REASON_NO_SAMPLE)).when(low, F.lit(REASON_LOW_CONFIDENCE))
              .when(far, F.lit(REASON_TOO_FAR)))
    return (df.withColumn("reject_reason", reason)
              .withColumn("person", F.when(F.col("reject_reason").isNull(), F.col("predicted")))
              .withColumn("confidence", F.when(missing, F.lit(0.0)).otherwise(F.col("confidence")))
              .drop("_max_dist"))


def open_set_gate(df: DataFrame, vec_col: str, profile, threshold: float = UNKNOWN_THRESHOLD,
                  margin: float = DISTANCE_MARGIN, use_distance: bool = True, label: str = "person") -> DataFrame:
    """V4 = W4 -> V1 -> V3: adds ``predicted``, ``confidence``, ``distance``, ``person`` (NULL
    when rejected) and ``reject_reason``. Confidence >= threshold passes; a distance strictly
    greater than the class's largest x margin rejects."""
    scored = nearest_class(df, vec_col, profile, label)
    return _gated(scored, F.col(vec_col).isNull(), threshold, margin, use_distance)


def gate_predictions(scored: DataFrame, vec_col: str, profile, threshold: float = UNKNOWN_THRESHOLD,
                     margin: float = DISTANCE_MARGIN, use_distance: bool = True, label: str = "person") -> DataFrame:
    """V4 for the ``predicted`` class and ``confidence`` of any model (U2): the row of the
    predicted class is joined for its distance rule."""
    p = _profile(profile, scored.sparkSession, label).withColumnsRenamed(
        {"label": "predicted", "centroid": "_centroid", "max_dist": "_max_dist"})
    out = join_apart(scored.withColumn("predicted", F.col("predicted").cast("string")), p, "predicted").withColumn(
        "distance", l2_distance(vec_col, "_centroid")).drop("_centroid")
    return _gated(out, F.col(vec_col).isNull(), threshold, margin, use_distance)


def confidence_label(df: DataFrame, threshold: float = UNKNOWN_THRESHOLD) -> DataFrame:
    """V1 alone (notebook rule): predicted label or ``UNKNOWN``."""
    return df.withColumn("gated_label", F.when(F.col("confidence") >= F.lit(float(threshold)),
                                               F.col("predicted")).otherwise(UNKNOWN_LABEL))
