"""Media operators on generated signals / pixel grids, and the table sources."""

import io
import os
import tempfile
import wave

import numpy as np
import pandas as pd
import pytest

from sparkgate.operators import media as MD
from sparkgate.sources import media as SM
from sparkgate.sources import tables as T


def _tone(freq, amp=0.5, seconds=1.0, sr=MD.SAMPLE_RATE):
    t = np.arange(int(seconds * sr)) / sr
    return amp * np.sin(2 * np.pi * freq * t)


def test_tone_features_are_analytically_right():
    f = MD.audio_features(_tone(1000.0))
    assert abs(f["RMSEnergy"] - 0.5 / np.sqrt(2)) < 0.02
    assert abs(f["ZeroCrossingRate"] - 2 * 1000.0 / MD.SAMPLE_RATE) < 0.01
    assert abs(f["SpectralCentroid"] - 1000.0) < 60
    assert set(f) == set(MD.FEATURE_COLUMNS)


def test_empty_clip_is_an_error():
    with pytest.raises(ValueError):
        MD.audio_features(np.zeros(0))


def test_audio_variants_are_seeded_and_shaped():
    y = _tone(440.0, seconds=0.5)
    a, b = MD.audio_variants(y, 123), MD.audio_variants(y, 123)
    assert np.array_equal(a["_noise"], b["_noise"])
    assert len(a["_stretch"]) > len(y) > len(a["_pitch"])
    assert np.array_equal(a[""], y)


def test_image_variant_identities():
    rng = np.random.default_rng(0)
    img = rng.integers(0, 256, (5, 7, 3), dtype=np.uint8)
    v = MD.image_variant_arrays(img)
    assert np.array_equal(v["_flip"][:, ::-1], img)
    r = img
    for _ in range(4):
        r = MD.image_variant_arrays(r)["_rotate"]
    assert np.array_equal(r, img)
    assert v["_rotate"].shape == (7, 5, 3)
    g = v["_gray"]
    assert (g[..., 0] == g[..., 1]).all() and (g[..., 1] == g[..., 2]).all()


def test_image_jobs_in_spark(spark):
    rows = [("i1", "p", "happy", [float(x) / 32 - 1 for x in range(64)])]
    df = spark.createDataFrame(rows, "image_id string, person string, emotion string, "
                                     "v array<double>")
    imgs = MD.grid_images(df, "v").drop("v")
    var = {r["variant"]: r for r in MD.image_variant_table(imgs).collect()}
    assert set(var) == {"happy", "happy_gray", "happy_flip", "happy_rotate"}
    assert all(len(r["data"]) == 8 * 8 * 3 for r in var.values())
    found, skipped = MD.first_encoding(MD.orientation_candidates(imgs), MD.brightness_encoder)
    assert found.count() + skipped.count() == 1


def _wav_bytes(y, sr, channels=1):
    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(sr)
        pcm = (np.clip(y, -1, 1) * 32767).astype(np.int16)
        if channels == 2:
            pcm = np.repeat(pcm, 2)
        w.writeframes(pcm.tobytes())
    return buf.getvalue()


def test_wav_decode_resamples_and_mixes():
    sr, y = SM.decode_wav(_wav_bytes(_tone(440.0, seconds=0.5, sr=16000), 16000, channels=2))
    assert sr == MD.SAMPLE_RATE and abs(len(y) - MD.SAMPLE_RATE // 2) <= 1


def test_audio_scan_and_features(spark):
    d = tempfile.mkdtemp(prefix="sparkgate-audio-")
    os.makedirs(os.path.join(d, "person1"))
    with open(os.path.join(d, "person1", "yes.wav"), "wb") as fh:
        fh.write(_wav_bytes(_tone(880.0, seconds=0.5), MD.SAMPLE_RATE))
    with open(os.path.join(d, "person1", "empty.wav"), "wb") as fh:
        fh.write(_wav_bytes(np.zeros(0), MD.SAMPLE_RATE))
    clips = SM.read_audio(spark, d)
    got = {r["phrase"]: r for r in clips.collect()}
    assert got["empty"]["error"] == "empty clip" and got["yes"]["person"] == "person1"
    feats = MD.audio_feature_table(clips.where("error IS NULL")).collect()
    assert len(feats) == 4
    base = [r for r in feats if r["variant"] == "yes"][0]
    assert abs(base["ZeroCrossingRate"] - 2 * 880.0 / MD.SAMPLE_RATE) < 0.01


def test_load_csv_checks(spark):
    d = tempfile.mkdtemp(prefix="sparkgate-csv-")
    p = os.path.join(d, "t.csv")
    pd.DataFrame({"customer_id": ["A1"], "amount": ["3"]}).to_csv(p, index=False)
    df = T.load_csv(spark, p, ["customer_id", "amount"], "t")
    assert df.count() == 1
    with pytest.raises(T.SchemaError) as e:
        T.load_csv(spark, p, ["customer_id", "x", "y"], "t")
    assert "'x'" in str(e.value) and "'y'" in str(e.value)
    with pytest.raises(T.MissingSourceError) as e:
        T.check_sources(spark, {"a": os.path.join(d, "nope1.csv"),
                                "b": os.path.join(d, "nope2.csv")})
    assert "nope1" in str(e.value) and "nope2" in str(e.value)
    empty = os.path.join(d, "e.csv")
    with open(empty, "w") as fh:
        fh.write("customer_id,amount\n")
    with pytest.raises(T.SchemaError):
        T.load_csv(spark, empty, ["customer_id"], "e")


def test_write_and_readback(spark):
    d = tempfile.mkdtemp(prefix="sparkgate-sink-")
    df = spark.createDataFrame([("a1", 1.0), ("a2", 0.0)], "customer_id string, total_spent double")
    T.write_table(df, os.path.join(d, "out"), fmt="csv")
    chk = {r["check"]: r for r in T.readback_checks(spark, os.path.join(d, "out"), df.columns,
                                                     "customer_id", fmt="csv",
                                                     expected_rows=2).collect()}
    assert all(r["passed"] for r in chk.values())


def test_verification_config_round_trip(spark):
    d = tempfile.mkdtemp(prefix="sparkgate-cfg-")
    prof = spark.createDataFrame([("p1", [0.0, 1.0], 2.0)],
                                 "person string, centroid array<double>, "
                                 "max_intra_class_distance double")
    T.write_verification_config(spark, prof, d, 0.6, 1.5, ["f1", "f2"])
    back, cfg = T.read_verification_config(spark, d)
    assert back.count() == 1 and cfg["unknown_threshold"] == 0.6
    assert cfg["feature_columns"] == ["f1", "f2"]


def test_feature_prefix_selection(spark):
    df = spark.createDataFrame([("p", 1.0, 2.0, None)],
                               "Person string, Feature1 double, Feature2 double, Feature3 double")
    cols = T.feature_columns(df, prefix="Feature")
    assert cols == ["Feature1", "Feature2", "Feature3"]
    r = T.assemble_features(df, cols).first()
    assert r["features_has_null"] is True


def test_model_persist_round_trip(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    d = tempfile.mkdtemp(prefix="sparkgate-model-")
    df = spark.createDataFrame([("b",), ("a",)], "c string")
    m = Pipeline(stages=[StringIndexer(inputCol="c", outputCol="i",
                                       stringOrderType="alphabetAsc")]).fit(df)
    T.save_model(m, os.path.join(d, "m"))
    back = T.load_model(spark, os.path.join(d, "m"))
    with pytest.raises(T.ModelNotAvailableError):
        T.load_model(spark, os.path.join(d, "absent"))
    os.makedirs(os.path.join(d, "broken"))
    with pytest.raises(T.ModelNotAvailableError):
        T.load_model(spark, os.path.join(d, "broken"))
    assert back.stages[0].labels == ["a", "b"]
    assert [r["i"] for r in back.transform(df).orderBy("c").collect()] == [0.0, 1.0]


def test_preview_and_fallback_source(spark):
    df = spark.createDataFrame([(" A1 ", "x", 1.0, 2.0, 3.0), ("a2", "y", 4.0, 5.0, 6.0)],
                               "customer_id string, name string, Feature1 double, "
                               "Feature2 double, Feature3 double")
    p = T.preview(df, ["customer_id", "missing"], prefix="Feature", first_n=2,
                  key="customer_id", value="a1")
    assert p.columns == ["customer_id", "Feature1", "Feature2"] and p.count() == 1
    d = tempfile.mkdtemp(prefix="sparkgate-fallback-")
    df.write.parquet(os.path.join(d, "platform"))
    got = T.first_available(spark, os.path.join(d, "customer"), os.path.join(d, "platform"),
                            spark.read.parquet, lambda x: x.dropDuplicates(["name"]))
    assert got.count() == 2


def test_distinct_counts_exact_and_sketch(spark):
    from sparkgate.operators import quality as Q
    df = spark.range(5000).selectExpr("id % 37 AS a", "id AS b")
    e = Q.distinct_counts(df, ["a", "b"]).first()
    s = Q.distinct_counts(df, ["a", "b"], approx=True).first()
    assert e["a"] == 37 and e["b"] == 5000 and e["rows"] == 5000
    assert abs(s["b"] - 5000) / 5000 < 0.05


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    """No machine-local fallback unless the session runs in local mode."""
    from sparkgate.session import checkpoint_dir

    class _Conf:
        def get(self, key, default=None):
            return default

        def set(self, key, value):
            raise AssertionError("must not set a local folder on a cluster")

    class _Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class _Session:
        conf = _Conf()
        sparkContext = _Ctx()

    with pytest.raises(ValueError):
        checkpoint_dir(_Session())


def test_tone_clips_sample_in_numpy(spark):
    """The samples equal the sum of sines that Spark's own sine gives; a missing value: no number."""
    from pyspark.sql import functions as F
    vecs = [[0.1 * i - 0.7 for i in range(16)], [0.0] * 15 + [None]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vecs)], "id int, v array<double>")
    clips = df.select("id", "v", MD.tone_clips(df, "v", seconds=0.01).alias("samples"))
    assert "lambdafunction" not in clips._jdf.queryExecution().toString()
    t = F.col("t")
    terms = [(0.05 + F.abs(F.col("v")[8 + k])) * F.sin(
        F.lit(2 * np.pi) * (110.0 * (k + 1) + F.abs(F.col("v")[k]) * 2000.0) * t / float(MD.SAMPLE_RATE))
        for k in range(8)]
    want = df.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(219))).alias("t")).select(
        "id", "t", sum(terms, F.lit(0.0)).cast("float").alias("s")).orderBy("id", "t").collect()
    got = {r.id: r.samples for r in clips.collect()}
    assert np.allclose(got[0], [r.s for r in want if r.id == 0], rtol=1e-6, atol=1e-7) and len(got[0]) == 220
    assert np.isnan(got[1]).all() and len(got[1]) == 220


def test_mel_bands_equal_the_whole_filters():
    power = np.random.default_rng(3).random((1 + MD.N_FFT // 2, 5))
    for sr in (8000, MD.SAMPLE_RATE):
        assert np.allclose(MD._mel(power, sr), MD.mel_filters(sr) @ power, rtol=1e-12, atol=0)
