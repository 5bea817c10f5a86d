"""Media sources: S5 (image directory scan) and S6 (audio directory scan + decode).

Files are listed and read by Spark (``image`` / ``binaryFile`` sources); person and
sample names come from the path with ``regexp_extract``. WAV decoding runs per
Arrow batch with the standard library (mono mix-down, linear resampling to
22 050 Hz); an empty clip becomes a quarantine row instead of failing the job.
"""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.media import SAMPLE_RATE

# Sample name patterns ``<root>/<person>/<stem>.<ext>``.
PERSON_FROM_PATH = r"([^/]+)/[^/]+$"
STEM_FROM_PATH = r"([^/]+)\.[^./]+$"


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """One row per decodable image: person from the directory, emotion from the stem."""
    img = spark.read.format("image").option("dropInvalid", True).load(path)
    o = F.col("image.origin")
    return img.select(
        o.alias("image_id"),
        F.regexp_extract(o, PERSON_FROM_PATH, 1).alias("person"),
        F.regexp_extract(o, STEM_FROM_PATH, 1).alias("emotion"),
        F.col("image.height").alias("height"), F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("nChannels"), F.col("image.data").alias("data"))


def decode_wav(content: bytes, target_sr: int = SAMPLE_RATE) -> tuple[int, np.ndarray]:
    """PCM WAV -> (sample rate, mono float32 at ``target_sr``)."""
    with wave.open(io.BytesIO(content)) as w:
        ch, width, sr, n = w.getnchannels(), w.getsampwidth(), w.getframerate(), w.getnframes()
        raw = w.readframes(n)
    dtype = {1: np.uint8, 2: np.int16, 4: np.int32}[width]
    x = np.frombuffer(raw, dtype=dtype).astype(np.float64)
    if width == 1:
        x = (x - 128.0) / 128.0
    else:
        x = x / float(2 ** (8 * width - 1))
    if ch > 1:
        x = x.reshape(-1, ch).mean(axis=1)
    if sr != target_sr and len(x):
        m = int(round(len(x) * target_sr / sr))
        x = np.interp(np.arange(m) * (sr / target_sr), np.arange(len(x)), x)
    return target_sr, x.astype(np.float32)


def read_audio(spark: SparkSession, path: str) -> DataFrame:
    """``(clip_id, person, phrase, sr, samples, error)``; ``error`` is set (and
    samples NULL) for empty or undecodable clips."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav") \
        .option("recursiveFileLookup", True).load(path)

    def run(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                try:
                    sr, y = decode_wav(bytes(r.content))
                    err = None if len(y) else "empty clip"
                except Exception as e:  # noqa: BLE001 - reported per row
                    sr, y, err = None, np.zeros(0, np.float32), f"decode failed: {e}"
                out.append((r.path, sr, None if err else y.tolist(), err))
            yield pd.DataFrame(out, columns=["clip_id", "sr", "samples", "error"])
    dec = files.select("path", "content").mapInPandas(
        run, "clip_id string, sr int, samples array<float>, error string")
    return dec.select(
        "clip_id",
        F.regexp_extract("clip_id", PERSON_FROM_PATH, 1).alias("person"),
        F.regexp_extract("clip_id", STEM_FROM_PATH, 1).alias("phrase"),
        "sr", "samples", "error")
