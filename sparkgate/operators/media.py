"""Media feature jobs: F1 (audio features), F2 (audio variants), F3 (image variants),
F4 (orientation candidates with first-hit selection).

Decoding and signal math run per Arrow batch in ``mapInPandas`` (numpy only);
Spark partitions the files / rows and does every join, explode and aggregate.
Audio features follow the usual definitions (Hann-windowed STFT, 2048/512,
128 Slaney mel bands, power-to-dB with an 80 dB floor, orthonormal DCT-II,
roll-off 0.85); they are numerically close to the common audio library, not
bit-identical.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the feature extraction and the augmentations.
SAMPLE_RATE = 22050
N_FFT = 2048
HOP = 512
N_MELS = 128
N_MFCC = 13
ROLLOFF = 0.85
TOP_DB = 80.0
PITCH_STEPS = 4
STRETCH_RATE = 0.85
NOISE_SCALE = 0.005
AUDIO_VARIANTS = ["", "_pitch", "_stretch", "_noise"]
IMAGE_VARIANTS = ["", "_gray", "_flip", "_rotate"]
GRAY_WEIGHTS_BGR = (0.114, 0.587, 0.299)
MEL_BAND = 16     # filters that are applied together
CLIP_BATCH = 64   # clips of which the samples are handed over at once
FEATURE_COLUMNS = [f"MFCC_{i}" for i in range(1, N_MFCC + 1)] + [
    "SpectralRolloff", "SpectralCentroid", "RMSEnergy", "ZeroCrossingRate"]


# ---------------------------------------------------------------- audio (numpy helpers)
def _padded(y: np.ndarray, n: int = N_FFT) -> np.ndarray:
    out = np.zeros(len(y) + 2 * (n // 2))
    out[n // 2:n // 2 + len(y)] = y
    return out


def _frames(padded: np.ndarray, n: int = N_FFT, hop: int = HOP) -> np.ndarray:
    """The frames as a read-only view of the padded signal."""
    return np.lib.stride_tricks.sliding_window_view(padded, n)[::hop]


def _hz_to_mel(f):
    f = np.asanyarray(f, dtype=float)
    f_sp, min_log_hz, logstep = 200.0 / 3, 1000.0, np.log(6.4) / 27.0
    mel = f / f_sp
    log_part = 1000.0 / f_sp + np.log(np.maximum(f, 1e-10) / min_log_hz) / logstep
    return np.where(f >= min_log_hz, log_part, mel)


def _mel_to_hz(m):
    m = np.asanyarray(m, dtype=float)
    f_sp, min_log_mel, logstep = 200.0 / 3, 1000.0 / (200.0 / 3), np.log(6.4) / 27.0
    return np.where(m >= min_log_mel, 1000.0 * np.exp(logstep * (m - min_log_mel)), f_sp * m)


@lru_cache(maxsize=8)
def mel_filters(sr: int = SAMPLE_RATE, n_fft: int = N_FFT, n_mels: int = N_MELS) -> np.ndarray:
    """Slaney-scale, Slaney-normalised triangular filters (n_mels x bins), built once per
    worker process and sample rate."""
    fft_f = np.linspace(0, sr / 2, 1 + n_fft // 2)
    mel_f = _mel_to_hz(np.linspace(_hz_to_mel(0.0), _hz_to_mel(sr / 2), n_mels + 2))
    fdiff = np.diff(mel_f)
    ramps = mel_f[:, None] - fft_f[None, :]
    lower = -ramps[:-2] / fdiff[:-1, None]
    upper = ramps[2:] / fdiff[1:, None]
    w = np.maximum(0, np.minimum(lower, upper))
    return w * (2.0 / (mel_f[2:n_mels + 2] - mel_f[:n_mels]))[:, None]


@lru_cache(maxsize=8)
def _mel_bands(sr: int) -> list[tuple[slice, slice, np.ndarray]]:
    """The filters in bands of MEL_BAND: filters, the bins they see, and their weights there
    (a filter covers few of the bins)."""
    w = mel_filters(sr)
    out = []
    for at in range(0, len(w), MEL_BAND):
        part = w[at:at + MEL_BAND]
        seen = np.flatnonzero(part.any(axis=0))
        bins = slice(int(seen[0]), int(seen[-1]) + 1) if len(seen) else slice(0, 1)
        out.append((slice(at, at + len(part)), bins, np.ascontiguousarray(part[:, bins])))
    return out


def _mel(power: np.ndarray, sr: int) -> np.ndarray:
    out = np.empty((N_MELS, power.shape[1]))
    for filters, bins, w in _mel_bands(sr):
        np.matmul(w, power[bins], out=out[filters])
    return out


@lru_cache(maxsize=8)
def _bin_freqs(sr: int) -> np.ndarray:
    return np.linspace(0, sr / 2, 1 + N_FFT // 2)


@lru_cache(maxsize=4)
def _hann(n: int) -> np.ndarray:
    """Periodic Hann window."""
    return np.hanning(n + 1)[:-1]


@lru_cache(maxsize=8)
def _dct_matrix(n: int, n_out: int) -> np.ndarray:
    k = np.arange(n_out)[:, None]
    basis = np.cos(np.pi * k * (2 * np.arange(n)[None, :] + 1) / (2 * n))
    scale = np.full((n_out, 1), np.sqrt(2.0 / n))
    scale[0, 0] = np.sqrt(1.0 / n)
    return scale * basis


def _dct_ortho(x: np.ndarray, n_out: int) -> np.ndarray:
    return _dct_matrix(x.shape[0], n_out) @ x


def audio_features(y: np.ndarray, sr: int = SAMPLE_RATE) -> dict[str, float]:
    """time-averaged MFCC 1-13, roll-off, centroid, RMS and zero-crossing rate."""
    y = np.asarray(y, dtype=np.float64)
    if y.size == 0:
        raise ValueError("empty audio clip")
    padded = _padded(y)
    win = _hann(N_FFT)
    mag = np.abs(np.fft.rfft(_frames(padded) * win, axis=1)).T            # bins x frames
    power = mag ** 2
    mel = _mel(power, sr)
    db = 10.0 * np.log10(np.maximum(mel, 1e-10))
    db = np.maximum(db, db.max() - TOP_DB)
    mfcc = _dct_ortho(db, N_MFCC).mean(axis=1)
    freqs = _bin_freqs(sr)
    tot = mag.sum(axis=0)
    centroid = np.where(tot > 0, (freqs @ mag) / np.maximum(tot, 1e-20), 0)
    cum = np.cumsum(mag, axis=0)
    roll = freqs[np.argmax(cum >= ROLLOFF * np.maximum(cum[-1:], 1e-20), axis=0)]
    rms = np.sqrt(np.mean(_frames(padded ** 2), axis=1))
    neg = np.signbit(padded)
    zc = np.count_nonzero(_frames(neg[1:] != neg[:-1], N_FFT - 1), axis=1) / N_FFT
    out = {f"MFCC_{i + 1}": float(v) for i, v in enumerate(mfcc)}
    out.update(SpectralRolloff=float(roll.mean()), SpectralCentroid=float(centroid.mean()),
               RMSEnergy=float(rms.mean()), ZeroCrossingRate=float(zc.mean()))
    return out


def _resample(y: np.ndarray, factor: float) -> np.ndarray:
    """Linear-interpolation resampling to ``len(y) / factor`` samples."""
    n = max(1, int(round(len(y) / factor)))
    return np.interp(np.arange(n) * factor, np.arange(len(y)), y)


def audio_variants(y: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """F2: original, pitch +4 semitones, time-stretch 0.85, additive noise 0.005 N(0,1).

    Pitch and stretch are resampling approximations (the phase-vocoder originals keep
    the other dimension fixed); the noise seed is a stable 64-bit hash, not a
    per-process one."""
    rng = np.random.default_rng(np.uint64(seed & 0xFFFFFFFFFFFFFFFF))
    return {"": y,
            "_pitch": _resample(y, 2 ** (PITCH_STEPS / 12)),
            "_stretch": _resample(y, STRETCH_RATE),
            "_noise": y + NOISE_SCALE * rng.standard_normal(len(y))}


AUDIO_OUT = ("clip_id string, person string, phrase string, variant string, "
             + ", ".join(f"{c} double" for c in FEATURE_COLUMNS))


def audio_feature_table(clips: DataFrame) -> DataFrame:
    """F1 + F2 over a clip table ``(clip_id, person, phrase, sr, samples ARRAY<FLOAT>)``:
    four variant rows per clip with the 17 features. The noise seed is
    ``xxhash64(person, phrase)`` computed by Spark."""
    src = clips.withColumn("noise_seed", F.xxhash64("person", "phrase"))

    def run(it):
        for pdf in it:
            rows = []
            for r in pdf.itertuples(index=False):
                y = np.asarray(r.samples, dtype=np.float64)
                variants = audio_variants(y, int(r.noise_seed))
                for suffix in AUDIO_VARIANTS:
                    wav = variants[suffix]
                    feats = audio_features(wav, int(r.sr))
                    rows.append({"clip_id": r.clip_id, "person": r.person, "phrase": r.phrase,
                                 "variant": f"{r.phrase}{suffix}", **feats})
            yield pd.DataFrame(rows, columns=["clip_id", "person", "phrase", "variant",
                                              *FEATURE_COLUMNS])
    return src.select("clip_id", "person", "phrase", "sr", "samples", "noise_seed").mapInPandas(
        run, AUDIO_OUT)


def tone_clips(df: DataFrame, vec_col: str, seconds: float = 0.5,
               sr: int = SAMPLE_RATE, partials: int = 8) -> Column:
    """A waveform per row derived from a feature vector: ``partials`` sines whose
    frequencies and amplitudes come from the vector's values. Spark derives the sines;
    their samples are computed per clip in numpy, as a lambda over an array evaluates
    every sample and sine as an object."""
    n = int(seconds * sr)
    v = F.col(vec_col)
    freqs = F.array(*[F.lit(110.0 * (k + 1)) + F.abs(F.element_at(v, k + 1)) * F.lit(2000.0)
                      for k in range(partials)])
    amps = F.array(*[F.lit(0.05) + F.abs(F.element_at(v, partials + k + 1)) for k in range(partials)])

    def run(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        t = np.arange(n, dtype=np.float64)
        for fs, ams in it:
            for at in range(0, len(fs), CLIP_BATCH):
                yield pd.Series([_tone(f, a, t, sr) for f, a in zip(
                    fs.iloc[at:at + CLIP_BATCH], ams.iloc[at:at + CLIP_BATCH])], dtype=object)
    return F.pandas_udf(run, "array<float>")(freqs, amps)


def _tone(freqs: np.ndarray, amps: np.ndarray, t: np.ndarray, sr: int) -> np.ndarray:
    """The sum of sines at the sample numbers ``t``; no frequency or amplitude: NaN samples."""
    acc = np.zeros(len(t))
    with np.errstate(invalid="ignore", over="ignore"):
        for f, a in zip(np.asarray(freqs, dtype=np.float64), np.asarray(amps, dtype=np.float64)):
            acc += a * np.sin(2 * np.pi * f * t / float(sr))
        return acc.astype(np.float32)


# ---------------------------------------------------------------- images
IMAGE_OUT = ("image_id string, person string, emotion string, variant string, "
             "height int, width int, nChannels int, data binary")


def image_variant_arrays(img: np.ndarray) -> dict[str, np.ndarray]:
    """original, 3-channel grayscale, horizontal flip, 90 degrees clockwise."""
    b, g, r = (img[..., i].astype(np.float64) for i in range(3))
    wb, wg, wr = GRAY_WEIGHTS_BGR
    gray = np.clip(np.rint(wb * b + wg * g + wr * r), 0, 255).astype(np.uint8)
    return {"": img, "_gray": np.stack([gray] * 3, axis=-1), "_flip": img[:, ::-1],
            "_rotate": np.rot90(img, k=-1)}


def image_variant_table(images: DataFrame) -> DataFrame:
    """F3 over an image table ``(image_id, person, emotion, height, width, nChannels,
    data)`` (BGR, row-major, as produced by Spark's image source)."""
    def run(it):
        for pdf in it:
            rows = []
            for r in pdf.itertuples(index=False):
                img = np.frombuffer(r.data, dtype=np.uint8).reshape(r.height, r.width,
                                                                    r.nChannels)
                variants = image_variant_arrays(img)
                for suffix in IMAGE_VARIANTS:
                    v = variants[suffix]
                    v = np.ascontiguousarray(v)
                    rows.append((r.image_id, r.person, r.emotion, f"{r.emotion}{suffix}",
                                 v.shape[0], v.shape[1], v.shape[2], v.tobytes()))
            yield pd.DataFrame(rows, columns=["image_id", "person", "emotion", "variant",
                                              "height", "width", "nChannels", "data"])
    return images.select("image_id", "person", "emotion", "height", "width", "nChannels",
                         "data").mapInPandas(run, IMAGE_OUT)


ROTATIONS = [0, 90, 180, 270]


def orientation_candidates(images: DataFrame) -> DataFrame:
    """F4 first half: the upright image and its 90/180/270 degree rotations, tagged
    with the candidate order."""
    def run(it):
        for pdf in it:
            rows = []
            for r in pdf.itertuples(index=False):
                img = np.frombuffer(r.data, dtype=np.uint8).reshape(r.height, r.width,
                                                                    r.nChannels)
                for order, deg in enumerate(ROTATIONS):
                    v = np.ascontiguousarray(np.rot90(img, k=-(deg // 90)))
                    rows.append((r.image_id, order, deg, v.shape[0], v.shape[1], v.shape[2],
                                 v.tobytes()))
            yield pd.DataFrame(rows, columns=["image_id", "cand_order", "rotation", "height",
                                              "width", "nChannels", "data"])
    return images.select("image_id", "height", "width", "nChannels", "data").mapInPandas(
        run, "image_id string, cand_order int, rotation int, height int, width int, "
             "nChannels int, data binary")


def first_encoding(candidates: DataFrame, encoder) -> tuple[DataFrame, DataFrame]:
    """F4 second half: apply a pluggable ``encoder`` (candidates -> DataFrame with
    ``encoding ARRAY<DOUBLE>`` or NULL) and keep the first candidate with a hit.
    Returns (found, skipped) — images without any hit are reported, not dropped."""
    enc = encoder(candidates).where(F.col("encoding").isNotNull())
    found = enc.groupBy("image_id").agg(
        F.min_by(F.struct("rotation", "encoding"), F.col("cand_order")).alias("_f"))
    found = found.select("image_id", F.col("_f.rotation").alias("rotation"),
                         F.col("_f.encoding").alias("encoding"))
    skipped = candidates.select("image_id").distinct().join(found, "image_id", "left_anti")
    return found, skipped


def brightness_encoder(candidates: DataFrame) -> DataFrame:
    """Stand-in encoder for tests and the demo query: a "face" is found when the top
    half of the image is brighter than the bottom half; the encoding is the mean of
    each pixel row. The real encoder network is an input of the engine."""
    def run(it):
        for pdf in it:
            encs = []
            for r in pdf.itertuples(index=False):
                img = np.frombuffer(r.data, dtype=np.uint8).reshape(r.height, r.width,
                                                                    r.nChannels)
                h = img.shape[0] // 2
                hit = img[:h].mean() > img[h:].mean()
                encs.append(img.mean(axis=(1, 2)).tolist() if hit else None)
            yield pdf.assign(encoding=encs).drop(columns=["data"])
    return candidates.mapInPandas(run, "image_id string, cand_order int, rotation int, "
                                       "height int, width int, nChannels int, "
                                       "encoding array<double>")


def grid_images(df: DataFrame, vec_col: str, side: int = 8) -> DataFrame:
    """An image struct per row derived in Spark from a ``side*side`` vector: BGR planes
    from the vector and two rotations of it, values mapped to 0-255."""
    n = side * side
    v = F.col(vec_col)
    px = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.least(
        F.lit(255), F.greatest(F.lit(0), ((F.element_at(v, i + 1) + 1.0) * 127.5).cast("int"))))
    # interleave B, G, R per pixel: G and R read the vector shifted by 1 and 2
    bgr = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.array(
        F.element_at(px, i + 1), F.element_at(px, ((i + 1) % n) + 1),
        F.element_at(px, ((i + 2) % n) + 1))))
    data = F.unhex(F.concat_ws("", F.transform(bgr, lambda x: F.lpad(F.hex(x), 2, "0"))))
    return df.withColumn("height", F.lit(side)).withColumn("width", F.lit(side)) \
        .withColumn("nChannels", F.lit(3)).withColumn("data", data)
