"""Acoustic features of speech clips: pitch, harmonics to noise, brightness, band ratio, pauses; and how they join older ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions import audio

#: Frames that are looked at together.
FRAMES = 512


def frames_of(y: np.ndarray, size: int, hop: int) -> Iterator[np.ndarray]:
    """Frames of a signal (padded to one at least), FRAMES at a time."""
    x = np.concatenate((y.astype(np.float64), np.zeros(max(0, size - y.size))))
    view = np.lib.stride_tricks.sliding_window_view(x, size)[::hop]
    for k in range(0, len(view), FRAMES):
        yield view[k : k + FRAMES]


def harmonicity(y: np.ndarray, rate: int, low: float = 75.0, high: float = 500.0, silent: float = 0.1) -> np.ndarray:
    """Harmonics-to-noise ratio in dB of 80 ms frames every 10 ms; frames whose peak is under `silent` of the loudest are left out.

    The share of a frame's power that repeats after a period is its autocorrelation there over that of the window; the
    rest is noise. The peak is sought between samples, on a spectrum padded to four times its length.
    """
    size, hop = int(0.08 * rate), max(1, int(0.01 * rate))
    peak = audio.peak_level(y)
    if y.size < size or peak < audio.EPS:
        return np.zeros(0)
    window = np.hanning(size)
    n, finer = 1 << (2 * size - 1).bit_length(), 4

    def correlated(frames: np.ndarray) -> np.ndarray:
        power = np.abs(np.fft.rfft(frames, n, axis=-1)) ** 2
        return np.fft.irfft(power, n * finer, axis=-1) * finer

    a, b = int(rate / high * finer), min(int(rate / low * finer) + 1, size * finer // 2)
    of_window = correlated(window)
    out = []
    for frames in frames_of(y, size, hop):
        heard = frames[np.abs(frames).max(axis=1) >= silent * peak]
        if not len(heard):
            continue
        r = correlated((heard - heard.mean(axis=1, keepdims=True)) * window)
        share = (r[:, a - 1 : b + 1] / np.maximum(r[:, :1], audio.EPS)) * (of_window[0] / of_window[a - 1 : b + 1])
        mid = share[:, 1:-1]
        tops = np.where((mid >= share[:, :-2]) & (mid >= share[:, 2:]), mid, 1e-6).max(axis=1)
        tops = np.clip(tops, 1e-6, 1 - 1e-6)
        out.append(10 * np.log10(tops / (1 - tops)))
    return np.concatenate(out) if out else np.zeros(0)


def spectral_centroid(y: np.ndarray, rate: int, size: int = 2048, hop: int = 512) -> float:
    """Mean over frames of the mean frequency, weighed by magnitude; silent frames count as 0."""
    frequency, total, count = np.fft.rfftfreq(size, 1 / rate), 0.0, 0
    for frames in frames_of(y, size, hop):
        s = np.abs(np.fft.rfft(frames * np.hanning(size), axis=1))
        total += float((s @ frequency / np.maximum(s.sum(axis=1), audio.EPS)).sum())
        count += len(s)
    return total / count


def band_ratio(y: np.ndarray, rate: int, cut: float = 2000.0, size: int = 1024, hop: int = 256) -> float:
    """Power from `cut` up over the power below."""
    power = sum(((np.abs(np.fft.rfft(f * np.hanning(size), axis=1)) ** 2).sum(axis=0) for f in frames_of(y, size, hop)), np.zeros(size // 2 + 1))
    low = np.fft.rfftfreq(size, 1 / rate) < cut
    return float(power[~low].sum() / (power[low].sum() + 1e-9))


NAMES = ("voiced_fraction", "f0_mean", "f0_std", "f0_range", "hnr_mean", "rms_mean", "rms_std", "rms_dynamic", "spectral_centroid", "hf_lf_ratio", "pause_ratio")


def features(y: np.ndarray, rate: int) -> dict[str, float]:
    """The features of a clip; none under 0.2 s."""
    if y.size < int(0.2 * rate):
        return {}
    f0 = audio.pitch(y, rate, 70.0, 500.0)
    voiced = f0[f0 > 0]
    wide = np.percentile(voiced, (5, 95)) if len(voiced) else (0.0, 0.0)
    hnr = harmonicity(y, rate)
    level = audio.frame_levels(y, 2048, 512)
    mean, spread = float(level.mean()), float(level.std())
    values = (len(voiced) / max(1, len(f0)), voiced.mean() if len(voiced) else 0.0, voiced.std() if len(voiced) else 0.0, wide[1] - wide[0], hnr.mean() if len(hnr) else 0.0, mean, spread, spread / (mean + 1e-9), spectral_centroid(y, rate), band_ratio(y, rate), audio.silence_ratio(y, rate, 35.0))
    return {n: float(v) for n, v in zip(NAMES, values, strict=True)}


def extracted(clips: DataFrame, key: str, samples: str, rate: int) -> DataFrame:
    """(key, features) of clips with an array of samples: a struct of NAMES, null in all for a clip under 0.2 s or without samples."""
    kind = pa.struct([(n, pa.float64()) for n in NAMES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for y in b.column(samples):
                values = np.zeros(0, np.float32) if y.values is None else y.values.fill_null(0).to_numpy(zero_copy_only=False)
                found.append(dict.fromkeys(NAMES) | features(values, rate))
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(found, kind)], [key, "features"])

    return clips.select(key, samples).mapInArrow(run, f"`{key}` {clips.schema[key].dataType.simpleString()}, features struct<{','.join(f'{n}:double' for n in NAMES)}>")


def merged(segments: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Segments whose struct `features` takes the values of fresh (key, features); what fresh lacks or has null, as word counts, stays."""
    old = segments.schema["features"].dataType.names
    new = fresh.schema["features"].dataType.names
    met = segments.alias("s").join(fresh.select(key, F.col("features").alias("_new")), key, "left")
    of = {n: F.col(f"s.features.{n}") for n in old}
    fields = [F.coalesce(F.col(f"_new.{n}"), *([of[n]] if n in of else [])).alias(n) if n in new else of[n].alias(n) for n in dict.fromkeys([*old, *new])]
    return met.select(*[F.struct(*fields).alias("features") if c == "features" else (F.col(c) if c == key else F.col(f"s.{c}")) for c in segments.columns])
