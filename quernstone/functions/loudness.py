"""Loudness with the ear's weighting: two recursive filters, then the gated mean of 400 ms blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed values of the public broadcast standard: (centre in Hz, gain in dB, quality) of the shelf, (centre, quality) of the high pass.
SHELF = (1681.974450955533, 3.999843853973347, 0.7071752369554196)
HIGH_PASS = (38.13547087602444, 0.5003270373238773)
OFFSET, ABSOLUTE_GATE, RELATIVE_GATE = -0.691, -70.0, -10.0


def weighting(rate: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """[(b, a)] of the two second-order filters at a sample rate, by the bilinear transform."""
    centre, gain, q = SHELF
    k = np.tan(np.pi * min(centre, 0.49 * rate) / rate)
    high = 10 ** (gain / 20)
    middle = high**0.4996667741545416
    a0 = 1 + k / q + k * k
    shelf = np.array([high + middle * k / q + k * k, 2 * (k * k - high), high - middle * k / q + k * k]) / a0, np.array([1, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0])
    centre, q = HIGH_PASS
    k = np.tan(np.pi * centre / rate)
    a0 = 1 + k / q + k * k
    return [shelf, (np.array([1.0, -2.0, 1.0]), np.array([1, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0]))]


def recursive(y: np.ndarray, b: np.ndarray, a: np.ndarray, block: int = 1024) -> np.ndarray:
    """A second-order recursive filter, block by block.

    In a block, the output is the input's own response (one convolution for all blocks) and the response to the two
    values of state at its begin. States go from block to block by a 2 x 2 matrix, the only step that is in order.
    """
    n = len(y)
    if not n:
        return np.zeros(0)
    x = np.concatenate((y.astype(np.float64), np.zeros(-n % block))).reshape(-1, block)
    step = np.array([[-a[1], 1.0], [-a[2], 0.0]])
    into = np.array([b[1] - a[1] * b[0], b[2] - a[2] * b[0]])
    # powers[k] is what a state is after k samples without input
    powers = np.empty((block + 1, 2, 2))
    powers[0] = np.eye(2)
    for k in range(block):
        powers[k + 1] = step @ powers[k]
    impulse = np.concatenate(([b[0]], powers[: block - 1, 0, :] @ into))
    size = 2 * block
    own = np.fft.irfft(np.fft.rfft(x, size, axis=1) * np.fft.rfft(impulse, size), size, axis=1)[:, :block]
    given = x @ (powers[block - 1 :: -1] @ into)
    state, states = np.zeros(2), np.empty((len(x), 2))
    for k in range(len(x)):
        states[k] = state
        state = powers[block] @ state + given[k]
    return (own + states @ powers[:block, 0, :].T).reshape(-1)[:n]


def weighted(y: np.ndarray, rate: int) -> np.ndarray:
    for b, a in weighting(rate):
        y = recursive(y, b, a)
    return y


def loudness(y: np.ndarray, rate: int) -> float:
    """Integrated loudness of one channel in LUFS; minus infinity in silence or under 400 ms.

    Blocks of 400 ms every 100 ms under -70 LUFS go; of the rest, those more than 10 LU under their mean.
    """
    size = round(0.4 * rate)
    if y.size < size:
        return -np.inf
    total = np.concatenate(([0.0], np.cumsum(weighted(y, rate) ** 2)))
    begins = np.round(np.arange(0, int((y.size - size) / (0.1 * rate) + 1e-9) + 1) * 0.1 * rate).astype(np.int64)
    begins = begins[begins + size <= y.size]
    power = np.maximum(total[begins + size] - total[begins], 0) / size
    level = OFFSET + 10 * np.log10(np.maximum(power, 1e-30))
    loud = power[level > ABSOLUTE_GATE]
    if not len(loud):
        return -np.inf
    gate = OFFSET + 10 * np.log10(loud.mean()) + RELATIVE_GATE
    return float(OFFSET + 10 * np.log10(power[(level > ABSOLUTE_GATE) & (level > gate)].mean()))


def measured(clips: DataFrame, key: str, samples: str, rate: int) -> DataFrame:
    """(key, lufs) of clips with an array of samples; null where loudness() has no value, or without samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [loudness(y.values.fill_null(0).to_numpy(zero_copy_only=False), rate) if y.values is not None else -np.inf for y in b.column(samples)]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array([x if np.isfinite(x) else None for x in found], pa.float64())], [key, "lufs"])

    return clips.select(key, samples).mapInArrow(run, f"`{key}` {clips.schema[key].dataType.simpleString()}, lufs double")
