"""Forced alignment of token sequences to tables of frame scores (blank-separated labels, as in CTC).

The trellis of a clip has a state for each token and for the blanks around them. Beside the best log score of each state
goes the sum of frame probabilities on its path, so the mean path probability needs no way back: memory is one row of
the trellis, whatever the number of frames. Clips are batched by size, longest first, so that those still running are
always the first rows of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scores of a batch, padded: about 32 MB.
CELLS = 4_000_000


def path_probabilities(scores: list[np.ndarray], tokens: list[np.ndarray], blank: int = 0) -> list[float | None]:
    """For each clip the mean over its frames of the probability of the label on the best path.

    scores: (frames, labels) log probabilities. None without tokens, with at least as many tokens as frames, or where
    no path fits (a repeated token needs a blank between). Of equal paths the one that stays wins, then the shorter step.
    """
    frames = np.array([len(s) for s in scores], np.int64)
    lengths = np.array([len(t) for t in tokens], np.int64)
    todo = np.flatnonzero((lengths > 0) & (lengths < frames))
    out: list[float | None] = [None] * len(scores)
    todo = todo[np.lexsort((lengths[todo], -frames[todo]))]
    while len(todo):
        wide = np.maximum.accumulate(lengths[todo])
        labels = max(scores[k].shape[1] for k in todo[:1])
        cost = np.arange(1, len(todo) + 1) * (frames[todo[0]] * labels + 2 * wide)
        n = max(1, int(np.searchsorted(cost, CELLS, "right")))
        for k, p in zip(todo[:n], _batch([scores[k] for k in todo[:n]], [tokens[k] for k in todo[:n]], blank), strict=True):
            out[k] = p
        todo = todo[n:]
    return out


def _batch(scores: list[np.ndarray], tokens: list[np.ndarray], blank: int) -> list[float | None]:
    frames = np.array([len(s) for s in scores])
    states = np.array([2 * len(t) + 1 for t in tokens])
    n, most = len(scores), int(states.max())
    padded = np.full((n, int(frames[0]), scores[0].shape[1]), -np.inf)
    label = np.full((n, most), blank, np.int64)
    for k, (s, t) in enumerate(zip(scores, tokens, strict=True)):
        padded[k, : len(s)] = s
        label[k, 1 : 2 * len(t) : 2] = t
    # a token may follow another one at once unless it is the same
    skips = np.zeros((n, most), bool)
    skips[:, 3::2] = label[:, 3::2] != label[:, 1:-2:2]
    rows = np.arange(n)[:, None]
    # two states that are never reached stand before the first
    best = np.full((n, most + 2), -np.inf)
    sums = np.zeros((n, most + 2))
    first = padded[rows, 0, label[:, :2]]
    best[:, 2:4], sums[:, 2:4] = first, np.exp(first)
    for t in range(1, int(frames[0])):
        a = int(np.searchsorted(-frames, -t, "left"))
        stay, step, skip = best[:a, 2:], best[:a, 1:-1], np.where(skips[:a], best[:a, :-2], -np.inf)
        stays = (stay >= step) & (stay >= skip)
        steps = step >= skip
        e = padded[rows[:a], t, label[:a]]
        s = np.where(stays, sums[:a, 2:], np.where(steps, sums[:a, 1:-1], sums[:a, :-2])) + np.exp(e)
        best[:a, 2:] = np.where(stays, stay, np.where(steps, step, skip)) + e
        sums[:a, 2:] = s
    k = np.arange(n)
    # the path ends in the last token or in the blank after it
    end = np.where(best[k, states + 1] > best[k, states], states + 1, states)
    mean = sums[k, end] / frames
    return [float(m) if np.isfinite(b) and np.isfinite(m) else None for m, b in zip(mean, best[k, end], strict=True)]


def align(frames: DataFrame, targets: DataFrame, clip: str, frame: str, scores: str, tokens: str, blank: int = 0) -> DataFrame:
    """(clip, n_frames, n_tokens, confidence) for each row of targets (clip, tokens), over frames (clip, frame, scores).

    One row of frames is one frame's log probabilities. A clip without frames or without tokens, or with as many tokens
    as frames, has a null confidence; a null token or score counts as none. One clip's frames meet in one row.
    """
    gathered = frames.groupBy(clip).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(frame).alias("f"), F.col(scores).cast("array<double>").alias("s")))), lambda x: x["s"]).alias("_s"))
    wanted = targets.select(clip, F.filter(F.coalesce(F.col(tokens).cast("array<int>"), F.array().cast("array<int>")), lambda t: t.isNotNull()).alias("_t"))
    both = wanted.join(gathered, clip, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, t = b.column("_s"), b.column("_t")
            per = [_matrix(s[k]) for k in range(b.num_rows)]
            want = [np.array(t[k].as_py(), np.int64) for k in range(b.num_rows)]
            p = path_probabilities(per, want, blank)
            n = [pa.array([len(x) for x in y], pa.int32()) for y in (per, want)]
            yield pa.RecordBatch.from_arrays([b.column(clip), *n, pa.array(p, pa.float64())], [clip, "n_frames", "n_tokens", "confidence"])

    return both.mapInArrow(run, f"`{clip}` {targets.schema[clip].dataType.simpleString()}, n_frames int, n_tokens int, confidence double")


def _matrix(frames: pa.ListScalar) -> np.ndarray:
    """Frames of one clip as (frames, labels); frames that have no scores or another number of them go."""
    rows = frames.values
    if rows is None or not len(rows):
        return np.zeros((0, 1))
    sizes = np.asarray(rows.value_lengths().fill_null(0))
    width = int(sizes[0])
    if width and (sizes == width).all() and not rows.null_count:
        return np.nan_to_num(rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64), nan=-np.inf, neginf=-np.inf).reshape(-1, width)
    kept = [r for r in rows.to_pylist() if r and len(r) == max(sizes)]
    return np.array([[-np.inf if x is None or x != x else x for x in r] for r in kept], np.float64) if kept else np.zeros((0, 1))
