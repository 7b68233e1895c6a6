"""Alignment, loudness, features, recordings, window cohesion, trials and ranking against plain versions."""

import math
import random
import struct
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.functions import alignment, audio, loudness, resampling, voice
from quernstone.operators import joins, metrics, ranking, sequence, trials
from quernstone.sources import recordings

# --- alignment ---------------------------------------------------------------------------------------------------


def plain_alignment(scores, tokens, blank=0):
    n, states = len(scores), [blank]
    if not len(tokens) or len(tokens) >= n:
        return None
    for t in tokens:
        states += [t, blank]
    best = [(scores[0][s], [k]) if k < 2 else (-math.inf, []) for k, s in enumerate(states)]
    for f in range(1, n):
        step = []
        for k, s in enumerate(states):
            ways = [best[k]] + ([best[k - 1]] if k else []) + ([best[k - 2]] if k > 1 and s != blank and s != states[k - 2] else [])
            score, path = max(ways, key=lambda w: w[0])
            step.append((score + scores[f][s], [*path, k]) if score > -math.inf else (-math.inf, []))
        best = step
    score, path = best[-1] if best[-1][0] > best[-2][0] else best[-2]
    return float(np.mean([math.exp(scores[f][states[k]]) for f, k in enumerate(path)])) if score > -math.inf else None


def frames_of(rng, n, labels=5):
    x = rng.normal(size=(n, labels)) * 2
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def test_alignment_equals_a_plain_loop(monkeypatch):
    rng = np.random.default_rng(1)
    scores = [frames_of(rng, rng.integers(1, 40)) for _ in range(80)]
    tokens = [rng.integers(1, 5, size=rng.integers(0, 25)) for _ in range(80)]
    expected = [plain_alignment(s, t) for s, t in zip(scores, tokens, strict=True)]
    for cells in (alignment.CELLS, 500):
        monkeypatch.setattr(alignment, "CELLS", cells)
        got = alignment.path_probabilities(scores, tokens)
        assert [g is None for g in got] == [e is None for e in expected]
        assert [g for g in got if g is not None] == pytest.approx([e for e in expected if e is not None])
    assert 10 < sum(e is None for e in expected) < 60


def test_a_repeated_token_needs_a_blank():
    scores = np.log(np.full((3, 2), 0.5))
    assert alignment.path_probabilities([scores] * 2, [np.array([1, 1]), np.array([1])]) == pytest.approx([0.5, 0.5])
    assert alignment.path_probabilities([np.log(np.full((4, 2), 0.5))], [np.array([1, 1, 1])]) == [None]


def test_alignment_of_ten_thousand_frames_keeps_one_row_of_the_trellis():
    import tracemalloc

    rng = np.random.default_rng(2)
    scores, tokens = [frames_of(rng, 10_000, 8)], [rng.integers(1, 8, size=500)]
    tracemalloc.start()
    got = alignment.path_probabilities(scores, tokens)[0]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # the scores once more as a padded batch, and no trellis of 10,000 x 1001
    assert 0 < got < 1 and most < 3 * scores[0].nbytes


def test_align_over_tables(spark):
    rng = np.random.default_rng(3)
    clips = {f"c{k}": frames_of(rng, int(rng.integers(1, 20))) for k in range(12)}
    targets = {c: [int(x) for x in rng.integers(1, 5, size=rng.integers(0, 8))] for c in clips} | {"none": [1, 2]}
    frames = [(c, f, [float(x) for x in row], "x") for c, s in clips.items() for f, row in enumerate(s)]
    random.Random(1).shuffle(frames)
    d = spark.createDataFrame([*frames, ("c0", 10_000, None, "x")], "clip string, frame int, scores array<double>, _t string")
    t = spark.createDataFrame([*targets.items(), ("null", None)], "clip string, tokens array<int>")
    got = {r.clip: r for r in alignment.align(d, t, "clip", "frame", "scores", "tokens").collect()}
    assert set(got) == {*targets, "null"}
    for c, s in clips.items():
        e = plain_alignment(s, targets[c])
        assert (got[c].confidence is None) == (e is None) and (e is None or abs(got[c].confidence - e) < 1e-12) and got[c].n_frames == len(s)
    assert (got["none"].n_frames, got["none"].n_tokens, got["none"].confidence, got["null"].confidence) == (0, 2, None, None)
    assert alignment.align(d, t.where("false"), "clip", "frame", "scores", "tokens").count() == 0


# --- sound -------------------------------------------------------------------------------------------------------


def tone(rate, seconds, hz, gain=1.0):
    return gain * np.sin(2 * np.pi * hz * np.arange(int(rate * seconds)) / rate)


def test_recursive_filter_equals_a_plain_loop():
    x = np.random.default_rng(0).normal(size=3000)
    for b, a in loudness.weighting(22050):
        y, s, t = [], 0.0, 0.0
        for v in x:
            y.append(b[0] * v + s)
            s, t = b[1] * v - a[1] * y[-1] + t, b[2] * v - a[2] * y[-1]
        for block in (7, 1024, 5000):
            assert np.abs(loudness.recursive(x, b, a, block) - y).max() < 1e-10


@pytest.mark.parametrize("rate", [16000, 44100, 48000])
def test_loudness_of_reference_sines(rate):
    # a full sine of 997 Hz on one channel is at -3.01 LUFS; 20 dB less is 20 LU less
    assert abs(loudness.loudness(tone(rate, 5, 997), rate) + 3.01) < 0.1
    assert abs(loudness.loudness(tone(rate, 5, 997, 0.1), rate) + 23.01) < 0.1
    # silence around it, and a part 30 dB below, are gated
    quiet = np.concatenate((np.zeros(4 * rate), tone(rate, 20, 997, 0.1), tone(rate, 20, 997, 0.1 * 10**-1.5), np.zeros(9 * rate)))
    assert abs(loudness.loudness(quiet, rate) + 23.01) < 0.1


def test_loudness_without_a_value():
    assert loudness.loudness(np.zeros(16000), 16000) == loudness.loudness(tone(16000, 0.3, 997), 16000) == -math.inf
    y = audio.loudness_normalize(tone(16000, 3, 440, 0.01), 16000)
    assert abs(loudness.loudness(y, 16000) + 20) < 0.05
    assert audio.peak_level(audio.loudness_normalize(tone(16000, 0.2, 440, 0.01), 16000)) == pytest.approx(10 ** (-1 / 20), rel=1e-3)
    assert len(audio.finalized(tone(48000, 1, 440), 48000, 24000)) == 24000 and audio.peak_level(audio.finalized(tone(16000, 1, 440, 0.1), 16000, 16000, "peak")) == pytest.approx(10 ** (-1 / 20), rel=1e-3)


@pytest.mark.parametrize("hz", [120, 200.7, 333.3])
@pytest.mark.parametrize("noise_db", [5, 10, 20, 30])
def test_harmonicity_of_tones_with_known_noise(hz, noise_db):
    rate, rng = 16000, np.random.default_rng(int(hz))
    y = tone(rate, 3, hz) + 0.5 * tone(rate, 3, 2 * hz)
    noisy = y + rng.normal(size=len(y)) * np.sqrt((y**2).mean() / 10 ** (noise_db / 10))
    assert abs(voice.harmonicity(0.2 * noisy, rate).mean() - noise_db) < 1


def test_features():
    y = np.concatenate((tone(16000, 1, 200, 0.3), np.zeros(16000), tone(16000, 1, 200, 0.3)))
    f = voice.features(y.astype(np.float32), 16000)
    assert set(f) == set(voice.NAMES) and abs(f["f0_mean"] - 200) < 3 and f["hnr_mean"] > 25 and f["hf_lf_ratio"] < 1e-3 and abs(f["pause_ratio"] - 1 / 3) < 0.05
    hiss = voice.features(0.3 * np.random.default_rng(1).normal(size=16000).astype(np.float32), 16000)
    assert hiss["hf_lf_ratio"] > 2 and hiss["hnr_mean"] < 3 and 3500 < hiss["spectral_centroid"] < 4500
    assert abs(voice.spectral_centroid(tone(16000, 1, 1000), 16000) - 1000) < 15
    assert voice.features(np.zeros(100), 16000) == {} and voice.features(np.zeros(16000), 16000)["hnr_mean"] == 0


def test_merged_features(spark):
    old = spark.createDataFrame([("a", (1.0, 2.0, 3.0), 1), ("b", (1.0, None, 3.0), 2), ("c", (9.0, 9.0, 9.0), 3)], "id string, features struct<hnr_mean:double,f0_mean:double,n_words:double>, _new int")
    fresh = spark.createDataFrame([("a", (5.0, None, 7.0)), ("b", (None, 6.0, None))], "id string, features struct<hnr_mean:double,f0_mean:double,rms_mean:double>")
    got = {r.id: tuple(r.features) for r in voice.merged(old.drop("_new"), fresh, "id").collect()}
    assert got == {"a": (5.0, 2.0, 3.0, 7.0), "b": (1.0, 6.0, 3.0, None), "c": (9.0, 9.0, 9.0, None)}


def test_extracted_over_a_table(spark):
    rows = [("a", [float(x) for x in tone(8000, 0.5, 200, 0.3)]), ("b", [0.1]), ("c", None), ("d", [])]
    d = spark.createDataFrame(rows, "id string, s array<float>")
    got = {r.id: r.features for r in voice.extracted(d, "id", "s", 8000).collect()}
    assert abs(got["a"].f0_mean - 200) < 3 and all(set(got[k]) == {None} for k in "bcd")
    loud = {r.id: r.lufs for r in loudness.measured(d, "id", "s", 8000).collect()}
    assert loud["a"] is not None and [loud[k] for k in "bcd"] == [None] * 3


@pytest.mark.parametrize(("rate", "to"), [(44100, 16000), (48000, 16000), (8000, 16000), (22050, 16000), (16000, 44100)])
def test_resampling_keeps_tones(rate, to):
    y = resampling.resample(tone(rate, 1, 440, 0.5) + tone(rate, 1, 3000, 0.3), rate, to)
    assert len(y) == to and np.abs(y - tone(to, 1, 440, 0.5) - tone(to, 1, 3000, 0.3))[600:-600].max() < 1e-3
    if to < rate:
        assert np.abs(resampling.resample(tone(rate, 1, to / 2 + 2000), rate, to))[600:-600].max() < 0.01


def wav(y, rate, channels=1, kind="<i2", extra=b"", claim=None):
    raw = (np.repeat(y[:, None], channels, 1) * (32767 if kind == "<i2" else 1)).astype(kind).tobytes()
    code, width = (1, 2) if kind == "<i2" else (3, 4)
    form = struct.pack("<HHIIHH", code, channels, rate, rate * channels * width, channels * width, 8 * width)
    return b"RIFF" + struct.pack("<I", 0) + b"WAVE" + extra + b"fmt " + struct.pack("<I", 16) + form + b"data" + struct.pack("<I", len(raw) if claim is None else claim) + raw


def read(spark, path, **options):
    spark.dataSource.register(recordings.Recordings)
    reader = spark.read.format("recordings")
    for k, v in options.items():
        reader = reader.option(k, v)
    return sorted(reader.load(str(path)).collect(), key=lambda r: (r.path, r.chunk))


def test_recordings_are_read_by_range(spark, tmp_path):
    y = tone(44100, 3.3, 440, 0.5)
    (tmp_path / "a.wav").write_bytes(wav(y, 44100, 2, extra=b"LIST" + struct.pack("<I", 5) + b"12345\0"))
    (tmp_path / "b.wav").write_bytes(wav(tone(16000, 1, 300), 16000, kind="<f4", claim=0xFFFFFFFF))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "empty.WAV").write_bytes(wav(np.zeros(0), 8000))
    (tmp_path / "bad.wav").write_bytes(b"RIFF....WAVEfmt ")
    (tmp_path / "none.wav").write_bytes(b"")
    (tmp_path / "notes.txt").write_text("x")
    whole = resampling.resample((y * 32767).astype("<i2") / 32768, 44100, 16000)
    for size in (1 << 24, 50_000, 999):
        got = read(spark, tmp_path, chunk_s=0.5, range_bytes=size)
        a = [r for r in got if r.path.endswith("a.wav")]
        assert [r.chunk for r in a] == list(range(7)) and [r.start_s for r in a] == [k * 0.5 for k in range(7)]
        assert np.abs(np.concatenate([r.samples for r in a]) - whole).max() < 1e-5
        rest = {r.path.rsplit("/", 1)[1]: r for r in got if r not in a and r.chunk == 0}
        assert (rest["empty.WAV"].samples, rest["empty.WAV"].duration_s, rest["empty.WAV"].rate) == (None, 0.0, 8000)
        assert all((rest[n].samples, rest[n].duration_s, rest[n].rate) == (None, 0.0, None) for n in ("bad.wav", "none.wav"))
        assert sum(r.duration_s for r in got if r.path.endswith("b.wav")) == 1.0 and "notes.txt" not in rest


def test_recordings_seek_and_trim(spark, tmp_path):
    y = tone(16000, 4, 440, 0.5)
    (tmp_path / "a.wav").write_bytes(wav(y, 16000))
    got = read(spark, tmp_path / "a.wav", start_s=1.5, dur_s=1.2, chunk_s=1)
    assert [round(r.duration_s, 6) for r in got] == [1.0, 0.2] and np.abs(np.concatenate([r.samples for r in got]) - y[24000:43200]).max() < 1e-4
    assert [r.samples for r in read(spark, tmp_path / "a.wav", start_s=9)] == [None]
    half = read(spark, f"file://{tmp_path}/a.wav", start_s=3, rate=8000)
    assert len(half) == 1 and len(half[0].samples) == 8000 and half[0].rate == 16000


def test_an_hour_of_sound_is_read_in_chunks(tmp_path):
    import tracemalloc

    path = tmp_path / "long.wav"
    n = 3600 * 16000
    with path.open("wb") as f:
        f.write(wav(np.zeros(0), 16000, claim=2 * n))
        f.truncate(f.tell() + 2 * n)
    reader = recordings.Reader({"path": str(path), "rate": "8000"})
    parts = reader.partitions()
    tracemalloc.start()
    rows = sum(b.num_rows for p in parts[:2] for b in reader.read(p))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(parts) == 7 and rows > 25 and most < 40e6


# --- windows, trials, ranking --------------------------------------------------------------------------------------


def test_window_cohesion(spark):
    rng = np.random.default_rng(5)
    clips = {f"c{k}": rng.normal(size=(k, 6)) + 1 for k in range(1, 8)}
    rows = [(c, [float(x) for x in v], 1) for c, vs in clips.items() for v in vs] + [("c1", None, 1)]
    got = {r.clip: r for r in metrics.window_cohesion(spark.createDataFrame(rows, "clip string, v array<float>, u int"), "clip", "v", 0.7).collect()}
    for c, vs in clips.items():
        e = [v / (np.linalg.norm(v) + 1e-9) for v in vs.astype(np.float32).astype(float)]
        pairs = [e[i] @ e[j] for i in range(len(e)) for j in range(i)]
        assert got[c].windows == len(vs) and (got[c].cohesion is None) == (not pairs)
        assert got[c].overlap == bool(pairs and np.mean(pairs) < 0.7) and (not pairs or abs(got[c].cohesion - np.mean(pairs)) < 1e-5)


def test_sample_windows(spark):
    d = spark.createDataFrame([(1, [float(k) for k in range(10)]), (2, [1.0]), (3, None), (4, [0.0] * 4)], "id int, s array<float>")
    got = sorted((r.id, r.window, r.window_samples) for r in sequence.sample_windows(d, "s", 4, 3).collect())
    assert got == [(1, 0, [0, 1, 2, 3]), (1, 1, [3, 4, 5, 6]), (1, 2, [6, 7, 8, 9]), (4, 0, [0.0] * 4)]


def test_shuffled_is_a_permutation(spark):
    for bits in (1, 3, 6):
        assert sorted(r[0] for r in spark.range(4**bits).select(trials.shuffled(F.col("id"), bits, 5)).collect()) == list(range(4**bits))


def voices(spark, sizes):
    return spark.createDataFrame([(k, s) for k, s in enumerate(s for s, n in sizes.items() for _ in range(n))] + [(9000, None)], "id long, who string")


def test_trials_are_balanced_and_different(spark):
    sizes = {"a": 90, "b": 30, "c": 1, "d": 2, "e": 1, "f": 40}
    d = voices(spark, sizes)
    who = {r.id: r.who for r in d.collect()}
    got = [tuple(r) for r in trials.balanced_trials(d, "id", "who", 500).collect()]
    assert len(set(got)) == len(got) == 1000 and sum(s for *_, s in got) == 500
    assert all(a < b and (who[a] == who[b]) == s and who[a] and who[b] for a, b, s in got)
    # all there are, once each
    small = voices(spark, {"a": 4, "b": 1, "c": 2})
    every = [tuple(r) for r in trials.balanced_trials(small, "id", "who").collect()]
    w = {r.id: r.who for r in small.collect() if r.who}
    assert {x[:2] for x in every if x[2]} == {(i, j) for i in w for j in w if i < j and w[i] == w[j]}
    assert sum(not s for *_, s in every) == sum(s for *_, s in every) == 7
    assert trials.balanced_trials(small.where("false"), "id", "who").count() == trials.balanced_trials(small.where("who = 'b'"), "id", "who").count() == 0


def test_small_numbers_are_drawn_evenly(spark):
    """Chi-square of how often each number comes over many seeds, three deviations at most."""
    for total, wanted, seeds in ((31, 10, 60), (74, 10, 60), (300, 200, 40)):
        seen, bits = Counter(), trials.half_bits(total)
        drawn = spark.range(4**bits).orderBy("id").select(*[trials.shuffled(F.col("id"), bits, seed).alias(f"s{seed}") for seed in range(seeds)]).collect()
        for seed in range(seeds):
            seen.update([r[seed] for r in drawn if r[seed] < total][:wanted])
        mean = seeds * wanted / total
        chi = sum((seen[k] - mean) ** 2 for k in range(total)) / (mean * (1 - wanted / total))
        assert abs(chi - (total - 1)) < 3 * math.sqrt(2 * (total - 1))


def test_drawn_numbers_cover_a_large_range_evenly(spark):
    x = np.array([r[0] for r in trials.drawn(spark, 10**12 + 7, 4000, 3).collect()])
    assert len(set(x.tolist())) == 4000 and x.min() >= 0 and x.max() < 10**12 + 7
    seen = np.bincount(x * 50 // (10**12 + 7), minlength=50)
    assert ((seen - 80) ** 2 / 80).sum() < 49 + 3 * math.sqrt(98)


@pytest.mark.parametrize("n", [0, 1, 500])
def test_positions_and_sums_equal_windows(spark, n):
    rng = random.Random(n)
    rows = [(k, rng.choice(["a", "a", "a", "b", None]), rng.randint(0, 9), rng.choice([None, 1, 5])) for k in range(n)]
    d = spark.createDataFrame(rows, "id int, g string, x int, __part int")
    got = ranking.positions(d, ["g"], [F.col("x").desc(), F.col("id")], "at", "size").collect()
    assert len(got) == n
    for g in {r[1] for r in rows}:
        order = sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0]))
        assert [(r.id, r["size"]) for r in sorted((r for r in got if r.g == g), key=lambda r: r["at"])] == [(r[0], len(order)) for r in order]
    summed = {r.id: (r.before, r.every) for r in ranking.running(d, [], [F.col("id")], {"before": F.col("__part")}, {"every": "before"}).collect()}
    parts = [r[3] or 0 for r in rows]
    assert summed == {k: (sum(parts[:k]), sum(parts)) for k in range(n)}


def test_intervals_meet_once_whatever_the_stretches(spark):
    rng = random.Random(4)
    make = lambda n: [(rng.choice("ab"), s := rng.choice([-3.0, 0.0, 2.5, 10.0, 29.9, 30.0]) + rng.randint(0, 90), s + rng.choice([0.0, 0.5, 3.0, 70.0, -2.0]), k) for k in range(n)]
    left, right = make(60), make(60)
    lost = ("a", None, 1.0, 99)
    x = spark.createDataFrame([*left, lost], "k string, left_start double, left_end double, l int")
    y = spark.createDataFrame([*right, lost], "k string, right_start double, right_end double, r int")
    expected = Counter((a[3], b[3]) for a in left for b in right if a[0] == b[0] and a[2] > b[1] and b[2] > a[1])
    for width in (0.7, 30.0, 1e6):
        assert Counter((r.l, r.r) for r in joins.overlapping(x, y, "k", width).collect()) == expected
