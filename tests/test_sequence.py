import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quernstone.operators import near_duplicates, sequence


def test_runs_bridge_the_gap_and_contained_pieces(spark):
    rows = [("a", 0.0, 1.0), ("a", 1.25, 2.0), ("a", 2.5, 2.6), ("a", 1.3, 5.0), ("a", 5.5, 6.0), ("b", 3.0, 3.0)]
    got = sequence.runs(spark.createDataFrame(rows, "k string, s double, e double"), ["k"], "s", "e", 0.25).orderBy("run_start").collect()
    assert [tuple(r) for r in got] == [("a", 0.0, 5.0, 4), ("a", 5.5, 6.0, 1)]


def plain_pack(pieces):
    out, cur = [], None
    for s, e in sorted(pieces):
        if cur is None:
            cur = [s, e]
        elif e - cur[0] <= 15:
            cur[1] = e
        elif cur[1] - cur[0] >= 5:
            out.append(tuple(cur))
            cur = [s, e]
        else:
            cur[1] = e
    if cur:
        if cur[1] - cur[0] >= 3:
            out.append(tuple(cur))
        elif out and cur[1] - out[-1][0] <= 25:
            out[-1] = (out[-1][0], cur[1])
    cut = []
    for s, e in out:
        n = 1 if e - s <= 25 else -int(-(e - s) // 15)
        cut += [(s + k * (e - s) / n, e if k == n - 1 else s + (k + 1) * (e - s) / n) for k in range(n)]
    return [(s, e) for s, e in cut if e - s >= 3]


def test_pack_equals_a_plain_loop(spark):
    rng, rows, expected = random.Random(1), [], {}
    for g in range(60):
        t, pieces = 0.0, []
        for _ in range(rng.randint(0, 12)):
            t += rng.choice([0, 1, 2])
            d = rng.choice([1, 2, 4, 9, 40])
            pieces.append((t, t + d))
            t += d
        rows += [(g, s, e) for s, e in pieces]
        expected[g] = plain_pack(pieces)
    got = {}
    for r in sequence.pack(spark.createDataFrame(rows, "g int, s double, e double"), "g", "s", "e").collect():
        got.setdefault(r.g, []).append((r.clip_start, r.clip_end))
    for g, clips in expected.items():
        assert [x for c in sorted(got.get(g, [])) for x in c] == pytest.approx([x for c in sorted(clips) for x in c])


def test_dominant_takes_the_first_of_equals(spark):
    d = spark.createDataFrame([(1, "x", 2.0, 5), (1, "y", 2.0, 3), (1, "z", -9.0, 1), (2, "q", 0.0, 1)], "k int, who string, w double, o int")
    assert sorted(tuple(r) for r in sequence.dominant(d, "k", "who", F.col("w"), F.col("o")).collect()) == [(1, "y", 2.0), (2, "q", 0.0)]


def plain_balance(rows, target):
    buckets = {}
    for r in sorted(rows):
        buckets.setdefault(r[1], []).append(r)
    if sum(r[2] for r in rows) <= target:
        return {r[0] for r in rows}
    order, chosen, total = sorted(buckets, key=lambda k: len(buckets[k])), set(), 0
    while total < target:
        for k in order:
            if buckets[k] and total < target:
                r = buckets[k].pop(0)
                chosen.add(r[0])
                total += r[2]
    return chosen


@pytest.mark.parametrize("target", [1, 40, 41, 10_000])
def test_balanced_equals_a_plain_loop(spark, target):
    rng = random.Random(target)
    rows = [(k, rng.choice("abbccc"), rng.randint(1, 9), "l") for k in range(40)]
    got = sequence.balanced(spark.createDataFrame(rows, "id int, b string, d int, l string"), "l", "b", "d", target, [F.col("id")])
    assert {r.id for r in got.collect()} == plain_balance(rows, target)


@pytest.mark.parametrize("n", [1, 2, 3, 20, 21, 40])
def test_split_sizes(spark, n):
    got = [r.split for r in sequence.split3(spark.range(n).withColumn("g", F.lit(1)), ["g"], 0.05, [F.col("id")]).orderBy("id").collect()]
    assert got == ["test" if i % 20 == 0 else "validation" if i % 20 == 1 else "train" for i in range(n)]


def test_no_split_without_a_fraction(spark):
    assert {r.split for r in sequence.split3(spark.range(5).withColumn("g", F.lit(1)), ["g"], 0.0, [F.col("id")]).collect()} == {"train"}


@pytest.mark.parametrize(("size", "n"), [(3, 5), (5, 5), (23, 5), (100, 7)])
def test_strides(spark, size, n):
    d = spark.range(size).withColumn("g", F.lit(1))
    k = max(1, size // n)
    assert sorted(r.id for r in sequence.stride_a(d, ["g"], n, [F.col("id")]).collect()) == list(range(size))[::k][:n]
    assert sorted(r.id for r in sequence.stride_b(d, ["g"], n, [F.col("id")]).collect()) == (list(range(size)) if size <= n else [int(i * size / n) for i in range(n)])


def test_z_scores(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 4.0), ("c", 2.0), ("c", 2.0)], "s string, f double")
    got = sorted((r.s, r.f_z) for r in sequence.z_scores(d, "s", ["f"]).collect())
    assert got == [("a", -1.069), ("a", -0.267), ("a", 1.336), ("b", 0.0), ("c", 0.0), ("c", 0.0)]


def plain_greedy(rows):
    kept, out = [], {}
    for k, text, lang in sorted(rows):
        t = set(text.lower().split())
        out[k] = bool(t) and any(l == lang and 10 * len(t & o) >= 9 * len(t | o) for l, o in kept if o)
        if not out[k]:
            kept.append((lang, t))
    return out


def test_greedy_keeps_the_end_of_a_chain(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(40)]
    rows = [(0, " ".join(base), "en"), (1, " ".join([*base[2:], "x", "y"]), "en"), (2, " ".join([*base[4:], "x", "y", "z", "q"]), "en"), (3, "", "en"), (4, "", "en"), (5, " ".join(base), "de"), (6, " ".join(reversed(base)), "en")]
    for k in range(60):
        w = base.copy()
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(40)] = f"v{rng.randrange(6)}"
        rows.append((10 + k, " ".join(w), rng.choice(["en", "de"])))
    got = {r.k: r.dropped for r in near_duplicates.greedy_kept(spark.createDataFrame(rows, "k int, text string, lang string"), "k", "text", "lang").collect()}
    assert got == plain_greedy(rows)


def test_copies_keep_their_links(spark):
    base = [f"w{k}" for k in range(20)]
    near = [*base[1:], "x"]
    rows = [(0, " ".join(base), "en"), (1, " ".join(reversed(base)), "en"), (2, " ".join(near), "en"), (3, " ".join(near), "en"), (4, "only copies", "en"), (5, "copies only", "en"), (6, " ", "en"), (7, " ".join(base), "de"), (8, "no language", None), (9, "no language", None)]
    d = spark.createDataFrame(rows, "k int, text string, lang string")
    member = {r.k: r.representative for r in near_duplicates.members(d, "k", "text", "lang").collect()}
    assert member == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4, 7: 7, 8: 8, 9: 8}
    pairs = {(r.a, r.b) for r in near_duplicates.similar_pairs(d, "k", "text", "lang").collect()}
    linked = {(a, b) for a in member for b in member if a < b and (member[a] == member[b] or (member[a], member[b]) in pairs or (member[b], member[a]) in pairs)}
    sets = {k: set(t.split()) for k, t, _ in rows}
    assert linked == {(a, b) for a in member for b in member if a < b and rows[a][2] == rows[b][2] and 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b])}


def test_rows_without_a_group_are_kept_and_compared(spark):
    rows = [(1, "a b c d", None), (2, "a b c d", None), (3, "a b c d", "en"), (4, "x y", None)]
    got = {r.k: r.dropped for r in near_duplicates.greedy_kept(spark.createDataFrame(rows, "k int, text string, lang string"), "k", "text", "lang").collect()}
    assert got == {1: False, 2: True, 3: False, 4: False}


def test_prefixes_are_cut_in_bounded_memory():
    rng = np.random.default_rng(8)
    n = np.concatenate(([0], rng.integers(0, 400, 5000), [200_000, 0, 3]))
    flat = rng.integers(-(2**63), 2**63, int(n.sum()))
    sets = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(flat))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(n))), sets], ["k", "hs"])
    common = np.sort(flat[::50])
    tracemalloc.start()
    got, peak = 0, 0
    for part in near_duplicates.cut_sets(iter([batch.slice(1)]), "k", 90, common, np.arange(len(common)) + 2):
        got += part.num_rows
        peak = max(peak, tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    assert got == int(np.minimum(n, n - (n * 90 + 99) // 100 + near_duplicates.SHARED).sum())
    # all 1.2 million tokens at once take some 60 MB
    assert peak < 30 << 20
