"""The operators on documents, against brute force, on small tables with every awkward row."""

import hashlib
import math
import random
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quernstone.llm import fertility, jaccard, lines, mixing, pieces, sharding, substrings, toxicity

#: Columns that operators use inside; documents may bring their own.
CLASHING = ("size", "h", "n", "s", "target", "rank", "shard", "slot", "line", "component", "doc", "score", "kind", "ids", "bucket", "start", "list")
WORDS = [a + b for a in ("ka", "lo", "mi", "su", "te", "vo") for b in ("ran", "dil", "pes", "mor", "tuk", "bel", "fin")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def rows(seed=1):
    """(doc_id, text, source): copies, near copies, a hot group, shared passages, long, empty, blank and null texts, null and repeated ids."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    out = [(k, prose(rng, rng.randint(6, 200)), f"s{k % 4}") for k in range(30)]
    hot = prose(rng, 90)
    out += [(100 + k, hot, "s0") for k in range(12)]
    for k in range(8):
        w = base.split()
        w[k * 11 % len(w)] = "changed" + str(k)
        out.append((200 + k, " ".join(w), None))
    passage = prose(rng, 70)
    out += [(300 + k, f"{prose(rng, 40)}\n{passage}\n{prose(rng, 25)}", "s1") for k in range(4)]
    out += [(400, prose(rng, 6000), "s2"), (401, "", "s2"), (402, " \n\t ", "s2"), (403, None, "s3"), (404, "one two", "s3"), (405, "ONE  two", "s3"), (406, "Ünï çödé ☃ 漢字 " * 9, ""), (407, "ab" * 700, "s1"), (408, "q" * 5000, "s1")]
    out += [(None, "no id here " * 12, "s1"), (500, "twice the same row " * 15, "s1"), (500, "twice the same row " * 15, "s1")]
    return out


def frame(spark, data, clash=True):
    d = spark.createDataFrame(data, "doc_id long, text string, source string").selectExpr("*", "'en' as lang", "cast(length(text) as long) as n_chars")
    for c in CLASHING if clash else ():
        d = d.selectExpr("*", f"'x' as `{c}`")
    return d.repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, rows()).persist()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def words(text):
    return (text or "").encode().split()


# --- mixing --------------------------------------------------------------------------------------------------------


def brute_targets(sizes, share=1.5, repeat=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * unit > repeat * sizes[s]}
        if not over:
            return target | {s: weight[s] * unit for s in open_}
        for s in over:
            target[s] = repeat * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing(docs):
    got = mixing.taken(docs, block=16).collect()
    data = rows()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(words(t))) for i, t, _ in data)
    sizes = Counter()
    for _, t, s in data:
        sizes[s] += len(words(t))
    target = brute_targets(sizes)
    source = {(i, len(words(t))): s for i, t, s in data}
    taken = Counter()
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    again = mixing.taken(docs.repartition(7), block=16).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mixing_empty(none, spark):
    assert mixing.taken(none).collect() == []
    assert [tuple(r) for r in mixing.taken(frame(spark, [(1, None, "a")])).collect()] == [(1, 0, 0, 0.0, 0)]


def test_schedule_is_a_permutation_with_even_shares(spark):
    import numpy as np

    got = mixing.schedule(spark, [(1, 500), (2, 200), (3, 13)], chunk=64).orderBy("place").collect()
    by = {s: [r["rank"] for r in got if r.source_no == s] for s in (1, 2, 3)}
    assert {s: len(x) for s, x in by.items()} == {1: 500, 2: 200, 3: 13}
    assert all(x == list(range(len(x))) for x in by.values())
    part = [r.source_no for r in got][: len(got) // 2]
    assert abs(part.count(1) - 250) < 15 and abs(part.count(2) - 100) < 12
    assert np.array_equal(mixing.reverse_bits(np.arange(8), 3), [0, 4, 2, 6, 1, 5, 3, 7])


def test_mix_documents_against_a_walk_over_the_streams(docs):
    out = mixing.mix_documents(docs, block=16)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.source) for r in out.select("doc_id", "text", "source").collect())
    place = docs.select("doc_id", "text", "source", F.xxhash64("doc_id", F.lit(11)).alias("o"), F.xxhash64("text").alias("t")).collect()
    sizes = Counter()
    for r in place:
        sizes[r.source] += len(words(r.text))
    expected, target = Counter(), brute_targets(sizes)
    for s in sizes:
        end, at = round(target[s]), 0
        stream = sorted((r for r in place if r.source == s), key=lambda r: (r.o % 256, r.o, len(words(r.text)), r.t))
        for epoch in range(2):
            first = True
            for r in stream:
                n = len(words(r.text))
                took = max(0, min(at + n, end) - at)
                if (2 * took >= n or (first and epoch == 0 and took)) if n else (at < target[s] or (sizes[s] == 0 and epoch == 0)):
                    expected[r.doc_id, r.text, r.source] += 1
                first = first and not n
                at += n
    assert got == expected


def test_mix_documents_keeps_a_source_of_one_long_document(spark):
    data = [(1, "a " * 5000, "x"), (2, "b " * 500, "y"), (3, "c " * 40000, "z")]
    out = mixing.mix_documents(frame(spark, data))
    assert {r.source for r in out.collect()} == {"x", "y", "z"}


def test_mix_documents_tells_rows_of_one_id_apart(spark):
    data = [(7, f"w{k} " * 50, "x") for k in range(40)] + [(8, "b " * 4000, "y")]
    d = frame(spark, data, clash=False).withColumn("__ROW", F.lit(1))
    out = mixing.mix_documents(d, share=0.5)
    assert out.columns == d.columns
    n = Counter(r.text for r in out.where("source = 'x'").collect())
    assert max(n.values()) <= 2


# --- toxicity ------------------------------------------------------------------------------------------------------


def labelled(spark, n=400):
    rng = random.Random(3)
    bad = ("zorbag", "pluknit", "skrevol", "wimtrash")
    data, marks = [], []
    for k in range(n):
        w, toxic = prose(rng, rng.randint(5, 120)).split(), int(k % 4 == 0)
        for _ in range(2 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        data.append((k, " ".join(w), "s"))
        marks.append((k, toxic))
    return frame(spark, data), spark.createDataFrame([*marks, (None, 1), (7, None)], "doc_id long, toxic int"), dict(marks)


def test_toxicity(spark, docs, none):
    d, labels, truth = labelled(spark)
    got = {r.doc_id: r for r in toxicity.toxicity(d, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    assert sum(got[i].predicted == truth[i] for i in held) / len(held) > 0.95
    model = toxicity.fit(d, labels)
    clean, misspelt = model([b"karan lodil mipes sumor tetuk", b"karan lodil mipes zorrbag tetuk pluknitt"])
    assert misspelt > clean
    other = toxicity.score(docs, model).collect()
    assert len(other) == len(rows()) and all(0 <= r.score <= 1 for r in other)
    assert all(r.score == 0 for r in other if r.doc_id in (401, 402, 403))
    assert toxicity.toxicity(none, labels).collect() == []
    assert {r.score for r in toxicity.toxicity(d, labels.where("toxic = 0")).collect()} == {0.0}
    kept = toxicity.clean_documents(d, model)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_a_text_over_the_budget_does_not_end_the_sample(spark):
    d, labels, _ = labelled(spark, 200)
    first = labels.where(~toxicity.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").first().doc_id
    long = d.withColumn("text", F.when(F.col("doc_id") == first, F.repeat("text", 1000)).otherwise(F.col("text")))
    model = toxicity.fit(long, labels, max_bytes=40_000)
    assert len(set(model([b"karan lodil mipes sumor tetuk", b"karan lodil mipes zorrbag tetuk pluknitt"]))) == 2


def plain_score(model, text):
    """The score by its definition, one word and one n-gram at a time."""
    table, base, _ = toxicity.hash_tables(31)
    words, total, n = text.lower().split(), 0.0, 0
    for k in range(0, len(words), toxicity.WINDOW):
        logits = []
        for w in words[k : k + toxicity.WINDOW]:
            padded = b" " + w + b" "
            for size in toxicity.SIZES:
                for i in range(len(padded) - size + 1):
                    h = sum(int(table[c]) * pow(int(base), j, 1 << 64) for j, c in enumerate(padded[i : i + size])) * 0x9E3779B97F4A7C15 % (1 << 64)
                    logits.append(float(model.table[h >> (64 - toxicity.BUCKET_BITS)]))
        z = model.bias + sum(logits) / max(1, len(logits))
        total += min(max(z, 0) + math.log1p(math.exp(-abs(z))), toxicity.MOST)
        n += 1
    return 1 - math.exp(-max(0.0, total - n * model.mean - toxicity.DEVIATIONS * math.sqrt(n) * model.deviation))


def test_scores_equal_the_plain_version(spark):
    d, labels, _ = labelled(spark, 200)
    model = toxicity.fit(d, labels)
    texts = [t.encode() for _, t, _ in rows() if t is not None] + [b"x", b"a\t\tb  zorrbag ", b"plukniz zorrbag " * 3]
    for text, got in zip(texts, model(texts), strict=True):
        assert got == pytest.approx(plain_score(model, text), abs=1e-6)


def test_length_alone_makes_no_text_toxic(spark):
    d, labels, truth = labelled(spark)
    model = toxicity.fit(d, labels)
    rng = random.Random(77)
    long = prose(rng, 60_000).encode()
    bad = next(r.text for r in d.collect() if truth[r.doc_id] == 1).encode()
    clean, toxic = model([long, b" ".join([bad, long[:200_000]] * 3 + [bad] * 60)])
    assert clean < 0.5 < toxic


def test_the_sample_holds_both_classes_whatever_one_takes():
    sizes = [(1, 0, 90), (2, 0, 30), (3, 1, 60), (4, 0, 25), (5, 1, 50), (6, 1, 1)]
    assert [i for i, _, _ in toxicity.within(sizes, 100)] == [2, 5]


# --- n-gram Jaccard join -------------------------------------------------------------------------------------------


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(data):
    own = [(i, shingles(t)) for i, t, _ in data if i is not None]
    parent = {i: i for i, _ in own}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(own):
        for j, b in own[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard(spark, seed):
    data = rows(seed)
    rng = random.Random(seed)
    for k in range(60):  # chains: each like the one before, ends unlike
        w = data[k % 3][1].split() if k < 3 else data[-3][1].split()
        if len(w) > 10:
            w[rng.randrange(len(w))] = f"edit{k}"
        data.append((1000 + k, " ".join(w), "s"))
    got = jaccard.jaccard_components(frame(spark, data)).collect()
    expected = brute_components(data)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter((i, len(shingles(t)), expected.get(i)) for i, t, _ in data)


def test_jaccard_stage(docs, none):
    assert jaccard.jaccard_components(none).collect() == []
    out = jaccard.one_of_each_group(docs)
    assert out.columns == docs.columns
    expected = brute_components(rows())
    assert Counter(r.doc_id for r in out.select("doc_id").collect()) == Counter([i for i, c in expected.items() if i == c] + [None])


def test_prefix_asks_for_shared_entries():
    import numpy as np

    rng = np.random.default_rng(0)
    heavy = np.sort(rng.integers(0, 2**63, 50).astype(np.uint64))
    cost = rng.integers(8, 5000, 50)
    for _ in range(200):
        n = int(rng.integers(1, 300))
        a = np.unique(np.concatenate((rng.integers(0, 2**63, n).astype(np.uint64), rng.choice(heavy, 20))))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, n // 20).astype(np.uint64))))
        if 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b)):
            (p, x), (q, y) = jaccard.prefix(a, heavy, cost), jaccard.prefix(b, heavy, cost)
            assert len(np.intersect1d(p, q)) >= min(x, y) >= 1


# --- suffix arrays -------------------------------------------------------------------------------------------------


def brute_substrings(data, length):
    texts = [(i, (t or "").encode()) for i, t, _ in data]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = Counter()
    for i, t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()] += 1
    return out


@pytest.mark.parametrize(("length", "gram", "salt"), [(200, 48, 20_000), (60, 16, 2)])
def test_substrings(docs, length, gram, salt):
    got = substrings.dedup(docs, length, gram, salt).collect()
    assert Counter(map(tuple, got)) == brute_substrings(rows(), length)


def test_shards_give_each_repeated_window_once(spark, monkeypatch):
    """What a shard knows to be repeated does not come back from the other shards too."""
    rng = random.Random(3)
    common, pairs = prose(rng, 60), [prose(rng, 20) for _ in range(6)]
    data = [(k, f"{prose(rng, 3)} {pairs[k % 6]} {common} {prose(rng, 3)}", "s") for k in range(24)]
    given, islands = [], substrings.islands
    monkeypatch.setattr(substrings, "islands", lambda windows: islands(given.append(windows) or windows))
    got = substrings.dedup(frame(spark, data), 60, 16, 2).collect()
    assert Counter(map(tuple, got)) == brute_substrings(data, 60)
    windows = Counter((r.anchor, r.context, at) for r in given[0].collect() for at in range(r.lo, r.hi + 1))
    assert windows and max(windows.values()) == 1


def test_substrings_empty(none):
    assert substrings.dedup(none).collect() == []


def test_removed_runs_join_spans_that_touch_or_overlap(spark):
    import numpy as np

    def brute(spans):
        covered = sorted({k for a, b in spans for k in range(a, b)})
        first = [k for k in covered if k - 1 not in covered]
        return [(a, next(k + 1 for k in covered if k >= a and k + 1 not in covered)) for a in first]

    rng = random.Random(5)
    windows, expected = [], {}
    for c in range(60):
        spans = [(a, a + rng.randint(1, 6)) for a in (rng.randint(0, 90) for _ in range(rng.randint(0, 25)))]
        begin, end = substrings.removed_runs(np.array([a << 32 | b for a, b in spans], np.int64))
        assert list(zip(begin.tolist(), end.tolist(), strict=True)) == brute(spans)
        windows += [(7, c, a, b - 1) for a, b in spans]
        expected[c] = brute(spans)
    got = substrings.islands(spark.createDataFrame(windows, "anchor long, context long, lo int, hi int")).collect()
    assert Counter((r.context, (r.lo, r.hi + 1)) for r in got) == Counter((c, x) for c, spans in expected.items() for x in spans)


def test_suffix_array_and_common_prefixes():
    import numpy as np

    rng = random.Random(4)
    for _ in range(20):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(8)] + [b"a" * 30]
        text = b"".join(parts)
        order = substrings.suffix_array(np.frombuffer(text, np.uint8))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        sizes = np.array([len(p) for p in parts])
        shared = substrings.common_prefixes(np.frombuffer(text, np.uint8), order, np.cumsum(sizes) - sizes, 10**6)
        for k in range(1, len(order)):
            a, b = text[order[k - 1] :], text[order[k] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] == n


# --- SentencePiece -------------------------------------------------------------------------------------------------


def brute_viterbi(v, table, text):
    if not text:
        return []
    t = (" " + text).replace(" ", pieces.MARK)
    longest, best, back = max(map(len, table)), [0.0], [None]
    for end in range(1, len(t) + 1):
        top, how = best[end - 1] + v.fallback, (1, -1)
        for size in range(1, min(longest, end) + 1):
            hit = table.get(t[end - size : end])
            if hit and (size == 1 or best[end - size] + hit[1] > top):
                top, how = best[end - size] + hit[1], (size, hit[0])
        best.append(top)
        back.append(how)
    out, end = [], len(t)
    while end:
        size, i = back[end]
        out.append([i] if i >= 0 else v.fallback_ids(t[end - 1].replace(pieces.MARK, " ")))
        end -= size
    return [i for part in reversed(out) for i in part]


def test_pieces(docs, none):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=pieces.VOCABULARY)
    table = {m.IdToPiece(i): (i, m.GetScore(i)) for i in range(m.GetPieceSize()) if not (m.IsByte(i) or m.IsControl(i) or m.IsUnknown(i))}
    v = pieces.Vocabulary()
    data = [*rows(), (0, " lead  and\n\ntrail \n", ""), (0, "\x00☃ 漢", "")]
    for _, t, _ in data:
        ids = v.encode(t or "")
        assert v.decode(ids) == (t or "")
        assert ids == brute_viterbi(v, table, t or "")
    encoded = pieces.encode(docs)
    got = encoded.collect()
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids)) for r in got) == Counter((i, len(e), tuple(e)) for i, t, _ in rows() for e in [v.encode(t or "")])
    assert Counter(map(tuple, pieces.decode(encoded).collect())) == Counter((i, t or "") for i, t, _ in rows())
    assert pieces.encode(none).collect() == []


def test_long_units_in_stretches(monkeypatch):
    v = pieces.Vocabulary()
    rng = random.Random(8)
    unit = "".join(rng.choice("abcdeinorst漢\u2603") for _ in range(700))
    whole = v.alone(unit)
    monkeypatch.setattr(pieces.Vocabulary, "STRETCH", 37)
    assert v.alone(unit) == whole and v.decode(v.encode(unit)) == unit


def test_a_megabyte_without_blanks():
    v = pieces.Vocabulary()
    text = "thequickbrownfox" * 65_536
    ids = v.encode(text)
    assert v.decode(ids) == text and len(ids) < len(text) / 2


def test_decoding_skips_ids_without_a_piece(spark):
    v = pieces.Vocabulary()
    ids = v.encode("some words")
    d = spark.createDataFrame([(1, ids), (2, [*ids[:1], -5, 10**6, None, *ids[1:]]), (3, None), (4, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in pieces.decode(d).collect()} == {1: "some words", 2: "some words", 3: "", 4: ""}


def test_sentencepiece_query_decodes_its_ids(docs, tmp_path):
    from quernstone.llm import queries

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op6_sentencepiece(docs.sparkSession, str(tmp_path)).collect()
    v = pieces.Vocabulary()
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded_sha256) for r in got) == Counter((i, len(e), tuple(e), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows() for e in [v.encode(t or "")])


# --- quality rules -------------------------------------------------------------------------------------------------


def test_fertility(docs, none):
    got = fertility.measure(docs).collect()
    assert len(got) == len(rows())
    expected = Counter()
    for i, t, _ in rows():
        w = words(t)
        seen = Counter(zip(w, w[1:], w[2:]))
        hit = set()
        for k in range(len(w) - 2):
            if seen[tuple(w[k : k + 3])] > 1:
                hit |= {k, k + 1, k + 2}
        ls = [x for x in (t or "").split("\n") if x.encode().split()]
        expected[i, len(w), sum(len(x.decode()) for x in w), sum((t or "").count(c) for c in "#*$%&|<>"), len(ls) - len(set(ls)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == expected
    assert not any(r.kept and r.base_failed for r in got)
    assert all(r.kept for r in got if r.doc_id is not None and r.doc_id < 30 and not r.base_failed)
    assert fertility.measure(none).collect() == []


def test_fertility_rejects_what_is_no_prose(spark):
    rng = random.Random(9)
    soup = " ".join("".join(rng.choice("☃☂☁☀★☎✂✈") for _ in range(6)) for _ in range(200))
    got = {r.doc_id: r for r in fertility.measure(frame(spark, [(1, soup, "s"), (2, prose(rng, 300), "s")])).collect()}
    assert not got[1].base_failed and not got[1].kept and got[2].kept


# --- fuzzy lines ---------------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute_lines(data):
    """Texts after dedup, by comparing all lines."""
    import numpy as np

    spots = []
    for i, t in {(i, t) for i, t, _ in data}:
        for at, line in enumerate((t or "").split("\n")):
            plain = lines.normalise(line.encode())
            if plain:
                spots.append((plain, i, t, at))
    names = sorted({p for p, *_ in spots})
    sims = lines.simhashes(names)
    parent = list(range(len(names)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(names)):
        for b in np.flatnonzero(np.bitwise_count(sims[:a] ^ sims[a]) <= 26).tolist():  # to spare time, the distance only of lines that are not far apart
            x, y = names[a].decode(), names[b].decode()
            if distance(x, y) <= int(max(len(x), len(y)) * (1 - lines.SIMILAR) + 1e-9):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    index = {p: k for k, p in enumerate(names)}
    groups = {}
    for p, i, t, at in spots:
        groups.setdefault(find(index[p]), []).append((i is None, i, t, at))
    return groups


def test_lines(spark, none):
    rng = random.Random(5)
    shared = [prose(rng, 14) for _ in range(6)]
    data = []
    for k in range(40):
        body = [prose(rng, rng.randint(2, 20)) for _ in range(rng.randint(0, 4))]
        for s in rng.sample(shared, 2):
            w = s.split()
            body.append(" ".join(w).upper() if k % 3 else s.replace("a", "e", 1) if k % 2 else s + " 1" + str(k % 10))
        data.append((k, "\n".join(body) + "\n" * (k % 2), "s"))
    data += [(None, "some line without an id at all\n" + shared[0], "s"), (41, None, "s"), (42, "", "s"), (43, "\n\n", "s"), (44, data[0][1], "s"), (44, data[0][1], "s")]
    d = frame(spark, data)
    out = lines.without_repeats(d)
    assert out.columns == d.columns
    groups = brute_lines(data)
    gone = {}
    for members in groups.values():
        # ids ordered last when null; equal ids of other texts are not in these data
        first = min(members, key=lambda m: (m[0], m[1] if m[1] is not None else 0))
        same_id = [m for m in members if (m[0], m[1]) == (first[0], first[1])]
        keep = min(same_id, key=lambda m: m[3])
        for m in members:
            if m != keep:
                gone.setdefault((m[1], m[2]), set()).add(m[3])
    expected = Counter()
    for i, t, _ in data:
        expected[i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get((i, t), ()))] += 1
    assert Counter((r.doc_id, r.text) for r in out.select("doc_id", "text").collect()) == expected
    assert lines.without_repeats(none).collect() == []
    counts = lines.without_repeats(d, counts=True).collect()
    assert sum(r.n_removed for r in counts) == sum(len(gone.get((i, t), ())) for i, t, _ in data)


def changed(rng, line, n):
    for _ in range(n):
        at = rng.randrange(len(line))
        line = line[:at] + rng.choice(["", "x", line[at] + "y"]) + line[at + 1 :]
    return line


def test_similar_lines_are_found(spark):
    """Against brute force on edit similarity alone."""
    rng = random.Random(11)
    names = []
    for k in range(36):
        base = prose(rng, 6 + k)
        names += [base, changed(rng, base, 1 + k % 3), changed(rng, base, len(base) // 20)]
    close = lambda a, b: distance(a, b) <= int(max(len(a), len(b)) * (1 - lines.SIMILAR) + 1e-9)
    alike = [{j for j in range(k) if abs(len(names[j]) - len(x)) * 10 <= max(len(names[j]), len(x)) and close(names[j], x)} for k, x in enumerate(names)]
    later = {k for k, before in enumerate(alike) if before}
    got = {r.doc_id: r.text for r in lines.without_repeats(frame(spark, [(k, x, "s") for k, x in enumerate(names)])).collect()}
    gone = {k for k, x in enumerate(names) if got[k] != x}
    assert len(later) >= 70 and gone <= later
    assert len(gone) >= 0.97 * len(later)


def test_a_pair_of_several_blocks_is_made_once(spark):
    """Of lines that share a long passage and are in components of their own, each pair comes from one of their blocks, and none is lost."""
    import pyarrow as pa

    rng = random.Random(6)
    passage = prose(rng, 60)
    names = [f"{prose(rng, 14)} {passage}".encode() for _ in range(40)]
    texts = spark.createDataFrame([(k, x.decode(), k) for k, x in enumerate(names)], "id long, plain string, component long")
    made = []
    entries = lines.packed(texts, 16, True).collect()
    by_part = {}
    for r in entries:
        by_part.setdefault(r.part, []).append(r)
    shared = set()
    for rows in by_part.values():
        x = lines.Buckets(pa.table({c: pa.array([bytes(r[c]) if r[c] is not None else None for r in rows], pa.binary()) for c, _ in lines.PACKED}), lines.LATER_LANES)
        for i, j in x.meetings(x.outside()):
            ok = (x.ids[i] != x.ids[j]) & (x.apart(i, j) <= lines.LATER_NEAR + x.more[i])
            shared |= {(max(a, b), min(a, b)) for a, b in zip(x.ids[i[ok]].tolist(), x.ids[j[ok]].tolist(), strict=True)}
            one = ok & ~lines.share_any(x.below[i], x.below[j])
            made += {(max(a, b), min(a, b)) for a, b in zip(x.ids[i[one]].tolist(), x.ids[j[one]].tolist(), strict=True)}
    assert len(shared) > 50 and sorted(made) == sorted(shared)
    got = lines.across(lines.packed(texts, 16, True), lines.LATER_NEAR, True).collect()
    assert {(r.u, r.v) for r in got} == shared


def least_of_each(links):
    least = {x: x for pair in links for x in pair}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return least


@pytest.mark.parametrize("bound", [16, 1024])
def test_lines_of_one_passage_make_rows_in_proportion(spark, monkeypatch, bound):
    """Lines that share a long passage make rows as many as lines before they are compared, and what is similar comes together, in whole crowds and in bins."""
    monkeypatch.setattr(lines, "CROWD", bound)
    rng = random.Random(6)
    passage = prose(rng, 60)
    names = [f"{prose(rng, 5 + k % 5)} {passage}" for k in range(120)]
    texts = spark.createDataFrame([(k, x, k // 2) for k, x in enumerate(names)], "id long, plain string, component long").cache()
    pairs = [(r.u, r.v) for r in lines.across(lines.packed(texts, 16, True), lines.LATER_NEAR, True).collect()]
    ok = lines.all_within([(names[u], names[v], int(max(len(names[u]), len(names[v])) * (1 - lines.SIMILAR) + 1e-9)) for u, v in pairs])
    same = [(2 * k, 2 * k + 1) for k in range(60)]
    links = [p for p, hit in zip(pairs, ok.tolist(), strict=True) if hit]
    near = lines.crowds(lines.packed(texts, 16, False), lines.LATER_NEAR).cache()
    assert len(pairs) > 10 * len(names) and 0 < len(links) < len(pairs) and near.count() <= 4 * len(names)
    found = [(r.u, r.v) for r in lines.ties(texts, lines.components(near), 4, lines.LATER_NEAR, lines.SIMILAR).collect()]
    assert set(found) <= set(links) and least_of_each(found + same) == least_of_each(links + same)
    assert len(found) < 60 if bound > 120 else len(found) < len(links)


def test_short_lines_and_lines_without_blanks_are_deduplicated(spark):
    script = "\u6f22\u5b57\u304b\u306a\u4ea4\u3058\u308a\u306e\u4e00\u884c\u3067\u3059"
    data = [(k, f"Les.\nonly {'abcdef'[k] * 5} here\n{script}\n", "s") for k in range(6)]
    got = {r.doc_id: r.text for r in lines.without_repeats(frame(spark, data)).collect()}
    assert got == {k: t if k == 0 else f"only {'abcdef'[k] * 5} here\n" for k, t, _ in data}


def test_lines_are_split_and_normalised():
    rng = random.Random(4)
    texts = ["".join(rng.choice("aB\u00e9 \t\n\r\x0b") for _ in range(rng.randint(0, 60))).encode() for _ in range(200)] + [b"", b"\n\n", b" a ", b"x"]
    data, starts, ends, text, at = lines.split_lines(texts)
    got = [(t, k, data[a:b].tobytes()) for a, b, t, k in zip(starts, ends, text, at, strict=True)]
    assert got == [(t, k, lines.normalise(x)) for t, y in enumerate(texts) for k, x in enumerate(y.split(b"\n"))]


def test_edit_distance():
    rng = random.Random(8)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abcd\u6f22 ") for _ in range(rng.randint(0, 200 if rng.random() < 0.2 else 60)))
        b = changed(rng, a, rng.randint(0, 8)) if len(a) > 10 and rng.random() < 0.8 else "".join(rng.choice("abc ") for _ in range(rng.randint(0, 40)))
        pairs.append((a, b, distance(a, b)))
    for most in (0, 1, 2, 4, 7, 12):
        assert [lines.within(a, b, most) for a, b, _ in pairs] == [d <= most for *_, d in pairs]
        assert lines.all_within([(a, b, most) for a, b, _ in pairs]).tolist() == [d <= most for *_, d in pairs]


def test_edit_distance_of_long_lines_takes_time_by_their_changes():
    rng = random.Random(10)
    pairs = []
    for k in range(6):
        a = prose(rng, 7000)[:40_000]
        b = "".join(c.upper() if j in (0, 20_000 + k, len(a) - 1) else c for j, c in enumerate(a)) + "!"
        pairs += [(a, b, len(a) // 10), (b, a, 4), (a, b, 0)]
    began = time.process_time()
    assert lines.all_within(pairs).tolist() == [True, True, False] * 6
    assert time.process_time() - began < 1


def test_edit_distance_of_all_kinds_of_characters():
    """Codes of one, two and four bytes, NUL and the values beside the marks, and sides of very different length, in one call."""
    rng = random.Random(11)
    pairs = []
    for kinds in ("ab", "a", "\0\1\2b", "a\xfd\xfe\xff", "a\ufffd\ufffe\uffff", "a\U0001f600\U0010ffff"):
        for _ in range(60):
            a = "".join(rng.choice(kinds) for _ in range(rng.choice([1, 2, 7, 40, 90])))
            b = changed(rng, a, rng.randint(0, 6)) if len(a) > 10 and rng.random() < 0.7 else "".join(rng.choice(kinds) for _ in range(rng.choice([0, 1, 30])))
            pairs += [(a, b, most) for most in (0, 1, 3, 8, 30)]
    assert lines.all_within(pairs).tolist() == [distance(a, b) <= most for a, b, most in pairs]


def test_names_of_lines():
    data, starts, ends, _, _ = lines.split_lines([b"one\n\n  two \x00\n", b"", b"\xc3\xa9", b"one"])
    some = ends > starts
    assert (lines.line_hashes(data, starts[some], 61) == lines.slice_hashes(data, 61)(starts[some], ends[some])).all()


def test_very_long_lines(spark):
    rng = random.Random(9)
    long = prose(rng, 150_000)  # about a million characters
    near = changed(rng, long, 60)
    far = " ".join(x if k % 4 else "other" for k, x in enumerate(long.split(" ")))
    got = {r.doc_id: r.text for r in lines.without_repeats(frame(spark, [(0, long, "s"), (1, near + "\nend", "s"), (2, far, "s")])).collect()}
    assert got == {0: long, 1: "end", 2: far}


def test_lines_of_other_digits_stay(spark):
    rows = ["2019 1423 5521 9034", "2018 7765 1290 4471", "row 17 of 3 May 2001: 5,120 paid", "row 94 of 8 May 1987: 3,466 paid", "2019 1423 5521 9035"]
    got = {r.doc_id: r.text for r in lines.without_repeats(frame(spark, [(k, x, "s") for k, x in enumerate(rows)])).collect()}
    assert got == dict(enumerate(rows)) | {4: ""}


# --- sharding ------------------------------------------------------------------------------------------------------


def test_sharding(docs, none, spark):
    got = sharding.shard(docs).collect()
    data = rows()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in data)
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    again = sharding.shard(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.shard, r.slot) for r in again) == Counter((r.doc_id, r.shard, r.slot) for r in got)
    assert sharding.shard(none).collect() == []


def test_shards_are_even_and_hold_groups(spark):
    rng = random.Random(8)
    data = [(k, prose(rng, rng.randint(20, 60)), "s") for k in range(600)]
    data += [(1000 + k, "pair " + data[k // 2][1], "s") for k in range(100)]
    data += [(2000 + k, "a third of all rows hold this text " * 6, "s") for k in range(300)]
    got = sharding.shard(frame(spark, data)).collect()
    loads = Counter()
    for r in got:
        loads[r.shard] += r["size"]
    assert max(loads.values()) - min(loads.values()) <= 2 * max(r["size"] for r in got)
    where = {r.doc_id: r.shard for r in got}
    assert sum(where[1000 + 2 * k] == where[1001 + 2 * k] for k in range(50)) >= 45
    assert len({where[2000 + k] for k in range(300)}) <= 5


def test_parities_are_compared_in_bounded_memory():
    rng = np.random.default_rng(9)
    rows = [rng.bytes(jaccard.BITS // 8) for _ in range(50)]
    column = pa.chunked_array([pa.array(rows[:20], pa.binary()).slice(5), pa.array([], pa.binary()), pa.array(rows[20:], pa.binary())])
    bits = jaccard.fixed_binary(column).view(np.uint64).reshape(45, -1)
    assert bits.tobytes() == b"".join(rows[5:])
    i, j = rng.integers(0, 45, (2, 1 << 19))
    tracemalloc.start()
    apart = jaccard.bits_apart(bits, i, j)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # at once, the rows of so many pairs take some 140 MB
    assert peak < 20 << 20
    some = slice(0, 70_000)
    assert (apart[some] == np.bitwise_count(bits[i[some]] ^ bits[j[some]]).sum(axis=1)).all()
