"""Calls with faults, the cache of vectors, romanisation, components and greedy resolution."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quernstone.functions import romanised
from quernstone.operators import caching, calls, components, near_duplicates


class Fake:
    """A client whose prompt says what happens at each call: t transient fault, f fault, x prose, j JSON, r JSON in the reasoning."""

    def __init__(self):
        self.at = {}

    def __call__(self, prompt):
        script = prompt.split("\n")[0]
        k = self.at[script] = self.at.get(script, -1) + 1
        step = script[k]
        if step == "t":
            raise calls.TransientError("busy")
        if step == "f":
            raise ValueError("no")
        return {"x": {"content": "sorry {"}, "j": {"content": f'```json\n{{"k": {k}, "again": {str("JSON" in prompt).lower()}}}\n```'}, "r": {"content": "", "reasoning": "so {a} it is {\"k\": 1} then"}}[step]


def test_calls_are_retried_and_no_row_is_lost(spark):
    scripts = ["j", "ttj", "ttttt", "f", "xj", "xxj", "xxx", "r", "xtj", "tf", None]
    waits = []
    policy = calls.Policy(tries=5, wait_s=3.0)
    for script, expected in {"ttj": [3.0, 6.0], "ttttt": [3.0, 6.0, 12.0, 24.0]}.items():
        waits.clear()
        calls.asked(Fake(), script, policy, waits.append)
        assert waits == expected
    d = spark.createDataFrame([(k, s) for k, s in enumerate(scripts)], "id long, prompt string").repartition(3)
    got = {r.id: r for r in calls.call(d, "id", "prompt", Fake, policy, lambda s: None).collect()}
    said = [(got[k].answer and json.loads(got[k].answer), got[k].calls, got[k].failure) for k in range(len(scripts))]
    assert said == [
        ({"k": 0, "again": False}, 1, None), ({"k": 2, "again": False}, 3, None), (None, 5, "TransientError: busy"), (None, 1, "ValueError: no"), ({"k": 1, "again": True}, 2, None), ({"k": 2, "again": True}, 3, None),
        (None, 3, "no JSON in the answer"), ({"k": 1}, 1, None), ({"k": 2, "again": True}, 3, None), (None, 2, "ValueError: no"), (None, 0, "no prompt"),
    ]
    assert calls.call(d.where("false"), "id", "prompt", Fake).count() == 0


def test_json_in_answers():
    good = {'{"a": 1}': {"a": 1}, '```\n{"a": 1}```': {"a": 1}, 'x {"a": {"b": 2}} y': {"a": {"b": 2}}, "{x} no": None, "": None, "[1]": [1]}
    assert {k: calls.json_in(k) for k in good} == good


def test_second_run_computes_nothing(spark, tmp_path):
    path, asked = str(tmp_path / "vectors"), []

    def compute(rows):
        asked.append(sorted(r.id for r in rows.collect()))
        return rows.where("content <> 'lost'").select("content_digest", F.length("content").alias("n"), F.array(F.col("id").cast("double")).alias("vector"))

    def run(rows, version="1"):
        d = spark.createDataFrame(rows, "id long, content string, content_digest string")
        return sorted((r.id, r.n) for r in caching.cached(d, F.col("content"), compute, path, version).collect())

    rows = [(1, "a", "x"), (2, "bb", "x"), (3, "bb", "y"), (4, None, "x"), (5, "lost", "x")]
    assert run(rows) == [(1, 1), (2, 2), (3, 2), (4, None), (5, None)]
    assert run(rows[:3]) == [(1, 1), (2, 2), (3, 2)]
    assert run([(1, "changed", "x"), (2, "bb", "x")]) == [(1, 7), (2, 2)]
    assert run([(2, "bb", "x")], "2") == [(2, 2)]
    assert len(asked[0]) == 4 and asked[1:] == [[], [1], [2]]
    assert run([]) == []


@pytest.mark.parametrize(
    ("word", "latin"),
    [
        ("తెలుగు", "telugu"), ("నమస్కారం", "namaskaaram"), ("భాష", "bhaasha"), ("క", "ka"), ("క్", "k"), ("ఆంధ్ర", "aamdhra"), ("హైదరాబాద్", "haidaraabaad"), ("ఒక్కడు", "okkadu"), ("దుఃఖం", "duhkham"), ("౧౨౩", "123"),
        ("స్త్రీ", "strii"), ("ఐ ఔ", "ai au"), ("కృష్ణ", "krshna"), ("OK  తెలుగు\n Café", "ok telugu cafe"), ("", ""), ("ి", "i"), ("ై", "ai"), ("हिन्दी", "हिन्दी"),
    ],
)
def test_romanised_words(word, latin):
    assert romanised.romanise(word) == latin


def test_marks_in_odd_places():
    # a sign after a soundless mark or a vowel is its own vowel, and the marks of other blocks go only up to U+036F
    for text, latin in (("క\u0c56ి", "kai"), ("అి్", "ai"), ("క్ి", "ki"), ("కిు", "kiu"), ("క\u0c46\u0c56", "kai"), ("é\u0327\u034f\u1ab0", "e\u034f\u1ab0")):
        assert romanised.romanise(text) == latin


def test_text_is_made_once_for_romanisation(spark, monkeypatch):
    from quernstone.plans import speech

    rows = spark.createDataFrame([(1, "Kit rag ~ é")], "doc_id long, text string")
    monkeypatch.setattr(speech, "table", lambda *_: rows)
    df = speech.romanised_texts(spark, "")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1
    assert df.first().digest == __import__("hashlib").md5(b"kita raaga").hexdigest()


def test_no_letter_of_the_script_is_left(spark):
    every = "".join(chr(c) for c in range(0x0C00, 0x0C80))
    rng = random.Random(1)
    rows = [("".join(rng.choice(every + "ab ") for _ in range(50)),) for _ in range(40)] + [(every,), (None,), ("Plain  ASCII",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(romanised.romanised(F.col("t"))).collect()]
    assert got == [None if t is None else romanised.romanise(t) for (t,) in rows]
    assert not any("ఀ" <= c < "ಀ" for t in got if t for c in t) and got[-1] == "plain ascii"


def plain_components(edges):
    low = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000 + k, 1001 + k) for k in range(200)] + [(5000, 4000 + k) for k in range(50)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: v for k, v in plain_components([e for e in edges if e[0] != e[1]]).items()}


@pytest.mark.parametrize("bound", [0, 30, 2_000_000])
def test_greedy_resolution_is_the_same_at_every_bound(spark, bound):
    rng = random.Random(3)
    edges = {(g, a, b) for g in "xyz" for _ in range(40) for a, b in [sorted(rng.sample(range(25), 2))]}
    edges = {(g, a + 100 * ord(g), b + 100 * ord(g)) for g, a, b in edges}
    kept, nodes = set(), sorted({x for _, a, b in edges for x in (a, b)})
    for n in nodes:
        if not any(b == n and a in kept for _, a, b in edges):
            kept.add(n)
    got = {r.rep: r.keep for r in near_duplicates.resolved(spark.createDataFrame(sorted(edges), "g string, a long, b long"), "g", bound).collect()}
    assert got == {n: n in kept for n in nodes}


def test_a_chain_of_ten_thousand_takes_few_jobs(spark):
    chain = spark.range(10_000).select(F.lit("g").alias("g"), F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "chain")
    got = near_duplicates.resolved(chain, "g").collect()
    jobs = len(tracker.getJobIdsForGroup("chain"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == 10_001 and all(r.keep == (r.rep % 2 == 0) for r in got) and jobs < 15
