"""Merkle manifest, page extraction and collocations against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from quernstone.llm import collocations, merkle, style_tree

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, pos long, leaf string, piece string, m long"


def documents(spark, rows):
    """rows of (doc_id, text, lang, source, n_chars), with columns of names that the operators use inside."""
    return spark.createDataFrame([(*r, "x", 3, "y", "z", 5) for r in rows], SCHEMA)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain_manifest(rows, fan=8):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha(*map(field, (r[0], r[3], r[2], r[4], text)))
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r, leaf(r, r[1])))

    def tree(nodes):
        """The root, and for each node the [(left, right)] on its way."""
        ways = [[] for _ in nodes]
        under = [[k] for k in range(len(nodes))]
        while len(nodes) > 1:
            up, upper = [], []
            for a in range(0, len(nodes), fan):
                run = nodes[a : a + fan]
                for k in range(len(run)):
                    for leaf_no in under[a + k]:
                        ways[leaf_no].append(("".join(run[:k]), "".join(run[k + 1 :])))
                up.append(sha(*run))
                upper.append([x for u in under[a : a + fan] for x in u])
            nodes, under = up, upper
        return nodes[0], ways

    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, ways = {}, {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        subroots[g], ways[g] = tree([h for _, h in groups[g]])
    root, above = tree([subroots[g] for g in order])
    out = []
    for g, over in zip(order, above, strict=True):
        for (r, h), way in zip(groups[g], ways[g], strict=True):
            steps = way + over
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            folded = leaf(r, low(r[1])) if hit and r[1] is not None else h
            for left, right in steps:
                folded = sha(left, folded, right)
            out.append((r[0], h, subroots[g], root, sha(*[x for s in steps for x in s]), folded, folded == root))
    return Counter(out)


def some_documents(n, seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcDEF é") for _ in range(rng.randrange(1, 9)))
    rows = [(k, " ".join(word() for _ in range(rng.randrange(6))), rng.choice(["en"] * 5 + ["", "zz", "fr", "Ünd"]), rng.choice(["s", None]), rng.choice([1, None])) for k in range(n)]
    odd = [(None, "A", None, None, None), (None, None, None, "s", 2), (3, None, "en", None, None), (3, "B", "en", None, None), (3, "B", "en", None, None), (9, "", "only", "", 0), (7, "A" * 300_000, "fr", "s", 300_000)]
    return rows + odd


@pytest.mark.parametrize("n", [0, 1, 9, 700])
def test_manifest_equals_a_plain_tree(spark, n):
    rows = some_documents(n) if n > 1 else some_documents(0)[:1] * n
    got = merkle.manifest(documents(spark, rows))
    assert Counter(tuple(r) for r in got.collect()) == (plain_manifest(rows) if rows else Counter())


def test_manifest_of_a_language_of_several_blocks_and_its_sql(spark):
    rows = [(k, f"Text {k}", "en", "s", k) for k in range(1200)] + [(k, "x", "de", "s", k) for k in range(65)]
    got = merkle.manifest(documents(spark, rows))
    found = Counter(tuple(r) for r in got.collect())
    assert found == plain_manifest(rows)
    db = duckdb.connect()
    db.register("documents", documents(spark, rows).toPandas())
    assert Counter(db.sql(merkle.oracle()).fetchall()) == found


def test_manifest_finds_what_was_changed(spark):
    rows = [(k, "Upper" if k % 2 else "lower", "en", "s", 1) for k in range(60)]
    for r in merkle.manifest(documents(spark, rows)).collect():
        assert r.verified == (not (r.doc_id % 2 and zlib.crc32(str(r.doc_id).encode()) % 3 == 0))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home with-sidebar"><header><h1>Site</h1></header>
<nav><ul><li>a<li>b</ul></nav><div class="cookie-banner"><p>We use cookies</p></div><article class="post has-comments">
<header><div><h1>Title &amp; more</h1></div><p class="meta">by x</p></header><p>First  para<br>two<p>Second <b>bold</b>
<span class="ad">AD <span>x</span> y</span>text&nbsp;z&#8212;<ul><li>one<li>two <a href=x>link</a></ul><table><tr><td>c1<td>c2<tr><td>c3</table>
<blockquote>quote</blockquote><form><input><p>Sub</p></form><aside>side</aside>tail<script>var a="</p>";</script><!-- no -->
<section id="comments"><article class="comment"><p>nice</p></article></section></article><div class="sidebar">s</div><footer>f</footer></body></html>"""


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (PAGE, "Title & more|First para two|Second bold text z—|one|two link|c1|c2|c3|quote|tail"),
        ("plain  text", "plain text"), ("<p>a<div>b</div>c", "a|b|c"), ("<nav><ul><li>x<article><p>real</article>", "real"), ("<form id=f><h1>T</h1><p>x</p></form>", "T|x"), ("<div class=ad>z</div>", ""),
        ("<article></article><div>q</div>", ""), ("<article><p>cut off &am", "cut off &am"), ("<main><div role=navigation>n</div><div>m</div></main>", "m"), ("<article><p>x<!-- c <p> -->y</p>z&lt;b&gt;&eacute</article>", "xy|z<b>é"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000 + "after", "deep|after"), ("<article>" + "<p>" * 5000 + "x</article>y", "x"), ("<ARTICLE><P CLASS='Notice'>n</P><P>k</ARTICLE>", "k"), ("<article><h1>a<h2>b</article>", "a|b"), ("<article hidden><p>h</article>", ""), ("", ""),
    ],
)
def test_blocks_of_a_page(html, text):
    assert "|".join(t for t, _ in style_tree.blocks(html)[0]) == text


def site(n, template, host="a.example", article=lambda k: f"<p>Story {k} begins.</p><p>It goes on for {k * 7} words.</p>"):
    return [(f"http://{host}/{k}", f"<html><body><div class='top'><p>{template}</p></div><div class='body'>{article(k)}</div><div class='end'><p>{template} again</p></div></body></html>") for k in range(n)]


def test_repeated_branches_of_a_site_go(spark):
    pages = site(12, "Subscribe now") + site(2, "Few pages", "b.example") + site(12, "all alike", "c.example", lambda k: "<p>same</p>") + [(None, "<p>no url</p>"), ("http://a.example/x", None), ("http://d.example/", "")]
    frame = spark.createDataFrame([(k, u, h, "x", 1) for k, (u, h) in enumerate(pages)], "page_id long, url string, html string, host string, row long")
    got = {r.page_id: r for r in style_tree.extract(frame).collect()}
    assert len(got) == len(pages)
    assert [got[k].text for k in range(12)] == [f"Story {k} begins.\nIt goes on for {k * 7} words." for k in range(12)]
    assert got[12].text.startswith("Few pages\n") and got[14].text == "all alike\nsame\nall alike again"
    assert [got[k].text for k in range(26, 29)] == ["no url", "", ""] and got[27].n_chars == 0
    assert style_tree.extract(frame.where("false")).collect() == []


def test_low_nodes_met_by_salt_give_the_same(spark):
    frame = spark.createDataFrame([(k % 5, u, h) for k, (u, h) in enumerate(site(12, "Subscribe now") * 2)], "page_id int, url string, html string")
    both = [Counter(map(tuple, style_tree.extract(frame, broadcast_rows=n).collect())) for n in (0, 1000)]
    assert both[0] == both[1] and sum(both[0].values()) == 24 and not any("Subscribe" in r[2] for r in both[0])


def test_copies_of_a_page_do_not_make_its_text_a_template(spark):
    article = lambda k: f"<article><div class='lead'><p>Copied text</p></div><p>{'same' if k < 40 else k}</p></article>"
    frame = spark.createDataFrame([(k, "http://a.example/", article(k)) for k in range(50)], "page_id long, url string, html string")
    # 40 equal pages count once, so the block is on 11 of 11 pages and still goes; the plain paragraph stays
    got = {r.page_id: r.text for r in style_tree.extract(frame).collect()}
    assert got[0].endswith("same") and got[45].endswith("45")


def plain_collocations(rows, least=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(r[1] or "")):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    per = defaultdict(list)
    for (lang, words), a in f.items():
        if len(words) < 2 or a < least:
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words)))
        longer = [b for (other, x), b in f.items() if other == lang and b >= least and len(x) > len(words) and any(x[i : i + len(words)] == words for i in range(len(x)))]
        if not any(100 * b >= inside * a for b in longer):
            per[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return Counter((lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in per.items() for k, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def test_collocations_equal_a_plain_count(spark):
    rng = random.Random(3)
    vocabulary = ["aa", "B", "c'c", "été", "d", "new", "york", "city", " x", "="]
    text = lambda: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n", " ! "]) for _ in range(rng.randrange(60)))
    rows = [(k, text() + "New York city; " * (k % 3), rng.choice(["en", "en", "de", None, "und", ""]), None, None) for k in range(120)]
    rows += [(None, None, "en", None, None), (1, "", None, None, None), (2, " \t ", "en", None, None), (5, "the same piece twice. " * 3_000, "long", None, None), (5, "one word " * 1_000, "long", None, None)] * 2
    got = collocations.collocations(documents(spark, rows))
    found = Counter(tuple(r) for r in got.collect())
    assert found == plain_collocations(rows) and len(found) > 30
    db = duckdb.connect()
    db.register("documents", documents(spark, rows).toPandas())
    assert Counter(db.sql(collocations.oracle()).fetchall()) == found
    cut = collocations.collocations(documents(spark, rows), top=3)
    assert Counter(tuple(r) for r in cut.collect()) == plain_collocations(rows, top=3)


def test_collocations_without_rows_or_words(spark):
    none = documents(spark, [])
    assert collocations.collocations(none).collect() == []
    assert collocations.collocations(documents(spark, [(1, None, "en", None, None)])).collect() == []


def test_collocation_scores_are_exact_beyond_64_bits(spark):
    # a count of some 10**13 can't be made of texts, so the same arithmetic over counts
    big = 3_000_000_000_001
    row = spark.range(1).select(F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (F.lit(big).cast("decimal(15,0)") * F.lit(big).cast("decimal(15,0)")), F.lit(big + 7).cast("decimal(15,0)") * F.lit(big + 9).cast("decimal(15,0)")).alias("s")).first()
    assert row.s == 1_000_000 * big * big // ((big + 7) * (big + 9))
