"""Merkle manifest of a dataset, with a proof for each row, by higher-order SQL functions alone.

Tree. A row's leaf is the SHA-256 of its fields, each with its length in front. In each language, in the order of
doc_id, every `FAN` consecutive nodes become one until one remains; the languages' subroots give the root likewise.

Blocks. `FAN ** LEVELS` consecutive nodes are one row with an array of them; sequence, transform, slice and aggregate
collapse it by up to LEVELS levels inside that row. Block ends are ends of runs at each level, so the blocks' roots are
the nodes of a level of the tree, and the same step takes them up until a language has one node: a round divides the
rows by 512, so 10**12 rows take five. Paths come down the same way: each block gets that of its root, and a row's
proof is its block's own siblings with the path above. No row has more than one block's hashes and the largest task one
range of the order (see operators/ranking.py), so a language with most rows is spread as any other.

Cases. Null fields are `-`, apart from empty ones (`0:`). Null doc_id: before all others, never tampered. Rows of
equal doc_id are ordered by leaf, so only equal leaves tie. Null text stays null when tampered; a text without A-Z
isn't changed and verifies. Null lang is a group before all others, apart from the empty one. One row: it is leaf,
subroot and root, and its proof has no siblings (the hash of no bytes). Empty table: no rows. Other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.operators.ranking import positions

from .common import ASCII_LOWER, ASCII_UPPER, materialise

FAN, LEVELS = 8, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<l:string,r:string>"


def h(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(text: Column) -> Column:
    """The hash of a row's fields, with `text` for its text."""
    values = [text if c == "text" else F.col(c).cast("string") for c in FIELDS]
    return h(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, g, leaf, tampered): g orders the languages with null first; tampered is null where that leaf is the same."""
    text = F.col("text")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    low = F.translate(text, ASCII_UPPER, ASCII_LOWER)
    g = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("g")
    return docs.select(*FIELDS).select("doc_id", g, leaf(text).alias("leaf"), F.when(hit & (low != text), leaf(low)).alias("tampered"))


def up(nodes: Column, levels: Column) -> Column:
    """[nodes, the level above, ...]: `levels` more levels, every FAN consecutive hashes of one joined and hashed to one of the next."""

    def over(below: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / FAN).cast("int"))
        return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(below, i * FAN + 1, F.lit(FAN)), ""), 256))

    steps = F.when(levels > 0, F.sequence(F.lit(1), levels)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.array(nodes), lambda acc, _: F.concat(acc, F.array(over(F.element_at(acc, -1)))))


def path(levels: Column, i: Column) -> Column:
    """The siblings left and right of node i and of each of its parents in a block, from below."""

    def siblings(level: Column, k: Column) -> Column:
        at = F.floor(i / F.pow(F.lit(FAN), k)).cast("int")
        run = F.slice(level, (at - at % FAN) + 1, F.lit(FAN))
        cut = F.slice(run, F.lit(1), at % FAN), F.slice(run, at % FAN + 2, F.lit(FAN))
        return F.struct(F.array_join(cut[0], "").alias("l"), F.array_join(cut[1], "").alias("r"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), siblings)


def fold(start: Column, steps: Column) -> Column:
    """The root that a hash and the siblings on its way lead to."""
    return F.aggregate(steps, start, lambda acc, s: h(s["l"], acc, s["r"]))


def collapse(nodes: DataFrame, carry: list[str], name: str) -> list[DataFrame]:
    """Blocks of nodes (g, pos, n, hash, carry) round by round, written: (g, block, levels, rows), the last with one block a group.

    n is the group's number of nodes; `rows` are structs of `carry` in the order of the block's nodes.
    """
    width, out = FAN**LEVELS, []
    while True:
        own = nodes.select("g", F.expr(f"pos div {width}").alias("block"), "n", F.struct("pos", "hash", *[c for c in carry if c != "hash"]).alias("x"))
        gathered = own.groupBy("g", "block", "n").agg(F.array_sort(F.collect_list("x")).alias("x"))
        # levels that are left to the group's root: n nodes take ceil(log8 n); comparing whole powers keeps it exact
        left = F.lit(0)
        for k in range(LEVELS):
            left = left + (F.col("n") > FAN**k).cast("int")
        blocks = gathered.select("g", "block", "n", up(F.transform("x", lambda x: x["hash"]), left).alias("levels"), F.transform("x", lambda x: F.struct(*[x[c].alias(c) for c in carry]) if carry else F.lit(0)).alias("rows"))
        blocks = materialise(blocks, name)
        out.append(blocks)
        # the n of the widest group: one number
        most = blocks.agg(F.max("n")).first()[0]
        if most is None or most <= width:
            return out
        nodes, carry = blocks.select("g", F.col("block").alias("pos"), F.expr(f"(n + {width - 1}) div {width}").alias("n"), F.element_at(F.element_at("levels", -1), 1).alias("hash")), []


def paths_down(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """(g, block, above, root) for the blocks of the first round: the siblings from a block's root to the root of all.

    top is (g, above, root) for the groups' own roots.
    """
    known = top.select("g", F.lit(0).cast("long").alias("block"), "above", "root")
    for blocks in rounds[:0:-1]:
        b = blocks.join(known, ["g", "block"])
        at = F.posexplode(F.transform(F.sequence(F.lit(0), F.size("rows") - 1), lambda i: F.concat(path(F.col("levels"), i), F.col("above"))))
        known = b.select("g", (F.col("block") * FAN**LEVELS).alias("first"), "root", at.alias("i", "above")).select("g", (F.col("first") + F.col("i")).alias("block"), "above", "root")
    return known


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    rows = positions(leaves(docs), ["g"], [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("tampered")], "pos", "n")
    rounds = collapse(rows.withColumnRenamed("leaf", "hash"), ["doc_id", "hash", "tampered"], "merkle-blocks")
    subroots = rounds[-1].select("g", F.element_at(F.element_at("levels", -1), 1).alias("subroot"))
    named = positions(subroots.withColumnRenamed("g", "lang_key").withColumn("g", F.lit(0)), ["g"], [F.col("lang_key")], "pos", "n")
    tops = collapse(named.withColumnRenamed("subroot", "hash"), ["lang_key", "hash"], "merkle-tops")
    root = tops[-1].select("g", F.array().cast(f"array<{STEP}>").alias("above"), F.element_at(F.element_at("levels", -1), 1).alias("root"))
    above = tops[0].join(paths_down(tops, root), ["g", "block"])
    languages = above.select(F.inline(F.transform("rows", lambda r, i: F.struct(r["lang_key"].alias("g"), r["hash"].alias("subroot"), F.concat(path(F.col("levels"), i), F.col("above")).alias("above"), F.col("root").alias("root")))))
    languages = materialise(languages, "merkle-languages")
    down = paths_down(rounds, languages.drop("subroot"))
    blocks = rounds[0].join(down, ["g", "block"]).join(languages.select("g", "subroot"), "g")

    def proven(r: Column, i: Column) -> Column:
        # an array of one path, so that the path is built once for both uses
        both = F.transform(F.array(F.concat(path(F.col("levels"), i), F.col("above"))), lambda p: F.struct(F.sha2(F.array_join(F.transform(p, lambda s: F.concat(s["l"], s["r"])), ""), 256).alias("proof"), fold(F.coalesce(r["tampered"], r["hash"]), p).alias("folded")))
        return F.struct(r["doc_id"].alias("doc_id"), r["hash"].alias("leaf"), F.get(both, F.lit(0)).alias("p"))

    each = blocks.select("subroot", "root", F.inline(F.transform("rows", proven)))
    return each.select("doc_id", "leaf", "subroot", "root", F.col("p.proof").alias("proof_sha256"), F.col("p.folded").alias("folded_root"), (F.col("p.folded") == F.col("root")).alias("verified"))


def oracle(levels: int = 9) -> str:
    """The same in SQL, level by level: enough for FAN ** levels rows of a language and as many languages."""
    field = lambda v: f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')"
    low = f"translate(text, '{ASCII_UPPER}', '{ASCII_LOWER}')"
    of = lambda t: "sha256(" + " || ".join(field(t if c == "text" else c) for c in FIELDS) + ")"
    # CRC-32 bit by bit: each character's code, then seven zeros, one list item for each shift
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"
    ctes = [f"t0 AS (SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '-') AS g, {of('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {of(low)} ELSE {of('text')} END AS tampered FROM documents)"]
    ctes.append("a0 AS (SELECT id, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, tampered) - 1 AS pos FROM t0)")
    ctes.append("n0 AS (SELECT g, pos, leaf AS hash FROM t0 JOIN a0 USING (id, g))")

    def climb(prefix: str, steps: int) -> None:
        for k in range(steps):
            # a group of one node passes as it is, and has no siblings
            ctes.append(f"{prefix}r{k} AS (SELECT g, pos // {FAN} AS run, list(hash ORDER BY pos) AS run_hashes, any_value(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {prefix}{k}) GROUP BY ALL)")
            ctes.append(f"{prefix}{k + 1} AS (SELECT g, run AS pos, CASE WHEN n = 1 THEN run_hashes[1] ELSE sha256(array_to_string(run_hashes, '')) END AS hash FROM {prefix}r{k})")

    climb("n", levels)
    ctes.append(f"m0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS pos, hash FROM n{levels})")
    ctes.append(f"s AS (SELECT g AS lang_key, row_number() OVER (ORDER BY g) - 1 AS place, hash AS subroot FROM n{levels})")
    climb("m", levels)
    before = "a0"
    joins = f"SELECT t0.id, t0.doc_id, t0.leaf, t0.tampered, s.subroot, (SELECT hash FROM m{levels}) AS root, t0.tampered AS f0, '' AS p0, a0.pos, s.place, s.lang_key AS g FROM t0 JOIN {before} USING (id, g) JOIN s ON s.lang_key = t0.g"
    ctes.append(f"w0 AS ({joins})")
    k = 0
    for prefix, at, key in (("n", "pos", "w.g"), ("m", "place", "0")):
        for j in range(levels):
            i = f"(w.{at} // {FAN**j}) % {FAN}"
            left, right = f"array_to_string(list_slice(r.run_hashes, 1, {i}), '')", f"array_to_string(list_slice(r.run_hashes, {i} + 2, {FAN}), '')"
            ctes.append(f"w{k + 1} AS (SELECT w.* EXCLUDE (f{k}, p{k}), CASE WHEN r.n = 1 THEN w.f{k} ELSE sha256({left} || w.f{k} || {right}) END AS f{k + 1}, CASE WHEN r.n = 1 THEN w.p{k} ELSE w.p{k} || {left} || {right} END AS p{k + 1} FROM w{k} AS w JOIN {prefix}r{j} AS r ON r.g = {key} AND r.run = w.{at} // {FAN ** (j + 1)})")
            k += 1
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, root, sha256(p{k}) AS proof_sha256, f{k} AS folded_root, f{k} = root AS verified FROM w{k}"
