"""Exact substring dedup over suffix arrays.

Every byte that lies in a 200-byte string which starts anywhere else too is removed; strings are judged on the input.

Where to look. Each 200-byte window has an anchor: the k-gram of least hash in it (the leftmost of equals). Equal
windows have equal anchors at equal places, so windows need comparing only where an anchor occurs twice; the windows
of one anchor are neighbours, and (anchor, context), the context being all their bytes, stands for them. Anchors meet
as packed arrays by hash range, counted for each slice first, so that a passage that a third of all texts hold is a
few counts. A context met twice is repeated as a whole.

Suffix arrays. What is left are different contexts of one anchor, which share some windows and not others. They are
dealt to shards by anchor; an anchor with more than `SALT_AT` contexts is dealt over several. Each shard sorts the
suffixes of its contexts (Larsson-Sadakane refinement: ranks of the first 8 bytes, then doubling within the groups
that are still unsorted) and takes common prefixes by Kasai's rule, with all contexts in step. Runs of the suffix
array with a common prefix of 200 bytes and two windows are repeated. For anchors of several shards, each shard gives
its sorted distinct windows as 128-bit keys; key ranges are merged by binary search of one shard's list in the
others', and hits go back to the windows.

Cases. Null text: empty (0 bytes, the hash of no bytes). Texts under 200 bytes keep all. Equal texts and repeated
rows count as other places. Null ids are kept apart by text. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, doc_chunks, hash_tables, joined, materialise, mix64, powers, texts_of

LENGTH = 200
GRAM = 48
#: Contexts of one anchor in a shard, some 350 bytes each; and the bytes of contexts that a shard is planned for.
SALT_AT = 2500
SHARD_BYTES = 1 << 20
_POSITION = np.uint64((1 << 31) - 1)


def window_runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, first and last window start in the text, anchor's offset from the first start, anchor hash, context hash) of each run of windows with one anchor."""
    data, begins, ends = joined(texts)
    n, width = len(data) - gram + 1, length - gram + 1
    none = np.zeros(0, np.int64)
    if len(data) < length or not (ends - begins >= length).any():
        return none, none, none, none, none, none
    table, base, inverse = hash_tables(43)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(base, len(data)), out=total[1:])
    back = powers(inverse, len(data) + 1)
    h = mix64((total[gram:] - total[:n]) * back[:n])
    key = (h & ~_POSITION) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = key
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    m = n - width + 1
    at = (np.minimum(ahead[:m], behind[width - 1 : width - 1 + m]) & _POSITION).astype(np.int64)
    # windows that lie in one text
    valid = np.zeros(m + 1, np.int8)
    long = ends - begins >= length
    valid[begins[long]] = 1
    np.subtract.at(valid, ends[long] - length + 1, 1)
    valid = np.cumsum(valid[:m]) > 0
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
    s = np.flatnonzero(first)
    # the last window of a run: before the next first or the next window that is not valid
    stop = np.flatnonzero(~valid)
    nxt = np.append(s[1:], m)
    gap = np.append(stop, m)[np.searchsorted(stop, s)]
    e = np.minimum(nxt, gap) - 1
    doc = np.searchsorted(begins, s, "right") - 1
    context = mix64((total[e + length] - total[s]) * back[s])
    context = mix64(context ^ mix64((e - s).astype(np.uint64) << np.uint64(32) | (at[s] - s).astype(np.uint64)))
    return doc, s - begins[doc], e - begins[doc], at[s] - s, h[at[s]].astype(np.int64), context.astype(np.int64)


def runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_chunks(batches, "text", 1 << 20):
            doc, s, e, _, anchor, context = window_runs(texts_of(batch, "text"), length, gram)
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()).take(take), batch.column("h").take(take), pa.array(s.astype(np.int32)), pa.array((e - s).astype(np.int32)), pa.array(anchor), pa.array(context)], ["doc_id", "h", "s", "more", "anchor", "context"]
            )

    return docs.mapInArrow(run, "doc_id long, h long, s int, more int, anchor long, context long")


def shared_contexts(docs: DataFrame, parts: int, length: int, gram: int) -> DataFrame:
    """(anchor, context, n, contexts): the contexts of anchors that occur at least twice; how often this one does, and how many the anchor has."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_chunks(batches, "text", 1 << 20):
            *_, anchor, context = window_runs(texts_of(batch, "text"), length, gram)
            if not len(anchor):
                continue
            order = np.lexsort((context, anchor))
            anchor, context = anchor[order], context[order]
            edge = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1]), [True])))
            counts, anchor, context = np.diff(edge).astype(np.int32), anchor[edge[:-1]], context[edge[:-1]]
            part = (mix64(anchor.astype(np.uint64) ^ np.uint64(5)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            rows = [(p, *(x[order[a:b]].tobytes() for x in (anchor, context, counts))) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 0 else pa.binary()) for k, c in enumerate(zip(*rows, strict=True))], ["part", "anchors", "contexts", "counts"])

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        anchor, context, counts = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("anchors", np.int64), ("contexts", np.int64), ("counts", np.int32)))
        order = np.lexsort((context, anchor))
        anchor, context, counts = anchor[order], context[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1]))))
        n, anchor, context = np.add.reduceat(counts, first, dtype=np.int64), anchor[first], context[first]
        group = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        size = np.diff(np.append(group, len(anchor)))
        kinds = np.repeat(size, size)
        keep = (kinds > 1) | (n > 1)
        return pa.table({"anchor": anchor[keep], "context": context[keep], "n": n[keep], "contexts": kinds[keep]})

    return docs.mapInArrow(pack, "part int, anchors binary, contexts binary, counts binary").groupBy("part").applyInArrow(meet, "anchor long, context long, n long, contexts long")


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order: Larsson-Sadakane refinement. Sorted to the end, as Kasai's rule needs."""
    n = len(text)
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = text.astype(np.uint64) + 1  # the end sorts first
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = key * np.uint64(257) + wide[k : k + n]
    order = np.argsort(key, kind="stable")
    ranks = np.empty(n, np.int64)
    new = np.concatenate(([True], key[order[1:]] != key[order[:-1]])) if n else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    ranks[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    step = 7
    while step < n:
        # suffixes of groups that are not yet sorted out, in their places
        sizes = np.diff(np.append(heads, n))
        open_groups = np.flatnonzero(sizes > 1)
        if not len(open_groups):
            break
        begin, size = heads[open_groups], sizes[open_groups]
        places = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        suffixes = order[places]
        after = suffixes + step
        second = np.where(after < n, ranks[np.minimum(after, n - 1)] + 1, 0)
        sub = np.argsort(ranks[suffixes] * (n + 1) + second, kind="stable")
        suffixes, second = suffixes[sub], second[sub]
        group = ranks[suffixes]
        order[places] = suffixes
        split = np.concatenate(([True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])))
        at = np.flatnonzero(split)
        ranks[suffixes] = np.repeat(places[at], np.diff(np.append(at, len(suffixes))))
        keep = np.ones(len(heads), bool)
        keep[open_groups] = False
        heads = np.sort(np.concatenate((heads[keep], places[at])))
        step *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, begins: np.ndarray, most: int) -> np.ndarray:
    """For each place of the suffix array, the bytes (up to `most`) shared with the suffix before it. Kasai's rule, all contexts in step: a context's
    suffix shares at least one byte less than the one before it in the text did."""
    n = len(text)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    words = np.zeros(n + 1, np.uint64)
    for k in range(8):
        words[:n] = (words[:n] << np.uint64(8)) | padded[k : k + n]
    shared = np.zeros(n, np.int64)
    ends = np.append(begins[1:], n)
    have = np.zeros(len(begins), np.int64)
    for j in range(int((ends - begins).max(initial=0))):
        lanes = np.flatnonzero(begins + j < ends)
        i = begins[lanes] + j
        p = place[i]
        length = np.maximum(have[lanes] - 1, 0)
        live = np.flatnonzero(p > 0)
        length[p == 0] = 0
        other = order[np.maximum(p - 1, 0)]
        while len(live):
            a, b = i[live] + length[live], other[live] + length[live]
            inside = (a < n) & (b < n)
            x = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
            # whole words first; at the first difference, its leading equal bytes
            same = np.where(x == 0, 8, 0)
            for k in range(1, 8):
                same = np.where((x != 0) & (x >> np.uint64(64 - 8 * k) == 0), k, same)
            room = n - np.maximum(a, b)
            got = np.where(inside, np.minimum(same, np.maximum(room, 0)), 0)
            length[live] = np.minimum(length[live] + got, most)
            live = live[(got == 8) & (length[live] < most)]
        have[lanes] = length
        shared[p] = length
    return shared


def laid_out(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All contexts in one byte array, their sizes and where each begins."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    return np.frombuffer(b"".join(contexts), np.uint8), sizes, np.cumsum(sizes) - sizes


def window_keys(contexts: list[bytes], number: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """128-bit keys of windows, as two columns, from two independent sums."""
    text, _, begins = laid_out(contexts)
    at, halves = begins[number] + start, []
    for seed in (71, 73):
        table, base, inverse = hash_tables(seed)
        total = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(table[text] * powers(base, len(text)), out=total[1:])
        halves.append(mix64((total[at + length] - total[at]) * powers(inverse, len(text) + 1)[at]))
    return np.stack(halves, axis=1)


def repeated_windows(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(context number, window start, class, whether another window of these contexts equals it) of all windows of a shard."""
    text, sizes, begins = laid_out(contexts)
    order = suffix_array(text)
    shared = common_prefixes(text, order, begins, length)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(len(text)) - begins[owner]
    window = start <= (sizes - length)[owner]
    group = np.cumsum(shared < length)
    w = window[order]
    pos, cls = order[w], group[w]
    counts = np.bincount(cls, minlength=int(group[-1]) + 1 if len(group) else 1)
    return owner[pos], start[pos], cls, counts[cls] > 1


def spans_of(number: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Ranges of consecutive window starts for each context number."""
    if not len(number):
        return
    order = np.lexsort((start, number))
    number, start = number[order], start[order]
    first = np.flatnonzero(np.concatenate(([True], (number[1:] != number[:-1]) | (start[1:] != start[:-1] + 1))))
    last = np.append(first[1:], len(number)) - 1
    out: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        out.setdefault(int(number[a]), []).append((int(start[a]), int(start[b])))
    yield from out.items()


PART = "anchor long, context long, lo int, hi int"


def partly_repeated(contexts: DataFrame, length: int, salt_at: int) -> DataFrame:
    """(anchor, context, lo, hi): ranges of repeated windows, of (anchor, context, contexts, bytes) with several contexts an anchor."""
    size = contexts.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    shards = max(8, int(size) // SHARD_BYTES + 1)
    salts = F.ceil(F.col("contexts") / F.lit(salt_at))
    dealt = contexts.withColumn("salts", salts).withColumn("shard", F.pmod(F.xxhash64("anchor", F.pmod("context", "salts")), F.lit(shards)).cast("int"))

    def within(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        texts = table.column("bytes").to_pylist()
        salts, anchors, names = (table.column(c).to_numpy() for c in ("salts", "anchor", "context"))
        number, start, cls, again = repeated_windows(texts, length)
        rows = [(anchors[k], names[k], lo, hi, None, None, None, None, None) for k, spans in spans_of(number[again], start[again]) for lo, hi in spans]
        # different windows of anchors that other shards hold too, packed by range of their keys; what is repeated here is known, so it is met by others and not asked for
        cross = np.flatnonzero(salts[number] > 1)
        cross = cross[np.concatenate(([True], cls[cross][1:] != cls[cross][:-1]))] if len(cross) else cross
        keys = window_keys(texts, number[cross], start[cross], length)
        ranges = (keys[:, 0] % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((keys[:, 1], keys[:, 0], ranges))
        cuts = np.searchsorted(ranges[order], np.arange(shards + 1)).tolist()
        packed = [keys[order].astype(">u8"), anchors[number[cross][order]], names[number[cross][order]], np.where(again[cross], -1, start[cross])[order].astype(np.int32)]
        rows += [(None, None, None, None, r, *(x[a:b].tobytes() for x in packed)) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 9, kinds, strict=True)]
        return pa.table(columns, ["anchor", "context", "lo", "hi", "range", "keys", "anchors", "contexts", "starts"])

    found = materialise(dealt.groupBy("shard").applyInArrow(within, f"{PART}, range long, keys binary, anchors binary, contexts binary, starts binary"), "sub-found")

    def across(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Sorted keys of each shard in this range, searched in those of the others."""
        parts = [np.frombuffer(x, ">u8").reshape(-1, 2) for x in table.column("keys").to_pylist()]
        lists = [np.ascontiguousarray(x).view([("a", ">u8"), ("b", ">u8")]).ravel() for x in parts]
        # the lists merged, with the least and greatest shard of each key: a window is met elsewhere if either isn't its own
        every = np.concatenate(lists)
        shard = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        order = np.argsort(every, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], every[order][1:] != every[order][:-1])))
        low, high, union = np.minimum.reduceat(shard[order], first), np.maximum.reduceat(shard[order], first), every[order][first]
        places = [np.searchsorted(union, mine) for mine in lists]
        hit = np.concatenate([(low[at] != k) | (high[at] != k) for k, at in enumerate(places)])
        anchor, context, start = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("anchors", np.int64), ("contexts", np.int64), ("starts", np.int32)))
        hit &= start >= 0
        return pa.table({"anchor": anchor[hit], "context": context[hit], "lo": start[hit], "hi": start[hit]})

    keyed = found.where("keys is not null").select("range", "keys", "anchors", "contexts", "starts")
    merged = keyed.groupBy("range").applyInArrow(across, PART)
    return islands(found.where("keys is null").select("anchor", "context", "lo", "hi").unionByName(merged))


def islands(windows: DataFrame) -> DataFrame:
    """(anchor, context, lo, hi): ranges that touch or overlap, as one. A context has no more windows than an anchor reaches, so its list is short."""
    joined_up = """aggregate(array_sort(collect_set(struct(lo, hi))), cast(array() as array<struct<lo: int, hi: int>>), (done, x) ->
        case when size(done) = 0 or x.lo > element_at(done, -1).hi + 1 then array_append(done, x)
        else array_append(slice(done, 1, size(done) - 1), named_struct('lo', element_at(done, -1).lo, 'hi', greatest(element_at(done, -1).hi, x.hi))) end)"""
    return windows.groupBy("anchor", "context").agg(F.expr(joined_up).alias("spans")).selectExpr("anchor", "context", "inline(spans)")


def removed_runs(cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the maximal removed runs begin and end, of spans packed as start * 2**32 + end."""
    cuts = np.sort(cuts)
    start, reach = cuts >> 32, np.maximum.accumulate(cuts & 0xFFFFFFFF)
    apart = start[1:] > reach[:-1]
    return start[np.concatenate(([True], apart))[: len(cuts)]], reach[np.concatenate((apart, [True]))[: len(cuts)]]


def contexts_of(docs: DataFrame, at: DataFrame, length: int) -> DataFrame:
    """(anchor, context, contexts, bytes) of (anchor, context, contexts, doc_id, h, s, more), one place each."""
    per = at.groupBy("doc_id", "h").agg(F.collect_list(F.struct("anchor", "context", "contexts", "s", "more")).alias("wanted"))  # no more than a text has runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_chunks(batches, "text", 1 << 20):
            rows = [(w["anchor"], w["context"], w["contexts"], text[w["s"] : w["s"] + w["more"] + length]) for text, wanted in zip(texts_of(batch, "text"), batch.column("wanted").to_pylist(), strict=True) for w in wanted]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["anchor", "context", "contexts", "bytes"])

    hit = docs.alias("d").hint("merge").join(per.alias("p"), F.expr("d.h = p.h and d.doc_id <=> p.doc_id")).select("d.text", "p.wanted")
    return hit.mapInArrow(run, "anchor long, context long, contexts long, bytes binary").dropDuplicates(["anchor", "context"])


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, salt_at: int = SALT_AT, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; with keep_text, also kept_text (binary)."""
    bound_batches(docs.sparkSession)
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(16, int(size) // (40 << 20))
    shared = materialise(shared_contexts(named, parts, length, gram), "sub-shared")
    hits = materialise(runs(named, length, gram).hint("merge").join(shared, ["anchor", "context"]), "sub-hits")
    some = hits.where("contexts > 1").groupBy("anchor", "context", "contexts").agg(F.min(F.struct("doc_id", "h", "s", "more")).alias("at"))
    texts = materialise(contexts_of(named, some.select("anchor", "context", "contexts", "at.*"), length), "sub-contexts")
    partly = partly_repeated(texts, length, salt_at)
    whole = hits.where("n > 1").select("doc_id", "h", "s", (F.col("s") + F.col("more") + length).alias("e"))
    part = hits.where("n = 1").join(partly, ["anchor", "context"]).select("doc_id", "h", (F.col("s") + F.col("lo")).alias("s"), (F.col("s") + F.col("hi") + length).alias("e"))
    packed = (F.shiftleft(F.col("s").cast("long"), 32) + F.col("e")).alias("cut")
    cuts = whole.unionByName(part).select("doc_id", "h", packed).distinct().groupBy("doc_id", "h").agg(F.collect_list("cut").alias("cuts"))  # no more than a text has windows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_chunks(batches, "text", 1 << 20):
            rows = []
            for doc_id, text, cuts in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text"), batch.column("cuts"), strict=True):
                begin, end = removed_runs(cuts.values.to_numpy() if cuts.is_valid else np.zeros(0, np.int64))
                left = b"".join(text[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(text)], strict=True))
                rows.append((doc_id, len(text), len(text) - len(left), len(begin), hashlib.sha256(left).hexdigest(), left if keep_text else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.string(), pa.binary()], strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    wide = named.alias("d").hint("merge").join(cuts.alias("c"), F.expr("d.h <=> c.h and d.doc_id <=> c.doc_id"), "left").select("d.doc_id", "d.text", "c.cuts")
    out = wide.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary")
    return out if keep_text else out.drop("kept_text")
