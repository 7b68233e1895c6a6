"""SentencePiece encoding and decoding with a batched Viterbi.

A text is read as SentencePiece reads it: blanks become U+2581 and one is put before the text. No piece holds that
mark after another character, so the units between the marks are segmented on their own, each distinct unit once in
a task. Units of equal length advance together: their prefix hashes give the hash of every substring, a binary search
in the sorted hashes of the pieces of that length gives its id and score, and vectorised maxima over the lengths
store the best score and the back pointer. Long units take the same steps alone. A character that no piece covers
costs as much as the worst piece and 10 more, and becomes its UTF-8 byte pieces.

The result is the segmentation with the largest sum of piece scores. It is what a unigram model would give; a
vocabulary that was trained as BPE (its scores are merge ranks) may be cut differently by its own merge order.
Decoding joins pieces and bytes, and gives the text back exactly.

Cases. Null text: no ids (an empty list). Empty text: no ids. Repeated rows: one result each. Other columns are not
read. Of equal sums, the segmentation whose last piece is shortest wins, at each position.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import bound_batches, doc_chunks, mix64

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LONG = 64
SCHEMA = "doc_id long, n_tokens long, ids array<int>"


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def prefix_hashes(points: np.ndarray) -> np.ndarray:
    """Along the last axis, H[j] of the first j characters: H[j + 1] = H[j] * BASE + mix(character)."""
    h = np.zeros((*points.shape[:-1], points.shape[-1] + 1), np.uint64)
    values = mix64(points.astype(np.uint64) + np.uint64(1))
    for j in range(points.shape[-1]):
        h[..., j + 1] = h[..., j] * BASE + values[..., j]
    return h


BASE = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces by length: sorted substring hashes with ids and scores; byte pieces; how to decode."""

    #: By the first bits of a hash, whether a piece has them; most substrings end there.
    SEEN_BITS = 18
    #: Ends of pieces that are looked for together in a long unit.
    STRETCH = 1 << 15

    def __init__(self, path: str = VOCABULARY) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.GetPieceSize()
        names = [model.IdToPiece(i) for i in range(n)]
        special = [model.IsByte(i) or model.IsControl(i) or model.IsUnknown(i) or model.IsUnused(i) for i in range(n)]
        self.load([(names[i], i, model.GetScore(i)) for i in range(n) if not special[i]], {int(names[i][3:5], 16): i for i in range(n) if model.IsByte(i)}, model.unk_id())

    def load(self, pieces: list[tuple[str, int, float]], byte_ids: dict[int, int], unknown: int) -> None:
        self.byte_ids, self.unknown = byte_ids, unknown
        by_length: dict[int, list[tuple[int, int, float]]] = {}
        for name, i, s in pieces:
            by_length.setdefault(len(name), []).append((int(prefix_hashes(code_points(name))[-1]), i, s))
        self.tables, self.seen = {}, {}
        for length, rows in sorted(by_length.items()):
            rows.sort()
            self.seen[length] = np.zeros(1 << self.SEEN_BITS, bool)
            self.seen[length][[r[0] >> (64 - self.SEEN_BITS) for r in rows]] = True
            self.tables[length] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int32), np.array([r[2] for r in rows]))
        self.fallback = min((s for *_, s in pieces), default=0.0) - 10
        self.bytes_of = {i: name.replace(MARK, " ").encode() for name, i, _ in pieces} | {i: bytes([b]) for b, i in byte_ids.items()}
        # all spellings as one byte array, by id
        spelt = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of, default=-1) + 1)] or [b""]
        self.spellings = np.frombuffer(b"".join(spelt), np.uint8)
        self.widths = np.array([len(x) for x in spelt], np.int64)
        self.begins = np.cumsum(self.widths) - self.widths
        inside = "".join(name for name, *_ in pieces if len(name) > 1)
        if any(MARK in name.lstrip(MARK) for name, *_ in pieces):
            self.units = re.compile(r"(?s).+")
        elif "\n" not in inside:
            self.units = re.compile(r"\n| *[^ \n]+| +")
        else:
            self.units = re.compile(r"(?s) *[^ ]+| +")
        self.powers = np.ones(max(self.tables, default=1) + 1, np.uint64)
        self.powers[1:] = BASE
        self.powers = np.multiply.accumulate(self.powers)

    def fallback_ids(self, c: str) -> list[int]:
        return [self.byte_ids.get(b, self.unknown) for b in c.encode("utf-8", "surrogatepass")]

    def probe(self, h: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where substring hashes are pieces of this length, their ids, their scores)."""
        keys, ids, scores = self.tables[length]
        may = np.flatnonzero(self.seen[length][h >> np.uint64(64 - self.SEEN_BITS)])
        at = np.minimum(np.searchsorted(keys, h[may]), len(keys) - 1)
        hit = keys[at] == h[may]
        return may[hit], ids[at[hit]], scores[at[hit]]

    def segment(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, number of ids of each unit); units in order of length, marks written as U+2581."""
        flat, counts, k = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
        while k < len(units):
            length, end = len(units[k]), k + 1
            if length > LONG:
                ids = self.alone(units[k])
                flat.append(np.array(ids, np.int32))
                counts.append(np.array([len(ids)], np.int64))
            else:
                while end < len(units) and len(units[end]) == length:
                    end += 1
                for part in range(k, end, 1 << 15):
                    f, c = self.together(units[part : min(end, part + (1 << 15))])
                    flat.append(f)
                    counts.append(c)
            k = end
        return np.concatenate(flat), np.concatenate(counts)

    def together(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """segment() for units of one length: one step for each end and piece length, over all units at once."""
        n, length = len(units), len(units[0])
        points = code_points("".join(units)).reshape(n, length)
        h = np.ascontiguousarray(prefix_hashes(points).T)
        best = np.zeros((length + 1, n))
        back = np.ones((length + 1, n), np.int8)
        piece = np.full((length + 1, n), -1, np.int32)
        for end in range(1, length + 1):
            best[end] = best[end - 1] + self.fallback
            for size in self.tables:
                if size > end:
                    break
                at, ids, scores = self.probe(h[end] - h[end - size] * self.powers[size], size)
                if not len(at):
                    continue
                sums = best[end - size][at] + scores
                if size > 1:
                    better = sums > best[end][at]
                    at, ids, sums = at[better], ids[better], sums[better]
                best[end][at] = sums
                back[end][at] = size
                piece[end][at] = ids
        paths = np.full((n, length), -2, np.int32)
        row, at = np.arange(n), np.full(n, length)
        for k in range(length - 1, -1, -1):
            paths[row, k] = piece[at, row]
            at = at - back[at, row]
            row, at = row[at > 0], at[at > 0]
            if not len(row):
                break
        counts = (paths != -2).sum(axis=1)
        odd = np.flatnonzero((paths == -1).any(axis=1))
        if not len(odd):
            return paths[paths != -2], counts
        parts, last = [], 0
        for r in odd.tolist():
            parts.append(paths[last:r][paths[last:r] != -2])
            tail = paths[r, length - counts[r] :].tolist()
            ids = self.spelt(units[r], tail, self.sizes(tail))
            parts.append(np.array(ids, np.int32))
            counts[r] = len(ids)
            last = r + 1
        parts.append(paths[last:][paths[last:] != -2])
        return np.concatenate(parts), counts

    def sizes(self, ids: list[int]) -> list[int]:
        return [len(self.bytes_of[i].decode()) if i >= 0 else 1 for i in ids]

    def spelt(self, unit: str, ids: list[int], sizes: list[int]) -> list[int]:
        """ids with the places of uncovered characters (-1) written as byte pieces."""
        out, at = [], 0
        for i, size in zip(ids, sizes, strict=True):
            out += [i] if i >= 0 else self.fallback_ids(unit[at].replace(MARK, " "))
            at += size
        return out

    def alone(self, unit: str) -> list[int]:
        """One long unit: substrings probed a stretch at a time, then a walk over those that are pieces; memory is the walk's own."""
        length = len(unit)
        h = self.running(unit)
        best, sizes_back, ids_back = [0.0] * (length + 1), np.ones(length + 1, np.int32), np.full(length + 1, -1, np.int32)
        for low in range(1, length + 1, self.STRETCH):
            high = min(low + self.STRETCH, length + 1)
            found: dict[int, list[tuple[int, int, float]]] = {}
            for size in self.tables:
                a, b = max(low - size, 0), high - size
                if b > a:
                    for k, i, score in zip(*map(np.ndarray.tolist, self.probe(h[a + size : b + size] - h[a:b] * self.powers[size], size)), strict=True):
                        found.setdefault(a + k + size, []).append((size, i, score))
            for end in range(low, high):
                top, how = best[end - 1] + self.fallback, None
                for size, i, s in found.get(end, ()):
                    if size == 1 or best[end - size] + s > top:
                        top, how = best[end - size] + s, (size, i)
                best[end] = top
                if how:
                    sizes_back[end], ids_back[end] = how
        ids, sizes, at = [], [], length
        back, named = sizes_back.tolist(), ids_back.tolist()
        while at:
            ids.append(named[at])
            sizes.append(back[at])
            at -= back[at]
        return self.spelt(unit, ids[::-1], sizes[::-1])

    @staticmethod
    def running(unit: str) -> np.ndarray:
        h, out, mask, base = 0, [0], (1 << 64) - 1, int(BASE)
        for v in mix64(code_points(unit).astype(np.uint64) + np.uint64(1)).tolist():
            h = (h * base + v) & mask
            out.append(h)
        return np.array(out, np.uint64)

    def encode(self, text: str) -> list[int]:
        units = self.units.findall(" " + text) if text else []
        known = sorted(set(units), key=len)
        flat, counts = self.segment([u.replace(" ", MARK) for u in known])
        ends = np.cumsum(counts)
        ids = {u: flat[e - c : e].tolist() for u, e, c in zip(known, ends, counts, strict=True)}
        return [i for u in units for i in ids[u]]

    def decode(self, ids) -> str:
        """The text of ids; ids without a piece give nothing."""
        return self.decode_all(np.array(ids, np.int64), np.array([len(ids)]))[0]

    def decode_all(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of lists of ids, one after the other in flat: the bytes of all pieces are gathered at once."""
        known = (flat >= 0) & (flat < len(self.widths))
        i = np.where(known, flat, 0)
        width = np.where(known, self.widths[i], 0)
        ends = np.concatenate(([0], np.cumsum(width)))
        raw = self.spellings[np.repeat(self.begins[i] - ends[:-1], width) + np.arange(ends[-1])].tobytes()
        cuts = ends[np.concatenate(([0], np.cumsum(counts)))].tolist()
        return [raw[a:b].decode("utf-8", "replace")[1:] for a, b in itertools.pairwise(cuts)]


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, remember: int = 400_000) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(vocabulary)
        number: dict[str, int] = {}
        flat, sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        for batch in doc_chunks(batches, "text"):
            if len(number) > remember:
                number, flat, sizes = {}, np.zeros(0, np.int32), np.zeros(0, np.int64)
            texts = batch.column("text").to_pylist()
            split = [v.units.findall(" " + t) if t else [] for t in texts]
            if new := sorted({u for us in split for u in us} - number.keys(), key=len):
                ids, counts = v.segment([u.replace(" ", MARK) for u in new])
                number |= zip(new, range(len(number), len(number) + len(new)), strict=True)
                sizes, flat = np.concatenate((sizes, counts)), np.concatenate((flat, ids))
            begins = np.cumsum(sizes) - sizes
            counts, parts = [], []
            for units in split:
                k = np.array(list(map(number.__getitem__, units)), np.int64)
                take = sizes[k]
                total = int(take.sum())
                parts.append(flat[np.repeat(begins[k] - (np.cumsum(take) - take), take) + np.arange(total)])
                counts.append(total)
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), ids], ["doc_id", "n_tokens", "ids"])

    bound_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give the empty text. With keep_ids, the columns of encode() and text."""
    kept = ["doc_id", "n_tokens", "ids"] if keep_ids else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(vocabulary)
        for batch in batches:
            counts = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(counts)
            start = 0
            while start < batch.num_rows:
                # as many rows as have a million ids, one at least
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + (1 << 20), "right")))
                part = batch.slice(start, stop - start)
                flat = pc.fill_null(part.column("ids").flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *(part.column(c) for c in kept[1:]), pa.array(v.decode_all(flat, counts[start:stop]), pa.string())], [*kept, "text"])
                start = stop

    return encoded.select(*(kept if keep_ids else ["doc_id", "ids"])).mapInArrow(run, f"{SCHEMA if keep_ids else 'doc_id long'}, text string")
