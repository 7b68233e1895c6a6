"""Quality rules from tokeniser fertility.

A public vocabulary with byte fallback cuts every word of a text; a text's characters per token, its share of
byte-fallback tokens and the entropy of its tokens (in bits) are held against bands for its script. Prose of a language that the vocabulary knows gives long tokens, few fallbacks and many
different tokens; symbol soup, random keys and pages that repeat one phrase fall out of a band. The bands are fixed
parameters, wide enough for invented or inflected words, and short texts are judged by the base rules alone, as
their entropy says little.

Words meet the vocabulary once for each task: pieces never cross the start of a word, so a text's tokens are those of
its words.

Cases. Null text: no words (base_failed, not kept). Repeated rows: one result each. doc_id may be null. Other columns
are not read.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bound_batches, doc_chunks

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of words


@dataclass(frozen=True)
class Band:
    """Limits that a text must stay within."""

    min_chars: float = 1.5
    max_chars: float = 12.0
    max_fallback: float = 0.05
    min_entropy: float = 4.5


#: By script of most letters; a script that the vocabulary spells in bytes has a band of its own.
BANDS = {
    "LATIN": Band(),
    "CYRILLIC": Band(max_fallback=0.10),
    "GREEK": Band(min_chars=0.8, max_fallback=0.30),
    "CJK": Band(min_chars=0.25, max_fallback=0.90, min_entropy=4.0),
    "HIRAGANA": Band(min_chars=0.25, max_fallback=0.90, min_entropy=4.0),
    "HANGUL": Band(min_chars=0.25, max_fallback=0.90, min_entropy=4.0),
}
OTHER = Band(min_chars=0.2, max_fallback=1.0, min_entropy=3.5)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "script string, chars_per_token double, fallback_share double, entropy double"
)


def repeated_words(ids: np.ndarray) -> int:
    """Words in 3-word windows that are found at least twice."""
    n = len(ids) - 2
    if n < 2:
        return 0
    base = int(ids.max()) + 1
    code = ids[:-2] * base + ids[1:-1]
    if base > 1 << 20:
        code = np.unique(code, return_inverse=True)[1]
    code = code * base + ids[2:]
    order = np.argsort(code)
    code = code[order]
    same = np.flatnonzero(code[1:] == code[:-1])
    if not len(same):
        return 0
    covered = np.zeros(len(ids), bool)
    for at in (order[same], order[same + 1]):
        for k in range(3):
            covered[at + k] = True
    return int(np.count_nonzero(covered))


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def first_script(word: str) -> str:
    c = word[0]
    return "LATIN" if c < "\u0250" else unicodedata.name(c, "NONE").split(" ")[0]


class Words:
    """What a vocabulary makes of words: numbered as they are met, with their tokens one after the other."""

    def __init__(self, vocabulary: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        self.fallback = np.array([self.model.IsByte(i) or self.model.IsUnknown(i) for i in range(self.model.GetPieceSize())])
        self.number: dict[bytes, int] = {}
        self.scripts = ["LATIN"]
        self.parts: list[list[np.ndarray]] = [[], [], [], [], []]

    def learn(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        ids = self.model.encode(texts, num_threads=1)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(lengths.sum()))
        ends = np.concatenate(([0], np.cumsum(lengths)))
        bad = np.concatenate(([0], np.cumsum(self.fallback[flat])))
        script = np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            if t[0] >= "\u0250":
                name = first_script(t)
                if name not in self.scripts:
                    self.scripts.append(name)
                script[k] = self.scripts.index(name)
        self.number |= zip(words, range(len(self.number), len(self.number) + len(words)), strict=True)
        for kept, new in zip(self.parts, (np.fromiter(map(len, texts), np.int64, len(texts)), lengths, bad[ends[1:]] - bad[ends[:-1]], script, flat), strict=True):
            kept.append(new)

    def tables(self) -> list[np.ndarray]:
        self.parts = [[np.concatenate(x) if x else np.zeros(0, np.int64)] for x in self.parts]
        return [x[0] for x in self.parts]


def measure(docs: DataFrame, vocabulary: str = VOCABULARY, bands: dict[str, Band] = BANDS, other: Band = OTHER, remember: int = 400_000) -> DataFrame:
    """One row for each document: base counts, base_failed, kept and the fertility figures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = Words(vocabulary)
        for batch in doc_chunks(batches, "text"):
            if len(words_of.number) > remember:
                words_of = Words(vocabulary)
            texts = [t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            split = [t.split() for t in texts]
            number = words_of.number
            if new := list({w for ws in split for w in ws} - number.keys()):
                words_of.learn(new)
            chars_of, tokens_of, bad_of, script_of, flat = words_of.tables()
            begins = np.cumsum(tokens_of) - tokens_of
            out = []
            for doc_id, text, words in zip(batch.column("doc_id").to_pylist(), texts, split, strict=True):
                n = len(words)
                if not n:
                    out.append((doc_id, 0, 0, sum(text.count(x) for x in SYMBOLS), 0, 0, True, False, "NONE", 0.0, 0.0, 0.0))
                    continue
                ids = np.array(list(map(number.__getitem__, words)), np.int64)
                kinds, at = np.unique(ids, return_inverse=True)
                counts = np.bincount(at)
                chars, bad, sizes = int(chars_of[kinds] @ counts), int(bad_of[kinds] @ counts), tokens_of[kinds]
                tokens = int(sizes @ counts)
                script = words_of.scripts[int(np.argmax(np.bincount(script_of[kinds], counts)))]
                entropy = 0.0
                if tokens > 1:
                    before = np.cumsum(sizes) - sizes
                    pieces = flat[np.repeat(begins[kinds] - before, sizes) + np.arange(int(sizes.sum()))]
                    p = np.bincount(pieces, np.repeat(counts, sizes))
                    p = p[p > 0] / tokens
                    entropy = max(0.0, float(-(p @ np.log2(p))))
                per, share = (chars / tokens, bad / tokens) if tokens else (0.0, 0.0)
                repeats = repeated_words(at)
                failed = n < MIN_WORDS or 100 * repeats > MAX_REPEATED * n
                b = bands.get(script, other)
                kept = not failed and b.min_chars <= per <= b.max_chars and share <= b.max_fallback and entropy >= b.min_entropy
                out.append((doc_id, n, chars, sum(text.count(x) for x in SYMBOLS), duplicate_lines(text), repeats, failed, kept, script, per, share, entropy))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string()] + [pa.float64()] * 3, strict=True)],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    bound_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
