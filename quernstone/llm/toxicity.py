"""Toxicity from subword bags.

A text is read in windows of `WINDOW` words. The n-grams of a window's words (3 to 5 bytes of UTF-8, with the blank
before and after a word, A-Z lower-cased) hash to buckets; their embeddings are averaged and a linear softmax over
clean and toxic reads the average. A text is toxic if any window is (noisy or), and embeddings and softmax are
trained jointly on that, in numpy, so a misspelt word lands near the words whose n-grams it shares. For scoring the
trained product of embeddings and softmax folds to one number a bucket, and texts stream through numpy in slices.

A window adds its hazard (the softplus of its logit, `MOST` at most) to its text's sum, and the score is
1 - exp(-sum). So that length alone makes no text toxic, what clean text of that many windows would sum up to goes off
first: the mean and `DEVIATIONS` standard deviations of the sum, from clean documents that training didn't see.

Training reads at most `PER_CLASS` labelled documents of either class, the first by a hash of the id, and at most
`MAX_BYTES` of text, half for either class: documented bounds that fit one executor task, in which the model is trained.
A text over what is left of its class's half is passed over; the sample goes on. Scoring reads every text, whole.

Cases. Null, empty or blank text: score 0. Null id: counts as the empty string for the fold. Labels that are null
are left out; of several labels of an id the largest counts, of several texts of an id the shortest. Without both
classes in the sample every score is the known share of toxic labels (0 without labels). Repeated rows: one result
each. Very long texts: scored whole, in memory that follows the longest text. Other columns are not inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, doc_chunks, hash_tables, joined, powers, texts_of

SIZES = (3, 4, 5)
BUCKET_BITS = 16
DIM = 8
WINDOW = 2
PER_CLASS = 3000
MAX_BYTES = 16 << 20
EPOCHS = 80
MOST, DEVIATIONS = 5.0, 3.0


def normalised(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased and white space made blank, and the white-space mask."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[9:14] = 32
    low = table[data]
    return low, low == 32


def ngrams(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, (bucket of the n-gram that starts at each byte, whether it lies in one word and its blanks)."""
    low, ws = normalised(data)
    table, base, inverse = hash_tables(31)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(table[low] * powers(base, len(low)), out=total[1:])
    back = powers(inverse, len(low))
    blanks = np.zeros(len(low) + 1, np.int32)
    np.cumsum(ws, out=blanks[1:])
    for size in SIZES:
        n = len(low) - size + 1
        if n <= 0:
            return
        h = (total[size:] - total[:n]) * back[:n]
        h *= np.uint64(0x9E3779B97F4A7C15)
        yield (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), blanks[size - 1 : size - 1 + n] == blanks[1 : 1 + n]


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The joined bytes, where each window's n-grams begin (the blank before its first word), and its text's number."""
    data, begins, _ = joined(texts)
    ws = normalised(data)[1]
    starts = np.flatnonzero(ws[:-1] & ~ws[1:]) + 1
    doc = np.searchsorted(begins, starts, "right") - 1
    nth = np.arange(len(starts)) - np.searchsorted(doc, doc)
    first = nth % WINDOW == 0
    return data, starts[first] - 1, doc[first]


def hazards(table: np.ndarray, bias: float, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each window its hazard, and the number of its text."""
    data, at, doc = windows(texts)
    sums, counts = np.zeros(len(at)), np.zeros(len(at))
    if len(at):
        for bucket, valid in ngrams(data):
            here = np.minimum(at, len(bucket) - 1)
            # the last window of a slice may begin where no n-gram of this size does; it then has none
            got = np.where(valid, table[bucket], np.float32(0))
            sums += np.add.reduceat(got, here, dtype=np.float64)
            counts += np.add.reduceat(valid, here, dtype=np.int64)
    return np.minimum(np.logaddexp(0, bias + sums / np.maximum(counts, 1)), MOST), doc


def window_scores(table: np.ndarray, bias: float, mean: float, deviation: float, texts: list[bytes]) -> np.ndarray:
    """For each text, the probability that some window is toxic, beyond what clean text of its length has."""
    hazard, doc = hazards(table, bias, texts)
    n = np.bincount(doc, minlength=len(texts))
    total = np.bincount(doc, hazard, len(texts)) - n * mean - DEVIATIONS * np.sqrt(n) * deviation
    return -np.expm1(-np.maximum(total, 0))


def background(table: np.ndarray, bias: float, texts: list[bytes]) -> tuple[float, float]:
    """Mean and standard deviation of the hazard of a window of clean texts; as if three more windows had a hazard of 1, which as many clean windows could hide."""
    hazard, _ = hazards(table, bias, texts)
    n = len(hazard) + 3
    mean = (hazard.sum() + 3) / n
    return float(mean), float(np.sqrt(max(((hazard * hazard).sum() + 3) / n - mean * mean, 0)))


def train(texts: list[bytes], toxic: np.ndarray, prior: float, epochs: int = EPOCHS, seed: int = 5) -> tuple[np.ndarray, float]:
    """One number a bucket and the bias, from embeddings and softmax weights trained jointly by Adam.

    prior: the share of toxic documents that the balanced sample is weighed back to.
    """
    number: dict[bytes, int] = {}
    ids, doc_words = [], []
    for t in texts:
        words = t.lower().split()
        ids.append(np.array([number.setdefault(w, len(number)) for w in words], np.int32))
        doc_words.append(len(words))
    # the n-grams of each distinct word: its buckets, one word after the other; int32 throughout, for one task's memory
    data, begins, _ = joined(list(number))
    owner, buckets = [], []
    for bucket, valid in ngrams(data):
        pos = np.flatnonzero(valid)
        owner.append((np.searchsorted(begins, pos + 1, "right") - 1).astype(np.int32))
        buckets.append(bucket[pos])
    del data, bucket, valid, pos
    owner, buckets = np.concatenate(owner), np.concatenate(buckets)
    order = np.argsort(owner, kind="stable").astype(np.int32)
    owner, buckets = owner[order], buckets[order]
    del order
    used = np.flatnonzero(np.bincount(buckets, minlength=1 << BUCKET_BITS))
    local = np.zeros(1 << BUCKET_BITS, np.int32)
    local[used] = np.arange(len(used))
    local = local[buckets]
    del buckets
    word_at = np.searchsorted(owner, np.arange(len(number)))
    word_n = np.bincount(owner, minlength=len(number))
    by_bucket = np.argsort(local, kind="stable").astype(np.int32)
    bucket_at = np.searchsorted(local[by_bucket], np.arange(len(used)))
    owner = owner[by_bucket]
    del by_bucket
    n_words = len(number)
    del number
    # windows: the first word of each and the document that it is of
    ids = np.concatenate(ids)
    ends = np.cumsum(doc_words)
    at = np.concatenate([np.arange(e - n, e, WINDOW) for e, n in zip(ends, doc_words, strict=True)]).astype(np.int64)
    doc = np.searchsorted(ends, at, "right")
    per = np.add.reduceat(word_n[ids], at).astype(np.float32)
    win = (np.searchsorted(at, np.arange(len(ids)), "right") - 1).astype(np.int32)

    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.1, (len(used), DIM)), rng.normal(0, 3, (DIM, 2)), np.array([4.0, 0.0])]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    n_toxic = max(1, int(toxic.sum()))
    weight = np.where(toxic == 1, prior / n_toxic, (1 - prior) / max(1, len(toxic) - n_toxic)) * len(toxic)
    rates = (0.1, 0.02, 0.05)
    for step in range(1, epochs + 1):
        e, w, b = params
        to = w[:, 1] - w[:, 0]
        # the average of embeddings times a weight is the average of the products
        z = np.add.reduceat(np.add.reduceat((e @ to).astype(np.float32)[local], word_at)[ids], at) / per + (b[1] - b[0])
        total = np.bincount(doc, np.logaddexp(0, z), len(texts))
        g_total = np.where(toxic == 1, -1 / np.expm1(np.clip(total, 1e-4, 50)), 1.0) * weight / len(texts)
        gz = g_total[doc] / (1 + np.exp(-z))
        pull = np.bincount(ids, (gz / per)[win], n_words)
        pull = np.add.reduceat(pull.astype(np.float32)[owner], bucket_at, dtype=np.float64)
        gw = e.T @ pull
        grads = [pull[:, None] * to[None, :], np.stack([-gw, gw], axis=1), np.array([-gz.sum(), gz.sum()])]
        for k, g in enumerate(grads):
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            params[k] = params[k] - rates[k] * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    e, w, b = params
    table = np.zeros(1 << BUCKET_BITS, np.float32)
    table[used] = e @ (w[:, 1] - w[:, 0])
    return table, float(b[1] - b[0])


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


@dataclass
class Model:
    """table, bias: the folded net; None with a constant score in bias. mean, deviation: the hazard of clean windows."""

    table: np.ndarray | None
    bias: float
    mean: float = 0.0
    deviation: float = 0.0

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        if self.table is None:
            return np.full(len(texts), self.bias)
        return window_scores(self.table, self.bias, self.mean, self.deviation, texts)


def within(sizes: list[tuple], budget: int) -> list[tuple]:
    """Of (doc_id, toxic, size), in order, those that fit half the budget for each class; what doesn't fit is passed over."""
    left, out = {0: budget // 2, 1: budget // 2}, []
    for doc_id, toxic, size in sizes:
        if size <= left[toxic]:
            left[toxic] -= size
            out.append((doc_id, toxic, size))
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> Model:
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n, bad = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = bad / n if n else 0.0
    constant = Model(None, min(max(share, 0.0), 1 - 1e-9))
    # At most 2 * per_class ids: the broadcasts below have that bound.
    chosen = None
    for c in (0, 1):
        part = known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select("doc_id", "text", F.octet_length("text").alias("size"))
    sizes = texts.where("size > 0").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("size").alias("size")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    sample = within([tuple(r) for r in sizes], max_bytes)
    if {toxic for _, toxic, _ in sample} != {0, 1}:
        return constant
    picked = docs.sparkSession.createDataFrame(sample, f"doc_id {dict(docs.dtypes)['doc_id']}, toxic int, size int")
    rows = texts.join(F.broadcast(picked), ["doc_id", "size"]).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += texts_of(batch, "text")
            toxic += batch.column("toxic").to_pylist()
        if not texts:
            return
        toxic = np.array(toxic)
        # every fifth clean document measures the background and takes no part in training
        apart = (toxic == 0) & (np.cumsum(toxic == 0) % 5 == 0)
        seen = [t for t, a in zip(texts, apart.tolist(), strict=True) if not a and t.split()]
        marks = np.array([x for t, x, a in zip(texts, toxic.tolist(), apart.tolist(), strict=True) if not a and t.split()], np.int64)
        if len(set(marks.tolist())) < 2:
            return
        table, bias = train(seen, marks, share)
        mean, deviation = background(table, bias, [t for t, a in zip(texts, apart.tolist(), strict=True) if a])
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary()), pa.array([bias]), pa.array([mean]), pa.array([deviation])], ["model", "bias", "mean", "deviation"])

    # max_bytes of text at most: one task
    got = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").mapInArrow(run, "model binary, bias double, mean double, deviation double").collect()
    return Model(np.frombuffer(got[0].model, np.float32), got[0].bias, got[0].mean, got[0].deviation) if got else constant


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_chunks(batches, "text", 1 << 20):
            s = model(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    bound_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def clean_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all columns, whose text isn't predicted toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_chunks(batches, "text", 1 << 20):
            yield batch.filter(pa.array(model(texts_of(batch, "text")) < 0.5))

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    return score(docs, fit(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
