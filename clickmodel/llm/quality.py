"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors of its hashed features: words, pairs of
neighbouring words, and the character n-grams inside words. A softmax over the average gives the
class. Vectors and output layer are trained together by stochastic gradient descent in numpy, on
a bounded sample of labelled documents (``SAMPLE_DOCS``, those with the least hash of their id).

The output is linear in the average, so for scoring each bucket's vector is reduced to one
number, its part in the difference of the two class scores; a document's score is the logistic
function of the mean over its features. That table of fixed size is all that is sent out.

Features of a word depend on its letters' case and on nothing but the text. A pair's bucket is
hashed from the exclusive-or of its words' hashes, so that doubled words share one.

Defined results: NULL, empty and blank texts have no features and score the bias; repeated rows
score alike; labels that are NULL are ignored, an id labelled more than once takes the mean
label, and counts as 1 from one half on; without labels every score is 0.5; an empty table gives
an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmodel.llm.hashing import SPACE, U, Words, mix

WORD_BUCKETS, PAIR_BUCKETS, GRAM_BUCKETS = 1 << 15, 1 << 14, 1 << 15
BUCKETS = WORD_BUCKETS + PAIR_BUCKETS + GRAM_BUCKETS
GRAMS = (3, 4)
DIMENSIONS, STEPS, BATCH, RATE, SEED = 10, 2000, 32, 1.0, 7
SAMPLE_DOCS = 4000
THRESHOLD = 0.7
BATCH_TEXTS = 256


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every feature, kind by kind."""
    words = Words(texts)
    n = len(words.hashes)
    doc = np.repeat(np.arange(len(texts)), words.counts)
    yield doc, ((words.hashes >> U(20)) % U(WORD_BUCKETS)).astype(np.int64)
    if n > 1:
        near = np.flatnonzero(doc[1:] == doc[:-1])
        pair = mix(words.hashes[near] ^ words.hashes[near + 1])
        yield doc[near], WORD_BUCKETS + ((pair >> U(20)) % U(PAIR_BUCKETS)).astype(np.int64)
    # Character n-grams, with the white space beside a word as its border.
    if not n:
        return
    lead = np.flatnonzero((words.data & 0xC0) != 0x80)  # UTF-8: each character's first byte
    inside = ~SPACE[words.data[lead]]
    owner = np.repeat(np.arange(len(texts)), words.byte_counts)[lead]
    code = np.where(inside, words.data[lead], 32).astype(np.uint64)
    width = np.diff(np.r_[lead, len(words.data)])
    for k in range(1, 4):
        more = np.flatnonzero(width > k)
        code[more] = code[more] * U(256) + words.data[lead[more] + k].astype(np.uint64)
    for size in GRAMS:
        if len(lead) < size:
            continue
        m = len(lead) - size + 1
        good = owner[:m] == owner[size - 1 :]
        key = np.full(m, size, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                key = key * U(0x9E3779B97F4A7C15) + code[k : k + m]
                if 0 < k < size - 1:
                    good &= inside[k : k + m]
        at = np.flatnonzero(good)
        yield owner[at], WORD_BUCKETS + PAIR_BUCKETS + ((mix(key[at]) >> U(20)) % U(GRAM_BUCKETS)).astype(np.int64)


def bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct buckets with their share of its features."""
    out = []
    for k in range(len(texts)):
        got = [b for _, b in features(texts.slice(k, 1))]
        ids, counts = np.unique(np.concatenate(got), return_counts=True) if got else (np.zeros(0, np.int64), np.zeros(0))
        out.append((ids.astype(np.int32), (counts / max(counts.sum(), 1)).astype(np.float32)))
    return out


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = bags(b.column("text"))
        yield pa.RecordBatch.from_arrays(
            [b.column("label"), pa.array([i.tobytes() for i, _ in got], pa.binary()), pa.array([w.tobytes() for _, w in got], pa.binary())], ["label", "ids", "shares"]
        )


class Classifier:
    """Bucket vectors, class vectors and biases."""

    def __init__(self, seed: int = SEED):
        self.rng = np.random.default_rng(seed)
        self.vectors = self.rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
        self.out = np.zeros((2, DIMENSIONS), np.float32)
        self.bias = np.zeros(2, np.float32)

    def train(self, labels: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, rate: float = RATE) -> Classifier:
        """``steps`` batches, the rate falling evenly to 0, in passes over the shuffled rows."""
        order = np.zeros(0, np.int64)
        for done in range(steps if len(rows) else 0):
            if not len(order):
                order = self.rng.permutation(len(rows))
            some, order = order[:BATCH], order[BATCH:]
            self._step(labels[some], [rows[k] for k in some], rate * (1 - done / steps))
        return self

    def _step(self, labels, rows, rate):
        ids = np.concatenate([i for i, _ in rows])
        shares = np.concatenate([w for _, w in rows])
        owner = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
        hidden = np.zeros((len(rows), DIMENSIONS), np.float32)
        part = self.vectors[ids] * shares[:, None]
        for d in range(DIMENSIONS):
            hidden[:, d] = np.bincount(owner, part[:, d], len(rows))
        scores = hidden @ self.out.T + self.bias
        odds = np.exp(scores - scores.max(1, keepdims=True))
        error = odds / odds.sum(1, keepdims=True)
        error[np.arange(len(rows)), labels] -= 1
        back = error @ self.out
        self.out -= rate * error.T @ hidden / len(rows)
        self.bias -= rate * error.mean(0)
        # A document's vectors share one gradient; spread over its features, as in plain SGD by document.
        np.subtract.at(self.vectors, ids, rate * shares[:, None] * back[owner])

    def bucket_scores(self) -> tuple[np.ndarray, float]:
        return (self.vectors @ (self.out[1] - self.out[0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def score_texts(texts: pa.Array, table: np.ndarray, bias: float) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for doc, bucket in features(texts):
        total += np.bincount(doc, table[bucket], len(texts))
        count += np.bincount(doc, minlength=len(texts))
    return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + bias)))


def held_out(id_col: str):
    """Rows that no label may be learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Trains on at most ``sample`` labelled documents that are not held out."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("long").alias("label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    got = rows.join(F.broadcast(known), "_id").select("label", "text").mapInArrow(_bags, "label bigint, ids binary, shares binary")
    found = sorted((bytes(r.ids), bytes(r.shares), r.label) for r in got.toLocalIterator())
    bag = [(np.frombuffer(i, np.int32), np.frombuffer(w, np.float32)) for i, w, _ in found]
    return Classifier().train(np.array([x for _, _, x in found], np.int64), bag)


def _scorer(table, bias: float, n_keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, BATCH_TEXTS):
                b = whole.slice(a, BATCH_TEXTS)
                scores = score_texts(b.column("_text"), table.value, bias)
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(n_keep)], pa.array(scores, pa.float64())], [*b.schema.names[:n_keep], "score"])

    return run


def score(docs: DataFrame, model: Classifier, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` plus each whole text's score."""
    table, bias = model.bucket_scores()
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["score double"])
    return rows.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(table), bias, len(keep)), schema)
