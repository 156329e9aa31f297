"""Quality score by attention-based multiple-instance learning (operator 8).

A document is a bag of passages of ``PASSAGE_WORDS`` words; only the document
has a label. Every passage becomes a feature row (hashed byte bigrams and a
few shares), is encoded by one tanh layer, gets a gated attention weight
(``w . (tanh(V h) * sigmoid(U h))``, softmax over the document's passages), and
the weighted mean of the encodings is scored by a logistic head.

Training: a bounded sample of labelled rows, ``PER_LABEL`` of each label, the
smallest hashes of the id among rows whose crc32 of the id is not 0 modulo 5,
whatever their length. Of a text with more than ``TRAIN_PASSAGES`` passages, that
many from evenly across the whole text are learned from (this bounds the driver's
memory; scoring reads every whole text). Passage features are made by
Spark tasks; the driver gets them as half floats and fits the small network by
full-batch gradients with numpy. Scoring is a narrow Arrow map; a document's
passages are made and pass through in blocks of ``BLOCK_BYTES`` of text with a running
softmax, so a very long text needs its own bytes and one block's features.

Edge cases: an empty or null text has one passage without words and gets its
score; without two labels to learn from, every score is the label's share (0.5
without labels); several labels of one document count by their mean (0.5 and
more is 1); repeated rows each give a row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from prefweave.llm.language import first_rows
from prefweave.llm.tables import need, split_crc
from prefweave.llm.textarrays import IS_SPACE, chunks, mix, word_hashes, words

PASSAGE_WORDS = 48
BUCKETS = 256                  # hashed byte bigrams
PER_LABEL = 500
TRAIN_PASSAGES = 64            # of a document, at most, in training
BLOCK_BYTES = 1 << 18          # of text whose passages are scored at once
HIDDEN, ATTENTION = 24, 12
EPOCHS, LEARNING_RATE, DECAY = 160, 0.02, 1e-4
THRESHOLD = 0.3

_KIND = np.zeros(256, dtype=np.int64)          # byte classes for the shares
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[IS_SPACE] = 4
_KIND[list(b".,;:!?'\"()-")] = 5
_KIND[128:] = 6
_PAIR = (mix(np.arange(1 << 16, dtype=np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.int64)
N_SHARES = 7 + 4
N_FEATURES = BUCKETS + N_SHARES


def passage_features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature row of each passage, row offsets) of a chunk of texts."""
    n_rows = len(offs) - 1
    starts, _, rows = words(buf, offs)
    n_words = np.diff(rows)
    per_row = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(per_row)])
    total = int(first[-1])
    # A passage reaches from its first word to the next passage's first word.
    within = np.arange(len(starts)) - np.repeat(rows[:-1], n_words)
    word_passage = np.repeat(first[:-1], n_words) + within // PASSAGE_WORDS
    begin = np.repeat(offs[:-1], per_row)
    opens = within % PASSAGE_WORDS == 0
    inner = opens & (within > 0)
    begin[word_passage[inner]] = starts[inner]
    size = np.diff(np.append(begin, len(buf)))
    passage = np.repeat(np.arange(total), size)
    x = np.zeros((total, N_FEATURES), dtype=np.float32)
    if len(buf):
        pair = (buf[:-1].astype(np.int64) << 8) | buf[1:]
        same = passage[:-1] == passage[1:]
        grams = np.bincount(passage[:-1][same] * BUCKETS + _PAIR[pair[same]], minlength=total * BUCKETS)
        grams = np.sqrt(grams.reshape(total, BUCKETS).astype(np.float32))
        x[:, :BUCKETS] = 4 * grams / np.maximum(np.linalg.norm(grams, axis=1, keepdims=True), 1)
        kinds = np.bincount(passage * 7 + _KIND[buf], minlength=total * 7).reshape(total, 7)
        x[:, BUCKETS:BUCKETS + 7] = 2 * kinds / np.maximum(size, 1)[:, None]
    count = np.bincount(word_passage, minlength=total)
    hashes, _ = word_hashes(buf, offs)
    order = np.lexsort((hashes, word_passage))
    h, p = hashes[order], word_passage[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (p[1:] != p[:-1])
    distinct = np.bincount(p[new], minlength=total)
    some = np.maximum(count, 1)
    x[:, -4] = 2 * distinct / some
    x[:, -3] = 2 * count / PASSAGE_WORDS
    x[:, -2] = np.minimum(size / some, 24) / 8
    x[:, -1] = count == 0
    return x, first


def passage_blocks(buf: np.ndarray, offs: np.ndarray,
                   most: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature rows, text of each) of a chunk, some ``most`` bytes at a time.
    A longer text is cut where a passage begins, so its rows are those of
    ``passage_features`` on the whole."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = min(max(int(np.searchsorted(offs, offs[lo] + most, side="right")) - 1, lo + 1), n)
        at, end, size = int(offs[lo]), int(offs[hi]), most
        while hi == lo + 1 and end - at > size:
            piece = buf[at:at + size]
            starts, _, _ = words(piece, np.array([0, size]))
            # The last word may go on behind the piece; its start is a start all the same.
            whole = (len(starts) - 1) // PASSAGE_WORDS
            if whole < 1:
                size *= 2
                continue
            cut = int(starts[whole * PASSAGE_WORDS])
            x, _ = passage_features(piece[:cut], np.array([0, cut]))
            yield x, np.full(len(x), lo)
            at, size = at + cut, most
        x, first = passage_features(buf[at:end], np.concatenate([[0], offs[lo + 1:hi + 1] - at]))
        yield x, np.repeat(np.arange(lo, hi), np.diff(first))
        lo = hi


class Network:
    """Passage encoder, gated attention and head; ``mean``/``scale`` centre the features."""

    NAMES = ("encode", "encode_b", "v", "u", "w", "head", "head_b")

    def __init__(self, seed: int = 8):
        r = np.random.default_rng(seed)
        self.encode = r.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, HIDDEN))
        self.encode_b = np.zeros(HIDDEN)
        self.v = r.normal(0, 0.3, (HIDDEN, ATTENTION))
        self.u = r.normal(0, 0.3, (HIDDEN, ATTENTION))
        self.w = r.normal(0, 0.3, ATTENTION)
        self.head = r.normal(0, 0.3, HIDDEN)
        self.head_b = np.zeros(1)
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)

    def passages(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        h = np.tanh(((x - self.mean) * self.scale) @ self.encode + self.encode_b)
        t, s = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        return h, t, s, (t * s) @ self.w

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss of the documents, by parameter."""
        z, doc = (x - self.mean) * self.scale, np.repeat(np.arange(len(y)), np.diff(first))
        h, t, s, a = self.passages(x)
        a = np.exp(a - np.maximum.reduceat(a, first[:-1])[doc])
        a /= np.add.reduceat(a, first[:-1])[doc]
        bag = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
        p = 1 / (1 + np.exp(-(bag @ self.head + self.head_b)))
        d = weight * (p - y)
        d_bag = d[:, None] * self.head
        d_a = (d_bag[doc] * h).sum(axis=1)
        d_a = a * (d_a - np.add.reduceat(a * d_a, first[:-1])[doc])      # through the softmax
        d_t, d_s = d_a[:, None] * self.w * s * (1 - t * t), d_a[:, None] * self.w * t * s * (1 - s)
        d_h = (a[:, None] * d_bag[doc] + d_t @ self.v.T + d_s @ self.u.T) * (1 - h * h)
        return {"encode": z.T @ d_h, "encode_b": d_h.sum(axis=0), "v": h.T @ d_t, "u": h.T @ d_s,
                "w": (t * s).T @ d_a, "head": bag.T @ d, "head_b": np.array([d.sum()])}

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> None:
        """Adam on the class-balanced log loss of the documents."""
        x = x.astype(np.float64)
        self.mean, deviation = x.mean(axis=0), x.std(axis=0)
        self.scale = 1 / np.maximum(deviation, 0.05)
        weight = 0.5 / np.bincount(y, minlength=2)[y]
        moments = {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in self.NAMES}
        for epoch in range(1, EPOCHS + 1):
            for n, g in self.gradients(x, first, y, weight).items():
                value = getattr(self, n)
                g = g + DECAY * value
                m, v2 = moments[n]
                m += 0.1 * (g - m)
                v2 += 0.001 * (g * g - v2)
                value -= LEARNING_RATE * (m / (1 - 0.9 ** epoch)) / (np.sqrt(v2 / (1 - 0.999 ** epoch)) + 1e-8)

    def score(self, blocks: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
        """Score of each of ``n`` documents; their passages come in blocks of
        (features, document of each, ascending), with a running maximum for the softmax."""
        top, total, bag = np.full(n, -np.inf), np.zeros(n), np.zeros((n, HIDDEN))
        for x, d in blocks:
            h, _, _, a = self.passages(x)
            edge = np.flatnonzero(np.diff(d, prepend=-1))
            own = d[edge]
            high = np.maximum(top[own], np.maximum.reduceat(a, edge))
            shrink = np.exp(top[own] - high)
            a = np.exp(a - np.repeat(high, np.diff(np.append(edge, len(d)))))
            total[own] = total[own] * shrink + np.add.reduceat(a, edge)
            bag[own] = bag[own] * shrink[:, None] + np.add.reduceat(a[:, None] * h, edge, axis=0)
            top[own] = high
        return 1 / (1 + np.exp(-((bag / total[:, None]) @ self.head + self.head_b)))


def _spread(x: np.ndarray) -> np.ndarray:
    """At most ``TRAIN_PASSAGES`` rows, evenly from first to last."""
    n = len(x)
    return x if n <= TRAIN_PASSAGES else x[np.arange(TRAIN_PASSAGES) * (n - 1) // (TRAIN_PASSAGES - 1)]


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offs in chunks(batch):
            x, first = passage_features(buf, offs)
            rows = [_spread(x[a:b]).astype(np.float16).tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(rows, pa.binary())],
                                             ["doc_id", "y", "x"])


def training_sample(documents: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """(doc_id, y, text) of the bounded labelled sample."""
    marks = need(labels, "doc_id", "quality").where(F.col("quality").isNotNull() & (split_crc() != 0))
    marks = marks.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    fit = need(documents, "doc_id", "text").where(F.col("text").isNotNull())
    marks = marks.join(fit.select("doc_id").distinct(), "doc_id", "left_semi")
    marks = marks.withColumn("h", F.xxhash64("doc_id")).withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(64)))
    near = Window.partitionBy("y", "salt").orderBy("h", "doc_id")
    far = Window.partitionBy("y").orderBy("h", "doc_id")
    ids = (marks.withColumn("r", F.row_number().over(near)).where(F.col("r") <= per_label)
           .withColumn("r", F.row_number().over(far)).where(F.col("r") <= per_label)
           .select(F.col("doc_id").alias("id"), "y"))
    texts = fit.join(F.broadcast(ids), F.col("doc_id") == F.col("id"))       # at most 2 * per_label ids
    texts = texts.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("y").cast("int").alias("y"),
                         F.col("text").cast("string").alias("text")).dropDuplicates(["doc_id", "text"])
    return first_rows(texts, "y", per_label)              # of ids with many texts, no more than the bound


def learn(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Network | float:
    """The fitted network, or the share of label 1 if there are no two labels."""
    rows = training_sample(documents, labels, per_label).mapInArrow(
        _feature_batches, "doc_id bigint, y int, x binary").collect()
    rows = sorted((r["doc_id"], r["y"], bytes(r["x"])) for r in rows)
    y = np.array([r[1] for r in rows], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    x = [np.frombuffer(r[2], np.float16).reshape(-1, N_FEATURES) for r in rows]
    network = Network()
    network.fit(np.concatenate(x), np.concatenate([[0], np.cumsum([len(v) for v in x])]), y)
    return network


def predict(documents: DataFrame, model: Network | float, threshold: float = THRESHOLD) -> DataFrame:
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                            F.coalesce(split_crc() == 0, F.lit(False)).alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(model)        # the network: a fixed size

    def run(batches):
        m = shared.value
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch):
                if isinstance(m, float):
                    s = np.full(hi - lo, m)
                else:
                    s = m.score(passage_blocks(buf, offs), hi - lo)
                s = np.clip(s, 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(2)[lo:hi], pa.array(s, pa.float64()),
                     pa.array((s >= threshold).astype(np.int32), pa.int32())],
                    ["doc_id", "held_out", "score", "predicted"])

    return docs.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def score_quality(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """Fit on the labelled sample and score every document."""
    return predict(documents, learn(documents, labels, per_label))
