"""Language identification by string kernels (operator 2).

The kernel of two texts is the normalised number of character n-grams (n = 1
to 4, lower case, white space folded) that occur in both: the blended-spectrum
presence kernel. Landmark texts give a Nystrom map, and one-versus-rest kernel
ridge regression is solved in that map's space. With the landmarks' presence
rows L, the whitening matrix H and the ridge weights W, a text with presence
row x scores ``x (L' H W) / |x|``; the small matrix ``L' H W`` is computed once
and a batch of texts is scored by one sparse-by-dense matrix product.

N-grams are numbered by hash into ``N_GRAMS`` buckets, a fixed space. The n-grams
of a long text would fill it, whatever the language, so a text is cut into
windows of equal length, at most ``WINDOW`` characters, that cover all of it: its
kernel, and so its score, is the mean over its windows (those with a letter).

Training reads a bounded sample of labelled rows: per language the
``PER_LANGUAGE`` rows with the smallest hash of the id, among rows with a
non-null language whose crc32 of the id is not 0 modulo 5. Spark tasks turn each
text into the presence row of one window, chosen by a hash of the text; of these
bit rows (``N_GRAMS`` bits each, for at most ``MAX_LANGUAGES`` languages, checked)
the driver takes the landmarks. Tasks then work out the kernel of every sampled
text, over all its windows, with the landmarks; one value for each pair comes to
the driver. Scoring is a narrow Arrow map over whole texts.

Edge cases: a text that is null or has no letter is ``und`` with score 0; if no
labelled text exists, every text is ``und``; with a single language every text
with a letter has it; repeated rows each give a row; ties go to the first
language by name; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from prefweave.llm.tables import need, split_crc, stored
from prefweave.llm.textarrays import mix, release

N_GRAMS = 1 << 15
MAX_N = 4
WINDOW = 1 << 11               # characters; sets a small part of the buckets
BLOCK = 256                    # windows scored at once
PER_LANGUAGE = 250             # labelled rows a language to learn from
LANDMARKS = 64                 # of them, a language
RIDGE = 0.05
# Bounds of what is learned from, whatever the labels hold: the languages with
# the most rows in the sample, and rows and landmarks of all languages together
# (each language has its even share of them, PER_LANGUAGE and LANDMARKS at most).
MAX_LANGUAGES = 512
MAX_ROWS = 16_000
MAX_LANDMARKS = 4096
UNKNOWN = "und"
MIN_SCORE = 0.3                # least score of a kept document in the pipeline

_SPACE = np.uint64(32)


def presence(text: str) -> np.ndarray:
    """Sorted buckets of the n-grams (n = 1 to MAX_N) that occur in a window."""
    flags = np.zeros(N_GRAMS, dtype=bool)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    codes = np.where(codes <= _SPACE, _SPACE, codes)
    gram = np.zeros(len(codes), dtype=np.uint64)
    for n in range(MAX_N):
        if len(codes) <= n:
            break
        gram = gram[:len(codes) - n] * np.uint64(0x110003) + codes[n:] + np.uint64(1)
        flags[mix(gram) & np.uint64(N_GRAMS - 1)] = True
    return np.flatnonzero(flags)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def windows(text: str) -> Iterator[str]:
    """The text in lower case, in even parts; none without a letter. A part
    reaches into the next, so that every n-gram is in one."""
    whole = text.lower()
    n = -(-len(whole) // WINDOW)
    for i in range(n):
        a, b = i * len(whole) // n, (i + 1) * len(whole) // n
        if has_letter(whole[a:b]):
            yield whole[a:b + MAX_N - 1]


def _packed(row: np.ndarray) -> bytes:
    flags = np.zeros(N_GRAMS, dtype=bool)
    flags[row] = True
    return np.packbits(flags).tobytes()


def _presence_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = []
        for value in batch.column(1):
            own = list(windows(value.as_py()))
            chosen = own[zlib.crc32(value.as_py().encode("utf-8", "surrogatepass")) % len(own)]
            bits.append(_packed(presence(chosen)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["lang", "bits"])


def training_sample(documents: DataFrame, per_language: int) -> DataFrame:
    """(lang, text) of the bounded labelled sample."""
    rows = need(documents, "doc_id", "text", "lang").where(
        (split_crc() != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    picked = rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    # Per task first, so that no language's rows meet in one task.
    near = Window.partitionBy("lang", "salt").orderBy("h", "doc_id")
    far = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = (picked.withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(64)))
              .withColumn("r", F.row_number().over(near)).where(F.col("r") <= per_language)
              .withColumn("r", F.row_number().over(far)).where(F.col("r") <= per_language))
    ids = picked.select(F.col("doc_id").alias("id"), F.col("lang").alias("l")).distinct()
    found = rows.join(F.broadcast(ids), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("l")))
    # Repeated rows count once, and an id with many texts has no more than its share.
    found = found.select("lang", "doc_id", F.col("text").cast("string").alias("text")).distinct()
    return first_rows(found, "lang", per_language).select("lang", "text")


def first_rows(rows: DataFrame, by: str, most: int) -> DataFrame:
    """At most ``most`` rows (doc_id, text) of each ``by``, by hash of id and
    text; first within 64 shares of it, so that no task gets all its rows."""
    order = ("h", "doc_id", "t", "text")
    rows = rows.withColumns({"h": F.xxhash64("doc_id"), "t": F.xxhash64("text")})
    rows = rows.withColumn("salt", F.pmod("t", F.lit(64)))
    for keys in ((by, "salt"), (by,)):
        rows = rows.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("r") <= most)
    return rows.drop("h", "t", "salt", "r")


class Model:
    """Languages and the (n-gram bucket x language) score matrix."""

    def __init__(self, languages: list[str], matrix: np.ndarray, bias: np.ndarray):
        self.languages, self.matrix, self.bias = languages, matrix, bias

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Ridge outputs of a batch of presence rows: one sparse product."""
        sizes = np.array([len(r) for r in rows])
        first = np.cumsum(sizes) - sizes
        sums = np.add.reduceat(self.matrix[np.concatenate(rows)], first, axis=0)
        return sums / np.sqrt(sizes)[:, None] + self.bias


def _unit_rows(bits: list[bytes]) -> np.ndarray:
    x = np.stack([np.unpackbits(np.frombuffer(b, np.uint8)) for b in bits]).astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def landmarks_of(labels: list[str], bits: list[bytes], most: int = LANDMARKS) -> list[bytes]:
    """The first ``most`` rows of each language."""
    y = np.array(labels)
    return [bits[i] for c in sorted(set(labels)) for i in np.flatnonzero(y == c)[:most]]


def kernel(text: str, marks: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Mean kernel of a text's windows with the landmarks (n-gram x landmark)."""
    total, n = np.zeros(len(norms)), 0
    for window in windows(text):
        row = presence(window)
        total += marks[row].sum(axis=0, dtype=np.int64) / (norms * np.sqrt(len(row)))
        n += 1
    return total / max(n, 1)


def fit(labels: list[str], kernels: np.ndarray, bits: list[bytes]) -> Model:
    """Nystrom map and ridge weights from the texts' kernels with the landmarks."""
    languages = sorted(set(labels))
    y = np.array([languages.index(v) for v in labels])
    landmarks = _unit_rows(bits)
    # Nystrom: phi(x) = H' k(x, landmarks) with H = K^(-1/2) over the landmarks.
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    phi = kernels.astype(np.float64) @ whiten
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # Each class counts alike, whatever its share of the sample.
    weight = 1.0 / np.bincount(y, minlength=len(languages))[y]
    weight /= weight.mean()
    centre, mean = np.average(phi, axis=0, weights=weight), np.average(target, axis=0, weights=weight)
    p = (phi - centre) * weight[:, None]
    ridge = np.linalg.solve(p.T @ (phi - centre) + RIDGE * np.eye(phi.shape[1]), p.T @ (target - mean))
    matrix = landmarks.T.astype(np.float64) @ (whiten @ ridge)
    return Model(languages, matrix.astype(np.float32), mean - centre @ ridge)


def learn(documents: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    sample = stored(training_sample(documents, per_language), "language-sample")
    counts = sample.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return None
    rows_each = max(1, min(per_language, MAX_ROWS // len(counts)))
    marks_each = max(1, min(LANDMARKS, MAX_LANDMARKS // len(counts)))
    if rows_each < per_language:
        order = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
        sample = sample.where(F.col("lang").isin(*[r["lang"] for r in counts]))
        sample = stored(sample.withColumn("r", F.row_number().over(order)).where(F.col("r") <= rows_each).drop("r"),
                        "language-sample")
    rows = sample.mapInArrow(_presence_bits, "lang string, bits binary").collect()
    rows = sorted((r["lang"], bytes(r["bits"])) for r in rows)
    bits = landmarks_of([r[0] for r in rows], [r[1] for r in rows], marks_each)
    shared = sample.sparkSession.sparkContext.broadcast(bits)

    def kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.ascontiguousarray(np.stack([np.unpackbits(np.frombuffer(b, np.uint8)) for b in shared.value]).T)
        norms = np.sqrt(np.maximum(marks.sum(axis=0, dtype=np.int64), 1))
        for batch in batches:
            own = [kernel(v.as_py(), marks, norms).astype(np.float32).tobytes() for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], ["lang", "kernel"])
            release()

    rows = sorted((r["lang"], bytes(r["kernel"])) for r in sample.mapInArrow(kernels, "lang string, kernel binary").collect())
    return fit([r[0] for r in rows], np.stack([np.frombuffer(r[1], np.float32) for r in rows]), bits)


def _classify(model: Model | None, texts: list[str]) -> tuple[list[str], list[float]]:
    """(language, score) of a batch of texts: the mean over a text's windows."""
    ok = [model is not None and has_letter(t) for t in texts]
    known = [t for t, o in zip(texts, ok) if o]
    total, n = np.zeros((len(known), len(model.languages) if known else 1)), np.zeros(len(known))
    rows, owner = [], []

    def add() -> None:
        if rows:
            np.add.at(total, owner, model.scores(rows))
            np.add.at(n, owner, 1)
            rows.clear()
            owner.clear()

    for i, text in enumerate(known):
        for window in windows(text):
            rows.append(presence(window))
            owner.append(i)
            if len(rows) == BLOCK:
                add()
    add()
    p = np.clip((total / n[:, None] + 1) / 2, 1e-6, 1)
    p = p / p.sum(axis=1, keepdims=True)
    best = iter(zip(p.argmax(axis=1), p.max(axis=1)))
    names, scores = [], []
    for o in ok:
        c, s = next(best) if o else (None, 0.0)
        names.append(model.languages[c] if o else UNKNOWN)
        scores.append(float(s))
    return names, scores


def _classified(model: Model | None, column: pa.Array) -> tuple[list[str], list[float]]:
    names, scores = [], []
    for lo in range(0, len(column), 256):
        n, s = _classify(model, [v.as_py() or "" for v in column[lo:lo + 256]])
        names += n
        scores += s
    return names, scores


def predict(documents: DataFrame, model: Model | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, the columns in ``keep``, lang_pred and score."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                            F.coalesce(split_crc() == 0, F.lit(False)).alias("held_out"), *keep,
                            F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)     # n-gram buckets x languages: fixed size
    out = docs.columns[:-1]

    def run(batches):
        for batch in batches:
            names, scores = _classified(shared.value, batch.column(len(out)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(out)], pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())], [*out, "lang_pred", "score"])
            release()

    schema = T.StructType([*docs.schema.fields[:-1], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def identify_languages(documents: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Train on the labelled sample of ``documents`` and predict every row."""
    return predict(documents, learn(documents, per_language))


def keep_identified(documents: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language is recognised: neither ``und`` nor scored
    below ``min_score``. The columns stay as they are."""
    shared = documents.sparkSession.sparkContext.broadcast(learn(documents))
    text = documents.columns.index("text")

    def run(batches):
        for batch in batches:
            names, scores = _classified(shared.value, batch.column(text))
            keep = [n != UNKNOWN and s >= min_score for n, s in zip(names, scores)]
            yield batch.filter(pa.array(keep, pa.bool_()))
            release()

    return documents.mapInArrow(run, documents.schema)
