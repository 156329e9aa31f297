"""Line dedup by winnowing over line hashes (operator 5).

A text is its sequence of non-blank lines (stripped, by hash). A window is the
shortest run of lines from a line on, or up to a line, with at least
``min_words`` words; its least line hash (the last one on ties) is selected as a
fingerprint. Two texts that share a run of ``min_words`` words or more share
its windows, hence a fingerprint: none is missed. Steps:

1. Every text becomes one narrow row of line hashes and word counts.
2. Winnow: selected lines whose hash is selected in two or more places are kept
   (a count with map-side combine; hot lines cost one row per task).
3. Join positions back to the narrow rows and, around each shared fingerprint,
   write the windows it was selected in. A window's hash names a matched stretch.
4. The first place of each window, in order of (doc_id, row, line), stays; every
   other place is a repeat. Overlapping repeats extend each other both ways to
   the whole repeated run.
5. A line that ``min_documents`` different texts or more hold is a repeat by
   itself, however short: texts are counted by line hash with map-side combine,
   and every later place of such a line goes, in a run of any length. Its first
   place, in the same order, is never inside a repeated run.
6. Delete the runs. Where a run repeats itself (its repeat overlaps the first
   place), the first place stays, but for lines of step 5.

No step pairs places with each other: a line in a third of all texts costs one
row per place. Line hashes have 64 bits, window hashes 128.

Edge cases: null and empty texts stay as they are, and so do texts with fewer
words, but for lines of step 5; blank lines go only inside a deleted run; rows equal in id and text count as
one text, so none is deleted on account of the other; a null id sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from prefweave.llm.tables import stored
from prefweave.llm.textarrays import chunks, column, mix, span_hashes, words

MIN_WORDS = 30                 # least repeated run that two places are enough for
MIN_DOCUMENTS = 20             # texts that make a line a repeat, whatever its length
OWN_COLUMNS = ("n_lines", "n_removed", "removed", "_runs")     # replaced where the input has them

_U = np.uint64
_SEEDS = (_U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93))


def row_key(documents: DataFrame) -> Column:
    """Names a row by its content; equal rows have equal keys."""
    return F.xxhash64(documents["doc_id"].cast("bigint"), documents["text"].cast("string"))


def line_arrays(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, words, row offsets) of the non-blank lines of a chunk: a line
    reaches from its first word to its last."""
    starts, ends, rows = words(buf, offs)
    n = len(starts)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    breaks = np.cumsum(np.concatenate([[0], buf == 10]))       # newlines before each byte
    opens = np.ones(n, dtype=bool)
    opens[1:] = breaks[starts[1:]] != breaks[starts[:-1]]
    opens[rows[:-1][np.diff(rows) > 0]] = True
    first = np.flatnonzero(opens)
    last = np.append(first[1:], n) - 1
    return span_hashes(buf, starts[first], ends[last]), last - first + 1, np.searchsorted(first, rows)


def windows(n_words: np.ndarray, rows: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last line) of every window, forward and backward, without repeats."""
    n = len(n_words)
    before = np.concatenate([[0], np.cumsum(n_words)])
    size = np.diff(rows)
    row_end, row_start = np.repeat(rows[1:], size), np.repeat(rows[:-1], size)
    line = np.arange(n)
    last = np.searchsorted(before, before[:-1] + min_words, side="left") - 1
    ok = last < row_end
    forward = (line[ok], last[ok])
    first = np.searchsorted(before, before[1:] - min_words, side="right") - 1
    ok = (before[1:] >= min_words) & (first >= row_start)
    both = np.unique(np.concatenate([forward[0] * (n + 1) + forward[1], first[ok] * (n + 1) + line[ok]]))
    return both // (n + 1), both % (n + 1)


def anchors(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The line with the least hash in each window, the last one on ties."""
    best, where = hashes[first].copy(), first.copy()
    open_ = np.flatnonzero(last > first)
    step = 1
    while len(open_):
        at = first[open_] + step
        less = hashes[at] <= best[open_]
        best[open_[less]], where[open_[less]] = hashes[at[less]], at[less]
        step += 1
        open_ = open_[last[open_] >= first[open_] + step]
    return where


def window_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    out = []
    for seed in _SEEDS:
        h = mix(hashes[first] * seed + (last - first).astype(np.uint64))
        open_ = np.flatnonzero(last > first)
        step = 1
        while len(open_):
            h[open_] = mix(h[open_] * seed + hashes[first[open_] + step])
            step += 1
            open_ = open_[last[open_] >= first[open_] + step]
        out.append(h)
    return out


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.astype(np.uint64).view(np.int64))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offs in chunks(batch):
            h, n, rows = line_arrays(buf, offs)
            n = n.astype(np.uint32)
            own = list(zip(rows[:-1], rows[1:]))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id")[lo:hi], column(batch, "rid")[lo:hi],
                 pa.array([h[a:b].tobytes() for a, b in own], pa.binary()),
                 pa.array([n[a:b].tobytes() for a, b in own], pa.binary())], ["doc_id", "rid", "hashes", "n_words"])


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = [np.frombuffer(v.as_py(), np.uint64) for v in column(batch, "hashes")]
    n = [np.frombuffer(v.as_py(), np.uint32) for v in column(batch, "n_words")]
    rows = np.concatenate([[0], np.cumsum([len(v) for v in h])]).astype(np.int64)
    return np.concatenate(h), np.concatenate(n).astype(np.int64), rows


def _line_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        h, _, rows = _unpacked(batch)
        row = np.repeat(np.arange(batch.num_rows), np.diff(rows))
        yield pa.RecordBatch.from_arrays(
            [_long(h), column(batch, "doc_id").take(pa.array(row)), column(batch, "rid").take(pa.array(row)),
             pa.array((np.arange(len(h)) - rows[row]).astype(np.int32))], ["h", "doc_id", "rid", "line"])


def _own_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every different line of each text once."""
    for batch in batches:
        own = [np.unique(np.frombuffer(v.as_py(), np.uint64)) for v in column(batch, "hashes")]
        yield pa.RecordBatch.from_arrays([_long(np.concatenate([np.zeros(0, np.uint64), *own]))], ["h"])


def common_lines(lines: DataFrame, min_documents: int) -> DataFrame:
    """doc_id, rid, a, b: the later places of the lines that occur in
    ``min_documents`` texts or more; ``lines`` has each text once."""
    common = (lines.mapInArrow(_own_lines, "h bigint").groupBy("h").agg(F.count("*").alias("n"))
              .where(F.col("n") >= min_documents).select("h"))
    places = stored(lines.mapInArrow(_line_places, "h bigint, doc_id bigint, rid bigint, line int")
                    .join(common, "h", "left_semi"), "common-lines")
    origin = places.groupBy("h").agg(F.min(F.struct("doc_id", "rid", "line")).alias("o"))
    return places.join(origin, "h").where(F.struct("doc_id", "rid", "line") > F.col("o")).select(
        "doc_id", "rid", F.col("line").alias("a"), F.col("line").alias("b"))


def repeated_runs(documents: DataFrame, min_words: int = MIN_WORDS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """doc_id, rid, runs: the line ranges (of non-blank lines, both ends
    included) to delete from each text that has any."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key(documents).alias("rid"),
                            F.col("text").cast("string").alias("text"))
    lines = stored(docs.mapInArrow(_signatures, "doc_id bigint, rid bigint, hashes binary, n_words binary")
                   .where(F.length("hashes") > 0).dropDuplicates(["doc_id", "rid"]), "lines")

    def select(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            h, n, rows = _unpacked(batch)
            at = np.unique(anchors(h, *windows(n, rows, min_words)))
            row = np.searchsorted(rows, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [_long(h[at]), column(batch, "doc_id").take(pa.array(row)), column(batch, "rid").take(pa.array(row)),
                 pa.array((at - rows[row]).astype(np.int32))], ["h", "doc_id", "rid", "line"])

    selected = stored(lines.mapInArrow(select, "h bigint, doc_id bigint, rid bigint, line int"), "fingerprints")
    shared = selected.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    places = stored(selected.join(shared, "h", "left_semi").groupBy("doc_id", "rid").agg(
        F.collect_set("line").alias("at")), "places")         # a text's own lines

    def extend(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            h, n, rows = _unpacked(batch)
            hit = np.zeros(len(h), dtype=bool)
            for r, at in enumerate(column(batch, "at")):
                hit[rows[r] + np.array(at.as_py(), dtype=np.int64)] = True
            first, last = windows(n, rows, min_words)
            own = hit[anchors(h, first, last)]
            first, last = first[own], last[own]
            row = np.searchsorted(rows, first, side="right") - 1
            w1, w2 = window_hashes(h, first, last)
            yield pa.RecordBatch.from_arrays(
                [_long(w1), _long(w2), column(batch, "doc_id").take(pa.array(row)),
                 column(batch, "rid").take(pa.array(row)), pa.array((first - rows[row]).astype(np.int32)),
                 pa.array((last - rows[row]).astype(np.int32))], ["w1", "w2", "doc_id", "rid", "first", "last"])

    keys = ["doc_id", "rid"]
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["rid"] == b["rid"])          # noqa: E731
    found = lines.join(places, same(lines, places)).select(lines["doc_id"], lines["rid"], "hashes", "n_words", "at")
    found = stored(found.mapInArrow(extend, "w1 bigint, w2 bigint, doc_id bigint, rid bigint, first int, last int"),
                   "windows")
    origin = found.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "rid", "first", "last")).alias("o"),
                                           F.count("*").alias("n")).where("n > 1").drop("n")
    later = found.join(origin, ["w1", "w2"]).where(F.struct("doc_id", "rid", "first", "last") > F.col("o"))
    inside = F.col("doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("rid") == F.col("o.rid"))
    begin = F.when(inside, F.greatest("first", F.col("o.last") + 1)).otherwise(F.col("first"))
    runs = later.select(*keys, begin.alias("a"), F.col("last").alias("b")).where("a <= b")
    return stored(runs.union(common_lines(lines, min_documents)).distinct()
                  .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("runs")), "runs")


def remove_lines(text: str, runs: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the runs, and the merged runs."""
    merged: list[list[int]] = []
    for a, b in runs:
        if merged and a <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    kept, number, at = [], -1, 0
    for line in text.split("\n"):
        blank = not line.encode().strip(b"\t\n\x0b\x0c\r ")
        number += not blank
        while at < len(merged) and number > merged[at][1]:
            at += 1
        inside = at < len(merged) and merged[at][0] <= number
        if not (inside and (not blank or number < merged[at][1])):
            kept.append(line)
    return "\n".join(kept), [(a, b) for a, b in merged]


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """All rows and columns, ``text`` without later repeats, plus
    ``n_lines`` (non-blank, before), ``n_removed`` and ``removed``
    (``first-last`` line numbers, from 0)."""
    documents = documents.drop(*OWN_COLUMNS)
    rid = row_key(documents)
    runs = repeated_runs(documents, min_words, min_documents).select(F.col("doc_id").alias("_doc"), F.col("rid").alias("_rid"),
                                                      F.col("runs").alias("_runs"))
    joined = documents.join(runs, documents["doc_id"].cast("bigint").eqNullSafe(F.col("_doc")) & (rid == F.col("_rid")),
                            "left").drop("_doc", "_rid")
    schema = T.StructType([*documents.schema.fields, T.StructField("n_lines", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("removed", T.StringType())])

    names, out_names = documents.columns, schema.names

    def apply(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            n_lines = np.concatenate([np.zeros(0, np.int64), *(
                np.diff(line_arrays(buf, offs)[2]) for _, _, buf, offs in chunks(batch))]).astype(np.int64)
            texts, gone, removed = batch.column(at).to_pylist(), [], []
            for i, runs in enumerate(column(batch, "_runs")):
                own = []
                if runs.is_valid:
                    texts[i], own = remove_lines(texts[i], [(r["a"], r["b"]) for r in runs.as_py()])
                gone.append(sum(b - a + 1 for a, b in own))
                removed.append(",".join(f"{a}-{b}" for a, b in own))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            columns[names.index("text")] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines), pa.array(gone, pa.int64()), pa.array(removed, pa.string())], out_names)

    return joined.mapInArrow(apply, schema)


def without_repeats(documents: DataFrame, min_words: int = MIN_WORDS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The documents with later repeats deleted; a document nothing is
    left of goes. The columns stay; ``n_chars``, where there is one, follows."""
    names = documents.columns
    aside = {c: f"_input_{c}" for c in OWN_COLUMNS if c in names}
    documents = documents.withColumnsRenamed(aside)
    out = dedup_lines(documents, min_words, min_documents).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    if "n_chars" in names:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out.select(*[F.col(aside.get(c, c)).alias(c) for c in names])
