"""Benchmark decontamination by greedy string tiling (operator 7).

Documents and benchmark items are compared as word sequences (lower case; ASCII
and ideographic punctuation separates; in scripts that write no spaces each
character is a word). Runs of ``min_tile`` words are hashed (Karp-Rabin)
and looked up among the items' runs; these seeds give the pairs to compare. In
a pair the longest match of unmarked words becomes a tile and is marked, again
and again, until no match of ``min_tile`` words is left; so passages that were
cut up and reordered are still covered. A document is contaminated by an item
if tiles cover at least ``coverage`` of the item's words.

Which pairs are looked at is exact: an item covered to that degree has at least
``ceil(coverage * words / min_tile)`` of its runs in the document, so one of any
(all - that + 1) runs is there. The runs that fewest items share are taken.

The benchmark goes to the tasks in blocks of bounded size (``block_words``), one
pass over the documents for each; usual benchmarks are one block. Documents are
never shuffled: each is compared whole, in its row.

An item of fewer than ``min_tile`` words is found where it stands whole: as all
the words between two ends of texts, lines or sentences. Inside a longer sentence
so few words can't be told from chance.

Edge cases: null and empty texts, and items without a word, match nothing;
repeated rows, on either side, each give their rows (a block holds a repeated
item once); an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from prefweave.llm.tables import need
from prefweave.llm.textarrays import chain, chunks, column, word_hashes, words

MIN_TILE = 4
COVERAGE = 0.7
BLOCK_WORDS = 500_000

SEPARATED = np.arange(256, dtype=np.uint8)     # ASCII letters, digits and all other bytes stay
for _c in range(128):
    if not chr(_c).isalnum():
        SEPARATED[_c] = 0x20


# UTF-8 lead bytes, and the second bytes they stand with, of scripts
# without spaces between words: Thai and Lao, Myanmar, Khmer, kana and ideographs.
UNSPACED = {0xE0: (0xB8, 0xBB), 0xE1: (0x9E, 0x9F), 0xE3: (0x81, 0xBF),
            **{lead: (0x80, 0xBF) for lead in range(0xE4, 0xEA)}}
MYANMAR = (0x80, 0x82)         # second bytes after 0xE1
STOP = np.zeros(256, dtype=bool)
STOP[[ord(c) for c in "\n\r.!?"]] = True
#: Ideographic full stop, and the wide forms of ! . and ?, which end sentences.
WIDE_STOPS = [(0xE3, 0x80, 0x82), (0xEF, 0xBC, 0x81), (0xEF, 0xBC, 0x8E), (0xEF, 0xBC, 0x9F)]


def lowered(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with its texts in lower case, of every script that has it."""
    at = batch.schema.get_field_index("text")
    return batch.set_column(at, "text", pc.utf8_lower(batch.column(at).cast(pa.large_string())))


def spaced(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with spaces around the characters of scripts that write none, and
    their punctuation as ``.`` or spaces."""
    if len(buf) < 3 or not (buf >= 0xE0).any():
        return buf, offs
    second, third = np.append(buf[1:], 0), np.append(buf[2:], [0, 0])
    buf = buf.copy()
    wide = np.zeros(len(buf), dtype=bool)
    for a, b, c in WIDE_STOPS:
        wide |= (buf == a) & (second == b) & (third == c)
    other = ((buf == 0xE3) & (second == 0x80) | (buf == 0xEF) & (second == 0xBC) & (third < 0x90)) & ~wide
    alone = (buf == 0xE1) & (second >= MYANMAR[0]) & (second <= MYANMAR[1])
    for lead, (low, high) in UNSPACED.items():
        alone |= (buf == lead) & (second >= low) & (second <= high)
    for mask, byte in ((wide, ord(".")), (other, ord(" "))):
        for i in range(3):
            buf[np.flatnonzero(mask) + i] = byte
    gaps = np.flatnonzero(alone)
    if not len(gaps):
        return buf, offs
    at = np.concatenate([gaps, gaps + 3])
    return np.insert(buf, at, ord(" ")), offs + np.searchsorted(np.sort(at), offs, side="left")


def sequences(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, row offsets, whether a text, line or sentence begins
    at each word)."""
    buf, offs = spaced(buf, offs)
    plain = SEPARATED[buf]
    hashes, rows = word_hashes(plain, offs)
    starts, ends, _ = words(plain, offs)
    stops = np.concatenate([[0], np.cumsum(STOP[buf])])
    begins = np.ones(len(starts), dtype=bool)
    begins[1:] = stops[starts[1:]] > stops[ends[:-1]]
    begins[rows[:-1][np.diff(rows) > 0]] = True
    return hashes, rows, begins


def whole_sentences(hashes: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the sentences of ``size`` words."""
    first = np.flatnonzero(begins)
    first = first[np.diff(np.append(first, len(hashes))) == size]
    return first, chain([hashes[first + i] for i in range(size)]) if len(first) else np.zeros(0, np.uint64)


def item_words(texts: list[str]) -> list[np.ndarray]:
    out = []
    for lo, hi, buf, offs in chunks(lowered(pa.record_batch([pa.array(texts, pa.string())], ["text"]))):
        h, rows, _ = sequences(buf, offs)
        out += [h[a:b] for a, b in zip(rows[:-1], rows[1:])]
    return out


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    return chain([words[i:i + n] for i in range(k)]) if n > 0 else np.zeros(0, np.uint64)


class Index:
    """Runs of a block of items: all of them, and those that select pairs."""

    def __init__(self, item_ids: list[int | None], texts: list[str], min_tile: int, coverage: float,
                 copies: list[int] | None = None):
        self.min_tile, self.coverage = min_tile, coverage
        self.ids, self.sizes, self.copies, runs, short = [], [], [], [], []
        for item, n, words in zip(item_ids, copies or [1] * len(texts), item_words(texts)):
            if len(words) >= min_tile:
                self.ids.append(item)
                self.sizes.append(len(words))
                self.copies.append(n)
                runs.append(run_hashes(words, min_tile))
            elif len(words):
                short.append((item, n, words))
        # By size: hash of the whole item -> its places in ids.
        self.short: dict[int, dict[int, list[int]]] = {}
        for item, n, words in short:
            whole = self.short.setdefault(len(words), {})
            whole.setdefault(int(run_hashes(words, len(words))[0]), []).append(len(self.ids))
            self.ids.append(item)
            self.sizes.append(len(words))
            self.copies.append(n)
        self.where: list[dict[int, list[int]]] = []
        for r in runs:
            places: dict[int, list[int]] = {}
            for i, h in enumerate(r.tolist()):
                places.setdefault(h, []).append(i)
            self.where.append(places)
        shared: dict[int, int] = {}
        for places in self.where:
            for h in places:
                shared[h] = shared.get(h, 0) + 1
        keys, owners = [], []
        for i, (places, n) in enumerate(zip(self.where, self.sizes)):
            needed = math.ceil(coverage * n / min_tile - 1e-9)
            rarest = sorted(places, key=lambda h: (shared[h], h))
            # Runs repeated inside an item count by their places.
            spare, taken = n - min_tile + 1 - max(needed, 1), 0
            for h in rarest:
                keys.append(h)
                owners.append(i)
                taken += len(places[h])
                if taken > spare:
                    break
        order = np.argsort(np.array(keys, np.uint64), kind="stable") if keys else np.zeros(0, np.int64)
        self.keys = np.array(keys, np.uint64)[order]
        self.owners = np.array(owners, np.int64)[order]

    def pairs(self, runs: np.ndarray, row: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) pairs that share a selecting run."""
        lo = np.searchsorted(self.keys, runs, side="left")
        hi = np.searchsorted(self.keys, runs, side="right")
        out = set()
        for i in np.flatnonzero(hi > lo):
            out.update((int(row[i]), int(o)) for o in self.owners[lo[i]:hi[i]])
        return out


def tiles(runs: list[int], places: dict[int, list[int]], k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of a document and an item: (place in the document, place
    in the item, words), longest first. ``runs``: the document's run hashes."""
    matched: dict[int, list[int]] = {}             # diagonal -> document places of seeds
    for d, h in enumerate(runs):
        for i in places.get(h, ()):
            matched.setdefault(d - i, []).append(d)
    heap = []
    for diagonal, at in matched.items():
        start = last = at[0]
        for d in at[1:]:
            if d != last + 1:
                heap.append((start - last, start - diagonal, start, last - start + k))
                start = d
            last = d
        heap.append((start - last, start - diagonal, start, last - start + k))
    heap = [(-n, i, d) for _, i, d, n in heap]
    heapq.heapify(heap)
    used_d, used_i, out = set(), set(), []
    while heap:
        n, i, d = heapq.heappop(heap)
        n = -n
        free = [d + j not in used_d and i + j not in used_i for j in range(n)]
        if all(free):
            out.append((d, i, n))
            used_d.update(range(d, d + n))
            used_i.update(range(i, i + n))
            continue
        start = None
        for j in range(n + 1):
            if j < n and free[j]:
                start = j if start is None else start
            elif start is not None:
                if j - start >= k:
                    heapq.heappush(heap, (start - j, i + start, d + start))
                start = None
    return out


def _compare(index: Index, buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """(row, item, tiles) of the contaminated pairs of a chunk of texts."""
    k = index.min_tile
    words, rows, begins = sequences(buf, offs)
    found = []
    for size, items in index.short.items():
        first, whole = whole_sentences(words, begins, size)
        known = np.flatnonzero(np.isin(whole, np.fromiter(items, np.uint64, len(items))))
        best: dict[tuple[int, int], int] = {}          # the first place in each text
        for place in known.tolist():
            r = int(np.searchsorted(rows, first[place], side="right")) - 1
            for item in items[int(whole[place])]:
                best.setdefault((r, item), int(first[place] - rows[r]))
        found += [(r, item, [(d, 0, size)]) for (r, item), d in best.items()]
    n = len(words) - k + 1
    if n <= 0 or not len(index.keys):
        return sorted(found)
    runs = run_hashes(words, k)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(rows))
    whole = row[:n] == row[k - 1:]
    for r, item in sorted(index.pairs(np.where(whole, runs, np.uint64(0)), row[:n])):
        own = runs[rows[r]:max(rows[r], rows[r + 1] - k + 1)].tolist()
        t = tiles(own, index.where[item], k)
        if sum(x[2] for x in t) >= index.coverage * index.sizes[item] - 1e-9:
            found.append((r, item, t))
    return sorted(found)


def _blocks(benchmark: DataFrame, min_tile: int, coverage: float, block_words: int) -> Iterator[Index]:
    """The benchmark as indexes of bounded size, one at a time."""
    items = need(benchmark, "item_id", "text").selectExpr("cast(item_id as bigint) item_id", "cast(text as string) text") \
        .where(F.col("text").isNotNull()).groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    total = items.select(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(total / (4 * block_words)))
    for b in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()   # about block_words words
        block = sorted(block, key=lambda r: (r["item_id"] is not None, r["item_id"] or 0, r["text"]))
        yield Index([r["item_id"] for r in block], [r["text"] for r in block], min_tile, coverage,
                    [r["copies"] for r in block])


def _mapped(documents: DataFrame, index: Index, emit: Callable, schema) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(index)      # bounded by the block size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in chunks(lowered(batch)):
                yield emit(batch, lo, hi, shared.value, _compare(shared.value, buf, offs))

    return documents.mapInArrow(run, schema)


def find_contamination(documents: DataFrame, benchmark: DataFrame, min_tile: int = MIN_TILE,
                       coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per contaminated (doc_id, item_id): the item's words, how many
    tiles cover, their number, the longest, and all tiles as
    ``document word:item word:words``."""
    docs = need(documents, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")

    def emit(batch, lo, hi, index, found):
        ids = column(batch, "doc_id")[lo:hi]
        found = [f for f in found for _ in range(index.copies[f[1]])]
        covered = [sum(x[2] for x in t) for _, _, t in found]
        sizes = [index.sizes[i] for _, i, _ in found]
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array([r for r, _, _ in found], pa.int64())),
             pa.array([index.ids[i] for _, i, _ in found], pa.int64()), pa.array(sizes, pa.int64()),
             pa.array(covered, pa.int64()), pa.array([c / s for c, s in zip(covered, sizes)], pa.float64()),
             pa.array([len(t) for _, _, t in found], pa.int64()),
             pa.array([max(x[2] for x in t) for _, _, t in found], pa.int64()),
             pa.array([",".join(f"{d}:{i}:{n}" for d, i, n in sorted(t)) for _, _, t in found], pa.string())],
            ["doc_id", "item_id", "n_words", "n_covered", "coverage", "n_tiles", "longest", "tiles"])

    schema = ("doc_id bigint, item_id bigint, n_words bigint, n_covered bigint, coverage double, n_tiles bigint, "
              "longest bigint, tiles string")
    out = None
    for index in _blocks(benchmark, min_tile, coverage, block_words):
        part = _mapped(docs, index, emit, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, min_tile: int = MIN_TILE,
                      coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents no item contaminates, with all their columns."""
    def emit(batch, lo, hi, index, found):
        keep = np.ones(hi - lo, dtype=bool)
        keep[[r for r, _, _ in found]] = False
        return batch.slice(lo, hi - lo).filter(pa.array(keep))

    for index in _blocks(benchmark, min_tile, coverage, block_words):
        documents = _mapped(documents, index, emit, documents.schema)
    return documents
