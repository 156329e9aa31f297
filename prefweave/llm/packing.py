"""Best-fit packing of documents into sequences by bin completion (operator 6).

Documents become pieces of at most ``capacity`` tokens. Packing depends on the
pieces' lengths only, so what is packed is the histogram of lengths (at most
``capacity`` counts, whatever the input): the solver returns patterns, each a
list of lengths that share a sequence and the number of sequences made so. The
pieces are then dealt to the patterns' places by their rank among the pieces of
their length, which Spark works out in salted windows.

The solver is bin completion branch-and-bound: best-fit decreasing gives the
first incumbent; then, around the largest remaining length, all fillings of the rest
that no other filling dominates are tried, made one at a time and the fullest first,
each for as many sequences at once as the counts allow and then for fewer; a branch is
cut when its waste exceeds what an improvement on the incumbent may waste. It ends when
the lower bound is reached, the tree is exhausted (the packing is then the best there
is), or after ``NODES`` steps, with the best packing found so far. A step is a node of
the tree or of the search for its fillings; no other limit ends it.

Edge cases: a null or empty text is one piece with the end id alone; repeated
rows are packed one by one; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from prefweave.llm.bpe import Encoder, default_vocabulary
from prefweave.llm.tables import need, stored
from prefweave.llm.textarrays import chunks, column

CAPACITY = 1024
END_ID = 2
NODES = 50_000                 # search steps after the first incumbent
RANKED = 200_000               # pieces of one length that one ranking group aims at

Pattern = tuple[tuple[int, ...], int]          # lengths, largest first; number of sequences


def waste_bound(counts: list[int], capacity: int) -> int:
    """Least number of sequences: all tokens, and Martello and Toth's bound."""
    best = math.ceil(sum(s * c for s, c in enumerate(counts)) / capacity)
    n = np.array(counts, dtype=object)
    total = np.array([s * c for s, c in enumerate(counts)], dtype=object)
    n_up, t_up = n.cumsum(), total.cumsum()
    for k in range(capacity // 2 + 1):
        big = n_up[capacity] - n_up[capacity - k]                       # over capacity - k
        half = n_up[capacity - k] - n_up[capacity // 2]                 # over half, up to capacity - k
        half_total = t_up[capacity - k] - t_up[capacity // 2]
        small_total = t_up[capacity // 2] - (t_up[k - 1] if k else 0)
        extra = max(0, math.ceil((small_total - (half * capacity - half_total)) / capacity))
        best = max(best, int(big + half + extra))
    return best


def best_fit(counts: list[int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on the histogram: sequences with the same content
    are filled together."""
    open_bins: dict[int, list[list]] = {}          # room -> [lengths, number]
    done: list[Pattern] = []
    for s in range(capacity, 0, -1):
        left = counts[s]
        for room in range(s, capacity + 1):
            while left and open_bins.get(room):
                lengths, number = open_bins[room].pop()
                each = room // s
                full = min(number, left // each)
                parts = [(full, each), (1, left - full * each)] if full < number else [(full, each)]
                used = 0
                for many, copies in parts:
                    if many and copies:
                        open_bins.setdefault(room - copies * s, []).append([lengths + (s,) * copies, many])
                        left -= many * copies
                        used += many
                if number > used:
                    open_bins[room].append([lengths, number - used])
                if used == 0:
                    break
            if not left:
                break
        if left:
            each = capacity // s
            for many, copies in ((left // each, each), (1, left % each)):
                if many and copies:
                    open_bins.setdefault(capacity - copies * s, []).append([(s,) * copies, many])
        done += [(tuple(l), n) for l, n in open_bins.pop(0, [])]
    return done + [(tuple(l), n) for bins in open_bins.values() for l, n in bins]


class Steps:
    """What is left of the search's steps."""

    def __init__(self, left: float):
        self.left = left

    def take(self) -> bool:
        self.left -= 1
        return self.left >= 0


def _spread(bits: int, most: int) -> int:
    """Every bit moved up by each of 0 to ``most`` places."""
    by = 1
    while by <= most:
        bits |= bits << min(by, most + 1 - by)
        by *= 2
    return bits


def fillings(counts: list[int], room: int, steps: Steps | None = None) -> Iterator[tuple[int, ...]]:
    """The undominated fillings of a room from ``counts``, lengths largest first,
    the fullest first, each once.

    A filling is dominated if another holds, for groups of its lengths, single
    ones at least as long. That is so exactly if a length it does not use up can
    take the place of some of its shorter lengths (or of none): their sum is at
    most that length, and the whole still fits. Sets of sums are bits of an
    integer; a part that is dominated whatever follows is left at once."""
    steps = steps or Steps(math.inf)
    if room <= 0 or not any(counts[1:room + 1]):
        yield ()
        return
    sizes = [s for s in range(room, 0, -1) if counts[s]]
    most = (1 << (room + 1)) - 1
    reach = [1] * (len(sizes) + 1)                 # sums of the lengths from each on
    for i in range(len(sizes) - 1, -1, -1):
        bits, copies, by = reach[i + 1], min(counts[sizes[i]], room // sizes[i]), 1
        while copies:
            by = min(by, copies)
            bits |= (bits << by * sizes[i]) & most
            copies, by = copies - by, by * 2
        reach[i] = bits
    free_at_first = sum(1 << s for s in sizes)

    def dominated(free: int, one: int, more: int, slack: int, above: int) -> bool:
        """``one``, ``more``: sums of one and of several chosen lengths;
        ``free``: lengths not used up; looked at: those over ``above``."""
        free &= -(1 << above + 1)
        if more & free:
            return True
        # Over a sum, by no more than the slack.
        return slack > 0 and _spread((1 | one | more) << 1, slack - 1) & free != 0

    def chosen(i: int, rest: int, slack: int, free: int, one: int, more: int) -> Iterator[tuple[int, ...]]:
        if not rest:
            if not dominated(free, one, more, slack, 0):
                yield ()
            return
        if slack and free >> rest + 1 & ((1 << slack) - 1):
            return                                 # one length takes the place of all that is to come
        alone = bool(free >> rest & 1)             # so it does for two or more
        for j in range(i, len(sizes)):
            if not reach[j] >> rest & 1:
                return
            s = sizes[j]
            if s > rest or alone and s != rest:
                continue
            one_s, more_s = one, more
            for copies in range(1, min(counts[s], rest // s) + 1):
                if not steps.take():
                    return
                more_s |= (one_s | more_s) << s & most
                one_s |= 1 << s
                left = rest - copies * s
                if not reach[j + 1] >> left & 1:
                    continue
                free_s = free & ~(1 << s) if copies == counts[s] else free
                if dominated(free_s, one_s, more_s, slack, s):
                    break
                for tail in chosen(j + 1, left, slack, free_s, one_s, more_s):
                    yield (s,) * copies + tail

    for total in range(room, 0, -1):
        if reach[0] >> total & 1:
            yield from chosen(0, total, room - total, free_at_first, 0, 0)


def complete_bins(counts: list[int], capacity: int, nodes: int = NODES) -> tuple[list[Pattern], int]:
    """(patterns, lower bound): bin completion from best-fit's incumbent."""
    incumbent = best_fit(counts, capacity)
    n_best = sum(n for _, n in incumbent)
    bound = waste_bound(counts, capacity)
    total = sum(s * c for s, c in enumerate(counts))
    steps = Steps(nodes)

    def branches(left: list[int], waste: int) -> Iterator[tuple[tuple[int, ...], int, int]]:
        """(lengths, number of sequences, waste after them), the least waste first."""
        s = next(s for s in range(capacity, 0, -1) if left[s])
        rest = list(left)
        rest[s] -= 1
        for fill in fillings(rest, capacity - s, steps):
            lengths = (s, *fill)
            each = capacity - sum(lengths)
            most = min(left[v] // lengths.count(v) for v in set(lengths))
            if each:
                most = min(most, ((n_best - 1) * capacity - total - waste) // each)
            if most <= 0:
                return                             # those that follow waste as much or more
            for times in range(most, 0, -1):
                yield lengths, times, waste + times * each

    # The path from the root: branches still to try, counts, pattern taken, sequences so far.
    path = [(branches(list(counts), 0), list(counts), None, 0)] if any(counts) else []
    while path and n_best > bound:
        options, left, _, used = path[-1]
        option = next(options, None)
        if option is None or not steps.take():
            if steps.left < 0:
                break
            path.pop()
            continue
        lengths, times, waste = option
        if waste > (n_best - 1) * capacity - total or used + times >= n_best:
            continue
        rest = list(left)
        for v in lengths:
            rest[v] -= times
        if any(rest):
            path.append((branches(rest, waste), rest, (lengths, times), used + times))
        else:
            n_best = used + times
            incumbent = [p for _, _, p, _ in path[1:]] + [(lengths, times)]
    return incumbent, bound


class Places:
    """Where the pieces of each length go: rank -> (sequence, offset)."""

    def __init__(self, patterns: list[Pattern]):
        per: dict[int, list[tuple[int, int, list[int]]]] = {}
        sequence = 0
        for lengths, times in sorted(patterns, key=lambda p: (tuple(-v for v in p[0]), p[1])):
            offsets: dict[int, list[int]] = {}
            at = 0
            for v in lengths:
                offsets.setdefault(v, []).append(at)
                at += v
            for v, o in offsets.items():
                per.setdefault(v, []).append((sequence, times, o))
            sequence += times
        self.by_length = {}
        for v, entries in per.items():
            end = np.cumsum([t * len(o) for _, t, o in entries])
            self.by_length[v] = (end, [e[0] for e in entries], [e[2] for e in entries])

    def of(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        end, sequences, offsets = self.by_length[length]
        entry = np.searchsorted(end, ranks, side="right")
        sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for e in np.unique(entry):
            own = entry == e
            within = ranks[own] - (end[e - 1] if e else 0)
            copies = len(offsets[e])
            sequence[own] = sequences[e] + within // copies
            offset[own] = np.array(offsets[e])[within % copies]
        return sequence, offset


def pieces(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
           end_id: int = END_ID) -> DataFrame:
    """The documents' pieces: doc_id, piece, start, length, ids_crc32."""
    vocabulary = vocabulary or default_vocabulary()
    docs = need(documents, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch):
                ids, rows = encoder.encode(buf, offs)
                out = []
                for i in range(hi - lo):
                    own = np.concatenate([ids[rows[i]:rows[i + 1]], end]).astype("<u4")
                    cuts = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
                    data = memoryview(own.view(np.uint8))
                    out += [(i, p, a, b - a, zlib.crc32(data[4 * a:4 * b]))
                            for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                i, p, a, n, crc = np.array(out, dtype=np.int64).reshape(-1, 5).T
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc_id")[lo:hi].take(pa.array(i)), pa.array(p.astype(np.int32)), pa.array(a),
                     pa.array(n), pa.array(crc)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = END_ID,
         nodes: int = NODES) -> DataFrame:
    """One row per piece with its sequence and place in it."""
    # The written number tells equal rows apart, so that copies are dealt to all windows.
    rows = stored(pieces(documents, capacity, vocabulary, end_id).withColumn("row", F.monotonically_increasing_id()),
                  "pieces")
    counts = [0] * (capacity + 1)
    for r in rows.groupBy("length").count().collect():        # at most ``capacity`` lengths
        counts[r["length"]] = r["count"]
    full, counts[capacity] = counts[capacity], 0
    patterns, _ = complete_bins(counts, capacity, nodes)
    if full:
        patterns = [((capacity,), full), *patterns]
    places = rows.sparkSession.sparkContext.broadcast(Places(patterns))     # bounded by the number of lengths

    salts = max(1, max(counts + [full]) // RANKED + 1)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    near = Window.partitionBy("length", "salt").orderBy("row")
    before = (rows.groupBy("length", "salt").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count"))
              .drop("count"))
    ranked = (rows.withColumn("rank", F.row_number().over(near) - 1)
              .join(before, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (column(batch, c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1))
            for own in np.split(order, edges[1:]):
                if len(own):
                    sequence[own], offset[own] = places.value.of(int(length[own[0]]), rank[own])
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                    "sequence_id bigint, offset bigint")
