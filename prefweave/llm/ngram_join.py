"""N-gram Jaccard self-join with grouped prefixes (operator 4).

A document's set is its distinct ``k``-word shingles. Two documents are linked
when ``100 * common >= percent * union``. Steps:

1. Equal sets are one class (a 128-bit digest); copies never meet again.
2. Shingles get a global order; any order gives the same links, a good one gives
   short lists. Shingles in the lower part of the hash space, a little more of it
   than prefixes take, are counted over all documents. First come those of them
   that one set alone has, then the upper part, then the shared ones, last the
   frequent ones, which every task counts.
3. A set of n shingles keeps its first ``n - ceil(percent * n / 100) + 1``: two
   linked sets share one of them. Classes with identical prefixes and size form
   one group, which stands in the lists once. Shingles of one set alone need no
   list, so most documents with text of their own stand in none; of lists with
   the same groups one is kept.
4. Groups that share a prefix shingle and pass the size and position bounds are
   candidate pairs; groups and pairs are expanded into member classes, and each
   pair of classes is verified: by an upper bound from small histograms of the
   hash space, then on whole sets.
5. So that a large group of near copies does not cost the square of its size,
   pairs come in rounds. Star rounds pair each list's groups with one leader;
   verified links give components. The last round makes every remaining pair of
   groups in different components; pairs inside a component need no look, since
   they cannot change it. Lists are split by size band, and a pair is made at the
   first shingle that it shares (checked against each group's first ``SEEN``
   shared shingles, then made distinct).

Components are exact: no pair that could join two of them goes unverified, and
nothing is capped. What the driver
receives is bounded: the order's frequent shingles (``HOT_SHINGLES``) and bit maps
of at most ``MAP_BITS`` bits: a fuller map lets more through, which costs work and
changes no link. Texts are read and cut anew in each pass rather than stored as sets;
smaller tables are written between steps, since the driver's memory grows with the scans
and exchanges of one plan.

Edge cases: null and empty texts have an empty set and no links; a text with
fewer than ``k`` words has its whole sequence as one shingle; repeated rows are
copies; rows with a null id count as documents but never name a component that
has an id; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from prefweave.llm.components import connected_components
from prefweave.llm.tables import need, stored
from prefweave.llm.textarrays import chunks, column, shingles, word_hashes

HOT_SHINGLES = 200_000
HOT_LEAST = 2                  # occurrences within one count that make a shingle worth reporting
COUNTED = 1 << 20              # shingles per count inside a task
SEEN = 8
MAP_BITS = 1 << 28
COUNTED_SHARE = 1.6            # part of the hash space that is counted, over the part prefixes take
STAR_ROUNDS = 2


def sets_of(buf: np.ndarray, offs: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    hashes, rows = word_hashes(buf, offs)
    h, row = shingles(hashes, rows, k)
    at = np.searchsorted(row, np.arange(len(offs)))
    out = []
    for a, b in zip(at[:-1], at[1:]):
        s = np.sort(h[a:b])
        if len(s) > 1:
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        out.append(s)
    return out


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs. Empties ``parts``,
    so that their memory is free before the sort, which is in place."""
    whole = np.concatenate([np.zeros(0, np.uint64), *parts])
    parts.clear()
    whole.sort()
    first = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]])) if len(whole) else np.zeros(0, np.int64)
    return whole[first], np.diff(np.append(first, len(whole)))


def _signed(a) -> pa.Array:
    return pa.array(np.asarray(a, dtype=np.uint64).view(np.int64))


def _describe(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "cid", "shingle", "df"]

        def frequent(parts):
            u, c = counted(parts)
            u, c = u[c >= HOT_LEAST], c[c >= HOT_LEAST]
            nothing = [pa.nulls(len(u), t) for t in (pa.int64(), pa.int64(), pa.binary())]
            return pa.RecordBatch.from_arrays([*nothing, _signed(u), pa.array(c.astype(np.int64))], names)

        parts, waiting = [], 0
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch):
                sets = sets_of(buf, offs, k)
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc_id")[lo:hi], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                     pa.nulls(hi - lo, pa.int64()), pa.nulls(hi - lo, pa.int64())], names)
                parts += sets
                waiting += sum(map(len, sets))
                if waiting >= COUNTED:
                    yield frequent(parts)
                    parts, waiting = [], 0
        if parts:
            yield frequent(parts)
    return run


class Order:
    """The global order of shingles: below ``low`` those that are not shared by
    hash, then those above ``low`` by hash, then the shared ones below by hash,
    then the frequent ones by count and hash. ``shared`` is a bit map that holds
    all shared shingles below ``low`` and maybe others."""

    def __init__(self, hot: tuple[np.ndarray, np.ndarray], low: int, shared: tuple[np.ndarray, int]):
        keys = hot[0].astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], hot[1].astype(np.int64)[order]
        self.low, self.shared = np.uint64(low), shared

    def prefix(self, s: np.ndarray, n: int) -> tuple[np.ndarray, int]:
        """The first ``n`` of a sorted set, and how many of them no other set has."""
        lower = s[:np.searchsorted(s, self.low)]
        common = _in_map(self.shared, lower)
        single = lower[~common][:n]
        if len(single) == n:
            return single, n
        rest = np.concatenate([s[len(lower):], lower[common]])
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, rest), len(self.keys) - 1)
            hot = self.keys[at] == rest
            last, counts = rest[hot], self.counts[at[hot]]
            rest = np.concatenate([rest[~hot], last[np.lexsort((last, counts))]])
        return np.concatenate([single, rest[:n - len(single)]]), len(single)


def _bit_map(places: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Bits set at the low bits of column ``p``, about 16 for each of ``n``
    values and at most MAP_BITS: a first sieve of bounded size, which lets some
    others through and none of the values out."""
    bits = min(MAP_BITS, 1 << max(16, (16 * n).bit_length()))
    cells = places.select(F.col("p").bitwiseAND(F.lit(bits - 1)).alias("p")).select(
        F.shiftright("p", 6).alias("cell"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
    table = cells.groupBy("cell").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[table["cell"].to_numpy()] = table["bit"].to_numpy().view(np.uint64)
    return out, bits


def _in_map(bit_map: tuple[np.ndarray, int], values: np.ndarray) -> np.ndarray:
    cells, bits = bit_map
    place = values.view(np.uint64) & np.uint64(bits - 1)
    return (cells[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def histogram(s: np.ndarray) -> bytes:
    """How many members fall into each of a power of two of equal parts of the
    hash space, about 8 a part. Two sets have at most the sum of the parts'
    smaller counts in common."""
    parts = 1 << max(4, (len(s) // 8).bit_length())
    counts = np.bincount((s >> np.uint64(64 - parts.bit_length() + 1)).astype(np.int64), minlength=parts)
    return counts.astype("<u2" if counts.max() < 1 << 16 else "<u4").tobytes()


def _counts(data: bytes, n: int) -> np.ndarray:
    parts = 1 << max(4, (n // 8).bit_length())
    return np.frombuffer(data, "<u2" if len(data) == 2 * parts else "<u4").astype(np.int64)


def may_link(a: bytes, na: int, b: bytes, nb: int, percent: int) -> bool:
    """Whether the histograms leave room for a link."""
    x, y = _counts(a, na), _counts(b, nb)
    while len(x) > len(y):
        x = x[0::2] + x[1::2]
    while len(y) > len(x):
        y = y[0::2] + y[1::2]
    return (100 + percent) * int(np.minimum(x, y).sum()) >= percent * (na + nb)


def _sift(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(column(batch, c).to_pylist() for c in ("ha", "na", "hb", "nb")))
            keep = pa.array([may_link(*r, percent) for r in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([column(batch, c).filter(keep) for c in ("ca", "cb")], ["ca", "cb"])
    return run


def _low_shingles(k: int, low: int):
    """The shingles below ``low`` of every distinct set, once each for some sets
    read together and twice if several of those have it."""
    low = np.uint64(low)

    def batch_of(found):
        parts = list(found.values())
        found.clear()
        u, c = counted(parts)
        return pa.RecordBatch.from_arrays([_signed(np.concatenate([u, u[c > 1]]))], ["shingle"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, waiting = {}, 0
        for batch in batches:
            for _, _, buf, offs in chunks(batch):
                for s in sets_of(buf, offs, k):
                    if len(s) and (key := digest(s)) not in found:
                        found[key] = s[:np.searchsorted(s, low)].copy()
                        waiting += len(found[key])
                if waiting >= COUNTED:
                    yield batch_of(found)
                    waiting = 0
        yield batch_of(found)
    return run


def _groups(sets: list[np.ndarray], order: Order, percent: int):
    """({(group, size): (prefix, how many of it are single)}, {(group, size,
    class, histogram)}) of a chunk."""
    prefixes, members = {}, set()
    for s in sets:
        if len(s):
            p, single = order.prefix(s, len(s) - -(-percent * len(s) // 100) + 1)
            gid = int.from_bytes(hashlib.blake2b(p.tobytes(), digest_size=8).digest(), "little", signed=True)
            prefixes[gid, len(s)] = p, single
            members.add((gid, len(s), digest(s), histogram(s)))
    return prefixes, members


def _postings(k: int, percent: int, order):
    """The groups' members, and their prefix shingles that others may have."""
    names = ["shingle", "gid", "n", "pos", "cid", "histogram"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, offs in chunks(batch):
                prefixes, members = _groups(sets_of(buf, offs, k), order.value, percent)
                size = [len(p) - single for p, single in prefixes.values()]
                rows = int(np.sum(size, dtype=np.int64))
                ids, ns = [g for g, _ in prefixes], [n for _, n in prefixes]
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate([np.zeros(0, np.uint64), *(p[i:] for p, i in prefixes.values())])),
                     pa.array(np.repeat(np.array(ids, np.int64), size)), pa.array(np.repeat(np.array(ns, np.int32), size)),
                     pa.array(np.concatenate([np.zeros(0, np.int64),
                                              *(np.arange(i, len(p)) for p, i in prefixes.values())]).astype(np.int32)),
                     pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary())], names)
                g, n, c, h = zip(*sorted(members)) if members else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(g), pa.int64()), pa.array(g, pa.int64()), pa.array(n, pa.int32()),
                     pa.nulls(len(g), pa.int32()), pa.array(c, pa.binary()), pa.array(h, pa.binary())], names)
    return run


def _sets(k: int, wanted):
    """Whole sets of the rows whose ``p`` passes the sieve."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_in_map(wanted.value, column(batch, "p").to_numpy())))
            for _, _, buf, offs in chunks(batch):
                found = {digest(s): s.tobytes() for s in sets_of(buf, offs, k) if len(s)}
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()),
                                                  pa.array(list(found.values()), pa.binary())], ["cid", "members"])
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (a, b) in enumerate(zip(column(batch, "sa"), column(batch, "sb"))):
                x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([column(batch, "ca").filter(mask), column(batch, "cb").filter(mask)],
                                             ["ca", "cb"])
    return run


def _bounds(percent: int) -> str:
    """Size and position bounds of a pair with na <= nb."""
    return (f"100L * na >= {percent}L * nb "
            f"and {100 + percent}L * least(na - pa, nb - pb) >= {percent}L * (na + nb)")


def _stars(postings: DataFrame, percent: int) -> DataFrame:
    """Group pairs (ga, gb): in every list and size band, each group of another
    component with the leader, a group of the largest component there; and the
    leaders of neighbouring bands. As many pairs as list entries at most."""
    entry = F.struct("size", F.xxhash64("gid").alias("h"), "gid", "n", "pos", "comp")
    leaders = stored(postings.groupBy("shingle", "band").agg(F.max(entry).alias("l"), F.min("comp").alias("lo"),
                                                             F.max("comp").alias("hi")), "leaders")
    mixed = leaders.where("lo <> hi").select("shingle", "band", "l")
    inside = postings.join(mixed, ["shingle", "band"]).where("comp <> l.comp").select(
        "gid", "n", "pos", F.col("l.gid").alias("lg"), F.col("l.n").alias("ln"), F.col("l.pos").alias("lp"))
    above = leaders.select("shingle", (F.col("band") - 1).alias("band"), F.col("l").alias("u"))
    across = leaders.join(above, ["shingle", "band"]).where("l.comp <> u.comp").select(
        F.col("l.gid").alias("gid"), F.col("l.n").alias("n"), F.col("l.pos").alias("pos"),
        F.col("u.gid").alias("lg"), F.col("u.n").alias("ln"), F.col("u.pos").alias("lp"))
    swap = F.col("n") > F.col("ln")
    pick = lambda a, b, name: F.when(swap, F.col(b)).otherwise(F.col(a)).alias(name)              # noqa: E731
    return (inside.unionByName(across)
            .select(pick("gid", "lg", "ga"), pick("lg", "gid", "gb"), pick("n", "ln", "na"), pick("ln", "n", "nb"),
                    pick("pos", "lp", "pa"), pick("lp", "pos", "pb"))
            .where(_bounds(percent)).select("ga", "na", "gb", "nb").distinct())


def _candidates(postings: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (ga, na, xa, gb, nb, xb), na <= nb, of groups' parts in
    different components xa and xb that share a prefix shingle within the
    bounds. Lists that hold one component are left out first."""
    spread = postings.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")) \
        .where("lo <> hi").select("shingle")
    postings = stored(postings.join(spread, "shingle", "left_semi"), "spread-lists")
    listed = postings.groupBy("gid", "n", "comp", "band").agg(
        F.sort_array(F.collect_list(F.struct("pos", "shingle"))).alias("l"))
    listed = listed.select("gid", "n", "comp", "band", F.expr(f"transform(slice(l, 1, {SEEN}), x -> x.shingle)").alias("early"),
                           F.posexplode("l").alias("i", "x"))
    rows = listed.select("gid", "n", "comp", F.col("x.shingle").alias("shingle"), F.col("x.pos").alias("pos"),
                         F.expr(f"slice(early, 1, least(i, {SEEN}))").alias("before"), "band")
    a = rows.select("shingle", "band", F.col("gid").alias("ga"), F.col("n").alias("na"), F.col("comp").alias("xa"),
                    F.col("pos").alias("pa"), F.col("before").alias("ba"))
    near = F.array(F.col("band"), F.col("band") - 1)
    b = rows.select("shingle", F.explode(near).alias("band"), F.col("gid").alias("gb"), F.col("n").alias("nb"),
                    F.col("comp").alias("xb"), F.col("pos").alias("pb"), F.col("before").alias("bb"))
    return (a.join(b, ["shingle", "band"])
            .where(f"xa <> xb and (na < nb or (na = nb and xa < xb)) and {_bounds(percent)} and not arrays_overlap(ba, bb)")
            .select("ga", "na", "xa", "gb", "nb", "xb").distinct())


class _Join:
    """The passes over the documents that candidate pairs and links come from."""

    def __init__(self, documents: DataFrame, k: int, percent: int):
        if not 0 < percent <= 100 or k < 1:
            raise ValueError("percent must be in 1..100 and k positive")
        self.k, self.percent = k, percent
        self.docs = need(documents, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id",
                                                                 "cast(text as string) text")
        self.context = self.docs.sparkSession.sparkContext
        described = stored(self.docs.mapInArrow(
            _describe(k), "doc_id bigint, n bigint, cid binary, shingle bigint, df bigint"), "shingle-sets")
        self.rows = described.where("n is not null").select("doc_id", "n", "cid")
        self.classes = stored(self.rows.where("cid is not null").groupBy("cid").agg(
            F.min("doc_id").alias("first"), F.count("*").alias("copies")), "classes")
        # As Arrow the first of all are picked in a task; collected rows would be merged in the driver.
        hot = (described.where("shingle is not null").groupBy("shingle").agg(F.sum("df").alias("df"))
               .orderBy(F.desc("df"), "shingle").limit(HOT_SHINGLES).toArrow())
        self._lists((hot["shingle"].to_numpy(), hot["df"].to_numpy()))

    def _lists(self, hot: tuple[np.ndarray, np.ndarray]) -> None:
        texts, k, percent = self.docs.select("text"), self.k, self.percent
        low = int(min(0.9, COUNTED_SHARE * (1 - percent / 100) + 0.01) * 2 ** 64)
        # Bare shingles are moved; a task has each of them once or twice.
        shared = stored(texts.mapInArrow(_low_shingles(k, low), "shingle bigint").repartition("shingle")
                        .groupBy("shingle").count().where("count > 1").select("shingle"), "shared-shingles")
        order = self.context.broadcast(Order(hot, low, _bit_map(shared.select(F.col("shingle").alias("p")),
                                                                shared.count())))
        made = stored(texts.mapInArrow(_postings(k, percent, order),
                                       "shingle bigint, gid bigint, n int, pos int, cid binary, histogram binary"), "prefixes")
        found = made.where("cid is not null").select("gid", "n", "cid", "histogram").dropDuplicates(["cid"])
        self.described = stored(found, "groups")
        self.members = self.described.select("gid", "n", "cid")
        lists = stored(made.where("cid is null").select("shingle", "gid", "n", "pos").distinct(), "lists")
        # Two near copies share many shingles, whose lists hold the same groups: the
        # first of those lists in the global order is enough, as any pair in it meets
        # there first. Positions follow that order for every member alike.
        several = lists.groupBy("shingle").agg(
            F.min(F.struct("gid", "n", "pos")).alias("first"), F.max(F.struct("gid", "n")).alias("hi"),
            F.count("*").alias("size"), F.bit_xor(F.xxhash64("gid", "n")).alias("who")).where("size > 1")
        kept = several.groupBy("who", "size", "first.gid", "first.n", "hi").agg(
            F.min(F.struct("first.pos", "shingle")).alias("l")).select("l.shingle")
        band = F.floor(F.log("n") / math.log(100 / percent * 1.0001)) if percent < 100 else F.col("n")
        order.destroy()
        self.postings = stored(lists.join(kept, "shingle", "left_semi").withColumn("band", band.cast("int")), "postings")

    def parts(self, components: DataFrame) -> DataFrame:
        """gid, n, cid with its component and the component's size."""
        of = stored(self.classes.join(components, "cid", "left")
                    .select("cid", F.coalesce("root", "cid").alias("comp"), "copies"), "class-components")
        sizes = of.groupBy("comp").agg(F.sum("copies").alias("size"))
        return stored(self.members.join(of, "cid").join(sizes, "comp"), "parts")

    def star_pairs(self, parts: DataFrame) -> DataFrame:
        """Class pairs of the star rounds: a group stands for its class in the
        largest component; inside a group that class meets the other ones."""
        best = F.max(F.struct("size", "copies", "cid", "comp")).alias("rep")
        reps = parts.groupBy("gid", "n").agg(best).select("gid", "n", F.col("rep.cid").alias("rep"),
                                                          F.col("rep.comp").alias("comp"), F.col("rep.size").alias("size"))
        reps = stored(reps, "group-representatives")
        entries = stored(self.postings.join(reps.drop("rep"), ["gid", "n"]), "list-entries")
        groups = stored(_stars(entries, self.percent), "group-pairs")
        left = reps.select(F.col("gid").alias("ga"), F.col("n").alias("na"), F.col("rep").alias("ca"))
        right = reps.select(F.col("gid").alias("gb"), F.col("n").alias("nb"), F.col("rep").alias("cb"))
        across = groups.join(left, ["ga", "na"]).join(right, ["gb", "nb"]).select("ca", "cb")
        within = parts.select("gid", "n", "cid", F.col("comp").alias("own")).join(reps, ["gid", "n"]).where("own <> comp") \
            .select(F.col("rep").alias("ca"), F.col("cid").alias("cb"))
        return across.unionByName(within)

    def cross_pairs(self, parts: DataFrame) -> DataFrame:
        """All class pairs of different components that may still be linked."""
        spots = parts.select("gid", "n", "comp").distinct()
        entries = stored(self.postings.join(spots, ["gid", "n"]), "list-entries")
        groups = stored(_candidates(entries, self.percent), "group-pairs")
        m1 = parts.select(F.col("gid").alias("ga"), F.col("n").alias("na"), F.col("comp").alias("xa"),
                          F.col("cid").alias("ca"))
        m2 = parts.select(F.col("gid").alias("gb"), F.col("n").alias("nb"), F.col("comp").alias("xb"),
                          F.col("cid").alias("cb"))
        across = groups.join(m1, ["ga", "na", "xa"]).join(m2, ["gb", "nb", "xb"]).select("ca", "cb")
        within = m1.join(m2, (F.col("ga") == F.col("gb")) & (F.col("na") == F.col("nb")) & (F.col("xa") < F.col("xb"))) \
            .select("ca", "cb")
        return across.unionByName(within)

    def verified(self, pairs: DataFrame) -> DataFrame | None:
        """The linked pairs, None without any: first those whose histograms leave
        room for a link, then by whole sets; a class's set is taken from its first
        document."""
        pairs = stored(pairs.select(F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")).distinct(),
                       "candidate-pairs")
        if pairs.isEmpty():
            return None
        of = self.described
        ha = of.select(F.col("cid").alias("ca"), F.col("n").alias("na"), F.col("histogram").alias("ha"))
        hb = of.select(F.col("cid").alias("cb"), F.col("n").alias("nb"), F.col("histogram").alias("hb"))
        pairs = stored(pairs.join(ha, "ca").join(hb, "cb").select("ca", "cb", "na", "ha", "nb", "hb")
                       .mapInArrow(_sift(self.percent), "ca binary, cb binary"), "class-pairs")
        if pairs.isEmpty():
            return None
        paired = pairs.select(F.col("ca").alias("cid")).unionByName(pairs.select(F.col("cb").alias("cid"))).distinct()
        first = stored(self.classes.join(paired, "cid", "left_semi").select("cid", "first"), "wanted")
        wanted = self.context.broadcast(_bit_map(first.select(F.xxhash64("first").alias("p")), first.count()))
        sets = self.docs.select("text", F.xxhash64("doc_id").alias("p")).mapInArrow(_sets(self.k, wanted),
                                                                                   "cid binary, members binary")
        sets = sets.join(first.select("cid"), "cid", "left_semi").dropDuplicates(["cid"])
        sa, sb = sets.alias("sa"), sets.alias("sb")
        links = (pairs.join(sa, F.col("ca") == F.col("sa.cid")).select("ca", "cb", F.col("sa.members").alias("sa"))
                 .join(sb, F.col("cb") == F.col("sb.cid")).select("ca", "cb", "sa", F.col("sb.members").alias("sb"))
                 .mapInArrow(_verify(self.percent), "ca binary, cb binary"))
        linked = stored(links, "links")
        wanted.destroy()
        return None if linked.isEmpty() else linked


def jaccard_components(documents: DataFrame, k: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): doc_id, n and class digest (null: empty set) of every
    row; cid, first id and component root of every class."""
    join = _Join(documents, k, percent)
    components = join.classes.select("cid", F.col("cid").alias("root")).where("false")
    links, parts, last = None, join.parts(components), None
    for pairs in (*[join.star_pairs] * STAR_ROUNDS, join.cross_pairs):
        if parts is None:
            parts = join.parts(components)
        elif pairs == last:                # the same components: the same pairs again
            continue
        found, last = join.verified(pairs(parts)), pairs
        if found is not None:
            links, parts = found if links is None else links.unionByName(found), None
            components = connected_components(links, "ca", "cb").select(F.col("node").alias("cid"), "root")
    classes = join.classes.join(components, "cid", "left").select("cid", "first", F.coalesce("root", "cid").alias("root"))
    return join.rows, stored(classes, "components")


def near_duplicates(documents: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id (least id
    reachable by links, its own included)."""
    rows, classes = jaccard_components(documents, k, percent)
    names = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = classes.join(names, "root").select("cid", "component_id")
    some = rows.where("cid is not null").join(of_class, "cid")
    none = rows.where("cid is null").select("cid", "doc_id", "n", F.col("doc_id").alias("component_id"))
    return some.unionByName(none).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents less near copies: of each component the row with the least
    id stays (of rows with that id, all equal ones or, for different texts, all
    of them). Rows without a set, or without an id, stay."""
    found = near_duplicates(documents.select("doc_id", "text"), k, percent)
    drop = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_drop")).distinct()
    return documents.join(drop, documents["doc_id"].cast("bigint") == F.col("_drop"), "left_anti")
