"""Packing, tokenisation, nearest neighbours, pipeline."""

import math
import random
import zlib

import numpy as np

from prefweave.llm import ann, bpe, packing
from prefweave.llm.tables import read
from prefweave.llm.textarrays import chunks
from tests.conftest import SF001, SF01

ODD = ["", "a", " a", "a  b", "a \n b", "\n\n a", "it's he'll 's 't ''s I'm", "  ", "\t\tz", "日本語 ١٢٣ ½ x²", "é'll",
       "a　b", "'S 'LL", "\r\n x", "<|endoftext|> hi", "a'\nb", "'s's't", "😀's  😀", "x\x1c y\x85 z"]


def test_ids_equal_the_tokenizer():
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rnd = random.Random(1)
    parts = ["'", "s", "re", " ", "  ", "\n", "\t", "é", "1", "!", "ll", "Z", "😀", "ve", " "]
    texts = ODD + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(1500)]
    encoder = bpe.Encoder.of(bpe.default_vocabulary())
    for lo, hi, buf, offs in chunks(pa.record_batch([pa.array(texts)], ["text"]), most=4000):
        ids, rows = encoder.encode(buf, offs)
        for i in range(hi - lo):
            assert ids[rows[i]:rows[i + 1]].tolist() == t.encode(texts[lo + i], add_special_tokens=False).ids


def used(patterns, capacity):
    counts = [0] * (capacity + 1)
    for lengths, n in patterns:
        assert n > 0 and sum(lengths) <= capacity
        for v in lengths:
            counts[v] += n
    return counts


def optimum(sizes, capacity):
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for r in sorted({x for x in rooms if x >= sizes[i]}):
            rest = list(rooms)
            rest.remove(r)
            place(i + 1, rest + [r - sizes[i]])
        place(i + 1, rooms + [capacity - sizes[i]])

    place(0, [])
    return best


def test_solver_keeps_all_and_is_optimal_on_small_cases():
    rnd = random.Random(3)
    for _ in range(60):
        sizes = [rnd.randint(1, 20) for _ in range(rnd.randint(0, 9))]
        counts = [sizes.count(s) for s in range(21)]
        patterns, bound = packing.complete_bins(counts, 20)
        assert used(patterns, 20) == counts
        assert bound <= sum(n for _, n in patterns) == optimum(sizes, 20)


def every_filling(counts, room):
    sizes = [s for s in range(room, 0, -1) if counts[s]]

    def some(i, rest):
        if i == len(sizes):
            yield ()
            return
        for c in range(min(counts[sizes[i]], rest // sizes[i]) + 1):
            for tail in some(i + 1, rest - c * sizes[i]):
                yield (sizes[i],) * c + tail

    return list(some(0, room))


def covers(a, b):
    """Whether b's lengths can be dealt to a's as to rooms."""
    def deal(i, rooms):
        return i == len(b) or any(deal(i + 1, rooms[:j] + (r - b[i],) + rooms[j + 1:])
                                  for j, r in enumerate(rooms) if r >= b[i])
    return deal(0, tuple(a))


def test_fillings_are_the_undominated_ones():
    rnd = random.Random(5)
    for _ in range(200):
        room = rnd.randint(0, 22)
        counts = [0] * (room + 8)
        for _ in range(rnd.randint(1, 6)):
            counts[rnd.randint(1, room + 5)] += rnd.randint(1, 3)
        every = every_filling(counts, room)
        undominated = {b for b in every if not any(a != b and covers(a, b) for a in every)}
        got = list(packing.fillings(counts, room))
        assert len(got) == len(set(got)) and set(got) == undominated, (room, counts)
        assert [sum(f) for f in got] == sorted((sum(f) for f in got), reverse=True)
    counts = [0] * 501
    for s in (300, 200, 190, 180, 100):
        counts[s] = 1
    assert next(packing.fillings(counts, 500)) == (300, 200)


def test_steps_alone_end_the_search():
    counts = [0] * 1025
    for s in range(200, 700, 3):
        counts[s] = 1 + s % 7
    some, bound = packing.complete_bins(counts, 1024, nodes=10)
    more, _ = packing.complete_bins(counts, 1024, nodes=20_000)
    assert used(some, 1024) == used(more, 1024) == counts[:1025]
    assert bound <= sum(n for _, n in more) <= sum(n for _, n in some)


def test_many_equal_rows_are_packed_apart(spark, docs):
    rows = packing.pack(docs([(1, "a b c")] * 5000)).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 5000
    assert len({r.sequence_id for r in rows}) == math.ceil(5000 / (1024 // rows[0].length))


def test_pieces_and_places(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [(r.doc_id, r.text) for r in read(spark, SF001, "documents").collect()] + [(-1, None), (-2, ""), (-3, "a " * 3000)]
    rows = packing.pack(docs(texts)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for d, text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(by[d], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        assert all(r.length == 1024 for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= math.ceil(sum(r.length for r in rows) / 1024) + 2
    assert packing.pack(docs([])).count() == 0
    twice = packing.pack(docs([(1, "x"), (1, "x")])).collect()
    assert len({(r.sequence_id, r.offset) for r in twice}) == 2


def test_recall_and_exact_scores(spark):
    e = read(spark, SF01, "embeddings")
    got = ann.nearest_neighbours(e, e.where("vec_id % 20 = 0"), k=20, shard_rows=300).toPandas()
    rows = e.toPandas()
    x, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    hits = []
    for q, own in got.groupby("query_id"):
        own = own.sort_values("rank")
        scores = (x * x[ids == q][0]).sum(axis=1)
        scores[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]])
        hits.append(len(best & set(own.vec_id)) / 20)
        exact = dict(zip(ids, scores))
        assert list(own["rank"]) == list(range(1, 21)) and q not in set(own.vec_id)
        assert np.allclose([exact[v] for v in own.vec_id], own.score, atol=1e-12)
        assert list(zip(-own.score, own.vec_id)) == sorted(zip(-own.score, own.vec_id))
    assert len(hits) == 25 and np.mean(hits) >= 0.9


def test_search_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [2.0, 0.0]),
            (6, [2.0, 0.0]), (7, []), (8, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (9, [-1.0, 0.0]), (9, [-1.0, 0.0])]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, ann.nearest_neighbours(e, e.where("vec_id in (0, 1, 8)"), k=20).collect()))
    assert got == [(0, 1, 5, 2.0), (0, 2, 6, 2.0), (0, 3, 9, -1.0), (0, 4, 9, -1.0)]
    none = e.where("false")
    assert ann.nearest_neighbours(none, none).count() == 0


def test_every_row_of_a_repeated_id_counts(spark):
    """Copies and different vectors under one id against loops over the rows; an id
    that holds most rows, over several shards and blocks."""
    rng = np.random.default_rng(6)
    rows = [(int(i), rng.integers(-4, 5, 6).tolist()) for i in range(120)]
    rows += [(20, rng.integers(-4, 5, 6).tolist()) for _ in range(150)] + rows[:45] + [rows[40]] * 30
    rows = [(i, [float(c) for c in v]) for i, v in rows]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest_neighbours(e, e.where("vec_id % 20 = 0"), k=20, shard_rows=90, query_rows=50, share=1.0)
    expected = []
    for q, v in {(i, tuple(v)) for i, v in rows if i % 20 == 0 and any(v)}:
        others = [(i, w) for i, w in rows if any(w)]
        others.remove((q, list(v)))                                      # its own row, once
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in others)[:20]
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_pipeline_stages(spark):
    import corpus_pipeline
    d = read(spark, SF001, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_jaccard", "decontaminate", "pack"]
    docs = d.limit(60).unionByName(d.where("false"))
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF001)
        assert docs.columns == d.columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert out.select("doc_id").distinct().count() <= sizes[-1]


def test_large_finite_vectors_and_clashing_columns(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 16))
    ids = np.arange(600)
    for scale in (1e25, 1e-30, 1e200):
        rows = [(int(i), (v * scale).tolist(), 7, 0.5) for i, v in zip(ids, x)]
        e = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, score double")
        got = ann.nearest_neighbours(e, e.where("vec_id % 60 = 0"), k=5, shard_rows=200).toPandas()
        for q, own in got.groupby("query_id"):
            with np.errstate(over="ignore", invalid="ignore"):
                scores = (x * scale * (x[q] * scale)).sum(axis=1)
            scores[q] = -np.inf
            best = ids[np.lexsort((ids, -scores))[:5]]
            own = own.sort_values("rank")
            if scale == 1e200:
                assert np.isposinf(own.score).all() and len(own) == 5 and (x[own.vec_id] @ x[q] > 0).all()
            else:
                assert len(set(best) & set(own.vec_id)) >= 4 and np.allclose(scores[own.vec_id], own.score, rtol=1e-12)
