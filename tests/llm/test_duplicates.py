"""Jaccard join, line dedup, decontamination: brute force and edge cases."""

import itertools
import random
import re

import pytest

from prefweave.llm import decontaminate, linededup, ngram_join


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute_components(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("k,percent", [(4, 85), (2, 60)])
def test_components_equal_brute_force(docs, k, percent):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(0, 60))] for _ in range(20)]
    rows = []
    for i in range(160):
        b = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 5])):
            if b:
                b[rnd.randrange(len(b))] = rnd.choice(words).upper()
        rows.append((i, rnd.choice([" ", "\n\t"]).join(b) if rnd.random() < 0.97 else None))
    got = sorted(map(tuple, ngram_join.near_duplicates(docs(rows), k, percent).collect()))
    assert got == brute_components(rows, k, percent)


def test_histogram_bound_never_loses_a_link():
    import numpy as np
    rnd = np.random.default_rng(5)
    for n in (3, 40, 700, 5000):
        a = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[: int(0.95 * n)], rnd.integers(0, 1 << 63, max(1, n // 50), dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common):
            assert ngram_join.may_link(ngram_join.histogram(a), len(a), ngram_join.histogram(b), len(b), 85)


def test_join_edges(docs):
    assert ngram_join.near_duplicates(docs([])).count() == 0
    same = [(5, "a b"), (5, "a b"), (9, "A  B"), (1, None), (2, ""), (3, "x " * 50_000)]
    got = sorted(map(tuple, ngram_join.near_duplicates(docs(same)).collect()))
    assert got == [(1, 0, 1), (2, 0, 2), (3, 1, 3), (5, 1, 5), (5, 1, 5), (9, 1, 5)]
    kept = ngram_join.keep_one(docs(same))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 5] and kept.columns == docs([]).columns


def brute_repeats(rows, least):
    """Lines of runs that occur in an earlier text, by comparing all places."""
    lines = [[(x.strip(), len(x.split())) for x in (t or "").split("\n") if x.strip()] for _, t in rows]
    out = [set() for _ in rows]
    for y in range(len(rows)):
        for x in range(y):
            for i in range(len(lines[x])):
                for j in range(len(lines[y])):
                    n = words = 0
                    while i + n < len(lines[x]) and j + n < len(lines[y]) and lines[x][i + n] == lines[y][j + n]:
                        words += lines[x][i + n][1]
                        n += 1
                    if words >= least:
                        out[y].update(range(j, j + n))
    return out


def test_line_runs_equal_brute_force(docs):
    rnd = random.Random(5)
    pool = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))) for _ in range(40)]
    rows = [(i, "\n".join(rnd.sample(pool + ["", " "], rnd.randint(0, 12)))) for i in range(30)]
    for i in range(30, 60):                                             # cut-and-paste from earlier texts
        old = rows[rnd.randrange(30)][1].split("\n")
        a = rnd.randrange(len(old))
        rows.append((i, "\n".join([f"own {i}", *old[a:a + rnd.randint(1, 6)], f"end {i}"])))
    got = {r.doc_id: r for r in linededup.dedup_lines(docs(rows), 12).collect()}
    for i, want in enumerate(brute_repeats(rows, 12)):
        runs = [tuple(map(int, x.split("-"))) for x in got[i].removed.split(",") if x]
        assert {n for a, b in runs for n in range(a, b + 1)} == want, i
        kept = [x for n, x in enumerate(y for y in rows[i][1].split("\n") if y.strip()) if n not in want]
        assert [x for x in got[i].text.split("\n") if x.strip()] == kept


def test_a_short_line_of_many_texts_stays_once(docs):
    rows = [(i, f"own {i}\nread more here\nlast {i}") for i in range(25)]
    rows += [(24, rows[24][1]), (30, "read more here\nx\nread more here")]       # an equal row; twice in one text
    rows += [(100 + i, f"mine {i}\nseldom seen") for i in range(19)]
    got = linededup.dedup_lines(docs(rows)).collect()
    by = {r.doc_id: r for r in got}
    assert by[0].text == rows[0][1] and by[30].text == "x" and by[30].removed == "0-0,2-2"
    assert all(r.text == f"own {r.doc_id}\nlast {r.doc_id}" and r.removed == "1-1" for r in got if 0 < r.doc_id < 25)
    assert len(got) == len(rows) and all(r.n_removed == 0 for r in got if r.doc_id >= 100)
    few = linededup.dedup_lines(docs([(i, f"{i}\nread more here") for i in range(19)] + [(18, "18\nread more here")]))
    assert all(r.n_removed == 0 for r in few.collect())                             # equal rows are one text


def test_line_edges(docs):
    line = "one two three four five six seven eight"
    rows = [(1, None), (2, ""), (3, line), (3, line), (4, f"x\n{line}\ny"), (None, line), (5, f"{line}\n{line}\n{line}")]
    got = linededup.dedup_lines(docs(rows), 6).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[None][0].n_removed == 0                                  # a null id sorts first
    assert [r.n_removed for r in by[3]] == [1, 1] and by[4][0].text == "x\ny"
    assert by[5][0].text == "" and by[1][0].text is None and by[2][0].n_lines == 0
    out = linededup.without_repeats(docs(rows), 6)
    assert out.columns == docs([]).columns
    assert sorted((str(r.doc_id), r.n_chars) for r in out.collect()) == [("1", 0), ("2", 0), ("4", 3), ("None", len(line))]
    assert linededup.dedup_lines(docs([])).count() == 0
    clash = linededup.without_repeats(docs(rows).withColumnRenamed("score", "removed").withColumnRenamed("rid", "n_lines"), 6)
    assert {(r.removed, r.n_lines) for r in clash.collect()} == {("y", "x")}


def brute_cover(doc, item, k):
    """Greedy tiling by looking for the longest unmarked match each time."""
    d, i = (re.findall(r"[a-z0-9]+", x.lower()) for x in (doc, item))
    md, mi, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(d)):
            for b in range(len(i)):
                n = 0
                while (a + n < len(d) and b + n < len(i) and d[a + n] == i[b + n]
                       and a + n not in md and b + n not in mi):
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        if best[0] < k:
            return covered
        md.update(range(best[1], best[1] + best[0]))
        mi.update(range(best[2], best[2] + best[0]))
        covered += best[0]


def test_tiling_equals_brute_force(spark, docs):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(25)]
    items = [" ".join(rnd.choice(words) for _ in range(rnd.randint(3, 24))) for _ in range(15)]
    texts = []
    for _ in range(80):
        x = rnd.choice(items).split()
        cut = rnd.randrange(len(x) + 1)
        x = x[cut:] + ["filler"] * rnd.randint(0, 2) + x[:cut]            # reordered
        if rnd.random() < 0.5:
            x[rnd.randrange(len(x))] = "changed"
        texts.append("Some, " + (" " if rnd.random() < 0.7 else "\n").join(x) + ". end")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for block in (500_000, 20):                                         # one block, and several
        got = {(r.doc_id, r.item_id): r.n_covered for r in decontaminate.find_contamination(
            docs(list(enumerate(texts))), bench, 4, 0.7, block).collect()}
        want = {}
        for d, t in enumerate(texts):
            for i, item in enumerate(items):
                n, c = len(item.split()), brute_cover(t, item, 4)
                if n >= 4 and c >= 0.7 * n:
                    want[d, i] = c
        assert set(got) == set(want)


def test_contamination_edges(spark, docs):
    bench = spark.createDataFrame([(1, "a b c d e"), (2, None), (3, ""), (4, "a b"), (None, "v w x y z")],
                                  "item_id long, text string")
    d = docs([(1, None), (2, ""), (3, "A, b; c d e"), (3, "A, b; c d e"), (4, "v w x y z " * 5000), (5, "a b")])
    got = decontaminate.find_contamination(d, bench).collect()
    assert sorted((r.doc_id, str(r.item_id)) for r in got) == [(3, "1"), (3, "1"), (4, "None"), (5, "4")]
    kept = decontaminate.drop_contaminated(d, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2] and kept.columns == d.columns
    assert decontaminate.find_contamination(d, bench.where("false")).count() == 0
    assert decontaminate.find_contamination(docs([]), bench).count() == 0


def test_short_items_and_scripts_without_spaces(spark, docs):
    bench = spark.createDataFrame([(1, "Capital of France?"), (2, "\u4e2d\u56fd\u7684\u9996\u90fd\u662f\u54ea\u91cc\uff1f"),
                                   (3, "\u00c9T\u00c9 \u00c0 LA MER BLEUE"), (4, "Paris"), (4, "Paris"), (5, "?!"),
                                   (6, "\u0e01\u0e23\u0e38\u0e07\u0e40\u0e17\u0e1e")], "item_id long, text string")
    d = docs([(1, "A quiz. Capital of France? I know it"), (2, "The capital of France is not asked for"),
              (3, "\u554f\u984c\u3002\u4e2d\u56fd\u7684\u9996\u90fd\u662f\u54ea\u91cc\uff1f\u5317\u4eac"), (4, "\u00e9t\u00e9 \u00e0 la mer bleue"),
              (5, "I saw Paris last year"), (6, "one\nPARIS\ntwo"), (7, "capital\nof France"),
              (8, "x \u0e01\u0e23\u0e38\u0e07\u0e40\u0e17\u0e1e y"), (9, "\u4e2d\u56fd\u7684\u9996\u5bcc\u662f\u8c01\uff1f")])
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.find_contamination(d, bench).collect())
    assert got == [(1, 1), (3, 2), (4, 3), (6, 4), (6, 4), (8, 6)]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(d, bench).collect()) == [2, 5, 7, 9]


def test_repeated_items_are_held_once(spark, docs):
    bench = spark.createDataFrame([(1, "a b c d e f")] * 3000, "item_id long, text string")
    blocks = list(decontaminate._blocks(bench, 4, 0.7, 500_000))
    assert [b.ids for b in blocks] == [[1]] and blocks[0].copies == [3000]
    assert decontaminate.find_contamination(docs([(7, "x a b c d e f y")]), bench).count() == 3000


def test_components_of_odd_shapes(spark):
    from prefweave.llm.components import connected_components
    rng = random.Random(5)
    edges = [(i + 1, i) for i in range(40)] + [(100 + i, 100 + (i + 1) % 9) for i in range(9)]      # a chain, a ring
    edges += [(250, 200 + i) for i in range(30)] + [(300, 300), (301, None), (401, 400), (400, 401)]
    edges += [(rng.randrange(500, 600), rng.randrange(500, 600)) for _ in range(70)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    df = spark.createDataFrame(edges, "a long, b long")
    got = [(r.node, r.root) for r in connected_components(df, "a", "b").collect()]
    assert sorted(got) == sorted((x, find(x)) for x in root)
    assert connected_components(df.where("false"), "a", "b").count() == 0


def test_without_links_no_round_is_repeated(spark):
    # Every job costs the driver memory, however little it reads: 137 ran here
    # when rounds without pairs still looked for links and components.
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(40)],
                                 "doc_id long, text string")
    sc = spark.sparkContext
    sc.setJobGroup("no-links", "near duplicates of texts without links")
    try:
        got = ngram_join.near_duplicates(docs, 5, 80).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r.doc_id, r.component_id) for r in got) == [(i, i) for i in range(40)]
    n = len(sc.statusTracker().getJobIdsForGroup("no-links"))
    assert 20 < n < 100, n
