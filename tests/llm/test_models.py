"""Language and quality models: held-out accuracy and edge cases."""

from prefweave.llm import language, quality
from prefweave.llm.tables import read
from tests.conftest import SF01


def test_language_held_out_accuracy(spark):
    d = read(spark, SF01, "documents")
    rows = language.predict(d, language.learn(d, 60), keep=("lang",)).where("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.97


def test_language_edges(docs):
    rows = [(i, "the cat and the dog of the house", "en") for i in range(20)]
    rows += [(100 + i, "der hund und die katze im haus", "de") for i in range(20)]
    rows += [(200, None, "en"), (201, "123 !?", "en"), (202, "", None), (None, "the house and the dog", None),
             (203, "und die " * 60_000, None)]
    got = {r.doc_id: r for r in language.identify_languages(docs(rows)).collect()}
    assert [got[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and got[200].score == 0
    assert got[None].lang_pred == "en" and got[203].lang_pred == "de" and 0 <= got[203].score <= 1
    kept = language.keep_identified(docs(rows))
    assert kept.columns == docs([]).columns and kept.count() == len(rows) - 3
    assert language.identify_languages(docs([])).count() == 0
    unlabelled = language.identify_languages(docs([(1, "abc")])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]


def varied_text(seed, n_chars):
    """Words over one alphabet, letters drawn by the language's own pair table."""
    import random
    own, rnd = random.Random(seed), random.Random(n_chars)
    letters = "abcdefghijklmnopqrstuvwxyz"
    follow = {c: own.choices(letters, k=12) for c in letters}
    words, size = [], 0
    while size < n_chars:
        c = rnd.choice(letters)
        word = c
        for _ in range(rnd.randint(1, 9)):
            c = rnd.choice(follow[c]) if rnd.random() < 0.75 else rnd.choice(letters)
            word += c
        words.append(word)
        size += len(word) + 1
    return " ".join(words)


def test_a_long_varied_text_keeps_its_language(docs):
    names = ["en", "de", "es", "fr"]
    rows = [(100 * i + j, varied_text(i, 700 + 9 * j), lang) for i, lang in enumerate(names) for j in range(60)]
    rows += [(9000 + i, varied_text(i, 300_000), None) for i in range(4)]
    got = {r.doc_id: r for r in language.identify_languages(docs(rows)).collect()}
    assert [got[9000 + i].lang_pred for i in range(4)] == names
    assert min(got[9000 + i].score for i in range(4)) > 0.5
    assert language.keep_identified(docs(rows)).count() == len(rows)


def test_quality_held_out_accuracy(spark):
    d, labels = read(spark, SF01, "documents"), read(spark, SF01, "labels")
    rows = quality.score_quality(d, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40 and sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.95


def test_quality_blocks_give_the_same_score():
    """Passages made block by block are those of the whole texts, whatever the cut."""
    import random
    import numpy as np
    rnd = random.Random(4)
    texts = ["", "  ", " one", "x" * 900] + [
        rnd.choice(["", " ", "\n\n"]) + "".join("\u00e9w"[:rnd.randint(1, 2)] * rnd.randint(1, 9) + rnd.choice([" ", "\t", " \n"])
                                             for _ in range(n)) for n in (1, 47, 48, 49, 96, 97, 700, 2000)]
    rnd.shuffle(texts)
    data = [t.encode() for t in texts]
    buf, offs = np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in data])])
    x, first = quality.passage_features(buf, offs)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    network = quality.Network()
    whole = network.score(iter([(x, doc)]), len(texts))
    for most in (64, 500, 3000, 1 << 20):
        blocks = list(quality.passage_blocks(buf, offs, most))
        assert np.array_equal(np.concatenate([b[0] for b in blocks]), x)
        assert np.array_equal(np.concatenate([b[1] for b in blocks]), doc)
        assert np.allclose(network.score(iter(blocks), len(texts)), whole, atol=1e-12)


def attention_loss(network, bags, y, weight):
    """Log loss of gated attention, passage by passage with plain loops."""
    import math
    loss = 0.0
    for bag, label, share in zip(bags, y, weight):
        encoded, attention = [], []
        for x in bag:
            h = [math.tanh(v) for v in ((x - network.mean) * network.scale) @ network.encode + network.encode_b]
            t = [math.tanh(sum(h[i] * network.v[i][j] for i in range(len(h)))) for j in range(len(network.w))]
            g = [1 / (1 + math.exp(-sum(h[i] * network.u[i][j] for i in range(len(h))))) for j in range(len(network.w))]
            encoded.append(h)
            attention.append(math.exp(sum(w * a * b for w, a, b in zip(network.w, t, g))))
        pooled = [sum(a * h[i] for a, h in zip(attention, encoded)) / sum(attention) for i in range(len(network.head))]
        p = 1 / (1 + math.exp(-(sum(a * b for a, b in zip(pooled, network.head)) + network.head_b[0])))
        loss -= share * (label * math.log(p) + (1 - label) * math.log(1 - p))
    return loss


def test_quality_gradients_equal_differences():
    """Every parameter's gradient against differences of a loss written with loops."""
    import numpy as np
    rng = np.random.default_rng(3)
    network = quality.Network()
    network.mean, network.scale = rng.normal(size=quality.N_FEATURES), rng.uniform(0.5, 1.5, quality.N_FEATURES)
    bags = [rng.normal(size=(n, quality.N_FEATURES)) for n in (1, 5, 3)]
    first, y, weight = np.array([0, 1, 6, 9]), np.array([1, 0, 1]), np.array([0.25, 0.5, 0.25])
    got = network.gradients(np.concatenate(bags), first, y, weight)
    assert set(got) == set(network.NAMES)
    for name in network.NAMES:
        value = getattr(network, name)
        for place in rng.choice(value.size, min(value.size, 6), replace=False):
            at, step = np.unravel_index(place, value.shape), 1e-5
            value[at] += step
            high = attention_loss(network, bags, y, weight)
            value[at] -= 2 * step
            low = attention_loss(network, bags, y, weight)
            value[at] += step
            assert abs((high - low) / (2 * step) - got[name][at]) < 1e-6, name


def test_language_model_equals_dense_kernel_ridge():
    """Scores through the n-gram matrix against weighted kernel ridge solved in the
    dual, on the dense kernel of all texts through the landmarks."""
    import numpy as np
    texts = [(lang, varied_text(i, 150 + 7 * j)) for i, lang in enumerate(("en", "de", "fr")) for j in range(9 + 2 * i)]
    texts.sort()
    sets = [set(language.presence(t).tolist()) for _, t in texts]
    asked = [set(language.presence(varied_text(i, 333)).tolist()) for i in range(5)]
    marks = [i for i in range(len(texts)) if i % 3 == 0]

    def dense(left, right):
        return np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in right] for a in left])

    own = [sets[i] for i in marks]
    middle = np.linalg.pinv(dense(own, own), rcond=1e-6, hermitian=True)
    k_fit, k_ask = dense(sets, own) @ middle @ dense(own, sets), dense(asked, own) @ middle @ dense(own, sets)
    languages = sorted({lang for lang, _ in texts})
    y = [lang for lang, _ in texts]
    w = np.array([1 / y.count(v) for v in y])
    w /= w.mean()
    share = w / w.sum()
    target = np.array([[1.0 if v == c else -1.0 for c in languages] for v in y])
    mean = share @ target
    centred = k_fit - np.outer(np.ones(len(y)), share @ k_fit)
    centred -= np.outer(centred @ share, np.ones(len(y)))
    ask = k_ask - (share @ k_fit)[None, :]
    ask -= (ask @ share)[:, None]
    expected = mean + ask @ np.linalg.solve(centred + language.RIDGE * np.diag(1 / w), target - mean)

    def bits(buckets):
        flags = np.zeros(language.N_GRAMS, bool)
        flags[sorted(buckets)] = True
        return np.packbits(flags).tobytes()

    model = language.fit(y, dense(sets, own), [bits(s) for s in own])
    got = model.scores([np.array(sorted(s)) for s in asked])
    assert model.languages == languages and np.abs(got - expected).max() < 2e-3
    assert np.abs(expected).max() > 0.2


def test_quality_learns_from_long_texts(spark, docs):
    rows = [(i, ("good plain words in a line " * 1000) if i % 2 else "buy!!! 99 $$$ now " * 20) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs(rows), labels).collect()
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in got)


def test_quality_edges(spark, docs):
    d = docs([(1, None), (2, ""), (3, "word " * 100_000), (3, "word"), (None, "x")])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.score_quality(d, labels).collect()
    assert len(got) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in got)
    one = spark.createDataFrame([(3, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert all(r.score in (0.5, 1.0) for r in quality.score_quality(d, one).collect())
    assert quality.score_quality(docs([]), labels).count() == 0


def test_repeated_labelled_rows_and_many_languages(spark, docs):
    """17,000 copies of one row, an id with many texts, and 70 languages."""
    from pyspark.sql import functions as F
    d = docs([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de")])
    many = d.where("doc_id = 1").withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(17_000)))).drop("_i")
    texts = d.where("doc_id = 2").withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(2_000)))).withColumn(
        "text", F.concat("text", F.lit(" "), F.col("_i").cast("string"))).drop("_i")
    both = many.unionByName(texts)
    assert language.training_sample(both, 250).groupBy("lang").count().orderBy("lang").collect() == [("de", 250), ("en", 1)]
    got = language.identify_languages(both)
    assert got.groupBy("lang_pred").count().orderBy("lang_pred").collect() == [("de", 2_000), ("en", 17_000)]
    rows = [(1000 * i + j, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{k}" for k in range(j, j + 6)), f"l{i:02}")
            for i in range(70) for j in range(4)]
    found = language.identify_languages(docs(rows))
    assert found.select("lang_pred").distinct().count() > 64


def test_an_id_with_many_texts_has_no_more_than_the_bound(spark, docs):
    rows = [(1, f"word{i} and more words", None) for i in range(900)] + [(2, "other", None)]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    sample = quality.training_sample(docs(rows), labels, 100)
    assert {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()} == {1: 100, 0: 1}
