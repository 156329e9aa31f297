"""URL filters: parts, rules, segmentation and naive Bayes against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from prefweave.llm import urls
from tests.conftest import SF01

SCHEMA = "page_id bigint, url string, html string, host string, n string, token string, name string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "a", "b", "c", "d") for i, u, h in rows], SCHEMA)


def plain_parts(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = re.split(r"[?#]", rest[cut:], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path


def plain_rule(host, path):
    fits = [(len(h + p), v, h + p) for v, h, p in urls.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else None


CASES = ["http://ORG/", "https://a.b.org", "http://a.org?x=/y", "http://example.org/es/1", "http://x.example.org/en/12#t",
         "http://example.org/en/21", "http://notexample.org/es/", "ftp://com/fr/", "http://a.com/fr", "http://a.com/de/x?y",
         "no scheme", "", None, "http://", "http:///es/", "x://y://z.org/", "http://Ünï.ORG/Ä", "http://u:p@h.com:80/fr/",
         "http://a.org#/", "http://com.net/fr/", "//a.org/", "http://.org/"]


def test_parts_and_rules(spark):
    df = pages(spark, [(i, u, None) for i, u in enumerate(CASES)])
    got = {r.page_id: r for r in urls.filter_urls(df).collect()}
    for i, url in enumerate(CASES):
        host, path = plain_parts(url)
        assert (got[i].host, got[i].path) == (host, path), url
        rule = plain_rule(host, path)
        assert got[i].rule == (rule and rule[1]), url
        if rule:
            assert got[i].verdict == rule[0] and got[i].score is None


def weight_of(name, cuts, known, run, letter):
    """Weight and words of one way to cut a name; None if two unknown words meet."""
    total, before, words = 0, True, [name[a:b] for a, b in zip(cuts, cuts[1:])]
    for w in words:
        if w in known:
            total, before = total + known[w], True
        elif not before:
            return None
        else:
            total, before = total + run + letter * len(w), False
    return total, -len(words)


@pytest.mark.parametrize("seed", range(60))
def test_split_is_the_best_of_all_splits(seed):
    rng = random.Random(seed)
    name = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
    subs = {name[i:j] for i in range(len(name)) for j in range(i + 2, len(name) + 1)}
    known = {w: -rng.randint(1, 30) * 100_000 for w in subs if rng.random() < 0.4}
    total = rng.choice([50, 5000])
    run, letter = round(math.log(10 / total) * urls.UNIT), -round(math.log(10) * urls.UNIT)
    arcs = [(i, j, known[name[i:j]]) for i in range(len(name)) for j in range(i + 2, len(name) + 1) if name[i:j] in known]
    words = urls.split_words(name, arcs, total)
    assert "".join(words) == name
    ways = [[0, *(k for k in range(1, len(name)) if mask >> (k - 1) & 1), len(name)] for mask in range(1 << (len(name) - 1))]
    best = max(w for w in (weight_of(name, c, known, run, letter) for c in ways) if w)
    cuts = [sum(map(len, words[:k])) for k in range(len(words) + 1)]
    assert weight_of(name, cuts, known, run, letter) == best


def test_concatenated_names_come_apart(spark):
    words = spark.createDataFrame([("cheap", 9), ("pills", 9), ("ill", 50), ("news", 30), ("the", 400)], "word string, n_word bigint")
    names = spark.createDataFrame([("cheappills",), ("thenews",), ("qqq",), ("x",), ("the" * 5000,)], "name string")
    got = {r["name"]: r["words"] for r in urls.segment(names, words).collect()}
    assert got["cheappills"] == ["cheap", "pills"] and got["thenews"] == ["the", "news"]
    assert got["qqq"] == ["qqq"] and got["x"] == ["x"] and got["the" * 5000] == ["the"] * 5000


def runs(text):
    """Runs of letters."""
    return "".join(c if c.isalpha() else " " for c in text.lower()).split()


def plain_verdicts(rows):
    """The whole method over (url, html) rows, in plain Python."""
    parts = [plain_parts(u) for u, _ in rows]
    hosts = sorted({h for h, _ in parts})
    counts = Counter(w for _, html in rows for w in runs(re.sub(r"<[^<>]*>", " ", html or "")))
    counts.update(w for h in hosts for w in runs(h))
    counts = {w: n for w, n in counts.items() if 2 <= len(w) <= urls.MAX_WORD}
    total = sum(counts.values())
    logs = {w: round(math.log(n / total) * urls.UNIT) for w, n in counts.items()}

    def words(name):
        arcs = [(i, j, logs[name[i:j]]) for i in range(len(name))
                for j in range(i + 2, min(len(name), i + urls.MAX_WORD) + 1) if name[i:j] in logs]
        return urls.split_words(name, arcs, total)

    host_words = {h: [w for name in runs(h) for w in words(name)] for h in hosts}
    block = {h: any(w in urls.SEED_WORDS for w in ws) for h, ws in host_words.items()}

    def tokens(host, path):
        found = re.findall(r"[^\W\d_]+|\d+", path.lower())
        return ["." + w for w in host_words[host]] + ["/" + ("#" if t[0].isdigit() else t) for t in found]

    seen = {True: Counter(), False: Counter()}
    for host, path in parts:
        seen[block[host]].update(tokens(host, path))
    distinct = len(set(seen[True]) | set(seen[False]))

    def weight(token):
        b, a = ((seen[c][token] + 1) / (seen[c].total() + distinct) for c in (True, False))
        return round(math.log(b) * urls.UNIT) - round(math.log(a) * urls.UNIT)

    n_block = sum(block[h] for h, _ in parts)
    prior = round(math.log((n_block + 1) / (len(parts) - n_block + 1)) * urls.UNIT)
    out = []
    for host, path in parts:
        rule, odds = plain_rule(host, path), prior + sum(weight(t) for t in tokens(host, path))
        out.append((host, path, rule and rule[1], rule[0] if rule else "block" if odds > 0 else "allow",
                    None if rule else odds / urls.UNIT))
    return out


def test_whole_method_equals_plain_python(spark):
    given = spark.read.parquet(f"{SF01}/pages.parquet").select("page_id", "url", "html").orderBy("page_id").collect()
    rows = [(r.url, r.html) for r in given] + [(None, None), ("no scheme", ""), (given[0].url, given[0].html),
                                               ("http://cheappillsnow.net/en/buy", "<p>cheap pills now"), ("http://x.net", None)]
    df = pages(spark, [(i, u, h) for i, (u, h) in enumerate(rows)]).repartition(6)
    got = {r.page_id: r for r in urls.filter_urls(df).collect()}
    assert len(got) == len(rows)
    for i, want in enumerate(plain_verdicts(rows)):
        r = got[i]
        assert (r.host, r.path, r.rule, r.verdict) == want[:4], (i, rows[i][0])
        assert (r.score is None) == (want[4] is None) and (want[4] is None or abs(r.score - want[4]) < 1e-4)


def test_spam_names_are_blocked_and_others_left_alone(spark):
    got = urls.filter_urls(spark.read.parquet(f"{SF01}/pages.parquet")).where("rule is null")
    spam = F.col("host").rlike("(pills|casino|bets|adult|spam|ads)")
    wrong = got.where((F.col("verdict") == "block") != spam)
    assert wrong.count() == 0 and got.where(spam).count() > 0


def test_empty_table_long_names_and_repeated_rows(spark):
    assert urls.filter_urls(pages(spark, [])).collect() == []
    long = "http://" + "cheap" * 4000 + ".net/" + "a1" * 50_000
    got = urls.filter_urls(pages(spark, [(1, long, "cheap " * 3), (1, long, None), (None, None, "<" * 100_000)])).collect()
    assert len(got) == 3 and sorted(len(r.path) for r in got) == [0, 100_001, 100_001]
