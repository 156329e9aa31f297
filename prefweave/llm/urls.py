"""URL filters: rules, then host word segmentation and naive Bayes (operator 11).

Rules of a host (and its subdomains) and a path prefix decide first; the
longest that fits wins. For the other URLs, host names are split at everything
but letters, and each run of letters into words by unigram Viterbi. The word
counts are those of the pages themselves: the words of their html outside tags,
and the runs of letters in distinct hosts. A run of unknown letters of length n
costs ``ln(10 / N) - n ln 10``, N being all words counted. Multinomial naive
Bayes with one added to each count then scores the words of the host and the
tokens of the path (runs of letters, and one token for any number).

Nobody labels URLs here, so the labels are distant ones: a host counts as
``block`` if a word of it is in ``SEED_WORDS`` (a parameter), else as
``allow``; every page counts once. Other words that stand with them take over
their weight. No score but that of the tokens decides; ties are allowed.

All logarithms are integers (millionths), so that sums do not depend on their
order. Hosts, names, paths and words meet their counts in joins: no table that
grows with the pages is broadcast or collected, and what more than one in a
thousand rows share is joined apart from the rest (``joined_back``).

Edge cases: null URLs, or without ``://``, have an empty host and path, which
no rule fits and no token scores, so the prior decides; null html has no words;
repeated and null ids stay, a result for each row; a name may be of any length
(words are at most ``MAX_WORD`` letters); an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from prefweave.llm.tables import need, stored
from prefweave.llm.vectors import joined_back

# (verdict, host, path); fixed values of the query's contract.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Words that make a host an example of the block class.
SEED_WORDS = ("ads", "adult", "bets", "betting", "casino", "gambling", "malware", "phishing", "pills", "poker",
              "porn", "spam", "viagra", "warez", "xxx")
MAX_WORD = 24
UNIT = 1_000_000
NUMBER = "#"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#``; A-Z lower-cased)
    and path (then up to ``?``, ``#``); both empty without ``://``."""
    c = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.instr(c, "://")
    rest = F.when(at > 0, F.substring(c, at + 3, F.length(c))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_column(host, path, rules: Sequence[tuple[str, str, str]], field: str) -> Column:
    """``rule`` (host and path as one string) or ``verdict`` of the longest rule
    that fits, else null; of equally long ones a block, then the first by text."""
    out = F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    for verdict, rule_host, rule_path in reversed(ordered):
        fits = ((F.col(host) == rule_host) | F.col(host).endswith("." + rule_host)) & F.col(path).startswith(rule_path)
        out = F.when(fits, F.lit(verdict if field == "verdict" else rule_host + rule_path)).otherwise(out)
    return out


def letter_runs(text) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), 1)


def path_tokens(path) -> Column:
    """Runs of letters and, for each run of digits, ``#``; marked as of the path."""
    runs = F.regexp_extract_all(F.lower(path), F.lit(r"(\p{L}+|\p{Nd}+)"), 1)
    return F.transform(runs, lambda t: F.concat(F.lit("/"), F.when(t.rlike(r"^\p{Nd}"), NUMBER).otherwise(t)))


def millionths(x) -> Column:
    return F.round(F.log(x) * UNIT).cast("bigint")


def split_words(name: str, arcs: Sequence[tuple[int, int, int]], total: int) -> list[str]:
    """The likeliest words of a name. ``arcs``: start, end and weight of the
    known words in it. Best by weight, then by fewer words, then by the longer
    last word; two unknown runs never meet."""
    run, letter = round(math.log(10 / total) * UNIT) if total else -UNIT, -round(math.log(10) * UNIT)
    ending: dict[int, list[tuple[int, int]]] = {}
    for start, end, weight in arcs:
        ending.setdefault(end, []).append((start, weight))
    # By place: (weight, -words, start of the last word) of the best split that
    # ends in a known word, and of the best that ends in an unknown run.
    none = (-(1 << 62), 0, 0)
    known, unknown = [(0, 0, 0)], [none]
    for j in range(1, len(name) + 1):
        best = none
        for start, weight in ending.get(j, ()):
            before = max(known[start], unknown[start])
            best = max(best, (before[0] + weight, before[1] - 1, -start))
        known.append(best)
        opened = (known[j - 1][0] + run + letter, known[j - 1][1] - 1, -(j - 1))
        longer = (unknown[j - 1][0] + letter, unknown[j - 1][1], unknown[j - 1][2])
        unknown.append(max(opened, longer))
    words, j = [], len(name)
    while j:
        start = -max(known[j], unknown[j])[2]
        words.append(name[start:j])
        if max(known[j], unknown[j]) == unknown[j]:
            # What comes before an unknown run ends in a known word.
            j = start
            while j:
                at = -known[j][2]
                words.append(name[at:j])
                j = at
                if unknown[j] > known[j]:
                    break
        else:
            j = start
    return words[::-1]


def word_counts(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """Words of two to ``MAX_WORD`` letters with their counts: of the html
    outside tags, and the runs of letters of distinct hosts."""
    text = F.regexp_replace("html", r"<[^<>]*>", " ")
    words = pages.select(F.explode(letter_runs(text)).alias("word")).unionByName(
        hosts.select(F.explode(letter_runs("host")).alias("word")))
    return (words.where(F.length("word").between(2, MAX_WORD)).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_word")))


def segment(names: DataFrame, words: DataFrame) -> DataFrame:
    """name, words of distinct ``names`` by the counts of ``words``."""
    total = words.agg(F.sum("n_word")).first()[0] or 0
    n = F.length("name")
    starts = names.where(n >= 2).select("name", F.explode(F.sequence(F.lit(0), n - 2)).alias("start"))
    arcs = starts.select("name", "start", F.explode(F.sequence(
        F.lit(2), F.least(F.lit(MAX_WORD), n - F.col("start")))).alias("size")).select(
        "name", "start", "size", F.expr("substring(name, start + 1, size)").alias("word"))
    known = (arcs.join(words, "word").withColumn("weight", millionths(F.col("n_word") / F.lit(float(max(total, 1)))))
             .groupBy("name").agg(F.collect_list(F.struct(
                 "start", (F.col("start") + F.col("size")).alias("end"), "weight")).alias("arcs")))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [split_words(name, [(a["start"], a["end"], a["weight"]) for a in arcs or ()], total)
                     for name, arcs in zip(b["name"].to_pylist(), b["arcs"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["name"], pa.array(found, pa.list_(pa.string()))], ["name", "words"])

    return names.join(known, "name", "left").select("name", "arcs").mapInArrow(best, "name string, words array<string>")


def _weights(tokens: DataFrame) -> tuple[DataFrame, int]:
    """token, weight (of block over allow), n_rows; and the prior's weight, of
    rows (token, block, n) where n counts pages."""
    counts = tokens.groupBy("token").agg(F.sum(F.when(F.col("block"), F.col("n")).otherwise(0)).alias("b"),
                                         F.sum(F.when(F.col("block"), 0).otherwise(F.col("n"))).alias("a"),
                                         F.count(F.lit(1)).alias("n_rows"))
    all_b, all_a, distinct = counts.agg(F.sum("b"), F.sum("a"), F.count(F.lit(1))).first()
    b = (F.col("b") + 1) / F.lit(float((all_b or 0) + distinct or 1))
    a = (F.col("a") + 1) / F.lit(float((all_a or 0) + distinct or 1))
    return counts.select("token", "n_rows", (millionths(b) - millionths(a)).alias("weight"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
                seed_words: Sequence[str] = SEED_WORDS) -> DataFrame:
    """page_id, host, path, rule, verdict and score (log odds of block; null
    where a rule decides) of every row of ``pages`` (page_id, url, html)."""
    pages = need(pages, "page_id", "url", "html")
    host, path = url_parts("url")
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    pairs = stored(split.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")), "url-pairs")
    hosts = stored(pairs.groupBy("host").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_paths")), "url-hosts")

    words = stored(word_counts(pages.select("html"), hosts.select("host")), "url-words")
    in_hosts = hosts.select("host", "n", F.explode(letter_runs("host")).alias("name"))
    names = stored(in_hosts.groupBy("name").agg(F.count(F.lit(1)).alias("n_rows")), "url-names")
    segmented = segment(names.select("name"), words).join(names, "name")
    host_words = stored(joined_back(in_hosts, segmented, "name", "n_rows")
                        .select("host", "n", F.explode("words").alias("token")), "url-host-words")

    blocked = host_words.groupBy("host").agg(F.max(F.col("token").isin(*seed_words)).alias("block"))
    classes = stored(hosts.join(blocked, "host", "left").select(
        "host", "n", "n_paths", F.coalesce("block", F.lit(False)).alias("block")), "url-classes")
    of_host = joined_back(host_words.withColumn("token", F.concat(F.lit("."), "token")),
                          host_words.groupBy("host").agg(F.count(F.lit(1)).alias("n_rows"))
                          .join(classes.select("host", "block"), "host"), "host", "n_rows")
    labelled = joined_back(pairs, classes.select("host", "block", "n_paths"), "host", "n_paths")
    of_path = labelled.groupBy("path", "block").agg(F.sum("n").alias("n")).select(
        "path", "block", "n", F.explode(path_tokens("path")).alias("token"))
    weights = stored(_weights(of_host.select("token", "block", "n").unionByName(of_path.select("token", "block", "n"))),
                     "url-weights")
    sizes = {r["block"]: r["n"] for r in classes.groupBy("block").agg(F.sum("n").alias("n")).collect()}
    prior = round(math.log((sizes.get(True, 0) + 1) / (sizes.get(False, 0) + 1)) * UNIT)

    def scored(rows: DataFrame, key: str, name: str) -> DataFrame:
        """Sum of the tokens' weights by ``key``."""
        return joined_back(rows, weights, "token", "n_rows").groupBy(key).agg(F.sum("weight").alias(name))

    host_scores = hosts.select("host", "n").join(scored(of_host.select("host", "token"), "host", "host_score"), "host", "left")
    paths = pairs.groupBy("path").agg(F.sum("n").alias("n"))
    path_scores = paths.join(scored(paths.select("path", F.explode(path_tokens("path")).alias("token")),
                                    "path", "path_score"), "path", "left")
    judged = joined_back(joined_back(split, stored(host_scores, "url-host-scores"), "host", "n"),
                         stored(path_scores, "url-path-scores"), "path", "n")
    odds = F.lit(prior) + F.coalesce("host_score", F.lit(0)) + F.coalesce("path_score", F.lit(0))
    rule = rule_column("host", "path", rules, "rule")
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(rule_column("host", "path", rules, "verdict"),
                   F.when(odds > 0, "block").otherwise("allow")).alias("verdict"),
        F.when(rule.isNull(), odds / UNIT).alias("score"))
