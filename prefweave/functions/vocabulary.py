"""A tokenizer with a vocabulary file for the tokenizer hook.

The file goes to the shared folder and from there to every executor
(``SparkContext.addFile``); a Python worker opens it at its first batch and keeps
it. The same path serves any tokenizer that is loaded from a file.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from prefweave.session import scratch_path

WORD = r"[^ \t\n\x0B\f\r]+"      # the same in Java, Python and RE2
_WORD = re.compile(WORD)
_loaded: dict[tuple[str, ...], frozenset[str]] = {}


def words_of_files(names: tuple[str, ...]) -> frozenset[str]:
    """The words of a sent vocabulary, read once per worker."""
    if names not in _loaded:
        words: set[str] = set()
        for name in names:
            with open(SparkFiles.get(name), encoding="utf-8", newline="\n") as lines:
                words.update(line.rstrip("\n") for line in lines)
        _loaded[names] = frozenset(words)
    return _loaded[names]


def tokenize(text: str, words: frozenset[str]) -> list[str]:
    """Words of the vocabulary whole, others cut into characters."""
    return [t for w in _WORD.findall(text) for t in ([w] if w in words else w)]


def send(spark: SparkSession, words: DataFrame) -> Callable[[list[str]], list[list[str]]]:
    """Write the vocabulary (one column of words, without line ends), send it to
    the executors, and return a batched tokenizer for ``token_count``. A
    vocabulary is held whole by every worker: it must be of a bounded size. Its
    file is sent, not its folder: a cluster takes no folder from a local disk."""
    path = scratch_path(spark, "vocabulary")
    words.coalesce(1).write.text(path)
    files = sorted(spark.read.text(path).inputFiles())
    for file in files:
        spark.sparkContext.addFile(file)
    names = tuple(file.rsplit("/", 1)[-1] for file in files)
    return lambda texts: [tokenize(t, words_of_files(names)) for t in texts]
