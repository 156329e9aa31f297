"""Preference-data preparation, end to end (the data half of the training script).

read pairs -> seeded sample of N -> triplets (status gate) -> exact split ->
records in the shared folder -> read back.

Plan shape: the sample and the split each find their cutoff by counts of hash
prefixes (the driver sees only counts). Then one plan labels every sampled pair
with its outcome, the split or the status that bars it, and one job writes them
all, a folder each, counting as it writes. Training and length statistics read
plain files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from prefweave import constants as C
from prefweave.functions import templates as tpl
from prefweave.operators import triplets as tri
from prefweave.operators.lengths import with_token_lengths
from prefweave.operators.sampling import sample_n, split_column
from prefweave.operators.triplets import create_triplets, with_status
from prefweave.schemas import PAIR
from prefweave.sources.manifest import FileTable, PreparedFiles
from prefweave.sources.records import (
    Materialized, content_state, materialize, pair_key, read_records, write_records)

SPLITS = ("train", "test")
QUARANTINE = "quarantine"
STATUSES = (tri.NULL_CONVERSATION, tri.NO_ASSISTANT, tri.PREFIX_MISMATCH, tri.EMPTY_PROMPT, tri.SYSTEM_NOT_SUPPORTED,
            tpl.ROLES_NOT_ALTERNATING, tpl.UNSUPPORTED_ROLE, tpl.NULL_CONTENT)
TRIPLET_COLUMNS = ["pair_id", "prompt", "chosen", "rejected"]
LABELLED = T.StructType([T.StructField(c, T.LongType() if c == "pair_id" else T.StringType())
                         for c in ("pair_id", "status", "prompt", "chosen", "rejected")])
LENGTHS = T.StructType([
    T.StructField("pair_id", T.LongType()),
    T.StructField("prompt_len", T.LongType()),
    T.StructField("prompt_chosen_len", T.LongType()),
    T.StructField("prompt_rejected_len", T.LongType()),
])


def with_outcome(labelled: DataFrame, test_fraction: float, split_seed: int) -> DataFrame:
    """``labelled`` (pair_id, status, prompt, chosen, rejected) with ``outcome``:
    the split of an ok pair, else its status (P7, L3)."""
    split = split_column(labelled, test_fraction=test_fraction, seed=split_seed, column="_split",
                         among=F.col("status") == tri.OK)
    return split.select(*TRIPLET_COLUMNS, F.coalesce("_split", "status").alias("outcome"))


def _prepared(written: Materialized, quarantine_path: str | None) -> Materialized:
    """With the quarantined pairs next to the splits."""
    written[QUARANTINE] = written.others("pair_id").select("pair_id", F.col("outcome").alias("status"))
    if quarantine_path:
        write_records(written[QUARANTINE], quarantine_path, mode="overwrite")
    return written


def prepare_preference_data(spark: SparkSession, pairs: DataFrame, *, source: str,
                            n_samples: int | None = C.SAMPLE_SIZE,
                            sample_seed: int = 42, split_seed: int = 7,
                            test_fraction: float = C.TEST_FRACTION,
                            template: tpl.ChatTemplate = tpl.ALTERNATING,
                            final_turn: tpl.ChatTemplate | None = tpl.FINAL_TURN,
                            system_message: str = tpl.DEFAULT_SYSTEM_MESSAGE,
                            mode: str = "quarantine", allow_fewer: bool = False,
                            quarantine_path: str | None = None, state: str | None = None,
                            root: str | None = None, fmt: str = "json") -> Materialized:
    """``{"train": df, "test": df, "quarantine": df}``: the splits of
    ``pair_id, prompt, chosen, rejected``, and ``pair_id, status`` of the sampled
    pairs that are malformed (also written to ``quarantine_path``, if given), with
    ``counts`` of every outcome. In strict mode a malformed pair fails the job. An
    input with fewer than ``n_samples`` pairs is an error unless ``allow_fewer``.

    ``source`` is a label in the cache fingerprint, next to every parameter and
    the state of the pairs. Give ``state`` where something names the pairs' rows
    for certain (the state of their files); a complete earlier write is then
    found without reading any of them. Else one pass over the pairs finds it.
    """
    params = {"source": source, "n": n_samples, "sample_seed": sample_seed,
              "split_seed": split_seed, "test_fraction": test_fraction,
              "template": repr(template), "final_turn": repr(final_turn),
              "system_message": system_message, "mode": mode, "allow_fewer": allow_fewer,
              "input": content_state(pairs) if state is None else state}

    def build():
        sampled = pairs if n_samples is None else sample_n(pairs, n_samples, sample_seed, allow_fewer=allow_fewer)
        if mode == "strict":
            labelled = create_triplets(sampled, template, final_turn, system_message, mode=mode).withColumn(
                "status", F.lit(tri.OK))
        elif mode == "quarantine":
            labelled = with_status(sampled, template, final_turn, system_message)
        else:
            raise ValueError(f"unknown mode {mode!r}")
        return with_outcome(labelled, test_fraction, split_seed)

    return _prepared(materialize(spark, build, "preference", params, splits=SPLITS, split_col="outcome",
                                 root=root, fmt=fmt, count=SPLITS + STATUSES), quarantine_path)


def label_files(spark: SparkSession, path: str, fmt: str = "parquet",
                template: tpl.ChatTemplate = tpl.ALTERNATING,
                final_turn: tpl.ChatTemplate | None = tpl.FINAL_TURN,
                system_message: str = tpl.DEFAULT_SYSTEM_MESSAGE, root: str | None = None) -> PreparedFiles:
    """Status and triplet of every pair in the files under ``path``, kept per
    file: files that an earlier call has seen are not read again."""
    return _file_table(spark, fmt, template, final_turn, system_message, root).refresh(path)


def _file_table(spark: SparkSession, fmt: str, template: tpl.ChatTemplate, final_turn: tpl.ChatTemplate | None,
                system_message: str, root: str | None) -> FileTable:
    def read(paths: list[str]) -> DataFrame:
        rows = (read_records(spark, paths, PAIR) if fmt == "json"
                else spark.read.schema(PAIR).format(fmt).load(paths))
        return rows.withColumn("pair_id", F.coalesce("pair_id", pair_key()))

    params = {"fmt": fmt, "template": repr(template), "final_turn": repr(final_turn), "system_message": system_message}
    return FileTable(spark, read, lambda pairs: with_status(pairs, template, final_turn, system_message),
                     "labelled", params, LABELLED, root)


def prepare_files(spark: SparkSession, path: str, *, fmt: str = "parquet", n_samples: int | None = C.SAMPLE_SIZE,
                  sample_seed: int = 42, split_seed: int = 7, test_fraction: float = C.TEST_FRACTION,
                  template: tpl.ChatTemplate = tpl.ALTERNATING, final_turn: tpl.ChatTemplate | None = tpl.FINAL_TURN,
                  system_message: str = tpl.DEFAULT_SYSTEM_MESSAGE, allow_fewer: bool = False,
                  quarantine_path: str | None = None, root: str | None = None,
                  records: str = "json") -> Materialized:
    """``prepare_preference_data`` for pair files that come in over time.

    Pairs are checked and rendered once per file; sample and split, which depend
    on all pairs, are found anew from the kept keys and statuses when a file has
    come, gone or changed, and the records are read back from an earlier write
    when none has: then no pair is read at all.
    """
    labelled = label_files(spark, path, fmt, template, final_turn, system_message, root)
    params = {"files": labelled.state, "n": n_samples, "sample_seed": sample_seed, "split_seed": split_seed,
              "test_fraction": test_fraction, "allow_fewer": allow_fewer}

    def build():
        sampled = labelled.rows if n_samples is None else sample_n(
            labelled.rows, n_samples, sample_seed, allow_fewer=allow_fewer)
        return with_outcome(sampled, test_fraction, split_seed)

    return _prepared(materialize(spark, build, "preference-files", params, splits=SPLITS, split_col="outcome",
                                 root=root, fmt=records, count=SPLITS + STATUSES), quarantine_path)


def token_length_table(spark: SparkSession, splits: dict[str, DataFrame], *, source: str,
                       tokenizer=None, batched: bool = False, tokenizer_id: str | None = None,
                       root: str | None = None) -> DataFrame:
    """Token lengths of every split, computed once and kept as a narrow table.

    The reference tokenises each text for the percentile and again for the
    filter; here the three lengths per pair are written once (parquet, by
    split, under the shared folder) and statistics and filter both read them.
    Returns ``pair_id, split, prompt_len, prompt_chosen_len, prompt_rejected_len``.
    Splits that preparation wrote are known by their folder; others by one pass
    over their rows. A ``tokenizer`` needs a ``tokenizer_id`` that changes whenever its counts do.
    """
    if (tokenizer is None) != (tokenizer_id is None):
        raise ValueError("give tokenizer and tokenizer_id together")
    written = getattr(splits, "state", None)
    splits = {name: df for name, df in splits.items() if name != QUARANTINE}
    names = tuple(splits)

    def build():
        parts = [with_token_lengths(df, tokenizer, batched)
                 .select("pair_id", "prompt_len", "prompt_chosen_len", "prompt_rejected_len")
                 .withColumn("split", F.lit(name)) for name, df in splits.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    params = {"source": source, "tokenizer": tokenizer_id, "batched": batched,
              "splits": written or {name: content_state(df) for name, df in splits.items()}}
    tables = materialize(spark, build, "token-lengths", params, schema=LENGTHS, splits=names,
                         root=root, fmt="parquet")
    out = None
    for name in names:
        t = tables[name].withColumn("split", F.lit(name))
        out = t if out is None else out.unionByName(t)
    return out
