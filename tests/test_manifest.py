"""Prepared rows per file: hits read nothing, growth reads only what is new."""

import os

import pytest
from pyspark.sql import functions as F

from prefweave.plans import catalog
from prefweave.plans.prepare import _file_table, label_files, prepare_files, prepare_preference_data
from prefweave.functions import templates as tpl
from prefweave.session import scratch_path
from tests.conftest import SF01


def local(path):
    return path.removeprefix("file:")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def stacked(parts):
    return {name: rows_of(df) for name, df in parts.items()}


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_growing_table_equals_a_cold_start(spark, fmt):
    path, root = scratch_path(spark, "test files+%20"), scratch_path(spark, "test-root")
    pairs = catalog.pairs(spark, SF01)
    for k in range(3):
        pairs.where(F.col("pair_id") % 3 == k).coalesce(1).write.mode("append").format(fmt).save(path)
        warm = prepare_files(spark, path, fmt=fmt, n_samples=20, root=root)
        cold = prepare_files(spark, path, fmt=fmt, n_samples=20, root=scratch_path(spark, "test-cold"))
        assert stacked(warm) == stacked(cold)
        assert sum(warm.counts.values()) == 20
        assert warm.counts["train"] == len(stacked(warm)["train"])
    seen = label_files(spark, path, fmt, root=root)
    assert (seen.files, seen.built) == (3, 0)
    direct = prepare_preference_data(spark, pairs, source="t", n_samples=20, root=root)
    assert stacked(direct) == stacked(warm) and direct.counts == warm.counts


def test_a_hit_opens_no_file(spark):
    """The files are spoilt behind the manifest's back, size and time kept."""
    path, root = scratch_path(spark, "test-spoilt"), scratch_path(spark, "test-root")
    catalog.pairs(spark, SF01).repartition(2).write.parquet(path)
    first = stacked(prepare_files(spark, path, n_samples=None, root=root))
    for name in os.listdir(local(path)):
        if name.startswith("part-"):
            full = os.path.join(local(path), name)
            at = os.stat(full)
            with open(full, "r+b") as f:
                f.write(b"\0" * at.st_size)
            os.utime(full, ns=(at.st_atime_ns, at.st_mtime_ns))
    again = prepare_files(spark, path, n_samples=None, root=root)
    assert stacked(again) == first


def test_changed_and_gone_files(spark):
    path, root = scratch_path(spark, "test-changed"), scratch_path(spark, "test-root")
    pairs = catalog.pairs(spark, SF01)
    for k in range(3):
        pairs.where(F.col("pair_id") % 3 == k).coalesce(1).write.parquet(f"{path}/part={k}")
    table = _file_table(spark, "parquet", tpl.ALTERNATING, tpl.FINAL_TURN, tpl.DEFAULT_SYSTEM_MESSAGE, root)
    assert table.refresh(path).built == 3 and table.collect_stale(path) == 0
    pairs.where("pair_id % 3 = 1 and pair_id < 50").coalesce(1).write.mode("overwrite").parquet(f"{path}/part=1")
    now = table.refresh(path)
    want = pairs.where("pair_id % 3 <> 1 or pair_id < 50").select("pair_id")
    assert (now.files, now.built) == (3, 1) and rows_of(now.rows.select("pair_id")) == rows_of(want)
    assert table.collect_stale(path) == 1 and table.collect_stale(path) == 0
    assert rows_of(table.refresh(path).rows.select("pair_id")) == rows_of(want)
    folders = [d for d, _, _ in os.walk(local(table.base)) if "_file=" in d]
    assert len(folders) == 3


def test_attempts_that_meet_count_once(spark):
    path, root = scratch_path(spark, "test-two"), scratch_path(spark, "test-root")
    catalog.pairs(spark, SF01).coalesce(1).write.parquet(path)
    table = _file_table(spark, "parquet", tpl.ALTERNATING, tpl.FINAL_TURN, tpl.DEFAULT_SYSTEM_MESSAGE, root)
    from prefweave.sources.manifest import list_files
    for _ in range(2):                       # two builders that saw the same listing
        table._build(list_files(spark, path).select("path", "file").collect())
    now = table.refresh(path)
    assert now.built == 0 and now.rows.count() == catalog.pairs(spark, SF01).count()
    assert table.collect_stale(path) == 1 and table.refresh(path).rows.count() == now.rows.count()


def test_empty_files_and_tables(spark):
    path, root = scratch_path(spark, "test-none"), scratch_path(spark, "test-root")
    catalog.pairs(spark, SF01).where("pair_id < 0").write.parquet(path)
    out = prepare_files(spark, path, n_samples=5, allow_fewer=True, root=root)
    assert {k: v.count() for k, v in out.items()} == {"train": 0, "test": 0, "quarantine": 0}
    assert label_files(spark, path, root=root).built == 0


def test_sample_search_runs_once_for_all_outcomes(spark, monkeypatch):
    from prefweave.operators import sampling
    calls = []
    real = sampling.cutoff
    monkeypatch.setattr(sampling, "cutoff", lambda *a, **k: calls.append(1) or real(*a, **k))
    root = scratch_path(spark, "test-once")
    out = prepare_preference_data(spark, catalog.pairs(spark, SF01), source="o", n_samples=60, root=root)
    assert len(calls) == 2                    # one for the sample, one for the split
    assert {k: v.count() for k, v in out.items()} == {
        "train": out.counts["train"], "test": out.counts["test"],
        "quarantine": sum(n for k, n in out.counts.items() if k not in ("train", "test"))}
    prepare_preference_data(spark, catalog.pairs(spark, SF01), source="o", n_samples=60, root=root)
    assert len(calls) == 2
