"""Plan properties of the registered queries, read from ``explain`` output."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if n != "preference_metric_log_stream"))
def test_no_cross_join_and_no_python(spark, name):
    plan = formatted(E.queries()[name](spark, SF001))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*)", plan)


def test_judge_and_scores_never_read_document_text(spark):
    for name in ("pairwise_matchups", "baseline_matchups", "pairwise_win_rates", "score_summary"):
        for rs in read_schemas(formatted(E.queries()[name](spark, SF001))):
            assert "text:" not in rs, (name, rs)


def test_baseline_filter_reaches_the_scan(spark):
    plan = formatted(E.queries()["baseline_matchups"](spark, SF001))
    assert "EqualTo(source,src0)" in plan


def test_sample_reads_only_the_key(spark):
    # The sample needs the key alone: the scan of the stored pairs reads one column.
    plan = formatted(E.queries()["sample_n"](spark, SF001))
    assert read_schemas(plan) and all(rs.startswith("struct<pair_id:bigint>") for rs in read_schemas(plan))


def test_metrics_read_only_needed_columns(spark):
    plan = formatted(E.queries()["preference_summary"](spark, SF001))
    assert all("label" not in rs for rs in read_schemas(plan))
