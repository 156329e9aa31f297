"""Preference-loss expressions (sigmoid loss of Rafailov et al., 2023)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def neg_log_sigmoid(x: Column) -> Column:
    """-log(sigmoid(x)) without overflow: max(-x, 0) + log1p(exp(-|x|))."""
    return F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))
