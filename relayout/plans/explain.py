"""Reading physical plans, for tests and for checking a plan by eye."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def scan_lines(df: DataFrame, key: str) -> list[str]:
    """The values of ``key`` (``PartitionFilters``, ``PushedFilters``, ``ReadSchema``) of every scan."""
    return re.findall(rf"^{key}: (.*)$", plan_text(df), flags=re.MULTILINE)


def exchanges(df: DataFrame) -> list[str]:
    """Every shuffle exchange of the physical plan (its partitioning and origin)."""
    return re.findall(r"Exchange (.*)$", plan_text(df, "simple"), flags=re.MULTILINE)
