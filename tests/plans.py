"""Read a frame's physical plan."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan(df: DataFrame, mode: str = "simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def count(text: str, operator: str) -> int:
    """Occurrences of an operator at the start of its line's node."""
    return sum(line.lstrip(" :+-*(0123456789)").startswith(operator) for line in text.splitlines())
