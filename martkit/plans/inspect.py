"""Plan inspection helpers: read a DataFrame's physical plan as text.

Used by tests to assert plan properties (pushdown, pruning, no nested-loop or
Cartesian joins, no Python-evaluated expressions) and by users as a quick check.
"""

from __future__ import annotations

import contextlib
import io
import re
from collections import Counter

from pyspark.sql import DataFrame

# Physical operators that must not appear in a registered query's plan.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def operators(df: DataFrame) -> Counter:
    """Operator names of the physical plan tree (the formatted header section)."""
    text = plan_text(df)
    head = text.split("\n\n\n", 1)[0]
    names = re.findall(r"(?:\+-|:-|^)\s*\*?\s*([A-Z][A-Za-z]+)", head, flags=re.M)
    return Counter(names)


def scans(df: DataFrame) -> list[dict]:
    """Per Parquet scan: its location, pushed filters and read schema."""
    out = []
    for block in re.split(r"\n\(\d+\) ", plan_text(df)):
        if not block.startswith("Scan parquet"):
            continue
        info = {}
        for key in ("Location", "PushedFilters", "ReadSchema"):
            m = re.search(rf"^{key}: (.*)$", block, flags=re.M)
            info[key] = m.group(1) if m else ""
        out.append(info)
    return out


def forbidden_operators(df: DataFrame) -> list[str]:
    text = plan_text(df)
    return [op for op in FORBIDDEN if op in text]
