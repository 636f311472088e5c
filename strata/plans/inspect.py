"""Plan inspection: the text of ``DataFrame.explain`` for assertions in tests and the bench."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def has_node(df: DataFrame, node: str, mode: str = "formatted") -> bool:
    return node in plan_text(df, mode)
