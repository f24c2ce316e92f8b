"""Plans as text."""

from __future__ import annotations

import contextlib
import io


def plan_of(df, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def executed_plan(df) -> str:
    """The plan after the run, with what was decided at run time."""
    df.collect()
    return plan_of(df, "simple")
