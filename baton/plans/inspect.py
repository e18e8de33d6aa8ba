"""Plan checks: what a frame reads, and its physical plan as text."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def input_paths(df: DataFrame) -> list[str]:
    """Files the frame's scans read (``DataFrame.inputFiles``)."""
    return list(df.inputFiles())


def reads_only(df: DataFrame, path: str) -> bool:
    """True when every file the frame reads lies under ``path``: the lineage
    is cut at the snapshot."""
    root = path.rstrip("/").split(":", 1)[-1].lstrip("/")
    files = input_paths(df)
    return bool(files) and all(f.split(":", 1)[-1].lstrip("/").startswith(root + "/") for f in files)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """``df.explain(mode)`` as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
