"""baton: durable, lineage-cutting handover of Spark tables.

Write a frame (or an RDD) as a snapshot and get back a frame over the stored
rows; re-open saved text and catalog tables; conform rows to a declared
schema; query files as a table; check that two tables hold the same rows.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# The few per-row helpers (the RDD pickle codec) are shipped with the task
# by value, so executors need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from baton.functions import resolve_path
from baton.operators import (
    conform,
    conform_split,
    decode_rows,
    encode_rows,
    frame_diff,
    judge_rows,
    open_rdd_snapshot,
    rdd_to_frame,
    same_rows,
    snapshot,
    snapshot_all,
    snapshot_async,
    snapshot_diff,
    snapshot_path,
    snapshot_rdd,
)
from baton.sinks import hold_application, lease_snapshot, release_snapshot, save_text, sweep_snapshots, write_snapshot
from baton.sources import (
    file_sizes,
    list_files,
    open_snapshot,
    open_table,
    open_text,
    open_typed,
    open_typed_split,
    read_files,
    read_ranges,
    walk_files,
)

__all__ = [
    "conform",
    "conform_split",
    "decode_rows",
    "encode_rows",
    "file_sizes",
    "frame_diff",
    "hold_application",
    "judge_rows",
    "lease_snapshot",
    "list_files",
    "open_snapshot",
    "open_table",
    "open_text",
    "open_typed",
    "open_typed_split",
    "open_rdd_snapshot",
    "rdd_to_frame",
    "read_files",
    "read_ranges",
    "release_snapshot",
    "resolve_path",
    "same_rows",
    "save_text",
    "snapshot",
    "snapshot_all",
    "snapshot_async",
    "snapshot_diff",
    "snapshot_path",
    "snapshot_rdd",
    "sweep_snapshots",
    "walk_files",
    "write_snapshot",
]
