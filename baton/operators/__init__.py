"""Frame-level operators: row codec, conform, handover and diff."""

from baton.operators.conform import conform
from baton.operators.diff import LEFT_ONLY, RIGHT_ONLY, frame_diff, same_rows
from baton.operators.handover import (
    open_rdd_snapshot,
    rdd_to_frame,
    snapshot,
    snapshot_all,
    snapshot_async,
    snapshot_path,
    snapshot_rdd,
)
from baton.operators.rejects import conform_split, judge_rows
from baton.operators.rowcodec import decode_rows, encode_rows
from baton.operators.snapshot_diff import snapshot_diff

__all__ = [
    "LEFT_ONLY",
    "RIGHT_ONLY",
    "conform",
    "conform_split",
    "decode_rows",
    "encode_rows",
    "frame_diff",
    "judge_rows",
    "open_rdd_snapshot",
    "rdd_to_frame",
    "same_rows",
    "snapshot",
    "snapshot_all",
    "snapshot_async",
    "snapshot_diff",
    "snapshot_path",
    "snapshot_rdd",
]
