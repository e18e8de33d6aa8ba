"""Column-level functions: the row codec and path resolution."""

from baton.functions.codec import (
    CODECS,
    JSON_OPTIONS,
    check_json_schema,
    decode_json,
    decode_utf8,
    encode_json,
    encode_utf8,
)
from baton.functions.paths import resolve_path

__all__ = [
    "CODECS",
    "JSON_OPTIONS",
    "check_json_schema",
    "decode_json",
    "decode_utf8",
    "encode_json",
    "encode_utf8",
    "resolve_path",
]
