"""Files that tasks read and write themselves, by byte ranges.

Spark's own sources hand a task whole files or whole splits.  What needs single ranges of a
file, or a file format of its own, goes through ``pyarrow.fs`` inside the tasks: local and
mounted folders, object stores, and HDFS where its native client is installed.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs

# Names of one store in Hadoop and in pyarrow.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "abfss": "abfss"}


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri`` and the path in it.  ``ValueError`` for a scheme that only
    Hadoop's file systems know."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", uri)
    if not scheme:
        return fs.LocalFileSystem(), uri
    if scheme[1] == "file":
        return fs.LocalFileSystem(), re.sub(r"^file:(//[^/]*(?=/))?", "", uri)
    known = _SCHEMES.get(scheme[1], scheme[1])
    try:
        return fs.FileSystem.from_uri(known + uri[scheme.end() - 1:])
    except pa.ArrowInvalid as e:
        raise ValueError(f"tasks cannot reach {scheme[1]}: {e}") from e


def open_input(uri: str) -> pa.NativeFile:
    """A file open for reads at any place."""
    store, path = filesystem(uri)
    return store.open_input_file(path)


def open_output(uri: str) -> pa.NativeFile:
    """A new file to write from its start; its folder is made where stores have folders."""
    store, path = filesystem(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path)


def delete_file(uri: str) -> None:
    """Delete one file, if it is there."""
    store, path = filesystem(uri)
    if store.get_file_info(path).type == fs.FileType.File:
        store.delete_file(path)
