"""Sources: snapshots, saved text, catalog tables and files as a table."""

from baton.sources.files import file_sizes, list_files, read_files
from baton.sources.snapshot import open_snapshot, read_manifest
from baton.sources.tables import open_table, open_typed, open_typed_split
from baton.sources.text import open_text
from baton.sources.tree import read_ranges, walk_files

__all__ = [
    "file_sizes",
    "list_files",
    "open_snapshot",
    "open_table",
    "open_text",
    "open_typed",
    "open_typed_split",
    "read_files",
    "read_manifest",
    "read_ranges",
    "walk_files",
]
