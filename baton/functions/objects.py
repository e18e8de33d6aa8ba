"""Python objects in RDDs: the ``pickle`` codec, and the check of records against a schema.

The ``pickle`` codec runs per element inside RDD tasks: it is only for collections that have no
schema.  Loading a pickle runs code, so it is meant for snapshots written by
the same user, never for foreign data.
"""

from __future__ import annotations

import base64
import pickle

from pyspark.sql import Row


def pickle_line(obj) -> str:
    """One base64 line (no breaks) holding ``obj``."""
    return base64.b64encode(pickle.dumps(obj, protocol=pickle.HIGHEST_PROTOCOL)).decode("ascii")


def unpickle_line(line: str):
    """Inverse of :func:`pickle_line`; a blank or damaged line raises."""
    if not line:
        raise ValueError("pickle codec: blank line in snapshot")
    return pickle.loads(base64.b64decode(line, validate=True))


def same_fields(names: list[str]):
    """A check of one record against a schema's names: it may lack fields, but has no others."""
    known = set(names)

    def check(row):
        if isinstance(row, Row) and hasattr(row, "__fields__"):
            found = row.__fields__
            if [n for n in found if n not in known]:
                # a row is read by place if its names are others: that must fit in length
                if len(found) != len(names):
                    raise ValueError(f"the row's fields {list(found)} are not those of the schema {names}")
                return tuple(row)
            return tuple(row[n] if n in found else None for n in names)
        if isinstance(row, dict):
            extra = [n for n in row if n not in known]
            if extra:
                raise ValueError(f"fields {extra} are not in the schema {names}")
            return tuple(row.get(n) for n in names)
        if isinstance(row, (tuple, list)) and len(row) != len(names):
            raise ValueError(f"a record of {len(row)} fields for a schema of {len(names)}")
        return row

    return check
