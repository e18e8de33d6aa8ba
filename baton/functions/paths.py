"""Path resolution as a column expression.

The rules are those of the Hadoop ``Path(parent, child)`` join: a child with a
scheme (and an absolute path or an authority) stands for itself, an absolute
child keeps the parent's scheme and authority, anything else is appended to the
parent.  Repeated slashes collapse, a trailing one goes, and ``.`` and ``..``
segments are removed where a segment before them allows it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A scheme is what stands before a colon in the first segment;
# an authority follows two slashes.
SCHEME = r"^([^/:]+:)"
AUTHORITY = r"^(//[^/]+)"
NO_AUTHORITY = r"^///+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _split(p: Column) -> tuple[Column, Column, Column]:
    """Scheme, authority and path of a column of paths."""
    scheme = F.regexp_extract(p, SCHEME, 1)
    rest = F.regexp_replace(p, SCHEME, "")
    rest = F.regexp_replace(rest, NO_AUTHORITY, "/")
    authority = F.regexp_extract(rest, AUTHORITY, 1)
    return scheme, authority, F.regexp_replace(rest, AUTHORITY, "")


def _normal(path: Column) -> Column:
    """A path without empty and dot segments; ``..`` stays only where nothing is above it."""
    def step(kept: Column, part: Column) -> Column:
        above = (F.size(kept) > 0) & (F.element_at(F.concat(F.array(F.lit("..")), kept), -1) != "..")
        return (F.when((part == "") | (part == "."), kept)
                .when((part == "..") & above, F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
                .otherwise(F.concat(kept, F.array(part))))

    kept = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    return F.concat(F.when(path.startswith("/"), F.lit("/")).otherwise(F.lit("")), F.array_join(kept, "/"))


def resolve_path(base, other) -> Column:
    """Resolve ``other`` against ``base``; both are columns or column names.

    An empty or NULL ``other`` gives ``base`` as it is, an empty ``base`` gives
    ``other``.  A scheme before a relative path (``file:x``) is an error.
    """
    b, o = _col(base), _col(other)
    b_scheme, b_authority, b_path = _split(b)
    o_scheme, o_authority, o_path = _split(o)
    bad = (o_scheme != "") & (o_authority == "") & ~o_path.startswith("/")
    own = F.concat(o_scheme, o_authority, _normal(o_path))
    placed = F.concat(b_scheme, F.when(o_authority != "", o_authority).otherwise(b_authority), _normal(o_path))
    joined = F.concat(b_scheme, b_authority, _normal(F.concat(b_path, F.lit("/"), o_path)))
    return (F.when(o.isNull() | (o == ""), b)
            .when(bad, F.raise_error(F.concat(F.lit("relative path with a scheme: "), o)).cast("string"))
            .when(o_scheme != "", own)
            .when(b == "", o)
            .when(o.startswith("/"), placed)
            .otherwise(joined))
