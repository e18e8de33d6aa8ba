"""Row-by-row comparison of two frames as multisets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton.functions.row_forms import form, hashed_whole, marked, plain, renamed, shown
from baton.operators.rowcodec import quote
from baton.sinks.snapshot import PARQUET, write_snapshot
from baton.sources.snapshot import read_snapshot

LEFT_ONLY = "left_only"
RIGHT_ONLY = "right_only"
_SIGN = "__baton_sign"
_N = "__baton_n"
_DIGEST = "__baton_digest"
_ROW = "__baton_row"
#: Bytes of rows that are shuffled as they are; their digests take 32.
NARROW = 64
#: Unequal digests (32 bytes each) that are broadcast; more are joined by a shuffle.
BROADCAST_DIGESTS = 200_000


def _fixed_width(dt: T.DataType) -> bool:
    """Whether a value takes eight bytes or fewer, whatever it is."""
    return isinstance(dt, (T.NumericType, T.BooleanType, T.DatetimeType, T.DayTimeIntervalType, T.YearMonthIntervalType)) and not (
        isinstance(dt, T.DecimalType) and dt.precision > 18)


def _digested(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with four independent 64-bit hashes of the whole row."""
    types = [renamed(df.schema[n].dataType) for n in names]
    row = F.struct(*[marked(quote(n).cast(dt), dt) for n, dt in zip(names, types)])
    hashes = [F.xxhash64(F.lit(i), F.col(_ROW), F.lit(i)).alias(f"h{i}") for i in range(4)]
    return df.withColumn(_ROW, row).withColumn(_DIGEST, F.struct(*hashes)).drop(_ROW)


def frame_diff(left: DataFrame, right: DataFrame, expand: bool = False, chunk_rows: int = 1 << 16,
               exact: bool = False, widen: bool = False) -> DataFrame:
    """Rows whose count differs between ``left`` and ``right``.

    Columns are matched by name and must have the same types, nested ones too:
    a value never equals one of another type.  ``widen=True`` compares columns
    of different types after Spark's own widening, where there is one.  Floats
    compare as values, with NaN equal to NaN and 0.0 different from -0.0; map
    columns come back as sorted entries and variant columns as JSON text.  The
    result has the columns plus ``side`` (``left_only`` / ``right_only``) and
    ``n``, how many more copies that side holds; it is empty exactly when the
    two are equal as multisets.  A column that is called ``side`` or ``n``
    itself comes back as ``left_side`` or ``left_n``, with more ``left_`` if
    that is taken too.

    Rows that take up to ``NARROW`` bytes by their types are counted as they
    are, in one pass.  Others are counted by a 256-bit digest first (four 64-bit hashes of the values
    with their null flags and array sizes at every level), so only digests are
    shuffled, copies combined before; this runs at once.  Then the
    rows whose digests are out of balance, and only those, are compared in
    full.  Two sides that differ by rows whose digests collide would be called
    equal: not to be expected by chance, but the hashes are no protection
    against someone who wants it.  ``exact=True`` compares all rows in full, as
    do columns of user-defined types, whose inner nulls cannot be flagged.
    ``expand=True`` emits one row per surplus copy; large surpluses are cut
    into ``chunk_rows`` pieces spread over tasks before they are exploded.
    """
    names = left.columns
    if len(set(names)) != len(names):
        raise ValueError("frame_diff: duplicate column names")
    if sorted(names) != sorted(right.columns):
        raise ValueError(f"frame_diff: columns differ: {names} vs {right.columns}")
    different = [f"{n}: {plain(left.schema[n].dataType)} vs {plain(right.schema[n].dataType)}" for n in names
                 if plain(left.schema[n].dataType) != plain(right.schema[n].dataType)]
    if different and not widen:
        raise TypeError(f"frame_diff: types differ ({'; '.join(different)}); conform one side or pass widen=True")
    if different:
        common = left.select(*[quote(n) for n in names]).limit(0).unionByName(right.limit(0)).schema
        left, right = (df.select(*[quote(n).cast(common[n].dataType).alias(n) for n in names]) for df in (left, right))
    types = {n: left.schema[n].dataType for n in names}
    inner = [f"c{i}" for i in range(len(names))]

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*[form(quote(n), types[n]).alias(c) for n, c in zip(names, inner)], F.lit(sign).alias(_SIGN))

    both = side(left, 1).unionByName(side(right, -1))
    narrow = len(names) * 8 <= NARROW and all(_fixed_width(types[n]) for n in names)
    if not exact and not narrow and all(hashed_whole(both.schema[c].dataType) for c in inner):
        unequal = (_digested(both, inner).groupBy(_DIGEST).agg(F.sum(_SIGN).alias(_N))
                   .where(F.col(_N) != 0).select(_DIGEST))
        path = write_snapshot(unequal, codec=PARQUET)
        unequal = read_snapshot(left.sparkSession, path, unequal.schema)
        count = unequal.count()
        if not count:
            both = both.where(F.lit(False))
        else:
            some = F.broadcast(unequal) if count <= BROADCAST_DIGESTS else unequal.hint("merge")
            both = _digested(both, inner).join(some, _DIGEST, "left_semi").drop(_DIGEST)
    net = both.groupBy(*inner).agg(F.sum(_SIGN).alias(_N)).where(F.col(_N) != 0)
    if expand:
        piece, take = F.col("__piece"), F.col("__take")
        net = (net.withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.abs(F.col(_N)) - 1) / chunk_rows))))
               .withColumn("__take", F.least(F.lit(chunk_rows), F.abs(F.col(_N)) - piece * chunk_rows))
               .repartition(F.xxhash64(*inner, piece))
               .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), take))))
    added = ["side"] if expand else ["side", "n"]
    taken = set(names) | set(added)
    labels = []
    for n in names:
        label = n
        if n in added:
            while label in taken:
                label = "left_" + label
            taken.add(label)
        labels.append(label)
    out = [shown(F.col(c), types[n]).alias(label) for c, n, label in zip(inner, names, labels)]
    out.append(F.when(F.col(_N) > 0, F.lit(LEFT_ONLY)).otherwise(F.lit(RIGHT_ONLY)).alias("side"))
    return net.select(*out, *([] if expand else [F.abs(F.col(_N)).alias("n")]))


def same_rows(left: DataFrame, right: DataFrame, exact: bool = False) -> bool:
    """Whether the two frames hold the same rows the same number of times."""
    return frame_diff(left, right, exact=exact).isEmpty()
