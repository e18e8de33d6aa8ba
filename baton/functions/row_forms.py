"""Column expressions that stand for a value in comparisons and hashes of whole rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def needs_form(dt: T.DataType) -> bool:
    """Whether ``dt`` holds a type Spark cannot group on as it is (map, variant), or whose
    grouping calls different values equal (float: 0.0 and -0.0)."""
    if isinstance(dt, (T.MapType, T.VariantType, T.FloatType, T.DoubleType)):
        return True
    if isinstance(dt, T.ArrayType):
        return needs_form(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(needs_form(f.dataType) for f in dt.fields)
    return False


def form(c: Column, dt: T.DataType) -> Column:
    """A value that is equal exactly for equal ``c``: floats tell zeros apart, maps are entries
    sorted by key, variants are their JSON text with the type of every leaf."""
    if not needs_form(dt):
        return c
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.struct(c.alias("value"), F.coalesce((c == 0) & (c.cast("string") == "-0.0"), F.lit(False)).alias("minus_zero"))
    if isinstance(dt, T.VariantType):
        return F.struct(F.to_json(c).alias("json"), F.schema_of_variant(c).alias("type"))
    if isinstance(dt, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            form(e["key"], dt.keyType).alias("key"), form(e["value"], dt.valueType).alias("value")))
        return F.array_sort(entries)
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: form(x, dt.elementType))
    fields = [form(c[f.name], f.dataType).alias(f"f{i}") for i, f in enumerate(dt.fields)]
    return F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*fields))


def shown(c: Column, dt: T.DataType) -> Column:
    """The value of a form: maps stay sorted entries, variants their JSON text."""
    if not needs_form(dt):
        return c
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.when(c["minus_zero"], F.lit("-0.0").cast(dt)).otherwise(c["value"])
    if isinstance(dt, T.VariantType):
        return c["json"]
    if isinstance(dt, T.MapType):
        return F.transform(c, lambda e: F.struct(shown(e["key"], dt.keyType).alias("key"), shown(e["value"], dt.valueType).alias("value")))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: shown(x, dt.elementType))
    fields = [shown(c[f"f{i}"], f.dataType).alias(f.name) for i, f in enumerate(dt.fields)]
    return F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*fields))


def plain(dt: T.DataType) -> str:
    """The type's name without nullability."""
    return dt.simpleString()


def renamed(dt: T.DataType) -> T.DataType:
    """The type with struct fields named by position, so that each can be picked by its name."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f"f{i}", renamed(f.dataType)) for i, f in enumerate(dt.fields)])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(renamed(dt.elementType))
    return dt


def hashed_whole(dt: T.DataType) -> bool:
    """Whether ``marked`` reaches every level of a form's type: not inside user-defined types."""
    if isinstance(dt, T.ArrayType):
        return hashed_whole(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(hashed_whole(f.dataType) for f in dt.fields)
    return not isinstance(dt, (T.UserDefinedType, T.MapType))


def marked(c: Column, dt: T.DataType) -> Column:
    """A form with a null flag or an array's size before each value, at every level: Spark's
    hashes skip nulls and run array elements together, so the bare values are ambiguous."""
    if isinstance(dt, T.ArrayType):
        return F.struct(F.when(c.isNull(), F.lit(-1)).otherwise(F.size(c)), F.transform(c, lambda x: marked(x, dt.elementType)))
    if isinstance(dt, T.StructType):
        return F.struct(c.isNull(), *[marked(c[f.name], f.dataType) for f in dt.fields])
    return F.struct(c.isNull(), c)
