"""Reading raw values whose type is only known per record.

Raw feeds carry one VARIANT column per declared field: SQL NULL means the key was
absent, a variant null means it was present and null. The same functions accept
ordinary typed columns, where the type is known when the plan is made.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.functions.times import iso_instant

# Names under which violations report JSON types, and how the schema
# of a VARIANT of that type starts.
JSON_TYPES = {
    "str": ("STRING",),
    "int": ("BIGINT",),
    "float": ("DECIMAL", "DOUBLE", "FLOAT"),
    "bool": ("BOOLEAN",),
    "dict": ("OBJECT",),
    "list": ("ARRAY",),
}

_TYPED = (
    (T.BooleanType, "BOOLEAN"),
    (T.IntegralType, "BIGINT"),
    (T.FractionalType, "DOUBLE"),
    ((T.StructType, T.MapType), "OBJECT"),
    (T.ArrayType, "ARRAY"),
)


def is_variant(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.VariantType)


def read_as(df: DataFrame, name: str, type_name: str, strict: bool = False) -> Column:
    """The column as `type_name`; unreadable values become null, or raise if strict."""
    if is_variant(df, name):
        get = F.variant_get if strict else F.try_variant_get
        return get(F.col(name), "$", type_name)
    col = F.col(name)
    return col.cast(type_name) if strict else col.try_cast(type_name)


def text(df: DataFrame, name: str, strict: bool = False) -> Column:
    return read_as(df, name, "string", strict)


def number(df: DataFrame, name: str, strict: bool = False) -> Column:
    return read_as(df, name, "double", strict)


def instant(df: DataFrame, name: str, strict: bool = False) -> Column:
    """The column as a timestamp. Texts are read where they are ISO 8601 and in no other case."""
    if not is_variant(df, name) and not isinstance(df.schema[name].dataType, T.StringType):
        return read_as(df, name, "timestamp", strict)
    as_text = text(df, name)
    found = iso_instant(as_text)
    if is_variant(df, name):
        is_text = is_json(json_schema(df, name), "str")
        found = F.when(is_text, found).otherwise(read_as(df, name, "timestamp"))
    if strict:
        why = F.concat(F.lit("no ISO 8601 timestamp: "), as_text)
        found = F.coalesce(found, F.when(as_text.isNotNull(), F.raise_error(why).cast("timestamp")))
    return found


def json_schema(df: DataFrame, name: str) -> Column:
    """Schema of the value; null for an absent key, VOID for a JSON null."""
    col = F.col(name)
    if is_variant(df, name):
        return F.schema_of_variant(col)
    kind = df.schema[name].dataType
    known = next((label for types, label in _TYPED if isinstance(kind, types)), "STRING")
    return F.when(col.isNotNull(), F.lit(known))


def is_json(schema: Column, *names: str) -> Column:
    """Whether a schema is of one of the named JSON types; null for an absent key."""
    starts = [start for name in names for start in JSON_TYPES[name]]
    # Only these carry parameters after the type.
    tests = [
        F.startswith(schema, F.lit(start))
        if start in ("DECIMAL", "OBJECT", "ARRAY")
        else schema == start
        for start in starts
    ]
    return reduce(Column.__or__, tests)


def is_present(schema: Column) -> Column:
    """Whether there is a value other than null; never null."""
    return schema.isNotNull() & (schema != "VOID")


def truthy(df: DataFrame, name: str, schema: Column | None = None) -> Column:
    """False for absent, null, empty text, zero, false, {} and []; never null.

    `schema` is that of the value where it is at hand already.
    """
    schema = json_schema(df, name) if schema is None else schema
    as_text = text(df, name)
    value = (
        F.when(is_json(schema, "str"), as_text != "")
        .when(is_json(schema, "int", "float"), number(df, name) != 0)
        .when(is_json(schema, "bool"), as_text == "true")
        .when(is_json(schema, "dict", "list"), ~_container_text(df, name).isin("{}", "[]"))
    )
    return F.coalesce(value, F.lit(False))


def as_variant(df: DataFrame, name: str) -> Column:
    """The value with its type, whatever the type of the column."""
    if is_variant(df, name):
        return F.col(name)
    nested = isinstance(df.schema[name].dataType, (T.StructType, T.MapType, T.ArrayType))
    return F.to_variant_object(name) if nested else F.col(name).cast("variant")


def json_name(value: Column) -> Column:
    """Name of the JSON type of a VARIANT; null for an absent key and for a JSON null."""
    schema = F.schema_of_variant(value)
    name = F.lit(None).cast("string")
    for label in JSON_TYPES:
        name = F.when(is_json(schema, label), label).otherwise(name)
    return name


def shown(value: Column) -> Column:
    """A VARIANT as it appears in a violation message: texts quoted, others bare."""
    schema = F.schema_of_variant(value)
    plain = F.try_variant_get(value, "$", "string")
    return (
        F.when(is_json(schema, "str"), F.concat(F.lit("'"), plain, F.lit("'")))
        .when(is_json(schema, "bool"), F.initcap(plain))
        .otherwise(plain)
    )


def _container_text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    nested = isinstance(kind, (T.VariantType, T.StructType, T.MapType, T.ArrayType))
    return F.to_json(F.col(name)) if nested else F.col(name).cast("string")
