"""Tolerant readers for JSON text columns: bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLAGS_TYPE = T.ArrayType(
    T.StructType(
        [T.StructField("experiment_id", T.StringType()), T.StructField("variant", T.StringType())]
    )
)


def parse_object(text: str, keys: list[str]) -> Column:
    """Parse a JSON object once into a struct of string fields."""
    return F.from_json(F.col(text), T.StructType([T.StructField(k, T.StringType()) for k in keys]))


def scalar_field(parsed: str, text: str, key: str) -> Column:
    """A field of :func:`parse_object`, NULL when the JSON value is an object or array.

    A nested value arrives as its JSON text. Only values that look like one pay for the
    second look, which tells a real object from a string that starts with a brace.
    """
    value = F.col(f"{parsed}.{key}")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(F.col(text)), f"$.{key}", "variant"))
    plain = value.isNull() | ~F.substring(value, 1, 1).isin("{", "[")
    return F.when(plain, value).when(kind == "STRING", value)


def parse_flags(text: str) -> Column:
    """``[{"experiment_id": …, "variant": …}, …]`` as an array of structs.

    Elements are read one by one: what is not an object has NULL fields and leaves the others
    as they are, and so has a field that is an object or array.
    """
    elements = F.from_json(F.col(text), T.ArrayType(T.StringType()))

    def field(element: Column, key: str) -> Column:
        value = F.from_json(element, FLAGS_TYPE.elementType)[key]
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(element), f"$.{key}", "variant"))
        plain = value.isNull() | ~F.substring(value, 1, 1).isin("{", "[")
        return F.when(plain, value).when(kind == "STRING", value)

    names = FLAGS_TYPE.elementType.names
    return F.transform(elements, lambda e: F.struct(*(field(e, k).alias(k) for k in names)))
