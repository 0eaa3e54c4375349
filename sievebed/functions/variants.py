"""Types of values whose schema nobody gave, from the schemas Spark finds in variants."""

from __future__ import annotations

import re

from pyspark.sql.types import (
    ArrayType, DataType, DecimalType, DoubleType, FloatType, LongType, NullType, StringType, StructField, StructType, VariantType,
)

# A quoted name as it stands, or the variant schema's word for a struct.
_OBJECT = re.compile(r"`(?:[^`]|``)*`|\bOBJECT(?=<)")
_NUMBERS = (LongType, DoubleType, FloatType, DecimalType)
#: Whole numbers of more digits than a long holds stay decimals; all other decimals are read as doubles.
_LONG_DIGITS = 19


def variant_type(found: str) -> DataType:
    """Spark type of the text ``schema_of_variant_agg`` gives; of mixed values VARIANT, of nulls only VOID."""
    ddl = _OBJECT.sub(lambda match: match[0] if match[0][0] == "`" else "struct", found)
    return StructType.fromDDL(f"value {ddl}")["value"].dataType


def both(one: DataType, other: DataType) -> DataType:
    """A type for the values of two; VARIANT where there is none."""
    if one == other or isinstance(other, NullType):
        return one
    if isinstance(one, NullType):
        return other
    if isinstance(one, StructType) and isinstance(other, StructType):
        kinds = {field.name: field.dataType for field in one}
        for field in other:
            kinds[field.name] = both(kinds[field.name], field.dataType) if field.name in kinds else field.dataType
        return StructType([StructField(name, kinds[name]) for name in sorted(kinds)])
    if isinstance(one, ArrayType) and isinstance(other, ArrayType):
        return ArrayType(both(one.elementType, other.elementType))
    return DoubleType() if isinstance(one, _NUMBERS) and isinstance(other, _NUMBERS) else VariantType()


def readable(kind: DataType) -> DataType | None:
    """The type JSON inference would give: numbers with a point as doubles, nulls and mixed values as texts.

    None for structs without a field, and for arrays of those: they hold nothing.
    """
    if isinstance(kind, StructType):
        fields = [(field.name, readable(field.dataType)) for field in kind]
        kept = [StructField(name, own) for name, own in fields if own is not None]
        return StructType(kept) if kept else None
    if isinstance(kind, ArrayType):
        element = readable(kind.elementType)
        return None if element is None else ArrayType(element)
    if isinstance(kind, DecimalType):
        return kind if kind.scale == 0 and kind.precision > _LONG_DIGITS else DoubleType()
    return StringType() if isinstance(kind, NullType | VariantType) else kind
