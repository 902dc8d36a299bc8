"""Canonical text of nested values: one text for one value, whatever engine or row order made it.

Objects have their keys sorted, numbers with a fraction have ``DIGITS`` decimals (no negative zero), texts are quoted with
backslash escapes of quote, backslash and line ends; null, true and false are themselves, NaN and infinity null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6
_ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"))


def _text(c: Column) -> Column:
    for plain, escaped in _ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit('"'), c, F.lit('"'))


def canonical(c: Column, kind: T.DataType) -> Column:
    """``c``, of type ``kind``, as text."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        parts = [F.concat(F.lit(f'"{f.name}":'), canonical(c.getField(f.name), f.dataType)) for f in fields]
        body = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        body = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: canonical(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        known = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c.cast("double"))
        body = F.round(known, DIGITS).cast(f"decimal(38,{DIGITS})").cast("string")
        body = F.when(body == "-0." + "0" * DIGITS, "0." + "0" * DIGITS).otherwise(body)
    elif isinstance(kind, T.StringType):
        body = _text(c)
    else:
        body = c.cast("string")
    return F.coalesce(F.when(c.isNotNull(), body), F.lit("null"))


def document(df: DataFrame, columns: list[str]) -> Column:
    """One object of ``columns`` of ``df`` as canonical text."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.concat(F.lit(f'"{c}":'), canonical(F.col(c), kinds[c])) for c in sorted(columns)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
