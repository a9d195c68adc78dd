"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """The column called exactly ``name``, dots and backticks included."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_type(kind: T.DataType) -> str:
    """A type as SQL has it, with field names of any kind."""
    if isinstance(kind, T.StructType):
        fields = (f"{quoted(f.name)}: {sql_type(f.dataType)}" for f in kind.fields)
        return f"STRUCT<{', '.join(fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{sql_type(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"MAP<{sql_type(kind.keyType)}, {sql_type(kind.valueType)}>"
    return kind.simpleString()


def op_is(op: Column, *codes: str) -> Column:
    """True when ``op`` is one of ``codes``, False otherwise; never NULL."""
    return F.coalesce(op.isin(*codes), F.lit(False))


def all_set(names: Iterable[str]) -> Column:
    """True when every named column has a value."""
    return reduce(lambda a, b: a & b, [named(n).isNotNull() for n in names])


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame, planned as such: it takes no tasks to compute."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*columns)


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> None:
    """Raise ``ValueError`` unless ``df`` has all ``names`` (exact case)."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing column(s) {missing}, found {df.columns}")


def resolved(df: DataFrame, names: Sequence[str], what: str) -> list[str]:
    """The columns of ``df`` that ``names`` mean, as SQL resolves names.

    Case counts only in a case-sensitive session. Raises ``ValueError`` for a
    name that means no column, or several.
    """
    same_case = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    out = []
    for name in names:
        fits = [c for c in df.columns if c == name]
        if not fits and not same_case:
            fits = [c for c in df.columns if c.lower() == name.lower()]
        if len(fits) != 1:
            raise ValueError(f"{what}: no one column {name!r} among {df.columns}")
        out += fits
    return out


def row_bytes(schema: T.StructType) -> Column:
    """Estimate of one row's size in memory, from its own values.

    Every field has an 8-byte slot; text, binary and nested values add
    their length.
    """
    size = F.lit(8 * (len(schema.fields) + 1)).cast("long")
    for field in schema.fields:
        col = named(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # Struct wrapping lets to_json take maps and arrays of any element.
            text = F.to_json(F.struct(col.alias("v")))
            size = size + 4 * F.coalesce(F.octet_length(text), F.lit(0))
        elif isinstance(field.dataType, T.DecimalType):
            size = size + 16
    return size
