"""Column builders: canonical forms, display texts, ids, hashes, verdicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the result tables.
NULL_TEXT = "NULL"
EMPTY_TEXT = "<empty>"
NULL_MARK = "__NULL__"
HASH_SEPARATOR = "§"
ONLY_REF, ONLY_NEW, MATCH, NO_MATCH, EXACT = "ONLY_IN_REF", "ONLY_IN_NEW", "MATCH", "NO_MATCH", "EXACT_MATCH"
ALL_COLUMNS, ALL_MATCH = "ALL_COLUMNS", "ALL_MATCH"


def is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def key(column: Column, kind: T.DataType) -> Column:
    """A key column whose blank texts (spaces only) are null."""
    return F.when(F.trim(column.cast("string")) != "", column) if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)) else column


def canonical(column: Column, kind: T.DataType) -> Column:
    """The comparable, orderable form: JSON for nested values (maps by key), base64 for bytes, else the value."""
    if isinstance(kind, T.MapType):
        return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(column))))
    if is_nested(kind):
        return F.to_json(column)
    if isinstance(kind, T.BinaryType):
        return F.base64(column)
    return column


def comparable(column: Column, kind: T.DataType, target: T.DataType) -> Column:
    """NEW's column in the form of REF's type; a value that can't be cast is null."""
    if is_nested(target) or isinstance(target, T.BinaryType) or is_nested(kind):
        return canonical(column, kind).cast("string")
    return column if kind == target else column.try_cast(target)


def display(column: Column) -> Column:
    """`NULL`, `<empty>` for blank text, else the value as text."""
    text = column.cast("string")
    return F.when(text.isNull(), NULL_TEXT).when(F.trim(text) == "", EMPTY_TEXT).otherwise(text)


def composite_id(keys: list[Column]) -> Column:
    return F.concat_ws("_", *(F.coalesce(k.cast("string"), F.lit(NULL_TEXT)) for k in keys))


def row_text(column: Column, kind: T.DataType) -> Column:
    return F.coalesce(canonical(column, kind).cast("string"), F.lit(NULL_MARK))


def row_hash(texts: list[Column]) -> Column:
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *texts), 256)


def verdict(in_ref: Column, in_new: Column, ref: Column, new: Column) -> Column:
    return F.when(~in_ref, ONLY_NEW).when(~in_new, ONLY_REF).when(ref.eqNullSafe(new), MATCH).otherwise(NO_MATCH)


def percentage(numerator: Column, denominator: Column) -> Column:
    """`%.4f%%`, or `-` for a denominator of 0."""
    return F.when(denominator > 0, F.format_string("%.4f%%", numerator * 100.0 / denominator)).otherwise("-")
