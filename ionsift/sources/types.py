"""Column types of text tables, found from all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionsift.functions.text import PLAIN_NUMBER, to_number

# How a cell may look to be of a type. Narrow types come first; every long is a double, everything is text.
BOOLEAN_TOKENS = ("T", "F", "TRUE", "FALSE", "true", "false")
PLAIN_INTEGER = r"^[+-]?[0-9]{1,18}$"
PLAIN_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TYPES = ("boolean", "long", "double", "date", "text")


def _fits(cell: Column) -> dict[str, Column]:
    return {
        "boolean": cell.isin(*BOOLEAN_TOKENS),
        "long": cell.rlike(PLAIN_INTEGER),
        "double": cell.rlike(PLAIN_NUMBER),
        "date": cell.rlike(PLAIN_DATE) & cell.try_cast("date").isNotNull(),
    }


def inferred_types(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column``, ``type``, ``n_values``, ``n_missing``: the narrowest type that every value of a column fits.

    One aggregate over all rows, combined before its shuffle; a column has one counter a type. Blanks around a value do
    not count. A column without a value is boolean, the narrowest type; a table without rows gives such columns.
    """
    columns = columns or df.columns
    votes = []
    for i, c in enumerate(columns):
        cell = F.trim(F.col(f"`{c}`"))
        votes += [F.count(cell).alias(f"n{i}"), F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"m{i}")]
        votes += [F.count(F.when(~fit, 1)).alias(f"x{i}_{t}") for t, fit in _fits(cell).items()]
    counted = df.agg(*votes)
    rows = []
    for i, c in enumerate(columns):
        found = F.lit(TYPES[-1])
        for t in reversed(TYPES[:-1]):
            found = F.when(F.col(f"x{i}_{t}") == 0, F.lit(t)).otherwise(found)
        rows.append(F.struct(F.lit(c).alias("column"), found.alias("type"), F.col(f"n{i}").alias("n_values"), F.col(f"m{i}").alias("n_missing")))
    return counted.select(F.inline(F.array(*rows)))


def typed(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Text columns as the types given, or as those inferred from all rows; columns not named stay.

    A value that does not fit a given type becomes NULL.
    """
    if types is None:
        text = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
        # One row a column.
        types = {r["column"]: r["type"] for r in inferred_types(df, text).collect()} if text else {}
    return df.select(*[_cast(F.col(f"`{c}`"), types.get(c, "")).alias(c) for c in df.columns])


def _cast(cell: Column, to: str) -> Column:
    trimmed = F.trim(cell)
    if to == "boolean":
        return F.when(trimmed.isin(*BOOLEAN_TOKENS), F.upper(F.left(trimmed, F.lit(1))) == "T")
    if to == "long":
        return F.when(trimmed.rlike(PLAIN_INTEGER), trimmed.try_cast("long"))
    if to == "double":
        return to_number(cell)
    if to == "date":
        return F.when(trimmed.rlike(PLAIN_DATE), trimmed.try_cast("date"))
    return cell
