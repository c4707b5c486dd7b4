"""What the text operators share: narrow views of a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift.session import settle

__all__ = ["documents", "let", "read_table", "restored", "settle", "texts"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id`` (long) and ``text`` (NULL becomes empty).

    Columns are addressed by position, so extra columns with clashing names do no harm. They are left out, or with
    ``carry`` go along as one struct ``rest``, whose fields are named by position.
    """
    at = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    columns = [
        F.col(f"_c{at[id_col]}").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"_c{at[text_col]}").cast("string"), F.lit("")).alias("text"),
    ]
    if carry:
        others = [i for i in range(len(df.columns)) if i not in (at[id_col], at[text_col])]
        columns.append(F.struct(F.lit(0).alias("none"), *[F.col(f"_c{i}").alias(f"f{i}") for i in others]).alias("rest"))
    return plain.select(*columns)


def restored(df: DataFrame, like: DataFrame, new: dict[str, Column]) -> DataFrame:
    """The columns of ``like`` from a carried ``rest``, with those in ``new`` replaced."""
    columns = {i: new[c] if c in new else F.col("rest")[f"f{i}"] for i, c in enumerate(like.columns)}
    return df.select(*[columns[i].cast(f.dataType).alias(f.name) for i, f in enumerate(like.schema.fields)])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(read_table(spark, sf_dir, "documents"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
