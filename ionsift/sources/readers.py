"""Reading delimited exports and lookup results."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift.functions.nulls import null_tokens
from ionsift.functions.text import column_name, to_number, unique_names
from ionsift.session import settle, settle_and_watch
from ionsift.sources import records

# File endings per delimiter (case matters).
TAB_FILE = r"\.(tsv|txt)$"
COMMA_FILE = r"\.csv$"


def delimiter(path: str) -> str:
    if re.search(TAB_FILE, path):
        return "\t"
    if re.search(COMMA_FILE, path):
        return ","
    raise ValueError(f"no reader for {path}: expected .tsv, .txt or .csv")


def _one_delimiter(paths: list[str]) -> str:
    seps = {delimiter(p) for p in paths}
    if len(seps) != 1:
        raise ValueError("files read together must have one delimiter")
    return seps.pop()


@dataclass
class Layout:
    """Files with one header: their records, column names, delimiter, and paths."""

    names: list[str]
    sep: str
    body: DataFrame  # source, block, at, record
    sources: list[str]

    def cells(self) -> DataFrame:
        """Every cell as text under its column's name, ``source``, and ``_bad`` (the record) if cells miss or are surplus."""
        parsed = self.body.select("source", records.parse(F.col("record"), len(self.names), self.sep).alias("c"))
        named = [F.col("c")[f"_{i}"].alias(n) for i, n in enumerate(self.names)]
        return parsed.select(*named, "source", F.col("c._bad").alias("_bad"))


def layouts(spark: SparkSession, paths: list[str], comments: str = records.COMMENT_LINES) -> list[Layout]:
    """The files by header: one entry for each delimiter and header. Paths may be patterns.

    First lines of all files come from one job; what reaches the driver is one header a file.
    """
    found = []
    by_sep: dict[str, list[str]] = {}
    for path in paths:
        by_sep.setdefault(delimiter(path), []).append(path)
    for sep, own in by_sep.items():
        rows, files = records.records(spark, own, sep, comments)
        header = settle(_headers(rows, files, sep))
        body = rows.join(header.select(*records.PLACE), records.PLACE, "left_anti")
        by_names: dict[tuple[str, ...], list[str]] = {}
        for r in header.select("names", "source").orderBy("source").collect():
            by_names.setdefault(tuple(r["names"]), []).append(r["source"])
        for names, sources in by_names.items():
            alike = header.where(F.col("names") == F.array(*[F.lit(n) for n in names])).select("source")
            some = body if len(by_names) == 1 else body.join(alike, "source", "left_semi")
            found.append(Layout(unique_names(list(names)), sep, some, sources))
    return found


def _headers(rows: DataFrame, files: DataFrame, sep: str) -> DataFrame:
    """Place and cells of the first record of every file that has one."""
    first = files.where("first IS NOT NULL").select("source", "first.*")
    # A header with a line break in a cell is a record of several lines.
    long = rows.join(first.where("f0 = 1").select(*records.PLACE), records.PLACE).select("source", "record")
    whole = first.join(long, "source", "left")
    text = F.regexp_replace(F.coalesce("record", "line"), "^\ufeff", "")
    count = F.regexp_count(_unquoted(text), F.lit(re.escape(sep))) + 1
    counted = settle(whole.select(*records.PLACE, text.alias("record"), count.alias("n")))
    most = counted.agg(F.max("n")).first()[0] or 1
    cells = records.parse(F.col("record"), most, sep)
    names = F.transform(F.array(*[cells[f"_{i}"] for i in range(most)]), lambda c: F.coalesce(c, F.lit("")))
    return counted.select(*records.PLACE, F.slice(names, 1, F.col("n")).alias("names"))


def _unquoted(record: Column) -> Column:
    """A record without what stands in quotes."""
    segments = F.split(record, records.QUOTE)
    return F.concat_ws("", F.filter(segments, lambda _, i: i % 2 == 0))


def read_cells(spark: SparkSession, paths: str | list[str], comments: str = records.COMMENT_LINES) -> DataFrame:
    """Files with one header as text columns, plus ``source`` and ``_bad``; cells as they stand in the file.

    Quoted cells may hold the delimiter, doubled quotes, line breaks and ``#``. Missing cells at the end of a record are
    NULL, surplus ones are dropped; ``_bad`` then holds the record.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    _one_delimiter(paths)
    found = layouts(spark, paths, comments)
    if len(found) != 1:
        raise ValueError("files read together must have one header" if found else f"no header in {', '.join(paths)}")
    return found[0].cells()


def read_table(spark: SparkSession, paths: str | list[str], comments: str = records.COMMENT_LINES) -> DataFrame:
    """Files with one header as text columns, no-value tokens as NULL, plus ``source``.

    Whole comment lines are skipped and a ``#`` inside a cell is kept; with ``TRAILING_COMMENTS`` a line ends at a ``#``
    that is not in quotes.
    """
    return _without_tokens(read_cells(spark, paths, comments))


def as_table(layout: Layout) -> DataFrame:
    """The files of a layout as text columns, no-value tokens as NULL, plus ``source``."""
    return _without_tokens(layout.cells())


def _without_tokens(cells: DataFrame) -> DataFrame:
    plain = cells.drop("_bad")
    return null_tokens(plain, [c for c in plain.columns if c != "source"])


def read_tables(spark: SparkSession, paths: list[str], comments: str = records.COMMENT_LINES) -> list[DataFrame]:
    """One table per distinct header: exports differ in their sample columns.

    Files that share a header are read by one scan.
    """
    return [as_table(x) for x in layouts(spark, paths, comments)]


def numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns to double; what is not a number becomes NULL."""
    wanted = set(columns)
    return df.select(*[to_number(F.col(f"`{c}`")).alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns])


def sanitise_columns(df: DataFrame) -> DataFrame:
    """Usable column names; those that become equal are told apart by a number, in the order of the columns."""
    return df.toDF(*unique_names([column_name(c) for c in df.columns]))


NO_VALUE = "-"


@dataclass
class Lookup:
    """Rows of a lookup result, and the records that were refused, with the reason and their number by reason."""

    rows: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def read_lookup(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A tab-delimited lookup result: ``-`` means no value, headers become plain names."""
    cells = read_cells(spark, paths, records.NO_COMMENTS).drop("_bad", "source")
    return sanitise_columns(cells.select(*[F.nullif(F.col(f"`{c}`"), F.lit(NO_VALUE)).alias(c) for c in cells.columns]))


def checked_lookup(spark: SparkSession, paths: str | list[str], number_columns: tuple[str, ...]) -> Lookup:
    """A lookup result with its numbers as numbers; records that don't fit are kept aside.

    A record is refused if it has more or fewer cells than the header (reason ``cells``), or a cell of ``number_columns`` (plain
    names) that is neither a number nor ``-`` nor empty (the column's name; the first such column counts). One scan
    parses, counts and writes; the two tables read what it wrote. ``source`` and ``record`` tell where a refused
    record stands and what it says.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    found = layouts(spark, paths, records.NO_COMMENTS)
    if len(found) != 1:
        raise ValueError("lookup results read together must have one header")
    layout = found[0]
    names = unique_names([column_name(c) for c in layout.names])
    missing = [c for c in number_columns if c not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} among {', '.join(names)}")
    parsed = layout.body.select("source", "record", records.parse(F.col("record"), len(names), layout.sep).alias("c"))
    text = {n: F.nullif(F.trim(F.col("c")[f"_{i}"]), F.lit("")) for i, n in enumerate(names)}
    value = {n: F.nullif(text[n], F.lit(NO_VALUE)) if n in number_columns else F.nullif(F.col("c")[f"_{i}"], F.lit(NO_VALUE)) for i, n in enumerate(names)}
    reason = F.when(F.col("c._bad").isNotNull(), F.lit("cells"))
    for n in number_columns:
        reason = reason.when(value[n].isNotNull() & to_number(value[n]).isNull(), F.lit(n))
    cells = [(to_number(value[n]) if n in number_columns else value[n]).alias(n) for n in names]
    kinds = ["cells", *number_columns]
    table, seen = settle_and_watch(
        parsed.select(F.struct(*cells).alias("row"), "source", "record", reason.alias("reason")),
        **{f"n{k}": F.count(F.when(F.col("reason") == kind, 1)) for k, kind in enumerate(kinds)},
    )
    counts = {kind: seen[f"n{k}"] for k, kind in enumerate(kinds) if seen[f"n{k}"]}
    return Lookup(
        table.where("reason IS NULL").select("row.*"), table.where("reason IS NOT NULL").select("source", "reason", "record"), counts
    )


def mode_in_name(name):
    """The mode between dollar signs in an old result file's name, NULL if there is none."""
    return F.nullif(F.regexp_extract(name, r"\$(.*)\$", 1), F.lit(""))


def name_without_mode(name):
    """An old result file's name with the mode taken out: equal for the files of a pair."""
    return F.regexp_replace(name, r"_\$(.*)\$_", "_")


def name_stem(name):
    """The part of a result file's name before its date."""
    return F.nullif(F.regexp_extract(name, r"^(.*)_[0-9]", 1), F.lit(""))


def old_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records of old result files (``source``, ``record``) with what their names say.

    The name is the last part of the path that holds a mode between dollar signs: of the file, or of the folder that holds
    its parts (after ``=`` if it is a partition). ``mode``, ``pair`` (equal for both modes of a pair) and ``stem`` are cut from it.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    parts = [x.body.select("source", "record") for x in layouts(spark, paths, records.NO_COMMENTS)]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    path = F.url_decode(F.regexp_replace("source", r"\+", "%2B"))
    named = F.filter(F.split(F.url_decode(path), "/"), lambda p: p.contains("$"))
    name = F.regexp_replace(F.element_at(F.when(F.size(named) > 0, named), -1), "^[^=$]*=", "")
    out = rows.withColumn("name", name)
    mode, pair, stem = (f(F.col("name")) for f in (mode_in_name, name_without_mode, name_stem))
    return out.withColumns({"mode": mode, "pair": pair, "stem": stem})
