"""Writing result tables: a folder per kind, partitioned by run date, experiment and mode."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift.params import Params
from ionsift.plans.process import Processed

# Folder names of the result kinds.
RAW_FLAGGED, FILTERED, FILTERED_WIDE = "raw_flagged", "filtered", "filtered_wide"


# Rows of one file at most, so that no reader of a result meets a file that one task can't take.
ROWS_PER_FILE = 1_000_000


def write_table(
    df: DataFrame,
    root: str,
    kind: str,
    run_date: datetime.date | None = None,
    fmt: str = "csv",
    null_text: str = "",
    mode: str = "errorifexists",
    sort_by: list[str] | None = None,
) -> str:
    """Write under ``root/kind``; NULL is ``null_text`` in CSV. Returns the folder.

    Quotes in a cell are doubled; blanks around a cell stay; an empty text is a pair of quotes. ``sort_by`` orders the rows
    inside each file, the only place where order matters. With mode ``replace`` a run may be repeated: the folders of the dates,
    experiments and modes that ``df`` holds are replaced as a whole, all others stay as they are.
    """
    dated = df.withColumn("run_date", F.lit(run_date or datetime.date.today()))
    parts = ["run_date"] + [c for c in ("ExpID", "IonMode") if c in df.columns]
    if sort_by:
        dated = dated.sortWithinPartitions(*parts, *sort_by)
    writer = dated.write.mode("overwrite" if mode == "replace" else mode).partitionBy(*parts)
    writer = writer.option("maxRecordsPerFile", ROWS_PER_FILE)
    if mode == "replace":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    path = f"{root}/{kind}"
    if fmt == "csv":
        writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(
            path, header=True, nullValue=null_text, escape='"', encoding="UTF-8"
        )
    else:
        writer.format(fmt).save(path)
    return path


def write_run(result: Processed, root: str, params: Params = Params(), **options) -> dict[str, str]:
    """The tables a run leaves behind: raw-flagged only if asked for, wide if paired and long."""
    out = {}
    if params.output_raw:
        out[RAW_FLAGGED] = write_table(result.raw_flagged(params), root, RAW_FLAGGED, **options)
    out[FILTERED] = write_table(result.filtered(params), root, FILTERED, **options)
    if params.paired and not params.output_wide:
        out[FILTERED_WIDE] = write_table(result.filtered_wide(), root, FILTERED_WIDE, **options)
    return out


def write_joined(df: DataFrame, root: str, **options) -> str:
    return write_table(df, root, "joined", null_text="NA", **options)


def write_compounds(df: DataFrame, root: str, **options) -> str:
    return write_table(df, root, "unique_compounds", null_text="NA", **options)


def write_scores(df: DataFrame, root: str, **options) -> str:
    """The priority table as UTF-8 CSV, without a byte-order mark."""
    return write_table(df, root, "priority_scores", null_text="NA", **options)


def read_result(spark: SparkSession, root: str, kind: str, schema: str, null_text: str = "") -> DataFrame:
    """A CSV result table with the columns of ``schema``; run date, experiment and mode come from the folders.

    ``schema`` names the columns of the files and of the folders, so experiments called ``007`` stay text. A filter on a folder
    column reads those folders only.
    """
    options = {"header": True, "escape": '"', "multiLine": True, "nullValue": null_text, "enforceSchema": False}
    return spark.read.schema(schema).csv(f"{root}/{kind}", **options)
