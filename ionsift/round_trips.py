"""Tables written as files and read back: what the readers and writers do, over the shared test tables.

Each function writes one of the given tables, as a whole, to the shared folder, reads the files with the package's readers and
returns what they say. The SQL beside it starts from the table alone.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift import fixtures as fx
from ionsift.operators.ingest import prepare_files
from ionsift.params import Params
from ionsift.session import settle, shared_folder
from ionsift.sources import readers, records, types, writers

RUN_DATE = datetime.date(2020, 1, 2)


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw_lines(df: DataFrame, header: str, path: str) -> None:
    """Lines as they are (one text column), in files that each begin with a header line."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = df.toDF("line").select(F.pmod(F.xxhash64("line"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("kind"), "line")
    heads = spark.range(parts).select(F.col("id").cast("int").alias("part"), F.lit(0).alias("kind"), F.lit(header).alias("line"))
    placed = lines.unionByName(heads).repartitionById(parts, F.col("part")).sortWithinPartitions("kind")
    placed.select("line").write.text(path)


# Web pages: cells with commas, quotes, line breaks and comment signs.
QUOTED = """
SELECT CAST(page_id AS STRING) AS page_id, concat('"', url, '", #', CAST(page_id AS STRING)) AS note, html,
       CASE WHEN page_id % 7 = 0 THEN '' WHEN page_id % 7 = 1 THEN NULL ELSE concat(' ', url, ' ') END AS url
FROM {pages}
"""


def read_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _folder(spark)
    table = spark.sql(QUOTED, pages=_table(spark, sf_dir, "pages"))
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    table.write.options(**options).csv(f"{root}/pages.csv", header=True, escape=records.QUOTE, nullValue="", emptyValue='""')
    return readers.read_cells(spark, f"{root}/pages.csv").select("page_id", "note", "html", "url", F.col("_bad").alias("bad"))


QUOTED_SQL = f"SELECT *, CAST(NULL AS VARCHAR) AS bad FROM ({QUOTED.replace('{pages}', 'pages')}) t"

# Records with remarks behind them, some of which hold quotes and delimiters, and remarks between them.
COMMENTED = '''
SELECT concat(CAST(p_partkey AS STRING), ',"', p_name, ' #', CAST(p_size AS STRING), ' ""', p_brand, '""",',
              CASE WHEN p_partkey % 4 = 0 THEN '"two
# lines"' ELSE p_type END,
              CASE p_partkey % 5 WHEN 0 THEN '# "checked, twice' WHEN 1 THEN ' #' WHEN 2 THEN '#"' ELSE '' END,
              CASE WHEN p_partkey % 6 = 0 THEN '
# an open " quote in a remark' ELSE '' END) AS line
FROM {part}
'''


def comment_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _folder(spark)
    _raw_lines(spark.sql(COMMENTED, part=_table(spark, sf_dir, "part")), "key,name,type # header", f"{root}/part.csv")
    cells = readers.read_cells(spark, f"{root}/part.csv", records.TRAILING_COMMENTS)
    return cells.select("key", "name", F.trim("`type `").alias("type"), F.col("_bad").alias("bad"))


COMMENTED_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS key, concat(p_name, ' #', CAST(p_size AS VARCHAR), ' "', p_brand, '"') AS name,
       CASE WHEN p_partkey % 4 = 0 THEN concat('two', chr(10), '# lines') ELSE p_type END AS type, CAST(NULL AS VARCHAR) AS bad
FROM part
"""

# Headers that become equal: only by their odd characters, by case, and from the start.
HEADER = ["A b", "A.b", "a_B", "2nd", "A_b_2", "2nd", ""]


def header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _folder(spark)
    part = _table(spark, sf_dir, "part")
    line = F.concat_ws("\t", "p_partkey", "p_size", "p_brand", "p_type", F.lit("-"), "p_retailprice", "p_name")
    _raw_lines(part.select(line), "\t".join(HEADER), f"{root}/part.tsv")
    return readers.read_lookup(spark, f"{root}/part.tsv")


HEADER_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS "A_b", CAST(p_size AS VARCHAR) AS "A_b_3", p_brand AS "a_B_4", p_type AS "X2nd",
       CAST(NULL AS VARCHAR) AS "A_b_2", CAST(p_retailprice AS VARCHAR) AS "X2nd_2", p_name AS "X" FROM part
"""

# Columns of every type, with values that decide only once in many rows.
TYPED = """
SELECT CAST(l_orderkey AS STRING) AS whole, concat('+', CAST(l_linenumber AS STRING)) AS sign,
       CASE WHEN l_orderkey % 1000 = 7 THEN '1e-3' ELSE CAST(l_linenumber AS STRING) END AS mixed,
       CAST(l_quantity AS STRING) AS number,
       CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE concat('19', CAST(10 + l_linenumber AS STRING), '-02-2', CAST(l_linenumber AS STRING)) END AS day,
       CASE WHEN l_orderkey % 997 = 5 THEN '1999-02-30' ELSE '1999-02-28' END AS no_day,
       CASE WHEN l_linenumber = 1 THEN 'T' WHEN l_linenumber = 2 THEN NULL ELSE 'false' END AS flag,
       CASE WHEN l_orderkey % 1000 = 3 THEN 'yes' ELSE 'TRUE' END AS no_flag,
       l_returnflag || l_linestatus AS word, CASE WHEN l_orderkey % 1000 = 9 THEN '2D' ELSE ' 12 ' END AS suffix, CAST(NULL AS STRING) AS nothing
FROM {lineitem}
"""


def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return types.inferred_types(spark.sql(TYPED, lineitem=_table(spark, sf_dir, "lineitem")))


def _type_sql() -> str:
    number = types.PLAIN_NUMBER
    parts = []
    for c in ("whole", "sign", "mixed", "number", "day", "no_day", "flag", "no_flag", "word", "suffix", "nothing"):
        tokens = ", ".join(f"'{t}'" for t in types.BOOLEAN_TOKENS)
        parts.append(f"""
            SELECT '{c}' AS "column", CASE
                     WHEN count(*) FILTER (v NOT IN ({tokens})) = 0 THEN 'boolean'
                     WHEN count(*) FILTER (NOT regexp_matches(v, '{types.PLAIN_INTEGER}')) = 0 THEN 'long'
                     WHEN count(*) FILTER (NOT regexp_matches(v, '{number}')) = 0 THEN 'double'
                     WHEN count(*) FILTER (NOT regexp_matches(v, '{types.PLAIN_DATE}') OR try_cast(v AS DATE) IS NULL) = 0
                       THEN 'date' ELSE 'text' END AS type,
                   count(v) AS n_values, count(*) - count(v) AS n_missing
            FROM (SELECT trim({c}) AS v FROM ({TYPED.replace("{lineitem}", "lineitem")}) x) t""")
    return " UNION ALL ".join(parts)


# One export in many files, of which every other one lacks a sample and has another instead.
BATCH = "lpad(CAST(p_partkey // 400 AS STRING), 6, '0')"
_SOME = {0: ["E1_Positive_MS1_S2_1"], 1: ["E1_Positive_MS1_S1_2"]}


def batch_columns(odd: int) -> list[str]:
    return [c for c in fx.EXPORT_COLUMNS if c not in _SOME[odd]]


def batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _folder(spark)
    rows = settle(fx.fixture(spark, sf_dir, fx.EXPORT).withColumn("k", F.regexp_extract("Compound", "([0-9]+)$", 1).cast("long")))
    rows = rows.where("Compound IS NOT NULL")
    batch = F.lpad(F.expr("CAST(k div 400 AS STRING)"), 6, "0")
    for odd in (0, 1):
        some = rows.where(F.expr("k div 400") % 2 == odd).select(
            batch.alias("batch"), "Mass", F.col("`Retention Time`"), "Compound", "Annotations", "Frequency", *batch_columns(odd)
        )
        # A batch is one file, as an instrument leaves it.
        files = some.repartition("batch").write.partitionBy("batch")
        files.options(escape=records.QUOTE, header=True, nullValue="-" if odd else "NA").csv(f"{root}/kind={odd}")
    paths = [f"{root}/kind=*/batch=*/*.csv"]
    return prepare_files(spark, paths, Params(), shared_datasets=True).long()


def batch_sql() -> str:
    sides = []
    for odd in (0, 1):
        for c in batch_columns(odd):
            _, _, _, sample, rep = c.split("_")
            sides.append(f"""
                SELECT n AS FeatureNumber, 'E1' AS ExpID, 'Positive' AS IonMode, 'MS1' AS ModeDetail,
                       '{'Blank' if sample.startswith('MB') else sample}' AS SampleDetail, '{rep}' AS Rep,
                       nullif(nullif(try_cast({c} AS DOUBLE), 0), 1) AS volume, try_cast(Mass AS DOUBLE) AS Mass,
                       try_cast("Retention Time" AS DOUBLE) AS RetentionTime, split_part(Compound, ' Esi', 1) AS Compound,
                       try_cast(regexp_extract(Annotations, 'overall=(.*),', 1) AS DOUBLE) AS Score,
                       CAST(nullif(Frequency, '0') AS BIGINT) AS Frequency
                FROM numbered WHERE odd = {odd}""")
    return f"""
        WITH export AS ({fx.plain(fx.EXPORT).replace("`", '"')}),
        rows AS (SELECT *, CAST(regexp_extract(Compound, '([0-9]+)$', 1) AS BIGINT) // 400 AS batch FROM export WHERE Compound IS NOT NULL),
        numbered AS (
            SELECT *, batch % 2 AS odd, row_number() OVER (ORDER BY batch % 2, batch, try_cast(Mass AS DOUBLE) NULLS LAST,
                     try_cast("Retention Time" AS DOUBLE) NULLS LAST, Compound) AS n FROM rows)
        {" UNION ALL ".join(sides)}"""


_RESULT = (
    "FeatureNumber BIGINT, Mass DOUBLE, RetentionTime DOUBLE, Compound STRING, Score DOUBLE, Frequency BIGINT, "
    "run_date DATE, ExpID STRING, IonMode STRING"
)


def sink_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written, written again for half of the experiments, and read back: as if written once."""
    root = _folder(spark)
    features = settle(fx.fixture(spark, sf_dir, fx.FEATURES).withColumn("Compound", F.concat(F.col("Compound"), F.lit(' "x", '))))
    writers.write_table(features, root, "features", RUN_DATE, mode="replace", null_text="NA")
    again = features.where(F.crc32(F.encode("ExpID", "UTF-8")) % 2 == 0)
    writers.write_table(again, root, "features", RUN_DATE, mode="replace", null_text="NA", sort_by=["Mass"])
    return writers.read_result(spark, root, "features", _RESULT, null_text="NA")


SINK_SQL = f"""
SELECT FeatureNumber, Mass, RetentionTime, concat(Compound, CASE WHEN Compound IS NULL THEN NULL ELSE ' "x", ' END) AS Compound, Score,
       CAST(Frequency AS BIGINT) AS Frequency, DATE '2020-01-02' AS run_date, ExpID, IonMode
FROM ({fx.plain(fx.FEATURES)}) f
""".replace("concat(Compound, CASE WHEN Compound IS NULL THEN NULL ELSE ' \"x\", ' END)", "Compound || ' \"x\", '")

# A lookup result with records that lack a cell, have one too many, or hold no number where one is due.
LOOKUP_NUMBERS = ("DATA_SOURCES", "TOXCAST___ACTIVE")
LOOKUP_HEADER = "INPUT\tDATA_SOURCES\tTOXCAST_% ACTIVE\tPreferred Name"
LOOKUP_CASES = """
SELECT p_partkey, p_name, p_type,
       CASE WHEN p_partkey % 31 = 3 THEN 'many' WHEN p_partkey % 29 = 0 THEN '-' ELSE CAST(p_size AS STRING) END AS sources,
       CASE WHEN p_partkey % 37 = 5 THEN '1,5' WHEN p_partkey % 14 = 0 THEN '' ELSE concat(CAST(p_size AS STRING), '.5') END AS active,
       CASE WHEN p_partkey % 41 = 7 THEN 'missing' WHEN p_partkey % 43 = 8 THEN 'surplus' ELSE 'whole' END AS cells
FROM {part}
"""
_LOOKUP_RECORD = """
CASE cells WHEN 'missing' THEN concat(p_name, '{t}', sources, '{t}', active)
           WHEN 'surplus' THEN concat(p_name, '{t}', sources, '{t}', active, '{t}', p_type, '{t}', 'more')
           ELSE concat(p_name, '{t}', sources, '{t}', active, '{t}', p_type) END
"""


def _lookup(spark: SparkSession, sf_dir: str) -> readers.Lookup:
    root = _folder(spark)
    cases = spark.sql(LOOKUP_CASES, part=_table(spark, sf_dir, "part"))
    _raw_lines(cases.select(F.expr(_LOOKUP_RECORD.replace("{t}", "\\t"))), LOOKUP_HEADER, f"{root}/lookup.tsv")
    return readers.checked_lookup(spark, f"{root}/lookup.tsv", LOOKUP_NUMBERS)


def lookup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir).rows


def lookup_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir).rejected.select("reason", "record")


def _lookup_sql() -> tuple[str, str]:
    cases = LOOKUP_CASES.replace("{part}", "part")
    reason = """CASE WHEN cells <> 'whole' THEN 'cells' WHEN sources = 'many' THEN 'DATA_SOURCES'
                     WHEN active = '1,5' THEN 'TOXCAST___ACTIVE' END"""
    record = _LOOKUP_RECORD.replace("'{t}'", "chr(9)")
    rows = f"""
        SELECT p_name AS "INPUT", try_cast(sources AS DOUBLE) AS "DATA_SOURCES", try_cast(nullif(active, '') AS DOUBLE) AS "TOXCAST___ACTIVE",
               p_type AS "Preferred_Name" FROM ({cases}) c WHERE ({reason}) IS NULL"""
    rejects = f"SELECT {reason} AS reason, {record} AS record FROM ({cases}) c WHERE ({reason}) IS NOT NULL"
    return rows, rejects


def old_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old results carry experiment, mode, kind and date in the names of their folders only."""
    root = _folder(spark)
    features = fx.fixture(spark, sf_dir, fx.FEATURES)
    name = F.concat("ExpID", F.lit("_$"), "IonMode", F.lit("$_Filtered_2018-01-05.csv"))
    features.select("FeatureNumber", "Mass", name.alias("name")).write.partitionBy("name").csv(f"{root}/old", header=True)
    return readers.old_files(spark, f"{root}/old/*/*.csv").select("name", "mode", "pair", "stem").distinct()


OLD_SQL = f"""
SELECT DISTINCT concat(ExpID, '_$', IonMode, '$_Filtered_2018-01-05.csv') AS name, IonMode AS mode,
       concat(ExpID, '_Filtered_2018-01-05.csv') AS pair, concat(ExpID, '_$', IonMode, '$_Filtered') AS stem
FROM ({fx.plain(fx.FEATURES)}) f
"""

QUERIES = {
    "read_quoted": read_quoted,
    "comment_cells": comment_cells,
    "header_names": header_names,
    "inferred_types": inferred_types,
    "batch_files": batch_files,
    "sink_round_trip": sink_round_trip,
    "lookup_rows": lookup_rows,
    "lookup_rejects": lookup_rejects,
    "old_names": old_names,
}

SQL = {
    "read_quoted": QUOTED_SQL,
    "comment_cells": COMMENTED_SQL,
    "header_names": HEADER_SQL,
    "inferred_types": _type_sql(),
    "batch_files": batch_sql(),
    "sink_round_trip": SINK_SQL,
    "lookup_rows": _lookup_sql()[0],
    "lookup_rejects": _lookup_sql()[1],
    "old_names": OLD_SQL,
}
