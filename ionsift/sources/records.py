"""Records of delimited files whose quoted cells may hold delimiters, doubled quotes, line breaks and comment signs.

Files stay splittable: they are read as lines, and a line that does not end where a record ends is
put together with the next ones. Whether a line starts inside a quoted cell hangs on all lines
before it, so each line is taken as a function of that state, functions are composed within a
block of a file by a window, and over the blocks of a file by another one on a row a block. Files
without a quoted line break, by far the most, need none of it: their lines are their records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ionsift.session import settle, settle_and_watch

QUOTE, COMMENT = '"', "#"
NO_COMMENTS, COMMENT_LINES, TRAILING_COMMENTS = "none", "lines", "trailing"
LONGEST = 64 << 20  # characters of a record that lies on several lines; more means a quote that is never closed

PLACE = ["source", "block", "at"]


def _walk(start: int, sep: str, trailing: bool) -> Column:
    """State (1: inside a quoted cell) and cut after a line that starts in ``start``; -1 if nothing is cut.

    A quote opens a cell at the start of the cell only, closes it inside, and is taken as text elsewhere. The cut is the
    number of quotes before a comment sign outside of quoted cells.
    """
    sign = f"contains(seg, '{COMMENT}')" if trailing else "false"
    sep_text = sep.replace("\t", "\\t")
    step = "named_struct('s', {}, 'closed', {}, 'first', false, 'n', a.n + 1, 'cut', -1)".format
    folded = f"""aggregate(slice(segs, 1, size(segs) - 1),
        named_struct('s', {start}, 'closed', false, 'first', true, 'n', 0, 'cut', -1),
        (a, seg) -> CASE
            WHEN a.cut >= 0 THEN a
            WHEN a.s = 0 AND {sign} THEN named_struct('s', 0, 'closed', false, 'first', false, 'n', a.n, 'cut', a.n)
            WHEN a.s = 1 THEN {step(0, "true")}
            WHEN (a.closed OR a.first) AND seg = '' OR endswith(seg, '{sep_text}') THEN {step(1, "false")}
            ELSE {step(0, "false")} END,
        a -> named_struct('s', a.s, 'cut', CASE WHEN a.cut >= 0 THEN a.cut
            WHEN a.s = 0 AND {sign.replace("seg", "element_at(segs, -1)")} THEN a.n ELSE -1 END))"""
    return F.expr(folded)


def lines(spark: SparkSession, paths: list[str], sep: str, comments: str = COMMENT_LINES) -> DataFrame:
    """Lines with their place, and what they do to the state: ``f0``, ``c0`` outside of a quoted cell, ``f1``, ``c1`` inside."""
    trailing = comments == TRAILING_COMMENTS
    raw = spark.read.text(paths, lineSep="\n").select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
        F.split("value", QUOTE).alias("segs"),
    )
    walked = raw.select("*", _walk(0, sep, trailing).alias("w0"), _walk(1, sep, trailing).alias("w1"))
    own = F.col("value").startswith(COMMENT) if comments == COMMENT_LINES else F.lit(False)
    return walked.select(
        *PLACE,
        "value",
        F.when(own, 0).otherwise(F.col("w0.s")).alias("f0"),
        F.when(own, 0).otherwise(F.col("w0.cut")).alias("c0"),
        F.col("w1.s").alias("f1"),
        F.col("w1.cut").alias("c1"),
    )


def _cut(value: Column, cut: Column) -> Column:
    """The line up to the comment sign after ``cut`` quotes."""
    segs = F.split(value, QUOTE)
    head = F.concat_ws(QUOTE, F.slice(segs, F.lit(1), F.greatest(cut, F.lit(0))), F.substring_index(F.get(segs, cut), COMMENT, 1))
    return F.when(cut < 0, value).otherwise(head)


def _ended(text: Column) -> Column:
    return F.regexp_replace(text, "\r$", "")


def _complete(rows: DataFrame) -> DataFrame:
    """Records that are lines: without comment lines and blank ones."""
    text = _ended(_cut(F.col("value"), F.col("c0")))
    return rows.select(*PLACE, text.alias("record")).where("trim(record) <> ''")


def first_lines(found: DataFrame) -> DataFrame:
    """One row a file, in one job: ``touched`` if a line may end inside a quoted cell, and its first line that says anything.

    ``at`` is the same whenever the same paths are read by the same session, as long as no filter leaves files out
    before they are read; so files are told apart by joins, never by a filter on ``source``.
    """
    line = _ended(_cut(F.col("value"), F.col("c0")))
    place = F.when(F.trim(line) != "", F.struct("block", "at"))
    return found.groupBy("source").agg(
        F.max("f0").alias("touched"),  # if no line ends inside a cell when it starts outside, none ever starts inside
        F.min_by(F.struct("block", "at", "f0", line.alias("line")), place).alias("first"),
    )


def _state(const: str, flips: str, start: Column) -> Column:
    """The state after lines of which the last constant one set ``const``, with ``flips`` of the state in all."""
    after = (F.col(f"{const}.value") + F.col(flips) - F.col(f"{const}.flips")) % 2
    return F.coalesce(after, (start + F.col(flips)) % 2)


def records(spark: SparkSession, paths: list[str], sep: str, comments: str = COMMENT_LINES) -> tuple[DataFrame, DataFrame]:
    """``source``, ``block``, ``at``, ``record`` of all files, and the table of their first lines.

    Lines are separated by line feeds; a carriage return before one is dropped at the end of a record and kept inside a
    quoted cell. Blank lines between records, and comments if wanted, are left out. A record that
    runs over more than ``LONGEST`` characters of several lines is an error that names the file: its quote is never closed.
    """
    found = lines(spark, paths, sep, comments)
    files, seen = settle_and_watch(first_lines(found), touched=F.sum("touched"))
    if not seen["touched"]:
        return _complete(found), files
    direct = found.join(files.where("touched = 0").select("source"), "source", "left_semi")
    rough = found.join(files.where("touched = 1").select("source"), "source", "left_semi")
    return _complete(direct).unionByName(_assembled(rough)), files


def _assembled(rough: DataFrame) -> DataFrame:
    """Records of files with quoted line breaks."""
    # A block of a file is bounded by the size of an input split.
    before = Window.partitionBy("source", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    flip = F.when((F.col("f0") == 1) & (F.col("f1") == 0), 1).otherwise(0)
    upto = Window.partitionBy("source", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    counted = rough.withColumn("flips", F.sum(flip).over(upto))
    const = F.when(F.col("f0") == F.col("f1"), F.struct(F.col("f0").alias("value"), F.col("flips").alias("flips")))
    held = settle(
        counted.select(
            "*",
            F.last(const, ignorenulls=True).over(upto).alias("const"),
            F.last(const, ignorenulls=True).over(before).alias("const_before"),
            (F.col("flips") - flip).alias("flips_before"),
        )
    )
    ends = held.groupBy("source", "block").agg(F.max_by(F.struct("flips", "const"), "at").alias("e"))
    ends = ends.select("source", "block", F.col("e.flips").alias("flips"), F.col("e.const").alias("const"))
    value = F.when(F.col("const").isNotNull(), _state("const", "flips", F.lit(0)))
    over = Window.partitionBy("source").orderBy("block")
    blocks = ends.select("source", "block", value.alias("value"), F.when(value.isNull(), F.col("flips") % 2).otherwise(0).alias("flip"))
    blocks = blocks.withColumn("flips", F.sum("flip").over(over))
    set_to = F.when(F.col("value").isNotNull(), F.struct(F.col("value").alias("value"), F.col("flips").alias("flips")))
    blocks = blocks.withColumn("set", F.last(set_to, ignorenulls=True).over(over))
    blocks = blocks.withColumn("out", _state("set", "flips", F.lit(0)))
    blocks = settle(blocks.select("source", "block", F.coalesce(F.lag("out").over(over), F.lit(0)).alias("state_in")))
    rows = held.join(blocks, ["source", "block"]).withColumn("s", _state("const_before", "flips_before", F.col("state_in")))
    inside = F.col("s") == 1
    whole = rows.where((F.col("s") == 0) & (F.col("f0") == 0))
    open_ = rows.where(inside | (F.col("f0") == 1)).select(
        *PLACE, "s", _cut(F.col("value"), F.when(inside, F.col("c1")).otherwise(F.col("c0"))).alias("text")
    )
    # The start of a record that goes on in a later block of the file is carried over the blocks.
    starts = open_.groupBy("source", "block").agg(F.max(F.when(F.col("s") == 0, F.struct("block", "at"))).alias("last_start"))
    back = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = settle(starts.select("source", "block", F.last("last_start", ignorenulls=True).over(back).alias("carried")))
    own = F.last(F.when(F.col("s") == 0, F.struct("block", "at")), ignorenulls=True).over(upto)
    placed = open_.withColumn("own", own).join(carried, ["source", "block"]).withColumn("of", F.coalesce("own", "carried"))
    parts = settle(placed.select("source", "of", "block", "at", "text"))
    sizes, seen = settle_and_watch(
        parts.groupBy("source", "of").agg(F.sum(F.length("text") + 1).alias("n")), longest=F.max("n"), worst=F.max_by("source", "n")
    )
    if (seen["longest"] or 0) > LONGEST:
        raise ValueError(f"{seen['worst']}: a quoted cell runs over {seen['longest']} characters; is its quote closed?")
    joined = parts.groupBy("source", "of").agg(F.sort_array(F.collect_list(F.struct("block", "at", "text"))).alias("x"))
    text = F.array_join(F.transform("x", lambda p: p["text"]), "\n")
    return _complete(whole).unionByName(joined.select("source", "of.block", "of.at", _ended(text).alias("record")))


def parse(record: Column, n: int, sep: str) -> Column:
    """The cells ``_0`` to ``_{n-1}`` of a record as text, and ``_bad``: the record itself if it has more or fewer.

    An empty cell is NULL, an empty text in quotes is empty text.
    """
    schema = ", ".join([f"_{i} STRING" for i in range(n)] + ["_bad STRING"])
    options = {
        "sep": sep, "quote": QUOTE, "escape": QUOTE, "nullValue": "\u0001", "emptyValue": "", "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_bad", "maxColumns": str(max(20480, n + 2)),
    }
    return F.from_csv(record, schema, options)
