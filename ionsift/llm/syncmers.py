"""Document fingerprints from closed syncmers of words, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ionsift.llm import common
from ionsift.llm.common import let
from ionsift.operators.skew import number_rows
from ionsift.session import settle, settle_and_watch

K = 5  # words of a k-mer
S = 2  # words of its inner substrings
_BLANK = " \t\n\x0b\f\r"
_NO_ID = -(2**63)
COARSE = 256  # buckets between quantiles of the ids
PER_BUCKET = 2_000  # rows of a bucket, about


def words(text: Column) -> Column:
    """Runs of characters outside 0x20 and 0x09-0x0D; an empty array without any."""
    trimmed = F.btrim(text, F.lit(_BLANK))
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"[\x20\x09-\x0D]+")))


def syncmers(text: Column) -> Column:
    """The closed syncmers of a text: an array of ``position`` (in words) and ``hash``, in text order.

    A k-mer of ``K`` words is chosen if the least of the hashes of its inner ``S``-word substrings is
    its first or its last one. The choice hangs on the k-mer alone, not on what stands around it,
    so a passage gives the same anchors in any text and at the same distances. A text of fewer
    than ``K`` words is one anchor, without words it has none.
    """

    def chosen(word: Column) -> Column:
        n = F.size(word)
        short = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(F.array_join(word, " ")).alias("hash")))
        none = F.array().cast("array<struct<position:int,hash:bigint>>")

        def of_hashes(h: Column) -> Column:
            inner = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1)))
            last = K - S  # place of the last inner substring

            def of_inner(m: Column) -> Column:
                edge = lambda i: F.least(F.get(m, i), F.get(m, i + last))
                middle = lambda i: F.least(*[F.get(m, i + j) for j in range(1, last)])
                starts = F.filter(F.sequence(F.lit(0), n - K), lambda i: edge(i) <= middle(i))
                kmer = lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(K)])
                return F.transform(starts, lambda i: F.struct(i.alias("position"), kmer(i).alias("hash")))

            return let(inner, of_inner)

        many = let(F.transform(word, lambda w: F.xxhash64(w)), of_hashes)
        return F.when(n >= K, many).when(n > 0, short).otherwise(none)

    return let(words(text), chosen)


def sketch(text: Column) -> Column:
    """Hashes of all pairs of neighbouring anchors with the distance between them, each once; the same for equal texts.

    Two texts have an element in common where two anchors follow each other at the same distance in
    both: a match of positions at a common offset, wherever the passage stands. A text with one anchor has its hash.
    """

    def pairs(a: Column) -> Column:
        def link(x: Column, i: Column) -> Column:
            following = F.get(a, i + 1)
            return F.xxhash64(x["hash"], following["hash"], following["position"] - x["position"])

        many = F.transform(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))), link)
        return F.when(F.size(a) > 1, many).otherwise(F.transform(a, lambda x: x["hash"]))

    return F.array_sort(F.array_distinct(let(syncmers(text), pairs)))


def fingerprint(sketched: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits for each element, however many there are."""
    return F.array_join(F.transform(sketched, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    """Share of common elements among all elements of both sketches, 0 to 1; two texts without words are alike (1)."""
    return let(
        F.size(F.array_intersect(one, other)),
        lambda both: F.when(F.size(one) + F.size(other) == 0, F.lit(1.0)).otherwise(
            both / (F.size(one) + F.size(other) - both)
        ),
    )


def anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``position``, ``hash``: every anchor of every text, for positional matching."""
    plain = common.texts(docs, id_col, text_col)
    return plain.select("doc_id", F.explode(syncmers(F.col("text"))).alias("a")).select("doc_id", "a.*")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``sketch``, ``fingerprint`` of every row; a NULL text is empty and has an empty one.

    A map over the rows: equal texts have equal fingerprints wherever they stand.
    """
    plain = common.texts(docs, id_col, text_col).select("doc_id", sketch(F.col("text")).alias("sketch"))
    return plain.withColumn("fingerprint", fingerprint(F.col("sketch")))


_BUCKET = ["coarse", "fine", "part"]


def _bucketed(base: DataFrame) -> DataFrame:
    """``base`` with the numbers of its bucket: rows of one bucket lie next to each other in the order of (id, salt).

    Coarse buckets end at quantiles of the ids. They are cut evenly into as many fine ones as leave each some
    ``PER_BUCKET`` rows; an id that fills several coarse ones is cut into parts by its salts.
    """
    shares = ", ".join(repr(i / COARSE) for i in range(COARSE + 1))
    seen = base.selectExpr(f"approx_percentile(id, array({shares}), 100000) AS cuts", "count(1) AS n").first()
    if not seen["n"]:
        return base.select("*", *[F.lit(0).alias(c) for c in _BUCKET])
    cuts = F.array(*[F.lit(c).cast("long") for c in seen["cuts"]])
    fine = -(-seen["n"] // (COARSE * PER_BUCKET))
    placed = base.withColumn("coarse", F.size(F.filter(cuts, lambda c: c < F.col("id"))))
    low = F.coalesce(F.get(cuts, F.col("coarse") - 1), F.get(cuts, F.col("coarse"))).cast("double")
    high = F.coalesce(F.get(cuts, F.col("coarse")), F.get(cuts, F.col("coarse") - 1)).cast("double")
    share = F.try_divide(F.col("id").cast("double") - low, high - low)
    times = F.size(F.filter(cuts, lambda c: c == F.col("id")))
    part = F.floor((F.col("salt").cast("double") / 2.0**64 + 0.5) * times * fine)
    return placed.select(
        "*",
        F.least(F.floor(F.coalesce(share, F.lit(0.0)) * fine), F.lit(fine)).cast("int").alias("fine"),
        F.when(times > 1, part).otherwise(0).cast("int").alias("part"),
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of the text with its last third replaced by the next one's beginning.

    The next document is the next in descending doc_id, after the last the first; a NULL doc_id
    comes last. Rows with one doc_id are ordered by a hash of their text; fully equal rows count as one for
    the order, and all are returned. A NULL text is empty. An empty table gives no row; other columns are ignored.

    Whole texts are shuffled once, to buckets of neighbouring ids (see ``_bucketed``); within a bucket
    the next text is the row behind, and only the first text of each bucket travels to the last row of the
    bucket before it. Fingerprints are taken after that shuffle and never written.
    """
    base = common.texts(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), F.xxhash64("text").alias("salt"), "text"
    )
    bucketed = _bucketed(base)
    # First row of each bucket: the largest id, of these the smallest salt.
    first = F.max(F.struct("id", F.bitwise_not("salt").alias("not_salt")))
    heads, seen = settle_and_watch(
        bucketed.groupBy(*_BUCKET).agg(first.alias("h")).select(*_BUCKET, "h.id", F.bitwise_not("h.not_salt").alias("salt"))
    )
    order = [F.col("coarse").desc(), F.col("fine").desc(), F.col("part")]
    numbered = settle(number_rows(heads, [], order, "number"))
    behind = numbered.select("id", "salt", (F.when(F.col("number") == 1, seen["rows"] + 1).otherwise(F.col("number")) - 1).alias("number"))
    texts = base.join(behind, ["id", "salt"]).dropDuplicates(["id", "salt"]).select("number", "text")
    after = numbered.select(*_BUCKET, "number").join(texts, "number")
    after = settle(after.select(*_BUCKET, F.col("text").alias("head")))
    # Equal rows are one with their number; this grouping and the window keep the layout by bucket.
    once = (
        bucketed.repartition(*_BUCKET)
        .groupBy(*_BUCKET, "id", "salt")
        .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    )
    in_order = Window.partitionBy(*_BUCKET).orderBy(F.col("id").desc(), "salt")
    known = once.withColumn("sketch", sketch(F.col("text")))
    following = known.withColumn("following", F.lead(F.struct("text", "sketch")).over(in_order))
    # By bucket alone, so that the texts stay where they are; only the last row of a bucket uses it.
    joined = following.join(after, _BUCKET, "left")
    beginning = F.coalesce("following.text", "head")
    edited = F.concat(
        F.expr("left(text, char_length(text) - CAST(floor(char_length(text) / 3) AS INT))"),
        F.left(beginning, F.expr("CAST(floor(char_length(text) / 3) AS INT)")),
    )
    both = joined.select(
        F.when(F.col("id") != _NO_ID, F.col("id")).alias("doc_id"),
        F.char_length("text").cast("long").alias("n_chars"),
        edited.alias("edited"),
        "sketch",
        F.coalesce("following.sketch", sketch(F.col("head"))).alias("next_sketch"),
        "copies",
    )
    done = both.select("*", sketch(F.col("edited")).alias("edited_sketch")).select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        "copies",
    )
    return done.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "_copy")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(common.read_table(spark, sf_dir, "documents"))
