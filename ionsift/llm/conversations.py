"""Conversation structure repair: the cheapest edits, least audit first, by integer-weighted paths."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift.llm import common
from ionsift.session import settle

# Costs of the edits and of a truncated row that stays.
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 2, 3, 2, 1

EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # what was said last
_INSERTED = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}  # ascending as in ASCII; 0 is the padding
_LETTERS = str.maketrans({"0": None, **{str(v): k for k, v in _DIGIT.items()}})

BLOCK = 64  # rows whose letters share one integer
FIELD = 9  # bits of a row's letters: three octal digits
_LOW = BLOCK * FIELD
_ABOVE = _LOW + 2  # two bits for the order of the beginnings
BUFFERED = 4 << 20  # characters of a conversation held for its digest; longer ones are read again

_WORD = re.compile(r"[^\x20\x09-\x0D]")
_ENDED = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")

Step = tuple[int, int, int, str]  # from, to, cost, letters


def follows(state: int, initial: str) -> int | None:
    """The state after a row with this role initial, None if it may not stand there."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    if initial == "u":
        return USER if state != USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


@lru_cache(maxsize=None)
def steps(initial: str, gone: bool, truncated: bool) -> tuple[Step, ...]:
    """The best way from each state to each other over one row: rows inserted before it, then its own edit.

    Letters of a row end with the only one that is no ``I``, so none begins another: the lesser of two ways between the
    same states is the better one whatever comes before and after.
    """
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        state, cost, letters = start, 0, ""
        for _ in range(3):
            moves = [("D", state, DELETE)]
            if not gone:
                late = LEFT_TRUNCATED if truncated else 0
                moves.append(("K", follows(state, initial), late))
                moves += [("R", follows(state, r), REROLE + late) for r in "ua"]
            for letter, to, price in moves:
                way = (cost + price, letters + letter)
                if to is not None and way < best.get((start, to), (1 << 30, "")):
                    best[start, to] = way
            state, cost, letters = _INSERTED[state], cost + INSERT, letters + "I"
    return tuple((p, q, c, w) for (p, q), (c, w) in best.items())


def closing() -> tuple[Step, ...]:
    """The rows to insert at the end."""
    ways = []
    for start in range(4):
        state, cost, letters = start, 0, ""
        while state not in (EMPTY, ASSISTANT):
            state, cost, letters = _INSERTED[state], cost + INSERT, letters + "I"
        ways.append((start, state, cost, letters))
    return tuple(ways)


@lru_cache(maxsize=None)
def _weights(ways: tuple[Step, ...], place: int) -> tuple[tuple[int, int, int], ...]:
    """Each way as one integer: its cost in the high digits, its letters in the field of the row, padded by zeros."""
    shift = _LOW - FIELD * (place + 1)
    out = []
    for p, q, cost, letters in ways:
        field = 0
        for k, letter in enumerate(letters):
            field |= _DIGIT[letter] << (FIELD - 3 * (k + 1))
        out.append((p, q, (cost << _ABOVE) + (field << shift)))
    return tuple(out)


class Paths:
    """The least path to every state, as one integer each; smaller is cheaper, then least in ASCII.

    After ``BLOCK`` rows the letters move to a chain and the paths keep their order as a digit,
    so integers stay short however long the conversation is.
    """

    def __init__(self, entry: int = EMPTY):
        self.values: list[int | None] = [None] * 4
        self.values[entry] = 0
        self.beginnings: list[tuple | None] = [None]
        self.place = 0

    def walk(self, ways: tuple[Step, ...]) -> None:
        values, new = self.values, [None] * 4
        for p, q, weight in _weights(ways, self.place):
            at = values[p]
            if at is not None:
                at += weight
                if new[q] is None or at < new[q]:
                    new[q] = at
        self.values = new
        self.place += 1
        if self.place == BLOCK:
            self._turn()

    def _turn(self) -> None:
        mask = (1 << _ABOVE) - 1
        order = sorted({v & mask for v in self.values if v is not None})
        low = (1 << _LOW) - 1
        self.beginnings = [(self.beginnings[x >> _LOW], _spelled(x & low)) for x in order]
        self.values = [
            None if v is None else (v >> _ABOVE << _ABOVE) + (order.index(v & mask) << _LOW) for v in self.values
        ]
        self.place = 0

    def ends(self) -> list[tuple[int, int, str]]:
        """Every state that can be reached, with its cost and letters."""
        if self.place:
            self._turn()
        rank = lambda v: (v & ((1 << _ABOVE) - 1)) >> _LOW
        return [(q, v >> _ABOVE, _chained(self.beginnings[rank(v)])) for q, v in enumerate(self.values) if v is not None]

    def best(self) -> tuple[int, str]:
        """Cost and audit of the whole, closed."""
        self.walk(closing())
        least = min(v for v in self.values if v is not None)
        at = self.values.index(least)
        return next((cost, letters) for q, cost, letters in self.ends() if q == at)


def _spelled(digits: int) -> str:
    return f"{digits:o}".translate(_LETTERS)


def _chained(beginning: tuple | None) -> str:
    parts = []
    while beginning is not None:
        beginning, letters = beginning
        parts.append(letters)
    return "".join(reversed(parts))


def joined(parts: list[list[Step]]) -> tuple[int, str]:
    """Cost and audit over runs of one conversation, each given as its best ways between states."""
    least: dict[int, tuple[int, int]] = {EMPTY: (0, 0)}  # cost and rank of the beginning
    beginnings: list[tuple | None] = [None]
    for part in [*parts, list(closing())]:
        order = {w: k for k, w in enumerate(sorted({w for *_, w in part}))}
        found: dict[int, tuple[int, int, int, str]] = {}
        for p, q, cost, letters in part:
            if p in least:
                way = (least[p][0] + cost, least[p][1], order[letters], letters)
                if q not in found or way < found[q]:
                    found[q] = way
        ranks = sorted({(way[1], way[2], way[3]) for way in found.values()})
        beginnings = [(beginnings[r], letters) for r, _, letters in ranks]
        least = {q: (way[0], ranks.index(way[1:])) for q, way in found.items()}
    cost, rank = min(least.values())
    return cost, _chained(beginnings[rank])


class Repaired:
    """Digest of the rows that an audit leaves, fed row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, EMPTY
        self.digest, self.any = hashlib.sha256(), False

    def _say(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.any else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.any = True

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state = _INSERTED[self.state]
            self._say(_ROLE[self.state], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = follows(self.state, role[:1])
            self._say(role, text)
        elif letter == "R":
            self.state = _INSERTED[self.state]
            self._say(_ROLE[self.state], text)

    def sha256(self) -> str:
        self._inserted()
        return self.digest.hexdigest()


COUNTS = ("blank", "duplicate", "truncated", "illegal")


class Run:
    """Consecutive rows of one conversation: counts, turns, best ways between states, and the rows while they are few."""

    def __init__(self, conv_id: int | None, entries: tuple[int, ...]):
        self.conv_id = conv_id
        self.paths = {e: Paths(e) for e in entries}
        self.n = dict.fromkeys(COUNTS, 0)
        self.first = self.last = None
        self.turns = [None, None, 0]  # smallest, largest, how many
        self.rows: list[tuple[str, str]] | None = []
        self.chars = 0

    def feed(self, turn: int | None, role: str | None, text: str | None, copies: int, again: bool) -> None:
        if role is None or not copies:  # only says that the conversation exists
            return
        if turn is not None and turn != self.turns[1]:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]
        blank, cut = not _WORD.search(text), not _ENDED.search(text)
        initial = role[:1]
        if self.rows is not None:
            self.chars += copies * (len(text) + len(role) + 64)
            if self.chars > BUFFERED:
                self.rows = None
        for k in range(copies):
            repeated = again or k > 0
            fault = "blank" if blank else "duplicate" if repeated else "truncated" if cut else None
            if fault:
                self.n[fault] += 1
            if self.first is None:
                self.first = initial
            elif self.last + initial not in ("su", "ua", "au"):
                self.n["illegal"] += 1
            self.last = initial
            gone = blank or repeated
            ways = steps(initial if initial in ("s", "u", "a") else "", gone, cut and not gone)
            for paths in self.paths.values():
                paths.walk(ways)
            if self.rows is not None:
                self.rows.append((role, text))

    def gaps(self) -> int:
        return gaps(*self.turns)


def gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


_RUN = (
    "conv_id long, open boolean, part int, seq int, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string, first string, last string, low long, high long, turns long, "
    "ways array<struct<p:int,q:int,cost:long,letters:string>>"
)
_FIELDS = [f.split()[0] for f in _RUN.split(", ")]


def _batch(records: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(records, schema=schema)


def _arrow(fields: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([pa.field(n, t) for n, t in fields])


_WAY = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())])
_TYPES = {
    "open": pa.bool_(), "part": pa.int32(), "seq": pa.int32(), "audit": pa.string(), "repaired_sha256": pa.string(),
    "first": pa.string(), "last": pa.string(), "ways": pa.list_(_WAY),
}
_RUN_SCHEMA = _arrow([(f, _TYPES.get(f, pa.int64())) for f in _FIELDS])
RESULT = ["conv_id", "gaps", *COUNTS, "cost", "audit", "repaired_sha256"]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One record a conversation of the partition; the first, the last and very long ones stay open."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    run: Run | None = None
    seq = 0

    def record(open_: bool) -> dict:
        out = {"conv_id": run.conv_id, "part": part, "seq": seq, "first": run.first, "last": run.last}
        out |= {c: run.n[c] for c in COUNTS} | dict(zip(("low", "high", "turns"), run.turns)) | {"gaps": run.gaps()}
        out["open"] = open_ or run.rows is None
        if out["open"]:
            out["ways"] = [
                {"p": e, "q": q, "cost": c, "letters": w} for e, paths in run.paths.items() for q, c, w in paths.ends()
            ]
        else:
            out["cost"], out["audit"] = run.paths[EMPTY].best()
            said = Repaired(out["audit"])
            for row in run.rows:
                said.row(*row)
            out["repaired_sha256"] = said.sha256()
        return out

    for batch in batches:
        out = []
        for conv_id, turn, role, text, copies, again in zip(*(c.to_pylist() for c in batch.columns)):
            if run is None or conv_id != run.conv_id:
                if run is not None:
                    out.append(record(seq == 0))
                    seq += 1
                run = Run(conv_id, (EMPTY,) if seq else tuple(range(4)))
            run.feed(turn, role, text, copies, again)
        if out:
            yield _batch(out, _RUN_SCHEMA)
    if run is not None:
        yield _batch([record(True)], _RUN_SCHEMA)


def _joined_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The open records of a conversation, in order, to one with its cost and audit."""
    held: list[dict] = []

    def record() -> dict:
        out = {"conv_id": held[0]["conv_id"], **{c: sum(r[c] for r in held) for c in COUNTS}}
        last = high = low = None
        distinct = 0
        for r in held:
            if r["first"] is not None:
                out["illegal"] += last is not None and last + r["first"] not in ("su", "ua", "au")
                last = r["last"]
            if r["low"] is not None:
                distinct += r["turns"] - (r["low"] == high)
                low, high = (r["low"] if low is None else low), r["high"]
        out["gaps"] = gaps(low, high, distinct)
        out["cost"], out["audit"] = joined([[(w["p"], w["q"], w["cost"], w["letters"]) for w in r["ways"]] for r in held])
        return out

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held and held[0]["conv_id"] != row["conv_id"]:
                out.append(record())
                held = []
            held.append(row)
        if out:
            yield _batch(out, _RUN_SCHEMA)
    if held:
        yield _batch([record()], _RUN_SCHEMA)


_DIGEST_SCHEMA = _arrow([(f, _TYPES.get(f, pa.int64())) for f in RESULT])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation begins with the row that holds its audit; its other rows stream through the digest."""
    head: dict | None = None
    said: Repaired | None = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["audit"] is not None:
                if head is not None:
                    out.append(head | {"repaired_sha256": said.sha256()})
                head, said = {f: row[f] for f in RESULT if f in row}, Repaired(row["audit"])
            elif row["role"] is not None:
                for _ in range(row["copies"]):
                    said.row(row["role"], row["text"])
        if out:
            yield _batch(out, _DIGEST_SCHEMA)
    if head is not None:
        yield _batch([head | {"repaired_sha256": said.sha256()}], _DIGEST_SCHEMA)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``copies`` after damage by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row (``role`` NULL and no copy: the conversation stays known), 1 empties its text, 2 removes ``.!?``, 3
    repeats it, 4 makes it the user's. A NULL stands as one space in the checksum, the role and the text. Equal
    rows of a turn are one with their number, added up before the shuffle.
    """
    at = {c: i for i, c in reversed(list(enumerate(rows.columns)))}
    plain = rows.toDF(*[f"_c{i}" for i in range(len(rows.columns))])
    of = lambda name: F.col(f"_c{at[name]}")
    spaced = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    named = plain.select(
        of("conv_id").cast("long").alias("conv_id"), of("turn").cast("long").alias("turn"),
        spaced(of("role")).alias("role"), spaced(of("text")).alias("text"),
    )
    key = F.concat(spaced(F.col("conv_id")), F.lit(":"), spaced(F.col("turn")))
    harm = named.withColumn("harm", F.crc32(F.encode(key, "UTF-8")) % 20)
    stays = F.col("harm") != 0
    without = F.regexp_replace("text", "[.!?]", "")
    text = F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, without).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role"))
    return (
        harm.select(
            "conv_id", F.when(stays, F.col("turn")).alias("turn"), F.when(stays, role).alias("role"),
            F.when(stays, text).alias("text"), F.when(F.col("harm") == 3, 2).when(stays, 1).otherwise(0).alias("copies"),
        )
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").cast("long").alias("copies"))
    )


ORDER = ["conv_id", "turn", "role", "text"]  # NULLs first; rows of one turn by role and text


def repaired(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``gaps``, the fault counts, ``illegal``, ``cost``, ``audit``, ``repaired_sha256`` of every conversation.

    The table is damaged first (see ``damaged``); rows are taken by turn, NULL first, rows of one turn by role and text.
    A repeat is known by its first turn: role and text that stand in several turns are found by two
    64-bit hashes, combined before the shuffle, and joined back. Rows are then dealt by ranges
    of (conversation, turn, role, text), so a conversation of any length is spread over tasks. Each task
    finds the best ways through its run of rows; only the runs at the ends of a task, which may go on in the next
    one, are put together, two a task. The digest of such a conversation is a chain over all its rows by
    definition: they stream through one task in order, one batch held at a time.

    NULL conv_id is a conversation of its own; a role that begins with neither s, u nor a can't be kept;
    an empty table gives no row; other columns are ignored.
    """
    rows = settle(damaged(conversations))
    said = [F.xxhash64(F.lit(k), F.coalesce("conv_id", F.lit(0)), F.col("conv_id").isNull(), "role", "text").alias(f"h{k}") for k in (0, 1)]
    turn = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    hashed = rows.where("role IS NOT NULL").select(*said, turn.alias("turn"))
    several = settle(
        hashed.groupBy("h0", "h1").agg(F.min("turn").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    marked = (
        rows.select("*", *said)
        .join(several, ["h0", "h1"], "left")
        .select(*ORDER, "copies", F.coalesce(turn > F.col("first"), F.lit(False)).alias("again"))
    )
    dealt = marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    runs = settle(dealt.mapInArrow(_runs, _RUN))
    opened = runs.where("open").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    whole = settle(opened.mapInArrow(_joined_runs, _RUN).select(*RESULT))
    # At most two conversations a task of the sweep.
    ids = F.broadcast(whole.select(F.col("conv_id").alias("_of")))
    again = rows.join(ids, F.col("conv_id").eqNullSafe(F.col("_of")), "left_semi")
    both = whole.drop("repaired_sha256").unionByName(again, allowMissingColumns=True)
    streamed = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *ORDER[1:])
    types = {"audit": "string", "repaired_sha256": "string"}
    digested = streamed.mapInArrow(_digests, ", ".join(f"{f} {types.get(f, 'long')}" for f in RESULT))
    return runs.where("NOT open").select(*RESULT).unionByName(digested)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(common.read_table(spark, sf_dir, "conversations"))


OP11_SQL = r"""
WITH RECURSIVE harmed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(
                   string_split(concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), ''),
                   lambda c: ord(c)::BIGINT)),
               lambda crc, b: list_reduce(
                   list_prepend(xor(crc, b), list_transform(range(8), lambda x: x::BIGINT)),
                   lambda k, z: CASE WHEN k & 1 = 1 THEN xor(k >> 1, 3988292384::BIGINT) ELSE k >> 1 END)),
               4294967295::BIGINT) % 20 AS harm
    FROM conversations
), dealt AS (
    SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM harmed, range(CASE WHEN harm = 0 THEN 0 WHEN harm = 3 THEN 2 ELSE 1 END) AS copy(k)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dealt
), numbered AS (
    SELECT conv_id, turn, role, text, i, left(role, 1) AS initial,
           NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
           NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut
    FROM placed
), faults AS (
    SELECT *, blank OR seen AS gone, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM numbered
), inserts(p, mid, price, letters, said) AS (
    VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
           (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']), (3, 2, 2, 'I', ['user:']),
           (1, 3, 4, 'II', ['user:', 'assistant:'])
), edits(letter, mid, initial, q, price, role) AS (
    VALUES ('D', 0, NULL, 0, 3, NULL), ('D', 1, NULL, 1, 3, NULL), ('D', 2, NULL, 2, 3, NULL), ('D', 3, NULL, 3, 3, NULL),
           ('K', 0, 's', 1, 0, NULL), ('K', 0, 'u', 2, 0, NULL), ('K', 1, 'u', 2, 0, NULL), ('K', 3, 'u', 2, 0, NULL),
           ('K', 2, 'a', 3, 0, NULL), ('R', 0, NULL, 2, 2, 'user'), ('R', 1, NULL, 2, 2, 'user'),
           ('R', 3, NULL, 2, 2, 'user'), ('R', 2, NULL, 3, 2, 'assistant')
), ids AS (SELECT DISTINCT conv_id FROM conversations), walk AS (
    SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS said FROM ids
    UNION ALL
    SELECT w.conv_id, f.i, e.q, w.cost + n.price + e.price + CASE WHEN f.cut AND e.letter <> 'D' THEN 1 ELSE 0 END AS total,
           w.audit || n.letters || e.letter AS spelled,
           w.said || n.said || CASE WHEN e.letter = 'D' THEN [] ELSE [coalesce(e.role, f.role) || ':' || f.text] END
    FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    JOIN inserts n ON n.p = w.state
    JOIN edits e ON e.mid = n.mid AND (e.initial IS NULL OR e.initial = f.initial) AND (e.letter = 'D' OR NOT f.gone)
    QUALIFY row_number() OVER (PARTITION BY w.conv_id, e.q ORDER BY total, spelled) = 1
), closed AS (
    SELECT w.conv_id, w.cost + n.price AS cost, w.audit || n.letters AS audit, array_to_string(w.said || n.said, chr(10)) AS said
    FROM walk w JOIN inserts n ON n.p = w.state AND n.mid IN (0, 3) AND n.price <= 4
    WHERE NOT EXISTS (SELECT 1 FROM faults f WHERE f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i > w.i)
    QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + n.price, w.audit || n.letters) = 1
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate,
           count(*) FILTER (cut AND NOT gone) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
)
SELECT c.conv_id, coalesce(n.gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0)::BIGINT AS blank,
       coalesce(n.duplicate, 0)::BIGINT AS duplicate, coalesce(n.truncated, 0)::BIGINT AS truncated,
       coalesce(n.illegal, 0)::BIGINT AS illegal, c.cost, c.audit, sha256(c.said) AS repaired_sha256
FROM closed c LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
"""
