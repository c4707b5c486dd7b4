"""Conversation repair against an independent search over whole strings, and its SQL."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ionsift.llm.conversations import Paths, closing, joined, op11_conversation_repair, repaired, steps

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    """The contract, row by row, with the least (cost, audit) found backwards over whole strings."""
    convs = {}
    for conv_id, turn, role, text in rows:
        held = convs.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        harm = zlib.crc32(name.encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        held += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return {c: one(sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))) for c, v in convs.items()}


def one(rows):
    n, seen, faults = dict(blank=0, duplicate=0, truncated=0), set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        if fault:
            n[fault] += 1
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    # What may follow: nothing yet, system, user, assistant.
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}
    best = {s: (0, "", []) if s in ("", "a") else None for s in after}

    def with_inserts(best):
        for _ in range(3):
            for s in after:
                for r in after[s]:
                    if r in full and best.get(r):
                        c, w, said = best[r]
                        option = (c + 2, "I" + w, [full[r] + ":", *said])
                        if best[s] is None or option[:2] < best[s][:2]:
                            best[s] = option
        return best

    best = with_inserts(best)
    for (_, role, text), fault in reversed(list(zip(rows, faults))):
        new, late = {}, fault == "truncated"
        for s in after:
            c, w, said = best[s]
            options = [(c + 3, "D" + w, said)]
            if fault not in ("blank", "duplicate"):
                for r in after[s]:
                    c, w, said = best[r]
                    if role[:1] == r:
                        options.append((c + late, "K" + w, [role + ":" + text, *said]))
                    if r in full:
                        options.append((c + 2 + late, "R" + w, [full[r] + ":" + text, *said]))
            new[s] = min(options, key=lambda o: o[:2])
        best = with_inserts(new)
    cost, audit, said = best[""]
    gap = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
    return (gap, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, digest)


def made(seed, convs, turns):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "so", "", " \t", "Why?", "A. b", "Ünd…", "x"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "User", "", None]
    rows = []
    for c in range(convs):
        for t in range(r.randint(0, turns)):
            turn = r.choice([t, t, t, t + r.randint(0, 3), None])
            rows.append((c if c else None, turn, r.choice(roles), r.choice([*texts, *texts, f"text {t}.", f"text {t}", None])))
    r.shuffle(rows)
    return rows + rows[:5]


def run(spark, rows, parts=3):
    got = repaired(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    out = {r["conv_id"]: tuple(r)[1:] for r in got}
    assert len(out) == len(got)
    return out


def test_equals_search_over_strings(spark):
    rows = made(1, 150, 9)
    assert run(spark, rows) == expected(rows)


def test_long_conversations_over_many_tasks(spark):
    rows = made(2, 3, 700) + [(9, t, "user", "Same first turn.") for t in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, rows) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_held_for_the_digest_are_bounded(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "a" * 300_000 + f"{t}.") for c in range(4) for t in range(20)]
    assert run(spark, rows) == expected(rows)


def test_runs_put_together_equal_one_run():
    r = random.Random(5)
    for _ in range(60):
        ways = [steps(r.choice(["s", "u", "a", ""]), r.random() < 0.2, r.random() < 0.3) for _ in range(r.randint(0, 200))]
        whole = Paths()
        for w in ways:
            whole.walk(w)
        parts, at = [], 0
        while at < len(ways):
            end = at + r.randint(1, 70)
            part = []
            for entry in range(4):
                paths = Paths(entry)
                for w in ways[at:end]:
                    paths.walk(w)
                part += [(entry, *x) for x in paths.ends()]
            parts.append(part)
            at = end
        assert whole.best() == joined(parts)
    assert closing()[2][2:] == (2, "I")


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repaired(empty).collect() == []
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "system", "Be kind.")]
    plain = spark.createDataFrame(rows, SCHEMA)
    wide = plain.select("*", F.lit("x").alias("TEXT"), F.lit(1).alias("copies"), F.lit(2).alias("h0"), F.lit(3).alias("audit"))
    assert sorted(map(tuple, repaired(wide).collect())) == sorted(map(tuple, repaired(plain).collect()))


def test_conversation_that_lost_every_row(spark):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = run(spark, [(gone, 0, "user", "Hi."), (gone, 0, "user", "Hi.")])
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_equals_the_search(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in op11_conversation_repair(spark, f"/root/testdata/{sf}").collect()}
    assert got == expected(rows)
