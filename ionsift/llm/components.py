"""Connected components, and links found through shared keys without listing the pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ionsift.session import settle, settle_and_watch

# Comparisons of marks in one block of ``linked``, for each row of its members.
PAIRS_PER_MEMBER = 256
PAIRS_PER_TASK = 200_000
SLICE = 1024  # nodes of a key that one task compares with all nodes of the key
CENTRES = 1  # further centres that nodes of large groups are compared with
SAMPLED = 16  # of large groups one node in so many is compared first, which joins most of what belongs together
PAIRS_AT_ONCE = 200_000  # confirmed in one go, or as many as there are members
PAIRS_PER_CENTRE = 5_000  # pairs of a node that one copy of its row serves
FEW_EDGES = 1_000_000
EDGES_PER_TASK = 100_000
FEW_TASKS = 8  # of a step over fewer edges than one task's share


def attach(df: DataFrame, key: str, **aggregates) -> DataFrame:
    """Group aggregates beside every row.

    Combined before the shuffle and written, so that the join back has a plain shuffle on both
    sides: adaptive execution can split a key that holds a large part of the rows.
    """
    groups = settle(df.groupBy(key).agg(*[a.alias(n) for n, a in aggregates.items()]))
    return df.join(groups, key)


def _stars(table: DataFrame, rows: int) -> bool:
    """Whether every edge leads from a node of its own straight to a centre, so that nothing can change."""
    ends = table.groupBy("a").agg(F.lit(True).alias("from")).join(table.select("b").distinct(), F.col("a") == F.col("b"), "left")
    seen = ends.agg(F.count(F.lit(1)).alias("n"), F.count("b").alias("both")).first()
    return seen["n"] == rows and not seen["both"]


def _steps(table: DataFrame) -> DataFrame:
    """A large-star and a small-star step; groups are combined before the shuffle, and the joins back can be split."""
    both = table.unionByName(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = (
        attach(both, "a", low=F.least(F.min("a"), F.min("b")))
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
    )
    large = settle(large.distinct())
    low = attach(large, "a", low=F.min("b"))
    return _pointed(low).distinct()


def _few_steps(table: DataFrame, rows: int) -> DataFrame:
    """The same for at most ``FEW_EDGES`` rows: each step is one shuffle to as many tasks as they are worth.

    Partitions beyond that, where the cluster deals out more, are read several by one task.
    """
    tasks = 1 + rows // EDGES_PER_TASK
    at_most = _few_tasks(rows)
    of_a = Window.partitionBy("a")
    both = table.unionByName(table.select(F.col("b").alias("a"), F.col("a").alias("b"))).repartition(tasks, "a")
    large = both.withColumn("low", F.least("a", F.min("b").over(of_a))).where("b > a")
    large = large.select(F.col("b").alias("a"), F.col("low").alias("b")).coalesce(at_most).repartition(tasks, "a").distinct()
    low = large.withColumn("low", F.min("b").over(of_a)).coalesce(at_most)
    return _pointed(low).repartition(tasks, "a").distinct().coalesce(at_most)


def _few_tasks(rows: int) -> int:
    return FEW_TASKS + rows // EDGES_PER_TASK


def _pointed(low: DataFrame) -> DataFrame:
    """Every node and its neighbours led to its smallest one."""
    return low.select("a", F.col("low").alias("b")).unionByName(
        low.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node that has an edge ``a``-``b``.

    Alternating large-star and small-star steps: each moves edges to the smallest known neighbour
    until nothing changes, in a few rounds on groups that hang on one centre and logarithmically
    many on chains. Edges go through the shuffle only; the driver sees a row count and a checksum.
    Repeated edges, loops and NULL ends are ignored.
    """
    checksum = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    plain = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    table, before = settle_and_watch(plain, sum=checksum)
    while before["rows"]:
        small = before["rows"] <= FEW_EDGES
        table, now = settle_and_watch(_few_steps(table, before["rows"]) if small else _steps(table), sum=checksum)
        if now == before or (not small and _stars(table, now["rows"])):
            break
        before = now
    heads = table.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    if before["rows"] <= FEW_EDGES:
        heads = heads.coalesce(_few_tasks(before["rows"]))
    return table.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(heads)


def shared_keys(members: DataFrame) -> DataFrame:
    """Rows (``key``, ``node``) whose key several rows have, with the key's smallest node as ``centre``; written.

    Counts are combined before the shuffle; the join back is one that adaptive execution splits.
    """
    groups = members.groupBy("key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("_n"))
    keys = settle(groups.where("_n > 1").drop("_n"))
    return settle(members.select("key", "node").join(keys, "key"))


def linked(
    shared: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    marks: DataFrame,
    alike: Callable[[Column, Column], Column],
    texts: DataFrame | None = None,
    sure: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """``node`` and ``component`` under the links that ``verify`` confirms among nodes sharing a key.

    ``shared`` has ``key``, ``node`` and a ``centre`` for each key, and may have the centre's ``weight``. ``verify`` takes distinct pairs (``a``, ``b``) and returns those that are
    links. ``marks`` has a ``mark`` of every ``node``; pairs whose marks are not ``alike`` are no links.

    A group is not expanded into its pairs: first each node is compared with one centre of its keys, the weightiest
    or else the smallest, which joins the groups of copies. Only keys whose nodes still lie in several components go on. Where those hold
    many pairs, each node is compared with a further centre, picked by hash, and then one node in ``SAMPLED`` with all, which
    makes one of a large family. What is then still apart is compared across components: of the pairs of a key those with marks
    alike are listed, in as many blocks as keep a block's comparisons linear in the members, and a key of many
    nodes is cut in slices, so that the work is spread by pairs and not by rows. A pair with several keys is listed
    for the smallest of them only. No pair that could join two components
    is left out, so the components are those of all links.

    Where ``sure`` tells a link from the ``text`` of both nodes, that ``texts`` has, the pairs across components are not even
    listed: they are told in the join that finds them, and links alone leave it.
    """
    centre = F.max_by("centre", F.struct("weight", "centre")) if "weight" in shared.columns else F.min("centre")
    best = shared.where("node <> centre").groupBy(F.col("node").alias("b")).agg(centre.alias("a"))
    links = settle(verify(_alike(best.select("a", "b"), marks, alike)).select("a", "b"))
    found = settle(components(links))
    rest, turn, block, blocks = shared.select("key", "node"), 0, 0, 0
    while not blocks or block < blocks:
        own = F.coalesce("component", "node").alias("component")
        placed = settle(rest.join(found, "node", "left").select("key", "node", own))
        spans = placed.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"),
            F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(turn))).alias("centre"),
        )
        of_key = F.col("n").cast("decimal(20,0)") * (F.col("n") - 1) / 2
        apart, seen = settle_and_watch(spans.where("low <> high"), pairs=F.sum(of_key), members=F.sum("n"))
        if not seen["rows"]:
            break
        pairs, members = int(seen["pairs"]), int(seen["members"])
        placed = placed.join(apart, "key").select("key", "node", "component", "n", "centre")
        rest = placed.select("key", "node")
        if not blocks and turn < CENTRES and pairs > CENTRES * max(members, 50_000):
            other = placed.where("component <> centre.component")
            star = other.groupBy(F.col("node").alias("b")).agg(F.min("centre.node").alias("a"))
            more, confirmed = settle_and_watch(verify(_alike(star.select("a", "b"), marks, alike)).select("a", "b"))
            links = links.unionByName(more)
            found = settle(components(links)) if confirmed["rows"] else found
            turn += 1
            continue
        if not blocks:
            sampled = pairs > SAMPLED * max(members, 50_000)
            blocks = int(sampled) + max(1, -(-pairs // max(PAIRS_PER_MEMBER * members, 1_000_000)))
        marked = settle(placed.drop("centre").join(_keys_of(placed).join(marks, "node"), "node"))
        # A sampled first block, then the others evenly.
        turns = F.pmod(F.xxhash64("node"), F.lit(SAMPLED * max(1, blocks - 1)))
        turn_of = F.when(turns % SAMPLED == 0, 0).otherwise(1 + F.floor(turns / SAMPLED)) if sampled else turns % blocks
        now = marked.where(turn_of == block) if blocks > 1 else marked
        # Laid out by the number of pairs, which adaptive execution does not know and so leaves alone.
        tasks = min(10_000, max(1, pairs // blocks // PAIRS_PER_TASK))
        if sure is None:
            listed = _listed(now, marked, alike, tasks)
            links, found = _confirmed(listed, links, found, verify, max(members, PAIRS_AT_ONCE))
        else:
            ends = settle(_with_alike(marked, now, alike, tasks))
            starts = settle(_with_alike(now, marked, alike, tasks)) if blocks > 1 else ends
            told = _listed(starts.join(texts, "node"), ends.join(texts, "node"), alike, tasks, sure)
            more, confirmed = settle_and_watch(told)
            links = links.unionByName(more)
            found = settle(components(links)) if confirmed["rows"] else found
        block += 1
    return found


def _keys_of(placed: DataFrame) -> DataFrame:
    """The ``keys`` of every ``node``."""
    return placed.groupBy("node").agg(F.collect_set("key").alias("keys"))


def _sides(now: DataFrame, marked: DataFrame, tasks: int, columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Both tables dealt by key and slice, the nodes ``now`` to one slice of a key each and ``marked`` to all."""
    slices = F.ceil(F.col("n") / SLICE).cast("int")
    one = now.select(
        "key", F.pmod(F.xxhash64("node", F.lit(7)), slices).cast("int").alias("slice"), *[F.col(c).alias(f"{c}_a") for c in columns]
    )
    other = marked.select(
        "key", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), *[F.col(c).alias(f"{c}_b") for c in columns]
    )
    return one.repartition(tasks, "key", "slice"), other.repartition(tasks, "key", "slice")


def _with_alike(now: DataFrame, marked: DataFrame, alike: Callable[[Column, Column], Column], tasks: int) -> DataFrame:
    """The rows of ``now`` with a node of their key in ``marked`` that lies in another component and has its mark alike."""
    columns = ("node", "component", "mark", "keys", "n")
    one, other = _sides(now, marked, tasks, columns)
    same = (one["key"] == other["key"]) & (one["slice"] == other["slice"])
    found = one.join(other, same & (F.col("component_a") != F.col("component_b")) & alike(F.col("mark_a"), F.col("mark_b")), "left_semi")
    return found.select("key", *[F.col(f"{c}_a").alias(c) for c in columns])


def _listed(
    now: DataFrame,
    marked: DataFrame,
    alike: Callable[[Column, Column], Column],
    tasks: int,
    sure: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Pairs of the nodes ``now`` with greater ones of their keys that lie in other components and have marks alike.

    Both tables have a row for each ``key`` of a ``node``, with the number ``n`` of the key's nodes and the node's ``keys``. A pair
    is listed for the smallest key that both have, so once, whatever number of keys they share. With ``sure`` both have
    a ``text`` as well, and only pairs that it confirms are listed.
    """
    one, other = _sides(now, marked, tasks, ("node", "component", "mark", "keys", *(["text"] if sure else [])))
    may = (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
    same = (one["key"] == other["key"]) & (one["slice"] == other["slice"])
    once = one["key"] == F.array_min(F.array_intersect("keys_a", "keys_b"))
    told = same & may & alike(F.col("mark_a"), F.col("mark_b")) & once
    pairs = one.join(other, told & sure(F.col("text_a"), F.col("text_b")) if sure else told)
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def _alike(pairs: DataFrame, marks: DataFrame, alike: Callable[[Column, Column], Column]) -> DataFrame:
    """The pairs that their marks do not rule out."""
    for end in "ab":
        pairs = pairs.join(marks.select(F.col("node").alias(end), F.col("mark").alias(f"mark_{end}")), end)
    return pairs.where(alike(F.col("mark_a"), F.col("mark_b"))).select("a", "b")


def with_sides(pairs: DataFrame, held: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct pairs (``a``, ``b``) with the ``columns`` of both nodes from ``held`` as ``<column>_a`` and ``<column>_b``.

    A node in very many pairs, the centre of a large group, has its row copied to as many parts as share them.
    """
    pairs, seen = settle_and_watch(pairs)
    if seen["rows"] <= PAIRS_PER_CENTRE:
        for end in "ab":
            pairs = pairs.join(held.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
        return pairs
    of_a, of_b = (pairs.groupBy(F.col(e).alias("node")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PAIRS_PER_CENTRE) for e in "ab")
    hot = settle(of_a.unionByName(of_b).groupBy("node").agg(F.ceil(F.max("n") / PAIRS_PER_CENTRE).cast("int").alias("parts")))
    # Only rows of such nodes are copied; all others have one part.
    copies = held.join(hot, "node").withColumn("part", F.explode(F.sequence(F.lit(1), F.col("parts") - 1))).drop("parts")
    side = held.withColumn("part", F.lit(0)).unionByName(copies)
    for end, far in ("ab", "ba"):
        parts = hot.select(F.col("node").alias(end), "parts")
        part = F.coalesce(F.pmod(F.xxhash64(far), F.col("parts")), F.lit(0)).cast("int")
        named = side.select(F.col("node").alias(end), "part", *[F.col(c).alias(f"{c}_{end}") for c in columns])
        pairs = pairs.join(parts, end, "left").withColumn("part", part).drop("parts").join(named, [end, "part"]).drop("part")
    return pairs


def _confirmed(pairs: DataFrame, links: DataFrame, found: DataFrame, verify, limit: int) -> tuple[DataFrame, DataFrame]:
    """Links and components after every pair was confirmed, refused, or found to lie in one component already.

    Many pairs are not confirmed at once: first one for each node, which joins most of what
    belongs together, then the pairs that are still apart in blocks of about ``limit``. How many blocks there
    are and which one a pair is in are settled once, so every pair's turn comes, whatever is refused before it.
    """
    pending, seen = settle_and_watch(pairs)
    if not seen["rows"]:
        return links, found

    def confirm(batch: DataFrame) -> None:
        nonlocal links, found
        more, confirmed = settle_and_watch(verify(batch).select("a", "b"))
        links = links.unionByName(more)
        if confirmed["rows"]:
            found = settle(components(links))

    if seen["rows"] <= limit:
        confirm(pending)
        return links, found
    first = settle(pending.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    confirm(first)
    pending, seen = settle_and_watch(_apart(pending.join(first, ["a", "b"], "left_anti"), found))
    blocks = -(-seen["rows"] // limit)
    if blocks > 1:
        pending = settle(pending.withColumn("block", F.pmod(F.xxhash64("a", "b"), F.lit(blocks))))
    for block in range(blocks):
        confirm(_apart(pending.where(F.col("block") == block), found) if blocks > 1 else pending)
    return links, found


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    for end in ("a", "b"):
        of_end = found.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(of_end, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    return pairs.where("of_a <> of_b").select("a", "b")
