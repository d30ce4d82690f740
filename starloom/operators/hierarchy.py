"""Parent-child links to full hierarchies.

Pointer jumping over hash splitters.  Whether a node is a splitter follows from its id alone, so
a walk knows where to stop without a look-up.

1. Every node walks to its next splitter or to its root.  Pointers double each round; a walk of w
   links takes log2(w) joins and w is a few times ``splitter_every``.
2. The splitters alone, linked to their next splitters, are a graph smaller by that factor; it is
   solved by doubling too.
3. Every node adds what its splitter knows: root, depth, cycle.

A walk that meets neither splitter nor root runs into a cycle without splitters.  Those are told
by counting.  A walk of finite length at least 2^r passes a node from which it is exactly 2^r, so
while any are left a round must finish some: a round that finishes none leaves walks without end
only.  U of those stay among their own U nodes, so after U links each stands on its cycle.  The
same counts end step 2.  No node is ever sent to the driver and no path is built before the cycles
are known, so a cycle of any length costs no more than a chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators.ordering import neighbour, rank_within
from starloom.operators.skew import look_up
from starloom.sources.tables import Scratch

SPLITTER_EVERY = 8
BROADCAST_ROWS = 200_000  #: nodes up to which a table of pointers is broadcast


def _is_splitter(c: Column, every: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(every)) == 0


def _at_pointer(left: DataFrame, there: DataFrame, rows: int) -> DataFrame:
    """left with what ``there`` (each __sl_id once) holds for its ptr; many rows may point at one node, as in a star."""
    return look_up(left, there.withColumnRenamed("__sl_id", "ptr"), "ptr", F.col("id"), rows=rows, broadcast_rows=BROADCAST_ROWS)


def _double(table: DataFrame, scratch: Scratch, carried: list[str]) -> DataFrame:
    """Follow pointers until every row is done or has gone further than there are open rows.

    table: id, ptr, hops, low (least id met), done and the ``carried`` columns, which a row takes
    from the done row it meets.  ``path``, where carried, is put together instead.
    """
    said = table.agg(F.count(F.lit(1)), F.count_if(~F.col("done"))).first()
    steps, open_rows, (rows, found) = 1, None, said
    while found and not (found == open_rows and steps >= found):
        open_rows = found
        there = table.select(*(F.col(c).alias(f"__sl_{c}") for c in ["id", "ptr", "hops", "low", "done", *carried]))
        moved = _at_pointer(table.filter(~F.col("done")), there, rows)
        moved = moved.select(
            "id",
            F.coalesce("__sl_ptr", "ptr").alias("ptr"),
            (F.col("hops") + F.col("__sl_hops")).alias("hops"),
            F.least("low", "__sl_low").alias("low"),
            F.col("__sl_done").alias("done"),
            *(F.concat("path", "__sl_path").alias("path") if c == "path" else F.col(f"__sl_{c}").alias(c) for c in carried),
        )
        seen = Observation()
        new = table.filter("done").unionByName(moved).observe(seen, F.count_if(~F.col("done")).alias("left"))
        new = scratch.put(new)
        scratch.drop(table)
        table, steps, found = new, steps * 2, seen.get["left"]
    return table


def _with_cycles(table: DataFrame) -> DataFrame:
    """cycle of the rows that never got done: the least id from where they stand, once around."""
    there = table.filter(~F.col("done")).select(F.col("id").alias("ptr"), F.col("low").alias("__sl_low"))
    stuck = look_up(table.filter(~F.col("done")), there, "ptr", F.col("id"), how="inner", broadcast_rows=BROADCAST_ROWS)
    return table.filter("done").unionByName(stuck.withColumn("cycle", F.col("__sl_low")).select(*table.columns))


def _solve(links: DataFrame, scratch: Scratch, every: int, paths: bool) -> DataFrame:
    """links: id, parent (null: none), each id once, each parent an id."""
    extra = ["path"] if paths else []
    first = {"path": F.when(F.col("parent").isNull(), F.expr("cast(array() as array<bigint>)")).otherwise(F.array("parent"))} if paths else {}
    walk = links.select(
        "id",
        F.col("parent").alias("ptr"),
        F.when(F.col("parent").isNull(), 0).otherwise(1).cast("bigint").alias("hops"),
        F.least("id", "parent").alias("low"),
        (F.col("parent").isNull() | _is_splitter(F.col("parent"), every)).alias("done"),
        F.lit(None).cast("bigint").alias("cycle"),
        *(c.alias(k) for k, c in first.items()),
    )
    walk = scratch.put(walk)
    walk = _double(walk, scratch, ["cycle", *extra])
    walk = scratch.put(_with_cycles(walk))
    ends = F.col("ptr").isNull() | ~_is_splitter(F.col("ptr"), every) | F.col("cycle").isNotNull()
    reduced = scratch.put(walk.filter(_is_splitter(F.col("id"), every)).withColumn("done", ends))
    reduced = _with_cycles(_double(reduced, scratch, ["cycle", *extra]))
    reduced = reduced.select(*(F.col(c).alias(f"__sl_{c}") for c in ["id", "ptr", "hops", "cycle", *extra]))
    # a node that ends on a cycle of its own takes nothing from its splitter
    goes_on = F.col("cycle").isNull() & _is_splitter(F.col("ptr"), every)
    reduced = reduced.withColumn("__sl_goes_on", F.lit(True)).withColumnRenamed("__sl_id", "__sl_at")
    out = look_up(walk.withColumn("__sl_at", F.when(goes_on, F.col("ptr"))), reduced, "__sl_at", F.col("id"), broadcast_rows=BROADCAST_ROWS)
    cycle = F.coalesce("cycle", "__sl_cycle")
    return out.select(
        "id",
        F.when(cycle.isNull(), F.coalesce("__sl_ptr", "ptr", "id")).alias("root"),
        F.when(cycle.isNull(), F.col("hops") + F.coalesce("__sl_hops", F.lit(0))).alias("depth"),
        cycle.alias("cycle_key"),
        *([F.concat("path", F.coalesce("__sl_path", F.expr("cast(array() as array<bigint>)"))).alias("up")] if paths else []),
    )


def links_of(nodes: DataFrame) -> DataFrame:
    """nodes (id, parent) as bigint links in which each id occurs once and each parent is an id.

    Null ids are left out.  Of an id with several parents the least counts.  A parent that is no
    id counts as none.
    """
    n = nodes.select(F.col("id").cast("bigint").alias("id"), F.col("parent").cast("bigint").alias("parent"))
    n = n.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("parent").alias("parent"))
    known = n.select(F.col("id").alias("parent"), F.col("id").alias("__sl_known"))
    return look_up(n, known, "parent", F.col("id"), broadcast_rows=BROADCAST_ROWS).select("id", F.col("__sl_known").alias("parent"))


def resolve(spark: SparkSession, nodes: DataFrame, splitter_every: int = SPLITTER_EVERY) -> DataFrame:
    """id, root, depth, cycle_key for each id of nodes (id, parent).

    root and depth are null for nodes on a cycle or below one; cycle_key is then the least id on
    that cycle, and else null.  A node that is its own parent is a cycle.  See links_of for nulls,
    repeated ids and unknown parents.  No rows give no rows.
    """
    scratch = Scratch(spark)
    return _solve(scratch.put(links_of(nodes)), scratch, splitter_every, paths=False)


def paths(spark: SparkSession, nodes: DataFrame, splitter_every: int = SPLITTER_EVERY) -> DataFrame:
    """id, parent, root, depth, path (ids from the root to the node), cycle_key.

    Nodes on a cycle or below one have no path, root or depth.  The sum of all path lengths is
    the size of the result, whatever the plan.
    """
    scratch = Scratch(spark)
    links = scratch.put(links_of(nodes))
    told = scratch.put(_solve(links, scratch, splitter_every, paths=False))
    endless = told.filter(F.col("cycle_key").isNotNull())
    ends = links.join(endless.select("id"), "id", "left_anti")
    found = _solve(scratch.put(ends), scratch, splitter_every, paths=True)
    path = F.reverse(F.concat(F.array("id"), "up"))
    out = found.select("id", "root", "depth", path.alias("path"), "cycle_key")
    nothing = endless.select("id", "root", "depth", F.lit(None).cast("array<bigint>").alias("path"), "cycle_key")
    return out.unionByName(nothing).join(links, "id").select("id", "parent", "root", "depth", "path", "cycle_key")


def subtree_sizes(spark: SparkSession, nodes: DataFrame, splitter_every: int = SPLITTER_EVERY) -> DataFrame:
    """id, descendants: how many nodes are below each node that is neither on a cycle nor below one.

    No pair of ancestor and descendant is made.  Each tree's Euler tour goes into a node, around its
    children and out again; it is one chain of two links for each node, whose positions resolve() finds
    as depths.  What lies between a node's way in and its way out is its subtree, twice.
    """
    scratch = Scratch(spark)
    links = scratch.put(links_of(nodes))
    told = resolve(spark, links, splitter_every)
    ends = links.join(told.filter(F.col("cycle_key").isNull()).select("id"), "id", "left_semi")
    coded = rank_within(ends.select("id").withColumn("__sl_all", F.lit(0)), ["__sl_all"], "id", "no", 64).select("id", "no")  # ids may be as large as their type
    coded = scratch.put(coded)
    n = look_up(ends.join(coded, "id"), coded.select(F.col("id").alias("parent"), F.col("no").alias("above")), "parent", F.col("id"))
    n = scratch.put(n.select("id", "no", "above"))
    into, out_of = (lambda c: F.col(c) * 2), (lambda c: F.col(c) * 2 + 1)
    # a hot parent's children are put in order by buckets
    following = neighbour(n.filter(F.col("above").isNotNull()), ["above"], "no", F.col("no"), "__sl_next", F.floor(F.col("no") / 50_000), following=True)
    onward = following.select(out_of("no").alias("id"), F.coalesce(F.col("__sl_next.value") * 2, out_of("above")).alias("parent"))
    ends_here = n.filter(F.col("above").isNull()).select(out_of("no").alias("id"), F.lit(None).cast("bigint").alias("parent"))
    first = n.filter(F.col("above").isNotNull()).groupBy(F.col("above").alias("no")).agg(F.min("no").alias("child"))
    inward = n.join(first, "no", "left").select(into("no").alias("id"), F.coalesce(F.col("child") * 2, out_of("no")).alias("parent"))
    at = resolve(spark, onward.unionByName(ends_here).unionByName(inward), splitter_every)
    span = at.groupBy(F.floor(F.col("id") / 2).alias("no")).agg((F.max("depth") - F.min("depth")).alias("links"))
    return n.join(span, "no").select("id", F.floor((F.col("links") - 1) / 2).cast("bigint").alias("descendants"))


def descendants(hierarchy: DataFrame) -> DataFrame:
    """ancestor, descendant, distance: one row for each node and each node above it in its path."""
    each = hierarchy.filter(F.col("path").isNotNull()).select(
        F.col("id").alias("descendant"), "depth", F.posexplode("path").alias("at", "ancestor")
    )
    return each.filter(F.col("at") < F.col("depth")).select("ancestor", "descendant", (F.col("depth") - F.col("at")).alias("distance"))
