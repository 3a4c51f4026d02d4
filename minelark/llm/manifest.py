"""A Merkle manifest of a table: leaves, roots and proofs, with each level of an aligned block kept as one hex string."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minelark.llm.texts import ascii_lower, quoted
from minelark.plans.lineage import settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
BLOCK_LEVELS = 3  # a block holds FAN ** BLOCK_LEVELS nodes
WIDTH = 64  # hex digits of a digest


def digest(*parts: Column) -> Column:
    """The lowercase hex sha256 of strings, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """The digest of the fields of a row: each ``-`` if null, else its UTF-8 bytes, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def lowered_leaf(of: Sequence[str] = FIELDS) -> Column:
    """The leaf of a row whose ``text`` has its A-Z lower-cased."""
    return leaf_of([ascii_lower(F.col(f)) if f == "text" else F.col(f) for f in of])


def runs(level: Column) -> Column:
    """A level's string in runs of ``FAN`` digests: substrings of a fixed width, of which the last may be shorter."""
    width = FAN * WIDTH
    places = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / width).cast("int"))
    return F.transform(places, lambda k: F.substr(level, k * width + 1, F.lit(width)))


def parent_level(level: Column) -> Column:
    """The string of the level above: the digest of each run, one after the other."""
    return F.array_join(F.transform(runs(level), lambda run: F.sha2(run.cast("binary"), 256)), "")


def flanks(run: Column, at: Column) -> Column:
    """The siblings of a node at place ``at`` of its run: the parts of the run's string before and behind it."""
    before = (at * WIDTH).cast("int")
    return F.struct(
        F.substr(run, F.lit(1), before).alias("before"), F.substr(run, before + WIDTH + 1, F.lit(FAN * WIDTH)).alias("behind")
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf leads to with these siblings."""
    return F.aggregate(proof, leaf, lambda node, side: F.sha2(F.concat(side.before, node, side.behind).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda side: F.concat(side.before, side.behind)), "").cast("binary"), 256)


def placed(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add ``at``, the place of a row in its group (from 0), and ``total``, the group's size.

    Rows are sorted by range over all partitions; places follow from the number of rows before each group's part in a
    partition. So no group is ever sorted or counted by one task.
    """
    keys = [*quoted(group), *quoted(order)]
    row = F.monotonically_increasing_id()
    rows = settle(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mm_row", row))
    part = F.shiftright("_mm_row", 33)
    parts = rows.groupBy(*quoted(group), part.alias("_mm_part")).agg(F.min("_mm_row").alias("_mm_first"), F.count(F.lit(1)).alias("_mm_n"))
    by = ", ".join(f"`{g}`" for g in group) or "1"
    parts = settle(parts.withColumns({
        "_mm_before": F.expr(f"sum(_mm_n) over (partition by {by} order by _mm_part) - _mm_n"),
        "total": F.expr(f"sum(_mm_n) over (partition by {by})"),
    }))
    same = part == F.col("_mm_p")
    for g in group:
        same &= F.col(f"`{g}`").eqNullSafe(F.col(f"`_mm_{g}`"))
    parts = parts.withColumnsRenamed({g: f"_mm_{g}" for g in group}).withColumnRenamed("_mm_part", "_mm_p")
    at = (F.col("_mm_row") - F.col("_mm_first") + F.col("_mm_before")).cast("long")
    done = rows.join(parts, same).withColumn("at", at)
    return done.drop("_mm_row", "_mm_first", "_mm_n", "_mm_before", "_mm_p", *[f"_mm_{g}" for g in group])


def blocks_of(nodes: DataFrame, group: list[str]) -> DataFrame:
    """Aligned blocks of nodes: ``group..., block, total, members, l0, l1, ..., top``.

    ``nodes`` has ``at`` and ``total`` (see :func:`placed`), a digest ``node``, and what else ``members`` is to carry. The
    levels of a block are the strings ``l<k>``; ``top`` is the node that the block becomes. A group of one block is
    followed up to its root, other blocks over all their levels.
    """
    size = FAN**BLOCK_LEVELS
    others = [c for c in nodes.columns if c not in (*group, "at", "total", "node")]
    member = F.struct((F.col("at") % size).cast("int").alias("at"), F.col("node"), *quoted(others))
    block = F.floor(F.col("at") / size).alias("block")
    gathered = nodes.groupBy(*quoted(group), block, "total").agg(F.array_sort(F.collect_list(member)).alias("members"))
    gathered = gathered.withColumn("l0", F.array_join(F.transform("members", lambda m: m.node), ""))
    single = F.col("total") <= size
    top = F.col("l0")
    for level in range(1, BLOCK_LEVELS + 1):
        below = F.col(f"l{level - 1}")
        goes_on = ~single | (F.length(below) > WIDTH)
        gathered = gathered.withColumn(f"l{level}", F.when(below.isNotNull() & goes_on, parent_level(below)))
        top = F.coalesce(F.col(f"l{level}"), top)
    return gathered.withColumn("top", top)


def paths_of(blocks: DataFrame) -> Column:
    """Per member of a block its siblings on all levels of the block, and then those ``up`` from the block.

    ``blocks`` has the runs of each level that has one above it as ``r<k>``.
    """

    def path(member: Column) -> Column:
        steps, place = [], member.at
        for level in range(BLOCK_LEVELS):
            run = F.get(f"r{level}", F.floor(place / FAN).cast("int"))
            steps.append(F.when(run.isNotNull(), flanks(run, place % FAN)))
            place = F.floor(place / FAN).cast("int")
        return F.concat(F.array_compact(F.array(*steps)), F.col("up"))

    return F.transform("members", path)


def tree(rows: DataFrame, group: list[str], order: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The steps of a tree per group, each a stored table of blocks, and ``group..., root, height`` of all groups.

    The blocks of a step are the nodes of the next one. A group of one block ends there: ``height`` is the step.
    """
    nodes, steps, size = placed(rows, group, order), [], FAN**BLOCK_LEVELS
    while True:
        step = settle(blocks_of(nodes, group))
        steps.append(step)
        single = F.col("total") <= size
        ends = step.where(single).select(*quoted(group), F.col("top").alias("root"), F.lit(len(steps) - 1).alias("height"))
        found = ends if len(steps) == 1 else found.unionByName(ends)
        further = step.where(~single)
        if further.isEmpty():
            return steps, settle(found)
        total = F.ceil(F.col("total") / size).cast("long").alias("total")
        nodes = further.select(*quoted(group), F.col("block").alias("at"), total, F.col("top").alias("node"))


def descended(steps: list[DataFrame], group: list[str], above: DataFrame) -> DataFrame:
    """The members of the first step with ``proof``: their siblings up to the root of their group, and those above it.

    ``above`` has per group its ``height``, the siblings ``up`` from its root and what else its members are to be given.
    From the last step to the first, blocks are joined to the paths of the nodes that they are in the next step.
    """
    given = [c for c in above.columns if c not in (*group, "height")]
    members = None
    for height in reversed(range(len(steps))):
        ups = above.where(F.col("height") == height).select(*quoted(group), F.lit(0).cast("long").alias("at"), *given)
        if members is not None:
            ups = ups.unionByName(members.withColumnRenamed("proof", "up").select(*quoted(group), "at", *given))
        same = F.col("block") == F.col("_mm_at")
        for g in group:
            same &= F.col(f"`{g}`").eqNullSafe(F.col(f"`_mm_{g}`"))
        blocks = steps[height].join(ups.withColumnsRenamed({"at": "_mm_at", **{g: f"_mm_{g}" for g in group}}), same)
        blocks = blocks.withColumns({
            f"r{k}": F.when(F.col(f"l{k + 1}").isNotNull(), runs(F.col(f"l{k}"))) for k in range(BLOCK_LEVELS)
        })
        others = [c for c in given if c != "up"]
        rows = blocks.select(*quoted(group), "block", *others, "members", paths_of(blocks).alias("proof"))
        rows = rows.select(*quoted(group), "block", *others, F.inline(F.arrays_zip("members", "proof")))
        rows = rows.select(*quoted(group), "block", *others, "members.*", "proof")
        members = rows.withColumn("at", F.col("block") * FAN**BLOCK_LEVELS + F.col("at")).drop("block")
    return members


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id") -> DataFrame:
    """Add ``leaf, subroot, root, proof`` to ``docs`` without its fields but ``order`` and ``group``.

    ``leaf`` is the digest of a row's fields (see :func:`leaf_of`). Per value of ``group``, leaves stand in ascending
    ``order``; every eight in a row become the digest of their digests, level by level, until one is left: ``subroot``.
    The subroots, ordered by ``group``, lead to ``root`` in the same way. ``proof`` lists the siblings on the way from a
    leaf to the root, as ``before`` and ``behind``; :func:`folded` applies them.

    Nulls: a field counts as ``-``; a null ``group`` is a group and comes first; null ``order`` comes first. Ties of
    ``order`` are broken by leaf, so repeated rows stand side by side, each with its own proof. Empty and very long texts
    are hashed whole, where they are read. No rows: no rows. Further columns of ``docs`` are kept, but those of the added
    names give way; names starting with ``_mm_`` are reserved.

    Texts are not shuffled. Places come from a sort by range, a block of 512 leaves holds all levels below its own, and a
    task works on one block at a time, whatever the size of a group. Proofs are computed on the way out, not stored.
    """
    gone = {name.lower() for name in (*fields, group, order, "leaf", "subroot", "root", "proof")}
    carried = [c for c in docs.columns if c.lower() not in gone]
    row = F.struct(F.col(f"`{order}`").alias("_mm_order"), *quoted(carried)).alias("row")
    leaves = docs.select(F.col(f"`{group}`").alias("g"), F.col(f"`{order}`").alias("o"), leaf_of(quoted(fields)).alias("node"), row)
    steps, subroots = tree(settle(leaves), ["g"], ["o", "node"])
    subroots = subroots.withColumnRenamed("root", "node")
    tops, root = tree(subroots, [], ["g"])
    last = root.first()  # one digest, or none without rows
    start = root.select("height", F.expr("cast(array() as array<struct<before:string,behind:string>>)").alias("up"))
    groups = descended(tops, [], start)
    above = groups.select("g", F.col("node").alias("subroot"), "height", F.col("proof").alias("up"))
    done = descended(steps, ["g"], settle(above))
    return done.select(
        F.col("row._mm_order").alias(order), F.col("g").alias(group), *[F.col(f"row.`{c}`") for c in carried],
        F.col("node").alias("leaf"), "subroot", F.lit(last and last.root).alias("root"), "proof",
    )
