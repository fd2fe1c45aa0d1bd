"""Merkle manifest of a dataset: a tree a group, a tree over the groups, a proof a row.

A tree joins every ``FAN`` consecutive nodes into their parent, level by level, until one is
left. ``FAN ** DEPTH`` consecutive nodes are an aligned block, which one row holds: a level
of it is the concatenation of its digests as one hex string, whose fixed-width substrings
are hashed into the next level's. The digests beside a node in its run are two substrings
as well, the sibling segments left and right of it. A block's last digest is a node of the
next tree of blocks, so trees of any size take a few jobs of aligned blocks each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleframe.llm.common import free_name, stage
from candleframe.llm.ordered import placed

#: Nodes of one parent, and levels of an aligned block.
FAN, DEPTH = 3, 5
BLOCK = FAN**DEPTH
#: Characters of a digest, and of all digests of one run.
HEX = 64
RUN = FAN * HEX
#: Nodes of a level that one node of each level of a block spans.
SPANS = [FAN**j for j in range(DEPTH)]

PROOF = "array<struct<left:string,right:string>>"


def leaf_digest(*columns: str | Column) -> Column:
    """sha256 of the columns' values in order: ``-`` for NULL, else UTF-8 byte count, ``:`` and the value."""
    parts = []
    for c in columns:
        value = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf gives with a proof's sibling segments, level by level."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """sha256 of all siblings' digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _parents(level: Column) -> Column:
    last = F.floor((F.length(level) - 1) / RUN).cast("int")
    return F.array_join(
        F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(F.substring(level, i * RUN + 1, RUN), 256)), "")


def _segments(at: Column, spans: Column, levels: Column) -> Column:
    """Left and right of a node's own path in each level of its block."""

    def beside(span, j):
        node = F.floor(at / span).cast("int")
        place = F.pmod(node, F.lit(FAN))
        level = F.get(levels, j)
        return F.struct(
            F.substring(level, (node - place) * HEX + 1, place * HEX).alias("left"),
            F.substring(level, (node + 1) * HEX + 1, (FAN - 1 - place) * HEX).alias("right"),
        )

    return F.transform(spans, beside)


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """Nodes (_g, _at, _n, _node, _carry) as aligned blocks with all their levels, one row each."""
    blocks = nodes.groupBy("_g", F.floor(F.col("_at") / BLOCK).alias("_block")).agg(
        F.max("_n").alias("_n"),
        F.sort_array(F.collect_list(F.struct(F.pmod("_at", F.lit(BLOCK)).cast("int").alias("at"), "_node", "_carry"))).alias("_members"),
    )
    # Levels that this block takes: all, unless it is a whole tree.
    spans = F.filter(F.array(*map(F.lit, SPANS)), lambda s: s < F.col("_n"))
    first = F.array_join(F.transform("_members", lambda m: m["_node"]), "")
    return stage(
        blocks.withColumn("_spans", spans).withColumn("_first", first)
        .withColumn("_levels", F.aggregate(
            "_spans", F.array(F.col("_first")).cast("array<string>"),
            lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1))))))
        .drop("_first"),
        name,
    )


def _up(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """The blocks of trees of up to ``most`` nodes, then of their blocks' roots, until each tree is one block."""
    tiers = [_blocks(nodes, name)]
    while most > BLOCK:
        most = -(-most // BLOCK)
        tiers.append(_blocks(
            tiers[-1].select("_g", F.col("_block").alias("_at"), F.ceil(F.col("_n") / BLOCK).alias("_n"),
                             F.element_at("_levels", -1).alias("_node"), F.lit(None).cast("int").alias("_carry")),
            f"{name}-{len(tiers)}"))
    return tiers


def _down(tiers: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """The first tier's nodes with their proofs: segments of each block on the way, then ``above``'s of the tree.

    ``above``: _ag, _proof (what follows a tree's root, by group) and further columns, which pass.
    """
    passed = [c for c in above.columns if c not in ("_ag", "_proof")]
    paths = above.withColumn("_ab", F.lit(0).cast("long"))
    for i, tier in reversed(list(enumerate(tiers))):
        same = F.col("_g").eqNullSafe(F.col("_ag")) & (F.col("_block") == F.col("_ab"))
        each = F.transform("_members", lambda m: F.struct(
            m["at"].alias("at"), m["_node"].alias("_node"), m["_carry"].alias("_carry"),
            F.concat(_segments(m["at"], F.col("_spans"), F.col("_levels")), F.col("_proof")).cast(PROOF).alias("_proof")))
        nodes = tier.join(paths, same).select("_g", "_block", *passed, F.inline(each))
        if not i:
            return nodes.drop("_block", "at")
        paths = stage(nodes.select(F.col("_g").alias("_ag"), "_proof", *passed,
                                   (F.col("_block") * BLOCK + F.col("at")).alias("_ab")), f"{name}-paths")
    raise ValueError("no tiers")


def merkle_manifest(rows: DataFrame, group: str = "source", order: str = "doc_id", leaf: str = "leaf") -> DataFrame:
    """``rows`` with ``subroot`` (its group's tree), ``root`` (the tree over groups) and ``proof``.

    ``leaf``: a row's digest (``leaf_digest``). Leaves of a group ascend by ``order``; subroots
    ascend by ``group`` in UTF-8 bytes; NULLs come first in both, and NULL groups are one
    group. Rows that tie in ``order`` ascend by their leaf; equal rows take any places among
    them, so the result as a whole does not depend on the input's order. A tree of one leaf
    is that leaf, with an empty proof. ``proof``: a struct (left, right) of the siblings'
    digests a level, from the leaf to ``root``; ``fold`` recomputes the root. All columns
    of ``rows`` pass; those named subroot, root or proof are replaced. No rows: no rows.

    A hot group is ranged over tasks, a task holds blocks of 243 digests, and the levels above
    shrink by that factor each. Two slim shuffles of leaves; texts are never shuffled.
    """
    made = ("subroot", "root", "proof")
    kept = [c for c in rows.columns if c.lower() not in made]
    slim = stage(rows.select(
        F.col(group).alias("g"), F.col(order).alias("o"), F.col(leaf).alias("node"),
        F.struct(*[F.col(f"`{c}`") for c in kept if c != leaf], F.lit(0).alias(free_name(kept, "_"))).alias("carry")), "merkle-leaves")
    at, most = placed(slim, "g", ["o", "node"], "merkle-order")
    leaves = at.select(F.col("g").alias("_g"), "_at", "_n", F.col("node").alias("_node"), F.col("carry").alias("_carry"))
    tiers = _up(leaves, most, "merkle-blocks")

    tops = stage(tiers[-1].select(F.lit(0).alias("g"), F.col("_g").alias("o"), F.element_at("_levels", -1).alias("node")), "merkle-subroots")
    at, most = placed(tops, "g", ["o"], "merkle-groups")
    groups = at.select(F.col("g").alias("_g"), "_at", "_n", F.col("node").alias("_node"), F.col("o").alias("_carry"))
    top = _up(groups, most, "merkle-top")
    start = top[-1].select(F.col("_g").alias("_ag"), F.array().cast(PROOF).alias("_proof"),
                           F.element_at("_levels", -1).alias("_root"))
    by_group = stage(
        _down(top, start, "merkle-top").select(
            F.col("_carry").alias("_ag"), F.col("_node").alias("_subroot"), "_root", "_proof"),
        "merkle-group-proofs")
    out = _down(tiers, by_group, "merkle")
    return out.select(
        *[(F.col("_node") if c == leaf else F.col(f"_carry.`{c}`")).alias(c) for c in kept],
        F.col("_subroot").alias("subroot"), F.col("_root").alias("root"), F.col("_proof").alias("proof"))
