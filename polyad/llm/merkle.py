"""Merkle dataset manifest, its upper levels by butterfly exchange.

Leaves are digests of rows. They are sorted by range and ranked, and every aligned run
of ``fanout ** levels`` leaves of a tree becomes a block, whose subtree is hashed where
the block is. Above the blocks there is no tree walk: in round r, the ``fanout`` blocks
whose numbers differ in their r-th digit alone swap the roots that they hold, and each
hashes the same parent for itself. So the blocks below one ancestor all end up with it,
and each has met every sibling that its proofs need: nothing is sent down again. Numbers
beyond a tree's last block, up to the next power of the fanout, are empty blocks that
take part and hold no hash until they get one, so each group has exactly ``fanout``
members: no group is hot, whatever the trees' sizes. The trees' roots are leaves of one
more tree, built in the same way.

A digest is the hex SHA-256 of its inputs joined, digests as hex text. While a tree has
more than one node, each run of ``fanout`` nodes (the last may be shorter, even a single
one) becomes their digest. A proof has, for every level, the digests before and after
the node in its run.

Edge cases: a NULL field is ``-`` in a leaf. A NULL tree comes before all others, then
names by their bytes; a NULL position before all others; rows of one position by their
digest, so rows that repeat entirely are interchangeable leaves. A tree of one leaf has it
as its root. An empty table has no rows and no root. Columns beyond those named are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyad.session import stage

from .common import map_batches

FANOUT = 3
LEVELS = 7  # of a block: 2,187 leaves, some 150 kB
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "array<struct<before:string, after:string>>"


def joined_digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row: ``-`` for a NULL field, else its length in bytes, a colon and its text."""
    text = {c: x.cast("string") for c, x in fields.items()}
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in text.values())), 256)


def leaves(docs: DataFrame, group: str = "source", order: str = "doc_id", fields: tuple[str, ...] = FIELDS, changed: dict[str, Column] | None = None) -> DataFrame:
    """``tree, at, leaf, other``: digests of the rows, and of the same rows with the fields of ``changed`` in their place."""
    own = {c: F.col(f"`{c}`") for c in fields}
    group = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))  # "" sorts before every "=..."
    return docs.select(group.alias("tree"), F.col(f"`{order}`").alias("at"), leaf(own).alias("leaf"), leaf(own | (changed or {})).alias("other"))


class Forest(NamedTuple):
    """``blocks``: ``tree, block, total, ats, leaves, others``; ``tops``: ``tree, block, top, upper`` (the root and the block's proof)."""

    blocks: DataFrame
    tops: DataFrame


def build(rows: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> Forest:
    """All trees of ``rows`` (``tree, at, leaf, other``), staged."""
    size = fanout**levels
    rows = stage(rows, "leaves")
    ordered = rows.repartitionByRange("tree", F.asc_nulls_first("at"), "leaf").sortWithinPartitions("tree", F.asc_nulls_first("at"), "leaf")
    ordered = stage(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "ordered")
    # a row for each tree in each partition: where its run begins, and the leaves of the tree before it
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = ordered.groupBy("part", "tree").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    runs = runs.select("part", "tree", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy("tree")).alias("total"))
    ranked = ordered.join(stage(runs, "runs"), ["part", "tree"]).withColumn("rank", F.col("row") + F.col("shift"))
    held = ranked.groupBy("tree", F.expr(f"rank div {size}").alias("block")).agg(F.min("total").alias("total"), F.sort_array(F.collect_list(F.struct("rank", "at", F.unhex("leaf").alias("leaf"), F.unhex("other").alias("other")))).alias("x"))
    blocks = stage(held.select("tree", "block", "total", F.col("x.at").alias("ats"), F.col("x.leaf").alias("leaves"), F.col("x.other").alias("others")), "blocks")

    def roots(source: Iterator[tuple]) -> Iterator[list]:
        for tree, block, total, digests in source:
            yield [[tree], [block], [-(-total // size)], [subtree([d.hex() for d in digests], fanout, levels if total > size else None)[-1][0]]]

    state = map_batches(blocks.select("tree", "block", "total", "leaves"), roots, "tree string, block long, n long, top string")
    state = stage(state.withColumn("upper", F.expr(f"cast(array() AS {_STEP})")), "tops")
    most = state.agg(F.coalesce(F.max("n"), F.lit(0))).head()[0]
    rounds = 0
    while fanout**rounds < most:
        rounds += 1
    done = [state.where("n = 1")]
    # empty blocks up to the next power of the fanout
    power = F.coalesce(*(F.when(F.col("n") <= fanout**r, F.lit(fanout**r)) for r in range(1, rounds + 1)), F.lit(1))
    number = F.explode(F.array(*(F.col("block") + k * F.col("n") for k in range(fanout)))).alias("number")
    state = state.where("n > 1").select("tree", "n", "block", "top", "upper", power.alias("power"), number).where("number < power")
    state = state.select("tree", "n", "power", F.col("number").alias("block"), F.when(F.col("number") < F.col("n"), F.col("top")).alias("top"), F.when(F.col("number") < F.col("n"), F.col("upper")).alias("upper"))
    for r in range(rounds):
        state = stage(swap(state, r, fanout), "swapped")
        done.append(state.where(f"power = {fanout ** (r + 1)} AND block < n"))
        state = state.where(f"power > {fanout ** (r + 1)}")
    tops = done[0].select("tree", "block", "top", "upper")
    for part in done[1:]:
        tops = tops.unionByName(part.select("tree", "block", "top", "upper"))
    return Forest(blocks, tops)


def swap(state: DataFrame, r: int, fanout: int) -> DataFrame:
    """Round r: blocks whose numbers differ in digit r alone get each other's hashes, hash the parent and note their siblings."""
    group = ["tree", F.expr(f"block div {fanout ** (r + 1)}").alias("high"), (F.col("block") % fanout**r).alias("low")]
    met = state.groupBy(*group).agg(F.first("n").alias("n"), F.first("power").alias("power"), F.sort_array(F.collect_list(F.struct("block", "top", "upper"))).alias("members"))
    known = F.filter("members", lambda x: x["top"].isNotNull())
    hashes = lambda x: F.array_join(F.transform(x, lambda m: m["top"]), "")
    met = met.select("tree", "n", "power", "members", F.when(F.size(known) > 0, F.sha2(hashes(known), 256)).alias("top"))

    def moved(x: Column) -> Column:
        side = lambda keep: hashes(F.filter("members", lambda m: m["top"].isNotNull() & keep(m["block"], x["block"])))
        step = F.struct(side(lambda a, b: a < b).alias("before"), side(lambda a, b: a > b).alias("after"))
        return F.struct(x["block"].alias("block"), F.concat(x["upper"], F.array(step)).alias("upper"))

    return met.select("tree", "n", "power", "top", F.explode(F.transform("members", moved)).alias("x")).select("tree", "n", "power", F.col("x.block").alias("block"), "top", F.col("x.upper").alias("upper"))


def subtree(digests: list[str], fanout: int, levels: int | None = None) -> list[list[str]]:
    """All levels from the leaves up: ``levels`` of them, or as many as it takes to a single node."""
    out = [digests]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        out.append([joined_digest(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def sides(tree: list[list[str]], at: int, fanout: int) -> list[tuple[str, str]]:
    """For every level below the top, the digests before and after leaf ``at``'s node in its run."""
    out = []
    for level in tree[:-1]:
        start = at - at % fanout
        out.append(("".join(level[start:at]), "".join(level[at + 1 : start + fanout])))
        at //= fanout
    return out


def fold(digest: str, proof: list[tuple[str, str]]) -> str:
    """The root that a leaf and its proof lead to."""
    for before, after in proof:
        digest = joined_digest(before, digest, after)
    return digest


def _each(forest: Forest, tops: DataFrame, make, schema: str, fanout: int, levels: int) -> DataFrame:
    """``make(tree, at, leaf, other, top, proof, *more)`` for every leaf; ``tops``: ``tree, block, top, upper`` and more columns."""
    size = fanout**levels
    more = [c for c in tops.columns if c not in ("tree", "block", "top", "upper")]

    def run(source: Iterator[tuple]) -> Iterator[list]:
        for tree, total, ats, digests, others, top, upper, *rest in source:
            digests = [d.hex() for d in digests]
            nodes = subtree(digests, fanout, levels if total > size else None)
            upper = [(x["before"], x["after"]) for x in upper]
            out = [make(tree, a, d, o.hex(), top, sides(nodes, i, fanout) + upper, *rest) for i, (a, d, o) in enumerate(zip(ats, digests, others, strict=True))]
            yield [list(c) for c in zip(*out, strict=True)]

    return map_batches(forest.blocks.join(tops, ["tree", "block"]).select("tree", "total", "ats", "leaves", "others", "top", "upper", *more), run, schema)


def proofs(rows: DataFrame, fanout: int = FANOUT, levels: int = LEVELS, at: str = "long") -> DataFrame:
    """``tree, at, leaf, top, proof`` for every leaf of ``rows`` (``tree, at, leaf, other``; ``at``: the type of that column)."""
    forest = build(rows, fanout, levels)
    make = lambda tree, a, digest, other, top, proof: (tree, a, digest, top, [{"before": x, "after": y} for x, y in proof])
    return _each(forest, forest.tops, make, f"tree string, at {at}, leaf string, top string, proof {_STEP}", fanout, levels)


def manifest(rows: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of :func:`leaves`.

    ``folded_root`` comes from the leaf of the changed row and the proof of the row as it was.
    """
    forest = build(rows, fanout, levels)
    subroots = forest.tops.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("at"), F.col("top").alias("leaf"), F.col("top").alias("other"))
    over = proofs(subroots, fanout, levels, "string").select(F.col("at").alias("tree"), F.col("top").alias("root"), F.col("proof").alias("over"))
    tops = forest.tops.join(stage(over, "over"), "tree")

    def make(tree, doc_id, digest, other, top, proof, root, over):
        proof = proof + [(x["before"], x["after"]) for x in over]
        folded = fold(other, proof)
        return doc_id, digest, top, root, joined_digest(*(x for step in proof for x in step)), folded, folded == root

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _each(forest, tops, make, schema, fanout, levels)
