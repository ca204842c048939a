"""Merkle manifest of a table: leaves, subtrees per group, proofs, and what the proofs fold to.

A leaf is the digest of a row's fields. In every group the leaves are ordered by key and reduced by runs of
`fan` neighbours until one node, the group's subroot, remains; the subroots, ordered by group, are reduced
likewise to the root. A row's proof holds the other nodes of its run on each level.

The order is cut into superblocks of `fan ** levels` leaves. One pass gives the node of every superblock; these
nodes are cut into superblocks again, until one node per group remains. On the way back the nodes of a
superblock are cogrouped with the outer nodes its proofs need, which are a handful per level: there the local
levels are reduced again, the proofs joined and the leaves folded. A task holds one superblock at a time.

A null key comes first and is a leaf like others, a null group is a group before all others, and repeated rows
are leaves beside each other. Texts of any length are hashed by Spark. An empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.base import settled
from tablesync.llm.ranking import ranked

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PROOF = "array<struct<before: string, after: string>>"


@dataclass(frozen=True)
class Merkle:
    fan: int = 8  # nodes of a run
    levels: int = 4  # levels inside a superblock

    @property
    def block(self) -> int:
        return self.fan**self.levels


def field(value: Column) -> Column:
    """A field as hashed: `-` for null, else its length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode("ascii")).hexdigest()


def _levels(nodes: list[str], everywhere: int, m: Merkle) -> list[list[str]]:
    """The nodes of a superblock level by level; `everywhere` is how many nodes its whole group has."""
    out = [nodes]
    for _ in range(m.levels):
        if everywhere <= 1:
            break
        below = out[-1]
        out.append([_digest(below[i : i + m.fan]) for i in range(0, len(below), m.fan)])
        everywhere = -(-everywhere // m.fan)
    return out


def _fold(node: str, proof: list[dict]) -> str:
    for step in proof:
        node = _digest([step["before"], node, step["after"]])
    return node


def _upper(nodes: DataFrame, m: Merkle) -> DataFrame:
    """The superblocks' nodes: rows (tree, size, position, node) become as many fewer."""

    def run(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree, size, block = keys
        top = _levels(rows.sort_values("position")["node"].tolist(), size, m)[-1]
        return pd.DataFrame({"tree": [tree], "size": [-(-size // m.block)], "position": [block], "node": top})

    dealt = nodes.select("tree", "size", "position", "node", F.floor(F.col("position") / m.block).alias("block"))
    return dealt.groupBy("tree", "size", "block").applyInPandas(run, "tree string, size bigint, position bigint, node string")


def _cogrouped(nodes: DataFrame, outer: DataFrame, run: Callable, schema: str, m: Merkle) -> DataFrame:
    """Superblocks of nodes with the proof and roots of their upper node."""
    dealt = nodes.withColumn("block", F.floor(F.col("position") / m.block))
    return dealt.groupBy("tree", "block").cogroup(outer.groupBy("tree", "position")).applyInPandas(run, schema)


def _steps(levels: list[list[str]], at: int, m: Merkle) -> list[dict]:
    """The other nodes of the runs above one node, inside its superblock."""
    steps = []
    for nodes in levels[:-1]:
        start = at // m.fan * m.fan
        steps.append({"before": "".join(nodes[start:at]), "after": "".join(nodes[at + 1 : start + m.fan])})
        at //= m.fan
    return steps


def _lower(nodes: DataFrame, outer: DataFrame, m: Merkle) -> DataFrame:
    """The proofs of all nodes of one table, from those of the superblocks they lie in."""
    columns = ["tree", "position", "proof", "subroot", "root"]

    def run(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or above.empty:
            return pd.DataFrame(columns=columns)
        rows, top = rows.sort_values("position"), above.iloc[0]
        levels, rest = _levels(rows["node"].tolist(), int(rows["size"].iloc[0]), m), [dict(s) for s in top["proof"]]
        return pd.DataFrame({
            "tree": rows["tree"], "position": rows["position"], "proof": [_steps(levels, i, m) + rest for i in range(len(rows))],
            "subroot": top["subroot"], "root": top["root"],
        })

    return _cogrouped(nodes, outer, run, f"tree string, position bigint, proof {PROOF}, subroot string, root string", m)


def _tables(nodes: DataFrame, m: Merkle) -> list[DataFrame]:
    """The nodes and the superblocks above them, up to the table of one node per tree."""
    tables = [nodes]
    largest = nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        tables.append(settled(_upper(tables[-1], m), "merkle-nodes"))
        largest = -(-largest // m.block)
    return tables


def manifest(df: DataFrame, key: str, columns: list[str], group: str, tampered: dict[str, Column] | None = None, when: Column | None = None, m: Merkle = Merkle()) -> DataFrame:
    """Per row: key, group, leaf, subroot, root, proof (per level the nodes before and after), folded_root.

    `columns` are the fields of a leaf, in their order. Where `when` holds, the row's fields in `tampered` are
    replaced before its proof is folded; everywhere else, and for null, the leaf itself is folded. The result has
    these columns only, whatever others the table has.
    """
    changed = leaf([(tampered or {}).get(c, F.col(f"`{c}`")) for c in columns])
    # Null comes before the empty name and all others.
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    leaves = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{group}`").alias("group"), tree.alias("tree"), leaf([F.col(f"`{c}`") for c in columns]).alias("node"),
        (F.when(when, changed) if when is not None else F.lit(None).cast("string")).alias("changed"))
    # Written first: the ranges are found on these short rows, and no text is hashed twice.
    leaves = ranked(settled(leaves, "merkle-leaves"), ["tree"], ["key", "node"], "position", "size")
    tables = _tables(leaves, m)

    # Subroots are the leaves of one more tree, in the order of their names.
    subroots = tables[-1].filter("size = 1").select(F.lit("").alias("all"), "tree", "node")
    tops = ranked(subroots, ["all"], ["tree"], "position", "size").withColumnRenamed("tree", "name").withColumnRenamed("all", "tree")
    above = _tables(tops, m)
    root = above[-1].select("tree", "position", F.array().cast(PROOF).alias("proof"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    for nodes in above[-2::-1]:
        root = _lower(nodes, root, m)
    # A subroot's proof goes on where the proofs inside its group end.
    named = tops.select("position", "name", F.col("node").alias("own"))
    outer = root.join(named, "position").select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("position"), "proof", F.col("own").alias("subroot"), "root")
    for nodes in tables[:0:-1]:
        outer = settled(outer if nodes is tables[-1] else _lower(nodes, outer, m), "merkle-outer")

    def run(rows: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        out = ["key", "group", "leaf", "subroot", "root", "proof", "folded_root"]
        if rows.empty or top.empty:
            return pd.DataFrame(columns=out)
        rows, top = rows.sort_values("position"), top.iloc[0]
        levels, rest = _levels(rows["node"].tolist(), int(rows["size"].iloc[0]), m), [dict(s) for s in top["proof"]]
        proofs = [_steps(levels, i, m) + rest for i in range(len(rows))]
        start = rows["changed"].where(rows["changed"].notna(), rows["node"])
        return pd.DataFrame({
            "key": rows["key"], "group": rows["group"], "leaf": rows["node"], "subroot": top["subroot"], "root": top["root"],
            "proof": proofs, "folded_root": [_fold(n, p) for n, p in zip(start, proofs)],
        })

    kinds = {c: leaves.schema[c].dataType.simpleString() for c in ("key", "group")}
    schema = f"key {kinds['key']}, group {kinds['group']}, leaf string, subroot string, root string, proof {PROOF}, folded_root string"
    # With a table of single leaves nothing is above them but the tree of subroots.
    found = _cogrouped(leaves, outer, run, schema, m)
    return found.select(F.col("key").alias(key), F.col("group").alias(group), "leaf", "subroot", "root", "proof", "folded_root")


def tampered_text(text: Column) -> Column:
    """The text with A-Z in lower case."""
    return F.translate(text, UPPER, LOWER)


def proof_digest(proof: Column) -> Column:
    """The digest of a proof's nodes, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.flatten(F.transform(proof, lambda s: F.array(s["before"], s["after"])))), 256)
