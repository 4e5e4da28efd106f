"""Merkle manifest of a table: one digest for each row, group and the whole, with proofs.

Digests are lowercase hex sha256 of concatenated inputs. A row's leaf is the digest of its
fields. The leaves of a group, in order of id, are hashed by runs of ``FAN`` until one node is
left, the group's subroot; the subroots, in order of group, are hashed likewise into the root.

Checkpoint and recompute: only each ``every``-th level of a tree is stored. A node of it
stands for an aligned subtree of at most FAN ** every stored nodes below, which one task
reads as one bounded list. For proofs a task regenerates the nodes between from that list,
gives each member its siblings, and discards them. Paths are found from the root downwards:
a stored node's path is its way to its subtree's top and the path of that top, so leaves are
shuffled once, as lists, and their proofs are never joined from pieces.

Places in a group come from one sort by ranges and sums over ranges; a group that holds most
rows is spread over them, and its subtrees are dealt out by number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import BATCH_ROWS, column, prepare, stored

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def field_text(value: Column) -> Column:
    """``-`` for null, else the value's length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field_text, values)), 256)


def group_key(group: Column) -> Column:
    """A group's name as a key that is never null and sorts a null name first."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def placed(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with the place of each in its group ``key`` and the group's size, stored.

    One sort by ranges of (key, order); then sums of counts by (range, key), as many as ranges
    and groups, tell where a range's part of a group begins.
    """
    part = F.spark_partition_id()
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    kept = stored(ranged.select("*", part.alias("_part"), row.alias("_row")), label)
    parts = kept.groupBy("key", "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # A group has a row for each range it reaches into.
    starts = parts.selectExpr(
        "key AS _key",
        "_part AS _range",
        "_first",
        "sum(_n) OVER (PARTITION BY key ORDER BY _part) - _n AS _before",
        "sum(_n) OVER (PARTITION BY key) AS size",
    )
    same = (kept["key"] == starts["_key"]) & (kept["_part"] == starts["_range"])
    return kept.join(starts, same).select(
        *[kept[c] for c in rows.columns],
        (F.col("_row") - F.col("_first") + F.col("_before")).alias("place"),
        "size",
    )


def levels_of(nodes: list[str], size: int, every: int) -> Iterator[list[str]]:
    """The levels of an aligned subtree, from ``nodes`` up to its top or the tree's.

    ``size`` is the number of nodes that the whole tree has on the level of ``nodes``.
    """
    for _ in range(every):
        yield nodes
        if size <= 1:
            return
        size = -(-size // FAN)
        nodes = [digest("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]
    yield nodes


def ways(levels: list[list[str]]) -> Iterator[str]:
    """For each node of the lowest level its siblings up to the top: ``left|right;`` a level."""
    steps = [
        ["".join(level[i - i % FAN : i]) + "|" + "".join(level[i + 1 : i - i % FAN + FAN]) + ";" for i in range(len(level))]
        for level in levels[:-1]
    ]
    for i in range(len(levels[0])):
        yield "".join(step[i // FAN**k] for k, step in enumerate(steps))


def siblings(path: str) -> str:
    """The digests of a path, concatenated."""
    return path.replace("|", "").replace(";", "")


def folded(leaf: str, path: str) -> str:
    """The root that a leaf gives with the siblings of a path."""
    for step in path.split(";")[:-1]:
        left, right = step.split("|")
        leaf = digest(left + leaf + right)
    return leaf


@dataclass
class Tree:
    """The stored levels of the trees of all groups: (key, place, size, digest) each.

    ``size`` is the number of nodes of the group's tree on that level; the last level has one.
    """

    levels: list[DataFrame]
    every: int

    def top(self) -> DataFrame:
        """(key, digest): the one node left of each group."""
        return self.levels[-1].select("key", "digest")


@dataclass
class Manifest:
    """The leaves with their rows' ids, the groups' trees and the tree over their subroots."""

    leaves: DataFrame
    groups: Tree
    whole: Tree
    root: str | None


def subtrees(nodes: DataFrame, columns: list[str], every: int) -> DataFrame:
    """(key, parent, size, members): the aligned subtrees over the nodes of a stored level.

    A subtree has at most FAN ** every members; its parent is its place so many levels up.
    """
    parent = F.expr(f"if(size > 1, place div {FAN**every}, place)")
    return nodes.groupBy("key", parent.alias("parent"), "size").agg(
        F.sort_array(F.collect_list(F.struct("place", *columns))).alias("members")
    )


def tree_over(nodes: DataFrame, every: int) -> Tree:
    """All stored levels over (key, place, size, digest), the lowest being ``nodes``."""
    tree = Tree([nodes], every)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = []
            for members, size in zip(column(batch, "members"), column(batch, "size")):
                *_, top = levels_of([m["digest"] for m in members], size, every)
                tops += top
            sizes = [max(1, -(-n // FAN**every)) for n in column(batch, "size")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("key")),
                    batch.column(batch.schema.get_field_index("parent")),
                    pa.array(sizes, pa.int64()),
                    pa.array(tops, pa.string()),
                ],
                ["key", "place", "size", "digest"],
            )

    while (tree.levels[-1].agg(F.max("size")).first()[0] or 1) > 1:
        lists = subtrees(tree.levels[-1], ["digest"], every)
        tree.levels.append(
            stored(lists.mapInArrow(fold, "key string, place long, size long, digest string"), "checkpoint")
        )
    return tree


def build(
    docs: DataFrame,
    *,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "source",
    found: Mapping[str, Column] | None = None,
    every: int = 4,
) -> Manifest:
    """The manifest of a table; each ``every``-th level of its trees is stored.

    Leaves ascend by id within a group, null ids first; rows of one id by their leaf. Null
    fields and groups are values of their own. Without rows there are no groups and no root.
    ``found`` gives fields as they are found later: ``claimed`` is the leaf of those.
    """
    prepare(docs.sparkSession)
    found = found or {}
    rows = docs.select(
        group_key(F.col(group_col)).alias("key"),
        F.col(id_col).cast("long").alias("doc_id"),
        leaf_of([F.col(c) for c in fields]).alias("leaf"),
        leaf_of([found.get(c, F.col(c)) for c in fields]).alias("claimed"),
    )
    leaves = stored(placed(rows, ["doc_id", "leaf"], "leaf-ranges"), "leaves")
    groups = tree_over(leaves.select("key", "place", "size", F.col("leaf").alias("digest")), every)
    subroots = groups.top().select(F.lit("").alias("key"), F.col("key").alias("group"), "digest")
    ordered = stored(placed(subroots, ["group"], "subroots"), "subroots")
    whole = tree_over(ordered, every)
    top = whole.top().first()
    return Manifest(leaves, groups, whole, top["digest"] if top else None)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def descended(
    nodes: DataFrame, every: int, names: list[str], tops: DataFrame, emit: Callable[..., tuple], schema: pa.Schema, ddl: str
) -> DataFrame:
    """What ``emit(key, member, way, path, subroot)`` gives for each node of a stored level.

    ``tops`` has (key, parent, path, subroot) of the nodes above, ``way`` is the node's way to
    the top of its subtree. Interior nodes live as long as one list of members is worked on.
    """
    lists = subtrees(nodes, names, every).join(tops, ["key", "parent"])

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ("key", "members", "size", "path", "subroot")
        for batch in batches:
            out: list[tuple] = []
            for key, members, size, path, subroot in zip(*(column(batch, c) for c in fields)):
                levels = list(levels_of([m["digest"] for m in members], size, every))
                out += [emit(key, m, way, path, subroot) for m, way in zip(members, ways(levels))]
                if len(out) >= BATCH_ROWS:
                    yield batch_of(out, schema)
                    out = []
            if out:
                yield batch_of(out, schema)

    return lists.mapInArrow(descend, ddl)


PATHS = pa.schema([("key", pa.string()), ("parent", pa.int64()), ("path", pa.string()), ("subroot", pa.string())])
PATHS_DDL = "key string, parent long, path string, subroot string"


def paths_of(
    levels: list[DataFrame], every: int, tops: DataFrame, names: list[str], emit: Callable[..., tuple]
) -> DataFrame:
    """(key, parent, path, subroot) of the nodes of the lowest of ``levels``."""
    for nodes in reversed(levels):
        tops = stored(descended(nodes, every, names, tops, emit, PATHS, PATHS_DDL), "paths")
    return tops


def proofs(manifest: Manifest, *, schema: pa.Schema | None = None, ddl: str = "", emit=None) -> DataFrame:
    """(doc_id, leaf, subroot, path) of each row; what ``emit(leaf row, path, subroot)`` gives
    instead, if there is one.

    ``path`` holds the siblings level by level up to the root, ``left|right;`` each.
    """
    if emit is None:
        ddl = "doc_id long, leaf string, subroot string, path string"
        schema = pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "path"))])
        emit = lambda m, path, subroot: (m["doc_id"], m["digest"], subroot, path)
    whole, every = manifest.whole.levels, manifest.whole.every
    top = whole[-1].select("key", F.col("place").alias("parent"), F.lit("").alias("path"), F.lit("").alias("subroot"))
    up = lambda key, m, way, path, subroot: (key, m["place"], way + path, subroot)
    group = lambda key, m, way, path, subroot: (m["group"], 0, way + path, m["digest"])
    if len(whole) > 1:
        above = paths_of(whole[1:-1], every, top, ["digest"], up)
        tops = paths_of(whole[:1], every, above, ["digest", "group"], group)
    else:
        tops = whole[0].select(
            F.col("group").alias("key"), F.lit(0).cast("long").alias("parent"), F.lit("").alias("path"),
            F.col("digest").alias("subroot"),
        )
    tops = paths_of(manifest.groups.levels[1:-1], every, tops, ["digest"], up)
    last = lambda key, m, way, path, subroot: emit(m, way + path, subroot)
    leaves = manifest.leaves.withColumnRenamed("leaf", "digest")
    return descended(leaves, every, ["digest", "claimed", "doc_id"], tops, last, schema, ddl)


CHECKED = pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "proof_sha256", "folded_root"))])


def checked(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row.

    ``folded_root`` is what the leaf of the fields as found gives with the row's proof;
    ``proof_sha256`` digests the proof.
    """

    def emit(m: dict, path: str, subroot: str) -> tuple:
        return m["doc_id"], m["digest"], subroot, digest(siblings(path)), folded(m["claimed"], path)

    ddl = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"
    root = F.lit(manifest.root).cast("string")
    return proofs(manifest, schema=CHECKED, ddl=ddl, emit=emit).select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
