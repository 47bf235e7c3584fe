"""Merkle manifest of a dataset, and proofs by descent through its records.

Every row is a leaf.  The leaves of a group (a language) ascend by id; every two
consecutive nodes become the hash of both until one remains, the group's
subroot, and the subroots in group order give the root in the same way.  The
manifest is a store of records (digest, children): a node is known by its digest
alone, so equal subtrees are one record.

A proof starts at the root, with nothing but its digest.  The binary digits of
the wanted rank, the highest first, say which child to follow; the child that is
not followed is collected.  At the leaf the collected path is reversed, from
leaf to root.

Levels are handled in segments of ``BITS``.  A segment of a group's tree falls
into blocks of at most 2^BITS nodes, each built by one small task call and
stored under its block.  Requests that share their high digits descend together
until their paths part: a block passes its digest and its path down to the
blocks below, so each upper step is taken once, not once a leaf, and no block
ever holds more than 2^BITS requests, whatever the size of its group.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import in_order, running, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 10  # levels of a segment
RECORD = "tree STRING, block BIGINT, levels INT, digest STRING, children ARRAY<STRING>, top BOOLEAN"
PATH = "siblings ARRAY<STRING>, digits ARRAY<INT>"


@dataclass
class Manifest:
    """``nodes`` (tree, rank, levels, digest, row): the leaves in order; ``row`` is what was passed through.

    ``records`` and ``top_records`` hold (digest, children) by segment, from the leaves up, of the
    groups and of the tree above them; ``trees`` (tree, levels, digest) one subroot a group, and
    ``root`` (levels, digest) the one root, no row if there is no leaf.
    """

    nodes: DataFrame
    records: list[DataFrame]
    trees: DataFrame
    top_records: list[DataFrame]
    root: DataFrame

    def store(self) -> DataFrame:
        """(digest, children), one row a distinct node: what a content-addressed store holds."""
        every = [r.select("digest", "children") for r in [*self.records, *self.top_records]]
        rows = every[0]
        for more in every[1:]:
            rows = rows.unionByName(more)
        return rows.distinct()


def leaf_digest(*fields: str | Column) -> Column:
    """Hash of the fields in turn: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    parts = []
    for field in fields:
        text = (F.col(field) if isinstance(field, str) else field).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _levels(count: Column) -> Column:
    """How often ``count`` nodes are halved, rounding up, until one is left."""
    return F.when(count <= 1, 0).otherwise(F.length(F.bin(count - 1)))


# --- building ---------------------------------------------------------------------


def _pack(table: pa.Table) -> pa.Table:
    """The records of one block, bottom up; the last is the block's own node."""
    table = table.sort_by("rank")
    now = table["digest"].to_pylist()
    made: list[tuple[str, list[str]]] = []
    segment = table["segment"][0].as_py()
    levels = table["levels"][0].as_py()
    for _ in range(min(BITS, levels - BITS * segment)):
        runs = [now[i : i + 2] for i in range(0, len(now), 2)]
        now = [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs]
        made += zip(now, runs)
    n = len(made)
    return pa.table(
        {
            "tree": pa.array([table["tree"][0].as_py()] * n, pa.string()),
            "block": pa.array([table["block"][0].as_py()] * n, pa.int64()),
            "levels": pa.array([levels] * n, pa.int32()),
            "digest": pa.array([d for d, _ in made], pa.string()),
            "children": pa.array([c for _, c in made], pa.list_(pa.string())),
            "top": pa.array([i == n - 1 for i in range(n)], pa.bool_()),
        }
    )


def _build(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Records by segment and the roots (tree, levels, digest) of all trees of ``nodes``."""
    now = nodes.select("tree", "rank", "levels", "digest")
    deepest = now.agg(F.max("levels")).first()[0] or 0
    records, roots = [], []
    for segment in range(max(1, -(-deepest // BITS))):
        roots.append(now.filter(F.col("levels") <= BITS * segment).select("tree", "levels", "digest"))
        blocks = (
            now.filter(F.col("levels") > BITS * segment)
            .withColumn("block", F.shiftright("rank", BITS))
            .withColumn("segment", F.lit(segment))
        )
        records.append(stored(blocks.groupBy("tree", "block").applyInArrow(_pack, RECORD)))
        now = records[-1].filter("top").select("tree", F.col("block").alias("rank"), "levels", "digest")
    roots.append(now.select("tree", "levels", "digest"))
    every = roots[0]
    for more in roots[1:]:
        every = every.unionByName(more)
    return records, every


def manifest(leaves: DataFrame, group: str = "lang", key: str = "doc_id", leaf: str = "leaf") -> Manifest:
    """The tree over ``leaves``; its columns all pass through as ``row``.

    Groups ascend as text, the null one first; in a group leaves ascend by
    ``key`` (nulls first), equal keys by their digest.  Rows equal in both are
    each a leaf and interchangeable.  A group of one leaf has that leaf as its
    subroot, one group its subroot as the root.  No rows give no root.
    """
    held = stored(
        leaves.select(
            F.struct(*[F.col(f"`{c}`") for c in leaves.columns]).alias("row"),
            F.col(group).cast("string").alias("tree"),
            F.col(key).alias("key"),
            F.col(leaf).alias("digest"),
            F.monotonically_increasing_id().alias("place"),  # spreads rows that agree in everything
            F.lit(1).cast("bigint").alias("one"),
        )
    )
    order = ["key", "digest", "place"]
    ranked = running(in_order(held, ["tree"], order), ["tree"], order, "one")
    counts = held.groupBy(F.col("tree").alias("of")).agg(_levels(F.count(F.lit(1))).alias("levels"))
    ranked = ranked.join(counts, F.col("tree").eqNullSafe(F.col("of")))
    nodes = stored(ranked.select("tree", F.col("before").alias("rank"), "levels", "digest", "row"))
    records, trees = _build(nodes)
    trees = stored(trees)
    above = _above(trees)
    top_records, roots = _build(above)
    return Manifest(nodes, records, trees, top_records, stored(roots.select("levels", "digest")))


def _above(trees: DataFrame) -> DataFrame:
    """The subroots as nodes of one more tree."""
    one = trees.withColumn("one", F.lit(1).cast("bigint"))
    ranked = running(in_order(one, [], ["tree"]), [], ["tree"], "one")
    depth = trees.agg(_levels(F.count(F.lit(1)))).first()[0]
    return stored(
        ranked.select(
            F.lit("").alias("tree"),
            F.col("before").alias("rank"),
            F.lit(depth).alias("levels"),
            "digest",
            F.struct(F.col("tree").alias("group"), "levels").alias("row"),
        )
    )


# --- descent ----------------------------------------------------------------------


def _walk(segment: int):
    """Descend through one segment.  Of each block come its head, then its records, then the requests."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, head, children = None, None, {}
        for batch in batches:
            out, rows = [], []
            tree, at, kind, pos, levels, digest, below, siblings, digits = (
                batch.column(i).to_pylist() for i in range(9)
            )
            for i in range(batch.num_rows):
                if (tree[i], at[i]) != block:
                    block, head, children = (tree[i], at[i]), None, {}
                if kind[i] == 0:
                    head = (levels[i], digest[i], siblings[i], digits[i])
                elif kind[i] == 1:
                    children[digest[i]] = below[i]
                elif head is not None:
                    depth, node, path, turns = head
                    path, turns = list(path), list(turns)
                    for level in range(min(BITS, depth - BITS * segment) - 1, -1, -1):
                        run = children[node]
                        digit = pos[i] >> level & 1
                        node = run[digit]
                        path.append(run[1 - digit] if len(run) == 2 else None)
                        turns.append(digit)
                    out.append((tree[i], pos[i], depth, node, path, turns))
                    rows.append(i)
            columns = list(zip(*out)) if out else [()] * 6
            types = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()))
            made = [pa.array(c, t) for c, t in zip(columns, types)]
            made.append(batch.column(9).take(pa.array(rows, pa.int64())))
            names = ["tree", "pos", "levels", "digest", "siblings", "digits", "row"]
            yield pa.RecordBatch.from_arrays(made, names=names)

    return walk


def _descend(requests: DataFrame, heads: DataFrame, records: list[DataFrame]) -> DataFrame:
    """(levels, digest, siblings, digits, row) of every request (tree, rank, row), paths from the root down.

    ``heads`` (tree, levels, digest, siblings, digits) are the roots with the
    path that leads to them.
    """
    shape = requests.schema["row"].dataType.simpleString()
    asked = [requests.select("tree", F.col("rank").alias("pos"), "row")]
    for _ in records[1:]:
        wider = asked[-1].select("tree", F.shiftright("pos", BITS).alias("pos")).distinct()
        asked.append(wider.withColumn("row", F.lit(None).cast(shape)))
    found = None
    for segment in range(len(records) - 1, -1, -1):
        first = F.greatest(F.ceil(F.col("levels") / BITS).cast("int") - 1, F.lit(0)) == segment
        located = heads.filter(first).withColumn("pos", F.lit(0).cast("bigint"))
        if found is not None:
            located = located.unionByName(found.drop("row"))
        none = {n: F.lit(None).cast(t) for n, t in (part.split(" ") for part in PATH.split(", "))}
        path = [none["siblings"].alias("siblings"), none["digits"].alias("digits")]
        blank = F.lit(None).cast(shape).alias("row")
        long, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
        rows = (
            located.select(
                "tree", F.col("pos").alias("block"), F.lit(0).alias("kind"), long.alias("pos"), "levels", "digest",
                none["siblings"].alias("children"), "siblings", "digits", blank,
            )
            .unionByName(
                records[segment].select(
                    "tree", "block", F.lit(1).alias("kind"), long.alias("pos"), "levels", "digest", "children", *path, blank
                )
            )
            .unionByName(
                asked[segment].select(
                    "tree", F.shiftright("pos", BITS).alias("block"), F.lit(2).alias("kind"), "pos",
                    F.lit(None).cast("int").alias("levels"), text.alias("digest"), none["siblings"].alias("children"), *path, "row",
                )
            )
        )
        dealt = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "kind")
        found = dealt.mapInArrow(
            _walk(segment), f"tree STRING, pos BIGINT, levels INT, digest STRING, {PATH}, row {shape}"
        )
        if segment:
            found = stored(found)
    return found


def prove(made: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """(row, leaf, subroot, root, siblings, digits, to_root) of every wanted leaf.

    ``wanted`` are rows of ``made.nodes``, by default all.  ``siblings`` go
    from the leaf to the root, null where a run has one node; ``digits`` tell
    the place in each run (1: the sibling stands on the left).
    """
    empty = [F.expr(f"CAST(array() AS {part.split(' ')[1]})").alias(part.split(" ")[0]) for part in PATH.split(", ")]
    heads = made.root.select(F.lit("").alias("tree"), "levels", "digest", *empty)
    above = _above(made.trees)
    groups = _descend(above.select("tree", "rank", "row"), heads, made.top_records)
    subroots = stored(
        groups.select(F.col("row.group").alias("tree"), F.col("row.levels").alias("levels"), "digest", "siblings", "digits")
    )
    root = made.root.first()
    ends = subroots.select(F.col("tree").alias("of"), F.col("digest").alias("subroot"))
    asked = wanted if wanted is not None else made.nodes
    found = _descend(asked.select("tree", "rank", "row"), subroots, made.records)
    return found.join(ends, F.col("tree").eqNullSafe(F.col("of"))).select(
        "row",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root.digest if root else None).cast("string").alias("root"),
        F.reverse("siblings").alias("siblings"),
        F.reverse("digits").alias("digits"),
    )


def fold(leaf: str | Column, siblings: str = "siblings", digits: str = "digits") -> Column:
    """The root that a leaf and its proof give."""
    leaf = F.col(leaf) if isinstance(leaf, str) else leaf

    def up(node: Column, step: Column) -> Column:
        beside = step[siblings]
        both = F.when(step[digits] == 1, F.concat(beside, node)).otherwise(F.concat(node, beside))
        return F.sha2(F.coalesce(both, node), 256)

    return F.aggregate(F.arrays_zip(siblings, digits), leaf, up)


def proof_digest(siblings: str = "siblings") -> Column:
    """Hash of the siblings from the leaf to the root."""
    return F.sha2(F.array_join(siblings, ""), 256)
