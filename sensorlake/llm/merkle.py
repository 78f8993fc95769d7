r"""A Merkle manifest of a dataset, with a witness for every row.

Every row is a leaf.  A tree has the rows of one group (a source) in key
order; while it has more than one node, every 16 consecutive ones become their
hash.  The groups' roots, in the order of the groups, form one more tree,
whose root stands for the dataset.  A witness lists, level by level, what a
leaf must be hashed with to arrive at that root.

Witnesses are built by streaming, aligned append (``Frontier``).  A node that
is appended takes the elder nodes of its run as its partial witness, and
extends theirs by its own digest; the sixteenth closes the run, whose hash is
appended one level up.  A partial witness hangs on an open subtree, so its
leaves share it.

A task appends one aligned block of ``BLOCK`` leaves.  The blocks' roots are
further appends to the same tree: they form the next table of nodes, dealt out
in aligned blocks again, until every tree has one node.  On the way back each
block gets its root's witness as one row, ahead of its leaves.  No task holds
more than a block, however large a group is, and the text is read once.

Positions come from a range partition by group and key: rows count from their
partition's first of the group, plus the group's rows in earlier partitions.
``Manifest.append`` adds rows behind all earlier ones of their groups: complete
blocks keep their roots, only open blocks and the levels above are hashed.

Edge cases: null in any column counts as ``-`` in a leaf; a null group is a
group of its own, before the others; null keys come first; rows with equal
keys stand in the order of their leaves, repeated rows are leaves of their
own.  A single leaf is its group's root, a single group's root is the
dataset's.  No rows give no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ship

FANOUT = 16
#: Levels, and so leaves, of an aligned block.
BLOCK_LEVELS = 3
BLOCK = FANOUT**BLOCK_LEVELS


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels of runs above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


class Node:
    """A subtree: its digest, its partial witness (the other nodes of its run
    so far, ``elder`` of them before it), and the run's hash once closed."""

    __slots__ = ("digest", "elder", "witness", "parent")

    def __init__(self, digest: str):
        self.digest, self.elder, self.witness, self.parent = digest, 0, [], None


class Frontier:
    """The open subtrees of one tree, by level."""

    def __init__(self):
        self.open: list[list[Node]] = [[]]

    def append(self, node: Node, level: int = 0) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        node.elder, node.witness = len(run), [x.digest for x in run]
        for elder in run:
            elder.witness.append(node.digest)
        run.append(node)
        if len(run) == FANOUT:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        above = Node(digest(*(x.digest for x in run)))
        for x in run:
            x.parent = above
        self.append(above, level + 1)

    def finish(self, levels: int) -> Node:
        """Close the last, shorter runs; the root after ``levels`` levels."""
        for level in range(levels):
            if self.open[level]:
                self._close(level)
        return self.open[levels][0]


def path(node: Node) -> list[tuple[int, list[str]]]:
    """A leaf's witness within its block: per level, how many digests stand
    before the leaf's own side, and the digests."""
    out = []
    while node.parent is not None:
        out.append((node.elder, node.witness))
        node = node.parent
    return out


def encode(levels: list[tuple[int, list[str]]]) -> str:
    return "".join(f"{elder}:{''.join(others)};" for elder, others in levels)


def decode(witness: str) -> list[tuple[int, list[str]]]:
    out = []
    for level in witness.split(";")[:-1]:
        elder, _, others = level.partition(":")
        out.append((int(elder), [others[i : i + 64] for i in range(0, len(others), 64)]))
    return out


def fold(leaf: str, levels: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and its witness lead to."""
    for elder, others in levels:
        leaf = digest(*others[:elder], leaf, *others[elder:])
    return leaf


# --- leaves and positions ----------------------------------------------------


def leaf(*columns: str | Column) -> Column:
    """Hex SHA-256 of the columns: ``-`` for null, else the UTF-8 length, a
    colon and the value."""
    values = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    one = lambda v: F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.sha2(F.concat(*map(one, values)), 256)


def tree_of(group: str | Column) -> Column:
    """A group's name as a string without nulls, in the groups' order."""
    return F.coalesce(F.concat(F.lit("="), group if isinstance(group, Column) else F.col(group)), F.lit(""))


def positions(rows: DataFrame, scratch: Scratch, name: str, first: DataFrame | None = None) -> DataFrame:
    """``rows`` (tree, key, digest, ...) with ``pos``, the place in the tree,
    and ``n``, the tree's size.  ``first`` (tree, first): rows that stand
    before these in the tree."""
    order = [F.col("tree"), F.col("key").asc_nulls_first(), F.col("digest"), F.col("row")]
    numbered = scratch.write(rows.withColumn("row", F.monotonically_increasing_id()), f"{name}-rows")
    placed = numbered.repartitionByRange(*order).sortWithinPartitions(*order)
    # The low 33 bits count the rows of a partition.
    at = F.monotonically_increasing_id()
    placed = placed.withColumns({"part": F.shiftright(at, 33), "at": at.bitwiseAND(F.lit(2**33 - 1))})
    placed = scratch.write(placed.drop("row"), f"{name}-placed")
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("start"), F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = runs.select("tree", "part", "start", (before - F.col("rows")).alias("before"), F.sum("rows").over(tree).alias("n"))
    if first is not None:
        ahead = F.coalesce("first", F.lit(0))
        runs = runs.join(first, "tree", "left").withColumns({"before": F.col("before") + ahead, "n": F.col("n") + ahead})
        runs = runs.drop("first")
    found = placed.join(runs, ["tree", "part"]).withColumn("pos", F.col("before") + F.col("at") - F.col("start"))
    found = scratch.write(found.drop("part", "at", "start", "before"), name)
    scratch.drop(f"{name}-rows", f"{name}-placed")
    return found


# --- blocks --------------------------------------------------------------------


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """Every block's rows together, in order."""
    if "block" not in nodes.columns:
        nodes = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _streamed(finish: Callable, columns: list[str], schema: pa.Schema):
    """A ``mapInArrow`` function: appends a block's rows as they come and
    calls ``finish(tree, block, root, header, nodes, rows)`` after its last.
    A row before the first position (pos < 0) is the block's header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        out: list[tuple] = []

        def close():
            (tree, block), frontier, n, header, nodes, rows = held
            if nodes:
                out.extend(finish(tree, block, frontier.finish(min(height(n), BLOCK_LEVELS)), header, nodes, rows))

        def made():
            batch = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "pos", "digest", "n", *columns))):
                if held is None or held[0] != row[:2]:
                    if held is not None:
                        close()
                    held = [row[:2], Frontier(), 1, "", [], []]
                if row[2] < 0:
                    held[3] = row[3]
                    continue
                node = Node(row[3])
                held[1].append(node)
                held[2] = row[4]
                held[4].append(node)
                held[5].append(row[5:])
            if len(out) >= BLOCK:
                yield made()
        if held is not None:
            close()
        if out:
            yield made()

    return run


_ROOTS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("n", pa.int64())])
_ABOVE = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("above", pa.string())])


def _block_roots(nodes: DataFrame) -> DataFrame:
    """The next table of nodes: every block's root at the block's place."""

    def finish(tree, block, root, header, nodes, rows):
        return [(tree, block, root.digest, -(-rows[0][0] // BLOCK))]

    walk = _streamed(finish, ["n"], _ROOTS)
    return _in_blocks(nodes).mapInArrow(walk, "tree string, pos long, digest string, n long")


def _with_headers(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """Rows in blocks, each block's witness ahead of its first."""
    if above is not None:
        head = above.select("tree", "block", F.col("above").alias("digest"), F.lit(-1).cast("long").alias("pos"))
        nodes = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
        nodes = nodes.unionByName(head, allowMissingColumns=True)
    return _in_blocks(nodes)


def _descend(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """Witnesses of the nodes, for the blocks that they are the roots of."""

    def finish(tree, block, root, header, nodes, rows):
        return [(tree, pos, encode(path(x)) + header) for x, (pos,) in zip(nodes, rows)]

    walk = _streamed(finish, ["pos"], _ABOVE)
    return _with_headers(nodes, above).mapInArrow(walk, "tree string, block long, above string")


# --- the manifest ---------------------------------------------------------------


@dataclass
class Manifest:
    """``tables[0]``: the leaves (tree, key, digest, pos, n, ...);
    ``tables[k]``: the roots of the blocks of ``tables[k - 1]``; the last has
    one node a tree.  ``tops``: the same for the tree of those.  ``root``: the
    dataset's digest, None without rows."""

    scratch: Scratch
    tables: list[DataFrame]
    tops: list[DataFrame]
    root: str | None

    def subroots(self) -> DataFrame:
        return self.tables[-1].select("tree", F.col("digest").alias("subroot"))

    def block_witnesses(self) -> DataFrame:
        """(tree, block, above): the witnesses of the leaves' blocks."""
        above = None
        for nodes in reversed(self.tops[:-1]):
            above = _descend(nodes, above)
        # A group's place among the groups gives the witness of its root.
        place = self.tops[0].select("pos", F.col("key").alias("tree"))
        above = place.join(above.select(F.col("block").alias("pos"), "above"), "pos")
        above = above.select("tree", F.lit(0).cast("long").alias("block"), "above")
        for nodes in reversed(self.tables[1:-1]):
            above = _descend(nodes, above)
        return above

    def witnesses(self) -> DataFrame:
        """The leaves' columns and ``witness``, the path to the root (see
        ``decode`` and ``fold``)."""
        extra = [f for f in self.tables[0].schema.fields if f.name not in ("tree", "pos", "digest", "n")]
        names = [f.name for f in extra]
        schema = pa.schema([("digest", pa.string()), ("witness", pa.string()), *_arrow(extra)])

        def finish(tree, block, root, header, nodes, rows):
            return [(x.digest, encode(path(x)) + header, *r) for x, r in zip(nodes, rows)]

        walk = _streamed(finish, names, schema)
        types = ", ".join(["digest string", "witness string", *(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)])
        return _with_headers(self.tables[0], self.block_witnesses()).mapInArrow(walk, types)

    def proofs(self, changed: str) -> DataFrame:
        """Per leaf: key, leaf, subroot, root, proof (hex SHA-256 of its
        witness's digests) and folded, the root recomputed from the witness
        and the digest in the column ``changed`` (null: the leaf's own).
        Witnesses themselves are not shipped."""
        key = self.tables[0].schema["key"]
        schema = pa.schema([*_arrow([key]), *((c, pa.string()) for c in ("leaf", "subroot", "proof", "folded"))])

        def finish(tree, block, root, header, nodes, rows):
            subroot, _, header = header.partition(" ")
            above = decode(header)
            tail = "".join("".join(others) for _, others in above).encode()
            folded: dict[str, str] = {}  # by what the block's root becomes
            for node, (key, other) in zip(nodes, rows):
                levels = path(node)
                proof = hashlib.sha256("".join("".join(others) for _, others in levels).encode())
                proof.update(tail)
                top = fold(other or node.digest, levels)
                if top not in folded:
                    folded[top] = fold(top, above)
                yield key, node.digest, subroot, proof.hexdigest(), folded[top]

        walk = _streamed(finish, ["key", changed], schema)
        types = f"key {key.dataType.simpleString()}, leaf string, subroot string, proof string, folded string"
        above = self.block_witnesses().join(self.subroots(), "tree")
        above = above.withColumn("above", F.concat("subroot", F.lit(" "), "above"))
        found = _with_headers(self.tables[0], above).mapInArrow(walk, types)
        return found.withColumn("root", F.lit(self.root).cast("string"))

    def append(self, rows: DataFrame) -> Manifest:
        """The manifest with ``rows`` (the leaves' columns but pos and n) after
        those of their trees.  Blocks that were complete keep their roots."""
        name = f"append-{uuid.uuid4().hex[:8]}"
        size = self.tables[0].groupBy("tree").agg(F.max("n").alias("first"))
        new = positions(rows, self.scratch, f"{name}-new", size)
        grown = new.groupBy("tree").agg(F.max("n").alias("now")).join(size, "tree", "left")
        grown = grown.select("tree", "now", F.coalesce("first", F.lit(0)).alias("first"))
        old = self.tables[0].join(grown, "tree", "left").withColumn("n", F.coalesce("now", "n"))
        leaves = self.scratch.write(old.drop("now", "first").unionByName(new), f"{name}-leaves")
        whole = self.tables[1].join(grown, "tree", "left").filter(f"first IS NULL OR (pos + 1) * {BLOCK} <= first")
        kept = whole.withColumn("n", F.expr(f"coalesce((now + {BLOCK - 1}) div {BLOCK}, n)")).drop("now", "first")
        opened = leaves.join(grown, "tree").filter(f"pos >= first div {BLOCK} * {BLOCK}").drop("now", "first")
        roots = kept.unionByName(_block_roots(opened))
        return _climb(self.scratch, leaves, roots, name)


def _arrow(fields) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [pa.field(f.name, to_arrow_type(f.dataType)) for f in fields]


def _tables(scratch: Scratch, nodes: DataFrame, name: str, roots: DataFrame | None = None) -> list[DataFrame]:
    """``nodes`` and the tables above, the last with one node a tree."""
    tables = [nodes]
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        roots = _block_roots(tables[-1]) if roots is None else roots
        tables.append(scratch.write(roots, f"{name}-{len(tables)}"))
        roots, largest = None, -(-largest // BLOCK)
        if largest <= 1:
            return tables


def _climb(scratch: Scratch, leaves: DataFrame, roots: DataFrame | None = None, name: str = "nodes") -> Manifest:
    tables = _tables(scratch, leaves, name, roots)
    groups = tables[-1].select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest")
    tops = _tables(scratch, positions(groups, scratch, f"{name}-groups"), f"{name}-top")
    top = tops[-1].select("digest").first()
    return Manifest(scratch, tables, tops, top[0] if top else None)


def build(rows: DataFrame) -> Manifest:
    """The manifest of ``rows`` (tree, key, digest, further columns): ``tree``
    by ``tree_of``, ``digest`` by ``leaf``."""
    ship(rows.sparkSession)
    scratch = Scratch(rows.sparkSession, "merkle")
    return _climb(scratch, positions(rows, scratch, "leaves"))
