"""A Merkle manifest of a dataset: one leaf a row, a tree of fan-out 16 a group, a tree over the groups, and a proof for each leaf.

1. One scan hashes each row to a leaf; only hashes go on from there.
2. Leaves are dealt by range of (group, order) and numbered by the sizes of the parts before, so no group is ever in one task.
3. Aligned blocks of 16 ** LEVELS leaves are one unit of work. Treehash makes the roots of blocks, which are the leaves of the same
   job one storey up, until each group is one block. The groups' roots are the leaves of a last tree.
4. Downwards, a block gets the path of its root as one row in front of its leaves. Then traversal goes from leaf to leaf: each
   level holds the nodes of the current run, and a treehash stack that makes the next run from the leaves ahead, one leaf a
   step. So a task holds at most two runs a level (2 * 16 * LEVELS nodes), whatever the size of the group or of the block.

A node is the lower-case hexadecimal SHA-256 of its children's text, joined. While a tree has more than one node, each run of 16
nodes becomes one; the last run may be shorter, and even a single node is hashed.

Defined results: null and empty text are different leaves, as null columns are written '-'; a null order comes first; rows that repeat
the order are sorted by their leaves; equal rows have one place each, so they have a proof each. A null group comes first and is a
group of its own. Very long texts are hashed where they are read. An empty table has an empty manifest. Columns that aren't
named are ignored and clash with nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import discard, save, shared_dir

FANOUT = 16
#: Levels of a block: 256 leaves.
LEVELS = 2
BLOCK = FANOUT**LEVELS
#: Rows of a batch that a task gives back; a row has about 1.5 KB of path a level.
BATCH = 512
PATH = "array<struct<left: string, right: string>>"


def leaf_of(*columns: Column) -> Column:
    """The leaf of a row: each value is '-' if null, else its bytes in UTF-8, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, at: F.sha2(F.concat(at.left, node, at.right).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda at: F.array(at.left, at.right))), "").cast("binary"), 256)


def _node(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


class Treehash:
    """Makes the nodes of one level from leaves, one at a time; it holds one unfinished run a level below."""

    def __init__(self, level: int) -> None:
        self.runs: list[list[str]] = [[] for _ in range(level)]

    def add(self, node: str) -> str | None:
        """The node of the level, if this leaf completes it."""
        for run in self.runs:
            run.append(node)
            if len(run) < FANOUT:
                return None
            node = _node(run)
            run.clear()
        return node

    def end(self) -> str | None:
        """The last node, made from what is left, if anything is."""
        node = None
        for run in self.runs:
            if node is not None:
                run.append(node)
            node = _node(run) if run else None
            run.clear()
        return node


class Level:
    """The current run of a level, and the next one as far as it is made from the leaves ahead."""

    def __init__(self, height: int) -> None:
        self.span, self.reach = FANOUT**height, FANOUT ** (height + 1)
        self.stack, self.now, self.ahead = Treehash(height), [], []

    def add(self, leaf: str, last: bool) -> None:
        for node in (self.stack.add(leaf), self.stack.end() if last else None):
            if node is not None:
                self.ahead.append(node)

    def turn(self) -> None:
        self.now, self.ahead = self.ahead, []


def height_of(n: int) -> int:
    """Levels of a tree of n leaves up to its one root."""
    h = 0
    while n > 1:
        n, h = -(-n // FANOUT), h + 1
    return h


def root_of(leaves: list[str], height: int) -> str:
    stack = Treehash(height)
    done = [x for x in [*map(stack.add, leaves), stack.end()] if x is not None]
    return done[-1]


def traversed(leaves: list[str], height: int) -> Iterator[list[tuple[str, str]]]:
    """The siblings (left, right) of each leaf in turn, level by level, below a root of the given height.

    Beside the leaves of the block, two runs a level are held: before the first step each level has its first run, and with each
    step it takes one leaf, a whole run ahead.
    """
    levels, n = [Level(h) for h in range(height)], len(leaves)
    for level in levels:
        for k in range(min(n, level.reach)):
            level.add(leaves[k], k == n - 1)
        level.turn()
    for k in range(n):
        places = [(level.now, k // level.span % FANOUT) for level in levels]
        yield [("".join(run[:at]), "".join(run[at + 1 :])) for run, at in places]
        for level in levels:
            if k + level.reach < n:
                level.add(leaves[k + level.reach], k + level.reach == n - 1)
            if (k + 1) % level.reach == 0:
                level.turn()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, list], dict | None]]:
    """Runs of rows of one (g, block), which arrive one after the other; and the row in front of them (at is -1), if there is one."""
    rows, head, key = None, None, None
    for batch in batches:
        cells = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            if (cells["g"][i], cells["block"][i]) != key:
                if rows and rows["at"]:
                    yield rows, head
                key, head, rows = (cells["g"][i], cells["block"][i]), None, {name: [] for name in cells}
            if cells["at"][i] < 0:
                head = {name: cells[name][i] for name in cells}
            else:
                for name, column in rows.items():
                    column.append(cells[name][i])
    if rows and rows["at"]:
        yield rows, head


def _numbered(rows: DataFrame, folder: str) -> DataFrame:
    """rows (g, o, leaf, ...) with their place `at` in g, by o and leaf, and the size `n` of g; written.

    Equal rows are told apart by a number, so that ranges can part them.
    """
    order = ["g", "o", "leaf", "tie"]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = save(dealt.drop("tie").withColumn("row", F.monotonically_increasing_id()), f"{folder}/dealt").withColumn("part", F.shiftright("row", 33))
    parts = dealt.groupBy("part", "g").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    g = Window.partitionBy("g")
    before = g.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.select("part", "g", (F.sum("rows").over(before) - F.col("rows") - F.col("first")).alias("shift"), F.sum("rows").over(g).alias("n"))
    return save(dealt.join(parts, ["part", "g"]).withColumn("at", F.col("row") + F.col("shift")).drop("row", "part", "shift", "o"), f"{folder}/numbered")


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("g", "block").sortWithinPartitions("g", "block", "at")


def _climbed(nodes: DataFrame, folder: str) -> tuple[list[DataFrame], DataFrame]:
    """Storeys (g, at, n, leaf, ...) from the leaves upwards, and (g, storey, root) of the groups. A storey holds the roots of the blocks below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _blocks(batches):
            n = rows["n"][0]
            root = root_of(rows["leaf"], min(LEVELS, height_of(n)))
            yield pa.RecordBatch.from_pylist([{"g": rows["g"][0], "at": rows["block"][0], "n": -(-n // BLOCK), "leaf": root}], schema=schema)

    schema = pa.schema([("g", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("leaf", pa.string())])
    storeys, roots = [nodes], None
    while True:
        below = storeys[-1].select("g", "at", "n", "leaf", F.expr(f"at div {BLOCK}").alias("block"))
        above = save(_in_blocks(below).mapInArrow(run, "g string, at long, n long, leaf string"), f"{folder}/storey-{len(storeys)}")
        top = above.where("n = 1").select("g", F.lit(len(storeys) - 1).alias("storey"), F.col("leaf").alias("root"))
        roots = top if roots is None else roots.unionByName(top)
        above = above.where("n > 1")
        if above.isEmpty():
            return storeys, roots
        storeys.append(above)


def _descended(storeys: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """(carried, path, subroot, root) of each leaf. tops: (g, storey, subroot, root, path) of the groups, path leading on from the group's root."""
    above = None
    for k in range(len(storeys) - 1, -1, -1):
        with_ = carried if k == 0 else ["g", "at"]
        heads = tops.where(F.col("storey") == k).select("g", F.lit(0).cast("long").alias("block"), "subroot", "root", "path")
        if above is not None:
            heads = heads.unionByName(above.select("g", F.col("at").alias("block"), "subroot", "root", "path"))
        heads = heads.withColumns({"at": F.lit(-1).cast("long"), "n": F.lit(None).cast("long"), "leaf": F.lit(None).cast("string")})
        rows = storeys[k].withColumn("block", F.expr(f"at div {BLOCK}")).select("g", "block", "at", "n", "leaf", *(c for c in with_ if c not in ("g", "at", "n", "leaf")))
        both = _in_blocks(rows.unionByName(heads, allowMissingColumns=True))
        fields = {f.name: f.dataType.simpleString() for f in both.schema}
        schema = ", ".join(f"`{c}` {fields[c]}" for c in [*with_, "subroot", "root", "path"])
        above = both.mapInArrow(_attach(with_), schema)
    return above


def _attach(carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for batch in batches:
                schema = batch.schema
                yield batch

        for rows, head in _blocks(seen()):
            size, upper = len(rows["at"]), [(x["left"], x["right"]) for x in head["path"]]
            left, right, begin, a = [], [], [0], 0
            for k, path in enumerate(traversed(rows["leaf"], min(LEVELS, height_of(rows["n"][0])))):
                for x, y in (*path, *upper):
                    left.append(x)
                    right.append(y)
                begin.append(len(left))
                if k + 1 - a == BATCH or k + 1 == size:
                    paths = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"]))
                    cells = [pa.array(rows[c][a : k + 1], schema.field(c).type) for c in carried]
                    tops = [pa.array([head[c]] * (k + 1 - a), pa.string()) for c in ("subroot", "root")]
                    yield pa.RecordBatch.from_arrays([*cells, *tops, paths], [*carried, "subroot", "root", "path"])
                    left, right, begin, a = [], [], [0], k + 1

    return run


def manifest(leaves: DataFrame, group: str, order: str, leaf: str = "leaf") -> DataFrame:
    """All columns of leaves with at (place in its group), subroot, root and path (siblings, level by level, up to the root).

    leaves has one row a leaf: the columns named, and others that are carried along. Columns that are called at, subroot, root or
    path are refused. Lineage is cut by tables in the shared folder, which hold hashes and the carried columns only.
    """
    spark, folder = leaves.sparkSession, shared_dir(leaves.sparkSession, "merkle")
    if clash := {"at", "subroot", "root", "path"} & {c.lower() for c in leaves.columns}:
        raise ValueError(f"columns that the result adds are there already: {sorted(clash)}")
    own = [f"c{k}" for k in range(len(leaves.columns))]
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))  # null comes first
    rows = leaves.select(name.alias("g"), F.col(f"`{order}`").alias("o"), F.col(f"`{leaf}`").alias("leaf"), *(F.col(f"`{c}`").alias(o) for c, o in zip(leaves.columns, own, strict=True)))
    nodes = _numbered(save(rows, f"{folder}/leaves"), folder)
    discard(spark, f"{folder}/leaves")
    storeys, roots = _climbed(nodes, f"{folder}/rows")

    groups = _numbered(roots.select(F.lit("").alias("g"), F.col("g").alias("o"), F.col("root").alias("leaf"), F.col("g").alias("of"), "storey"), f"{folder}/groups")
    upper, summit = _climbed(groups, f"{folder}/groups")
    nothing = F.array().cast(PATH)
    summit = summit.select("g", "storey", F.lit("").alias("subroot"), "root", nothing.alias("path"))
    tops = save(_descended(upper, summit, ["of", "storey", "leaf"]).select(F.col("of").alias("g"), "storey", F.col("leaf").alias("subroot"), "root", "path"), f"{folder}/tops")
    done = _descended(storeys, tops, [*own, "at"])
    return done.select(*(F.col(o).alias(c) for c, o in zip(leaves.columns, own, strict=True)), "at", "subroot", "root", "path")


def report(docs: DataFrame) -> DataFrame:
    """The manifest of documents with each proof checked; of a fifth of the rows, an altered text is held against it."""
    text = F.col("text").cast("string")
    whole = lambda t: leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), t)
    # fixed values: which rows are tampered with, and how
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = docs.select("doc_id", "source", whole(text).alias("leaf"), F.when(struck, whole(lowered)).alias("tampered"))
    made = manifest(leaves, "source", "doc_id")
    made = made.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return made.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
