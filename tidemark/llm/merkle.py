"""Operator 12. A Merkle manifest of a table, in van Emde Boas layout.

Every row is a leaf: SHA-256 (lower-case hex, `H`) of its fields one after another,
each `-` if null, else its UTF-8 byte count, `:` and its value. The leaves of a
language ascend by `doc_id`. While a language has several nodes, every `FANOUT`
consecutive ones become their H, the last run as it is; what remains is the
language's subroot. The subroots, ordered by language (null first, then by UTF-8
bytes), become the root in the same way.

Layout. A tree is cut into aligned blocks of `HEIGHT` levels above their lowest
nodes, so of `FANOUT ** HEIGHT` lowest nodes at most. A block is one row: its
nodes' digests of 32 bytes in van Emde Boas order. A tree of L levels is split at
half its height into a top tree and the trees below, each stored whole and split
in the same way, so a run of siblings lies together with its parent whatever the
size of a cache line or page. `addresses` computes the places, for building a
block as well as for reading siblings from it.

Blocks of one stage are the lowest nodes of the next: stages recurse over block
roots until a tree is one block. Every block is built in one task from rows of
bounded number. A proof leaves a block upwards as the siblings of the block's
root, one small row per block, so no path is copied to each of the leaves.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import Scratch, scratch_path

FANOUT, HEIGHT = 8, 3
DIGEST = 32
#: Lowest nodes of a block, at most.
BLOCK_NODES = FANOUT**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

LEAVES = "tree string, pos long, total long, doc_id long, lang string, leaf binary, tampered binary"
BLOCKS = "tree string, block long, total long, height int, n long, nodes binary, root binary"
PATHS = "tree string, block long, path binary"


def H(*parts: str) -> str:
    """SHA-256 of the parts one after another, as lower-case hex."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# Layout


def size(levels: int) -> int:
    """Nodes of a whole tree of so many levels."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def addresses(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Van Emde Boas places of the nodes `index` at `depth` (0: the root) of a whole
    tree of `levels` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return addresses(top, depth, index)
    below, width = levels - top, FANOUT ** (depth - top)
    return size(top) + index // width * size(below) + addresses(below, depth - top, index % width)


@cache
def _places(height: int) -> list[np.ndarray]:
    """For each level above the lowest (0), the places of its nodes in a block."""
    return [
        addresses(height + 1, height - level, np.arange(FANOUT ** (height - level)))
        for level in range(height + 1)
    ]


def height_of(n: int) -> int:
    """Levels above the lowest that `n` nodes need, in a block at most `HEIGHT`."""
    height = 0
    while n > 1 and height < HEIGHT:
        n, height = -(-n // FANOUT), height + 1
    return height


def built(lowest: list[str], height: int) -> bytes:
    """A block's digests by place; places without a node are left zero."""
    nodes = bytearray(DIGEST * size(height + 1))
    level = lowest
    for at in _places(height):
        for place, digest in zip(at.tolist(), level, strict=False):
            nodes[DIGEST * place : DIGEST * (place + 1)] = bytes.fromhex(digest)
        level = [H(*level[i : i + FANOUT]) for i in range(0, len(level), FANOUT)]
    return bytes(nodes)


def siblings(nodes: bytes, height: int, n: int, leaf: int) -> list[tuple[int, list[str]]]:
    """For each level from the lowest up: the node's place in its run, and the run's others."""
    out, index = [], leaf
    for level in range(height):
        first = index - index % FANOUT
        others = [i for i in range(first, min(first + FANOUT, n)) if i != index]
        at = _places(height)[level]
        found = [nodes[DIGEST * at[i] : DIGEST * (at[i] + 1)].hex() for i in others]
        out.append((index - first, found))
        index, n = index // FANOUT, -(-n // FANOUT)
    return out


# Paths: per level one byte for the place in the run, one for the number of
# others, then their digests.


def packed_path(steps: list[tuple[int, list[str]]]) -> bytes:
    return b"".join(
        bytes([place, len(others)]) + bytes.fromhex("".join(others)) for place, others in steps
    )


def unpacked_path(path: bytes) -> list[tuple[int, list[str]]]:
    steps, at = [], 0
    while at < len(path):
        place, n = path[at], path[at + 1]
        at += 2
        steps.append((place, [path[at + DIGEST * i : at + DIGEST * (i + 1)].hex() for i in range(n)]))
        at += DIGEST * n
    return steps


def folded(leaf: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and its path lead to."""
    for place, others in steps:
        leaf = H(*others[:place], leaf, *others[place:])
    return leaf


def proof_digest(steps: list[tuple[int, list[str]]]) -> str:
    return H(*(digest for _, others in steps for digest in others))


# Leaves


def _field(column: Column) -> Column:
    text = column.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(counted, F.lit("-"))


def leaf_digest(text: Column) -> Column:
    """Digest of a row (hex) with `text` in place of its own."""
    own = [text if name == "text" else F.col(name) for name in FIELDS]
    return F.sha2(F.concat(*map(_field, own)), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_tampered() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0


def leaf_rows(docs: DataFrame) -> DataFrame:
    """Narrow rows of the table's leaves, the only pass over its texts. `tree` names
    a language so that null comes first and others follow by their bytes."""
    changed = F.when(is_tampered(), leaf_digest(lower_ascii(F.col("text"))))
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.unhex(leaf_digest(F.col("text"))).alias("leaf"),
        F.unhex(changed).alias("tampered"),
    )


def numbered(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """`rows` with `pos`, their rank from 0 within their `tree` by `order`, and `total`,
    the rows of the tree.

    Rows are dealt by ranges of (tree, order), so that a tree of any size is
    spread; a rank is the rows before it in its task and those of its tree in the
    tasks before, of which there is one row each.
    """
    ordered = ["tree", *order]
    dealt = rows.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    dealt = scratch.staged(
        dealt.select(
            "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")
        ),
        "merkle-order",
    )
    runs = dealt.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "tree",
        "part",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("base"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total"),
    )
    pos = (F.col("row") + F.col("base")).alias("pos")
    return dealt.join(starts, ["tree", "part"]).select(*rows.columns, pos, "total")


# Blocks


_ARROW = {
    "string": pa.string(),
    "long": pa.int64(),
    "int": pa.int32(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
}


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    fields = [field.split() for field in schema.split(", ")]
    target = pa.schema([(name, _ARROW[kind]) for name, kind in fields])
    columns = list(zip(*rows, strict=True)) or [[]] * len(target)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)]
    return pa.Table.from_arrays(arrays, schema=target)


def _block_row(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("pos")
    n = rows.num_rows
    # a block beside others stands for `HEIGHT` levels, however few nodes it has
    total = rows.column("total")[0].as_py()
    height = HEIGHT if total > BLOCK_NODES else height_of(n)
    nodes = built([digest.hex() for digest in rows.column("digest").to_pylist()], height)
    tree, block = (k.as_py() for k in key)
    return _table(BLOCKS, [(tree, block, total, height, n, nodes, nodes[:DIGEST])])


def _blocks(lowest: DataFrame) -> DataFrame:
    """Blocks over rows of (tree, pos, total, digest)."""
    block = F.floor(F.col("pos") / BLOCK_NODES).alias("block")
    rows = lowest.select("tree", block, "pos", "total", "digest")
    return rows.groupBy("tree", "block").applyInArrow(_block_row, BLOCKS)


def _stages(lowest: DataFrame, folder: str) -> list[DataFrame]:
    """Blocks over the lowest nodes, over their roots, and so on until each tree is
    one block; written one after another."""
    spark, stages = lowest.sparkSession, []
    while True:
        path = f"{folder}-{len(stages)}"
        _blocks(lowest).write.parquet(path)
        stages.append(spark.read.schema(BLOCKS).parquet(path))
        unfinished = stages[-1].where(F.col("total") > BLOCK_NODES)
        if unfinished.isEmpty():
            return stages
        lowest = unfinished.select(
            "tree",
            F.col("block").alias("pos"),
            F.ceil(F.col("total") / BLOCK_NODES).alias("total"),
            F.col("root").alias("digest"),
        )


@dataclass(frozen=True)
class Manifest:
    """A written manifest: leaves, the stages of their trees, subroots, and the
    stages of the tree over the subroots."""

    leaves: DataFrame
    stages: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]

    @property
    def root(self) -> DataFrame:
        """One row with `root`, none for an empty table."""
        return self.top[-1].select("root")


def _tree_roots(stages: list[DataFrame]) -> DataFrame:
    """(tree, digest) of each tree, from the stage at which it is one block."""
    whole = [stage.where(F.col("total") <= BLOCK_NODES) for stage in stages]
    return reduce(DataFrame.unionByName, whole).select("tree", F.col("root").alias("digest"))


def write_manifest(docs: DataFrame, folder: str) -> Manifest:
    """Write the manifest of `docs` as tables below `folder`.

    `docs` needs `doc_id, source, lang, n_chars, text`; other columns are not
    read. Null fields count as `-`; a null `doc_id` comes first, and is never
    tampered with. Rows that repeat an id are leaves each, in order of their
    digest. An empty table has no leaves and no root.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        rows = scratch.staged(leaf_rows(docs), "merkle-leaves")
        placed = numbered(rows, ["doc_id", "leaf"], scratch)
        placed.select([c.split()[0] for c in LEAVES.split(", ")]).write.parquet(f"{folder}/leaves")
        leaves = spark.read.schema(LEAVES).parquet(f"{folder}/leaves")
        stages = _stages(leaves.select("tree", "pos", "total", F.col("leaf").alias("digest")), f"{folder}/stage")
        roots = scratch.staged(_tree_roots(stages), "merkle-roots")
        one_tree = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
        numbered(one_tree, ["name"], scratch).write.parquet(f"{folder}/subroots")
        subroots = spark.read.schema(
            "tree string, name string, digest binary, pos long, total long"
        ).parquet(f"{folder}/subroots")
        top = _stages(subroots.select("tree", "pos", "total", "digest"), f"{folder}/top")
    return Manifest(leaves, stages, subroots, top)


# Proofs


def _paths_below(key: tuple, blocks: pa.Table, above: pa.Table) -> pa.Table:
    """Paths of a block's lowest nodes: their own siblings, then the block's path."""
    tree, number = (k.as_py() for k in key)
    block, upper = blocks.to_pylist()[0], above.column("path")[0].as_py()
    n, first = block["n"], number * BLOCK_NODES
    paths = [packed_path(siblings(block["nodes"], block["height"], n, i)) for i in range(n)]
    return _table(PATHS, [(tree, first + i, path + upper) for i, path in enumerate(paths)])


def _paths(stages: list[DataFrame], above: DataFrame, scratch: Scratch) -> DataFrame:
    """Paths (tree, block, path) of the blocks of the first stage. `above` holds
    paths of whole trees, as their block 0."""
    keys = ["tree", "block"]
    for stage in reversed(stages[1:]):
        made = stage.groupBy(*keys).cogroup(_only(above, stage).groupBy(*keys)).applyInArrow(
            _paths_below, PATHS
        )
        # trees that are one block already keep their path
        above = scratch.staged(
            made.unionByName(above.join(stage.select("tree").distinct(), "tree", "left_anti")),
            "merkle-paths",
        )
    return above


def _only(paths: DataFrame, stage: DataFrame) -> DataFrame:
    return paths.join(stage.select("tree").distinct(), "tree", "left_semi")


PROOFS = (
    "doc_id long, lang string, leaf string, subroot string, root string, proof_sha256 string,"
    " folded_root string, verified boolean"
)


def _proved(_: tuple, leaves: pa.Table, blocks: pa.Table) -> pa.Table:
    block = blocks.to_pylist()[0]
    upper = unpacked_path(block["path"])
    subroot, root = block["subroot"].hex(), block["root"].hex()
    out = []
    for row in leaves.to_pylist():
        own = siblings(block["nodes"], block["height"], block["n"], row["pos"] % BLOCK_NODES)
        steps, leaf = own + upper, row["leaf"].hex()
        found = folded(leaf if row["tampered"] is None else row["tampered"].hex(), steps)
        proof = proof_digest(steps)
        out.append((row["doc_id"], row["lang"], leaf, subroot, root, proof, found, found == root))
    return _table(PROOFS, out)


def proofs(manifest: Manifest, scratch: Scratch) -> DataFrame:
    """One row per leaf: its digest, subroot and root, the digest of its proof, and
    what the tampered leaf (else its own) folds up to."""
    spark = manifest.leaves.sparkSession
    root = manifest.root.first()
    if root is None:
        return spark.createDataFrame([], PROOFS)
    keys = ["tree", "block"]
    top = _paths(manifest.top, spark.createDataFrame([("", 0, b"")], PATHS), scratch)
    of_subroots = manifest.top[0].groupBy(*keys).cogroup(top.groupBy(*keys)).applyInArrow(
        _paths_below, PATHS
    )
    named = scratch.staged(
        of_subroots.withColumnRenamed("block", "pos")
        .join(manifest.subroots, ["tree", "pos"])
        .select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot")),
        "merkle-subroots",
    )
    above = named.select("tree", F.lit(0).cast("long").alias("block"), "path")
    paths = _paths(manifest.stages, above, scratch)
    blocks = (
        manifest.stages[0]
        .select(*keys, "height", "n", "nodes")
        .join(paths, keys)
        .join(named.select("tree", "subroot"), "tree")
        .withColumn("root", F.lit(root.root))
    )
    leaves = manifest.leaves.withColumn("block", F.floor(F.col("pos") / BLOCK_NODES))
    return leaves.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(_proved, PROOFS)


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """Write a manifest of `docs` to the scratch folder and prove every row from it."""
    spark: SparkSession = docs.sparkSession
    folder = scratch_path(spark, "manifest")
    manifest = write_manifest(docs, folder)
    path = scratch_path(spark, "manifest-proofs")
    with Scratch(spark) as scratch:
        found = proofs(manifest, scratch).drop("lang")
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)
