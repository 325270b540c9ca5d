"""From candidate pairs to components, for joins on shingle sets.

A join hands in which documents share a key with the key's smallest document, the
pivot. Its pairs are checked by what the join knows of a document (`sketch`), then
exactly on the sets of their texts, and make a graph of documents. A pair of a
key's other documents could still link: for keys with a pair that failed, all
documents that are not in one component by then, nor paired with all others of the
key, are compared sketch against sketch, in blocks of at most `BLOCK` documents, and
what sketches allow is checked exactly. So no link between components is lost that
shares any key.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_CHARS, text_slices
from tidemark.llm.components import components
from tidemark.llm.shingles import linked, shingle_sets
from tidemark.operators.skew import rows_with_keys
from tidemark.session import Scratch

#: Documents of a key that are compared in one block.
BLOCK = 512
#: Members of a hot document's pairs that one task checks.
CHECKED = 128
#: Keys, the smallest, that a document's row of a comparison takes along.
NAMED = 16

#: may(sketch, sketch, size, size): False only if a link is ruled out.
May = Callable[[bytes, bytes, int, int], bool]
#: near(labels, blocks, sizes, sketches, inner): places of pairs from two components
#: (and two blocks, unless inner) that may link.
Near = Callable[[np.ndarray, np.ndarray, np.ndarray, list, bool], tuple[np.ndarray, np.ndarray]]


def ordered(pairs: DataFrame) -> DataFrame:
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return pairs.where("a <> b").select(low, high).distinct()


def passing(pairs: DataFrame, nodes: DataFrame, may: May) -> DataFrame:
    """Pairs `a`, `b` that sizes and sketches do not rule out."""
    one, two = nodes.toDF("a", "na", "sa"), nodes.toDF("b", "nb", "sb")
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "sa", "sb")

    def work(batches):
        for batch in batches:
            _, _, na, nb, sa, sb = (c.to_pylist() for c in batch.columns)
            passed = [may(*x) for x in zip(sa, sb, na, nb, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    return joined.mapInArrow(work, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs `a`, `b` with a similarity of `percent` or more, from the sets of their texts.

    A document's text is sent to each document it is paired with; the texts of
    documents with very many partners go to several tasks, each with its share.
    The ids are written first, so that Spark sends them to the texts while they
    are few, and no other texts are shuffled.
    """
    parts = F.ceil(F.count(F.lit(1)) / CHECKED).cast("int")
    sizes = pairs.groupBy("a").agg(parts.alias("parts"))
    split = pairs.join(sizes, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    partners = split.select("a", "part", F.col("b").alias("doc_id"))
    centres = sizes.select(
        "a",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.col("a").alias("doc_id"),
    )
    wanted = scratch.staged(partners.union(centres), "link-places")
    ids = scratch.staged(wanted.select("doc_id").distinct(), "link-ids")
    wanted = wanted.join(rows_with_keys(docs, ids, ["doc_id"]), "doc_id")
    dealt = wanted.repartition("a", "part").sortWithinPartitions(
        "a", "part", F.col("doc_id") != F.col("a")
    )

    def work(batches):
        at, centres = None, []
        for piece, texts in text_slices(batches, chars=SLICE_CHARS // 2):
            columns = [piece.column(i).to_pylist() for i in range(3)]
            found = []
            for a, part, doc_id, own in zip(*columns, shingle_sets(texts), strict=True):
                if (a, part) != at:
                    at, centres = (a, part), []
                if doc_id == a:
                    centres.append(own)
                elif any(linked(centre, own, percent) for centre in centres):
                    found.append((a, doc_id))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in range(2)], names=["a", "b"]
            )

    chosen = dealt.select("a", "part", "doc_id", "text")
    return chosen.mapInArrow(work, "a long, b long").distinct()


def unmet(open_rows: DataFrame) -> DataFrame:
    """`key`, `doc_id` of a key's documents that are not paired with all others of it.

    `open_rows` has the pairs `a`, `b` of each key. What is paired with all others,
    as both documents of a key of two, has been checked against all of them.
    """
    sides = open_rows.select("key", F.col("a").alias("doc_id"), F.col("b").alias("other"))
    sides = sides.union(open_rows.select("key", "b", "a"))
    other = F.when(F.col("other") != F.col("doc_id"), F.col("other"))
    members = sides.groupBy("key", "doc_id").agg(F.count_distinct(other).alias("met"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return members.join(sizes, "key").where("met < n - 1").select("key", "doc_id")


def left_over(
    named: DataFrame,
    failed: DataFrame,
    nodes: DataFrame,
    labels: DataFrame,
    near: Near,
    scratch: Scratch,
) -> DataFrame:
    """Pairs in different components that share a key of a failed pair, as sketches
    allow; of pairs `a`, `b` of `named` not all, as they have been checked."""
    marked = failed.select("a", "b").union(failed.select("b", "a"))
    keys = named.join(marked, ["a", "b"]).select("key").distinct()
    members = scratch.staged(unmet(named.join(keys, "key")), "link-members")
    members = (
        members.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("label", F.coalesce("label", "doc_id"))
    )
    sizes = (
        members.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
        )
        .where("low <> high")
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    # a document's rows take its smallest keys along, by which a pair that shares
    # many keys is handed on once; all its keys in each row would grow with their square
    keys = (
        members.join(sizes, "key")
        .groupBy("doc_id", "label")
        .agg(
            F.collect_list(F.struct("key", "blocks")).alias("open"),
            F.slice(F.sort_array(F.collect_list("key")), 1, NAMED).alias("keys"),
        )
        .join(nodes, "doc_id")
        .withColumn("open", F.explode("open"))
        .select("*", "open.key", "open.blocks")
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    )
    dealt = keys.withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        "*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    order = ["key", "i", "j", "doc_id"]
    sorted_rows = (
        dealt.select(*order, "label", "block", "n_shingles", "sketch", "keys")
        .repartition("key", "i", "j")
        .sortWithinPartitions(*order)
    )
    return sorted_rows.mapInArrow(
        lambda batches: compare_blocks(batches, near), "a long, b long"
    ).distinct()


def compare_blocks(batches, near: Near):
    """Pairs that sketches allow, among the rows of each (key, i, j), which lie together."""
    left = None
    for batch in itertools.chain(batches, [None]):
        if batch is None and left is None:
            return
        table = left if batch is None else pa.Table.from_batches([batch])
        if batch is not None and left is not None:
            table = pa.concat_tables([left, table])
        if not table.num_rows:
            continue
        group = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
        starts = np.flatnonzero(np.r_[True, (group[:, 1:] != group[:, :-1]).any(axis=0)])
        # the last group may go on in the next batch
        whole = table.num_rows if batch is None else int(starts[-1])
        left = None if batch is None else table.slice(whole)
        ids, labels, blocks, sizes = (
            table.column(c).to_numpy() for c in ("doc_id", "label", "block", "n_shingles")
        )
        sketches, keys = (table.column(c).to_pylist() for c in ("sketch", "keys"))
        inner = group[1] == group[2]
        found: list[np.ndarray] = []
        for low, high in zip(starts, np.r_[starts[1:], table.num_rows], strict=True):
            if high > whole:
                break
            part = slice(low, high)
            if (labels[part] != labels[low]).any():
                x, y = near(labels[part], blocks[part], sizes[part], sketches[part], inner[low])
                own = int(group[0, low])
                # the smallest keys of both name the smallest key the two share, or none
                # of them: then each key they share hands the pair on
                first = [
                    min(set(keys[low + i]).intersection(keys[low + j]), default=own) == own
                    for i, j in zip(x.tolist(), y.tolist(), strict=True)
                ]
                x, y = x[np.array(first, dtype=bool)], y[np.array(first, dtype=bool)]
                found.append(np.stack([ids[part][x], ids[part][y]]))
        pairs = np.concatenate(found, axis=1) if found else np.empty((2, 0), dtype=np.int64)
        pairs = np.unique(pairs, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def labelled(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """`rows` with the labels of the nodes in `column`, where they have one."""
    joined = rows.join(labels.toDF(column, "label"), column, "left")
    return joined.withColumn(column, F.coalesce("label", column)).select(rows.columns)


def copies_of_sets(rows: DataFrame) -> DataFrame:
    """(doc_id, rep): the smallest document with an equal set, by size and digest."""
    same = ["n_shingles", "da", "db"]
    first = rows.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    return rows.join(first, same).select("doc_id", "rep").distinct()


def linked_components(
    docs: DataFrame,
    rows: DataFrame,
    reps: DataFrame,
    shared: DataFrame,
    may: May,
    near: Near,
    percent: int,
    scratch: Scratch,
) -> DataFrame:
    """(doc_id, component_id) of all documents in `reps`; the result reads `scratch`.

    `docs` has doc_id and text, `rows` the sketches, `shared` (key, pivot, doc).
    """
    usable = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    named = scratch.staged(
        shared.join(reps.toDF("pivot", "a"), "pivot")
        .join(reps.toDF("doc", "b"), "doc")
        .select("key", "a", "b"),
        "link-keys",
    )
    pairs = scratch.staged(ordered(named), "link-pairs")
    # sketches are shuffled for documents that are in a pair, and made ready once
    paired = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    paired = scratch.staged(paired, "link-paired")
    nodes = rows_with_keys(usable, paired, ["doc_id"])
    nodes = nodes.dropDuplicates(["doc_id", "n_shingles", "da", "db"])
    nodes = scratch.staged(nodes.select("doc_id", "n_shingles", "sketch"), "link-nodes")

    def links_of(some: DataFrame, name: str) -> DataFrame:
        allowed = scratch.staged(passing(some, nodes, may), f"{name}-allowed")
        return scratch.staged(verified(allowed, docs, percent, scratch), f"{name}-links")

    # each document with the smallest it is paired with, then what is still apart
    first = scratch.staged(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first-pairs")
    links = links_of(first, "first")
    # the sets of a repeated id belong together
    same_id = reps.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z"))
    same_id = reps.join(same_id.where("a < z"), "doc_id").select("a", F.col("rep").alias("b"))
    labels = components(links.union(same_id), scratch)
    second = _apart(pairs, labels).join(first, ["a", "b"], "left_anti")
    labels = _merged(labels, links_of(scratch.staged(second, "second-pairs"), "second"), scratch)
    # a pair of a key's other documents is left to find only where one of them is
    # apart from the pivot
    rest = left_over(named, _apart(pairs, labels), nodes, labels, near, scratch)
    rest = scratch.staged(ordered(rest), "links-left-over")
    labels = _merged(labels, verified(rest, docs, percent, scratch), scratch)
    named = labelled(reps.toDF("doc_id", "node"), "node", labels)
    return named.groupBy("doc_id").agg(F.min("node").alias("component_id"))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose documents are in different components."""
    one, two = labels.toDF("a", "one"), labels.toDF("b", "two")
    joined = pairs.join(one, "a", "left").join(two, "b", "left")
    return joined.where(F.coalesce("one", "a") != F.coalesce("two", "b")).select("a", "b")


def _merged(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """`labels` after some more links. What joins components is a small graph over
    their labels."""
    between = labelled(labelled(links, "a", labels), "b", labels)
    between = scratch.staged(between.where("a <> b").distinct(), "links-between")
    if between.isEmpty():
        return labels
    joined = components(between, scratch)
    moved = labels.join(joined.toDF("label", "to"), "label", "left")
    moved = moved.select("node", F.coalesce("to", "label").alias("label"))
    # labels that moved are nodes themselves from now on
    return scratch.staged(moved.unionByName(joined), "links-labels")
