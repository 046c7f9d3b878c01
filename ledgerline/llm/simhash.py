"""SimHash near-duplicates: fingerprints, BK-trees per shard, components.

Two fingerprints within ``radius`` bits agree in whole blocks of bits: of radius + t blocks
at least t are untouched. A shard is all fingerprints with the same value in t chosen
blocks, so every linked pair meets in a shard, and a query only visits the trees of its own
shards. Each shard (or block of a large one) becomes a BK-tree; a search follows only the
edges whose distance lies within the radius of the query's distance to the node.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import arrow, in_slices, table, utf8, written
from ledgerline.llm.components import components
from ledgerline.operators.relational import join_lookup

SHINGLE = 3
RADIUS = 3
SEED = 42
# Fingerprints of a tree; a larger shard is cut into blocks that meet pair by pair.
TREE = 768


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles; a text without words has 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        spans = [(0, len(joined))]
    else:
        starts = np.concatenate(([0], ends[:-shingle] + 1))
        spans = zip(starts.tolist(), ends[shingle - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (the 64 bits as a long) of every row; whole texts, no shuffle."""
    schema = "doc_id long, fingerprint long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            marks = np.array([fingerprint(t, shingle) for t in utf8(batch)], np.uint64).view(np.int64)
            yield arrow(schema, {"doc_id": batch.column("doc_id"), "fingerprint": marks})

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


class BKTree:
    """Values in a tree whose edges carry the Hamming distance between parent and child."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        node, fresh = 0, len(self.values)
        self.values.append(value)
        self.children.append({})
        while node != fresh:
            node = self.children[node].setdefault((self.values[node] ^ value).bit_count(), fresh)

    def within(self, value: int, radius: int) -> list[int]:
        """Positions of the values at most ``radius`` bits away."""
        found, open_nodes = [], [0] if self.values else []
        values, children = self.values, self.children
        while open_nodes:
            node = open_nodes.pop()
            distance = (values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            low, high = distance - radius, distance + radius
            open_nodes += [child for edge, child in children[node].items() if low <= edge <= high]
        return found


def _masks(radius: int, kept: int) -> list[int]:
    """Bit masks of every choice of ``kept`` out of radius + kept blocks."""
    edges = np.linspace(0, 64, radius + kept + 1).round().astype(int)
    blocks = [sum(1 << int(b) for b in range(a, z)) for a, z in zip(edges, edges[1:])]
    chosen = [sum(c) for c in combinations(blocks, kept)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def _kept_blocks(distinct: int) -> int:
    """Blocks that must agree: longer shard keys for more fingerprints. Results are the same."""
    return 1 if distinct <= 1 << 20 else 2 if distinct <= 1 << 28 else 3


def _links(groups: Iterator[tuple], radius: int) -> Iterator[tuple[int, int]]:
    """(node, smallest linked node) of every unit: as many rows as nodes at most."""
    for (_, _, i, j), rows in groups:
        rows = list(rows)
        if len(rows) < 2:
            continue
        parent = list(range(len(rows)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        tree, at = BKTree(), []
        if i != j:  # two blocks: one is the tree, the other asks
            for x, row in enumerate(rows):
                if row[4] == i:
                    tree.add(row[5])
                    at.append(x)
        for x, row in enumerate(rows):
            if i != j and row[4] == i:
                continue
            for hit in tree.within(row[5], radius):
                a, b = root(at[hit]), root(x)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if i == j:
                tree.add(row[5])
                at.append(x)
        low: dict[int, int] = {}
        for x, row in enumerate(rows):
            r = root(x)
            low[r] = min(low.get(r, row[6]), row[6])
        for x, row in enumerate(rows):
            if row[6] != low[root(x)]:
                yield row[6], low[root(x)]


def link_classes(classes: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Edges (u, v) that connect all classes whose fingerprints are within ``radius`` bits.

    ``classes`` has fingerprint (distinct) and node. Not every pair is returned, only enough
    edges for the components; a unit of work returns no more edges than it has classes.
    """
    masks = _masks(radius, _kept_blocks(classes.count()))
    keys = classes.select(
        "node", "fingerprint",
        F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks])).alias("part", "shard"),
    )
    sizes = keys.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") > tree).select("part", "shard", F.ceil(F.col("n") / tree).cast("int").alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("fingerprint"), blocks).cast("int")
    units = (
        join_lookup(keys, large, ["part", "shard"]).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("part", "shard", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fingerprint", "node")
    )
    unit = ["part", "shard", "i", "j"]
    schema = "u long, v long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            r for b in batches
            for r in zip(*(c.to_pylist() for c in b.columns[:5]), b.column(5).to_numpy().view(np.uint64).tolist(), b.column(6).to_pylist())
        )
        edges = []
        for edge in _links(groupby(rows, key=lambda r: r[:4]), radius):
            edges.append(edge)
            if len(edges) >= 50_000:
                yield arrow(schema, dict(zip("uv", zip(*edges))))
                edges = []
        if edges:
            yield arrow(schema, dict(zip("uv", zip(*edges))))

    return units.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, schema)


def _grouped(documents: DataFrame, shingle: int, radius: int) -> DataFrame:
    """doc_id, fingerprint, own_group, component_id of every row; groups are named by a fingerprint.

    Classes are nodes by their fingerprint, as one doc_id may stand in several of them.
    """
    marks = written(fingerprints(documents, shingle), "fingerprints")
    classes = written(
        marks.filter("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
        .withColumn("node", F.col("fingerprint")), "classes"
    )
    found = components(link_classes(classes, radius))
    named = join_lookup(classes, found, ["node"]).select("fingerprint", "first", F.coalesce("component", "node").alias("own_group"))
    lowest = named.groupBy("own_group").agg(F.min("first").alias("component_id"))
    named = join_lookup(named, lowest, ["own_group"]).select("fingerprint", "own_group", "component_id")
    own = [F.when(F.col("doc_id").isNotNull(), F.col(c)).alias(c) for c in ("own_group", "component_id")]
    return join_lookup(marks, named, ["fingerprint"]).select("doc_id", "fingerprint", *own)


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (long), component_id of every row of ``documents``.

    Two documents are linked if their fingerprints differ in at most ``radius`` bits;
    component_id is the smallest doc_id reachable. Equal fingerprints (copies, repeated
    rows, and all texts without words, whose fingerprint is 0) are one class, so copies cost
    one row. Different texts under one doc_id are linked by their fingerprints only. NULL text
    is empty text. A row without doc_id gets its fingerprint and no component, and links
    nothing. Only doc_id and text are read; an empty table gives no rows.
    """
    return _grouped(documents, shingle, radius).select("doc_id", "fingerprint", "component_id")


def _with_fingerprint(documents: DataFrame, name: str, shingle: int) -> DataFrame:
    """All columns, and the fingerprint of the text; no shuffle."""
    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            marks = np.array([fingerprint(t, shingle) for t in utf8(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks)], names=[*batch.schema.names, name])

    return documents.mapInArrow(run, schema)


def keep_one(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The row with the smallest doc_id of every group of near-duplicates, with all its columns.

    Rows without doc_id cannot be told apart and stay. Different texts under one doc_id are
    judged apart, by their fingerprints; of several rows of a group with the kept doc_id one
    stays. Ids on several rows are looked for first, so that texts are shuffled only for them.
    """
    groups = written(_grouped(documents, shingle, radius), "groups")
    nameless = not groups.filter("doc_id is null").isEmpty()
    kept = written(
        groups.filter("doc_id is not null").groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("doc_id") == F.col("component_id")).alias("stays")).filter("stays").select("doc_id", "n"), "kept"
    )
    repeated = not kept.filter("n > 1").isEmpty()
    # A name that no column of the documents has.
    key = "kept_" + "_".join(documents.columns)
    own = documents["doc_id"].cast("long")

    def those(ids: DataFrame) -> DataFrame:
        # Hashing the ids of a partition needs no sort of the texts, and is the plan for any size.
        return documents.join(ids.select(F.col("doc_id").alias(key)).hint("shuffle_hash"), own == F.col(key), "left_semi")

    out = those(kept.filter("n = 1") if repeated else kept)
    if repeated:
        chosen = groups.filter("doc_id = component_id").groupBy("own_group").agg(F.min("doc_id").alias(key + "_id"), F.min("fingerprint").alias(key + "_print"))
        several = _with_fingerprint(those(kept.filter("n > 1")), key, shingle)
        same = (several["doc_id"].cast("long") == chosen[key + "_id"]) & (several[key] == chosen[key + "_print"])
        out = out.unionByName(several.join(chosen, same, "left_semi").dropDuplicates(["doc_id", key]).drop(key))
    return out.unionByName(documents.filter("doc_id is null")) if nameless else out


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
