"""Exact top-k by inner product over a bit-sliced index.

The index is a table of blocks. A block holds, for each attribute (vector component), the high
bits of its values as bitmaps over the block's rows, and the values themselves. A query adds the
slices of all attributes, each as often as the query's weight says, by carry-save bitmap
arithmetic: the sum is again a list of slices, an approximate score per row. The k-th highest sum
is found from the most significant slice downward. What the dropped low bits can change is bounded,
so rows near the boundary are taken as well and scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow, scratch, table, written

SCALE = 1024
K = 10
# Rows of a block, high bits kept as slices, queries that are sent to the executors at a time.
BLOCK_ROWS = 8192
SLICES = 8
QUERY_ROWS = 4096
# Quantised components are cut off here, far beyond what any embedding holds.
LARGEST = (1 << 62) - 1
# Up to this size of components and number of them, a score fits a long by far.
PLAIN = 1 << 24


def quantised(vectors: Column) -> Column:
    """floor(1024 * x) of every component, in double arithmetic, as longs."""
    high = F.lit(float(LARGEST))
    return F.transform(vectors, lambda x: F.floor(F.least(F.greatest(x.cast("double") * SCALE, -high), high)))


def usable(vectors: Column) -> Column:
    """Whether a vector takes part: there, not empty, and every component a finite number."""
    broken = F.exists(vectors, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return vectors.isNotNull() & (F.size(vectors) > 0) & ~broken


def sliced(values: np.ndarray, slices: int = SLICES) -> tuple[np.ndarray, np.ndarray, int]:
    """Bitmaps [component, slice from low to high, word], smallest value per component, bits dropped."""
    low = values.min(0)
    lifted = values - low
    bits = max(1, int(lifted.max()).bit_length())
    shift = max(0, bits - slices)
    kept = (lifted >> shift).astype(np.uint64)
    padded = -len(values) % 64
    maps = np.empty((values.shape[1], bits - shift, (len(values) + padded) // 64), np.uint64)
    for b in range(bits - shift):
        plane = ((kept >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T
        plane = np.pad(plane, ((0, 0), (0, padded)))
        maps[:, b] = np.ascontiguousarray(np.packbits(plane, axis=1, bitorder="little")).view("<u8")
    return maps, low, shift


def add_slices(maps: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Slices, low to high, of the sum over components of |weight| times the component's slices.

    The slices of a component with a negative weight are complemented first: what a large
    value takes away there, a small one leaves.
    """
    components, bits, words = maps.shape
    signed = np.where((weights < 0)[:, None, None], ~maps, maps).reshape(components * bits, words)
    size = np.abs(weights)
    place = np.arange(components)
    result: list[np.ndarray] = []
    carried = np.zeros((0, words), np.uint64)
    level, top = 0, int(size.max()).bit_length() + bits
    while level < top or len(carried):
        rows = [
            place[(size >> (level - b)) & 1 == 1] * bits + b for b in range(bits) if level >= b
        ]
        now = np.concatenate([signed[np.concatenate(rows)], carried]) if rows else carried
        carries = []
        while len(now) >= 3:  # full adders, a third of the rows at a time
            k = len(now) // 3
            a, b, c = now[:k], now[k:2 * k], now[2 * k:3 * k]
            odd = a ^ b
            carries.append((a & b) | (c & odd))
            now = np.concatenate([odd ^ c, now[3 * k:]])
        if len(now) == 2:
            carries.append((now[0] & now[1])[None])
            now = (now[0] ^ now[1])[None]
        result.append(now[0] if len(now) else np.zeros(words, np.uint64))
        carried = np.concatenate(carries) if carries else np.zeros((0, words), np.uint64)
        level += 1
    return result


def kth_highest(slices: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th highest sum among ``rows`` (a bitmap with at least k of them)."""
    value, above, equal = 0, np.zeros_like(rows), rows
    for bit in range(len(slices) - 1, -1, -1):
        with_bit = equal & slices[bit]
        if int(np.bitwise_count(above | with_bit).sum()) >= k:
            equal = with_bit
            value |= 1 << bit
        else:
            above, equal = above | with_bit, equal & ~slices[bit]
    return value


def at_least(slices: list[np.ndarray], rows: np.ndarray, value: int) -> np.ndarray:
    """Bitmap of the ``rows`` whose sum is ``value`` or more."""
    if value <= 0:
        return rows
    if value >> len(slices):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for bit in range(len(slices) - 1, -1, -1):
        if value >> bit & 1:
            equal = equal & slices[bit]
        else:
            above, equal = above | (equal & slices[bit]), equal & ~slices[bit]
    return above | equal


class Block:
    """Rows of one number of components: ids, values, slices."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, maps: np.ndarray | None, shift: int) -> None:
        self.ids, self.values, self.maps, self.shift = ids, values, maps, shift
        self.all = np.packbits(np.pad(np.ones(len(ids), np.uint8), (0, -len(ids) % 64)), bitorder="little").view("<u8")

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[list[int], list[int]]:
        """Ids and scores of the k rows with the highest exact scores, ties to smaller ids."""
        at = np.flatnonzero(self.ids != own)
        plain = self.maps is not None and int(np.abs(query).max()) < PLAIN
        if plain and len(at) > k:
            rows = self.all
            mine = np.flatnonzero(self.ids == own)
            if len(mine):
                rows = rows.copy()
                np.bitwise_and.at(rows, mine >> 6, ~(np.uint64(1) << (mine & 63).astype(np.uint64)))
            slices = add_slices(self.maps, query)
            # The dropped bits add at most this to the sums, from the k-th row's lowest to any row's highest.
            slack = int(np.abs(query).sum()) * ((1 << self.shift) - 1) >> self.shift
            near = at_least(slices, rows, kth_highest(slices, rows, k) - slack)
            at = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")[:len(self.ids)])
        if plain:
            scores = self.values[at] @ query
            order = np.lexsort((self.ids[at], -scores))[:k]
            return self.ids[at][order].tolist(), scores[order].tolist()
        exact = (self.values[at].astype(object) * query.astype(object)).sum(1) if len(at) else []
        bound = (1 << 63) - 1
        ranked = sorted((-max(-bound, min(bound, s)), i) for s, i in zip(exact, self.ids[at].tolist()))[:k]
        return [i for _, i in ranked], [-s for s, _ in ranked]


_INDEX = "components int, shift int, ids binary, values binary, maps binary"


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS, slices: int = SLICES) -> DataFrame:
    """The bit-sliced index over all rows of ``vectors`` (vec_id, q: longs), written to the shared folder."""
    count = vectors.count()

    def blocks(parts: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for size, rows in parts.items():
            ids = np.array([r[0] for r in rows], np.int64)
            values = np.array([r[1] for r in rows], np.int64).reshape(len(rows), size)
            # Components too large for plain sums get no slices; their scores are all computed exactly.
            maps, _, shift = sliced(values, slices) if size <= PLAIN and np.abs(values).max() < PLAIN else (None, None, 0)
            yield arrow(_INDEX, {
                "components": [size], "shift": [shift], "ids": [ids.tobytes()], "values": [values.tobytes()],
                "maps": [None if maps is None else maps.tobytes()],
            })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        held = 0
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts.setdefault(len(value), []).append((key, value))
                held += 1
                if held >= block_rows:
                    yield from blocks(parts)
                    parts, held = {}, 0
        yield from blocks(parts)

    return written(vectors.repartition(max(1, -(-count // block_rows))).mapInArrow(run, _INDEX), "bit-slices")


def search(index: DataFrame, queries: list[tuple[int, list[int]]], k: int = K) -> DataFrame:
    """query_id, vec_id, score: the k best of every block for each query of a bounded list."""
    shared = index.sparkSession.sparkContext.broadcast(queries)
    schema = "query_id long, vec_id long, score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, shift, ids, values, maps in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, np.int64)
                values = np.frombuffer(values, np.int64).reshape(len(ids), size)
                words = (len(ids) + 63) // 64
                block = Block(ids, values, None if maps is None else np.frombuffer(maps, np.uint64).reshape(size, -1, words), shift)
                found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
                for key, query in shared.value:
                    if len(query) == size:
                        top, scores = block.top(key, np.array(query, np.int64), k)
                        found["query_id"] += [key] * len(top)
                        found["vec_id"] += top
                        found["score"] += scores
                yield arrow(schema, found)

    return index.mapInArrow(run, schema)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k rows with the highest inner products.

    Both tables have vec_id and embedding. Components become floor(1024 * x); scores are exact;
    ties go to the smaller vec_id; a query never finds rows of its own id; fewer rows give fewer
    results. Vectors that are NULL, empty or hold NULL or non-finite components, and rows without
    vec_id, take no part; vectors of another length than the query's are no candidates. A row that
    repeats another exactly counts once; of several vectors under a query's id the smallest asks.
    Components beyond 62 bits and scores beyond a long stop there, before they are ranked. Queries go in blocks of ``query_rows``, each against
    the whole index; a block's results are written before the next, so no plan or driver memory
    grows with the queries.
    """
    def prepared(df: DataFrame) -> DataFrame:
        own = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
        return own.filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).select("vec_id", quantised(F.col("v")).alias("q"))

    index = build_index(prepared(vectors).distinct())
    asked = prepared(queries).groupBy("vec_id").agg(F.min("q").alias("q"))
    blocks = 1 + asked.count() // query_rows
    spark = vectors.sparkSession
    path = scratch(spark, "block-results")
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).collect()
        search(index, [(r["vec_id"], r["q"]) for r in rows], k).write.mode("append").parquet(path)
    found = spark.read.schema("query_id long, vec_id long, score long").parquet(path)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best rows for every vector whose id is divisible by 100."""
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"))


ORACLE = """
with whole as (
    select distinct vec_id::bigint as vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as q from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
    select a.vec_id as query_id, b.vec_id, list_inner_product(a.q::double[], b.q::double[])::bigint as score
    from (select vec_id, min(q) as q from whole where vec_id % 100 = 0 group by vec_id) a
    join whole b on a.vec_id <> b.vec_id and len(a.q) = len(b.q)
)
select query_id, rank::int as rank, vec_id, score from (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
) where rank <= 10
"""
