"""Documents packed into sequences of a fixed length by patterns of lengths.

Only the histogram of piece lengths decides the plan: patterns of two or three lengths that
fill a sequence exactly are fitted to it by non-negative least squares, generated as the fit
needs them, their repeat counts rounded down, and what is left is packed best-fit by descending
length, many equal sequences at a time. The plan has as many rows as different patterns, however many documents there are. A
piece finds its place from its length and its number among the pieces of that length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow, in_slices, table, utf8, written
from ledgerline.llm.tokenfile import TOKENIZER, tokenizer_path
from ledgerline.llm.wordids import encoder
from ledgerline.operators.relational import same_key

LENGTH = 2048
END = 0
# Rounds in which patterns are added, and steps of the fit in each; it ends before when no pattern would help.
ROUNDS, STEPS = 24, 60


def pairs_of(present: np.ndarray, length: int) -> np.ndarray:
    """Pairs of present lengths that fill a sequence, as rows (a, b, 0)."""
    there = np.zeros(length + 1, bool)
    there[present] = True
    low = present[present * 2 <= length]
    low = low[there[length - low]]
    return np.stack([low, length - low, np.zeros_like(low)], axis=1)


def best_triples(present: np.ndarray, length: int, worth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every smallest length the triple (a, b, c) that fills a sequence and is worth most; and its worth.

    All triples of present lengths are looked at, by the sum of what their lengths are worth.
    """
    there = np.zeros(length + 1, bool)
    there[present] = True
    rows, gains = [], []
    for a in present[present * 3 <= length].tolist():
        b = present[np.searchsorted(present, a):np.searchsorted(present, (length - a) // 2, "right")]
        b = b[there[length - a - b]]
        if len(b):
            gain = worth[a] + worth[b] + worth[length - a - b]
            at = int(gain.argmax())
            rows.append((a, int(b[at]), length - a - int(b[at])))
            gains.append(float(gain[at]))
    return np.array(rows, np.int64).reshape(-1, 3), np.array(gains)


def made(shapes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Pieces of each length that the patterns hold, repeated ``counts`` times."""
    return np.bincount(shapes.ravel(), weights=np.repeat(counts, 3) * (shapes.ravel() > 0), minlength=size)


def fit_counts(
    shapes: np.ndarray, histogram: np.ndarray, weights: np.ndarray, start: np.ndarray | None = None, steps: int = STEPS
) -> np.ndarray:
    """Repeat counts >= 0 whose sums of lengths come closest to the histogram (weighted least squares).

    Projected gradient steps with momentum, restarted whenever the fit gets worse.
    """
    target = histogram.astype(float)
    real = (shapes > 0).astype(float)

    def slope(counts: np.ndarray) -> tuple[float, np.ndarray]:
        rest = made(shapes, counts, len(target)) - target
        return float((weights * rest) @ rest), ((weights * rest)[shapes] * real).sum(1)

    # The largest eigenvalue of the normal equations is at most their largest row sum.
    rows = ((weights * made(shapes, np.ones(len(shapes)), len(target)))[shapes] * real).sum(1)
    rate = 1 / max(1e-9, float(rows.max(initial=1e-9)))
    counts = np.zeros(len(shapes)) if start is None else start
    ahead, momentum, before = counts, 1.0, np.inf
    for _ in range(steps):
        error, gradient = slope(ahead)
        if error > before:
            ahead, momentum = counts, 1.0
            error, gradient = slope(ahead)
        before = error
        now = np.maximum(ahead - rate * gradient, 0.0)
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = now + (momentum - 1) / following * (now - counts)
        counts, momentum = now, following
        ahead = np.maximum(ahead, 0.0)
    return counts


def fit_patterns(histogram: np.ndarray, length: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns of two or three present lengths, and repeat counts fitted to the histogram.

    Patterns are generated as they are needed: all pairs are there from the beginning; each round
    adds the triples that the lengths still short would gain most from, until none gains. So
    every triple takes part, though few are ever held. A length counts by its square: what is
    left over of the long ones costs most.
    """
    present = np.flatnonzero(histogram)
    weights = (np.arange(len(histogram)) / length) ** 2
    shapes = pairs_of(present, length)
    counts = fit_counts(shapes, histogram, weights) if len(shapes) else np.zeros(0)
    for _ in range(rounds):
        short = weights * (histogram - made(shapes, counts, len(histogram)))
        new, gain = best_triples(present, length, short)
        new = new[gain > 0.05]
        fresh = np.unique(np.concatenate([shapes, new]), axis=0, return_index=True)[1]
        fresh = fresh[fresh >= len(shapes)] - len(shapes)
        if not len(fresh):
            break
        shapes = np.concatenate([shapes, new[fresh]])
        counts = fit_counts(shapes, histogram, weights, np.concatenate([counts, np.zeros(len(fresh))]))
        used = (counts > 1e-3) | (shapes[:, 2] == 0)
        shapes, counts = shapes[used], counts[used]
    return shapes, counts


def best_fit(left: np.ndarray, length: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit by descending length over a histogram: (lengths of a sequence, how many such)."""
    rooms: list[int] = []  # sizes of the gaps of open sequences, ascending
    groups: dict[int, list[list]] = {}
    done: list[tuple[tuple[int, ...], int]] = []

    def put(shape: tuple[int, ...], count: int, room: int) -> None:
        if room == 0:
            done.append((shape, count))
            return
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append([shape, count])

    for size in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[size])
        while todo:
            at = bisect_left(rooms, size)
            if at == len(rooms):  # nothing open is large enough: new sequences, each filled with this length
                each = length // size
                full, rest = divmod(todo, each)
                if full:
                    put((size,) * each, full, length - each * size)
                if rest:
                    put((size,) * rest, 1, length - rest * size)
                break
            room = rooms[at]
            shape, count = groups[room][-1]
            took = min(todo, count)
            if took == count:
                groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            else:
                groups[room][-1][1] -= took
            put((*shape, size), took, room - size)
            todo -= took
    return done + [(tuple(shape), count) for room in rooms for shape, count in groups[room]]


def plan(histogram: np.ndarray, length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such) for a histogram over 0..length; uses up all of it.

    Never more sequences than best-fit alone makes: where it makes fewer, its plan is taken.
    """
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    whole = [((length,), int(left[length]))] if left[length] else []
    left[length] = 0
    plain = best_fit(left, length)
    shapes, counts = fit_patterns(left, length)
    result = []
    for row in np.argsort(-counts, kind="stable").tolist():
        shape = tuple(int(x) for x in sorted(shapes[row], reverse=True) if x)
        most = min(int(left[s]) // shape.count(s) for s in shape)
        took = min(int(counts[row]), most)
        if took > 0:
            for s in shape:
                left[s] -= took
            result.append((shape, took))
    result += best_fit(left, length)
    return whole + min(result, plain, key=lambda planned: sum(n for _, n in planned))


def places(planned: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Where the n-th piece of a length goes: ranges of numbers per length, sorted for search."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for shape, count in planned:
        offset = 0
        for size in shape:
            first = used.get(size, 0)
            rows.append((size, first, sequence, offset))
            used[size] = first + count
            offset += size
        sequence += count
    rows.sort()
    size, first, sequences, offsets = (np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 4
    return {"size": size, "first": first, "sequence": sequences, "offset": offsets}


def pieces(documents: DataFrame, tokenizer: str, end: int = END, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, numbered per task and length.

    ``part`` is the task, ``nth`` the number of the piece among those of its length in the task.
    The rows are written once, so that numbers stay what they are whatever is run again.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, part = encoder(tokenizer, end), TaskContext.get().partitionId()
        seen = np.zeros(length + 1, np.int64)
        for batch in in_slices(batches):
            ids, sizes = codes.encode(utf8(batch))
            ids = ids.astype("<u4", copy=False)
            ends = np.cumsum(sizes)
            columns: dict[str, list] = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth")}
            for key, a, b in zip(batch.column("doc_id").to_pylist(), (ends - sizes).tolist(), ends.tolist()):
                for number, at in enumerate(range(a, b, length)):
                    size = min(length, b - at)
                    for name, value in zip(columns, (key, number, at - a, size, zlib.crc32(ids[at:at + size].tobytes()), part, int(seen[size]))):
                        columns[name].append(value)
                    seen[size] += 1
            yield arrow(schema, columns)

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(plain.mapInArrow(run, schema), "pieces")


def pack(documents: DataFrame, tokenizer: str, end: int = END, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    A document's ids (with ``end``) are cut only if longer than ``length``; the pieces of a
    sequence stand gapless from 0. NULL text is empty text and is its end id alone; a missing
    doc_id stays NULL; repeated rows are documents of their own; texts of any length are encoded
    whole; extra columns are not read; an empty table gives no rows.
    """
    made = pieces(documents, tokenizer, end, length)
    counts = made.groupBy("length", "part").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = written(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    histogram = np.zeros(length + 1, np.int64)
    for r in based.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row per length
        histogram[r["length"]] = r["n"]
    shared = documents.sparkSession.sparkContext.broadcast(places(plan(histogram, length)))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = shared.value
        key = where["size"] * (1 << 44) + where["first"]
        for batch in batches:
            number = batch.column("number").to_numpy()
            row = np.searchsorted(key, batch.column("length").to_numpy() * (1 << 44) + number, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(where["sequence"][row] + number - where["first"][row]), pa.array(where["offset"][row])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    other = based.select(F.col("length").alias("_length"), F.col("part").alias("_part"), "base")
    on = same_key([F.col("length"), F.col("part")], [F.col("_length"), F.col("_part")])
    numbered = made.join(other, on).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("number"))
    return numbered.mapInArrow(run, schema)


def sequences(documents: DataFrame, packed: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """sequence_id, ids (array) of every sequence: the packed documents themselves.

    For documents with distinct ids; ids are encoded again where they are needed.
    """
    schema = "doc_id long, ids array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(tokenizer, end)
        for batch in in_slices(batches):
            ids, sizes = codes.encode(utf8(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.split(ids.astype(np.int64), np.cumsum(sizes)[:-1]), pa.list_(pa.int64()))],
                names=["doc_id", "ids"],
            )

    coded = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
    parts = packed.join(coded, "doc_id").select("sequence_id", "offset", F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("part"))
    ordered = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "part"))).alias("parts"))
    return ordered.select("sequence_id", F.flatten("parts.part").alias("ids"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 ids."""
    return pack(table(spark, folder, "documents"), tokenizer_path(TOKENIZER))
