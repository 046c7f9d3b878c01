"""Benchmark passages in documents, found by an FM-index per shard of the documents.

A shard is a slice of a partition's documents. Its text is the sequence of their words,
written in the alphabet of the benchmark: a word no phrase has can match nothing, so every run
of such words (and every end of a document) becomes one separator. Over that sequence lie a
suffix array, its Burrows-Wheeler transform in a wavelet matrix, and sampled suffix positions.
Phrases are searched backwards, all together, one word a step; the rows that remain are walked
to the next sampled position; the words inside any occurrence are merged to spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import in_slices, table, texts, utf8, written

WINDOW = 10
# One position of the sequence in so many is kept in the index.
SAMPLE = 8
# Text of a shard, and benchmark text that is sent to the executors at a time.
SHARD_BYTES = 4 << 20
# (Windows take up to 80 bytes a word while they are sorted, the words of the vocabulary as much again.)
BLOCK_BYTES = 8 << 20

# Digits, letters and everything beyond ASCII; A-Z count as a-z.
_WORDS = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


@dataclass(frozen=True)
class Phrases:
    """Distinct windows as rows of word numbers (padded with 0 in front), and whose they are.

    The items of window ``i`` are ``owners[starts[i]:starts[i + 1]]``. All but the vocabulary are
    arrays, so a block of the benchmark takes a few times its own size.
    """

    vocabulary: dict[bytes, int]
    symbols: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    owners: np.ndarray

    def items(self, window: int) -> list[int]:
        return self.owners[self.starts[window]:self.starts[window + 1]].tolist()


def phrases(rows: Iterable[tuple[int, bytes]], window: int = WINDOW) -> Phrases:
    """Windows of the items (id, text); an item shorter than a window is one."""
    vocabulary: dict[bytes, int] = {}
    texts_: list[np.ndarray] = []
    ids: list[int] = []
    for item, text in rows:
        words = words_of(text)
        if words:
            numbers = np.fromiter((vocabulary.setdefault(w, len(vocabulary) + 1) for w in words), np.int32, len(words))
            # In front of a short item stands as much nothing as it lacks.
            texts_.append(np.concatenate((np.zeros(max(0, window - len(words)), np.int32), numbers)))
            ids.append(item)
    if not texts_:
        return Phrases(vocabulary, np.zeros((0, window), np.int32), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64))
    counts = np.array([len(t) - window + 1 for t in texts_])
    flat = np.concatenate(texts_)
    texts_.clear()
    ends = np.cumsum(counts + window - 1)
    first = np.repeat(ends - (counts + window - 1) - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, window)[first])
    keys = windows.view(np.dtype((np.void, windows.itemsize * window))).ravel()
    _, at, number = np.unique(keys, return_index=True, return_inverse=True)
    pairs = np.unique(np.stack([number.ravel(), np.repeat(np.array(ids, np.int64), counts)], axis=1), axis=0)
    symbols = windows[at]
    return Phrases(vocabulary, symbols, (symbols > 0).sum(1), np.searchsorted(pairs[:, 0], np.arange(len(at) + 1)), pairs[:, 1].copy())


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """Order of the suffixes of ``text``, in which every 0 is a separator of its own.

    Separators are smaller than words and ordered by position, so a comparison ends at the
    first of them. The first symbols are compared as one number; what is still equal is
    compared by the ranks already known, twice as far each time.
    """
    n = len(text)
    width = max(1, int(letters).bit_length())
    step = max(1, min(16, 62 // width))
    key = np.zeros(n, np.int64)
    open_ = np.ones(n, bool)
    for k in range(step):
        ahead = np.zeros(n, np.int64)
        ahead[:max(0, n - k)] = text[k:]
        open_ &= ahead != 0
        key = (key << width) | np.where(open_, ahead, 0)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    # A suffix whose key reaches a separator is decided: equal ones stand in order of position.
    fresh = np.ones(n, bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]) | ~open_[order[1:]]
    rank = np.empty(n, np.int64)
    group = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = group
    while True:
        size = np.bincount(group, minlength=n)
        slots = np.flatnonzero(size[group] > 1)
        if not len(slots):
            return order
        at = order[slots]
        by = np.lexsort((rank[at + step], group[slots]))  # within the run, so at + step < n
        at, old = at[by], group[slots][by]
        later = rank[at + step]
        order[slots] = at
        new = np.ones(len(slots), bool)
        new[1:] = (old[1:] != old[:-1]) | (later[1:] != later[:-1])
        group[slots] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[at] = group[slots]
        step *= 2


class WaveletMatrix:
    """Ranks of symbols: per bit, from the highest, how many zeros stand before a place."""

    def __init__(self, symbols: np.ndarray, letters: int) -> None:
        self.bits = max(1, int(letters).bit_length())
        self.zeros: list[np.ndarray] = []
        now = symbols
        for bit in range(self.bits - 1, -1, -1):
            low = ((now >> bit) & 1) == 0
            before = np.zeros(len(now) + 1, np.int32)
            np.cumsum(low, out=before[1:])
            self.zeros.append(before)
            now = np.concatenate((now[low], now[~low]))
        # Where each symbol's run starts after the last level.
        self.first = np.zeros(1 << self.bits, np.int64)
        starts = np.flatnonzero(np.concatenate(([True], now[1:] != now[:-1])))
        self.first[now[starts]] = starts

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the place."""
        for level, before in enumerate(self.zeros):
            one = (symbol >> (self.bits - 1 - level)) & 1
            zeros = before[place]
            place = np.where(one == 1, before[-1] + place - zeros, zeros)
        return np.maximum(place - self.first[symbol], 0)


class FMIndex:
    """Backward search and location in a sequence of word numbers with 0 as separator."""

    def __init__(self, text: np.ndarray, letters: int) -> None:
        order = suffix_array(text, letters)
        self.last = text[order - 1]  # the first suffix is preceded by the closing separator
        self.wavelet = WaveletMatrix(self.last, letters)
        counts = np.bincount(text, minlength=letters + 1)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        # Kept positions: every SAMPLE-th, and those after a separator, where walks would end.
        self.kept = (order % SAMPLE == 0) | (self.last == 0)
        self.kept_rank = np.concatenate(([0], np.cumsum(self.kept)))
        self.positions = order[self.kept]

    def ranges(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that start with each phrase (padded in front with 0)."""
        n, width = symbols.shape
        low, high = np.zeros(n, np.int64), np.full(n, len(self.last))
        live = np.arange(n)
        for column in range(width - 1, -1, -1):
            letter = symbols[live, column]
            live, letter = live[letter > 0], letter[letter > 0]  # a short phrase is complete
            if not len(live):
                break
            low[live] = self.before[letter] + self.wavelet.rank(letter, low[live])
            high[live] = self.before[letter] + self.wavelet.rank(letter, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the given rows."""
        rows, moved = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.kept[rows])
        while len(walking):
            at = rows[walking]
            letter = self.last[at]
            rows[walking] = self.before[letter] + self.wavelet.rank(letter, at)
            moved[walking] += 1
            walking = walking[~self.kept[rows[walking]]]
        return self.positions[self.kept_rank[rows]] + moved


@dataclass
class Found:
    """Of one document: number of words, word spans [start, end) inside occurrences, items."""

    words: int
    spans: list[tuple[int, int]]
    items: list[int]

    @property
    def hit(self) -> int:
        return sum(b - a for a, b in self.spans)


def search(documents: list[bytes], wanted: Phrases) -> list[Found]:
    """Occurrences of all phrases in a shard of whole documents."""
    words = [words_of(t) for t in documents]
    result = [Found(len(w), [], []) for w in words]
    letters = len(wanted.vocabulary)
    if not letters or not len(wanted.lengths):
        return result
    # One closing separator per document.
    sizes = np.array([len(w) + 1 for w in words])
    ends = np.cumsum(sizes)
    flat = np.fromiter(chain.from_iterable(chain(map(wanted.vocabulary.get, w, repeat(0)), (0,)) for w in words), np.int64, int(ends[-1]))
    keep = flat != 0
    keep[0] = True
    keep[1:] |= flat[:-1] != 0
    place = np.flatnonzero(keep)  # of each symbol of the index among the shard's words
    index = FMIndex(flat[place], letters)
    low, high = index.ranges(wanted.symbols)
    some = np.flatnonzero(high > low)
    if not len(some):
        return result
    count = (high - low)[some]
    phrase = np.repeat(some, count)
    within = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count)
    start = place[index.locate(low[phrase] + within)]
    edges = np.zeros(len(flat) + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + wanted.lengths[phrase], -1)
    inside = np.concatenate(([False], np.cumsum(edges)[:-1] > 0, [False]))
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    begins, stops = turns[::2], turns[1::2]
    first = ends - sizes
    for doc, a, b in zip(np.searchsorted(ends, begins, "right").tolist(), begins.tolist(), stops.tolist()):
        result[doc].spans.append((a - int(first[doc]), b - int(first[doc])))
    pairs = np.unique(np.searchsorted(ends, start, "right") * len(wanted.lengths) + phrase)
    for doc, one in zip((pairs // len(wanted.lengths)).tolist(), (pairs % len(wanted.lengths)).tolist()):
        result[doc].items += wanted.items(one)
    for found in result:
        found.items = sorted(set(found.items))
    return result


def benchmark_blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark in blocks of about ``limit`` bytes of text; one block if it is that small.

    Every block is small enough to send to the executors, however large the benchmark is.
    Items without id or text have no windows.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter(
        "item_id is not null and text is not null"
    )
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = 1 + size // limit
    if blocks == 1:
        return [items]
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) for b in range(blocks)]


def _wanted(block: DataFrame, window: int) -> Phrases:
    return phrases(((r["item_id"], r["text"].encode()) for r in block.toLocalIterator()), window)


def _found(documents: DataFrame, key: str, block: DataFrame, window: int) -> DataFrame:
    """key, n_words, spans, items of every row, for one block of the benchmark; no shuffle."""
    return _searched(documents, key, documents.sparkSession.sparkContext.broadcast(_wanted(block, window)))


def _searched(documents: DataFrame, key: str, shared: Broadcast) -> DataFrame:
    """The same for phrases that are sent to the executors already."""
    schema = f"{key} long, n_words long, spans array<struct<start: long, end: long>>, items array<long>"
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, size=SHARD_BYTES):
            found = search(utf8(batch), shared.value)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([f.words for f in found], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in f.spans] for f in found], span),
                pa.array([f.items for f in found], pa.list_(pa.int64())),
            ], names=[key, "n_words", "spans", "items"])

    return documents.select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find_passages(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, spans (of word numbers, end exclusive), items of every row.

    spans are the merged words inside any occurrence of a window; items the sorted ids of the
    items with an occurring window. NULL text has no words; a missing doc_id stays NULL;
    repeated rows are searched each, texts whole, however long; no benchmark gives empty spans, no
    documents no rows. Extra columns are not read.
    """
    blocks = benchmark_blocks(benchmark, limit)
    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if len(blocks) == 1:
        return _found(plain, "doc_id", blocks[0], window)
    # Several blocks: rows get a number, and what the blocks find is put together by it.
    numbered = written(plain.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "numbered")
    found = _found(numbered, "row", blocks[0], window)
    for block in blocks[1:]:
        found = found.unionByName(_found(numbered, "row", block, window))
    span = "array<struct<start: long, end: long>>"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_merged([(s["start"], s["end"]) for s in x]) for x in batch.column("spans").to_pylist()]
            merged = pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], batch.column("spans").type)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("n_words"), merged, batch.column("items")], names=["row", "n_words", "spans", "items"]
            )

    together = found.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).mapInArrow(merge, f"row long, n_words long, spans {span}, items array<long>")
    return numbered.select("row", "doc_id").join(together, "row").drop("row")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what lies between them."""
    if not spans:
        return text
    places = [m.span() for m in _WORD.finditer(text)]
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return "".join([*parts, text[at:]])


def _removed_by_blocks(documents: DataFrame, blocks: list[DataFrame], window: int, count: str | None) -> DataFrame:
    """Removal for a benchmark of several blocks, of which one at a time is in memory.

    A round searches the texts for every block, merges the spans of all blocks and cuts once;
    the next round has the changed texts only. Every round shortens its texts, so they end.
    """
    context = documents.sparkSession.sparkContext
    # A name that no column of the documents has.
    key = "row_" + "_".join(documents.columns)
    numbered = written(documents.select(F.monotonically_increasing_id().alias(key), "*"), "numbered")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_merged([(s["start"], s["end"]) for s in x]) for x in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([cut(t, x) for t, x in zip(texts(batch), spans)], pa.string())], names=["row", "text"]
            )

    now, rounds = numbered.select(F.col(key).alias("row"), F.col("text").cast("string").alias("text")), []
    while True:
        hits = []
        for block in blocks:
            shared = context.broadcast(_wanted(block, window))
            hits.append(written(_searched(now, "row", shared).filter(F.size("spans") > 0).select("row", "spans"), "hits"))
            shared.destroy()
        spans = reduce(DataFrame.unionByName, hits).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        now = written(now.join(spans, "row").mapInArrow(run, "row long, text string"), "cut")
        if now.isEmpty():
            break
        rounds.append(now.withColumn("round", F.lit(len(rounds))))
    if not rounds:
        return numbered.select(*documents.columns)
    last = reduce(DataFrame.unionByName, rounds).groupBy(F.col("row").alias(key + "_cut")).agg(F.max_by("text", "round").alias(key + "_text"))
    new = {"text": F.col(key + "_text")} | ({count: F.length(key + "_text")} if count else {})
    return numbered.join(last, F.col(key) == F.col(key + "_cut"), "left").select(*[
        F.when(F.col(key + "_cut").isNotNull(), new[f.name].cast(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
        if f.name in new else F.col(f"`{f.name}`") for f in documents.schema.fields
    ])


def remove_passages(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BLOCK_BYTES) -> DataFrame:
    """All rows with all columns; text without the benchmark passages, n_chars (if there) its length.

    The words inside any occurrence of any window go at once, so the result does not depend on
    the blocks of the benchmark. What is left around a cut could spell a window anew; such text
    is searched again until nothing is found. Rows without an occurrence keep their text to the
    letter; NULL text stays NULL; repeated rows and rows without doc_id are cut each, texts of any
    length as a whole. No documents give no rows.
    """
    blocks = benchmark_blocks(benchmark, limit)
    count = next((f.name for f in documents.schema.fields if f.name == "n_chars" and isinstance(f.dataType, (T.LongType, T.IntegerType))), None)
    if len(blocks) > 1:
        return _removed_by_blocks(documents, blocks, window, count)
    shared = documents.sparkSession.sparkContext.broadcast(_wanted(blocks[0], window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, size=SHARD_BYTES):
            now = texts(batch)
            changed: set[int] = set()
            todo = list(range(len(now)))
            while todo:
                found = search([now[i].encode() for i in todo], shared.value)
                todo = [i for i, f in zip(todo, found) if f.spans]
                for i, f in zip(list(todo), [f for f in found if f.spans]):
                    now[i] = cut(now[i], f.spans)
                changed.update(todo)
            if changed:
                names, columns = batch.schema.names, list(batch.columns)
                at = names.index("text")
                old = columns[at].to_pylist()
                columns[at] = pa.array([now[i] if i in changed else old[i] for i in range(len(now))], columns[at].type)
                if count:
                    at = names.index(count)
                    old = columns[at].to_pylist()
                    columns[at] = pa.array([len(now[i]) if i in changed else old[i] for i in range(len(now))], columns[at].type)
                batch = pa.RecordBatch.from_arrays(columns, names=names)
            yield batch

    return documents.mapInArrow(run, documents.schema)


def op7_decontam(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the items they come from."""
    found = find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.col("n_hit") > 0)
