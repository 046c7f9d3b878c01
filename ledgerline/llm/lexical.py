"""Ranked lexical search: documents alike in what the items can see are scored once.

An item sees of a document how often its own terms occur and how long the document is. So a
document is restricted to the vocabulary of the items: a vector of (term, occurrences), and
the length class ``m``. Documents with one hash, one vector and one ``m`` are a class; only
classes are scored, and the winning classes are expanded to their members by ascending id.

Scores are sums of whole numbers (see :func:`op13_lexical`), so they do not depend on order.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow, in_slices, table, utf8, written

TOP = 20
# Text of items whose vocabulary is sent to executors at a time; more items take more rounds.
BLOCK_BYTES = 4 << 20
# Cells (classes times items) scored at a time.
CELLS = 1 << 20

# Digits, letters and everything beyond ASCII; A-Z count as a-z.
_TERMS = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return text.translate(_TERMS).split()


@dataclass(frozen=True)
class Items:
    """A block of items: their ids, the numbers of all their terms, and per term who has it how often."""

    ids: list[int | None]
    vocabulary: dict[bytes, int]
    starts: np.ndarray
    holders: np.ndarray
    times: np.ndarray


def items_of(rows: list[tuple[int | None, bytes]]) -> Items:
    """Items from (id, text) rows; each row is an item of its own."""
    vocabulary: dict[bytes, int] = {}
    held: list[tuple[int, int, int]] = []
    for number, (_, text) in enumerate(rows):
        held += [(vocabulary.setdefault(t, len(vocabulary)), number, n) for t, n in Counter(terms_of(text)).items()]
    held.sort()
    columns = np.array(held, np.int64).reshape(-1, 3)
    starts = np.searchsorted(columns[:, 0], np.arange(len(vocabulary) + 1))
    return Items([i for i, _ in rows], vocabulary, starts, columns[:, 1].copy(), columns[:, 2].copy())


def item_blocks(items: DataFrame, size: int = BLOCK_BYTES) -> Iterator[Items]:
    """Distinct rows (item_id, text) in blocks of little more than ``size`` bytes; the driver holds one at a time."""
    rows: list[tuple[int | None, bytes]] = []
    total = 0
    plain = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for row in plain.distinct().toLocalIterator():
        rows.append((row.item_id, row.text.encode("utf-8", "replace")))
        total += len(rows[-1][1]) + 64
        if total >= size:
            yield items_of(rows)
            rows, total = [], 0
    if rows:
        yield items_of(rows)


def restricted(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms, with repeats), vector of every document with a term and an id.

    The vector holds the numbers of the vocabulary's terms in the document, ascending, then how
    often each occurs, as 32-bit integers: equal vectors are equal bytes.
    """
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary)
    schema = "doc_id long, n long, vector binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in in_slices(batches):
            ids, lengths, vectors = [], [], []
            for key, text in zip(batch.column("doc_id").to_pylist(), utf8(batch)):
                found = terms_of(text)
                if found:
                    counts = Counter(found)
                    pairs = sorted((known[t], counts[t]) for t in counts.keys() & known.keys())
                    ids.append(key)
                    lengths.append(len(found))
                    vectors.append(np.array(pairs, "<u4").reshape(-1, 2).T.tobytes())
            yield arrow(schema, {"doc_id": ids, "n": lengths, "vector": vectors})

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.filter("doc_id is not null and text is not null").mapInArrow(run, schema)


def _pairs(vector: bytes) -> np.ndarray:
    """Row 0: numbers of terms; row 1: occurrences."""
    return np.frombuffer(vector, "<u4").reshape(2, -1).astype(np.int64)


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """How many of the restricted documents hold each of ``size`` terms; summed in the tasks first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for vector in batch.column("vector").to_pylist():
                total[_pairs(vector)[0]] += 1
        terms = np.flatnonzero(total)
        yield arrow("term long, df long", {"term": terms, "df": total[terms]})

    out = np.zeros(size, np.int64)
    for row in rows.select("vector").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row.term] = row.df
    return out


def term_weights(counts: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of every term."""
    known = {df: math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in set(counts.tolist())}
    return np.array([known[df] for df in counts.tolist()], np.int64)


def classes(rows: DataFrame, documents: int, terms: int, top: int = TOP) -> DataFrame:
    """m, vector, members of every class of documents alike in hash, vector and m.

    ``members`` are the smallest ``top`` ids: no other can be among the best ``top`` documents,
    as ids break ties. Each map task keeps as many per class, so a class that holds a third of
    all documents is as cheap as any.
    """
    sized = rows.filter(F.length("vector") > 0).select(
        F.xxhash64("vector").alias("hash"), F.expr(f"75 + (25 * n * {documents}L) div {max(terms, 1)}L").alias("m"), "vector", "doc_id"
    )
    key = ["hash", "m", "vector"]
    place = F.row_number().over(Window.partitionBy(*key).orderBy("doc_id"))
    first = sized.withColumn("place", place).filter(F.col("place") <= top)
    return first.groupBy(*key).agg(F.array_sort(F.collect_list("doc_id")).alias("members")).drop("hash")


def score_slice(items: Items, weights: np.ndarray, m: np.ndarray, vectors: list[bytes]) -> np.ndarray:
    """Scores [class, item], in 64-bit integers: term by term, its classes times its items."""
    pairs = [_pairs(v) for v in vectors]
    owner = np.repeat(np.arange(len(pairs)), [p.shape[1] for p in pairs])
    term, tf = np.concatenate(pairs, axis=1)
    gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[owner]))
    order = np.argsort(term, kind="stable")
    term, owner, gain = term[order], owner[order], gain[order]
    cuts = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1], [True])))
    scores = np.zeros((len(pairs), len(items.ids)), np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        low, high = items.starts[term[a]], items.starts[term[a] + 1]
        scores[np.ix_(owner[a:b], items.holders[low:high])] += gain[a:b, None] * items.times[low:high]
    return scores


def best_classes(found: DataFrame, items: Items, weights: np.ndarray, top: int = TOP) -> DataFrame:
    """item (place in the block), score, members: per item the best classes of each task."""
    sent = found.sparkSession.sparkContext.broadcast((items, weights))
    step = max(1, CELLS // max(1, len(items.ids)))
    schema = pa.schema([("item", pa.int64()), ("score", pa.int64()), ("members", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = sent.value
        kept: list[list] = [[] for _ in block.ids]
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                members = part.column("members").to_pylist()
                first = np.argsort([x[0] for x in members], kind="stable")  # smaller ids win ties
                scores = score_slice(block, weight, part.column("m").to_numpy(), part.column("vector").to_pylist())[first]
                ranked = np.argsort(-scores, axis=0, kind="stable")[:top].T
                for item, rows in enumerate(ranked.tolist()):
                    more = [(-int(scores[r, item]), members[first[r]]) for r in rows if scores[r, item] > 0]
                    if more:
                        kept[item] = heapq.nsmallest(top, kept[item] + more)
        out = [(item, -score, ids) for item, rows in enumerate(kept) for score, ids in rows]
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out], schema=schema)

    return found.mapInArrow(run, "item long, score long, members array<long>")


def ranked(best: DataFrame, top: int = TOP) -> DataFrame:
    """item, rank, doc_id, score: the best classes of all tasks, then their members by id."""
    by_class = Window.partitionBy("item").orderBy(F.desc("score"), F.get("members", F.lit(0)))
    kept = best.withColumn("rank", F.row_number().over(by_class)).filter(F.col("rank") <= top).drop("rank")
    each = kept.select("item", "score", F.explode("members").alias("doc_id"))
    by_document = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return each.withColumn("rank", F.row_number().over(by_document)).filter(F.col("rank") <= top)


def search(documents: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents with the highest scores above 0 of each item.

    Equal scores rank by ascending doc_id. Texts are read whole, however long. A document row
    without id or text is no document: it is neither found nor counted; texts without terms are
    not counted either. Repeated document rows are documents each and may fill two ranks with
    one id. A repeated row of ``items`` counts once; rows that share an item_id but not the text
    are items each; NULL text has no terms and finds nothing. No documents or no items give no
    rows; other columns are not read.
    """
    spark = documents.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items, block_bytes):
        rows = written(restricted(documents, block.vocabulary), "vectors")
        total = rows.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
        weights = term_weights(document_counts(rows, len(block.vocabulary)), total.documents)
        found = classes(rows, total.documents, total.terms or 0, top)
        # At most ``top`` rows an item; written, as the block's broadcasts end with it.
        mine = written(ranked(best_classes(found, block, weights, top), top), "ranked")
        names = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
        out = out.unionByName(mine.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out


def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best documents of every benchmark item.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))); a document's m is
    75 + (25 n N) div L; an item's term adds weight * ((10^9 tf) div (1000 tf + 12 m)), as often
    as the item has it.
    """
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLE = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, {_FOLD}), '{_PATTERN}') AS terms
    FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
), sizes AS (
    SELECT row, doc_id, len(terms)::BIGINT AS n, sum(len(terms)) OVER ()::BIGINT AS l, count(*) OVER () AS n_docs
    FROM docs WHERE len(terms) > 0
), items AS (
    SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)
), wanted AS (
    SELECT item, item_id, term, count(*) AS times
    FROM (SELECT item, item_id, unnest(regexp_extract_all(translate(text, {_FOLD}), '{_PATTERN}')) AS term FROM items) GROUP BY ALL
), found AS (
    SELECT row, term, count(*) AS tf
    FROM (SELECT row, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * (SELECT max(n_docs) FROM sizes) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM found GROUP BY term
), scores AS (
    SELECT item, item_id, s.doc_id, s.row,
        sum(q.times * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * s.n * s.n_docs) // s.l))))::BIGINT AS score
    FROM found f JOIN sizes s USING (row) JOIN weights w USING (term) JOIN wanted q USING (term) GROUP BY ALL
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {TOP}
"""
