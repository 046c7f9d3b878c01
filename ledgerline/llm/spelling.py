"""Spelling variants: words one edit apart, found by pivotal grams, chained to their frequent forms.

A word's bigrams are ordered by rarity. Its prefix are the first three (with all others equal to
the third); of any three bigrams two do not overlap, and the two disjoint ones that are rarest
together, chosen by dynamic programming, are its pivots. One edit spoils at most one of two
disjoint bigrams, so of two words one edit apart, the one whose prefix ends earlier in the
order has a pivot in the other's prefix: pivots are joined to prefixes. A bigram the edit does
not touch stands at the same place in both words, or, if their lengths differ by one, at most
that one place later in the longer: the join asks for these places. Candidates are then verified.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow, in_slices, table, texts, written
from ledgerline.operators.relational import join_lookup

# Words of the dealt query: code points at least, occurrences at least, factor between a word and its form.
LENGTH, COUNT, FACTOR = 6, 5, 5
# Of so many occurrences about one loses a letter, chosen by a checksum (the dealt query's own misprints).
MISPRINT = 199
# Distinct words a task holds before it passes their counts on.
HELD = 400_000
# Places a gram's number can take; grams of Latin-1 letters have numbers of their own.
GRAMS = 1 << 16
PIVOTS, PREFIX = 2, 3
# Entries of one cell that are compared with each other in one group.
BLOCK = 4096

# In Latin-1: a-z, A-Z as a-z, and everything from 0xC0 on; the rest separates.
_LETTERS = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters A-Z, a-z, U+00C0 to U+00FF in Latin-1, A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def text_words(key: int | None, text: str, length: int = LENGTH, misprint: int = MISPRINT) -> list[tuple[bytes, int]]:
    """(word, occurrences) of a text's words of ``length`` letters or more, misprints made."""
    start = zlib.crc32(f"{'' if key is None else key}:".encode())
    found = []
    for word, n in Counter(runs(text)).items():
        if len(word) >= length:
            h = zlib.crc32(_utf8(word), start) if misprint else 1
            if misprint and h % misprint == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
                if len(word) < length:
                    continue
            found.append((word, n))
    return found


def count_words(documents: DataFrame, length: int = LENGTH, least: int = COUNT, misprint: int = MISPRINT) -> DataFrame:
    """word, n: the words of at least ``length`` letters that occur at least ``least`` times.

    Tasks sum what they see first, so a word that is a third of all words stays a few rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            return arrow("word string, n long", {"word": [w.decode("latin-1") for w in total], "n": list(total.values())})

        for batch in in_slices(batches):
            for key, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                for word, n in text_words(key, text, length, misprint):
                    total[word] += n
            if len(total) >= HELD:
                yield counted()
                total.clear()
        if total:
            yield counted()

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    each = plain.filter("text is not null").mapInArrow(run, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def grams(word: str) -> list[int]:
    """Numbers of a word's bigrams by place; different bigrams may share one, equal ones always do."""
    codes = [ord(c) for c in word]
    return [(a << 8 ^ b) & (GRAMS - 1) for a, b in zip(codes, codes[1:])]


def choose_pivots(places: Sequence[int], weights: Sequence[int], wanted: int = PIVOTS) -> tuple[int, ...]:
    """Indices of ``wanted`` bigrams that do not overlap and together weigh least; places ascend.

    Row k of the table holds, for every number of first places, the least weight of k disjoint
    bigrams among them. No such choice gives an empty tuple.
    """
    row: list[tuple[float, tuple[int, ...]]] = [(0.0, ())] * (len(places) + 1)
    for _ in range(wanted):
        now: list[tuple[float, tuple[int, ...]]] = [(float("inf"), ())]
        for i, place in enumerate(places):
            free = i
            while free and places[free - 1] > place - 2:
                free -= 1
            weight, chosen = row[free]
            now.append(min(now[-1], (weight + weights[i], (*chosen, i))))
        row = now
    return row[-1][1]


def _cell(gram: int, place: int, length: int) -> int:
    """Key of a bigram at a place of a word of a length; beyond the bits kept, places fold."""
    return gram | (place & 0xFFFFFF) << 16 | (length & 0x7FFFFF) << 40


def word_entries(word: str, frequency: np.ndarray) -> tuple[int, int, list[int], list[int]]:
    """Letter mask, order of the prefix's last bigram, cells of its prefix, cells its pivots look into."""
    numbers = grams(word)
    weights = [int(frequency[g]) for g in numbers]
    ordered = sorted(zip(weights, numbers, range(len(numbers))))
    last = ordered[PREFIX - 1][:2]
    prefix = sorted(place for weight, gram, place in ordered if (weight, gram) <= last)
    chosen = [prefix[i] for i in choose_pivots(prefix, [weights[p] for p in prefix])]
    size = len(word)
    mask = 0
    for c in word:
        mask |= 1 << (ord(c) & 63)
    looked = {_cell(numbers[p], p + shift, size + more) for p in chosen for more, shift in ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1)) if p + shift >= 0}
    return mask - (1 << 64) if mask >> 63 else mask, last[0] << 16 | last[1], [_cell(numbers[p], p, size) for p in prefix], sorted(looked)


def gram_frequency(words: DataFrame) -> np.ndarray:
    """In how many words each bigram stands: GRAMS numbers, whatever the number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(GRAMS, np.int64)
        for batch in batches:
            for word in batch.column("word").to_pylist():
                total[list(set(grams(word)))] += 1
        held = np.flatnonzero(total)
        yield arrow("gram long, n long", {"gram": held, "n": total[held]})

    out = np.zeros(GRAMS, np.int64)
    for row in words.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[row.gram] = row.n
    return out


_ENTRIES = pa.schema([
    ("word", pa.string()), ("n", pa.int64()), ("mask", pa.int64()), ("last", pa.int64()),
    ("prefix", pa.list_(pa.int64())), ("pivots", pa.list_(pa.int64())),
])


def near_pairs(words: DataFrame) -> DataFrame:
    """a, na, b, nb: all ordered pairs of words (word, n) that are exactly one edit apart.

    Words are distinct and have at least four letters (three bigrams). Cells with many entries on
    either side are cut into a grid of groups, so no group grows with the most frequent bigram.
    """
    sent = words.sparkSession.sparkContext.broadcast(gram_frequency(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = sent.value
        for batch in batches:
            listed = batch.column("word").to_pylist()
            columns = list(zip(*(word_entries(w, frequency) for w in listed))) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), *(pa.array(list(c), f.type) for c, f in zip(columns, list(_ENTRIES)[2:]))], schema=_ENTRIES
            )

    schema = "word string, n long, mask long, last long, prefix array<long>, pivots array<long>"
    entries = written(words.select("word", "n").mapInArrow(run, schema), "grams")
    prefix = entries.select(F.explode("prefix").alias("cell"), "word", "n", "mask", "last")
    pivots = entries.select(F.explode("pivots").alias("cell"), "word", "n", "mask", "last")

    def sizes(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))

    grid = sizes(prefix, "right").join(sizes(pivots, "left"), "cell")

    def spread(side: DataFrame, own: str, other: str) -> DataFrame:
        """Every entry in one group of its own side and in all groups of the other."""
        group = F.pmod(F.xxhash64("word"), F.col(own)).cast("int")
        placed = join_lookup(side, grid, ["cell"], "inner").withColumn(f"{own}_group", group)
        return placed.withColumn(f"{other}_group", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("left", "right")

    p, q = spread(pivots, "left", "right").alias("p"), spread(prefix, "right", "left").alias("q")
    same = (F.col("p.cell") == F.col("q.cell")) & (F.col("p.left_group") == F.col("q.left_group")) & (F.col("p.right_group") == F.col("q.right_group"))
    # One edit takes one letter away and brings one in; only what passes that is compared letter by letter.
    near = (
        (F.col("p.last") <= F.col("q.last")) & (F.bit_count(F.col("p.mask").bitwiseXOR(F.col("q.mask"))) <= 2)
        & (F.col("p.word") != F.col("q.word")) & (F.levenshtein("p.word", "q.word", 1) == 1)
    )
    found = p.join(q, same & near).select(F.col("p.word").alias("a"), F.col("p.n").alias("na"), F.col("q.word").alias("b"), F.col("q.n").alias("nb"))
    turned = found.select(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb"))
    return found.unionByName(turned).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of every word's chain of forms (word, form).

    Each round doubles the steps taken, so rounds grow with the logarithm of the longest chain,
    and chains are short: a form is several times as frequent as its word, so there are no rings.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(join_lookup(now, ahead, ["root"]), "roots")
        if moved.filter("further is not null").isEmpty():
            return now
        now = moved.select("word", F.coalesce("further", "root").alias("root"))


def group_spellings(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n).

    Words are near if one inserted, deleted or replaced code point makes one the other. A word's
    form is its near word of largest n (ties: first in code-point order) where that n is at
    least ``factor`` times the word's, else NULL; its root is where following forms ends, itself
    where it has none. Words must be distinct; NULL words or counts and words shorter than four
    letters have no near words. No words give no rows.
    """
    words = written(words.select("word", "n"), "words")
    usable = words.filter("length(word) >= 4 and n is not null")
    best = F.min(F.struct((-F.col("nb")).alias("less"), "b"))
    near = near_pairs(usable).groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best"), F.first("na").alias("na")
    )
    formed = F.col("best.less") <= -factor * F.col("na")
    near = written(near.select(
        "word", "n_near", F.when(formed, F.col("best.b")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")
    ), "near")
    ends = roots(near.filter("form is not null"))
    return (
        words.join(near, "word", "left").join(ends, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Spelling variants among the words of all documents.

    NULL text has no words; a missing doc_id counts as empty text in the checksum; repeated rows
    count each; texts of any length are read whole; other columns are not read.
    """
    return group_spellings(count_words(table(spark, folder, "documents")))
