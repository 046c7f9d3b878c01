"""Match a file without customer ids: exact email first, then similar company names.

Similar names are found in one of two ways: :func:`similar_names` is exact, its candidates grow
faster than the names where most names are alike; :func:`similar_names_by_bands` finds most pairs by
locality-sensitive hashing, and its candidates stay near in proportion to the names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.identity import owners
from ledgerline.operators.relational import join_lookup
from ledgerline.session import stored

# Names of one side that meet in a task: pieces held by more names than this are split.
NAMES_PER_SHARE = 1024
# Chance of a band in common that pairs of the weighted likeness LIKENESS shall have.
RECALL, LIKENESS = 0.999, 0.7


def trigrams(name: Column) -> Column:
    """Set of three-letter pieces of every word, padded by two blanks before and one after.

    A piece is written as one number, 21 bits per character, which is exact for every
    Unicode character and compares much faster than text.
    """
    words = F.filter(F.split(F.lower(name), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def pieces(word: Column) -> Column:
        padded = F.concat(F.lit("  "), word, F.lit(" "))
        def code(position: Column) -> Column:
            return F.ascii(F.substring(padded, position, F.lit(1))).cast("bigint")

        return F.transform(
            F.sequence(F.lit(1), F.length(word) + 1),
            lambda i: F.shiftleft(code(i), 42) + F.shiftleft(code(i + 1), 21) + code(i + 2),
        )

    return F.array_distinct(F.flatten(F.transform(words, pieces)))


def similarity(a: Column, b: Column) -> Column:
    """Shared pieces over all pieces."""
    shared = F.size(F.array_intersect(a, b))
    return F.try_divide(shared.cast("double"), (F.size(a) + F.size(b) - shared).cast("double"))


def _names(df: DataFrame, column: str, side: int) -> DataFrame:
    """Every distinct name once with its pieces, so repeated names cost one row."""
    return (
        df.filter(F.col(column).isNotNull()).select(F.col(column).alias("name")).distinct()
        .withColumn("grams", trigrams(F.col("name")))
        .withColumn("side", F.lit(side))
    )


def _ranked_names(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """side, id, name, grams (rare to common), n: the names of both sides, stored once.

    Everything after works on short rows with the id; the names and their whole arrays are
    fetched again only for pairs that pass.
    """
    names = _names(left, column, 0).unionByName(_names(right, column, 1))
    pieces = names.select("side", "name", F.explode("grams").alias("gram"))
    frequency = pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("uses"))
    # One array per name, no longer than the name itself.
    # (Every piece has a frequency. The left join keeps the many pieces on the streamed side.)
    ranked = (
        join_lookup(pieces, frequency, ["gram"])
        .groupBy("side", "name")
        .agg(F.sort_array(F.collect_list(F.struct("uses", "gram"))).alias("ranked"))
        .select("side", F.monotonically_increasing_id().alias("id"), "name", F.col("ranked.gram").alias("grams"))
        .withColumn("n", F.size("grams"))
    )
    return stored(ranked, "names")


def _keys(names: DataFrame, threshold: float, pieces: int) -> DataFrame:
    """One row per combination of ``pieces`` (1 or 2) rare pieces of a name: what it is joined by.

    ``last`` is the position of the last piece of the combination in the name.
    """
    needed = F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    heads = names.withColumn("head", F.slice("grams", F.lit(1), F.col("n") - needed + pieces)).select("side", "id", "n", "head")
    ends = heads.select("*", F.posexplode("head").alias("last", "gram"))
    if pieces == 1:
        return ends.withColumn("first", F.lit(0).cast("bigint"))
    return ends.filter("last > 0").select("*", F.explode(F.slice("head", F.lit(1), F.col("last"))).alias("first"))


def _in_shares(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The keys of the left and of the right side, those of frequent combinations in shares.

    A combination held by many names makes a grid: its left names are dealt to rows, its right
    names to columns, and each name goes to every cell of its row or column. The grid follows
    the measured counts, so a cell is of bounded size however frequent a combination is.
    A frequent combination that only one side has joins nothing and is left out.
    """
    counted = keys.groupBy("first", "gram").agg(
        F.ceil(F.count_if(F.col("side") == 0) / NAMES_PER_SHARE).alias("rows"),
        F.ceil(F.count_if(F.col("side") == 1) / NAMES_PER_SHARE).alias("columns"),
    )
    frequent = counted.filter("greatest(rows, columns) > 1")
    dealt = join_lookup(keys, frequent, ["first", "gram"]).filter("rows is null or least(rows, columns) > 0")
    rows, columns = F.coalesce("rows", F.lit(1)), F.coalesce("columns", F.lit(1))

    def own(shares: Column) -> Column:
        return F.pmod(F.xxhash64("id"), shares)

    def every(shares: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), shares - 1))

    left = dealt.filter("side = 0").select("*", own(rows).alias("row"), every(columns).alias("column"))
    right = dealt.filter("side = 1").select("*", own(columns).alias("column"), every(rows).alias("row"))
    return left.drop("side", "rows", "columns"), right.drop("side", "rows", "columns")


def candidate_names(names: DataFrame, threshold: float) -> DataFrame:
    """left_id, right_id of :func:`_ranked_names` that can reach ``threshold``, each pair once.

    Exact, without comparing everything with everything: with pieces ordered from rare to
    common, two names that similar share ``p`` of their first ``n - ceil(threshold * n) + p``
    pieces. For a threshold above one half every name with pieces has to share two, so names
    are joined by two rare pieces at once, and a piece that occurs in most names hardly ever
    takes part. A pair is kept at its first common combination only, and only if enough pieces
    are left behind it. (A name gives as many combinations as its rare pieces have pairs,
    which suits names, not long texts.)
    """
    together = 2 if threshold > 0.5 else 1
    left, right = _in_shares(_keys(names, threshold, together))
    keys = ["first", "gram", "row", "column"]
    a = left.select(*keys, F.col("id").alias("left_id"), F.col("n").alias("na"), F.col("head").alias("ha"), F.col("last").alias("ia"))
    b = right.select(*keys, F.col("id").alias("right_id"), F.col("n").alias("nb"), F.col("head").alias("hb"), F.col("last").alias("ib"))
    shared_needed = (F.col("na") + F.col("nb")) * (threshold / (1 + threshold)) - F.lit(1e-9)
    common = F.array_intersect("ha", "hb")
    start = F.element_at(common, together) == F.col("gram")
    if together == 2:
        start = start & (F.element_at(common, 1) == F.col("first"))
    left_behind = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) - 1
    return a.join(b, keys).filter((left_behind + together >= shared_needed) & start).select("left_id", "right_id")


def similar_names(left: DataFrame, right: DataFrame, column: str, threshold: float) -> DataFrame:
    """All pairs of distinct names with similarity >= ``threshold``: name, other, similarity."""
    names = _ranked_names(left, right, column)
    sides = [
        names.filter(F.col("side") == i).select(F.col("id").alias(f"{s}_id"), F.col("name").alias(f"{s}_name"), F.col("grams").alias(f"{s}_grams"))
        for i, s in enumerate(("left", "right"))
    ]
    pairs = join_lookup(join_lookup(candidate_names(names, threshold), sides[0], ["left_id"]), sides[1], ["right_id"])
    return (
        pairs.select(
            F.col("left_name").alias("name"), F.col("right_name").alias("other"),
            similarity(F.col("left_grams"), F.col("right_grams")).alias("similarity"),
        )
        .filter(F.col("similarity") >= F.lit(threshold) - F.lit(1e-9))
    )


def band_shape(names: int) -> tuple[int, int]:
    """(bands, rows a band) for so many names.

    Rows follow the logarithm of the names, so that names sharing some pieces by chance meet in
    a band the more rarely the more there are; bands make up for the rows.
    """
    rows = max(2, 1 + round(math.log10(max(names, 1))))
    return math.ceil(math.log(1 - RECALL) / math.log(1 - LIKENESS ** rows)), rows


def plain_name(name: Column) -> Column:
    """Lower case, one blank between words, no other signs."""
    return F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "))


def edit_similarity(a: Column, b: Column) -> Column:
    """Share of the longer plain name that stands without edits."""
    a, b = plain_name(a), plain_name(b)
    return 1 - F.try_divide(F.levenshtein(a, b).cast("double"), F.greatest(F.length(a), F.length(b)).cast("double"))


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def _hash_long(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of 64-bit numbers, as ``F.xxhash64`` chains it."""
    x = (seed + _P5 + np.uint64(8)) ^ (_turned(value * _P2, 31) * _P1)
    return _mixed(_turned(x, 27) * _P1 + _P4)


def _hash_int(number: int, seed: np.ndarray) -> np.ndarray:
    """XXH64 of a 32-bit number with seeds."""
    x = (seed + _P5 + np.uint64(4)) ^ (np.array([number], dtype=np.uint64) * _P1)
    return _mixed(_turned(x, 23) * _P2 + _P3)


def piece_seeds(pieces: np.ndarray) -> np.ndarray:
    return _hash_long(pieces.astype(np.int64).view(np.uint64), np.array([42], dtype=np.uint64))


def uniform(number: int, seeds: np.ndarray) -> np.ndarray:
    """What pieces with these seeds draw by that number: above 0, at most 1."""
    return ((_hash_int(number, seeds) >> np.uint64(11)) + np.uint64(1)) / float(1 << 53)


def band_keys(grams: np.ndarray, weights: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """names × bands of the names whose pieces lie between ``offsets``, each name with at least one.

    What a piece draws depends on it alone, so each piece is drawn for once and looked up by the names.
    """
    if len(offsets) < 2:
        return np.empty((0, bands), dtype=np.int64)
    distinct, first, place = np.unique(grams, return_index=True, return_inverse=True)
    seeds = piece_seeds(distinct)
    weight, place = weights[first], place.reshape(-1)
    keys = np.empty((len(offsets) - 1, bands), dtype=np.int64)
    for band in range(bands):
        key = np.full(len(offsets) - 1, 42, dtype=np.uint64)
        for number in range(band * rows, (band + 1) * rows):
            drawn = np.minimum.reduceat((-np.log(uniform(number, seeds)) / weight)[place], offsets[:-1])
            key = _hash_long(drawn.view(np.uint64), key)
        keys[:, band] = key.view(np.int64)
    return keys


def _band_keys(names: DataFrame) -> DataFrame:
    """side, id, first (number of the band), gram (its key) for names (side, id, grams).

    Weighted MinHash: a draw takes of a name's pieces the smallest -ln(u) / w, where u comes from a hash
    of the piece and the draw, and w is the logarithm of the piece's rarity. Two names draw alike
    with a chance of their shared weight over their whole weight, so pieces that most names have
    hardly count. A band's key is a hash of its draws.
    """
    spark = names.sparkSession
    total = names.count()  # one number
    bands, rows = band_shape(total)
    pieces = names.select("side", "id", F.explode("grams").alias("gram"))
    rarity = pieces.groupBy("gram").agg(F.log(F.lit(total + 1.0) / F.count(F.lit(1))).alias("weight"))
    # Much work on few bytes: over all cores, however small the names are.
    spread = join_lookup(pieces, rarity, ["gram"]).repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "side", "id")
    weighted = spread.groupBy("side", "id").agg(F.collect_list(F.struct("gram", "weight")).alias("pieces"))

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            ends, held = np.asarray(lists.offsets), lists.values
            offsets = ends - ends[0]
            grams = held.field("gram").to_numpy()[ends[0]:ends[-1]]
            weights = held.field("weight").to_numpy()[ends[0]:ends[-1]]
            keys = np.ascontiguousarray(band_keys(grams, weights, offsets, bands, rows))
            steps = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * bands)
            listed = pa.ListArray.from_arrays(steps, pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("side"), batch.column("id"), listed], names=["side", "id", "keys"])

    keys = weighted.select("side", "id", "pieces").mapInArrow(keyed, "side int, id bigint, keys array<bigint>")
    return keys.select("side", "id", F.posexplode("keys").alias("first", "gram"))


def banded_names(names: DataFrame) -> DataFrame:
    """left_id, right_id of names (side, id, grams) with a band in common, each pair once."""
    left, right = _in_shares(stored(_band_keys(names), "bands"))
    keys = ["first", "gram", "row", "column"]
    pairs = left.select(*keys, F.col("id").alias("left_id")).join(right.select(*keys, F.col("id").alias("right_id")), keys)
    return pairs.select("left_id", "right_id").distinct()


def similar_names_by_bands(left: DataFrame, right: DataFrame, column: str, threshold: float) -> DataFrame:
    """Most pairs of distinct names whose :func:`edit_similarity` reaches ``threshold``: name, other, similarity.

    Near pairs can be missed, none that does not reach the threshold is returned.
    """
    both = _names(left, column, 0).unionByName(_names(right, column, 1))
    names = stored(both.withColumn("id", F.monotonically_increasing_id()), "names")
    sides = [names.filter(F.col("side") == i).select(F.col("id").alias(f"{s}_id"), F.col("name").alias(s)) for i, s in enumerate(("name", "other"))]
    pairs = banded_names(names).withColumnsRenamed({"left_id": "name_id", "right_id": "other_id"})
    named = join_lookup(join_lookup(pairs, sides[0], ["name_id"]), sides[1], ["other_id"])
    return named.select("name", "other", edit_similarity(F.col("name"), F.col("other")).alias("similarity")).filter(
        F.col("similarity") >= F.lit(threshold) - F.lit(1e-9)
    )


def match_partners(
    partners: DataFrame, customers: DataFrame, threshold: float = 0.8,
    similar: Callable[[DataFrame, DataFrame, str, float], DataFrame] = similar_names,
) -> DataFrame:
    """partner_id, customer_id, method, similarity for every partner row.

    method: ``email`` (sole owner of the address), ``name`` (the one most similar company
    name at or above the threshold), else ``quarantine`` without customer: no match is
    applied below the threshold or when several customers fit equally well. ``similar`` finds
    the pairs of names and defines what similar is.
    """
    by_email = owners(customers, "email", "customer_id").filter(~F.col("_ambiguous")).drop("_ambiguous")
    emailed = join_lookup(partners.filter(F.col("email").isNotNull()), by_email, ["email"])
    found = emailed.filter(F.col("customer_id").isNotNull()).select(
        "partner_id", "customer_id", F.lit("email").alias("method"), F.lit(1.0).alias("similarity")
    )
    rest = (
        emailed.filter(F.col("customer_id").isNull()).select("partner_id", "company_name")
        .unionByName(partners.filter(F.col("email").isNull()).select("partner_id", "company_name"))
    )
    # Only the most similar names count; all of them, as a tie decides nothing.
    rank = F.rank().over(Window.partitionBy("name").orderBy(F.col("similarity").desc()))
    closest = similar(rest, customers, "company_name", threshold).withColumn("_rank", rank).filter("_rank = 1")
    # A company name may belong to several customers; smallest and largest id tell.
    holders = customers.groupBy(F.col("company_name").alias("other")).agg(F.min("customer_id").alias("low"), F.max("customer_id").alias("high"))
    best = (
        join_lookup(closest, holders, ["other"])
        .groupBy("name", "similarity").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .filter("low = high")
        .select(F.col("name").alias("company_name"), F.col("low").alias("customer_id"), "similarity")
    )
    named = join_lookup(rest, best, ["company_name"]).select(
        "partner_id", "customer_id",
        F.when(F.col("customer_id").isNull(), "quarantine").otherwise("name").alias("method"),
        "similarity",
    )
    return found.unionByName(named)
