"""Class-wise search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences

from ledgerline.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items, top=20):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if i is not None and terms(t)]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in set(items):
        scored = []
        for i, bag, n in bags:
            m = 75 + 25 * n * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
                for t in terms(text) if t in bag
            )
            if score > 0:
                scored.append((-score, i))
        out += [(item, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def searched(spark, docs, items, **options):
    frame = spark.createDataFrame([(i, t, "x", 1.0) for i, t in docs], "doc_id long, text string, term string, score double").repartition(4)
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, rank int")
    return sorted(map(tuple, lexical.search(frame, asked, **options).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_terms_equal_the_pattern(odd):
    for row in odd.collect():
        if row.text is not None:
            assert [t.decode() for t in lexical.terms_of(row.text.encode())] == terms(row.text)


@pytest.mark.parametrize("block", [lexical.BLOCK_BYTES, 100])
def test_against_every_document(spark, odd, block):
    """Copies, near copies, ties, odd texts; items in one block and in several."""
    mix = random.Random(5)
    words = ["alpha", "Beta", "gamma", "É", "7", "delta", "x1"]
    docs = [(i, " ".join(mix.choice(words) for _ in range(mix.randint(0, 12)))) for i in range(300)]
    docs += [(1000 - i, "alpha beta, GAMMA!") for i in range(60)] + [(5, "alpha"), (5, "alpha beta"), (None, "alpha")]
    docs += [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "Alpha alpha é"), (1, "Alpha alpha é"), (1, "gamma 7"), (2, "nothing here zzz"), (3, None), (4, ""), (None, "beta the"), (6, "delta x1 " * 5)]
    assert searched(spark, docs, items, block_bytes=block) == plain(docs, items)
    assert searched(spark, docs, items, top=3, block_bytes=block) == plain(docs, items, 3)


def test_large_sums_stay_whole_numbers():
    items = lexical.items_of([(1, b"a " * 3_000_000 + b"b")])
    vector = np.array([[0, 1], [1 << 31, 1]], "<u4").tobytes()
    weights = np.array([40_001, 3], np.int64)
    m = np.array([75], np.int64)
    one = 40_001 * (10**9 * (1 << 31) // (1000 * (1 << 31) + 900)) * 3_000_000
    assert lexical.score_slice(items, weights, m, [vector])[0, 0] == one + 3 * (10**9 // 1900)


def test_tables_without_rows(spark, none):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lexical.search(none, items).count() == lexical.search(some, items.filter("false")).count() == 0


def test_query_equals_its_sql(spark, tables):
    df = lexical.op13_lexical(spark, tables)
    assert differences(df.collect(), df.columns, connect(tables), lexical.ORACLE) == ""
