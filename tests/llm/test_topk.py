"""The bit-sliced index against sorted inner products."""

import math
import random

import numpy as np
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import topk


def brute(vectors, queries, k):
    most, bound = 1 << 62, (1 << 63) - 1
    whole = {(i, tuple(max(-most, min(most, math.floor(1024 * x))) for x in v)) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    asked = {}
    for i, v in whole:
        if i in queries:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, a in asked.items():
        scored = sorted((-max(-bound, min(bound, sum(x * y for x, y in zip(a, b)))), i) for i, b in whole if i != q and len(b) == len(a))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6))
def test_slices(seed):
    """Sums by bitmaps, the k-th highest and the comparison, on random blocks."""
    mix = np.random.default_rng(seed)
    n, d = int(mix.integers(1, 150)), int(mix.integers(1, 9))
    values = mix.integers(-300, 300, (n, d))
    query = mix.integers(-40, 40, d)
    maps, low, shift = topk.sliced(values, 6)
    kept = (values - low) >> shift
    wanted = np.where(query >= 0, kept, (1 << maps.shape[1]) - 1 - kept) @ np.abs(query)
    slices = topk.add_slices(maps, query)
    bits = np.stack([np.unpackbits(s.view(np.uint8), bitorder="little")[:n] for s in slices]).astype(object)
    assert [sum(int(b) << i for i, b in enumerate(bits[:, r])) for r in range(n)] == wanted.tolist()
    block = topk.Block(np.arange(n), values, maps, shift)
    k = int(mix.integers(1, n + 1))
    kth = topk.kth_highest(slices, block.all, k)
    assert kth == sorted(wanted, reverse=True)[k - 1]
    near = np.unpackbits(topk.at_least(slices, block.all, kth).view(np.uint8), bitorder="little")[:n]
    assert near.tolist() == (wanted >= kth).astype(int).tolist()


def test_against_brute_force(spark):
    mix = random.Random(3)
    vectors = [(i, [mix.gauss(0, 0.3) for _ in range(7)]) for i in range(300)]
    vectors += [(1000 + i, vectors[10][1]) for i in range(120)]  # ties
    vectors += [(2000, None), (2001, []), (2002, [float("nan")] * 7), (2003, [float("inf")] + [0.0] * 6), (2004, [None] * 7), (None, [0.1] * 7)]
    vectors += [(3000, [1.0, 2.0]), (3001, [-1.0, 0.5]), (3002, [1e300] * 7), (3003, [0.0] * 7), vectors[0], (5, [0.5] * 7)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id long, embedding array<double>, score string, rank int").repartition(5)
    queries = {0, 5, 10, 1003, 3000, 3002, 2002}
    asked = df.filter(df.vec_id.isin(*queries))
    found = sorted(map(tuple, topk.top_k(df, asked, 4, query_rows=2).collect()))
    assert found == brute(vectors, queries, 4)
    assert topk.top_k(df.filter("false"), asked).count() == topk.top_k(df, df.filter("false")).count() == 0


def test_query_equals_its_sql(spark, tables):
    df = topk.op2_topk(spark, tables)
    assert differences(df.collect(), df.columns, connect(tables), topk.ORACLE) == ""
