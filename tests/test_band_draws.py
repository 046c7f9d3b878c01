"""Draws of the bands: once per piece and batch of names, by the engine's hash."""

import numpy as np
from pyspark.sql import functions as F

from ledgerline.operators import matching


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pieces_draw_by_the_engine_hash(spark):
    pieces = [5, -7, 11, 2**40, 0]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(pieces)], "i int, gram bigint").orderBy("i")
    for number in (0, 1, 900):
        u = (F.shiftrightunsigned(F.xxhash64("gram", F.lit(number)), 11) + 1).cast("double") / float(1 << 53)
        assert [r[0] for r in df.select(u).collect()] == matching.uniform(number, matching.piece_seeds(np.array(pieces))).tolist()


def test_band_keys_are_drawn_by_batches(spark):
    names = spark.createDataFrame([(0, 1, [3, 4]), (1, 2, [3, 4]), (1, 3, [9])], "side int, id bigint, grams array<bigint>")
    keys = matching._band_keys(names)
    assert "MapInArrow" in _plan(keys)
    held = {i: [r["gram"] for r in keys.filter(F.col("id") == i).orderBy("first").collect()] for i in (1, 2, 3)}
    assert held[1] == held[2] and not set(held[1]) & set(held[3])
