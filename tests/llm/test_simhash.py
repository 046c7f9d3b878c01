"""Fingerprints and components against brute force."""

import random
import xxhash

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import simhash
from ledgerline.llm.common import table
from ledgerline.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks):
    """Smallest id reachable, by comparing all pairs."""
    parent = {i: i for i, _ in marks}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in marks:
        for j, b in marks:
            if i < j and (a ^ b).bit_count() <= 3:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in marks}


def test_hash_is_the_engine_s(spark):
    """The seed and algorithm named in the contract are those of the built-in function too."""
    df = spark.createDataFrame([("a b c",), ("é" * 50,)], "s string")
    for r in df.select("s", F.xxhash64("s").alias("h")).collect():
        assert xxhash.xxh64_intdigest(r.s.encode(), 42) == r.h % (1 << 64)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBc é\n\t,", max_size=80))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**12 - 1), min_size=1, max_size=60), st.integers(0, 2**12 - 1))
def test_tree(values, asked):
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    assert sorted(values[i] for i in tree.within(asked, 3)) == sorted(v for v in values if (v ^ asked).bit_count() <= 3)


def clustered(n, seed):
    mix = random.Random(seed)
    centres = [mix.getrandbits(64) for _ in range(n // 12)]
    found = set()
    while len(found) < n:
        value = mix.choice(centres)
        for _ in range(mix.randint(0, 4)):
            value ^= 1 << mix.randrange(64)
        found.add(value)
    return sorted(found)


def test_links_connect_all_pairs_whatever_the_shards(spark, monkeypatch):
    """Small trees (blocks that meet pairwise) and longer shard keys give the same components."""
    values = clustered(300, 5)
    marks = list(enumerate(values))
    expected = plain_components(marks)
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in marks]
    classes = spark.createDataFrame(signed, "node long, fingerprint long")
    for tree, kept in ((768, 1), (5, 1), (768, 2)):
        monkeypatch.setattr(simhash, "_kept_blocks", lambda n, k=kept: k)
        found = {r.node: r.component for r in components(simhash.link_classes(classes, 3, tree)).collect()}
        assert {i: found.get(i, i) for i in expected} == expected


def test_long_path_contracts(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "u long, v long")
    found = dict(map(tuple, components(edges).collect()))
    assert found == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_documents(spark, tables):
    documents = table(spark, tables, "documents")
    texts = {r.doc_id: r.text for r in documents.collect()}
    marks = [(i, plain_fingerprint(t)) for i, t in sorted(texts.items())]
    expected = plain_components(marks)
    found = simhash.op1_simhash(spark, tables).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {(i, f"{m:016x}", expected[i]) for i, m in marks}
    kept = [r.doc_id for r in simhash.keep_one(documents).collect()]
    assert sorted(kept) == sorted(set(expected.values()))


def test_odd_rows(odd, none):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[0].fingerprint == by_id[1].fingerprint == 0 and {by_id[i].component_id for i in (0, 1, 2)} == {0}
    assert by_id[6].component_id == 5 and all(r.component_id is None for r in found if r.doc_id is None)
    kept = simhash.keep_one(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and ids.count(5) == 1 and ids.count(None) == 2 and not {1, 2, 6} & set(ids)
    assert simhash.near_duplicates(none).count() == simhash.keep_one(none).count() == 0


def test_texts_under_one_id_are_judged_apart(spark):
    """Unlike texts with one id both stay; a near-duplicate of an earlier document goes, whatever else has its id."""
    mix = random.Random(3)
    a, b, c, d, e = (" ".join("".join(mix.choices("abcdefgh", k=6)) for _ in range(60)) for _ in range(5))
    rows = [(5, a), (5, b), (7, b), (9, c), (9, d), (2, d), (2, d), (8, e), (4, a), (11, a)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(4, a), (5, b), (9, c), (2, d), (8, e)])
    clash = simhash.keep_one(spark.createDataFrame([(5, a), (5, b), (5, a), (6, a), (6, b)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in clash) == sorted([(5, a), (5, b)])
