"""The index against plain search."""

import random
import re
import tracemalloc

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import decontam
from ledgerline.llm.common import table


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=10):
    windows = {}
    for item, text in items:
        words = plain_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[i:i + window]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        words = plain_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                owners = windows.get(tuple(words[i:i + n]))
                if owners:
                    hit |= set(range(i, i + n))
                    found |= owners
        out.append((len(words), sorted(hit), sorted(found)))
    return out


def hits(found):
    return found.words, [i for a, b in found.spans for i in range(a, b)], found.items


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=120))
def test_suffix_order(symbols):
    """Separators are smaller than words and ordered by position."""
    text = np.array([*symbols, 0])
    own = [(0, i) if s == 0 else (1, s) for i, s in enumerate(text.tolist())]
    assert decontam.suffix_array(text, 3).tolist() == sorted(range(len(own)), key=lambda i: own[i:])


@settings(max_examples=80, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from("a b c X9 é zz".split()), max_size=40).map(" ".join), min_size=1, max_size=6),
    st.lists(st.lists(st.sampled_from("a b c X9".split()), max_size=8).map(", ".join), max_size=5), st.integers(1, 4),
)
def test_search(texts, items, window):
    items = list(enumerate(items))
    found = decontam.search([t.encode() for t in texts], decontam.phrases([(i, t.encode()) for i, t in items], window))
    assert [hits(f) for f in found] == brute(texts, items, window)


def test_query(spark, tables):
    texts = {r.doc_id: r.text for r in table(spark, tables, "documents").collect()}
    items = [(r.item_id, r.text) for r in table(spark, tables, "benchmark").collect()]
    expected = dict(zip(texts, brute(texts.values(), items)))
    found = decontam.op7_decontam(spark, tables).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in found} == {
        i: (n, len(h), len(o), bool(h)) for i, (n, h, o) in expected.items()
    }
    assert any(r.contaminated for r in found)
    # In blocks of items the result is the same.
    one = decontam.find_passages(table(spark, tables, "documents"), table(spark, tables, "benchmark"))
    more = decontam.find_passages(table(spark, tables, "documents"), table(spark, tables, "benchmark"), limit=4000)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, more.select(one.columns).collect()))


def test_removal(spark, tables):
    """Nothing of the benchmark is left, and texts without any are untouched."""
    documents, benchmark = table(spark, tables, "documents"), table(spark, tables, "benchmark")
    before = {r.doc_id: r for r in documents.collect()}
    dirty = {r.doc_id for r in decontam.op7_decontam(spark, tables).collect() if r.contaminated}
    after = decontam.remove_passages(documents, benchmark)
    assert after.columns == documents.columns
    rows = after.collect()
    assert {r.doc_id for r in rows if r.text != before[r.doc_id].text} == dirty and len(rows) == len(before)
    assert all(r.n_chars == len(r.text) for r in rows if r.doc_id in dirty)
    assert not any(f.hit for f in decontam.search([r.text.encode() for r in rows], decontam.phrases([(r.item_id, r.text.encode()) for r in benchmark.collect()])))


def test_removal_does_not_depend_on_blocks(spark, odd):
    """Items that share words in different blocks, and windows that a cut by another block spells."""
    rows, items = [], []
    for n in range(12):
        w = [f"w{n}x{i}" for i in range(60)]
        items += [(4 * n, " ".join(w[:30] + w[40:45])), (4 * n + 1, " ".join(w[:36])), (4 * n + 2, " ".join(w[48:58]))]
        rows += [
            (4 * n, "before " + ", ".join(w[:36]) + " after", 0), (4 * n + 1, " ".join(["a", *w[48:53], *w[:36], *w[53:58], "z"]), 0),
            (4 * n + 2, " ".join(["kept", *w[:9], "words", *w[48:57]]), -1), (4 * n + 3, None, -1),
        ]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_chars int").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert len(decontam.benchmark_blocks(benchmark, 1000)) > 4
    one, more = (decontam.remove_passages(documents, benchmark, limit=x) for x in (1 << 20, 1000))
    found = {r.doc_id: (r.text, r.n_chars) for r in more.collect()}
    assert found == {r.doc_id: (r.text, r.n_chars) for r in one.collect()} and more.schema.simpleString() == documents.schema.simpleString()
    for doc, text, chars in rows:
        assert found[doc] == ([("before  after", 13), ("a  z", 4), (text, chars), (None, -1)][doc % 4])
    assert sorted(map(repr, decontam.remove_passages(odd, benchmark, limit=1000).collect())) == sorted(map(repr, odd.collect()))


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "A"), (2, None), (None, "x y"), (3, ""), (3, "quick brown fox"), (3, "quick brown fox")], "item_id long, text string")
    found = decontam.find_passages(odd, items).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[0].n_words == 0 and by_id[3]["items"] == [1] and [tuple(s) for s in by_id[3].spans] == [(0, 1)]
    assert decontam.remove_passages(odd, items).columns == odd.columns and decontam.remove_passages(odd, items).count() == odd.count()
    assert decontam.find_passages(none, items).count() == 0
    assert all(not r.spans for r in decontam.find_passages(odd, items.filter("false")).collect())


def test_windows_of_a_large_block_are_arrays():
    """Eight megabytes of benchmark with few words in common: a bounded block in the driver."""
    mix = random.Random(8)
    rows_ = [(i, " ".join(f"{mix.randrange(16**5):05x}" for _ in range(400)).encode()) for i in range(800)]
    size = sum(len(t) for _, t in rows_)
    tracemalloc.start()
    try:
        wanted = decontam.phrases(rows_)
        assert tracemalloc.get_traced_memory()[1] < 60 * size
    finally:
        tracemalloc.stop()
    assert len(wanted.lengths) == 800 * 391 and wanted.items(0)[0] in range(800)


def test_windows_and_their_items():
    wanted = decontam.phrases([(3, b"a b c d"), (1, b"b c d"), (2, b""), (4, b"C D"), (5, b"c d"), (3, b"a b c d")], 3)
    number = {v: k for k, v in wanted.vocabulary.items()}
    found = {tuple(number.get(x, b"") for x in row): wanted.items(i) for i, row in enumerate(wanted.symbols.tolist())}
    assert found == {(b"a", b"b", b"c"): [3], (b"b", b"c", b"d"): [1, 3], (b"", b"c", b"d"): [4, 5]}
    assert wanted.lengths.tolist() == [3 if b"" not in w else 2 for w in found]
