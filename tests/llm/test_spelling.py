"""Pivotal grams against all pairs of words."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import spelling
from ledgerline.llm.common import table


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def plain_words(rows, length=6, least=5):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= length and n >= least}


def plain_groups(counts):
    near = {w: set() for w in counts}
    parts = {}
    for w in counts:  # words one edit apart share what is left without some letter
        for cut in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            parts.setdefault(cut, []).append(w)
    for group in parts.values():
        for a, b in combinations(group, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(near[w]), form[w] and counts[form[w]]) for w, n in counts.items())


def grouped(spark, counts):
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    return sorted(map(tuple, spelling.group_spellings(frame).collect()))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab cÀ×ÿĀ\u0085 Z\n?1'", max_size=40))
def test_runs(text):
    assert [w.decode("latin-1") for w in spelling.runs(text)] == [
        "".join(c.lower() if "A" <= c <= "Z" else c for c in r) for r in re.findall("[A-Za-zÀ-ÿ]+", text)
    ]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=7, unique=True), st.integers(0, 10**6))
def test_pivots_weigh_least(places, seed):
    places = sorted(places)
    weights = np.random.default_rng(seed).integers(1, 20, len(places)).tolist()
    choices = [c for c in combinations(range(len(places)), 2) if places[c[1]] - places[c[0]] >= 2]
    chosen = spelling.choose_pivots(places, weights)
    assert len(chosen) == (2 if choices else 0)
    if choices:
        assert sum(weights[i] for i in chosen) == min(sum(weights[i] for i in c) for c in choices) and chosen in choices


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="abc", min_size=6, max_size=9), st.integers(0, 10**6))
def test_pivots_meet_prefixes(word, seed):
    """Of any two words one edit apart, one's pivots look into a cell of the other's prefix, whatever the order of grams."""
    mix = random.Random(seed)
    at = mix.randrange(len(word) + 1)
    other = mix.choice([word[:at] + "b" + word[at:], word[:at] + word[at + 1:], word[:at] + "c" + word[at + 1:]])
    if not one_edit(word, other) or len(other) < 4:
        return
    frequency = np.random.default_rng(seed).integers(1, 4, spelling.GRAMS)
    _, last_a, prefix_a, looked_a = spelling.word_entries(word, frequency)
    _, last_b, prefix_b, looked_b = spelling.word_entries(other, frequency)
    assert (last_a <= last_b and set(looked_a) & set(prefix_b)) or (last_b <= last_a and set(looked_b) & set(prefix_a))


@pytest.mark.parametrize("block", [spelling.BLOCK, 3])
def test_against_all_pairs(spark, monkeypatch, block):
    """Dense words, so that forms chain; groups of one size and cut into grids."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    mix = random.Random(7)
    words = {"".join(mix.choice("abé") for _ in range(mix.randint(4, 9))) for _ in range(400)}
    counts = {w: 5 ** mix.randint(0, 8) + mix.randint(0, 2) for w in words}
    assert grouped(spark, counts) == plain_groups(counts)


def test_odd_words(spark):
    counts = {"x" * 3000: 5, "x" * 3001: 50, "aaaa": 1, "aaaaa": 5, "aaaaaa": 25, "ßßßß": 7, "÷×÷×": 3}
    assert grouped(spark, counts) == plain_groups(counts)
    frame = spark.createDataFrame([("abc", 100), ("abcd", 5), (None, 3), ("abce", None)], "word string, n long")
    assert sorted(map(str, (tuple(r) for r in spelling.group_spellings(frame).collect()))) == sorted(
        map(str, [("abc", None, "abc", 100, 0, None), ("abcd", None, "abcd", 5, 0, None), (None, None, None, 3, 0, None), ("abce", None, "abce", None, 0, None)])
    )
    assert spelling.group_spellings(frame.filter("false")).count() == 0


def test_words_of_odd_documents(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = {r.word: r.n for r in spelling.count_words(odd).collect()}
    assert found == plain_words(rows)
    assert spelling.count_words(none).count() == 0


def test_query(spark, tables):
    rows = [(r.doc_id, r.text) for r in table(spark, tables, "documents").collect()]
    found = sorted(map(tuple, spelling.op11_spelling(spark, tables).select("word", "form", "root", "n", "n_near", "form_n").collect()))
    assert found == plain_groups(plain_words(rows)) and any(r[1] for r in found)
