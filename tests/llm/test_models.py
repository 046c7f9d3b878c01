"""Toxicity and quality: the algebra against plain sums, and held-out accuracy."""

import tracemalloc
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import quality, toxicity
from ledgerline.llm.common import fold, table


def auc(rows):
    good, bad = [s for s, y in rows if y], [s for s, y in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("text", ["idiot", "a b idiot c d e idiot", "fool idiot fool a", "x y z " * 30 + "idiot a fool", "fool " * 9])
def test_marginals_equal_the_sum_over_all_taggings(text):
    model = toxicity.ToxicModel({b"idiot": 2.0, b"fool": -0.5}, -1.5, ((0.3, -0.4), (0.1, 0.9)), 1.0, 0.0)
    words = toxicity.words_of(text)[-12:]
    found = toxicity.document_marginals([b" ".join(words).decode(), "nothing here"], model)
    weight = [model.weights.get(w, model.other) for w in words]
    mass = np.zeros((len(words), 2))
    for tags in product((0, 1), repeat=len(words)):
        s = sum(w for w, t in zip(weight, tags) if t) + sum(model.transitions[a][b] for a, b in zip(tags, tags[1:]))
        for i, t in enumerate(tags):
            mass[i, t] += np.exp(s)
    expected = [(i, mass[i, 1] / mass[i].sum()) for i, w in enumerate(words) if w in model.weights]
    assert [i for i, _ in found[0][1]] == [i for i, _ in expected]
    assert np.allclose([p for _, p in found[0][1]], [p for _, p in expected])
    assert found[0][0] == pytest.approx(1 - np.prod([1 - p for _, p in expected])) and found[1] == (0.0, [])


def test_padded_chains_equal_single_ones():
    mix = np.random.default_rng(1)
    emit, trans = mix.normal(size=(3, 5)), mix.normal(size=(2, 2))
    mask = np.arange(5) < np.array([5, 3, 1])[:, None]
    log_z, marginal, moves = toxicity._forward_backward(emit, trans, mask)
    total = np.zeros((2, 2))
    for row, n in enumerate((5, 3, 1)):
        scores = {}
        for tags in product((0, 1), repeat=n):
            scores[tags] = np.exp(sum(emit[row, i] for i in range(n) if tags[i]) + sum(trans[a][b] for a, b in zip(tags, tags[1:])))
        z = sum(scores.values())
        for i in range(n):
            assert marginal[row, i] == pytest.approx(sum(s for t, s in scores.items() if t[i]) / z)
        for t, s in scores.items():
            for a, b in zip(t, t[1:]):
                total[a, b] += s / z
        assert log_z[row] == pytest.approx(np.log(z))
    assert np.allclose(moves, total)


def test_toxicity_on_held_out_rows(spark, tables):
    folder = tables.replace("sf0.001", "sf0.1")  # the smaller ones have some fifty toxic rows in four languages
    labels = table(spark, folder, "labels")
    found = toxicity.op3_toxicity(spark, folder).join(labels, "doc_id").filter("held_out")
    rows = [(r.score, r.toxic) for r in found.collect()]
    assert auc(rows) > 0.85
    clean = [s for s, y in rows if not y]
    assert sum(s >= 0.5 for s in clean) <= 0.03 * len(clean)


def test_toxic_spans_name_the_words(spark):
    """Offsets point at the words; text that lower-cases to another length keeps its offsets."""
    mix = np.random.default_rng(0)
    fill = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    rows = []
    for i in range(120):
        words = list(mix.choice(fill, 30))
        if i % 2:
            for at in mix.choice(30, 3, replace=False):
                words[at] = "Villain!"
        rows.append((" ".join(words), i % 2))
    model = toxicity.fit(rows)
    df = spark.createDataFrame([(1, "İİ waa VILLAIN wab, villain."), (2, "waa wab")], "doc_id long, text string")
    one, two = toxicity.toxicity(df, model).orderBy("doc_id").collect()
    text = "İİ waa VILLAIN wab, villain."
    assert [text[s.start:s.end] for s in one.spans] == ["VILLAIN", "villain"] and one.score > 0.5 > two.score and two.spans == []


LISTED = toxicity.ToxicModel({b"bad": 2.0, b"worse": 3.5, b"fine": -1.0}, -1.5, ((0.3, -0.2), (-0.4, 0.5)), 1.0, 0.0)


@pytest.mark.parametrize("long, cells", [(0, 1 << 20), (10**9, 1), (5, 12)])
def test_groups_and_long_texts_change_no_marginal(monkeypatch, long, cells):
    """Texts moved together, in small groups and one by one in plain numbers give the same."""
    mix = np.random.default_rng(1)
    texts = [" ".join(mix.choice(["bad", "worse", "fine", "x", "y"], mix.integers(0, 40))) for _ in range(60)] + ["bad", "x bad", "", "x"]
    whole = toxicity.document_marginals(texts, LISTED)
    monkeypatch.setattr(toxicity, "LONG", long)
    monkeypatch.setattr(toxicity, "CELLS", cells)
    for (a, one), (b, two) in zip(whole, toxicity.document_marginals(texts, LISTED)):
        assert a == pytest.approx(b) and [i for i, _ in one] == [i for i, _ in two]
        assert [p for _, p in one] == pytest.approx([p for _, p in two])


def test_one_long_toxic_text_beside_short_ones():
    """Memory follows the text, not its listed words times all other texts."""
    texts = ["bad word " * 150_000] + ["x bad"] * 1000
    tracemalloc.start()
    try:
        found = toxicity.document_marginals(texts, LISTED)
        assert tracemalloc.get_traced_memory()[1] < 150e6
    finally:
        tracemalloc.stop()
    assert len(found[0][1]) == 150_000 and len(found[5][1]) == 1


def test_toxic_offsets_of_the_query(spark, tables):
    folder = tables.replace("sf0.001", "sf0.01")
    documents = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    found = toxicity.op3_toxicity(spark, folder).collect()
    hot = [(r, [tuple(map(int, x.split(":"))) for x in r.offsets.split(",")]) for r in found if r.n_spans]
    assert hot and all(len(x) == r.n_spans and all(documents[r.doc_id][a:b].strip() for a, b in x) for r, x in hot)


def test_quality_on_held_out_rows(spark, tables):
    folder = tables.replace("sf0.001", "sf0.01")
    found = quality.op6_quality(spark, folder).join(table(spark, folder, "labels"), "doc_id").filter("held_out")
    assert auc([(r.score, r.quality) for r in found.collect()]) > 0.9


def test_density_difference_is_that_of_the_formula():
    mix = np.random.default_rng(2)
    covs = [a @ a.T + np.eye(3) for a in mix.normal(size=(2, 3, 3))]
    means, x = mix.normal(size=(2, 3)), mix.normal(size=(6, 3))
    model = quality.Discriminant(
        (np.log(0.3), np.log(0.7)), means, np.array([np.linalg.inv(np.linalg.cholesky(c)) for c in covs]),
        tuple(float(np.linalg.slogdet(c)[1]) for c in covs),
    )
    density = [np.log(p) - 0.5 * np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m) - 0.5 * np.linalg.slogdet(c)[1] for p, m, c in zip((0.3, 0.7), means, covs)]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(density[0] - density[1])))


def test_labels_of_the_held_out_fold_change_nothing(spark, tables):
    """Scores stay the same when the held-out labels are turned around."""
    documents, labels = table(spark, tables, "documents"), table(spark, tables, "labels")
    turned = labels.withColumn("quality", F.when(fold("doc_id", 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    turned = turned.withColumn("toxic", F.when(fold("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r.doc_id: r.score for r in quality.score_quality(documents, labels).collect()}
    b = {r.doc_id: r.score for r in quality.score_quality(documents, turned).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 for k in a)
    sample = sorted(toxicity.training_sample(documents, labels, "toxic", 5, 0))
    assert sample == sorted(toxicity.training_sample(documents, turned, "toxic", 5, 0)) and sample


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(5, 1, 0), (5, None, None), (None, 1, 1), (99, 0, 1), (10, 0, 1), (13, 0, 0), (15, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    empty = labels.filter("false")
    for marks in (labels, empty):
        found = quality.score_quality(odd, marks).collect()
        assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
        model = toxicity.toxic_model(odd, marks)
        found = toxicity.toxicity(odd, model).collect()
        assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
        kept = toxicity.reject_toxic(odd, model)
        assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert quality.score_quality(none, labels).count() == toxicity.toxicity(none, toxicity.toxic_model(none, labels)).count() == 0
