"""Patterns against the plain regular expressions; the field against all readings."""

import hashlib
import re
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import pii
from ledgerline.llm.common import table

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    def passes(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == 1:
            return all(int(p) <= 255 for p in s.split("."))
        if kind == 2:
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
        return kind == 0 or 9 <= len(digits) <= 15

    return [(k, *m.span()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if passes(k, m.group())]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(alphabet="ab_.@-1250+() é", max_size=50), st.text(alphabet="4111 -.+", max_size=60)))
def test_patterns(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["4111 1111 1111 1111", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "256.1.1.1", "x+1 (743) 555-3824.", "a@b@c.de", "007.1.1.1"])
def test_known_cases(text):
    assert pii.base_spans(text) == plain(text)


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000, "a@" * 100_000, "+1 " * 100_000, "1 " * 100_000):
        pii.base_spans(text)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**6))
def test_programs_equal_all_readings(seed):
    """log Z, marginals and the best reading of a small region, by listing every segmentation."""
    mix = np.random.default_rng(seed)
    region = "".join(mix.choice(list("12.34-+ 5678"), 9))
    size, found = pii._segments(region, "x ", " y")
    found = found[:7]
    field = pii.Field(mix.normal(size=(len(pii.KINDS), pii.FEATURES)))
    scores = field._scores(found)
    readings = {}
    for chosen in product(*[range(-1, len(pii.KINDS)) for _ in found]):
        parts = [(found[x][0], found[x][1], x, k) for x, k in enumerate(chosen) if k >= 0]
        parts.sort()
        if all(a[1] <= b[0] for a, b in zip(parts, parts[1:])):
            readings[tuple((x, k) for _, _, x, k in parts)] = sum(scores[x, k] for _, _, x, k in parts)
        if len(readings) > 4000:
            return
    z = np.logaddexp.reduce(list(readings.values()))
    log_z, chance, _ = field.marginals(size, found)
    assert log_z == pytest.approx(z)
    for x in range(len(found)):
        for k in range(len(pii.KINDS)):
            assert chance[x, k] == pytest.approx(sum(np.exp(s - z) for r, s in readings.items() if (x, k) in r))
    best = field.best(size, found)
    assert sum(scores[x, k] for x, k in best) == pytest.approx(max(readings.values()))


def test_field_adds_what_the_patterns_miss():
    mix = np.random.default_rng(1)
    rows_ = []
    for _ in range(60):
        a, b, c = mix.integers(200, 999), mix.integers(200, 999), mix.integers(1000, 9999)
        text = f"+1 ({a}) {b}-{c}"
        rows_.append((text, "call ", " now", pii.base_spans(text)))
        text = str(mix.integers(10**15, 10**16))
        rows_.append((text, "no ", " x", pii.base_spans(text)))
    field = pii.fit(rows_)
    assert pii.added_spans(field, 10, "(743) 555-3824", "tel ", " x", []) == [(3, 10, 24)]
    assert pii.added_spans(field, 0, "(743) 555-3824", "tel ", " x", [(3, 0, 5)]) == []
    assert pii.added_spans(field, 0, "1234567890123452", "n ", " x", []) == []


def test_query(spark, tables):
    texts = {r.doc_id: r.text for r in table(spark, tables, "documents").collect()}
    found = pii.personal_data(table(spark, tables, "documents")).collect()
    assert {r.doc_id: [tuple(s) for s in r.base] for r in found} == {i: plain(t) for i, t in texts.items()}
    for r in found:
        assert set(r.base) <= set(r.spans) and all(0 <= s.start < s.end <= len(texts[r.doc_id]) for s in r.spans)


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)


def test_every_column_of_the_query(spark, tables, odd, tmp_path):
    """Counts and digest from the plain patterns, spans from the operator, on given and on odd texts."""
    for folder, documents in ((tables, table(spark, tables, "documents")), (str(tmp_path), odd)):
        if documents is odd:
            odd.write.parquet(f"{folder}/documents.parquet")
        base = {r.doc_id: plain(r.text or "") for r in documents.collect() if r.doc_id is not None}
        spans = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.personal_data(documents).collect()}
        found = {r.doc_id: r for r in pii.op10_pii(spark, folder).collect()}
        assert base.keys() <= found.keys() and (documents is not odd or {kind for x in base.values() for kind, _, _ in x} == {0, 1, 2, 3})
        for i, expected in base.items():
            r = found[i]
            counts = tuple(sum(s[0] == k for s in expected) for k in range(4))
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == counts
            assert r.base_sha256 == hashlib.sha256(listed(expected).encode()).hexdigest() and r.spans == listed(spans[i])


def test_masking(spark, odd, none):
    field = pii.fit([])
    out = {r.doc_id: r for r in pii.mask(odd, field).collect() if r.doc_id is not None}
    assert out[10].text == "[PHONE], [EMAIL], [IP], [CARD]" and out[10].n_chars == len(out[10].text) and out[0].text is None
    before = {r.doc_id: r for r in odd.collect() if r.doc_id is not None}
    assert all(out[i].text == before[i].text for i in before if not pii.base_spans(before[i].text or ""))
    assert pii.mask_personal_data(odd).columns == odd.columns and pii.mask_personal_data(odd).count() == odd.count()
    assert pii.personal_data(odd).count() == odd.count()
    assert pii.personal_data(none).count() == pii.mask_personal_data(none).count() == 0
