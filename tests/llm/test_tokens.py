"""Token counts, token files and packing against the tokenizer libraries."""

import random
import tracemalloc
import zlib
from itertools import product

import numpy as np
import pyarrow.fs as pafs
import pytest
import sentencepiece
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.llm_odd import ODD_STRINGS
from tokenizers import Tokenizer

from ledgerline.llm import packing, tokencount, tokenfile, wordids
from ledgerline.llm.common import scratch, table

PIECES = tokenfile.tokenizer_path("piece_bpe_32k.model")
WORDS = tokenfile.tokenizer_path("word_bpe_49k.json")
library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
tokenizer = Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def machine():
    return tokencount.Transducer(PIECES)


def test_memory_of_a_text_without_boundaries(machine):
    """A text without blanks is counted chunk by chunk: maps hold states, not texts."""
    text = "".join(random.Random(4).choices("abcdefghij", k=200_000))
    wanted = tokencount.count_tokens(machine, text)
    tracemalloc.start()
    try:
        assert tokencount.count_tokens(machine, text, 500) == wanted
        assert tracemalloc.get_traced_memory()[1] < 12 * len(text)
    finally:
        tracemalloc.stop()


def ids_of(text, end):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


TEXT = st.one_of(st.text(max_size=60), st.text(alphabet="ab e\n  th.,▁é😀\tion0", max_size=80))


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 9))
def test_counts_of_any_text_in_any_chunks(text, chunk):
    machine = tokencount.transducer(PIECES)
    wanted = len(library.encode(text))
    assert tokencount.count_tokens(machine, text) == wanted == tokencount.count_tokens(machine, text, chunk)


def states(machine, texts):
    """States the machine is in after some texts, and the first one."""
    return {tokencount.START, *(machine.follow(t.replace(" ", tokencount.SPACE), tokencount.START)[0] for t in texts)}


CHUNKS = st.lists(st.text(alphabet="ab the\nion é", max_size=7), min_size=3, max_size=6)


@settings(max_examples=150, deadline=None)
@given(CHUNKS, st.text(alphabet="ab theion", max_size=6))
def test_chunk_maps_equal_the_machine(parts, before):
    """Per entry state, the map of a chunk is what the machine does from there, character by character."""
    machine = tokencount.transducer(PIECES)
    for part in parts:
        for entry in states(machine, [before, "a", " "]):
            assert tokencount.chunk_map(machine, part, [entry]) == {entry: machine.follow(part.replace(" ", tokencount.SPACE), entry)}


@settings(max_examples=100, deadline=None)
@given(CHUNKS)
def test_composition_and_prefix_states(parts):
    machine = tokencount.transducer(PIECES)
    maps, entries = [], states(machine, ["th", "  "])
    for part in parts:
        maps.append(tokencount.chunk_map(machine, part, entries))
        entries = {end for end, _ in maps[-1].values()}
    a, b, c = maps[:3]
    assert tokencount.compose(tokencount.compose(a, b), c) == tokencount.compose(a, tokencount.compose(b, c))
    for i, prefix in enumerate(tokencount.scan(maps)):
        whole = "".join(parts[: i + 1]).replace(" ", tokencount.SPACE)
        assert prefix == {entry: machine.follow(whole, entry) for entry in maps[0]}


@settings(max_examples=100, deadline=None)
@given(TEXT, st.integers(1, 12))
def test_stretches_add_up(text, size):
    machine = tokencount.transducer(PIECES)
    parts = list(tokencount.stretches(tokencount.prepared(text), size))
    assert "".join(parts) == tokencount.prepared(text)
    assert sum(tokencount.count_from_boundary(machine, p) for p in parts) == len(library.encode(text))


def test_long_texts_are_spread_over_tasks(spark, odd):
    wanted = sorted((r.doc_id or -1, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in odd.collect())
    rows = tokencount.token_counts(odd, PIECES, stretch=300)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows.collect()) == wanted


def test_forgetting_changes_nothing(machine, monkeypatch):
    texts = [" ".join("".join(random.Random(i).choices("abcdetion", k=7)) for _ in range(50)) for i in range(20)]
    monkeypatch.setattr(tokencount, "KEPT_STATES", 50)
    monkeypatch.setattr(tokencount, "KEPT_SEGMENTS", 10)
    assert [tokencount.count_tokens(machine, t) for t in texts] == [len(library.encode(t)) for t in texts]


def test_count_query(spark, tables, odd, none):
    texts = {r.doc_id: r.text for r in table(spark, tables, "documents").collect()}
    found = tokencount.op4_tokencount(spark, tables).collect()
    assert {tuple(r) for r in found} == {(i, len(t.encode()), n := len(library.encode(t)), n > 4096) for i, t in texts.items()}
    rows = tokencount.token_counts(odd, PIECES)
    wanted = sorted((r.doc_id or -1, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in odd.collect())
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows.collect()) == wanted
    assert tokencount.token_counts(none, PIECES).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TEXT, st.sampled_from(ODD_STRINGS)), max_size=5))
def test_word_ids_equal_the_library_s(texts):
    ids, sizes = wordids.encoder(WORDS, 7).encode([t.encode() for t in texts])
    parts = np.split(ids, np.cumsum(sizes)[:-1]) if texts else []
    assert [p.tolist() for p in parts] == [ids_of(t, 7) for t in texts]


def test_word_ids_with_small_caches_and_short_stretches(monkeypatch):
    """Half of the pieces are dropped again and again, and texts are split at every few blanks."""
    monkeypatch.setattr(wordids, "KEPT_PIECES", 30)
    monkeypatch.setattr(wordids, "STRETCH", 7)
    own, mix = wordids.TextEncoder(WORDS, 7), random.Random(3)
    for _ in range(60):
        batch = [" ".join(mix.choice([*ODD_STRINGS, "the", "of", "don't", "l'été", "3.14!", "x" * mix.randint(1, 9)]) for _ in range(mix.randint(0, 12))) for _ in range(4)]
        ids, sizes = own.encode([t.encode() for t in batch])
        assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [ids_of(t, 7) for t in batch]
    monkeypatch.setattr(wordids, "KEPT_IDS", 10)
    ids, sizes = own.encode([b"the long and the short"])
    assert ids.tolist() == ids_of("the long and the short", 7)


def test_other_tokenizers_encode_whole_texts():
    path = tokenfile.tokenizer_path("byte_bpe_50k.json")
    own, other = wordids.TextEncoder(path, 3), Tokenizer.from_file(path)
    assert not own.word_wise
    ids, sizes = own.encode([b"two  words", b""])
    assert ids.tolist() == other.encode("two  words", add_special_tokens=False).ids + [3, 3] and sizes.sum() == len(ids)


def test_files(spark, tables, odd, none):
    documents = table(spark, tables, "documents")
    folder = scratch(spark, "ids")
    files = tokenfile.write_files(documents, folder, WORDS)
    found = sorted(map(tuple, tokenfile.read_files(files).collect()))
    start, expected = 0, []
    texts = {r.doc_id: r.text for r in documents.collect()}
    for i in sorted(texts):
        ids = np.array(ids_of(texts[i], 1), "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == expected
    # Any reader can decompress a file as a whole; the table gives single documents.
    first = files.orderBy("part").first()
    filesystem, place = pafs.FileSystem.from_uri(first.file)
    with filesystem.open_input_file(place) as source:
        whole = zstandard.ZstdDecompressor().stream_reader(source.read(), read_across_frames=True).read()
    assert len(whole) == 4 * first.tokens
    some = sorted(texts)[1]
    assert tokenfile.documents_of(first.file, [some, -5])[some].tolist() == ids_of(texts[some], 1)
    rows = tokenfile.read_files(tokenfile.write_files(odd, scratch(spark, "ids"), WORDS)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted([r.doc_id for r in odd.collect()], key=lambda i: (i is not None, i or 0))
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    assert tokenfile.read_files(tokenfile.write_files(none, scratch(spark, "ids"), WORDS)).count() == 0


def test_damage_is_noticed(tmp_path):
    place = tmp_path / "x.zst"
    with place.open("wb") as out:
        writer = tokenfile.FrameWriter(out)
        writer.add(4, b"abcd" * 50)
        writer.close()
    body = bytearray(place.read_bytes())
    assert tokenfile.open_file(str(place)).content(0) == b"abcd" * 50
    body[-23] ^= 1  # the checksum of the frame in the table
    place.write_bytes(bytes(body))
    with pytest.raises(ValueError):
        for i in range(1):
            tokenfile.open_file(str(place)).content(i)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=40))
def test_plan_uses_every_piece_once(counts):
    histogram = np.zeros(65, np.int64)
    for size, n in counts.items():
        histogram[size] = n
    planned = packing.plan(histogram, 64)
    used = np.zeros(65, np.int64)
    for shape, n in planned:
        assert 0 < sum(shape) <= 64 and n > 0
        for size in shape:
            used[size] += n
    assert (used == histogram).all()
    histogram[0] = 0
    assert sum(n for _, n in planned) <= sum(n for _, n in packing.best_fit(histogram, 64))


def every_pattern(length):
    return np.array([(a, b, length - a - b) for a in range(1, length) for b in range(a, length) if b <= length - a - b]
                    + [(a, length - a, 0) for a in range(1, length // 2 + 1)])


def test_pattern_fit_reproduces_a_mixture():
    wanted = np.zeros(41, np.int64)
    for shape in every_pattern(40)[::7]:
        for size in shape[shape > 0]:
            wanted[size] += 50
    shapes, counts = packing.fit_patterns(wanted, 40)
    assert (shapes.sum(1) == 40).all() and (counts >= 0).all()
    sizes = np.arange(41)  # in tokens
    assert np.abs(np.where(sizes, packing.made(shapes, counts, 41), 0) - wanted) @ sizes < 0.02 * (wanted @ sizes)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**6))
def test_fit_is_that_of_an_exact_solver(seed):
    """Non-negative least squares by trying every set of patterns that may repeat."""
    mix = np.random.default_rng(seed)
    shapes = every_pattern(9)[mix.choice(len(every_pattern(9)), 6, replace=False)]
    wanted = np.concatenate(([0], mix.integers(0, 40, 9)))
    matrix = np.stack([packing.made(shapes[[i]], np.ones(1), 10) for i in range(6)], axis=1)
    best = float(wanted @ wanted)
    for chosen in product([False, True], repeat=6):
        if any(chosen):
            counts = np.linalg.lstsq(matrix[:, chosen], wanted.astype(float), rcond=None)[0]
            if (counts >= -1e-9).all():
                best = min(best, float(((matrix[:, chosen] @ counts - wanted) ** 2).sum()))
    rest = packing.made(shapes, packing.fit_counts(shapes, wanted, np.ones(10), steps=3000), 10) - wanted
    assert rest @ rest == pytest.approx(best, rel=1e-3, abs=1e-2)


def test_spread_lengths_pack_as_well_as_best_fit():
    """Three thousand lengths spread evenly, most of which fit with one other at best."""
    sizes = np.random.default_rng(0).integers(1, 2029, 3000)
    histogram = np.bincount(sizes, minlength=2049)
    used, bound = sum(n for _, n in packing.plan(histogram)), -(-int(sizes.sum()) // 2048)
    histogram[0] = 0
    assert used <= sum(n for _, n in packing.best_fit(histogram, 2048)) and used <= 1.03 * bound


def check_packed(rows, texts, length):
    """Pieces cover their documents, sequences are gapless; returns the number of sequences."""
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        documents.setdefault(r.doc_id, []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    for i, text in texts.items():
        ids = np.array(ids_of(text, 0), "<u4")
        parts = sorted(documents[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in parts] == [(n, a, min(length, len(ids) - a)) for n, a in enumerate(range(0, len(ids), length))]
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in parts)
    return len(sequences)


def test_packing(spark, tables, odd, none):
    documents = table(spark, tables, "documents")
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = packing.op9_packing(spark, tables).collect()
    used = check_packed(rows, texts, 2048)
    assert used <= 1.02 * sum(r.length for r in rows) / 2048 + 1
    packed = packing.pack(documents, WORDS)
    whole = {r.sequence_id: list(r.ids) for r in packing.sequences(documents, packed, WORDS).collect()}
    one = packed.filter("doc_id = 3 and piece = 0").first()
    assert whole[one.sequence_id][one.offset:one.offset + one.length] == ids_of(texts[3], 0)[:2048]
    once = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_packed(packing.pack(once, WORDS, 0, 64).collect(), {r.doc_id: r.text for r in once.collect()}, 64)
    assert packing.pack(odd, WORDS).filter("piece = 0").count() == odd.count() and packing.pack(none, WORDS).count() == 0
