from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from swishline.llm import bpe, packing, token_counts, token_files

TEXT = st.text(st.sampled_from("aé .,'\n\t  s1日$<|>é　\u0085ΑΣ"), max_size=60)


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary(name))


@pytest.fixture(scope="module")
def byte_level():
    return library(bpe.BYTE_BPE)


@pytest.fixture(scope="module")
def word_level():
    return library(bpe.WORD_BPE)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_units_give_the_ids_of_whole_texts(texts):
    own = bpe.encoder(bpe.vocabulary(bpe.BYTE_BPE))
    whole = library_cache(bpe.BYTE_BPE)
    texts += ["x<|endoftext|>y z", f"a {bpe.BEGIN} b", "it's we 'll", " lead", "tail "]
    ids, ends = own.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        expected = whole.encode(text or "", add_special_tokens=False).ids
        assert ids[ends[i] : ends[i + 1]].tolist() == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=8))
def test_units_give_the_counts_of_whole_texts(texts):
    counts = bpe.counter(bpe.vocabulary(bpe.WORD_BPE)).count(pa.array(texts, pa.string()))
    whole = library_cache(bpe.WORD_BPE)
    assert counts.tolist() == [
        len(whole.encode(t or "", add_special_tokens=False).ids) for t in texts
    ]


_LIBRARIES = {}


def library_cache(name):
    if name not in _LIBRARIES:
        _LIBRARIES[name] = library(name)
    return _LIBRARIES[name]


@pytest.mark.parametrize("kind", ["documents", "odd_documents"])
def test_token_counts(request, kind, word_level):
    docs = request.getfixturevalue(kind)
    found = sorted(map(str, token_counts.token_counts(docs, limit=100).collect()))
    expected = []
    for row in docs.collect():
        text = row["text"] or ""
        n = len(word_level.encode(text, add_special_tokens=False).ids)
        expected.append(
            f"Row(doc_id={row['doc_id']}, n_bytes={len(text.encode())}, n_tokens={n}, "
            f"over_limit={n > 100})"
        )
    assert found == sorted(expected)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_ranks_round_trip(ranks):
    values = np.array(ranks, np.uint32)
    control, data = token_files.pack_ranks(values)
    assert token_files.unpack_ranks(control, data, len(values)).tolist() == ranks
    assert len(control) == -(-len(ranks) // 4)


@pytest.mark.parametrize("kind", ["documents", "odd_documents"])
def test_token_files_give_back_all_ids(request, kind, byte_level, tmp_path):
    docs = request.getfixturevalue(kind)
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, path, block_tokens=5_000, range_bytes=100_000)
    found = sorted(token_files.read_token_files(docs.sparkSession, path).collect(), key=lambda r: r["start"])
    rows = sorted(
        ((r["doc_id"], r["text"]) for r in docs.collect()),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""),
    )
    start = 0
    assert len(found) == len(rows)
    for got, (doc_id, text) in zip(found, rows, strict=True):
        ids = [*byte_level.encode(text or "", add_special_tokens=False).ids, 0]
        assert (got["doc_id"], got["start"], got["n_tokens"]) == (doc_id, start, len(ids))
        assert np.frombuffer(got["ids"], "<u4").tolist() == ids
        start += len(ids)


def test_empty_tables(documents):
    none = documents.limit(0)
    assert token_counts.token_counts(none).collect() == []
    assert token_files.digest(token_files.token_files(none)).collect() == []
    assert packing.pack(none).collect() == []


@pytest.mark.parametrize("kind", ["documents", "odd_documents"])
def test_packing_places_every_token_once(request, kind, byte_level):
    docs = request.getfixturevalue(kind)
    rows = packing.pack(docs, search=packing.Search(islands=2, epochs=2, generations=3)).collect()
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    expected = {}
    for row in docs.collect():
        ids = [*byte_level.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        raw = np.array(ids, "<u4").tobytes()
        expected.setdefault(row["doc_id"], []).extend(
            (k, s, n, zlib.crc32(raw[4 * s : 4 * (s + n)]))
            for k, (s, n) in enumerate(packing.cut(len(ids), 1024))
        )
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    tokens = sum(r["length"] for r in rows)
    assert len(sequences) <= 1.02 * -(-tokens // 1024) + 1


@given(st.integers(1, 5000))
def test_only_the_first_piece_may_be_shorter(n):
    parts = packing.cut(n, 1024)
    assert [s for s, _ in parts] == [sum(x for _, x in parts[:k]) for k in range(len(parts))]
    assert sum(x for _, x in parts) == n
    assert all(x == 1024 for _, x in parts[1:])


@given(st.lists(st.integers(1, 100), min_size=1, max_size=60), st.integers(0, 5))
def test_crossover_keeps_every_piece(lengths, seed):
    import random
    from collections import Counter

    pieces, rng = Counter(lengths), random.Random(seed)
    a = packing.best_fit(sorted(pieces.items(), reverse=True), 100)
    b = packing._first_individual(pieces, 100, rng)
    child = packing.cross(a, b, pieces, 100, rng, 0.95)
    for bins in (a, b, child):
        held = Counter()
        for bin_, count in bins.items():
            assert sum(bin_) <= 100
            for x in bin_:
                held[x] += count
        assert held == pieces


# --- the packing search where best fit fails


def triplets(count, capacity, seed):
    """Lengths of three pieces that fill a sequence, ``count`` times: ``count`` is the best."""
    rng, out = random.Random(seed), []
    while len(out) < 3 * count:
        a = rng.randint(capacity * 38 // 100, capacity * 49 // 100)
        b = rng.randint(capacity // 4 + 1, (capacity - a) // 2)
        if capacity // 4 < capacity - a - b < capacity // 2:
            out += [a, b, capacity - a - b]
    return Counter(out)


@pytest.mark.parametrize("count", [20, 60])
def test_islands_beat_best_fit_where_it_is_not_optimal(spark, count):
    pieces = triplets(count, 1000, 5)
    plain = sum(packing.best_fit(sorted(pieces.items(), reverse=True), 1000).values())
    bins = packing.pack_lengths(spark, pieces, 1000)
    assert count <= sum(bins.values()) <= plain - 2
    assert packed(bins) == pieces and max(map(sum, bins)) <= 1000


def packed(bins):
    total = Counter()
    for bin_, n in bins.items():
        for x in bin_:
            total[x] += n
    return total


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.integers(1, 50), st.integers(1, 6)), min_size=1, max_size=25), st.integers(0, 99))
def test_crossover_with_replacement_keeps_every_piece(lengths, seed):
    pieces = Counter()
    for length, count in lengths:
        pieces[length] += count
    rng = random.Random(seed)
    a, b = (packing._first_individual(pieces, 50, rng) for _ in range(2))
    for well in (0.5, 0.995):
        child = packing.cross(a, b, pieces, 50, rng, well)
        assert packed(child) == pieces
        assert max(map(sum, child)) <= 50 and min(child.values()) > 0


def test_displaced_pieces_replace_smaller_ones():
    bins, displaced = {(400, 300): 2, (1000,): 1}, Counter({550: 3, 350: 2})
    packing.replace(bins, displaced, 1000)
    assert packed(bins) + displaced == Counter({400: 2, 300: 2, 1000: 1, 550: 3, 350: 2})
    assert bins[(1000,)] == 1 and max(sum(b) for b in bins if b != (1000,)) > 900
