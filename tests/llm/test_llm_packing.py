import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lotwise.llm.packing import OPEN_BINS, best_fit, cuts, encoder, pack, packed_sequences, tokenizer_path


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def check(docs, rows, plain, length=2048):
    ids = [(r.doc_id, plain.encode(r.text or "", add_special_tokens=False).ids + [0]) for r in docs.collect()]
    want = sorted((str(i), k, s, n, zlib.crc32(np.array(x[s:s + n], "<u4").tobytes())) for i, x in ids for k, (s, n) in enumerate(cuts(len(x), length)))
    assert sorted((str(r.doc_id), r.piece, r.start, r["length"], r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(by), -(-sum(len(x) for _, x in ids) // length)


def test_real_documents(documents, plain):
    used, bound = check(documents, pack(documents, tokenizer_path()).collect(), plain)
    assert used <= bound * 1.01 + 1


def test_odd_rows(odd, plain):
    long = "word " * 9000 + "x" * 30000 + " " * 5000 + "<|endoftext|> é 漢字"
    docs = odd([(1, None, "en", "a"), (None, "", "en", None), (2, long, "en", "a"), (2, long, "en", "a"), (3, "a<|endoftext|>b", "en", "a"), (4, "\n\n  x's 12\t", "en", "b")])
    packed = pack(docs, tokenizer_path(), with_ids=True)
    check(docs, packed.collect(), plain)
    sequences = {r.sequence_id: r.ids for r in packed_sequences(packed).collect()}
    for r in packed.collect():
        assert sequences[r.sequence_id][r.offset:r.offset + r["length"]] == r.ids


def test_empty_table(odd):
    assert pack(odd([]), tokenizer_path()).count() == 0


def test_few_open_bins_still_pack():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 2049, 5000).tolist()
    for open_bins in (1, 16, 4096):
        bins, offsets = best_fit(sizes, 2048, open_bins)
        fill = {}
        for b, o, n in zip(bins, offsets, sizes):
            assert fill.get(b, 0) == o
            fill[b] = o + n
        assert max(fill.values()) <= 2048


@given(st.lists(st.integers(1, 50), max_size=80))
@settings(max_examples=60, deadline=None)
def test_best_fit_is_the_fullest_bin_that_fits(sizes):
    bins, _ = best_fit(sizes, 50, 1000)
    free: list[int] = []
    for size, got in zip(sizes, bins):
        fits = [f for f in free if f >= size]
        if fits:
            assert free[got] == min(fits)
        else:
            assert got == len(free)
            free.append(50)
        free[got] -= size


def test_cuts():
    assert cuts(5, 10) == [(0, 5)] and cuts(10, 10) == [(0, 10)] and cuts(20, 10) == [(0, 10), (10, 10)]
    assert cuts(21, 10) == [(0, 1), (1, 10), (11, 10)]


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_ids_are_the_librarys(text):
    t, fresh = encoder(tokenizer_path()), _fresh()
    assert t.ids(text) == fresh.encode(text, add_special_tokens=False).ids
    fresh.encode_special_tokens = True
    assert t.ids(text, special=False) == fresh.encode(text, add_special_tokens=False).ids


def _fresh():
    if not _FRESH:
        _FRESH.append(Tokenizer.from_file(tokenizer_path()))
    _FRESH[0].encode_special_tokens = False
    return _FRESH[0]


_FRESH: list = []


def test_special_strings_are_the_librarys_ids():
    assert encoder(tokenizer_path()).ids("a<|endoftext|>b") == [64, 50256, 65]
    assert encoder(tokenizer_path()).ids("a<|endoftext|>b", special=False) != [64, 50256, 65]


def test_the_bound_closes_the_fullest_bin():
    sizes = sorted(np.random.default_rng(2).integers(1, 2049, 8192).tolist(), reverse=True)
    least = -(-sum(sizes) // 2048)
    used = {b: max(best_fit(sizes, 2048, b)[0]) + 1 for b in (64, OPEN_BINS, 8192)}
    assert used[64] > used[OPEN_BINS] > used[8192] and used[OPEN_BINS] <= 1.2 * least
    bins, offsets = best_fit([1200, 1000, 900, 800], 2048, 2)
    assert bins == [0, 1, 1, 0] and offsets == [0, 0, 1000, 1200]
    assert best_fit([1200, 1100, 1000, 800, 900], 2048, 2)[0] == [0, 1, 2, 1, 2]  # the third size closes bin 0, the fullest
