import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lotwise.llm import alignment
from lotwise.llm.alignment import Aligned, Pair, align, gallop, packed_entries, tokenizer_paths, unpacked_entries


@pytest.fixture(scope="module")
def two():
    return Pair(*tokenizer_paths())


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokenizer_paths()[0])
    t.encode_special_tokens = True
    return t


def by_ranges(two, plain, text):
    """(a, b, links, groups) by comparing every token of A with every one of B."""
    if not text:
        return [], [], [], []
    a, b = plain.encode(" " + text, add_special_tokens=False).ids, two.b.encode(text)
    if b"".join(two.bytes_a[i] for i in a) != (" " + text).encode() or b"".join(two.bytes_b[i] for i in b) != (" " + text).encode():
        return [], [], [], []
    ends_a, ends_b = (np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in ((two.bytes_a, a), (two.bytes_b, b)))
    spans_a, spans_b = ([*zip([0, *e], e)] for e in (ends_a, ends_b))
    links = [(i, j) for i, (s, e) in zip(a, spans_a) for j, (t, f) in zip(b, spans_b) if s < f and t < e]
    groups, low = [], 0
    for cut in sorted({*ends_a} & {*ends_b}):
        groups.append(tuple(",".join(str(i) for i, e in zip(ids, ends) if low < e <= cut) for ids, ends in ((a, ends_a), (b, ends_b))))
        low = cut
    return a, b, links, groups


def whole(two, plain, rows):
    """What align() has to give for (doc_id, text) rows."""
    found = [(i, *by_ranges(two, plain, t)) for i, t in rows]
    held = Counter(p for f in found for p in set(f[3]))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(n, best.get(a, 0))
    out = []
    for i, a, b, links, groups in found:
        text = ";".join("|".join(g) for g in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=repr), held


def results(docs):
    return sorted((tuple(r)[:8] for r in align(docs, *tokenizer_paths()).documents().collect()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 200), min_size=1), st.sets(st.integers(1, 200), min_size=1), st.data())
def test_gallop_is_a_binary_search(one, two, data):
    long = np.array(sorted(one | {201}))
    short = np.array(sorted(two | {201}))
    finger = np.array([data.draw(st.integers(0, len(long) - 1)) for _ in short])
    assert gallop(short, long, finger).tolist() == np.searchsorted(long, short).tolist()


def test_links_and_groups_like_ranges(two, plain):
    r = random.Random(1)
    words = ["hello", "wörld", " ", "漢字", "𝒳", "<|endoftext|>", "<s>", "123", "\n", "unbelievable", "  ", "\x00", "▁", "é"]
    texts = ["".join(r.choice(words) for _ in range(r.randint(1, 15))) for _ in range(300)]
    want = [by_ranges(two, plain, t) for t in texts]
    ids = [two.ids(t) for t in texts]
    assert [(a, b) for a, b, _, _ in want] == [(list(a), list(b)) for a, b in ids]
    assert any(not w[0] for w in want)
    used = [k for k, w in enumerate(want) if w[0]]
    got = Aligned([ids[k][0] for k in used], [ids[k][1] for k in used], two.length_a, two.length_b)
    groups = list(got.groups(two.shown, len(two.bytes_a)))
    for place, k in enumerate(used):
        own = got.link_text == place
        assert sorted(zip(got.ids[0][got.links_a[own]].tolist(), got.ids[1][got.links_b[own]].tolist())) == sorted(want[k][2])
        assert groups[place] == ";".join("|".join(g) for g in want[k][3])
        assert (got.n_links[place], got.n_groups[place]) == (len(want[k][2]), len(want[k][3]))


def test_either_list_drives(two):
    for a, b in (([5, 6, 7], [9]), ([5], [9, 9, 9])):
        size = np.zeros(10, dtype=np.int64)
        size[[5, 6, 7]], size[9] = (1, 3) if len(a) == 3 else (3, 1)
        got = Aligned([a], [b], size, size)
        assert got.n_links.tolist() == [3] and got.n_groups.tolist() == [1]


@given(st.dictionaries(st.integers(0, 2**31 - 2), st.integers(1, 10**6), max_size=30))
def test_entries_come_back(entries):
    places = np.array(sorted(entries), dtype=np.int64)
    times = np.array([entries[p] for p in sorted(entries)], dtype=np.int64)
    back = unpacked_entries(packed_entries(places, times))
    assert back[0].tolist() == places.tolist() and back[1].tolist() == times.tolist()


def test_documents(documents, two, plain):
    docs = documents.where("text is null or length(text) < 4000")  # brute force compares all tokens of a text
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(rows) > 100 and results(docs) == whole(two, plain, rows)[0]


def test_counts_over_many_blocks(spark, documents, two, plain, monkeypatch):
    few = documents.where("length(text) < 2000").limit(120)
    rows = [(r.doc_id, r.text) for r in few.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = alignment.align(docs, *tokenizer_paths(), with_groups=True)
    assert got.parts.select("block").distinct().count() > 3
    want, held = whole(two, plain, rows)
    assert sorted((tuple(r)[:8] for r in got.documents().collect()), key=repr) == want
    assert {(r.a, r.b): r.n for r in got.pair_counts().collect()} == held
    for r in got.documents().collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")


def test_odd_rows(odd, two, plain):
    rows = [(1, None, "en", "a"), (2, "", "en", None), (None, "no id", "en", "a"), (3, "twice", None, "a"), (3, "twice", None, "a"), (4, "▁ blank", "en", "b"),
            (5, "a<|endoftext|><s>b" + " word" * 300, "en", "b")]
    docs = odd(rows, more="block string, pair string, entries string, n string, held string, groups string")
    assert results(docs) == whole(two, plain, [r[:2] for r in rows])[0]
    assert results(odd([])) == []


def test_long_texts(odd, two, plain):
    text = "wörd 漢字 " * 40_000 + " " * 3000 + "x" * 3000
    (row,) = align(odd([(1, text, "en", "a")]), *tokenizer_paths()).documents().collect()
    a, b = plain.encode(" " + text, add_special_tokens=False).ids, two.b.encode(text)
    ends = [set(np.cumsum([len(t[i]) for i in ids]).tolist()) for t, ids in ((two.bytes_a, a), (two.bytes_b, b))]
    assert (row.n_a, row.n_b, row.n_groups) == (len(a), len(b), len(ends[0] & ends[1]))
    assert row.n_links == len(a) + len(b) - row.n_groups == row.count_sum
