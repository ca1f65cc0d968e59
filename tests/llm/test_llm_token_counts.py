import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from lotwise.llm import token_counts
from lotwise.llm.token_counts import count_batch, count_tokens, piece_table, tokenizer_path


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


def same(texts, library):
    n_bytes, n_tokens = count_batch(pa.array(texts, pa.string()), piece_table(tokenizer_path()))
    assert n_bytes.tolist() == [len((t or "").encode()) for t in texts]
    assert n_tokens.tolist() == [len(library.encode(t or "")) for t in texts]


def some_texts(n, seed=3):
    r = random.Random(seed)
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    pieces = [library.id_to_piece(i) for i in range(259, library.get_piece_size())]
    kinds = [
        lambda: "".join(r.choice(pieces).replace("▁", " ") for _ in range(r.randint(0, 12))),
        lambda: "".join(r.choice(pieces) for _ in range(r.randint(0, 12))),
        lambda: "".join(r.choice("   ▁ab<s>\x00é漢𝒳\n\t́") for _ in range(r.randint(0, 40))),
        lambda: "".join(chr(r.choice([r.randint(0, 0xd7ff), r.randint(0x10000, 0x10ffff)])) for _ in range(r.randint(0, 20))),
        lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(r.randint(0, 80))),
        lambda: r.choice(" ax▁=-") * r.randint(0, 400) + "".join(r.choice(pieces) for _ in range(5)),
    ]
    return [r.choice(kinds)() for _ in range(n)]


def test_like_the_library(library):
    same(some_texts(6000), library)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), min_size=1, max_size=5))
def test_any_unicode(texts):
    same(texts, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path()))


@pytest.mark.parametrize("name,value", [("LONG_RUN", 4), ("CHUNK_BYTES", 40)])
def test_one_by_one_and_cut_texts_agree(library, monkeypatch, name, value):
    monkeypatch.setattr(token_counts, name, value)
    same(some_texts(3000, seed=4), library)


def test_very_long_texts(library):
    r = random.Random(1)
    same([" " * 30_000, "x" * 100_000, "".join(r.choice("0123456789abcdef") for _ in range(100_000)), "word " * 600_000, "漢字" * 50_000,
          "= " * 50_000, None, ""], library)


def test_every_piece_alone(library):
    same([library.id_to_piece(i).replace("▁", " ") for i in range(library.get_piece_size())], library)


def test_ranks_of_all_runs_fall_together():
    table = piece_table(tokenizer_path())
    runs = [table.of_char[[ord(c) for c in w]] for w in ("hello", "a", "▁▁▁▁▁", "strengths")]
    offsets = np.cumsum([0, *map(len, runs)])
    together = table.tokens(np.concatenate(runs).copy(), offsets)
    assert together.tolist() == [int(table.tokens(r.copy(), np.array([0, len(r)]))[0]) for r in runs]


def test_documents(documents, library):
    rows = count_tokens(documents, tokenizer_path()).collect()
    assert len(rows) == documents.count()
    for r in rows:
        n = len(library.encode(r.text or ""))
        assert tuple(r.tokens) == (len((r.text or "").encode()), n, n > 4096)


def test_odd_rows(odd, library):
    docs = odd([(1, None, "en", "a"), (None, "", "en", None), (2, "ein Wort", "de", "a"), (2, "ein Wort", "de", "a"), (3, "a " * 9000, None, "b")],
               more="tokens string, n_tokens string, n_bytes string, over_limit string, size string")
    got = count_tokens(docs, tokenizer_path(), limit=3)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted((r.tokens.n_bytes, r.tokens.n_tokens, r.tokens.over_limit) for r in rows) == sorted(
        (len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 3) for t in ("", "", "ein Wort", "ein Wort", "a " * 9000))
    assert all(r.n_tokens == "x" and r.size == "x" for r in rows)
    assert count_tokens(odd([]), tokenizer_path(), out="found").count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(Exception):
        piece_table(tokenizer_path("byte_bpe_50k.json"))
