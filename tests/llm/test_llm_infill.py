import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lotwise.llm.infill import SCAN_BYTES, draws, fill_in_middle, restore, restored, rotate, scan, transform

TEXT = st.text(alphabet="aé漢𝒳<PSM> ́\x00", max_size=30)


def by_slices(text, doc_id):
    """The form by plain string slices."""
    h1, h2, h3, h4 = draws(doc_id)
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, post = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{post}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{post}<M>{mid}"


@settings(max_examples=500, deadline=None)
@given(TEXT, st.integers(0, 10_000))
def test_like_slices_and_back(text, doc_id):
    n, form, a, b, output = transform(text.encode(), doc_id)
    assert (n, form, a, b, output.decode()) == by_slices(text, doc_id)
    assert restored(output, form).decode() == text


@given(st.binary(max_size=40), st.data())
def test_rotation_and_its_inverse(data, choose):
    low, middle, high = sorted(choose.draw(st.integers(0, len(data))) for _ in range(3))
    work = bytearray(data)
    rotate(work, low, middle, high)
    assert bytes(work) == data[:low] + data[middle:high] + data[low:middle] + data[high:]
    rotate(work, low, low + high - middle, high)
    assert bytes(work) == data


def test_cuts_across_scan_blocks():
    import numpy as np

    text = "aé漢𝒳" * (SCAN_BYTES // 4)
    view = np.frombuffer(text.encode(), dtype=np.uint8)
    cuts = (0, 5, len(text) // 2 + 1, len(text) - 1, len(text))
    assert scan(view, cuts) == [len(text[:c].encode()) for c in cuts]


def test_every_form_occurs_in_documents(spark, documents):
    rows = fill_in_middle(documents).withColumn("back", restore(F.col("fim.output"), F.col("fim.form"))).collect()
    assert {r.fim.form for r in rows} == {"plain", "psm", "spm"} and len(rows) == documents.count()
    for r in rows:
        assert tuple(r.fim) == by_slices(r.text or "", r.doc_id) and r.back == (r.text or "")


def test_odd_rows(odd):
    long = "wörd 漢 " * 200_000
    docs = odd([(1, None, "en", "a"), (2, "", "en", None), (None, "abc", None, None), (3, long, "en", "a"), (3, long, "en", "a"), (4, "a<P>b", "en", "a"), (5, "a<P", "en", "b")],
               more="key string, fim string, output string, form string, n string, `a.b` string")
    got = fill_in_middle(docs).withColumn("back", restore(F.col("fim.output"), F.col("fim.form")))
    assert got.columns == [*docs.columns, "back"] and dict(got.dtypes)["key"] == "string"
    rows = got.collect()
    assert len(rows) == 7 and all(r.back == (r.text or "") and r.key == "x" for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[k].fim.form for k in (1, 2, 4)] == ["plain"] * 3 and by_id[1].fim.n == 0 and by_id[1].fim.prefix_chars is None
    assert by_id[3].fim.n == len(long) and len({r.fim.output for r in rows if r.doc_id == 3}) == 1
    assert fill_in_middle(odd([])).count() == 0


def test_rates_and_sentinels(odd):
    docs = odd([(i, "some text here", "en", "a") for i in range(60)])
    assert {r.fim.form for r in fill_in_middle(docs, fim_percent=0).collect()} == {"plain"}
    rows = fill_in_middle(docs, fim_percent=100, spm_percent=100, sentinels=("[pre]", "[suf]", "[mid]")).collect()
    assert all(r.fim.form == "spm" and r.fim.output.startswith("[suf]") for r in rows)
    for wrong in (("<P>", "<P>", "<M>"), ("ab", "ba", "c"), ("a", "xay", "c"), ("", "b", "c"), ("aa", "b", "c")):
        with pytest.raises(ValueError):
            fill_in_middle(docs, sentinels=wrong)


def test_sha256_draws():
    assert draws(7)[0] == int(hashlib.sha256(b"1:7").hexdigest()[:8], 16)
