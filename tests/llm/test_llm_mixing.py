import re

import pytest

from lotwise.llm.mixing import mix, permuted
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Sharing out again and again, as the contract says it."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    full: set = set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        part = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if part[s] > 2 * sizes[s]}
        if not over:
            return part | {s: 2.0 * sizes[s] for s in full}
        full |= over


def check(docs, mixed):
    rows = docs.collect()
    out = mixed.taken().collect()
    size = {}
    for r in rows:
        size[r.source] = size.get(r.source, 0) + len(WORD.findall(r.text or ""))
    want = targets(size) if size else {}
    assert sorted((str(r.doc_id), r["size"]) for r in out) == sorted((str(r.doc_id), len(WORD.findall(r.text or ""))) for r in rows)
    taken = {}
    for r in out:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= 0.51
    return sorted(map(str, out))


def test_real_documents_and_reruns(documents):
    first = check(documents, mix(documents))
    assert first == sorted(map(str, mix(documents.repartition(5)).taken().collect()))
    other = mix(documents, block_words=16, seed=3)
    assert check(documents, other) != first


def test_odd_rows(odd):
    rows = [(1, "a b c d e f g", "en", "s1"), (1, "a b c d e f g", "en", "s1"), (None, "x  y\tz", "en", None), (3, None, "en", "s1"),
            (4, "", "en", "s2"), (5, " \n ", "en", None), (6, "é ñ " * 40, "es", "S"), (7, "one", "en", "\U0001f600"), (8, "w " * 900, "en", "￿")]
    docs = odd(rows)
    mixed = mix(docs, block_words=8)
    check(docs, mixed)
    words = {}
    out = mixed.documents()
    assert out.columns == docs.columns
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORD.findall(r.text))
        assert r.n_chars == len(r.text) and r.text
    taken = {}
    for r in mixed.taken().collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    assert words == {k: v for k, v in taken.items() if v}


def test_empty_table(odd):
    mixed = mix(odd([]))
    assert mixed.taken().count() == 0 and mixed.documents().count() == 0


def test_shards_hold_all_sources(documents):
    draws = mix(documents, block_words=4, shard_slots=500).draws()
    slots = draws.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("source_key").alias("s")).orderBy("shard").collect()
    assert all(r.n == 500 and r.s >= 15 for r in slots[:-1])
    assert draws.select("slot").distinct().count() == draws.count() == draws.agg(F.max("slot")).first()[0] + 1


@pytest.mark.parametrize("n", [1, 2, 3, 7, 48, 1000])
def test_permutation_and_its_inverse(spark, n):
    rows = permuted(spark.range(n), "p", F.col("id"), F.lit(n).cast("long"), F.lit(5))
    back = permuted(rows, "q", F.col("p"), F.lit(n).cast("long"), F.lit(5), back=True).collect()
    assert sorted(r.p for r in back) == list(range(n)) and all(r.q == r.id for r in back)
