import itertools

import numpy as np
from pyspark.sql import functions as F

from lotwise.llm.langid import Model, decode, fit, held_out, identify, label_texts, words_of


def test_decode_is_the_best_of_all_labelings():
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = rng.integers(1, 7, 5)
        scores = rng.normal(size=(sizes.sum(), 3)) * 4
        got, at = decode(scores, sizes, penalty=3.0), 0
        for n in sizes:
            part = scores[at:at + n]
            value = lambda path: sum(part[k, c] for k, c in enumerate(path)) - 3.0 * sum(a != b for a, b in zip(path, path[1:]))  # noqa: B023, E731
            best = max(value(p) for p in itertools.product(range(3), repeat=int(n)))
            assert abs(value(got[at:at + n].tolist()) - best) < 1e-9
            at += n
    assert len(decode(np.zeros((0, 3)), np.zeros(0, dtype=int))) == 0


def test_words_and_their_places():
    texts = ["Äb c1d", "", "\0", "x\0yz", "漢字 ok"]
    words = words_of(texts)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    found = [texts[k][s - begin[k]:e - begin[k]] for k, s, e in zip(words.text, words.start, words.end)]
    assert found == ["Äb", "c", "d", "x", "yz", "漢字", "ok"]
    assert np.array_equal(words_of(["ÄB"]).slots, words_of(["äb"]).slots)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")
    out = identify(docs, fit(docs), with_spans=False).where(held_out(F.col("doc_id")))
    n, right = out.agg(F.count("*"), F.sum((F.col("language.lang") == F.col("lang")).cast("int"))).first()
    assert n > 150 and right >= 0.97 * n


def test_spans_of_mixed_texts_and_scripts(spark, odd):
    en, es = "the thing that they thought with this other", "la ciudad donde los niños corrieron hacia una montaña"
    ru = "мой дядя самых честных правил когда не в шутку занемог"
    train = odd([(k, t, lang, "s") for k in range(60) for t, lang in ((en, "en"), (es, "es"), (ru, "ru"), (None, "en"), (en, None))])
    model = fit(train)
    assert model.languages == ["en", "es", "ru"]
    mixed = f"{en}. {es}! {ru}"
    docs = odd([(1, mixed, None, "s"), (2, None, "en", "s"), (3, "", "en", "s"), (4, "123 !?", "en", "s"), (1, mixed, None, "s"), (5, (es + " ") * 9000, "x", "s")])
    out = {r.doc_id: r.language for r in identify(docs, model).collect()}
    assert [(s.lang, mixed[s.start:s.end]) for s in out[1].spans] == [("en", en), ("es", es), ("ru", ru)]
    assert out[1].n_spans == 3 and 0 < out[1].score < 1
    assert all((out[k].lang, out[k].score, out[k].n_spans) == ("und", 0.0, 0) for k in (2, 3, 4))
    assert (out[5].lang, out[5].score) == ("es", 1.0)
    assert identify(docs, model).columns == docs.columns + ["language"]


def test_stretches_agree_with_one_run_inside_a_language():
    model = Model(["a", "b"], np.log(np.tile([[0.6, 0.4]], (1 << 16, 1))).astype(np.float32), np.ones((20, 2), dtype=bool))
    whole, parts = label_texts(["w " * 500], model, True, stretch=10 ** 6), label_texts(["w " * 500], model, True, stretch=7)
    assert whole == parts and whole[0][0] == "a"


def test_nothing_to_learn_from(odd):
    model = fit(odd([(1, None, "en", "s"), (2, "text", None, "s"), (None, "text", "en", "s")]))
    assert model.languages == []
    assert [r.language.lang for r in identify(odd([(1, "text", "en", "s")]), model).collect()] == ["und"]
    assert identify(odd([]), model).count() == 0
