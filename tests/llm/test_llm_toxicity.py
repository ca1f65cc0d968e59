from pyspark.sql import functions as F

from lotwise.llm.toxicity import Model, features, fit, fold, held_out, score, weigh, _matched


def labels(spark, rows):
    return spark.createDataFrame([(i, 1, t, "x") for i, t in rows], "doc_id long, quality int, toxic int, text string")


def test_folding():
    assert fold("Ïd1οt") == " idiot "
    assert fold("mоrοn!! lo​ser, СLОWN") == " moron loser clown "  # Cyrillic and Greek letters among them
    assert fold("") == " " * 2 and fold("5tup1d") == " stupid " and fold("ＴＲＡＳＨ") == " trash "


def test_matches_weights_and_exceptions():
    model = Model({" trash ": 2.0, " idio": 1.5, " idiot ": 3.0})
    automaton = _matched(model)
    assert weigh("Trash and an idiot, idiomatic", automaton) == (2.0 + 3.0 + 1.5, 3, 5)
    assert weigh("the trash can is full", automaton)[1] == 0
    assert weigh("the trash can be trash", automaton)[1] == 1
    assert weigh(None, automaton) == weigh("", automaton) == (0.0, 0, 0) or weigh("", automaton)[:2] == (0.0, 0)
    assert features(2.0, 10) > features(2.0, 1000)


def test_held_out_accuracy(spark, sf_dir):
    at = sf_dir.replace("0.001", "0.1")
    docs, known = spark.read.parquet(at + "/documents.parquet"), spark.read.parquet(at + "/labels.parquet")
    out = score(docs.select("doc_id", "text"), fit(docs, known)).where(held_out(F.col("doc_id"))).join(known, "doc_id")
    said = F.col("toxicity.score") >= 0.5
    n, right, hits, toxic = out.agg(F.count("*"), F.sum((said == (F.col("toxic") == 1)).cast("int")),
                                    F.sum((said & (F.col("toxic") == 1)).cast("int")), F.sum("toxic")).first()
    assert n > 700 and right >= 0.97 * n and hits >= 0.85 * toxic


def test_labels_of_held_out_rows_are_not_used(spark, odd):
    docs = odd([(k, "zorgle " * 3 + "fine day number " + str(k) if k % 2 else "fine day number " + str(k), "en", "s") for k in range(200)])
    rows = [(r.doc_id, r.out) for r in docs.select("doc_id", held_out(F.col("doc_id")).alias("out")).collect()]
    first = fit(docs, labels(spark, [(i, int(i % 2)) for i, _ in rows]))
    second = fit(docs, labels(spark, [(i, 1 - int(i % 2) if out else int(i % 2)) for i, out in rows]))
    assert first == second


def test_odd_rows(spark, odd):
    docs = odd([(1, None, "en", "s"), (2, "", "en", "s"), (3, "you idiot, you moron", "en", "s"), (3, "you idiot, you moron", "en", "s"), (None, "nice", "en", "s"),
                (4, "idiot " * 50000, "en", "s"), (5, "a nice day", "en", "s")])
    for known in ([], [(3, None)], [(3, 1), (3, 0), (5, 0), (4, 1), (99, 1), (None, 1)]):
        model = fit(docs, labels(spark, known))
        out = score(docs, model)
        assert out.columns == docs.columns + ["toxicity"]
        got = {r.doc_id: r.toxicity.score for r in out.collect()}
        assert out.count() == 7 and all(0 <= s <= 1 for s in got.values())
        assert got[3] > got[5] and got[1] == got[2]
    assert score(odd([]), Model()).count() == 0
    assert score(odd([]), fit(odd([]), labels(spark, []))).count() == 0
