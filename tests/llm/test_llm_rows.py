from lotwise.llm.rows import BATCH_ROWS, content_key, hash_sample, of, packed, small_batches, unpacked
from pyspark.sql import functions as F


def test_clashing_names_and_any_types(spark):
    docs = spark.createDataFrame([(1, "ab", "s", {"a": 1}, "x", 2), (None, None, None, None, None, None)],
                                 "doc_id long, text string, source string, row map<string,int>, `a.b` string, n_chars int")
    rows = packed(docs).withColumns({"key": content_key(docs), "text": F.lit("own")})
    out = unpacked(rows, docs, {"text": F.concat(of("text"), F.lit("c")), "more": F.lit(1)})
    assert out.columns == [*docs.columns, "more"]
    assert sorted(map(str, out.collect())) == sorted(map(str, spark.createDataFrame(
        [(1, "abc", "s", {"a": 1}, "x", 3, 1), (None, None, None, None, None, None, 1)], "doc_id long, text string, source string, row map<string,int>, `a.b` string, n_chars int, more int").collect()))
    assert rows.where("key is null").count() == 0


def test_sample_is_the_same_under_any_partitioning(spark):
    rows = spark.range(20_000)
    first = [r.id for r in hash_sample(rows, 500, "id").collect()]
    assert len(set(first)) == 500 and first == [r.id for r in hash_sample(rows.repartition(7), 500, "id").collect()]
    assert hash_sample(rows.limit(30), 500, "id").count() == 30 and hash_sample(rows.limit(0), 5, "id").count() == 0


def test_batches_are_only_made_smaller(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for before, after in (("10000", BATCH_ROWS), ("0", BATCH_ROWS), ("10", 10)):
        spark.conf.set(name, before)
        small_batches(spark)
        assert int(spark.conf.get(name)) == after
    spark.conf.set(name, BATCH_ROWS)
