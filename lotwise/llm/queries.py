"""The registered queries of the operators, one for each, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.sources.tables import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).taken().select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.nearest import nearest

    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, F.col("vec_id") % 100 == 0)


def op3_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.vector_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.secrets import digest, scan

    return digest(scan(table(spark, sf_dir, "documents")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.toxicity import fit, held_out, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "toxicity.score", "toxicity.matches")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "matches")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.licenses import scan

    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return out.select("doc_id", *[f"licence.{n}" for n in names])


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.pii import pseudonymize

    out = pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), key="lotwise")
    count = lambda kind: F.size(F.filter("entities", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return out.select("doc_id", "text", *[count(k) for k in ("email", "phone", "ip", "card", "account", "ssn", "iban")],
                      F.array_join(F.transform("entities", one), ",").alias("spans"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.langid import fit, held_out, identify

    docs = table(spark, sf_dir, "documents")
    out = identify(docs.select("doc_id", "text"), fit(docs), with_spans=False)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"),
                      "language.score", "language.n_spans")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.packing import pack, tokenizer_path

    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.ngram_join import similar_groups

    return similar_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.alignment import align, tokenizer_paths

    return align(table(spark, sf_dir, "documents"), *tokenizer_paths()).documents().drop("groups")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.infill import fill_in_middle, restore

    fim = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = restore(F.col("fim.output"), F.col("fim.form"))
    return fim.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
                      F.sha2("fim.output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotwise.llm.token_counts import count_tokens, tokenizer_path

    out = count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return out.select("doc_id", "tokens.n_bytes", "tokens.n_tokens", "tokens.over_limit")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_nearest": op2_nearest,
    "op3_vector_dedup": op3_vector_dedup,
    "op4_secrets": op4_secrets,
    "op5_toxicity": op5_toxicity,
    "op6_licenses": op6_licenses,
    "op7_pii": op7_pii,
    "op8_language": op8_language,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_ngram_join": op10_ngram_join,
    "op11_alignment": op11_alignment,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_token_counts": op13_token_counts,
}
_COMPONENTS = """reach(id, root) AS (SELECT id, id FROM nodes UNION SELECT r.id, e.b FROM reach r JOIN edges e ON e.a = r.root)"""

SQL: dict[str, str] = {
    # all pairs of a label
    "op3_vector_dedup": f"""WITH RECURSIVE nodes AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v,
    label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable FROM embeddings),
edges AS (SELECT x.id AS a, y.id AS b FROM nodes x JOIN nodes y ON x.label = y.label AND x.id <> y.id AND x.usable AND y.usable
  AND list_cosine_similarity(x.v, y.v) >= 0.93),
{_COMPONENTS},
least AS (SELECT id, min(root) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a AS id, count(*) AS n FROM edges GROUP BY 1)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept FROM least LEFT JOIN counts USING (id)""",
    # all pairs of documents that share a shingle
    "op10_ngram_join": rf"""WITH RECURSIVE words AS (SELECT doc_id AS id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda x: x <> '') AS w FROM documents),
grams AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
nodes AS (SELECT id, count(g) AS n FROM words LEFT JOIN grams USING (id) GROUP BY 1),
shared AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM grams x JOIN grams y ON x.g = y.g AND x.id <> y.id GROUP BY 1, 2),
edges AS (SELECT a, b FROM shared JOIN nodes p ON p.id = a JOIN nodes q ON q.id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
{_COMPONENTS}
SELECT id AS doc_id, n AS n_shingles, min(root) AS component_id FROM reach JOIN nodes USING (id) GROUP BY 1, 2""",
    "op12_fill_in_middle": """WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
draws AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM docs),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM draws),
parts AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS post FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || post || '<M>' || mid
    ELSE '<S>' || post || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM parts""",
}
