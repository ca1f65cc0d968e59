import math
import os
import re
import shutil
import subprocess
import sys

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as P
from lotwise.llm import toxicity
from lotwise.llm.packing import tokenizer_path
from test_llm_mixing import WORD, targets
from test_llm_ngram_join import brute
from test_llm_secrets import ACCESS, ASSIGN, HEX

ROOT = os.path.dirname(os.path.abspath(P.__file__))
NAMES = ["op1_", "op2_", "op3_", "op4_", "op5_", "op6_", "op7_", "op8_", "op9_", "op10_"]


def test_one_query_for_each_operator():
    names = list(entry.queries())
    assert [sum(n.startswith(p) for n in names) for p in NAMES] == [1] * 10 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name, columns", [
    ("op1", "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint"), ("op2", "query_id:bigint rank:int vec_id:bigint score:double"),
    ("op3", "vec_id:bigint n_links:bigint component_id:bigint kept:boolean"), ("op4", "doc_id:bigint n_assign:bigint n_access:bigint n_hex:bigint base_sha256:string spans:string"),
    ("op5", "doc_id:bigint held_out:boolean score:double predicted:int"),
    ("op6", "doc_id:bigint n_words:bigint n_base:bigint first_word:bigint last_word:bigint base_labels:string labels:string score:double"),
    ("op7", "doc_id:bigint text:string"), ("op8", "doc_id:bigint held_out:boolean lang_pred:string score:double"),
    ("op9", "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint"), ("op10", "doc_id:bigint n_shingles:bigint component_id:bigint"),
])
def test_queries_return_the_agreed_columns(spark, sf_dir, name, columns):
    query = next(q for n, q in entry.queries().items() if n.startswith(name + "_"))
    got = dict(query(spark, sf_dir).dtypes)
    for c in columns.split():
        column, kind = c.split(":")
        assert got[column] == kind


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The rows that enter each stage, and the last stage's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(P.materialize(stage(spark, out[-1], sf_dir), f"test_{name}"))
    return out


def test_stages_keep_the_columns(steps):
    assert [name for name, _ in P.STAGES] == ["toxicity", "ngram_join", "secrets", "mixing", "packing"]
    assert all(s.dtypes == steps[0].dtypes for s in steps[:-1])


def test_toxic_documents_go(spark, sf_dir, steps):
    model = toxicity.fit(steps[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    automaton = model.automaton()
    want = []
    for r in steps[0].collect():
        total, _, words = toxicity.weigh(r.text, automaton)
        x, y = toxicity.features(total, words)
        a, b, c = model.curve
        if 1 / (1 + math.exp(-(a + b * x + c * y))) < 0.5:
            want.append(tuple(r))
    assert sorted(map(tuple, steps[1].collect())) == sorted(want) and 0 < len(want) < steps[0].count()


def test_one_document_of_each_group_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted({int(c) for _, _, c in brute(rows)})


def test_live_secrets_are_masked(steps):
    before, after = {r.doc_id: r for r in steps[2].collect()}, {r.doc_id: r for r in steps[3].collect()}
    owners: dict = {}
    found = {}
    for i, r in before.items():
        spans = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(r.text) if len(m[2]) >= 8]
        spans += [m.span() for p, n in ((ACCESS, 16), (HEX, 32)) for m in p.finditer(r.text) if len(m[0]) >= n]
        found[i] = sorted(spans)
        for a, b in spans:
            owners.setdefault(r.text[a:b], set()).add(r.source)
    assert set(before) == set(after)
    for i, r in before.items():
        out, at = "", 0
        for a, b in found[i]:
            value = r.text[a:b]
            if len(owners[value]) < 3 and len(set(value)) / min(len(value), 32) >= 0.3:
                if a >= at:
                    out += r.text[at:a] + "[secret]"
                at = max(at, b)
        assert after[i].text == out + r.text[at:] and after[i].n_chars == len(after[i].text)


def test_mix_meets_its_targets(steps):
    size, taken, per = {}, {}, {}
    for r in steps[3].collect():
        size[r.source] = size.get(r.source, 0) + len(WORD.findall(r.text))
        per[r.doc_id] = len(WORD.findall(r.text))
    got: dict = {}
    for r in steps[4].collect():
        n = len(WORD.findall(r.text))
        taken[r.source] = taken.get(r.source, 0) + n
        got[r.doc_id] = got.get(r.doc_id, 0) + n
    for s, target in targets(size).items():
        assert abs(taken.get(s, 0) - target) <= 0.51
    assert all(n <= 2 * per[i] for i, n in got.items())


def test_sequences_hold_all_ids(steps):
    plain = Tokenizer.from_file(tokenizer_path())
    plain.encode_special_tokens = True
    want = sum(len(plain.encode(r.text, add_special_tokens=False).ids) + 1 for r in steps[4].collect())
    rows = steps[5].collect()
    assert sum(r["length"] for r in rows) == want
    assert len({r.sequence_id for r in rows}) <= want / 2048 * 1.02 + 1
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    assert all(sum(n for _, n in parts) <= 2048 and sorted(parts)[0][0] == 0 for parts in by.values())


def test_run_is_the_stages_in_turn(spark, sf_dir, steps):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = lambda df: sorted(map(tuple, df.select(*names).collect()))
    assert rows(P.run(spark, sf_dir)) == rows(steps[-1])


def test_stages_of_odd_documents(spark, sf_dir, odd):
    docs = odd([(1, None, None, None), (2, "", "en", "s"), (2, "", "en", "s"), (None, "only one here", "en", None), (4, "x " * 30000, "en", "s"), (5, "password=Q1w2e3r4t5y6", "en", "t")])
    for rows in (docs, docs.limit(0)):
        for name, stage in P.STAGES:
            out = P.materialize(stage(spark, rows, sf_dir), f"odd_{name}")
            assert name == "packing" or out.columns == docs.columns
            rows = out
        assert rows.columns[0] == "doc_id"


def test_the_rest_works_without_these_folders(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(re.match('op[0-9]', n) for n in q), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", "import re; " + code], cwd=tmp_path / "repo", capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    n, any_op, _ = done.stdout.split()
    assert int(n) > 90 and any_op == "False"
    assert not [f for f in (tmp_path / "repo").rglob("*.py") if f.name != "__spark_entry__.py" and re.search(r"\bllm\b", f.read_text())]
