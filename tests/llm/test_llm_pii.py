import re

import pytest
from pyspark.sql import functions as F

from lotwise.llm.pii import IP, _surrogate, luhn_sum, pseudonymize, surrogates
from lotwise.sources.scratch import materialize


def test_formats_scripts_and_coreference(odd):
    docs = odd([
        (1, "Mr. John Smith and Mrs. Anna Smith, j.smith@acme.com, +1 (386) 555-3733", "en", "s"),
        (2, "J.SMITH@ACME.COM or +1 386 555 3733; Dr. SMITH at 10.2.3.4, not 999.1.2.3", "en", "s"),
        (3, "4041894974608795, 4041 8949 7460 8795, 4041894974608796; 123-45-6789; DE89 3704 0044 0532 0130 00", "en", "s"),
        (4, "г-н Иван Петров и г-жа Анна Петрова", "ru", "s"), (5, None, "en", "s"), (6, "", "en", None), (7, "12 of 34, Mr. no", "en", "s"),
        (1, "Mr. John Smith and Mrs. Anna Smith, j.smith@acme.com, +1 (386) 555-3733", "en", "s"), (None, "a.b@c.org", "en", "s"), (8, "x 1.2.3.4 " * 3000, "en", "s"),
    ])
    out = pseudonymize(docs, "key")
    assert out.columns == docs.columns + ["entities"] and out.count() == 10
    got = {r.doc_id: r for r in out.collect()}
    one = re.fullmatch(r"Mr\. (\w+) (\w+) and Mrs\. (\w+) (\w+), ([a-z])\.([a-z]{5})@([a-z]{8})\.com, (\+1 \(\d{3}\) \d{3}-\d{4})", got[1].text)
    assert one and one[2] == one[4] != "Smith" and one[1] != one[3]
    mail = got[1].text.split(", ")[1]
    two = got[2].text
    assert two.startswith(mail.upper()) and one[2].upper() in two and "999.1.2.3" in two and "10.2.3.4," not in two
    assert re.sub(r"\D", "", two.split("or ")[1].split(";")[0]) == re.sub(r"\D", "", one[8])
    a, b, c = got[3].text.split(";")[0].split(", ")
    assert b.replace(" ", "") == a != "4041894974608795" and re.fullmatch(r"\d{4}( \d{4}){3}", b) and re.fullmatch(r"\d{16}", c) and c != "4041894974608796"
    assert re.fullmatch(r" 9\d\d-\d\d-\d{4}; DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d", got[3].text[got[3].text.index(";") + 1:])
    assert re.fullmatch(r"г-н [А-Я][а-я]+ [А-Я][а-я]+ и г-жа [А-Я][а-я]+а [А-Я][а-я]+", got[4].text) or "г-жа" in got[4].text
    assert got[5].text is None and got[6].text == "" and got[7].text == "12 of 34, Mr. no" and got[7].entities == []
    assert len(got[8].entities) == 3000 and len(set(re.findall(r"[\d.]{7,}", got[8].text))) == 1
    assert all(r.n_chars == len(r.text) for r in got.values() if r.text is not None)
    assert out.collect() == pseudonymize(docs, "key").collect()
    assert got[1].text != {r.doc_id: r for r in pseudonymize(docs, "other").collect()}[1].text
    assert pseudonymize(odd([]), "key").count() == 0


def test_surrogates_stay_distinct_in_small_spaces(spark):
    """More family names and short mail names than the lists and one letter allow at the first try."""
    forms = [("family", f"name{k}") for k in range(300)] + [("given_m", f"given{k}") for k in range(80)] + [("given_x", f"given{k}") for k in range(80)]
    forms += [("email", f"{c}@x.com") for c in "abcdefghijklmnopqrstuvwxyz"] + [("ip", f"10.0.{k}.{k}") for k in range(200)] + [("family", "turner"), ("family", "quinn")]
    rows = surrogates(spark.createDataFrame(forms, "kind string, norm string"), "k").collect()
    assert sorted((r.kind, r.norm) for r in rows) == sorted(forms)
    for family in ("family", "given", "email", "ip"):
        own = [r for r in rows if r.kind.startswith(family)]
        made = [r.surrogate for r in own]
        assert len(set(made)) == len(made) and not set(made) & {r.norm for r in own} and None not in made


@pytest.mark.parametrize("number, good", [("4041894974608795", True), ("4041894974608796", False), ("79927398713", True)])
def test_luhn(spark, number, good):
    assert (spark.range(1).select(luhn_sum(F.lit(number))).first()[0] % 10 == 0) == good


def test_real_documents_keep_no_entity(documents):
    found = re.compile(r"[\w.+-]+@[\w.-]+\w|(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w])|(?<!\w)\d{16}(?!\w)|\+1 \(\d{3}\) \d{3}-\d{4}")
    out = {r.doc_id: r.text for r in pseudonymize(documents, "k").collect()}
    mentions, pairs = 0, {}
    for r in documents.collect():
        old, new = found.findall(r.text), found.findall(out[r.doc_id])
        assert len(old) == len(new)
        mentions += len(old)
        for a, b in zip(old, new):
            assert pairs.setdefault(a, b) == b != a
    assert mentions > 10 and len(set(pairs.values())) == len(pairs)


def test_names_are_replaced_where_they_stand_without_title(odd):
    texts = ["Mr. John Smith called. Smith said JOHN's and Smith’s smith, Smithson, Smith@acme.com",
             "Smith waits for Prof. Smith's son", "г-жа Анна Петрова: Петрова и Анна", "Smith and John"]
    out = {r.doc_id: r for r in pseudonymize(odd([(i, t, "en", "s") for i, t in enumerate(texts)]), "key").collect()}
    one = re.fullmatch(r"Mr\. (\w+) (\w+) called\. (\w+) said (\w+)'s and (\w+)’s smith, Smithson, ([a-zA-Z]{5})@\w+\.com", out[0].text)
    assert one and one[2] == one[3] == one[5] and one[4] == one[1].upper() and not {"John", "Smith"} & set(one.groups())
    assert out[1].text == f"{one[2]} waits for Prof. {one[2]}'s son"
    two = re.fullmatch(r"г-жа (\w+) (\w+): (\w+) и (\w+)", out[2].text)
    assert two and two[2] == two[3] != "Петрова" and two[1] == two[4] != "Анна"
    assert [texts[0][e.start:e.end] for e in out[0].entities] == ["John", "Smith", "Smith", "JOHN", "Smith", "Smith@acme.com"]
    assert out[3].text == texts[3]


def test_addresses_have_more_room_on_later_tries(spark):
    forms = spark.range(2000).select(F.concat(F.lit("1.2.3."), F.col("id")).alias("norm"))
    made = [[r[0] for r in forms.select(_surrogate("k", F.lit("ip"), F.col("norm"), F.lit(k))).collect()] for k in (0, 1, 2)]
    assert {a.split(".")[0] for a in made[0]} == {"10"}
    for again in made[1:]:
        assert {int(a.split(".")[0]) for a in again} == set(range(240, 255))
        assert all(re.fullmatch(IP, a) for a in again)


def test_names_of_one_surrogate_are_combined_before_the_shuffle(spark, monkeypatch):
    plans = []
    monkeypatch.setattr("lotwise.llm.pii.materialize", lambda d, name: (plans.append(d._jdf.queryExecution().executedPlan().toString()), materialize(d, name))[1])
    forms = spark.createDataFrame([("family", f"name{k}") for k in range(50)], "kind string, norm string")
    assert surrogates(forms, "k").count() == 50
    assert plans and not any("Window" in p for p in plans)
