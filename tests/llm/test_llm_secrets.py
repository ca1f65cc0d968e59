import hashlib
import re

from lotwise.llm.secrets import digest, redact, scan

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
KEY = "Zx9fQ2mLw8RtY4uPb7Kd"


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(found)


def joined(found):
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in found)


def check(docs):
    rows, got = docs.collect(), digest(scan(docs)).collect()
    want = sorted((str(r.doc_id), hashlib.sha256(joined(base(r.text)).encode()).hexdigest(), *[sum(f[1] == k for f in base(r.text)) for k in range(3)]) for r in rows)
    assert sorted((str(r.doc_id), r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in got) == want
    for r in got:
        starts = [int(s.split(":")[1]) for s in r.spans.split(",") if s]
        assert starts == sorted(starts)
    return got


def test_real_documents(documents):
    check(documents)


TRICKY = [
    "password: secret: abcdefghij", "token = token=abcdefgh1", "Api-key apikey='12345678' API_KEY  =  \"a/b+c=d_e.f-\"", "secret=short secret=longenough",
    "AKIA AKIA12 AKIAABCDEFGHIJKL AKIAAKIAAKIAAKIAA", "f" * 31 + " " + "0" * 32 + "g" + "a" * 70, "éñ 漢字 \U0001f600 token=abcdefgh\U0001f600 passwd:hunter2222",
    "TOKEN=ABCDEFGH" * 3, "", None, "password\n=\nabcdefgh", "token==abcdefg", "ſecret=abcdefgh", "pass" * 5000 + "password=abcdefgh",
]


def test_tricky_texts(odd):
    check(odd([(i, t, "en", f"s{i % 3}") for i, t in enumerate(TRICKY)] + [(None, TRICKY[0], None, None), (3, TRICKY[3], "en", "s0")]))


def test_owners_tell_examples_from_live_keys(odd):
    rows = [(i, f"password={KEY} and token=aaaaaaaaaaaa", "en", f"owner{i % 4}") for i in range(12)] + [(20, "secret: q7Hs92LmZx04 " + KEY + "9Qa", "en", "owner1")]
    got = {r.doc_id: r for r in check(odd(rows))}
    assert got[0].n_live == 0 and got[0].n_example == 2
    assert got[20].n_live == 2 and got[20].n_example == 0 and "live:" in got[20].spans
    out = {r.doc_id: r for r in redact(odd(rows)).collect()}
    assert out[0].text == rows[0][1]
    assert out[20].text == "secret: [secret] [secret]" and out[20].n_chars == len(out[20].text)


def test_redact_keeps_rows_and_columns(odd):
    docs = odd([(1, None, "en", "a"), (1, "", "en", None), (2, "token=abcd1234efgh x", "en", "a"), (2, "token=abcd1234efgh x", "en", "a"), (None, "password=Q1w2e3r4t5", "en", "b")])
    out = redact(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.text) for r in out.collect()) == ["", "None", "password=[secret]", "token=[secret] x", "token=[secret] x"]


def test_empty_table(odd):
    assert scan(odd([])).count() == 0 and redact(odd([])).count() == 0
