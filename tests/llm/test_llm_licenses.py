import random
import re

from lotwise.llm.license_texts import PHRASES, TEMPLATES
from lotwise.llm.licenses import Automaton, Scanner, scan, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def test_matching_statistics_are_the_longest_suffixes():
    rng = random.Random(2)
    for _ in range(40):
        lists = [[rng.randrange(1, 4) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
        a = Automaton()
        for k, words in enumerate(lists):
            a.add(k, words)
        a.finish([])
        subs = {tuple(w[i:j]) for w in lists for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        text = [rng.randrange(1, 5) for _ in range(30)]
        state = length = 0
        for at, word in enumerate(text):
            while state and word not in a.step[state]:
                state = a.link[state]
                length = a.longest[state]
            if word in a.step[state]:
                state, length = a.step[state][word], length + 1
            else:
                state = length = 0
            best = max([n for n in range(1, at + 2) if tuple(text[at + 1 - n:at + 1]) in subs], default=0)
            assert length == best
            found = tuple(text[at + 1 - best:at + 1])
            assert set(a.ends[state] if best else {}) == {k for k, w in enumerate(lists) if best and any(tuple(w[i:i + best]) == found for i in range(len(w)))}
            for k, end in (a.ends[state].items() if best else ()):
                assert tuple(lists[k][end - best:end]) == found


def base(text):
    words = WORD.findall((text or "").translate(SMALL))
    places = [(i, label) for label, phrase in PHRASES for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def check(docs):
    out = scan(docs)
    assert out.columns == docs.columns + ["licence"]
    rows = out.collect()
    for r in rows:
        f = r.licence
        assert (f.n_words, f.n_base, f.first_word, f.last_word, f.base_labels) == base(r.text)
        assert set(f.base_labels.split(",")) - {""} <= set(f.labels.split(",")) and 0 <= f.score <= 1
    return {r.doc_id: r.licence for r in rows}


def test_real_documents(documents):
    check(documents)


def test_all_templates_and_changed_ones(odd):
    scanner = Scanner()
    for label, text in TEMPLATES:
        n, _, chains = scanner.scan(f"xx yy {text} zz")
        assert n == len(words_of(text)) + 3
        whole = [c for c in chains if c[3] == 1.0 and scanner.templates[c[2]][0] == label]
        assert any((a, b) == (2, n - 2) for a, b, _, _ in whole)
    mit = words_of(TEMPLATES[0][1])
    changed = mit[:60] + ["some", "one"] + mit[62:100] + mit[103:]
    half = mit[:len(mit) // 2]
    docs = odd([(1, " ".join(changed).upper(), "en", "s"), (2, " ".join(half), "en", "s"), (3, " ".join(mit * 40), "en", "s"), (4, " ".join(reversed(mit)), "en", "s")])
    got = check(docs)
    assert "mit" in got[1].labels and 0.9 < got[1].score < 1 and len([s for s in got[1].spans if s.label == "mit"]) == 1
    assert "mit" not in got[2].labels and "mit" not in got[4].labels
    assert len([s for s in got[3].spans if s.label == "mit" and s.cover == 1.0]) == 40


def test_odd_rows(odd):
    texts = [None, "", "cc by", "CC-BY ccKbyccby CC BY BY", "all rights reserved all rights reserved", "General\npublic  LICENSE", "all rights éreserved", "cc by " * 50000,
             "general public general public license", "cc", "x" * 2_000_000, "allrights reserved", "all rights reserved"]
    got = check(odd([(i, t, "en", "s") for i, t in enumerate(texts)] + [(4, texts[4], "en", None), (None, "cc by", "en", "s")]))
    assert got[0].score == 0.0 and got[0].labels == "" and got[2].score == 1.0 and got[7].n_base == 50000
    assert scan(odd([])).count() == 0


def covered(template, text):
    """Most words of a common subsequence whose pairs are in equal runs of three words or more."""
    n, m = len(template), len(text)
    run = {}
    for i in range(n):
        for j in range(m):
            if template[i] == text[j]:
                run[i, j] = run.get((i - 1, j - 1), 0) + 1
    long = {(i - k, j - k) for (i, j), size in run.items() if size >= 3 for k in range(size)}
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n):
        for j in range(m):
            best[i + 1][j + 1] = best[i][j] + 1 if (i, j) in long else max(best[i][j + 1], best[i + 1][j])
            best[i + 1][j + 1] = max(best[i + 1][j + 1], best[i][j + 1], best[i + 1][j])
    return best[n][m]


def test_one_word_more_or_changed_anywhere():
    scanner = Scanner()
    text = "and THE SOFTWARE IS PROVIDED".join(TEMPLATES[0][1].split("THE SOFTWARE IS PROVIDED"))
    assert [c[3] for c in scanner.scan(text)[2] if c[2] == 0] == [1.0]
    assert any(c[2] == 0 and c[3] > 0.98 for c in scanner.scan(TEMPLATES[0][1].replace("furnished", "provided"))[2])
    for k, (_, template) in enumerate(TEMPLATES):
        words = words_of(template)
        if len(words) < 15:
            continue
        for at in range(len(words)):
            for new in ("and", "provided", "zzz"):
                for changed, lost in ((words[:at] + [new] + words[at:], 4), (words[:at] + [new] + words[at + 1:], 5)):
                    covers = [c[3] for c in scanner.scan(" ".join(changed))[2] if c[2] == k]
                    assert len(covers) == 1 and covers[0] >= (len(words) - lost) / len(words), (k, at, new)


def test_chains_cover_as_much_as_brute_force():
    rng = random.Random(6)
    hits = 0
    for _ in range(400):
        template = [rng.choice("abcd") for _ in range(rng.randrange(5, 16))]
        text = list(template)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(text))
            text[at:at + rng.randrange(2)] = [rng.choice("abcde") for _ in range(rng.randrange(3))]
        text = [rng.choice("abcde") for _ in range(4)] + text
        chains = Scanner((("t", " ".join(template)),), ()).scan(" ".join(text))[2]
        most = covered(template, text) / len(template)
        assert bool(chains) == (most >= 0.8)
        if chains and len(chains) == 1:
            assert chains[0][3] == most
            hits += 1
    assert hits > 100


def test_matches_of_one_template_survive_longer_ones_of_another():
    scanner = Scanner((("x", "p q r s t u v w"), ("y", "q r s t m n o k l")), ())
    assert [(scanner.templates[c[2]][0], c[0], c[1], c[3]) for c in scanner.scan("p q r s t u m n o k l")[2]] == [("y", 1, 10, 1.0)]


def test_shared_words_count_for_the_template_that_covers_most():
    scanner = Scanner()
    for label, text in TEMPLATES:
        assert [scanner.templates[c[2]][0] for c in scanner.scan(text)[2]] == [label]
    mit, apache = words_of(TEMPLATES[0][1]), words_of(next(t for label, t in TEMPLATES if label == "apache-2.0" and len(t) < 80))
    found = scanner.scan(" ".join(mit[:90] + apache + mit[90:]))[2]
    assert sorted((scanner.templates[c[2]][0], c[3]) for c in found) == [("apache-2.0", 1.0), ("mit", 1.0)]
