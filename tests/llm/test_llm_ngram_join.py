import random
import re

from lotwise.llm.graph import components
from lotwise.llm.ngram_join import keep_first, similar_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def shingles(text):
    w = WORD.findall((text or "").translate(SMALL))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """Smallest id of each row's group, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            out[find(k)] = min(i, out.get(find(k), i))
    return [(str(i), len(s), str(out.get(find(k)))) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in similar_groups(docs).collect())
    assert got == sorted(brute(rows))
    return got


def test_real_documents(documents):
    got = check(documents)
    assert sorted(r.doc_id for r in keep_first(documents).collect()) == sorted({int(c) for _, _, c in got})


def test_near_the_threshold(odd):
    """Copies with more and more changed words, chains, a shared passage in most texts, and short texts."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(60))
    rows, k = [], 0
    for n in (3, 5, 6, 9, 12, 30, 80, 300):
        for _ in range(3):
            first = [word() for _ in range(n)]
            rows.append((k := k + 1, " ".join(first)))
            for changes in range(7):
                near = list(first)
                for _ in range(changes):
                    near[rng.randrange(n)] = word()
                rows.append((k := k + 1, " ".join(near).upper()))
    rows += [(k := k + 1, passage + " " + " ".join(word() for _ in range(rng.randrange(1, 40)))) for _ in range(60)]
    chain = [word() for _ in range(60)]
    for _ in range(20):
        rows.append((k := k + 1, " ".join(chain)))
        chain[rng.randrange(60)] = word()
    rng.shuffle(rows)
    check(odd([(i, t, "en", "s") for i, t in rows]))


def test_odd_rows(odd):
    text = "one two three four five six seven"
    docs = odd([(5, text, "en", "a"), (5, text, "en", "a"), (None, text.upper(), "en", None), (7, None, "en", "a"), (8, "", "en", "a"), (9, " \t\n", "en", "a"),
                (None, "alone here", "en", "a"), (3, "Alone  HERE", "en", "a"), (5, "other text of the same id", "en", "a"), (11, "w " * 70000, "en", "a"), (12, "x" * 3_000_000, "en", "a")])
    check(docs)
    out = keep_first(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(["5", "5", "7", "8", "9", "3", "11", "12"])


def test_empty_table(odd):
    assert similar_groups(odd([])).count() == 0 and keep_first(odd([])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)] + [(300, 300), (7, 7), (500, 400), (400, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100} | {200 + k: 100 for k in range(50)} | {400: 400, 500: 400}
