"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding maps look-alike letters, accents and digit substitutions to plain letters and all else to blanks.
The lexicon holds whole words and word beginnings: a start list, and what labelled rows add. Weights are
log odds. Matches inside exception phrases don't count. The sum of weights, as it is and by length, goes
through a logistic curve.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.rows import hash_sample, small_batches
from lotwise.sources.scratch import materialize

#: The bounded sample of labelled rows that the lexicon and the curve are fitted on.
SAMPLE_ROWS = 20000
MAX_TERMS = 4000
STEMS = range(4, 11)
MIN_CONTEXTS = 4
MIN_ODDS = 2.5
START_WEIGHT = 3.0
HELD_OUT = 5

# ---- fixed values: start list, harmless phrases, look-alike letters, digit substitutions ----
START_WORDS = (
    "asshole bastard bitch clown cretin degenerate dickhead disgusting dumbass dumb fool fuck fucking garbage idiot "
    "imbecile jerk loser lunatic moron motherfucker pathetic pig retard scum scumbag shit shithead slut stupid trash "
    "twat vermin wanker whore worthless "
    "arschloch blödmann depp dreckskerl dummkopf hurensohn idioten schlampe schwachkopf trottel wichser "
    "abruti bâtard connard connasse crétin débile enculé imbécile ordure salaud salope "
    "cabrón estúpido gilipollas idiota mierda pendejo puta puto tonto zorra"
).split()
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "take out the trash", "garbage collection", "garbage collector",
    "garbage truck", "clown fish", "clownfish", "guinea pig", "pig iron", "loser bracket", "dumb terminal",
    "sore loser", "april fool", "fool proof", "moron laws",
)
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "і": "i", "ї": "i", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ј": "j", "ԁ": "d", "ո": "n", "α": "a", "β": "b", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ß": "ss", "ı": "i", "ł": "l", "ø": "o",
    "æ": "ae", "œ": "oe", "đ": "d",
}
DIGIT_LETTERS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}


def _folding() -> dict[int, str]:
    out = {}
    for code in [*range(0x600), *range(0x1E00, 0x2100), *range(0xFF00, 0xFF60)]:
        c = chr(code)
        plain = unicodedata.normalize("NFKD", c).lower()
        plain = "".join(LOOKALIKES.get(x, x) for x in plain if not unicodedata.combining(x))
        if c in DIGIT_LETTERS:
            out[code] = DIGIT_LETTERS[c]
        elif unicodedata.combining(c) or code in (0xAD, *range(0x200B, 0x2010)):
            out[code] = ""  # invisible: it must not split a word
        else:
            out[code] = plain if plain.isalpha() else " "
    return out


_FOLD = _folding()


def fold(text: str) -> str:
    """Lower-case plain letters, blanks at both ends and for all that is no letter."""
    words = [w.rstrip("!$@") for w in text.split()]  # at a word's end these are punctuation
    return " " + " ".join(" ".join(words).translate(_FOLD).split()) + " "


@dataclass
class Model:
    """``terms``: folded keys, with a blank before, and after where whole words are meant."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-4.0, 1.5, 0.5)

    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for key, weight in self.terms.items():
            out.add_word(key, (len(key), weight))
        for phrase in self.exceptions:
            key = fold(phrase)
            out.add_word(key, (len(key), None))
        out.make_automaton()
        return out


_AUTOMATA: dict[tuple, object] = {}


def _matched(model: Model):
    key = (zlib.crc32(repr(sorted(model.terms.items())).encode()), len(model.terms), model.exceptions)
    if key not in _AUTOMATA:
        _AUTOMATA[key] = model.automaton()
    return _AUTOMATA[key]


def weigh(text: str | None, automaton) -> tuple[float, int, int]:
    """Sum of weights, matches and words of a text; of the terms that start a word the heaviest counts."""
    folded = fold(text or "")
    best: dict[int, float] = {}
    harmless: list[tuple[int, int]] = []
    for end, (size, weight) in automaton.iter(folded):
        start = end - size + 1
        if weight is None:
            harmless.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    for low, high in harmless:
        for start in [s for s in best if low <= s < high]:
            del best[start]
    return math.fsum(best.values()), len(best), folded.count(" ") - 1


def features(total: float, words: int) -> tuple[float, float]:
    return math.log1p(total), math.log1p(1000.0 * total / max(words, 1))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """Adds struct ``out`` (score 0 to 1, matches). A null or empty text has no match, which gives the least score."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("score double, matches int")
    def one(texts: pa.Array) -> pa.Array:
        automaton = _matched(model)
        a, b, c = model.curve
        scores, found = [], []
        for t in texts:
            total, matches, words = weigh(t.as_py(), automaton)
            x, y = features(total, words)
            scores.append(1.0 / (1.0 + math.exp(-max(-700.0, a + b * x + c * y))))
            found.append(matches)
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(found, pa.int32())], ["score", "matches"])

    return docs.withColumn(out, one(F.col(text)))


def held_out(doc_id, folds: int = HELD_OUT):
    """Rows never learned from: crc32 of the id as text is a multiple of ``folds``; rows without an id, too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and curve from ``sample_rows`` labelled rows at most, those of the smallest id hashes.

    A learned term occurs in toxic rows after at least 4 different words (so copies of one text can't make
    it), and in toxic rows far oftener than in others. Without labelled rows the start list has its weight.
    """
    small_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").alias("label_id"), "toxic").where("toxic is not null and label_id is not null")
    known = known.where(~held_out(F.col("label_id"))).groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    known = hash_sample(known, sample_rows, "label_id")
    texts = docs.select("doc_id", "text").where("text is not null")
    sample = materialize(texts.join(F.broadcast(known), F.col("doc_id") == F.col("label_id")).select("text", "toxic"), "toxic_sample")
    n_toxic, n_other = sample.agg(F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0)),
                                  F.coalesce(F.sum((F.col("toxic") != 1).cast("long")), F.lit(0))).first()
    start = {" " + fold(w).strip() + " ": START_WEIGHT for w in START_WORDS}
    if not n_toxic or not n_other:
        return Model(start)
    counts = sample.mapInArrow(_term_counts, "term string, toxic int, before long, rows long")
    toxic = F.col("toxic") == 1
    per = counts.groupBy("term").agg(
        F.sum(F.when(toxic, F.col("rows")).otherwise(0)).alias("t"), F.sum(F.when(toxic, 0).otherwise(F.col("rows"))).alias("o"),
        F.size(F.collect_set(F.when(toxic, F.col("before")))).alias("contexts"))
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("o") + 0.5) / (n_other + 1.0))
    per = per.withColumn("odds", odds)
    chosen = per.where((F.col("contexts") >= MIN_CONTEXTS) & (F.col("odds") >= MIN_ODDS))
    learned = chosen.orderBy(F.desc("contexts"), "term").limit(MAX_TERMS).select("term", "odds").collect()
    at_start = per.where(F.col("term").isin(list(start))).select("term", "odds", (F.col("t") + F.col("o")).alias("n")).collect()
    terms = dict(start)
    for r in at_start:  # what the sample says of a start word, against its prior weight by number of rows
        terms[r["term"]] = max(0.0, (START_WEIGHT * 5 + min(r["odds"], 6.0) * r["n"]) / (5 + r["n"]))
    found = {r["term"]: min(r["odds"], 6.0) for r in learned}
    for term, weight in found.items():
        shorter = [term[:k] for k in range(5, len(term))]
        if not any(found.get(s, -1.0) >= weight - 1.0 for s in shorter):
            terms[term] = max(weight, terms.get(term, 0.0))
    model = Model(terms)
    rows = sorted(sample.mapInArrow(_weights_of(model), "toxic int, total double, words long").collect())  # the same sums on every run
    x = np.array([[1.0, *features(r["total"], r["words"])] for r in rows])
    y = np.array([float(r["toxic"] == 1) for r in rows])
    model.curve = tuple(float(v) for v in _logistic(x, y))
    return model


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (term, label, hash of the word before, documents): partial counts, given out as they fill up."""
    schema = pa.schema([("term", pa.string()), ("toxic", pa.int32()), ("before", pa.int64()), ("rows", pa.int64())])
    counts: Counter = Counter()

    def full() -> pa.RecordBatch:
        keys = list(counts)
        columns = [[k[i] for k in keys] for i in range(3)] + [list(counts.values())]
        counts.clear()
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            first: dict[str, int] = {}
            before = ""
            for word in fold(text.as_py()).split():
                key = " " + word + " "
                if key not in first:
                    at = zlib.crc32(before.encode()) if toxic == 1 else 0
                    first[key] = at
                    for k in STEMS:
                        if len(word) >= k:
                            first.setdefault(" " + word[:k], at)
                before = word
            label = int(toxic == 1)
            counts.update((term, label, at) for term, at in first.items())
            if len(counts) > 100_000:
                yield full()
    yield full()


def _weights_of(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _matched(model)
        for batch in batches:
            found = [weigh(t.as_py(), automaton) for t in batch.column(0)]
            yield pa.record_batch([batch.column(1).cast(pa.int32()), pa.array([f[0] for f in found], pa.float64()),
                                   pa.array([f[2] for f in found], pa.int64())], names=["toxic", "total", "words"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Newton steps; the ridge keeps the curve finite where the classes are apart."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - ridge * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta
