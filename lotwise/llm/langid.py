"""Language ID: script ranges narrow the candidates, then Viterbi over word scores with a switching penalty.

A word's score for a language is the sum of log probabilities of its letter trigrams, learned per language
in a fixed number of hash slots. All steps run on whole batches of text as arrays of code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.rows import hash_sample, small_batches
from lotwise.sources.scratch import materialize

#: The bounded sample of rows with a language that scores are fitted on.
SAMPLE_ROWS = 20000
SLOTS = 1 << 16
PENALTY = 8.0
CHUNK_CHARS = 2 << 20
BATCH = 1000
#: Longer texts are decoded in stretches of so many words, each by itself.
STRETCH = 4096
HELD_OUT = (4, 2)
UNKNOWN = "und"

#: fixed values: starts of code point ranges and the script that goes from there to the next start
SCRIPTS = (
    (0x0, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"), (0x600, "Arabic"),
    (0x700, "Other"), (0x900, "Devanagari"), (0x980, "Bengali"), (0xA00, "Indic"), (0xE00, "Thai"), (0xE80, "Other"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1380, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3130, "Hangul"), (0x31F0, "Kana"),
    (0x3400, "Han"), (0xA000, "Other"), (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"), (0xA800, "Other"),
    (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Other"), (0xFF21, "Latin"), (0xFF66, "Kana"),
    (0x10000, "Other"), (0x20000, "Han"),
)
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(n) for _, n in SCRIPTS])
_TABLES: list[np.ndarray] = []


def _lower() -> np.ndarray:
    """Code point of the small letter for each letter, 0 for what is no letter."""
    if not _TABLES:
        table = np.zeros(0x110000, dtype=np.uint32)
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                small = c.lower()
                table[code] = ord(small) if len(small) == 1 else code
        _TABLES.append(table)
    return _TABLES[0]


@dataclass
class Words:
    """The words of texts laid end to end: each letter's trigram slot, and of each word its place and text."""

    slots: np.ndarray
    first_letter: np.ndarray
    letters: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    script: np.ndarray


def words_of(texts: list[str]) -> Words:
    joined = "\0".join(texts)
    x = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.cumsum([len(t) + 1 for t in texts])
    x = np.concatenate([[0], _lower()[x], [0]]).astype(np.uint64)
    at = np.flatnonzero(x)
    a, b, c = x[at - 1], x[at], x[at + 1]
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c * np.uint64(0x165667B19E3779F9))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    slots = (h >> np.uint64(64 - 16)).astype(np.int64)
    first = np.flatnonzero(a == 0)
    letters = np.diff(np.append(first, len(at)))
    start = at[first] - 1
    return Words(slots, first, letters, start, start + letters, np.searchsorted(ends, start, side="right"),
                 _SCRIPT[np.searchsorted(_STARTS, b[first].astype(np.int64), side="right") - 1])


@dataclass
class Model:
    """``scores``: log probability by slot and language; ``allowed``: languages by script."""

    languages: list[str]
    scores: np.ndarray
    allowed: np.ndarray

    def word_scores(self, words: Words) -> np.ndarray:
        if not len(words.first_letter):
            return np.zeros((0, len(self.languages)))
        sums = np.add.reduceat(self.scores[words.slots], words.first_letter, axis=0).astype(np.float64)
        return np.where(self.allowed[words.script], sums, -np.inf)


def decode(scores: np.ndarray, sizes: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Best label of each word: the sequences of ``sizes`` words lie one after another, all decoded at once.

    A label costs the sum of its words' scores, each change ``penalty``. Of equal labels the first wins, and
    of staying and changing staying does.
    """
    labels = np.zeros(len(scores), dtype=np.int16)
    order = np.argsort(-sizes, kind="stable")
    sizes, starts = sizes[order], (np.cumsum(sizes) - sizes)[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # how many have more than t words
    came: list[np.ndarray] = []
    best = scores[starts[:active[0]]].copy() if longest else None
    for t in range(1, longest):
        n = active[t]
        now = best[:n]
        top = now.argmax(1)
        over = now[np.arange(n), top] - penalty
        stays = now >= over[:, None]
        came.append(np.where(stays, np.arange(now.shape[1], dtype=np.int16), top[:, None].astype(np.int16)))
        best[:n] = np.where(stays, now, over[:, None]) + scores[starts[:n] + t]
    if longest:
        last = best.argmax(1).astype(np.int16)
        labels[starts[:active[0]] + sizes[:active[0]] - 1] = last
        for t in range(longest - 1, 0, -1):
            n = active[t]
            labels[starts[:n] + t - 1] = came[t - 1][np.arange(n), labels[starts[:n] + t]]
    return labels


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: by crc32 of the id as text; rows without an id, too."""
    folds, out = HELD_OUT
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == out, F.lit(True))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Trigram scores from the texts of at most ``sample_rows`` ids with a language, those of the smallest hash."""
    small_batches(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    ids = hash_sample(known.select(F.col("doc_id").alias("_id")).distinct(), sample_rows, "_id")
    sample = materialize(known.join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).select("text", "lang"), "lang_sample")
    counts = sample.mapInArrow(_slot_counts, "lang string, slot int, script int, n long").groupBy("lang", "slot", "script").agg(F.sum("n").alias("n"))
    rows = counts.toPandas()  # at most a row for each language and slot, and for each language and script
    languages = sorted(rows["lang"].unique())
    at = rows["lang"].map({name: k for k, name in enumerate(languages)}).to_numpy(dtype=np.int64)
    slot, script, n = rows["slot"].to_numpy(), rows["script"].to_numpy(), rows["n"].to_numpy()
    seen = np.zeros((SLOTS, len(languages)))
    used = slot >= 0
    np.add.at(seen, (slot[used], at[used]), n[used])
    by_script = np.zeros((len(_NAMES), len(languages)))
    np.add.at(by_script, (script[~used], at[~used]), n[~used])
    scores = np.log((seen + 0.5) / (seen.sum(0) + 0.5 * SLOTS)).astype(np.float32)
    allowed = by_script >= 0.05 * np.maximum(by_script.sum(0), 1)
    allowed[~allowed.any(1)] = True  # a script that no language writes leaves them all
    return Model(languages, scores, allowed)


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    at, chars = 0, 0
    for k, t in enumerate(texts):
        chars += len(t)
        if chars >= CHUNK_CHARS:
            yield at, k + 1
            at, chars = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and language: (slot, count) with script -1, and (script, words) with slot -1."""
    schema = pa.schema([("lang", pa.string()), ("slot", pa.int32()), ("script", pa.int32()), ("n", pa.int64())])
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            own = [t for t, name in zip(texts, langs) if name == lang]
            slots, scripts = np.zeros(SLOTS, np.int64), np.zeros(len(_NAMES), np.int64)
            for a, b in _chunks(own):
                words = words_of(own[a:b])
                slots += np.bincount(words.slots, minlength=SLOTS)
                scripts += np.bincount(words.script, minlength=len(_NAMES))
            s, k = np.flatnonzero(slots), np.flatnonzero(scripts)
            yield pa.record_batch([pa.array([lang] * (len(s) + len(k))), pa.array(np.concatenate([s, np.full(len(k), -1)]), pa.int32()),
                                   pa.array(np.concatenate([np.full(len(s), -1), k]), pa.int32()),
                                   pa.array(np.concatenate([slots[s], scripts[k]]), pa.int64())], schema=schema)


def label_texts(texts: list[str], model: Model, with_spans: bool, stretch: int = STRETCH) -> list[tuple]:
    """(language, share of the letters, number of spans, spans) of each text."""
    out: list[tuple] = [(UNKNOWN, 0.0, 0, [])] * len(texts)
    if not model.languages:
        return out
    for low, high in _chunks(texts):
        words = words_of(texts[low:high])
        per_text = np.bincount(words.text, minlength=high - low)
        whole, rest = per_text // stretch, per_text % stretch
        sizes = np.concatenate([np.array([stretch] * int(w) + ([int(r)] if r else []), dtype=np.int64) for w, r in zip(whole, rest)])
        labels = decode(model.word_scores(words), sizes)
        letters = np.zeros((high - low, len(model.languages)), dtype=np.int64)
        np.add.at(letters, (words.text, labels), words.letters)
        change = np.ones(len(labels), dtype=bool)
        change[1:] = (labels[1:] != labels[:-1]) | (words.text[1:] != words.text[:-1])
        spans = np.bincount(words.text[change], minlength=high - low)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[low:high]])
        runs: list[list] = [[] for _ in range(high - low)]
        if with_spans:
            first = np.flatnonzero(change)
            last = np.append(first[1:], len(labels)) - 1
            for a, b in zip(first.tolist(), last.tolist()):
                k = int(words.text[a])
                runs[k].append((model.languages[labels[a]], int(words.start[a] - begins[k]), int(words.end[b] - begins[k])))
        for k in np.flatnonzero(per_text).tolist():
            top = int(letters[k].argmax())
            out[low + k] = (model.languages[top], float(letters[k, top] / letters[k].sum()), int(spans[k]), runs[k])
    return out


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language", with_spans: bool = True) -> DataFrame:
    """Adds struct ``out``: lang, score, n_spans and spans (lang, start, end in code points).

    Lang is the language of most letters, of equals the first by name; score is its share of the letters. A
    null text, one without letters, or a model without languages gives ``und``, 0 and no spans.
    """
    small_batches(docs.sparkSession)
    span = pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    @F.arrow_udf("lang string, score double, n_spans int, spans array<struct<lang:string,start:int,end:int>>")
    def one(texts: pa.Array) -> pa.Array:
        rows = []
        for at in range(0, len(texts), BATCH):
            rows += label_texts([t.as_py() or "" for t in texts.slice(at, BATCH)], model, with_spans)
        spans = [[{"lang": a, "start": b, "end": c} for a, b, c in r[3]] for r in rows]
        columns = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()),
                   pa.array([r[2] for r in rows], pa.int32()), pa.array(spans, pa.list_(span))]
        return pa.StructArray.from_arrays(columns, ["lang", "score", "n_spans", "spans"])

    return docs.withColumn(out, one(F.col(text)))
