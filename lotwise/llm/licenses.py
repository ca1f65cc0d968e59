"""Licence scans with a generalised suffix automaton of template words.

A text runs through the automaton once. Its matching statistics say at each word how long a match with some
template ends there. The matches with a template, in all its places, are chained by dynamic programming, in the
order of both text and template, into the parts of the text that cover most of the template. Of templates
that share their words in a text, the one that covers most of it stands.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.license_texts import PHRASES, TEMPLATES
from lotwise.llm.rows import small_batches

#: ASCII letters and digits and all beyond ASCII; only A-Z are lower-cased.
WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
LEAST_MATCH = 3
LARGEST_GAP = 40
LEAST_COVER = 0.8
_KNOWN_WORDS = 1 << 20


def words_of(text: str) -> list[str]:
    return [w.lower() if w.isascii() else w.translate(_SMALL) for w in WORD.findall(text)]


_SMALL = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


@dataclass
class Automaton:
    """Suffix automaton of several word sequences. State 0 is the empty match.

    ``ends[s]``: for each template with the state's longest string, where in it that first ends.
    ``phrases[s]``: phrases that end with the state's strings, by length.
    """

    longest: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    ends: list[dict[int, int]] = field(default_factory=lambda: [{}])
    phrases: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])

    def _new(self, longest: int, link: int, step: dict[int, int], ends: dict[int, int]) -> int:
        self.longest.append(longest)
        self.link.append(link)
        self.step.append(step)
        self.ends.append(ends)
        self.phrases.append([])
        return len(self.link) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        copy = self._new(self.longest[p] + 1, self.link[q], dict(self.step[q]), dict(self.ends[q]))
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, word: int) -> int:
        q = self.step[last].get(word)
        if q is not None:  # the string is known from an earlier template
            return q if self.longest[q] == self.longest[last] + 1 else self._split(last, q, word)
        new, p = self._new(self.longest[last] + 1, 0, {}, {}), last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][word]
            self.link[new] = q if self.longest[q] == self.longest[p] + 1 else self._split(p, q, word)
        return new

    def add(self, number: int, words: list[int]) -> int:
        """Adds a template; gives the state of the whole of it."""
        state = 0
        for at, word in enumerate(words):
            state = self._extend(state, word)
            self.ends[state].setdefault(number, at + 1)
        return state

    def finish(self, marks: list[tuple[int, int, int]]) -> None:
        """Hands places up to shorter strings, and phrases (state, number, length) down to longer ones."""
        order = sorted(range(1, len(self.link)), key=self.longest.__getitem__)
        for s in reversed(order):
            for number, at in self.ends[s].items():
                if self.link[s] > 0:
                    above = self.ends[self.link[s]]
                    above[number] = min(at, above.get(number, at))
        own: dict[int, list[tuple[int, int]]] = {}
        for state, number, length in marks:
            own.setdefault(state, []).append((number, length))
        for s in order:
            self.phrases[s] = own.get(s, []) + (self.phrases[self.link[s]] if self.link[s] > 0 else [])


class Scanner:
    """Finds phrases and covered templates in texts."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.templates, self.phrases = templates, phrases
        self.number: dict[str, int] = {}
        self.automaton = Automaton()
        self.sizes = []
        for k, (_, text) in enumerate(templates):
            words = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            self.sizes.append(len(words))
            self.automaton.add(k, words)
        lists = [[self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)] for _, text in phrases]
        for k, words in enumerate(lists):
            self.automaton.add(len(templates) + k, words)
        # states may have been split since, so look the phrases' states up at the end
        self.automaton.finish([(self._state(words), k, len(words)) for k, words in enumerate(lists)])
        a = self.automaton
        #: The state of the last words, LEAST_MATCH of them, of a state's strings, and where in which templates it ends.
        self.short = list(range(len(a.link)))
        for state in sorted(range(1, len(a.link)), key=a.longest.__getitem__):
            if a.longest[a.link[state]] >= LEAST_MATCH:
                self.short[state] = self.short[a.link[state]]
        self.places: list[list[tuple[int, int]]] = [[] for _ in a.link]
        for k, (_, text) in enumerate(templates):
            state = 0
            for at, word in enumerate(words_of(text), 1):
                state = a.step[state][self.number[word]]
                if at >= LEAST_MATCH:
                    self.places[self.short[state]].append((k, at))
        self.known: dict[str, int] = {}

    def _state(self, words: list[int]) -> int:
        state = 0
        for w in words:
            state = self.automaton.step[state][w]
        return state

    def numbers(self, text: str) -> np.ndarray:
        """The number of each word of the text, 0 for words of no template."""
        if len(self.known) > _KNOWN_WORDS:
            self.known.clear()
        known, out = self.known, []
        for w in WORD.findall(text):
            n = known.get(w)
            if n is None:
                n = known[w] = self.number.get(w.lower(), 0) if w.isascii() else 0
            out.append(n)
        return np.array(out, dtype=np.int32)

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """Words, places (start, phrase) of phrases, and chains (first word, last word, template, share covered)."""
        ids = self.numbers(text)
        a = self.automaton
        places: list[tuple[int, int]] = []
        runs: dict[tuple[int, int], list[list[int]]] = {}
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
        for low, high in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if high - low < 2:
                continue
            state = length = 0
            for at, word in enumerate(ids[low:high].tolist(), low):
                following = a.step[state].get(word)
                while following is None and state > 0:
                    state = a.link[state]
                    length = a.longest[state]
                    following = a.step[state].get(word)
                if following is None:
                    state = length = 0
                    continue
                state, length = following, length + 1
                for number, size in a.phrases[state]:
                    if size <= length:
                        places.append((at + 1 - size, number))
                if length >= LEAST_MATCH:
                    self._prolong(runs, state, at + 1)
        matches: dict[int, list[tuple[int, int, int]]] = {}
        for (number, shift), found in runs.items():
            matches.setdefault(number, []).extend((start, end, start + shift) for start, end in found)
        return len(ids), places, self._distinct([c for k, found in matches.items() for c in self._chains(k, sorted(found))])

    def _prolong(self, runs: dict[tuple[int, int], list[list[int]]], state: int, end: int) -> None:
        """The matches that end here, in all places of all templates, by template and shift against the text."""
        for number, place in self.places[self.short[state]]:
            found = runs.setdefault((number, place - end), [])
            if found and found[-1][1] == end - 1:
                found[-1][1] = end
            else:
                found.append([end - LEAST_MATCH, end])

    def _chains(self, number: int, found: list[tuple[int, int, int]]) -> list[tuple[int, int, list[tuple[int, int]]]]:
        """The chains of a template that cover most words together, none in the text of another.

        ``found`` has all matches with the template as (start, end, place), by rising start. A chain goes
        on in text and template; of a match that overlaps the one before in either, the rest counts. A
        chain is (template, words covered, their stretches of the text).
        """
        size = self.sizes[number]
        least = math.ceil(LEAST_COVER * size - 1e-9)
        seen = bytearray(size)
        for start, end, place in found:
            seen[place:place + end - start] = b"\1" * (end - start)
        if sum(seen) < least:
            return []
        whole = []
        for k, (first, _, place) in enumerate(found):
            if place <= size - least:
                whole += [(c[0], first, c) for c in self._from(found, k) if c[2] >= least]
        whole.sort(key=lambda w: w[:2])
        # chains that don't overlap, by end: the best of those up to each, as (covered, words passed, chains)
        ends, best = [0], [(0, 0, None)]
        for end, start, chain in whole:
            before = best[bisect.bisect_right(ends, start) - 1]
            new = (before[0] + chain[2], before[1] + start - end, (before[2], chain))
            if new[:2] > best[-1][:2]:
                ends.append(end)
                best.append(new)
        out, last = [], best[-1][2]
        while last:
            last, chain = last
            covered, parts = chain[2], []
            while chain:
                end, _, most, chain = chain
                parts.append((end - most + (chain[2] if chain else 0), end))
            out.append((number, covered, parts[::-1]))
        return out[::-1]

    @staticmethod
    def _from(found: list[tuple[int, int, int]], k: int) -> list[tuple]:
        """(end, place reached, most words covered, before) of the chains that begin with a match; a later end covers more."""
        start, end, place = found[k]
        open_, furthest = [(end, place + end - start, end - start, None)], end
        out = list(open_)
        for start, end, place in found[k + 1:]:
            if start - furthest > LARGEST_GAP:
                break
            open_ = [c for c in open_ if start - c[0] <= LARGEST_GAP]
            reached, most, before = place + end - start, 0, None
            for c in open_:
                if c[0] < end and c[1] < reached:
                    covered = c[2] + min(end - max(start, c[0]), reached - max(place, c[1]))
                    if covered > most:
                        most, before = covered, c
            if before:
                open_.append((end, reached, most, before))
                out.append(open_[-1])
                furthest = max(furthest, end)
        best, rising = 0, []
        for c in sorted(out, key=lambda c: (c[0], -c[2])):
            if c[2] > best:
                best = c[2]
                rising.append(c)
        return rising

    def _distinct(self, chains: list[tuple[int, int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, float]]:
        """Chains of which half the words or more aren't those of a better one, which covers more words, or as many of fewer."""
        order = lambda c: (-c[1], self.sizes[c[0]])
        taken: set[int] = set()
        out = []
        for _, equal in itertools.groupby(sorted(chains, key=order), order):
            kept = [c for c in equal if 2 * sum(w in taken for low, high in c[2] for w in range(low, high)) <= c[1]]
            for number, covered, parts in kept:
                taken.update(w for low, high in parts for w in range(low, high))
                out.append((parts[0][0], parts[-1][1] - 1, number, covered / self.sizes[number]))
        return out


_SCANNERS: list[Scanner] = []


def scanner() -> Scanner:
    if not _SCANNERS:
        _SCANNERS.append(Scanner())
    return _SCANNERS[0]


def scan(docs: DataFrame, text: str = "text", out: str = "licence") -> DataFrame:
    """Adds struct ``out`` with the words, the base phrases' places and the templates that the text covers.

    Fields: n_words, n_base, first_word, last_word (least and greatest start of a phrase, else null),
    base_labels, labels (with those of templates covered by 80 percent or more; both sorted and joined by
    commas), score (the largest share covered, 1 if there is a phrase) and spans (label, first_word,
    last_word, cover). A null text is an empty one: no words, labels or spans, and score 0.
    """
    small_batches(docs.sparkSession)
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("cover", pa.float64())])

    @F.arrow_udf("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
                 "spans array<struct<label:string,first_word:long,last_word:long,cover:double>>")
    def one(texts: pa.Array) -> pa.Array:
        s = scanner()
        rows = []
        for t in texts:
            n, places, chains = s.scan(t.as_py() or "")
            base = {s.phrases[k][0] for _, k in places}
            both = base | {s.templates[c[2]][0] for c in chains}
            starts = [p for p, _ in places]
            spans = [{"label": s.templates[k][0], "first_word": a, "last_word": b, "cover": c} for a, b, k, c in sorted(chains)]
            rows.append((n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(both)),
                         1.0 if base else max((c[3] for c in chains), default=0.0), spans))
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
        return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return docs.withColumn(out, one(F.col(text)))
