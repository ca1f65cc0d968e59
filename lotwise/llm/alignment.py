"""Cross-tokenizer alignment: groups and links between the tokens of two tokenizers, and how common links are.

Token ends are byte offsets. The shorter list of ends drives a galloping search into the longer one: from a
finger, steps double until the end is bracketed, then halve. Ends found in both lists cut the tokens into
groups, and the ranks of neighbouring ends give the range of tokens that each token overlaps.

How many documents hold a linked id pair is counted in blocks of documents: a block gives each of its pairs
once, with the number of its documents; sums over blocks go back to the blocks that hold the pair.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lotwise.llm.packing import _byte_alphabet, encoder
from lotwise.llm.rows import small_batches
from lotwise.llm.token_counts import BLANK
from lotwise.sources.scratch import materialize

CHUNK_BYTES = 1 << 20
#: distinct (document, pair) entries after which a block of documents is full
BLOCK_ENTRIES = 1 << 19
_LOADED: dict[tuple[str, str], "Pair"] = {}

_PARTS = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()), ("entries", pa.binary()),
                    ("pair", pa.int64()), ("held", pa.int64())])
_PART_COLUMNS = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
                 "entries binary, pair long, held long")
_OUT = pa.schema([_PARTS.field(k) for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                 + [("n_best", pa.int64()), ("count_sum", pa.int64()), _PARTS.field("groups_sha256"), _PARTS.field("groups")])
_OUT_COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


class Pair:
    """A byte-level vocabulary (A) and a piece vocabulary (B) with the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = encoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = _byte_alphabet()
        words = self.a.plain.get_vocab()
        self.bytes_a = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in word) if all(c in byte_of for c in word) else word.encode()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.size_b = len(self.bytes_b)
        self.length_a = np.array([len(w) for w in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(w) for w in self.bytes_b], dtype=np.int64)
        #: ids as decimals with what follows them: inside a list, and at the end of a group's list
        self.shown = ([f"{i}{c}" for i in range(len(self.bytes_a)) for c in ",|"] + [f"{i}{c}" for i in range(self.size_b) for c in ",;"])

    def ids(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both; none where the bytes of either differ from those of a space and the text."""
        if not text:
            return [], []
        if BLANK in text:  # B reads it as a space
            return [], []
        a, b = self.a.ids(" " + text, special=False), self.b.encode(text)
        want = b" " + text.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != want or b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return [], []
        return a, b


def gallop(short: np.ndarray, long: np.ndarray, finger: np.ndarray) -> np.ndarray:
    """For each value of ``short`` the first place in ``long`` that isn't below it; the last of ``long`` is none's.

    All values gallop at once, each from its finger: steps of 1, 2, 4 and on bracket it, halving finds it.
    """
    top = len(long) - 1
    right = long[finger] < short
    low = np.where(right, finger, -1)
    high = np.where(right, top, finger)
    for going, sign in ((np.flatnonzero(right), 1), (np.flatnonzero(~right), -1)):
        step = 1
        while len(going):
            at = finger[going] + sign * step
            inside = (at >= 0) & (at < top)
            going, at = going[inside], at[inside]
            under = long[at] < short[going]
            low[going[under]] = at[under]
            high[going[~under]] = at[~under]
            going = going[under if sign > 0 else ~under]
            step *= 2
    wide = np.flatnonzero(high - low > 1)
    while len(wide):
        at = (low[wide] + high[wide]) >> 1
        under = long[at] < short[wide]
        low[wide[under]] = at[under]
        high[wide[~under]] = at[~under]
        wide = wide[high[wide] - low[wide] > 1]
    return high


class Aligned:
    """The alignment of some texts, one after another; every text's end is an end of both lists."""

    def __init__(self, ids_a: list[list[int]], ids_b: list[list[int]], length_a: np.ndarray, length_b: np.ndarray):
        self.sizes = [np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b)]
        self.starts = [np.cumsum(n) - n for n in self.sizes]
        self.ids = [np.array([i for x in ids for i in x], dtype=np.int64) for ids in (ids_a, ids_b)]
        ends = [np.cumsum(length_a[self.ids[0]]), np.cumsum(length_b[self.ids[1]])]
        one = int(len(ends[1]) < len(ends[0]))  # the list that drives
        two = 1 - one
        text = np.repeat(np.arange(len(ids_a)), self.sizes[one])
        local = np.arange(len(text)) - self.starts[one][text]
        finger = self.starts[two][text] + local * self.sizes[two][text] // self.sizes[one][text]
        rank = gallop(ends[one], ends[two], finger)
        common = ends[two][rank] == ends[one]
        first = np.zeros(len(rank), dtype=np.int64)
        first[1:] = rank[:-1] + common[:-1]
        counts = rank - first + 1
        before = np.cumsum(counts) - counts
        links = [None, None]
        links[one] = np.repeat(np.arange(len(rank)), counts)
        links[two] = np.arange(int(counts.sum())) - np.repeat(before - first, counts)
        self.links_a, self.links_b = links
        self.link_text = np.repeat(text, counts)
        #: last token of each group, for A and for B
        cuts = [None, None]
        cuts[one], cuts[two] = np.flatnonzero(common), rank[common]
        self.cuts_a, self.cuts_b = cuts
        self.n_links = np.bincount(text, counts, len(ids_a)).astype(np.int64)
        self.n_groups = np.bincount(text, common, len(ids_a)).astype(np.int64)

    def pairs(self, size_b: int) -> np.ndarray:
        """A number for the id pair of each link."""
        return self.ids[0][self.links_a] * size_b + self.ids[1][self.links_b]

    def groups(self, shown: list[str], n_a: int) -> Iterator[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        codes = np.empty(len(self.ids[0]) + len(self.ids[1]), dtype=np.int64)
        for own, other, ids, base in ((self.cuts_a, self.cuts_b, self.ids[0], 0), (self.cuts_b, self.cuts_a, self.ids[1], 2 * n_a)):
            place = np.arange(len(ids))
            group = np.searchsorted(own, place)
            done = np.r_[0, other + 1]
            codes[place + (done[group] if base == 0 else done[group + 1])] = base + 2 * ids + (place == own[group])
        at = 0
        for n in (self.sizes[0] + self.sizes[1]).tolist():
            yield "".join(map(shown.__getitem__, codes[at:at + n].tolist()))[:-1]
            at += n


def _loaded(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Pair(path_a, path_b)
    return _LOADED[path_a, path_b]


class _Block:
    """Documents whose pairs are numbered together."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.entries = 0

    def batches(self, block: int) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(p) for p in self.pairs])
        pairs, place = np.unique(np.concatenate(self.pairs), return_inverse=True)
        held = np.bincount(place, minlength=len(pairs))
        bounds = np.r_[0, np.cumsum(sizes)]
        entries = [packed_entries(place[bounds[k]:bounds[k + 1]], t) for k, t in enumerate(self.times)]
        n = len(self.rows)
        columns = [[block] * n, *zip(*self.rows), entries]
        yield _filled(columns, [0, 1, 2, 3, 4, 5, 6, 7, 8], n)
        yield _filled([np.full(len(pairs), block), pairs, held], [0, 9, 10], len(pairs))


def _filled(columns: list, places: list[int], n: int) -> pa.RecordBatch:
    given = {p: pa.array(c, _PARTS.field(p).type) for p, c in zip(places, columns)}
    return pa.record_batch([given.get(k, pa.nulls(n, f.type)) for k, f in enumerate(_PARTS)], schema=_PARTS)


def packed_entries(places: np.ndarray, times: np.ndarray) -> bytes:
    """Rising places and how often each occurs, as compressed bytes."""
    return zlib.compress(np.concatenate([np.diff(places, prepend=0), times]).astype("<i4").tobytes(), 1)


def unpacked_entries(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(data), dtype="<i4").astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


def _parts(docs: DataFrame, path_a: str, path_b: str, with_groups: bool) -> DataFrame:
    """Rows of documents (pair is null) and of the pairs of their blocks (pair isn't)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = _loaded(path_a, path_b)
        task, n_blocks = TaskContext.get().partitionId() << 32, 0
        block = _Block()
        waiting: list[tuple[int | None, list[int], list[int]]] = []
        size = 0

        def align() -> None:
            used = [w for w in waiting if w[1]]
            found = Aligned([w[1] for w in used], [w[2] for w in used], two.length_a, two.length_b) if used else None
            if found:
                base = len(two.bytes_a) * two.size_b
                keys, times = np.unique(found.link_text * base + found.pairs(two.size_b), return_counts=True)
                bounds = np.searchsorted(keys, np.arange(len(used) + 1) * base)
                groups = found.groups(two.shown, len(two.bytes_a))
            k = 0
            for doc_id, a, b in waiting:
                if not a:
                    block.rows.append((doc_id, 0, 0, 0, 0, "", ""))
                    block.pairs.append(np.empty(0, np.int64))
                    block.times.append(np.empty(0, np.int64))
                    continue
                text = next(groups)
                block.rows.append((doc_id, len(a), len(b), int(found.n_groups[k]), int(found.n_links[k]),
                                   hashlib.sha256(text.encode()).hexdigest(), text if with_groups else None))
                own = slice(bounds[k], bounds[k + 1])
                block.pairs.append(keys[own] - k * base)
                block.times.append(times[own])
                block.entries += len(times[own])
                k += 1
            waiting.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                waiting.append((doc_id, *two.ids(text)))
                size += len(text)
                if size >= CHUNK_BYTES:
                    align()
                    size = 0
                    if block.entries >= BLOCK_ENTRIES:
                        yield from block.batches(task + n_blocks)
                        block, n_blocks = _Block(), n_blocks + 1
        if waiting:
            align()
        if block.rows:
            yield from block.batches(task + n_blocks)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _PART_COLUMNS)


def _scored(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a block with what its pairs count in the corpus."""
    pairs = pairs.sort_by("pair")
    counts, best = (pairs.column(c).to_numpy() for c in ("n", "best"))
    sums, bests = [], []
    for entries in docs.column("entries"):
        place, times = unpacked_entries(entries.as_py())
        sums.append(int((counts[place] * times).sum()))
        bests.append(int(times[best[place]].sum()))
    made = {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
    return pa.table([made.get(f.name) if f.name in made else docs.column(f.name) for f in _OUT], schema=_OUT)


class Alignment:
    """Per-document results and the corpus-wide counts of linked id pairs behind them."""

    def __init__(self, parts: DataFrame, size_b: int):
        self.parts, self.size_b = parts, size_b

    def pair_counts(self) -> DataFrame:
        """(a, b, n, best): documents that hold ids a and b linked, and whether no b has more for this a."""
        totals = self.parts.where("pair is not null").groupBy("pair").agg(F.sum("held").alias("n"))
        totals = totals.select(F.expr(f"pair div {self.size_b}").alias("a"), F.col("pair"), "n")
        most = F.max("n").over(Window.partitionBy("a"))  # an id has as many rows as B has ids at most
        return totals.select("a", F.expr(f"pair % {self.size_b}").alias("b"), "pair", "n", (F.col("n") == most).alias("best"))

    def documents(self) -> DataFrame:
        totals = self.pair_counts().select("pair", "n", "best")
        pairs = self.parts.where("pair is not null").select("block", "pair").join(totals, "pair").select("block", "pair", "n", "best")
        rows = self.parts.where("pair is null").drop("pair", "held").withColumnRenamed("block", "own_block")
        return rows.groupBy("own_block").cogroup(pairs.groupBy("block")).applyInArrow(_scored, _OUT_COLUMNS)


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> Alignment:
    """Aligns the tokens of each text under two tokenizers: byte-level A on a space and the text, pieces B on the text.

    ``documents()`` gives (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups) for each
    row; groups are null without ``with_groups``. Null and empty texts, and those whose tokens don't spell a
    space and the text, have zeros and the empty string. Texts are aligned whole. Every row is a document:
    repeated ones count as often as they occur, rows without an id too. An empty table gives none. Columns
    other than doc_id and text are left out, so their names can't clash. Special strings are plain text.
    """
    small_batches(docs.sparkSession)
    size_b = _loaded(path_a, path_b).size_b
    return Alignment(materialize(_parts(docs, path_a, path_b, with_groups), "aligned"), size_b)


def tokenizer_paths(a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(a), public_tokenizers.path(b)
