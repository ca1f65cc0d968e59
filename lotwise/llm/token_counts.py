"""Token counts by rank-synchronous array merging.

A batch of texts becomes ragged arrays of symbols: runs of characters that some piece of the vocabulary
could join, each distinct run once. In every round all runs merge their own lowest-ranked pair at once;
the symbols that are left when no pair has a rank are the tokens.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.rows import small_batches

LIMIT = 4096
CHUNK_BYTES = 1 << 21
LONG_RUN = 256
COUNTS = "n_bytes long, n_tokens long, over_limit boolean"
BLANK = "▁"
_NONE = np.int32(2**31 - 1)
_LOADED: dict[str, "PieceTable"] = {}


class PieceTable:
    """Symbols, pair ranks and neighbouring characters of a piece vocabulary with byte fallback.

    Symbols are the pieces and the single characters in them; a further one for each number of bytes stands
    for characters that no piece holds, which count as so many byte tokens.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        pieces = {model.id_to_piece(i): model.get_score(i) for i in ids
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        if sum(map(model.is_byte, ids)) != 256 or any(map(model.is_unused, ids)) or model.encode(" ", out_type=str) != [BLANK * 2]:
            raise ValueError(f"{path} is no piece vocabulary with byte fallback and a leading blank")
        chars = sorted({c for p in pieces for c in p})
        number = {s: k for k, s in enumerate([*pieces, *(c for c in chars if c not in pieces)])}
        n = len(number)
        self.size = n + 5
        self.weight = np.ones(self.size, dtype=np.int64)
        self.weight[n:] = np.arange(5)
        for c in chars:
            if c not in pieces:
                self.weight[number[c]] = len(c.encode())
        self.of_char = np.full(0x110000, n + 4, dtype=np.int32)
        for width, top in ((3, 0x10000), (2, 0x800), (1, 0x80)):
            self.of_char[:top] = n + width
        self.of_char[[ord(c) for c in chars]] = [number[c] for c in chars]
        self.of_char[ord(" ")] = number[BLANK]

        rank_of = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        pairs = {}
        for piece, score in pieces.items():
            for k in range(1, len(piece)):
                a, b = number.get(piece[:k]), number.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = (rank_of[score], number[piece])
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()] + [_NONE], dtype=np.int32)
        self.into = np.array([pairs[k][1] for k in self.keys.tolist()] + [0], dtype=np.int32)

        joined = sorted({c for p in pieces if len(p) > 1 for c in p})
        self.group = np.zeros(self.size, dtype=np.int32)
        self.group[[number[c] for c in joined]] = np.arange(1, len(joined) + 1)
        self.meet = np.zeros((len(joined) + 1, len(joined) + 1), dtype=bool)
        for p in pieces:
            for x, y in zip(p, p[1:]):
                self.meet[self.group[number[x]], self.group[number[y]]] = True
        blank = self.group[number[BLANK]]
        #: whether a text may be cut before each blank that follows something else
        self.cut_at_blanks = not np.delete(self.meet[:, blank], blank).any()

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of each pair of symbols."""
        key = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.keys, key)
        at[self.keys[np.minimum(at, len(self.keys) - 1)] != key] = len(self.keys)
        return self.ranks[at], self.into[at]

    def tokens(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each run of symbols; run k is symbols[offsets[k]:offsets[k + 1]] and isn't empty."""
        out = np.zeros(len(offsets) - 1, dtype=np.int64)
        run = np.repeat(np.arange(len(out)), np.diff(offsets))
        rank = np.full(len(symbols), _NONE, dtype=np.int32)
        merged = np.zeros(len(symbols), dtype=np.int32)
        inner = np.flatnonzero(run[1:] == run[:-1])
        rank[inner], merged[inner] = self.pairs(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            low = np.minimum.reduceat(rank, starts)
            done = low == _NONE
            if done.any():
                np.add.at(out, run[starts[done]], np.add.reduceat(self.weight[symbols], starts)[done])
                left = ~np.repeat(done, sizes)
                symbols, run, rank, merged = symbols[left], run[left], rank[left], merged[left]
                low, sizes = low[~done], sizes[~done]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(low, sizes))
            # of pairs that overlap, every second one from the left
            first = np.r_[True, (np.diff(at) != 1)]
            at = at[(at - np.repeat(at[first], np.diff(np.r_[np.flatnonzero(first), len(at)]))) % 2 == 0]
            at, slow = self._in_order(symbols, run, rank, merged, at)
            new = merged[at]
            symbols[at] = new
            kept = np.ones(len(symbols), dtype=bool)
            kept[at + 1] = False
            symbols, run, rank, merged = symbols[kept], run[kept], rank[kept], merged[kept]
            at = at - np.arange(len(at))
            touched = np.zeros(len(symbols), dtype=bool)
            touched[at] = True
            touched[at[at > 0] - 1] = True
            near = np.flatnonzero(touched)
            inner = near[near + 1 < len(run)]
            inner = inner[run[inner] == run[inner + 1]]
            rank[near] = _NONE
            rank[inner], merged[inner] = self.pairs(symbols[inner], symbols[inner + 1])
            if len(slow):
                left = np.ones(len(symbols), dtype=bool)
                for k in slow:
                    own = slice(*np.searchsorted(run, [k, k + 1]))
                    out[k] = self._one_by_one(symbols[own].tolist())
                    left[own] = False
                symbols, run, rank, merged = symbols[left], run[left], rank[left], merged[left]
        return out

    def _in_order(self, symbols: np.ndarray, run: np.ndarray, rank: np.ndarray, merged: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the merges at ``at`` those that one-by-one merging would do next, and long runs that lost some.

        A merge can make a pair of its own rank or a lower one; merges to its right then have to wait.
        """
        new = merged[at]
        before, after = at - 1, at + 2
        left = symbols[np.maximum(before, 0)]
        follows = np.r_[False, at[1:] - at[:-1] == 2]
        left[follows] = new[:-1][follows[1:]]
        has_left = (before >= 0) & (run[np.maximum(before, 0)] == run[at])
        clipped = np.minimum(after, len(run) - 1)
        has_right = (after < len(run)) & (run[clipped] == run[at])
        own = rank[at]
        early = (has_left & (self.pairs(left, new)[0] <= own)) | (has_right & (self.pairs(new, symbols[clipped])[0] <= own))
        if not early.any():
            return at, at[:0]
        first = np.r_[True, run[at[1:]] != run[at[:-1]]]
        place = np.cumsum(early)
        earlier = place - early - np.repeat((place - early)[first], np.diff(np.r_[np.flatnonzero(first), len(at)]))
        waiting = np.unique(run[at[early]])
        sizes = np.searchsorted(run, waiting + 1) - np.searchsorted(run, waiting)
        return at[earlier == 0], waiting[sizes > LONG_RUN]

    def _one_by_one(self, symbols: list[int]) -> int:
        """Tokens of one long run by a heap of pairs, lowest rank and then leftmost first."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        ranks, into = self.pairs(np.array(symbols[:-1], dtype=np.int32), np.array(symbols[1:], dtype=np.int32))
        heap = [(r, k, symbols[k], symbols[k + 1], m) for k, (r, m) in enumerate(zip(ranks.tolist(), into.tolist())) if r != _NONE]
        heapq.heapify(heap)
        keys = {}

        def push(k: int) -> None:
            if k < 0 or after[k] >= n:
                return
            pair = (symbols[k], symbols[after[k]])
            if pair not in keys:
                r, m = self.pairs(np.array([pair[0]], dtype=np.int32), np.array([pair[1]], dtype=np.int32))
                keys[pair] = int(r[0]), int(m[0])
            r, m = keys[pair]
            if r != _NONE:
                heapq.heappush(heap, (r, k, *pair, m))

        while heap:
            _, k, a, b, m = heapq.heappop(heap)
            if not alive[k] or symbols[k] != a or after[k] >= n or symbols[after[k]] != b:
                continue
            gone = after[k]
            symbols[k], alive[gone], after[k] = m, False, after[gone]
            if after[k] < n:
                before[after[k]] = k
            push(before[k])
            push(k)
        return int(sum(self.weight[s] for s, ok in zip(symbols, alive) if ok))

    def counts(self, parts: list[bytes], opens: np.ndarray) -> np.ndarray:
        """Tokens of each part of a text; those that open a text are led by a blank. Parts aren't empty."""
        lengths = np.array([len(p.decode()) for p in parts])
        ends = np.cumsum(lengths + opens)
        symbols = np.empty(int(ends[-1]), dtype=np.int32)
        starts = ends - lengths - opens
        body = np.ones(len(symbols), dtype=bool)
        body[starts[opens]] = False
        symbols[body] = self.of_char[np.frombuffer(b"".join(parts).decode().encode("utf-32-le"), dtype="<u4")]
        symbols[starts[opens]] = self.of_char[ord(" ")]
        group = self.group[symbols]
        new_run = np.ones(len(symbols), dtype=bool)
        new_run[1:] = ~self.meet[group[:-1], group[1:]]
        new_run[starts] = True
        begin = np.flatnonzero(new_run)
        offsets = np.append(begin, len(symbols)).astype(np.int64) * symbols.itemsize
        runs = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(symbols)])
        runs = runs.dictionary_encode()
        distinct, place = runs.dictionary, runs.indices.to_numpy()
        bounds = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[:len(distinct) + 1] // symbols.itemsize
        flat = np.frombuffer(distinct.buffers()[2], dtype=np.int32)[:bounds[-1]].copy()
        return np.add.reduceat(self.tokens(flat, bounds)[place], np.searchsorted(begin, starts))

    def parts_of(self, text: bytes) -> Iterator[bytes]:
        """The text, or parts of about a chunk that end where no piece can reach across."""
        at, blank = 0, BLANK.encode()
        while len(text) - at > CHUNK_BYTES and self.cut_at_blanks:
            to = text.find(b" ", at + CHUNK_BYTES)
            while to > 0 and (text[to - 1:to] == b" " or text[to - 3:to] == blank):
                to = text.find(b" ", to + 1)
            if to < 0:
                break
            yield text[at:to]
            at = to
        yield text[at:]


def piece_table(path: str) -> PieceTable:
    if path not in _LOADED:
        _LOADED[path] = PieceTable(path)
    return _LOADED[path]


def count_batch(texts: pa.Array, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, tokens) of each text of an Arrow column."""
    n_bytes = np.zeros(len(texts), dtype=np.int64)
    n_tokens = np.zeros(len(texts), dtype=np.int64)
    parts: list[bytes] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if parts:
            opens = np.r_[owner[0] != last, np.diff(owner) != 0]
            np.add.at(n_tokens, owner, table.counts(parts, opens))
            parts.clear()
            owner.clear()
            held = 0

    last = -1  # the text whose earlier parts are counted already
    for k, text in enumerate(texts):
        data = text.as_buffer().to_pybytes() if text.is_valid else b""
        n_bytes[k] = len(data)
        if not data:
            continue
        for part in table.parts_of(data):
            parts.append(part)
            owner.append(k)
            held += len(part)
            if held >= CHUNK_BYTES:
                flush()
                last = k
    flush()
    return n_bytes, n_tokens


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "tokens", limit: int = LIMIT) -> DataFrame:
    """Adds struct ``out`` (n_bytes, n_tokens, over_limit) to each row, for the piece vocabulary at ``path``.

    Counts are those of the vocabulary's library without begin or end; special strings in a text are plain
    text. A null or empty text has 0 bytes and tokens. Texts of any length are counted whole, in parts that
    end where no piece reaches across; repeated rows have equal counts, an empty table none. A column
    named ``out`` is replaced; all others of the caller stay as they are.
    """
    small_batches(docs.sparkSession)

    @F.arrow_udf(COUNTS)
    def one(texts: pa.Array) -> pa.Array:
        n_bytes, n_tokens = count_batch(texts, piece_table(path))
        return pa.StructArray.from_arrays([pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)], ["n_bytes", "n_tokens", "over_limit"])

    return docs.withColumn(out, one(F.col(f"`{text}`").cast("string")))


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
