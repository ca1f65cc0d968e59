"""Best-fit packing: bounded-space online best-fit of token sequences.

A fixed number of bins is open at any time. They are kept in lists by free space, and one integer used
as a bitset says which free spaces have an open bin: the smallest fitting one is a shift and a lowest
set bit. If no bin fits and all may be open, the fullest closes.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from lotwise.llm.rows import small_batches

LENGTH = 2048
#: Of groups of about 10,000 pieces: sequences over the least possible are 1.0002 to 1.0008 (1280: 1.003 to 1.007; 2048: 1.0002, and none closes)
OPEN_BINS = 1536
GROUP_ROWS = 8192
LONG_RUN = 2000
_ENCODERS: dict[str, object] = {}

#: fixed value: the word pattern that belongs to the byte-level vocabulary
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids of a byte-level vocabulary file, those that its library's plain call gives.

    The library itself reads texts with an added token's string (``special=False`` makes that ordinary text),
    and texts with very long runs of letters or of white space. For all others its vocabulary is used as
    ranks, which gives the same ids in a fifth of the time.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.default = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = special = {t["content"] for t in spec.get("added_tokens", [])}
        byte_of = _byte_alphabet()
        ranks = {bytes(byte_of[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
        self.fast = tiktoken.Encoding("ranks", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str, special: bool = True) -> list[int]:
        if special and any(a in text for a in self.added):
            return self.default.encode(text, add_special_tokens=False).ids
        words = text.split()
        letters = sum(map(len, words))
        if max(map(len, words), default=0) > LONG_RUN or len(text) - letters - len(words) > LONG_RUN:
            return self.plain.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def _byte_alphabet() -> dict[str, int]:
    """Printable bytes stand for themselves in the vocabulary file, the others for 256, 257 and on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cuts(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; what doesn't fill a whole piece comes first."""
    if n <= length:
        return [(0, n)]
    first = n % length
    out = [(0, first)] if first else []
    return out + [(s, length) for s in range(first, n, length)]


def pieces(docs: DataFrame, path: str, length: int = LENGTH, groups: int = 1, with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, arrival_group[, ids]) of the tokenized texts.

    A document is its ids and then id 0; a null or empty text is the id 0 alone. Other columns of
    ``docs`` are left out, so their names can't clash. Pieces are dealt to the groups in turn.
    """
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, arrival_group long"
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("arrival_group", pa.int64())]
                       + ([("ids", pa.list_(pa.int64()))] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        turn = TaskContext.get().partitionId() * 7919
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                ids = np.array([*enc.ids(text), 0], dtype="<u4")
                for i, (start, size) in enumerate(cuts(len(ids), length)):
                    own = ids[start:start + size]
                    row = (doc_id, i, start, size, zlib.crc32(own.tobytes()), turn % groups, own.astype(np.int64))
                    for column, v in zip(out, row):
                        column.append(v)
                    turn += 1
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, fields + (", ids array<long>" if with_ids else ""))


def best_fit(sizes: list[int], length: int, open_bins: int) -> tuple[list[int], list[int]]:
    """Bin number and offset of each size, in order of arrival."""
    lists: list[list[int]] = [[] for _ in range(length + 1)]
    bits, opened, n_open = 0, 0, 0
    bins, offsets = [], []
    for size in sizes:
        fits = bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            number = lists[free].pop()
            if not lists[free]:
                bits ^= 1 << free
        else:
            if n_open >= open_bins:
                fullest = (bits & -bits).bit_length() - 1
                lists[fullest].pop()
                if not lists[fullest]:
                    bits ^= 1 << fullest
                n_open -= 1
            number, free = opened, length
            opened += 1
            n_open += 1
        bins.append(number)
        offsets.append(length - free)
        free -= size
        if free:
            if not lists[free]:
                bits |= 1 << free
            lists[free].append(number)
        else:
            n_open -= 1
    return bins, offsets


def pack(docs: DataFrame, path: str, length: int = LENGTH, open_bins: int = OPEN_BINS, group_rows: int = GROUP_ROWS,
         with_ids: bool = False) -> DataFrame:
    """Pieces with the sequence that holds them: adds sequence_id and offset to ``pieces``.

    Documents are dealt evenly to groups of about ``group_rows``; each is packed by itself, so no task
    holds more than a group, and a lost one is packed again alone. Within a group pieces arrive by
    falling length, so that the fullest bins, which close first, are full but for a few tokens. An empty table gives no rows;
    repeated rows are packed as often as they occur, equal lengths in order of doc_id, piece and ids.
    """
    small_batches(docs.sparkSession)
    groups = max(1, math.ceil(docs.count() / group_rows))
    cut = pieces(docs, path, length, groups, with_ids)
    schema = T.StructType([f for f in cut.schema.fields if f.name != "arrival_group"]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def one_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        bins, offsets = best_fit(rows["length"].tolist(), length, open_bins)
        rows["sequence_id"] = (int(key[0]) << 32) + np.array(bins, dtype=np.int64)
        rows["offset"] = np.array(offsets, dtype=np.int64)
        return rows[[f.name for f in schema.fields]]

    return cut.groupBy("arrival_group").applyInPandas(one_group, schema)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """The token sequences of ``pack(..., with_ids=True)``: sequence_id and its ids, piece after piece."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


__all__ = ["best_fit", "cuts", "encoder", "pack", "packed_sequences", "pieces", "tokenizer_path"]
