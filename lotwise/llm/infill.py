"""Fill-in-middle transformation: blocks of a text exchanged in place by rotations.

Two cuts part a text into prefix, middle and suffix. A scan over the bytes finds the cuts, sentinels go in
at the cuts of a bytearray, and one rotation (three reversals) brings the suffix to its place: before the
middle (psm), or before everything (spm). The inverse rotation restores the text exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.rows import small_batches

SENTINELS = ("<P>", "<S>", "<M>")
SCAN_BYTES = 1 << 20
FIM = "n long, form string, prefix_chars long, middle_chars long, output string"


def scan(data: np.ndarray, cuts: tuple[int, ...]) -> list[int]:
    """Byte offsets of rising code-point cuts in UTF-8, block after block."""
    out, seen = [], 0
    for at in range(0, len(data), SCAN_BYTES):
        block = data[at:at + SCAN_BYTES]
        first = (block & 0xC0) != 0x80
        here = int(np.count_nonzero(first))
        while len(out) < len(cuts) and cuts[len(out)] < seen + here:
            out.append(at + int(np.flatnonzero(first)[cuts[len(out)] - seen]))
        seen += here
    return out + [len(data)] * (len(cuts) - len(out))


def code_points(data: np.ndarray) -> int:
    return sum(int(np.count_nonzero((data[at:at + SCAN_BYTES] & 0xC0) != 0x80)) for at in range(0, len(data), SCAN_BYTES))


def _reverse(data: np.ndarray, low: int, high: int) -> None:
    half = (high - low) // 2
    left, right = data[low:low + half], data[high - half:high][::-1]
    kept = left.copy()
    left[:] = right
    right[:] = kept


def rotate(data: bytearray, low: int, middle: int, high: int) -> None:
    """Exchanges data[low:middle] and data[middle:high] where they lie."""
    view = np.frombuffer(data, dtype=np.uint8)
    _reverse(view, low, middle)
    _reverse(view, middle, high)
    _reverse(view, low, high)


def draws(doc_id: object, seed: int = 1) -> tuple[int, int, int, int]:
    """The first four 8-digit groups of the sha256 of ``seed:doc_id``; a null id counts as the word null."""
    h = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(h[k:k + 8], 16) for k in range(0, 32, 8))


def transform(text: bytes, doc_id: object, seed: int = 1, fim_percent: int = 90, spm_percent: int = 20,
              sentinels: tuple[str, str, str] = SENTINELS) -> tuple[int, str, int | None, int | None, bytes]:
    """(code points, form, code points of prefix and middle, output)."""
    p, s, m = (x.encode() for x in sentinels)
    view = np.frombuffer(text, dtype=np.uint8)
    n = code_points(view)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= fim_percent or any(x in text for x in (p, s, m)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    low, high = scan(view, (first, second))
    form = "spm" if h4 % 100 < spm_percent else "psm"
    data = bytearray(text)
    data[high:high] = s
    data[low:low] = m
    data[:0] = p
    rotate(data, 0 if form == "spm" else len(p) + low, len(p) + len(m) + high, len(data))
    return n, form, first, second - first, bytes(data)


def restored(output: bytes, form: str, sentinels: tuple[str, str, str] = SENTINELS) -> bytes:
    """The text of an output. No sentinel begins inside another or in the text, so the first match is the one put in."""
    if form == "plain":
        return output
    p, s, m = (x.encode() for x in sentinels)
    data = bytearray(output)
    start = data.index(s)
    end = data.index(p if form == "spm" else m)
    rotate(data, start, end, len(data))
    low, high = data.index(m), start + len(data) - end
    del data[high:high + len(s)]
    del data[low:low + len(m)]
    del data[:len(p)]
    return bytes(data)


def _check(sentinels: tuple[str, str, str]) -> None:
    """Sentinels that overlap could be found where none was put in."""
    apart = all(a[-k:] != b[:k] for a in sentinels for b in sentinels for k in range(1, min(len(a), len(b))))
    within = any(sentinels[i] in sentinels[j] for i in range(3) for j in range(3) if i != j)
    if not all(sentinels) or not apart or within:
        raise ValueError(f"sentinels {sentinels} are empty, equal, parts of each other or overlap")


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", out: str = "fim", seed: int = 1,
                   fim_percent: int = 90, spm_percent: int = 20, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Adds struct ``out`` (n, form, prefix_chars, middle_chars, output) to each row.

    Cuts and form follow from the sha256 of ``seed:key``, so reruns and repeated rows agree. A null text is
    empty; empty texts and those that hold a sentinel stay ``plain``, with null lengths. Texts of any length
    are cut whole. A null key counts as the word null. An empty table gives none. A column named ``out``
    is replaced; all others of the caller stay as they are.
    """
    _check(sentinels)
    small_batches(docs.sparkSession)

    @F.arrow_udf(FIM)
    def one(texts: pa.Array, keys: pa.Array) -> pa.Array:
        done = [transform(t.as_buffer().to_pybytes() if t.is_valid else b"", k, seed, fim_percent, spm_percent, sentinels)
                for t, k in zip(texts, keys.to_pylist())]
        columns = list(zip(*done)) if done else [()] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        parts = [pa.array(c, k) for c, k in zip(columns, kinds)] + [pa.array(columns[4], pa.binary()).cast(pa.string())]
        return pa.StructArray.from_arrays(parts, ["n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.withColumn(out, one(F.col(f"`{text}`").cast("string"), F.col(f"`{key}`").cast("string")))


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The exact text behind an output and its form; null where either is null."""
    @F.arrow_udf("string")
    def one(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        back = [restored(o.as_buffer().to_pybytes(), f, sentinels) if o.is_valid and f is not None else None
                for o, f in zip(outputs, forms.to_pylist())]
        return pa.array(back, pa.binary()).cast(pa.string())

    return one(output, form)
