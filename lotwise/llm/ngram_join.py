"""N-gram Jaccard join by vertical partitioning.

The global order of n-grams is that of their 64-bit hashes, cut into fragments at fixed values; a document's
set falls into one segment per fragment. Candidates are documents whose segments begin alike in some
fragment. The overlap of a pair is counted fragment by fragment and summed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.graph import components, hang
from lotwise.llm.rows import of, packed, small_batches, unpacked
from lotwise.llm.shingles import mixed, shingle_sets
from lotwise.sources.scratch import materialize

FRAGMENTS = 48
HEAD = 3
COUNTED = 4
#: Sets of this size or more need so many equal beginnings with others to be candidates.
SMALL_SET = 32
LEAST_HEADS = 3
BITMAP_BITS = 1 << 23
#: N-grams of more holders than this are compared in blocks of so many sets and n-grams.
FEW_HOLDERS = 8
BLOCK = 256
FRAGMENT_COLUMNS = 4096
PERCENT = 80


def _cuts(fragments: int) -> np.ndarray:
    return np.array([(k << 64) // fragments for k in range(1, fragments)], dtype=np.uint64)


def segment_heads(grams: np.ndarray, fragments: int = FRAGMENTS, head: int = HEAD) -> np.ndarray:
    """A hash of (fragment, its first ``head`` n-grams) for every fragment that isn't empty."""
    starts = np.concatenate([[0], np.searchsorted(grams, _cuts(fragments))])
    ends = np.append(starts[1:], len(grams))
    used = np.flatnonzero(ends > starts)
    out = mixed((used.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    for k in range(head):
        at = starts[used] + k
        gram = np.where(at < ends[used], grams[np.minimum(at, len(grams) - 1)], np.uint64(k + 1))
        out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + gram)
    return out


def gram_sets(docs: DataFrame, fragments: int = FRAGMENTS, head: int = HEAD) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, heads) of each document; equal sets have equal keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, heads = [], [], []
            for grams in shingle_sets(batch.column(2)):
                sizes.append(len(grams))
                keys.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                heads.append(segment_heads(grams, fragments, head).view(np.int64) if len(grams) else np.empty(0, np.int64))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                                   pa.array(heads, pa.list_(pa.int64()))], names=["doc_id", "text_key", "n_shingles", "set_key", "heads"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, n_shingles long, set_key binary, heads array<long>")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _similar_sizes(a: str, b: str) -> Column:
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    return 100 * low >= PERCENT * high


def _sieved(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose number occurs in ``wanted`` (one column), and some others.

    A bitmap of hashes, never over a megabyte of bits, is broadcast: it keeps most rows out of a shuffle, and
    the join that follows is exact.
    """
    def place(c: Column) -> tuple[Column, Column]:
        h = F.xxhash64(c)
        return F.floor(F.pmod(h, F.lit(BITMAP_BITS)) / 64), F.pmod(h, F.lit(64)).cast("int")

    word, bit = place(F.col(wanted.columns[0]))
    bitmap = wanted.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    word, bit = place(F.col(column))
    return rows.join(F.broadcast(bitmap), word == F.col("_word")).where(F.call_function("getbit", F.col("_bits"), bit) == 1).drop("_word", "_bits")


def _overlapping(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """Pairs (a, b) that link: overlaps are counted for each fragment by itself and summed per pair.

    A set that very many others are compared with is met fragment by fragment, on either side of a pair.
    """
    one = _sieved(segments, "id", pairs.select("a")).select(F.col("id").alias("a"), "fragment", F.col("grams").alias("grams_a"))
    two = _sieved(segments, "id", pairs.select("b")).select(F.col("id").alias("b"), "fragment", F.col("grams").alias("grams_b"))
    each = pairs.withColumn("fragment", F.explode(F.array(*[F.lit(k) for k in range(COUNTED)])))
    partial = each.join(one, ["a", "fragment"]).join(two, ["b", "fragment"]).select(
        "a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("part"))
    whole = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("part").alias("shared"))
    return whole.where(100 * F.col("shared") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b")


def _segments_of(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, fragment, grams) of the wanted sets (set_key, id), from the text of one document each."""
    holders = sets.join(wanted, "set_key").groupBy("id").agg(F.min(F.struct("doc_id", "text_key")).alias("h"))
    holders = materialize(holders.select(_row_name(F.col("h.doc_id"), F.col("h.text_key")).alias("_name"), F.col("h.text_key"), "id"), "holders")
    rows = docs.select(_row_name(F.col("doc_id"), text_key(F.col("text"))).alias("_name"), text_key(F.col("text")).alias("text_key"), F.col("text").cast("string").alias("text"))
    rows = _sieved(rows, "text_key", holders.select("text_key")).select("_name", "text")
    # rows are alike where the name is; the join has them by name already
    texts = rows.join(holders.select("_name", "id"), "_name").dropDuplicates(["_name"]).select("id", "text")
    schema = pa.schema([("id", pa.int64()), ("fragment", pa.int32()), ("grams", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, places, parts = [], [], []
            for number, grams in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1))):
                for k, part in enumerate(np.split(grams, np.searchsorted(grams, _cuts(COUNTED)))):
                    if len(part):
                        numbers.append(number)
                        places.append(k)
                        parts.append(part.view(np.int64))
            yield pa.record_batch([pa.array(v, f.type) for v, f in zip((numbers, places, parts), schema)], schema=schema)

    return materialize(texts.mapInArrow(run, "id long, fragment int, grams array<long>"), "segments")


def _links_across(segments: DataFrame, placed: DataFrame) -> DataFrame:
    """Links (a, b) that join different components, from sets that share one of their rarest n-grams.

    Only n-grams held by two components can join them. Of n n-grams, by rising number of such holders, the
    first ``n - ceil(0.8 n) + 1`` of both sets of a link share one; n-grams within a component come first
    and meet nobody. If those are ``own``, a link has ``own_a + own_b <= (n_a + n_b) / 9``, so one of its
    sets has at most a ninth of its own: sets with more never meet each other.

    N-grams of a few holders give pairs. Sets that share others, as families of half-similar texts do, are
    compared in blocks that give out a root for each linked set, never pairs.
    """
    placed = placed.select("id", "n", F.col("component").alias("place"))
    grams = segments.join(placed.select("id", "place"), "id").select("id", "place", F.explode("grams").alias("gram"))
    held = grams.groupBy("gram").agg(F.min("place").alias("lo"), F.max("place").alias("hi"), F.count(F.lit(1)).alias("holders"))
    cross = materialize(grams.join(held.where("lo <> hi").select("gram", "holders"), "gram").select("id", "holders", "gram"), "cross_grams")
    counts = cross.groupBy("id").agg(F.count(F.lit(1)).alias("n_cross"))
    needed = F.col("n") - F.ceil(F.lit(PERCENT) * F.col("n") / 100) + 1
    left = placed.join(counts, "id").withColumns({"own": F.col("n") - F.col("n_cross"), "ranked": (needed - F.col("n") + F.col("n_cross")).cast("int")})
    left = materialize(left.where("ranked > 0"), "open_ranks")
    order = F.array_sort(F.collect_list(F.struct("holders", "gram")))
    lists = cross.join(left.select("id"), "id", "left_semi").groupBy("id").agg(order.alias("by_rarity"))
    lists = materialize(left.join(lists, "id"), "gram_lists")
    rare = lists.select("id", "n", "own", "place", F.explode(F.slice("by_rarity", F.lit(1), F.col("ranked"))).alias("g"))
    rare = rare.select(F.col("g.gram").alias("gram"), "id", "n", "own", "place")
    clean = 9 * F.col("own") <= F.col("n")
    held = rare.groupBy("gram").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("least"))
    rare = materialize(rare.join(held.where("members > 1"), "gram").withColumn("clean", clean), "rare_grams")

    few = rare.where(F.col("members") <= FEW_HOLDERS)
    one = few.where("clean").select("gram", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("own").alias("own_a"), F.col("place").alias("place_a"))
    two = few.select("gram", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("own").alias("own_b"), F.col("place").alias("place_b"), "clean")
    may = (F.col("place_a") != F.col("place_b")) & (~F.col("clean") | (F.col("a") < F.col("b"))) & _similar_sizes("n_a", "n_b")
    pairs = one.join(two, "gram").where(may & (9 * (F.col("own_a") + F.col("own_b")) <= F.col("n_a") + F.col("n_b")))
    pairs = materialize(pairs.select("a", "b", "n_a", "n_b").distinct(), "rare_pairs")
    alone = _overlapping(pairs, segments)

    many = rare.where((F.col("members") > FEW_HOLDERS) & (F.col("id") != F.col("least")))
    family = components(many.select(F.col("id").alias("a"), F.col("least").alias("b")))
    family = family.select(F.col("node").alias("id"), F.col("component").alias("family"))
    sizes = family.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = lists.join(family, "id").join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("family", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "n", "own", "place",
                             F.transform("by_rarity", lambda g: g["gram"]).alias("grams"))
    blocks = members.groupBy("family", "low", "high").applyInPandas(_linked_in_block, "a long, b long")
    return alone.unionByName(blocks)


def _linked_in_block(rows: pd.DataFrame) -> pd.DataFrame:
    """(set, root) for the sets of a block pair that link across components.

    Overlaps are products of 0/1 matrices, one for each fragment of the n-gram order, and add up.
    """
    rows = rows.sort_values("id").reset_index(drop=True)
    n, own, place = (rows[c].to_numpy() for c in ("n", "own", "place"))
    sizes = rows["grams"].map(len).to_numpy()
    names, column, holders = np.unique(np.concatenate(rows["grams"].to_list()), return_inverse=True, return_counts=True)
    owner, shared = np.repeat(np.arange(len(rows)), sizes), np.cumsum(holders > 1) - 1
    kept = holders[column] > 1
    owner, column = owner[kept], shared[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    overlap = np.zeros((len(rows), len(rows)), dtype=np.float32)
    for low in range(0, int((holders > 1).sum()), FRAGMENT_COLUMNS):
        at = slice(*np.searchsorted(column, [low, low + FRAGMENT_COLUMNS]))
        part = np.zeros((len(rows), FRAGMENT_COLUMNS), dtype=np.float32)
        part[owner[at], column[at] - low] = 1
        overlap += part @ part.T
    linked = (100 * overlap >= PERCENT * (n[:, None] + n[None] - overlap)) & (place[:, None] != place[None])
    a, b = np.nonzero(np.triu(linked, 1))
    root = hang(np.arange(len(rows)), a, b)
    used = np.unique(np.concatenate([a, b]))
    keys = rows["id"].to_numpy()
    return pd.DataFrame({"a": keys[used], "b": keys[root[used]]})


def _row_name(doc_id: Column, key: Column) -> Column:
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), F.hex(key))


def similar_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, first) of each document over links of Jaccard 0.8 or more.

    ``first`` marks the rows with the smallest (doc_id, text_key) of their group. Null and empty texts have
    no shingles and no links. Rows without an id link like others; their group's id is its smallest one, or
    null if it has none. Repeated rows stay as many rows.

    Equal sets are one vertex. Pairs are never listed within a group: each vertex is first compared with
    the most connected vertex of each of its buckets. Vertices that still have buckets with other components
    are then matched across components by their rarest n-grams, which loses no link that joins two.

    Two sets with a Jaccard of 0.8 begin alike in a fragment of 3 or more n-grams with a chance of 0.51, so
    the chance of fewer than 3 of 48 is 1e-12; smaller sets have more equal segments than differences.
    """
    small_batches(docs.sparkSession)
    sets = materialize(gram_sets(docs), "gram_sets")
    vertices = sets.where("set_key is not null").groupBy("set_key").agg(
        F.first("n_shingles").alias("n"), F.first("heads").alias("heads"))
    # written once, so the numbers stay what they are
    vertices = materialize(vertices.withColumn("id", F.monotonically_increasing_id()), "vertices")
    sizes = vertices.select("id", "n")
    heads = vertices.select("id", F.explode("heads").alias("head"))
    shared = heads.groupBy("head").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    bucketed = materialize(heads.join(shared, "head"), "buckets")
    counts = bucketed.groupBy("id").agg(F.sum("members").alias("reach"), F.count(F.lit(1)).alias("heads"))
    counts = materialize(counts.join(sizes, "id"), "bucket_counts")
    placed = bucketed.join(counts.select("id", "reach", "n"), "id").select("head", "id", "reach", "n")
    centre = placed.groupBy("head").agg(F.max(F.struct("reach", "id", "n")).alias("c"))
    star = placed.join(centre, "head").select(
        F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b"),
        F.when(F.col("id") < F.col("c.id"), F.col("n")).otherwise(F.col("c.n")).alias("n_a"),
        F.when(F.col("id") < F.col("c.id"), F.col("c.n")).otherwise(F.col("n")).alias("n_b"))
    star = star.where((F.col("a") != F.col("b")) & _similar_sizes("n_a", "n_b")).groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("heads"))
    known = F.col("heads") >= F.when(F.col("n") >= SMALL_SET, LEAST_HEADS).otherwise(1)
    star = materialize(star.withColumn("n", F.least("n_a", "n_b")).where(known).drop("n", "heads"), "star_pairs")
    candidates = counts.where(known).select("id")
    segments = _segments_of(docs, sets, vertices.select("set_key", "id").join(candidates, "id"))
    links = materialize(_overlapping(star, segments), "star_links")
    joined = components(links)

    placed = bucketed.select("head", "id").join(joined.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    split = placed.groupBy("head").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("head")
    open_sets = placed.join(split, "head").groupBy("id", "component").agg(F.count(F.lit(1)).alias("heads"))
    open_sets = materialize(open_sets.join(sizes, "id").where(known), "open_sets")
    more = materialize(_links_across(segments, open_sets), "links_across")
    joined = components(links.unionByName(more)) if more.take(1) else joined

    of_set = sets.where("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("row"))
    groups = vertices.select("set_key", "id").join(joined.withColumnRenamed("node", "id"), "id", "left")
    groups = groups.select("set_key", F.coalesce("component", "id").alias("_group"))
    of_set = materialize(of_set.join(groups, "set_key").select("set_key", "_group", "least", "row"), "set_groups")
    per = of_set.groupBy("_group").agg(F.min("least").alias("component_id"), F.min("row").alias("row"))
    classes = of_set.select("set_key", "_group").join(per, "_group").select(
        F.col("set_key").alias("_set"), "component_id", F.col("row.doc_id").alias("_first_id"), F.col("row.text_key").alias("_first_key"))
    out = sets.drop("heads").join(classes, F.col("set_key") == F.col("_set"), "left")
    alone = F.col("set_key").isNull()
    first = F.col("doc_id").eqNullSafe(F.col("_first_id")) & (F.col("text_key") == F.col("_first_key"))
    return out.select("doc_id", "text_key", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.when(alone, F.lit(True)).otherwise(first).alias("first"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id; rows without words stay once per id."""
    kept = similar_groups(docs).where("first").select(_row_name(F.col("doc_id"), F.col("text_key")).alias("_name")).distinct()
    named = packed(docs).withColumn("_name", _row_name(of("doc_id"), text_key(of("text"))))
    return unpacked(named.join(kept, "_name", "left_semi").dropDuplicates(["_name"]), docs, {})
