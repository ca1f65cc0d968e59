"""Mixing sources to target weights: blocks of words, drawn by shard, joined by index.

Each source's documents are laid end to end and cut into blocks of a fixed number of words. Every output
slot takes one block. The source counts of a shard's slots are a multinomial draw on condition that the
sources' totals meet their targets: a keyed permutation deals all draws to slots, so a shard's counts vary
as drawn without replacement. (Free multinomial draws would miss a target by the root of its size and
could pass a source's limit.) The k-th draw of a source takes block ``perm(k)`` of its own keyed
permutation, a fresh one in each round through the source. Only the last draw of a source is cut short.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.llm.rows import content_key, of, packed, unpacked
from lotwise.sources.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
SPACED_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
BLOCK_WORDS = 256
SHARD_SLOTS = 1024
CHUNK = 4096
BUCKET_ROWS = 8192
ROUNDS = 4
WALK = 40


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Text that names a source, null included."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, limit: float) -> DataFrame:
    """Adds weight and target to (source, source_size).

    Weights go round the sources by code point, null last. Where a target would pass ``limit`` times its
    source, it stops there and the rest is shared anew. In order of limit by weight the stopped sources
    come first, so the level of the others is that of the first one that stays below its limit.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
    rows = rows.withColumn("cap", F.lit(float(limit)) * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    rows = rows.withColumns({
        "place": F.row_number().over(by_cap),
        "level": (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after),
    })
    below = F.when(F.col("cap") > F.col("weight") * F.col("level"), F.struct("place", "level"))
    rows = rows.withColumn("first_below", F.min(below).over(everything))
    target = F.when(F.col("place") < F.coalesce(F.col("first_below.place"), F.lit(1 << 30)), F.col("cap")).otherwise(
        F.col("weight") * F.col("first_below.level"))
    return rows.select("source", "source_size", "weight", F.least(target, F.col("cap")).alias("target"))


def _scrambled(x: Column, wide: Column, high: Column, seed: Column, back: bool = False) -> Column:
    """One pass of a keyed bijection of 0..wide*high-1: rounds add a hash of one half to the other."""
    def one(state: Column, i: Column) -> Column:
        low, top = state["low"], state["top"]
        sign = F.lit(-1 if back else 1)
        moved_low = F.pmod(low + sign * F.pmod(F.xxhash64(seed, i, top), wide), wide)
        moved_top = F.pmod(top + sign * F.pmod(F.xxhash64(seed, i, low), high), high)
        return F.when(i % 2 == 1, F.struct(moved_low.alias("low"), top.alias("top"))).otherwise(
            F.struct(low.alias("low"), moved_top.alias("top")))

    rounds = range(ROUNDS, 0, -1) if back else range(1, ROUNDS + 1)
    start = F.struct(F.pmod(x, wide).alias("low"), F.floor(x / wide).cast("long").alias("top"))
    end = F.aggregate(F.array(*[F.lit(i) for i in rounds]), start, one)
    return F.transform(F.array(end), lambda s: s["low"] + wide * s["top"])[0]


def permuted(rows: DataFrame, out: str, x: Column, n: Column, seed: Column, back: bool = False) -> DataFrame:
    """Adds column ``out``, a keyed permutation of 0..n-1 applied to x (or its inverse).

    The bijection's domain is the smallest rectangle of about root(n) sides that holds n. A value outside
    0..n-1 goes through it again; at most root(n) values lie outside, so 40 passes always end for n below
    1,600 and leave a chance under 1 in 10^60 above.
    """
    wide = F.ceil(F.sqrt(n)).cast("long")
    rows = rows.withColumns({"_n": n, "_seed": seed, "_wide": F.greatest(wide, F.lit(1))})
    rows = rows.withColumn("_high", F.greatest(F.ceil(F.col("_n") / F.col("_wide")).cast("long"), F.lit(1)))
    again = lambda v: _scrambled(v, F.col("_wide"), F.col("_high"), F.col("_seed"), back)
    rows = rows.withColumn("_v", again(x))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.col("_v"),
                         lambda v, _: F.when(v >= F.col("_n"), again(v)).otherwise(v))
    return rows.withColumn(out, F.when(F.col("_v") < F.col("_n"), F.col("_v")).otherwise(walked)).drop(
        "_n", "_seed", "_wide", "_high", "_v")


@dataclass
class Mix:
    """``plan``: a row for each source; ``rows``: a row for each document with its place in its source."""

    docs: DataFrame
    plan: DataFrame
    rows: DataFrame
    block_words: int
    shard_slots: int
    seed: int

    def draws(self) -> DataFrame:
        """Output slots: shard, slot, source, round through the source, block, words taken of the block."""
        b = F.lit(self.block_words)
        every = Window.partitionBy()
        plan = self.plan.where("draws > 0").withColumn("all_draws", F.sum("draws").over(every))
        before = Window.orderBy("source_key").rowsBetween(Window.unboundedPreceding, -1)
        plan = plan.withColumn("first_draw", F.coalesce(F.sum("draws").over(before), F.lit(0)))
        chunks = plan.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("draws") - 1, F.lit(CHUNK).cast("long"))))
        n = int(self.docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        chunks = chunks.repartition(n, "source_key", "chunk")
        rows = chunks.withColumn("draw", F.explode(F.sequence("chunk", F.least(F.col("chunk") + CHUNK, F.col("draws")) - 1)))
        rows = permuted(rows, "slot", F.col("first_draw") + F.col("draw"), F.col("all_draws"), F.lit(self.seed))
        rows = rows.withColumns({"round": F.floor(F.col("draw") / F.col("blocks")).cast("long"), "k": F.col("draw") % F.col("blocks")})
        rows = permuted(rows, "block", F.col("k"), F.col("blocks"), F.xxhash64("source_key", "round", F.lit(self.seed)))
        length = F.when(F.col("block") == F.col("blocks") - 1, F.col("last_words")).otherwise(b)
        used = F.col("k") * b - F.when(F.col("k") > F.col("last_at"), b - F.col("last_words")).otherwise(0)
        take = F.when(F.col("round") < F.col("whole_rounds"), length).otherwise(F.least(length, F.col("rest") - used))
        return rows.select(F.floor(F.col("slot") / self.shard_slots).cast("long").alias("shard"), "slot", "source_key", "source",
                           "round", "block", take.alias("block_taken"))

    def parts(self) -> DataFrame:
        """Every document's parts in blocks, and for each draw of the block the words it takes of the part.

        A document without words has one part without a block. ``from_word`` counts from 0 in the document.
        """
        b = F.lit(self.block_words).cast("long")
        start, end = F.col("start"), F.col("start") + F.col("size")
        blocks = F.when(F.col("size") > 0, F.sequence(F.floor(start / b).cast("long"), F.floor((end - 1) / b).cast("long")))
        parts = self.rows.withColumn("block", F.explode(F.coalesce(blocks, F.array(-1 - F.col("row_in_bucket").cast("long")))))
        # the draws come from a small table, but there are as many as blocks: never broadcast them
        joined = parts.join(self.draws().drop("source").hint("merge"), ["source_key", "block"], "left")
        low = F.greatest(start, F.col("block") * b)
        high = F.least(end, F.col("block") * b + F.coalesce(F.col("block_taken"), F.lit(0)))
        return joined.withColumns({"from_word": low - start, "words": F.greatest(high - low, F.lit(0)).cast("long")})

    def taken(self) -> DataFrame:
        """doc_id, source, size, source_size, target and the words taken of each document, repeats counted."""
        per = self.parts().groupBy("source_key", "bucket", "row_in_bucket", "doc_id", "size").agg(F.sum("words").alias("taken"))
        return per.join(self.plan.select("source_key", "source", "source_size", "target"), "source_key").select(
            "doc_id", "source", "size", "source_size", "target", "taken")

    def documents(self) -> DataFrame:
        """The mixed documents: the columns of ``docs``, a row for each round that takes words of a document.

        ``text`` is what the round takes, white space between words kept; ``n_chars`` follows it.
        """
        per = self.parts().where("words > 0").groupBy("source_key", "bucket", "row_in_bucket", "doc_id", "size", "row_key", "round").agg(
            F.array_sort(F.collect_list(F.struct("from_word", "words"))).alias("ranges"), F.sum("words").alias("taken"))
        per = per.select("doc_id", "row_key", "size", "ranges", "taken")
        whole = packed(self.docs).withColumns({"id": of("doc_id"), "key": content_key(self.docs)}).dropDuplicates(["id", "key"])
        joined = whole.join(per, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("row_key")))
        words = F.regexp_extract_all(of("text"), F.lit(SPACED_WORD), F.lit(0))
        cut = F.transform(F.array(words), lambda w: F.array_join(F.transform(F.col("ranges"), lambda r: F.array_join(
            F.slice(w, (r["from_word"] + 1).cast("int"), r["words"].cast("int")), "")), ""))[0]
        text = F.when(F.col("taken") == F.col("size"), of("text")).otherwise(F.regexp_replace(cut, r"^[\x20\x09-\x0D]+", ""))
        return unpacked(joined, self.docs, {"text": text})


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, limit: float = 2.0,
        block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 17) -> Mix:
    """Plans the mix of ``docs`` (doc_id, text, source and any others), ``share`` times its words in all.

    Null texts have no words; null sources are one source, the last. Documents lie in their source by
    bucket (a hash of the row), doc_id and size, so equal runs give equal mixes, and rows that repeat lie
    side by side. An empty table gives an empty mix. No document is taken more than ``limit`` times when
    that is a whole number. The offsets in a source are sums of bucket sums, never one sort of a source.
    """
    buckets = max(1, math.ceil(docs.count() / BUCKET_ROWS))
    sized = materialize(packed(docs).select(
        of("doc_id").alias("doc_id"), of("source").cast("string").alias("source"), word_count(of("text")).alias("size"), content_key(docs).alias("row_key"),
    ).withColumns({"source_key": source_key(F.col("source")), "bucket": F.pmod(F.xxhash64("row_key"), F.lit(buckets))}), "sized")
    sums = sized.groupBy("source_key", "bucket").agg(F.first("source").alias("source"), F.sum("size").alias("bucket_size"))
    sizes = sums.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("bucket_size").alias("source_size"))
    plan = source_targets(sizes.select("source", "source_size"), weights, share, limit)
    b, size = F.lit(block_words).cast("long"), F.col("source_size")
    whole = F.when(size > 0, F.least(F.round("target").cast("long"), F.floor(F.lit(limit) * size)))
    plan = plan.withColumns({"source_key": source_key(F.col("source")), "goal": F.coalesce(whole, F.lit(0).cast("long"))})
    plan = plan.withColumns({
        "whole_rounds": F.when(size > 0, F.floor(F.col("goal") / size)).otherwise(0).cast("long"),
        "blocks": F.ceil(size / b).cast("long"),
    }).withColumns({"rest": F.col("goal") - F.col("whole_rounds") * size, "last_words": size - (F.col("blocks") - 1) * b})
    plan = permuted(plan, "last_at", F.col("blocks") - 1, F.col("blocks"),
                    F.xxhash64("source_key", "whole_rounds", F.lit(seed)), back=True)
    plain = F.ceil(F.col("rest") / b).cast("long")
    cut = F.greatest(F.col("last_at") + 1, F.ceil((F.col("rest") - F.col("last_words")) / b).cast("long") + 1)
    part = F.when(F.col("rest") <= 0, F.lit(0)).when(plain <= F.col("last_at"), plain).otherwise(cut)
    plan = materialize(plan.withColumn("draws", F.col("whole_rounds") * F.col("blocks") + part), "mix_plan")

    in_source = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source_key", "bucket", F.coalesce(F.sum("bucket_size").over(in_source), F.lit(0)).alias("base"))
    in_bucket = Window.partitionBy("source_key", "bucket").orderBy("doc_id", "size", "row_key")
    within = F.coalesce(F.sum("size").over(in_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = sized.drop("source").withColumns({"within": within, "row_in_bucket": F.row_number().over(in_bucket)})
    rows = rows.join(bases, ["source_key", "bucket"]).withColumn("start", F.col("base") + F.col("within")).drop("base", "within")
    return Mix(docs, plan, rows, block_words, shard_slots, seed)
