"""Secret scans: base patterns in each text, and ownership counts of candidates over the corpus.

A candidate that many owners hold is a copied example; one that a single owner holds, and that looks
random, is likely a live credential. Counting is an aggregation over (value hash, owner, repository) in
steps that each combine before the shuffle, so a value held by a third of the rows is a few rows a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.rows import of, packed, unpacked
from lotwise.sources.scratch import materialize

# ---- fixed values: the patterns of the base kinds, in the order in which kinds are listed ----
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
          r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_KEPT = ASSIGN[:-2] + "{8,})"
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex")
#: What else may be a secret: prefixed provider keys, key blocks, credentials in addresses, long mixed runs.
PROVIDER = r"(?:gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|AIza[A-Za-z0-9_-]{30,}|glpat-[A-Za-z0-9_-]{16,}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})"
KEY_BLOCK = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
LOGIN = r"[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/@]+@"
MIXED = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9A-Z+/_=-]*[a-z])[A-Za-z0-9+/_=-]{20,}"
EXTRA = f"(?:{PROVIDER}|{KEY_BLOCK}|{LOGIN}|{MIXED})"
EXAMPLE_OWNERS = 3
MIN_VARIETY = 0.3


def located(text: Column, pattern: str, kind: str, hint: str | None = None) -> Column:
    """Spans (kind, start, end, value) of all matches in code points, from the text's split at them.

    Only texts that match ``hint``, by default the pattern, are split. The gaps and the matches alternate, so a running sum of their lengths gives each place.
    """
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(gaps.alias("gap"), found.alias("hit"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>").alias("spans"))

    def step(acc: Column, one: Column) -> Column:
        start = acc["at"] + F.length(one["gap"])
        end = start + F.length(one["hit"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), one["hit"].alias("value"))
        return F.struct(F.coalesce(end, start).alias("at"),
                        F.when(one["hit"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span))).alias("spans"))

    return F.when(text.rlike(hint or pattern), F.aggregate(both, zero, step, lambda acc: acc["spans"])).otherwise(zero["spans"])


def _in_order(spans: Column) -> Column:
    """By start, then kind as listed; kinds of the method after those of the base."""
    place = lambda s: F.struct(s["start"].alias("start"), F.coalesce(F.nullif(
        F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]), F.lit(0)), F.lit(9)).alias("rank"), s.alias("span"))
    return F.transform(F.array_sort(F.transform(spans, place)), lambda s: s["span"])


def _joined(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def base_spans(text: Column) -> Column:
    """Array of base spans of a text (null: none). An assignment counts with a value of 8 or more characters.

    Shorter assignments still use up their text. Runs of the other kinds are as long as they can be, so
    asking for the length in the pattern finds the same ones.
    """
    text = F.coalesce(text, F.lit(""))
    assign = F.filter(located(text, ASSIGN, "assign"), lambda s: s["value"].rlike(f"^{ASSIGN_KEPT}$"))
    return _in_order(F.concat(assign, located(text, ACCESS, "access"), located(text, HEX, "hex")))


def secret_value(span: Column) -> Column:
    """The credential in a span: what stands after an assignment's sign, else the whole match."""
    return F.when(span["kind"] == "assign", F.regexp_extract(span["value"], ASSIGN, 2)).otherwise(span["value"])


def _variety(value: Column) -> Column:
    """Distinct characters by length, up to 32: random keys have many, placeholders like xxxx few."""
    return F.size(F.array_distinct(F.split(value, ""))) / F.least(F.length(value), F.lit(32))


def _row_key(*values: Column) -> Column:
    """With the doc_id, what tells rows apart whose spans may differ: owner, repository and text."""
    return F.xxhash64(*[F.coalesce(v.cast("string"), F.lit("")) for v in values])


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """A row for each document with its spans and what the corpus says of each.

    Columns: doc_id, row_key, ``base`` (spans of the base kinds), ``extra`` (spans of kind ``live`` that the method
    adds: further candidates, held by one owner only and varied enough) and ``n_live``, ``n_example`` over
    the credentials of all spans: live ones have fewer owners than ``example_owners``. Null texts are
    empty; null owners and repositories each count as one. Repeated rows give equal rows, and no row is
    lost or added. Other columns of ``docs`` are left out. ``live_places`` are where live credentials stand.
    """
    rows = docs.select(F.col("doc_id"), _row_key(F.col(owner), F.col(repository), F.col("text")).alias("row_key"),
                       F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
                       F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "row_key", "owner", "repository",
                       base_spans(F.col("text")).alias("base"), located(F.col("text"), EXTRA, "live").alias("others"))
    crossing = lambda s: F.exists(F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    rows = rows.withColumn("others", F.filter("others", lambda s: ~crossing(s)))
    rows = materialize(rows, "secret_spans")

    spans = rows.where((F.size("base") > 0) | (F.size("others") > 0)).select(
        "doc_id", "row_key", "owner", "repository", F.explode(F.concat("base", "others")).alias("span"))
    value = secret_value(F.col("span"))
    spans = spans.select("doc_id", "row_key", "owner", "repository", "span", F.length(value).alias("size"), F.sha2(value, 256).alias("value_hash"),
                         (_variety(value) >= MIN_VARIETY).alias("varied"))
    held = spans.groupBy("value_hash", "owner", "repository").agg(F.lit(1).alias("one"))
    owners = held.groupBy("value_hash", "owner").agg(F.count("one").alias("repositories"))
    counts = owners.groupBy("value_hash").agg(F.count("owner").alias("owners"), F.sum("repositories").alias("repositories"))
    # equal rows hold equal spans: judge each (row, span) once, then bring it back to all of them
    mine = spans.select("doc_id", "row_key", "span", "size", "value_hash", "varied").distinct().join(counts, "value_hash")
    live = F.col("varied") & (F.col("owners") < example_owners)
    added = (F.col("span.kind") == "live") & F.col("varied") & (F.col("owners") == 1)
    per = mine.groupBy("doc_id", "row_key").agg(
        F.sum(live.cast("long")).alias("n_live"), F.sum((F.col("owners") >= example_owners).cast("long")).alias("n_example"),
        F.array_sort(F.collect_list(F.when(live, F.struct((F.col("span.end") - F.col("size")).alias("start"), F.col("span.end").alias("end"))))).alias("live_places"),
        F.array_sort(F.collect_list(F.when(added, F.struct("span.start", "span.end", "span.kind", "span.value")))).alias("added"))
    per = per.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), "n_live", "n_example", "live_places",
                     F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                             s["value"].alias("value"))).alias("extra"))
    plain = (F.size("base") == 0) & (F.size("others") == 0)
    judged = rows.where(~plain).join(per, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_key") == F.col("_key")), "left")
    names = ["doc_id", "row_key", "base", "extra", "n_live", "n_example", "live_places"]
    none = rows.where(plain).withColumns({"extra": F.col("base"), "n_live": F.lit(0).cast("long"), "n_example": F.lit(0).cast("long"),
                                          "live_places": F.array().cast("array<struct<start:int,end:int>>")})
    return judged.select(*names).unionByName(none.select(*names))


def digest(scanned: DataFrame) -> DataFrame:
    """The counts and joined spans of ``scan``."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(_in_order(F.concat("base", "extra"))).alias("spans"), "n_live", "n_example")


def redact(docs: DataFrame, mask: str = "[secret]", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """``docs`` with live credentials masked and examples left; of an assignment only the value goes.

    ``n_chars`` follows. Only rows in which some pattern occurs are joined with their spans.
    """
    places = scan(docs, owner, repository).where(F.size("live_places") > 0).dropDuplicates(["doc_id", "row_key"]).select(
        "doc_id", "row_key", "live_places")
    rows, text = packed(docs), of("text")
    possible = F.coalesce(text.rlike(f"{ASSIGN}|{ACCESS}|{HEX}|{EXTRA}"), F.lit(False))
    some = rows.where(possible).withColumns({"id": of("doc_id"), "key": _row_key(of(owner), of(repository), text)})
    some = some.join(places, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("row_key")), "left")

    def step(acc: Column, one: Column) -> Column:
        more = F.concat(acc["out"], F.substr(text, acc["at"] + 1, one["start"] - acc["at"]), F.lit(mask))
        return F.struct(F.greatest(acc["at"], one["end"]).alias("at"), F.when(one["start"] >= acc["at"], more).otherwise(acc["out"]).alias("out"))

    masked = F.aggregate("live_places", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                         lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
    changed = unpacked(some, docs, {"text": F.when(F.col("live_places").isNull(), text).otherwise(masked)})
    return changed.unionByName(unpacked(rows.where(~possible), docs, {}))
