"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text's units are its words, or its characters where it has fewer than K words. Of every K units in a row the inner
substrings are single units here; the k-mer is an anchor if the smallest hash among them is at the first or last place.
The choice looks at nothing outside the k-mer, so equal passages choose equal anchors wherever they stand. The fingerprint is the anchors'
hashes in text order. Likeness is the share of common anchors: twice their number over the sum of both texts' distinct anchors.

Each document is put beside the next one by doc_id without a global sort: documents are dealt into ranges of doc_id, a window inside
each range looks one row ahead, and a range's last document sees a copy of the first one of the next range.

Defined cases: a null text is empty; texts with fewer than K characters, and those of whose k-mers none is closed, have one anchor, the whole text, so two empty
texts are alike; null doc_ids come last; rows that share a doc_id go by a hash of their text; the last document's next one is the
first, which with a single row is itself; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.session import store

K = 5
RANGES_PER_PARTITION = 4


def units(text: Column) -> Column:
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return F.when(F.size(words) >= K, words).otherwise(F.array_remove(F.split(text, ""), ""))


def anchors(hashes: Column) -> Column:
    """Hashes of the closed syncmers, in text order, from the units' hashes; null for fewer than K units."""
    at = lambda i, d: F.get(hashes, i + d)
    closed = F.filter(F.sequence(F.lit(0), F.size(hashes) - K), lambda i: F.least(
        *[at(i, d) for d in range(1, K - 1)]) >= F.least(at(i, 0), at(i, K - 1)))
    short = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    chosen = F.transform(closed, lambda i: short(F.xxhash64(*[at(i, d) for d in range(K)])))
    return F.when(F.size(hashes) >= K, chosen)


def whole_text(text: Column) -> Column:
    """The one anchor of a text that is too short to have others."""
    return F.array(F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))


def with_anchors(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the anchors of a text column; each step is a column of its own so that none is computed twice."""
    hashed = df.withColumn("_units", units(F.col(text))).withColumn("_hashes", F.transform("_units", lambda u: F.xxhash64(u)))
    chosen = hashed.withColumn("_chosen", anchors(F.col("_hashes")))
    return chosen.withColumn(name, F.when(F.size("_chosen") > 0, F.col("_chosen")).otherwise(whole_text(F.col(text)))).drop(
        "_units", "_hashes", "_chosen")


def fingerprint(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda a: F.lower(F.hex(a))), " ")


def likeness(a: Column, b: Column) -> Column:
    return 2.0 * F.size(F.array_intersect(a, b)) / (F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)))


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below the key, by two short searches; the null key lies in the last range."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    upto = lambda xs: F.size(F.filter(xs, lambda b: b <= key))
    part = F.greatest(upto(longs([p[0] for p in parts])) - 1, F.lit(0))
    inside = part * step + upto(F.get(F.array(*map(longs, parts)), part))
    return F.when(key.isNull(), len(bounds)).otherwise(inside)


def beside_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """doc_id, text and the next text, with one extra row at each range's end, and the window that orders a range."""
    spark = docs.sparkSession
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] or []
    rows = docs.withColumn("tie", F.xxhash64("text")).withColumn("range", range_of(F.col("doc_id"), sorted(set(cuts))))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    firsts = rows.groupBy("range").agg(F.min(key).alias("first"))
    in_order = Window.orderBy("range")  # one row for each range
    heads = store(firsts.select("first", F.coalesce(
        F.lag("range").over(in_order), F.max("range").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    ).alias("before")), "syncmers")
    extra = rows.join(F.broadcast(heads), (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))) & (F.col("tie") == F.col("first.tie"))).groupBy(
        "before").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("tie").alias("tie"))
    everything = rows.withColumn("extra", F.lit(False)).unionByName(
        extra.withColumnRenamed("before", "range").withColumn("extra", F.lit(True)))
    window = Window.partitionBy("range").orderBy("extra", F.col("doc_id").asc_nulls_last(), "tie")
    return everything.withColumn("next_text", F.lead("text").over(window)), window


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and its edited text, and how alike each is to the text's own."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    beside, window = beside_next(texts)
    sized = beside.withColumn("n_chars", F.length("text").cast("long")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    edited = F.concat(F.expr("substring(text, 1, int(n_chars) - half)"), F.expr("substring(next_text, 1, half)"))
    own = with_anchors(sized.withColumn("edited", edited), "text", "anchors")
    both = with_anchors(own.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_anchors").drop("text", "edited", "next_text")
    beside_anchors = both.withColumn("next_anchors", F.lead("anchors").over(window)).where("not extra")
    return beside_anchors.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("anchors")).alias("fingerprint"),
        fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"))
