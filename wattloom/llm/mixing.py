"""Mixing sources to target weights by capped water-filling.

Each source gets its share of a total by weight. A source whose share is above ``max_epochs`` times
its size is clamped there, and what it can't take is shared among the others by weight, until no share is
above its cap. A source's target is then met by whole repetitions of all its documents and one seeded
fractional one: documents in the order of a hash of seed and doc_id, up to the words that are left.

The fractional cut is found without sorting a source: sizes are summed by source and hash slice, the slice
in which the cut falls follows from the sums, and only that slice's rows (one in SLICES) are put in order.

Defined cases: null text has size 0; a null source is a source of its own and comes last; a null doc_id
hashes as the empty text; rows that share doc_id and source are taken or left together; a source of size 0
has target 0; an empty table gives an empty plan. Columns other than the named ones are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import WORD
from wattloom.session import small_side, store

SLICES = 4096
WHOLE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: int) -> Column:
    """A 60-bit number from seed and doc_id, the same on every run and in every engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def slice_of(drawn: Column) -> Column:
    return F.shiftright(drawn, 48)


def measured(docs: DataFrame, seed: int) -> DataFrame:
    """One thin row for each document; written once, as every later step reads it."""
    return store(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), draw(F.col("doc_id"), seed).alias("drawn")), "mix")


def water_level(sources: DataFrame) -> tuple[int, int, int]:
    """Total, words fixed by clamped sources, weight of the free ones, once no free source is above its cap.

    Each round is one aggregate over the table of sources; clamping is monotone, so it ends.
    """
    first = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, fixed, free = int(first[0] or 0), 0, int(first[1] or 0)
    while free:
        full = F.col("cap").cast(WHOLE) * F.lit(free) <= F.lit(total - fixed).cast(WHOLE) * F.col("weight")
        found = sources.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        held, left = int(found[0] or 0), int(found[1] or 0)
        if left == free:
            break
        fixed, free = held, left
    return total, fixed, free


def mix_plan(sizes: DataFrame, max_epochs: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row for each source: size, target, whole repetitions, and the last (drawn, doc_id) of the fractional one."""
    by_slice = store(sizes.groupBy("source", slice_of(F.col("drawn")).alias("slice")).agg(F.sum("size").alias("words")), "mix")
    ranked = by_slice.groupBy("source").agg(F.sum("words").alias("source_size")).withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = store(ranked.select(
        "source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * max_epochs).alias("cap")), "mix")
    total, fixed, free = water_level(sources)
    share = F.col("weight").cast("double") * F.lit(float(total - fixed)) / F.lit(float(free)) if free else F.lit(0.0)
    target = F.least(share, F.col("cap").cast("double")) if free else F.col("cap").cast("double")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    planned = sources.withColumn("target", target).withColumn("epochs", epochs).withColumn(
        "rest", F.round("target").cast("long") - F.col("epochs") * F.col("source_size"))
    planned = store(planned.select("source", "source_size", "target", "epochs", "rest"), "mix")

    upto = Window.partitionBy("source").orderBy("slice")
    cuts = by_slice.withColumn("upto", F.sum("words").over(upto)).join(
        small_side(planned), by_slice["source"].eqNullSafe(planned["source"]), "left").where("upto > rest").groupBy(
        by_slice["source"]).agg(F.min_by(F.struct("slice", (F.col("upto") - F.col("words")).alias("below"), "rest"), "slice").alias("cut"))
    cuts = store(cuts.select("source", "cut.*"), "mix")
    drawn = sizes.alias("s").join(small_side(cuts).alias("c"), F.expr(
        "s.source <=> c.source and shiftright(s.drawn, 48) = c.slice")).groupBy(
        "s.source", "drawn", "doc_id", "below", "rest").agg(F.sum("size").alias("size"))
    so_far = F.col("below") + F.sum("size").over(Window.partitionBy("source").orderBy("drawn", F.col("doc_id").asc_nulls_first()))
    last = drawn.withColumn("so_far", so_far).where("2 * so_far - size <= 2 * rest").groupBy("source").agg(
        F.max(F.struct("drawn", "doc_id")).alias("last"))
    return store(planned.alias("p").join(cuts.alias("c"), F.expr("p.source <=> c.source"), "left").join(
        last.alias("l"), F.expr("p.source <=> l.source"), "left").select(
        "p.*", "c.slice", F.col("l.last.drawn").alias("last_drawn"), F.col("l.last.doc_id").alias("last_doc")), "mix")


def repeated(docs: DataFrame, plan: DataFrame, drawn: Column) -> DataFrame:
    """``docs`` with source_size, target and repetitions (whole ones, and one more inside the fractional cut)."""
    before = F.coalesce(slice_of(drawn) < F.col("p.slice"), F.col("p.rest") > 0)
    inside = (slice_of(drawn) == F.col("p.slice")) & ((drawn < F.col("p.last_drawn")) | (
        (drawn == F.col("p.last_drawn")) & (F.col("d.doc_id").isNull() | F.coalesce(F.col("d.doc_id") <= F.col("p.last_doc"), F.lit(False)))))
    extra = F.when(before | F.coalesce(inside, F.lit(False)), 1).otherwise(0)
    return docs.alias("d").join(small_side(plan).alias("p"), F.expr("d.source <=> p.source")).select(
        "d.*", "p.source_size", "p.target", (F.col("p.epochs") + extra).alias("repetitions"))


def mixed(docs: DataFrame, seed: int = 11, max_epochs: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """The mix itself: every column of ``docs``, each row as often as it is taken."""
    plan = mix_plan(measured(docs, seed), max_epochs, weights)
    whole = docs.select("doc_id", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = repeated(whole, plan, draw(F.col("d.doc_id"), seed)).where("repetitions > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repetitions")))).select("row.*")


def mix_report(docs: DataFrame, seed: int = 11, max_epochs: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """What the mix takes of each document."""
    sizes = measured(docs.select("doc_id", "source", "text"), seed)
    taken = repeated(sizes, mix_plan(sizes, max_epochs, weights), F.col("d.drawn"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repetitions")).alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS drawn
  FROM documents),
sources AS (
  SELECT source, source_size, weight, 3 * source_size AS cap FROM (
    SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source)),
filled AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0) AS free,
         coalesce(sum(cap) OVER lower, 0) AS fixed, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place
  FROM sources
  WINDOW lower AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT total, fixed, free FROM filled WHERE cap * free > (total - fixed) * weight ORDER BY place LIMIT 1),
planned AS (
  SELECT s.source, s.source_size, CASE WHEN l.free IS NULL THEN s.cap::DOUBLE
         ELSE least(s.weight::DOUBLE * (l.total - l.fixed)::DOUBLE / l.free::DOUBLE, s.cap::DOUBLE) END AS target
  FROM sources s LEFT JOIN level l ON true),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM planned),
ordered AS (
  SELECT s.doc_id, s.size, e.source_size, e.target, e.epochs, round(e.target)::BIGINT - e.epochs * e.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.drawn, s.doc_id) AS so_far
  FROM sized s JOIN epochs e ON s.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       size * (epochs + CASE WHEN rest > 0 AND 2 * so_far - size <= 2 * rest THEN 1 ELSE 0 END)::BIGINT AS taken
FROM ordered
"""
