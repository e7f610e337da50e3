"""URL filter: allow and block rules, and a character language-model ratio for what no rule fits.

Two variable-order Markov models, one of URLs that a rule allows and one of those that a rule blocks, give each character's
probability after up to ORDER characters before it. Witten-Bell smoothing mixes each order with the next shorter one. The score is
the difference of the two log-likelihoods over the length. The threshold is calibrated on labelled URLs that took no part in the
counts: the score at which the shares of wrongly blocked and wrongly allowed ones are least in sum.

All of it is DataFrame functions. The characters modelled are those of the whole url as it stands; only the rules read host and path. Equal
urls are counted and scored once. A probability is kept as its change from the next shorter order, so that a string's log-likelihood is
a plain sum over joined rows: the change of an observed continuation, the discount of a context that never saw it, nothing for an unseen context.

Defined cases: a null url, or one without ://, has an empty host and path and fits no rule; a null url scores as the empty string (0, no
difference); without labelled URLs of one kind the threshold is 0 and the missing model says nothing; repeated
rows are judged one by one; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.session import small_side, store

ORDER = 4
HELD_OUT = 5
LEAST_CONTEXT = 2
ALPHABET = 256
PIECE = 64
#: (rule, verdict): hosts of the rule and below, paths that start with the rule's.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    part = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return ascii_lower(part(1)), part(2)


def rule_for(rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits; reads host and path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, path = text.partition("/")
        fits = ((F.col("host") == domain) | F.endswith(F.col("host"), F.lit("." + domain))) & F.startswith(F.col("path"), F.lit(slash + path))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def grams(strings: DataFrame) -> DataFrame:
    """One row for each character and order: the characters before it and itself. A start mark stands before the first.

    A string is cut into pieces of PIECE characters, each with the ORDER ones before it, so that a character of a very long string costs no more than
    one of a short string. Rows carry the string's ``id`` and the piece, not the string. A small table may lie in one task and is spread first.
    """
    tasks = int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = strings.repartition(tasks, "id").withColumn(
        "pieces", F.regexp_extract_all(F.concat(F.lit("\u0002"), F.col("chars")), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).drop("chars")
    led = F.transform("pieces", lambda piece, k: F.concat(F.coalesce(F.right(F.get("pieces", k - 1), F.lit(ORDER)), F.lit("")), piece))
    first = F.when(F.col("pos") == 0, 2).otherwise(ORDER + 1)  # the first place that is the piece's own
    placed = (cut.select("*", F.posexplode(led).alias("pos", "piece")).drop("pieces").where(F.length("piece") >= first)
              .withColumn("i", F.explode(F.sequence(first, F.length("piece")))).drop("pos")
              .withColumn("n", F.explode(F.array(*map(F.lit, range(ORDER + 1))))).where("n < i"))
    return placed.withColumn("context", F.expr("substring(piece, i - n, n)")).withColumn("next", F.expr("substring(piece, i, 1)")).drop("piece", "i")


def model(strings: DataFrame) -> DataFrame:
    """(context, next) -> the two models' changes of log-probability; next '' is a context's discount.

    ``strings`` has id, chars, kind (allow or block) and how many URLs are so. Contexts below LEAST_CONTEXT sightings are left
    out, as a smoothed model's shorter contexts speak for them.
    """
    counted = grams(strings).groupBy("kind", "n", "context", "next").agg(F.sum("urls").alias("seen"))
    totals = counted.groupBy("kind", "n", "context").agg(F.sum("seen").alias("total"), F.count("*").alias("kinds")).where(
        F.col("total") >= LEAST_CONTEXT)
    known = store(counted.join(totals, ["kind", "n", "context"]), "urls")
    share = lambda lower: (F.col("seen") + F.col("kinds") * lower) / (F.col("total") + F.col("kinds"))
    level = known.where("n = 0").withColumn("p", share(F.lit(1.0 / ALPHABET))).withColumn(
        "change", F.log(F.col("p") * ALPHABET))
    rows = [level]
    for n in range(1, ORDER + 1):
        lower = rows[-1].select("kind", F.col("context").alias("shorter"), "next", F.col("p").alias("lower"))
        longer = known.where(F.col("n") == n).withColumn("shorter", F.expr("substring(context, 2)"))
        level = longer.join(lower, ["kind", "shorter", "next"]).withColumn("p", share(F.col("lower"))).withColumn(
            "change", F.log(F.col("p") / F.col("lower"))).drop("shorter", "lower")
        rows.append(level)
    changes = rows[0].select("kind", "context", "next", "change")
    for level in rows[1:]:
        changes = changes.union(level.select("kind", "context", "next", "change"))
    discounts = totals.select("kind", "context", F.lit("").alias("next"), F.log(F.col("kinds") / (F.col("total") + F.col("kinds"))).alias("change"))
    one = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("change"))).alias(kind)
    return store(changes.union(discounts).groupBy("context", "next").agg(one("allow"), one("block")), "urls")


def scored(strings: DataFrame, fitted: DataFrame) -> DataFrame:
    """``strings`` (distinct chars, each with an id) with score: the mean over characters of log allow minus log block; none for the empty string."""
    pieces = grams(strings.select("id", "chars"))
    model_rows = small_side(fitted)
    seen = model_rows.where("next != ''").select("context", "next", "allow", "block")
    discount = model_rows.where("next = ''").select("context", F.col("allow").alias("allow_0"), F.col("block").alias("block_0"))
    found = pieces.join(small_side(seen), ["context", "next"], "left").join(small_side(discount), "context", "left")
    change = lambda kind: F.coalesce(F.col(kind), F.col(f"{kind}_0"), F.lit(0.0))
    sums = found.groupBy("id").agg(F.sum(change("allow") - change("block")).alias("sum"))
    return strings.join(sums, "id").select("chars", F.round(F.col("sum") / F.length("chars"), 9).alias("score"))


def threshold(labelled: DataFrame) -> float:
    """The score that parts held-out labelled strings best; ``labelled`` has score, kind and urls. A tie takes the lowest."""
    binned = labelled.groupBy(F.round("score", 2).alias("cut")).agg(
        F.sum(F.when(F.col("kind") == "allow", F.col("urls")).otherwise(0)).alias("allow"),
        F.sum(F.when(F.col("kind") == "block", F.col("urls")).otherwise(0)).alias("block")).orderBy("cut").limit(100_000).collect()
    allow, block = sum(r["allow"] for r in binned), sum(r["block"] for r in binned)
    if not allow or not block:
        return 0.0
    best, lost, passed = (1.0, float("-inf")), 0, block
    for r in binned:  # everything below this row's score is blocked
        best = min(best, (lost / allow + passed / block, r["cut"]))
        lost, passed = lost + r["allow"], passed - r["block"]
    return best[1] if best[1] != float("-inf") else 0.0


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    host, path = split_url(F.col("url"))
    rule, said = rule_for(rules)
    parts = pages.select("page_id", F.coalesce("url", F.lit("")).alias("chars"), host.alias("host"), path.alias("path")).withColumn(
        "rule", rule).withColumn("said", said)
    strings = store(parts.groupBy("chars", "said").agg(F.count("*").alias("urls")).withColumn("id", F.monotonically_increasing_id()), "urls")
    labelled = strings.where("said is not null").withColumnRenamed("said", "kind")
    held = F.pmod(F.xxhash64("chars"), F.lit(HELD_OUT)) == 0
    fitted = model(labelled.where(~held))
    scores = store(scored(strings, fitted), "urls")
    cut = threshold(labelled.where(held).join(scores, "chars"))
    verdict = F.coalesce(F.col("said"), F.when(F.coalesce("score", F.lit(0.0)) >= F.lit(cut), "allow").otherwise("block"))
    return parts.join(scores, "chars", "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("score", F.lit(0.0)).alias("score"))
