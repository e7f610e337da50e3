import math
import random
from collections import Counter

from pyspark.sql import functions as F

from tests.helpers import by
from wattloom.functions import texts
from wattloom.functions.texts import folded, html_text, ticket_tone, tokens
from wattloom.operators import search
from wattloom.operators.resolve import resolve_literal

WORDS = "solar heat pump price battery roof meter bill grid tariff".split()


def corpus(spark, n=60):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 40)))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, content string")


def brute_force(rows, query, k):
    texts = {i: Counter(t.split()) for i, t in rows}
    size = sum(sum(c.values()) for c in texts.values()) / len(texts)
    scores = Counter()
    for term in set(query):
        df = sum(term in c for c in texts.values())
        for i, c in texts.items():
            if c[term]:
                norm = 1.2 * (0.25 + 0.75 * sum(c.values()) / size)
                scores[i] += math.log(1 + (len(texts) - df + 0.5) / (df + 0.5)) * c[term] * 2.2 / (c[term] + norm)
    return sorted(((round(s, 6), i) for i, s in scores.items()), key=lambda x: (-x[0], x[1]))[:k]


def test_ranking_equals_brute_force(spark):
    rows, df = corpus(spark)
    for query in (["solar"], ["heat", "pump", "heat"], ["roof", "unknown"], WORDS):
        found = search.search(df, "doc_id", "content", query, k=7).collect()
        ranked = sorted(((r["score"], r["doc_id"]) for r in found), key=lambda x: (-x[0], x[1]))
        assert ranked == brute_force(rows, query, 7)


def test_no_hit_gives_no_rows(spark):
    assert search.search(corpus(spark)[1], "doc_id", "content", ["zebra"]).count() == 0


def test_stored_index_gives_the_same_answer(spark, tmp_path):
    _, df = corpus(spark)
    search.write_term_index(search.term_index(df, "doc_id", "content"), str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    best = search.bm25_search(stored, search.corpus_stats(df, "content"), ["solar", "bill"], 5)
    direct = search.search(df, "doc_id", "content", ["solar", "bill"], 5)
    assert {(r["doc"], r["score"]) for r in best.collect()} == {(r["doc_id"], r["score"]) for r in direct.collect()}
    plan = stored.where(F.col("term").isin(["solar"]))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(term), EqualTo(term,solar)]" in plan or "PushedFilters: [In(term" in plan


def test_refreshed_index_equals_a_new_one(spark):
    _, before = corpus(spark)
    after = (before.where("doc_id <> 3")
             .withColumn("content", F.when(F.col("doc_id") == 5, "solar solar new").otherwise(F.col("content")))
             .unionByName(spark.createDataFrame([(900, "fresh bill")], "doc_id long, content string")))
    known = before.select("doc_id", F.md5("content").alias("content_hash"))
    refreshed = search.refreshed_index(search.term_index(before, "doc_id", "content"), after, known, "doc_id", "content")
    fresh = search.term_index(after, "doc_id", "content")
    assert refreshed.exceptAll(fresh).count() == 0 and fresh.exceptAll(refreshed).count() == 0
    assert {r["doc_id"] for r in search.changed_documents(after, known, "doc_id", "content").collect()} == {5, 900}


def test_sections(spark):
    text = "intro\n# One\nbody # not a heading\n## Two\nmore\n#tag\n####### seven"
    rows = search.sections(spark.createDataFrame([(1, text)], "doc_id long, content string")).orderBy("section").collect()
    assert [(r["title"], r["content"]) for r in rows] == [
        ("", "intro\n"), ("One", "# One\nbody # not a heading\n"), ("Two", "## Two\nmore\n#tag\n####### seven")]


def test_vector_search(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, [-1.0, 0.0])],
                               "id long, v array<float>")
    found = search.vector_search(df, "id", "v", df.where("id = 1").select("v"), 3).collect()
    assert [(r["id"], r["cosine"]) for r in found] == [(1, 1.0), (2, 1.0), (3, 0.0)]


def test_names_with_umlauts_typos_and_no_match(spark):
    df = spark.createDataFrame([("Max Müller",), ("Maxi Meier",), ("Jörg Groß",), ("Max Müller",), (None,)], "name string")
    assert resolve_literal(df, "name", "Mueller").first()["value"] == "Max Müller"
    assert resolve_literal(df, "name", "joerg gross").first()[1:] == (1.0, 0)
    assert resolve_literal(df, "name", "Max Muler").first()["value"] == "Max Müller"
    assert resolve_literal(df, "name", "qqq zzz").count() == 0
    assert resolve_literal(df, "name", "Max Müller").count() == 2


def test_folding_and_tokens(spark):
    row = spark.createDataFrame([("Größe  Éclair-ÑU",)], "t string").select(folded(F.col("t")), tokens(F.col("t"))).first()
    assert row[0] == "groesse eclair nu"
    assert row[1] == ["größe", "éclair", "ñu"]


def test_html_text(spark):
    page = ('<html><head><title>A &amp;lt; B</title><style>p{}</style><SCRIPT type="x">var t="</p>";</SCRIPT></head>'
            "<body><!-- gone <p> --><p>Hi&nbsp;there</p>\n<br>&copy; x</body></html>")
    assert spark.createDataFrame([(page,)], "h string").select(html_text(F.col("h"))).first()[0] == "A &lt; B Hi there © x"


def test_ticket_tone(spark):
    rows = [("Wallbox defekt",), ("Lob, aber Störung",), ("Lob",), ("Frage",), ("Speicher lädt nicht",)]
    found = spark.createDataFrame(rows, "t string").select("t", ticket_tone(F.col("t")).alias("tone"))
    assert {k: r["tone"] for k, r in by(found, "t").items()} == {
        "Wallbox defekt": "negative", "Lob, aber Störung": "negative", "Lob": "positive", "Frage": "neutral",
        "Speicher lädt nicht": "negative"}


def test_html_tags_quotes_and_numbered_characters(spark):
    cases = {
        "a < b and c > d": "a < b and c > d",
        '<p title="x>y">in</p> out': "in out",
        "<a href='it>s'>k</a><br/>z": "k z",
        "M&#228;rz &#x20AC;5 &#128512; &#38;lt; &#0; &#55296; &#12": "M\u00e4rz \u20ac5 \U0001f600 &lt; &#0; &#55296; &#12",
        '<p title="open>left': 'left',
        "<!-- a > b --><script>x<y</script>t": "t",
        "": "", None: None,
        "<b " + "'x' " * 5000 + "> end": "end",
    }
    rows = spark.createDataFrame([(k,) for k in cases], "html string")
    found = {r.html: r.text for r in rows.select("html", texts.html_text(F.col("html")).alias("text")).collect()}
    assert found == cases
