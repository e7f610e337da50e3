"""Registered queries on documents, tickets, names, vectors and web pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from wattloom.functions.texts import html_text, tokens
from wattloom.operators import search, service
from wattloom.operators.accounts import heavy_users
from wattloom.operators.name_index import NameIndex
from wattloom.operators.resolve import resolve_literal
from wattloom.operators.text_index import TextIndex
from wattloom.operators.vector_index import VectorIndex
from wattloom.session import scratch_path, store
from wattloom.sources import documents
from wattloom.sources.document_folder import DocumentFolder
from wattloom.sources.shared_files import put_files

SQL_WORDS = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')".format


def _question(d, item: int = 0) -> list[str]:
    """The words of one question, read as parameters of the search."""
    return d.source("benchmark").where(F.col("item_id") == item).select(tokens(F.col("text"))).first()[0]


def bm25_sql(corpus: str, key: str, text: str, columns: str = "", k: int = 5, where: str = "true") -> str:
    """Ranking of ``corpus`` for the first question, over all of its rows and whole texts; rows that fit ``where`` come back."""
    return f"""
    SELECT {key + ", " if key != "doc" else ""}{columns} score FROM (
      WITH texts AS MATERIALIZED (SELECT {key} AS doc, {SQL_WORDS(text)} AS words FROM {corpus}),
           question AS MATERIALIZED (SELECT DISTINCT unnest({SQL_WORDS('text')}) AS term FROM benchmark WHERE item_id = 0),
           size AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(len(words)) AS DOUBLE) AS total FROM texts),
           hits AS MATERIALIZED (
             SELECT doc, len, term, count(*) AS tf
             FROM (SELECT doc, len(words) AS len, unnest(words) AS term FROM texts) JOIN question USING (term)
             GROUP BY 1, 2, 3),
           frequency AS MATERIALIZED (SELECT term, count(*) AS df FROM hits GROUP BY 1)
      SELECT doc AS d, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
               / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / (total / n)))), 6) AS score
      FROM hits JOIN frequency USING (term) CROSS JOIN size GROUP BY 1)
    JOIN {corpus} ON {key} = d WHERE {where} ORDER BY score DESC, {key} LIMIT {k}"""


ENERGY_DOCS = "(SELECT * FROM parsed_content WHERE relative_path ILIKE '%/energy/%')"


@query("R2 S8 P5 F14", r"""
    SELECT collection, count(*) AS documents, min(regexp_extract(relative_path, '[^/]+$')) AS first_title,
           CAST(sum(length(content)) AS BIGINT) AS characters
    FROM (SELECT *, split_part(relative_path, '/', 2) AS collection FROM parsed_content) GROUP BY 1""", "parsed_content")
def document_collections(d):
    folders = [documents.collection(d["parsed_content"], name).withColumn("collection", F.lit(name))
               for name in ("energy", "products", "service")]
    return folders[0].unionByName(folders[1]).unionByName(folders[2]).groupBy("collection").agg(
        F.count("*").alias("documents"), F.min("title").alias("first_title"),
        F.sum(F.length("content")).alias("characters"))


FILE_SLICES = 24


@query("S8 R7 S5", """
    SELECT doc_id, CAST(CASE WHEN doc_id % 10 IN (1, 3) THEN 1 ELSE 0 END AS BIGINT) AS scan, length(text) AS characters, md5(text) AS content_hash
    FROM documents""")
def document_rescan(d):
    """Documents as one file each, in ten folders: one is rewritten and one added after the first scan; the second reads these, the third none."""
    root = scratch_path(d.spark, "document-files")
    part = F.col("doc_id") % 10
    slice_ = F.pmod(F.floor(F.col("doc_id") / 10), F.lit(FILE_SLICES))  # subfolders are listed side by side
    texts = d.source("documents").select("doc_id", F.col("text").alias("value"), part.alias("part"), slice_.alias("slice"))
    folder = DocumentFolder(d.spark, root, scratch_path(d.spark, "document-state"))
    older = F.when(part == 1, F.concat("value", F.lit(" older words"))).otherwise(F.col("value"))
    for now in (texts.where("part <> 3").withColumn("value", older), texts.where("part in (1, 3)")):
        put_files(now.select(F.concat_ws("\n", "doc_id", "value").alias("value"), "part", "slice"), root, ("part", "slice"), FILE_SLICES)
        folder.scan()
    folder.scan()
    pieces = F.split("content", "\n", 2)
    text = F.expr("left(text, length(text) - 1)")  # the writer ends a file with a line feed
    return folder.documents().select(pieces[0].cast("bigint").alias("doc_id"), "scan", pieces[1].alias("text")).select(
        "doc_id", "scan", F.length(text).alias("characters"), F.md5(text).alias("content_hash"))


@query("L2", """
    SELECT relative_path, left(content, 200) AS content_preview FROM parsed_content ORDER BY relative_path LIMIT 5""",
       "parsed_content")
def document_preview(d):
    return documents.preview(d["parsed_content"])


@query("R4", r"""
    SELECT doc_id, title, length(content) AS characters, md5(content) AS content_hash
    FROM (SELECT doc_id, regexp_extract(part, '^#{1,6} ([^\n]*)', 1) AS title, part AS content
          FROM (SELECT doc_id, unnest(string_split(regexp_replace(content, '(^|\n)(#{1,6} )', '\1' || chr(1) || '\2', 'g'),
                                                   chr(1))) AS part FROM parsed_content)) WHERE content <> ''""",
       "parsed_content")
def document_sections(d):
    return search.sections(d["parsed_content"]).select(
        "doc_id", "title", F.length("content").alias("characters"), F.md5("content").alias("content_hash"))


@query("R3", bm25_sql(ENERGY_DOCS, "doc_id", "content", "relative_path, file_url,"), "parsed_content")
def energy_document_search(d):
    corpus = documents.collection(d["parsed_content"], "energy").drop("title")
    return search.search(corpus, "doc_id", "content", _question(d))


@query("R3 B33", bm25_sql("parsed_content", "doc_id", "content", "relative_path, file_url,", 10), "parsed_content")
def document_search(d):
    return search.search(d["parsed_content"], "doc_id", "content", _question(d), k=10)


@query("R5", bm25_sql("ticket_texts", "log_id", "description", "conv_id, turn,"), "ticket_texts")
def ticket_search(d):
    tickets = d["ticket_texts"].select("log_id", "conv_id", "turn", "description")
    return search.search(tickets, "log_id", "description", _question(d))


def _index(d, corpus, key: str, text: str) -> TextIndex:
    index = TextIndex(d.spark, scratch_path(d.spark, "text-index"))
    index.refresh(corpus, key, text)
    return index


def _passages(d):
    """Sections of all three collections, with the attributes that a search returns."""
    parts = search.sections(d["parsed_content"].drop("file_url"))
    return parts.select(F.concat_ws("#", "doc_id", "section").alias("doc"), "doc_id", F.col("section").cast("long").alias("section"), "title",
                        "relative_path", F.element_at(F.split("relative_path", "/"), 2).alias("collection"), "content")


PASSAGE = "doc_id, section, title, relative_path, collection,"


@query("R2 R3 B33", bm25_sql("passages", "doc", "content", PASSAGE, 10), "passages")
def passage_search(d):
    """Passages of every collection, from a stored index."""
    return _index(d, _passages(d), "doc", "content").search(_question(d), 10).drop("doc")


@query("R2 R3", bm25_sql("passages", "doc", "content", PASSAGE, where="collection = 'products'"), "passages")
def product_search(d):
    return _index(d, _passages(d), "doc", "content").search(_question(d), where=F.col("collection") == "products").drop("doc")


@query("R2 R3", bm25_sql("passages", "doc", "content", PASSAGE, where="collection = 'service'"), "passages")
def service_search(d):
    return _index(d, _passages(d), "doc", "content").search(_question(d), where=F.col("collection") == "service").drop("doc")


@query("R3 R7 S5", bm25_sql("(SELECT * FROM passages WHERE doc_id % 5 <> 3)", "doc", "content", PASSAGE, 10), "passages")
def indexed_search(d):
    """The index knew older texts and documents that are gone since; a refresh indexes what changed, in a segment of its own."""
    now = _passages(d).where("doc_id % 5 <> 3")
    old_text = F.when(F.col("collection") == "energy", F.concat("content", F.lit(" older words"))).otherwise(F.col("content"))
    index = _index(d, _passages(d).where("doc_id % 5 <> 4").withColumn("content", old_text), "doc", "content")
    index.refresh(now, "doc", "content")
    return index.search(_question(d), 10).drop("doc")


@query("R5", bm25_sql("ticket_texts", "log_id", "description", "conv_id, turn, topic, priority, sentiment,", 10,
                      "topic = 'outage' AND priority IN ('high', 'critical')"), "ticket_texts")
def filtered_ticket_search(d):
    """Tickets of one topic and the two upper priorities, ranked as among all tickets."""
    wanted = (F.col("topic") == "outage") & F.col("priority").isin("high", "critical")
    return _index(d, d["ticket_texts"], "log_id", "description").search(_question(d), 10, wanted).withColumnRenamed("doc", "log_id")


@query("J14 B6 B33", """
    SELECT customer_key, kwh, doc_id AS tip_doc_id, score AS tip_score FROM (
      SELECT customer_key, CAST(sum(consumption_kwh) AS BIGINT) AS kwh FROM billing_history GROUP BY 1
      HAVING sum(consumption_kwh) > 6000)
    CROSS JOIN (""" + bm25_sql("parsed_content", "doc_id", "content", "", 1) + ")", "billing_history parsed_content")
def heavy_users_with_tip(d):
    """The customer list beside the best passage: one document, carried along as a one-row subquery."""
    best = search.search(d["parsed_content"], "doc_id", "content", _question(d), k=1)
    tip = best.select(F.struct("doc_id", "score")).scalar()
    return heavy_users(d["billing_history"], 6000).withColumn("tip", tip).select(
        "customer_key", "kwh", F.col("tip.doc_id").alias("tip_doc_id"), F.col("tip.score").alias("tip_score"))


@query("R7 S5", r"""
    SELECT term, CAST(sum(tf) AS BIGINT) AS occurrences, count(*) AS documents
    FROM (SELECT doc_id, term, count(*) AS tf FROM (
            SELECT doc_id, unnest(""" + SQL_WORDS("content") + """) AS term FROM parsed_content
            WHERE relative_path NOT ILIKE '%/service/%') GROUP BY 1, 2) GROUP BY 1""", "parsed_content")
def refreshed_term_index(d):
    """The index knew older texts and the service folder; only what changed is indexed again."""
    now = d["parsed_content"].where("relative_path NOT ILIKE '%/service/%'")
    old_text = F.when(F.col("relative_path").ilike("%/energy/%"), F.concat(F.lit("old "), "content")).otherwise(F.col("content"))
    before = d["parsed_content"].withColumn("content", old_text)
    known = before.select("doc_id", F.md5("content").alias("content_hash"))
    index = search.refreshed_index(search.term_index(before, "doc_id", "content"), now, known, "doc_id", "content")
    return index.groupBy("term").agg(F.sum("tf").alias("occurrences"), F.count("*").alias("documents"))


@query("R7", """
    SELECT doc_id, relative_path FROM parsed_content WHERE relative_path ILIKE '%/energy/%'""", "parsed_content")
def changed_documents(d):
    old_text = F.when(F.col("relative_path").ilike("%/energy/%"), F.concat(F.lit("old "), "content")).otherwise(F.col("content"))
    known = d["parsed_content"].select("doc_id", F.md5(old_text).alias("content_hash"))
    return search.changed_documents(d["parsed_content"], known, "doc_id", "content").select("doc_id", "relative_path")


@query("R6", """
    SELECT vec_id, round(list_dot_product(v, q) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(q, q))), 6) AS cosine
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
                 (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 7) AS q FROM embeddings)
    ORDER BY cosine DESC, vec_id LIMIT 5""")
def vector_search(d):
    vectors = d.source("embeddings")
    probe = vectors.where("vec_id = 7").select("embedding")
    return search.vector_search(vectors, "vec_id", "embedding", probe, 5)


@query("R6", """
    SELECT vec_id, round(list_dot_product(v, q) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(q, q))), 6) AS cosine
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
                 (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 11) AS q FROM embeddings)
    ORDER BY cosine DESC, vec_id LIMIT 5""")
def indexed_vector_search(d):
    """Cells of a stored index, opened until no other one can hold a nearer vector."""
    vectors = d.source("embeddings")
    index = VectorIndex(d.spark, scratch_path(d.spark, "vectors"))
    index.build(vectors, "vec_id", "embedding")
    probe = vectors.where("vec_id = 11").select("embedding").first()[0]
    return index.search(probe, 5, exact=True).withColumnRenamed("key", "vec_id")


@query("R6", "SELECT count(*) AS queries, 5 * count(*) AS found, true AS recall_reached FROM embeddings WHERE vec_id % 20 = 0")
def vector_index_recall(d):
    """How many of the five nearest vectors of every query row the index finds without opening all cells; 0.9 is the least."""
    vectors = d.source("embeddings")
    index = VectorIndex(d.spark, scratch_path(d.spark, "vectors"))
    index.build(vectors, "vec_id", "embedding")
    asked = vectors.where("vec_id % 20 = 0")
    found = store(index.search_all(asked, "vec_id", "embedding"), "vectors")
    exact = index.search_all(asked, "vec_id", "embedding", probes=len(index.cells())).select("query", F.col("rank"), F.col("cosine").alias("true_cosine"))
    both = found.join(exact, ["query", "rank"])
    return both.agg(F.count_distinct("query").alias("queries"), F.count("*").alias("found"),
                    (F.count_if(F.col("cosine") >= F.col("true_cosine")) >= 0.9 * F.count("*")).alias("recall_reached"))


def resolve_sql(values: str, column: str, typed: str, k: int = 5) -> str:
    """Trigram overlap on folded text, for names without umlauts."""
    fold = r"trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))".format
    grams = "list_distinct(list_transform(range(1, length({0}) + 2), lambda i: substr('  ' || {0} || ' ', i, 3)))".format
    return f"""
    SELECT value, round(CAST(len(list_intersect(have, want)) AS DOUBLE)
                        / (len(have) + len(want) - len(list_intersect(have, want))), 6) AS similarity,
           CAST(levenshtein(folded, probe) AS BIGINT) AS edits
    FROM (SELECT *, {grams('folded')} AS have, {grams('probe')} AS want
          FROM (SELECT DISTINCT {column} AS value, {fold(column)} AS folded, {fold(f"'{typed}'")} AS probe FROM {values}))
    WHERE len(list_intersect(have, want)) > 0 ORDER BY similarity DESC, edits, value LIMIT {k}"""


@query("R1", resolve_sql("customer_dim", "customer_name", "custommer 42"), "customer_dim")
def resolve_customer(d):
    return resolve_literal(d["customer_dim"], "customer_name", "custommer 42")


@query("R1", resolve_sql("customer_dim", "city", "nation-12"), "customer_dim")
def resolve_city(d):
    return resolve_literal(d["customer_dim"], "city", "nation-12")


@query("R1", resolve_sql("product_dim", "product_name", "smal widgit"), "product_dim")
def resolve_product(d):
    return resolve_literal(d["product_dim"], "product_name", "smal widgit")


@query("R1", resolve_sql("vendor_dim", "vendor_name", "suplier 0009"), "vendor_dim")
def resolve_vendor(d):
    return resolve_literal(d["vendor_dim"], "vendor_name", "suplier 0009")


@query("R1", resolve_sql("sales_rep_dim", "rep_name", "rep nation 3"), "sales_rep_dim")
def resolve_rep(d):
    return resolve_literal(d["sales_rep_dim"], "rep_name", "rep nation 3")


@query("R1", resolve_sql("(SELECT customer_name AS name FROM customer_dim UNION SELECT city FROM customer_dim UNION SELECT product_name FROM product_dim"
                        " UNION SELECT vendor_name FROM vendor_dim UNION SELECT rep_name FROM sales_rep_dim)", "name", "suplier 00011", 10),
       "customer_dim product_dim vendor_dim sales_rep_dim")
def indexed_resolve(d):
    """One stored index over all five name columns; customers and products came later and were added to it."""
    index = NameIndex(d.spark)
    for table, column in (("vendor_dim", "vendor_name"), ("sales_rep_dim", "rep_name"), ("customer_dim", "city"), ("customer_dim", "customer_name"),
                          ("product_dim", "product_name")):
        index.add(d[table], column)
    return index.resolve("suplier 00011", 10)


@query("P13", """
    SELECT log_id, CASE WHEN regexp_matches(description, 'defekt|Störung|Beschwerde|nicht') THEN 'negative'
                        WHEN regexp_matches(description, 'Lob') THEN 'positive' ELSE 'neutral' END AS tone
    FROM ticket_texts""", "ticket_texts")
def ticket_tones(d):
    return service.tagged_tickets(d["ticket_texts"]).select("log_id", "tone")


def html_sql(column: str) -> str:
    text = f"regexp_replace({column}, '<!--.*?-->', ' ', 'gs')"
    for tag in ("script", "style"):
        text = f"regexp_replace({text}, '<{tag}[^>]*>.*?</{tag}>', ' ', 'gsi')"
    text = f"""regexp_replace({text}, '<[a-zA-Z/!?]("[^"]*"|''[^'']*''|[^''">])*>', ' ', 'gs')"""
    text = f"regexp_replace({text}, '<[a-zA-Z/!?][^>]*>', ' ', 'gs')"
    for entity, character in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{character}')"
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


@query("X4", f"SELECT page_id, url, length({html_sql('html')}) AS characters, md5({html_sql('html')}) AS text_hash FROM pages")
def page_texts(d):
    plain = d.source("pages").withColumn("text", html_text(F.col("html")))
    return plain.select("page_id", "url", F.length("text").alias("characters"), F.md5("text").alias("text_hash"))
