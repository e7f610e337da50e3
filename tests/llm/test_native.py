"""The syncmer fingerprints and the URL model against plain versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wattloom.llm import syncmers, url_model

TEXTS = ["", "a", "ab cd", "one two three four five", "é\U0001f600 ñ", " \n", "the the the the the the the", "x" * 3000,
         " ".join(f"w{i % 97}" for i in range(4000)), " ".join(f"w{i % 97}" for i in range(2000)), None, "1 2 3 4 5 6 7 8 9"]


def test_edited_texts_and_fingerprints(spark):
    rows = [(i * 7, t, "c") for i, t in enumerate(TEXTS)] + [(None, "last of all here", "c"), (14, "ab cd", "c")]
    found = syncmers.fingerprints(spark.createDataFrame(rows, "doc_id long, text string, range string").repartition(5)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    want = Counter()
    for (doc_id, text, _), (_, after, _) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        want[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == want
    prints = defaultdict(set)
    text_of = {i: t or "" for i, t, _ in rows}
    for r in found:
        prints[text_of[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.fingerprint
    assert all(len(p) == 1 for p in prints.values())
    by_id = {r.doc_id: r for r in found}
    assert by_id[56].near_next == 1.0 or by_id[56].near_next > 0.9  # the same 97 words in turn
    assert by_id[7].near_edited == 1.0


def test_anchors_are_closed_syncmers(spark):
    row = syncmers.with_anchors(spark.createDataFrame([(TEXTS[8],)], "t string"), "t", "found").first()
    words = TEXTS[8].split()
    pairs = spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "w string").selectExpr("w", "xxhash64(w) h").collect()
    hashes = [dict(map(tuple, pairs))[w] for w in words]
    want = sum(min(hashes[i:i + 5]) in (hashes[i], hashes[i + 4]) for i in range(len(words) - 4))
    assert len(row.found) == want


def test_texts_without_a_closed_syncmer(spark):
    docs = spark.createDataFrame([(i, f"a{i} b{i} c{i} d{i} e{i}") for i in range(60)], "doc_id long, text string")
    found = syncmers.fingerprints(docs).collect()
    assert len({r.fingerprint for r in found}) == 60
    assert all(r.fingerprint and 0 <= r.near_edited <= 1 and r.near_next == 0 for r in found)


def test_single_document_is_its_own_next(spark):
    (row,) = syncmers.fingerprints(spark.createDataFrame([(3, "abcd")], "doc_id long, text string")).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    assert syncmers.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("bounds", [[], [3], [1, 4, 9, 16, 25, 36, 49]])
def test_range_of(spark, bounds):
    found = spark.range(-2, 60).select("id", syncmers.range_of(F.col("id"), bounds)).collect()
    assert all(r[1] == sum(b <= r[0] for b in bounds) for r in found)


URLS = ["https://A.Example.com/en/1?x", "http://www.example.com/en/22", "http://shop.net/es/1#t", "ftp://x.net/de/1", "notaurl", None, "",
        "http://example.com.evil.org/en/", "http://net/es/", "http://com", "x://?q", "http://b.org/ÄÖ/É?", "a\nb://Z.com/\n1", "http://h.net/ES/1"]


def plain(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, said in url_model.RULES:
        domain, _, tail = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best[0])):
            best = rule, said
    return host, path, *(best or (None, None))


def log_p(strings, chars):
    """The smoothed model of one kind by its definition: each order mixed with the next shorter one."""
    seen = defaultdict(Counter)
    for text, times in strings.items():
        marked = "\x02" + text
        for i in range(1, len(marked)):
            for n in range(min(url_model.ORDER, i) + 1):
                seen[marked[i - n:i]][marked[i]] += times
    total, marked = 0.0, "\x02" + chars
    for i in range(1, len(marked)):
        p = 1 / url_model.ALPHABET
        for n in range(min(url_model.ORDER, i) + 1):
            after = seen.get(marked[i - n:i])
            if after and sum(after.values()) >= url_model.LEAST_CONTEXT:
                p = (after[marked[i]] + len(after) * p) / (sum(after.values()) + len(after))
        total += math.log(p)
    return total


def test_rules_and_scores(spark):
    urls = URLS + [f"http://h{i % 9}.example.{tld}/{lang}/{i}" for i in range(60) for tld in ("com", "net", "org") for lang in ("en", "fr", "de")]
    rows = [(i, u, "c") for i, u in enumerate(urls)] + [(3, URLS[3], "again"), (None, URLS[0], "")]
    found = url_model.judged(spark.createDataFrame(rows, "page_id long, url string, chars string")).collect()
    assert len(found) == len(rows)
    url_of = {i: u for i, u, _ in rows}
    kinds, counts = {"allow": Counter(), "block": Counter()}, Counter()
    for _, url, _ in rows:
        said = plain(url)[3]
        if said:
            counts[url, said] += 1
    hashed = dict(map(tuple, spark.createDataFrame([(c,) for c, _ in counts], "c string").selectExpr("c", "pmod(xxhash64(c), 5)").collect()))
    for (chars, said), n in counts.items():
        if hashed[chars] != 0:
            kinds[said][chars] += n
    for r in found:
        host, path, rule, said = plain(url_of[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == said or said is None and r.verdict in ("allow", "block")
        chars = url_of[r.page_id]
        if chars:
            assert r.score == pytest.approx((log_p(kinds["allow"], chars) - log_p(kinds["block"], chars)) / len(chars), abs=1e-6)
    unruled = [(r.score, r.verdict) for r in found if r.rule is None]
    assert max((s for s, v in unruled if v == "block"), default=-9) < min((s for s, v in unruled if v == "allow"), default=9)


def test_urls_without_rows_or_labels(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_model.judged(empty).count() == 0
    one = url_model.judged(spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")).collect()
    assert [(r.verdict, r.score) for r in one] == [("allow", 0.0)]


def test_grams_of_short_and_very_long_strings(spark):
    """Around the borders of pieces, with line feeds and characters beyond 16 bits; a string of a million characters is cut as fast a character."""
    texts = ["", "a", "ab", "x" * 63, "".join(chr(97 + i % 26) for i in range(64)), "".join(chr(97 + i * 7 % 26) for i in range(300)), "a\n\U0001F600b" * 50]
    strings = spark.createDataFrame(list(enumerate(texts)), "id long, chars string")
    found = sorted(tuple(r) for r in url_model.grams(strings).select("id", "n", "context", "next").collect())
    want = []
    for i, text in enumerate(texts):
        marked = "\u0002" + text
        want += [(i, n, marked[at - n:at], marked[at]) for at in range(1, len(marked)) for n in range(min(url_model.ORDER, at) + 1)]
    assert found == sorted(want)
    long = spark.range(3).selectExpr("id", "repeat('http://a.b/c?', 80000) as chars")
    assert url_model.grams(long).groupBy("n").count().where("n = 4").first()["count"] == 3 * (13 * 80_000 - 3)


def test_whole_urls_are_modelled(spark):
    """Query, fragment, scheme and digits count: urls that differ only there are judged apart, each by the plain model of the whole url."""
    urls = [f"http://h{i % 7}.example.{tld}/en/{i}?{mark}={i}" for i in range(80) for tld, mark in (("com", "good"), ("net", "x"))]
    urls += [f"https://shop.net/{lang}/{i}?spam=1#ad" for i in range(40) for lang in ("es", "fr")]
    bare = "http://a.org/p/"
    urls += [bare, bare + "?good=1", bare + "?spam=1#ad", bare + "1", bare + "7", "no scheme ?spam=1", None]
    docs = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {urls[r.page_id]: r for r in url_model.judged(docs).collect()}
    said = {u: plain(u)[3] for u in urls if plain(u)[3]}
    hashed = dict(map(tuple, spark.createDataFrame([(u,) for u in said], "c string").selectExpr("c", "pmod(xxhash64(c), 5)").collect()))
    kinds = {kind: Counter(u for u, s in said.items() if s == kind and hashed[u] != 0) for kind in ("allow", "block")}
    for url, r in found.items():
        want = (log_p(kinds["allow"], url) - log_p(kinds["block"], url)) / len(url) if url else 0.0
        assert r.score == pytest.approx(want, abs=1e-6)
    assert found[bare + "?good=1"].score > found[bare + "?spam=1#ad"].score
    assert len({found[bare + x].score for x in ("", "1", "7", "?good=1", "?spam=1#ad")}) == 5
