"""Scalar and table functions over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import dates, encoding, identity, markup, urls
from palimpsest.plans.registry import Tables, query
from palimpsest.profile import FORUM, Era, SiteProfile
from palimpsest.session import lean_workers

#: The synthetic pages as a site: every host in scope, languages as eras.
PAGES = SiteProfile(hosts=(), eras=(Era("a", ("/en/",), "a"), Era("b", ("/fr/", "/de/"), "b")), session_keys=("utm_source", "ref"), start_key="page")
HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '^www\.', '')"


@query(f"""WITH p AS (SELECT {HOST} AS host, list_distinct(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS links FROM pages)
SELECT host, 'external' AS kind, count(*) AS pages, CAST(sum(len(links)) AS BIGINT) AS links FROM p GROUP BY host""")
def link_extract(t: Tables) -> DataFrame:
    """References of all pages by host and kind."""
    lean_workers(t.spark)
    refs = t.pages.select(urls.host(F.col("url")).alias("host"), markup.page_references()(F.col("html"), F.col("url")).alias("refs"))
    links = refs.select("host", F.explode("refs").alias("r"))
    counts = links.groupBy("host", urls.resource_kind(F.col("r.url")).alias("kind")).agg(F.count("*").alias("links"))
    pages = refs.groupBy("host").agg(F.count("*").alias("pages"))
    return counts.join(pages, "host").select("host", "kind", "pages", "links")


@query(rf"""WITH p AS (SELECT page_id, {HOST} AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages)
SELECT page_id, 'http://' || host || coalesce(nullif(path, ''), '/') || CASE WHEN regexp_matches(q, '(^|&)page=') THEN '?page=' || regexp_extract(q, '(^|&)page=([^&]*)', 2) ELSE '' END AS canonical FROM p""")
def canonical_url(t: Tables) -> DataFrame:
    """Canonical addresses."""
    return t.pages.select("page_id", urls.canonical_url(PAGES)(F.col("url")).alias("canonical"))


@query(rf"""SELECT page_id, {HOST} AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '\?([^#]*)', 1) AS query, regexp_extract(lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)), '\.([^./]*)$', 1) AS extension FROM pages""")
def url_parts(t: Tables) -> DataFrame:
    """Host, path, query and extension."""
    u = F.col("url")
    return t.pages.select("page_id", urls.host(u).alias("host"), urls.path(u).alias("path"), urls.query_string(u).alias("query"), urls.extension(urls.path(u)).alias("extension"))


SAMPLE = ("http://forum.example.net/", "http://forum.example.net/phpbb2/viewtopic.php?t=1", "http://www.example.net/forum/topic.asp", "http://example.net/phpbb3/a/attachment/x", "http://forum.example.net/img/x.GIF", "http://other.example/x.html", "http://example.net/forums/list", "http://example.net/phpbb3/style.css", "http://example.net/phpbb2/file.zip", "http://example.net/forum/a b")


@query("""WITH u AS (SELECT doc_id, doc_id % 10 AS i, doc_id % 20 >= 10 AS early FROM documents)
SELECT doc_id, ['page','page','page','attachment','asset','external','page','asset','attachment','external'][i + 1] AS kind, CASE WHEN i IN (0, 4) AND early THEN 'community-server' ELSE ['phpbb2','phpbb2','snitz','phpbb3','phpbb2',NULL,'community-server','phpbb3','phpbb2','snitz'][i + 1] END AS era FROM u""")
def resource_kind(t: Tables) -> DataFrame:
    """Kinds and eras of addresses."""
    url = F.element_at(F.array(*map(F.lit, SAMPLE)), (F.col("doc_id") % 10 + 1).cast("int"))
    stamp = F.when(F.col("doc_id") % 20 >= 10, "20070501000000").otherwise("20080101000000")
    return t.documents.select("doc_id", urls.resource_kind(url).alias("kind"), urls.era(url, FORUM, stamp).alias("era"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS posted_at FROM orders""")
def forum_date(t: Tables) -> DataFrame:
    """Dates in all notations, read back."""
    d = F.col("o_orderdate")
    fmt = lambda p: F.date_format(d, p)
    raw = (
        F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("Postado - "), fmt("dd/MM/yyyy : HH:mm:ss")))
        .when(F.col("o_orderkey") % 5 == 1, fmt("M-d-yyyy, h:mm:ss a"))
        .when(F.col("o_orderkey") % 5 == 2, fmt("EEE MMM d, yyyy h:mm:ss a"))
        .when(F.col("o_orderkey") % 5 == 3, fmt("d MMM yyyy, HH:mm:ss"))
        .otherwise(F.lit("31/02/2004 : 10:00:00"))
    )
    return t.orders.select("o_orderkey", dates.parse_forum_date(raw).alias("posted_at"))


@query("SELECT lang, CASE WHEN doc_id % 2 = 0 THEN 'utf-8' ELSE 'utf-8/windows-1252-mixed' END AS source_encoding, count(*) AS n, CAST(sum(length(nfc_normalize(text)) + CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 2 END) AS BIGINT) AS chars FROM documents GROUP BY 1, 2")
def encoding_stats(t: Tables) -> DataFrame:
    """Encodings of payloads, half of them with a stray byte."""
    stray = F.concat(F.col("text").cast("binary"), F.unhex(F.lit("A920")))
    raw = F.when(F.col("doc_id") % 2 == 0, F.col("text").cast("binary")).otherwise(stray)
    decoded = t.documents.select("lang", encoding.decode_html(raw).alias("d"))
    return decoded.groupBy("lang", F.col("d.source_encoding").alias("source_encoding")).agg(F.count("*").alias("n"), F.sum(F.length("d.text")).alias("chars"))


@query("SELECT doc_id, strip_accents(replace(lower(split_part(text, ' ', 1)), 'ß', 'ss')) AS norm FROM documents")
def username_norm(t: Tables) -> DataFrame:
    """Folded names."""
    return t.documents.select("doc_id", identity.normalize_username(F.split("text", " ")[0]).alias("norm"))


@query("SELECT event_id, json_extract_string(props, '$.page') AS page, len(json_keys(props)) AS keys FROM events")
def json_props(t: Tables) -> DataFrame:
    """Fields of JSON columns."""
    return t.events.select("event_id", F.get_json_object("props", "$.page").alias("page"), F.size(F.json_object_keys("props")).cast("bigint").alias("keys"))


@query("SELECT conv_id AS topic_id, turn + 1 AS post_id, role AS author_name, strftime(TIMESTAMP '2004-01-01 10:00:00' + to_days(CAST(turn AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS posted_at FROM conversations")
def parsed_posts(t: Tables) -> DataFrame:
    """Posts read from pages of a bulletin board made of ``conversations``."""
    from palimpsest.functions import forum

    day = F.date_format(F.date_add(F.lit("2004-01-01").cast("date"), F.col("turn").cast("int")), "EEE MMM d, yyyy")
    text = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    post = F.format_string("<table><tr><td><a name='p%d'></a><b class='postauthor'>%s</b></td><td>Posted: %s 10:00 am</td></tr><tr><td colspan=2><div class='postbody'>%s</div></td></tr></table>", F.col("turn") + 1, F.col("role"), day, text)
    pages = t.conversations.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", post.alias("p")))), lambda x: x["p"]), "").alias("html"))
    url = F.format_string("http://forum.example.net/phpbb3/viewtopic.php?t=%d", F.col("conv_id"))
    captures = pages.select(F.concat(F.lit("<html><body>"), "html", F.lit("</body></html>")).cast("binary").alias("content"), url.alias("original_url"), F.lit("phpbb3").alias("era"))
    return forum.posts_of(forum.parse_pages(captures)).select("topic_id", "post_id", "author_name", "posted_at")


@query("""SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'phpbb3/topicos/' || doc_id || '/index.html' WHEN 1 THEN 'phpbb2/foruns/' || doc_id || '/inicio/50/index.html' WHEN 2 THEN 'forum/topicos/' || doc_id || '/pagina/2/index.html'
WHEN 3 THEN 'comunidade/topicos/' || doc_id || '/index.html' WHEN 4 THEN 'phpbb3/acoes/somente-leitura/index.html' WHEN 5 THEN 'phpbb3/paginas/faq-' || doc_id || '/index.html' END AS route FROM documents""")
def static_routes(t: Tables) -> DataFrame:
    """Routes of addresses of all forms."""
    from palimpsest.functions import routes

    forms = ("http://forum.example.net/phpbb3/viewtopic.php?f=2&t={}", "http://forum.example.net/phpbb2/viewforum.php?f={}&start=50", "http://example.net/forum/topic.asp?TOPIC_ID={}&whichpage=2", "http://forum.example.net/forums/thread/{}.aspx", "http://forum.example.net/phpbb3/posting.php?t={}", "http://forum.example.net/phpbb3/faq-{}.php", "http://other.example/{}")
    url = F.element_at(F.array(*[F.concat(F.lit(a), F.col("doc_id").cast("string"), F.lit(b)) for a, b in (f.split("{}") for f in forms)]), (F.col("doc_id") % len(forms) + 1).cast("int"))
    return t.documents.select("doc_id", routes.static_route()(url, F.lit("20080101000000")).alias("route"))
