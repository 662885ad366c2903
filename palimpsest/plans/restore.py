"""Restoration end to end: manifest and payloads to relational tables, the link graph and a site.

Everything is set-based.  ``ord`` (time, address, digest, position) replaces ingestion order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import forum, identity, markup, rewrite, routes, urls
from palimpsest.functions.encoding import decode_html
from palimpsest.operators import gates, relations
from palimpsest.operators.asof import nearest_asof
from palimpsest.operators.closure import fixpoint
from palimpsest.operators.merge import argmax_row, dominant, latest_wins
from palimpsest.profile import FORUM, SiteProfile
from palimpsest.session import materialize
from palimpsest.sources import manifest
from palimpsest.sources.manifest import Period


@dataclass
class Archive:
    """The tables of a restored archive."""

    captures: DataFrame
    references: DataFrame
    posts: DataFrame
    post_sources: DataFrame
    topics: DataFrame
    forums: DataFrame
    users: DataFrame
    evidence: DataFrame


def capture_id(archive: Archive, original_url: str, timestamp: str) -> int:
    """The id of one capture; raises ``LookupError`` where it isn't in the archive."""
    found = archive.captures.where((F.col("original_url") == original_url) & (F.col("timestamp") == timestamp))
    return gates.the_row(found.select("capture_id"), f"capture {original_url} at {timestamp}").capture_id


def inside(col, period: Period | None):
    return F.lit(True) if period is None else relations.within(col, period.start, period.end)


def captures_of(rows: DataFrame, blobs: DataFrame, profile: SiteProfile = FORUM) -> DataFrame:
    """Manifest rows with checked payload, canonical address, era and kind (PJ1, PJ2)."""
    both = manifest.with_payload(rows, blobs)
    gates.require_none(manifest.payload_violations(both).drop("content"), "payload doesn't match the manifest")
    url = F.col("original_url")
    stamp = F.col("timestamp")
    return both.select(
        F.xxhash64("original_url", "timestamp").alias("capture_id"), "original_url", "timestamp", F.nullif("mimetype", F.lit("")).alias("mimetype"), F.col("statuscode").cast("int").alias("statuscode"), F.nullif("requested_url", F.lit("")).alias("requested_url"), "sha256", "content",
        urls.canonical_url(profile)(url).alias("canonical_url"), urls.era(url, profile, stamp).alias("era"), urls.resource_kind(url, urls.in_scope(url, profile, stamp)).alias("kind"), F.octet_length("content").cast("bigint").alias("byte_length"),
    )


def restore(rows: DataFrame, blobs: DataFrame, period: Period | None = None, profile: SiteProfile = FORUM) -> Archive:
    """All tables from a valid manifest (``read_manifest``) and (sha256, content)."""
    captures = materialize(captures_of(rows, blobs, profile))
    scope = urls.in_scope(F.col("original_url"), profile, F.col("timestamp"))
    pages = captures.where((relations.role(F.col("mimetype")) == "page") & scope)
    pages = materialize(forum.parse_pages(pages.select("capture_id", "original_url", "timestamp", "sha256", "era", "content"), profile))
    of_pages = pages.select("capture_id", F.explode("page.references").alias("r"))
    sheets = captures.where(relations.role(F.col("mimetype")) == "stylesheet").select("capture_id", F.explode(markup.stylesheet_references(profile)(decode_html(F.col("content"))["text"], F.col("original_url"))).alias("r"))
    target = F.col("r.url")
    kind = F.when(F.col("r.is_asset"), "asset").otherwise(urls.resource_kind(target, urls.in_scope(target, profile)))
    references = of_pages.union(sheets).select("capture_id", target.alias("target_url"), kind.alias("kind")).distinct()

    place = F.struct("timestamp", "original_url", "sha256")
    posts = forum.posts_of(pages).where(inside(F.col("posted_at"), period)).withColumn("norm", identity.normalize_username("author_name"))
    posts = posts.withColumn("user_identity", identity.user_identity(F.col("era"), F.col("author_id"), F.col("norm"))).withColumn("ord", place)
    key = identity.post_identity(F.col("era"), F.col("post_id"), F.col("topic_id"), F.col("norm"), F.col("posted_at"), F.col("posted_at_raw"), F.col("body_text"))
    posts = materialize(posts.withColumn("identity_sha256", key).withColumn("best_capture_id", F.col("capture_id")))
    listings = forum.listings_of(pages).where(inside(F.col("created_at"), period) | inside(F.col("last_posted_at"), period)).withColumn("ord", place)
    listings = materialize(listings)

    winner = ["era", "topic_id", "forum_id", "user_identity", "author_name", "norm", "posted_at", "posted_at_raw", "body_html", "body_text", "best_capture_id"]
    merged = latest_wins(posts, ["identity_sha256"], "timestamp", ["ord", "position"], winner, ["topic_title", "forum_name"], {"first_capture_id": "capture_id"}, ["post_id"]).withColumnRenamed("timestamp", "best_capture_timestamp").withColumnRenamed("post_id", "historical_id")
    sources = relations.provenance(merged, posts.select("identity_sha256", "capture_id"), "identity_sha256")

    # of a page's posts the first of each forum and topic speaks for it; of pages the last that has a value
    listed = listings.select("era", "forum_id", "topic_id", F.col("title").alias("topic_title"), F.lit(None).cast("string").alias("forum_name"), "timestamp", "ord", F.lit(1).alias("stage"), "position")
    order = ["ord", "stage", "position"]
    forums = _of_pages(posts, "forum_id", ["forum_name"]).unionByName(listed.select("era", "forum_id", "forum_name", "timestamp", "ord", "stage", "position"))
    forums = relations.merge_known(forums.where("forum_id IS NOT NULL"), ["era", "forum_id"], order, {"name": "forum_name"}, more=relations.seen())
    both = _of_pages(posts, "topic_id", ["forum_id", "topic_title"]).unionByName(listed.drop("forum_name"))

    people = _evidence(listings)
    users = _users(posts, people)
    evidence = latest_wins(people.withColumn("best_capture_id", F.col("capture_id")), ["identity"], "timestamp", ["ord", "position", "role"], ["posted_at", "topic_title", "best_capture_id"], ["post_id"], {c: c for c in ("era", "role", "user_identity", "author_norm", "topic_id", "forum_id")}).withColumnRenamed("timestamp", "best_capture_timestamp")

    own = ["era", "topic_id", "user_identity", "posted_at"]
    activity = relations.activity(merged.select(*own), evidence.select(*own))
    topics = relations.merge_known(both.where("topic_id IS NOT NULL"), ["era", "topic_id"], order, {"forum_id": "forum_id", "title": "topic_title"}, more=relations.seen())
    listed_at = relations.merge_known(listings, ["era", "topic_id"], ["ord", "position"], {"_last": "last_posted_at"}, {"_first": "created_at"})
    topics = relations.with_activity(topics.join(listed_at, ["era", "topic_id"], "left"), activity, ["era", "topic_id"], F.col("_first"), F.col("_last"))
    topics = topics.select("era", "topic_id", "forum_id", "title", "first_posted_at", "last_posted_at", "first_seen", "last_seen")
    users = relations.with_count(relations.with_activity(users, activity, ["user_identity"]), merged, "user_identity", "post_count")
    users = users.select("user_identity", "era", "historical_id", "username", "username_norm", "first_posted_at", "last_posted_at", "post_count")
    # written once, so that the plans of a site don't contain those of its tables
    return Archive(captures, *map(materialize, (references, merged, sources, topics, forums, users, evidence)))


def _of_pages(posts: DataFrame, key: str, values: list[str]) -> DataFrame:
    """The first post's ``values`` for each ``key`` of each page, as rows of stage 0."""
    first = F.min_by(F.struct(*values), "position").alias("v")
    rows = posts.where(F.col(key).isNotNull()).groupBy("era", key, "capture_id", "timestamp", "ord").agg(first, F.min("position").alias("position"))
    return rows.select("era", key, *[F.col(f"v.{c}").alias(c) for c in values], "timestamp", "ord", F.lit(0).alias("stage"), "position")


def _evidence(listings: DataFrame) -> DataFrame:
    """Authors and last posters of topic listings, one row each."""
    shared = ["era", "capture_id", "timestamp", "ord", "position", "topic_id", "forum_id", F.col("title").alias("topic_title")]
    none = F.lit(None).cast("bigint")
    first = listings.select(*shared, F.lit("topic_author").alias("role"), F.col("author_id").alias("user_id"), F.col("author_name").alias("name"), none.alias("post_id"), F.col("created_at").alias("posted_at"))
    last = listings.select(*shared, F.lit("last_poster").alias("role"), F.col("last_author_id").alias("user_id"), F.col("last_author_name").alias("name"), F.col("last_post_id").alias("post_id"), F.col("last_posted_at").alias("posted_at"))
    rows = first.unionByName(last).where("name IS NOT NULL").withColumn("author_norm", identity.normalize_username("name"))
    rows = rows.withColumn("user_identity", identity.user_identity(F.col("era"), F.col("user_id"), F.col("author_norm")))
    return rows.withColumn("identity", identity.evidence_identity(F.col("era"), F.col("role"), F.col("topic_id"), F.col("author_norm"), F.col("posted_at")))


def _users(posts: DataFrame, people: DataFrame) -> DataFrame:
    """Last name of users with an id, first name of users known by name only."""
    rows = posts.select("user_identity", "era", F.col("author_id").alias("historical_id"), F.col("author_name").alias("username"), F.col("norm").alias("username_norm"), F.struct("ord", F.lit(0), "position", F.lit("")).alias("place"))
    rows = rows.union(people.select("user_identity", "era", "user_id", "name", "author_norm", F.struct("ord", F.lit(1), "position", "role")))
    return relations.merge_users(rows, "user_identity", ["place"], ["username", "username_norm"], F.col("user_identity").startswith("id:"), ["era", "historical_id"])


def require_terminal_post(archive: Archive, period: Period) -> None:
    """The post that ends the period was read from the capture that proves it."""
    last = archive.posts.where((F.col("historical_id") == period.post_id) & (F.col("posted_at") == period.posted_at)).select("identity_sha256")
    capture = archive.captures.where((F.col("timestamp") == period.capture_timestamp) & (F.col("original_url") == period.original_url)).select("capture_id")
    gates.require_some(relations.proofs(last, archive.post_sources, capture, "identity_sha256", "capture_id"), "the post that ends the period wasn't found")


def select_pages(archive: Archive, profile: SiteProfile = FORUM) -> DataFrame:
    """The newest usable capture of each route, with the number of others."""
    usable = archive.captures.where((F.coalesce("statuscode", F.lit(200)) == 200) & (relations.role(F.col("mimetype")) == "page"))
    topic = dominant(archive.post_sources.join(archive.posts.select("identity_sha256", "topic_id"), "identity_sha256"), ["capture_id"], "topic_id").select("capture_id", F.col("topic_id").alias("shown"))
    routed = usable.drop("content").join(topic, "capture_id", "left")
    routed = routed.withColumn("route", routes.static_route(profile)(routes.rendered_url("original_url", "shown"), "timestamp")).where("route IS NOT NULL")
    gates.require_none(relations.collisions(routed, ["route", "timestamp"], "sha256", routes.shared_route(F.col("route"))), "captures of one time compete for a route")
    return materialize(argmax_row(routed.select("route", "timestamp", "original_url", "sha256", "capture_id", "canonical_url", "requested_url", "era"), ["route"], ["timestamp", "original_url", "sha256"]))


def resolve_links(links: DataFrame, pages: DataFrame, aliases: DataFrame, post_aliases: DataFrame, profile: SiteProfile = FORUM) -> DataFrame:
    """(url, timestamp) with ``path`` and ``inert``: exact route, alias, print view, post alias.

    ``pages`` has route; ``aliases`` canonical, timestamp, path; ``post_aliases`` era, post_id,
    timestamp, path.  Distinct links are resolved once each.
    """
    keyed = materialize(links.select("url", "timestamp").distinct().withColumn("k", routes.link_keys(profile)("url", "timestamp")).select("url", "timestamp", "k.*"))
    known = pages.select(F.col("route").alias("path")).distinct()
    at = lambda c: keyed.join(known, keyed[c] == known["path"]).select("url", "timestamp", "path")
    near = nearest_asof(keyed.select("canonical", "timestamp", "url"), aliases, ["canonical"], "timestamp", ["path"], ["path"]).select("url", "timestamp", F.col("nearest_path").alias("path"))
    posts = nearest_asof(keyed.where("post_id IS NOT NULL").select("era", "post_id", "timestamp", "url"), post_aliases, ["era", "post_id"], "timestamp", ["path"], ["path"]).select("url", "timestamp", F.col("nearest_path").alias("path"))
    found = relations.first_found([at("route"), near, at("print_route"), posts], ["url", "timestamp"], "path")
    path = F.col("path")
    return materialize(keyed.join(found, ["url", "timestamp"], "left").select("url", "timestamp", "inert", F.when(F.col("fragment") == "", path).otherwise(F.concat(path, F.lit("#"), "fragment")).alias("path")))


def route_aliases(archive: Archive, pages: DataFrame, profile: SiteProfile = FORUM) -> tuple[DataFrame, DataFrame]:
    """Aliases of routes by address (also the one asked for) and by post."""
    own = archive.captures.where(relations.role(F.col("mimetype")) == "page").drop("content")
    topic = dominant(archive.post_sources.join(archive.posts.select("identity_sha256", "topic_id"), "identity_sha256"), ["capture_id"], "topic_id").select("capture_id", F.col("topic_id").alias("shown"))
    own = own.join(topic, "capture_id", "left").withColumn("path", routes.static_route(profile)(routes.rendered_url("original_url", "shown"), "timestamp"))
    own = own.join(pages.select(F.col("route").alias("path")), "path", "left_semi")
    asked = relations.answering(own, F.col("original_url"), F.col("requested_url"), "url").select("timestamp", "path", "url")
    aliases = asked.where(~routes.static_route(profile)("url", "timestamp").eqNullSafe(F.col("path"))).select(urls.canonical_url(profile)("url").alias("canonical"), "timestamp", "path").distinct()
    posts = archive.post_sources.join(archive.posts.select("identity_sha256", "historical_id").where("historical_id IS NOT NULL"), "identity_sha256").join(own.select("capture_id", "timestamp", "path", "era"), "capture_id")
    return aliases, posts.select("era", F.col("historical_id").cast("string").alias("post_id"), "timestamp", "path").distinct()


def resource_closure(archive: Archive, pages: DataFrame, profile: SiteProfile = FORUM) -> tuple[DataFrame, DataFrame]:
    """(referrer, canonical, capture_id, target) of resources reached from pages and, through
    style sheets, from each other, each hop as of its own referrer's time; and the missing addresses.
    """
    usable = archive.captures.where((F.coalesce("statuscode", F.lit(200)) == 200) & (relations.role(F.col("mimetype")) != "page") & (F.col("byte_length") > 0)).drop("content")
    target = routes.target_of("sha256", "original_url", "mimetype", "timestamp")
    same = F.when(F.col("mimetype") == "text/css", F.concat_ws("|", "sha256", "canonical_url", "timestamp")).otherwise(F.col("sha256"))
    # one copy of equal contents: that of the least address, time and id
    placed = usable.withColumn("identity", same).withColumn("target", target)
    first = relations.first_of_identity(placed, F.col("identity"), "target", ["canonical_url", "timestamp", "capture_id"]).drop("captures")
    placed = placed.drop("target").join(first, "identity").withColumn("asked_url", urls.canonical_url(profile)("requested_url"))
    own = ["timestamp", "capture_id", "sha256", "original_url", "mimetype", "target"]
    candidates = materialize(relations.answering(placed, F.col("canonical_url"), F.col("asked_url"), "address").select(F.col("address").alias("canonical_url"), *own))
    wanted = materialize(archive.references.where("kind IN ('asset', 'attachment')").select(F.col("capture_id").alias("referrer"), F.col("target_url").alias("canonical_url")))

    def hop(referrers: DataFrame) -> DataFrame:
        probes = referrers.select(F.col("capture_id").alias("referrer"), "timestamp").distinct().join(wanted, "referrer")
        got = nearest_asof(probes, candidates, ["canonical_url"], "timestamp", ["capture_id", "sha256", "original_url"], ["capture_id", "target", "mimetype"])
        return got.select("referrer", "canonical_url", F.col("nearest_capture_id").alias("capture_id"), F.col("nearest_timestamp").alias("timestamp"), F.col("nearest_target").alias("target"), F.col("nearest_mimetype").alias("mimetype"))

    start = hop(pages.select("capture_id", "timestamp"))
    reached = fixpoint(start, lambda f: hop(f.where("mimetype = 'text/css'").select("capture_id", "timestamp")), ["referrer", "canonical_url"])
    reached = materialize(reached)
    return reached.where("capture_id IS NOT NULL"), reached.where("capture_id IS NULL").select(F.col("canonical_url").alias("target_url")).distinct()


def missing_pages(archive: Archive, pages: DataFrame, resolved: DataFrame) -> DataFrame:
    """Page addresses that selected pages link to and that neither resolve nor only act."""
    refs = archive.references.where("kind = 'page'").join(pages.select("capture_id", "timestamp"), "capture_id").select(F.col("target_url").alias("url"), "timestamp")
    refs = refs.distinct().join(resolved.select("url", "timestamp", "inert"), ["url", "timestamp"], "left")
    return relations.lost(refs, resolved.where("path IS NOT NULL"), ["url", "timestamp"], F.coalesce("inert", F.lit(True))).select("url").distinct().transform(materialize)


def entity_plan(missing: DataFrame, archive: Archive, profile: SiteProfile = FORUM) -> DataFrame:
    """Entities (era, kind, id) to write for missing addresses: known ones and their topics."""
    space = {e.namespace: e.name for e in profile.eras}
    era = F.create_map(*[F.lit(x) for pair in space.items() for x in pair])
    asked = missing.select(routes.route_entity(routes.static_route(profile)("url", F.lit(None).cast("string"))).alias("e")).where("e IS NOT NULL")
    asked = asked.select(F.try_element_at(era, F.col("e.namespace")).alias("era"), "e.kind", "e.id").distinct()
    topics = archive.topics.select("era", F.lit("topicos").alias("kind"), F.col("topic_id").alias("id"))
    known = topics.union(archive.forums.select("era", F.lit("foruns"), "forum_id")).union(archive.users.where("historical_id IS NOT NULL").select("era", F.lit("usuarios"), "historical_id"))
    topic = ["era", F.lit("topicos").alias("kind"), F.col("topic_id").alias("id")]
    owner = ["owner_era", "owner_kind", "owner_id"]
    by_forum = archive.topics.select(*topic, F.col("era").alias("owner_era"), F.lit("foruns").alias("owner_kind"), F.col("forum_id").alias("owner_id"))
    people = archive.users.where("historical_id IS NOT NULL").select("user_identity", F.col("era").alias("owner_era"), F.lit("usuarios").alias("owner_kind"), F.col("historical_id").alias("owner_id"))
    by_user = archive.posts.where("topic_id IS NOT NULL").select("user_identity", *topic).join(people, "user_identity")
    return materialize(relations.with_members(asked, known, ["era", "kind", "id"], [(by_forum, owner), (by_user, owner)]))


def homepage(pages: DataFrame) -> DataFrame:
    """The portal, else an index page: the newest (A13); raises without one."""
    path = F.lower(urls.path(F.col("original_url")))
    portal = path.endswith("/portal.php")
    found = relations.newest(pages.where(portal | path.rlike(r"(/index\.php|/default\.aspx|/forum/)$")), portal, ["timestamp", "capture_id"])
    gates.require_some(found, "no home page")
    return found


def entity_pages(plan: DataFrame, archive: Archive) -> DataFrame:
    """(route, title, body): generated pages of topics, forums and users, posts in page order."""
    esc = escape_html
    # authors whose page is written too are links to it
    name = esc(F.col("author_name"))
    author = F.when(F.col("author_page").isNotNull(), F.concat(F.lit('<a href="../../usuarios/'), F.col("author_page").cast("string"), F.lit('/index.html">'), name, F.lit("</a>"))).otherwise(name)
    line = F.concat(F.lit("<article><h3>"), author, F.lit("</h3><time>"), esc(F.col("posted_at")), F.lit("</time><div>"), esc(F.col("body_text")), F.lit("</div></article>"))
    joined = lambda *order: relations.joined_in_order(order, line)
    kinds = {k: plan.where(F.col("kind") == k) for k in ("topicos", "foruns", "usuarios")}
    people = archive.users.join(kinds["usuarios"].select("era", F.col("id").alias("historical_id")), ["era", "historical_id"], "left_semi")
    posts = archive.posts.drop("historical_id").join(people.select("user_identity", F.col("historical_id").alias("author_page")), "user_identity", "left")
    of_topics = posts.join(kinds["topicos"].select("era", F.col("id").alias("topic_id")), ["era", "topic_id"], "left_semi").groupBy("era", "topic_id").agg(F.max("topic_title").alias("title"), joined("posted_at", "identity_sha256").alias("body")).select("era", F.lit("topicos").alias("kind"), F.col("topic_id").alias("id"), "title", "body")
    of_users = posts.drop("era").join(people.select("user_identity", "era", "historical_id", "username"), "user_identity").groupBy("era", "historical_id", "username").agg(joined("posted_at", "identity_sha256").alias("body")).select("era", F.lit("usuarios"), "historical_id", "username", "body")
    item = F.concat(F.lit("<li>"), esc(F.col("title")), F.lit("</li>"))
    rows = archive.topics.join(kinds["foruns"].select("era", F.col("id").alias("forum_id")), ["era", "forum_id"], "left_semi").groupBy("era", "forum_id").agg(relations.joined_in_order(["last_posted_at", "topic_id"], item).alias("body"))
    of_forums = rows.join(archive.forums.select("era", "forum_id", "name"), ["era", "forum_id"]).select("era", F.lit("foruns"), "forum_id", "name", "body")
    made = of_topics.union(of_users).union(of_forums)
    return materialize(made.select("era", "kind", "id", F.coalesce("title", F.lit("")).alias("title"), "body"))


def posts_outside(archive: Archive, pages: DataFrame, period: Period | None, profile: SiteProfile = FORUM) -> DataFrame:
    """(capture_id, outside): positions of the selected pages' posts that the period leaves out."""
    if period is None:
        return pages.select("capture_id", F.array().cast("array<int>").alias("outside")).limit(0)
    content = archive.captures.select("capture_id", "original_url", "timestamp", "sha256", "era", "content").join(pages.select("capture_id"), "capture_id", "left_semi")
    posts = forum.posts_of(forum.parse_pages(content, profile)).where(~inside(F.col("posted_at"), period))
    return posts.groupBy("capture_id").agg(F.collect_set("position").alias("outside"))


def resource_files(archive: Archive, resources: DataFrame, profile: SiteProfile = FORUM) -> DataFrame:
    """(path, content) of every resource that pages or style sheets reach, one copy of each target."""
    one = resources.groupBy("target").agg(F.min("capture_id").alias("capture_id"))
    loads = resources.groupBy(F.col("referrer").alias("capture_id")).agg(F.map_from_entries(F.collect_set(F.struct("canonical_url", "target"))).alias("loads"))
    content = archive.captures.select("capture_id", "original_url", "mimetype", "content")
    return rewrite.publish_resources(one.join(content, "capture_id").join(loads, "capture_id", "left"), profile)


def entity_files(made: DataFrame, sources: DataFrame | None = None, profile: SiteProfile = FORUM) -> DataFrame:
    """(path, html) of generated pages: shell, way back, source routes and body.

    ``sources`` is (era, kind, id, route): captured pages that show an entity.
    """
    space = F.create_map(*[F.lit(x) for e in profile.eras for x in (e.name, e.namespace)])
    path = F.concat_ws("/", F.try_element_at(space, F.col("era")), "kind", F.col("id").cast("string"), F.lit("index.html"))
    rows = made.withColumn("path", path)
    if sources is not None:
        item = F.concat(F.lit('<li><a href="../../../'), escape_html(F.col("route")), F.lit('">'), escape_html(F.col("route")), F.lit("</a></li>"))
        seen = sources.groupBy("era", "kind", "id").agg(relations.joined_in_order(["route"], item).alias("seen"))
        rows = rows.join(seen, ["era", "kind", "id"], "left")
    else:
        rows = rows.withColumn("seen", F.lit(None).cast("string"))
    title = escape_html(F.col("title"))
    robots = F.when(F.col("kind") == "usuarios", F.lit('<meta name="robots" content="noindex,follow">')).otherwise(F.lit(""))
    listed = F.coalesce(F.concat(F.lit("<h2>Capturas</h2><ul>"), "seen", F.lit("</ul>")), F.lit(""))
    html = F.concat(
        F.lit('<!doctype html>\n<html><head><meta charset="utf-8"><meta http-equiv="Content-Security-Policy" content="'), escape_html(F.lit(rewrite.POLICY)), F.lit('">'), robots, F.lit("<title>"), title,
        F.lit('</title></head><body><nav><a href="../../../index.html">Arquivo</a></nav><main><h1>'), title, F.lit("</h1>"), F.col("body"), listed, F.lit("</main></body></html>"),
    )
    return rows.select("path", html.alias("html"))


def escape_html(text) -> Column:
    """Text for elements and quoted attributes; control characters but tab and line ends go."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def require_entities(plan: DataFrame, made: DataFrame) -> None:
    """Every planned entity has a page."""
    gates.require_none(plan.join(made.select("era", "kind", "id"), ["era", "kind", "id"], "left_anti"), "planned entities without a page")


def build_metrics(archive: Archive, pages: DataFrame, resources: DataFrame, lost_pages: DataFrame, lost_resources: DataFrame, made: DataFrame, restored: DataFrame) -> DataFrame:
    """One row: what a site was built of (K9, A7, A9).  Each part is counted once, in its own aggregate."""
    parts = {
        "posts": archive.posts, "topics": archive.topics, "users": archive.users, "activities": archive.evidence, "captured_pages": pages, "copied_resource_blobs": resources.select("target").distinct(),
        "generated_entity_pages": made, "restored_entity_links": restored, "neutralized_uncaptured_page_links": lost_pages, "neutralized_uncaptured_resources": lost_resources,
    }
    counts = None
    for name, df in parts.items():
        n = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        counts = n if counts is None else counts.union(n)
    others = pages.agg(F.coalesce(F.sum("duplicates"), F.lit(0)).alias("n")).select(F.lit("discarded_duplicate_routes").alias("name"), "n")
    counts = counts.union(others)
    names = [*parts, "discarded_duplicate_routes"]
    return counts.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names], F.lit("UTF-8").alias("encoding"))


def site_files(archive: Archive, rendered: DataFrame, made: DataFrame, resources: DataFrame, report: str, profile: SiteProfile = FORUM) -> DataFrame:
    """(path, content) of a whole site, for ``sinks.write_files``."""
    spark = rendered.sparkSession
    own = rendered.select(F.col("route").alias("path"), F.col("html").cast("binary").alias("content"))
    fixed = spark.createDataFrame([("build-manifest.json", bytearray((report + "\n").encode())), (".nojekyll", bytearray()), (rewrite.SEARCH_STYLE, bytearray(rewrite.STYLE.encode()))], "path string, content binary")
    generated = entity_files(made, profile=profile).select("path", F.col("html").cast("binary").alias("content"))
    generated = generated.join(own.select("path"), "path", "left_anti")  # captured pages go first
    return own.unionByName(generated).unionByName(resource_files(archive, resources, profile)).unionByName(fixed)


def render_site(archive: Archive, pages: DataFrame, resolved: DataFrame, resources: DataFrame, profile: SiteProfile = FORUM, period: Period | None = None, home: DataFrame | None = None, search: bool = False) -> DataFrame:
    """(route, html) of all selected pages with local links, and of ``home`` once more as index.html (K7)."""
    if home is not None:
        pages = pages.unionByName(home.select(*[F.lit("index.html").alias(c) if c == "route" else F.col(c) for c in pages.columns]))
    links = archive.references.join(pages.select("capture_id", "timestamp"), "capture_id").join(resolved.where("path IS NOT NULL").withColumnRenamed("url", "target_url"), ["target_url", "timestamp"])
    links = links.groupBy("capture_id").agg(F.map_from_entries(F.collect_set(F.struct("target_url", "path"))).alias("links"))
    loads = resources.groupBy(F.col("referrer").alias("capture_id")).agg(F.map_from_entries(F.collect_set(F.struct("canonical_url", "target"))).alias("resources"))
    content = archive.captures.select("capture_id", "content")
    outside = posts_outside(archive, pages, period, profile)
    return materialize(rewrite.render(pages.join(content, "capture_id").join(links, "capture_id", "left").join(loads, "capture_id", "left").join(outside, "capture_id", "left"), profile, search))
