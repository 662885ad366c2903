import base64
import hashlib
import json

import pytest

from palimpsest.operators.gates import IntegrityError
from palimpsest.plans import restore
from palimpsest.sources import manifest
from palimpsest.sources.manifest import Period

BASE = "http://forum.example.net/phpbb3"


def topic_page(post_id, author, body, date="Fri Mar 5, 2004 9:15 pm"):
    return f"<html><head><link rel='stylesheet' href='/s.css'><link rel='up' href='viewforum.php?f=3' title='Geral'></head><body><div id='pageheader'><h2>Titulo</h2></div><table><tr><td><a name='p{post_id}'></a><b class='postauthor'>{author}</b></td><td>Posted: {date}</td></tr><tr><td><a href='memberlist.php?mode=viewprofile&u=9'>x</a></td><td><div class='postbody'>{body}</div></td></tr></table><a href='viewtopic.php?t=77'>outro</a><a href='viewtopic.php?t=5'>este</a></body></html>".encode()


def archive(tmp_path, files):
    rows, blobs = [], []
    for ts, url, mime, raw in files:
        sha, digest = hashlib.sha256(raw).hexdigest(), base64.b32encode(hashlib.sha1(raw).digest()).decode()
        rows.append({"timestamp": ts, "original_url": url, "statuscode": "200", "mimetype": mime, "digest": digest, "payload_digest": digest, "cdx_digest_matches_payload": True, "length": "1", "retrieved_length": str(len(raw)), "sha256": sha, "path": f"blobs/{sha[:2]}/{sha}", "source": "wayback"})
        blobs.append((sha, bytearray(raw)))
    path = tmp_path / "captures.jsonl"
    path.write_text("\n".join(map(json.dumps, rows)))
    return str(path), sorted({(s, bytes(b)) for s, b in blobs})


FILES = [
    ("20040401000000", f"{BASE}/viewtopic.php?t=5", "text/html", topic_page(12, "Ana", "antigo")),
    ("20050401000000", f"{BASE}/viewtopic.php?t=5", "text/html", topic_page(12, "Ana Maria", "novo")),
    ("20050401000000", f"{BASE}/index.php", "text/html", b"<html><body><a href='viewtopic.php?t=5'>t</a><img src='/x.gif'></body></html>"),
    ("20050301000000", "http://forum.example.net/s.css", "text/css", b"@import 't.css'; a{b:url(/x.gif)}"),
    ("20050302000000", "http://forum.example.net/t.css", "text/css", b"@import 's.css';"),
    ("20050302000000", "http://forum.example.net/x.gif", "image/gif", b"GIF89a"),
]


def test_end_to_end(spark, tmp_path):
    path, blobs = archive(tmp_path, FILES)
    rows = manifest.read_manifest(spark, path)
    period = Period("2004-01-01T00:00:00", "2004-03-05T21:15:00", 12, "2004-03-05T21:15:00", "20050401000000", f"{BASE}/viewtopic.php?t=5", "A" * 32)
    a = restore.restore(rows, spark.createDataFrame(blobs, "sha256 string, content binary"), period)
    (post,) = a.posts.collect()
    assert (post.historical_id, post.author_name, post.body_text, post.best_capture_timestamp, post.topic_title) == (12, "Ana Maria", "novo", "20050401000000", "Titulo")
    assert a.post_sources.count() == 2
    (topic,) = a.topics.collect()
    assert (topic.topic_id, topic.forum_id, topic.first_posted_at, topic.first_seen, topic.last_seen) == (5, 3, "2004-03-05T21:15:00", "20040401000000", "20050401000000")
    (user,) = a.users.collect()
    assert (user.user_identity, user.username, user.post_count) == ("id:phpbb3:9", "Ana Maria", 1)
    assert a.forums.first().name == "Geral"
    restore.require_terminal_post(a, period)
    assert restore.capture_id(a, f"{BASE}/index.php", "20050401000000") == a.captures.where(f"original_url = '{BASE}/index.php'").first().capture_id
    with pytest.raises(LookupError):
        restore.capture_id(a, f"{BASE}/index.php", "19990101000000")

    pages = restore.select_pages(a)
    assert {r.route: r.duplicates for r in pages.collect()} == {"phpbb3/topicos/5/index.html": 1, "phpbb3/index.html": 0}
    assert restore.homepage(pages).first().route == "phpbb3/index.html"
    aliases, posts = restore.route_aliases(a, pages)
    links = a.references.where("kind = 'page'").join(pages.select("capture_id", "timestamp"), "capture_id").selectExpr("target_url AS url", "timestamp")
    resolved = restore.resolve_links(links, pages, aliases, posts)
    paths = {r.url: r.path for r in resolved.collect()}
    assert paths[f"{BASE}/viewtopic.php?t=5"] == "phpbb3/topicos/5/index.html" and paths[f"{BASE}/viewtopic.php?t=77"] is None
    lost = restore.missing_pages(a, pages, resolved)
    assert f"{BASE}/viewtopic.php?t=77" in {r.url for r in lost.collect()}
    assert restore.entity_plan(lost, a).collect()[0].kind == "usuarios"

    resources, missing = restore.resource_closure(a, pages)
    assert {r.canonical_url.rpartition("/")[2] for r in resources.collect()} == {"s.css", "t.css", "x.gif"} and missing.count() == 0
    site = {r.route: r.html for r in restore.render_site(a, pages, resolved, resources).collect()}
    assert 'href="../topicos' not in site["phpbb3/index.html"] and 'href="topicos/5/index.html"' in site["phpbb3/index.html"]
    assert "archive-link-missing" in site["phpbb3/topicos/5/index.html"] and "recursos/" in site["phpbb3/index.html"]
    from palimpsest.functions import rewrite

    targets = pages.selectExpr("route AS target").union(resources.select("target"))
    assert rewrite.output_problems(restore.render_site(a, pages, resolved, resources), targets).count() == 0
    made = restore.entity_pages(restore.entity_plan(lost, a), a)
    assert any("novo" in r.body for r in made.collect())


def board_page(posts, title="T"):
    rows = "".join(f"<table><tr><td><a name='p{i}'></a><b class='postauthor'>{a}</b></td><td>Posted: {d}</td></tr><tr><td><a href='memberlist.php?mode=viewprofile&u={9 + i}'>x</a></td><td><div class='postbody'>{b}</div></td></tr></table>" for i, a, b, d in posts)
    return f"<html><head><link rel='stylesheet' href='/s.css'><link rel='up' href='viewforum.php?f=3' title='Geral'></head><body><div id='pageheader'><h2>{title}</h2></div>{rows}<a href='viewforum.php?f=3&sid=1'>f</a><a href='viewtopic.php?t=5#p1'>self</a><img src='/d.svg'></body></html>".encode()


def test_a_whole_site(spark, tmp_path):
    from palimpsest.functions import rewrite
    from palimpsest.sources import sinks

    inside, outside = "Fri Mar 5, 2004 9:15 pm", "Fri Mar 5, 2010 9:15 pm"
    files = [
        ("20050401000000", f"{BASE}/viewtopic.php?t=5", "text/html", board_page([(1, "Ana", "dentro", inside), (2, "Bia", "fora", outside)])),
        ("20050401000000", f"{BASE}/portal.php", "text/html", b"<html><body><a href='viewtopic.php?t=5#p1'>t</a><a href='viewtopic.php?t=5#nope'>n</a></body></html>"),
        ("20050301000000", "http://forum.example.net/s.css", "text/css", b"a{b:url(/x.gif);behavior:url(y)} c{d:url(/gone.png)}"),
        ("20050501000000", "http://forum.example.net/s.css", "text/css", b"a{b:url(/x.gif);behavior:url(y)} c{d:url(/gone.png)}"),
        ("20050302000000", "http://forum.example.net/x.gif", "image/gif", b"GIF89a"),
        ("20050302000000", "http://forum.example.net/d.svg", "image/svg+xml", b"<svg onload='x'><script>1</script><path></path></svg>"),
    ]
    path, blobs = archive(tmp_path, files)
    period = Period("2004-01-01T00:00:00", "2005-03-05T21:15:00", 1, "2004-03-05T21:15:00", "20050401000000", f"{BASE}/viewtopic.php?t=5", "A" * 32)
    a = restore.restore(manifest.read_manifest(spark, path), spark.createDataFrame(blobs, "sha256 string, content binary"), period)
    assert [p.body_text for p in a.posts.collect()] == ["dentro"]
    pages = restore.select_pages(a)
    aliases, posts = restore.route_aliases(a, pages)
    links = a.references.where("kind = 'page'").join(pages.select("capture_id", "timestamp"), "capture_id").selectExpr("target_url AS url", "timestamp")
    resolved = restore.resolve_links(links, pages, aliases, posts)
    resources, lost_resources = restore.resource_closure(a, pages)
    lost = restore.missing_pages(a, pages, resolved)
    plan = restore.entity_plan(lost, a)
    made = restore.entity_pages(plan, a)
    restore.require_entities(plan, made)
    with pytest.raises(IntegrityError):
        restore.require_entities(plan, made.limit(0))

    rendered = restore.render_site(a, pages, resolved, resources, period=period, home=restore.homepage(pages), search=True)
    html = {r.route: r.html for r in rendered.collect()}
    topic = html["phpbb3/topicos/5/index.html"]
    assert "dentro" in topic and "fora" not in topic and 'href="index.html#p1"' in topic and "index.html" in html

    metrics = restore.build_metrics(a, pages, resources, lost, lost_resources, made, plan)
    report = sinks.build_report(metrics)
    counts = json.loads(report)
    assert (counts["posts"], counts["captured_pages"], counts["copied_resource_blobs"], counts["neutralized_uncaptured_resources"], counts["generated_entity_pages"]) == (1, 2, 3, 2, made.count())

    site = restore.site_files(a, rendered, made, resources, report)
    n = sinks.write_files(site, f"file://{tmp_path}/site")
    root = tmp_path / "site"
    assert n == site.count() == sum(p.is_file() for p in root.rglob("*"))
    (css,) = root.glob("recursos/**/s.css")
    assert "behavior" not in css.read_text() and "x.gif" in css.read_text() and 'url("data:,")' in css.read_text()
    (svg,) = root.glob("recursos/**/d.svg")
    assert "script" not in svg.read_text() and "onload" not in svg.read_text()
    assert (root / "phpbb3/foruns/3/index.html").read_text().startswith("<!doctype html>") and (root / ".nojekyll").exists()

    targets = site.selectExpr("path AS target").union(spark.createDataFrame([(rewrite.SEARCH_PAGE,)], "target string"))
    problems = {(r.reference.rpartition("#")[2], r.problem) for r in rewrite.output_problems(rendered, targets, site).collect()}
    assert problems == {("nope", "anchor")}
    generated = restore.entity_files(made).withColumnRenamed("path", "route")
    assert rewrite.output_problems(generated, targets.union(generated.select("route"))).count() == 0
    topics = restore.entity_pages(spark.createDataFrame([("phpbb3", "topicos", 5), ("phpbb3", "usuarios", 10)], "era string, kind string, id long"), a)
    assert '<a href="../../usuarios/10/index.html">Ana</a>' in topics.where("kind = 'topicos'").first().body
    bad = spark.createDataFrame([("a/b.html", "<a href='http://x/'>1</a><img src='../../c'><a href='gone.html'>2</a><form action='http://y/'></form><p style='a:image-set(x)'></p><svg><script></script></svg>")], "route string, html string")
    sheet = spark.createDataFrame([("r/s.css", bytearray(b"a{b:url(http://z/)}"))], "path string, content binary")
    found = sorted(r.problem for r in rewrite.output_problems(bad, targets, sheet).collect())
    assert found == ["active drawing", "broken", "external", "external", "external", "outside the site", "unsafe style"]


def test_the_first_post_of_a_page_speaks_for_its_forum(spark):
    rows = [("e", 1, 7, "20040101000000", "a", 0, None), ("e", 1, 7, "20040101000000", "a", 1, "late"), ("e", 1, 8, "20050101000000", "b", 0, "first"), ("e", 1, 8, "20050101000000", "b", 1, "second")]
    posts = spark.createDataFrame(rows, "era string, forum_id long, capture_id long, timestamp string, ord string, position int, forum_name string")
    got = restore._of_pages(posts, "forum_id", ["forum_name"]).collect()
    assert sorted((r.timestamp, r.forum_name) for r in got) == [("20040101000000", None), ("20050101000000", "first")]


def test_generated_text_is_escaped(spark):
    row = spark.createDataFrame([("a<b>&\"'\x01\tz",)], "t string").select(restore.escape_html("t").alias("t")).first()
    assert row.t == "a&lt;b&gt;&amp;&quot;&#x27;\tz"


def test_false_payload_is_rejected(spark, tmp_path):
    path, blobs = archive(tmp_path, FILES[:1])
    wrong = [(sha, raw + b"x") for sha, raw in blobs]
    with pytest.raises(IntegrityError):
        restore.restore(manifest.read_manifest(spark, path), spark.createDataFrame(wrong, "sha256 string, content binary"))


def test_bad_manifest_rows_are_rejected(spark, tmp_path):
    path, _ = archive(tmp_path, FILES[:1])
    row = json.loads(open(path).read())
    for change in ({"path": "../x"}, {"source": "disk"}, {"cdx_digest_matches_payload": False}, {"timestamp": "2004"}, {"requested_url": "http://a/"}):
        (tmp_path / "bad.jsonl").write_text(json.dumps(row | change))
        with pytest.raises(IntegrityError):
            manifest.read_manifest(spark, str(tmp_path / "bad.jsonl"))
    (tmp_path / "bad.jsonl").write_text("\n".join([json.dumps(row)] * 2))
    with pytest.raises(IntegrityError):
        manifest.read_manifest(spark, str(tmp_path / "bad.jsonl"))
    (tmp_path / "some.jsonl").write_text("\n".join(["no json", json.dumps(row | {"path": "../x"}), json.dumps(row)]))
    assert manifest.compact_manifest(spark, str(tmp_path / "some.jsonl")).count() == 1
