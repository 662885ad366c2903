import hashlib
import base64

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.functions import dates, encoding, forum, identity, markup, rewrite, routes, urls


@pytest.mark.parametrize(
    "raw, want",
    [
        ("05/03/2004 : 21:15:09", "2004-03-05T21:15:09"),
        ("5/3/04, 1:05", "2004-03-05T01:05:00"),
        ("Sex Mar 5, 2004 9:15 pm", "2004-03-05T21:15:00"),
        ("5 fev 2004, 12:00 am", "2004-02-05T00:00:00"),
        ("3-5-2004, 9:15 PM", "2004-03-05T21:15:00"),
        ("31/02/2004 10:00", None),
        ("31/02/2004 10:00 5 Mar 2004 10:00", None),
        ("5/3/75 10:00", "1975-03-05T10:00:00"),
        ("março 5, 2004 10:00", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "s string").select(dates.parse_forum_date(F.col("s"))).first()[0] == want


@pytest.mark.parametrize(
    "raw, want",
    [
        (b"<meta charset=iso-8859-1>\x93a\x94\x81", ("<meta charset=iso-8859-1>“a”\x81", "windows-1252")),
        ("ação".encode() + b" \xa9", ("ação ©", "utf-8/windows-1252-mixed")),
        ("á".encode(), ("á", "utf-8")),
        ("aÃ§Ã£o".encode(), ("ação", "utf-8")),
    ],
)
def test_decode(raw, want):
    assert encoding.decode(raw) == want


@given(st.binary(max_size=200))
@settings(max_examples=200, deadline=None)
def test_decode_never_raises(raw):
    assert isinstance(encoding.decode(raw)[0], str)


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_canonical_is_idempotent(text):
    once = urls.canonical(f"http://forum.example.net/{text}")
    assert urls.canonical(once) == once or "&" in once or "\\" in once or "%5C" in once


def test_canonical():
    assert urls.canonical("HTTPS://www.Forum.example.net:443//phpbb2/viewTopic.php?t\\0751&sid=abc&start=0#x") == "http://forum.example.net/phpbb2/viewtopic.php?t=1"
    assert urls.canonical("https://web.archive.org/web/2005id_/http://example.net/a") == "http://example.net/a"
    assert urls.canonical("http://[bad") == ""
    assert urls.canonical("http://example.net") == urls.canonical("http://example.net/") == "http://example.net/"
    assert urls.canonical("http://example.net?b=1&a=2") == "http://example.net/?a=2&b=1"


def test_targets_of_style_sheets_depend_on_their_time():
    one, other = (routes.resource_target("ab" * 32, "http://example.net/s.css", "text/css", t) for t in ("20040101000000", "20050101000000"))
    assert one != other and one.endswith("/20040101000000/s.css")
    assert routes.resource_target("ab" * 32, "http://example.net/x.gif", "image/gif", "20040101000000") == routes.resource_target("ab" * 32, "http://example.net/x.gif", "image/gif")


def test_stray_bytes_take_linear_time():
    import time

    began = time.monotonic()
    text, name = encoding.decode(b"a\xe7\xe3o \x81" * 100_000)
    assert name == "utf-8/windows-1252-mixed" and text == "ação \x81" * 100_000 and time.monotonic() - began < 20


def test_links_keep_their_fragment_and_lose_their_session():
    html = b"<a href='viewtopic.php?t=5&sid=abc'>a</a><a href='viewtopic.php?t=5#p12'>b</a><a href='http://web.archive.org/web/2005/http://forum.example.net/phpbb3/viewtopic.php?t=5'>c</a><a href='http://web.archive.org/x'>d</a>"
    known = {"http://forum.example.net/phpbb3/viewtopic.php?t=5": "phpbb3/topicos/5/index.html"}
    out = rewrite.preserve_page(html, "http://forum.example.net/phpbb3/index.php", "phpbb3/index.html", lambda u: known.get(urls.canonical(u)), {}.get)
    assert out.count('href="topicos/5/index.html"') == 2 and 'href="topicos/5/index.html#p12"' in out and out.count("archive-link-missing") == 1


def test_posts_outside_the_period_are_taken_out():
    post = "<table class='tablebg'><tr><td><a name='p{0}'></a><b class='postauthor'>A</b></td><td>Posted: {1}</td></tr><tr><td><div class='postbody'>body{0}</div></td></tr></table>"
    html = "<html><body>" + post.format(1, "x") + post.format(2, "y") + "</body></html>"
    out = rewrite.preserve_page(html.encode(), "http://forum.example.net/phpbb3/viewtopic.php?t=1", "phpbb3/topicos/1/index.html", {}.get, {}.get, "phpbb3", frozenset({1}), search=True)
    assert "body1" in out and "body2" not in out and 'action="../../../busca/index.html"' in out and 'href="../../../assets/archive-search.css"' in out

def test_digest(spark):
    raw = b"payload"
    got = spark.createDataFrame([(bytearray(raw),)], "c binary").select(identity.payload_digest(F.col("c"))).first()[0]
    assert got == base64.b32encode(hashlib.sha1(raw).digest()).decode()


def test_names():
    assert identity.fold_name(" Straße ÁÉ ") == "strasse ae"


@pytest.mark.parametrize("kind, text", [("page_references", '<a href="/x">x</a><img src="y.png">'), ("stylesheet_references", "a{b:url(/x)} @import 'y.css';")])
def test_references_are_read_once_in_small_pieces(spark, kind, text):
    column = getattr(markup, kind)()
    rows = [(text, "http://e.org/a/"), (None, "http://e.org/"), (text, None), ("", "http://e.org/")]
    frame = spark.createDataFrame(rows, "text string, url string")
    found = frame.select("url", column(F.col("text"), F.col("url")).alias("refs"))
    exploded = found.select("url", F.explode("refs").alias("r")).groupBy("r.url").count()
    assert exploded._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("ArrowEvalPython [") == 1
    assert sorted(len(r.refs) for r in found.collect()) == [0, 0, 0, 2]
    assert {r.url for r in exploded.collect()} == {"http://e.org/x", "http://e.org/a/y.png" if "href" in text else "http://e.org/a/y.css"}
    pieces = list(column.func(iter([(pa.array([text] * 300), pa.array(["http://e.org/"] * 300))])))
    assert sum(map(len, pieces)) == 300 and max(map(len, pieces)) <= 64


def test_css_and_srcset():
    assert markup.css_references("/* url(a) */ b{c:url( 'd.png' )} @import \"e.css\"; f{g:'url(h)'}") == ["d.png", "e.css"]
    assert markup.rewrite_css("a{b:url(x)} @import 'y';", {}.get) == 'a{b:url("data:,")} '
    assert markup.parse_srcset("data:image/gif;base64,AA== 1x, b.png 2x") == [("data:image/gif;base64,AA==", "1x"), ("b.png", "2x")]
    assert markup.clean_css("color:red;behavior:url(x)") == "color:red;"
    assert markup.clean_css("a{color:red;width:expression(f(1));b:c} d{behavior:url(x)} /* expression( */ e{f:'javascript:'}") == "a{color:red;b:c} d{} /* expression( */ e{f:'javascript:'}"
    assert markup.clean_css("color:red;width:exp\\72 ession(1);b:c") == "color:red;b:c"
    assert [markup.clean_css(x) for x in ("a{b:u\\72l(http://x)}", "a{b:-webkit-image-set('x' 1x)}", "@\\69mport 'x';")] == ["", "", ""]


def test_tree_is_tolerant():
    root = markup.parse('<p><b>a<p>b<script>var t="</p>";</script><ul><li>c<li>d</ul>')
    assert len(root.find("p")) == 2 and len(root.find("li")) == 2


@pytest.mark.parametrize(
    "url, want",
    [
        ("http://forum.example.net/phpbb3/viewtopic.php?f=1&t=49", "phpbb3/topicos/49/index.html"),
        ("http://forum.example.net/phpbb2/viewtopic.php?t=4&start=15", "phpbb2/topicos/4/inicio/15/index.html"),
        ("http://example.net/forum/topic.asp?TOPIC_ID=7&whichpage=1", "forum/topicos/7/index.html"),
        ("http://forum.example.net/forums/permalink/5/6/ShowThread.aspx", "comunidade/topicos/5/index.html"),
        ("http://forum.example.net/phpbb3/ucp.php?mode=login", "phpbb3/acoes/login/index.html"),
        ("http://forum.example.net/phpbb3/search.php?q=1", "busca/index.html"),
        ("http://other.example/", None),
    ],
)
def test_routes(url, want):
    assert routes.route(url, "20080101000000") == want


def test_snitz_topic_and_listing():
    page = b"<table><tr><td><a href='pop_profile.asp?id=4'>Rui</a></td><td><a name='33'></a>Postado - 05/03/2004 :  21:15:09<hr><span>Oi <i>x</i></span></td></tr></table><a href='post.asp?Topic_Title=Ol%E1'>r</a>"
    got = forum.read_page(page, "http://example.net/forum/topic.asp?TOPIC_ID=9", "snitz")
    (post,) = got["posts"]
    assert (post["author_name"], post["author_id"], post["post_id"], post["body_text"], got["topic_id"]) == ("Rui", 4, 33, "Oi x", 9)
    row = b"<table><tr><td></td><td><a href='topic.asp?TOPIC_ID=5'>T</a></td><td>Ana</td><td>1</td><td>2</td><td>05/03/2004 10:00 <a href='pop_profile.asp?id=8'>Bia</a></td></tr></table>"
    (listing,) = forum.read_page(row, "http://example.net/forum/forum.asp?FORUM_ID=2", "snitz")["listings"]
    assert (listing["topic_id"], listing["forum_id"], listing["author_name"], listing["last_author_id"]) == (5, 2, "Ana", 8)


def test_phpbb2_and_print_and_community():
    two = b"<table><tr><td><a name='7'></a><b>Ze</b></td><td><span class='largetext'>corpo</span></td></tr><tr><td>Sex Mar 5, 2004 9:15 pm <a href='profile.php?mode=viewprofile&u=3'>p</a></td></tr></table><td class='toprow'><b>Tit</b></td>"
    (post,) = forum.read_page(two, "http://example.net/phpbb2/viewtopic.php?t=1", "phpbb2")["posts"]
    assert (post["author_id"], post["raw_date"], post["body_text"]) == (3, "Sex Mar 5, 2004 9:15 pm", "corpo")
    pr = b"<div id='page-header'><h2>T</h2></div><div class='post'><div class='author'><strong>A</strong></div><div class='date'><strong>5 Mar 2004 10:00</strong></div><div class='content'>c</div></div>"
    (post,) = forum.read_page(pr, "http://example.net/phpbb3/viewtopic.php?t=1&view=print", "phpbb3")["posts"]
    assert post["post_id"] is None and post["author_id"] is None and post["raw_date"] == "5 Mar 2004 10:00"
    cs = b"<a href='/forums/12/ShowForum.aspx'>F</a><div class='ForumPostArea'><h4 class='ForumPostHeader'><a name='55'></a>3-5-2004, 9:15 PM</h4><ul><li class='ForumPostUserName'><a>U</a></li></ul><img src='avatar.aspx?userid=6'><div class='ForumPostContentText'>c</div></div>"
    page = forum.read_page(cs, "http://forum.example.net/forums/thread/4.aspx", "community-server")
    assert page["forum_id"] == 12 and page["posts"][0]["author_id"] == 6 and page["posts"][0]["raw_date"] == "3-5-2004, 9:15 PM"


def test_rewriting_is_local_and_inert():
    html = b"<html><body onload='x'><script>1</script><a href='/a#f'>k</a><a href='/gone'>g</a><a href='javascript:x'>j</a><img src='/i.png'><form action='/p'><input></form><svg onload='y'><style>z</style></svg></body></html>"
    out = rewrite.preserve_page(html, "http://forum.example.net/x", "phpbb3/topicos/1/index.html", {"http://forum.example.net/a#f": "b/index.html#f"}.get, {"http://forum.example.net/i.png": "r/i.png"}.get)
    assert 'href="../../../b/index.html#f"' in out and 'src="../../../r/i.png"' in out
    assert "<script" not in out and "onload" not in out and "/gone" not in out and "javascript" not in out and 'action=' not in out.replace("form-action", "")
    assert "<style" not in out and 'disabled="disabled"' in out


def test_svg():
    assert rewrite.preserve_svg("<svg onclick='a'><script>b</script><a href='http://x'><path style='c'></path></a></svg>") == "<svg><a><path></path></a></svg>"
