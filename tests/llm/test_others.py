"""Tokens, shards, URL filters and the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from palimpsest.llm import bpe, quality_rules, sharding, url_filter
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def pair():
    path = bpe.production_tokenizer()
    return bpe.load(path), tokenizers.Tokenizer.from_file(path)


def odd_texts():
    rng = random.Random(6)
    parts = ["a", "the ", " ", "\n", "\r\n", "\t", "'s", "'ll", "é", "日本", "😀", "1", "12", "!?", "<|endoftext|>", " ", " ", " ", "\x1c", "\x85", "\u200b", "ſ", "ing", "tion", "ß", "e\u0301"]
    return ["", " ", "abc" * 4000, "é" * 3000, "a" * 5000] + ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(800)]


def test_tokens_equal_the_library(pair):
    ours, theirs = pair
    texts = odd_texts()
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        want = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:60]
        assert ours.decode_bytes(ids).decode("utf-8", "replace") == theirs.decode(want, skip_special_tokens=False)


def test_cache_generations(pair, monkeypatch):
    ours, _ = pair
    texts = odd_texts()[:200]
    want = ours.encode(texts)
    monkeypatch.setattr(ours.words, "limit", 3)
    monkeypatch.setattr(ours.chunks, "limit", 3)
    assert [x for t in texts for x in ours.encode([t])] == want


def test_tokens_of_odd_rows(odd, none, odd_rows):
    rows = bpe.encode_decode(odd, bpe.production_tokenizer(), keep_ids=True).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest() and r.n_tokens * 4 == len(r.ids)
    assert sorted((r.decoded for r in rows)) == sorted((t or "") for _, t, *_ in odd_rows)
    assert bpe.encode_decode(none, bpe.production_tokenizer()).count() == 0


def test_shards_are_even_and_slots_gapless(spark):
    rng = random.Random(9)
    rows = [(i, "x" * rng.randint(0, 90), rng.choice("ab")) for i in range(600)] + [(1000 + i, "same text of a third of all", "a") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    got = sharding.shard_by_bytes(docs, 7, {"id": F.col("doc_id"), "size": F.length("text"), "lang": F.crc32(F.col("lang").cast("binary"))}).toPandas()
    assert len(got) == 900 and set(got["shard"]) == set(range(7))
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() <= 0.02 * sums.mean() + 2 * got["size"].max()
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))


def brute_leaves(rows, n_dims, shards):
    """The leaf of each (dims..., size, tie) by recursion over sorted keys."""
    steps, shift = (1 << sharding.VALUE_BITS) - 1, sharding.GROUP_BITS + sharding.ID_BITS
    spread = lambda own, d: max(rows[i][d] for i in own) - min(rows[i][d] for i in own)
    whole = [spread(range(len(rows)), d) or 1.0 for d in range(n_dims)]
    out = {}

    def part(own, first, count):
        if count == 1 or not own:
            out.update(dict.fromkeys(own, first))
            return
        d = max(range(n_dims), key=lambda d: spread(own, d) / whole[d])
        low, extent = min(rows[i][d] for i in own), spread(own, d) or 1.0
        keys = {i: (min(max(int((rows[i][d] - low) / extent * steps), 0), steps) << shift) + rows[i][-1] for i in own}
        weight = {}
        for i, k in keys.items():
            weight[k] = weight.get(k, 0) + rows[i][-2]
        half = (count + 1) // 2
        rest, ordered = sum(weight.values()) * half / count, sorted(weight)
        for k in ordered:
            if weight[k] > rest or k == ordered[-1]:
                break
            rest -= weight[k]
        cut = k + (rest > weight[k] / 2)
        part([i for i in own if keys[i] < cut], first, half)
        part([i for i in own if keys[i] >= cut], first + half, count - half)

    part(list(range(len(rows))), 0, shards)
    return out


def test_leaves_against_brute_force(spark, monkeypatch):
    rng = random.Random(13)
    monkeypatch.setattr(sharding, "TOLERANCE", 0.0)
    rows = [(float(rng.randint(0, 50)), rng.choice([1.0, 2.0, 9.0]), rng.randint(16, 400), rng.getrandbits(40)) for _ in range(400)]
    rows += [(7.0, 1.0, 50, rng.getrandbits(24)) for _ in range(200)]
    points = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, a double, b double, size long, _tie long").repartition(3)
    got = {r.i: r["shard"] for r in sharding.grow(points, ["a", "b"], 7).collect()}
    assert got == brute_leaves(rows, 2, 7) and len(set(got.values())) == 7


def test_copies_share_a_shard(spark):
    rng = random.Random(14)
    rows = [(i, f"text {i} " * rng.randint(1, 30), rng.choice("ab"), rng.choice("xyz")) for i in range(300)]
    rows += [(1000 + 5 * g + i, f"copy {g} " * 9, "a", "x") for g in range(20) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    code = lambda c: F.crc32(F.col(c).cast("binary"))
    got = {r.doc_id: r["shard"] for r in sharding.shard_by_bytes(docs, 6, {"copies": code("text"), "length": F.length("text"), "lang": code("lang"), "source": code("source")}).collect()}
    together = sum(len({got[1000 + 5 * g + i] for i in range(4)}) == 1 for g in range(20))
    assert together >= 15  # 5 cuts part at most 5 groups


def test_shards_of_odd_rows(odd, none, odd_rows):
    dims = {"id": F.col("doc_id"), "n": F.col("n_chars")}
    got = sharding.shard_by_bytes(odd, 40, dims).collect()
    assert len(got) == len(odd_rows) and {r["size"] for r in got if r.doc_id == 3} == {16} and all(0 <= r["shard"] < 40 for r in got)
    assert sharding.shard_by_bytes(none, 40, dims).count() == 0


def test_urls(spark):
    rows = [(0, None), (1, "no scheme"), (2, "http://EXAMPLE.org/es/1?x#y"), (3, "https://a.example.org/en/12"), (4, "http://b.com/fr/x"), (5, "http://b.com/de/x"), (6, "http://b.com"), (7, "http://org/"), (8, "x://a://b/c"), (9, "http://h.net?u=://z/"), (10, "http://notexample.org/es/"), (11, "http://h.net#a://b/c"), (12, "://"), (13, "http://u.net/" + "a/" * 3000 + "?q"), (14, "")]
    rows += [(100 + i, f"http://s.net/spam/{i}") for i in range(60)] + [(200 + i, f"http://s.net/news/{i}.html") for i in range(60)] + [(300 + i, f"http://slugs.net/{chr(97 + i % 26)}{'x' * i}") for i in range(60)]
    pages = spark.createDataFrame(rows + [rows[2]], "page_id bigint, url string").withColumn("shape", F.lit(1)).withColumn("n", F.lit(1)).withColumn("host", F.lit(1))
    for bad, good in ((range(100, 140), range(200, 240)), (range(100, 130), range(200, 260))):
        labels = spark.createDataFrame([(i, i < 200) for i in (*bad, *good)], "_id bigint, bad boolean").withColumn("page_id", F.lit(3)).withColumn("host", F.lit("x"))
        found = url_filter.filter_urls(pages, labels).collect()
        got = {r.page_id: r for r in found}
        assert len(found) == len(rows) + 1 and [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(12)] == [
            ("", "", None, "allow"), ("", "", None, "allow"), ("example.org", "/es/1", "example.org/es/", "block"), ("a.example.org", "/en/12", "example.org/en/1", "block"), ("b.com", "/fr/x", "com/fr/", "allow"), ("b.com", "/de/x", "com/de/", "block"),
            ("b.com", "", None, "allow"), ("org", "/", "org/", "allow"), ("a:", "//b/c", None, "allow"), ("h.net", "", None, "allow"), ("notexample.org", "/es/", "org/", "allow"), ("h.net", "", None, "allow"),
        ]
        # hosts without a label are allowed, though half of all labels are bad in the first case
        assert got[150].verdict == "block" and got[150].template == "/spam/**" and got[250].verdict == "allow" and got[310].verdict == "allow"
        assert got[13].path == "/" + "a/" * 3000 and got[13].verdict == "allow"
    assert len(url_filter.filter_urls(pages, labels.limit(0)).where("verdict = 'block' AND rule IS NULL").collect()) == 0
    assert url_filter.filter_urls(pages.limit(0), labels).count() == 0


def brute_templates(pages, labels, support, z, alpha, reject):
    """(template, blocked) by page id: the tree of each host, by recursion over lists."""
    shapes, hosts, out = {}, {}, {}
    for i, url in pages:
        host, _, path = url.split("://", 1)[1].partition("/")
        shapes[i] = ["{n}" if re.fullmatch(r"[0-9]+(\.[A-Za-z]+)?", s) else "{x}" if re.search("[0-9]", s) else s for s in path.split("/")]
        hosts.setdefault(host, []).append(i)
    count = lambda ids: (sum(i in labels for i in ids), sum(labels.get(i, 0) for i in ids))

    def part(ids, depth, template, parent):
        labelled, bad = count(ids)
        rate = (bad + alpha * parent) / (labelled + alpha)
        blocked = rate >= reject and labelled > 0
        deeper = [i for i in ids if len(shapes[i]) > depth]
        parted = len(ids) >= support and 0 < bad < labelled
        for i in ids:
            if len(shapes[i]) <= depth:
                out[i] = (template, blocked)
            elif not parted:
                out[i] = (template + "/**", blocked)
        if not parted:
            return
        kids, branches = {}, {}
        for i in deeper:
            kids.setdefault(shapes[i][depth], []).append(i)
        al, ab = count(deeper)
        for seg, own in kids.items():
            l, b = count(own)
            keep = seg in ("{n}", "{x}")
            if not keep and len(own) >= support and 0 < l < al:
                p = ab / al
                keep = abs(b / l - (ab - b) / (al - l)) > z * (p * (1 - p) * (1 / l + 1 / (al - l))) ** 0.5
            branches.setdefault(seg if keep else "*", []).extend(own)
        for seg, own in branches.items():
            part(own, depth + 1, f"{template}/{seg}", rate)

    prior = sum(labels.values()) / len(labels)
    for ids in hosts.values():
        part(ids, 0, "", prior)
    return out


def test_template_tree_against_brute_force(spark, monkeypatch):
    rng = random.Random(21)
    pages, labels = [], {}
    for i in range(2600):
        host = rng.choices(["hot.net", "b.net", "c.net"], [6, 2, 1])[0]
        path = [rng.choice(["en", "de", "shop", "tag"])] + [rng.choice(["old", "new", "7", "v2", "12.html", ""]) for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.1:
            path = [f"slug{''.join(rng.choices('abcdef', k=6))}"]
        pages.append((i, f"http://{host}/" + "/".join(path)))
        if rng.random() < 0.5:
            labels[i] = int(rng.random() < (0.95 if path[0] == "tag" or path[1:2] == ["old"] and host == "hot.net" else 0.15))
    frame = spark.createDataFrame([(i, bool(b)) for i, b in labels.items()], "_id bigint, bad boolean")
    docs = spark.createDataFrame(pages, "page_id bigint, url string").repartition(3)
    want = brute_templates(pages, labels, 20, 2.58, 10.0, 0.5)
    for share in (1000, 3):
        monkeypatch.setattr(url_filter, "SHARE", share)
        got = {r.page_id: (r.template, r.verdict == "block") for r in url_filter.filter_urls(docs, frame, rules=()).collect()}
        assert got == want
    assert len({t for t, _ in want.values()}) > 8 and 0 < sum(b for _, b in want.values()) < len(pages) / 2


def test_pipeline_against_brute_force(spark, tables):
    from tests.llm.test_pairs import brute_components, brute_hits

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    model = quality_rules.fit(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = []
    for i, t in rows:
        if quality_rules.content_share(t or "", model) >= 0.5 and not quality_rules.count_base(t)[-1]:
            kept.append((i, t))
    stays = {c for _, _, c in brute_components(kept)}
    kept = [(i, t) for i, t in kept if i in stays]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    hits = {d for d, _, hit, _ in brute_hits(kept, bench) if hit}
    assert hits == {62}
    kept = [(i, t.replace("a.b@c.example", "[EMAIL]")) for i, t in kept if i not in hits]
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in kept}
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, tables).collect()}
    assert got == want and 60 not in got and 61 not in got and 63 in got


def test_pipeline_on_odd_tables(spark, tables, tmp_path):
    """Clashing column names, nulls, repeated rows, and no rows at all."""
    import shutil

    for name, limit in (("odd", 100), ("empty", 0)):
        folder = f"{tmp_path}/{name}"
        shutil.copytree(f"{tables}/labels.parquet", f"{folder}/labels.parquet")
        shutil.copytree(f"{tables}/benchmark.parquet", f"{folder}/benchmark.parquet")
        docs = spark.read.parquet(f"{tables}/documents.parquet")
        for c in ("n_words", "kept", "text_key", "base", "row", "node", "id", "token", "l", "r", "_id", "_text", "entities"):
            docs = docs.withColumn(c, F.lit(1))
        docs.unionAll(docs).limit(limit).write.parquet(f"{folder}/documents.parquet")
        rows = corpus_pipeline.run(spark, folder).collect()
        assert len({r.doc_id for r in rows}) == len(rows) and bool(rows) == bool(limit)


def test_stages_return_the_columns_of_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tables).columns == docs.columns
