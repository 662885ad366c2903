import random

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import gates, relations
from palimpsest.operators.asof import nearest_asof
from palimpsest.operators.closure import fixpoint
from palimpsest.operators.merge import conflict_checked, dominant, latest_wins
from palimpsest.sources import harvest, manifest, sinks


def test_latest_wins_does_not_depend_on_order(spark):
    rng = random.Random(3)
    rows = [(k, f"2004010{rng.randint(1, 4)}", i, rng.choice([None, "a", "b"]), i) for i, k in enumerate(rng.choices(range(12), k=150))]
    want = {}
    for k, ts, o, title, v in rows:  # one row at a time, in order
        if k not in want:
            want[k] = [ts, v, title, o]
        else:
            w = want[k]
            if ts > w[0]:
                w[0], w[1], w[2] = ts, v, title if title is not None else w[2]
    rng.shuffle(rows)
    got = latest_wins(spark.createDataFrame(rows, "k int, ts string, o int, title string, v int").repartition(5), ["k"], "ts", ["o"], ["v"], ["title"], {"first": "o"})
    ordered = {}
    for r in got.collect():
        ordered[r.k] = [r.ts, r.v, r.first]
    assert {k: [w[0], w[1], w[3]] for k, w in want.items()} == ordered


def test_nearest_asof_matches_brute_force(spark):
    rng = random.Random(5)
    stamp = lambda: f"200401{rng.randint(1, 9):02d}{rng.randint(0, 3):02d}0000"
    probes = [(i, rng.randint(0, 3), stamp()) for i in range(60)]
    cands = [(rng.randint(0, 2), stamp(), i % 7) for i in range(50)]
    secs = lambda s: int(s[6:8]) * 86400 + int(s[8:10]) * 3600
    want = {}
    for i, k, t in probes:
        own = [(ts, c) for kk, ts, c in cands if kk == k]
        p, n = max([x for x in own if x[0] < t], default=None), min([x for x in own if x[0] >= t], default=None)
        want[i] = None if not own else (n if p is None else p if n is None or secs(t) - secs(p[0]) <= secs(n[0]) - secs(t) else n)
    got = nearest_asof(spark.createDataFrame(probes, "i int, k int, ts string"), spark.createDataFrame(cands, "k int, ts string, c int"), ["k"], "ts", ["c"], ["c"])
    assert {r.i: None if r.nearest_ts is None else (r.nearest_ts, r.nearest_c) for r in got.collect()} == want


def test_nearest_asof_of_a_hot_key_and_unknown_times(spark):
    """A key with nearly all rows lies in several ranges; probes without time take the last candidate."""
    rng = random.Random(15)
    stamp = lambda: f"200{rng.randint(1, 7)}{rng.randint(1, 12):02d}{rng.randint(1, 28):02d}000000"
    cands = [("hot", stamp(), i) for i in range(300)] + [("cold", "20040101000000", 1000), ("hot", None, 2000)]
    probes = [(i, "hot", stamp()) for i in range(200)] + [(900, "hot", None), (901, "cold", "20010101000000"), (902, "none", "20010101000000")]
    secs = lambda s: __import__("datetime").datetime.strptime(s, "%Y%m%d%H%M%S").timestamp()
    want = {}
    for i, k, t in probes:
        own = sorted((ts, c) for kk, ts, c in cands if kk == k and ts)
        before, after = [x for x in own if t is None or x[0] < t], [x for x in own if t is not None and x[0] >= t]
        sides = [x[-1 if x is before else 0] for x in (before, after) if x]
        want[i] = min(sides, key=lambda x: (abs(secs(x[0]) - secs(t)) if t else 0, x[0]))[1] if sides else None
    got = nearest_asof(spark.createDataFrame(probes, "i int, k string, ts string").repartition(4), spark.createDataFrame(cands, "k string, ts string, c int").repartition(4), ["k"], "ts", ["c"], ["c"])
    assert {r.i: r.nearest_c for r in got.collect()} == want


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 5)], "node int, dst int")
    got = fixpoint(spark.createDataFrame([(1,)], "node int"), lambda f: f.join(edges, "node").select(F.col("dst").alias("node")), ["node"])
    assert sorted((r.node, r.depth) for r in got.collect()) == [(1, 0), (2, 1), (3, 2)]


def test_dominant_ties_to_least(spark):
    got = dominant(spark.createDataFrame([(1, 5), (1, 4), (2, None)], "k int, v int"), ["k"], "v").collect()
    assert [(r.k, r.v) for r in got] == [(1, 4)]


def test_strict_conflicts_raise(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, o int, v string")
    assert conflict_checked(df, ["k"], ["o"]).first().v == "a"
    with pytest.raises(Exception, match="conflicting"):
        conflict_checked(df, ["k"], ["o"], strict=True).collect()


def test_refresh_touches_changed_keys_only(spark):
    rows = spark.createDataFrame([("a", "2004"), ("a", "2006"), ("b", "2005")], "k string, posted_at string")
    old = spark.createDataFrame([("a", "1", "2"), ("b", "3", "4"), ("c", "5", "6")], "k string, first_posted_at string, last_posted_at string")
    changed = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    got = relations.refreshed_activity(old, changed, rows, ["k"]).collect()
    assert sorted(map(tuple, got)) == [("a", "2004", "2006"), ("b", "3", "4"), ("c", None, None)]


def test_provenance_bounds_the_rows_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(relations, "TASK_ROWS", 100, raising=False)
    pairs = [(i % 800, i % 1600) for i in range(4000)] + [(None, 1)]
    posts = spark.createDataFrame([(k,) for k in range(0, 900, 2)] * 2 + [(None,)], "post long")
    found = relations.provenance(posts, spark.createDataFrame(pairs, "post long, capture long"), "post")
    tasks = found.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.post, r.capture) for r in tasks) == sorted({(a, b) for a, b in pairs if a is not None and a % 2 == 0})
    assert max(sum(r.task == t for r in tasks) for t in {r.task for r in tasks}) <= 100


def test_gates(spark):
    with pytest.raises(gates.IntegrityError):
        gates.require_none(spark.range(1), "rows")


def test_cdx(spark, tmp_path):
    d = "A" * 32
    (tmp_path / "a.json").write_text(f'[["timestamp","original","statuscode","mimetype","digest","length"],["20040101000000","http://a/","200","text/html","{d}","5"],["20040102000000","http://a/","200","text/html","{d}","5"]]')
    (tmp_path / "b.json").write_text(f'[["original","timestamp","statuscode","mimetype","digest","length"],["http://a/","20040101000000","200","text/html","{d}","5"],["http://b/","20040101000000","x","text/html","{d}","5"]]')
    assert manifest.read_cdx(spark, str(tmp_path / "*.json")).count() == 3
    (tmp_path / "c.json").write_text("no json")
    assert manifest.read_cdx(spark, str(tmp_path / "*.json"), strict=False).count() == 3
    with pytest.raises(gates.IntegrityError):
        manifest.read_cdx(spark, str(tmp_path / "*.json"))


def test_fetch_and_resume(spark):
    inventory = spark.createDataFrame([("20040101000000", "http://a/", "X"), ("20040101000000", "http://b/", "X"), ("20040101000000", "http://c/", "X")], "timestamp string, original_url string, digest string")
    done = inventory.where("original_url = 'http://c/'")

    def fetcher(url):
        return (404, {}, b"") if url.endswith("b/") else (200, {}, b"body")

    got = harvest.fetch(harvest.pending(inventory, done), fetcher, parallel=2)
    by = {r.original_url: r for r in got.collect()}
    assert set(by) == {"http://a/", "http://b/"} and by["http://b/"].error == "status 404" and by["http://a/"].retrieved_length == 4
    assert harvest.retry_delay({"Retry-After": "900"}, 0) == 300 and harvest.retry_delay({}, 9) == 120


def test_publish_replaces_the_pointer(spark, tmp_path):
    for n in (3, 5):
        sinks.publish(spark.range(n), f"file://{tmp_path}")
        assert (tmp_path / "CURRENT").is_file() and sinks.current(spark, f"file://{tmp_path}").count() == n


def test_results_are_made_once(spark, tmp_path):
    (tmp_path / "made").mkdir()

    def run(batches):
        import uuid

        for pdf in batches:
            (tmp_path / "made" / uuid.uuid4().hex).touch()
            yield pdf

    rows = spark.range(4).coalesce(1).mapInPandas(run, "id long")
    results = rows.select(F.when(F.col("id") > 0, F.struct("id")).alias("row"), F.when(F.col("id") == 0, F.struct("id")).alias("failure"))
    sinks.route_results(results, f"{tmp_path}/rows", f"{tmp_path}/failures")
    assert len(list((tmp_path / "made").iterdir())) == 1 and spark.read.json(f"{tmp_path}/rows").count() == 3 and spark.read.json(f"{tmp_path}/failures").count() == 1


def test_sinks(spark, tmp_path):
    base = str(tmp_path / "site")
    sinks.publish(spark.range(3), base)
    sinks.publish(spark.range(5), base)
    assert sinks.current(spark, base).count() == 5
    n = sinks.write_files(spark.createDataFrame([("a/b.html", "x"), ("a/b.html", "y"), ("c.html", "z")], "path string, content string"), f"file://{tmp_path}/out")
    assert n == 2 and (tmp_path / "out/a/b.html").read_text() == "x"
