import json

from palimpsest.streaming import captures


def test_download_resumes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    row = lambda u: json.dumps({"timestamp": "20040101000000", "original_url": u, "statuscode": 200, "mimetype": "text/html", "digest": "X", "length": 1})
    (tmp_path / "in/a.json").write_text(row("http://a/"))
    run = lambda: captures.download(spark, str(tmp_path / "in"), str(tmp_path / "out"), lambda url: (200, {}, url.encode()), str(tmp_path / "ck"), parallel=1).awaitTermination()
    run()
    (tmp_path / "in/b.json").write_text("\n".join([row("http://a/"), row("http://b/")]))
    run()
    assert sorted(r.original_url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["http://a/", "http://b/"]


def test_merged_table_of_batches(spark, tmp_path):
    schema = "identity int, timestamp string, capture_id int, value string"
    captures.merge_batch(spark.createDataFrame([(1, "2004", 1, "a"), (2, "2004", 2, "b")], schema), 0, str(tmp_path / "t"))
    captures.merge_batch(spark.createDataFrame([(1, "2005", 3, "c"), (2, "2004", 4, "d")], schema), 1, str(tmp_path / "t"))
    from palimpsest.sources import sinks

    assert sorted((r.identity, r.value) for r in sinks.current(spark, str(tmp_path / "t")).collect()) == [(1, "c"), (2, "b")]
