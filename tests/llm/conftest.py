import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, text_key string, kind string"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows; clashing extra columns."""
    prose = " ".join(f"word{i % 97} other{i % 89}" for i in range(300))
    return [
        (1, prose, "en", "a", 1, "x", "y"),
        (1, prose, "en", "a", 1, "x", "y"),
        (2, prose + " tail", "en", "b", 2, None, None),
        (3, None, None, None, None, None, None),
        (4, "", "fr", "c", 0, "x", "y"),
        (None, "nur ein kurzer Text", "de", None, 3, "x", "y"),
        (5, " \n\t ", "de", "a", 3, "x", "y"),
        (6, "é😀 " * 40_000, "es", "a", 3, "x", "y"),
        (5, "two words", None, "a", 3, "x", "y"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Small tables in a folder, for the thin queries and the pipeline."""
    d = tmp_path_factory.mktemp("tables")
    import random

    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(4000)]
    line = lambda n: " ".join(rng.choices(words, k=n)).capitalize() + "."
    docs, labels = [], []
    for i in range(60):
        bad = i % 5 == 0
        text = "\n".join(" ".join(w.upper() + "!!" for w in line(14).split()) if bad else line(14) for _ in range(8))
        docs.append((i, text, "en", f"s{i % 4}", len(text)))
        labels.append((i, 0 if bad else 1, 0))
    item = line(30)
    docs += [(60, docs[1][1] + " one two", "en", "s1", 1), (61, docs[2][1], "en", "s2", 1), (62, line(30) + "\n" + item + "\n" + line(40), "en", "s1", 1), (63, line(40) + " mail a.b@c.example now\n" + line(40), "en", "s1", 1), (64, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)
