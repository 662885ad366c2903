"""Near-duplicates and decontamination against brute force."""

import random
import re

import numpy as np

from palimpsest.llm import decontamination, ngram_join


def shingle_sets(rows):
    out = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        out.append((i, frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset()))
    return out


def brute_components(rows):
    sets = shingle_sets(rows)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), d if not s else least.get(find(i))) for i, (d, s) in enumerate(sets)), key=repr)


def planted():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    passage = rng.choices(words, k=60)
    rows = []
    for g in range(12):
        base = rng.choices(words, k=rng.randint(20, 160))
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    rows += [" ".join(rng.choices(words, k=60) + passage) for _ in range(12)]
    chain = rng.choices(words, k=100)  # a chain: neighbours link, ends don't
    for step in range(8):
        rows.append(" ".join(chain[step * 4 :] + words[: step * 4]))
    rows += ["A B c d", "a b C D", "a b c d e", "", None, " \n", "É x y z q", "é x y z q", rows[0], rows[0]]
    return list(enumerate(rows)) + [(0, rows[0]), (3, "other text of an old id"), (None, "nameless text with five words"), (None, None)]


def test_components_equal_brute_force(spark):
    rows = planted()
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows)


def test_order_levels_and_rounds_lose_no_link(spark, monkeypatch):
    """All elements known by frequency, by broadcast and by shuffle; tiny blocks; only rounds, and only lists of pairs."""
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    for least, frequent, block, crowd in ((2, 10**6, 300, 2), (2, 0, 10**6, 10**9), (10**6, 10**6, 10**6, 5)):
        for name, value in (("LEAST_DF", least), ("FREQUENT", frequent), ("BLOCK_TOKENS", block), ("CROWD", crowd)):
            monkeypatch.setattr(ngram_join, name, value)
        got = ngram_join.near_duplicates(docs).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows)


def test_words_hash_alike_wherever_they_stand(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices(["a", "B", "é ", "\n", " ", "\x1c", "\xa0", "xyz"], k=rng.randint(0, 60))) for _ in range(500)] + ["w " * 3000, "x" * 900 + " y", " " * 900, "\t"]
    hashes = {}
    for piece in (ngram_join.PIECE, 64):
        monkeypatch.setattr(ngram_join, "PIECE", piece)
        for t in texts:
            words, got = t.encode().lower().split(), ngram_join.word_hashes(t).tolist()
            assert len(words) == len(got)
            for w, h in zip(words, got, strict=True):
                assert hashes.setdefault(w, h) == h
    assert len(set(hashes.values())) == len(hashes)


def test_a_large_group_at_the_threshold(spark):
    """Near copies of one text of which many pairs miss the threshold by little, among unrelated texts of a common passage."""
    rng = random.Random(12)
    base, passage = [f"b{i}" for i in range(64)], [f"p{i}" for i in range(40)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(900)}"
        rows.append((i, " ".join(words[: rng.randint(54, 64)])))
    rows += [(1000 + i, " ".join([f"u{i}_{j}" for j in range(rng.randint(8, 30))] + passage)) for i in range(60)]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows)


def test_one_of_each_group_stays(spark):
    rows = [(i, t) for i, t in planted() if i is not None and t != "other text of an old id"]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    groups = {c for _, n, c in brute_components(rows) if n}
    empty = sum(1 for _, n, _ in brute_components(rows) if not n)
    assert len(kept) == len(groups) + empty


def test_levels_grow_with_the_cost():
    level = lambda n, *df: ngram_join.choose_level(np.array([1] * (n - len(df)) + list(df)))
    assert level(1) == 1
    assert level(100) < level(1000) <= ngram_join.LEVELS
    assert level(20, *[30] * 19) > level(20)


def test_join_on_odd_rows(odd, none, odd_rows):
    got = ngram_join.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows) and {r.component_id for r in got if r.n_shingles == 0} == {3, 4, 5}
    assert ngram_join.near_duplicates(none).count() == 0
    # the repeated row and its near copy go; of the others, also the empty ones, all stay
    assert len(ngram_join.keep_one(odd).collect()) == len(odd_rows) - 2
    assert ngram_join.keep_one(none).count() == 0


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_hits(rows, items):
    fold = lambda t: WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
    windows = {}
    for item, text in items:
        w = fold(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1) if w and item is not None else ():
            windows.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    out = []
    for d, text in rows:
        w, hit, found = fold(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if own := windows.get(tuple(w[i : i + k])):
                    hit |= set(range(i, i + k))
                    found |= own
        out.append((d, len(w), tuple(sorted(hit)), tuple(sorted(found))))
    return sorted(out, key=repr)


def contaminated_rows():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)] + ["É", "naïve", "x1"]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, text(n)) for i, n in enumerate([30, 12, 10, 9, 3, 1, 0, 55])] + [(100, "w1, W2; w3."), (None, "lost item"), (3, None), (7, "w5 " * 15)]
    cut = lambda t, a, b: " ".join(t.split()[a:b])
    rows = [(i, text(20) + "... " + cut(items[i % 8][1], rng.randint(0, 5), 60).upper() + " - " + text(15)) for i in range(40)]
    rows += [(50, "w5 " * 30), (51, items[0][1]), (51, items[0][1]), (52, None), (53, ""), (None, items[7][1]), (54, "W1 w2 w3"), (55, "é É naïve")]
    return rows, items


def test_hits_equal_brute_force(spark, monkeypatch):
    rows, items = contaminated_rows()
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), spark.createDataFrame(items, "item_id bigint, text string")
    for bits, limit in ((decontamination.TABLE_BITS, decontamination.BROADCAST_BYTES), (1, -1)):  # a full bit table passes all; without broadcast
        monkeypatch.setattr(decontamination, "TABLE_BITS", bits)
        monkeypatch.setattr(decontamination, "BROADCAST_BYTES", limit)
        got = decontamination.decontaminate(docs, bench).collect()
        assert sorted(((r.doc_id, r.n_words, tuple(sorted(r.hit)), tuple(r.items)) for r in got), key=repr) == brute_hits(rows, items)


def test_decontamination_of_odd_rows(spark, odd, none, odd_rows):
    bench = spark.createDataFrame([(1, "nothing like this occurs there at all in these rows ever")], "item_id bigint, text string")
    assert all(r.hit == [] for r in decontamination.decontaminate(odd, bench).collect())
    assert decontamination.without_contaminated(odd, bench).count() == len(odd_rows)
    assert decontamination.decontaminate(none, bench).count() == 0
    assert decontamination.decontaminate(odd, bench.limit(0)).count() == len(odd_rows)


def test_items_without_an_id_count_as_hits(spark):
    item = " ".join(f"w{i}" for i in range(14))
    docs = spark.createDataFrame([(1, f"so {item} it is"), (2, "something else")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(None, item)], "item_id bigint, text string")
    got = {r.doc_id: (len(r.hit), r.items) for r in decontamination.decontaminate(docs, bench).collect()}
    assert got == {1: (14, []), 2: (0, [])}
    assert [r.doc_id for r in decontamination.without_contaminated(docs, bench).collect()] == [2]
