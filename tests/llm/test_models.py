"""Learned operators: held-out accuracy, gradients, defined results of odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import language_id, quality_classifier, quality_rules


def test_quality_classifier_on_held_out_texts():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(500)]
    good = [" ".join(rng.choice(words, 60)) for _ in range(300)]
    bad = [" ".join(w + s for w, s in zip(rng.choice(words, 60), rng.choice(["%%%", "###", "***"], 60), strict=True)) for _ in range(100)]
    texts, labels = good[:200] + bad[:60], np.array([1] * 200 + [0] * 60)
    model = quality_classifier.train(texts, labels)
    s = model.scores(np.array([model.pooled(t) for t in good[200:] + bad[60:]]))
    assert ((s >= 0.7) == np.array([1] * 100 + [0] * 40)).mean() > 0.97


def test_quality_scores_of_odd_rows(spark, odd, none, odd_rows):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 1), (4, None), (None, 1)], "doc_id bigint, quality int")
    for chosen in (labels, labels.limit(0), labels.where("quality = 1")):
        model = quality_classifier.fit(odd, chosen, F.lit(True))
        rows = quality_classifier.score(odd, model).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
        assert quality_classifier.score(none, model).count() == 0


def test_gradients_through_time():
    rng = np.random.default_rng(1)
    model = language_id.train([b"aa bb", b"cc dd"] * 3, ["x", "y"] * 3, rounds=1, batch=4, span=6)
    for name in ("embed", "project", "recur", "emit", "bias"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    windows, sizes, gold = rng.integers(97, 101, (3, 7)).astype(np.uint8), np.array([7, 4, 1]), np.array([0, 1, 0])

    def loss():
        # the same network, position by position
        total = 0.0
        for b in range(3):
            states = []
            for d, order in ((0, range(sizes[b])), (1, range(sizes[b] - 1, -1, -1))):
                h, own = np.zeros((1, 1, language_id.HIDDEN)), {}
                for t in order:
                    zr, _, n = language_id.gates(model.table[d][windows[b, t]][None, None], model.recur[d][None], h)
                    h = n + zr[..., : language_id.HIDDEN] * (h - n)
                    own[t] = h[0, 0]
                states.append(own)
            for t in range(sizes[b]):
                z = states[0][t] @ model.emit[0] + states[1][t] @ model.emit[1] + model.bias
                total += np.log(np.exp(z).sum()) - z[gold[b]]
        return total / sizes.sum()

    grads = language_id.gradients(model, windows, sizes, gold)
    for g, name in zip(grads, ("embed", "project", "recur", "emit", "bias"), strict=True):
        p = getattr(model, name)
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        p[at] += 1e-4
        up = loss()
        p[at] -= 2e-4
        down = loss()
        p[at] += 1e-4
        assert (up - down) / 2e-4 == pytest.approx(g[at], rel=0.03), name


def test_language_on_held_out_texts_and_chunking():
    rng = np.random.default_rng(2)
    make = lambda syllables: " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(60)).encode()
    kinds = {"en": ["the", "ing", "and", "tion"], "fr": ["é", "eaux", "ç", "le"], "de": ["ß", "sch", "ü", "ung"]}
    texts, labels = zip(*[(make(s), g) for g, s in kinds.items() for _ in range(40)], strict=True)
    model = language_id.train(list(texts), list(labels), rounds=120, batch=60)
    held = [(make(s), g) for g, s in kinds.items() for _ in range(20)]
    p = language_id.classify(model, [t for t, _ in held])
    assert np.mean([model.languages[i] == g for i, (_, g) in zip(p.argmax(1), held, strict=True)]) > 0.95
    assert np.allclose(p.sum(1), 1, atol=1e-3)
    alone = np.concatenate([language_id.classify(model, [t]) for t, _ in held[:5]])
    assert np.allclose(alone, p[:5], atol=1e-4)


def test_language_of_odd_rows(odd, none, odd_rows):
    model = language_id.fit(odd, F.lit(True))
    rows = language_id.identify(odd, model).collect()
    assert len(rows) == len(odd_rows) and {r.lang_pred for r in rows if r.doc_id in (3, 4)} == {"und"}
    assert {r.lang_pred for r in rows} <= {"en", "fr", "de", "es", "und"} and all(0 <= r.score <= 1 for r in rows)
    assert language_id.identify(none, model).count() == 0
    empty = language_id.fit(none, F.lit(True))
    assert {r.lang_pred for r in language_id.identify(odd, empty).collect()} == {"und"}


def brute_base(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = {}
    for i in range(len(words) - 4):
        wins.setdefault(tuple(words[i : i + 5]), []).append(i)
    hit = {j for at in wins.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), n < 10 or 100 * len(hit) > 20 * n


def test_base_counts():
    rng = np.random.default_rng(3)
    texts = ["", " \n", "a b c d e a b c d e", "x\n\nx\nx y\n", "a " * 50] + ["".join(rng.choice(["a", "b ", "c\n", "é ", "# ", "\x1c", " "], 60)) for _ in range(80)]
    texts.append(" ".join(f"u{i % 5000}" for i in range(9000)))
    assert [quality_rules.count_base(t) for t in texts] == [brute_base(t) for t in texts]


def test_viterbi_is_the_best_path():
    import itertools

    rng = np.random.default_rng(4)
    for _ in range(20):
        emit, move = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
        score = lambda y: sum(emit[i, y[i]] for i in range(6)) + sum(move[y[i], y[i + 1]] for i in range(5))
        best = max(itertools.product((0, 1), repeat=6), key=score)
        assert tuple(quality_rules.viterbi(emit, move)) == best


def test_rules_on_odd_rows(spark, odd, none, odd_rows, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    model = quality_rules.fit(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs, model).collect()}
    assert not any(kept[i] for i in range(0, 60, 5)) and all(kept[i] for i in range(60) if i % 5)
    rows = quality_rules.judge(odd, model).collect()
    assert len(rows) == len(odd_rows) and not any(r.kept for r in rows if r.n_words < 10)
    assert quality_rules.judge(none, model).count() == 0
    untrained = quality_rules.fit(none, None)
    assert quality_rules.judge(odd, untrained).count() == len(odd_rows)


def test_lines_follow_their_documents_labels():
    """Junk that no seed names is learned from bad documents; multipliers keep each document within its label."""
    rng = np.random.default_rng(8)
    words = ["river", "house", "the", "of", "walks", "slowly", "and", "green"]
    prose = lambda: " ".join(rng.choice(words, 9)).capitalize() + "."
    junk = lambda: " ".join(f"{w}/{w}" for w in rng.choice(words, 9))
    texts = ["\n".join([prose(), junk(), junk(), junk()]) if i % 2 else "\n".join([prose(), prose(), junk(), prose()]) for i in range(60)]
    model = quality_rules.train_crf(texts, [i % 2 == 0 for i in range(60)])
    decode = lambda t: quality_rules.viterbi(quality_rules.line_table(t)[0] @ model[0], model[1]).tolist()
    assert decode("\n".join([prose(), prose(), prose(), junk(), junk(), junk()])) == [0, 0, 0, 1, 1, 1]
    assert quality_rules.content_share("\n".join([prose()] * 4), model) == 1 and quality_rules.content_share(junk() + "\n" + junk(), model) == 0
    for good in (True, False):
        for t in texts[:8]:
            x, sizes = quality_rules.line_table(t)
            assert quality_rules.allowed(quality_rules.bound_labels(x @ model[0], model[1], sizes, good), sizes, good)


def test_field_gradient():
    """``ascend`` moves along the gradient of the log-likelihood that plain enumeration gives."""
    import itertools

    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 2, (4, quality_rules.FEATURES)).astype(float), np.array([0, 1, 1, 0])

    def likelihood(weight, move):
        emit = x @ weight
        score = lambda s: sum(emit[i, s[i]] for i in range(4)) + sum(move[s[i], s[i + 1]] for i in range(3))
        return score(y) - np.log(sum(np.exp(score(s)) for s in itertools.product((0, 1), repeat=4)))

    start, move = rng.normal(size=(quality_rules.FEATURES, 2)), rng.normal(size=(2, 2))
    w, m = start.copy(), move.copy()
    quality_rules.ascend([x], [y], w, m, 1, 1.0, 0.0)
    for at in [(3, 0), (7, 1), (0, 0)]:
        step = np.zeros_like(start)
        step[at] = 1e-5
        assert abs((likelihood(start + step, move) - likelihood(start - step, move)) / 2e-5 - (w - start)[at]) < 1e-6
    step = np.zeros((2, 2))
    step[0, 1] = 1e-5
    assert abs((likelihood(start, move + step) - likelihood(start, move - step)) / 2e-5 - (m - move)[0, 1]) < 1e-6


def test_kept_documents_keep_their_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    model = quality_rules.fit(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    for c in ("n_words", "kept", "_id", "_text", "content_share"):
        docs = docs.withColumn(c, F.lit("x"))
    got = quality_rules.keep_good(docs, model)
    assert got.schema == docs.schema
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in quality_rules.judge(docs, model).where("kept").collect())


def test_positions_against_a_plain_network():
    """The batched pass equals one position at a time, with both directions' states written out."""
    rng = np.random.default_rng(6)
    h, e = language_id.HIDDEN, language_id.EMBED
    model = language_id.Model(["a", "b", "c"], rng.normal(size=(2, 256, e)).astype(np.float32), rng.normal(size=(2, e + 1, 3 * h)).astype(np.float32), rng.normal(size=(2, h, 3 * h)).astype(np.float32), rng.normal(size=(2, h, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32))
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def states(data, d):
        out, state = [], np.zeros(h)
        for byte in data:
            x, s = model.embed[d, byte] @ model.project[d, :e] + model.project[d, e], state @ model.recur[d]
            z, r = sigmoid(x[:h] + s[:h]), sigmoid(x[h : 2 * h] + s[h : 2 * h])
            new = np.tanh(x[2 * h :] + r * s[2 * h :])
            state = new + z * (state - new)
            out.append(state)
        return out

    def plain(data):
        left, right = states(data, 0), states(data[::-1], 1)[::-1]
        total = np.zeros(3)
        for a, b in zip(left, right, strict=True):
            z = np.exp(a @ model.emit[0] + b @ model.emit[1] + model.bias)
            total += z / z.sum()
        return total

    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (1, 5, 128, 129, 300)]
    want = []
    for t in texts:
        parts = [t[i : i + language_id.SPAN] for i in range(0, len(t), language_id.SPAN)]
        want.append(sum(map(plain, parts)) / len(t))
    assert np.allclose(language_id.classify(model, texts), want, atol=1e-4)


def test_samples_are_bounded_and_deal_with_repeats(spark):
    """One id and text repeated very often is one row of the fit; long texts give windows from anywhere."""
    rows = [(1, "the river runs " * 2000, "en")] * 500 + [(i, f"der fluss nummer {chr(97 + i % 26)} ist lang", "de") for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    model = language_id.fit(docs, F.lit(True), per_language=20, train_chars=300)
    assert model.languages == ["de", "en"]
    assert [r.lang_pred for r in language_id.identify(docs.where("doc_id < 3").dropDuplicates(), model).orderBy("doc_id").collect()] == ["en", "de"]
    from palimpsest.llm.common import window_of

    text = "".join(chr(0x4E00 + i) for i in range(5000))
    cut = [r.w for r in spark.range(1).select(*[window_of(F.lit(text), 100, s).alias("w") for s in (1,)]).collect()]
    assert all(len(w) == 100 and w in text for w in cut) and not text.startswith(cut[0])
