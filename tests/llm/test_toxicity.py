"""The classifier: gradients against finite differences, held-out accuracy, edge cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame
from tidemart.llm import toxicity as tox


def corpus(rng, n):
    plain = [a + b for a in ("ba", "ko", "ri", "ment", "tion", "sel") for b in ("la", "no", "the", "or", "an")]
    texts, labels = [], []
    for _ in range(n):
        w = [rng.choice(plain) for _ in range(rng.choice([5, 40, 150]))]
        y = rng.random() < 0.3
        for _ in range(max(1, len(w) // 30) if y else 0):
            w[rng.randrange(len(w))] = rng.choice(["vrakz", "Idiowt,", "grublo" + rng.choice(["x", "en", "is"])])
        texts.append(" ".join(w))
        labels.append(int(y))
    return texts, labels


def test_gradients_match_finite_differences():
    s = tox.Settings(window=4, pad=2, segment=100, hidden=3, dim=4, words=32, grams=32)
    t = tox._Text(["one two three four five six seven eight", "nine"], s, tox._powers())
    at, doc = t.windows(s)
    p = {k: v.astype(np.float64) for k, v in tox._init(s).items()}
    y = np.array([1.0, 0, 1.0, 0, 1.0, 1.0])[:len(at)]
    words, place, present, core = tox._batch(t, at, doc, s)

    def loss():
        x = tox._project(p, t)[:-1][words]
        x = np.concatenate([x, p["bin"][None, :]]).astype(np.float32)[place.T]
        z = tox._pool(p, tox._states(p, x, present.T), core)[0].astype(np.float64)
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    g = tox._gradients(p, t, words, place, present, core, y)
    rng = np.random.default_rng(1)
    for k in g:
        flat = p[k].reshape(-1)
        used = np.flatnonzero(np.abs(g[k].reshape(-1)) > 1e-4)
        for i in rng.choice(used, min(4, len(used)), replace=False):
            old, step = flat[i], 3e-3
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * step) - g[k].reshape(-1)[i]) < 3e-3 + 0.05 * abs(g[k].reshape(-1)[i]), k


def test_every_word_starts_a_window():
    s = tox.Settings(window=8)
    texts = ["", None, "a", " ".join(map(str, range(8))), " ".join(map(str, range(30))), "!!", "x y"]
    t = tox._Text(texts, s, tox._powers())
    at, doc = t.windows(s)
    own = {d: (at[doc == d] - t.first[d]).tolist() for d in range(len(texts))}
    assert own == {0: [], 1: [], 2: [0], 3: [0], 4: list(range(23)), 5: [], 6: [0]}


def plain_logits(p, x, s):
    """Window by window, for the projected words ``x`` of one text: states of one pass over the text, then pooling."""
    def gru(x, u):
        h, out, state = u.shape[0], [], np.zeros(u.shape[0])
        for row in x:
            zr = 1 / (1 + np.exp(-(row[:2 * h] + state @ u[:, :2 * h])))
            state = state + zr[:h] * (np.tanh(row[2 * h:] + (zr[h:] * state) @ u[:, 2 * h:]) - state)
            out.append(state)
        return np.array(out)

    h = p["uf"].shape[0]
    states = np.concatenate([gru(x[:, :3 * h], p["uf"]), gru(x[::-1, 3 * h:], p["ub"])[::-1]], axis=1)
    out = []
    for a in range(max(1, len(x) - s.window + 1)):
        own = states[a:a + s.window]
        e = np.exp(np.tanh(own @ p["wa"]) @ p["va"])
        out.append((e / e.sum()) @ own @ p["wo"] + p["bo"][0])
    return np.array(out)


def test_scores_equal_brute_force_window_by_window():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(n)) for n in (0, 1, 5, 7, 8, 40, 200)]
    s = tox.Settings(window=7, pad=300, segment=30, hidden=4, dim=4, words=64, grams=64)
    t = tox._Text(texts, s, tox._powers())
    p = tox._init(s)
    x, got, (_, doc) = tox._project(p, t), None, t.windows(s)
    got = tox._logits(p, x, t, s)
    for d in range(1, len(texts)):
        own = x[t.word[t.first[d]:t.first[d + 1]]]
        assert np.abs(got[doc == d] - plain_logits(p, own, s)).max() < 1e-4, d
    for window in (1, 2, 5, 7, 8, 32):
        v = np.arange(100.0)[:, None] ** 2
        assert np.allclose(tox._sums(v, window)[:, 0], np.convolve(v[:, 0], np.ones(window), "valid"))


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(4)
    texts, labels = corpus(rng, 900)
    s = tox.Settings(epochs=4, words=1 << 10, grams=1 << 10)
    model = tox.train(texts[:600], labels[:600], s)
    rows = [(i, t) for i, t in enumerate(texts[600:])]
    long_text = " ".join(texts[k] for k in range(600) if not labels[k])
    rows += [(1000, None), (1001, ""), (1002, " \n"), (None, texts[0]), (1003, long_text), (1004, long_text + " vrakz vrakz vrakz"),
             (5, texts[605])]
    out = tox.score_documents(docs_frame(spark, rows), model, s).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    by = {r.doc_id: r for r in out}
    assert by[1000].score == by[1001].score == by[1002].score == 0
    assert by[1004].score > by[1003].score and by[1004].predicted == 1
    right = sum(by[i].predicted == y for i, y in enumerate(labels[600:]))
    assert right >= 0.95 * 300
    assert tox.score_documents(docs_frame(spark, []), model, s).collect() == []
    # a toxic run is found wherever it starts: no verdict depends on words put in front
    p, powers = model, tox._powers()
    clean = " ".join(texts[k] for k in range(40) if not labels[k]).split()
    for offset in range(16):
        run = tox._Text([" ".join([*clean[:offset], "vrakz", "grublox", "vrakz", *clean[20:300]])], s, powers)
        best = tox._logits(p, tox._project(p, run), run, s).max() + p["offset"][0]
        assert best > np.log(0.7 / 0.3), offset


def test_training_never_sees_held_out_rows(spark):
    import zlib

    rows = [(i, f"text {i}") for i in range(200)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)] + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    texts, y = tox.training_sample(docs_frame(spark, rows), labels, tox.Settings(sample_rows=60))
    ids = [int(t.split()[1]) for t in texts]
    assert len(ids) == 60 and sum(y) == 30 and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)
    assert all(i % 2 == k for i, k in zip(ids, y, strict=True))


def test_training_learns_from_6000_rows_by_default(spark):
    rows = [(i, f"text {i}") for i in range(10_000)]
    labels = spark.range(10_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    texts, y = tox.training_sample(docs_frame(spark, rows), labels, tox.Settings())
    assert len(texts) == 6000 and sum(y) == 3000


def test_training_without_labels_or_words():
    s = tox.Settings(epochs=1)
    for texts, labels in (([], []), (["", None], [0, 1]), (["a b"], [1])):
        assert np.isfinite(tox.train(texts, labels, s)["offset"][0])
