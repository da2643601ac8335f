import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import abuse as A

# Made for these tests; an address, an accusation and its filling, so that whole combinations can be held out.
ADDRESS = ["you are", "what a", "every one of you is", "your whole family is", "people like you are", "listen, you"]
FOUL = ["a worthless moron", "a lying bastard", "a filthy cretin", "a stupid whore", "an utter imbecile", "a brainless dickhead"]
CALM = [
    "The replacement seal arrived on Tuesday and fits well.", "Does anybody know the torque for these bolts?", "I painted the fence twice before the rain came.",
    "My neighbour lent me a ladder for the gutter.", "Tighten it by hand first, then a quarter turn more.", "The invoice says three metres but I only got two.",
    "We drove to the lake and the axle stayed quiet.", "Could you share the wiring diagram again please?", "Everyone at the club was very kind to me.",
]


def disguised(rng, text):
    """One word with signs for letters, or pulled apart."""
    words = text.split()
    k = max(range(len(words)), key=lambda i: len(words[i]))
    words[k] = rng.choice([words[k].replace("o", "0").replace("i", "1").replace("a", "@"), ".".join(words[k]), words[k][0] + words[k][1] * 4 + words[k][2:]])
    return " ".join(words)


def sample(n, seed, pairs, share=0.3, noise=0.1):
    rng, docs, labels = random.Random(seed), [], []
    for k in range(n):
        bad = rng.random() < share
        parts = [rng.choice(CALM) for _ in range(rng.randrange(1, 6))]
        if bad:
            a, f = rng.choice(pairs)
            text = f"{a} {f}"
            parts.append((disguised(rng, text) if rng.random() < 0.25 else text) + rng.choice(".!"))
        rng.shuffle(parts)
        docs.append((k, "\n".join(parts), rng.choice(["s1", "s2"]), "x", bad))
        labels.append((k, int(bad) if rng.random() > noise else int(not bad), "r"))
    return docs, labels


PAIRS = [(a, f) for a in ADDRESS for f in FOUL]


@pytest.mark.parametrize("text", ["You are an idiot", "you p.r.i.c.k", "what a b a s t a r d you are", "you mоrоns", "You baaaastard", "you @sshole", "you b*stard", "dumme Schlampe, du"])
def test_evidence(text):
    assert A.features(text)[A._EVIDENCE] >= 0.9
    assert A.features("Nothing here. " * 5000 + "\n" + text)[A._EVIDENCE] >= 0.9
    assert A.features(f"> quoted\n[b]{text}[/b]")[A._EVIDENCE] >= 0.9
    assert A.features(f'<a href="{"x" * 500}">{text}</a>')[A._EVIDENCE] >= 0.9


@pytest.mark.parametrize("text", CALM + ["Поменял ремень, теперь работает тихо.", "週末に部品を交換したら静かになりました。", "1759363367 :-) ***"])
def test_no_evidence(text):
    assert A.features(text)[A._EVIDENCE] < 0.9


def test_null_and_empty():
    assert not A.features(None).any() and not A.features("").any() and len(A.features("x")) == len(A.FEATURES)
    assert A.dense(A.parse([]), None).shape == (0, len(A.FEATURES))


def test_nearness_is_exact_at_every_size():
    rng = np.random.default_rng(5)
    sentence = np.sort(rng.integers(0, 40, 3000))
    a, b = np.flatnonzero(rng.random(3000) < 0.2), np.flatnonzero(rng.random(3000) < 0.2)
    got = A._nearness(a, b, sentence, 40)
    want = [max((1 / (1 + abs(x - y)) for x in a for y in b if sentence[x] == sentence[y] == s), default=0.0) for s in range(40)]
    assert np.allclose(got, want)
    assert not A._nearness(a, b[:0], sentence, 40).any()


def test_rows_do_not_depend_on_their_batch():
    texts = ["You are an idiot.", None, "", CALM[0], "x", "a b c d e f", "Hello!\n\nYou m0ron!"]
    tables = tuple(np.random.default_rng(k).normal(size=A.BUCKETS).astype(np.float32) for k in (1, 2))
    together = A.dense(A.parse(texts), tables)
    alone = np.concatenate([A.dense(A.parse([t]), tables) for t in texts])
    assert np.allclose(together, alone)


def test_chunks_hold_every_text_once():
    texts = ["a" * 5, None, "b" * 20, "", "c" * 4, "d" * 4, "e" * 4]
    assert all(len(part) == 1 or sum(len(t or "") for t in part) <= 10 for part in A.chunks(texts, 10))
    assert sum(A.chunks(texts, 10), []) == texts and list(A.chunks([], 10)) == []


def test_isotonic_is_monotone_and_calibrated():
    rng = np.random.default_rng(1)
    s = rng.normal(size=3000)
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * s))).astype(float)
    knots, values = A.isotonic(s, y)
    assert (np.diff(values) >= -1e-12).all() and (np.diff(knots) >= 0).all()
    fit = np.interp(s, knots, values)
    for low in np.arange(0, 1, 0.2):
        inside = (fit >= low) & (fit < low + 0.2)
        assert abs(fit[inside].mean() - y[inside].mean()) < 0.05
    ties, means = A.isotonic(np.zeros(10), np.array([0, 1] * 5, dtype=float))
    assert set(means) == {0.5} and set(ties) == {0.0}


def test_boosting_starts_at_the_base_rate_and_learns():
    rng = np.random.default_rng(2)
    x = rng.random((1500, 20))
    y = ((x[:, 1] > 0.5) & (x[:, 2] > 0.3)).astype(float)
    boosted = A.boost(x[:1000], y[:1000])
    assert abs(1 / (1 + np.exp(-boosted.base)) - y[:1000].mean()) < 1e-9
    assert ((boosted.margin(x[1000:]) > 0) == y[1000:]).mean() > 0.9
    assert A.boost(np.zeros((10, 3)), np.zeros(10)).margin(np.zeros((2, 3))).max() < 0


def test_wordings_that_no_label_has_seen():
    """Held out by phrase: address and accusation are known apart, never together."""
    rng = random.Random(4)
    pairs = PAIRS[:]
    rng.shuffle(pairs)
    docs, labels = sample(1200, 6, pairs[:24])
    model = A.fit([d[1] for d in docs], np.array([float(y) for _, y, _ in labels]))
    assert model.boosted is not None and model.boosted.trees
    held, _ = sample(600, 7, pairs[24:], noise=0)
    p = model.probability(A.dense(A.parse([d[1] for d in held]), model.tables()))
    bad = np.array([d[4] for d in held])
    assert (p[bad] >= 0.5).mean() > 0.85 and (p[~bad] < 0.5).mean() > 0.95


def test_the_trees_decide():
    """What labels call harmless is not flagged, whatever the general lexicons say; and the other way round."""
    rng = random.Random(8)
    texts, y = [], []
    for _ in range(400):
        odd = rng.random()
        text = rng.choice(CALM)
        text += " The bastard file is in the top drawer." if odd < 0.3 else f" May your well run dry for {rng.randrange(9)} winters." if odd < 0.6 else ""
        texts.append(text)
        y.append(float(0.3 <= odd < 0.6))
    model = A.fit(texts, np.array(y))
    p = model.probability(A.dense(A.parse(["The bastard file is in the top drawer.", "May your well run dry for 3 winters.", CALM[3]]), model.tables()))
    assert p[0] < 0.5 < p[1] and p[2] < 0.5


def test_held_out_accuracy_and_rates(spark):
    docs, labels = sample(800, 1, PAIRS)
    labels = [r for r in labels if r[0] % 2]
    docs += [(9000, None, "s1", "x", False), (9001, "", None, "x", False), (3, docs[3][1], docs[3][2], "x", docs[3][4])]
    labels += [(9999, 1, "r"), (9000, 1, "r"), (5, 1, "q"), (5, 0, "q"), (None, 1, "q"), (7, None, "q")]
    d = spark.createDataFrame(docs, "doc long, text string, src string, probability string, bad boolean")
    marks = spark.createDataFrame(labels, "doc long, label int, who string")
    model = A.train(d, marks, "doc", "text", "label")
    scored = A.score(d, "doc", "text", "src", model)
    got = {r.doc: r.probability for r in scored.collect()}
    bad = {k: b for k, *_, b in docs}
    held = [k for k in got if k % 2 == 0 and k < 9000]
    assert np.mean([(got[k] >= 0.5) == bad[k] for k in held]) > 0.95
    assert got[9000] == got[9001] == 0
    table = {r.src: r for r in A.rates(scored, "src").collect()}
    assert table[None].documents == 1 and sum(r.documents for r in table.values()) == len(docs)
    assert all(abs(r.rate - r.flagged / r.documents) < 1e-12 for r in table.values())
    bounded = A.labelled(d, marks, "doc", "text", "label", limit=50, chars=2000)
    assert 0 < bounded.agg(F.sum(F.length("text"))).first()[0] <= 2000 and bounded.count() < 50


def test_no_labels_and_no_documents(spark):
    d = spark.createDataFrame([(1, "You are an idiot, a moron.", "s"), (2, CALM[0], "s")], "doc long, text string, src string")
    none = spark.createDataFrame([], "doc long, label int")
    model = A.train(d, none, "doc", "text", "label")
    assert {r.doc: r.probability >= 0.5 for r in A.score(d, "doc", "text", "src", model).collect()} == {1: True, 2: False}
    assert A.score(d.limit(0), "doc", "text", "src", model).count() == 0
