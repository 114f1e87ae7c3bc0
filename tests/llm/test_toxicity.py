from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from rankweave.llm import gru
from rankweave.llm.toxicity import score_toxicity


def corpus(n, seed):
    """Rude words make a text toxic, and so do words with a rude stem that no other text has."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(5, 200))]
        label = int(rng.random() < 0.25)
        if label:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["zork", "blimp", "qqstem" + rng.choice("abcdefgh") + rng.choice("abcdefgh")])
        out.append((" ".join(words), label))
    return out


@pytest.fixture(scope="module")
def model():
    known = corpus(400, 1)
    return gru.train([t for t, _ in known], [y for _, y in known])


def test_held_out_accuracy(model):
    unseen = corpus(300, 2)
    scores = gru.Scorer(model).scores([t for t, _ in unseen])
    assert np.mean((scores >= 0.5) == np.array([y for _, y in unseen])) > 0.93


def test_gradients_equal_differences():
    rng = np.random.RandomState(0)
    p = {k: v.astype(np.float64) for k, v in gru.new_parameters(np.zeros(3, np.float32), np.zeros(3, np.float32)).items()}
    x, mask, weight = rng.standard_normal((6, 4, gru.SIZE)), np.ones((6, 4)), rng.standard_normal(4)
    mask[3:, 1] = 0
    _, state = gru.forward(p, x, mask)
    gradients, d_x = gru.backward(p, weight, state)
    for name in ("wf", "uf", "bf", "wb", "ub", "bb", "a", "a0", "v", "u", "c"):
        at = tuple(rng.randint(n) for n in p[name].shape)
        ends = []
        for step in (1e-3, -1e-3):
            q = p | {name: p[name].copy()}
            q[name][at] += step
            ends.append(float((gru.forward(q, x, mask)[0] * weight).sum()))
        assert gradients[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-3, rel=1e-2, abs=1e-5), name


def test_scorer_equals_the_network_on_all_windows(model, monkeypatch):
    monkeypatch.setattr(gru.Scorer, "BATCH", 3)
    monkeypatch.setattr(gru.Scorer, "CACHE", 400)
    words, grams, p = model
    texts = [t for t, _ in corpus(20, 3)] + ["", " \n", "one", " ".join(["zork"] * 33), " ".join(t for t, _ in corpus(30, 4))]
    found = gru.Scorer(model).logits(texts)
    for text, logit in zip(texts, found):
        inputs = gru.Inputs(words, grams)
        ids = gru.window_ids(np.array(inputs.ids(gru.words_of(text)), dtype=np.int64)).T
        plain, _ = gru.forward(p, inputs.vectors(p)[ids], (ids > 0).astype(np.float32))
        assert logit == pytest.approx(plain.max(), abs=1e-3)


def test_windows_overlap_and_reach_the_end():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        ids = gru.window_ids(np.arange(1, n + 1))
        assert set(ids.ravel()) - {0} == set(range(1, n + 1))
        assert all(a[gru.STRIDE] == b[0] for a, b in zip(ids, ids[1:]))


def test_query_rows(spark, documents, model):
    rows = [(i, t) for i, (t, _) in enumerate(corpus(30, 5))] + [(3, "zork zork"), (None, "zork"), (40, None), (41, "")]
    found = score_toxicity(documents(rows, extra=True), None, model=model).collect()
    assert len(found) == len(rows)
    for row in found:
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.5)
        assert row["held_out"] == (row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
    assert next(r for r in found if r["doc_id"] is None)["predicted"] == 1


def test_fit_leaves_fold_0_out(spark, documents):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    rows = [(i, "zork" if i % 2 else "calm") for i in range(40)]
    found = score_toxicity(documents(rows), labels).collect()
    assert len(found) == 40
    empty = spark.createDataFrame([], labels.schema)
    assert len(score_toxicity(documents(rows), empty).collect()) == 40
    assert score_toxicity(documents([]), labels).collect() == []


def test_long_labelled_texts_are_fitted_on(spark, documents):
    """Where all labelled texts are long, their windows are fitted on all the same."""
    from rankweave.llm.toxicity import MAX_TRAINING_CHARS, fit_toxicity

    rng = random.Random(11)
    known = [(" ".join(t for t, _ in corpus(rng.randint(24, 28), 100 + i) if "zork" not in t and "blimp" not in t and "qqstem" not in t), i % 3 == 0) for i in range(120)]
    known = [(t + " zork blimp " * 4 + t[:900] if toxic else t + " " + t[:900], int(toxic)) for t, toxic in known]
    assert min(len(t) for t, _ in known) > MAX_TRAINING_CHARS
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(known)], "doc_id bigint, quality int, toxic int")
    model = fit_toxicity(documents([(i, t) for i, (t, _) in enumerate(known)]), labels)
    scores = gru.Scorer(model).scores([t for t, _ in known])
    assert np.mean((scores >= 0.5) == np.array([y for _, y in known])) > 0.9


def test_any_stretch_of_half_a_window_lies_within_one():
    ids = np.arange(1, 200)
    windows = [set(row.tolist()) for row in gru.window_ids(ids)]
    half = gru.LENGTH // 2
    assert all(any(set(range(k, k + half)) <= w for w in windows) for k in range(1, 200 - half + 1))
