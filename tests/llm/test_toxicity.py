import math
import zlib

import numpy as np
import pytest

from daybook.llm.toxicity import Model, PuRisk, drop_toxic, fit_nnpu, pieces, score_toxicity, toxicity, train


def test_nnpu_beats_plain_learning_from_unlabelled():
    """With hidden positives among the unlabelled, the corrected risk still finds them."""
    rng = np.random.default_rng(1)
    n, prior = 4000, 0.3
    y = rng.random(n) < prior
    x = (rng.random((n, 12)) < np.where(y[:, None], 0.6, 0.15)).astype(np.float32)
    positive = (rng.random((600, 12)) < 0.6).astype(np.float32)
    w, bias = fit_nnpu(listed(positive), listed(x), 12, prior)
    p = 1 / (1 + np.exp(-(x @ w + bias)))
    assert ((p >= 0.5) == y).mean() > 0.93
    assert abs(p.mean() - prior) < 0.1


def listed(matrix):
    return [np.flatnonzero(row).tolist() for row in matrix]


def crc_held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(2)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    docs, labels = [], []
    for k in range(1500):
        words = list(rng.choice(vocabulary, rng.integers(20, 120)))
        bad = k % 8 == 0
        if bad:
            for w in rng.choice(["vilezor", "grumpox", "snarlyk"], rng.integers(1, 4)):
                words[rng.integers(len(words))] = str(w)
        docs.append((k, " ".join(words), "x"))
        if (k // 8) % 3 < 2:  # labelled whether toxic or not, so that labels show the prior
            labels.append((k, int(bad), "x"))
    docs += [(5000, None, "x"), (5001, "", "x"), (None, "no id", "x"), (5002, "vilezor " * 20_000, "x"), (3, docs[3][1], "x")]
    labels += [(0, None, "x"), (8, 0, "x"), (None, 1, "x"), (9999, 1, "x")]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int, text string"), docs


def test_held_out_accuracy_and_edges(made):
    docs, labels, rows = made
    got = toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    held = [k for k in range(1500) if crc_held(k)]
    assert all(by_id[k].held_out == crc_held(k) for k in range(1500))
    assert sum(by_id[k].predicted == (k % 8 == 0) for k in held) >= 0.97 * len(held)
    assert by_id[5000].predicted == by_id[5001].predicted == 0 and by_id[5000].score == by_id[5001].score
    assert by_id[5002].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_drop_keeps_columns_and_clean_rows(made):
    docs, labels, rows = made
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert sum(k in ids for k in range(1500) if k % 8) >= 0.99 * 1312
    assert sum(k in ids for k in range(1500) if k % 8 == 0) <= 0.05 * 188


def test_held_out_labels_are_not_read(made):
    docs, labels, _ = made
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id AS string)) % 4 = 2, 1 - toxic, toxic) AS toxic", "text")
    a, b = train(docs, labels), train(docs, flipped)
    assert a.features == b.features and a.weights == b.weights and a.bias == b.bias


def test_no_labels_and_empty_tables(made, no_docs):
    docs, labels, rows = made
    model = train(docs, labels.limit(0))
    assert {r.score for r in score_toxicity(docs, model).collect()} == {0.0}
    assert toxicity(no_docs, labels).count() == 0
    assert drop_toxic(docs, labels.limit(0)).count() == len(rows)


def small_sample(seed=4, n_p=40, n_u=90, features=6):
    rng = np.random.default_rng(seed)
    return (rng.random((n_p, features)) < 0.5).astype(np.float32), (rng.random((n_u, features)) < 0.3).astype(np.float32)


def risk_by_hand(positive, unlabelled, prior, w, bias, decay):
    """The corrected risk, one document at a time; also its two parts."""
    score = lambda row: sum(a * b for a, b in zip(row, w)) + bias
    loss = lambda g, y: math.log1p(math.exp(-y * g))
    plus = sum(loss(score(r), 1) for r in positive) / len(positive)
    minus = sum(loss(score(r), -1) for r in positive) / len(positive)
    other = sum(loss(score(r), -1) for r in unlabelled) / len(unlabelled)
    first = prior * plus + 0.5 * decay / len(positive) * sum(a * a for a in w)
    return first, other - prior * minus


def test_risk_and_gradient_by_hand():
    positive, unlabelled = small_sample()
    risk = PuRisk(listed(positive), listed(unlabelled), 6, 0.2, 0.7)
    rng = np.random.default_rng(5)
    for _ in range(5):
        w = rng.normal(size=7)
        first, second = risk_by_hand(positive.tolist(), unlabelled.tolist(), 0.2, w[:-1].tolist(), w[-1], 0.7)
        assert risk.parts(w) == pytest.approx((first, second), abs=1e-8)
        assert risk.risk(w) == pytest.approx(first + max(0, second), abs=1e-8)
        for s in (1.0, 0.4):
            grad = risk.gradient(w, s)
            for k in range(7):  # finite differences
                step = np.zeros(7)
                step[k] = 1e-5
                (a, b), (c, d) = risk.parts(w + step), risk.parts(w - step)
                assert grad[k] == pytest.approx((a + s * b - c - s * d) / 2e-5, abs=1e-7)


@pytest.mark.parametrize("prior, bound", [(0.1, False), (0.8, True)])
def test_fit_is_the_least_point(prior, bound):
    """No step in any direction lowers the risk, with the bound reached or not."""
    positive, unlabelled = small_sample()
    w, bias = fit_nnpu(listed(positive), listed(unlabelled), 6, prior)
    risk, at = PuRisk(listed(positive), listed(unlabelled), 6, prior), np.append(w, bias)
    assert (abs(risk.parts(at)[1]) < 1e-5) == bound and risk.parts(at)[1] > -1e-5
    rng = np.random.default_rng(6)
    for size in (1e-3, 0.05, 1.0):
        for _ in range(50):
            assert risk.risk(at + size * rng.normal(size=7)) >= risk.risk(at) - 2e-6


def test_row_order_changes_nothing():
    positive, unlabelled = small_sample(7, 60, 200, 20)
    rng = np.random.default_rng(8)
    want = fit_nnpu(listed(positive), listed(unlabelled), 20, 0.3)
    for _ in range(3):
        w, bias = fit_nnpu(listed(positive[rng.permutation(60)]), listed(unlabelled[rng.permutation(200)]), 20, 0.3)
        assert (w == want[0]).all() and bias == want[1]


def test_partitions_change_no_score(made):
    docs, labels, _ = made
    first, again = (sorted(toxicity(docs.repartition(n), labels.repartition(n)).collect(), key=str) for n in (2, 7))
    assert first == again


def test_scores_by_hand():
    model = Model([], [0.5, -1.0], 0.25)
    words = ["good", "bad"]
    model.features = [min(pieces(w)) for w in words]
    own = lambda t: sum(w for f, w in zip(model.features, model.weights) if any(f in pieces(x) for x in t.lower().split()))
    texts = ["good bad", "Good good", "none", "", None]
    want = [1 / (1 + math.exp(-(own(t or "") + 0.25))) for t in texts]
    assert model.scorer()(texts) == pytest.approx(want)
