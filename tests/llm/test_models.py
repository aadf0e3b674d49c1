"""Classifiers: held-out accuracy, and edge cases."""

import numpy as np
import pytest

from foliant.llm import quality, toxicity
from tests.conftest import DATA


def measured(spark, out, label, sf):
    labels = spark.read.parquet(f"{DATA}/{sf}/labels.parquet").select("doc_id", label)
    return out.join(labels, "doc_id").filter("held_out").toPandas()


def test_quality_held_out(spark):
    m = measured(spark, quality.op3_quality(spark, f"{DATA}/sf0.01"), "quality", "sf0.01")
    assert (m["predicted"] == m["quality"]).mean() > 0.9
    assert m[m["quality"] == 1]["score"].mean() > m[m["quality"] == 0]["score"].mean() + 0.5


def test_toxicity_held_out(spark):
    m = measured(spark, toxicity.op9_toxicity(spark, f"{DATA}/sf0.1"), "toxic", "sf0.1")
    hit = m[m["predicted"] == 1]
    assert (hit["toxic"] == 1).mean() > 0.9 and (m[m["toxic"] == 1]["predicted"] == 1).mean() > 0.85


def test_prior_estimate():
    rng = np.random.default_rng(0)
    pos, neg = rng.beta(8, 2, 4000), rng.beta(2, 8, 4000)
    mixed = np.concatenate([rng.beta(8, 2, 6000), neg[:4000]])
    assert quality.estimate_prior(pos, np.histogram(mixed, quality.BINS, (0, 1))[0]) == pytest.approx(0.6, abs=0.08)


def test_label_model_finds_accuracies_and_correlation():
    rng = np.random.default_rng(1)
    n, prior = 40_000, 0.2
    y = rng.random(n) < prior
    on, off = np.array([0.9, 0.7, 0.6, 0.8, 0.5, 0.7]), np.array([0.05, 0.1, 0.02, 0.2, 0.1, 0.1])
    votes = np.where(y[:, None], rng.random((n, 6)) < on, rng.random((n, 6)) < off).astype(float)
    votes[:, 5] = np.where(rng.random(n) < 0.9, votes[:, 1], votes[:, 5])  # a near copy of voter 1
    rates, loose = toxicity.label_model(votes.T @ votes, n, prior)
    assert np.abs(rates[:5, 0] - on[:5]).max() < 0.15 and np.abs(rates[:5, 1] - off[:5]).max() < 0.08
    assert loose[1, 5] == np.abs(loose).max() > 0.3


def test_scores_of_odd_texts(spark):
    docs = spark.createDataFrame(
        [(1, None, "c"), (2, "", "c"), (3, "you are an idiot and a moron, pathetic trash", "c"), (4, "a calm text about rivers and hills", "c"), (4, "a calm text about rivers and hills", "c"), (None, "x" * 200_000, "c")],
        "doc_id bigint, text string, label string",
    )
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (None, 1, 1), (1, None, None)], "doc_id bigint, toxic int, quality int")
    for no_labels in (False, True):
        known = labels.limit(0) if no_labels else labels
        model, featured = toxicity.train(docs, known)
        got = toxicity.scores(featured, model).collect()
        by = {r["id"]: r["score"] for r in got}
        assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got) and by[3] > by[4] and by[1] == by[2]
        assert sorted(r["score"] for r in toxicity.with_score(docs, model).collect()) == pytest.approx(sorted(r["score"] for r in got), abs=1e-6)
        trained, table = quality.train(docs, known)
        assert quality.scores(table, trained).filter("score between 0 and 1").count() == 6
    assert toxicity.scores(*reversed(toxicity.train(docs.limit(0), labels))).count() == 0
    assert quality.scores(*reversed(quality.train(docs.limit(0), labels))).count() == 0


def test_rejected_rows_go_with_columns_kept(spark):
    docs = spark.createDataFrame([(1, "idiot moron scum trash", "a", "b"), (2, "quiet words", "a", "b"), (3, None, "a", "b")], "doc_id bigint, text string, _score string, _text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    out = toxicity.non_toxic(docs, labels)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == {2, 3}


def test_prior_with_few_positives():
    assert 0 < quality.estimate_prior(np.array([0.9]), np.histogram([0.2, 0.9], quality.BINS, (0, 1))[0]) < 1


def test_risk_against_sums_written_out():
    rng = np.random.default_rng(2)
    pos, unl, prior, w = rng.normal(1, 1, (30, 4)), rng.normal(0, 1, (50, 4)), 0.3, rng.normal(0, 0.3, 4)
    risk = lambda w: quality.Risk(w, pos, quality.unlabelled_sums(unl, w), prior)
    loss = lambda v: np.log1p(np.exp(-v))
    l2 = quality.L2 + quality.L2_ROWS / len(pos)
    second = sum(loss(-(x @ w)) for x in unl) / len(unl) - prior * sum(loss(-(x @ w)) for x in pos) / len(pos)
    assert risk(w).negative == pytest.approx(second) and second > 0
    assert risk(w).value == pytest.approx(prior * sum(loss(x @ w) for x in pos) / len(pos) + second + l2 / 2 * w @ w)
    for i in range(4):
        e = np.eye(4)[i] * 1e-5
        assert risk(w).gradient[i] == pytest.approx((risk(w + e).value - risk(w - e).value) / 2e-5, abs=1e-6)
        assert risk(w).curvature[i] == pytest.approx((risk(w + e).gradient - risk(w - e).gradient) / 2e-5, abs=1e-6)
    high = quality.Risk(np.array([9.0, 0, 0, 0]), pos, quality.unlabelled_sums(unl - 3, np.array([9.0, 0, 0, 0])), 0.9)
    assert high.negative < 0 and high.value >= 0


def test_descent_ends_at_the_least_risk():
    rng = np.random.default_rng(3)
    one = lambda x: np.hstack([x, np.ones((len(x), 1))])
    pos, unl = one(rng.normal(1, 1, (400, 2))), one(np.vstack([rng.normal(1, 1, (600, 2)), rng.normal(-1, 1, (400, 2))]))
    risk = lambda w: quality.Risk(w, pos, quality.unlabelled_sums(unl, w), 0.6)
    w = quality.descend(risk, 3, 30)
    assert risk(w).negative >= 0 and all(risk(w + d).value >= risk(w).value - 1e-6 for d in rng.normal(0, 0.05, (200, 3)))
    assert (unl[:600] @ w > 0).mean() > 0.85 and (unl[600:] @ w < 0).mean() > 0.8


def test_quality_is_the_same_however_rows_are_dealt(spark):
    sf, got = f"{DATA}/sf0.001", []
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for batch, parts in (("10000", 1), ("7", 11)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        model, table = quality.train(docs.repartition(parts), labels)
        got.append({r["id"]: r["score"] for r in quality.scores(table, model).collect()})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got[0] == pytest.approx(got[1], abs=1e-6)


def test_posterior_against_bayes():
    rng = np.random.default_rng(4)
    k = len(toxicity.VOTERS)
    rates = np.stack([rng.uniform(0.3, 0.9, k), rng.uniform(0.01, 0.2, k)], axis=1)
    model = toxicity.Model({}, rates, np.zeros((k, k)), prior=0.2)
    for _ in range(20):
        votes = (rng.random(k) < 0.3).astype(float)
        like = [1.0, 1.0]
        for j in range(k):
            for c in (0, 1):
                if votes[j]:
                    like[c] *= rates[j, c]
                elif toxicity.TWO_SIDED[j]:
                    like[c] *= 1 - rates[j, c]
        assert model.posterior(votes[None])[0] == pytest.approx(0.2 * like[0] / (0.2 * like[0] + 0.8 * like[1]), rel=1e-9)


def test_classifier_finds_the_least_loss_of_posteriors():
    rng = np.random.default_rng(5)
    x, n = np.hstack([rng.integers(0, 2, (60, 5)), np.ones((60, 1))]).astype(np.float64), rng.integers(1, 9, 60)
    y = 1 / (1 + np.exp(-(x @ rng.normal(0, 1, 6))))

    def at(w):
        out = toxicity.loss_sums(x, y, n, w) / n.sum()
        return out[0] + 1e-3 / 2 * w @ w, out[1:] + 1e-3 * w

    written_out = lambda w: sum(c * -(t * np.log(p) + (1 - t) * np.log(1 - p)) for c, t, p in zip(n, y, 1 / (1 + np.exp(-(x @ w))), strict=True)) / n.sum() + 1e-3 / 2 * w @ w
    w = toxicity.minimise(at, 6, steps=60)
    assert at(w)[0] == pytest.approx(written_out(w)) and np.abs(at(w)[1]).max() < 1e-4
    assert all(written_out(w + d) >= written_out(w) - 1e-9 for d in rng.normal(0, 0.01, (50, 6)))


def test_labels_are_no_targets(spark):
    """With the same lexicon the fit is the same whatever the labels say."""
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    all_clean = docs.selectExpr("doc_id", "0 AS toxic")
    models = [toxicity.train(docs, labels)[0] for labels in (none, all_clean)]
    assert models[0].entries == models[1].entries
    np.testing.assert_allclose(models[0].weights, models[1].weights, atol=1e-9)


def test_null_id_is_not_held_out(spark, tmp_path):
    spark.createDataFrame([(None, "an idiot"), (1, "calm words"), (2, "stupid moron, idiot")], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for run in (quality.op3_quality, toxicity.op9_toxicity):
        got = {r["doc_id"]: r["held_out"] for r in run(spark, str(tmp_path)).collect()}
        assert got[None] is False and set(got.values()) <= {True, False}
