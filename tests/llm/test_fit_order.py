"""Fits do not depend on how labelled rows lie; rates written during a fit do not change it."""

import numpy as np
import pytest

from riskloom.llm import mixing, text_classifier, toxicity

WORDS = "red green blue hateful vile kind warm river stone cloud amber field".split()


def _rows(n=240):
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        words = [*rng.choice(WORDS[5:], 8), *(["hateful", "vile"] if bad else ["kind"])]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 2), int(bad)))
        if i % 5 == 0:                       # the same document with another label, and once more
            labels += [(i, int(i % 2), 1 - int(bad)), (i, int(i % 2), int(bad))]
    docs += [(n, None), (n + 1, ""), (n + 2, "hateful " * 20_000), (None, "kind"), (0, "kind river")]
    labels += [(n, 0, 0), (n + 1, 1, 0), (n + 2, 0, 1), (None, 1, 1), (n + 3, 1, None), (n + 9, 1, 0)]
    return docs, labels


def _frames(spark, parts, seed):
    docs, labels = _rows()
    rng = np.random.default_rng(seed)
    docs, labels = ([rows[i] for i in rng.permutation(len(rows))] for rows in (docs, labels))
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(parts),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(parts))


def test_smallest_of_several_labels_counts(spark):
    docs, labels = _frames(spark, 4, 1)
    sample = text_classifier.labelled_sample(docs, labels, "toxic")
    rows, given = _rows()
    least = {}
    for d, _, y in given:
        if d is not None and y is not None:
            least[d] = min(str(y), least.get(d, "9"))
    expected = {(t or "", least[d]) for d, t in rows if d in least}
    got = sample.collect()
    assert {(r.text, r.y) for r in got} == expected and len(got) == len(expected)


@pytest.mark.parametrize("fit", [
    lambda d, lab: toxicity.fit(d, lab.select("doc_id", "toxic")), lambda d, lab: mixing.fit_domains(d, lab)],
    ids=["toxicity", "domains"])
def test_models_do_not_depend_on_partitions(spark, fit):
    models = [fit(*_frames(spark, parts, seed)) for parts, seed in ((1, 2), (4, 3), (16, 4))]
    for m in models[1:]:
        assert m.classes == models[0].classes and m.vocabulary == models[0].vocabulary
        assert np.array_equal(m.weights, models[0].weights) and np.array_equal(m.bias, models[0].bias)


def test_toxicity_of_awkward_and_empty_tables(spark):
    docs, labels = _frames(spark, 2, 7)
    model = toxicity.fit(docs, labels.select("doc_id", "toxic"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(docs.where("false"), model).count() == 0
    none = toxicity.fit(docs, labels.select("doc_id", "toxic").where("false"))
    assert {0 <= r.score < 0.5 for r in toxicity.score(docs, none).collect()} == {True}


def test_rates_written_during_the_fit_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.4, 0.3, 0.2], 300)
    rows = [(int(n), q.tolist()) for n, q in zip(rng.integers(1, 60, 300), p)]
    narrow = spark.createDataFrame(rows, "n_tokens long, posteriors array<double>").repartition(3)
    targets = {"a": 0.2, "b": 0.2, "c": 0.6}
    found = []
    for every in (1, 1000):
        monkeypatch.setattr(mixing, "FOLDED", every)
        steps, goal = mixing.fit_rates(narrow, ["a", "b", "c"], targets, "a", 1.05)
        found.append(np.array(steps))
    assert len(found[0]) > 1 and found[0].shape == found[1].shape and np.allclose(found[0], found[1], atol=1e-9)
    # a reference solver: projected gradient of the same least squares, dense, in small steps
    n = np.array([r[0] for r in rows], float)
    inverse = np.linalg.inv((p * n[:, None]).T @ p)
    r = np.ones(len(n))
    for _ in range(20_000):
        r = np.maximum(0, r - p @ (inverse @ ((r * n) @ p - goal)))
    fitted = mixing.fold_steps(p, found[0])
    distance = [np.abs((x * n) @ p - goal).sum() / goal.sum() for x in (r, fitted)]
    assert distance[1] <= distance[0] + 1e-6 and fitted.min() >= 0

