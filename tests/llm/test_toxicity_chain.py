"""The learnt categories of the toxicity chain, its out-of-fold chances, and accuracy on labels it was not trained on."""

import numpy as np
from pyspark.sql import functions as F

from wardlake.llm import toxicity
from wardlake.llm.common import table


def test_categories_from_counts():
    counts = [("w:bad", 0, 60), ("w:awful", 1, 30), ("w:mal", 0, 30), ("p:malo", 0, 90), ("w:the", 900, 100), ("w:vile", 5, 5)]
    frequent, rarer = toxicity.marking_words(counts)
    assert frequent == {"w:bad", "w:awful"} and rarer == {"w:mal", "w:vile"}
    assert toxicity.marking_words([]) == (set(), set())
    names = [f for f, _, _ in counts]
    x = [np.array([0, 4]), np.array([2, 3]), np.array([1, 5]), np.array([0]), np.array([], int)]
    got = toxicity.category_labels(x, np.array([1, 1, 1, 0, 1]), names, (frequent, rarer))
    assert got.tolist() == [[1, 0, 1], [0, 1, 1], [1, 1, 1], [0, 0, 0], [0, 0, 1]]
    assert toxicity.category_labels([], np.zeros(0, int), [], (set(), set())).shape == (0, 3)


def test_chances_come_from_models_that_have_not_seen_the_document():
    rng = np.random.default_rng(3)
    x = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(90)]
    y = np.array([[int(0 in r), int(1 in r), int(0 in r or 1 in r)] for r in x])
    fold = np.arange(90) % toxicity.FOLDS
    chain = toxicity.Chain([str(k) for k in range(6)], x, y, fold)
    seen = np.zeros((90, 0))
    for c in range(3):
        expected = np.zeros(90)
        for k in range(90):
            others = np.flatnonzero(fold != fold[k])
            model = toxicity.fit([x[j] for j in others], seen[others], y[others, c].astype(float), 6)
            expected[k] = toxicity.chances(model, [x[k]], seen[k:k + 1])[0]
            if k >= 6:  # two documents of each fold are enough
                break
        assert np.allclose(chain.out_of_fold[:6, c], expected[:6])
        seen = chain.out_of_fold[:, :c + 1]


def test_cut_has_the_best_f1_of_all():
    rng = np.random.default_rng(1)

    def f1(cut, p, y):
        hit = (p >= cut) & (y == 1)
        return 2 * hit.sum() / max(1, (p >= cut).sum() + y.sum())

    for n in [1, 2, 5, 40] * 10:
        y = (rng.random(n) < 0.4).astype(int)
        p = np.round(np.clip(0.35 * rng.random(n) + 0.45 * y + 0.2 * rng.random(n), 0, 1), 2)
        cut = toxicity.best_cut(p, y)
        assert cut >= 0.5 and f1(cut, p, y) >= max(f1(c, p, y) for c in [0.5, *p[p >= 0.5]]) - 1e-12
    assert toxicity.best_cut(np.zeros(0), np.zeros(0)) == 0.5


def test_held_out_labels_in_every_language(spark, sf_dir):
    """Trained on the labels of even ids, held against those of odd ids."""
    sf = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    chain = toxicity.train(docs, labels.filter("doc_id % 2 = 0"))
    odd = docs.join(labels.filter("doc_id % 2 = 1").withColumnRenamed("toxic", "truth"), "doc_id")
    got = toxicity.score(odd, chain).join(odd.select("doc_id", "lang", "truth"), "doc_id").groupBy("lang").agg(
        F.sum("truth").alias("bad"), F.count("*").alias("n"),
        F.sum(F.col("truth") * F.col("is_toxic").cast("int")).alias("caught"),
        F.sum((1 - F.col("truth")) * F.col("is_toxic").cast("int")).alias("wrong"),
        F.max("p_frequent").alias("frequent"), F.max("p_rarer").alias("rarer")).collect()
    assert len(got) == 4
    for r in got:
        assert r.caught >= 0.85 * r.bad and r.wrong <= 0.1 * (r.n - r.bad), r
    assert sum(r.caught for r in got) >= 0.9 * sum(r.bad for r in got)
    assert sum(r.wrong for r in got) <= 0.02 * sum(r.n - r.bad for r in got)
    assert max(r.frequent for r in got) > 0.5 and max(r.rarer for r in got) > 0.5
