"""The hashed TF-IDF classifier against a plain version of its features and weights."""

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import classify
from tessera.plans.base import table


def test_weights_and_probabilities(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select("doc_id", "text", "quality")
    words = text.tokens(F.lower("text"))
    places, penalty = 200, 0.05
    model = classify.fit(d, words, F.col("quality"), places, 500, penalty)
    tf, idf, lr = model.stages
    rows = tf.transform(d.select("doc_id", words.alias("words"), "quality")).collect()
    x = np.array([r.counts.toArray() for r in rows])
    some = rows[3].words[:30]
    assert x.sum() == sum(len(r.words) for r in rows) and all(x[3, tf.indexOf(w)] >= rows[3].words.count(w) for w in some)
    has = np.array([r.quality is not None for r in rows])
    y = np.array([r.quality or 0 for r in rows], float)
    weight = np.log((has.sum() + 1) / ((x[has] > 0).sum(axis=0) + 1))
    assert np.allclose(weight, idf.idf.toArray())
    x *= weight
    a = np.hstack([x[has], np.ones((has.sum(), 1))])
    theta, keep = np.zeros(places + 1), np.append(np.full(places, penalty), 0.0)
    for _ in range(60):  # Newton's steps
        p = 1 / (1 + np.exp(-a @ theta))
        g = a.T @ (p - y[has]) / len(a) + keep * theta
        h = (a * (p * (1 - p))[:, None]).T @ a / len(a) + np.diag(keep) + 1e-12 * np.eye(places + 1)
        theta -= np.linalg.solve(h, g)
    assert np.abs(lr.coefficients.toArray() - theta[:-1]).max() < 1e-3 and abs(lr.intercept - theta[-1]) < 1e-2
    got = {r.id: (r.probability, r.predicted) for r in classify.probabilities(model, d, "doc_id", words).collect()}
    want = 1 / (1 + np.exp(-(x @ theta[:-1] + theta[-1])))
    assert len(got) == len(rows) and all(abs(got[r.doc_id][0] - p) < 1e-2 and got[r.doc_id][1] == int(got[r.doc_id][0] > 0.5) for r, p in zip(rows, want, strict=True))
