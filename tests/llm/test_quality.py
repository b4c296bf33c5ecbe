"""The quality rules against plain counts, and the trees against their constraints."""

import re

import numpy as np

from quillmesh.llm import quality_trees as q
from quillmesh.llm import statistics


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = {r for r in runs if runs.count(r) > 1} if len(set(runs)) < len(runs) else set()
    gone = {k + j for k, r in enumerate(runs) if r in often for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(gone)


def test_base_counts_and_rules(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "a b " * 3000), (-4, "x\nx\n \ny # <b>"), (-4, "x\nx\n \ny # <b>"), (None, "w " * 30)], "doc_id long, text string")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = q.op4(docs.unionAll(odd), labels).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.unionAll(odd).collect()}
    assert len(rows) == docs.count() + 6
    for r in rows:
        want = counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_no_labels_pass_all_but_the_base_rules(spark):
    docs = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(30)), "clash") for k in range(5)], "doc_id long, text string, quality string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["kept"] for r in q.judge(docs, q.fit(docs, labels)).collect()] == [True] * 5
    assert q.op4(docs.limit(0), labels).count() == 0


def test_trees_keep_both_directions_and_learn():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 3))
    y = (x[:, 0] - x[:, 1] + 0.5 * np.sin(3 * x[:, 2]) + rng.normal(size=3000) * 0.3 > 0).astype(float)
    model = q.fit_trees(x, y, [1, -1, 0])
    assert ((q.predict(model, x) > 0.5) == (y > 0)).mean() > 0.9
    for j, way in ((0, 1), (1, -1)):
        at = np.repeat(rng.normal(size=(50, 3)), 40, 0)
        at[:, j] = np.tile(np.linspace(-3, 3, 40), 50)
        p = q.predict(model, at).reshape(50, 40)
        assert (way * np.diff(p, axis=1) >= -1e-12).all()


def test_flat_arrays_score_as_walking_does():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(500, 4)), rng.integers(0, 2, 500).astype(float)
    m = q.fit_trees(x, y, [0] * 4)
    for row, p in zip(x[:50], q.predict(m, x[:50]), strict=True):
        z = m["bias"]
        for k in m["roots"]:
            while m["feature"][k] >= 0:
                k = m["left"][k] + (row[m["feature"][k]] > m["threshold"][k])
            z += m["value"][k]
        assert abs(p - 1 / (1 + np.exp(-z))) < 1e-12


def test_features_are_finite():
    for t in (None, "", " ", "1 2 3", "É" * 50, "a" * 100_000):
        assert np.isfinite(statistics.features(t, statistics.base(t))).all()
