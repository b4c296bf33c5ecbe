"""The model's table grows with what was counted: no pair or word shares another's counts."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest

from quillmesh.llm import toxicity_kn


def test_unseen_words_are_no_evidence(spark):
    words = map("".join, itertools.product("abcdefghijklmnop", repeat=5))
    rows = [(i, " ".join(itertools.islice(words, 4000))) for i in range(60)]
    unseen = " ".join(itertools.islice(words, 2000))
    docs = spark.createDataFrame([*rows, (1000, unseen), (1001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity_kn.op6(docs, labels).where("doc_id >= 1000 OR doc_id = 2").collect()}
    assert got[1000] == got[1001]


def test_toxic_expressions_are_found(spark):
    rows = [(i, ("plain words of a quiet day " * 3) + ("vile insult" if i % 4 == 0 else "kind remark")) for i in range(200)]
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, rows[0][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity_kn.op6(docs, labels).collect()}
    assert len(got) == 203
    assert all(got[i]["predicted"] == int(i % 4 == 0) for i, _ in rows)
    assert got[None]["score"] == got[0]["score"] and got[1000]["score"] == got[1001]["score"]


def test_distributions_sum_to_one(spark):
    """Against plain Kneser-Ney on a small corpus: every probability of the table, and the mass over all words after each word."""
    rng = random.Random(3)
    words = ["alphaone", "alphatwo", "beta", "gamma", "deltasix", "deltas"]
    rows = [(" ".join(rng.choice(words) for _ in range(12)), i % 2) for i in range(30)]
    pairs = toxicity_kn.counted(spark.createDataFrame(rows, "text string, y int"), "text")
    table, stems, unseen, _ = toxicity_kn.probabilities(pairs)
    key = {w: toxicity_kn._word_key(w) for w in words}
    signed = {w: k - (1 << 64) if k >= 1 << 63 else k for w, k in key.items()}
    got = {r["word"]: r for r in table.collect()}
    d = lambda n: 0 if not n else toxicity_kn.DISCOUNTS[min(n, len(toxicity_kn.DISCOUNTS)) - 1]
    n = [Counter(), Counter()]
    for text, y in rows:
        w = text.split()
        n[y].update(set(zip(["", *w], w, strict=False)))
    both = set(n[0]) | set(n[1])
    shared = Counter(w for _, w in both)
    shared_stems = Counter(w[:5] for _, w in both)
    for c in (0, 1):
        s, x = Counter(w for _, w in n[c]), Counter(w[:5] for _, w in n[c])
        total = sum(s.values())
        left, left_stems = sum(map(d, s.values())) / total, sum(map(d, x.values())) / total
        p = {}
        for w in words:
            stem = (x[w[:5]] - d(x[w[:5]])) / total + left_stems * (shared_stems[w[:5]] - 0.5) / sum(shared.values())
            p[w] = (s[w] - d(s[w])) / total + left * stem * (shared[w] - 0.5) / shared_stems[w[:5]]
            assert got[signed[w]][f"p{c}"] == pytest.approx(p[w])
        # what the known words leave is what unseen forms of known stems and unseen stems get
        forms = sum(left * ((x[t] - d(x[t])) / total + left_stems * (shared_stems[t] - 0.5) / sum(shared.values())) * 0.5 * sum(1 for w in shared if w[:5] == t) / shared_stems[t] for t in shared_stems)
        assert sum(p.values()) + forms + unseen[c] == pytest.approx(1)
        for v in words:
            seen = sum(k for (a, _), k in n[c].items() if a == v)
            assert got[signed[v]][f"seen{c}"] == seen
            assert sum(k - d(k) for (a, _), k in n[c].items() if a == v) / seen + got[signed[v]][f"l{c}"] / seen == pytest.approx(1)


def test_ratios_are_those_of_the_table(spark):
    ids, n = np.array([0, 1, 0, 2]), np.array([3, 1])
    h = np.array([toxicity_kn._word_key(w) for w in ("one", "two", "three")], np.uint64)
    a = toxicity_kn.Asked(h, ids, n, 64)
    assert a.v.tolist() == [3, 0, 1, 3] and len(a.keys[0]) == 4 and len(a.keys[1]) == 4
    zero = lambda k, t: [np.zeros(len(a.keys[k]), t) for _ in range(2)]
    words, stems = zero(1, np.float32) * 3, zero(2, np.float32)
    assert toxicity_kn.ratios(a, zero(0, np.uint32), words, stems, [0.25, 0.5]).tolist() == [0.0] * 4
    for q, value in zip(stems, (0.25, 0.5), strict=True):
        q[a.stem[1]] = value
    assert toxicity_kn.ratios(a, zero(0, np.uint32), words, stems, [0.1, 0.1]) == pytest.approx([0, np.log(2), 0, 0])


def test_without_labels_all_stay(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "a") for i in range(20)], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity_kn.kept(docs, none).count() == 20
    assert toxicity_kn.kept(docs, spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int")).count() == 20


def test_held_out_toxic_texts_of_the_tables_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity_kn.op6(docs, labels).where("held_out").join(labels.where("toxic IS NOT NULL"), "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85
    assert n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.02
