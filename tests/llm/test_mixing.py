"""Mixing against a plain water-filling."""

import pytest

from quillmesh.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string"


def filled(sizes, weights, total, cap):
    held, targets = set(), {}
    while True:
        rest = total - sum(cap * sizes[s] for s in held)
        open_ = [s for s in sizes if s not in held]
        if not open_:
            break
        share = {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        targets = share
        if not over:
            break
        held |= over
    return {s: cap * sizes[s] if s in held else targets[s] for s in sizes}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, ["b", "a", None, "c"][min(3, i % 7)], "w " * (i % 11), "clash") for i in range(700)]
    return spark.createDataFrame([*rows, (900, "a", None, None), (None, "c", "x y", None), (5, "c", "w w", None), (5, "c", "w w", None)], SCHEMA)


def test_targets_and_taken(docs):
    rows = mixing.op9(docs).collect()
    assert len(rows) == docs.count()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = filled(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2)
    for s in order:
        own = [r for r in rows if r["source"] == s]
        assert {r["source_size"] for r in own} == {sizes[s]}
        assert own[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 10
    assert sorted(map(repr, mixing.op9(docs).collect())) == sorted(map(repr, rows))


def test_repetitions_keep_the_columns(docs):
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    taken = mixing.mix(docs)
    assert got.count() == taken.agg({"repeats": "sum"}).first()[0]
    assert [c for c in taken.columns if c.lower() == "size"] == ["size"]


def test_empty(spark):
    assert mixing.op9(spark.createDataFrame([], SCHEMA)).count() == 0
