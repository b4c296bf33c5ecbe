import re

import numpy as np

from quillmesh.llm import signature_trees as st


def brute(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    comp = {i: i for i in ids}
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and comp[i] != comp[j]:
                lo, hi = sorted((comp[i], comp[j]))
                comp = {k: lo if c == hi else c for k, c in comp.items()}
    return {i: (len(sets[i]), comp[i]) for i in ids}


def check(docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in st.near_duplicates(docs).collect()}
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_matches_brute_force(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))


def test_chains_and_edges(spark):
    rng = np.random.default_rng(5)
    base, rows = [f"w{i}" for i in rng.integers(0, 5000, 200)], [(0, None), (1, ""), (2, "A b"), (3, "a B"), (4, " \n ")]
    for i in range(5, 80):
        base = [w if rng.random() > 0.012 else f"v{rng.integers(0, 9000)}" for w in base]
        rows.append((i, " ".join(base)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert st.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_traversal_that_prunes_everything():
    bits = np.zeros((20, 16), np.uint64)
    bits[np.arange(20), np.arange(20) % 16] = np.uint64(255)
    size, component = np.full(20, 10), np.arange(20)
    tree = st.Tree(bits, size, component)
    (a, b), = st.dual(tree, tree, True)
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(i, i + 16) for i in range(4)]
    same = st.Tree(bits, size, np.zeros(20, int))
    assert [len(x) for p in st.dual(same, same, True) for x in p] == [0, 0]


def test_one_id_with_two_texts_links_nothing(spark):
    x, y = " ".join(f"x{i}" for i in range(40)), " ".join(f"y{i}" for i in range(40))
    rows = [(1, x), (1, y), (2, x + " z"), (3, y + " z"), (None, x), (4, x), (4, x)]
    got = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in st.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == [(0, 36, 1), (1, 36, 1), (1, 36, 1), (2, 37, 1), (3, 37, 1), (4, 36, 1), (4, 36, 1)]


def test_split_groups_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(st, "BLOCK", 4)
    rng, rows = np.random.default_rng(3), []
    base = [f"w{i}" for i in range(120)]
    for i in range(60):
        t = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 5)):
            t[k] = f"v{rng.integers(0, 40)}"
        rows.append((i, " ".join(t)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_one_of_each_keeps_columns_and_wordless_rows(spark):
    x = " ".join(f"x{i}" for i in range(40))
    rows = [(1, x, "a"), (2, x, "b"), (3, "", "c"), (None, x, "d"), (5, None, "e"), (1, x, "a")]
    got = st.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, class string"))
    assert got.columns == ["doc_id", "text", "class"]
    assert sorted(r["class"] for r in got.collect()) == ["a", "c", "d", "e"]
