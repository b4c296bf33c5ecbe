import hashlib
import re

import numpy as np

from quillmesh.llm import substring_blocks


def brute(rows):
    seen, out = {}, {}
    docs = sorted((i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows)
    for i, w in docs:
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            if seen.setdefault(tuple(w[p : p + 20]), (i, p)) != (i, p):
                gone[p : p + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_blocks.op3(docs).collect()}
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edges(spark):
    a = " ".join(f"w{i}" for i in range(45))
    rows = [(1, a), (2, "x y " + a[8:]), (3, None), (4, ""), (5, a + " " + a), (6, " ".join(["z"] * 60)), (7, "é " * 19)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_blocks.op3(docs).collect()}
    assert got == brute(rows)
    assert substring_blocks.op3(docs.limit(0)).count() == 0


def test_one_id_with_two_texts_and_other_white_space(spark):
    a = " ".join(f"w{i}\u00a0\u0085{i}\x1c" for i in range(30))
    b = "\t".join(f"v{i}" for i in range(25))
    rows = [(1, a), (2, b + "\v" + a), (4, "q " + b), (None, a), (5, "é\u3000ß " * 41)]
    docs = spark.createDataFrame(rows + [(2, "other words of the same id"), (1, a)], "doc_id long, text string")
    got = {(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_blocks.op3(docs).collect()}
    want = {(i if i < 9 else None, *v) for i, v in brute([(9 if i is None else i, t) for i, t in rows]).items()}
    sha = hashlib.sha256(b"other words of the same id").hexdigest()
    assert got == want | {(2, 6, 0, sha)}


def test_probes_that_meet_no_block_are_not_sorted():
    h = np.random.default_rng(3).integers(0, 1 << 63, 100_000).astype(np.uint64)
    block = np.arange(len(h)) % 10 == 0
    h[5::1000] = h[::1000]  # probes that meet a block
    may = substring_blocks._may_hit(h, block)
    assert may[block].all() and may[5::1000].all() and may.sum() < 0.2 * len(h)


def test_hits_hold_places_only(spark, monkeypatch):
    kept, as_table = {}, substring_blocks.common.as_table
    monkeypatch.setattr(substring_blocks.common, "as_table", lambda df, label: kept.setdefault(label, as_table(df, label)))
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    substring_blocks.op3(docs)
    assert sum(len(r["data"]) for r in kept["anchor-hits"].collect()) == 2 * 4 * 4  # four blocks in each text, four bytes a place
