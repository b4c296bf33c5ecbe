import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from quillmesh.llm import packing


def sound(rows, docs):
    t = Tokenizer.from_file(packing.VOCABULARY)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for i, text in docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    total = sum(r["length"] for r in rows)
    return len(by_seq), -(-total // 1024)


def test_packs_everything_tightly(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    n, least = sound(packing.op5(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert n <= 1.02 * least


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "word " * 5000), (4, "<|endoftext|>")]
    sound(packing.op5(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)
    assert packing.op5(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_plan_uses_every_length():
    rng = np.random.default_rng(1)
    for _ in range(20):
        counts = Counter(rng.integers(1, 1025, rng.integers(1, 400)).tolist())
        used = Counter()
        for lengths, n in packing.plan(dict(counts)):
            assert sum(lengths) <= 1024
            for k in lengths:
                used[k] += n
        assert used == counts


def test_ids_are_those_of_the_tokenizer():
    t, own, rng = Tokenizer.from_file(packing.VOCABULARY), packing._tokenizer(packing.VOCABULARY), np.random.default_rng(2)
    alike = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), 0x20AC]]
    every = [*alike, *map(chr, [0x378, 0x3B1, 0x5D0, 0x661, 0xE01, 0x180E, 0x2028, 0x3000, 0x4E2D, 0xFEFF, 0x1F600, 0x1E030, 0x11F50])]
    texts = ["", " ", "\n\n  x", "<|endoftext|>a <|endoftext|>", "a" * 3000, " " * 3000 + "b", "it's we'll I'D 've", *(chr(c) * 2 + f" a{chr(c)}1" for c in range(0x250))]
    texts += ["".join(rng.choice(x, rng.integers(1, 60))) for x in (alike, every) for _ in range(1500)]
    assert all(own(x) == t.encode(x, add_special_tokens=False).ids for x in texts)
