"""The chain over a small corpus: every stage against a plain version on its own input, and run() against the chain."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from test_mixing import filled
from test_signature_trees import brute
from tokenizers import Tokenizer

import corpus_pipeline
from quillmesh.llm import packing, toxicity_kn

SF = "/root/testdata/sf0.001"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """The folder of the tables, and the rows of each stage's input and output."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = pq.read_table(f"{SF}/documents.parquet")
    rows = docs.to_pylist()
    first = next(r for r in rows if len(_WORD.findall(r["text"] or "")) > 100)
    top = max(r["doc_id"] for r in rows)
    words = first["text"].split()
    planted = [first["text"], " ".join([*words[:-1], "altered"]), None, "", "lone line a\nlone line b\nown words here", "other words\nlone line a\nlone line b"]
    rows += [first | {"doc_id": top + 1 + k, "text": t, "n_chars": len(t or "")} for k, t in enumerate(planted)]
    pq.write_table(type(docs).from_pylist(rows, docs.schema), f"{folder}/documents.parquet")
    pq.write_table(pq.read_table(f"{SF}/labels.parquet"), f"{folder}/labels.parquet")
    tables = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], folder).write.parquet(f"{folder}/{name}.parquet")
        tables.append(spark.read.parquet(f"{folder}/{name}.parquet"))
    return folder, [[r.asDict() for r in t.collect()] for t in tables], tables


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_toxic_documents_go_and_others_stay(spark, chain):
    folder, rows, tables = chain
    said = toxicity_kn.op6(tables[0], spark.read.parquet(f"{folder}/labels.parquet")).collect()
    clean = {r["doc_id"] for r in said if not r["predicted"]}
    assert texts(rows[1]) == {i: t for i, t in texts(rows[0]).items() if i in clean}


def test_lines_that_stood_before_go(chain):
    _, rows, _ = chain
    pairs, long, want = set(), set(), {}
    for i, t in sorted(texts(rows[1]).items()):
        lines = (t or "").split("\n")
        at = [k for k, x in enumerate(lines) if _WORD.search(x)]
        own = [lines[k].strip(" \t\r\v\f") for k in at]
        gone = set()
        for k, x in enumerate(own):
            if len(_WORD.findall(x)) >= 20:
                gone |= {k} if x in long else set()
                long.add(x)
            if k + 1 < len(own):
                gone |= {k, k + 1} if (x, own[k + 1]) in pairs else set()
                pairs.add((x, own[k + 1]))
        if not at or len(gone) < len(at):
            drop = {at[k] for k in gone}
            want[i] = "\n".join(x for k, x in enumerate(lines) if k not in drop) if gone else t
    assert texts(rows[2]) == want
    assert any(want[i] != texts(rows[1])[i] for i in want)


def test_one_of_each_component_stays(chain):
    _, rows, _ = chain
    before = texts(rows[2])
    found = brute(list(before.items()))
    assert texts(rows[3]) == {i: t for i, t in before.items() if found[i][1] == i}


def test_sources_come_near_their_targets(chain):
    _, rows, _ = chain
    size = {r["doc_id"]: len(_WORD.findall(r["text"] or "")) for r in rows[3]}
    source = {r["doc_id"]: r["source"] for r in rows[3]}
    copies = Counter(r["doc_id"] for r in rows[4])
    assert set(copies) <= set(size) and all(n <= 2 for i, n in copies.items() if size[i])
    whole, taken = Counter(), Counter()
    for i, s in source.items():
        whole[s] += size[i]
        taken[s] += size[i] * copies[i]
    order = sorted(whole, key=lambda s: (s is None, s or ""))
    want = filled(whole, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(whole.values()), 2)
    for s in order:
        assert abs(taken[s] - want[s]) <= max(size[i] for i in size if source[i] == s)


def test_every_copy_is_packed_whole(chain):
    _, rows, _ = chain
    t, copies, text = Tokenizer.from_file(packing.VOCABULARY), Counter(r["doc_id"] for r in rows[4]), texts(rows[4])
    pieces, sequences = defaultdict(Counter), defaultdict(list)
    for r in rows[5]:
        pieces[r["doc_id"]][r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(copies)
    for i, own in pieces.items():
        ids, at = np.array([*t.encode(text[i] or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for k, ((piece, start, length, crc), n) in enumerate(sorted(own.items())):
            assert (piece, start, crc, n) == (k, at, zlib.crc32(ids[at : at + length].tobytes()), copies[i])
            at += length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024


def test_run_gives_the_rows_of_the_chain(spark, chain):
    folder, rows, _ = chain

    def pieces(found):
        return Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found)

    assert pieces(corpus_pipeline.run(spark, folder).collect()) == pieces(rows[5])
