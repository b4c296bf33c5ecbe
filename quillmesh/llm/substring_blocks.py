"""Substring dedup by fixed-block anchors.

Every document's non-overlapping blocks of half a window are the index; every rolling run of that many words probes it.
A window of 20 words holds a whole block of its document, so both places of a repeat are hit. Hits extend to the windows
around them, whose full sequences then meet by hash; a window that is not the earliest of its sequence is repeated, and
neighbouring repeated windows together are the maximal repeats.

Both meetings are packed by hash range: a task holds a bounded share of the hash space, and of a sequence that a third
of the documents share only 20 bytes a place. No pairs of documents are formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm import common

WINDOW = 20
_PLACE = np.dtype([("h", "<u8"), ("doc", "<i8"), ("pos", "<u4")])
_BLOCK = np.uint32(1 << 31)
_NO_ID = np.iinfo(np.int64).max
_KIND = "range int, data binary"


def _ids(b: pa.RecordBatch) -> np.ndarray:
    """Ids; null is the greatest."""
    return b.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _words(texts: pa.Array) -> list[list[bytes]]:
    """Words of each text in UTF-8: splitting bytes parts them at space and 09 to 0D, and nowhere else."""
    return [(t or b"").split() for t in texts.cast(pa.binary()).to_pylist()]


def _hashed(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words' hashes, each distinct word hashed once; texts' starts in them."""
    starts = np.append(0, np.cumsum([len(w) for w in words], dtype=np.int64))
    vocabulary = common.Vocabulary()
    ids = np.fromiter(map(vocabulary.__getitem__, chain.from_iterable(words)), np.int64, int(starts[-1]))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))[ids], starts


def _runs(h: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs within one text; each one's text and place."""
    runs = common.joined(h, length)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(runs)]
    pos = np.arange(len(runs)) - starts[text]
    whole = pos + length <= np.diff(starts)[text]
    return runs[whole], text[whole], pos[whole]


def _by_range(n: int, h: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """The places as one value for each of n hash ranges that has any, column by column: so they compress."""
    ranges = ((h >> np.uint64(44)) & np.uint64(n - 1)).astype(np.uint16)
    order = np.argsort(ranges, kind="stable")  # 16 bits: by radix
    ranges, columns = ranges[order], [h[order], doc[order], pos.astype(np.uint32)[order]]
    at = _firsts(ranges)
    data = [b"".join(c[x:y].tobytes() for c in columns) for x, y in zip(at, np.append(at[1:], len(h)), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(ranges[at].astype(np.int32)), pa.array(data, pa.binary())], names=["range", "data"])


def _places(t: pa.Table) -> list[np.ndarray]:
    """The columns of all places in the values of one range."""
    data = t.column("data")
    n = (pc.sum(pc.binary_length(data)).as_py() or 0) // _PLACE.itemsize
    out, done = [np.empty(n, _PLACE[f]) for f in _PLACE.names], 0
    for x in data:
        value, at = x.as_buffer(), 0
        k = value.size // _PLACE.itemsize
        for c in out:
            c[done : done + k] = np.frombuffer(value, c.dtype, k, at)
            at += k * c.itemsize
        done += k
    return out


def _firsts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.append(len(x) > 0, x[1:] != x[:-1])[: len(x)])


def _by_doc(doc: np.ndarray, **columns: np.ndarray) -> pa.Table:
    """One row for each document that has any: doc, and of each column its values as one value."""
    order = np.argsort(doc, kind="stable")
    doc = doc[order]
    at = _firsts(doc)
    ends = np.append(at, len(doc))
    packed = [pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((ends * c.itemsize).astype(np.int32)), pa.py_buffer(c[order])]) for c in columns.values()]
    return pa.table([pa.array(doc[at]), *packed], names=["doc", *columns])


def _flat(lists: pa.Array, values: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in the lists' packed values, and the row of each (null lists have none)."""
    _, ends, data = values.cast(pa.large_binary()).buffers()
    at = np.frombuffer(ends, np.int64)[values.offset :][lists.offsets.to_numpy()] if len(values) else np.zeros(len(lists) + 1, np.int64)
    size = np.dtype(dtype).itemsize
    out = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(dtype) if at[-1] > at[0] else np.zeros(0, dtype)
    return out, np.repeat(np.arange(len(lists)), np.diff(at) // size)


def _covered(at: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any of the spans [at, to)."""
    return np.cumsum(np.bincount(at, minlength=n + 1) - np.bincount(to, minlength=n + 1))[:n] > 0


def _may_hit(h: np.ndarray, block: np.ndarray) -> np.ndarray:
    """True wherever a block has the same hash, and at few others: a bit table with 16 cells or more a block, without sorting."""
    mask = np.uint64((16 << int(block.sum()).bit_length()) - 1)
    cells = np.zeros(int(mask) + 1, bool)
    cells[h[block] & mask] = True
    return cells[h & mask]


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document with any: doc (long), windows: packed hashes h and places pos of its windows that start earlier elsewhere."""
    block, n = window // 2, common.ranges(docs.sparkSession)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, "text"):
            h, starts = _hashed(_words(b.column(1)))
            if len(h) >= block:
                runs, text, pos = _runs(h, starts, block)
                yield _by_range(n, runs, _ids(b)[text], np.where(pos % block == 0, pos | _BLOCK, pos))

    def hits(key: tuple, t: pa.Table) -> pa.Table:
        h, doc, pos = _places(t)
        may = np.flatnonzero(_may_hit(h, (pos & _BLOCK) > 0))
        may = may[np.argsort(h[may])]
        h, doc, pos = h[may], doc[may], pos[may]
        first = _firsts(h)
        size = np.diff(np.append(first, len(h)))
        indexed = np.logical_or.reduceat((pos & _BLOCK) > 0, first) if len(first) else np.zeros(0, bool)
        hit = np.repeat(indexed & (size > 1), size)
        return _by_doc(doc[hit], data=pos[hit] & ~_BLOCK)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, "text"):
            h, starts = _hashed(_words(b.column(1)))
            if len(h) < window:
                continue
            p, k = _flat(b.column(2), b.column(2).values, "<u4")
            p = p + starts[k]
            whole = p + block <= starts[k + 1]
            p, k = p[whole], k[whole]
            # the windows that hold this run
            near = _covered(np.maximum(p - (window - block), starts[k]), p + 1, len(h))
            runs, text, pos = _runs(h, starts, window)
            keep = near[pos + starts[text]]
            runs, text, pos = runs[keep], text[keep], pos[keep]
            if len(runs):
                yield _by_range(n, runs, _ids(b)[text], pos)

    def later(key: tuple, t: pa.Table) -> pa.Table:
        h, doc, pos = _places(t)
        order = np.argsort(h)
        h, doc, pos = h[order], doc[order], pos[order]
        first = _firsts(h)
        size = np.diff(np.append(first, len(h)))
        # the earliest place of each sequence; repeated rows of a document are one document
        if len(h):
            away = doc != np.repeat(np.minimum.reduceat(doc, first), size)
            away |= pos != np.repeat(np.minimum.reduceat(np.where(away, _BLOCK, pos), first), size)
            h, doc, pos = h[away], doc[away], pos[away]
        return _by_doc(doc, h=h, pos=pos)

    docs = docs.select(F.col("doc_id").cast("long"), "text")
    found = docs.mapInArrow(probes, _KIND).groupBy("range").applyInArrow(hits, "doc long, data binary")
    found = common.as_table(found, "anchor-hits").groupBy("doc").agg(F.collect_list("data").alias("hits"))  # a document's own hits
    hit = docs.join(found, F.coalesce("doc_id", F.lit(_NO_ID)) == F.col("doc")).select("doc_id", "text", "hits")
    out = hit.mapInArrow(windows, _KIND).groupBy("range").applyInArrow(later, "doc long, h binary, pos binary")
    return common.as_table(out, "repeated-windows").groupBy("doc").agg(F.collect_list(F.struct("h", "pos")).alias("windows"))


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row's doc_id, n_words, n_removed, kept_text, spans (start and end word of each maximal repeat removed).

    Word order in the corpus: by doc_id (null last), then place. Null and empty texts have no words; texts shorter than
    a window keep all; repeated rows of one document are one document, and get one result each; an empty table gives an
    empty one; other columns are not read.
    """
    repeats = repeated_windows(docs, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, "text"):
            words, lists = _words(b.column(1)), b.column(2)
            own, _ = _flat(lists, lists.values.field(0), "<u8")
            p, k = _flat(lists, lists.values.field(1), "<u4")
            # only texts with repeated windows are hashed
            some = np.zeros(len(words), bool)
            some[k] = True
            h, starts = _hashed([w if x else [] for w, x in zip(words, some, strict=True)])
            runs = common.joined(h, window)
            p = p + starts[k]
            whole = p + window <= starts[k + 1]
            p, own = p[whole], own[whole]
            p = p[runs[p] == own]  # another row of the same id may have another text
            gone = _covered(p, p + window, len(h))
            texts, removed, spans = [], [], []
            for k, w in enumerate(words):
                g = gone[starts[k] : starts[k + 1]]
                change = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8))).tolist() if some[k] else []
                kept = zip([0, *change[1::2]], [*change[::2], len(w)], strict=True)
                texts.append(b" ".join(chain.from_iterable(w[x:y] for x, y in kept) if change else w))
                removed.append(sum(change[1::2]) - sum(change[::2]))
                spans.append(change)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.int64()))], names=["doc_id", "n_words", "n_removed", "kept_text", "spans"])

    docs = docs.select(F.col("doc_id").cast("long"), "text")
    out = docs.join(repeats, F.coalesce("doc_id", F.lit(_NO_ID)) == F.col("doc"), "left").select("doc_id", "text", "windows")
    return out.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string, spans array<long>")


def op3(docs: DataFrame) -> DataFrame:
    """The columns of the query."""
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))
