"""Line dedup by winnowing.

Lines (white space at the ends cut, blank ones aside) are hashed. Every pair of neighbouring lines is a fingerprint (a
winnowing window of one pair), so any run of two lines has one, the same in every copy; a line of `LONG` words is a
fingerprint by itself. Positions of equal fingerprints meet by hash range; each later one is laid beside the earliest,
the match is extended both ways, and the later run goes. A fingerprint that a third of the documents have brings one
comparison a document, never pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm import common

LONG = 20
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_PLACE = np.dtype([("h", "<u8"), ("doc", "<i8"), ("line", "<u4")])
_MATCH = np.dtype([("line", "<u4"), ("first", "<i8"), ("at", "<u4")])


def lines_of(text: str | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All lines, the places of those with a word, and their hashes."""
    lines = (text or "").split("\n")
    at = [k for k, x in enumerate(lines) if _WORD.search(x)]
    return lines, np.array(at, np.int64), np.array([xxhash.xxh3_64_intdigest(lines[k].strip(" \t\r\v\f").encode("utf-8", "surrogatepass")) for k in at], np.uint64)


def fingerprints(lines: list[str], at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places (among lines with a word) of the fingerprints."""
    pairs = common.joined(h, 2) if len(h) > 1 else np.zeros(0, np.uint64)
    long = np.array([k for k, x in enumerate(at) if len(_WORD.findall(lines[x])) >= LONG], np.int64)
    return np.concatenate([pairs, common.mixed(h[long] + np.uint64(1))]), np.concatenate([np.arange(len(pairs)), long])


def dedup(docs: DataFrame) -> DataFrame:
    """Every row of docs with its columns, text without the later runs, n_lines and n_removed.

    The order of the corpus is doc_id, then line. Null text stays null with no lines; a null doc_id keeps its text, and
    so does a blank one; repeated rows are one document and are treated alike; an empty table gives an empty one;
    columns called n_lines and n_removed are replaced.
    """
    n = common.ranges(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_removed")])
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc"), "text")

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, "text"):
            parts = [np.zeros(0, _PLACE)]
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h, at = fingerprints(*lines_of(t))
                rows = np.zeros(len(h), _PLACE)
                rows["h"], rows["doc"], rows["line"] = h, i, at
                parts.append(rows)
            rows = np.concatenate(parts)
            if len(rows):
                yield common.pack((rows["h"] >> np.uint64(44)).astype(np.int64) % n, rows)

    def met(key: tuple, t: pa.Table) -> pa.Table:
        rows = common.unpack(t, _PLACE)
        rows = rows[np.lexsort((rows["line"], rows["doc"], rows["h"]))]
        new = np.append(len(rows) > 0, rows["h"][1:] != rows["h"][:-1])[: len(rows)]
        first = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0)) if len(rows) else np.zeros(0, int)
        later = (rows["doc"] != rows["doc"][first]) | (rows["line"] != rows["line"][first])
        return pa.table({"doc": rows["doc"][later], "line": rows["line"][later].astype(np.int64), "first": rows["doc"][first][later], "at": rows["line"][first][later].astype(np.int64)})

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([lines_of(t)[2].tobytes() for t in b.column(1).to_pylist()], pa.binary())], names=["doc", "lines"])

    places = texts.mapInArrow(printed, "range int, data binary").groupBy("range").applyInArrow(met, "doc long, line long, first long, at long")
    places = common.as_table(places.distinct(), "line-matches")
    lines = common.as_table(texts.mapInArrow(hashed, "doc long, lines binary").groupBy("doc").agg(F.min("lines").alias("lines")), "line-hashes")
    matches = places.groupBy("doc", "first").agg(F.collect_list(F.struct("line", "at")).alias("m"))  # of one document's own lines
    sides = matches.join(lines, "doc").join(lines.select(F.col("doc").alias("first"), F.col("lines").alias("source")), "first").select("doc", "first", "m", "lines", "source")

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gone = []
            for d, f, m, x, y in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                out = np.zeros(len(x), bool)
                done: dict[int, int] = {}  # by alignment, the line up to which its matches are extended
                for i, j in sorted((k["line"], k["at"]) for k in m):
                    if i >= len(x) or j >= len(y) or x[i] != y[j] or i < done.get(i - j, 0):
                        continue
                    lo = hi = 0
                    while i - lo > 0 and j - lo > 0 and x[i - lo - 1] == y[j - lo - 1]:
                        lo += 1
                    while i + hi + 1 < len(x) and j + hi + 1 < len(y) and x[i + hi + 1] == y[j + hi + 1]:
                        hi += 1
                    out[i - lo : i + hi + 1] = True
                    done[i - j] = i + hi + 1
                gone.append(np.flatnonzero(out).tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(gone, pa.list_(pa.int64()))], names=["doc", "gone"])

    gone = sides.mapInArrow(extended, "doc long, gone array<long>").groupBy(F.col("doc").alias("__doc")).agg(F.flatten(F.collect_list("gone")).alias("__gone"))
    kept = [c for c in docs.columns if c != "text"]
    joined = docs.join(gone, F.col("doc_id") == F.col("__doc"), "left").select(*[F.col(f"`{c}`") for c in kept], "text", "__gone")
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), "text string, n_lines long, n_removed long"])

    def cleared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, "text"):
            texts, counts, removed = [], [], []
            for t, g in zip(b.column(len(kept)).to_pylist(), b.column(len(kept) + 1).to_pylist(), strict=True):
                lines, at, _ = lines_of(t)
                drop = {int(at[k]) for k in g or () if k < len(at)}
                texts.append(None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in drop) if drop else t)
                counts.append(len(at))
                removed.append(len(drop))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], names=[*kept, "text", "n_lines", "n_removed"])

    return joined.mapInArrow(cleared, schema).select(*[F.col(f"`{c}`") for c in docs.columns], "n_lines", "n_removed")


def op7(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left."""
    return dedup(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")
