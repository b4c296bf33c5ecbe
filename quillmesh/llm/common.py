"""Shared plumbing of the training-data operators: tables in the cluster's shared folder, hashing, batch slicing."""

from __future__ import annotations

import os
import pickle
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where that is unset (tests)."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("a cluster must name a shared folder in spark.checkpoint.dir")
        found = f"file://{tempfile.mkdtemp(prefix='quillmesh-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def as_table(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: lineage ends here, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"quillmesh-{spark.sparkContext.applicationId}", f"{label}-{uuid.uuid4().hex[:12]}")
    # nothing reads the shuffle files of a write that has ended
    cleanup = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, cleanup)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession) -> None:
    """Deletes the tables written so far. Only for callers whose earlier results have been written elsewhere."""
    _delete(spark, _written.pop(spark.sparkContext.applicationId, []))


def drop(table: DataFrame) -> None:
    """Deletes a table of as_table that nothing will read again."""
    spark = table.sparkSession
    own = _written.get(spark.sparkContext.applicationId, [])
    gone = [p for p in own if any(p.rsplit("/", 1)[1] in f for f in table.inputFiles()[:1])]
    for p in gone:
        own.remove(p)
    _delete(spark, gone)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranges(spark: SparkSession) -> int:
    """Number of hash ranges (a power of two): grows with the cluster's partitions, so one range stays a bounded share."""
    return 1 << max(6, min(16, (2 * partitions(spark) - 1).bit_length()))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings and each one's offsets (n + 1) into them; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds about `size` bytes of `text`; a longer single text stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        start = 0
        while start < len(ends):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sized(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield batch.cast(schema) if batch.schema != schema else batch


class Hashes(dict):
    """64-bit hashes of words, remembered; bounded by count and by the length of what is remembered."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 32:
            if len(self) >= 100_000:
                self.clear()
            self[word] = h
        return h


class Vocabulary(dict):
    """Words by number, in order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def hashed(words: Iterable[str], n: int) -> np.ndarray:
    """64-bit hashes of n words, each distinct one hashed once."""
    vocabulary = Vocabulary()
    ids = np.fromiter(map(vocabulary.__getitem__, words), np.int64, n)
    return np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in vocabulary], np.uint64)[ids]


_packer, _unpacker = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, byte plane by byte plane; ascending whole numbers are best given as differences."""
    return _packer.compress(pickle.dumps([(a.dtype.str, len(a), np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()) for a in arrays]))


def expand(value: bytes) -> list[np.ndarray]:
    return [np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).reshape(-1).view(kind) if n else np.zeros(0, kind) for kind, n, data in pickle.loads(_unpacker.decompress(value))]


def pack(ranges: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """The rows (a structured array) as one binary value for each range that has any: (range, data)."""
    order = np.argsort(ranges, kind="stable")
    ranges, rows = ranges[order], rows[order]
    at = np.flatnonzero(np.append(len(ranges) > 0, ranges[1:] != ranges[:-1])[: len(ranges)])
    ends = np.append(at[1:], len(rows))[: len(at)]
    return pa.RecordBatch.from_arrays([pa.array((ranges[at] & 0x7FFFFFFF).astype(np.int32)), pa.array([b"".join(rows[f][a:b].tobytes() for f in rows.dtype.names) for a, b in zip(at, ends, strict=True)], pa.binary())], names=["range", "data"])


def unpacked(data: bytes, dtype: np.dtype) -> np.ndarray:
    """The rows of one value, which holds them column by column: so they compress."""
    out, at = np.zeros(len(data) // dtype.itemsize, dtype), 0
    for f in dtype.names:
        out[f] = np.frombuffer(data, dtype[f], len(out), at)
        at += len(out) * dtype[f].itemsize
    return out


def unpack(table: pa.Table, dtype: np.dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *(unpacked(x.as_py(), dtype) for x in table.column("data"))])


def joined(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of `length` hashes, by doubling."""
    done, out, width = 0, None, 1
    while length:
        if length & 1:
            out, done = (h.copy(), width) if out is None else (_pair(out[: max(0, len(h) - done)], h[done:]), done + width)
        if length := length >> 1:
            h = _pair(h[: max(0, len(h) - width)], h[width:])
            width *= 2
    return out


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = min(len(a), len(b))
    return mixed(a[:n] * np.uint64(0x9DDFEA08EB382D69) + b[:n])


def held_out(doc_id: Column) -> Column:
    """The fold that no training sees: crc32 of the id as text, divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, limit: int | None, among: Column) -> DataFrame:
    """Rows of docs with y (0 or 1), at most `limit` by a hash of the id. Null labels are none; a repeated id has its greatest."""
    y = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & among).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    y = y.withColumnRenamed("doc_id", "__id")
    if limit:
        y = F.broadcast(y.orderBy(F.xxhash64("__id"), "__id").limit(limit))
    return docs.join(y, F.col("doc_id") == F.col("__id")).drop("__id")


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1e-3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression, by Adam over all rows; zero if there is but one class."""
    w, b = np.zeros(x.shape[1]), 0.0
    if not len(y) or y.min() == y.max():
        return w, 0.0 if not len(y) else (4.0 if y[0] else -4.0)
    weight = np.ones(len(y)) if weight is None else weight
    weight = weight / weight.sum()
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        e = weight * (sigmoid(x @ w + b) - y)
        g = np.append(x.T @ e + l2 * w, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
