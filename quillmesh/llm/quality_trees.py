"""Quality rules: gradient-boosted trees over document statistics.

Trees are grown by histogram on a bounded sample of labelled rows, with monotonic constraints (a split on a constrained
feature must order its children, and bounds pass down so that the whole tree keeps the order), and flattened into numpy
node arrays that score a batch level by level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm import common, statistics

#: Labelled rows that training uses at most.
TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST, L2 = 60, 4, 0.2, 64, 20, 1.0


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: list[int]) -> dict:
    """Node arrays: feature (-1: leaf), threshold (left if below or equal), left child (right follows), value; tree starts."""
    start = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
    model = {"bias": float(np.log(start / (1 - start))), "feature": [], "threshold": [], "left": [], "value": [], "roots": []}
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1) if len(x) else x.astype(int)
    z = np.full(len(y), model["bias"])

    def node() -> int:
        for k, v in (("feature", -1), ("threshold", 0.0), ("left", 0), ("value", 0.0)):
            model[k].append(v)
        return len(model["feature"]) - 1

    def grow(k: int, rows: np.ndarray, low: float, high: float, depth: int) -> None:
        gs, hs = g[rows].sum(), h[rows].sum()
        model["value"][k] = float(np.clip(-gs / (hs + L2), low, high)) * RATE
        best = (1e-6, None)
        if depth < DEPTH and len(rows) >= 2 * LEAST:
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                n, gl, hl = (np.cumsum(np.bincount(binned[rows, j], w, len(c) + 1))[:-1] for w in (None, g[rows], h[rows]))
                lv, rv = np.clip(-gl / (hl + L2), low, high), np.clip(-(gs - gl) / (hs - hl + L2), low, high)
                gain = gl**2 / (hl + L2) + (gs - gl) ** 2 / (hs - hl + L2) - gs**2 / (hs + L2)
                gain[(n < LEAST) | (len(rows) - n < LEAST) | (monotone[j] * (rv - lv) < 0)] = 0
                if len(gain) and gain.max() > best[0]:
                    i = int(gain.argmax())
                    best = (gain[i], (j, i, lv[i], rv[i]))
        if best[1] is None:
            z[rows] += model["value"][k]
            return
        j, i, lv, rv = best[1]
        a, _ = node(), node()
        model["feature"][k], model["threshold"][k], model["left"][k] = j, float(cuts[j][i]), a
        goes, mid = binned[rows, j] <= i, (lv + rv) / 2
        grow(a, rows[goes], max(low, mid) if monotone[j] < 0 else low, min(high, mid) if monotone[j] > 0 else high, depth + 1)
        grow(a + 1, rows[~goes], max(low, mid) if monotone[j] > 0 else low, min(high, mid) if monotone[j] < 0 else high, depth + 1)

    for _ in range(TREES if len(y) and y.min() != y.max() else 0):
        p = common.sigmoid(z)
        g, h = p - y, p * (1 - p)
        model["roots"].append(root := node())
        grow(root, np.arange(len(y)), -np.inf, np.inf, 0)
    return {k: np.array(v) if isinstance(v, list) else v for k, v in model.items()}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Probabilities, all rows and trees at once, level by level."""
    if not len(model["roots"]) or not len(x):
        return np.full(len(x), common.sigmoid(np.float64(model["bias"])))
    at = np.broadcast_to(model["roots"], (len(x), len(model["roots"]))).copy()
    for _ in range(DEPTH):
        f = model["feature"][at]
        right = np.take_along_axis(x, np.maximum(f, 0), 1) > model["threshold"][at]
        at = np.where(f >= 0, model["left"][at] + right, at)
    return common.sigmoid(model["bias"] + model["value"][at].sum(1))


def _measured(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    b, x = [], []
    for t in texts:
        words = statistics.words_of(t)
        b.append(statistics.base(t, words))
        x.append(statistics.features(t, b[-1], words))
    return np.array(b, np.int64).reshape(-1, 5), np.array(x, float).reshape(-1, len(statistics.FEATURES))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> dict:
    """The trees, from at most `rows` labelled rows outside the held-out fold. Without labels, everything passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(1).cast(pa.int32()), pa.array(_measured(b.column(0).to_pylist())[1].tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    got = common.labelled(docs.select("doc_id", "text"), labels, label, rows, ~common.held_out(F.col("doc_id"))).select("text", "y").mapInArrow(run, "y int, x array<double>").toArrow()
    x = np.array(got.column("x").to_pylist()).reshape(-1, len(statistics.FEATURES))
    return fit_trees(x, np.array(got.column("y").to_pylist(), float), list(statistics.FEATURES.values()))


def judge(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """docs without text, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, quality, kept.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged alike; an empty table stays
    empty; columns of docs called as a new one are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    own = [c for c in docs.columns if c.lower() not in {*names, "base_failed", "quality", "kept", "text"}]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own), *(f"{n} long" for n in names), "base_failed boolean, quality double, kept boolean"])
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # at most 60 trees of 31 nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, "text"):
            base, x = _measured(b.column(len(own)).to_pylist())
            failed, p = (base[:, 0] < 20) | (100 * base[:, 4] > 30 * base[:, 0]), predict(shipped.value, x)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(own)], *map(pa.array, base.T.copy()), pa.array(failed), pa.array(p), pa.array(~failed & (p >= threshold))], names=[*own, *names, "base_failed", "quality", "kept"])

    return docs.select(*[F.col(f"`{c}`") for c in own], "text").mapInArrow(run, schema)


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of the query."""
    return judge(docs.select("doc_id", "text"), fit(docs, labels))
