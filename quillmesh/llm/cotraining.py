"""Quality classifier by co-training: a text view and a metadata view teach each other.

Both are logistic regressions. In each round each view labels the unlabelled rows it is surest of, in the proportion of
the classes, and hands them to the other. The calibrated views are then combined by a logistic regression on a fold of
labelled rows that neither was trained on.

All unlabelled rows take part: their features are written once, every fit sums gradients and curvature over them on the
executors (Newton's method), and what the views taught each other follows from the models of the rounds before. Only
labelled rows are bounded.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm import common, statistics

#: Labelled rows that training uses at most.
LABELLED_ROWS = 12_000
#: Newton steps of a fit, and the change of weights that ends it.
STEPS, ENOUGH = 8, 1e-2
#: Cells of the logits from -40 to 40, to find how many rows are surer than one.
CELLS = 1 << 16
ROUNDS, SHARE = 4, 0.1
SHAPES, META = 128, 64
_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")
_hash = common.Hashes()


def text_views(texts: list[str | None]) -> np.ndarray:
    """Statistics of each text and, hashed, the shares of its word shapes (letters as one a, digits as one 0)."""
    stats = len(statistics.FEATURES)
    out, vocabulary, ids = np.zeros((len(texts), stats + SHAPES)), common.Vocabulary(), []
    for k, t in enumerate(texts):
        words = statistics.words_of(t)
        out[k, :stats] = statistics.features(t, statistics.base(t, words), words)
        ids.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
    cell = np.array([_hash[_DIGITS.sub("0", _LETTERS.sub("a", w))] % SHAPES for w in vocabulary], np.int64)
    for k, x in enumerate(ids):
        if len(x):
            out[k, stats:] = np.bincount(cell[x], minlength=SHAPES) / len(x)
    return out


def meta_view(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Language and source, hashed, and the length that the table states, by size class."""
    out = np.zeros(META + 18)
    out[_hash[f"lang {lang}"] % META] += 1
    out[_hash[f"source {source}"] % META] += 1
    out[META] = np.log1p(max(0, n_chars or 0))
    out[META + 1 + min(16, max(0, n_chars or 0).bit_length())] = 1
    return out


def _views(b: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray]:
    text, lang, source, n = (b.column(at + k).to_pylist() for k in range(4))
    t = text_views(text)
    m = np.stack([meta_view(*x) for x in zip(lang, source, n, strict=True)])
    return t, m


def _scaled(v: np.ndarray, scale: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.clip((v - scale[0]) / scale[1], -8, 8)


def taught(x: list[np.ndarray], role: np.ndarray, cal: np.ndarray, rounds: list) -> list[np.ndarray]:
    """By view, the label each row trains it with (-1: none): its own, or what the other view's rounds gave it."""
    out = [np.where(cal | (role < 0), -1, role) for _ in x]
    for models in rounds:
        for k, (w, b, low, high) in enumerate(models):
            z, to = x[k] @ w + b, out[1 - k]
            free = (role == -1) & (to < 0)
            p = common.sigmoid(z)
            to[free & (_cell(z) <= low) & (p < 0.1)] = 0
            to[free & (_cell(z) >= high) & (p > 0.9)] = 1
    return out


def _cell(z: np.ndarray) -> np.ndarray:
    return ((np.clip(z, -40, 40) + 40) / 80 * (CELLS - 1)).astype(np.int64)


def _edges(cells: np.ndarray, share: float) -> tuple[int, int]:
    """Greatest cell of those that go low and least of those that go high, where `share` of the rows taught are high; ties go together."""
    n = int(cells.sum())
    up = int(SHARE * n * share)
    down = int(SHARE * n - SHARE * n * share)
    low = int(np.searchsorted(np.cumsum(cells), down)) if down else -1
    high = CELLS - 1 - int(np.searchsorted(np.cumsum(cells[::-1]), up)) if up else CELLS
    return low, high


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1)


def _sums(table: DataFrame, of: Callable[[list[np.ndarray], np.ndarray, np.ndarray], list[np.ndarray]]) -> list[np.ndarray] | None:
    """The sums over all batches of what `of` makes of (views, role, cal); partitions meet on the executors. None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                role, cal = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                got = of([_matrix(b.column(2)), _matrix(b.column(3))], role, cal.astype(bool))
                total = got if total is None else [x + y for x, y in zip(total, got, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 8], pa.int32()), pa.array([pickle.dumps(total)], pa.binary())], names=["at", "data"])

    def met(key: tuple, t: pa.Table) -> pa.Table:
        parts = [pickle.loads(x.as_py()) for x in t.column("data")]
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([pickle.dumps([sum(x) for x in zip(*parts, strict=True)])], pa.binary())], names=["at", "data"])

    kind = "at int, data binary"
    parts = [pickle.loads(r["data"]) for r in table.select("role", "cal", "t", "m").mapInArrow(run, kind).groupBy("at").applyInArrow(met, kind).collect()]
    return [sum(x) for x in zip(*parts, strict=True)] if parts else None


def _fitted(table: DataFrame, scale: list, rounds: list, start: list, l2: float = 1e-3) -> list[tuple[np.ndarray, float]]:
    """Weights and bias of both views by Newton's method, from `start`; a step that does not lessen the loss is halved."""
    at = [np.append(w, b) for w, b in start]
    best: list = [None, None]  # by view: weights, loss and step of the last point that lessened it
    ended = [False, False]
    for _ in range(STEPS):
        now = [None if e else w for e, w in zip(ended, at, strict=True)]

        def of(views: list[np.ndarray], role: np.ndarray, cal: np.ndarray, now: list = now) -> list[np.ndarray]:
            x = [_scaled(v, s) for v, s in zip(views, scale, strict=True)]
            out = []
            for v, t, w in zip(x, taught(x, role, cal, rounds), now, strict=True):
                own = t >= 0
                if w is None or not own.any():
                    d = v.shape[1] + 1
                    out += [np.zeros(3), np.zeros(d), np.zeros((d, d))]
                    continue
                z, y = np.column_stack([v[own], np.ones(own.sum())]), t[own]
                logit = z @ w
                p = common.sigmoid(logit)
                out += [np.array([len(y), y.sum(), (np.logaddexp(0, logit) - y * logit).sum()]), z.T @ (p - y), (z.T * (p * (1 - p))) @ z]
            return out

        got = _sums(table, of)
        for k in (0, 1):
            if ended[k]:
                continue
            (n, up, loss), grad, curve = got[3 * k : 3 * k + 3] if got else ((0, 0, 0), None, None)
            if up in (0, n):
                at[k], ended[k] = np.append(np.zeros(len(at[k]) - 1), 0.0 if not n else 4.0 if up else -4.0), True
                continue
            ridge = np.append(np.full(len(at[k]) - 1, l2), 0.0)
            loss = loss / n + (ridge * at[k] ** 2).sum() / 2
            if best[k] is not None and loss > best[k][1] + 1e-12:
                w, f, step = best[k]
                best[k] = (w, f, step / 2)
            else:
                step = -np.linalg.solve(curve / n + np.diag(ridge + 1e-9), grad / n + ridge * at[k])
                best[k] = (at[k], loss, step)
            w, _, step = best[k]
            at[k] = w + step
            ended[k] = np.abs(step).max() < ENOUGH
        if all(ended):
            break
    return [(w[:-1], float(w[-1])) for w in at]


def co_train(table: DataFrame) -> dict:
    """table: role (0, 1: label; -1: unlabelled; -2: takes no part), cal (kept for the combination), t and m (features by view)."""
    sizes = (len(statistics.FEATURES) + SHAPES, META + 18)
    table = table.where("role >= -1")

    def moments(views: list[np.ndarray], role: np.ndarray, cal: np.ndarray) -> list[np.ndarray]:
        v = [x.astype(float) for x in views]
        own = role[(role >= 0) & ~cal]
        return [np.array([len(role), (role == -1).sum(), len(own), own.sum()]), *(x.sum(0) for x in v), *((x**2).sum(0) for x in v)]

    (rows, pool, n, up), *m = _sums(table, moments) or [(0, 0, 0, 0), *(np.zeros(k) for k in sizes * 2)]
    scale = [(m[k] / max(1, rows), np.sqrt(np.maximum(m[2 + k] / max(1, rows) - (m[k] / max(1, rows)) ** 2, 0)) + (1e-6 if rows else 1)) for k in (0, 1)]
    rounds: list = []
    fitted = [(np.zeros(k), 0.0) for k in sizes]
    for r in range(ROUNDS + 1):
        fitted = _fitted(table, scale, rounds, fitted)
        if r == ROUNDS or not pool:
            break

        def sure(views: list[np.ndarray], role: np.ndarray, cal: np.ndarray, fitted: list = fitted) -> list[np.ndarray]:
            x = [_scaled(v, s) for v, s in zip(views, scale, strict=True)]
            to = taught(x, role, cal, rounds)
            return [np.bincount(_cell(x[k] @ w + b)[(role == -1) & (to[1 - k] < 0)], minlength=CELLS) for k, (w, b) in enumerate(fitted)]

        rounds = [*rounds, [(w, b, *_edges(cells, up / n if n else 0.5)) for (w, b), cells in zip(fitted, _sums(table, sure), strict=True)]]
    # the calibration fold is a part of the bounded labelled rows
    own = table.where("cal AND role >= 0").select("role", "t", "m").toArrow().combine_chunks()
    y = own.column("role").to_numpy().astype(float)
    zs = np.zeros((len(y), 2))
    if len(y):
        zs = np.stack([_scaled(_matrix(own.column(c).combine_chunks()), sc) @ w + b for c, sc, (w, b) in zip(("t", "m"), scale, fitted, strict=True)], 1)
    single = [common.logistic(zs[:, k : k + 1], y, l2=1e-4, steps=800) for k in (0, 1)]
    logits = np.stack([zs[:, k] * w[0] + b for k, (w, b) in enumerate(single)], 1)
    return {"scale": scale, "views": fitted, "single": single, "both": common.logistic(logits, y, l2=1e-4, steps=800), "rounds": rounds, "pool": int(pool)}


def predict(model: dict, views: list[np.ndarray]) -> np.ndarray:
    """Columns: score, text score, metadata score."""
    zs = [np.clip((v - m) / s, -8, 8) @ w + b for v, (m, s), (w, b) in zip(views, model["scale"], model["views"], strict=True)]
    logits = np.stack([z * w[0] + b for z, (w, b) in zip(zs, model["single"], strict=True)], 1)
    return common.sigmoid(np.column_stack([logits @ model["both"][0] + model["both"][1], logits]))


_META = ("text", "lang", "source", "n_chars")


def features(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = LABELLED_ROWS) -> DataFrame:
    """doc_id, role, cal, t and m of every row, written once. Labels of the held-out fold are not read, and its labelled rows
    take no part; fold 1 (crc32 of the id) calibrates. Null labels are none, and rows beyond `rows` count as unlabelled."""
    out = common.held_out(F.col("doc_id"))
    cal = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    y = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("__y"))
    used = y.where(~out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id", F.lit(True).alias("__used"))
    y = y.join(F.broadcast(used), "doc_id", "left")
    role = F.when(F.col("__used"), F.col("__y")).when(F.col("doc_id").isNull() | (out & F.col("__y").isNotNull()), -2).otherwise(-1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, "text"):
            views = [pa.array([x.tobytes() for x in v.astype(np.float32)], pa.binary()) for v in _views(b, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *views], names=["doc_id", "t", "m"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    viewed = docs.select("doc_id", *_META).mapInArrow(run, f"doc_id {kind}, t binary, m binary")
    # labels grow with the rows, so they are not broadcast; what moves to them is the features, never the texts
    given = viewed.join(y.hint("merge"), "doc_id", "left")
    return common.as_table(given.select("doc_id", role.alias("role"), (cal & F.coalesce("__used", F.lit(False))).alias("cal"), "t", "m"), "views")


def classify(table: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, text_score, meta_score (0 to 1, higher: better) and predicted of every row of features().

    Nulls in any column are values of their own; empty texts score by what they have; an empty table gives an empty
    one; other columns are not read.
    """
    shipped = table.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = predict(shipped.value, [_matrix(b.column(k)) for k in (1, 2)])
                yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, p.T.copy()), pa.array((p[:, 0] >= 0.5).astype(np.int32))], names=["doc_id", "score", "text_score", "meta_score", "predicted"])

    return table.select("doc_id", "t", "m").mapInArrow(run, f"doc_id {table.schema['doc_id'].dataType.simpleString()}, score double, text_score double, meta_score double, predicted int")


def op1(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of the query."""
    table = features(docs, labels)
    return classify(table, co_train(table))
