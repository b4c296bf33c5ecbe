"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated word-bigram models, one of toxic and one of ordinary training texts. Pairs back off to their class's
continuation counts of words, these to the class's stems (a word's first letters: forms of one expression), and stems to
one shared distribution over both classes; what discounts take is what the backoff gets, so each distribution sums to 1.
A text's evidence is the length-normalised log-likelihood ratio, as a whole, over its most toxic spans, and as the
share of words that speak for one class; a logistic calibration on a bounded fold that the counts have not seen turns it
into a score.

Counts come from all labelled rows outside the held-out and the calibration fold, so they grow with the input, and so does
the model: a written table of pairs, words and stems by the range of their keys. Texts are dealt into slices; what a slice
has of keys meets the table by range, and the counts found go back to the slice. Pairs are asked for by as many bits of
their hash as make a wrong answer a one in 2**20 event, so the keys widen with the model. Nothing of the model but
sums of its columns is broadcast or brought to the driver. Texts are scored in rounds, so shuffle files stay a share of the input.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.llm import common

#: Rows of the calibration fold that are used at most.
CALIBRATION_ROWS = 20_000
#: Discount of a count of 1, 2, ...; the last holds for all greater. What was seen once says next to nothing about its class.
DISCOUNTS = (0.98, 1.92, 2.8, 3.6, 4.4, 5.0, 5.5, 6.0)
#: Discount of the shared counts.
SHARED = 0.5
#: Letters of a word that its forms have in common.
STEM = 5
SPANS, SHARES, BEST = (1, 3, 6), (1.0, 2.0, 3.0), 5
N_FEATURES = 3 + len(SPANS) + len(SHARES)
#: Bytes of text in a slice; pairs and words repeat less between longer ones.
SLICE = 24_000_000
#: Pairs of the model in a range; texts' rounds.
RANGE_PAIRS, ROUNDS = 1 << 18, 4
_WORDS = re.compile(r"[^\W\d_]+")
_START = np.uint64(0x9E3779B97F4A7C15)


def _word_key(word: str) -> int:
    """40 bits of the stem's hash, 24 of the word's."""
    stem = xxhash.xxh3_64_intdigest(word[:STEM].encode("utf-8", "surrogatepass"))
    return (stem & ~((1 << 24) - 1)) | (xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) & ((1 << 24) - 1))


class Tokens:
    """Texts as numbers of their lower-cased words of letters."""

    def __init__(self) -> None:
        self.vocabulary, self.ids, self.n, self.size = common.Vocabulary(), [], [], 0

    def add(self, text: str | None) -> None:
        text = text or ""
        got = _WORDS.findall(text.lower())
        self.ids.append(np.fromiter(map(self.vocabulary.__getitem__, got), np.int32, len(got)))
        self.n.append(len(got))
        self.size += len(text)

    def keys(self) -> np.ndarray:
        return np.array([_word_key(w) for w in self.vocabulary], np.uint64)


def before(ids: np.ndarray, n: np.ndarray, start: int) -> np.ndarray:
    """The word before each; `start` at the start of a text."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    at = np.cumsum(n) - n
    out[at[n > 0]] = start
    return out


def pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return common.mixed(common.mixed(v) * np.uint64(0x9DDFEA08EB382D69) + w)


def _tokenised(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[tuple[Tokens, list[pa.RecordBatch]]]:
    """Slices of about `size` characters, with the rows that they hold."""
    t, rows = Tokens(), []
    for b in batches:
        start = 0
        for k, text in enumerate(b.column(column).to_pylist()):
            t.add(text)
            if t.size >= size:
                rows.append(b.slice(start, k + 1 - start))
                yield t, rows
                t, rows, start = Tokens(), [], k + 1
        if start < b.num_rows:
            rows.append(b.slice(start))
    if rows:
        yield t, rows


def counted(train: DataFrame, text: str) -> DataFrame:
    """Of rows (text, y), each pair (v, w) with the number of texts that have it, by class (n0, n1)."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, rows in _tokenised(batches, 0, SLICE):
            n, ids = np.array(t.n, np.int64), np.concatenate(t.ids).astype(np.int64)
            if not len(ids):
                continue
            h = np.append(t.keys(), _START)
            y = np.repeat(np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in rows]).astype(np.int64), n)
            code = before(ids, n, len(h) - 1) * len(h) + ids
            # a pair counts once in a text: what one text repeats says little about its class
            order = np.lexsort((code, np.repeat(np.arange(len(n)), n)))
            of = np.repeat(np.arange(len(n)), n)[order]
            once = order[np.append(True, (np.diff(of) != 0) | (np.diff(code[order]) != 0))]
            pair, back = np.unique(code[once], return_inverse=True)
            n0, n1 = (np.bincount(back, y[once] == c, len(pair)).astype(np.int64) for c in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(h[pair // len(h)].view(np.int64)), pa.array(h[pair % len(h)].view(np.int64)), pa.array(n0), pa.array(n1)], names=["v", "w", "n0", "n1"])

    own = common.as_table(train.select(text, "y"), "toxicity-training")
    found = own.mapInArrow(mapped, "v long, w long, n0 long, n1 long")
    pairs = common.as_table(found.groupBy("v", "w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "toxicity-pairs")
    common.drop(own)
    return pairs


def discount(n: Column) -> Column:
    out = F.lit(DISCOUNTS[-1])
    for k in range(len(DISCOUNTS) - 1, -1, -1):
        out = F.when(n == k, DISCOUNTS[k - 1] if k else 0.0).otherwise(out)
    return out


def _discounted(n: np.ndarray) -> np.ndarray:
    return np.append(0.0, DISCOUNTS)[np.minimum(n, len(DISCOUNTS))]


def probabilities(pairs: DataFrame) -> tuple[DataFrame, DataFrame, list[float], list[DataFrame]]:
    """words: word, p0, p1 (null if it only begins pairs), seen0, seen1, l0, l1 (how often it begins a pair, and the mass
    that goes to the backoff); stems: stem, q0, q1 (an unseen form's share of mass); an unseen stem's two; and the tables
    that these read."""
    stem = F.shiftrightunsigned("word", 24)
    ends = pairs.selectExpr("w AS word", "CAST(n0 > 0 AS LONG) AS s0", "CAST(n1 > 0 AS LONG) AS s1", "1L AS s", "0L AS seen0", "0L AS seen1", "0D AS l0", "0D AS l1")
    begins = pairs.select(F.col("v").alias("word"), *[F.lit(0).cast("long").alias(c) for c in ("s0", "s1", "s")], F.col("n0").alias("seen0"), F.col("n1").alias("seen1"), discount(F.col("n0")).alias("l0"), discount(F.col("n1")).alias("l1"))
    words = common.as_table(ends.unionAll(begins).groupBy("word").agg(*[F.sum(c).alias(c) for c in ends.columns[1:]]), "toxicity-words")
    stems = common.as_table(words.where("s > 0").groupBy(stem.alias("stem")).agg(*[F.sum(c).alias(f"x{c[1:]}") for c in ("s0", "s1", "s")], F.count("*").alias("forms")), "toxicity-stems")
    scratch = [words, stems]
    whole = words.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in ("s0", "s1", "s")], *[F.coalesce(F.sum(discount(F.col(c))), F.lit(0.0)) for c in ("s0", "s1")]).first()
    of_stems = stems.agg(*[F.coalesce(F.sum(discount(F.col(c))), F.lit(0.0)) for c in ("x0", "x1")], F.count("*")).first()
    total, all_, left, left_stems, n_stems = whole[:2], max(1, whole[2]), whole[3:5], of_stems[:2], of_stems[2]

    def part(amount: Column | float, c: int, none: float) -> Column | float:
        return amount / total[c] if total[c] else none

    shared = (F.col("x") - SHARED) / all_
    own = [part(F.col(f"x{c}") - discount(F.col(f"x{c}")), c, F.lit(0.0)) + part(left_stems[c], c, 1.0) * shared for c in (0, 1)]
    over = [part(left[c], c, 1.0) for c in (0, 1)]
    stems = stems.select("stem", "x", *[(over[c] * own[c]).alias(f"q{c}") for c in (0, 1)])
    words = words.withColumn("stem", stem).join(stems.withColumnRenamed("stem", "__x"), F.col("stem") == F.col("__x"), "left")
    form = (F.col("s") - SHARED) / F.col("x")
    p = [F.when(F.col("s") > 0, part(F.col(f"s{c}") - discount(F.col(f"s{c}")), c, F.lit(0.0)) + F.col(f"q{c}") * form).alias(f"p{c}") for c in (0, 1)]
    unseen = [over[c] * part(left_stems[c], c, 1.0) * SHARED * max(1, n_stems) / all_ for c in (0, 1)]
    return words.select("word", *p, "seen0", "seen1", "l0", "l1"), stems.select("stem", "q0", "q1"), unseen, scratch


#: Rows of the model that are packed at a time.
_PACKED = 1 << 20
_SENT = "range int, slice binary, data binary"
_PAIRS = "v long, w long, n0 long, n1 long"


def _ascending(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def _sent(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["range", "slice", "data"])


def _cuts(keys: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Where ascending keys of so many bits pass from one range (their highest bits) to the next."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(width - bits)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _together(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of batches, about `size` at a time."""
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def gather(train: DataFrame, text: str) -> dict:
    """The model from rows (text, y): its table by range of the keys, and what belongs to no key."""
    pairs = counted(train, text)
    n = pairs.count()
    bits = max(3, (-(-n // RANGE_PAIRS) - 1).bit_length())
    width = min(64, max(1, n).bit_length() + 20)
    words, stems, unseen, scratch = probabilities(pairs)

    def packed(of: Callable[[pa.Table], tuple[int, int, list[np.ndarray]]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _together(batches, _PACKED):
                kind, own, (keys, *values) = of(rows)
                order = np.argsort(keys)
                keys, values = keys[order], [x[order] for x in values]
                at = _cuts(keys, own, bits)
                yield _sent([(k, b"", bytes([kind]) + common.squeeze(_ascending(keys[i:j]), *[x[i:j] for x in values])) for k, (i, j) in enumerate(zip(at[:-1], at[1:], strict=True)) if i < j])

        return run

    def longs(b: pa.Table, k: int) -> np.ndarray:
        return b.column(k).to_numpy()

    def of_pairs(b: pa.Table) -> tuple[int, int, list[np.ndarray]]:
        keys = pair_keys(longs(b, 0).view(np.uint64), longs(b, 1).view(np.uint64)) >> np.uint64(64 - width)
        return 0, width, [keys, longs(b, 2).astype(np.uint32), longs(b, 3).astype(np.uint32)]

    def of_words(b: pa.Table) -> tuple[int, int, list[np.ndarray]]:
        p = [np.nan_to_num(longs(b, k).astype(np.float32)) for k in (1, 2)]
        return 1, 64, [longs(b, 0).view(np.uint64), *p, *(longs(b, k).astype(np.uint32) for k in (3, 4)), *(longs(b, k).astype(np.float32) for k in (5, 6))]

    def of_stems(b: pa.Table) -> tuple[int, int, list[np.ndarray]]:
        return 2, 40, [longs(b, 0).view(np.uint64), *(longs(b, k).astype(np.float32) for k in (1, 2))]

    parts = [x.mapInArrow(packed(f), _SENT) for x, f in ((pairs.select("v", "w", "n0", "n1"), of_pairs), (words, of_words), (stems, of_stems))]
    table = common.as_table(reduce(DataFrame.unionAll, parts), "toxicity-model")
    for t in (pairs, *scratch):
        common.drop(t)
    return {"table": table, "bits": bits, "width": width, "unseen": unseen}


class Asked:
    """What a slice asks for: its keys in ascending order by kind, and where each word finds the answers."""

    def __init__(self, h: np.ndarray, ids: np.ndarray, n: np.ndarray, width: int) -> None:
        h = np.append(h, _START)
        self.v, self.w = before(ids, n, len(h) - 1), ids
        keys, self.pair = np.unique(pair_keys(h[self.v], h[self.w]) >> np.uint64(64 - width), return_inverse=True)
        words, self.word = np.unique(h, return_inverse=True)
        stems, self.stem = np.unique(h >> np.uint64(24), return_inverse=True)
        self.keys, self.widths = [keys, words, stems], [width, 64, 40]


def ratios(asked: Asked, pairs: list[np.ndarray], words: list[np.ndarray], stems: list[np.ndarray], unseen: list[float]) -> np.ndarray:
    """Of every word, log P(word | before, toxic) - log P(word | before, ordinary); 0 of one whose stem neither class has seen."""
    logs = []
    known = ((words[0] + words[1])[asked.word] > 0) | ((stems[0] + stems[1])[asked.stem] > 0)
    for c in (0, 1):
        n = pairs[c][asked.pair].astype(np.int64)
        p, q = words[c].astype(float)[asked.word], stems[c].astype(float)[asked.stem]
        p = np.where(p > 0, p, np.where(q > 0, q, unseen[c]))[asked.w]
        seen, left = words[2 + c].astype(float)[asked.word][asked.v], words[4 + c].astype(float)[asked.word][asked.v]
        down = np.maximum(seen, 1)
        logs.append(np.log((n - _discounted(n)) / down + np.where(seen > 0, left / down, 1.0) * p))
    return np.where(known[asked.w], logs[1] - logs[0], 0.0)


def evidence(r: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of texts with n words each, whose ratios are r: means, greatest means over spans, mean of the best, shares; 0 without words."""
    out, at = np.zeros((len(n), N_FEATURES)), 0
    for i, k in enumerate(n):
        if k:
            own = r[at : at + k]
            s = np.append(0, np.cumsum(own))
            best = np.partition(own, k - min(BEST, k))[k - min(BEST, k) :]
            spans = [(s[min(m, k) :] - s[: -min(m, k)]).max() / min(m, k) for m in SPANS]
            out[i] = [s[-1] / k, np.clip(own, -3, 3).mean(), best.mean(), *spans, *((own > x).mean() for x in SHARES)]
        at += k
    return out


def with_evidence(docs: DataFrame, model: dict, text: str) -> DataFrame:
    """Distinct __h (md5 of a text) with __x, its evidence. Each round tokenises its texts once, into a table of what the slices
    ask for and what they keep, which goes when the round's evidence is written."""
    bits, width, unseen = model["bits"], model["width"], model["unseen"]

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, rows in _tokenised(batches, 1, SLICE):
            digests = [x for b in rows for x in b.column(0).to_pylist()]
            ids, n, h, name = np.concatenate(t.ids), np.array(t.n), t.keys(), uuid.uuid4().bytes
            got = Asked(h, ids, n, width)
            cuts = [_cuts(k, own, bits) for k, own in zip(got.keys, got.widths, strict=True)]
            yield _sent([(r, name, common.squeeze(*[_ascending(k[c[r] : c[r + 1]]) for k, c in zip(got.keys, cuts, strict=True)])) for r in range(1 << bits)])
            often = np.argsort(-np.bincount(ids, minlength=len(h)), kind="stable")
            rank = np.empty(len(often), np.uint32)
            rank[often] = np.arange(len(often), dtype=np.uint32)
            yield _sent([(-1, name, common.squeeze(h[often], rank[ids], n.astype(np.uint32), np.frombuffer(b"".join(digests), np.uint8)))])

    def answered(key: tuple, t: pa.Table) -> pa.Table:
        names, data = t.column("slice").to_pylist(), t.column("data")
        kinds: list[list] = [[], [], []]
        for i, x in enumerate(names):
            if not x:
                value = data[i].as_py()
                kinds[value[0]].append(common.expand(value[1:]))
        tables = []
        for k, types in enumerate(((np.uint32,) * 2, (np.float32, np.float32, np.uint32, np.uint32, np.float32, np.float32), (np.float32,) * 2)):
            keys = np.concatenate([np.zeros(0, np.uint64), *(np.cumsum(x[0]) for x in kinds[k])])
            order = np.argsort(keys, kind="stable")
            tables.append((keys[order], [np.concatenate([np.zeros(0, u), *(x[1 + j] for x in kinds[k])])[order] for j, u in enumerate(types)]))
        del kinds
        out = []
        for i, x in enumerate(names):
            if x:
                found = []
                for wanted, (keys, values) in zip(common.expand(data[i].as_py()), tables, strict=True):
                    wanted = np.cumsum(wanted, dtype=np.uint64)
                    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
                    hit = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
                    for v in values:
                        own = np.zeros(len(wanted), v.dtype)
                        own[hit] = v[at[hit]]
                        found.append(own)
                out.append((key[0].as_py(), x, common.squeeze(*found)))
        return pa.Table.from_batches([_sent(out)])

    def weighed(key: tuple, t: pa.Table) -> pa.Table:
        ranges, data = t.column("range").to_pylist(), t.column("data")
        if sorted(ranges) != list(range(-1, 1 << bits)):
            raise ValueError("a slice lacks answers")
        h, ids, n, digests = common.expand(data[ranges.index(-1)].as_py())
        answers = [common.expand(data[i].as_py()) for i in sorted(range(len(ranges)), key=lambda i: ranges[i]) if ranges[i] >= 0]
        found = [np.concatenate(x) for x in zip(*answers, strict=True)]
        n = n.astype(np.int64)
        if len(ids):
            got = Asked(h, ids.astype(np.int64), n, width)
            x = evidence(ratios(got, found[:2], found[2:8], found[8:], unseen), n)
        else:
            x = np.zeros((len(n), N_FEATURES))
        return pa.table([pa.array([digests[k : k + 16].tobytes() for k in range(0, len(digests), 16)], pa.binary()), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["__h", "__x"])

    texts = docs.where(F.col(text).isNotNull())
    out = []
    for k in range(ROUNDS):
        own = texts.where(F.pmod(F.xxhash64(text), F.lit(ROUNDS)) == k).select(_digest(text).alias("__h"), F.col(text).alias("text"))
        sent = common.as_table(own.mapInArrow(sliced, _SENT), "toxicity-slices")
        answers = sent.where("range >= 0").unionAll(model["table"]).groupBy("range").applyInArrow(answered, _SENT)
        found = answers.unionAll(sent.where("range < 0")).groupBy("slice").applyInArrow(weighed, "__h binary, __x array<double>")
        out.append(common.as_table(found.groupBy("__h").agg(F.first("__x").alias("__x")), "toxicity-evidence"))
        common.drop(sent)
    return reduce(DataFrame.unionAll, out)


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text") -> dict:
    """The model from docs (doc_id, text) and labels (doc_id, label). Without labels of both classes there is none, and all texts
    score the share of toxic ones, or 0."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    docs = docs.select("doc_id", text)
    model = gather(common.labelled(docs, labels, label, None, fold >= 2).where(F.col(text).isNotNull()), text)
    own = common.as_table(common.labelled(docs, labels, label, CALIBRATION_ROWS, fold == 1).where(F.col(text).isNotNull()).select(text, "y"), "toxicity-calibration")
    got = own.select("y", _digest(text).alias("__k")).join(with_evidence(own, model, text), F.col("__k") == F.col("__h")).select("y", "__x").toArrow()
    x, y = np.array(got.column("__x").to_pylist()).reshape(-1, N_FEATURES), np.array(got.column("y").to_pylist(), float)
    model["mean"], model["spread"] = (x.mean(0), x.std(0) + 1e-9) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    model["w"], model["b"] = common.logistic((x - model["mean"]) / model["spread"], y, None, 1e-4, 1500)
    if not len(y) or y.min() == y.max():
        model["b"] = 4.0 if len(y) and y[0] else -40.0
    return model


def score(docs: DataFrame, model: dict, text: str = "text", name: str = "score") -> DataFrame:
    """docs with a score from 0 to 1, higher where the text is likelier toxic. Labels are no part of it.

    Null, empty and wordless texts get the score of no evidence; repeated rows score alike; long texts are read whole; an
    empty table stays empty; a column of docs called as the score is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != name.lower()]
    found = with_evidence(docs, model, text)
    out = docs.withColumn("__k", _digest(text)).join(found, F.col("__k") == F.col("__h"), "left")
    z = F.lit(float(model["b"]))
    for k, (mean, spread, w) in enumerate(zip(model["mean"], model["spread"], model["w"], strict=True)):
        z = z + (F.coalesce(F.col("__x")[k], F.lit(0.0)) - float(mean)) / float(spread) * float(w)
    return out.select(*[F.col(f"`{c}`") for c in kept], (1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(40.0)), F.lit(-40.0))))).alias(name))


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of the query."""
    docs = docs.select("doc_id", "text")
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that are not toxic, with docs' own columns. Without labels of both classes all rows stay."""
    out = score(docs, fit(docs, labels), name="__score").where(F.col("__score") < threshold)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
