"""Best-fit packing by linear grouping.

Pieces are cut and counted by length (at most `size` counts reach the driver, at any scale). Large lengths are grouped
with equal cardinality and rounded up to their group's greatest; configurations of these few sizes that fill a sequence
best are found by dynamic programming and used as often as the groups allow; actual lengths take the places, longest
first; small lengths then go where they fit best. The plan is about classes of equal sequences, not about documents:
a piece finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh.llm import common

SIZE, END, GROUPS = 1024, 2, 256
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
_tokenizers: dict = {}
#: Characters that both libraries' patterns class alike, and the longest run of other than white space that the fast one merges.
_OTHER, RUN = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]"), 500


def _tokenizer(path: str) -> Callable[[str], list[int]]:
    """Ids as Tokenizer.encode(text, add_special_tokens=False) gives them. The same vocabulary as ranks gives the same ids several
    times faster; texts with characters that the libraries could class unlike, or with long runs, go to the tokenizer itself."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        plain = spec["pre_tokenizer"]
        if plain["type"] != "ByteLevel" or plain["add_prefix_space"] or not plain["use_regex"] or spec["normalizer"] or spec["model"].get("ignore_merges"):
            _tokenizers[path] = lambda text: slow.encode(text, add_special_tokens=False).ids
            return _tokenizers[path]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the rest by order from 256 on
        to_byte = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(sorted(set(range(256)) - set(shown)))}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> list[int]:
            words = text.split()
            alike = (text.isascii() or not _OTHER.search(text)) and len(text) - sum(map(len, words)) < len(words) + RUN
            if alike and max(map(len, words), default=0) <= RUN and not any(x in text for x in special):
                return fast.encode_ordinary(text)
            return slow.encode(text, add_special_tokens=False).ids

        _tokenizers[path] = encode
    return _tokenizers[path]


def cut(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first takes what is over."""
    first = n % size or size
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def _grouped(counts: dict[int, int], size: int, groups: int) -> list[list[list[int]]]:
    """Large lengths (over an eighth) by groups of equal cardinality, longest first: lists of [length, count]."""
    large = sorted(((k, n) for k, n in counts.items() if k > size // 8), reverse=True)
    each, out, room = max(1, -(-sum(n for _, n in large) // groups)), [], 0
    for k, n in large:
        while n:
            if not room:
                out.append([])
                room = each
            take = min(n, room)
            out[-1].append([k, take])
            n, room = n - take, room - take
    return out


def _best_configuration(sizes: list[int], left: list[int], size: int, first: int) -> list[int]:
    """How often each rounded size goes with `first` into one sequence, to fill it best."""
    best: dict[int, tuple[int, ...]] = {sizes[first]: (first,)}
    for g in range(first, len(sizes)):
        for total, used in sorted(best.items()):
            most = min((size - total) // sizes[g], left[g] - used.count(g))
            for c in range(1, most + 1):
                best.setdefault(total + c * sizes[g], used + (g,) * c)
    used = best[max(best)]
    return [used.count(g) for g in range(len(sizes))]


def plan(counts: dict[int, int], size: int = SIZE, groups: int = GROUPS) -> list[tuple[tuple[int, ...], int]]:
    """Classes of sequences: the lengths in one, and how many there are. Every length is used as often as it is counted."""
    bins: list[dict[tuple[int, ...], int]] = [defaultdict(int) for _ in range(size + 1)]  # by room left
    own = _grouped(counts, size, groups)
    sizes, left = [g[0][0] for g in own], [sum(n for _, n in g) for g in own]
    while any(left):
        first = next(k for k, n in enumerate(left) if n)
        use = _best_configuration(sizes, left, size, first)
        times = min(left[g] // u for g, u in enumerate(use) if u)
        while times:
            # as many sequences as have the same actual lengths
            run, lengths = times, []
            for g, u in enumerate(use):
                need, k = u, 0
                while need:
                    length, n = own[g][k]
                    same = min(need, n)
                    run = min(run, n // same if same == need else 1)
                    lengths += [length] * same
                    need, k = need - same, k + 1
            for g, u in enumerate(use):
                need = u * run
                while need:
                    got = min(need, own[g][0][1])
                    own[g][0][1] -= got
                    need -= got
                    if not own[g][0][1]:
                        own[g].pop(0)
                left[g] -= u * run
            bins[size - sum(lengths)][tuple(lengths)] += run
            times -= run
    for length, n in sorted(((k, n) for k, n in counts.items() if k <= size // 8), reverse=True):
        while n:
            room = next((r for r in range(length, size + 1) if bins[r]), None)
            if room is None:
                bins[size][()] += -(-n // (size // length))
                continue
            lengths, have = next(iter(bins[room].items()))
            fit = min(room // length, n)  # the tightest room stays the tightest while it holds another
            run = min(have, n // fit)
            if run == have:
                del bins[room][lengths]
            else:
                bins[room][lengths] -= run
            bins[room - fit * length][lengths + (length,) * fit] += run
            n -= fit * run
    return [(k, n) for b in bins for k, n in b.items() if k]


def _segments(classes: list[tuple[tuple[int, ...], int]], size: int) -> dict[int, np.ndarray]:
    """By length, rows (first rank, first sequence, copies in a sequence, offset of the first copy), by rank."""
    ranks: dict[int, int] = defaultdict(int)
    out, sequence = defaultdict(list), 0
    for lengths, n in classes:
        at = 0
        for k in sorted(set(lengths), reverse=True):
            c = lengths.count(k)
            out[k].append((ranks[k], sequence, c, at))
            ranks[k] += c * n
            at += c * k
        sequence += n
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, size: int = SIZE, ids: bool = True) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and its ids (ids=False: without).

    Null and empty texts are one piece of the end token. Repeated rows are documents of their own; an empty table gives
    an empty one; other columns are not read. vocabulary must be readable at every executor.
    """
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long" + ", ids array<int>" * ids

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, part, seen = _tokenizer(vocabulary), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for b in common.slices(batches, "text", 1_000_000):
            cols: list[list] = [[] for _ in range(8)]
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = np.array(t(text or "") + [END], "<u4")
                for k, (s, n) in enumerate(cut(len(own), size)):
                    piece = own[s : s + n]
                    for c, v in zip(cols, (i, k, s, n, zlib.crc32(piece.tobytes()), part, seen[n], piece.astype(np.int32) if ids else None), strict=True):
                        c.append(v)
                    seen[n] += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, types, strict=True)][: 7 + ids], names=names[: 7 + ids])

    pieces = common.as_table(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tokenized, kind), "pieces")
    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")  # a row a task, not a piece
    starts = common.as_table(per_part.withColumn("before", before), "piece-starts")
    counts = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    shipped = docs.sparkSession.sparkContext.broadcast(_segments(plan(counts, size), size))
    offsets = starts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("starts"))  # at most `size` entries
    offsets = offsets.select(F.col("part").alias("__part"), "starts")
    ranked = pieces.join(offsets, F.col("part") == F.col("__part")).withColumn("rank", F.col("local") + F.element_at("starts", F.col("length"))).drop("part", "__part", "starts", "local")
    out = [c for c in ranked.columns if c != "rank"]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(b.num_columns - 1).to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for k in np.unique(length):
                s, own = shipped.value[int(k)], np.flatnonzero(length == k)
                s = s[np.searchsorted(s[:, 0], rank[own], "right") - 1]
                at = rank[own] - s[:, 0]
                sequence[own], offset[own] = s[:, 1] + at // s[:, 2], s[:, 3] + at % s[:, 2] * k
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*out, "sequence_id", "offset"])

    return ranked.mapInArrow(placed, kind.replace(", part int, local long", "") + ", sequence_id long, offset long")


def op5(docs: DataFrame) -> DataFrame:
    """The columns of the query."""
    return pack(docs, ids=False)
