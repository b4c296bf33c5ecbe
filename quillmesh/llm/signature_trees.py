"""N-gram Jaccard join by signature trees.

Equal texts are one class. Of each class's shingles those that another class has, too, are kept with the number of
classes that have them; the rarest of them that a partner must share (the prefix) are its keys. The least class of a key
is its hub, and all classes that share a key with a hub meet in the hub's group: a pair of classes meets once for each
hub that they have in common, not once for each key.

A group builds a signature tree: leaves are classes with the bitmap of their shared shingles and their size, inner nodes
OR the bitmaps and span the sizes. A dual traversal, first of the hub against all, then of the tree against itself,
drops every pair of nodes whose greatest possible overlap falls short or whose classes already are one component; leaf
pairs left over are verified on the shingles, and those that link unite their components.

Large groups are split into blocks with a copy of the hub. Classes that linking within blocks leaves outside of their
hub's component then visit the other blocks; classes in that component never do, so a group of near copies is not
squared.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm import common, components

N, NUMERATOR, DENOMINATOR = 5, 75, 100
BITS, FANOUT, BLOCK = 1024, 8, 512
#: Shingles in a range of hashes, classes in a bucket, bytes of text in a slice.
RANGE, BUCKET, SLICE = 1 << 20, 1024, 8_000_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = {c: c + 32 for c in range(65, 91)}
_PART = "bucket int, data binary"


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_UPPER)


def shingled(texts: list[str | None], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of n words (all words, if fewer) of each text, ascending within it, and each one's text;
    A-Z count as a-z."""
    vocabulary, ids = common.Vocabulary(), []
    for t in texts:
        words = _WORD.findall(_lower(t or ""))
        ids.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
    count = np.array([len(x) for x in ids], np.int64)
    words = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in vocabulary], np.uint64)
    if not count.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = words[np.concatenate(ids)]
    starts = np.cumsum(count) - count
    of = np.repeat(np.arange(len(count)), count)
    runs = common.joined(h, n)
    whole = np.arange(len(runs)) + n <= (starts + count)[of[: len(runs)]]
    short = np.flatnonzero((count > 0) & (count < n))
    few = [common.joined(h[starts[k] : starts[k] + count[k]], int(count[k])) for k in short]
    h, of = np.concatenate([runs[whole], *few]), np.concatenate([of[: len(runs)][whole], short])
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.append(True, (h[1:] != h[:-1]) | (of[1:] != of[:-1]))
    return h[new], of[new]


def shingles(text: str | None, n: int = N) -> np.ndarray:
    return shingled([text], n)[0]


def _links(a: int, b: int, overlap: int) -> bool:
    return DENOMINATOR * overlap >= NUMERATOR * (a + b - overlap)


def _least_overlap(a, b):  # noqa: ANN001, ANN202
    return -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


class Tree:
    """Levels of nodes over classes in order of size; level 0 are the classes."""

    def __init__(self, bits: np.ndarray, size: np.ndarray, component: np.ndarray) -> None:
        self.levels = [(bits, size, size, component, component)]
        while len(self.levels[-1][0]) > 1:
            b, lo, hi, c0, c1 = self.levels[-1]
            at = np.arange(0, len(b), FANOUT)
            b = np.bitwise_or.reduceat(b, at, 0)
            self.levels.append((b, np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.minimum.reduceat(c0, at), np.maximum.reduceat(c1, at)))


def dual(x: Tree, y: Tree, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs whose overlap may suffice. A leaf's overlap with a node is at most its shared shingles that the node's
    bits allow: its size less the bits it has and the node has not."""
    depth = max(len(x.levels), len(y.levels)) - 1
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for level in range(depth, -1, -1):
        kx, ky = min(level, len(x.levels) - 1), min(level, len(y.levels) - 1)
        outs = [(a[:0], b[:0])]
        for s in range(0, len(a), 65536):
            i, j = a[s : s + 65536], b[s : s + 65536]
            (bx, lx, hx, cx0, cx1), (by, ly, hy, cy0, cy1) = x.levels[kx], y.levels[ky]
            ok = (hx[i] * DENOMINATOR >= NUMERATOR * ly[j]) & (hy[j] * DENOMINATOR >= NUMERATOR * lx[i])
            ok &= ~((cx0[i] == cx1[i]) & (cy0[j] == cy1[j]) & (cx0[i] == cy0[j]))
            if own:
                ok &= i < j if level == 0 else i <= j
            i, j = i[ok], j[ok]
            if kx == 0:
                most = hx[i] - np.bitwise_count(bx[i] & ~by[j]).sum(1)
                i, j = (z[most >= _least_overlap(lx[i], ly[j])] for z in (i, j))
            if ky == 0 and len(i):
                most = hy[j] - np.bitwise_count(by[j] & ~bx[i]).sum(1)
                i, j = (z[most >= _least_overlap(lx[i], ly[j])] for z in (i, j))
            outs.append((i, j))
        a, b = (np.concatenate(z) for z in zip(*outs, strict=True))
        if level:
            def below(t: Tree, at: np.ndarray, k: int, level: int = level) -> tuple[np.ndarray, np.ndarray]:
                if k < level:
                    return at[:, None], np.ones((len(at), 1), bool)
                c = at[:, None] * FANOUT + np.arange(FANOUT)
                return c, c < len(t.levels[k - 1][0])

            (ca, va), (cb, vb) = below(x, a, kx), below(y, b, ky)
            both = va[:, :, None] & vb[:, None, :]
            a, b = np.broadcast_to(ca[:, :, None], both.shape)[both], np.broadcast_to(cb[:, None, :], both.shape)[both]
    yield a, b


def _bitmap(h: np.ndarray) -> np.ndarray:
    place = np.zeros(BITS, np.uint8)
    place[(h % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(place).view(np.uint64)


class Group:
    """Classes with their sizes and shared shingles, and the components that links have made of them."""

    def __init__(self, ids: np.ndarray, size: np.ndarray, data: list[np.ndarray], component: np.ndarray) -> None:
        order = np.argsort(size, kind="stable")
        self.ids, self.size, self.data = ids[order], size[order], [data[k] for k in order]
        self.bits = np.array([_bitmap(x) for x in self.data]).reshape(len(order), -1)
        self.component, self.links = component[order].copy(), []

    def tree(self, own: np.ndarray) -> Tree:
        return Tree(self.bits[own], self.size[own], self.component[own])

    def join(self, x: np.ndarray, y: np.ndarray, own: bool = False) -> None:
        """Links between the classes x and y (places, ascending), or within x; a pair whose classes are one component is passed by."""
        if len(x) and len(y):
            trees = [self.tree(z) for z in ((x,) if own else (x, y))]
            for p, q in dual(trees[0], trees[-1], own):
                for a, b in zip(x[p], y[q], strict=True):
                    if self.component[a] != self.component[b] and _links(self.size[a], self.size[b], len(np.intersect1d(self.data[a], self.data[b], assume_unique=True))):
                        self.links.append((self.ids[a], self.ids[b]))
                        self.component[self.component == self.component[b]] = self.component[a]


_LINKS = "a long, b long"
_ROWS = ("id", "n", "data", "component", "role")


def _group(t: pa.Table) -> tuple[Group, np.ndarray]:
    ids, size, comp, role = (t.column(k).to_numpy() for k in ("id", "n", "component", "role"))
    first = np.unique(ids, return_index=True)[1]
    data = [common.expand(t.column("data")[int(k)].as_py())[0] for k in first]
    g = Group(ids[first], size[first], data, comp[first])
    return g, role[first][np.argsort(size[first], kind="stable")]


def _linked(g: Group) -> pa.Table:
    links = np.array(g.links, np.int64).reshape(-1, 2)
    return pa.table({"a": links.max(1) if len(links) else links[:, 0], "b": links.min(1) if len(links) else links[:, 0]})


def _within(t: pa.Table) -> pa.Table:
    """A block: the hub (role 0) against the classes, then these against each other."""
    g, role = _group(t)
    hub, rest = np.flatnonzero(role == 0), np.flatnonzero(role != 0)
    g.join(hub, rest)
    g.join(rest, rest, own=True)
    return _linked(g)


def _across(t: pa.Table) -> pa.Table:
    """Visitors from other blocks (role 0) against a block's own classes (role 1)."""
    g, role = _group(t)
    g.join(np.flatnonzero(role == 0), np.flatnonzero(role == 1))
    return _linked(g)


def class_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From distinct texts (class, text): every class with its number of shingles, and links that connect whatever links connect."""
    size = docs.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    n_ranges = 1 << max(3, (-(-int(size[1]) // (6 * RANGE)) - 1).bit_length())
    n_buckets = max(8, -(-int(size[0]) // BUCKET))
    top = np.uint64(64 - n_ranges.bit_length() + 1)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, "text", SLICE):
            ids = b.column(0).to_numpy()
            h, of = shingled(b.column(1).to_pylist())
            n = np.bincount(of, minlength=len(ids)).astype(np.uint32)
            at = np.argsort(h >> top, kind="stable")
            h, own = h[at], ids[of[at]]
            cuts = np.searchsorted(h >> top, np.arange(n_ranges + 1, dtype=np.uint64))
            where = ids.view(np.uint64) % np.uint64(n_ranges)
            rows = [(r, common.squeeze(h[i:j], own[i:j], ids[where == r], n[where == r])) for r, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()), pa.array([d for _, d in rows], pa.binary())], names=["range", "data"])

    def counted(key: tuple, t: pa.Table) -> pa.Table:
        parts = [common.expand(x.as_py()) for x in t.column("data")]
        h, ids, every, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.lexsort((ids, h))
        h, ids = h[order], ids[order]
        new = np.append(len(h) > 0, (h[1:] != h[:-1]) | (ids[1:] != ids[:-1]))[: len(h)]
        h, ids = h[new], ids[new]
        first = np.flatnonzero(np.append(len(h) > 0, h[1:] != h[:-1])[: len(h)])
        often = np.diff(np.append(first, len(h)))
        df = np.repeat(often, often)
        h, ids, df = h[df > 1], ids[df > 1], df[df > 1]
        every, at = np.unique(every, return_index=True)
        n = n[at]
        own, all_ = (x.view(np.uint64) % np.uint64(n_buckets) for x in (ids, every))
        out = []
        order = np.lexsort((ids, own))
        h, ids, df, own = h[order], ids[order], df[order], own[order]
        for k in np.union1d(own, all_):
            i, j = np.searchsorted(own, [k, k + np.uint64(1)])
            out.append((int(k), common.squeeze(h[i:j], ids[i:j], df[i:j].astype(np.uint32), every[all_ == k], n[all_ == k])))
        return pa.table([pa.array([x for x, _ in out], pa.int32()), pa.array([d for _, d in out], pa.binary())], names=["bucket", "data"])

    def merged(key: tuple, t: pa.Table) -> pa.Table:
        parts = [common.expand(x.as_py()) for x in t.column("data")]
        h, ids, df, every, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        every, at = np.unique(every, return_index=True)
        n = n[at].astype(np.int64)
        order = np.lexsort((h, df, ids))
        h, ids, df = h[order], ids[order], df[order]
        i, j = np.searchsorted(ids, every), np.searchsorted(ids, every, "right")
        data, keys = [], []
        for k, x, y in zip(n, i, j, strict=True):
            # a partner shares one of the first n - least overlap + 1 shingles; those nobody shares come first
            reach = k - -(-NUMERATOR * k // DENOMINATOR) + 1 - (k - (y - x))
            keys.append(h[x : x + max(0, reach)].view(np.int64).tolist() if k else [])
            data.append(common.squeeze(np.sort(h[x:y])) if keys[-1] else None)
        return pa.table([pa.array(every), pa.array(n), pa.array(data, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "data", "keys"])

    parts = docs.select("class", "text").mapInArrow(dealt, "range int, data binary").groupBy("range").applyInArrow(counted, _PART)
    shared = common.as_table(parts.groupBy("bucket").applyInArrow(merged, "id long, n long, data binary, keys array<long>"), "shared")
    keyed = shared.select(F.explode("keys").alias("key"), "id")
    least = keyed.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("c")).where("c > 1").select("key", "hub")
    met = common.as_table(keyed.join(least, "key").where("id <> hub").select("hub", "id").distinct(), "hub-members")
    blocks = common.as_table(met.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "hub-blocks")
    met = met.join(blocks, "hub").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    hubs = blocks.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("hub").alias("id"), F.lit(0).alias("role"))
    data = shared.where("data IS NOT NULL").select("id", "n", "data")

    def linked(rows: DataFrame, f: Callable[[pa.Table], pa.Table]) -> DataFrame:
        return rows.join(data, "id").groupBy("hub", "block").applyInArrow(lambda key, t: f(t), _LINKS)

    rows = met.select("hub", "block", "id", F.lit(1).alias("role")).unionAll(hubs).withColumn("component", F.col("id"))
    first = common.as_table(linked(rows, _within).distinct(), "block-links")
    found = components.components(first).select(F.col("id").alias("__id"), "component")
    # classes of split groups that are not in their hub's component visit all other blocks
    split = met.where("blocks > 1").select("hub", "blocks", "block", "id")
    split = split.join(found, F.col("id") == F.col("__id"), "left").select("hub", "blocks", "block", "id", F.coalesce("component", "id").alias("component"))
    split = split.join(found.select("__id", F.col("component").alias("__c")), F.col("hub") == F.col("__id"), "left")
    split = common.as_table(split.select("hub", "blocks", "block", "id", "component", (F.col("component") != F.coalesce("__c", "hub")).alias("out")), "split-groups")
    visits = split.where("out").select("hub", "id", "component", F.lit(0).alias("role"), F.explode(F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("block"))).alias("block"))
    stays = split.join(split.where("out").select("hub").distinct(), "hub", "left_semi").select("hub", "id", "component", F.lit(1).alias("role"), "block")
    second = common.as_table(linked(visits.unionByName(stays), _across).distinct(), "across-links")
    return shared.select(F.col("id").alias("class"), "n"), first.unionAll(second)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links; its own without any) of every row.

    Null, empty and wordless texts have empty sets and link with nothing. Repeated rows are equal texts; rows with one
    doc_id and different texts are documents of their own, linked only if their texts are. A row without doc_id belongs
    to its text's component, or to none (null). Texts of any length are read whole; ties of size or id change nothing; an
    empty table gives an empty one; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    members = docs.select("doc_id", F.conv(F.substring(F.md5(F.encode("text", "UTF-8")), 1, 15), 16, 10).cast("long").alias("class"))
    members = common.as_table(members, "members")
    classes = members.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("first"))
    texts = docs.withColumn("__class", F.conv(F.substring(F.md5(F.encode("text", "UTF-8")), 1, 15), 16, 10).cast("long"))
    # one row of each class: the one with its least id, or any without an id; a row twice counts once further on
    texts = texts.join(classes, (F.col("__class") == F.col("class")) & F.col("doc_id").eqNullSafe(F.col("first"))).select("class", "text")
    texts = common.as_table(texts, "texts")
    sizes, links = class_links(texts)
    common.drop(texts)
    found = common.as_table(components.components(links).select(F.col("id").alias("__id"), F.col("component").alias("__c")), "components")
    sizes = sizes.where("n > 0").join(found, F.col("class") == F.col("__id"), "left").select(F.col("class").alias("__class"), "n", F.coalesce("__c", "class").alias("label"))
    known = sizes.join(classes.withColumnRenamed("class", "__k"), F.col("__class") == F.col("__k")).select("__class", "n", "label", "first")
    known = common.as_table(known, "class-labels")
    names = known.groupBy(F.col("label").alias("__label")).agg(F.min("first").alias("__least"))
    known = known.join(names, F.col("label") == F.col("__label")).select("__class", "n", "__least")
    out = members.join(known, F.col("class") == F.col("__class"), "left")
    return out.select("doc_id", F.coalesce("n", F.lit(0)).alias("n_shingles"), F.coalesce("__least", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs but for near copies: of each component the least doc_id stays, once. Rows without words or without a
    doc_id stay; so do the columns, in their order."""
    found = common.as_table(near_duplicates(docs), "near-duplicates")
    keep = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("__keep")).agg(F.count("*").alias("__rows"))
    words = F.coalesce(F.regexp_like("text", F.lit(common.WORD)), F.lit(False))
    kept = common.as_table(docs.join(keep, F.col("doc_id") == F.col("__keep"), "left").where(F.col("__keep").isNotNull() | ~words | F.col("doc_id").isNull()).drop("__keep"), "kept")
    once = kept.where("__rows IS NULL OR __rows = 1").drop("__rows")
    return once.unionAll(kept.where("__rows > 1").drop("__rows").dropDuplicates(["doc_id", "text"]))
