"""One issue's blocks as items: stories, intros, adverts, essays, teasers.

The scan over the blocks depends on their order and on what came before, so it is one Python stage over the array of
blocks; flags that need no order are native elsewhere (`functions.text`).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh.functions import rules
from quillmesh.sources import blocks as bl

_RE = {k: re.compile(getattr(rules, k)) for k in ("CALL", "TEASER_LINK", "READ_TIME", "CALL_HINT", "PAYWALL", "DROP_ITEM", "DATE_LINE", "BARE_SPONSOR", "SPONSOR_LABEL", "SPONSOR_BODY", "NOT_A_STORY", "READ_IN_APP", "PROMO_SUBJECT", "NUMBERED_ENTRY", "LABEL_ENTRY")}
ITEM = f"struct<position:int,section:string,title:string,body:string,url:string,kind:string,is_sponsor:int,word_count:int,links:array<{bl.LINK}>>"


def _has(rule: str, text: str | None) -> bool:
    return bool(_RE[rule].search(text or ""))


def _n(text: str | None) -> int:
    return len((text or "").split())


@dataclass
class Item:
    title: str | None = None
    section: str | None = None
    kind: str = "story"
    url: str | None = None
    links: list = field(default_factory=list)
    parts: list[dict] = field(default_factory=list)  # blocks of the body
    text: str | None = None  # a body that is not that of the blocks
    by_link: bool = False
    by_heading: bool = False
    sponsor: int = 0

    @property
    def body(self) -> str:
        return "\n\n".join(b["text"] for b in self.parts).strip() if self.text is None else self.text


def first_url(links: list[dict]) -> str | None:
    """The first source link, else the first tracked one."""
    return next((x["url"] for k in ("source", "tracked") for x in links if x["kind"] == k), None)


def _linked(b: dict) -> bool:
    return first_url(b["links"]) is not None


def is_title(b: dict | None) -> bool:
    if b is None or b["kind"] == "hr" or not 0 < _n(b["text"]) <= rules.TITLE_WORDS or _has("CALL", b["text"]) or _has("TEASER_LINK", b["text"]):
        return False
    end, heading, timed = b["text"].rstrip()[-1:], b["kind"] == "heading", _has("READ_TIME", b["text"])
    if not timed:
        if end in (".", "?", "!", ":") and not heading and not b["link_full"]:
            return False  # a sentence
        if end == "." and b["link_full"] and not b["bold_full"] and not heading:
            return False  # a linked sentence
    return heading or b["bold_full"] or b["link_full"] or b["lead_link_frac"] >= 0.6 or b["lead_bold_frac"] >= 0.85


def _button(b: dict) -> bool:
    return b["link_full"] and b["kind"] != "heading" and _n(b["text"]) <= 8 and not _has("READ_TIME", b["text"]) and _has("CALL_HINT", b["text"])


class _Scan:
    """Walks the blocks; holds the section, the advert slot and the item that is open."""

    def __init__(self) -> None:
        self.items: list[Item] = []
        self.section: str | None = None
        self.outer: str | None = None  # the section that an advert label interrupts
        self.slot_used = False
        self.open: Item | None = None

    def finish(self) -> None:
        if self.open and (self.open.title or self.open.body):
            self.items.append(self.open)
        self.open = None

    def begin(self, **what: object) -> None:
        self.finish()
        self.open = Item(section=self.section, **what)

    def label(self, text: str) -> None:
        self.finish()
        name = _RE["READ_TIME"].sub("", text).strip(" :–-")
        if _has("SPONSOR_LABEL", name):
            if not _has("SPONSOR_LABEL", self.section):
                self.outer = self.section
            self.slot_used = False
        self.section = name

    def title(self, b: dict, advert: bool) -> None:
        self.finish()
        if advert and self.slot_used:
            self.section = self.outer
        self.slot_used = self.slot_used or advert
        self.begin(title=b["text"], url=first_url(b["links"]), links=list(b["links"]), by_link=b["link_full"], by_heading=b["kind"] == "heading")

    def more(self, b: dict) -> None:
        if self.open is None:
            self.begin(kind="intro")
        self.open.parts.append(b)
        self.open.links += b["links"]
        self.open.url = self.open.url or first_url(b["links"])

    def step(self, b: dict, after: dict | None, later: dict | None) -> bool:
        """False where the issue ends."""
        short, text = _n(b["text"]) <= rules.TITLE_WORDS, b["text"]
        if short and _has("PAYWALL", text):
            return False
        if short and _has("DROP_ITEM", text):
            self.begin(title=text, kind="drop")
            return True
        dated = lambda x: x is not None and bool(_RE["DATE_LINE"].match(x["text"]))
        byline = dated(after) and _n(text) <= 5
        above_byline = after is not None and _n(after["text"]) <= 5 and dated(later)
        names_section = is_title(b) and not _linked(b) and _n(text) <= rules.SECTION_WORDS and is_title(after) and not above_byline
        if (names_section or _has("BARE_SPONSOR", text)) and not byline and len(re.sub("[^0-9A-Za-z]", "", text)) >= 3:
            self.label(text)
            return True
        advert = _has("SPONSOR_LABEL", self.section)
        never = byline or above_byline or _button(b) or text.lstrip().startswith("@")
        if advert and self.open:
            if self.open.title is None and _n(self.open.body) >= rules.AD_WORDS:
                self.slot_used = True  # an advert without a title was the slot
            never = never or self.slot_used and b["kind"] != "heading" and self.open.section == self.section
        if not never and is_title(b) and (_linked(b) or after is not None and not is_title(after)):
            self.title(b, advert)
        else:
            self.more(b)
        return True


def _stays(it: Item) -> bool:
    bare = it.kind == "story" and not it.body
    title = it.title or ""
    return not (
        it.kind == "drop"
        or _has("DROP_ITEM", it.title or it.body[:120])
        or not (it.body or it.url)
        or it.kind == "intro" and _n(it.body) < rules.INTRO_WORDS
        or bool(_RE["NOT_A_STORY"].match(title))
        or bare and _n(title) <= 3 and not _has("READ_TIME", title)
        or bare and title.rstrip().endswith(("…", "..."))
    )


def _calls(it: Item) -> bool:
    n = _n(it.title)
    return it.kind == "story" and it.by_link and not it.by_heading and _n(it.body) < 4 and n <= 14 and (n <= 6 or _has("CALL_HINT", it.title))


def _advert(it: Item) -> int:
    return int(_has("SPONSOR_LABEL", it.section) or _has("SPONSOR_LABEL", it.title) or _has("SPONSOR_BODY", it.body[:200]))


def entry(b: dict) -> tuple[str, str] | None:
    """Title and body of a block that is a numbered or pictured entry of a list."""
    if _n(b["text"]) < rules.ENTRY_WORDS:
        return None
    m = _RE["NUMBERED_ENTRY"].match(b["text"])
    if not m:
        m = _RE["LABEL_ENTRY"].match(b["text"])
        if not m or m["title"].strip().lower() in rules.NOT_A_LABEL or max(map(ord, m["pre"])) <= 0x2000:
            return None
    return (m["title"].strip(), m["body"].strip()) if _n(m["title"]) <= 20 else None


def _entries(it: Item) -> list[Item]:
    """The item, or the entries of the list that it is."""
    found = [(b, entry(b)) for b in it.parts]
    own = [b for b, e in found if e]
    size = lambda bs: sum(_n(b["text"]) for b in bs)
    if it.kind != "story" or it.sponsor or len(own) < 2 or size(own) < rules.ENTRIES_SHARE * max(1, size(it.parts)):
        return [it]
    rest = [b for b, e in found if not e]
    links = [x for b in rest for x in b["links"]]
    parent = [Item(it.title, it.section, url=first_url(links) or it.url, links=links, parts=rest)] if size(rest) >= rules.ENTRY_WORDS else []
    return parent + [Item(e[0], it.title or it.section, url=first_url(b["links"]), links=list(b["links"]), parts=[b], text=e[1]) for b, e in found if e]


def _refined(items: list[Item]) -> list[Item]:
    kept: list[Item] = []
    for it in filter(_stays, items):
        if kept and kept[-1].kind in ("story", "intro") and _calls(it):
            kept[-1].links += it.links
        else:
            kept.append(it)
    for it in kept:
        it.sponsor = _advert(it)
    kept = [x for it in kept for x in _entries(it)]
    captions = {id(a) for a, b in zip(kept, kept[1:], strict=False) if a.kind == "story" and a.title and not a.sponsor and b.section == a.title and _n(a.body) <= rules.CAPTION_WORDS}
    return [it for it in kept if id(it) not in captions]


def promo(subject: str | None, stories: int) -> int:
    return int(stories <= 2 and _has("PROMO_SUBJECT", subject))


def _post(items: list[Item], subject: str) -> list[Item]:
    """A web post: one essay of all that is no advert, under its headings."""
    own = [it for it in items if not it.sponsor]
    first = next((it.title for it in own if it.title), None)
    title = first if first and (not subject or subject.rstrip().endswith(("…", "..."))) else subject or first
    texts = [((f"## {it.title}\n\n" if it.title and it.title != title else "") + it.body).strip() for it in own]
    essay = Item(title, kind="essay", url=next((it.url for it in own if it.url), None), links=[x for it in own for x in it.links], text="\n\n".join(filter(None, texts)))
    return [essay, *(it for it in items if it.sponsor)]


def split(blocks: list[dict], subject: str | None) -> tuple[list[Item], str, int]:
    """Items, shape (roundup, essay, teaser or empty) and whether the issue is a promotion."""
    subject = subject or ""
    blocks = [b for b in blocks if b["kind"] != "hr" and re.search("[0-9A-Za-z]", b["text"])]
    if not blocks:
        return [], "empty", 0
    scan = _Scan()
    for b, after, later in zip(blocks, [*blocks[1:], None], [*blocks[2:], None, None][: len(blocks)], strict=True):
        if not scan.step(b, after, later):
            break
    scan.finish()
    items = _refined(scan.items)
    stories = [it for it in items if it.kind == "story"]
    links, size = [x for b in blocks for x in b["links"]], sum(_n(b["text"]) for b in blocks)
    teaser = next((x for x in links if _has("TEASER_LINK", x["text"])), None)
    if any(_has("READ_IN_APP", b["text"]) for b in blocks[:15]) and any(not it.sponsor for it in items):
        items, shape, n = _post(items, subject), "essay", 1
    elif teaser and size <= rules.TEASER_WORDS and len(stories) <= 2:
        text = "\n\n".join(b["text"] for b in blocks if not _has("TEASER_LINK", b["text"]) and not _has("CALL", b["text"]))
        items, shape, n = [Item(subject or None, kind="teaser", url=teaser["url"], links=links, text=text)], "teaser", 1
    elif len(stories) < 2 and size >= rules.ESSAY_WORDS:
        title = subject or (stories[0].title if stories else None)
        items, shape, n = [Item(title, kind="essay", url=first_url(links), links=links, text="\n\n".join(b["text"] for b in blocks))], "essay", 1
    else:
        shape, n = "roundup" if stories else "empty", len(stories)
    for it in items:
        it.sponsor, it.title = _advert(it), it.title.strip() if it.title else it.title
    return items, shape, promo(subject, n)


_LINKS = pa.list_(pa.struct([("text", pa.string()), ("url", pa.string()), ("kind", pa.string())]))
_ITEMS = pa.list_(pa.struct([("position", pa.int32()), ("section", pa.string()), ("title", pa.string()), ("body", pa.string()), ("url", pa.string()), ("kind", pa.string()), ("is_sponsor", pa.int32()), ("word_count", pa.int32()), ("links", _LINKS)]))


def with_items(rows: DataFrame, blocks: str = "blocks", subject: str = "subject") -> DataFrame:
    """rows without blocks, with items, split_shape and is_promo."""
    kept = [c for c in rows.columns if c not in (blocks, "items", "split_shape", "is_promo")]
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept), f"items array<{ITEM}>, split_shape string, is_promo int"])
    at, about, own = rows.columns.index(blocks), rows.columns.index(subject), [rows.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [split(x or [], s) for x, s in zip(b.column(at).to_pylist(), b.column(about).to_pylist(), strict=True)]
            items = [[{"position": k, "section": it.section, "title": it.title, "body": it.body, "url": it.url, "kind": it.kind, "is_sponsor": it.sponsor, "word_count": _n(f"{it.title or ''} {it.body}"), "links": it.links} for k, it in enumerate(i, 1)] for i, _, _ in found]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in own), pa.array(items, _ITEMS), pa.array([s for _, s, _ in found]), pa.array([p for _, _, p in found], pa.int32())], names=[*kept, "items", "split_shape", "is_promo"])

    return rows.mapInArrow(run, schema)


def item_rows(messages: DataFrame, key: str = "gmail_id") -> DataFrame:
    """A row an item, with a number of its own that the same message gives again."""
    number = F.xxhash64(key, "it.position").bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
    out = messages.select(*[c for c in messages.columns if c != "items"], F.explode("items").alias("it"))
    return out.select(number.alias("item_id"), *[c for c in messages.columns if c != "items"], "it.*")


def link_rows(items: DataFrame) -> DataFrame:
    """A row a link of an item: each address once, no mail addresses; those of adverts are marked."""
    out = items.select("item_id", "is_sponsor", F.posexplode("links").alias("at", "x")).where("x.kind <> 'mailto'")
    first = out.withColumn("_r", F.row_number().over(W.partitionBy("item_id", "x.url").orderBy("at"))).where("_r = 1")
    advert = (F.col("is_sponsor") == 1) & F.col("x.kind").isin("source", "tracked")
    domain = F.regexp_replace(F.lower(F.regexp_extract("x.url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")
    return first.select("item_id", F.col("x.url").alias("url"), F.col("x.text").alias("anchor_text"), domain.alias("domain"), F.when(advert, "sponsor").otherwise(F.col("x.kind")).alias("link_type"))


def counters(messages: DataFrame) -> DataFrame:
    """By shape: issues, items, adverts and promotions."""
    adverts = F.size(F.filter("items", lambda i: i["is_sponsor"] == 1))
    return messages.groupBy("split_shape").agg(F.count("*").alias("issues"), F.sum(F.size("items")).alias("items"), F.sum(adverts).alias("sponsors"), F.sum("is_promo").alias("promos"))
