"""Bodies of messages as blocks of text with their links: one Python stage for the markup, the rest native.

Markup is read into a tree first: void elements are empty, nothing closes by itself, an end tag closes its nearest open
element and is passed over if there is none. Elements that are hidden or hold no text are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions import rules, urls

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN, _BOLD, _ZERO = re.compile(rules.HIDDEN_STYLE), re.compile(rules.BOLD_STYLE), re.compile(rules.ZERO_WIDTH)
_URL = re.compile(r"https?://[^\s<>()\[\]]+")
LINK = "struct<text:string,url:string,kind:string>"
BLOCK = f"struct<kind:string,text:string,level:int,bold_full:boolean,link_full:boolean,links:array<{LINK}>,lead_link_frac:double,lead_bold_frac:double>"


@dataclass
class _Node:
    name: str
    attributes: dict = field(default_factory=dict)
    parent: _Node | None = None
    children: list = field(default_factory=list)

    def hidden(self) -> bool:
        a = self.attributes
        marked = " ".join((a.get("class") or "").split()).lower()
        return "hidden" in a or a.get("aria-hidden") == "true" or bool(_HIDDEN.search(a.get("style") or "")) or "preheader" in marked or "preview-text" in marked

    def texts(self) -> list[str]:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                todo.extend(reversed(x.children))
        return out


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("")
        self.body: _Node | None = None
        self.open: dict[str, int] = {}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = _Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        if tag == "body" and self.body is None:
            self.body = node
        if tag not in _VOID:
            self.at = node
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.open.get(tag):
            while True:
                done, self.at = self.at, self.at.parent
                self.open[done.name] -= 1
                if done.name == tag:
                    break

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def _parsed(page: str) -> _Node:
    tree = _Tree()
    tree.feed(page)
    tree.close()
    return tree.body or tree.root


def _share(runs: list[tuple[int, bool]]) -> float:
    """Share of the characters that stand before the first run that does not hold."""
    lead = 0
    for n, holds in runs:
        if not holds:
            break
        lead += n
    return lead / (sum(n for n, _ in runs) or 1)


class _Lines:
    """Runs of text as they come, closed into blocks."""

    def __init__(self) -> None:
        self.blocks: list[dict] = []
        self._begin()

    def _begin(self, kind: str = "text", level: int = 0) -> None:
        self.runs: list[tuple[str, bool, str | None]] = []
        self.hrefs: list[tuple[str, str]] = []
        self.kind, self.level = kind, level

    def close(self, kind: str = "text", level: int = 0) -> None:
        text = " ".join("".join(t for t, _, _ in self.runs).split())
        if text:
            seen = [(len("".join(t.split())), bold, href) for t, bold, href in self.runs]
            seen = [x for x in seen if x[0]]
            links: dict[str, dict] = {}
            for shown, href in self.hrefs:
                url = urls.canonical(href)
                if url and not url.lower().startswith(("javascript:", "#")):
                    links.setdefault(url, {"text": shown, "url": url, "kind": urls.kind(url)})
            first = seen[0][2]
            self.blocks.append({
                "kind": self.kind, "text": text, "level": self.level,
                "bold_full": all(b for _, b, _ in seen), "link_full": first is not None and all(h == first for _, _, h in seen), "links": list(links.values()),
                "lead_link_frac": _share([(n, h == first) for n, _, h in seen]) if first else 0.0, "lead_bold_frac": _share([(n, b) for n, b, _ in seen]),
            })
        self._begin(kind, level)


def html_blocks(page: str) -> list[dict]:
    """The blocks of a page, in order."""
    out = _Lines()
    todo: list = [(x, False, None) for x in reversed(_parsed(page).children)]
    while todo:
        x, bold, href = todo.pop()
        if x is None:
            out.close()
        elif isinstance(x, str):
            if t := _ZERO.sub("", x):
                out.runs.append((t, bold, href))
        elif x.name in rules.DROP_TAGS or x.name == "img" or x.hidden():
            continue
        elif x.name == "hr":
            out.close()
            out.blocks.append({"kind": "hr", "text": "---", "level": 0, "bold_full": False, "link_full": False, "links": [], "lead_link_frac": 0.0, "lead_bold_frac": 0.0})
        else:
            if x.name in rules.BLOCK_TAGS:
                heading = re.fullmatch("h([1-6])", x.name)
                out.close("heading" if heading else "li" if x.name == "li" else "text", int(heading[1]) if heading else 0)
                todo.append((None, False, None))
            if x.name == "a" and x.attributes.get("href"):
                href = x.attributes["href"]
                out.hrefs.append((" ".join(" ".join(t.strip() for t in x.texts() if t.strip()).split()), href))
            bold = bold or x.name in ("b", "strong") or bool(_BOLD.search(x.attributes.get("style") or ""))
            todo.extend((c, bold, href) for c in reversed(x.children))
    out.close()
    return out.blocks


def text_blocks(text: str) -> list[dict]:
    """Paragraphs of a plain body; short ones in capitals are headings."""
    out = []
    for part in re.split(r"\n\s*\n", text):
        flat = " ".join(_ZERO.sub("", part).split())
        if flat:
            found = [urls.canonical(u) for u in _URL.findall(flat)]
            shown = _URL.sub("", flat).strip(" -–|()[]<>") or flat
            n = len(shown.split())
            heading = n <= rules.SECTION_WORDS and shown.upper() == shown and any(map(str.isalpha, shown))
            out.append({
                "kind": "heading" if heading else "text", "text": shown, "level": 3 if heading else 0, "bold_full": False, "link_full": len(found) == 1 and n <= 20,
                "links": [{"text": "", "url": u, "kind": urls.kind(u)} for u in found], "lead_link_frac": 0.0, "lead_bold_frac": 0.0,
            })
    return out


def visible_text(html: str | None, text: str | None) -> str:
    """All readable text of a body, flat; for counts and snippets."""
    if not html:
        return " ".join((text or "").split())
    tree = _Tree()
    tree.feed(html)
    tree.close()
    out, todo = [], [tree.root]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x.strip())
        elif x.name not in ("script", "style", "head", "title", "meta"):
            todo.extend(reversed(x.children))
    return " ".join(" ".join(t for t in out if t).split())


def with_blocks(rows: DataFrame, html: str = "html", text: str = "text", name: str = "blocks") -> DataFrame:
    """rows with their body's blocks: of the markup if there is any, else of the plain text; none of neither."""
    kept = [c for c in rows.columns if c != name]
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept), f"{name} array<{BLOCK}>"])
    kind = pa.list_(pa.struct([
        ("kind", pa.string()), ("text", pa.string()), ("level", pa.int32()), ("bold_full", pa.bool_()), ("link_full", pa.bool_()),
        ("links", pa.list_(pa.struct([("text", pa.string()), ("url", pa.string()), ("kind", pa.string())]))), ("lead_link_frac", pa.float64()), ("lead_bold_frac", pa.float64()),
    ]))
    at, plain = (rows.columns.index(c) if c in rows.columns else -1 for c in (html, text))
    own = [rows.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            none = [None] * b.num_rows
            found = [html_blocks(h) if h else text_blocks(t or "") for h, t in zip(b.column(at).to_pylist() if at >= 0 else none, b.column(plain).to_pylist() if plain >= 0 else none, strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in own), pa.array(found, kind)], names=[*kept, name])

    return rows.mapInArrow(run, schema)


def words_of(block: Column) -> Column:
    return F.size(F.filter(F.split(block["text"], " "), lambda w: w != ""))


def without_boilerplate(blocks: Column) -> Column:
    """Without boilerplate, and cut at the first footer line in the last two fifths."""
    own = F.filter(blocks, lambda b: ~b["text"].rlike(rules.BOILERPLATE))
    least = F.floor(F.size(own) * rules.FOOTER_ZONE).cast("int")
    marks = F.transform(own, lambda b, i: F.when((i >= least) & (words_of(b) <= rules.FOOTER_WORDS) & b["text"].rlike(rules.FOOTER), i))
    return F.slice(own, F.lit(1), F.coalesce(F.array_min(F.filter(marks, lambda m: m.isNotNull())), F.size(own)))


def markdown(blocks: Column) -> Column:
    """The blocks as Markdown, with up to five source links after a block that is no link itself."""

    def line(b: Column) -> Column:
        t = F.when(b["link_full"] & (F.size(b["links"]) > 0), F.concat(F.lit("["), b["text"], F.lit("]("), F.get(b["links"], F.lit(0))["url"], F.lit(")"))).otherwise(b["text"])
        marked = F.when(b["kind"] == "hr", "---").when(b["kind"] == "heading", F.concat(F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(b["level"], F.lit(6)))), F.lit(" "), t))
        marked = marked.when(b["kind"] == "li", F.concat(F.lit("- "), t)).when(b["bold_full"], F.concat(F.lit("**"), t, F.lit("**"))).otherwise(t)
        more = F.slice(F.filter(b["links"], lambda x: x["kind"] == "source"), 1, 5)
        more = F.when(b["link_full"] | (b["kind"] == "hr"), F.array().cast("array<string>")).otherwise(F.transform(more, lambda x: F.concat(F.lit("  <"), x["url"], F.lit(">"))))
        return F.concat(F.array(marked), more)

    return F.concat(F.array_join(F.flatten(F.transform(blocks, line)), "\n\n"), F.lit("\n"))


def has_link(b: Column) -> Column:
    return F.exists(b["links"], lambda x: x["kind"].isin("source", "tracked"))


def title_like(b: Column) -> Column:
    """Whether a block reads as a title, as a native condition."""
    text, n = b["text"], words_of(b)
    read = text.rlike(rules.READ_TIME)
    sentence = text.rlike(r"[.?!:]\s*$") & ~((b["kind"] == "heading") | b["link_full"]) & ~read
    card = b["link_full"] & ~b["bold_full"] & (b["kind"] != "heading") & text.rlike(r"\.\s*$") & ~read
    shaped = (b["kind"] == "heading") | b["bold_full"] | b["link_full"] | (b["lead_link_frac"] >= 0.6) | (b["lead_bold_frac"] >= 0.85)
    return (b["kind"] != "hr") & (n > 0) & (n <= rules.TITLE_WORDS) & ~text.rlike(rules.CALL) & ~text.rlike(rules.TEASER_LINK) & ~sentence & ~card & shaped


def section_label(b: Column, following: Column) -> Column:
    """Whether a block names a section: a short title without a link before another title."""
    return title_like(b) & ~has_link(b) & (words_of(b) <= rules.SECTION_WORDS) & F.coalesce(title_like(following), F.lit(False))
