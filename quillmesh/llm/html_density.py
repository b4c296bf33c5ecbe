"""HTML extraction by line-block distribution.

Markup is stripped to lines (one per block element), each with its length of text outside links. Sums over sliding
windows of lines form the distribution; a surge is where the sum leaves zero and a dive where it falls back. Of every page
all stretches between a surge and its dive are kept whose mass reaches `THRESHOLD`, or is the greatest of the page where
none does. Elements that never hold article text (menus, footers, forms, adverts, comments ...) are cut out beforehand and
leave no trace; if the page has `article` or `main` with text, lines outside weigh nothing, and the sum dives at the edges.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quillmesh.llm import common

WINDOW = 3
#: Characters outside links that make a stretch main text by itself.
THRESHOLD = 86
_NAME, _STOP = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"), re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
# HTML element names by what they do here.
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video xmp noembed noframes".split())
CUT = frozenset("nav footer aside form menu dialog button select option datalist head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot th thead tr ul".split())
# Words of class, id and role that mark what is no article text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo cookie cookies disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion recommended related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget complementary alertdialog".split()
)
_OUTSIDE = frozenset(["header"])


def _marked(attributes: str, inside: bool) -> bool:
    if "=" not in attributes:
        return False
    words = {w for _, v in _ATTRIBUTE.findall(attributes) for w in re.split(r"[^a-z0-9]+", v.lower())}
    return bool(words & MARKS) or not inside and bool(words & _OUTSIDE)


def _tags(page: str) -> list[tuple[bool, str, str, int, int]]:
    """All tags, comments and raw elements (nameless), as (is end tag, name, attributes, start, end), in one pass: a quote that
    nothing closes is a character like others, and what nothing ends is searched for once."""
    out, at, last = [], 0, {c: page.rfind(c) for c in "\"'>"}
    endless: set[str] = set()
    while (start := page.find("<", at)) >= 0:
        if page.startswith(("<!", "<?"), start):
            end, skip = (page.find("-->", start + 4), 3) if page.startswith("<!--", start) else (page.find(">", start), 1)
            at = end + skip if end >= 0 else len(page)
            out.append((False, "", "", start, at))
            continue
        m = _NAME.match(page, start)
        if not m:
            at = start + 1
            continue
        k = m.end()
        while (c := _STOP.search(page, k)) and c[0] != ">":
            k = page.find(c[0], c.end()) + 1 if c.end() <= last[c[0]] else c.end()
        if not c:
            at = start + 1
            if start > last[">"]:
                break
            continue
        at, name, attributes = c.end(), m[2].lower(), page[m.end() : c.start()]
        out.append((bool(m[1]), name, attributes, start, at))
        if name in RAW and not m[1] and not attributes.endswith("/"):
            stop = None if name in endless else re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            if stop:
                out[-1] = (False, "", "", start, stop.end())
                at = stop.end()
            elif name in ("script", "style"):
                break
            endless |= set() if stop else {name}
    return out


def _ends(tokens: list) -> dict[int, int]:
    """By index of a start tag, the index of the end tag that closes it."""
    out: dict[int, int] = {}
    begun: dict[str, list[int]] = {}
    for k, (end, name, *_) in enumerate(tokens):
        if not end:
            begun.setdefault(name, []).append(k)
        elif begun.get(name):
            out[begun[name].pop()] = k
    return out


def lines(page: str) -> list[tuple[str, int, bool]]:
    """The page as lines: text, its length outside links, whether within article or main. An empty line is a gap."""
    out: list[tuple[str, int, bool]] = []
    tokens = _tags(page)
    closes = _ends(tokens)
    parts: list[str] = []
    free = inside = link = 0

    def flush() -> None:
        nonlocal free
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, free, inside > 0))
            parts.clear()
        free = 0

    def add(text: str) -> None:
        nonlocal free
        if text:
            parts.append(text)
            if not link:
                free += len(text.strip())

    i, at = 0, 0
    while i < len(tokens):
        end, name, attributes, start, stop = tokens[i]
        add(page[at:start])
        at = stop
        i += 1
        if not name:
            continue
        if not end and name not in VOID and name not in ("html", "body", "article", "main") and (name in CUT or name == "header" and not inside or _marked(attributes, inside > 0)):
            last = closes.get(i - 1)
            if last is not None:
                flush()
                i, at = last + 1, tokens[last][4]
                continue
        if name in BLOCK:
            flush()
            if name in ("article", "main"):
                inside = max(0, inside + (-1 if end else 1))
                out.extend([("", 0, False)] * WINDOW)
            link = 0
        elif name == "br":
            parts.append("\n")
        elif name == "a":
            link = 0 if end else 1
    if not tokens or tokens[-1][1] not in ("script", "style") or tokens[-1][0]:
        add(page[at:])
    flush()
    return out


def extract(page: str | None) -> str:
    """The main text: blocks of the kept lines joined by an empty line; empty if there is none."""
    if not page:
        return ""
    found = lines(page)
    within = any(x for _, x, inside in found if inside)
    weights = [x if inside or not within else 0 for _, x, inside in found]
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    stretches = []
    i = 0
    while i < len(sums):
        if not weights[i]:  # the window sees a surge before its first line
            i += 1
            continue
        surge = i
        while i < len(sums) and sums[i]:
            i += 1
        stretches.append((sum(weights[surge:i]), surge, i))
    least = min(THRESHOLD, max(stretches, default=(0,))[0])
    return "\n\n".join(t for mass, a, b in stretches if mass >= least for t, _, _ in found[a:b] if t)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages with text (main text, "" if none) and n_chars (its code points) in place of the markup.

    Null or empty html gives ""; repeated rows stay; an empty table gives an empty one. The page's other columns stay;
    text and n_chars among them are replaced. One page is parsed at a time, in memory in proportion to its length.
    """
    kept = [c for c in pages.columns if c.lower() not in (html_col.lower(), "text", "n_chars")]
    pages = pages.select(*[f"`{c}`" for c in kept], html_col)
    schema = ", ".join([*(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept), "text string", "n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, html_col, 4_000_000):
            texts = [extract(x) for x in b.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*kept, "text", "n_chars"])

    return pages.mapInArrow(run, schema)


def op8(pages: DataFrame) -> DataFrame:
    """The columns of the query."""
    return extract_pages(pages.select("page_id", "url", "html"))
