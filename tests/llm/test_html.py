"""HTML extraction on small pages whose main text is known."""

import difflib
import html
import re
import time

from quillmesh.llm import html_density as h

PAGE = """<!doctype html><html><head><title>T</title><style>p {}</style></head><body><nav><a href=x>Home</a></nav>
<article><h1>Head &amp; line</h1><p>One  two
 three.</p><div class="ad-box ad">Buy now</div><script>var a = "</p>";</script><p>Four &#233;.</p><form>f</form></article>
<section id="comments"><p>A reader comment of many words, longer than all the rest of this page taken together.</p></section><footer>c</footer></body></html>"""


def test_article_only():
    assert h.extract(PAGE) == "Head & line\n\nOne two three.\n\nFour é."


def test_density_without_article():
    links = "".join(f"<div><a href=x>Link {k}</a></div>" for k in range(9))
    page = f"<body><div>{links}</div><div><p>First block of text, which is long.</p><p>Second block of text.</p></div><div>{links}</div></body>"
    assert h.extract(page) == "First block of text, which is long.\n\nSecond block of text."


def test_odd_pages():
    assert [h.extract(x) for x in (None, "", "<nav>a</nav>", "<script>x", "<p")] == ["", "", "", "", "<p"]
    assert h.extract("plain words") == "plain words"
    deep = "<div>" * 3000 + "<p>deep</p>" + "</div>" * 3000
    assert h.extract(deep) == "deep"


def test_query(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None), (None, "v", "", "")], "page_id long, url string, html string, text string")
    rows = h.op8(pages).collect()
    assert sorted((r["page_id"] or 0, r["text"][:4], r["n_chars"] == len(r["text"])) for r in rows) == [(0, "", True), (1, "Head", True), (1, "Head", True), (2, "", True)]
    assert h.extract_pages(pages.limit(0)).count() == 0


def test_density_decides_within_article():
    text = "A paragraph of the article, long enough to be main text by itself, as it has over a hundred characters in all."
    links = "".join(f"<li><a href=x>Link {k}</a></li>" for k in range(4))
    assert h.extract(f"<article><p>{text}</p><ul class=more>{links}</ul><p>{text}</p></article><div>{text}</div>") == f"{text}\n\n{text}"
    assert h.extract(f"<article><p>{text}</p><ul>{links}</ul><p>Short notice</p></article>") == text


def test_cut_elements_and_wrappers_do_not_split():
    assert h.extract('<div><p>A</p><div class="ad">x</div><p>B</p></div>') == "A\n\nB"
    assert h.extract("<div><section><div><p>One</p></div></section><section><div><p>Two</p></div></section></div>") == "One\n\nTwo"
    text, links = "Words of a stretch that is main text by itself. " * 3, "".join(f"<p><a href=x>{k}</a></p>" for k in range(3))
    assert h.extract(f"<p>{text}</p>{links}<p>{text}</p>").count("stretch") == 6


def test_hostile_pages_take_linear_time():
    for unit in ('<p class="x', "<nav>", '<a "', "<title>", "<", "<!", "<a '\"", "<div class=ad>", "<svg>"):
        page = unit * (1_000_000 // len(unit))
        start = time.process_time()
        h.extract(page)
        assert time.process_time() - start < 20, unit


def test_known_text_with_and_without_article(spark):
    """The pages' articles by another parser: h1 and p of article; with their tags renamed, only classes and density are left."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    for page in pages:
        inner = re.sub(r"(?s)<(script|style|form)\b.*?</\1>", "", re.search(r"(?s)<article>(.*?)</article>", page)[1])
        inner = re.sub(r'(?s)<(div|aside|section) class="(?:ad|comment|notice|share)[^"]*">.*?</\1>', "", inner)
        known = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"(?i)</?(?:p|h1|h2|h3|li|ul|div|section)\b[^>]*>", inner)]
        known = "".join("".join(x.split()) for x in known)
        got = "".join(h.extract(page).split())
        renamed = "".join(h.extract(re.sub(r"(</?)(?:article|main)\b", r"\1div", page)).split())
        assert got == known
        assert difflib.SequenceMatcher(None, renamed[:3000], known[:3000], autojunk=False).ratio() > 0.9
