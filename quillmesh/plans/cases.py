"""Queries over given cases: parsers and checks whose results SQL can't compute, held against values written from the rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import text as tx
from quillmesh.functions import urls
from quillmesh.operators import grounding, splitting, stories
from quillmesh.plans.queries import ORACLES, QUERIES
from quillmesh.sources import blocks, mail, tables

_TYPES = {"string": "VARCHAR", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _literal(v: object) -> str:
    return "NULL" if v is None else str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, int | float) else "'" + str(v).replace("'", "''") + "'"


def case(schema: str, expected: list[tuple]) -> Callable:
    """Registers f(spark) with the rows that it has to give."""
    columns = [c.split() for c in schema.split(", ")]

    def register(f: Callable[[SparkSession], DataFrame]) -> Callable[[SparkSession], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark)
        values = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in expected)
        ORACLES[f.__name__] = "SELECT " + ", ".join(f'CAST("{n}" AS {_TYPES[t]}) AS "{n}"' for n, t in columns) + f" FROM (VALUES {values}) AS v(" + ", ".join(f'"{n}"' for n, _ in columns) + ")"
        return f

    return register


_WRAPPED = [
    ("https://mail.example.net/CL0/https:%2F%2Fwww.paper.org%2F2026%2Fai%3Futm_source=x/1/0100/abc=", "https://www.paper.org/2026/ai", "source"),
    ("https://www.search.com/url?q=https://example.com/a%3Fb%3D1&sa=D", "https://example.com/a?b=1", "source"),
    ("https://example.com/x?utm_source=t&id=5&l=en&mc_cid=1&fbclid=z#top", "https://example.com/x?id=5&l=en", "source"),
    ("https://foo.substack.com/p/bar?utm_medium=email", "https://foo.substack.com/p/bar", "source"),
    ("https://substack.com/redirect/2/eyJ", "https://substack.com/redirect/2/eyJ", "tracked"),
    ("https://link.mail.beehiiv.com/ss/c/u001.abc/def", "https://link.mail.beehiiv.com/ss/c/u001.abc/def", "tracked"),
    ("https://host.net/redirect/https://example.com/x?y=1", "https://example.com/x?y=1", "source"),
    ("https://twitter.com/paper", "https://twitter.com/paper", "social"),
    ("mailto:hi@x.com", "mailto:hi@x.com", "mailto"),
    ("#top", "#top", "source"),
]


@case("url string, canonical string, kind string", _WRAPPED)
def unwrapped_urls(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(u,) for u, _, _ in _WRAPPED], "url string")
    canonical, kind = F.udf(urls.canonical, "string"), F.udf(lambda u: urls.kind(urls.canonical(u)), "string")
    return rows.select("url", canonical("url").alias("canonical"), kind("url").alias("kind"))


_HOPS = {"https://t.co/a": (301, "https://t.co/b"), "https://t.co/b": (302, "https://example.com/x?utm_source=t"), "https://t.co/c": (200, None), "https://t.co/d": (500, None), "https://t.co/e": (301, "https://t.co/e")}


@case("url string, final string", [("https://t.co/a", "https://example.com/x"), ("https://t.co/b", "https://example.com/x"), ("https://t.co/c", None), ("https://t.co/d", None), ("https://t.co/e", None)])
def resolved_urls(spark: SparkSession) -> DataFrame:
    resolve = F.udf(lambda u: urls.resolve(u, lambda at, method: _HOPS[at]), "string")
    return spark.createDataFrame([(u,) for u in _HOPS], "url string").select("url", resolve("url").alias("final"))


@case("page long, image string", [(1, "https://x.org/a.png?b=1&c=2"), (2, "https://x.org/t.png"), (3, None), (4, None)])
def preview_images(spark: SparkSession) -> DataFrame:
    pages = [
        (1, '<meta name="twitter:image" content="https://x.org/t.png"><meta property="og:image" content="https://x.org/a.png?b=1&amp;c=2">'), (2, "<META content='https://x.org/t.png' name='twitter:image:src'/>"),
        (3, '<meta property="og:image" content="http://x.org/a.png">'), (4, "<p>none</p>"),
    ]
    return spark.createDataFrame(pages, "page long, html string").select("page", urls.image_col(F.col("html"), F.lit("https://x.org/")).alias("image"))


_MAIL = [
    b"From: TLDR AI <dan@tldrnewsletter.com>\r\nTo: box+techai@example.com\r\nSubject: Agents ship\r\nDate: Mon, 05 Oct 2026 07:01:00 -0400\r\nReceived: by mx; Mon, 05 Oct 2026 11:01:02 +0000\r\nList-Unsubscribe: <https://a.beehiiv.com/u>\r\n\r\n" + b"word " * 300,
    b"From: Dru Riley @ Trends.vc <d@trends.vc>\r\nDelivered-To: box@example.com\r\nSubject: Welcome to Trends\r\nDate: nonsense\r\nList-Id: Trends <t.trends.vc>\r\n\r\nshort text",
    b"From: =?utf-8?q?Caf=C3=A9?= <news@morningbrew.com>\r\nTo: box+legal@example.com\r\nSubject: =?utf-8?q?=E2=98=95_Fed?=\r\nDate: Tue, 06 Oct 2026 07:01:00\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary=b\r\nX-Mailer: Sendy 4\r\n\r\n"
    b"--b\r\nContent-Type: text/html; charset=utf-8\r\n\r\n<html><head><title>t</title></head><body><p>One <b>two</b></p><script>x</script></body></html>\r\n--b\r\nContent-Type: application/pdf\r\nContent-Disposition: attachment; filename=a.pdf\r\n\r\nx\r\n--b--\r\n",
    b"From: spam@bad.com\r\nTo: box@example.com\r\nSubject: \r\n\r\n",
]
_ROWS = [
    ("m0", "1-TechAI", "dan@tldrnewsletter.com|tldr ai", "TLDR AI", "Agents ship", "2026-10-05T11:01:00+00:00", "2026-10-05T11:01:02+00:00", 1, "beehiiv", 0, 300, 1.3, 0, "box+techai@example.com", "pending"),
    ("m1", "6-Indie", "d@trends.vc|t.trends.vc", "Dru Riley @ Trends.vc", "Welcome to Trends", None, None, 0, "unknown", 0, 2, 0.0, 0, "box@example.com", "pending"),
    ("m2", "2-Biz", "news@morningbrew.com|caf", "Café", "☕ Fed", "2026-10-06T07:01:00+00:00", None, 1, "other:sendy", 1, 2, 0.0, 1, "box+legal@example.com", "pending"),
    ("m3", "ignored", "spam@bad.com|spam bad com", "spam@bad.com", "", None, None, 0, "unknown", 0, 0, 0.0, 0, "box@example.com", "skipped"),
]


@case("gmail_id string, segment string, source_key string, sender_name string, subject string, sent_date string, received_date string, is_issue int, sending_platform string, has_html int, word_count int, reading_minutes double, has_attachments int, to_address string, split_status string", _ROWS)
def message_rows(spark: SparkSession) -> DataFrame:
    files = spark.createDataFrame([(f"/a/x__{'0' * 11}{k}.eml", m) for k, m in enumerate(_MAIL)], "path string, content binary")
    found = mail.messages(files).withColumn("message_id", F.concat(F.lit("m"), F.substring("message_id", -1, 1)))
    out = mail.message_rows(found, "box@example.com", [("morningbrew.com", "2-Biz")], {"techai": "1-TechAI", "legal": "3-Legal"}, [("trends.vc", "6-Indie")], ["spam@bad.com"])
    return out.select("gmail_id", "segment", "source_key", "sender_name", "subject", "sent_date", "received_date", "is_issue", "sending_platform", "has_html", "word_count", "reading_minutes", "has_attachments", "to_address", "split_status")


_LONG = "The company said on Monday that the new release changes how agents call tools and how they keep what they learn between runs."
ROUNDUP = f"""<html><head><style>p {{}}</style></head><body><div style="display:none">Preheader</div><img src="x.gif"><p><a href="https://paper.org/web">View in browser</a></p>
<h2>Headlines &amp; Launches</h2>
<p><a href="https://one.org/a?utm_source=x"><b>Agents SDK arrives (4 minute read)</b></a></p><p>{_LONG}</p>
<p><a href="https://two.org/b"><b>Chips beat estimates (3 minute read)</b></a></p><p>{_LONG}</p>
<p><a href="https://three.org/c"><b>Build tools in minutes (Sponsor)</b></a></p><p>{_LONG}</p>
<h2>Deep Dives</h2>
<p><a href="https://four.org/d"><b>Why evals fail (8 minute read)</b></a></p><p>{_LONG}</p>
<p>Love TLDR? Tell your friends and get rewards!</p><p>Share your referral link below.</p>
<p>You received this because you signed up. <a href="https://x.org/u">Unsubscribe</a></p></body></html>"""
BREW = f"""<body><p>Good morning to all of you who read this with a first coffee and a second look at the day.</p>
<p><b>MARKETS</b></p><h3>The Fed holds steady, stocks don't</h3><p>Powell spoke. {_LONG} <a href="https://cnbc.com/fed">More</a></p><h3>Oil slips on supply news</h3><p>{_LONG}</p>
<p><b>TOGETHER WITH VANTA</b></p><h3>Get compliant without sheets</h3><p>{_LONG}</p><p><b>TECH</b></p><h3>Chip team loses a leader</h3><p>{_LONG}</p><h3>Share the Brew</h3><p>Invite your friends.</p></body>"""
ESSAY = "<body>" + f"<p>{_LONG} {_LONG}</p>" * 5 + "</body>"
TEASER = f'<body><h1>Three names</h1><p>{_LONG}</p><p><a href="https://micro.substack.com/p/three">Keep reading with a trial</a></p></body>'


def _split(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([("brew", BREW, "Fed holds"), ("essay", ESSAY, "The Economics"), ("none", "", None), ("round", ROUNDUP, "Agents ship"), ("teaser", TEASER, "Last chance: 20% off")], "gmail_id string, html string, subject string")
    return splitting.with_items(blocks.with_blocks(rows).withColumn("blocks", blocks.without_boilerplate(F.col("blocks"))))


@case(
    "gmail_id string, position int, kind string, section string, title string, url string, is_sponsor int",
    [
        ("brew", 1, "intro", None, None, None, 0), ("brew", 2, "story", "MARKETS", "The Fed holds steady, stocks don't", "https://cnbc.com/fed", 0), ("brew", 3, "story", "MARKETS", "Oil slips on supply news", None, 0),
        ("brew", 4, "story", "TOGETHER WITH VANTA", "Get compliant without sheets", None, 1), ("brew", 5, "story", "TECH", "Chip team loses a leader", None, 0),
        ("essay", 1, "essay", None, "The Economics", None, 0),
        ("round", 1, "story", "Headlines & Launches", "Agents SDK arrives (4 minute read)", "https://one.org/a", 0), ("round", 2, "story", "Headlines & Launches", "Chips beat estimates (3 minute read)", "https://two.org/b", 0),
        ("round", 3, "story", "Headlines & Launches", "Build tools in minutes (Sponsor)", "https://three.org/c", 1), ("round", 4, "story", "Deep Dives", "Why evals fail (8 minute read)", "https://four.org/d", 0),
        ("teaser", 1, "teaser", None, "Last chance: 20% off", "https://micro.substack.com/p/three", 0),
    ],
)
def split_items(spark: SparkSession) -> DataFrame:
    return splitting.item_rows(_split(spark)).select("gmail_id", "position", "kind", "section", "title", "url", "is_sponsor")


@case("split_shape string, issues long, items long, sponsors long, promos long", [("roundup", 2, 9, 2, 0), ("essay", 1, 1, 0, 0), ("teaser", 1, 1, 0, 1), ("empty", 1, 0, 0, 0)])
def split_counters(spark: SparkSession) -> DataFrame:
    return splitting.counters(_split(spark))


@case("gmail_id string, url string, domain string, link_type string", [("brew", "https://cnbc.com/fed", "cnbc.com", "source"), ("round", "https://one.org/a", "one.org", "source"), ("round", "https://two.org/b", "two.org", "source"), ("round", "https://three.org/c", "three.org", "sponsor"), ("round", "https://four.org/d", "four.org", "source"), ("teaser", "https://micro.substack.com/p/three", "micro.substack.com", "source")])
def item_links(spark: SparkSession) -> DataFrame:
    items = splitting.item_rows(_split(spark))
    return splitting.link_rows(items).join(items.select("item_id", "gmail_id"), "item_id").select("gmail_id", "url", "domain", "link_type")


_PAGE = """<p hidden>no</p><h2>Head <a href="https://a.org/x">link</a></h2>Loose<br>lines<ul><li><b>Bold item</b></li><li><a href="https://b.org">All link</a></li></ul><hr><div><strong>Lead</strong> and the rest of it</div><div style="font-weight:700">Styled</div><p><b>open<p>next</b> plain</p>"""


@case(
    "at int, kind string, text string, level int, bold_full boolean, link_full boolean, links string, lead_bold double",
    [
        (0, "heading", "Head link", 2, False, False, "https://a.org/x", 0.0), (1, "text", "Loose", 0, False, False, "", 0.0), (2, "text", "lines", 0, False, False, "", 0.0), (3, "li", "Bold item", 0, True, False, "", 1.0),
        (4, "li", "All link", 0, False, True, "https://b.org", 0.0), (5, "hr", "---", 0, False, False, "", 0.0), (6, "text", "Lead and the rest of it", 0, False, False, "", 0.222), (7, "text", "Styled", 0, True, False, "", 1.0),
        (8, "text", "open", 0, True, False, "", 1.0), (9, "text", "next", 0, True, False, "", 1.0), (10, "text", "plain", 0, False, False, "", 0.0),
    ],
)
def page_blocks(spark: SparkSession) -> DataFrame:
    rows = blocks.with_blocks(spark.createDataFrame([(_PAGE,)], "html string")).select(F.posexplode("blocks").alias("at", "b"))
    return rows.select("at", "b.kind", "b.text", "b.level", "b.bold_full", "b.link_full", F.array_join(F.transform("b.links", lambda x: x["url"]), " ").alias("links"), F.round("b.lead_bold_frac", 3).alias("lead_bold"))


@case("markdown string", [("## Big [news]\n\n  <https://a.org>\n\n**All bold**\n\n[Read it all](https://b.org)\n\n- an item\n\n---\n\nLast words.\n",)])
def block_markdown(spark: SparkSession) -> DataFrame:
    page = '<h2>Big [news]<a href="https://a.org"> </a></h2><p><b>All bold</b></p><p><a href="https://b.org">Read it all</a></p><li>an item</li><hr><p>Last words.</p><p>View this email in your browser</p><p>All rights reserved</p>'
    rows = blocks.with_blocks(spark.createDataFrame([(page,)], "html string"))
    return rows.select(blocks.markdown(blocks.without_boilerplate(F.col("blocks"))).alias("markdown"))


@case("at int, kind string, text string, links string, link_full boolean", [(0, "heading", "TOP NEWS", "", False), (1, "text", "Plain words here", "", False), (2, "text", "See", "https://a.org/x", True)])
def text_paragraphs(spark: SparkSession) -> DataFrame:
    rows = blocks.with_blocks(spark.createDataFrame([("TOP NEWS\n\nPlain\nwords here\n \n\nSee https://a.org/x?utm_source=b",)], "text string")).select(F.posexplode("blocks").alias("at", "b"))
    return rows.select("at", "b.kind", "b.text", F.array_join(F.transform("b.links", lambda x: x["url"]), " ").alias("links"), "b.link_full")


@case("at int, sentence string", [(0, "First one. [i1]"), (1, "Then 2 more! [i2][i3]"), (2, 'He said "no".'), (3, "(Yes.) e.g. this")])
def split_sentences(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([('First one. [i1] Then 2 more! [i2][i3] He said "no". (Yes.) e.g. this',)], "text string")
    return rows.select(F.posexplode(tx.sentences(F.col("text"))).alias("at", "sentence"))


@case("k int, ids string, plain string", [(1, "3,12", "Two cited, and more."), (2, "", "None")])
def cited_ids(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(1, "Two [i12] [i3] cited , and more [i12]."), (2, "None")], "k int, text string")
    return rows.select("k", F.array_join(tx.citations(F.col("text")).cast("array<string>"), ",").alias("ids"), tx.plain(F.col("text")).alias("plain"))


@case("k int, seconds double", [(1, 62.5), (2, 0.12), (3, 3.0), (4, None), (5, 3600.0)])
def durations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, "1m2.5s"), (2, "120ms"), (3, "3"), (4, "soon"), (5, "1h")], "k int, v string").select("k", F.round(tx.seconds(F.col("v")), 6).alias("seconds"))


@case("k int, subject string, tidy string, prompt string, id long", [(1, "re: big news", "3-5 miles", "A robot waves. flat style", 5), (2, "", "plain", "sun. flat style", None)])
def small_texts(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(1, "Re:​  BIG\tnews ", "3‑5 miles", "A logo  robot text waves", "[i5]"), (2, None, "plain", "sun", "x")], "k int, s string, t string, b string, i string")
    return rows.select("k", tx.norm_subject(F.col("s")).alias("subject"), tx.tidy(F.col("t")).alias("tidy"), tx.image_prompt(F.col("b"), "flat style", ["logo", "text"]).alias("prompt"), tx.cited_id(F.col("i")).alias("id"))


@case("k int, object string", [(1, '{"a": 1}'), (2, '{"a": 2}'), (3, None), (4, '{"b": {}}')])
def reply_objects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, '```json\n{"a": 1}\n```'), (2, 'Sure! {"a": 2} Done.'), (3, "nothing"), (4, ' {"b": {}} ')], "k int, reply string").select("k", tx.json_object(F.col("reply")).alias("object"))


_SOURCE = "Acme raised $25M in a round led by Orbit. “We will hire 1,299 people this year,” said Jo Hill. The model is called Lumen 2."
_REPLY = """{"summary": "Acme raised money.", "category": "FUNDING", "importance": "4.5", "entities": [{"name": "Acme", "type": "company"}, {"name": "acme", "type": "org"}, {"name": "Ghost", "type": "org"}, {"name": "Jo Hill", "type": "pilot"}],
"claims": [{"text": "Raised $25M", "type": "number"}, {"text": "Raised $77M", "type": "number"}, {"text": "It grows", "type": "guess"}], "stats": [{"value": "1299", "unit": "people", "description": "hires"}, {"value": "7", "unit": "x", "description": ""}, {"value": "many"}],
"quotes": [{"text": "\\"We will hire 1,299 people\\"", "speaker": "Jo Hill"}, {"text": "too short"}], "topics": ["Funding", "funding", "AI"]}"""


@case(
    "item_id int, summary string, category string, importance int, entities string, claims string, stats string, quotes string, topics string, dropped int",
    [(1, "Acme raised money.", "funding", 4, "Acme:company, Jo Hill:other", "Raised $25M:number, It grows:fact", "1299:people", "We will hire 1,299 people:Jo Hill", "funding, ai", 5), (2, "A tip", "other", 1, "", "", "", "", "", 0), (3, None, None, None, None, None, None, None, None, None)],
)
def valid_extractions(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(1, _REPLY, _SOURCE), (2, '{"importance": 5}', "A tip\nmore"), (3, '{"importance": 5}', "word " * 80)], "item_id int, reply string, source string")
    x = grounding.validated(rows)
    pairs = lambda c, a, b: F.array_join(F.transform(f"x.{c}", lambda e: F.concat_ws(":", e[a], e[b])), ", ").alias(c)
    return x.select("item_id", "x.summary", "x.category", "x.importance", pairs("entities", "name", "type"), pairs("claims", "text", "type"), pairs("stats", "value", "unit"), pairs("quotes", "text", "speaker"), F.array_join("x.topics", ", ").alias("topics"), "x.dropped")


@case("kind string, n long", [("claims", 2), ("entities", 2), ("item_enrichment", 3), ("quotes", 1), ("stats", 1), ("topics", 2)])
def extraction_facts(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(1, _REPLY, _SOURCE), (2, '{"importance": 5}', "A tip\nmore"), (3, '{"importance": 5}', "word " * 80)], "item_id int, reply string, source string")
    out = None
    for name, df in sorted(grounding.facts(grounding.validated(rows)).items()):
        n = df.agg(F.lit(name).alias("kind"), F.count("*").alias("n"))
        out = n if out is None else out.unionAll(n)
    return out


@case("at int, text string, items string", [(0, "Both report growth", "1,2"), (1, "Revenue was 25", "1")])
def valid_points(spark: SparkSession) -> DataFrame:
    points = '[{"text": "Both  report growth", "items": ["[i1]", "2", "9"]}, {"text": "Revenue was 99", "items": ["1"]}, {"text": "Revenue was 25", "items": ["i1"]}, {"text": "No ids", "items": ["8"]}, {"text": "", "items": ["1"]}]'
    rows = spark.createDataFrame([(points,)], "p string").select(F.posexplode(grounding.valid_points(F.from_json("p", grounding.POINTS), F.create_map(F.lit(1).cast("long"), F.lit("It made $25M"), F.lit(2).cast("long"), F.lit("It grew")))).alias("at", "x"))
    return rows.select("at", "x.text", F.array_join(F.col("x.items").cast("array<string>"), ",").alias("items"))


_COPY = "The quick brown robot jumped over the lazy old fence near our house today"


@case(
    "k int, problem string",
    [
        (1, None), (2, "cites unknown item(s) [9]"), (3, "no citation"), (4, "names the newsletter 'Daily Byte'"), (5, "mentions newsletters"), (6, "number 99 not in the cited source"), (7, "name 'Zed' not in the cited source"),
        (8, "copies 11+ words from the source"), (9, None), (10, None),
    ],
)
def checked_sentences(spark: SparkSession) -> DataFrame:
    rows = [(1, "Acme raised 25 million for Lumen. [i1]"), (2, "It grew. [i9]"), (3, "It grew."), (4, "As Daily Byte wrote, it grew. [i1]"), (5, "The newsletter says so. [i1]"), (6, "It made 99 units. [i1]"), (7, "Then Zed left. [i1]"), (8, f"{_COPY}. [i2]"), (9, "[i1]"), (10, "Two reports agree on Acme. [i1]")]
    texts = spark.createDataFrame([(1, "Acme raised $25 million; Lumen is its model."), (2, _COPY)], "item_id long, text string")
    return grounding.checked_sentences(spark.createDataFrame(rows, "k int, sentence string"), texts, ["Daily Byte", "X"]).select("k", "problem")


@case("part string, text string, problems long", [("hook", "Acme grew. [i1]", 1), ("close", "", 0)])
def checked_parts(spark: SparkSession) -> DataFrame:
    parts = spark.createDataFrame([(1, "hook", 0, "Acme grew. [i1] Then Zed left Acme. [i1]"), (1, "close", 0, None)], "issue int, part string, position int, text string")
    out = grounding.checked_parts(parts, spark.createDataFrame([(1, "Acme grew fast")], "item_id long, text string"))
    return out.select("part", "text", F.size("problems").cast("long").alias("problems"))


@case("item_id long", [(1,), (2,)])
def cited_before(spark: SparkSession) -> DataFrame:
    rows = [("a", "2026-10-01", "sent", '{"cited_items": [1, 2]}'), ("a", "2026-10-02", "rejected", '{"cited_items": [3]}'), ("a", "2026-10-03", "draft", "broken"), ("a", "2026-10-05", "sent", '{"cited_items": [4]}'), ("b", "2026-10-01", "sent", '{"cited_items": [5]}')]
    return stories.cited_before(spark.createDataFrame(rows, "segment string, issue_date string, status string, validator_report string"), "a", "2026-10-05")


@case("notes string", [("### STORY 7 — TOP — widely covered today\n[i1] note 1/2: One\n    Short sum\n    numbers: 25 M; 3 x\n[i2] note 2/2: Two\n    its first words\n    notes agree: Both grew [i1][i2]",)])
def story_notes(spark: SparkSession) -> DataFrame:
    items = [(1, "One", "Short sum", "text", ["25 M", "3 x"]), (2, "Two", None, "its first words", [])]
    rows = spark.createDataFrame([(7, items, [("Both grew", [1, 2])], [])], "story int, items array<struct<item_id:int,title:string,summary:string,text:string,stats:array<string>>>, agree array<struct<text:string,items:array<int>>>, differ array<struct<text:string,items:array<int>>>")
    return rows.select(stories.notes(F.lit("TOP"), F.col("story"), F.lit(2), F.col("items"), F.col("agree"), F.col("differ")).alias("notes"))


@case("video string, start double, text string", [("v", 0.0, "Hello there"), ("v", 2.5, "second line"), ("v", 3661.25, "third")])
def caption_cues(spark: SparkSession) -> DataFrame:
    content = "WEBVTT\nKind: captions\nLanguage: en\n\n00:00:00.000 --> 00:00:01.000 align:start\nHello <c>there</c>\nnext\n\n00:00:01.000 --> 00:00:02.500\nHello there\n\n2\n00:00:02.500 --> 00:00:03.000\nsecond <00:00:02.700>line\n\n01:01:01.250 --> 01:01:02.000\nthird\n"
    return tables.cues(spark.createDataFrame([("v", content)], "video string, content string")).select("video", "start", "text")


@case("k int, decoded string, subject string, cell string", [(1, "a?b>c", "Long subject line", '"a ""b"", c"'), (2, "ab", None, "plain")])
def mail_exports(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(1, "YT9iPmM", "To: x\r\nSubject: Long\r\n subject line\r\n\r\nSubject: body", 'a "b", c'), (2, "YWI", "To: x\n\nSubject: body", "plain")], "k int, b string, raw string, c string")
    return rows.select("k", tables.base64url(F.col("b")).cast("string").alias("decoded"), tables.header(F.col("raw"), "Subject").alias("subject"), tables.csv_cell(F.col("c")).alias("cell"))
