"""Native column functions over text and addresses."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillmesh.functions import rules


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def reading_minutes(words: Column) -> Column:
    """Minutes to a tenth, half to even."""
    return F.bround(words / rules.WORDS_PER_MINUTE, 1)


def slug(value: Column, length: int = 28) -> Column:
    """Lower-case letters and digits joined by hyphens; x if there are none."""
    s = F.substring(F.trim(F.regexp_replace(F.lower(F.coalesce(value, F.lit("x"))), r"[^a-z0-9]+", "-"), F.lit("-")), 1, length)
    return F.when(s == "", "x").otherwise(s)


def clip(value: Column, length: int) -> Column:
    """White space runs as one space; what exceeds the length ends in an ellipsis."""
    flat = F.trim(F.regexp_replace(value, r"[ \t\n\x0B\f\r]+", " "))
    return F.when(F.length(flat) > length, F.concat(F.rtrim(F.substring(flat, 1, length - 1)), F.lit("…"))).otherwise(flat)


def html_escape(value: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        value = F.replace(value, F.lit(plain), F.lit(entity))
    return value


def number_in_text(value: Column, source: Column) -> Column:
    """Whether every number of the value, of which there must be one, stands in the source; commas aside."""
    found, plain = F.regexp_extract_all(value, F.lit(r"\d+(?:[.,]\d+)*"), F.lit(0)), F.replace(source, F.lit(","), F.lit(""))
    return (F.size(found) > 0) & F.forall(found, lambda n: F.contains(plain, F.replace(n, F.lit(","), F.lit(""))))


def route(value: Column, rules: list[tuple[str, str]], default: str = "unmatched") -> Column:
    """The segment of the first rule whose needle the value contains, in any case."""
    low = F.lower(value)
    hits = [F.when(F.contains(low, F.lit(needle.lower())), segment) for needle, segment in rules]
    return F.coalesce(*hits, F.lit(default))


_SPACE = r"(?U)\s+"


def flat(value: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(value, _SPACE, " "))


def norm(value: Column) -> Column:
    """Lower case, plain quotes and dashes, flat; for "does this stand in the text". NFKC besides is norm_nfkc."""
    return flat(F.translate(F.lower(F.coalesce(value, F.lit(""))), "\u2019\u2018\u201c\u201d\u2013\u2014", "''\"\"--"))


@F.pandas_udf(StringType())
def _nfkc(value: pd.Series) -> pd.Series:
    return value.map(lambda s: s if s is None or s.isascii() else unicodedata.normalize("NFKC", s))


def norm_nfkc(value: Column) -> Column:
    """norm of text that may hold compatibility characters: Arrow batches, ASCII passed through."""
    return norm(_nfkc(value))


def norm_text(value: str | None) -> str:
    """norm_nfkc of one value."""
    s = unicodedata.normalize("NFKC", value or "").lower().translate(str.maketrans("\u2019\u2018\u201c\u201d\u2013\u2014", "''\"\"--"))
    return " ".join(s.split())


def clean_title(value: Column) -> Column:
    """Without reading times, leading symbols and punctuation at the ends."""
    t = F.regexp_replace(F.coalesce(value, F.lit("")), rules.TITLE_NOISE, "")
    t = F.regexp_replace(F.regexp_replace(t, "(?U)^[^\\w\"'\u201c\u2018$]+", ""), _SPACE, " ")
    return F.regexp_replace(t, "^[ :\u2013-]+|[ :\u2013-]+$", "")


def tokens(value: Column) -> Column:
    """Words that tell stories apart: no stop words, no single letters, plurals folded."""
    found = F.regexp_extract_all(norm(value), F.lit(f"({rules.TOKEN})"))
    own = F.filter(found, lambda t: ~t.isin(*rules.STOP) & ((F.length(t) > 1) | t.rlike("^[0-9]$")))
    return F.transform(own, lambda t: F.when((F.length(t) > 4) & F.endswith(t, F.lit("s")) & ~F.endswith(t, F.lit("ss")), F.substr(t, F.lit(1), F.length(t) - 1)).otherwise(t))


def words(value: Column) -> Column:
    return F.filter(F.split(F.coalesce(value, F.lit("")), _SPACE), lambda w: w != "")


def first_words(value: Column, n: int, more: str = "") -> Column:
    """The first n words by single spaces, and `more` if there are others."""
    # split no further than needed: a blank at the start gives an empty piece, and the last piece is the rest
    w = F.filter(F.split(F.coalesce(value, F.lit("")), _SPACE, n + 2), lambda w: w != "")
    return F.concat(F.array_join(F.slice(w, 1, n), " "), F.when(F.size(w) > n, more).otherwise(""))


def item_text(section: Column, title: Column, body: Column) -> Column:
    """What a model reads of an item: section and title, and at most 1,800 words of the body."""
    short = F.when(F.size(words(body)) > rules.INPUT_WORDS, first_words(body, rules.INPUT_WORDS, " …")).otherwise(F.coalesce(body, F.lit("")))
    head = F.when(F.coalesce(section, F.lit("")) != "", F.concat(F.lit("Section: "), section, F.lit("\n"))).otherwise("")
    named = F.when(F.coalesce(title, F.lit("")) != "", title).otherwise("(untitled)")
    return F.trim(F.concat(head, F.lit("Title: "), named, F.lit("\n\n"), short))


def newsletter_name(sender: Column) -> Column:
    """A sender's name up to a dash, a "from" or an at sign."""
    return F.trim(F.regexp_extract(F.coalesce(sender, F.lit("")), "(?s)^(.*?)( \u2013 | from |@|$)", 1))


def norm_subject(subject: Column) -> Column:
    return F.lower(flat(F.regexp_replace(F.coalesce(subject, F.lit("")), "[\u200b-\u200f\u2060\ufeff\u034f\u00ad]", "")))


def tidy(value: Column) -> Column:
    """Unusual hyphens and spaces as plain ones."""
    return F.translate(value, "\u2011\u2010\u202f\u00a0\u2009", "--   ")


def is_issue(subject: Column, n_words: Column) -> Column:
    """0 if a blank or confirming subject stands over a short text, else 1."""
    subject = F.coalesce(subject, F.lit(""))
    odd = (F.trim(F.regexp_replace(subject, _SPACE, " ")) == "") | subject.rlike(rules.CONFIRM)
    return F.when(odd & (n_words < rules.NON_ISSUE_WORDS), 0).otherwise(1)


def is_promo(subject: Column, stories: Column) -> Column:
    return (F.coalesce(subject, F.lit("")).rlike(rules.PROMO_SUBJECT) & (stories <= 2)).cast("int")


def is_sponsor(section: Column, title: Column, body: Column) -> Column:
    label = F.coalesce(section, F.lit("")).rlike(rules.SPONSOR_LABEL) | F.coalesce(title, F.lit("")).rlike(rules.SPONSOR_LABEL)
    return (label | F.substring(F.coalesce(body, F.lit("")), 1, 200).rlike(rules.SPONSOR_BODY)).cast("int")


def sentences(value: Column) -> Column:
    """Sentences; citations that follow a full stop go to the sentence before."""
    parts = F.split(F.trim(F.coalesce(value, F.lit(""))), "(?<=[.!?])\\s+(?=[A-Z0-9\"\u201c\u2018'(\\[])")
    lead = r"^((?:\s*\[i\d+\]\s*)+[.!?]?)"

    def step(done: Column, part: Column) -> Column:
        cited = F.regexp_extract(part, lead, 1)
        moves = (F.size(done) > 0) & (cited != "")
        last = F.concat(F.element_at(done, -1), F.lit(" "), F.trim(cited))
        before = F.when(moves, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(last))).otherwise(done)
        rest = F.trim(F.when(moves, F.regexp_replace(part, lead, "")).otherwise(part))
        return F.when(rest == "", before).otherwise(F.concat(before, F.array(rest)))

    return F.aggregate(parts, F.array().cast("array<string>"), step)


def citations(value: Column) -> Column:
    """Distinct cited ids, ascending."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(value, F.lit(rules.CITATION)), lambda x: x.cast("long"))))


def plain(value: Column) -> Column:
    """Without citations, and without the spaces that they leave."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(value, F.lit("")), rules.CITATION, ""), r"\s+([.!?,;:])", "$1")
    return F.trim(F.regexp_replace(t, r"\s{2,}", " "))


def ngrams(value: Column, n: int = rules.COPY) -> Column:
    """Distinct runs of n words of norm(value)."""

    def runs(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))
        return F.when(F.size(w) >= n, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))

    # the words as a lambda's variable: an inner lambda would find the words of the text again for each of its runs
    return F.get(F.transform(F.array(F.regexp_extract_all(norm(value), F.lit(r"([a-z0-9$%']+)"))), runs), F.lit(0))


def markdown_to_text(value: Column) -> Column:
    t = F.regexp_replace(value, r"\[([^\]]*)\]\(([^)]*)\)", "$1 <$2>")
    return F.replace(F.regexp_replace(t, r"(?m)^#+\s*", ""), F.lit("**"), F.lit(""))


def image_prompt(brief: Column, style: str, banned: list[str]) -> Column:
    """A brief without banned words, with the style, at most 900 characters."""
    pattern = r"(?i)\b(" + "|".join(banned) + r")\b"
    return F.substring(F.concat(flat(F.regexp_replace(brief, pattern, "")), F.lit(". "), F.lit(style)), 1, 900)


def seconds(value: Column) -> Column:
    """Seconds of 1m2.5s, 120ms, 3 and the like; null without a number."""
    parts = F.regexp_extract_all(value, F.lit(r"([\d.]+(?:ms|h|m|s))"))
    unit = {"ms": 0.001, "h": 3600.0, "m": 60.0, "s": 1.0}

    def of(p: Column) -> Column:
        u, n = F.regexp_extract(p, r"(ms|h|m|s)$", 1), F.regexp_extract(p, r"^([\d.]+)", 1).cast("double")
        out = F.lit(0.0)
        for k, x in unit.items():
            out = F.when(u == k, n * x).otherwise(out)
        return out

    total = F.aggregate(F.transform(parts, of), F.lit(0.0), lambda a, x: a + x)
    return F.coalesce(F.trim(value).try_cast("double"), F.when(F.size(parts) > 0, total))


def next_check(subscribed: Column, frequency: Column) -> Column:
    days = F.lit(rules.CADENCE_ELSE)
    for k, n in rules.CADENCE.items():
        days = F.when(F.lower(F.trim(frequency)) == k, n).otherwise(days)
    return F.date_add(subscribed, days)


def date_label(day: Column) -> Column:
    return F.date_format(day, "EEEE, d MMMM yyyy")


def card_date(day: Column) -> Column:
    return F.date_format(day, "MMMM d, yyyy")


def cited_id(value: Column) -> Column:
    """5 of "[i5]", "i5" and "5"."""
    return F.regexp_extract(value, r"^\s*\[?i?(\d+)\]?\s*$", 1).try_cast("long")


def json_object(reply: Column) -> Column:
    """The JSON object in a reply, as text: fenced, bare, or from the first brace to the last; null if there is none."""
    inner = F.trim(F.regexp_replace(F.trim(reply), r"(?s)^```(?:json)?\s*|\s*```$", ""))
    inner = F.when(F.startswith(inner, F.lit("{")) & F.try_parse_json(inner).isNotNull(), inner).otherwise(F.regexp_extract(inner, r"(?s)(\{.*\})", 1))
    return F.when((inner != "") & F.try_parse_json(inner).isNotNull(), inner)
