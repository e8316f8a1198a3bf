"""Text rules as Column functions (F-06..F-07, F-09, F-11..F-18, F-25, F-28..F-30, F-39, F-44)."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BODY_MAX = 4000
SLUG_MAX = 40
TAIL = 200
#: Endings that mark a text as cut.
CUT_ENDINGS = ("…", "...", "‥", "···")


@F.pandas_udf(StringType())
def unescape(text: pd.Series) -> pd.Series:
    """Character references by HTML's rules; the one step of strip_html that has no built-in form."""
    return text.map(html.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


#: Python's str.strip(): white space of any script.
EDGE = r"^[\s\x1c-\x1f\x85   -     　]+|[\s\x1c-\x1f\x85   -     　]+$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, EDGE, "")


def _collapsed(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "[ \t ]+", " "), "\n{3,}", "\n\n")


def _spaced(text: Column) -> Column:
    return strip(_collapsed(text))


def strip_html(raw: Column) -> Column:
    """Tags to spaces, references decoded, blanks collapsed, at most one blank line. Only texts with an & leave the JVM."""
    bare = F.regexp_replace(F.coalesce(raw, F.lit("")), "<[^>]+>", " ")
    return _spaced(F.when(F.contains(bare, F.lit("&")), unescape(bare)).otherwise(bare))


def strip_html_simple(raw: Column) -> Column:
    """As strip_html, but only amp, quot, middot, copy, lt, gt with their semicolons are references, and only ASCII's white space is cut at the ends: all inside the JVM."""
    bare = F.regexp_replace(F.coalesce(raw, F.lit("")), "<[^>]+>", " ")
    for name, char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(name), F.lit(char))
    return F.regexp_replace(_collapsed(bare), r"\A[\t\n\f\r ]+|[\t\n\f\r ]+\z", "")


def entry_body(candidates: Column) -> Column:
    """The longest of the stripped candidates (the first of equals), cut at BODY_MAX (P-02)."""
    stripped = F.filter(candidates, lambda c: c.isNotNull() & (c != ""))
    best = F.aggregate(stripped, F.lit(""), lambda acc, c: F.when(F.length(c) > F.length(acc), c).otherwise(acc))
    return F.left(best, F.lit(BODY_MAX))


def parse_offset(text: Column) -> Column:
    """Seconds of an offset such as +09:00 or -0530; null for null or empty, an error otherwise."""
    t = F.trim(text)
    sign = F.when(F.left(t, F.lit(1)) == "-", F.lit(-1)).otherwise(F.lit(1))
    seconds = sign * (F.regexp_extract(t, r"^[+-](\d{2}):?(\d{2})$", 1).cast("int") * 3600 + F.regexp_extract(t, r"^[+-](\d{2}):?(\d{2})$", 2).cast("int") * 60)
    return F.when(text.isNull() | (text == ""), F.lit(None).cast("int")).when(t.rlike(r"^[+-]\d{2}:?\d{2}$"), seconds).otherwise(F.raise_error(F.concat(F.lit("not an offset: "), text)).cast("int"))


def utc_date(naive: Column, offset: Column, explicit: Column | None = None) -> Column:
    """UTC date of an entry: an explicit moment wins, else the naive one shifted by its source's offset (F-08)."""
    moved = F.to_date(naive.cast("timestamp_ntz") - F.make_dt_interval(secs=F.coalesce(offset, F.lit(0))))
    return moved if explicit is None else F.coalesce(F.to_date(explicit), moved)


def casefold(text: Column) -> Column:
    """Full case folding: ß is ss, ligatures are their letters, a final sigma is a sigma, a dotless i stays."""
    # Upper case spells out what lower case leaves; the optimizer would drop it directly inside lower().
    spelt = F.translate(F.upper(F.translate(text, "ı", "\ue002")), "\ue002", "ı")
    return F.replace(F.translate(F.lower(spelt), "ς", "σ"), F.lit("ß"), F.lit("ss"))


def normalization_key(name: Column) -> Column:
    """Matching key: without any white space, folded."""
    return casefold(F.regexp_replace(name, "(?U)\\s+", ""))


def slugify(text: Column, most: int | None = None, normalised: bool = False) -> Column:
    """Lower-case letters, digits and Hangul with hyphens between; cut at a hyphen that is past half of most."""
    slug = F.regexp_replace(F.lower(text if normalised else nfc(text)), "[^0-9a-z가-힣ㄱ-ㅎㅏ-ㅣ]+", "-")
    slug = F.regexp_replace(F.regexp_replace(slug, "-{2,}", "-"), "^-+|-+$", "")
    if most is None:
        return slug
    window = F.left(slug, F.lit(most + 1))
    last = F.length(window) - F.instr(F.reverse(window), "-")  # characters before the last hyphen
    cut = F.when((F.instr(window, "-") > 0) & (last >= most // 2), F.left(window, last)).otherwise(F.left(slug, F.lit(most)))
    return F.when(F.length(slug) <= most, slug).otherwise(F.regexp_replace(cut, "^-+|-+$", ""))


def sanitize_filename(name: Column) -> Column:
    clean = F.regexp_replace(F.regexp_replace(name, r'[\\/:*?"<>|\x00-\x1f]', ""), "[. ]+$", "")
    return F.when(clean == "", F.lit("untitled")).otherwise(clean)


def build_filename(title: Column, source: Column, day: Column, normalised: bool = False) -> Column:
    """<date>-<source>-<slug>.md"""
    blank = lambda c, other: F.coalesce(F.nullif(c, F.lit("")), F.lit(other))
    return sanitize_filename(F.concat(day.cast("string"), F.lit("-"), blank(slugify(source, None, normalised), "unknown"), F.lit("-"), blank(slugify(title, SLUG_MAX, normalised), "untitled"), F.lit(".md")))


def safe_filename(key: Column) -> Column:
    return F.concat(F.regexp_replace(key, "[^A-Za-z0-9._-]", "_"), F.lit(".json"))


def wikilink(value: Column) -> Column:
    clean = F.translate(F.replace(F.replace(value, F.lit("[["), F.lit("")), F.lit("]]"), F.lit("")), "|#", "  ")
    return F.concat(F.lit("[["), strip(clean), F.lit("]]"))


def render_body(summary: Column, tags: Column, companies: Column, source: Column, url: Column) -> Column:
    """Markdown body of a note: summary, linked concepts, source link (F-15). The headings are fixed values."""
    links = F.concat(F.transform(tags, lambda x: F.concat(F.lit("- "), wikilink(x))), F.transform(F.filter(companies, lambda x: x != ""), lambda x: F.concat(F.lit("- "), wikilink(x))))
    shown = F.when(F.size(links) == 0, F.lit("- (없음)")).otherwise(F.array_join(links, "\n"))
    return F.concat(F.lit("## 요약\n\n"), strip(summary), F.lit("\n\n## 관련 개념\n\n"), shown, F.lit("\n\n## 원문\n\n["), source, F.lit("에서 보기]("), url, F.lit(")\n"))


def declared_lang(tags: Column) -> Column:
    return F.when(F.array_contains(tags, "ko"), F.lit("ko")).otherwise(F.lit("en"))


def clamp_text(body: Column) -> Column:
    """(text cut at BODY_MAX, truncated): truncated if the right-stripped text ends in a mark, or the text is longer."""
    ends = F.regexp_replace(body, EDGE.split("|")[1], "")
    marked = F.lit(False)
    for mark in CUT_ENDINGS:
        marked = marked | ends.endswith(mark)
    return F.struct(F.left(body, F.lit(BODY_MAX)).alias("text"), (marked | (F.length(body) > BODY_MAX)).alias("truncated"))


def render_prompt(template: str, values: dict[str, Column], missing: str = "(정보 없음)") -> Column:
    """Fill {{name}} places in one pass: a value is never expanded again (F-18)."""
    import re

    parts, at = [], 0
    for m in re.finditer(r"\{\{(\w+)\}\}", template):
        parts.append(F.lit(template[at : m.start()]))
        parts.append(F.coalesce(F.nullif(values[m[1]].cast("string"), F.lit("")), F.lit(missing)) if m[1] in values else F.lit(m[0]))
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def stop_kind(finish: Column, content: Column) -> Column:
    """length becomes degenerate if the last TAIL characters are blank, else truncated; other reasons stay (F-30)."""
    return F.when(finish == "length", F.when(strip(F.right(F.coalesce(content, F.lit("")), F.lit(TAIL))) == "", F.lit("degenerate")).otherwise(F.lit("truncated"))).otherwise(finish)


def stated_denominator(rationale: Column) -> Column:
    """The denominator that a rationale states, else that of its last ratio (F-25). The pattern is a fixed value."""
    named = F.regexp_extract(rationale, r"분모\s*(?:는|은|가|=|:)?\s*(\d)", 1)
    ratios = F.regexp_extract_all(rationale, F.lit(r"\d(?:\.\d)?\s*/\s*(\d)"), F.lit(1))
    return F.when(named != "", named.cast("int")).when(F.size(ratios) > 0, F.element_at(ratios, -1).cast("int"))


def slot_key(label: Column) -> Column:
    return F.translate(label, "①②③④", "1234")


def parse_take(text: Column) -> Column:
    """name and number of "Name=10", split at the last = (F-39)."""
    return F.struct(F.regexp_extract(text, r"^(.+)=(\d+)$", 1).alias("name"), F.regexp_extract(text, r"^(.+)=(\d+)$", 2).cast("int").alias("n"))
