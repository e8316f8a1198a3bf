"""Functions for queries written as SQL: register(spark) (F-06, F-11, F-15, F-23, F-24, F-26, F-27).

The Column functions of functions/text.py and operators/evals.py are expressions and have no name in SQL. These are
their twins on Arrow batches, in Python's regular expressions over the same patterns.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from tessera.operators.evals import ARROWS, CIRCLED, HELD, MARKS, NO, STATE, WINDOW, YES


def strip_html(raw: str | None) -> str:
    """Tags to spaces, references decoded, blanks collapsed, at most one blank line."""
    text = html.unescape(re.sub("<[^>]+>", " ", raw or ""))
    return re.sub("\n{3,}", "\n\n", re.sub("[ \t\xa0]+", " ", text)).strip()


def slug(text: str | None, most: int | None = None) -> str | None:
    """Lower-case letters, digits and Hangul with hyphens between, of the NFC form; cut at a hyphen past half of most."""
    if text is None:
        return None
    found = re.sub("[^0-9a-z가-힣ㄱ-ㅎㅏ-ㅣ]+", "-", unicodedata.normalize("NFC", text).lower()).strip("-")
    if most is None or len(found) <= most:
        return found
    at = found[: most + 1].rfind("-")
    return (found[:at] if at >= max(most // 2, 0) and at >= 0 else found[:most]).strip("-")


def _link(value: str) -> str:
    return f"[[{re.sub('[|#]', ' ', value.replace('[[', '').replace(']]', '')).strip()}]]"


def note_body(summary: str, tags: list[str], companies: list[str], source: str, url: str) -> str:
    """Markdown body of a note. The headings are fixed values."""
    links = [f"- {_link(x)}" for x in [*tags, *(c for c in companies if c)]] or ["- (없음)"]
    lines = "\n".join(links)
    return f"## 요약\n\n{summary.strip()}\n\n## 관련 개념\n\n{lines}\n\n## 원문\n\n[{source}에서 보기]({url})\n"


def _first_of_each(rationale: str | None, read: Callable[[str], str | None]) -> list[str | None]:
    """Of each of the four slots the first reading that is not null."""
    text, got = rationale or "", [None] * 4
    marks = list(re.finditer(MARKS, text))
    for m, after in zip(marks, [*marks[1:], None]):
        k = next(int(c) for c in m[0].translate(str.maketrans(CIRCLED, "1234")) if c in "1234") - 1
        if got[k] is None:
            got[k] = read(re.split(ARROWS, text[m.end() : after.start() if after else None], maxsplit=1)[0][:WINDOW])
    return got


def slot_verdicts(rationale: str | None) -> list[str | None]:
    """yes / no / null of the four slots."""
    return _first_of_each(rationale, lambda t: "no" if re.search(NO, t) else "yes" if re.search(YES, t) else None)


def _state(text: str) -> str | None:
    found = re.search(STATE, text)
    token = found[0] if found else None
    return None if token is None else "excluded" if token.startswith("분모") else {"부분": "partial", "충족": "full"}.get(token, "none")


def slot_states(rationale: str | None) -> list[str | None]:
    """full / partial / none / excluded / null of the four slots."""
    return _first_of_each(rationale, _state)


def _elements(text: str, pick: int) -> str:
    found = {e: re.findall(rf"\({e}\)\s*({HELD})", text) for e in "abc"}
    return ";".join(f"{e}={v[pick]}" for e, v in found.items() if v)


def element_verdicts(rationale: str | None) -> list[str | None]:
    """a=..;b=..;c=.. of the four slots, null without elements; the last verdict on an element counts."""
    return _first_of_each(rationale, lambda t: _elements(t, -1) or None)


def parsed_elements(rationale: str | None, sizes: list[int]) -> str:
    """Strict reading: ok:<elements of the slots>, or error:<what is wrong first>."""
    text = rationale or ""
    if not text.strip():
        return "error:empty"
    if any(text.count(mark) > 1 for mark in CIRCLED):
        return "error:slot twice"
    right = []
    for k, (mark, n) in enumerate(zip(CIRCLED, sizes), 1):
        own = re.search(f"{mark}([^{CIRCLED}]*)", text)
        if n <= 0:
            right.append("")
            continue
        if not own:
            return f"error:slot {k} missing"
        found = {e: re.findall(rf"\({e}\)\s*({HELD})", own[1]) for e in "abc"}
        if any(len(set(v)) > 1 for v in found.values()):
            return f"error:slot {k} contradicts itself"
        if [e for e, v in found.items() if v] != list("abc"[: min(n, 3)]):
            return f"error:slot {k} has other elements than its label"
        right.append(_elements(own[1], 0))
    return "ok:" + "|".join(right)


#: Rows of which a worker makes Python values at a time.
ROWS = 64


def _each(f: Callable, kind: str) -> Callable:
    """f of each row, on Arrow arrays in slices of ROWS: a batch of whole texts is held as Arrow alone."""
    to = to_arrow_type(DataType.fromDDL(kind))

    def run(*columns: pa.Array) -> pa.Array:
        slices = ([c.slice(at, ROWS).to_pylist() for c in columns] for at in range(0, len(columns[0]), ROWS))
        parts = [pa.array([f(*row) for row in zip(*own, strict=True)], to) for own in slices]
        return pa.concat_arrays(parts) if parts else pa.array([], to)

    return run


def register(spark: SparkSession, prefix: str = "") -> None:
    """Name the functions in the session: strip_html, slug, note_body, slot_verdicts, slot_states, element_verdicts, parsed_elements."""

    def body_of(s: str | None, tags: list | None, companies: list | None, source: str | None, url: str | None) -> str | None:
        return None if None in (s, source, url) else note_body(s, tags or [], companies or [], source, url)

    def parsed_of(rationale: str | None, sizes: list | None) -> str:
        return parsed_elements(rationale, sizes or [])

    for name, f, kind in (("strip_html", strip_html, "string"), ("slug", slug, "string"), ("note_body", body_of, "string"), ("slot_verdicts", slot_verdicts, "array<string>"),
                          ("slot_states", slot_states, "array<string>"), ("element_verdicts", element_verdicts, "array<string>"), ("parsed_elements", parsed_of, "string")):
        spark.udf.register(prefix + name, F.arrow_udf(_each(f, kind), kind))
