"""HTML extraction with the standard parser, batch-wise over Arrow."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Labels of a detail page and the fields they fill.
LABELS = {
    "organization name": "organization_name", "year": "year", "award programs": "award_programs", "award": "award", "category": "category", "category group": "category_group",
    "industry": "industry", "city": "city", "state/province": "state_province", "country": "country", "submitting agency": "submitting_agency", "notes": "notes",
}
DETAIL = T.StructType([T.StructField(c, T.StringType()) for c in ("nomination_title", *LABELS.values())])
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: Elements that hold no content of the page.
_SKIPPED = {"script", "style", "nav", "footer", "header", "noscript"}


class _Tree(HTMLParser):
    """Runs callbacks on elements with their text; enough for tables, headings and marked blocks."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[dict] = []
        self.done: list[dict] = []

    def handle_starttag(self, tag, attrs):
        node = {"tag": tag, "attrs": {k: v or "" for k, v in attrs}, "text": [], "order": len(self.done) + len(self.open), "parents": [n["tag"] for n in self.open]}
        node["ids"] = [n["order"] for n in self.open]
        if tag in _VOID:
            self.done.append(node)
        else:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k]["tag"] == tag:
                self.done += self.open[k:]
                del self.open[k:]
                return

    def handle_data(self, data):
        for n in self.open:
            n["text"].append(data)

    def nodes(self) -> list[dict]:
        return sorted(self.done + self.open, key=lambda n: n["order"])


def _parsed(html: str | None) -> list[dict]:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    for k, n in enumerate(nodes := tree.nodes()):
        n["place"] = k
    return nodes


def _text(node: dict, glue: str = "") -> str:
    parts = [t.strip() for t in node["text"]]
    return glue.join(p for p in parts if p)


def detail_of(html: str | None) -> dict[str, str | None]:
    """Fields of a detail page: the first heading of the most specific level, and rows of two cells."""
    nodes = _parsed(html)
    out: dict[str, str | None] = dict.fromkeys(("nomination_title", *LABELS.values()))
    for level in ("h5", "h4", "h3"):
        heading = next((n for n in nodes if n["tag"] == level), None)
        if heading is not None:
            out["nomination_title"] = _text(heading)
            break
    for row in (n for n in nodes if n["tag"] == "tr" and "table" in n["parents"]):
        cells = [n for n in nodes if n["tag"] in ("td", "th") and row["order"] in n["ids"] and "tr" in n["parents"] and n["ids"][max(k for k, t in enumerate(n["parents"]) if t == "tr")] == row["order"]]
        if len(cells) >= 2:
            field = LABELS.get(_text(cells[0]).lower().rstrip(":").strip())
            if field:
                out[field] = _text(cells[1])
    return out


@F.pandas_udf(DETAIL)
def parse_detail(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([detail_of(h) for h in html], columns=["nomination_title", *LABELS.values()])


def post_of(html: str | None) -> dict:
    """Title, author, text and absolute links of an article page."""
    nodes = _parsed(html)
    meta = lambda key, name: next((n["attrs"].get("content", "").strip() or None for n in nodes if n["tag"] == "meta" and n["attrs"].get(key) == name), None)
    marked = next((n for n in nodes if n["attrs"].get("id") == "hs_cos_wrapper_name"), None)
    body = next((n for n in nodes if "post-body" in n["attrs"].get("class", "").split()), None)
    links = {n["attrs"].get("href", "") for n in nodes if body is not None and n["tag"] == "a" and body["order"] in n["ids"]}
    return {
        "title": (_text(marked) if marked is not None else "") or meta("property", "og:title"),
        "author": meta("name", "author"),
        "clean_text": re.sub(r"\s+", " ", _text(body, " ")).strip() if body is not None else "",
        "links": sorted(u for u in links if u.startswith(("http://", "https://"))),
    }


@F.pandas_udf(T.StructType([*(T.StructField(c, T.StringType()) for c in ("title", "author", "clean_text")), T.StructField("links", T.ArrayType(T.StringType()))]))
def parse_post(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([post_of(h) for h in html], columns=["title", "author", "clean_text", "links"])


#: Elements whose text is never shown.
_SILENT = {"script", "style", "noscript", "template"}


class _Main(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.held: list[tuple[str, list[str]]] = []  # elements to skip that are open, with the text inside

    def handle_starttag(self, tag, attrs):
        if tag in _SKIPPED:
            self.held.append((tag, []))

    def handle_endtag(self, tag):
        at = next((k for k in range(len(self.held) - 1, -1, -1) if self.held[k][0] == tag), None)
        if at is not None:
            del self.held[at:]

    def handle_data(self, data):
        (self.held[-1][1] if self.held else self.out).append(data)

    def close(self):
        super().close()
        # furniture that is never closed is none: its text counts
        self.out += [t for tag, texts in self.held if tag not in _SILENT for t in texts]


def main_text(html: str | None) -> str:
    """Text outside scripts, styles and page furniture, white space collapsed."""
    p = _Main()
    p.feed(html or "")
    p.close()
    return " ".join(" ".join(p.out).split())


@F.pandas_udf(T.StringType())
def html_to_text(html: pd.Series) -> pd.Series:
    return html.map(main_text)


def listing_ids(html: Column) -> Column:
    """Numeric ``rel`` of every link of a listing page, in order."""
    anchors = F.regexp_extract_all(html, F.lit(r"(<a\b[^>]*\ba-view-past-winner-details\b[^>]*>)"), 1)
    return F.filter(F.transform(anchors, lambda a: F.regexp_extract(a, r"""\brel=["']?(\d+)["'\s>]""", 1)), lambda i: i != "")


def has_captcha(html: Column) -> Column:
    return html.contains('name="captcha_response"')
