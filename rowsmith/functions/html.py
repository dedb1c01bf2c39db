"""Pages: text, links and addresses in Arrow batches over the standard parser."""

from __future__ import annotations

import json
import re
import unicodedata
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

_SKIP = frozenset("script style nav footer header aside noscript".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.hidden, self.text, self.metas, self.links, self.jsonld = 0, [], [], [], []
        self.anchor: list | None = None
        self.ld = False

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "meta" and (a.get("property") or a.get("name") or "").lower() in ("og:title", "og:description", "description") and a.get("content"):
            self.metas.append(a["content"])
        if tag == "script" and (a.get("type") or "").lower() == "application/ld+json":
            self.ld = True
        if tag == "a" and a.get("href"):
            self.anchor = [a["href"], ""]
            self.links.append(self.anchor)
        if tag in _SKIP and tag not in _VOID:
            self.hidden += 1

    def handle_endtag(self, tag):
        if tag == "a":
            self.anchor = None
        if tag == "script":
            self.ld = False
        if tag in _SKIP and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if self.ld:
            self.jsonld.append(data)
        if self.anchor is not None:
            self.anchor[1] += data
        if not self.hidden:
            self.text.append(data)


def parse(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    page.close()
    return page


def text_of(html: str | None) -> str:
    """Descriptions of the head, then the body's text without navigation; white space collapsed."""
    page = parse(html)
    return re.sub(r"\s+", " ", " ".join([*page.metas, " ".join(page.text)])).strip()


def links_of(html: str | None, base: str | None, words: list[str], most: int) -> list[str]:
    """Links of the page's own host with one of ``words`` in address or text, distinct, ``most`` at most (the operator's cap)."""
    out: list[str] = []
    home = urlsplit(base or "").netloc.lower()
    for href, label in parse(html).links:
        url = urljoin(base or "", href).split("#")[0]
        if urlsplit(url).netloc.lower() == home and url not in out and any(w in (url + " " + label).lower() for w in words):
            out.append(url)
    return out[:most]


def jsonld_address(html: str | None) -> str | None:
    """First address found depth-first in the page's linked data."""
    for block in parse(html).jsonld:
        try:
            stack = [json.loads(block)]
        except ValueError:
            continue
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += node
            elif isinstance(node, dict):
                a = node.get("address")
                if isinstance(a, dict) and a.get("streetAddress"):
                    parts = [a.get(k) for k in ("streetAddress", "addressLocality", "addressRegion", "postalCode")]
                    return ", ".join(str(p).strip() for p in parts if p)
                stack += list(node.values())
    return None


def fold(value: str | None) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", (value or "").lower()) if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def page_text(html: pd.Series) -> pd.Series:
    return html.map(text_of)


@F.pandas_udf(StringType())
def page_address(html: pd.Series) -> pd.Series:
    return html.map(jsonld_address)


@F.pandas_udf(StringType())
def fold_accents(value: pd.Series) -> pd.Series:
    return value.map(fold)


def page_links(words: list[str], most: int = 200):
    @F.pandas_udf(ArrayType(StringType()))
    def run(html: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([links_of(h, b, words, most) for h, b in zip(html, base)])

    return run
