"""Result cards of search pages, by a table of the marks that each search site puts on its cards."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls

# fixed values: class of a card, of its link ('' for the first link) and of its snippet ('' for the first paragraph), by site
SITES = {"Bing": ("b_algo", "", ""), "DuckDuckGo": ("result", "result__a", "result__snippet")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class CardParser(HTMLParser):
    """Collects (href, title, snippet) of every card; cards do not nest."""

    def __init__(self, card: str, link: str, snippet: str) -> None:
        super().__init__(convert_charrefs=True)
        self.marks = card, link, snippet
        self.depth, self.card_at, self.into, self.into_at = 0, None, None, None
        self.cards: list[dict] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            return
        self.depth += 1
        a = {k: v or "" for k, v in attrs}
        classes = a.get("class", "").split()
        card, link, snippet = self.marks
        if self.card_at is None:
            if card in classes:
                self.card_at = self.depth
                self.cards.append({"href": "", "title": "", "snippet": ""})
            return
        now = self.cards[-1]
        if self.into is None and tag == "a" and a.get("href") and not now["href"] and (not link or link in classes):
            now["href"], self.into, self.into_at = a["href"], "title", self.depth
        elif self.into is None and not now["snippet"] and (snippet in classes if snippet else tag == "p"):
            self.into, self.into_at = "snippet", self.depth

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if self.into_at == self.depth:
            self.into = self.into_at = None
        if self.card_at == self.depth:
            self.card_at = None
        self.depth -= 1

    def handle_data(self, data: str) -> None:
        if self.into:
            self.cards[-1][self.into] += data + " "


def result_cards(pages: DataFrame, query: str, body: str, site: str, most: int = 20) -> DataFrame:
    """(query, pos, title, url, snippet) of the cards that lead somewhere, at most so many of a page; redirects are undone. A page without cards, or null, gives none."""
    kind = dict(pages.dtypes)[query]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for q, text in zip(b["q"], b["body"], strict=True):
                p = CardParser(*SITES[site])
                p.feed(text or "")
                p.close()
                found = [c for c in p.cards if c["href"]][:most]
                rows += [(q, n, " ".join(c["title"].split()), c["href"], " ".join(c["snippet"].split())) for n, c in enumerate(found)]
            yield pd.DataFrame(rows, columns=["q", "pos", "title", "url", "snippet"])

    cards = pages.select(F.col(query).alias("q"), F.col(body).alias("body")).mapInPandas(run, f"q {kind}, pos int, title string, url string, snippet string")
    return cards.select(F.col("q").alias(query), "pos", "title", urls.unwrap_redirect(F.col("url")).alias("url"), "snippet")
