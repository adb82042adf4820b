"""Facts of HTML pages, parsed once per page; every later operator works on the columns.

One pass of the standard parser over each page of an Arrow batch gives title, headings with the text of their
section, links, images, metadata, and JSON-LD. Pages are taken whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.reasons import score

SCHEMA = """
title string, h1 string, main_text string, all_text string, has_form boolean,
metas map<string,string>, jsonld array<string>,
headings array<struct<pos:int,level:int,text:string,section:string,href:string>>,
anchors array<struct<pos:int,href:string,text:string,near:int>>,
images array<struct<pos:int,src:string,alt:string,in_header:boolean,width:string,height:string>>,
icons array<string>, times array<struct<value:string,near:int>>,
beside array<string>
"""
# fixed values: elements without a closing tag, and those whose text is none of the page's
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MUTE = frozenset("script style noscript svg template".split())
# fixed values: words that make a heading one of a role, and headings that are none
ROLE_WORDS = "architect designer draftsman draughtsman draughtsperson engineer coordinator manager officer visualizer visualiser planner intern surveyor modeler modeller artist lead head".split()
PLAIN_HEADINGS = frozenset(("application", "apply", "open positions", "open position", "current openings", "current opening", "requirements", "responsibilities", "qualification", "qualifications", "benefits", "about us", "careers", "career", "contact", "get in touch", "documents"))
ROLE = re.compile(r"\b(?:" + "|".join(ROLE_WORDS) + r")\b")
APPLY_LABELS = frozenset(("application", "application form", "apply now", "documents"))


def squash(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def names_role(text: str) -> bool:
    low = text.lower().strip(" :-|")
    return bool(text) and len(text) <= 180 and low not in PLAIN_HEADINGS and bool(ROLE.search(low))


class PageParser(HTMLParser):
    """Collects the facts of one page while the parser walks it."""

    def __init__(self, url: str) -> None:
        super().__init__(convert_charrefs=True)
        self.url = url
        self.stack: list[str] = []
        self.parts: list[tuple[str, tuple[str, ...]]] = []
        self.open: list[dict] = []
        self.facts: dict = {"title": "", "has_form": False, "metas": {}, "jsonld": [], "headings": [], "anchors": [], "images": [], "icons": [], "times": [], "beside": []}
        self.events: list[tuple[str, object]] = []

    def join(self, href: str | None) -> str:
        try:
            return urljoin(self.url, href or "")
        except ValueError:
            return href or ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        f = self.facts
        if tag == "meta":
            key = (a.get("property") or a.get("name") or a.get("itemprop") or a.get("http-equiv") or "").lower()
            if key and key not in f["metas"]:
                f["metas"][key] = a.get("content", "")
        elif tag == "link" and "icon" in a.get("rel", "").lower():
            f["icons"].append(self.join(a.get("href")))
        elif tag == "img":
            f["images"].append({"pos": len(f["images"]), "src": self.image(a), "alt": a.get("alt", ""), "in_header": "header" in self.stack, "width": a.get("width", ""), "height": a.get("height", "")})
        elif tag == "form":
            f["has_form"] = True
            self.events.append(("form", None))
        if tag in VOID:
            return
        self.stack.append(tag)
        node = {"tag": tag, "attrs": a, "start": len(self.parts), "raw": []}
        self.open.append(node)
        if re.fullmatch(r"h[1-6]", tag):
            node["event"] = len(self.events)
            self.events.append(("heading", node))

    def image(self, a: dict) -> str:
        """The largest of a source set, the last of equal ones, else the first of the usual attributes that is an address."""
        best, weight = "", -1.0
        for part in (a.get("srcset") or a.get("data-srcset") or "").split(","):
            bits = part.split()
            if bits:
                m = re.fullmatch(r"([\d.]+)([wx])", bits[1], re.I) if len(bits) > 1 else None
                try:
                    w = float(m[1]) * (1000 if m[2].lower() == "x" else 1) if m else 0.0
                except ValueError:
                    w = 0.0
                if w >= weight:
                    best, weight = bits[0], w
        if best:
            return self.join(best)
        return next((self.join(a[k]) for k in ("data-src", "data-lazy-src", "data-original", "src") if a.get(k) and not a[k].lower().startswith("data:")), "")

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.stack:
            return
        while self.stack:
            top, node = self.stack.pop(), self.open.pop()
            self.close_node(top, node)
            if top == tag:
                return

    def text_from(self, start: int) -> str:
        return squash(" ".join(t for t, path in self.parts[start:] if not MUTE & set(path)))

    def parent(self) -> int | None:
        """The place in ``beside`` of the innermost open element, whose whole text is set when it closes; each is kept once, however many links are in it."""
        if not self.open:
            return None
        node = self.open[-1]
        if "beside" not in node:
            node["beside"] = len(self.facts["beside"])
            self.facts["beside"].append("")
        return node["beside"]

    def close_node(self, tag: str, node: dict) -> None:
        f = self.facts
        if tag == "title" and not f["title"]:
            f["title"] = squash(" ".join(node["raw"]))
        elif tag == "script" and "ld+json" in node["attrs"].get("type", "").lower():
            f["jsonld"].append("".join(node["raw"]))
        elif tag == "a":
            f["anchors"].append({"pos": len(f["anchors"]), "href": self.join(node["attrs"].get("href")), "text": self.text_from(node["start"]), "near": self.parent()})
            for up in reversed(self.open):
                if re.fullmatch(r"h[1-6]", up["tag"]):
                    up["href"] = self.join(node["attrs"].get("href"))
        elif tag == "time":
            f["times"].append({"value": node["attrs"].get("datetime") or self.text_from(node["start"]), "near": self.parent()})
        elif "event" in node:
            node["text"] = self.text_from(node["start"])
        if "beside" in node:
            f["beside"][node["beside"]] = self.text_from(node["start"])

    def handle_data(self, data: str) -> None:
        if self.open:
            self.open[-1]["raw"].append(data)
        if data.strip():
            self.parts.append((data, tuple(self.stack)))
            self.events.append(("text", (data, tuple(self.stack))))

    def finish(self) -> dict:
        while self.stack:
            self.close_node(self.stack.pop(), self.open.pop())
        f = self.facts
        seen = [(t, set(p)) for t, p in self.parts]
        within = lambda tag: squash(" ".join(t for t, p in seen if tag in p and not MUTE & p))
        f["all_text"] = squash(" ".join(t for t, p in seen if not MUTE & p))
        f["main_text"] = within("main") or within("article") or within("body") or f["all_text"]
        for at, (kind, node) in enumerate(self.events):
            if kind == "heading":
                f["headings"].append({"pos": len(f["headings"]), "level": int(node["tag"][1]), "text": node.get("text", ""), "section": self.section(at, node.get("text", "")), "href": node.get("href", "")})
        f["h1"] = next((h["text"] for h in f["headings"] if h["level"] == 1 and h["text"]), "")
        return f

    def section(self, at: int, title: str) -> str:
        """The text from a heading to the next heading of a role, a form, or the label of an application form."""
        parts, known = ([title], {title.lower()}) if title else ([], set())
        for kind, node in self.events[at + 1 :]:
            if kind == "form" or kind == "heading" and names_role(node.get("text", "")):
                break
            if kind == "text":
                data, path = node
                value = squash(data)
                if not value or MUTE & set(path) or value.lower() in known:
                    continue
                if value.lower().strip(" :-|") in APPLY_LABELS and len(parts) > 1:
                    break
                known.add(value.lower())
                parts.append(value)
        return " ".join(parts)


def parse_page(url: str, html: str) -> dict:
    p = PageParser(url or "")
    p.feed(html or "")
    p.close()
    return p.finish()


def page_facts(pages: DataFrame, url: str, html: str) -> DataFrame:
    """The pages' other columns and their facts; a page without HTML has empty facts."""
    kept = ", ".join(f"`{c}` {t}" for c, t in pages.dtypes if c != html)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            facts = pd.DataFrame([parse_page(u, h) for u, h in zip(b[url], b[html], strict=True)], columns=["title", "h1", "main_text", "all_text", "has_form", "metas", "jsonld", "headings", "anchors", "images", "icons", "times", "beside"])
            yield pd.concat([b.drop(columns=[html]).reset_index(drop=True), facts], axis=1)

    return pages.mapInPandas(run, f"{kept}, {SCHEMA}")


def first_filled(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(v), F.lit("")) for v in values], F.lit(""))


def page_title(facts: DataFrame) -> Column:
    return first_filled(facts["h1"], facts["metas"]["og:title"], facts["title"])


def links(facts: DataFrame, key: str) -> DataFrame:
    """(key, pos, href, text, near) of every link."""
    near = F.coalesce(F.get("beside", F.col("a.near")), F.lit("")).alias("near")
    return facts.select(key, "beside", F.explode("anchors").alias("a")).select(key, "a.pos", "a.href", "a.text", near)


def role_headings(facts: DataFrame, key: str) -> DataFrame:
    """(key, pos, title, section, href): the headings that name a role, the first of each title of a page."""
    h = facts.select(key, F.explode("headings").alias("h")).select(key, "h.*")
    roles = h.where(F.col("level").between(1, 6) & (F.length("text") <= 180) & ~F.lower(F.trim("text")).isin(sorted(PLAIN_HEADINGS)) & F.lower("text").rlike(ROLE.pattern))
    first = roles.groupBy(key, F.lower("text").alias("low")).agg(F.min_by(F.struct("pos", "text", "section", "href"), "pos").alias("h"))
    return first.select(key, "h.pos", F.col("h.text").alias("title"), "h.section", "h.href")


# fixed values: points of an image as a logo, by a pattern over its address or label, and for its place and size
LOGO_POINTS = (
    (22, "src", "logo"),
    (35, "label", "logo|brand|company"),
    (12, "src", r"\.svg$"),
    (-55, "src", "favicon|apple-touch-icon"),
    (-45, "src", r"(?:^|[,?&_/])w=?(?:16|24|32)(?:[,?&_/]|$)"),
    (-45, "src", r"(?:^|[,?&_/])h=?(?:16|24|32)(?:[,?&_/]|$)"),
)
LOGO_IN_HEADER, LOGO_SMALL, LOGO_SMALL_SIDE = 18, -30, 40


def logo_score(src: Column, label: Column, in_header: Column, width: Column, height: Column) -> Column:
    """The sum of the points in the tables that an image earns."""
    fields = {"src": F.lower(F.coalesce(src, F.lit(""))), "label": F.lower(F.coalesce(label, F.lit("")))}
    small = lambda side: F.coalesce(F.regexp_replace(side, r"\D", "").try_cast("int") <= LOGO_SMALL_SIDE, F.lit(False))
    earned = [(n, fields[f].rlike(p)) for n, f, p in LOGO_POINTS] + [(LOGO_IN_HEADER, F.coalesce(in_header, F.lit(False))), (LOGO_SMALL, small(width)), (LOGO_SMALL, small(height))]
    return score(earned)


def logos(facts: DataFrame, key: str) -> DataFrame:
    """(key, logo): the image of the highest score that looks like a logo, the first of equal ones, else the first icon."""
    i = facts.select(key, F.explode("images").alias("i")).select(key, "i.*").where("src <> ''")
    scored = i.withColumn("score", logo_score(F.col("src"), F.col("alt"), F.col("in_header"), F.col("width"), F.col("height")))
    best = scored.where(F.lower(F.concat_ws(" ", "src", "alt")).rlike("logo|brand")).groupBy(key).agg(F.max_by("src", F.struct("score", F.expr("-pos"))).alias("logo"))
    plain = facts.select(key, F.get("icons", F.lit(0)).alias("icon"))
    return plain.join(best, key, "left").select(key, F.regexp_replace(F.coalesce("logo", "icon", F.lit("")), r"(?i)/cdn-cgi/image/[^/]+/", "/").alias("logo"))


# fixed values: words of links that lead to vacancies
JOB_HINTS = ("job", "jobs", "career", "careers", "opening", "openings", "vacancy", "vacancies", "position", "positions", "opportunity", "opportunities", "recruit")


def job_links(facts: DataFrame, key: str, roles: str, blocked: tuple[str, ...] = (), most: int = 30) -> DataFrame:
    """(key, pos, link, text): links whose own words name a role, or that hint at jobs beside words of a role; the first of each address, at most so many of a page."""
    from ..functions import urls
    from ..operators.keyed import cap, first_wins

    a = links(facts, key).where(~F.lower("href").rlike(r"^(?:javascript|mailto|tel):") & (F.col("href") != "")).withColumn("link", urls.canonical_url(F.col("href")))
    context = F.lower(F.concat_ws(" ", "text", "near", "link"))
    fits = F.lower("text").rlike(roles) | (context.rlike("|".join(JOB_HINTS)) & F.lower("near").rlike(roles))
    kept = a.where(fits & (F.col("link") != "") & (urls.blocked_reason(F.col("link"), blocked) == "")).select(key, "pos", "link", "text")
    return cap(first_wins(kept, [key, "link"], [F.col("pos")]), [key], [F.col("pos")], most)


def board_links(facts: DataFrame, key: str) -> DataFrame:
    """(key, provider, board): boards of applicant-tracking systems that a page links or redirects to, each once."""
    from ..functions import urls

    refresh = F.regexp_extract(F.coalesce(F.col("metas")["refresh"], F.lit("")), r"(?i)url=['\"]?([^'\"]+)", 1)
    found = facts.select(key, F.explode(F.concat(F.transform("anchors", lambda a: a["href"]), F.array(refresh))).alias("__link")).withColumn("provider", urls.ats_provider(F.col("__link")))
    return found.where("provider <> ''").select(key, "provider", urls.ats_board_root(F.col("__link")).alias("board")).distinct()


def apply_route(facts: DataFrame, url: str, open_terms: tuple[str, ...] = ("apply", "send your", "we are hiring", "vacancy", "open position")) -> DataFrame:
    """(url, route, method, email): the first link to apply, else the page's form, else the best address, where the page is open for applications."""
    from ..functions import contacts, urls

    is_apply = lambda a: ~F.lower(a["href"]).startswith("mailto:") & (F.lower(a["text"]).rlike("apply|submit application|send cv|send resume") | (F.lower(a["href"]).contains("apply") & F.lower(F.get("beside", a["near"])).contains("apply")))
    first = urls.canonical_url(F.get(F.filter("anchors", is_apply), F.lit(0))["href"])
    mails = F.transform(F.filter("anchors", lambda a: F.lower(a["href"]).startswith("mailto:")), lambda a: F.regexp_replace(a["href"], r"(?i)^mailto:|\?.*$", ""))
    email = contacts.best_email(F.concat_ws(" ", F.array_join(mails, " "), "all_text"))
    is_open = F.lower("all_text").rlike("|".join(open_terms))
    route = F.when(first != "", first).when(F.col("has_form") & is_open, urls.canonical_url(F.col(url))).when((email != "") & is_open, F.concat(F.lit("mailto:"), email)).otherwise("")
    method = F.when(first != "", "Apply Link").when(F.col("has_form") & is_open, "Public Form").when((email != "") & is_open, "Email").otherwise("")
    return facts.select(url, route.alias("route"), method.alias("method"), email.alias("email"))


def posted_date(facts: DataFrame) -> Column:
    """When a page was posted: its metadata, a time beside the word, or the text."""
    from ..functions import dates

    metas = [dates.parse_date(facts["metas"][k]) for k in ("article:published_time", "date", "dateposted")]
    near = F.filter(facts["times"], lambda t: F.lower(F.get(facts["beside"], t["near"])).rlike("posted|published"))
    return F.coalesce(*metas, dates.parse_date(F.get(near, F.lit(0))["value"]), dates.labelled_date(facts["all_text"], dates.POSTED_LABELS))
