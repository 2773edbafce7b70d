"""URL policy, page compliance, page structure, chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.probing import strip
from ..functions.scores import page_quality, pattern_hits

# --- URL policy ---------------------------------------------------------------------


def domain_of(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def bare_domain(domain: Column) -> Column:
    return F.regexp_replace(domain, r"^www\.", "")


def domain_suffixes(domain: Column) -> Column:
    """The domain and its parents, without the top level, the longest first."""
    parts = F.split(domain, r"\.")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, i, n), "."))


def validated(urls: DataFrame, policy: DataFrame, require_https: bool = True) -> DataFrame:
    """``safety`` and ``reason`` of each url by policy rows (domain, verdict blocked or trusted, allowed_paths, blocked_paths).

    The longest suffix that the policy names decides; an unknown domain is not valid.
    """
    rows = urls.withColumns({"domain": domain_of(F.col("url")), "path": F.coalesce(F.try_parse_url("url", F.lit("PATH")), F.lit("")), "scheme": F.try_parse_url("url", F.lit("PROTOCOL"))})
    suffix = rows.select("domain").distinct().withColumn("policy_domain", F.explode(domain_suffixes(bare_domain(F.col("domain")))))
    known = suffix.join(F.broadcast(policy.withColumnRenamed("domain", "policy_domain")), "policy_domain")  # the policy is a configuration
    verdict = F.max_by(F.struct("verdict", "allowed_paths", "blocked_paths"), F.struct((F.col("verdict") == "blocked").cast("int"), F.length("policy_domain")))
    rows = rows.join(known.groupBy("domain").agg(verdict.alias("p")), "domain", "left")
    starts = lambda paths: F.exists(paths, lambda x: F.col("path").startswith(x))
    barred = F.coalesce(starts(F.col("p.blocked_paths")), F.lit(False))
    outside = (F.size("p.allowed_paths") > 0) & ~F.coalesce(starts(F.col("p.allowed_paths")), F.lit(False))
    reason = (
        F.when(F.col("domain").isNull(), "invalid_url").when(F.lit(require_https) & (F.coalesce("scheme", F.lit("")) != "https"), "not_https").when(F.col("p.verdict") == "blocked", "domain_blocked")
        .when(F.col("p").isNull(), "unknown_domain").when(barred | outside, "path_restricted")
    )
    safety = F.when(reason.isNull(), "trusted").when(reason == "path_restricted", "restricted").when(reason == "unknown_domain", "unknown").otherwise("blocked")
    return rows.withColumns({"reason": reason, "safety": safety, "valid": reason.isNull()}).drop("p", "scheme")


def content_type(url: Column) -> Column:
    u = F.lower(url)
    has = lambda *keys: F.lit(False) if not keys else u.rlike("|".join(re.escape(k) for k in keys))
    return (
        F.when(has("/docs/", "documentation"), "documentation").when(has("/tutorial", "/learn"), "tutorial").when(has("/api", "/reference"), "api_reference").when(has("/blog/", "/posts/"), "blog_post")
        .when(has("stackoverflow.com", "github.com/discussions"), "forum_post").when(has("github.com"), "code_repository").otherwise("unknown")
    )


# --- compliance -----------------------------------------------------------------------

#: Signs of pages that may not be used, matched in lower-cased page text.
SIGNS = {
    "paywall": [
        r"subscribe\s+(?:now\s+)?to\s+(?:continue\s+)?read", r"sign\s+up\s+to\s+read", r"create\s+(?:a\s+)?free\s+account\s+to\s+continue",
        r"this\s+(?:article|content)\s+is\s+for\s+(?:premium\s+)?(?:subscribers|members)\s+only", r"unlock\s+this\s+(?:article|content)", r"(?:premium|subscriber)\s+(?:only|exclusive)\s+content",
        r"free\s+trial\s+to\s+continue\s+reading", r"article\s+limit\s+reached", r"you(?:'ve|\s+have)\s+reached\s+your\s+(?:free\s+)?(?:article|viewing)\s+limit", r"register\s+to\s+read\s+more",
        r"already\s+a\s+subscriber\?\s+(?:sign\s+)?in", r"(?:start\s+)?your\s+(?:free\s+)?(?:trial|subscription)", r"(?:only\s+)?\$\d+(?:\.\d+)?(?:\s*\/\s*(?:mo|month|year))",
        r"(?:get\s+)?unlimited\s+access\s+for", r"become\s+a\s+(?:premium\s+)?member",
    ],
    "login": [
        r"(?:please\s+)?(?:sign|log)\s*in\s+to\s+(?:continue|view|access)", r"you\s+must\s+be\s+logged\s+in", r"login\s+required", r"authentication\s+required",
        r"sign\s+in\s+with\s+(?:google|github|facebook|twitter)", r"create\s+an\s+account\s+to\s+continue", r"session\s+(?:has\s+)?expired",
    ],
    "captcha": [
        r"verify\s+you(?:'re|\s+are)\s+(?:a\s+)?human", r"complete\s+(?:the\s+)?captcha", r"recaptcha", r"hcaptcha", r"prove\s+you(?:'re|\s+are)\s+not\s+a\s+(?:robot|bot)", r"security\s+check", r"challenge\s+required",
    ],
    "rate_limit": [r"too\s+many\s+requests", r"rate\s+limit(?:ed)?", r"slow\s+down", r"try\s+again\s+(?:in\s+)?\d+\s+(?:seconds?|minutes?)", r"request\s+limit\s+exceeded", r"temporarily\s+blocked"],
    "access_denied": [r"403\s+forbidden", r"access\s+denied", r"you\s+don(?:'t|\s+not)\s+have\s+permission", r"unauthorized\s+access", r"blocked\s+by\s+(?:cloudflare|firewall)", r"ip\s+(?:address\s+)?(?:has\s+been\s+)?blocked"],
    "scraping_blocked": [r"automated\s+(?:access|requests?)\s+(?:detected|blocked)", r"bot\s+(?:detected|blocked)", r"scraping\s+(?:is\s+)?(?:not\s+)?allowed", r"please\s+use\s+(?:our\s+)?api", r"disable\s+(?:your\s+)?(?:ad\s*)?blocker"],
    "copyright": [r"all\s+rights\s+reserved", r"(?:no\s+)?reproduction\s+(?:is\s+)?permitted", r"(?:do\s+not|cannot)\s+(?:copy|reproduce|distribute)", r"protected\s+by\s+copyright", r"proprietary\s+(?:and\s+)?confidential"],
    "adult": [r"(?:18\+|21\+)\s+only", r"adult\s+content", r"(?:explicit|mature)\s+(?:material|content)", r"must\s+be\s+(?:18|21)\s+(?:years?\s+old|or\s+older)", r"age\s+verification\s+required"],
}
#: Violations that bar a page; the others warn.
BARRING = ("paywall", "login", "captcha", "rate_limit", "access_denied", "scraping_blocked", "adult", "legal", "http_error")


def violations(html: Column, text: Column, status: Column, headers: Column | None = None) -> Column:
    """The violations that a page shows, in a fixed order."""
    all_text = F.lower(F.concat_ws("\n", html, text))
    counted = sum((F.least(F.lit(2), F.regexp_count(all_text, F.lit(p))) for p in SIGNS["paywall"]), F.lit(0))
    hits = {k: pattern_hits(all_text, v) for k, v in SIGNS.items() if k not in ("paywall", "copyright")}
    limited = hits["rate_limit"] > 0
    if headers is not None:
        limited = limited | F.coalesce(F.try_element_at(headers, F.lit("x-ratelimit-remaining")) == "0", F.lit(False))
    low = page_quality(text) < 0.3
    return F.array_compact(F.array(
        F.when(status == 401, "login").when(status == 403, "access_denied").when(status == 429, "rate_limit").when(status == 451, "legal").when(status >= 400, "http_error"),
        F.when(counted * 0.3 >= 0.7, "paywall"), F.when(hits["login"] * 0.35 >= 0.7, "login"), F.when((hits["captcha"] > 0) | F.lower(html).rlike(r"""(?:id|class)=["'](?:g-recaptcha|h-captcha|captcha|cf-challenge|challenge-form)"""), "captcha"),
        F.when(limited, "rate_limit"), F.when(hits["scraping_blocked"] > 0, "scraping_blocked"), F.when(hits["access_denied"] > 0, "access_denied"), F.when(hits["adult"] > 0, "adult"), F.when(low, "low_quality"),
    ))


def compliance(pages: DataFrame, allow: list[str] | None = None, block: list[str] | None = None, strict: bool = False, flag_copyright: bool = False) -> DataFrame:
    """``violations``, ``verdict`` and ``confidence`` of pages (url, html, text, http_status)."""
    found = violations(F.col("html"), F.col("text"), F.col("http_status"), F.col("headers") if "headers" in pages.columns else None)
    body = F.concat_ws("\n", "html", "text")
    if block:
        found = F.when(body.rlike("(?i)" + "|".join(f"(?:{b})" for b in block)), F.concat(found, F.array(F.lit("malicious")))).otherwise(found)
    if flag_copyright:
        found = F.when(pattern_hits(F.lower(body), SIGNS["copyright"]) > 0, F.concat(found, F.array(F.lit("copyright")))).otherwise(found)
    found = F.array_distinct(found)
    if allow:
        found = F.when(body.rlike("(?i)" + "|".join(f"(?:{a})" for a in allow)), F.filter(found, lambda v: v.isin("malicious", "adult"))).otherwise(found)
    barred = F.arrays_overlap("violations", F.array(*map(F.lit, (*BARRING, "malicious"))))
    verdict = F.when(barred, "blocked").when(F.size("violations") > 0, "blocked" if strict else "warning").otherwise("compliant")
    return pages.withColumn("violations", found).withColumns({"verdict": verdict, "confidence": F.greatest(F.lit(0.0), 1 - 0.1 * F.size("violations"))})


# --- structure --------------------------------------------------------------------------

PAGE = (
    "title string, description string, sections array<struct<path:string,level:int,heading:string,content:string>>, code_blocks array<struct<language:string,code:string,context:string>>, "
    "links array<struct<text:string,href:string>>, text string, markdown string"
)
_SKIP = {"script", "style", "noscript", "template", "nav", "footer", "header", "aside", "iframe", "svg", "form"}
#: Classes and ids of navigation, footers, side bars, advertisements, comments, sharing, consent and pop-ups.
BOILERPLATE_CLASSES = frozenset(
    "nav navbar navigation menu top-bar topbar header-nav footer site-footer page-footer bottom-bar sidebar side-nav widget widgets related-posts "
    "ad ads advertisement sponsored promo promotion banner newsletter-signup comments comment-section disqus share social social-share sharing "
    "cookie cookie-banner cookie-consent gdpr privacy-notice modal popup overlay lightbox".split()
)
BOILERPLATE_IDS = frozenset("nav navbar navigation menu footer sidebar comments disqus_thread".split())
#: Where a page's main content stands, the first that the page has counts (name: an element, ".": a class, "#": an id, "=": a role).
CONTENT_PLACES = (
    "article main .content #content .main-content #main-content .article-content .doc-content .documentation .docs .markdown-body .prose .post-content .entry-content .page-content =main "
    ".rst-content .md-content .document"
).split()
_BLOCK = {"p", "div", "li", "ul", "ol", "table", "tr", "blockquote", "section", "article", "main", "br", "pre", "dd", "dt"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class PageParser(HTMLParser):
    """Title, description, sections, code, links and text of a page without its boilerplate.

    ``places`` tells which element (by the number of its start tag) each content place first is; with
    ``main``, only that element's content is taken.
    """

    def __init__(self, url: str, main: int | None = None):
        super().__init__(convert_charrefs=True)
        self.main, self.number, self.inside, self.places = main, 0, None if main is None else [], {}
        self.url, self.host = url, urlparse(url).netloc
        self.title, self.description, self.skip, self.in_title = "", "", [], False
        self.items: list[list] = [["", 0, "", []]]  # path, level, heading, content parts
        self.heading, self.code, self.language, self.link = None, None, "", None
        self.code_blocks, self.links, self.stack = [], {}, []

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "title" and not self.title:
            self.in_title = True
        if tag == "meta" and a.get("name", "").lower() == "description":
            self.description = a.get("content", "").strip()
        self.number += 1
        classes, place = a.get("class", "").lower().split(), a.get("id", "").lower()
        if tag not in _VOID and (self.skip or tag in _SKIP or place in BOILERPLATE_IDS or not BOILERPLATE_CLASSES.isdisjoint(classes)):
            if tag != "a" or self.skip:
                self.skip.append(tag)
        if tag == "a" and a.get("href"):
            self.link = [a["href"], []]
        if self.skip:
            return
        for name in (tag, *("." + c for c in classes), "#" + place, "=" + a.get("role", "").lower()):
            self.places.setdefault(name, self.number)
        if self.main is not None and tag not in _VOID:
            if self.number == self.main:
                self.inside = [tag]
            elif self.inside:
                self.inside.append(tag)
        if self.main is not None and not self.inside:
            return
        if re.fullmatch("h[1-6]", tag):
            self.heading = (int(tag[1]), [])
        elif tag == "pre" or (tag == "code" and self.code is None):
            self.code = []
        if tag in ("pre", "code") and (m := re.search(r"(?:language|lang|highlight)-([\w+#]+)", a.get("class", ""))):
            self.language = m[1]
        if tag in _BLOCK:
            self.items[-1][3].append("\n")

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        if tag == "a" and self.link:
            href, text = self.link[0], " ".join("".join(self.link[1]).split())
            self.link = None
            if not href.startswith(("#", "javascript:")):
                full = urljoin(self.url, href)
                if urlparse(full).netloc == self.host and full not in self.links:
                    self.links[full] = text
        if self.skip:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            return
        if self.main is not None:
            if not self.inside:
                return
            if tag in self.inside:
                while self.inside.pop() != tag:
                    pass
        if re.fullmatch("h[1-6]", tag) and self.heading:
            level, parts = self.heading
            name = " ".join("".join(parts).split())
            self.heading = None
            self.stack = [x for x in self.stack if x[0] < level] + [(level, name)]
            self.items.append([" > ".join(n for _, n in self.stack), level, name, []])
        elif (tag == "pre" or tag == "code") and self.code is not None:
            code = "".join(self.code).strip("\n")
            if tag == "pre" or "\n" in code or len(code) > 40:
                context = " ".join("".join(self.items[-1][3]).split())[-200:]
                self.code_blocks.append((self.language or "text", code, context))
            self.items[-1][3].append(f"\n```\n{code}\n```\n" if tag == "pre" else f"`{code}`")
            self.code, self.language = None, ""
        if tag in _BLOCK:
            self.items[-1][3].append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        if self.link:
            self.link[1].append(data)
        if self.skip or self.in_title or self.main is not None and not self.inside:
            return
        if self.heading:
            self.heading[1].append(data)
        elif self.code is not None:
            self.code.append(data)
        else:
            self.items[-1][3].append(data)


def _lines(parts: list[str]) -> str:
    return "\n".join(x for x in (" ".join(line.split()) for line in "".join(parts).split("\n")) if x)


def page_structure(url: str | None, html: str | None) -> tuple:
    parser = PageParser(url or "")
    parser.feed(html or "")
    parser.close()
    main = next((parser.places[p] for p in CONTENT_PLACES if p in parser.places), None)
    if main is not None:
        whole, parser = parser, PageParser(url or "", main)
        parser.feed(html or "")
        parser.close()
        if not any(heading or "".join(parts).strip() for _, _, heading, parts in parser.items):
            parser = whole  # an empty place is none
        else:
            parser.links = whole.links
    sections = [(path, level, heading, _lines(parts)) for path, level, heading, parts in parser.items]
    titled = [s for s in sections if s[1]]
    text = "\n\n".join(x for _, _, heading, content in sections for x in (heading, content) if x)
    markdown = "\n\n".join(x for _, level, heading, content in sections for x in ("#" * level + " " + heading if level else "", content) if x)
    return (" ".join(parser.title.split()), parser.description, titled, parser.code_blocks, [(t, h) for h, t in parser.links.items()], text, markdown)


#: Characters of raw pages that are parsed before their results are handed on.
BITE = 1 << 20
_NAMES = ("title", "description", "sections", "code_blocks", "links", "text", "markdown")
_FIELDS = {"sections": ("path", "level", "heading", "content"), "code_blocks": ("language", "code", "context"), "links": ("text", "href")}


def _bites(pages: pd.Series) -> Iterator[tuple[int, int]]:
    """Runs of pages of at most ``BITE`` characters, or one page."""
    begin, chars = 0, 0
    for k, page in enumerate(pages):
        n = len(page or "")
        if k > begin and chars + n > BITE:
            yield begin, k
            begin, chars = k, 0
        chars += n
    if begin < len(pages):
        yield begin, len(pages)


def structured(pages: DataFrame, *columns: str) -> DataFrame:
    """Pages (page_id, url, html) as structured content, or the named columns of it.

    A worker holds the results of a few pages at a time, however many come in a batch.
    """
    names = columns or _NAMES
    kinds = dict(zip(_NAMES, re.findall(r"\w+ ((?:array<.*?>>|string))(?:, |$)", PAGE)))

    def structures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for begin, end in _bites(rows["html"]):
                part = rows.iloc[begin:end]
                made = {n: [] for n in names}
                for url, html in zip(part["url"], part["html"]):
                    page = dict(zip(_NAMES, page_structure(url, html)))
                    for n in names:
                        made[n].append([dict(zip(_FIELDS[n], x)) for x in page[n]] if n in _FIELDS else page[n])
                yield pd.DataFrame({"page_id": part["page_id"].to_numpy(), "url": part["url"].to_numpy(), **made})

    return pages.select("page_id", "url", "html").mapInPandas(structures, ", ".join(["page_id long", "url string", *(f"{n} {kinds[n]}" for n in names)]))


def chunked(text: Column, most: int = 1500) -> Column:
    """Paragraphs put together while they have at most so many characters, joints not counted."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("now"), F.lit(0).alias("size"))

    def step(s, p):
        full = (s["size"] + F.length(p) > most) & (F.size(s["now"]) > 0)
        return F.when(full, F.struct(F.concat(s["done"], F.array(F.array_join(s["now"], "\n\n"))).alias("done"), F.array(p).alias("now"), F.length(p).alias("size"))).otherwise(
            F.struct(s["done"].alias("done"), F.concat(s["now"], F.array(p)).alias("now"), (s["size"] + F.length(p)).alias("size"))
        )

    return F.aggregate(F.split(text, "\n\n"), start, step, lambda s: F.when(F.size(s["now"]) > 0, F.concat(s["done"], F.array(F.array_join(s["now"], "\n\n")))).otherwise(s["done"]))


def stripped_text(html: Column) -> Column:
    """Page text by expressions only: scripts, styles, comments and tags out, white space to single spaces."""
    out = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->", " ")
    return strip(F.regexp_replace(F.regexp_replace(out, r"<[^>]*>", " "), r"\s+", " "))
