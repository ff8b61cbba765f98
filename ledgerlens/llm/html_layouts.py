"""Labelled pages: a generator of page layouts whose blocks are marked as main text or not.

The pages table has no labels, so the extractor learns from pages that are written
here: layouts vary in containers, names and the order of their parts, tags are left
open at times, and every part carries ``data-main`` ("1" article, "0" anything else).
Texts are strings of made-up words, so that the model learns layouts, not topics.
"""

from __future__ import annotations

import random

from .html_blocks import LABEL

_LETTERS = "aaaabcdeeeeefghiiijklmnnooopqrrsssttuuvwxyzäéñ"
#: how pages name the wrapper of their article, and its parts
_MAIN = """content main-content post post-content entry entry-content article article-body article__body story story-body
    body-text text page-content blog-post news-article prose markdown-body copy""".split()
#: parts beside or inside the article, with names, tags and short texts they use
_PARTS = {
    "menu": ("nav ul div".split(), "nav menu main-menu navbar navigation site-nav topnav nav-links mobile-menu toc breadcrumb breadcrumbs pagination pager".split(),
             "Home About Contact News Blog Next Previous Back Login Shop Archive".split()),
    "header": ("header div".split(), "header site-header masthead topbar logo branding site-title tagline page-header banner".split(), "Welcome to".split()),
    "footer": ("footer div".split(), "footer site-footer colophon copyright legal bottom footer-links credits imprint".split(),
               "© Copyright All rights reserved Privacy Terms Imprint".split()),
    "sidebar": ("aside div".split(), "sidebar side aside widget widgets rail right-column complementary secondary related related-posts recommended more trending popular tags tag-list author-box".split(),
                "Related Popular More Recommended Tags Archives Categories".split()),
    "notice": ("div section p".split(), "cookie cookie-notice cookie-banner consent notice alert gdpr warning message popup modal overlay paywall announcement disclaimer".split(),
               "We use cookies Accept Subscribe to continue reading".split()),
    "advert": ("div aside ins".split(), "ad ads advert advertisement ad-slot sponsor sponsored promo promotion banner-ad adsbygoogle dfp".split(),
               "Advertisement Sponsored Buy now".split()),
    "form": ("form".split(), "search search-form newsletter signup subscribe login contact-form comment-form subscription".split(),
             "Search Subscribe Email Name Password Submit Send".split()),
    "comments": ("section div ol ul".split(), "comments comment-list comments-area responses discussion disqus user-comments reader-comments replies thread".split(),
                 "Reply says wrote comments Comment by Guest Anonymous".split()),
    "share": ("div ul".split(), "share social share-buttons social-links sharing follow like buttons toolbar".split(), "Share Tweet Facebook Email Print Follow".split()),
    "meta": ("div p span".split(), "meta byline post-meta date author entry-meta timestamp published reading-time".split(), "Posted by on Published Updated min read".split()),
}
_INSIDE = ("advert", "share", "comments", "form", "sidebar", "meta", "menu", "notice", "footer")
_AROUND = ("menu", "header", "sidebar", "notice", "advert", "form", "comments", "footer", "share")


class _Page:
    def __init__(self, rng: random.Random) -> None:
        self.rng, self.lazy = rng, rng.random() < 0.4  # a lazy page leaves tags open

    def words(self, n: int) -> str:
        r = self.rng
        marks = r.choice(("", "", "", "", "|", "###", "***", "&amp;", "-", "1")) if n > 1 else ""
        return " ".join("".join(r.choices(_LETTERS, k=int(r.random() * 9) + 1)) + (marks and r.choice((marks, " " + marks, "")))
                        for _ in range(n))

    def sentence(self, most: int = 25) -> str:
        s = self.words(self.rng.randint(1, most))
        if self.rng.random() < 0.5:
            s = s.replace(" ", ", ", self.rng.randint(0, 3))
        return s[:1].upper() + s[1:] + self.rng.choice((*"....!?", "", ""))

    def prose(self) -> str:
        n = self.rng.choice((1, 1, 1, 1, 2, 2, 3, 5, 9, 20, 40))
        s = " ".join(self.sentence() for _ in range(n))
        if self.rng.random() < 0.15:
            s = f"{self.sentence()} <a href='/{self.rng.randint(1, 99)}'>{self.words(2)}</a> {s}"
        if self.rng.random() < 0.1:
            s = s.replace(" ", " <br>\n", 1)
        return s

    def tag(self, tag: str, inner: str, names: str = "", label: str = "", open_: bool = False) -> str:
        r = self.rng
        attrs = f" {LABEL}='{label}'" if label else ""
        if names and r.random() < 0.85:
            extra = f" {r.choice(('js', 'c', 'col', 'u', 'x'))}-{r.randint(1, 99)}" if r.random() < 0.3 else ""
            attrs += f" {r.choice(('class', 'class', 'id'))}='{names}{extra}'"
        return f"<{tag}{attrs}>{inner}" + ("" if open_ else f"</{tag}>")

    def paragraph(self, label: str) -> str:
        inner = self.prose()
        if self.rng.random() < 0.15:
            inner = f"<b>{inner}" + ("" if self.lazy else "</b>")
        return self.tag("p", inner, label=label, open_=self.lazy and self.rng.random() < 0.6)

    def part(self, kind: str) -> str:
        """Something that is not the article."""
        r = self.rng
        tags, names, says = _PARTS[kind]
        tag, name, items = r.choice(tags), r.choice(names), []
        short = lambda: r.choice((r.choice(says), " ".join(says), self.words(r.randint(1, 4))))
        if kind == "menu" or (kind in ("sidebar", "footer", "share", "header") and r.random() < 0.5):
            inner = "".join(f"<li><a href='/{r.randint(1, 999)}'>{short()}</a>" + ("" if self.lazy else "</li>") for _ in range(r.randint(2, 8)))
            items.append(inner if tag in ("ul", "ol") else f"<ul>{inner}</ul>")
        elif kind == "comments":
            for _ in range(r.randint(1, 6)):
                who = f"<{r.choice(('h4', 'div', 'span', 'b'))}>{self.words(2)} {r.choice(says)}"
                who += "</" + who[1:].split(">")[0] + ">"
                body = who + self.paragraph("")
                items.append(self.tag("li" if tag in ("ul", "ol") else r.choice(("div", "article", "p")), body,
                                      r.choice(("comment", "comment-body", "reply", "response", "post"))))
        elif kind == "form":
            items.append(f"<label>{short()}</label><input name='q'>" + (f"<p>{self.sentence()}</p>" if r.random() < 0.5 else "")
                         + f"<button>{short()}</button>" + ("<select><option>1<option>2</select>" if r.random() < 0.2 else ""))
        else:
            text = [short(), self.sentence(), f"{short()} {self.sentence(12)}", self.prose()]
            for _ in range(r.randint(1, 3)):
                own = r.choice(text)
                items.append(r.choice((own, own, f"<p>{own}</p>", f"<div>{own}</div>", f"<a href='#'>{own}</a>")))
        if kind == "sidebar" and r.random() < 0.5:
            items.insert(0, f"<h3>{short()}</h3>")
        if tag == "p":
            items = [self.sentence()]
        return self.tag(tag, "".join(items), name, "0")

    def article(self) -> str:
        r, out = self.rng, []
        title = self.tag("h1", r.choice((self.words(r.randint(1, 10)), self.sentence(10))), r.choice(("", "title", "headline", "entry-title")), "1")
        if r.random() < 0.85:
            out.append(self.tag("header", title + (self.part("meta") if r.random() < 0.5 else ""), r.choice(("", "entry-header", "post-header")))
                       if r.random() < 0.15 else title)
        for _ in range(r.choice((1, 1, 1, 2, 2, 3, 4, 6, 10, 20))):
            x = r.random()
            if x < 0.72:
                out.append(self.paragraph("1"))
            elif x < 0.80:
                out.append(self.tag(r.choice(("h2", "h3")), self.words(r.randint(1, 8)), label="1"))
            elif x < 0.84:
                item = "".join(self.tag("li", self.prose(), open_=self.lazy) for _ in range(r.randint(2, 5)))
                out.append(self.tag(r.choice(("ul", "ol")), item, label="1"))
            elif x < 0.87:
                out.append(self.tag("blockquote", self.paragraph(""), r.choice(("", "quote")), "1"))
            elif x < 0.89:
                out.append(f"<figure {LABEL}='1'><img src='a.jpg'><figcaption>{self.sentence()}</figcaption></figure>")
            elif x < 0.91:
                cells = "".join(f"<tr><td>{self.words(2)}</td><td>{r.randint(1, 999)}</td></tr>" for _ in range(3))
                out.append(f"<table {LABEL}='1'>{cells}</table>")
            elif x < 0.93:
                out.append(self.tag("pre", self.words(12).replace(" ", "\n"), label="1"))
            elif x < 0.96:
                out.append(self.tag("div", self.prose(), label="1"))
            else:
                out.append(self.part(r.choice(_INSIDE)))
        if r.random() < 0.35:
            out.append(self.part(r.choice(_INSIDE)))
        inner = "\n".join(out) if r.random() < 0.5 else "".join(out)
        kind, name = r.choice(("article", "article", "main", "div", "div", "section", "td")), r.choice(_MAIN)
        if kind in ("article", "main") and r.random() < 0.7:
            name = ""
        if r.random() < 0.1:  # straight in the body
            return inner
        body = self.tag("table", f"<tr>{self.tag('td', inner, name)}</tr>") if kind == "td" else self.tag(kind, inner, name)
        if r.random() < 0.35:
            body = self.tag(r.choice(("main", "div", "article", "section")), body, r.choice((*_MAIN, "wrapper", "container", "row", "page")))
        return body

    def page(self) -> str:
        r = self.rng
        if r.random() < 0.05:  # a fragment
            inner = "".join(self.paragraph("1") for _ in range(r.randint(1, 3)))
            return r.choice((inner, f"<article>{inner}</article>", f"<html><body>{inner}"))
        around = [k for k in _AROUND if r.random() < 0.55]
        cut = sum(k in ("menu", "header", "notice", "advert", "form") for k in around)
        if r.random() < 0.3:
            r.shuffle(around)
        before, after = around[:r.randint(0, cut) if r.random() < 0.3 else cut], []
        after = [k for k in around if k not in before]
        body = "".join(map(self.part, before)) + "<!-- part -->" * (r.random() < 0.3) + self.article() + "".join(map(self.part, after))
        for _ in range(r.choice((0, 0, 1, 2))):
            body = self.tag("div", body, r.choice(("wrapper", "container", "page", "site", "row", "app", "root", "layout", "inner")))
        head = f"<head><title>{self.words(4)}</title><style>p{{}}</style><script>var t='</p>';</script></head>"
        if r.random() < 0.1:
            return body
        tail = "" if self.lazy and r.random() < 0.5 else "</body></html>"
        return f"<!DOCTYPE html><html lang='en'>{head}<body>{body}{tail}"


def labelled_pages(n: int = 1600, seed: int = 11) -> list[str]:
    """``n`` labelled pages; the same for the same seed."""
    rng = random.Random(seed)
    return [_Page(rng).page() for _ in range(n)]
