"""Labelled pages: made-up pages of many layouts whose blocks say whether they belong to the article.

The label stands in the attribute `data-label` of block elements (1: article, 0: not). Pages are drawn
from a seed, so the training set is the same wherever it is made.
"""

from __future__ import annotations

import random

LABEL = "data-label"
_SYLLABLES = "ka lo mi ner tu sal ve do rin pa és öl ña the on re ti".split()


class _Maker:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def word(self) -> str:
        return "".join(self.rng.choices(_SYLLABLES, k=self.rng.randint(1, 3)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high)))

    def sentence(self, low: int = 2, high: int = 18) -> str:
        return self.words(low, high).capitalize() + self.rng.choice([".", ".", ".", "!", "?"])

    def prose(self, high: int = 7) -> str:
        return " ".join(self.sentence() for _ in range(self.rng.randint(1, high)))

    def link(self) -> str:
        return f'<a href="/{self.word()}">{self.words(1, 3)}</a>'

    def links(self, label: int = 0, low: int = 3, high: int = 9) -> str:
        return "<ul>" + "".join(f'<li {LABEL}="{label}">{self.link()}</li>' for _ in range(self.rng.randint(low, high))) + "</ul>"

    def block(self, tag: str, inner: str, label: int, attrs: str = "") -> str:
        return f'<{tag}{" " + attrs if attrs else ""} {LABEL}="{label}">{inner}</{tag}>'

    def named(self, *names: str) -> str:
        name = self.rng.choice(names)
        return self.rng.choice([f'class="{name}"', f'id="{name}"', f'class="{name} {self.word()}"'])

    def menu(self) -> str:
        kind = self.rng.randrange(4)
        if kind == 0:
            return f"<nav>{self.links()}</nav>"
        if kind == 1:
            return f'<div {self.named("nav", "menu", "navbar", "navigation", "top-menu", "main-nav")}>{self.links()}</div>'
        if kind == 2:
            return self.block("div", " | ".join(self.link() for _ in range(5)), 0, self.named("menu", "breadcrumb", "breadcrumbs", "topbar"))
        return f'<nav role="navigation" {self.named("site-nav", "menu")}>{self.links()}</nav>'

    def advert(self) -> str:
        name = self.named("ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo", "ad-slot", "adsbox", "sponsor")
        inner = self.rng.choice([self.sentence(), self.prose(3), f"<p {LABEL}=\"0\">{self.prose(2)}</p>", f"<p {LABEL}=\"0\">{self.sentence()} {self.link()}</p>"])
        return self.block(self.rng.choice(["div", "div", "aside", "section"]), inner, 0, name)

    def notice(self) -> str:
        name = self.named("cookie-notice", "cookie-banner", "notice", "alert", "consent", "gdpr", "popup", "modal", "paywall", "newsletter", "subscribe", "message")
        return self.block(self.rng.choice(["div", "section", "aside"]), self.rng.choice([self.prose(3), f"<p {LABEL}=\"0\">{self.prose(3)}</p><button>{self.word()}</button>"]), 0, name)

    def form(self) -> str:
        return f'<form {self.named("search", "signup", "newsletter-form", "contact", "login")}><label {LABEL}="0">{self.words(1, 4)}</label><input type="text"><p {LABEL}="0">{self.sentence()}</p><button>{self.word()}</button><select><option>{self.word()}<option>{self.word()}</select></form>'

    def sidebar(self) -> str:
        tag = self.rng.choice(["aside", "aside", "div", "section"])
        name = self.named("sidebar", "side", "widget", "widgets", "related", "recommended", "trending", "popular-posts", "tags", "rail") if tag != "aside" or self.rng.random() < 0.5 else ""
        body = self.rng.choice([self.links(), f"<h3 {LABEL}=\"0\">{self.words(1, 3)}</h3>{self.links()}", f"<h3 {LABEL}=\"0\">{self.words(1, 3)}</h3><p {LABEL}=\"0\">{self.prose(3)}</p>", f"<p {LABEL}=\"0\">{self.prose(4)}</p>"])
        return self.block(tag, body, 0, name)

    def comments(self) -> str:
        name = self.named("comments", "comment-list", "discussion", "responses", "comments-area", "disqus", "replies")
        each = "".join(self.rng.choice([f'<div class="comment" {LABEL}="0"><b>{self.word()}</b><p {LABEL}="0">{self.prose()}</p></div>', f'<li class="comment" {LABEL}="0"><p {LABEL}="0">{self.prose()}</p></li>', f'<p {LABEL}="0">{self.prose()}</p>']) for _ in range(self.rng.randint(1, 5)))
        return self.block(self.rng.choice(["section", "div", "div", "ol"]), f"<h3 {LABEL}=\"0\">{self.words(1, 3)}</h3>" + each, 0, name)

    def header(self) -> str:
        body = self.rng.choice([self.block("h1", self.words(1, 4), 0), self.block("div", self.words(1, 4), 0, self.named("logo", "brand", "site-title")), self.block("p", self.sentence(), 0)]) + self.rng.choice(["", self.menu()])
        return self.rng.choice([f"<header>{body}</header>", f'<div {self.named("header", "masthead", "page-header", "site-header")}>{body}</div>', f'<header role="banner">{body}</header>'])

    def footer(self) -> str:
        text = self.rng.choice([f"&copy; {self.word()}.example &middot; {self.prose(3)}", f"&copy; {self.words(1, 3)}", self.prose(3), " | ".join(self.link() for _ in range(4))])
        inner = self.rng.choice([text, f"<p {LABEL}=\"0\">{text}</p>", f"<p {LABEL}=\"0\">{text}</p>{self.links()}"])
        return self.rng.choice([self.block("footer", inner, 0), self.block("footer", inner, 0), self.block("div", inner, 0, self.named("footer", "site-footer", "copyright", "bottom", "legal"))])

    def share(self) -> str:
        return self.block("div", " ".join(self.link() for _ in range(3)), 0, self.named("share", "social", "share-bar", "toolbar", "pagination", "pager"))

    def paragraph(self) -> str:
        roll = self.rng.random()
        text = self.prose()
        if roll < 0.12:
            text = self.words(1, 3).capitalize() + "."
        elif roll < 0.3:
            text = f"{self.sentence()} {self.link()} {self.sentence()}"
        elif roll < 0.4:
            text = f"<b>{self.sentence()}</b> <em>{self.words(1, 4)}</em> {self.prose(3)}"
        elif roll < 0.47:
            return f'<p {LABEL}="1"><b>{text}<br>'
        return f'<p {LABEL}="1">{text}</p>'

    def article(self, heading: bool = True) -> str:
        rng, body = self.rng, []
        if heading:
            title = self.block(rng.choice(["h1", "h1", "h2"]), self.words(2, 12).capitalize(), 1)
            body.append(rng.choice([title, title, f"<header>{title}</header>"]))
        for _ in range(rng.randint(1, 9)):
            roll = rng.random()
            if roll < 0.72:
                body.append(self.paragraph())
            elif roll < 0.79:
                body.append(self.block(rng.choice(["h2", "h3"]), self.words(1, 6), 1))
            elif roll < 0.85:
                body.append("<ul>" + "".join(self.block("li", rng.choice([self.sentence(), self.words(1, 4)]), 1) for _ in range(rng.randint(2, 5))) + "</ul>")
            elif roll < 0.89:
                body.append(rng.choice([f"<blockquote>{self.block('p', self.prose(3), 1)}</blockquote>", self.block("blockquote", self.prose(2), 1), self.block("pre", self.words(3, 9), 1)]))
            elif roll < 0.92:
                body.append("<table>" + "".join("<tr>" + "".join(self.block("td", self.words(1, 4), 1) for _ in range(3)) + "</tr>" for _ in range(2)) + "</table>")
            elif roll < 0.94:
                body.append(f"<figure><img src=x>{self.block('figcaption', self.sentence(), 1)}</figure>")
            else:
                body.append(rng.choice([self.advert, self.notice, self.share, self.form, self.sidebar])())
        return "".join(body)

    def page(self) -> str:
        rng = self.rng
        body = self.article()
        kind = rng.randrange(6)
        if kind == 0:
            main = f"<article>{body}</article>"
        elif kind == 1:
            main = f"<main><article {self.named('post', 'entry', 'story', 'article')}>{body}</article>{rng.choice(['', self.comments()])}</main>"
        elif kind == 2:
            main = f'<div {self.named("content", "main", "main-content", "page-content")}><div {self.named("post", "entry", "article-body", "story", "entry-content", "post-body", "text")}>{body}</div></div>'
        elif kind == 3:
            main = f'<div {self.named("wrapper", "container", "page")}><div {self.named("content", "main", "article")}>{body}</div>{rng.choice(["", self.sidebar()])}</div>'
        elif kind == 4:
            main = f"<main>{body}</main>"
        else:
            main = f"<div><div>{body}</div></div>"
        before = [f() for f in (self.header, self.menu, self.advert, self.notice) if rng.random() < 0.5]
        after = [f() for f in (self.share, self.sidebar, self.comments, self.form, self.advert, self.notice, self.footer) if rng.random() < 0.5]
        if kind == 5:
            # Bare layouts need something else on the page to be told from.
            after.append(self.footer())
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title><style>p{{margin:0}}</style><script>var a='</p>';</script></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def labelled_pages(n: int, seed: int = 1) -> list[str]:
    return [_Maker(seed * 1_000_003 + k).page() for k in range(n)]
