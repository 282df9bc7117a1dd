"""Generated web pages whose blocks of main text are marked, to train the extraction on.

Each page draws its layout at random: where menus, headers, adverts, notices, sidebars, comments, forms and footers stand,
what their elements and attributes are called, and what holds the article.
"""

from __future__ import annotations

import html

import numpy as np

#: Attribute of blocks that hold main text; the extraction reads it in training only.
MARK = "data-main-text"


class _Writer:
    def __init__(self, rng: np.random.Generator, words: list[str]) -> None:
        self.rng, self.words = rng, words

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def pick(self, *options: str) -> str:
        return options[self.rng.integers(len(options))]

    def some(self, low: int, high: int) -> int:
        """A size between low and high, small ones more often."""
        return int(np.exp(self.rng.uniform(np.log(low), np.log(high + 1))))

    def prose(self, low: int, high: int) -> str:
        n = self.some(low, high)
        at = int(self.rng.integers(len(self.words)))
        return html.escape(" ".join(self.words[(at + i) % len(self.words)] for i in range(n)), quote=False)

    def element(self, names: str, inside: str) -> str:
        """names: the tag and attributes, as in `div class="ad"`."""
        return f"<{names}>{inside}</{names.split()[0]}>"

    def links(self, n: int) -> list[str]:
        return [f'<a href="/{i}">{self.prose(1, 4)}</a>' for i in range(n)]

    def listed(self, parts: list[str], names: str = "ul") -> str:
        return self.element(names, "".join(f"<li>{x}</li>" for x in parts))

    def menu(self) -> str:
        links = self.links(self.some(2, 12))
        inside = self.listed(links) if self.chance(0.7) else " | ".join(links)
        return self.element(self.pick("nav", "nav", 'div class="menu"', 'div id="navigation"', 'nav class="navbar"', 'div class="breadcrumbs"', 'div role="navigation"'), inside)

    def header(self) -> str:
        inside = self.element(self.pick("h1", "h2", "p", "div", "a"), self.prose(1, 8)) + (self.menu() if self.chance(0.4) else "") + (self.element("p", self.prose(2, 12)) if self.chance(0.4) else "")
        return self.element(self.pick("header", 'div class="header"', 'div id="masthead"', 'header class="site-header"', 'div class="topbar"'), inside)

    def advert(self) -> str:
        inside = self.prose(2, 40)
        inside = self.pick(inside, f"<p>{inside}</p>", f'<a href="/x">{inside}</a>', f"<h3>{self.prose(1, 5)}</h3><p>{inside}</p>")
        return self.element(self.pick('div class="ad"', 'div class="ad"', 'aside class="advert"', 'div class="ads banner"', 'section class="sponsored"', 'div id="ad-top"', 'div class="promo"', 'div class="advertisement"', 'p class="ad"'), inside)

    def notice(self) -> str:
        inside = self.prose(4, 50) + (self.element("button", self.prose(1, 3)) if self.chance(0.5) else "")
        inside = inside if self.chance(0.5) else f"<p>{inside}</p>"
        return self.element(self.pick('div class="cookie-notice"', 'div id="cookie-banner"', 'div class="notice"', 'div role="alert"', 'section class="consent"', 'p class="notice"', 'div class="popup modal"', 'div class="newsletter"', 'aside class="notice"', 'div class="subscribe"'), inside)

    def sidebar(self) -> str:
        parts = []
        for _ in range(self.some(1, 4)):
            parts.append((self.element("h3", self.prose(1, 4)) if self.chance(0.6) else "") + (self.listed(self.links(self.some(2, 8))) if self.chance(0.5) else self.element(self.pick("p", "div"), self.prose(3, 60))))
        return self.element(self.pick("aside", "aside", 'div class="sidebar"', 'div id="sidebar"', 'aside class="side"', 'div class="widget"', 'section class="sidebar"', 'div class="related"'), "".join(parts))

    def comments(self) -> str:
        inner = self.pick('div class="comment"', "li", "article", 'li class="comment"', "div", "p", 'article class="comment"')
        text = lambda: self.prose(3, 80) if inner == "p" or self.chance(0.3) else f"<p>{self.prose(3, 80)}</p>"
        author = lambda: self.element(self.pick("b", "span", "cite"), self.prose(1, 2)) if self.chance(0.5) else ""
        each = "".join(self.element(inner, author() + text()) for _ in range(self.some(1, 10)))
        title = self.element(self.pick("h2", "h3"), self.prose(1, 3)) if self.chance(0.6) else ""
        outer = "ol" if inner.startswith("li") else self.pick("section", "div")
        return self.element(outer + " " + self.pick('class="comments"', 'id="comments"', 'class="comment-list"', 'class="reader-comments"', 'id="discussion"', 'class="replies"'), title + each)

    def form(self) -> str:
        fields = "".join(f"<label>{self.prose(1, 4)}</label><input>" for _ in range(self.some(1, 4)))
        choice = f"<select>{''.join(f'<option>{self.prose(1, 3)}' for _ in range(3))}</select>" if self.chance(0.3) else ""
        lead = self.element("p", self.prose(2, 20)) if self.chance(0.4) else ""
        made = self.element(self.pick("form", 'form class="search"', 'form id="signup"'), lead + fields + choice + f"<button>{self.prose(1, 3)}</button>")
        return made if self.chance(0.7) else self.element(self.pick("div", 'div class="newsletter"', 'section class="contact"'), self.element("p", self.prose(2, 15)) + made)

    def footer(self) -> str:
        inside = "&copy; example.com &middot; " + self.prose(2, 30)
        inside = self.pick(inside, f"<p>{inside}</p>", self.listed(self.links(self.some(2, 8))) + f"<p>{inside}</p>")
        return self.element(self.pick("footer", "footer", 'div class="footer"', 'div id="footer"', 'footer class="site-footer"', 'div class="copyright"'), inside)

    def junk(self) -> str:
        return getattr(self, self.pick("menu", "advert", "notice", "sidebar", "comments", "form", "advert"))()

    def article(self) -> str:
        inline = lambda text: text if self.chance(0.8) else self.pick(f"<b>{text}</b>", f"<b>{text}<br>", f"<span>{text}</span>", f"<em>{self.prose(1, 5)}</em> {text}", f'{text} <a href="/y">{self.prose(1, 6)}</a>')
        ends = self.chance(0.8)
        blocks = []
        if self.chance(0.8):
            blocks.append(f"<h1 {MARK}>{self.prose(1, 12)}</h1>")
        for _ in range(self.some(1, 25)):
            text = inline(self.prose(1, 150))
            kind = self.pick(*["p"] * 14, "list", "h2", "quote", "div", "table", "figure")
            if kind == "p":
                blocks.append(f"<p {MARK}>{text}" + ("</p>" if ends or self.chance(0.5) else ""))
            elif kind == "list":
                blocks.append(self.element("ul", "".join(f"<li {MARK}>{self.prose(2, 30)}</li>" for _ in range(self.some(2, 8)))))
            elif kind == "h2":
                blocks.append(f"<h2 {MARK}>{self.prose(1, 8)}</h2>")
            elif kind == "quote":
                blocks.append(f"<blockquote {MARK}>{text}</blockquote>")
            elif kind == "div":
                blocks.append(f"<div {MARK}>{text}</div>")
            elif kind == "figure":
                blocks.append(f"<figure><figcaption {MARK}>{self.prose(2, 20)}</figcaption></figure>")
            else:
                row = lambda: "<tr>" + "".join(f"<td {MARK}>{self.prose(1, 6)}</td>" for _ in range(3)) + "</tr>"
                blocks.append("<table>" + "".join(row() for _ in range(self.some(1, 6))) + "</table>")
            if self.chance(0.04):
                blocks.append(self.pick(self.advert(), self.notice(), self.sidebar(), self.form()))
        if self.chance(0.1):
            blocks.append(self.comments())
        return "".join(blocks)

    def page(self) -> str:
        body = self.article() if self.chance(0.97) else ""
        held = self.pick("article", "article", "article", "main", 'div class="content"', 'div class="post-body"', 'div id="main"', 'section class="story"', "div", 'div class="entry"', "section")
        main = self.element(held, body)
        if self.chance(0.3):
            main = self.element(self.pick("main", 'div id="content"', "div", 'div class="page"'), main + (self.comments() if self.chance(0.3) else "") + (self.sidebar() if self.chance(0.3) else ""))
        before = [x() for x, p in ((self.header, 0.4), (self.menu, 0.7), (self.notice, 0.3), (self.advert, 0.6), (self.sidebar, 0.15), (self.form, 0.1)) if self.chance(p)]
        after = [x() for x, p in ((self.advert, 0.2), (self.comments, 0.35), (self.sidebar, 0.3), (self.form, 0.2), (self.notice, 0.15), (self.footer, 0.8)) if self.chance(p)]
        extra = [self.junk()] if self.chance(0.1) else []
        script = '<script>var t="</p>";track(1);</script>' if self.chance(0.5) else ""
        made = f"<html><head><title>{self.prose(1, 8)}</title></head><body>{script}{''.join(before + extra)}{main}{''.join(after)}</body></html>"
        return made[: int(self.rng.integers(200, len(made) + 1))] if self.chance(0.1) and len(made) > 200 else made


def labelled_page(rng: np.random.Generator, words: list[str]) -> str:
    """One page with MARK on the blocks of its article."""
    return _Writer(rng, words).page()
