"""Labelled pages to train the extractor: laid out from parts, every part labelled.

A layout is drawn at random from the ways pages are commonly built: with and
without semantic tags, with and without telling class names, menus above or
beside the text, notices, adverts between paragraphs, forms, related links,
reader comments and footers around it. The words come from the caller. Each
part is written between two marks, so that the label of every block is known.
"""

from __future__ import annotations

import numpy as np

CONTENT, REST = "", ""     # private-use marks before a block's text


def labelled_page(rng: np.random.Generator, words: list[str]) -> str:
    """One page; every block's text begins with ``CONTENT`` or ``REST``."""
    pick = lambda *x: x[int(rng.integers(len(x)))]
    chance = lambda p: rng.random() < p

    def text(lo: int, hi: int) -> str:
        n = int(rng.integers(lo, hi + 1))
        out = [words[i] for i in rng.integers(0, len(words), n)]
        if hi > 8:
            for i in range(9, n, int(rng.integers(7, 14))):
                out[i] = out[i].rstrip(".,") + pick(".", ",", ".")
            out[-1] = out[-1].rstrip(".,") + "."
        return " ".join(out)

    def tag(name: str, inner: str, cls: str = "", other: str = "") -> str:
        named = f' {pick("class", "class", "id")}="{cls}"' if cls else ""
        return f"<{name}{named}{other}>{inner}</{name}>"

    def link(mark: str, lo: int = 1, hi: int = 3) -> str:
        return f'<a href="/{pick(*words)}">{mark}{text(lo, hi)}</a>'

    def menu(cls: str) -> str:
        items = "".join(tag("li", link(REST)) for _ in range(int(rng.integers(2, 9))))
        if chance(0.3):
            return tag("div", " | ".join(link(REST if i == 0 else "") for i in range(int(rng.integers(2, 7)))), cls)
        return tag(pick("nav", "div", "div"), tag("ul", items), cls if chance(0.8) else "")

    def advert() -> str:
        return tag(pick("div", "aside", "div"), REST + text(2, 16) + (" " + link("") if chance(0.4) else ""), pick("ad", "advert", "promo", "sponsored", "ads banner"))

    def paragraph() -> str:
        body = CONTENT + text(5, 70) if chance(0.85) else CONTENT + text(1, 5)
        if chance(0.2):
            body += f" {pick('<b>', '<em>', '<span>')}{text(1, 6)}" + pick("</b>", "</em>", "</span>", "")
        if chance(0.15):
            body += " " + link("")
        return f"<p>{body}" + pick("</p>", "</p>", "</p>", "<br>", "")

    def story() -> str:
        parts = [tag(pick("h1", "h1", "h2"), CONTENT + text(2, 12))] if chance(0.9) else []
        for _ in range(int(rng.integers(1, 10))):
            kind = rng.random()
            if kind < 0.72:
                parts.append(paragraph())
            elif kind < 0.78:
                parts.append(tag(pick("h2", "h3"), CONTENT + text(2, 7)))
            elif kind < 0.84:
                parts.append(tag(pick("ul", "ol"), "".join(tag("li", CONTENT + text(3, 20)) for _ in range(int(rng.integers(2, 6))))))
            elif kind < 0.88:
                parts.append(tag("blockquote", paragraph()))
            elif kind < 0.91:
                parts.append(tag("table", "".join(tag("tr", tag("td", CONTENT + text(1, 4)) + tag("td", CONTENT + text(1, 4))) for _ in range(3))))
            elif kind < 0.94:
                parts.append(tag("div", CONTENT + text(10, 50)))
            else:
                parts.append(advert())
        return "".join(parts)

    def side() -> str:
        head = tag(pick("h3", "h4", "div"), REST + text(1, 4)) if chance(0.6) else ""
        inner = head + "".join(tag("li", link(REST, 2, 9)) for _ in range(int(rng.integers(2, 7)))) if chance(0.6) else head + tag("p", REST + text(5, 30))
        return tag(pick("aside", "div", "div"), inner, pick("sidebar", "side", "related", "widget", "right-col", "share", "tags"))

    def notice() -> str:
        return tag(pick("div", "p", "section"), REST + text(6, 30) + (f" <button>{text(1, 2)}</button>" if chance(0.5) else ""), pick("cookie", "notice", "banner", "alert", "consent", "popup newsletter"))

    def form() -> str:
        return f"<form action='/{pick(*words)}'>" + tag(pick("label", "p", "div"), REST + text(1, 12)) + "<input name='q'>" + f"<button>{text(1, 2)}</button></form>"

    def comments() -> str:
        one = lambda: tag(pick("div", "li", "article"), tag(pick("b", "div", "span"), REST + text(1, 2)) + tag("p", REST + text(4, 45)), pick("comment", "comment-body", "reply"))
        return tag(pick("section", "div"), tag("h3", REST + text(1, 3)) + "".join(one() for _ in range(int(rng.integers(1, 6)))), pick("comments", "comment-list", "responses", "discussion"))

    def footer() -> str:
        inner = REST + "&copy; " + text(2, 14) + (" &middot; " + link("") if chance(0.5) else "")
        return pick(tag("footer", inner), tag("div", inner, pick("footer", "site-footer", "legal", "copyright")), tag("footer", tag("p", inner)))

    top = [tag(pick("header", "div"), REST + text(1, 5) if chance(0.5) else tag("p", REST + text(1, 8)), pick("header", "masthead", "top", "site-header"))] if chance(0.5) else []
    top += [menu(pick("nav", "menu", "navbar", "main-menu", "breadcrumb"))] if chance(0.85) else []
    top += [notice()] if chance(0.3) else []
    top += [advert()] if chance(0.5) else []
    holder = pick("article", "article", "main", "div", "div", "section", "")
    cls = pick("", "content", "post", "article-body", "entry-content", "story", "main") if holder == "div" else pick("", "", "post")
    middle = [tag(holder, story(), cls) if holder else story()]
    if chance(0.25):
        middle = [tag(pick("main", "div"), "".join(middle), pick("", "main", "container", "wrap"))]
    if chance(0.4):
        middle.insert(int(rng.integers(0, 2)), side())
    bottom = [p() for p, often in ((comments, 0.35), (form, 0.3), (side, 0.2), (lambda: menu(pick("nav", "links", "pagination")), 0.15)) if chance(often)]
    if chance(0.9):
        bottom.append(footer())
    body = "".join([*top, *middle, *bottom])
    if chance(0.2):
        body = tag("div", body, pick("page", "wrapper", "container"))
    return f"<!DOCTYPE html><html><head><title>{text(2, 8)}</title><script>var a='<p>';</script></head><body>{body}" + pick("</body></html>", "")
