"""Generated web pages of many layouts, whose main blocks carry ``MARK``: what the block labeller learns from."""

from __future__ import annotations

import numpy as np

#: Stands in every main block's text, and is taken out again before anything is learned.
MARK = "█"
LETTERS = np.array(list("abcdefghijklmnopqrstuvwxyzäéñóü"))

# Class names that pages use for what is and is not their article.
MAIN = ["article", "content", "post", "entry", "main", "story", "article-body", "post-content", "entry-content"]
SIDE = {
    "nav": ["nav", "menu", "navbar", "breadcrumb", "pagination", "site-nav"],
    "header": ["header", "masthead", "site-header", "banner", "logo"],
    "footer": ["footer", "site-footer", "copyright", "colophon"],
    "aside": ["sidebar", "related", "widget", "share", "social", "tags", "recommended", "newsletter"],
    "notice": ["cookie", "notice", "consent", "alert", "popup", "gdpr"],
    "ad": ["ad", "ads", "advert", "sponsored", "promo", "banner-ad"],
    "comments": ["comments", "comment", "responses", "discussion", "comment-list", "reply"],
    "form": ["search", "login", "subscribe", "signup", "contact-form"],
}


def page(random: np.random.Generator) -> str:
    """One page: a main part among side parts, in random order, depth, markup and care."""
    pick = lambda xs: xs[random.integers(len(xs))]

    def word() -> str:
        return "".join(LETTERS[random.integers(0, len(LETTERS), random.integers(1, 10))])

    def text(n: int) -> str:
        words = [word() for _ in range(max(1, n))]
        glue = pick([" ", " ", " ", "\n"])
        return glue.join(words).capitalize() + pick([".", ".", ".", "", "?"])

    def attribute(names: list[str]) -> str:
        kind = pick(["class", "class", "id"])
        return f' {kind}="{pick(names)}"' if random.random() < 0.85 else ""

    def link() -> str:
        return f'<a href="/{word()}">{text(random.integers(1, 3))}</a>'

    def listing() -> str:
        return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(random.integers(1, 9))) + "</ul>"

    def paragraph(mark: str) -> str:
        body = text(int(random.integers(1, 60)))
        if random.random() < 0.25:
            body = f"<b>{body}" + pick(["</b>", "", "<br>"])
        if random.random() < 0.15:
            body += " " + link()
        end = pick(["</p>", "</p>", "</p>", ""])
        return f"<p>{mark}{body}{end}"

    def main_part() -> str:
        inner = []
        if random.random() < 0.8:
            inner.append(f"<h1>{MARK}{text(6)}</h1>")
        for _ in range(random.integers(1, 9)):
            kind = random.random()
            if kind < 0.75:
                inner.append(paragraph(MARK))
            elif kind < 0.82:
                inner.append(f"<h2>{MARK}{text(4)}</h2>")
            elif kind < 0.88:
                inner.append(f"<ul><li>{MARK}{text(8)}</li><li>{MARK}{text(5)}</li></ul>")
            elif kind < 0.93:
                inner.append(f"<blockquote>{MARK}{text(12)}</blockquote>")
            elif kind < 0.96:
                inner.append(f"<table><tr><td>{MARK}{text(2)}</td><td>{MARK}{text(3)}</td></tr></table>")
            else:
                inner.append(side(pick(["ad", "aside", "form", "notice"])))
        if random.random() < 0.15:
            inner.append(side("comments"))
        body = "".join(inner)
        kind = random.random()
        if kind < 0.6:
            return f"<article{attribute(MAIN) if random.random() < 0.3 else ''}>{body}</article>"
        if kind < 0.8:
            return f"<main><div{attribute(MAIN)}>{body}</div></main>"
        return f'<div class="{pick(MAIN)}">{body}</div>'

    def side(kind: str) -> str:
        own = SIDE[kind]
        tag = kind if kind in ("nav", "header", "footer", "aside", "form") and random.random() < 0.7 else pick(["div", "section"])
        name = attribute(own) if tag == kind else f' class="{pick(own)}"'
        shape = random.random()
        if kind == "nav":
            body = listing() if shape < 0.8 else " ".join(link() for _ in range(4))
        elif kind == "comments":
            body = "<h3>" + text(2) + "</h3>" + "".join(
                pick([f'<div class="comment"><p>{text(random.integers(1, 40))}</p></div>', f"<li>{text(12)}</li>"])
                for _ in range(random.integers(1, 5))
            )
        elif kind == "form":
            body = f"<label>{text(2)}</label><input name=q><button>{text(1)}</button>"
        elif kind == "footer":
            body = f"&copy; {text(random.integers(1, 20))} &middot; {text(4)}"
        elif shape < 0.5:
            body = text(random.integers(1, 40))
        elif shape < 0.75:
            body = "".join(paragraph("") for _ in range(random.integers(1, 3)))
        else:
            body = "<h3>" + text(2) + "</h3>" + listing()
        return f"<{tag}{name}>{body}</{tag}>"

    before = [side(k) for k in ("notice", "header", "nav", "ad", "form", "aside") if random.random() < 0.45]
    after = [side(k) for k in ("comments", "aside", "ad", "nav", "footer") if random.random() < 0.5]
    if random.random() < 0.2:
        random.shuffle(before)
    head = f"<head><title>{text(6)}</title><style>p{{margin:0}}</style></head>" if random.random() < 0.9 else ""
    noise = pick(["", "<!-- ad -->", '<script>var t="</p>";track();</script>'])
    body = noise + "".join(before) + main_part() + "".join(after)
    if random.random() < 0.3:
        body = f'<div class="{pick(["wrapper", "page", "container", "site"])}">{body}</div>'
    return f"<!DOCTYPE html><html>{head}<body>{body}</body></html>"
