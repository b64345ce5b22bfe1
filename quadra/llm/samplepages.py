"""Labelled sample pages to learn HTML extraction from: random layouts with invented words.

An element with ``data-content`` 1 or 0 and all inside it is main text or not;
what no such element holds is not. The layouts vary what sites vary: semantic
elements or plain blocks, telling, neutral or no class names, where menus,
notices, adverts and comments stand, unclosed tags.
"""

from __future__ import annotations

import random

LABEL = "data-content"
PAGES, SEED = 600, 13
_SYLLABLES = "ba be con da den el en er fi ga he in ka la le li ma men mi mo na no or pa per ra re ri sa sche ser so ta te ti to tra un va ver vi".split()
_NAMES = {
    "menu": ["nav", "menu", "main-menu", "navbar", "navigation", "topNav", "nav-list"],
    "head": ["header", "site-header", "masthead", "top", "page-header", "branding"],
    "foot": ["footer", "site-footer", "foot", "bottom", "page-footer", "copyright"],
    "side": ["sidebar", "side", "widget", "rail", "secondary", "widget-area", "right-column"],
    "notice": ["cookie-banner", "notice", "consent", "alert", "gdpr", "cookie-notice", "popup", "message"],
    "ad": ["ad", "ads", "advert", "ad-slot", "sponsored", "promo", "banner-ad", "advertisement"],
    "form": ["newsletter", "subscribe", "search-form", "signup", "login", "contact-form"],
    "reader": ["comments", "comment-list", "disqus_thread", "responses reply", "discussion", "user-comments"],
    "share": ["share", "social", "share-bar", "social-links", "follow"],
    "related": ["related", "related-posts", "more", "recommended", "trending", "read-more"],
    "crumbs": ["breadcrumb", "crumbs", "breadcrumbs"],
    "main": ["content", "main", "article", "post", "entry-content", "article-body", "story", "post-content", "mainContent", "text"],
    "wrap": ["wrapper", "container", "row", "layout", "page", "site", "inner"],
}


class _Writer:
    def __init__(self, rng: random.Random):
        self.rng = rng
        self.telling = rng.random() < 0.8
        # Some pages' main text is junk: repeated lines and words, bars, capitals, no marks.
        self.junk = rng.choices(("", "lines", "words", "bars", "capitals", "bare"), (70, 9, 6, 5, 5, 5))[0]
        self.line = self.words(rng.randint(1, 5)).capitalize() + rng.choice((".", ""))

    def word(self) -> str:
        return "".join(self.rng.choices(_SYLLABLES, k=self.rng.choice((1, 1, 2, 2, 3))))

    def words(self, n: int) -> str:
        return " ".join(self.word() for _ in range(n))

    def sentence(self) -> str:
        mark = self.rng.choices([".", "?", "!", ""], [90, 4, 2, 4])[0]
        odd = self.rng.random()
        body = self.words(self.rng.randint(1, 18))
        if odd < 0.03:
            body = body.replace(" ", "### ")
        elif odd < 0.06:
            body = body.replace(" ", " &amp;&amp; ")
        return body.capitalize() + mark

    def prose(self, most: int = 8) -> str:
        return " ".join(self.sentence() for _ in range(self.rng.randint(1, most)))

    def link(self, n: int = 2) -> str:
        return f'<a href="/{self.word()}">{self.words(self.rng.randint(1, n)).capitalize()}</a>'

    def named(self, tags: str, part: str, inner: str, label: int | None = None, semantic: float = 0.6) -> str:
        """An element of one of the tags (the first is the semantic one), named after its part or not."""
        options = tags.split()
        tag = options[0] if len(options) == 1 or self.rng.random() < semantic else self.rng.choice(options[1:])
        chance = self.rng.random()
        name = ""
        if chance < (0.7 if self.telling else 0.15):
            name = f' {self.rng.choice(("class", "class", "id"))}="{self.rng.choice(_NAMES[part])}"'
        elif chance < 0.8:
            name = f' class="{self.rng.choice(("box", "block", "c", "col", "x", "module"))}{self.rng.randint(1, 40)}"'
        mark = "" if label is None else f' {LABEL}="{label}"'
        return f"<{tag}{name}{mark}>{inner}</{tag}>"

    def maybe(self, chance: float, *makers) -> str:
        return "".join(m() for m in makers) if self.rng.random() < chance else ""

    # Parts that are not main text.
    def link_list(self, least: int = 2, most: int = 9, n: int = 2) -> str:
        links = [self.link(n) for _ in range(self.rng.randint(least, most))]
        style = self.rng.random()
        if style < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>"
        return (" | " if style < 0.8 else " ").join(links)

    def menu(self) -> str:
        return self.named("nav div ul", "menu", self.link_list(3, 10) if self.rng.random() < 0.95 else self.link_list(30, 90), 0)

    def crumbs(self) -> str:
        return self.named("nav div p", "crumbs", " &gt; ".join(self.link() for _ in range(self.rng.randint(2, 4))), 0, 0.3)

    def search(self) -> str:
        return self.named("form div", "form", f"<label>{self.words(2)}</label><input name=q><button>{self.word()}</button>", 0, 0.8)

    def head(self) -> str:
        logo = self.rng.choice((f"<h1>{self.link()}</h1>", f"<h1>{self.words(3)}</h1>", f"<div>{self.link()}</div>", f"<p>{self.words(3)}</p>", f"<h2>{self.words(2)}</h2>", ""))
        return self.named("header div", "head", logo + self.maybe(0.5, lambda: f"<p>{self.sentence()}</p>") + self.maybe(0.6, self.menu) + self.maybe(0.3, self.search), 0)

    def foot(self) -> str:
        owner = self.rng.choice(("&copy; {} &middot; {}", "© 20{} {}. All rights reserved.", "Copyright {} {}", "{} {}"))
        body = owner.format(self.word() + "." + self.word() if "20{}" not in owner else self.rng.randint(10, 26), self.prose(3))
        if self.rng.random() < 0.5:
            body = f"<p>{body}</p>"
        return self.named("footer div", "foot", self.maybe(0.4, self.link_list) + body + self.maybe(0.2, lambda: f"<p>{self.prose(4)}</p>"), 0, 0.7)

    def advert(self) -> str:
        body = self.rng.choice((self.prose(2), self.words(3), self.link(5), f"<p>{self.prose(5)}</p>", f"<h4>{self.words(3)}</h4><p>{self.sentence()} {self.link()}</p>"))
        chance = self.telling
        self.telling = True  # an advert that nothing tells from text cannot be learned
        out = self.named("div aside section", "ad", body, 0, 0.7)
        self.telling = chance
        return out

    def notice(self) -> str:
        said = self.rng.choice(("This site uses cookies", "We use cookies to improve this site", "Please accept our privacy policy", "Please enable JavaScript", self.sentence()))
        body = f"<p>{said} {self.prose(3)}</p>" if self.rng.random() < 0.6 else f"{said}. {self.prose(2)}"
        if self.rng.random() < 0.2:
            return f'<div {self.rng.choice(("hidden", 'style="display: none"', 'aria-hidden="true"'))} {LABEL}="0">{body}</div>'
        chance, self.telling = self.telling, True
        out = self.named("div aside section dialog", "notice", self.maybe(0.2, lambda: f"<h3>{self.words(2)}</h3>") + body + self.maybe(0.6, lambda: f"<button>{self.word()}</button>"), 0, 0.7)
        self.telling = chance
        return out

    def signup(self) -> str:
        body = f"<h3>{self.rng.choice(('Subscribe', 'Newsletter', self.words(3)))}</h3><p>{self.sentence()}</p><input type=email><button>{self.word()}</button>"
        return self.named("form div section", "form", f"<form>{body}</form>" if self.rng.random() < 0.4 else body, 0, 0.7)

    def share(self) -> str:
        return self.named("div ul", "share", self.link_list(2, 5, 1), 0)

    def related(self) -> str:
        items = "".join(f"<li>{self.link(8)}{self.maybe(0.3, lambda: f'<p>{self.sentence()}</p>')}</li>" for _ in range(self.rng.randint(2, 6)))
        return self.named("section aside div", "related", f"<h3>{self.words(2)}</h3><ul>{items}</ul>", 0, 0.3)

    def side(self) -> str:
        boxes = [f"<h3>{self.words(2)}</h3>" + self.rng.choice((self.link_list(), f"<p>{self.prose(3)}</p>", self.link_list(3, 8, 6))) for _ in range(self.rng.randint(1, 4))]
        return self.named("aside div section td", "side", "".join(f"<div>{b}</div>" if self.rng.random() < 0.5 else b for b in boxes) + self.maybe(0.3, self.advert), 0)

    def comments(self) -> str:
        def one(depth: int = 0) -> str:
            who = self.rng.choice((f"<div>{self.link()} 2 days ago</div>", f"<h4>{self.words(2)}</h4>", f"<p><b>{self.word()}</b>: {self.sentence()}</p>"))
            said = "".join(f"<p>{self.prose(6)}</p>" for _ in range(self.rng.randint(1, 3)))
            tag = self.rng.choice(("li", "div", "article"))
            name = self.rng.choice((' class="comment"', ' class="comment-body"', ' class="reply"', "", ' class="item"'))
            return f"<{tag}{name}>{who}{said}{one(depth + 1) if depth < 2 and self.rng.random() < 0.3 else ''}</{tag}>"

        chance, self.telling = self.telling, True
        items = "".join(one() for _ in range(self.rng.randint(1, 6) if self.rng.random() < 0.9 else self.rng.randint(15, 40)))
        title = self.rng.choice(("<h2>Comments</h2>", f"<h3>{self.rng.randint(2, 90)} comments</h3>", f"<h3>{self.words(2)}</h3>", ""))
        out = self.named("section div ol", "reader", title + items + self.maybe(0.4, self.signup), 0, 0.4)
        self.telling = chance
        return out

    # Main text.
    def paragraph(self) -> str:
        if self.junk and self.rng.random() < 0.9:
            said = {
                "lines": lambda: self.line, "words": lambda: " ".join([self.word()] * self.rng.randint(1, 60)),
                "bars": lambda: self.prose(2).replace(" ", " | "), "capitals": lambda: self.prose(2).upper().replace(" ", "!! "),
                "bare": lambda: self.words(self.rng.randint(1, 30)),
            }[self.junk]()
            return f"<p>{said}</p>"
        body = self.words(self.rng.randint(1, 2)).capitalize() + "." if self.rng.random() < 0.15 else self.prose()
        if self.rng.random() < 0.2:
            body = f"<b>{body}</b>" if self.rng.random() < 0.5 else f"{body} {self.link(3)} {self.sentence()}"
        if self.rng.random() < 0.1:
            body = f"<b>{body}<br>"
        return f"<p>{body}</p>" if self.rng.random() < 0.9 else f"<p>{body}"

    def block(self) -> str:
        kind = self.rng.random()
        if kind < 0.72:
            return self.paragraph()
        if kind < 0.82:
            return f"<h{(k := self.rng.choice((2, 3, 4)))}>{self.words(self.rng.randint(1, 7)).capitalize()}</h{k}>{self.paragraph()}"
        if kind < 0.88:
            tag = self.rng.choice(("ul", "ol"))
            return f"<{tag}>" + "".join(f"<li>{self.sentence()}</li>" for _ in range(self.rng.randint(2, 6))) + f"</{tag}>"
        if kind < 0.91:
            return f"<blockquote>{self.paragraph()}</blockquote>"
        if kind < 0.94:
            return f'<figure><img src="{self.word()}.jpg"><figcaption>{self.sentence()}</figcaption></figure>'
        if kind < 0.97:
            rows = "".join("<tr>" + "".join(f"<td>{self.words(2)}</td>" for _ in range(3)) + "</tr>" for _ in range(self.rng.randint(2, 4)))
            return f"<table>{rows}</table>"
        return self.rng.choice((f"<pre>{self.words(12)}</pre>", f"<div>{self.prose()}</div>", f"<section><h2>{self.words(3)}</h2>{self.paragraph()}</section>"))

    def blocks(self, inserts: float) -> list[str]:
        out = []
        for _ in range(self.rng.choice((1, 2, 3, 5, 8, 13, 21, 21 if self.junk else 2)) if self.rng.random() < 0.94 else self.rng.randint(50, 250)):
            out.append(self.paragraph() if self.junk else self.block())
            if self.rng.random() < inserts:
                out.append(self.rng.choice((self.advert, self.related, self.share, self.signup, self.side))())
        return out

    def title(self) -> str:
        body = f"<h1>{self.words(self.rng.randint(2, 12)).capitalize()}{self.rng.choice(('', '', '.', '###'))}</h1>"
        by = self.maybe(0.25, lambda: f"<p>By {self.words(2)}, {self.rng.randint(1, 28)} May 20{self.rng.randint(10, 25)}</p>")
        return f"<header>{body}{by}</header>" if self.rng.random() < 0.15 else self.maybe(0.95, lambda: body) + by

    def main(self) -> str:
        inner = self.title() + "".join(self.blocks(self.rng.choice((0, 0, 0.1))))
        tail = self.maybe(0.15, self.share) + self.maybe(0.1, lambda: f"<footer {LABEL}=0>{self.words(3)} {self.link()}</footer>") + self.maybe(0.12, self.comments)
        style = self.rng.random()
        if style < 0.45:
            out = self.named("article", "main", inner + tail, 1)
            return self.named("main div", "main", out) if self.rng.random() < 0.3 else out
        if style < 0.6:
            return self.named("main", "main", inner + tail, 1)
        if style < 0.95 or tail:
            chance, self.telling = self.telling, self.telling or self.rng.random() < 0.6
            out = self.named("div section td", "main", inner + tail, 1, 0.7)
            self.telling = chance
            return self.named("div", "wrap", out) if self.rng.random() < 0.3 else out
        marked = inner.replace("<p>", f"<p {LABEL}=1>").replace("<h1>", f"<h1 {LABEL}=1>")
        return marked if "<div" not in inner and "<section" not in inner and "<aside" not in inner else f"<div {LABEL}=1>{inner}</div>"

    def page(self) -> str:
        rng = self.rng
        if rng.random() < 0.03:  # text alone
            return rng.choice((f"<html {LABEL}=1><body {LABEL}=1>{self.prose()}", f"<body {LABEL}=1>" + "".join(self.blocks(0))))
        inner = [self.main()]
        if rng.random() < 0.45:
            inner.insert(rng.choice((0, 1)), self.side())
        after = self.maybe(0.3, self.comments) + self.maybe(0.25, self.related) + self.maybe(0.15, self.signup)
        middle = "".join(inner) + (after if rng.random() < 0.5 else "")
        if rng.random() < 0.5:
            middle = self.named("div", "wrap", middle)
        elif rng.random() < 0.15:
            middle = f"<table><tr><td>{middle}</td></tr></table>"
        if not middle.endswith(after) or not after:
            middle += after
        top = self.maybe(0.25, self.notice) + self.rng.choice((self.head, self.menu, lambda: self.head() + self.menu()))() + self.maybe(0.25, self.crumbs) + self.maybe(0.4, self.advert)
        bottom = self.maybe(0.15, self.advert) + self.maybe(0.95, self.foot) + self.maybe(0.15, self.notice)
        head = f'<head><meta charset="utf-8"><title>{self.words(4)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head>'
        return f"<!DOCTYPE html><html>{head}<body>{top}{middle}{bottom}{rng.choice(('</body></html>', '', '</body>'))}"


def labelled_pages(count: int = PAGES, seed: int = SEED) -> list[str]:
    """``count`` pages; the same ones for the same seed."""
    return [_Writer(random.Random(f"{seed} {k}")).page() for k in range(count)]
