"""Labelled pages to train the page model on: invented text in the page frames that sites use.

Every part of a frame is marked content (``data-y="1"``) or not (``data-y="0"``). Frames differ in elements,
in names of classes and ids and in order; some have no names at all, so that text and place must tell.
Names are the common words by which sites call such parts. All choices come from one seeded generator.
"""

from __future__ import annotations

import random
from collections.abc import Callable

SYLLABLES = "ta ri no shel qua mor vin del ka su por lim ent ar ü ös é la con zhi ben ost ñu gra per tol ish".split()
CONTENT = "content post entry article story main body text article-body post-content entry-content articleBody page-content post-body article__body story-text main-content".split()
HEADER = "header masthead site-header top topbar banner logo branding page-header".split()
MENU = "nav menu navigation navbar main-menu primary-nav menubar breadcrumb breadcrumbs tabs toolbar site-nav".split()
FOOTER = "footer site-footer bottom colophon copyright legal page-footer foot".split()
SIDE = "sidebar side aside widget widget-area rail right-column related related-posts recommended popular trending tags tag-cloud archive categories more-stories".split()
ADVERT = "ad ads advert advertisement ad-slot banner-ad sponsored sponsor promo promotion adsense dfp-ad partner-content".split()
NOTICE = "notice cookie cookie-banner consent gdpr alert popup modal overlay message paywall cookie-notice toast announcement".split()
FORM = "newsletter subscribe signup search login search-form contact-form subscription register feedback".split()
SOCIAL = "share social social-share sharing share-buttons follow".split()
COMMENTS = "comments comment comment-list reader-comments discussion replies responses disqus respond comment-body reply reviews".split()
INNER = "lead intro summary byline author dateline caption paragraph block wrapper row text-block quote highlight chapter columns inner".split()
PAGER = "pagination pager page-numbers prev-next post-navigation".split()

#: Names that say how an element looks and not what it holds; on elements of any kind, often many at once.
UTILITIES = (
    "flex md:flex-row flex-col px-4 py-2 mt-8 mb-6 grid lg:grid-cols-3 gap-4 text-sm text-gray-700 font-bold rounded-lg shadow-md border bg-white "
    "w-full max-w-3xl mx-auto items-center justify-between leading-7 tracking-wide col-12 row container d-flex p-3 m-0 clearfix is-active "
    "js-hook relative z-10 overflow-hidden space-y-2 sm:inline-block order-last prose-lg dark:bg-black hover:underline").split()


class Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.own = random.Random(seed + 1)
        self.junk = 0  # main text may be noise too: it still is the page's main text

    def extra(self, chance: float, part: Callable[[], str]) -> str:
        """A part by a generator of its own: all else on the pages is the same with and without such parts."""
        self.r, self.own = self.own, self.r
        text = part() if self.r.random() < chance else ""
        self.r, self.own = self.own, self.r
        return text

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 4, high: int = 18) -> str:
        return self.words(low, high).capitalize() + self.r.choice([".", ".", ".", "?", "!", ", " + self.words(2, 6) + "."])

    def prose(self, low: int = 1, high: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(low, high)))

    def utilities(self) -> str:
        return " ".join(self.r.sample(UTILITIES, self.r.randint(3, 26)))

    def wrapped(self, inner: str) -> str:
        """Now and then inside elements that have nothing but such names."""
        for _ in range(4):
            if names := self.extra(0.3, self.utilities):
                inner = f'<div class="{names}">{inner}</div>'
        return inner

    def named(self, names: list[str]) -> str:
        kind = self.r.choice(["class", "class", "id", "class2"])
        name = self.r.choice(names)
        looks = self.extra(0.2, self.utilities)
        if kind == "class2":
            return f' class="{self.word()} {name}{looks and " " + looks}"'
        if kind == "id":
            return f' id="{name}"' + (looks and f' class="{looks}"')
        return f' class="{looks and looks + " "}{name}"'

    def links(self, low: int, high: int, listed: bool = True) -> str:
        one = lambda: f'<a href="/{self.word()}">{self.words(1, 4)}</a>'
        n = self.r.randint(low, high)
        if listed:
            return "<ul>" + "".join(f"<li>{one()}</li>" for _ in range(n)) + "</ul>"
        return self.r.choice([" | ", " &middot; ", " "]).join(one() for _ in range(n))

    def box(self, label: int, inner: str, names: list[str], tags: list[str], plain: float = 0.05) -> str:
        tag = self.r.choice(tags)
        name = "" if self.r.random() < plain else self.named(names)
        return f'<{tag}{name} data-y="{label}">{self.wrapped(inner)}</{tag}>'

    def paragraph(self) -> str:
        text = self.prose(*self.r.choice([(1, 1), (1, 3), (2, 6), (4, 9)]))
        if self.r.random() < 0.2:
            text = text.replace(" ", f' <a href="/{self.word()}">{self.words(1, 3)}</a> ', 1)
        if self.r.random() < 0.1:
            text = f"<b>{text}<br>"
        text += self.extra(0.04, lambda: self.r.choice([f" <math><mi>{self.word()}</mi><mo>=</mo><mn>2</mn></math>.", ' <svg><path d="M0"/></svg>', " <svg-icon></svg-icon>"]))
        if self.junk == 1:
            text = " ".join(w + self.r.choice(["%%%", "***", "&amp;&amp;", "###"]) for w in text.split(" "))
        elif self.junk == 2:
            text = " ".join([self.word()] * self.r.randint(5, 60))
        elif self.junk == 3:
            text = " | ".join(text.split(" "))
        elif self.junk == 4:
            text = text.upper().replace(" ", "!! ")
        return self.r.choice([f"<p>{text}</p>"] * 6 + [f"<p>{text}", f"<div>{text}</div>"])

    def article(self) -> str:
        parts = [f"<h1>{self.r.choice([self.words(1, 9), self.prose(1, 2)])}</h1>"] if self.r.random() < 0.85 else []
        for _ in range(self.r.randint(1, 9)):
            parts.append(self.paragraph())
            luck = self.r.random()
            if luck < 0.08:
                parts.append(f"<h2>{self.words(1, 7)}</h2>")
            elif luck < 0.14:
                parts.append("<ul>" + "".join(f"<li>{self.sentence()}</li>" for _ in range(self.r.randint(2, 6))) + "</ul>")
            elif luck < 0.18:
                parts.append(f"<blockquote>{self.paragraph()}</blockquote>")
            elif luck < 0.21:
                parts.append(f"<pre>{self.words(3, 12)}</pre>")
            elif luck < 0.24:
                parts.append("<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 5)}</td></tr>" for _ in range(3)) + "</table>")
            elif luck < 0.38:
                parts.append(f'<{(t := self.r.choice(["div", "section", "p", "figure"]))}{self.named([*INNER, self.word()])}>{self.r.choice([self.words(2, 6), self.paragraph()])}</{t}>')
            elif luck < 0.44:
                parts.append(self.advert())
            elif luck < 0.47:
                parts.append(self.box(0, self.links(2, 5), SIDE, ["div", "aside"], 0))
            elif luck < 0.50:
                parts.append(self.box(0, self.links(2, 5, False), SOCIAL, ["div", "p"], 0))
            parts.append(self.extra(0.06, lambda: self.embedded(self.r.choice([f"<p>{self.prose()}</p>", self.prose(1, 2)]))))
            parts.append(self.extra(0.02, self.options))
        return "".join(parts)

    def embedded(self, inner: str) -> str:
        """What an embedded element holds is of the kind of its surroundings."""
        tag = self.r.choice("noscript svg iframe object canvas audio video".split())
        return f"<{tag}>" + (f"<text>{self.words(1, 5)}</text>" if tag == "svg" else inner) + f"</{tag}>"

    def options(self) -> str:
        inner = "".join(f"<option>{self.words(1, 3)}</option>" for _ in range(self.r.randint(2, 8)))
        return f'<{(t := self.r.choice(["select", "select", "datalist"]))} data-y="0">{inner}</{t}>'

    def advert(self) -> str:
        return self.box(0, self.r.choice([self.prose(1, 2), f"<p>{self.prose(1, 3)}</p>", f'<a href="/x">{self.words(2, 8)}</a>']) + self.extra(0.2, lambda: self.embedded(self.prose(1, 2))), ADVERT, ["div", "div", "aside", "section"], 0)

    def comments(self) -> str:
        one = lambda: f'<{(t := self.r.choice(["li", "div", "article"]))} class="{self.r.choice(["comment", "reply", self.word()])}"><p>{self.prose(1, 4)}</p></{t}>'
        return self.box(0, (f"<h3>{self.words(1, 2)}</h3>" if self.r.random() < 0.6 else "") + "".join(one() for _ in range(self.r.randint(1, 8))), COMMENTS, ["div", "section", "ol", "aside"], 0)

    def notice(self) -> str:
        return self.box(0, self.r.choice([f"<p>{self.prose(1, 3)}</p><button>{self.word()}</button>", self.prose(1, 2)]), NOTICE, ["div", "section", "aside", "dialog"], 0)

    def form(self) -> str:
        return self.box(0, f'<form action="/x"><label>{self.words(1, 4)}</label><input name="q">{self.extra(0.3, self.options)}<p>{self.prose(1, 2)}</p><button>{self.word()}</button></form>', FORM, ["div", "section"], 0.3)

    def bare(self) -> str:
        """A page without any frame."""
        inner = self.r.choice([self.prose(1, 8), self.article(), "".join(self.paragraph() for _ in range(self.r.randint(1, 6)))])
        inner = f'<div data-y="1">{inner}</div>'
        return self.r.choice([inner, f"<html><body>{inner}</body></html>", f"<body><h1 data-y=\"1\">{self.words(1, 6)}</h1>{inner}"])

    def page(self) -> str:
        if self.r.random() < 0.06:
            return self.bare()
        body, open_body = [], 0
        maybe = lambda chance, part: body.append(part()) if self.r.random() < chance else None
        maybe(0.2, self.notice)
        body.append(self.extra(0.1, lambda: f'<noscript data-y="0">{self.prose(1, 1)}</noscript>'))
        maybe(0.4, lambda: self.box(0, self.r.choice([f"<h1>{self.words(1, 4)}</h1>", f'<a href="/">{self.words(1, 3)}</a>', self.words(1, 4)]) + (f"<p>{self.sentence()}</p>" if self.r.random() < 0.4 else ""), HEADER, ["header", "div", "div"]))
        maybe(0.85, lambda: self.box(0, self.links(3, 9, self.r.random() < 0.75), MENU, ["nav", "nav", "div"]))
        maybe(0.3, self.advert)
        maybe(0.12, self.form)
        early_side = self.r.random() < 0.3
        side = lambda: self.box(0, f"<h3>{self.words(1, 3)}</h3>" + self.r.choice([self.links(3, 8), f"<p>{self.prose(1, 3)}</p>", self.links(2, 6) + f"<p>{self.prose(1, 2)}</p>"]), SIDE, ["aside", "div", "section"], 0.1)
        if early_side:
            maybe(0.6, side)
        self.junk = self.r.choice([0, 0, 0, 0, 0, 0, 1, 2, 3, 4])
        article = self.article()
        self.junk = 0
        style = self.r.random()
        inside = self.comments() if self.r.random() < 0.12 else ""
        if style < 0.45:
            main = f'<article{self.named(CONTENT) if self.r.random() < 0.4 else ""} data-y="1">{self.wrapped(article)}{inside}</article>'
        elif style < 0.8:
            main = self.box(1, article + inside, CONTENT, ["div", "div", "section", "main"], 0)
        elif style < 0.86:
            main = f'<div data-y="1">{article}{inside}</div>'
        elif style < 0.92:  # no element of its own: all other parts carry their own labels
            main, open_body = article, 1
        else:
            main = f'<table><tr><td data-y="0">{self.links(3, 6)}</td><td data-y="1">{article}</td></tr></table>'
        body.append(f"<main>{main}</main>" if self.r.random() < 0.25 else main)
        maybe(0.15, lambda: self.box(0, self.links(2, 4, False), SOCIAL, ["div", "ul"], 0))
        maybe(0.15, lambda: self.box(0, self.links(2, 5, False), PAGER, ["div", "nav"], 0))
        maybe(0.3, self.comments)
        if not early_side:
            maybe(0.45, side)
        maybe(0.2, self.form)
        maybe(0.15, self.advert)
        maybe(0.9, lambda: self.box(0, self.r.choice(["&copy; ", "", "Copyright "]) + self.r.choice([self.prose(1, 2), self.words(2, 8) + " &middot; " + self.links(2, 4, False), f"<p>{self.prose(1, 2)}</p>" + self.links(2, 6)]), FOOTER, ["footer", "footer", "div"], 0.1))
        maybe(0.08, self.notice)
        return f'<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style></head><body data-y="{open_body}">{"".join(body)}</body></html>'


def pages(count: int, seed: int = 5) -> list[str]:
    writer = Writer(seed)
    short = lambda: f'<{(t := writer.r.choice(["div", "p", "body"]))} data-y="1">{writer.words(1, 12)}</{t}>'
    return [writer.extra(0.03, short) or writer.page() for _ in range(count)]  # some pages are a few words and nothing else
