"""Labelled pages for the extractor of main text, written by a seeded rule.

A page is assembled from regions: menus, headers, footers, sidebars, notices, adverts, forms, comments and an article, each
in one of several forms that web pages have (semantic elements, classes and ids, roles, tables, or no hint at all). The
attribute `data-label` says what an element's text is: `main` or `other`; the nearest one above a text counts. Words are
made of random syllables, so that a model learns from structure and from the shape of a text, not from a language.
"""

from __future__ import annotations

import random
from collections.abc import Callable

# Words that page authors use in class names and ids for a region.
WRAPPERS = "page wrapper site container layout outer root app row columns"
ARTICLE = "article content main post entry story text body copy prose"
MENU = "menu nav navbar navigation topnav breadcrumb breadcrumbs toc links tabs skip"
HEADER = "header masthead topbar banner branding logo hero"
FOOTER = "footer colophon bottom copyright legal credits siteinfo"
SIDEBAR = "sidebar aside side rail widget secondary complementary panel"
NOTICE = "notice cookie consent alert gdpr popup modal message warning banner overlay toast newsletter subscribe paywall promo"
ADVERT = "ad ads advert advertisement adsense sponsor sponsored promo promotion banner dfp commercial"
FORM = "form search login signup contact newsletter subscribe register poll"
COMMENT = "comment comments reply replies response responses discussion disqus thread respond feedback"
RELATED = "related recommended more popular trending also teaser share social sharing tags pagination pager recent"
# Words of texts that give a region away.
SAID = {
    "notice": "cookie cookies consent privacy accept",
    "footer": "© copyright privacy terms rights",
    "comment": "comment comments reply replies",
    "advert": "advertisement sponsored ad",
    "form": "subscribe newsletter login search email",
    "related": "share related tags",
}
LETTERS = ["aeiou bcdfghlmnprstvw", "äöüaeiou bdfgklmnrstzß", "éèaeiou bcdlmnprtvç", "аеио бвгдклмнпрст"]


class Writer:
    """One page; every choice is drawn from the seed."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        vowels, consonants = self.r.choice(LETTERS).split()
        self.syllables = [c + v for c in consonants for v in vowels]
        self.bare = self.r.random() < 0.15  # a page whose classes say nothing

    def maybe(self, p: float, make: Callable[[], str]) -> str:
        return make() if self.r.random() < p else ""

    def word(self) -> str:
        return "".join(self.r.choice(self.syllables) for _ in range(self.r.choice((1, 1, 2, 2, 3, 4))))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 1, high: int = 18) -> str:
        s = self.words(low, high).capitalize()
        if self.r.random() < 0.15:
            s = s.replace(" ", self.r.choice((", ", " &amp; ", "&nbsp;", " - ")), 1)
        return s + self.r.choice("......?!:")

    def said(self, kind: str, text: str) -> str:
        return f"{self.r.choice(SAID[kind].split())} {text}" if self.r.random() < 0.4 else text

    def prose(self, low: int = 1, high: int = 6) -> str:
        out = [self.sentence() for _ in range(self.r.randint(low, high))]
        k = self.r.randrange(len(out))
        tag = self.r.choice(("", "", "", "b", "em", "strong", "a href=/x", "span", "i", "code"))
        if tag:
            out[k] = f"<{tag}>{out[k]}</{tag.split()[0]}>"
        return " ".join(out)

    def hint(self, kinds: str, role: str = "") -> str:
        """Attributes of a region's element."""
        if self.bare or self.r.random() < 0.08:
            return self.r.choice(("", "", f' class="css-{self.r.randrange(9999)}"', f' class="{self.word()}"'))
        name = self.r.choice(kinds.split())
        more = self.r.choice(("", "", "", "s", "-inner", "-box", "-wrap", "-container", "-area", "-list", "-1", " " + self.word()))
        before = self.r.choice(("", "", "", "site-", "page-", "main-", "c-", "post-", "article-", "top-"))
        out = f' {self.r.choice(("class", "class", "id"))}="{before}{name}{more}"'
        return out + (f' role="{role}"' if role and self.r.random() < 0.25 else "")

    def region(self, tags: str, kinds: str, inner: str, role: str = "", label: str = "other") -> str:
        """An element of one of the tags; one that is no plain box may do without a hint."""
        tag = self.r.choice(tags.split())
        hint = "" if tag not in ("div", "section", "ul", "td", "p", "span") and self.r.random() < 0.5 else self.hint(kinds, role)
        return f'<{tag}{hint} data-label="{label}">{inner}</{tag}>'

    def links(self, low: int = 2, high: int = 8) -> str:
        each = [f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(self.r.randint(low, high))]
        form = self.r.randrange(4)
        if form == 0:
            return "<ul>" + "".join(f"<li>{a}</li>" for a in each) + "</ul>"
        if form == 1:
            return "<ul>" + "".join(f"<li>{a}" for a in each) + "</ul>"
        return self.r.choice((" | ", " ", " &middot; ", "<br>", " &gt; ")).join(each)

    def menu(self) -> str:
        return self.region("nav nav ul div div", MENU, self.links(), "navigation")

    def header(self) -> str:
        name = self.r.choice(("<h1>{}</h1>", "<h1>{}</h1>", "<h1><a href=/>{}</a></h1>", "<a href=/>{}</a>", "<p>{}</p>", "<div>{}</div>", "<h2>{}</h2>")).format(self.words(1, 4))
        return self.region("header header div div", HEADER, name + self.maybe(0.4, lambda: f"<p>{self.sentence(2, 8)}</p>") + self.maybe(0.5, self.menu), "banner")

    def footer(self) -> str:
        parts = [self.maybe(0.5, lambda: f"<p>{self.said('footer', self.prose(1, 2))}</p>"), self.maybe(0.4, self.links), f"&copy; {self.words(1, 3)} &middot; {self.sentence()}"]
        self.r.shuffle(parts)
        return self.region("footer footer footer div div", FOOTER, "".join(parts), "contentinfo")

    def notice(self) -> str:
        inner = self.r.choice(("<p>{}</p>", "{}", "<div>{}</div>")).format(self.said("notice", self.prose(1, 3)))
        return self.region("div div div section aside dialog", NOTICE, inner + self.maybe(0.4, lambda: f"<button>{self.word()}</button>"), "alert")

    def advert(self) -> str:
        inner = self.r.choice(("{}", "{}", "<p>{}</p>", "<a href=/x>{}</a>", "<span>{}</span>")).format(self.said("advert", self.prose(1, 3)))
        return self.region("div div div aside section ins", ADVERT, inner)

    def form(self) -> str:
        fields = "".join(f"<label>{self.words(1, 3)}</label><input name=x>" for _ in range(self.r.randint(1, 4)))
        more = self.maybe(0.5, lambda: f"<p>{self.said('form', self.prose(1, 2))}</p>") + self.maybe(0.3, lambda: "<select>" + "".join(f"<option>{self.word()}" for _ in range(3)) + "</select>")
        return self.region("form form form div", FORM, more + fields + self.maybe(0.7, lambda: f"<button type=submit>{self.words(1, 2)}</button>"), "search")

    def related(self) -> str:
        items = "".join(self.r.choice(("<li><a href=/x>{}</a></li>", "<div><a href=/x>{}</a></div>", "<h3><a href=/x>{}</a></h3><p>{}</p>")).replace("{}", self.sentence(2, 9)) for _ in range(self.r.randint(1, 5)))
        return self.region("div div section aside ul nav", RELATED, self.maybe(0.5, lambda: f"<h3>{self.said('related', self.words(1, 3))}</h3>") + items)

    def sidebar(self) -> str:
        parts = [self.r.choice((self.related, self.advert, self.form, self.menu, lambda: f"<h3>{self.words(1, 3)}</h3><p>{self.prose(1, 3)}</p>", lambda: f"<p>{self.prose(1, 2)}</p>"))() for _ in range(self.r.randint(1, 4))]
        return self.region("aside aside aside div div", SIDEBAR, "".join(parts), "complementary")

    def comments(self) -> str:
        def one() -> str:
            text = self.r.choice(("<p>{}</p>", "<div>{}</div>", "{}")).format(self.prose(1, 6))
            return self.region("div div li article section", COMMENT, self.maybe(0.7, lambda: f"<b>{self.words(1, 2)}</b> <time>{self.r.randrange(60)}</time>") + text)

        inner = self.maybe(0.6, lambda: f"<h3>{self.said('comment', self.words(1, 2))}</h3>") + "".join(one() for _ in range(self.r.randint(1, 5)))
        return self.region("section section div div ol ul", COMMENT, inner + self.maybe(0.3, self.form))

    def paragraph(self) -> str:
        p = self.prose(*self.r.choice(((1, 1), (1, 3), (2, 8), (4, 12))))
        odd = self.r.random()
        if odd < 0.15:
            p = self.r.choice((self.word().capitalize() + ".", self.word(), self.word()[0]))
        elif odd < 0.25:  # what tables, lists and logs leave in a text
            p = self.r.choice((" | ", " ", " &middot; ", "; ")).join(self.r.choice((self.word(), str(self.r.randrange(10**6)), self.word() + self.r.choice(("###", "!!!", ",", "%")))) for _ in range(self.r.randint(3, 60)))
        return self.r.choice(("<p>{}</p>",) * 6 + ("<p>{}", "<p><b>{}<br>", "<div>{}</div>", "<p class=x>{}</p>", "{}<br><br>")).format(p)

    def extra(self) -> str:
        """What an article has besides paragraphs."""
        k = self.r.randrange(8)
        if k < 3:
            return f"<h{k + 2}>{self.words(1, 7)}</h{k + 2}>"
        if k < 5:
            kind = self.r.choice(("ul", "ol"))
            return f"<{kind}>" + "".join(f"<li>{self.r.choice((self.words(1, 4), self.sentence(), self.prose()))}</li>" for _ in range(self.r.randint(1, 6))) + f"</{kind}>"
        if k == 5:
            return f"<blockquote>{self.r.choice(('{}', '<p>{}</p>')).format(self.prose())}</blockquote>"
        if k == 6:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{self.words(1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(self.r.randint(1, 4))) + "</table>"
        return self.r.choice((f"<figure><img src=x><figcaption>{self.sentence()}</figcaption></figure>", f"<pre><code>{self.words(2, 20)}</code></pre>", f"<section><h2>{self.words(1, 5)}</h2>{self.paragraph()}</section>", f"<dl><dt>{self.word()}<dd>{self.sentence()}</dl>"))

    def article(self) -> str:
        title = self.maybe(0.8, lambda: self.r.choice(("<h1>{}</h1>",) * 4 + ("<header><h1>{}</h1></header>", "<header{h}><h1>{}</h1></header>", "<h2>{}</h2>", '<h1 class="title">{}</h1>', '<div class="title">{}</div>')).format(self.r.choice((self.words(1, 9), self.sentence(2, 9))), h=self.hint(ARTICLE + " header title")))
        parts = [self.paragraph() if self.r.random() < 0.75 else self.extra() for _ in range(self.r.choice((1, 2, 3, 5, 8, 14)))]
        if self.r.random() < 0.1:  # text without paragraphs
            parts = [self.prose() + self.r.choice((" ", "<br>", "<hr>")) for _ in parts]
        elif self.r.random() < 0.1:  # very short ones
            parts = [f"<p>{self.sentence(1, 2)}</p>" for _ in parts]
        for make, p in ((self.advert, 0.2), (self.notice, 0.08), (self.related, 0.15), (self.form, 0.08), (self.sidebar, 0.08), (self.menu, 0.06)):
            if self.r.random() < p:
                parts.insert(self.r.randint(0, len(parts)), make())
        inner = title + "".join(parts) + self.maybe(0.12, self.footer) + self.maybe(0.15, self.comments)
        kind = self.r.randrange(10)
        if kind < 5:
            out = f'<article{self.hint(ARTICLE) if self.r.random() < 0.4 else ""} data-label="main">{inner}</article>'
        elif kind < 6:
            out = f'<main data-label="main">{inner}</main>'
        else:
            out = self.region("div div div section td", ARTICLE, inner, "main", "main")
            out = f"<table><tr>{out}</tr></table>" if out.startswith("<td") else out
        return f"<main>{out}</main>" if kind < 3 and self.r.random() < 0.5 else out

    def page(self) -> str:
        return self.whole(self.bald() if self.r.random() < 0.06 else self.article() if self.r.random() < 0.1 else self.around(self.article()))

    def whole(self, inner: str) -> str:
        return f'<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{margin:0}}</style></head><body data-label="other">{inner}</body></html>'

    def bald(self) -> str:
        """Text without any region."""
        return f'<div data-label="main">{"".join(self.paragraph() for _ in range(self.r.randint(1, 4)))}</div>'

    def around(self, article: str) -> str:
        """The regions of a site about an article."""
        centre = [article]
        for make, p in ((self.sidebar, 0.4), (self.advert, 0.25), (self.related, 0.2)):
            if self.r.random() < p:
                centre.insert(self.r.randint(0, len(centre)), make())
        body = "".join(centre) + self.maybe(0.35, self.comments)
        if self.r.random() < 0.35:
            body = f"<div{self.hint(WRAPPERS + ' content main body')}>{body}</div>"
        before = [self.maybe(p, make) for make, p in ((self.header, 0.5), (self.menu, 0.6), (self.notice, 0.3), (self.advert, 0.4), (self.form, 0.15))]
        after = [self.maybe(p, make) for make, p in ((self.related, 0.2), (self.notice, 0.15), (self.form, 0.15), (self.advert, 0.15))]
        self.r.shuffle(after)
        if self.r.random() < 0.3:
            self.r.shuffle(before)
        inner = "".join(before) + body + "".join(after) + self.maybe(0.85, self.footer)
        if self.r.random() < 0.4:
            inner = f"<div{self.hint(WRAPPERS)}>{inner}</div>"
        return inner


def labelled_pages(n: int = 1000, seed: int = 11) -> list[str]:
    return [Writer(seed * 1_000_003 + k).page() for k in range(n)]
