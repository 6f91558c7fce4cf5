"""Made-up pages with marked blocks, for the block labeller to learn from.

Every page is an article among other parts. Containers, tags, class names, order and
texts are drawn at random, and telling tags and classes are left out now and then.
All texts are made of the same made-up words, so that length and place count, too;
the words below occur in the parts they name.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

MARK = "data-part"  # the attribute that says 1 for the article, 0 for the rest

# Words and class names by which pages name their parts.
MENU = "home about contact news blog shop products services help search login register archive start kontakt accueil inicio".split()
FOOTER = "© copyright all rights reserved privacy policy terms imprint impressum sitemap powered by 2024 datenschutz mentions".split()
NOTICE = "cookies cookie we use accept consent agree this site subscribe newsletter sign up continue browser javascript required".split()
ADVERT = "advertisement sponsored buy now offer discount sale free shipping only today order anzeige publicité".split()
COMMENTS = "comments comment reply says posted ago likes report great thanks agree kommentare commentaires responses".split()
RELATED = "related popular read more recommended you may also like share tweet follow us latest trending tags recent".split()
FORM = "name email password submit send search message your select country choose required send".split()

CONTENT_CLASSES = "article content main post entry story body text blog single news copy prose".split()
OTHER_CLASSES = {
    "menu": "nav menu navbar topnav navigation breadcrumb breadcrumbs links mainnav tabs".split(),
    "header": "header masthead logo branding top sitename topbar head".split(),
    "footer": "footer bottom copyright colophon legal foot sitemap".split(),
    "sidebar": "sidebar aside widget rail related popular trending recent secondary complementary".split(),
    "advert": "ad ads advert advertisement sponsored promo promotion banner adslot sponsor".split(),
    "notice": "cookie consent notice alert gdpr popup modal overlay newsletter subscribe paywall warning".split(),
    "form": "form search login signup contact register feedback".split(),
    "comments": "comments comment discussion replies respond disqus thread feedback".split(),
    "share": "share social tags meta sharing toolbar".split(),
}
NEUTRAL = "site page block container wrapper col row inner outer section box area list item left right wide grid".split()


class Page:
    """One page in the making."""

    def __init__(self, rng: random.Random):
        self.rng = rng
        syllables = ["".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiouäéóü") for _ in range(2)) for _ in range(40)]
        self.words = ["".join(rng.choices(syllables, k=rng.randrange(1, 4)))[: rng.randrange(2, 12)] for _ in range(150)]
        self.plain = rng.random() < 0.15  # a page whose containers have no classes
        self.style = rng.choices(["prose", "bars", "signs", "data", "same", "mixed"], [68, 6, 6, 6, 4, 10])[0]

    def sentence(self, least: int = 3, most: int = 25, of: list[str] = ()) -> str:
        rng = self.rng
        words = [
            rng.choice(of) if of and rng.random() < 0.5 else rng.choice(self.words) for _ in range(rng.randint(least, most))
        ]
        if rng.random() < 0.1:
            words[rng.randrange(len(words))] += rng.choice([" &amp;", "&nbsp;", "***", " 42", "&eacute;"])
        return " ".join(words).capitalize() + rng.choice([".", ".", ".", ".", "!", "?", ""])

    def prose(self, most: int = 6) -> str:
        if self.rng.random() < 0.03:
            most *= 20
        text = " ".join(self.sentence() for _ in range(self.rng.randint(1, most)))
        return self.styled(self.sentence(1, 4) if self.rng.random() < 0.12 else text)

    def styled(self, text: str) -> str:
        """The article's text as tables without markup, with stray signs, or full of numbers, names and mentions."""
        rng = self.rng
        style = rng.choice(["bars", "signs", "data", "same", "menu"]) if self.style == "mixed" and rng.random() < 0.3 else self.style
        if style == "bars":
            return rng.choice([" | ", " | ", " · ", " / "]).join(text.split())
        if style == "signs":
            return " ".join(w + rng.choice(["***", "###", "$$$", "&amp;&amp;&amp;", "%%%", "~~"]) for w in text.split())
        if style == "data":
            extra = ["+1 555 0100 42", "someone@example.com", "key=ab12cd34ef", "https://example.org/x", "10.0.0.1", "1234", "(MIT)"]
            return " ".join(w if rng.random() < 0.8 else rng.choice(extra) for w in text.split())
        if style == "same":
            return " ".join([rng.choice(self.words).capitalize() + rng.choice(["", ".", ","])] * rng.randint(2, 40))
        if style == "menu":  # words that are common in other parts
            return text + " " + " ".join(rng.choices(MENU + FOOTER + NOTICE + ADVERT + RELATED + COMMENTS, k=rng.randint(1, 5)))
        return text

    def inline(self, text: str) -> str:
        rng, words = self.rng, text.split(" ")
        if rng.random() < 0.25 and len(words) > 3:
            tag = rng.choice(["a href='/x'", "b", "em", "span", "i", "code", "strong"])
            at = rng.randrange(len(words) - 2)
            words[at] = f"<{tag}>{words[at]}"
            words[at + 1] += f"</{tag.split()[0]}>"
        return " ".join(words)

    def box(self, kind: str, tags: list[str], inside: str, mark: int) -> str:
        rng = self.rng
        tag = rng.choice(tags)
        names = CONTENT_CLASSES if kind == "content" else OTHER_CLASSES[kind]
        telling = tag not in ("div", "section", "td") or rng.random() < 0.9
        given = ""
        if not self.plain and telling and rng.random() < 0.85 or tag == "div" and kind in ("advert", "notice", "share"):
            words = [rng.choice(names), *rng.sample(NEUTRAL, rng.choice([0, 0, 1, 1, 2]))]
            if rng.random() < 0.2:
                words.append(rng.choice(names))
            rng.shuffle(words)
            given = f' {rng.choice(["class", "class", "class", "id"])}="{rng.choice(["-", " ", "_"]).join(words)}"'
        elif rng.random() < 0.3:
            given = f' class="{rng.choice(NEUTRAL)}{rng.randrange(9)}"'
        made = f'<{tag}{given} {MARK}="{mark}">{inside}</{tag}>'
        return f"<div class='{rng.choice(NEUTRAL)}'>{made}</div>" if rng.random() < 0.15 else made

    # Parts of the article

    def heading(self, tag: str) -> str:
        return f"<{tag}>{self.styled(self.sentence(1, 14))}</{tag}>"

    def body(self) -> str:
        rng, parts = self.rng, []
        for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 9, 14, 25])):
            kind = rng.random()
            if kind < 0.72:
                parts.append(f"<p>{self.inline(self.prose())}</p>")
            elif kind < 0.8:  # unclosed, as found in the wild
                parts.append(f"<p><b>{self.prose(2)}<br><p>{self.prose()}</p>")
            elif kind < 0.86:
                parts.append(self.heading(rng.choice(["h2", "h3", "h4"])) + f"<p>{self.prose()}</p>")
            elif kind < 0.9:
                items = "".join(f"<li>{self.inline(self.sentence(2, 18))}</li>" for _ in range(rng.randint(2, 6)))
                parts.append(f"<{(tag := rng.choice(['ul', 'ol']))}>{items}</{tag}>")
            elif kind < 0.93:
                parts.append(f"<blockquote>{rng.choice(['', '<p>'])}{self.prose(2)}</blockquote>")
            elif kind < 0.95:
                parts.append(f"<pre>{self.sentence()}</pre>")
            elif kind < 0.97:
                rows = "".join(f"<tr><td>{self.sentence(1, 3)}</td><td>{self.sentence(1, 5)}</td></tr>" for _ in range(3))
                parts.append(f"<table>{rows}</table>")
            elif kind < 0.985:
                parts.append(f"<figure><img src='x'><figcaption>{self.sentence(3, 12)}</figcaption></figure>")
            else:
                parts.append(f"<div>{self.prose()}</div>")
            if rng.random() < 0.04:  # something else in the middle
                parts.append(rng.choice([self.advert, self.notice, self.share, self.related])())
        return "".join(parts)

    def article(self) -> str:
        rng = self.rng
        title = self.heading("h1") if rng.random() < 0.9 else ""
        if title and rng.random() < 0.1:
            title = f'<header class="{rng.choice(CONTENT_CLASSES)}-header">{title}</header>'
        tags = ["article", "article", "article", "main", "div", "div", "section", "td"]
        if rng.random() < 0.15 and title:
            return f'<div {MARK}="1">{title}</div>' + self.box("content", tags, self.body(), 1)
        if rng.random() < 0.06:
            return f'<div {MARK}="1">{title}{self.body()}</div>'
        return self.box("content", tags, title + self.body(), 1)

    # Everything else

    def links(self, of: list[str], most: int = 9) -> str:
        rng = self.rng
        texts = [rng.choice(of).capitalize() if rng.random() < 0.5 else self.sentence(1, 3).rstrip(".") for _ in range(rng.randint(2, most))]
        if rng.random() < 0.7:
            return "<ul>" + "".join(f'<li><a href="/{t}">{t}</a></li>' for t in texts) + "</ul>"
        return rng.choice([" ", " | ", " &middot; "]).join(f"<a href='#'>{t}</a>" for t in texts)

    def menu(self) -> str:
        return self.box("menu", ["nav", "nav", "div", "ul"], self.links(MENU), 0)

    def header(self) -> str:
        rng = self.rng
        name = rng.choice([f"<a href='/'>{self.sentence(1, 3)}</a>", f"<div>{self.sentence(1, 4)}</div>", f"<p>{self.sentence(2, 9)}</p>"])
        return self.box("header", ["header", "header", "div"], name + (self.menu() if rng.random() < 0.3 else ""), 0)

    def footer(self) -> str:
        rng = self.rng
        text = rng.choice(["&copy; ", "&copy; host.example.com &middot; ", ""]) + self.sentence(2, 14, FOOTER)
        parts = [text if rng.random() < 0.5 else f"<p>{text}</p>"]
        if rng.random() < 0.4:
            parts.insert(rng.randrange(2), self.links(FOOTER + MENU))
        return self.box("footer", ["footer", "footer", "footer", "div"], "".join(parts), 0)

    def sidebar(self) -> str:
        rng = self.rng
        parts = [f"<h3>{self.sentence(1, 4, RELATED)}</h3>"] if rng.random() < 0.7 else []
        parts.append(rng.choice([self.links(RELATED), f"<p>{self.prose(2)}</p>", f"<div>{self.sentence()}</div>"]))
        return self.box("sidebar", ["aside", "aside", "div"], "".join(parts), 0)

    def related(self) -> str:
        return self.box("sidebar", ["aside", "div", "section"], f"<h4>{self.sentence(1, 4, RELATED)}</h4>{self.links(RELATED)}", 0)

    def advert(self) -> str:
        text = self.sentence(2, 18, ADVERT if self.rng.random() < 0.5 else [])
        return "<!-- ad -->" + self.box("advert", ["div", "div", "aside"], self.rng.choice([text, f"<p>{text}</p>"]), 0)

    def notice(self) -> str:
        text = " ".join(self.sentence(3, 12, NOTICE) for _ in range(self.rng.randint(1, 2)))
        button = self.rng.choice(["", f"<button>{self.sentence(1, 2, NOTICE)}</button>", "<a href='#'>OK</a>"])
        return self.box("notice", ["div", "div", "section", "dialog"], self.rng.choice([text, f"<p>{text}</p>"]) + button, 0)

    def form(self) -> str:
        rng = self.rng
        fields = "".join(
            rng.choice([f"<label>{self.sentence(1, 3, FORM)}</label><input name='x'>", f"<p>{self.sentence(1, 6, FORM)}</p><input>",
                        f"<select><option>{self.sentence(1, 2)}<option>{self.sentence(1, 2)}</select>"])
            for _ in range(rng.randint(1, 4))
        )
        inside = f"<form action='/go' {MARK}='0'>{fields}<button>{self.sentence(1, 2, FORM)}</button></form>"
        return self.box("form", ["div", "section"], inside, 0)

    def share(self) -> str:
        return self.box("share", ["div", "ul"], self.links(RELATED, 5), 0)

    def comments(self) -> str:
        rng = self.rng
        parts = [f"<h3>{self.sentence(1, 3, COMMENTS)}</h3>"] if rng.random() < 0.8 else []
        style = rng.choice([0, 0, 1, 2, 3, 3])
        for _ in range(rng.randint(1, 6)):
            who, text = f"{self.sentence(1, 2)} {rng.choice(COMMENTS)}", self.prose(3)
            if style == 0:
                parts.append(f"<div class='comment'><b>{who}</b><p>{text}</p></div>")
            elif style == 3:
                parts.append(f"<p>{rng.choice([who + ':', who, self.sentence(1, 1) + ':'])} {text}</p>")
            elif style == 1:
                parts.append(f"<li><p>{text}</p><span>{who}</span></li>")
            else:
                parts.append(f"<article class='comment'><p>{who}</p><p>{text}</p></article>")
        if rng.random() < 0.3:
            parts.append(self.form())
        return self.box("comments", ["section", "section", "div", "ol"], "".join(parts), 0)

    def whole(self) -> str:
        rng = self.rng

        def some(*parts: tuple) -> list[str]:
            return [part() for part, chance in parts if rng.random() < chance]

        before = some((self.notice, 0.2), (self.header, 0.4), (self.menu, 0.7), (self.advert, 0.4), (self.form, 0.1), (self.sidebar, 0.15))
        after = some((self.share, 0.15), (self.advert, 0.15), (self.related, 0.2), (self.comments, 0.4), (self.sidebar, 0.25),
                     (self.form, 0.15), (self.menu, 0.1), (self.footer, 0.8), (self.notice, 0.15))
        inside = "".join([*before, self.article(), *after])
        if rng.random() < 0.04:  # an article and nothing else
            inside = f'<div {MARK}="1">{self.body()}</div>'
            inside = inside.replace("<div", "<body", 1).replace("</div>", "") if rng.random() < 0.5 else inside
        if rng.random() < 0.2:
            inside = f"<div class='{rng.choice(NEUTRAL)}'>{inside}</div>"
        head = f"<title>{self.sentence()}</title><script>var t='</p>';</script><style>p{{margin:0}}</style>"
        return f"<!DOCTYPE html><html><head>{head}</head><body {MARK}=\"0\">{inside}</body></html>"


def pages(n: int, seed: int) -> Iterator[str]:
    """``n`` pages, the same for the same seed."""
    rng = random.Random(seed)
    for _ in range(n):
        yield Page(rng).whole()
