"""Labelled pages for the block field: invented pages of many layouts, each block marked by hand.

A layout is a list of parts in page order. Each part says how it is written and whether its blocks
are main text, so the label of every block is known. Texts are drawn from syllables, with the
lengths and signs that such parts have on real pages.
"""

from __future__ import annotations

import random

PAGES = 420

_SYLLABLES = "an be co der el fa gen ho in ka lo men no on per qui re sa ti un ver wo ze ä é ñ ch st th".split()
_MENU = "Home About Contact News Blog Products Services Support Login Imprint Archive Search Help Sport Politics".split()


class _Writer:
    def __init__(self, draw: random.Random):
        self.draw = draw
        self.out: list[str] = []
        self.labels: list[int] = []

    def word(self) -> str:
        return "".join(self.draw.choices(_SYLLABLES, k=self.draw.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.draw.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        some = []
        for _ in range(self.draw.randint(low, high)):
            text = self.words(3, 22).capitalize()
            if self.draw.random() < 0.4:
                text = text.replace(" ", ", ", 1)
            some.append(text + self.draw.choice("....!?"))
        return " ".join(some)

    def put(self, markup: str) -> None:
        self.out.append(markup)

    def block(self, main: int, markup: str) -> None:
        """Markup that holds exactly one leaf block."""
        self.out.append(markup)
        self.labels.append(main)

    def links(self, low: int, high: int, wrap: str = "li") -> None:
        for _ in range(self.draw.randint(low, high)):
            name = self.draw.choice(_MENU) if self.draw.random() < 0.4 else self.words(1, 4)
            self.block(0, f'<{wrap}><a href="/{name[:5]}">{name}</a></{wrap}>')


def _attribute(w: _Writer, names: str) -> str:
    name = w.draw.choice(names.split())
    form = w.draw.choice(['class="{}"', "class='{}'", 'id="{}"', 'class="box {}"', 'class="{} wide"', "class={}"])
    return form.format(name)


def _menu(w: _Writer) -> None:
    tag, more = w.draw.choice([("nav", ""), ("nav", ' class="main"'), ("div", " " + _attribute(w, "menu nav navbar navigation topnav breadcrumb breadcrumbs tabs toc"))])
    w.put(f"<{tag}{more}>")
    if w.draw.random() < 0.2:
        w.block(0, f"<h3>{w.draw.choice(['Menu', 'Navigation', w.words(1, 2)])}</h3>")
    w.put("<ul>")
    w.links(2, 9)
    w.put(f"</ul></{tag}>")


def _header(w: _Writer) -> None:
    tag, more = w.draw.choice([("header", ""), ("div", " " + _attribute(w, "header masthead topbar banner branding site-header logo"))])
    w.put(f"<{tag}{more}>")
    if w.draw.random() < 0.6:
        w.block(0, f'<div class="logo">{w.words(1, 3)}</div>')
    if w.draw.random() < 0.4:
        w.block(0, f"<h1>{w.words(1, 4)}</h1>")
    w.block(0, f"<p>{w.words(2, 8)}</p>")
    w.put(f"</{tag}>")


def _short(w: _Writer, names: str, tags: str = "div section aside p") -> None:
    """A part that is not main text although it may hold sentences."""
    tag = w.draw.choice(tags.split())
    body = w.draw.choice([w.sentences(1, 3), w.words(1, 8), w.sentences(1, 1), w.sentences(2, 6)])
    if tag != "p" and w.draw.random() < 0.4:
        w.put(f"<{tag} {_attribute(w, names)}>")
        for _ in range(w.draw.randint(1, 3)):
            w.block(0, f"<p>{w.sentences(1, 3)}</p>")
        w.put(f"</{tag}>")
    else:
        w.block(0, f"<{tag} {_attribute(w, names)}>{body}</{tag}>")


def _advert(w: _Writer) -> None:
    _short(w, "ad ads advert advertisement sponsored promo sponsor banner-ad adsense ad-slot")


def _notice(w: _Writer) -> None:
    _short(w, "cookie cookies notice consent gdpr cookie-banner alert warning popup newsletter modal subscribe paywall")


def _sidebar(w: _Writer) -> None:
    tag, more = w.draw.choice([("aside", ""), ("aside", ' class="sidebar"'), ("div", " " + _attribute(w, "sidebar side widget related trending recommended most-read rail"))])
    w.put(f"<{tag}{more}>")
    w.block(0, f"<h3>{w.words(1, 4)}</h3>")
    if w.draw.random() < 0.6:
        w.put("<ul>")
        w.links(2, 7)
        w.put("</ul>")
    for _ in range(w.draw.randint(0, 3)):
        w.block(0, f"<p>{w.sentences(1, 3)}</p>")
    w.put(f"</{tag}>")


def _form(w: _Writer) -> None:
    w.put(f"<form action='/x' {_attribute(w, 'search login signup contact subscribe')}>")
    w.block(0, f"<label>{w.words(1, 3)}</label><input type=text name=q><button>{w.words(1, 2)}</button>")
    if w.draw.random() < 0.4:
        w.block(0, f"<p>{w.sentences(1, 2)}</p>")
    w.put("</form>")


def _comments(w: _Writer) -> None:
    tag = w.draw.choice(["div", "section", "ol"])
    w.put(f"<{tag} {_attribute(w, 'comments comment-list discussion replies responses disqus reader-comments')}>")
    if tag != "ol":
        w.block(0, f"<h3>{w.draw.choice(['Comments', w.words(1, 3)])}</h3>")
    item = "li" if tag == "ol" else w.draw.choice(["div", "article", "p"])
    for _ in range(w.draw.randint(1, 5)):
        if item == "p":
            w.block(0, f'<p class="comment">{w.sentences(1, 4)}</p>')
        else:
            w.put(f'<{item} class="comment">')
            w.block(0, f'<div class="author">{w.words(1, 2)}</div>')
            w.block(0, f"<p>{w.sentences(1, 5)}</p>")
            w.put(f"</{item}>")
    w.put(f"</{tag}>")


def _share(w: _Writer) -> None:
    w.put(f"<div {_attribute(w, 'share social share-buttons tags byline-tools tools pagination pager')}><ul>")
    w.links(2, 4)
    w.put("</ul></div>")


def _footer(w: _Writer) -> None:
    tag, more = w.draw.choice([("footer", ""), ("footer", ""), ("div", " " + _attribute(w, "footer bottom copyright site-footer colophon legal"))])
    if w.draw.random() < 0.6:
        body = w.draw.choice(["&copy; {} &middot; {}", "© 2021 {}. {}", "{} | {}", "{} {}"]).format(w.words(1, 3), w.sentences(1, 2))
        w.block(0, f"<{tag}{more}>{body}</{tag}>")
    else:
        w.put(f"<{tag}{more}>")
        w.block(0, f"<p>&copy; {w.words(1, 4)}</p>")
        w.put("<ul>")
        w.links(1, 5)
        w.put("</ul>")
        w.put(f"</{tag}>")


def _paragraph(w: _Writer) -> None:
    body = w.draw.choice([w.sentences(1, 1), w.sentences(2, 5), w.sentences(3, 9), w.words(2, 9) + ".", w.sentences(1, 3)])
    kind = w.draw.random()
    if kind < 0.1:
        body = body.replace(" ", ' <a href="/y">', 1) + "</a>"
    elif kind < 0.2:
        body = f"<b>{body}</b>"
    elif kind < 0.25:
        body = body.replace(" ", " <br>", 1)
    elif kind < 0.3:
        body = body.replace(" ", " | ", 3)
    # left open, as pages often do
    if w.draw.random() < 0.2:
        w.block(1, f"<p><b>{body}<br>" if w.draw.random() < 0.5 else f"<p>{body}")
    else:
        w.block(1, f"<p>{body}</p>")


def _inner(w: _Writer) -> None:
    """What articles hold besides paragraphs."""
    kind = w.draw.random()
    if kind < 0.3:
        w.block(1, f"<h2>{w.words(2, 8)}</h2>")
    elif kind < 0.5:
        w.put("<ul>" if w.draw.random() < 0.7 else "<ol>")
        for _ in range(w.draw.randint(2, 5)):
            w.block(1, f"<li>{w.draw.choice([w.sentences(1, 2), w.words(2, 9)])}</li>")
        w.put("</ul>")
    elif kind < 0.65:
        w.block(1, f"<blockquote>{w.sentences(1, 3)}</blockquote>")
    elif kind < 0.75:
        w.block(1, f"<figure><figcaption>{w.words(3, 12)}</figcaption></figure>")
    elif kind < 0.82:
        w.put("<table>")
        for _ in range(w.draw.randint(1, 3)):
            w.put("<tr>")
            w.block(1, f"<td>{w.words(1, 4)}</td>")
            w.block(1, f"<td>{w.words(1, 4)}</td>")
            w.put("</tr>")
        w.put("</table>")
    elif kind < 0.88:
        w.block(1, f"<pre>{w.words(3, 20)}</pre>")
    else:
        w.draw.choice([_advert, _share])(w)


def _article(w: _Writer) -> None:
    tag, more = w.draw.choice(
        [("article", ""), ("article", ""), ("article", ' class="post"'), ("main", ""),
         ("div", " " + _attribute(w, "content article post entry article-body story post-content main body-text text"))]
    )
    w.put(f"<{tag}{more}>")
    if w.draw.random() < 0.85:
        w.block(1, f"<h1>{w.draw.choice([w.words(2, 12), w.sentences(1, 2)])}</h1>")
    plain = w.draw.random() < 0.5
    for _ in range(w.draw.choice([0, 1, 1, 2, 3, 4, 6, 9, 14])):
        if not plain and w.draw.random() < 0.25:
            _inner(w)
        else:
            _paragraph(w)
    w.put(f"</{tag}>")


def _page(draw: random.Random) -> tuple[str, list[int]]:
    w = _Writer(draw)
    w.put("<!DOCTYPE html><html><head><meta charset='utf-8'><title>" + w.words(2, 9) + "</title>")
    w.put("<style>p{margin:0}</style><script>var t='</p>';</script></head><body>")
    lead = [p for p, chance in ((_notice, 0.2), (_header, 0.45), (_menu, 0.75), (_advert, 0.5), (_form, 0.15), (_sidebar, 0.15)) if draw.random() < chance]
    if draw.random() < 0.3:
        draw.shuffle(lead)
    tail = [p for p, chance in ((_share, 0.15), (_advert, 0.2), (_comments, 0.4), (_sidebar, 0.35), (_form, 0.15), (_notice, 0.15), (_footer, 0.8)) if draw.random() < chance]
    wrapped = draw.random() < 0.3
    for part in lead:
        part(w)
        if draw.random() < 0.2:
            w.put(f"<!-- {w.words(1, 3)} -->")
    if wrapped:
        w.put(f'<div class="{draw.choice(["container", "wrapper", "page", "row"])}">')
    if draw.random() < 0.96:
        _article(w)
    for part in tail:
        part(w)
    if draw.random() < 0.85:
        w.put("</div></body></html>" if wrapped else "</body></html>")
    return "".join(w.out), w.labels


def labelled_pages(pages: int = PAGES, seed: int = 1) -> list[tuple[str, list[int]]]:
    """``(html, labels)``: 1 for each leaf block of main text, 0 for the others, in page order."""
    draw = random.Random(seed)
    return [_page(draw) for _ in range(pages)]
