"""Labelled pages to learn extraction from: layouts of the usual regions, filled with given sentences.

No table says which part of a page is its article, so pages are laid out here: an article among
menus, headers, sidebars, notices, adverts, forms, reader comments and footers, under the names such
regions carry on the web, under meaningless ones or under none, in several orders and nestings. The
sentences come from pages of the table, the same ones for articles and for what surrounds them, so that
a reader has to go by path, shape and neighbours. Text of the article starts with ``MARK``.
"""

from __future__ import annotations

import html
import random

MARK = "\ue000"

# Usual element and class names of each region.
REGIONS = {
    "menu": ("nav div ul", "nav navbar menu main-menu navigation site-nav top-menu breadcrumb nav-links tabs"),
    "header": ("header div section", "header site-header masthead banner logo brand top page-header hero topbar"),
    "sidebar": (
        "aside div section",
        "sidebar aside widget related rail secondary trending popular recommended more-stories tags share social"
        " related-posts read-next side-column author-box",
    ),
    "notice": (
        "div section dialog aside",
        "cookie cookie-banner notice consent gdpr alert popup modal overlay paywall privacy disclaimer message"
        " toast announcement warning info-box subscribe",
    ),
    "advert": ("div aside ins section", "ad ads advert advertisement sponsored promo ad-slot adsense sponsor banner-ad promotion"),
    "form": ("form form div section", "form newsletter signup search login contact subscribe-form search-form register"),
    "comments": (
        "section div ol ul",
        "comments comment-list discussion replies responses disqus reader-comments user-comments feedback thread"
        " comment-section reviews",
    ),
    "footer": ("footer div section", "footer site-footer bottom copyright colophon legal foot page-footer imprint"),
    "article": (
        "article article main div section",
        "article content post entry main story article-body post-content entry-content text page-content"
        " story-body main-content body-text",
    ),
}
NEUTRAL = "container wrapper row col box inner block grid layout section-1 c1 x7 w2 page site outer panel".split()
# Usual phrases, in the languages of the tables.
PHRASES = {
    "notice": (
        "We use cookies to improve your experience.|Accept all|Reject|This site uses cookies.|Privacy settings"
        "|Wir verwenden Cookies.|Akzeptieren|Utilizamos cookies.|Aceptar|Nous utilisons des cookies.|Accepter"
        "|Please enable JavaScript to view this page.|Subscribe to continue reading.|Notice"
    ),
    "advert": "Advertisement|Sponsored|Anzeige|Publicidad|Publicité|Buy now|Limited offer|Ad",
    "form": "Search|Email address|Subscribe|Sign up|Your name|Submit|Log in|Password|Send|Suche|Buscar|Rechercher|Message",
    "comments": "Reply|Report|Like|Leave a comment|Log in to comment|Antworten|Responder|Répondre|2 days ago|posted at 10:24",
    "comments-title": "Comments|3 comments|Discussion|Kommentare|Comentarios|Commentaires|Join the conversation|Responses",
    "sidebar": "Related articles|Most read|Trending|Share|Tags|Read more|Follow us|Popular|Mehr|Más leído|À lire|You may also like",
    "footer": "All rights reserved.|Terms|Privacy|Imprint|Contact|About us|© 2024|Alle Rechte vorbehalten|Mentions légales",
    "menu": "Home|News|Sports|About|Contact|Blog|Login|Startseite|Inicio|Accueil|World|Business|Search|Menu",
    "header": "Skip to content|Welcome|The Daily News|Sign in|Our Blog|Menu",
}


class Pages:
    """Random pages, one after another, of a seeded generator."""

    def __init__(self, sentences: list[str], seed: int = 13) -> None:
        self.rng = random.Random(seed)
        self.sentences = sentences or ["A sentence of a few words."]

    def _words(self, low: int, high: int) -> str:
        words = self.rng.choice(self.sentences).split()
        return " ".join(words[: self.rng.randint(low, high)]) or "word"

    def _sentences(self, low: int, high: int) -> str:
        return " ".join(self.rng.choice(self.sentences) for _ in range(self.rng.randint(low, high)))

    def _phrase(self, kind: str) -> str:
        return self.rng.choice(PHRASES[kind].split("|"))

    def _attributes(self, names: str) -> str:
        chosen = self.rng.sample(names.split(), self.rng.randint(1, 2))
        if self.rng.random() < 0.3:
            chosen.append(self.rng.choice(NEUTRAL))
        if self.rng.random() < 0.2:
            chosen = [c.replace("-", "_") for c in chosen]
        kind = self.rng.choice(["class", "class", "class", "id"])
        return f' {kind}="{(" " if kind == "class" else "-").join(chosen)}"'

    def _wrap(self, region: str, inner: str) -> str:
        """``inner`` in the region's element: named, by its tag only, or without any hint."""
        rng, (tags, names) = self.rng, REGIONS[region]
        fate = rng.random()
        tag = rng.choice(tags.split())
        if fate < 0.55:
            attributes = self._attributes(names)
        elif fate < 0.8 and tag not in ("div", "section"):
            attributes = ""
        else:
            tag = "div" if region != "article" or rng.random() < 0.5 else tag
            attributes = f' class="{rng.choice(NEUTRAL)}"' if rng.random() < 0.5 else ""
        out = f"<{tag}{attributes}>{inner}</{tag}>"
        return f'<div class="{rng.choice(NEUTRAL)}">{out}</div>' if rng.random() < 0.25 else out

    def _links(self, kind: str, low: int, high: int) -> str:
        rng = self.rng
        plain = rng.random() < 0.3
        items = []
        for _ in range(rng.randint(low, high)):
            text = self._phrase(kind) if rng.random() < 0.4 else self._words(1, 7)
            link = html.escape(text) if rng.random() < 0.1 else f'<a href="/{rng.randint(0, 99)}">{html.escape(text)}</a>'
            items.append(link if plain else f"<li>{link}</li>")
        return " | ".join(items) if plain else f"<ul>{''.join(items)}</ul>"

    def _said(self, kind: str, low: int = 1, high: int = 2) -> str:
        """A few words of a region: a usual phrase, sentences, or both."""
        rng = self.rng
        text = self._phrase(kind) if rng.random() < 0.45 else self._sentences(low, high)
        if rng.random() < 0.2:
            text += " " + self._sentences(1, 1)
        tag = rng.choice(["p", "div", "span", ""])
        return f"<{tag}>{html.escape(text)}</{tag}>" if tag else html.escape(text)

    def menu(self) -> str:
        return self._wrap("menu", self._links("menu", 2, 9))

    def header(self) -> str:
        title = html.escape(self._phrase("header") if self.rng.random() < 0.5 else self._words(1, 5))
        tag = self.rng.choice(["h1", "h2", "div", "a", "p"])
        inner = f"<{tag}>{title}</{tag}>"
        if self.rng.random() < 0.4:
            inner += self._said("header")
        if self.rng.random() < 0.3:
            inner += self.menu()
        return self._wrap("header", inner)

    def sidebar(self) -> str:
        tag = self.rng.choice(["h2", "h3", "h4", "div", "p"])
        title = html.escape(self._phrase("sidebar") if self.rng.random() < 0.7 else self._words(1, 4))
        inner = f"<{tag}>{title}</{tag}>"
        inner += self._links("sidebar", 2, 6) if self.rng.random() < 0.6 else self._said("sidebar", 1, 3)
        return self._wrap("sidebar", inner)

    def notice(self) -> str:
        inner = self._said("notice")
        if self.rng.random() < 0.5:
            inner += f"<button>{html.escape(self._phrase('notice'))}</button>"
        return self._wrap("notice", inner)

    def advert(self) -> str:
        inner = self._said("advert")
        return self._wrap("advert", f'<a href="/x">{inner}</a>' if self.rng.random() < 0.4 else inner)

    def form(self) -> str:
        rng, parts = self.rng, []
        for _ in range(rng.randint(1, 4)):
            text = html.escape(self._phrase("form") if rng.random() < 0.6 else self._words(1, 5))
            parts.append(rng.choice([f"<label>{text}</label><input name='q'>", f"<p>{text}</p>", f"<button>{text}</button>",
                                     f"<select><option>{text}</option><option>{text}</option></select>"]))
        return self._wrap("form", "".join(parts))

    def comments(self) -> str:
        rng, parts = self.rng, []
        if rng.random() < 0.75:
            parts.append(f"<h3>{html.escape(self._phrase('comments-title'))}</h3>")
        tag = rng.choice(["div", "li", "article", "p", "section", "blockquote"])
        own = rng.choice(["", ' class="comment"', ' class="reply"', ' class="user-post"', ' class="comment-body"'])
        for _ in range(rng.randint(1, 6)):
            name = f"<b>{html.escape(self._words(1, 2))}</b>" if rng.random() < 0.6 else ""
            text = f"<p>{html.escape(self._sentences(1, 3))}</p>"
            if name and rng.random() < 0.5:
                name = f"<div>{name}</div>"
            foot = f"<a href='#'>{html.escape(self._phrase('comments'))}</a>" if rng.random() < 0.5 else ""
            parts.append(f"<{tag}{own}>{name}{text}{foot}</{tag}>")
        if rng.random() < 0.3:
            parts.append(self.form())
        return self._wrap("comments", "".join(parts))

    def footer(self) -> str:
        inner = self._links("footer", 2, 5) if self.rng.random() < 0.4 else ""
        for _ in range(self.rng.randint(0 if inner else 1, 2)):
            inner += self._said("footer")
        return self._wrap("footer", inner)

    def _body(self, long: bool) -> str:
        """Text of an article's block: sentences mostly, also one odd line or a word over and over."""
        rng, kind = self.rng, self.rng.random()
        if kind < 0.06:
            return " ".join([self._words(1, 2)] * rng.choice([1, 2, 20, 200]))
        if kind < 0.1:
            return " ".join(self._words(1, 9).rstrip(".") for _ in range(rng.choice([1, 5, 60])))
        if kind < 0.14:
            return self._phrase(rng.choice(list(PHRASES)))
        if kind < 0.17:
            return f"{self._sentences(1, 2)} {self._phrase('footer')}"
        if kind < 0.2:
            return self._sentences(30, 150)
        return self._sentences(1, 6 if long else 2) if kind < 0.85 else self._words(1, 6)

    def _inline(self, text: str) -> str:
        """Escaped text of the article with some of it in inline elements."""
        words = html.escape(text).split(" ")
        for i in range(len(words)):
            if self.rng.random() < 0.04:
                tag = self.rng.choice(["b", "i", "em", "strong", "code", "a href='/z'", "span"])
                words[i] = f"<{tag}>{words[i]}</{tag.split()[0]}>"
        return MARK + " ".join(words)

    def article(self) -> str:
        rng, parts = self.rng, []
        if rng.random() < 0.85:
            title = f"<h1>{self._inline(self._words(2, 12))}</h1>"
            parts.append(f"<header>{title}</header>" if rng.random() < 0.15 else title)
        long = rng.random() < 0.6
        for _ in range(rng.randint(1, 14)):
            kind = rng.random()
            text = self._inline(self._body(long))
            if kind < 0.62:
                parts.append(f"<p>{text}</p>" if rng.random() < 0.8 else f"<p><b>{text}<br>")
            elif kind < 0.7:
                parts.append(f"<{(h := rng.choice(['h2', 'h3']))}>{self._inline(self._words(1, 7))}</{h}>")
            elif kind < 0.77:
                items = "".join(f"<li>{self._inline(self._words(2, 14))}</li>" for _ in range(rng.randint(2, 5)))
                parts.append(f"<{(t := rng.choice(['ul', 'ol']))}>{items}</{t}>")
            elif kind < 0.81:
                parts.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.84:
                parts.append(f"<pre>{text}</pre>")
            elif kind < 0.87:
                cells = "".join(f"<td>{self._inline(self._words(1, 4))}</td>" for _ in range(4))
                parts.append(f"<table><tr>{cells}</tr></table>")
            elif kind < 0.9:
                parts.append(f"<figure><img src='x.png'><figcaption>{text}</figcaption></figure>")
            else:
                parts.append(f"<div>{text}</div>" if rng.random() < 0.6 else f"{text}<br>")
        for make, chance in ((self.advert, 0.12), (self.sidebar, 0.1), (self.notice, 0.05), (self.form, 0.05)):
            if rng.random() < chance:
                parts.insert(rng.randint(1, len(parts)), make())
        inner = "".join(parts)
        if rng.random() < 0.15:
            inner += self.comments()
        inner = self._wrap("article", inner)
        if rng.random() < 0.3:
            beside = self.sidebar() if rng.random() < 0.5 else self.comments()
            inner = self._wrap("article", inner + beside) if rng.random() < 0.5 else f"<main>{inner}{beside}</main>"
        return inner

    def page(self) -> str:
        rng = self.rng
        above = [(self.notice, 0.25), (self.header, 0.45), (self.menu, 0.8), (self.advert, 0.4), (self.form, 0.2),
                 (self.sidebar, 0.15), (self.notice, 0.1)]
        below = [(self.advert, 0.25), (self.sidebar, 0.35), (self.comments, 0.35), (self.form, 0.25), (self.advert, 0.1),
                 (self.notice, 0.12), (self.menu, 0.12)]
        if rng.random() < 0.12:
            above = below = []
        rng.shuffle(below)
        parts = [make() for make, chance in above if rng.random() < chance]
        parts.append(self.article())
        parts += [make() for make, chance in below if rng.random() < chance]
        if below and rng.random() < 0.85:
            parts.append(self.footer())
        body = "".join(parts)
        if rng.random() < 0.3:
            body = f'<div class="{rng.choice(NEUTRAL)}">{body}</div>'
        return f"<html><head><title>t</title></head><body>{body}</body></html>" if rng.random() < 0.95 else body
