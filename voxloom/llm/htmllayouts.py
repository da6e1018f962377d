"""Pages drawn up at random, from which the block labeller learns what parts of a page look like.

Every text begins with a mark: the second of ``MARKS`` in the article, the first elsewhere. Parts are named by their
elements, by class or id words, by both, or not at all, so that no single sign is enough.
"""

from __future__ import annotations

import html

import numpy as np

#: First character of a text outside and inside the article.
MARKS = ("\ue000", "\ue001")

#: Words that name a part of a page, and its elements. Fixed values.
NAMES = {
    "article": (("article", "main", "article", "section"), "article post content entry story body main text single node page blog news".split()),
    "menu": (("nav", "nav", "ul", "header"), "nav menu navbar navigation topnav links breadcrumb breadcrumbs tabs mainmenu toolbar".split()),
    "header": (("header", "header", "div"), "header masthead top branding logo banner site-header topbar".split()),
    "footer": (("footer", "footer", "div"), "footer bottom colophon site-footer copyright legal foot imprint".split()),
    "sidebar": (("aside", "aside", "div"), "sidebar widget aside rail side secondary related popular trending recent".split()),
    "advert": (("div", "aside", "ins", "section"), "ad ads advert advertisement sponsored sponsor promo banner-ad adsbygoogle adslot teaser".split()),
    "notice": (("div", "section", "dialog", "aside"), "notice cookie cookies consent gdpr alert banner modal popup overlay newsletter paywall warning message".split()),
    "form": (("form", "form", "div"), "form search login signup subscribe newsletter contact searchbox register".split()),
    "comments": (("section", "div", "ol", "aside"), "comments comment responses discussion replies disqus thread feedback reviews reader-comments".split()),
    "share": (("div", "ul", "p"), "share social sharing tags meta buttons follow author-box tools".split()),
}
#: What such parts say, where they don't say what the sample says. Fixed values.
PHRASES = {
    "menu": "Home|About us|Contact|News|Sports|Products|Login|Startseite|Über uns|Kontakt|Accueil|À propos|Inicio|Noticias|Contacto|Archive|Help|Sitemap",
    "header": "The Daily Example|Welcome to our site|Your source for news|Menu|Search|Subscribe now|Toggle navigation|Skip to content",
    "footer": "© 2024 Example Inc. All rights reserved.|Privacy Policy|Terms of Service|Imprint|Impressum|Datenschutz|Mentions légales|Aviso legal|Follow us on|Powered by Example|Cookie settings|Back to top",
    "sidebar": "Most read|Related articles|Popular posts|Recent comments|Categories|Archives|Trending now|Follow us|Newsletter|You may also like|Meistgelesen|À lire aussi|Más leídas",
    "advert": "Advertisement|Sponsored|Buy now and save 50%!|Limited offer, order today|Anzeige|Publicité|Publicidad|Click here to learn more|Free shipping on all orders",
    "notice": "We use cookies to improve your experience.|Accept all|This site uses cookies. By continuing you agree.|Please enable JavaScript to view this page.|Wir verwenden Cookies.|Nous utilisons des cookies.|Usamos cookies.|Subscribe to keep reading|You have 2 free articles left",
    "form": "Your name|E-mail|Message|Send|Search|Subscribe|Password|Sign in|Enter your email address|Username|Submit|Senden|Envoyer|Enviar",
    "comments": "Leave a reply|3 comments|Reply|Report|Great article, thanks for sharing!|Anonymous says:|I totally disagree with this.|Posted on May 3 at 10:22|Kommentare|Commentaires|Comentarios|Like|Load more comments",
    "share": "Share on Facebook|Tweet|Print|Email this|Tags:|Filed under|5 min read|Teilen|Partager|Compartir",
}
WORDS = "the of and to in that is was for it with as his on be at by had not are but from or have an they which you were all".split()


class _Draw:
    def __init__(self, rng: np.random.Generator, words: list[str]) -> None:
        self.rng, self.words = rng, words if len(words) > 50 else WORDS * 4
        # How this page names its parts.
        self.by_element, self.by_name = self.some(0.6), self.some(0.7)
        self.pretty, self.odd_names = self.some(0.5), self.some(0.2)

    def some(self, share: float) -> bool:
        return bool(self.rng.random() < share)

    def pick(self, of):
        return of[int(self.rng.integers(len(of)))]

    def many(self, low: int, high: int) -> range:
        return range(int(self.rng.integers(low, high + 1)))

    def text(self, low: int, high: int) -> str:
        """Consecutive words of the sample, more often few than many."""
        n = int(round(np.exp(self.rng.uniform(np.log(low), np.log(high)))))
        at = int(self.rng.integers(max(1, len(self.words) - n)))
        got = " ".join(self.words[at : at + n])
        return html.escape(got[:1].upper() + got[1:] + self.pick((".", ".", ".", "", "?", "!")), quote=False)

    def says(self, part: str, low: int, high: int) -> str:
        words = html.escape(self.pick(PHRASES[part].split("|")), quote=False) if self.some(0.35) else self.text(low, high)
        return MARKS[0] + words

    def attrs(self, part: str) -> str:
        names = NAMES[part][1]
        if self.by_name and not self.some(0.08):
            name = self.pick(names)
            if self.some(0.4):
                name = self.pick((f"site-{name}", f"{name}-wrapper", f"{name}-container", f"main-{name}", f"{name}_box", f"{name} {self.pick(names)}", f"{name}-1", f"js-{name}"))
            return self.pick((f' class="{name}"', f' class="{name}"', f' id="{name}"', f" class='{name} clearfix'", f' id="{name}" class="row"'))
        if self.odd_names:
            return f' class="c{int(self.rng.integers(10**6)):x} x{self.pick("abcdefgh")}"'
        return ""

    def wrap(self, part: str, inside: str) -> str:
        tag = self.pick(NAMES[part][0]) if self.by_element and not self.some(0.1) else "div"
        return self.box(tag, self.attrs(part), inside)

    def box(self, tag: str, attrs: str, inside: str) -> str:
        gap = "\n" if self.pretty else ""
        return f"<{tag}{attrs}>{gap}{inside}{gap}</{tag}>{gap}"

    def links(self, part: str, low: int, high: int) -> str:
        each = [f'<a href="/{int(self.rng.integers(1000))}">{self.says(part, 1, 4)}</a>' for _ in self.many(low, high)]
        if self.some(0.7):
            return f"<ul>{''.join(f'<li>{x}</li>' for x in each)}</ul>"
        return self.pick((" ", " | ", "\n")).join(each) if self.some(0.5) else "".join(f"<div>{x}</div>" for x in each)

    def menu(self) -> str:
        return self.wrap("menu", self.links("menu", 2, 12))

    def header(self) -> str:
        return self.wrap("header", "".join((f"<{self.pick(('h1', 'h2', 'div', 'p', 'a'))}>{self.says('header', 1, 8)}", self.menu() if self.some(0.5) else "", self.form() if self.some(0.2) else "")))

    def footer(self) -> str:
        parts = [f"<p>{self.says('footer', 2, 40)}</p>" if self.some(0.6) else self.says("footer", 2, 30) for _ in self.many(1, 3)]
        return self.wrap("footer", "".join(parts) + (self.links("footer", 2, 8) if self.some(0.5) else ""))

    def advert(self) -> str:
        inside = self.says("advert", 2, 30)
        return self.wrap("advert", self.pick((inside, f"<p>{inside}</p>", f'<a href="http://x">{inside}</a>', f"<div>{inside}</div><p>{self.says('advert', 2, 15)}</p>")))

    def notice(self) -> str:
        inside = f"<p>{self.says('notice', 4, 50)}</p>" if self.some(0.7) else self.says("notice", 4, 50)
        return self.wrap("notice", inside + (f"<button>{self.says('notice', 1, 3)}</button>" if self.some(0.5) else ""))

    def form(self) -> str:
        fields = "".join(f"<label>{self.says('form', 1, 4)}</label><input name=a>" for _ in self.many(0, 4))
        return self.wrap("form", (f"<p>{self.says('form', 2, 25)}</p>" if self.some(0.5) else "") + fields + (f"<button>{self.says('form', 1, 2)}</button>" if self.some(0.7) else ""))

    def sidebar(self) -> str:
        parts = []
        for _ in self.many(1, 4):
            parts.append(f"<{self.pick(('h3', 'h2', 'h4', 'p'))}>{self.says('sidebar', 1, 6)}")
            parts.append(self.links("sidebar", 2, 7) if self.some(0.6) else f"<p>{self.says('sidebar', 5, 60)}</p>")
        return self.wrap("sidebar", "".join(parts))

    def comments(self) -> str:
        parts = [f"<{self.pick(('h2', 'h3', 'p'))}>{self.says('comments', 1, 5)}"] if self.some(0.8) else []
        for _ in self.many(1, 8):
            said = "".join(f"<p>{self.says('comments', 3, 120)}</p>" for _ in self.many(1, 2))
            who = f"<{self.pick(('b', 'span', 'cite', 'div'))}>{self.says('comments', 1, 3)}" if self.some(0.6) else ""
            tag = self.pick(("div", "li", "article", "blockquote"))
            parts.append(self.box(tag, self.attrs("comments") if self.some(0.7) else "", who + said + (f'<a href="#r">{self.says("comments", 1, 1)}</a>' if self.some(0.4) else "")))
        return self.wrap("comments", "".join(parts) + (self.form() if self.some(0.3) else ""))

    def prose(self, low: int = 4, high: int = 220) -> str:
        words = self.text(low, high)
        if self.some(0.2):
            at = words.find(" ", len(words) // 2)
            if at > 0:
                words = words[:at] + self.pick((' <a href="/x">{}</a> ', " <b>{}</b> ", " <em>{}</em> ", "<br>{} ")).format(self.text(1, 4)) + words[at + 1 :]
        return MARKS[1] + words

    def article(self) -> str:
        parts = [f"<h1>{MARKS[1]}{self.text(2, 14)}</h1>"] if self.some(0.85) else []
        if self.some(0.15):
            parts.append(self.wrap("share", self.links("share", 1, 4)))
        style = self.pick(("p", "p", "p", "open", "open", "br", "div", "mixed"))
        for _ in self.many(1, 14) if self.some(0.85) else self.many(1, 2):
            kind = self.pick(("p", "open", "div")) if style == "mixed" else style
            if self.some(0.12):
                parts.append(f"<{self.pick(('h2', 'h3'))}>{MARKS[1]}{self.text(1, 9)}</h2>")
            if self.some(0.1):
                items = "".join(f"<li>{self.prose(2, 30)}{self.pick(('</li>', ''))}" for _ in self.many(2, 6))
                parts.append(f"<ul>{items}</ul>" if self.some(0.6) else f"<ol>{items}</ol>")
            elif self.some(0.05):
                parts.append(self.pick(("<blockquote>{}</blockquote>", "<pre>{}</pre>", "<table><tr><td>{}</td></tr></table>", "<figure><img src=x><figcaption>{}</figcaption></figure>")).format(self.prose(3, 60)))
            elif self.some(0.05):
                parts.append(self.pick((self.advert, self.form, self.sidebar, self.notice))())
            if self.some(0.03):  # a line that says the same again and again, or what other parts say
                line = f"<p>{self.prose(1, 6) if self.some(0.7) else MARKS[1] + html.escape(self.pick(self.pick(list(PHRASES.values())).split('|')), quote=False)}{self.pick(('</p>', ''))}"
                parts.append(line * self.pick((1, 1, 4, 12, 25)))
            bold = "<b>" if kind == "open" and self.some(0.3) else ""
            parts.append({"p": "<p>{}</p>", "open": "<p>" + bold + "{}" + self.pick(("", "<br>")), "br": "{}<br><br>", "div": "<div>{}</div>"}[kind].format(self.prose()))
        if self.some(0.25):
            parts.append(self.wrap("share", self.links("share", 2, 5)))
        inside = ("\n" if self.pretty else "").join(parts)
        if self.some(0.2):
            inside = self.box("div", self.attrs("article"), inside)
        return self.wrap("article", inside)

    def page(self) -> str:
        if self.some(0.04):
            return "".join(f"<p>{self.prose()}</p>" for _ in self.many(1, 5))
        before = [self.pick((self.header, self.menu, self.notice, self.advert, self.sidebar, self.form, self.menu)) for _ in self.many(0, 4)]
        after = [self.pick((self.footer, self.sidebar, self.comments, self.advert, self.notice, self.form, self.menu, self.comments)) for _ in self.many(0, 4)]
        body = "".join(f() for f in before)
        middle = self.article()
        if self.some(0.25):
            middle = self.box("div", self.pick(("", ' class="wrapper"', ' id="page" class="container"', ' class="row layout"')), middle + "".join(f() for f in after[:1]))
            after = after[1:]
        body += middle + "".join(f() for f in after) + (self.footer() if self.some(0.6) else "")
        if self.some(0.15):
            body = f"<main>{body}</main>" if self.some(0.3) else f'<div id="wrap">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>t</title></head><body>{body}" + ("</body></html>" if self.some(0.8) else "")


def draw(rng: np.random.Generator, words: list[str]) -> str:
    """One page."""
    return _Draw(rng, words).page()
