"""Labelled pages to learn from: layouts of sites, with the main text marked, filled with words by a seeded rule.

``data-y`` says whether the text of an element is main text (1) or not (0) and holds until an inner element says otherwise; outside of all it
is 0. Readers of the pages see class, id and role, never ``data-y``.
"""

from __future__ import annotations

import random
import re

# Names that sites give to parts of their pages.
NAMES = {
    "menu": "menu nav navbar navigation main-menu breadcrumb breadcrumbs tabs pager pagination toc topbar",
    "header": "header site-header masthead banner top page-header branding",
    "footer": "footer site-footer colophon bottom copyright legal page-footer",
    "side": "sidebar side aside widget widget-area related rail column-right secondary recommended popular trending",
    "notice": "notice cookie cookie-notice cookies consent gdpr alert banner-notice popup modal overlay message warning disclaimer",
    "ad": "ad ads advert advertisement adsense sponsored sponsor promo promotion ad-slot banner-ad adbox",
    "form": "form search login signup subscribe newsletter contact-form subscription",
    "comments": "comments comment comment-list responses replies discussion disqus respond reader-comments",
    "share": "share social social-share sharing buttons tags meta byline author-box post-meta",
    "main": "content main article post entry story post-content entry-content article-body main-content body-text text post-body",
}

#: A layout without an element is a page of plain text, all of it main.
#: @word@ picks a name of that kind; {p} some paragraphs, {s} a sentence, {w} a few words, {l} a list of links, {c} comments.
LAYOUTS = (
    '<header><a href="/">{w}</a></header><nav><ul>{l}</ul></nav><div class="@ad@">{s}</div><article data-y="1"><h1>{w}</h1>{p}</article><footer>&copy; {w} &middot; {s}</footer>',
    '<nav class="@menu@">{l}</nav><article data-y="1"><h1>{w}</h1><p>{s}</p>{p}</article><div class="@ad@">{s}</div><footer>{s}</footer>',
    '<div id="@header@"><h2>{w}</h2></div><div id="@menu@"><ul>{l}</ul></div><div id="@main@" data-y="1"><h1>{w}</h1>{p}</div><div id="@side@"><h3>{w}</h3><ul>{l}</ul><p>{s}</p></div><div id="@footer@"><p>{s}</p></div>',
    '<header class="@header@"><p>{s}</p></header><main data-y="1"><h1>{w}</h1>{p}<aside class="@side@" data-y="0"><h2>{w}</h2><p>{s}</p></aside>{p}</main><section class="@comments@"><h2>{w}</h2>{c}</section><footer class="@footer@"><p>{s}</p></footer>',
    '<div class="@notice@"><p>{s}</p><button>{w}</button></div><nav>{l}</nav><main><article data-y="1"><header><h1>{w}</h1></header>{p}<div class="@ad@" data-y="0"><p>{s}</p></div>{p}</article><div class="@comments@">{c}</div></main><aside>{l}<p>{s}</p></aside>',
    '<table><tr><td class="@menu@"><ul>{l}</ul></td><td class="@main@" data-y="1"><h1>{w}</h1>{p}</td><td class="@side@"><p>{s}</p><ul>{l}</ul></td></tr></table><div class="@footer@">{s}</div>',
    '<div><ul>{l}</ul></div><div data-y="1"><h1>{w}</h1>{p}</div><div><ul>{l}</ul></div><div>{w}</div>',
    '<div role="navigation">{l}</div><div role="main" data-y="1"><h1>{w}</h1>{p}<blockquote><p>{s}</p></blockquote><ul><li>{s}</li><li>{s}</li></ul>{p}</div><div role="complementary">{s}</div><div role="contentinfo">{s}</div>',
    '<section class="@notice@">{s}</section><form class="@form@"><label>{w}</label><input><button>{w}</button><p>{s}</p></form><section class="@main@" data-y="1"><h1>{w}</h1>{p}<h2>{w}</h2>{p}</section><div class="@share@">{l}</div><form><p>{s}</p><select><option>{w}</option><option>{w}</option></select></form>',
    '<article data-y="1"><h1>{w}</h1>{p}<figure><figcaption>{s}</figcaption></figure>{p}<nav class="@menu@" data-y="0"><ul>{l}</ul></nav><section class="@comments@" data-y="0"><h3>{w}</h3>{c}</section><footer data-y="0">{s}</footer></article><div class="@side@"><p>{s}</p><p>{s}</p></div>',
    '<div class="wrap"><div class="@header@"><p>{s}</p></div><div class="row"><div class="@main@" data-y="1"><h1>{w}</h1>{p}<div class="@form@" data-y="0"><p>{s}</p><input></div>{p}</div><div class="@side@"><p>{s}</p><p>{s}</p></div></div><div class="@notice@"><p>{s}</p></div></div>',
    '<nav><ul>{l}</ul></nav><aside class="@side@"><h3>{w}</h3><p>{s}</p><p>{s}</p></aside><article class="@main@" data-y="1"><h1>{w}</h1>{p}</article><section id="@comments@"><article class="@comments@">{s}</article><article class="@comments@"><p>{s}</p></article></section><footer><nav>{l}</nav><p>{s}</p></footer>',
    '<main><div class="@ad@"><p>{s}</p></div><h1 data-y="1">{w}</h1><div data-y="1">{p}<ol><li>{s}</li><li>{s}</li></ol><table><tr><th>{w}</th><td>{w}</td></tr></table></div><div class="@share@"><p>{w}</p></div><ul class="@comments@"><li>{s}</li><li><p>{s}</p></li></ul></main><dialog class="@notice@"><p>{s}</p></dialog>',
    '<header><nav>{l}</nav></header><article data-y="1">{p}</article><footer class="@footer@">{s}</footer>',
    '<nav><ul>{l}</ul></nav><article data-y="1"><h1>{w}</h1>{p}<ul>{l}</ul>{p}</article><aside><ul>{l}</ul></aside><footer>{s}</footer>',
    '<div class="@menu@">{l}</div><div class="@main@" data-y="1"><h1>{w}</h1>{p}<h2>{w}</h2><ol>{l}</ol>{p}</div><div class="@footer@">{l}</div>',
    '<header><nav>{l}</nav></header><main><article data-y="1"><h2>{w}</h2>{p}</article><article data-y="1"><h2>{w}</h2>{p}</article><article data-y="1"><h2>{w}</h2>{p}</article></main><footer>{s}</footer>',
    "{s} {s} {s}",
)

_SYLLABLES = "an re ti on er th en es ou la de qui ver ein ung los que cion ar in st ly ble at nd".split()
_field = re.compile(r"@(\w+)@|\{(\w)\}")


class PageWriter:
    def __init__(self, seed: int):
        self._rng = random.Random(seed)

    def words(self, least: int, most: int) -> list[str]:
        return ["".join(self._rng.choices(_SYLLABLES, k=self._rng.randint(1, 4))) for _ in range(self._rng.randint(least, most))]

    def sentence(self) -> str:
        return " ".join(self.words(1, 22)).capitalize() + "."

    def paragraph(self) -> str:
        text = " ".join(self.sentence() for _ in range(self._rng.choice((1, 1, 2, 4, 8))))
        text = f"<b>{text}</b>" if self._rng.random() < 0.1 else text
        return f"<p>{text}" + ("</p>" if self._rng.random() < 0.8 else "")

    def page(self, layout: str) -> str:
        rng = self._rng
        tiny = rng.random() < 0.15

        def fill(found: re.Match) -> str:
            kind, part = found.groups()
            if kind:
                return rng.choice(NAMES[kind].split())
            if part == "w":
                return " ".join(self.words(1, 8))
            if part == "s":
                return " ".join(self.sentence() for _ in range(rng.choice((1, 1, 2, 3))))
            if part == "p" and tiny:
                return f"<p>{' '.join(self.words(1, 3))}.</p>"
            if part == "p":
                return "".join(self.paragraph() for _ in range(rng.choice((1, 2, 4, 9))))
            if part == "l":
                return "".join(f'<li><a href="/x">{" ".join(self.words(1, 3))}</a></li>' for _ in range(rng.randint(3, 8)))
            return "".join(f'<div class="{rng.choice(("comment", "reply", "comment-body"))}"><p>{self.sentence()}</p></div>' for _ in range(rng.randint(1, 5)))

        filled = _field.sub(fill, layout)
        return filled if "<" not in layout else f"<!DOCTYPE html><html><head><title>x</title></head><body>{filled}</body></html>"


def labelled_pages(per_layout: int = 30, seed: int = 5, layouts: tuple[str, ...] = LAYOUTS) -> list[str]:
    writer = PageWriter(seed)
    return [writer.page(layout) for _ in range(per_layout) for layout in layouts]
