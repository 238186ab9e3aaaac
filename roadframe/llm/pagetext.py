"""Visible text blocks of an HTML page, with the region in which they stand.

Elements that never hold an article (menus, footers, asides, forms, hidden
parts) are left out. Names of classes and the like only lower a block's
standing: they decide unless boxes of that name hold most of the page's text.
"""

from __future__ import annotations

import html
import re

_TAG = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_CLASS = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.I)
_NAME_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: content that is no markup: skipped up to the end tag
_RAW = frozenset("script style textarea title noscript template iframe svg math object noframes xmp".split())
#: elements that never hold the article's text
_CHROME = frozenset("nav footer aside form head button select dialog menu".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody tfoot thead title tr ul".split())
#: inline elements that end with the block in which they were opened
_SPACE = frozenset("br td th".split())
#: what a class, id or role name is about where it names something around an article
_CHROME_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright discussion disqus footer gdpr login menu modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination popup promo promotion recommended related replies "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar "
    "widget widgets contentinfo complementary alert masthead".split())
#: last parts of a name that say only that it is a box: what stands before counts
_BOX_NAMES = frozenset(
    "area bar block body box button buttons card cards column container content form group holder icons inner item items "
    "left link links list module outer panel posts right row section slot stories unit wrap wrapper".split())
#: first parts that speak of something else's contents
_OTHERWISE = frozenset("has is no not with without hide show".split())
_HEADER_NAMES = frozenset(["header", "topbar"])
_MAIN_NAMES = frozenset(["main", "article"])
_CLOSED_BY = {  # an open element that ends where one of these begins
    "p": _BLOCK - {"caption", "option", "optgroup"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}


#: boxes of one name that hold more than this share of a page's text are no chrome
MOST = 0.6
#: an article or main element with less than this share of the text is a teaser
TEASER = 0.25
#: characters of an article, outside such boxes, that leave no doubt about them
ARTICLE = 250


def _head(name: str) -> str | None:
    """What a compound name is about: its last part, boxes aside ('site-footer'
    is a footer, 'ad-slot' an ad, 'comments-open' and 'has-sidebar' neither)."""
    parts = [p.lower() for p in _NAME_PART.findall(name)]
    while len(parts) > 1 and parts[-1] in _BOX_NAMES:
        parts.pop()
    return parts[-1] if parts and parts[0] not in _OTHERWISE else None


def _region(name: str, attributes: str, main: bool) -> str | None:
    """'chrome', 'main', the chrome name of a box, or None (as its surroundings)."""
    if name in _CHROME or (name == "header" and not main):
        return "chrome"
    if attributes:
        if _HIDDEN.search(attributes):
            return "chrome"
        if name not in ("html", "body", "main", "article", "p") and "=" in attributes:
            heads = {_head(token) for found in _CLASS.findall(attributes) for token in "".join(found).split()}
            if name in ("div", "section") and heads & _MAIN_NAMES and "role" in attributes.lower():
                return "main"
            named = sorted(h for h in heads if h in _CHROME_NAMES or (not main and h in _HEADER_NAMES))
            if named:
                return f"named {named[0]}"
    return "main" if name in ("main", "article") else None


def page_blocks(page: str | None) -> list[tuple[bool, str]]:
    """``(main, text)`` of the blocks that may be the page's text, in page
    order. Blocks in boxes with a chrome name are left out, unless boxes of
    that name hold most of the text and no article stands beside them (a page
    may have more comments than text); blocks outside article and main elements
    are, unless those hold a teaser at most (then no block is ``main``)."""
    found = blocks(page)
    total = sum(len(text) for _, _, text in found)
    mass: dict[str, int] = {}
    for _, names, text in found:
        for name in names:
            mass[name] = mass.get(name, 0) + len(text)
    article = sum(len(text) for main, names, text in found if main and not names)
    chrome = {name for name, size in mass.items() if size <= MOST * total or article >= ARTICLE}
    kept = [(main, text) for main, names, text in found if not names & chrome]
    inside = sum(len(text) for main, text in kept if main)
    if inside and inside >= TEASER * sum(len(text) for _, text in kept):
        return [(True, text) for main, text in kept if main]
    return [(False, text) for _, text in kept]


def blocks(page: str | None) -> list[tuple[bool, frozenset[str], str]]:
    """``(main, names, text)`` in page order: ``main`` blocks stand inside an
    article or main element; ``names`` are the chrome names of the boxes around
    a block, up to that element. Menus, headers, footers, asides, forms,
    scripts, styles and hidden parts are left out. Character references are
    decoded and white space is one space."""
    if not page:
        return []
    out: list[tuple[bool, frozenset[str], str]] = []
    held: list[str] = []
    stack: list[tuple[str, str | None]] = []
    chrome = main = 0  # open elements of either kind
    names: list[str] = []  # of open boxes, since the last main element began
    outer: list[list[str]] = []  # those before it
    raw, place = None, 0

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append((main > 0, frozenset(names), text))
            held.clear()

    def close(upto: int) -> None:
        nonlocal chrome, main, names
        for name, kind in reversed(stack[upto:]):
            if name in _BLOCK:
                flush()
            if kind == "chrome":
                chrome -= 1
            elif kind == "main":
                main -= 1
                names = outer.pop()
            elif kind:
                names.pop()
        del stack[upto:]

    while True:
        tag = _TAG.search(page, place)
        end = tag.start() if tag else len(page)
        if end > place and not chrome:
            piece = page[place:end]
            held.append(html.unescape(piece) if "&" in piece else piece)
        if tag is None:
            break
        place = tag.end()
        name = tag.group(2)
        if name is None:
            if tag.group().startswith("<![CDATA[") and not chrome:
                held.append(tag.group()[9:].removesuffix("]]>"))
            continue
        name, closing = name.lower(), tag.group(1)
        if closing:
            if name in _BLOCK and not chrome:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
                if name not in _BLOCK and stack[i][0] in _BLOCK:
                    break  # a stray inline end tag does not end a block
            continue
        if name in _RAW:
            if not tag.group(3).endswith("/"):
                raw = re.compile(f"</{re.escape(name)}[^>]*>", re.I).search(page, place)
                place = raw.end() if raw else len(page)
            continue
        if name in _SPACE and not chrome:
            held.append(" ")
        if name in _VOID:
            if name == "hr" and not chrome:
                flush()
            continue
        if name in _BLOCK:
            if not chrome:
                flush()
            for i in range(len(stack) - 1, -1, -1):  # an open paragraph or item ends here
                opened = stack[i][0]
                if name in _CLOSED_BY.get(opened, ()):
                    close(i)
                    break
                if opened in _BLOCK:
                    break
        elif name in ("td", "th"):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ("td", "th"):
                    close(i)
                    break
                if stack[i][0] in _BLOCK:
                    break
        kind = _region(name, tag.group(3), main > 0)
        if kind and not chrome:
            flush()
        stack.append((name, kind))
        if kind == "chrome":
            chrome += 1
        elif kind == "main":
            main += 1
            outer.append(names)
            names = []
        elif kind:
            names.append(kind)
    flush()
    return out
