"""Leaf blocks of HTML pages, with the features of their place and text.

A block is a run of text without a block-level tag in it. Tags need not be closed or nested
well. Used inside Arrow batches, page by page, in one pass over the whole page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[^\W\d_]+")

# Element names of HTML.
_UNSEEN = {"script", "style", "template", "iframe", "object", "noembed", "noframes", "svg", "math", "canvas", "audio", "video", "head"}
_RAW = {"script", "style", "iframe", "noembed", "noframes", "textarea", "title", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav",
    "noscript", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "textarea", "tfoot", "th", "thead",
    "title", "tr", "ul", "head", "template", "object", "svg", "math", "canvas", "audio", "video", "iframe", "xmp", "noembed", "noframes", "script", "style",
}
#: An element of the first name ends where one of the second names begins, up to an element of the third names.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "thead": ({"caption"}, {"table"}), "body": ({"head"}, set()),
}
_TABLE = {"table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th"}
#: Words of class, id, role and label attributes, by what they tell. Fixed values.
_HINTS = {
    "main": "article content contents main post entry body story text hentry maincontent bodytext prose markdown document page",
    "menu": "nav navbar navigation menu menus breadcrumb breadcrumbs crumbs topnav tabs toc pagination pager links sitemap skip",
    "head": "header masthead banner topbar branding logo tagline site",
    "foot": "footer foot bottom copyright legal colophon imprint credits",
    "side": "sidebar aside side rail widget widgets complementary related recommended recommendations trending popular more tags teaser promo promos",
    "note": "notice notices alert cookie cookies consent gdpr banner popup modal overlay toast message warning disclaimer paywall notification announcement privacy",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors dfp adsense outbrain taboola commercial promotion",
    "form": "form search login signin signup subscribe subscription newsletter register contact input feedback poll",
    "talk": "comment comments commentlist reply replies respond discussion disqus reader readers thread review reviews forum",
    "share": "share sharing social follow facebook twitter tools toolbar buttons actions print",
}
_HINT = {word: kind for kind, words in _HINTS.items() for word in words.split()}
#: Words of page furniture in block texts. Fixed values.
_SAYS = set(
    "cookie cookies subscribe newsletter login copyright advertisement sponsored share reply comments rights reserved privacy terms menu home search "
    "sign email password submit related previous next".split()
)


class _Place:
    """An open element: its name, and the features that everything in it has."""

    __slots__ = ("tag", "features", "hint", "unseen")

    def __init__(self, tag: str, features: tuple[str, ...], hint: str, unseen: bool):
        self.tag, self.features, self.hint, self.unseen = tag, features, hint, unseen


_ROOT = _Place("", (), "none", False)
_NAMED = {"class", "id", "role", "aria-label", "itemprop", "data-role", "data-component", "name"}


def _open(parent: _Place, tag: str, attributes: str) -> _Place:
    own, hidden = [], False
    for match in _ATTRIBUTE.finditer(attributes) if attributes.strip(" /\n\t") else ():
        name = match[1].lower()
        value = match[2] or match[3] or match[4] or ""
        if name in _NAMED:
            own += [w.lower() for w in _NAME.findall(value)]
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            hidden = True
    new = {f"in:{tag}", *(f"word:{w}" for w in own)}
    kinds = {_HINT[w] for w in own if w in _HINT}
    new |= {f"hint:{kind}" for kind in kinds}
    if hidden:
        new.add("hidden")
    hint = "+".join(sorted(kinds)) or (tag if tag in ("article", "main", "nav", "aside", "footer", "header", "form") else parent.hint)
    return _Place(tag, tuple({*parent.features, *new}), hint, parent.unseen or tag in _UNSEEN)


def _size(n: int) -> str:
    return "0" if n == 0 else "1" if n == 1 else "3" if n <= 3 else "8" if n <= 8 else "20" if n <= 20 else "50" if n <= 50 else "many"


def leaf_blocks(page: str) -> list[tuple[str, tuple[str, ...]]]:
    """Text and features of every leaf block of a page, in page order.

    Character references are decoded; white space (Unicode's) becomes single spaces. A line
    break is white space. Scripts, styles, templates, embedded media and the head have no blocks.
    """
    found = []
    stack = [_ROOT]
    pieces: list[str] = []
    linked, in_link, n_break = 0, False, 0

    def flush():
        nonlocal linked, n_break
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                found.append((text, stack[-1], min(linked / max(len(text), 1), 1.0), n_break))
            pieces.clear()
        linked, n_break = 0, 0

    def close(names: set[str], limits: set[str]):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                del stack[k:]
                return True
            if stack[k].tag in limits:
                return False
        return False

    at = 0
    while True:
        match = _TOKEN.search(page, at)
        end = match.start() if match else len(page)
        if end > at and not stack[-1].unseen:
            piece = page[at:end]
            pieces.append(piece)
            if in_link:
                linked += len(piece)
        if not match:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if tag in _RAW and not match[1]:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            flush()
            if tag == "textarea":
                stack.append(_open(stack[-1], tag, match[3]))
                pieces.append(page[at : stop.start() if stop else len(page)])
                flush()
                stack.pop()
            at = stop.start() if stop else len(page)
        elif tag == "a":
            in_link = not match[1]
        elif tag == "br":
            pieces.append(" ")
            n_break += 1
        elif tag in _BLOCK or "-" in tag:
            flush()
            if match[1]:
                if tag not in _RAW and close({tag}, {"table"} - {tag} if tag in _TABLE else {"td", "th"}):
                    in_link = False
            elif tag not in _VOID:
                if stack[-1].tag == "head" and tag not in _UNSEEN:
                    stack.pop()
                ends, limits = _ENDS.get(tag, ((), set()))
                if ends:
                    close(ends, limits)
                if stack[-1].tag == "p":
                    stack.pop()
                if not match[3].endswith("/"):
                    stack.append(_open(stack[-1], tag, match[3]))
        elif tag in ("input", "img"):
            pieces.append(" ")
    flush()
    return list(_with_text_features(found))


def _with_text_features(found: list) -> Iterator[tuple[str, tuple[str, ...]]]:
    tags = {f for _, place, *_ in found for f in place.features if f in ("in:article", "in:main", "in:h1")}
    heads = [k for k, (_, place, *_) in enumerate(found) if place.tag == "h1"]
    for k, (text, place, link, breaks) in enumerate(found):
        words = text.split(" ")
        features = [
            "any", *place.features, f"tag:{place.tag}", f"near:{place.hint}", f"near:{place.hint}:{place.tag}", f"words:{_size(len(words))}",
            f"link:{0 if link == 0 else 1 if link < 0.3 else 2 if link < 0.9 else 3}", f"end:{text[-1] if text[-1] in '.!?:,;' else 'other'}",
            f"words:{_size(len(words))}:{place.tag in ('p', 'li', 'td', 'h1', 'h2', 'h3', 'blockquote', 'pre')}", f"breaks:{min(breaks, 2)}",
            *(f"says:{w}" for w in {w.strip(".,:!").lower() for w in words[:12]} & _SAYS),
        ]
        for tag in ("article", "main"):
            if f"in:{tag}" in tags and f"in:{tag}" not in place.features:
                features.append(f"outside:{tag}")
        if heads:
            features.append("title" if k == heads[0] else "before title" if k < heads[0] else "after title")
        if "©" in words[0] or "©" in text:
            features.append("says:©")
        if "|" in words or "»" in words or "·" in words:
            features.append("says:|")
        yield text, tuple(features)
