"""Labelled pages: layouts of many kinds put together at random, with a label for every leaf block.

They stand in for pages labelled by hand. Words are invented; what is real is how pages are
built: where articles stand, how menus, notices, adverts, forms and comments are marked up,
and how often marks are missing, or misleading.
"""

from __future__ import annotations

import random

#: Stands before each piece of main text in a generated page; no page holds it otherwise.
MARK = "\x01"

_SYLLABLES = "an be con da el for gi ho in ka lo me nu or pa qui ra se ti ul ven wo ze é ü".split()


def _word(r: random.Random) -> str:
    return "".join(r.choices(_SYLLABLES, k=r.choice((1, 1, 2, 2, 3))))


def _words(r: random.Random, low: int, high: int) -> str:
    return " ".join(_word(r) for _ in range(r.randint(low, high)))


def _sentence(r: random.Random, low: int = 1, high: int = 18) -> str:
    return _words(r, low, high).capitalize() + r.choice("....!?")


def _prose(r: random.Random) -> str:
    return " ".join(_sentence(r) for _ in range(r.choice((1, 1, 1, 2, 3, 5, 9))))


def _box(r: random.Random, names: str, inside: str, tags: str = "div") -> str:
    tag, name = r.choice(tags.split()), r.choice(names.split())
    mark = r.choice((f' class="{name}"', f' class="{name} {_word(r)}"', f' id="{name}"', f' class="box {name}-{_word(r)}"', f' role="{name}"'))
    return f"<{tag}{mark}>{inside}</{tag}>"


def _links(r: random.Random, low: int = 2, high: int = 7) -> str:
    return "".join(f'<li><a href="/{_word(r)}">{_words(r, 1, 3)}</a></li>' for _ in range(r.randint(low, high)))


def _menu(r: random.Random) -> str:
    rows = f"<ul>{_links(r)}</ul>"
    return r.choice((
        f"<nav>{rows}</nav>", _box(r, "nav navbar menu main-menu breadcrumbs navigation topnav toc", rows, "div ul nav"),
        f"<nav>{' '.join(f'<a href=x>{_word(r)}</a>' for _ in range(4))}</nav>", f'<div class="breadcrumb"><a href=/>{_word(r)}</a> » <a href=x>{_word(r)}</a> » {_words(r, 1, 4)}</div>',
    ))


def _header(r: random.Random) -> str:
    inside = f"<h{r.choice('12')}>{_words(r, 1, 4)}</h1>" if r.random() < 0.2 else f"<div>{_words(r, 1, 4)}</div>"
    inside += f"<p>{_sentence(r)}</p>" * (r.random() < 0.6) + _menu(r) * (r.random() < 0.5)
    return r.choice((f"<header>{inside}</header>", _box(r, "header masthead site-header branding topbar banner page-header", inside, "div header")))


def _footer(r: random.Random) -> str:
    inside = r.choice((f"&copy; {_words(r, 1, 3)} &middot; {_sentence(r)}", f"<p>&copy; 2021 {_words(r, 1, 3)}. All rights reserved.</p>", f"<p>{_sentence(r)}</p><ul>{_links(r)}</ul>"))
    return r.choice((f"<footer>{inside}</footer>", _box(r, "footer site-footer bottom copyright colophon legal", inside, "div footer")))


def _advert(r: random.Random) -> str:
    inside = r.choice((_prose(r), f"<p>{_prose(r)}</p>", f"<a href=x>{_sentence(r)}</a>", f"<h3>{_words(r, 2, 5)}</h3><p>{_prose(r)}</p>"))
    return _box(r, "ad ads advert advertisement sponsored ad-slot google-ads promo sponsor commercial", inside, "div div aside section ins-box")


def _notice(r: random.Random) -> str:
    inside = r.choice((_prose(r), f"<p>{_prose(r)}</p>", f"<p>{_prose(r)}</p><button>{_words(r, 1, 2)}</button>"))
    return _box(r, "cookie-notice cookie-banner notice alert consent gdpr modal popup toast paywall disclaimer announcement site-notice", inside, "div div section aside dialog")


def _side(r: random.Random) -> str:
    inside = r.choice((f"<h3>{_words(r, 1, 3)}</h3><ul>{_links(r)}</ul>", f"<h2>{_words(r, 1, 3)}</h2><p>{_prose(r)}</p>", f"<p>{_prose(r)}</p>" * 2, _prose(r)))
    return r.choice((f"<aside>{inside}</aside>", _box(r, "sidebar side-bar widget related related-posts popular teaser recommended rail tags author-box", inside, "div aside section")))


def _form(r: random.Random) -> str:
    inside = r.choice((
        f"<label>{_words(r, 1, 3)}</label><input name=q><button>{_word(r)}</button>", f"<p>{_prose(r)}</p><input type=email><button>{_words(r, 1, 2)}</button>",
        f"<fieldset><legend>{_words(r, 1, 3)}</legend><select><option>{_word(r)}<option>{_word(r)}</select><textarea>{_sentence(r)}</textarea></fieldset>",
        f"<h3>{_words(r, 1, 4)}</h3><div>{_prose(r)}</div>",
    ))
    return r.choice((f"<form action=/x>{inside}</form>", f'<form class="{r.choice(("search", "login", "newsletter", "contact"))}">{inside}</form>',
                     _box(r, "newsletter signup subscribe search-box login", f"<form>{inside}</form>")))


def _talk(r: random.Random) -> str:
    def one() -> str:
        said = r.choice((f"<p>{_prose(r)}</p>", f"<b>{_word(r)}</b><p>{_prose(r)}</p><p>{_prose(r)}</p>", _prose(r)))
        return r.choice((f'<div class="comment">{said}</div>', f'<article class="comment">{said}</article>', f"<li>{said}</li>", f'<div class="comment-body"><p>{said}</div>'))

    inside = f"<h{r.choice('234')}>{_words(r, 1, 3)}</h3>" * (r.random() < 0.6) + "".join(one() for _ in range(r.randint(1, 5)))
    inside += _form(r) * (r.random() < 0.3)
    return _box(r, "comments comment-list reader-comments discussion responses replies comments-area disqus", inside, "section div div ol ul")


def _share(r: random.Random) -> str:
    return _box(r, "share social share-buttons follow tools", "".join(f"<a href=x>{_word(r)}</a> " for _ in range(3)), "div ul")


def _body(r: random.Random) -> str:
    """Main text: headings, paragraphs, lists, tables, quotes; sometimes unclosed, broken up or very short."""
    out, m = [], MARK
    for _ in range(r.choice((1, 2, 3, 4, 6, 9, 14))):
        kind = r.random()
        if kind < 0.62:
            out.append(f"<p>{m}{_prose(r)}" + r.choice(("</p>", "</p>", "</p>\n", "")))
        elif kind < 0.68:
            out.append(f"<p>{m}<b>{_words(r, 1, 12)}.<br><p>{m}{_prose(r)}</p>")
        elif kind < 0.75:
            h = r.choice("234")
            out.append(f"<h{h}>{m}{_words(r, 1, 6)}</h{h}><p>{m}{_prose(r)}</p>")
        elif kind < 0.80:
            out.append("<ul>" + "".join(f"<li>{m}{_sentence(r)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
        elif kind < 0.83:
            out.append("<ol>" + "".join(f"<li>{m}{_words(r, 1, 4)}" for _ in range(r.randint(2, 4))) + "</ol>")
        elif kind < 0.86:
            out.append(f"<blockquote><p>{m}{_prose(r)}</p></blockquote>")
        elif kind < 0.89:
            out.append("<table>" + "".join(f"<tr><td>{m}{_word(r)}</td><td>{m}{_words(r, 1, 3)}</td></tr>" for _ in range(3)) + "</table>")
        elif kind < 0.91:
            out.append(f"<pre>{m}{_words(r, 2, 20)}\n{_words(r, 2, 9)}</pre>")
        elif kind < 0.93:
            out.append(f"<figure><img src=x><figcaption>{m}{_words(r, 2, 9)}</figcaption></figure>")
        elif kind < 0.95:
            out.append(f"<p>{m}{_prose(r)} <a href=x>{_words(r, 1, 4)}</a> {_sentence(r)}</p>")
        elif kind < 0.97:
            out.append(f"<div>{m}{_prose(r)}</div>")
        else:
            out.append(f"<p>{m}<a href=x>{_words(r, 1, 5)}</a></p>")
        if r.random() < 0.06:
            out.append(r.choice((_advert, _advert, _side, _form, _notice, _share, _menu))(r))
    return "".join(out)


def _article(r: random.Random) -> str:
    title = f"<h1>{MARK}{_words(r, 1, 12)}</h1>"
    title = r.choice((title, title, title, f"<header>{title}</header>", f"<div class=entry-header>{title}</div>", f"<h2>{MARK}{_words(r, 1, 9)}</h2>", ""))
    inside = title + r.choice((_body(r), _body(r), _body(r), f"<div class={r.choice(('content', 'entry-content', 'article-body', 'post-text'))}>{_body(r)}</div>", f"<section>{_body(r)}</section><section>{_body(r)}</section>"))
    late = "".join(part(r) for part, chance in ((_share, 0.1), (_side, 0.1), (_form, 0.08), (_talk, 0.15), (_advert, 0.08), (_notice, 0.05)) if r.random() < chance)
    inside += late + (f"<footer>{_sentence(r)}</footer>" if r.random() < 0.06 else "")
    return r.choice((
        f"<article>{inside}</article>", f"<article>{inside}</article>", f'<article class="{r.choice(("post", "entry", "hentry", "story"))}">{inside}</article>',
        f"<main>{inside}</main>", f"<main><article>{inside}</article></main>", f'<main id="content"><div class="{_word(r)}">{inside}</div></main>',
        _box(r, "content main post entry article story main-content post-body text", inside, "div section"),
        f'<div id="main"><div class="{_word(r)}">{inside}</div></div>', f'<div class="{_word(r)}">{inside}</div>', f'<div class="page"><div class="{_word(r)}"><div>{inside}</div></div></div>',
    ))


def labelled_page(seed: int) -> str:
    """A page in which ``MARK`` begins every block of main text."""
    r = random.Random(seed)
    before = [part(r) for part, chance in ((_notice, 0.25), (_header, 0.4), (_menu, 0.6), (_advert, 0.4), (_form, 0.15), (_side, 0.15)) if r.random() < chance]
    after = [part(r) for part, chance in ((_talk, 0.3), (_side, 0.3), (_advert, 0.25), (_form, 0.15), (_share, 0.1), (_notice, 0.12), (_menu, 0.1), (_footer, 0.75)) if r.random() < chance]
    if r.random() < 0.3:
        r.shuffle(before)
    if r.random() < 0.3:
        r.shuffle(after)
    article = _article(r) if r.random() < 0.97 else ""
    if r.random() < 0.1:
        page = f"{''.join(before)}<table><tr><td>{_menu(r)}</td><td>{article}</td><td>{_side(r)}</td></tr></table>{''.join(after)}"
    elif r.random() < 0.25:
        page = f'{"".join(before[:1])}<div class="{r.choice(("wrapper", "container", "row", "page", "site", "layout"))}">{"".join(before[1:])}{article}{"".join(after[:-1])}</div>{"".join(after[-1:])}'
    else:
        page = "".join(before) + article + "".join(after)
    head = f"<head><meta charset=utf-8><title>{_words(r, 1, 8)}</title><style>p{{margin:0}}</style><script>var t = '</p>';</script></head>"
    return f"<!DOCTYPE html><html lang=en>{head}<body>{page}" + r.choice(("</body></html>", "</body></html>", ""))
