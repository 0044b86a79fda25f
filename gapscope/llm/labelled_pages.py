"""Labelled training pages for the HTML model: many layouts, each block marked as article text or not.

A page is put together at random (fixed seed) from the usual parts of web
pages. On odd pages names do not help: articles are called by words of any
kind of block, furniture often has no name, headings stand in headers. Blocks carry ``data-y="1"`` (article) or ``"0"``. The labels are read by
the fit alone; scored pages have no such attribute, and it is never a feature.
"""

from __future__ import annotations

import random
import re

from gapscope.llm.dom import HINTS

_SYLLABLES = "an the of er re on in at es ti or st ed ing tion ha en nd th ou ea he ly ble wh sh is to be it".split()
LABEL = "data-y"
#: Of odd pages: shares of articles with misleading or made-up names, of furniture whose names are left out, and of articles with a header of their own.
MISNAMED, UNNAMED, HEADED = 0.6, 0.4, 0.3
_NAMES = re.compile(r' (?:class|id|role)="[^"]*"')


def labelled_pages(count: int = 600, seed: int = 11, odd: float = 0.0) -> list[str]:
    """``odd`` is the share of pages whose names mislead or are left out."""
    return [_page(random.Random(f"{seed}:{i}"), odd) for i in range(count)]


def _word(r) -> str:
    return "".join(r.choice(_SYLLABLES) for _ in range(r.choice((1, 1, 1, 2, 2, 3))))


def _words(r, low, high) -> str:
    return " ".join(_word(r) for _ in range(r.randint(low, high)))


def _sentences(r, count) -> str:
    style = r.random()
    out = []
    for _ in range(count):
        s = _words(r, 1, 24)
        if style < 0.06:
            s = " ".join(w + r.choice(("###", "%%%", "&amp;&amp;&amp;", "***", "$$$")) for w in s.split())
        elif style < 0.1:
            s = " ".join(w.upper() + "!!" for w in s.split())
        elif style < 0.14:
            s = " | ".join(s.split())
        elif style < 0.26:
            s = " ".join([_word(r)] * r.randint(2, 60))
        out.append(s[:1].upper() + s[1:] + ("" if 0.06 < style < 0.3 else r.choice((".", ".", ".", "?", ","))))
    return " ".join(out)


def _inline(r, s) -> str:
    if r.random() < 0.25:
        w = s.split(" ")
        k = r.randrange(len(w))
        tag = r.choice(("b", "em", "strong", "i", 'a href="/x"', "code", "span"))
        w[k] = f"<{tag}>{w[k]}</{tag.split()[0]}>"
        s = " ".join(w)
    return s


def _names(r) -> str:
    """A class or id that tells nothing: made-up words and words of any kind of block."""
    words = [_word(r) if r.random() < 0.4 else r.choice(sorted(r.choice(HINTS))) for _ in range(r.choice((1, 2, 2, 3)))]
    return f' {r.choice(("class", "class", "id"))}="{r.choice("- _").join(words)}"'


def _article(r, odd: bool) -> str:
    y = f' {LABEL}="1"'
    out = [f"<h1{y}>{_words(r, 1, 12)}</h1>"] if r.random() < 0.85 else []
    if out and odd and r.random() < HEADED:
        dated = f"<p{y}>{_words(r, 2, 5)}</p>" if r.random() < 0.3 else ""
        out = [f'<header{_names(r) if r.random() < 0.5 else ""}>{out[0]}{dated}</header>']
    for _ in range(r.choice((1, 2, 3, 5, 8, 13))):
        kind = r.random()
        body = _inline(r, _sentences(r, r.choice((1, 1, 2, 4, 9))))
        if kind < 0.62:
            out.append(f"<p{y}>{body}" + ("</p>" if r.random() < 0.85 else ""))
        elif kind < 0.70:
            out.append(f"<p{y}><b>{body}<br>")
        elif kind < 0.76:
            out.append(f"<h{r.randint(2, 4)}{y}>{_words(r, 1, 8)}</h2>".replace("</h2>", "</h3>") if r.random() < 0.1 else f"<h2{y}>{_words(r, 1, 8)}</h2>")
        elif kind < 0.82:
            tag = r.choice(("ul", "ol"))
            out.append(f"<{tag}>" + "".join(f"<li{y}>{_words(r, 1, 18)}.</li>" for _ in range(r.randint(2, 6))) + f"</{tag}>")
        elif kind < 0.87:
            out.append(f"<blockquote{y}>{body}</blockquote>")
        elif kind < 0.90:
            out.append(f"<pre{y}>{_words(r, 3, 30)}\n  {_words(r, 3, 20)}</pre>")
        elif kind < 0.94:
            out.append("<table>" + "".join("<tr>" + "".join(f"<td{y}>{_words(r, 1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(3)) + "</table>")
        else:
            out.append(f'<figure><img src="x.png"><figcaption{y}>{_words(r, 3, 14)}.</figcaption></figure>')
    inner = "".join(out)
    wrapper = r.choice(("article", "article", "article", "main", 'div class="content"', 'div id="main-content"', 'div class="post-body"', 'section class="entry-content"', 'div class="story"', "section", "div"))
    for _ in range(r.choice((0, 0, 0, 1))):
        inner = f"<div{_names(r) if odd and r.random() < MISNAMED else ''}>{inner}</div>"
    if odd and r.random() < MISNAMED:
        wrapper = wrapper.split()[0] + _names(r)
    return f"<{wrapper}>{inner}</{wrapper.split()[0]}>"


def _noise(r, kind, odd: bool) -> str:
    made = _named_noise(r, kind)
    if not odd:
        return made
    if (kind in ("nav", "notice", "share", "comments") or "<aside" in made) and r.random() < UNNAMED:  # told by their look alone
        made = _NAMES.sub("", made)
    elif r.random() < 0.1:
        if not _NAMES.search(made[: made.index(">")]):
            made = re.sub(r"^<(\w+)", lambda m: f"<{m[1]}{_names(r)}", made)
    return made


def _named_noise(r, kind) -> str:
    n = f' {LABEL}="0"'
    link = lambda: f'<a href="/{_word(r)}">{_words(r, 1, 3)}</a>'
    items = lambda: "".join(f"<li{n}>{link()}</li>" for _ in range(r.randint(3, 9)))
    if kind == "nav":
        tag = r.choice(("nav", "nav", 'div class="navbar"', 'ul id="menu"', 'div class="breadcrumbs"', 'div role="navigation"'))
        return f"<{tag}>" + (f"<ul>{items()}</ul>" if not tag.startswith("ul") else items()) + f"</{tag.split()[0]}>"
    if kind == "header":
        return r.choice((f'<header><div{n} class="logo">{_words(r, 1, 3)}</div><p{n}>{_words(r, 2, 9)}</p></header>', f'<div{n} id="header">{_words(r, 1, 5)}</div>', f'<div class="site-header"><span{n} class="brand">{_words(r, 1, 4)}</span></div>'))
    if kind == "footer":
        return r.choice((f"<footer{n}>&copy; {_word(r)}.example.com &middot; {_sentences(r, 1)}</footer>", f'<footer><p{n}>&copy; 20{r.randint(10, 29)} {_words(r, 1, 6)}</p><ul>{items()}</ul></footer>', f'<div{n} class="footer">{_sentences(r, r.randint(1, 3))}</div>'))
    if kind == "aside":
        return r.choice((f"<aside><h3{n}>{_words(r, 1, 3)}</h3><ul>{items()}</ul></aside>", f'<div class="sidebar"><p{n}>{_sentences(r, r.randint(1, 3))}</p></div>', f'<div id="related-posts"><h2{n}>{_words(r, 1, 3)}</h2>' + "".join(f"<p{n}>{link()}</p>" for _ in range(3)) + "</div>"))
    if kind == "ad":
        return r.choice((f'<div{n} class="ad">{_sentences(r, r.randint(1, 2))}</div>', f'<div class="advert"><p{n}>{_sentences(r, 1)}</p></div>', f'<div{n} id="sponsored">{link()} {_sentences(r, 1)}</div>', f'<div{n} class="promo-box">{_sentences(r, 2)}</div>'))
    if kind == "notice":
        asked = "".join(f"<button{n}>{_word(r)}</button>" for _ in range(r.randint(1, 2)))
        return r.choice((f'<div class="cookies"><p{n}>{_sentences(r, r.randint(1, 3))}</p>{asked}</div>', f'<div{n} class="cookie-notice">{_sentences(r, r.randint(1, 3))} <button>{_word(r)}</button></div>', f'<div id="consent"><p{n}>{_sentences(r, 2)}</p><button{n}>{_word(r)}</button></div>', f'<div{n} class="alert" role="alert">{_sentences(r, 1)} <button>{_word(r)}</button></div>'))
    if kind == "form":
        return r.choice((f'<form{n} action="/s"><label>{_word(r)}</label><input name="q"><button>{_word(r)}</button></form>', f'<form class="newsletter"><p{n}>{_sentences(r, 1)}</p><input type="email"><button>{_word(r)}</button></form>'))
    if kind == "share":
        return f'<div class="share">{"".join(f"<a{n} href=#>{_word(r)}</a> " for _ in range(4))}</div>'
    # the writer's name stands first
    name = r.choice(("b", "strong", "cite", "h4", "h5"))
    made = r.choice(("li", "div", "article"))
    unnamed_one = f'<{made}><{name}{n}>%s</{name}><p{n}>%s</p></{made}>'
    if r.random() < 0.3:
        many = "".join(unnamed_one % (_word(r), _sentences(r, r.randint(1, 5))) for _ in range(r.randint(2, 8)))
        tag = "ul" if made == "li" else r.choice(("div", "section"))
        return f'<section class="comments"><h3{n}>{_words(r, 1, 2)}</h3><{tag}>{many}</{tag}></section>'
    one = lambda: r.choice((f'<li class="comment"><b>{_word(r)}</b><p{n}>{_sentences(r, r.randint(1, 5))}</p></li>', f'<div class="comment"><p{n}>{_sentences(r, r.randint(1, 5))}</p></div>'))
    head = f"<h3{n}>{_words(r, 1, 2)}</h3>"
    many = "".join(one() for _ in range(r.randint(1, 8)))
    return r.choice((f'<section id="comments">{head}<ol>{many}</ol></section>', f'<div class="comments">{head}{many}</div>', f'<ul class="commentlist">{many}</ul>'))


def _page(r, odd_share: float) -> str:
    odd = r.random() < odd_share
    before = [k for k in ("header", "nav", "notice", "ad", "form") if r.random() < 0.5]
    after = [k for k in ("share", "comments", "aside", "ad", "form", "footer") if r.random() < 0.5]
    if not before and not after:
        before, after = ["nav"], ["footer"]
    r.shuffle(before)
    body = _article(r, odd)
    if r.random() < 0.25:  # noise inside the article's wrapper, ahead of its end
        cut = body.rindex("</")
        body = body[:cut] + _noise(r, r.choice(("ad", "share", "aside", "comments", "notice")), odd) + body[cut:]
    if r.random() < 0.3:
        body = f'<div class="{r.choice(("container", "wrapper", "page", "row"))}">{body}{_noise(r, "aside", odd) if r.random() < 0.4 else ""}</div>'
    parts = [_noise(r, k, odd) for k in before] + [body] + [_noise(r, k, odd) for k in after]
    head = f'<head><meta charset="utf-8"><title>{_words(r, 2, 6)}</title><style>p{{margin:0}}</style><script>var a="<p>{_word(r)}</p>";</script></head>'
    return f"<!DOCTYPE html><html>{head}<body>{'<!-- x -->'.join(parts)}</body></html>"
