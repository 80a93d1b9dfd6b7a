"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page."""

from __future__ import annotations

import html as html_lib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Elements of HTML that stand inside a line of text; all others part blocks.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr output q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr "
    "annotation annotation-xml math merror mfrac mi mn mo mover mpadded mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is never text of the page.
SKIPPED = frozenset("annotation annotation-xml script style template noscript title iframe object audio video select textarea option datalist button".split())
RAW = frozenset("script style textarea title iframe noscript".split())
#: What stands in a head; any other opening tag, or text, ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
#: An opening tag of the second kind closes an open one of the first.
CLOSED_BY = {
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
# Quotes count only after an equals sign, and no < stands in a tag, so damaged markup costs its length at most.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/<>]*)((?:[^<>=]++|=\s*+(?:\"[^\"<]*+\"|'[^'<]*+')?+)*+)>", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-label)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
UNSEEN = "hidden!"  # the attribute hidden or display:none; no class or id is read as this name
HEADINGS = frozenset(f"<h{n}>" for n in range(1, 7))
#: What the headings of reader comments say.
_TALK = re.compile(
    r"\b(?:comments?|replies|responses|discussion|leave a (?:reply|comment)|kommentare?|antworten|diskussion|comentarios?|respuestas|commentaires?|r[ée]ponses)\b", re.I
)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Block:
    """A run of text between block tags: its text, tags and names around it, those right around it, and linked characters."""

    __slots__ = ("text", "around", "linked", "near")

    def __init__(self, text: str, around: frozenset, linked: int, near: set):
        self.text, self.around, self.linked, self.near = text, around, linked, near


def _attribute_names(attributes: str) -> list[str]:
    names = []
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "").lower()):
            names.append(UNSEEN)
        elif key != "style":
            names.extend(x.lower() for x in _NAME.findall(value))
    return names


def leaf_blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; one pass, whatever the nesting or the damage."""
    blocks: list[Block] = []
    open_: list[tuple[str, list[str]]] = []
    count: dict[str, int] = {}  # open tags and names, with their number
    depth: dict[str, int] = {}  # open elements by tag
    outer: list[list[str]] = []  # open block elements
    named: list[list[str]] = []  # those of them with a class or an id
    parts: list[str] = []
    state = [0, 0, 0]  # skipped elements open, links open, linked characters
    around: frozenset | None = None

    def flush() -> None:
        nonlocal around
        if parts:
            text = _SPACE.sub(" ", html_lib.unescape("".join(parts))).strip()
            if text:
                if around is None:
                    around = frozenset(count)
                near = {*(outer[-1] if outer else ()), *(named[-1] if named else ())}
                blocks.append(Block(text, around, state[2], near))
            parts.clear()
        state[2] = 0

    def add(names: list[str], by: int) -> None:
        for x in names:
            left = count.get(x, 0) + by
            if left:
                count[x] = left
            else:
                del count[x]

    def close() -> None:
        nonlocal around
        tag, names = open_.pop()
        depth[tag] -= 1
        state[0] -= tag in SKIPPED
        state[1] -= tag == "a"
        if names:
            outer.pop()
            if len(names) > 1:
                named.pop()
            add(names, -1)
            around = None

    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() < at:
            continue  # inside raw content
        if m.start() > at and not state[0]:
            parts.append(page[at : m.start()])
            if state[1]:
                state[2] += m.start() - at
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        inline = tag in INLINE
        if not inline:
            flush()
        elif tag == "br" and not state[0]:
            parts.append(" ")
        if m[1]:
            if depth.get(tag):
                while open_:
                    last = open_[-1][0]
                    if inline and last not in INLINE:
                        break  # a stray end inside another block
                    close()
                    if last == tag:
                        break
            continue
        if depth.get("head") and tag not in IN_HEAD and not state[0]:
            while depth["head"]:
                close()
        while open_ and tag in CLOSED_BY.get(open_[-1][0], ()):
            close()
        if not inline and depth.get("p") and tag in CLOSED_BY["p"]:
            while open_ and open_[-1][0] in INLINE:
                close()
            if open_ and open_[-1][0] == "p":
                close()
        if tag in VOID or m[3].endswith("/") and tag not in RAW:
            continue
        names = [] if inline else [f"<{tag}>", *(f".{x}" for x in _attribute_names(m[3]))] if m[3] else [f"<{tag}>"]
        open_.append((tag, names))
        depth[tag] = depth.get(tag, 0) + 1
        state[0] += tag in SKIPPED
        state[1] += tag == "a"
        if names:
            outer.append(names)
            if len(names) > 1:
                named.append(names)
            add(names, 1)
            around = None
        if tag in RAW:  # nothing in it is markup but its own end
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.start() if end else len(page)
    if at < len(page) and not state[0]:
        parts.append(page[at:])
    flush()
    return blocks


def features(blocks: list[Block]) -> list[list[str]]:
    """Ancestor tags and names, what the text itself looks like, and whether it stands under a heading of comments."""
    out = []
    n = len(blocks)
    talk = None  # what stands around the last heading that speaks of comments, as long as its section goes on
    for k, b in enumerate(blocks):
        t = b.text
        words = t.count(" ") + 1
        stops = t.count(".") + t.count("!") + t.count("?")
        f = ["always", *b.around, *(f"in:{x}" for x in b.near), f"words:{min(6, words.bit_length())}", f"linked:{min(3, 4 * b.linked // max(1, len(t)))}"]
        f.append("stop" if t[-1] in ".!?:;\"')…" else "no stop")
        if words >= 8 and stops:
            f.append("sentences")
        if "©" in t or "copyright" in t[:60].lower():
            f.append("copyright")
        if b.linked and ("|" in t or "»" in t or "·" in t):
            f.append("linked bars")
        f.append(f"place:{4 * k // n}")
        heading = not HEADINGS.isdisjoint(b.around)
        if talk is not None and (heading or not talk <= b.around):
            talk = None
        if heading and words <= 6 and _TALK.search(t):
            talk = b.around - HEADINGS
            f.append("heading of comments")
        elif talk is not None:
            f.append("below a heading of comments")
        out.append(f)
    return out


# -- labelled pages

_GOOD, _BAD = 1, 0


def labelled_pages(number: int = 1000, seed: int = 1) -> list[tuple[str, list[int]]]:
    """Labelled training pages ``(html, label per leaf block)``, drawn from page grammars of many kinds.

    Menus, headers, breadcrumbs, notices, adverts, sidebars, forms, related links, comments and footers, around and
    inside an article that is marked up in one of several ways. Words are invented, so nothing is learnt from them.
    """
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))

    def sentence(lo=5, hi=25) -> str:
        return " ".join(word() for _ in range(rng.randint(lo, hi))).capitalize() + rng.choice("....?!")

    def phrase(lo=1, hi=4) -> str:
        return " ".join(word() for _ in range(rng.randint(lo, hi))).capitalize()

    def pick(*names: str) -> str:
        name = rng.choice(names)
        return rng.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {word()}"', f" class='{word()} {name}'"])

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{word()}">{phrase()}</a></li>' for _ in range(n))

    def menu():
        n = rng.randint(3, 8)
        kind = rng.randrange(4)
        if kind == 0:
            return f"<nav{rng.choice(['', pick('main-nav', 'navbar')])}><ul>{links(n)}</ul></nav>", [_BAD] * n
        if kind == 1:
            return f"<div{pick('menu', 'nav', 'navigation', 'top-menu')}><ul>{links(n)}</ul></div>", [_BAD] * n
        if kind == 2:
            return f"<ul{pick('menu', 'nav', 'navbar')}>{links(n)}</ul>", [_BAD] * n
        return f"<nav>{''.join(f'<a href=/{word()}>{phrase()}</a> | ' for _ in range(n))}</nav>", [_BAD]

    def boxed(tags, names, paragraphs, inner="p"):
        n = rng.randint(*paragraphs)
        body = "".join(f"<{inner}>{sentence()} {sentence() if rng.random() < 0.5 else ''}</{inner}>" for _ in range(n))
        tag = rng.choice(tags)
        return f"<{tag}{pick(*names)}>{body}</{tag}>", [_BAD] * n

    def advert():
        if rng.random() < 0.5:
            return f"<div{pick('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'ad-box', 'banner-ad')}>{sentence()}{chr(10)}{sentence()}</div>", [_BAD]
        return boxed(["div", "aside", "section"], ["ad", "advert", "sponsor", "promo", "ads"], (1, 2))

    def notice():
        if rng.random() < 0.5:
            return f"<div{pick('notice', 'cookie', 'cookie-banner', 'consent', 'gdpr', 'alert', 'popup', 'modal')}>{sentence()} <button>{phrase()}</button></div>", [_BAD]
        return boxed(["div", "section", "aside"], ["notice", "cookie-notice", "consent", "alert", "paywall", "newsletter", "subscribe"], (1, 2))

    def sidebar():
        n = rng.randint(2, 6)
        head = f"<h3>{phrase()}</h3>"
        body = rng.choice([f"<ul>{links(n)}</ul>", "".join(f"<p>{sentence()}</p>" for _ in range(n))])
        tag = rng.choice(["aside", "aside", "div", "section"])
        name = "" if tag == "aside" and rng.random() < 0.6 else pick("sidebar", "side-bar", "widget", "related", "related-posts", "recommended", "rail")
        return f"<{tag}{name}>{head}{body}</{tag}>", [_BAD] * (n + 1)

    def form():
        return f"<form action='/{word()}'><p>{sentence()}</p><label>{phrase()}</label><input type=text><button>{phrase()}</button></form>", [_BAD, _BAD]

    def comments():
        n = rng.randint(1, 5)
        said = rng.choice(["Comments", f"{n} comments", "Reader comments", "Leave a comment", "Discussion", f"{n} replies", "Responses", "Kommentare", "Comentarios", "Commentaires"])
        if rng.random() < 0.4:  # nothing but the heading tells
            tag, h = rng.choice(["section", "div", "section"]), rng.choice(["h2", "h3", "h4"])
            one = rng.choice(["<p>{}</p>", "<div><p>{}</p></div>", "<li>{}</li>", "<li>{}</li>"])
            body = "".join(one.format(f"{sentence()} {sentence() if rng.random() < 0.5 else ''}") for _ in range(n))
            return f"<{tag}><{h}>{said}</{h}>{f'<ul>{body}</ul>' if 'li' in one else body}</{tag}>", [_BAD] * (n + 1)
        tag, one = rng.choice(["section", "div", "div"]), rng.choice(["div", "li", "article", "p"])
        body = "".join(
            f"<{one}{pick('comment', 'reply', 'comment-body') if rng.random() < 0.7 else ''}>{'' if one == 'p' else '<p>'}{sentence()} {sentence()}{'' if one == 'p' else '</p>'}</{one}>" for _ in range(n)
        )
        return f"<{tag}{pick('comments', 'comment-list', 'disqus', 'responses', 'discussion')}><h3>{said if rng.random() < 0.5 else phrase()}</h3>{body}</{tag}>", [_BAD] * (n + 1)

    def share():
        n = rng.randint(2, 4)
        return f"<ul{pick('share', 'social', 'tags', 'breadcrumb', 'breadcrumbs', 'pagination')}>{links(n)}</ul>", [_BAD] * n

    def header():
        if rng.random() < 0.5:
            return f"<header><h1>{phrase()}</h1><p>{sentence(3, 8)}</p></header>", [_BAD, _BAD]
        return f"<div{pick('header', 'masthead', 'site-header', 'topbar', 'banner')}><a href='/'>{phrase()}</a></div>", [_BAD]

    def footer():
        text = rng.choice([f"&copy; {word()} &middot; {sentence()}", f"Copyright 20{rng.randint(10, 26)} {phrase()}. {sentence()}", sentence()])
        if rng.random() < 0.6:
            return f"<footer>{text}</footer>", [_BAD]
        return f"<div{pick('footer', 'site-footer', 'copyright', 'foot', 'legal')}><p>{text}</p></div>", [_BAD]

    def paragraph():
        kind = rng.random()
        if kind < 0.62:
            text = " ".join(sentence() for _ in range(rng.randint(1, 5)))
        elif kind < 0.75:
            text = sentence(1, 4)
        elif kind < 0.85:
            text = f"{sentence()} <a href='/{word()}'>{phrase()}</a> {sentence()} <b>{phrase()}</b>."
        else:
            text = f"<b>{sentence()}<br>" if rng.random() < 0.5 else f"<em>{phrase()}</em> {sentence()}"
        return f"<p>{text}" + ("</p>" if rng.random() < 0.85 else "")

    def article():
        out, labels = [f"<h1>{phrase(2, 9)}</h1>" if rng.random() < 0.8 else ""], []
        labels += [_GOOD] * bool(out[0])
        for _ in range(rng.randint(1, 9)):
            draw = rng.random()
            if draw < 0.72:
                out.append(paragraph())
                labels.append(_GOOD)
            elif draw < 0.78:
                out.append(f"<h2>{phrase(1, 6)}</h2>")
                labels.append(_GOOD)
            elif draw < 0.83:
                n = rng.randint(2, 4)
                out.append("<ul>" + "".join(f"<li>{sentence(2, 12)}</li>" for _ in range(n)) + "</ul>")
                labels += [_GOOD] * n
            elif draw < 0.86:
                out.append(f"<blockquote><p>{sentence()}</p></blockquote>")
                labels.append(_GOOD)
            elif draw < 0.88:
                out.append(f"<table><tr><td>{phrase()}</td><td>{phrase()}</td></tr></table>")
                labels += [_GOOD, _GOOD]
            else:
                text, bad = rng.choice([advert, share, notice, sidebar, form])()
                out.append("</p>" + text)
                labels += bad
        if rng.random() < 0.12:
            text, bad = comments()
            out.append("</p>" + text)
            labels += bad
        body = "".join(out)
        kind = rng.random()
        if kind < 0.45:
            return f"<article{rng.choice(['', '', pick('post', 'entry', 'story')])}>{body}</article>", labels
        if kind < 0.57:
            return f"<main{rng.choice(['', pick('content')])}>{body}</main>", labels
        if kind < 0.82:
            return f"<div{pick('content', 'article', 'post', 'entry-content', 'story', 'article-body', 'main', 'post-content', 'text')}>{body}</div>", labels
        return body, labels

    pages = []
    for _ in range(number):
        if rng.random() < 0.05:  # nothing but the article
            body, labels = article()
            if len(leaf_blocks(body)) == len(labels):
                pages.append((body, labels))
            continue
        parts = [x() for x in (notice, header, menu) if rng.random() < 0.6]
        rng.shuffle(parts)
        parts += [x() for x in (share, advert, advert) if rng.random() < 0.4]
        side = [sidebar()] if rng.random() < 0.35 else []
        parts += side if rng.random() < 0.5 else []
        parts.append(article())
        parts += side if not (side and side[0] in parts) else []
        parts += [x() for x in (advert, share, sidebar, form, comments, notice, menu) if rng.random() < 0.25]
        parts += [footer()] if rng.random() < 0.85 else []
        body = "".join(p for p, _ in parts)
        page = f"<html><head><title>{phrase()}</title><style>p{{}}</style><script>var t='</p>';</script></head><body><!-- {word()} -->{body}</body></html>"
        labels = [x for _, y in parts for x in y]
        if len(leaf_blocks(page)) == len(labels):
            pages.append((page, labels))
    return pages


# -- the field

class Field:
    """Weights of a chain with two labels: per feature and label, and per pair of neighbouring labels."""

    def __init__(self, index: dict[str, int], unary: np.ndarray, pair: np.ndarray):
        self.index, self.unary, self.pair = index, unary, pair
        self.margin = {f: float(unary[k, 1] - unary[k, 0]) for f, k in index.items()}

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The likeliest labels of a page, by Viterbi; label 0 scores 0 and label 1 the difference."""
        get, pair = self.margin.get, self.pair
        (p00, p01), (p10, p11) = pair.tolist()
        s0 = s1 = 0.0
        back = []
        for k, row in enumerate(rows):
            gain = sum(get(f, 0.0) for f in row)
            if k:
                a0, b0, a1, b1 = s0 + p00, s1 + p10, s0 + p01, s1 + p11
                back.append((b0 > a0, b1 > a1))
                s0, s1 = max(a0, b0), max(a1, b1) + gain
            else:
                s1 = gain
        label, out = int(s1 > s0), []
        for step in reversed(back):
            out.append(label)
            label = int(step[label])
        out.append(label)
        return out[::-1] if rows else []


def train(pages: list[tuple[str, list[int]]], rounds: int = 40, decay: float = 2e-3, least: int = 3) -> Field:
    """Maximum likelihood by forward and backward sums over each page, with decayed adaptive steps."""
    data = [(features(leaf_blocks(page)), labels) for page, labels in pages]
    seen: dict[str, int] = {}
    for rows, _ in data:
        for row in rows:
            for f in row:
                seen[f] = seen.get(f, 0) + 1
    index = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n >= least))}
    width = max((len(rows) for rows, _ in data), default=1)
    pages_n = len(data)
    cols, owner = [], []
    gold = np.full((pages_n, width), -1)
    for i, (rows, labels) in enumerate(data):
        gold[i, : len(labels)] = labels
        for k, row in enumerate(rows):
            found = [index[f] for f in row if f in index]
            cols += found
            owner += [i * width + k] * len(found)
    cols, owner = np.array(cols), np.array(owner)
    live, n_blocks = gold >= 0, max(1, (gold >= 0).sum())
    unary, pair = np.zeros((len(index), 2)), np.zeros((2, 2))
    square_u, square_p = np.full_like(unary, 1e-8), np.full_like(pair, 1e-8)
    hot = np.stack([(gold == 0), (gold == 1)], axis=-1).astype(float)
    for _ in range(rounds):
        score = np.stack([np.bincount(owner, unary[cols, y], pages_n * width).reshape(pages_n, width) for y in (0, 1)], axis=-1)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for k in range(1, width):
            step = np.logaddexp(forward[:, k - 1, 0, None] + pair[0], forward[:, k - 1, 1, None] + pair[1]) + score[:, k]
            forward[:, k] = np.where(live[:, k, None], step, forward[:, k - 1])
        for k in range(width - 2, -1, -1):
            after = score[:, k + 1] + backward[:, k + 1]
            step = np.logaddexp(pair[:, 0] + after[:, 0, None], pair[:, 1] + after[:, 1, None])
            backward[:, k] = np.where(live[:, k + 1, None], step, 0)
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        chance = np.exp(forward + backward - total[:, None, None]) * live[..., None]
        gap = (hot - chance).reshape(-1, 2)
        grad_u = np.stack([np.bincount(cols, gap[owner, y], len(index)) for y in (0, 1)], axis=-1) / n_blocks - decay * unary / pages_n
        grad_p = np.zeros((2, 2))
        both = live[:, 1:] & live[:, :-1]
        for a in (0, 1):
            for b in (0, 1):
                joint = np.exp(forward[:, :-1, a] + pair[a, b] + score[:, 1:, b] + backward[:, 1:, b] - total[:, None])
                grad_p[a, b] = ((hot[:, :-1, a] * hot[:, 1:, b] - joint) * both).sum() / n_blocks
        square_u += grad_u**2
        square_p += grad_p**2
        unary += 0.5 * grad_u / np.sqrt(square_u)
        pair += 0.5 * grad_p / np.sqrt(square_p)
    return Field(index, unary, pair)


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_pages())


def main_text(page: str | None, field: Field) -> str:
    """The blocks of the article, one a line; empty for null, for pages without text and for pages without an article."""
    if not page:
        return ""
    blocks = [b for b in leaf_blocks(page) if f".{UNSEEN}" not in b.around]
    return "\n".join(b.text for b, keep in zip(blocks, field.decode(features(blocks))) if keep)


def extract(pages: DataFrame, html: str = "html", text: str = "text", field: Field | None = None) -> DataFrame:
    """``pages`` with the main text of each page in column ``text`` (replaced if there is one).

    The field is trained once on the driver from labelled pages (``labelled_pages`` unless another ``field`` is
    given) and sent to the tasks: a few hundred weights. Each page is parsed and decoded alone, in one pass over the
    whole html. White space inside a block becomes one space; a line break inside a paragraph is white space.

    Defined cases: null or empty html and pages without text give an empty text; damaged markup, unclosed elements and
    any nesting are read as far as they go; repeated pages give equal texts; no pages give no rows.
    """
    model = field or default_field()

    @F.arrow_udf("string")
    def of(column: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py(), model) for x in column], pa.string())

    return pages.withColumn(text, of(F.col(html)))
