"""Main text of web pages by a linear-chain conditional random field (operator 5)."""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

DIMS = 1 << 13

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>", re.S)
_ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[a-z]+")
_SELF_CLOSING = re.compile(r"(?:^|[\s\"'])/\s*\Z|=\s*(?:\"[^\"]*\"|'[^']*')\s*/\s*\Z|(?:^|\s)[^\s=\"']+/\s*\Z")


def _inline(tag: str) -> bool:
    return tag in INLINE or ":" in tag  # elements within svg and math are named svg:path, math:mi


def _foreign(stack: list[tuple[str, frozenset[str], int]]) -> str:
    """svg or math if the innermost open element lies within one, unless within its HTML content (foreignObject)."""
    for t, _, _ in reversed(stack):
        if t in ("svg", "math"):
            return t
        if t in ("svg:foreignobject", "svg:desc", "math:annotation-xml"):
            break
    return ""

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea template iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr svg math".split())
#: HTML elements that end an open svg or math element, as the HTML standard lists them.
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strike strong sub sup table tt u ul var".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]      # ancestors, outermost first
    marks: frozenset[str]      # words of the ancestors' class, id and role
    near: frozenset[str]       # those of the innermost ancestor that has any
    linked: int                # characters inside links
    inside: tuple[int, ...]    # numbers of the ancestors, to tell equal containers


def parse(page: str | None) -> list[Block]:
    """DOM leaf blocks: runs of text between boundaries of block elements, with
    character references decoded and white space turned into single spaces;
    empty ones are left out. Content of scripts, styles and the like is not
    text; that of math and svg elements is text within its line, that of xmp a
    block as it stands. Only elements within svg and math can close
    themselves by a slash. Unclosed and unmatched tags are taken as browsers
    mostly do."""
    page = page or ""
    blocks: list[Block] = []
    stack: list[tuple[str, frozenset[str], int]] = []
    run: list[str] = []
    link_runs: list[int] = []
    number = at = 0
    any_foreign = False

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                marks = frozenset().union(*(m for _, m, _ in stack)) if stack else frozenset()
                near = next((m for _, m, _ in reversed(stack) if m), frozenset())
                blocks.append(Block(text, tuple(t for t, _, _ in stack), marks, near, sum(link_runs), tuple(i for _, _, i in stack)))
            run.clear()
            link_runs.clear()

    def pop_to(i: int) -> None:
        if not all(_inline(t) for t, _, _ in stack[i:]):
            flush()
        del stack[i:]

    def say(piece: str) -> None:
        if piece:
            run.append(piece)
            if any(t == "a" for t, _, _ in stack):
                link_runs.append(len(piece.strip()))

    while True:
        m = _TAG.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing, attrs = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if closing:
            if stack and stack[-1][0].startswith("svg:"):
                run.append(" ")
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0].rpartition(":")[2] == tag:
                    pop_to(i)
                    break
                if tag in INLINE and not _inline(stack[i][0]):
                    break  # an inline end tag doesn't close blocks
            else:
                if tag not in INLINE:
                    flush()
            continue
        foreign = _foreign(stack) if any_foreign else ""
        any_foreign = any_foreign or tag in ("svg", "math")
        if foreign and tag in BREAKOUT:
            foreign = ""
            pop_to(max(i for i, x in enumerate(stack) if x[0] in ("svg", "math")))
        closed = bool((foreign or tag in ("svg", "math")) and _SELF_CLOSING.search(attrs))
        if tag in VOID and not foreign:
            if tag == "hr":
                flush()
            elif tag == "br":
                run.append(" ")
            continue
        if tag in RAW or tag == "xmp" and not foreign:
            if not closed:
                end = re.compile(rf"</{re.escape(tag)}\s*/?>", re.I).search(page, at)
                if tag == "xmp":
                    flush()
                    stack.append((tag, frozenset(), number := number + 1))
                    say(html.escape(page[at:end.start() if end else len(page)]))
                    pop_to(len(stack) - 1)
                at = end.end() if end else len(page)
            run.append(" ")
            continue
        if foreign:
            if foreign == "svg":
                run.append(" ")
            tag = f"{foreign}:{tag}"
        if not _inline(tag):
            flush()
            for i in range(len(stack) - 1, -1, -1):  # an open paragraph ends where a block begins
                if stack[i][0] == "p":
                    del stack[i:]
                    break
                if not _inline(stack[i][0]):
                    break
            if tag in CLOSES:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in CLOSES[tag]:
                        del stack[i:]
                        break
                    if stack[i][0] in ("ul", "ol", "dl", "table", "select"):
                        break
        marks = frozenset(w for x in _ATTR.finditer(attrs) for w in _TOKEN.findall((x[2] or x[3] or x[4] or "").lower()))
        number += 1
        if not closed:
            stack.append((tag, marks, number))
    flush()
    return blocks


def _hash(s: str) -> int:
    return zlib.crc32(s.encode()) & (DIMS - 1)


_SEEN: dict[str, int] = {}


def _dim(s: str) -> int:
    if s not in _SEEN:
        if len(_SEEN) > 100_000:
            _SEEN.clear()
        _SEEN[s] = _hash(s)
    return _SEEN[s]


def features(blocks: list[Block]) -> list[list[int]]:
    """Hashed binary features of each block: ancestor tags and the words of
    their class, id and role, the innermost tag, and the text's length, link
    density, punctuation, capitals, digits, signs and place on the page."""
    out = []
    last = max(1, len(blocks) - 1)
    any_article = any("article" in b.tags or "main" in b.tags for b in blocks)
    for i, b in enumerate(blocks):
        n, words = len(b.text), b.text.count(" ") + 1
        leaf = next((t for t in reversed(b.tags) if not _inline(t)), "")
        size = min(words.bit_length(), 9)
        density = min(4, 4 * b.linked // max(1, n))
        end = "." if b.text[-1] in ".!?…\"”»" else ":" if b.text[-1] == ":" else "-"
        f = ["bias", f"leaf={leaf}", f"size={size}", f"link={density}", f"end={end}", f"leaf={leaf} size={size}", f"link={density} size={size}",
             f"place={4 * i // (last + 1)}", f"article={any_article}"]
        f += [f"tag={t}" for t in set(b.tags) if t not in ("html", "body", "div")]
        f += [f"mark={w}" for w in b.marks]
        f += [f"near={w}" for w in b.near]
        f.append(f"marks={bool(b.marks)}")
        if b.text[0] in "©®" or "©" in b.text:
            f.append("copyright")
        f.append(f"capitals={min(3, 8 * sum(map(str.isupper, b.text)) // n)}")
        f.append(f"digits={min(3, 8 * sum(map(str.isdigit, b.text)) // n)}")
        if i:
            p = blocks[i - 1]
            f.append(f"same={p.inside[-1:] == b.inside[-1:]} {p.inside[:-1] == b.inside[:-1]}")
        out.append(sorted({_dim(x) for x in f}))
    return out


@dataclass
class CRF:
    """Two states, 0 other and 1 main text. ``emit`` (DIMS, 2), ``step`` (2, 2)
    scores of following states, ``first`` and ``final`` of the ends."""

    emit: np.ndarray
    step: np.ndarray
    first: np.ndarray
    final: np.ndarray

    def decode(self, blocks: list[Block]) -> list[int]:
        """The best state sequence (Viterbi; the lower state at ties)."""
        if not blocks:
            return []
        score = [self.emit[f].sum(axis=0) for f in features(blocks)]
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = (self.first + score[0]).tolist()
        back = []
        for e in score[1:]:
            x, y = e.tolist()
            na, pa_ = (a + s00, 0) if a + s00 >= b + s10 else (b + s10, 1)
            nb, pb = (a + s01, 0) if a + s01 >= b + s11 else (b + s11, 1)
            back.append((pa_, pb))
            a, b = na + x, nb + y
        state = int(b + self.final[1] > a + self.final[0])
        path = [state]
        for p in reversed(back):
            state = p[state]
            path.append(state)
        return path[::-1]


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit_crf(sequences: list[tuple[list[Block], list[int]]], rounds: int = 150, penalty: float = 1e-4, rate: float = 0.1) -> CRF:
    """Maximum conditional likelihood with an L2 penalty by full-batch Adam;
    forward and backward sums run over all sequences at a time."""
    sequences = [s for s in sequences if s[0]]
    model = CRF(np.zeros((DIMS, 2)), np.zeros((2, 2)), np.zeros(2), np.zeros(2))
    if not sequences:
        return model
    n, longest = len(sequences), max(len(b) for b, _ in sequences)
    length = np.array([len(b) for b, _ in sequences])
    cols, owner, row = [], [], 0
    for blocks, _ in sequences:
        for f in features(blocks):
            cols += f
            owner += [row] * len(f)
            row += 1
    cols, owner = np.array(cols), np.array(owner)
    seq = np.repeat(np.arange(n), length)
    pos = np.arange(row) - np.repeat(np.cumsum(length) - length, length)
    gold = np.concatenate([np.array(y) for _, y in sequences])
    here = np.arange(longest)[None, :] < length[:, None]
    y = np.zeros((n, longest), int)
    y[seq, pos] = gold
    both = here[:, 1:]
    theta = [model.emit, model.step, model.first, model.final]
    m1, m2 = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    edge = np.arange(n)
    for it in range(1, rounds + 1):
        emit, step, first, final = theta
        e = np.zeros((row, 2))
        for k in (0, 1):
            e[:, k] = np.bincount(owner, emit[cols, k], minlength=row)
        x = np.zeros((n, longest, 2))
        x[seq, pos] = e
        alpha, beta = np.zeros_like(x), np.zeros_like(x)
        alpha[:, 0] = first + x[:, 0]
        for t in range(1, longest):
            alpha[:, t] = np.where(here[:, t, None], _logsumexp(alpha[:, t - 1, :, None] + step, 1) + x[:, t], alpha[:, t - 1])
        beta[edge, length - 1] = final
        for t in range(longest - 2, -1, -1):
            on = (t + 1 < length)[:, None]
            beta[:, t] = np.where(on, _logsumexp(step + (x[:, t + 1] + beta[:, t + 1])[:, None, :], 2), beta[:, t])
        z = _logsumexp(alpha[:, -1] + final, 1)
        node = np.exp(alpha + beta - z[:, None, None]) * here[:, :, None]
        pair = np.exp(alpha[:, :-1, :, None] + step + (x[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * both[:, :, None, None]
        truth = np.zeros_like(node)
        truth[seq, pos, gold] = 1
        gap = (node - truth)[seq, pos]
        ge = np.stack([np.bincount(cols, gap[owner, k], minlength=DIMS) for k in (0, 1)], axis=1)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
        grads = [ge, pair.sum(axis=(0, 1)) - seen, (node[:, 0] - truth[:, 0]).sum(axis=0), (node - truth)[edge, length - 1].sum(axis=0)]
        for i, (t, g) in enumerate(zip(theta, grads)):
            g = g / row + penalty * t
            m1[i] = 0.9 * m1[i] + 0.1 * g
            m2[i] = 0.999 * m2[i] + 0.001 * g * g
            t -= rate * (m1[i] / (1 - 0.9 ** it)) / (np.sqrt(m2[i] / (1 - 0.999 ** it)) + 1e-9)
    return model


# Containers of the training layouts.
_MAIN = ["content", "main", "post", "entry", "article", "story", "text", "body", "post-content", "article-body", "entry-content", "main-content", "page-content"]
_OTHER = {
    "menu": ["nav", "menu", "navbar", "navigation", "topbar", "breadcrumb", "breadcrumbs", "main-menu", "site-nav", "links", "tabs", "pagination", "skip"],
    "header": ["header", "site-header", "masthead", "branding", "logo", "page-header", "top", "tagline", "banner"],
    "footer": ["footer", "site-footer", "copyright", "legal", "bottom", "colophon", "imprint", "disclaimer"],
    "side": ["sidebar", "widget", "related", "recommended", "trending", "popular", "tags", "share", "social", "more", "teaser", "promo", "side", "aside", "author", "meta"],
    "notice": ["cookie", "cookies", "notice", "banner", "alert", "consent", "gdpr", "popup", "modal", "overlay", "message", "warning", "subscribe", "newsletter", "paywall", "announcement", "toast"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "adbox", "dfp", "ad-slot"],
    "comment": ["comments", "comment", "comment-list", "responses", "discussion", "replies", "reply", "disqus", "reviews", "guestbook", "reader-comments"],
    "form": ["form", "search", "login", "signup", "contact", "newsletter", "subscribe"],
}


def weak_labels(blocks: list[Block]) -> list[int]:
    """Labels from the markup of pages that say what they are: main text lies in
    <article> or <main> (where a page has neither: in paragraphs, headings,
    lists and quotes), outside menus, headers, footers, asides, forms and
    containers whose class or id names one."""
    bad_tags = {"nav", "aside", "footer", "form", "button", "select", "header"}
    bad = {w for words in _OTHER.values() for x in words for w in x.split("-")} - {"top", "main", "more", "body", "text", "page", "site", "list", "side", "author", "meta"}
    whole = any({"article", "main"} & set(b.tags) for b in blocks)
    good = {"article", "main"} if whole else {"p", "h1", "h2", "h3", "h4", "li", "blockquote", "pre", "td"}
    return [int(bool(good & set(b.tags)) and not bad_tags & set(b.tags) and not bad & b.marks) for b in blocks]


def training_page(texts: list[str], extra: list[str], rng: random.Random) -> tuple[list[Block], list[int]]:
    """A labelled page in a random layout: ``texts`` as the article, pieces of
    ``extra`` (texts of other pages) as everything else."""
    mark = "\u2063"  # begins each main block, and is taken off after parsing
    name = lambda kind: rng.choice(_OTHER[kind])
    attr = lambda x: rng.choice([f' class="{x}"', f' id="{x}"', f' class="{x} {rng.choice("abcxyz")}{rng.randint(1, 99)}"', f" class='box {x}'"])
    esc = lambda s: html.escape(s, quote=False)

    def short(words=6):
        w = rng.choice(extra).split() or ["x"]
        i = rng.randrange(len(w))
        return esc(" ".join(w[i:i + rng.randint(1, words)]))

    def prose():
        return esc(" ".join(rng.choice(extra).split()[:rng.randint(5, 60)]) or "x")

    def links(tag="li"):
        items = "".join(f"<{tag}><a href='/x'>{short(3)}</a></{tag}>" for _ in range(rng.randint(2, 7)))
        return f"<ul>{items}</ul>" if tag == "li" else items

    def box(kind):
        a = attr(name(kind)) if rng.random() < 0.8 else ""
        if kind == "menu":
            tag = rng.choice(["nav", "nav", "div", "ul"]) if a else "nav"
            return f"<{tag}{a}>{links(rng.choice(['li', 'li', 'span', 'div']))}</{tag}>"
        if kind == "header":
            tag = rng.choice(["header", "div"]) if a else "header"
            return f"<{tag}{a}><{rng.choice(['p', 'div', 'h2', 'a', 'h1'])}>{short()}</{tag}>" + (links("span") if rng.random() < 0.3 and tag == "header" and not a else "")
        if kind == "footer":
            tag = rng.choice(["footer", "div"]) if a else "footer"
            return f"<{tag}{a}>{rng.choice(['&copy; ', '© 2024 ', '', ''])}{short(9)}{links('span') if rng.random() < 0.4 else ''}{'<p>' + prose() + '</p>' if rng.random() < 0.4 else ''}</{tag}>"
        if kind == "comment":
            tag = rng.choice(["section", "div", "ol", "ul"])
            a = attr(name(kind))
            one = lambda: rng.choice([f"<div class='comment'><b>{short(2)}</b><p>{prose()}</p></div>", f"<li>{prose()}</li>", f"<p>{prose()}</p>", f"<article class='comment'><p>{prose()}</p></article>"])
            return f"<{tag}{a}>{'<h3>' + short(3) + '</h3>' if rng.random() < 0.6 else ''}{''.join(one() for _ in range(rng.randint(1, 5)))}</{tag}>"
        if kind == "form":
            return f"<form{a}><label>{short(3)}</label><input name=q><p>{short(8)}</p><select><option>{short(1)}</option><option>{short(1)}</option></select><button>{short(2)}</button></form>"
        tag = "aside" if kind == "side" and (not a or rng.random() < 0.5) else rng.choice(["div", "section", "p", "div"])
        a = a or (attr(name(kind)) if tag != "aside" else "")
        inner = rng.choice([short(12), prose(), f"<p>{prose()}</p>", f"<h3>{short(3)}</h3>{links()}", f"<h4>{short(4)}</h4><p>{prose()}</p>", f"<p>{prose()}</p><button>{short(2)}</button>"])
        return f"<{tag}{a}>{inner if tag != 'p' else short(14)}</{tag}>"

    main = []
    for i, t in enumerate(texts):
        t = esc(t)
        words = t.split(" ")
        if len(words) > 6 and rng.random() < 0.25:
            j = rng.randrange(len(words) - 2)
            words[j] = f"<{(k := rng.choice(['a', 'b', 'em', 'i']))}>{words[j]}</{k}>"
            t = " ".join(words)
        tag = rng.choice(["h1", "h1", "h2"]) if i == 0 and len(words) < 20 else rng.choice(["p"] * 12 + ["div", "blockquote", "li", "h2", "pre", "td"])
        piece = f"{mark}{t}"
        main.append({"li": f"<ul><li>{piece}</li></ul>", "td": f"<table><tr><td>{piece}</td></tr></table>", "blockquote": f"<blockquote><p>{piece}</p></blockquote>"}.get(tag, f"<{tag}>{piece}" + ("" if tag == "p" and rng.random() < 0.07 else f"</{tag}>")))
        if rng.random() < 0.06:
            main.append(box(rng.choice(["ad", "side", "form", "notice"])))
    kind = rng.random()
    body = "".join(main)
    if kind < 0.45:
        body = f"<article>{body}</article>" if rng.random() < 0.7 else f"<article{attr(rng.choice(_MAIN))}>{body}</article>"
    elif kind < 0.6:
        body = f"<main{attr(rng.choice(_MAIN)) if rng.random() < 0.5 else ''}>{body}</main>"
    else:
        body = f"<div{attr(rng.choice(_MAIN))}>{body}</div>"
    if rng.random() < 0.3:
        body = f"<{(w := rng.choice(['div', 'section', 'main']))}{attr(rng.choice(['wrapper', 'container', 'row', 'page', 'wrap', 'grid', 'col', 'layout']))}>{body}</{w}>"
    some = lambda kinds, p: [box(k) for k in kinds if rng.random() < p]
    before = some(["notice", "header", "menu", "ad", "side", "form"], 0.4)
    after = some(["side", "ad", "comment", "form", "menu", "notice", "footer"], 0.4)
    rng.shuffle(before)
    page = f"<html><head><title>{short()}</title><script>var t='</p>';</script></head><body>{''.join(before)}{body}{''.join(after)}{box('footer') if rng.random() < 0.6 else ''}</body></html>"
    blocks, labels = parse(page), []
    for b in blocks:
        labels.append(int(mark in b.text))
        b.text = b.text.replace(mark, "").strip() or "x"
    return blocks, labels


def train_extractor(pages: DataFrame, most: int = 200, layouts: int = 3, seed: int = 5, most_blocks: int = 120, most_texts: int = 40) -> CRF:
    """CRF from ``most`` pages at most (the documented bound of the fit; drawn
    by a hash of page_id), labelled by ``weak_labels`` as they are and, so that
    it does not lean on one site's markup, with their texts set in ``layouts``
    random layouts each. Two further bounds of the fit: a page with more than
    ``most_blocks`` blocks teaches by its first and last halves of that many,
    and a random layout holds at most ``most_texts`` texts, evenly spread over
    the page's. Extraction itself has no bounds."""
    draw = F.xxhash64("page_id", F.lit(seed))
    known = pages.filter("html is not null and page_id is not null")
    ids = known.select("page_id").orderBy(draw, "page_id").limit(most).distinct()  # narrow: only ids are gathered
    rows = known.select("page_id", "html").join(F.broadcast(ids), "page_id").orderBy(draw, "page_id", F.md5("html")).limit(most).collect()
    rng = random.Random(seed)
    known = []
    for r in rows:
        blocks = parse(r.html)
        labels = weak_labels(blocks)
        if blocks:
            known.append((blocks, labels))
    extra = [b.text for blocks, _ in known for b in blocks]
    spread = lambda x: [x[i] for i in sorted(set(np.linspace(0, len(x) - 1, min(len(x), most_texts)).astype(int).tolist()))]
    made = [training_page(spread([b.text for b, y in zip(blocks, labels) if y]), extra, rng)
            for blocks, labels in known if any(labels) for _ in range(layouts)]
    half = max(1, most_blocks // 2)
    cut = lambda s: s if len(s[0]) <= most_blocks else (s[0][:half] + s[0][-half:], s[1][:half] + s[1][-half:])
    return fit_crf([cut(s) for s in known + made])


def extract_text(pages: DataFrame, model: CRF) -> DataFrame:
    """``pages``' columns without html, plus text (main blocks in page order,
    joined by line ends; empty if none) and n_chars (code points). Null html is
    empty. Columns of these names are overwritten."""
    names = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*names).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page in batch["html"]:
                blocks = parse(page.as_py())
                texts.append("\n".join(b.text for b, y in zip(blocks, model.decode(blocks)) if y))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             [*names, "text", "n_chars"])

    return pages.select(*names, "html").mapInArrow(K.tidy(run), f"{kinds}, text string, n_chars long" if names else "text string, n_chars long")
