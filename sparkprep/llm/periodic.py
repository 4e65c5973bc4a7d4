"""Periodic runs of words by grammar compression (operator 13): Re-Pair over
the word ids, runs across each nonterminal's boundary, translated to all its
derivation positions and merged."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import kernels as K
from .kernels import IS_SPACE, U64, chunks, mix, powers, utf8, words
from .vocabulary import word_ids

_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


@dataclass
class Grammar:
    """Nonterminals as spans of the sequence: ``left`` words of ``total`` come
    from the first symbol of the rule. Occurrences of nonterminal k are the
    starts ``at[first[k]:first[k + 1]]``, the first of which stands for all."""

    left: np.ndarray
    total: np.ndarray
    first: np.ndarray
    at: np.ndarray


def re_pair(seq: np.ndarray, part: np.ndarray) -> Grammar:
    """Grammar of ``seq``, whose symbols are numbers of their own in each text;
    nothing is paired across a change of ``part``.

    Rounds replace pairs that occur twice or more, many at a time: of
    overlapping pairs the more frequent one is taken (a hash settles ties), so
    each text's most frequent pair is replaced in every round. A part without
    a repeated pair is done. What is left of each part, its start rule, is
    halved into nonterminals that occur once each."""
    n = len(seq)
    sym, pos, size = seq.astype(np.int64), np.arange(n), np.ones(n, np.int64)
    own = part
    names = int(sym.max()) + 1 if n else 0
    left, total, counts, at = [], [], [], []
    rest = []
    while len(sym):
        link = np.append(own[1:] == own[:-1], False)
        i = np.flatnonzero(link)
        twin = np.append(sym[1:] == sym[:-1], False) & link
        begins = twin & ~np.concatenate([[False], twin[:-1]])
        since = np.arange(len(sym)) - np.maximum.accumulate(np.where(begins, np.arange(len(sym)), 0))
        i = i[~(twin[i] & (since[i] % 2 == 1))]  # of a a a a every other pair
        key, back, n_pair = np.unique(sym[i] * names + sym[i + 1], return_inverse=True, return_counts=True)
        order = np.lexsort((mix(key.astype(U64)), n_pair))
        rank = np.empty(len(key), np.int64)
        rank[order] = np.arange(1, len(key) + 1)
        rank[n_pair < 2] = 0
        level = np.zeros(len(sym) + 2, np.int64)
        level[i + 1] = rank[back]
        mine = level[i + 1]
        taken = (mine > 0) & (mine > level[i]) & (mine > level[i + 2])
        if not taken.any():
            rest.append((own, pos, size))
            break
        i, k = i[taken], back[taken]
        by = np.argsort(k, kind="stable")
        i, k = i[by], k[by]
        new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        left.append(size[i[new]])
        total.append((size[i] + size[i + 1])[new])
        counts.append(np.diff(np.append(new, len(k))))
        at.append(pos[i])
        sym[i] = names + np.repeat(np.arange(len(new)), counts[-1])
        names += len(new)
        size[i] += size[i + 1]
        keep = np.ones(len(sym), bool)
        keep[i + 1] = False
        busy = np.zeros(len(sym), bool)
        busy[np.flatnonzero(level[1:-1])] = True
        alive = np.isin(own, own[busy]) if not busy.all() else np.ones(len(sym), bool)
        done = keep & ~alive
        if done.any():
            rest.append((own[done], pos[done], size[done]))
        keep &= alive
        sym, pos, size, own = sym[keep], pos[keep], size[keep], own[keep]
    if rest:
        own, pos, size = (np.concatenate(x) for x in zip(*rest))
        by = np.argsort(pos, kind="stable")
        own, pos, size = own[by], pos[by], size[by]
    while len(own):
        begins = np.concatenate([[True], own[1:] != own[:-1]])
        no = np.arange(len(own)) - np.maximum.accumulate(np.where(begins, np.arange(len(own)), 0))
        i = np.flatnonzero((no[:-1] % 2 == 0) & (own[1:] == own[:-1]))
        if not len(i):
            break
        left.append(size[i])
        total.append(size[i] + size[i + 1])
        counts.append(np.ones(len(i), np.int64))
        at.append(pos[i])
        size[i] += size[i + 1]
        keep = np.ones(len(own), bool)
        keep[i + 1] = False
        own, pos, size = own[keep], pos[keep], size[keep]
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return Grammar(cat(left), cat(total), np.concatenate([[0], np.cumsum(cat(counts))]).astype(np.int64), cat(at))


class _Hashed:
    """Lengths of common extensions in a sequence, by polynomial hashes."""

    def __init__(self, seq: np.ndarray, seed: int):
        p, self.inv = powers(len(seq) + 1)
        self.c = np.zeros(len(seq) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(mix(seq.astype(U64) + U64(seed)) * p[:len(seq)], out=self.c[1:])

    def _same(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.c[x + n] - self.c[x]) * self.inv[x] == (self.c[y + n] - self.c[y]) * self.inv[y]

    def ahead(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from x and y on agree, at most ``most``."""
        got = np.zeros(len(x), np.int64)
        for bit in reversed(range(int(most.max(initial=0)).bit_length())):
            to = got + (1 << bit)
            ok = np.flatnonzero(to <= most)
            ok = ok[self._same(x[ok], y[ok], to[ok])]
            got[ok] = to[ok]
        return got

    def behind(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before x and y agree, at most ``most``."""
        got = np.zeros(len(x), np.int64)
        for bit in reversed(range(int(most.max(initial=0)).bit_length())):
            to = got + (1 << bit)
            ok = np.flatnonzero(to <= most)
            ok = ok[self._same(x[ok] - to[ok], y[ok] - to[ok], to[ok])]
            got[ok] = to[ok]
        return got


def _crossing(seq: np.ndarray, g: Grammar, min_length: int, exponent: int, seed: int, cells: int = 1 << 19) -> tuple[np.ndarray, ...]:
    """Runs (nonterminal, start, end, period) that lie in a nonterminal's
    first occurrence and hold words of both its symbols.

    A run with period q of at least exponent*q words around a boundary agrees
    with itself q words on at the last word before the boundary, or q words
    before that; one of that word's neighbours does so too. Where this holds
    the agreement is extended both ways as far as the nonterminal goes."""
    h = _Hashed(seq, seed)
    wide = np.flatnonzero(g.total >= min_length)
    low = g.at[g.first[wide]]
    high, last = low + g.total[wide], low + g.left[wide] - 1
    most = g.total[wide] // exponent
    ends = np.cumsum(most)
    out = []
    i = 0
    while i < len(wide):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + cells, "right")))
        node = np.repeat(np.arange(i, j), most[i:j])
        q = np.arange(len(node)) - np.repeat(np.cumsum(most[i:j]) - most[i:j], most[i:j]) + 1
        for back in (0, 1):
            x = last[node] - back * q
            k = np.flatnonzero((x >= low[node]) & (x + q < high[node]))
            x, p, m = x[k], q[k], node[k]
            k = np.flatnonzero(seq[x] == seq[x + p])
            x, p, m = x[k], p[k], m[k]
            before = (x > low[m]) & (seq[x - 1] == seq[x - 1 + p])
            after = x + p + 1 < high[m]
            after &= seq[x + 1] == seq[np.minimum(x + p + 1, len(seq) - 1)]
            k = np.flatnonzero(before | after)
            x, p, m = x[k], p[k], m[k]
            s = x - h.behind(x, x + p, x - low[m])
            e = x + p + h.ahead(x, x + p, high[m] - x - p)
            k = np.flatnonzero((e - s >= np.maximum(min_length, exponent * p)) & (s <= last[m]) & (e >= last[m] + 2))
            out.append(np.stack([m[k], s[k], e[k], p[k]]))
        i = j
    if not out:
        return (np.zeros(0, np.int64),) * 4
    m, s, e, p = np.concatenate(out, axis=1)
    by = np.lexsort((p, e, s, m))  # of the periods of one interval only the smallest is a run's
    m, s, e, p = m[by], s[by], e[by], p[by]
    one = np.concatenate([[True], (m[1:] != m[:-1]) | (s[1:] != s[:-1]) | (e[1:] != e[:-1])]) if len(m) else np.zeros(0, bool)
    return wide[m[one]], s[one], e[one], p[one]


def _agree(seq: np.ndarray, s: np.ndarray, e: np.ndarray, p: np.ndarray) -> bool:
    return all(np.array_equal(seq[i:j - q], seq[i + q:j]) for i, j, q in zip(s.tolist(), e.tolist(), p.tolist()))


def _plain(seq: np.ndarray, part: np.ndarray, min_length: int, exponent: int) -> tuple[np.ndarray, ...]:
    """The same intervals period by period, for sequences whose hashes keep meeting."""
    out = []
    for q in range(1, len(seq) // exponent + 1):
        same = np.concatenate([[False], (seq[q:] == seq[:-q]) & (part[q:] == part[:-q]), [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        s, e = edge[::2], edge[1::2] + q
        k = e - s >= max(min_length, exponent * q)
        out += [(i, j, q) for i, j in zip(s[k].tolist(), e[k].tolist())]
    best: dict[tuple[int, int], int] = {}
    for i, j, q in out:
        best.setdefault((i, j), q)
    rows = np.array([(i, j, q) for (i, j), q in best.items()], np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 1], rows[:, 2]


def _merged(s: np.ndarray, e: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of one period that share that many words become one."""
    if not len(s):
        return s, e, p
    by = np.lexsort((s, p))
    s, e, p = s[by], e[by], p[by]
    top = int(e.max()) + 1
    _, step = np.unique(p, return_inverse=True)
    reach = np.maximum.accumulate(step * top + e) - step * top
    new = np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] + p[1:] > reach[:-1])])
    first = np.flatnonzero(new)
    return s[first], reach[np.append(first[1:], len(s)) - 1], p[first]


def runs_of(seq: np.ndarray, part: np.ndarray, min_length: int = 6, exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of all maximal runs of at least ``min_length``
    words and ``exponent`` periods in ``seq`` (numbers that differ between
    texts) that stay within one ``part``."""
    g = re_pair(seq, part)
    for seed in (0x5DEECE66D, 0xB5026F5AA96619E9, 0x2545F4914F6CDD1D):
        node, s, e, p = _crossing(seq, g, min_length, exponent, seed)
        if _agree(seq, s, e, p):
            break
    else:
        return _merged(*_plain(seq, part, min_length, exponent))
    count = (g.first[1:] - g.first[:-1])[node]
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    move = g.at[np.repeat(g.first[node], count) + step] - np.repeat(g.at[g.first[node]], count)
    return _merged(np.repeat(s, count) + move, np.repeat(e, count) + move, np.repeat(p, count))


def _stretches(ids: np.ndarray, doc: np.ndarray, min_length: int, exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where runs can be: the places kept, their words' numbers (each text has
    its own) and the stretch each lies in. A word of a run occurs in its text
    ``exponent`` times at least, and two words next to each other in it once less."""
    _, own, n = np.unique(doc * (int(ids.max(initial=0)) + 1) + ids, return_inverse=True, return_counts=True)
    often = n[own] >= exponent
    i = np.flatnonzero(often[:-1] & often[1:] & (doc[:-1] == doc[1:]))
    _, back, n = np.unique(own[i] * (int(own.max(initial=0)) + 1) + own[i + 1], return_inverse=True, return_counts=True)
    link = np.zeros(len(ids) + 1, bool)
    link[i[n[back] >= exponent - 1] + 1] = True  # link[k]: word k - 1 and word k
    stretch = np.cumsum(~link[:-1])
    keep = np.flatnonzero(np.bincount(stretch, minlength=1)[stretch] >= min_length) if len(ids) else np.zeros(0, np.int64)
    return keep, own[keep], stretch[keep]


def text_runs(b: np.ndarray, offsets: np.ndarray, min_length: int = 6, exponent: int = 4):
    """All runs of the texts in UTF-8 bytes ``b`` by start, then period: the
    words' starts, ends and row offsets, and the runs' first words, ends and periods."""
    s, e, wo = words(b, offsets)
    ids, _, _ = word_ids(b, s, e)
    doc = np.repeat(np.arange(len(wo) - 1), np.diff(wo))
    keep, own, stretch = _stretches(ids, doc, min_length, exponent)
    rs, re, rp = runs_of(np.unique(own, return_inverse=True)[1], stretch, min_length, exponent) if len(keep) else (keep, keep, keep)
    rs, re = keep[rs], keep[re - 1] + 1 if len(re) else re
    by = np.lexsort((rp, rs))
    return (s, e, wo), (rs[by], re[by], rp[by])


def _collapsed(b: np.ndarray, offsets: np.ndarray, s: np.ndarray, e: np.ndarray, wo: np.ndarray, dropped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of the words that are not dropped, joined by one space."""
    row = np.repeat(np.arange(len(wo) - 1), np.diff(wo))[~dropped]
    s, e = s[~dropped], e[~dropped]
    more = np.append(row[1:] == row[:-1], False)  # another kept word follows in the row, so a white-space byte does
    edge = np.zeros(len(b) + 2, np.int8)
    edge[s] = 1
    edge[e + more] -= 1
    mask = np.cumsum(edge[:len(b)], dtype=np.int8).astype(bool)
    size = np.bincount(row, weights=e - s + more, minlength=len(wo) - 1).astype(np.int64)
    return np.where(IS_SPACE[b], 32, b)[mask].astype(np.uint8), np.concatenate([[0], np.cumsum(size)])


def collapse_runs(docs: DataFrame, min_length: int = 6, exponent: int = 4) -> DataFrame:
    """``docs`` (with text; other columns are kept as they are) with runs, an
    array of (start, length, period) by start, then period, and collapsed: the
    words (runs of bytes other than space and \\t to \\r) joined by one space,
    without those that a run holds after its first period.

    A run is a stretch of words with smallest period q, of at least
    ``min_length`` words and ``exponent`` (4 or more) times q words, that no
    neighbouring word extends. Words are numbered from 0.

    Null and empty texts have no runs and an empty collapsed text. Rows are
    texts of their own, whatever their ids; repeated rows come out each.
    Columns named runs or collapsed are replaced. An empty table gives an
    empty one. Texts are handled whole, a few MB of rows at a time: the
    longest text and its word numbers must fit in a task, about 60 bytes a
    byte of text. Each row stands alone, so a lost task is run again."""
    if exponent < 4 or min_length < exponent:
        raise ValueError("runs of fewer than four periods are not found")
    kept = [c for c in docs.columns if c not in ("runs", "collapsed")]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, offsets = utf8(batch["row"].field("text"))
            for lo, hi in chunks(offsets):
                own, at = b[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                (s, e, wo), (rs, re, rp) = text_runs(own, at, min_length, exponent)
                edge = np.zeros(len(s) + 1, np.int64)
                np.add.at(edge, rs + rp, 1)
                np.add.at(edge, re, -1)
                out, to = _collapsed(own, at, s, e, wo, np.cumsum(edge[:-1]) > 0)
                doc = np.searchsorted(wo, rs, "right") - 1
                split = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(split), pa.StructArray.from_arrays([pa.array(x) for x in (rs - wo[doc], re - rs, rp)], fields=list(kind.value_type)))
                text = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(to), pa.py_buffer(out)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch["row"].slice(lo, hi - lo), runs, text], ["row", "runs", "collapsed"])

    schema = StructType([packed.schema["row"], *StructType.fromDDL(f"runs {_RUNS}, collapsed string").fields])
    return packed.mapInArrow(K.tidy(run), schema).select("row.*", "runs", "collapsed")
