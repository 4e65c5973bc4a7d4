"""Language identification by nearest TF-IDF centroid (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .store import materialise, small_or_shuffled

DIMS = 4096
#: Rows whose dense vectors are in memory at a time.
ROWS = 256
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)


def _grams(b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, DIMS) float32 counts of hashed byte 2- and 3-grams of the folded
    text: ASCII letters in lower case, other ASCII as space, other bytes kept;
    grams don't cross rows, and a row has a space on either side. Grams of
    spaces only are left out."""
    rows, n = len(offsets) - 1, len(b)
    x = np.full(n + 2 * rows, 32, np.uint32)
    shift = np.repeat(2 * np.arange(rows) + 1, np.diff(offsets))
    x[np.arange(n) + shift] = _FOLD[b]
    row = np.repeat(np.arange(rows), np.diff(offsets) + 2)
    two = x[:-1] << np.uint32(8) | x[1:]
    out = np.zeros((rows, DIMS), np.float32)
    keep = (row[:-1] == row[1:]) & (two != 0x2020)
    code = (two * np.uint32(0x9E3779B1)) >> np.uint32(20)
    flat = np.bincount(row[:-1][keep] * DIMS + code[keep], minlength=rows * DIMS)
    three = two[:-1] << np.uint32(8) | x[2:]
    keep = (row[:-2] == row[2:]) & (three != 0x202020)
    code = (three * np.uint32(0x85EBCA77)) >> np.uint32(20)
    flat += np.bincount(row[:-2][keep] * DIMS + code[keep], minlength=rows * DIMS)
    out[:] = flat.reshape(rows, DIMS)
    return out


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


#: Lengths in bytes at which the least cosine of a language is learned.
LENGTHS = 8 << np.arange(8)


@dataclass
class Centroids:
    """``bound`` has, for each language of ``names`` and each of ``LENGTHS``,
    the cosine below which a text of that length that is nearest to the
    language belongs to no learned language."""

    langs: list[str]       # of each centroid, sorted
    centre: np.ndarray     # (centroids, DIMS)
    idf: np.ndarray
    names: list[str]       # of the languages, sorted
    bound: np.ndarray      # (languages, lengths)

    def best(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, languages) cosine with the nearest centroid of each language."""
        first = [i for i, lang in enumerate(self.langs) if not i or lang != self.langs[i - 1]]
        return np.maximum.reduceat(vectors @ self.centre.T, first, axis=1)

    def least(self, top: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The bound of language ``top`` at ``size`` bytes: linear in the
        logarithm of the size, towards zero below the shortest length and
        even beyond the longest."""
        at = np.log2(np.maximum(size, 1) / LENGTHS[0]).clip(0, len(LENGTHS) - 1)
        lo = np.floor(at).astype(int)
        hi = np.minimum(lo + 1, len(LENGTHS) - 1)
        bound = self.bound[top, lo] + (at - lo) * (self.bound[top, hi] - self.bound[top, lo])
        return bound * np.minimum(1, size / LENGTHS[0])


def _pieces(texts: list[str], length: int, most: int = 4) -> list[str]:
    """Up to ``most`` pieces of ``length`` bytes of each text that has them, evenly spread over the whole text."""
    out = []
    for text in texts:
        raw = text.encode()
        n = min(most, len(raw) // length)
        starts = [(2 * i + 1) * len(raw) // (2 * n) - length // 2 for i in range(n)]
        out += [raw[i:i + length].decode("utf-8", "ignore") for i in starts]
    return [x for x in out if has_letter(x)]


def _text_vectors(texts: list[str], idf: np.ndarray) -> Iterator[np.ndarray]:
    b, o = K.utf8(pa.array(texts, pa.large_string()))
    for lo, hi in K.chunks(o, 1 << 20, ROWS):
        yield _vectors(_grams(b[o[lo]:o[hi]], o[lo:hi + 1] - o[lo]), idf)


def _bounds(model: Centroids, held: dict[str, list[str]], quantile: float, margin: float, foreign: float) -> np.ndarray:
    """For each language and length, ``margin`` times the ``quantile`` of the
    cosines of held-back pieces that are nearest to it, but not more than the
    ``foreign`` quantile of what pieces reach with their second language (with
    one language, half): a nearer text may be an odd one of a learned language.
    Where fewer than 20 pieces are nearest to a language, those of all count; a
    length that no held-back text has takes the bound of the next shorter one."""
    bound = np.zeros((len(model.names), len(LENGTHS)))
    for j, length in enumerate(LENGTHS.tolist()):
        found = [model.best(v) for x in held.values() for v in _text_vectors(_pieces(x, length), model.idf)]
        if not found:
            bound[:, j] = bound[:, max(j - 1, 0)]
            continue
        best = np.concatenate(found)
        cosine, top = best.max(axis=1), best.argmax(axis=1)
        most = np.quantile(np.sort(best, axis=1)[:, -2], foreign) if len(model.names) > 1 else 0.5 * np.quantile(cosine, quantile)
        for i in range(len(model.names)):
            own = cosine[top == i]
            bound[i, j] = min(margin * np.quantile(own if len(own) >= 20 else cosine, quantile), most)
    return bound


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows (the rows come in hash order)."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit_centroids(labelled: DataFrame, per_lang: int = 300, clusters: int = 4,
                  quantile: float = 0.01, margin: float = 0.9, foreign: float = 0.1) -> Centroids:
    """``labelled`` (id long, text, lang): document frequencies come from all of
    its rows, the clustered centroids from about ``per_lang`` rows a language
    (the documented bound; drawn by a hash of id), at most ``max_langs``
    languages, the most frequent ones. Half as many more are held back from
    the centroids (a third of them where a language has fewer rows): pieces of
    these of several lengths give each language's bounds (``_bounds``). A language with a text or two learns its bounds from
    those. Null langs and texts without a letter teach nothing. With no
    labelled rows there are no centroids."""
    labelled = labelled.select("id", "text", "lang").filter("lang is not null and text is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            b, o = K.utf8(batch["text"])
            for lo, hi in K.chunks(o, 1 << 20, ROWS):
                df += (_grams(b[o[lo]:o[hi]], o[lo:hi + 1] - o[lo]) > 0).sum(axis=0)
                rows += hi - lo
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMS), pa.int32()), pa.array(np.concatenate([[rows], df]))], ["gram", "n"])

    found = labelled.select("text").mapInArrow(K.tidy(frequencies), "gram int, n long").groupBy("gram").agg(F.sum("n")).collect()
    df = np.zeros(DIMS + 1)
    for gram, n in found:
        df[gram + 1] = n
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1
    rates = labelled.groupBy(F.col("lang").alias("of")).agg(F.least(F.lit(1.0), F.lit(1.5 * per_lang) / F.count("*")).alias("rate"))
    draw = F.pmod(F.xxhash64("id", F.lit(8)), F.lit(1 << 30)) / float(1 << 30)
    drawn = labelled.join(small_or_shuffled(materialise(rates, "rates")), F.col("lang") == F.col("of")).filter(draw < F.col("rate"))
    by_lang: dict[str, list] = {}
    for r in drawn.select("lang", "text", draw.alias("draw")).collect():
        by_lang.setdefault(r.lang, []).append(r)
    langs, centres, held = [], [], {}
    for lang, sample in sorted(by_lang.items()):
        texts = [r.text for r in sorted(sample, key=lambda r: (r.draw, r.text)) if has_letter(r.text)]
        if not texts:
            continue
        x = np.concatenate(list(_text_vectors([t for i, t in enumerate(texts) if i % 3 != 2], idf.astype(np.float32))))
        c = _kmeans(x, clusters)
        langs += [lang] * len(c)
        centres.append(c)
        held[lang] = texts[2::3] or texts
    centre = np.concatenate(centres).astype(np.float32) if centres else np.zeros((0, DIMS), np.float32)
    model = Centroids(langs, centre, idf.astype(np.float32), sorted(held), np.zeros((len(held), len(LENGTHS))))
    if held:
        model.bound = _bounds(model, held, quantile, margin, foreign)
    return model


def identify(docs: DataFrame, model: Centroids, sharpness: float = 30.0) -> DataFrame:
    """``docs``' columns plus lang_pred (the nearest centroid's language; `und`
    for a text that is null or has no letter), score (0 to 1: softmax over
    the languages' best cosines; 0 for `und`), cosine, and rejected: no
    letter, or farther from every centroid than the bound of lang_pred for a
    text of its length. Columns of these names are overwritten."""
    own = ["lang_pred", "score", "cosine", "rejected"]
    docs = docs.drop(*own)
    schema = docs.select("*").schema.add("lang_pred", "string").add("score", "double").add("cosine", "double").add("rejected", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, o = K.utf8(batch["text"])
            for lo, hi in K.chunks(o, 1 << 20, ROWS):
                part = batch.slice(lo, hi - lo)
                letters = np.zeros(hi - lo, bool)
                c = b[o[lo]:o[hi]]
                if len(c):
                    ascii_letters = np.concatenate([[0], np.cumsum(((c | 32) >= 97) & ((c | 32) <= 122))])
                    letters = np.diff(ascii_letters[o[lo:hi + 1] - o[lo]]) > 0
                for i in np.flatnonzero(~letters):
                    letters[i] = has_letter(part["text"][int(i)].as_py())
                if model.names:
                    best = model.best(_vectors(_grams(c, o[lo:hi + 1] - o[lo]), model.idf))
                    top = best.argmax(axis=1)
                    cosine = best.max(axis=1).astype(float)
                    score = 1 / np.exp(sharpness * (best - best.max(axis=1, keepdims=True))).sum(axis=1)
                    pred = np.array(model.names, object)[top]
                    far = cosine < model.least(top, np.diff(o[lo:hi + 1]))
                else:
                    cosine, score, pred = np.zeros(hi - lo), np.zeros(hi - lo), np.full(hi - lo, UNKNOWN, object)
                    far = np.zeros(hi - lo, bool)
                pred = np.where(letters, pred, UNKNOWN)
                score = np.where(letters, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(pred.tolist(), pa.string()), pa.array(score.astype(float)), pa.array(cosine),
                     pa.array(~letters | far)], [*part.schema.names, *own])

    return docs.mapInArrow(K.tidy(run), schema)
