"""Quality classifier: Naive Bayes support vectors (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

#: Hashed n-grams: character shapes, then binned frequencies, then words.
SHAPES, BINS, LEXICAL = 7680, 512, 8192
DIMS = SHAPES + BINS + LEXICAL

# shape classes: 1 lower case (and bytes of other letters), 2 upper case, 3 digit, 4 space, 5 line end, and one per other ASCII sign
_SHAPE = np.ones(256, np.uint32)
_SHAPE[:128] = np.arange(128) + 128
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58] = 1, 2, 3
_SHAPE[[32, 9, 11, 12, 13]] = 4
_SHAPE[10] = 5


def _halvings(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """0 for a share over 1/2, 1 over 1/4 and so on to 14; 15 for none."""
    with np.errstate(divide="ignore"):
        return np.where(part > 0, np.floor(-np.log2(part / np.maximum(whole, 1))).clip(0, 14), 15).astype(np.int64)


def indicators(b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, DIMS) bool, which n-grams a whole text has: hashed character
    shape n-grams (1 to 4), hashed lower-cased words, and binned frequencies
    (by halvings) of shape 1-grams, of words equal to the word 1 to 4 before,
    and of the number of words. A row without bytes has none."""
    rows, n = len(offsets) - 1, len(b)
    out = np.zeros((rows, DIMS), bool)
    if not n:
        return out
    size = np.diff(offsets)
    some = np.flatnonzero(size)
    row = np.repeat(np.arange(rows), size)
    x = _SHAPE[b]
    code = x
    for k in range(1, 5):
        if k > 1:
            code = code[:-1] * np.uint32(0x01000193) + x[k - 1:]
        same = row[:n - k + 1] == row[k - 1:]
        h = (code + np.uint32(k)) * np.uint32(0x9E3779B1)
        out[row[:n - k + 1][same], (h[same] >> np.uint32(8)) % np.uint32(SHAPES)] = True
    at = SHAPES
    for kind in (x == 2, x == 3, x >= 128, x == 5):
        got = np.bincount(row[kind], minlength=rows)
        out[some, at + _halvings(got, size)[some]] = True
        at += 16
    lower = np.where((b >= 65) & (b <= 90), b | 32, b).astype(np.uint8)
    s, e, wo = K.words(lower, offsets)
    if len(s):
        wh, count = K.span_hash(K.prefix_hash(lower), s, e), np.diff(wo)
        wrow = np.repeat(np.arange(rows), count)
        out[wrow, SHAPES + BINS + (wh >> np.uint64(51)).astype(np.int64)] = True
        for k in range(1, 5):
            equal = (wh[k:] == wh[:-k]) & (wrow[k:] == wrow[:-k])
            got = np.bincount(wrow[k:][equal], minlength=rows)
            out[some, at + _halvings(got, count)[some]] = True
            at += 16
        out[some, at + np.log2(np.maximum(count, 1)).astype(np.int64).clip(0, 15)[some]] = True
    return out


def batch_indicators(column) -> Iterator[np.ndarray]:
    b, o = K.utf8(column)
    for lo, hi in K.chunks(o, 1 << 20, 256):
        yield indicators(b[o[lo]:o[hi]], o[lo:hi + 1] - o[lo])


@dataclass
class QualityModel:
    weight: np.ndarray   # (DIMS,) of raw indicators: log-count ratio times SVM weight
    square: np.ndarray   # (DIMS,) squared ratios: rows are scaled to unit length
    bias: float
    slope: float         # of the logistic that turns margins into 0 to 1
    offset: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        both = x.astype(np.float32) @ np.stack([self.weight, self.square], axis=1)
        return (both[:, 0].astype(float) + self.bias) / np.sqrt(both[:, 1].astype(float) + 1.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.margin(x) + self.offset).clip(-60, 60)))


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dims: int, c: np.ndarray, rounds: int = 30, seed: int = 3, tol: float = 1e-3) -> np.ndarray:
    """Linear hinge-loss SVM with an L2 penalty, one dual variable at a time
    (0 <= a_i <= c_i); rows are (columns, values). The last dim is the bias."""
    w, a = np.zeros(dims), np.zeros(len(rows))
    norm = np.array([float(v @ v) for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            cols, v = rows[i]
            if norm[i] == 0:
                continue
            g = y[i] * float(w[cols] @ v) - 1
            pg = min(g, 0.0) if a[i] <= 0 else max(g, 0.0) if a[i] >= c[i] else g
            worst = max(worst, abs(pg))
            if pg:
                old = a[i]
                a[i] = min(max(old - g / norm[i], 0.0), c[i])
                w[cols] += (a[i] - old) * y[i] * v
        if worst < tol:
            break
    return w


def _logistic(margin: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of P(y = 1 | margin), by Newton steps on targets drawn in from 0 and 1."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    s, o = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(s * margin + o).clip(-60, 60)))
        r, w = p - t, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(r * margin).sum(), r.sum()])
        h = np.array([[(w * margin * margin).sum() + 1e-6, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-6]])
        d = np.linalg.solve(h, g)
        s, o = s - d[0], o - d[1]
        if np.abs(d).max() < 1e-8:
            break
    return max(float(s), 1e-3), float(o)


def fit_quality(texts: list[str], labels: list[int], penalty: float = 10.0, blend: float = 0.25) -> QualityModel:
    """NBSVM on a bounded list of texts with labels 0 or 1. Four of five rows
    give ratios and weights, the others the logistic. Rows of ratio-scaled
    indicators have unit length and classes equal total penalty; the SVM's
    weights are blended with their mean magnitude (``blend`` is the SVM's
    share). With one class only every score is 0.98 or 0.02, with no rows 0.5."""
    y = np.where(np.asarray(labels, int) > 0, 1, -1)
    zero = np.zeros(DIMS, np.float32)
    if len(y) == 0 or abs(int(y.sum())) == len(y):
        return QualityModel(zero, zero, 0.0, 1.0, 4.0 * y[0] if len(y) else 0.0)
    found = [np.flatnonzero(r) for x in batch_indicators(pa.array(texts, pa.large_string())) for r in x]
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held[:] = False
    train = np.flatnonzero(~held)
    p, q = np.ones(DIMS), np.ones(DIMS)
    for i in train:
        (p if y[i] > 0 else q)[found[i]] += 1
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    rows = []
    for cols in found:
        v = np.append(ratio[cols], 1.0)
        rows.append((np.append(cols, DIMS), v / np.linalg.norm(v)))
    limit = penalty * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y <= 0).sum()))
    w = dual_coordinate_descent([rows[i] for i in train], y[train], DIMS + 1, limit[train])
    own = (1 - blend) * np.abs(w[:-1]).mean() + blend * w[:-1]
    model = QualityModel((own * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), blend * float(w[-1]), 1.0, 0.0)
    some = np.flatnonzero(held) if held.any() else train
    margin = np.array([(model.weight[found[i]].sum(dtype=float) + model.bias) / np.sqrt(model.square[found[i]].sum(dtype=float) + 1) for i in some])
    model.slope, model.offset = _logistic(margin, y[some])
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = 2500) -> DataFrame:
    """Texts and labels of at most ``per_class`` labelled ids of either class,
    and as many rows in all (the documented bound of the fit), drawn by a hash of doc_id. Null ids,
    labels and texts teach nothing; an id with several labels teaches each."""
    known = labels.filter("doc_id is not null and quality in (0, 1)").select("doc_id", "quality")
    draw = F.xxhash64("doc_id", F.lit(1))
    picked = [known.filter(F.col("quality") == q).orderBy(draw, "doc_id").limit(per_class) for q in (0, 1)]
    picked = picked[0].unionByName(picked[1]).distinct()
    return docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(picked), "doc_id").select("doc_id", "text", "quality").orderBy(draw, "doc_id").limit(2 * per_class)


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """``docs``' columns plus score (0 to 1, higher: good likelier) and
    predicted (1 from ``threshold`` on). Null text is empty, and an empty text
    gets the score of no n-grams. Columns of these names are overwritten."""
    docs = docs.drop("score", "predicted")
    schema = docs.select("*").schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = np.concatenate([model.score(x) for x in batch_indicators(batch["text"])])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                                 [*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(K.tidy(run), schema)


def train_quality(docs: DataFrame, labels: DataFrame, per_class: int = 2500, **options) -> QualityModel:
    rows = labelled_sample(docs, labels, per_class).collect()
    rows.sort(key=lambda r: (hash_order(r.doc_id), r.text, r.quality))
    return fit_quality([r.text for r in rows], [r.quality for r in rows], **options)


def hash_order(doc_id: int) -> int:
    """A fixed shuffle of ids, so that held-out rows are spread over the sample."""
    return doc_id * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
