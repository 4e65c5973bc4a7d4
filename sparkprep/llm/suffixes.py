"""Removal of repeated byte strings by a sparse, range-partitioned suffix array (operator 6).

A byte goes if a ``window``-byte string over it also starts earlier (smaller
doc_id, or same document and an earlier start). Sorting every suffix would
ship many times the input, so suffixes are sampled by content: in each window
the leading ``gram`` bytes with the smallest hash (leftmost for ties) are an
anchor. Equal windows have equal anchors at equal places, so only suffixes at
anchors, with their surroundings of less than a window on either side, have
to meet:

1. anchors are dealt to ranges of their hashed leading bytes. The hash is
   uniform, so even splitters are the sampled quantiles; what a batch holds
   several times is settled there and one record is sent;
2. a range sorts its suffixes (leading bytes, surroundings, place) and marks
   those whose whole surroundings occurred earlier;
3. suffixes whose leading bytes are shared but whose surroundings differ (the
   edges of repeated passages) fetch their bytes and are compared window by
   window, across what was a boundary before. Of leading bytes with very many
   surroundings (a common line) the hashes of the windows go out instead,
   each to its own range, so that such a group is spread over all tasks.

Hashes have 64 bits; (2) compares 128 bits in all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .store import partitions

_LOW = -(1 << 63)
#: Surroundings of an anchor's leading bytes above which they aren't compared in one place.
HOT = 5_000
#: A window that starts at ``place``.
HASHED = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("place", "<u8")])
ANCHOR = np.dtype([("key", "<u8"), ("around", "<u8"), ("doc", "<i8"), ("place", "<u8"), ("left", "u1"), ("right", "u1")])
#: kind 0: bytes start .. end go; kind 1: an anchor at start whose surroundings are asked for; kind 2: one whose windows' hashes are
MARK = np.dtype([("doc", "<i8"), ("kind", "u1"), ("tie", "<u4"), ("start", "<u4"), ("end", "<u4"), ("key", "<u8")])


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Sorting permutation by several word columns: the first is sorted, and
    only runs that tie go on to the next ones (multikey quicksort by words)."""
    order = np.argsort(columns[0], kind="stable")
    if len(columns) == 1 or not len(order):
        return order
    first = columns[0][order]
    tied = np.zeros(len(order), bool)
    equal = first[1:] == first[:-1]
    tied[1:] |= equal
    tied[:-1] |= equal
    at = np.flatnonzero(tied)
    if len(at):
        run = np.cumsum(np.concatenate([[True], ~equal]))[at]
        own = order[at]
        deeper = multikey_order([c[own] for c in columns[1:]])
        order[at] = own[deeper[np.argsort(run[deeper], kind="stable")]]
    return order


def merge_spans(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of half-open spans within each group (ints below 2^31), sorted."""
    if not len(start):
        return group, start, end
    base = group.astype(np.int64) << 32
    s, e = base + start, base + end
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(s) - 1]])
    s, e = s[new], e[last]
    g = s >> 32
    return g, s - (g << 32), e - (g << 32)


def find_anchors(b: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``b``, rows, leading hashes, and how much text (less than a
    window that still holds the anchor) is left and right of them in their row."""
    n = len(b)
    size = np.diff(offsets)
    none = np.zeros(0, np.int64)
    if n < window or size.max(initial=0) < window:
        return none, none, none.astype(np.uint64), none, none
    c = K.prefix_hash(b)
    _, inv = K.powers(n + 1)
    with np.errstate(over="ignore"):
        h = K.mix((c[gram:] - c[:-gram]) * inv[:n - gram + 1])
    low = (h >> K.U64(32) << K.U64(32)) | np.arange(len(h), dtype=np.uint64)
    span, have = window - gram + 1, 1
    while have < span:  # minimum of ``span`` following values, by doubling
        step = min(have, span - have)
        low = np.minimum(low[:len(low) - step], low[step:])
        have += step
    ends = np.repeat(offsets[1:], size)
    ok = ends[:len(low)] - np.arange(len(low)) >= window
    at = (low[ok] & K.U64(0xFFFFFFFF)).astype(np.int64)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at
    row = np.searchsorted(offsets, at, "right") - 1
    left = np.minimum(at - offsets[row], window - gram)
    right = np.minimum(offsets[row + 1] - at, window)
    # anchors have small hashes, being minima: mixed once more, they are uniform again
    return at, row, K.mix(h[at] ^ K.U64(0x2545F4914F6CDD1D)), left, right


def _blobs(part: np.ndarray, records: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Records of each part, in one binary value a part."""
    order = np.argsort(part, kind="stable")
    part, records = part[order], records[order]
    cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]) if len(part) else np.zeros(1, int)
    return [int(part[i]) for i in cut[:-1]], [records[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])]


def _part_of(x: np.ndarray, parts: int) -> np.ndarray:
    """Even ranges of a uniform 64-bit hash."""
    return ((x >> K.U64(40)) * K.U64(parts) >> K.U64(24)).astype(np.int64)


def _marks(doc, kind, tie, start, end, key=0) -> np.ndarray:
    out = np.zeros(len(start), MARK)
    out["doc"], out["kind"], out["tie"], out["start"], out["end"], out["key"] = doc, kind, tie, start, end, key
    return out


def _mark_blobs(marks: np.ndarray, parts: int) -> tuple[list[int], list[bytes]]:
    """Marks by the part of their document: few large values instead of many small rows."""
    return _blobs(_part_of(K.mix(marks["doc"].astype(np.uint64)), parts), marks)


def _mark_batch(marks: np.ndarray, parts: int) -> pa.RecordBatch:
    part, blobs = _mark_blobs(marks, parts)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(blobs, pa.binary())], ["part", "data"])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All marks of a part (sorted by part) -> one row a document, its spans merged."""
    part, held = None, []

    def close() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        m = np.concatenate(held)
        m = m[multikey_order([m["doc"], m["tie"]])]
        unit = np.cumsum(np.concatenate([[False], (m["doc"][1:] != m["doc"][:-1]) | (m["tie"][1:] != m["tie"][:-1])]))
        first = np.concatenate([[0], np.flatnonzero(np.diff(unit)) + 1])
        done = m["kind"] == 0
        g, s, e = merge_spans(unit[done], m["start"][done].astype(np.int64), m["end"][done].astype(np.int64))
        m = np.concatenate([_marks(m["doc"][first[g]], 0, m["tie"][first[g]], s, e), m[~done]])
        m = m[np.argsort(m["doc"], kind="stable")]
        cut = np.concatenate([[0], np.flatnonzero(np.diff(m["doc"])) + 1, [len(m)]])
        yield pa.RecordBatch.from_arrays([pa.array(m["doc"][cut[:-1]]), pa.array([m[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary())], ["k", "marks"])

    for batch in batches:
        for p, data in zip(batch["part"].to_pylist(), batch["data"]):
            if p != part:
                yield from close()
                part, held = p, []
            held.append(np.frombuffer(data.as_buffer(), MARK))
    yield from close()


class _Ties:
    """Numbers rows of equal id, which come one after the other, from 0."""

    def __init__(self):
        self.last, self.count = None, 0

    def of(self, ids: np.ndarray) -> np.ndarray:
        if not len(ids):
            return np.zeros(0, np.int64)
        new = np.concatenate([[self.last is None or ids[0] != self.last], ids[1:] != ids[:-1]])
        at = np.flatnonzero(new)
        run = np.arange(len(ids)) - np.repeat(np.concatenate([[0], at]) if not new[0] else at, np.diff(np.concatenate([[0] if not new[0] else [], at, [len(ids)]])).astype(int))
        if not new[0]:
            first = at[0] if len(at) else len(ids)
            run[:first] = np.arange(first) + self.count
        self.last, self.count = ids[-1], int(run[-1]) + 1
        return run


def _send_anchors(window: int, gram: int, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ties = _Ties()
        for batch in batches:
            ids = batch["k"].to_numpy(zero_copy_only=False).astype(np.int64)
            tie = ties.of(ids)
            b, o = K.utf8(batch["text"])
            for lo, hi in K.chunks(o, 1 << 20):
                text, off = b[o[lo]:o[hi]], o[lo:hi + 1] - o[lo]
                at, row, key, left, right = find_anchors(text, off, window, gram)
                if not len(at):
                    continue
                around = K.span_hash(K.prefix_hash(text), at - left, at + right) ^ K.mix(left.astype(np.uint64) + K.U64(1))
                doc, pos = ids[lo + row], at - off[row]
                place = tie[lo + row].astype(np.uint64) << K.U64(32) | pos.astype(np.uint64)
                order = multikey_order([key, around, doc, place])
                first = np.ones(len(order), bool)
                first[1:] = (key[order][1:] != key[order][:-1]) | (around[order][1:] != around[order][:-1])
                # what this batch has earlier itself
                again = order[~first]
                g, s, e = merge_spans(row[again], pos[again] - left[again], pos[again] + right[again])
                sent = order[first]
                records = np.zeros(len(sent), ANCHOR)
                for name, x in (("key", key), ("around", around), ("doc", doc), ("place", place), ("left", left), ("right", right)):
                    records[name] = x[sent]
                parts, blobs = _blobs(_part_of(records["key"], ranges), records)
                parts2, blobs2 = _mark_blobs(_marks(ids[lo + g], 0, tie[lo + g], s, e), ranges)
                yield pa.RecordBatch.from_arrays([
                    pa.array(parts + parts2, pa.int64()), pa.array([False] * len(parts) + [True] * len(parts2)),
                    pa.array(blobs + blobs2, pa.binary())], ["part", "settled", "data"])

    return run


def _sort_range(records: np.ndarray, hot: int) -> np.ndarray:
    """Marks from all anchors of a range."""
    order = multikey_order([records["key"], records["around"], records["doc"], records["place"]])
    r = records[order]
    new_key = np.concatenate([[True], r["key"][1:] != r["key"][:-1]])
    new = new_key | np.concatenate([[True], r["around"][1:] != r["around"][:-1]])
    pos, tie = (r["place"] & K.U64(0xFFFFFFFF)).astype(np.int64), (r["place"] >> K.U64(32)).astype(np.int64)
    again = np.flatnonzero(~new)
    done = _marks(r["doc"][again], 0, tie[again], pos[again] - r["left"][again], pos[again] + r["right"][again])
    run = np.cumsum(new_key) - 1
    classes = np.bincount(run, weights=new)
    asked = np.flatnonzero(new & (classes[run] > 1))
    return np.concatenate([done, _marks(r["doc"][asked], np.where(classes[run[asked]] > hot, 2, 1), tie[asked], pos[asked], 0, r["key"][asked])])


def _settle_ranges(ranges: int, hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for p, settled, data in zip(batch["part"].to_pylist(), batch["settled"].to_pylist(), batch["data"]):
                if settled:
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([data.as_py()], pa.binary())], ["part", "data"])
                    continue
                if p != part and held:
                    yield _mark_batch(_sort_range(np.concatenate(held), hot), ranges)
                    held = []
                part = p
                held.append(np.frombuffer(data.as_buffer(), ANCHOR))
        if held:
            yield _mark_batch(_sort_range(np.concatenate(held), hot), ranges)

    return run


def _send_surroundings(window: int, gram: int, ranges: int):
    side = window - gram
    kind = _surrounded(window, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ties = _Ties()
        for batch in batches:
            ids = batch["k"].to_numpy(zero_copy_only=False).astype(np.int64)
            tie = ties.of(ids)
            b, o = K.utf8(batch["text"])
            rows, places, keys, hots = [], [], [], []
            for i, blob in enumerate(batch["marks"]):
                if blob.is_valid:
                    m = np.frombuffer(blob.as_buffer(), MARK)
                    m = m[(m["kind"] > 0) & (m["tie"] == tie[i])]
                    if len(m):
                        rows.append(np.full(len(m), i))
                        places.append(m["start"].astype(np.int64))
                        keys.append(m["key"])
                        hots.append(m["kind"] == 2)
            if not rows:
                continue
            row, pos, key, hot = np.concatenate(rows), np.concatenate(places), np.concatenate(keys), np.concatenate(hots)
            for i in range(0, len(row), 10_000):
                r, p = row[i:i + 10_000], pos[i:i + 10_000]
                out = np.zeros(len(r), kind)
                out["key"], out["doc"] = key[i:i + 10_000], ids[r]
                out["place"] = tie[r].astype(np.uint64) << K.U64(32) | p.astype(np.uint64)
                out["left"], out["right"] = np.minimum(p, side), np.minimum(o[r + 1] - o[r] - p, window)
                at = (o[r] + p - side)[:, None] + np.arange(side + window)
                inside = (np.arange(side + window) >= side - out["left"][:, None].astype(int)) & (np.arange(side + window) < side + out["right"][:, None].astype(int))
                out["bytes"] = np.where(inside, b[at.clip(0, max(len(b) - 1, 0))], 0)
                spread = hot[i:i + 10_000]
                sent = [(1, *_blobs(_part_of(out["key"][~spread], ranges), out[~spread]))]
                for j in range(0, int(spread.sum()), 2_500):
                    hashed, marks = _first_windows(out[spread][j:j + 2_500], window, gram)
                    sent += [(2, *_blobs(_part_of(hashed["hash"], ranges), hashed)), (0, *_mark_blobs(marks, ranges))]
                for what, parts, blobs in sent:
                    if parts:
                        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array([what] * len(parts), pa.int32()), pa.array(blobs, pa.binary())],
                                                         ["part", "what", "data"])

    return run


def _surrounded(window: int, gram: int) -> np.dtype:
    return np.dtype([("key", "<u8"), ("doc", "<i8"), ("place", "<u8"), ("left", "u1"), ("right", "u1"), ("bytes", "u1", (2 * window - gram,))])


def window_hashes(r: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Records -> for each window over their anchors: the record, how many bytes
    before the anchor it starts, and a hash of both this and the window."""
    side = window - gram
    shifts = np.arange(side + 1)
    step = K.BYTE_VALUE[r["bytes"]] * K.powers(side + window)[0]
    with np.errstate(over="ignore"):
        c = np.concatenate([np.zeros((len(r), 1), np.uint64), np.cumsum(step, axis=1)], axis=1)
        begin = side - shifts
        h = (c[:, begin + window] - c[:, begin]) * K.powers(side + window)[1][begin]
        h = K.mix(h + r["key"][:, None] + shifts.astype(np.uint64) * K.U64(0xD1342543DE82EF95))
    fits = (shifts <= r["left"][:, None]) & (window - shifts <= r["right"][:, None])
    row, shift = np.nonzero(fits)
    return row, shift, h[row, shift]


def compare_windows(r: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Records (of whole keys, sorted by key, then place) -> marks of the
    windows over the anchors that occur at an earlier record."""
    row, shift, h = window_hashes(r, window, gram)
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    again = first[inverse] != np.arange(len(row))
    row, shift = row[again], shift[again]
    pos = (r["place"][row] & K.U64(0xFFFFFFFF)).astype(np.int64)
    g, s, e = merge_spans(row, pos - shift, pos - shift + window)
    return _marks(r["doc"][g], 0, (r["place"][g] >> K.U64(32)).astype(np.int64), s, e)


def _earlier(w: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows -> the earliest of each hash, and marks of the others."""
    w = w[multikey_order([w["hash"], w["doc"], w["place"]])]
    first = np.concatenate([[True], w["hash"][1:] != w["hash"][:-1]]) if len(w) else np.zeros(0, bool)
    again = w[~first]
    again = again[multikey_order([again["doc"], again["place"]])]
    tie, start = (again["place"] >> K.U64(32)).astype(np.int64), (again["place"] & K.U64(0xFFFFFFFF)).astype(np.int64)
    unit = np.cumsum(np.concatenate([[False], (again["doc"][1:] != again["doc"][:-1]) | (tie[1:] != tie[:-1])])) if len(again) else start
    at = np.concatenate([[0], np.flatnonzero(np.diff(unit)) + 1])
    g, s, e = merge_spans(unit, start, start + window)
    return w[first], _marks(again["doc"][at[g]], 0, tie[at[g]], s, e)


def _first_windows(r: np.ndarray, window: int, gram: int, rows: int = 1_000) -> tuple[np.ndarray, np.ndarray]:
    """``_earlier`` of all windows over the anchors of records."""
    found = []
    for i in range(0, len(r), rows):
        own = r[i:i + rows]
        row, shift, h = window_hashes(own, window, gram)
        w = np.zeros(len(row), HASHED)
        w["hash"], w["doc"], w["place"] = h, own["doc"][row], own["place"][row] - shift.astype(np.uint64)
        found.append(w)
    return _earlier(np.concatenate(found), window)


def _compare_ranges(window: int, gram: int, ranges: int, rows: int = 5_000):
    kind = _surrounded(window, gram)

    def close(held: list[np.ndarray], hashed: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        slices = sum(map(len, hashed)) // 250_000 + 1
        for i in range(slices if hashed else 0):  # equal hashes fall in one slice
            yield _mark_batch(_earlier(np.concatenate([w[w["hash"] % K.U64(slices) == i] for w in hashed]), window)[1], ranges)
        if not held:
            return
        r = np.concatenate(held)
        r = r[multikey_order([r["key"], r["doc"], r["place"]])]
        cuts = np.concatenate([[0], np.flatnonzero(r["key"][1:] != r["key"][:-1]) + 1, [len(r)]])
        lo = 0
        while lo < len(cuts) - 1:  # whole keys, about ``rows`` records at a time
            hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + rows, "right")) - 1)
            yield _mark_batch(compare_windows(r[cuts[lo]:cuts[hi]], window, gram), ranges)
            lo = hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, hashed = None, [], []
        for batch in batches:
            for p, what, data in zip(batch["part"].to_pylist(), batch["what"].to_pylist(), batch["data"]):
                if what == 0:
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([data.as_py()], pa.binary())], ["part", "data"])
                    continue
                if p != part:
                    yield from close(held, hashed)
                    part, held, hashed = p, [], []
                if what == 1:
                    held.append(np.frombuffer(data.as_buffer(), kind))
                else:
                    hashed.append(np.frombuffer(data.as_buffer(), HASHED))
        yield from close(held, hashed)

    return run


def _cut(names: list[str], keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ties = _Ties()
        for batch in batches:
            tie = ties.of(batch["k"].to_numpy(zero_copy_only=False).astype(np.int64))
            size, removed, spans, digest, kept_text = [], [], [], [], []
            for i, (text, m1, m2) in enumerate(zip(batch["text"], batch["marks"], batch["more"])):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                start = end = ()
                if m1.is_valid or m2.is_valid:
                    m = np.concatenate([np.frombuffer(x.as_buffer(), MARK) for x in (m1, m2) if x.is_valid])
                    m = m[(m["kind"] == 0) & (m["tie"] == tie[i])]
                    _, start, end = merge_spans(np.zeros(len(m), np.int64), m["start"].astype(np.int64), m["end"].astype(np.int64))
                kept, at = [], 0
                for s, e in zip(start, end):
                    kept.append(raw[at:s])
                    at = e
                kept = b"".join([*kept, raw[at:]])
                size.append(len(raw))
                removed.append(len(raw) - len(kept))
                spans.append(len(start))
                digest.append(hashlib.sha256(kept).hexdigest())
                kept_text.append(kept.decode("utf-8", "ignore") if text.is_valid else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())]
                + ([pa.array(kept_text, pa.string())] if keep_text else []),
                [*names, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * keep_text)

    return run


def remove_repeats(docs: DataFrame, window: int = 100, gram: int = 20, keep_text: bool = False, hot: int = HOT) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, ...) without its text, plus n_bytes,
    n_removed, n_spans (maximal removed runs), kept_sha256 and, with
    ``keep_text``, kept_text (code points that a cut leaves incomplete go; a
    null text stays null). Columns of these names are overwritten.

    Null text is empty; a null doc_id comes before all others; rows of equal
    id are ordered by text. Texts shorter than ``window`` bytes lose nothing.
    Texts are shuffled once (by doc_id) and that exchange is read three times:
    for anchors, for the surroundings asked for, and for the result. Leading
    bytes with more than ``hot`` surroundings are compared by window hashes,
    which go to all tasks."""
    own = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    names = [c for c in docs.columns if c not in [*own, "text"]]
    if {"k", "marks", "more"} & set(names):  # names of the work below
        packed = docs.select("doc_id", "text", F.struct(*names).alias("rest"))
        cut = remove_repeats(packed, window, gram, keep_text, hot)
        return cut.select("rest.*", *own[:5 if keep_text else 4])
    spark = docs.sparkSession
    p = partitions(spark)
    dealt = docs.select(*names, F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW)).alias("k"), "text").repartition(p, "k")
    # all columns go along, so that the exchange of ``dealt`` is the same one in all three places
    sent = dealt.sortWithinPartitions("k", "text").mapInArrow(K.tidy(_send_anchors(window, gram, p)), "part long, settled boolean, data binary")
    gathered = lambda blobs: blobs.repartition(p, "part").sortWithinPartitions("part").mapInArrow(K.tidy(_gather), "k long, marks binary")
    marks = gathered(sent.repartition(p, "part").sortWithinPartitions("part").mapInArrow(K.tidy(_settle_ranges(p, hot)), "part long, data binary"))
    joined = dealt.join(marks, "k", "left")
    surroundings = joined.sortWithinPartitions("k", "text").mapInArrow(K.tidy(_send_surroundings(window, gram, p)), "part long, what int, data binary")
    more = gathered(surroundings.repartition(p, "part").sortWithinPartitions("part").mapInArrow(K.tidy(_compare_ranges(window, gram, p)), "part long, data binary")
                    ).withColumnRenamed("marks", "more")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema.fields)
    out = f"{kinds}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * keep_text
    return joined.join(more, "k", "left").sortWithinPartitions("k", "text").mapInArrow(K.tidy(_cut(names, keep_text)), out)
