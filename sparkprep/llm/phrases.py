"""Phrase collocations by SETM (operator 12): written occurrence relations in
order of piece and position, merge-joined with themselves one position on,
counted by group, and cut down to frequent groups before the next length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .kernels import U64, WORD_MULT, chunks, mix, utf8
from .store import materialise
from .vocabulary import word_hashes, word_ids

#: Bytes between words, and bytes between pieces.
IS_GAP, IS_STOP = np.zeros(256, bool), np.zeros(256, bool)
IS_GAP[[0x20, 0x09]] = True
IS_STOP[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_COUNT = "lang string, phrase string, n long"
#: A row of a relation, a block of texts: its languages with the word occurrences of each, its words joined by
#: spaces and the language of each, and the occurrences in order of piece and position: the word, whether the next
#: occurrence follows it in the piece (bits), and the group of the phrase that starts here (0: none; of words: empty).
_BLOCK = "langs array<string>, sizes array<long>, words string, lang_of binary, run binary, link binary, grp binary"
_NAMES = ["langs", "sizes", "words", "lang_of", "run", "link", "grp"]
_LANG_MULT = U64(0x9E6C63D0876A9A47)
_HASH_BITS = 48


def _occurrences(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends and rows of the words, and whether each is followed by another word of its piece."""
    n = len(b)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, bool)
    apart = IS_GAP[b] | IS_STOP[b]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start, end = ~apart, ~apart
    start[1:] &= apart[:-1] | first[1:-1]
    end[:-1] &= apart[1:] | first[1:-1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    row = np.searchsorted(offsets, s, "right") - 1
    stops = np.cumsum(IS_STOP[b], dtype=np.int32)
    link = np.append((stops[s[1:]] == stops[e[:-1] - 1]) & (row[1:] == row[:-1]), False)
    return s, e, row, link


def _phrase_hash(words: list[np.ndarray], lang: np.ndarray) -> np.ndarray:
    """48-bit hash of phrases of one length from their words' hashes (a column a position) and languages'."""
    with np.errstate(over="ignore"):
        total = lang * _LANG_MULT
        for j, w in enumerate(words):
            total = total + w * WORD_MULT[j]
    return mix(total) >> U64(64 - _HASH_BITS)


def _hashes(values: list[str]) -> np.ndarray:
    b, offsets = utf8(pa.array(values, pa.large_string()))
    return word_hashes(b, offsets[:-1], offsets[1:])


class FrequentFilter:
    """Bits that tell which hashes may be of frequent phrases: all of theirs, and few others."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, h: np.ndarray) -> np.ndarray:
        ok = np.ones(len(h), bool)
        for at in _bits(h, len(self.words) * 64):
            ok &= (self.words[at >> 6] >> (at & 63).astype(U64)) & U64(1) != 0
        return ok


def _bits(h: np.ndarray, size: int) -> list[np.ndarray]:
    """Four places of each hash among ``size`` (a power of two) bits."""
    with np.errstate(over="ignore"):
        first, step = mix(h + U64(1)), mix(h + U64(2)) | U64(1)
        return [((first + U64(j) * step) & U64(size - 1)).astype(np.int64) for j in range(4)]


def frequent_filter(hashes: DataFrame, most_bits: int = 1 << 28) -> FrequentFilter:
    """The filter of ``hashes`` (h long; a written table): 16 bits a hash, at
    most ``most_bits`` (32 MB) whatever their number. Tasks turn hashes into
    bits; those of one 64-bit word are joined before the driver gets at most
    ``most_bits`` / 64 words."""
    size = 1 << 10
    while size < min(16 * hashes.count(), most_bits):
        size *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(_bits(batch["h"].to_numpy().view(np.uint64), size)))
            slot, first = np.unique(at >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(U64(1) << (at & 63).astype(U64), first) if len(at) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(bits.view(np.int64))], ["slot", "bits"])

    found = hashes.select("h").mapInArrow(K.tidy(run), "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(size // 64, np.uint64)
    words[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return FrequentFilter(words)


def _narrow(x: np.ndarray) -> bytes:
    """Numbers from 0 as bytes: a first byte tells their width."""
    kind = np.uint16 if x.max(initial=0) < 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()


def _wide(raw: memoryview) -> np.ndarray:
    return np.frombuffer(raw, {2: np.uint16, 4: np.uint32}[raw[0]], offset=1).astype(np.int64) if len(raw) else None


class _Block:
    """A row of a relation."""

    def __init__(self, batch: pa.RecordBatch, r: int):
        get = lambda c: memoryview(batch[c][r].as_buffer())
        self.langs, self.sizes, self.text = batch["langs"][r].as_py(), batch["sizes"][r].as_py(), batch["words"][r].as_py()
        self.words = self.text.split(" ")
        self.lang_of, self.run, grp = _wide(get("lang_of")), _wide(get("run")), _wide(get("grp"))
        self.link = np.unpackbits(np.frombuffer(get("link"), np.uint8), count=len(self.run)).astype(bool)
        self.grp = self.run if grp is None else grp - 1

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The place of an occurrence of each group, and how many it has."""
        place = np.flatnonzero(self.grp >= 0)
        at = np.zeros(int(self.grp.max(initial=-1)) + 1, np.int64)
        at[self.grp[place]] = place
        return at, np.bincount(self.grp[place], minlength=len(at))

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the phrases of ``length`` words at the given places."""
        h = _hashes(self.words)
        return _phrase_hash([h[self.run[at + j]] for j in range(length)], _hashes(self.langs)[self.lang_of[self.run[at]]])

    def only(self, keep: FrequentFilter, length: int) -> None:
        """Semi-join: groups that the filter doesn't know lose their occurrences."""
        at, _ = self.groups()
        known = np.append(keep.has(self.hashes(at, length)), False)  # the last element answers for -1
        self.grp = np.where(known[self.grp], self.grp, -1)

    def extend(self) -> None:
        """Merge-join of the occurrences with those that start one word on:
        groups of phrases one word longer."""
        i = np.flatnonzero((self.grp[:-1] >= 0) & (self.grp[1:] >= 0) & self.link[:-1])
        _, new = np.unique(self.grp[i] * (int(self.grp.max(initial=0)) + 1) + self.grp[i + 1], return_inverse=True)
        self.grp = np.full(len(self.run), -1, np.int64)
        self.grp[i] = new

    def row(self, length: int) -> tuple | None:
        """The block without the words in no occurrence; None if there are no others."""
        i = np.flatnonzero(self.grp >= 0)
        if not len(i):
            return None
        edge = np.zeros(len(self.run) + 1, np.int64)
        edge[i] += 1
        edge[i + length] -= 1
        inside = np.cumsum(edge[:-1]) > 0
        used, run = np.unique(self.run[inside], return_inverse=True)
        grp = self.grp[inside]
        grp[grp >= 0] = np.unique(grp[grp >= 0], return_inverse=True)[1]
        link = (self.link & np.append(inside[1:], False))[inside]
        return self.langs, self.sizes, " ".join([self.words[k] for k in used.tolist()]), self.lang_of[used], run, link, grp


def _relation(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (langs, sizes, text, lang_of, run, link, grp) as a batch."""
    kinds = [pa.list_(pa.string()), pa.list_(pa.int64()), pa.string()] + [pa.binary()] * 4
    packed = [(a, b, c, _narrow(d), _narrow(e), np.packbits(f).tobytes(), b"" if g is None else _narrow(g + 1)) for a, b, c, d, e, f, g in rows]
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in packed], kind) for k, kind in enumerate(kinds)], _NAMES)


def _word_occurrences(docs: DataFrame, limit: int = 1 << 20) -> DataFrame:
    """The relation of all words, in blocks of about ``limit`` bytes of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, offsets = utf8(batch["text"])
            lang = batch["lang"].dictionary_encode()
            code, langs = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64), lang.dictionary.to_pylist()
            for lo, hi in chunks(offsets, limit):
                own = b[offsets[lo]:offsets[hi]]
                own = np.where((own >= 65) & (own <= 90), own | 32, own).astype(np.uint8)
                s, e, row, link = _occurrences(own, offsets[lo:hi + 1] - offsets[lo])
                if not len(s):
                    continue
                ids, _, _ = word_ids(own, s, e)
                mine = code[lo:hi][row]
                # a word of two languages is two symbols
                key, at, symbol = np.unique(ids * len(langs) + mine, return_index=True, return_inverse=True)
                raw = own.tobytes()
                text = " ".join([raw[i:j].decode() for i, j in zip(s[at].tolist(), e[at].tolist())])
                yield _relation([(langs, np.bincount(mine, minlength=len(langs)).tolist(), text, key % len(langs), symbol, link, None)])

    return docs.select("text", "lang").mapInArrow(K.tidy(run), _BLOCK)


def _blocks(batches: Iterator[pa.RecordBatch], length: int, known: FrequentFilter | None) -> Iterator[_Block]:
    """Blocks whose groups are phrases of ``length`` words, from a relation of
    phrases one word shorter (of words: itself) of which ``known`` tells the frequent ones."""
    for batch in batches:
        for r in range(batch.num_rows):
            x = _Block(batch, r)
            if length > 1:
                if known is not None:
                    x.only(known, length - 1)
                x.extend()
            yield x


def _joined(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, back = np.unique(h, return_inverse=True)
    return h, np.bincount(back, weights=n, minlength=len(h)).astype(np.int64)


def _packed(x: np.ndarray, width: int) -> bytes:
    """Numbers byte by byte: all lowest bytes first, so that high ones compress."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpacked(raw: memoryview, width: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def frequent_hashes(relation: DataFrame, length: int, known: FrequentFilter | None, min_count: int, ranges: int, held: int = 1 << 18) -> DataFrame:
    """Group count by hash: (h) of the groups that occur ``min_count`` times or
    more. Tasks add up their blocks' groups, ``held`` of them at a time, and
    send them packed by range of the hash, about 5 bytes each; counts from
    ``min_count`` on are alike. A range's groups meet in one task, which grows
    with neither the input (``ranges`` does) nor a group's size."""
    shift, top = U64(_HASH_BITS - (ranges.bit_length() - 1)), min(min_count, (1 << 16) - 1)

    def send(h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        cut = np.searchsorted(h, np.arange(ranges + 1, dtype=np.uint64) << shift)
        rows = [(k, _packed(np.diff(h[i:j], prepend=U64(0)), 8), _packed(n[i:j], 2)) for k, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if j > i]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["part", "h", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, n, more, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0
        for x in _blocks(batches, length, known):
            at, k = x.groups()
            more.append((x.hashes(at, length), k))
            size += len(at)
            if size > held // 4:
                h, n = _joined(np.concatenate([h, *[a for a, _ in more]]), np.concatenate([n, *[b for _, b in more]]))
                more, size = [], 0
                if len(h) > held:
                    yield send(h, np.minimum(n, top))
                    h, n = h[:0], n[:0]
        h, n = _joined(np.concatenate([h, *[a for a, _ in more]]), np.concatenate([n, *[b for _, b in more]]))
        yield send(h, np.minimum(n, top))

    def add(table: pa.Table) -> pa.Table:
        h, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in table.to_batches():
            own = [np.cumsum(_unpacked(memoryview(x.as_buffer()), 8), dtype=np.uint64) for x in batch["h"]]
            many = [_unpacked(memoryview(x.as_buffer()), 2).astype(np.int64) for x in batch["n"]]
            h, n = _joined(np.concatenate([h, *own]), np.concatenate([n, *many]))
        return pa.table({"h": h[n >= top].view(np.int64)})

    sent = relation.select(*_NAMES).mapInArrow(K.tidy(count), "part int, h binary, n binary")
    return sent.groupBy("part").applyInArrow(add, "h long")


def _semi_joined(relation: DataFrame, length: int, known: FrequentFilter | None, keep: FrequentFilter) -> DataFrame:
    """The relation of the frequent phrases of ``length`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _blocks(batches, length, known):
            x.only(keep, length)
            row = x.row(length)
            if row is not None:
                yield _relation([row])

    return relation.select(*_NAMES).mapInArrow(K.tidy(run), _BLOCK)


def _group_counts(relation: DataFrame, length: int, keep: FrequentFilter | None = None) -> DataFrame:
    """(lang, phrase, n) of the groups of each block; of words, those that ``keep`` knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                x = _Block(batch, r)
                at, n = x.groups()
                if keep is not None:
                    known = keep.has(x.hashes(at, length))
                    at, n = at[known], n[known]
                words = pa.array(x.words, pa.string())
                spelled = pc.binary_join_element_wise(*[words.take(pa.array(x.run[at + j])) for j in range(length)], " ")
                lang = pa.array(x.langs, pa.string()).take(pa.array(x.lang_of[x.run[at]]))
                yield pa.RecordBatch.from_arrays([lang, spelled, pa.array(n)], ["lang", "phrase", "n"])

    return relation.select(*_NAMES).mapInArrow(K.tidy(run), _COUNT)


def phrase_counts(docs: DataFrame, min_count: int = 100, longest: int = 5, range_words: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of 1 to ``longest`` words that
    occur ``min_count`` times or more in their language, and (lang, n) of all
    word occurrences.

    The relation of all words is written. For each length the relation of
    phrases one word shorter is merge-joined, its groups are counted by hash,
    the occurrences of frequent groups are written (of words, picked out on
    reading), and their phrases counted by themselves, which is what counts:
    hashes that meet, and bits of the filter, only let a few more through.
    Hashes are counted in a range for every ``range_words`` word occurrences."""
    relation = materialise(_word_occurrences(docs), "occurrences1")
    sizes = relation.select(F.explode(F.arrays_zip("langs", "sizes")).alias("x"))
    totals = materialise(sizes.groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.sizes").alias("n")), "totals")
    words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = 1 << max(0, int(words // range_words)).bit_length()
    frequent, known = None, None
    for length in range(1, longest + 1):
        keep = frequent_filter(materialise(frequent_hashes(relation, length, known, min_count, ranges), f"hashes{length}"))
        if length == 1:
            known, counts = keep, _group_counts(relation, 1, keep)
        else:
            relation, known = materialise(_semi_joined(relation, length, known, keep), f"occurrences{length}"), None
            counts = _group_counts(relation, length)
        counts = counts.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
        level = materialise(counts.select("lang", "phrase", F.lit(length).alias("words"), "f"), f"frequent{length}")
        frequent = level if frequent is None else frequent.unionByName(level)
    return frequent, totals


def collocations(docs: DataFrame, min_count: int = 100, longest: int = 5, share: int = 100, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language in ``docs`` (text, lang; other
    columns are ignored): lang, rank, phrase, a, l, r, n, score.

    Texts (null: empty) are put in lower case (A-Z), cut into pieces and
    words; a null lang is ``und``. Candidates are phrases of 2 to ``longest``
    words that occur a >= ``min_count`` times within pieces. Each cut after
    the first k words, which occur l times, the rest r times, scores
    floor(1000 a n / (l r)), n being the language's word occurrences; the
    lowest score counts, of equal ones the smallest k. Candidates within a
    longer one that occurs ``share`` percent as often or more are dropped.
    Ties of rank go by score, a (descending), phrase. Products are decimals
    of 38 digits. An empty table gives an empty one; repeated rows count each.
    Sharing a language or a word costs nothing: counts are joined by block
    before they are shuffled."""
    texts = docs.select(F.col("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    frequent, totals = phrase_counts(texts, min_count, longest)
    found = frequent.filter("words > 1").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))
    part = lambda at, size: F.array_join(F.slice("w", at, size), " ")
    cut = found.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    known = frequent.filter(F.col("words") < longest)
    cut = cut.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cut = cut.join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(totals, "lang")
    scored = cut.withColumn("score", F.expr("(cast(1000 as decimal(4,0)) * a * n) div (cast(l as decimal(19,0)) * r)"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.size("w") - m + 1), lambda at: F.array_join(F.slice("w", at, m), " "))))
    within = found.filter("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a")
    within = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    best = best.join(within, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    best = best.select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
