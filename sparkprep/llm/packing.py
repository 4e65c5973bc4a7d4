"""Packing tokenised documents into fixed-length sequences (operator 4):
shortest-pack-first over the length histogram."""

from __future__ import annotations

import bisect
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import IS_SPACE, chunks, prefix_hash, span_hash, utf8, words
from . import kernels as K
from .store import materialise, partitions

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordCachedTokenizer:
    """``tokenizers`` ids of whole texts, encoding words that it has not seen
    lately and looking up the others. Exact for tokenizers like word_bpe_49k,
    which lower case, drop white space and never look across it: texts may
    then be cut at ASCII white space and before a comma or stop that ends a
    word after an ASCII letter (the split pattern cuts there), and ASCII
    letters put in lower case first.

    Words are found and hashed (64 bits) with numpy; ``cache`` slots, each of
    one word of up to ``width`` ids, keep the latest word of their hash. New
    words are encoded in one call, joined by spaces; their ids are told apart
    by the vocabulary's end-of-word suffix, as many word ends each as the
    tokenizer's own split pattern finds words in it. Words with special tokens,
    or that don't add up, are encoded one by one."""

    def __init__(self, path: str, cache: int = 1 << 19, width: int = 12):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            own = json.load(f)
        suffix = own["model"]["end_of_word_suffix"]
        self.word = regex.compile(next(x["pattern"]["Regex"] for x in own["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"))
        self.special = [x["content"] for x in own["added_tokens"]]
        self.first_special = {x[:1].encode() for x in self.special}
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tok.get_vocab().items() if t.endswith(suffix)]] = True
        self.key = np.zeros(cache, np.uint64)
        self.size = np.zeros(cache, np.int64)
        self.slot = np.zeros((cache, width), np.uint16 if len(self.ends) <= 1 << 16 else np.uint32)

    def _one(self, piece: str) -> np.ndarray:
        return np.asarray(self.tok.encode(piece, add_special_tokens=False).ids, "<u4")

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has."""
        if not any(x in p for p in pieces if "<" in p for x in self.special):
            count = [1 if p.isascii() and p.isalpha() else len(self.word.findall(unicodedata.normalize("NFC", p).lower())) for p in pieces]
            ids = np.asarray(self.tok.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, "<u4")
            last, total = np.flatnonzero(self.ends[ids]), np.cumsum(count)
            if len(last) == total[-1]:
                return ids, np.diff(np.concatenate([[-1], last])[total], prepend=-1)
        each = [self._one(p) for p in pieces]
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)

    def ids(self, b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """uint32 ids of the texts in UTF-8 bytes ``b``, and row offsets into them."""
        n = len(b)
        if not n:
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        if not any(x in b for x in (ord(f) for f in self.first_special)):
            b = np.where((b >= 65) & (b <= 90), b | 32, b).astype(np.uint8)
        stop = np.zeros(n, bool)  # a comma or stop after a letter at the end of a word: a word of its own
        stop[1:] = ((b[1:] == 44) | (b[1:] == 46)) & ((b[:-1] | 32) >= 97) & ((b[:-1] | 32) <= 122)
        stop[:-1] &= IS_SPACE[b[1:]]
        at_end = offsets[1:-1][(offsets[1:-1] < n) & (offsets[1:-1] > 0)]
        stop[at_end] = False  # the first byte of a text follows no letter of its own
        s, e, wo = words(b, offsets, stop)
        h = span_hash(prefix_hash(b), s, e)
        at = (h >> np.uint64(13)).astype(np.int64) & (len(self.key) - 1)
        known = self.key[at] == h
        size = np.where(known, self.size[at], 0)
        missing = np.flatnonzero(~known)
        if len(missing):
            _, first, inverse = np.unique(h[missing], return_index=True, return_inverse=True)
            spans = missing[first]
            raw = b.tobytes()
            pieces = [raw[i:j].decode() for i, j in zip(s[spans].tolist(), e[spans].tolist())]
            new, length = self._encode(pieces)
            begin = np.concatenate([[0], np.cumsum(length)])
            size[missing] = length[inverse]
        to = np.concatenate([[0], np.cumsum(size)])
        out = np.zeros(to[-1], "<u4")
        hit = np.flatnonzero(known)
        have = np.arange(self.slot.shape[1]) < size[hit][:, None]
        out[(to[hit][:, None] + np.arange(self.slot.shape[1]))[have]] = self.slot[at[hit]][have]
        if len(missing):
            count = size[missing]
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            out[np.repeat(to[missing], count) + step] = new[np.repeat(begin[inverse], count) + step]
            keep = np.flatnonzero(length <= self.slot.shape[1])
            place = at[spans[keep]]
            rows = np.zeros((len(keep), self.slot.shape[1]), self.slot.dtype)
            have = np.arange(self.slot.shape[1]) < length[keep][:, None]
            rows[have] = new[(begin[keep][:, None] + np.arange(self.slot.shape[1]))[have]]
            _, final = np.unique(place[::-1], return_index=True)  # of words with one slot the last stays, whole
            final = len(place) - 1 - final
            self.key[place[final]], self.size[place[final]], self.slot[place[final]] = h[spans[keep[final]]], length[keep[final]], rows[final]
        return out, to[wo]


_TOKENIZERS: dict[str, WordCachedTokenizer] = {}


def shared_tokenizer(path: str) -> WordCachedTokenizer:
    """One a worker process, so that later tasks find its known words."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordCachedTokenizer(path)
    return _TOKENIZERS[path]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, path: str | None = None, end_id: int = 2, seq_len: int = 4096, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and,
    with ``keep_ids``, ids (binary, little-endian uint32). A document is its
    ids and ``end_id``; it is cut at multiples of ``seq_len``. A null text is
    empty and has the end id alone."""
    name, step = path, 4 * seq_len

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tok, end = shared_tokenizer(name or tokenizer_path()), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            doc, start, length, crc, total, ids = [], [], [], [], [], []
            b, offsets = utf8(batch["text"])
            for lo, hi in chunks(offsets, 2 << 20):
                flat, to = tok.ids(b[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                for d, i, j in zip(batch["doc_id"].slice(lo, hi - lo).to_pylist(), to[:-1].tolist(), to[1:].tolist()):
                    raw = flat[i:j].tobytes() + end
                    for at in range(0, len(raw), step):
                        piece = raw[at:at + step]
                        doc.append(d)
                        start.append(at // 4)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(len(raw) // 4)
                        if keep_ids:
                            ids.append(piece)
            cols = [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)] + ([pa.array(ids, pa.binary())] if keep_ids else [])
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(K.tidy(run), _PIECES + ", ids binary" * keep_ids)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in order, count) for a histogram of lengths.

    Lengths are placed longest first, each into the packs with the least
    content that it fits, whole runs of equal packs at a time; packs that
    no length fits are opened new. The work and the number of patterns
    depend on ``capacity`` only, not on the number of documents: a length
    splits at most one run of equal packs per placement depth."""
    by_fill: dict[int, dict[tuple[int, ...], int]] = {}
    fills: list[int] = []

    def put(fill: int, pattern: tuple[int, ...], n: int) -> None:
        if fill not in by_fill:
            by_fill[fill] = {}
            bisect.insort(fills, fill)
        by_fill[fill][pattern] = by_fill[fill].get(pattern, 0) + n

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if fills and fills[0] + length <= capacity:
                fill = fills[0]
                pattern, n = next(iter(by_fill[fill].items()))
                take = min(n, left)
                if take == n:
                    del by_fill[fill][pattern]
                    if not by_fill[fill]:
                        del by_fill[fill]
                        fills.pop(0)
                else:
                    by_fill[fill][pattern] = n - take
                put(fill + length, pattern + (length,), take)
            else:
                # as many of this length as a new pack holds; the rest of the count in a shorter pack
                per = capacity // length
                if left >= per:
                    put(per * length, (length,) * per, left // per)
                if left % per:
                    put(left % per * length, (length,) * (left % per), 1)
                left = take = 0
            left -= take
    return [(pattern, n) for fill in fills for pattern, n in by_fill[fill].items()]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go by rank: arrays sorted by (length,
    first): pieces of that length with ranks first .. first + n - 1 take
    sequences seq .. seq + n - 1 at offset."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for pattern, n in patterns:
        at = 0
        for length in pattern:
            first = used.get(length, 0)
            rows.append((length, first, base, at))
            used[length] = first + n
            at += length
        base += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "first": table[:, 1], "seq": table[:, 2], "offset": table[:, 3]}


def place(table: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by length and rank."""
    top = np.int64(1) << 40
    at = np.searchsorted(table["length"] * top + table["first"], length * top + rank, "right") - 1
    return table["seq"][at] + rank - table["first"][at], table["offset"][at]


def pack_pieces(pieces: DataFrame, seq_len: int = 4096, bucket_rows: int = 50_000) -> DataFrame:
    """``pieces`` (a written table with long columns length, at most
    ``seq_len``, and rid, unique) -> its rows with sequence_id and offset.

    The length histogram (at most ``seq_len`` rows) is packed on the driver;
    pieces join the patterns by their rank within their length. Ranks are
    counted in buckets of about ``bucket_rows`` rows dealt by a hash of rid,
    so one length holding a third of all pieces is spread over many tasks. An
    empty table gives an empty table."""
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    table = slots(shortest_pack_first(histogram, seq_len))
    buckets = spark.createDataFrame([(k, -(-v // bucket_rows)) for k, v in histogram.items()], "length long, buckets long")
    dealt = pieces.join(F.broadcast(buckets), "length").withColumn("bucket", F.pmod(F.xxhash64("rid"), "buckets")).drop("buckets")
    counts = dealt.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inner = Window.partitionBy("length", "bucket").orderBy("rid")
    ranked = dealt.withColumn("no", F.row_number().over(inner) - 1).join(offsets, ["length", "bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("no") + F.col("before")).alias("rank"))
    names = [c for c in ranked.columns if c != "rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, offset = place(table, batch["length"].to_numpy(zero_copy_only=False).astype(np.int64), batch["rank"].to_numpy(zero_copy_only=False).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch[c] for c in names] + [pa.array(seq, pa.int64()), pa.array(offset, pa.int64())], names + ["sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "rank")
    return ranked.mapInArrow(K.tidy(run), f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None, end_id: int = 2, seq_len: int = 4096, keep_ids: bool = False) -> DataFrame:
    """Pack whole documents (doc_id, text; other columns are ignored): one row
    per piece with doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and ids if ``keep_ids``. Null and empty texts are one end id; a
    null doc_id is kept; repeated rows are packed each. Documents longer than
    ``seq_len`` are cut at its multiples."""
    pieces = token_pieces(docs, path, end_id, seq_len, keep_ids).withColumn("rid", F.monotonically_increasing_id())
    return pack_pieces(materialise(pieces, "pieces"), seq_len).drop("rid")
