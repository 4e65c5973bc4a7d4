"""N-gram Jaccard similarity join by MinHash LSH with fixed prefixes (operator 10).

Every text gets ``trees`` sequences of ``deepest`` MinHash values. Two texts of
similarity s share a prefix of k values in some tree with probability
1 - (1 - s^k)^trees. One k is taken for all texts (banding, not a forest): the
largest up to ``deepest`` at which that reaches the target recall at the
threshold. Texts meet by equality of the prefix's hash.

Equal texts are one class from the start. Texts that share a prefix are
compared by signature, which gives a spanning forest (not pairs) of likely
neighbours with a wide margin below the threshold; its components, tight
groups, then meet with their texts, and every pair inside is verified by exact
Jaccard similarity of the shingle sets in matrix blocks. Pairs are counted
where they are found and never written out. Groups and trie nodes above a
block's size are split into blocks and pairs of blocks, each its own task, so
a group of any size keeps all its links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .graph import connected_components
from .store import materialise, partitions, small_or_shuffled

_LOW = -(1 << 63)


def prefix_length(threshold: float, trees: int, deepest: int, recall: float) -> int:
    """The longest prefix that reaches the target recall at the threshold (1 at least)."""
    k = deepest
    while k > 1 and 1 - (1 - threshold ** k) ** trees < recall:
        k -= 1
    return k


def likeness_floor(threshold: float, values: int, deviations: float = 4.5) -> float:
    """Share of equal signature values below which a pair at the threshold falls with probability < 1e-5."""
    return threshold - deviations * (threshold * (1 - threshold) / values) ** 0.5


def _binary_rows(column, width: int) -> np.ndarray:
    b, _ = K.utf8(column)
    return b.reshape(-1, width)


def _signatures(trees: int, deepest: int, n: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        perms = K.Permutations(trees * deepest, seed)
        for batch in batches:
            b, o = K.utf8(batch["text"])
            for lo, hi in K.chunks(o, 2 << 20):
                part = batch.slice(lo, hi - lo)
                s, so = K.shingles(b[o[lo]:o[hi]], o[lo:hi + 1] - o[lo], n)
                yield pa.RecordBatch.from_arrays([part["k"], part["node"], pa.array(np.diff(so)), K.row_binary(perms.signatures(s, so))],
                                                 ["k", "node", "shingles", "sig"])

    return run


def _entries(trees: int, deepest: int, depth: int):
    """A row for each class and tree: the hash of its prefix, its node and the low bytes of its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _binary_rows(batch["sig"], 4 * trees * deepest).view("<u4").reshape(-1, trees, deepest)
            low = K.row_binary((sig & np.uint32(255)).astype(np.uint8).reshape(len(sig), -1))
            for t in range(trees):
                key = np.full(len(sig), K.U64(t + 1), np.uint64)
                for d in range(depth):
                    key = K.mix(key + sig[:, t, d].astype(np.uint64) * K.U64(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch["node"], low], ["key", "node", "low"])

    return run


def spanning_forest(close: Callable[[int, np.ndarray], np.ndarray], count: int) -> list[tuple[int, np.ndarray]]:
    """Stars (centre, others) that connect what ``close(i, rest)`` (a bool for
    each of rest) connects. Each row is compared with the rows not reached yet only."""
    rest, out = np.arange(count), []
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            i = reached.pop()
            near = close(i, rest)
            if near.any():
                out.append((i, rest[near]))
                reached.extend(rest[near].tolist())
                rest = rest[~near]
    return out


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups (rows sorted by ``names``, equal in them) with the
    groups' bounds; a group that goes on in the next batch is held back."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same_as_held = held and all(held[-1][n][held[-1].num_rows - 1] == batch[n][0] for n in names)
        new = np.zeros(batch.num_rows, bool)
        for n in names:
            x = batch[n].to_numpy(zero_copy_only=False) if not pa.types.is_binary(batch[n].type) else np.array(batch[n].to_pylist(), object)
            new[1:] |= x[1:] != x[:-1]
        new[0] = not same_as_held
        starts = np.flatnonzero(new)
        if not len(starts):
            held.append(batch)
            continue
        last = int(starts[-1])
        parts = held + ([batch.slice(0, last)] if last else [])
        if parts:
            bounds, at = [0], sum(x.num_rows for x in held)
            bounds += [at + int(i) for i in starts if at + i > 0]
            yield pa.Table.from_batches(parts).combine_chunks(), np.array(bounds)
        held = [batch.slice(last)]
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, np.array([0, table.num_rows])


_NODE = "u binary, v binary"


def _likely_edges(width: int, floor: float):
    least = int(np.ceil(floor * width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _groups(batches, ["key", "bi", "bj"]):
            low, node = _binary_rows(table["low"], width), table["node"].combine_chunks()
            u, v = [], []
            size = np.diff(bounds)
            two = bounds[:-1][size == 2]
            near = (low[two] == low[two + 1]).sum(axis=1) >= least
            u.append(two[near])
            v.append(two[near] + 1)
            for g in np.flatnonzero(size > 2):
                at, own = bounds[g], low[bounds[g]:bounds[g + 1]]
                for i, others in spanning_forest(lambda i, rest: (own[rest] == own[i]).sum(axis=1) >= least, len(own)):
                    u.append(np.full(len(others), at + i))
                    v.append(at + others)
            u, v = np.concatenate(u), np.concatenate(v)
            yield pa.RecordBatch.from_arrays([node.take(pa.array(u)), node.take(pa.array(v))], ["u", "v"])

    return run


def in_blocks(rows: DataFrame, sizes: DataFrame, keys: list[str], node: str) -> DataFrame:
    """Add block numbers bi <= bj. ``sizes`` (keys..., blocks) lists the groups
    that need several blocks: their rows go to a block by a hash of ``node``
    and are sent to each pair with another block; other rows have (0, 0)."""
    with_blocks = rows.join(small_or_shuffled(sizes), keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)).cast("int"))
    own = F.pmod(F.xxhash64(node, F.lit(5)), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least(F.col("own"), other).alias("bi"), F.greatest(F.col("own"), other).alias("bj")))
    return with_blocks.withColumn("own", own).select("*", F.inline(pairs)).drop("blocks")


def _common(sets: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """(sets, sets) sizes of intersections, by matrix products over blocks of
    the elements that two sets have at least."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)
    element = np.cumsum(new) - 1
    shared = np.bincount(element)[element] > 1 if len(values) else new
    owner, element = owner[shared], element[shared]
    if len(element):
        element = np.cumsum(np.concatenate([[False], element[1:] != element[:-1]]))
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(element[-1]) + 1 if len(element) else 0, columns):
        lo, hi = np.searchsorted(element, [at, at + columns])
        m = np.zeros((len(sets), columns), np.float32)
        m[owner[lo:hi], element[lo:hi] - at] = 1
        out += m @ m.T
    return out


def _verify(threshold: float, n: int):
    """Per class of a group (or pair of blocks): how many documents it is linked with here, and stars of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _groups(batches, ["root", "bi", "bj"]):
            b, o = K.utf8(table["text"])
            node, other, links = [], [], []
            nodes, copies = table["node"].to_pylist(), table["copies"].to_numpy()
            own_block, bi, bj = (table[x].to_numpy() for x in ("own", "bi", "bj"))
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi - lo < 2:
                    continue
                sets = []
                for x, y in K.chunks(o[lo:hi + 1], 4 << 20):
                    x, y = x + lo, y + lo
                    s, so = K.shingles(b[o[x]:o[y]], o[x:y + 1] - o[x], n)
                    sets += [np.unique(s[i:j]) for i, j in zip(so[:-1], so[1:])]
                size = np.array([len(x) for x in sets], float)
                common = _common(sets).astype(float)
                near = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9
                np.fill_diagonal(near, False)
                if bi[lo] != bj[lo]:  # pairs within a block are counted in the block's own task
                    near &= own_block[lo:hi][:, None] != own_block[lo:hi][None, :]
                found = near @ copies[lo:hi]
                for i in np.flatnonzero(found):
                    node.append(nodes[lo + i])
                    other.append(None)
                    links.append(int(found[i]))
                for i, others in spanning_forest(lambda i, rest: near[i, rest], hi - lo):
                    node += [nodes[lo + j] for j in others]
                    other += [nodes[lo + i]] * len(others)
                    links += [0] * len(others)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(other, pa.binary()), pa.array(links, pa.int64())], ["node", "other", "links"])

    return run


def text_node(text="text"):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def similarity_classes(docs: DataFrame, threshold: float = 0.8, n: int = 5, trees: int = 16, deepest: int = 6, recall: float = 0.999,
                       seed: int = 17, depth: int | None = None, block_rows: int = 4096, block_shingles: int = 600_000, block_classes: int = 2048) -> tuple[DataFrame, DataFrame]:
    """(rows, classes). rows: k (doc_id, the least long for null), node (digest
    of the text), rid (unique), shingles. classes, of distinct texts: node,
    class_id (smallest k), copies, n_links (documents linked to each of its
    own, their equals included), head (struct k, rid, node: the first document
    of the component) and shingles.

    A text links with others whose sets of ``n``-word shingles (white-space
    words; a shorter text is one shingle) have Jaccard similarity >= threshold.
    Null and empty texts, and those of white space only, have no shingles and
    link with nothing, not even each other."""
    spark = docs.sparkSession
    p = partitions(spark)
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW)).alias("k"), text_node().alias("node"), "text")
    rows = materialise(base.mapInArrow(K.tidy(_signatures(trees, deepest, n, seed)), "k long, node binary, shingles long, sig binary")
                       .withColumn("rid", F.monotonically_increasing_id()), "signatures")
    classes = materialise(rows.filter("shingles > 0").groupBy("node").agg(
        F.min(F.struct("k", "rid")).alias("first"), F.count("*").alias("copies"), F.first("shingles").alias("shingles"), F.first("sig").alias("sig")), "classes")
    depth = depth or prefix_length(threshold, trees, deepest, recall)
    entries = classes.select("node", "sig").mapInArrow(K.tidy(_entries(trees, deepest, depth)), "key long, node binary, low binary")
    crowded = materialise(entries.groupBy("key").count().filter(F.col("count") > block_rows)
                          .select("key", F.ceil(F.col("count") / block_rows).cast("int").alias("blocks")), "crowded")
    dealt = in_blocks(entries, crowded, ["key"], "node").drop("own").repartition(p, "key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    floor = likeness_floor(threshold, trees * deepest)
    groups = materialise(connected_components(dealt.mapInArrow(K.tidy(_likely_edges(trees * deepest, floor)), _NODE)), "groups")

    narrow = classes.select("node", F.col("first.k").alias("class_id"), "first", "copies", "shingles")
    members = materialise(groups.join(narrow, "node"), "members")
    large = materialise(members.groupBy("root").agg(F.greatest(F.ceil(F.sum("shingles") / block_shingles), F.ceil(F.count("*") / block_classes)).cast("int").alias("blocks"))
                        .filter("blocks > 1"), "large")
    # a sort-merge join at every size: its exchange of the texts is also what dropDuplicates needs
    texts = base.join(members.select("root", "node", F.col("class_id").alias("k"), "copies").hint("merge"), ["node", "k"]).dropDuplicates(["node", "k"])
    pieces = in_blocks(texts, large, ["root"], "node").select("root", "bi", "bj", "own", "node", "copies", "text")
    found = materialise(pieces.repartition(p, "root", "bi", "bj").sortWithinPartitions("root", "bi", "bj", "node")
                        .mapInArrow(K.tidy(_verify(threshold, n)), "node binary, other binary, links long"), "links")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    stars = connected_components(found.filter("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    heads = stars.join(narrow, "node").groupBy("root").agg(F.min(F.struct("first.k", "first.rid", "node")).alias("head"))
    component = stars.join(heads, "root").select("node", "head")
    out = narrow.join(linked, "node", "left").join(component, "node", "left").select(
        "node", "class_id", "copies", "shingles", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("head", F.struct(F.col("first.k").alias("k"), F.col("first.rid").alias("rid"), F.col("node").alias("node"))).alias("head"))
    return rows.select("k", "node", "rid", "shingles"), materialise(out, "similar")


def _id(c):
    return F.when(c != _LOW, c)


def similarity_join(docs: DataFrame, threshold: float = 0.8, n: int = 5, **options) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id with an equal
    text), component_id (smallest doc_id reachable over links), n_links (other
    documents linked directly, equal texts included) and kept (the first
    document of its component; of repeated rows one). Documents without words
    are alone and kept. Columns other than doc_id and text are ignored; a null
    doc_id counts as the smallest; an empty table gives an empty table."""
    rows, classes = similarity_classes(docs, threshold, n, **options)
    j = rows.join(classes.drop("shingles"), "node", "left")
    alone = F.col("class_id").isNull()
    return j.select(_id(F.col("k")).alias("doc_id"), _id(F.when(alone, F.col("k")).otherwise(F.col("class_id"))).alias("class_id"),
                    _id(F.when(alone, F.col("k")).otherwise(F.col("head.k"))).alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), (alone | (F.col("rid") == F.col("head.rid"))).alias("kept"))


def one_of_each_group(docs: DataFrame, threshold: float = 0.8, n: int = 5, **options) -> DataFrame:
    """``docs`` less all but the first document of each component (its own
    columns, whatever their names). Documents without words all stay."""
    _, classes = similarity_classes(docs, threshold, n, **options)
    heads = classes.select("head.k", "head.node").distinct()
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW)).alias("k"), text_node().alias("node"),
                        F.coalesce(F.col("text"), F.lit("")).rlike(r"^[\x20\x09-\x0D]*\z").alias("blank"), F.struct(*docs.columns).alias("row"))
    first = keyed.filter("not blank").join(heads, ["k", "node"], "left_semi").dropDuplicates(["k", "node"])
    return first.unionByName(keyed.filter("blank")).select("row.*")
