"""Embedding near-dedup by HNSW graphs per shard (operator 2)."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import connected_components
from . import kernels as K
from .store import materialise, small_or_shuffled

_LOW = -(1 << 63)


@dataclass
class HNSW:
    """Hierarchical navigable small-world graph over unit vectors; numpy arrays
    only. ``layers[l]`` (rows, degree) lists neighbours, -1 where there are
    fewer; a row of layer l > 0 without any is not on that layer."""

    unit: np.ndarray            # (rows, dims) float32
    layers: list[np.ndarray]
    entry: int

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and similarities (queries, width) that beams of ``width`` find, best first; -1 for none."""
        start = np.full((len(queries), 1), self.entry)
        for layer in self.layers[:0:-1]:
            start = _beam(self.unit, layer, queries, start, 4)[0][:, :1]
        return _beam(self.unit, self.layers[0], queries, start, width)


def _beam(unit: np.ndarray, layer: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int, expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of one layer for all queries in step: each step
    expands the best unexpanded rows of every beam."""
    q, n = len(queries), len(unit)
    ids = np.full((q, width + expand * layer.shape[1]), -1)
    sims = np.full(ids.shape, -np.inf, np.float32)
    done = np.ones(ids.shape, bool)
    seen = np.zeros((q, n), bool)
    claim = np.zeros((q, n), np.int32)
    k = min(start.shape[1], width)
    ids[:, :k] = start[:, :k]
    sims[:, :k] = np.einsum("qd,qkd->qk", queries, unit[start[:, :k]])
    done[:, :k] = False
    seen[np.arange(q)[:, None], start[:, :k]] = True
    active = np.arange(q)
    while len(active):
        # the beam is kept sorted: its first unexpanded rows are the best ones
        rank = np.cumsum(~done[active, :width], axis=1)
        pick = ~done[active, :width] & (rank <= expand)
        row, col = np.nonzero(pick)
        if not len(row):
            break
        done[active[row], col] = True
        near = layer[ids[active[row], col]]
        own = np.repeat(active[row], near.shape[1])
        slot = (rank[row, col] - 1)[:, None] * layer.shape[1] + np.arange(near.shape[1])
        near, slot = near.ravel(), slot.ravel()
        fresh = near >= 0
        fresh[fresh] &= ~seen[own[fresh], near[fresh]]
        own, near, slot = own[fresh], near[fresh], slot[fresh]
        claim[own, near] = slot  # of equal finds one counts
        one = claim[own, near] == slot
        own, near, slot = own[one], near[one], slot[one]
        seen[own, near] = True
        ids[active, width:] = -1
        sims[active, width:] = -np.inf
        done[active, width:] = True
        ids[own, width + slot] = near
        sims[own, width + slot] = np.einsum("nd,nd->n", queries[own], unit[near])
        done[own, width + slot] = False
        order = np.argsort(-sims[active], axis=1, kind="stable")
        for x in (ids, sims, done):
            x[active] = np.take_along_axis(x[active], order, axis=1)
        active = active[(~done[active, :width] & (ids[active, :width] >= 0)).any(axis=1)]
    return ids[:, :width], sims[:, :width]


def _diverse(unit: np.ndarray, of: int, found: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` neighbours, best first, skipping those nearer to a chosen one than to ``of``; the rest fill up."""
    sim = unit[found] @ unit[of]
    found = found[np.argsort(-sim, kind="stable")]
    if len(found) <= degree:
        return found
    v = unit[found]
    to = v @ unit[of]
    cross = v @ v.T
    blocked = np.zeros(len(found), bool)
    chosen = []
    for i in range(len(found)):
        if not blocked[i]:
            chosen.append(i)
            if len(chosen) == degree:
                break
            blocked |= cross[i] > to
    for i in range(len(found)):
        if len(chosen) >= degree:
            break
        if i not in chosen:
            chosen.append(i)
    return found[chosen]


def _link(unit: np.ndarray, members: np.ndarray, degree: int, width: int) -> np.ndarray:
    """One layer: members join in batches that double the graph; a batch
    searches the graph so far, sees itself whole, and its links go both ways."""
    layer = np.full((len(unit), degree), -1)
    at = 0
    while at < len(members):
        batch = members[at:at + max(32, min(at, 512))]
        within = unit[batch] @ unit[batch].T
        np.fill_diagonal(within, -np.inf)
        best = np.argsort(-within, axis=1, kind="stable")[:, :min(degree, len(batch) - 1)]
        found = batch[best]
        if at:
            old, _ = _beam(unit, layer, unit[batch], np.repeat(members[:1][None], len(batch), 0), width)
            found = np.concatenate([old, found], axis=1)
        back: dict[int, list[int]] = {}
        for i, f in zip(batch.tolist(), found):
            mine = _diverse(unit, i, f[f >= 0], max(2, degree // 2))
            layer[i, :len(mine)] = mine
            for j in mine.tolist():
                back.setdefault(j, []).append(i)
        for j, new in back.items():
            have = layer[j][layer[j] >= 0]
            every = np.concatenate([have, np.setdiff1d(new, have)])
            kept = every if len(every) <= degree else _diverse(unit, j, every, degree)
            layer[j] = -1
            layer[j, :len(kept)] = kept
        at += len(batch)
    return layer


def build_hnsw(unit: np.ndarray, degree: int = 24, width: int = 48, seed: int = 9) -> HNSW:
    """``unit`` float32 unit vectors in any order; levels by the usual geometric draw."""
    n = len(unit)
    rng = np.random.default_rng(seed)
    level = np.floor(-np.log(rng.random(n)) / np.log(degree // 2)).astype(int)
    layers = []
    for l in range(int(level.max(initial=0)) + 1):
        members = np.flatnonzero(level >= l)
        members = members[np.argsort(-level[members], kind="stable")]
        layers.append(_link(unit, members, degree if l == 0 else degree // 2, width))
    return HNSW(unit, layers, int(np.argmax(level)) if n else 0)


def linked(index: HNSW, whole: np.ndarray, queries: np.ndarray, threshold: float, recall: float = 0.999, widths: tuple[int, ...] = (24, 48, 96, 192),
           audit: int = 128, depth: int = 10) -> np.ndarray:
    """(queries, rows) bool: cosine >= threshold in double precision, of what
    the graph finds. ``whole``, ``queries``: float64 unit vectors.

    Beams widen until an audit passes: ``audit`` evenly spaced queries are
    compared with a scan of the shard, and the share found of their links and
    of their ``depth`` nearest rows, linked or not, must reach ``recall``. A
    query's own row doesn't count, and so few neighbours that one miss would
    break ``recall`` prove nothing. Queries whose beam is full of links, and
    all of them if the widest beams fail their audit or too little is there
    to audit, get the scan (the exact way for the rest)."""
    near = np.zeros((len(queries), len(whole)), bool)
    low = queries.astype(np.float32)
    margin = np.float32(threshold - 1e-5)
    todo = np.arange(len(queries))
    sample = np.unique(np.linspace(0, len(queries) - 1, min(audit, len(queries))).astype(int))
    cosine = queries[sample] @ whole.T
    cosine[cosine >= 1 - 1e-12] = -np.inf
    nearest = np.partition(cosine, max(0, len(whole) - depth), axis=1)[:, max(0, len(whole) - depth)]
    truth = (cosine >= np.minimum(nearest, threshold)[:, None]) & np.isfinite(cosine)
    for width in widths:
        if width >= len(whole) or truth.sum() * (1 - recall) < 1 - 1e-9:
            break
        ids, sims = index.search(low[sample], width)
        checked = sims[:, -1] < margin
        want = truth[checked].sum()
        got = (np.take_along_axis(truth, np.maximum(ids, 0), axis=1) & (ids >= 0))[checked].sum()
        if checked.mean() > 0.5 and want * (1 - recall) >= 1 - 1e-9 and got >= recall * want:
            ids, sims = index.search(low, width)
            row, col = np.nonzero((sims >= margin) & (ids >= 0))
            found = ids[row, col]
            near[row, found] = np.einsum("nd,nd->n", queries[row], whole[found]) >= threshold
            todo = np.flatnonzero(sims[:, -1] >= margin)
            break
    for at in range(0, len(todo), 512):
        own = todo[at:at + 512]
        near[own] = queries[own] @ whole.T >= threshold
    return near


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors (float64 bytes) of usable embeddings, and a digest of label and vector."""
    for batch in batches:
        node, dims, unit = [], [], []
        for label, v in zip(batch["label"].to_pylist(), batch["v"]):
            x = None
            if label is not None and v.is_valid and v.values.null_count == 0 and len(v.values):
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(x).max() if np.isfinite(x).all() else 0.0
                x = x / top if top > 0 else None  # scaled first, so that no square over- or underflows
            if x is None:
                node.append(None)
                dims.append(None)
                unit.append(None)
            else:
                x = x / np.sqrt(x @ x)
                node.append(hashlib.md5(f"{label} ".encode() + x.tobytes()).digest())
                dims.append(len(x))
                unit.append(x.tobytes())
        yield pa.RecordBatch.from_arrays([batch["k"], batch["label"], pa.array(node, pa.binary()), pa.array(dims, pa.int32()), pa.array(unit, pa.binary())],
                                         ["k", "label", "node", "dims", "unit"])


def _vectors(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, values)), np.float64).reshape(len(values), -1)


def _build(degree: int, width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", key=lambda s: s.map(bytes))
        whole = _vectors(pdf["unit"])
        index = build_hnsw(whole.astype(np.float32), degree, width)
        blob = pickle.dumps((whole, [bytes(x) for x in pdf["node"]], pdf["copies"].to_numpy(), [x.astype(np.int32) for x in index.layers], index.entry), 5)
        return pdf[["label", "dims", "shard", "queries"]].head(1).assign(index=[blob])

    return run


def _search(threshold: float, recall: float):
    def run(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(index):
            return pd.DataFrame({"node": [], "other": [], "links": []})
        whole, nodes, copies, layers, entry = pickle.loads(bytes(index["index"].iloc[0]))
        graph = HNSW(whole.astype(np.float32), [x.astype(np.int64) for x in layers], entry)
        own = [bytes(x) for x in queries["node"]]
        near = linked(graph, whole, _vectors(queries["unit"]), threshold, recall)
        at = {x: i for i, x in enumerate(nodes)}
        for i, x in enumerate(own):
            if x in at:
                near[i, at[x]] = False
        found = near @ copies
        # smallest reachable row of the shard, by alternating minima over queries and rows
        rows = np.flatnonzero(near.any(axis=0))
        linked_q = np.flatnonzero(near.any(axis=1))
        part = near[np.ix_(linked_q, rows)]
        label = np.arange(len(rows))
        while len(rows):
            q = np.where(part, label, len(rows)).min(axis=1)
            new = np.minimum(label, np.where(part, q[:, None], len(rows)).min(axis=0))
            new = new[new]
            if (new == label).all():
                break
            label = new
        edges = [(own[i], nodes[rows[label[part[j].argmax()]]]) for j, i in enumerate(linked_q)]
        edges += [(nodes[r], nodes[rows[label[j]]]) for j, r in enumerate(rows) if label[j] != j]
        out = [(own[i], None, int(found[i])) for i in np.flatnonzero(found)] + [(u, v, 0) for u, v in edges if u != v]
        return pd.DataFrame(out, columns=["node", "other", "links"])

    return run


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = 0.93,
                 shard_rows: int = 8192, query_rows: int = 1024, degree: int = 24, width: int = 48, recall: float = 0.999) -> DataFrame:
    """One row per vector: vec_id, n_links (vectors of the same label with
    cosine >= threshold, found directly), component_id (smallest vec_id
    reachable over links) and kept (vec_id = component_id).

    Equal vectors of a label are one class from the start. The classes of a
    label (and length) are dealt to shards of about ``shard_rows`` by hash;
    a task builds each shard's graph, and blocks of queries visit every shard
    of their label, a task a pair, so a label of any size is spread. Only
    counts and spanning edges leave a task. A null label, and a vector that is
    null, empty, zero or has null or non-finite components, link with nothing.
    A null vec_id counts as the smallest; other columns are ignored."""
    v = vectors.select(F.coalesce(F.col(vec_id).cast("long"), F.lit(_LOW)).alias("k"), F.col(label).cast("string").alias("label"), F.col(embedding).alias("v"))
    rows = materialise(v.mapInArrow(K.tidy(_prepare), "k long, label string, node binary, dims int, unit binary"), "vectors")
    classes = materialise(rows.filter("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("dims").alias("dims"), F.first("unit").alias("unit"), F.count("*").alias("copies"), F.min("k").alias("k")), "classes")
    sizes = materialise(classes.groupBy("label", "dims").agg(
        F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"), F.ceil(F.count("*") / query_rows).cast("int").alias("queries")), "sizes")
    sized = classes.join(small_or_shuffled(sizes), ["label", "dims"])
    key = ["label", "dims", "shard"]
    index = materialise(sized.withColumn("shard", F.pmod(F.xxhash64("node"), "shards").cast("int")).select(*key, "queries", "node", "copies", "unit")
                        .groupBy(*key).applyInPandas(_build(degree, width), "label string, dims int, shard int, queries int, index binary"), "hnsw")
    asked = sized.select("label", "dims", "node", "unit", F.pmod(F.xxhash64("node", F.lit(2)), "queries").cast("int").alias("block"),
                         F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    each = index.select(*key, "index", F.explode(F.sequence(F.lit(0), F.col("queries") - 1)).alias("block"))
    found = materialise(asked.groupBy(*key, "block").cogroup(each.groupBy(*key, "block"))
                        .applyInPandas(_search(threshold, recall), "node binary, other binary, links long"), "links")
    total = found.groupBy("node").agg(F.sum("links").alias("links"))
    stars = connected_components(found.filter("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    least = stars.join(classes.select("node", "k"), "node").groupBy("root").agg(F.min("k").alias("least"))
    component = stars.join(least, "root").select("node", "least")
    known = materialise(classes.select("node", "copies", F.col("k").alias("own")).join(total, "node", "left").join(component, "node", "left").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "own").alias("least")), "known")
    j = rows.select("k", "node").join(known, "node", "left")
    least = F.coalesce("least", "k")
    return j.select(F.when(F.col("k") != _LOW, F.col("k")).alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(least != _LOW, least).alias("component_id"), (F.col("k") == least).alias("kept"))
