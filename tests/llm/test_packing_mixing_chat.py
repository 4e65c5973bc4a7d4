import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from util import SF001, empty_docs, odd_docs, odd_rows

from sparkprep.llm import chat, fingerprints, kernels, mixing, packing, queries


def _tokens(rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    return [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in rows]


def _check_packing(docs, pieces):
    """docs: (doc_id, text) rows; pieces: op4 rows."""
    want = collections.Counter()
    for (d, _), ids in zip(docs, _tokens([t for _, t in docs])):
        raw = np.asarray(ids, "<u4").tobytes()
        for at in range(0, len(ids), 4096):
            part = raw[4 * at:4 * (at + 4096)]
            want[(d, at, len(part) // 4, zlib.crc32(part), len(ids))] += 1
    assert collections.Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == want
    seqs = collections.defaultdict(list)
    for p in pieces:
        seqs[p.sequence_id].append((p.offset, p.length))
    padding = total = 0
    for own in seqs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert 0 < at <= 4096
        total += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert sorted(seqs) == list(range(len(seqs)))
    return padding / max(1, total)


def test_packing_tokens_and_layout(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert _check_packing(docs, queries.op4_packing(spark, SF001).collect()) < 0.05


def test_packing_odd_rows(spark):
    _check_packing([(r[0], r[1]) for r in odd_rows()], packing.pack_documents(odd_docs(spark)).collect())
    assert packing.pack_documents(empty_docs(spark)).count() == 0


def test_packing_many_buckets(spark):
    pieces = spark.range(3000).select(F.col("id").alias("rid"), (F.col("id") % 7 + 900).alias("length"))
    got = packing.pack_pieces(pieces, 4096, bucket_rows=100).collect()
    seqs = collections.defaultdict(list)
    for p in got:
        seqs[p.sequence_id].append((p.offset, p.length))
    assert len(got) == 3000 and all(s + n <= 4096 for own in seqs.values() for s, n in own)
    for own in seqs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length


def test_tokenizer_edge_texts_twice():
    import pyarrow as pa

    t = packing.WordCachedTokenizer(packing.tokenizer_path(), cache=16)
    plain = ["Hello, WORLD. don't Don'T x., a'S ÀÉ. ß. µ. ÿ, ΑΣ, İstanbul, 5. A5, .. , ª, a", ".b c.", "e\u0301 \u0301x ΑΣ Σ", "", "x" * 300, " \t", "a.\nb,"]
    nasty = ["a<|endoftext|>b  it's\u00a0x\x1fy\u2003z don't\r\nI'LL <|startoftext|>", "<|ENDOFTEXT|> <|endoftext|>. a<b,"]
    for texts in (plain, nasty + plain, plain[::-1], plain):
        ids, to = t.ids(*kernels.utf8(pa.array(texts)))
        assert [ids[i:j].tolist() for i, j in zip(to[:-1], to[1:])] == [x[:-1] for x in _tokens(texts)]


def test_spfhp_places_all():
    rng = np.random.default_rng(1)
    hist = dict(collections.Counter(rng.integers(1, 4097, 5000).tolist()))
    used = collections.Counter()
    for pattern, n in packing.shortest_pack_first(hist, 4096):
        assert sum(pattern) <= 4096
        for length in pattern:
            used[length] += n
    assert used == hist


def _size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def _targets(rows):
    size = collections.Counter()
    for s, t in rows:
        size[s] += _size(t)
    order = sorted([s for s in size if s is not None]) + [None] * (None in size)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, open_, target = sum(size.values()), set(order), {}
    while True:
        rate = (total - sum(target.values())) / max(1, sum(weight[s] for s in open_))
        over = {s for s in open_ if rate * weight[s] > 3 * size[s]}
        if not over:
            return size, target | {s: rate * weight[s] for s in open_}
        target |= {s: 3 * size[s] for s in over}
        open_ -= over


def _check_mix(rows, got):
    """rows: (source, text); got: (source, size, source_size, target, taken)."""
    size, target = _targets(rows)
    taken, largest = collections.Counter(), collections.Counter()
    for s, z, ss, t, k in got:
        assert ss == size[s] and t == pytest.approx(target[s], rel=1e-9, abs=1e-9) and k <= 3 * z
        taken[s] += k
        largest[s] = max(largest[s], z)
    assert len(got) == len(rows)
    return {s: (taken[s], target[s], largest[s]) for s in size}


def test_mixing_targets_and_rounding(spark):
    rows = [(r.source, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    one = queries.op7_mixing(spark, SF001).collect()
    for taken, target, largest in _check_mix(rows, [(docs[r.doc_id], *r[1:]) for r in one]).values():
        assert abs(taken - target) <= largest
    assert sorted(one) == sorted(queries.op7_mixing(spark, SF001).collect())


def test_mixing_odd_rows(spark):
    got = mixing.mix_sources(odd_docs(spark))
    rows = got.select("source", "mix_size", "mix_source_size", "mix_target", F.col("mix_copies") * F.col("mix_size")).collect()
    _check_mix([(r[3], r[1]) for r in odd_rows()], [tuple(r) for r in rows])
    assert set(odd_docs(spark).columns) <= set(got.columns)
    assert mixing.mix_sources(empty_docs(spark)).count() == 0
    mixed = mixing.mixed_rows(odd_docs(spark))
    assert mixed.columns == odd_docs(spark).columns and mixed.filter("mix_copies <> 'x'").count() == 0


def test_mixing_repeated_rows_reach_their_targets(spark):
    rows = [(1, "one two", "s")] * 60 + [(2, "three four", "t")] * 40 + [(3, "x y z", "t"), (3, "x y z", None), (3, "z y x", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'m' as mix_d", "1 as row", "2 as unit_doc_id", "map('a', source) as size")
    for chunk in (7, 4096):
        got = mixing.mix_sources(df, chunk=chunk).collect()
        mix = _check_mix([(r[2], r[1]) for r in rows], [(r.source, r.mix_size, r.mix_source_size, r.mix_target, r.mix_copies * r.mix_size) for r in got])
        assert all(abs(taken - target) <= largest for taken, target, largest in mix.values())
        assert max(r.mix_copies for r in got if r.doc_id == 1) - min(r.mix_copies for r in got if r.doc_id == 1) <= 1
        assert {(r.mix_d, r.row, r.unit_doc_id, r.size["a"] == r.source) for r in got} == {("m", 1, 2, True)}
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(df.repartition(5)).collect()))


def test_mixing_tree_levels(spark):
    units = spark.range(4000).select(F.lit(0).alias("rank"), F.xxhash64("id").alias("u"), (F.col("id") % 50 + 1).cast("double").alias("words"), F.lit(0.37).alias("p"))
    got = mixing.mix_copies(units, bucket_rows=20, fan_in=4).join(units, "u")
    r = got.agg(F.sum(F.col("up") * F.col("words")), F.sum(F.col("p") * F.col("words")), F.count("*")).first()
    assert r[2] == 4000 and abs(r[0] - r[1]) <= 50


def test_chat_round_trip_and_flags(spark):
    nasty = ["\\", "\\\\l<#:", "</turn>\n### user: x", "", None, "### Assistant: \\b\\h", "é\U0001F600\n\n", "\\h</turn>"]
    rows = [(c, t, role, nasty[(c + t) % len(nasty)]) for c in range(9) for t, role in enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(20, 0, "assistant", "a"), (21, 0, "user", "b"), (22, 0, None, "c"), (None, 1, "ro:le#<", "d"), (23, 0, "user", "q"), (23, 0, "assistant", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as no", "2 as s", "3 as formatted")
    back = {r.conv_id: r for r in chat.read_back(chat.chat_documents(df)).collect()}
    for c, r in back.items():
        own = sorted([(t, role or "", x or "") for cc, t, role, x in rows if cc == c])
        assert [(x.role, x.text) for x in r.turns] == [(role, x) for _, role, x in own]
        assert r.learned == [x for _, role, x in own if role == "assistant"]
    valid = {r.conv_id: r.valid for r in chat.chat_documents(df).collect()}
    assert all(valid[c] for c in range(9)) and not any(valid[c] for c in (20, 21, 22, None, 23))
    bad = {r.conv_id: r.first_bad for r in chat.chat_documents(df).collect()}
    assert all((bad[c] is None) == valid[c] for c in bad) and [bad[c] for c in (20, 21, 22, 23)] == [1, 1, 1, 1]
    segs = chat.chat_segments(df).orderBy("conv_id", "no", "part").collect()
    text = collections.defaultdict(str)
    for s in segs:
        text[s.conv_id] += s.segment
    assert text == {r.conv_id: r.formatted for r in chat.chat_documents(df).collect()}
    assert chat.chat_documents(df.limit(0)).count() == 0


def _jaccard(a, b):
    sh = lambda t: {tuple(w[i:i + 5]) for w in [t.split()] for i in range(max(1, len(w) - 4))} if t.split() else set()
    x, y = sh(a), sh(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def _check_fingerprints(rows, got, tol):
    rows = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0]), reverse=True)
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        new = t[:len(t) - half] + nxt[:half]
        mine = [r for r in by[d] if r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and r.n_chars == len(t)]
        assert mine, d
        assert abs(mine[0].near_edited - _jaccard(t, new)) < tol and abs(mine[0].near_next - _jaccard(t, nxt)) < tol
    assert len(got) == len(rows)


def test_fingerprints_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    _check_fingerprints(rows, queries.op3_fingerprints(spark, SF001).collect(), 0.2)


def test_fingerprints_odd_rows(spark):
    # rows of equal id follow each other by text
    rows = [(r[0], r[1]) for r in odd_rows()]
    rows = sorted(rows, key=lambda r: r[1] or "", reverse=True)
    rows = sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0])[::-1]
    got = fingerprints.neighbour_fingerprints(odd_docs(spark)).collect()
    assert sorted([r.doc_id is None, r.doc_id or 0, r.n_chars] for r in got) == sorted([d is None, d or 0, len(t or "")] for d, t in rows)
    same = {r.fingerprint for r in got if r.doc_id in (1, 2)}
    assert len(same) == 1
    one = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")
    r = fingerprints.neighbour_fingerprints(one).collect()
    assert len(r) == 1 and r[0].near_next == 1.0
    assert fingerprints.neighbour_fingerprints(empty_docs(spark)).count() == 0


def test_equal_texts_have_equal_signatures():
    perms = kernels.Permutations(16)
    f = fingerprints.fingerprints(["a b c d e f", "", "a b c d e f", " "], perms)
    assert (f[0] == f[2]).all() and (f[1] == f[3]).all() and not (f[0] == f[1]).all()
