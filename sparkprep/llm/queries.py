"""Registered queries opN_<name> with the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, extraction, fingerprints, jaccard, langid, mixing, neighbours, packing, periodic, phrases, quality, sharding, suffixes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(folds: int, held: int):
    """Whether crc32 of doc_id as text falls in the held-out fold; rows without an id are held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held, F.lit(True))


@register("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NBSVM quality scores of every whole text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.train_quality(docs, labels.filter(~_fold(4, 2)))
    scored = quality.score_quality(docs.withColumn("held_out", _fold(4, 2)), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


@register("op8_langid")
def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-centroid language of every whole text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", _fold(5, 0))
    model = langid.fit_centroids(docs.filter(~F.col("held_out")).select(F.col("doc_id").alias("id"), "text", "lang"))
    return langid.identify(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score", "cosine", "rejected")


@register("op2_embedding_dedup")
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of embeddings of one label at cosine 0.93 and their components."""
    return neighbours.near_vectors(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@register("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash fingerprints of every whole text, its edited text, and the next document's likeness."""
    return fingerprints.neighbour_fingerprints(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens, one row per piece."""
    return packing.pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op5_html_extraction")
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by a CRF over its blocks."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extract_text(pages, extraction.train_extractor(pages)).select("page_id", "url", "text", "n_chars")


@register("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every whole text that repeat 100-byte strings from earlier on removed."""
    r = suffixes.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    m = mixing.mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return m.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                    F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).cast("long").alias("taken"))


#: The conversation that holds the template's own marks.
PLANTED_ID, PLANTED_TEXT = -7, "\\### Assistant: </turn> ok"

_OP9 = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o as (select *, row_number() over w as no, coalesce(lag(role) over w, '') as state, lead(conv_id) over w is null and lead(role) over w is null as last
  from c window w as (partition by conv_id order by turn nulls first, role, text)),
b as (select conv_id, min(no) as first_bad from o where not (case
    when no = 1 then role in ('system', 'user') when state in ('system', 'assistant') then role = 'user' when state = 'user' then role = 'assistant' else false end)
  or (last and role <> 'assistant') group by conv_id)
select c.conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(14 + length(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c'))
         + length(replace(replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c')))::bigint as formatted_chars,
  any_value(first_bad) is null as valid, any_value(first_bad)::bigint as first_bad
from c left join b on c.conv_id is not distinct from b.conv_id group by c.conv_id
"""


@register("op9_chat", _OP9)
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, digests of what is read back from the
    formatted text, and the turn automaton's verdict (valid, first_bad)."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    row = lambda no, role: F.struct(F.lit(PLANTED_ID).cast("long").alias("conv_id"), F.lit(no).cast("long").alias("turn"),
                                    F.lit(role).alias("role"), F.lit(PLANTED_TEXT).alias("text"))
    planted = spark.range(1).select(F.inline(F.array(row(0, "user"), row(1, "assistant"))))
    back = chat.read_back(chat.chat_documents(turns.unionByName(planted)))
    line = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    learned = F.concat_ws("", "learned")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(line, 256).alias("turns_sha256"),
                       F.char_length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"), "valid", "first_bad")


@register("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity join of all documents on five-word shingles at Jaccard 0.8."""
    return jaccard.similarity_join(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op11_sharding")
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into 24 shards of equal row counts."""
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return sharding.shuffle_into_shards(rows, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _repeated_tail(doc_id, text):
    """The text of every tenth document (by crc32 of its id) with its words from
    the a-th on replaced by the p words there, over and over; other texts as they are."""
    h = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    w = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size(w).cast("long"), F.floor(h / 10).cast("long")
    a = F.when(n > 0, g % F.greatest(n, F.lit(1)))
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    again = F.flatten(F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
    tail = F.slice(again, F.lit(1), (n - a).cast("int"))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " ")).otherwise(text)


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every whole text, and the text without their repeats."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", _repeated_tail(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.collapse_runs(docs)
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


_OP12 = r"""
with docs as (
  select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece from docs),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
totals as (select lang, sum(len(ws))::bigint as n from w group by lang),
grams as (select lang, m, ws[i:i + m - 1] as ws from (
  select lang, m, ws, unnest(range(1, len(ws) - m + 2)) as i from w cross join (select unnest(range(1, 6)) as m))),
freq as (select lang, m, ws, count(*) as f from grams group by lang, m, ws having count(*) >= 100),
cuts as (
  select c.lang, c.ws, c.m, c.f as a, k, x.f as l, y.f as r, n,
    ((1000::hugeint * c.f * n) // (x.f::hugeint * y.f))::bigint as score
  from freq c cross join (select unnest(range(1, 5)) as k) join totals using (lang)
  join freq x on x.lang = c.lang and x.ws = c.ws[1:k]
  join freq y on y.lang = c.lang and y.ws = c.ws[k + 1:]
  where c.m > 1 and k < c.m),
best as (select * from cuts qualify row_number() over (partition by lang, ws order by score, k) = 1),
longer as (
  select lang, ws[i:i + z - 1] as ws, max(f) as f from (
    select lang, ws, f, z, unnest(range(1, m - z + 2)) as i from freq cross join (select unnest(range(2, 5)) as z) where m > z)
  group by all),
kept as (select best.* from best left join longer using (lang, ws) where longer.f is null or 100 * longer.f < 100 * a),
named as (select lang, array_to_string(ws, ' ') as phrase, a, l, r, n, score from kept)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from named qualify rank <= 2000
"""


@register("op12_collocations", _OP12)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language by their weakest cut."""
    return phrases.collocations(_table(spark, sf_dir, "documents").select("text", "lang"))
