"""Queries of the training-data operators over the supplied tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.llm import chat, dialogue_repair, hash_ring, mixing, ngram_join, packing, prefix_counts, quality_votes, repeat_index
from rosterlens.llm import token_alignment, toxic_segments, vector_graph, warc

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.shingle_components(_table(spark, sf_dir, "documents"), size=5, percent=75)


def op2_repeat_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_index.repeat_digests(_table(spark, sf_dir, "documents"), length=200)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.chat_digests(rows.unionByName(probe))


def op4_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.98)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.prefix_token_counts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY), limit=512)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(_table(spark, sf_dir, "pages"), least=0)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_votes.quality(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                       "posterior")


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_segments.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_repair.repair_digests(dialogue_repair.damaged(_table(spark, sf_dir, "conversations")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_digests(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(PIECE_VOCABULARY))


def op13_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hash_ring.ring_shards(_table(spark, sf_dir, "documents"), shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard, op2_repeat_index, op3_chat_format, op4_vector_graph, op5_best_fit_packing, op6_token_counts, op7_warc,
    op8_source_mix, op9_quality_votes, op10_toxic_segments, op11_dialogue_repair, op12_token_alignment,
    op13_hash_ring, pipeline)}

_CHAT_MARKS = [("\\", "b"), *chat.CONTROL]


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _escaped_sql(column: str, line: bool) -> str:
    out = column
    for old, letter in _CHAT_MARKS:
        out = f"replace({out}, {_sql_text(old)}, {_sql_text(chr(92) + letter)})"
    if line:
        out = f"replace({out}, chr(10), {_sql_text(chr(92) + 'n')})"
    conflict = " or ".join(f"contains({c}, {_sql_text(s)})" for c in ("r", "t") for s, _ in _CHAT_MARKS)
    return f"(case when {conflict} or contains(r, chr(10)) then {out} else {column} end)"


_REACH = """reach(a, b) as (
  select a, b from link union select reach.a, link.b from reach join link on link.a = reach.b)"""

# The cheapest (cost, audit) of two or more, as DuckDB structs.
def _cheapest(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _edit(rest: str, initial: str, cost: str) -> str:
    return f"{{'c': {rest}.c + {cost}, 'a': '{initial}' || {rest}.a}}"


def _kept_sql(role: str, then: str) -> str:
    """Keep or rerole of row r to a state's next turn; impossible where the row must go."""
    never = "{'c': 1000000000000, 'a': 'Z'}"
    stay = f"case when r.gone then {never} when r.i = '{role}' then {_edit(then, 'K', 'r.more')} else {_edit(then, 'R', 'r.more + 1')} end"
    return stay


_DIALOGUE_SQL = f"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    encode(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')) as k from conversations
), hashed as (
  select *, xor(list_reduce(list_concat([4294967295::bigint],
    list_transform(range(octet_length(k)), lambda i: ('0x' || substr(hex(k), (2 * i + 1)::int, 2))::bigint)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::bigint) % 20 as h from keyed
), hurt as (
  select conv_id, turn, case when h = 4 then 'user' else role end as role,
    case when h = 1 then '' when h = 2 then translate(text, '.!?', '') else text end as text,
    unnest(range(case when h = 3 then 2 else 1 end)) as copy from hashed where h <> 0
), placed as (
  select *, row_number() over (partition by conv_id, role, text order by p) > 1 as again,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as last
  from (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as p from hurt)
), rows_ as (
  select conv_id, turn, role, text, p, left(role, 1) as i, last = '' as blank, last <> '' and again as duplicate,
    last not in ('', '.', '!', '?') and not again as cut, lag(left(role, 1)) over (partition by conv_id order by p) || left(role, 1) as pair
  from placed
), counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(blank) as blank,
    count_if(duplicate) as duplicate, count_if(cut) as truncated, count_if(pair not in ('su', 'ua', 'au')) as illegal
  from rows_ group by conv_id
), symbols as (
  select conv_id, p, i, blank or duplicate as gone, case when cut then 5 else 0 end as more from rows_
), walk as (
  select conv_id, n + 1 as p, {{'c': 0::bigint, 'a': ''}} as s0, {{'c': 10::bigint, 'a': 'II'}} as s1, {{'c': 5::bigint, 'a': 'I'}} as s2,
    {{'c': 0::bigint, 'a': ''}} as s3 from counts
  union all
  select conv_id, p, {_cheapest('b0', _edit('b2', 'I', '5'), _edit('b3', 'II', '10'))},
    {_cheapest('b1', _edit('b2', 'I', '5'), _edit('b3', 'II', '10'))}, {_cheapest('b2', _edit('b3', 'I', '5'))},
    {_cheapest('b3', _edit('b2', 'I', '5'))}
  from (select w.conv_id, r.p,
    {_cheapest(_edit('s0', 'D', '2'), _kept_sql('u', 's2'), "case when r.i = 's' and not r.gone then " + _edit('s1', 'K', 'r.more') + " else " + _edit('s0', 'D', '2') + " end")} as b0,
    {_cheapest(_edit('s1', 'D', '2'), _kept_sql('u', 's2'))} as b1, {_cheapest(_edit('s2', 'D', '2'), _kept_sql('a', 's3'))} as b2,
    {_cheapest(_edit('s3', 'D', '2'), _kept_sql('u', 's2'))} as b3
    from walk w join symbols r on r.conv_id is not distinct from w.conv_id and r.p = w.p - 1)
), best as (select conv_id, s0.c as cost, s0.a as audit from walk where p = 1
), letters as (
  select conv_id, audit[k] as l, len(replace(audit[:k], 'I', '')) as p, len(replace(audit[:k], 'D', '')) as f
  from (select conv_id, audit, unnest(range(1, len(audit) + 1)) as k from best)
), joined as (
  select l.conv_id, l.l, l.f, r.role, case when l.l = 'I' then '' else r.text end as text,
    max(l.l = 'K' and l.f = 1 and r.i = 's') over (partition by l.conv_id) as has
  from letters l left join rows_ r on r.conv_id is not distinct from l.conv_id and r.p = l.p where l.l <> 'D'
), repaired as (
  select conv_id, sha256(string_agg(case when l = 'K' then role when f % 2 = has::int then 'assistant' else 'user' end || ':' || text,
    chr(10) order by f)) as h from joined group by conv_id
), ids as (select distinct conv_id from conversations)
select ids.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost,
  coalesce(audit, '') as audit, coalesce(h, sha256('')) as repaired_sha256
from ids left join counts c on c.conv_id is not distinct from ids.conv_id left join best b on b.conv_id is not distinct from ids.conv_id
left join repaired d on d.conv_id is not distinct from ids.conv_id"""

ORACLE = {
    "op11_dialogue_repair": _DIALOGUE_SQL,
    "op1_ngram_jaccard": f"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w from documents
), shingle as (
  select distinct doc_id, unnest(case when len(w) >= 5
    then list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i+4], 'string_agg', ' '))
    when len(w) > 0 then [list_aggregate(w, 'string_agg', ' ')] else [] end) as g from words
), size as (select doc_id, count(*) as n from shingle group by doc_id
), common as (
  select x.doc_id as a, y.doc_id as b, count(*) as o from shingle x join shingle y on x.g = y.g and x.doc_id <> y.doc_id
  group by x.doc_id, y.doc_id
), link as (
  select a, b from common join size s on s.doc_id = a join size t on t.doc_id = b where 100 * o >= 75 * (s.n + t.n - o)
), {_REACH}
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) as component_id
from documents d left join size s on s.doc_id = d.doc_id
left join (select a, min(b) as low from reach group by a) m on m.a = d.doc_id""",
    "op3_chat_format": f"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as t from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized as (
  select *, 3 + length({_escaped_sql('r', True)}) + 1 + length({_escaped_sql('t', False)}) + 4
    + case when r = 'assistant' then 0 when r = 'system' then 17 else 15 end as chars from rows_
)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn, r, t)) as turns_sha256,
  coalesce(sum(length(t)) filter (r = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(t, '' order by turn, r, t) filter (r = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from sized group by conv_id""",
    "op4_vector_graph": f"""
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
    and list_bool_or(list_transform(embedding, lambda x: x <> 0))
), link as (
  select x.vec_id as a, y.vec_id as b from v x join v y on x.label = y.label and x.vec_id <> y.vec_id and len(x.e) = len(y.e)
  where list_cosine_similarity(x.e, y.e) >= 0.98
), {_REACH}
select e.vec_id, coalesce(l.n, 0)::bigint as n_links, least(e.vec_id, coalesce(m.low, e.vec_id)) as component_id,
  e.vec_id = least(e.vec_id, coalesce(m.low, e.vec_id)) as kept
from embeddings e left join (select a, count(*) as n from link group by a) l on l.a = e.vec_id
left join (select a, min(b) as low from reach group by a) m on m.a = e.vec_id""",
    "op7_warc": """
with p as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages
), d as (
  select *, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (5 * i + 1)::int, 5))::bigint >> s) & 31) + 1)::int, 1)), '')), '')
    as payload_digest, max(page_id) over (partition by h) as last from p
)
select page_id, payload_bytes, payload_digest, case when page_id = last then 'response' else 'revisit' end as record_type,
  case when page_id <> last then last end as refers_to from d""",
}
