"""Registered queries of the operators, and their independent SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import (
    backoff_lm,
    burst_trie,
    chat,
    decontaminate,
    hard_negatives,
    jaccard_join,
    language_crf,
    mixing,
    repetition,
    sharding,
    simhash,
    token_file,
    toxicity,
)
from riskweave.llm.tables import table
from riskweave.session import cut_lineage

WORDS_SQL = r"""regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"""
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_language_crf(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned outside the held-out fifth."""
    return language_crf.identify(table(spark, folder, "documents"))


def op2_suffix_repetition(spark: SparkSession, folder: str) -> DataFrame:
    """Repetition counts and verdict of every document."""
    found = repetition.judge(table(spark, folder, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept", "covered_words")


# Words that repeats of k words or more cover are those in k-word windows that occur twice; a repeat of more than 50 words
# exists if a window of 51 occurs twice.
OP2_SQL = f"""
with w as (select doc_id, coalesce(text, '') as t, {WORDS_SQL.format(text="coalesce(text, '')")} as w from documents),
g as (
  select doc_id, k, i, w[i : i + k - 1] as run
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from w, (values (5), (6)) as s(k))),
six as (select doc_id, 6 as k, i from g where k = 6 qualify count(*) over (partition by doc_id, run) > 1),
h as (
  select doc_id, 51 as k, i, w[i : i + 50] as run
  from (select doc_id, w, unnest(range(1, len(w) - 49)) as i from w where doc_id in (select doc_id from six))),
r as (
  select * from six union all select doc_id, k, i from g where k = 5 qualify count(*) over (partition by doc_id, run) > 1
  union all select doc_id, k, i from h qualify count(*) over (partition by doc_id, run) > 1),
c as (
  select doc_id, count(distinct i + o) filter (k = 5 and o < 5) as five, count(distinct i + o) filter (k = 6 and o < 6) as six,
    count(*) filter (k = 51) as long
  from r, range(6) as s(o) group by doc_id),
l as (
  select doc_id, count(*) as n_dup_lines from (
    select doc_id, line, row_number() over (partition by doc_id, line) as nth from (select doc_id, unnest(string_split(t, chr(10))) as line from w))
  where nth > 1 and regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
m as (
  select w.doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(five, 0) as n_repeat_words, coalesce(six, 0) as covered_words, coalesce(long, 0) as long
  from w left join c using (doc_id) left join l using (doc_id))
select * exclude (long), n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and 100 * covered_words <= 15 * n_words and long = 0 as kept
from m
"""


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a similarity of 0.9 or more."""
    return jaccard_join.jaccard_components(table(spark, folder, "documents"), k=3, num=90, den=100)


OP5_SQL = f"""
with recursive w as (select doc_id, {WORDS_SQL.format(text=LOWER_SQL)} as w from documents),
s as (
  select distinct doc_id, unnest(case
    when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as shingle
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (
  select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.shingle = y.shingle and x.doc_id < y.doc_id
  group by all),
l as (
  select p.a, p.b from p join n na on na.doc_id = p.a join n nb on nb.doc_id = p.b
  where 100 * p.c >= 90 * (na.n + nb.n - p.c)),
e as (select a, b from l union select b, a from l),
reach(a, b) as (select a, b from e union select reach.a, e.b from reach join e on reach.b = e.a)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least(w.doc_id, coalesce(r.low, w.doc_id)) as component_id
from w left join n using (doc_id) left join (select a as doc_id, min(b) as low from reach group by a) r using (doc_id)
"""

def op3_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard and slot, by equal bytes along the curve."""
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    placed = sharding.assign(table(spark, folder, "documents"))
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown, "curve")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item: one row per document and item."""
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mixing.mix(table(spark, folder, "documents")).drop("slots")


# What a source gives is the beginning of its repeated, shuffled stream, up to its quota.
OP6_SQL = f"""
with d as (
  select doc_id, source, len({WORDS_SQL.format(text="coalesce(text, '')")}) as size, md5(coalesce(doc_id::varchar, '')) as place
  from documents),
s as (
  select source, sum(size)::bigint as source_size, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight
  from d group by source),
f as (
  select *, (sum(source_size) over ())::bigint as total, (3 * source_size)::double / weight as full_at,
    coalesce(sum(3 * source_size) over (order by (3 * source_size)::double / weight, source nulls last
      rows between unbounded preceding and 1 preceding), 0)::bigint as filled,
    (sum(weight) over (order by (3 * source_size)::double / weight, source nulls last
      rows between current row and unbounded following))::bigint as open_weight
  from s),
l as (select max((total - filled)::double / open_weight) as level from f where (total - filled)::double / open_weight <= full_at),
t as (select source, source_size, least(3 * source_size, coalesce(level, 0) * weight)::double as target from f, l),
p as (
  select d.*, coalesce(sum(size) over (partition by source order by place, size rows between unbounded preceding and 1 preceding), 0)
    as start
  from d)
select p.doc_id, p.source, p.size, t.source_size, t.target,
  (select sum(least(start + size + e * source_size, round(target)) - least(start + e * source_size, round(target)))
   from range(3) r(e))::bigint as taken
from p join t on p.source is not distinct from t.source
"""


def op7_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """Place and checksum of every document's token ids, read back from packed files."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return token_file.encoded_documents(table(spark, folder, "documents"), path, end_id=2, vocabulary=49_408)


def op8_backoff_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Stupid-backoff score of every document under the trigram counts of all the others."""
    found = backoff_lm.scores(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", F.round("log_score", 6).alias("log_score"), F.round("score", 9).alias("score"))


OP8_SQL = f"""
with w as (
  select doc_id, unnest(w) as c, unnest(range(1, len(w) + 1)) as i from (select doc_id, {WORDS_SQL.format(text=LOWER_SQL)} as w from documents)),
g as (
  select *, lag(c) over o as b, lag(c, 2) over o as a, count(*) over () - count(*) over (partition by doc_id) as others
  from w window o as (partition by doc_id order by i)),
n as (
  select *, count(*) over (partition by c) - count(*) over (partition by doc_id, c) as n1,
    count(*) over (partition by b, c) - count(*) over (partition by doc_id, b, c) as n2,
    count(*) over (partition by a, b, c) - count(*) over (partition by doc_id, a, b, c) as n3
  from g),
p as (select *, lag(n1) over o as m1, lag(n2) over o as m2 from n window o as (partition by doc_id order by i)),
s as (
  select doc_id, case
    when i > 2 and n3 > 0 then ln(n3 / m2)
    when i > 1 and n2 > 0 then ln(n2 / m1) + (least(i - 1, 2) - 1) * ln(0.4)
    else ln(greatest(n1, 1) / greatest(others, 1)) + least(i - 1, 2) * ln(0.4) end as x
  from p),
t as (select doc_id, count(*) as n_words, sum(x) as total from s group by doc_id)
select doc_id, coalesce(n_words, 0) as n_words, round(total, 6) as log_score, round(total / n_words, 9) as score
from documents left join t using (doc_id)
"""


def op9_chat_examples(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every conversation, read back from its examples; conversation -7 says control strings."""
    said = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    odd = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    return chat.read_back(chat.examples(rows))


OP9_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f as (
  select *, length('### : </turn>' || chr(10)) + length(role)
    + length(replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>')) as chars
  from c),
e as (
  select *, sum(chars) over (partition by conv_id order by turn, role, text rows unbounded preceding) as so_far,
    row_number() over (partition by conv_id order by turn desc, role desc, text desc) = 1 as last
  from f)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  (sum(so_far) filter (role = 'assistant' or last))::bigint as formatted_chars
from e group by conv_id
"""


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels outside the held-out fifth."""
    return toxicity.predict(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_burst_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, each rebuilt on the first turns of its family's first one."""
    placed = cut_lineage(burst_trie.positions(table(spark, folder, "conversations")))
    return burst_trie.trie(*burst_trie.with_shared_heads(placed))


# crc32 bit by bit: every byte is mixed in and shifted out by eight steps, which the -1 stand for.
OP11_SQL = f"""
with t as (
  select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p
  from conversations where conv_id is not null),
k as (
  select c, c - c % 20 as b, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, flatten(list_transform(string_split(c::varchar, ''), lambda y: [ascii(y)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, y: case when y >= 0 then xor(a, y) when a % 2 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) % 4 as h
  from (select distinct c from t)),
z as (
  select k.c, t.p as o, r, x from k join t on t.c = k.b and t.p <= k.h
  union all select k.c, t.p + 3, r, x from k join t on t.c = k.c and t.p > k.h),
s as (select c, row_number() over (partition by c order by o) as d, r, x from z),
q as (
  select c, d, list([r, x]) over (partition by c order by d rows unbounded preceding) as path, len({WORDS_SQL.format(text="x")}) as w from s
  union all select c, 0, []::varchar[][], 0 from k),
l as (select c, max(d) as d from q group by c),
n as (select path, d, min(c) as conv_id, count(*) as n_convs, min(w) as w from q group by path, d),
e as (select path, sha256(string_agg(c::varchar, ',' order by c)) as ends_sha256 from q join l using (c, d) group by path),
g as (select list_slice(path, 1, d - 1) as path, count(*) as n_children from n where d > 0 group by 1),
u as (
  select q.path, sum((n_convs - 1) * n.w)::bigint as saved_tokens, count(*) filter (g.n_children is null) as n_leaves
  from n left join g using (path) join q on q.c = n.conv_id and q.d <= n.d group by q.path)
select n.conv_id, n.d as depth, f.conv_id as parent_conv_id, n.n_convs, coalesce(g.n_children, 0) as n_children, u.n_leaves,
  u.saved_tokens, coalesce(e.ends_sha256, sha256('')) as ends_sha256
from n join u using (path) left join g using (path) left join e using (path)
  left join n f on n.d > 0 and f.path = list_slice(n.path, 1, n.d - 1)
"""


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The best negatives in the score window of each anchor's positives; every seventh row carries a wrong label."""
    label = F.col("label").cast("long")
    wrong = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = table(spark, folder, "embeddings").select("vec_id", wrong.alias("label"), "embedding")
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


OP12_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select a.vec_id as anchor_id, c.vec_id, c.label = a.label as same, list_dot_product(a.q, c.q)::bigint as score
  from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id,
  (row_number() over (partition by anchor_id, positive_id order by s.score desc, s.vec_id))::int as rank,
  s.vec_id as negative_id, positive_score, s.score as negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score
qualify rank <= 10
"""


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document, by links of four bits or fewer."""
    return simhash.near_components(table(spark, folder, "documents"))


QUERIES = {
    "op1_language_crf": op1_language_crf,
    "op2_suffix_repetition": op2_suffix_repetition,
    "op3_hilbert_shards": op3_hilbert_shards,
    "op4_decontaminate": op4_decontaminate,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_mix": op6_mix,
    "op7_token_file": op7_token_file,
    "op8_backoff_lm": op8_backoff_lm,
    "op9_chat_examples": op9_chat_examples,
    "op10_toxicity": op10_toxicity,
    "op11_burst_trie": op11_burst_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_simhash": op13_simhash,
}


def sql() -> dict[str, str]:
    return {
        "op2_suffix_repetition": OP2_SQL,
        "op5_jaccard_join": OP5_SQL,
        "op6_mix": OP6_SQL,
        "op8_backoff_lm": OP8_SQL,
        "op9_chat_examples": OP9_SQL,
        "op11_burst_trie": OP11_SQL,
        "op12_hard_negatives": OP12_SQL,
    }
