"""Queries of the training-data operators and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, word_count

#: Fixed values of the URL query: (verdict, host and path).
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]

_WORDS = r"[^\x20\x09-\x0D]+"


def op1_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .itq_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


OP1_SQL = r"""
with recursive e as (
  select vec_id, cast(embedding as double[]) as v from embeddings),
g as (
  select vec_id, v from e
  where v is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(v, lambda x: x <> 0)) > 0),
l as (
  select a.vec_id as a, b.vec_id as b from g a join g b
    on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9),
reach(vec_id, root) as (
  select vec_id, vec_id from e
  union
  select l.b, reach.root from reach join l on l.a = reach.vec_id where reach.root < l.b),
n as (select a as vec_id, count(*) as n_links from l group by a),
c as (select vec_id, min(root) as component_id from reach group by vec_id)
select c.vec_id, cast(coalesce(n_links, 0) as bigint) as n_links, component_id, c.vec_id = component_id as kept
from c left join n on c.vec_id = n.vec_id
"""


def op2_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .weighted_sampling import edited_fingerprints

    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_rules import judge_urls

    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    out = judge_urls(table(spark, sf_dir, "pages"), labels, URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", "confidence")


def op4_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_runs import drop_common_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_common_lines(docs, min_docs=10, min_chars=1).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
with split as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select doc_id, pos, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from split),
common as (select k from keyed where length(k) >= 1 group by k having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(common.k) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where common.k is null), '')) as kept_sha256
from keyed left join common on keyed.k = common.k
group by doc_id
"""


def op5_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .crf_quality import fold_of, score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, field).select(
        "row.doc_id", (fold_of(F.col("row.doc_id")) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_archives, write_archives

    files = write_archives(table(spark, sf_dir, "pages"), min_bytes=0)
    return read_archives(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# DuckDB has sha1 as hex; base 32 takes 5 bits at a time from the 160.
OP6_SQL = r"""
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
d as (
  select page_id, octet_length(payload) as payload_bytes, payload,
         max(page_id) over (partition by payload) as keeper
  from p),
h as (select *, cast(cast(from_hex(sha1(payload)) as bit) as varchar) as bits from d)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
       array_to_string([
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + 16 * cast(bits[5 * i + 1] as int) + 8 * cast(bits[5 * i + 2] as int)
                  + 4 * cast(bits[5 * i + 3] as int) + 2 * cast(bits[5 * i + 4] as int)
                  + cast(bits[5 * i + 5] as int), 1) for i in range(32)], '') as payload_digest,
       case when page_id = keeper then 'response' else 'revisit' end as record_type,
       case when page_id <> keeper then keeper end as refers_to
from h
"""


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_piece_bpe(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    from .piece_bpe import token_digests

    return token_digests(table(spark, sf_dir, "documents"), model_path or tokenizer("piece_bpe_32k.model"))


def op9_token_counts(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    import public_tokenizers

    from .token_scan import byte_bpe_encoder, document_token_counts

    encoder = byte_bpe_encoder(ranks_path or tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return document_token_counts(table(spark, sf_dir, "documents"), encoder, end_id=50256)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), width=5, percent=75)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import cyclic_weights, mix

    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.array("source").alias("sources"), word_count(F.col("text")).alias("size"))
    one = F.col("stats")[0]
    return mix(docs, cyclic_weights, share=1.5, most=2, seed=17).select(
        "doc_id", "size", one["words"].alias("source_size"), one["target"].alias("target"),
        (F.col("size") * F.col("copies")).alias("taken"), "copies")


# Sources fill in the order of size over weight: source i is at its cap when its
# cap over weight is at most what is left over the weights left.
OP8_SQL = r"""
with d as (
  select doc_id, source, md5('17:' || coalesce(cast(doc_id as varchar), '')) as ord,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents),
s as (
  select source, sum(size)::bigint as words,
         [3, 1, 2][1 + (row_number() over (order by encode(source) nulls last) - 1) % 3] as w,
         row_number() over (order by encode(source) nulls last) as r
  from d group by source),
f as (
  select *, 2.0::double * words / w as ratio,
         (1.5::double * sum(words) over ()
          - coalesce(sum(2.0::double * words) over (order by 2.0::double * words / w, r rows between unbounded preceding and 1 preceding), 0)) as left_over,
         sum(w) over () - coalesce(sum(w) over (order by 2.0::double * words / w, r rows between unbounded preceding and 1 preceding), 0) as left_w
  from s),
g as (select *, ratio <= left_over / left_w as capped from f),
e as (select *, min(case when not capped then struct_pack(ratio := ratio, r := r, lo := left_over, lw := left_w) end) over () as stop from g),
t as (
  select source, words, w, ratio, case when capped then 2.0::double * words else stop.lo * w / stop.lw end as target
  from e),
q as (select *, cast(round_even(target, 0) as bigint) as quota from t),
c as (
  select d.*, q.words, q.target,
         case when q.words > 0 then q.quota // q.words else 0 end as whole,
         case when q.words > 0 then q.quota % q.words else 0 end as rest,
         coalesce(sum(d.size) over (partition by d.source order by ord, doc_id, size rows between unbounded preceding and 1 preceding), 0) as before
  from d join q on d.source is not distinct from q.source)
select doc_id, size, words as source_size, target,
       cast(size * (whole + case when rest > 0 and 2 * before + size <= 2 * rest then 1 else 0 end) as bigint) as taken,
       cast(whole + case when rest > 0 and 2 * before + size <= 2 * rest then 1 else 0 end as bigint) as copies
from c
"""

def op11_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversation_repair import damaged_and_repaired

    return damaged_and_repaired(table(spark, sf_dir, "conversations"))


# The same repair from left to right: the least (cost, audit, lines) for each state after each row. States: 0 nothing
# yet, 1 after s, 2 after u, 3 after a. DuckDB has no crc32: a byte at a time, with 8 shifts for each.
OP11_SQL = r"""
with recursive c as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(
           list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
                          lambda x: cast(ord(x) as bigint)),
           lambda h, x: list_reduce(range(8), lambda v, k: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, xor(h, x)),
           cast(4294967295 as bigint)), 4294967295) % 20 as harm
  from conversations),
d as (
  select conv_id, turn, case when harm = 4 then 'user' else role end as role,
         case harm when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from c, range(case harm when 0 then 0 when 3 then 2 else 1 end)),
o as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
         left(role, 1) as ini, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?') as unended
  from d),
r as (
  select *, not blank and row_number() over (partition by conv_id, role, text order by pos) > 1 as dup,
         lag(ini) over (partition by conv_id order by pos) as before
  from o),
step(p, role, q) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
added(p, q, lines) as (
  values (0, 0, cast([] as varchar[])), (1, 1, []), (2, 2, []), (3, 3, []), (0, 2, ['user:']), (1, 2, ['user:']),
         (3, 2, ['user:']), (2, 3, ['assistant:']), (0, 3, ['user:', 'assistant:']), (1, 3, ['user:', 'assistant:'])),
e as (
  select r.conv_id, pos, p, p as q, 2 as cost, 'D' as audit, cast([] as varchar[]) as lines from r, (select unnest(range(4)) as p)
  union all
  select r.conv_id, pos, p, q, case when unended then 5 else 0 end, 'K', [r.role || ':' || text] from r join step on ini = step.role
  where not blank and not dup
  union all
  select r.conv_id, pos, p, q, case when unended then 6 else 1 end, 'R',
         [case step.role when 'u' then 'user' else 'assistant' end || ':' || text] from r, step
  where not blank and not dup and step.role <> 's'),
f as (
  select conv_id, pos, e.p, added.q, {'cost': cast(cost + 5 * len(added.lines) as bigint),
         'audit': audit || repeat('I', len(added.lines)), 'lines': list_concat(e.lines, added.lines)} as way
  from e join added on e.q = added.p),
dp as (
  select conv_id, cast(0 as bigint) as pos, q,
         {'cost': cast(5 * len(lines) as bigint), 'audit': repeat('I', len(lines)), 'lines': lines} as best
  from (select distinct conv_id from d), added where p = 0
  union all
  select conv_id, pos, q, min(best) from (
    select f.conv_id, f.pos, f.q, {'cost': best.cost + way.cost, 'audit': best.audit || way.audit,
                                   'lines': list_concat(best.lines, way.lines)} as best
    from dp join f on dp.conv_id is not distinct from f.conv_id and f.pos = dp.pos + 1 and f.p = dp.q)
  group by conv_id, pos, q),
n as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (where blank) as blank, count(*) filter (where dup) as duplicate,
         count(*) filter (where not blank and not dup and unended) as truncated,
         count(*) filter (where before is not null and before || ini not in ('su', 'ua', 'au')) as illegal
  from r group by conv_id),
b as (
  select n.conv_id, min(best) as best from n join dp on n.conv_id is not distinct from dp.conv_id and n.n = dp.pos
  where dp.q in (0, 3) group by n.conv_id)
select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0) as cost,
       coalesce(best.audit, '') as audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) i
left join n on i.conv_id is not distinct from n.conv_id left join b on i.conv_id is not distinct from b.conv_id
"""

def op12_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rule_ledger import BASE, DEFAULT, apply_policy, build_ledger

    ledger = build_ledger(table(spark, sf_dir, "documents"))
    judged = apply_policy(apply_policy(ledger, BASE, "passed"), DEFAULT)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~F.col("passed")).alias("base_failed"), "kept", "failed")


OP12_SQL = r"""
with t as (select row_number() over () as id, doc_id, coalesce(text, '') as text from documents),
w as (select id, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words, string_split(text, chr(10)) as lines from t),
m as (
  select *, cast(len(words) as bigint) as n_words, cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as full_lines,
         len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) as n_letter_words,
         len(list_filter(words, lambda x: regexp_matches(x, '[A-Z]') and not regexp_matches(x, '[a-z]|[^\x00-\x7F]'))) as n_capital_words
  from w),
g as (
  select id, i, words[i:i + 2] as three from (select id, words, unnest(range(1, len(words) - 1)) as i from m)),
c as (select id, unnest([i, i + 1, i + 2]) as i from (select id, i, count(*) over (partition by id, three) as n from g) where n > 1),
r as (select id, count(distinct i) as n from c group by id),
a as (
  select doc_id, n_words, word_chars, n_symbols, cast(len(full_lines) - len(list_distinct(full_lines)) as bigint) as n_dup_lines,
         cast(coalesce(r.n, 0) as bigint) as n_repeat_words, n_letter_words, n_capital_words, cast(len(full_lines) as bigint) as n_lines,
         len(list_filter(full_lines, lambda x: regexp_matches(x, '[.!?"][\x20\x09-\x0D]*$'))) as n_ended_lines
  from m left join r on m.id = r.id),
b as (
  select *, case when n_words < 50 then 1 else 0 end + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
    + case when word_chars < 3 * n_words then 4 else 0 end + case when word_chars > 10 * n_words then 8 else 0 end
    + case when 10 * n_symbols > n_words then 16 else 0 end + case when 2 * n_capital_words > n_words then 32 else 0 end
    + case when 10 * n_letter_words < 8 * n_words then 64 else 0 end + case when 2 * n_dup_lines > n_lines then 128 else 0 end
    + case when 10 * n_dup_lines > 3 * n_lines then 256 else 0 end + case when 100 * n_ended_lines < 12 * n_lines then 512 else 0 end
    + case when n_words > 100000 then 1024 else 0 end as failed
  from a)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 as base_failed,
       failed & 255 = 0 as kept, cast(failed as bigint) as failed
from b
"""

def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrase_mining import collocations

    return collocations(table(spark, sf_dir, "documents"), least=100, top=2000)


OP13_SQL = r"""
with t as (
  select row_number() over () as id, coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
p as (select id, lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from t),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
x as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, (select unnest(range(1, 6)) as k) where len(w) >= k)),
f as (select lang, k, phrase, count(*) as f from x group by all),
n as (select lang, sum(f) as n from f where k = 1 group by lang),
c as (select lang, k, phrase, string_split(phrase, ' ') as w, f as a from f where f >= 100 and k >= 2),
cut as (
  select c.lang, c.phrase, c.a, j, l.f as l, r.f as r, n.n,
         cast(1000 as hugeint) * c.a * n.n // (cast(l.f as hugeint) * r.f) as score
  from (select *, unnest(range(1, k)) as j from c) c
  join f l on l.lang = c.lang and l.k = j and l.phrase = array_to_string(w[1:j], ' ')
  join f r on r.lang = c.lang and r.k = c.k - j and r.phrase = array_to_string(w[j + 1:], ' ')
  join n on n.lang = c.lang),
worst as (select *, row_number() over (partition by lang, phrase order by score, j) as pick from cut),
inner_ as (
  select distinct s.lang, s.phrase from c s join c g on s.lang = g.lang and g.k > s.k and g.a >= s.a
    and contains(' ' || g.phrase || ' ', ' ' || s.phrase || ' ')),
kept as (
  select * from worst where pick = 1 and not exists (
    select 1 from inner_ where inner_.lang = worst.lang and inner_.phrase = worst.phrase)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
       cast(n as bigint) as n, cast(score as bigint) as score
from ranked where rank <= 2000
"""

QUERIES: dict[str, tuple] = {
    "op1_itq_dedup": (op1_itq_dedup, OP1_SQL),
    "op2_weighted_sampling": (op2_weighted_sampling, None),
    "op3_url_rules": (op3_url_rules, None),
    "op4_line_runs": (op4_line_runs, OP4_SQL),
    "op5_crf_quality": (op5_crf_quality, None),
    "op6_warc": (op6_warc, OP6_SQL),
    "op7_piece_bpe": (op7_piece_bpe, None),
    "op8_source_mix": (op8_source_mix, OP8_SQL),
    "op10_ngram_join": (op10_ngram_join, None),
    "op9_token_counts": (op9_token_counts, None),
    "op11_cyk_repair": (op11_cyk_repair, OP11_SQL),
    "op12_rule_ledger": (op12_rule_ledger, OP12_SQL),
    "op13_phrase_mining": (op13_phrase_mining, OP13_SQL),
}


def queries() -> dict:
    return {name: fn for name, (fn, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
