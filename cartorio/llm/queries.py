"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.llm import decontam, line_dedup, media, merkle, ngram_join, packing, quality, quality_rules, secrets, spelling, suffix_dedup, tokens, toxicity
from cartorio.llm.frames import load
from cartorio.llm.labelled import fold

#: A document is taken for label 1 from this score on.
LEAST_SCORE = 0.3


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(load(spark, sf_dir, "documents"))


OP1_SQL = r"""
with recursive doc as (
  select doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
shingle as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from doc where len(w) > 0)),
size as (select doc_id, count(*) as n from shingle group by doc_id),
pair as (select a.doc_id as x, b.doc_id as y, count(*) as k from shingle a join shingle b on a.s = b.s and a.doc_id <> b.doc_id group by all),
link as (select x, y from pair join size p on p.doc_id = x join size q on q.doc_id = y where 9 * k >= 4 * (p.n + q.n)),
reach(doc_id, root) as (select doc_id, doc_id from doc union select l.y, r.root from reach r join link l on r.doc_id = l.x),
class as (select doc_id, min(root) as class_id from reach group by doc_id),
degree as (select x as doc_id, count(distinct b.text) as n_links from link join doc a on a.doc_id = x join doc b on b.doc_id = y where a.text <> b.text group by x)
select doc_id, class_id, coalesce(n_links, 0) as n_links from class left join degree using (doc_id)
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(load(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


OP3_SQL = r"""
with line as (select doc_id, text, string_split(text, chr(10)) as l from documents),
win as (
  select doc_id, pos, array_to_string(l[pos + 1 : pos + 3], chr(10)) as content
  from (select doc_id, l, unnest(range(0, len(l) - 2)) as pos from line where len(l) >= 3)),
later as (
  select doc_id, pos from (
    select doc_id, pos, row_number() over (partition by content order by doc_id, pos) as n from win where length(trim(translate(content, chr(10) || chr(13) || chr(9), ''))) > 0)
  where n > 1),
gone as (select distinct doc_id, unnest(range(pos, pos + 3)) as k from later),
one as (select doc_id, unnest(l) as content, unnest(range(0, len(l))) as k from line),
kept as (
  select o.doc_id, count(*) filter (g.k is not null) as n_removed, coalesce(string_agg(o.content, chr(10) order by o.k) filter (g.k is null), '') as kept
  from one o left join gone g on o.doc_id = g.doc_id and o.k = g.k group by o.doc_id)
select line.doc_id, cast(coalesce(len(l), 0) as bigint) as n_lines, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  case when text is null then null else sha256(coalesce(kept, '')) end as kept_sha256
from line left join kept using (doc_id)
"""


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    out = quality.score(docs, quality.train(docs, labels))
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP5_SQL = r"""
with doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (
  select distinct item_id, least(13, len(w)) as n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') as words
  from (select item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from item where len(w) > 0)),
place as (
  select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as words
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from doc, (select distinct n from win) where len(w) >= n)),
hit as (select doc_id, item_id, i, p.n from place p join win v on p.words = v.words and p.n = v.n),
covered as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from hit) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct doc_id, cast(item_id as varchar) as id from hit) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc d left join covered using (doc_id) left join named using (doc_id)
"""


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


OP6_SQL = """
with doc as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
piece as (select doc_id, n, base, substr(h, 2 * base + 1, 2 * 177) as p from (select doc_id, h, n, unnest(range(0, n - 49, 128)) as base from doc where n >= 50)),
win as (select doc_id, base + j as i, substr(p, 2 * j + 1, 100) as s from (select doc_id, base, p, unnest(range(0, least(128, n - 49 - base))) as j from piece)),
first as (select s, min(doc_id) as least from win group by s),
hit as (select doc_id, i from win join first using (s) where least < doc_id),
mark as (select doc_id, i, case when i <= 50 + lag(i) over (partition by doc_id order by i) then 0 else 1 end as fresh from hit),
part as (select doc_id, i, sum(fresh) over (partition by doc_id order by i) as span from mark),
span as (select doc_id, min(i) as a, max(i) + 50 as z from part group by doc_id, span),
gap as (select doc_id, a, z, coalesce(lag(z) over (partition by doc_id order by a), 0) as since from span),
cut as (select doc_id, sum(z - a) as n_removed, count(*) as n_spans, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' order by a) || substr(any_value(h), 2 * max(z) + 1) as rest
  from gap join doc using (doc_id) group by doc_id)
select d.doc_id, cast(n as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(rest, h))) as kept_sha256
from doc d left join cut using (doc_id)
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    out = toxicity.score(docs, toxicity.train(docs, labels))
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media.read_back(media.store(load(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(load(spark, sf_dir, "documents")))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(load(spark, sf_dir, "documents"), merkle.one_more()).withColumnRenamed("proof", "proof_sha256")


OP11_SQL = """
with recursive
bits(i, k, c) as (select i, 0, i from range(256) r(i) union all select i, k + 1, case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end from bits where k < 8),
crc as (select list(c order by i) as crcs from bits where k = 8),
field as (
  select doc_id, lang, n_chars, xor(list_reduce([4294967295] || list_transform(range(1, len(doc_id::varchar) + 1), lambda j: ascii(substr(doc_id::varchar, j, 1))::bigint),
      lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255) + 1])), 4294967295) as crc,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as before,
    coalesce(strlen(text) || ':' || text, '-') as after
  from documents, crc),
leaf as (
  select doc_id, lang, sha256(before || coalesce(len(n_chars::varchar) || ':' || n_chars, '-') || after) as leaf,
    sha256(before || coalesce(len((n_chars + (crc % 7 = 0)::int)::varchar) || ':' || (n_chars + (crc % 7 = 0)::int), '-') || after) as claimed,
    row_number() over (partition by lang order by doc_id) - 1 as idx, count(*) over (partition by lang) as n from field),
node(lang, level, idx, n, h) as (
  select lang, 0, idx, n, leaf from leaf
  union all select lang, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' order by idx)) from node where n > 1 group by lang, level, idx // 2, n),
sub as (select lang, h, row_number() over (order by lang nulls first) - 1 as idx, count(*) over () as n from node where n = 1),
top(level, idx, n, h) as (
  select 0, idx, n, h from sub
  union all select level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' order by idx)) from top where n > 1 group by level, idx // 2, n),
climb(doc_id, lang, level, idx, folded, proof) as (
  select doc_id, lang, 0, idx, claimed, '' from leaf
  union all
  select c.doc_id, c.lang, c.level + 1, c.idx // 2, sha256(case c.idx % 2 when 0 then folded || coalesce(s.h, '') else s.h || folded end), proof || coalesce(s.h, '')
  from climb c join node o on o.lang is not distinct from c.lang and o.level = c.level and o.idx = c.idx and o.n > 1
  left join node s on s.lang is not distinct from c.lang and s.level = c.level and s.idx = xor(c.idx, 1)),
reached as (select * from climb qualify row_number() over (partition by doc_id order by level desc) = 1),
up(doc_id, level, idx, folded, proof) as (
  select doc_id, 0, sub.idx, folded, proof from reached join sub on sub.lang is not distinct from reached.lang
  union all
  select c.doc_id, c.level + 1, c.idx // 2, sha256(case c.idx % 2 when 0 then folded || coalesce(s.h, '') else s.h || folded end), proof || coalesce(s.h, '')
  from up c join top o on o.level = c.level and o.idx = c.idx and o.n > 1 left join top s on s.level = c.level and s.idx = xor(c.idx, 1)),
ended as (select * from up qualify row_number() over (partition by doc_id order by level desc) = 1)
select doc_id, leaf, sub.h as subroot, root.h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = root.h as verified
from leaf join sub on sub.lang is not distinct from leaf.lang join ended using (doc_id), (select h from top where n = 1) root
"""


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(load(spark, sf_dir, "documents"))
    return out.select("doc_id", *(f"_rules.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


OP12_SQL = r"""
with doc as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from documents),
win as (select doc_id, i, array_to_string(w[i : i + 4], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from doc where len(w) >= 5)),
again as (select doc_id, i from win qualify count(*) over (partition by doc_id, s) > 1),
covered as (select doc_id, count(distinct k) as n from (select doc_id, unnest(range(i, i + 5)) as k from again) group by doc_id),
stat as (
  select doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols,
    len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n, 0) as n_repeat_words, len(l) as n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) as n_bullet_lines, len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) as n_cut_lines,
    len(list_filter(w, lambda x: list_contains(string_split('STOP_WORDS', ' '), lower(x)))) as n_stop_words, len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) as n_letter_words
  from doc left join covered using (doc_id)),
verdict as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from stat)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and word_chars >= 2 * n_words and word_chars <= 12 * n_words and 10 * n_symbols <= n_words and 10 * n_letter_words >= 6 * n_words
    and (n_words < 50 or 50 * n_stop_words >= n_words) and 10 * n_dup_lines <= 3 * n_lines and 10 * n_bullet_lines <= 9 * n_lines and 10 * n_cut_lines <= 3 * n_lines as kept
from verdict
""".replace("STOP_WORDS", " ".join(quality_rules.STOP_WORDS))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(load(spark, sf_dir, "documents"))


OP13_SQL = r"""
with recursive
bits(i, k, c) as (select i, 0, i from range(256) r(i) union all select i, k + 1, case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end from bits where k < 8),
crc as (select list(c order by i) as crcs from bits where k = 8),
run as (
  select doc_id, count(*) as n, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as r
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) as r from documents) where length(r) >= 7 group by all),
told as (
  select n, r, xor(list_reduce([4294967295::bigint] || list_transform(range(1, strlen(doc_id || ':' || r) + 1), lambda j: ('0x' || substr(hex(encode(doc_id || ':' || r)), 2 * j - 1, 2))::bigint),
    lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255) + 1])), 4294967295) as h from run, crc),
word as (
  select w as word, sum(n)::bigint as n from (select n, case when h % 31 = 0 then substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) else r end as w from told)
  where length(w) >= 7 group by w having sum(n) >= 2),
gap as (select word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as k from word)),
pair as (
  select a.word, a.n, b.word as near, b.n as near_n from gap a join gap b on a.k = b.k and a.rest = b.rest and a.word <> b.word and length(a.word) = length(b.word)
  union select a.word, a.n, b.word, b.n from gap a join word b on a.rest = b.word
  union select b.word, b.n, a.word, a.n from gap a join word b on a.rest = b.word),
best as (select word, count(*) as n_near, arg_min(near, (-near_n, near)) as near, max(near_n) as near_n from pair group by word),
formed as (
  select word.word, n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * n then near end as form, case when near_n >= 10 * n then near_n end as form_n from word left join best using (word)),
climb(word, step, k) as (select word, word, 0 from formed union all select c.word, f.form, k + 1 from climb c join formed f on f.word = c.step where f.form is not null),
last as (select word, arg_max(step, k) as root from climb group by word)
select word, form, root, n, n_near, form_n from formed join last using (word)
"""


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_packing": op2_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality": op4_quality,
    "op5_decontamination": op5_decontamination,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_media": op8_media,
    "op9_tokens": op9_tokens,
    "op10_secrets": op10_secrets,
    "op11_merkle": op11_merkle,
    "op12_quality_rules": op12_quality_rules,
    "op13_spelling": op13_spelling,
}
ORACLE_SQL = {"op1_ngram_join": OP1_SQL, "op6_suffix_dedup": OP6_SQL, "op3_line_dedup": OP3_SQL, "op5_decontamination": OP5_SQL, "op11_merkle": OP11_SQL, "op12_quality_rules": OP12_SQL,
              "op13_spelling": OP13_SQL}
