"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    block_dedup,
    chat_masks,
    decontaminate,
    hard_negatives,
    host_reputation,
    jaccard_join,
    lexicon_bpe,
    line_quality,
    minhash,
    prefix_trie,
    sharding,
    suffix_dedup,
    warc_store,
)
from .common import ship_package


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's definition; ``LINKLOOM_TOKENIZERS`` names another folder."""
    folder = os.environ.get("LINKLOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1 URL filters ---------------------------------------------------------------------------

URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict per page. A page's labelled outcome is the row of ``labels`` with its
    number: good if of quality and not toxic."""
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    judged = host_reputation.judge_pages(table(spark, sf_dir, "pages"), outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = r"""
with urls as (
  select page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages),
outcomes as (
  select doc_id, min(case when quality = 1 and toxic = 0 then 1 else 0 end) as good
  from labels where quality is not null and toxic is not null group by doc_id),
hosts as (
  select host, count(good) as n, coalesce(sum(good), 0) as k,
         regexp_replace(host, ':\d*$', '') as name, regexp_extract(name, '(?:^|\.)({long})$', 1) as ends,
         case when regexp_matches(name, '^(\d+\.\d+\.\d+\.\d+|\[.*\])$') then 'address'
              when ends <> '' then ends else regexp_extract(name, '([^.]*)$', 1) end as suffix,
         case when suffix = 'address' or ends = name or name not like '%.%' then name
              when ends <> '' then regexp_extract(name, '([^.]*\.)({long})$')
              else regexp_extract(name, '([^.]*\.[^.]*)$', 1) end as domain
  from urls left join outcomes on page_id = doc_id group by host),
domains as (select domain, suffix, sum(n) as n, sum(k) as k from hosts group by all),
suffixes as (select suffix, sum(n) as n, sum(k) as k from domains group by suffix),
whole as (select (sum(k) + 1.0::double) / (sum(n) + 2) as m from suffixes),
w0 as (
  select case when coalesce(sum(n * (n - 1)), 0) = 0 or sum(power(k - n * m, 2) / (m * (1 - m))) <= sum(n) then 1000.0::double
         else least(1000.0::double, greatest(1.0::double, sum(n * (n - 1)) / (sum(power(k - n * m, 2) / (m * (1 - m))) - sum(n)) - 1)) end as w
  from suffixes, whole where n > 0),
s as (select suffix, (k + w * m) / (n + w) as m from suffixes, whole, w0),
dm as (select d.*, s.m from domains d join s using (suffix)),
w1 as (
  select case when coalesce(sum(n * (n - 1)), 0) = 0 or sum(power(k - n * m, 2) / (m * (1 - m))) <= sum(n) then 1000.0::double
         else least(1000.0::double, greatest(1.0::double, sum(n * (n - 1)) / (sum(power(k - n * m, 2) / (m * (1 - m))) - sum(n)) - 1)) end as w
  from dm where n > 0),
d as (select domain, (k + w * m) / (n + w) as m from dm, w1),
hm as (select h.*, d.m from hosts h join d using (domain)),
w2 as (
  select case when coalesce(sum(n * (n - 1)), 0) = 0 or sum(power(k - n * m, 2) / (m * (1 - m))) <= sum(n) then 1000.0::double
         else least(1000.0::double, greatest(1.0::double, sum(n * (n - 1)) / (sum(power(k - n * m, 2) / (m * (1 - m))) - sum(n)) - 1)) end as w
  from hm where n > 0),
ab as (select host, k + w * m as a, n - k + w * (1 - m) as b from hm, w2),
scores as (select host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bound from ab),
ruled as (
  select page_id, u.host, path, bound,
    case when (u.host = 'www.example.com' or ends_with(u.host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
         when (u.host = 'example.com' or ends_with(u.host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
         when (u.host = 'net' or ends_with(u.host, '.net')) and starts_with(path, '/es/') then 'net/es/'
         when (u.host = 'net' or ends_with(u.host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
         when (u.host = 'com' or ends_with(u.host, '.com')) and starts_with(path, '/') then 'com/' end as rule
  from urls u join scores using (host))
select page_id, host, path, rule,
       case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
            when bound >= 0.5 then 'allow' else 'block' end as verdict
from ruled
""".replace("{long}", "|".join(s.replace(".", "\\.") for s in host_reputation.LONG_SUFFIXES))


# --- 2 WARC ----------------------------------------------------------------------------------

def op2_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the pages to a content-addressed archive and reads it back."""
    path = warc_store.archive_path(spark)
    warc_store.write_archive(table(spark, sf_dir, "pages"), path)
    records = warc_store.read_archive(spark, path)
    return records.select(
        warc_store.page_id_of(F.col("record_id")).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc_store.page_id_of(F.col("refers_to")).cast("long").alias("refers_to"),
    )


OP2_SQL = """
select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes,
       sha256(coalesce(html, '')) as payload_digest,
       case when octet_length(encode(coalesce(html, ''))) >= 100
                 and page_id <> min(page_id) over (partition by coalesce(html, '')) then 'revisit' else 'response' end as record_type,
       case when octet_length(encode(coalesce(html, ''))) >= 100
                 and page_id <> min(page_id) over (partition by coalesce(html, '')) then min(page_id) over (partition by coalesce(html, '')) end as refers_to
from pages
"""


# --- 3 Chat formatting -----------------------------------------------------------------------

def op3_chat_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats all conversations and one more that quotes control strings, and reads them back."""
    quoted = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", quoted), (-1, 1, "assistant", quoted)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    with open(tokenizer_file(), encoding="utf-8") as f:
        chats = chat_masks.format_chats(rows, f.read())
    return chats.select("conv_id", "segment", "text", "token_starts", "token_ends", "loss_mask").mapInArrow(
        _chat_digests,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def _chat_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each conversation; its segments arrive in order."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    state = None

    def row():
        conv, turns, all_turns, chars, loss, formatted = state
        return conv, turns, all_turns.hexdigest(), chars, loss.hexdigest(), formatted

    for batch in batches:
        out = []
        convs, segments, texts = (batch.column(i).to_pylist() for i in range(3))
        lists = [batch.column(i) for i in range(3, 6)]
        ends = [x.offsets.to_numpy() for x in lists]
        values = [x.values.to_numpy(zero_copy_only=False) for x in lists]
        for i, (conv, segment, whole) in enumerate(zip(convs, segments, texts)):
            if segment == 0:
                if state:
                    out.append(row())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in chat_masks.read_turns(whole):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            starts, stops, mask = (v[e[i] : e[i + 1]] for v, e in zip(values, ends))
            for text in chat_masks.masked_texts(whole, starts, stops, mask):
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(whole)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 6, types)], names)
    if state:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(row()), types)], names)


OP3_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
written as (select *, replace(replace(role, '\', '\\'), chr(10), '\n') as escaped, '<\\*/?s>|\[\\*/?INST\]' as controls from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length('<s></s>') + 1 + length(escaped) + len(regexp_extract_all(escaped, controls)) + length(text) + len(regexp_extract_all(text, controls))
           + case when role = 'user' then length('[INST][/INST]') else 0 end)::bigint as formatted_chars
from written group by conv_id
"""


# --- 4 Sharding ------------------------------------------------------------------------------

SHARDS = 24


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.shard_rows(rows, ["doc_id", "text_crc32", "size"], SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


# --- 5 Benchmark decontamination -------------------------------------------------------------

def op5_qgram_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items of which they hold a passage."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


# --- 6 Quality rules -------------------------------------------------------------------------

def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's host is its ``source``."""
    judged = line_quality.judge_documents(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "words_left", "base_failed", "kept"
    )


OP6_SQL = r"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(source, '') as host, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents),
windows as (select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g from docs, unnest(range(1, len(ws) - 1)) t(i)),
found as (select r, i from (select r, i, count(*) over (partition by r, g) as c from windows) where c > 1),
repeats as (select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from found) group by r),
split as (select r, host, unnest(string_split(text, chr(10))) as line from docs),
lines as (
  select r, host, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as words,
         ('0x' || substr(md5(array_to_string(regexp_extract_all(
            translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
            '[^\x20\x09-\x0D]+'), ' ')), 1, 15))::bigint as h
  from split where regexp_matches(line, '[^\x20\x09-\x0D]')),
dups as (select r, count(*) - count(distinct line) as n from lines group by r),
per_line as (select r, host, h, sum(words) as words from lines group by r, host, h),
sets as (
  select d.r, d.host, coalesce(string_agg(p.h::varchar, ',' order by p.h), '') as s
  from docs d left join per_line p using (r) group by d.r, d.host),
counts as (select p.host, p.h, count(distinct s.s) as n from per_line p join sets s using (r) group by p.host, p.h),
hosts as (select host, count(distinct s) as n from sets group by host),
frequent as (select c.host, c.h from counts c join hosts using (host) where c.n > 20 and c.n > hosts.n * 0.05::double),
lost as (select k.r, sum(k.words) as n from per_line k join frequent f on k.host = f.host and k.h = f.h group by k.r),
measured as (
  select doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(d.n, 0)::bigint as n_dup_lines,
         coalesce(p.n, 0)::bigint as n_repeat_words, (len(ws) - coalesce(l.n, 0))::bigint as words_left
  from docs left join repeats p using (r) left join dups d using (r) left join lost l using (r))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and words_left >= 20 and words_left >= 0.5::double * n_words as kept
from measured
"""


# --- 7 Suffix-array dedup --------------------------------------------------------------------

def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"], length=50)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = """
with docs as (
  select row_number() over () as r, doc_id, coalesce(doc_id, 9223372036854775807) as d, hex(encode(coalesce(text, ''))) as hx from documents),
lists as (select r, d, list_transform(range(1, length(hx) // 2 - 48), lambda i: md5_number(substr(hx, 2 * i - 1, 100))) as gs from docs),
windows as (select r, d, unnest(gs) as g, unnest(range(1, len(gs) + 1)) as i from lists),
shared as (select g, min(d) as d from windows group by g having min(d) < max(d)),
hits as (select w.r, w.i from windows w join shared s on s.g = w.g and s.d < w.d),
breaks as (select r, i, case when i > lag(i) over (partition by r order by i) + 50 then 1 else 0 end as new from hits),
numbered as (select r, i, sum(new) over (partition by r order by i) as k from breaks),
spans as (select r, min(i) as s, max(i) + 49 as e from numbered group by r, k),
gaps as (select r, s, e, lag(e, 1, 0) over (partition by r order by s) as before from spans),
cut as (
  select r, sum(e - s + 1) as n_removed, count(*) as n_spans, max(e) as last,
         string_agg(substr(hx, 2 * before + 1, 2 * (s - before - 1)), '' order by s) as head
  from gaps join docs using (r) group by r)
select doc_id, (length(hx) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(case when head is null then hx else head || substr(hx, 2 * last + 1) end)) as kept_sha256
from docs left join cut using (r)
"""


# --- 8 N-gram Jaccard join -------------------------------------------------------------------

def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    similarity = jaccard_join.Similarity(shingle=4, percent=85)
    groups = jaccard_join.similar_groups(table(spark, sf_dir, "documents"), similarity=similarity)
    return groups.select("doc_id", "n_shingles", "component_id")


_GROUPS_SQL = r"""
with recursive docs as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents),
shingles as (
  select distinct r, array_to_string(ws[i : i + {last}], ' ') as g
  from docs, unnest(range(1, greatest(len(ws) - {last}, 1) + 1)) t(i) where len(ws) > 0),
sizes as (select r, count(*) as n from shingles group by r),
shared as (select a.r as a, b.r as b, count(*) as c from shingles a join shingles b on a.g = b.g and a.r < b.r group by a.r, b.r),
links as (
  select a, b from shared join sizes x on x.r = a join sizes y on y.r = b where 100 * c >= 85 * (x.n + y.n - c)),
both_ways as (select a, b from links union all select b, a from links),
reach as (select r as a, r as b from docs union select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a),
least as (select reach.a as r, min(docs.doc_id) as component_id from reach join docs on docs.r = reach.b group by reach.a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id{more} from docs join least using (r) left join sizes using (r)
"""
OP8_SQL = _GROUPS_SQL.format(last=3, more="")


# --- 9 Substring dedup -----------------------------------------------------------------------

def op9_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = block_dedup.remove_repeated_words(table(spark, sf_dir, "documents"), ["doc_id"], length=35)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
words as (
  select r, i, ws[i] as w, case when i + 34 <= len(ws) then array_to_string(ws[i : i + 34], ' ') end as g
  from docs, unnest(range(1, len(ws) + 1)) t(i)),
flagged as (select r, i, w, case when g is not null and count(*) over (partition by g) > 1 then 1 else 0 end as f from words),
covered as (select r, i, w, max(f) over (partition by r order by i rows between 34 preceding and current row) as c from flagged),
kept as (select r, count(*) filter (c = 1) as n_removed, string_agg(w, ' ' order by i) filter (c = 0) as t from covered group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from docs left join kept using (r)
"""


# --- 10 BPE encoding and decoding ------------------------------------------------------------

def op10_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with open(tokenizer_file(), encoding="utf-8") as f:
        definition = f.read()
    lexicon = lexicon_bpe.fit_lexicon(docs, definition)
    decoded = lexicon_bpe.encode_documents(docs, definition, lexicon, ["doc_id"], decoded=True)
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


# --- 11 Hard-negative mining -----------------------------------------------------------------

def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose number is divisible by 100; rows whose number is divisible
    by 7 first move to the next label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, hard_negatives.Mining(positives=5, negatives=10, low_percent=30, high_percent=90, scale=256))


OP11_SQL = """
with taking as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, embedding
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
numbered as (
  select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q from taking),
scored as (
  select a.r as a, a.vec_id as anchor_id, c.r as c, c.vec_id, a.label = c.label as same,
         coalesce(list_sum(list_transform(list_zip(a.q, c.q), lambda z: coalesce(z[1] * z[2], 0))), 0)::bigint as s
  from numbered a join numbered c on a.r <> c.r where a.vec_id % 100 = 0),
positives as (
  select * from (select *, row_number() over (partition by a order by s desc, vec_id nulls last, c) as k from scored where same) where k <= 5),
negatives as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.s as positive_score, n.s as negative_score,
         row_number() over (partition by p.a, p.k order by n.s desc, n.vec_id nulls last, n.c) as rank
  from positives p join scored n on n.a = p.a and not n.same and 30 * p.s <= 100 * n.s and 100 * n.s <= 90 * p.s)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from negatives where rank <= 10
"""


# --- 12 MinHash near-dedup -------------------------------------------------------------------

def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = minhash.near_duplicate_groups(table(spark, sf_dir, "documents"), how=minhash.MinHash(shingle=5, percent=85))
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


OP12_SQL = _GROUPS_SQL.format(last=4, more=", doc_id is not distinct from component_id as kept")


# --- 13 Conversation prefix trie -------------------------------------------------------------

def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), group=100, most=6)


# Fixed value: the reversed polynomial of CRC-32.
OP13_SQL = """
with own as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, role, g) as p, g, chars
  from (select conv_id, turn, coalesce(role, '') as role, length(coalesce(text, '')) as chars,
               sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as g
        from conversations where conv_id is not null)),
sized as (select c, count(*) as turns from own group by c),
convs as (
  select c, c - c % 100 as head, turns,
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda ch: ascii(ch)::bigint)),
               lambda x, b: list_reduce(list_prepend(xor(x, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
                 lambda y, i: case when y % 2 = 1 then xor(y // 2, 3988292384::bigint) else y // 2 end)), 4294967295::bigint) % 6 as h
  from sized),
placed as (select convs.*, least(h, coalesce(s.turns, 0)) as d0 from convs left join sized s on s.c = convs.head),
turns as (
  select x.c, o.p as depth, o.g, o.chars from placed x join own o on o.c = x.head and o.p <= x.h
  union all select x.c, x.d0 + o.p - x.h, o.g, o.chars from placed x join own o on o.c = x.c and o.p > x.h
  union all select c, 0, '', 0 from placed),
rows as (select c, depth, chars, md5(string_agg(g, '' order by depth) over (partition by c order by depth)) as k from turns),
lengths as (select c, max(depth) as depth from rows group by c),
nodes as (select depth, k, count(*) as n, min(c) as mc, max(chars) as chars from rows group by depth, k),
up as (
  select v.depth, v.k, v.n, v.mc, p.depth as p_depth, p.k as p_k, p.mc as p_mc
  from nodes v left join rows r on r.c = v.mc and r.depth = v.depth - 1 left join nodes p on p.depth = r.depth and p.k = r.k),
kids as (select p_depth as depth, p_k as k, count(*) as n from up where p_k is not null group by all),
above as (select v.depth, v.k, v.n, v.chars, r.depth as a_depth, r.k as a_k from nodes v join rows r on r.c = v.mc and r.depth <= v.depth),
sums as (
  select a_depth as depth, a_k as k, sum((n - 1) * chars)::bigint as saved,
         count(*) filter (where (depth, k) not in (select (depth, k) from kids)) as leaves
  from above group by a_depth, a_k),
ends as (
  select r.depth, r.k, sha256(string_agg(r.c::varchar, ',' order by r.c)) as sha
  from rows r join lengths l on l.c = r.c and l.depth = r.depth group by r.depth, r.k)
select up.mc as conv_id, up.depth::bigint as depth, up.p_mc as parent_conv_id, up.n as n_convs, coalesce(kids.n, 0) as n_children,
       sums.leaves as n_leaves, sums.saved as saved_tokens, coalesce(ends.sha, sha256('')) as ends_sha256
from up join sums using (depth, k) left join kids using (depth, k) left join ends using (depth, k)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_reputation": op1_url_reputation,
    "op2_warc_store": op2_warc_store,
    "op3_chat_masks": op3_chat_masks,
    "op4_feistel_shards": op4_feistel_shards,
    "op5_qgram_decontaminate": op5_qgram_decontaminate,
    "op6_line_quality": op6_line_quality,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_block_dedup": op9_block_dedup,
    "op10_lexicon_bpe": op10_lexicon_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES: dict[str, str] = {
    "op1_url_reputation": OP1_SQL,
    "op2_warc_store": OP2_SQL,
    "op3_chat_masks": OP3_SQL,
    "op6_line_quality": OP6_SQL,
    "op7_suffix_dedup": OP7_SQL,
    "op8_jaccard_join": OP8_SQL,
    "op9_block_dedup": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_minhash_dedup": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
