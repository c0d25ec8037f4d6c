"""The registered queries of the operators and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm import (
    language,
    minhash,
    mixing,
    neighbours,
    packing,
    quality,
    sharding,
    simhash,
    spelling,
    suffixes,
    toxicity,
    trie,
    urls,
)
from salespipe.llm.store import small_batches, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_STOCK = " + ".join(
    f"{len(p.split(' '))} * len(regexp_extract_all(low, '{quality.bordered(p)}'))" for p in quality.BOILERPLATE
)
_STARTS = " or ".join(f"starts_with(low, '{m}')" for m in quality.NAVIGATION if m[0] != " ")
_MARKS = " + ".join(
    f"(length(low) - length(replace(low, '{m}', ''))) // {len(m)}" for m in quality.NAVIGATION if m[0] == " "
)
_ENDS = " or ".join("ends_with(line, '{}')".format(e.replace("'", "''")) for e in quality.SENTENCE_ENDS)


@query(rf"""
with docs as (
  select row_number() over () r, doc_id, coalesce(text, '') as text, {WORDS.format("coalesce(text, '')")} as words from documents),
lines as (select r, unnest(string_split(text, chr(10))) as whole from docs),
l as (select r, whole, trim(whole, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line from lines),
wordy as (select r, whole, line, lower(line) as low from l where line <> ''),
stocked as (select *, {_STOCK} as stock, len({WORDS.format("line")}) as line_words from wordy),
judged as (select r, whole, (stock > 0 and 100 * stock >= {quality.PHRASE_SHARE} * line_words) or ({_STARTS}) or ({_MARKS}) >= {quality.NAVIGATION_MARKS}
    or (not ({_ENDS}) and line_words < {quality.MIN_LINE_WORDS}) as fails from stocked),
lost as (select r, count(*) as n_lines, count(*) - count(distinct whole) as dup, count(*) filter (fails) as removed,
    coalesce(sum(octet_length(encode(whole))) filter (fails), 0) as line_bytes from judged group by r),
counts as (select r, len(string_split(text, chr(10))) as all_lines from docs),
windows as (select r, k, array_to_string(words[k:k + 7], ' ') as w from
    (select r, words, unnest(generate_series(1, len(words) - 7)) as k from docs where len(words) >= 8)),
twice as (select r, k from (select r, k, count(*) over (partition by r, w) as c from windows) where c > 1),
rep as (select r, count(distinct k + j) as repeated from twice, (select unnest(generate_series(0, 7)) as j) group by r),
base as (
  select d.doc_id, len(words) as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(dup, 0) as n_dup_lines,
    coalesce(repeated, 0) as n_repeat_words, octet_length(encode(text)) as n_bytes, coalesce(n_lines, 0) as n_lines,
    coalesce(removed, 0) as n_lines_removed,
    -- a removed line takes one newline with it, but the last of a text that goes whole has none
    coalesce(line_bytes, 0) + coalesce(removed, 0) - case when removed = all_lines then 1 else 0 end as n_bytes_removed
  from docs d join counts using (r) left join lost using (r) left join rep using (r)),
failed as (select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words as base_failed from base)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines, n_lines_removed, n_bytes,
  n_bytes_removed, not base_failed and 100 * n_bytes_removed <= {quality.MAX_LOST} * n_bytes as kept
from failed
""")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.line_first(table(spark, sf_dir, "documents")).drop("cleaned_text")


RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)
_FITS = " union all ".join(f"select '{r.verdict}' as v, '{r.host}' as h, '{r.path}' as p" for r in RULES)


@query(rf"""
with recursive rules as ({_FITS}),
parts as (select row_number() over () as r, page_id, url, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{urls.UPPER}', '{urls.LOWER}') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)', 1), '') as asked from pages),
named as (select *, case when host <> '' then host || regexp_replace(path, '/+$', '') || regexp_replace(
    regexp_replace(regexp_replace(asked, '(?i)([?&])(?:(?:utm_[a-z]+|ref|gclid|fbclid|sessionid)=[^&#]*(?:&|$))+', '\1', 'g'),
    '[?&]$', ''), '[?&]$', '') end as address from parts),
fit as (select r, max(struct_pack(n := length(h || p), rule := h || p, verdict := v)) as f from parts, rules
  where (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by r),
alias as (select address, min(f.verdict) as verdict from named join fit using (r) where address is not null group by address)
select n.page_id, n.host, n.path, f.rule as rule, coalesce(f.verdict, a.verdict, 'allow') as verdict,
  f is null and a.verdict is not null as from_alias
from named n left join fit using (r) left join alias a using (address)
""")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL joins pages of one address; the tables hold no canonical link or redirect (small tests cover those)."""
    return urls.verdicts(spark, table(spark, sf_dir, "pages"), RULES)


@query()
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = "coalesce(octet_length(cast(text as string)), 0) + 1"
    out = sharding.shards(spark, table(spark, sf_dir, "documents"), size, 16)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.expr(size).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _remainder(n: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(-1))


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(spark, docs, _remainder(3) != 1)
    return language.identify(docs, model).select(
        "doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score"
    )


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels"), _remainder(5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "score", "predicted",
        F.col("evidence.doc_id").alias("evidence"),
    )


@query(rf"""
with recursive docs as (
  select doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}')")} as words from documents),
starts as (select doc_id, words, unnest(generate_series(1, greatest(len(words) - 3, 1))) as k from docs where len(words) > 0),
shingles as (select distinct doc_id, array_to_string(words[k:k + 3], ' ') as s from starts),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
  select a.doc_id as x, b.doc_id as y from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
    join sizes m on m.doc_id = a.doc_id join sizes n on n.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, m.n, n.n having 100 * count(*) >= 80 * (m.n + n.n - count(*))),
reach as (select doc_id, doc_id as other from docs union select r.doc_id, l.y from reach r join links l on l.x = r.other)
select d.doc_id, coalesce(n, 0) as n_shingles, least_id as component_id, least_id = d.doc_id as kept
from docs d left join sizes using (doc_id) join (select doc_id, min(other) as least_id from reach group by doc_id) using (doc_id)
""")
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents"), shingle=4, similarity=80)


@query(r"""
with docs as (select doc_id, octet_length(encode(coalesce(text, ''))) as n, hex(encode(coalesce(text, ''))) as h from documents),
starts as (select doc_id, h, unnest(generate_series(0, n - 50)) as p from docs where n >= 50),
strings as (select doc_id, p, substr(h, 2 * p + 1, 100) as s from starts),
least as (select s, min(doc_id) as first from strings group by s),
gone as (select doc_id, p from strings join least using (s) where first < doc_id),
edges as (select doc_id, p, lag(p) over (partition by doc_id order by p) as before from gone),
heads as (select doc_id, p, sum(case when before is null or p > before + 50 then 1 else 0 end) over (partition by doc_id order by p) as k
  from edges),
spans as (select doc_id, k, min(p) as a, max(p) + 50 as b from heads group by doc_id, k),
pieces as (select d.doc_id, d.n, d.h, list(struct_pack(a := a, b := b) order by a) filter (a is not null) as cuts,
    coalesce(sum(b - a), 0)::bigint as n_removed, count(a) as n_spans
  from docs d left join spans using (doc_id) group by d.doc_id, d.n, d.h)
select doc_id, n as n_bytes, n_removed, n_spans, sha256(unhex(case when n_spans = 0 then h else
    substr(h, 1, 2 * cuts[1].a) || array_to_string(list_transform(generate_series(1, n_spans), lambda i:
      substr(h, 2 * cuts[i].b + 1, 2 * (case when i = n_spans then n else cuts[i + 1].a end - cuts[i].b))), '') end)) as kept_sha256
from pieces
""")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(spark, table(spark, sf_dir, "documents"), length=50).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query()
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark, table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "n_tokens", "epoch", "block", "position")


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"))


@query()
def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_classes(spark, table(spark, sf_dir, "documents"), shingle=4)


def _crc32_of_hex(digits: str) -> str:
    """SQL for the unsigned CRC-32 of bytes given as hexadecimal digits, bit by bit."""
    bit = f"(('0x' || substr({digits}, 2 * (i // 8) + 1, 2))::bigint >> (i % 8)) & 1"
    bits = f"list_transform(generate_series(0, 4 * length({digits}) - 1), lambda i: {bit})"
    step = "lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {bits}::bigint[]), {step}), 4294967295::bigint)"


@query(rf"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as k, role, text
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
own as (select conv_id, count(*) as n, conv_id - conv_id % 5 as base, conv_id::varchar as name from turns group by conv_id),
convs as (select *, {_crc32_of_hex("hex(encode(name))")} % 9 as h from own),
taking as (select c.conv_id, c.n, c.base, c.h, least(c.h, coalesce(b.n, 0)) as taken from convs c left join own b on b.conv_id = c.base),
rebuilt as (
  select conv_id, taken + k - h as pos, role, text from turns join taking using (conv_id) where k > h
  union all
  select c.conv_id, t.k, t.role, t.text from taking c join turns t on t.conv_id = c.base and t.k <= c.h),
paths as (
  select conv_id, pos, octet_length(encode(text)) as size,
    string_agg(md5(length(role) || ':' || role || text), '') over (partition by conv_id order by pos) as path from rebuilt
  union all select conv_id, 0, 0, '' from own),
nodes as (select path, min(conv_id) as conv_id, any_value(pos) as depth, count(*) as n, any_value(size) as size from paths group by path),
children as (select substr(path, 1, length(path) - 32) as path, count(*) as n_children from nodes where depth > 0 group by 1),
below as (
  select a.path, sum(case when c.path is null then 1 else 0 end)::bigint as n_leaves, sum((w.n - 1) * w.size)::bigint as saved_tokens
  from nodes w join paths a on a.conv_id = w.conv_id and a.pos <= w.depth left join children c on c.path = w.path group by a.path),
ends as (
  select path, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from (select conv_id, path from paths qualify row_number() over (partition by conv_id order by pos desc) = 1) group by path)
select n.conv_id, n.depth::bigint as depth, up.conv_id as parent_conv_id, n.n as n_convs, coalesce(n_children, 0) as n_children, n_leaves,
  saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from nodes n left join nodes up on n.depth > 0 and up.path = substr(n.path, 1, length(n.path) - 32)
  left join children c on c.path = n.path join below b on b.path = n.path left join ends e on e.path = n.path
""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = trie.reopened(spark, trie.numbered(spark, table(spark, sf_dir, "conversations")))
    return trie.trie(spark, turns, convs).drop("node", "parent", "turn_id")


@query(rf"""
with recursive found as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{urls.UPPER}', '{urls.LOWER}') as run from documents),
own as (select doc_id, run, count(*) as n, coalesce(doc_id::varchar, '') || ':' || run as named from found group by doc_id, run),
bytes as (select *, hex(encode(named)) as x from own),
hashed as (select *, {_crc32_of_hex("x")} as h from bytes),
changed as (select n, case when h % 97 = 0
    then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from hashed),
words as (select word, sum(n)::bigint as n from changed where length(word) >= 5 group by word having sum(n) >= 3),
-- two words are one edit apart if one is the other without a letter, or both are alike without their k-th
cut as (select word, k, substr(word, 1, k - 1) || substr(word, k + 1) as rest
    from (select word, unnest(generate_series(1, length(word))) as k from words)
  union all select word, 0, word from words),
near as (select distinct a.word, b.word as other from cut a join cut b on a.rest = b.rest and a.word <> b.word
    where a.k = b.k or a.k = 0 or b.k = 0),
best as (select near.word, count(*) as n_near, min(struct_pack(n := -o.n, word := other)) as b
  from near join words o on o.word = other group by near.word),
forms as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when -b.n >= 2 * w.n then b.word end as form,
    case when -b.n >= 2 * w.n then -b.n end as form_n from words w left join best using (word)),
steps as (select word, word as here from forms union all select s.word, f.form from steps s join forms f on f.word = s.here where f.form is not null),
last as (select s.word, here as root from steps s join forms f on f.word = here where f.form is null)
select f.word, form, root, n, n_near, form_n from forms f join last on last.word = f.word
""")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(spark, table(spark, sf_dir, "documents"), change=spelling.damaged)
    return spelling.variants(spark, words)
