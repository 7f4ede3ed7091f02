"""Registered queries of the operators, with their DuckDB SQL where SQL can state
the result. Each query applies its operator with production parameters to whole
tables and derives the contract's columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from launchboard.llm import near_dup
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85).drop("text_hash")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from launchboard.llm import decontaminate
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from launchboard.llm import quality_rules
    docs = table(spark, sf_dir, "documents")
    return quality_rules.quality_rules(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from launchboard.llm import repeats
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select(
        "doc_id", "__repeats.n_words", "__repeats.n_removed",
        F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from launchboard.llm.url_filter import Rule, filter_urls
    rules = [Rule("net/", "block"), Rule("example.net/en/", "allow"),
             Rule("example.com/de/", "block"), Rule("org/fr/", "allow")]
    return filter_urls(table(spark, sf_dir, "pages"), rules)


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from launchboard.llm import quality_model
    docs = table(spark, sf_dir, "documents")
    machine = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, machine).select(
        "doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality_model.PREDICT_AT).cast("int").alias("predicted"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from launchboard.llm import packing
    packed = packing.pack(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from launchboard.llm import license_scan
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from launchboard.llm import tokens
    from launchboard.llm.store import Scratch
    # a cache of its own for each call: the query's work does not depend on earlier calls
    cache = Scratch(spark, "token-cache").path
    counts = tokens.count_tokens(table(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_50k.json"), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from launchboard.llm import kneser_ney
    from launchboard.llm.store import Scratch
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "lm-scoring")
    model = kneser_ney.fit(docs.where(kneser_ney.part(F.col("doc_id")) != 0), scratch)
    return scratch.keep(kneser_ney.score(docs, model), "scores").select(
        "doc_id", F.coalesce(kneser_ney.part(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from launchboard.llm import spelling
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from launchboard.llm import collocations
    return collocations.top_collocations(table(spark, sf_dir, "documents")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from launchboard.llm import suffixes
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeated_bytes(docs).select(
        "doc_id", "__suffixes.n_bytes", "__suffixes.n_removed",
        F.size("__suffixes.spans").cast("long").alias("n_spans"),
        F.sha2("__suffixes.kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_near_duplicates, op2_decontamination, op3_quality_rules, op4_substring_dedup, op5_url_filter,
    op6_quality_model, op7_best_fit_packing, op8_license_scan, op9_token_counts, op10_lm_scoring,
    op11_spelling_variants, op12_collocations,
    op13_suffix_dedup)}


OP1_SQL = """
with recursive words as (
  select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + 2], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select a, b from common c join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c.n >= 85 * (x.n + y.n - c.n)),
both_ways as (select a, b from links union all select b, a from links),
reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select r.doc_id, l.b from reach r join both_ways l on l.a = r.other)
select d.doc_id, coalesce(any_value(z.n), 0) as n_shingles, min(r.other) as component_id,
       d.doc_id = min(r.other) as kept
from documents d join reach r using (doc_id) left join sizes z using (doc_id)
group by d.doc_id"""

OP4_SQL = """
with words as (
  select row_number() over () as r, doc_id, list_filter(string_split_regex(
    coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents),
windows as (
  select r, doc_id, i, array_to_string(w[i:i + 12], ' ') as k
  from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from words)),
first_docs as (select k, min(doc_id) as first_doc from windows group by k),
gone as (
  select distinct r, i + o as p
  from windows join first_docs using (k), range(13) t(o) where first_doc < doc_id),
tokens as (select r, unnest(w) as word, generate_subscripts(w, 1) as p from words),
kept as (
  select t.r, count(g.p) as n_removed,
         string_agg(t.word, ' ' order by t.p) filter (where g.p is null) as text
  from tokens t left join gone g on g.r = t.r and g.p = t.p group by t.r)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed,
       sha256(coalesce(text, '')) as kept_sha256
from words left join kept using (r)"""

OP12_SQL = """
with pieces as (
  select lang, row_number() over () as p, w from (
    select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from (
      select coalesce(lang, 'und') as lang, unnest(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) as piece
      from documents where text is not null))
  where len(w) > 0),
tokens as (select lang, p, unnest(w) as x, generate_subscripts(w, 1) as i from pieces),
runs as (
  select lang, x, lead(x, 1) over v as x2, lead(x, 2) over v as x3, lead(x, 3) over v as x4
  from tokens window v as (partition by p order by i)),
grams as (
  select lang, 1 as k, x as s from runs
  union all select lang, 2, x || ' ' || x2 from runs where x2 is not null
  union all select lang, 3, x || ' ' || x2 || ' ' || x3 from runs where x3 is not null
  union all select lang, 4, x || ' ' || x2 || ' ' || x3 || ' ' || x4 from runs where x4 is not null),
counts as (select lang, k, s, count(*) as f from grams group by all),
totals as (select lang, sum(f) as n from counts where k = 1 group by lang),
frequent as (select lang, k, s, f, string_split(s, ' ') as w from counts where f >= 30),
cuts as (
  select c.lang, c.k, c.s, c.f as a, c.w, t.j, x.f as l, y.f as r,
         ((2000000::hugeint * c.f) // (x.f + y.f))::bigint as score
  from frequent c join range(1, 4) t(j) on t.j < c.k
  join frequent x on x.lang = c.lang and x.s = array_to_string(c.w[1:t.j], ' ')
  join frequent y on y.lang = c.lang and y.s = array_to_string(c.w[t.j + 1:], ' ')
  where c.k > 1),
lowest as (select * from cuts qualify row_number() over (partition by lang, s order by score, j) = 1),
inside as (
  select distinct b.lang, array_to_string(b.w[i:i + m - 1], ' ') as s, b.f
  from (select lang, w, k, f, m, unnest(range(1, k - m + 2)) as i
        from frequent, range(2, 4) t(m) where m < k) b),
dropped as (
  select distinct c.lang, c.s from lowest c join inside b on b.lang = c.lang and b.s = c.s
  where 100 * b.f >= 80 * c.a),
ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, s) as rank, s as phrase, a, l, r, score
  from lowest anti join dropped using (lang, s))
select lang, rank, phrase, a, l, r, n::bigint as n, score from ranked join totals using (lang) where rank <= 2000"""

OP13_SQL = """
with docs as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
parts as (
  select r, c, substring(h, (2 * c + 1)::bigint, 2398) as h
  from (select r, h, unnest(range(0, (length(h) // 2 - 199)::bigint, 1000)) as c from docs)),
windows as (
  select r, c + i as i, md5(substring(h, (2 * i + 1)::bigint, 400)) as k
  from (select r, c, h, unnest(range(0, least(1000, length(h) // 2 - 199)::bigint)) as i from parts)),
repeated as (select k from windows group by k having count(*) > 1),
starts as (select r, i, lag(i) over (partition by r order by i) as before
           from windows semi join repeated using (k)),
runs as (
  select r, i, sum(case when before is null or before < i - 200 then 1 else 0 end) over (
    partition by r order by i rows unbounded preceding) as run from starts),
spans as (select r, run, min(i) as a, max(i) + 200 as b from runs group by r, run),
around as (select r, a, b, lag(b, 1, 0) over (partition by r order by a) as kept_from from spans),
kept as (
  select r, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last_b,
         list({'f': kept_from, 't': a} order by a) as stay from around group by r)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(case when last_b is null then h else array_to_string(list_transform(
         stay, lambda x: substring(h, (2 * x.f + 1)::bigint, (2 * (x.t - x.f))::bigint)), '')
         || substring(h, (2 * last_b + 1)::bigint) end)) as kept_sha256
from docs left join kept using (r)"""


def _oracle() -> dict[str, str]:
    from launchboard.llm import license_scan
    return {"op1_near_duplicates": OP1_SQL, "op4_substring_dedup": OP4_SQL, "op12_collocations": OP12_SQL, "op13_suffix_dedup": OP13_SQL,
            "op8_license_scan": license_scan.oracle_sql()}


ORACLE: dict[str, str] = _oracle()
