"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sublens.llm import (
    decontaminate,
    html_text,
    mixing,
    negatives,
    neighbours,
    periodic,
    quality,
    quality_rules,
    records,
    repeats,
    simhash,
    site_lines,
    toxicity,
)
from sublens.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "text", F.length("text").cast("long").alias("n_chars"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def labelled_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table of the domain classifier: the language of the rows in labels."""
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(
        table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = mixing.rated(docs, docs, labelled_domains(spark, sf_dir), keep=["doc_id"])
    return rows.select(
        "doc_id", F.col("_n").alias("n_tokens"),
        *[F.get("_p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(mixing.TARGETS)],
        F.col("_rate").alias("rate"), mixing.copies().alias("copies"))


def op6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, index = records.output(table(spark, sf_dir, "documents"))
    return index.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.verdicts(decontaminate.scan(docs, table(spark, sf_dir, "benchmark")))
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        F.col("_contaminated").alias("contaminated"))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.drop_lines(html_text.extract(table(spark, sf_dir, "pages")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by its id's CRC, gets a periodic tail; a NULL id none."""
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), edit=periodic_tail)
    # runs come by start and period: the first of equal exponents stays
    best = F.reduce("runs", F.expr("cast(null as struct<start:bigint,length:bigint,period:bigint>)"),
                    lambda m, r: F.when(m.isNull() | (r["length"] * m["period"] > m["length"] * r["period"]), r).otherwise(m))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_html": op2_html,
    "op3_toxicity": op3_toxicity,
    "op4_repeats": op4_repeats,
    "op5_mixing": op5_mixing,
    "op6_records": op6_records,
    "op7_decontaminate": op7_decontaminate,
    "op8_rules": op8_rules,
    "op9_site_lines": op9_site_lines,
    "op10_quality": op10_quality,
    "op11_runs": op11_runs,
    "op12_neighbours": op12_neighbours,
    "op13_negatives": op13_negatives,
}

_AZ = ("translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

OP7_SQL = f"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all({_AZ.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents),
b as (
  select cast(item_id as varchar) as item,
         regexp_extract_all({_AZ.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark),
windows as (
  select distinct item, least(len(w), 13) as n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as g
  from b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as t(i) where len(w) > 0),
sizes as (select distinct n from windows),
grams as (
  select r, i, n, array_to_string(w[i:i + n - 1], ' ') as g
  from d, sizes, unnest(range(1, len(w) - n + 2)) as t(i) where len(w) >= n),
occurs as (select r, i, grams.n, item from grams join windows using (n, g)),
hits as (select r, count(distinct i + k) as n_hit from occurs, unnest(range(0, n)) as t(k) group by r),
named as (
  select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items
  from occurs group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hits using (r) left join named using (r)
"""

_TESTS8 = ", ".join(f"('{r[0]}', {c})" for r in quality_rules.RULES for c in r[3])
_TOP8 = " ".join(f"when '{r[0]}' then {r[1]}" for r in quality_rules.RULES)
_BOTTOM8 = " ".join(f"when '{r[0]}' then {r[2]}" for r in quality_rules.RULES)
_RATE8 = quality_rules.ALLOWED / len(quality_rules.RULES)

OP8_SQL = f"""
with d as (
  select row_number() over () as r, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as t,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
  from documents),
grams as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from d, unnest(range(1, len(w) - 1)) as x(i) where len(w) > 2),
twice as (select r, g from grams group by r, g having count(*) > 1),
repeated as (
  select r, count(distinct i + k) as n from grams join twice using (r, g), unnest([0, 1, 2]) as x(k) group by r),
c as (
  select r, doc_id, stratum, len(w)::bigint as n_words, len(l)::bigint as n_lines,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words
  from d left join repeated using (r)),
good as (select doc_id from labels where quality is not null group by doc_id having min(quality) = 1 and max(quality) = 1),
tests(rule, cutoff) as (values {_TESTS8}),
held as (
  select stratum, rule, cutoff, count(*) as n,
         count(*) filter (where 100 * (case rule {_TOP8} end) >= cutoff * (case rule {_BOTTOM8} end)) as k
  from c, tests where doc_id in (select doc_id from good) group by all),
tails as (
  select stratum, rule, cutoff, case when k > n * {_RATE8} then 1.0 else
    (select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RATE8}) + (n - i) * ln(1 - {_RATE8})))
     from unnest(range(0, k + 1)) as x(i)) end as p
  from held),
cuts as (
  select stratum, rule, min(cutoff) as cutoff from tails
  where p <= {quality_rules.DELTA} / ({len(quality_rules.RULES)} * (select count(distinct stratum) from held))
  group by all),
bad as (
  select distinct r from c join cuts using (stratum)
  where 100 * (case rule {_TOP8} end) >= cutoff * (case rule {_BOTTOM8} end))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and r not in (select r from bad) as kept
from c
"""

OP13_SQL = """
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
pairs as (
  select a.vec_id as anchor_id, o.vec_id, o.label = a.label as same,
         list_inner_product(a.v, o.v)::bigint as score
  from r a join r o on a.vec_id % 100 = 0 and o.vec_id <> a.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id,
       (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives join pairs using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op13_negatives": OP13_SQL,
    "op8_rules": OP8_SQL,
    "op7_decontaminate": OP7_SQL,
}
