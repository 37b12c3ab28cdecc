"""The registered queries of the corpus operators, and SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hostpulse.llm import conversations, decontaminate, language_id, line_dedup, near_dup, packing, pii, quality, sharding, simhash, spelling, token_files, url_filter
from hostpulse.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link_documents(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontaminate.n_hit().alias("n_hit"),
        F.size(decontaminate.item_ids()).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", decontaminate.item_ids()), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.col("n_hit") > 0)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_tokens(table(spark, sf_dir, "documents"), token_files.tokens_path(spark))
    return token_files.digest(token_files.read_tokens(spark, path))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(F.lit(quality.BASE)) != 0).alias("base_failed"),
        quality.passes().alias("kept"), "n_lines", "n_capitals", "fail_bits",
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"), pii.train())
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model, places = url_filter.learn(pages)
    return url_filter.judge(pages, model, places=places)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.link_documents(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return conversations.repair(given, conversations.damage(given)).report()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_decontamination": op5_decontamination,
    "op6_language_id": op6_language_id,
    "op7_token_files": op7_token_files,
    "op8_quality_rules": op8_quality_rules,
    "op9_personal_data": op9_personal_data,
    "op10_url_filter": op10_url_filter,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_simhash": op12_simhash,
    "op13_conversation_repair": op13_conversation_repair,
}

_OP5 = r"""
with doc_words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), items as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), sized as (
    select item_id, w, least(10, len(w)) as k from items where len(w) > 0
), windows as (
    select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as win
    from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as i from sized)
), lengths as (select distinct k from windows
), doc_windows as (
    select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as win
    from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from doc_words, lengths where len(w) >= k)
), hits as (
    select d.doc_id, d.i, d.k, v.item_id from doc_windows d join windows v on v.k = d.k and v.win = d.win
), covered as (
    select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from hits) group by doc_id
), found as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join covered using (doc_id) left join found using (doc_id)
"""

_OP8 = r"""
with texts as (
    select doc_id, coalesce(text, '') as t from documents
), words as (
    select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from texts
), wins as (
    select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as win
    from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from words)
), repeated as (
    select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as c from wins) where c > 1
), covered as (
    select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from repeated) group by doc_id
), measured as (
    select doc_id, cast(len(w) as bigint) as n_words,
        cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
        cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
        cast(len(l) as bigint) as n_lines, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
        cast(coalesce(n, 0) as bigint) as n_repeat_words,
        cast(length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g')) as bigint) as n_capitals
    from words left join covered using (doc_id)
), ledger as (
    select *, cast((case when n_words < 50 then 1 else 0 end) + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
        + (case when 10 * n_symbols > n_words then 4 else 0 end) + (case when 100 * n_dup_lines > 50 * n_lines then 8 else 0 end)
        + (case when word_chars < 2 * n_words then 16 else 0 end) + (case when word_chars > 15 * n_words then 32 else 0 end)
        + (case when 100 * n_capitals > 60 * word_chars then 64 else 0 end) as bigint) as fail_bits from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 as base_failed,
    fail_bits = 0 as kept, n_lines, n_capitals, fail_bits from ledger
"""

_OP2 = r"""
with lines as (
    select doc_id, source, text, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as place
    from documents
), worded as (
    select * from lines where regexp_matches(line, '[^\x20\x09-\x0D]')
), wide as (
    select line, min(row(doc_id, place)) as f from worded group by line having count(distinct coalesce('=' || source, '')) >= 5
), marked as (
    select l.doc_id, l.line, l.place, w.line is not null and row(l.doc_id, l.place) <> w.f as gone,
        regexp_matches(l.line, '[^\x20\x09-\x0D]') as worded
    from lines l left join wide w on w.line = l.line
)
select doc_id, cast(count_if(worded) as bigint) as n_lines, cast(count_if(gone) as bigint) as n_removed,
    coalesce(string_agg(line, chr(10) order by place) filter (not gone), '') as text
from marked group by doc_id
"""

ORACLES: dict[str, str] = {"op2_line_dedup": _OP2, "op5_decontamination": _OP5, "op8_quality_rules": _OP8}
