"""Registered queries of the corpus operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rarespark.llm import decontaminate, html_main, licenses, line_dedup, packing, simhash_dedup, substring_dedup, token_alignment, token_histogram, toxicity, version_sketch, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Words of a text in SQL: white space is \x20 and \x09-\x0D alone.
WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    "op10_substring_dedup",
    f"""with d as (select doc_id, {WORDS_SQL} as w from documents),
    g as (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d),
    win as (select doc_id, i, sha256(array_to_string(w[i:i+12], ' ')) as h from g),
    m as (select h, min(doc_id) as first_id from win group by h),
    hit as (select doc_id, i from win join m using (h) where first_id < doc_id),
    gone as (select distinct doc_id, unnest(range(i, i + 13)) as p from hit),
    word as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
    kept as (select word.doc_id, count(gone.p) as n_removed,
                    string_agg(word, ' ' order by word.p) filter (where gone.p is null) as t
             from word left join gone on word.doc_id = gone.doc_id and word.p = gone.p group by word.doc_id)
    select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
           sha256(coalesce(t, '')) as kept_sha256
    from d left join kept on d.doc_id = kept.doc_id""",
)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.dedup_report(table(spark, sf, "documents"))


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_dedup.near_duplicate_classes(table(spark, sf, "documents"))


@query("op2_token_length_histogram")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return token_histogram.limit_report(token_histogram.length_histogram(token_histogram.token_lengths(table(spark, sf, "documents"))))


@query("op6_best_fit_packing")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"))


LOWER_WORDS_SQL = WORDS_SQL.replace("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


@query(
    "op8_containment_decontamination",
    f"""with d as (select doc_id, {LOWER_WORDS_SQL} as w from documents),
    q as (select item_id, {LOWER_WORDS_SQL} as w from benchmark),
    qk as (select *, least(len(w), 5) as k from q where len(w) > 0),
    qs as (select distinct item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as s
           from qk),
    ds as (select distinct doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as s
           from d cross join (select distinct k from qk) where len(w) >= k),
    n as (select item_id, count(*) as n_shingles from qs group by item_id)
    select doc_id, item_id, n_shingles, count(*) as n_shared
    from ds join qs using (k, s) join n using (item_id)
    group by doc_id, item_id, n_shingles having count(*) * 5 >= n_shingles * 4""",
)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.containment_pairs(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query(
    "op1_warc_capture_index",
    """with p as (select page_id, url, coalesce(html, '') as t, sha1(coalesce(html, '')) as h from pages),
    r as (select *, max(page_id) over (partition by h) as holder from p)
    select page_id, url, cast(octet_length(encode(t)) as bigint) as payload_bytes,
      array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (
        ((16 * (instr('0123456789abcdef', substr(h, 5 * i // 4 + 1, 1)) - 1) + instr('0123456789abcdef', substr(h, 5 * i // 4 + 2, 1)) - 1)
          >> (3 - (5 * i) % 4)) & 31)::int + 1, 1)), '') as payload_digest,
      case when page_id = holder then 'response' else 'revisit' end as record_type,
      case when page_id <> holder then holder end as refers_to
    from r""",
)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf, "pages"))


@query("op3_template_main_text")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return html_main.main_texts(table(spark, sf, "pages"))


@query("op5_version_fingerprints")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return version_sketch.compare_with_next(table(spark, sf, "documents"))


@query("op7_ngram_toxicity")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op9_license_digest_lookup", licenses.report_sql())
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_report(table(spark, sf, "documents"))


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitening_report(table(spark, sf, "embeddings"))


@query(
    "op12_line_dedup",
    """with g as (select doc_id, unnest(l) as line, unnest(range(1, len(l) + 1)) as p
      from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)),
    k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from g),
    common as (select key from k where key <> '' group by key having count(distinct doc_id) >= 10)
    select doc_id, cast(count(*) as bigint) as n_lines, cast(count(common.key) as bigint) as n_dropped,
      sha256(coalesce(string_agg(line, chr(10) order by p) filter (where common.key is null), '')) as kept_sha256
    from k left join common on k.key = common.key group by doc_id""",
)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf, "documents"))


@query("op13_cross_tokenizer_alignment")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return token_alignment.alignment_report(table(spark, sf, "documents"))
