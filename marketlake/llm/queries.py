"""The registered queries of the corpus operators, with production parameters and whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import (
    decontaminate,
    fingerprints,
    html_extract,
    importance,
    line_dedup,
    lm_scoring,
    packing,
    periodic_runs,
    simhash,
    token_counts,
    toxicity,
    warc,
    window_packing,
)
from marketlake.llm.common import table
from marketlake.session import configure, scratch_root

Query = Callable[[SparkSession, str], DataFrame]

#: Rows with whole texts are long, so fewer of them go to Python at once.
ARROW_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark).conf.set(*ARROW_ROWS)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = configured
        if sql:
            SQL[run.__name__] = sql
        return run

    return register


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast((v >> {}) & 31 as integer), 1)"
_WARC_SQL = f"""
with hashed as (
  select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as hex from pages
),
groups as (
  select hex, unnest(range(8)) as k from (select distinct hex from hashed)
),
quads as (
  select hex, k, cast('0x' || substr(hex, 1 + 5 * cast(k as integer), 5) as bigint) as v from groups
),
digests as (
  select hex, string_agg({" || ".join(_DIGIT.format(n) for n in (15, 10, 5, 0))}, '' order by k) as payload_digest
  from quads group by hex
),
largest as (select hex, max(page_id) as top from hashed group by hex)
select page_id, octet_length(encode(body)) as payload_bytes, payload_digest,
  case when page_id is not distinct from top then 'response' else 'revisit' end as record_type,
  case when page_id is not distinct from top then null else top end as refers_to
from hashed join digests using (hex) join largest using (hex)
"""


@query(_WARC_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_root(spark)
    warc.write_archive(table(spark, sf_dir, "pages"), path, min_revisit_bytes=0)
    # The bytes are those of the rebuilt record of a response; a revisit has its payload elsewhere.
    headers = F.length("warc_header") + F.length("http_header") + F.lit(len(2 * warc.EOL))
    rebuilt = F.when(F.col("record_type") == "response", F.length("record") - headers).otherwise(
        F.length("payload")
    )
    return warc.read_archive(spark, path).select(
        "page_id",
        rebuilt.cast("long").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )


@query()
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a benchmark item in a document, within a fifth of its words."""
    return decontaminate.find_benchmark(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), capacity=4096, end_id=1
    )


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query()
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with earlier ones, and what they lost."""
    kept = line_dedup.drop_shared_passages(
        table(spark, sf_dir, "documents").select("doc_id", "text"), removed="removed_lines"
    )
    return kept.select("doc_id", "removed_lines", "text")


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query()
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of each document."""
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"),
        tokenizer("byte_bpe_multi_50k.tiktoken"),
        sections="line",
        rule="majority",
    )


@query()
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query()
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(
        table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), modulus=7, held_out=2
    )


def _planted_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth text, by its id, repeats the words after some place until its end."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(
        table(spark, sf_dir, "documents"), min_length=24, min_exponent=3, rewrite=_planted_repeats
    )
    lines = F.transform(
        "runs",
        lambda r: F.concat(
            F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")
        ),
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op12_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_packing.pack_windows(
        table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), capacity=2048, end_id=1
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
_IMPORTANCE_SQL = f"""
with remainders as (
  select list(list_reduce(list_prepend(n, range(8)),
    lambda c, k: case when c % 2 = 1 then xor(3988292384, c // 2) else c // 2 end) order by n) as part
  from range(256) r(n)
),
own as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
features as (select r, unnest(w) as f from own),
wanted as (select unnest({_WORDS}) as f from benchmark),
kinds as (select f, hex(encode(f)) as digits from (select f from features union select f from wanted)),
hashed as (
  select f, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(digits) // 2),
      lambda i: cast('0x' || substr(digits, 2 * i + 1, 2) as bigint))),
    lambda c, b: xor(c // 256, part[1 + xor(c, b) % 256]))) % 10000 as bucket
  from kinds, remainders
),
sources as (select bucket, count(*) as s from features join hashed using (f) group by bucket),
targets as (select bucket, count(*) as t from wanted join hashed using (f) group by bucket),
totals as (select (select count(*) from features) as all_s, (select count(*) from wanted) as all_t),
gains as (
  select bucket, floor(1000 * ln(
    (coalesce(t, 0) + 1)::double * (all_s + 10000)::double
    / ((coalesce(s, 0) + 1)::double * (all_t + 10000)::double)))::bigint as gain
  from (select range as bucket from range(10000)) left join sources using (bucket)
    left join targets using (bucket), totals
),
weighed as (
  select r, count(*) as n, floor(sum(gain)::double / count(*))::bigint as weight
  from features join hashed using (f) join gains using (bucket) group by r
),
scored as (
  select doc_id, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) + 0.5::double) / 4294967296::double)))::bigint as score
  from own left join weighed using (r)
),
drawn as (
  select *, n_features >= 20 as eligible,
    row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place,
    count(*) filter (n_features >= 20) over () as n
  from scored
)
select doc_id, n_features, weight, score,
  case when eligible and place <= 10 * n // 100 then place end as rank
from drawn
"""


@query(_IMPORTANCE_SQL)
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "benchmark"),
        max_words=1,
        buckets=10_000,
        seed="2024",
        min_words=20,
        percent=10,
    )
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
