"""One registered query per operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.scratch import new_path
from siltworks.llm import binary, bpe, chat, interaction, lines, minhash, neighbours, packing, quality, suffixes, urls, warc, whitening
from siltworks.llm.tables import store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return add


def tokenizer(name: str) -> str:
    """Where a public vocabulary file lies on this machine; a parameter of every operator."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


PLANTED = r"\### Assistant: </turn> ok"


@query(
    "op1_chat_formatting",
    rf"""
    WITH rows AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '{PLANTED}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED}'),
    numbered AS (
      SELECT *, row_number() OVER w AS n, lag(role) OVER w AS earlier,
             replace(replace(replace(replace(text, '\', '\s'), '</turn>', '\l/turn>'), '<turn/>', '\lturn/>'), '### ', '\h## ') AS safe,
             replace(replace(replace(replace(replace(role, '\', '\s'), '</turn>', '\l/turn>'), '<turn/>', '\lturn/>'), '### ', '\h## '), ':', '\c') AS name
      FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(safe) + CASE WHEN earlier IS DISTINCT FROM role THEN 6 + length(name) + 8 ELSE 7 END) AS BIGINT) AS formatted_chars,
           CAST(sum(CASE WHEN earlier IS DISTINCT FROM role THEN 1 ELSE 0 END) AS BIGINT) AS n_blocks
    FROM numbered GROUP BY conv_id""",
)
def op1_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED).alias("text"),
    )
    read = chat.parse(chat.format_chat(rows.unionByName(planted)))
    said = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "n_blocks",
    )


@query("op3_token_binary")
def op3_token_binary(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "token-shards")
    binary.write_token_shards(table(spark, sf, "documents"), path, tokenizer("word_bpe_49k.json"), end=2)
    return binary.token_index(spark, path)


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer("byte_bpe_50k.json"), end=0)


@query("op9_bpe_codec")
def op9_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    ids = bpe.encode_texts(table(spark, sf, "documents"), path)
    back = bpe.decode_texts(ids, path)
    return back.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    stats = store(quality.statistics(documents).drop("text"), "statistics", sweep=True)
    return quality.judge(stats).select("doc_id", *quality.STATISTICS, "base_failed", "kept", "distance")


@query("op10_fuzzy_lines")
def op10_fuzzy_lines(spark: SparkSession, sf: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query("op2_minhash_classes")
def op2_minhash_classes(spark: SparkSession, sf: str) -> DataFrame:
    found = minhash.classes(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(F.col("doc").alias("doc_id"), "class_id", F.col("first").alias("kept"))


@query("op4_repeated_passages")
def op4_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    out = suffixes.remove_repeated(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op7_merkle_audit",
    r"""
    WITH made AS (
      SELECT page_id, 'WARC/1.0' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), 'null')
             || '>' || e || 'WARC-Target-URI: ' || regexp_replace(coalesce(url, ''), '[\r\n]', ' ', 'g') || e || 'WARC-Payload-Digest: sha256:'
             || sha256(coalesce(html, '')) || e || 'Content-Type: text/html' || e || 'Content-Length: ' || strlen(coalesce(html, '')) || e || e
             || coalesce(html, '') || e || e AS record
      FROM pages, (SELECT chr(13) || chr(10) AS e))
    SELECT page_id, strlen(record) AS record_bytes, sha256(record) AS record_sha256,
           CASE page_id % 101 WHEN 7 THEN 'changed' WHEN 13 THEN 'lost' WHEN 19 THEN 'changed' WHEN 23 THEN 'changed' ELSE 'intact' END AS status
    FROM made""",
)
def op7_merkle_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Two replicas of all pages; every record of the first with what the audit says.

    In the second, records in mid-archive have another letter, are missing, have a misspelt length or are longer.
    """
    records = warc.records(table(spark, sf, "pages").select("page_id", "url", "html"))
    path = new_path(spark, "replicas")
    number = F.substr("name", F.lit(len("urn:page:") + 1)).try_cast("long")
    hit = F.coalesce(number % 101, F.lit(0))
    damaged = (
        F.when(hit == 7, F.overlay("record", F.lit("X"), F.lit(12)))
        .when(hit == 13, F.lit(None))
        .when(hit == 19, F.replace("record", F.lit("Content-Length:"), F.lit("Content-Lenght:")))
        .when(hit == 23, F.concat("record", F.lit(" and more")))
        .otherwise(F.col("record"))
    )
    warc.write_replicas(records, path, {"a": F.col("record"), "b": damaged})
    left, right = (store(warc.read_archives(spark, f"{path}/replica={side}"), "leaves") for side in "ab")
    found = store(warc.audit(left, right).filter("offset IS NOT NULL"), "audit")
    # moved records are whole
    found = found.select("archive", "seq", F.when(F.col("status") != "moved", F.col("status")).alias("status"))
    return left.join(found, ["archive", "seq"], "left").select(
        number.alias("page_id"),
        F.col("length").alias("record_bytes"),
        F.col("digest").alias("record_sha256"),
        F.coalesce("status", F.lit("intact")).alias("status"),
    )


@query("op8_hilbert_neighbours")
def op8_hilbert_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf, "embeddings"), every=20, k=20)


# The rules of the query, and the first host labels whose pages make its list.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
LISTED_LABELS = ["adult-x", "free-bets"]
_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query(
    "op11_url_filters",
    rf"""
    WITH cut AS (
      SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (
      SELECT page_id, url, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), {_ASCII}) AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(coalesce(rest, ''), '^[^?#]*\?([^#]*)', 1) AS query
      FROM cut),
    named AS (
      SELECT *, list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS told
      FROM split),
    made AS (
      SELECT *, CASE WHEN instr(url, '://') > 0 THEN regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
                || regexp_replace(path, '(\.html|/+)$', '') || CASE WHEN len(told) = 0 THEN '' ELSE '?' || array_to_string(told, '&') END END AS canonical
      FROM named),
    rules(verdict, rhost, rpath) AS (VALUES {", ".join(repr(r) for r in URL_RULES)}),
    best AS (
      SELECT page_id, arg_max(r.rhost || r.rpath, length(r.rhost || r.rpath)) AS rule, arg_max(r.verdict, length(r.rhost || r.rpath)) AS verdict
      FROM made m JOIN rules r ON (m.host = r.rhost OR ends_with(m.host, '.' || r.rhost)) AND starts_with(m.path, r.rpath) GROUP BY page_id),
    listed AS (SELECT DISTINCT canonical FROM made WHERE split_part(host, '.', 1) IN ({", ".join(repr(w) for w in LISTED_LABELS)}))
    SELECT m.page_id, m.host, m.path, m.canonical, b.rule,
           coalesce(b.verdict, CASE WHEN l.canonical IS NULL THEN 'allow' ELSE 'block' END) AS verdict
    FROM made m LEFT JOIN best b USING (page_id) LEFT JOIN listed l USING (canonical)""",
)
def op11_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    """All pages against the rules and a list: every URL seen on hosts for adults and betting."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    host = urls.split_url(F.col("url"))[0]
    listed = pages.filter(F.substring_index(host, ".", 1).isin(LISTED_LABELS)).select("url")
    return urls.judge_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "canonical", "rule", "verdict")


@query(
    "op12_filter_interactions",
    r"""
    WITH own AS (
      SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    failed AS (
      SELECT part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
             coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e,
             coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
             coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic FROM own),
    masks AS (
      SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
             sum(good::INT) AS good, sum(toxic::INT) AS toxic FROM failed GROUP BY 1, 2),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
    orders AS (
      SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
      WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND p.bit | q.bit | r.bit | s.bit | t.bit = 31),
    steps AS (
      SELECT o.filter_order, l.bit, instr(o.filter_order, l.x) AS step,
             (SELECT sum(e.bit) FROM letters e WHERE instr(o.filter_order, e.x) < instr(o.filter_order, l.x)) AS before
      FROM orders o, letters l),
    found AS (
      SELECT m.part, s.filter_order, s.step, s.bit,
             sum(CASE WHEN m.mask & (coalesce(s.before, 0) | s.bit) = 0 THEN m.n ELSE 0 END) AS kept,
             sum(CASE WHEN m.mask & coalesce(s.before, 0) = 0 AND m.mask & s.bit > 0 THEN m.n ELSE 0 END) AS removed,
             sum(CASE WHEN m.mask & coalesce(s.before, 0) > 0 AND m.mask & s.bit > 0 THEN m.n ELSE 0 END) AS redundant,
             sum(CASE WHEN m.mask = s.bit THEN m.n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN m.mask & coalesce(s.before, 0) = 0 AND m.mask & s.bit > 0 THEN m.good ELSE 0 END) AS good_lost,
             sum(CASE WHEN m.mask & coalesce(s.before, 0) = 0 AND m.mask & s.bit > 0 THEN m.toxic ELSE 0 END) AS toxic_lost
      FROM masks m, steps s GROUP BY 1, 2, 3, 4)
    SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
           unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
           (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
    FROM found""",
)
def op12_filter_interactions(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return interaction.interaction_audit(interaction.failure_masks(documents, table(spark, sf, "labels")))


@query("op13_lanczos_whitening")
def op13_lanczos_whitening(spark: SparkSession, sf: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))
