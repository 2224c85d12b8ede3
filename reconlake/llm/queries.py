"""One query per operator over the whole tables, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.llm import (
    conversation_trie,
    exact_stream,
    language,
    licenses,
    line_chunks,
    mixing,
    periodic_runs,
    pii,
    simhash,
    suffix_doubling,
    templates,
    token_counts,
    token_files,
)
from reconlake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return token_counts.count_tokens(documents(spark, sf_dir), path, TOKEN_LIMIT)


@query(
    "op2_mixing",
    r"""
    WITH RECURSIVE sized AS (
        SELECT doc_id, source, strlen(coalesce(text, '')) AS bytes,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::DOUBLE AS s,
               [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
        FROM sized GROUP BY source
    ), rounds(n, level) AS (
        -- share the rest again until no source is above twice its size
        SELECT 0, 1.5 * (SELECT sum(s) FROM sources) / (SELECT sum(w) FROM sources)
        UNION ALL
        SELECT n + 1, (SELECT (1.5 * sum(s) - sum(2.0 * s) FILTER (2.0 * s <= w * level))
                              / sum(w) FILTER (2.0 * s > w * level) FROM sources)
        FROM rounds
        WHERE n < 60 AND (SELECT count(*) FROM sources WHERE 2.0 * s <= w * level) > 0
    ), levels AS (SELECT max(level) AS level FROM rounds), shared AS (
        SELECT source, s, CASE WHEN 2.0 * s <= w * level THEN 2.0 * s ELSE w * level END AS target
        FROM sources, levels
    ), owed AS (
        SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0.0 END AS whole,
               CASE WHEN s > 0 THEN target / s - floor(target / s) ELSE 0.0 END AS fraction
        FROM shared
    ), ranked AS (
        SELECT d.doc_id, d.bytes, d.size, o.s, o.target, o.whole, o.fraction, d.source,
               (('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5)
                   / 281474976710656.0 AS u
        FROM sized d JOIN owed o ON d.source IS NOT DISTINCT FROM o.source
    ), summed AS (
        SELECT *, sum(size) OVER (
            PARTITION BY source
            ORDER BY CASE WHEN fraction > 0 THEN (u / (1 - u)) / (fraction / (1 - fraction)) END, doc_id NULLS FIRST, bytes
            ROWS UNBOUNDED PRECEDING) AS so_far
        FROM ranked
    )
    SELECT doc_id, size::BIGINT AS size, s::BIGINT AS source_size, target,
           (whole + CASE WHEN fraction > 0 AND so_far - size / 2 < target - whole * s THEN 1 ELSE 0 END)::INTEGER AS copies,
           (size * (whole + CASE WHEN fraction > 0 AND so_far - size / 2 < target - whole * s THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM summed
    """,
)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(documents(spark, sf_dir)).decisions()


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(documents(spark, sf_dir), path, public_tokenizers.path(TOKENIZER))
    return token_files.read_digests(spark, path)


@query(
    "op10_exact_dedup",
    r"""
    WITH cleaned AS (
        SELECT doc_id, length(coalesce(text, '')) AS points,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id,
           first_value(doc_id) OVER best AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           row_number() OVER best = 1 AS kept,
           text_sha256
    FROM cleaned
    WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_stream.ExactDedup(spark, f"{sf_dir}/documents.parquet").advance().result()


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.NearDuplicates(documents(spark, sf_dir)).components()


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.learn(docs))


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = templates.Leaks(documents(spark, sf_dir), benchmark).pairs()
    return found.select("doc_id", "item_id", "share", "as_written")


@query("op7_line_chunks")
def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.LineChunks(documents(spark, sf_dir)).report()


@query("op6_personal_data")
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.find_personal_data(docs, pii.fit(docs))
    base = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *[f"n_{kind}" for kind in pii.KINDS], base, "spans")


@query("op3_licenses")
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a source is a tree, with a directory per 1,000 and below it per 50 ids."""
    number = F.coalesce(F.col("doc_id"), F.lit(-1))
    thousand, fifty = F.floor(number / 1000), F.floor(number / 50)
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), thousand, fifty, F.concat(number, F.lit(".txt")))
    files = documents(spark, sf_dir).select("doc_id", "text", path.alias("path"))
    return licenses.LicenseScan(files, keep=("doc_id",)).result()


@query("op11_repeated_bytes")
def op11_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_doubling.RepeatedBytes(documents(spark, sf_dir)).report()
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op12_conversation_trie",
    r"""
    WITH keyed AS (
        SELECT conv_id, turn, length(coalesce(text, ''))::BIGINT AS points,
               sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k
        FROM conversations WHERE conv_id IS NOT NULL
    ), turns AS (
        SELECT conv_id, k, points, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS n FROM keyed
    ), given AS (
        -- CRC-32, bit by bit, of the decimal id
        SELECT conv_id, conv_id - conv_id % 100 AS base,
               xor(list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                   lambda s, b: list_reduce(
                       list_prepend(xor(s, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                       lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))
               ), 4294967295::BIGINT) % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM turns)
    ), rebuilt AS (
        SELECT g.conv_id, t.n, t.k, t.points FROM given g JOIN turns t ON t.conv_id = g.base AND t.n <= g.h
        UNION ALL
        SELECT g.conv_id, t.n, t.k, t.points FROM given g JOIN turns t ON t.conv_id = g.conv_id AND t.n > g.h
    ), paths AS (
        SELECT conv_id, 0 AS depth, 'root' AS node, NULL AS parent, 0::BIGINT AS points FROM given
        UNION ALL
        SELECT conv_id, depth, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), 'root'), points
        FROM (SELECT conv_id, points, row_number() OVER w AS depth, sha256(string_agg(k, ',') OVER w) AS node
              FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY n))
    ), nodes AS (
        SELECT node, parent, depth, points, min(conv_id) AS conv_id, count(*) AS n_convs
        FROM paths GROUP BY node, parent, depth, points
    ), below AS (
        SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
    ), rolled AS (
        SELECT p.node, sum((y.n_convs - 1) * y.points)::BIGINT AS saved_tokens,
               count(*) FILTER (b.node IS NULL) AS n_leaves
        FROM nodes y LEFT JOIN below b ON b.node = y.node JOIN paths p ON p.conv_id = y.conv_id AND p.depth <= y.depth
        GROUP BY p.node
    ), ends AS (
        SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
        FROM (SELECT conv_id, arg_max(node, depth) AS node FROM paths GROUP BY conv_id) GROUP BY node
    )
    SELECT x.conv_id, x.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, x.n_convs,
           coalesce(b.n_children, 0) AS n_children, r.n_leaves, r.saved_tokens,
           coalesce(e.ends_sha256, sha256('')) AS ends_sha256
    FROM nodes x JOIN rolled r ON r.node = x.node LEFT JOIN below b ON b.node = x.node
    LEFT JOIN ends e ON e.node = x.node LEFT JOIN nodes u ON u.node = x.parent
    """,
)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_trie.ConversationTrie(conversation_trie.with_shared_heads(turns)).nodes()


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(documents(spark, sf_dir), rewrite=periodic_runs.repeat_tail)
    # the longest; among equals the first, then the one of the smaller period
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("q")))
    best = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    length, period = -best["n"], best["q"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["s"].alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
