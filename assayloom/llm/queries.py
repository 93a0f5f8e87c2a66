"""The registered queries of the training-data operators: thin digests of what each operator returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.llm.common import sha256_hex, table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.common import shared_path
    from assayloom.llm.warc_zstd import read_archives, with_records, write_archives

    folder = shared_path(spark, "warc")
    write_archives(with_records(table(spark, sf_dir, "pages").select("page_id", "url", "html")), folder)
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.jaccard_join import groups

    return groups(table(spark, sf_dir, "documents"), words=4, percent=85).select("doc_id", "n_shingles", "component_id", "n_links")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.suffix_dedup import without_repeats

    return without_repeats(table(spark, sf_dir, "documents")).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.toxicity import held_out, toxicity

    scored = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_pii_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.pii_weak import KINDS, find, fit, label, spelled

    labelled = label(table(spark, sf_dir, "documents"), keep=["doc_id"])
    found = find(labelled, fit(labelled))
    of = lambda k: F.filter("base", lambda x: x["kind"] == k)
    counts = [F.size(of(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, sha256_hex(spelled("base")).alias("base_sha256"), spelled("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.chat_format import format_chats, read_chats

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")
    )
    back = read_chats(format_chats(turns.unionByName(extra)))
    lines = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256_hex(lines).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        sha256_hex(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.phrase_index import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from assayloom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048)


def op9_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.ring_shards import assign

    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = assign(rows, F.col("doc_id"), [F.col("doc_id"), F.col("text_crc32"), F.col("size")], shards=24, slack=0.0)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_prefix_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.prefix_prints import prints

    return prints(table(spark, sf_dir, "documents"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from assayloom.llm.bpe import decoded, encoded

    path = public_tokenizers.path("word_bpe_49k.json")
    back = decoded(encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), path).select("doc_id", "ids"), path)
    spelled = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), sha256_hex(spelled).alias("ids_sha256"), sha256_hex(F.col("decoded")).alias("decoded_sha256"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.resampling import resampled

    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assayloom.llm.filter_audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if v}


ORACLES: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        q AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
                     max(page_id) OVER (PARTITION BY html) AS last FROM p)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to FROM q""",
    "op6_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, regexp_replace(text, '(\\|\[/?(?:INST|SYS|ROLE)\]|\[(?:TEXT|NEXT)\]|</?s>)', '\\\1', 'g') AS esc,
                     lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM t),
        s AS (SELECT *, CASE WHEN before = role THEN 8 WHEN role = 'user' THEN 15 WHEN role = 'assistant' THEN 9 WHEN role = 'system' THEN 13
                             ELSE 7 + length(regexp_replace(role, '(\\|\[/?(?:INST|SYS|ROLE)\]|\[(?:TEXT|NEXT)\]|</?s>)', '\\\1', 'g')) + 8 + 8 END AS marks FROM e)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(esc) + marks)::BIGINT AS formatted_chars
        FROM s GROUP BY conv_id""",
    "op13_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
        l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        m AS (
            SELECT part, (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
                 + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT
                 + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * (w.doc_id > least)::INT AS mask,
                 coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
            FROM w LEFT JOIN l USING (doc_id)),
        v AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
        f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(f, bit)),
        o AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        s AS (SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, range(1, 6) AS r(step)),
        c AS (
            SELECT part, filter_order, step, bit,
                   coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before > 0), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
                   coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
            FROM v, s GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
        FROM c""",
}
