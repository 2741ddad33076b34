"""The operators over the driver's tables, and SQL for those that it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import bpe, byte_bpe, chat, exact_dedup, html_extract, importance, langid, mixing, ngram_join, quality, runs, secrets, substring_dedup
from finlake.llm.common import let, table, words_of

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS, BYTE_PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.drop("text", "clean_text")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(*chat.format_chat(rows.select("conv_id", "turn", "role", "text").unionByName(extra)))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *map(count, secrets.KINDS),
        F.sha2(F.encode(secrets.span_list(base), "UTF-8"), 256).alias("base_sha256"),
        secrets.span_list(F.col("secrets")).alias("spans"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs)
    return langid.predict(docs.select("doc_id", "text", langid.held_out(F.col("doc_id")).alias("held_out")), model).drop("text")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY, keep_ids=False)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"), keep_bytes=False)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def periodic(doc_id: Column, text: Column) -> Column:
    """A tenth of the texts, by a hash of their ids, with their words from one on repeated in a period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.get(words, at(i))), " ")).otherwise(text)

    return F.when(h % 10 == 0, let(words_of(text), repeated)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = runs.mark_runs(docs.select("doc_id", periodic(F.col("doc_id"), F.col("text")).alias("text")))
    found = found.select("*", runs.best_run(F.col("runs")).alias("best"))
    ratio = F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        ratio.alias("exponent_milli"),
        F.sha2(runs.run_list(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.encode_texts(docs, BYTE_RANKS, BYTE_PATTERN, keep_ids=False)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_exact_dedup, op3_mixing, op4_chat_format, op5_secret_scan, op6_language_id, op7_ngram_join, op8_bpe, op9_substring_dedup, op10_html_extract,
        op11_periodic_runs, op12_importance_resampling, op13_byte_bpe,
    )
}


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_WORDS = r"'[^\x20\x09-\x0D]+'"
_BAD = f"""symbols > 0.1 * size OR letters < 0.4 * size OR (NOT regexp_matches(line, '[.!?…。！？]') AND len(ws) >= 12)
    OR (({' OR '.join(f"contains(line, {_quoted(m)})" for m in '|»›•·')} OR contains(line, ' > ') OR contains(line, ' / ')) AND len(list_filter(ws, lambda w: regexp_full_match(w, '[|»›•·>/]+'))) > 0.2 * len(ws))
    OR ((contains(line, '://') OR contains(line, 'www.')) AND len(regexp_extract_all(line, '(?:https?://|www\\.)[^\\x20\\x09-\\x0D]+')) > 0.5 * len(ws))
    OR (size < 20 AND regexp_matches(trim(lower(line)), {_quoted(quality.MENU_LINE)})) OR regexp_matches(lower(line), {_quoted(quality.RIGHTS)})
    OR {' OR '.join(f"contains(lower(line), {_quoted(x)})" for phrases in quality.BOILERPLATE.values() for x in phrases)}"""

ORACLE_SQL = {
    "op1_quality_rules": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT doc_id, regexp_extract_all(t, {_WORDS}) AS ws FROM d),
        windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
        again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
        repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(8) AS r(k) GROUP BY 1),
        l AS (SELECT doc_id, line, regexp_extract_all(line, {_WORDS}) AS ws, regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g') AS dense FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
        m AS (SELECT doc_id, line, ws, length(dense) AS size, length(dense) - length(regexp_replace(dense, '[#*$%&|<>]', '', 'g')) AS symbols, length(regexp_replace(dense, '\\PL', '', 'g')) AS letters FROM l WHERE len(ws) > 0),
        j AS (SELECT *, ({_BAD}) AS bad FROM m),
        s AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, sum(size) AS word_chars, sum(symbols) AS n_symbols, count(*) FILTER (bad) AS n_bad_lines, coalesce(sum(size) FILTER (bad), 0) AS lost FROM j GROUP BY 1),
        o AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_repeat_words, s.* EXCLUDE (doc_id), len(ws) < 20 OR 100 * coalesce(n, 0) > 30 * len(ws) AS failed FROM w LEFT JOIN repeated USING (doc_id) LEFT JOIN s USING (doc_id))
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, CAST(coalesce(n_symbols, 0) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
               CAST(n_repeat_words AS BIGINT) AS n_repeat_words, failed AS base_failed, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_bad_lines, 0) AS BIGINT) AS n_bad_lines, CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars,
               NOT failed AND coalesce(lost, 0) <= 0.5 * coalesce(word_chars, 0) AS kept
        FROM o
    """,
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_importance_resampling": """
        WITH bytes AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
        dw AS (SELECT doc_id, unnest(ws) AS w FROM d), bw AS (SELECT unnest(ws) AS w FROM b),
        dn AS (SELECT w, count(*) AS n FROM dw GROUP BY 1), bn AS (SELECT w, count(*) AS n FROM bw GROUP BY 1),
        hashes AS (SELECT w, xor(list_reduce(list_concat([4294967295], list_transform(range(1, len(hex(w)), 2), lambda i: CAST('0x' || substr(hex(w), i, 2) AS BIGINT))), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
            FROM (SELECT w FROM dn UNION SELECT w FROM bn), bytes),
        s AS (SELECT bucket, sum(n) AS n FROM dn JOIN hashes USING (w) GROUP BY 1), t AS (SELECT bucket, sum(n) AS n FROM bn JOIN hashes USING (w) GROUP BY 1),
        gains AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
            FROM s LEFT JOIN t USING (bucket)),
        weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM dw JOIN hashes USING (w) JOIN gains USING (bucket) GROUP BY 1),
        o AS (SELECT d.doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8) AS BIGINT) + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score
            FROM d LEFT JOIN weights ON d.doc_id IS NOT DISTINCT FROM weights.doc_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS k, count(*) FILTER (n_features >= 20) OVER () AS n FROM o)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= 10 * n // 100 THEN k END AS rank FROM r
    """,
}
