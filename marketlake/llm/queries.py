"""The registered query of each operator (see the README for what they return)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import (bpe, chat_format, clustering, decontamination, exact_dedup, html_text, language, line_dedup, quality, simhash,
                            substring_dedup, token_counts, whitening)
from marketlake.llm.tables import Scratch, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def byte_bpe_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe.encode_and_decode(docs, byte_bpe_file())
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "op2"),
                                   bands=line_dedup.BANDS, equal_from=line_dedup.EQUAL_FROM)
    return found.select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_lines"), "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_dedup(read(spark, sf_dir, "documents"), Scratch(spark, "op3")).drop("component")
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = decontamination.decontaminate(docs, items, Scratch(spark, "op4"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = r"string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ')"
ORACLES["op4_decontamination"] = f"""
WITH d AS (SELECT doc_id, CASE WHEN w = [''] THEN [] ELSE w END AS w FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
 i AS (SELECT item_id, w, least(len(w), 10) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE w <> ['']),
 iw AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS words
        FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s FROM i)),
 ks AS (SELECT DISTINCT k FROM i),
 dw AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS words
        FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s FROM d, ks WHERE len(w) >= k)),
 hits AS (SELECT doc_id, item_id, s, dw.k FROM dw JOIN iw USING (k, words)),
 n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + k - 1)) AS p FROM hits) GROUP BY doc_id),
 it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)"""


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read(spark, sf_dir, "documents"), Scratch(spark, "op5"))


ORACLES["op5_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)"""


@query
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", *(F.round(c, 6).alias(c) for c in ("p_text", "p_meta", "score", "p_toxic")), "keep", "is_toxic")


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marker = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", marker), (-1, 1, "assistant", marker)], rows.schema)
    chats = chat_format.format_chats(rows.unionByName(planted))
    turns = chat_format.read_back(F.col("formatted"))
    loss = F.array_join(chat_format.trained_texts(F.col("pieces"), F.col("mask")), "")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.withColumns({"turns": turns, "loss": loss}).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


_CONTROL = r"([<\[])(\\*)(\||/?s>|<SYS>>|</SYS>>|/?INST\])"
ORACLES["op8_chat_format"] = f"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
 e AS (SELECT *, regexp_replace(role, '{_CONTROL}', '\\1\\\\\\2\\3', 'g') AS er, regexp_replace(text, '{_CONTROL}', '\\1\\\\\\2\\3', 'g') AS et FROM rows_),
 r AS (SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens, lead(role) OVER w IS DISTINCT FROM role AS closes
       FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, er, et))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, er, et)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, er, et) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(et) + CASE WHEN opens THEN 16 + length(er) ELSE 0 END + CASE WHEN closes THEN 7 ELSE 8 END) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id"""


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"), Scratch(spark, "op9"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, byte_bpe_file()).drop("text")


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read(spark, sf_dir, "embeddings"), Scratch(spark, "op11"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clustering.cluster(read(spark, sf_dir, "embeddings"), Scratch(spark, "op12"))
    # a row per centroid, at most 16
    small = found.centroids.select("cluster", F.col("inertia").alias("cluster_inertia"), F.lit(found.inertia).cast("long").alias("inertia"),
                                   F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))
    return found.rows.join(F.broadcast(small), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


_KEPT = """SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64"""
_NEAREST = """a{n} AS (SELECT row_id, any_value(vec_id) AS vec_id, any_value(x) AS x, min(d) AS distance, arg_min(cluster, d * 16 + cluster) AS cluster
  FROM (SELECT row_id, vec_id, x, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{n}) GROUP BY row_id)"""
_MOVED = """c{m} AS (SELECT c{n}.cluster, coalesce(moved.c, c{n}.c) AS c FROM c{n} LEFT JOIN (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS c
  FROM (SELECT cluster, pos, CAST(sum(x[pos]) AS BIGINT) AS s, count(*) AS n FROM a{n}, generate_series(1, 64) AS g(pos) GROUP BY cluster, pos) GROUP BY cluster) AS moved USING (cluster))"""
ORACLES["op12_clustering"] = f"""
WITH v AS ({_KEPT}),
 c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x AS c FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), 'null')) AS h, x FROM v ORDER BY h, x LIMIT 16)),
 {", ".join(_NEAREST.format(n=n) + ", " + _MOVED.format(n=n, m=n + 1) for n in range(3))}, {_NEAREST.format(n=3)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (cluster)"""


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language.fit(docs, learn=~held_out)
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")
