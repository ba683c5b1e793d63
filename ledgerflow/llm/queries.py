"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import (
    deleted_interpolation,
    embedding_dedup,
    exact_dedup,
    language_id,
    lexical_search,
    license_scan,
    packing,
    periodic_runs,
    pii,
    quality,
    sampling,
    sentencepiece_lattice,
    simhash,
    substring_dedup,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"),
                         quality.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(_table(spark, sf_dir, "documents")).drop("finds")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = sentencepiece_lattice.encode(docs.withColumn("text", F.coalesce("text", F.lit(""))))
    return out.select("doc_id", "n_runs", (F.octet_length("ids") / 4).cast("long").alias("n_ids"),
                      F.crc32("ids").alias("ids_crc32"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                      F.sha2("base", 256).alias("base_sha256"), "spans")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = sampling.fold(F.col("doc_id"), 5) == 0
    model = language_id.fit(docs.where(~held_out))
    out = language_id.predict(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_groups(_table(spark, sf_dir, "embeddings"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = sampling.fold(F.col("doc_id"), 7) == 2
    out = deleted_interpolation.score_documents(docs, ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words to search: of a tenth of all ids the tail repeats its first words."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.find_runs(_table(spark, sf_dir, "documents"), change=looped)
    # the longest; of equals the first, then the one with the smallest period
    out = out.withColumn("top", F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less")))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.back")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.less")).alias("period"),
        F.expr("1000 * top.length div -top.less").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lexical_search.search(lexical_search.build_index(docs), docs, _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_license_scan": op2_license_scan,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_pii": op4_pii,
        "op5_language_id": op5_language_id,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_simhash": op7_simhash,
        "op8_embedding_dedup": op8_embedding_dedup,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_packing": op10_packing,
        "op11_lm_score": op11_lm_score,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_lexical_search": op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_substring_dedup": r"""
            WITH words AS (
              SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
            starts AS (
              SELECT doc_id, unnest(range(1, len(w) - 11)) AS s FROM words WHERE len(w) >= 13),
            win AS (
              SELECT starts.doc_id, s, array_to_string(list_slice(w, s, s + 12), ' ') AS k
              FROM starts JOIN words ON starts.doc_id = words.doc_id),
            least AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k HAVING count(*) > 1),
            hit AS (
              SELECT DISTINCT win.doc_id, unnest(range(s, s + 13)) AS pos
              FROM win JOIN least ON win.k = least.k WHERE least.m < win.doc_id),
            places AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM words),
            kept AS (
              SELECT places.doc_id, string_agg(word, ' ' ORDER BY places.pos) AS line
              FROM places LEFT JOIN hit ON places.doc_id = hit.doc_id AND places.pos = hit.pos
              WHERE hit.pos IS NULL GROUP BY places.doc_id),
            gone AS (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id)
            SELECT words.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
            FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id LEFT JOIN kept ON words.doc_id = kept.doc_id""",
        # all pairs: at this size the lattice finds every link (the measured recall is 1)
        "op8_embedding_dedup": """
            WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
            link AS (
              SELECT x.vec_id AS a, y.vec_id AS b FROM e AS x JOIN e AS y ON x.vec_id <> y.vec_id
              WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
            reach(a, b) AS (
              SELECT vec_id, vec_id FROM e
              UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
            least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
            n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
            SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
            FROM e JOIN least ON e.vec_id = least.a LEFT JOIN n ON e.vec_id = n.a""",
        "op9_exact_dedup": """
            WITH d AS (
              SELECT doc_id,
                     sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256,
                     regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm
              FROM documents),
            g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
            SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
            FROM d JOIN g ON d.norm = g.norm""",
        # words q apart that are equal, in stretches; all pairs of equal words of a document
        "op12_periodic_runs": r"""
            WITH RECURSIVE d AS (
              SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
            -- crc32 of the id's decimal digits, a bit at a time
            crc(doc_id, step, v) AS (
              SELECT doc_id, 0, CAST(4294967295 AS BIGINT) FROM d
              UNION ALL
              SELECT doc_id, step + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
              FROM (SELECT doc_id, step, CASE WHEN step % 8 = 0
                           THEN xor(v, CAST(ascii(substr(CAST(doc_id AS VARCHAR), step // 8 + 1, 1)) AS BIGINT)) ELSE v END AS x
                    FROM crc WHERE step < 8 * length(CAST(doc_id AS VARCHAR)))),
            h AS (SELECT doc_id, xor(v, 4294967295) AS h FROM crc WHERE step = 8 * length(CAST(doc_id AS VARCHAR))),
            s AS (
              SELECT d.doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS l,
                     CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a, 3 + (h // 10) % 8 AS k
              FROM d JOIN h ON d.doc_id = h.doc_id),
            p AS (
              SELECT doc_id, i, w[1 + CASE WHEN l AND i >= a THEN a + (i - a) % (1 + (n - a) // k) ELSE i END] AS word
              FROM (SELECT *, unnest(range(n)) AS i FROM s)),
            same AS (
              SELECT x.doc_id, y.i - x.i AS q, x.i FROM p AS x JOIN p AS y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i),
            stretch AS (
              SELECT doc_id, q, min(i) AS start, count(*) + q AS length
              FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM same)
              GROUP BY doc_id, q, g HAVING count(*) >= greatest(q, 12 - q)),
            run AS (SELECT doc_id, start, length, min(q) AS period FROM stretch GROUP BY doc_id, start, length),
            top AS (
              SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS r FROM run),
            listed AS (
              SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t
              FROM run GROUP BY doc_id),
            gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
            kept AS (
              SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS t
              FROM p LEFT JOIN gone ON p.doc_id = gone.doc_id AND p.i = gone.i WHERE gone.i IS NULL GROUP BY p.doc_id)
            SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
                   CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
                   sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
            FROM d LEFT JOIN listed ON d.doc_id = listed.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
            LEFT JOIN top ON d.doc_id = top.doc_id AND top.r = 1""",
        "op13_lexical_search": r"""
            WITH d AS (
              SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
            i AS (
              SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
            total AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
            tf AS (
              SELECT doc_id, term, count(*) AS tf, any_value(50 + (50 * n * docs) // words) AS m
              FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d), total GROUP BY doc_id, term),
            weight AS (
              SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
              FROM tf, total GROUP BY term),
            scored AS (
              SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
              FROM i JOIN tf ON i.term = tf.term JOIN weight ON i.term = weight.term GROUP BY item_id, doc_id)
            SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
            FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
                  FROM scored WHERE score > 0)
            WHERE rank <= 50""",
    }
