"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import conversation_repair, embedding_dedup, html_text, language_id, lm_scoring, minhash, packing, periodic_runs, piece_sampling, quality, secret_scan, toxicity, vector_search
from llm.textbatch import crc_bucket

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those whose remainder modulo 3 is not 1."""

    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_bucket(F.col("doc_id"), 3) == 1, F.lit(False))
    net = language_id.fit_language_network(documents.where(~held_out))
    found = language_id.identify_languages(documents, net)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(lm_scoring.fit_models(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from labels whose remainder modulo 5 is not 0."""

    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_bucket(F.col("doc_id"), 5) == 0, F.lit(False))
    model = toxicity.fit_toxicity(documents, labels.where(~held_out))
    found = toxicity.score_toxicity(documents, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op9_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.sample_pieces(table(spark, sf_dir, "documents"))


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.select_by_importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    counts = [F.size(secret_scan.of_kind(spans, kind)).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS]
    base = secret_scan.joined(secret_scan.of_kind(spans, *secret_scan.BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), secret_scan.joined(spans).alias("spans"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = periodic_runs.plant_periods(table(spark, sf_dir, "documents"))
    found = periodic_runs.collapse_runs(planted)
    best = periodic_runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage_turns(table(spark, sf_dir, "conversations"))
    return conversation_repair.conversation_reports(damaged, copies="copies")


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_harmonic_packing": op2_harmonic_packing,
    "op3_segment_search": op3_segment_search,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_toxicity": op5_toxicity,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_wrapper_induction": op8_wrapper_induction,
    "op9_piece_sampling": op9_piece_sampling,
    "op10_importance_resampling": op10_importance_resampling,
    "op11_secret_scan": op11_secret_scan,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_repair": op13_conversation_repair,
}

#: crc32 of a text by the table of its polynomial, which the statement joins as ``crc_table``.
_CRC32 = """
    xor(list_reduce(list_transform(range(1, len({0}) + 1), lambda i: ascii({0}[i])::BIGINT),
        lambda c, b: xor(c >> 8, crcs[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)
"""
_CRC_TABLE = """crc_table AS (
            SELECT list_transform(range(256), lambda k: list_reduce(range(8),
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k)) AS crcs
        )"""



def _best(state: str, cost: int = 0, audit: str = "", *lines: str) -> str:
    """SQL of a state's cost, audit and repaired lines, each after a newline."""

    text = "".join(f" || chr(10) || '{line}'" for line in lines)
    return f"struct_pack(c := {cost}::BIGINT, p := '{audit}', r := ''{text}) AS {state}"


def _with(state: str, cost: int | str, letter: str, line: str | None = None) -> str:
    """SQL of a state's values after one more edit."""

    text = f" || chr(10) || {line}" if line else ""
    return f"struct_pack(c := {state}.c + {cost}, p := {state}.p || '{letter}', r := {state}.r{text})"


#: Queries that SQL can state over whole tables.
ORACLES: dict[str, str] = {
    "op3_segment_search": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        ),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op6_minhash_dedup": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id,
                   list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
            FROM documents WHERE doc_id IS NOT NULL
        ),
        sets AS (
            SELECT doc_id, CASE
                WHEN len(words) = 0 THEN []
                WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
            END AS shingles
            FROM split
        ),
        flat AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
            GROUP BY ALL
        ),
        links AS (
            SELECT a, b FROM common
            JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
            WHERE 100 * n >= 75 * (len(x.shingles) + len(y.shingles) - n)
        ),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM sets
            UNION
            SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
        ),
        roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN roots USING (doc_id)
    """,
    "op7_embedding_dedup": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.93
        ),
        reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings WHERE vec_id IS NOT NULL
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ),
        roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM roots LEFT JOIN counts USING (vec_id)
    """,
    "op12_periodic_runs": rf"""
        WITH {_CRC_TABLE},
        checked AS (
            SELECT doc_id, text, {_CRC32.format("CAST(doc_id AS VARCHAR)")} AS h
            FROM documents, crc_table
        ),
        split AS (
            SELECT doc_id, h, h // 10 AS g,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
            FROM checked
        ),
        ends AS (SELECT *, len(words) AS n, CASE WHEN len(words) > 0 THEN g % len(words) END AS a FROM split),
        planted AS (
            SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                THEN list_transform(range(n), lambda i: words[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END])
                ELSE words END AS words
            FROM ends
        ),
        placed AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(words) AS word, words FROM planted),
        grams AS (
            SELECT doc_id, i, array_to_string(words[i + 1:i + 16], ' ') AS gram FROM placed WHERE i + 16 <= n
        ),
        pairs AS (
            SELECT x.doc_id, x.i, y.i - x.i AS d FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i
        ),
        numbered AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM pairs),
        stretches AS (
            SELECT doc_id, d, min(i) AS start, max(i) + 16 + d - min(i) AS length FROM numbered GROUP BY doc_id, d, island
        ),
        runs AS (
            SELECT doc_id, start, length, min(d) AS period FROM stretches
            WHERE length >= greatest(24, 3 * d) GROUP BY doc_id, start, length
        ),
        listed AS (
            SELECT doc_id, count(*) AS n_runs,
                   string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
                   first(struct_pack(s := start, l := length, p := period) ORDER BY length / period DESC, start, period) AS best
            FROM runs GROUP BY doc_id
        ),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM placed
            WHERE NOT EXISTS (
                SELECT 1 FROM runs WHERE runs.doc_id = placed.doc_id AND i >= start + period AND i < start + length)
            GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
               1000 * best.l // best.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
               sha256(coalesce(collapsed, '')) AS collapsed_sha256
        FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op13_conversation_repair": rf"""
        WITH RECURSIVE {_CRC_TABLE},
        known AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
            FROM conversations
        ),
        sorted AS (SELECT *, {_CRC32.format("key")} % 20 AS sort FROM known, crc_table),
        damaged AS (
            SELECT conv_id, turn, unnest(range(CASE sort WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy,
                   CASE sort WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE sort WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM sorted
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged
        ),
        judged AS (
            SELECT *, CASE
                WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated'
                ELSE 'none' END AS fault,
                left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS previous
            FROM placed
        ),
        counts AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id
        ),
        -- Cheapest (cost, audit, repaired lines) after i rows in each state: e nothing, s system, u user, a assistant.
        steps AS (
            SELECT conv_id, 0::BIGINT AS i, {_best("e")}, {_best("s", 1000000)}, {_best("u", 5, "I", "user:")},
                   {_best("a", 10, "II", "user:", "assistant:")}
            FROM counts
            UNION ALL
            SELECT conv_id, i, e, s, u,
                   list_min([a, {_with("u", 5, "I", "'assistant:'")}]) AS a
            FROM (
                SELECT conv_id, i, e, s, a,
                       list_min([u, {_with("e", 5, "I", "'user:'")}, {_with("s", 5, "I", "'user:'")}, {_with("a", 5, "I", "'user:'")}]) AS u
                FROM (
                    SELECT conv_id, judged.i, {_with("e", 2, "D")} AS e,
                           CASE WHEN stays AND initial = 's' THEN list_min([{_with("s", 2, "D")}, {_with("e", "extra", "K", "role || ':' || text")}])
                                ELSE {_with("s", 2, "D")} END AS s,
                           CASE WHEN stays AND initial = 'u' THEN list_min([{_with("u", 2, "D")}, {_with("before_user", "extra", "K", "role || ':' || text")},
                                    {_with("before_user", "extra + 1", "R", "'user:' || text")}])
                                WHEN stays THEN list_min([{_with("u", 2, "D")}, {_with("before_user", "extra + 1", "R", "'user:' || text")}])
                                ELSE {_with("u", 2, "D")} END AS u,
                           CASE WHEN stays AND initial = 'a' THEN list_min([{_with("a", 2, "D")}, {_with("u", "extra", "K", "role || ':' || text")},
                                    {_with("u", "extra + 1", "R", "'assistant:' || text")}])
                                WHEN stays THEN list_min([{_with("a", 2, "D")}, {_with("u", "extra + 1", "R", "'assistant:' || text")}])
                                ELSE {_with("a", 2, "D")} END AS a
                    FROM (SELECT *, list_min([e, s, a]) AS before_user FROM steps) AS steps
                    JOIN (
                        SELECT *, fault IN ('none', 'truncated') AS stays, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra FROM judged
                    ) AS judged USING (conv_id)
                    WHERE judged.i = steps.i + 1
                )
            )
        ),
        repaired AS (
            SELECT conv_id, n, gaps, blank, duplicate, truncated, illegal, list_min([e, a]) AS best
            FROM steps JOIN counts USING (conv_id) WHERE i = n
        )
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
               coalesce(best.p, '') AS audit, sha256(coalesce(best.r[2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN repaired USING (conv_id)
    """,
}
