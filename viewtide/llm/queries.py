"""The registered queries: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import ball_search, grace_dedup, jaccard_join, language_id, lm_scoring, mixing, packing, pii, quality, secrets, sentence_spans, simhash, vector_codes
from viewtide.llm.common import read_documents

Run = Callable[[SparkSession, str], DataFrame]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree scores of all documents."""
    return lm_scoring.score_texts(lm_scoring.held_out_by_id(read_documents(spark, sf_dir)))


def word_tokenizer() -> str:
    """The place of the public vocabulary; the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces in sequences of 2,048."""
    return packing.pack_documents(read_documents(spark, sf_dir), word_tokenizer())


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, by base kinds and published key formats."""
    return secrets.digest(secrets.find_secrets(read_documents(spark, sf_dir)))


def secret_sql() -> str:
    """The spans of op3 by DuckDB: places are summed from the matches and the texts between."""
    parts = []
    for place, rule in enumerate(secrets.BASE_RULES + secrets.KEY_RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, found[i] AS found, part[i] AS part,
                list_sum([length(x) for x in around[1:i]])
                    + coalesce(list_sum([length(x) for x in found[1:i - 1]]), 0) AS start
            FROM (SELECT doc_id, found, part, around, unnest(range(1, len(found) + 1)) AS i FROM (
                SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS found,
                    regexp_extract_all(text, '{pattern}', {rule.group}) AS part,
                    string_split_regex(text, '{pattern}') AS around FROM d)) AS m
            WHERE length(part[i]) >= {rule.least}"""
        )
    counts = ", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in secrets.BASE_RULES)
    counted = ", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in secrets.BASE_RULES)
    written = "string_agg(kind || ':' || start || ':' || (start + length(found)), ',' ORDER BY start, place)"
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        s AS ({" UNION ALL ".join(parts)}),
        g AS (SELECT doc_id, {counted}, {written} FILTER (place < {len(secrets.BASE_RULES)}) AS base, {written} AS spans
            FROM s GROUP BY doc_id)
        SELECT d.doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN g USING (doc_id)"""


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all documents."""
    judged = quality.assess(read_documents(spark, sf_dir))
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"
    return judged.select(*names.split(), "log_perplexity", "spreads_away")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of similar documents, by links between their shingle sets."""
    groups = jaccard_join.similar_groups(read_documents(spark, sf_dir))
    return groups.select("doc_id", "n_shingles", "component_id", "class_id")


LINKS_SQL = r"""
    WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS MATERIALIZED (
        SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0) AS x),
    d AS MATERIALIZED (SELECT doc_id, CAST(count(*) AS BIGINT) AS n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS own
        FROM s GROUP BY doc_id),
    c AS MATERIALIZED (SELECT own, min(doc_id) AS class_id, min(n) AS n FROM d GROUP BY own),
    k AS MATERIALIZED (SELECT class_id, n, shingle FROM c JOIN s ON s.doc_id = c.class_id),
    l AS MATERIALIZED (SELECT a.class_id AS u, b.class_id AS v FROM k AS a JOIN k AS b USING (shingle)
        WHERE a.class_id <> b.class_id GROUP BY a.class_id, b.class_id, a.n, b.n
        HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    r(node, reached) AS (SELECT class_id, class_id FROM c UNION SELECT l.v, r.reached FROM r JOIN l ON l.u = r.node),
    g AS (SELECT node, min(reached) AS lowest FROM r GROUP BY node)
    SELECT t.doc_id, coalesce(d.n, 0) AS n_shingles, coalesce(g.lowest, t.doc_id) AS component_id, c.class_id
    FROM t LEFT JOIN d USING (doc_id) LEFT JOIN c USING (own) LEFT JOIN g ON g.node = c.class_id"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return simhash.compare_with_edits(read_documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages and language spans of all documents."""
    return language_id.identify_held_out(read_documents(spark, sf_dir))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents, with the terms that reveal it."""
    return pii.scan(read_documents(spark, sf_dir))


def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the sentences that repeat earlier passages."""
    cut = sentence_spans.remove_repeats(read_documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_sentences", "n_removed", "first_docs", "text")


def op4_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' places in a mixture of their sources."""
    docs = read_documents(spark, sf_dir).select("doc_id", "text", "source")
    return mixing.mix_sources(docs).drop("text")


def op11_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of all documents with equal texts stay."""
    return grace_dedup.exact_groups(read_documents(spark, sf_dir).select("doc_id", "text"))


GRACE_SQL = r"""
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
    g AS (SELECT text, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM t JOIN g USING (text)"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings."""
    coded, codebooks = vector_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = F.lit(vector_codes.digest(codebooks)).alias("codebooks_sha256")
    return vector_codes.with_label_errors(coded).select("vec_id", "code", "error", "label_error", digest)


def codes_sql() -> str:
    """The rounds of op12 one after the other, with all distances."""
    parts, entries, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    steps = [
        f"""WITH k AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, label,
                list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (SELECT n, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x
            FROM k, range({parts}) AS r(part)),
        f AS (SELECT n, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT {entries}),
        c0 AS MATERIALIZED (SELECT part, entry, x AS c FROM p JOIN f USING (n))"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (SELECT n, part, x, entry, d FROM (
                SELECT n, part, x, entry, d, row_number() OVER (PARTITION BY n, part ORDER BY d, entry) AS place
                FROM (SELECT n, p.part, x, entry,
                    CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
                    FROM p JOIN c{k} ON p.part = c{k}.part)) WHERE place = 1)"""
        )
        if k < rounds:
            steps.append(
                f"""c{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, c{k}.c) AS c FROM c{k} LEFT JOIN (
                    SELECT part, entry, list(mean ORDER BY i) AS c FROM (
                        SELECT part, entry, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS mean
                        FROM a{k}, range(1, 1 + (SELECT max(len(x)) FROM p)) AS r(i) GROUP BY part, entry, i)
                    GROUP BY part, entry) AS m USING (part, entry))"""
            )
    steps.append(
        f"""e AS (SELECT n, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM a{rounds} GROUP BY n),
        h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM k JOIN e USING (n), h"""
    )
    return ",\n".join(steps)


def op13_ball_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of all items."""
    return ball_search.rank_documents(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SEARCH_SQL = r"""
    WITH t AS MATERIALIZED (SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7F])+')) AS term
        FROM documents),
    b AS (SELECT item_id, term, count(*) AS often FROM (SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7F])+')) AS term
        FROM benchmark) AS x GROUP BY item_id, term),
    n AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY doc_id),
    s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
    f AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM t SEMI JOIN b USING (term) GROUP BY doc_id, term),
    w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
        FROM f, s GROUP BY term, docs),
    r AS (SELECT item_id, doc_id, CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
        FROM b JOIN w USING (term) JOIN f USING (term) JOIN n USING (doc_id), s GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM r WHERE score > 0 QUALIFY rank <= 20"""


def queries() -> dict[str, Run]:
    return {run.__name__: run for run in (op1_lm_scoring, op2_best_fit_packing, op3_secret_scans, op4_pfair_mixing, op5_quality_rules, op6_language_id, op7_jaccard_join, op8_sentence_spans, op9_simhash, op10_pii, op11_grace_dedup, op12_vector_codes, op13_ball_search)}


def oracle_sql() -> dict[str, str]:
    """SQL where it can say what a query does; the others are tested by brute force."""
    return {"op3_secret_scans": secret_sql(), "op7_jaccard_join": LINKS_SQL, "op11_grace_dedup": GRACE_SQL, "op12_vector_codes": codes_sql(), "op13_ball_search": SEARCH_SQL}
