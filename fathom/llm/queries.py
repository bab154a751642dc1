"""The registered queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm import chunks, decontam, html, jaccard, lines, mixing, pivots, quality, search, spelling, spm, suffix, warc
from fathom.llm.common import table

TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document, repeated ones too; null texts and sources as mixing.mix() has them; an empty table gives none."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each vector; null, zero and non-finite ones link with nothing; vectors of any length."""
    return pivots.near_vectors(table(spark, sf_dir, "embeddings"), 0.93)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; null and empty texts lose nothing; long texts are cut whole; other columns don't matter."""
    return chunks.chunk_report(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document, encoded whole; null texts as empty ones, which have no ids; repeated rows each."""
    return spm.encoded(table(spark, sf_dir, "documents"), tokenizer_path(), ids=False)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; texts without words and null ids link with nothing; rows that repeat an id are judged each."""
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), 4, "0.85")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; null texts as empty ones; null ids take no part; doc_id must identify a text."""
    return suffix.without_repeats(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each page, through archives that are written and read back; null html is an empty payload."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; null texts count as empty in the digest; null ids keep all lines; equal ids lose the same lines."""
    docs = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document, judged whole; null and empty texts have no words and fail the base rules."""
    return quality.quality(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each page; null and empty html gives an empty text; pages of any length take time in proportion."""
    return html.extract(table(spark, sf_dir, "pages"))


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document, repeated ones too; null and empty texts have no words; null item ids add no item."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans", "items")


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each word of seven code points and two occurrences or more; null texts have none; a null doc_id is empty in the checksums."""
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 50 rows for each benchmark item; items that no document matches have none; repeated documents are ranked each."""
    return search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_EVERY = (
    op1_mix_sources, op2_embedding_near_dedup, op3_substring_dedup, op4_sentencepiece, op5_ngram_jaccard_join, op6_suffix_array_dedup, op7_warc, op8_line_dedup,
    op9_quality_rules, op10_html_text, op11_benchmark_decontamination, op12_spelling_groups, op13_ranked_search,
)
QUERIES = {f.__name__: f for f in _EVERY}

#: Words of op11 and terms of op13 as a list, A-Z lowered.
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: From links (a, b): (id, component) of all that have one, by the smallest id that is reachable.
_COMPONENTS = """
        ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached AS (SELECT DISTINCT a AS id, a AS r FROM ways UNION SELECT reached.id, ways.b FROM reached JOIN ways ON reached.r = ways.a),
        component AS (SELECT id, min(r) AS component FROM reached GROUP BY id)"""

ORACLE_SQL = {
    "op2_embedding_near_dedup": f"""
        WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        good AS (
            SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM v
            WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x != 0)) > 0),
        links AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id < y.vec_id
            WHERE list_inner_product(x.e, y.e) / (x.norm * y.norm) >= 0.93),{_COMPONENTS}
        SELECT v.vec_id, (SELECT count(*) FROM ways WHERE ways.a = v.vec_id)::BIGINT AS n_links, coalesce(c.component, v.vec_id) AS component_id,
               v.vec_id = coalesce(c.component, v.vec_id) AS kept
        FROM v LEFT JOIN component c ON c.id = v.vec_id""",
    "op5_ngram_jaccard_join": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),{_COMPONENTS}
        SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, coalesce(c.component, d.doc_id) AS component_id
        FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN component c ON c.id = d.doc_id""",
    "op6_suffix_array_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
        firsts AS (SELECT s, min(doc_id) AS least FROM strings GROUP BY s),
        hits AS (SELECT doc_id, i FROM strings JOIN firsts USING (s) WHERE least < doc_id),
        marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM hits),
        numbered AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked),
        spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, k),
        ahead AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM spans),
        cut AS (
            SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(substr(h, (2 * z + 1)::BIGINT, (2 * (a - z))::BIGINT), '' ORDER BY a) AS head
            FROM ahead JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(coalesce(head || substr(h, (2 * last + 1)::BIGINT), h))) AS kept_sha256
        FROM d LEFT JOIN cut USING (doc_id)""",
    "op1_mix_sources": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   md5('mix' || coalesce(doc_id::VARCHAR, 'null')) AS k
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
        weighed AS (
            SELECT *, 2.0::DOUBLE * source_size AS most,
                   ([3, 1, 2])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
            FROM sources),
        levels AS (
            SELECT *,
                   ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
                    - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / (sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
            FROM weighed),
        shared AS (
            SELECT *, max(CASE WHEN level <= most / weight THEN level END) OVER () AS share FROM levels),
        aims AS (
            SELECT source, source_size, CASE WHEN share IS NULL THEN most ELSE least(most, share * weight) END AS target FROM shared),
        running AS (
            SELECT s.doc_id, s.size, a.source_size, a.target, round(a.target)::BIGINT AS budget,
                   coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id NULLS FIRST, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
            FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source)
        SELECT doc_id, size, source_size, target,
               CASE WHEN source_size = 0 THEN 0
                    ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - ahead)) END::BIGINT AS taken
        FROM running""",
    "op7_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (
            SELECT payload_digest, min(page_id) AS first_id FROM p WHERE strlen(payload) >= 100 GROUP BY payload_digest)
        SELECT p.page_id, strlen(payload)::BIGINT AS payload_bytes, p.payload_digest,
               CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
        FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND strlen(payload) >= 100""",
    "op11_benchmark_decontamination": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
        b AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
        places AS (
            SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM windows))),
        found AS (SELECT r, i, places.n, item_id FROM places JOIN windows ON places.n = windows.n AND places.s = windows.s),
        words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
        items AS (
            SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    "op12_spelling_groups": r"""
        WITH RECURSIVE bits AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i::BIGINT], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        runs AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
        counted AS (SELECT doc_id, run, count(*) AS n, hex(encode(concat(doc_id::VARCHAR, ':', run))) AS h FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
        spelled AS (
            SELECT doc_id, run, n,
                   list_transform(range(0, len(h) // 2), lambda i: (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1) AS b
            FROM counted),
        summed AS (
            SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS crc FROM spelled, bits),
        typed AS (SELECT CASE WHEN crc % 31 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n FROM summed),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        shorter AS (
            SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS s FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
        pairs AS (
            SELECT x.word AS a, y.word AS b FROM shorter x JOIN shorter y ON x.s = y.s AND x.i = y.i AND x.word <> y.word
            UNION SELECT word, s FROM shorter WHERE s IN (SELECT word FROM words)
            UNION SELECT s, word FROM shorter WHERE s IN (SELECT word FROM words)),
        ranked AS (
            SELECT a, b, y.n AS form_n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY y.n DESC, b) AS k
            FROM pairs JOIN words y ON y.word = b),
        judged AS (
            SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 10 * n THEN b END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
            FROM words LEFT JOIN ranked ON a = word AND k = 1),
        ways AS (
            SELECT word, word AS root FROM judged
            UNION ALL SELECT ways.word, judged.form FROM ways JOIN judged ON judged.word = root WHERE judged.form IS NOT NULL)
        SELECT word, judged.form, root, judged.n, judged.n_near, judged.form_n
        FROM judged JOIN ways USING (word) JOIN (SELECT word AS root, form AS last FROM judged) ends USING (root) WHERE last IS NULL""",
    "op13_ranked_search": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
        sizes AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
        totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS all_terms FROM sizes),
        wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
        posted AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
        weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
            FROM (SELECT term, count(*) AS df FROM posted GROUP BY term), totals),
        parts AS (
            SELECT p.r, p.term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // all_terms))) AS part
            FROM posted p JOIN weights USING (term) JOIN sizes USING (r), totals),
        scores AS (SELECT item_id, r, sum(part)::BIGINT AS score FROM parts JOIN wanted USING (term) GROUP BY item_id, r),
        ranked AS (
            SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
            FROM scores JOIN sizes USING (r) WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50""",
}
