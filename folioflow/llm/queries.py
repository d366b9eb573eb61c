"""One thin query per operator, and the SQL that states the same result where SQL can.

Each query applies its operator, with production parameters, to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import chat_format, decontam, divergence, language_id, language_model, mixing, quality, simhash, token_binary, toxicity, url_filter, vector_codes, warc
from folioflow.llm.common import id_bucket, scratch, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: A conversation of control strings, formatted along with the table's.
TRICKY = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.formatted(turns.unionByName(tricky)))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predicted(docs, language_id.train(docs))
    held_out = F.coalesce(id_bucket(F.col("doc_id"), language_id.FOLDS) == language_id.HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = token_binary.write_shards(docs, scratch(spark, "token-shards"), tokenizer_path())
    return token_binary.read_shards(manifest, with_ids=False)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    drawn = mixing.sampled(mixing.sized(docs))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    field = toxicity.train(toxicity.sample(docs, labels))
    scores = toxicity.scored(docs, field)
    held_out = F.coalesce(id_bucket(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), scratch(spark, "archives"))
    return warc.captures(manifest, with_payload=False).select(
        "page_id",
        warc.payload_bytes().alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("refers_to"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(table(spark, sf_dir, "documents"))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_language_id": op2_language_id,
    "op3_token_binary": op3_token_binary,
    "op4_quality": op4_quality,
    "op5_url_filter": op5_url_filter,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_toxicity": op8_toxicity,
    "op9_decontam": op9_decontam,
    "op10_warc": op10_warc,
    "op11_vector_codes": op11_vector_codes,
    "op12_divergence": op12_divergence,
    "op13_language_model": op13_language_model,
}

def _vector_codes_sql() -> str:
    """Two rounds and a last assignment, each against every entry."""
    assigned = """, a{k} AS MATERIALIZED (
            SELECT rid, p, part, any_value(x) AS x, min(d * 64 + e) % 64 AS e, min(d) AS d
            FROM (SELECT t.rid, t.p, t.x, t.part, c.e, list_sum(list_transform(range(1, len(t.x) + 1), lambda i: (t.x[i] - c.x[i]) * (t.x[i] - c.x[i])))::BIGINT AS d FROM parts t JOIN c{k} c USING (p))
            GROUP BY rid, p, part
        )"""
    moved = """, s{k} AS (
            SELECT p, e, i, sum(y)::BIGINT AS s, count(*) AS n FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY p, e, i
        ), c{n} AS MATERIALIZED (
            SELECT c.p, c.e, coalesce(m.x, c.x) AS x
            FROM c{k} c LEFT JOIN (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{k} GROUP BY p, e) m ON m.p = c.p AND m.e = c.e
        )"""
    return (
        """
        WITH ok AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(embedding) % 16 = 0 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
        ), kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS rid, * FROM ok WHERE len(v) = (SELECT len(v) FROM ok ORDER BY vec_id NULLS LAST, v LIMIT 1)
        ), parts AS MATERIALIZED (
            SELECT rid, p, 0 AS part, v[(p * len(v) // 16 + 1)::BIGINT : ((p + 1) * len(v) // 16)::BIGINT] AS x FROM kept, range(16) r(p)
        ), c0 AS MATERIALIZED (SELECT p, rid - 1 AS e, x FROM parts WHERE rid <= 64)"""
        + "".join(assigned.format(k=k) + (moved.format(k=k, n=k + 1) if k < 2 else "") for k in range(3))
        + """, books AS (
            SELECT sha256(string_agg(list_aggregate(x, 'string_agg', ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2
        ), coded AS (
            SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY rid
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN kept USING (rid), books
    """
    )


ORACLE_SQL: dict[str, str] = {
    "op11_vector_codes": _vector_codes_sql(),
    "op4_quality": r"""
        WITH t0 AS (
            SELECT doc_id, lang, coalesce(text, '') AS text FROM documents
        ), t1 AS (
            SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, regexp_replace(text, '[a-z]+', '', 'g') AS s1 FROM t0
        ), t2 AS (SELECT *, regexp_replace(s1, '[\x20\x09-\x0D]+', '', 'g') AS s2 FROM t1
        ), t3 AS (SELECT *, regexp_replace(s2, '[.,;:!?''"()\-]+', '', 'g') AS s3 FROM t2
        ), t4 AS (SELECT *, regexp_replace(s3, '[#*$%&|<>]+', '', 'g') AS s4 FROM t3
        ), t5 AS (SELECT *, regexp_replace(s4, '[A-Z]+', '', 'g') AS s5 FROM t4
        ), t6 AS (SELECT *, regexp_replace(s5, '\p{L}+', '', 'g') AS s6 FROM t5
        ), t7 AS (SELECT *, regexp_replace(s6, '\p{N}+', '', 'g') AS s7 FROM t6
        ), counted AS (
            SELECT row_number() OVER () AS rid, doc_id, lang, words, len(words)::BIGINT AS n_words,
                   length(text) - length(s1) AS c_lower, length(s1) - length(s2) AS c_space, length(s2) - length(s3) AS c_punctuation,
                   length(s3) - length(s4) AS n_symbols, length(s4) - length(s5) AS c_upper, length(s5) - length(s6) AS c_letter,
                   length(s6) - length(s7) AS c_digit, length(s3) - length(s4) + length(s7) AS c_symbol,
                   (length(text) - (length(s1) - length(s2)))::BIGINT AS word_chars,
                   list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM t7
        ), grams AS (
            SELECT rid, unnest(range(1, n_words - 1)) AS i, words FROM counted WHERE n_words >= 3
        ), hits AS (
            SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS c FROM grams) WHERE c > 1
        ), covered AS (
            SELECT rid, sum(least(3, coalesce(nxt - i, 3)))::BIGINT AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM hits) GROUP BY rid
        ), sums AS (
            SELECT lang, sum(n_words) AS total, sum(c_space) AS s, sum(c_lower) AS l, sum(c_upper) AS u, sum(c_letter) AS o, sum(c_digit) AS d,
                   sum(c_punctuation) AS p, sum(c_symbol) AS y, sum(c_space + c_lower + c_upper + c_letter + c_digit + c_punctuation + c_symbol) AS z
            FROM counted GROUP BY lang
        ), large AS (
            SELECT lang, total, [s / z, l / z, u / z, o / z, d / z, p / z, y / z] AS r FROM sums WHERE lang IS NOT NULL AND total >= 2000
        ), frequent AS (
            SELECT lang, word, count(*) AS n, any_value(total) AS total FROM (SELECT lang, unnest(words) AS word FROM counted) JOIN large USING (lang)
            GROUP BY lang, word HAVING count(*) >= 0.004 * any_value(total)
        ), common AS (
            SELECT lang, word, n::DOUBLE / total AS q, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS k FROM frequent QUALIFY k <= 12
        ), found AS (
            SELECT rid, lang, word, count(*) AS n FROM (SELECT rid, lang, unnest(words) AS word FROM counted) GROUP BY rid, lang, word
        ), shares AS (
            SELECT c.rid, k.q, coalesce(f.n, 0)::DOUBLE / greatest(c.n_words, 1) AS p
            FROM counted c JOIN common k ON c.lang = k.lang LEFT JOIN found f ON f.rid = c.rid AND f.word = k.word
        ), entries AS (
            SELECT rid, p, q FROM shares UNION ALL
            SELECT rid, greatest(0.0, 1 - sum(p)), greatest(0.0, 1 - sum(q)) FROM shares GROUP BY rid
        ), word_js AS (
            SELECT rid, sqrt(greatest(0.0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS wd
            FROM entries GROUP BY rid
        ), class_entries AS (
            SELECT c.rid, unnest([c_space, c_lower, c_upper, c_letter, c_digit, c_punctuation, c_symbol]) AS n,
                   unnest(l.r) AS q, c_space + c_lower + c_upper + c_letter + c_digit + c_punctuation + c_symbol AS chars
            FROM counted c JOIN large l USING (lang)
        ), class_js AS (
            SELECT rid, any_value(chars) AS chars,
                   sqrt(greatest(0.0, sum(CASE WHEN n > 0 THEN n / chars * log2(n / chars / ((n / chars + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((n / chars + q) / 2)) ELSE 0 END) / 2)) AS cd
            FROM class_entries WHERE chars >= 200 GROUP BY rid
        ), verdict AS (
            SELECT c.doc_id, c.n_words, c.word_chars, c.n_symbols::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words,
                   c.n_words < 50 OR 100 * coalesce(v.n, 0) > 50 * c.n_words AS base_failed,
                   coalesce(cd > 0.3, false) OR (c.n_words >= 60 AND coalesce(wd > 0.33, false)) AS far
            FROM counted c LEFT JOIN covered v USING (rid) LEFT JOIN class_js USING (rid) LEFT JOIN word_js USING (rid)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept FROM verdict
    """,
    "op1_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), escaped AS (
            SELECT *, regexp_replace(regexp_replace(text,
                '<(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>)', '<\\\1\2', 'g'), '\[(\\*)(/?INST\])', '[\\\1\2', 'g') AS e FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(12 + length(role) + 1 + length(e) + 11)::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id
    """,
    "op6_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS h FROM documents
        ), per AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
        ), weighed AS (
            SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS w,
                   source_size * 2.0::DOUBLE AS cap FROM per
        ), level AS (
            SELECT *, cap / w AS full_at, coalesce(sum(cap) OVER lower, 0.0::DOUBLE) AS below,
                   sum(w) OVER () - coalesce(sum(w) OVER lower, 0.0::DOUBLE) AS w_from, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS wanted
            FROM weighed
            WINDOW lower AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), found AS (
            SELECT *, max(CASE WHEN (wanted - below) / w_from <= full_at THEN (wanted - below) / w_from END) OVER () AS lv FROM level
        ), goals AS (
            SELECT source, source_size, CASE WHEN lv IS NULL OR full_at <= lv THEN cap ELSE lv * w END AS target FROM found
        ), rated AS (
            SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
                   ('0x' || substr(md5('mix-1:' || coalesce(source, '')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0::DOUBLE AS u0 FROM goals
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY
                CASE WHEN size < 16 THEN size ELSE floor(log2(size::DOUBLE) * 8)::BIGINT END, h) - 1 AS pos
            FROM sized
        ), placed AS (
            SELECT r.doc_id, r.size, r.source, g.source_size, g.target, g.rate, g.u0, r.pos FROM ranked r JOIN rated g ON r.source IS NOT DISTINCT FROM g.source
        )
        SELECT doc_id, size, source_size, target, (size * least(2, floor((pos + 1) * rate + u0) - floor(pos * rate + u0)))::BIGINT AS taken FROM placed
    """,
    "op10_warc": r"""
        WITH payloads AS (
            SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
        ), digests AS (
            SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS sha FROM payloads
        ), firsts AS (
            SELECT sha, min(page_id) AS original FROM digests GROUP BY sha
        )
        SELECT page_id, payload_bytes,
               list_aggregate(list_transform(range(32), lambda i:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha, (i // 4) * 5 + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = original OR original IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> original THEN original END AS refers_to
        FROM digests JOIN firsts USING (sha)
    """,
    "op12_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
        ), words AS (
            SELECT rid, lang, source, term, count(*) AS n FROM (SELECT rid, lang, source, unnest(terms) AS term FROM docs) GROUP BY rid, lang, source, term
        ), vocabulary AS (
            SELECT lang, term, sum(n)::HUGEINT AS lang_count FROM words GROUP BY lang, term HAVING count(*) >= 30
        ), sums AS (
            SELECT lang, source, term, sum(n)::HUGEINT AS c FROM words JOIN vocabulary USING (lang, term) GROUP BY lang, source, term
        ), kept AS (
            SELECT lang, count(*)::HUGEINT AS v, sum(lang_count)::HUGEINT AS lang_n FROM vocabulary GROUP BY lang
        ), totals AS (
            SELECT lang, source, sum(c)::HUGEINT AS n FROM sums GROUP BY lang, source
        ), grp AS (
            SELECT g.lang, g.source, coalesce(t.n, 0)::HUGEINT AS n, coalesce(k.v, 0)::HUGEINT AS v, coalesce(k.lang_n, 0)::HUGEINT AS lang_n
            FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN totals t USING (lang, source) LEFT JOIN kept k USING (lang)
        ), grid AS (
            SELECT g.lang, g.source, w.term, coalesce(s.c, 0)::HUGEINT AS c, 1 + (1000000000 * (coalesce(s.c, 0)::HUGEINT + 5)) // (g.n + 5 * g.v) AS p,
                   1 + (1000000000 * (w.lang_count + 5)) // (g.lang_n + 5 * g.v) AS q
            FROM grp g JOIN vocabulary w USING (lang) LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.term = w.term
        ), apart AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
            FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
        ), listed AS (
            SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM grid WHERE c > 0 AND p > q
        ), every AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM listed)
        )
        SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM every WHERE part = 'pair' OR rank <= 50
    """,
}
