"""One query per operator, on whole tables, and the SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, langid, lexical, minhash, packing, periods, permutation, quality, suffixes, toxicity, warc
from .common import bounded_batches, held_out, table

CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    messages = chat.fold_events(chat.events_of_turns(turns.unionByName(own)))
    return chat.digests(chat.render(messages))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 3, 1)
    model = langid.train(docs, ~out)
    return langid.classify(docs.select("doc_id", "text", out.alias("held_out")), model).drop("text")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 3, 1)
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~out)
    scored = quality.score(docs.select("doc_id", "text", out.alias("held_out")), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~out)
    scored = toxicity.score(docs.select("doc_id", "text", out.alias("held_out")), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op6_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    vectors = table(spark, sf_dir, "embeddings")
    return permutation.nearest(vectors.where("vec_id % 50 = 0"), vectors, k=5)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs).drop("text")


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return suffixes.removal_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    index = warc.write_archives(warc.mark_revisits(table(spark, sf_dir, "pages")))
    return warc.read_records(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Texts of every tenth id (by its checksum) go on from some word as repeats of what follows it."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("long").alias("g"))
    chosen = F.coalesce((F.col("h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    repeated = planted.where(chosen).select("doc_id", "g", words.alias("w")).withColumn("a", F.expr("g % size(w)").cast("int"))
    repeated = repeated.withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)").cast("int"))
    text = F.expr("array_join(transform(sequence(0, size(w) - 1), i -> w[if(i < a, i, a + (i - a) % p)]), ' ')")
    return repeated.select("doc_id", text.alias("text")).unionByName(planted.where(~chosen).select("doc_id", "text"))


def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return periods.run_digests(with_planted_periods(table(spark, sf_dir, "documents")))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


QUERIES = {"op1_minhash": op1_minhash, "op2_chat": op2_chat, "op3_langid": op3_langid, "op4_quality": op4_quality, "op5_toxicity": op5_toxicity, "op6_permutation": op6_permutation, "op7_bpe": op7_bpe, "op8_decontam": op8_decontam, "op9_suffixes": op9_suffixes, "op10_warc": op10_warc, "op11_periods": op11_periods, "op12_packing": op12_packing, "op13_lexical": op13_lexical}

SQL = {
    "op1_minhash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), s AS (
            SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
            FROM w
        ), e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
        n AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles FROM s),
        p AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
            FROM e x JOIN e y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
        ), l AS (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * common >= 80 * (x.n_shingles + y.n_shingles - common)
        ), r AS (
            SELECT doc_id, doc_id AS reached FROM n
            UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached
        ), c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
        SELECT n.doc_id, n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN c USING (doc_id)
    """,
    "op2_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), e AS (
            SELECT *,
                regexp_replace(role, '([\\#<\n])', '\\\1', 'g') AS erole,
                regexp_replace(text, '([\\#<])', '\\\1', 'g') AS etext
            FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
            CAST(sum(4 + length(erole) + 1 + length(etext) + 8) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), m AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM p
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
        FROM m
    """,
    "op13_lexical": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), i AS (
            SELECT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), q AS (SELECT item_id, term, count(*) AS repeats FROM i GROUP BY ALL),
        s AS (SELECT count(*) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_terms FROM d WHERE len(words) > 0),
        t AS (
            SELECT doc_id, term, n, count(*) AS tf
            FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
        ), w AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight
            FROM t, s GROUP BY term, n_docs
        ), r AS (
            SELECT item_id, doc_id, CAST(sum(repeats * weight * (
                (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM t JOIN w USING (term) JOIN q USING (term), s GROUP BY item_id, doc_id
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM r WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
    """,
}
