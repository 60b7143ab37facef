"""The operators over their whole tables, as registered queries.

Each query calls its operator with production parameters and derives the columns that its
contract fixes. Where SQL can express the result, ``oracle_sql`` has it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollspan.llm import bitpack, kneser_ney, license_templates, mixing, mtree, packing, preferences, resampling, sentencepieces, simhash, spelling, syncmers, toxicity
from rollspan.llm.frames import prepare, scratch_path, table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(prepare(spark), sf_dir)
        _QUERIES[name] = run
        if sql:
            _SQL[name] = sql
        return run
    return add


#: CRC-32 of a text column: its table by rule, its bytes from the hexadecimal form.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i))"""


def _crc(x: str) -> str:
    """CRC-32 of the SQL text ``x``, where ``t`` is the table."""
    octets = f"list_transform(range(strlen({x})), lambda i: CAST('0x' || substr(hex(encode({x})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda v, b: xor(v >> 8, t[(xor(v, b) & 255) + 1])), 4294967295)"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_pfair_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.schedule(docs, ["doc_id"], F.xxhash64("doc_id"), F.col("source"))


@query("op2_kneser_ney_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_simhash_bktree")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, radius=4)


@query("op4_template_licenses")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.scan_licenses(table(spark, sf_dir, "documents"))


@query("op5_mtree_top_k", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS w FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(mtree.integer_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


@query("op6_closed_syncmers")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_edits(table(spark, sf_dir, "documents"))


@query("op7_preference_pairs")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = preferences.turns_of(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return preferences.format_pairs(chosen, preferences.swapped_replies(chosen))


@query("op8_lexicon_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op9_bit_packed_ids")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    bitpack.write_ids(table(spark, sf_dir, "documents"), out, vocabulary("word_bpe_49k.json"), keeps_blanks=False, end=1)
    return bitpack.read_documents(spark, out)


@query("op10_bounded_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), keeps_blanks=True, end=0)


@query("op11_backtracking_pieces")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digest_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op12_prefix_suffix_tiles", f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id || ':' || w AS named, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS w
    FROM documents) WHERE length(w) >= 7 GROUP BY ALL),
hashed AS (SELECT w, n, {_crc("named")} AS h FROM runs, crc_table),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN holes b ON a.word = b.rest
  UNION SELECT b.word, a.word, a.n FROM words a JOIN holes b ON a.word = b.rest),
best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) = 1),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
ways AS (SELECT word, form AS last FROM forms WHERE form IS NOT NULL UNION ALL SELECT ways.word, f.form FROM ways JOIN forms f ON f.word = ways.last WHERE f.form IS NOT NULL),
roots AS (SELECT ways.word, last AS root FROM ways JOIN forms f ON f.word = ways.last WHERE f.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN roots USING (word)""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.noisy_words(table(spark, sf_dir, "documents")))


@query("op13_importance_resampling", f"""
WITH {_CRC_TABLE},
words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS w
  FROM (SELECT doc_id, text FROM documents UNION ALL SELECT NULL, text FROM benchmark)),
counts AS (SELECT doc_id, w, count(*) AS n FROM words GROUP BY ALL),
buckets AS (SELECT w, {_crc("w")} % 10000 AS bucket FROM (SELECT DISTINCT w FROM counts), crc_table),
totals AS (
  SELECT bucket, CAST(sum(n) FILTER (doc_id IS NOT NULL) AS BIGINT) AS s, CAST(sum(n) FILTER (doc_id IS NULL) AS BIGINT) AS t
  FROM counts JOIN buckets USING (w) GROUP BY bucket),
whole AS (SELECT CAST(sum(s) AS DOUBLE) AS all_s, CAST(sum(t) AS DOUBLE) AS all_t FROM totals),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + 10000) / ((coalesce(s, 0) + 1) * (all_t + 10000)))) AS BIGINT) AS gain FROM totals, whole),
sums AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight
  FROM counts JOIN buckets USING (w) JOIN gains USING (bucket) WHERE doc_id IS NOT NULL GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents d LEFT JOIN sums USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= 10 * n // 100 THEN r END AS rank FROM ranked""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
