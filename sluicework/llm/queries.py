"""The registered queries of this subpackage: thin wraps of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm import (
    curve_neighbours, extendible_shards, language_cnn, line_dedup, ngram_join, packing, phrases, pieces, quality_cnn,
    quality_rules, source_mix, token_files, tree_negatives,
)
from sluicework.llm.shipping import ship
from sluicework.llm.texts import fold_of
from sluicework.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


SOURCE_WEIGHTS = (5, 2, 1)

MIX_SQL = r"""
WITH docs AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 13))::BIGINT AS place
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM docs GROUP BY source
), ranked AS (
    SELECT *, sum(source_size) OVER ()::BIGINT AS total,
           coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
           sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM totals WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)
), levels AS (
    SELECT *, (total - capped)::DOUBLE / open_weight AS own_level,
           (total - capped)::DOUBLE / open_weight * weight >= (3 * source_size)::DOUBLE AS clamped
    FROM ranked
), goals AS (
    SELECT source, source_size,
           CASE WHEN clamped THEN (3 * source_size)::DOUBLE
                ELSE (SELECT arg_min(l.own_level, l.capped) FROM levels l WHERE NOT l.clamped) * weight END AS target
    FROM levels
), running AS (
    SELECT d.doc_id, d.size, g.source_size, g.target, round(g.target)::BIGINT AS goal,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier
    FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (goal // source_size) * size
                 + least(greatest(goal % source_size - earlier, 0), size) END::BIGINT AS taken
FROM running
"""

SHARDS_SQL = f"""
WITH docs AS (
    SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS bits
    FROM documents
), nodes AS (
    SELECT depth, bits >> (60 - depth) AS prefix, count(*) AS n_rows, sum(size)::BIGINT AS n_bytes,
           sum(size) <= {extendible_shards.LIMIT} OR min(bits) = max(bits) AS fits
    FROM docs, (SELECT unnest(range(0, 61))::INT AS depth)
    GROUP BY depth, prefix
)
SELECT d.doc_id, d.size, n.depth || '-' || n.prefix AS shard, n.n_rows AS shard_rows, n.n_bytes AS shard_bytes
FROM docs d JOIN nodes n ON n.prefix = d.bits >> (60 - n.depth)
WHERE n.fits AND NOT EXISTS (
    SELECT 1 FROM nodes p WHERE p.fits AND p.depth < n.depth AND p.prefix = n.prefix >> (n.depth - p.depth))
"""


NEGATIVES_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), pairs AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
    FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id))::INT AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

PHRASES_SQL = r"""
WITH docs AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), pieces AS (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?
-]')), '[^ 	]+') AS w FROM docs
), spots AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), runs AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM spots, (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(w)
), counts AS (
    SELECT lang, m, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), several AS (
    SELECT c.* FROM counts c WHERE m >= 2 AND NOT EXISTS (
        SELECT 1 FROM counts b WHERE b.lang = c.lang AND b.m > c.m AND 100 * b.f >= 100 * c.f
           AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
    SELECT lang, phrase, f, m, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM several
), scores AS (
    SELECT c.lang, c.phrase, c.k, c.f AS a, l.f AS l, r.f AS r, t.n,
           1000::HUGEINT * c.f * t.n // (l.f::HUGEINT * r.f) AS score
    FROM cuts c JOIN totals t USING (lang)
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
), lowest AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, (row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase))::INT AS rank,
       phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM lowest QUALIFY rank <= 2000
"""


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        run.__name__ = function.__name__
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return run

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


@query()
def op1_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    fold = fold_of(F.col("doc_id"), 4)
    model = quality_cnn.fit(docs, read(spark, sf_dir, "labels"), usable=fold != 2)
    return quality_cnn.scored(docs, model).select(
        "doc_id", (fold == 2).alias("held_out"), "score",
        (F.col("score") >= quality_cnn.THRESHOLD).cast("int").alias("predicted"))


@query()
def op2_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query()
def op3_zstd_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    index = token_files.write(read(spark, sf_dir, "documents"), folder, tokenizer("word_bpe_49k.json"))
    return token_files.digests(token_files.read(index, folder))


@query()
def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(read(spark, sf_dir, "documents")).select(
        "doc_id", "line_no", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.line_no").alias("first_line_no"), "n_class", "kept")


@query()
def op5_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return curve_neighbours.search(vectors, F.col("vec_id") % 100 == 0)


@query(sql=SHARDS_SQL)
def op6_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "shards")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    shards = extendible_shards.write_shards(docs, folder).select(
        F.concat_ws("-", "depth", "prefix").alias("shard"), "n_rows", "n_bytes")
    stored = spark.read.schema("doc_id long, text string, shard string").parquet(folder)
    sized = stored.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"), "shard")
    return sized.join(F.broadcast(shards) if shards.count() <= extendible_shards.FEW_SHARDS else shards, "shard").select(
        "doc_id", "size", "shard", F.col("n_rows").alias("shard_rows"), F.col("n_bytes").alias("shard_bytes"))


@query(sql=MIX_SQL)
def op7_capped_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.shares(read(spark, sf_dir, "documents"), SOURCE_WEIGHTS)


@query()
def op8_ngram_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    usable = fold_of(F.col("doc_id"), 4) != 2
    model = quality_rules.fit(docs, read(spark, sf_dir, "labels"), usable=usable)
    return quality_rules.judged(docs, model).drop("text")


@query()
def op9_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"))


@query()
def op10_language_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = fold_of(F.col("doc_id"), 5)
    model = language_cnn.fit(docs, usable=fold != 0)
    return language_cnn.predicted(docs.drop("lang"), model).select(
        "doc_id", (fold == 0).alias("held_out"), "lang_pred", "score")


@query()
def op11_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json")))


@query(sql=NEGATIVES_SQL)
def op12_spanning_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"), moved.alias("label"))
    return tree_negatives.mine(vectors, F.col("vec_id") % 50 == 0)


@query(sql=PHRASES_SQL)
def op13_fingerprint_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))
