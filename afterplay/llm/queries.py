"""The queries of the operators of this subpackage, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from afterplay.llm import audit, jaccard, language, metric_tree, mixing, packing, perplexity, pii, quality, secrets, token_counts, whitening, winnow
from afterplay.llm.arrow import small_batches
from afterplay.llm.components import written
from afterplay.plans.registry import Query, table

REGISTRY: dict[str, Query] = {}
GOOD_FROM = 0.3
HELD_OUT = 5


def query(name: str, sql: str | None = None):
    def register(function):
        REGISTRY[name] = Query(name, lambda spark, folder: function(small_batches(spark), folder), sql)
        return function

    return register


def tokenizer() -> str:
    """The file of the public tokenizer that the queries use; only they need its package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def remainder(column: str, of: int) -> F.Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % of


MIXED_SQL = r"""
    WITH counted AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
        FROM {docs}
    ), banded AS (
        SELECT *, md5(coalesce(doc_id::VARCHAR, '')) AS place,
            (size >> greatest(length(bin(size)) - 4, 0)) << greatest(length(bin(size)) - 4, 0) AS band
        FROM counted
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY band, place, doc_id, size) - 1 AS nth FROM banded
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
            (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
        FROM counted GROUP BY source
    ), caps AS (SELECT *, source_size * 3 AS cap, sum(source_size) OVER () AS everything FROM sources),
    marked AS (
        SELECT *, cap * sum(weight) OVER (
                ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING
            ) <= (everything - coalesce(sum(cap) OVER (
                ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
            ), 0)) * weight AS capped
        FROM caps
    ), targets AS (
        SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE
            (everything - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0))::DOUBLE * weight
            / (sum(CASE WHEN NOT capped THEN weight END) OVER ())::DOUBLE END AS target,
            ('0x' || substr(md5('mix-1' || CASE WHEN source IS NULL THEN ':null' ELSE '=:' || source END), 1, 8))
                ::BIGINT::DOUBLE / 4294967296 AS beginning
        FROM marked
    ), shares AS (SELECT *, coalesce(target / nullif(source_size, 0), 0) AS share FROM targets),
    mixed AS (
        SELECT r.doc_id, r.source, r.size, s.source_size, s.target,
            (floor((nth + 1) * share + beginning) - floor(nth * share + beginning))::BIGINT AS copies
        FROM ranked r JOIN shares s ON r.source IS NOT DISTINCT FROM s.source
    )
"""


@query(
    "op1_source_mixing",
    MIXED_SQL.format(docs="documents")
    + "SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed",
)
def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size")
    )
    mixed = mixing.mix(docs, F.col("size"))
    return mixed.select(
        "doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


TOP = 5
TOP_SQL = """
    WITH usable AS (
        SELECT vec_id, embedding FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
    ), whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM usable
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op2_metric_tree_search", TOP_SQL)
def metric_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = written(metric_tree.scaled(table(spark, folder, "embeddings")), "vectors")
    index = metric_tree.build(vectors)
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return metric_tree.top_k(vectors.filter("id % 50 = 0"), index, TOP)


@query("op3_cross_entropy_difference")
def cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    counted = perplexity.tokens(table(spark, folder, "documents"), tokenizer())
    return perplexity.score(counted, perplexity.train(counted, good))


@query("op4_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    counted = written(quality.with_statistics(table(spark, folder, "documents"), "doc_id"), "statistics")
    trees = quality.train(counted, table(spark, folder, "labels"), remainder("doc_id", HELD_OUT) != 0)
    return quality.score(counted, trees).select(
        "doc_id",
        (remainder("doc_id", HELD_OUT) == 0).alias("held_out"),
        "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
    )


@query("op5_winnowing_fingerprints")
def winnowing_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.fingerprints_and_edits(table(spark, folder, "documents"))


@query("op6_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(table(spark, folder, "documents"))


@query("op7_crf_language_id")
def crf_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.train(docs, remainder("doc_id", 3) != 1)
    return language.predict(docs, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )


@query("op8_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer())


def span_digests(found: DataFrame, base: tuple[str, ...], learned: str) -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans, from arrays of spans."""
    line = "concat_ws(':', s.kind, s.start, s.end)"
    shapes = f"concat_ws(',', transform(filter(found, s -> s.kind <> '{learned}'), s -> {line}))"
    counts = [
        F.expr(f"CAST(size(filter(found, s -> s.kind = '{kind}')) AS BIGINT)").alias(f"n_{kind}")
        for kind in (*base, learned)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(shapes).cast("binary"), 256).alias("base_sha256"),
        F.expr(f"concat_ws(',', transform(found, s -> {line}))").alias("spans"),
    )


@query("op9_secret_scans")
def secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return span_digests(secrets.scan(docs, secrets.train(docs)), secrets.KINDS[:3], secrets.KINDS[3])


@query("op10_contextual_pii")
def contextual_pii(spark: SparkSession, folder: str) -> DataFrame:
    return span_digests(pii.scan(table(spark, folder, "documents")), pii.KINDS, "context")


@query("op11_embedding_whitening")
def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.whole_numbers(table(spark, folder, "embeddings"))
    model = whitening.fit(rows)
    if model is None:
        return spark.createDataFrame(
            [], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        )
    deviation = F.col("deviation").try_cast("bigint").alias("deviation")
    return whitening.apply(rows, model).select(
        F.col("id").alias("vec_id"), "component", "n", deviation, "whitened", "explained", "identity_error"
    )


TOKEN_LIMIT = 2048


@query("op12_token_counts")
def token_count_query(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents"), tokenizer())
    return counted.select("*", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


# the orders of five letters, and the bits of the filters before each step
AUDIT_SQL = r"""
    WITH whole AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
    ), split AS (
        SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
            coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE) AS is_copy
        FROM whole
    ), marks AS (
        SELECT doc_id, bool_or(coalesce(quality = 1, FALSE)) AS good, bool_or(coalesce(toxic = 1, FALSE)) AS toxic
        FROM labels GROUP BY doc_id
    ), masked AS (
        SELECT s.part, coalesce(m.good, FALSE) AS good, coalesce(m.toxic, FALSE) AS toxic,
            (len(words) < 200)::INT
            + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
            + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
            + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * is_copy::INT AS mask
        FROM split s LEFT JOIN marks m ON s.doc_id = m.doc_id
    ), counts AS (
        SELECT part, mask, good, toxic, count(*) AS n FROM masked GROUP BY ALL
    ), letters AS (
        SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
    ), orders AS (
        SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
            [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
    ), steps AS (
        SELECT filter_order, step::INT AS step, bits[step] AS own,
            coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
        FROM orders, range(1, 6) r(step)
    )
    SELECT part, filter_order, step,
        sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN mask & own > 0 AND mask & before > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN good AND mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN toxic AND mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS toxic_lost,
        sum(CASE WHEN mask & own > 0 THEN n * 120 // bit_count(mask) ELSE 0 END)::BIGINT AS shapley
    FROM counts, steps GROUP BY part, filter_order, step
"""


@query("op13_filter_interaction_audit", AUDIT_SQL)
def filter_interaction_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))
