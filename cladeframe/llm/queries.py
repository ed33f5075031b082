"""The registered queries of this subpackage, each over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.llm import decontamination, hard_negatives, mixing, neighbours, pieces, pseudo_likelihood, quality, simhash, suffix_dedup, token_counts, token_files, toxicity, turn_repair

END_ID = 2


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def rate_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severities(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def write_and_read_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_tokens(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"), END_ID)
    return token_files.read_tokens(files)


def group_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def score_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.trained_and_scored(table(spark, sf_dir, "documents"))


def dedup_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def find_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_file("piece_bpe_32k.model"))


def encode_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary_file("piece_bpe_32k.model")
    made = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), model), model)
    hashed = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return made.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), hashed("ids").alias("ids_sha256"), hashed("decoded").alias("decoded_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults, by the crc32 of conv_id:turn modulo 20: 0 goes, 1 loses its text, 2 its marks, 3 is there twice, 4 is
    the user's. Nulls are one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("kind")).where("kind <> 0")
    rows = rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"))


def repair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    report, repaired = turn_repair.repair(damaged(conversations))
    return turn_repair.with_empty(conversations, report, turn_repair.digests(repaired))


def mine_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": decontaminate,
        "op2_toxicity": rate_toxicity,
        "op3_quality": classify_quality,
        "op4_token_files": write_and_read_tokens,
        "op5_simhash": group_near_duplicates,
        "op6_mixing": mix_sources,
        "op7_pseudo_likelihood": score_language,
        "op8_suffix_dedup": dedup_suffixes,
        "op9_neighbours": find_neighbours,
        "op10_token_counts": count_tokens,
        "op11_pieces": encode_pieces,
        "op12_turn_repair": repair_turns,
        "op13_hard_negatives": mine_negatives,
    }


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS ord
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM sized GROUP BY source),
capped AS (SELECT *, 2.0::DOUBLE * source_size / weight AS cap_rate FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY cap_rate, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / CAST(sum(weight) OVER (ORDER BY cap_rate, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS lvl
  FROM capped),
settled AS (SELECT *, (SELECT min_by(lvl, cap_rate) FROM levels WHERE lvl <= cap_rate) AS final FROM levels),
targets AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, final * weight) AS target FROM settled),
queued AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, row_number() OVER () AS place,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (SELECT *, start + size + turn * source_size AS ended, CAST(start + size + turn * source_size AS DOUBLE) / target AS finish FROM (SELECT *, unnest([0, 1]) AS turn FROM queued WHERE target > 0)),
ranged AS (SELECT place, size, CAST(sum(size) OVER (ORDER BY finish, source NULLS LAST, ended ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS words_before FROM copies),
budget AS (SELECT CAST(floor(1.5::DOUBLE * sum(size)) AS BIGINT) AS total FROM sized),
takes AS (SELECT place, CAST(sum(greatest(0, least(size, total - words_before))) AS BIGINT) AS taken FROM ranged, budget GROUP BY place)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, source, CASE WHEN target > 0 THEN CAST(start + size AS DOUBLE) / target END AS virtual_finish
FROM queued LEFT JOIN takes USING (place)
"""

NEIGHBOURS_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs) WHERE rank <= 10
"""

DECONTAMINATION_SQL = r"""
WITH item_words AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+') AS w FROM benchmark),
doc_words AS (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}_]+') AS w FROM documents),
items AS (SELECT *, least(5, len(w)) AS n FROM item_words WHERE len(w) > 0),
item_shingles AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s FROM (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT n FROM items),
doc_shingles AS (SELECT DISTINCT doc, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words JOIN sizes ON len(w) >= n)),
totals AS (SELECT item, count(*) AS n_shingles FROM item_shingles GROUP BY item),
shared AS (SELECT d.doc, i.item, count(*) AS n_shared FROM item_shingles i JOIN doc_shingles d ON i.n = d.n AND i.s = d.s GROUP BY d.doc, i.item)
SELECT doc_id, item_id, CAST(n_shingles AS BIGINT) AS n_shingles, CAST(n_shared AS BIGINT) AS n_shared, n_shared / n_shingles AS containment
FROM shared JOIN totals USING (item) JOIN items USING (item) JOIN doc_words USING (doc) WHERE n_shared >= 0.8 * n_shingles - 1e-9
"""

NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_reduce(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2]), lambda x, y: x + y) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM pairs WHERE alike) WHERE place <= 5),
ranked AS (
  SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN pairs USING (anchor_id) WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": DECONTAMINATION_SQL, "op6_mixing": MIXING_SQL, "op9_neighbours": NEIGHBOURS_SQL, "op13_hard_negatives": NEGATIVES_SQL}
