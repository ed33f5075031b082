"""The driver's tables as genome data, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.scratch import stash

RANKS = ["domain", "phylum", "class", "species"]
HIT_ORDER = ["evalue", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]

SQL = {
    "hits": "hits AS (SELECT l_orderkey AS genome_id, p_brand AS marker, -l_extendedprice AS evalue, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey)",
    "split_hits": """base AS (SELECT l_orderkey AS genome_id, p_brand AS marker, -l_extendedprice AS evalue, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey),
      hits AS (SELECT * FROM base UNION ALL SELECT * REPLACE ('Split' AS marker) FROM (SELECT * FROM base ORDER BY l_partkey % 1000, genome_id, l_linenumber, l_partkey, evalue LIMIT 1)
      UNION ALL SELECT * REPLACE ('Split' AS marker) FROM (SELECT * FROM base ORDER BY -(l_partkey % 1000), genome_id, l_linenumber, l_partkey, evalue LIMIT 1))""",
    "split_markers": "markers AS (SELECT DISTINCT p_brand AS marker FROM part UNION ALL SELECT 'Split')",
    "markers": "markers AS (SELECT DISTINCT p_brand AS marker FROM part)",
    "genomes": "genomes AS (SELECT o_orderkey AS genome_id FROM orders)",
    "found": "found AS (SELECT genome_id, marker, count(*) AS n FROM hits GROUP BY ALL)",
    "counts": "counts AS (SELECT g.genome_id, m.marker, coalesce(f.n, 0) AS n FROM genomes g CROSS JOIN markers m LEFT JOIN found f ON f.genome_id = g.genome_id AND f.marker = m.marker)",
    "quality": "quality AS (SELECT *, round_even(num_hits / (SELECT count(*) FROM markers) * 100, 2) AS perc_comp, round_even(redund / (SELECT count(*) FROM markers) * 100, 2) AS perc_redund FROM (SELECT genome_id, count(*) FILTER (n > 0) AS num_hits, count(*) FILTER (n = 1) AS uniq_hits, CAST(sum(greatest(n - 1, 0)) AS BIGINT) AS redund FROM counts GROUP BY genome_id))",
    "gtdb": """gtdb AS (SELECT 'RS_GCF_' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '.' || CAST(1 + c_custkey % 3 AS VARCHAR) AS accession, c_custkey, r_name AS "domain", n_name AS phylum, c_mktsegment AS "class", c_name AS species,
      CASE WHEN c_custkey % 10 = 0 THEN 't' ELSE 'f' END AS gtdb_representative, CASE WHEN c_custkey % 7 = 0 THEN 'representative genome' ELSE 'na' END AS ncbi_refseq_category
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "wanted": """wanted AS (SELECT 'GCA_' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '.9' AS id FROM customer WHERE c_custkey % 3 = 0
      UNION ALL SELECT 'GCF_' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '.9' FROM customer WHERE c_custkey % 6 = 0
      UNION ALL SELECT 'GCA_' || lpad(CAST(900000000 + n_nationkey AS VARCHAR), 9, '0') || '.1' FROM nation)""",
    "catalog": """catalog AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'GCF_' ELSE 'GCA_' END || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '.' || CAST(1 + c_custkey % 3 AS VARCHAR) AS assembly_accession, CAST(c_custkey AS VARCHAR) AS taxid, c_name AS organism_name,
      CASE WHEN c_custkey % 4 = 0 THEN 'strain=' || n_name ELSE '' END AS infraspecific_name, 'latest' AS version_status, c_mktsegment AS assembly_level, n_name || ' (v' || CAST(c_custkey % 5 AS VARCHAR) || ')' AS asm_name,
      CASE WHEN c_custkey % 5 = 0 THEN 'ftp://host/' || c_name || '/' ELSE 'na' END AS ftp_path FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "seqs": "seqs AS (SELECT source AS marker, doc_id AS genome_id, CAST(doc_id AS VARCHAR) AS gene_id, text AS seq, CAST(length(text) AS BIGINT) AS len FROM documents)",
    "aln": """aln AS (SELECT 'm' || CAST(m AS VARCHAR) AS marker, vec_id AS genome_id, array_to_string(list_transform(list_slice(embedding, m * 16 + 1, m * 16 + 16), lambda x: CASE WHEN x > 0.05 THEN 'A' WHEN x < -0.05 THEN 'C' ELSE '-' END), '') AS seq
      FROM (SELECT vec_id, unnest([0, 1, 2, 3]) AS m, embedding FROM embeddings) WHERE m <> vec_id % 5)""",
    "complete": "complete AS (SELECT m.marker, g.genome_id, coalesce(a.seq, repeat('-', 16)) AS seq FROM (SELECT DISTINCT marker FROM aln) m CROSS JOIN (SELECT DISTINCT vec_id AS genome_id FROM embeddings) g LEFT JOIN aln a ON a.marker = m.marker AND a.genome_id = g.genome_id)",
    "nodes": """nodes AS (SELECT 1 AS taxid, 1 AS parent, 'no rank' AS "rank", 'root' AS name UNION ALL SELECT 10 + r_regionkey, 1, 'domain', r_name FROM region
      UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, 'phylum', n_name FROM nation UNION ALL SELECT 1000 + c_custkey, 100 + c_nationkey, 'species', c_name FROM customer)""",
    "user_map": "user_map AS (SELECT c_custkey AS genome_id, CASE WHEN c_custkey % 4 = 0 THEN 'my ' || c_name END AS label, CASE WHEN c_custkey % 6 = 0 THEN 'sfx ' || n_name END AS suffix FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 4 = 0 OR c_custkey % 6 = 0)",
}
for _name, _custkey in (("all_lineage", "true"), ("gtdb_lineage", "c_custkey % 2 = 0"), ("ncbi_lineage", "c_custkey % 3 = 0")):
    SQL[_name] = f'{_name} AS (SELECT c_custkey AS genome_id, "domain", phylum, "class", species FROM gtdb WHERE {_custkey})'


def with_sql(*names: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n"


class Tables:
    """Bindings over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def hits(self, line: DataFrame | None = None, *more: str) -> DataFrame:
        """Lines with the brand of their part: all lines, or those given, with more of their columns."""
        line = (self.table("lineitem") if line is None else line).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", *more)
        joined = line.join(self.table("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        return joined.select(F.col("l_orderkey").alias("genome_id"), F.col("p_brand").alias("marker"), (-F.col("l_extendedprice")).alias("evalue"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", *more)

    def split_hits(self, hits: DataFrame | None = None) -> DataFrame:
        """The hits, and two of a marker more: on the shortest and on the longest gene, so that its lengths have nothing in common."""
        hits, letters = self.hits() if hits is None else hits, F.col("l_partkey") % 1000
        ends = [hits.orderBy(by, "genome_id", "l_linenumber", "l_partkey", "evalue").limit(1).withColumn("marker", F.lit("Split")) for by in (letters, -letters)]
        return hits.unionByName(stash(ends[0].unionByName(ends[1]), "ends"))

    def markers(self) -> DataFrame:
        return self.table("part").select(F.col("p_brand").alias("marker")).distinct()

    def genomes(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("genome_id"))

    def places(self) -> DataFrame:
        """Customers with their nation and region."""
        n, r = self.table("nation"), self.table("region")
        return self.table("customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))

    def digits(self, column: Column) -> Column:
        return F.lpad(column.cast("string"), 9, "0")

    def gtdb(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.places().select(
            F.concat(F.lit("RS_GCF_"), self.digits(k), F.lit("."), (1 + k % 3).cast("string")).alias("accession"), "c_custkey", F.col("r_name").alias("domain"), F.col("n_name").alias("phylum"),
            F.col("c_mktsegment").alias("class"), F.col("c_name").alias("species"), F.when(k % 10 == 0, "t").otherwise("f").alias("gtdb_representative"),
            F.when(k % 7 == 0, "representative genome").otherwise("na").alias("ncbi_refseq_category"),
        )

    def wanted(self) -> DataFrame:
        k, customers = F.col("c_custkey"), self.table("customer")
        name = lambda kind, c, v: F.concat(F.lit(kind), self.digits(c), F.lit(v)).alias("id")
        known = customers.where(k % 3 == 0).select(name("GCA_", k, ".9")).unionAll(customers.where(k % 6 == 0).select(name("GCF_", k, ".9")))
        return known.unionAll(self.table("nation").select(name("GCA_", 900_000_000 + F.col("n_nationkey"), ".1")))

    def catalog(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.places().select(
            F.concat(F.when(k % 2 == 0, "GCF_").otherwise("GCA_"), self.digits(k), F.lit("."), (1 + k % 3).cast("string")).alias("assembly_accession"), k.cast("string").alias("taxid"), F.col("c_name").alias("organism_name"),
            F.when(k % 4 == 0, F.concat(F.lit("strain="), "n_name")).otherwise("").alias("infraspecific_name"), F.lit("latest").alias("version_status"), F.col("c_mktsegment").alias("assembly_level"),
            F.concat("n_name", F.lit(" (v"), (k % 5).cast("string"), F.lit(")")).alias("asm_name"), F.when(k % 5 == 0, F.concat(F.lit("ftp://host/"), "c_name", F.lit("/"))).otherwise("na").alias("ftp_path"),
        )

    def seqs(self) -> DataFrame:
        return self.table("documents").select(F.col("source").alias("marker"), F.col("doc_id").alias("genome_id"), F.col("doc_id").cast("string").alias("gene_id"), F.col("text").alias("seq"), F.length("text").cast("long").alias("len"))

    def aln(self) -> DataFrame:
        vectors = self.table("embeddings").select("vec_id", "embedding", F.explode(F.array(*map(F.lit, range(4)))).alias("m")).where(F.col("m") != F.col("vec_id") % 5)
        letter = lambda x: F.when(x > 0.05, "A").when(x < -0.05, "C").otherwise("-")
        return vectors.select(F.concat(F.lit("m"), F.col("m").cast("string")).alias("marker"), F.col("vec_id").alias("genome_id"), F.array_join(F.transform(F.slice("embedding", F.col("m") * 16 + 1, F.lit(16)), letter), "").alias("seq"))

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(F.col("vec_id").alias("genome_id"))

    def taxonomy(self) -> tuple[DataFrame, DataFrame]:
        rows = [
            self.spark.sql("SELECT 1L AS taxid, 1L AS parent, 'no rank' AS rank, 'root' AS name"),
            self.table("region").selectExpr("CAST(10 + r_regionkey AS long) AS taxid", "1L AS parent", "'domain' AS rank", "r_name AS name"),
            self.table("nation").selectExpr("CAST(100 + n_nationkey AS long) AS taxid", "CAST(10 + n_regionkey AS long) AS parent", "'phylum' AS rank", "n_name AS name"),
            self.table("customer").selectExpr("CAST(1000 + c_custkey AS long) AS taxid", "CAST(100 + c_nationkey AS long) AS parent", "'species' AS rank", "c_name AS name"),
        ]
        every = rows[0].unionAll(rows[1]).unionAll(rows[2]).unionAll(rows[3])
        return every.select("taxid", "parent", "rank"), every.select("taxid", "name")

    def lineage(self, every: int) -> DataFrame:
        return self.gtdb().where(F.col("c_custkey") % every == 0).select(F.col("c_custkey").alias("genome_id"), "domain", "phylum", "class", "species")

    def user_map(self) -> DataFrame:
        k = F.col("c_custkey")
        label, suffix = F.when(k % 4 == 0, F.concat(F.lit("my "), "c_name")), F.when(k % 6 == 0, F.concat(F.lit("sfx "), "n_name"))
        return self.places().where((k % 4 == 0) | (k % 6 == 0)).select(k.alias("genome_id"), label.alias("label"), suffix.alias("suffix"))

    def customers(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("genome_id"))
