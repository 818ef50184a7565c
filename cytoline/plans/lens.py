"""Stand-in cohort tables over the generic tables that tests and benchmarks come with. Whole tables, renamed columns.

measure: line items as pileup rows of eight samples; sites: parts; tracks: parts as intervals on the same coordinates;
values: embeddings as a matrix with a sample for each dimension and a site for each vector; reads: line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLES = [f"s{i}" for i in range(8)]
DIMENSIONS = [f"d{i:02d}" for i in range(64)]
MIN_COV = 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('s', l_suppkey % 8) AS sample", "cast(l_partkey % 22 + 1 AS string) AS chrom",
        "2 * l_partkey + if(l_linestatus = 'F', 0, 1) AS start", "2 * l_partkey + if(l_linestatus = 'F', 1, 2) AS end",
        "if(l_returnflag = 'R', 'h', 'm') AS mod_code", "if(l_linestatus = 'F', '+', '-') AS strand",
        "cast(l_quantity AS bigint) AS n_valid", "l_discount * 1000 AS fraction",
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('chr', p_partkey % 22 + 1, ':', 2 * p_partkey) AS site_id", "concat('chr', p_partkey % 22 + 1) AS chrom", "2 * p_partkey AS start", "2 * p_partkey + 2 AS end"
    )


def track(spark: SparkSession, sf_dir: str, stride: int, shift: int = 0, length: str = "22 * p_size") -> DataFrame:
    """An interval for each part, ``stride`` sites apart, with a name, another text and an origin."""
    at = f"({stride} * p_partkey + {shift})"
    return table(spark, sf_dir, "part").selectExpr(
        f"concat('chr', {at} % 22 + 1) AS chrom", f"2 * {at} AS start", f"2 * {at} + {length} AS end", "p_brand AS name", "p_type AS extra",
        "CASE p_size % 5 WHEN 0 THEN 'cpgIsland' WHEN 1 THEN '450k' WHEN 2 THEN '850k;v2' WHEN 3 THEN '450k; v2' END AS origin",
    )


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """site_id, sample, beta; what is nearly 0 counts as not observed."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    return rows.selectExpr("vec_id AS site_id", "concat('d', lpad(cast(i AS string), 2, '0')) AS sample", "if(abs(v) < 0.01, null, cast(v AS double)) AS beta")


def complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    return rows.selectExpr("vec_id AS site_id", "concat('d', lpad(cast(i AS string), 2, '0')) AS sample", "cast(v AS double) AS beta")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('r', l_orderkey) AS qname", "if(l_returnflag = 'R', 256, 0) AS flag", "concat('chr', l_partkey % 22 + 1) AS chrom",
        "2 * l_partkey AS pos", "2 * l_partkey + 3 * cast(l_quantity AS bigint) AS end_pos", "l_linenumber - 1 AS mapq",
    )


#: The same tables for DuckDB, as the beginning of a query.
SQL = """
WITH measure AS (
  SELECT 's' || (l_suppkey % 8) AS sample, 'chr' || (l_partkey % 22 + 1) AS chrom, 2 * l_partkey AS start,
         CASE WHEN l_returnflag = 'R' THEN 'h' ELSE 'm' END AS mod_code, l_quantity::BIGINT AS n_valid, l_discount * 1000 AS fraction
  FROM lineitem),
parsed AS (
  SELECT sample, chrom || ':' || start AS site_id, chrom, start, start + 2 AS "end", 'm' AS mod_code, sum(n_valid)::BIGINT AS n_valid,
         sum(fraction / 100 * n_valid) / nullif(sum(n_valid), 0) AS fraction
  FROM measure WHERE mod_code = 'm' GROUP BY sample, chrom, start),
sites AS (
  SELECT 'chr' || (p_partkey % 22 + 1) || ':' || (2 * p_partkey) AS site_id, 'chr' || (p_partkey % 22 + 1) AS chrom, 2 * p_partkey AS start, 2 * p_partkey + 2 AS "end"
  FROM part),
cells AS (
  SELECT g.site_id, g.chrom, g.start, g."end", g.sample,
         CASE WHEN n_valid >= 30 THEN round_even(fraction * 100 * 100, 0) / 100 END AS beta, CASE WHEN n_valid >= 30 THEN n_valid END AS cov
  FROM (SELECT * FROM sites, (SELECT 's' || i AS sample FROM range(8) t(i))) g LEFT JOIN parsed p ON p.site_id = g.site_id AND p.sample = g.sample),
shapes AS (
  SELECT p_partkey AS k, p_size, p_brand AS name, p_type AS extra,
         CASE p_size % 5 WHEN 0 THEN 'cpgIsland' WHEN 1 THEN '450k' WHEN 2 THEN '850k;v2' WHEN 3 THEN '450k; v2' END AS origin FROM part),
track3 AS (SELECT 'chr' || (3 * k % 22 + 1) AS chrom, 6 * k AS start, 6 * k + 22 * p_size AS "end", name, extra, origin FROM shapes),
tss AS (SELECT 'chr' || (5 * k % 22 + 1) AS chrom, 10 * k AS start, 10 * k + 1 AS "end", name, extra FROM shapes),
introns AS (SELECT 'chr' || (7 * k % 22 + 1) AS chrom, 14 * k AS start, 14 * k + 60 * p_size AS "end", name, extra FROM shapes),
ccre AS (SELECT 'chr' || ((4 * k + 1) % 22 + 1) AS chrom, 8 * k + 2 AS start, 8 * k + 2 + 90 * p_size AS "end", name, extra FROM shapes),
origins AS (
  SELECT s.site_id, s.chrom, s.start, s."end", coalesce(o.origin, 'unknown') AS origin
  FROM sites s LEFT JOIN (
    SELECT site_id, string_agg(tag, ';' ORDER BY tag) AS origin
    FROM (SELECT DISTINCT s.site_id, trim(u.tag) AS tag FROM sites s JOIN track3 t ON t.chrom = s.chrom AND t.start < s."end" AND t."end" > s.start,
          unnest(string_split(t.origin, ';')) u(tag) WHERE t.origin IS NOT NULL)
    GROUP BY site_id) o USING (site_id)),
covered AS (SELECT site_id, chrom, start, count(beta) AS n_covered FROM cells GROUP BY ALL),
complete AS (
  SELECT vec_id AS site_id, 'd' || lpad((i - 1)::VARCHAR, 2, '0') AS sample, embedding[i]::DOUBLE AS beta
  FROM embeddings, range(1, 65) t(i)),
observed AS (SELECT site_id, sample, CASE WHEN abs(beta::FLOAT) < 0.01 THEN NULL ELSE beta END AS beta FROM complete),
reads AS (
  SELECT 'r' || l_orderkey AS qname, CASE WHEN l_returnflag = 'R' THEN 256 ELSE 0 END AS flag, 'chr' || (l_partkey % 22 + 1) AS chrom,
         2 * l_partkey AS pos, 2 * l_partkey + 3 * l_quantity::BIGINT AS end_pos, l_linenumber - 1 AS mapq FROM lineitem)
"""
