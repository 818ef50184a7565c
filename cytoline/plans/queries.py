"""The registered queries of the cohort operators, each with its SQL where SQL can express it.

Every query runs an operator over whole stand-in tables. Doubles are rounded the same way on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoline.functions import expr
from cytoline.operators import annotation, cluster, cohort, coverage, distance, distrib, intervals, linalg, matrix, reads, stats
from cytoline.session import settle, shared_folder
from cytoline.sources import cohort_store, pileup_source, read_store, writers

from . import lens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
SAMPLES, DIMENSIONS = lens.SAMPLES, lens.DIMENSIONS


def query(sql: str | None = None, prefix: bool = True):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLE[run.__name__] = (lens.SQL if prefix else "") + sql
        return run

    return add


def r6(name: str):
    """Rounded to six decimals; -0.0 is 0.0."""
    return (F.round(F.col(name), 6) + 0.0).alias(name)


def variance(rows: DataFrame) -> DataFrame:
    """Variances with their ties between two roundings broken upwards: sums in another order differ in the last bits."""
    return rows.withColumn("variance", F.round(F.col("variance") + 1e-9, 6))


def parsed(spark, sf):
    return cohort.parse_sample(lens.measure(spark, sf))


def cells(spark, sf):
    return cohort.align(lens.sites(spark, sf), parsed(spark, sf), SAMPLES, lens.MIN_COV)


def site_origins(spark, sf):
    return cohort.with_origins(lens.sites(spark, sf), lens.track(spark, sf, 3))


# -- cohort ------------------------------------------------------------------------------------------------------------


@query('SELECT sample, site_id, chrom, start, "end", mod_code, n_valid, round(fraction, 6) AS fraction FROM parsed')
def parse_sample(spark, sf):
    return parsed(spark, sf).select("sample", "site_id", "chrom", "start", "end", "mod_code", "n_valid", r6("fraction"))


@query("SELECT name, CASE WHEN name LIKE 'chr%' THEN name WHEN name IN ('MT', 'M') THEN 'chrM' ELSE 'chr' || name END AS chrom, n FROM ("
       "SELECT CASE WHEN p_size = 1 THEN 'MT' WHEN p_size = 2 THEN 'M' WHEN p_size < 20 THEN 'chr' || p_size ELSE p_size::VARCHAR END AS name, count(*) AS n FROM part GROUP BY 1)", prefix=False)  # fmt: skip
def chromosome_names(spark, sf):
    name = F.expr("CASE WHEN p_size = 1 THEN 'MT' WHEN p_size = 2 THEN 'M' WHEN p_size < 20 THEN concat('chr', p_size) ELSE cast(p_size AS string) END")
    return lens.table(spark, sf, "part").groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n")).select("name", expr.chromosome(F.col("name")).alias("chrom"), "n")


@query("SELECT strand, count(*) AS n, sum(place)::BIGINT AS sum_start FROM (SELECT CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, 2 * l_partkey AS place FROM lineitem) GROUP BY strand", prefix=False)
def plus_strand_starts(spark, sf):
    at = expr.plus_start(F.col("start"), expr.checked_strand(F.col("strand")))
    return lens.measure(spark, sf).select("strand", at.alias("at")).groupBy("strand").agg(F.count(F.lit(1)).alias("n"), F.sum("at").alias("sum_start"))


@query("SELECT sample, site_id, count(*) AS n FROM (SELECT * FROM parsed UNION ALL SELECT * FROM parsed WHERE n_valid >= 60) GROUP BY ALL HAVING count(*) > 1")
def repeated_sites(spark, sf):
    rows = parsed(spark, sf)
    return cohort.repeated_sites(rows.unionByName(rows.filter("n_valid >= 60")))


@query("SELECT sample, count(*) AS n_plain FROM (SELECT 's' || (l_suppkey % 8) AS sample, (l_partkey % 22 + 1)::VARCHAR AS chrom FROM lineitem) WHERE chrom NOT LIKE 'chr%' GROUP BY sample", prefix=False)
def mixed_names(spark, sf):
    return cohort.mixed_names(lens.measure(spark, sf))


def stored(spark) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def dropped(spark, folder: str, rows):
    """The rows, worked out; then the folder that they were read from goes."""
    rows = settle(rows)
    writers.remove(spark, folder)
    return rows


@query("SELECT sample, 'chr5' || ':' || start AS site_id, 'chr5' AS chrom, start, start + 2 AS \"end\", 'm' AS mod_code, n_valid, round(fraction, 6) AS fraction FROM parsed WHERE chrom = 'chr5'")
def pileup_files(spark, sf):
    """All measurements written as pileup files of samples, noted by range, and one chromosome of them read back."""
    folder = stored(spark)
    writers.pileup(lens.measure(spark, sf), folder)
    pileup_source.write_zones(spark, folder, range_bytes=1 << 20)
    rows = pileup_source.scan(spark, folder, chroms=["5"], mod_codes=["m"], range_bytes=1 << 20)
    return dropped(spark, folder, cohort.parse_sample(rows).select("sample", "site_id", "chrom", "start", "end", "mod_code", "n_valid", r6("fraction")))


@query('SELECT site_id, chrom, start, "end", sample, beta, cov FROM cells')
def matrix_long(spark, sf):
    return cells(spark, sf)


@query("SELECT site_id, chrom, start, " + ", ".join(f"max(beta) FILTER (sample = '{s}') AS beta_{s}, max(cov) FILTER (sample = '{s}') AS cov_{s}" for s in SAMPLES) + " FROM cells GROUP BY site_id, chrom, start HAVING count(cov) > 0")
def matrix_wide(spark, sf):
    return writers.wide(cohort.split_covered(cells(spark, sf))[0], SAMPLES, ["site_id", "chrom", "start"])


@query("SELECT site_id, chrom, start, \"end\" FROM cells WHERE sample IN ('s0', 's1') GROUP BY ALL HAVING count(cov) = 0")
def excluded_sites(spark, sf):
    """Sites that neither of two samples covers."""
    return cohort.split_covered(cells(spark, sf).filter("sample IN ('s0', 's1')"))[1]


@query("SELECT sample, count(*) - count(beta) AS n_missing, count(*) AS n_sites FROM cells GROUP BY sample")
def missing_by_sample(spark, sf):
    return cohort.missing_by_sample(cells(spark, sf))


@query("SELECT sample, median(n_valid)::DOUBLE AS median_depth, round(median(fraction), 6) AS median_fraction FROM parsed GROUP BY sample")
def depth_medians(spark, sf):
    return cohort.depth_medians(parsed(spark, sf)).select("sample", F.col("median_depth").cast("double").alias("median_depth"), r6("median_fraction"))


@query("SELECT site_id, sample, CASE WHEN NOT coalesce(cov < 60, false) THEN beta END AS beta FROM cells")
def plot_mask(spark, sf):
    return cells(spark, sf).select("site_id", "sample", expr.covered_or_unknown(F.col("beta"), F.col("cov"), 60).alias("beta"))


@query('SELECT site_id, chrom, start, "end", sample, beta, cov FROM cells')
def matrix_in_steps(spark, sf):
    """The cohort of five samples stored by site, and three more aligned to it and added."""
    folder, name = stored(spark), f"cohort_{uuid.uuid4().hex}"
    cohort_store.store_sites(lens.sites(spark, sf), f"{name}_sites", f"{folder}/sites", 16)
    for names in (SAMPLES[:5], SAMPLES[5:]):
        cohort_store.add(cohort_store.align(spark, f"{name}_sites", parsed(spark, sf), names, lens.MIN_COV), name, f"{folder}/cells", 16)
    rows = dropped(spark, folder, spark.table(name).select("site_id", "chrom", "start", "end", "sample", "beta", "cov"))
    for table in (name, f"{name}_sites"):
        spark.sql(f"DROP TABLE {table}")
    return rows


# -- intervals and annotation ------------------------------------------------------------------------------------------


@query('SELECT site_id, chrom, start, "end", origin FROM origins')
def overlap_all_origins(spark, sf):
    return site_origins(spark, sf).select("site_id", "chrom", "start", "end", "origin")


@query('SELECT s.site_id, CASE WHEN t."end" > s.start THEN t.name END AS name FROM sites s ASOF LEFT JOIN track3 t ON s.chrom = t.chrom AND s.start >= t.start')
def asof_first_overlap(spark, sf):
    return intervals.asof_overlap(lens.sites(spark, sf), lens.track(spark, sf, 3), ["name"]).select("site_id", F.col("hit.name").alias("name"))


@query('SELECT s.site_id, max(struct_pack(a := t.start, b := t."end", c := t.name)).c AS name FROM sites s LEFT JOIN track3 t ON s.chrom = t.chrom AND t.start <= s.start AND t."end" > s.start GROUP BY s.site_id')
def true_first_overlap(spark, sf):
    return intervals.first_overlap(lens.sites(spark, sf), lens.track(spark, sf, 3), ["name"]).select("site_id", F.col("hit.name").alias("name"))


_LONG = """, long AS (SELECT 'chr' || (3 * k % 22 + 1) AS chrom, 6 * k AS start, 6 * k + CASE WHEN p_size % 25 = 0 THEN 250000000 ELSE 22 * p_size END AS "end" FROM shapes)
"""


@query(_LONG + 'SELECT s.site_id, count(*) AS n, sum(t."end" - t.start)::BIGINT AS bases FROM sites s JOIN long t ON t.chrom = s.chrom AND t.start < s."end" AND t."end" > s.start GROUP BY s.site_id')
def overlap_long_intervals(spark, sf):
    """Sites in a track of which some intervals are as long as a chromosome."""
    track = lens.track(spark, sf, 3, 0, "if(p_size % 25 = 0, 250000000, 22 * p_size)")
    return intervals.overlap_totals(lens.sites(spark, sf), track, "end - start").withColumnRenamed("total", "bases")


@query(_LONG + 'SELECT chrom, count(*) AS n, sum(pos)::BIGINT AS sum_pos FROM reads r WHERE NOT EXISTS (SELECT 1 FROM long t WHERE t.chrom = r.chrom AND t.start < r.end_pos AND t."end" > r.pos) GROUP BY chrom')
def reads_off_long_intervals(spark, sf):
    track = lens.track(spark, sf, 3, 0, "if(p_size % 25 = 0, 250000000, 22 * p_size)")
    return reads.on_regions(lens.reads(spark, sf), track, inside=False).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("sum_pos"))


_FIRST = """, hits AS (
  SELECT s.site_id, s.start, CASE WHEN t."end" > s.start THEN t END AS t, CASE WHEN e."end" > s.start THEN e END AS e,
         CASE WHEN i."end" > s.start THEN i END AS i, CASE WHEN c."end" > s.start THEN c END AS c
  FROM sites s ASOF LEFT JOIN tss t ON s.chrom = t.chrom AND s.start >= t.start ASOF LEFT JOIN track3 e ON s.chrom = e.chrom AND s.start >= e.start
  ASOF LEFT JOIN introns i ON s.chrom = i.chrom AND s.start >= i.start ASOF LEFT JOIN ccre c ON s.chrom = c.chrom AND s.start >= c.start),
annotated AS (
  SELECT site_id, CASE WHEN t IS NOT NULL THEN 'Promoter/TSS' WHEN e IS NOT NULL THEN 'Exon' WHEN i IS NOT NULL THEN 'Intron' WHEN c IS NOT NULL THEN 'cCRE' ELSE 'Intergenic' END AS feature_label,
         CASE WHEN t IS NOT NULL THEN t.name WHEN e IS NOT NULL THEN e.name WHEN i IS NOT NULL THEN i.name ELSE '' END AS gene_name,
         CASE WHEN t IS NOT NULL THEN t.extra ELSE '' END AS "distance_TSS",
         CASE WHEN t IS NULL AND e IS NULL AND i IS NULL AND c IS NOT NULL THEN c.name ELSE '' END AS ccre_accession,
         CASE WHEN t IS NULL AND e IS NULL AND i IS NULL AND c IS NOT NULL THEN c.extra ELSE '' END AS ccre_type FROM hits)
"""


def annotated(spark, sf):
    track = lambda *a: lens.track(spark, sf, *a)
    return annotation.annotate(lens.sites(spark, sf), track(5, 0, "1"), track(3), track(7, 0, "60 * p_size"), track(4, 1, "90 * p_size"))


@query(_FIRST + "SELECT * FROM annotated")
def annotate_priority(spark, sf):
    return annotated(spark, sf).select("site_id", "feature_label", "gene_name", "distance_TSS", "ccre_accession", "ccre_type")


@query(_FIRST + "SELECT feature_label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM annotated GROUP BY feature_label")
def feature_counts(spark, sf):
    return cohort.counts_with_percent(annotated(spark, sf), "feature_label")


@query("SELECT s.site_id, min(abs(s.start - t.start)) AS distance FROM sites s LEFT JOIN tss t ON s.chrom = t.chrom GROUP BY s.site_id")
def distance_to_start(spark, sf):
    return annotation.distance_to_start(lens.sites(spark, sf), lens.track(spark, sf, 5, 0, "1")).select("site_id", "distance")


_MERGED = """, ordered AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM track3),
islands AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM ordered),
merged AS (SELECT chrom, min(start) AS start, max("end") AS "end", string_agg(DISTINCT name, ',' ORDER BY name) AS name FROM islands GROUP BY chrom, island)
"""


@query(_MERGED + 'SELECT chrom, start, "end" FROM merged')
def interval_merge(spark, sf):
    return intervals.merge(lens.track(spark, sf, 3))


@query(_MERGED + 'SELECT chrom, start, "end", name FROM merged')
def interval_merge_names(spark, sf):
    return intervals.merge(lens.track(spark, sf, 3), "name")


@query(_MERGED + """, cut AS (SELECT i.chrom, i.start AS a, i."end" AS b, i.name, greatest(m.start, i.start) AS s, least(m."end", i."end") AS e
  FROM introns i JOIN merged m ON m.chrom = i.chrom AND m.start < i."end" AND m."end" > i.start),
points AS (SELECT i.chrom, i.start AS a, i."end" AS b, i.name, i.start AS f, coalesce(min(c.s), i."end") AS t FROM introns i LEFT JOIN cut c ON c.chrom = i.chrom AND c.a = i.start GROUP BY i.chrom, i.start, i."end", i.name
  UNION ALL SELECT chrom, a, b, name, e, coalesce(lead(s) OVER (PARTITION BY chrom, a ORDER BY s), b) FROM cut)
SELECT chrom, f AS start, t AS "end", name FROM points WHERE t > f""")
def interval_subtract(spark, sf):
    return intervals.subtract(lens.track(spark, sf, 7, 0, "60 * p_size"), lens.track(spark, sf, 3)).select("chrom", "start", "end", "name")


_SWEEP = """, edges AS (SELECT chrom, place, sum(step) AS step FROM (SELECT chrom, pos AS place, 1 AS step FROM reads UNION ALL SELECT chrom, end_pos, -1 FROM reads) GROUP BY chrom, place),
swept AS (SELECT chrom, place AS start, lead(place) OVER w AS "end", sum(step) OVER w AS depth FROM edges WINDOW w AS (PARTITION BY chrom ORDER BY place)),
marked AS (SELECT *, CASE WHEN lag(depth) OVER w = depth AND lag("end") OVER w = start THEN 0 ELSE 1 END AS fresh FROM swept WHERE depth > 0 WINDOW w AS (PARTITION BY chrom ORDER BY start)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY start ROWS UNBOUNDED PRECEDING) AS run FROM marked)
"""


@query(_SWEEP + 'SELECT chrom, min(start) AS start, max("end") AS "end", depth::BIGINT AS depth FROM runs GROUP BY chrom, run, depth')
def depth_sweep(spark, sf):
    return intervals.depth(lens.reads(spark, sf).selectExpr("chrom", "pos AS start", "end_pos AS end"))


_DEEP = _SWEEP + """, deep AS (SELECT chrom, start, "end" FROM swept WHERE depth > 60),
o AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM deep),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start ROWS UNBOUNDED PRECEDING) AS island FROM o),
regions AS (SELECT chrom, min(start) AS start, max("end") AS "end" FROM g GROUP BY chrom, island)
"""


@query(_DEEP + 'SELECT chrom, start, "end" FROM regions')
def deep_regions(spark, sf):
    return reads.too_deep(lens.reads(spark, sf), 60)


@query(_DEEP + 'SELECT chrom, count(*) AS n, sum(pos)::BIGINT AS sum_pos FROM reads r ANTI JOIN regions t ON t.chrom = r.chrom AND t.start < r.end_pos AND t."end" > r.pos GROUP BY chrom')
def reads_without_deep(spark, sf):
    return reads.without_deep(lens.reads(spark, sf), 60).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("sum_pos"))


@query("SELECT qname, chrom, pos, end_pos, flag, mapq FROM reads WHERE (chrom = 'chr3' AND pos < 900 AND end_pos > 400) OR (chrom = 'chr3' AND pos < 2000 AND end_pos > 1990) OR (chrom = 'chr9' AND pos < 2600 AND end_pos > 2000)")
def reads_in_regions(spark, sf):
    """All reads stored in order with their index, and those of three regions read from the files that it names."""
    folder = stored(spark)
    read_store.write(lens.reads(spark, sf), folder, 5_000)
    regions = spark.createDataFrame([("chr3", 400, 900), ("chr3", 1990, 2000), ("chr9", 2000, 2600)], "chrom string, start long, end long")
    return dropped(spark, folder, read_store.within(spark, folder, regions).select("qname", "chrom", "pos", "end_pos", "flag", "mapq"))


@query("SELECT qname, chrom, pos, end_pos, flag, mapq FROM reads WHERE qname IN (SELECT qname FROM reads WHERE mapq = 6)")
def reads_named(spark, sf):
    rows = lens.reads(spark, sf)
    return reads.named(rows, rows.filter("mapq = 6")).select("qname", "chrom", "pos", "end_pos", "flag", "mapq")


def genes(spark, sf):
    return lens.table(spark, sf, "part").selectExpr(
        "concat('chr', p_partkey % 22 + 1) AS chrom", "if(p_size % 2 = 0, '+', '-') AS strand", "2 * p_partkey AS tx_start", "cast(2 * p_partkey + 100 + p_size AS bigint) AS tx_end", "p_brand AS gene",
        "array(2 * p_partkey, 2 * p_partkey + 40) AS exon_starts", "array(2 * p_partkey + 10, cast(2 * p_partkey + 100 + p_size AS bigint)) AS exon_ends",
    )


@query("SELECT DISTINCT 'chr' || (p_partkey % 22 + 1) AS chrom, CASE WHEN p_size % 2 = 0 THEN 2 * p_partkey ELSE 2 * p_partkey + 99 + p_size END AS start, "
       "CASE WHEN p_size % 2 = 0 THEN 2 * p_partkey + 1 ELSE 2 * p_partkey + 100 + p_size END AS \"end\", p_brand AS gene, 0 AS score, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part", prefix=False)  # fmt: skip
def start_sites(spark, sf):
    return annotation.starts(genes(spark, sf))


@query("SELECT 'chr' || (p_partkey % 22 + 1) AS chrom, 2 * p_partkey + a AS start, 2 * p_partkey + coalesce(b, 100 + p_size) AS \"end\", p_brand AS gene, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand "
       "FROM part, (VALUES (0, 10), (40, NULL)) t(a, b)", prefix=False)  # fmt: skip
def exon_rows(spark, sf):
    return annotation.exons(genes(spark, sf))


_EXONS = """WITH genes AS (SELECT 'chr' || (p_partkey % 22 + 1) AS chrom, 2 * p_partkey AS a, 2 * p_partkey + 100 + p_size AS b, p_brand AS gene, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part),
exons AS (SELECT chrom, a AS start, a + 10 AS "end", gene FROM genes UNION ALL SELECT chrom, a + 40, b, gene FROM genes),
ordered AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM exons),
islands AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM ordered),
merged AS (SELECT chrom, min(start) AS start, max("end") AS "end", string_agg(DISTINCT gene, ',' ORDER BY gene) AS gene FROM islands GROUP BY chrom, island)
"""


@query(_EXONS + 'SELECT chrom, start, "end", gene FROM merged', prefix=False)
def exons_merged(spark, sf):
    return annotation.merged_exons(genes(spark, sf))


@query(_EXONS + """, cut AS (SELECT g.*, greatest(m.start, a) AS s, least(m."end", b) AS e FROM genes g JOIN merged m ON m.chrom = g.chrom AND m.start < b AND m."end" > a),
points AS (SELECT g.chrom, g.a, g.b, g.gene, g.strand, g.a AS f, coalesce(min(c.s), g.b) AS t FROM genes g LEFT JOIN cut c ON c.chrom = g.chrom AND c.a = g.a GROUP BY g.chrom, g.a, g.b, g.gene, g.strand
  UNION ALL SELECT chrom, a, b, gene, strand, e, coalesce(lead(s) OVER (PARTITION BY chrom, a ORDER BY s), b) FROM cut)
SELECT chrom, f AS start, t AS "end", gene, strand FROM points WHERE t > f""", prefix=False)  # fmt: skip
def intron_rows(spark, sf):
    return annotation.introns(genes(spark, sf))


@query("SELECT 'chr' || (p_partkey % 22 + 1) AS chrom, 2 * p_partkey AS start, 2 * p_partkey + 100 + p_size AS \"end\", p_brand AS gene, 2 AS n_blocks, '10,' || (60 + p_size) AS sizes, '0,40' AS starts FROM part", prefix=False)
def block_form(spark, sf):
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return annotation.blocks(genes(spark, sf)).select("chrom", "start", "end", "gene", "n_blocks", text("block_sizes").alias("sizes"), text("block_starts").alias("starts"))


# -- coverage and distributions ----------------------------------------------------------------------------------------


@query("SELECT site_id, chrom, start, n_covered FROM covered")
def coverage_per_site(spark, sf):
    return coverage.per_site(cells(spark, sf))


@query("SELECT site_id, chrom, start, n_covered FROM covered ORDER BY n_covered, site_id LIMIT 100")
def coverage_bottom_k(spark, sf):
    return coverage.least_covered(coverage.per_site(cells(spark, sf)), 100)


@query("""SELECT x, coalesce(n, 0) AS n_sites, CASE WHEN x < 8 THEN coalesce(n, 0) ELSE 0 END AS n_sites_with_nan, coalesce(n, 0) * (8 - x) AS n_nan_values, coalesce(epc, 0) AS n_EPC, coalesce(island, 0) AS n_islandcpg
FROM range(1, 9) r(x) LEFT JOIN (SELECT n_covered, count(*) AS n, count(*) FILTER (list_has_any(string_split(origin, ';'), ['450k', '850k', 'v2'])) AS epc,
  count(*) FILTER (list_contains(string_split(origin, ';'), 'cpgIsland')) AS island FROM covered JOIN origins USING (site_id) GROUP BY n_covered) ON n_covered = x""")
def coverage_summary(spark, sf):
    sites = coverage.per_site(cells(spark, sf)).join(site_origins(spark, sf).select("site_id", "origin"), "site_id")
    return coverage.summary(sites, len(SAMPLES))


@query('SELECT chrom, start, start + 2 AS "end", site_id FROM covered WHERE n_covered / 8 * 100 >= 75')
def covered_75_percent(spark, sf):
    return coverage.covered_in(coverage.per_site(cells(spark, sf)), len(SAMPLES), 75)


@query(r"""SELECT site_id, CASE WHEN i AND a THEN 'island+array' WHEN i THEN 'island' WHEN a THEN 'array' ELSE 'other' END AS category
FROM (SELECT site_id, regexp_matches(origin, '\bcpgIsland\b', 'i') AS i, regexp_matches(origin, '\b(450k|850k|v2)\b', 'i') AS a FROM origins)""")
def origin_categories(spark, sf):
    return site_origins(spark, sf).select("site_id", expr.origin_category(F.col("origin")).alias("category"))


@query("SELECT origin, count(*) AS n FROM origins GROUP BY origin ORDER BY n DESC, origin LIMIT 15")
def origin_counts_top(spark, sf):
    return site_origins(spark, sf).groupBy("origin").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "origin").limit(15)


_HIST = """, h AS (SELECT least(floor(beta)::BIGINT + 1, 100) AS bin, count(*) AS n FROM cells WHERE beta > 0 AND beta < 100 GROUP BY 1),
bins AS (SELECT b.bin, coalesce(n, 0) AS n FROM range(1, 101) b(bin) LEFT JOIN h USING (bin))
"""


@query(_HIST + "SELECT bin, n FROM bins")
def beta_histogram(spark, sf):
    return distrib.histogram(cells(spark, sf))


@query(_HIST + """, e AS (SELECT 0 AS place, 0.0::DOUBLE AS value, count(*) FILTER (beta = 0) AS n FROM cells UNION ALL SELECT bin, bin - 0.5, n FROM bins UNION ALL SELECT 101, 100.0, count(*) FILTER (beta = 100) FROM cells),
c AS (SELECT *, sum(n) OVER (ORDER BY place) AS upto, sum(n) OVER () AS total FROM e),
p AS (SELECT *, coalesce(lag(upto) OVER (ORDER BY place), 0) AS below, coalesce(lag(value) OVER (ORDER BY place), 0) AS previous FROM c),
f AS (SELECT * FROM p WHERE total > 0 AND upto >= total / 2 ORDER BY place LIMIT 1)
SELECT round(CASE WHEN place = 0 THEN 0.0 ELSE coalesce(previous + (total / 2 - below) / nullif(upto - below, 0) * (value - previous), value) END, 6) AS median FROM f""")
def beta_histogram_median(spark, sf):
    return distrib.median_from_histogram(cells(spark, sf)).select(r6("median"))


@query("SELECT count(*) FILTER (beta = 0) AS n_zero, count(*) FILTER (beta = 100) AS n_hundred, count(*) FILTER (beta > 0 AND beta < 100) AS n_between, count(*) FILTER (beta IS NULL) AS n_missing, round(avg(beta), 6) AS mean FROM cells")
def beta_extremes(spark, sf):
    return distrib.extremes(cells(spark, sf)).select("n_zero", "n_hundred", "n_between", "n_missing", r6("mean"))


_EDGES = distrib.log_edges(30, 3000, 80)


@query(", e AS (SELECT [" + ", ".join(f"{x!r}::DOUBLE" for x in _EDGES) + """] AS edges),
h AS (SELECT least(len(list_filter(edges, lambda x: x <= cov)), 80)::BIGINT AS bin, count(*) AS n FROM cells, e WHERE cov >= edges[1] AND cov <= edges[81] GROUP BY 1)
SELECT b.bin, coalesce(n, 0) AS n FROM range(1, 81) b(bin) LEFT JOIN h USING (bin)""")
def coverage_log_histogram(spark, sf):
    return distrib.edge_histogram(cells(spark, sf), "cov", _EDGES)


@query("SELECT round(quantile_cont(cov, 0.1), 6) AS p10, round(quantile_cont(cov, 0.5), 6) AS p50, round(quantile_cont(cov, 0.9), 6) AS p90, round(avg(cov), 6) AS mean, max(cov) AS largest, round(avg((cov < 50)::INT), 6) AS below FROM cells")
def coverage_percentiles(spark, sf):
    return distrib.depth_quantiles(cells(spark, sf), 50).select(r6("p10"), r6("p50"), r6("p90"), r6("mean"), "largest", r6("below"))


@query("SELECT site_id, round(var_samp(beta) + 1e-9, 6) AS variance, count(beta) AS n_values FROM cells GROUP BY site_id HAVING count(beta) >= 2")
def site_variance(spark, sf):
    return variance(distrib.site_variance(cells(spark, sf)))


_VEDGES = distrib.log_edges(1, 10000, 50)


@query(", v AS (SELECT round(var_samp(beta) + 1e-9, 6) AS variance FROM cells GROUP BY site_id HAVING count(beta) >= 2), e AS (SELECT [" + ", ".join(f"{x!r}::DOUBLE" for x in _VEDGES) + """] AS edges),
h AS (SELECT least(len(list_filter(edges, lambda x: x <= variance)), 50)::BIGINT AS bin, count(*) AS n FROM v, e WHERE variance >= edges[1] AND variance <= edges[51] GROUP BY 1)
SELECT b.bin, coalesce(n, 0) AS n FROM range(1, 51) b(bin) LEFT JOIN h USING (bin)""")
def variance_histogram(spark, sf):
    return distrib.edge_histogram(variance(distrib.site_variance(cells(spark, sf))), "variance", _VEDGES)


@query(_FIRST + "SELECT feature_label, round(quantile_cont(beta, 0.25), 6) AS q1, round(quantile_cont(beta, 0.5), 6) AS median, round(quantile_cont(beta, 0.75), 6) AS q3, count(*) AS n FROM cells JOIN annotated USING (site_id) WHERE beta IS NOT NULL GROUP BY feature_label")
def feature_quartiles(spark, sf):
    both = cells(spark, sf).join(annotated(spark, sf).select("site_id", "feature_label"), "site_id")
    return distrib.feature_quartiles(both).select("feature_label", r6("q1"), r6("median"), r6("q3"), "n")


_PAIR = """, xy AS (SELECT site_id, max(beta) FILTER (sample = 's0') AS x, max(beta) FILTER (sample = 's1') AS y FROM cells GROUP BY site_id)
"""


@query(_FIRST + _PAIR + "SELECT feature_label, count(*) AS n, CASE WHEN count(*) > 1 AND var_pop(x) * var_pop(y) > 1e-18 THEN round(covar_pop(x, y) / sqrt(var_pop(x) * var_pop(y)), 6) END AS r FROM xy JOIN annotated USING (site_id) WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY feature_label")
def pair_correlation(spark, sf):
    both = cells(spark, sf).join(annotated(spark, sf).select("site_id", "feature_label"), "site_id")
    return distrib.pair_correlation(both, "s0", "s1", ["feature_label"]).select("feature_label", "n", r6("r"))


@query("SELECT site_id, round(coalesce(var_samp(beta), 0) + 1e-9, 6) AS variance FROM cells GROUP BY site_id ORDER BY variance DESC, site_id LIMIT 50")
def most_variable_sites(spark, sf):
    return distrib.most_variable(variance(distrib.site_variance(cells(spark, sf), zero=True)).select("site_id", "variance"), 50)


# -- matrices ----------------------------------------------------------------------------------------------------------


@query("SELECT site_id, sample, beta FROM observed WHERE site_id IN (SELECT site_id FROM observed GROUP BY site_id HAVING count(beta) / 64 >= 0.9)")
def completeness_filter(spark, sf):
    return matrix.complete_enough(lens.values(spark, sf), 64, 0.9)


@query("SELECT site_id, sample, beta FROM observed WHERE site_id IN (SELECT site_id FROM observed GROUP BY site_id HAVING count(beta) = 64)")
def sites_without_missing(spark, sf):
    return matrix.without_missing(lens.values(spark, sf), 64)


@query("SELECT site_id, sample, beta FROM observed WHERE sample NOT IN ('d00', 'd07') AND site_id IN (SELECT site_id FROM observed WHERE sample NOT IN ('d00', 'd07') GROUP BY site_id HAVING count(beta) > 0)")
def sample_exclusion(spark, sf):
    return matrix.without_samples(lens.values(spark, sf), ["d00", "d07"])


@query("SELECT site_id, sample, round(coalesce(beta, median(beta) OVER (PARTITION BY site_id)), 6) + 0.0 AS beta FROM observed")
def impute_median(spark, sf):
    return matrix.impute_median(lens.values(spark, sf)).select("site_id", "sample", r6("beta"))


@query("SELECT site_id, sample, (beta >= 0.1)::INT::DOUBLE AS beta FROM complete")
def binarize(spark, sf):
    return matrix.binary(lens.complete(spark, sf), 0.1)


@query("SELECT site_id, sample, round((beta - avg(beta) OVER w) / CASE WHEN stddev_pop(beta) OVER w = 0 THEN 1 ELSE stddev_pop(beta) OVER w END, 6) + 0.0 AS beta FROM complete WINDOW w AS (PARTITION BY site_id)")
def standard_scale(spark, sf):
    return matrix.standard_scaled(lens.complete(spark, sf)).select("site_id", "sample", r6("beta"))


@query(""", q AS (SELECT site_id, quantile_cont(beta, [0.1, 0.5, 0.9]) AS q FROM complete GROUP BY site_id)
SELECT site_id, sample, round((beta - q[2]) / greatest(CASE WHEN q[3] - q[1] = 0 THEN 1 ELSE q[3] - q[1] END, 1e-8), 6) + 0.0 AS beta FROM complete JOIN q USING (site_id)""")
def robust_scale(spark, sf):
    return matrix.robust_scaled(lens.complete(spark, sf)).select("site_id", "sample", r6("beta"))


_ALONG = """, v AS (SELECT chrom, sample, start, site_id, beta FROM cells),
n AS (SELECT *, last_value(CASE WHEN beta IS NOT NULL THEN start END IGNORE NULLS) OVER l AS ls, last_value(beta IGNORE NULLS) OVER l AS lb,
      first_value(CASE WHEN beta IS NOT NULL THEN start END IGNORE NULLS) OVER r AS rs, first_value(beta IGNORE NULLS) OVER r AS rb FROM v
  WINDOW l AS (PARTITION BY sample, chrom ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), r AS (PARTITION BY sample, chrom ORDER BY start ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
imputed AS (SELECT site_id, sample, beta AS before, coalesce(beta, CASE WHEN ls IS NOT NULL AND rs IS NOT NULL THEN (lb * (rs - start) + rb * (start - ls)) / ((rs - start) + (start - ls)) ELSE coalesce(lb, rb) END) AS beta FROM n)
"""


@query(_ALONG + "SELECT CASE WHEN grouping(sample) = 1 THEN 'all' ELSE sample END AS sample, count(*) AS n_sites, count(*) - count(before) AS missing_before, count(*) - count(beta) AS missing_after, count(beta) - count(before) AS n_imputed, "
       "round(100.0 * (count(*) - count(before)) / count(*), 6) AS percent_before, round(100.0 * (count(*) - count(beta)) / count(*), 6) AS percent_after FROM imputed GROUP BY ROLLUP (sample)")  # fmt: skip
def imputation_missing(spark, sf):
    before = cells(spark, sf)
    return cohort.missing_before_after(before, matrix.impute_along(before))


@query("SELECT coalesce(m.sample, d.sample) AS sample, CASE WHEN m.sample IS NULL THEN 'measurements' ELSE 'metadata' END AS lacks FROM (SELECT DISTINCT 's' || (l_suppkey % 8) AS sample FROM lineitem) m "
       "FULL JOIN (SELECT DISTINCT 's' || (s_suppkey % 11) AS sample FROM supplier WHERE s_suppkey % 11 <> 3) d ON m.sample = d.sample WHERE m.sample IS NULL OR d.sample IS NULL", prefix=False)  # fmt: skip
def samples_unmatched(spark, sf):
    """Samples without metadata, and metadata without measurements."""
    metadata = lens.table(spark, sf, "supplier").selectExpr("concat('s', s_suppkey % 11) AS sample").filter("sample <> 's3'")
    return cohort.unmatched(lens.measure(spark, sf), metadata, "measurements", "metadata")


@query(_ALONG + "SELECT site_id, sample, round(beta, 6) AS beta FROM imputed")
def impute_along(spark, sf):
    return matrix.impute_along(cells(spark, sf)).select("site_id", "sample", r6("beta"))


@query(""", s AS (SELECT a.sample AS i, b.sample AS j, sqrt((SELECT count(DISTINCT site_id) FROM observed WHERE beta IS NOT NULL) / count(*) * sum((a.beta - b.beta) * (a.beta - b.beta))) AS d
  FROM observed a JOIN observed b ON a.site_id = b.site_id AND a.sample <> b.sample WHERE a.beta IS NOT NULL AND b.beta IS NOT NULL GROUP BY 1, 2),
near AS (SELECT m.site_id, m.sample, o.beta, d, row_number() OVER (PARTITION BY m.site_id, m.sample ORDER BY d, o.sample) AS place
  FROM observed m JOIN observed o ON o.site_id = m.site_id JOIN s ON i = m.sample AND j = o.sample WHERE m.beta IS NULL AND o.beta IS NOT NULL),
estimate AS (SELECT site_id, sample, sum(beta / d) / sum(1 / d) AS value FROM near WHERE place <= 5 GROUP BY ALL)
SELECT site_id, sample, round(greatest(-1, least(1, coalesce(beta, value))), 6) + 0.0 AS beta FROM observed LEFT JOIN estimate USING (site_id, sample)""")
def impute_knn(spark, sf):
    return matrix.impute_neighbours(lens.values(spark, sf), DIMENSIONS, 5, -1.0, 1.0).select("site_id", "sample", r6("beta"))


@query()
def impute_pca_em(spark, sf):
    return matrix.impute_components(lens.values(spark, sf), DIMENSIONS, 10, 50, 1e-4, -1.0, 1.0).select("site_id", "sample", r6("beta"))


@query("SELECT site_id, sample, round(coalesce(beta, ('0x' || substr(md5(site_id || ':' || sample || ':42'), 1, 13))::BIGINT / 4503599627370496), 6) + 0.0 AS beta FROM observed")
def impute_random(spark, sf):
    return matrix.impute_random(lens.values(spark, sf)).select("site_id", "sample", r6("beta"))


# -- distances ---------------------------------------------------------------------------------------------------------

_RANKS = ", ranked AS (SELECT site_id, sample, rank() OVER (PARTITION BY sample ORDER BY beta) + (count(*) OVER (PARTITION BY sample, beta) - 1) / 2 AS beta FROM observed WHERE beta IS NOT NULL)\n"


def _pairs_sql(source: str, value: str) -> str:
    return f""", s AS (SELECT a.sample AS sample_i, b.sample AS sample_j, count(*) AS n, sum(a.beta) AS x, sum(b.beta) AS y, sum(a.beta * a.beta) AS xx, sum(b.beta * b.beta) AS yy, sum(a.beta * b.beta) AS xy
  FROM {source} a JOIN {source} b ON a.site_id = b.site_id AND a.sample < b.sample WHERE a.beta IS NOT NULL AND b.beta IS NOT NULL GROUP BY 1, 2)
SELECT sample_i, sample_j, {value} AS d, n AS n_co FROM s"""


_PEARSON = "round(1 - greatest(-1, least(1, CASE WHEN sqrt(greatest(xx - x * x / n, 0) * greatest(yy - y * y / n, 0)) < 1e-12 THEN 0 ELSE (xy - x * y / n) / sqrt(greatest(xx - x * x / n, 0) * greatest(yy - y * y / n, 0)) END)), 6)"


def _pairwise(spark, sf, metric):
    return distance.frame(spark, DIMENSIONS, *distance.pairwise(lens.values(spark, sf), DIMENSIONS, metric)).select("sample_i", "sample_j", r6("d"), "n_co")


@query(_RANKS + "SELECT site_id, sample, beta::DOUBLE AS beta FROM ranked")
def spearman_ranks(spark, sf):
    return distance.ranks(lens.values(spark, sf)).select("site_id", "sample", "beta")


@query(_pairs_sql("observed", _PEARSON))
def pairwise_pearson(spark, sf):
    return _pairwise(spark, sf, "pearson")


@query(_RANKS + _pairs_sql("ranked", _PEARSON))
def pairwise_spearman(spark, sf):
    return _pairwise(spark, sf, "spearman")


@query(_pairs_sql("observed", "round(sqrt((SELECT count(DISTINCT site_id) FROM observed WHERE beta IS NOT NULL) / n * greatest(xx + yy - 2 * xy, 0)), 6)"))
def pairwise_euclidean(spark, sf):
    return _pairwise(spark, sf, "euclidean")


@query("SELECT count(*) FILTER (n < 400) AS n_low, count(*) AS n_pairs FROM (SELECT count(*) AS n FROM observed a JOIN observed b ON a.site_id = b.site_id AND a.sample < b.sample WHERE a.beta IS NOT NULL AND b.beta IS NOT NULL GROUP BY a.sample, b.sample)")
def few_common_sites(spark, sf):
    _, common = distance.pairwise(lens.values(spark, sf), DIMENSIONS, "euclidean")
    return spark.createDataFrame([(distance.few_common(common, 400), len(DIMENSIONS) * (len(DIMENSIONS) - 1) // 2)], "n_low long, n_pairs long")


def _groups(spark):
    return spark.createDataFrame([(s, i % 4) for i, s in enumerate(DIMENSIONS)], "sample string, label int")


_EUCLID = """, pairs AS (SELECT a.sample AS sample_i, b.sample AS sample_j, sqrt(sum((a.beta - b.beta) * (a.beta - b.beta))) AS d FROM complete a JOIN complete b ON a.site_id = b.site_id AND a.sample < b.sample GROUP BY 1, 2),
groups AS (SELECT DISTINCT sample, sample[2:]::INT % 4 AS label FROM complete)
"""


def _complete_distances(spark, sf):
    return distance.pairwise(lens.complete(spark, sf), DIMENSIONS, "euclidean")[0]


def _complete_pairs(spark, sf):
    return distance.frame(spark, DIMENSIONS, _complete_distances(spark, sf))


@query(_EUCLID + """, mirrored AS (SELECT sample_i, sample_j, d FROM pairs UNION ALL SELECT sample_j, sample_i, d FROM pairs),
m AS (SELECT b.sample_i, i.label AS own, j.label, avg(d) AS d FROM mirrored b JOIN groups i ON i.sample = b.sample_i JOIN groups j ON j.sample = b.sample_j GROUP BY ALL),
ab AS (SELECT sample_i AS sample, max(d) FILTER (own = label) AS a, min(d) FILTER (own <> label) AS b FROM m GROUP BY sample_i)
SELECT sample, round((b - a) / greatest(a, b), 6) + 0.0 AS silhouette FROM ab""")
def silhouette(spark, sf):
    return distance.silhouettes(_complete_pairs(spark, sf), _groups(spark)).select("sample", r6("silhouette"))


@query(_EUCLID + """, n AS (SELECT count(*) AS n, count(DISTINCT label) AS a FROM groups), sizes AS (SELECT label, count(*) AS size FROM groups GROUP BY label),
s AS (SELECT sum(d * d) AS total, sum(d * d / size) FILTER (i.label = j.label) AS within FROM pairs JOIN groups i ON i.sample = sample_i JOIN groups j ON j.sample = sample_j JOIN sizes z ON z.label = i.label)
SELECT n AS "N", a AS a_groups, round(total / n, 6) AS ss_total, round(within, 6) AS ss_within, round(total / n - within, 6) AS ss_between, round(((total / n - within) / (a - 1)) / (within / (n - a)), 6) AS pseudo_f FROM s, n""")
def permanova_observed(spark, sf):
    out = stats.permanova_observed(_complete_pairs(spark, sf), _groups(spark))
    return out.select("N", "a_groups", r6("ss_total"), r6("ss_within"), r6("ss_between"), r6("pseudo_f"))


@query(_EUCLID + """, sq AS (SELECT sample_i AS i, sample_j AS j, d * d AS q FROM pairs UNION ALL SELECT sample_j, sample_i, d * d FROM pairs UNION ALL SELECT sample, sample, 0 FROM groups),
r AS (SELECT i, avg(q) AS m FROM sq GROUP BY i), g AS (SELECT avg(q) AS m FROM sq)
SELECT sq.i AS sample_i, sq.j AS sample_j, round(-0.5 * (q - a.m - b.m + g.m), 6) + 0.0 AS b FROM sq JOIN r a ON a.i = sq.i JOIN r b ON b.i = sq.j, g""")
def gower_center(spark, sf):
    b = linalg.gower(_complete_distances(spark, sf))
    rows = [(DIMENSIONS[i], DIMENSIONS[j], float(b[i, j])) for i in range(len(b)) for j in range(len(b))]
    return spark.createDataFrame(rows, "sample_i string, sample_j string, b double").select("sample_i", "sample_j", r6("b"))


@query("""SELECT p_partkey, p_value, round(least(1.0, greatest(0.0, min(p_value * n / rank) OVER (ORDER BY rank DESC ROWS UNBOUNDED PRECEDING))), 9) AS p_adj
FROM (SELECT p_partkey, p_retailprice / 100000 AS p_value, row_number() OVER (ORDER BY p_retailprice / 100000, p_partkey) AS rank, count(*) OVER () AS n FROM part)""", prefix=False)  # fmt: skip
def bh_adjust(spark, sf):
    tests = lens.table(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") / 100000).alias("p_value"))
    return stats.adjusted(tests).select("p_partkey", "p_value", F.round("p_adj", 9).alias("p_adj"))


@query("SELECT p_size AS cluster, count(*) AS n_patients, string_agg(name, ', ' ORDER BY name) AS patients FROM (SELECT p_size, 'p' || p_partkey AS name FROM part) GROUP BY p_size", prefix=False)
def cluster_members(spark, sf):
    return cluster.members(lens.table(spark, sf, "part").selectExpr("p_size AS cluster", "concat('p', p_partkey) AS sample"))


@query(""", i AS (SELECT p_size AS k, sum(p_retailprice) AS y FROM part GROUP BY p_size), e AS (SELECT min(k) AS x1, max(k) AS x2, arg_min(y, k) AS y1, arg_max(y, k) AS y2 FROM i)
SELECT k::BIGINT AS k FROM i, e ORDER BY round(abs((x2 - x1) * (y1 - y) - (x1 - k) * (y2 - y1)), 3) DESC, k LIMIT 1""")
def elbow_k(spark, sf):
    rows = lens.table(spark, sf, "part").groupBy("p_size").agg(F.sum("p_retailprice").alias("y")).orderBy("p_size").collect()
    return spark.createDataFrame([(int(cluster.elbow([r["y"] for r in rows], [r["p_size"] for r in rows])),)], "k long")


# -- small matrices, tests and clusters: no SQL -----------------------------------------------------------------------


@query()
def pca(spark, sf):
    at, share = linalg.components(matrix.standard_scaled(lens.complete(spark, sf)), DIMENSIONS, 5)
    rows = [(s, *map(float, at[i])) for i, s in enumerate(DIMENSIONS)]
    out = spark.createDataFrame(rows, "sample string, " + ", ".join(f"PC{i + 1} double" for i in range(at.shape[1])))
    return out.select("sample", *(r6(f"PC{i + 1}") for i in range(at.shape[1])))


@query()
def pcoa(spark, sf):
    out = linalg.principal_coordinates(distance.pairwise(lens.values(spark, sf), DIMENSIONS, "pearson")[0])
    rows = [(f"PCo{i + 1}", float(v), float(p), float(c)) for i, (v, p, c) in enumerate(zip(out["eigenvalues"], out["percent"], np.cumsum(out["percent"])))]
    return spark.createDataFrame(rows, "axis string, eigenvalue double, pct_variance double, cumulative_pct_variance double").select("axis", r6("eigenvalue"), r6("pct_variance"), r6("cumulative_pct_variance"))


@query()
def pcoa_corrected(spark, sf):
    """Coordinates of squares of distances, which points need not have, after a correction where there is something to correct."""
    out = linalg.principal_coordinates(distance.pairwise(lens.values(spark, sf), DIMENSIONS, "euclidean")[0] ** 2)
    rows = [(f"PCo{i + 1}", float(v), float(out["negative"])) for i, v in enumerate(out["eigenvalues"])]
    return spark.createDataFrame(rows, "axis string, eigenvalue double, negative_share double").select("axis", r6("eigenvalue"), r6("negative_share"))


def _coordinates(spark, sf):
    return linalg.components(lens.complete(spark, sf), DIMENSIONS, len(DIMENSIONS))[0]


@query()
def kmeans(spark, sf):
    x, rows = _coordinates(spark, sf), []
    d = np.sqrt(np.maximum(((x[:, None] - x[None]) ** 2).sum(2), 0))
    for k in cluster.k_range(len(x)):
        labels, inertia = cluster.k_means(x, k)
        rows.append((k, float(inertia), cluster.silhouette(d, labels)))
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double").select("k", r6("inertia"), r6("silhouette"))


@query()
def gmm(spark, sf):
    x, features = _coordinates(spark, sf), lens.table(spark, sf, "embeddings").count()
    fits = [(k, cluster.mixture(x, k, features)) for k in cluster.k_range(len(x))]
    return spark.createDataFrame([(k, float(f["bic"]), float(f["aic"]), bool(f["converged"])) for k, f in fits], "k int, bic double, aic double, converged boolean").select("k", F.round("bic", 3).alias("bic"), F.round("aic", 3).alias("aic"), "converged")


@query()
def gmm_shapes(spark, sf):
    """Two components in each of the shapes; the diagonal one is fitted on the sites themselves."""
    x, vectors = _coordinates(spark, sf), settle(matrix.vectors(lens.complete(spark, sf), DIMENSIONS))
    features = vectors.count()
    fits = {s: cluster.diagonal_mixture(vectors, x, 2, features, 1e-3, 3) if s == "diag" else cluster.mixture(x, 2, features, s, 1e-3, 3) for s in cluster.SHAPES}
    return spark.createDataFrame([(s, float(f["bic"]), float(f["aic"])) for s, f in fits.items()], "shape string, bic double, aic double").select("shape", F.round("bic", 3).alias("bic"), F.round("aic", 3).alias("aic"))


@query("SELECT count(*) AS n_singletons FROM (SELECT p_retailprice FROM part GROUP BY p_retailprice HAVING count(*) = 1)", prefix=False)
def cluster_singletons(spark, sf):
    return cluster.singletons(lens.table(spark, sf, "part").selectExpr("p_retailprice AS cluster", "p_partkey AS sample"))


@query()
def kmedoids(spark, sf):
    d = _complete_distances(spark, sf)
    labels, _, centre = cluster.medoids(d, 4)
    return spark.createDataFrame([(s, int(labels[i]), DIMENSIONS[centre[labels[i]]]) for i, s in enumerate(DIMENSIONS)], "sample string, cluster int, medoid string")


@query()
def hierarchical(spark, sf):
    merges = cluster.linkage(_complete_distances(spark, sf), "average")
    labels = cluster.cut(merges, len(DIMENSIONS), 4)
    return spark.createDataFrame([(s, int(labels[i])) for i, s in enumerate(DIMENSIONS)], "sample string, cluster int")


@query()
def linkage_table(spark, sf):
    merges = cluster.linkage(_complete_distances(spark, sf), "complete")
    return spark.createDataFrame([(int(a), int(b), float(h), int(n)) for a, b, h, n in merges], "left int, right int, height double, size int").select("left", "right", r6("height"), "size")


@query()
def heatmap_order(spark, sf):
    """The 50 most variable sites with their samples in the order of a Ward tree."""
    top = distrib.most_variable(distrib.site_variance(lens.values(spark, sf), zero=True), 50).select("site_id")
    rows = matrix.impute_median(lens.values(spark, sf).join(top, "site_id", "left_semi"))
    d = distance.pairwise(rows, DIMENSIONS, "euclidean")[0]
    order = {i: k for k, i in enumerate(cluster.leaves(cluster.linkage(d, "ward"), len(DIMENSIONS)))}
    places = spark.createDataFrame([(s, order[i]) for i, s in enumerate(DIMENSIONS)], "sample string, place int")
    return rows.join(F.broadcast(places), "sample").select("site_id", "sample", "place", r6("beta"))


@query()
def umap(spark, sf):
    at = cluster.layout(_complete_distances(spark, sf))
    return spark.createDataFrame([(s, float(at[i, 0]), float(at[i, 1])) for i, s in enumerate(DIMENSIONS)], "sample string, UMAP1 double, UMAP2 double").select("sample", r6("UMAP1"), r6("UMAP2"))


@query()
def permanova_test(spark, sf):
    out = stats.permanova(spark, _complete_distances(spark, sf), [i % 4 for i in range(len(DIMENSIONS))])
    return spark.createDataFrame([(out["pseudo_f"], out["p_value"], out["null_median"], out["null_p95"])], "pseudo_f double, p_value double, null_median double, null_p95 double").select(*map(r6, ("pseudo_f", "p_value", "null_median", "null_p95")))


def _risk(spark, sf):
    means = {r["sample"]: r["m"] for r in lens.complete(spark, sf).groupBy("sample").agg(F.round(F.avg("beta"), 9).alias("m")).collect()}
    return np.array([means[s] for s in DIMENSIONS])


def _axes(spark, sf):
    x = linalg.principal_coordinates(_complete_distances(spark, sf))["coordinates"]
    return x[:, : stats.axes_to_try(len(DIMENSIONS), x.shape[1])]


@query()
def axis_risk_correlation(spark, sf):
    x, y = _axes(spark, sf), _risk(spark, sf)
    rows = [(f"PCo{i + 1}", *map(float, stats.spearman(x[:, i], y))) for i in range(x.shape[1])]
    return stats.adjusted(spark.createDataFrame(rows, "axis string, spearman_rho double, p_value double")).select("axis", r6("spearman_rho"), r6("p_value"), r6("p_adj"))


@query()
def loocv(spark, sf):
    x = _axes(spark, sf)
    _, _, table = stats.best_axes(x, _risk(spark, sf), x.shape[1])
    return spark.createDataFrame([(k + 1, float(q)) for k, q in enumerate(table)], "k int, q2 double").select("k", r6("q2"))


@query()
def gradient_test(spark, sf):
    x = _axes(spark, sf)
    out = stats.gradient_test(spark, x, _risk(spark, sf), x.shape[1])
    return spark.createDataFrame([(out["k"], out["q2"], out["p_value"])], "k int, q2 double, p_value double").select("k", r6("q2"), r6("p_value"))


@query()
def gradient_scores(spark, sf):
    x, y = _axes(spark, sf), _risk(spark, sf)
    k, _, _ = stats.best_axes(x, y, x.shape[1])
    _, _, score = stats.gradient(x[:, :k], y)
    return spark.createDataFrame([(s, float(y[i]), float(score[i])) for i, s in enumerate(DIMENSIONS)], "sample string, risk double, projection double").select("sample", r6("risk"), r6("projection")).orderBy("projection", "sample")


# -- reads ---------------------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT qname FROM reads r SEMI JOIN track3 t ON t.chrom = r.chrom AND t.start < r.end_pos AND t.\"end\" > r.pos WHERE (flag & 2308) = 0")
def read_names(spark, sf):
    return reads.names_on(lens.reads(spark, sf), lens.track(spark, sf, 3))


@query("SELECT count(*) AS n, sum(pos)::BIGINT AS sum_pos FROM reads WHERE mapq >= 1")
def reads_mapped_well(spark, sf):
    return reads.mapped_well(lens.reads(spark, sf)).agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("sum_pos"))


@query("SELECT chrom, count(*) AS n, sum(pos)::BIGINT AS sum_pos FROM reads r SEMI JOIN tss t ON t.chrom = r.chrom AND t.start < r.end_pos AND t.\"end\" > r.pos GROUP BY chrom")
def reads_on_target(spark, sf):
    return reads.on_regions(lens.reads(spark, sf), lens.track(spark, sf, 5, 0, "1")).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("sum_pos"))


@query("SELECT chrom, count(*) AS n, sum(pos)::BIGINT AS sum_pos FROM reads r ANTI JOIN tss t ON t.chrom = r.chrom AND t.start < r.end_pos AND t.\"end\" > r.pos GROUP BY chrom")
def reads_off_target(spark, sf):
    return reads.on_regions(lens.reads(spark, sf), lens.track(spark, sf, 5, 0, "1"), inside=False).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("sum_pos"))


@query("SELECT chrom, count(*) AS n FROM (SELECT * FROM reads WHERE mapq >= 3 UNION ALL SELECT * FROM reads WHERE flag = 256) GROUP BY chrom")
def reads_union(spark, sf):
    all_ = lens.reads(spark, sf)
    return reads.together(all_.filter("mapq >= 3"), all_.filter("flag = 256")).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT * FROM reads WHERE substr(md5(qname || ':100'), 1, 8) < '20000000'")
def reads_thinned(spark, sf):
    return reads.thinned(lens.reads(spark, sf))


_CALLS = """, calls AS (
  SELECT 'chr' || (l_partkey % 22 + 1) AS chrom, 2 * l_partkey AS start, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand,
         CASE WHEN l_returnflag = 'R' THEN 'h' ELSE 'm' END AS mod_code, (l_orderkey * 37 + l_partkey * 11 + l_linenumber) % 256 / 255.0::DOUBLE AS prob FROM lineitem),
certain AS (SELECT *, greatest(prob, 1 - prob) AS certainty FROM calls)
"""


@query(_CALLS + "SELECT chrom, start, strand, mod_code, count(*) AS n_valid, round(100 * avg((prob >= 0.5)::INT), 6) AS fraction FROM certain "
       "WHERE certainty >= (SELECT quantile_disc(certainty, 0.1) FROM certain) GROUP BY ALL")  # fmt: skip
def pileup_estimated(spark, sf):
    """The pileup of all calls but the tenth that is least certain."""
    rows = lens.table(spark, sf, "lineitem").selectExpr("concat('chr', l_partkey % 22 + 1) AS chrom", "array(named_struct('pos', 2 * l_partkey, 'strand', if(l_linestatus = 'F', '+', '-'), 'mod_code', if(l_returnflag = 'R', 'h', 'm'), "
                                                        "'prob', (l_orderkey * 37 + l_partkey * 11 + l_linenumber) % 256 / 255.0D)) AS mods")  # fmt: skip
    return reads.pileup(rows, None).select("chrom", "start", "strand", "mod_code", "n_valid", r6("fraction"))


@query("SELECT chrom, start, strand, mod_code, count(*) AS n_valid, round(100 * avg((prob >= 0.5)::INT), 6) AS fraction FROM (SELECT 'chr' || (l_partkey % 22 + 1) AS chrom, 2 * l_partkey AS start, "
       "CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, CASE WHEN l_returnflag = 'R' THEN 'h' ELSE 'm' END AS mod_code, l_discount * 10 AS prob FROM lineitem) GROUP BY ALL", prefix=False)  # fmt: skip
def pileup(spark, sf):
    rows = lens.table(spark, sf, "lineitem").selectExpr("concat('chr', l_partkey % 22 + 1) AS chrom", "array(named_struct('pos', 2 * l_partkey, 'strand', if(l_linestatus = 'F', '+', '-'), 'mod_code', if(l_returnflag = 'R', 'h', 'm'), 'prob', l_discount * 10)) AS mods")
    return reads.pileup(rows).select("chrom", "start", "strand", "mod_code", "n_valid", r6("fraction"))
