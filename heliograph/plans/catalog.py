"""Every registered query with its SQL. Names are the operator inventory's ids."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliograph.functions import names, scores
from heliograph.operators import activity, cells, communities, embedding, factor, guards, intervals, metadata, motif, neighbours, order, pseudobulk, ranks, regulatory, sampling
from heliograph.operators.cut import cut, shared_dir
from heliograph.plans import batch, views
from heliograph.sources import matrix, readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
T = views.table
#: Thresholds that leave something of the driver's tables.
LOOSE = regulatory.Thresholds(peak_gene_fdr=0.9, peak_gene_r=0.02, motif_pvalue=0.01, tf_pseudobulk_mean=0.1, tf_pseudobulk_max=0.2, tf_gene_r=0.0)


def query(sql: str | None = None, base: bool = True):
    def add(f):
        name = f.__name__
        QUERIES[name] = f
        if sql:
            body = sql.strip()
            if base:
                body = "WITH " + views.BASE.strip() + (",\n" + body[5:] if body.startswith("WITH ") else "\n" + body)
            ORACLE[name] = body
        return f

    return add


def r6(*columns: str) -> dict:
    return {c: F.round(c, 6) for c in columns}


# ---- flagship, scans, sinks


@query("SELECT gene, cell, CAST(sum(value) AS DOUBLE) AS activity FROM atac JOIN links USING (peak) GROUP BY 1, 2")
def gene_activity(s, d):
    """AG8, JN6: accessibility of all linked peaks, by gene and cell."""
    return activity.gene_activity(views.atac(s, d), views.links(s, d))


@query("SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem WHERE l_quantity > 25", base=False)
def sc8_parquet_scan(s, d):
    """Projection and predicate reach the scan."""
    return T(s, d, "lineitem").filter("l_quantity > 25").select("l_orderkey", "l_suppkey", "l_quantity")


@query("SELECT CAST(regexp_extract(u, '/([^/]+)/[^/]*$', 1) AS VARCHAR) AS dataset, count(*) AS n FROM (SELECT 'x/region/part' AS u FROM region UNION ALL SELECT 'x/nation/part' FROM nation) GROUP BY 1", base=False)
def sc15_dataset_glob(s, d):
    """The dataset's name from the path."""
    path = T(s, d, "region").select(F.lit("x/region/part").alias("u")).unionAll(T(s, d, "nation").select(F.lit("x/nation/part").alias("u")))
    return path.select(F.element_at(F.split("u", "/"), -2).alias("dataset")).groupBy("dataset").agg(F.count("*").alias("n"))


def _gtf_lines(s, d):
    """Annotation records made of customers: genes and transcripts, some of other types, in file order."""
    c, k = T(s, d, "customer"), F.col("c_custkey")
    strand = F.when(k % 2 == 0, "+").otherwise("-")
    rec = lambda kind, n: c.select((k * 2 + n).alias("line_no"), F.concat_ws("\t", (k % 22 + 1).cast("string"), F.lit("src"), F.lit(kind), (k * 10).cast("string"), (k * 10 + 50).cast("string"), F.lit("."), strand, F.lit("."), F.concat(F.lit('gene_id "G'), k.cast("string"), F.lit('"; gene_'), F.when(k % 3 == 0, "biotype").otherwise("type"), F.lit(' "'), F.when(k % 7 == 0, "lncRNA").otherwise("protein_coding"), F.lit('"; gene_name "'), "c_name", F.lit('";'))).alias("value"))
    return rec("gene", 0).unionAll(rec("transcript", 1)).unionAll(c.limit(1).select(F.lit(-1).cast("long").alias("line_no"), F.lit("#comment").alias("value")))


@query("SELECT c_name AS gene, 'chr' || (c_custkey % 22 + 1) AS chrom, CASE WHEN c_custkey % 2 = 0 THEN c_custkey * 10 ELSE c_custkey * 10 + 50 END AS tss, CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM customer WHERE c_custkey % 7 <> 0", base=False)
def sc4_gtf_genes(s, d):
    """SC4, SC5: start sites of protein-coding genes; chromosomes get their prefix."""
    return readers.parse_gtf(_gtf_lines(s, d))[0]


@query("SELECT c_name AS gene, 'chr' || (c_custkey % 22 + 1) AS chrom, c_custkey * 10 AS \"start\", c_custkey * 10 + 50 AS \"end\" FROM customer WHERE c_custkey % 7 <> 0", base=False)
def sc5_gtf_bodies(s, d):
    return readers.parse_gtf(_gtf_lines(s, d))[1]


@query("SELECT gene, CAST(value AS FLOAT) AS value, cell FROM rna")
def sk2_sparse_export(s, d):
    """The rows of the value table that the sparse sink writes."""
    return views.rna(s, d).select("cell", "gene", F.col("value").cast("float").alias("value"))


@query("SELECT DISTINCT gene, cell FROM rna")
def sk2_inverted_index(s, d):
    return views.rna(s, d).select("gene", "cell")


@query("SELECT DISTINCT replace(n_name, ' ', '_') AS contig FROM nation", base=False)
def sc11_fasta_contigs(s, d):
    lines = T(s, d, "nation").select(F.explode(F.array(F.concat(F.lit(">"), F.translate("n_name", " ", "_"), F.lit(" description")), F.lit("ACGT"))).alias("value"))
    return readers.fasta_contigs(lines)


@query("SELECT CAST(cell AS VARCHAR) AS cell, gene, value FROM rna")
def sc9_matrix_slice(s, d):
    """SC1, SC9: both facts as a matrix folder, of which one modality is read back; the other is left out where entries are parsed."""
    facts = [x.select("cell", F.col(f).cast("string").alias("feature"), F.lit(kind).alias("feature_type"), "value") for x, f, kind in ((views.rna(s, d), "gene", "Gene Expression"), (views.atac(s, d), "peak", "Peaks"))]
    path = f"{shared_dir(s)}/matrix-{uuid.uuid4().hex}"
    matrix.write_folder(facts[0].unionByName(facts[1]), path)
    return matrix.read_slice(s, path, "feature_type = 'Gene Expression'").select("cell", F.col("feature").alias("gene"), "value")


_SAMPLE = "'S' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')"


@query(f"SELECT {_SAMPLE} AS sample_name, CASE n_nationkey % 4 WHEN 0 THEN {_SAMPLE} WHEN 1 THEN {_SAMPLE} || '_x' WHEN 2 THEN replace({_SAMPLE}, 'S', 'file') END AS path, CASE n_nationkey % 4 WHEN 0 THEN 'name' WHEN 1 THEN 'name_part' WHEN 2 THEN 'file' END AS rule FROM nation", base=False)
def sc13_input_resolution(s, d):
    """By name, part of a name, file, part of a file; each sample has one kind of path or none."""
    k = F.col("n_nationkey")
    name, file = (F.concat(F.lit(x), F.lpad(k.cast("string"), 2, "0")) for x in ("S", "file"))
    n = T(s, d, "nation")
    samples = n.select(name.alias("sample_name"), file.alias("sample_file"))
    paths = n.select(F.when(k % 4 == 0, name).when(k % 4 == 1, F.concat(name, F.lit("_x"))).when(k % 4 == 2, file).alias("path")).filter("path is not null")
    return metadata.resolve_input(samples, paths)


# ---- filters and projections


@query("""WITH rc AS (SELECT cell FROM rna WHERE value <> 0 GROUP BY 1 HAVING count(*) >= 2), rg AS (SELECT gene FROM rna WHERE value <> 0 GROUP BY 1 HAVING count(*) >= 3),
ac AS (SELECT cell FROM atac GROUP BY 1 HAVING sum(CASE WHEN value <> 0 THEN value END) >= 50), ap AS (SELECT peak FROM atac WHERE value <> 0 GROUP BY 1 HAVING count(*) >= 3),
ok AS (SELECT cell FROM rc INTERSECT SELECT cell FROM ac)
SELECT 'rna' AS modality, cell, gene AS feature, value FROM rna WHERE cell IN (SELECT cell FROM ok) AND gene IN (SELECT gene FROM rg)
UNION ALL SELECT 'atac', cell, CAST(peak AS VARCHAR), value FROM atac WHERE cell IN (SELECT cell FROM ok) AND peak IN (SELECT peak FROM ap)""")
def pf1_qc_filter(s, d):
    """AG1, PF1, ST3."""
    r, a = cells.qc_filter(views.rna(s, d), views.atac(s, d), 3, 2, 3, 50)
    return r.select(F.lit("rna").alias("modality"), "cell", F.col("gene").alias("feature"), "value").unionByName(a.select(F.lit("atac").alias("modality"), "cell", F.col("peak").cast("string").alias("feature"), "value"))


@query("SELECT cell, count(*) AS n_features, sum(value) AS total FROM rna WHERE value <> 0 GROUP BY 1")
def ag1_qc_metrics(s, d):
    return cells.qc_metrics(views.rna(s, d), "gene")[0]


@query("SELECT gene, count(*) AS n FROM rna GROUP BY 1 HAVING count(*) > 0.1 * (SELECT count(*) FROM cells)")
def pf2_detection(s, d):
    return cells.detected(views.rna(s, d), "gene", views.cells(s, d).count(), 0.1)


@query("WITH j AS (SELECT * FROM atac JOIN cells USING (cell)) SELECT peak, count(*) AS n FROM j GROUP BY 1 HAVING count(DISTINCT sample_id) = (SELECT count(DISTINCT sample_id) FROM cells) AND count(*) > 0.005 * (SELECT count(*) FROM cells)")
def jn18_common_features(s, d):
    """Features of every sample, by counts over all samples."""
    return cells.detected_in_all(views.atac(s, d), views.cells(s, d), "peak", "sample_id", 0.005)


@query("SELECT p_partkey, g FROM (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '  ' WHEN p_size % 3 = 1 THEN p_brand END AS g FROM part) WHERE trim(coalesce(g, '')) <> ''", base=False)
def pf3_blank_gene(s, d):
    x = T(s, d, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, "  ").when(F.col("p_size") % 3 == 1, F.col("p_brand")).alias("g"))
    return x.filter(F.trim(F.coalesce("g", F.lit(""))) != "")


@query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'Homo sapiens' WHEN 1 THEN 'Mus musculus' END AS organism, 'GSE' || n_nationkey AS accession FROM nation", base=False)
def pf4_organism(s, d):
    k = F.col("n_nationkey")
    name = F.concat(F.lit("GSE"), k.cast("string"), F.when(k % 3 == 0, "_Homo_sapiens").when(k % 3 == 1, "_Mus_musculus").otherwise(""))
    return T(s, d, "nation").select("n_nationkey", names.organism(name).alias("organism"), names.accession(name).alias("accession"))


_CONTEXT = "CASE c_custkey % 8 WHEN 0 THEN '' WHEN 1 THEN ' NA ' WHEN 2 THEN 'unknown' WHEN 3 THEN 'Not Available' WHEN 4 THEN '--' WHEN 5 THEN 'wt' WHEN 6 THEN c_mktsegment END"


@query(f"SELECT c_custkey, lower(trim(coalesce({_CONTEXT}, ''))) IN ('', 'na', 'nan', 'none', 'null', 'unknown', 'notavailable', 'not available', '-', '--') AS missing FROM customer", base=False)
def pf5_missing_context(s, d):
    return T(s, d, "customer").select("c_custkey", names.is_missing(F.expr(_CONTEXT)).alias("missing"))


@query("SELECT p_partkey FROM part WHERE TRY_CAST(CASE WHEN p_size % 4 = 0 THEN 'n/a' ELSE CAST(p_size * 10 AS VARCHAR) END AS DOUBLE) >= 100", base=False)
def pf10_numeric_coercion(s, d):
    x = T(s, d, "part").select(F.col("p_partkey").cast("string").alias("dataset"), F.when(F.col("p_size") % 4 == 0, "n/a").otherwise((F.col("p_size") * 10).cast("string")).alias("unique_tf_gene_pairs"))
    return batch.covered_datasets(x).select(F.col("dataset").cast("long").alias("p_partkey"))


@query("WITH v AS (SELECT gene FROM rna GROUP BY 1 ORDER BY sum(value) DESC, gene LIMIT 5) SELECT DISTINCT peak FROM links JOIN v USING (gene)")
def pf12_hvg_peaks(s, d):
    """Peaks linked to one of the five genes of the highest totals."""
    top = views.rna(s, d).groupBy("gene").agg(F.sum("value").alias("t")).orderBy(F.desc("t"), "gene").limit(5)
    return views.links(s, d).join(top, "gene", "left_semi").select("peak").distinct()


@query("SELECT DISTINCT cell, gene FROM rna WHERE value > 30")
def pf14_positive(s, d):
    return views.rna(s, d).filter("value > 30").select("cell", "gene")


@query("SELECT c_custkey AS sample_id, coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_name END, 'notAvailable') AS sample_name, 'GSE' AS dataset, CASE WHEN c_acctbal >= 0 THEN 'activating' ELSE 'repressive' END AS regulation_direction FROM customer", base=False)
def pj1_projection(s, d):
    """PJ1 to PJ4: rename, literal, condition, null fill."""
    return T(s, d, "customer").select(F.col("c_custkey").alias("sample_id"), F.coalesce(F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")), F.lit(metadata.NOT_AVAILABLE)).alias("sample_name"), F.lit("GSE").alias("dataset"), F.when(F.col("c_acctbal") >= 0, "activating").otherwise("repressive").alias("regulation_direction"))


# ---- joins


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey", base=False)
def jn8_many_to_one(s, d):
    """JN2, JN8: a dimension's columns, each row with its match."""
    c = T(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return guards.many_to_one(T(s, d, "orders").select("o_orderkey", "o_custkey"), c, ["o_custkey"]).select("o_orderkey", "c_name", "c_mktsegment")


@query("SELECT n_nationkey, n_name, upper(n_name) AS file FROM nation", base=False)
def jn1_one_to_one(s, d):
    n = T(s, d, "nation")
    return guards.one_to_one(n.select("n_nationkey", "n_name"), n.select("n_nationkey", F.upper("n_name").alias("file")), ["n_nationkey"])


@query("SELECT peak, gene, tf, motif_pvalue FROM links JOIN hits USING (peak) WHERE tf IN (SELECT gene FROM rna GROUP BY 1 HAVING sum(value) > (SELECT avg(t) FROM (SELECT sum(value) AS t FROM rna GROUP BY gene)))")
def jn3_star_join(s, d):
    """Links, motif hits and eligible TFs."""
    t = views.rna(s, d).groupBy("gene").agg(F.sum("value").alias("t"))
    tfs = t.filter(F.col("t") > t.agg(F.avg("t")).first()[0]).select(F.col("gene").alias("tf"))
    return views.links(s, d).join(views.hits(s, d), "peak").join(tfs, "tf").select("peak", "gene", "tf", "motif_pvalue")


@query("SELECT DISTINCT p_type AS motif_id, p_brand AS tf, l_suppkey AS peak FROM lineitem JOIN part ON l_partkey = p_partkey", base=False)
def jn5_motif_to_tf(s, d):
    """Many hits of a motif, many TFs of a motif."""
    x = T(s, d, "lineitem").join(T(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return x.select(F.col("p_type").alias("motif_id"), F.col("p_brand").alias("tf"), F.col("l_suppkey").alias("peak")).distinct()


@query("SELECT cell FROM cells WHERE cell IN (SELECT cell FROM rna)")
def jn9_semi_join(s, d):
    return views.cells(s, d).join(views.rna(s, d), "cell", "left_semi").select("cell")


@query("SELECT cell FROM cells WHERE cell NOT IN (SELECT cell FROM rna)")
def jn10_anti_join(s, d):
    return views.cells(s, d).join(views.rna(s, d), "cell", "left_anti").select("cell")


@query("SELECT a.chrom, a.\"start\", a.\"end\", g.gene, g.lo AS b_start, g.hi AS b_end FROM (SELECT DISTINCT * FROM peaks) a JOIN (SELECT gene, chrom, greatest(CASE WHEN strand = '+' THEN tss - 100 ELSE tss - 10 END, 0) AS lo, CASE WHEN strand = '+' THEN tss + 10 ELSE tss + 100 END AS hi FROM genes) g ON a.chrom = g.chrom AND a.\"start\" < g.hi AND g.lo < a.\"end\"")
def jn12_promoter_overlap(s, d):
    """FN8, JN11, JN12: overlaps by shared bins."""
    lo, hi = scores.promoter(F.col("tss"), F.col("strand"), 100, 10)
    return intervals.overlap_join(views.peaks(s, d).distinct(), views.genes(s, d).select("gene", "chrom", lo.alias("start"), hi.alias("end")), 64)


_BODY = "(SELECT gene, chrom, CASE WHEN strand = '+' THEN tss ELSE greatest(tss - (gene % 20 + 1), 0) END AS lo, CASE WHEN strand = '+' THEN tss + gene % 20 + 1 ELSE tss + 1 END AS hi FROM genes)"


@query(f"SELECT a.chrom, a.\"start\", a.\"end\", g.gene, g.lo AS b_start, g.hi AS b_end FROM (SELECT DISTINCT * FROM peaks) a JOIN {_BODY} g ON a.chrom = g.chrom AND a.\"start\" < g.hi AND g.lo < a.\"end\"")
def jn13_body_overlap(s, d):
    return intervals.overlap_join(views.peaks(s, d).distinct(), views.bodies(s, d), 64)


_DIST = "CASE WHEN a.\"start\" > tss THEN a.\"start\" - tss WHEN a.\"end\" < tss THEN a.\"end\" - tss ELSE 0 END"


@query(f"SELECT chrom, \"start\", \"end\", gene, tss, distance FROM (SELECT a.*, gene, tss, {_DIST} AS distance, row_number() OVER (PARTITION BY a.chrom, a.\"start\", a.\"end\" ORDER BY abs({_DIST}), tss, gene) AS n FROM (SELECT DISTINCT * FROM peaks) a JOIN genes g ON a.chrom = g.chrom AND abs({_DIST}) <= 40) WHERE n = 1")
def jn14_nearest(s, d):
    """FN7, JN14: the nearest start site within 40."""
    return intervals.nearest_join(views.peaks(s, d).distinct(), views.genes(s, d), 40)


@query(f"""WITH p AS (SELECT DISTINCT * FROM peaks), w AS (SELECT gene, chrom, tss, greatest(CASE WHEN strand = '+' THEN tss - 100 ELSE tss - 10 END, 0) AS lo, CASE WHEN strand = '+' THEN tss + 10 ELSE tss + 100 END AS hi FROM genes),
pr AS (SELECT a.*, gene, 0 AS distance FROM p a JOIN w ON a.chrom = w.chrom AND a."start" < hi AND lo < a."end"),
nr AS (SELECT a.*, gene, {_DIST} AS distance, row_number() OVER (PARTITION BY a.chrom, a."start", a."end" ORDER BY abs({_DIST}), tss, gene) AS n FROM p a JOIN genes g ON a.chrom = g.chrom AND abs({_DIST}) <= 40),
b AS (SELECT a.*, gene FROM p a JOIN {_BODY} g ON a.chrom = g.chrom AND a."start" < g.hi AND g.lo < a."end"),
u AS (SELECT chrom, "start", "end", gene, distance, 'promoter' AS peak_type, 0 AS o FROM pr UNION ALL SELECT chrom, "start", "end", gene, distance, 'distal', 1 FROM nr WHERE n = 1 UNION ALL SELECT chrom, "start", "end", gene, 0, 'distal', 2 FROM b)
SELECT chrom, "start", "end", gene, distance, peak_type FROM (SELECT *, row_number() OVER (PARTITION BY chrom, "start", "end", gene ORDER BY o, abs(distance)) AS n FROM u) WHERE o = 0 OR n = 1""")
def jn15_annotate(s, d):
    """Promoters at distance 0, then the nearest start site, then bodies as distal at 0."""
    return intervals.annotate(views.peaks(s, d), views.genes(s, d), views.bodies(s, d), 100, 10, 40, 64)


_TRIP = "(SELECT tf, peak, gene FROM hits JOIN links USING (peak) WHERE motif_pvalue < 0.01)"
_JOINT = f"""WITH t AS (SELECT DISTINCT * FROM {_TRIP}), g AS (SELECT project_id, sample_id, gpt_cell_type, count(*) AS group_total_cells FROM cells GROUP BY ALL),
c AS (SELECT t.tf, t.peak, t.gene, project_id, sample_id, gpt_cell_type, count(*) AS n FROM t JOIN atac a ON a.peak = t.peak AND a.value > 0 JOIN rna f ON f.gene = t.tf AND f.cell = a.cell AND f.value > 0 JOIN rna r ON r.gene = t.gene AND r.cell = a.cell AND r.value > 0 JOIN cells ON cells.cell = a.cell GROUP BY ALL),
j AS (SELECT tf, peak, gene, project_id, sample_id, gpt_cell_type, group_total_cells, n AS active_cell_count, n / group_total_cells AS active_cell_fraction FROM c JOIN g USING (project_id, sample_id, gpt_cell_type))
"""


def _joint(s, d):
    trip = views.hits(s, d).filter("motif_pvalue < 0.01").join(views.links(s, d), "peak")
    return activity.joint_counts(trip, views.rna(s, d), views.atac(s, d), views.cells(s, d))


@query(_JOINT + "SELECT tf, peak, gene, project_id, sample_id, gpt_cell_type, group_total_cells, active_cell_count, round(active_cell_fraction, 6) AS active_cell_fraction FROM j")
def jn17_joint_detection(s, d):
    """JN16, JN17, ML15: cells with TF, gene and peak, by triplet and group."""
    return _joint(s, d).withColumns(r6("active_cell_fraction"))


_POOL = """, w AS (SELECT 'ds' AS dataset, * FROM j), q AS (SELECT dataset, tf, peak, gene, gpt_cell_type, CAST(sum(active_cell_count) AS BIGINT) AS dataset_active_cell_count, CAST(sum(group_total_cells) AS BIGINT) AS dataset_group_total_cells, sum(active_cell_count) / nullif(sum(group_total_cells), 0) AS dataset_active_cell_fraction FROM w GROUP BY ALL HAVING dataset_active_cell_fraction > 0.001 AND dataset_active_cell_count > 2)
"""


@query(_JOINT + _POOL + "SELECT dataset, tf, peak, gene, project_id, sample_id, gpt_cell_type, active_cell_count, dataset_active_cell_count, dataset_group_total_cells, round(dataset_active_cell_fraction, 6) AS dataset_active_cell_fraction FROM w JOIN q USING (dataset, tf, peak, gene, gpt_cell_type)")
def jn7_dataset_filter(s, d):
    """AG9, JN7: pooled ratio of sums above both thresholds."""
    out = activity.dataset_filter(_joint(s, d).withColumn("dataset", F.lit("ds")), 0.001, 2)
    return out.withColumns(r6("dataset_active_cell_fraction")).drop("group_total_cells", "active_cell_fraction")


@query(_JOINT + _POOL + """, k AS (SELECT w.* FROM w JOIN q USING (dataset, tf, peak, gene, gpt_cell_type))
SELECT a.n AS source_rows, a.k AS source_keys, b.n AS kept_rows, b.k AS kept_keys, round(b.n / a.n, 6) AS kept_rows_fraction, round(b.k / a.k, 6) AS kept_keys_fraction FROM (SELECT count(*) AS n, count(DISTINCT (dataset, tf, peak, gene, gpt_cell_type)) AS k FROM w) a, (SELECT count(*) AS n, count(DISTINCT (dataset, tf, peak, gene, gpt_cell_type)) AS k FROM k) b""")
def ag10_filter_summary(s, d):
    """AG10, AG13."""
    w = _joint(s, d).withColumn("dataset", F.lit("ds"))
    return activity.filter_summary(w, 0.001, 2).withColumns(r6("kept_rows_fraction", "kept_keys_fraction"))


@query("""WITH w AS (SELECT DISTINCT CASE WHEN c_custkey % 2 = 0 THEN 'chr' ELSE '' END || (c_custkey * 7 % 40) AS chrom FROM customer),
k AS (SELECT DISTINCT CASE WHEN s_suppkey % 3 = 0 THEN 'chr' ELSE '' END || (s_suppkey * 11 % 31) AS contig FROM supplier)
SELECT chrom, coalesce(e.contig, o.contig) AS contig FROM w LEFT JOIN k e ON e.contig = chrom LEFT JOIN k o ON o.contig = CASE WHEN chrom LIKE 'chr%' THEN chrom[4:] ELSE 'chr' || chrom END""", base=False)
def jn19_contigs(s, d):
    """Names that customers ask for, among contigs that suppliers have."""
    name = lambda key, every, times, of: F.concat(F.when(F.col(key) % every == 0, "chr").otherwise(""), (F.col(key) * times % of).cast("string"))
    wanted = T(s, d, "customer").select(name("c_custkey", 2, 7, 40).alias("chrom"))
    return intervals.resolve_contigs(wanted, T(s, d, "supplier").select(name("s_suppkey", 3, 11, 31).alias("contig")))


@query("SELECT cell, cell IN (SELECT cell FROM rna WHERE value > 40) AS selected FROM cells")
def jn20_mark_join(s, d):
    on = views.rna(s, d).filter("value > 40").select("cell").distinct().withColumn("m", F.lit(True))
    return views.cells(s, d).join(on, "cell", "left").select("cell", F.col("m").isNotNull().alias("selected"))


@query("SELECT cell, CASE WHEN n IS NULL THEN 'none' ELSE 'g' || n % 3 END AS label FROM cells LEFT JOIN (SELECT cell, count(*) AS n FROM rna GROUP BY 1) USING (cell)")
def jn21_label_write_back(s, d):
    n = views.rna(s, d).groupBy("cell").agg(F.count("*").alias("n"))
    return views.cells(s, d).join(n, "cell", "left").select("cell", F.when(F.col("n").isNull(), "none").otherwise(F.concat(F.lit("g"), (F.col("n") % 3).cast("string"))).alias("label"))


# ---- aggregates

_GROUPS = "g AS (SELECT project_id, sample_id, gpt_cell_type, count(*) AS n_cells FROM cells GROUP BY ALL HAVING count(*) >= 10)"
_MEANS = _GROUPS + """, ng AS (SELECT count(*) AS n FROM g),
mr AS (SELECT project_id, sample_id, gpt_cell_type, gene, sum(value) / any_value(n_cells) AS value FROM rna JOIN cells USING (cell) JOIN g USING (project_id, sample_id, gpt_cell_type) GROUP BY 1, 2, 3, 4),
ma AS (SELECT project_id, sample_id, gpt_cell_type, peak, sum(value) / any_value(n_cells) AS value FROM atac JOIN cells USING (cell) JOIN g USING (project_id, sample_id, gpt_cell_type) GROUP BY 1, 2, 3, 4)"""


@query(f"WITH {_MEANS} SELECT project_id || chr(31) || sample_id || chr(31) || gpt_cell_type || chr(31) || '0' AS group_id, gene, round(value, 6) AS value FROM mr WHERE value <> 0")
def ag2_pseudobulk_means(s, d):
    """AG2, AG11: means over all cells of groups with ten or more."""
    c = views.cells(s, d)
    return pseudobulk.group_means(views.rna(s, d), pseudobulk.assign(c, pseudobulk.groups_of(c, 10)), "gene").withColumns(r6("value"))


@query(f"WITH {_MEANS} SELECT gene, round(sum(value) / any_value(n), 6) AS pseudobulk_expression_mean, round(max(value), 6) AS pseudobulk_expression_max FROM mr, ng GROUP BY 1")
def ag3_tf_summary(s, d):
    c = views.cells(s, d)
    g = pseudobulk.groups_of(c, 10)
    m = pseudobulk.group_means(views.rna(s, d), pseudobulk.assign(c, g), "gene")
    return pseudobulk.feature_summary(m, "gene", g.count()).withColumns(r6("pseudobulk_expression_mean", "pseudobulk_expression_max"))


@query(f"WITH {_MEANS} SELECT gene AS tf FROM mr, ng GROUP BY 1 HAVING sum(value) / any_value(n) > 2.0 AND max(value) > 4.0")
def pf8_tf_gate(s, d):
    c = views.cells(s, d)
    g = pseudobulk.groups_of(c, 10)
    m = pseudobulk.group_means(views.rna(s, d), pseudobulk.assign(c, g), "gene")
    return regulatory.eligible_tfs(m, g.count(), 2.0, 4.0).select("tf")


_FIELDS = ["project_id", "sample_id", "gpt_cell_type", "o_orderstatus", "o_orderpriority"]


@query("""WITH x AS (UNPIVOT (SELECT cell, project_id, sample_id, gpt_cell_type, o_orderstatus, o_orderpriority FROM cells) ON project_id, sample_id, gpt_cell_type, o_orderstatus, o_orderpriority INTO NAME context_name VALUE context_value),
n AS (SELECT context_name, context_value, count(*) AS n_cells FROM x GROUP BY ALL)
SELECT context_name, context_value, gene, round(sum(value) / any_value(n_cells), 6) AS mean_value, any_value(n_cells) AS n_cells, count(*) AS nnz FROM rna JOIN x USING (cell) JOIN n USING (context_name, context_value) GROUP BY 1, 2, 3""")
def ag4_context_means(s, d):
    return pseudobulk.context_means(views.rna(s, d), views.cells(s, d), "gene", _FIELDS).withColumns(r6("mean_value"))


@query("SELECT cell, upper(left(gene, 7)) AS gene, sum(value) AS value FROM rna GROUP BY 1, 2")
def ag5_collapse(s, d):
    """AG5, AG6: features that share a new name are summed."""
    return cells.collapse(views.rna(s, d), "gene", F.upper(F.substring("gene", 1, 7)))


@query("""WITH p AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM peaks),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR "start" > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS island FROM p)
SELECT chrom, min("start") AS "start", max("end") AS "end" FROM i GROUP BY chrom, island""")
def ag7_interval_merge(s, d):
    return intervals.merge(views.peaks(s, d), 0)


@query("""WITH p AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM peaks),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR "start" > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS island FROM p),
m AS (SELECT chrom, min("start") AS lo, max("end") AS hi FROM i GROUP BY chrom, island), q AS (SELECT DISTINCT * FROM peaks)
SELECT q.chrom, q."start", q."end", lo AS b_start, hi AS b_end, q."end" - q."start" AS overlap FROM q JOIN m ON q.chrom = m.chrom AND q."start" < hi AND lo < q."end\"""")
def wn6_best_overlap(s, d):
    """WN6, JN11: each original in the merged interval it overlaps most, which holds it whole."""
    p = views.peaks(s, d).distinct().withColumn("key", F.concat_ws(":", "chrom", "start", "end"))
    return intervals.best_overlap(p, intervals.merge(views.peaks(s, d), 0), "key", 64).drop("key")


@query("WITH t AS (SELECT cell, sum(value) AS total FROM rna GROUP BY 1) SELECT cell, gene, round(ln(1 + value * (SELECT median(total) FROM t) / total), 6) AS value FROM rna JOIN t USING (cell)")
def ag14_normalize(s, d):
    return cells.normalize(views.rna(s, d)).withColumns(r6("value"))


_PWM = "SELECT p_brand AS motif_id, p_size AS pos, CAST(p_partkey % 7 AS DOUBLE) AS a, CAST(p_partkey % 5 AS DOUBLE) AS c, CAST(p_partkey % 3 AS DOUBLE) AS g, CAST(p_partkey % 2 AS DOUBLE) AS t FROM part WHERE p_partkey % 210 <> 0"


def _pwm(s, d):
    k = lambda n: (F.col("p_partkey") % n).cast("double")
    return T(s, d, "part").filter("p_partkey % 210 <> 0").select(F.col("p_brand").alias("motif_id"), F.col("p_size").alias("pos"), k(7).alias("A"), k(5).alias("C"), k(3).alias("G"), k(2).alias("T"))


@query(f"SELECT motif_id, round(sum(h), 6) AS information_content, count(*) AS width FROM (SELECT motif_id, list_sum(list_transform([a, c, g, t], lambda x: CASE WHEN x > 0 THEN x / (a + c + g + t) * log2(x / (a + c + g + t) / 0.25) ELSE 0 END)) AS h FROM ({_PWM})) GROUP BY 1", base=False)
def ag16_information_content(s, d):
    """AG16, AG17, PF13."""
    return motif.information_content(motif.valid_matrices(_pwm(s, d))).withColumns(r6("information_content"))


# ---- ranks

_RANKED = "rank() OVER (PARTITION BY {f} ORDER BY CAST(value AS FLOAT)) + (count(*) OVER (PARTITION BY {f}, CAST(value AS FLOAT)) - 1) / 2.0"
_DENSE = _MEANS + """, dr AS (SELECT gene, project_id, sample_id, gpt_cell_type, coalesce(value, 0) AS value FROM (SELECT DISTINCT gene FROM mr) CROSS JOIN g LEFT JOIN mr USING (gene, project_id, sample_id, gpt_cell_type)),
da AS (SELECT peak, project_id, sample_id, gpt_cell_type, coalesce(value, 0) AS value FROM (SELECT DISTINCT peak FROM ma) CROSS JOIN g LEFT JOIN ma USING (peak, project_id, sample_id, gpt_cell_type)),
kr AS (SELECT *, """ + _RANKED.format(f="gene") + " AS k FROM dr), ka AS (SELECT *, " + _RANKED.format(f="peak") + """ AS k FROM da),
rho AS (SELECT peak, gene, CASE WHEN stddev_pop(ka.k) > 1e-9 AND stddev_pop(kr.k) > 1e-9 THEN corr(ka.k, kr.k) END AS rho FROM links JOIN ka USING (peak) JOIN kr USING (gene, project_id, sample_id, gpt_cell_type) GROUP BY 1, 2)"""
_TAIL = """, tp AS (SELECT *, rho * sqrt((n - 2) / (1 - rho * rho)) AS t, n - 2 AS v FROM rho, ng),
th AS (SELECT *, v / (v + t * t) AS c2, abs(t) / sqrt(v + t * t) AS sn FROM tp),
pv AS (SELECT peak, gene, rho, n, CASE WHEN v % 2 = 0 THEN 1 - sn * list_sum(list_transform(range(0, CAST(v / 2 AS BIGINT)), lambda k: exp(lgamma(2 * k + 1) - 2 * k * ln(2) - 2 * lgamma(k + 1)) * c2 ** k))
  ELSE 1 - 2 / pi() * (asin(sn) + sn * sqrt(c2) * list_sum(list_transform(range(0, CAST((v - 1) / 2 AS BIGINT)), lambda k: exp(2 * k * ln(2) + 2 * lgamma(k + 1) - lgamma(2 * k + 2)) * c2 ** k))) END AS pvalue FROM th)"""


@query(f"WITH {_DENSE} SELECT peak, gene, round(rho, 6) AS rho FROM rho")
def wn2_spearman(s, d):
    """WN1, WN2: sparse ranks against dense ones in SQL."""
    c = views.cells(s, d)
    g = pseudobulk.groups_of(c, 10)
    a = pseudobulk.assign(c, g)
    out = ranks.spearman(views.links(s, d), pseudobulk.group_means(views.atac(s, d), a, "peak"), pseudobulk.group_means(views.rna(s, d), a, "gene"), "peak", "gene", g.count())
    return out.withColumns(r6("rho"))


@query(f"""WITH {_DENSE}{_TAIL}, bh AS (SELECT *, pvalue * count(pvalue) OVER () / row_number() OVER (ORDER BY pvalue, peak, gene) AS x FROM pv)
SELECT peak, gene, round(rho, 6) AS spearman, round(pvalue, 6) AS pvalue, round(least(1, min(x) OVER (ORDER BY pvalue, peak, gene ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 5) AS qvalue_bh, n AS n_pseudobulks, 'biological' AS pseudobulk_mode FROM bh""")
def ml14_peak_gene_links(s, d):
    """ML14, WN3, WN4, WN11, AG2: links with p- and q-values."""
    out = regulatory.peak_gene_links(views.rna(s, d), views.atac(s, d), views.cells(s, d), views.links(s, d))
    return out.withColumns(r6("spearman", "pvalue") | {"qvalue_bh": F.round("qvalue_bh", 5)})


@query("SELECT o_orderpriority AS g, o_orderkey, round(least(1, min(x) OVER (PARTITION BY o_orderpriority ORDER BY p, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS q FROM (SELECT *, p * count(*) OVER (PARTITION BY o_orderpriority) / row_number() OVER (PARTITION BY o_orderpriority ORDER BY p, o_orderkey) AS x FROM (SELECT *, ((o_orderkey * 2654435761) % 1000003 + 1) / 1000004.0 AS p FROM orders))", base=False)
def wn4_benjamini_hochberg(s, d):
    x = T(s, d, "orders").select(F.col("o_orderpriority").alias("g"), "o_orderkey", (((F.col("o_orderkey") * 2654435761) % 1000003 + 1) / 1000004.0).alias("p"))
    return ranks.benjamini_hochberg(x, "p", "q", ("g",)).drop("p").withColumns(r6("q"))


@query("SELECT tf, peak, motif_pvalue FROM (SELECT p_brand AS tf, l_suppkey AS peak, l_tax AS motif_pvalue, row_number() OVER (PARTITION BY p_brand, l_suppkey ORDER BY l_tax) AS n FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE n = 1", base=False)
def wn5_best_motif(s, d):
    x = T(s, d, "lineitem").join(T(s, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("tf"), F.col("l_suppkey").alias("peak"), F.col("l_tax").alias("motif_pvalue"))
    return regulatory.best_motifs(x)


def _markers(s, d):
    return T(s, d, "part").select(F.col("p_type").alias("group"), F.col("p_name").alias("names"), F.col("p_retailprice").alias("scores"), F.col("p_size").cast("double").alias("logfoldchanges"), (F.col("p_partkey") % 100 / 100.0).alias("pvals_adj"), "p_partkey")


@query("SELECT p_type AS \"group\", p_partkey, CAST(n AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_size DESC, p_name) AS n FROM part) WHERE n <= 3", base=False)
def wn7_top_markers(s, d):
    return cells.top_markers(_markers(s, d), 3).select("group", "p_partkey", "rank")


@query("""WITH c AS (SELECT DISTINCT p_brand AS tf, p_type AS motif_id, CASE WHEN p_size % 3 = 0 THEN 'D' WHEN p_size % 3 = 1 THEN 'I' ELSE 'N' END AS status, CASE p_size % 4 WHEN 0 THEN 'ChIP-seq' WHEN 1 THEN 'SELEX' WHEN 2 THEN 'PBM' ELSE 'unheard' END AS source FROM part),
i AS (SELECT p_type AS motif_id, round(sum(p_size), 0) AS information_content FROM part GROUP BY 1),
x AS (SELECT *, CASE status WHEN 'D' THEN 0 WHEN 'I' THEN 1 ELSE 2 END AS tier, CASE source WHEN 'ChIP-seq' THEN 1 WHEN 'SELEX' THEN 2 WHEN 'PBM' THEN 3 ELSE 9 END AS source_priority FROM c JOIN i USING (motif_id)),
b AS (SELECT *, min(tier) OVER (PARTITION BY tf) AS best FROM x),
u AS (SELECT *, row_number() OVER (PARTITION BY tf, motif_id ORDER BY source_priority, information_content DESC, source, status) AS dd FROM b WHERE tier = best)
SELECT tf, motif_id, source, source_priority, information_content, CAST(n AS INTEGER) AS selected_rank, CASE tier WHEN 0 THEN 'direct' ELSE 'inferred' END AS evidence_tier FROM (SELECT *, row_number() OVER (PARTITION BY tf ORDER BY source_priority, information_content DESC, motif_id) AS n FROM u WHERE dd = 1) WHERE n <= 4""", base=False)
def wn8_matrix_choice(s, d):
    """WN8, FN10."""
    p, z = T(s, d, "part"), F.col("p_size")
    c = p.select(F.col("p_brand").alias("tf"), F.col("p_type").alias("motif_id"), F.when(z % 3 == 0, "D").when(z % 3 == 1, "I").otherwise("N").alias("status"), F.when(z % 4 == 0, "ChIP-seq").when(z % 4 == 1, "SELEX").when(z % 4 == 2, "PBM").otherwise("unheard").alias("source")).distinct()
    i = p.groupBy(F.col("p_type").alias("motif_id")).agg(F.round(F.sum("p_size").cast("double"), 0).alias("information_content"))
    return motif.select_matrices(c, i, 4)


@query(f"WITH {_DENSE} SELECT gene, project_id || chr(31) || sample_id || chr(31) || gpt_cell_type || chr(31) || '0' AS group_id, round(k / n, 6) AS percentile FROM kr, ng WHERE value > 0")
def wn9_percentiles(s, d):
    c = views.cells(s, d)
    g = pseudobulk.groups_of(c, 10)
    m = pseudobulk.group_means(views.rna(s, d), pseudobulk.assign(c, g), "gene")
    return ranks.percentiles(m, "gene", g.count()).drop("value").withColumns(r6("percentile"))


@query("SELECT l_orderkey, l_linenumber, 'peak_' || lpad(CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) AS VARCHAR), 9, '0') AS id FROM lineitem", base=False)
def wn10_sequential_id(s, d):
    x = T(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return order.numbered(x, ["l_orderkey", "l_linenumber", "l_partkey"]).select("l_orderkey", "l_linenumber", F.format_string("peak_%09d", "n").alias("id"))


@query("""WITH t AS (SELECT count(*) AS n FROM cells), s AS (SELECT gpt_cell_type, count(*) AS n1 FROM cells GROUP BY 1),
f AS (SELECT gene, cell, gpt_cell_type, coalesce(value, 0) / 10 AS value FROM (SELECT DISTINCT gene FROM rna) CROSS JOIN cells LEFT JOIN rna USING (gene, cell)),
k AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY value) + (count(*) OVER (PARTITION BY gene, value) - 1) / 2.0 AS r FROM f),
a AS (SELECT gene, gpt_cell_type, sum(r) AS w, sum(exp(value) - 1) AS e FROM k GROUP BY 1, 2), z AS (SELECT gene, sum(e) AS e FROM a GROUP BY 1)
SELECT gpt_cell_type AS "group", a.gene AS names, round((w - n1 * (n + 1) / 2) / sqrt(n1 * (n - n1) * (n + 1) / 12.0), 6) AS scores, round(log2((a.e / n1 + 1e-9) / ((z.e - a.e) / (n - n1) + 1e-9)), 6) AS logfoldchanges FROM a JOIN z USING (gene) JOIN s USING (gpt_cell_type), t""")
def wn12_rank_sum_markers(s, d):
    """Each cell type against the rest; zeros are never stored."""
    r = views.rna(s, d).withColumn("value", F.col("value") / 10)
    out = ranks.rank_sum_markers(r, views.cells(s, d), "gene", "gpt_cell_type")
    return out.select("group", "names", F.round("scores", 6).alias("scores"), F.round("logfoldchanges", 6).alias("logfoldchanges"))


# ---- order, samples, sets


@query("SELECT chrom, \"start\", \"end\" FROM peaks ORDER BY ALL")
def so1_sorted(s, d):
    return views.peaks(s, d).orderBy("chrom", "start", "end")


_ALLOC = """WITH z AS (SELECT sample_id, gpt_cell_type, count(*) AS size FROM cells GROUP BY ALL), y AS (SELECT *, sum(size) OVER () AS total, least(size, 10) AS b0, sum(least(size, 10)) OVER () AS sb FROM z),
x AS (SELECT *, size - b0 AS room FROM y), w AS (SELECT *, sum(room) OVER () AS rooms, 5000 - sb AS lft FROM x), v AS (SELECT *, b0 + CAST(floor(room / rooms * lft) AS BIGINT) AS part FROM w), u AS (SELECT *, 5000 - sum(part) OVER () AS rest FROM v),
q AS (SELECT *, size - part AS capacity, coalesce(sum(size - part) OVER (ORDER BY size - part DESC, sample_id, gpt_cell_type ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS larger FROM u)
SELECT sample_id, gpt_cell_type, size, CASE WHEN total <= 5000 THEN size ELSE CAST(part + greatest(0, least(capacity, rest - larger)) AS BIGINT) END AS allocated FROM q"""


@query(_ALLOC)
def sm1_allocation(s, d):
    z = views.cells(s, d).groupBy("sample_id", "gpt_cell_type").agg(F.count("*").alias("size"))
    return sampling.allocation(z, 5000, 10, ["sample_id", "gpt_cell_type"])


@query(f"WITH al AS ({_ALLOC}), r AS (SELECT cell, sample_id, gpt_cell_type, row_number() OVER (PARTITION BY sample_id, gpt_cell_type ORDER BY (cell * 2654435761) % 1000003, cell) AS n FROM cells) SELECT cell, n <= allocated AS selected FROM r JOIN al USING (sample_id, gpt_cell_type)")
def sm1_stratified_sample(s, d):
    """SM1, JN20: with an order that SQL has too."""
    order = [(F.col("cell") * 2654435761) % 1000003, F.col("cell")]
    return sampling.stratified(views.cells(s, d), 5000, 10, ["sample_id", "gpt_cell_type"], order=order, share=order[0] / 1000003).select("cell", "selected")


@query()
def sm2_pseudo_replicates(s, d):
    """All cells as two groups, split in parts: part sizes."""
    pair = F.when(F.col("cell") % 2 == 0, "even").otherwise("odd")
    c = views.cells(s, d).withColumns({"project_id": F.lit("all"), "sample_id": pair, "gpt_cell_type": F.lit("all")})
    g = pseudobulk.replicate_parts(pseudobulk.groups_of(c, 10))
    return pseudobulk.assign(c, g).groupBy("sample_id", "part").agg(F.count("*").alias("n"))


@query("SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier", base=False)
def st1_union_all(s, d):
    return T(s, d, "customer").select(F.col("c_nationkey").alias("k")).unionByName(T(s, d, "supplier").select(F.col("s_nationkey").alias("k")))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier", base=False)
def st2_union_distinct(s, d):
    return st1_union_all(s, d).distinct()


@query("SELECT cell FROM rna INTERSECT SELECT cell FROM atac")
def st3_intersect(s, d):
    return cells.common_cells(views.rna(s, d), views.atac(s, d))


@query("WITH a AS (SELECT DISTINCT cell FROM rna WHERE value > 45), b AS (SELECT DISTINCT cell FROM atac WHERE value > 48) SELECT cell, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT cell, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def st4_set_difference(s, d):
    return guards.set_difference(views.rna(s, d).filter("value > 45"), views.atac(s, d).filter("value > 48"), "cell")


# ---- functions


@query("SELECT chrom || ':' || \"start\" || '-' || \"end\" AS name, chrom, \"start\", \"end\" FROM (SELECT DISTINCT * FROM peaks) UNION ALL SELECT 'bad_' || n_nationkey, NULL, NULL, NULL FROM nation")
def fn1_parse_peak(s, d):
    n = views.peaks(s, d).distinct().select(F.concat("chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string")).alias("name")).unionAll(T(s, d, "nation").select(F.concat(F.lit("bad_"), F.col("n_nationkey").cast("string"))))
    return n.withColumn("p", names.parse_peak(F.col("name"))).select("name", "p.*")


@query("""WITH n AS (SELECT c_custkey, ['', 'chr', 'CHR', 'Chr'][c_custkey % 4 + 1] || CASE WHEN c_custkey % 13 < 5 THEN ['x', 'Y', 'mt', 'M', 'GL000.1'][c_custkey % 13 + 1] WHEN c_custkey % 13 = 5 THEN '2L' ELSE CAST(c_custkey % 23 AS VARCHAR) END AS name FROM customer)
SELECT c_custkey, name, CASE WHEN b IN ('M', 'MT') THEN 'chrM' WHEN regexp_full_match(b, '[0-9]+|X|Y') THEN 'chr' || b ELSE name END AS chrom FROM (SELECT *, upper(regexp_replace(name, '^[cC][hH][rR]', '')) AS b FROM n)""", base=False)
def fn2_normalize_chrom(s, d):
    """Names of every kind, one a customer."""
    k, pick = F.col("c_custkey"), lambda names_, n: F.element_at(F.array(*map(F.lit, names_)), (n + 1).cast("int"))
    body = F.when(k % 13 < 5, pick(("x", "Y", "mt", "M", "GL000.1"), F.least(k % 13, F.lit(4)))).when(k % 13 == 5, "2L").otherwise((k % 23).cast("string"))
    x = T(s, d, "customer").select("c_custkey", F.concat(pick(("", "chr", "CHR", "Chr"), k % 4), body).alias("name"))
    return x.withColumn("chrom", names.normalize_chrom(F.col("name")))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || '#' || c_name ELSE c_mktsegment || '#' || c_name END AS cell, c_mktsegment AS sample FROM customer", base=False)
def fn3_cell_prefix(s, d):
    cell = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_mktsegment", F.lit("#"), "c_name")).otherwise(F.col("c_name"))
    x = T(s, d, "customer").select("c_custkey", names.prefixed_cell(cell, F.col("c_mktsegment")).alias("cell"))
    return x.withColumn("sample", names.sample_of(F.col("cell")))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(cbrt(l_quantity / 50 * l_tax * l_discount), 6) AS active, round(CASE WHEN (l_tax - 0.04) * l_discount >= 0 THEN cbrt(l_quantity / 50 * l_tax * l_discount) * sqrt((l_tax - 0.04) * l_discount) END, 6) AS weighted FROM lineitem", base=False)
def fn4_scores(s, d):
    """FN4 to FN6."""
    a = scores.active_score(F.col("l_quantity") / 50, F.col("l_tax"), F.col("l_discount"))
    return T(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(a, 6).alias("active"), F.round(scores.weighted_score(a, F.col("l_tax") - 0.04, F.col("l_discount")), 6).alias("weighted"))


@query("SELECT event_id, regexp_matches(props, '^CL:\\d{7}$') AS cl, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events", base=False)
def fn13_json_fields(s, d):
    """FN11, FN13: JSON fields and full matches."""
    return T(s, d, "events").select("event_id", F.col("props").rlike(r"^CL:\d{7}$").alias("cl"), F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'G' || c_custkey ELSE 'H' || c_custkey END AS id FROM customer", base=False)
def fn15_fasta_header(s, d):
    k = F.col("c_custkey")
    h = F.when(k % 2 == 0, F.concat(F.lit(">G"), k.cast("string"), F.lit("::chr1:5-9"))).otherwise(F.concat(F.lit(">H"), k.cast("string"), F.lit(" text")))
    return T(s, d, "customer").select("c_custkey", names.fasta_id(h).alias("id"))


@query("SELECT o_orderkey, greatest(1, least(48, CASE WHEN o_totalprice <= 10000 THEN 48 WHEN o_totalprice <= 25000 THEN 32 WHEN o_totalprice <= 50000 THEN 24 WHEN o_totalprice <= 100000 THEN 12 ELSE 8 END, CAST(floor((o_orderkey % 60000) / 2 / 512) AS INTEGER))) AS jobs FROM orders", base=False)
def ctl1_job_limit(s, d):
    return T(s, d, "orders").select("o_orderkey", scores.job_limit(F.col("o_totalprice"), F.lit(48), F.col("o_orderkey") % 60000).alias("jobs"))


@query("SELECT p_type AS \"group\", string_agg(p_name, '|' ORDER BY n) AS names FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_size DESC, p_name) AS n FROM part) WHERE n <= 5 GROUP BY 1", base=False)
def fn12_marker_payload(s, d):
    """FN12: names by cluster, read back from the JSON payload."""
    meta = T(s, d, "region").select(F.col("r_name").alias("sample_name"))
    p = metadata.marker_payload(_markers(s, d), meta, "ds", 5)
    x = p.select(F.explode(F.from_json("payload", "clusters map<string, array<struct<names: string>>>")["clusters"]).alias("group", "m"))
    return x.select("group", F.array_join("m.names", "|").alias("names"))


# ---- regulatory chain, embedding, motif scan


def _links(s, d, means=None):
    return regulatory.peak_gene_links(views.rna(s, d), views.atac(s, d), views.cells(s, d), views.links(s, d), LOOSE, means=means)


def _means(s, d):
    return regulatory.means_of(views.rna(s, d), views.atac(s, d), views.cells(s, d), LOOSE)


_LINKS_SQL = _DENSE + _TAIL + """, bh AS (SELECT *, pvalue * count(pvalue) OVER () / row_number() OVER (ORDER BY pvalue, peak, gene) AS x FROM pv),
lk AS (SELECT peak, gene, rho AS spearman, least(1, min(x) OVER (ORDER BY pvalue, peak, gene ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS qvalue_bh FROM bh)"""
_TRIPLETS_SQL = _LINKS_SQL + """, sl AS (SELECT * FROM lk WHERE qvalue_bh < 0.9 AND spearman > 0.02),
tfs AS (SELECT gene AS tf FROM mr, ng GROUP BY 1 HAVING sum(value) / any_value(n) > 0.1 AND max(value) > 0.2),
cand AS (SELECT peak, gene, tf, spearman, qvalue_bh, motif_pvalue FROM sl JOIN hits USING (peak) JOIN tfs USING (tf) WHERE motif_pvalue < 0.01),
tg AS (SELECT x.gene AS tf, y.gene AS gene, CASE WHEN stddev_pop(x.k) > 1e-9 AND stddev_pop(y.k) > 1e-9 THEN corr(x.k, y.k) END AS tf_gene_spearman FROM kr x JOIN kr y USING (project_id, sample_id, gpt_cell_type) GROUP BY 1, 2),
tr AS (SELECT cand.*, tf_gene_spearman FROM cand JOIN tg USING (tf, gene) WHERE tf_gene_spearman > 1e-12)"""


@query(f"WITH {_LINKS_SQL} SELECT peak, gene FROM lk WHERE qvalue_bh < 0.9 AND spearman > 0.02")
def pf6_selected_links(s, d):
    return regulatory.select_links(_links(s, d), LOOSE).select("peak", "gene")


@query(f"WITH {_TRIPLETS_SQL} SELECT tf, peak, gene, round(spearman, 6) AS spearman, motif_pvalue, round(tf_gene_spearman, 6) AS tf_gene_spearman, 'activating' AS regulation_direction FROM tr")
def ml13_triplets(s, d):
    """ML13, JN3, JN4, PF7, PF9, PJ3."""
    m = _means(s, d)
    out = regulatory.triplets(_links(s, d, m), views.hits(s, d), views.rna(s, d), views.cells(s, d), regulatory.Thresholds(**{**LOOSE.__dict__, "tf_gene_r": 1e-12}), means=m)
    return out.select("tf", "peak", "gene", F.round("spearman", 6).alias("spearman"), "motif_pvalue", F.round("tf_gene_spearman", 6).alias("tf_gene_spearman"), "regulation_direction")


@query(f"""WITH {_TRIPLETS_SQL}, g2 AS (SELECT * FROM tr CROSS JOIN g)
SELECT tf, peak, gene, project_id, sample_id, gpt_cell_type, round(CASE WHEN f.value > 0 AND a.value > 0 AND y.value > 0 THEN cbrt(f.k / n * a.k / n * y.k / n) ELSE 0 END, 5) AS active_score, round(CASE WHEN f.value > 0 AND a.value > 0 AND y.value > 0 THEN cbrt(f.k / n * a.k / n * y.k / n) ELSE 0 END * sqrt(g2.spearman * g2.tf_gene_spearman), 5) AS weighted_active_score
FROM g2 JOIN (SELECT gene AS tf, project_id, sample_id, gpt_cell_type, value, k FROM kr) f USING (tf, project_id, sample_id, gpt_cell_type) JOIN ka a USING (peak, project_id, sample_id, gpt_cell_type) JOIN kr y USING (gene, project_id, sample_id, gpt_cell_type), ng""")
def ml12_active_scores(s, d):
    """ML12, JN16, WN9, FN4, FN5: scores of the top of the chain, links to triplets to scores."""
    c, r, a = views.cells(s, d), views.rna(s, d), views.atac(s, d)
    t = regulatory.Thresholds(**{**LOOSE.__dict__, "tf_gene_r": 1e-12})
    m = _means(s, d)
    trip = regulatory.triplets(_links(s, d, m), views.hits(s, d), r, c, t, means=m)
    out = regulatory.active_scores(trip, r, a, c, "ds", t, means=m)
    return out.select("tf", "peak", "gene", "project_id", "sample_id", "gpt_cell_type", F.round("active_score", 5).alias("active_score"), F.round("weighted_active_score", 5).alias("weighted_active_score"))


@query("""WITH n AS MATERIALIZED (SELECT count(*) AS n FROM cells), x AS MATERIALIZED (SELECT * FROM rna), st AS MATERIALIZED (SELECT gene, sum(value) AS s, sum(value * value) AS q FROM x GROUP BY 1),
v AS MATERIALIZED (SELECT gene, (q - s * s / (SELECT n FROM n)) / ((SELECT n FROM n) - 1) AS v FROM st)
SELECT cell, gene, round(value / sqrt(v), 6) AS value FROM x JOIN v USING (gene) WHERE v > 0""")
def ml2_scale(s, d):
    return cells.scale(views.rna(s, d), "gene", views.cells(s, d).count()).withColumns(r6("value"))


@query("""WITH n AS (SELECT count(*) AS n FROM cells), e AS (SELECT gene, exp(value / 100) - 1 AS x FROM rna),
st AS (SELECT gene, sum(x) / any_value(n) AS mean, (sum(x * x) - any_value(n) * (sum(x) / any_value(n)) ** 2) / (any_value(n) - 1) AS v FROM e, n GROUP BY 1),
l AS (SELECT gene, ln(1 + mean) AS m, ln(v / mean) AS dd FROM st), b AS (SELECT *, least(floor((m - min(m) OVER ()) / ((max(m) OVER () - min(m) OVER ()) / 4)), 3) AS bin FROM l),
z AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY bin) = 1 THEN 1 ELSE (dd - avg(dd) OVER (PARTITION BY bin)) / stddev_samp(dd) OVER (PARTITION BY bin) END AS score FROM b)
SELECT gene, round(score, 5) AS score, row_number() OVER (ORDER BY score DESC, gene) <= 5 AS highly_variable FROM z""")
def ml1_highly_variable(s, d):
    r = views.rna(s, d).withColumn("value", F.col("value") / 100)
    return cells.highly_variable(r, "gene", views.cells(s, d).count(), 5, 4).select("gene", F.round("score", 5).alias("score"), "highly_variable")


def _vectors(s, d):
    return T(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"))


@query("""WITH p AS (SELECT a.vec_id AS src, b.vec_id AS dst, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (CAST(z[1] AS DOUBLE) - z[2]) ** 2))) AS distance FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
SELECT src, dst, round(distance, 5) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY distance, dst) AS n FROM p) WHERE n <= 10""", base=False)
def ml4_knn(s, d):
    return embedding.knn(_vectors(s, d), 10).select("src", "dst", F.round("distance", 5).alias("distance"))


@query()
def ml3_truncated_svd(s, d):
    """Scores on the first three of ten components."""
    x = factor.truncated_svd(views.rna(s, d), "gene", 10)
    return x.select("cell", F.slice(F.transform("x", lambda v: F.round(v, 4)), 1, 3).alias("x"))


@query()
def ml5_clusters(s, d):
    e = embedding.connectivities(embedding.knn(_vectors(s, d), 10))
    return embedding.clusters(e, 5)


@query()
def ml6_layout(s, d):
    v = _vectors(s, d)
    return embedding.layout(v, embedding.connectivities(embedding.knn(v, 10)), 10)


@query("SELECT cell, round(sum(value * value), 3) AS squares FROM rna GROUP BY 1")
def ml3_svd_lengths(s, d):
    """With as many components as genes, scores keep every cell's length."""
    x = factor.truncated_svd(views.rna(s, d), "gene", 25)
    return x.select("cell", F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v), 3).alias("squares"))


@query("SELECT count(*) AS vectors, 10 * count(*) AS edges, true AS found FROM embeddings", base=False)
def ml4_approximate_knn(s, d):
    """The approximate neighbours of all vectors: how many, and whether 95 of 100 are among the exact ones."""
    v = _vectors(s, d)
    exact = embedding.knn(v, 10)
    near = neighbours.approximate_knn(v, 10, trees=64, leaf=256, recall=0.97, exact=exact)
    both = near.join(exact.select("src", "dst", F.lit(1).alias("hit")), ["src", "dst"], "left")
    return both.agg(F.count_distinct("src").alias("vectors"), F.count("*").alias("edges"), (F.sum("hit") >= 0.95 * F.count("*")).alias("found"))


@query("SELECT count(*) AS vertices, 0 AS apart, true AS as_good FROM embeddings", base=False)
def ml5_modularity(s, d):
    """Communities of all vectors: vertices, communities in several parts, and whether modularity is that of label propagation or more."""
    e = cut(embedding.connectivities(embedding.knn(_vectors(s, d), 10)))
    found = cut(communities.communities(e))
    good = communities.modularity(e, found) >= communities.modularity(e, embedding.clusters(e, 5)) - 1e-9
    own = e
    for c in ("src", "dst"):
        own = own.join(found.withColumnsRenamed({"id": c, "cluster": f"c_{c}"}), c)
    parts = communities.connected(own.filter("c_src = c_dst").select("src", "dst"), found.select("id")).join(found, "id")
    apart = parts.groupBy("cluster").agg(F.count_distinct("part").alias("n"))
    return found.agg(F.count("*").alias("vertices")).crossJoin(apart.agg(F.count_if(F.col("n") > 1).alias("apart"))).withColumn("as_good", F.lit(bool(good)))


@query("SELECT page_id, substr(h, page_id % 50 + 1, 20) AS sequence FROM (SELECT page_id, repeat('ACGTTGCA', 20) AS h FROM pages)", base=False)
def ml10_sequences(s, d):
    p = T(s, d, "pages").select("page_id", F.lit("c").alias("chrom"), (F.col("page_id") % 50).alias("start"), (F.col("page_id") % 50 + 20).alias("end"))
    contigs = T(s, d, "region").limit(1).select(F.lit("c").alias("contig"), F.repeat(F.lit("ACGTTGCA"), 20).alias("sequence"))
    return intervals.extract_sequences(p, contigs)[0].select("page_id", "sequence")


@query()
def ml9_motif_scan(s, d):
    """Documents' letters as sequences."""
    import numpy as np

    seq = T(s, d, "documents").select(F.col("doc_id").cast("string").alias("peak"), F.translate(F.upper(F.coalesce("text", F.lit(""))), "ETAOINSHRDLU", "ACGTACGTACGT").alias("sequence"))
    p = np.full((6, 4), 0.02)
    p[np.arange(6), [0, 1, 2, 3, 0, 2]] = 0.94
    return motif.scan(seq, {"M1": p}, 5e-4)


@query(f"WITH {_MEANS}, f AS (SELECT gene AS tf, sum(value) / any_value(n) AS m, max(value) AS h FROM mr, ng GROUP BY 1), c AS (SELECT count(*) FILTER (WHERE m > 0.5 AND h > 0.5) AS a, count(*) FILTER (WHERE m > 0.25 AND h > 0.5) AS b, count(*) FILTER (WHERE m > 0.25 AND h > 0.25) AS c, count(*) FILTER (WHERE m > 0.1 AND h > 0.25) AS e FROM f) SELECT CASE WHEN a >= 3 THEN 0 WHEN b >= 3 THEN 1 WHEN c >= 3 THEN 2 ELSE 3 END AS rung, CASE WHEN a >= 3 THEN a WHEN b >= 3 THEN b WHEN c >= 3 THEN c ELSE e END AS n_tfs FROM c")
def ml11_ladder(s, d):
    c = views.cells(s, d)
    g = pseudobulk.groups_of(c, 10)
    m = pseudobulk.feature_summary(pseudobulk.group_means(views.rna(s, d), pseudobulk.assign(c, g), "gene"), "gene", g.count()).withColumnRenamed("gene", "tf")
    return motif.ladder(m, m.select("tf"), 0.5, 0.5).select("rung", "n_tfs")


@query("SELECT cell, 'type ' || gpt_cell_type AS gpt_cell_type, 'CL:000000' || (length(gpt_cell_type) % 10) AS gpt_cell_ontology_id FROM cells")
def ml16_annotation_labels(s, d):
    """FN11, FN13, ML16: a JSON answer, checked, put on cells."""
    c = views.cells(s, d).select("cell", F.col("gpt_cell_type").alias("old_cluster"))
    a = c.select("old_cluster").distinct().select("old_cluster", F.concat(F.lit("type "), "old_cluster").alias("cell_type"), F.concat(F.lit("CL:000000"), (F.length("old_cluster") % 10).cast("string")).alias("cell_ontology_id"), F.lit("high").alias("confidence"), F.lit(True).alias("tissue_consistent"), F.lit("").alias("reason"))
    js = a.agg(F.to_json(F.struct(F.collect_list(F.struct(*a.columns)).alias("annotations"))).alias("json"))
    return metadata.label_cells(c, metadata.parse_annotations(js)).select("cell", "gpt_cell_type", "gpt_cell_ontology_id")


@query("SELECT cell, gene, position, value FROM (SELECT l_orderkey AS cell, p_brand AS gene, l_linenumber AS position, min(l_quantity) AS value, min(l_linenumber) OVER (PARTITION BY p_brand) AS f FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3) WHERE position = f", base=False)
def cl1_first_feature(s, d):
    x = T(s, d, "lineitem").join(T(s, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_orderkey").alias("cell"), F.col("p_brand").alias("gene"), F.col("l_linenumber").alias("position")).agg(F.min("l_quantity").alias("value"))
    return cells.first_feature(x, "gene", "position")


@query("SELECT count(*) FILTER (WHERE last_ok > coalesce(last_failed, -1)) AS complete, count(*) AS n FROM (SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN event_id END) AS last_ok, max(CASE WHEN event_type = 'error' THEN event_id END) AS last_failed FROM events GROUP BY 1)", base=False)
def ag15_status(s, d):
    """Last completion after the last failure."""
    last = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("event_id")))
    x = T(s, d, "events").groupBy("user_id").agg(last("purchase").alias("ok"), last("error").alias("failed"))
    return x.agg(F.count_if(F.col("ok") > F.coalesce("failed", F.lit(-1))).alias("complete"), F.count("*").alias("n"))
