"""The end-to-end run of a dataset: matrices to links, motif hits, triplets, scores and the export bundle.

Each stage publishes its tables below work_root or output_root. With a table lies a manifest: a fingerprint of the settings that the stage
reads, of its input files and of the stages before it. A stage is passed over where all its tables have the fingerprint that they would
get now, so what was made under other settings, or from tables that have changed since, is made again. The stages' own work
is DataFrames; what reaches the driver is one row a sample, a motif or a summary.
"""

from __future__ import annotations

import hashlib
import json
import logging
import time
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.functions.names import is_missing, prefixed_cell
from heliograph.operators import activity, cells, communities, embedding, factor, intervals, metadata, motif, neighbours, order, pseudobulk, ranks, regulatory, samples, sampling
from heliograph.operators.cut import cut
from heliograph.operators.guards import ContractError, require_columns
from heliograph.plans.batch import PipelineConfig, run_datasets
from heliograph.sources import readers, sinks

LOG = logging.getLogger("heliograph")
#: Epochs of the layouts.
EPOCHS = 30
#: Names that a motif hit table's columns may have. Fixed values.
HIT_NAMES = {"TF_Name": "tf", "p-value": "motif_pvalue", "pvalue": "motif_pvalue"}


class Stages:
    """Runs stages or takes what they left; a stage's tables are named by path."""

    def __init__(self, spark: SparkSession, config: PipelineConfig, dataset: str) -> None:
        self.spark, self.config, self.dataset, self.seconds, self.marks, self.ran = spark, config, dataset, {}, {}, []

    def mark(self, name: str, uses: tuple[str, ...], after: tuple[str, ...], files: list[str | None]) -> str:
        """The stage's fingerprint, which is its tables' manifest."""
        settings = self.config.to_dict()
        told = [name, self.dataset, {u: settings[u] for u in uses}, [self.marks[x] for x in after], [sinks.stamp(self.spark, f) for f in files]]
        self.marks[name] = hashlib.sha256(json.dumps(told, sort_keys=True, default=str).encode()).hexdigest()
        return self.marks[name]

    def __call__(self, name: str, paths: dict[str, str], make: Callable[[], dict[str, DataFrame]], uses: tuple[str, ...] = (), after: tuple[str, ...] = (), files: list[str | None] | None = None) -> dict[str, DataFrame]:
        began = time.time()
        mark = self.mark(name, uses, after, files or [])
        if not (self.config.resume and all(sinks.manifest(self.spark, p) == mark for p in paths.values())):
            made = make()
            for k, path in paths.items():
                sinks.publish(made[k], path, manifest=mark)
            self.ran.append(name)
        self.seconds[name] = round(time.time() - began, 1)
        LOG.info("dataset=%s stage=%s seconds=%s", self.dataset, name, self.seconds[name])
        return {k: self.spark.read.parquet(p) for k, p in paths.items()}


def load(spark: SparkSession, config: PipelineConfig, dataset: str, meta: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rna, atac, cells: cell, sample) of all samples after quality control, merged; cells are named sample#cell."""
    root = f"{config.data_root}/{dataset}"
    listed = [r.asDict() for r in meta.collect()]  # one row a sample
    if readers.is_10x_dir(spark, root):
        if len(listed) != 1:
            raise ContractError("one matrix for several samples")
        paths = [(listed[0]["sample_name"], root)]
    else:
        names = spark.createDataFrame([(x["sample_name"], x.get("sample_file") or x["sample_name"]) for x in listed], "sample_name string, sample_file string")
        found = metadata.resolve_input(names, spark.createDataFrame([(x,) for x in readers.names_in(spark, root)], "path string")).collect()
        if lost := sorted(r["sample_name"] for r in found if r["path"] is None):
            raise ContractError(f"samples without a folder: {lost}")
        paths = sorted((r["sample_name"], f"{root}/{r['path']}") for r in found)
    every: list[list[DataFrame]] = []
    for name, path in paths:
        if (kind := readers.matrix_kind(spark, path)) != "mtx":
            raise ContractError(f"{path}: {kind} matrices are not read here")
        rna, atac = (cut(x) for x in readers.clean_modalities(cut(readers.read_mtx(spark, path))))
        passed = cells.qc_cells(rna, atac, config.min_genes, config.min_atac_counts)
        both = cells.qc_filter(rna, atac, config.min_cells, config.min_genes, config.min_cells, config.min_atac_counts)
        every.append([x.withColumns({"sample": F.lit(name), "cell": prefixed_cell(F.col("cell"), F.lit(name))}) for x in (*both, passed)])
    rna, atac, all_ = every[0]
    for r, a, c in every[1:]:
        rna, atac, all_ = rna.unionByName(r), atac.unionByName(a), all_.unionByName(c)
    return *samples.merge_samples(cut(rna), cut(atac)), cut(all_)


def _vectors(fact: DataFrame, feature: str, numbers: DataFrame, k: int) -> DataFrame:
    """id, x: every cell's scores on leading components, by the cells' numbers; a cell without values lies at 0."""
    least = min(k, fact.select(feature).distinct().count() - 1, numbers.count() - 1)
    scores = cut(factor.truncated_svd(fact, feature, max(2, least)))
    n = scores.agg(F.max(F.size("x"))).first()[0]
    zero = F.array_repeat(F.lit(0.0), n)
    return cut(numbers.join(scores, "cell", "left").select("id", F.coalesce("x", zero).alias("x")))


def variable_genes(rna: DataFrame, n: int) -> DataFrame:
    """rna of highly variable genes, scaled. n: all cells."""
    best = cells.highly_variable(rna, "gene", n).filter("highly_variable").select("gene")
    return cut(cells.scale(rna.join(best, "gene", "left_semi"), "gene", n))


def cluster(rna: DataFrame, numbers: DataFrame, resolution: float = 1.0) -> DataFrame:
    """cell, old_cluster: every cell's community of the neighbour graph."""
    vectors = _vectors(variable_genes(rna, numbers.count()), "gene", numbers, 20)
    edges = embedding.connectivities(cut(neighbours.knn(vectors, 15)))
    return numbers.join(communities.communities(edges, resolution), "id").select("cell", F.col("cluster").alias("old_cluster"))


def points(fact: DataFrame, feature: str, numbers: DataFrame, every: DataFrame, seed: int) -> DataFrame:
    """cell, x, y: the layout of a modality, one row for each cell."""
    vectors = _vectors(fact, feature, numbers, 50)
    xy = embedding.layout(vectors, embedding.connectivities(cut(neighbours.knn(vectors, 20))), EPOCHS, seed)
    return embedding.require_embedding(cut(numbers.join(xy, "id").select("cell", "x", "y")), every)


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """An external table of motif hits: tf, peak, motif_pvalue and what else it has."""
    raw = spark.read.parquet(path) if path.endswith(".parquet") else readers.read_strings(spark, path, "\t")
    out = require_columns(raw.withColumnsRenamed(HIT_NAMES), "tf", "peak", "motif_pvalue")
    return out.withColumn("motif_pvalue", F.col("motif_pvalue").try_cast("double"))


def read_catalog(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(catalogue: tf, motif_id, status, source; valid matrices: motif_id, pos, p) of a motif folder."""
    table = readers.read_strings(spark, f"{folder}/TF_Information_all_motifs_plus.txt", "\t")
    require_columns(table, "TF_Name", "Motif_ID", "TF_Status", "MSource_Type", "MSource_Identifier")
    catalog = table.select(F.col("TF_Name").alias("tf"), F.col("Motif_ID").alias("motif_id"), F.col("TF_Status").alias("status"), F.col("MSource_Type").alias("source")).distinct()
    rows = spark.read.csv(f"{folder}/pwms_all_motifs/*.txt", sep="\t", header=True, schema="Pos int, A double, C double, G double, T double")
    rows = rows.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.txt$", 1).alias("motif_id"), F.col("Pos").alias("pos"), "A", "C", "G", "T")
    return catalog, motif.valid_matrices(rows)


def scan_motifs(spark: SparkSession, config: PipelineConfig, dataset: str, organism: str, rna: DataFrame, atac: DataFrame, labelled: DataFrame) -> dict[str, DataFrame]:
    """hits (tf, peak, motif_id, motif_pvalue): best hits of the expressed TFs' chosen motifs in the peaks' sequences; chosen: the motifs
    and their sources; dropped (peak, chrom, start, end): peaks that the genome lacks."""
    t = config.thresholds
    catalog, matrices = read_catalog(spark, config.cisdb_by_organism[organism])
    matrices = cut(matrices)
    groups = pseudobulk.replicate_parts(pseudobulk.groups_of(labelled, t.min_pseudobulk_cells))
    n = groups.agg(F.sum("parts")).first()[0] or 0
    means = cut(pseudobulk.group_means(rna, pseudobulk.assign(labelled, groups, config.random_seed), "gene"))
    summary = cut(pseudobulk.feature_summary(means, "gene", max(1, n)).withColumnRenamed("gene", "tf"))
    usable = catalog.join(matrices.select("motif_id").distinct(), "motif_id", "left_semi")
    rung = motif.ladder(summary, usable, t.tf_pseudobulk_mean, t.tf_pseudobulk_max).first()
    passed = summary.filter((F.col("pseudobulk_expression_mean") > rung["mean"]) & (F.col("pseudobulk_expression_max") > rung["maximum"]))
    chosen = cut(motif.select_matrices(usable.join(passed, "tf", "left_semi"), motif.information_content(matrices), 1))
    table: dict[str, list] = {}  # the chosen motifs alone, some kilobytes each
    for r in matrices.join(chosen.select("motif_id").distinct(), "motif_id", "left_semi").orderBy("motif_id", "pos").collect():
        table.setdefault(r["motif_id"], []).append(r["p"])
    genome = cut(readers.read_fasta(spark, config.genome(dataset, organism)))
    peaks = samples.peak_intervals(atac)
    where = intervals.resolve_contigs(peaks.select("chrom"), genome.select("contig"))
    located = peaks.join(where, "chrom").select("peak", F.coalesce("contig", "chrom").alias("chrom"), "start", "end")
    found, dropped = intervals.extract_sequences(located, genome)
    hits = motif.tf_peak_hits(motif.scan(found, {m: np.array(p) for m, p in table.items()}, t.motif_pvalue), chosen)
    return {"hits": hits, "chosen": chosen, "dropped": dropped.select("peak", "chrom", "start", "end")}


def export(spark: SparkSession, config: PipelineConfig, dataset: str, out: str, labelled: DataFrame, rna: DataFrame, atac: DataFrame, places: dict[str, DataFrame], tables: dict[str, DataFrame]) -> None:
    """The bundle: cells, membership, layouts and expression of drawn cells, inverted indexes, regulatory tables, a summary.

    A stratified draw by (sample_id, gpt_cell_type) bounds the cells; scores are whole.
    """
    drawn = cut(sampling.stratified(labelled.select("cell", "sample_id", "gpt_cell_type"), config.export_max_cells, config.export_min_per_stratum, ["sample_id", "gpt_cell_type"], config.random_seed).select("cell", "selected"))
    kept = drawn.filter("selected").select("cell")
    named = lambda df: df.withColumnRenamed("cell", "cell_id")
    of = lambda df: df.join(kept, "cell", "left_semi")
    rest = [c for c in labelled.columns if c != "cell"]
    sinks.publish(of(labelled).select(F.lit(dataset).alias("dataset"), F.col("cell").alias("cell_id"), *rest), f"{out}/meta/cells.parquet")
    sinks.publish(named(drawn), f"{out}/meta/downsampling_membership.parquet")
    for name, xy in places.items():
        sinks.publish(named(of(xy)), f"{out}/embedding/umap_{name}.parquet")
    for name, fact, feature in (("rna", rna, "gene"), ("atac", atac, "peak")):
        sinks.write_sparse(of(fact), feature, f"{out}/expression/{name}_expr.parquet", f"{out}/index/{feature}_to_cells.parquet", cell="cell_id")
    for name, df in tables.items():
        sinks.publish(df, f"{out}/regulatory/{name}.parquet")
    n, m = drawn.agg(F.count("*"), F.count_if("selected")).first()
    sinks.write_report(spark, {"method": "stratified by sample_id and gpt_cell_type", "seed": config.random_seed, "original_cells": n, "exported_cells": m, "max_cells": config.export_max_cells, "minimum_per_stratum": config.export_min_per_stratum, "note": "scores are not downsampled"}, f"{out}/meta/downsampling.json")


def process_dataset(spark: SparkSession, config: PipelineConfig, dataset: str, annotate: Callable[[str, int], str] | None = None) -> str | None:
    """All stages of one dataset; a reason if there is nothing to do.

    annotate: (payload, attempt from 0) -> the answer as JSON, asked again while it breaks the contract; else the answer is a file.
    """
    work, out, t, seed = f"{config.work_root}/{dataset}", f"{config.output_root}/{dataset}", config.thresholds, config.random_seed
    stage = Stages(spark, config, dataset)

    def samples_() -> dict[str, DataFrame]:
        files = readers.read_strings(spark, config.sample_file_map, "\t") if config.sample_file_map else None
        return {"metadata": metadata.dataset_metadata(readers.read_strings(spark, config.metadata), dataset, files)}

    meta = stage("metadata", {"metadata": f"{work}/metadata"}, samples_, files=[config.metadata, config.sample_file_map])["metadata"]
    organism = meta.first()["biosource_organism"]

    def matrix() -> dict[str, DataFrame]:
        genes, bodies = readers.read_gtf(spark, config.gtf(dataset, organism))
        rna, atac, all_ = load(spark, config, dataset, meta)
        rna, atac, annotation = samples.filter_annotate(rna, atac, genes, bodies, t.feature_fraction, all_.count())
        return {"rna": cut(rna), "atac": cut(atac), "annotation": annotation, "all_cells": all_}

    m = stage("read_filter_peak_annotation", {k: f"{work}/{k}" for k in ("rna", "atac", "annotation", "all_cells")}, matrix, ("min_genes", "min_cells", "min_atac_counts", "thresholds"), ("metadata",), [f"{config.data_root}/{dataset}", config.gtf(dataset, organism)])
    rna, atac, annotation = m["rna"], m["atac"], m["annotation"]

    def clusters() -> dict[str, DataFrame]:
        named = m["all_cells"].select("cell", F.col("sample").alias("sample_name"))
        all_ = metadata.join_metadata(cut(named), meta)
        numbers = cut(order.numbered(named.select("cell"), ["cell"]).select("cell", F.col("n").alias("id")))
        found = cut(all_.join(cluster(rna, numbers, config.cluster_resolution), "cell"))
        return {"numbers": numbers, "cells": found, "markers": ranks.rank_sum_markers(rna, found, "gene", "old_cluster")}

    c = stage("cluster_markers", {k: f"{work}/{k}" for k in ("numbers", "cells", "markers")}, clusters, ("cluster_resolution",), ("read_filter_peak_annotation",))

    def label() -> dict[str, DataFrame]:
        payload = metadata.marker_payload(c["markers"], meta, dataset, config.top_markers)
        if annotate is not None:
            asked = payload.first()["payload"]
            answer = lambda i: cut(metadata.parse_annotations(spark.createDataFrame([(annotate(asked, i),)], "json string")))
            return {"labelled": metadata.annotate_with_retries(c["cells"], answer)}
        if not config.annotation_response:
            sinks.write_small(payload, f"{work}/annotation_payload", "json")
            raise ContractError(f"no annotation_response; the payload to answer is in {work}/annotation_payload")
        answer = spark.read.text(config.annotation_response, wholetext=True).select(F.col("value").alias("json"))
        return {"labelled": metadata.label_cells(c["cells"], cut(metadata.parse_annotations(answer)))}

    labelled = stage("annotation", {"labelled": f"{work}/labelled"}, label, ("annotation_response", "top_markers"), ("cluster_markers",), [config.annotation_response])["labelled"]

    def places() -> dict[str, DataFrame]:
        scaled = variable_genes(rna, c["numbers"].count())
        linked = annotation.join(scaled.select("gene").distinct(), "gene", "left_semi").select("peak").distinct()
        every = labelled.select("cell")
        return {"rna": points(scaled, "gene", c["numbers"], every, seed), "atac": points(atac.join(linked, "peak", "left_semi"), "peak", c["numbers"], every, seed)}

    of = ("random_seed", "thresholds")
    xy = stage("embeddings", {k: f"{work}/umap_{k}" for k in ("rna", "atac")}, places, ("random_seed",), ("cluster_markers",))
    links = stage("peak_gene_links", {"links": f"{work}/peak_gene_links"}, lambda: {"links": regulatory.peak_gene_links(rna, atac, labelled, annotation, t, seed)}, of, ("annotation",))["links"]
    if dataset in config.motif_hits:
        given = config.motif_hits[dataset]
        hits = read_hits(spark, given)
        stage.mark("motif_hits", (), (), [given])
    else:
        needs = [config.genome(dataset, organism), config.cisdb_by_organism[organism]]
        hits = stage("motif_hits", {"hits": f"{work}/tf_peak_hits", "chosen": f"{work}/tf_motifs_selected", "dropped": f"{work}/peaks_without_sequence"}, lambda: scan_motifs(spark, config, dataset, organism, rna, atac, labelled), of, ("annotation",), needs)["hits"]
    trip = stage("triplets", {"trip": f"{work}/triplets"}, lambda: {"trip": regulatory.triplets(links, hits, rna, labelled, t, seed=seed)}, of, ("peak_gene_links", "motif_hits"))["trip"]
    stage("active_scores", {"scores": f"{out}/triplet_active_scores.parquet"}, lambda: {"scores": regulatory.active_scores(trip, rna, atac, labelled, dataset, t)}, of, ("triplets",))
    fields = [f for f in metadata.CONTEXT_FIELDS if f in labelled.columns]
    stage("context_means", {f: f"{out}/expression/{f}_mean_context.parquet" for f in ("gene", "peak")}, lambda: {f: pseudobulk.context_means(fact, labelled, f, fields) for f, fact in (("gene", rna), ("peak", atac))}, (), ("annotation",))
    mark = stage.mark("export", ("export_max_cells", "export_min_per_stratum", "random_seed"), ("embeddings", "active_scores", "context_means"), [])
    activity_path = f"{out}/expression/gene_activity.parquet"
    if not stage.ran and config.resume and sinks.read_report(spark, f"{out}/meta/complete.json") == mark and sinks.is_complete(spark, activity_path):
        return "complete"
    export(spark, config, dataset, out, labelled, rna, atac, xy, {"peak_gene_links": links, "tf_peak_motif_hits": hits, "tf_peak_gene_triplets": trip})
    drawn = spark.read.parquet(f"{out}/expression/atac_expr.parquet").withColumnRenamed("cell_id", "cell")
    sinks.publish(activity.gene_activity(drawn, links.filter(~is_missing(F.col("gene")))).withColumnRenamed("cell", "cell_id"), activity_path, manifest=mark)
    sinks.write_report(spark, mark, f"{out}/meta/complete.json")
    return None


def run(spark: SparkSession, config: PipelineConfig, datasets: list[str] | None = None, annotate: Callable[[str, int], str] | None = None) -> list[dict]:
    """Rows of status, one a dataset, also written after each as run.latest.json and under the run's time; `workers` datasets at a time."""
    names = datasets or config.datasets
    if odd := sorted(set(names) - set(config.datasets)):
        raise ValueError(f"not in the configuration: {odd}")
    stamp = time.strftime("%Y%m%dT%H%M%S", time.gmtime())

    def report(rows: list[dict]) -> None:
        for name in (stamp, "latest"):
            sinks.write_report(spark, rows, f"{config.output_root}/run.{name}.json")

    return run_datasets(names, lambda d: process_dataset(spark, config, d, annotate), report, config.workers, spark)
