"""Configuration and runs over many datasets."""

from __future__ import annotations

import argparse
import json
import logging
import sys
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from pathlib import Path
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.operators import activity
from heliograph.operators.guards import require_columns
from heliograph.operators.pseudobulk import GROUP
from heliograph.operators.regulatory import Thresholds
from heliograph.sources import readers, sinks
from heliograph.sources.keyed import STATUS, KeyedTable, run_name

LOG = logging.getLogger("heliograph")
#: Keys of a configuration for programs and services that have no part here; they are read and passed over. Fixed values.
OUTSIDE = ("fimo_jobs", "fimo_sequences_per_chunk", "fimo_executable", "bedtools_executable", "annotation_mode", "annotation_model", "annotation_base_url", "annotation_api_key_env", "codex_executable", "run_rapids", "rapids_env", "gpu_ids")


@dataclass(frozen=True)
class PipelineConfig:
    """The keys that users of such configurations write. min_genes, min_cells and min_atac_counts are the limits of cells and features."""

    data_root: str
    datasets: list[str]
    metadata: str | None = None
    sample_file_map: str | None = None
    output_root: str = "./output"
    work_root: str = "./work"
    workers: int = 1
    gtf_by_organism: dict[str, str] = field(default_factory=dict)
    gtf_by_dataset: dict[str, str] = field(default_factory=dict)
    genome_fasta_by_organism: dict[str, str] = field(default_factory=dict)
    genome_fasta_by_dataset: dict[str, str] = field(default_factory=dict)
    cisdb_by_organism: dict[str, str] = field(default_factory=dict)
    motif_hits: dict[str, str] = field(default_factory=dict)
    top_markers: int = 30
    annotation_response: str | None = None
    resume: bool = True
    export_max_cells: int = 100_000
    export_min_per_stratum: int = 20
    random_seed: int = 0
    cluster_resolution: float = 1.0
    log_level: str = "INFO"
    min_genes: int = 200
    min_cells: int = 3
    min_atac_counts: int = 100
    thresholds: Thresholds = field(default_factory=Thresholds)

    def __post_init__(self) -> None:
        if not self.datasets:
            raise ValueError("no datasets")
        if self.workers < 1:
            raise ValueError("workers must be 1 or more")

    @classmethod
    def from_json(cls, path: str) -> PipelineConfig:
        raw = {k: v for k, v in json.loads(Path(path).read_text()).items() if k not in OUTSIDE}
        return cls(**raw | {"thresholds": Thresholds(**raw.get("thresholds", {}))})

    def to_dict(self) -> dict:
        return asdict(self)

    def gtf(self, dataset: str, organism: str) -> str:
        return self.gtf_by_dataset.get(dataset) or self.gtf_by_organism[organism]

    def genome(self, dataset: str, organism: str) -> str:
        return self.genome_fasta_by_dataset.get(dataset) or self.genome_fasta_by_organism[organism]


def run_datasets(datasets: list[str], work: Callable[[str], str | None], on_row: Callable[[list[dict]], None] | None = None, workers: int = 1, spark: SparkSession | None = None) -> list[dict]:
    """Rows of status in the order given; a failure is a row, not the end. work returns a reason to skip.

    workers: so many datasets at a time, each from a thread of its own; with fair scheduling each has a pool of its own, so that a large
    dataset's jobs do not hold up the others'. on_row gets the rows so far, one call at a time.
    """
    rows: dict[str, dict] = {}
    lock = Lock()

    def one(d: str) -> None:
        began = time.time()
        try:
            if spark is not None:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", d)
            skipped = work(d)
            row = {"dataset": d, "status": "skipped" if skipped else "ok", "detail": skipped or ""}
        except Exception as e:  # noqa: BLE001
            LOG.exception("dataset %s", d)
            row = {"dataset": d, "status": "failed", "detail": f"{type(e).__name__}: {e}"}
        finally:
            if spark is not None:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        with lock:
            rows[d] = row | {"seconds": round(time.time() - began, 1)}
            if on_row:
                on_row([rows[x] for x in datasets if x in rows])

    if workers <= 1:
        for d in datasets:
            one(d)
    else:
        with ThreadPoolExecutor(workers) as pool:
            for f in [pool.submit(inheritable_thread_target(spark)(one) if spark is not None else one, d) for d in datasets]:
                f.result()
    return [rows[d] for d in datasets]


def covered_datasets(coverage: DataFrame, minimum: int = 100) -> DataFrame:
    """dataset of rows whose pair count is a number of at least the minimum."""
    require_columns(coverage, "dataset", "unique_tf_gene_pairs")
    return coverage.filter(F.col("unique_tf_gene_pairs").try_cast("double") >= minimum).select("dataset")


def matrices(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells with their labels, rna, atac) of a dataset's work folder as the run leaves it, or of cells, rna and atac .parquet files."""
    ran = sinks.is_complete(spark, f"{folder}/labelled")
    return tuple(spark.read.parquet(f"{folder}/{n}" if ran else f"{folder}/{'cells' if n == 'labelled' else n}.parquet") for n in ("labelled", "rna", "atac"))


def active_fraction(spark: SparkSession, folder: str, output: str, work: str | None = None) -> str | None:
    """The scores of a dataset with the share of each group's cells that hold TF, peak and gene; a reason if it has no scores.

    folder: where triplet_active_scores.parquet lies; work: where the matrices are, the same folder if not given.
    """
    path = f"{folder}/triplet_active_scores.parquet"
    if not sinks.is_complete(spark, path):
        return "no scores"
    scores = require_columns(spark.read.parquet(path), "tf", "peak", "gene", *GROUP)
    cells, rna, atac = matrices(spark, work or folder)
    sinks.publish(activity.add_active_fraction(scores, rna, atac, cells), output)
    return None


#: What a dataset's scores must have for the filter.
_SCORES = ("dataset", "tf", "peak", "gene", "gpt_cell_type", "active_cell_count", "group_total_cells")


def filter_datasets(spark: SparkSession, root: str, names: list[str], table: str, fraction: float = 0.10, count: int = 20) -> list[dict]:
    """The dataset filter over all these datasets as one job, into one keyed table; a status row for each, in the order given.

    A dataset without scores is skipped and one whose scores lack columns, or are of other datasets, has failed; neither touches what the
    table holds of it. Only footers are read one by one.
    """
    rows, frames = {}, []
    for d in names:
        path = f"{root}/{d}/triplet_active_scores.with_active_cells.parquet"
        try:
            if not sinks.is_complete(spark, path):
                rows[d] = {"status": "skipped", "detail": "no scores"}
                continue
            df = require_columns(spark.read.parquet(path), *_SCORES)
            frames.append((d, df.withColumn("_folder", F.lit(d))))
        except Exception as e:  # noqa: BLE001
            LOG.exception("dataset %s", d)
            rows[d] = {"status": "failed", "detail": f"{type(e).__name__}: {e}"}
    keyed, run = KeyedTable(spark, table), run_name()
    if frames:
        every = frames[0][1]
        for _, df in frames[1:]:
            every = every.unionByName(df, allowMissingColumns=True)
        strange = {r[0] for r in every.filter(~F.col("dataset").eqNullSafe(F.col("_folder"))).select("_folder").distinct().collect()}
        rows |= {d: {"status": "failed", "detail": "rows of another dataset"} for d in strange}
        scores = every.filter(~F.col("_folder").isin(sorted(strange))).drop("_folder") if strange else every.drop("_folder")
        good = [d for d, _ in frames if d not in strange]
        kept = activity.dataset_filter(scores, fraction, count)
        keyed.put(kept, good)
        there = keyed.get(kept.schema).filter(F.col("dataset").isin(good))
        found = {r["dataset"]: r.asDict() for r in activity.filter_summaries(scores, there).collect()}  # a row a dataset
        nothing = {k: 0 for k in ("source_rows", "kept_rows", "source_keys", "kept_keys")}
        rows |= {d: {"status": "ok", "detail": ""} | nothing | {k: v for k, v in found.get(d, {}).items() if k != "dataset"} for d in good}
    out = [{"dataset": d} | rows[d] | {"run": run} for d in names]
    keyed.append(spark.createDataFrame([{k: r.get(k) for k in (f.split()[0] for f in STATUS.split(", "))} for r in out], STATUS))
    return out


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="heliograph")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("active-fraction")
    a.add_argument("--backend-root", required=True)
    a.add_argument("--coverage-tsv")
    a.add_argument("--minimum-pairs", type=int, default=100)
    a.add_argument("--work-root", help="where the run left its matrices, a folder a dataset; --backend-root if not given")
    a.add_argument("--workers", type=int, default=1)
    f = sub.add_parser("dataset-filter")
    f.add_argument("--backend-root", required=True)
    f.add_argument("--summary", required=True)
    f.add_argument("--score-threshold", type=float, default=0.10)
    f.add_argument("--count-threshold", type=int, default=20)
    f.add_argument("--output-name", default="triplet_active_scores.dataset_active.parquet")
    f.add_argument("--one-table", help="one table over all datasets, partitioned by dataset, in place of a file in each folder")
    r = sub.add_parser("pipeline")
    r.add_argument("--config", required=True)
    r.add_argument("--datasets", nargs="*", help="some of the configuration's datasets")
    r.add_argument("--workers", type=int, help="datasets at a time; the configuration's number if not given")
    o = p.parse_args(args)
    spark = SparkSession.builder.config("spark.scheduler.mode", "FAIR").getOrCreate()
    if o.command == "pipeline":
        from heliograph.plans import run

        config = PipelineConfig.from_json(o.config)
        if o.workers:
            config = replace(config, workers=o.workers)
        LOG.setLevel(config.log_level)
        rows = run.run(spark, config, o.datasets or None)
    elif o.command == "active-fraction":
        names = [n for n in readers.names_in(spark, o.backend_root) if not n.endswith(".json")]
        if o.coverage_tsv:
            good = {r[0] for r in covered_datasets(readers.read_strings(spark, o.coverage_tsv, "\t"), o.minimum_pairs).collect()}
            names = [n for n in names if n in good]
        work = o.work_root or o.backend_root
        rows = run_datasets(names, lambda d: active_fraction(spark, f"{o.backend_root}/{d}", f"{o.backend_root}/{d}/triplet_active_scores.with_active_cells.parquet", f"{work}/{d}"), workers=o.workers, spark=spark)
    else:
        if "/" in o.output_name or not o.output_name.endswith(".parquet"):
            p.error("--output-name must be a plain .parquet name")

        def one(d: str) -> str | None:
            path = f"{o.backend_root}/{d}/triplet_active_scores.with_active_cells.parquet"
            if not sinks.is_complete(spark, path):
                return "no scores"
            sinks.publish(activity.dataset_filter(spark.read.parquet(path), o.score_threshold, o.count_threshold), f"{o.backend_root}/{d}/{o.output_name}")
            return None

        names = [n for n in readers.names_in(spark, o.backend_root) if not n.endswith(".json")]
        if o.one_table:
            rows = filter_datasets(spark, o.backend_root, names, o.one_table, o.score_threshold, o.count_threshold)
            sinks.write_report(spark, rows, o.summary)
        else:
            rows = run_datasets(names, one, lambda r: sinks.write_report(spark, r, o.summary))
    return int(any(r["status"] == "failed" for r in rows))


if __name__ == "__main__":
    sys.exit(main())
