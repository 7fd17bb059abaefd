"""The end-to-end run from files to every output table."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliograph.operators.guards import ContractError
from heliograph.plans import batch, run
from heliograph.sources import sinks

COLUMNS = ["gse", "PROJID", "SAMID", "sample_name", "organism", "tissueOntologyName", "tissueOntologyID", "isCellLine", "isOrganoid", "cellLineOntologyName", "cellLineOntologyID", "cellOntologyName", "cellOntologyID", "diseaseOntologyName", "diseaseOntologyID", "treatment", "genotype", "group", "donor", "sex", "age", "age_group"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("run")
    rng = np.random.default_rng(5)
    genes, peaks = [f"G{i}" for i in range(14)], [(2000 + 1000 * i, 2300 + 1000 * i) for i in range(14)]
    for s in ("s1", "s2"):
        at = d / "data" / "GSE1_Homo_sapiens" / f"{s}_matrix"
        at.mkdir(parents=True)
        kind = np.repeat([0, 1], 30)
        rate = np.where((np.arange(14) % 2)[:, None] == kind[None], 9.0, 1.5)
        both = np.vstack([rng.poisson(rate), rng.poisson(rate)])
        shift = 20 if s == "s2" else 0  # overlapping, not equal, peaks
        names = [f"{g}\t{g}\tGene Expression" for g in genes] + [f"p{i}\tchr1:{a + shift}-{b + shift}\tPeaks" for i, (a, b) in enumerate(peaks)]
        # cell c60 passes quality control by genes and a peak that no other cell has, so it loses all its values when features are filtered
        names += [f"Own{i}\tOwn{i}\tGene Expression" for i in range(3)] + ["own\tchr1:100-200\tPeaks"]
        both = np.vstack([np.hstack([both, np.zeros((28, 1), int)]), np.hstack([np.zeros((4, 60), int), [[5], [5], [5], [9]]])])
        (at / "features.tsv").write_text("\n".join(names) + "\n")
        (at / "barcodes.tsv").write_text("\n".join(f"c{i}" for i in range(61)) + "\n")
        f, c = np.nonzero(both)
        (at / "matrix.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n%\n" + f"32 61 {len(f)}\n" + "\n".join(f"{i + 1} {j + 1} {both[i, j]}" for i, j in zip(f, c)) + "\n")
    (d / "genes.gtf").write_text("".join(f'chr1\tx\tgene\t{2100 + 1000 * i}\t{2600 + 1000 * i}\t.\t+\t.\tgene_id "{g}"; gene_name "{g}"; gene_type "protein_coding";\nchr1\tx\ttranscript\t{2100 + 1000 * i}\t{2600 + 1000 * i}\t.\t+\t.\tgene_id "{g}"; gene_name "{g}"; gene_type "protein_coding";\n' for i, g in enumerate(genes)))
    seq = rng.choice(list("ACGT"), 20_000)
    for a, _ in peaks:
        seq[a + 100 : a + 110] = list("ACGTTGCAAC")
    (d / "genome.fa").write_text(">chr1 test\n" + "\n".join("".join(seq[i : i + 60]) for i in range(0, len(seq), 60)) + "\n")
    (d / "motifs" / "pwms_all_motifs").mkdir(parents=True)
    (d / "motifs" / "TF_Information_all_motifs_plus.txt").write_text("TF_Name\tMotif_ID\tTF_Status\tMSource_Type\tMSource_Identifier\n" + "".join(f"G{i}\tM{i}\tD\tSELEX\tx\n" for i in range(4)))
    for i in range(4):
        (d / "motifs" / "pwms_all_motifs" / f"M{i}.txt").write_text("Pos\tA\tC\tG\tT\n" + "".join(f"{k + 1}\t" + "\t".join("0.97" if b == x else "0.01" for b in "ACGT") + "\n" for k, x in enumerate("ACGTTGCAAC")))
    (d / "sheet.csv").write_text(",".join(COLUMNS) + "\n" + "".join(f"GSE1,P1,SAM{i},s{i},Homo sapiens,blood," + ",".join([""] * 16) + "\n" for i in (1, 2)))
    return d


def config(d, **more):
    raw = {"data_root": f"{d}/data", "datasets": ["GSE1_Homo_sapiens"], "metadata": f"{d}/sheet.csv", "output_root": f"{d}/out", "work_root": f"{d}/work", "gtf_by_organism": {"Homo sapiens": f"{d}/genes.gtf"}, "genome_fasta_by_organism": {"Homo sapiens": f"{d}/genome.fa"}, "cisdb_by_organism": {"Homo sapiens": f"{d}/motifs"}, "min_genes": 3, "min_atac_counts": 5, "export_max_cells": 50, "export_min_per_stratum": 2, "annotation_mode": "openai", "thresholds": {"peak_gene_fdr": 0.9, "peak_gene_r": 0.1, "tf_gene_r": 0.0, "motif_pvalue": 1e-3, "min_pseudobulk_cells": 5}} | more
    (d / "config.json").write_text(json.dumps(raw))
    return batch.PipelineConfig.from_json(str(d / "config.json"))


def test_end_to_end(spark, folder, monkeypatch):
    monkeypatch.setattr(run, "EPOCHS", 2)
    name, out, work = "GSE1_Homo_sapiens", folder / "out" / "GSE1_Homo_sapiens", folder / "work" / "GSE1_Homo_sapiens"
    first = run.run(spark, config(folder))
    assert first[0]["status"] == "failed" and "annotation_response" in first[0]["detail"]  # the payload waits for its answer
    read = lambda p: spark.read.parquet(str(p))
    found = {r["old_cluster"] for r in read(work / "cells").select("old_cluster").distinct().collect()}
    payload = json.loads(json.loads(spark.read.text(str(work / "annotation_payload")).first()[0])["payload"])
    answer = {"annotations": [{"old_cluster": k, "cell_type": f"type {k}", "cell_ontology_id": "CL:0000084", "confidence": "high", "tissue_consistent": True, "reason": "-"} for k in sorted(found)]}
    (folder / "answer.json").write_text(json.dumps(answer))
    c = config(folder, annotation_response=f"{folder}/answer.json")
    assert run.run(spark, c)[0]["status"] == "ok"
    cells, member = read(out / "meta/cells.parquet"), read(out / "meta/downsampling_membership.parquet")
    assert cells.columns[:2] == ["dataset", "cell_id"] and cells.count() == 50 == member.filter("selected").count() and member.count() == 122  # with the cells that have no value left
    assert {r[0] for r in read(work / "cells").select("cell").collect()} >= {"s1#c60", "s2#c60"} and read(work / "rna").filter("cell = 's1#c60'").count() == 0
    assert read(work / "umap_atac").count() == 122 == read(work / "umap_rna").count()
    drawn = {r[0] for r in cells.select("cell_id").collect()}
    for p in ("embedding/umap_rna", "embedding/umap_atac"):
        assert read(out / f"{p}.parquet").columns == ["cell_id", "x", "y"] and {r[0] for r in read(out / f"{p}.parquet").select("cell_id").collect()} == drawn
    for p, f in (("rna", "gene"), ("atac", "peak")):
        fact, index = read(out / f"expression/{p}_expr.parquet"), read(out / f"index/{f}_to_cells.parquet")
        assert fact.dtypes == [("cell_id", "string"), (f, "string"), ("value", "float")] and index.count() == fact.count()
        assert {r[0] for r in fact.select("cell_id").collect()} <= drawn
    peaks = {r[0] for r in read(work / "atac").select("peak").distinct().collect()}
    assert peaks == {f"chr1:{2000 + 1000 * i}-{2320 + 1000 * i}" for i in range(14)}  # the samples' peaks, merged
    links, trip, scores = read(out / "regulatory/peak_gene_links.parquet"), read(out / "regulatory/tf_peak_gene_triplets.parquet"), read(out / "triplet_active_scores.parquet")
    assert links.columns == ["peak", "gene", "spearman", "pvalue", "qvalue_bh", "n_pseudobulks", "pseudobulk_mode"] and links.count() > 0
    assert read(out / "regulatory/tf_peak_motif_hits.parquet").count() > 0 and trip.count() > 0 and scores.count() >= trip.count()
    assert read(out / "expression/gene_mean_context.parquet").filter("context_name = 'gpt_cell_type'").count() > 0 and read(out / "expression/peak_mean_context.parquet").count() > 0
    assert read(out / "expression/gene_activity.parquet").columns == ["gene", "cell_id", "activity"]
    assert sinks.read_report(spark, f"{out}/meta/downsampling.json")["exported_cells"] == 50
    assert set(payload["clusters"]) == found and payload["dataset"] == name
    assert run.run(spark, c)[0]["status"] == "skipped" and sinks.read_report(spark, f"{folder}/out/run.latest.json")[0]["detail"] == "complete"
    stamp = (work / "peak_gene_links" / "_MANIFEST.json").stat().st_mtime_ns
    assert run.run(spark, config(folder, annotation_response=f"{folder}/answer.json", export_max_cells=40))[0]["status"] == "ok"
    assert read(out / "meta/cells.parquet").count() == 40 and (work / "peak_gene_links" / "_MANIFEST.json").stat().st_mtime_ns == stamp
    # the steps after the run work on what it left
    args = ["--backend-root", f"{folder}/out"]
    assert batch.main(["active-fraction", *args, "--work-root", f"{folder}/work"]) == 0
    active = read(out / "triplet_active_scores.with_active_cells.parquet")
    assert active.count() == read(out / "triplet_active_scores.parquet").count() > 0 and {"active_cell_count", "group_total_cells"} <= set(active.columns)
    total = {tuple(r)[:3]: r["n"] for r in read(work / "labelled").groupBy("project_id", "sample_id", "gpt_cell_type").agg(F.count("*").alias("n")).collect()}
    assert all(r["group_total_cells"] == total[r["project_id"], r["sample_id"], r["gpt_cell_type"]] for r in active.select("project_id", "sample_id", "gpt_cell_type", "group_total_cells").distinct().collect())
    assert batch.main(["dataset-filter", *args, "--summary", f"{folder}/summary.json", "--score-threshold", "0.0", "--count-threshold", "0"]) == 0
    assert read(out / "triplet_active_scores.dataset_active.parquet").count() > 0
    with pytest.raises(ValueError):
        run.run(spark, c, ["other"])
    with pytest.raises(ContractError):
        run.load(spark, c, "none_Homo_sapiens", read(work / "metadata"))


def test_stale_tables_are_made_again(spark, tmp_path):
    (tmp_path / "in.txt").write_text("1")
    made = []

    def stages(seed, fail=False):
        c = batch.PipelineConfig(data_root="x", datasets=["d"], random_seed=seed)
        s = run.Stages(spark, c, "d")
        n = lambda name: lambda: made.append((name, seed)) or {"t": spark.createDataFrame([(name, seed)], "a string, b int")}
        a = s("a", {"t": str(tmp_path / "a")}, n("a"), ("random_seed",), (), [str(tmp_path / "in.txt")])["t"]
        if fail:
            raise RuntimeError("lost")
        b = s("b", {"t": str(tmp_path / "b")}, n("b"), (), ("a",))["t"]
        return a.first()["b"], b.first()["b"]

    assert stages(1) == (1, 1) and stages(1) == (1, 1) and made == [("a", 1), ("b", 1)]
    with pytest.raises(RuntimeError):
        stages(2, fail=True)
    assert stages(2) == (2, 2)  # b, whose own settings are the same, was made from the other a
    assert made[2:] == [("a", 2), ("b", 2)]
    (tmp_path / "in.txt").write_text("22")
    assert stages(2) == (2, 2) and made[4:] == [("a", 2), ("b", 2)]


def test_answers_are_asked_again(spark):
    from heliograph.operators import metadata

    cl = spark.createDataFrame([(1, "0")], "cell int, old_cluster string")
    good = {"old_cluster": "0", "cell_type": "T", "cell_ontology_id": "CL:0000084", "confidence": "high", "tissue_consistent": True, "reason": ""}
    asked = []

    def ask(i):
        asked.append(i)
        return metadata.parse_annotations(spark.createDataFrame([(json.dumps({"annotations": [good | ({} if i else {"confidence": "sure"})]}),)], "json string"))

    assert metadata.annotate_with_retries(cl, ask).first()["gpt_cell_type"] == "T" and asked == [0, 1]


def test_empty_motif_output(spark, tmp_path):
    from heliograph.sources import readers

    (tmp_path / "e.tsv").write_text("")
    assert readers.read_motif_output(spark, str(tmp_path / "e.tsv")).count() == 0
    (tmp_path / "x.h5").write_bytes(readers.HDF5_MAGIC + b"rest")
    (tmp_path / "y.h5").write_bytes(b"no")
    assert readers.is_hdf5(spark, str(tmp_path / "x.h5")) and not readers.is_hdf5(spark, str(tmp_path / "y.h5"))


def test_publish_keeps_the_old_on_failure(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    sinks.publish(spark.range(3), path)
    with pytest.raises(sinks.EmptyOutput):
        sinks.publish(spark.range(0), path, allow_empty=False)
    assert spark.read.parquet(path).count() == 3
    sinks.publish(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["t.parquet"]
