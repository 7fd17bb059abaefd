"""Worked examples, properties and plan shapes."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from heliograph.functions import names, scores, stats
from heliograph.operators import cells, embedding, guards, intervals, metadata, motif, order, pseudobulk, ranks, sampling
from heliograph.plans import batch, catalog, views
from heliograph.sources import readers, sinks


def test_spearman_example(spark):
    x, y = [0, 0, 1, 2, 2], [0, 3, 0, 5, 4]
    f = lambda v, n: spark.createDataFrame([(f"g{i}", n, float(a)) for i, a in enumerate(v) if a], f"group_id string, {n[0]} string, value double")
    pairs = spark.createDataFrame([("peak", "gene"), ("gone", "gene")], "p string, g string")
    out = {r["p"]: r["rho"] for r in ranks.spearman(pairs, f(x, "peak").withColumnRenamed("p", "p"), f(y, "gene"), "p", "g", 5).collect()}
    assert out["peak"] == pytest.approx(0.7299963950884314)
    assert out["gone"] is None
    p = spark.createDataFrame([(out["peak"], 5), (None, 5), (0.5, 2)], "rho double, n int").select(stats.t_two_sided("rho", "n").alias("p")).collect()
    assert p[0]["p"] == pytest.approx(0.161423, abs=1e-6)
    assert p[1]["p"] is None and p[2]["p"] is None


def test_benjamini_hochberg_example(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate([0.01, 0.04, 0.03, 0.005, 0.9, None])], "i int, pvalue double")
    q = [r["qvalue_bh"] for r in ranks.benjamini_hochberg(df).orderBy("i").collect()]
    assert q[:5] == pytest.approx([0.025, 0.05, 0.05, 0.025, 0.9])
    assert q[5] is None


def test_incomplete_beta():
    a = np.array([0.5, 5.0, 61.5])
    assert stats.incomplete_beta(a, 0.5, np.array([0.0, 1.0, 0.5]))[:2].tolist() == [0.0, 1.0]
    t, df = 2.0, 10  # P(|t| > 2), 10 degrees of freedom
    assert stats.incomplete_beta(np.array([df / 2]), 0.5, np.array([df / (df + t * t)]))[0] == pytest.approx(0.0733880, abs=1e-6)


@pytest.mark.parametrize(("sizes", "most", "minimum", "want"), [([100, 30, 5], 50, 10, [31, 14, 5]), ([100, 100, 100], 50, 10, [18, 16, 16]), ([1000, 1, 1, 1], 5, 1, [2, 1, 1, 1]), ([100, 30, 5], 20, 10, [15, 4, 1]), ([3, 3, 3], 2, 1, [1, 1, 0]), ([3, 4], 10, 1, [3, 4])])
def test_allocation(spark, sizes, most, minimum, want):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "k string, size long")
    got = [r["allocated"] for r in sampling.allocation(df, most, minimum, ["k"]).orderBy("k").collect()]
    assert got == want and sum(got) == min(most, sum(sizes))


@pytest.mark.parametrize(("sizes", "want"), [([300], [5]), ([120, 260], [2, 3]), ([40, 60], [1, 1]), ([30], [1]), ([99, 49], [1, 1])])
def test_replicates(spark, sizes, want):
    g = spark.createDataFrame([(f"p{i}", "s", "c", n) for i, n in enumerate(sizes)], "project_id string, sample_id string, gpt_cell_type string, n_cells long")
    out = pseudobulk.replicate_parts(g).orderBy("project_id").collect()
    assert [r["parts"] for r in out] == want
    assert {r["pseudobulk_mode"] for r in out} == {"within_sample_split" if sum(want) > len(want) else "biological"}


def test_merge_is_idempotent_and_slack_counts(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([("c", int(a), int(a + w)) for a, w in zip(rng.integers(0, 3000, 300), rng.integers(1, 30, 300))], "chrom string, start long, end long")
    for slack in (-1, 0, 1):
        one = intervals.merge(df, slack)
        assert sorted(map(tuple, intervals.merge(one, slack).collect())) == sorted(map(tuple, one.collect()))
    n = [intervals.merge(df, s).count() for s in (-1, 0, 1)]
    assert n[0] >= n[1] >= n[2]


def test_bin_join_has_no_nested_loop(spark):
    a = spark.range(10).select(F.lit("c").alias("chrom"), F.col("id").alias("start"), (F.col("id") + 5).alias("end"))
    plan = intervals.overlap_join(a, a, 4)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scores_and_names(spark):
    r = spark.range(1).select(
        scores.active_score(F.lit(0.8), F.lit(0.6), F.lit(0.4)).alias("a"),
        scores.weighted_score(F.lit(0.5768998), F.lit(0.6), F.lit(0.9)).alias("w"),
        scores.weighted_score(F.lit(0.5), F.lit(0.6), F.lit(-0.9)).alias("none"),
        names.fasta_id(F.lit(">x::chr1:2-3")).alias("id"),
        names.parse_peak(F.lit("bad")).alias("p"),
    ).first()
    assert r["a"] == pytest.approx(0.5768998) and r["w"] == pytest.approx(0.4239331) and r["none"] is None and r["id"] == "x" and r["p"] is None


def test_guards(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(guards.ContractError):
        guards.require_columns(df, "nope")
    with pytest.raises(guards.ContractError):
        guards.require_unique(df, "k")
    with pytest.raises(guards.ContractError):
        guards.many_to_one(df, spark.createDataFrame([(2, 1)], "k int, w int"), ["k"])


def test_mtx_and_publish(spark, tmp_path):
    d = tmp_path / "m"
    d.mkdir()
    (d / "barcodes.tsv").write_text("A\nB\n")
    (d / "features.tsv").write_text("g1\tG1\tGene Expression\ng2\tG1\tGene Expression\np1\tchr1:1-5\tPeaks\n")
    (d / "matrix.mtx").write_text("%%MatrixMarket\n3 2 4\n1 1 5\n2 1 7\n3 1 2\n3 2 1\n")
    assert readers.matrix_kind(spark, f"file://{d}") == "mtx"
    m = readers.read_mtx(spark, f"file://{d}")
    assert m.count() == 4
    rna, atac = readers.clean_modalities(m)
    assert [tuple(r) for r in rna.collect()] == [("A", "G1", 5.0)] and [tuple(r) for r in atac.collect()] == [("A", "chr1:1-5", 2.0)]
    out = f"file://{tmp_path}/out"
    sinks.write_sparse(rna, "gene", out, out + "-index")
    assert sinks.is_complete(spark, out, ("cell", "gene", "value"))
    with pytest.raises(sinks.EmptyOutput):
        sinks.write_sparse(rna.limit(0), "gene", out, out + "-index")
    assert spark.read.parquet(out).count() == 1


def test_gtf_and_fasta(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('#!x\n1\ts\tgene\t10\t20\t.\t-\t.\tgene_name "A"; gene_type "protein_coding";\n1\ts\ttranscript\t10\t20\t.\t-\t.\tgene_name "A"; gene_name "B"; gene_biotype "protein_coding";\nbad line\n')
    g, b = readers.read_gtf(spark, f"file://{tmp_path}/a.gtf")
    assert [tuple(r) for r in g.collect()] == [("A", "chr1", 20, "-")] and [tuple(r) for r in b.collect()] == [("B", "chr1", 10, 20)]
    (tmp_path / "a.fa").write_text(">c1 x\nACGT\nAC\n>c2\nTT\n")
    assert {r["contig"]: r["sequence"] for r in readers.read_fasta(spark, f"file://{tmp_path}/a.fa").collect()} == {"c1": "ACGTAC", "c2": "TT"}


def test_sequences_across_pieces(spark, tmp_path):
    n = intervals.CHUNK
    rng = np.random.default_rng(7)
    bases = {"a": "".join(rng.choice(list("ACGT"), 2 * n + 90)), "b": "".join(rng.choice(list("ACGT"), n)), "c": "ACGT"}
    folded = lambda s, width: "\n".join(s[i : i + width] for i in range(0, len(s), width))
    (tmp_path / "g.fa").write_text(f">a one\n{folded(bases['a'], 61)}\n\n>b\n{bases['b']}\n>none\n>c\n{folded(bases['c'], 3)}\n")
    genome = readers.read_fasta(spark, f"file://{tmp_path}/g.fa").cache()
    rows = sorted((r["contig"], r["at"], r["sequence"]) for r in genome.collect())
    assert rows == sorted((c, i, s[i : i + n]) for c, s in bases.items() for i in range(0, len(s), n))
    places = [("a", 0, 5), ("a", n - 3, n + 4), ("a", n - 3, n + 4), ("a", n - 1, 2 * n + 90), ("a", n, n), ("b", n - 2, n), ("c", 1, 4)]
    wrong = [("a", 5, 2 * n + 91), ("a", -1, 4), ("none", 0, 1), ("z", 0, 1), (None, 0, 1), ("a", None, 4)]
    peaks = spark.createDataFrame([(i, *x) for i, x in enumerate(places + wrong)], "peak int, chrom string, start long, end long")
    whole = spark.createDataFrame(list(bases.items()), "contig string, sequence string")
    for contigs in (genome, whole):
        got, lost = intervals.extract_sequences(peaks, contigs)
        assert {r["peak"]: r["sequence"] for r in got.collect()} == {i: bases[c][s:e] for i, (c, s, e) in enumerate(places)}
        assert sorted(r["peak"] for r in lost.collect()) == list(range(len(places), len(places) + len(wrong)))
        assert set(got.columns) == {*peaks.columns, "sequence"} and lost.columns and "sequence" not in lost.columns
    assert intervals.extract_sequences(peaks.limit(0), genome)[0].count() == 0 and readers.parse_fasta(spark.createDataFrame([], "line_no long, value string")).count() == 0


def test_motif_scan(spark):
    p = np.full((6, 4), 0.01)
    p[np.arange(6), [0, 1, 2, 3, 0, 2]] = 0.97
    seq = spark.createDataFrame([("x", "TTTACGTAGTTT"), ("y", "CTACGTAAAAA"), ("n", None)], "peak string, sequence string")
    hits = {(r["peak"], r["start"], r["strand"]) for r in motif.scan(seq, {"m": p}, 1e-3).collect()}
    assert ("x", 3, "+") in hits and ("y", 0, "-") in hits
    _, _, tail = motif.score_tail(motif.log_odds(p))
    assert tail[0] == pytest.approx(1.0) and tail[-1] == pytest.approx(0.25**6)
    assert motif.rungs(0.5, 0.5) == [(0.5, 0.5), (0.25, 0.5), (0.25, 0.25), (0.1, 0.25)]
    assert motif.rungs(0.2, 0.3) == [(0.2, 0.3), (0.1, 0.25)]


def test_clusters_find_two_cliques(spark):
    edges = [(a, b, 1.0) for s in (0, 10) for a in range(s, s + 6) for b in range(s, s + 6) if a != b] + [(0, 10, 0.1), (10, 0, 0.1)]
    c = {r["id"]: r["cluster"] for r in embedding.clusters(spark.createDataFrame(edges, "src long, dst long, weight double"), 4).collect()}
    assert len({c[i] for i in range(6)}) == 1 and c[0] != c[10]


def test_annotation_contract(spark):
    cl = spark.createDataFrame([(1, "0"), (2, "1")], "cell int, old_cluster string")
    a = lambda ident: spark.createDataFrame([("0", "T", ident, "high", True, ""), ("1", "B", "CL:0000236", "low", False, "")], "old_cluster string, cell_type string, cell_ontology_id string, confidence string, tissue_consistent boolean, reason string")
    with pytest.raises(guards.ContractError):
        metadata.label_cells(cl, a("CL:84"))
    out = metadata.annotate_with_retries(cl, lambda i: a("CL:84" if i == 0 else "CL:0000084"))
    assert {r["gpt_cell_type"] for r in out.collect()} == {"T", "B"}


def test_batch_and_config(tmp_path):
    def work(d):
        if d == "b":
            raise ValueError("x")
        return "no input" if d == "c" else None

    assert [r["status"] for r in batch.run_datasets(["a", "b", "c"], work)] == ["ok", "failed", "skipped"]
    (tmp_path / "c.json").write_text('{"data_root": "d", "datasets": ["x"], "thresholds": {"motif_pvalue": 0.1}, "gtf_by_dataset": {"x": "o"}, "gtf_by_organism": {"any": "p"}, "fimo_jobs": 4}')
    c = batch.PipelineConfig.from_json(str(tmp_path / "c.json"))
    assert c.thresholds.motif_pvalue == 0.1 and c.gtf("x", "any") == "o" and c.gtf("y", "any") == "p"
    with pytest.raises(ValueError):
        batch.PipelineConfig(data_root="d", datasets=[])


def test_variance_of_sparse(spark):
    f = spark.createDataFrame([(1, "a", 2.0), (2, "a", 4.0)], "cell int, gene string, value double")
    r = cells.variance_stats(f, "gene", 4).first()
    assert r["mean"] == 1.5 and r["variance"] == pytest.approx(np.var([2, 4, 0, 0], ddof=1))


def test_numbered_in_ranges(spark):
    x = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"))
    rows = sorted((r["h"], r["id"], r["g"]) for r in x.collect())
    assert {r["id"]: r["n"] for r in order.numbered(x, ["h", "id"]).collect()} == {k: i + 1 for i, (_, k, _) in enumerate(rows)}
    want = {k: i + 1 for g in (None, 0, 1, 2) for i, k in enumerate(k for _, k, v in rows if v == g)}
    assert {r["id"]: r["n"] for r in order.numbered(x, ["h", "id"], ("g",)).collect()} == want
    assert order.numbered(x.limit(0), ["h", "id"]).count() == 0


def test_whole_tables(spark):
    d = "/root/testdata/sf0.001"
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    assert catalog.QUERIES["wn10_sequential_id"](spark, d).count() == lines.count()
    assert {r["peak"] for r in catalog.QUERIES["jn5_motif_to_tf"](spark, d).collect()} == {r[0] for r in lines.select("l_suppkey").distinct().collect()}
    got = catalog.QUERIES["sm2_pseudo_replicates"](spark, d).collect()
    assert sum(r["n"] for r in got) == spark.read.parquet(f"{d}/orders.parquet").count() and len(got) > 2
    plan = catalog.QUERIES["wn10_sequential_id"](spark, d)._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(_range" in plan and "SinglePartition" not in plan.split("windowspecdefinition(_range")[0]


def test_joint_detection_of_all_peaks(spark):
    d = "/root/testdata/sf0.001"
    want = {r["peak"] for r in views.hits(spark, d).filter("motif_pvalue < 0.01").join(views.links(spark, d), "peak").select("peak").distinct().collect()}
    got = {r["peak"] for r in catalog.QUERIES["jn17_joint_detection"](spark, d).select("peak").distinct().collect()}
    assert got == want and any(p % 10 != 1 for p in got)
