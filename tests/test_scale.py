"""Operators that carry over ranges, factor, search and cluster, against plain versions and by their properties."""

import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliograph.operators import activity, cells, communities, cut, embedding, factor, intervals, motif, neighbours, order, ranks, regulatory, sampling
from heliograph.plans import batch


@pytest.fixture(autouse=True)
def ranges(spark):
    """Small tables lie in several ranges here, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_scanned_against_a_loop(spark):
    rng = np.random.default_rng(1)
    rows = [(str(b), int(k), None if rng.random() < 0.6 else int(v)) for b, k, v in zip(rng.integers(0, 2, 400), rng.permutation(400), rng.integers(0, 99, 400))]
    df = spark.createDataFrame(rows, "b string, k long, v long").repartition(5)
    x = order.ranged(df, ["b", "k"])
    assert x.select("_range").distinct().count() > 2
    got = {(r["b"], r["k"]): (r["m"], r["l"], r["n"]) for r in order.scanned(x, ["k"], ("b",), m=("max", F.col("v")), l=("last", F.col("v")), n=("next", F.col("v"))).collect()}
    for b in "01":
        mine = sorted((k, v) for c, k, v in rows if c == b)
        for i, (k, _) in enumerate(mine):
            before = [v for _, v in mine[:i] if v is not None]
            upto, later = [v for _, v in mine[: i + 1] if v is not None], [v for _, v in mine[i:] if v is not None]
            assert got[b, k] == (max(before, default=None), upto[-1] if upto else None, later[0] if later else None)


def test_nearest_meets_two_points_a_peak(spark):
    rng = np.random.default_rng(2)
    peaks = [("c" if i % 3 else "d", int(a), int(a + w)) for i, (a, w) in enumerate(zip(rng.integers(0, 5000, 80), rng.integers(1, 60, 80)))]
    points = [(f"g{i}", "c" if i % 2 else "d", int(p)) for i, p in enumerate(rng.integers(0, 5200, 150))] + [("a0", "c", 100), ("a1", "c", 100), ("n", None, 5)]
    p, g = spark.createDataFrame(peaks, "chrom string, start long, end long"), spark.createDataFrame(points, "gene string, chrom string, tss long")
    want = set()
    for c, s, e in set(peaks):
        d = lambda t: s - t if s > t else e - t if e < t else 0  # noqa: B023,E731
        best = min(((abs(d(t)), t, n, d(t)) for n, k, t in points if k == c and abs(d(t)) <= 40), default=None)
        if best:
            want.add((c, s, e, best[2], best[1], best[3]))
    out = intervals.nearest_join(p, g, 40)
    assert {tuple(r) for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(chrom#" not in plan.split("_range")[0]
    # however many points lie around a peak, no join makes a row for each: rows are peaks and points
    many = spark.range(50_000).select(F.lit("x").alias("gene"), F.lit("c").alias("chrom"), F.col("id").alias("tss"))
    assert intervals.nearest_join(p, many, 200_000).count() == len({x for x in peaks if x[0] == "c"})


@pytest.mark.parametrize("many", ["a", "b"])
def test_overlaps_are_dealt_by_their_pairs(spark, monkeypatch, many):
    rng = np.random.default_rng(6)
    monkeypatch.setattr(order, "ROWS", 50)
    made = lambda n, at: [(i, "c" if i % 9 else "d", int(s), int(s + w)) for i, (s, w) in enumerate(zip(rng.integers(0, at, n), rng.integers(1, 20, n)))]
    a, b = made(200 if many == "a" else 40, 60), made(40 if many == "a" else 200, 60)
    df = lambda rows, i: spark.createDataFrame(rows, f"{i} long, chrom string, start long, end long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")  # as users have it: tables of few bytes come to one task
    out = intervals.overlap_join(df(a, "i"), df(b, "j"), 30).select("i", "j")
    want = sorted((i, j) for i, c, s, e in a for j, d, f, g in b if c == d and s < g and f < e)
    assert sorted(map(tuple, out.collect())) == want
    rows = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert out.rdd.getNumPartitions() >= len(want) / 50 and max(rows) < len(want) / 4


def test_scores_of_shared_means_are_dealt_by_their_rows(spark, monkeypatch):
    rng = np.random.default_rng(7)
    monkeypatch.setattr(order, "ROWS", 40)
    c = spark.createDataFrame([(i, "p", f"s{i % 5}", "t") for i in range(100)], "cell long, project_id string, sample_id string, gpt_cell_type string")
    fact = lambda f, n: spark.createDataFrame([(i, f"{f[0]}{j}", float(rng.integers(1, 9))) for i in range(100) for j in range(n) if rng.random() < 0.06], f"cell long, {f} string, value double")
    r, a = fact("gene", 6).localCheckpoint(), fact("peak", 8).localCheckpoint()
    rows = [(f"g{k % 5}", f"p{k % 8}", f"g{k % 6}", 0.5, 0.01, 0.5, 1e-6) for k in range(60)] + [("none", "p0", "g1", 0.5, 0.01, 0.5, 1e-6)]
    trip = spark.createDataFrame(rows, "tf string, peak string, gene string, spearman double, qvalue_bh double, tf_gene_spearman double, motif_pvalue double")
    m = regulatory.means_of(r, a, c)
    assert m.mode == "biological" and m.n == 5
    out = regulatory.active_scores(trip, r, a, c, means=m)
    got = out.collect()
    mean = {(f, x[f], x["group_id"]): x["value"] for f, d in (("gene", m.gene), ("peak", m.peak)) for x in d.collect()}
    share = {}
    for f, k, g in mean:
        v = [mean.get((f, k, f"p\x1fs{i}\x1ft\x1f0"), 0.0) for i in range(5)]
        share[f, k, g] = (sum(x < mean[f, k, g] for x in v) + (sum(x == mean[f, k, g] for x in v) + 1) / 2) / 5
    assert len(got) == 5 * len(rows)
    for x in got:
        g = f"p\x1f{x['sample_id']}\x1ft\x1f0"
        at = [("gene", x["tf"], g), ("peak", x["peak"], g), ("gene", x["gene"], g)]
        assert [x["tf_pseudobulk_mean"], x["peak_pseudobulk_mean"], x["gene_pseudobulk_mean"]] == pytest.approx([mean.get(k, 0.0) for k in at])
        assert x["active_score"] == pytest.approx(np.prod([share.get(k, 0.0) for k in at]) ** (1 / 3))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(group_id" not in plan and out.rdd.getNumPartitions() >= len(got) / 40
    key = lambda x: tuple(map(str, x))
    assert sorted(got, key=key) == sorted(regulatory.active_scores(trip, r, a, c).collect(), key=key)
    pairs = spark.createDataFrame([(f"p{i}", f"g{j}") for i in range(8) for j in range(6)], "peak string, gene string")
    links = [regulatory.peak_gene_links(r, a, c, pairs, means=x).collect() for x in (None, m)]
    assert sorted(links[0], key=key) == sorted(links[1], key=key) and len(links[0]) == 48


def test_merge_against_a_loop(spark):
    rng = np.random.default_rng(3)
    rows = [("c" if i % 4 else "d", int(a), int(a + w)) for i, (a, w) in enumerate(zip(rng.integers(0, 4000, 500), rng.integers(1, 40, 500)))] + [("c", 0, 4100)] * 2
    for slack in (-1, 0, 2):
        want = set()
        for c in "cd":
            at = None
            for s, e in sorted((s, e) for k, s, e in rows if k == c):
                if at is not None and s <= at[1] + slack:
                    at[1] = max(at[1], e)
                else:
                    if at:
                        want.add((c, *at))
                    at = [s, e]
            want.add((c, *at))
        df = spark.createDataFrame(rows, "chrom string, start long, end long")
        assert {tuple(r) for r in intervals.merge(df, slack).collect()} == want


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_benjamini_hochberg_against_a_loop(spark, n):
    rng = np.random.default_rng(n)
    p = np.round(rng.random(n), 2)
    p[rng.random(n) < 0.4] = 1.0
    rows = [(i, f"k{i % 2}", None if i % 11 == 5 else float(v)) for i, v in enumerate(p)]
    df = spark.createDataFrame(rows, "i long, k string, pvalue double").repartition(4)
    for by in ((), ("k",)):
        want = {i: None for i, _, v in rows}
        for g in {k for _, k, _ in rows} if by else {None}:
            some = sorted((v, i) for i, k, v in rows if v is not None and g in (None, k))
            low = 1.0
            for r in range(len(some), 0, -1):
                low = min(low, some[r - 1][0] * len(some) / r)
                want[some[r - 1][1]] = low
        got = {r["i"]: r["q"] for r in ranks.benjamini_hochberg(df, q="q", by=by).collect()}
        assert set(got) == set(want)
        assert all((got[i] is None) == (want[i] is None) and (want[i] is None or abs(got[i] - want[i]) < 1e-12) for i in want)


def test_median(spark):
    rng = np.random.default_rng(4)
    for n in (1, 2, 9, 1000):
        v = np.concatenate([rng.lognormal(0, 4, n), [7.0] * (n // 2)])
        df = spark.createDataFrame([(float(x),) for x in v], "v double").groupBy("v").agg(F.count("*").alias("n"))
        assert cells.median(df, "v", "n", bins=8) == np.median(v)
    assert cells.median(df.limit(0), "v", "n") is None


def test_svd_by_a_randomised_range(spark):
    rng = np.random.default_rng(5)
    n, m, k = 6000, 1200, 6  # six kinds of cells, each with genes of its own
    i = np.repeat(np.arange(n), 40)
    j = (i % 6) * 200 + rng.integers(0, 200, len(i))
    dense = np.zeros((n, m))
    np.add.at(dense, (i, j), 1 + 0.1 * (i % 6))
    import pandas as pd

    at = np.nonzero(dense)
    fact = spark.createDataFrame(pd.DataFrame({"cell": [f"c{x:05}" for x in at[0]], "gene": [f"g{x:05}" for x in at[1]], "value": dense[at]}))
    scores, s, loadings = factor.svd(fact, "gene", k, rounds=2)
    w = np.linalg.svd(dense, compute_uv=False)[:k]
    assert np.allclose(s, w, rtol=2e-3)
    x = np.array([r["x"] for r in scores.orderBy("cell").collect()])
    y = np.array([r["x"] for r in loadings.orderBy("gene").collect()])
    assert np.allclose(y.T @ y, np.eye(k), atol=1e-9)  # orthonormal
    assert np.allclose(x.T @ x, np.diag(s**2), atol=1e-6 * s[0] ** 2)
    best = np.linalg.norm(dense, "fro") ** 2 - (w**2).sum()
    assert np.linalg.norm(dense - x @ y.T, "fro") ** 2 <= 1.001 * best  # the subspace is as good as the best


def test_svd_of_many_features_and_of_few(spark):
    wide = spark.range(60_000).select((F.col("id") % 40).alias("cell"), (F.col("id") * 7919 % 32_003).alias("peak"), (F.col("id") % 7 + 1.0).alias("value")).groupBy("cell", "peak").agg(F.sum("value").alias("value"))
    scores, s, loadings = factor.svd(wide, "peak", 5)
    assert scores.count() == 40 and loadings.count() == wide.select("peak").distinct().count() > 30_000
    few = spark.createDataFrame([(c, f, float(c * f + (c == f))) for c in range(1, 9) for f in range(1, 4)], "cell long, f long, value double")
    x = {r["cell"]: r["x"] for r in factor.truncated_svd(few, "f", 3).collect()}
    for c in x:  # of full rank: lengths are kept
        assert abs(sum(v * v for v in x[c]) - sum((c * f + (c == f)) ** 2 for f in range(1, 4))) < 1e-6
    with pytest.raises(ValueError):
        factor.svd(few.filter("f = 1"), "f", 5)


def test_svd_of_few_features_is_exact_and_keeps_no_thin_matrix(spark, monkeypatch):
    monkeypatch.setattr(factor, "CELLS", 16)
    monkeypatch.setattr(factor, "FAN", 2)
    written = []
    monkeypatch.setattr(factor, "cut", lambda df: written.append(df) or cut.cut(df))
    rng = np.random.default_rng(14)
    dense = rng.integers(0, 3, (300, 25)).astype(float)  # a flat spectrum
    dense[7] = 0
    name = lambda j: None if j == 4 else f"g{j:02}"
    rows = [(None if i == 9 else int(i), name(j), float(dense[i, j])) for i, j in np.ndindex(dense.shape)]  # zeros too
    fact = spark.createDataFrame(rows, "cell long, gene string, value double").repartition(7, "cell")
    scores, s, loadings = factor.svd(fact, "gene", 5)
    u, w, vt = np.linalg.svd(dense, full_matrices=False)
    sign = np.sign(vt[np.arange(5), np.abs(vt[:5]).argmax(1)])
    assert np.allclose(s, w[:5], rtol=1e-12)
    got = {r["cell"]: r["x"] for r in scores.collect()}
    want = {None if i == 9 else i: u[i, :5] * w[:5] * sign for i in range(300) if i != 7}
    assert scores.dtypes == [("cell", "bigint"), ("x", "array<double>")] and got.keys() == want.keys()
    assert np.allclose([got[c] for c in want], list(want.values()), atol=1e-8)
    load = {r["gene"]: r["x"] for r in loadings.collect()}
    assert np.allclose([load[name(j)] for j in range(25)], vt[:5].T * sign, atol=1e-8)
    assert not written
    assert factor.truncated_svd(fact.filter("cell < 3"), "gene", 5).first()["x"].__len__() == 3  # no more than there are cells


def test_approximate_neighbours(spark):
    rng = np.random.default_rng(6)
    x = (rng.standard_normal((40, 30)) * 2)[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 30))
    x[:1300] = x[0]  # a third of all are equal
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, x array<double>")
    of = lambda df: {r["src"]: r["d"] for r in df.groupBy("src").agg(F.sort_array(F.collect_list("distance")).alias("d")).collect()}
    exact, found = of(embedding.knn(v, 10)), of(neighbours.approximate_knn(v, 10, leaf=256))
    assert set(found) == set(exact) and {len(d) for d in found.values()} == {10}
    hits = [np.mean(np.array(found[i]) <= exact[i][-1] + 1e-9) for i in exact]
    assert np.mean(hits) >= 0.95
    assert neighbours.approximate_knn(v.limit(0)).count() == 0


def test_exact_neighbours_of_blocks_and_copies(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(-3, 4, (1500, 3)).astype(float)  # many equal vectors and many equal distances
    x[:20] *= 1e3
    ids = rng.permutation(1500) * 7
    v = spark.createDataFrame([(int(i), r.tolist()) for i, r in zip(ids, x)], "id long, x array<double>")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    want = set()
    for q in range(1500):
        o = [j for j in np.lexsort((ids, d[q])) if j != q][:4]
        want |= {(int(ids[q]), int(ids[j]), round(float(d[q, j]), 6), r + 1) for r, j in enumerate(o)}
    for block in (512, 8192):
        assert {(r["src"], r["dst"], round(r["distance"], 6), r["rank"]) for r in embedding.knn(v, 4, block).collect()} == want
    found = embedding.knn(v.limit(3), 4)
    assert found.count() == 6 and embedding.knn(v.limit(1), 4).count() == 0 and embedding.knn(v.limit(0), 4).count() == 0


def test_exact_neighbours_of_copies(spark):
    """Equal vectors meet once: 30,000 copies of 40 vectors are no more work than 40."""
    v = spark.range(30_000).select("id", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: ((F.col("id") % 40) * (i + 1) % 41).cast("double")).alias("x"))
    got = embedding.knn(v, 3).filter("src = 40 or src = 29999")
    assert {(r["src"], r["dst"], r["distance"]) for r in got.collect()} == {(40, 0, 0.0), (40, 80, 0.0), (40, 120, 0.0), (29999, 39, 0.0), (29999, 79, 0.0), (29999, 119, 0.0)}


def test_approximate_neighbours_of_noise_are_measured(spark):
    x = np.random.default_rng(9).standard_normal((3000, 40))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, x array<double>")
    exact = embedding.knn(v, 10)
    found = neighbours.approximate_knn(v, 10, trees=2, leaf=64)
    assert found.join(exact, ["src", "dst"]).count() >= 0.9 * exact.count()
    assert neighbours.share_found(v, exact, 10) == 1.0
    assert abs(neighbours.share_found(v, exact.filter("rank <= 5"), 10) - 0.5) < 1e-9


def test_approximate_neighbours_of_copies(spark):
    """Equal vectors are compared once, so that of a class larger than a block the smallest ids are found."""
    x = np.random.default_rng(15).standard_normal((60, 8)) * 3
    v = spark.createDataFrame([(i, x[i % 60].tolist()) for i in range(6000)], "id long, x array<double>")
    found = neighbours.approximate_knn(v, 5, leaf=32)
    rows = lambda df: {(r["src"], r["dst"], r["rank"]) for r in df.collect()}
    assert rows(found) == rows(embedding.knn(v, 5))
    few = v.filter("id < 120")  # two of each: the others come from other vectors
    hit = neighbours.approximate_knn(few, 5, leaf=32).join(embedding.knn(few, 5), ["src", "dst"]).count()
    assert hit >= 0.9 * 600


def test_noise_is_told_before_blocks_are_compared(spark, monkeypatch):
    x = np.random.default_rng(16).standard_normal((2500, 40))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, x array<double>")
    exact = embedding.knn(v, 10)

    def fail(*_):
        raise AssertionError

    with monkeypatch.context() as m:
        m.setattr(neighbours, "_within", fail)
        m.setattr(embedding, "knn", fail)  # it is at hand
        assert neighbours.approximate_knn(v, 10, trees=2, leaf=64, exact=exact) is exact
    # the sample tells of all rows what their blocks hold
    placed = neighbours.blocks(v, 2, 64, 0)
    drawn = neighbours._drawn(v, 256, 0)
    near = neighbours._within(placed, v, 10)
    assert abs(neighbours.share_found(v, neighbours._met(placed, v, drawn), 10) - neighbours.share_found(v, near, 10)) < 1e-9


def rings(spark, groups, size, seed):
    rng = np.random.default_rng(seed)
    e = []
    for g in range(groups):
        ids = g * size + np.arange(size)
        e += [(int(a), int(b), 1.0) for a in ids for b in rng.choice(ids, 4) if a != b]
    e += [(int(a), int(b), 1.0) for a, b in rng.integers(0, groups * size, (groups * 6, 2)) if a != b]
    return spark.createDataFrame([*e, *[(b, a, w) for a, b, w in e]], "src long, dst long, weight double").dropDuplicates(["src", "dst"])


def test_communities(spark):
    edges = rings(spark, 8, 25, 7)
    found = communities.communities(edges)
    label = {r["id"]: r["cluster"] for r in found.collect()}
    assert len(label) == edges.select("src").distinct().count()
    q = communities.modularity(edges, found)
    assert q >= communities.modularity(edges, embedding.clusters(edges, 8)) - 1e-9 and q > 0.6
    assert 6 <= len(set(label.values())) <= 10
    inner = edges.join(found.select(F.col("id").alias("src"), F.col("cluster").alias("a")), "src").join(found.select(F.col("id").alias("dst"), F.col("cluster").alias("b")), "dst").filter("a = b")
    parts = communities.connected(inner, found.select("id")).join(found, "id").groupBy("cluster").agg(F.count_distinct("part").alias("n"))
    assert parts.filter("n > 1").count() == 0
    sizes = [int(r["n"]) for r in found.groupBy("cluster").count().withColumnRenamed("count", "n").orderBy(F.col("cluster").cast("int")).collect()]
    assert sizes == sorted(sizes, reverse=True)
    assert len({r["cluster"] for r in communities.communities(edges, resolution=0.02, levels=3).collect()}) < len(set(label.values()))


def test_stratified_ranks_few_rows(spark):
    df = spark.range(200_000).select(F.col("id").alias("cell"), F.when(F.col("id") % 1000 == 0, "small").when(F.col("id") < 40, "tiny").otherwise("large").alias("k"))
    out = sampling.stratified(df, 900, 30, ["k"], seed=3)
    got = {r["k"]: (r["n"], r["m"]) for r in out.groupBy("k").agg(F.count("*").alias("n"), F.count_if("selected").alias("m")).collect()}
    allocated = {r["k"]: r["allocated"] for r in sampling.allocation(df.groupBy("k").agg(F.count("*").alias("size")), 900, 30, ["k"]).collect()}
    assert {k: m for k, (_, m) in got.items()} == allocated and out.count() == 200_000
    hashed = [F.xxhash64(F.lit(3), "cell"), F.col("cell")]  # the same draw as by ranking everything
    assert sampling.stratified(df, 900, 30, ["k"], order=hashed).exceptAll(out).count() == 0


def test_workers_overlap_and_fail_alone(spark):
    meet, seen = threading.Barrier(3, timeout=60), []

    def work(d):
        seen.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        if d != "bad":
            meet.wait()  # passes only if three run at a time
        if d == "bad":
            raise RuntimeError("x")
        return None if spark.range(10).count() == 10 and d != "c" else "nothing"

    told = []
    rows = batch.run_datasets(["a", "b", "bad", "c"], work, told.append, workers=4, spark=spark)
    assert [(r["dataset"], r["status"]) for r in rows] == [("a", "ok"), ("b", "ok"), ("bad", "failed"), ("c", "skipped")]
    assert sorted(seen) == ["a", "b", "bad", "c"] and len(told) == 4
    began = time.time()
    assert [r["status"] for r in batch.run_datasets(["a"], lambda d: "x")] == ["skipped"] and time.time() - began < 5


@pytest.mark.parametrize("dense", [True, False])
def test_joint_detection_from_either_side(spark, dense):
    rng = np.random.default_rng(11)
    cells_n, trips = (60, 300) if dense else (12, 6)
    fact = lambda f, n: {(int(c), f"{f}{x}") for c, x in zip(rng.integers(0, cells_n, n), rng.integers(0, 8, n))}
    rna, atac = fact("g", 150), fact("p", 120)
    trip = {(f"g{a}", f"p{b}", f"g{c}") for a, b, c in rng.integers(0, 8, (trips, 3))}
    of = {c: ("x", f"s{c % 2}", f"t{c % 3}") for c in range(cells_n)}
    want = {}
    for c, key in of.items():
        for t, p, g in trip:
            if (c, t) in rna and (c, p) in atac and (c, g) in rna:
                want[key, t, p, g] = want.get((key, t, p, g), 0) + 1
    group = "project_id string, sample_id string, gpt_cell_type string"
    table = spark.createDataFrame([(c, *k) for c, k in of.items()], f"cell long, {group}")
    df = lambda x, f: spark.createDataFrame([(*r, 1.0) for r in x] + [(0, f"{f[0]}7", 0.0)], f"cell long, {f} string, value double")
    got = activity.joint_counts(spark.createDataFrame(list(trip) * 2, "tf string, peak string, gene string"), df(rna, "gene"), df(atac, "peak"), table)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("array_intersect" in plan) == dense
    if dense:  # what triplets and cells multiply to is not dealt again
        assert "hashpartitioning(tf#" not in plan and "hashpartitioning(gene#" not in plan
        w = got.withColumn("dataset", F.lit("d"))
        for out in (activity.dataset_filter(w, 0.01, 1), activity.filter_summary(w, 0.01, 1)):
            assert "hashpartitioning(dataset#" not in (text := out._jdf.queryExecution().executedPlan().toString()) and "hashpartitioning(tf#" not in text
        kept = activity.dataset_filter(w, 0.01, 1)
        summary = activity.filter_summary(w, 0.01, 1).first()
        assert (summary["source_rows"], summary["kept_rows"], summary["kept_keys"]) == (len(want), kept.count(), kept.select(*activity.KEYS).distinct().count())
    assert {((r["project_id"], r["sample_id"], r["gpt_cell_type"]), r["tf"], r["peak"], r["gene"]): r["active_cell_count"] for r in got.collect()} == want


def test_gene_activity_carries_arrays(spark):
    a = spark.createDataFrame([(1, "p", 2.0), (1, "q", 3.0), (2, "p", 4.0), (3, None, 1.0)], "cell long, peak string, value double")
    links = spark.createDataFrame([("p", "g"), ("p", "h"), ("q", "g"), ("q", "g"), ("q", None)], "peak string, gene string")
    out = activity.gene_activity(a, links)
    assert {(r["gene"], r["cell"]): r["activity"] for r in out.collect()} == {("g", 1): 8.0, ("h", 1): 2.0, ("g", 2): 4.0, ("h", 2): 4.0, (None, 1): 3.0}
    assert "hashpartitioning(gene#" not in out._jdf.queryExecution().executedPlan().toString()
    assert activity.gene_activity(a.limit(0), links).count() == 0 and activity.gene_activity(a, links.limit(0)).count() == 0


def test_annotation_deals_no_promoter_rows(spark):
    peaks = spark.createDataFrame([("c", 10, 20), ("c", 30, 35)], "chrom string, start long, end long")
    genes = spark.createDataFrame([("g", "c", 12, "+"), ("h", "c", 40, "+"), ("h", "c", 500, "+"), (None, "c", 33, "-")], "gene string, chrom string, tss long, strand string")
    bodies = spark.createDataFrame([("g", "c", 12, 40), ("k", "c", 11, 12), (None, "c", 30, 34)], "gene string, chrom string, start long, end long")
    out = intervals.annotate(peaks, genes, bodies, 5, 2, 100)
    near = {("c", 10, 20, "g", 0, "promoter"), ("c", 30, 35, None, 0, "promoter"), ("c", 30, 35, "g", 0, "distal"), ("c", 10, 20, "k", 0, "distal"), ("c", 30, 35, "h", 0, "promoter")}
    assert {tuple(r) for r in out.collect()} == near - {("c", 30, 35, "h", 0, "promoter")}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("Union")  # the window is below one side only


@pytest.mark.parametrize("names", [400, 12])
def test_annotation_against_a_loop(spark, names):
    """Promoters and bodies are met in one join; nothing is dealt by (peak, gene) but the nearest genes and genes of several bodies or windows."""
    rng = np.random.default_rng(13)
    peaks = [("c" if i % 3 else "d", int(a), int(a + w)) for i, (a, w) in enumerate(zip(rng.integers(0, 600, 90), rng.integers(1, 25, 90)))] + [(None, 1, 9)]
    name = (lambda i: f"g{i}") if names == 400 else (lambda i: f"g{i % names}" if i % names else None)
    chrom = lambda i: "d" if i % 5 == 0 else "c"
    genes = [(name(i), chrom(i), int(t), "+" if i % 2 else "-") for i, t in enumerate(rng.integers(0, 640, 70))] + [("n", "c", None, "+"), ("m", None, 9, "+")]
    bodies = [(name(i), chrom(i), max(0, g[2] - 30), g[2] + int(w)) for i, (g, w) in enumerate(zip(genes, rng.integers(1, 60, 60)))] + [("b", "c", 5, 300), ("m", None, 0, 99), ("v", "c", None, 3)]
    wide = [(g, c, max(0, t - (20 if s == "+" else 3)), t + (3 if s == "+" else 20)) for g, c, t, s in genes if c and t is not None]
    want = []
    for c, s, e in {p for p in peaks if None not in p}:
        near = [g for g, k, a, b in wide if k == c and s < b and a < e]
        want += [(c, s, e, g, 0, "promoter") for g in near]
        d = lambda t: s - t if s > t else e - t if e < t else 0  # noqa: B023,E731
        rest = {g: 0 for g, k, a, b in bodies if k == c and a is not None and s < b and a < e}
        point = min(((abs(d(t)), t, g is None, g or "", d(t)) for g, k, t, _ in genes if k == c and t is not None and abs(d(t)) <= 40), default=None)
        if point:
            at = [g for g, k, t, _ in genes if k == c and t == point[1] and g is not None]
            rest[min(at, default=None)] = point[4]
        want += [(c, s, e, g, x, "distal") for g, x in rest.items() if g not in near]
    df = lambda rows, t: spark.createDataFrame(rows, t)
    out = intervals.annotate(df([*peaks, *peaks[:9]], "chrom string, start long, end long"), df(genes, "gene string, chrom string, tss long, strand string"), df(bodies, "gene string, chrom string, start long, end long"), 20, 3, 40, 64)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join Inner") == (1 if names == 400 else 2)


def test_motif_hits_across_pieces(spark, monkeypatch):
    p = np.full((6, 4), 0.01)
    p[np.arange(6), [0, 1, 2, 3, 0, 2]] = 0.97
    text = "".join(np.random.default_rng(12).choice(list("ACGTN"), 3000)) + "ACGTAG"
    seq = spark.createDataFrame([(f"p{i}", text[i:]) for i in range(3)], "peak string, sequence string")
    want = {tuple(r) for r in motif.scan(seq, {"m": p}, 1e-2).collect()}
    monkeypatch.setattr(motif, "PLACES", 7)
    monkeypatch.setattr(motif, "HELD", 3)
    got = [tuple(r) for r in motif.scan(seq, {"m": p}, 1e-2).collect()]
    assert set(got) == want and len(got) == len(want) > 5


def test_svd_tasks_hold_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(factor, "HELD", 2000)
    monkeypatch.setattr(factor, "CELLS", 8)
    few = spark.createDataFrame([(c, f, float(c * f % 5 + (c == f))) for c in range(1, 41) for f in range(1, 4)], "cell long, f long, value double").filter("value <> 0")
    x = {r["cell"]: r["x"] for r in factor.truncated_svd(few, "f", 3).collect()}
    for c in x:  # of full rank: lengths are kept
        assert abs(sum(v * v for v in x[c]) - sum((c * f % 5 + (c == f)) ** 2 for f in range(1, 4))) < 1e-6
