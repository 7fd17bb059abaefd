"""Fill-in-the-middle, cross-tokenizer alignment and approximate neighbours against brute force, and their defined cases."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliograph.llm import ann_search, fill_in_middle, queries, token_alignment
from heliograph.llm.fill_in_middle import CheckpointIndex

BIG = 9007199254740993
TEXTS = ["", "a", "ab cd", "x1é▁😀 zz\n\n  q", "a" * 5000, "é" * 3000 + "word " * 700, "<P> in it", "tail<S", "<|endoftext|> and <s> </s> <unk>", " lead", "İſK", "a\x00b"]
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "null id here", "x"), (BIG, "big id", None), (BIG, "big id", None), (BIG + 2, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n string").withColumn("part", F.lit("p")).coalesce(1)


def rows(df):
    return [r.asDict() for r in df.collect()]


def middle_by_hand(doc_id, text):
    text = text or ""
    u = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, len(u), "plain", None, None, text)
    if h4 % 100 < 20:
        return (doc_id, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("every,block", [(1, 1), (3, 5), (4, 64), (512, 1 << 18)])
def test_checkpoint_index(every, block):
    for text in TEXTS:
        u = UNIT.findall(text)
        index = CheckpointIndex(text.encode(), every, block)
        assert index.n == len(u)
        assert index.units == list(range(0, len(u), every))
        for k in {0, 1, len(u) // 2, max(0, len(u) - 1), len(u)}:
            p = "".join(u[:k])
            assert index.locate(k) == (len(p.encode()), len(p)), (text[:20], k)


def test_fill_in_middle(spark, docs):
    out = fill_in_middle.fill_in_middle(docs, every=4).withColumn("back", fill_in_middle.restore(F.col("output"), F.col("form")))
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows(out)), key=repr)
    assert got == sorted((middle_by_hand(r["doc_id"], r["text"]) for r in rows(docs)), key=repr)
    assert sorted(r["back"] for r in rows(out)) == sorted(r["text"] or "" for r in rows(docs))
    assert fill_in_middle.fill_in_middle(docs.filter("false")).count() == 0


def test_fill_in_middle_whole_table(spark, sf):
    got = {r["doc_id"]: r for r in rows(queries.op11_fill_in_middle(spark, sf))}
    for r in rows(spark.read.parquet(f"{sf}/documents.parquet")):
        want = middle_by_hand(r["doc_id"], r["text"])
        x = got[r["doc_id"]]
        assert (x["n"], x["form"], x["prefix_chars"], x["middle_chars"]) == want[1:5]
        assert x["output_sha256"] == hashlib.sha256(want[5].encode()).hexdigest()
        assert x["restored_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def align_by_hand(docs):
    """Links by comparing byte ranges, with the tokenizers library itself for the first side."""
    import sentencepiece
    from tokenizers import Tokenizer

    from heliograph.llm.packing import vocabulary_path

    ta = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    ta.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    points = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in points} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in points)}
    out, seen = [], Counter()
    for doc_id, text in docs:
        a = ta.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        xa = [bytes(byte[c] for c in ta.id_to_token(i)) for i in a]
        pieces = [sp.id_to_piece(i) for i in b]
        xb = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(xa) != raw or b"".join(xb) != raw:
            out.append((doc_id, [], [], [], ""))
            continue
        spans = lambda x: [(e - len(t), e) for t, e in zip(x, np.cumsum([len(t) for t in x]).tolist())]
        sa, sb = spans(xa), spans(xb)
        link, j0 = [], 0
        for i, (s, e) in enumerate(sa):
            while sb[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(sb) and sb[j][0] < e:
                link.append((a[i], b[j]))
                j += 1
        common = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, i, j = [], 0, 0
        for e in common:
            ga, gb = [], []
            while i < len(sa) and sa[i][1] <= e:
                ga.append(str(a[i]))
                i += 1
            while j < len(sb) and sb[j][1] <= e:
                gb.append(str(b[j]))
                j += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        seen.update(set(link))
        out.append((doc_id, a, b, link, ";".join(groups)))
    best = Counter()
    for (x, _), n in seen.items():
        best[x] = max(best[x], n)
    sha = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    told = [(d, len(a), len(b), g.count(";") + bool(g), len(ln), sum(seen[p] == best[p[0]] for p in ln), sum(seen[p] for p in ln), sha(g)) for d, a, b, ln, g in out]
    return sorted(told, key=repr), seen


def test_alignment(spark, docs, sf):
    every = docs.select("doc_id", "text").unionByName(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    want, seen = align_by_hand([(r["doc_id"], r["text"]) for r in rows(every)])
    for part in (token_alignment.PART, 500):  # one part a task, and many
        out = token_alignment.align(every, part=part)
        assert sorted(map(tuple, out.collect()), key=repr) == want
    counts = token_alignment.pair_counts(every)
    assert {(r["a_id"], r["b_id"]): r["n_docs"] for r in rows(counts)} == seen


def test_alignment_cases(spark, docs):
    out = {(r["doc_id"], r["n_a"]): r for r in rows(token_alignment.align(docs, with_groups=True))}
    assert sum(1 for d, _ in out if d is None) == 1
    assert out[(BIG + 2, 0)]["groups_sha256"] == "" and out[(BIG + 2, 0)]["groups"] == ""
    assert out[(3, 0)]["n_links"] == 0  # U+2581 is not given back
    r = next(r for (d, _), r in out.items() if d == 2)
    assert hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"]
    assert token_alignment.align(docs.filter("false")).count() == 0


def test_run_sums_across_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        x = spark.createDataFrame([(p, k, 1 + p) for k in (1, 5, 9) for p in range(8)], "part long, key long, n long").coalesce(1).sortWithinPartitions("key")
        got = rows(token_alignment.run_sums(x))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == 24 and {r["total"] for r in got} == {36} and sum(r["first"] for r in got) == 3


def neighbours_by_hand(vectors, queries_, k):
    want = {}
    for q, x in queries_:
        s = sorted(((-float((np.array(x) * np.array(v)).sum()), i) for i, v in vectors if i != q))
        want[q] = [(i, -t) for t, i in s[:k]]
    return want


def test_beta_quantile():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((100_000, 20)) ** 2
    share = x[:, :8].sum(1) / x.sum(1)
    assert abs(ann_search.beta_quantile(4, 6, 0.95) - np.quantile(share, 0.95)) < 0.01


def test_ann_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((30, 24)) * 3
    x = centres[rng.integers(0, 30, 6000)] + rng.standard_normal((6000, 24))
    x *= rng.uniform(0.2, 4, 6000)[:, None]  # norms differ: the largest inner product is not the nearest direction
    x[3000:5000] = x[0]  # a third of all rows is one vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(6)
    out = ann_search.nearest(df, df.filter("vec_id % 20 = 0"), k=20, sample=1500, list_rows=100)
    got = {}
    for r in sorted(rows(out), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = neighbours_by_hand(list(enumerate(x)), [(i, x[i]) for i in range(0, 6000, 20)], 20)
    assert {len(v) for v in got.values()} == {20} and set(got) == set(want)
    hit = np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / 20 for q, w in want.items()])
    assert hit >= 0.9, hit
    for q, found in got.items():
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))
        assert all(abs(s - float(x[q] @ x[i])) < 1e-9 * max(1, abs(s)) for i, s in found)


def test_ann_scan_abandons(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(4000)
    index = ann_search.fit(x, ids, 1.0, 4000)
    q = x[:40]
    exact = np.sort(q @ x.T, axis=1)[:, -22]
    scan = ann_search.Scan(index, q, exact, 20)
    for i in range(0, 4000, 1000):
        scan.block(x[i : i + 1000], ids[i : i + 1000], ids[i : i + 1000])
    at, _, key = scan.best()
    found = [set(key[at == i].tolist()) for i in range(40)]
    top = np.argsort(-(q @ x.T), axis=1)[:, :21]
    assert np.mean([len(f & set(t.tolist())) / 21 for f, t in zip(found, top)]) >= 0.95
    assert scan.read < 0.75 * scan.could  # components read, of all


def test_ann_cases(spark):
    v = [1.0, 2.0]
    data = [(1, v), (1, v), (2, v), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [float("inf"), 1.0]), (8, [1.0]), (9, [1.0, 2.0, 0.0]), (None, v), (BIG, [2.0, 1.0]), (10, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).withColumn("part", F.lit(1))
    got = rows(ann_search.nearest(df, df, k=3))
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by) == {1, 2, 8, 9, BIG}
    assert by[1] == [(2, 5.0), (9, 5.0), (BIG, 4.0)]
    assert by[8] == [(BIG, 2.0), (1, 1.0), (2, 1.0)]
    assert ann_search.nearest(df.filter("false"), df.filter("false")).count() == 0
    assert ann_search.nearest(df.filter("vec_id = 1"), df.filter("vec_id = 1")).count() == 0


def test_ann_query(spark, sf):
    got = rows(queries.op13_ann_search(spark, sf))
    e = {r["vec_id"]: np.array(r["embedding"], float) for r in rows(spark.read.parquet(f"{sf}/embeddings.parquet"))}
    want = neighbours_by_hand(list(e.items()), [(i, x) for i, x in e.items() if i % 20 == 0], 20)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(found[q] & {i for i, _ in w}) / 20 for q, w in want.items()]) >= 0.9
