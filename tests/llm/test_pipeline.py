"""The pipeline on the smallest driver tables against a plain version of its stages."""

import collections

import corpus_pipeline
from heliograph.llm import language_id, packing

DATA = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = language_id.identify(docs, language_id.fit(docs)).filter("not lang_rejected").select("doc_id", "text").collect()
    text = dict(sorted((r["doc_id"], r["text"]) for r in kept))
    seen, classes, out = set(), [], {}
    for i, t in text.items():
        lines = []
        for line in t.split("\n"):
            w = frozenset(line.lower().split())
            later = bool(w) and (w in seen or any(100 * len(w & v) >= 75 * len(w | v) for v in classes))
            if w and w not in seen:
                seen.add(w)
                classes.append(w)
            if not later:
                lines.append(line)
        if "\n".join(lines).split() or lines == t.split("\n"):
            out[i] = "\n".join(lines)
    sets = {}
    for i, t in out.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    out = {i: t for i, t in out.items() if find(i) == i}
    count = lambda w: collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
    items = [r["text"].encode().lower().split() for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    dirty = set()
    for i, t in out.items():
        w = t.encode().lower().split()
        for v in items:
            c = count(v)
            for s in range(max(1, len(w) - len(v) + 1)):
                if any(g in c for g in [tuple(w[s : s + 5]), tuple(w[s + len(v) - 5 : s + len(v)]), tuple(w[s + len(v) // 2 : s + len(v) // 2 + 5])]):
                    a = count(w[s : s + len(v)])
                    if 100 * sum((a & c).values()) >= 75 * sum((a | c).values()):
                        dirty.add(i)
    encode = packing.byte_bpe()
    want = {i: len(encode(t)) + 1 for i, t in out.items() if i not in dirty}
    got = collections.Counter()
    for r in corpus_pipeline.run(spark, DATA).collect():
        got[r["doc_id"]] += r["length"]
    assert dict(got) == want and dirty
