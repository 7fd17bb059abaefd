"""Quality and toxicity by hierarchical empirical Bayes.

A document classifier gives evidence: words' log odds (with a prior that shrinks rare words to 0) and a few measures of form, weighed by a
logistic regression; it is learned in numpy, in one task, from a bounded sample of `most` labelled rows (the lowest by a hash of
doc_id), cross-fitted in halves so that words' odds are weighed on rows they were not counted on.

Evidence of all documents (labels, where there are any) is then summed by host and by path through grouped
aggregation. At each level a Beta prior around the level above has its strength fitted by moments (how far sites spread
beyond what counting noise explains), so sparse sites shrink to their host, and hosts to the global rate. A document's
posterior adds to its own log odds how far its path's rate, without the document itself, lies from the global one.

Defined cases: a null or blank text is of quality 0 and not toxic, and not kept; a null host or path is a site of its own
value, null; without labels evidence is 0.5 for both and every text with words is kept; labels that are null are left out; documents with several labels
count as their mean; rows that repeat a doc_id are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_received, id_sent, Spool

BUCKETS = 1 << 17
MOST = 6000
TARGETS = ("quality", "toxic")
#: Words' odds count only beyond so many pseudo-observations at the mean rate.
SHRINK = 4.0


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word buckets, measures of form; of the whole text."""
    import xxhash

    raw = text.encode("utf-8", "surrogatepass")
    ws = raw.lower().split()
    b = np.frombuffer(raw, np.uint8)
    kinds = set(ws)
    at = np.unique(np.fromiter((xxhash.xxh32_intdigest(w.strip(b".,;:!?\"'()")) & (BUCKETS - 1) for w in kinds), np.int64, len(kinds)))
    n, lines = max(1, len(b)), text.split("\n")
    letters = ((b | 32) >= 97) & ((b | 32) <= 122) | (b >= 128)
    form = [np.log1p(len(ws)), len(kinds) / max(1, len(ws)), letters.sum() / n, ((b >= 48) & (b <= 57)).sum() / n, ((b >= 33) & (b <= 126) & ~letters).sum() / n, np.log1p(n / max(1, len(ws))), np.log1p(len(ws) / len(lines)), len(set(lines)) / len(lines)]
    return at, np.array(form)


def _odds(rows: list, y: np.ndarray) -> np.ndarray:
    rate = (y.sum() + 1) / (len(y) + 2)
    hit, all_ = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for (at, _), t in zip(rows, y):
        all_[at] += 1
        hit[at] += t
    p = (hit + SHRINK * rate) / (all_ + SHRINK)
    return np.log(p / (1 - p)) - np.log(rate / (1 - rate))


def _inputs(rows: list, odds: np.ndarray) -> np.ndarray:
    out = np.empty((len(rows), 14))
    for i, (at, form) in enumerate(rows):
        o = np.sort(odds[at]) if len(at) else np.zeros(1)
        out[i] = [1.0, o[-1], o[-3:].sum(), o[0], o[:3].sum(), o.mean(), *form]
    return out


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + penalty * np.concatenate([[0], w[1:]])
        h = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        d = np.linalg.solve(h, g)
        w -= d
        if np.abs(d).max() < 1e-8:
            break
    return w


def train(rows: list[tuple[str, float, float]]) -> bytes:
    """rows: (text, quality, toxic), in a fixed order; a label may be NaN."""
    seen = [features(t) for t, *_ in rows]
    out = {}
    for k, name in enumerate(TARGETS):
        y = np.array([r[k + 1] for r in rows], float)
        at = np.flatnonzero(~np.isnan(y))
        part, t = [seen[i] for i in at], y[at]
        if len(at) < 20 or t.min() == t.max():
            out |= {f"{name}_odds": np.zeros(1), f"{name}_w": np.zeros(0), f"{name}_norm": np.zeros((2, 0))}
            continue
        half = np.arange(len(at)) % 2
        x = np.empty((len(at), 14))
        for s in (0, 1):
            x[half == s] = _inputs([r for r, m in zip(part, half) if m == s], _odds([r for r, m in zip(part, half) if m != s], t[half != s]))
        mean, sd = x.mean(0), x.std(0) + 1e-9
        mean[0], sd[0] = 0, 1
        out |= {f"{name}_odds": _odds(part, t).astype(np.float32), f"{name}_w": _logistic((x - mean) / sd, t), f"{name}_norm": np.stack([mean, sd])}
    data = io.BytesIO()
    np.savez_compressed(data, **out)
    return data.getvalue()


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST) -> bytes | None:
    """Learns from the documented bounded sample; runs at once and brings only the model to the driver."""
    known = _labels(labels)
    chosen = known.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").join(known, "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [r for pdf in batches for r in pdf[["doc_id", "text", *TARGETS]].itertuples(index=False)]
        if got:
            got.sort(key=lambda r: (r.doc_id, r.text))
            yield pd.DataFrame({"model": [train([tuple(r)[1:] for r in got])]})

    found = rows.repartition(1).mapInPandas(run, "model binary").collect()
    return bytes(found[0]["model"]) if found else None


def _labels(labels: DataFrame) -> DataFrame:
    """doc_id with mean labels as doubles."""
    return labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*[F.avg(t).alias(t) for t in TARGETS])


def evidence(docs: DataFrame, model: bytes | None, host: str = "source", path: str = "lang") -> DataFrame:
    """doc_id, host, path, words and e_quality, e_toxic: the classifier's log odds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = dict(np.load(io.BytesIO(model))) if model else {}
        for pdf in batches:
            out: dict = {"words": [], "e_quality": [], "e_toxic": []}
            for t in pdf["text"].tolist():
                f = features(t) if isinstance(t, str) else (np.empty(0, np.int64), np.zeros(8))
                out["words"].append(len(f[0]))
                for name in TARGETS:
                    w = m.get(f"{name}_w", ())
                    mean, sd = m.get(f"{name}_norm", (None, None))
                    z = float((_inputs([f], m[f"{name}_odds"])[0] - mean) / sd @ w) if len(w) else 0.0
                    out[f"e_{name}"].append(min(15.0, max(-15.0, z)))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "host": pdf["host"], "path": pdf["path"], **out})

    cols = docs.select(id_sent("doc_id"), "text", F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"))
    return cols.mapInPandas(run, "doc_id string, host string, path string, words long, e_quality double, e_toxic double").withColumn("doc_id", id_received("doc_id"))


def _p(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(q / (1 - q))


def _strength(sites: DataFrame, s: str, n: str, prior: Column) -> DataFrame:
    """One row: the Beta prior's strength by moments over sites of sum s, count n around prior."""
    q, m = prior, F.col(s) / F.col(n)
    noise, spread = F.sum(q * (1 - q)), F.sum(F.col(n) * (m - q) * (m - q))
    between = F.greatest((spread - noise) / F.greatest(F.sum(F.col(n)) - F.count("*"), F.lit(1.0)), F.lit(1e-6))
    return sites.agg(F.least(F.greatest(F.avg(q * (1 - q)) / between - 1, F.lit(2.0)), F.lit(1e6)).alias(f"k_{s}"))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", most: int = MOST) -> DataFrame:
    """doc_id, quality, toxic (posterior probabilities), keep."""
    spool = Spool(docs.sparkSession, "quality")
    e = evidence(docs, fit(docs, labels, most), host, path).join(_labels(labels), "doc_id", "left")
    e = spool.write(e.select("doc_id", "host", "path", "words", *[f"e_{t}" for t in TARGETS], *[F.coalesce(t, _p(F.col(f"e_{t}"))).alias(f"p_{t}") for t in TARGETS]))
    sums = lambda t: [F.sum(f"p_{t}").alias(f"s_{t}")]
    paths = spool.write(e.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), *[x for t in TARGETS for x in sums(t)]))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), *[F.sum(f"s_{t}").alias(f"h_{t}") for t in TARGETS])
    total = hosts.agg(F.sum("hn").alias("N"), *[F.sum(f"h_{t}").alias(f"g_{t}") for t in TARGETS]).first()
    mean = {t: ((total[f"g_{t}"] or 0.0) + 0.5) / ((total["N"] or 0.0) + 1) for t in TARGETS}
    k_host = {t: (_strength(hosts, f"h_{t}", "hn", F.lit(mean[t])).first()[0] or 2.0) for t in TARGETS}
    hosts = hosts.withColumns({f"post_h_{t}": (F.col(f"h_{t}") + k_host[t] * mean[t]) / (F.col("hn") + k_host[t]) for t in TARGETS})
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    sites = spool.write(paths.join(hosts.withColumnRenamed("host", "_h"), same("host", "_h")).drop("_h"))
    k_path = {t: (_strength(sites, f"s_{t}", "n", F.col(f"post_h_{t}")).first()[0] or 2.0) for t in TARGETS}
    both = e.join(sites.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "n", *[f"{c}_{t}" for t in TARGETS for c in ("s", "post_h")]), same("host", "_h") & same("path", "_p"))
    out = {}
    for t in TARGETS:
        site = (F.col(f"s_{t}") - F.col(f"p_{t}") + k_path[t] * F.col(f"post_h_{t}")) / (F.col("n") - 1 + k_path[t])
        out[t] = _p(F.col(f"e_{t}") + _logit(site) - _logit(F.lit(mean[t])))
    has = F.col("words") > 0
    both = both.withColumns({"quality": F.when(has, out["quality"]).otherwise(0.0), "toxic": F.when(has, out["toxic"]).otherwise(0.0)})
    return both.select("doc_id", "quality", "toxic", (has & (F.col("quality") >= 0.5) & (F.col("toxic") < 0.5 + 1e-9)).alias("keep"))
