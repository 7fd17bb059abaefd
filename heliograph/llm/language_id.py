"""Language identification: averaged hashed subword embeddings under a linear softmax.

Byte n-grams (2 to 4, word boundaries included) of the lower-cased whole text are hashed to rows of an embedding
table; a text is the mean of its rows, and a linear softmax gives a probability per language. Table and softmax are
trained together by stochastic gradient descent in numpy, in one task, on a bounded sample (`per_language` labelled
rows of each language, the lowest by a hash of doc_id, `most` rows in all, every language among them). A part of the sample, not
trained on, calibrates: a temperature by likelihood, then the lowest confidence from which accepted texts reach `precision`, though
never above CEILING, so that wrong labels cannot reject texts that are told with confidence.
As the model is linear, scoring needs only table @ softmax, one row of logits per hashed n-gram.

Defined cases: a text that is null, empty or without a letter is `und` with score 0 and rejected; where nothing can
be learned from (no labelled row), every text is; a null doc_id is never learned from; repeated rows are scored each; texts of any
length are read whole; columns named like a result are replaced, others kept.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Spool, bounded_batches, maybe_in

BUCKETS, DIM, GRAMS = 1 << 15, 16, (2, 3, 4)
UND = "und"
#: The highest confidence that may be asked for, and the parts in which a language's rows are ranked.
CEILING, SALTS = 0.6, 256
_K = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def subwords(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur in the whole text."""
    b = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    acc = b * _K[0]
    for n in range(2, max(GRAMS) + 1):
        if len(b) < n:
            break
        acc = (acc[:-1] ^ (acc[:-1] >> np.uint32(15))) * _K[1] + b[n - 1 :] * _K[2]
        if n in GRAMS:
            h = (acc ^ np.uint32(n)) * _K[3]
            counts += np.bincount(h >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    return counts


class Model:
    """logits: bucket x language (the table times the softmax's weights, temperature included); threshold: confidence below which a text is rejected."""

    def __init__(self, languages: list[str], logits: np.ndarray, bias: np.ndarray, threshold: float) -> None:
        self.languages, self.logits, self.bias, self.threshold = languages, logits, bias, threshold

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, languages=np.array(self.languages), logits=self.logits, bias=self.bias, threshold=self.threshold)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Model:
        z = np.load(io.BytesIO(data))
        return cls([str(x) for x in z["languages"]], z["logits"], z["bias"], float(z["threshold"]))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, rejected."""
        if not has_letter(text):
            return UND, 0.0, True
        c = subwords(text)
        at = np.flatnonzero(c)
        z = c[at] @ self.logits[at] / max(1, c.sum()) + self.bias
        p = np.exp(z - z.max())
        p /= p.sum()
        i = int(p.argmax())
        return self.languages[i], float(min(1.0, p[i])), bool(p[i] < self.threshold)


def train(rows: list[tuple[str, str]], epochs: int = 6, rate: float = 0.5, precision: float = 0.99, seed: int = 7) -> Model | None:
    """rows: (text, language), in a fixed order."""
    rows = [(t, y) for t, y in rows if has_letter(t)]
    names = sorted({y for _, y in rows})
    if not names:
        return None
    rng = np.random.default_rng(seed)
    x = []
    for t, _ in rows:
        c = subwords(t)
        at = np.flatnonzero(c)
        x.append((at, (c[at] / max(1, c.sum())).astype(np.float32)))
    y = np.array([names.index(b) for _, b in rows])
    held = np.zeros(len(rows), bool)
    if len(rows) >= 20 * len(names):
        held[rng.permutation(len(rows))[: len(rows) // 5]] = True
    table = rng.normal(0, 0.5 / DIM**0.5, (BUCKETS, DIM)).astype(np.float32)
    w, b = np.zeros((DIM, len(names)), np.float32), np.zeros(len(names), np.float32)
    fit = np.flatnonzero(~held)
    steps, step = max(1, epochs * len(fit)), 0
    for _ in range(epochs):
        for i in rng.permutation(fit):
            at, share = x[i]
            lr = rate * (1 - step / steps)
            step += 1
            v = share @ table[at]
            z = v @ w + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = w @ p
            w -= lr * np.outer(v, p)
            b -= lr * p
            table[at] -= (lr * 20) * share[:, None] * g[None, :]
    logits = table @ w
    cal = np.flatnonzero(held) if held.any() else fit
    z = np.stack([x[i][1] @ logits[x[i][0]] + b for i in cal])

    def prob(t: float) -> np.ndarray:
        e = np.exp((z - z.max(1, keepdims=True)) * t)
        return e / e.sum(1, keepdims=True)

    temps = [2.0**k for k in np.arange(-3, 5.01, 0.5)]
    t = min(temps, key=lambda t: -np.log(np.maximum(prob(t)[np.arange(len(cal)), y[cal]], 1e-9)).mean())
    p = prob(t)
    right, sure = p.argmax(1) == y[cal], p.max(1)
    order = np.argsort(-sure, kind="stable")
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision
    threshold = 0.0 if good[-1] else float(sure[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    least = 1.2 / len(names) if len(names) > 1 else 0.0
    return Model(names, (logits * t).astype(np.float32), (b * t).astype(np.float32), min(max(threshold, least), CEILING))


def held_out(folds: int = 5):
    """Whether a row is never learned from: crc32 of doc_id as text, divisible by folds."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == 0


def fit(docs: DataFrame, per_language: int = 400, most: int = 80_000, folds: int = 5, precision: float = 0.99) -> Model | None:
    """Learns every lang value from a bounded sample of its rows; brings only the model (4 * buckets bytes a language) to the driver.

    The sample is the rows of least hash of doc_id, at most per_language a language and `most` in all, but one a language at least.
    """
    bounded_batches(docs.sparkSession)
    can = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(folds))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    part = Window.partitionBy("lang", F.pmod(order[0], F.lit(SALTS))).orderBy(*order)
    first = Window.partitionBy("lang").orderBy(*order)
    some = can.select("doc_id", "lang").distinct().withColumn("_n", F.row_number().over(part)).filter(F.col("_n") <= per_language).drop("_n")
    some = some.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= per_language)
    some = Spool(docs.sparkSession, "language").write(some)
    quota = max(1, most // max(1, some.select("lang").distinct().count()))
    chosen = some.filter(F.col("_n") <= quota)
    rows = maybe_in(can.select("doc_id", "lang", "text"), "CAST(doc_id AS BIGINT)", chosen.select(F.col("doc_id").cast("long").alias("doc_id"))).join(chosen.select("doc_id", "lang"), ["doc_id", "lang"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = sorted((str(i), y, t) for pdf in batches for i, y, t in zip(pdf["doc_id"].tolist(), pdf["lang"].tolist(), pdf["text"].tolist()))
        if m := train([(t, y) for _, y, t in got], precision=precision):
            yield pd.DataFrame({"model": [m.dump()]})

    found = rows.repartition(1).mapInPandas(run, "model binary").collect()
    return Model.load(bytes(found[0]["model"])) if found else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with lang_pred, lang_score and lang_rejected."""
    bounded_batches(docs.sparkSession)
    data = model.dump() if model else None

    @F.pandas_udf("lang_pred string, lang_score double, lang_rejected boolean")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = Model.load(data) if data else None
        for texts in batches:
            got = [m.predict(None if t is None or t != t else t) if m else (UND, 0.0, True) for t in texts.tolist()]
            yield pd.DataFrame(got, columns=["lang_pred", "lang_score", "lang_rejected"])

    # Only the text goes to Python, so no other column is changed on the way; "nondeterministic" has it called once a row.
    rest = docs.drop("lang_pred", "lang_score", "lang_rejected")
    found = f"_told_{uuid.uuid4().hex[:8]}"
    return rest.withColumn(found, told.asNondeterministic()("text")).select(*rest.columns, f"{found}.*")
