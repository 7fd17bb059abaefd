"""Ids over 2**53, null ids, equal rows and ids with several texts in one batch: no operator rounds, drops or multiplies them."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliograph.llm import decontaminate, fill_in_middle, language_id, line_dedup, minhash_dedup, packing, quality, secrets, suffix_dedup, token_alignment

BIG = 9007199254740993
RNG = np.random.default_rng(8)
WORDS = " ".join(RNG.choice([f"w{i}" for i in range(300)], 160))
ROWS = [(None, "a null id"), (BIG, WORDS), (BIG + 2, WORDS.replace(" ", " x", 1)), (BIG, WORDS), (BIG, "another text of this id"), (BIG + 4, None), (BIG + 6, ""), (None, WORDS + " end"), (2**61 + 1, "one more"), (-5, "below zero")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in ROWS], "doc_id long, text string, lang string, source string")
    for clash in ("start", "length", "words", "host", "path", "rep", "id", "copies", "bands", "n", "part"):
        df = df.withColumn(clash, F.lit("clash"))
    return df.coalesce(1)


OPERATORS = {
    "minhash": lambda d: minhash_dedup.near_duplicates(d),
    "secrets": lambda d: secrets.report(d),
    "suffix_none": lambda d: suffix_dedup.remove_repeats(d, keep="none"),
    "suffix_first": lambda d: suffix_dedup.remove_repeats(d, keep="first"),
    "quality": lambda d: quality.classify(d, d.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))),
    "lines": lambda d: line_dedup.dedup_lines(d),
    "clean": lambda d: decontaminate.clean(d, d.sparkSession.createDataFrame([(1, "nothing like it here at all")], "item_id long, text string")),
    "language": lambda d: language_id.identify(d, language_id.fit(d)),
    "packing": lambda d: packing.pack(d).filter("start = 0"),
    "middle": lambda d: fill_in_middle.fill_in_middle(d),
    "alignment": lambda d: token_alignment.align(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_and_ids(docs, name):
    got = Counter(r["doc_id"] for r in OPERATORS[name](docs).select("doc_id").collect())
    assert got == Counter(i for i, _ in ROWS)


def test_links_beside_a_null_id(docs):
    got = minhash_dedup.near_duplicates(docs).select("doc_id", "component_id", "kept").collect()
    assert {r["component_id"] for r in got if r["doc_id"] in (BIG, BIG + 2)} == {BIG}
    assert {r["kept"] for r in got if r["doc_id"] == BIG + 2} == {False}


def test_repeats_of_equal_rows(docs):
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(docs, keep="none").collect())
    texts = [(t or "").encode() for _, t in ROWS]
    seen = Counter(b[k : k + 400] for b in texts for k in range(len(b) - 399))
    want = Counter()
    for (i, _), b in zip(ROWS, texts):
        gone = {k + j for k in range(len(b) - 399) if seen[b[k : k + 400]] > 1 for j in range(400)}
        want[i, len(b), len(gone), hashlib.sha256(bytes(c for k, c in enumerate(b) if k not in gone)).hexdigest()] += 1
    assert got == want


def test_repeats_in_a_text_of_several_pieces(spark):
    rng = np.random.default_rng(2)
    text = rng.choice(list("abcdefghijklmnop"), suffix_dedup.PIECE + 150_000)
    text[suffix_dedup.PIECE - 500 : suffix_dedup.PIECE + 400] = text[1000:1900]  # a copy over the pieces' border
    df = spark.createDataFrame([(1, "".join(text)), (1, "".join(text[200_000:201_000]) + "!"), (1, "short")], "doc_id long, text string")
    got = {r["n_bytes"]: r for r in suffix_dedup.remove_repeats(df, keep="none").collect()}
    r = got[len(text)]
    assert [tuple(s) for s in r["spans"]] == [(1000, 1900), (200_000, 201_000), (suffix_dedup.PIECE - 500, suffix_dedup.PIECE + 400)]
    assert got[1001]["n_removed"] == 1000 and got[5]["n_removed"] == 0
