"""Fill-in-the-middle examples: texts cut at two units and put in prefix-suffix-middle or suffix-prefix-middle order.

A unit is a run of ASCII letters, or any other single code point. Texts are read as UTF-8 bytes, block by block. While units are
counted, a checkpoint is recorded at every `every`-th unit: its number, byte offset and code-point offset. To find a cut, the checkpoint
before it is found by binary search, and only the few units after it are read again. So a text is counted once, and beside the
text a task holds a sparse index and one block.

The two cuts and the form depend on doc_id and `seed` alone, by a SHA-256 of both. Texts stay with Spark: Python gives back offsets.

Defined cases: a null text is read as empty; an empty text, or one with a marker in it, is plain, that is left as it is; a null doc_id
takes part and is drawn as 'null'; repeated rows are rows of their own, with equal results; an empty table gives no rows; other
columns are ignored, whatever their names. Texts of any length are read whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

#: The markers before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
EVERY, BLOCK = 512, 1 << 18
CUTS = "n long, prefix_bytes long, middle_bytes long, prefix_chars long, middle_chars long"


def _starts(block: np.ndarray, letter_before: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Where units begin in a block of bytes, where code points do, and whether its last byte is a letter."""
    letter = ((block | 0x20) - np.uint8(97)) < 26
    before = np.empty_like(letter)
    before[0], before[1:] = letter_before, letter[:-1]
    point = (block & 0xC0) != 0x80
    return np.where(letter, ~before, point), point, bool(letter[-1])


class CheckpointIndex:
    """The units of a text: how many (n), and the offsets of any of them by a sparse index."""

    def __init__(self, data: bytes, every: int = EVERY, block: int = BLOCK) -> None:
        self.data, self.every = np.frombuffer(data, np.uint8), every
        self.units, self.bytes, self.points = [], [], []
        self.n = self.n_points = 0
        letter = False
        for at in range(0, len(self.data), block):
            unit, point, letter = _starts(self.data[at : at + block], letter)
            where = np.flatnonzero(unit)
            mark = where[-self.n % every :: every]
            if len(mark):
                self.units += range(-(-self.n // every) * every, self.n + len(where), every)
                self.bytes += (at + mark).tolist()
                self.points += (self.n_points + np.cumsum(point)[mark] - point[mark]).tolist()
            self.n += len(where)
            self.n_points += int(np.count_nonzero(point))

    def locate(self, unit: int) -> tuple[int, int]:
        """(byte offset, code-point offset) at which unit number `unit` begins; the text's ends for n."""
        if unit >= self.n:
            return len(self.data), self.n_points
        i = int(np.searchsorted(self.units, unit, side="right")) - 1
        at, points, left, width = self.bytes[i], self.points[i], unit - self.units[i], 4 * self.every
        letter = False  # a checkpoint is a unit's first byte, whatever stands before it
        while True:
            u, p, letter = _starts(self.data[at : at + width], letter)
            where = np.flatnonzero(u)
            if left < len(where):
                return at + int(where[left]), points + int(np.count_nonzero(p[: where[left]]))
            left -= len(where)
            points += int(np.count_nonzero(p))
            at += len(u)
            width *= 2


def cuts(text: bytes | None, h1: int, h2: int, every: int = EVERY) -> tuple[int, int, int, int, int]:
    """The row of CUTS for a text and its two draws."""
    index = CheckpointIndex(text or b"", every)
    lo, hi = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
    (b1, c1), (b2, c2) = index.locate(lo), index.locate(hi)
    return index.n, b1, b2 - b1, c1, c2 - c1


def draws(key: Column, seed: str, n: int) -> list[Column]:
    """n numbers below 2**32: the first 8-digit groups of the hex SHA-256 of seed, a colon and key."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def restore(output: Column, form: Column) -> Column:
    """The exact text that an output was made of.

    Texts with markers are plain and a marker cannot overlap another, so the first one found of each kind is the one that was put there.
    """
    first, second = (lambda m: F.split(F.substr(output, F.lit(4)), m, 2)), lambda x, m: F.split(x[1], m, 2)
    psm, spm = first(MARKERS[1]), first(MARKERS[0])
    p, s = second(psm, MARKERS[2]), second(spm, MARKERS[2])
    return F.when(form == "psm", F.concat(psm[0], p[1], p[0])).when(form == "spm", F.concat(s[0], s[1], spm[0])).otherwise(output)


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "1", rate: int = 90, spm: int = 20, every: int = EVERY) -> DataFrame:
    """A row per row of docs: key, n (units), form, prefix_chars, middle_chars, output.

    rate: of 100 documents, how many are cut; spm: of 100 of those, how many put the suffix first.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(CUTS)
    def place(data: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
        rows = [cuts(t, int(a), int(b), every) for t, a, b in zip(data, h1, h2)]
        return pd.DataFrame(rows, columns=[x.split()[0] for x in CUTS.split(", ")], dtype="int64")

    whole = F.coalesce(F.col(text), F.lit(""))
    h = draws(F.col(key), seed, 4)
    x = docs.select(F.col(key).alias("key"), whole.cast("binary").alias("data"), *[v.alias(f"h{i}") for i, v in enumerate(h, 1)])
    x = x.withColumn("cut", place("data", "h1", "h2"))
    string = F.col("data").cast("string")
    marked = F.lit(False)
    for m in MARKERS:
        marked = marked | F.contains(string, F.lit(m))
    form = F.when((F.length("data") == 0) | marked | (F.col("h3") % 100 >= rate), "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm")
    x = x.withColumn("form", form)
    a, m = F.col("cut.prefix_bytes").cast("int"), F.col("cut.middle_bytes").cast("int")
    part = lambda start, n: F.substr(F.col("data"), start + 1, n).cast("string")
    prefix, middle, suffix = part(F.lit(0), a), part(a, m), part(a + m, F.length("data") - a - m)
    p, s, mid = (F.lit(v) for v in MARKERS)
    output = F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, mid, middle)).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, mid, middle)).otherwise(string)
    cut = F.col("form") != "plain"
    return x.select(
        F.col("key").alias(key), F.col("cut.n").alias("n"), "form",
        F.when(cut, F.col("cut.prefix_chars")).alias("prefix_chars"), F.when(cut, F.col("cut.middle_chars")).alias("middle_chars"), output.alias("output"),
    )
