"""Cross-tokenizer alignment: which tokens of two tokenizers share bytes of the same texts, and how often in the corpus.

1. Each text is cut by both tokenizers. Where tokens of both end at the same byte, a group ends. What lies between neighbouring
   ends, of either side, is part of one token of each, so such stretches and links (pairs of tokens that overlap) are the same.
   The ids go, as bytes, to a written table; its rows are dealt into parts of bounded tokens.
2. A pair of ids is one 64-bit number. np.unique gives each part's pairs with the number of its documents that hold them.
3. These partial counts are sorted by ranges over the cluster; equal pairs are neighbours, and a run's sum is the pair's count.
   Each part's row of a run gets that sum, so what comes back to a part is its own sorted shard of the corpus counts.
4. A part's shard is put in a file, memory-mapped, and its documents' links are looked up by binary search.

Nothing holds all pairs: tasks hold batches, and the driver gets the highest count of each id of the first tokenizer, at most one row a
vocabulary entry.

Defined cases: a text that is null, empty, or that either tokenizer does not give back byte for byte has no tokens, zeros and
an empty digest; a null doc_id takes part; rows that repeat a doc_id are documents of their own; an empty table gives no rows; other
columns are ignored, whatever their names. Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Spool, id_received, id_sent, texts
from .packing import byte_bpe, vocabulary_path

#: Bits of an id in a packed pair; ids of both vocabularies lie below 2**20, and so do documents of a batch.
BITS = 20
MASK = (1 << BITS) - 1
#: Tokens of the first tokenizer in a part, and bytes of ids whose links are taken at once.
PART, LOT = 4_000_000, 16_000_000


def byte_table(path: str | None = None) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """(encode, bytes of each id) of the byte-level BPE; special tokens' strings are plain text."""
    import base64

    with open(path or vocabulary_path(), "rb") as f:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    return byte_bpe(path, special={}), [ranks.get(i, b"") for i in range(max(ranks) + 1)]


def piece_table(path: str | None = None) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """(encode, bytes of each id) of the piece BPE: U+2581 is a blank, <0xHH> the byte HH."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path("piece_bpe_32k.model"))
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    table = [bytes.fromhex(p[3:5]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return lambda s: model.encode(s, num_threads=1), table


class Vocabulary:
    """Bytes and lengths of ids, and the type that holds an id."""

    def __init__(self, table: list[bytes]) -> None:
        self.bytes, self.lengths = table, np.array([len(b) for b in table], np.int64)
        self.kind = "<u2" if len(table) <= 1 << 16 else "<u4"

    def text(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Names:
    """The decimal names of ids below n, each followed by a comma, a bar or a semicolon, as rows of bytes."""

    def __init__(self, n: int) -> None:
        names = np.array([b"%d%c" % (i, sign) for i in range(n) for sign in b",|;"])
        self.width = names.dtype.itemsize
        self.rows = names.view(np.uint8).reshape(len(names), self.width)
        self.lengths = (self.rows != 0).sum(1)

    def text(self, tokens: np.ndarray, signs: np.ndarray) -> bytes:
        """The names in a row; signs: 0, 1 or 2 after each."""
        out, at = [], 3 * tokens + signs
        for i in range(0, len(at), 1 << 20):
            part = self.rows[at[i : i + (1 << 20)]]
            out.append(part[part != 0].tobytes())
        return b"".join(out)


def aligned(x: list[np.ndarray], y: list[np.ndarray], va: Vocabulary, vb: Vocabulary, names: Names) -> tuple[np.ndarray, list[bytes]]:
    """(number of groups, text of the groups) of each document: `a1,a2|b1;a3|b2,b3`, ids in order.

    x, y: ids of the same bytes, document by document; all of them are read as one sequence, as both sides end where a document ends.
    """
    n = [np.array([len(d) for d in side], np.int64) for side in (x, y)]
    if not n[0].sum():
        return np.zeros(len(x), np.int64), [b""] * len(x)
    a, b = (np.concatenate(side).astype(np.int64) for side in (x, y))
    ends_a, ends_b = np.cumsum(va.lengths[a]), np.cumsum(vb.lengths[b])
    at = np.searchsorted(ends_b, ends_a)
    ia = np.flatnonzero(ends_b[at] == ends_a)  # the last tokens of the groups
    ib = at[ia]
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[ia] = last_b[ib] = 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    at_a = np.arange(len(a)) + np.concatenate([[0], ib + 1])[group_a]  # after its group's earlier ones come the tokens of B
    at_b = np.arange(len(b)) + (ia + 1)[group_b]
    tokens, signs = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int64)
    tokens[at_a], tokens[at_b] = a, b
    signs[at_a[ia]], signs[at_b[ib]] = 1, 2
    text = names.text(tokens, signs)
    stop = np.concatenate([[0], np.cumsum(names.lengths[3 * tokens + signs])])[np.cumsum(n[0] + n[1])]
    start = np.concatenate([[0], stop[:-1]])
    groups = np.diff(np.concatenate([[0], np.cumsum(last_a)])[np.cumsum(n[0])], prepend=0)
    return groups, [text[s : e - 1] if e > s else b"" for s, e in zip(start.tolist(), stop.tolist())]


def links(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pairs of ids, packed, of all links in order of bytes; place among them of the last link of each token of A).

    Links are the stretches between the ends of either side, so a link's tokens are those whose ends are counted before its own end.
    """
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(ends_b, ends_a)
    both = ends_b[at] == ends_a
    place = np.arange(len(a)) + at - (np.cumsum(both) - both)
    of_a = np.zeros(len(a) + len(b) - int(both.sum()), bool)
    of_a[place] = True
    of_b = ~of_a
    of_b[place[both]] = True
    before = lambda ends: np.cumsum(ends) - ends
    return a[before(of_a)] << BITS | b[before(of_b)], place


def encoded(docs: DataFrame, spool: Spool, a: Callable = byte_table, b: Callable = piece_table, part: int = PART, with_groups: bool = False) -> DataFrame:
    """part, seq, doc_id (as string), n_a, n_b, n_groups, n_links, groups_sha256, a and b (ids, little-endian 16 or 32 bits), and groups if asked for.

    a, b: give (encode, bytes of each id). The first reads a blank and the text; the second adds the blank itself.
    """
    names = ["part", "seq", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b"] + ["groups"] * with_groups
    schema = "part long, seq long, doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a binary, b binary" + ", groups string" * with_groups

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        (encode_a, table_a), (encode_b, table_b) = a(), b()
        va, vb, decimal = Vocabulary(table_a), Vocabulary(table_b), Names(max(len(table_a), len(table_b)))
        number, seq, held = TaskContext.get().partitionId() << 32, 0, 0
        for pdf, tx in texts(batches):
            xs, ys = [], []
            for t in tx:
                x, y = (encode_a(" " + t), encode_b(t)) if t else ([], [])
                raw = (" " + t).encode() if t else b""
                same = va.text(x) == raw == vb.text(y)
                xs.append(np.array(x if same else [], va.kind))
                ys.append(np.array(y if same else [], vb.kind))
            groups, text = aligned(xs, ys, va, vb, decimal)
            out = []
            for doc, x, y, n, g in zip(pdf["doc_id"].tolist(), xs, ys, groups.tolist(), text):
                if held > part:
                    number, held = number + 1, 0
                seq += 1
                held += len(x)
                out.append((number, seq, doc, len(x), len(y), n, len(x) + len(y) - n, hashlib.sha256(g).hexdigest() if g else "", x.tobytes(), y.tobytes(), *[g.decode()] * with_groups))
            yield pd.DataFrame(out, columns=names)

    return spool.write(docs.select(id_sent("doc_id"), "text").mapInPandas(run, schema))


def _batch_links(frames: list[tuple[bytes, bytes]], va: Vocabulary, vb: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(packed pairs, number of links up to the end of each document) of some documents, read as one sequence of bytes."""
    a, b = (np.frombuffer(b"".join(f[i] for f in frames), v.kind).astype(np.int64) for i, v in ((0, va), (1, vb)))
    ends_a, ends_b = np.cumsum(va.lengths[a]), np.cumsum(vb.lengths[b])
    last = np.cumsum([len(f[0]) // np.dtype(va.kind).itemsize for f in frames])  # tokens of A up to the end of each document
    keys, place = links(a, b, ends_a, ends_b)
    return keys, np.concatenate([[0], place + 1])[last]


def _lots(pdf: pd.DataFrame) -> Iterator[tuple[slice, list[tuple[bytes, bytes]]]]:
    """Consecutive rows of at most LOT bytes of ids (or one row)."""
    rows, n, begin = [], 0, 0
    for i, (x, y) in enumerate(zip(pdf["a"].tolist(), pdf["b"].tolist())):
        if rows and n + len(x) + len(y) > LOT:
            yield slice(begin, i), rows
            rows, n, begin = [], 0, i
        rows.append((bytes(x), bytes(y)))
        n += len(x) + len(y)
    if rows:
        yield slice(begin, begin + len(rows)), rows


def partial_counts(table: DataFrame, spool: Spool, a: Callable = byte_table, b: Callable = piece_table) -> DataFrame:
    """part, key, n: of each part's pairs, how many of its documents hold them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        va, vb = Vocabulary(a()[1]), Vocabulary(b()[1])
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def out(part: int) -> pd.DataFrame:
            keys, n = held.pop(part)
            return pd.DataFrame({"part": np.full(len(keys), part), "key": keys, "n": n})

        for pdf in batches:
            for part, rows in pdf.groupby("part", sort=False):
                for old in [p for p in held if p != part]:
                    yield out(old)
                for _, lot in _lots(rows):
                    keys, upto = _batch_links(lot, va, vb)
                    doc = np.repeat(np.arange(len(lot)), np.diff(upto, prepend=0))
                    keys = np.unique(doc << 2 * BITS | keys) & (1 << 2 * BITS) - 1  # once a document
                    keys, n = np.unique(keys, return_counts=True)
                    if part in held:
                        keys, n = np.concatenate([held[part][0], keys]), np.concatenate([held[part][1], n])
                        o = np.argsort(keys, kind="stable")
                        keys, n = keys[o], n[o]
                        first = np.flatnonzero(np.diff(keys, prepend=-1))
                        keys, n = keys[first], np.add.reduceat(n, first)
                    if len(keys):
                        held[part] = (keys, n.astype(np.int64))
        for part in list(held):
            yield out(part)

    return spool.write(table.select("part", "a", "b").mapInPandas(run, "part long, key long, n long"))


def run_sums(sorted_rows: DataFrame) -> DataFrame:
    """part, key, total, first of rows (part, key, n) that are sorted by key within partitions, equal keys in one partition.

    total: the sum of n over the key's run; first: whether the row is the first of its run. A run may go on in the next batch: its rows
    are held back, one for each part at most.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            x = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            keys = x["key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last run may not be whole
            rest = x.iloc[cut:]
            if cut:
                yield summed(x.iloc[:cut])
        if rest is not None and len(rest):
            yield summed(rest)

    def summed(x: pd.DataFrame) -> pd.DataFrame:
        keys, n = x["key"].to_numpy(), x["n"].to_numpy()
        first = np.diff(keys, prepend=-1) != 0
        at = np.flatnonzero(first)
        totals = np.add.reduceat(n, at)
        return pd.DataFrame({"part": x["part"].to_numpy(), "key": keys, "total": np.repeat(totals, np.diff(np.append(at, len(keys)))), "first": first})

    return sorted_rows.mapInPandas(run, "part long, key long, total long, first boolean")


class MappedShard:
    """A part's sorted keys and their counts in two memory-mapped files, which have no names any more and so go with the task."""

    def __init__(self) -> None:
        self.files, self.n = (tempfile.TemporaryFile(), tempfile.TemporaryFile()), 0  # noqa: SIM115
        self.keys = self.totals = np.empty(0, np.int64)

    def add(self, keys: np.ndarray, totals: np.ndarray) -> None:
        for f, x in zip(self.files, (keys, totals)):
            f.write(x.astype("<i8").tobytes())
        self.n += len(keys)

    def open(self) -> None:
        for f in self.files:
            f.flush()
        if self.n:
            self.keys, self.totals = (np.memmap(f, "<i8", "r", shape=(self.n,)) for f in self.files)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        return self.totals[np.searchsorted(self.keys, keys)]

    def close(self) -> None:
        self.keys = self.totals = np.empty(0, np.int64)
        for f in self.files:
            f.close()


def pair_counts(docs: DataFrame, a: Callable = byte_table, b: Callable = piece_table) -> DataFrame:
    """a_id, b_id, n_docs: every pair of ids that some document holds linked, with the number of such documents."""
    spool = Spool(docs.sparkSession, "alignment")
    totals = run_sums(partial_counts(encoded(docs, spool, a, b), spool, a, b).repartitionByRange("key").sortWithinPartitions("key"))
    return totals.filter("first").select(F.expr(f"CAST(shiftright(key, {BITS}) AS INT)").alias("a_id"), F.expr(f"CAST(key & {MASK} AS INT)").alias("b_id"), F.col("total").alias("n_docs"))


def align(docs: DataFrame, a: Callable = byte_table, b: Callable = piece_table, part: int = PART, with_groups: bool = False) -> DataFrame:
    """A row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and groups if asked for.

    n_best: links whose count is the highest of their first id in the corpus; count_sum: the sum of the counts of all links.
    """
    spark = docs.sparkSession
    spool = Spool(spark, "alignment")
    table = encoded(docs, spool, a, b, part, with_groups)
    partial = partial_counts(table, spool, a, b)
    totals = spool.write(run_sums(partial.repartitionByRange("key").sortWithinPartitions("key")))
    best = np.zeros(1 << BITS, np.int64)
    for r in totals.groupBy(F.expr(f"CAST(shiftright(key, {BITS}) AS INT)").alias("a")).agg(F.max("total").alias("n")).collect():  # one row a vocabulary entry
        best[r["a"]] = r["n"]
    best = spark.sparkContext.broadcast(best[: max(1, int(np.flatnonzero(best).max(initial=0)) + 1)])

    shards = totals.select("part", F.lit(0).alias("kind"), F.col("key").alias("ord"), "total", *[F.lit(None).cast(t).alias(c) for c, t in table.dtypes if c not in ("part", "seq")])
    rows = table.select("part", F.lit(1).alias("kind"), F.col("seq").alias("ord"), F.lit(None).cast("long").alias("total"), *[c for c in table.columns if c not in ("part", "seq")])
    told = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + ["groups"] * with_groups
    schema = ", ".join(f"{c} {'string' if c == 'doc_id' or c.startswith('groups') else 'long'}" for c in told)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        va, vb = Vocabulary(a()[1]), Vocabulary(b()[1])
        shard, of, ready = MappedShard(), None, False
        for pdf in batches:
            for (p, kind), x in pdf.groupby(["part", "kind"], sort=False):
                if p != of:
                    shard.close()
                    shard, of, ready = MappedShard(), p, False
                if kind == 0:
                    shard.add(x["ord"].to_numpy(np.int64), x["total"].to_numpy(np.int64))
                    continue
                if not ready:
                    shard.open()
                    ready = True
                for s, lot in _lots(x):
                    keys, upto = _batch_links(lot, va, vb)
                    n = shard.counts(keys)
                    upto = np.concatenate([[0], upto])
                    total, top = (np.concatenate([[0], np.cumsum(v)])[upto] for v in (n, n == best.value[keys >> BITS]))
                    out = x.iloc[s]
                    frame = {c: out[c].astype("int64") if c.startswith("n_") else out[c] for c in told if c in out.columns}
                    yield pd.DataFrame(frame | {"n_best": np.diff(top), "count_sum": np.diff(total)})[told]
        shard.close()

    both = shards.unionByName(rows)
    return both.repartition("part").sortWithinPartitions("part", "kind", "ord").mapInPandas(run, schema).withColumn("doc_id", id_received("doc_id"))
