"""Packing token sequences by minimum bin slack.

Each task packs what it reads: whole windows are cut off every document, and the remaining lengths (1 to window - 1)
form a multiset. For the longest remaining length, subset sums of the others are kept as bits of one integer; the
sum closest to the window's rest is picked and the counts that make it are backtracked; an exact fill is repeated as
often as the counts allow. A window that no multiset fills is filled by cutting one piece, and what is left at a
task's end is cut into sequences of powers of two, which need no padding. So tasks need not hear of each other, nothing
is shuffled, and a task holds at most `hold` tokens.

Defined cases: a null or empty text has only the closing id; repeated rows are packed as rows of their own; an empty
table gives no pieces; other columns are ignored, whatever their names. A special token's string in a text is that token's id, as the
tokenizers library reads the file by default. Tails are packed in lots of at most `hold` tokens, a bound on a task's memory;
each lot is packed whole, so no piece is lost or padded for it. A text of any length is read whole.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import bounded_batches, id_received, id_sent

WINDOW = 1024
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def special_tokens(path: str | None = None) -> dict[str, int]:
    """The added tokens of the tokenizers file: string -> id."""
    with open(path or vocabulary_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}


def byte_bpe(path: str | None = None, special: dict[str, int] | None = None) -> Callable[[str], list[int]]:
    """Text -> ids of the byte-level BPE in byte_bpe_50k.json, special tokens' strings as their ids.

    byte_bpe_50k.tiktoken holds the same vocabulary as ranks, and tiktoken gives the same ids in a fifth of the
    time that the tokenizers library takes; tests compare the two.
    """
    import base64

    import public_tokenizers
    import tiktoken

    special = special_tokens() if special is None else special
    with open(path or vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    names = set(special)

    def encode(text: str) -> list[int]:
        if any(x in text for x in names):
            return bpe.encode(text, allowed_special=names, disallowed_special=())
        return bpe.encode_ordinary(text)

    return encode


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths (within counts) whose sum is closest to capacity from below; longest lengths first.

    Bit s of a layer is set if some multiset of the lengths so far sums to s.
    """
    mask = (1 << (capacity + 1)) - 1
    layers, used, bits = [], [], 1
    for length in sorted((x for x, n in counts.items() if n > 0 and x <= capacity), reverse=True):
        layers.append(bits)
        used.append(length)
        n, step = min(counts[length], capacity // length), 1
        while n > 0:  # binary parts of the count
            take = min(step, n)
            bits |= (bits << (length * take)) & mask
            n -= take
            step *= 2
        if bits >> capacity & 1:
            break
    total, out = bits.bit_length() - 1, {}
    for length, before in zip(reversed(used), reversed(layers)):
        m = 0
        while not before >> total & 1:
            total -= length
            m += 1
        if m:
            out[length] = m
    return out


def minimum_slack(pieces: dict[int, list], window: int, cut: Callable) -> Iterator[list]:
    """Empties pieces (length -> stack of pieces) into lists of pieces that fill a window, then the tail.

    cut(piece, n) -> (first n ids, the rest).
    """
    counts = {x: len(v) for x, v in pieces.items() if v}

    def take(length: int):
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
        return pieces[length].pop()

    while counts:
        first = max(counts)
        counts[first] -= 1
        pick = closest_fill(counts, window - first)
        counts[first] += 1
        pick[first] = pick.get(first, 0) + 1
        slack = window - sum(x * n for x, n in pick.items())
        times = 1 if slack else min(counts[x] // n for x, n in pick.items())
        for _ in range(times):
            out = [take(x) for x, n in pick.items() for _ in range(n)]
            if slack:
                if counts:  # nothing left fits: every length is over the slack
                    length = min(counts)
                    head, rest = cut(take(length), slack)
                    out.append(head)
                    counts[length - slack] = counts.get(length - slack, 0) + 1
                    pieces.setdefault(length - slack, []).append(rest)
                else:
                    yield from tail(out, window - slack, cut)
                    return
            yield out


def tail(pieces: list, total: int, cut: Callable) -> Iterator[list]:
    """The last pieces, cut into sequences whose lengths are powers of two."""
    pieces = pieces[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        room, out = total & (1 << bit), []
        while room:
            p = pieces.pop()
            if p[2] > room:
                p, rest = cut(p, room)
                pieces.append(rest)
            room -= p[2]
            out.append(p)
        if out:
            yield out


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = 0, path: str | None = None, hold: int = 8_000_000, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encode = byte_bpe(path)
        number, held = TaskContext.get().partitionId() << 36, 0
        pieces: dict[int, list] = defaultdict(list)
        out: list[list] = []

        def cut(p: tuple, n: int) -> tuple[tuple, tuple]:
            return (p[0], p[1], n, p[3]), (p[0], p[1] + n, p[2] - n, p[3])

        def put(sequence: list) -> None:
            nonlocal number
            offset = 0
            for doc, start, length, ids in sequence:
                part = ids[start : start + length]
                out.append([doc, start, length, zlib.crc32(part.astype("<u4").tobytes()), len(ids), number, offset, *([part.tolist()] if with_ids else [])])
                offset += length
            number += 1

        names = [x.split()[0] for x in SCHEMA.split(", ")] + ["ids"] * with_ids

        def flush() -> Iterator[pd.DataFrame]:
            nonlocal held
            for s in minimum_slack(pieces, window, cut):
                put(s)
            pieces.clear()
            held = 0
            yield from ready()

        def ready() -> Iterator[pd.DataFrame]:
            while out:
                part = out[:50_000]
                del out[:50_000]
                yield pd.DataFrame(part, columns=names)

        for pdf in batches:
            for doc, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                ids = np.array([*(encode(text) if text is not None and text == text else ()), end_id], np.uint32)
                whole = len(ids) // window * window
                for start in range(0, whole, window):
                    put([(doc, start, window, ids)])
                if whole < len(ids):
                    pieces[len(ids) - whole].append((doc, whole, len(ids) - whole, ids))
                    held += len(ids)
                if len(out) > 50_000:
                    yield from ready()
                if held > hold:
                    yield from flush()
        yield from flush()

    bounded_batches(docs.sparkSession)
    out = docs.select(id_sent("doc_id"), "text").mapInPandas(run, SCHEMA.replace("doc_id long", "doc_id string") + (", ids array<long>" if with_ids else ""))
    return out.withColumn("doc_id", id_received("doc_id"))
