"""Secret scans with DataFrame functions only.

Base kinds are regular expressions. Beyond them, candidate strings (runs of key-like characters) are scanned by a
window that slides over their characters: the window's character counts c (five bits each, twelve to a long) and the sum of
c*log2(c) are carried along, and a step changes both only by the one character that leaves and the one that enters. The highest window
entropy log2(w) - sum/w is held against a bar for the candidate's character class; candidates that an allow-list
pattern matches, and those that a base span touches, are suppressed.

Positions are code points, end exclusive. They follow from the pieces between matches: split() and
regexp_extract_all() see the same leftmost non-overlapping matches, so running lengths give starts and ends.

Defined cases: a null or empty text has no spans; repeated rows are scanned each; no row is dropped; an empty table gives no rows;
columns named base_spans or all_spans are replaced, others kept; texts and candidates of any length are scanned whole, matches
being placed in blocks of BLOCK, so that work grows with their number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind, pattern, group whose length counts, its least length. Fixed values.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),  # leftmost runs of AKIA[A-Z0-9]+ of 20 or more characters
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # whole runs of [0-9a-f]+ of 24 or more
)
KINDS = ("assign", "access", "hex", "entropy")
#: A text that none of these finds has no span of any kind.
ANY = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}|[A-Za-z0-9+/_=-]{20}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: The characters of candidates; their counts in a window, in longs of twelve.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
PER_LONG = 12
#: Matches placed at once.
BLOCK = 256
#: Character classes of candidates: pattern of the whole string, what it must also hold, bits of entropy that its best window must reach.
CLASSES = (
    ("hex", r"^[0-9A-Fa-f]+$", r"[0-9].*[A-Fa-f]|[A-Fa-f].*[0-9]", 2.9),
    ("lower case and digits", r"^[0-9a-z]+$", r"(?:[0-9][^0-9]*){4}", 3.6),
    ("upper case and digits", r"^[0-9A-Z]+$", r"(?:[0-9][^0-9]*){4}", 3.6),
    ("alphanumeric", r"^[0-9A-Za-z]+$", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])", 3.6),
    ("base64", r"^[0-9A-Za-z+/_=-]+$", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])", 3.7),
)
#: Benign strings: UUIDs, runs of one alphabet in order, placeholders, paths of plain words, rules of dashes.
ALLOW = (
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"(?i)0123456789|abcdefghijkl|example|placeholder|changeme|xxxxxx",
    r"(.)\1{7}",
    r"^[A-Za-z]{0,30}([/_-][A-Za-z]{0,30})+[0-9]{0,4}$",
)


def find(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>>: leftmost non-overlapping matches with code-point positions."""
    p = F.lit(pattern)
    between, found = F.split(text, pattern), F.regexp_extract_all(text, p, F.lit(0))
    pair = F.arrays_zip(F.transform(F.slice(between, 1, F.size(found)), lambda x: F.length(x).cast("long")).alias("gap"), found.alias("m"))
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("at"), F.array().cast("array<struct<s:bigint,e:bigint,m:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))

    def shifted(acc: Column, block: Column) -> Column:
        at = F.transform(block["out"], lambda x: F.struct((x["s"] + acc["at"]).alias("s"), (x["e"] + acc["at"]).alias("e"), x["m"].alias("m")))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], F.array(at)).alias("out"))

    def placed(all_: Column) -> Column:
        firsts = F.when(F.size(all_) > 0, F.sequence(F.lit(1), F.size(all_), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
        blocks = F.transform(firsts, lambda i: F.aggregate(F.slice(all_, i, BLOCK), start, step))  # places within a block
        none = F.struct(zero.alias("at"), F.array().cast("array<array<struct<s:bigint,e:bigint,m:string>>>").alias("out"))
        return F.aggregate(blocks, none, shifted, lambda acc: F.flatten(acc["out"]))

    return F.element_at(F.transform(F.array(pair), placed), 1)


def _f(c: Column) -> Column:
    """c * log2(c), 0 at 0."""
    return F.when(c > 0, c * F.log2(F.greatest(c, F.lit(1)).cast("double"))).otherwise(F.lit(0.0))


def _place(code: Column) -> tuple[Column, Column]:
    """Which long holds a character's count (from 0), and at which bit."""
    return F.floor(code / PER_LONG), 5 * F.pmod(code, F.lit(PER_LONG))


def _moved(counts: Column, code: Column, by: int) -> Column:
    """counts with a character's count changed by 1 or -1."""
    at, bit = _place(code)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    return F.transform(counts, lambda v, k: F.when(k == at, v + by * one).otherwise(v))


def _count(counts: Column, code: Column) -> Column:
    at, bit = _place(code)
    return F.call_function("shiftright", F.element_at(counts, (at + 1).cast("int")), bit).bitwiseAND(F.lit(31).cast("long"))


def best_entropy(s: Column, width: int = WINDOW) -> Column:
    """The highest Shannon entropy of a window of `width` (at most 31) characters of s, at least that long and of ALPHABET."""

    def scan_(codes: Column) -> Column:
        n = F.size(codes)
        empty = F.array_repeat(F.lit(0).cast("long"), -(-len(ALPHABET) // PER_LONG))

        def grow(acc: Column, x: Column) -> Column:
            c = _count(acc["counts"], x)
            return F.struct(_moved(acc["counts"], x, 1).alias("counts"), (acc["sum"] + _f(c + 1) - _f(c)).alias("sum"))

        def step(acc: Column, i: Column) -> Column:
            leaves, enters = F.element_at(codes, i - width), F.element_at(codes, i)
            out = _count(acc["counts"], leaves)
            into = _count(acc["counts"], enters) - F.when(leaves == enters, 1).otherwise(0)
            now = acc["sum"] + _f(out - 1) - _f(out) + _f(into + 1) - _f(into)
            return F.struct(_moved(_moved(acc["counts"], leaves, -1), enters, 1).alias("counts"), now.alias("sum"), F.least(acc["least"], now).alias("least"))

        steps = F.when(n > width, F.sequence(F.lit(width + 1), n)).otherwise(F.array().cast("array<int>"))
        first = F.aggregate(F.slice(codes, 1, width), F.struct(empty.alias("counts"), F.lit(0.0).alias("sum")), grow)
        # the first window once, as a variable of its own
        best = F.transform(F.array(first), lambda w: F.aggregate(steps, F.struct(w["counts"].alias("counts"), w["sum"].alias("sum"), w["sum"].alias("least")), step, lambda acc: acc["least"]))
        return F.lit(math.log2(width)) - F.element_at(best, 1) / F.lit(float(width))

    codes = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return F.element_at(F.transform(F.array(codes), scan_), 1)


def suspicious(s: Column, allow: tuple[str, ...] = ALLOW) -> Column:
    """Whether a candidate's class asks for no more entropy than its best window has, and no allow-list pattern is in it."""
    bar = F.lit(None).cast("double")
    for _, whole, also, bits in reversed(CLASSES):
        bar = F.when(s.rlike(whole), F.when(s.rlike(also), F.lit(bits))).otherwise(bar)
    ok = bar.isNotNull()
    for a in allow:
        ok = ok & ~s.rlike(a)
    return F.when(ok, best_entropy(s) >= bar).otherwise(F.lit(False))


def secret_spans(text: Column) -> Column:
    """array<struct<s, k, e>>: spans by start, then kind (an index into KINDS)."""
    of = []
    for k, (_, pattern, group, least) in enumerate(BASE):
        got = find(text, pattern)
        if group:
            got = F.filter(got, lambda x: F.length(F.regexp_extract(x["m"], pattern, group)) >= least)  # noqa: B023
        of.append(F.transform(got, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"))))
    return F.array_sort(F.concat(*of))


def entropy_spans(text: Column, base: Column, allow: tuple[str, ...] = ALLOW) -> Column:
    meets = lambda b, x: (b["s"] < x["e"]) & (x["s"] < b["e"])

    def block(spans: Column) -> Column:
        return F.struct(F.array_min(F.transform(spans, lambda b: b["s"])).alias("s"), F.array_max(F.transform(spans, lambda b: b["e"])).alias("e"), spans.alias("spans"))

    def beside(blocks: Column) -> Column:  # a candidate is held against the spans of the blocks that it meets
        free = lambda x: ~F.exists(blocks, lambda b: meets(b, x) & F.exists(b["spans"], lambda y: meets(y, x)))
        return F.filter(find(text, CANDIDATE), lambda x: free(x) & suspicious(x["m"], allow))

    firsts = F.when(F.size(base) > 0, F.sequence(F.lit(1), F.size(base), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    got = F.element_at(F.transform(F.array(F.transform(firsts, lambda i: block(F.slice(base, i, BLOCK)))), beside), 1)
    return F.transform(got, lambda x: F.struct(x["s"].alias("s"), F.lit(len(BASE)).alias("k"), x["e"].alias("e")))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """docs with base_spans and all_spans, arrays of struct<s, k, e>; texts that cannot match skip the positions' work."""
    none = F.array().cast("array<struct<s:bigint,k:int,e:bigint>>")
    t = F.coalesce(F.col(text), F.lit(""))
    hit = t.rlike(ANY)
    rest = docs.drop("base_spans", "all_spans")
    base = rest.withColumn("base_spans", F.when(hit, secret_spans(t)).otherwise(none))
    return base.withColumn("all_spans", F.when(hit, F.array_sort(F.concat("base_spans", entropy_spans(t, F.col("base_spans"), allow)))).otherwise(none))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans."""
    s = scan(docs.select("doc_id", "text"))
    n = lambda k: F.size(F.filter("all_spans", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return s.select("doc_id", n(0), n(1), n(2), n(3), F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256"), joined(F.col("all_spans")).alias("spans"))
