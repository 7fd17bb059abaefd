"""Names: peaks, chromosomes, cells, datasets, context labels, record headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels that count as missing, after trimming and lower-casing. Fixed values.
MISSING = ("", "na", "nan", "none", "null", "unknown", "notavailable", "not available", "-", "--")
#: Dataset name endings that tell the organism. Fixed values.
ORGANISMS = (("_Homo_sapiens", "Homo sapiens"), ("_Mus_musculus", "Mus musculus"))
PEAK = r"^([^:]+):(\d+)-(\d+)$"


def parse_peak(name: Column) -> Column:
    """struct<chrom, start, end> of `chrom:start-end`; null where the name has another form."""
    part = lambda i: F.regexp_extract(name, PEAK, i)
    return F.when(name.rlike(PEAK), F.struct(part(1).alias("chrom"), part(2).cast("long").alias("start"), part(3).cast("long").alias("end")))


def normalize_chrom(chrom: Column) -> Column:
    """chr1 to chrN, chrX, chrY, chrM whatever the prefix and case; other names unchanged."""
    bare = F.upper(F.regexp_replace(chrom, "^(?i)chr", ""))
    return F.when(bare.isin("M", "MT"), F.lit("chrM")).when(bare.rlike("^([0-9]+|X|Y)$"), F.concat(F.lit("chr"), bare)).otherwise(chrom)


def normalize_peak(name: Column) -> Column:
    """The trimmed name with its chromosome normalised; null stays null, another form than `chrom:start-end` raises."""
    trimmed = F.trim(name)
    part = lambda i: F.regexp_extract(trimmed, PEAK, i)
    wrong = F.raise_error(F.concat(F.lit("invalid peak name (expected chrom:start-end): "), name))
    return F.when(name.isNull(), F.lit(None).cast("string")).when(trimmed.rlike(PEAK), F.concat(normalize_chrom(part(1)), F.lit(":"), part(2), F.lit("-"), part(3))).otherwise(wrong)


def prefixed_cell(cell: Column, sample: Column) -> Column:
    """sample#cell, unless the cell has that prefix already."""
    prefix = F.concat(sample, F.lit("#"))
    return F.when(F.startswith(cell, prefix), cell).otherwise(F.concat(prefix, cell))


def sample_of(cell: Column) -> Column:
    """The text before the first #."""
    return F.element_at(F.split(cell, "#", 2), 1)


def organism(dataset: Column) -> Column:
    """Null where the name tells none."""
    out = F.lit(None).cast("string")
    for ending, name in ORGANISMS:
        out = F.when(F.endswith(dataset, F.lit(ending)), F.lit(name)).otherwise(out)
    return out


def accession(dataset: Column) -> Column:
    """The dataset name without the organism's ending."""
    return F.regexp_replace(dataset, "(" + "|".join(e for e, _ in ORGANISMS) + ")$", "")


def is_missing(label: Column) -> Column:
    return F.lower(F.trim(F.coalesce(label, F.lit("")))).isin(*MISSING)


def fasta_id(header: Column) -> Column:
    """`>id::region` or `>id description` -> id."""
    return F.element_at(F.split(F.element_at(F.split(F.regexp_replace(header, "^>", ""), "::", 2), 1), r"\s", 2), 1)


def cluster_order(cluster: Column) -> list[Column]:
    """Sort keys: numbers by value first, then other labels by name."""
    n = cluster.try_cast("bigint")
    return [n.isNull(), n, cluster]
