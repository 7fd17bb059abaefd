"""A data source for matrix folders: entries by byte ranges, with slices of features pushed into the reader; and a writer of such folders.

    spark.dataSource.register(MatrixFolder)
    spark.read.format("matrix_folder").load(path).filter("feature_type = 'Peaks'")

A folder holds `matrix*` (Matrix Market, coordinate form), `features*` and `barcodes*`, each a file or a folder of parts in the order of
their names. The reader tells cells by number; read_slice() puts their names on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from heliograph.operators.guards import ContractError

#: Bytes of a partition, and of the blocks in which a task reads it.
RANGE, BLOCK = 64 << 20, 4 << 20
#: Shuffled bytes that a task of the writer takes (compressed: some 14 a row of a fact, which take 160 in an aggregate).
TASK = 16 << 20
SCHEMA = "feature string, feature_type string, position int, cell_number long, value double"
_ARROW = pa.schema([("feature", pa.string()), ("feature_type", pa.string()), ("position", pa.int32()), ("cell_number", pa.int64()), ("value", pa.float64())])


def _triples(block: bytes, path: str) -> np.ndarray:
    """A row a line of three numbers; blank lines are passed over."""
    try:
        x = np.fromstring(block, sep=" ")
    except ValueError as e:
        raise ContractError(f"{path}: {e}") from e
    if len(x) != 3 * block.count(b"\n") and len(x) != 3 * sum(1 for line in block.splitlines() if line.strip()):
        raise ContractError(f"{path}: a line of other than three numbers")
    return x.reshape(-1, 3)


@dataclass
class Range(InputPartition):
    """Lines that begin in [start, end) of a file; head: the file begins with the matrix's header."""

    path: str
    start: int
    end: int
    head: bool


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def parts_of(path: str, kind: str) -> list[tuple[str, int]]:
    """(file, length) of the folder's matrix, features or barcodes, in order."""
    fs, p = _open(path)
    visible = lambda where: sorted((f for f in fs.get_file_info(pafs.FileSelector(where)) if not f.base_name.startswith(("_", "."))), key=lambda f: f.base_name)
    found = [f for f in visible(p) if f.base_name.startswith(kind)]
    if not found:
        raise FileNotFoundError(f"no {kind} in {path}")
    inner = [found[0]] if found[0].type == pafs.FileType.File else visible(found[0].path)
    return [(f.path, f.size) for f in inner]


def _blocks(fs: pafs.FileSystem, part: Range) -> Iterator[bytes]:
    """Whole lines of a range, in blocks; a line belongs to the range in which it begins. A gzip file is one range."""
    whole = part.path.endswith(".gz")
    stream = fs.open_input_stream(part.path, compression="gzip") if whole else fs.open_input_file(part.path)
    with stream:
        rest, skipping, at = b"", part.start > 0, 0
        if skipping:  # from the byte before: if that ends a line, the next one begins here
            at = part.start - 1
            stream.seek(at)
        while (whole or at < part.end) and (got := stream.read(BLOCK if whole else min(BLOCK, part.end - at))):
            at += len(got)
            if skipping:
                begin = got.find(b"\n") + 1
                if not begin:
                    continue
                got, skipping = got[begin:], False
            end = got.rfind(b"\n") + 1
            if end:
                yield rest + got[:end]
            rest = got[end:] if end else rest + got
        while rest and not rest.endswith(b"\n") and (got := stream.read(4096)):  # the last line may end in the next range
            rest += got[: got.find(b"\n") + 1] or got
        if rest:
            yield rest


class MatrixReader(DataSourceReader):
    """Filters on feature, feature_type and position become one mask over positions, so entries outside never leave the parser."""

    def __init__(self, path: str) -> None:
        self.path, self.pushed = path, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else ""
            named = column in ("feature", "feature_type") and isinstance(f, (EqualTo, In, IsNotNull))
            placed = column == "position" and isinstance(f, (EqualTo, In, IsNotNull, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual))
            if named or placed:
                self.pushed.append(f)
            elif column in ("cell_number", "value") and isinstance(f, IsNotNull):
                continue  # never null
            else:
                yield f

    def partitions(self) -> list[Range]:
        out = []
        for i, (path, size) in enumerate(parts_of(self.path, "matrix")):
            step = max(size, 1) if path.endswith(".gz") else RANGE
            out += [Range(path, a, min(a + step, size), i == 0 and a == 0) for a in range(0, size, step)]
        return out

    def features(self) -> tuple[pa.Array, pa.Array]:
        """(names, types) by position. The features of a genome: megabytes, however many cells there are."""
        names, types = [], []
        fs, _ = _open(self.path)
        for path, size in parts_of(self.path, "features"):
            for block in _blocks(fs, Range(path, 0, size, False)):
                for line in block.decode().splitlines():
                    x = line.split("\t")
                    names.append(x[1] if len(x) > 1 else x[0])
                    types.append(x[2] if len(x) > 2 else None)
        return pa.array(names, pa.string()), pa.array(types, pa.string())

    def wanted(self, names: pa.Array, types: pa.Array) -> np.ndarray:
        """Which positions, from 1 on, all pushed filters take."""
        columns = {"feature": np.array(names.to_pylist(), object), "feature_type": np.array(types.to_pylist(), object), "position": np.arange(1, len(names) + 1)}
        mask = np.ones(len(names), bool)
        for f in self.pushed:
            x = columns[f.attribute[0]]
            if isinstance(f, IsNotNull):
                mask &= np.array([v is not None for v in x], bool)
            elif isinstance(f, In):
                among = {v for v in f.value if v is not None}
                mask &= np.fromiter((v in among for v in x), bool, len(x))
            elif isinstance(f, EqualTo):
                mask &= np.array(x == f.value, bool) if f.value is not None else False
            else:
                mask &= {GreaterThan: x > f.value, GreaterThanOrEqual: x >= f.value, LessThan: x < f.value, LessThanOrEqual: x <= f.value}[type(f)]
        return np.concatenate([[False], mask])

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        names, types = self.features()
        mask = self.wanted(names, types)
        if not mask.any():
            return
        head = partition.head
        for block in _blocks(_open(self.path)[0], partition):
            if head or b"%" in block:
                lines = [x for x in block.splitlines() if x.strip() and not x.startswith(b"%")]
                if head and lines:
                    lines, head = lines[1:], False  # the dimensions
                block = b"\n".join(lines)
            if not block.strip():
                continue
            x = _triples(block, partition.path)
            at = x[:, 0].astype(np.int64)
            if len(at) and (at.min() < 1 or at.max() >= len(mask)):
                raise ContractError(f"{partition.path}: an entry of a feature that is not listed")
            keep = mask[at] & (x[:, 2] != 0)
            if keep.any():
                place = pa.array(at[keep] - 1)
                yield pa.record_batch([names.take(place), types.take(place), pa.array(at[keep].astype(np.int32)), pa.array(x[keep, 1].astype(np.int64)), pa.array(x[keep, 2])], schema=_ARROW)


class MatrixFolder(DataSource):
    """Entries other than 0 of a matrix folder: feature, feature_type, position, cell_number (both from 1), value."""

    @classmethod
    def name(cls) -> str:
        return "matrix_folder"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MatrixReader:
        return MatrixReader(self.options["path"])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """i (from 1), line of a text file or a folder of parts in the order of their names.

    Lines are counted by block of a file, so that numbering neither sorts nor gathers them; what is ordered is one row a block.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line"))
    blocks = raw.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("_file", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return raw.join(blocks, ["_file", "_block"]).select((F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("i"), "line")


def cell_names(spark: SparkSession, path: str) -> DataFrame:
    """cell_number, cell of a matrix folder."""
    from heliograph.sources.readers import names_in

    name = next(x for x in names_in(spark, path) if x.startswith("barcodes"))
    return numbered_lines(spark, f"{path}/{name}").select(F.col("i").alias("cell_number"), F.element_at(F.split("line", "\t"), 1).alias("cell"))


def read_slice(spark: SparkSession, path: str, where: Column | str | None = None) -> DataFrame:
    """cell, feature, feature_type, position, value of a matrix folder, of the features that `where` names.

    `where` may name feature, feature_type and position; equality, lists and (for positions) bounds are tested where entries are parsed.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MatrixFolder)
    entries = spark.read.format("matrix_folder").load(path)
    entries = entries if where is None else entries.filter(where)
    return entries.join(cell_names(spark, path), "cell_number").select("cell", "feature", "feature_type", "position", "value")


def write_folder(fact: DataFrame, path: str) -> None:
    """fact (cell, feature, feature_type, value) as a matrix folder of part files; cells and features are numbered in their order.

    The header's file sorts before the parts. A feature is a name and its type; rows with a null name or type are left out, and names hold
    no tabs or line ends. What makes the fact runs here too, in tasks of TASK shuffled bytes.
    """
    spark, advisory = fact.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, str(TASK))
    try:
        _write(spark, fact, path)
    finally:
        spark.conf.set(advisory, before)


def _write(spark: SparkSession, fact: DataFrame, path: str) -> None:
    from heliograph.operators.cut import cut
    from heliograph.operators.order import numbered
    from heliograph.sources.sinks import write_text

    cells = cut(numbered(fact.select(F.col("cell").cast("string").alias("cell")).distinct(), ["cell"]).select("cell", F.col("n").alias("c")))
    features = cut(numbered(fact.select(F.col("feature").cast("string").alias("feature"), "feature_type").distinct(), ["feature_type", "feature"]).select("feature", "feature_type", F.col("n").alias("f")))
    text = lambda df, n, line, name: df.repartitionByRange(n).sortWithinPartitions(n).select(line).write.mode("overwrite").text(f"{path}/{name}")
    text(cells, "c", F.col("cell"), "barcodes.tsv")
    text(features, "f", F.concat_ws("\t", "feature", "feature", "feature_type"), "features.tsv")
    rows = fact.withColumns({"cell": F.col("cell").cast("string"), "feature": F.col("feature").cast("string")}).join(features, ["feature", "feature_type"]).join(cells, "cell")
    rows.select(F.concat_ws(" ", "f", "c", F.col("value").cast("double"))).write.mode("overwrite").text(f"{path}/matrix.mtx")
    size = f"{features.count()} {cells.count()} {spark.read.text(f'{path}/matrix.mtx').count()}"
    write_text(spark, f"%%MatrixMarket matrix coordinate real general\n{size}\n", f"{path}/matrix.mtx/header.mtx")
