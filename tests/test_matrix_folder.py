"""Matrix folders as a data source: ranges, slices, numbering, the writer's round trip."""

import gzip
import re

import numpy as np
import pytest

from heliograph.operators.guards import ContractError
from heliograph.sources import matrix, readers


@pytest.fixture(scope="module")
def plain(tmp_path_factory):
    d = tmp_path_factory.mktemp("m")
    rng = np.random.default_rng(3)
    x = rng.poisson(0.4, (40, 900))
    x[:, 7] = 0
    (d / "features.tsv").write_text("".join(f"id{i}\tg{i}\t{'Peaks' if i % 4 == 0 else 'Gene Expression'}\n" for i in range(40)))
    (d / "barcodes.tsv").write_text("".join(f"c{i}\n" for i in range(900)))
    f, c = np.nonzero(x)
    body = "".join(f"{i + 1} {j + 1} {x[i, j]}\n" for i, j in zip(f, c)) + "3 8 0\n"  # a stored zero
    (d / "matrix.mtx").write_text(f"%%MatrixMarket matrix coordinate integer general\n% note\n40 900 {len(f) + 1}\n" + body)
    return str(d), {(f"c{j}", f"g{i}"): float(x[i, j]) for i, j in zip(f, c)}


def entries(df):
    got = [((r["cell"], r["feature"]), r["value"]) for r in df.collect()]
    assert len(got) == len(dict(got))
    return dict(got)


def test_slices_are_parsed_out_in_the_reader(spark, plain, capsys):
    path, want = plain
    assert entries(matrix.read_slice(spark, path)) == want == entries(readers.read_mtx(spark, path))
    peaks = matrix.read_slice(spark, path, "feature_type = 'Peaks'")
    assert entries(peaks) == {k: v for k, v in want.items() if int(k[1][1:]) % 4 == 0}
    peaks.explain("formatted")
    plan = capsys.readouterr().out
    assert re.search(r"PushedFilters: .*EqualTo\(feature_type,Peaks\)", plan) and "Condition : isnotnull(feature" not in plan  # nothing is left for Spark to filter
    for where, test in (("feature IN ('g3', 'g5', 'nowhere')", lambda i: i in (3, 5)), ("position BETWEEN 5 AND 9", lambda i: 4 <= i <= 8), ("position > 38 AND feature_type = 'Gene Expression'", lambda i: i > 37 and i % 4), ("feature = 'nowhere'", lambda i: False), ("feature LIKE 'g1%'", lambda i: str(i)[0] == "1")):
        assert entries(matrix.read_slice(spark, path, where)) == {k: v for k, v in want.items() if test(int(k[1][1:]))}


@pytest.mark.parametrize("size,block", [(1, 1), (7, 3), (64, 5), (1000, 4096), (1 << 20, 97)])
def test_every_line_lies_in_one_range(plain, monkeypatch, size, block):
    path, want = plain
    monkeypatch.setattr(matrix, "RANGE", size if size > 60 else 61 * size)
    monkeypatch.setattr(matrix, "BLOCK", block)
    r = matrix.MatrixReader(path)
    parts = r.partitions()
    assert len(parts) > 1 or size == 1 << 20
    # ranges begin within the header too, so the check is on lines
    text = open(f"{path}/matrix.mtx", "rb").read()
    lines = [x for p in parts for b in matrix._blocks(matrix._open(path)[0], p) for x in b.splitlines()]
    assert lines == text.splitlines()


def test_gzip_and_ranges_give_the_same_entries(spark, plain, tmp_path, monkeypatch):
    path, want = plain
    for n in ("features.tsv", "barcodes.tsv", "matrix.mtx"):
        with open(f"{path}/{n}", "rb") as f:
            (tmp_path / f"{n}.gz").write_bytes(gzip.compress(f.read()))
    assert entries(matrix.read_slice(spark, str(tmp_path))) == want
    monkeypatch.setattr(matrix, "BLOCK", 50)
    r = matrix.MatrixReader(str(tmp_path))
    assert len(r.partitions()) == 1 and sum(b.num_rows for b in r.read(r.partitions()[0])) == len(want)


def test_broken_folders(plain, tmp_path):
    (tmp_path / "features.tsv").write_text("a\tA\n")
    (tmp_path / "barcodes.tsv").write_text("c\n")
    with pytest.raises(FileNotFoundError):
        matrix.parts_of(str(tmp_path), "matrix")
    for body in ("1 1\n", "2 1 5\n", "1 1 x\n"):
        (tmp_path / "matrix.mtx").write_text("%%MatrixMarket\n1 1 1\n" + body)
        r = matrix.MatrixReader(str(tmp_path))
        with pytest.raises(ContractError):
            [*r.read(r.partitions()[0])]
    (tmp_path / "matrix.mtx").write_text("%%MatrixMarket\n1 1 0\n")
    r = matrix.MatrixReader(str(tmp_path))
    assert [*r.read(r.partitions()[0])] == []


def test_written_folders_are_read_back(spark, tmp_path):
    rows = [(f"c{i % 70:03}", f"f{i % 31}", "Peaks" if i % 2 else "Gene Expression", i / 8 + 1) for i in range(70 * 31)]
    fact = spark.createDataFrame(rows, "cell string, feature string, feature_type string, value double").repartition(5)
    path = str(tmp_path / "w")
    matrix.write_folder(fact, path)
    assert readers.is_10x_dir(spark, path)
    assert sorted(tuple(r) for r in matrix.read_slice(spark, path).drop("position").collect()) == sorted(rows)
    assert matrix.read_slice(spark, path, "feature_type = 'Peaks'").count() == sum(r[2] == "Peaks" for r in rows)
    assert sorted(tuple(r) for r in readers.read_mtx(spark, path).drop("position").collect()) == sorted(rows)
    lines = matrix.numbered_lines(spark, f"{path}/barcodes.tsv").orderBy("i").collect()
    assert [r["i"] for r in lines] == list(range(1, 71)) and [r["line"] for r in lines] == sorted(r["line"] for r in lines)


def test_the_writers_tasks_take_few_bytes(spark, tmp_path, monkeypatch):
    from heliograph.operators import cut

    key, seen, real = "spark.sql.adaptive.advisoryPartitionSizeInBytes", [], cut.cut
    before = spark.conf.get(key)
    monkeypatch.setattr(cut, "cut", lambda df: seen.append(spark.conf.get(key)) or real(df))
    fact = spark.createDataFrame([("c", "f", "Peaks", 1.0)], "cell string, feature string, feature_type string, value double")
    matrix.write_folder(fact, str(tmp_path / "w"))
    assert set(seen) == {str(16 << 20)} and spark.conf.get(key) == before
    with pytest.raises(Exception):
        matrix.write_folder(fact.drop("value"), str(tmp_path / "v"))
    assert spark.conf.get(key) == before
