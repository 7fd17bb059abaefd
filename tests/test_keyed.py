"""One table over all datasets: a rerun replaces its own partition alone; failures are rows."""

import json
import os

import pytest

from heliograph.operators import activity
from heliograph.plans import batch
from heliograph.sources.keyed import KeyedTable

SCHEMA = "dataset string, tf string, peak string, gene string, project_id string, sample_id string, gpt_cell_type string, active_cell_count long, group_total_cells long"


def scores(spark, d, n, active=30):
    rows = [(d, f"t{i}", f"p{i}", f"g{i}", "P", s, "T", active if i % 2 else 1, 100) for i in range(n) for s in ("a", "b")]
    return spark.createDataFrame(rows, SCHEMA)


def place(df, root, d):
    df.write.mode("overwrite").parquet(f"{root}/{d}/triplet_active_scores.with_active_cells.parquet")


def test_rerun_replaces_one_partition(spark, tmp_path):
    root, table = str(tmp_path / "in"), str(tmp_path / "table")
    for d, n in (("d1", 6), ("d2", 10), ("0301", 4)):
        place(scores(spark, d, n), root, d)
    place(scores(spark, "d4", 3).drop("gene"), root, "d4")
    place(scores(spark, "other", 3), root, "d5")
    os.makedirs(f"{root}/d6")
    names = ["d1", "d2", "0301", "d4", "d5", "d6"]
    first = batch.filter_datasets(spark, root, names, table)
    assert [(r["dataset"], r["status"]) for r in first] == [("d1", "ok"), ("d2", "ok"), ("0301", "ok"), ("d4", "failed"), ("d5", "failed"), ("d6", "skipped")]
    assert [(r["source_rows"], r["kept_rows"], r["source_keys"], r["kept_keys"]) for r in first[:3]] == [(12, 6, 6, 3), (20, 10, 10, 5), (8, 4, 4, 2)]
    k = KeyedTable(spark, table)
    held = lambda: {tuple(r) for r in k.get().select("dataset", "tf", "sample_id", "dataset_active_cell_count").collect()}
    want = {tuple(r) for d, n in (("d1", 6), ("d2", 10), ("0301", 4)) for r in activity.dataset_filter(scores(spark, d, n)).select("dataset", "tf", "sample_id", "dataset_active_cell_count").collect()}
    assert held() == want
    files = lambda d: sorted((f, os.stat(f"{table}/rows/dataset={d}/{f}").st_mtime_ns) for f in os.listdir(f"{table}/rows/dataset={d}"))
    before = files("d2")
    place(scores(spark, "d1", 4), root, "d1")
    assert batch.filter_datasets(spark, root, ["d1"], table)[0]["kept_rows"] == 4
    assert files("d2") == before and {r[1] for r in held() if r[0] == "d1"} == {"t1", "t3"} and {r for r in held() if r[0] != "d1"} == {r for r in want if r[0] != "d1"}
    # nothing above the thresholds: the dataset's rows go; a failure leaves them
    place(scores(spark, "d1", 4, active=0), root, "d1")
    place(scores(spark, "d2", 4).drop("tf"), root, "d2")
    again = batch.filter_datasets(spark, root, ["d1", "d2"], table)
    assert [(r["status"], r.get("kept_rows")) for r in again] == [("ok", 0), ("failed", None)]
    assert {r[0] for r in held()} == {"d2", "0301"} and files("d2") == before
    latest = {r["dataset"]: (r["status"], r["kept_rows"]) for r in k.latest().collect()}
    assert latest["d1"] == ("ok", 0) and latest["d2"] == ("failed", None) and latest["d6"][0] == "skipped" and spark.read.parquet(f"{table}/status").count() == 9
    with pytest.raises(ValueError):
        k.put(scores(spark, "d1", 2), ["d2"])


def test_command(spark, tmp_path):
    root = str(tmp_path / "in")
    place(scores(spark, "d1", 6), root, "d1")
    args = ["dataset-filter", "--backend-root", root, "--summary", f"{tmp_path}/s.json", "--one-table", f"{tmp_path}/t"]
    assert batch.main(args) == 0 and json.loads((tmp_path / "s.json").read_text())[0]["kept_rows"] == 6
    assert KeyedTable(spark, f"{tmp_path}/t").get().count() == 6
    os.makedirs(f"{root}/d2")
    assert batch.main(args) == 0


def test_nothing_kept_and_names_of_digits(spark, tmp_path):
    root, k = str(tmp_path / "in"), KeyedTable(spark, f"{tmp_path}/t")
    place(scores(spark, "007", 3, active=0), root, "007")
    got = batch.filter_datasets(spark, root, ["007"], f"{tmp_path}/t")
    assert (got[0]["status"], got[0]["source_rows"], got[0]["kept_rows"]) == ("ok", 6, 0) and k.get(scores(spark, "x", 1).schema).count() == 0
    assert batch.filter_datasets(spark, root, [], f"{tmp_path}/t") == []
    place(scores(spark, "007", 3), root, "007")
    batch.filter_datasets(spark, root, ["007"], f"{tmp_path}/t")
    assert {r["dataset"] for r in k.get().select("dataset").collect()} == {"007"}
