import json
import zipfile

import pytest

from weft.plans import pipeline
from weft.sources import tsv
from weft.streaming.ingest import ingest


def test_scan_of_dirty_lines(spark, tmp_path):
    path = tmp_path / "r.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tA "b" c\tnull\tUS\nS1-2\tshort\n\nS1-3\tback\\slash\tx\tUS\tmore\n', encoding="utf-8")
    got = sorted(tuple(r) for r in tsv.read_records(spark, str(path)).collect())
    assert got == [("S1-1", 'A "b" c', "null", "US"), ("S1-2", "short", None, None), ("S1-3", "back\\slash", "x", "US")]
    assert sorted(r[0] for r in tsv.read_ids(spark, str(path)).collect()) == ["S1-1", "S1-2", "S1-3"]
    with pytest.raises(FileNotFoundError):
        tsv.require_files([str(path), str(tmp_path / "no.tsv")])


def deliver(spark, small, folder, part):
    folder.mkdir(parents=True)
    for n in (1, 2, 3):
        frame = spark.read.parquet(f"{small}/train_source{n}.parquet").toPandas().fillna("")
        frame = frame.replace(r"[\t\r\n]", " ", regex=True)
        frame.to_csv(folder / f"{part}_source{n}.tsv", sep="\t", index=False, quoting=3, escapechar="\\")
    truth = spark.read.parquet(f"{small}/train_matches.parquet").toPandas().fillna("")
    truth.to_csv(folder / "train_ground_truth.tsv", sep="\t", index=False, quoting=3)


def test_files_to_lists(spark, small, tmp_path):
    deliver(spark, small, tmp_path / "dataset/train", "train")
    deliver(spark, small, tmp_path / "dataset/test", "test")
    pipeline.main(["--resource-root", str(tmp_path), "--work-dir", str(tmp_path / "work"), "--output-dir", str(tmp_path / "out"), "--trees", "2", "--train-percent", "60", "--validation-percent", "40", "--team", "Team / 1", "--blank-country"])
    metrics = json.loads((tmp_path / "out/run_metrics.json").read_text())
    assert metrics["prediction"]["candidates"] > 0 and 0 <= metrics["macro_f05"] <= 1
    lines = (tmp_path / "out/matching_results.tsv").read_text().splitlines()
    assert lines[0] == "source1_entity_id\tmatched_entity_ids"
    assert len(lines) - 1 == metrics["prediction"]["queries"] == len({line.split("\t")[0] for line in lines[1:]})
    assert 0 <= metrics["prediction"]["singleton_rate"] <= 1 and metrics["config"]["blank_country"]
    assert "queries without a link" in (tmp_path / "out/REVIEW.md").read_text() and "matching_results.tsv" in (tmp_path / "out/METHOD.md").read_text()
    assert sorted(zipfile.ZipFile(tmp_path / "out/Team_1.zip").namelist()) == ["METHOD.md", "REVIEW.md", "candidate_pairs.tsv", "matching_results.tsv"]
    (tmp_path / "out/matching_results.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS1-2\n")
    with pytest.raises(ValueError, match="self_match"):
        pipeline.deliver(spark, tmp_path / "dataset/test", tmp_path / "out", metrics, "x")
    assert "Review" in (tmp_path / "out/REVIEW.md").read_text()


def test_continuous_ingestion(spark, tmp_path):
    header = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    (tmp_path / "in").mkdir()
    for n in range(2):
        (tmp_path / f"in/{n}.tsv").write_text(header + f"S1-{n}\tTovarel Otter Foods\t{n} Mapelin Road\tUS\n")
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r.entity_id for r in spark.read.parquet(str(tmp_path / "out/records")).collect()) == ["S1-0", "S1-1"]
    assert spark.read.parquet(str(tmp_path / "out/signatures")).where("entity_id = 'S1-1'").count() > 0
