"""The linkage pipeline over delivered files: train a matcher, then write match and candidate lists.

    python -m weft.plans.pipeline --resource-root DIR --work-dir DIR --output-dir DIR [--stage all|train|infer]

DIR/dataset/train holds train_source{1,2,3}.tsv and train_ground_truth.tsv, DIR/dataset/test the test_source files.
"""

from __future__ import annotations

import argparse
import re
import zipfile
from dataclasses import asdict, replace
from hashlib import sha256
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.config import LinkConfig
from weft.operators import blocking, evaluation, features, lists, model, records
from weft.session import cut
from weft.sources import tsv


def _targets(spark: SparkSession, folder: Path, part: str) -> DataFrame:
    frames = [records.normalise_records(tsv.read_records(spark, str(folder / f"{part}_source{n}.tsv"))).withColumn("target_source", F.lit(n)) for n in (2, 3)]
    return frames[0].unionByName(frames[1])


def train(spark: SparkSession, folder: Path, model_path: str, config: LinkConfig) -> dict:
    """Fit and save the model; returns the metrics of the run."""
    tsv.require_files([str(folder / f"train_source{n}.tsv") for n in (1, 2, 3)] + [str(folder / "train_ground_truth.tsv")])
    everyone = records.normalise_records(tsv.read_records(spark, str(folder / "train_source1.tsv")))
    pairs = cut(features.truth_pairs(tsv.read_truth(spark, str(folder / "train_ground_truth.tsv"))))
    split = features.split_queries(everyone, config.train_percent, config.validation_percent)
    queries, targets = cut(split.drop("split")), cut(_targets(spark, folder, "train"))
    candidates = cut(blocking.retrieve(queries, targets, config, texts=True))
    rows = cut(features.labelled(features.pair_features(candidates), pairs))
    parts = split.select(F.col("entity_id").alias("query_id"), "split")
    training = rows.join(parts.where("split = 'train'"), "query_id", "left_semi")
    fitted = model.fit_model(training, config)
    model.save_model(fitted, model_path)
    asked = split.where("split = 'validation'")
    scored = cut(model.score(fitted, rows.join(parts.where("split = 'validation'"), "query_id", "left_semi")))
    sweep = evaluation.threshold_sweep(evaluation.truth_counts(asked, pairs), scored).collect()
    best = max(sweep, key=lambda r: (round(r.macro_f05, 9), -r.threshold)) if sweep else None
    return {
        "config": asdict(config),
        "blocking": blocking.blocking_stats(queries, candidates).first().asDict(),
        "recall": evaluation.blocking_recall(queries, candidates, pairs).first().asDict(),
        "positive_rate": training.agg(F.avg("label")).first()[0],
        "threshold": best.threshold if best else 0.5,
        "macro_f05": best.macro_f05 if best else None,
        "history": sorted(([r.threshold, r.macro_f05] for r in sweep), key=lambda x: (-x[1], x[0]))[:20],
        "importances": model.importances(fitted),
    }


def infer(spark: SparkSession, folder: Path, out: Path, model_path: str, metrics: dict, config: LinkConfig) -> dict:
    """Score the candidates of all test records and write both lists."""
    tsv.require_files([str(folder / f"test_source{n}.tsv") for n in (1, 2, 3)])
    queries = cut(records.normalise_records(tsv.read_records(spark, str(folder / "test_source1.tsv"))))
    targets = cut(_targets(spark, folder, "test"))
    candidates = cut(blocking.retrieve(queries, targets, config, texts=True))
    scored = cut(model.score(model.load_model(model_path), features.pair_features(candidates)))
    out.mkdir(parents=True, exist_ok=True)
    lists.write_tsv(lists.match_lists(queries, scored, metrics["threshold"]), str(out / "matching_results.tsv"), single_file=True)
    lists.write_tsv(lists.candidate_lists(queries, candidates), str(out / "candidate_pairs.tsv"), single_file=True)
    return metrics | {"prediction": prediction_counts(queries, scored, metrics["threshold"]) | {"candidates": candidates.count()}}


def prediction_counts(queries: DataFrame, scored: DataFrame, threshold: float) -> dict:
    """queries, links and matched_entities at a threshold, links a query, and the share of queries without a link (0 without queries)."""
    counted = scored.sparkSession.sql(
        "select count(*) as links, count(distinct query_id) as matched_entities from {scored} where probability >= :threshold", args={"threshold": threshold}, scored=scored
    ).first()
    n = queries.count()
    rates = {"links_per_query": counted.links / n if n else 0.0, "singleton_rate": 1 - counted.matched_entities / n if n else 0.0}
    return {"queries": n, "links": counted.links, "matched_entities": counted.matched_entities} | rates


def review(metrics: dict) -> str:
    """What the metrics of a run say, as text."""
    notes = []
    if (recall := metrics.get("recall", {}).get("recall")) is not None and recall < 0.98:
        notes.append(f"- recall of candidates is {recall:.4f}, under 0.98: work on blocking first")
    if (score := metrics.get("macro_f05")) is not None and score < 0.80:
        notes.append(f"- macro F0.5 is {score:.4f}, under 0.80: work on the features")
    if not 0.15 <= metrics.get("threshold", 0.5) <= 0.98:
        notes.append(f"- the threshold {metrics['threshold']:.4f} is extreme: check the calibration")
    top = "\n".join(f"- {name}: {value:.4f}" for name, value in metrics.get("importances", [])[:10])
    return "# Review\n\n" + ("\n".join(notes) or "- nothing to warn of") + f"\n\n## Key metrics\n\n{key_metrics(metrics)}\n\n## Features\n\n{top}\n"


def key_metrics(metrics: dict) -> str:
    """The metrics of a run by which it is judged, as a table; those that weren't measured are left out."""
    blocked, recall, predicted = metrics.get("blocking", {}), metrics.get("recall", {}), metrics.get("prediction", {})
    rows = {
        "candidates a query": blocked.get("average_candidates"), "recall of candidates": recall.get("recall"), "share of true pairs in training": metrics.get("positive_rate"),
        "macro F0.5 of validation": metrics.get("macro_f05"), "threshold": metrics.get("threshold"), "predicted links": predicted.get("links"),
        "links a query": predicted.get("links_per_query"), "queries without a link": predicted.get("singleton_rate"),
    }
    shown = [f"| {name} | {value:,.4f} |" if isinstance(value, float) else f"| {name} | {value:,} |" for name, value in rows.items() if value is not None]
    return "\n".join(["| metric | value |", "| --- | --- |", *shown])


def methodology(metrics: dict, team: str, files: list[Path]) -> str:
    """How the lists were made, with the settings and figures of the run and the SHA-256 of each file."""
    settings = "\n".join(f"- {name}: {value}" for name, value in sorted(metrics.get("config", {}).items()))
    sums = "\n".join(f"- {path.name}: {sha256(path.read_bytes()).hexdigest()}" for path in sorted(files))
    steps = "Records are normalised and signed; targets that share rare signatures are ranked by rarity and likeness; pairs get features; boosted trees score them; the threshold is the best one of validation."
    return f"# Method of {team}\n\n{steps}\n\n## Settings\n\n{settings}\n\n## Figures\n\n{key_metrics(metrics)}\n\n## Files\n\n{sums}\n"


def team_name(raw: str) -> str:
    """A name that can stand in that of a file: runs of other characters than letters, digits, dots and dashes become one underscore."""
    return re.sub(r"[^A-Za-z0-9.-]+", "_", raw).strip("._-") or "team"


def deliver(spark: SparkSession, folder: Path, out: Path, metrics: dict, team: str) -> str:
    """Validate both lists against the test records, then pack them with the method and the review; returns the archive's SHA-256.

    A broken rule that is an error is a ValueError that names it.
    """
    required, targets = tsv.read_records(spark, str(folder / "test_source1.tsv")), _targets(spark, folder, "test")
    known, found = targets.select("entity_id"), []
    candidates = lists.read_lists(spark, str(out / "candidate_pairs.tsv"), "candidate_entity_ids")
    superset = candidates.withColumnRenamed("candidate_entity_ids", "ids")
    for name, column, within in (("matching_results.tsv", "matched_entity_ids", superset), ("candidate_pairs.tsv", "candidate_entity_ids", None)):
        form = lists.validate_file(spark, str(out / name), column)
        found += [(name, r.rule) for r in form.unionByName(lists.validate_lists(lists.read_lists(spark, str(out / name), column), column, required, known, within)).collect() if r.severity == "error"]
    if found:
        raise ValueError("broken lists: " + ", ".join(f"{name} {rule}" for name, rule in found))
    files = [out / "matching_results.tsv", out / "candidate_pairs.tsv"]
    (out / "METHOD.md").write_text(methodology(metrics, team, files))
    return package([*files, out / "METHOD.md", out / "REVIEW.md"], out / f"{team_name(team)}.zip")


def package(paths: list[Path], archive: Path) -> str:
    """Zip files under their names, in order; returns the archive's SHA-256."""
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED, compresslevel=6) as out:
        for path in sorted(paths):
            out.write(path, path.name)
    return sha256(archive.read_bytes()).hexdigest()


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Link business records")
    parser.add_argument("--resource-root", type=Path, required=True)
    parser.add_argument("--work-dir", type=Path, required=True)
    parser.add_argument("--output-dir", type=Path, required=True)
    parser.add_argument("--stage", choices=("all", "train", "infer"), default="all")
    parser.add_argument("--team", help="pack the checked lists under this name")
    parser.add_argument("--trees", type=int, default=LinkConfig.trees)
    parser.add_argument("--train-percent", type=int, default=LinkConfig.train_percent)
    parser.add_argument("--validation-percent", type=int, default=LinkConfig.validation_percent)
    parser.add_argument("--blank-country", action="store_true", help="let every query seek targets without a country")
    parser.add_argument("--max-candidates-per-source", type=int, default=LinkConfig.max_candidates_per_source)
    given = parser.parse_args(args)
    config = replace(LinkConfig(), trees=given.trees, train_percent=given.train_percent, validation_percent=given.validation_percent, max_candidates_per_source=given.max_candidates_per_source, blank_country=given.blank_country)
    spark = SparkSession.builder.getOrCreate()
    model_path, metrics_path = str(given.work_dir / "matcher"), str(given.output_dir / "run_metrics.json")
    if given.stage in ("all", "train"):
        tsv.write_metrics(metrics_path, train(spark, given.resource_root / "dataset/train", model_path, config))
    if given.stage in ("all", "infer"):
        metrics = infer(spark, given.resource_root / "dataset/test", given.output_dir, model_path, tsv.read_metrics(metrics_path), config)
        tsv.write_metrics(metrics_path, metrics)
        (given.output_dir / "REVIEW.md").write_text(review(metrics))
        if given.team:
            print(deliver(spark, given.resource_root / "dataset/test", given.output_dir, metrics, given.team))


if __name__ == "__main__":
    main()
