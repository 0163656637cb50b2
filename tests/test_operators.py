import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weft.config import FEATURES, LinkConfig
from weft.operators import blocking, evaluation, features, lists, model, records, signatures, survival
from weft.plans import queries

RECORD = "entity_id string, business_name string, business_address string, country string"


def frame(spark, *values):
    return spark.createDataFrame(list(values), RECORD)


def test_nulls_blank_and_repeated_records(spark):
    out = records.normalise_records(frame(spark, ("S1-1", None, None, None), ("S1-1", None, None, None), ("S1-2", "!!", " ", " US "))).orderBy("entity_id").collect()
    assert [(r.entity_id, r.name_norm, r.address_norm, r.country) for r in out] == [("S1-1", "", "", ""), ("S1-2", "", "", "US")]


def test_empty_tables_and_other_columns(spark):
    none = frame(spark).withColumn("kind", F.lit("x"))
    made = records.normalise_records(none)
    assert signatures.all_signatures(made).count() == 0
    targets = made.withColumn("target_source", F.lit(2))
    index = blocking.weighted_index(targets)
    assert blocking.raw_candidates(signatures.all_signatures(made), index).count() == 0
    assert blocking.blocking_stats(made, spark.createDataFrame([], "query_id string")).first().average_candidates == 0


def test_pairs_of_the_longest_words(spark):
    name = " ".join(f"word{'x' * i}" for i in range(20))
    made = records.normalise_records(frame(spark, ("S1-1", name, "", ""), ("S1-2", "single", "", ""), ("S1-3", "", "", "")))
    counts = dict(signatures.pair_signatures(made).groupBy("entity_id").count().collect())
    assert counts == {"S1-1": 66}


def test_ranking_keeps_ties_in_order(spark):
    raw = spark.createDataFrame([("q", 2, f"t{i}", 10, 1, 0) for i in range(50)], "query_id string, target_source int, target_id string, score_micro long, exact_hits int, shape_hits int")
    kept = blocking.shortlist(raw, LinkConfig(prefilter_candidates=3))
    assert [r[2] for r in rows(kept)] == ["t0", "t1", "t10"]


def test_truth_is_distinct(spark):
    truth = spark.createDataFrame([("S1-1", "S2-1, S2-1,, ,S3-2 "), (" S1-1", "S2-1"), ("S1-2", ""), ("S1-3", None)], "source1_entity_id string, matched_entity_ids string")
    assert rows(features.truth_pairs(truth)) == [("S1-1", "S2-1"), ("S1-1", "S3-2")]


def test_an_unknown_split_is_refused(spark):
    q = spark.createDataFrame([(f"S1-{i}",) for i in range(300)], "entity_id string")
    parts = {split: set(rows(features.split_queries(q, 8, 2, split).select("entity_id"))) for split in features.SPLITS}
    assert parts["train"] | parts["validation"] == parts["sample"] and not parts["train"] & parts["validation"]
    with pytest.raises(ValueError, match="unknown split"):
        features.split_queries(q, 8, 2, "test")


def test_entity_scores(spark):
    def one(truth, predicted, hits):
        return spark.range(1).select(evaluation.entity_score(F.lit(truth), F.lit(predicted), F.lit(hits)).alias("s")).first().s

    assert one(2, 3, 2) == pytest.approx(0.714, abs=1e-3)
    assert (one(0, 0, 0), one(0, 1, 0), one(2, 0, 0)) == (1.0, 0.0, 0.0)


def test_sweep_equals_single_thresholds(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 0), ("c", 2)], "query_id string, truth_count long")
    scored = spark.createDataFrame([("a", 0.9, 1), ("a", 0.4, 0), ("b", 0.5, 0), ("c", 0.95, 1), ("c", 0.2, 1)], "query_id string, probability double, label int")
    sweep = {r.threshold: r.macro_f05 for r in evaluation.threshold_sweep(counts, scored).collect()}
    assert len(sweep) > 180
    for t in list(sweep)[::20]:
        assert evaluation.macro_f05(counts, scored, t).first().macro_f05 == pytest.approx(sweep[t])


def test_quantiles_equal_those_of_all_values(spark):
    import random

    random.seed(2)
    values = [(random.choice([random.random(), 0.5, 1.0, 0.0, round(random.random(), 2)]),) for _ in range(2000)] + [(None,)]
    frame_ = spark.createDataFrame(values, "p double")
    points = [0.0, 0.013, 0.25, 0.5, 0.777, 0.999, 1.0]
    want = frame_.agg(F.percentile("p", F.array(*map(F.lit, points)))).first()[0]
    assert evaluation.quantiles(frame_, "p", points, bins=64) == pytest.approx(want)
    assert evaluation.quantiles(frame_.limit(0), "p", points) == []


def test_pairs_of_many_targets_are_refined(spark):
    same = [(f"S2-{i}", "Alpha", f"Tamilia Nadurai {'x' * (i // 3 + 3)}", "US") for i in range(9)]
    made = records.normalise_records(frame(spark, *same)).withColumn("target_source", F.lit(2))
    config = LinkConfig(max_pair_frequency=4)
    index = blocking.weighted_index(made, config).where("kind in ('pe', 'pt')")
    held = {r.signature for r in index.collect()}
    assert "ae:nadurai|ae:tamilia" not in held and "ae:nadurai|ae:tamilia|ae:xxx" in held
    raw = blocking.retrieve_raw(made.drop("target_source"), made, config)
    assert raw.where("query_id = 'S2-0' and target_id = 'S2-1'").count() == 1
    assert blocking.retrieve_raw(made.drop("target_source").limit(0), made, config).count() == 0


def test_names_of_tables(spark):
    from weft import session

    spark.range(1).createOrReplaceTempView("known_view")
    assert session.table_exists(spark, "known_view") and not session.table_exists(spark, "unknown_view")
    for bad in ("", "1a", "a b", "A", "a;drop table b", "../x"):
        with pytest.raises(ValueError, match="name of a table"):
            session.checked_name(bad)


def test_recall_without_truth_is_one(spark):
    q = spark.createDataFrame([("S1-1",)], "entity_id string")
    none = spark.createDataFrame([], "source1_entity_id string, target_id string")
    assert evaluation.blocking_recall(q, spark.createDataFrame([], "query_id string, target_id string"), none).first().recall == 1


def test_lists_have_a_row_for_each_record(spark, tmp_path):
    q = spark.createDataFrame([("S1-2",), ("S1-1",)], "entity_id string")
    scored = spark.createDataFrame([("S1-1", 3, "S3-1", 0.8), ("S1-1", 2, "S2-9", 0.9), ("S1-1", 2, "S2-1", 0.1)], "query_id string, target_source int, target_id string, probability double")
    made = lists.match_lists(q, scored, 0.8)
    assert rows(made) == [("S1-1", "S2-9,S3-1"), ("S1-2", "")]
    lists.write_tsv(made, str(tmp_path / "out.tsv"), single_file=True)
    assert (tmp_path / "out.tsv").read_text() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-9,S3-1\nS1-2\t\n"


def test_planted_defects_are_found(spark):
    bad = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-1", "S1-2"), ("S1-9", "X-1"), ("S1-3", "S2-7, S2-1")], "source1_entity_id string, matched_entity_ids string")
    need = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "entity_id string")
    known = spark.createDataFrame([("S2-1",)], "entity_id string")
    wide = spark.createDataFrame([("S1-1", "S2-1"), ("S1-3", "S2-7")], "source1_entity_id string, ids string")
    found = {r.rule: (r.severity, r.n, r.examples) for r in lists.validate_lists(bad, "matched_entity_ids", need, known, wide).collect()}
    assert found == {
        "duplicate_row": ("error", 1, "S1-1"), "duplicate_id": ("error", 1, "S1-1"), "self_match": ("error", 1, "S1-2"), "wrong_prefix": ("error", 1, "S1-9"),
        "missing_row": ("error", 1, "S1-2"), "unknown_row": ("error", 1, "S1-9"), "unknown_id": ("error", 3, "S1-2 S2-7 X-1"), "not_in_candidates": ("warning", 3, "S1-1 S1-3 S1-9"),
    }


def test_form_of_list_files(spark, tmp_path):
    def rules(text):
        path = tmp_path / "f.tsv"
        path.write_text(text)
        return {r.rule: r.n for r in lists.validate_file(spark, str(path), "matched_entity_ids").collect()}

    assert rules("Source1_entity_id\t matched_entity_ids \nS1-1\tS2-1\n\nS1-2\t\n") == {}
    assert rules("source1_entity_id,matched_entity_ids\nS1-1\tS2-1\nS1-2\n") == {"comma_header": 1, "no_tab": 1}
    assert rules("id\tmatched_entity_ids\nS1-1\nS1-2\n") == {"wrong_header": 1, "no_tab": 2}
    assert rules("") == {"wrong_header": 1}


def test_short_texts_have_no_ngram(spark):
    got = spark.createDataFrame([("abcd",), ("abcdef",)], "s string").select(survival.char_ngrams(F.col("s")).alias("g")).collect()
    assert [r.g for r in got] == [[], ["abcde", "bcdef"]]


def test_model_is_saved_and_scores(spark, tmp_path):
    import random

    random.seed(3)
    values = [tuple([float(x := random.random())] * len(FEATURES)) + (int(x > 0.5), f"q{i}", 2, f"t{i}") for i in range(200)]
    data = spark.createDataFrame(values, [*FEATURES, "label", "query_id", "target_source", "target_id"])
    fitted = model.fit_model(data, LinkConfig(trees=3, depth=3))
    model.save_model(fitted, str(tmp_path / "m"))
    scored = model.score(model.load_model(str(tmp_path / "m")), data)
    assert scored.where("(probability > 0.5) = (label = 1)").count() > 190
    assert len(model.importances(fitted)) == len(FEATURES)


def test_index_join_finds_the_same_without_a_cap(spark, small):
    assert queries.queries()["candidate_raw"](spark, small).count() >= queries.queries()["candidate_bounded_pairs"](spark, small).count() > 0


def test_model_scores_every_candidate_with_the_default_settings(spark, small, monkeypatch):
    fit, asked = model.fit_model, []

    def few_trees(rows, config):
        asked.append(config)
        return fit(rows, LinkConfig(trees=1, depth=2))

    monkeypatch.setattr(model, "fit_model", few_trees)
    scored = queries.model_score(spark, small).select("query_id", "target_source", "target_id").collect()
    assert asked == [LinkConfig()]
    assert sorted(map(tuple, scored)) == rows(queries.candidate_topk(spark, small).select("query_id", "target_source", "target_id"))


def test_pairs_that_likeness_cannot_lift_are_not_compared(spark):
    """F7, F8: the final pairs are those of the whole shortlist, also where ids have two records."""
    import random

    random.seed(5)
    schema = "query_id string, target_source int, target_id string, score_micro long, exact_hits int, shape_hits int"
    raw = spark.createDataFrame([(f"q{q}", 2, f"t{t}", random.choice([2, 9, 13, 14, 18, 25, 40]) * 1_000_000 + random.randrange(3), random.randrange(3), 0) for q in range(12) for t in range(q * 4)], schema)
    names = ["", "acme", "acme works", "northern acme", "zebra"]
    queries = spark.createDataFrame([(f"q{q}", "US", random.choice(names), random.choice(names)) for q in range(12)] + [("q9", "US", "acme", "")], "entity_id string, country string, name_norm string, address_norm string")
    targets = spark.createDataFrame([(2, f"t{t}", random.choice(names), random.choice(names)) for t in range(48)] + [(2, "t3", "acme", "acme"), (2, "t3", "zebra", "")], "target_source int, entity_id string, name_norm string, address_norm string")
    config = LinkConfig(prefilter_candidates=30, max_candidates_per_source=5)
    short = blocking.contenders(raw, config)
    assert rows(short.drop("contends")) == rows(blocking.shortlist(raw, config))
    left = short.where("contends").drop("contends")
    assert left.count() < short.count()
    whole, found = (blocking.final_candidates(blocking.rescored(s, queries, targets), config) for s in (short.drop("contends"), left))
    assert rows(found) == rows(whole)
