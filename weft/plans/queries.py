"""The queries of the core operators, over the tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.config import FEATURES, RECORD_COLUMNS, LinkConfig
from weft.functions.text import tokens
from weft.operators import blocking, evaluation, features, lists, model, parsing, records, signatures, skew, survival
from weft.session import cut, shared_folder, table
from weft.sources import tsv

Query = Callable[[SparkSession, str], DataFrame]
CONFIG = LinkConfig()
#: Fixed value: the threshold on the score without a model.
SURE = 0.8


def sources(spark: SparkSession, folder: str, labelled: bool = False) -> tuple[DataFrame, DataFrame]:
    """Normalised reference records (labelled: of those with a row of labels), and normalised targets of both sources with target_source."""
    references = table(spark, folder, "train_source1")
    queries = records.normalise_records(_labelled_queries(references, spark, folder) if labelled else references)
    targets = [records.normalise_records(table(spark, folder, f"train_source{n}")).withColumn("target_source", F.lit(n)) for n in (2, 3)]
    return queries, targets[0].unionByName(targets[1])


def _index(targets: DataFrame) -> DataFrame:
    return blocking.weighted_index(targets, CONFIG)


def _written(spark: SparkSession, folder: str, labelled: bool = False) -> tuple[DataFrame, DataFrame]:
    """What retrieval needs of the same, normalised and written once, without what is made of it at once; small tables in as many parts as there are cores.

    labelled: only reference records with a row of labels.
    """
    cores = spark.sparkContext.defaultParallelism
    written = [cut(r.select(*(["target_source"] if "target_source" in r.columns else []), "entity_id", "country", "name_norm", "address_norm")) for r in sources(spark, folder, labelled)]
    queries, targets = (w.repartition(cores) if 2 * w.rdd.getNumPartitions() <= cores else w for w in written)
    queries, targets = (w.withColumns({"name_tokens": tokens(F.col("name_norm")), "address_tokens": tokens(F.col("address_norm"))}) for w in (queries, targets))
    return queries, targets


def _truth(spark: SparkSession, folder: str) -> DataFrame:
    return features.truth_pairs(table(spark, folder, "train_matches"))


def _labelled_queries(queries: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    return queries.join(table(spark, folder, "train_matches").select(F.trim("source1_entity_id").alias("entity_id")).hint("merge"), "entity_id", "left_semi")


def _scored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labelled queries, their candidates with the score without a model and a label, and their truth counts."""
    queries, targets = _written(spark, folder, labelled=True)
    pairs = _truth(spark, folder)
    scored = features.labelled(model.baseline_score(blocking.retrieve(queries, targets, CONFIG)), pairs).withColumn("probability", F.round("probability", 9))
    return queries, cut(scored), evaluation.truth_counts(queries, pairs)


def scan_normalize(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = sources(spark, folder)
    both = queries.withColumn("target_source", F.lit(1)).unionByName(targets)
    joined = {c: F.concat_ws(" ", F.array_sort(c)) for c in ("name_tokens", "address_tokens", "digit_tokens")}
    return both.withColumns(joined).select("target_source", "entity_id", "country", "name_norm", "core_name", "address_norm", *joined)


def scan_tsv(spark: SparkSession, folder: str) -> DataFrame:
    """The reference records delivered as a TSV file and scanned; empty fields come back as null. Tabs and line breaks can't be delivered."""
    lines = table(spark, folder, "train_source1").select(*[F.regexp_replace(F.coalesce(c, F.lit("")), "[\t\r\n]", " ").alias(c) for c in RECORD_COLUMNS])
    path = f"{shared_folder(spark)}/weft-tsv-{uuid.uuid4().hex}"
    lines.write.csv(path, sep="\t", header=True, quote="", escape="", emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return tsv.read_records(spark, path)


def normalize_documents(spark: SparkSession, folder: str) -> DataFrame:
    from weft.functions.text import normalise

    return table(spark, folder, "documents").select("doc_id", normalise(F.col("title")).alias("title_norm"), normalise(F.col("text")).alias("text_norm"))


def truth_explode(spark: SparkSession, folder: str) -> DataFrame:
    return _truth(spark, folder)


def truth_counts(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.truth_counts(sources(spark, folder)[0], _truth(spark, folder))


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    return features.split_queries(sources(spark, folder)[0].select("entity_id"), CONFIG.train_percent, CONFIG.validation_percent)


def signature_exact(spark: SparkSession, folder: str) -> DataFrame:
    return signatures.exact_signatures(sources(spark, folder)[0])


def signature_shape(spark: SparkSession, folder: str) -> DataFrame:
    return signatures.shape_signatures(sources(spark, folder)[0])


def signature_pair(spark: SparkSession, folder: str) -> DataFrame:
    return signatures.pair_signatures(sources(spark, folder)[0])


def signature_df(spark: SparkSession, folder: str) -> DataFrame:
    return blocking.document_frequencies(signatures.single_signatures(sources(spark, folder)[1]))


def signature_weights(spark: SparkSession, folder: str) -> DataFrame:
    _, targets = _written(spark, folder)
    return _index(targets).where("kind not in ('pe', 'pt')")


def candidate_raw(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = _written(spark, folder)
    return blocking.retrieve_raw(queries, targets, CONFIG)


def candidate_shortlist(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = _written(spark, folder)
    return blocking.retrieve_shortlist(queries, targets, CONFIG)


def candidate_topk(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = _written(spark, folder)
    made = blocking.retrieve(queries, targets, CONFIG)
    return made.withColumns({c: F.round(c, 6) for c in ("name_jaro", "address_jaro", "block_score")})


def candidate_bounded_pairs(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = _written(spark, folder)
    return blocking.retrieve_raw(queries, targets, replace(CONFIG, max_pair_frequency=10))


def pair_features(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = _written(spark, folder)
    made = features.pair_features(blocking.retrieve(queries, targets, CONFIG, texts=True))
    return made.withColumns({c: F.round(c, 6) for c in FEATURES if not dict(made.dtypes)[c].startswith("int")})


def pair_labels(spark: SparkSession, folder: str) -> DataFrame:
    _, scored, _ = _scored(spark, folder)
    return scored.select("query_id", "target_source", "target_id", "label")


def blocking_stats(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = _written(spark, folder)
    return blocking.blocking_stats(queries, blocking.retrieve(queries, targets, CONFIG))


def blocking_recall(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = _written(spark, folder, labelled=True)
    return evaluation.blocking_recall(queries, blocking.retrieve(queries, targets, CONFIG), _truth(spark, folder))


def blocking_recall_stages(spark: SparkSession, folder: str) -> DataFrame:
    """Recall after each stage of retrieval, by default and with targets without a country sought by all queries."""
    queries, targets = _written(spark, folder, labelled=True)
    truth, rows = cut(_truth(spark, folder)), []
    for config in (CONFIG, replace(CONFIG, blank_country=True)):
        short = cut(blocking.contenders(raw := cut(blocking.retrieve_raw(queries, targets, config)), config))
        final = blocking.final_candidates(blocking.rescored(short.where("contends").drop("contends"), queries, targets), config)
        for stage, found in (("1 raw", raw), ("2 shortlist", short), ("3 final", final)):
            rows.append(evaluation.blocking_recall(queries, found, truth).select(F.lit(config.blank_country).alias("blank_country"), F.lit(stage).alias("stage"), "truth_links", "captured", F.round("recall", 6).alias("recall")))
    return reduce(DataFrame.unionByName, rows)


def macro_f05(spark: SparkSession, folder: str) -> DataFrame:
    _, scored, counts = _scored(spark, folder)
    return evaluation.macro_f05(counts, scored, SURE).withColumn("macro_f05", F.round("macro_f05", 6))


def threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    _, scored, counts = _scored(spark, folder)
    return evaluation.threshold_sweep(counts, scored).select(F.round("threshold", 6).alias("threshold"), F.round("macro_f05", 6).alias("macro_f05"))


def threshold_best(spark: SparkSession, folder: str) -> DataFrame:
    _, scored, counts = _scored(spark, folder)
    return evaluation.best_threshold(evaluation.threshold_sweep(counts, scored)).select(F.round("threshold", 6).alias("threshold"), F.round("macro_f05", 6).alias("macro_f05"))


def match_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Of all reference records, by the score without a model; needs no labels."""
    queries, targets = _written(spark, folder)
    scored = model.baseline_score(blocking.retrieve(queries, targets, CONFIG)).withColumn("probability", F.round("probability", 9))
    return lists.match_lists(queries, scored, SURE)


def candidate_lists(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = _written(spark, folder)
    return lists.candidate_lists(queries, blocking.retrieve(queries, targets, CONFIG))


def validate_id_lists(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "train_source2").select("entity_id").unionByName(table(spark, folder, "train_source3").select("entity_id"))
    return lists.validate_lists(table(spark, folder, "train_matches"), "matched_entity_ids", table(spark, folder, "train_source1"), known)


def blocking_survival(spark: SparkSession, folder: str) -> DataFrame:
    queries, targets = sources(spark, folder)
    return survival.blocking_survival(queries, targets, _truth(spark, folder))


def model_score(spark: SparkSession, folder: str) -> DataFrame:
    """Trained on all labelled queries with the settings of LinkConfig, applied to all; label is null where a query has none."""
    queries, targets = _written(spark, folder)
    rows = cut(features.pair_features(blocking.retrieve(queries, targets, CONFIG, texts=True)))
    asked = _labelled_queries(queries, spark, folder).select(F.col("entity_id").alias("query_id"))
    train = cut(features.labelled(rows.join(asked.hint("merge"), "query_id", "left_semi"), _truth(spark, folder)))
    others = rows.join(asked.hint("merge"), "query_id", "left_anti").withColumn("label", F.lit(None).cast(train.schema["label"].dataType))
    return model.score(model.fit_model(train, CONFIG), train.unionByName(others))


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "train_source2").selectExpr("trim(coalesce(country, '')) as country", "entity_id")
    return skew.per_key_counts(rows, "country", "entity_id")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _labels(spark, folder).where("heavy").select("country")


def p3_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _labels(spark, folder).select("country", "n_rows", "n_distinct", "heavy")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.failures(table(spark, folder, "raw_source_lines"), table(spark, folder, "train_source1"), table(spark, folder, "train_source2"))


def p7_loaded(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.read_deliveries(table(spark, folder, "raw_source_lines")).where("reason is null").select("line_id", "file_name", *parsing.RECORD)


def p7_repairs(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.read_deliveries(table(spark, folder, "raw_source_lines")).where("edits <> ''").select("line_id", "reason", "edits")


REFERENCE_QUERIES = (
    scan_normalize, scan_tsv, normalize_documents, truth_explode, truth_counts, hash_split, signature_exact, signature_shape, signature_pair, signature_df, signature_weights, candidate_raw,
    candidate_shortlist, candidate_topk, candidate_bounded_pairs, pair_features, pair_labels, blocking_stats, blocking_recall, blocking_recall_stages, macro_f05, threshold_sweep, threshold_best, match_lists,
    candidate_lists, validate_id_lists, blocking_survival, model_score,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p3_found, p3_labels, p7_found, p7_loaded, p7_repairs, *REFERENCE_QUERIES)}
