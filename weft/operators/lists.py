"""Id lists: one row for each reference record, its matches or candidates joined by commas; and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _joined(order: list[str], id_column: str) -> Column:
    sorted_items = F.array_sort(F.collect_list(F.struct(*order, F.col(id_column).alias("item"))))
    return F.array_join(F.transform(sorted_items, lambda s: s["item"]), ",")


def _for_all(queries: DataFrame, lists: DataFrame, column: str) -> DataFrame:
    everyone = queries.select(F.col("entity_id").alias("source1_entity_id")).distinct()
    return everyone.join(lists.hint("merge"), "source1_entity_id", "left").select("source1_entity_id", F.coalesce(column, F.lit("")).alias(column))


def match_lists(queries: DataFrame, scored: DataFrame, threshold: float) -> DataFrame:
    """source1_entity_id and matched_entity_ids: the targets from the threshold on, by source and id; '' if there is none."""
    kept = scored.where(F.col("probability") >= threshold)
    lists = kept.groupBy(F.col("query_id").alias("source1_entity_id")).agg(_joined(["target_source"], "target_id").alias("matched_entity_ids"))
    return _for_all(queries, lists, "matched_entity_ids")


def candidate_lists(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """source1_entity_id and candidate_entity_ids by source and rank; '' if there is none."""
    lists = candidates.groupBy(F.col("query_id").alias("source1_entity_id")).agg(_joined(["target_source", "candidate_rank"], "target_id").alias("candidate_entity_ids"))
    return _for_all(queries, lists, "candidate_entity_ids")


def write_tsv(lists: DataFrame, path: str, single_file: bool = False) -> None:
    """Write with a header, tabs and no quotes, by id, in parallel. single_file: then join the parts to one plain file, for tools that want one.

    The parts are sorted by range and written by all tasks; they are joined as bytes through the path's file system, local or not.
    """
    folder = f"{path}.parts" if single_file else path
    lists.orderBy("source1_entity_id").write.mode("overwrite").csv(folder, sep="\t", header=not single_file, quote="", emptyValue="", nullValue="")
    if not single_file:
        return
    spark = lists.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    parts = sorted(str(f.getPath()) for f in system.listStatus(source) if f.getPath().getName().startswith("part-"))
    out = system.create(target, True)
    try:
        out.write(bytearray(("\t".join(lists.columns) + "\n").encode()))
        for part in parts:
            read = system.open(jvm.org.apache.hadoop.fs.Path(part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(read, out, conf, False)
            finally:
                read.close()
    finally:
        out.close()
    system.delete(source, True)
    # the check sum of an older file of this name
    system.delete(jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.crc"), False)


def _finding(rule: str, severity: str, shown: DataFrame, weight: Column) -> DataFrame:
    """A row for a broken rule, none for one that holds. shown: e, the different offenders; n sums up the weight."""
    counted = shown.select(weight.cast("long").alias("n"), F.lit(None).cast("string").alias("e"))
    first = shown.orderBy("e").limit(5).select(F.lit(0).cast("long").alias("n"), "e")
    whole = counted.unionByName(first).agg(F.sum("n").alias("n"), F.concat_ws(" ", F.array_sort(F.collect_list("e"))).alias("examples"))
    return whole.where("n > 0").select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "n", "examples")


def validate_file(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Check the form of a list file: rule, severity, n and examples, as `validate_lists`; no rows for a sound one.

    The header must be source1_entity_id, a tab and the column (blanks around and case don't matter); one with commas is said to be
    of another format; every other line that isn't blank must hold a tab.
    """
    lines = spark.read.text(path).withColumn("n", F.monotonically_increasing_id())
    first = lines.agg(F.min_by("value", "n").alias("h"), F.min("n").alias("n"))
    head = F.lower(F.trim(F.coalesce("h", F.lit(""))))
    wanted = f"source1_entity_id\t{column}".lower()
    kind = F.when(F.regexp_replace(head, r"\s*\t\s*", "\t") == wanted, None).when(head.contains(",") & ~head.contains("\t"), "comma_header").otherwise("wrong_header")
    header = first.select(kind.alias("rule"), F.lit("error").alias("severity"), F.lit(1).cast("long").alias("n"), F.coalesce("h", F.lit("")).alias("examples")).where("rule is not null")
    body = lines.join(F.broadcast(first.select("n")), "n", "left_anti").where("trim(value) <> '' and instr(value, '\t') = 0")
    bare = _finding("no_tab", "error", body.groupBy(F.substring("value", 1, 80).alias("e")).agg(F.count("*").alias("c")), F.col("c"))
    return header.unionByName(bare)


def read_lists(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The lists of a file: source1_entity_id and the column."""
    return spark.read.csv(path, sep="\t", header=True, quote="", schema=f"source1_entity_id string, `{column}` string")


def validate_lists(lists: DataFrame, column: str, required: DataFrame, known: DataFrame | None = None, superset: DataFrame | None = None) -> DataFrame:
    """Check id lists: rule, severity, n and examples (up to five, joined by blanks) of every rule that is broken.

    lists: source1_entity_id and a list column; required: entity_id of all reference records; known: entity_id of all targets, or
    None to leave that out; superset: lists with source1_entity_id and ids, of which these must be part (a warning).
    """
    rows = lists.select(F.trim(F.coalesce("source1_entity_id", F.lit(""))).alias("s"), F.coalesce(column, F.lit("")).alias("l"))
    items = rows.where("l <> ''").select("s", F.posexplode(F.split("l", ",")).alias("pos", "x")).select("s", F.trim("x").alias("x"))
    need = required.select(F.trim("entity_id").alias("s")).distinct()

    def found(rule: str, severity: str, frame: DataFrame, example: str) -> DataFrame:
        return _finding(rule, severity, frame.select(F.col(example).alias("e")).distinct(), F.lit(1))

    checks = [
        found("duplicate_row", "error", rows.groupBy("s").count().where("count > 1"), "s"),
        found("duplicate_id", "error", items.groupBy("s", "x").count().where("count > 1"), "s"),
        found("self_match", "error", items.where("x like 'S1-%'"), "x"),
        found("wrong_prefix", "error", items.where("x not like 'S1-%' and x not like 'S2-%' and x not like 'S3-%'"), "s"),
        found("missing_row", "error", need.join(rows, "s", "left_anti"), "s"),
        found("unknown_row", "error", rows.select("s").join(need, "s", "left_anti"), "s"),
    ]
    if known is not None:
        checks.append(found("unknown_id", "error", items.select("x").join(known.select(F.trim("entity_id").alias("x")).distinct(), "x", "left_anti"), "x"))
    if superset is not None:
        wide = superset.select(F.trim("source1_entity_id").alias("s"), F.explode(F.split(F.coalesce("ids", F.lit("")), ",")).alias("x")).select("s", F.trim("x").alias("x"))
        checks.append(found("not_in_candidates", "warning", items.join(wide, ["s", "x"], "left_anti"), "s"))
    out = checks[0]
    for check in checks[1:]:
        out = out.unionByName(check)
    return out
