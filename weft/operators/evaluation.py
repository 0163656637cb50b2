"""Entity-level evaluation: links of the truth, recall of candidates, macro F0.5 and the best threshold.

Nothing that grows with the tables is broadcast: what a plan takes for small by its files can be far larger in the driver's memory.
"""

from __future__ import annotations

import math
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def truth_counts(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """query_id and truth_count, 0 for queries without a link."""
    links = pairs.groupBy(F.col("source1_entity_id").alias("query_id")).agg(F.count("target_id").alias("n")).hint("merge")
    return queries.select(F.col("entity_id").alias("query_id")).join(links, "query_id", "left").select("query_id", F.coalesce("n", F.lit(0)).cast("long").alias("truth_count"))


def blocking_recall(queries: DataFrame, candidates: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: truth_links of the queries, captured ones and recall (1 without any link)."""
    asked = pairs.join(queries.select(F.col("entity_id").alias("source1_entity_id")).hint("merge"), "source1_entity_id", "left_semi")
    pair = candidates.select(F.col("query_id").alias("source1_entity_id"), "target_id", F.lit(1).alias("hit")).distinct().hint("merge")
    counted = asked.join(pair, ["source1_entity_id", "target_id"], "left").agg(F.count("*").alias("truth_links"), F.count("hit").alias("captured"))
    return counted.withColumn("recall", F.when(F.col("truth_links") == 0, 1.0).otherwise(F.col("captured") / F.col("truth_links")))


def entity_score(truth: Column, predicted: Column, hits: Column) -> Column:
    """1 for a rightly empty entity, else F0.5 of its links, 0 without a hit."""
    precision, recall = hits / predicted, hits / truth
    return F.when((truth == 0) & (predicted == 0), 1.0).when((truth > 0) & (predicted > 0) & (hits > 0), 1.25 * precision * recall / (0.25 * precision + recall)).otherwise(0.0)


def macro_f05(counts: DataFrame, scored: DataFrame, threshold: float) -> DataFrame:
    """One row: entities and macro_f05 at a threshold. counts: query_id, truth_count; scored: query_id, probability, label."""
    hit = F.col("probability") >= threshold
    per = scored.groupBy("query_id").agg(F.count(F.when(hit, 1)).alias("predicted"), F.count(F.when(hit & (F.col("label") == 1), 1)).alias("hits"))
    joined = counts.join(per.hint("merge"), "query_id", "left").na.fill(0, ["predicted", "hits"])
    return joined.select(entity_score(F.col("truth_count"), F.col("predicted"), F.col("hits")).alias("s")).agg(F.count("*").alias("entities"), F.avg("s").alias("macro_f05"))


def quantiles(values: DataFrame, column: str, points: list[float], bins: int = 1 << 16) -> list[float]:
    """Exact interpolated quantiles of a column of numbers from 0 to 1; none of an empty one. Nulls don't count.

    Values are counted by bin, at most `bins` + 1 rows reach the driver; then only the different values of the bins that hold a wanted
    rank, at most two for each point, are counted and put in order, each bin by itself.
    """
    p = values.select(F.col(column).cast("double").alias("p")).where("p is not null").withColumn("bin", F.floor(F.col("p") * bins).cast("int"))
    sizes = sorted((r["bin"], r["n"]) for r in p.groupBy("bin").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in sizes)
    if not total:
        return []
    starts, seen = {}, 0
    for b, n in sizes:
        starts[b] = seen
        seen += n
    places = [point * (total - 1) for point in points]
    ranks = sorted({math.floor(x) for x in places} | {math.ceil(x) for x in places})
    ends = [starts[b] + n for b, n in sizes]
    held = sorted({sizes[bisect_right(ends, r)][0] for r in ranks})
    counted = p.where(F.col("bin").isin(held)).groupBy("bin", "p").agg(F.count("*").alias("n"))
    start = F.element_at(F.create_map(*[F.lit(x) for b in held for x in (b, starts[b])]), F.col("bin"))
    upto = F.sum("n").over(Window.partitionBy("bin").orderBy("p")) + start
    # only values on which a wanted rank falls
    wanted = F.exists(F.array(*[F.lit(r).cast("long") for r in ranks]), lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))
    rows = sorted((r["upto"], r["p"]) for r in counted.withColumn("upto", upto).where(wanted).collect())
    tops = [u for u, _ in rows]

    def at(rank: int) -> float:
        return rows[bisect_right(tops, rank)][1]

    return [at(math.floor(x)) + (x - math.floor(x)) * (at(math.ceil(x)) - at(math.floor(x))) for x in places]


def thresholds(scored: DataFrame) -> list[float]:
    """180 even ones from 0.10 to 0.995 and 100 quantiles from 0.50 to 0.999 of the probabilities, to nine places; the different ones in order."""
    even = [0.10 + i * ((0.995 - 0.10) / 179) for i in range(180)]
    return sorted({round(t, 9) for t in even + quantiles(scored, "probability", [0.5 + i * (0.999 - 0.5) / 99 for i in range(100)])})


def threshold_sweep(counts: DataFrame, scored: DataFrame) -> DataFrame:
    """threshold and macro_f05 of every threshold. Each pair is counted at its own number of thresholds, then summed up from the top.

    A query's score changes only where one of its pairs falls in, so the sweep handles a row for each pair and threshold level, not
    each pair at every threshold. The thresholds, at most 280, are found first.
    """
    levels = F.array(*[F.lit(t) for t in thresholds(scored)])
    # the index of the highest threshold that a pair passes
    passed = F.size(F.filter(levels, lambda t: t <= F.col("probability")))
    pairs = scored.select("query_id", "label", passed.alias("k")).where("k > 0")
    by_level = pairs.groupBy("query_id", "k").agg(F.count("*").alias("p"), F.sum("label").alias("h"))
    per_query = by_level.groupBy("query_id").agg(F.collect_list(F.struct("k", "p", "h")).alias("steps"))
    joined = counts.join(per_query.hint("merge"), "query_id", "left")

    def upto(name: str, k: Column) -> Column:
        return F.aggregate(F.coalesce("steps", F.array()), F.lit(0).cast("long"), lambda total, s: total + F.when(s["k"] >= k, s[name]).otherwise(F.lit(0).cast("long")))

    scores = F.transform(levels, lambda t, i: F.struct(t.alias("threshold"), entity_score(F.col("truth_count"), upto("p", i + 1), upto("h", i + 1)).alias("s")))
    return joined.select(F.explode(scores).alias("x")).groupBy("x.threshold").agg(F.avg("x.s").alias("macro_f05"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row with the highest macro_f05 (to nine places), of equal ones that with the lowest threshold."""
    return sweep.orderBy(F.desc(F.round("macro_f05", 9)), "threshold").limit(1)
