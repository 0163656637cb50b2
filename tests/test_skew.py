from collections import Counter, defaultdict

from weft.operators import skew


def brute(data):
    n, seen = Counter(), defaultdict(set)
    for k, v in data:
        n[k or ""] += 1
        seen[k or ""] |= {v} - {None}
    return sorted((k, n[k], len(seen[k]), n[k] / len(data) > 0.05) for k in n)


def test_counts_of_skewed_keys(spark):
    data = [("hot", f"v{i % 700}") for i in range(2000)] + [(f"k{i % 60}", f"w{i}") for i in range(900)] + [(None, None), ("", "a"), ("hot", None)] * 3
    df = spark.createDataFrame(data, "k string, v string").selectExpr("*", "1 as task", "2 as n_rows", "'x' as share")
    got = skew.per_key_counts(df, "k", "v", tasks=7).select("k", "n_rows", "n_distinct", "heavy").collect()
    assert sorted(map(tuple, got)) == brute(data)


def test_one_key_and_no_row(spark):
    df = spark.createDataFrame([("a", "x")] * 50, "k string, v string")
    assert [tuple(r)[:3] for r in skew.per_key_counts(df, "k", "v").collect()] == [("a", 50, 1)]
    assert skew.per_key_counts(df.limit(0), "k", "v").count() == 0


def test_plan_evens_out():
    plan = skew.plan_loads({"a": 10_000, "b": 3000}, [50] * 40, 10)
    assert max(plan.loads) <= 1.2 * sum(plan.loads) / 10
    assert len(plan.shards["a"]) > len(plan.shards["b"]) >= 1


def test_hot_rows_are_spread(spark):
    df = spark.createDataFrame([("hot", f"v{i}") for i in range(4000)] + [(f"k{i}", "x") for i in range(100)], "k string, v string")
    plan = skew.measure_loads(df, "k", 8)
    sizes = df.withColumn("task", skew.assign_task(plan, "k", "v")).repartitionById(8, "task").rdd.glom().map(len).collect()
    assert max(sizes) < 2 * 4100 / 8


def test_all_rows_are_counted_in_fragments(spark):
    df = spark.createDataFrame([("a", "x")] * 50 + [("b", "y")], "k string, v string").repartition(2)
    plan = skew.per_key_counts(df, "k", "v", tasks=3).select("k", "heavy")._jdf.queryExecution().analyzed().toString()
    # each read of the rows goes through the cut into tasks
    assert plan.count("LogicalRDD") == plan.count("RepartitionByExpression") > 0
