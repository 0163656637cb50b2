"""Per-key results where a few keys hold most of the rows: fragment and replicate by estimated load."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.session import partitions


@dataclass(frozen=True)
class LoadPlan:
    """Where rows go. shards: of each key that is split, its tasks, one for each shard. buckets: the task of each bucket of the other keys."""

    tasks: int
    shards: dict[str, list[int]]
    buckets: list[int]
    loads: list[float]


def plan_loads(heavy: dict[str, int], buckets: list[int], tasks: int) -> LoadPlan:
    """Pack key shards and buckets of light keys into tasks, the largest piece first into the task with the least load.

    A key with more than a task's fair share is cut into so many equal shards that each is at most half a share, so that packing
    has room to even out. Empty input gives an empty plan.
    """
    total = sum(heavy.values()) + sum(buckets)
    share = max(1.0, total / tasks)
    pieces: list[tuple[float, tuple[str, str | int, int]]] = []
    shards: dict[str, list[int]] = {}
    for key, rows in heavy.items():
        count = min(tasks, max(1, round(2 * rows / share)))
        shards[key] = [0] * count
        pieces += [(rows / count, ("key", key, k)) for k in range(count)]
    pieces += [(rows, ("bucket", k, 0)) for k, rows in enumerate(buckets)]
    room = [(0.0, task) for task in range(tasks)]
    heapq.heapify(room)
    where = [0] * len(buckets)
    loads = [0.0] * tasks
    for load, (kind, name, k) in sorted(pieces, key=lambda piece: (-piece[0], str(piece[1]))):
        used, task = heapq.heappop(room)
        heapq.heappush(room, (used + load, task))
        loads[task] += load
        if kind == "key":
            shards[str(name)][k] = task
        else:
            where[int(name)] = task
    return LoadPlan(tasks, shards, where, loads)


def measure_loads(df: DataFrame, key: str, tasks: int, buckets_per_task: int = 4) -> LoadPlan:
    """Count rows by key (combined on the map side) and plan. At most `tasks` heavy keys and `buckets_per_task * tasks` buckets reach the driver."""
    count = tasks * buckets_per_task
    share = df.count() / tasks
    with_share = df.groupBy(key).agg(F.count("*").alias("n")).withColumn("heavy", F.col("n") > share)
    bucket = F.when(F.col("heavy"), F.lit(-1).cast("long")).otherwise(F.pmod(F.xxhash64(key), F.lit(count)))
    rows = with_share.groupBy(F.when(F.col("heavy"), F.col(key)).alias("k"), bucket.alias("b")).agg(F.sum("n").alias("n")).collect()
    by_bucket = [0] * count
    for row in rows:
        if row.b >= 0:
            by_bucket[row.b] = row.n
    return plan_loads({row.k: row.n for row in rows if row.b < 0}, by_bucket, tasks)


def _array(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def assign_task(plan: LoadPlan, key: str, shard_on: str) -> Column:
    """The task of a row: of a split key by the hash of `shard_on`, of the others by their bucket."""
    task = F.element_at(_array(plan.buckets), (F.pmod(F.xxhash64(key), F.lit(len(plan.buckets))) + 1).cast("int"))
    for name, tasks in plan.shards.items():
        shard = (F.pmod(F.xxhash64(shard_on), F.lit(len(tasks))) + 1).cast("int")
        task = F.when(F.col(key) == F.lit(name), F.element_at(_array(tasks), shard)).otherwise(task)
    return task


def replicas(plan: LoadPlan, key: str) -> Column:
    """The tasks to which a row of the matching side must be copied: one for a light key, those of its shards for a split one."""
    tasks = F.array(F.element_at(_array(plan.buckets), (F.pmod(F.xxhash64(key), F.lit(len(plan.buckets))) + 1).cast("int")))
    for name, own in plan.shards.items():
        tasks = F.when(F.col(key) == F.lit(name), _array(sorted(set(own)))).otherwise(tasks)
    return tasks


def per_key_counts(df: DataFrame, key: str, distinct_of: str, heavy_share: float = 0.05, tasks: int | None = None) -> DataFrame:
    """Rows, distinct values and heaviness of every key, with no task doing more than about its share.

    Parameters: key, a string column, whose null counts as ''; distinct_of, the column whose different non-null values are counted;
    heavy_share, a key that holds more than this part of all rows is heavy.
    Result: key, n_rows, n_distinct, share, heavy; one row for each key. The matching side here is the table of key totals: it is
    copied to exactly the tasks that hold fragments of its key. Repeated rows count each time in n_rows. An empty table gives no
    row; other columns, of whatever name, are not read; texts of any length are only hashed and compared.
    """
    tasks = tasks or partitions(df.sparkSession)
    rows = df.select(F.coalesce(F.col(key), F.lit("")).alias("k"), F.col(distinct_of).alias("v"))
    plan = measure_loads(rows, "k", tasks)
    fragments = (
        rows.withColumn("task", assign_task(plan, "k", "v"))
        .repartitionById(tasks, "task")
        .groupBy("task", "k", "v").agg(F.count("*").alias("n"))
        .groupBy("task", "k").agg(F.sum("n").alias("n_rows"), F.count("v").alias("n_distinct"))
    )
    whole = sum(plan.loads)
    totals = fragments.groupBy("k").agg(F.sum("n_rows").alias("key_rows")).select("k", (F.col("key_rows") / F.lit(float(max(1, whole)))).alias("share"), F.explode(replicas(plan, "k")).alias("task"))
    return (
        fragments.join(totals, ["k", "task"])
        .groupBy("k").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_distinct").alias("n_distinct"), F.max("share").alias("share"))
        .select(F.col("k").alias(key), "n_rows", "n_distinct", "share", (F.col("share") > heavy_share).alias("heavy"))
    )
