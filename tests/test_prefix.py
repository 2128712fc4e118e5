"""Running values of groups against a plain loop, with hot groups, nulls and ties."""

import random

import pytest
from pyspark.sql import functions as F

from sieveworks.operators import chunks, scoring
from sieveworks.operators.prefix import running


def rows(r, n, hot):
    return [(None if r.random() < 0.05 else "hot" if r.random() < hot else f"g{r.randint(0, 20)}", k, r.choice([None, 1, 5, -7]), r.getrandbits(62) - (1 << 61)) for k in range(n)]


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_running_equals_a_loop(spark, hot):
    data = rows(random.Random(int(hot * 10)), 1500, hot)
    df = spark.createDataFrame(data, "g string, pos long, v long, x long").repartition(5)
    got = {r.pos: (r.n, r.total, r.mixed) for r in running(df, ["g"], [F.desc("pos")], number="n", sums={"total": "v"}, xors={"mixed": "x"}).collect()}
    state, want = {}, {}
    for g, pos, v, x in sorted(data, key=lambda d: -d[1]):
        n, total, mixed = state.get(g, (0, 0, 0))
        state[g] = want[pos] = (n + 1, total + (v or 0), mixed ^ x)
    assert got == want


def test_a_single_group_is_spread(spark):
    df = spark.range(4000).select(F.col("id").alias("pos"), F.lit("only").alias("g"), (F.col("id") % 50).cast("int").alias("fit_score"))
    ranked = scoring.ranked(df, ["g"])
    want = {p: k for k, (_, p) in enumerate(sorted((-(p % 50), p) for p in range(4000)), 1)}
    assert {r.pos: r["rank"] for r in ranked.collect()} == want and dict(ranked.dtypes)["rank"] == "int"
    held = ranked.inputFiles()
    sizes = sorted(r["count"] for r in spark.read.parquet(*held).groupBy("__part").count().collect())
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_no_groups_empty_tables_and_new_columns_of_old_names(spark):
    df = spark.range(100).withColumn("id2", F.lit(7))
    assert [r.id2 for r in chunks.dense_ids(df, ["id"], "id2").orderBy("id").collect()] == list(range(100))
    assert running(df.limit(0), ["id2"], ["id"], number="n").columns == ["id", "id2", "n"]
    assert running(df.limit(0), [], ["id"], number="n", sums={"s": "id"}).count() == 0
