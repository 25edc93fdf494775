"""How long written tables live, and tables that keep their placement."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyrate import storage
from tallyrate.operators.fill import forward_fill


def test_a_scope_leaves_only_what_is_kept(spark):
    with storage.scope(spark) as tables:
        first = storage.written_table(spark.range(5), "first")
        second = storage.written_table(first.where("id > 1"), "second")
        kept = tables.keep(second.where("id > 2"), "result")
        paths = tables.tables()
        assert len(paths) == 2 and all(storage.exists(spark, path) for path in paths)
    assert not any(storage.exists(spark, path) for path in paths)
    assert sorted(r.id for r in kept.collect()) == [3, 4]


def test_a_table_goes_with_its_last_reader(spark):
    with storage.scope(spark) as tables:
        base = storage.written_table(spark.range(9), "base", readers=2)
        path = tables.tables()[0]
        one = storage.written_table(base.union(base), "one")
        assert storage.exists(spark, path)
        storage.written_table(one, "other")
        assert storage.exists(spark, path)
        two = storage.written_table(base.join(one, "id"), "two", readers=1)
        assert not storage.exists(spark, path)
        assert tables.keep(two, "result").count() == 18
        assert len(tables.tables()) == 2


def test_scopes_may_be_nested(spark):
    with storage.scope(spark) as outer:
        shared = storage.written_table(spark.range(4), "shared", readers=2)
        shared_path = outer.tables()[0]
        with storage.scope(spark) as inner:
            storage.written_table(shared, "copy")
            kept = inner.keep(shared, "kept")
            assert not storage.exists(spark, shared_path)
        assert len(outer.tables()) == 1 and kept.count() == 4
        kept_path = outer.tables()[0]
    assert not storage.exists(spark, kept_path)


def test_a_failure_drops_the_tables_too(spark):
    with pytest.raises(ZeroDivisionError):
        with storage.scope(spark) as tables:
            storage.written_table(spark.range(4), "t")
            paths = tables.tables()
            raise ZeroDivisionError
    assert paths and not storage.exists(spark, paths[0])
    assert storage.written_table(spark.range(2), "outside").count() == 2


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]


def test_bucket_keys_fill_every_bucket(spark):
    for buckets in (1, 4, 31):
        keys = storage.bucket_keys(spark, buckets)
        found = spark.createDataFrame([(k,) for k in keys], "k int").select(F.pmod(F.hash("k"), F.lit(buckets))).collect()
        assert [r[0] for r in found] == list(range(buckets))


def test_a_placed_table_is_read_without_an_exchange(spark):
    rows = spark.range(1000).select((F.col("id") % 50).cast("int").alias("k"), "id").repartition(4, "k")
    placed = storage.placed_table(rows, "placed", "k", ["id"], 4)
    window = Window.partitionBy("k", F.col("id") % 2).orderBy("id")
    for df in (placed.groupBy("k").count(), placed.withColumn("n", F.row_number().over(window))):
        assert exchanges(df) == []
    other = storage.placed_table(rows.where("id < 300").withColumnRenamed("id", "other"), "placed", "k", ["other"], 4)
    joined = placed.hint("merge").join(other, "k")
    assert exchanges(joined) == [] and joined.count() == 6000


def test_a_scope_drops_placed_tables(spark):
    with storage.scope(spark) as tables:
        placed = storage.placed_table(spark.range(10).repartition(2, "id"), "placed", "id", [], 2)
        assert placed.count() == 10
        path = tables.tables()[0]
        assert any(t.name.startswith("tallyrate_") for t in spark.catalog.listTables())
        before = len(spark.catalog.listTables())
    assert not storage.exists(spark, path) and len(spark.catalog.listTables()) == before - 1


def test_the_log_is_exchanged_once(spark):
    log = spark.range(3000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"),
                                   F.when(F.col("id") % 7 == 0, F.col("id").cast("string")).alias("v"))
    filled = forward_fill(log, "v", "g", "o")
    plan = filled._jdf.queryExecution().executedPlan().toString()
    # What is left to exchange are two rows of each partition.
    assert "Bucketed: true" in plan
    assert all("_group" in line or "_part" in line for line in exchanges(filled)) and len(exchanges(filled)) == 1


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_fill_goes_on_over_partitions(spark, settings, partitions):
    """One large group over all partitions, tiny ones inside, values far apart, ties and nulls."""
    settings(spark__sql__shuffle__partitions=partitions)
    rows = [("a", i, str(i) if i in (3, 400) else None) for i in range(900)]
    rows += [("b", i, None) for i in range(5)] + [(None, 1, "x"), (None, 2, None), ("c", None, "y"), ("c", 1, None), ("c", 1, "z")]
    rows += [(f"d{i}", 1, None) for i in range(50)]
    found = forward_fill(spark.createDataFrame(rows, "g string, o int, v string"), "v", "g", "o").collect()
    held = {}
    want = []
    for g, o, v in sorted(rows, key=lambda r: (r[0] or "", -1 if r[1] is None else r[1], r[2] is None, r[2] or "")):
        held[g] = v if v is not None else held.get(g, "0")
        want.append((g, o, held[g]))
    key = lambda r: (r[0] or "", -1 if r[1] is None else r[1], r[2])
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_single_partitions_of_a_union_stay_tasks(spark):
    before = spark.conf.get("spark.sql.unionOutputPartitioning", None)
    with storage.separate_unions(spark):
        parts = [spark.range(3).coalesce(1) for _ in range(4)]
        both = parts[0].union(parts[1]).union(parts[2]).union(parts[3]).select(F.spark_partition_id().alias("task"))
        assert both.distinct().count() == 4
    assert spark.conf.get("spark.sql.unionOutputPartitioning", None) == before


def test_table_with_a_folder_for_each_value(spark):
    table = storage.written_table(spark.range(10).selectExpr("id", "id % 3 as kind"), "kinds", by="kind")
    some = table.where("kind = 2")
    assert sorted(tuple(r) for r in some.collect()) == [(2, 2), (5, 2), (8, 2)]
    assert len({f.rsplit("/", 2)[1] for f in table.inputFiles()}) == 3
