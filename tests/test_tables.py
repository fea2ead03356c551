"""Tables of the session's catalogue: what an upsert reads, replaces and counts, and how rows lie in them."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sportmart.operators.upsert import merged, merged_by_bucket
from sportmart.session import new_database, settings
from sportmart.sources.frames import empty_frame
from sportmart.sources.tables import (
    create_table, layout_of, observed_nulls, table_schema, touched_rows, upsert_table, write_sorted,
)
from tests.test_operators import frame, rows


@pytest.fixture
def table(spark):
    return f"{new_database(spark, 'test')}.t"


def files_of(spark, table):
    return {f.removeprefix("file:") for f in spark.table(table).inputFiles()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitioned_upsert_replaces_touched_partitions_only(spark, table):
    columns, keys = "id BIGINT, season INT, v INT", ["id", "season"]
    first = frame(spark, [(1, 1, 10), (2, 1, 20), (1, 2, 30), (5, None, 50)], columns)
    assert upsert_table(first, table, keys, ["v"], "season") == (4, 0)
    assert layout_of(spark, table) == ("season", 0) and table_schema(spark, table).names == ["id", "v", "season"]
    before = files_of(spark, table)
    second = frame(spark, [(1, 2, 31), (9, 3, 90), (5, None, 51)], columns)
    # Files of a season that the source has not are not even opened.
    (held,) = [f for f in before if "season=1" in f]
    whole = open(held, "rb").read()
    open(held, "wb").write(b"no parquet")
    assert upsert_table(second, table, keys, ["v"], "season") == (2, 1)
    open(held, "wb").write(whole)
    assert rows(spark.table(table).select("id", "season", "v")) == sorted(
        [(1, 1, 10), (2, 1, 20), (1, 2, 31), (9, 3, 90), (5, None, 50), (5, None, 51)], key=repr
    )
    assert held in files_of(spark, table) and len(files_of(spark, table) & before) == 1


def test_touched_partitions_are_found_while_the_job_runs(spark, table):
    create_table(spark, table, empty_frame(spark, "id INT, season INT, v INT").schema, "season")
    source = spark.createDataFrame([(1, 2, 3)], "id INT, season INT, v INT")
    plan = plan_of(touched_rows(spark.table(table), source, "season", with_null=False))
    assert "dynamicpruning" in plan[plan.index("PartitionFilters") :].split("]")[0]


@pytest.mark.parametrize("form", [{}, {"partition_by": "season"}, {"buckets": 4}])
def test_upsert_forms_agree_with_brute_force(spark, form):
    r = random.Random(7)
    ddl, keys = "id INT, season INT, v INT, w INT", ["id", "season"]
    draw = lambda n: [
        (r.choice([None, *range(12)]), r.choice([None, 1, 2, 3]), r.randint(0, 99), r.randint(0, 99)) for _ in range(n)
    ]
    table, stored = f"{new_database(spark, 'forms')}.t", []
    for n in (0, 30, 0, 25, 40):
        source = draw(n)
        whole = {}
        for row in source:
            if None not in row[:2]:
                whole[row[:2]] = max(whole.get(row[:2], row), row, key=lambda x: x[2:])
        updated = {row[:2] for row in stored} & whole.keys()
        stored = [(*row[:2], whole[row[:2]][2], row[3]) if row[:2] in updated else row for row in stored]
        new = [row for key, row in whole.items() if key not in updated] + [row for row in source if None in row[:2]]
        stored += new
        done = upsert_table(frame(spark, source, ddl), table, keys, ["v"], on_duplicate="any", **form)
        assert done == (len(new), len(updated))
        assert rows(spark.table(table).select("id", "season", "v", "w")) == sorted(stored, key=repr)


def test_bucketed_target_is_not_shuffled(spark, table):
    ddl, keys = "id INT, season INT, v INT", ["id", "season"]
    create_table(spark, table, empty_frame(spark, ddl).schema, buckets=4, keys=keys)
    assert layout_of(spark, table) == (None, 4)
    upsert_table(frame(spark, [(i, i % 3, i) for i in range(100)], ddl), table, keys, ["v"])
    source = spark.range(50, 150).selectExpr("CAST(id AS INT) AS id", "CAST(id % 3 AS INT) AS season", "0 AS v")
    with settings(spark, {"spark.sql.shuffle.partitions": 4, "spark.sql.autoBroadcastJoinThreshold": -1}):
        for mode in ("error", "any"):
            plan = plan_of(merged_by_bucket(spark.table(table), source, keys, ["v"], mode))
            assert plan.count("Exchange ") == 1 and "SelectedBucketsCount: 4 out of 4" in plan
            assert plan.index("Bucketed: true") < plan.index("Exchange ") < plan.index("partial_")
        # The plain form shuffles both sides.
        assert plan_of(merged(spark.table(table), source, keys, ["v"])).count("Exchange ") == 1
    upsert_table(source, table, keys, ["v"])
    assert spark.table(table).count() == 150 and spark.table(table).where("v > 0").count() == 49


def test_an_empty_load_leaves_a_table(spark):
    database, columns = new_database(spark, "empty"), "id BIGINT, season STRING, v INT"
    for by in (None, "season"):
        name, none = f"{database}.t{by}", empty_frame(spark, columns)
        assert upsert_table(none, name, ["id", "season"], ["v"], by) == (0, 0)
        assert upsert_table(none, name, ["id", "season"], ["v"], by) == (0, 0)
        assert rows(spark.table(name)) == []
        full = frame(spark, [(1, "2001-02", 1), (2, None, 2)], columns)
        assert upsert_table(full, name, ["id", "season"], ["v"], by) == (2, 0)
        assert upsert_table(none, name, ["id", "season"], ["v"], by) == (0, 0)
        assert rows(spark.table(name).select("id", "season", "v")) == [(1, "2001-02", 1), (2, None, 2)]


def test_table_upsert_refuses_duplicate_keys(spark, table):
    upsert_table(frame(spark, [(1, 1)], "id INT, v INT"), table, ["id"], ["v"])
    twice = frame(spark, [(2, 1), (2, 2)], "id INT, v INT")
    with pytest.raises(Exception, match="more than one source row"):
        upsert_table(twice, table, ["id"], ["v"])
    with pytest.raises(ValueError, match="needs an order"):
        upsert_table(twice, table, ["id"], ["v"], on_duplicate="latest")
    assert rows(spark.table(table)) == [(1, 1)]
    assert upsert_table(twice, table, ["id"], ["v"], on_duplicate="any") == (1, 0)
    assert rows(spark.table(table)) == [(1, 1), (2, 2)]


def test_table_columns_must_agree(spark, table):
    upsert_table(frame(spark, [(1, 1)], "id INT, v INT"), table, ["id"], ["v"])
    for ddl, row in (("id INT", (1,)), ("id INT, v INT, w INT", (1, 1, 1)), ("id INT, v BIGINT", (1, 1))):
        with pytest.raises(ValueError, match="differ"):
            upsert_table(frame(spark, [row], ddl), table, ["id"], [])


def test_partition_values_keep_their_type(spark, table):
    first = frame(spark, [("2001-02", 1), ("2002-03", 2), ("007", 3)], "season STRING, v INT")
    upsert_table(first, table, ["season"], ["v"], "season")
    assert upsert_table(frame(spark, [("2001-02", 5)], "season STRING, v INT"), table, ["season"], ["v"], "season") == (0, 1)
    assert rows(spark.table(table).select("season", "v")) == [("007", 3), ("2001-02", 5), ("2002-03", 2)]
    with pytest.raises(Exception, match="empty season"):
        upsert_table(frame(spark, [("", 5)], "season STRING, v INT"), table, ["season"], ["v"], "season")


def test_partition_column_must_be_a_key(spark, table):
    with pytest.raises(ValueError):
        upsert_table(frame(spark, [(1, 1)], "id INT, season INT"), table, ["id"], [], "season")
    assert not spark.catalog.tableExists(table)


def test_nulls_are_counted_by_the_job_that_writes(spark, table):
    df = frame(spark, [(1, None), (None, None), (3, "x")], "a INT, `b c` STRING")
    counted, seen = observed_nulls(df)
    counted.write.saveAsTable(table)
    assert seen.get == {"element_count": 3, "null_0": 1, "null_1": 2}
    none, seen = observed_nulls(empty_frame(spark, "a INT"))
    none.write.mode("overwrite").format("noop").save()
    assert seen.get == {"element_count": 0, "null_0": 0}


def test_sorted_storage_skips_files_and_splits_a_hot_key(spark, table):
    """A third of the rows has one key; files hold ranges of the keys, and the hot key lies in several."""
    df = spark.range(60_000).selectExpr("IF(id % 3 = 0, 500, id % 1000) AS k", "id AS v").repartition(7)
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        write_sorted(df, table, ["k"])
    ranges = []
    for path in files_of(spark, table):
        statistics = pq.ParquetFile(path).metadata
        for group in range(statistics.num_row_groups):
            own = statistics.row_group(group).column(0).statistics
            ranges.append((own.min, own.max))
    assert len(ranges) == 8 and sum(low <= 10 and high >= 5 for low, high in ranges) <= 2
    assert sum(low <= 500 <= high for low, high in ranges) >= 3
    got = spark.table(table).where("k BETWEEN 5 AND 10")
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,5), LessThanOrEqual(k,10)]" in plan_of(got)
    assert rows(got) == rows(df.where("k BETWEEN 5 AND 10"))
    assert glob.glob("/".join(next(iter(files_of(spark, table))).split("/")[:-1]) + "/*.parquet")
