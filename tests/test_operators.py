"""Operators on small frames: semantics, invariants and brute force."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sportmart.operators import reshape
from sportmart.operators.audit import audit_row, freshness
from sportmart.operators.nested import collect_flatten, explode_path, stack_array_columns
from sportmart.operators.pages import current_season, documents_for_ids, envelope, first_seasons, link_codes
from sportmart.operators.quality import QualityError, Suite, enforce, null_counts, run_suites
from sportmart.operators.reshape import distinct_sorted, long_to_wide
from sportmart.operators.sets import align_to, latest_per_key
from sportmart.operators.upsert import duplicate_keys, merge_into, upsert, upsert_counts
from sportmart.plans.catalogue.quality import table_lineage
from sportmart.plans.load import TARGETS
from sportmart.sources.documents import has_rows, is_schema_empty, read_pages
from sportmart.sources.frames import empty_frame, literal_rows
from sportmart.sources.tables import write_parquet


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


# ---- reshape -------------------------------------------------------------


@pytest.mark.parametrize("width", [3, 40])
def test_pivot_equals_brute_force(spark, width):
    rng = random.Random(width)
    names = [f"n{i}" for i in range(width)]
    data = [
        (rng.choice([1, 2, 3, None]), rng.choice([*names, "other", None]), rng.choice([None, 1.0, 2.0, 5.0]))
        for _ in range(600)
    ] + [(9, "other", 1.0)]
    sums = defaultdict(dict)
    for key, name, value in data:
        if key is not None:
            sums[key]
            if name in names and value is not None:
                sums[key][name] = sums[key].get(name, 0.0) + value
    expected = sorted(((k, *[v.get(n) for n in names]) for k, v in sums.items()), key=repr)
    df = frame(spark, data, "k INT, n STRING, v DOUBLE")
    wide = long_to_wide(df, ["k"], "n", "v", names)
    assert wide.columns == ["k", *names]
    assert rows(wide) == expected
    total = sum(v for r in rows(wide) for v in r[1:] if v is not None)
    assert total == sum(v for k, n, v in data if k is not None and n in names and v is not None)
    listed = long_to_wide(df, ["k"], "n", "v", names, listed_only=True)
    assert 9 not in {r[0] for r in rows(listed)}


def test_pivot_names_are_case_sensitive_and_can_hold_dots(spark):
    df = frame(spark, [(1, "a.b", 1.0), (1, "A.B", 2.0)], "k INT, n STRING, v DOUBLE")
    assert rows(long_to_wide(df, ["k"], "n", "v", ["a.b"])) == [(1, 1.0)]


@pytest.mark.parametrize("agg", ["sum", "max", "min"])
def test_few_names_fold_in_one_shuffle_like_the_pivot(spark, monkeypatch, agg):
    data = [(i % 5 or None, "ab.A"[i % 4], None if i % 7 == 0 else float(i % 11)) for i in range(300)] + [(8, None, 1.0), (9, "z", 1.0)]
    df = frame(spark, data * 2, "k INT, n STRING, v DOUBLE")
    make = lambda few, **how: (monkeypatch.setattr(reshape, "FEW_NAMES", few), long_to_wide(df, ["k"], "n", "v", ["a", ".", "none"], agg, **how))[1]
    for how in ({}, {"null_keys": True}, {"listed_only": True}):
        one, two = make(16, **how), make(0, **how)
        plans = [wide._jdf.queryExecution().executedPlan().toString() for wide in (one, two)]
        assert [plan.count("Exchange hashpartitioning") for plan in plans] == [1, 2]
        assert one.schema == two.schema and rows(one) == rows(two)


def test_too_many_names_is_an_error(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("n"))
    assert len(distinct_sorted(df, "n", limit=20)) == 20
    with pytest.raises(ValueError):
        distinct_sorted(df, "n", limit=19)


# ---- nested --------------------------------------------------------------


def test_regrouping_a_hot_key_stays_in_pieces(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        "id",
        F.array("id", -F.col("id")).alias("a"),
    )
    pieces = collect_flatten(df, ["k"], "a", F.floor(F.col("id") / 100))
    assert pieces.agg(F.max(F.size("a"))).first()[0] <= 200
    back = explode_path(pieces, "a", "v", keep=["k"])
    direct = explode_path(df, "a", "v", keep=["k"])
    assert back.exceptAll(direct).count() == 0 and direct.exceptAll(back).count() == 0


def test_stacking_keeps_label_and_skips_empty(spark):
    df = frame(spark, [(1, [1, 2], None), (2, [], [3])], "k INT, a ARRAY<INT>, b ARRAY<INT>")
    assert rows(stack_array_columns(df, ["a", "b"], "v", label="m", keep=["k"])) == [
        (1, "a", 1), (1, "a", 2), (2, "b", 3),
    ]


# ---- sets ----------------------------------------------------------------


def test_align_fills_casts_and_orders(spark):
    df = frame(spark, [("7", 1.0)], "Id STRING, extra DOUBLE")
    got = align_to(df, [("name", "string"), ("id", "bigint")])
    assert got.dtypes == [("name", "string"), ("id", "bigint")]
    assert rows(got) == [(None, 7)]


def test_latest_per_key_is_the_same_on_every_run(spark):
    rng = random.Random(4)
    data = [(rng.choice([1, 2, None]), rng.randrange(3), rng.randrange(50)) for _ in range(300)]
    df = frame(spark, data, "k INT, t INT, v INT")
    expected = [max((r for r in data if r[0] == k), key=lambda r: r[1:]) for k in (1, 2)]
    expected += [r for r in data if r[0] is None]
    for parts in (1, 7):
        assert rows(latest_per_key(df.repartition(parts), ["k"], ["t"])) == sorted(expected, key=repr)


# ---- upsert --------------------------------------------------------------

DDL = "a INT, b INT, x STRING, y INT"


def brute_upsert(target, source, keys, updates, columns):
    """Row by row, as a MERGE would."""
    position = {c: i for i, c in enumerate(columns)}
    key = lambda r: tuple(r[position[k]] for k in keys)
    by_key = {key(r): r for r in source if None not in key(r)}
    stored = {key(r) for r in target if None not in key(r)}
    out = []
    for r in target:
        new = by_key.get(key(r)) if None not in key(r) else None
        out.append(tuple(new[i] if new and c in updates else v for i, (c, v) in enumerate(zip(columns, r))))
    out += [r for r in source if None in key(r) or key(r) not in stored]
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("updates", [["x", "y"], ["y"], []])
def test_upsert_equals_brute_force(spark, updates, broadcast):
    rng = random.Random(len(updates))
    part = lambda: rng.choice([None, 1, 2, 3, 4, 5])
    target = [(part(), part(), rng.choice("pqr"), rng.randrange(9)) for _ in range(80)]
    source, seen = [], set()
    for _ in range(60):
        row = (part(), part(), rng.choice(["s", "t", None]), rng.choice([None, 7]))
        if None in row[:2] or row[:2] not in seen:
            seen.add(row[:2])
            source.append(row)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = rows(upsert(frame(spark, target, DDL), frame(spark, source, DDL), ["a", "b"], updates))
        counts = upsert_counts(frame(spark, target, DDL), frame(spark, source, DDL), ["a", "b"]).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute_upsert(target, source, ["a", "b"], updates, ["a", "b", "x", "y"])
    assert counts["rows_inserted"] == len(got) - len(target)


def test_upsert_twice_changes_nothing(spark):
    target = frame(spark, [(1, 1, "a", 1), (2, 2, "b", 2)], DDL)
    source = frame(spark, [(1, 1, "z", 9), (3, 3, "c", 3)], DDL)
    once = upsert(target, source, ["a", "b"])
    assert rows(upsert(once, source, ["a", "b"])) == rows(once)


def test_duplicate_source_key(spark):
    target = frame(spark, [(1, 1, "a", 1)], DDL)
    source = frame(spark, [(1, 1, "b", 2), (1, 1, "c", 3), (None, 1, "n", 0), (None, 1, "n", 0)], DDL)
    assert rows(duplicate_keys(source, ["a", "b"])) == [(1, 1, 2)]
    for updates in (["x", "y"], []):
        with pytest.raises(Exception, match="more than one source row"):
            upsert(target, source, ["a", "b"], updates).collect()
    latest = upsert(target, source, ["a", "b"], on_duplicate="latest", order=["y"])
    assert rows(latest) == [(1, 1, "c", 3), (None, 1, "n", 0), (None, 1, "n", 0)]
    assert rows(upsert(target, source, ["a", "b"], on_duplicate="any")) == rows(latest)
    for wrong in ("first", "latest"):
        with pytest.raises(ValueError):
            upsert(target, source, ["a", "b"], on_duplicate=wrong)


def test_upsert_where_all_columns_are_keys(spark):
    ddl = "a INT, b INT"
    target = frame(spark, [(1, 1), (2, 2), (2, 2), (None, 3), (None, 3)], ddl)
    source = frame(spark, [(1, 1), (4, 4), (None, 3), (None, 5)], ddl)
    want = sorted([(1, 1), (2, 2), (2, 2), (4, 4), *[(None, 3)] * 3, (None, 5)], key=repr)
    for mode in ("error", "any", "unique"):
        assert rows(upsert(target, source, ["a", "b"], on_duplicate=mode)) == want
    assert upsert_counts(target, source, ["a", "b"]).first().asDict() == {"rows_inserted": 3, "rows_updated": 1}
    twice = source.union(source)
    assert rows(upsert(target, twice, ["a", "b"], on_duplicate="any")) == sorted([*want, (None, 3), (None, 5)], key=repr)
    with pytest.raises(Exception, match="more than one source row"):
        upsert(target, twice, ["a", "b"]).collect()


def test_copies_of_a_hot_key_fold_before_they_are_shuffled(spark, tmp_path):
    write_parquet(spark.range(10).selectExpr("id AS a", "id AS y"), str(tmp_path / "target"))
    write_parquet(spark.range(20_000).selectExpr("IF(id % 3 = 0, id % 10, 7) AS a", "id AS y"), str(tmp_path / "source"))
    target, source = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source"))
    got = upsert(target, source, ["a"], on_duplicate="latest", order=["y"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    fold, window = plan.rindex("partial_max"), plan.index("Window")
    assert window < plan.index("Exchange") < fold
    assert dict(rows(got))[7] == 19_999 and len(rows(got)) == 10


def test_merge_needs_a_catalog_with_merge(spark):
    from pyspark.errors import PySparkException

    spark.range(1).createOrReplaceTempView("merge_target")
    with pytest.raises(PySparkException):
        merge_into(spark.range(1), "merge_target", ["id"], [])


def test_upsert_reads_and_shuffles_each_side_once(spark, tmp_path):
    for name in ("target", "source"):
        write_parquet(spark.range(1000).selectExpr("id AS a", "id AS b", "'x' AS x", "1 AS y"), str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source"))
    plan = upsert(target, source, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange ") == 1 and "Join" not in plan


# ---- frames --------------------------------------------------------------


def test_guards(spark):
    df = frame(spark, [(1, None), (2, dt.date(2020, 1, 1))], "a BIGINT, b DATE")
    assert not has_rows(empty_frame(spark, "a INT")) and has_rows(df)
    assert is_schema_empty(df.select()) and not is_schema_empty(df)
    assert rows(literal_rows(spark, [(1, None)], df.schema)) == [(1, None)]


# ---- quality -------------------------------------------------------------


def test_every_check_reports_counts(spark):
    df = frame(
        spark, [(1, None, ("x",)), (2, 3.0, (None,)), (3, 4.0, None)], "id BIGINT, v DOUBLE, s STRUCT<name: STRING>"
    )
    suite = (
        Suite("it's", df)
        .columns_exist(["id", "nope"])
        .any_column_exists(["nope", "v"])
        .not_null()
        .column_set(["id", "v", "w"])
        .column_types([("id", "bigint"), ("v", "decimal(10,0)")])
        .nested_exists("s", "name")
        .nested_exists("s", "code")
    )
    got = {(r["check"], r["column"]): (r["passed"], r["unexpected_count"], r["detail"]) for r in suite.results().collect()}
    assert got == {
        ("column_exists", "id"): (True, 0, ""),
        ("column_exists", "nope"): (False, 1, "column is missing"),
        ("any_column_exists", "nope,v"): (True, 0, "found: v"),
        ("not_null", "id"): (True, 0, ""),
        ("not_null", "v"): (False, 1, ""),
        ("not_null", "s"): (False, 1, ""),
        ("column_set", "*"): (False, 2, "missing: w; unexpected: s"),
        ("column_type", "id"): (True, 0, ""),
        ("column_type", "v"): (False, 1, "double for decimal(10,0)"),
        ("nested_exists", "s.name"): (False, 1, ""),
        ("nested_exists", "s.code"): (False, 1, "path is missing"),
    }
    assert {r["element_count"] for r in suite.results().collect()} == {3}


def test_schema_checks_alone_run_nothing(spark):
    broken = spark.range(3).select(F.raise_error(F.lit("must not run")).cast("bigint").alias("id"))
    suite = Suite("t", broken).column_set(["id"]).column_types([("id", "bigint")])
    got = [(r["passed"], r["unexpected_count"], r["element_count"]) for r in suite.results(count_rows=False).collect()]
    assert got == [(True, 0, None), (True, 0, None)]


def test_enforce(spark):
    results = run_suites([Suite("t", spark.range(2)).columns_exist(["id", "gone"])])
    with pytest.warns(UserWarning, match="gone"):
        assert enforce(results).count() == 1
    with pytest.raises(QualityError, match="t: column_exists gone"):
        enforce(results, "raise")
    assert enforce(run_suites([Suite("t", spark.range(2)).not_null()]), "raise").count() == 0


def test_null_counts(spark):
    df = frame(spark, [(1, None), (None, None)], "a INT, b INT")
    assert rows(null_counts(df)) == [("a", 1, 2), ("b", 2, 2)]


# ---- ingestion and audit -------------------------------------------------


def test_pages(spark, tmp_path):
    (tmp_path / "p0.json").write_text('{"pageInfo": {"page": 0, "numPages": 2}, "content": [{"id": 1}, {"id": 2}]}')
    (tmp_path / "p1.json").write_text('{"pageInfo": {"page": 1, "numPages": 2}, "content": []}')
    pages = read_pages(spark, str(tmp_path), "id: BIGINT")
    assert rows(explode_path(pages, "content", "c").select("c.id")) == [(1,), (2,)]
    body = frame(spark, [("goals", ([1, 2],))], "entity STRING, stats STRUCT<content: ARRAY<INT>>")
    assert rows(envelope(body)) == [("goals", [1, 2])]


def test_link_codes_by_class(spark):
    html = """<a class="topStatsLink" href="/s/goals">g</a><A HREF='/s/saves?po=GOALKEEPER' class='x more-stats__link'>s</A>
              <a href="/s/plain">p</a><a class="topStatsLink">none</a><abbr href="/s/no">"""
    df = frame(spark, [(html,)], "html STRING")
    assert rows(link_codes(df, "html")) == [("goals",), ("plain",), ("saves",)]
    assert rows(link_codes(df, "html", ["topStatsLink", "more-stats__link"])) == [("goals",), ("saves",)]


def test_listing_and_seasons(spark):
    documents = frame(spark, [(1, "a"), (1, "b"), (2, "c")], "id INT, v STRING")
    assert rows(documents_for_ids(frame(spark, [(1,), (1,)], "id INT"), documents, "id")) == [(1, "a"), (1, "b")]
    seasons = frame(spark, [(3, "2023-24"), (1, "2021-22"), (2, "2022-23")], "id INT, label STRING")
    assert rows(current_season(seasons)) == [(3, "2023-24")]
    assert rows(current_season(seasons, "2021-22")) == [(1, "2021-22")]
    assert rows(first_seasons(seasons, 2)) == [(1, "2021-22"), (2, "2022-23")]


def test_audit_freshness_and_lineage(spark):
    now = dt.datetime(2024, 1, 1, 12)
    counts = literal_rows(spark, [(1, 2)], "rows_inserted BIGINT, rows_updated BIGINT")
    fresh = audit_row(counts, "new", now - dt.timedelta(minutes=59))
    stale = audit_row(counts, "old", now - dt.timedelta(minutes=61))
    got = freshness(fresh.union(stale), ["new", "old", "never"], now).select("table", "fresh")
    assert rows(got) == [("never", False), ("new", True), ("old", False)]
    mapping = Counter(r["table"] for r in table_lineage(spark).collect())
    assert mapping == {name: len(target.sources) for name, target in TARGETS.items()}
