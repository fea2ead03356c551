"""Documents without a declared shape, and functions and filters that Spark supplies."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sportmart import functions
from sportmart.functions.sql import register_functions
from sportmart.operators.nested import variant_rows
from sportmart.operators.pages import BLOOM, documents_for_ids, documents_of_large_listing
from sportmart.session import settings
from sportmart.sources.inference import field_rows, inferred_schema, read_variants, typed
from tests.test_operators import frame, rows


def variants(spark, texts):
    return frame(spark, [(t,) for t in texts], "s STRING").select(F.try_parse_json("s").alias("document"))


MIXED = [
    '{"a": 1, "b": "x", "c": {"d": [1, 2.5], "e e": 1}, "n": null}', '{"a": 2.5, "b": 3, "t": true, "OBJECT<": {"x": 1}}',
    '{"b": {"deep": [1]}, "c": {"d": [], "f": 7}, "big": 123456789012345678901}', "not json", None, "{}",
]


def test_schema_of_mixed_documents(spark):
    schema = inferred_schema(variants(spark, MIXED))
    assert dict(field_rows(schema)) == {
        "a": "double", "b": "string", "big": "bigint", "c.d": "array<double>", "c.e e": "bigint", "c.f": "bigint",
        "n": "string", "t": "boolean", "OBJECT<.x": "bigint",
    }
    got = typed(variants(spark, MIXED), schema).collect()
    assert [r["a"] for r in got] == [1.0, 2.5, None, None, None, None]
    assert [r["b"] for r in got] == ["x", "3", '{"deep":[1]}', None, None, None]
    assert got[0]["c"].asDict() == {"d": [1.0, 2.5], "e e": 1, "f": None} and got[1]["OBJECT<"]["x"] == 1


def test_schema_of_nothing(spark):
    for texts in ([], [None], ["junk"], ["[1]"], ["[1]", "{}"], ["5"]):
        assert inferred_schema(variants(spark, texts)) == T.StructType([]), texts


def test_landed_documents_of_one_file(spark, tmp_path):
    (tmp_path / "all.json").write_text('[{"a": 1,\n "b": [true]},\n {"a": "x"}]')
    documents = read_variants(spark, str(tmp_path), multi_line=True)
    assert dict(field_rows(inferred_schema(documents))) in (
        {"a": "string", "b": "array<boolean>"},
    )


def test_values_under_unknown_keys(spark):
    documents = variants(spark, ['{"a": 1, "b": {"c": [true, {"d": "x"}], "e": {}}, "n": null}', "7", "[]", None])
    got = rows(variant_rows(documents, "document", 3))
    assert got == sorted([
        (".a", "BIGINT", "1"), (".b.c[0]", "BOOLEAN", "true"), (".b.c[1]", "OBJECT<d: STRING>", '{"d":"x"}'),
        (".b.e", "OBJECT<>", "{}"), (".n", "VOID", None), ("", "BIGINT", "7"), ("", "ARRAY<VOID>", "[]"),
    ], key=repr)
    assert len(rows(variant_rows(documents, "document", 0))) == 3


def test_sql_functions_equal_the_column_functions(spark):
    assert register_functions(spark) == register_functions(spark)
    r = random.Random(4)
    kickoffs = [f"Sat {r.randint(1, 31)} {r.choice('Jan Mar Aug Oct'.split())} {r.randint(1990, 2030)}, {r.randint(0, 24)}:{r.randint(0, 59):02d}{z}"
                for z in ("", " BST", " GMT") for _ in range(60)]
    kickoffs += ["Sun 29 Oct 2023, 01:30", "Sun 26 Mar 2023, 01:30", "nothing", "", None]
    others = ["Central Defender/Mid", "90 +5'00", "45", "90 +5'12", "31 March 1998", "32 May 2000", "  7", "a  b", "90 +5 +3'00"]
    df = frame(spark, [(t,) for t in kickoffs + others], "text STRING")
    names = ["initials", "parse_long_date", "local_date", "local_time", "clock_minutes", "london_to_local"]
    by_sql = spark.sql("SELECT text, " + ", ".join(f"{n}(text) AS {n}" for n in names) + " FROM {df}", df=df)
    by_column = df.select("text", *(getattr(functions, n)(F.col("text")).alias(n) for n in names))
    assert rows(by_sql) == rows(by_column)
    plan = by_sql._jdf.queryExecution().optimizedPlan().toString()
    # Inlined: expressions of this one projection, no function left to call.
    assert plan.startswith("Project") and "array_join" in plan and "initials(" not in plan


def test_large_listing_filters_before_the_shuffle(spark, tmp_path):
    spark.range(50_000).selectExpr("id", "id * 2 AS v").write.parquet(str(tmp_path / "documents"))
    spark.range(50_000).selectExpr("id", "id % 100 AS season").write.parquet(str(tmp_path / "listing"))
    documents, listing = (spark.read.parquet(str(tmp_path / x)) for x in ("documents", "listing"))
    listing = listing.where("season = 7")
    with settings(spark, {**BLOOM, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = documents_for_ids(listing, documents, "id")._jdf.queryExecution().executedPlan().toString()
    assert "might_contain" in plan[: plan.index("Scan")] and "BroadcastHashJoin" not in plan
    got = documents_of_large_listing(listing, documents, "id")
    assert rows(got) == [(i, 2 * i) for i in sorted(range(7, 50_000, 100), key=lambda i: repr((i, 2 * i)))]
