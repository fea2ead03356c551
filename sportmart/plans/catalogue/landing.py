"""Queries that write and read back: landing zone, bronze, table upserts.

They write below the shared folder of the session, since other executors
read what one of them wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sportmart.functions import academic_year, nth
from sportmart.plans import dims, facts, standins
from sportmart.plans.catalogue.registry import QUERIES, query, season_sql, season_start_sql
from sportmart.plans.ingest import land_pages, page_ddl
from sportmart.plans.dims import as_id
from sportmart.plans.catalogue.models import BRIDGE_SQL, PLAYER_SQL, SEASON_IDS_SQL
from sportmart.plans.load import TARGETS, load_tables, read_audit
from sportmart.schemas import SOURCES
from sportmart.session import new_database, shared_dir
from sportmart.sources.documents import extract, has_rows, is_schema_empty, read_entity, read_landed, read_lines
from sportmart.operators.nested import variant_rows
from sportmart.sources.frames import empty_frame, literal_rows
from sportmart.sources.inference import field_rows, inferred_schema, read_variants, typed
from sportmart.sources.tables import (
    empty_like,
    create_table,
    land_documents,
    land_json,
    observed_nulls,
    staged,
    target_schema,
    to_bronze,
    upsert_table,
    write_lines,
    write_parquet,
    write_sorted,
)
from sportmart.streaming.incremental import stream_upsert


def _landed_matches(t, seasons=None):
    """Match documents landed as JSON by season and read back with the declared schema."""
    path = shared_dir(t.spark, "landing")
    documents = standins.match_info(t)
    land_json(documents, path)
    back = read_landed(t.spark, path, documents.drop("season").schema, seasons)
    return back.select(as_id("id").alias("id"), as_id(nth("teams", 0, "team.id")).alias("home"), "season")


LANDED_SQL = f"SELECT o_orderkey AS id, o_custkey AS home, {season_sql('o_orderdate')} AS season FROM orders"


@query("SNK-1", LANDED_SQL)
def landing_roundtrip(t):
    return _landed_matches(t)


@query("LIM-1 SNK-1", f"SELECT * FROM ({LANDED_SQL}) WHERE season IN ('1996-97', '1999-00')")
def landed_seasons(t):
    """The season parameter of a read: only the directories of two seasons are scanned."""
    return _landed_matches(t, ["1996-97", "1999-00"])


@query(
    "SRC-8 SRC-5 SET-2",
    "SELECT o_orderkey AS match_id FROM orders",
)
def optional_source(t):
    """A source that never landed adds no rows to one that did."""
    landed = standins.match_info(t).drop("season")
    absent = read_entity(t.spark, shared_dir(t.spark, "absent"), "match_info", optional=True)
    return landed.unionByName(absent, allowMissingColumns=True).select(F.col("id").cast("bigint").alias("match_id"))


@query(
    "SRC-4 SRC-5 SNK-4",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    """,
)
def target_schema_snapshot(t):
    """Rows appended to a table, aligned to the schema read from it."""
    path = shared_dir(t.spark, "snapshot")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    write_parquet(empty_frame(t.spark, "o_orderstatus STRING, o_orderkey BIGINT, o_custkey BIGINT"), path)
    names = target_schema(t.spark, path).fieldNames()
    write_parquet(empty_like(t.spark, path).unionByName(rows).select(*names), path, mode="append")
    return t.spark.read.parquet(path)


@query(
    "SNK-2 SNK-3",
    """
    SELECT s_suppkey AS club_id, s_name || CASE WHEN s_acctbal < 1000 THEN ' FC' ELSE '' END AS name,
           'Club ' || s_suppkey AS short_name, 'C' || s_suppkey AS abbr
    FROM supplier
    """,
)
def table_upsert(t):
    """Two seasons of clubs upserted into a table of the catalogue, one after the other."""
    table = f"{new_database(t.spark, 'clubs')}.dim_club"
    clubs, spec = standins.club_info(t), TARGETS["dim_club"]
    for season in standins.CLUB_SEASONS:
        rows = dims.dim_club(clubs.where(F.col("season") == season))
        upsert_table(rows, table, spec.keys(rows.columns), spec.update_cols(rows.columns))
    return t.spark.table(table)


@query(
    "SNK-2 SNK-3 MDL-13",
    f"""
    SELECT l_orderkey AS match_id, l_suppkey AS club_id, s.season_id, max(l_quantity) AS duel_lost,
           max(CASE WHEN s.season_id >= 1999 THEN l_linenumber ELSE 0 END)::DOUBLE AS fk_foul_lost
    FROM (SELECT *, {season_start_sql('l_shipdate')} AS season_id FROM lineitem) s
    WHERE s.season_id IN (SELECT {season_start_sql('o_orderdate')} FROM orders)
    GROUP BY 1, 2, 3
    """,
)
def table_upsert_partitions(t):
    """A table by season of which an upsert rewrites only the later seasons."""
    table, spec = f"{new_database(t.spark, 'match_stats')}.fct_match_stat", TARGETS["fct_match_stat"]
    names = ["duel_lost", "fk_foul_lost"]
    fact = staged(facts.fct_match_stat(standins.match_stats(t), standins.seasons(t), names), "match-fact")
    keys, updates = spec.keys(fact.columns), spec.update_cols(fact.columns)
    for rows in (fact.withColumn("fk_foul_lost", F.lit(0.0)), fact.where("season_id >= 1999")):
        upsert_table(rows, table, keys, updates, spec.partition_by)
    return t.spark.table(table)


@query(
    "SNK-3 JON-9",
    """
    SELECT user_id AS player_id, event_type AS kind, max(value) AS best FROM events GROUP BY 1, 2
    UNION ALL SELECT NULL, event_type, max(value) FROM events GROUP BY 2
    UNION ALL SELECT NULL, event_type, max(value) FROM events GROUP BY 2
    """,
)
def bucketed_upsert(t):
    """A table in buckets of its key, filled and then upserted: best values of all players, first those of clicks as 0; rows
    without a player come with both loads and are inserted both times."""
    table, keys = f"{new_database(t.spark, 'bests')}.bests", ["player_id", "kind"]
    best = F.max("value").alias("best")
    players = t.events.groupBy(F.col("user_id").alias("player_id"), F.col("event_type").alias("kind")).agg(best)
    nobody = t.events.groupBy(F.col("event_type").alias("kind")).agg(best)
    rows = staged(players.unionByName(nobody, allowMissingColumns=True), "bests")
    create_table(t.spark, table, rows.schema, buckets=8, keys=keys)
    old = rows.where("kind = 'click' AND player_id IS NOT NULL").withColumn("best", F.lit(0.0))
    for source in (old.union(rows.where("player_id IS NULL")), rows):
        upsert_table(source, table, keys, ["best"])
    return t.spark.table(table)


@query(
    "SNK-3 SNK-2 MDL-12",
    f"""
    SELECT o_orderkey AS id, {season_start_sql('o_orderdate')} AS season_id,
           o_totalprice + CASE WHEN {season_start_sql('o_orderdate')} = 1997 THEN 1 ELSE 0 END AS price FROM orders
    """,
)
def upsert_prunes_partitions(t):
    """One season upserted into a table by season: the source's seasons prune the partitions that are read and replaced."""
    database = new_database(t.spark, "prices")
    season = academic_year(F.col("o_orderdate")).substr(1, 4).cast("bigint")
    rows = t.orders.select(F.col("o_orderkey").alias("id"), season.alias("season_id"), F.col("o_totalprice").alias("price"))
    upsert_table(rows, f"{database}.prices", ["id", "season_id"], ["price"], "season_id")
    later = rows.where("season_id = 1997").withColumn("price", F.col("price") + 1)
    upsert_table(later, f"{database}.prices", ["id", "season_id"], ["price"], "season_id")
    return t.spark.table(f"{database}.prices").select("id", "season_id", "price")


@query(
    "SRT-1",
    """
    SELECT l_suppkey AS club_id, l_orderkey AS match_id, l_linenumber AS line, l_quantity AS value FROM lineitem
    WHERE l_suppkey BETWEEN 3 AND 6
    """,
)
def sorted_key_range(t):
    """A range of the business key from a table that is stored in its order: other files and row groups are skipped."""
    table = f"{new_database(t.spark, 'sorted')}.club_lines"
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("club_id"), F.col("l_orderkey").alias("match_id"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("value"),
    )
    write_sorted(rows, table, ["club_id", "match_id"])
    return t.spark.table(table).where("club_id BETWEEN 3 AND 6")


@query(
    "SNK-1 MDL-4",
    """
    SELECT s_suppkey AS club_id, s_name AS name, 'Club ' || s_suppkey AS short_name, 'C' || s_suppkey AS abbr
    FROM supplier
    UNION SELECT s_suppkey, s_name || ' FC', 'Club ' || s_suppkey, 'C' || s_suppkey FROM supplier WHERE s_acctbal < 1000
    """,
)
def bronze_models(t):
    """Sources parsed once into Parquet by season, a table built from them."""
    bronze = to_bronze({"club_info": standins.club_info(t)}, shared_dir(t.spark, "bronze"))
    return dims.dim_club(bronze["club_info"])


@query(
    "SNK-3 SNK-1",
    f"""
    SELECT o_custkey AS id, CAST(count(DISTINCT {season_sql('o_orderdate')}) AS BIGINT) AS seasons_seen FROM orders
    GROUP BY 1
    """,
)
def incremental_upsert(t):
    """Landed seasons streamed in one file batch at a time, upserted into a table."""
    landing, table = shared_dir(t.spark, "stream-landing"), f"{new_database(t.spark, 'stream')}.seen"
    rows = t.orders.select(
        F.col("o_custkey").alias("id"), academic_year(F.col("o_orderdate")).alias("season")
    ).distinct()
    schema = "id BIGINT, season STRING"
    write_parquet(rows, landing, ["season"])
    stream_upsert(
        t.spark, landing, schema, table, shared_dir(t.spark, "stream-checkpoint"), keys=["id", "season"], update_cols=[],
        partition_by="season",
    )
    return t.spark.table(table).groupBy("id").agg(F.count("season").alias("seasons_seen"))


CLUB_SEASONS_SQL = """
    SELECT s_suppkey AS id, season, s_name || CASE WHEN s_acctbal < 1000 AND season = '2000-01' THEN ' FC' ELSE '' END AS name
    FROM supplier, (VALUES ('1999-00'), ('2000-01')) AS v(season)
"""


def _club_files(t):
    """Clubs landed as arrays by path, and one file that breaks off."""
    root, path = shared_dir(t.spark, "clubs"), SOURCES["club_info"].path
    land_documents(standins.club_info(t), root, path, standins.CLUB_SEASONS)
    broken = t.region.where("r_regionkey = 0").select(F.concat(F.lit('[{"id": 1.0, "name": "'), "r_name").alias("value"))
    broken.write.mode("append").text(f"{root}/{path.replace('{season}', standins.CLUB_SEASONS[0])}")
    return root


@query(
    "SRC-1 SRC-2",
    f"""
    SELECT season, id, name, false AS corrupt FROM ({CLUB_SEASONS_SQL})
    UNION ALL SELECT '1999-00', NULL, NULL, true
    """,
)
def entity_files(t):
    """Multi-line documents of all seasons, the season from the path, a broken file kept as text."""
    clubs = read_entity(t.spark, _club_files(t), "club_info", corrupt_column="_text")
    return clubs.select("season", as_id("id").alias("id"), "name", F.col("_text").isNotNull().alias("corrupt"))


@query("SRC-1 SRC-2 LIM-1", f"SELECT id, name FROM ({CLUB_SEASONS_SQL}) WHERE season = '2000-01'")
def entity_files_of_season(t):
    """The files of one season only."""
    clubs = read_entity(t.spark, _club_files(t), "club_info", [standins.CLUB_SEASONS[1]])
    return clubs.select(as_id("id").alias("id"), "name")


#: Awards in a file, about.
AWARDS_PER_FILE = 1000


def _month_awards(t, seasons=None):
    """Awards of all seasons landed as files of several months each and one file that breaks off; those of ``seasons``, or
    all, read back."""
    root, path = shared_dir(t.spark, "awards"), SOURCES["month_award"].path
    item = "named_struct('awardTypeId', 1D, 'official', named_struct('officialId', CAST(o_custkey AS DOUBLE)))"
    orders = t.orders.withColumn("season", academic_year(F.col("o_orderdate")))
    # Names of seasons: one per year.
    counts = [tuple(r) for r in orders.groupBy("season").count().collect()]
    files_of = F.create_map(*(F.lit(x) for season, n in counts for x in (season, -(-n // AWARDS_PER_FILE))))
    piece = F.pmod(F.xxhash64("o_orderkey"), files_of[F.col("season")])
    months = orders.groupBy("season", piece.alias("piece"), F.date_format("o_orderdate", "MMMM").alias("month"))
    months = months.agg(F.expr(f"collect_list({item})").alias("items"))
    by_month = F.map_from_entries(F.collect_list(F.struct("month", "items")))
    files = staged(months.groupBy("season", "piece").agg(F.to_json(by_month).alias("value")), "award-files")
    for season, _ in counts:
        text = files.where(F.col("season") == season).select("value")
        text.write.option("maxRecordsPerFile", 1).text(f"{root}/{path.replace('{season}', season)}")
    broken = t.region.where("r_regionkey = 0").select(F.concat(F.lit('{"May": [{"award": "'), "r_name").alias("value"))
    broken.write.mode("append").text(f"{root}/{path.replace('{season}', '1996-97')}")
    optional = [name for name in SOURCES if name != "awards"]
    sources = extract(t.spark, root, seasons, optional)
    sources["month_award"] = read_entity(t.spark, root, "month_award", seasons, corrupt_column="_text")
    present = [df for df in sources.values() if not is_schema_empty(df) and has_rows(df)]
    (found,) = present
    rows = found.select("season", F.explode_outer("awards").alias("month", "items"), F.col("_text").isNotNull().alias("corrupt"))
    rows = rows.select("season", "month", F.explode_outer("items").alias("item"), "corrupt")
    return rows.select("season", "month", as_id("item.official.officialId").alias("holder"), "corrupt")


@query(
    "SRC-1 SRC-6 SRC-7 SRC-8",
    f"""
    SELECT {season_sql('o_orderdate')} AS season, strftime(o_orderdate, '%B') AS month, o_custkey AS holder, false AS corrupt
    FROM orders WHERE {season_sql('o_orderdate')} IN ('1996-97', '1997-98')
    UNION ALL SELECT '1996-97', NULL, NULL, true
    """,
)
def month_award_files(t):
    """Month awards as whole documents by path; sources that have no files, rows or columns are passed over.
    All seasons are landed, the files of two are read."""
    return _month_awards(t, ["1996-97", "1997-98"])


@query(
    "SRC-1 SRC-6 SRC-7 SRC-8",
    f"""
    SELECT {season_sql('o_orderdate')} AS season, strftime(o_orderdate, '%B') AS month, o_custkey AS holder, false AS corrupt
    FROM orders
    UNION ALL SELECT '1996-97', NULL, NULL, true
    """,
)
def month_award_files_all(t):
    """Month awards of every season, as whole documents by path."""
    return _month_awards(t)


def _undeclared(t):
    """Orders landed as documents of mixed shapes and read back without a schema: scores are whole, broken or absent, codes are numbers
    or text, and a line in a thousand or so does not parse."""
    path = shared_dir(t.spark, "undeclared")
    document = """to_json(named_struct('id', o_orderkey, 'home', named_struct('team', named_struct('id', o_custkey)),
        'marks', array(o_orderkey % 3, o_orderkey % 5), 'played', o_orderstatus <> 'P', 'note', o_orderpriority))"""
    score = """CASE o_orderstatus WHEN 'F' THEN concat(', "score": ', o_orderkey % 4) WHEN 'O' THEN concat(', "score": ', o_orderkey % 4, '.5')
        ELSE ', "referee": null' END"""
    code = """IF(o_orderkey % 2 = 0, concat(', "code": ', o_orderkey), concat(', "code": "C', o_orderkey, '"'))"""
    text = f"IF(o_orderkey % 1009 = 1, '{{\"id\": ', concat(left({document}, length({document}) - 1), {score}, {code}, '}}'))"
    t.orders.select(F.expr(text).alias("value")).write.text(path)
    return read_variants(t.spark, path)


WHOLE_SQL = "o_orderkey % 1009 <> 1"


@query(
    "SRC-1 PRJ-6",
    f"""
    SELECT path, type FROM (VALUES ('code', 'string', 'true'), ('home.team.id', 'bigint', 'true'), ('id', 'bigint', 'true'),
        ('marks', 'array<bigint>', 'true'), ('note', 'string', 'true'), ('played', 'boolean', 'true')) AS v(path, type, always)
    UNION ALL SELECT 'score', CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'O') > 0 THEN 'double' ELSE 'bigint' END
    FROM orders WHERE {WHOLE_SQL} AND o_orderstatus <> 'P' HAVING count(*) > 0
    UNION ALL SELECT 'referee', 'string' FROM orders WHERE {WHOLE_SQL} AND o_orderstatus = 'P' HAVING count(*) > 0
    """,
)
def inferred_fields(t):
    """Fields and types of landed documents that nobody declared."""
    return literal_rows(t.spark, field_rows(inferred_schema(_undeclared(t))), "path STRING, type STRING")


@query(
    "SRC-1 PRJ-6",
    f"""
    SELECT o_orderkey AS id, o_custkey AS home_team_id, o_orderkey % 5 AS second_mark, o_orderstatus <> 'P' AS played,
           CASE o_orderstatus WHEN 'F' THEN (o_orderkey % 4)::DOUBLE WHEN 'O' THEN o_orderkey % 4 + 0.5::DOUBLE END AS score,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey::VARCHAR ELSE 'C' || o_orderkey END AS code
    FROM orders WHERE {WHOLE_SQL}
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM orders WHERE NOT ({WHOLE_SQL})
    """,
)
def inferred_documents(t):
    """The same documents as columns of the inferred types; one that does not parse has none."""
    documents = _undeclared(t)
    rows = typed(documents, inferred_schema(documents))
    return rows.select(
        "id", F.col("home.team.id").alias("home_team_id"), F.get("marks", F.lit(1)).alias("second_mark"), "played",
        F.col("score").cast("double").alias("score"), "code",
    )


@query(
    "NST-5 NST-7 PRJ-6",
    f"""
    SELECT o_orderkey AS id, path, type, text FROM (SELECT * FROM orders WHERE {WHOLE_SQL}), LATERAL (
        SELECT '.id' AS path, 'BIGINT' AS type, o_orderkey::VARCHAR AS text
        UNION ALL SELECT '.home.team', 'OBJECT<id: BIGINT>', '{{"id":' || o_custkey || '}}'
        UNION ALL SELECT '.marks[0]', 'BIGINT', (o_orderkey % 3)::VARCHAR
        UNION ALL SELECT '.marks[1]', 'BIGINT', (o_orderkey % 5)::VARCHAR
        UNION ALL SELECT '.played', 'BOOLEAN', CASE WHEN o_orderstatus <> 'P' THEN 'true' ELSE 'false' END
        UNION ALL SELECT '.note', 'STRING', o_orderpriority
        UNION ALL SELECT '.score', CASE o_orderstatus WHEN 'F' THEN 'BIGINT' ELSE 'DECIMAL(' || CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 2 END || ',1)' END,
               (o_orderkey % 4) || CASE o_orderstatus WHEN 'O' THEN '.5' ELSE '' END WHERE o_orderstatus <> 'P'
        UNION ALL SELECT '.referee', 'VOID', NULL WHERE o_orderstatus = 'P'
        UNION ALL SELECT '.code', CASE WHEN o_orderkey % 2 = 0 THEN 'BIGINT' ELSE 'STRING' END,
               CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'C' END || o_orderkey) v
    """,
)
def unknown_object_rows(t):
    """Every value of documents of unknown keys and types as a row, two levels deep."""
    documents = _undeclared(t)
    keyed = documents.select(F.try_variant_get("document", "$.id", "bigint").alias("id"), "document")
    return variant_rows(keyed, "document", 2, keep=["id"])


@query(
    "DQ-2 AGG-8 RAM-2",
    """
    SELECT 'o_orderkey' AS "column", count(*) FILTER (WHERE o_orderkey IS NULL) AS null_count, count(*) AS element_count FROM orders
    UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus = 'P'), count(*) FROM orders
    UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice < 50000), count(*) FROM orders
    """,
)
def dq_nulls_while_writing(t):
    """Nulls per column, counted by the job that stores the rows."""
    rows = t.orders.select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("o_totalprice"),
    )
    counted, seen = observed_nulls(rows)
    counted.write.saveAsTable(f"{new_database(t.spark, 'checked')}.orders")
    counts = [(name, seen.get[f"null_{i}"], seen.get["element_count"]) for i, name in enumerate(rows.columns)]
    return literal_rows(t.spark, counts, "column STRING, null_count BIGINT, element_count BIGINT")


LOADED = ("dim_season", "dim_club", "dim_player", "fct_object_award")


def _loaded(t, database):
    """Four tables loaded twice through the batch's loop: first without any award or player, then all."""
    s = standins.sources(t)
    nobody = {name: df.where(F.lit(False)) for name, df in s.items()}
    for source in ({**s, "month_award": nobody["month_award"], "season_award": nobody["season_award"],
                    "player_info": nobody["player_info"]}, s):
        tables = {
            "dim_season": dims.dim_season(source["seasons"]),
            "dim_club": dims.dim_club(source["club_info"], latest=True),
            "dim_player": dims.dim_player(source["player_info"], latest=True),
            "fct_object_award": facts.fct_object_award(source["month_award"], source["season_award"], source["seasons"]),
        }
        load_tables(t.spark, tables, database, standins.LOAD_TIME)


@query(
    "SNK-5 SNK-2 SNK-3 RAM-2 MDL-12",
    f"""
    WITH given AS (SELECT * FROM ({BRIDGE_SQL})),
    stored AS (SELECT count(DISTINCT (award_id, season_id, object_id)) FILTER (WHERE object_id IS NOT NULL)
                      + count(*) FILTER (WHERE object_id IS NULL) AS n FROM given),
    loads AS (
        SELECT 'dim_season' AS "table", (SELECT count(*) FROM {SEASON_IDS_SQL}) AS first, 0 AS later
        UNION ALL SELECT 'dim_club', (SELECT count(*) FROM supplier), 0
        UNION ALL SELECT 'dim_player', 0, (SELECT count(*) FROM ({PLAYER_SQL}))
        UNION ALL SELECT 'fct_object_award', 0, n FROM stored)
    SELECT "table", 'UPDATE' AS operation, TIMESTAMP '2024-01-01 00:00:00' AS ts, first AS rows_inserted, 0::BIGINT AS rows_updated
    FROM loads
    UNION ALL SELECT "table", 'UPDATE', TIMESTAMP '2024-01-01 00:00:00', later, CASE WHEN later = 0 THEN first ELSE 0 END
    FROM loads
    """,
)
def load_loop_audit(t):
    """The audit rows that the load loop appends, two for every table."""
    database = new_database(t.spark, "warehouse")
    _loaded(t, database)
    return read_audit(t.spark, database)


@query(
    "SNK-5 SNK-2 MDL-12",
    f"""
    SELECT DISTINCT * FROM ({BRIDGE_SQL}) WHERE object_id IS NOT NULL
    UNION ALL SELECT * FROM ({BRIDGE_SQL}) WHERE object_id IS NULL
    """,
)
def empty_then_full_load(t):
    """A table by season whose first load had no rows."""
    database = new_database(t.spark, "warehouse")
    _loaded(t, database)
    return t.spark.table(f"{database}.fct_object_award")


def _landed_pages(t):
    """Pages of the sites written and read back: an entry to a listing page, a statistic to a page."""
    root, s = shared_dir(t.spark, "pages"), standins.sources(t)
    pages = {"seasons": s["seasons"]}
    for name in ("player_info", "match_info"):
        columns = [c for c in s[name].columns if c != "season"]
        one = F.struct(*columns)
        pages[name] = s[name].select(F.array(one).alias("content"), "season")
    for name in ("club_stats", "player_stats"):
        pages[name] = s[name].select("entity", F.struct(F.col("stats").alias("content")).alias("stats"), "season")
    pages["match_stats"] = s["match_stats"].withColumnRenamed("stats", "data")
    item = """array(named_struct('awardTypeId', CAST(left(o_orderpriority, 1) AS DOUBLE), 'award', substring(o_orderpriority, 3),
        'player', named_struct('playerId', CAST(o_custkey AS DOUBLE))))"""
    pages["awards"] = t.orders.select(
        F.expr(f"IF(o_orderstatus <> 'P', map(date_format(o_orderdate, 'MMMM'), {item}), NULL)").alias("monthAwards"),
        F.expr(f"IF(o_orderstatus = 'P', {item}, NULL)").alias("seasonAwards"),
        academic_year(F.col("o_orderdate")).alias("season"),
    )
    for name, df in pages.items():
        write_lines(df, f"{root}/raw/{name}")
    landed = {
        name: read_lines(t.spark, f"{root}/raw/{name}", page_ddl(name), many_names=SOURCES[name].many_names) for name in pages
    }
    land_pages(landed, f"{root}/landing")
    back = {}
    for name in ("player_info", "player_stats", "match_info", "match_stats", "month_award", "season_award"):
        source = SOURCES[name]
        back[name] = read_landed(t.spark, f"{root}/landing/{name}", source.ddl, many_names=source.many_names)
    back["seasons"] = t.spark.read.schema(SOURCES["seasons"].ddl).json(f"{root}/landing/seasons")
    return back


@query("ING-1 MDL-7 SNK-1", PLAYER_SQL)
def players_from_pages(t):
    """A dimension that starts from landed listing pages."""
    return dims.dim_player(_landed_pages(t)["player_info"])


@query("ING-2 MDL-11 SNK-1", QUERIES["fct_player_stat"].sql)
def player_facts_from_pages(t):
    """A fact that starts from landed statistics pages."""
    sources = _landed_pages(t)
    return facts.fct_player_stat(sources["player_stats"], sources["seasons"], standins.PLAYER_NAMES)


@query(
    "ING-5 MDL-12",
    f"""
    SELECT CAST(left(o_orderpriority, 1) AS BIGINT) AS award_id, season_id, o_custkey AS object_id
    FROM orders JOIN {SEASON_IDS_SQL} s ON s.season = {season_sql('o_orderdate')}
    """,
)
def awards_from_pages(t):
    """The bridge from combined award documents."""
    sources = _landed_pages(t)
    return facts.fct_object_award(sources["month_award"], sources["season_award"], sources["seasons"])


@query(
    "ING-6 MDL-13",
    f"""
    SELECT l_orderkey AS match_id, l_suppkey AS club_id, s.season_id, max(l_quantity) AS duel_lost
    FROM lineitem JOIN {SEASON_IDS_SQL} s ON s.season = {season_sql('l_shipdate')}
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
    GROUP BY l_orderkey, l_suppkey, s.season_id
    """,
)
def match_facts_from_pages(t):
    """Match documents of the matches in the landed listing."""
    sources = _landed_pages(t)
    return facts.fct_match_stat(sources["match_stats"], sources["seasons"], ["duel_lost"])
