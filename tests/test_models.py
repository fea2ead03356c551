"""The 13 tables from landed documents, edge case by edge case."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sportmart.operators.quality import QualityError
from sportmart.operators.pages import award_rows, related_references
from sportmart.plans import dims, facts
from sportmart.plans.load import TARGETS, build_tables, check_sources, check_tables, load_tables, read_audit, run, table_columns
from sportmart.schemas import SOURCES, TABLES
from sportmart.sources.documents import extract, read_entity
from sportmart.session import new_database
from tests import fixtures


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    fixtures.land(root)
    return root


@pytest.fixture(scope="module")
def sources(spark, landing):
    return extract(spark, landing)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


NAMES = (["losses", "wins"], ["GOALS", "SAVES", "FOULS"], ["duel_lost", "fk_foul_lost", "formation_used"])


def test_empty_file_has_all_columns(spark, landing):
    df = read_entity(spark, landing, "match_info", seasons=["2022-23"])
    assert df.count() == 0
    assert df.columns == [
        "id", "teams", "kickoff", "attendance", "gameweek", "clock", "ground", "season",
    ]


def test_season_comes_from_the_path(sources):
    assert rows(sources["club_info"], "season", "name") == [
        ("2022-23", "Old Club 1"), ("2023-24", "Club 1"), ("2023-24", "Club 2"), ("2023-24", "Club 3"),
    ]


def test_listed_seasons_only(spark, landing):
    df = read_entity(spark, landing, "club_info", seasons=["2022-23"])
    assert rows(df, "name") == [("Old Club 1",)]


def test_missing_source(spark, landing):
    from pyspark.errors import AnalysisException

    absent = read_entity(spark, landing + "/nowhere", "month_award", optional=True)
    assert absent.count() == 0 and absent.columns == ["awards", "season"]
    with pytest.raises(AnalysisException):
        read_entity(spark, landing + "/nowhere", "month_award")


def test_corrupt_document_is_kept_as_text(spark, tmp_path):
    path = tmp_path / "club" / "2023-24"
    path.mkdir(parents=True)
    (path / "club_info.json").write_text('[{"id": 1.0, "name": ')
    df = read_entity(spark, str(tmp_path), "club_info", corrupt_column="_corrupt")
    assert [r["_corrupt"] is not None for r in df.collect()] == [True]


def test_dim_season(sources):
    assert rows(dims.dim_season(sources["seasons"])) == [(489, "2022-23"), (578, "2023-24")]


def test_dim_country_is_one_row_without_nulls(sources):
    df = dims.dim_country(sources["manager_info"], sources["player_info"])
    assert rows(df) == [("GB-ENG", "England", "English")]


def test_dim_manager_needs_a_birth_date(sources):
    assert rows(dims.dim_manager(sources["manager_info"]), "manager_id", "dob", "country_id") == [
        (10, dt.date(1980, 6, 2), None), (7, dt.date(1970, 3, 31), "GB-ENG"), (8, dt.date(1975, 5, 1), "ES"),
    ]


def test_dim_club_keeps_a_renamed_club_twice_or_latest(sources):
    assert rows(dims.dim_club(sources["club_info"]).where("club_id = 1"), "name") == [("Club 1",), ("Old Club 1",)]
    latest = dims.dim_club(sources["club_info"], latest=True)
    assert rows(latest, "club_id", "name") == [(1, "Club 1"), (2, "Club 2"), (3, "Club 3")]


def test_dim_stadium_without_grounds(sources):
    assert rows(dims.dim_stadium(sources["club_info"]), "stadium_id", "latitude") == [(10, 51.5), (11, 51.5)]


def test_dim_position(sources):
    assert rows(dims.dim_position(sources["player_info"])) == [
        ("CDM", "Central Defender/Midfielder"), ("M", "Midfielder"),
    ]


def test_dim_player(sources):
    assert rows(dims.dim_player(sources["player_info"]), "player_id", "dob", "shirt_num", "country_id", "position_id") == [
        (338798, dt.date(1998, 3, 31), 4, "GB-ENG", "CDM"), (4, dt.date(1999, 5, 2), None, None, "M"),
    ]


def test_dim_player_combines_entries_of_one_id(spark):
    ddl = SOURCES["player_info"].ddl + ", season STRING"
    entry = lambda info, country, dob: (
        1.0, info, country, ("F", "L"), ((dob,),), "2023-24"
    )
    df = spark.createDataFrame(
        [
            entry(("D", 4.0, "Defender"), None, None),
            entry(None, ("ES", "Spain", "Spanish"), "1 May 1999"),
            entry(None, ("ES", "Spain", "Spanish"), "1 May 1999"),
        ],
        ddl,
    )
    got = rows(dims.dim_player(df), "player_id", "country_id", "position_id")
    assert got == [(1, "ES", "D"), (1, None, "D")]


def test_dim_award_keeps_names_and_types_apart(sources):
    assert rows(dims.dim_award(sources["month_award"], sources["season_award"])) == [
        (1, "EA Player of the Month", "month"), (1, "Player of the Month", "month"),
        (2, "Manager of the Month", "month"), (3, "Champions", "season"), (4, "Golden Boot", "season"),
    ]


def test_dim_match(sources):
    df = dims.dim_match(sources["match_info"])
    assert df.columns == [name for name, _ in TABLES["dim_match"]]
    got = rows(df, "match_id", "date_played", "time", "match_length_min", "away_team_id", "away_team_final_score", "attendance")
    d = Decimal
    assert got == [
        (75281, dt.date(2023, 8, 12), "21:00", d(95), 38, d(1), d(101)),
        (75291, dt.date(2022, 12, 27), "03:00", d(45), None, None, d(101)),
        (75301, dt.date(2023, 10, 29), "08:30", None, 2, d(0), d(101)),
        (75311, None, None, None, 2, d(0), d(101)),
    ]


def test_fct_club_stat(sources):
    df = facts.fct_club_stat(sources["club_stats"], sources["manager_info"], sources["seasons"], NAMES[0])
    assert df.columns == ["club_id", "manager_id", "stadium_id", "season_id", "losses", "wins"]
    assert rows(df) == [
        (1, 7, 10, 578, None, 7.0), (1, 7, 11, 578, None, 7.0),
        (1, 8, 10, 578, None, 7.0), (1, 8, 11, 578, None, 7.0),
        (2, 9, 20, 578, 4.0, None),
    ]


def test_fct_player_stat(sources):
    df = facts.fct_player_stat(sources["player_stats"], sources["seasons"], NAMES[1])
    assert rows(df) == [
        (4, 1, 578, 5.0, 6.0, None), (4, 2, 578, 5.0, 6.0, None), (5, None, 578, 1.0, None, None),
        (6, 1, 578, None, None, None),
    ]


def test_fct_object_award(sources):
    s = sources
    awards = dims.dim_award(s["month_award"], s["season_award"])
    expected = [(1, 578, 4), (1, 578, 4), (2, 578, 7), (3, 578, 1), (4, 578, 338798)]
    assert rows(facts.fct_object_award(s["month_award"], s["season_award"], s["seasons"])) == expected
    assert rows(facts.fct_object_award(s["month_award"], s["season_award"], s["seasons"], awards)) == expected
    fanned = facts.fct_object_award(s["month_award"], s["season_award"], s["seasons"], awards, fan_out=True)
    assert rows(fanned) == sorted(expected + [(1, 578, 4), (1, 578, 4)], key=repr)


def test_award_references(sources):
    month = related_references(award_rows(sources["month_award"]), "award_month.relatedContent", "PROMO")
    assert rows(month) == [("p1",)]
    assert rows(related_references(sources["season_award"], "relatedContent")) == [("p1",), ("t1",)]


def test_fct_match_stat_golden(sources):
    df = facts.fct_match_stat(sources["match_stats"], sources["seasons"], NAMES[2])
    assert df.columns == ["match_id", "club_id", "season_id", *NAMES[2]]
    assert rows(df) == [
        (75281, 1, 578, 45.0, 8.0, 433.0), (75281, 38, 578, 35.0, 9.0, 433.0),
        (75291, 1, 578, 15.0, 2.0, 433.0), (75291, 38, 578, 25.0, 11.0, 442.0),
    ]


def test_suites(sources):
    with pytest.warns(UserWarning, match="club_info: not_null grounds"):
        results = check_sources(sources)
    failed = {(r["dataset"], r["column"]) for r in results.where("NOT passed").collect()}
    assert failed == {("club_info", "grounds")}
    tables = build_tables(sources, *NAMES)
    columns = {name: table_columns(name, *NAMES) for name in tables}
    assert check_tables(tables, columns).where("NOT passed").count() == 0


def test_whole_batch_twice(spark, landing):
    warehouse = new_database(spark, "batch")
    now = dt.datetime(2024, 1, 1)
    with pytest.warns(UserWarning):
        first = run(spark, landing, warehouse, *NAMES, now=now)
    assert set(TARGETS) == {r["table"] for r in first.collect()}
    assert all(r["rows_updated"] == 0 for r in first.collect())
    before = {name: rows(spark.table(f"{warehouse}.{name}")) for name in TARGETS}
    with pytest.warns(UserWarning):
        second = run(spark, landing, warehouse, *NAMES, now=now + dt.timedelta(days=7))
    again = {r["table"]: r for r in second.collect() if r["ts"] > now}
    assert all(r["rows_inserted"] == 0 for r in again.values())
    assert {name: rows(spark.table(f"{warehouse}.{name}")) for name in TARGETS} == before
    assert before["dim_club"] and before["fct_match_stat"]


@pytest.mark.filterwarnings("ignore:failed check")
def test_batch_twice_after_a_season_without_facts(spark, tmp_path):
    root, warehouse = str(tmp_path / "landing"), new_database(spark, "batch")
    fixtures.land(root)
    empty = {
        "club/{s}/club_stats.json": [], "player/{s}/player_stats.json": [], "award/{s}/month/award.json": {},
        "award/{s}/season/award.json": [], "match/{s}/match_stats.json": [],
    }
    for path, body in empty.items():
        (tmp_path / "landing" / path.format(s="2023-24")).write_text(json.dumps(body))
    for _ in range(2):
        run(spark, root, warehouse, *NAMES)
    facts_ = [name for name in TARGETS if name.startswith("fct")]
    assert all(spark.table(f"{warehouse}.{name}").count() == 0 for name in facts_)
    fixtures.land(root)
    run(spark, root, warehouse, *NAMES)
    assert all(spark.table(f"{warehouse}.{name}").count() for name in facts_)


@pytest.mark.filterwarnings("ignore:failed check")
def test_drift_stops_the_batch_before_any_table_changes(spark, tmp_path):
    root, warehouse = str(tmp_path / "landing"), new_database(spark, "batch")
    fixtures.land(root)
    run(spark, root, warehouse, *NAMES)
    before = {name: sorted(spark.table(f"{warehouse}.{name}").inputFiles()) for name in TARGETS}
    with pytest.raises(QualityError, match="fct_club_stat: column_set"):
        run(spark, root, warehouse, [*NAMES[0], "draws"], *NAMES[1:])
    tables = build_tables(extract(spark, root), *NAMES, latest=True)
    tables["dim_award"] = tables["dim_award"].withColumn("award_id", F.col("award_id").cast("int"))
    with pytest.raises(QualityError, match="dim_award: column_type award_id int for bigint"):
        load_tables(spark, tables, warehouse)
    assert {name: sorted(spark.table(f"{warehouse}.{name}").inputFiles()) for name in TARGETS} == before
    assert read_audit(spark, warehouse).count() == len(TARGETS)


@pytest.mark.filterwarnings("ignore:failed check")
def test_an_absent_source_can_be_optional(spark, tmp_path):
    root = tmp_path / "landing"
    fixtures.land(str(root))
    for path in root.glob("club/*/club_stats.json"):
        path.unlink()
    warehouse = new_database(spark, "batch")
    run(spark, str(root), warehouse, *NAMES, optional=["club_stats"])
    assert spark.table(f"{warehouse}.fct_club_stat").count() == 0


def test_clubs_without_id_do_not_multiply(spark):
    ddl = SOURCES["club_info"].ddl + ", season STRING"
    twice = [(None, "Nobody", None, None, season) for season in ("2022-23", "2023-24")]
    df = spark.createDataFrame(twice, ddl)
    assert dims.dim_club(df, latest=True).count() == dims.dim_club(df).count() == 1


def test_a_month_document_that_does_not_parse_is_kept(spark, tmp_path):
    path = tmp_path / "award" / "2023-24" / "month"
    path.mkdir(parents=True)
    (path / "award.json").write_text('{"August": [{"award": ')
    (got,) = read_entity(spark, str(tmp_path), "month_award", corrupt_column="_corrupt").collect()
    assert got["awards"] is None and got["_corrupt"].startswith('{"August"') and got["season"] == "2023-24"
