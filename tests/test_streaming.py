"""Files that land between two runs of the incremental load."""

import json

from sportmart.plans import dims
from sportmart.plans.load import TARGETS
from sportmart.schemas import SOURCES
from sportmart.session import new_database
from sportmart.streaming.incremental import BATCH, stream_upsert, upsert_batch
from tests import fixtures


def test_only_new_files_are_processed(spark, tmp_path):
    landing, checkpoint = (str(tmp_path / name) for name in ("landing", "checkpoint"))
    table = f"{new_database(spark, 'stream')}.dim_club"
    (tmp_path / "landing").mkdir()
    spec = TARGETS["dim_club"]
    batches = []

    def build(batch):
        batches.append(batch.count())
        return dims.dim_club(batch, latest=True)

    def land(name, clubs, season):
        lines = [json.dumps({**club, "season": season}) for club in clubs]
        (tmp_path / "landing" / name).write_text("\n".join(lines))

    def load():
        stream_upsert(
            spark, landing, SOURCES["club_info"].ddl + ", season STRING", table, checkpoint,
            keys=["club_id"], update_cols=["name", "short_name", "abbr"], build=build, file_format="json",
        )
        return sorted((r["club_id"], r["name"]) for r in spark.table(table).collect())

    assert spec.keys(["club_id", "name"]) == ["club_id"]
    land("a.json", fixtures.CLUB_INFO, "2022-23")
    assert load() == [(1, "Club 1"), (2, "Club 2"), (3, "Club 3")]
    land("b.json", [{**fixtures.club(1), "name": "New Club 1"}, fixtures.club(4)], "2023-24")
    assert load() == [(1, "New Club 1"), (2, "Club 2"), (3, "Club 3"), (4, "Club 4")]
    assert load()[0] == (1, "New Club 1")
    assert batches == [3, 2]


def test_a_batch_that_comes_twice_counts_once(spark):
    """Also rows with a null key part, which no key can tell from those of other batches; by partition and without."""
    ddl = "id BIGINT, season STRING, v INT"
    first = spark.createDataFrame([(1, "a", 1), (None, "a", 2), (None, "a", 2), (4, None, 3), (None, None, 3)], ddl)
    second = spark.createDataFrame([(1, "a", 5), (None, "a", 2), (None, "b", 6)], ddl)
    for by in ("season", None):
        table = f"{new_database(spark, 'twice')}.t"

        def put(rows, batch):
            return upsert_batch(rows, table, batch, ["id", "season"], ["v"], by)  # noqa: B023

        def stored():
            return sorted((tuple(r) for r in spark.table(table).select("id", "season", "v").collect()), key=repr)  # noqa: B023

        put(first, "s/0")
        once = stored()
        assert len(once) == 5
        assert put(first, "s/0") == (0, 1) and stored() == once
        put(second, "s/1")
        both = stored()
        assert len(both) == 7 and (1, "a", 5) in both
        assert put(second, "s/1") == (0, 1) and stored() == both
        # The same rows in another batch are other rows, as are those of another stream.
        assert put(second, "t/1") == (2, 1) and len(stored()) == 9
        assert spark.table(table).where(f"{BATCH} = 't/1'").count() == 3


def test_a_batch_that_stopped_between_partitions(spark):
    """Some partitions have the batch already, others not."""
    ddl = "id BIGINT, season STRING, v INT"
    rows = spark.createDataFrame([(None, "a", 1), (None, "b", 2), (7, "a", 3), (7, "b", 4)], ddl)
    table = f"{new_database(spark, 'stopped')}.t"
    upsert_batch(rows.where("season = 'a'"), table, "s/0", ["id", "season"], ["v"], "season")
    upsert_batch(rows, table, "s/0", ["id", "season"], ["v"], "season")
    got = sorted((tuple(r) for r in spark.table(table).select("id", "season", "v").collect()), key=repr)
    assert got == sorted((tuple(r) for r in rows.collect()), key=repr)
