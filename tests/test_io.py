import helpers as h
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripweave import model, session
from tripweave.operators import changes, documents, quality, relational
from tripweave.sources import tables


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_tables_survive_a_round_trip(small, spark, tmp_path, fmt):
    kept = {"users": small["users"], "stations": small["stations"], "trips": small["trips"], "events": small["events"]}
    tables.save_tables(kept, str(tmp_path), fmt)
    loaded = tables.load_tables(spark, str(tmp_path), fmt)
    for name, df in kept.items():
        assert [f.dataType for f in loaded[name].schema] == [f.dataType for f in model.SCHEMAS[name]]
        assert h.rows(loaded[name].select(df.columns)) == h.rows(df)


def test_documents_survive_a_round_trip(small, spark, tmp_path):
    docs = documents.embed_events(small["trips"], small["events"])
    for fmt in ("parquet", "json"):
        path = str(tmp_path / fmt)
        tables.write_table(docs, path, fmt)
        back = tables.read_table(spark, path, model.TRIP_DOCUMENT, fmt)
        assert h.rows(documents.unwind_events(back)) == h.rows(documents.unwind_events(docs))
        assert h.rows(documents.trips_with_embedded_event(back)) == h.rows(documents.trips_with_embedded_event(docs))


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_stored_parts_answer_like_whole_documents(small, spark, tmp_path, fmt):
    whole = documents.embed_events(small["trips"], small["events"])
    cut = documents.embed_events(small["trips"], small["events"], part_rows=2)
    tables.write_table(cut, str(tmp_path / "cut"), fmt)
    back = tables.read_table(spark, str(tmp_path / "cut"), model.TRIP_DOCUMENT, fmt)
    assert back.count() > whole.count()
    asked = [
        documents.trips_with_embedded_event,
        documents.facet_station_roles,
        documents.unwind_events,
        changes.modified_count,
        lambda docs: documents.trip_documents_report(docs, small["users"], small["stations"]),
        lambda docs: quality.check_documents(docs, small["users"], small["stations"]),
        lambda docs: quality.check_document_types(documents.documents_as_json(docs.drop("user_id").withColumn("user_id", F.lit("x"))), "text", model.TRIP_DOCUMENT, "trips"),
    ]
    for question in asked:
        assert h.rows(question(back)) == h.rows(question(whole))


def test_documents_without_part_fields_are_refused(small):
    docs = documents.embed_events(small["trips"], small["events"]).drop("part", "parts")
    for question in (documents.trips_with_embedded_event, documents.facet_station_roles):
        with pytest.raises(ValueError, match="part"):
            question(docs)


def test_first_version_documents_read_with_the_second_schema(small, spark, tmp_path):
    docs = documents.embed_events(small["trips"], small["events"])
    tables.write_table(docs, str(tmp_path / "v1"))
    back = tables.read_table(spark, str(tmp_path / "v1"), model.TRIP_DOCUMENT_V2)
    levels = documents.unwind_events(back).select("battery_level").distinct().collect()
    assert [r[0] for r in levels] == [None]


def test_append_and_overwrite(small, tmp_path, spark):
    path, schema = str(tmp_path / "stations"), model.STATIONS
    places = small["stations"]
    tables.write_table(places, path)
    with pytest.raises(PySparkException):
        tables.write_table(places, path)
    tables.write_table(places, path, mode="append")
    assert tables.read_table(spark, path, schema).count() == 20
    tables.write_table(places, path, mode="overwrite")
    assert tables.read_table(spark, path, schema).count() == 10


def test_empty_json_keeps_its_columns(spark, tmp_path):
    (tmp_path / "trips").mkdir()
    (tmp_path / "trips" / "empty.json").write_text("")
    empty = tables.read_table(spark, str(tmp_path / "trips"), model.TRIPS, "json")
    assert relational.active_user_stats(empty).collect() == []


def test_sorted_layout(spark, small, tmp_path):
    tables.save_tables({"trips": small["trips"]}, str(tmp_path), sort_by={"trips": ["trip_id"]})
    back = tables.read_table(spark, str(tmp_path / "trips"), model.TRIPS)
    assert h.rows(back) == h.rows(small["trips"].select(back.columns))


def test_csv_has_a_header(spark, small, tmp_path):
    tables.write_table(small["stations"].coalesce(1), str(tmp_path / "s"), "csv")
    first = next((tmp_path / "s").glob("*.csv")).read_text().splitlines()[0]
    assert first == "station_id,name,city,capacity"


class _Settings(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


class _Session:
    def __init__(self, master, checkpoints=None, **settings):
        self.conf = _Settings(settings)
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda _: checkpoints})()


def test_the_shared_folder_is_the_one_the_cluster_names():
    assert session.shared_folder(_Session("yarn", **{"spark.checkpoint.dir": "hdfs:///c/"})) == "hdfs:///c"
    assert session.shared_folder(_Session("yarn", "hdfs:///d")) == "hdfs:///d"
    with pytest.raises(ValueError):
        session.shared_folder(_Session("yarn"))
    local = _Session("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)
    assert session.fresh_folder(local, "x") != session.fresh_folder(local, "x")
