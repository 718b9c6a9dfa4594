import datetime as dt

import pytest
from pyspark.errors import PySparkException

from brightwell.operators import relational as rel
from brightwell.sinks import files as out
from brightwell.sources import files, jdbc, streams
from tests.conftest import rows

FLIGHT = "FL_DATE DATE, CARRIER STRING NOT NULL, DISTANCE INT"


@pytest.fixture()
def flights(tmp_path):
    path = tmp_path / "flights.csv"
    path.write_text('FL_DATE,CARRIER,DISTANCE\n1/2/2020,DL,500\n3/14/2020,"A ""A""",700\nnot a date,UA,900\n4/5/2020,ÜA,x\n',
                    encoding="utf-8")
    return str(path)


def test_survey_counts_by_country(spark, tmp_path):
    people = [(37, "United States"), (44, "United States"), (32, "Canada"), (31, "United Kingdom"),
              (31, "United States"), (33, "United States"), (35, "United States"), (39, "Canada"), (42, "Canada")]
    path = tmp_path / "survey.csv"
    path.write_text("Age,Country,state\n" + "".join(f"{a},{c},NA\n" for a, c in people))
    survey = files.read_csv(spark, str(path), null_value="NA", policy="PERMISSIVE")
    assert dict(survey.dtypes)["Age"] == "int"
    assert survey.where("state IS NOT NULL").count() == 0
    counts = survey.where("Age < 40").groupBy("Country").count()
    assert rows(counts) == [("Canada", 2), ("United Kingdom", 1), ("United States", 4)]


def test_explicit_schema_and_failfast(spark, flights):
    df = files.read_csv(spark, flights, FLIGHT, dateFormat="M/d/y", escape='"', encoding="UTF-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        df.collect()


def test_drop_malformed(spark, flights):
    df = files.read_csv(spark, flights, FLIGHT, policy="DROPMALFORMED", dateFormat="M/d/y", escape='"')
    assert rows(df, "CARRIER", "DISTANCE") == [('A "A"', 700), ("DL", 500)]


def test_corrupt_rows_are_kept_apart(spark, flights):
    checked = files.read_csv_checked(spark, flights, FLIGHT, dateFormat="M/d/y", escape='"')
    assert checked.good.count() == 2
    assert rows(checked.corrupt, "_corrupt_record") == [("4/5/2020,ÜA,x",), ("not a date,UA,900",)]
    assert checked.good.columns == ["FL_DATE", "CARRIER", "DISTANCE"]


def test_json_and_text(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('{"FL_DATE": "2020-01-02", "CARRIER": "DL", "DISTANCE": 5}\n{"CARRIER": "UA"}\n')
    assert rows(files.read_json(spark, str(path), FLIGHT), "CARRIER", "DISTANCE") == [("DL", 5), ("UA", None)]
    assert files.read_text(spark, str(path)).count() == 2


def test_parquet_schema_evolution(spark, tmp_path):
    old = spark.createDataFrame([("DL", 1)], "carrier STRING, n INT")
    new = spark.createDataFrame([("UA", 2, "A320")], "carrier STRING, n INT, aircraft STRING")
    base = str(tmp_path / "t")
    out.write_parquet(old, base + "/a")
    out.write_parquet(new, base + "/b")
    merged = files.read_parquet(spark, base + "/a", base + "/b", merge_schema=True)
    assert rows(merged) == rows(files.evolve(old, new)) == [("DL", 1, None), ("UA", 2, "A320")]
    assert files.read_parquet(spark, base + "/b", name_filter="*.parquet").count() == 1


def test_schema_tools(spark):
    described = files.describe_schema(FLIGHT)
    assert described[1][:3] == ("CARRIER", "string", False)
    assert files.required(FLIGHT) == ["CARRIER"]
    none = files.empty(spark, FLIGHT)
    assert none.count() == 0 and none.columns == ["FL_DATE", "CARRIER", "DISTANCE"]


def test_range_rows(spark):
    df = files.with_range_category(files.number_range(spark, 1, 9, 3)).withColumn(
        "score", rel.with_random(spark.range(1), "s").select("s").scalar())
    assert rows(df.groupBy("category").count()) == [("Basic", 3), ("Premium", 3), ("Standard", 3)]
    weighted = df.select(files.adjusted_score().alias("a"), "score", "category").where("category = 'Premium'").first()
    assert weighted["a"] == pytest.approx(weighted["score"] * 1.5)


def test_csv_round_trip_and_modes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "k INT, v STRING")
    path = str(tmp_path / "csv")
    out.write_csv(df, path)
    assert rows(files.read_csv(spark, path, "k INT, v STRING")) == [(1, "a,b"), (2, None)]
    out.write_csv(df, path, mode="append")
    assert files.read_csv(spark, path, "k INT, v STRING").count() == 4
    out.write_csv(df.limit(0), path, mode="ignore")
    assert files.read_csv(spark, path, "k INT, v STRING").count() == 4
    with pytest.raises(PySparkException):
        out.write_csv(df, path, mode="error")
    out.write_csv(df, path, mode="overwrite")
    assert files.read_csv(spark, path, "k INT, v STRING").count() == 2


def test_json_partitioned_with_small_files(spark, tmp_path):
    df = spark.range(0, 20, 1, 1).selectExpr("id", "CASE WHEN id < 12 THEN 'x' ELSE 'y' END AS origin")
    path = tmp_path / "json"
    out.write_json(df, str(path), partition_by=["origin"], max_records_per_file=5)
    assert len(list((path / "origin=x").glob("*.json"))) == 3
    back = files.read_json(spark, str(path), "id LONG, origin STRING")
    assert back.where("origin = 'y'").count() == 8


def test_parquet_partition_pruning(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 4 AS part")
    out.write_parquet(df, str(tmp_path / "p"), partition_by=["part"])
    pruned = files.read_parquet(spark, str(tmp_path / "p")).where("part = 2")
    assert len(pruned.inputFiles()) > 0 and pruned.count() == 25
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_jdbc_options_hide_the_password():
    connection = jdbc.Connection("jdbc:mysql://db/todos", "com.mysql.cj.jdbc.Driver", "app", "secret",
                                 session_init="SET time_zone = '+00:00'")
    options = connection.options()
    assert options["fetchsize"] == "1000" and options["batchsize"] == "1000"
    assert options["isolationLevel"] == "READ_COMMITTED"
    assert options["sessionInitStatement"].startswith("SET time_zone")
    assert "secret" not in repr(connection)


def test_kafka_reader_options():
    options = streams.kafka_options("host:9092", "transactions", max_offsets=1000, min_partitions=64)
    assert options == {"kafka.bootstrap.servers": "host:9092", "subscribe": "transactions",
                       "startingOffsets": "latest", "failOnDataLoss": "false",
                       "maxOffsetsPerTrigger": "1000", "minPartitions": "64"}


def test_rows_from_local_data(spark):
    from pyspark.sql import Row
    people = spark.createDataFrame([Row(name="Mia", born=dt.date(2003, 2, 3)), Row(name="Omar", born=None)])
    assert people.toDF("n", "b").columns == ["n", "b"]
    assert people.where("born IS NULL").count() == 1
