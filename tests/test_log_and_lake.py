import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from peoplelake.schemas import STREAMS, stream_schema
from peoplelake.sources import lake as lk
from peoplelake.sources import log
from peoplelake.streaming.ingest import progress_report, start_ingest, watch

TS = dt.datetime(2026, 5, 1, 10, 30)


def messages(spark, payloads, topic="t"):
    rows = [(f"k{i}".encode(), p.encode(), topic, i % 2, i, TS) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, log.MESSAGE_DDL)


def test_unknown_stream_is_an_error():
    with pytest.raises(ValueError):
        stream_schema("nope")


@pytest.mark.parametrize("stream", ["employees", "attendance", "performance", "recruitment"])
def test_schema_round_trip(spark, stream):
    schema = STREAMS[stream]
    sample = {"string": "x", "double": 1.5, "int": 3, "boolean": True, "date": "2026-05-01",
              "timestamp": "2026-05-01T10:00:00Z"}
    fields = [f.split(" ") for f in schema.ddl.split(", ")]
    payloads = [json.dumps({name: sample[kind] for name, kind in fields}) for _ in range(10)]
    parsed = log.parse_messages(messages(spark, payloads), stream)
    assert parsed.count() == 10
    assert parsed.filter(" OR ".join(f"{c} IS NULL" for c, _ in fields)).count() == 0


def test_parse_is_permissive(spark):
    payloads = ['{"employee_id": 7, "salary": 12.5, "skills": ["a"]}', "{broken", '{"employee_id":"E2","experience":"many"}']
    rows = log.parse_messages(messages(spark, payloads), "employee_csv", F.col("timestamp")).orderBy("offset").collect()
    assert [r["_raw"] for r in rows] == payloads
    assert [r["employee_id"] for r in rows] == ["7", None, "E2"]
    assert rows[0]["salary"] == "12.5" and rows[0]["skills"] == ["a"] and rows[2]["experience"] is None
    assert rows[0]["ingest_date"] == TS.date() and rows[0]["kafka_key"] == "k0"


def test_audit_and_replay(spark):
    payloads = ['{"employee_id":"E%d"}' % i for i in range(6)] + ["x" * 500]
    landed = log.parse_messages(messages(spark, payloads), "employee_csv")
    rows = log.audit(landed, "t", from_offset=2, max_messages=3).collect()
    assert [(r["partition"], r["offset"]) for r in rows] == [(0, 2), (0, 4), (0, 6)]
    assert rows[-1]["is_json"] is False and rows[-1]["payload"] == "x" * 200
    assert log.audit(landed, "t", partition=1, to_offset=4).count() == 2
    again = log.replay(landed, "employee_csv", "t", from_offset=1, to_offset=3)
    assert again.columns == landed.columns
    assert sorted(r["employee_id"] for r in again.collect()) == ["E1", "E2"]


def test_records_keep_nulls_and_split_lists(spark):
    df = spark.createDataFrame([("E1", float("nan"), "a||b", None), (None, 1.0, None, "é")],
                               "employee_id string, experience double, skills string, name string")
    rows = log.to_records(df).collect()
    assert rows[0]["key"] == "E1"
    assert json.loads(rows[0]["value"]) == {"employee_id": "E1", "experience": None, "skills": ["a", "b"], "name": None}
    assert rows[1]["key"] is None and "é" in rows[1]["value"]


def test_stream_restart_neither_loses_nor_repeats(spark, lake, tmp_path):
    source = str(tmp_path / "landing")
    first = [json.dumps({"attendance_id": f"a{i}", "employee_id": "E"}) for i in range(20)]
    messages(spark, first).write.parquet(source)

    def run():
        stream = log.file_stream(spark, source, log.MESSAGE_DDL, max_files_per_trigger=1)
        query = start_ingest(stream, "attendance", lake, ingest_ts=F.col("timestamp"))
        return watch(query)

    report = progress_report(spark, run())
    assert report.agg(F.sum("input_rows")).first()[0] == 20
    run()
    assert spark.read.parquet(lake.bronze("attendance")).count() == 20
    messages(spark, ["{broken", first[0]]).write.mode("append").parquet(source)
    run()
    landed = spark.read.parquet(lake.bronze("attendance"))
    assert landed.count() == 22 and landed.filter("attendance_id IS NULL").count() == 1


def test_incremental_read_prunes_partitions(spark, lake):
    df = spark.createDataFrame([(i, dt.date(2026, 5, 1 + i % 4)) for i in range(40)], "n int, ingest_date date")
    lk.write_table(df, lake.bronze("x"), "ingest_date")
    recent = log.read_since(spark, lake.bronze("x"), "2026-05-03")
    assert recent.count() == 20
    plan = recent._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "ingest_date" in filters and ">=" in filters


def test_partitioned_write_round_trip_and_dynamic_overwrite(spark, lake):
    df = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5), (3, None, 3.5)], "n int, department string, v double")
    path = lake.silver("t")
    lk.write_table(df, path, "department")
    back = lk.read_table(spark, path, like=df)
    assert back.columns == df.columns and sorted(r["n"] for r in back.collect()) == [1, 2, 3]
    only_b = spark.createDataFrame([(9, "b", 0.0)], df.schema)
    lk.write_table(only_b, path, "department", dynamic=True)
    assert sorted(r["n"] for r in lk.read_table(spark, path).collect()) == [1, 3, 9]


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
def test_formats(spark, tmp_path, kind):
    schema = STREAMS["employee_csv"].struct
    rows = [("E1", ' A "q", b ', " HR ", "$1,000", "2020-01-01", 4.5, None, "yes", "in\ndia", ["a", "b"], 2.0),
            ("E2", None, None, None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    lk.write_format(df, str(tmp_path / kind), kind)
    if kind == "csv":
        df = df.withColumn("country", F.lit(None).cast("string"))
        lk.write_format(df, str(tmp_path / "csv1"), kind)
        back = lk.read_format(spark, str(tmp_path / "csv1"), kind, schema)
    else:
        back = lk.read_format(spark, str(tmp_path / kind), kind, schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
