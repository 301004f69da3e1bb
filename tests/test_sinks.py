"""Sinks, sources with side effects, record formats and partitioning."""

import pytest
from pyspark.sql import functions as F

from tidewater.functions import records
from tidewater.operators import partitioning
from tidewater.sinks import basic as sinks
from tidewater.sources import basic as sources

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _derby(spark, tmpdir_path):
    """Embedded file database: runs inside the JVM, no server and no port."""
    url = f"jdbc:derby:{tmpdir_path}/db;create=true"
    ddl = "CREATE TABLE t_student (id INT GENERATED ALWAYS AS IDENTITY, name VARCHAR(64), age INT)"
    (spark.read.format("jdbc").option("url", url).option("driver", DERBY["driver"])
     .option("sessionInitStatement", ddl).option("query", "SELECT 1 AS x FROM SYSIBM.SYSDUMMY1").load().collect())
    return url


def test_jdbc_append_generated_ids_and_snapshots(spark, tmpdir_path):
    url = _derby(spark, tmpdir_path)
    students = sources.inline(spark, [("tony", 18), ("tony2", 18)], "name string, age int")
    sinks.jdbc_append(students, url, "t_student", DERBY)
    rows = sources.jdbc_table(spark, url, "select id, name, age from t_student", DERBY).collect()
    assert sorted(r.ID for r in rows) == [1, 2]
    assert sorted(r.NAME for r in rows) == ["tony", "tony2"]
    parallel = sources.jdbc_table(spark, url, "select id, name, age from t_student", DERBY,
                                  partition_column="id", bounds=(1, 3), num_partitions=2)
    assert parallel.rdd.getNumPartitions() == 2 and parallel.count() == 2
    # polling source: every poll re-emits the whole table
    _, snapshot = sources.jdbc_snapshots(spark, url, "select id, name, age from t_student", props=DERBY)
    assert snapshot(None, 0).count() == 2
    sinks.jdbc_append(students.limit(1), url, "t_student", DERBY)
    assert snapshot(None, 1).count() == 3


def test_text_tuples_and_rolling_files(spark, tmpdir_path):
    df = sources.inline(spark, [("hello", 2), ("world", 1)], "word string, n long")
    sinks.write_tuples(df, ["word", "n"], f"{tmpdir_path}/t", files=2)
    assert sorted(r.value for r in sources.text(spark, f"{tmpdir_path}/t").collect()) == ["(hello,2)", "(world,1)"]
    ev = sources.inline(spark, [(1, "2024-01-01 10:00:00"), (2, "2024-01-02 11:30:00")], "id int, t string") \
        .withColumn("ts", F.to_timestamp("t"))
    sinks.write_rolling(ev, F.col("id").cast("string"), sinks.bucket_hourly("ts"), f"{tmpdir_path}/r",
                        max_records_per_file=1)
    got = sorted(map(tuple, sinks.read_rolling(spark, f"{tmpdir_path}/r").collect()))
    assert got == [("1", "2024-01-01--10"), ("2", "2024-01-02--11")]


def test_kafka_frame_round_trip(spark):
    df = sources.inline(spark, [(1, "success", 7), (2, "fail", 8)], "user_id long, status string, page_id long")
    frame = records.as_consumed(records.kafka_frame(df, F.col("user_id"), records.row_json(df), "t"))
    assert set(frame.columns) == set(records.KAFKA_SCHEMA.fieldNames())
    back = records.decode_value(frame, "page_id long, status string, user_id long")
    assert sorted(map(tuple, back.select("user_id", "status", "page_id").collect())) == \
        [(1, "success", 7), (2, "fail", 8)]
    assert records.row_json(df).__class__.__name__ == "Column"
    first = frame.select(F.col("value").cast("string")).orderBy("value").first()[0]
    assert first == '{"page_id":7,"status":"success","user_id":1}'  # fields sorted by name


def test_parse_csv_strict_and_lenient(spark):
    lines = sources.inline(spark, [("s1,3",), ("s2,x",)], "value string")
    lenient = lines.select(*records.parse_csv("value", [("id", "string"), ("count", "int")], strict=False))
    assert sorted((r["id"], r["count"]) for r in lenient.collect()) == [("s1", 3), ("s2", None)]
    with pytest.raises(Exception):
        lines.select(*records.parse_csv("value", [("id", "string"), ("count", "int")])).collect()


def test_partitioning_modes(spark):
    df = spark.range(100)
    assert partitioning.to_global(df).rdd.getNumPartitions() == 1
    rep = partitioning.replicate(df, 4)
    assert rep.count() == 400
    per_task = partitioning.with_task_id(rep).groupBy("partition").count().collect()
    assert sorted(r["count"] for r in per_task) == [100, 100, 100, 100]
    custom = partitioning.with_task_id(partitioning.custom(df, 4, F.lit(0)))
    assert {r.partition for r in custom.collect()} == {0}
    assert partitioning.rescale(df.repartition(8), 2).rdd.getNumPartitions() == 2
    assert partitioning.shuffle(df, 4).count() == 100


def test_catalog_self_append(spark, tmpdir_path):
    df = sources.inline(spark, [(1, "a"), (2, "b")], "id int, name string")
    sinks.create_table(df, "tw_person_test", f"{tmpdir_path}/person")
    sinks.insert_select(spark, "tw_person_test", "SELECT * FROM tw_person_test")
    spark.catalog.refreshTable("tw_person_test")
    assert sources.catalog_table(spark, "tw_person_test").count() == 4
    spark.sql("DROP TABLE tw_person_test")


def test_poll_jdbc_reemits_full_table(spark, tmpdir_path):
    from tidewater.streaming.recovery import IdempotentBatchSink
    url = _derby(spark, tmpdir_path)
    sinks.jdbc_append(sources.inline(spark, [("tony", 18), ("tony2", 18)], "name string, age int"),
                      url, "t_student", DERBY)
    sink = IdempotentBatchSink(f"{tmpdir_path}/polls")
    q = sources.poll_jdbc(spark, url, "select id, name, age from t_student", sink, f"{tmpdir_path}/ck",
                          interval="300 milliseconds", props=DERBY)
    try:
        q.awaitTermination(3)
    finally:
        q.stop()
    polls = sink.read(spark).groupBy("poll").count().collect()
    assert len(polls) >= 2 and all(r["count"] == 2 for r in polls)


def test_remote_lookup_bounded_batches_and_default(spark):
    import time
    from tidewater.operators.lookup import remote_lookup
    names = {1: "服装", 2: "图书", 3: "家电"}

    def fetch(keys):
        if 5 in keys:
            time.sleep(2)  # this batch times out
        return {k: names[k] for k in keys if k in names}

    facts = spark.createDataFrame([(i % 6,) for i in range(60)], "cid long")
    got = remote_lookup(facts.where("cid != 5"), "cid", fetch, "name", batch_size=2, max_in_flight=3)
    assert {(r.cid, r.name) for r in got.collect()} == {(0, "未知"), (1, "服装"), (2, "图书"), (3, "家电"), (4, "未知")}
    slow = remote_lookup(facts.where("cid = 5"), "cid", fetch, "name", timeout=0.2, on_missing="null")
    assert {r.name for r in slow.collect()} == {None}


def test_print_and_console_sinks(spark, tmpdir_path, capsys):
    df = sources.inline(spark, [("hello", 1)], "word string, n long")
    sinks.print_rows(df, label="wc")
    out = capsys.readouterr().out
    assert "wc" in out and "hello" in out
    src = f"{tmpdir_path}/in"
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = sinks.console_stream(stream, label="wc").option("checkpointLocation", f"{tmpdir_path}/ck") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.lastProgress["numInputRows"] == 1


def test_job_config_checkpoint_from_argument(spark, tmpdir_path):
    """The checkpoint location is a job argument; a second run resumes from it."""
    from tidewater.streaming.recovery import IdempotentBatchSink, JobConfig
    src, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/ck"
    sources.inline(spark, [(1,)], "x long").write.parquet(f"{src}/a")
    sink = IdempotentBatchSink(f"{tmpdir_path}/out")
    for _ in range(2):
        cfg = JobConfig(checkpoint_location=ck, available_now=True)
        cfg.apply(spark.readStream.schema("x long").parquet(f"{src}/*").writeStream.foreachBatch(sink)) \
            .start().awaitTermination()
    assert sink.read(spark).count() == 1  # the second run found nothing new to process


def test_kafka_options():
    read = records.kafka_reader_options("b:9092", "in", "earliest", group="g")
    assert read == {"kafka.bootstrap.servers": "b:9092", "subscribe": "in", "startingOffsets": "earliest", "kafka.group.id": "g"}
    assert "kafka.group.id" not in records.kafka_reader_options("b:9092", "in")
    assert records.kafka_writer_options("b:9092", "out") == {"kafka.bootstrap.servers": "b:9092", "topic": "out"}


def test_append_only_plans_only_add(spark):
    from tidewater.operators import changelog
    assert sorted(map(tuple, changelog.append_only(spark.range(2)).collect())) == [(True, 0), (True, 1)]


def test_row_writer_opens_writes_and_closes(spark, tmpdir_path):
    import os
    from tidewater.streaming.jobs import RowWriter
    spark.range(6).repartition(2).write.parquet(f"{tmpdir_path}/in")

    def open_part(partition, epoch):
        return open(f"{tmpdir_path}/part-{epoch}-{partition}", "a")
    writer = RowWriter(open_part, lambda f, row: f.write(f"{row['id']}\n"), lambda f, error: f.close())
    q = (spark.readStream.schema("id long").parquet(f"{tmpdir_path}/in").writeStream.foreach(writer)
         .option("checkpointLocation", f"{tmpdir_path}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    lines = [line for n in os.listdir(tmpdir_path) if n.startswith("part-") for line in open(f"{tmpdir_path}/{n}").read().split()]
    assert sorted(lines) == [str(i) for i in range(6)]
