"""Readers, writers, publishing and the event log, on temporary folders."""

import json

import pytest
from pyspark.sql import types as T

from textloom.fixtures import CHUNKS, load
from textloom.sources import files
from textloom.streaming import state


def test_discovery_reads_one_copy_of_each_chapter(spark, tmp_path):
    for folder in ("ch1/rag_pipeline_output", "ch1/backup", "ch2"):
        (tmp_path / folder).mkdir(parents=True)
    (tmp_path / "ch1/rag_pipeline_output/a_RAG_Optimised.md").write_text(CHUNKS)
    (tmp_path / "ch1/backup/a_RAG_Optimised.md").write_text("old")
    (tmp_path / "ch2/b_RAG_Optimised.md").write_text("---\nchunk_id: X\n---\n\ntext")
    got = {(r.chapter, r.chunk_id) for r in files.read_chunks(spark, str(tmp_path)).collect()}
    assert {c for c, _ in got} == {"ch1", "ch2"} and ("ch2", "X") in got and len(got) == 5
    assert files.read_catalogue(spark, str(tmp_path)).count() == 5
    assert files.file_hashes(spark, str(tmp_path), "*.md").count() == 3


def test_tables_round_trip(spark, tmp_path):
    claims = load(spark, "claims")
    files.write_both(claims, str(tmp_path / "claims"))
    assert sorted(map(tuple, files.read_strings(spark, str(tmp_path / "claims/csv")).na.fill("").collect()))[0][0] == "q1"
    back = files.read_records(spark, str(tmp_path / "claims/jsonl"), claims.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, claims.collect()))
    files.write_cards(claims.select("claim_id", "claim_text"), str(tmp_path / "cards"))
    assert next((tmp_path / "cards").glob("*.csv")).read_text().startswith("#Card_ID\t")
    assert files.write_json(claims, str(tmp_path / "none"), dry_run=True) == 4 and not (tmp_path / "none").exists()
    assert files.last_by_key(load(spark, "bridge"), "record_id", "ord").where("record_id = 'r1'").first().chapter == "13"


def test_strict_and_tolerant_json(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    (tmp_path / "x.json").write_text(json.dumps([{"a": 1}, {"a": "no"}]))
    with pytest.raises(Exception):
        files.read_document(spark, str(tmp_path / "x.json"), schema).collect()
    assert files.read_document(spark, str(tmp_path / "x.json"), schema, strict=False).where("a = 1").count() == 1
    assert files.read_or_empty(spark, str(tmp_path / "missing.json"), schema).count() == 0


def test_publishing_is_all_or_nothing(spark, tmp_path):
    root, one = f"file://{tmp_path}/pub", spark.range(3)
    assert "<version>" in files.publish(spark, {"t": one}, root)["t"] and not (tmp_path / "pub").exists()
    files.publish(spark, {"t": one, "u": one}, root, write=True)
    assert files.read_published(spark, root, "u").count() == 3
    with pytest.raises(files.Refused):
        files.publish(spark, {"t": spark.range(5)}, root, write=True)
    with pytest.raises(files.Refused):
        files.publish(spark, {"t": spark.range(5)}, root, write=True, in_place=True, verify=lambda t: t["t"].count() == 4)
    assert files.read_published(spark, root, "t").count() == 3 and len(list((tmp_path / "pub").glob("[0-9a-f]*"))) == 1
    files.publish(spark, {"t": spark.range(5)}, root, write=True, in_place=True, verify=lambda t: t["t"].count() == 5)
    assert files.read_published(spark, root, "t").count() == 5


def test_event_log_resumes(spark, tmp_path):
    source, log, mark = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "mark")
    source.mkdir()
    rows = [tuple(r) for r in load(spark, "events_log").collect()]
    names = ["prefix", "source_md5", "stage", "status", "version", "ord"]
    for part in (rows[:2], rows[2:]):
        (source / f"{len(list(source.iterdir()))}.json").write_text("\n".join(json.dumps(dict(zip(names, r))) for r in part))
        state.stream_log(spark, str(source), log, mark).awaitTermination(120)
    events = spark.read.parquet(log)
    assert events.count() == len(rows)
    got = {(r.prefix, r.next_stage) for r in state.next_stage(spark, events, load(spark, "log_sources")).collect()}
    assert got == {("p", "3"), ("q", "1"), ("r", "1")}
    assert {r.stage: r.successor for r in state.successors(spark).collect()}["4.5c"] == "4.5d"


def test_windowed_counts_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("event_id", "cast(ts as timestamp) ts", "user_id", "event_type", "value", "props").write.parquet(str(tmp_path / "in/part"))
    got = state.event_counts(spark, str(tmp_path / "in/*"))
    run = got.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination(120)
    total = spark.sql("select sum(n) from counts").first()[0]
    assert total == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
