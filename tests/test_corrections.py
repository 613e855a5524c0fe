"""Answers that correct earlier ones: after every batch the result is that of the newest answers."""

import pytest
from pyspark.sql import functions as F

from contentlake.streaming.corrections import read_corrected, run_corrected_stream, signed_answers

SCHEMA = "row_id long, response_id string, link_url string, q1 double, q2 string, start_date string"


@pytest.fixture
def stream(spark, tmp_path):
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")
    products = spark.createDataFrame([(1, "https://h/", "All")], "ord int, prefix string, target string")

    def arrive(rows, since=None):
        if rows:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        run_corrected_stream(spark.readStream.schema(SCHEMA).parquet(landing), target, origin="https://h", products=products)
        return {r["canonical_url"][10:-1]: (r["n"], r["avg_q1"], r["q2_comments"]) for r in read_corrected(spark, target, since=since).collect()}

    return arrive


def test_corrections_take_old_answers_back(stream):
    day = "2024-01-01"
    first = stream([(1, "a", "/x", 1.0, "one", day), (2, "b", "/x", 3.0, None, day), (3, "c", "/y", 5.0, "three", day), (3, "c", "/y", 5.0, "three", day), (4, None, "/x", 1.0, "no id", day)])
    assert first == {"x": (2, 2.0, "one"), "y": (1, 5.0, "three")}
    # a moves to another page, c is withdrawn by an answer without rating, an old answer of b comes late, d is corrected in its batch
    second = stream([(5, "a", "/z", 2.0, "moved", day), (6, "c", "/y", None, "gone", day), (0, "b", "/z", 1.0, "late", day), (7, "d", "/x", 4.0, "seven", day), (8, "d", "/x", 5.0, "eight", day)])
    assert second == {"x": (2, 4.0, "eight"), "z": (1, 2.0, "moved")}
    # nothing new: a restart repeats nothing
    assert stream([]) == second
    third = stream([(9, "e", "/w", 1.0, "new", day), (10, "c", "/y", 2.0, "back", day)])
    assert third == {**second, "w": (1, 1.0, "new"), "y": (1, 2.0, "back")}


def test_only_touched_pages_are_read(stream, spark):
    day = "2024-01-01"
    stream([(1, "a", "/x", 1.0, "one", day), (2, "b", "/y", 3.0, "two", day)])
    assert stream([(3, "b", "/z", 4.0, "three", day), (4, "c", "/x", 2.0, "four", day)], since=0) == {"x": (2, 1.5, "one|||four"), "z": (1, 4.0, "three")}


def test_state_ends_after_the_delay(spark, tmp_path):
    schema = "row_id long, response_id string, at timestamp"
    landing, seen = str(tmp_path / "in"), []

    def arrive(*rows):
        spark.createDataFrame(rows, "row_id long, response_id string, at string").withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(landing)
        signed = signed_answers(spark.readStream.schema(schema).parquet(landing), forget=("at", "1 day"))
        query = signed.writeStream.foreachBatch(lambda df, _: seen.extend((r["row_id"], r["sign"]) for r in df.collect()))
        query.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
        out = sorted(seen)
        seen.clear()
        return out

    assert arrive((1, "a", "2024-01-01 00:00:00"), (2, "b", "2024-01-01 00:00:00")) == [(1, 1), (2, 1)]
    assert arrive((3, "a", "2024-01-01 12:00:00")) == [(1, -1), (3, 1)]
    assert arrive((4, "c", "2024-02-01 00:00:00")) == [(4, 1)]
    # the states of a and b are gone by now; an answer within the watermark of a forgotten response is a first one
    assert arrive((5, "a", "2024-02-01 00:00:00")) == [(5, 1)]


def test_states_do_not_grow_by_responses(spark, tmp_path):
    schema = "row_id long, response_id string, q1 double, at timestamp"
    landing, seen = str(tmp_path / "in"), []
    of = lambda ids, step: ids.selectExpr(f"id * 2 + {step} AS row_id", "concat('r', id) AS response_id", "CASE WHEN id % 2 = 0 THEN 1.5D END AS q1", "TIMESTAMP '2024-01-01 05:06:07' AS at")

    def arrive(answers):
        answers.write.mode("append").parquet(landing)
        signed = signed_answers(spark.readStream.schema(schema).parquet(landing), groups=8)
        query = signed.writeStream.foreachBatch(lambda df, _: seen.extend(sorted(map(tuple, df.collect()), key=lambda r: r[0])))
        started = query.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        started.awaitTermination()
        out = [(*r[:3], str(r[3]), r[4]) for r in seen]
        seen.clear()
        return out, started.lastProgress["stateOperators"][0]["numRowsTotal"]

    at = "2024-01-01 05:06:07"
    first, states = arrive(of(spark.range(3000), 0))
    assert len(first) == 3000 and states <= 8
    assert first[:2] == [(0, "r0", 1.5, at, 1), (2, "r1", None, at, 1)]
    second, states = arrive(of(spark.range(3), 1).union(of(spark.range(3, 5), -1)))  # three corrections, two late answers
    assert [(r[0], r[4]) for r in second] == [(0, -1), (1, 1), (2, -1), (3, 1), (4, -1), (5, 1)] and states <= 8
