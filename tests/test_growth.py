"""Steps of large runs: which columns are written, how often members are read and moved, and how many rows a task gets."""

import re

import pytest
from pyspark.sql import functions as F

from blockloom.operators import segments as S
from blockloom.plans import queries, run
from blockloom.plans.rest import QUERIES
from blockloom.sources import fixture


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def fresh(monkeypatch):
    """Stage tables by name with their columns, of runs made in the test."""
    made = {}
    monkeypatch.setattr(queries, "_RUNS", {})
    for place in (run, S):
        monkeypatch.setattr(place, "stage", lambda df, name, plain=place.stage: made.setdefault(name, df.columns) and plain(df, name))
    return made


def test_j2_writes_no_whole_libraries(spark, sf, fresh):
    QUERIES["j2_concentration"](spark, sf).collect()
    assert not {"labelled", "e"} & set(fresh)
    assert sorted(fresh["segments"]) == ["block", "devices", "ip", "segment"]


@pytest.mark.parametrize("bits", [2, 5, 16])
def test_cuts_of_two_kinds_in_one_pass(spark, bits):
    rows = [(b, ip) for b, n in ((3, 40), (64, 1), (100, 9)) for ip in range(b, b + n)]
    df = spark.createDataFrame(rows, "block long, ip long")
    few, more = [(3, 8), (3, 31), (100, 104)], [(3, 8), (3, 31), (100, 104), (3, 9), (3, 30), (100, 108), (3, 8)]
    frame = lambda x: spark.createDataFrame(x, "block long, cut_ip long")
    got = {r.ip: (r.block, r.segment, r.final) for r in S.cut_each(df, {"segment": frame(few), "final": frame(more)}, "block", bits).collect()}
    last = lambda b, ip, cuts: max([b, *[c for o, c in cuts if o == b and c <= ip]])
    assert got == {ip: (b, last(b, ip, few), last(b, ip, more)) for b, ip in rows}


def test_sides_of_buckets_without_valid_members(spark):
    zero = {m: F.lit(2).cast("long") for m in ("reports", "devices", "mobile")}
    rows = [(0, ip, ip < 60 or ip == 200, "a" if ip < 128 else None) for ip in range(0, 260)]
    df = spark.createDataFrame(rows, "block long, ip long, is_valid boolean, operator string").withColumns(zero).withColumn("bucket64", F.expr("ip div 64"))
    got = {r.bucket64: (r.l_cnt, r.r_cnt, r.l_reports, r.r_reports, r.l_op, r.r_op) for r in S.boundaries(df, 5).collect()}
    assert got == {0: (5, 0, 10, 0, "a", None), 1: (0, 0, 0, 0, None, None), 2: (0, 1, 0, 2, None, None), 3: (1, 0, 2, 0, None, None)}


def test_d7_reads_members_once(spark, sf, fresh):
    assert plan(QUERIES["d7_run_pieces"](spark, sf)).count("stage-final-members") == 1


def test_d7_small_runs_stay_whole(spark):
    """A run of 256 rows over an edge of 2^16 is one piece, one of 257 is cut at the edge and every 256."""
    edge = 1 << 16
    rows = [(1, ip) for ip in range(edge - 100, edge + 156)] + [(2, ip) for ip in range(3 * edge - 1, 3 * edge + 256)] + [(3, ip) for ip in range(5 * edge, 5 * edge + 300)]
    e = spark.createDataFrame(rows, "run long, ip long")
    got = sorted(map(tuple, queries.pieces(e).select("run", "p16", "piece", "ip_start", "ip_end", "members").collect()), key=str)
    assert got == [
        (1, None, 0, edge - 100, edge + 155, 256), (2, 2, 0, 3 * edge - 1, 3 * edge - 1, 1), (2, 3, 0, 3 * edge, 3 * edge + 255, 256),
        (3, 5, 0, 5 * edge, 5 * edge + 255, 256), (3, 5, 1, 5 * edge + 256, 5 * edge + 299, 44),
    ]


def test_members_move_by_address_only(spark, sf):
    made = plan(S.members(fixture.source(spark, sf), fixture.abnormal(spark, sf)))
    assert "hashpartitioning(ip#" in made and "orderkey#" not in "".join(re.findall(r"hashpartitioning\([^)]*", made))


def test_lines_a_task_stay_few(spark, sf, monkeypatch):
    monkeypatch.setattr(fixture, "LINES_A_TASK", 1000, raising=False)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert re.search(rf"hashpartitioning\(ip#\d+L, {lines // 1000 + 1}\), REPARTITION_BY_NUM", plan(fixture.source(spark, sf)))


def test_j25_joins_by_address_once(spark, sf):
    assert len(re.findall(r"Join \[ip#", plan(QUERIES["j25_trace_keys"](spark, sf)).split("== Initial Plan ==")[0])) == 1
