"""Operators on small rows: ingest, dialogs, splits, resumable work, sinks and streams."""

import json

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import dedup, dialog, incremental, ranking, reports, sampling, tensors
from millrace.sources import jsonl, manifest, sinks
from millrace.streaming import incremental as stream

CHATS = [
    {"messages": [{"role": "user", "content": "q1"}, {"role": "assistant", "content": "a1"}], "id": 7, "language": "sw"},
    {"conversations": [{"from": "human", "value": "q2"}, {"from": "gpt", "value": [{"text": "a2"}, "more"]}]},
    [{"role": "user", "content": "q3"}, {"role": "model", "content": "a3"}],
    {"instruction": " q4 ", "response": "a4", "source": "s", "source_id": "x"},
    {"user": "q5", "assistant": "a5", "language": "fr"},
    {"messages": [{"role": "assistant", "content": "only"}]},
]


def write(folder, lines):
    path = folder / "chat.jsonl"
    path.write_text("\n".join(lines) + "\n")
    return f"file://{path}"


def test_layouts(spark, tmp_path):
    path = write(tmp_path, [json.dumps(CHATS[0]), "", *map(json.dumps, CHATS[1:])])
    found = {r.instruction: r for r in jsonl.chat_rows(jsonl.read_lines(spark, path), "key").collect()}
    assert sorted(found) == ["q1", "q2", "q3", "q4", "q5"]
    assert (found["q1"].source_id, found["q1"].language, found["q1"].source) == ("7", "swahili", "key")
    assert (found["q2"].response, found["q2"].source_id) == ("a2 more", "key-2")
    assert found["q3"].source_id == "key-3" and found["q4"].source_id == "x" and found["q5"].language == "fr"
    dense = jsonl.chat_rows(jsonl.read_lines(spark, path, keep_blank_index=False), "key")
    assert {r.source_id for r in dense.collect()} == {"7", "key-1", "key-2", "x", "key-4"}


def test_malformed_lines(spark, tmp_path):
    path = write(tmp_path, [json.dumps(CHATS[0]), '{"messages": [', json.dumps(CHATS[4])])
    lines = jsonl.read_lines(spark, path)
    assert jsonl.chat_rows(lines, "k", mode="tolerant").count() == 2
    with pytest.raises(Exception, match="line 2"):
        jsonl.chat_rows(lines, "k").collect()


def test_line_numbers_over_splits(spark, tmp_path):
    path = write(tmp_path, [json.dumps({"user": f"q{i}", "assistant": "a"}) if i % 5 else "" for i in range(400)])
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = jsonl.chat_rows(jsonl.read_lines(spark, path), "k").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert {(r.source_id, r.instruction) for r in found} == {(f"k-{i}", f"q{i}") for i in range(400) if i % 5}


def test_one_of_several_files_keeps_its_lines(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"part={k}").mkdir()
        write(tmp_path / f"part={k}", [json.dumps({"user": f"q{i}", "assistant": "a"}) for i in range(2_000)])
    kept = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        lines = jsonl.read_lines(spark, f"file://{tmp_path}/part=*").withColumn("part", F.regexp_extract("file", r"part=(\d+)", 1).cast("long"))
        found = [jsonl.chat_rows(lines.filter(F.col("part") == k), "k").collect() for k in range(2)]
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", kept)
    assert all(sorted((r.source_id, r.instruction) for r in rows) == sorted((f"k-{i}", f"q{i}") for i in range(2_000)) for rows in found)


def turns(*pairs):
    return [{"role": r, "content": c} for r, c in pairs]


@pytest.mark.parametrize(
    "messages,last,first,merged",
    [
        (turns(("user", "a"), ("user", "b"), ("assistant", "c")), ("b", "c"), ("a", "c"), 2),
        (turns(("assistant", "x"), ("user", "a"), ("assistant", "b")), ("a", "b"), ("a", "b"), 2),
        (turns(("user", "a"), ("assistant", "b"), ("user", "c")), ("c", "b"), ("a", "b"), 0),
        (turns(("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")), ("c", "d"), ("a", "b"), 4),
        (turns(("user", "a")), None, None, 0),
        ([], None, None, 0),
    ],
)
def test_pairs(spark, messages, last, first, merged):
    df = spark.createDataFrame([(messages,)], f"m {dialog.TURNS}")
    row = df.select(dialog.last_pair(F.col("m")).alias("last"), dialog.first_pair(F.col("m")).alias("first"), F.size(dialog.alternating(F.col("m"))).alias("n")).first()
    assert (row.last and tuple(row.last), row.first and tuple(row.first), row.n) == (last, first, merged)


def test_split_is_a_partition_and_ignores_partitioning(spark):
    rows = spark.range(500).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 7, "small").otherwise("big").alias("g"))
    one = {tuple(r) for r in sampling.split(rows.repartition(1), "g", 0.1, 3, "doc_id").select("doc_id", "is_test").collect()}
    many = {tuple(r) for r in sampling.split(rows.repartition(9), "g", 0.1, 3, "doc_id").select("doc_id", "is_test").collect()}
    assert one == many and len(one) == 500
    assert sum(t for _, t in one) == 1 + 49


def test_running_sum_matches_one_window(spark):
    rows = spark.range(300).select(F.col("id"), (F.col("id") * 7 % 11).alias("v"))
    found = {r.id: r.s for r in sampling.running(rows, F.floor(F.col("id") / 40), [F.col("id")], F.col("v"), "s").collect()}
    total = 0
    for i in range(300):
        assert found[i] == total
        total += i * 7 % 11


def test_floor_reached_once(spark):
    rows = spark.range(200).select(F.col("id"), (F.col("id") % 3).alias("b"), F.lit(10).alias("t"))
    taken = sampling.round_robin(rows, "b", "t", 95, 1, "id").collect()
    assert len(taken) == 10 and max(r.tokens_before for r in taken) == 90


def test_last_wins_and_remaining(spark):
    log = spark.createDataFrame([(1, 0, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string")
    assert {(r.k, r.v) for r in dedup.last_wins(log, ["k"], "o").collect()} == {(1, "b"), (2, "c")}
    left = incremental.remaining(spark.range(5).withColumnRenamed("id", "k"), log.select("k"), spark.createDataFrame([(4,)], "k long"), key="k")
    assert {r.k for r in left.collect()} == {0, 3}


def test_ranking_without_errors_or_passers(spark):
    schema = "name string, mean_kld double, mean_kld_se double, hidden_mean double, cpu_generation_tps double, size long, peak_rss_kb double"
    rows = spark.createDataFrame([("a", 0.010, None, 0.5, 1.0, 5, None), ("b", 0.0115, None, 0.9, 1.0, 9, None), ("c", 0.02, None, 0.99, 9.0, 1, None), ("d", None, None, 1.0, 9.0, 1, None)], schema)
    found = ranking.noise_aware(rows).orderBy("place").collect()
    assert [r.name for r in found] == ["b", "a", "c", "d"] and {r.tolerance for r in found} == {0.002}
    assert ranking.noise_aware(rows.limit(0)).count() == 0


def test_pareto_against_all_pairs(spark):
    points = [(i, (i * 37) % 11, (i * 53) % 7, (i * 29) % 5) for i in range(120)]
    df = spark.createDataFrame(points, "name int, a int, s int, t int")
    best = {p[0] for p in points if not any(q[1] >= p[1] and q[2] <= p[2] and q[3] >= p[3] and q[1:] != p[1:] for q in points)}
    assert {r.name for r in ranking.pareto(df, name="name", most=["a", "t"], least=["s"]).collect()} == best


def test_gate_raises(spark):
    rows = spark.range(10)
    assert reports.gate(rows, F.count(F.lit(1)) == 10, "no").count() == 10
    with pytest.raises(Exception, match="too few"):
        reports.gate(rows, F.count(F.lit(1)) > 10, "too few").collect()


def test_lattice_bounds(spark):
    df = spark.createDataFrame([([float(i - 20) for i in range(64)],), ([0.0] * 32,)], "v array<float>")
    rounded = df.withColumn("r", tensors.lattice(F.col("v")))
    most = [r[0] for r in rounded.select(tensors.errors(F.col("v"), F.col("r"))[0]).collect()]
    assert most[1] == 0 and 0 < most[0] <= 43 / 8


def single_precision(values, block=32):
    """The quantiser in numpy."""
    out = []
    for k in range(0, len(values), block):
        x = np.array(values[k : k + block], np.float32)
        scale = x[np.abs(x).argmax()] / np.float32(-8)
        inverse = np.float32(1) / scale if scale else np.float32(0)
        codes = np.minimum(15, np.floor(x * inverse + np.float32(8.5))) - 8
        out += (codes.astype(np.float32) * np.float32(np.float16(scale))).tolist()
    return out


def test_lattice_half_against_numpy(spark):
    rng = np.random.default_rng(6)
    rows = [rng.normal(0, 10.0**k, n).astype(np.float32).tolist() for k in range(-8, 4) for n in (1, 31, 32, 70)] + [[0.0] * 40, [], [-1.0, 1.0], [3e-7, 1e-8]]
    df = spark.createDataFrame([(k, v) for k, v in enumerate([*rows, None])], "k int, v array<float>")
    found = {r.k: r.y for r in df.select("k", tensors.lattice_half(F.col("v")).alias("y")).collect()}
    assert found.pop(len(rows)) is None
    for k, v in enumerate(rows):
        assert found[k] == pytest.approx(single_precision(v), rel=1e-6, abs=0), k
    assert [r.y for r in df.filter(F.size("v") <= 0).select(tensors.lattice(F.col("v")).alias("y")).collect()] == [[]]


@given(st.lists(st.floats(-7e4, 7e4, width=32), min_size=1, max_size=40))
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_half(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    with np.errstate(over="ignore"):
        assert [r.y for r in df.select(tensors.half(F.col("x")).alias("y")).collect()] == [float(np.float16(v)) for v in values]


def test_places_of_any_values(spark):
    """Sparse, dense and single values: chunks and hold-outs follow the order."""
    for values in ([k * 10**12 for k in range(500)], list(range(700)), [5], []):
        df = spark.createDataFrame([(v,) for v in values], "v long").repartition(3)
        found = {r.v: r.chunk_index for r in sampling.chunks(df, "v", 7).collect()}
        assert found == {v: k // 7 for k, v in enumerate(sorted(values))}
    ranges = df.sparkSession.createDataFrame([(k * 10**9,) for k in range(2_000)], "v long")
    per = ranges.groupBy(sampling.by_value(ranges, "v", 16).alias("r")).count().collect()
    assert len(per) == 16 and max(r["count"] for r in per) < 200


def test_samples_sort_only_the_ranges_they_need(spark):
    df = spark.range(5_000).selectExpr("id", "if(id % 3 = 0, null, 'a') as g")
    whole = {(r.g, r.id): r.place for r in sampling.ranked_within(df, "g", 3, "id").collect()}
    few = {(r.g, r.id): r.place for r in sampling.ranked_within(df, "g", 3, "id", most=F.lit(40)).collect()}
    assert few == {k: p for k, p in whole.items() if p <= 40} and len(few) == 80
    assert sorted(p for (g, _), p in whole.items() if g is None) == list(range(1, sum(g is None for g, _ in whole) + 1))


def test_first_match_keeps_repeated_and_unmatched_rows(spark):
    left = spark.createDataFrame([("ab", 1), ("ab", 1), ("zz", None)], "n string, k int")
    right = spark.createDataFrame([("b", 2), ("a", 3)], "p string, v int")
    found = ranking.first_match(left, right, F.contains("n", F.col("p")), order=["p"])
    assert sorted(map(tuple, found.collect()), key=str) == [("ab", 1, "a", 3), ("ab", 1, "a", 3), ("zz", None, None, None)]


def test_pair_gate_outcomes(spark):
    rows = [(False, "p", "c", "r", 1, 1, 1), (True, "p", None, "r", 1, 1, 1), (True, "p", "c", "r", 9, 1, 1), (True, "p", "c", "r", 1, 1, 9), (True, "p", "c", "r", 4, 1, 4), (True, "p", " ", "r", 1, 1, 1), (True, "p", "c", "r", 1, 1, 1)]
    df = spark.createDataFrame(rows, "valid boolean, p string, c string, r string, np int, nc int, nr int")
    outcome = dialog.pair_gate(*[F.col(c) for c in df.columns], most_prompt=5, most_completion=5, most_total=7)
    assert [r.o for r in df.select(outcome.alias("o")).collect()] == ["invalid_row", "render_splice_failed", "prompt_too_long", "completion_too_long", "too_long", "empty_completion", "kept"]


def test_sinks_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([(2, turns(("user", "b"), ("assistant", "c"))), (1, turns(("user", "a"), ("assistant", "d")))], f"k int, messages {dialog.TURNS}")
    path = f"file://{tmp_path}/out"
    sinks.write_arrays(rows, path, order="k")
    assert sinks.read_back(spark, path, 2).first().ok
    assert not sinks.read_back(spark, path, 3).first().ok
    sinks.publish(rows, f"file://{tmp_path}/pub", ["k"])
    assert spark.read.parquet(f"file://{tmp_path}/pub").filter("split = 'train'").count() == 2


def test_listing(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "__pycache__").mkdir()
    for name in ("a/x.bin", "a/y.tmp", "__pycache__/z"):
        (tmp_path / name).write_bytes(b"abc")
    found = manifest.listing(spark, f"file://{tmp_path}").collect()
    assert [r.path.endswith("a/x.bin") for r in found] == [True] and found[0].size == 3


def test_stream_equals_batch_and_runs_once(spark, tmp_path):
    source = f"file://{tmp_path}/in"
    rows = spark.createDataFrame([(i % 8, i, "bad" if i % 8 == 3 else "good") for i in range(24)], "k int, o int, t string")
    rows.repartition(4).write.parquet(source)
    reason = lambda: F.when(F.col("t") == "bad", "rejected")
    paths = [f"file://{tmp_path}/{x}" for x in ("done", "failed", "cp")]
    for checkpoint in (paths[2], paths[2] + "2"):  # the second run sees all files anew
        stream.run_available(spark, source, rows.schema, reason, paths[0], paths[1], checkpoint, key="k", order="o")
    assert sorted(r.k for r in spark.read.parquet(paths[0]).collect()) == [0, 1, 2, 4, 5, 6, 7]
    assert [tuple(r) for r in spark.read.parquet(paths[1]).collect()] == [(3, "rejected")]
