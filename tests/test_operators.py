"""Operators on small tables with hand-derived results."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gapwise.functions import ordered
from gapwise.operators import catalog, extract, profile, rules, select, temporal, tensors
from gapwise.sources import measurements as store

T0 = datetime(2026, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


POSITION = [(0, 0.0), (0.5, 0.0), (1, 2.0), (1.5, 2.0), (2, 0.0), (2.5, 0.0), (7200, 0.0), (7200.5, 3.0), (7201, 0.0)]


@pytest.fixture(scope="module")
def position(spark):
    return spark.createDataFrame([(at(s), v) for s, v in POSITION], "time timestamp_ntz, value double")


def test_gap_statistics(position):
    h = temporal.gap_histogram(temporal.gaps(position, [], ["time", "value"]))
    r = temporal.gap_statistics(h).first()
    assert (r.gap_count, r.minimum_gap_seconds, r.maximum_gap_seconds, r.median_gap_seconds) == (8, 0.5, 7197.5, 0.5)
    assert r.mean_gap_seconds == pytest.approx(900.125) and r.p95_gap_seconds == pytest.approx(4678.55) and r.p99_gap_seconds == pytest.approx(6693.71)
    counts = {x.threshold_seconds: x.gap_count for x in temporal.gap_threshold_counts(h).collect()}
    assert counts[1] == counts[3600] == 1 and counts[21600] == 0


def test_sessions_and_cycles(position):
    got = temporal.sessions(position, [], ["time", "value"], 3600).orderBy("session_id").collect()
    assert [(r.session_id, r.start_time, r.end_time, r.duration_seconds, r.number_of_samples, r.maximum_internal_gap_seconds) for r in got] == [(1, at(0), at(2.5), 2.5, 6, 0.5), (2, at(7200), at(7201), 1.0, 3, 0.5)]
    tagged = temporal.session_ids(position, [], ["time", "value"], 3600)
    c = temporal.cycles(tagged, ["session_id"], ["time", "value"], 1.0).orderBy("cycle_id").collect()
    assert [(r.cycle_id, r.session_id, r.start_time, r.end_time, r.number_of_samples, r.start_index, r.end_index) for r in c] == [(1, 1, at(1), at(2), 3, 2, 4), (2, 2, at(7200.5), at(7201), 2, 1, 2)]
    assert c[0].mean_position == pytest.approx(4 / 3) and c[1].mean_position == 1.5


@pytest.mark.parametrize("bucket", ["SECOND", "HOUR", "YEAR"])
def test_two_levels_equal_one(spark, bucket):
    df = spark.createDataFrame([(i % 3, at(i * i * 7 % 5000), i) for i in range(300)], "k int, time timestamp_ntz, v int")
    got = ordered.scan(df, ["k"], ["time", "v"], {"p": "v"}, {"s": F.col("v"), "up": (F.col("v") > F.col("p") + 40).cast("int")}, bucket)
    from pyspark.sql import Window

    w = Window.partitionBy("k").orderBy("time", "v")
    want = df.withColumn("p", F.lag("v").over(w)).withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    want = want.withColumn("up", F.coalesce((F.col("v") > F.col("p") + 40).cast("int"), F.lit(0)))
    want = want.withColumn("up", F.sum("up").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_edges_at_the_ends_are_no_cycles(spark):
    df = spark.createDataFrame([(at(i), v) for i, v in enumerate([5.0, 0.0, 5.0, 5.0, 0.0, 5.0])], "time timestamp_ntz, value double")
    got = temporal.cycles(df, [], ["time", "value"]).collect()
    assert [(r.start_time, r.end_time) for r in got] == [(at(2), at(4))]
    with pytest.raises(ValueError):
        temporal.edges(df, [], ["time"], -1)


def test_touching_windows_share_their_boundary(spark, position):
    cuts = [(1, 1, 0, 1), (2, 1, 1, 2), (3, 1, 2, 2.5), (4, 2, 7200, 7200.5), (5, 2, 7200.5, 7201)]
    cycles = spark.createDataFrame([(c, s, at(a), at(b)) for c, s, a, b in cuts], "cycle_id bigint, session_id bigint, start_time timestamp_ntz, end_time timestamp_ntz")
    m = extract.cycle_measurements(position.withColumn("signal_name", F.lit("position")), cycles, bucket_seconds=1)
    assert [r["count"] for r in m.groupBy("cycle_id").count().orderBy("cycle_id").collect()] == [3, 3, 2, 2, 2]
    s = extract.window_summary(m, cycles, spark.createDataFrame([("position",), ("other",)], "signal_name string"))
    assert s.where("is_missing").count() == 5 and s.where("signal_name = 'other' AND sample_count = 0").count() == 5


def test_nearest_takes_the_earlier_of_ties(spark):
    points = spark.createDataFrame([(1, at(10)), (2, at(15)), (3, at(10**6)), (4, at(-10**6))], "point_id bigint, at timestamp_ntz")
    samples = spark.createDataFrame([(at(10), 1.0), (at(20), 2.0)], "time timestamp_ntz, value double")
    got = {r.point_id: r.nearest_value for r in temporal.nearest(points, samples, "at").collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 2.0, 4: 1.0}


def test_merge_and_overlap(spark):
    df = spark.createDataFrame([(at(0), at(10)), (at(2), at(3)), (at(11), at(12)), (at(100), at(101))], "start_time timestamp_ntz, end_time timestamp_ntz")
    assert sorted((r.start_time, r.end_time, r.intervals) for r in temporal.merge_intervals(df, [], 1).collect()) == [(at(0), at(12), 3), (at(100), at(101), 1)]
    right = spark.createDataFrame([(at(12), at(50))], "min_time timestamp_ntz, max_time timestamp_ntz")
    assert [r.start_time for r in temporal.overlap_exists(df, right).collect()] == [at(11)]


def test_merge_over_many_days_equals_a_loop(spark):
    """Intervals that outlast their day, repeated rows, null keys and null starts."""
    import random

    rng = random.Random(2)
    rows = [(rng.choice([1, 2, None]), at(a), at(a + rng.choice([5, 400, 200_000]))) for a in (rng.randrange(0, 3_000_000) for _ in range(150))]
    rows += rows[:20] + [(1, None, at(5)), (1, None, at(5))]
    fields = "k int, start_time timestamp_ntz, end_time timestamp_ntz"
    for keys in ([], ["k"]):
        want = []
        for k in {r[0] if keys else 0 for r in rows}:
            mine = [r for r in rows if not keys or r[0] == k]
            here = [[None, r[2], 1] for r in mine if r[1] is None]
            reach = max([r[1] for r in here], default=None)
            begun = False
            for _, a, z in sorted((r for r in mine if r[1] is not None), key=lambda r: (r[1], r[2])):
                if reach is None or a - reach > timedelta(seconds=3600) or not (begun or here):
                    here.append([a, z, 1])
                else:
                    here[-1] = [a if here[-1][0] is None else here[-1][0], max(here[-1][1], z), here[-1][2] + 1]
                reach, begun = z if reach is None else max(reach, z), True
            want += [((k,) if keys else ()) + tuple(x) for x in here]
        got = temporal.merge_intervals(spark.createDataFrame(rows, fields), keys, 3600)
        assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert temporal.merge_intervals(spark.createDataFrame([], fields), [], 1).count() == 0


def test_selection_equals_one_ordered_pass(spark):
    rows = [(i, i % 2, at(i), i % 3, i % 7 - 3) for i in range(90)]
    df = spark.createDataFrame(rows, "cycle_id bigint, session_id bigint, start_time timestamp_ntz, stratum bigint, burst_id bigint")
    hashed = {r.cycle_id: r.h for r in df.select("cycle_id", F.xxhash64(F.lit(42), "cycle_id").alias("h")).collect()}
    turns, queue = {}, []
    for i, session, _, stratum, burst in sorted(rows, key=lambda r: hashed[r[0]]):
        turn = turns[session, stratum] = turns.get((session, stratum), 0) + 1
        queue.append((turn, session, stratum, i, burst))
    used, order = {}, []
    for *_, i, burst in sorted(queue):
        used[burst] = used.get(burst, 0) + 1
        if burst < 0 or used[burst] <= 4:
            order.append(i)
    got = select.select_cycles(df, 20, 4)
    assert {r.cycle_id: r.selection_rank for r in got.where("selection_rank IS NOT NULL").collect()} == {i: n + 1 for n, i in enumerate(order[:20])}
    assert got.count() == 90 and got.where("rejection_reasons <> ''").count() == 90 - len(order)


def test_node_paths_and_cycles_in_them(spark):
    nodes = spark.createDataFrame([("a", "Root", None), ("b", "Drive", "a"), ("c", None, "b"), ("d", "Orphan", "x"), ("e", "Blank", "")], "node_id string, name string, parent_node string")
    got = {r.node_id: r.path for r in catalog.node_paths(nodes).collect()}
    assert got == {"a": "Root", "b": "Root/Drive", "c": "Root/Drive/", "d": "Orphan", "e": "Blank"}
    loop = spark.createDataFrame([("a", "A", "b"), ("b", "B", "a")], nodes.schema)
    with pytest.raises(ValueError):
        catalog.check_acyclic(loop, catalog.node_paths(loop))


def test_names_and_collisions(spark):
    rows = [("R/Drive", "velocity", "uuid", "velocity"), ("R/Sensor A", "x", "int", "sensor_a"), ("R/P", "pressure", "uuid", "pressure"), ("R/Z", "vibration", "uuid", "vibration_z"), ("R/Q", "mm", "int", "mm_q"), (None, "volt", "int", "volt_volt")]
    df = spark.createDataFrame(rows, "path string, unit_code string, source string, want string")
    for r in df.withColumn("got", catalog.base_name()).collect():
        assert r.got == r.want
    assert catalog.unique_names([("t", "R/A"), ("t", "R/A"), ("t", "R/A"), ("t", "R/A")]) == ["t", "t_a", "t_r", "t_2"]


def test_find_signals(spark):
    df = spark.createDataFrame([("Exp1/Drive", "mm"), ("Exp10/Temp", None)], "path string, unit_code string")
    assert catalog.find_signals(df, path="exp1").count() == 2 and catalog.find_signals(df, unit="m").count() == 1 and catalog.find_signals(df, name="^drive$").count() == 1


def test_scan_guards():
    with pytest.raises(ValueError):
        store.check_bounds(None, None)
    with pytest.raises(ValueError):
        store.check_bounds(at(1), at(1))
    store.check_bounds(None, None, allow_full_scan=True)


def test_quality_with_odd_values(spark):
    cycles = spark.createDataFrame([(1, 1, at(0), at(10)), (2, 1, at(20), at(20))], "cycle_id bigint, session_id bigint, start_time timestamp_ntz, end_time timestamp_ntz")
    m = spark.createDataFrame([(1, "a", at(0), 1.0), (1, "a", at(0), float("inf")), (1, "a", at(4), float("nan")), (1, "a", at(8), 3.0), (1, "b", at(2), 5.0)], "cycle_id bigint, signal_name string, time timestamp_ntz, value double")
    q = {(r.cycle_id, r.signal_name): r for r in profile.signal_quality(m, cycles).collect()}
    a, b = q[1, "a"], q[1, "b"]
    assert (a.sample_count, a.finite_sample_count, a.duration_seconds, a.maximum_timestamp_gap, a.duplicate_timestamp_count, a.mean_value, a.signal_range, a.coverage_ratio, a.estimated_sampling_rate) == (4, 2, 8.0, 4.0, 1, 2.0, 2.0, 0.8, 0.375)
    assert (b.standard_deviation, b.median_sampling_interval, b.estimated_sampling_rate, b.is_constant) == (0.0, None, None, False)
    assert q[2, "a"].missing_signal and q[2, "a"].sample_count == 0
    assert profile.cycle_profile(profile.signal_quality(m, cycles), cycles, "a").where("cycle_id = 2").first().missing_signal_names == "a,b"


def test_rules_fall_back_and_skip(spark):
    values = [("core", "a", "m", float(i)) for i in range(30)] + [("core", "b", "m", 1.0)] * 30 + [("core", "c", "m", 1.0)] * 5 + [("core", "d", "m", 1.0)] * 29 + [("core", "d", "m", 90.0), ("core", "d", "m", float("inf"))]
    got = {r.signal_name: r for r in rules.learned_rules(spark.createDataFrame(values, "scope string, signal_name string, metric string, x double"), rules.RuleConfig()).collect()}
    assert got["a"].method == "median_mad" and got["a"].lower_bound == pytest.approx(14.5 - 3.5 / 0.6745 * 7.5)
    assert (got["b"].status, got["c"].status) == ("skipped_constant", "skipped_insufficient_data")
    assert got["d"].method == "quantile" and got["d"].fallback_used and got["d"].reference_count == 30


def test_ready_block(spark):
    df = spark.createDataFrame([(i, i // 6, at(i), at(i + 1), n) for i, n in enumerate([1, 1, 0, 1, 1, 1, 1, 1, 1])], "cycle_id bigint, session_id int, start_time timestamp_ntz, end_time timestamp_ntz, a_sample_count int")
    blocks = select.ready_blocks(df, ["a"], 3)
    assert [r.cycle_id for r in select.first_block(blocks, 3).collect()] == [3, 4, 5]
    with pytest.raises(ValueError):
        select.first_block(blocks, 4)


def test_tensor_lengths_masks_and_skips(spark, tmp_path):
    rows = [(1, "position", at(i), 10.0 * i) for i in range(4)] + [(1, "velocity", at(i), float(i + 1)) for i in range(2)] + [(2, "position", at(i), float(i)) for i in range(6)]
    m = spark.createDataFrame(rows, "cycle_id bigint, signal_name string, time timestamp_ntz, value double")
    cycles = spark.createDataFrame([(1, 1, at(0), at(4)), (2, 1, at(5), at(9)), (3, 1, None, None)], "cycle_id bigint, session_id bigint, start_time timestamp_ntz, end_time timestamp_ntz")
    length = tensors.target_length(tensors.cycle_lengths(m, "position"))
    assert length == 6 and tensors.target_length(tensors.cycle_lengths(m, "position"), "percentile", 50) == 5
    out = {r.cycle_id: r for r in tensors.cycle_tensors(m, cycles, ["position", "velocity"], length, "position").collect()}
    assert out[1]["values"] == [[0.0, 10.0, 20.0, 30.0, 30.0, 30.0], [1.0, 2.0, 2.0, 2.0, 2.0, 2.0]] and [sum(x) for x in out[1]["mask"]] == [4, 2]
    assert out[2].skip_reason == "missing_required_signal" and out[3].skip_reason == "missing_cycle_timing"
    s = tensors.length_statistics(tensors.cycle_lengths(m, "position"), 5).first()
    assert (s.padded_count, s.truncated_count, s.mean_length) == (1, 1, 5.0)
    written = tensors.write_npy(tensors.cycle_tensors(m, cycles, ["position", "velocity"], length, "position"), str(tmp_path)).collect()
    import numpy as np

    assert np.load(tmp_path / f"{written[0].file_name}.npy").shape == (1, 6, 2)
    with pytest.raises(ValueError):
        tensors.target_length(tensors.cycle_lengths(m.limit(0), "position"))


def test_selection_caps_bursts(spark):
    """Six cycles of one burst, two without one: the cap holds for the burst alone."""
    rows = [(i, 1, at(i), 0, 0) for i in range(6)] + [(6, 1, at(6), 0, -1), (7, 2, at(7), 1, -1)]
    df = spark.createDataFrame(rows, "cycle_id bigint, session_id bigint, start_time timestamp_ntz, stratum bigint, burst_id bigint")
    got = select.select_cycles(df, 10, 4).toPandas()
    assert got.selection_rank.notna().sum() == 6 and (got[got.burst_id == 0].selection_rank.notna()).sum() == 4
    assert (got[got.selection_rank.isna()].rejection_reasons == "burst_selection_limit").all()
    assert select.selection_summary(select.select_cycles(df, 10, 4), 10).first() == (8, 6, 4)


def test_validation_block_needs_neighbours(spark):
    counts = [(1, 3), (2, 0), (3, 1), (4, 5), (5, 5), (6, 5)]
    df = spark.createDataFrame([(c, 1, at(c), n) for c, n in counts], "cycle_id bigint, session_id bigint, start_time timestamp_ntz, x_sample_count bigint")
    q = select.validation_quality(df, ["x"], {"x": 2})
    assert [r.rejection_reason for r in q.orderBy("cycle_id").collect()] == ["", "missing required signals", "insufficient samples for required signals", "", "", ""]
    assert [r.cycle_id for r in select.validation_cycles(q, 2).collect()] == [4, 5]
    assert [r.cycle_id for r in select.validation_cycles(q, 2, False).collect()] == [1, 4]
    for bad in ({"count": 4}, {"count": 0}, {"count": 9, "consecutive": False}):
        with pytest.raises(ValueError):
            select.validation_cycles(q, **bad)


def test_nearest_keeps_repeated_points_apart(spark):
    points = spark.createDataFrame([(1, at(10)), (1, at(10)), (None, at(19)), (2, None)], "point_id bigint, at timestamp_ntz")
    samples = spark.createDataFrame([(at(10), 1.0), (at(20), 2.0)], "time timestamp_ntz, value double")
    got = sorted((r.point_id or 0, r.nearest_value or 0) for r in temporal.nearest(points, samples, "at").collect())
    assert got == [(0, 2.0), (1, 1.0), (1, 1.0), (2, 0)]
    assert temporal.nearest(points, samples.limit(0), "at").where("nearest_value IS NULL").count() == 4


def test_ordered_edge_cases(spark):
    df = spark.createDataFrame([(None, at(1), 5.0, "x"), (None, at(1), 5.0, "x"), ("k", None, 1.0, "y")], "k string, time timestamp_ntz, v double, __bucket string")
    got = ordered.scan(df, ["k"], ["time", "v"], {"p": "v"}, {"n": F.lit(1)})
    assert got.columns == ["k", "time", "v", "__bucket", "p", "n"]
    assert sorted((r.p or 0, r.n) for r in got.collect()) == [(0, 1), (0, 1), (5.0, 2)]
    assert ordered.scan(df.limit(0), [], ["time"], {"p": "v"}, {"n": F.lit(1)}).count() == 0
    assert temporal.gap_statistics(temporal.gap_histogram(temporal.gaps(df.limit(0), [], ["time"]))).first().gap_count is None


def test_batches_and_selection_counts(spark):
    cycles = spark.createDataFrame([(1, i, at(i)) for i in range(1, 6)], "session_id bigint, cycle_id bigint, start_time timestamp_ntz")
    found = spark.createDataFrame([(1,), (1,), (2,), (5,)], "cycle_id bigint")
    got = extract.batch_summary(found, cycles, 2).orderBy("batch_id").collect()
    assert [tuple(r) for r in got] == [(0, 2, 1, 2, 3), (1, 2, 3, 4, 0), (2, 1, 5, 5, 1)]
    assert extract.batch_summary(found, cycles.limit(0), 2).count() == 0
    picked = spark.createDataFrame([(1, 0, -1, 1), (1, 1, 7, 2), (2, 1, 7, 3), (2, 1, 7, None)], "session_id bigint, stratum bigint, burst_id bigint, selection_rank bigint")
    assert sorted(tuple(r) for r in select.selection_counts(picked).collect()) == [("session", 1, 2), ("session", 2, 1), ("time_stratum", 0, 1), ("time_stratum", 1, 2), ("vibration_burst", -1, 1), ("vibration_burst", 7, 2)]
    assert select.selection_counts(picked.limit(0)).count() == 0


def test_samples_around_the_first_cycles(spark, position):
    cycles = spark.createDataFrame([(1, at(1), at(2)), (2, at(7200.5), at(7201))], "cycle_id bigint, start_time timestamp_ntz, end_time timestamp_ntz")
    got, some = temporal.around(position, cycles, 1)
    assert got.count() == 6 and some.count() == 1  # both margins are closed: 0 to 3
    got, some = temporal.around(position, cycles.limit(0))
    assert got.count() == 0 and some.count() == 0
    r = temporal.interval_summary(temporal.gaps(position, [], ["time", "value"])).first()
    assert tuple(r) == (9, 500.0, 500.0, 7197500.0)
    assert tuple(temporal.interval_summary(temporal.gaps(position.limit(0), [], ["time", "value"])).first()) == (0, None, None, None)
