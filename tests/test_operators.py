"""Goldens, boundaries and order-independence of the recording operators."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gridstone.functions import identity, scalar
from gridstone.operators import asof, features, integrity, labels, policy, runs, scenes, selection, timegrid

from .conftest import rows

MS, S = 1_000_000, 1_000_000_000


def grid(spark, stamps, fps, tolerance):
    df = spark.createDataFrame([("r", i, t) for i, t in enumerate(stamps)], "k string, i long, t long")
    return [(r["target_ts"], r["batch_ts"], r["error"]) for r in timegrid.match_grid(df, "k", "t", ["i"], fps, tolerance).orderBy("target_index").collect()]


@pytest.mark.parametrize("stamps, fps, tolerance", [
    ([70 * MS, 260 * MS, 333 * MS, 480 * MS, 911 * MS], Fraction(5), 90 * MS), ([0, 7 * S, 13 * S], Fraction(1, 3), S), ([5, 3, 11, 8, 21, 34], Fraction(S, 4), 1),
    ([900, 100, 1300, 1777], Fraction(S, 250), 60), ([1_704_433_195_189_486_123 + i * 3 * S + i % 7 for i in range(9)], Fraction(1), S), ([42], Fraction(7, 3), 0), ([11, 11 + 41_708_333, 11 + 83_416_667], Fraction(24000, 1001), 1),
])
def test_grid_equals_the_loop(spark, stamps, fps, tolerance):
    want = [(target, batch, None if batch is None else batch - target) for _, target, batch in brute_grid(stamps, fps, tolerance)]
    assert grid(spark, stamps, fps, tolerance) == want and want[0][0] == stamps[0]


def brute_grid(stamps, fps, tolerance):
    left, out, i = sorted(stamps), [], 0
    while True:
        target = stamps[0] + math.floor(i * S / fps + Fraction(1, 2))
        if target > max(stamps) + tolerance:
            return out
        best = min(left, key=lambda b: (abs(b - target), b), default=None)
        if best is not None and abs(best - target) <= tolerance:
            left.remove(best)
            out.append((i, target, best))
        else:
            out.append((i, target, None))
        i += 1


def test_grid_forms_equal_the_loop(spark):
    rng = random.Random(5)
    for _ in range(300):
        stamps = rng.sample(range(0, 3000), rng.randint(1, 25))
        fps, tolerance = Fraction(S, rng.choice([100, 70, 333])), rng.choice([0, 10, 34, 49, 60, 200])
        assert timegrid.greedy_grid(stamps, fps, tolerance) == brute_grid(stamps, fps, tolerance)
    data, want = [], {}
    for k in range(40):
        stamps = rng.sample(range(0, 5000), rng.randint(1, 40))
        data += [(k, i, t) for i, t in enumerate(stamps)]
        want[k] = brute_grid(stamps, Fraction(S, 100), 49)
    df = spark.createDataFrame(data, "k long, i long, t long").repartition(3)
    got = timegrid.match_grid(df, "k", "t", ["i"], Fraction(S, 100), 49)
    assert rows(got, "k", "target_index", "target_ts", "batch_ts") == sorted([(k, *x) for k, xs in want.items() for x in xs], key=lambda r: tuple((x is None, str(x)) for x in r))


def test_grid_fails_beyond_the_most_targets(spark, monkeypatch):
    """No target is left out silently, in either form."""
    df = spark.createDataFrame([("r", 0, 0), ("r", 1, timegrid.MOST_TARGETS * S)], "k string, i long, t long")
    for tolerance in (0, S):
        with pytest.raises(Exception, match="exceeds safety limit"):
            timegrid.match_grid(df, "k", "t", ["i"], Fraction(1), tolerance).where("target_index > 9999998").collect()
    monkeypatch.setattr(timegrid, "MOST_TARGETS", 5)
    assert len(grid(spark, [0, 5 * S - 1], Fraction(1), 0)) == 5
    with pytest.raises(Exception, match="exceeds safety limit 5"):
        grid(spark, [0, 5 * S], Fraction(1), 0)
    assert len(timegrid.greedy_grid([0, 4 * S], Fraction(1), S - 1)) == 5
    with pytest.raises(ValueError, match="exceeds safety limit 5"):
        timegrid.greedy_grid([0, 4 * S], Fraction(1), S)


def test_grid_rejects_bad_input(spark):
    with pytest.raises(ValueError):
        timegrid.greedy_grid([1, 1], Fraction(2), 0)
    df = spark.createDataFrame([("r", 0, 1)], "k string, i long, t long")
    for fps, tolerance in ((Fraction(0), 1), (Fraction(2), -1), (Fraction(2 * S), 0)):
        with pytest.raises(ValueError):
            timegrid.match_grid(df, "k", "t", ["i"], fps, tolerance)
    twice = spark.createDataFrame([("r", 0, 1), ("r", 1, 50), ("r", 2, 50)], "k string, i long, t long")
    for tolerance in (0, S):
        with pytest.raises(Exception, match="duplicate batch timestamps"):
            timegrid.match_grid(twice, "k", "t", ["i"], Fraction(2), tolerance).collect()


def turned(axis, angle):
    q = [math.cos(angle / 2), 0.0, 0.0, 0.0]
    q[1 + axis] = math.sin(angle / 2)
    return q


def times(p, q):
    (a, b, c, d), (e, f, g, h) = p, q
    return [a * e - b * f - c * g - d * h, a * f + b * e + c * h - d * g, a * g - b * h + c * e + d * f, a * h + b * g - c * f + d * e]


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_scalar_goldens(spark):
    for angles in ((0.3, -1.1, 2.2), (-2.5, 0.4, 0.0), (0.0, 1.5, -3.0)):
        (q,) = one(spark, scalar.euler_quaternion(*map(F.lit, angles)))
        x, y, z = (turned(axis, angle) for axis, angle in enumerate(angles))
        assert q == pytest.approx(times(times(z, y), x), abs=1e-12)  # about x first, z last
    x, _ = one(spark, *scalar.mercator(F.lit(180.0), F.lit(0.0)))
    assert x == pytest.approx(20037508.342789, abs=1e-6)
    half = math.radians(179 / 2)
    ab = spark.createDataFrame([([math.cos(half), 0.0, 0.0, math.sin(half)], [math.cos(half), 0.0, 0.0, -math.sin(half)])], "a array<double>, b array<double>")
    (m,) = ab.select(scalar.slerp(F.col("a"), F.col("b"), F.lit(0.5))).first()
    assert abs(m[0]) < 1e-12 and abs(m[3]) == pytest.approx(1)
    assert one(spark, scalar.shortest_angle(F.lit(math.pi)), scalar.shortest_angle(F.lit(-math.pi))) == (math.pi, -math.pi)
    assert one(spark, scalar.round_half_away(F.lit(-2.5)), scalar.round_half_away(F.lit(2.5))) == (-3, 3)
    assert one(spark, scalar.half_up_target(F.lit(5), "0.5"), scalar.half_up_target(F.lit(3), "0.01"), scalar.half_up_target(F.lit(3), "0.99")) == (3, 0, 3)
    assert one(spark, scalar.quaternion(*map(F.lit, (0.0, 0.0, 0.0, 0.0)))) == (None,)
    assert one(spark, scalar.numeric_leaf(F.lit("18446744073709551615")), scalar.numeric_leaf(F.lit("01")), scalar.numeric_leaf(F.lit("-5"))) == (18446744073709551615.0, None, -5.0)
    assert one(spark, scalar.axis_angle_quaternion(*map(F.lit, (0.0, 0.0, 0.0)))) == ([1.0, 0.0, 0.0, 0.0],)


def test_paths_and_names(spark):
    data = [("a/b.mcap", True), ("/a.mcap", False), ("a/../b.mcap", False), ("", False), (None, False), ("a\\b", False), ("a/ b", False)]
    df = spark.createDataFrame(data, "p string, ok boolean")
    assert df.where(scalar.safe_relative_path(F.col("p")) != F.col("ok")).count() == 0
    assert one(spark, scalar.channel_name(F.lit("front-left")), scalar.channel_name(F.lit("cam_-x"))) == ("CAM_FRONT_LEFT", "CAM_X")


def test_segments_and_repository_paths(spark):
    good = [".hidden", "..a", "a" * 300, "console", "nulls.x", "COM0", "x y", "é", "漢", "lpt10.txt"]
    bad = [".", "..", "a.", "nul", "Con.tar.gz", "COM7", "lpt1.", "aux.json", " a", "a ", "a\u00a0", "a\u200b", "a\x07", "a:b", "a*", "a?b", 'a"', "a<b", "a|b", "a/b", "a\\b", "", None]
    df = spark.createDataFrame([(s, True) for s in good] + [(s, False) for s in bad], "p string, ok boolean")
    assert [r["p"] for r in df.where(scalar.safe_segment(F.col("p")) != F.col("ok")).collect()] == []
    files = [("data/a/b.mp4", True), ("data/x.tar", True), ("data/.json", False), ("data/nul.json", False), ("data/a.mcap", False), ("dat/a.json", False), ("data//a.json", False), ("data/a%20.json", False), ("data/./a.json", False), (None, False)]
    records = [("data/a/b.mcap", True), ("data/nul.mcap", True), ("data/../b.mcap", False), ("data/b.mcap/", False), ("data/a#b.mcap", False), ("/data/b.mcap", False), ("x/b.mcap", False), (None, False)]
    for cases, check in ((files, scalar.repo_file_path), (records, scalar.repo_recording_path)):
        df = spark.createDataFrame(cases, "p string, ok boolean")
        assert [r["p"] for r in df.where(check(F.col("p")) != F.col("ok")).collect()] == []


def test_blend_keeps_equal_values_and_takes_the_nearer_end(spark):
    df = spark.createDataFrame([({"n": "1", "same": "up", "far": "x", "left": "7"}, {"n": "3", "same": "up", "far": "y", "right": "8"})], "a map<string,string>, b map<string,string>")
    blend = lambda t: df.select(scalar.mapped_blend(F.col("a"), F.col("b"), F.lit(t)).alias("m")).first()["m"]
    assert blend(0.25) == {"n": "1.5", "same": "up", "far": "x"} and blend(0.5)["far"] == "y"


def test_partition_takes_null_runs_and_long_ones(spark, monkeypatch):
    stamps = sorted(random.Random(8).sample(range(100_000), 3000))
    data = [(k, t) for k in (None, 5, 2**53 + 1) for t in stamps]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        got = scenes.partition_runs(spark.createDataFrame(data, "k long, t long").repartition(3), ["k"], "t", 500, 50, 3, 40)
        scene, why = scenes.greedy_scenes(stamps, 500, 50, 3, 40)
        seen = {k: sorted((r["t"], r["scene"], r["unassigned"]) for r in got.where(F.col("k").eqNullSafe(F.lit(k))).collect()) for k in (None, 5, 2**53 + 1)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(rows_ == list(zip(stamps, scene, why, strict=True)) for rows_ in seen.values()) and max(x or 0 for x in scene) > 50


def test_islands_are_the_same_in_slices(spark):
    rng = random.Random(17)
    data = [(k, a, a + rng.randint(0, 60), i) for k in range(3) for i in range(200) for a in [rng.randint(0, 5000)]]
    df = spark.createDataFrame(data, "k int, a long, b long, i int")
    whole = rows(runs.merge_intervals(df, ["k"], "a", "b", ["i"]), "k", "i", "island")
    for width in (7, 400, 100_000):
        assert rows(runs.merge_intervals(df, ["k"], "a", "b", ["i"], slice_width=width), "k", "i", "island") == whole


def test_required_reference_and_sanity_errors_raise(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "b", 0)], "s int, c string, i int")
    assert rows(features.reference_observation(df.where("s = 1"), ["s"], "c", "i", "b", True), "s", "c", "fallback") == [(1, "b", False)]
    with pytest.raises(Exception, match="no a in sample 2"):
        features.reference_observation(df, ["s"], "c", "i", "a", True).collect()
    found = spark.createDataFrame([(1, "x", "warn")], "s int, code string, severity string")
    policy.require_sane(found)
    with pytest.raises(ValueError, match="sanity errors"):
        policy.require_sane(found.withColumn("severity", F.lit("error")))


def test_labels_with_a_key_twice_raise(spark):
    two = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k long, v string")
    frames = spark.createDataFrame([(1,), (2,)], "k long")
    assert labels.join_labels(two, frames.where("k = 1"), ["k"]).count() == 1  # what meets no frame is dropped unseen
    with pytest.raises(Exception, match="label key is not unique"):
        labels.join_labels(two, frames, ["k"]).collect()


def test_identities(spark):
    import hashlib
    import uuid

    (u,) = one(spark, identity.name_uuid(uuid.NAMESPACE_URL.hex, F.lit("zürich/1")))
    assert u == str(uuid.uuid5(uuid.NAMESPACE_URL, "zürich/1"))
    text = 'a"b\\c\nd\té'
    (j,) = one(spark, identity.json_object(b=identity.json_string(F.lit(text)), a=F.lit(3)))
    assert j == identity.canonical_json({"a": 3, "b": text})
    (g,) = one(spark, identity.git_blob_id(F.lit(b"hello\n")))
    assert g == hashlib.sha1(b"blob 6\0hello\n").hexdigest()


def test_gap_is_strict_and_slices_agree(spark):
    df = spark.createDataFrame([("r", t) for t in (0, 10, 20, 31, 100, 110)], "k string, t long")
    got = {r["t"]: r["run_id"] for r in runs.gap_runs(df, ["k"], "t", 10).collect()}
    assert got == {0: 0, 10: 0, 20: 0, 31: 1, 100: 2, 110: 2}
    rng = random.Random(2)
    big = spark.createDataFrame([(k, t) for k in range(5) for t in rng.sample(range(-500, 3000), 200)], "k long, t long")
    for width in (7, 50, 5000):
        assert rows(runs.gap_runs(big, ["k"], "t", 9, slice_width=width), "k", "t", "run_id") == rows(runs.gap_runs(big, ["k"], "t", 9), "k", "t", "run_id")


def test_bracket_sides_and_slices(spark):
    rng = random.Random(3)
    samples = spark.createDataFrame([(k, t, float(t)) for k in range(4) for t in rng.sample(range(0, 1000), 30)], "k long, t long, v double")
    asked = spark.createDataFrame([(i, rng.randrange(5), rng.randrange(-50, 1100)) for i in range(300)], "id long, k long, t long")
    by = {k: sorted(r["t"] for r in samples.collect() if r["k"] == k) for k in range(5)}
    want = []
    for r in asked.collect():
        below, above = [t for t in by[r["k"]] if t <= r["t"]], [t for t in by[r["k"]] if t >= r["t"]]
        want.append((r["id"], below[-1] if below else None, above[0] if above else None))
    for width in (None, 10, 400):
        got = asof.bracket(asked.repartition(3), samples, ["k"], "t", ["v"], width)
        assert sorted((r["id"], r["before"] and r["before"]["ts"], r["after"] and r["after"]["ts"]) for r in got.collect()) == sorted(want)


def test_nearest_tie_goes_to_the_earlier(spark):
    samples = spark.createDataFrame([("r", 0), ("r", 10)], "k string, t long")
    found = asof.bracket(spark.createDataFrame([("r", 5), ("r", 6)], "k string, t long"), samples, ["k"], "t", [])
    assert rows(found.select("t", asof.nearest(F.col("t"), F.col("before"), F.col("after"))["ts"])) == [(5, 0), (6, 10)]


def test_features_golden(spark):
    df = spark.createDataFrame([("s", t * S, x, 0.0, 0.0) for t, x in ((0, 0.0), (1, 10.0), (3, 20.0))] + [("one", 0, 1.0, 1.0, 0.0)], "scene string, t long, x double, y double, h double")
    seg = features.segments(df.repartition(2), ["scene"], "t", "x", "y", "h", 0.1)
    got = {r["scene"]: r for r in features.scene_features(seg, ["scene"], "t").collect()}
    s = got["s"]
    assert (s["total_distance"], s["duration_s"], s["mean_speed"], s["first_speed"], s["last_speed"]) == (20.0, 3.0, 7.5, 10.0, 5.0)
    assert s["time_weighted_speed"] == pytest.approx(20 / 3) and s["scene_valid_ratio"] == 1.0
    assert all(got["one"][c] == 0 for c in ("total_distance", "duration_s", "mean_speed", "max_speed", "net_turn"))
    assert [r["observation_stationary"] for r in seg.where("scene = 'one'").collect()] == [True]


def test_greedy_scene_bounds():
    scene, why = scenes.greedy_scenes([0, 5, 10, 11, 12, 30, 31], longest=10, shortest=2, least=2, skip=2)
    assert scene == [0, 0, 0, None, None, None, None]
    assert why == [None, None, None, "inter_scene_skip", *["candidate_too_short"] * 3]


def test_hybrid_keeps_windows_apart(spark):
    df = spark.createDataFrame([("r", t) for t in range(10)], "k string, t long")
    windows = spark.createDataFrame([("r", 0, 0, 4, 5)], "k string, run_id long, window long, first long, last long")
    got = {r["t"]: (r["kind"], r["scene_first"]) for r in scenes.build_scenes(df, "k", "t", "hybrid", 3, 100, 1, 2, 0, windows).collect()}
    assert got == {**{t: ("automatic", 0) for t in range(4)}, **{t: ("annotation", 4) for t in (4, 5)}, **{t: ("automatic", 6) for t in range(6, 10)}}
    only = scenes.build_scenes(df, "k", "t", "annotation_only", 3, 100, 1, 2, 0, windows)
    assert only.where("unassigned = 'annotation_mode_excluded'").count() == 8


def test_annotation_decisions(spark):
    samples = spark.createDataFrame([("a", 10, True), ("a", 20, False), ("b", 5, False)], "k string, t long, valid boolean")
    notes = spark.createDataFrame([("a", 13), ("a", 30), ("b", 5), ("zz", 1)], "k string, t long")
    got = scenes.match_annotations(notes, samples, "k", "t", 3)
    assert rows(got, "k", "t", "decision") == [("a", 13, "matched"), ("a", 30, "outside_tolerance"), ("b", 5, "no_valid_samples"), ("zz", 1, "different_recording")]


def test_filter_keeps_all_reasons_and_bounds_are_inclusive(spark):
    df = spark.createDataFrame([("a", 10.0, ["moving"], {"F": 1.0}), ("b", 9.9, ["x"], {})], "s string, d double, tags array<string>, coverage map<string,double>")
    f = policy.SceneFilter(ranges={"d": (10.0, 10.0)}, sets={"tags": (["moving"], [], ["x"])}, min_channel_coverage={"F": 0.5})
    ok, bad = policy.filter_scenes(df, f)
    assert rows(ok, "s") == [("a",)]
    assert [r["code"] for r in bad.first()["reasons"]] == ["d_below_minimum", "channel_coverage_below_minimum", "tags_missing_any", "tags_excluded"]


def test_selection_is_exact_and_ordered(spark):
    df = spark.createDataFrame([(f"s{i}", f"d{i % 3}", i) for i in range(50)], "token string, source string, n long")
    src = identity.json_object(digest=identity.json_string(F.col("source")))
    rules = [("even", 5, F.col("n") % 2 == 0), ("all", 60, F.lit(True))]
    a, audit = selection.select_quotas(df, ["token", "source"], rules, 1, src)
    b, _ = selection.select_quotas(df.orderBy(F.rand()).repartition(5), ["token", "source"], rules, 1, src)
    assert rows(a) == rows(b)
    assert rows(audit, "rule_index", "matched", "eligible", "selected", "deficit") == [(0, 25, 25, 5, 0), (1, 50, 45, 45, 15)]
    assert a.where("selected").select("token").distinct().count() == 50
    with pytest.raises(selection.QuotaError):
        selection.select_quotas(df, ["token", "source"], rules, 1, src, strict=True)


def test_apportion_keeps_its_promises():
    rng = random.Random(12)
    for _ in range(400):
        sizes = {f"s{i}": rng.choice([1, 1, 2, 3, 5, 20]) for i in range(rng.randint(1, 6))}
        fraction = rng.choice(["0.05", "0.2", "0.5", "0.9", "0.33"])
        n, seed = sum(sizes.values()), rng.randint(0, 99)
        test = selection.apportion(sizes, fraction, seed)
        target = math.floor(n * Fraction(fraction) + Fraction(1, 2))
        assert sum(test.values()) == target and all(0 <= test[s] <= sizes[s] for s in sizes)
        assert test == selection.apportion(dict(reversed(sizes.items())), fraction, seed)
        for have in (test, {s: sizes[s] - test[s] for s in sizes}):
            if any(sizes[s] > 1 and not have[s] for s in sizes):  # a side is missing only where no stratum can spare one
                assert not any(have[s] > (sizes[s] > 1) for s in sizes) or have is test


def test_cutoffs_end_each_quota(spark):
    df = spark.createDataFrame([(i % 3, f"{i * 7919 % 65536:04x}{i:02x}", i) for i in range(60)] + [(9, "00ff", 1), (9, "00ff", 0)], "g int, rank string, t int")
    quota = {0: 5, 1: 20, 2: 99, 9: 1}
    got = selection.cutoffs(df, F.col("g"), "rank", ["t"], quota)
    for g, n in quota.items():
        order = sorted((r["rank"], r["t"]) for r in df.where(F.col("g") == g).collect())
        assert got[g] == (order[n - 1] if n <= len(order) else None)


def test_split_is_complete_and_stable(spark):
    df = spark.createDataFrame([(f"s{i}", "d", "x") for i in range(5)], "token string, source string, g string")
    out, audit = selection.split_scenes(df, "token", "source", "0.5", 7)
    assert audit.select("test", "train").first() == (3, 2)
    again, _ = selection.split_scenes(df.orderBy(F.desc("token")), "token", "source", "0.5", 7)
    assert rows(out, "token", "split") == rows(again, "token", "split")
    _, tiny = selection.split_scenes(df.limit(0), "token", "source", "0.5", 7)
    assert tiny.count() == 0


def test_overlap_is_half_open_on_the_window_and_closed_on_the_scene(spark):
    w = spark.createDataFrame([("r", 10, 20)], "k string, a long, b long")
    s = spark.createDataFrame([("r", 0, 10, 0, "touch"), ("r", 20, 30, 1, "after"), ("r", 15, 40, 2, "in")], "k string, f long, l long, o long, token string")
    for width in (3, 100):
        got = labels.windows_to_scenes(w, s, ["k"], "a", "b", "f", "l", "o", "token", width)
        assert got.first()["scene_tokens"] == ["touch", "in"]


def test_constraints(spark):
    df = spark.createDataFrame([(0.4, 0.6), (0.4, None), (None, None), (0.4, 0.7)], "a double, b double")
    assert [r[0] for r in df.select(labels.probabilities_ok(["a", "b"])).collect()] == [True, False, True, False]
    with pytest.raises(ValueError, match="2 rows"):
        labels.require(df, F.col("b").isNotNull(), "b is missing")
    assert labels.mask_layers(df, {"x": ["b"]}, ["camera_scalar"], "camera_scalar").where("b is not null").count() == 0
    assert labels.mask_layers(df, {"x": ["b"]}, ["x"], "camera_scalar").count() == 0


def test_chain_mutations_are_found(spark):
    base = runs.chain_links(spark.createDataFrame([("s", f"t{i}", i) for i in range(5)], "scene string, token string, t long"), ["scene"], ["t"], "token")
    check = lambda d: {r["fault"] for r in integrity.chain_faults(d, ["scene"], "token", "prev", "next", "t").collect()}
    assert check(base) == set()
    assert check(base.withColumn("prev", F.when(F.col("t") == 2, "t4").otherwise(F.col("prev")))) == {"prev_mismatch"}
    assert check(base.withColumn("next", F.when(F.col("t") == 4, "t0").otherwise(F.col("next")))) == {"next_mismatch"}
    assert "order_not_increasing" in check(base.withColumn("t", F.lit(1)))


def test_forbidden_json(spark):
    import json

    deep: object = "1999-99-99"
    for _ in range(30):
        deep = {"k": [deep]}
    texts = [json.dumps({"GPSWeek": 1, "gpsWeek": 2, "latency": 3}), json.dumps([json.dumps({"lon": {}})]), json.dumps(deep), "plain 2001-02-03", "{broken", None, "[]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    got = [(r["id"], r["path"], r["finding"]) for r in integrity.forbidden_json(df, ["id"], "t").orderBy("id").collect()]
    assert got == [(0, "root.gpsWeek", "forbidden_name"), (1, "root[0].lon", "forbidden_name"), (2, "root" + ".k[0]" * 30, "iso_date"), (3, "root", "iso_date")]


def test_forbidden_columns(spark):
    df = spark.createDataFrame([], "a long, logTimeOfDayNs long, s struct<utc:long, xs:array<struct<publish_date:string>>>, update long")
    assert integrity.forbidden_columns(df) == ["logTimeOfDayNs", "s.utc", "s.xs[].publish_date"]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "k string, t long, valid boolean")
    assert runs.gap_runs(df, ["k"], "t", 1).count() == 0
    assert asof.bracket(df.select("k", "t"), df, ["k"], "t", []).count() == 0
    assert scenes.partition_runs(df, ["k"], "t", 1, 1, 1).count() == 0
    assert timegrid.match_grid(df.withColumn("i", F.lit(0)), "k", "t", ["i"], Fraction(1), 0).count() == 0
