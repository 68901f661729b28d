"""One query an operator over the driver's tables, each beside the SQL it must equal.

``events`` stands for recordings: user_id is the recording, event_type the
channel, ts the time (as nanoseconds) and value a position.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import identity, scalar, trees
from ..operators import asof, features, integrity, labels, policy, runs, scenes, selection, timegrid
from ..sinks import publish
from ..sources import manifests

HOUR = 3_600_000_000_000
DAY = 24 * HOUR
NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"  # the URL namespace of RFC 4122
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_EV = "ev AS (SELECT event_id, user_id, event_type, value, props, epoch_us(ts) * 1000 AS ts_ns FROM events)"
_RUNS = f"""{_EV},
 step AS (SELECT *, CASE WHEN ts_ns - lag(ts_ns) OVER (PARTITION BY user_id ORDER BY ts_ns) > {DAY} THEN 1 ELSE 0 END AS nw FROM ev),
 run AS (SELECT * EXCLUDE (nw), CAST(sum(nw) OVER (PARTITION BY user_id ORDER BY ts_ns) AS BIGINT) AS run_id FROM step)"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _us(column: str) -> str:
    return f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {column})"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props", F.expr(f"{_us('ts')} * 1000").alias("ts_ns"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.gap_runs(events(spark, sf_dir), ["user_id"], "ts_ns", DAY)


@query(f"WITH {_RUNS} SELECT event_id, user_id, ts_ns, run_id FROM run")
def gap_runs(spark, sf_dir):
    return sessions(spark, sf_dir).select("event_id", "user_id", "ts_ns", "run_id")


@query(SQL["gap_runs"])
def gap_runs_sliced(spark, sf_dir):
    found = runs.gap_runs(events(spark, sf_dir), ["user_id"], "ts_ns", DAY, slice_width=10 * DAY)
    return found.select("event_id", "user_id", "ts_ns", "run_id")


@query(f"""WITH {_EV}, d AS (SELECT event_id, user_id, event_type, ts_ns - lag(ts_ns) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS delta FROM ev)
SELECT event_id, user_id, event_type, delta, coalesce(delta <= 0, false) AS non_monotonic, coalesce(delta > {2 * DAY}, false) AS gap_exceeded FROM d""")
def timeline_observations(spark, sf_dir):
    found = runs.timeline_observations(events(spark, sf_dir), ["user_id", "event_type"], "ts_ns", ["event_id"], 2 * DAY)
    return found.select("event_id", "user_id", "event_type", "delta", "non_monotonic", "gap_exceeded")


STATIONARY = 0.001
_SEG = f"""{_RUNS},
 d AS (SELECT *, (ts_ns - lag(ts_ns) OVER w) / 1e9 AS dt, value - lag(value) OVER w AS dx, value / 2 - lag(value / 2) OVER w AS dy, value / 10 - lag(value / 10) OVER w AS dh
       FROM run WINDOW w AS (PARTITION BY user_id, run_id ORDER BY ts_ns)),
 g AS (SELECT *, sqrt(dx * dx + dy * dy) AS distance, sqrt(dx * dx + dy * dy) / dt AS speed, (dh + pi()) - 2 * pi() * floor((dh + pi()) / (2 * pi())) - pi() AS turn FROM d),
 seg AS (SELECT *, speed <= {STATIONARY} AS stationary, lag(speed <= {STATIONARY}) OVER (PARTITION BY user_id, run_id ORDER BY ts_ns) AS was FROM g),
 feat AS (SELECT user_id, run_id, count(*) AS n_samples, coalesce(sum(dt), 0) AS duration_s, coalesce(sum(distance), 0) AS total_distance,
   coalesce(avg(speed), 0) AS mean_speed, coalesce(median(speed), 0) AS median_speed, coalesce(max(speed), 0) AS max_speed,
   coalesce(arg_min(speed, ts_ns) FILTER (speed IS NOT NULL), 0) AS first_speed, coalesce(arg_max(speed, ts_ns) FILTER (speed IS NOT NULL), 0) AS last_speed,
   count(*) FILTER (NOT was AND stationary) AS stopping_count, count(*) FILTER (was AND NOT stationary) AS starting_count,
   coalesce(sum(dt) FILTER (stationary), 0) AS stationary_s, count(*) FILTER (NOT stationary) AS moving_segments,
   coalesce(sum(turn), 0) AS net_turn, coalesce(sum(abs(turn)), 0) AS total_turn, avg(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS gnss_ratio, count(DISTINCT event_type) / 5.0 AS coverage_ratio
   FROM seg GROUP BY user_id, run_id)"""
_TAGS = """concat_ws(',', list_aggregate(list_sort(list_filter([
   CASE WHEN total_distance >= 50 AND moving_segments > 0 THEN 'moving' ELSE 'stationary' END,
   CASE WHEN stopping_count > 0 THEN 'stopping' END, CASE WHEN starting_count > 0 THEN 'starting' END,
   CASE WHEN degrees(abs(net_turn)) <= 10 THEN 'straight'
        WHEN degrees(abs(net_turn)) >= 45 THEN CASE WHEN net_turn > 0 THEN 'left' ELSE 'right' END || '_turn'
        WHEN degrees(abs(net_turn)) >= 15 THEN CASE WHEN net_turn > 0 THEN 'left' ELSE 'right' END || '_curvature' END,
   CASE WHEN gnss_ratio = 1 THEN 'gnss_valid' WHEN gnss_ratio = 0 THEN 'gnss_invalid' ELSE 'gnss_partial' END,
   CASE WHEN coverage_ratio = 1 THEN 'camera_coverage_complete' ELSE 'camera_coverage_partial' END], lambda x: x IS NOT NULL)), 'string_agg', ','))"""


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a run of events: features, ratios and tags."""
    s = sessions(spark, sf_dir).withColumns({"x": F.col("value"), "y": F.col("value") / 2, "heading": F.col("value") / 10})
    segmented = features.segments(s, ["user_id", "run_id"], "ts_ns", "x", "y", "heading", STATIONARY)
    shares = {"gnss_ratio": F.avg((F.col("value") > 20).cast("int")), "coverage_ratio": F.size(F.collect_set("event_type")) / 5}  # a rig has few channels
    f = features.scene_features(segmented, ["user_id", "run_id"], "ts_ns", shares)
    c = F.col
    tags = features.computed_tags(c("total_distance"), c("moving_segments"), c("net_turn"), c("stopping_count"), c("starting_count"), c("gnss_ratio"), c("coverage_ratio"), minimum_movement=50.0)
    return f.withColumn("tags", tags)


_NUMBERS = ["duration_s", "total_distance", "mean_speed", "median_speed", "max_speed", "first_speed", "last_speed", "stationary_s", "net_turn", "total_turn"]
_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in _NUMBERS)


@query(f"WITH {_SEG} SELECT user_id, run_id, n_samples, stopping_count, starting_count, moving_segments, {_ROUNDED} FROM feat")
def scene_features(spark, sf_dir):
    f = featured(spark, sf_dir)
    return f.select("user_id", "run_id", "n_samples", "stopping_count", "starting_count", "moving_segments", *(F.round(c, 6).alias(c) for c in _NUMBERS))


@query(f"WITH {_SEG} SELECT event_id, round(dt, 6) AS dt, round(distance, 6) AS distance, round(coalesce(sum(distance) OVER (PARTITION BY user_id, run_id ORDER BY ts_ns), 0), 6) AS cumulative_distance, round(turn, 6) AS turn FROM seg")
def segment_metrics(spark, sf_dir):
    s = sessions(spark, sf_dir).withColumns({"x": F.col("value"), "y": F.col("value") / 2, "heading": F.col("value") / 10})
    g = features.segments(s, ["user_id", "run_id"], "ts_ns", "x", "y", "heading", STATIONARY)
    return g.select("event_id", *(F.round(c, 6).alias(c) for c in ("dt", "distance", "cumulative_distance", "turn")))


@query(f"WITH {_SEG} SELECT user_id, run_id, {_TAGS} AS tags FROM feat")
def computed_tags(spark, sf_dir):
    return featured(spark, sf_dir).select("user_id", "run_id", F.array_join("tags", ",").alias("tags"))


FILTER = policy.SceneFilter(
    ranges={"duration_s": (3600.0, 400000.0), "gnss_ratio": (0.5, None), "total_distance": (10.0, None)},
    sets={"tags": (["moving", "stopping"], ["gnss_partial"], ["straight"])},
    blacklists={"user_id": [7, 11]},
)
_REASONS = """concat_ws(',', CASE WHEN duration_s < 3600 THEN 'duration_s_below_minimum' END, CASE WHEN duration_s > 400000 THEN 'duration_s_above_maximum' END,
  CASE WHEN gnss_ratio < 0.5 THEN 'gnss_ratio_below_minimum' END, CASE WHEN total_distance < 10 THEN 'total_distance_below_minimum' END,
  CASE WHEN NOT (list_contains(t, 'moving') OR list_contains(t, 'stopping')) THEN 'tags_missing_any' END,
  CASE WHEN NOT list_contains(t, 'gnss_partial') THEN 'tags_missing_required' END, CASE WHEN list_contains(t, 'straight') THEN 'tags_excluded' END,
  CASE WHEN user_id IN (7, 11) THEN 'user_id_blacklisted' END)"""


@query(f"WITH {_SEG}, tagged AS (SELECT *, string_split({_TAGS}, ',') AS t FROM feat) SELECT user_id, run_id, {_REASONS} AS reasons FROM tagged")
def scene_filter(spark, sf_dir):
    f = featured(spark, sf_dir).withColumn("reasons", policy.rejection_reasons(FILTER))
    return f.select("user_id", "run_id", F.array_join(F.transform("reasons", lambda r: r["code"]), ",").alias("reasons"))


@query(f"""WITH {_EV}, span AS (SELECT user_id, arg_min(ts_ns, event_id) AS anchor, max(ts_ns) AS fin FROM ev GROUP BY user_id),
 grid AS (SELECT user_id, unnest(generate_series(0, (fin + {6 * HOUR} - anchor) // {DAY})) AS target_index, anchor FROM span),
 t AS (SELECT user_id, CAST(target_index AS BIGINT) AS target_index, CAST(anchor + target_index * {DAY} AS BIGINT) AS target_ts FROM grid),
 m AS (SELECT t.*, ev.ts_ns AS batch_ts, ev.ts_ns - target_ts AS error, row_number() OVER (PARTITION BY t.user_id, target_index ORDER BY abs(ev.ts_ns - target_ts), ev.ts_ns) AS r
       FROM t LEFT JOIN ev ON ev.user_id = t.user_id AND ev.ts_ns BETWEEN target_ts - {6 * HOUR} AND target_ts + {6 * HOUR})
SELECT user_id, target_index, target_ts, batch_ts, error FROM m WHERE r = 1""")
def grid_match(spark, sf_dir):
    return timegrid.match_grid(events(spark, sf_dir), "user_id", "ts_ns", ["event_id"], Fraction(1, 86400), 6 * HOUR)


@query(f"""WITH RECURSIVE {_EV}, span AS (SELECT user_id, arg_min(ts_ns, event_id) AS anchor, max(ts_ns) AS fin, list(ts_ns) AS bs FROM ev GROUP BY user_id),
 w AS (SELECT user_id, CAST(-1 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS target_ts, CAST(NULL AS BIGINT) AS batch_ts, bs AS free, anchor, fin FROM span UNION ALL
  SELECT user_id, i + 1, t, pick, CASE WHEN pick IS NULL THEN free ELSE list_filter(free, lambda x: x <> pick) END, anchor, fin
  FROM (SELECT *, list_sort(list_transform(list_filter(free, lambda x: abs(x - t) <= {18 * HOUR}), lambda x: struct_pack(d := abs(x - t), x := x)))[1].x AS pick FROM (SELECT *, anchor + (i + 1) * {DAY} AS t FROM w) y) z
  WHERE t <= fin + {18 * HOUR})
SELECT user_id, i AS target_index, target_ts, batch_ts, batch_ts - target_ts AS error FROM w WHERE i >= 0""")
def grid_match_greedy(spark, sf_dir):
    return timegrid.match_grid(events(spark, sf_dir), "user_id", "ts_ns", ["event_id"], Fraction(1, 86400), 18 * HOUR)


@query(f"""WITH {_EV}, p AS (SELECT * FROM ev WHERE event_type = 'purchase'), c AS (SELECT * FROM ev WHERE event_type = 'click'),
 b AS (SELECT p.event_id, p.user_id, p.ts_ns, c.ts_ns AS before_ts, c.value AS bv FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts_ns >= c.ts_ns),
 a AS (SELECT b.*, c.ts_ns AS after_ts, c.value AS av FROM b ASOF LEFT JOIN c ON b.user_id = c.user_id AND b.ts_ns <= c.ts_ns)
SELECT event_id, before_ts, after_ts, round((ts_ns - before_ts) / (after_ts - before_ts), 6) AS fraction, round(bv + (av - bv) * ((ts_ns - before_ts) / (after_ts - before_ts)), 6) AS value,
 before_ts IS NOT NULL AND after_ts IS NOT NULL AS available FROM a""")
def bracket_interpolate(spark, sf_dir):
    return _bracketed(spark, sf_dir, None)


@query(SQL["bracket_interpolate"])
def bracket_interpolate_sliced(spark, sf_dir):
    return _bracketed(spark, sf_dir, 5 * DAY)


def _bracketed(spark, sf_dir, slice_width):
    ev = events(spark, sf_dir)
    asked = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts_ns")
    found = asof.bracket(asked, ev.where("event_type = 'click'"), ["user_id"], "ts_ns", ["value"], slice_width)
    t = asof.fraction(F.col("ts_ns"), F.col("before"), F.col("after"))
    value = scalar.lerp(F.col("before.value"), F.col("after.value"), t)
    there = F.col("before").isNotNull() & F.col("after").isNotNull()
    return found.select("event_id", F.col("before.ts").alias("before_ts"), F.col("after.ts").alias("after_ts"), F.round(t, 6).alias("fraction"), F.round(value, 6).alias("value"), there.alias("available"))


@query(f"""WITH {_EV}, p AS (SELECT * FROM ev WHERE event_type = 'purchase'), c AS (SELECT * FROM ev WHERE event_type = 'click'),
 b AS (SELECT p.event_id, p.user_id, p.ts_ns, c.ts_ns AS bt, c.value AS bv FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts_ns >= c.ts_ns),
 a AS (SELECT b.*, c.ts_ns AS aft, c.value AS av FROM b ASOF LEFT JOIN c ON b.user_id = c.user_id AND b.ts_ns <= c.ts_ns)
SELECT event_id, CASE WHEN bt IS NOT NULL AND aft IS NOT NULL AND bv > 5 AND av > 5 THEN 'available' WHEN bt IS NOT NULL AND aft IS NOT NULL THEN 'invalid_endpoint' ELSE 'no_bracket' END AS status,
 CASE WHEN bt IS NOT NULL AND aft IS NOT NULL AND bv > 5 AND av > 5 THEN round(bv + (av - bv) * ((ts_ns - bt) / (aft - bt)), 6) END AS value FROM a""")
def barrier_interpolate(spark, sf_dir, slice_width=None):
    """Invalid samples are kept as barriers: no interpolation across one."""
    ev = events(spark, sf_dir).withColumn("ok", F.col("value") > 5)
    asked = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts_ns")
    found = asof.barrier_interpolate(asked, ev.where("event_type = 'click'"), ["user_id"], "ts_ns", "ok", ["value"], slice_width)
    return found.select("event_id", "status", F.round("value", 6).alias("value"))


@query(SQL["barrier_interpolate"])
def barrier_interpolate_sliced(spark, sf_dir):
    return barrier_interpolate(spark, sf_dir, 3 * DAY)


@query(f"""WITH {_EV}, p AS (SELECT *, CASE WHEN event_id % 50 = 0 THEN user_id + 100000 ELSE user_id END AS rec FROM ev WHERE event_type = 'purchase'),
 c AS (SELECT user_id AS rec, ts_ns, event_id % 7 <> 0 AS valid FROM ev WHERE event_type = 'click'), v AS (SELECT * FROM c WHERE valid),
 b AS (SELECT p.event_id, p.rec, p.ts_ns, v.ts_ns AS bt FROM p ASOF LEFT JOIN v ON p.rec = v.rec AND p.ts_ns >= v.ts_ns),
 a AS (SELECT b.*, v.ts_ns AS aft FROM b ASOF LEFT JOIN v ON b.rec = v.rec AND b.ts_ns <= v.ts_ns),
 n AS (SELECT *, CASE WHEN aft IS NULL OR ts_ns - bt <= aft - ts_ns THEN bt ELSE aft END AS nearest_ts FROM a)
SELECT event_id, nearest_ts, nearest_ts - ts_ns AS error, CASE WHEN rec NOT IN (SELECT rec FROM c) THEN 'different_recording' WHEN nearest_ts IS NULL THEN 'no_valid_samples'
 WHEN abs(nearest_ts - ts_ns) > {6 * HOUR} THEN 'outside_tolerance' ELSE 'matched' END AS decision FROM n""")
def annotation_match(spark, sf_dir, slice_width=None):
    ev = events(spark, sf_dir)
    notes = ev.where("event_type = 'purchase'").select("event_id", F.when(F.col("event_id") % 50 == 0, F.col("user_id") + 100000).otherwise(F.col("user_id")).alias("rec"), "ts_ns")
    samples = ev.where("event_type = 'click'").select(F.col("user_id").alias("rec"), "ts_ns", (F.col("event_id") % 7 != 0).alias("valid"))
    return scenes.match_annotations(notes, samples, "rec", "ts_ns", 6 * HOUR, slice_width=slice_width).select("event_id", F.col("nearest.ts").alias("nearest_ts"), "error", "decision")


@query(SQL["annotation_match"])
def annotation_match_sliced(spark, sf_dir):
    return annotation_match(spark, sf_dir, 3 * DAY)


@query(f"""WITH RECURSIVE {_RUNS},
 w AS (SELECT user_id, run_id, ts_ns, max(ts_ns) OVER r AS e, count(*) OVER r AS n FROM run
       WINDOW r AS (PARTITION BY user_id, run_id ORDER BY ts_ns RANGE BETWEEN CURRENT ROW AND {2 * DAY} FOLLOWING)),
 k AS (SELECT *, e - ts_ns >= {HOUR} AND n >= 3 AS kept FROM w),
 nx AS (SELECT k.*, (SELECT min(j.ts_ns) FROM run j WHERE j.user_id = k.user_id AND j.run_id = k.run_id AND j.ts_ns > k.e AND (NOT k.kept OR j.ts_ns >= k.e + {6 * HOUR})) AS nxt FROM k),
 walk AS (SELECT * FROM nx WHERE ts_ns = (SELECT min(j.ts_ns) FROM run j WHERE j.user_id = nx.user_id AND j.run_id = nx.run_id)
          UNION ALL SELECT nx.* FROM walk JOIN nx ON nx.user_id = walk.user_id AND nx.run_id = walk.run_id AND nx.ts_ns = walk.nxt),
 num AS (SELECT *, row_number() OVER (PARTITION BY user_id, run_id ORDER BY ts_ns) - 1 AS scene FROM walk WHERE kept),
 part AS (SELECT r.user_id, r.run_id, r.ts_ns, s.ts_ns AS start_ts, s.e, s.kept FROM run r ASOF JOIN walk s ON r.user_id = s.user_id AND r.run_id = s.run_id AND r.ts_ns >= s.ts_ns)
SELECT part.user_id, part.run_id, part.ts_ns, num.scene, CASE WHEN num.scene IS NOT NULL THEN NULL WHEN part.kept THEN 'inter_scene_skip' ELSE 'candidate_too_short' END AS unassigned
FROM part LEFT JOIN num ON num.user_id = part.user_id AND num.run_id = part.run_id AND num.ts_ns = part.start_ts AND part.ts_ns <= part.e""")
def scene_partition(spark, sf_dir):
    return scenes.partition_runs(sessions(spark, sf_dir), ["user_id", "run_id"], "ts_ns", 2 * DAY, HOUR, 3, 6 * HOUR)


_WIN = f"""{_RUNS}, span AS (SELECT user_id, run_id, min(ts_ns) AS rf, max(ts_ns) AS rl FROM run GROUP BY user_id, run_id),
 cand AS (SELECT run.user_id, run.run_id, event_id AS line, event_type, greatest(ts_ns - {3 * HOUR}, rf) AS first, least(ts_ns + {5 * HOUR}, rl) AS last
          FROM run JOIN span ON run.user_id = span.user_id AND run.run_id = span.run_id WHERE event_id % 4 = 0),
 isl AS (SELECT *, CASE WHEN first > max(last) OVER (PARTITION BY user_id, run_id ORDER BY first, last, line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS nw FROM cand),
 isl2 AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY user_id, run_id ORDER BY first, last, line ROWS UNBOUNDED PRECEDING) AS BIGINT) AS win FROM isl),
 lab AS (SELECT user_id, run_id, win, event_type, min(line) AS line0 FROM isl2 GROUP BY ALL),
 win AS (SELECT user_id, run_id, win, min(first) AS first, max(last) AS last, count(*) AS n_lines FROM isl2 GROUP BY user_id, run_id, win)"""


def windows(spark: SparkSession, sf_dir: str, slice_width: int | None = None) -> DataFrame:
    s = sessions(spark, sf_dir)
    spans = s.groupBy("user_id", "run_id").agg(F.min("ts_ns").alias("run_first"), F.max("ts_ns").alias("run_last"))
    notes = s.where("event_id % 4 = 0").select("user_id", "run_id", F.col("ts_ns").alias("anchor"), F.col("event_id").alias("line"), F.array("event_type").alias("names"))
    return scenes.annotation_windows(notes, spans, ["user_id", "run_id"], "anchor", "line", "names", 3 * HOUR, 5 * HOUR, slice_width)


@query(f"""WITH {_WIN} SELECT w.user_id, w.run_id, w.win AS "window", w.first, w.last, w.n_lines, (SELECT string_agg(event_type, ',' ORDER BY line0) FROM lab l WHERE l.user_id = w.user_id AND l.run_id = w.run_id AND l.win = w.win) AS labels FROM win w""")
def annotation_windows(spark, sf_dir, slice_width=None):
    return windows(spark, sf_dir, slice_width).select("user_id", "run_id", "window", "first", "last", F.size("lines").cast("long").alias("n_lines"), F.array_join("labels", ",").alias("labels"))


@query(SQL["annotation_windows"])
def annotation_windows_sliced(spark, sf_dir):
    return annotation_windows(spark, sf_dir, 2 * DAY)


@query(f"""WITH {_WIN} SELECT run.event_id, w.win AS "window" FROM run JOIN win w ON run.user_id = w.user_id AND run.run_id = w.run_id AND run.ts_ns BETWEEN w.first AND w.last""")
def window_samples(spark, sf_dir):
    s, w = sessions(spark, sf_dir), windows(spark, sf_dir).select("user_id", "run_id", "window", "first", "last")
    return scenes.window_samples(s, w, ["user_id", "run_id"], "ts_ns", 12 * HOUR).select("event_id", "window")


@query(f"""WITH RECURSIVE {_WIN},
 tk AS (SELECT run.user_id, run.run_id, run.ts_ns, w.win FROM run LEFT JOIN win w ON run.user_id = w.user_id AND run.run_id = w.run_id AND run.ts_ns BETWEEN w.first AND w.last),
 pt AS (SELECT *, sum(CASE WHEN was THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, run_id ORDER BY ts_ns) AS part FROM (SELECT *, coalesce(lag(win IS NOT NULL) OVER (PARTITION BY user_id, run_id ORDER BY ts_ns), false) AS was FROM tk)),
 fr AS (SELECT user_id, run_id, part, ts_ns FROM pt WHERE win IS NULL),
 fw AS (SELECT *, max(ts_ns) OVER r AS e, count(*) OVER r AS n FROM fr WINDOW r AS (PARTITION BY user_id, run_id, part ORDER BY ts_ns RANGE BETWEEN CURRENT ROW AND {2 * DAY} FOLLOWING)),
 fk AS (SELECT *, e - ts_ns >= {HOUR} AND n >= 3 AS kept FROM fw),
 fx AS (SELECT fk.*, (SELECT min(j.ts_ns) FROM fr j WHERE j.user_id = fk.user_id AND j.run_id = fk.run_id AND j.part = fk.part AND j.ts_ns > fk.e AND (NOT fk.kept OR j.ts_ns >= fk.e + {6 * HOUR})) AS nxt FROM fk),
 walk AS (SELECT * FROM fx WHERE ts_ns = (SELECT min(j.ts_ns) FROM fr j WHERE j.user_id = fx.user_id AND j.run_id = fx.run_id AND j.part = fx.part)
          UNION ALL SELECT fx.* FROM walk JOIN fx ON fx.user_id = walk.user_id AND fx.run_id = walk.run_id AND fx.part = walk.part AND fx.ts_ns = walk.nxt),
 au AS (SELECT r.user_id, r.run_id, r.ts_ns, s.ts_ns AS start_ts, s.e, s.kept FROM fr r ASOF JOIN walk s ON r.user_id = s.user_id AND r.run_id = s.run_id AND r.part = s.part AND r.ts_ns >= s.ts_ns)
SELECT user_id, ts_ns, run_id, CASE WHEN kept AND ts_ns <= e THEN NULL WHEN kept THEN 'inter_scene_skip' ELSE 'candidate_too_short' END AS unassigned,
 CASE WHEN kept AND ts_ns <= e THEN 'automatic' END AS kind, CASE WHEN kept AND ts_ns <= e THEN start_ts END AS scene_first FROM au
UNION ALL SELECT user_id, ts_ns, run_id, NULL, 'annotation', min(ts_ns) OVER (PARTITION BY user_id, run_id, win) FROM tk WHERE win IS NOT NULL""")
def hybrid_scenes(spark, sf_dir):
    ev = events(spark, sf_dir).select("user_id", "ts_ns")
    return scenes.build_scenes(ev, "user_id", "ts_ns", "hybrid", DAY, 2 * DAY, HOUR, 3, 6 * HOUR, windows(spark, sf_dir))


@query(f"""WITH {_WIN}, m AS (SELECT run.user_id, run.ts_ns, run.run_id, w.win, w.first FROM run LEFT JOIN win w ON run.user_id = w.user_id AND run.run_id = w.run_id AND run.ts_ns BETWEEN w.first AND w.last)
SELECT user_id, ts_ns, run_id, CASE WHEN win IS NULL THEN 'annotation_mode_excluded' END AS unassigned, CASE WHEN win IS NOT NULL THEN min(ts_ns) OVER (PARTITION BY user_id, run_id, win) END AS scene_first FROM m""")
def annotation_only_scenes(spark, sf_dir):
    ev = events(spark, sf_dir).select("user_id", "ts_ns")
    return scenes.build_scenes(ev, "user_id", "ts_ns", "annotation_only", DAY, 2 * DAY, HOUR, 3, 0, windows(spark, sf_dir)).select("user_id", "ts_ns", "run_id", "unassigned", "scene_first")


@query(f"""WITH {_RUNS}, s AS (SELECT user_id, run_id, min(ts_ns) AS first_ts, sha256(CAST(user_id AS VARCHAR)) AS digest FROM run GROUP BY user_id, run_id),
 o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY first_ts) - 1 AS ordinal FROM s),
 h AS (SELECT *, sha1(unhex('{NAMESPACE}') || encode('scene/["' || digest || '",' || ordinal || ']')) AS x FROM o),
 t AS (SELECT *, substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr(x, 17, 1)) AS INTEGER) % 4 + 1, 1) || substr(x, 18, 3) || '-' || substr(x, 21, 12) AS token FROM h)
SELECT user_id, run_id, ordinal, substr(digest, 1, 12) || '-' || lpad(CAST(ordinal AS VARCHAR), 6, '0') AS name, token,
 coalesce(lag(token) OVER w, '') AS prev, coalesce(lead(token) OVER w, '') AS next FROM t WINDOW w AS (PARTITION BY user_id ORDER BY first_ts)""")
def scene_chain(spark, sf_dir):
    s = sessions(spark, sf_dir).groupBy("user_id", "run_id").agg(F.min("ts_ns").alias("first_ts"))
    return scenes.name_scenes(s, "user_id", ["first_ts"], identity.sha256(F.col("user_id").cast("string")), NAMESPACE).select("user_id", "run_id", "ordinal", "name", "token", "prev", "next")


@query(f"""WITH {_EV}, s AS (SELECT DISTINCT user_id, ts_ns // {DAY} AS day, event_type FROM ev), days AS (SELECT user_id, count(DISTINCT day) AS expected FROM s GROUP BY user_id),
 kinds AS (SELECT DISTINCT event_type AS channel FROM ev)
SELECT d.user_id, k.channel, (SELECT count(*) FROM s WHERE s.user_id = d.user_id AND s.event_type = k.channel) AS present, d.expected, (SELECT count(*) FROM s WHERE s.user_id = d.user_id AND s.event_type = k.channel) / d.expected AS ratio
FROM days d CROSS JOIN kinds k""")
def channel_coverage(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("day", F.floor(F.col("ts_ns") / DAY))
    kinds = [r[0] for r in ev.select("event_type").distinct().orderBy("event_type").collect()]  # the channels of a rig
    samples = ev.groupBy("user_id", "day").agg(F.collect_set("event_type").alias("present_channels")).withColumn("expected_channels", F.array(*map(F.lit, kinds)))
    return features.channel_coverage(samples, ["user_id"], "expected_channels", "present_channels")


@query(f"""WITH {_EV}, r AS (SELECT *, ts_ns // {DAY} AS day, row_number() OVER (PARTITION BY user_id, ts_ns // {DAY} ORDER BY event_type <> 'view', event_type, event_id) AS n FROM ev)
SELECT user_id, day, event_type, event_id, event_type <> 'view' AS fallback FROM r WHERE n = 1""")
def reference_observation(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("day", F.floor(F.col("ts_ns") / DAY))
    return features.reference_observation(ev, ["user_id", "day"], "event_type", "event_id", "view").select("user_id", "day", "event_type", "event_id", "fallback")


@query(f"""WITH {_EV}, f AS (SELECT user_id, event_type, min(event_id) AS line0 FROM ev GROUP BY user_id, event_type)
SELECT user_id, string_agg(event_type, ',' ORDER BY line0) AS labels FROM f GROUP BY user_id""")
def label_union(spark, sf_dir):
    ev = events(spark, sf_dir).groupBy("user_id").agg(F.collect_list(F.struct(F.col("event_id").alias("line"), F.array("event_type").alias("labels"))).alias("l"))
    return ev.select("user_id", F.array_join(runs.first_appearance_union(F.col("l")), ",").alias("labels"))


SEED = 17
_SCENES = f"""{_RUNS}, sc AS (SELECT 'u' || user_id || '-' || run_id AS token, sha256(CAST(user_id AS VARCHAR)) AS source, user_id, run_id, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS buys, min(ts_ns) AS first_ts FROM run GROUP BY user_id, run_id)"""


def scene_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sessions(spark, sf_dir).groupBy("user_id", "run_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "purchase").alias("buys"), F.min("ts_ns").alias("first_ts"))
    return s.withColumns({"token": F.concat(F.lit("u"), F.col("user_id"), F.lit("-"), F.col("run_id")), "source": identity.sha256(F.col("user_id").cast("string"))})


def _rules():
    return [("long", 40, F.col("n") >= 6), ("buyers", 60, F.col("buys") > 0), ("rest", 50, F.lit(True))]


def _rule_sql(i: int, name: str, where: str, quota: int) -> str:
    payload = f"""'{{"rule_index":{i},"rule_name":"{name}","scene_token":"' || token || '","seed":{SEED},"source":{{"digest":"' || source || '"}}}}'"""
    prior = " OR ".join(f"token IN (SELECT token FROM s{j})" for j in range(i)) or "false"
    return f"""m{i} AS (SELECT token, source, sha256({payload}) AS rank, {prior} AS claimed FROM sc WHERE {where}),
 s{i} AS (SELECT token FROM m{i} WHERE NOT claimed ORDER BY rank, token LIMIT {quota}),
 c{i} AS (SELECT token, {i} AS rule_index, '{name}' AS rule_name, rank, claimed, token IN (SELECT token FROM s{i}) AS selected FROM m{i})"""


_SELECT = ", ".join([_SCENES, _rule_sql(0, "long", "n >= 6", 40), _rule_sql(1, "buyers", "buys > 0", 60), _rule_sql(2, "rest", "true", 50), "cs AS (SELECT * FROM c0 UNION ALL SELECT * FROM c1 UNION ALL SELECT * FROM c2)"])


def _selected(spark, sf_dir):
    return selection.select_quotas(scene_rows(spark, sf_dir), ["token", "source"], _rules(), SEED, identity.json_object(digest=identity.json_string(F.col("source"))))


@query(f"WITH {_SELECT} SELECT token, rule_index, rule_name, rank, claimed, selected, CASE WHEN selected THEN 'selected' WHEN claimed THEN 'claimed_by_prior_rule' ELSE 'quota_filled' END AS reason FROM cs")
def quota_select(spark, sf_dir):
    return _selected(spark, sf_dir)[0].drop("source")


@query(f"""WITH {_SELECT}, q AS (SELECT * FROM (VALUES ('long', 0, 40), ('buyers', 1, 60), ('rest', 2, 50)) v(rule_name, rule_index, quota))
SELECT q.rule_name, q.rule_index, CAST(q.quota AS BIGINT) AS quota, count(*) AS matched, count(*) FILTER (NOT claimed) AS eligible, count(*) FILTER (selected) AS selected, q.quota - count(*) FILTER (selected) AS deficit
FROM q JOIN cs ON cs.rule_index = q.rule_index GROUP BY q.rule_name, q.rule_index, q.quota""")
def rule_audits(spark, sf_dir):
    return _selected(spark, sf_dir)[1]


@query(f"WITH {_SELECT} SELECT token, 'quota_filled' AS reason FROM cs GROUP BY token HAVING NOT bool_or(selected)")
def unselected_audit(spark, sf_dir):
    return selection.unselected(scene_rows(spark, sf_dir), _selected(spark, sf_dir)[0], ["token", "source"]).drop("source")


_STRATA = """p AS (SELECT CAST(doc_id AS VARCHAR) AS token, source, lang, sha256('{"primary_scenario":"' || lang || '","scene_token":"' || doc_id || '","seed":17,"source_digest":"' || source || '"}') AS rank FROM documents),
 z AS (SELECT lang, count(*) AS n, floor(count(*) * 0.2::DECIMAL(4,1)) AS f FROM p GROUP BY lang),
 e AS (SELECT *, row_number() OVER (ORDER BY n * 0.2::DECIMAL(4,1) - f DESC, sha256('{"primary_scenario":"' || lang || '","purpose":"apportion","seed":17}'), lang) AS k FROM z),
 q AS (SELECT lang, n, CAST(f + CASE WHEN k <= (SELECT floor(sum(n) * 0.2::DECIMAL(4,1) + 0.5) - sum(f) FROM z) THEN 1 ELSE 0 END AS BIGINT) AS quota FROM e),
 r AS (SELECT p.*, row_number() OVER (PARTITION BY p.lang ORDER BY rank, token) AS k FROM p)"""


def _split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("token"), "source", "lang")
    return selection.split_scenes(docs, "token", "source", "0.2", SEED, "lang")


@query(f"WITH {_STRATA} SELECT token, r.source, r.lang, rank, CASE WHEN k <= quota THEN 'test' ELSE 'train' END AS split FROM r JOIN q ON q.lang = r.lang")
def stratified_split(spark, sf_dir):
    return _split(spark, sf_dir)[0].select("token", "source", "lang", "rank", "split")


@query(f"WITH {_STRATA} SELECT lang AS stratum, n AS population, quota AS test, n - quota AS train FROM q")
def strata_audit(spark, sf_dir):
    return _split(spark, sf_dir)[1].select("stratum", "population", "test", "train")


_PLAIN = f"""{_SCENES}, r AS (SELECT *, row_number() OVER (ORDER BY sha256('{{"primary_scenario":"__all__","scene_token":"' || token || '","seed":{SEED},"source_digest":"' || source || '"}}'), token) AS k FROM sc),
 sp AS (SELECT *, CASE WHEN k <= (SELECT floor(count(*) * 0.3::DECIMAL(4,1) + 0.5) FROM sc) THEN 'test' ELSE 'train' END AS split FROM r)"""


@query(f"""WITH {_PLAIN}, l AS (SELECT source, token, split, lead(token) OVER w AS next_token, lead(split) OVER w AS next_split FROM sp WINDOW w AS (PARTITION BY source ORDER BY first_ts))
SELECT * FROM l WHERE next_split <> split""")
def leakage_pairs(spark, sf_dir):
    out, _ = selection.split_scenes(scene_rows(spark, sf_dir), "token", "source", "0.3", SEED)
    return selection.leakage_pairs(out, "source", ["first_ts"], "token", "split")


@query("SELECT d.doc_id, quality, toxic, source FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE lang = 'en'")
def label_join(spark, sf_dir):
    frames = table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id", "source")
    return labels.join_labels(table(spark, sf_dir, "labels"), frames, ["doc_id"]).select("doc_id", "quality", "toxic", "source")


@query(f"""WITH {_RUNS}, s AS (SELECT user_id, run_id, min(ts_ns) AS a, max(ts_ns) AS b FROM run GROUP BY user_id, run_id),
 w AS (SELECT DISTINCT user_id, ts_ns // {3 * DAY} AS idx FROM ev)
SELECT w.user_id, w.idx, string_agg('s' || s.run_id, ',' ORDER BY s.run_id) AS scene_tokens FROM w JOIN s ON s.user_id = w.user_id AND w.idx * {3 * DAY} <= s.b AND (w.idx + 1) * {3 * DAY} > s.a GROUP BY w.user_id, w.idx""")
def interval_overlap_join(spark, sf_dir):
    s = sessions(spark, sf_dir)
    spans = s.groupBy("user_id", "run_id").agg(F.min("ts_ns").alias("a"), F.max("ts_ns").alias("b")).withColumn("token", F.concat(F.lit("s"), F.col("run_id")))
    w = s.select("user_id", F.expr(f"ts_ns div {3 * DAY}").alias("idx")).distinct().withColumns({"first": F.col("idx") * (3 * DAY), "end": (F.col("idx") + 1) * (3 * DAY)})
    found = labels.windows_to_scenes(w, spans, ["user_id"], "first", "end", "a", "b", "run_id", "token", 3 * DAY)
    return found.select("user_id", "idx", F.array_join("scene_tokens", ",").alias("scene_tokens"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, epoch_us(o_orderdate) AS first FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 WHERE epoch_us(l_shipdate) >= epoch_us(o_orderdate) AND epoch_us(l_shipdate) < epoch_us(o_orderdate) + 30 * 86400000000""")
def interval_contains_join(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", F.expr(_us("l_shipdate")).alias("t"))
    spans = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.expr(_us("o_orderdate")).alias("first"))
    spans = spans.withColumn("end", F.col("first") + 30 * 86400000000)
    return labels.windows_to_samples(spans, items, ["k"], "first", "end", "t", 30 * 86400000000).select(F.col("k").alias("l_orderkey"), "l_linenumber", "l_partkey", "first")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey WHERE o_orderstatus = 'F'""")
def payload_ref_join(spark, sf_dir):
    refs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_orderkey") % 7).alias("d"))
    frames = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 7).alias("d"))
    parts = table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return labels.join_payload_refs(refs, frames, "l_orderkey", ["d"], parts, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "p_name")


@query("""SELECT 'documents' AS layer, (SELECT count(*) FROM documents) AS available, (SELECT count(*) FROM documents SEMI JOIN labels USING (doc_id)) AS joined
UNION ALL SELECT 'labels', (SELECT count(*) FROM labels), (SELECT count(*) FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE lang = 'en')""")
def join_audit(spark, sf_dir):
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return labels.join_audit({"documents": docs, "labels": marks}, {"documents": docs.join(marks, "doc_id", "left_semi"), "labels": label_join(spark, sf_dir)})


@query("""SELECT l_orderkey, l_linenumber, l_discount >= 0 AND l_tax >= l_discount AND l_quantity >= l_tax AS ordered, abs(l_discount + l_tax + (1 - l_discount - l_tax) - 1) <= 0.00001 AND l_discount BETWEEN 0 AND 1 AND l_tax BETWEEN 0 AND 1 AND 1 - l_discount - l_tax BETWEEN 0 AND 1 AS weather, l_discount + l_tax <= 0.1 + 0.000001 AS semantic FROM lineitem""")
def weak_label_constraints(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumns({"rest": 1 - F.col("l_discount") - F.col("l_tax")})
    part = lambda i, c: F.struct(F.lit(i).alias("class_id"), (F.col(c) * 10).alias("fraction"))
    items = items.withColumn("classes", F.array(part(1, "l_discount"), part(2, "l_tax")))
    fine = labels.fractions_ok("classes", 1e-5)
    return items.select("l_orderkey", "l_linenumber", labels.ordered_ok("l_discount", "l_tax", "l_quantity").alias("ordered"), labels.probabilities_ok(["l_discount", "l_tax", "rest"]).alias("weather"), fine.alias("semantic"))


_OBS = f"""{_EV}, o AS (SELECT *, ts_ns - lag(ts_ns) OVER (PARTITION BY user_id ORDER BY event_id) AS delta FROM ev),
 obs AS (SELECT event_id, user_id, 'camera_timestamp_non_monotonic' AS code, delta AS measured, 0.0 AS threshold, true AS enabled FROM o WHERE delta <= 0
  UNION ALL SELECT event_id, user_id, 'camera_timestamp_gap_exceeded', delta, {2 * DAY}, false FROM o WHERE delta > {2 * DAY}
  UNION ALL SELECT event_id, user_id, 'position_sigma_exceeded', value, 60, true FROM o WHERE value > 60
  UNION ALL SELECT event_id, user_id, 'missing_required_camera', 1, NULL, true FROM o WHERE event_type = 'error')"""


def _observed(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id")
    o = events(spark, sf_dir).withColumn("delta", F.col("ts_ns") - F.lag("ts_ns").over(w))
    rules = [
        ("camera_timestamp_non_monotonic", "camera", F.col("delta") <= 0, F.col("delta"), 0, True),
        ("camera_timestamp_gap_exceeded", "camera", F.col("delta") > 2 * DAY, F.col("delta"), 2 * DAY, False),
        ("position_sigma_exceeded", "pose", F.col("value") > 60, F.col("value"), 60, True),
        ("missing_required_camera", "sample", F.col("event_type") == "error", F.lit(1), None, True),
    ]
    return policy.observations(o, rules, ["event_id", "user_id"])


@query(f"WITH {_OBS} SELECT event_id, user_id, code, CAST(measured AS DOUBLE) AS measured, CAST(threshold AS DOUBLE) AS threshold, enabled FROM obs")
def validity_observations(spark, sf_dir):
    return _observed(spark, sf_dir).drop("scope")


@query(f"""WITH {_OBS}, c AS (SELECT event_id, string_agg(DISTINCT code, ',' ORDER BY code) AS codes, bool_or(enabled) AS bad FROM obs GROUP BY event_id)
SELECT ev.event_id, coalesce(codes, '') AS codes, NOT coalesce(bad, false) AS valid, NOT coalesce(bad, false) AS final_candidate, coalesce(bad, false) AS audit_only FROM ev LEFT JOIN c ON c.event_id = ev.event_id""")
def sample_audits(spark, sf_dir):
    out = policy.sample_audits(events(spark, sf_dir).select("event_id"), _observed(spark, sf_dir), ["event_id"], "retain")
    return out.withColumn("codes", F.array_join("codes", ","))


@query(f"""WITH {_EV} SELECT user_id, 'all_gnss_invalid' AS code, 'error' AS severity FROM ev GROUP BY user_id HAVING bool_and(value < 20)
UNION ALL SELECT user_id, 'no_purchase', 'warn' FROM ev GROUP BY user_id HAVING count(*) FILTER (event_type = 'purchase') = 0
UNION ALL SELECT user_id, 'few_samples', 'warn' FROM ev GROUP BY user_id HAVING count(*) < 60""")
def sanity_findings(spark, sf_dir):
    checks = {
        "all_gnss_invalid": (F.bool_and(F.col("value") < 20), "error"), "no_purchase": (F.count_if(F.col("event_type") == "purchase") == 0, "warn"),
        "few_samples": (F.count(F.lit(1)) < 60, "warn"), "many_samples": (F.count(F.lit(1)) > 60, "off"),
    }
    return policy.sanity_findings(events(spark, sf_dir), ["user_id"], checks)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def key_violations(spark, sf_dir):
    return integrity.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT user_id AS key, count(*) AS n FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0) GROUP BY user_id")
def foreign_key_violations(spark, sf_dir):
    return integrity.orphans(table(spark, sf_dir, "events"), "user_id", table(spark, sf_dir, "customer").where("c_custkey % 3 = 0"), "c_custkey")


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM (SELECT doc_id FROM documents WHERE doc_id % 5 <> 0) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL""")
def coverage_differences(spark, sf_dir):
    return integrity.coverage_differences(table(spark, sf_dir, "documents").where("doc_id % 5 <> 0"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("""SELECT doc_id, CASE WHEN n IS NULL THEN 'missing' ELSE 'shared' END AS fault FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 2 = 0 AND doc_id % 3 = 0 THEN 2 WHEN doc_id % 2 = 0 OR doc_id % 3 = 0 THEN 1 END AS n FROM documents) WHERE n IS NULL OR n > 1""")
def partition_faults(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    some = docs.where("doc_id % 10 <> 0")
    return integrity.partition_faults(docs, {"a": some.where("doc_id % 2 = 0"), "b": some.where("doc_id % 3 = 0")}, ["doc_id"])


_CHAIN = "l AS (SELECT conv_id, turn, conv_id || '-' || turn AS token, coalesce(lag(conv_id || '-' || turn) OVER w, '') AS p, coalesce(lead(conv_id || '-' || turn) OVER w, '') AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, conv_id || '-' || turn))"


@query(f"""WITH {_CHAIN} SELECT conv_id, token, 'prev_mismatch' AS fault FROM l WHERE turn % 5 = 3 AND p <> '' UNION ALL SELECT conv_id, token, 'next_mismatch' FROM l WHERE turn % 7 = 2 AND n <> ''""")
def chain_faults(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("token"))
    linked = runs.chain_links(turns, ["conv_id"], ["turn", "token"], "token")
    broken = linked.withColumns({"prev": F.when(F.col("turn") % 5 == 3, "").otherwise(F.col("prev")), "next": F.when(F.col("turn") % 7 == 2, "").otherwise(F.col("next"))})
    return integrity.chain_faults(broken, ["conv_id"], "token", "prev", "next", "turn")


@query(r"""SELECT doc_id, 'credential' AS finding FROM documents WHERE len(regexp_extract_all(text, '(?i)(?:password|passwd|secret|token|api[_-]?key|private[_-]?key)\s*[=:]\s*\S{6}')) > 0
UNION ALL SELECT doc_id, 'iso_date' FROM documents WHERE len(regexp_extract_all(' ' || text || ' ', '[^0-9]\d{4}-\d\d-\d\d[^0-9]')) > 0""")
def forbidden_text(spark, sf_dir):
    return integrity.forbidden_text(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(r"""WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
SELECT o_orderkey, 'root.a.gpsWeek' AS path, 'forbidden_name' AS finding FROM o WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, unnest(['root.note', 'root.note.days[1]']), 'iso_date' FROM o WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'root.note.osm', 'forbidden_name' FROM o WHERE o_orderkey % 5 = 0""")
def forbidden_json(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    day = F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("none")
    inner = F.to_json(F.struct(F.array(F.lit("x"), day).alias("days"), F.when(k % 5 == 0, F.lit(1)).alias("osm")))
    whole = F.to_json(F.struct(F.struct(F.when(k % 3 == 0, F.lit(7)).alias("gpsWeek"), F.lit("latest").alias("platform")).alias("a"), inner.alias("note")))
    return integrity.forbidden_json(o.select("o_orderkey", whole.alias("j")), ["o_orderkey"], "j")


@query("""SELECT vec_id, round(sqrt(list_sum(list_transform(embedding[1:4], lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm, vec_id % 3 = 0 AS ok FROM embeddings""")
def geometry_check(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("v", F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double")))
    unit = scalar.quaternion(*(F.get("v", i) for i in range(4)))
    e = e.withColumns({"q": F.when(F.col("vec_id") % 3 == 0, unit).otherwise(F.transform(unit, lambda x: x * 1.1)), "t": F.slice("v", 1, 3)})
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return e.select("vec_id", F.round(norm, 6).alias("norm"), integrity.geometry_ok("t", "q").alias("ok"))


@query(f"""WITH {_EV}, d AS (SELECT event_id, value AS lon, value / 2 AS lat FROM ev), p AS (SELECT *, 6378137.0 * radians(lon) AS x, 6378137.0 * ln(tan(pi() / 4 + radians(lat) / 2)) AS y FROM d)
SELECT event_id, round(x, 3) AS x, round(y, 3) AS y, round(degrees(x / 6378137.0), 9) AS lon, round(degrees(2 * atan(exp(y / 6378137.0)) - pi() / 2), 9) AS lat FROM p WHERE abs(lat) < 85""")
def mercator(spark, sf_dir):
    ev = events(spark, sf_dir).where(F.abs(F.col("value") / 2) < 85)
    x, y = scalar.mercator(F.col("value"), F.col("value") / 2)
    lon, lat = scalar.inverse_mercator(x, y)
    return ev.select("event_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"), F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


@query("""WITH v AS (SELECT vec_id, embedding[1]::DOUBLE AS r, embedding[2]::DOUBLE AS p, embedding[3]::DOUBLE AS y FROM embeddings),
 q AS (SELECT vec_id, cos(r/2)*cos(p/2)*cos(y/2)+sin(r/2)*sin(p/2)*sin(y/2) AS w, sin(r/2)*cos(p/2)*cos(y/2)-cos(r/2)*sin(p/2)*sin(y/2) AS x,
   cos(r/2)*sin(p/2)*cos(y/2)+sin(r/2)*cos(p/2)*sin(y/2) AS yy, cos(r/2)*cos(p/2)*sin(y/2)-sin(r/2)*sin(p/2)*cos(y/2) AS z FROM v)
SELECT vec_id, round(w, 9) AS w, round(x, 9) AS x, round(yy, 9) AS y, round(z, 9) AS z, round(atan2(2*(w*z+x*yy), 1-2*(yy*yy+z*z)), 9) AS yaw FROM q""")
def euler_quaternion(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = scalar.euler_quaternion(*(F.get("embedding", i).cast("double") for i in range(3)))
    e = e.select("vec_id", q.alias("q"))
    return e.select("vec_id", *(F.round(F.get("q", i), 9).alias(n) for i, n in enumerate("wxyz")), F.round(scalar.yaw(F.col("q")), 9).alias("yaw"))


@query("""WITH u AS (SELECT vec_id, embedding[1:4]::DOUBLE[] AS a, embedding[5:8]::DOUBLE[] AS b FROM embeddings),
 n AS (SELECT vec_id, list_transform(a, lambda x: x / sqrt(list_dot_product(a, a))) AS a, list_transform(b, lambda x: x / sqrt(list_dot_product(b, b))) AS b FROM u),
 d AS (SELECT *, least(abs(list_dot_product(a, b)), 1.0) AS dot, CASE WHEN list_dot_product(a, b) < 0 THEN -1 ELSE 1 END AS s FROM n),
 f AS (SELECT *, CASE WHEN dot > 0.9995 THEN 0.75 ELSE sin(acos(dot) * 0.75) / sin(acos(dot)) END AS fa, s * CASE WHEN dot > 0.9995 THEN 0.25 ELSE sin(acos(dot) * 0.25) / sin(acos(dot)) END AS fb FROM d),
 m AS (SELECT vec_id, a[1]*fa+b[1]*fb AS w, a[2]*fa+b[2]*fb AS x, a[3]*fa+b[3]*fb AS y, a[4]*fa+b[4]*fb AS z FROM f)
SELECT vec_id, round(w / sqrt(w*w+x*x+y*y+z*z), 8) AS w, round(x / sqrt(w*w+x*x+y*y+z*z), 8) AS x, round(y / sqrt(w*w+x*x+y*y+z*z), 8) AS y, round(z / sqrt(w*w+x*x+y*y+z*z), 8) AS z FROM m""")
def slerp(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    unit = lambda k: scalar.quaternion(*(F.get("embedding", k + i).cast("double") for i in range(4)))
    e = e.select("vec_id", unit(0).alias("a"), unit(4).alias("b")).select("vec_id", scalar.slerp(F.col("a"), F.col("b"), F.lit(0.25)).alias("q"))
    return e.select("vec_id", *(F.round(F.get("q", i), 8).alias(n) for i, n in enumerate("wxyz")))


@query(f"""WITH {_EV}, k AS (SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS v, lead(CAST(json_extract(props, '$.k') AS DOUBLE)) OVER (PARTITION BY user_id ORDER BY ts_ns) AS n FROM ev)
SELECT event_id, round(v + (n - v) * 0.5, 6) AS k FROM k WHERE n IS NOT NULL""")
def props_lerp(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("m", F.from_json("props", "map<string,double>"))
    ev = ev.withColumn("n", F.lead("m").over(Window.partitionBy("user_id").orderBy("ts_ns"))).where("n is not null")
    return ev.select("event_id", F.round(F.element_at(scalar.mapped_lerp(F.col("m"), F.col("n"), F.lit(0.5)), "k"), 6).alias("k"))


@query(f"""WITH {_EV}, k AS (SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS v, lead(CAST(json_extract(props, '$.k') AS DOUBLE)) OVER (PARTITION BY user_id ORDER BY ts_ns) AS n FROM ev)
SELECT event_id, round(v + (n - v) * 0.25, 6) AS k, CAST(0 AS INTEGER) AS n_left FROM k WHERE n IS NOT NULL""")
def tree_blend(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("following", F.lead("props").over(Window.partitionBy("user_id").orderBy("ts_ns"))).where("following is not null")
    found = ev.select("event_id", trees.blended("props", "following", F.lit(0.25)).alias("m"))
    return found.select("event_id", F.round(F.element_at("m.blended", "k"), 6).alias("k"), F.size("m.uninterpolated").alias("n_left"))


@query(f"""WITH {_EV} SELECT event_id, 'k' AS path, CAST(json_extract(props, '$.k') AS DOUBLE) AS value FROM ev""")
def largest_leaf(spark, sf_dir):
    found = events(spark, sf_dir).select("event_id", trees.numeric_leaves("props").alias("l")).select("event_id", trees.largest_leaf(F.col("l")).alias("b"))
    return found.select("event_id", "b.path", "b.value")


@query("""SELECT c_custkey, sha256('{"key":' || c_custkey || ',"name":"' || c_name || '","segment":"' || c_mktsegment || '"}') AS digest FROM customer""")
def canonical_hashes(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", identity.sha256(identity.json_object(name=identity.json_string(F.col("c_name")), key=F.col("c_custkey"), segment=identity.json_string(F.col("c_mktsegment")))).alias("digest"))


@query(f"""WITH {_EV}, x AS (SELECT event_id, (value - 50) / 3 AS v, value FROM ev)
SELECT event_id, CAST(CASE WHEN v >= 0 THEN floor(v + 0.5) ELSE ceil(v - 0.5) END AS BIGINT) AS away, (ts_ns // 1000) AS us, CAST((2 * ts_ns::HUGEINT * 7 + 3) // 6 AS BIGINT) AS ratio,
 round((v + pi()) - 2 * pi() * floor((v + pi()) / (2 * pi())) - pi(), 9) AS angle FROM x JOIN ev USING (event_id)""")
def scalar_rounding(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("v", (F.col("value") - 50) / 3)
    return ev.select("event_id", scalar.round_half_away(F.col("v")).cast("long").alias("away"), scalar.microseconds(F.col("ts_ns")).alias("us"), scalar.rounded_ratio(F.col("ts_ns").cast("decimal(38,0)") * 7, F.lit(3)).alias("ratio"), F.round(scalar.shortest_angle(F.col("v")), 9).alias("angle"))


@query(r"""SELECT s_suppkey, regexp_replace('CAM_' || replace(upper(s_name), '-', '_'), '_+', '_', 'g') AS channel, NOT regexp_matches(s_name, '[/\\#]') AS segment FROM supplier""")
def names_and_paths(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", scalar.channel_name(F.col("s_name")).alias("channel"), (scalar.safe_segment(F.col("s_name")) & ~F.contains("s_name", F.lit("#"))).alias("segment"))


@query("""SELECT c_custkey, 'filter' AS stage FROM customer WHERE c_acctbal < 0 UNION SELECT c_custkey, 'filter' FROM customer WHERE c_custkey % 10 = 0 UNION SELECT c_custkey, 'sanity' FROM customer WHERE c_acctbal < 100""")
def rejection_merge(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    rows = lambda where, stage: c.where(where).select("c_custkey", F.lit(stage).alias("stage"))
    return publish.merge_rejections(rows("c_acctbal < 0", "filter").unionByName(rows("c_acctbal < 100", "sanity")), rows("c_custkey % 10 = 0", "filter"))


@query("""SELECT s_suppkey AS line_number, 'data/s/' || s_suppkey || '.mcap' AS repo_path, s_suppkey * 10 + 1 AS source_size, sha256(s_name) AS sha256 FROM supplier""")
def manifest_parse(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    line = F.concat(F.lit('{"source_size": '), F.col("s_suppkey") * 10 + 1, F.lit(', "note": [1], "repo_path": "data/s/'), F.col("s_suppkey"), F.lit('.mcap", "sha256": "'), F.sha2("s_name", 256), F.lit('"}'))
    lines = s.select(F.col("s_suppkey").alias("line_number"), line.alias("value")).unionByName(s.select((-F.col("s_suppkey")).alias("line_number"), F.lit("  # comment").alias("value")))
    return manifests.parse_manifest(lines)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey IN (SELECT unnest(range(1, 101))) AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')")
def select_recordings(spark, sf_dir):
    catalog = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return manifests.select_recordings(catalog, list(range(1, 101)), ["BUILDING", "MACHINERY", "AUTOMOBILE"], "c_custkey", "c_mktsegment")


@query("SELECT p_partkey, p_brand FROM part ANTI JOIN (SELECT l_partkey AS p_partkey FROM lineitem WHERE l_quantity > 40) USING (p_partkey)")
def artifact_verification(spark, sf_dir):
    index = table(spark, sf_dir, "lineitem").where("l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    return manifests.verify_artifacts(table(spark, sf_dir, "part"), index, ["p_partkey"]).select("p_partkey", "p_brand")


@query("""SELECT d.doc_id, d.n_chars AS metadata, length(d.text) AS viewer, l.n AS integrity, l.n IS NOT NULL AND d.n_chars = length(d.text) AND d.n_chars = l.n AS agrees
FROM documents d LEFT JOIN (SELECT doc_id, n_chars AS n FROM documents SEMI JOIN labels USING (doc_id)) l ON l.doc_id = d.doc_id""")
def three_way_agreement(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labelled = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi").select("doc_id", F.col("n_chars").alias("v"))
    return manifests.agreement({"metadata": docs.select("doc_id", F.col("n_chars").alias("v")), "viewer": docs.select("doc_id", F.length("text").cast("long").alias("v")), "integrity": labelled}, ["doc_id"], "v")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CAST(NULL AS DOUBLE) AS l_discount, CAST(NULL AS DOUBLE) AS l_tax, l_returnflag FROM lineitem")
def layer_mask(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_returnflag")
    return labels.mask_layers(items, {"semantic": ["l_discount", "l_tax"], "weather": ["l_returnflag"]}, ["camera_scalar", "weather"], "camera_scalar")


@query("SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'region', count(*) FROM region")
def inspect(spark, sf_dir):
    from .sdk import Dataset

    return Dataset({n: table(spark, sf_dir, n) for n in ("region", "nation", "orders")}).inspect()


@query("""SELECT user_id, string_agg(t, ',' ORDER BY t) AS missing FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (VALUES ('view'), ('refund'), ('purchase')) v(t) WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND e.event_type = t) GROUP BY user_id""")
def required_channels(spark, sf_dir):
    return integrity.missing_channels(table(spark, sf_dir, "events"), ["user_id"], "event_type", ["view", "refund", "purchase"]).select("user_id", F.array_join("missing", ",").alias("missing"))


@query("""SELECT DISTINCT 'tokens' AS family, 'lineitem_duplicate_key' AS code, l_orderkey || '|' || l_linenumber AS subject FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT DISTINCT 'foreign_keys', 'events_orphan', CAST(user_id AS VARCHAR) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)""")
def validation_report(spark, sf_dir):
    return integrity.report([
        integrity.key_findings("lineitem", table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]),
        integrity.foreign_findings("events", table(spark, sf_dir, "events"), "user_id", table(spark, sf_dir, "customer").where("c_custkey % 3 = 0"), "c_custkey"),
    ])


@query(f"""WITH {_SEG}, tagged AS (SELECT *, string_split({_TAGS}, ',') AS t FROM feat), ok AS (SELECT * FROM tagged WHERE {_REASONS} = '')
SELECT user_id, run_id, n_samples, round(duration_s, 3) AS duration_s, array_to_string(t, ',') AS tags FROM ok""")
def build_dataset(spark, sf_dir):
    """Runs, features, tags, filter: the accepted scenes."""
    accepted, _ = policy.filter_scenes(featured(spark, sf_dir), FILTER)
    return accepted.select("user_id", "run_id", "n_samples", F.round("duration_s", 3).alias("duration_s"), F.array_join("tags", ",").alias("tags"))
