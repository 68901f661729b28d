"""Queries over scene graphs, validity, control tables and the published view.

A recording is a user of ``events``; a sample an hour with events; a record the
first event of a channel in it; a scene a run of samples without a day's gap.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, scalar
from ..operators import extensions, graph, policy, runs, selection, timegrid, validity
from ..sinks import recordings as files_out
from ..sources import control, recordings
from . import config
from .queries import _EV, _SELECT, DAY, HOUR, NAMESPACE, SEED, SQL, _rules, _selected, events, query, scene_rows, table
from .sdk import Dataset

_SETTINGS = '{"gap":86400}'


def _uuid(x: str) -> str:
    return f"(substr({x}, 1, 8) || '-' || substr({x}, 9, 4) || '-5' || substr({x}, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr({x}, 17, 1)) AS INTEGER) % 4 + 1, 1) || substr({x}, 18, 3) || '-' || substr({x}, 21, 12))"


_GRAPH = f"""{_EV}, rec0 AS (SELECT user_id, ts_ns // {HOUR} * {HOUR} AS ts, event_type AS channel, min(event_id) AS camera_index FROM ev GROUP BY ALL),
 rec AS (SELECT rec0.*, ev.ts_ns AS camera_ts FROM rec0 JOIN ev ON ev.event_id = rec0.camera_index),
 smp AS (SELECT user_id, ts_ns // {HOUR} * {HOUR} AS ts, min(ts_ns) AS batch_ts FROM ev GROUP BY ALL),
 st AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > {DAY} THEN 1 ELSE 0 END AS nw FROM smp),
 rn AS (SELECT * EXCLUDE (nw), sum(nw) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM st),
 kept AS (SELECT *, min(ts) OVER (PARTITION BY user_id, run) AS scene_first, count(*) OVER (PARTITION BY user_id, run) AS n FROM rn QUALIFY n >= 3),
 sg AS (SELECT user_id, scene_first, sha256(CAST(user_id AS VARCHAR)) AS digest, '{{"digest":"' || sha256(CAST(user_id AS VARCHAR)) || '"}}' AS src, string_agg(ts, ',' ORDER BY ts) AS stamps, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS nbr_samples FROM kept GROUP BY user_id, scene_first),
 sx AS (SELECT *, sha1(unhex('{NAMESPACE}') || encode('scene/[' || src || ',"automatic",null,[' || stamps || '],{_SETTINGS}]')) AS x FROM sg),
 sc AS (SELECT user_id, scene_first, digest, src, first_ts, last_ts, nbr_samples, {_uuid('x')} AS token, row_number() OVER (PARTITION BY user_id ORDER BY scene_first) - 1 AS ordinal FROM sx),
 px AS (SELECT k.user_id, k.ts, k.batch_ts, sc.token AS scene_token, src, digest, sha1(unhex('{NAMESPACE}') || encode('sample/[' || src || ',"' || sc.token || '",' || k.ts || ']')) AS x FROM kept k JOIN sc ON sc.user_id = k.user_id AND sc.scene_first = k.scene_first),
 sa AS (SELECT user_id, ts, batch_ts, scene_token, src, digest, {_uuid('x')} AS token FROM px),
 dx AS (SELECT rec.*, sa.token AS sample_token, scene_token, src, digest, row_number() OVER (PARTITION BY scene_token, channel ORDER BY rec.ts) - 1 AS ordinal FROM rec JOIN sa ON sa.user_id = rec.user_id AND sa.ts = rec.ts),
 dy AS (SELECT *, sha1(unhex('{NAMESPACE}') || encode('sample-data/[' || src || ',"' || scene_token || '","' || sample_token || '","' || channel || '",' || camera_ts || ',' || camera_index || ',' || ordinal || ']')) AS x FROM dx),
 da AS (SELECT * EXCLUDE (x), {_uuid('x')} AS token FROM dy)"""


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(assigned samples, records)."""
    ev = events(spark, sf_dir).withColumn("ts", F.floor(F.col("ts_ns") / HOUR) * HOUR)
    records = ev.groupBy("user_id", "ts", F.col("event_type").alias("channel")).agg(F.min("event_id").alias("camera_index"), F.min_by("ts_ns", "event_id").alias("camera_ts"))
    samples = runs.gap_runs(ev.groupBy("user_id", "ts").agg(F.min("ts_ns").alias("batch_ts")), ["user_id"], "ts", DAY)
    size = samples.groupBy("user_id", "run_id").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("scene_first"))
    kind = F.when(F.col("n") >= 3, "automatic")
    assigned = samples.join(size, ["user_id", "run_id"]).select("user_id", "ts", "batch_ts", kind.alias("kind"), "scene_first", F.lit(None).cast("string").alias("window_token"))
    return assigned, records


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    assigned, records = _parts(spark, sf_dir)
    digest = identity.sha256(F.col("user_id").cast("string"))
    out = graph.materialize(assigned, records, "user_id", digest, identity.json_object(digest=identity.json_string(digest)), _SETTINGS, NAMESPACE)
    return *out, assigned


def _kept_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The graph for queries that read it many times: cached, and made anew
    where an executor that held some of it is lost."""
    return tuple(d.persist() for d in _graph(spark, sf_dir))


@query(f"""WITH {_GRAPH} SELECT sc.user_id, sc.token, substr(digest, 1, 12) || '-' || lpad(CAST(ordinal AS VARCHAR), 6, '0') AS name, ordinal, nbr_samples, first_ts, last_ts,
 (SELECT arg_min(sa.token, ts) FROM sa WHERE scene_token = sc.token) AS first_sample_token, (SELECT arg_max(sa.token, ts) FROM sa WHERE scene_token = sc.token) AS last_sample_token FROM sc""")
def graph_scenes(spark, sf_dir):
    return _graph(spark, sf_dir)[0].drop("kind", "window_token")


@query(f"""WITH {_GRAPH} SELECT token, scene_token, user_id, ts, batch_ts, coalesce(lag(token) OVER w, '') AS prev, coalesce(lead(token) OVER w, '') AS next FROM sa WINDOW w AS (PARTITION BY scene_token ORDER BY ts)""")
def graph_samples(spark, sf_dir):
    return _graph(spark, sf_dir)[1]


@query(f"""WITH {_GRAPH} SELECT token, sample_token, scene_token, channel, camera_index, ordinal, camera_ts, 'samples/' || digest || '/' || channel || '/' || token || '.jpg' AS filename,
 coalesce(lag(token) OVER w, '') AS prev, coalesce(lead(token) OVER w, '') AS next FROM da WINDOW w AS (PARTITION BY scene_token, channel ORDER BY ts)""")
def graph_sample_data(spark, sf_dir):
    return _graph(spark, sf_dir)[2]


@query(f"""WITH {_GRAPH}, b AS (SELECT token, scene_token, ts, coalesce(lag(token) OVER w, '') AS p FROM sa WINDOW w AS (PARTITION BY scene_token ORDER BY ts)),
 z AS (SELECT *, CAST(token[1:1] = '0' AS BOOLEAN) AS cut FROM b)
SELECT 'sample_prev_mismatch' AS code, token AS subject FROM z WHERE cut AND p <> ''
UNION ALL SELECT 'scene_ends', token FROM sc WHERE ordinal = 1 UNION ALL SELECT 'filename_wrong', token FROM da WHERE channel = 'click' AND ordinal % 5 = 4 UNION ALL SELECT 'unexpected_channel', token FROM da WHERE channel = 'view'
UNION ALL SELECT 'assignment_unknown', user_id || '@' || ts FROM kept WHERE ts % {7 * HOUR} = 0""")
def graph_validation(spark, sf_dir):
    """A graph with faults put in on purpose, of which each must be found."""
    scenes, samples, data, assigned = _kept_graph(spark, sf_dir)
    kinds = [r[0] for r in data.select("channel").distinct().collect()]
    scenes = scenes.withColumn("nbr_samples", F.col("nbr_samples") + (F.col("ordinal") == 1).cast("long"))
    samples = samples.withColumn("prev", F.when(F.substring("token", 1, 1) == "0", "").otherwise(F.col("prev")))
    data = data.withColumn("filename", F.when((F.col("channel") == "click") & (F.col("ordinal") % 5 == 4), "x.jpg").otherwise(F.col("filename")))
    data = data.withColumn("filename", F.when(F.col("filename") == "x.jpg", F.concat("filename", "token")).otherwise(F.col("filename")))
    found = graph.graph_findings(scenes, samples, data, assigned.where(F.col("ts") % (7 * HOUR) != 0), "user_id", [k for k in kinds if k != "view"])
    return found


@query(f"""WITH {_GRAPH}, e AS (SELECT scene_token, abs(batch_ts - ts) AS e FROM sa UNION ALL SELECT scene_token, abs(camera_ts - ts) FROM da)
SELECT scene_token, round(max(e) / 1e6, 6) AS max_ms, round(avg(e) / 1e6, 6) AS mean_ms FROM e GROUP BY scene_token""")
def sync_features(spark, sf_dir):
    _, samples, data, _ = _graph(spark, sf_dir)
    s = samples.withColumn("error", F.col("batch_ts") - F.col("ts"))
    d = data.join(samples.select(F.col("token").alias("sample_token"), "ts"), "sample_token").withColumn("error", F.col("camera_ts") - F.col("ts"))
    out = graph.sync_features(s, d, ["scene_token"], "error", "error")
    return out.select("scene_token", F.round("max_sync_error_ms", 6).alias("max_ms"), F.round("mean_sync_error_ms", 6).alias("mean_ms"))


@query(f"""WITH {_GRAPH}, own AS (SELECT DISTINCT user_id FROM sc WHERE nbr_samples >= 12)
SELECT sc.token, sc.user_id, row_number() OVER (PARTITION BY sc.user_id ORDER BY scene_first) - 1 AS position, nbr_samples >= 12 AS selected FROM sc SEMI JOIN own ON own.user_id = sc.user_id""")
def scene_chronology(spark, sf_dir):
    scenes = _graph(spark, sf_dir)[0]
    return graph.chronology(scenes, scenes.where("nbr_samples >= 12"), "user_id", ["first_ts"]).select("token", "user_id", "position", "selected")


@query(f"""WITH {_GRAPH}, chosen AS (SELECT token FROM sc WHERE ordinal = 0)
SELECT 'scene' AS name, token FROM chosen UNION ALL SELECT 'sample', token FROM sa WHERE scene_token IN (FROM chosen) UNION ALL SELECT 'sample_data', token FROM da WHERE scene_token IN (FROM chosen)
UNION ALL SELECT DISTINCT 'calibrated_sensor', digest || '-' || channel FROM da WHERE scene_token IN (FROM chosen) UNION ALL SELECT DISTINCT 'sensor', channel FROM da WHERE scene_token IN (FROM chosen) UNION ALL SELECT DISTINCT 'log', CAST(user_id AS VARCHAR) FROM sc WHERE ordinal = 0""")
def export_tables(spark, sf_dir):
    scenes, samples, data, _ = _kept_graph(spark, sf_dir)
    data = data.withColumn("calibrated_sensor_token", F.concat(F.element_at(F.split("filename", "/"), 2), F.lit("-"), "channel"))
    cal = data.select(F.col("calibrated_sensor_token").alias("token"), F.col("channel").alias("sensor_token")).distinct()
    logs = scenes.select(F.col("user_id").cast("string").alias("token")).distinct()
    tables = {"scene": scenes.withColumn("log_token", F.col("user_id").cast("string")), "sample": samples, "sample_data": data, "calibrated_sensor": cal, "sensor": cal.select(F.col("sensor_token").alias("token")).distinct(), "log": logs}
    out = graph.export_tables(scenes.where("ordinal = 0"), tables)
    found = None
    for name in sorted(out):
        own = out[name].select(F.lit(name).alias("name"), "token")
        found = own if found is None else found.unionByName(own)
    return found


@query(f"""WITH {_GRAPH} SELECT 'pose_missing' AS code, token AS subject FROM da WHERE ordinal % 4 = 1 UNION ALL SELECT DISTINCT 'calibration_missing', channel FROM da WHERE channel = 'view'
UNION ALL SELECT 'file_missing', 'samples/' || digest || '/' || channel || '/' || token || '.jpg' FROM da WHERE camera_index % 3 = 0""")
def export_preflight(spark, sf_dir):
    data = _graph(spark, sf_dir)[2].withColumns({"ego_pose_token": F.col("token"), "calibrated_sensor_token": F.col("channel")})
    poses, cal = data.where("ordinal % 4 <> 1").select("token"), data.where("channel <> 'view'").select(F.col("channel").alias("token"))
    return graph.preflight_findings(data, poses, cal, data.where("camera_index % 3 <> 0").select(F.col("filename").alias("path")))


@query(f"""WITH {_EV}, p AS (SELECT event_id, user_id, event_id % 7 <> 0 AS available, event_id % 5 <> 0 AS after_ok, value / 10 AS sigma, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, ts_ns - lag(ts_ns) OVER (PARTITION BY user_id ORDER BY ts_ns) AS gap FROM ev)
SELECT event_id, 'gnss_source_invalid' AS code, CAST(available AS INTEGER)::DOUBLE AS measured, NULL AS threshold, true AS enabled FROM p WHERE NOT available OR NOT after_ok
UNION ALL SELECT event_id, 'position_sigma_exceeded', sigma, 5.0, false FROM p WHERE sigma > 5 UNION ALL SELECT event_id, 'orientation_variance_exceeded', k, 50.0, true FROM p WHERE k > 50
UNION ALL SELECT event_id, 'gnss_sync_gap_exceeded', gap, {HOUR}.0, false FROM p WHERE gap > {HOUR}""")
def pose_observations(spark, sf_dir):
    from pyspark.sql.window import Window

    ev = events(spark, sf_dir)
    gap = F.col("ts_ns") - F.lag("ts_ns").over(Window.partitionBy("user_id").orderBy("ts_ns"))
    poses = ev.select(
        "event_id", (F.col("event_id") % 7 != 0).alias("available"), F.array(F.lit(True), F.col("event_id") % 5 != 0).alias("source_validity"),
        F.create_map(F.lit("up_sigma_m"), F.col("value") / 10, F.lit("other"), F.lit(1e9)).alias("position_uncertainty"),
        F.from_json("props", "map<string,double>").alias("orientation_uncertainty"), gap.alias("sync_gap_before_ns"), F.lit(None).cast("long").alias("sync_gap_after_ns"),
    )
    rules = validity.pose_rules(5.0, 50.0, 3_600_000.0, ["gnss_source_invalid", "orientation_variance_exceeded"])
    return validity.evaluate(poses, ["event_id"], rules).drop("scope")


@query(f"""WITH {_EV}, a AS (SELECT event_id, event_id % 7 <> 0 AS ok, event_id % 7 <> 0 OR event_id % 49 = 0 AS valid, event_id % 7 <> 0 AS cand, event_id % 7 = 0 AND event_id % 5 <> 0 AS ao FROM ev)
SELECT 'validity_differs' AS code, CAST(event_id AS VARCHAR) AS subject FROM a WHERE valid <> ok UNION ALL SELECT 'candidate_differs', CAST(event_id AS VARCHAR) FROM a WHERE cand <> valid
UNION ALL SELECT 'audit_only_differs', CAST(event_id AS VARCHAR) FROM a WHERE ao <> NOT valid UNION ALL SELECT 'exported_not_candidate', CAST(event_id AS VARCHAR) FROM a WHERE event_id % 11 = 0 AND NOT cand""")
def validity_enforcement(spark, sf_dir):
    e = F.col("event_id")
    ev = events(spark, sf_dir).select("event_id")
    audits = ev.select("event_id", ((e % 7 != 0) | (e % 49 == 0)).alias("valid"), (e % 7 != 0).alias("final_candidate"), ((e % 7 == 0) & (e % 5 != 0)).alias("audit_only"))
    observed = ev.where(e % 7 == 0).withColumn("enabled", F.lit(True)).unionByName(ev.where(e % 3 == 0).withColumn("enabled", F.lit(False)))
    return validity.enforcement_findings(audits, observed, ev.where(e % 11 == 0), ["event_id"], "retain")


@query(f"""WITH {_GRAPH}, g AS (SELECT user_id, ts, batch_ts, ts % {5 * HOUR} = 0 AS miss, ts % {3 * HOUR} = 0 AS shifted, ts % {4 * HOUR} = 0 AS nobatch, ts % {6 * HOUR} = 0 AS nopose FROM smp)
SELECT CASE WHEN miss THEN 'grid_entry_missing' WHEN shifted THEN 'grid_entry_differs' WHEN nobatch THEN 'batch_missing' END AS code, user_id || '@' || ts AS subject FROM g WHERE miss OR shifted OR nobatch
UNION ALL SELECT 'pose_missing', user_id || '@' || ts FROM g WHERE nopose""")
def sample_references(spark, sf_dir):
    t = F.col("ts")
    samples = _parts(spark, sf_dir)[0].select("user_id", "ts", "batch_ts", F.concat_ws("@", "user_id", "ts").alias("pose_token"))
    grid = samples.select("user_id", t.alias("target_ts"), F.when(t % (5 * HOUR) != 0, F.col("batch_ts") + (t % (3 * HOUR) == 0).cast("long")).alias("batch_ts"))
    batches = samples.where(t % (4 * HOUR) != 0).select("user_id", "batch_ts")
    return validity.reference_findings(samples, grid, batches, samples.where(t % (6 * HOUR) != 0).select(F.col("pose_token").alias("token")), "user_id")


@query(f"""WITH {_EV}, s AS (SELECT user_id, max(ts_ns) - min(ts_ns) + 1 AS duration_ns FROM ev GROUP BY user_id) SELECT * FROM s""")
def recording_durations(spark, sf_dir):
    ev = events(spark, sf_dir)
    offsets = ev.join(ev.groupBy("user_id").agg(F.min("ts_ns").alias("a")), "user_id").select("user_id", (F.col("ts_ns") - F.col("a")).alias("offset"))
    return control.recording_durations(offsets, "user_id", "offset")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY o_orderstatus")
def status_counts(spark, sf_dir):
    return control.status_counts(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status")), "status")


@query("""WITH s AS (SELECT CAST(c_custkey AS VARCHAR) AS r, unnest(['front', 'rear']) AS cam, c_custkey AS k FROM customer), f AS (SELECT *, cam = 'front' AS fr FROM s)
SELECT CASE WHEN k % 11 = 0 AND fr THEN 'slot_missing' WHEN k % 7 = 0 THEN 'path_differs' WHEN k % 5 = 0 THEN 'status_differs' WHEN k % 3 = 0 AND fr THEN 'camera_missing' END AS code, r || '@' || cam AS subject FROM f
WHERE (k % 11 = 0 AND fr) OR k % 7 = 0 OR k % 5 = 0 OR (k % 3 = 0 AND fr)""")
def control_contract(spark, sf_dir):
    k = F.col("c_custkey")
    slots = table(spark, sf_dir, "customer").select(k.cast("string").alias("r"), k, F.explode(F.array(F.lit("front"), F.lit("rear"))).alias("cam"))
    slots = slots.withColumn("path", F.when(k % 3 != 0, F.concat_ws("/", "r", "cam"))).withColumn("status", F.when(k % 3 != 0, "blurred").otherwise("missing"))
    viewer = slots.withColumn("status", F.when(k % 5 == 0, "other").otherwise(F.col("status")))
    other = slots.withColumn("path", F.when(k % 7 == 0, "x").otherwise(F.col("path"))).where(~((k % 11 == 0) & (F.col("cam") == "front")))
    return control.contract_findings(slots, viewer, other, ["r", "cam"], ["rear"])


@query("""SELECT 'path_repeated' AS code, 'data/tables/' || s_name AS subject FROM supplier WHERE s_suppkey % 9 = 0 UNION ALL SELECT 'path_unknown', 'data/other/' || s_name FROM supplier WHERE s_suppkey % 4 = 0
UNION ALL SELECT 'path_dated', 'log/2024-0' || (s_suppkey % 9 + 1) || '-11/' || s_name FROM supplier WHERE s_suppkey % 6 = 0 UNION ALL SELECT 'path_missing', 'data/required.json'""")
def release_tree(spark, sf_dir):
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    paths = lambda where, *parts: s.where(where).select(F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)).alias("path"))
    files = paths("true", "data/tables/", F.col("s_name")).unionAll(paths("s_suppkey % 9 = 0", "data/tables/", F.col("s_name"))).unionAll(paths("s_suppkey % 4 = 0", "data/other/", F.col("s_name")))
    files = files.unionAll(paths("s_suppkey % 6 = 0", "log/2024-0", (k % 9 + 1).cast("string"), "-11/", F.col("s_name")))
    return control.tree_findings(files, ["data/tables/"], ["data/required.json"])


@query("SELECT CAST(s_suppkey + 1000000 AS VARCHAR) AS id, 'data/tables/camera=front/part_' || (s_suppkey + 1000000) || '.parquet' AS path FROM supplier")
def recording_tables(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1000000).cast("string").alias("id"))
    files = lambda camera: s.select(F.concat(F.lit(f"data/tables/camera={camera}/part_"), "id", F.lit(".parquet")).alias("path"))
    return control.recording_tables(files("front").unionAll(files("rear")), s, "id", "data/tables/", "front")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS recording_id, l_linenumber AS frame_index, epoch_us(l_shipdate) AS recording_offset_ns, 'depth' AS artifact_kind, min(l_partkey) AS frame_id FROM lineitem GROUP BY ALL HAVING max(l_quantity) > 30")
def dense_references(spark, sf_dir):
    item = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("recording_id"), F.col("l_linenumber").alias("frame_index"), F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', l_shipdate)").alias("recording_offset_ns"), "l_partkey", "l_quantity")
    item = item.groupBy("recording_id", "frame_index", "recording_offset_ns").agg(F.min("l_partkey").alias("frame_id"), F.max("l_quantity").alias("l_quantity"))
    index = item.where("l_quantity > 30").drop("frame_id", "l_quantity").withColumns({
        "artifact_kind": F.lit("depth"), "dtype": F.lit("uint16"), "width": F.lit(4), "height": F.lit(3), "member_path": F.concat_ws("/", "recording_id", "frame_index"),
        "payload_bytes": F.lit(24), "payload_sha256": F.sha2("recording_id", 256), "shard_path": F.lit("data/dense/a.tar"),
    })
    key = ["recording_id", "frame_index", "recording_offset_ns"]
    halves = [index.where("frame_index % 2 = 0"), index.where("frame_index % 2 = 1")]
    return control.dense_references(halves, item, key).select(*key, "artifact_kind", "frame_id")


@query("SELECT 'r' || o_custkey AS recording_id, o_orderkey AS window_index, o_orderkey * 10 AS window_start_offset_ns FROM orders WHERE o_custkey % 2 = 0")
def scenario_windows(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    none = F.array().cast("array<string>")
    rows = o.select(
        F.lit("v1").alias("schema_version"), F.lit("abc").alias("source_revision"), F.concat(F.lit("r"), "o_custkey").alias("recording_id"), k.alias("window_index"), (k * 10).alias("window_start_offset_ns"), (k * 10 + 5).alias("window_end_offset_ns"),
        F.lit("turn").alias("motion_label"), F.array(F.lit("a"), F.lit("b")).alias("validity_tags"), none.alias("quality_tags"), none.alias("anomaly_reasons"), F.lit(0.5).alias("confidence"), F.lit("run1").alias("run_id"), "o_custkey",
    )
    durations = rows.groupBy("recording_id").agg(F.max("window_end_offset_ns").alias("duration_ns"))
    chosen = rows.where("o_custkey % 2 = 0").select("recording_id")
    return control.scenario_windows(rows.drop("o_custkey"), durations, "abc", "v1", chosen).select("recording_id", "window_index", "window_start_offset_ns")


@query("SELECT CAST(c_custkey AS VARCHAR) AS token, CASE WHEN c_custkey % 10 = 0 THEN 'missing' WHEN c_custkey % 7 = 0 THEN 'changed' END AS fault FROM customer WHERE c_custkey % 10 = 0 OR c_custkey % 7 = 0 UNION ALL SELECT 'x' || c_custkey, 'unknown' FROM customer WHERE c_custkey % 13 = 0")
def recomputed_differences(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    want = c.select(k.cast("string").alias("token"), "c_name", "c_acctbal", k)
    got = want.where(k % 10 != 0).withColumn("c_name", F.when(k % 7 == 0, "").otherwise(F.col("c_name")))
    more = want.where(k % 13 == 0).withColumn("token", F.concat(F.lit("x"), "token"))
    return graph.table_differences(got.unionByName(more).drop("c_custkey"), want.drop("c_custkey"), ["token"])


@query(f"WITH {_SELECT} SELECT token, rule_index, 'changed' AS fault FROM cs WHERE rank < '1'")
def selection_validation(spark, sf_dir):
    """A selection with some decisions turned around, against what its rules
    give anew from rows in another order."""
    again = selection.select_quotas(scene_rows(spark, sf_dir).repartition(5, "token"), ["token", "source"], _rules(), SEED, identity.json_object(digest=identity.json_string(F.col("source"))))[0]
    wrong = _selected(spark, sf_dir)[0].withColumn("selected", F.col("selected") != (F.col("rank") < "1"))
    return graph.table_differences(wrong.drop("source"), again.drop("source"), ["token", "rule_index"])


@query("SELECT CAST(doc_id AS VARCHAR) AS token, 'changed' AS fault FROM documents WHERE doc_id % 17 = 0")
def split_validation(spark, sf_dir):
    """A split with some sides turned around, against the one its seed gives."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("token"), "source", "lang", "doc_id")
    right = selection.split_scenes(docs, "token", "source", "0.2", SEED, "lang")[0]
    turned = F.when(F.col("split") == "test", "train").otherwise("test")
    wrong = right.withColumn("split", F.when(F.col("doc_id") % 17 == 0, turned).otherwise(F.col("split")))
    return graph.table_differences(wrong.select("token", "split", "rank"), right.select("token", "split", "rank"), ["token"])


@query("""SELECT 'identity_left_only' AS code, c_custkey || '@' || c_nationkey AS subject FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT 'scene_missing', c_custkey || '@' || c_nationkey FROM customer WHERE c_custkey % 9 = 0
UNION ALL SELECT 'scene_name_differs', c_custkey || '@' || c_nationkey FROM customer WHERE c_custkey % 4 = 0 AND c_custkey % 9 <> 0 UNION ALL SELECT 'source_foreign', '99' UNION ALL SELECT 'scene_repeated', '7@99'""")
def split_inputs(spark, sf_dir):
    k = F.col("c_custkey")
    features = table(spark, sf_dir, "customer").select(k, "c_nationkey", F.col("c_name").alias("scene_name"))
    scenes = features.where(k % 9 != 0).withColumn("scene_name", F.when(k % 4 == 0, "").otherwise(F.col("scene_name")))
    extra = spark.createDataFrame([(7, 99, "x")] * 2, scenes.schema)
    return graph.split_input_findings(features, features.where(k % 5 != 0), scenes.unionByName(extra), ["c_custkey", "c_nationkey"])


@query("SELECT CAST(o_orderkey AS VARCHAR) AS sample_data_token, 'c' || o_custkey AS ego_pose_token, c_acctbal AS x FROM orders JOIN customer ON o_custkey = c_custkey")
def record_poses(spark, sf_dir):
    data = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("token"), F.concat(F.lit("c"), "o_custkey").alias("ego_pose_token"))
    poses = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("token"), F.col("c_acctbal").alias("x"))
    return Dataset({"sample_data": data, "ego_pose": poses}).record_poses()


@query("""WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderkey AS VARCHAR) AS t FROM orders)
SELECT 'record_missing' AS code, t AS subject FROM o WHERE o_orderkey % 6 = 0 UNION ALL SELECT 'source_differs', t FROM o WHERE o_orderkey % 8 = 0
UNION ALL SELECT 'window_tokens_differ', CAST(c AS VARCHAR) FROM (SELECT DISTINCT o_custkey AS c FROM o WHERE o_custkey % 5 = 0) UNION ALL SELECT 'window_missing', CAST(c AS VARCHAR) FROM (SELECT DISTINCT o_custkey AS c FROM o WHERE o_custkey % 5 = 1)""")
def scene_evidence(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("o_orderkey")
    token = k.cast("string")
    refs = F.array_sort(F.collect_list(token))
    scenes = o.groupBy("o_custkey").agg(refs.alias("annotation_refs")).select(F.col("o_custkey").cast("string").alias("scene_token"), F.lit("d").alias("source_digest"), "annotation_refs", F.concat(F.lit("w"), "o_custkey").alias("annotation_window_ref"), "o_custkey")
    windows = scenes.where("o_custkey % 5 <> 1").select(F.col("annotation_window_ref").alias("token"), "source_digest", F.when(F.col("o_custkey") % 5 == 0, F.array(F.lit("x"))).otherwise(F.col("annotation_refs")).alias("annotation_tokens"))
    records = o.where(k % 6 != 0).select(token.alias("token"), F.lit("d").alias("source_digest"))
    matches = o.select(token.alias("annotation_token"), F.when(k % 8 == 0, "e").otherwise("d").alias("source_digest"))
    return Dataset({"annotation_scenes": scenes.drop("o_custkey"), "annotation_records": records, "annotation_matches": matches, "annotation_windows": windows}).scene_evidence()[1]


@query("""SELECT user_id, sha256('{"digest_kind":"user","repo_path":"r/' || user_id || '"}') AS digest, CASE WHEN user_id % 2 = 0 THEN 'r/' || user_id ELSE CAST(user_id AS VARCHAR) END AS locator FROM (SELECT DISTINCT user_id FROM events)""")
def source_fingerprints(spark, sf_dir):
    u = table(spark, sf_dir, "events").select("user_id").distinct()
    path = F.concat(F.lit("r/"), F.col("user_id").cast("string"))
    return u.select("user_id", config.source_digest(digest_kind="user", repo_path=path).alias("digest"), config.locator(F.when(F.col("user_id") % 2 == 0, path), F.col("user_id").cast("string")).alias("locator"))


@query(f"""WITH {_EV} SELECT user_id, event_type AS topic, event_id AS sequence, ts_ns AS log_time, row_number() OVER (PARTITION BY user_id ORDER BY ts_ns, event_id) - 1 AS position, strlen(props) AS size FROM ev WHERE event_type <> 'view'""")
def recording_index(spark, sf_dir):
    """Events written as one container a user, and its index without payloads read back."""
    ev = events(spark, sf_dir)
    kinds = [r[0] for r in ev.select("event_type").distinct().orderBy("event_type").collect()]
    rows = ev.select("user_id", F.col("event_type").alias("topic"), F.col("event_id").alias("sequence"), F.col("ts_ns").alias("time"), F.encode("props", "utf-8").alias("data"))
    boxes = files_out.containers(rows, "user_id", {k: (f"kit.{k}", b"") for k in kinds})
    found = recordings.read_messages(boxes, [k for k in kinds if k != "view"], key="user_id")
    return found.select("user_id", "topic", "sequence", "log_time", "position", "size")


@query("SELECT DISTINCT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 'frame_missing' ELSE 'size_differs' END AS fault FROM lineitem WHERE l_orderkey % 3 = 0 OR l_linenumber = 2")
def frame_evidence(spark, sf_dir):
    labels = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.lit(4).alias("width"), F.lit(3).alias("height"))
    frames = labels.where("l_orderkey % 3 <> 0").withColumn("width", F.when(F.col("l_linenumber") == 2, 5).otherwise(4)).distinct()
    return recordings.frame_evidence(labels.distinct(), frames, ["l_orderkey", "l_linenumber"])


@query(f"""WITH {_GRAPH} SELECT 'scene_ends' AS code, sc.token AS subject FROM sc LEFT JOIN (SELECT scene_token, count(*) AS d FROM sa WHERE ts % {11 * HOUR} = 0 GROUP BY scene_token) x ON x.scene_token = sc.token WHERE coalesce(d, 0) <> CASE WHEN ordinal % 3 = 1 THEN 1 ELSE 0 END
UNION ALL SELECT 'pose_unused', 'extra' UNION ALL SELECT 'ego_pose_geometry', token FROM da WHERE camera_index % 50 = 0 AND camera_index % 41 <> 0
UNION ALL SELECT 'sample_data_ego_pose_token_unknown', token FROM da WHERE camera_index % 41 = 0 UNION ALL SELECT 'sample_token_repeated', token FROM sa WHERE ts % {11 * HOUR} = 0
UNION ALL SELECT code, token FROM (SELECT token, ts, lag(ts) OVER w AS p, lead(ts) OVER w AS n, unnest(['sample_prev_mismatch', 'sample_next_mismatch', 'sample_order_not_increasing']) AS code FROM sa WINDOW w AS (PARTITION BY scene_token ORDER BY ts)) WHERE ts % {11 * HOUR} = 0""")
def dataset_validation(spark, sf_dir):
    """The published tables of a graph with faults put in on purpose."""
    scenes, samples, data, _ = _kept_graph(spark, sf_dir)
    scenes = scenes.withColumn("nbr_samples", F.col("nbr_samples") + (F.col("ordinal") % 3 == 1).cast("long"))
    samples = samples.withColumnRenamed("ts", "timestamp")
    samples = samples.unionAll(samples.where(F.col("timestamp") % (11 * HOUR) == 0))
    i = F.col("camera_index")
    data = data.withColumnRenamed("camera_ts", "timestamp").withColumn("ego_pose_token", F.col("token"))
    turned = F.array(F.when(i % 50 == 0, 2.0).otherwise(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0))
    poses = data.where(i % 41 != 0).select("token", F.array(*[F.lit(0.0)] * 3).alias("translation"), turned.alias("rotation"))
    poses = poses.unionAll(spark.createDataFrame([("extra", [0.0] * 3, [1.0, 0.0, 0.0, 0.0])], poses.schema))
    return extensions.dataset_findings({"scene": scenes, "sample": samples, "sample_data": data, "ego_pose": poses})


@query("""WITH c AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS t FROM customer)
SELECT 'accepted_and_rejected' AS code, t AS subject FROM c WHERE k % 10 = 0 UNION ALL SELECT 'selection_missing', t FROM c WHERE k % 3 <> 0 AND k % 8 = 0 UNION ALL SELECT 'selection_shared', t FROM c WHERE k % 3 = 0 AND k % 7 = 0
UNION ALL SELECT 'published_left_only', t FROM c WHERE k % 3 = 0 AND k % 4 = 0 UNION ALL SELECT 'split_right_only', t FROM c WHERE k % 3 = 1""")
def audit_validation(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(k, k.cast("string").alias("token"))
    selected = c.where(k % 3 == 0)
    return extensions.audit_findings(c, c.where(k % 10 == 0), selected, c.where(((k % 3 != 0) & (k % 8 != 0)) | ((k % 3 == 0) & (k % 7 == 0))), selected.where(k % 4 != 0), c.where(k % 3 != 2))


@query("""WITH p AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS t FROM part)
SELECT 'fraction_range' AS code, t AS subject FROM p WHERE k % 9 = 0 UNION ALL SELECT 'gap_range', t FROM p WHERE k % 11 = 0 UNION ALL SELECT 'rotation_norm', t FROM p WHERE k % 13 = 0
UNION ALL SELECT 'local_coordinates', t FROM p WHERE k % 5 = 0 UNION ALL SELECT 'record_left_only', t FROM p WHERE k % 17 = 0""")
def pose_extension(spark, sf_dir):
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(k, k.cast("string").alias("sample_data_token"))
    rows = p.select(
        "sample_data_token", F.when(k % 9 == 0, 1.5).otherwise(0.5).alias("fraction"), F.when(k % 11 == 0, -1).alias("sync_gap_before_ns"), F.lit(3).alias("sync_gap_after_ns"),
        F.array(F.when(k % 13 == 0, 0.5).otherwise(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("rotation"), F.when(k % 5 == 0, 1.5).otherwise(2.0).alias("east_m"), F.lit(3.0).alias("north_m"), F.lit(0.1).alias("up_m"),
    )
    return extensions.pose_extension_findings(rows, p.where(k % 17 != 0).select(F.col("sample_data_token").alias("token")), True)


@query("""WITH o AS (SELECT o_custkey AS c, CAST(o_custkey AS VARCHAR) AS s, o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS t FROM orders), g AS (SELECT DISTINCT c, s FROM o)
SELECT 'ratio_range' AS code, s AS subject FROM g WHERE c % 7 = 0 UNION ALL SELECT 'sync_range', s FROM g WHERE c % 8 = 0 UNION ALL SELECT 'coverage_ratio', s FROM g WHERE c % 9 = 0 UNION ALL SELECT 'coverage_order', s FROM g WHERE c % 10 = 0
UNION ALL SELECT 'sample_right_only', t FROM o WHERE k % 12 = 0 UNION ALL SELECT 'sample_time', t FROM o WHERE k % 12 <> 0 AND k % 5 = 0""")
def validity_rows(spark, sf_dir):
    o, c, k = table(spark, sf_dir, "orders"), F.col("o_custkey"), F.col("o_orderkey")
    scene = c.cast("string").alias("scene_token")
    samples = o.select(k.cast("string").alias("token"), scene, (k * 3).alias("timestamp"))
    nested = F.collect_list(F.when(k % 12 != 0, F.struct(k.cast("string").alias("sample_token"), (k * 3000 + 999 + F.when(k % 5 == 0, 1).otherwise(0)).alias("timestamp_ns"))))
    part = lambda name, ratio: F.struct(F.lit(name).alias("channel"), F.lit(1).alias("present"), F.lit(3).alias("expected"), ratio.alias("ratio"))
    third = F.lit(1) / F.lit(3)
    pair = F.array(part("a", F.when(c % 9 == 0, 0.5).otherwise(third)), part("b", third))
    rows = o.groupBy("o_custkey").agg(nested.alias("samples")).select(
        scene, F.lit(1.0).alias("scene_valid_ratio"), F.when(c % 7 == 0, 1.1).otherwise(1.0).alias("source_gnss_valid_ratio"), F.lit(0.0).alias("camera_coverage_ratio"),
        F.when(c % 8 == 0, -1.0).otherwise(1.0).alias("max_abs_sync_error_ms"), F.lit(0.5).alias("mean_abs_sync_error_ms"), F.when(c % 10 == 0, F.reverse(pair)).otherwise(pair).alias("coverage"), "samples",
    )
    return extensions.validity_row_findings(rows, samples)


@query("""WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS t FROM supplier)
SELECT 'scene_right_only' AS code, t AS subject FROM s WHERE k % 6 = 0 UNION ALL SELECT 'owner_differs', t FROM s WHERE k % 4 = 0 AND k % 6 <> 0 UNION ALL SELECT 'tags_unordered', t FROM s WHERE k % 5 = 0 AND k % 6 <> 0""")
def scene_extension(spark, sf_dir):
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(k, k.cast("string").alias("token"), F.lit("d").alias("source_digest"))
    tags = F.when(k % 5 == 0, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    extension = s.where(k % 6 != 0).select(F.col("token").alias("scene_token"), F.when(k % 4 == 0, "e").otherwise("d").alias("source_digest"), tags.alias("tags"))
    return extensions.scene_extension_findings(extension, s)


@query(f"SELECT ev.user_id, ev.ts_ns FROM (SELECT user_id, epoch_us(ts) * 1000 AS ts_ns FROM events) ev ANTI JOIN (SELECT user_id, batch_ts AS ts_ns FROM ({SQL['grid_match']}) g WHERE batch_ts IS NOT NULL) used USING (user_id, ts_ns)")
def unused_batches(spark, sf_dir):
    ev = events(spark, sf_dir)
    grid = timegrid.match_grid(ev, "user_id", "ts_ns", ["event_id"], Fraction(1, 86400), 6 * HOUR)
    return timegrid.unused_batches(ev, grid, "user_id", "ts_ns")


@query("""WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE (c_custkey % 10) / 10 END AS a, (c_custkey % 7) / 10 AS b, c_acctbal / 100 AS e FROM customer)
SELECT k, concat_ws(',', CASE WHEN coalesce(a, 0) < 0.5 THEN 'channel_coverage_below_minimum' END, CASE WHEN b > 0.5 THEN 'channel_coverage_above_maximum' END, CASE WHEN e > 50 THEN 'sync_error_above_maximum' END) AS reasons FROM c""")
def coverage_filter(spark, sf_dir):
    k = F.col("c_custkey")
    a = F.when(k % 4 != 0, F.create_map(F.lit("a"), (k % 10) / 10)).otherwise(F.create_map().cast("map<string,double>"))
    c = table(spark, sf_dir, "customer").select(k.alias("k"), F.map_concat(a, F.create_map(F.lit("b"), (k % 7) / 10)).alias("coverage"), (F.col("c_acctbal") / 100).alias("e"))
    f = policy.SceneFilter(min_channel_coverage={"a": 0.5}, max_channel_coverage={"b": 0.5}, max_sync_error=("e", 50.0))
    return c.select("k", F.array_join(F.transform(policy.rejection_reasons(f), lambda r: r["code"]), ",").alias("reasons"))


@query("""WITH v AS (SELECT event_id, value / 40 AS x, value / 70 AS y, -value / 90 AS z FROM events), n AS (SELECT *, sqrt(x * x + y * y + z * z) AS a FROM v)
SELECT event_id, round(cos(a / 2), 9) AS w, round(CASE WHEN a > 0 THEN x * sin(a / 2) / a ELSE 0 END, 9) AS i, round(CASE WHEN a > 0 THEN y * sin(a / 2) / a ELSE 0 END, 9) AS j, CAST(floor(event_id * 0.3::DECIMAL(4,1) + 0.5) AS BIGINT) AS target,
 CASE WHEN event_id % 3 = 0 THEN event_id::DOUBLE END AS leaf FROM n""")
def rotations_and_leaves(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_id", (F.col("value") / 40).alias("x"), (F.col("value") / 70).alias("y"), (-F.col("value") / 90).alias("z"))
    q = scalar.axis_angle_quaternion(F.col("x"), F.col("y"), F.col("z"))
    text = F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string")).otherwise(F.concat(F.lit("0"), F.col("event_id").cast("string"), F.lit(".0")))
    return ev.withColumn("q", q).select("event_id", *(F.round(F.get("q", i), 9).alias(n) for i, n in enumerate("wij")), scalar.half_up_target(F.col("event_id"), "0.3").alias("target"), scalar.numeric_leaf(text).alias("leaf"))


@query("""SELECT c_custkey, CAST(c_custkey + 0.25 * 2 AS DOUBLE) AS n, 'up' AS same, CASE WHEN c_custkey % 2 = 0 THEN 'left' ELSE 'right' END AS far FROM customer""")
def quality_blend(spark, sf_dir):
    k = F.col("c_custkey")
    pair = lambda n, far, own: F.create_map(F.lit("n"), n.cast("string"), F.lit("same"), F.lit("up"), F.lit("far"), F.lit(far), F.lit(own), F.lit("x"))
    c = table(spark, sf_dir, "customer").select(k, pair(k, "left", "a").alias("a"), pair(k + 2, "right", "b").alias("b"))
    near = c.withColumns({"m": scalar.mapped_blend(F.col("a"), F.col("b"), F.lit(0.25)), "f": scalar.mapped_blend(F.col("a"), F.col("b"), F.when(k % 2 == 0, 0.25).otherwise(0.5))})
    return near.select("c_custkey", F.element_at("m", "n").cast("double").alias("n"), F.element_at("m", "same").alias("same"), F.element_at("f", "far").alias("far"))
