"""Read-only view of a published dataset: tables, exact lookups, chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.graph import TABLES
from ..operators.labels import require


class Dataset:
    """``tables``: name to DataFrame, each with a unique ``token``."""

    def __init__(self, tables: dict[str, DataFrame]):
        self._tables = dict(tables)

    @classmethod
    def read(cls, spark: SparkSession, root: str, names: list[str]) -> Dataset:
        return cls({n: spark.read.parquet(f"{root}/{n}") for n in names})

    @classmethod
    def read_json(cls, spark: SparkSession, root: str, names: Sequence[str] = TABLES) -> Dataset:
        """The published JSON arrays below ``root``; an empty array is a table
        of tokens without rows."""
        found = {n: spark.read.option("multiLine", True).json(f"{root.rstrip('/')}/{n}.json") for n in names}
        return cls({n: df if df.columns else spark.createDataFrame([], "token string") for n, df in found.items()})

    def check_channels(self) -> None:
        """Raise unless each sample has at most one record a channel."""
        cal, sensor = self.table("calibrated_sensor"), self.table("sensor")
        of = cal.select(F.col("token").alias("calibrated_sensor_token"), "sensor_token").join(sensor.select(F.col("token").alias("sensor_token"), "channel"), "sensor_token")
        seen = self.table("sample_data").select("sample_token", "calibrated_sensor_token").join(of, "calibrated_sensor_token")
        require(seen.groupBy("sample_token", "channel").count(), F.col("count") == 1, "records of one sample and channel")

    def table(self, name: str) -> DataFrame:
        """One table; an unknown name is an error."""
        if name not in self._tables:
            raise KeyError(name)
        return self._tables[name]

    def one(self, name: str, where: Column) -> Row:
        """The only row; none or several is an error."""
        got = self.table(name).where(where).limit(2).collect()
        if len(got) != 1:
            raise LookupError(f"{'no' if not got else 'more than one'} row in {name}")
        return got[0]

    def get(self, name: str, token: str) -> Row:
        return self.one(name, F.col("token") == token)

    def field2token(self, name: str, field: str, value: object) -> list[str]:
        return [r[0] for r in self.table(name).where(F.col(field) == F.lit(value)).select("token").orderBy("token").collect()]

    def select(self, name: str, **equal: object) -> DataFrame:
        """Rows that equal all filters given; None doesn't filter."""
        out = self.table(name)
        for field, value in equal.items():
            if value is not None:
                out = out.where(F.col(field) == F.lit(value))
        return out

    def scenes_in_split(self, split: str) -> DataFrame:
        return self.select("scene", split=split)

    def scene_samples(self, token: str) -> DataFrame:
        """A scene's samples in order; broken links raise."""
        w = Window.orderBy("timestamp")  # one scene
        s = self.table("sample").where(F.col("scene_token") == token)
        s = s.withColumns({"__p": F.coalesce(F.lag("token").over(w), F.lit("")), "__n": F.coalesce(F.lead("token").over(w), F.lit(""))})
        require(s, (F.col("prev") == F.col("__p")) & (F.col("next") == F.col("__n")), "broken sample chain")
        return s.drop("__p", "__n").orderBy("timestamp")

    def camera(self, sample_token: str, channel: str) -> Row:
        """The (sample, channel) record through its calibration and sensor."""
        data, cal, sensor = self.table("sample_data"), self.table("calibrated_sensor"), self.table("sensor")
        named = data.join(cal.select(F.col("token").alias("calibrated_sensor_token"), "sensor_token"), "calibrated_sensor_token").join(sensor.select(F.col("token").alias("sensor_token"), "channel"), "sensor_token")
        got = named.where((F.col("sample_token") == sample_token) & (F.col("channel") == channel)).limit(2).collect()
        if len(got) != 1:
            raise LookupError(f"{len(got)} records of {channel}")
        return got[0]

    def check_keys(self) -> None:
        """Raise unless every table's tokens are there and unique."""
        for name, df in self._tables.items():
            if "token" in df.columns:
                require(df.groupBy("token").count(), F.col("token").isNotNull() & (F.col("count") == 1), f"tokens of {name}")

    def ego_pose(self, sample_data_token: str) -> Row:
        """The pose that one record refers to."""
        return self.get("ego_pose", self.get("sample_data", sample_data_token)["ego_pose_token"])

    def record_poses(self) -> DataFrame:
        """Every record's token with its pose, as one join."""
        pose = self.table("ego_pose")
        return self.table("sample_data").select(F.col("token").alias("sample_data_token"), "ego_pose_token").join(pose.withColumnRenamed("token", "ego_pose_token"), "ego_pose_token")

    def annotation(self, kind: str, token: str | None = None) -> DataFrame | Row:
        """Annotation records, matches (by annotation_token), windows or
        scenes; with a token its only row."""
        name = f"annotation_{kind}"
        return self.table(name) if token is None else self.one(name, F.col("annotation_token" if kind == "matches" else "token") == token)

    def scene_evidence(self) -> tuple[DataFrame, DataFrame]:
        """(scene, records, matches and window of each scene summary; findings).

        Findings (code, subject): references given twice or not found, a window
        whose tokens are not exactly the scene's, evidence of another source.
        """
        scenes = self.table("annotation_scenes")
        refs = scenes.select("scene_token", "source_digest", F.posexplode("annotation_refs").alias("place", "token"))
        rec = self.table("annotation_records").select("token", F.col("source_digest").alias("rd"), F.lit(True).alias("r"))
        mat = self.table("annotation_matches").select(F.col("annotation_token").alias("token"), F.col("source_digest").alias("md"), F.lit(True).alias("m"))
        seen = refs.join(rec, "token", "left").join(mat, "token", "left")
        win = self.table("annotation_windows").select(F.col("token").alias("annotation_window_ref"), F.col("annotation_tokens"), F.col("source_digest").alias("wd"))
        held = scenes.join(win, "annotation_window_ref", "left")
        named = F.coalesce(F.col("annotation_window_ref"), F.lit("")) != ""
        faults = [
            (scenes, F.size(F.array_distinct("annotation_refs")) != F.size("annotation_refs"), "reference_repeated", "scene_token"),
            (seen, F.col("r").isNull(), "record_missing", "token"),
            (seen, F.col("m").isNull(), "match_missing", "token"),
            (seen, (F.col("rd") != F.col("source_digest")) | (F.col("md") != F.col("source_digest")), "source_differs", "token"),
            (held, named & F.col("annotation_tokens").isNull(), "window_missing", "scene_token"),
            (held, named & (F.col("annotation_tokens") != F.col("annotation_refs")), "window_tokens_differ", "scene_token"),
            (held, named & (F.col("wd") != F.col("source_digest")), "window_source_differs", "scene_token"),
        ]
        found: DataFrame | None = None
        for df, wrong, code, subject in faults:
            own = df.where(wrong).select(F.lit(code).alias("code"), F.col(subject).cast("string").alias("subject"))
            found = own if found is None else found.unionByName(own)
        members = seen.groupBy("scene_token").agg(F.count("r").alias("records"), F.count("m").alias("matches"))
        out = held.select("scene_token", "source_digest", "annotation_window_ref").join(members, "scene_token", "left").na.fill(0, ["records", "matches"])
        return out, found.distinct()

    def inspect(self) -> DataFrame:
        """name and n of each table."""
        out: DataFrame | None = None
        for name in sorted(self._tables):
            row = self._tables[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
            out = row if out is None else out.unionByName(row)
        return out
