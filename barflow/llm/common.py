"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.session import scratch_path


class Scratch:
    """Written tables that cut lineage, in the folder ``spark.checkpoint.dir`` names.

    ``cut`` writes a frame as Parquet and reads it back, so that later steps
    neither recompute it nor depend on the executor that made it. ``drop``
    deletes tables that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.paths: dict[int, str] = {}

    def cut(self, df: DataFrame, *done: DataFrame) -> DataFrame:
        """Write ``df``; then delete the tables ``done``, which only it needed."""
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self._kept = getattr(self, "_kept", []) + [out]
        self.drop(*done)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path = self.paths.pop(id(t), None)
            if path:
                hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                conf = self.spark._jsc.hadoopConfiguration()
                hadoop.getFileSystem(conf).delete(hadoop, True)


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``."""
    return F.crc32(key.cast("string").cast("binary")) % parts


def lower_ascii(c: Column) -> Column:
    """A-Z only: other scripts keep their case."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ordered_spans(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Spans (start, end, kind) by start, then by the place of their kind in ``kinds``."""
    listed = F.array(*map(F.lit, kinds))
    return F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(listed, s["kind"]).alias("place"),
        s["end"].alias("end"), s["kind"].alias("kind"))))


def listed_spans(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of each span, comma-joined in that order."""
    return F.array_join(F.transform(ordered_spans(spans, kinds), lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end"])), ",")


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
