"""Structured JSON log lines ``{ts, level, logger, msg}`` (S-10, S-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the log timestamp format (seconds, no zone).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def to_log_lines(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """S-11: one JSON object per row in column ``value`` (ready for ``write.text``)."""
    extra = extra or []
    return df.select(F.to_json(F.struct(
        F.date_format("ts", TS_FORMAT).alias("ts"), "level", "logger", "msg", *extra)).alias("value"))


def from_log_lines(lines: DataFrame, extra: dict[str, str] | None = None, col: str = "value") -> DataFrame:
    """S-10: JSON lines -> LOG columns (``ts`` as timestamp_ntz); bad lines give NULLs."""
    extra = extra or {}
    fields = [T.StructField("ts", T.StringType()), T.StructField("level", T.StringType()),
              T.StructField("logger", T.StringType()), T.StructField("msg", T.StringType())]
    fields += [T.StructField(k, T._parse_datatype_string(v)) for k, v in extra.items()]
    rec = F.from_json(F.col(col), T.StructType(fields))
    return lines.select(rec.alias("r")).select(
        *[F.col(f"r.{k}") for k in extra],
        F.to_timestamp_ntz(F.col("r.ts"), F.lit(TS_FORMAT)).alias("ts"),
        "r.level", "r.logger", "r.msg")


def write_logs(df: DataFrame, path: str, mode: str = "append") -> None:
    to_log_lines(df).write.mode(mode).text(path)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return from_log_lines(spark.read.text(path))
