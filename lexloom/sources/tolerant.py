"""Documents whose schema grows: known fields typed, unknown ones kept as they came, so that a round trip loses nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, path: str, known: T.StructType) -> DataFrame:
    """JSON lines with the known fields as columns and ``extra``, a map of the other fields' JSON text. Lines that are no object are left out."""
    lines = spark.read.text(path).select("value", F.from_json("value", known).alias("_k"), F.from_json("value", "map<string,string>").alias("_all")).where("_all is not null")
    return lines.select("_k.*", F.map_filter("_all", lambda k, _: ~k.isin(*known.fieldNames())).alias("extra"))


def write(df: DataFrame, path: str) -> None:
    """The inverse: known columns and what ``extra`` holds, one object a line; strings of ``extra`` that are JSON stay JSON."""
    known = [c for c in df.columns if c != "extra"]
    raw = lambda v: F.when(F.try_parse_json(v).isNotNull(), v).otherwise(F.concat(F.lit('"'), F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))
    extra = F.array_join(F.transform(F.map_entries("extra"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), F.coalesce(raw(e["value"]), F.lit("null")))), ",")
    body = F.to_json(F.struct(*known))
    joined = F.when(F.coalesce(extra, F.lit("")) == "", body).when(body == "{}", F.concat(F.lit("{"), extra, F.lit("}"))).otherwise(F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(","), extra, F.lit("}")))
    df.select(joined.alias("value")).write.text(path)
