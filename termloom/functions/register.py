"""The engine's functions for SQL users."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from termloom.functions.anchor import _folding

#: Native ones: name, parameters, type and body.
SQL = [
    ("is_meaningful", "s STRING", "BOOLEAN", r"coalesce(s rlike '\\p{L}', false)"),
    ("cjk_ratio", "s STRING", "DOUBLE", r"coalesce(length(regexp_replace(s, '[^一-鿿]', '')) / nullif(length(regexp_replace(s, '(?U)\\s', '')), 0), 0D)"),
    ("foreign_side", "src STRING, tgt STRING", "STRING", "if(cjk_ratio(src) >= cjk_ratio(tgt), 'tgt', 'src')"),
]


def register_udfs(spark: SparkSession) -> list[str]:
    """Make the functions known to a session's SQL; returns their names."""
    for name, parameters, kind, body in SQL:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    spark.udf.register("anchor_slice", F.pandas_udf(_folding, "string"))
    return [s[0] for s in SQL] + ["anchor_slice"]
