"""Places of rows within their group, for groups of any size, and a few SQL pieces for the oracles.

A window over one group would put a group with a third of all rows into one task. Here rows are dealt by ranges of
(group, order), sorted within their partition and written once; the count of each (group, partition) gives the
offset of that partition, and the place of a row in its partition the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskspark.llm.common import materialize

PART_BITS = 33  # of monotonically_increasing_id(): the lower 33 bits count the rows of a partition


def group_key(column: Column) -> Column:
    """A text that is never null and sorts as ``column`` does bytewise, null first."""
    return F.coalesce(F.concat(F.lit("+"), column.cast("string")), F.lit(""))


def numbered(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``df`` as a written table with ``pos`` (0, 1, ... within ``group`` by ``order``, ascending, nulls first) and
    ``n`` (rows of the group). Rows that ``order`` leaves equal are in any order, the same in every later read."""
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(group), *order, F.col("_tie")]
    ranged = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    rows = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("_part", F.shiftright("_at", PART_BITS))
    runs = rows.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(F.min("_at").alias("_lo"), F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy("_g")  # at most one row a partition
    before = F.sum("_c").over(whole.orderBy("_p")) - F.col("_c")
    runs = runs.select("_g", "_p", (before - F.col("_lo")).alias("_shift"), F.sum("_c").over(whole).alias("n"))
    out = rows.join(runs, (F.col(group) == F.col("_g")) & (F.col("_part") == F.col("_p")))
    return out.select(*df.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "n")


def crc32_sql(text: str) -> str:
    """DuckDB: unsigned crc32 of the UTF-8 bytes of a text expression, bit by bit."""
    bits = f"""list_transform(range(octet_length(encode({text})) * 8), lambda i: CASE WHEN i % 8 = 0
        THEN ('0x' || substr(hex(encode({text})), (i // 4 + 1)::INT, 2))::INT::BIGINT ELSE 0 END)"""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda a, b: CASE WHEN xor(a, b) % 2 = 1
        THEN xor(xor(a, b) // 2, 3988292384) ELSE xor(a, b) // 2 END), 4294967295)"""
