"""Frames and check-text fragments several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkweave.functions.money import sql_mean, sql_total, sql_units  # noqa: F401

# employees of the usual teaching schema: a customer, whose manager is a third of its key
EMP = """emp AS (SELECT c_custkey AS emp_id, c_name AS name, c_nationkey AS dept_id, c_acctbal AS salary,
  CASE WHEN c_custkey > 0 THEN c_custkey // 3 END AS manager_id FROM customer)"""


def employees(t) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("emp_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("dept_id"),
        F.col("c_acctbal").alias("salary"),
        F.expr("CASE WHEN c_custkey > 0 THEN c_custkey div 3 END").alias("manager_id"),
    )


def n_rows():
    return F.count(F.lit(1))


def day(c):
    return F.col(c).cast("date") if isinstance(c, str) else c.cast("date")


def month(c):
    return F.trunc(day(c), "month")


def tagged(**frames: DataFrame) -> DataFrame:
    """Union of frames with the argument name in column ``form``."""
    out = None
    for name, df in frames.items():
        df = df.withColumn("form", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out


def sql_tagged(**texts: str) -> str:
    return " UNION ALL ".join(f"SELECT *, '{k}' AS form FROM ({v})" for k, v in texts.items())


#: Checksums in a check text: ``crc_table`` goes before (in a recursive WITH), ``sql_crc32`` gives the checksum of a string.
SQL_CRC_TABLE = """crc_steps(i, k, v) AS (SELECT i, 0, i FROM range(256) t(i) UNION ALL
 SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_steps WHERE k = 8)"""


def sql_crc32(hexed: str) -> str:
    """Of ``hex(encode(string))``, in a query that has ``crc_table`` in its FROM."""
    return f"""xor(list_reduce(list_transform(range(0, len({hexed}) // 2), lambda i: ('0x' || substr({hexed}, 2 * i + 1, 2))::BIGINT),
 lambda a, b: xor(crc_table.t[xor(a, b) % 256 + 1], a >> 8), 4294967295::BIGINT), 4294967295::BIGINT)"""
