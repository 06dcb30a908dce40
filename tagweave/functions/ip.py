"""IPv4 text to number."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def with_ip_number(df: DataFrame, ip: str, number: str) -> DataFrame:
    """Add '10.1.0.2' as 167837698 (bigint); null when the text is no IPv4 address.

    Octets become columns of their own, so that each text is split once. In a single
    expression the split would be evaluated for every octet and every check.
    """
    octets = [f"_{number}_{i}" for i in range(4)]
    split = df.withColumn("_octets", F.split(ip, r"\."))
    parsed = split.select(*df.columns, F.size("_octets").alias("_octet_count"), *[
        F.get("_octets", F.lit(i)).try_cast("int").alias(name) for i, name in enumerate(octets)])
    valid = reduce(lambda a, b: a & b, [F.col(o).between(0, 255) for o in octets], F.col("_octet_count") == 4)
    value = reduce(lambda a, b: a * 256 + b, [F.col(o) for o in octets[1:]], F.col(octets[0]).cast("bigint"))
    return parsed.select(*df.columns, F.when(valid, value).alias(number))
