"""Cut points are exact at every size."""

import math

from pyspark.sql import functions as F

from tidemark.operators import aggregates, quality


def test_cuts_are_exact_beyond_the_size_of_a_sketch(spark):
    n = 300_007
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("int").alias("even"), F.pow(F.lit(2.0), F.col("id") % 50).alias("wide"),
                               F.when(F.col("id") % 3 == 0, F.col("id")).alias("gaps"))
    cuts = [(k, 5) for k in range(1, 5)]
    got = {r.column_name: list(r.cuts) for r in aggregates.exact_cuts(df, df.columns, cuts).collect()}
    for name, values in {"even": range(n), "wide": sorted(2.0 ** (i % 50) for i in range(n)), "gaps": range(0, n, 3)}.items():
        assert got[name] == [float(values[math.ceil(k * len(values) / of) - 1]) for k, of in cuts], name
    few = quality.profile_columns(df.select("even"), "t", accuracy=20).first()
    assert few.median_value == math.ceil(n / 2) - 1
