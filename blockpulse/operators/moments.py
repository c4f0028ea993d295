"""Cross-product (Gram) matrices of row vectors, summed by Spark.

Each row turns its vector into the flat outer product and the products are added up with
map-side combine; what reaches a Python worker is one small matrix per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outer_product(vector: Column) -> Column:
    return F.flatten(F.transform(vector, lambda a: F.transform(vector, lambda b: a * b)))


def gram(rows: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """(keys, n, gram): row count and flat sum of outer products per group.

    All vectors of a group must have one length and no NULL entries.
    """
    flat = rows.withColumn("_outer", array_to_vector(outer_product(F.col(vector))))
    # The summarizer keeps a running mean, which is turned back into a sum.
    sums = flat.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("_outer")).alias("_mean")
    )
    total = F.transform(vector_to_array("_mean"), lambda m: m * F.col("n"))
    return sums.select(*keys, "n", total.alias("gram"))
