"""What happens to ranked results afterwards: functions DataFrame to DataFrame, for DataFrame.transform."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def lost_in_middle(results: DataFrame) -> DataFrame:
    """Ranks dealt anew, the best to both ends: 1, 3, 5 ... and back ... 4, 2. Two or fewer results stay."""
    own = Window.partitionBy("query_id")
    place, n = F.col("rank"), F.count(F.lit(1)).over(own)
    new = F.when(n <= 2, place).when(place % 2 == 1, (place + 1) / 2).otherwise(n + 1 - place / 2)
    return results.withColumn("rank", new.cast("int"))


def deduplicate(results: DataFrame, threshold: float = 0.85, column: str = "document") -> DataFrame:
    """Drops a result whose tokens' Jaccard similarity with a better one that stays reaches the threshold.

    A query's results are one array (they are k at most), folded from the best on.
    """
    row = F.struct("rank", F.array_distinct(X.tokens(F.coalesce(column, F.lit("")))).alias("t"), F.struct(*results.columns).alias("row"))
    lists = results.groupBy("query_id").agg(F.array_sort(F.collect_list(row)).alias("all"))
    alike = lambda a, b: F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0)), F.lit(1.0)) >= threshold
    kept = F.aggregate("all", F.slice("all", 1, 0), lambda kept, x: F.when(F.exists(kept, lambda y: alike(x["t"], y["t"])), kept).otherwise(F.concat(kept, F.array(x))))
    again = lists.select(F.posexplode(kept).alias("at", "x"))
    return again.select("at", "x.row.*").withColumn("rank", (F.col("at") + 1).cast("int")).drop("at").select(*results.columns)
