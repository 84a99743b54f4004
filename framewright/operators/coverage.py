"""The fixed-length window of a clip that covers the most seeds; row-local, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.functions.ids import EPS, WINDOW_SEC


def with_window(rows: DataFrame, start: str = "start", end: str = "end", seeds: str = "seeds", length: float = WINDOW_SEC) -> DataFrame:
    """Adds window_start, covered and dropped (places in seeds); nulls where the clip is too short or no seed can be covered.

    Of the windows with the most seeds the one whose places come first wins; it is then
    centred on its seeds as far as the clip allows.
    """
    s, n, size = F.col(seeds), F.size(seeds), F.lit(float(length))
    none = F.array().cast("array<int>")
    places = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(none)
    out = rows.withColumns({"__low": F.col(start), "__high": F.greatest(F.col(end) - size, F.col(start)), "__places": places})

    def clamp(v):
        return F.least(F.greatest(v, F.col("__low")), F.col("__high"))

    out = out.withColumn("__starts", F.array_distinct(F.concat(F.array("__low", "__high"), F.transform(s, clamp), F.transform(s, lambda t: clamp(t - size)))))
    out = out.withColumn("__sets", F.transform("__starts", lambda w: F.filter("__places", lambda i: (F.get(s, i) >= w - EPS) & (F.get(s, i) <= w + size + EPS))))
    ranked = F.transform(F.filter("__sets", lambda c: F.size(c) > 0), lambda c: F.struct((-F.size(c)).alias("k"), c.alias("c")))
    fits = F.col(end) - F.col(start) >= size - EPS
    out = out.withColumn("covered", F.when(fits, F.array_min(ranked)["c"]))
    out = out.withColumn("__times", F.transform("covered", lambda i: F.get(s, i)))
    first, last = F.array_min("__times"), F.array_max("__times")
    out = out.withColumns({"__first": first, "__last": last, "__from": F.greatest(F.col("__low"), last - size)})
    out = out.withColumn("__to", F.greatest(F.least("__high", "__first"), F.col("__from")))
    centred = (F.col("__first") + F.col("__last")) / 2.0 - size / 2.0
    out = out.withColumns({"window_start": F.least(F.greatest(centred, F.col("__from")), F.col("__to")), "dropped": F.when(F.col("covered").isNotNull(), F.array_except("__places", "covered"))})
    # least and greatest skip nulls, so a clip without a window is cleared at last
    out = out.withColumn("window_start", F.when(F.col("covered").isNotNull(), F.col("window_start")))
    return out.drop("__low", "__high", "__places", "__starts", "__sets", "__times", "__first", "__last", "__from", "__to")
