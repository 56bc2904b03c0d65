"""Exact ranks within groups of any size, without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def hash_rank(df: DataFrame, key: str, group: str, seed: int = 42, prefix_digits: int = 4, output: str = "rank") -> DataFrame:
    """Position of each row within its group by hash order, and the group size.

    A window over the group would sort a hot group in one task. Instead the
    leading hash digits cut each group into evenly filled cells: counting them
    gives every cell's offset, and only rows of one cell are sorted together.
    """
    hashed = df.withColumn("__h", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))).withColumn(
        "__cell", F.substring("__h", 1, prefix_digits)
    )
    cells = hashed.groupBy(group, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    # At most 16^prefix_digits cells per group, whatever its size.
    before = Window.partitionBy(group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    offsets = cells.select(
        F.col(group).alias("__g"), F.col("__cell").alias("__c"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
        F.sum("__n").over(whole).alias("group_size"),
    )
    within = Window.partitionBy(group, "__cell").orderBy("__h", key)
    return (
        hashed.withColumn("__in_cell", F.row_number().over(within))
        .join(offsets, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__cell") == F.col("__c")))
        .withColumn(output, F.col("__offset") + F.col("__in_cell"))
        .drop("__h", "__cell", "__c", "__g", "__offset", "__in_cell")
    )


def stratified_split(df: DataFrame, key: str, label: str, train_percent: int = 80, seed: int = 42, prefix_digits: int = 4) -> DataFrame:
    """The rows plus ``is_train``: an exact share of every label, repeatable anywhere.

    The train rows of a label are those up to one place in its hash order. Only keys and labels are counted and ranked to find the hash at that place, so whole
    rows (texts) are never shuffled; one cut per label is broadcast. Rows that share the hash of a cut (repeated keys) are numbered, as only some of them are in.
    """
    hashed = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    narrow = df.select(F.col(label).alias("__g"), hashed.alias("__h")).withColumn("__cell", F.substring("__h", 1, prefix_digits))
    cells = narrow.groupBy("__g", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy("__g")
    before = whole.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)  # at most 16^prefix_digits cells per label
    placed = cells.select("__g", "__cell", "__n", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(whole).alias("__size"))
    # Integer form of (rank - 1) / (size - 1) < share, the percent rank of a row.
    share = F.lit(train_percent) * F.greatest(F.col("__size") - 1, F.lit(1))
    placed = placed.withColumn("__last", F.least("__size", F.ceil(share / 100).cast("bigint")) - F.col("__before")).where(F.col("__last").between(1, F.col("__n")))
    cut_cells = placed.select(F.col("__g").alias("__cut_g"), F.col("__cell").alias("__cut_cell"), "__last")
    near = narrow.join(F.broadcast(cut_cells), F.col("__g").eqNullSafe(F.col("__cut_g")) & (F.col("__cell") == F.col("__cut_cell")))
    order = Window.partitionBy("__g").orderBy("__h")  # the rows of one cell of each label
    ranked = near.select("__g", "__h", "__last", F.row_number().over(order).alias("__place"), F.rank().over(order).alias("__first"))
    cuts = ranked.where("__place = __last").select("__g", F.col("__h").alias("__cut"), (F.col("__place") - F.col("__first") + 1).alias("__take"))

    rows = df.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("__g")), "left")
    at_cut = F.coalesce(hashed == F.col("__cut"), F.lit(False))
    clear = rows.where(~at_cut).withColumn("is_train", F.coalesce(hashed < F.col("__cut"), F.lit(False)))
    tied = rows.where(at_cut).withColumn("is_train", F.row_number().over(Window.partitionBy(label).orderBy(key)) <= F.col("__take"))
    return clear.unionByName(tied).drop("__g", "__cut", "__take")


def ordered_position(df: DataFrame, group: list[str], order: list[str], output: str = "position", ranges: int = 64) -> DataFrame:
    """Position of each row, from 1, within its group by ``order``, which should tell rows apart.

    A window over the group would sort a hot group in one task. Here a bounded sample of keys cuts the order of all rows into even ranges:
    rows are numbered within their range, and what earlier ranges hold of a group is added. The sample decides about the cost only.
    """
    key = F.struct(*group, *order)
    drawn = df.select(key.alias("k"), F.xxhash64(*group, *order).alias("h")).orderBy("h").limit(16 * ranges)
    cuts = drawn.agg(F.sort_array(F.collect_list("k")).alias("k")).select(
        F.filter("k", lambda _, i: i % 16 == 15).alias("cuts"))  # at most as many as there are ranges
    placed = df.withColumn("__cuts", cuts.scalar()).withColumn("__range", F.size(F.filter("__cuts", lambda c: c <= key))).drop("__cuts")
    counts = placed.groupBy(*group, "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # at most ``ranges`` rows of a group
    offsets = counts.select(*(F.col(g).alias(f"__{g}") for g in group), F.col("__range").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    within = Window.partitionBy(*group, "__range").orderBy(*order)
    same = F.col("__range") == F.col("__of")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    numbered = placed.withColumn("__place", F.row_number().over(within)).join(offsets, same)
    return numbered.withColumn(output, F.col("__offset") + F.col("__place")).drop("__range", "__of", "__offset", "__place", *(f"__{g}" for g in group))
