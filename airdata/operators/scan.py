"""Order-dependent building blocks that stay distributed.

Spark evaluates a window without ``partitionBy`` (global rank, global running
sum) in a single task, and a window partitioned by a hot key (one passenger
with a third of the payments) in one task per key. Everything here rests on
``range_bounds`` instead: a sorted list of cut points taken from the order keys
with the smallest hashes. The list is a scalar subquery and depends on the rows
alone, not on how they are partitioned, so the range of a row (``range_of``) is
a pure function of its key: it can be computed twice, or again after a lost
executor, with the same outcome, and no row has to be written down between.

- ``numbered``: global row numbers; only a row count a range is shared.
- ``prefix_sums``, ``running_sum``, ``running``: running aggregates over a total
  order, of all rows or of groups of any size, with carries between ranges.
- ``order_statistics``, ``exact_quantiles``: any number of exact order
  statistics in one plan, without ordering all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys drawn for each cut point.
DRAWN = 32


def _cols(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def key_of(order_by) -> Column:
    """The order key as one value: structs compare field by field, nulls first."""
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_cols(order_by))])


def ranges_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(df: DataFrame, order_by, n: int) -> Column:
    """At most ``n - 1`` ascending cut points of the ascending order of df.

    A scalar subquery: ``DRAWN * n`` keys, those with the smallest hashes, are
    sorted in one small row and every ``DRAWN``-th is a cut point. Only the
    order columns are read for it.
    """
    drawn = df.select(key_of(order_by).alias("k")).orderBy(F.xxhash64("k"), "k").limit(DRAWN * n)
    one = drawn.agg(F.sort_array(F.collect_list("k")).alias("s"))
    step = F.size("s") / F.lit(n)
    cuts = F.transform(F.sequence(F.lit(1), F.lit(max(n - 1, 1))), lambda i: F.get("s", F.floor(i * step).cast("int")))
    return one.select(F.when((F.size("s") > 0) & F.lit(n > 1), cuts).otherwise(F.slice("s", 1, 0)).alias("b")).scalar()


def range_of(bounds: Column, key: Column, n: int) -> Column:
    """Number of cut points at or below the key, by binary search."""
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(max(1, (n - 1).bit_length())))])

    def search(b):
        def step(at, w):
            return F.when((at + w <= F.size(b)) & (F.get(b, at + w - 1) <= key), at + w).otherwise(at)
        return F.aggregate(steps, F.lit(0), step)

    return F.get(F.transform(F.array(bounds), search), F.lit(0))


def with_range(df: DataFrame, order_by, out: str, num_partitions: int | None = None) -> DataFrame:
    n = num_partitions or ranges_of(df)
    if n == 1:
        return df.withColumn(out, F.lit(0))
    cut = df.withColumn("_bounds", range_bounds(df, order_by, n))
    return cut.withColumn(out, range_of(F.col("_bounds"), key_of(order_by), n)).drop("_bounds")


def numbered(df: DataFrame, order_by, out: str, num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by order_by)`` as bigint; ``order_by`` ascending and total.

    The rows are sorted inside their ranges. The offset of a range comes from a
    row count a range, for which only the order columns are read.
    """
    if num_partitions == 1:   # the caller knows that one task will do
        return df.select(*df.columns, F.row_number().over(Window.orderBy(*_cols(order_by))).cast("bigint").alias(out))
    ranged = with_range(df, order_by, "_nr", num_partitions)
    before = Window.orderBy("_nr").rowsBetween(Window.unboundedPreceding, -1)   # a row a range
    offsets = (ranged.groupBy("_nr").agg(F.count(F.lit(1)).alias("_n"))
                     .select("_nr", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    place = F.row_number().over(Window.partitionBy("_nr").orderBy(*_cols(order_by)))
    # a row a range
    return (ranged.withColumn("_at", place).join(F.broadcast(offsets), "_nr")
                  .withColumn(out, F.col("_at") + F.col("_before")).select(*df.columns, out))


def running(df: DataFrame, partition_by, order_by, aggregates: dict, num_partitions: int | None = None) -> DataFrame:
    """Running aggregates over (partition by p order by o rows unbounded preceding).

    ``aggregates``: out -> (column, aggregate function, function that joins two
    of its results), for instance ``(v, F.sum, operator.add)``. A plain window
    puts each group in one task. Here rows are dealt by ranges of (group,
    order), so a group of any size, the null group included, covers as many
    ranges as it needs; the totals by (range, group) give it the carry of its
    earlier ranges. In a range only the first group can have begun before it,
    so there are fewer carries than ranges.
    """
    part, order = list(partition_by), _cols(order_by)
    ranged = with_range(df, [*part, *order], "_rs", num_partitions)
    upto = Window.partitionBy("_rs", *part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*part).orderBy("_rs").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_rs", *part).agg(*[f(c).alias(f"_t{i}") for i, (c, f, _) in enumerate(aggregates.values())])
    carried = [f(f"_t{i}").over(earlier).alias(f"_c{i}") for i, (_, f, _) in enumerate(aggregates.values())]
    carries = (totals.select(F.col("_rs").alias("_rp"), *[F.col(c).alias(f"_p{i}") for i, c in enumerate(part)], *carried,
                             F.lag(F.lit(True)).over(Window.partitionBy(*part).orderBy("_rs")).alias("_later"))
                     .filter("_later").drop("_later"))
    same = F.col("_rs") == F.col("_rp")
    for i, c in enumerate(part):
        same = same & F.col(c).eqNullSafe(F.col(f"_p{i}"))
    local = ranged.withColumns({f"_l{i}": f(c).over(upto) for i, (c, f, _) in enumerate(aggregates.values())})
    joined = {out: F.when(F.col(f"_c{i}").isNull(), F.col(f"_l{i}")).when(F.col(f"_l{i}").isNull(), F.col(f"_c{i}"))
              .otherwise(two(F.col(f"_c{i}"), F.col(f"_l{i}"))) for i, (out, (_, _, two)) in enumerate(aggregates.items())}
    # fewer rows than ranges
    return local.join(F.broadcast(carries), same, "left").withColumns(joined).select(*df.columns, *aggregates)


def _added(value):
    return F.col(value) if isinstance(value, str) else value, F.sum, lambda a, b: a + b


def prefix_sums(df: DataFrame, order_by, sums: dict[str, str],
                num_partitions: int | None = None) -> DataFrame:
    """For each ``value: out``, ``sum(value) over (order by order_by rows
    unbounded preceding)``, all in one ordered pass."""
    return running(df, [], order_by, {out: _added(v) for v, out in sums.items()}, num_partitions)


def prefix_sum(df: DataFrame, order_by, value: str, out: str,
               num_partitions: int | None = None) -> DataFrame:
    """``sum(value) over (order by order_by rows unbounded preceding)``."""
    return prefix_sums(df, order_by, {value: out}, num_partitions)


def running_sum(df: DataFrame, partition_by, order_by, value: str, out: str,
                num_partitions: int | None = None) -> DataFrame:
    """``sum(value) over (partition by p order by o rows unbounded preceding)``."""
    return running(df, partition_by, order_by, {out: _added(value)}, num_partitions)


#: Ranges that the distinct values are cut into, and the accuracy of the sketch that cuts them.
RANGES, ACCURACY = 256, 4096


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """``_v``, ``_c``: the distinct non-null values and their numbers of rows. A hot
    value is counted before the shuffle. The table is written once (a value and
    a number a row), so that whatever df stands for is computed once."""
    return (df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")).checkpoint())


def order_statistics(counts: DataFrame, ranks: dict[str, Column], bounds: list | None = None, below: bool = False) -> DataFrame:
    """One row: for each ``name: rank`` the value at that 0-based rank of the
    ascending order, null where no row has it; with ``below`` also
    ``name_below``, the number of rows with a smaller value, and ``_n``.

    ``counts`` comes from ``value_counts``; a rank is an expression over ``_n``,
    the number of rows. All ranks are found together: the values are cut by one
    set of cut points (a mergeable sketch of the distinct values, or the caller's
    ``bounds``), the rows of a range are counted, and only the ranges that hold a
    wanted rank are put in order, each by itself. Cut points decide how the work
    is dealt and never what comes out.
    """
    if bounds is None:
        marks = [(i + 1) / RANGES for i in range(RANGES - 1)]
        cuts = counts.agg(F.array_distinct(F.percentile_approx("_v", marks, ACCURACY))).scalar()
        n_cuts = RANGES
    else:
        cuts, n_cuts = F.array(*[F.lit(b) for b in bounds]).cast(f"array<{counts.schema['_v'].dataType.simpleString()}>"), len(bounds) + 1
    ranged = counts.withColumn("_cuts", cuts).withColumn("_r", range_of(F.col("_cuts"), F.col("_v"), n_cuts)).drop("_cuts")
    by_range = Window.orderBy("_r")                                             # a row a range
    ends = (ranged.groupBy("_r").agg(F.sum("_c").alias("_s"))
                  .withColumn("_to", F.sum("_s").over(by_range.rowsBetween(Window.unboundedPreceding, 0)))
                  .withColumn("_n", F.sum("_s").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    wanted = F.array(*[rank.cast("bigint") for rank in ranks.values()])
    inside = F.filter(wanted, lambda k: (k >= F.col("_to") - F.col("_s")) & (k < F.col("_to")))
    held = (ends.withColumn("_k", inside).filter(F.size("_k") > 0)
                .agg(F.map_from_entries(F.collect_list(F.struct("_r", F.col("_to") - F.col("_s")))).alias("before"), F.max("_n").alias("n")))
    one = held.select(F.struct("before", "n").alias("h")).scalar()              # a range a rank at most
    upto = Window.partitionBy("_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = (ranged.withColumn("_h", one).filter(F.map_contains_key(F.col("_h.before"), F.col("_r")))
                  .withColumn("_to", F.try_element_at(F.col("_h.before"), F.col("_r")) + F.sum("_c").over(upto))
                  .withColumn("_n", F.col("_h.n")))
    out = []
    for name, k in ranks.items():
        hit = (F.col("_to") > k) & (F.col("_to") - F.col("_c") <= k)
        out.append(F.max(F.when(hit, F.col("_v"))).alias(name))
        if below:
            out.append(F.max(F.when(hit, F.col("_to") - F.col("_c"))).alias(f"{name}_below"))
    if below:
        out.append(F.max("_n").alias("_n"))
    return near.agg(*out)


def value_at(df: DataFrame, value: str, index) -> DataFrame:
    """One row ``v``: the non-null value at a 0-based ``index`` (a function of the
    number of values) in ascending order, exactly."""
    return order_statistics(value_counts(df, value), {"v": index(F.col("_n"))})


def quantiles_of(counts: DataFrame, quantiles, names, bounds: list | None = None) -> DataFrame:
    """One row of linearly interpolated quantiles (doubles) of a table of ``value_counts``."""
    at = [(F.col("_n") - 1) * F.lit(float(q)) for q in quantiles]
    ranks = {}
    for i, x in enumerate(at):
        ranks |= {f"_lo{i}": F.floor(x), f"_hi{i}": F.ceil(x)}
    found = order_statistics(counts, ranks, bounds, below=True)

    def between(i, x):
        lo, hi = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double")
        return lo + (hi - lo) * (x - F.floor(x))

    return found.select(*[between(i, x).alias(name) for i, (x, name) in enumerate(zip(at, names))])


def exact_quantiles(df: DataFrame, value: str, quantiles, names=None) -> DataFrame:
    """One-row frame of linearly interpolated quantiles of ``value``
    (nulls ignored), i.e. ``percentile_cont(q)`` / pandas ``quantile``."""
    names = list(names or [f"q{int(round(q * 100))}" for q in quantiles])
    return quantiles_of(value_counts(df, value), quantiles, names)
