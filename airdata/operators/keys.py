"""Keys and deduplication: K-01 .. K-06.

All operators are DataFrame -> DataFrame and stay distributed. None of them
gathers rows on the driver or runs a window without a partition key over the
whole input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airdata.functions.scalar import with_scalar
from airdata.operators.graph import connected_components
from airdata.operators.scan import numbered
from airdata.sources.tables import written


def assign_surrogate_key(df: DataFrame, order_by, id_col: str, start=1,
                         num_partitions: int | None = None) -> DataFrame:
    """K-01: ``id = start - 1 + row_number() over (order by order_by)``.

    A window without a partition key runs in one task; ``scan.numbered`` sorts
    the rows in ranges and adds up a row count a range instead. Nothing is
    written on the way, and the ids are the same however often the plan runs.
    ``start`` may be a Column (e.g. a scalar ``max(id) + 1`` from a one-row
    frame) or an int. ``order_by`` must be ascending and a total order.
    """
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (numbered(df, order_by, "_k01", num_partitions)
            .withColumn(id_col, (start_col + F.col("_k01") - 1).cast("bigint")).drop("_k01"))


def number_rows(rows: DataFrame, order_by, id_col: str, name: str) -> DataFrame:
    """K-01 for a table that is written down anyway (``rows`` is one): the ids of
    ``assign_surrogate_key`` from 1, each row sorted and written once.

    Spark's range partitioning sorts the rows in tasks; a row keeps its place in
    its task, and the rows of the tasks before it are added up when the table is
    read. ``order_by`` must be ascending and a total order of column names.
    """
    place = F.monotonically_increasing_id()   # task and place in the task
    dealt = rows.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("_k01", place)
    stored = written(dealt, name).withColumn("_task", F.shiftright("_k01", 33))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)   # a row a task
    offsets = (stored.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
                     .select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    at = F.col("_k01") - F.shiftleft("_task", 33) + F.col("_before") + 1
    return stored.join(F.broadcast(offsets), "_task").select(at.cast("bigint").alias(id_col), *rows.columns)


def next_key_after_max(new_rows: DataFrame, existing: DataFrame, id_col: str,
                       order_by, num_partitions: int | None = None) -> DataFrame:
    """K-01 incremental form: new ids continue after ``max(existing.id)``.

    The maximum is a scalar subquery.
    """
    base = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_k01_max"))
    keyed = assign_surrogate_key(new_rows, order_by, "_k01_rank", start=1,
                                 num_partitions=num_partitions)
    return (with_scalar(keyed, base)
                 .withColumn(id_col, (F.col("_k01_max") + F.col("_k01_rank")).cast("bigint"))
                 .drop("_k01_max", "_k01_rank"))


def first_per_key(df: DataFrame, keys, order_by) -> DataFrame:
    """Keep the first row of each key group by ``order_by``; null keys never
    collide, so rows with any null key are all kept.

    The cut ``row_number() = 1`` is planned with a group limit before the
    shuffle, so a key holding a third of all rows leaves one row a task.
    """
    keys = list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    w = Window.partitionBy(*keys).orderBy(*order_by)
    firsts = (df.filter(~any_null).withColumn("_first", F.row_number().over(w))
                .filter(F.col("_first") == 1).drop("_first"))
    return firsts.unionByName(df.filter(any_null))


def insert_ignore(target: DataFrame, candidates: DataFrame, keys, order_by) -> DataFrame:
    """K-02 / K-03: ``INSERT ... ON CONFLICT (keys) DO NOTHING``.

    Returns the rows that would be inserted: the first candidate per key (by
    ``order_by``), minus keys already in ``target``. Rows with a null key
    never conflict and are all inserted.
    """
    keys = list(keys)
    firsts = first_per_key(candidates, keys, order_by)
    t = target.select(*keys).filter(
        reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return firsts.join(t, on=keys, how="left_anti")


#: Rows of a conflict component that one task folds.
FOLD = 100_000


def insert_ignore_any_unique(target: DataFrame, candidates: DataFrame,
                             unique_keys, order_col: str, fold: int = FOLD) -> DataFrame:
    """K-04: insert-ignore where a conflict on *any* of several unique keys
    drops the row (``ON CONFLICT DO NOTHING`` without a target).

    A row-by-row fold is order dependent: a row dropped because of an earlier
    row no longer blocks later ones. Only rows that share a key, and rows that
    share one with those, and so on, can matter to each other:

    1. drop candidates that clash with ``target`` on any key; rows that share no
       key with another are kept;
    2. link the others by their keys and find the components, in rounds that
       grow with the logarithm of the longest chain;
    3. fold each component in order, in a task that remembers its keys; a
       component of more than ``fold`` rows goes on in rounds over the cluster
       instead (``_kept_by_rounds``).
    """
    keys = list(unique_keys)
    # equal order values would leave two first rows: number the rows themselves
    rest = [c for c in candidates.columns if c != order_col]
    live = assign_surrogate_key(candidates, [order_col, *rest], "_k04_order")
    for k in keys:
        live = live.join(target.select(k).filter(F.col(k).isNotNull()).distinct(),
                         on=k, how="left_anti")
    live = live.checkpoint()
    links = []
    for k in keys:
        held = live.filter(F.col(k).isNotNull()).select(k, "_k04_order")
        first = held.groupBy(k).agg(F.min("_k04_order").alias("v"))
        links.append(held.join(first, k).filter("_k04_order <> v").select(F.col("_k04_order").alias("u"), "v"))
    nodes, _ = connected_components(reduce(DataFrame.unionByName, links))
    nodes = nodes.select(F.col("node").alias("_k04_order"), "component").checkpoint()
    sizes = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("_rows"))
    giant = nodes.join(sizes.filter(F.col("_rows") > fold).select("component"), "component", "left_semi").select("_k04_order")
    inside = nodes.join(sizes.filter(F.col("_rows") <= fold).select("component"), "component", "left_semi")

    def folded(batches):
        import pyarrow as pa
        now, used = None, None
        for b in batches:
            out, column = [], [b.column(i).to_pylist() for i in range(b.num_columns)]
            for component, order, *values in zip(*column):
                if component != now:
                    now, used = component, [set() for _ in values]
                if all(v is None or v not in u for v, u in zip(values, used)):
                    out.append(order)
                    for v, u in zip(values, used):
                        u.add(v)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["_k04_order"])

    dealt = live.join(inside, "_k04_order").select("component", "_k04_order", *keys)
    kept = dealt.repartition("component").sortWithinPartitions("component", "_k04_order").mapInArrow(folded, "_k04_order long")
    parts = [live.join(nodes.select("_k04_order"), "_k04_order", "left_anti"), live.join(kept, "_k04_order", "left_semi")]
    if not giant.isEmpty():
        parts += _kept_by_rounds(live.join(giant, "_k04_order", "left_semi"), keys, "_k04_order")
    return reduce(DataFrame.unionByName, [p.select(*candidates.columns) for p in parts])


def _kept_by_rounds(undecided: DataFrame, keys, order_col: str) -> list[DataFrame]:
    """The rows that a fold in order keeps, in rounds: a row is *kept* when it is
    the first undecided row in every one of its key groups; undecided rows sharing
    a key with a kept row are *dropped*; repeat until nothing is undecided. Every
    round keeps at least the first undecided row, so there is no cap on them."""
    undecided = undecided.checkpoint()
    kept_parts = []
    while True:
        firsts = None
        for k in keys:
            mins = (undecided.filter(F.col(k).isNotNull())
                             .groupBy(k).agg(F.min(order_col).alias("_m")))
            not_first = (undecided.join(mins, on=k)
                                  .filter(F.col(order_col) != F.col("_m"))
                                  .select(order_col))
            firsts = not_first if firsts is None else firsts.unionByName(not_first)
        kept = undecided.join(firsts.distinct(), on=order_col, how="left_anti")
        kept = kept.checkpoint()
        kept_parts.append(kept)
        rest = undecided.join(kept.select(order_col), on=order_col, how="left_anti")
        for k in keys:
            rest = rest.join(kept.select(k).filter(F.col(k).isNotNull()), on=k, how="left_anti")
        undecided = rest.checkpoint()
        if undecided.isEmpty():
            break
    return kept_parts


def dedup_pairs_against_existing(existing: DataFrame, new_pairs: DataFrame, keys) -> DataFrame:
    """K-05: distinct new key pairs not already present."""
    keys = list(keys)
    return new_pairs.select(*keys).dropDuplicates(keys).join(
        existing.select(*keys), on=keys, how="left_anti")


def new_rows_since(df: DataFrame, previous: DataFrame, id_col: str) -> DataFrame:
    """K-06: rows whose id is above the previous high-water mark.

    The mark is a scalar subquery, so the filter is a comparison with a
    constant that reaches the scan."""
    mark = previous.agg(F.coalesce(F.max(id_col), F.lit(-(2 ** 62))).alias("_hwm"))
    return df.filter(F.col(id_col) > mark.scalar())
