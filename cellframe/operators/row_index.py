"""0-based row numbers per dataset for tables, which have no order of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellframe.schema import ident

INT_MAX = 2**31 - 1
# Boundaries are drawn from a sample of this many rows per bucket.
_SAMPLE_PER_BUCKET = 32
# Keys travel as text to the driver and back; instants keep their microseconds.
_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def with_row_index(
    df: DataFrame,
    order_by: Sequence[str],
    dataset_by: Sequence[str] = (),
    name: str = "row_index",
    rows_per_bucket: int = 1_000_000,
    max_buckets: int = 16_384,
    bucket_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add the position of each row within its dataset, in the order of ``order_by``.

    ``order_by`` has to be a total order within a dataset (rows equal in all keys
    must be interchangeable). A window over the dataset alone would sort each
    dataset in one task, so rows are first cut into ordered buckets: the boundaries
    come from a sample of the keys (they only balance the work, every row is kept),
    a row finds its bucket by binary search, and its index is the number of rows in
    the dataset's earlier buckets plus its rank inside its own. The rows are
    shuffled once, on the bucket; the bucket counts are aggregated before their
    shuffle and are as few as there are buckets and datasets.

    ``bucket_by`` is a leading part of ``order_by``, by default all of it. Boundaries
    and counts then read these columns alone, unless some of its values hold more than
    half a bucket each: the rows of these get a second level of boundaries, over the
    whole of ``order_by``. Only rows equal in all keys are never split.
    Up to ``rows_per_bucket`` rows are one bucket and one task per dataset; beyond
    ``max_buckets`` buckets only their size grows, as the driver holds the boundaries.
    Building runs jobs: a count of rows and, for more than one bucket, a sample for
    each level of boundaries.
    An index past 32 bits is null.
    """
    bucket_by = list(order_by if bucket_by is None else bucket_by)
    if bucket_by != list(order_by)[: len(bucket_by)] or not bucket_by:
        raise ValueError("bucket_by has to be a leading part of order_by")
    total = df.count()
    buckets = min(max_buckets, total // rows_per_bucket + 1)
    if buckets == 1:
        window = _window(dataset_by, order_by)
        return df.withColumn(name, _to_int(F.row_number().over(window) - 1))

    # Dataset and bucket as one struct: never null, so grouping, ranking and joining
    # all need the same partitioning and the rows are not moved again for the join.
    group = F.struct(
        *[F.col(ident(c)).alias(f"set{i}") for i, c in enumerate(dataset_by)],
        _bucket(df, order_by, dataset_by, bucket_by, total, buckets).alias("bucket"),
    )
    placed = df.withColumn("_group", group)
    counts = placed.groupBy("_group").agg(F.count(F.lit(1)).alias("_rows"))
    before = (
        Window.partitionBy(*[f"_group.set{i}" for i in range(len(dataset_by))])
        .orderBy("_group.bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select("_group", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    ranked = placed.withColumn("_rank", F.row_number().over(_window(["_group"], order_by)))
    return ranked.join(offsets, "_group").select(
        *map(ident, df.columns), _to_int(F.col("_before") + F.col("_rank") - 1).alias(name)
    )


def _window(partition: Sequence[str], order_by: Sequence[str]):
    return Window.partitionBy(*map(ident, partition)).orderBy(
        *[F.col(ident(k)).asc_nulls_first() for k in order_by]
    )


def _to_int(index: Column) -> Column:
    """The contract's index has 32 bits: null past them, never wrapped around."""
    return F.when(index <= INT_MAX, index.cast("int"))


def _bucket(
    df: DataFrame, order_by: Sequence[str], dataset_by: Sequence[str], bucket_by: Sequence[str], total: int, buckets: int
) -> Column:
    """The ordered bucket of a row, as a number, or as a pair of numbers if some values need a second level."""
    key = _key([*dataset_by, *bucket_by])
    bounds, share = _boundaries(df.select(key.alias("key")), total, buckets)
    bucket = _bucket_of(key, bounds, buckets)
    if not share or list(bucket_by) == list(order_by):
        return bucket

    def is_heavy(found: Column) -> Column:
        bound = F.get(bounds, found - 1)
        return (bound["heavy"] & bound["key"].eqNullSafe(key)).eqNullSafe(True)

    whole = _key([*dataset_by, *order_by])
    inside = df.where(F.get(F.transform(F.array(bucket), is_heavy), F.lit(0)))
    inner_buckets = int(buckets * share) + 1
    inner, _ = _boundaries(inside.select(whole.alias("key")), max(1, int(total * share)), inner_buckets)

    def both(found: Column) -> Column:
        # A bucket starts with its heavy value; what else is in it comes behind.
        part = F.when(is_heavy(found), _bucket_of(whole, inner, inner_buckets)).otherwise(F.lit(INT_MAX))
        return F.struct(found.alias("outer"), part.alias("inner"))

    return F.get(F.transform(F.array(bucket), both), F.lit(0))


def _key(names: Sequence[str]) -> Column:
    parts = [F.col(ident(k)) for k in names]
    return parts[0] if len(parts) == 1 else F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def _boundaries(keys: DataFrame, total: int, buckets: int) -> tuple[Column, float]:
    """Ordered bucket boundaries (key, heavy: whether it is a heavy value) as one literal array, and the share of rows in such.

    A heavy value holds more than half a bucket of the sample. The driver sees a bounded
    number of sampled keys. The literal makes the bucket of a row the same in every
    evaluation, also when a lost task is run again.
    """
    wanted = buckets * _SAMPLE_PER_BUCKET
    sample = keys.sample(fraction=min(1.0, wanted / total), seed=7)
    by_key = Window.orderBy("key")
    step = F.greatest(F.lit(1), (F.count(F.lit(1)).over(Window.partitionBy()) / buckets).cast("int"))
    equal = F.count(F.lit(1)).over(by_key.rangeBetween(Window.currentRow, Window.currentRow))
    picked = (
        sample.select("key", F.row_number().over(by_key).alias("n"), step.alias("step"), equal.alias("equal"))
        .select("key", ((F.col("equal") > 1) & (2 * F.col("equal") > F.col("step"))).alias("heavy"),
                (F.col("n") % F.col("step") == 0).alias("bound"))
        .agg(
            F.to_json(
                F.sort_array(F.collect_set(F.when(F.col("bound"), F.struct("key", "heavy")))), _JSON
            ).alias("bounds"),
            F.coalesce(F.avg(F.col("heavy").cast("int")), F.lit(0.0)).alias("share"),
        )
        .first()
    )
    schema = f"array<struct<key: {keys.schema['key'].dataType.simpleString()}, heavy: boolean>>"
    # Folded once for all rows. Higher-order functions over it would not be, but run for each step of each row's search.
    return F.sort_array(F.from_json(F.lit(picked["bounds"]), schema, _JSON)), picked["share"]


def _bucket_of(key: Column, bounds: Column, buckets: int) -> Column:
    """How many boundaries are at or below the key, by binary search."""
    # A whole step over the sample leaves fewer than two boundaries per bucket.
    steps = F.array(*[F.lit(1 << p) for p in range((2 * buckets).bit_length() - 1, -1, -1)])
    size = F.size(bounds)

    def search(k: Column) -> Column:
        def advance(found: Column, step: Column) -> Column:
            probe = found + step
            bound = F.get(bounds, probe - 1)["key"]
            hit = (probe <= size) & F.coalesce(bound <= k, bound.isNull())  # a null key is the first of all
            return F.when(hit, probe).otherwise(found)

        return F.aggregate(steps, F.lit(0), advance)

    # The one-element transform builds the key once per row, not once per step.
    return F.get(F.transform(F.array(key), search), F.lit(0))
