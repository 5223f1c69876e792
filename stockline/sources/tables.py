"""Relational extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


_RELATIONS: dict = {}


def read_table(spark: SparkSession, table_dir: str, name: str) -> DataFrame:
    """One Parquet relation. Column pruning and filters reach the scan
    through Catalyst, so callers just select what they need. The relation
    (file listing and footer schema) is resolved once per session and
    path: it is a plan, not data, so reusing it caches nothing."""
    path = f"{table_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    hit = _RELATIONS.get(key)
    if hit is None or hit[0] is not spark:
        hit = (spark, spark.read.parquet(path))
        _RELATIONS[key] = hit
    return hit[1]


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str, lower: int, upper: int,
              num_partitions: int = 64, properties: dict | None = None) -> DataFrame:
    """An ERP extract over JDBC (S1): ``num_partitions`` range queries on the
    numeric ``partition_column``, so that executors pull in parallel and no
    task reads a whole extract. ``lower`` and ``upper`` only set the stride;
    rows outside them are read too."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
            .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions).load())


#: Bins of the key histogram that a partitioned extract is cut by.
BINS = 10_000


def histogram_query(table: str, key: str, low: int, high: int, bins: int = BINS) -> str:
    """Rows per bin of the key's range, counted by the database: at most
    ``bins`` rows, whatever the table's size (plus one for rows without a key)."""
    width = max(1, -(-(high - low + 1) // bins))
    return f"SELECT FLOOR(({key} - {low}) / {width}) AS bin, COUNT(*) AS n FROM {table} GROUP BY FLOOR(({key} - {low}) / {width})"


def stride_bounds(counts: dict[int, int], low: int, high: int, parts: int, bins: int = BINS) -> list[int]:
    """Keys at which the extract is cut so that its parts hold about as many
    rows each: quantiles of the binned key. A bin with more than a part's share
    is a part of its own."""
    width = max(1, -(-(high - low + 1) // bins))
    total, bounds, before = sum(counts.values()), [], 0
    share = total / max(1, parts)
    for b in sorted(counts):
        if counts[b] >= share and before > 0:  # a hot bin starts a part of its own
            bounds.append(low + b * width)
            before = 0
        before += counts[b]
        if before >= share:
            bounds.append(low + (b + 1) * width)
            before = 0
    return sorted({b for b in bounds if low < b <= high})


def range_predicates(key: str, bounds: list[int]) -> list[str]:
    """One predicate per part; together they hold for every row exactly once,
    rows without a key in the first."""
    if not bounds:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{key} < {bounds[0]} OR {key} IS NULL", *inner, f"{key} >= {bounds[-1]}"]


def read_jdbc_even(spark: SparkSession, url: str, table: str, key: str, num_partitions: int = 64,
                   properties: dict | None = None) -> DataFrame:
    """A relation over JDBC in parts of about equal size (S1): the database
    counts the rows per bin of the integer ``key``, and each part reads one
    range between quantiles, so a skewed key makes no large part."""
    def rows(query: str) -> DataFrame:
        r = spark.read.format("jdbc").option("url", url).option("query", query)
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        return r.load()
    low, high = rows(f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}").first()
    bounds: list[int] = []
    if low is not None:
        counts = {int(b): int(n) for b, n in rows(histogram_query(table, key, int(low), int(high))).collect() if b is not None}
        bounds = stride_bounds(counts, int(low), int(high), num_partitions)
    return spark.read.jdbc(url, table, predicates=range_predicates(key, bounds), properties=properties or {})
