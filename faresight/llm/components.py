"""Connected components of a link table, as joins and minima that never gather a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faresight.session import scratch_path


def stored(table: DataFrame, name: str) -> DataFrame:
    """``table`` written to the shared folder and read again: its lineage ends there."""
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.parquet(path)


def fresh(columns: list[str], name: str) -> str:
    """``name``, or a longer one that no column has (whatever its case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def once(rows: DataFrame, name: str) -> DataFrame:
    """One row of ``rows`` for each value of the column ``name`` (not null). Values that occur once are not grouped."""
    again = stored(rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(name), "again")
    return rows.join(again, name, "left_anti").unionByName(rows.join(again, name, "left_semi").dropDuplicates([name]))


def _name(links: DataFrame) -> tuple:
    """Number of links, and two sums over them that tell whether a step has changed any."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) for every node in ``links`` (a, b: long, not null).

    Alternating large-star and small-star steps: each node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones, until every link leads to its component's smallest node.
    A link is a row of fixed size throughout, and the number of rounds grows with the logarithm of the longest chain.
    """
    links = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links")
    before = None
    while before != (before := _name(links)):
        both = links.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        links = stored(small.filter("u <> v").distinct(), "links")
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
