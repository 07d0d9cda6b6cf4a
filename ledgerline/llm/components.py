"""Connected components of a graph of links, by contraction.

Every round each node hooks to its neighbour of smallest hash (itself included), links are
rewritten to the nodes hooked to, and links within one node go. Hashes differ from round to
round, so long chains shrink by a constant share each time. Every round is written below the
shared folder; no group of neighbours is ever collected.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import shared_dir


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: for every node of a link the smallest node it is connected with."""
    spark, folder = links.sparkSession, shared_dir(links.sparkSession, "components")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = kept(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges-0")
    place, round_ = None, 0
    while not edges.isEmpty():
        rank = lambda c: F.xxhash64(F.lit(round_), F.col(c))  # noqa: B023, E731
        best = F.min(F.struct(rank("b").alias("h"), F.col("b").alias("to")))
        own = F.struct(rank("a").alias("h"), F.col("a").alias("to"))
        hooks = kept(edges.groupBy("a").agg(best.alias("best")).select(F.col("a").alias("node"), F.least(own, F.col("best"))["to"].alias("to")), f"hooks-{round_}")
        moved = hooks if place is None else place.join(hooks.withColumnRenamed("node", "n").withColumnRenamed("to", "t"), F.col("to") == F.col("n"), "left").select("node", F.coalesce("t", "to").alias("to"))
        place = kept(moved, f"place-{round_}")
        first = edges.join(hooks.withColumnRenamed("to", "a2"), F.col("a") == F.col("node")).select("a2", "b")
        second = first.join(hooks.withColumnRenamed("to", "b2"), F.col("b") == F.col("node")).select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        round_ += 1
        edges = kept(second.filter("a <> b").distinct(), f"edges-{round_}")
    if place is None:
        return links.select(F.col(a).alias("node"), F.col(a).alias("component")).limit(0)
    names = kept(place.groupBy("to").agg(F.min("node").alias("component")), "names").withColumnRenamed("to", "root")
    return place.join(names, F.col("to") == F.col("root")).select("node", "component")
