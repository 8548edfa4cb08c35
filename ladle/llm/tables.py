"""Tables in the shared folder, where a lineage ends, and connected components over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.session import scratch


def landed(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a Parquet table in the shared folder: computed once, compressed, and there for whoever reads them
    after an executor was lost. The table is removed when the driver ends."""
    path = scratch(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """node, component (some node of it) of every node of ``edges`` (a, b of type long; an edge with a null end is none).

    In each round every root that has an edge to a smaller root is hooked to the smallest such, hooks are followed a few
    steps, and edges are drawn anew between roots; those within a component vanish. Rounds grow with the logarithm of a
    component's width. All steps are equi-joins and minima that combine before the shuffle. Each round's tables are landed:
    a lost executor costs no earlier round, the planner sees their true sizes (a checkpoint keeps the estimate of its plan,
    which self-joins multiply from round to round), and a node with very many edges can be split in the joins. Hooks are
    followed by one and the same table, which a plan sends or shuffles once for all steps: where tables are small, plans
    and what they hold on the driver are the cost, not rows.
    """
    edges = landed(
        edges.filter("a IS NOT NULL AND b IS NOT NULL").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = ends.withColumn("component", F.col("node"))
    links, rounds = edges.filter("a <> b"), 0
    while not links.isEmpty():
        rounds += 1
        hooks = landed(links.groupBy("a").agg(F.min("b").alias("to")), "hooks")
        further = hooks.select(F.col("a").alias("to"), F.col("to").alias("beyond"))
        for _ in range(3):
            hooks = hooks.join(further, "to", "left").select("a", F.coalesce("beyond", "to").alias("to"))
        hooks = landed(hooks, "hooks")
        labels = labels.join(hooks, labels["component"] == hooks["a"], "left")
        labels = landed(labels.select("node", F.coalesce("to", "component").alias("component")), "labels")
        moved = links.join(hooks.withColumnRenamed("to", "to_a"), "a").select(F.col("to_a").alias("a"), "b")
        other = hooks.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        moved = moved.join(other, "b", "left").select("a", F.coalesce("to_b", "b").alias("b"))
        links = landed(moved.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    return labels if rounds else landed(labels, "labels")
