"""Connected components by repeated contraction, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from afterplay.session import scratch_path


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, which cuts its lineage."""
    spark: SparkSession = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    table.scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete what ``written`` made, once nothing that is still to run reads it, and the shuffles behind it."""
    for table in tables:
        jvm = table.sparkSession._jvm
        # shuffles go once the driver has collected the plans that made them
        jvm.System.gc()
        path = jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after joining the labels that ``links`` (a, b) connect.

    Every label takes the least label next to it; chains are followed to their ends, and the
    links between what remains go through again. A label that many links share is only ever
    the key of an aggregate or a join, never collected.
    """
    a, b = labels.toDF("a", "la"), labels.toDF("b", "lb")
    edges = written(
        links.join(a, "a").join(b, "b").filter("la <> lb").select(
            F.least("la", "lb").alias("x"), F.greatest("la", "lb").alias("y")
        ).distinct(),
        "edges",
    )
    while not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        parent = written(ends.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("of"), F.least("x", "y").alias("to")), "parents")
        while True:
            up = parent.select(F.col("of").alias("mid"), F.col("to").alias("top"))
            jumped = written(
                parent.join(up, parent["to"] == up["mid"]).select("of", F.col("top").alias("to"), (F.col("top") != F.col("to")).alias("moved")),
                "parents",
            )
            parent = jumped.select("of", "to")
            if jumped.filter("moved").isEmpty():
                break
        labels = written(
            labels.join(parent, labels["label"] == parent["of"], "left").select("node", F.coalesce("to", "label").alias("label")),
            "labels",
        )
        x, y = parent.toDF("x", "px"), parent.toDF("y", "py")
        edges = written(
            edges.join(x, "x").join(y, "y").filter("px <> py").select(
                F.least("px", "py").alias("x"), F.greatest("px", "py").alias("y")
            ).distinct(),
            "edges",
        )
    return labels
