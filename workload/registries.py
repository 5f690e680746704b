"""Registries whose models follow from the given tables, so they grow with them."""

from __future__ import annotations

from pyspark.sql import functions as F

import ensemblescore as es
from ensemblescore.sources.scratch import scratch_path
from ensemblescore.sources.tables import beside


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored_path(spark, tables: es.ModelTables, label: str) -> str:
    return tables.write(scratch_path(spark, label))


def stored(spark, tables: es.ModelTables, label: str) -> es.ModelTables:
    return es.ModelTables.read(spark, stored_path(spark, tables, label))


def per_user(spark, sf_dir) -> es.ModelTables:
    """One stump per user: split at half the user's largest value, leaves from the event count."""
    n = F.count("*").cast("double")
    params = read(spark, sf_dir, "events").groupBy("user_id").agg(
        (F.max("value") / 2).alias("threshold"), (n / 64).alias("below"),
        (-n / 64).alias("otherwise")).withColumnRenamed("user_id", "model_id")
    return stored(spark, es.stump_registry(params, "value"), "per-user")


def forest_per_user(spark, sf_dir) -> es.ModelTables:
    """Two trees per user: splits at a quarter and a half of the largest value, and at the smallest."""
    def entry(value=None, threshold=None, missing=None):
        feature = None if threshold is None else 0
        return F.struct(F.lit(feature).cast("int").alias("feature"),
                        F.lit(threshold).cast("float").alias("threshold"), F.lit(missing).alias("missing"),
                        F.lit(value).cast("float").alias("value"))

    n, top = F.col("n").cast("double"), F.col("top")
    first = F.array(entry(threshold=top / 4, missing="below"), entry(n / 64), entry(threshold=top / 2, missing="below"),
                    entry(0.5), entry(-n / 64))
    second = F.array(entry(threshold=F.col("low"), missing="otherwise"), entry(8.0), entry(0.25))
    trees = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("model_id")).agg(
        F.max("value").alias("top"), F.min("value").alias("low"), F.count("*").alias("n")).select(
        "model_id", F.posexplode(F.array(first, second)).alias("tree_id", "nodes"))
    return stored(spark, es.forest_registry(trees, [es.scalar("value")]), "forest-per-user")


def customer_names(spark, sf_dir) -> str:
    """A vocabulary that grows with ``customer``: the names of all keys that seven does not divide, in order."""
    names = read(spark, sf_dir, "customer").where("c_custkey % 7 != 0").agg(
        F.array_sort(F.collect_set("c_name")).alias("categories"), F.lit("names").alias("model_id"))
    n = names.select(F.size("categories")).head()[0]
    rows = es.model_rows("names", [es.category("c_name", [])], [
        es.Split(0, n // 2, es.Leaf(1), es.Leaf(2), missing="below"), es.stump(0, n // 4, 10, 20)])
    tables = es.ModelTables.from_rows(spark, rows)
    inputs = tables.inputs.drop("categories").join(names, "model_id").select(*tables.inputs.columns)
    return stored_path(spark, es.ModelTables(tables.header, inputs, tables.trees, tables.nodes), "names")


def per_part(spark, sf_dir) -> es.ModelTables:
    """One stump per part on its retail price."""
    params = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("model_id"), F.col("p_retailprice").alias("threshold"),
        F.lit(1.0).alias("below"), F.lit(2.0).alias("otherwise"))
    return es.stump_registry(params, "l_extendedprice")


def shaped_by_part(spark, sf_dir) -> es.ModelTables:
    """Per part: a vector input as wide as ``p_size``, a second input if it is dear, and one
    constant tree per ten units of size."""
    part = read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("model_id"), "p_size", "p_retailprice",
        (F.floor(F.col("p_size") / 10) + 1).cast("int").alias("n"))
    n_parts = part.count()
    base = per_part(spark, sf_dir)
    header = base.header.drop("n_outputs", "output_names").join(beside(part, n_parts), "model_id").select(
        "model_id", "aggregation", "post_transform", F.col("n").alias("n_outputs"),
        F.transform(F.sequence(F.lit(1), "n"), lambda k: F.concat(F.lit("p"), k.cast("string")))
        .alias("output_names"))
    none = F.lit(None).cast("array<string>")
    one = part.select("model_id", F.lit(0).alias("ordinal"), F.lit("v").alias("name"),
                      F.lit("FLOAT32").alias("dtype"), F.array(F.lit(-1), "p_size").alias("shape"),
                      none.alias("categories"))
    two = part.where("p_retailprice >= 1000").select(
        "model_id", F.lit(1).alias("ordinal"), F.lit("price").alias("name"),
        F.lit("FLOAT64").alias("dtype"), F.array(F.lit(-1)).alias("shape"),
        none.alias("categories"))
    trees = part.select("model_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1))
                        .alias("tree_id")).withColumn("tree_group", F.col("tree_id"))
    leaf = base.nodes.where("node_id = 1").withColumn("node_id", F.lit(0)).drop("tree_id")
    nodes = leaf.join(beside(trees, n_parts), "model_id").select(*base.nodes.columns)
    return es.ModelTables(header, one.unionByName(two), trees, nodes)


def broken_by_part(spark, sf_dir) -> es.ModelTables:
    """``per_part`` with one kind of damage for each of the sizes 1 to 11."""
    size = read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("model_id"), "p_size")
    size = beside(size, size.count())
    good = per_part(spark, sf_dir)
    p, node = F.col("p_size"), F.col("node_id")
    header = good.header.join(size, "model_id").where("p_size != 10").withColumn(
        "aggregation", F.when(p == 8, "MEAN").otherwise(F.col("aggregation"))).drop("p_size")
    trees = good.trees.join(size, "model_id").withColumn(
        "tree_group", F.when(p == 3, 5).otherwise(F.col("tree_group"))).drop("p_size")
    root = node == 0

    def ints(*values):
        return F.array(*[F.lit(v) for v in values])

    sized = good.nodes.join(size, "model_id")
    damaged = (
        sized
        .withColumn("children", F.when(root & (p == 1), ints(1, 7)).when(root & (p == 7), ints(1, 1))
                    .when((node == 1) & (p == 9), ints(2)).otherwise(F.col("children")))
        .withColumn("default_child", F.when(root & p.isin(1, 7), 1)
                    .otherwise(F.col("default_child")))
        .withColumn("split_feature", F.when(root & (p == 2), 3).otherwise(F.col("split_feature")))
        .withColumn("split_op", F.when(root & (p == 4), "GREATER").otherwise(F.col("split_op")))
        .withColumn("split_threshold", F.when(root & (p == 11), F.lit(float("nan")).cast("float"))
                    .otherwise(F.col("split_threshold")))
        .withColumn("copy", F.explode(F.when((node == 2) & (p == 5), ints(0, 1))
                                      .otherwise(ints(0))))
        .drop("copy"))
    # Size 6: nodes 3 and 4 hang on node 3 itself.
    ring = sized.where("p_size = 6 AND node_id < 2").withColumn("node_id", node + 3).withColumn(
        "children", F.when(F.col("kind") == "BRANCH", ints(3, 4)).otherwise(F.col("children"))
    ).withColumn("default_child", F.when(F.col("kind") == "BRANCH", 3).otherwise(0))
    nodes = damaged.unionByName(ring).select(*good.nodes.columns)
    return es.ModelTables(header, good.inputs, trees, nodes)
