"""One query per operator, over whole tables of the given directory."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import ensemblescore as es
from ensemblescore.operators.registry import MAX_BROADCAST_NODES
from ensemblescore.sources.scratch import scratch_path
from workload import registries
from workload.models import model, models_path
from workload.registries import read

LINE = ["l_orderkey", "l_linenumber"]


def assemble(df: DataFrame, columns: list[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=output).transform(df)


def vector_of(*columns) -> F.Column:
    """A dense vector, built without blocking the filters written after it."""
    return array_to_vector(F.array(*[F.col(c).cast("double") for c in columns]))


def score_vector_stump(spark, sf):
    df = assemble(read(spark, sf, "lineitem"), ["l_discount", "l_tax"])
    return model(spark, "vector_stump").transform(df).select(*LINE, "l_discount", "prediction")


def score_scalar_inputs(spark, sf):
    return model(spark, "two_scalars").transform(read(spark, sf, "lineitem")).select(
        *LINE, "l_quantity", "prediction")


def float_boundary(spark, sf):
    df = read(spark, sf, "lineitem").where("l_discount = 0.05D")
    return model(spark, "discount_stump").transform(df).groupBy("prediction").agg(
        F.count("*").alias("n"))


def feature_ignored(spark, sf):
    stage = model(spark, "vector_stump").setFeaturesCol("v")
    df = read(spark, sf, "lineitem").withColumn("v", vector_of("l_discount", "l_tax"))
    first = stage.transform(df).withColumnRenamed("prediction", "p_tax").drop("v")
    second = stage.setPredictionCol("p_price").transform(
        first.withColumn("v", vector_of("l_discount", "l_extendedprice")))
    return second.select(*LINE, "p_tax", "p_price")


def numeric_coercion(spark, sf):
    df = read(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("byte").alias("as_byte"),
        F.col("p_size").cast("short").alias("as_short"), F.col("p_size").alias("as_int"),
        F.col("p_size").cast("long").alias("as_long"),
        F.col("p_size").cast("float").alias("as_float"),
        F.col("p_retailprice").alias("as_double"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("as_decimal"))
    return model(spark, "number_types").transform(df).select("p_partkey", "prediction")


def null_as_zero(spark, sf):
    df = read(spark, sf, "lineitem").withColumn(
        "l_quantity", F.when(F.col("l_returnflag") != "N", F.col("l_quantity")))
    return model(spark, "quantity_stump").transform(df).select(
        *LINE, "l_returnflag", "prediction")


def _with_nan(spark, sf):
    nan = F.lit(float("nan"))
    return read(spark, sf, "events").withColumn(
        "value", F.when(F.col("event_type") == "error", nan).otherwise(F.col("value")))


def nan_default_child(spark, sf):
    below = model(spark, "missing_below").setPredictionCol("to_below")
    otherwise = model(spark, "missing_otherwise").setPredictionCol("to_otherwise")
    return otherwise.transform(below.transform(_with_nan(spark, sf))).select(
        "event_id", "to_below", "to_otherwise")


def nan_default_child_arrow(spark, sf):
    below = model(spark, "missing_below").setStrategy("arrow")
    return below.transform(_with_nan(spark, sf)).select("event_id", "prediction")


def sparse_equals_dense(spark, sf):
    names = ["l_discount", *["zero"] * 4, "l_tax", *["zero"] * 2]
    df = read(spark, sf, "lineitem").withColumn("zero", F.lit(0.0))
    df = assemble(df, names, "sparse").withColumn("dense", vector_of(*names))
    stage = model(spark, "eight_wide").setFeaturesCol("dense").setPredictionCol("from_dense")
    both = model(spark, "eight_wide").setFeaturesCol("sparse").setPredictionCol(
        "from_sparse").transform(stage.transform(df))
    return both.groupBy("from_sparse").agg(
        F.count("*").alias("n"),
        F.sum((F.col("from_dense") != F.col("from_sparse")).cast("long")).alias("differences"))


def array_features(spark, sf):
    return model(spark, "embedding").setFeaturesCol("embedding").transform(
        read(spark, sf, "embeddings")).select("vec_id", "label", "prediction")


def multi_vector_inputs(spark, sf):
    df = read(spark, sf, "lineitem").withColumns({
        "u": vector_of("l_quantity", "l_extendedprice", "l_discount"),
        "w": vector_of("l_tax", "l_linenumber")})
    return model(spark, "two_vectors").transform(df).select(*LINE, "prediction")


def mixed_inputs(spark, sf):
    df = read(spark, sf, "lineitem").withColumn("u", vector_of("l_discount", "l_extendedprice"))
    return model(spark, "mixed").transform(df).select(*LINE, "prediction")


def string_input(spark, sf):
    return model(spark, "event_kind").transform(read(spark, sf, "events")).select(
        "event_id", "event_type", "prediction")


def string_and_vector(spark, sf):
    df = read(spark, sf, "customer").withColumn("v", vector_of("c_acctbal", "c_nationkey"))
    return model(spark, "segment").transform(df).select("c_custkey", "prediction")


def string_large_vocabulary(spark, sf):
    stage = es.EnsembleModel.loadFile(registries.customer_names(spark, sf))
    return stage.transform(read(spark, sf, "customer")).select("c_custkey", "prediction")


def string_skewed_vocabulary(spark, sf):
    """Names looked up by a join, where one name is a third of all rows and null is another."""
    stage = es.EnsembleModel(modelPath=registries.customer_names(spark, sf)).setMaxBroadcastChars(0)
    df = read(spark, sf, "orders").join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    df = df.withColumn("c_name", F.when(F.col("o_orderkey") % 3 == 0, "Customer#000000001").when(
        F.col("o_orderkey") % 3 == 1, F.col("c_name")))
    return stage.transform(df).select("o_orderkey", "c_name", "prediction")


def string_input_joined(spark, sf):
    """Scored by joins, as a model too large for any executor could be."""
    return model(spark, "event_kind").setStrategy("join").transform(read(spark, sf, "events")).select(
        "event_id", "event_type", "prediction")


def string_and_vector_joined(spark, sf):
    df = read(spark, sf, "customer").withColumn("v", vector_of("c_acctbal", "c_nationkey"))
    stage = model(spark, "segment").setMaxBroadcastNodes(1).setStrategy("join")
    return stage.transform(df).select("c_custkey", "prediction")


def forest_sum_chunked(spark, sf):
    """The forest in chunks of a few trees each."""
    return model(spark, "forest").setMaxBroadcastNodes(1000).transform(
        read(spark, sf, "lineitem")).select(*LINE, "prediction")


def forest_sum_tree_parallel(spark, sf):
    """Distinct rows go to the trees, and partial sums of trees are added exactly."""
    df = read(spark, sf, "lineitem").withColumns({
        "l_extendedprice": F.floor(F.col("l_extendedprice") / 1000) * 1000.0, "l_tax": F.lit(0.04)})
    return model(spark, "forest").setStrategy("trees").transform(df).select(*LINE, "prediction")


def duplicate_names(spark, sf):
    """Two columns of one name pass through scoring by position."""
    orders = read(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("id"), vector_of("o_totalprice").alias("features"))
    customers = read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    scored = model(spark, "order_price").transform(orders.join(customers, orders["id"] == customers["id"]))
    return scored.toDF("o_orderkey", "o_custkey", "features", "c_custkey", "c_name", "prediction").drop("features")


def const_tree(spark, sf):
    return model(spark, "constant").transform(read(spark, sf, "orders")).select(
        "o_orderkey", "prediction")


def forest_sum(spark, sf):
    return model(spark, "forest").transform(read(spark, sf, "lineitem")).select(
        *LINE, "prediction")


def forest_expr(spark, sf):
    return model(spark, "forest_small").setStrategy("expr").transform(
        read(spark, sf, "lineitem")).select(*LINE, "prediction")


def softmax_proba(spark, sf):
    df = read(spark, sf, "lineitem").withColumn("features", vector_of("l_discount", "l_tax"))
    p = vector_to_array("probability")
    return model(spark, "three_classes").transform(df).select(
        *LINE, *[F.round(p[k], 4).alias(f"p{k}") for k in range(3)], "prediction")


def softmax_forest(spark, sf):
    p = vector_to_array("probability")
    return model(spark, "forest_classes").transform(read(spark, sf, "lineitem")).select(
        *LINE, *[F.round(p[k], 4).alias(f"p{k}") for k in range(5)])


def argmax_class(spark, sf):
    return model(spark, "forest_classes").transform(read(spark, sf, "lineitem")).select(
        *LINE, "prediction")


def argmax_tie(spark, sf):
    return model(spark, "ties").transform(read(spark, sf, "orders")).select(
        "o_orderkey", "prediction")


def output_width(spark, sf):
    tables = registries.stored(spark, registries.shaped_by_part(spark, sf), "shaped")
    return es.model_widths(tables)


def rename_outputs(spark, sf):
    stage = (model(spark, "event_kind").setPredictionCol("score")
             .setProbabilityCol("not_used_by_one_output"))
    return stage.transform(read(spark, sf, "events")).drop("ts", "props", "user_id")


def rename_probability(spark, sf):
    df = read(spark, sf, "lineitem").withColumn("f", vector_of("l_discount", "l_tax"))
    stage = model(spark, "three_classes").setParams(
        featuresCol="f", predictionCol="class", probabilityCol="chances")
    return stage.transform(df).select(
        *LINE, F.round(vector_to_array("chances")[1], 4).alias("middle"), "class")


def filter_after_score(spark, sf):
    scored = model(spark, "two_scalars").transform(read(spark, sf, "lineitem"))
    return scored.where("l_shipdate < timestamp '1998-06-01' AND prediction > 0").select(
        *LINE, "prediction")


def aggregate_scores(spark, sf):
    """Scores joined and aggregated like any other column."""
    scored = model(spark, "forest").transform(read(spark, sf, "lineitem"))
    return scored.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum("prediction").alias("total"),
        F.max("prediction").alias("best"))


def pipeline(spark, sf) -> Pipeline:
    return Pipeline(stages=[
        SQLTransformer(statement="SELECT *, o_totalprice * 1.0 AS price FROM __THIS__"),
        VectorAssembler(inputCols=["price"], outputCol="features"),
        model(spark, "order_price")])


def pipeline_stage(spark, sf):
    df = read(spark, sf, "orders")
    return pipeline(spark, sf).fit(df).transform(df).select("o_orderkey", "prediction")


def saved_pipeline(spark, sf):
    df, path = read(spark, sf, "orders"), scratch_path(spark, "pipeline")
    pipeline(spark, sf).fit(df).write().overwrite().save(path)
    return PipelineModel.load(path).transform(df).select("o_orderkey", "prediction")


def empty_input(spark, sf):
    df = read(spark, sf, "events").where("value < 0")
    return model(spark, "event_kind").transform(df).agg(
        F.count("*").alias("n"), F.count("prediction").alias("n_scored"))


def partition_invariance(spark, sf):
    stage, df = model(spark, "order_price"), read(spark, sf, "orders").withColumn(
        "features", vector_of("o_totalprice"))
    report = es.parity_report(
        stage.transform(df), stage.transform(df.repartition("o_orderkey")), ["o_orderkey"],
        tolerance=0.0)
    return report.select("rows_left", "rows_right", "keys_met", "max_abs_diff", "over_tolerance")


def copy_params(spark, sf):
    stage = model(spark, "constant").setPredictionCol("score")
    copied = stage.copy({stage.modelId: "order_price", stage.featuresCol: "price"})
    df = read(spark, sf, "orders").withColumn("price", vector_of("o_totalprice"))
    return copied.transform(df).select("o_orderkey", "score")


def deferred_load(spark, sf):
    stage = es.EnsembleModel(modelPath="/no/such/model").setModelId("discount_stump")
    stage.setModelPath(models_path(spark))
    return stage.transform(read(spark, sf, "lineitem")).select(*LINE, "prediction")


def model_violations(spark, sf):
    tables = registries.stored(spark, registries.broken_by_part(spark, sf), "broken")
    none = F.lit(-1)
    return es.violations(tables).select(
        "model_id", "rule", F.coalesce("tree_id", none).alias("tree_id"),
        F.coalesce("node_id", none).alias("node_id"))


def parity_report(spark, sf):
    df = read(spark, sf, "orders").withColumn("features", vector_of("o_totalprice"))
    stage = model(spark, "order_price")
    return es.parity_report(
        stage.copy({stage.strategy: "expr"}).transform(df),
        stage.copy({stage.strategy: "arrow"}).transform(df), ["o_orderkey"], tolerance=0.0)


def parity_report_differs(spark, sf):
    """Two models that do differ, on keys of which one side lacks some."""
    df = read(spark, sf, "events")
    left = model(spark, "missing_below").transform(df)
    right = model(spark, "missing_otherwise").transform(df.where("event_type != 'view'"))
    return es.parity_report(left, right, ["event_id"], tolerance=50.0)


def parity_repeated_keys(spark, sf):
    """An order holds many lines; one value in the middle of each order differs."""
    df = read(spark, sf, "lineitem")
    left = df.select("l_orderkey", F.col("l_quantity").cast("double").alias("prediction"))
    right = df.select("l_orderkey", (F.col("l_quantity") + F.when(
        F.col("l_linenumber") == 2, 0.25).otherwise(0.0)).cast("double").alias("prediction"))
    return es.parity_report(left, right, ["l_orderkey"], tolerance=0.0, count_outputs=True).select(
        "rows_left", "rows_right", "keys_met", "differing_outputs", "over_tolerance")


def parity_noise(spark, sf):
    """Noise on every row of keys that repeat, and one value in the middle that differs."""
    df = read(spark, sf, "lineitem")
    noise = F.col("l_linenumber") / float(1 << 20) + F.when(F.col("l_linenumber") == 2, 0.25).otherwise(0.0)
    left = df.select("l_orderkey", F.col("l_quantity").cast("double").alias("prediction"))
    right = df.select("l_orderkey", (F.col("l_quantity") + noise).cast("double").alias("prediction"))
    return es.parity_report(left, right, ["l_orderkey"]).select(
        "rows_left", "rows_right", "keys_met", "uneven_keys", "max_abs_diff", "over_tolerance")


def parity_uneven_keys(spark, sf):
    """Noise on every row, and each third line is on one side only."""
    df = read(spark, sf, "lineitem")
    left = df.select("l_orderkey", F.col("l_quantity").cast("double").alias("prediction"))
    right = df.where("l_linenumber % 3 != 0").select("l_orderkey", (
        F.col("l_quantity") + F.col("l_linenumber") / float(1 << 20)).cast("double").alias("prediction"))
    return es.parity_report(left, right, ["l_orderkey"], align_uneven=True).select(
        "rows_left", "rows_right", "keys_met", "uneven_keys", "unmatched_outputs", "max_aligned_diff")


def registry_score(spark, sf):
    tables = es.ModelTables.read(spark, models_path(spark)).map(
        lambda df: df.where(F.col("model_id").isin("click", "error", "purchase", "signup")))
    return es.score_registry(read(spark, sf, "events"), tables, "event_type").select(
        "event_id", "event_type", "prediction")


def _mixed_widths(strategy):
    def query(spark, sf):
        """Every part has a model of its own, with a vector as wide as the part is large."""
        tables = registries.stored(spark, registries.shaped_by_part(spark, sf), "shaped")
        df = read(spark, sf, "part").select(
            F.col("p_partkey").cast("string").alias("part"), F.col("p_retailprice").alias("price"),
            F.array_repeat(F.col("p_retailprice") / 1000, F.col("p_size")).alias("v"))
        n_deals = 1 + tables.nodes.count() // (MAX_BROADCAST_NODES * 4 // 5) if strategy == "arrow" else 1
        scored = None
        for k in range(n_deals):
            some, own = df, tables
            if n_deals > 1:  # no deal is more than is broadcast at once
                some = df.where(_deal("part", n_deals).eqNullSafe(k))
                own = tables.map(lambda t: t.where(_deal("model_id", n_deals) == k))
            part = es.score_registry(some, own, "part", features_col="v", strategy=strategy)
            scored = part if scored is None else scored.unionByName(part, allowMissingColumns=True)
        return scored.select("part", "prediction", F.when(F.col("probability").isNull(), -1).otherwise(
            F.size(vector_to_array(F.coalesce("probability", vector_of())))).alias("n_classes"))

    def _deal(name, n):
        return F.coalesce(F.pmod(F.xxhash64(name), F.lit(n)), F.lit(0))
    return query


def _hot_model(strategy):
    def query(spark, sf):
        """Most rows name one model, and many rows are equal."""
        tables = es.ModelTables.read(spark, models_path(spark)).map(
            lambda df: df.where(F.col("model_id").isin("click", "error", "purchase", "signup")))
        df = read(spark, sf, "events").select(
            "event_id", F.when(F.col("event_type") == "signup", "signup").otherwise("click").alias("kind"),
            (F.floor(F.col("value") / 10) * 10.0).alias("value"))
        return es.score_registry(df, tables, "kind", strategy=strategy, rows_per_group=1000)
    return query


def _per_user(strategy):
    def query(spark, sf):
        scored = es.score_registry(
            read(spark, sf, "events"), registries.per_user(spark, sf), "user_id",
            strategy=strategy)
        return scored.select("event_id", "user_id", "prediction")
    return query


def registry_duplicate_names(spark, sf):
    """Columns that no model reads share names, one of them with a helper of an earlier plan."""
    df = read(spark, sf, "events").select(
        "event_id", "user_id", "value", F.lit(-7).alias("__row"), F.lit("a").alias("x"),
        F.col("event_type").alias("x"), F.lit(1).alias("__model"), F.lit(2).alias("__s"))
    scored = es.score_registry(df, registries.per_user(spark, sf), "user_id", strategy="group", rows_per_group=500)
    return scored.toDF("event_id", "user_id", "value", "row", "x1", "x2", "model", "s", "prediction")


def registry_large_model(spark, sf):
    """A model that no task may hold whole, beside a small one and names that have none."""
    tables = es.ModelTables.read(spark, models_path(spark)).map(
        lambda df: df.where(F.col("model_id").isin("forest", "forest_small")))
    df = read(spark, sf, "lineitem").withColumn("m", F.when(F.col("l_returnflag") == "R", "forest_small").when(
        F.col("l_returnflag") == "N", "forest").otherwise("none"))
    return es.score_registry(df, tables, "m", strategy="group", max_nodes=1000, rows_per_group=20_000).select(
        *LINE, "m", "prediction")


def forest_registry_built(spark, sf):
    """Two trees per user, in preorder arrays that Spark derives from the user's events."""
    events = read(spark, sf, "events")
    scored = es.score_registry(events, registries.forest_per_user(spark, sf), "user_id")
    return scored.select("event_id", "user_id", "prediction")


def registry_two_versions(spark, sf):
    """The registry is published, and published anew while the first version is open."""
    root = scratch_path(spark, "published")
    es.publish_models(registries.per_user(spark, sf), root)
    first = es.published_models(spark, root)
    es.publish_models(registries.forest_per_user(spark, sf), root)
    events = read(spark, sf, "events").select("event_id", "user_id", "value")
    scored = es.score_registry(events, first, "user_id", prediction_col="before")
    scored = es.score_registry(scored, es.published_models(spark, root), "user_id", prediction_col="after")
    again = es.score_registry(scored, es.published_models(spark, root, 1), "user_id", prediction_col="again")
    return again.select("event_id", "user_id", "before", "after", (F.col("again") == F.col("before")).alias("same"))


def stream_registry_score(spark, sf):
    """Half of the events arrive before a second version is published, and half after."""
    root, arrived, out, log = (scratch_path(spark, n) for n in ("published", "arrived", "scored", "log"))
    events = read(spark, sf, "events").select("event_id", "user_id", "value")
    for tables, part in ((registries.per_user(spark, sf), 0), (registries.forest_per_user(spark, sf), 1)):
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(arrived)
        es.publish_models(tables, root)
        stream = spark.readStream.schema(events.schema).parquet(arrived)
        es.score_registry_stream(stream, root, out, log, model_id_col="user_id", available_now=True,
                                 columns=["event_id", "user_id", "prediction"]).awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "prediction")


def leaf_table_score(spark, sf):
    return model(spark, "forest_small").setStrategy("join").transform(
        read(spark, sf, "lineitem")).select(*LINE, "prediction")


def leaf_box_score(spark, sf):
    """Leaf boxes met on grid cells, with missing values on one line in seven."""
    df = read(spark, sf, "lineitem").withColumn(
        "l_discount", F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_discount")))
    return model(spark, "forest_small").setStrategy("boxes").transform(df).select(*LINE, "prediction")


def stream_score(spark, sf):
    table = read(spark, sf, "events")
    # A table may be one file or a folder of part files; a stream reads folders.
    files = table.inputFiles()
    if len(files) == 1 and files[0].endswith("/events.parquet"):
        stream = spark.readStream.schema(table.schema).option(
            "pathGlobFilter", "events.parquet").parquet(sf)
    else:
        stream = spark.readStream.schema(table.schema).parquet(f"{sf}/events.parquet")
    out = scratch_path(spark, "stream")
    es.score_stream(model(spark, "event_kind"), stream, out, scratch_path(spark, "stream-log"),
                    columns=["event_id", "event_type", "prediction"],
                    available_now=True).awaitTermination()
    return spark.read.parquet(out)


QUERIES = {
    f.__name__: f for f in (
        score_vector_stump, score_scalar_inputs, float_boundary, feature_ignored,
        numeric_coercion, null_as_zero, nan_default_child, nan_default_child_arrow,
        sparse_equals_dense, array_features, multi_vector_inputs, mixed_inputs, string_input,
        string_and_vector, string_large_vocabulary, string_skewed_vocabulary, string_input_joined, string_and_vector_joined,
        forest_sum_chunked, forest_sum_tree_parallel, duplicate_names, parity_repeated_keys, const_tree, forest_sum, forest_expr,
        softmax_proba, softmax_forest, argmax_class, argmax_tie, output_width, rename_outputs,
        rename_probability, filter_after_score, aggregate_scores, pipeline_stage,
        saved_pipeline, empty_input, partition_invariance, copy_params, deferred_load,
        model_violations, parity_report, parity_report_differs, parity_noise, parity_uneven_keys, registry_score,
        leaf_table_score, leaf_box_score, stream_score, registry_duplicate_names, registry_large_model,
        forest_registry_built, registry_two_versions, stream_registry_score)
} | {
    "registry_per_user": _per_user("auto"),
    "registry_per_user_grouped": _per_user("group"),
    "registry_per_user_joined": _per_user("join"),
    **{f"registry_mixed_widths_{s}": _mixed_widths(s) for s in ("arrow", "group", "join")},
    **{f"registry_hot_model_{s}": _hot_model(s) for s in ("arrow", "group", "join")},
}
