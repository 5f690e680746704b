"""The four model tables. All carry ``model_id``: a directory may hold one model or a registry."""

from pyspark.sql.types import (
    ArrayType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# The enums a model may use.
SUM = "SUM"
IDENTITY = "IDENTITY"
SOFTMAX = "SOFTMAX"
BRANCH = "BRANCH"
LEAF = "LEAF"
LESS_THAN = "LESS_THAN"
SPLIT_OP_UNSPECIFIED = "SPLIT_OP_UNSPECIFIED"
FLOAT32 = "FLOAT32"
FLOAT64 = "FLOAT64"
STRING = "STRING"

AGGREGATIONS = (SUM,)
POST_TRANSFORMS = (IDENTITY, SOFTMAX)
NODE_KINDS = (BRANCH, LEAF)
SPLIT_OPS = (LESS_THAN, SPLIT_OP_UNSPECIFIED)
DTYPES = (FLOAT32, FLOAT64, STRING)


def _field(name, dtype, nullable=False):
    return StructField(name, dtype, nullable)


HEADER = StructType([
    _field("model_id", StringType()),
    _field("aggregation", StringType()),
    _field("post_transform", StringType()),
    _field("n_outputs", IntegerType()),
    _field("output_names", ArrayType(StringType())),
])

INPUTS = StructType([
    _field("model_id", StringType()),
    _field("ordinal", IntegerType()),
    _field("name", StringType()),
    _field("dtype", StringType()),
    _field("shape", ArrayType(IntegerType())),
    _field("categories", ArrayType(StringType()), True),
])

TREES = StructType([
    _field("model_id", StringType()),
    _field("tree_id", IntegerType()),
    _field("tree_group", IntegerType()),
])

# children: [taken when the split holds, taken otherwise]; default_child: node id for a missing value.
NODES = StructType([
    _field("model_id", StringType()),
    _field("tree_id", IntegerType()),
    _field("node_id", IntegerType()),
    _field("kind", StringType()),
    _field("split_feature", IntegerType()),
    _field("split_op", StringType()),
    _field("split_threshold", FloatType()),
    _field("children", ArrayType(IntegerType())),
    _field("default_child", IntegerType()),
    _field("leaf_value", FloatType()),
])

TABLES = {"header": HEADER, "inputs": INPUTS, "trees": TREES, "nodes": NODES}
