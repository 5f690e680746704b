"""The models the queries score, kept together in one model directory per application."""

from __future__ import annotations

import random

import ensemblescore as es
from ensemblescore.sources.schema import FLOAT64, SOFTMAX
from ensemblescore.sources.scratch import scratch_path

EVENT_TYPES = ["click", "purchase", "signup", "view"]  # 'error' is left out on purpose
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

# Value ranges of the four lineitem features the forests split on.
RANGES = {"l_quantity": (1, 50), "l_extendedprice": (900, 105_000),
          "l_discount": (0, 0.1), "l_tax": (0, 0.08)}


def forest(seed: int, n_trees: int, depth: int) -> list:
    """Seeded full trees; leaf values are multiples of 1/64, so their sums are exact."""
    rng = random.Random(seed)
    ranges = list(RANGES.values())

    def grow(level):
        if level == depth:
            return es.Leaf(rng.randint(-64, 64) / 64)
        feature = rng.randrange(len(ranges))
        low, high = ranges[feature]
        threshold = round(rng.uniform(low, high), 4)
        return es.Split(feature, threshold, grow(level + 1), grow(level + 1),
                        rng.choice(["below", "otherwise"]))

    return [grow(0) for _ in range(n_trees)]


FOREST_SMALL = forest(1, 3, 3)
FOREST = forest(2, 100, 6)
FOREST_CLASSES = forest(3, 20, 4)
CLASS_GROUPS = [k % 5 for k in range(20)]
LINEITEM_INPUTS = [es.scalar(name, FLOAT64) for name in RANGES]


def all_models() -> list[dict]:
    split, leaf, stump = es.Split, es.Leaf, es.stump
    return [
        es.model_rows("vector_stump", [es.vector("X", 2, FLOAT64)], [stump(0, 0.05, 2, -2)]),
        es.model_rows("three_classes", [es.vector("X", 2)],
                      [stump(0, 0.05, 2, -1), es.constant(0), stump(0, 0.05, -1, 2)],
                      groups=[0, 1, 2], post_transform=SOFTMAX),
        es.model_rows("two_scalars", [es.scalar("l_quantity"), es.scalar("l_discount")],
                      [split(0, 24, stump(1, 0.05, 1, -1), stump(1, 0.03, 3, 0.5))]),
        es.model_rows("discount_stump", [es.scalar("l_discount")], [stump(0, 0.05, 2, -2)]),
        es.model_rows("number_types", [es.scalar(n) for n in
                                       ("as_byte", "as_short", "as_int", "as_long", "as_float",
                                        "as_double", "as_decimal")],
                      [stump(k, t, 2.0 ** k, 0) for k, t in
                       enumerate([10, 20, 25, 30, 40, 950.5, 1000.25])]),
        es.model_rows("quantity_stump", [es.scalar("l_quantity")], [stump(0, 10, 1, -1)]),
        es.model_rows("missing_below", [es.scalar("value")],
                      [stump(0, 20, 5, 7, missing="below")]),
        es.model_rows("missing_otherwise", [es.scalar("value")], [stump(0, 20, 50, 70)]),
        es.model_rows("eight_wide", [es.vector("X", 8)],
                      [stump(0, 0.05, 1, 2), stump(5, 0.04, 10, 20)]),
        es.model_rows("embedding", [es.vector("X", 64)],
                      [split(3, 0.01, stump(17, -0.02, 1, 2), stump(40, 0.03, 3, 4)),
                       stump(63, 0.0, 0.25, 0.5)]),
        es.model_rows("two_vectors", [es.vector("u", 3), es.vector("w", 2)],
                      [stump(0, 25, 1, 2), stump(2, 0.04, 10, 20), stump(3, 0.03, 100, 200),
                       stump(4, 4, 1000, 2000)]),
        es.model_rows("mixed", [es.scalar("l_quantity"), es.vector("u", 2), es.scalar("l_tax")],
                      [stump(0, 30, 1, 2), split(1, 0.06, stump(3, 0.02, 10, 20),
                                                 stump(2, 50_000, 30, 40))]),
        es.model_rows("event_kind", [es.category("event_type", EVENT_TYPES), es.scalar("value")],
                      [split(0, 1.5, stump(0, 0.5, 1, 2), stump(0, 2.5, 3, 4), missing="below"),
                       split(0, 0.5, stump(1, 15, 10, 20), es.Leaf(30))]),
        es.model_rows("segment", [es.category("c_mktsegment", SEGMENTS), es.vector("v", 2)],
                      [split(0, 2.5, stump(1, 1000, 1, 2), stump(2, 12, 3, 4))]),
        es.model_rows("constant", [es.scalar("o_totalprice")], [es.constant(0.375)]),
        es.model_rows("forest_small", LINEITEM_INPUTS, FOREST_SMALL),
        es.model_rows("forest", LINEITEM_INPUTS, FOREST),
        es.model_rows("forest_classes", LINEITEM_INPUTS, FOREST_CLASSES, groups=CLASS_GROUPS,
                      post_transform=SOFTMAX),
        es.model_rows("ties", [es.scalar("o_totalprice")],
                      [stump(0, 250_000, 1, 0), stump(0, 100_000, 1, 0),
                       stump(0, 250_000, 0, 1), stump(0, 400_000, 0, 1)],
                      groups=[0, 1, 2, 3], output_names=["a", "b", "c", "d"]),
        es.model_rows("order_price", [es.vector("X", 1)],
                      [split(0, 150_000, leaf(1), stump(0, 300_000, 2, 3))]),
        *[es.model_rows(kind, [es.scalar("value")], [stump(0, 5 * (k + 1), k + 1, -k - 1)])
          for k, kind in enumerate(["click", "error", "purchase", "signup", "view"])],
    ]


_written: dict[str, str] = {}


def models_path(spark) -> str:
    """The directory holding ``all_models``, written when first asked for."""
    app = spark.sparkContext.applicationId
    if app not in _written:
        _written[app] = es.write_models(spark, scratch_path(spark, "models"), *all_models())
    return _written[app]


def model(spark, model_id: str) -> es.EnsembleModel:
    return es.EnsembleModel.loadFile(models_path(spark), model_id)
