"""The same answers in plain SQL.

Stumps are written by hand. Forests are rendered from the nested splits, not from
the model tables or the library's own SQL, so a shared mistake cannot hide.
"""

from __future__ import annotations

from ensemblescore.sources.build import Leaf
from workload.models import CLASS_GROUPS, FOREST, FOREST_CLASSES, FOREST_SMALL, RANGES


def f32(x) -> str:
    return f"CAST({x} AS FLOAT)"


def case(x: str, threshold, below, otherwise) -> str:
    return (f"CASE WHEN {f32(x)} < {f32(threshold)} THEN CAST({below} AS DOUBLE) "
            f"ELSE CAST({otherwise} AS DOUBLE) END")


def tree(node) -> str:
    if isinstance(node, Leaf):
        return f"CAST({node.value} AS DOUBLE)"
    x = list(RANGES)[node.feature]
    return (f"CASE WHEN {f32(x)} < {f32(node.threshold)} THEN {tree(node.below)} "
            f"ELSE {tree(node.otherwise)} END")


def total(trees, render=tree) -> str:
    return " + ".join(f"({render(t)})" for t in trees)


def tree_with_missing(node) -> str:
    if isinstance(node, Leaf):
        return f"CAST({node.value} AS DOUBLE)"
    x = list(RANGES)[node.feature]
    below, otherwise = tree_with_missing(node.below), tree_with_missing(node.otherwise)
    return (f"CASE WHEN isnan({x}) THEN {below if node.missing == 'below' else otherwise} "
            f"WHEN {f32(x)} < {f32(node.threshold)} THEN {below} ELSE {otherwise} END")


KEYS = "l_orderkey, l_linenumber"
STUMP = case("l_discount", 0.05, 2, -2)
TWO_SCALARS = (f"CASE WHEN {f32('l_quantity')} < {f32(24)} THEN {case('l_discount', 0.05, 1, -1)} "
               f"ELSE {case('l_discount', 0.03, 3, 0.5)} END")
ORDER_PRICE = (f"CASE WHEN {f32('o_totalprice')} < {f32(150000)} THEN CAST(1 AS DOUBLE) "
               f"ELSE {case('o_totalprice', 300000, 2, 3)} END")
# click 0, purchase 1, signup 2, view 3; error is unknown and takes each split's missing side.
EVENT_KIND = f"""
    (CASE event_type WHEN 'click' THEN 1.0 WHEN 'purchase' THEN 2.0 WHEN 'signup' THEN 3.0
                     WHEN 'view' THEN 4.0 ELSE 2.0 END)::DOUBLE
  + (CASE event_type WHEN 'click' THEN {case('value', 15, 10, 20)} ELSE 30.0::DOUBLE END)"""
PER_USER = f"""
    WITH m AS (SELECT user_id, {f32('max(value) / 2')} AS t,
                      {f32('CAST(count(*) AS DOUBLE) / 64')} AS below,
                      {f32('-CAST(count(*) AS DOUBLE) / 64')} AS otherwise
               FROM events GROUP BY user_id)
    SELECT event_id, e.user_id,
           CAST(CASE WHEN {f32('value')} < t THEN below ELSE otherwise END AS DOUBLE) AS prediction
    FROM events e JOIN m USING (user_id)"""

FOREST_PER_USER = f"""
    WITH m AS (SELECT user_id, {f32('max(value) / 4')} AS a, {f32('max(value) / 2')} AS b, {f32('min(value)')} AS c,
                      {f32('CAST(count(*) AS DOUBLE) / 64')} AS n
               FROM events GROUP BY user_id)
    SELECT event_id, e.user_id,
           CAST(CASE WHEN {f32('value')} < a THEN n WHEN {f32('value')} < b THEN 0.5 ELSE -n END AS DOUBLE)
         + CASE WHEN {f32('value')} < c THEN CAST(8 AS DOUBLE) ELSE CAST(0.25 AS DOUBLE) END AS prediction
    FROM events e JOIN m USING (user_id)"""

# The vocabulary of registries.customer_names: codes by order, unknown and null names missing.
NAMES = """v AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS code
                 FROM (SELECT DISTINCT c_name FROM customer WHERE c_custkey % 7 <> 0)),
            n AS (SELECT count(*) AS n FROM v)"""
NAME_SCORE = ("CAST(CASE WHEN code IS NULL OR code < n // 2 THEN 1 ELSE 2 END AS DOUBLE)"
              " + CASE WHEN code < n // 4 THEN 10 ELSE 20 END")

_EXP = "exp(CAST({} AS DOUBLE))"
_LOW = f"{_EXP.format(2)} + {_EXP.format(0)} + {_EXP.format(-1)}"


def _three(k_below, k_otherwise) -> str:
    return (f"round(CASE WHEN {f32('l_discount')} < {f32(0.05)} THEN {_EXP.format(k_below)} "
            f"ELSE {_EXP.format(k_otherwise)} END / ({_LOW}), 4)")


CLASS_SUMS = ", ".join(
    f"{total([t for t, g in zip(FOREST_CLASSES, CLASS_GROUPS) if g == k])} AS s{k}"
    for k in range(5))
CLASS_SCORES = f"(SELECT {KEYS}, {CLASS_SUMS} FROM lineitem)"
CLASS_TOP = "greatest(s0, s1, s2, s3, s4)"
CLASS_ALL = "(" + " + ".join(f"exp(s{k})" for k in range(5)) + ")"

SQL = {
    "score_vector_stump": f"SELECT {KEYS}, l_discount, {STUMP} AS prediction FROM lineitem",
    "score_scalar_inputs": f"SELECT {KEYS}, l_quantity, {TWO_SCALARS} AS prediction FROM lineitem",
    "float_boundary": f"""
        SELECT {STUMP} AS prediction, count(*) AS n FROM lineitem
        WHERE l_discount = CAST(0.05 AS DOUBLE) GROUP BY 1""",
    "feature_ignored": f"SELECT {KEYS}, {STUMP} AS p_tax, {STUMP} AS p_price FROM lineitem",
    "numeric_coercion": f"""
        SELECT p_partkey, {case('p_size', 10, 1, 0)} + {case('p_size', 20, 2, 0)}
             + {case('p_size', 25, 4, 0)} + {case('p_size', 30, 8, 0)}
             + {case('p_size', 40, 16, 0)} + {case('p_retailprice', 950.5, 32, 0)}
             + {case('CAST(p_retailprice AS DECIMAL(12,2))', 1000.25, 64, 0)} AS prediction
        FROM part""",
    "null_as_zero": f"""
        SELECT {KEYS}, l_returnflag,
               {case("CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_quantity END", 10, 1, -1)}
               AS prediction FROM lineitem""",
    "nan_default_child": f"""
        SELECT event_id,
               CASE WHEN event_type = 'error' THEN CAST(5 AS DOUBLE)
                    ELSE {case('value', 20, 5, 7)} END AS to_below,
               CASE WHEN event_type = 'error' THEN CAST(70 AS DOUBLE)
                    ELSE {case('value', 20, 50, 70)} END AS to_otherwise FROM events""",
    "nan_default_child_arrow": f"""
        SELECT event_id, CASE WHEN event_type = 'error' THEN CAST(5 AS DOUBLE)
                              ELSE {case('value', 20, 5, 7)} END AS prediction FROM events""",
    "sparse_equals_dense": f"""
        SELECT {case('l_discount', 0.05, 1, 2)} + {case('l_tax', 0.04, 10, 20)} AS from_sparse,
               count(*) AS n, CAST(0 AS BIGINT) AS differences FROM lineitem GROUP BY 1""",
    "array_features": f"""
        SELECT vec_id, label,
               CASE WHEN embedding[4] < {f32(0.01)} THEN {case('embedding[18]', -0.02, 1, 2)}
                    ELSE {case('embedding[41]', 0.03, 3, 4)} END
             + {case('embedding[64]', 0.0, 0.25, 0.5)} AS prediction FROM embeddings""",
    "multi_vector_inputs": f"""
        SELECT {KEYS}, {case('l_quantity', 25, 1, 2)} + {case('l_discount', 0.04, 10, 20)}
             + {case('l_tax', 0.03, 100, 200)} + {case('l_linenumber', 4, 1000, 2000)}
             AS prediction FROM lineitem""",
    "mixed_inputs": f"""
        SELECT {KEYS}, {case('l_quantity', 30, 1, 2)}
             + CASE WHEN {f32('l_discount')} < {f32(0.06)} THEN {case('l_tax', 0.02, 10, 20)}
                    ELSE {case('l_extendedprice', 50000, 30, 40)} END AS prediction
        FROM lineitem""",
    "string_input": f"SELECT event_id, event_type, {EVENT_KIND} AS prediction FROM events",
    "string_and_vector": f"""
        SELECT c_custkey,
               CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
                    THEN {case('c_acctbal', 1000, 1, 2)}
                    ELSE {case('c_nationkey', 12, 3, 4)} END AS prediction FROM customer""",
    "string_large_vocabulary": f"""
        WITH {NAMES} SELECT c_custkey, {NAME_SCORE} AS prediction FROM customer LEFT JOIN v USING (c_name), n""",
    "string_skewed_vocabulary": f"""
        WITH {NAMES}, o AS (
            SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'Customer#000000001' WHEN 1 THEN c_name END AS c_name
            FROM orders JOIN customer ON o_custkey = c_custkey)
        SELECT o_orderkey, c_name, {NAME_SCORE} AS prediction FROM o LEFT JOIN v USING (c_name), n""",
    "forest_sum_tree_parallel": f"""
        SELECT {KEYS}, {total(FOREST)} AS prediction FROM (
            SELECT l_orderkey, l_linenumber, l_quantity, floor(l_extendedprice / 1000) * 1000.0::DOUBLE AS l_extendedprice,
                   l_discount, 0.04::DOUBLE AS l_tax FROM lineitem)""",
    "forest_sum_chunked": f"SELECT {KEYS}, {total(FOREST)} AS prediction FROM lineitem",
    "duplicate_names": f"""
        SELECT o_orderkey, o_custkey, c_custkey, c_name, {ORDER_PRICE} AS prediction
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "parity_repeated_keys": """
        WITH a AS (SELECT l_orderkey AS k, l_quantity::DOUBLE AS v, count(*) AS n FROM lineitem GROUP BY 1, 2),
        b AS (SELECT l_orderkey AS k, (l_quantity + CASE WHEN l_linenumber = 2 THEN 0.25 ELSE 0 END)::DOUBLE AS v,
                     count(*) AS n FROM lineitem GROUP BY 1, 2),
        d AS (SELECT coalesce(a.k, b.k) AS k FROM a FULL JOIN b ON a.k = b.k AND a.v = b.v
              WHERE a.n IS DISTINCT FROM b.n)
        SELECT (SELECT count(*) FROM lineitem) AS rows_left, (SELECT count(*) FROM lineitem) AS rows_right,
               (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS keys_met,
               count(*) AS differing_outputs, count(DISTINCT k) AS over_tolerance FROM d""",
    "const_tree": "SELECT o_orderkey, CAST(0.375 AS DOUBLE) AS prediction FROM orders",
    "forest_sum": f"SELECT {KEYS}, {total(FOREST)} AS prediction FROM lineitem",
    "forest_expr": f"SELECT {KEYS}, {total(FOREST_SMALL)} AS prediction FROM lineitem",
    "softmax_proba": f"""
        SELECT {KEYS}, {_three(2, -1)} AS p0, {_three(0, 0)} AS p1, {_three(-1, 2)} AS p2,
               {case('l_discount', 0.05, 0, 2)} AS prediction FROM lineitem""",
    "softmax_forest": f"""
        SELECT {KEYS}, {', '.join(f"round(CAST({f32(f'exp(s{k}) / {CLASS_ALL}')} AS DOUBLE), 4) AS p{k}" for k in range(5))}
        FROM {CLASS_SCORES}""",
    "argmax_class": f"""
        SELECT {KEYS}, CAST(CASE {CLASS_TOP} WHEN s0 THEN 0 WHEN s1 THEN 1 WHEN s2 THEN 2
                            WHEN s3 THEN 3 ELSE 4 END AS DOUBLE) AS prediction
        FROM {CLASS_SCORES}""",
    # Scores (a, b, c, d) by price: below 100000 (1,1,0,0), below 250000 (1,0,0,0),
    # below 400000 (0,0,1,0), above (0,0,1,1). The first of equal maxima wins.
    "argmax_tie": f"SELECT o_orderkey, {case('o_totalprice', 250000, 0, 2)} AS prediction FROM orders",
    "output_width": """
        SELECT CAST(p_partkey AS VARCHAR) AS model_id,
               CAST(p_size // 10 + 1 AS INTEGER) AS n_outputs,
               CAST(p_size // 10 + 1 AS INTEGER) AS used_outputs,
               CAST(p_size + CASE WHEN p_retailprice >= 1000 THEN 1 ELSE 0 END AS BIGINT)
               AS input_width FROM part""",
    "rename_outputs": f"SELECT event_id, event_type, value, {EVENT_KIND} AS score FROM events",
    "rename_probability": f"""
        SELECT {KEYS}, {_three(0, 0)} AS middle, {case('l_discount', 0.05, 0, 2)} AS class
        FROM lineitem""",
    "filter_after_score": f"""
        SELECT {KEYS}, {TWO_SCALARS} AS prediction FROM lineitem
        WHERE l_shipdate < TIMESTAMP '1998-06-01' AND {TWO_SCALARS} > 0""",
    "aggregate_scores": f"""
        SELECT l_returnflag, l_linestatus, count(*) AS n, sum(s) AS total, max(s) AS best
        FROM (SELECT l_returnflag, l_linestatus, {total(FOREST)} AS s FROM lineitem)
        GROUP BY 1, 2""",
    "pipeline_stage": f"SELECT o_orderkey, {ORDER_PRICE} AS prediction FROM orders",
    "saved_pipeline": f"SELECT o_orderkey, {ORDER_PRICE} AS prediction FROM orders",
    "empty_input": """
        SELECT count(*) AS n, count(value) AS n_scored FROM events WHERE value < 0""",
    "partition_invariance": """
        SELECT count(*) AS rows_left, count(*) AS rows_right, count(*) AS keys_met,
               CAST(0 AS DOUBLE) AS max_abs_diff, CAST(0 AS BIGINT) AS over_tolerance
        FROM orders""",
    "copy_params": f"SELECT o_orderkey, {ORDER_PRICE} AS score FROM orders",
    "deferred_load": f"SELECT {KEYS}, {STUMP} AS prediction FROM lineitem",
    # One kind of damage per size; see registries.broken_by_part.
    "model_violations": """
        SELECT CAST(p_partkey AS VARCHAR) AS model_id, rule, tree_id, node_id
        FROM part JOIN (VALUES
            (1, 'missing_child', 0, 7), (1, 'unreachable', 0, 2),
            (2, 'bad_split_feature', 0, 0), (3, 'bad_tree_group', 0, -1),
            (4, 'unknown_split_op', 0, 0), (5, 'duplicate_node', 0, 2),
            (6, 'unreachable', 0, 3), (6, 'unreachable', 0, 4),
            (7, 'two_parents', 0, 1), (7, 'unreachable', 0, 2),
            (8, 'unknown_aggregation', -1, -1), (9, 'leaf_has_children', 0, 1),
            (10, 'no_header', -1, -1), (10, 'bad_tree_group', 0, -1),
            (11, 'nan_threshold', 0, 0)) AS v(size, rule, tree_id, node_id)
        ON p_size = size""",
    "parity_report": """
        SELECT count(*) AS rows_left, count(*) AS rows_right, count(*) AS keys_met,
               CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right,
               CAST(0 AS BIGINT) AS repeated_keys, CAST(0 AS BIGINT) AS uneven_keys,
               CAST(0 AS DOUBLE) AS max_abs_diff, CAST(0 AS BIGINT) AS over_tolerance,
               CAST(0 AS BIGINT) AS argmax_disagreements FROM orders""",
    "parity_report_differs": f"""
        WITH p AS (SELECT event_type <> 'view' AS met, {f32('value')} < {f32(20)} AS low
                   FROM events)
        SELECT count(*) AS rows_left, count(*) FILTER (WHERE met) AS rows_right,
               count(*) FILTER (WHERE met) AS keys_met,
               count(*) FILTER (WHERE NOT met) AS only_left, CAST(0 AS BIGINT) AS only_right,
               CAST(0 AS BIGINT) AS repeated_keys, CAST(0 AS BIGINT) AS uneven_keys,
               max(CASE WHEN met AND low THEN 45 WHEN met THEN 63 END)::DOUBLE AS max_abs_diff,
               count(*) FILTER (WHERE met AND NOT low) AS over_tolerance,
               CAST(0 AS BIGINT) AS argmax_disagreements FROM p""",
    "parity_noise": """
        WITH v AS (SELECT l_orderkey AS k, l_quantity::DOUBLE AS a, (l_quantity + l_linenumber / 1048576.0::DOUBLE
                          + CASE l_linenumber WHEN 2 THEN 0.25 ELSE 0 END)::DOUBLE AS b FROM lineitem),
        p AS (SELECT k, max(abs(x.a - y.b)) AS diff
              FROM (SELECT k, a, row_number() OVER (PARTITION BY k ORDER BY a) AS i FROM v) x
              JOIN (SELECT k, b, row_number() OVER (PARTITION BY k ORDER BY b) AS i FROM v) y USING (k, i) GROUP BY k)
        SELECT (SELECT count(*) FROM v) AS rows_left, (SELECT count(*) FROM v) AS rows_right, count(*) AS keys_met,
               0::BIGINT AS uneven_keys, max(diff) AS max_abs_diff, count(*) FILTER (diff > 1e-5) AS over_tolerance
        FROM p""",
    # Quantities are whole numbers, so only rows of one quantity meet, the least noise first.
    "parity_uneven_keys": """
        WITH v AS (SELECT l_orderkey AS k, l_quantity AS q, l_linenumber % 3 != 0 AS met,
                          l_linenumber / 1048576.0::DOUBLE AS noise FROM lineitem),
        u AS (SELECT k FROM v GROUP BY k HAVING count(*) FILTER (met) BETWEEN 1 AND count(*) - 1),
        p AS (SELECT k, q, noise, count(*) OVER (PARTITION BY k, q) AS n,
                     row_number() OVER (PARTITION BY k, q ORDER BY NOT met, noise) AS i, met
              FROM v SEMI JOIN u USING (k))
        SELECT (SELECT count(*) FROM v) AS rows_left, (SELECT count(*) FROM v WHERE met) AS rows_right,
               (SELECT count(DISTINCT k) FROM v WHERE met) AS keys_met, (SELECT count(*) FROM u) AS uneven_keys,
               count(*) FILTER (NOT met) AS unmatched_outputs, max(noise) FILTER (met) AS max_aligned_diff FROM p""",
    "registry_score": f"""
        SELECT event_id, event_type,
               CASE event_type WHEN 'click' THEN {case('value', 5, 1, -1)}
                               WHEN 'error' THEN {case('value', 10, 2, -2)}
                               WHEN 'purchase' THEN {case('value', 15, 3, -3)}
                               WHEN 'signup' THEN {case('value', 20, 4, -4)} END AS prediction
        FROM events""",
    "registry_per_user": PER_USER,
    "registry_per_user_grouped": PER_USER,
    "registry_per_user_joined": PER_USER,
    "registry_duplicate_names": f"""
        SELECT event_id, e.user_id, value, -7 AS row, 'a' AS x1, event_type AS x2, 1 AS model, 2 AS s, prediction
        FROM ({PER_USER}) JOIN events e USING (event_id)""",
    "registry_large_model": f"""
        SELECT {KEYS}, CASE l_returnflag WHEN 'R' THEN 'forest_small' WHEN 'N' THEN 'forest' ELSE 'none' END AS m,
               CASE l_returnflag WHEN 'R' THEN {total(FOREST_SMALL)} WHEN 'N' THEN {total(FOREST)} END AS prediction
        FROM lineitem""",
    "forest_registry_built": FOREST_PER_USER,
    "registry_two_versions": f"""
        SELECT event_id, a.user_id, a.prediction AS before, b.prediction AS after, true AS same
        FROM ({PER_USER}) a JOIN ({FOREST_PER_USER}) b USING (event_id)""",
    "stream_registry_score": f"""
        SELECT * FROM ({PER_USER}) WHERE event_id % 2 = 0
        UNION ALL SELECT * FROM ({FOREST_PER_USER}) WHERE event_id % 2 = 1""",
    "leaf_table_score": f"SELECT {KEYS}, {total(FOREST_SMALL)} AS prediction FROM lineitem",
    "leaf_box_score": f"""
        SELECT {KEYS}, {total(FOREST_SMALL, tree_with_missing)} AS prediction FROM (
            SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_tax,
                   CASE l_linenumber WHEN 3 THEN 'nan'::DOUBLE ELSE l_discount END AS l_discount FROM lineitem)""",
    "stream_score": f"SELECT event_id, event_type, {EVENT_KIND} AS prediction FROM events",
}
SQL["string_input_joined"] = SQL["string_input"]
SQL["string_and_vector_joined"] = SQL["string_and_vector"]
for _plan in ("arrow", "group", "join"):
    SQL[f"registry_mixed_widths_{_plan}"] = """
        SELECT CAST(p_partkey AS VARCHAR) AS part, CASE WHEN p_size >= 10 THEN 0 ELSE 1 END::DOUBLE AS prediction,
               CASE WHEN p_size >= 10 THEN p_size // 10 + 1 ELSE -1 END::INTEGER AS n_classes FROM part"""
    SQL[f"registry_hot_model_{_plan}"] = f"""
        WITH e AS (SELECT event_id, CASE event_type WHEN 'signup' THEN 'signup' ELSE 'click' END AS kind,
                          floor(value / 10) * 10.0::DOUBLE AS value FROM events)
        SELECT event_id, kind, value,
               CASE kind WHEN 'click' THEN {case('value', 5, 1, -1)} ELSE {case('value', 20, 4, -4)} END AS prediction
        FROM e"""
