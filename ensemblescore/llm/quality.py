"""Quality rules kept as a ledger: measure once, store failure bits, decide by policy later."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ensemblescore.llm.text import codes, named, slices, sums, text_bytes, unused, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_echo_words", "n_capitals")

#: Rule name and failure condition, in the order of their bits. All are integer comparisons.
RULES = {
    "too_few_words": "n_words < 10",
    "repeated_passages": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "echoed_words": "10 * n_echo_words > 3 * n_words",
    "capitals": "10 * n_capitals > 3 * word_chars and n_words >= 10",
}

#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("too_few_words", "repeated_passages"),
    "v1": tuple(RULES),
}

#: The words a passage must repeat to count as repeated.
WINDOW = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[list(range(ord("A"), ord("Z") + 1))] = True


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(rules) -> int:
    return sum(bit(rule) for rule in rules)


def _repeated(word: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """For each row, the words covered by a window that occurs twice or more in the row.

    Windows get exact numbers by doubling: words, pairs, fours, then four and one."""
    n = len(word)
    row = np.repeat(np.arange(len(n_words)), n_words)
    if n < WINDOW:
        return np.zeros(len(n_words), np.int64)

    def pair(left, right):
        return pd.factorize(left * (right.max() + 1) + right)[0]

    two = pair(word[:-1], word[1:])
    four = pair(two[:-2], two[2:])
    five = pair(four[:-1], word[4:])
    own = pair(five, row[: n - WINDOW + 1])
    inside = row[: n - WINDOW + 1] == row[WINDOW - 1:]
    again = inside & (np.bincount(own[inside], minlength=own.max() + 1)[own] > 1)
    step = np.zeros(n + 1, np.int64)
    step[: n - WINDOW + 1] += again
    step[WINDOW:] -= again
    return sums(np.cumsum(step)[:n] > 0, n_words)


def _measure_slice(text: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = text_bytes(text)
    sizes = np.diff(offsets)
    flat, n_words = words(text)
    word = codes(flat)
    row = np.repeat(np.arange(len(text)), n_words)
    echo = np.zeros(len(word), bool)
    echo[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])

    lists = pc.split_pattern(text, "\n")
    lines = lists.flatten()
    line_row = np.repeat(np.arange(len(text)), np.diff(lists.offsets.to_numpy()))
    full = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0).to_numpy(
        zero_copy_only=False)
    line, line_row = codes(lines)[full], line_row[full]
    seen = pd.DataFrame({"row": line_row, "line": line}).duplicated().to_numpy()
    return {
        "n_words": n_words,
        "word_chars": sums(~_SPACE[data] & ((data & 0xC0) != 0x80), sizes),
        "n_symbols": sums(_SYMBOL[data], sizes),
        "n_lines": np.bincount(line_row, minlength=len(text)),
        "n_dup_lines": np.bincount(line_row[seen], minlength=len(text)),
        "n_repeat_words": _repeated(word, n_words),
        "n_echo_words": sums(echo, n_words),
        "n_capitals": sums(_CAPITAL[data], sizes),
    }


def _measure(text: pa.Array) -> pa.Array:
    parts = [_measure_slice(rows) for _, rows in slices(text)]
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate([p[m] for p in parts] or [[]]), pa.int64()) for m in MEASURES],
        names=list(MEASURES))


def measures(text: Column) -> Column:
    """All measurements of a text column, as one struct; a null text measures as an empty one."""
    kind = "struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">"
    return F.arrow_udf(_measure, kind)(text.cast("string"))


def failures(measured: str) -> Column:
    """The bits of the rules that a struct of measurements fails."""
    def fails(condition: str) -> Column:
        return F.expr(re.sub(r"\b(" + "|".join(MEASURES) + r")\b", rf"{measured}.\1", condition))
    return sum((F.when(fails(condition), F.lit(bit(rule)).cast("bigint")).otherwise(F.lit(0))
                for rule, condition in RULES.items()), F.lit(0).cast("bigint"))


def ledger(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, the measurements, and ``failures``, a bit per failed rule.

    Every rule is evaluated once, whatever policies come later. A null or empty text has
    no words and fails ``too_few_words``; null keys and repeated rows are kept as they are.
    Narrow: no shuffle, and memory is a few slices of one Arrow batch.
    """
    rows = df.select(df[key].alias("doc_id"), measures(df[text]).alias("m"))
    return rows.withColumn("failures", failures("m")).select("doc_id", "m.*", "failures")


def passes(bits: Column, policy: str = "v1") -> Column:
    """Whether no rule of the policy has failed."""
    return bits.bitwiseAND(F.lit(mask(POLICIES[policy])).cast("bigint")) == 0


def passing(df: DataFrame, policy: str = "v1", text: str = "text") -> DataFrame:
    """The rows of ``df`` that no rule of the policy rejects, in the same columns."""
    name = unused(df, "measured")
    # By position: the table may have several columns of one name.
    return df.select("*", measures(named(text)).alias(name)).where(passes(failures(name), policy)).drop(name)


def ablations(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of a policy: ``n_failed``, and ``n_only``, the documents it alone rejects.

    Works on the ledger's bits: documents are first counted per pattern of failures,
    of which there are at most two to the number of rules.
    """
    patterns = rows.groupBy(F.col("failures").bitwiseAND(
        F.lit(mask(POLICIES[policy])).cast("bigint")).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("bigint").alias("b"))
                                for r in POLICIES[policy]]))
    return patterns.select("bits", "n", rules.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.b")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.b"), F.col("n")).otherwise(0)).alias("n_only"))
