"""How far the sources of a language differ in their terms, by single-pass in-memory indexing.

One pass over the documents builds postings in memory, (language, source, term) with documents and
occurrences, until a block is full, and spills it as a term-sorted run. Runs are dealt to shards by a
hash of language and term; in a shard they meet in Spark's external sort, which merges sorted runs
through a heap and spills, and one pass over the merged postings adds them up to frequencies. The same
order is read once more to stream what pairs of sources share.

Shares are whole numbers of billionths, smoothed by two occurrences per term, and a difference is
``f(p, q) = floor((p - q)^2 / (p + q))``. With ``p0`` and ``q0`` the shares of a term that is not there,

    sum of f(p, q) = V f(p0, q0) + sum over terms of one     f(p, q0) - f(p0, q0)
                                 + sum over terms of the other f(p0, q) - f(p0, q0)
                                 + sum over terms of both    f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

so absent terms cost nothing, terms of one source are counted by how often they occur, and only
terms of both are met pair by pair, in the stream. All arithmetic is in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ensemblescore.llm.text import named, slices, text_bytes, words
from ensemblescore.sources.scratch import ensure_checkpoint_dir

#: Documents that a term of the vocabulary is in at least, and terms reported per source.
MIN_DOCS, TOP_TERMS = 10, 10

#: Postings of a block in memory, and pairs of sources a task adds up before it lets go of them.
MOST_POSTINGS, MOST_PAIRS = 1 << 19, 1 << 20

#: A source's terms are spread over so many keys when its total is joined to them.
SPREAD = 16

POSTING = "lang string, term string, source string, docs bigint, n bigint"

#: ASCII letters in lower case and all other characters' bytes; the rest of ASCII parts terms.
_FOLD = np.array([c if c >= 0x80 else c | 0x20 if chr(c).isalpha() else 0x20 for c in range(256)], np.uint8)


def _terms(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of large_string texts in order, and how many each has."""
    data, offsets = text_bytes(text)
    return words(pa.LargeStringArray.from_buffers(
        len(text), pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(_FOLD[data])))


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin, from whether each row differs from the one before in any column."""
    return np.flatnonzero(np.logical_or.reduce(columns))


def _new(values: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before; the first does."""
    if not len(values):
        return np.zeros(0, bool)
    return np.append(True, pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False))


def _postings(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Postings of a slice of documents; the empty term has the documents of every source."""
    flat, n_words = _terms(text)
    coded = flat.dictionary_encode()
    n_terms = len(coded.dictionary) + 1
    doc = np.repeat(np.arange(len(text)), n_words)
    term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pairs, n = np.unique(doc * n_terms + term, return_counts=True)
    doc, term = np.divmod(pairs, n_terms)
    doc, term, n = (np.append(a, b) for a, b in (
        (doc, np.arange(len(text))), (term, np.full(len(text), n_terms - 1)), (n, np.zeros(len(text), np.int64))))
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    group = (langs.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(sources.dictionary)
             + sources.indices.to_numpy(zero_copy_only=False))
    key = group[doc] * n_terms + term
    order = np.argsort(key, kind="stable")
    keys, first, docs = np.unique(key[order], return_index=True, return_counts=True)
    group, term = np.divmod(keys, n_terms)
    of_lang, of_source = np.divmod(group, max(1, len(sources.dictionary)))
    names = pa.concat_arrays([coded.dictionary.cast(pa.large_string()), pa.array([""], pa.large_string())])
    return pa.table({
        "lang": langs.dictionary.take(pa.array(of_lang)).cast(pa.large_string()),
        "term": names.take(pa.array(term)),
        "source": sources.dictionary.take(pa.array(of_source)).cast(pa.large_string()),
        "docs": docs, "n": np.add.reduceat(n[order], first) if len(first) else np.zeros(0, np.int64)})


def _merged(index: list[pa.Table]) -> pa.Table:
    by = pa.concat_tables(index).group_by(["lang", "term", "source"]).aggregate([("docs", "sum"), ("n", "sum")])
    return by.rename_columns(["lang", "term", "source", "docs", "n"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term-sorted runs of a task's documents, one for each time that its memory is full."""
    def spilled(index):
        run = _merged(index).sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending")])
        yield from run.cast(pa.schema([(f.name, pa.string() if pa.types.is_large_string(f.type) else f.type)
                                       for f in run.schema])).to_batches(max_chunksize=1 << 16)

    index, n = [], 0
    for batch in batches:
        for first, rows in slices(batch.column("text")):
            part = batch.slice(first, len(rows))
            index.append(_postings(part.column("lang"), part.column("source"), rows))
            n += index[-1].num_rows
            if n > MOST_POSTINGS:
                index = [_merged(index)]
                n = index[0].num_rows
                if 2 * n > MOST_POSTINGS:
                    yield from spilled(index)
                    index, n = [], 0
    if index:
        yield from spilled(index)


def _whole_terms(batches: Iterator[pa.RecordBatch], merge=lambda rows: rows) -> Iterator[pa.Table]:
    """The batches of rows sorted by language and term, cut anew so that no term is parted.

    ``merge`` may make the rows of terms fewer; what is held is a batch and one term."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        rows = merge(rows.combine_chunks())
        if not rows.num_rows:
            continue
        last = int(_starts(_new(rows["lang"].chunk(0)), _new(rows["term"].chunk(0)))[-1])
        if last:
            yield rows.slice(0, last).combine_chunks()
        held = rows.slice(last)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _added_up(rows: pa.Table) -> pa.Table:
    """Sorted postings with those of one language, term and source made one."""
    if not rows.num_rows:
        return rows
    first = _starts(*[_new(rows[c].chunk(0)) for c in ("lang", "term", "source")])
    if len(first) == rows.num_rows:
        return rows
    kept = rows.take(pa.array(first))
    for i, c in ((3, "docs"), (4, "n")):
        kept = kept.set_column(i, c, pa.array(np.add.reduceat(rows[c].to_numpy(), first)))
    return kept.combine_chunks()


def _frequencies(min_docs: int):
    """Frequencies of the vocabulary from a shard's merged postings, and a row per source."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_terms(batches, _added_up):
            first = _starts(_new(rows["lang"].chunk(0)), _new(rows["term"].chunk(0)))
            n_rows = np.diff(np.append(first, rows.num_rows))
            docs = np.add.reduceat(rows["docs"].to_numpy(), first)
            total = np.repeat(np.add.reduceat(rows["n"].to_numpy(), first), n_rows)
            nothing = pc.equal(rows["term"].chunk(0), "").to_numpy(zero_copy_only=False)
            kept = np.repeat(docs >= min_docs, n_rows) | nothing
            opens = np.zeros(rows.num_rows, np.int64)
            opens[first] = 1
            opens[nothing] = 0
            table = rows.drop_columns(["docs"]).append_column("lang_n", pa.array(total)).append_column(
                "opens", pa.array(opens)).filter(pa.array(kept))
            yield from table.combine_chunks().to_batches(max_chunksize=1 << 16)
    return run


def _share(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (n + 2) / total), in two steps of long division: exact up to 9 * 10^13 occurrences."""
    whole, rest = np.divmod((n + 2) * 100_000, total)
    return 1 + whole * 10_000 + rest * 10_000 // total


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, value): the corrections for terms of both sources, added up over the task's terms."""
    numbers: dict[tuple, int] = {}
    sums: dict[int, int] = {}

    def let_go():
        groups = list(numbers)
        yield pa.record_batch(
            [pa.array([groups[k >> 32][0] for k in sums], pa.string()),
             pa.array([groups[k >> 32][1] for k in sums], pa.string()),
             pa.array([groups[k & 0xFFFFFFFF][1] for k in sums], pa.string()),
             pa.array(list(sums.values()), pa.int64())], names=["lang", "a", "b", "value"])
        sums.clear()

    for rows in _whole_terms(batches):
        langs, sources = rows["lang"].chunk(0).dictionary_encode(), rows["source"].chunk(0).dictionary_encode()
        pair = (langs.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(sources.dictionary)
                + sources.indices.to_numpy(zero_copy_only=False))
        found, at = np.unique(pair, return_inverse=True)
        lang_names, source_names = langs.dictionary.to_pylist(), sources.dictionary.to_pylist()
        group = np.array([numbers.setdefault((lang_names[g // len(source_names)], source_names[g % len(source_names)]),
                                             len(numbers)) for g in found.tolist()], np.int64)[at]
        first = _starts(_new(rows["lang"].chunk(0)), _new(rows["term"].chunk(0)))
        ends = np.append(first[1:], rows.num_rows)
        left = np.repeat(ends, ends - first) - np.arange(rows.num_rows)  # rows of the term from here on
        n, total = rows["n"].to_numpy(), rows["total"].to_numpy()
        p, p0 = _share(n, total), _share(np.zeros_like(n), total)
        for k in range(1, int(left.max())):
            i = np.flatnonzero(left > k)
            j = i + k
            value = _f(p[i], p[j]) - _f(p[i], p0[j]) - _f(p0[i], p[j]) + _f(p0[i], p0[j])
            key = group[i] << 32 | group[j]
            order = np.argsort(key, kind="stable")
            keys, start = np.unique(key[order], return_index=True)
            for x, v in zip(keys.tolist(), np.add.reduceat(value[order], start).tolist()):
                sums[x] = sums.get(x, 0) + v
            if len(sums) > MOST_PAIRS:
                yield from let_go()
    if sums:
        yield from let_go()


def _share_of(n: str, total: str) -> Column:
    """The share of ``n`` occurrences among ``total``, in decimals that hold it exactly."""
    return F.expr(f"1 + (cast(1000000000 AS decimal(10, 0)) * cast({n} + 2 AS decimal(19, 0))) "
                  f"div cast({total} AS decimal(19, 0))")


def _difference(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def _salted(left: DataFrame, right: DataFrame, on: list[str], by: Column) -> DataFrame:
    """An equi-join on few and uneven keys: ``left`` is spread by ``by``, ``right`` sent to every part."""
    parts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    return left.withColumn("spread", F.pmod(F.xxhash64(by), F.lit(SPREAD)).cast("int")).join(
        right.withColumn("spread", parts), [*on, "spread"]).drop("spread")


def frequencies(df: DataFrame, min_docs: int = MIN_DOCS, lang: str = "lang", source: str = "source",
                text: str = "text") -> DataFrame:
    """``lang``, ``term``, ``source``, ``n``, ``lang_n``, ``opens``: how often each source has each kept term.

    A language keeps the terms that ``min_docs`` of its documents have. ``opens`` is 1 on one row
    of each term; the empty term has a row for every source that occurs, with or without terms."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(*[F.coalesce(named(c).cast("string"), F.lit("")).alias(a)
                       for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    return rows.mapInArrow(_runs, POSTING).repartition("lang", "term").sortWithinPartitions(
        "lang", "term", "source").mapInArrow(
        _frequencies(min_docs), "lang string, term string, source string, n bigint, lang_n bigint, opens bigint"
    ).checkpoint()


def audit(df: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, lang: str = "lang",
          source: str = "source", text: str = "text") -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: what sets each source apart.

    Part ``pair`` has every other source of the language with the difference summed over all kept
    terms, 0 in a language without any. Part ``term`` has the ``top`` terms whose share in the
    source is above that in the language, by their difference; it ranks no term that is not so.
    Ranks count from 1, larger values first, then items by their bytes. A null language, source or
    text is empty, and an empty source is one like any other; repeated rows count as often as they
    occur; an empty table gives no rows; other columns are not read. The result has a row for each
    ordered pair of sources, so it grows with their square, and nothing before it does.
    """
    counted = frequencies(df, min_docs, lang, source, text)
    by_source = counted.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum("opens").alias("opens"))
    by_lang = by_source.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("opens").alias("v"))
    totals = by_source.join(by_lang, "lang").select(
        "lang", "source", "v", (F.col("n") + 2 * F.col("v")).alias("total"),
        (F.col("lang_n") + 2 * F.col("v")).alias("lang_total")).checkpoint()

    terms = _salted(counted.where("term != ''").drop("opens"), totals, ["lang", "source"], F.col("term"))
    others = totals.select("lang", F.col("source").alias("other"), F.col("total").alias("other_total"))

    # What every pair has from its sizes alone; a language without terms has totals of 0.
    base = totals.join(others, "lang").where("source < other").select(
        "lang", F.col("source").alias("a"), F.col("other").alias("b"), "v",
        F.when(F.col("v") > 0, _share_of("0", "total")).otherwise(1).alias("p0"),
        F.when(F.col("v") > 0, _share_of("0", "other_total")).otherwise(1).alias("q0")
    ).select("lang", "a", "b", (F.col("v") * _difference("p0", "q0")).alias("value"))
    often = terms.groupBy("lang", "source", "total", "n").agg(F.count("*").alias("terms"))
    alone = _salted(often, others, ["lang"], F.col("n")).where("source != other").select(
        "lang", "source", "other", "terms", _share_of("n", "total").alias("p"), _share_of("0", "total").alias("p0"),
        _share_of("0", "other_total").alias("q0")).select(
        "lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"),
        (F.col("terms") * (_difference("p", "q0") - _difference("p0", "q0"))).alias("value"))
    both = terms.select("lang", "term", "source", "n", "total").repartition("lang", "term").sortWithinPartitions(
        "lang", "term", "source").mapInArrow(_shared_terms, "lang string, a string, b string, value bigint")
    pairs = base.unionByName(alone).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pair_rows = pairs.select("lang", "value", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x")).select(
        "lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")

    term_rows = terms.select("lang", "source", "term", _share_of("n", "total").alias("p"),
                             _share_of("lang_n", "lang_total").alias("q")).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _difference("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order).alias("rank")
    return pair_rows.select("*", rank).unionByName(term_rows.select("*", rank).where(F.col("rank") <= top))
