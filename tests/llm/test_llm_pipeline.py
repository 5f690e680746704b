"""Each stage of the pipeline against brute force on what its predecessor kept."""

import os
from collections import Counter

import brute
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from ensemblescore.llm import mixing

SF = "/root/testdata/sf0.001"


def first_of_groups(rows):
    """The smallest key of each SimHash group."""
    return sorted({c for _, _, c in brute.simhash(rows)})


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert out.columns == columns or i == 4
        out.write.parquet(str(tmp_path / str(i)))
        kept.append((docs, docs := spark.read.parquet(str(tmp_path / str(i)))))
    texts = [[[(r.doc_id, r.text) for r in df.collect()] for df in pair if "text" in df.columns] for pair in kept]

    before, after = texts[0]
    assert Counter(after) == Counter((k, t) for k, t in before if brute.quality(t)[-1])
    before, after = texts[1]
    assert sorted(k for k, _ in after) == first_of_groups(before) and set(after) <= set(before)
    before, after = texts[2]
    left = {k: (t if not n else kept_) for (k, t), (_, _, n, kept_) in zip(before, brute.without_repeats(before))}
    assert dict(after) == left and all(r.n_chars == len(r.text) for r in kept[2][1].collect())
    before, after = texts[3]
    taken = {r.doc_id: r.taken / max(1, r["size"]) for r in mixing.mix(kept[3][0]).taken.collect()}
    times = Counter(k for k, _ in after)
    assert set(after) <= set(before) and all(abs(times[k] - x) <= 0.5 for k, x in taken.items())
    words = {s: 0 for s in ("before", "after")}
    words["before"] = sum(len(brute.words(t)) for _, t in before)
    words["after"] = sum(len(brute.words(t)) for _, t in after)
    assert abs(words["after"] / words["before"] - 1.5) < 0.05

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((k, tuple(ids := model.encode(t, add_eos=True)), brute.sha(model.decode(ids))) for k, t in texts[4][0])
    assert Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in docs.collect()) == want
    assert Counter((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect()) == Counter(
        (r.doc_id, r.n_tokens) for r in docs.collect())


def test_stages_on_nothing_and_on_odd_rows(spark):
    rows = [(1, None, "en", "a", None), (None, "", None, None, 0), (2, "word " * 40, "en", "a", 5), (2, "word " * 40, "en", "a", 5),
            (3, " ".join(f"w{i}" for i in range(90)), "de", "b", 9), (None, " ".join(f"v{i}" for i in range(90)), "de", "b", 9)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(
        "*", *[F.lit(1).alias(c) for c in ("digest", "row", "kept", "measured", "chosen", "copies", "ids")])
    for docs in (odd, odd.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, "").count() <= 2 * len(rows)


def test_stages_keep_columns_of_any_name(spark):
    """Extra columns with a dot, of one name, and of a type that has no order."""
    rows = [(k, " ".join(f"w{k % 7}x{i}" for i in range(60)), "en", "ab"[k % 2], 0) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "doc_id AS a", "source AS b", "map('k', doc_id) AS m", "doc_id AS d").toDF(
        "doc_id", "text", "lang", "source", "n_chars", "same", "same", "m", "dot.ted")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        found = out.collect()
        assert found and all(r[5] == r[0] == r[8] == r[7]["k"] and r[6] == r[3] for r in found)
