"""Every query against its SQL, or against brute force where SQL cannot say it, on whole tables."""

import math
import os
from collections import Counter

import brute
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers

import __spark_entry__
from ensemblescore.llm import embeddings, language_model, simhash, substrings

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()


def rows_of(df):
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n.startswith("op") and n in SQL])
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):  # what the operators read
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    con.execute(f"CREATE TABLE want AS {SQL[name]}")
    names = sorted(r[0] for r in con.execute("DESCRIBE want").fetchall())
    assert names == sorted(got.columns)
    want = Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                   for r in con.execute(f"SELECT {', '.join(names)} FROM want").fetchall())
    assert rows_of(got) == want


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in QUERIES


def test_simhash(spark, documents):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, SF).collect()}
    assert got == {(k, f"{p:016x}", c) for k, p, c in brute.simhash(documents)}


def test_sentencepiece(spark, documents):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = set()
    for key, text in documents:
        ids = model.encode(text or "", add_eos=True)
        want.add((key, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(model.decode(ids))))
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in QUERIES["op3_sentencepiece"](spark, SF).collect()}
    assert got == want


def test_language_model(spark, documents):
    want, total = brute.language_model(documents, language_model.PRIOR)
    got = {r.doc_id: r for r in QUERIES["op4_lm_scores"](spark, SF).collect()}
    assert len(got) == len(want)
    for key, held, tokens, known, base, score in want:
        r = got[key]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, total)
        assert np.allclose([r.base_score, r.score], [base, score], rtol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_sums_to_one(spark):
    """From any state, the words of training and one unknown word share all probability."""
    train = [(i, " ".join("ab"[i >> b & 1] for b in range(3))) for i in range(8)]
    known = [(100 + i, f"{v} {w}") for i, (v, w) in enumerate((v, w) for v in "ab" for w in "abz")]
    ends = [(200 + i, v) for i, v in enumerate("ab")]
    df = spark.createDataFrame([(k, t, k >= 100) for k, t in train + known + ends], "doc_id long, text string, held boolean")
    got = {r.doc_id: r.score for r in language_model.score(df, df["held"]).collect()}
    rows, _ = brute.language_model(train + known + ends, language_model.PRIOR, held=lambda k: k >= 100)
    for key, _, _, _, _, score in rows:
        assert got[key] == pytest.approx(score)


def test_mixing_comes_near_its_targets(spark):
    rows = QUERIES["op6_mixing"](spark, SF).collect()
    by_target = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        by_target.setdefault((r.source_size, r.target), []).append(r.taken)
    assert sum(t for _, t in by_target) == pytest.approx(1.5 * sum(r.size for r in rows))
    for (size, target), taken in by_target.items():
        assert abs(sum(taken) - target) <= 8 * 64 and target <= 2 * size


def test_mixing_reruns_agree(spark):
    assert rows_of(QUERIES["op6_mixing"](spark, SF)) == rows_of(QUERIES["op6_mixing"](spark, SF))


def test_token_counts(spark, documents):
    model = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {(k, len((t or "").encode()), n := len(model.encode(t or "", add_special_tokens=False).ids), n > 1024)
            for k, t in documents}
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op7_token_counts"](spark, SF).collect()}
    assert got == want


def test_embeddings(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in QUERIES["op8_embedding_dedup"](spark, SF).collect())
    assert got == sorted(brute.near_vectors(vectors))


def test_embeddings_find_dense_groups_whole(spark):
    """Groups larger than a window, loose groups, and copies: recall against brute force."""
    rng = np.random.default_rng(3)
    base = rng.standard_normal((4, 16))
    rows = [(base[i % 4] + rng.standard_normal(16) * rng.choice([0, .1, .25, .4])).tolist() for i in range(400)]
    rows = list(enumerate(rows + [rows[0]] * 30))
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), passes=12, window=16)
    want = sorted(brute.near_vectors(rows))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in got.collect())
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)


@pytest.mark.parametrize("window, block", [(64, 256), (512, 4096)])
def test_embeddings_find_pairs_among_even_vectors(spark, window, block):
    """600 planted pairs just above the threshold among 12,000 vectors: recall, and no link that is none."""
    rng = np.random.default_rng(5)
    n, pairs, width = 12_000, 600, 64
    vectors = rng.standard_normal((n, width))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    first, apart = vectors[:pairs], vectors[pairs:2 * pairs]
    apart = apart - (apart * first).sum(axis=1, keepdims=True) * first
    apart /= np.linalg.norm(apart, axis=1, keepdims=True)
    vectors[pairs:2 * pairs] = 0.951 * first + math.sqrt(1 - 0.951 ** 2) * apart
    values = pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), width).cast(pa.list_(pa.float64()))
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": values}))
    got = {r.vec_id: r.component_id for r in embeddings.near_vectors(df, window=window, block=block).collect()}
    assert sum(got[k] == got[k + pairs] for k in range(pairs)) >= 0.99 * pairs
    assert all(got[k] == k for k in range(n) if not pairs <= k < 2 * pairs)


def test_embeddings_find_pairs_in_topics_within_runs(spark):
    """Two close topics of 2,000 vectors each and a tight group of copies, windows of 32: runs are ordered again."""
    rng = np.random.default_rng(7)
    n, pairs, width = 4_000, 200, 64
    topics = np.zeros((2, width))
    topics[:, 0], topics[0, 1], topics[1, 1] = 1, 0.3, -0.3
    noise = rng.standard_normal((n, width)) * 0.05
    noise[pairs:2 * pairs] = noise[:pairs] + rng.standard_normal((pairs, width)) * 0.02
    vectors = topics[np.arange(n) % 2] + noise
    copies = np.eye(1, width, 5) + rng.standard_normal((500, width)) * 0.001
    vectors = np.concatenate([vectors, copies])
    df = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id)
           for r in embeddings.near_vectors(df, threshold=0.985, window=32, block=128).collect()}
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    want = (vectors @ vectors.T >= 0.985).sum(axis=1) - 1
    linked = np.flatnonzero(want).tolist()
    assert len(linked) >= 2 * pairs - 10 + 500
    assert all(got[k][0] <= want[k] for k in range(n + 500))
    assert sum(got[k][0] == want[k] for k in linked[:-500]) >= 0.95 * len(linked[:-500])
    assert all(got[k] == (499, n) for k in range(n, n + 500))


def test_embeddings_find_pairs_in_a_hot_topic(spark):
    """100,000 vectors at mutual cosine 0.85; only the planted pairs, at 0.955, are linked."""
    rng = np.random.default_rng(11)
    n, pairs, width = 100_000, 300, 64
    topic = np.eye(1, width)[0]

    def across(v, *others):
        for o in others:
            v = v - (v * o).sum(axis=-1, keepdims=True) * o
        return v / np.linalg.norm(v, axis=-1, keepdims=True)

    own = across(rng.standard_normal((n, width)), topic)
    first = own[:pairs]
    inner = (0.955 - 0.85) / 0.15
    own[pairs:2 * pairs] = inner * first + math.sqrt(1 - inner ** 2) * across(
        rng.standard_normal((pairs, width)), topic, first)
    vectors = math.sqrt(0.85) * topic + math.sqrt(0.15) * own
    values = pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), width).cast(pa.list_(pa.float64()))
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": values}))
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df).where(f"vec_id < {2 * pairs}").collect()}
    want = vectors[:2 * pairs] @ vectors.T >= embeddings.THRESHOLD
    assert {k: v[0] for k, v in got.items()} == {k: int(want[k].sum()) - 1 for k in range(2 * pairs)}
    assert all(got[k][1] == got[k + pairs][1] for k in range(pairs))


@pytest.mark.parametrize("crowd", [substrings.CROWD, 2])
def test_substrings(spark, documents, crowd):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept)
                  for r in substrings.remove_repeats(df, block_bytes=50_000, crowd=crowd).collect())
    assert got == Counter(brute.without_repeats(documents))


def test_simhash_segments_change_nothing(spark, documents):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    links = [set(map(tuple, simhash.links(
        df.select(simhash.fingerprints(df["text"]).alias("fingerprint")), bits, segments).collect()))
        for bits, segments in ((6, 2), (6, 4), (6, 7))]
    assert links[0] == links[1] == links[2] and links[0]
