"""Nulls, empty and long texts, ties and repeated rows, empty tables, and columns of clashing names."""

import random
from collections import Counter

import brute
import duckdb
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from ensemblescore.llm import (chat, components, embeddings, language_model, licenses, mixing, oracle, pieces, quality,
                               simhash, substrings, token_counts)
from ensemblescore.llm.automaton import SuffixAutomaton

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(random.Random(7).choice(["alpha", "beta", "gamma", "delta", "É", "日本"]) for _ in range(60_000))
TEXTS = [None, "", " ", "\n\n", "one", "one two three", "one two three", "a" * 5000, LONG, "x " * 3000, "tab\tand\x0bline\r\n",
         " no-break　wide ", "  double  spaces  ", "▁mark ▁ here▁", "<|endoftext|> a<|endoftext|>b", "</s>[INST]"]
CLASH = ["fingerprint", "component_id", "digest", "size", "rank", "block", "bucket", "payload", "row", "kept", "n_words",
         "measured", "chosen", "copies", "order", "ids", "score", "__block", "target", "taken", "matches"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a null key, a null source, one row twice, one key with two texts, and clashing names."""
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(TEXTS)]
    rows += [(None, "null key " * 30, "s0"), (None, None, None), rows[5], rows[8], (4, "another text of key four", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)]), rows


@pytest.fixture(scope="module")
def none(odd):
    return odd[0].where("false")


def pairs(rows):
    return [(k, t) for k, t, _ in rows]


def test_quality(odd, none):
    df, rows = odd
    got = Counter(tuple(r) for r in quality.ledger(df).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ~quality.passes(F.col("failures"), "base"), quality.passes(F.col("failures"))).collect())
    assert got == Counter((k, *brute.quality(t)) for k, t in pairs(rows))
    assert quality.ledger(none).count() == 0 and quality.passing(none).columns == df.columns
    assert Counter(r.doc_id for r in quality.passing(df).collect()) == Counter(
        k for k, t in pairs(rows) if brute.quality(t)[-1])


def test_quality_ablations_agree_with_the_rules_one_by_one(odd):
    ledger = quality.ledger(odd[0]).cache()
    rows = ledger.collect()
    for r in quality.ablations(ledger).collect():
        b = quality.bit(r.rule)
        assert r.n_failed == sum(bool(x.failures & b) for x in rows)
        assert r.n_only == sum(x.failures == b for x in rows)


def test_simhash(odd, none):
    df, rows = odd
    got = Counter((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == Counter(brute.simhash(pairs(rows)))
    assert simhash.near_duplicates(none).count() == 0 and simhash.representatives(none).count() == 0


def test_simhash_representatives_are_one_row_of_each_group(odd):
    df, rows = odd
    labelled = brute.simhash(pairs(rows))
    linked = [(i, j) for i, (_, p, _) in enumerate(labelled) for j in range(i) if (p ^ labelled[j][1]).bit_count() <= 3]
    first = dict(zip(brute.groups(rows, linked), (c for _, _, c in labelled)))
    got = simhash.representatives(df)
    assert got.columns == df.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter(first.values())


def test_components_of_chains_rings_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(1, 300)] + [(1000, 1001), (1001, 1002), (1002, 1000)]
    links += [(7, 7), (None, 3), (200, 100)] + links[:20]
    random.Random(1).shuffle(links)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(201)}, **{i: 500 for i in range(500, 800)}, 1000: 1000, 1001: 1000, 1002: 1000}
    assert {k: got.get(k, k) for k in want} == want and set(got) <= set(want)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sentencepiece(spark, odd, none):
    df, rows = odd
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = pieces.encode(df, PIECES, block_bytes=20_000)
    got = got.withColumn("text", pieces.decode(got, "ids", PIECES)).collect()
    want = [(k, tuple(model.encode(t or "", add_eos=True))) for k, t in pairs(rows)]
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter(want)
    assert all(r.text == model.decode(list(r.ids)) for r in got)
    assert pieces.encode(none, PIECES).count() == 0


def test_sentencepiece_on_random_texts(spark):
    rng = random.Random(2)
    parts = ["a", "b", " ", "  ", "▁", "\n", "é", "　", "\x00", "word", "</s>", "\t", "日本", "ﬁ", "\U0001f600"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for i in range(300)]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: list(r.ids) for r in pieces.encode(
        spark.createDataFrame(rows, "doc_id long, text string"), PIECES, block_bytes=1000).collect()}
    assert got == {k: model.encode(t, add_eos=True) for k, t in rows}


def test_language_model(odd, none):
    df, rows = odd
    want, total = brute.language_model(pairs(rows), language_model.PRIOR)
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6), r.train_tokens)
                  for r in language_model.score(df, held, block_bytes=20_000).collect())
    assert got == Counter((k, h, n, kn, round(b, 6), round(s, 6), total) for k, h, n, kn, b, s in want)
    assert language_model.score(none, held).count() == 0
    assert {r.n_known for r in language_model.score(df, F.lit(True)).collect()} == {0}


def test_token_counts(spark, odd, none):
    df, rows = odd
    model = tokenizers.Tokenizer.from_file(BYTES)
    rng = random.Random(3)
    parts = ["a", "don't", " ", "  ", "\n", " ", "é", "\x85", " ", "12", "!?", "<|endoftext|>", "日本", "\x1c", "'s"]
    more = [(1000 + i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30))), None) for i in range(300)]
    both = df.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string, source string").drop("source"))
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(both, BYTES).collect())
    assert got == Counter((k, len((t or "").encode()), len(model.encode(t or "", add_special_tokens=False).ids))
                          for k, t in pairs(rows) + pairs(more))
    assert token_counts.count_tokens(none, BYTES).count() == 0


def test_token_counts_reads_other_tokenizers(odd):
    df, rows = odd
    for path, count in ((public_tokenizers.path("word_bpe_49k.json"), lambda m, t: len(m.encode(t, add_special_tokens=False).ids)),
                        (PIECES, lambda m, t: len(m.encode(t)))):
        model = (tokenizers.Tokenizer.from_file(path) if path.endswith("json")
                 else sentencepiece.SentencePieceProcessor(model_file=path))
        got = Counter((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(df, path).collect())
        assert got == Counter((k, count(model, t or "")) for k, t in pairs(rows))


def test_token_counts_encodes_only_what_the_cache_lacks(spark, odd, tmp_path):
    df, _ = odd
    path = str(tmp_path / "cache")
    some = df.where("doc_id < 8")
    token_counts.count_tokens(some, BYTES, path)
    assert spark.read.parquet(path).count() == some.select(F.coalesce("text", F.lit(""))).distinct().count()
    spark.read.parquet(path).withColumn("n_tokens", F.lit(-5).cast("bigint")).write.parquet(str(tmp_path / "marked"))
    counts = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, BYTES, str(tmp_path / "marked")).where(
        "doc_id is not null").collect()}
    assert all((counts[k] == -5) == (k < 8) for k in counts if k != 4)
    token_counts.count_tokens(df, PIECES, path)
    assert spark.read.parquet(path).select("tokenizer").distinct().count() == 2


def test_mixing(odd, none):
    df, rows = odd
    got = mixing.mix(df).taken.collect()
    sizes = [(k, len(brute.words(t))) for k, t in pairs(rows)]
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter(sizes)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    sources = {r["rank"]: (r.source, r.target) for r in got}
    assert [s for _, (s, _) in sorted(sources.items())] == ["s0", "s1", "s2", None]
    assert sum(t for _, t in sources.values()) == pytest.approx(1.5 * sum(n for _, n in sizes))
    assert mixing.mix(none).taken.count() == 0 and mixing.mixed_documents(none).count() == 0
    assert mixing.mixed_documents(df).columns == df.columns


def test_mixing_gives_every_source_its_target(spark):
    """Sources far below a block beside large ones, and one of a single word."""
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(1, 400), f"big{i % 3}") for i in range(300)]
    rows += [(1000 + 10 * s + d, "x " * 5, f"small{s:03d}") for s in range(300) for d in range(3)] + [(9999, "one", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    mix = mixing.mix(df)
    taken, target = Counter(), {}
    for r in mix.taken.collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    assert len(target) == 304 and all(abs(taken[s] - t) <= 0.5 for s, t in target.items())
    pieces_ = mix.pieces.collect()
    assert sum(p.length for p in pieces_) == sum(taken.values())
    # Blocks without a slot of their own stand among the slots, not behind them.
    places = sorted({(p.slot, p["rank"]) for p in pieces_})
    small = [i for i, (_, rank) in enumerate(places) if rank >= 3]
    assert len({s for s, _ in places}) == len(places) and min(small) < 0.1 * len(places) and max(small) > 0.9 * len(places)


def test_mixing_pieces_cover_what_is_taken(odd):
    mix = mixing.mix(odd[0], block=100)
    pieces_, taken = mix.pieces.collect(), mix.taken.collect()
    assert sum(p.length for p in pieces_) == sum(r.taken for r in taken)
    filled = Counter()
    for p in pieces_:
        filled[p.slot] += p.length
    assert max(filled.values()) <= 100
    # A source of few words has a document in one block once per round.
    assert max(Counter((p["rank"], p.block, p.start, p.begin) for p in pieces_).values()) <= mixing.EPOCHS


def test_mixing_targets_reshare_what_is_above(spark):
    """Against resharing step by step."""
    sizes = [("a", 100), ("b", 10), ("c", 1000), ("d", 5), (None, 50)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, size long")).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    capped, size = {}, dict(sizes)
    while True:
        left = 1.5 * sum(size.values()) - sum(capped.values())
        free = {s: left * weight[s] / sum(weight[x] for x in size if x not in capped) for s in size if s not in capped}
        over = {s: 2 * size[s] for s in free if free[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
    assert got == pytest.approx({**capped, **free})


def test_substrings(odd, none):
    df, rows = odd
    got = Counter(tuple(r) for r in substrings.remove_repeats(df, block_bytes=50_000).collect())
    assert got == Counter(brute.without_repeats(pairs(rows)))
    whole = substrings.without_repeats(df)
    assert whole.columns == df.columns and whole.count() == len(rows)
    assert substrings.remove_repeats(none).count() == 0


def test_substrings_of_few_words_repeat_in_every_way(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 100), " ".join(rng.choice("ab") for _ in range(rng.choice([0, 3, 10, 40, 150])))) for _ in range(120)]
    for crowd in (substrings.CROWD, 2):
        got = Counter(tuple(r) for r in substrings.remove_repeats(
            spark.createDataFrame(rows, "doc_id long, text string"), least=10, block_bytes=2000, crowd=crowd).collect())
        assert got == Counter(brute.without_repeats(rows, 10))


def test_automaton_finds_the_earliest_place():
    rng = random.Random(4)
    texts = [[rng.randint(0, 2) for _ in range(rng.randint(1, 30))] for _ in range(20)]
    automaton = SuffixAutomaton()
    for d, t in enumerate(texts):
        automaton.add(t, [(d, i) for i in range(len(t))])
    automaton.settle()
    for query in texts + [[rng.randint(0, 3) for _ in range(40)] for _ in range(10)]:
        for end, got in enumerate(automaton.statistics(query, 4)):
            part = query[max(0, end - 3):end + 1]
            places = [(d, i + 3) for d, t in enumerate(texts) for i in range(len(t) - 3) if t[i:i + 4] == part]
            assert got == (min(places) if len(part) == 4 and places else None)


def test_embeddings(spark):
    unit = [1.0, 0.0, 0.0]
    vectors = [unit, unit, [0.99, 0.01, 0.0], None, [], [0.0, 0.0, 0.0], [float("nan"), 1.0, 0.0], [None, 1.0, 0.0],
               [float("inf"), 0.0, 0.0], [1.0], [-1.0, 0.0, 0.0], [1e300, 1e298, 0.0], [1e-300, 0.0, 0.0]]
    rows = list(enumerate(vectors)) + [(1, unit)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", *[F.lit(0).alias(c) for c in ("node", "v", "n", "h1", "component", "bin")])
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df).collect())
    assert got == sorted((k, n, c, k == c) for k, n, c in brute.near_vectors(
        [(k, v and [x / 1e300 if x == 1e300 or x == 1e298 else x * 1e300 if x == 1e-300 else x for x in v]
          if v and None not in v else v) for k, v in rows]))
    nameless = spark.createDataFrame([(None, unit), (5, unit)], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.n_links for r in embeddings.near_vectors(nameless).collect()} == {None: 0, 5: 0}
    assert embeddings.near_vectors(df.where("false")).count() == 0


def test_licenses(odd, none, spark):
    df, rows = odd
    got = licenses.scan(df).collect()
    assert Counter(r.doc_id for r in got) == Counter(k for k, _ in pairs(rows))
    assert all(r.n_base == 0 and r.first_word is None and not r.labels for r in got)
    assert licenses.scan(none).count() == 0
    told = spark.createDataFrame([
        (1, "Under the MIT-license, under THE mit  license"), (2, "x " * 33 + "GNU General Public License, version 3"),
        (3, "CC BY-NC 4.0 and Apache License,\nVersion 2.0"), (4, "submit license")], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(told).collect()}
    assert (found[1].n_base, found[1].first_word, found[1].last_word, found[1].labels) == (2, 0, 4, ["mit"])
    assert found[2].base_labels == [] and found[2].labels == [] and found[4].labels == []
    assert found[3].base_labels == ["apache-2", "cc-by-nc"] and found[3].score == 1.0


def test_licenses_agree_with_sql_on_texts_that_come_near(spark):
    """Neighbours of the templates, parts of them at the threshold, and templates across the ends of blocks."""
    rng = random.Random(6)
    rows = ["released under the apache license version 2 0", "licensed under cc by 4 0",
            "licensed under the gnu general public license version 2", "licensed under cc by nc 4 0"]
    for label, text in licenses.TEMPLATES:
        own = list(dict.fromkeys(licenses.template_words(text)))
        for share in (1, 0.85, 0.8, 0.79, 0.5):
            part = rng.sample(own, round(share * len(own)))
            rows += [" ".join(part), "filler " * rng.randrange(300) + text[:int(share * len(text))] + " end" * rng.randrange(300)]
        rows.append(text.upper() + " gap " * 400 + text)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(rows)))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({oracle.SQL['op9_licenses']}) ORDER BY doc_id").fetchall()
    got = licenses.scan(df).withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")}).select(*names)
    assert sorted(map(tuple, got.collect())) == want
    labels = [r[6] for r in want]
    assert labels[:4] == ["apache-2", "", "", "cc-by-nc"]
    found = [(label, labels[4 + 11 * k + i]) for k, (label, _) in enumerate(licenses.TEMPLATES) for i in (0, 1, 2, 10)]
    assert all(label in have.split(",") for label, have in found)
    assert not any(label in labels[4 + 11 * k + 8].split(",") for k, (label, _) in enumerate(licenses.TEMPLATES))


def test_licenses_search_whole_texts(spark):
    whole = " ".join(f"word{i}" for i in range(300))
    told = [(k, f"{'x ' * k}{whole} y") for k in (0, 1, 150, 299, 431)] + [(1000, whole[:len(whole) // 2])]
    got = licenses.scan(spark.createDataFrame(told, "doc_id long, text string"), templates=(("own", whole),)).collect()
    assert {r.doc_id: (r.labels, r.score) for r in got} == {
        k: (["own"], 1.0) if k < 1000 else ([], 0.0) for k, _ in told}


def test_chats(spark):
    texts = ["</s>[INST] ok [/INST]", "<\\/s>", "[\\\\TURN][TURN]", "", None, "<s", "/s>", "[ROLE]x[/ROLE]", "a\n", "<<s>s>", "\\"]
    rng = random.Random(6)
    rows = [(c, rng.choice([0, 1, 1, 2, None]), rng.choice(["user", "assistant", "system", "[ROLE]</s>", None]), rng.choice(texts))
            for c in [0] * 60 + [1] * 5 + [2, None, None] for _ in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select(
        "*", *[F.lit(0).alias(c) for c in ("t", "turns", "segments", "formatted", "blocks")])
    out = chat.format_chats(df).select("*", chat.read_chats(F.col("formatted")).alias("read"),
                                       chat.loss_text(F.col("segments")).alias("loss")).collect()
    assert len(out) == 4
    for r in out:
        own = sorted([(-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == r.conv_id],
                     key=lambda x: (x[0], x[1].encode(), x[2].encode()))
        assert [(x.role, x.text) for x in r.read] == [(role, text) for _, role, text in own]
        assert r.loss == "".join(text for _, role, text in own if role == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
    assert chat.format_chats(df.where("false")).count() == 0


def test_chats_merge_neighbours_of_one_role(spark):
    df = spark.createDataFrame([(1, 0, "system", "be kind"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c")],
                               "conv_id long, turn long, role string, text string")
    assert chat.format_chats(df).first().formatted == "[ROLE]system[/ROLE]be kind[INST]a[TURN]b[/INST]<s>c</s>"
