"""Packing: ids as the library gives them, sequences without gaps, and plans that fill their bins."""

import itertools
import json
import os
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers

import __spark_entry__
from ensemblescore.llm import encoding, packing

WORDS = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(WORDS)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, want, capacity):
    """Pieces of each document in order, whole sequences, and every document once."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    expected = defaultdict(list)
    for key, ids in want:
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            expected[key].append((k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {k: Counter(v) for k, v in pieces.items()} == {k: Counter(v) for k, v in expected.items()}
    return len(sequences)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_query(spark, library):
    rows = __spark_entry__.queries()["op13_packing"](spark, SF).collect()
    want = [(r.doc_id, ids_of(library, r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    total = sum(len(ids) for _, ids in want)
    assert check(rows, want, 4096) == -(-total // 4096)  # no fewer could do


def test_odd_documents(spark, library):
    long = " ".join(random.Random(1).choice(["alpha", "Beta", "é", "日本", "x1y"]) for _ in range(3000))
    texts = [None, "", " ", "\n\t", "one", "one", long, long, "don't <|endoftext|>stop<|startoftext|> J̌'s", "a" * 3000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "null key"), (4, "one"), (4, "one"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS length", "2 AS part", "3 AS c", "map(1, 2) AS m").toDF("doc_id", "text", "length", "part", "a.b", "a.b")
    packed = packing.pack(df, WORDS, capacity=64).cache()
    digests = packed.withColumn("ids_crc32", packing.ids_crc32(packed["ids"])).collect()
    check(digests, [(k, ids_of(library, t)) for k, t in rows], 64)
    whole = packing.sequences(packed).collect()
    assert all(len(r.ids) <= 64 for r in whole)
    assert sum(len(r.ids) for r in whole) == sum(len(ids_of(library, t)) for _, t in rows)
    empty = packing.pack(df.where("false"), WORDS)
    assert empty.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"] and empty.isEmpty()


def test_words_give_the_ids_of_whole_texts(library, monkeypatch):
    """Over texts made to upset it, and a memory that is forgotten all the time."""
    rng = random.Random(3)
    parts = ["a", "B", "é", "J̌", "é", " ", "  ", "\n", "'s", "'", "'ll", "\"", "...", "1", "23", "½", "²", "日本", "—",
             "…", "<|endoftext|>", "<|", "|>", "<|ENDOFTEXT|>", "=", "̸", "İ", "Σ", " ", " ", "\x1c", "\x85", "$%",
             "_", "-", "<|startoftext|>", "x" * 50, "\x00", "ẞ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    monkeypatch.setattr(encoding, "MOST_KNOWN", 500)
    encoder = encoding.TextEncoder(WORDS)
    for lo in range(0, len(texts), 400):
        some = texts[lo:lo + 400]
        ids, offsets = encoder.encode(pa.array(some, pa.large_string()), 1)
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(offsets)] == [ids_of(library, t) for t in some]
    assert encoder.by_words
    other = encoding.TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    ids, offsets = other.encode(pa.array(["a  b\n c", "", "x"], pa.large_string()), 1)
    whole = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_words
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(offsets)] == [ids_of(whole, t) for t in ("a  b\n c", "", "x")]


def test_plain_words_skip_normalizer_and_pattern(library, monkeypatch):
    """Every letter below U+0250 alone, beside others and before marks; the whole tokenizer sees only the marked ones."""
    rng = random.Random(4)
    letters = [c for c in map(chr, range(0x250)) if c.isalpha() and c != "\u0130"]
    plain = letters + ["".join(rng.choices(["a", "B", "\xe9", rng.choice(letters)], k=rng.randint(1, 40))) for _ in range(3000)]
    others = ["\u0130", "a\u0130", "J\u030c", "e\u0301a", "\u03a3\u03b1\u03c2", "\u65e5\u672c", "\u212a", "a<|endoftext|>b"]
    seen, ids_before = [], encoding.TextEncoder._ids

    def ids_seen(self, texts, *model):
        seen.extend(() if model else texts)
        return ids_before(self, texts, *model)

    monkeypatch.setattr(encoding.TextEncoder, "_ids", ids_seen)
    encoder = encoding.TextEncoder(WORDS)
    for texts in (plain, [" ".join(plain), *others, " ".join([*plain[:600], *others])], []):
        ids, offsets = encoder.encode(pa.array(texts, pa.large_string()), 1)
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(offsets)] == [ids_of(library, t) for t in texts]
    assert {w for text in seen for w in text.split(encoder.parting)} == {*others, ""}


def test_plain_letters_need_marked_ends():
    rules = json.loads(Path(WORDS).read_text(encoding="utf-8"))
    alphabet = tokenizers.pre_tokenizers.ByteLevel.alphabet()
    assert set("azAZ") <= set(encoding.plain_letters(rules, str.lower, alphabet))
    assert set("az") < set(encoding.plain_letters(rules, str, alphabet)) and "A" not in encoding.plain_letters(rules, str, alphabet)
    bpe, lacking = rules["model"], dict(rules["model"]["vocab"])
    del lacking["q</w>"]
    letters_only = [*rules["added_tokens"], rules["added_tokens"][0] | {"content": "stop"}]
    for other in ({"model": bpe | {"end_of_word_suffix": None}}, {"model": bpe | {"ignore_merges": True}},
                  {"model": bpe | {"vocab": lacking}}, {"added_tokens": letters_only}):
        assert encoding.plain_letters(rules | other, str.lower, alphabet) == ""


def test_fullest_is_the_best_of_all_combinations():
    rng = random.Random(2)
    for _ in range(200):
        left = {length: rng.randint(1, 3) for length in rng.sample(range(1, 30), rng.randint(1, 5))}
        free = rng.randint(0, 40)
        chosen = packing.fullest(sorted(left, reverse=True), left, free)
        assert all(n <= left[length] for length, n in chosen)
        got = sum(length * n for length, n in chosen)
        sums = {sum(c) for c in itertools.product(*[[length * n for n in range(m + 1)] for length, m in left.items()])}
        assert got == max(s for s in sums if s <= free)


def test_plans_use_every_piece_once_and_few_bins():
    rng = random.Random(5)
    for lengths in ([rng.randint(1, 4096) for _ in range(3000)], [4096] * 50, [2049] * 7, [1] * 10_000,
                    [min(4096, int(rng.lognormvariate(6.3, 1)) + 1) for _ in range(20_000)], []):
        counts = Counter(lengths)
        plan = packing.minimum_bin_slack(counts)
        used = Counter()
        for bins, chosen in plan:
            assert bins > 0 and sum(length * n for length, n in chosen) <= 4096
            for length, n in chosen:
                used[length] += bins * n
        assert used == counts
        least = max(-(-sum(lengths) // 4096), sum(n for length, n in counts.items() if length > 2048))
        assert sum(bins for bins, _ in plan) <= least + max(1, least // 50)
