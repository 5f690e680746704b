"""Source divergence: frequencies from runs of any size, and every pair against brute force."""

import random
import re
from collections import Counter

import pytest

from ensemblescore.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, min_docs=10, top=10):
    docs = [(lang or "", source or "", TERM.findall(lower(text))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= min_docs) for s in {d[1] for d in mine}}
        whole = sum(counts.values(), Counter())

        def share(c, t):
            return 1 + 10 ** 9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for s, c in counts.items():
            pairs = [(o, sum(f(share(c, t), share(d, t)) for t in kept)) for o, d in counts.items() if o != s]
            terms = [(t, f(share(c, t), share(whole, t))) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda r: (-r[1], r[0].encode()))
                for rank, (item, value) in enumerate(found[:top] if part == "term" else found, 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("ka", "Ré", "日", "tsch", "x") for b in ("lo", "MI", "ß", "", "nu")]
    rows = []
    for i in range(400):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "B", "é", None, "hot", "hot", "hot"])
        shift = sum(map(ord, source or "")) % 7
        rows.append((i, " ,".join(words[(rng.randrange(12) * (1 + shift % 3) + shift) % len(words)]
                                  for _ in range(rng.randrange(40))), lang, source))
    rows += [rows[3]] * 30 + [(500, None, "en", "only null"), (501, "", "xx", "a"), (502, "one 1 two", "xx", "b"),
                              (503, "lone", "yy", "z"), (None, "ka " * 20_000, "en", "long"), (504, "k" * 100_000, "en", "a")]
    return rows


def test_every_value_is_that_of_brute_force(spark, corpus):
    df = spark.createDataFrame(corpus, SCHEMA).repartition(4)
    assert got(divergence.audit(df)) == brute(corpus)
    assert got(divergence.audit(df, min_docs=1, top=3)) == brute(corpus, 1, 3)


def test_a_hundred_runs_give_what_one_gives(spark, corpus, monkeypatch):
    import pyarrow as pa
    table = pa.table({"lang": [r[2] or "" for r in corpus], "source": [r[3] or "" for r in corpus],
                      "text": [r[1] or "" for r in corpus]})
    whole = list(divergence._runs(iter(table.to_batches())))
    monkeypatch.setattr(divergence, "MOST_POSTINGS", 5)
    parts = list(divergence._runs(iter(table.to_batches(max_chunksize=3))))
    assert len(parts) > 100 > len(whole)

    def added(batches):
        sums = Counter()
        for b in batches:
            rows = b.to_pylist()
            assert rows == sorted(rows, key=lambda r: (r["lang"], r["term"].encode(), r["source"].encode()))
            for r in rows:
                sums[r["lang"], r["term"], r["source"]] += complex(r["docs"], r["n"])
        return sums

    assert added(parts) == added(whole)
    ordered = pa.Table.from_batches(parts).sort_by([(c, "ascending") for c in ("lang", "term", "source")])
    for size in (1, 2, 7, 10_000):
        merged = list(divergence._whole_terms(iter(ordered.to_batches(max_chunksize=size)), divergence._added_up))
        assert added(b for t in merged for b in t.to_batches()) == added(whole)
        keys = [{(r["lang"], r["term"]) for r in t.to_pylist()} for t in merged]
        assert sum(map(len, keys)) == len(set().union(*keys))  # no term is parted


def test_odd_tables(spark, corpus):
    df = spark.createDataFrame(corpus, SCHEMA)
    clash = df.selectExpr("*", "1 AS term", "2 AS n", "3 AS docs", "map(1, 2) AS m").toDF(
        "doc_id", "text", "lang", "source", "term", "n", "a.b", "a.b")
    assert got(divergence.audit(clash)) == brute(corpus)
    empty = divergence.audit(df.where("false"))
    assert empty.columns == ["lang", "source", "part", "item", "value", "rank"] and empty.isEmpty()
    nothing = spark.createDataFrame([(1, None, None, None), (2, "!!", None, "s")], SCHEMA)
    assert got(divergence.audit(nothing)) == [("", "", "pair", "s", 0, 1), ("", "s", "pair", "", 0, 1)]


def test_shares_are_exact_for_large_counts():
    import numpy as np
    rng = random.Random(1)
    n = np.array([rng.randrange(10 ** rng.randrange(1, 13)) for _ in range(500)])
    total = n + np.array([4 + rng.randrange(10 ** rng.randrange(1, 13)) for _ in range(500)])
    assert divergence._share(n, total).tolist() == [1 + 10 ** 9 * (int(a) + 2) // int(b) for a, b in zip(n, total)]
