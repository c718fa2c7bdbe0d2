"""Spelling variants against comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from spotweave.llm import queries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        near = [(-m, v) for v, m in counts.items() if one_apart(w, v)]
        best = min(near, default=None)
        good = best is not None and -best[0] >= ratio * n
        out[w] = [n, len(near), best[1] if good else None, -best[0] if good else None]
    for w in out:
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        out[w] = (*out[w][:4], root)
    return out


def rows_of(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


@pytest.mark.parametrize("ratio", [2, 10])
def test_variants_against_all_pairs(spark, ratio):
    rng = random.Random(4)
    letters = "abcé÷ÿ"
    words = {"".join(rng.choices(letters, k=rng.randint(7, 12))) for _ in range(150)}
    for w in list(words):
        for _ in range(4):
            i, how = rng.randrange(len(w)), rng.randrange(3)
            words.add(w[:i] + rng.choice(letters) * (how != 0) + w[i + (how != 1) :])
    words |= {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "ababababa"}
    counts = {w: rng.choice([2, 3, 20, 21, 30, 250, 3000, 40_000]) for w in words if len(w) >= 7}
    table = spark.createDataFrame(list(counts.items()), "word string, n long").withColumns({"a": F.lit(1), "key": F.lit("x"), "root": F.lit(2)})
    found = rows_of(spelling.variants(spark, table, ratio))
    assert found == brute(counts, ratio)
    assert sum(x[2] is not None for x in found.values()) > 50 and any(x[4] != x[2] for w, x in found.items() if x[2])


def test_pairs_come_once(spark):
    words = ["abcdefgh", "abcdefgx", "xbcdefgh", "abcxdefgh", "abcdxefgh", "abcdegh", "aaaaaaa", "aaaaaaaa"]
    found = [tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()]
    assert sorted(found) == sorted((min(a, b), max(a, b)) for i, a in enumerate(words) for b in words[i + 1 :] if one_apart(a, b))


def test_words_are_not_broadcast(spark, monkeypatch):
    """A stored table of words looks small, but its keys aren't; no join of words hands one to the driver."""
    words = ["abcdefgh", "abcdefgx", "xbcdefgh", "abcxdefgh"]
    plans, keep = [], spelling.stored
    table = keep(spark, spark.createDataFrame([(w, 30**k) for k, w in enumerate(words)], "word string, n long"), "words")

    def planned(spark, df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(spark, df, label)

    monkeypatch.setattr(spelling, "stored", planned)
    assert "Broadcast" not in spelling.near_pairs(table)._jdf.queryExecution().executedPlan().toString()
    assert rows_of(spelling.variants(spark, table)) == brute({w: 30**k for k, w in enumerate(words)})
    assert len(plans) >= 4 and not [p for p in plans if "Broadcast" in p]


def corpus():
    rng = random.Random(6)
    base = ["".join(rng.choices("abcdefghiéü", k=rng.randint(5, 11))) for _ in range(120)]
    rows = [(i, " ".join(rng.choices(base, weights=[1 / (k + 1) for k in range(120)], k=rng.randint(1, 600)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "ONE Überraschung, Überraschung; UBERRASCHUNG überraschung 12345678 a×b÷cdefgh"), (63, "z" * 5_000_000), (63, "Wörterbuch-Wörterbuch_wörterbuch")]
    return [*rows, (None, "nothing nothing Nothing"), (5, rows[5][1]), (5, rows[5][1])]


def test_occurrences_and_slips(spark):
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in corpus()], "doc_id long, text string, word string, n int").repartition(3)
    words = spelling.with_slips(spelling.occurrences(docs, 7), 31).filter(F.length("word") >= 7)
    found = {r.word: r.n for r in words.groupBy("word").agg(F.count("*").alias("n")).collect()}
    want = Counter()
    for i, t in corpus():
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                want[w] += 1
    assert found == want


def test_no_words(spark):
    assert spelling.variants(spark, spark.createDataFrame([], "word string, n long")).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spark, spark.createDataFrame([], "word string, n long"), 1)


def test_query_equals_sql_and_all_pairs(spark):
    place = "/root/testdata/sf0.001"
    found = rows_of(queries.op12_spelling(spark, place))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{place}/documents.parquet'")
    assert found == {w: (n, near, form, m, root) for w, n, near, form, m, root in db.execute(queries.SPELLING_SQL).fetchall()}
    short = {w: x[0] for w, x in found.items() if len(w) < 9}
    assert {w: x[1] for w, x in brute(short).items() if len(w) < 8} == {w: x[1] for w, x in found.items() if len(w) < 8}
