"""Spelling variants: words one edit apart, by asymmetric chunks.

Of two words that may be one edit apart, the one that isn't shorter (of length L) contributes two disjoint
chunks, its first and its last ``L // 2`` code points; the other contributes the positional grams that
such a chunk can be equal to. One edit touches at most one of two disjoint chunks, so one of them stands in
the other word, at its place or, behind a left-out letter, shifted by one; the lengths tell which, so
a word has four grams: for partners of its length and for partners one longer, at either end.

Short chunks crowd, so the rest of the word, which holds the edit, is cut into two chunks in the
same way, and a key is a chunk with a chunk of the rest: three quarters of a word. A pair that shares
several keys is taken at the first. What shares a key is verified on whole words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm.common import intermediates, stored

#: Maximal runs of these characters are words.
LETTERS = "A-Za-zÀ-ÿ"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def occurrences(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``word`` for each run of ``least`` letters or more, A-Z lowered; null texts have none."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least},}}+"), F.lit(0))
    found = docs.select(F.col(id_col).alias("doc_id"), F.explode(runs).alias("run"))
    return found.select("doc_id", F.translate("run", _CAPITALS, _CAPITALS.lower()).alias("word"))


def with_slips(words: DataFrame, every: int) -> DataFrame:
    """Occurrences of which one in ``every`` loses a code point, chosen by the crc32 of ``doc_id:word`` (a null id is empty)."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = (h % F.length("word")).cast("int")
    cut = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
    return words.select("doc_id", F.when(h % every == 0, cut).otherwise(F.col("word")).alias("word"))


def _parts(word: Column, long: Column) -> list[tuple[Column, Column]]:
    """The keys of a word for a longer word of ``long`` code points: a chunk at one end, and a chunk at one end of the rest."""
    size = F.length(word)
    q = F.floor(long / 2).cast("int")
    r = F.floor((long - q) / 2).cast("int")
    ends = lambda w, k: (F.substr(w, F.lit(1), k), F.substr(w, F.length(w) - k + 1, k))
    rests = F.substr(word, q + 1), F.substr(word, F.lit(1), size - q)
    return [(chunk, part) for chunk, rest in zip(ends(word, q), rests, strict=True) for part in ends(rest, r)]


def _keyed(words: DataFrame, word: str, n: str, longer: tuple[int, ...]) -> DataFrame:
    """A row for each key: ``key`` (a hash; what meets is verified), ``kind``, the word and its count."""
    size = F.length("word")
    keys = [
        F.struct(F.lit(k).alias("kind"), F.xxhash64(F.lit(k), size + more, chunk, part).alias("key"))
        for more in longer
        for k, (chunk, part) in enumerate(_parts(F.col("word"), size + more))
    ]
    return words.select(F.col("word").alias(word), F.col("n").alias(n), F.explode(F.array(*keys)).alias("k")).select(word, n, "k.*")


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair of words one inserted, deleted or replaced code point apart, once: ``a``, ``a_n``, ``b``, ``b_n``.

    ``words`` has distinct words ``word`` of at least four code points and their counts ``n``. Keys hold
    three quarters of a word, so even in a large vocabulary few words share one; a crowded key is an
    ordinary join key, which adaptive execution splits. Neither side is broadcast: by the size of the stored words
    Spark would, though their keys are four rows of each or more, and the driver would hold them.
    """
    a, b = _keyed(words, "a", "a_n", (0,)), _keyed(words, "b", "b_n", (0, 1))
    met = a.hint("merge").join(b, ["kind", "key"])
    met = met.filter((F.length("a") > F.length("b")) | (F.col("a") < F.col("b"))).filter(F.levenshtein("a", "b", 1) == 1)
    shared = [(x[0] == y[0]) & (x[1] == y[1]) for x, y in zip(_parts(F.col("a"), F.length("a")), _parts(F.col("b"), F.length("a")), strict=True)]
    first = F.lit(len(shared))
    for k in range(len(shared) - 1, -1, -1):
        first = F.when(shared[k], k).otherwise(first)
    return met.filter(F.col("kind") == first).select("a", "a_n", "b", "b_n")


def variants(spark: SparkSession, words: DataFrame, ratio: int = 10) -> DataFrame:
    """A row for each of ``words`` (distinct ``word``, count ``n``): ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    ``n_near`` words are one edit away. ``form`` is the one of them with the largest count (ties: smallest in
    code-point order) if it has at least ``ratio`` (2 or more) times this word's count, else null. ``root``: where forms
    of forms end, the word itself if it has none. Words shorter than four code points may miss neighbours,
    so they aren't allowed. No words give no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, else forms could go in circles")
    with intermediates(spark, keep=1):
        words = stored(spark, words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
        pairs = near_pairs(words)
        both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("m"))))
        near = pairs.select(both.alias("p")).select("p.*").groupBy("word")
        near = near.agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
        good = -F.col("best.m") >= ratio * F.col("n")
        found = words.join(near.hint("merge"), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.m")).alias("form_n")
        )
        found = stored(spark, found, "spelling-forms")
        return stored(spark, _with_roots(spark, found, ratio), "spelling-result")


def _with_roots(spark: SparkSession, found: DataFrame, ratio: int) -> DataFrame:
    """Pointer jumping; counts grow by ``ratio`` with each form, so the largest count bounds the steps. Links, as many as words at most, aren't broadcast."""
    top = found.agg(F.max("form_n").alias("m"), F.min("n").alias("n")).first()
    steps = math.floor(math.log(max(top["m"] / max(top["n"], 1), 1), ratio) + 1e-9) if top["m"] else 0
    links = found.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("end"))
        links = stored(spark, links.join(further.hint("merge"), "root", "left").select("word", F.coalesce("end", "root").alias("root")), "spelling-roots")
    return found.join(links.hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))
