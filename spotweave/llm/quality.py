"""Quality rules: text statistics, and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed words and word pairs: one of a trusted target,
one of the raw corpus. A document's score is the mean log ratio of its n-grams, so its length
cancels out; one fixed threshold decides every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm.common import SPACES, free_prefix, intermediates, stored, text_or_empty

#: Symbols that count as such.
SYMBOLS = r"[#*$%&|<>]"
#: Steps in a unit of the log ratio.
SCALE = 1 << 20


def words_of(text: Column) -> Column:
    """Array of the words of a text that isn't null."""
    bare = F.trim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES, -1))


def _statistics(docs: DataFrame, text: str, words: str) -> dict[str, Column]:
    """Columns of the base rules, from a text that isn't null and its array of words."""
    t, w = F.col(text), F.col(words)
    n = F.size(w)
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.when(t.rlike(SYMBOLS), F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).otherwise(0).cast("long"),
        "n_dup_lines": F.when(F.instr(t, "\n") > 0, F.size(lines) - F.size(F.array_distinct(lines))).otherwise(0).cast("long"),
    }


def _windows(words: Column, width: int) -> Column:
    """64-bit hash of each run of ``width`` words."""
    return F.when(
        F.size(words) >= width,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - width),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def base_rules(docs: DataFrame, text_col: str = "text", width: int = 5) -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and ``base_failed``.

    Repeated words: the windows of ``width`` words are sorted by hash, then place; those equal
    to a neighbour are repeated. Their places, sorted, each cover the words up to the next
    place, ``width`` at most. Only texts with a repeated window are sorted.
    """
    step = docs.withColumn("_text", text_or_empty(text_col)).withColumn("_words", words_of(F.col("_text")))
    step = step.withColumns(_statistics(step, "_text", "_words")).withColumn("_windows", _windows(F.col("_words"), width)).drop("_words")
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    step = step.withColumn("_order", F.when(some, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    order = F.col("_order")
    alike = F.transform(
        order, lambda x, i: F.when((F.get(order, i - 1)["h"] == x["h"]) | (F.get(order, i + 1)["h"] == x["h"]), x["i"])
    )
    step = step.withColumn("_places", F.sort_array(F.array_compact(alike))).drop("_order", "_windows", "_text")
    places = F.col("_places")
    spans = F.transform(places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(width)), F.lit(width)))
    return (
        step.withColumn("n_repeat_words", F.coalesce(F.aggregate(spans, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
        .drop("_places")
    )


def gram_rows(docs: DataFrame, keep: list[str], text: str, buckets: int) -> DataFrame:
    """A row for each n-gram of each text: columns ``keep`` and ``bucket`` (int).

    N-grams are words, pairs of neighbouring words, and the last two characters of words.
    """
    words = words_of(F.col(text))
    pairs = docs.select(*keep, words.alias("_w")).select(*keep, F.explode(F.arrays_zip(F.col("_w").alias("a"), F.slice("_w", 2, 1 << 30).alias("b"))).alias("z"))
    a, b = F.col("z.a"), F.col("z.b")
    hashes = [F.xxhash64(a), F.xxhash64(F.lit(2), F.right(a, F.lit(2))), F.when(b.isNotNull(), F.xxhash64(a, b))]
    found = F.explode(F.array(*[F.pmod(h, F.lit(buckets)).cast("int") for h in hashes]))
    return pairs.select(*keep, found.alias("bucket")).filter("bucket is not null")


def log_ratios(
    spark: SparkSession,
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int = 10_000,
    trusted_limit: int = 20_000,
    smoothing: float = 1.0,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per bucket: ``bucket``, ``raw``, ``target`` (counts), ``ratio``.

    Raw counts are of all of ``docs``. The target is fitted on those of them whose id is among
    ``trusted`` (column ``doc_id``), of which at most ``trusted_limit`` are used, in the order
    of a hash; so they can be broadcast.
    ``ratio`` is log(target share / raw share), both with ``smoothing`` added to each count.
    Every bucket has a row, also over an empty table.
    """
    order = F.md5(F.col("_trusted").cast("string"))
    ids = trusted.select(F.col("doc_id").alias("_trusted")).filter("_trusted is not null").distinct().orderBy(order).limit(trusted_limit)
    flagged = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")).join(
        F.broadcast(ids), F.col("_id") == F.col("_trusted"), "left"
    )
    flagged = flagged.select(F.col("_trusted").isNotNull().cast("int").alias("t"), "_text")
    counts = gram_rows(flagged, ["t"], "_text", buckets).groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("t").alias("target"))
    counts = stored(spark, counts, "quality-counts")  # from here on a row for each bucket, whatever the input
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").fillna(0, ["raw", "target"])
    sums = full.agg(F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"))
    extra = smoothing * buckets
    share = lambda x, total: (F.col(x) + smoothing) / (F.col(total) + extra)
    return full.join(F.broadcast(sums)).select(
        "bucket", "raw", "target", F.log(share("target", "all_target") / share("raw", "all_raw")).alias("ratio")
    )


def quality(
    spark: SparkSession,
    docs: DataFrame,
    trusted: DataFrame,
    threshold: float = -0.35,
    buckets: int = 10_000,
    trusted_limit: int = 20_000,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """``docs`` with the base statistics, ``llr_score`` (double), ``base_failed`` and ``kept``.

    ``kept`` is false for documents that fail the base rules and else says whether
    ``llr_score >= threshold``. Where nothing is trusted the ratio decides nothing. A null or
    empty text has no words and fails. Repeated rows are each judged; columns of these names
    in ``docs`` are replaced. An empty table gives an empty table.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr_score", "kept"]
    docs = docs.drop(*made)
    text, name = text_or_empty(text_col), F.coalesce(F.col(id_col).cast("string"), F.lit("\x00null"))
    k1, k2 = (f"{free_prefix(docs, '_quality')}k{i}" for i in (1, 2))
    keyed = docs.withColumns({k1: F.xxhash64(name, text), k2: F.xxhash64(text, name)})
    own = docs.select(F.xxhash64(name, text).alias("_k1"), F.xxhash64(text, name).alias("_k2"), text.alias("_text"))
    with intermediates(spark, keep=1):
        model = log_ratios(spark, docs, trusted, buckets, trusted_limit, text_col=text_col, id_col=id_col)
        model = stored(spark, model, "quality-ratios")  # as many rows as buckets
        some = model.agg((F.coalesce(F.sum("target"), F.lit(0)) > 0).alias("some"))
        # fixed point: a sum of longs is the same in whatever order rows arrive
        points = F.when(F.col("some"), F.round(F.col("ratio") * SCALE)).otherwise(0).cast("long")
        ratios = model.join(F.broadcast(some)).select("bucket", points.alias("points"))
        grams = gram_rows(own, ["_k1", "_k2"], "_text", buckets)
        mean = F.sum("points") / (F.count("*") * F.lit(float(SCALE)))
        scores = grams.join(F.broadcast(ratios), "bucket").groupBy("_k1", "_k2").agg(mean.alias("llr_score"))
        judged = base_rules(own, "_text").drop("_text").join(scores, ["_k1", "_k2"], "left")
        judged = judged.withColumn("llr_score", F.coalesce("llr_score", F.lit(0.0)))
        # stored, for a filter on the verdict would else be pushed into the statistics and evaluate them again and again
        judged = stored(spark, judged.dropDuplicates(["_k1", "_k2"]), "quality-verdicts")
    return (
        keyed.join(judged.withColumnsRenamed({"_k1": k1, "_k2": k2}), [k1, k2])
        .drop(k1, k2)
        .withColumn("kept", ~F.col("base_failed") & (F.col("llr_score") >= threshold))
    )
