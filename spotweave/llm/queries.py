"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm import conversations, embeddings, fingerprints, language, mixing, neardup, packing, quality, secrets, sharding, spelling, suffix_dedup, tokens
from spotweave.llm.common import documents, scratch_path, text_or_empty


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of repeated strings of 400 bytes from all documents."""
    found = suffix_dedup.repeated_spans(spark, documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "has_repeats")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents; a source is an owner, a source and language a repository."""
    found = secrets.scan(spark, documents(spark, sf_dir).select("doc_id", "text", "lang", "source")).drop("text")
    rank = {k: F.expr(f"size(filter(secret_spans, s -> s.rank = {r}))").cast("long") for r, k in enumerate(secrets.KINDS)}
    base = F.filter("secret_spans", lambda s: s["rank"] < len(secrets.BASE))
    return found.select(
        "doc_id",
        *[rank[k].alias(f"n_{k}") for k in secrets.KINDS],
        F.size(F.filter("secret_spans", lambda s: ~s["live"])).cast("long").alias("n_widely_copied"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("secret_spans")).alias("spans"),
    )


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: five words, similarity 0.85 or more."""
    return neardup.near_duplicates(spark, documents(spark, sf_dir).select("doc_id", "text"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences of at most 4096."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return packing.pack_documents(spark, docs, tokenizer_path("word_bpe_49k.json"))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, through a cache that this query starts empty."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = tokens.count_tokens(spark, docs, tokenizer_path("byte_bpe_50k.json"), scratch_path(spark, "token-cache"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digests of all documents and their edited texts."""
    found = fingerprints.edited_pairs(spark, documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, replicated by source to target shares that follow the square root of the source's size."""
    return mixing.mix(spark, documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards, counts at most one apart (law ``rows``)."""
    text = text_or_empty()
    docs = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = sharding.shard_rows(spark, docs, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learnt from those that aren't held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", language.held_out())
    models = language.train(spark, docs.filter(~F.col("held_out")))
    found = language.identify(spark, docs.select("doc_id", "text", "held_out"), models)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), "lang_rejected", "lang_bits")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by the base rules and the log-likelihood ratio; trusted are those labelled good and not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trusted = labels.filter("quality = 1 and toxic = 0").select("doc_id")
    found = quality.quality(spark, documents(spark, sf_dir), trusted)
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr_score"
    )


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repairs of all conversations after damage."""
    rows = conversations.named(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    found = conversations.repairs(spark, conversations.damaged(rows), rows)
    return found.withColumnRenamed("conv", "conv_id")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, one occurrence in 31 of them with a letter left out."""
    words = spelling.with_slips(spelling.occurrences(documents(spark, sf_dir), 7), 31).filter(F.length("word") >= 7)
    counts = words.groupBy("word").agg(F.count("*").alias("n")).filter("n >= 2")
    return spelling.variants(spark, counts).select("word", "n", "n_near", "form", "form_n", "root")


def op13_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of all embeddings: cosine 0.95 or more."""
    return embeddings.near_vectors(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: Near-duplicates by counting shared shingles of all pairs and closing the links transitively.
NEARDUP_SQL = r"""
WITH RECURSIVE w AS (
 SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))
 WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w) z),
n AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.k + y.k - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.k, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.doc_id = d.doc_id
"""

#: Poisson counts by stepping through the distribution function of each source; rates above 500 as sums of parts.
MIXING_SQL = """
WITH RECURSIVE g AS (SELECT coalesce(source, concat(chr(0), 'null')) AS grp, count(*) AS n FROM documents GROUP BY 1),
t AS (SELECT sum(n) AS an, sum(power(n, 0.5)) AS aw FROM g),
w AS (SELECT grp, 1.0 * an * power(n, 0.5) / aw / n AS whole FROM g, t),
rt AS (SELECT grp, CASE WHEN whole <= 500 THEN 1 ELSE CAST(ceil(whole / 256) AS INT) END AS parts, whole / (CASE WHEN whole <= 500 THEN 1 ELSE CAST(ceil(whole / 256) AS INT) END) AS rate FROM w),
cdf AS (SELECT grp, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rt
 UNION ALL SELECT grp, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf WHERE k < CAST(floor(rate + 9 * sqrt(rate + 1) + 24) AS INT)),
s AS (SELECT doc_id, rt.grp, unnest(range(1, parts + 1)) AS j FROM documents d JOIN rt ON coalesce(d.source, concat(chr(0), 'null')) = rt.grp),
u AS (SELECT doc_id, grp,
 CAST(concat('0x', substr(md5(CASE WHEN j = 1 THEN concat('mix-1', chr(31), CAST(doc_id AS VARCHAR)) ELSE concat('mix-1/part', chr(31), CAST(doc_id AS VARCHAR), chr(31), CAST(j AS VARCHAR)) END), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u FROM s),
k AS (SELECT doc_id, count(*) FILTER (c <= u) AS mix_copies FROM u JOIN cdf ON u.grp = cdf.grp GROUP BY doc_id),
e AS (SELECT doc_id, mix_copies, unnest(range(0, mix_copies)) AS mix_copy FROM k)
SELECT d.*, mix_copies, mix_copy, md5(concat('mix-1', chr(31), CAST(d.doc_id AS VARCHAR), chr(31), CAST(mix_copy AS VARCHAR))) AS mix_key
FROM documents d JOIN e ON d.doc_id = e.doc_id
"""

#: Spelling variants by all one-letter deletions of each word; crc32 by its table.
SPELLING_SQL = """
WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS tab FROM (
 SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)) z),
o AS (SELECT doc_id, w, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents) z
 WHERE length(w) >= 7 GROUP BY 1, 2),
x AS (SELECT *, hex(encode(concat(doc_id, ':', w))) AS hx FROM o),
b AS (SELECT w, k, list_transform(range(length(hx) // 2), lambda i: CAST(concat('0x', substr(hx, 2 * i + 1, 2)) AS BIGINT)) AS bytes FROM x),
h AS (SELECT w, k, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, y: xor(c >> 8, tab[(xor(c, y) & 255) + 1])), 4294967295) AS h FROM b, crc),
e AS (SELECT CASE WHEN h % 31 = 0 THEN concat(substr(w, 1, h % length(w)), substr(w, h % length(w) + 2)) ELSE w END AS word, k FROM h),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM e WHERE length(word) >= 7 GROUP BY 1 HAVING sum(k) >= 2),
d AS (SELECT word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v) z),
near AS (SELECT a.word, b.word AS near, b.n AS m FROM d a JOIN d b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
 UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.cut = v.word UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.cut = v.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY 1),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * v.n THEN m END AS form_n FROM v LEFT JOIN best ON v.word = best.word),
g AS (SELECT f.*, (SELECT min(near) FROM near WHERE near.word = f.word AND near.m = f.form_n) AS form FROM f),
r AS (SELECT word, word AS root FROM g UNION ALL SELECT r.word, g.form FROM r JOIN g ON g.word = r.root WHERE g.form IS NOT NULL),
l AS (SELECT r.word, r.root FROM r JOIN g ON g.word = r.root WHERE g.form IS NULL)
SELECT g.word, n, n_near, form, form_n, root FROM g JOIN l ON g.word = l.word
"""

#: Near vectors by all pairs.
EMBEDDING_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
g AS (SELECT vec_id, v FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(v, lambda x: abs(x))) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
c AS (SELECT a, count(*) AS n FROM l GROUP BY 1),
r AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM e LEFT JOIN c ON c.a = e.vec_id JOIN m ON m.vec_id = e.vec_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to query."""
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_secrets": op2_secrets,
        "op3_neardup": op3_neardup,
        "op4_packing": op4_packing,
        "op7_tokens": op7_tokens,
        "op5_fingerprints": op5_fingerprints,
        "op6_mixing": op6_mixing,
        "op8_sharding": op8_sharding,
        "op9_language": op9_language,
        "op10_quality": op10_quality,
        "op11_conversations": op11_conversations,
        "op12_spelling": op12_spelling,
        "op13_embeddings": op13_embeddings,
    }


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL, where SQL can express the query.

    SQL has no tokenizer, no xxhash and no code point places of matches; the other queries are
    tested against brute force.
    """
    return {"op3_neardup": NEARDUP_SQL, "op6_mixing": MIXING_SQL, "op12_spelling": SPELLING_SQL, "op13_embeddings": EMBEDDING_SQL}
