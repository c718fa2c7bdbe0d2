"""Secret scans with corpus-wide ownership frequency.

Fixed patterns give the base spans. A wider pattern gives further candidates, which count only
by who holds them: the hash of every candidate value is aggregated over the whole corpus by
distinct repositories and owners. A value that several owners hold, or many repositories of one
owner, is a widely copied example; one that a single owner holds in few repositories and that
looks random is a live-looking credential of its own.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm.common import free_prefix, stored, text_or_empty

#: Patterns: kind, expression, group of the value, least length of the value. In the order of kinds.
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]
#: The same matches of at least the least length, where that can be asked for within the expression: the runs are maximal, so no other match appears.
_QUICK = {"assign": BASE[0][1], "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
#: Whether a text can hold a match at all.
_GATE = {"assign": r"(?i:password|passwd|secret|token|api_?key)", "access": "AKIA", "hex": r"[0-9a-f]{16}"}
#: Further candidates: runs of 20 characters or more with a digit, a capital and a small letter.
WIDE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9A-Z+/_=-]*[a-z])(?=[0-9a-z+/_=-]*[A-Z])[A-Za-z0-9+/_=-]{20,}+"
_WIDE_GATE = r"[A-Za-z0-9+/_=-]{20}"
#: Order of kinds at equal starts.
KINDS = ["assign", "access", "hex", "live"]


#: Matches whose places are counted from one start.
_STRETCH = 256


def _held(value: Column, use) -> Column:
    """``use`` of a value that is computed once: inside a lambda any other expression is computed for every element."""
    return F.get(F.transform(F.array(value), use), 0)


def _stretches(array: Column) -> Column:
    """Numbers of the stretches of an array that isn't empty."""
    return F.sequence(F.lit(0), F.floor((F.size(array) - 1) / _STRETCH).cast("int"))


def _running(values: Column, join) -> Column:
    """Running sums or maxima (``join`` of two whole numbers from 0 up) of an array: of whole stretches first, then inside each."""
    zero, stretch = F.lit(0), lambda i: F.floor(i / _STRETCH).cast("int")
    whole = F.transform(_stretches(values), lambda b: F.aggregate(F.slice(values, b * _STRETCH + 1, _STRETCH), zero, join))
    bases = F.aggregate(whole, F.array(zero), lambda acc, x: F.concat(acc, F.array(join(F.element_at(acc, -1), x))))
    within = lambda base: F.transform(
        values, lambda _, i: F.aggregate(F.slice(values, stretch(i) * _STRETCH + 1, i % _STRETCH + 1), F.get(base, stretch(i)), join)
    )
    return F.when(F.size(values) > 0, _held(bases, within)).otherwise(F.array().cast("array<int>"))


def _spans(text: Column, kind: str, pattern: str, group: int, least: int, gate: str) -> Column:
    """Array of (start, rank, end, value) of the leftmost non-overlapping matches; code points, end exclusive.

    Places come from the lengths of the matches and of the pieces between them.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    sizes = F.transform(found, lambda m: F.length(m))

    def placed(z: Column) -> Column:
        steps = F.transform(F.arrays_zip(z["gaps"].alias("g"), z["sizes"].alias("n")), lambda x: x["g"] + x["n"])
        steps = F.filter(steps, lambda x: x.isNotNull())  # one more piece than matches
        return F.zip_with(
            F.arrays_zip(_held(steps, lambda x: _running(x, lambda s, y: s + y)).alias("e"), z["sizes"].alias("n")),
            z["values"],
            lambda y, v: F.struct((y["e"] - y["n"]).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), y["e"].alias("end"), v.alias("value")),
        )

    spans = _held(F.struct(gaps.alias("gaps"), sizes.alias("sizes"), values.alias("values")), placed)
    kept = F.filter(spans, lambda x: F.length(x["value"]) >= least)
    return F.when(text.rlike(gate), kept).otherwise(F.array().cast("array<struct<start:int,rank:int,end:int,value:string>>"))


def _contained(spans: Column, x: Column) -> Column:
    return F.exists(spans, lambda y: (y["start"] <= x["start"]) & (x["end"] <= y["end"]))


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_base`` and ``_wide``: arrays of spans; a wide one isn't within a single base one."""
    text = text_or_empty(text_col)
    base = [_spans(text, k, _QUICK[k], g, n, _GATE[k]) for k, _, g, n in BASE]
    step = docs.withColumn("_base", F.array_sort(F.concat(*base)))
    wide = _spans(text, "live", WIDE, 0, 20, _WIDE_GATE)
    # ``_base`` is bound once, for a lambda would compute an expression anew for every candidate
    outside = _held(F.struct(F.col("_base").alias("base"), wide.alias("wide")), lambda z: F.filter(z["wide"], lambda x: ~_contained(z["base"], x)))
    return step.withColumn("_wide", outside)


def scan(
    spark: SparkSession,
    docs: DataFrame,
    repository: Column | None = None,
    owner: Column | None = None,
    widely: int = 2,
    spread: int = 3,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``secret_spans`` and counts.

    ``secret_spans``: array of (start, rank, end, owners, repositories, live), in order of start and
    kind (rank in ``KINDS``). All base spans are there; a wide candidate only if fewer than
    ``widely`` owners hold its value, in fewer than ``spread`` repositories. ``live`` says the same of
    any span. ``repository`` is by default source and language, ``owner`` the source; null is one repository or owner.

    A null or empty text has no spans. Each input row gives one row, repeated ones too; columns
    named ``secret_spans`` are replaced. An empty table gives an empty table.
    """
    missing = F.lit("\x00null")
    named = lambda c: F.coalesce(F.col(c).cast("string"), missing) if c in docs.columns else missing
    owner = F.coalesce(owner.cast("string"), missing) if owner is not None else named("source")
    repository = F.coalesce(repository.cast("string"), missing) if repository is not None else F.concat_ws("/", named("source"), named("lang"))
    docs = docs.drop("secret_spans")
    k1, k2 = (f"{free_prefix(docs, '_secret')}k{i}" for i in (1, 2))
    keys = {"_k1": F.xxhash64(text_or_empty(text_col)), "_k2": F.xxhash64(F.lit(7), text_or_empty(text_col))}
    # asked for first: a filter on the spans would find them a second time
    gates = reduce(or_, [text_or_empty(text_col).rlike(g) for g in (*_GATE.values(), _WIDE_GATE)])
    texts = docs.filter(gates).select(F.col(text_col).alias("_text"), owner.alias("_owner"), repository.alias("_repo"), *[v.alias(k) for k, v in keys.items()])
    found = candidates(texts, "_text").drop("_text")
    found = stored(spark, found.filter((F.size("_base") > 0) | (F.size("_wide") > 0)), "secret-candidates")

    one = found.select("_owner", "_repo", "_k1", "_k2", F.explode(F.concat("_base", "_wide")).alias("s"))
    one = one.withColumns({"_v": F.sha2("s.value", 256)})
    held = one.select("_v", "_owner", "_repo").distinct()  # partial sums first: a hot value is one row for each task and owner
    owned = held.groupBy("_v", "_owner").agg(F.count("*").alias("r")).groupBy("_v").agg(
        F.count("*").alias("owners"), F.sum("r").alias("repositories")
    )
    distinct = one.select("_k1", "_k2", "s", "_v").distinct()  # equal texts have equal spans
    judged = distinct.join(owned, "_v").withColumn("live", (F.col("owners") < widely) & (F.col("repositories") < spread))
    judged = judged.filter((F.col("s.rank") < len(BASE)) | F.col("live"))
    spans = judged.groupBy("_k1", "_k2").agg(
        F.array_sort(
            F.collect_list(F.struct("s.start", "s.rank", "s.end", "owners", "repositories", "live"))
        ).alias("secret_spans")
    )
    empty = F.array().cast(spans.schema["secret_spans"].dataType)
    return (
        docs.withColumns({k1: keys["_k1"], k2: keys["_k2"]})
        .join(spans.withColumnsRenamed({"_k1": k1, "_k2": k2}), [k1, k2], "left")
        .withColumn("secret_spans", F.coalesce("secret_spans", empty))
        .drop(k1, k2)
    )


def joined(spans: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each maximal run of spans replaced by ``<SECRET>``, or ``<SECRET_EXAMPLE>`` if every span of the run is widely copied.

    Spans that overlap are one run. A null text, and one without spans, stays as it is. Work is
    linear in text and spans: pieces are cut out of one stretch of runs at a time.
    """
    mark = lambda r: F.when(r["live"], F.lit("<SECRET>")).otherwise(F.lit("<SECRET_EXAMPLE>"))

    def runs(z: Column) -> Column:
        first = F.transform(z["spans"], lambda s, i: F.when((i == 0) | (s["start"] >= F.get(z["to"], i - 1)), i))
        return _held(
            F.array_compact(first),
            lambda firsts: F.transform(
                firsts,
                lambda i, k: _held(
                    F.coalesce(F.get(firsts, k + 1), F.size(z["spans"])),
                    lambda end: F.struct(
                        F.get(z["spans"], i)["start"].alias("at"),
                        F.get(z["to"], end - 1).alias("to"),
                        F.exists(F.slice(z["spans"], i + 1, end - i), lambda s: s["live"]).alias("live"),
                    ),
                ),
            ),
        )

    def cut(z: Column) -> Column:
        at = lambda i: F.coalesce(F.get(z["runs"], i)["at"], F.length(z["text"]))

        def stretch(b: Column) -> Column:
            start = b * _STRETCH
            piece = F.struct(at(start).alias("from"), F.substr(z["text"], at(start) + 1, at(start + _STRETCH) - at(start)).alias("t"))
            return _held(
                piece,
                lambda p: F.array_join(
                    F.transform(
                        F.slice(z["runs"], start + 1, _STRETCH),
                        lambda r, i: F.concat(mark(r), F.substr(p["t"], r["to"] - p["from"] + 1, at(start + i + 1) - r["to"])),
                    ),
                    "",
                ),
            )

        return F.concat(F.left(z["text"], at(F.lit(0))), F.array_join(F.transform(_stretches(z["runs"]), stretch), ""))

    ended = F.struct(spans.alias("spans"), _held(F.transform(spans, lambda s: s["end"]), lambda x: _running(x, lambda a, b: F.greatest(a, b))).alias("to"))
    whole = _held(F.struct(text.alias("text"), _held(ended, runs).alias("runs")), cut)
    return F.when(F.size(spans) > 0, whole).otherwise(text)
