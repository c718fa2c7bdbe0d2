"""Canonical exact digests of documents.

A text is decomposed (Unicode canonical decomposition, NFD), its case folded (full folding, so that
``STRASSE`` is ``straße``) and its whitespace folded; two 64-bit xxhashes of the outcome name a bucket, and bytes are compared inside each bucket, so that
texts share a fingerprint exactly if they have the same canonical form.
"""

from __future__ import annotations

import functools
import json
import sys
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotweave.llm.common import intermediates, stored, text_or_empty


#: Bits of a code point that choose its place in each level of a table, highest first.
_LEVELS = (9, 6, 6)


def _table(values: dict[int, object]) -> list:
    """Nested arrays of what single code points map to: by the highest bits, the middle, the lowest.

    Levels without a value are null and nothing follows the last value of one, so a table is little longer than its values:
    it is part of each plan that uses it, and of every text of that plan.
    """
    if not values:
        return []

    def level(held: dict[int, object], bits: tuple[int, ...]) -> list:
        if not bits:
            return held[0]
        low = sum(bits[1:])
        parts: dict[int, dict[int, object]] = {}
        for p, x in held.items():
            parts.setdefault(p >> low, {})[p & (1 << low) - 1] = x
        return [level(parts[k], bits[1:]) if k in parts else None for k in range(max(parts) + 1)]

    return level(values, _LEVELS)


@functools.cache
def _decomposition() -> dict[int, str]:
    """From Unicode data: full canonical decompositions; Hangul syllables follow a rule instead (``_jamo``)."""
    points = (p for p in range(0x80, sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF and not 0xAC00 <= p <= 0xD7A3)
    return {p: full for p in points if (full := unicodedata.normalize("NFD", chr(p))) != chr(p)}


@functools.cache
def _classes() -> dict[int, int]:
    """From Unicode data: combining classes other than 0."""
    return {p: k for p in range(0x80, sys.maxunicode + 1) if (k := unicodedata.combining(chr(p)))}


def _looked_up(char: Column, values: dict[int, object], kind: str) -> Column:
    """What the first code point of ``char`` maps to, or null; a look-up takes constant time."""
    for _ in _LEVELS:
        kind = f"array<{kind}>"
    point, out = F.ascii(char), F.from_json(F.lit(json.dumps(_table(values), ensure_ascii=False, separators=(",", ":"))), kind)
    for k, n in enumerate(_LEVELS):
        out = F.get(out, F.shiftright(point, sum(_LEVELS[k + 1 :])).bitwiseAND(F.lit((1 << n) - 1)))
    return out


def _jamo(char: Column) -> Column:
    """Leading consonant, vowel and, if there is one, trailing consonant of a Hangul syllable; null for others.

    Syllables are numbered by 19 leading, 21 vowels, 28 trailing (the first one is none).
    """
    number = F.ascii(char) - 0xAC00
    letters = lambda first, n: F.array(*[F.lit(chr(first + k)) for k in range(n)])
    trailing = F.concat(F.array(F.lit("")), letters(0x11A8, 27))
    pick = lambda a, k: F.get(a, F.floor(k).cast("int"))
    parts = F.concat(pick(letters(0x1100, 19), number / 588), pick(letters(0x1161, 21), (number % 588) / 28), pick(trailing, number % 28))
    return F.when((number >= 0) & (number < 11172), parts)


def _class(points: list[int]) -> str:
    """The inside of a regular expression class of the code points, in ranges."""
    out: list[list[int]] = []
    for p in sorted(points):
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out)


def _held(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _sorted_marks(run: Column) -> Column:
    """Neighbouring characters of combining classes other than 0, in the order of the classes; equal classes keep theirs."""
    chars = F.regexp_extract_all(run, F.lit("(?s)."), F.lit(0))
    keyed = F.transform(chars, lambda c, i: F.struct(_looked_up(c, _classes(), "int").alias("k"), i.alias("i"), c.alias("c")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["c"]), "")


def decomposed(text: Column) -> Column:
    """Canonical decomposition (NFD): each code point fully decomposed, then each run of marks ordered by combining class.

    Texts without a code point that decomposes or a mark, and pieces without any, pass untouched.
    """
    # nothing below U+00C0 decomposes
    pieces = F.regexp_extract_all(text, F.lit(r"[\x{C0}-\x{10FFFF}]|[^\x{C0}-\x{10FFFF}]+"), F.lit(0))
    whole = F.array_join(F.transform(pieces, lambda c: F.coalesce(_looked_up(c, _decomposition(), "string"), _jamo(c), c)), "")
    step = F.when(text.rlike(r"[\x{C0}-\x{10FFFF}]"), whole).otherwise(text)

    # marks newer than the Unicode data of the JVM are unassigned to it
    mark, marks = r"[\p{M}\p{Cn}]", _class(list(_classes()))

    def ordered(t: Column) -> Column:
        runs = F.regexp_extract_all(t, F.lit(rf"{mark}+|[^\p{{M}}\p{{Cn}}]+"), F.lit(0))
        inner = lambda r: F.regexp_extract_all(r, F.lit(f"[{marks}]+|[^{marks}]+"), F.lit(0))
        part = lambda m: F.when((F.length(m) > 1) & _looked_up(m, _classes(), "int").isNotNull(), _sorted_marks(m)).otherwise(m)
        fixed = F.transform(runs, lambda r: F.when(r.rlike(f"^{mark}{{2}}"), F.array_join(F.transform(inner(r), part), "")).otherwise(r))
        return F.when(t.rlike(f"{mark}{{2}}"), F.array_join(fixed, "")).otherwise(t)

    return _held(step, ordered)


@functools.cache
def _foldings() -> dict[int, str]:
    """From Unicode data: full case foldings, decomposed, of code points beyond ASCII; those that only lower-casing changes stay themselves."""
    points = (chr(p) for p in range(0x80, sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF)
    return {ord(c): unicodedata.normalize("NFD", c.casefold()) for c in points if c.casefold() != c or c.lower() != c}


def case_folded(text: Column) -> Column:
    """Full case folding of a decomposed text, decomposed again.

    Beyond ASCII a table is asked for each code point, for lower-casing depends on what stands around (final
    sigma) and leaves ``ß`` and ``ſ``; code points that aren't in it stay, whatever the JVM's Unicode data say.
    The pieces are cut by ranges, as a class of all code points that fold is slow; the usual accents, U+0300 to
    U+0344, have no case and are left out.
    """
    wide = r"\x{80}-\x{2FF}\x{345}-\x{10FFFF}"
    pieces = F.regexp_extract_all(text, F.lit(f"[{wide}]|[^{wide}]+"), F.lit(0))
    folded = lambda c: F.when((F.ascii(c) < 0x80) | F.ascii(c).between(0x300, 0x344), F.lower(c)).otherwise(F.coalesce(_looked_up(c, _foldings(), "string"), c))
    whole = F.array_join(F.transform(pieces, folded), "")
    return F.when(text.rlike(f"[{wide}]"), whole).otherwise(F.lower(text))


def canonical(text: Column) -> Column:
    """Decomposed, case-folded, each run of whitespace one space, none at the ends.

    What is rare is asked for first: nothing decomposes below U+00C0, and most texts have no
    whitespace but single spaces and line breaks. A very long text is one value, handled as a whole.
    """
    wide = _held(decomposed(text), case_folded)
    plain = F.when(text.rlike(r"[\x{B5}\x{C0}-\x{10FFFF}]"), wide).otherwise(F.lower(text))
    for c in "\n\t\r":
        plain = F.replace(plain, F.lit(c), F.lit(" "))
    odd = r"[\x0B\x0C\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
    # held, for an expression that is read twice is written out twice
    folded = _held(plain, lambda t: F.when(t.rlike(odd + "| {2}"), F.regexp_replace(t, f"(?:{odd}| )+", " ")).otherwise(t))
    return F.trim(folded)


def wide_hash(canon: Column) -> Column:
    """Hex of two 64-bit xxhashes."""
    parts = [F.xxhash64(canon), F.xxhash64(F.lit("spotweave"), canon)]
    return F.concat(*[F.lower(F.lpad(F.hex(p), 16, "0")) for p in parts])


def buckets(spark: SparkSession, hashed: DataFrame) -> DataFrame:
    """Buckets (``_hash``) with more than one canonical text: ``_hash``, ``_canon``, ``_nth`` from 0.

    Hash and text together are made distinct, which compares the bytes of texts in one bucket;
    each task first keeps one of its equal texts, so a bucket of copies is one row for each task.
    """
    texts = stored(spark, hashed.select("_hash", "_canon").distinct(), "fingerprint-texts")
    clash = texts.groupBy("_hash").agg(F.count("*").alias("n")).filter("n > 1").select("_hash")
    met = texts.join(clash, "_hash")
    return stored(spark, met.withColumn("_nth", F.row_number().over(Window.partitionBy("_hash").orderBy("_canon")) - 1), "fingerprint-clashes")


#: Hashes (32 characters each) up to which the buckets that hold several rows are broadcast.
FEW = 200_000


def collisions(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``buckets`` of ``rows`` (``_hash``, ``_text``, not canonical): first hashes alone are counted, then bytes are compared where a hash occurs again."""
    with intermediates(spark, keep=1):
        again = stored(spark, rows.groupBy("_hash").agg(F.count("*").alias("n")).filter("n > 1").select("_hash"), "fingerprint-again")
        met = rows.join(F.broadcast(again) if again.count() <= FEW else again, "_hash", "left_semi")
        return buckets(spark, met.select("_hash", canonical(F.col("_text")).alias("_canon")))


def fingerprint_of(rows: DataFrame, hash_col: str, text: Column, clash: DataFrame, out: str) -> DataFrame:
    """``rows`` with the fingerprint of a text whose hash is ``hash_col``: the hash, and its number where the bucket clashes."""
    if clash.limit(1).count() == 0:
        return rows.withColumn(out, F.concat(hash_col, F.lit("-0")))
    right = clash.select(F.col("_hash").alias("_h"), F.col("_canon").alias("_c"), "_nth")
    met = rows.withColumn("_own", canonical(text)).join(right, (F.col(hash_col) == F.col("_h")) & (F.col("_own") == F.col("_c")), "left")
    nth = F.coalesce(F.col("_nth").cast("string"), F.lit("0"))
    return met.withColumn(out, F.concat(hash_col, F.lit("-"), nth)).drop("_h", "_c", "_nth", "_own")


def fingerprints(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``: the wide hash of the canonical text and its number inside a bucket that holds several texts.

    Null is the empty text. Each row gives a row, repeated ones too; a column ``fingerprint`` is
    replaced. An empty table gives an empty table.
    """
    rest = [c for c in docs.columns if c != "fingerprint"]
    own = docs.select(F.struct(*rest).alias("_row"), text_or_empty(text_col).alias("_text"))
    hashed = own.withColumn("_canon", canonical(F.col("_text"))).withColumn("_hash", wide_hash(F.col("_canon"))).drop("_canon")
    hashed = stored(spark, hashed, "fingerprint-rows")
    clash = collisions(spark, hashed)
    return fingerprint_of(hashed, "_hash", F.col("_text"), clash, "fingerprint").select("_row.*", "fingerprint")


#: Parts into which the span of ids is cut at first and the most ranges there are, and rows that a range of them should hold.
CELLS, RANGE = 1 << 16, 5_000


def cells(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with ``_cell``, parts of the span of ``_id`` (-1: null), and how many rows a range should hold.

    The span is cut into equal parts, which are counted. A part that holds more than two ranges' rows and
    several ids is cut again between its own least and greatest id, until there is none, so outlying ids
    crowd nothing. Ranges are as many as RANGE asks for, CELLS at most (beyond, they grow); so fewer than
    CELLS / 2 parts are cut again, and their bounds are what the driver holds.
    """
    kind = rows.schema["_id"].dataType
    ends = rows.agg(F.min("_id").alias("low"), F.max("_id").alias("high"), F.count("*").alias("n")).first()
    low, high = float(ends["low"] or 0), float(ends["high"] or 0)
    want = max(RANGE, -(-ends["n"] // CELLS))
    cell = F.floor((F.col("_id").cast("double") - F.lit(low)) / F.lit(max(high - low, 1e-300) / (CELLS - 1))).cast("long")
    named, base = rows.withColumn("_cell", F.coalesce(cell, F.lit(-1))), CELLS + 1
    while True:
        full = named.groupBy("_cell").agg(F.count("*").alias("n"), F.min("_id").alias("low"), F.max("_id").alias("high"))
        full = full.filter((F.col("n") > 2 * want) & (F.col("low") < F.col("high"))).collect()
        if not full:
            return named, want
        cuts = []
        for r in full:
            parts = 16 + 4 * r["n"] // want
            cuts.append((r["_cell"], r["low"], float(r["high"] - r["low"]) / (parts - 1), base))
            base += parts + 1
        bounds = rows.sparkSession.createDataFrame(cuts, f"_cell long, _low {kind.simpleString()}, _width double, _base long")
        inner = F.col("_base") + F.floor((F.col("_id") - F.col("_low")) / F.col("_width")).cast("long")
        named = named.join(F.broadcast(bounds), "_cell", "left").withColumn("_cell", F.coalesce(inner, "_cell")).drop("_low", "_width", "_base")


def with_next(rows: DataFrame, also: list[str]) -> DataFrame:
    """``rows`` (``_id``, ``_text``) with ``_next``: the text of the row with the next lower id; after the last, the first.

    For each column of ``also``, ``_next_<name>`` is that row's. The span of ids is cut into
    parts (``cells``), and neighbouring parts are joined to ranges (a part is never cut). The first row of a
    range is also dealt, as a guest, to the range before it, so texts move once and a window over each
    range finds what follows. Rows with equal ids follow each other by text, greatest first, in one range;
    null ids come last.
    """
    named, want = cells(rows)
    parts = named.groupBy("_cell").agg(F.count("*").alias("n"), F.max("_id").alias("top"))
    falling = Window.orderBy(F.col("top").desc_nulls_last())
    parts = parts.withColumn("_range", F.floor((F.sum("n").over(falling) - F.col("n")) / want).cast("long"))
    heads = parts.groupBy("_range").agg(F.max("top").alias("_head"))
    last = F.max("_range").over(Window.partitionBy())
    heads = heads.select("_range", "_head", F.coalesce(F.lag("_range").over(Window.orderBy("_range")), last).alias("_before"))
    placed = named.join(F.broadcast(parts.join(heads, "_range").select("_cell", "_range", "_head", "_before")), "_cell")
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("_before").alias("r"), F.lit(True).alias("guest"))
    dealt = placed.withColumn("_to", F.explode(F.when(F.col("_id").eqNullSafe(F.col("_head")), F.array(own, guest)).otherwise(F.array(own))))
    dealt = dealt.select(*rows.columns, "_to.r", "_to.guest")
    order = Window.partitionBy("r").orderBy("guest", F.col("_id").desc_nulls_last(), F.col("_text").desc())
    leads = {"_next": F.lead("_text").over(order)} | {f"_next_{c}": F.lead(c).over(order) for c in also}
    return dealt.withColumns(leads).filter("not guest").drop("r", "guest")


def edited_pairs(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of documents and of edited ones: ``docs`` with the columns below, without its text.

    In the edited text the last half of the code points (rounded down) is replaced by as many
    first ones of the next document (``with_next``). ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``; ``near_edited`` and ``near_next`` (double): 1 if the
    fingerprint is that of the edited text, of the next document, else 0. Columns of these names
    are replaced; other columns, whatever their names, pass through. Ids are numbers or null.
    An empty table gives an empty table.
    """
    made = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rest = [c for c in docs.columns if c not in (*made, text_col)]
    rows = docs.select(F.struct(*rest).alias("_row"), F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    rows = rows.withColumn("_canon", canonical(F.col("_text"))).withColumn("_hash", wide_hash(F.col("_canon"))).drop("_canon")
    half = F.floor(F.length("_text") / 2).cast("int")
    edited = F.concat(F.left(F.col("_text"), F.length("_text") - half), F.left(F.col("_next"), half))
    pairs = with_next(rows, ["_hash"]).withColumn("_edited", edited).drop("_next")
    pairs = pairs.withColumn("_canon", canonical(F.col("_edited"))).withColumn("_edited_hash", wide_hash(F.col("_canon"))).drop("_canon")
    pairs = stored(spark, pairs, "fingerprint-pairs")
    both = pairs.select("_hash", "_text").union(pairs.select("_edited_hash", "_edited"))
    clash = collisions(spark, both)
    named = fingerprint_of(pairs, "_hash", F.col("_text"), clash, "fingerprint")
    named = fingerprint_of(named, "_edited_hash", F.col("_edited"), clash, "edited_fingerprint")
    if clash.limit(1).count():
        # the next document's number in its bucket: it is found again among the fingerprints
        named = with_next(named, ["fingerprint"]).withColumnRenamed("_next_fingerprint", "_following")
    else:
        named = named.withColumn("_following", F.concat("_next__hash", F.lit("-0")))
    return named.select(
        "_row.*",
        F.length("_text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        (F.col("fingerprint") == F.col("edited_fingerprint")).cast("double").alias("near_edited"),
        (F.col("fingerprint") == F.col("_following")).cast("double").alias("near_next"),
    )
