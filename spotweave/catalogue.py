"""The registered queries over the fixture views, and SQL for each written by another method."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.config import BarcodeSpec, FixedSpec, ProteinSpec, RunSpec, UmiSpec
from spotweave.functions import reads as R
from spotweave.functions import sequence, text
from spotweave.operators import filters, mapping, mask_index, masks, protein, resolve
from spotweave.plans.fixtures import ctes, view
from spotweave.storage import scratch

#: The fixture's fixed sequence.
FIXED = "TGCCTCTCAG"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with SQL if there is any."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def spec(mismatch: int = 0, fixed: tuple = ()) -> RunSpec:
    """The default run with a tolerance and fixed sequences."""
    return RunSpec(barcode=BarcodeSpec(mismatch=mismatch), fixed=FixedSpec(fixed))


PROTEIN = RunSpec(protein=ProteinSpec(mismatch=1))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "read_pairs")


def _mask(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "chip_mask")


#: Where the index of each mask of a session is.
_INDEXED: dict[tuple[str, str], mask_index.MaskIndex] = {}


def index(spark: SparkSession, d: str) -> mask_index.MaskIndex:
    """The index of the fixture mask, built once in a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _INDEXED:
        _INDEXED[key] = mask_index.build(spark, _mask(spark, d), BarcodeSpec(), scratch(spark, "mask-index"))
    return _INDEXED[key]


def _mapped(spark: SparkSession, d: str, k: int, **how: bool) -> DataFrame:
    return mapping.map_pairs(_pairs(spark, d), index(spark, d), spec(k), **how)


def _with(names: list[str], *more: str) -> str:
    return "WITH " + ",\n".join([ctes(*names), *more]) + "\n"


# SQL building blocks; the engine encodes barcodes and expands neighbours, the SQL compares strings
_R = """r AS (SELECT *, substr(seq1,1,25) AS barcode, substr(qual1,1,25) AS bar_qual, substr(seq1,26,10) AS umi, substr(qual1,26,10) AS umi_qual FROM read_pairs)"""
_M = """m AS (SELECT barcode AS mb, x, y FROM (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY rec_no DESC) AS k FROM chip_mask) z WHERE k = 1)"""
_NS = "(length(barcode) - length(replace(barcode, 'N', '')))"


def _resolution(k: int) -> list[str]:
    """CTEs up to ``res(barcode, match_kind, mb, x, y)``."""
    if k == 0:
        return [_R, _M, "res AS (SELECT DISTINCT r.barcode, 'exact' AS match_kind, mb, x, y FROM r JOIN m ON r.barcode = mb WHERE barcode <> repeat('T', 25))"]
    parts = [(1, 8), (9, 8), (17, 9)]
    cand = " UNION ".join(f"SELECT b.barcode, ns, mb, x, y FROM b JOIN m ON substr(b.barcode,{a},{n}) = substr(mb,{a},{n})" for a, n in parts)
    return [
        _R,
        _M,
        f"b AS (SELECT DISTINCT barcode, {_NS} AS ns FROM r WHERE barcode <> repeat('T', 25) AND {_NS} <= 1)",
        f"cand AS ({cand})",
        f"dist AS (SELECT *, hamming(barcode, mb) AS d FROM cand WHERE hamming(barcode, mb) <= CASE WHEN ns = 1 THEN 1 ELSE {k} END)",
        "near AS (SELECT barcode, min(d) AS md FROM dist GROUP BY barcode)",
        """best AS (SELECT dist.barcode, max(ns) AS ns, max(d) AS d, count(*) AS n, min(mb) AS mb, min(x) AS x, min(y) AS y
 FROM dist JOIN near ON dist.barcode = near.barcode AND d = md GROUP BY dist.barcode)""",
        """res AS (SELECT barcode, CASE WHEN n > 1 THEN 'ambiguous' WHEN ns = 1 THEN 'n' WHEN d = 0 THEN 'exact' WHEN d = 1 THEN 'mis1' ELSE 'mis2' END AS match_kind,
 CASE WHEN n = 1 THEN mb END AS mb, CASE WHEN n = 1 THEN x END AS x, CASE WHEN n = 1 THEN y END AS y FROM best)""",
    ]


def _count_ge(col: str, first: str) -> str:
    """SQL: characters of a column at or above one."""
    low = "".join(chr(c) for c in range(33, ord(first))).replace("'", "''")
    return f"length(translate({col}, '{low}', ''))"


_WEAK = "length(umi_qual) - " + _count_ge("umi_qual", "+")
_FAIL = f"CASE WHEN contains(umi,'N') THEN 'n' WHEN umi = repeat('A',10) THEN 'poly_a' WHEN {_WEAK} > 1 THEN 'low_quality' END"


def _mapped_sql(k: int) -> str:
    """WITH ... ``mapped`` for the default run."""
    both = f"""mapped AS (SELECT r.*, match_kind, x, y, CASE WHEN x IS NOT NULL THEN {_FAIL} END AS umi_fail FROM r LEFT JOIN res ON r.barcode = res.barcode)"""
    return _with(["read_pairs", "chip_mask"], *_resolution(k), both)


@query(_with(["read_pairs", "chip_mask"], *_resolution(0)) + "SELECT x, y, count(*) AS n FROM r JOIN res ON r.barcode = res.barcode GROUP BY x, y")
def map_exact_counts(spark: SparkSession, d: str) -> DataFrame:
    """Reads of each position, exact matches."""
    return mapping.position_counts(_mapped(spark, d, 0))


def _resolved(spark: SparkSession, d: str, k: int) -> DataFrame:
    s = spec(k)
    cut = mapping.sliced(_pairs(spark, d), s)
    found = index(spark, d).resolved(resolve.distinct_barcodes(cut), s.barcode)
    return found.select("barcode", "match_kind", sequence.decode("bc", 25).alias("matched"), "x", "y")


@query(_with(["read_pairs", "chip_mask"], *_resolution(1)) + "SELECT barcode, match_kind, mb AS matched, x, y FROM res")
def map_k1_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Distinct barcodes with one substitution tolerated."""
    return _resolved(spark, d, 1)


@query(_with(["read_pairs", "chip_mask"], *_resolution(2)) + "SELECT barcode, match_kind, mb AS matched, x, y FROM res")
def map_k2_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Distinct barcodes with two substitutions tolerated."""
    return _resolved(spark, d, 2)


@query(_with(["read_pairs", "chip_mask"], *_resolution(1)) + "SELECT barcode, mb AS matched, x, y FROM res WHERE match_kind = 'n'")
def map_n_wildcard(spark: SparkSession, d: str) -> DataFrame:
    """Barcodes with one N that has one match."""
    s = spec(1)
    codes = resolve.distinct_barcodes(mapping.sliced(_pairs(spark, d), s)).filter(sequence.n_count("barcode") == 1)
    found, _ = resolve.wildcard(codes, resolve.last_wins(_mask(spark, d), s.barcode))
    return found.select("barcode", sequence.decode("bc", 25).alias("matched"), "x", "y")


_TAG = "concat(split_part(name,'/',1),'|||CB:Z:',CAST(x AS VARCHAR),'_',CAST(y AS VARCHAR),'|||UR:Z:',umi,'|||UY:Z:',umi_qual)"


@query(_mapped_sql(1) + f"SELECT read_id, {_TAG} AS tagged_name, seq2, qual2, umi_fail FROM mapped WHERE x IS NOT NULL")
def mapped_tags_se(spark: SparkSession, d: str) -> DataFrame:
    """Tagged second reads."""
    return mapping.tagged_single(_mapped(spark, d, 1), spec(1)).select("read_id", "tagged_name", "seq2", "qual2", "umi_fail")


@query(_mapped_sql(1) + f"SELECT read_id, {_TAG} AS tagged_name, '' AS out_seq1, '' AS out_qual1, seq2 AS out_seq2, qual2 AS out_qual2 FROM mapped WHERE x IS NOT NULL")
def mapped_tags_pe(spark: SparkSession, d: str) -> DataFrame:
    """Tagged and trimmed pairs."""
    return mapping.tagged_pairs(_mapped(spark, d, 1, trimmed=True), spec(1)).select("read_id", "tagged_name", "out_seq1", "out_qual1", "out_seq2", "out_qual2")


@query(
    _with(["read_pairs", "chip_mask"], *_resolution(1), f"mapped AS (SELECT r.*, x, y, CASE WHEN x IS NOT NULL THEN {_FAIL} END AS umi_fail FROM r LEFT JOIN res ON r.barcode = res.barcode)")
    + """SELECT split_part(name,'/',1) AS base, CAST(x AS VARCHAR) AS x, seq1, substr(seq2,1,40) AS seq2 FROM mapped WHERE x IS NOT NULL"""
)
def trims_umi_on_second(spark: SparkSession, d: str) -> DataFrame:
    """Pairs whose identifier is on the second read: it is cut there, and the first read is whole."""
    s = RunSpec(barcode=BarcodeSpec(mismatch=1), umi=UmiSpec(start=40, length=10, read=2))
    out = mapping.tagged_single(mapping.map_pairs(_pairs(spark, d), _mask(spark, d), s), s)
    return out.select(F.substring_index("tagged_name", "|||", 1).alias("base"), F.col("x").cast("string").alias("x"), "seq1", "seq2")


@query(_mapped_sql(1) + "SELECT read_id, match_kind, umi_fail FROM mapped WHERE x IS NULL OR umi_fail IS NOT NULL")
def unmapped_reads(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of the unmapped output."""
    return _mapped(spark, d, 1).filter(~F.col("passed")).select("read_id", "match_kind", "umi_fail")


def _fixed(spark: SparkSession, d: str, *rows: tuple[str, int]) -> DataFrame:
    return _pairs(spark, d).filter(filters.has_fixed(FixedSpec(rows), F.col("seq1"))).select("read_id")


@query(_with(["read_pairs"]) + f"SELECT read_id FROM read_pairs WHERE position('{FIXED}' IN seq1) > 0 OR position('CTGAGAGGCA' IN seq1) > 0")
def fixed_filter_any(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with the fixed sequence anywhere, on either strand."""
    return _fixed(spark, d, (FIXED, -1))


@query(_with(["read_pairs"]) + f"SELECT read_id FROM read_pairs WHERE position('{FIXED}' IN seq1) = 36")
def fixed_filter_pos(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with the fixed sequence first at its start."""
    return _fixed(spark, d, (FIXED, 35))


@query(
    _with(["read_pairs"])
    + f"SELECT read_id FROM read_pairs WHERE position('{FIXED}' IN seq1) = 36 OR position('GATTACA' IN seq1) > 0 OR position('TGTAATC' IN seq1) > 0 OR position('TTTTTTTTTT' IN seq1) = 1"
)
def fixed_filter_list(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with any of a list of fixed sequences."""
    return _fixed(spark, d, (FIXED, 35), ("GATTACA", -1), ("TTTTTTTTTT", 0))


@query(_with(["read_pairs"], _R) + f"SELECT read_id, {_FAIL} AS umi_fail FROM r")
def umi_filter_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Why identifiers fail, for all pairs."""
    s = spec()
    cut = mapping.sliced(_pairs(spark, d), s)
    return cut.select("read_id", filters.umi_fail(F.col("umi"), F.col("umi_qual"), s.umi).alias("umi_fail"))


def _pct(a: str, b: str) -> str:
    return f"round(CASE WHEN {b} <> 0 THEN CAST({a} AS DOUBLE) * 100 / {b} END, 4)"


_METRICS = f"""counts AS (SELECT (SELECT count(*) FROM read_pairs) AS total_reads, count(*) AS pass_filter, count(x) AS mapped,
 count(*) FILTER (match_kind = 'exact') AS exact, count(*) FILTER (match_kind IN ('mis1','mis2')) AS mismatched, count(*) FILTER (match_kind = 'n') AS with_n,
 count(*) FILTER (umi_fail = 'n') AS umi_n, count(*) FILTER (umi_fail = 'poly_a') AS umi_poly_a, count(*) FILTER (umi_fail = 'low_quality') AS umi_low_quality, count(umi_fail) AS umi_filtered
 FROM mapped WHERE position('{FIXED}' IN seq1) = 0 AND position('CTGAGAGGCA' IN seq1) = 0)"""
_PCTS = ", ".join(f"{_pct(c, 'pass_filter')} AS {c}_pct" for c in ("mapped", "exact", "mismatched", "with_n", "umi_filtered", "umi_n", "umi_poly_a", "umi_low_quality"))


@query(_mapped_sql(2).rstrip() + ",\n" + _METRICS + f"\nSELECT *, total_reads - pass_filter AS fixed_filtered, {_pct('(total_reads - pass_filter)', 'total_reads')} AS fixed_pct, {_PCTS} FROM counts")
def run_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Counters and percentages of a run with a fixed sequence and two substitutions."""
    pairs, s = _pairs(spark, d), spec(2, ((FIXED, -1),))
    return mapping.run_metrics(pairs, mapping.map_pairs(pairs, index(spark, d), s))


_QUALS = ", ".join(
    f"{c}_{q}, {_pct(f'{c}_{q}', n)} AS {c}_{q}_pct" for q in R.QUALITY for c, n in (("barcode", "(reads * 25)"), ("umi", "(mapped * 10)"))
)
_SUMS = ", ".join(f"sum({_count_ge('bar_qual', f)}) AS barcode_{q}, sum(CASE WHEN x IS NOT NULL THEN {_count_ge('umi_qual', f)} END) AS umi_{q}" for q, f in R.QUALITY.items())


@query(_mapped_sql(1).rstrip() + f",\ns AS (SELECT count(*) AS reads, count(x) AS mapped, {_SUMS} FROM mapped)\nSELECT reads, mapped, {_QUALS} FROM s")
def quality_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Base qualities of barcodes and identifiers."""
    return mapping.quality_metrics(_mapped(spark, d, 1), spec(1))


@query(_mapped_sql(1) + "SELECT count(*) AS mapped_dnbs FROM (SELECT DISTINCT x, y FROM mapped WHERE x IS NOT NULL) z")
def mapped_dnbs(spark: SparkSession, d: str) -> DataFrame:
    """Distinct positions."""
    return mapping.mapped_spots(_mapped(spark, d, 1))


@query(_mapped_sql(1) + "SELECT n, n * count(*) AS reads FROM (SELECT count(*) AS n FROM mapped WHERE x IS NOT NULL GROUP BY x, y) z GROUP BY n")
def reads_per_barcode_hist(spark: SparkSession, d: str) -> DataFrame:
    """Reads by the number of reads of their position."""
    return mapping.barcode_histogram(mapping.position_counts(_mapped(spark, d, 1)))


@query(_with(["barcode_list"]) + "SELECT x, y, CAST(sum(n) AS BIGINT) AS n FROM barcode_list GROUP BY x, y")
def merge_count_lists(spark: SparkSession, d: str) -> DataFrame:
    """Count lists summed."""
    return masks.merge_counts(view(spark, d, "barcode_list"))


def _records(spark: SparkSession, d: str) -> DataFrame:
    return masks.coded(masks.union(_mask(spark, d), view(spark, d, "chip_mask_b")))


_U = _with(["chip_mask", "chip_mask_b"], "u AS (SELECT 0 AS src, * FROM chip_mask UNION ALL SELECT 1 AS src, * FROM chip_mask_b)")


@query(_U + "SELECT barcode, min(x) AS x, min(y) AS y FROM u GROUP BY barcode HAVING count(DISTINCT concat(CAST(x AS VARCHAR),'_',CAST(y AS VARCHAR))) = 1")
def mask_merge(spark: SparkSession, d: str) -> DataFrame:
    """Two masks merged, without conflicting barcodes."""
    return masks.kept(_records(spark, d)).select(sequence.decode("bc", 25).alias("barcode"), "x", "y")


@query(_U + "SELECT barcode FROM u GROUP BY barcode HAVING count(DISTINCT concat(CAST(x AS VARCHAR),'_',CAST(y AS VARCHAR))) > 1")
def mask_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Conflicting barcodes."""
    return masks.conflicts(_records(spark, d)).select(sequence.decode("bc", 25).alias("barcode"))


@query(
    _U.rstrip()
    + """,
f AS (SELECT barcode, x, y, src, rec_no, row_number() OVER (PARTITION BY barcode ORDER BY src, rec_no) AS i FROM u),
o AS (SELECT f.barcode, count(*) AS n, coalesce(min(CASE WHEN f.x <> g.x OR f.y <> g.y THEN f.i END) - 1, count(*)) AS m
 FROM f JOIN f g ON f.barcode = g.barcode AND g.i = 1 GROUP BY f.barcode)
SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(m - 1) AS BIGINT) AS overlap, CAST(sum(CASE WHEN m < n THEN n - m + 1 ELSE 0 END) AS BIGINT) AS dup, count(*) FILTER (m = n) AS unique_barcodes FROM o"""
)
def mask_merge_stats(spark: SparkSession, d: str) -> DataFrame:
    """Counters of the merge."""
    return masks.merge_stats(_records(spark, d))


@query(_U + "SELECT min(x) AS col_start, max(x) AS col_end, min(y) AS row_start, max(y) AS row_end FROM u")
def mask_range(spark: SparkSession, d: str) -> DataFrame:
    """Range of positions."""
    return masks.slide_range(_records(spark, d))


@query(_U + "SELECT count(DISTINCT barcode) AS barcode_types FROM u")
def mask_types(spark: SparkSession, d: str) -> DataFrame:
    """Distinct barcodes."""
    return masks.barcode_types(_records(spark, d))


@query(_U + "SELECT barcode, x, y FROM (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY src DESC, rec_no DESC) AS k FROM u) z WHERE k = 1")
def mask_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Of a barcode's records the last."""
    return resolve.last_wins(_records(spark, d), BarcodeSpec()).select(sequence.decode("bc", 25).alias("barcode"), "x", "y")


# order of barcodes as codes: the last base weighs most, bases rank A C T G
_CODE_ORDER = "reverse(translate(barcode, 'ACTG', '0123'))"


@query(
    _U.rstrip()
    + f""",
c AS (SELECT DISTINCT barcode, x, y FROM u), rg AS (SELECT min(x) AS x0, min(y) AS y0 FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY {_CODE_ORDER}) - 1 AS seg FROM c)
SELECT CAST(y - y0 AS INT) AS "row", CAST(x - x0 AS INT) AS col, CAST(seg AS INT) AS seg, barcode FROM k, rg WHERE seg < 2"""
)
def mask_cells(spark: SparkSession, d: str) -> DataFrame:
    """Dense cells of the records, two segments a cell."""
    found = masks.cells(_records(spark, d).select("bc", "x", "y").distinct(), 2)
    return found.select("row", "col", "seg", sequence.decode("bc", 25).alias("barcode"))


@query(_with(["chip_mask"]) + "SELECT barcode, x + 5 AS x, y + 7 AS y FROM chip_mask WHERE barcode <> repeat('A', 25)")
def mask_from_cells(spark: SparkSession, d: str) -> DataFrame:
    """Mask rows from cells with offsets; empty cells are dropped."""
    table = masks.coded(_mask(spark, d)).select(F.col("y").alias("row"), F.col("x").alias("col"), F.lit(0).alias("seg"), "bc")
    empty = table.select((F.col("row") + 1).alias("row"), "col", "seg", F.lit(0).cast("long").alias("bc"))
    return masks.from_cells(table.union(empty), 7, 5).select(sequence.decode("bc", 25).alias("barcode"), "x", "y")


@query(_U + "SELECT barcode, min(x) AS x, min(y) AS y FROM u GROUP BY barcode HAVING count(*) = 1")
def singleton_barcodes(spark: SparkSession, d: str) -> DataFrame:
    """Barcodes with one record."""
    return masks.singletons(_records(spark, d)).select(sequence.decode("bc", 25).alias("barcode"), "x", "y")


@query(_U + "SELECT CAST(sum(n) AS BIGINT) AS total, CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS dup, count(*) AS types, count(*) FILTER (n = 1) AS unique_types FROM (SELECT count(*) AS n FROM u GROUP BY barcode) z")
def singleton_stats(spark: SparkSession, d: str) -> DataFrame:
    """Counters of singleton barcodes."""
    return masks.singleton_stats(_records(spark, d))


_POS = "(SELECT CAST(unnest(generate_series(1, 15)) AS INT) AS i)"
_VARIANTS = f"""v AS (SELECT barcode AS variant, protein_index FROM protein_list UNION ALL
 SELECT concat(substr(barcode,1,i-1), b, substr(barcode,i+1,15)), protein_index FROM protein_list, {_POS} p, (SELECT unnest(['A','C','T','G']) AS b) q WHERE substr(barcode,i,1) <> b)"""


@query(_with(["protein_list"], _VARIANTS) + "SELECT variant, protein_index FROM v")
def protein_expand(spark: SparkSession, d: str) -> DataFrame:
    """Protein barcodes with one substitution."""
    found = protein.expand(view(spark, d, "protein_list"), ProteinSpec())
    return found.select(sequence.decode("variant", 15).alias("variant"), "protein_index")


@query(
    _with(["chip_mask"], "p AS (SELECT barcode, min(rec_no) AS protein_index FROM chip_mask GROUP BY barcode)", """
v AS (SELECT barcode AS variant, protein_index FROM p UNION ALL
 SELECT concat(substr(barcode,1,i-1), b, substr(barcode,i+1,25)), protein_index FROM p, (SELECT CAST(unnest(generate_series(1, 25)) AS INT) AS i) s, (SELECT unnest(['A','C','T','G']) AS b) q WHERE substr(barcode,i,1) <> b)""")
    + "SELECT variant, min(protein_index) AS a, max(protein_index) AS b FROM v GROUP BY variant HAVING min(protein_index) <> max(protein_index)"
)
def protein_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Variants that two distinct chip barcodes share; a barcode's index is its first record."""
    every = _mask(spark, d).groupBy("barcode").agg(F.min("rec_no").alias("protein_index"))
    found = protein.collisions(every, ProteinSpec(length=25))
    return found.select(sequence.decode("variant", 25).alias("variant"), "a", "b")


_PR = """pr AS (SELECT read_id, substr(seq1,1,25) AS barcode, substr(seq1,26,10) AS umi, substr(qual1,26,10) AS umi_qual, substr(seq2,1,15) AS pb FROM protein_read_pairs)"""
_HITS = f"""hits AS (SELECT read_id, x, y, protein_index, umi FROM pr JOIN spot_mask s ON pr.barcode = s.barcode JOIN protein_list l ON hamming(pr.pb, l.barcode) <= 1 WHERE {_FAIL} IS NULL)"""
_P = ["read_pairs", "protein_read_pairs", "spot_mask", "protein_list"]


def _hits(spark: SparkSession, d: str) -> DataFrame:
    return protein.protein_reads(view(spark, d, "protein_read_pairs"), view(spark, d, "spot_mask"), view(spark, d, "protein_list"), PROTEIN)


@query(_with(_P, _PR, _HITS) + "SELECT read_id, x, y, protein_index, umi FROM hits")
def protein_reads(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with a position and a protein."""
    return _hits(spark, d)


_COUNTS = "cnt AS (SELECT x, y, protein_index, umi, count(*) AS n FROM hits GROUP BY x, y, protein_index, umi)"
_RANKED = "ranked AS (SELECT *, row_number() OVER (PARTITION BY x, y, protein_index ORDER BY n DESC, reverse(translate(umi, 'ACTG', '0123')) DESC) AS rk, count(*) OVER (PARTITION BY x, y, protein_index) AS sz FROM cnt)"
_PARENTS = """par AS (SELECT a.x, a.y, a.protein_index, a.umi, a.n, a.rk, min(b.rk) AS parent FROM ranked a LEFT JOIN ranked b
 ON a.x = b.x AND a.y = b.y AND a.protein_index = b.protein_index AND b.rk < a.rk AND a.sz >= 5 AND hamming(a.umi, b.umi) <= 1 GROUP BY a.x, a.y, a.protein_index, a.umi, a.n, a.rk)"""
_TREE = """tree AS (SELECT x, y, protein_index, umi, rk, rk AS root, n FROM par WHERE parent IS NULL
 UNION ALL SELECT p.x, p.y, p.protein_index, p.umi, p.rk, t.root, p.n FROM par p JOIN tree t ON p.x = t.x AND p.y = t.y AND p.protein_index = t.protein_index AND p.parent = t.rk)"""
_COLLAPSED = """col AS (SELECT t.x, t.y, t.protein_index, r.umi, t.n FROM (SELECT x, y, protein_index, root, CAST(sum(n) AS BIGINT) AS n FROM tree GROUP BY x, y, protein_index, root) t
 JOIN ranked r ON t.x = r.x AND t.y = r.y AND t.protein_index = r.protein_index AND t.root = r.rk)"""


def _collapse_sql() -> str:
    return _with(_P, _PR, _HITS, _COUNTS, _RANKED, _PARENTS, _TREE, _COLLAPSED).replace("WITH ", "WITH RECURSIVE ", 1)


@query(_with(_P, _PR, _HITS, _COUNTS) + "SELECT * FROM cnt")
def umi_counts(spark: SparkSession, d: str) -> DataFrame:
    """Reads of each identifier."""
    return protein.umi_counts(_hits(spark, d))


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    return protein.umi_rank(protein.umi_counts(_hits(spark, d)))


@query(_with(_P, _PR, _HITS, _COUNTS, _RANKED) + "SELECT x, y, protein_index, umi, n, rk AS rank FROM ranked")
def umi_rank(spark: SparkSession, d: str) -> DataFrame:
    """Ranks of identifiers."""
    return _ranked(spark, d).select("x", "y", "protein_index", "umi", "n", F.col("rank").cast("long").alias("rank"))


def _collapsed(spark: SparkSession, d: str) -> DataFrame:
    return protein.umi_collapse(spark, _ranked(spark, d), 10)


@query(_collapse_sql() + "SELECT x, y, protein_index, umi, n FROM col")
def umi_collapse(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers after collapse."""
    return _collapsed(spark, d).select("x", "y", "protein_index", "umi", "n")


@query(_collapse_sql() + "SELECT protein_name AS geneID, x, y, count(*) AS MIDCount FROM col JOIN protein_list l ON col.protein_index = l.protein_index GROUP BY protein_name, x, y")
def gem(spark: SparkSession, d: str) -> DataFrame:
    """The count matrix."""
    return protein.gem(_collapsed(spark, d), view(spark, d, "protein_list"))


@query(_collapse_sql() + "SELECT y, x, protein_index, umi, n FROM col")
def gem_raw(spark: SparkSession, d: str) -> DataFrame:
    """The raw matrix."""
    return protein.gem_raw(_collapsed(spark, d)).withColumn("umi", sequence.decode("umi_code", 10)).select("y", "x", "protein_index", "umi", "n")


@query(_collapse_sql() + "SELECT count(*) AS unique_reads, CAST(sum(n) AS BIGINT) AS total_reads, round((1 - CAST(count(*) AS DOUBLE) / sum(n)) * 100, 4) AS duplication_pct FROM col")
def duplication_rate(spark: SparkSession, d: str) -> DataFrame:
    """Unique and total reads."""
    return protein.duplication(_collapsed(spark, d))


_PQ = ", ".join(f"CAST(sum(CASE WHEN {_FAIL} IS NULL THEN {_count_ge('substr(qual2,1,15)', f)} ELSE 0 END) AS BIGINT) AS protein_{q}" for q, f in R.QUALITY.items())


@query(
    _with(_P, f"pq AS (SELECT count(*) AS mapped, {_PQ} FROM (SELECT qual2, substr(seq1,26,10) AS umi, substr(qual1,26,10) AS umi_qual, substr(seq1,1,25) AS barcode FROM protein_read_pairs) z JOIN spot_mask s ON z.barcode = s.barcode)")
    + "SELECT *, " + ", ".join(f"{_pct(f'protein_{q}', '(mapped * 15)')} AS protein_{q}_pct" for q in R.QUALITY) + " FROM pq"
)
def protein_quality(spark: SparkSession, d: str) -> DataFrame:
    """Qualities of protein barcodes."""
    mapped = mapping.map_pairs(view(spark, d, "protein_read_pairs"), view(spark, d, "spot_mask"), PROTEIN)
    return protein.protein_quality(mapped, mapped, PROTEIN.protein)


_CODE = " + ".join(f"CAST(translate(substr(barcode,{i + 1},1),'ACTGN','01233') AS BIGINT) * {4**i}" for i in range(25))


@query(_with(["chip_mask"]) + f"SELECT barcode, {_CODE} AS code, barcode AS back FROM chip_mask")
def encode_decode(spark: SparkSession, d: str) -> DataFrame:
    """Codes of chip barcodes, and back."""
    return _mask(spark, d).select("barcode", sequence.encode("barcode").alias("code"), sequence.decode(sequence.encode("barcode"), 25).alias("back"))


@query(_with(["read_pairs"]) + "SELECT read_id, reverse(translate(seq1, 'ACGT', 'TGCA')) AS rc, translate(seq1, 'ACGT', 'TGCA') AS comp FROM read_pairs")
def reverse_complement(spark: SparkSession, d: str) -> DataFrame:
    """Reversed complements of first reads."""
    return _pairs(spark, d).select("read_id", sequence.reverse_complement("seq1").alias("rc"), sequence.complement("seq1").alias("comp"))


@query(_with(["chip_mask"]) + "SELECT x, y, x * 4294967296 + y AS code, CAST(x * 1099511627776 + (y % 16777216) * 65536 + rec_no % 65536 AS BIGINT) AS cell, concat(CAST(x AS VARCHAR),'_',CAST(y AS VARCHAR)) AS label FROM chip_mask")
def position_codes(spark: SparkSession, d: str) -> DataFrame:
    """Packed positions and cells, taken apart again for x and y."""
    code = sequence.pack_position("x", "y")
    x, y = sequence.unpack_position(code)
    cell = sequence.pack_cell("x", F.col("y") % 16777216, F.col("rec_no") % 65536)
    return _mask(spark, d).select(x.alias("x"), y.alias("y"), code.alias("code"), cell.alias("cell"), sequence.position_text("x", "y").alias("label"))


@query(_with(["read_pairs"]) + f"SELECT read_id, CASE WHEN {_NS.replace('barcode', 'substr(seq1,1,25)')} = 0 THEN -1 WHEN {_NS.replace('barcode', 'substr(seq1,1,25)')} = 1 THEN position('N' IN seq1) - 1 ELSE -2 END AS at FROM read_pairs")
def n_index(spark: SparkSession, d: str) -> DataFrame:
    """Place of the N in barcodes."""
    return _pairs(spark, d).select("read_id", sequence.n_index(F.substring("seq1", 1, 25)).alias("at"))


@query(_with(["read_pairs"]) + "SELECT read_id, length(qual2) - length(translate(qual2, '!\"#$%&''()*+,-./01234', '')) AS low FROM read_pairs")
def low_qual(spark: SparkSession, d: str) -> DataFrame:
    """Bases below quality 20."""
    return _pairs(spark, d).select("read_id", R.below(F.col("qual2")).alias("low"))


_P64 = "".join(map(chr, range(33, 127)))
_P33 = "".join(chr(max(33, c - 31)) for c in range(33, 127))


@query(_with(["read_pairs"]) + "SELECT read_id, translate(qual1, '{}', '{}') AS shifted FROM read_pairs".format(_P64.replace("'", "''"), _P33.replace("'", "''")))
def phred_shift(spark: SparkSession, d: str) -> DataFrame:
    """Qualities moved from offset 64 to 33."""
    return _pairs(spark, d).select("read_id", R.phred64_to_33(F.col("qual1")).alias("shifted"))


@query(_with(["read_pairs"]) + "SELECT read_id, regexp_extract(concat(name,':',substr(seq1,1,8),'+',substr(seq2,1,8)), '\\+([ACGTN]+)$', 1) AS last_index, substr(seq1,1,8) AS first_index FROM read_pairs")
def name_index(spark: SparkSession, d: str) -> DataFrame:
    """Indexes in names."""
    name = F.concat("name", F.lit(":"), F.substring("seq1", 1, 8), F.lit("+"), F.substring("seq2", 1, 8))
    return _pairs(spark, d).select("read_id", name.alias("n")).select("read_id", R.last_index(F.col("n")).alias("last_index"), R.first_index(F.col("n")).alias("first_index"))


@query(_with(["read_pairs"]) + "SELECT read_id, concat(name, chr(10), seq2, chr(10), '+', chr(10), qual2) AS record FROM read_pairs")
def fastq_records(spark: SparkSession, d: str) -> DataFrame:
    """FASTQ text of second reads."""
    return _pairs(spark, d).select("read_id", R.record(F.col("name"), F.col("seq2"), F.lit("+"), F.col("qual2")).alias("record"))


@query(
    _with(["read_pairs"])
    + "SELECT read_id, list_extract(string_split(read_id, ':'), 2) AS second, starts_with(name, '@FX') AS starts, suffix(name, '/1') AS ends, CASE WHEN suppkey % 7 = 0 THEN '0.0' ELSE printf('%.2f', round(CAST(prot AS DOUBLE) * 100 / (suppkey % 7), 2)) END AS pct FROM read_pairs"
)
def text_functions(spark: SparkSession, d: str) -> DataFrame:
    """Parts, tests and percent texts."""
    parts = text.tokens("read_id", ":")
    return _pairs(spark, d).select(
        "read_id",
        F.get(parts, F.lit(1)).alias("second"),
        text.starts_with("name", "@FX").alias("starts"),
        text.ends_with(text.trimmed("name"), "/1").alias("ends"),
        text.percent(F.col("prot"), F.col("suppkey") % 7).alias("pct"),
    )


_OVERLAP = """p AS (SELECT read_id, seq1 AS a, qual1 AS p, concat(substr(seq1,11,40), substr(seq2,1,10)) AS b, reverse(substr(qual2,1,50)) AS q FROM read_pairs),
o AS (SELECT *, unnest(generate_series(30, 50)) AS o FROM p),
d AS (SELECT *, list_filter(generate_series(1, o), lambda i: substr(a,50-o+i,1) <> substr(b,i,1)) AS d FROM o),
f AS (SELECT read_id, min(o) AS o FROM d WHERE len(d) < 3 AND len(list_filter(d, lambda i: NOT (substr(p,50-o+i,1) >= '?' AND substr(q,i,1) <= '0' OR substr(p,50-o+i,1) <= '0' AND substr(q,i,1) >= '?'))) = 0 GROUP BY read_id),
k AS (SELECT d.* FROM d JOIN f ON d.read_id = f.read_id AND d.o = f.o),
t AS (SELECT *, list_transform(generate_series(1, o), lambda i: CASE WHEN substr(p,50-o+i,1) >= '?' AND substr(q,i,1) <= '0' THEN substr(a,50-o+i,1) ELSE substr(b,i,1) END) AS bases,
 list_transform(generate_series(1, o), lambda i: CASE WHEN substr(a,50-o+i,1) = substr(b,i,1) THEN chr(ord(substr(p,50-o+i,1)) + ord(substr(q,i,1)) - 33)
 WHEN substr(p,50-o+i,1) >= '?' AND substr(q,i,1) <= '0' THEN substr(p,50-o+i,1) ELSE substr(q,i,1) END) AS quals FROM k)"""


@query(
    _with(["read_pairs"], _OVERLAP)
    + "SELECT read_id, CAST(o AS INT) AS overlap, CAST(len(d) AS INT) AS diff, concat(substr(a,1,50-o), array_to_string(bases,''), substr(b,o+1)) AS merged_seq, concat(substr(p,1,50-o), array_to_string(quals,''), substr(q,o+1)) AS merged_qual FROM t"
)
def pair_overlap_merge(spark: SparkSession, d: str) -> DataFrame:
    """Pairs whose ends overlap, merged; the second read is the fixture's first read's reversed complement, shifted and with its own qualities."""
    rc = sequence.reverse_complement(F.concat(F.substring("seq1", 11, 40), F.substring("seq2", 1, 10)))
    pairs = _pairs(spark, d).select("read_id", "seq1", "qual1", rc.alias("seq2"), F.substring("qual2", 1, 50).alias("qual2"))
    return mapping.overlap_merge(pairs).select("read_id", "overlap", "diff", "merged_seq", "merged_qual")


def queries() -> dict[str, Query]:
    """Name to query."""
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL."""
    return dict(ORACLES)
