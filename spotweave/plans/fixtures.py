"""The fixture views: sequencing inputs derived from the tables orders, lineitem, events and supplier.

The SQL runs unchanged in Spark and DuckDB. Views of read pairs are derived by column functions with the same rows
(``read_pairs``), for the SQL's plan maps letters one by one and is close to the size above which a JVM doesn't compile.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.functions.text import mapped

#: View to SQL over the base tables (the last one over ``read_pairs``).
SQL = {
    "chip_mask": """
SELECT substr(translate(md5(concat('cid:',CAST(o_orderkey AS STRING))),'0123456789abcdef','ACTGACTGACTGACTG'),1,25) AS barcode,
       CAST(o_orderkey % 1024 AS BIGINT) AS x, CAST(floor(o_orderkey/1024.0) AS BIGINT) AS y, CAST(o_orderkey AS BIGINT) AS rec_no
FROM orders
UNION ALL
SELECT concat(substr(b,1,24), translate(substr(b,25,1),'ACTG','TGAC')), x, y+100000, k+1000000000 FROM (
SELECT substr(translate(md5(concat('cid:',CAST(o_orderkey AS STRING))),'0123456789abcdef','ACTGACTGACTGACTG'),1,25) AS b, CAST(o_orderkey % 1024 AS BIGINT) AS x, CAST(floor(o_orderkey/1024.0) AS BIGINT) AS y, CAST(o_orderkey AS BIGINT) AS k
FROM orders WHERE o_orderkey % 10 = 0) s
""",
    "read_pairs": """
WITH base AS (
 SELECT concat(CAST(l_orderkey AS STRING),':',CAST(l_linenumber AS STRING),':',CAST(l_partkey AS STRING),':',CAST(l_suppkey AS STRING),':',CAST(CAST(l_quantity AS INT) AS STRING)) AS read_id, CAST((l_orderkey*7+l_linenumber) % 20 AS INT) AS cls,
  CAST(1+(l_orderkey+l_linenumber) % 25 AS INT) AS p, CAST(1+(l_orderkey+l_linenumber+7) % 25 AS INT) AS p2, CAST(1+(l_orderkey+l_linenumber+13) % 25 AS INT) AS p3,
  CAST(l_suppkey AS BIGINT) AS suppkey, CAST(l_partkey % 8 AS INT) AS prot,
  substr(translate(md5(concat('cid:',CAST(l_orderkey AS STRING))),'0123456789abcdef','ACTGACTGACTGACTG'),1,25) AS bc0,
  translate(md5(concat('rnd:',concat(CAST(l_orderkey AS STRING),':',CAST(l_linenumber AS STRING),':',CAST(l_partkey AS STRING),':',CAST(l_suppkey AS STRING),':',CAST(CAST(l_quantity AS INT) AS STRING)))),'0123456789abcdef','ACTGACTGACTGACTG') AS rnd,
  substr(translate(md5(concat('umi:',CAST(l_orderkey % 16 AS STRING))),'0123456789abcdef','ACTGACTGACTGACTG'),1,10) AS umi0,
  concat(md5(concat('q1:',concat(CAST(l_orderkey AS STRING),':',CAST(l_linenumber AS STRING),':',CAST(l_partkey AS STRING),':',CAST(l_suppkey AS STRING),':',CAST(CAST(l_quantity AS INT) AS STRING)))),md5(concat('q2:',concat(CAST(l_orderkey AS STRING),':',CAST(l_linenumber AS STRING),':',CAST(l_partkey AS STRING),':',CAST(l_suppkey AS STRING),':',CAST(CAST(l_quantity AS INT) AS STRING))))) AS qhex,
  CAST((l_orderkey+l_linenumber) % 9 AS INT) AS ucls
 FROM lineitem),
m1 AS (SELECT *, concat(substr(bc0,1,p-1), translate(substr(bc0,p,1),'ACTG','CTGA'), substr(bc0,p+1,25)) AS b1,
  concat(substr(bc0,1,p-1),'N',substr(bc0,p+1,25)) AS n1 FROM base),
m2 AS (SELECT *, concat(substr(b1,1,p2-1), translate(substr(b1,p2,1),'ACTG','CTGA'), substr(b1,p2+1,25)) AS b2,
  concat(substr(n1,1,p2-1),'N',substr(n1,p2+1,25)) AS n2 FROM m1),
m3 AS (SELECT *, concat(substr(b2,1,p3-1), translate(substr(b2,p3,1),'ACTG','CTGA'), substr(b2,p3+1,25)) AS b3 FROM m2),
f AS (SELECT *, CASE WHEN cls IN (10,11) THEN b1 WHEN cls=12 THEN b2 WHEN cls=13 THEN b3 WHEN cls=14 THEN n1 WHEN cls=15 THEN n2
   WHEN cls=16 THEN repeat('T',25) WHEN cls=17 THEN substr(rnd,1,25) ELSE bc0 END AS bc,
  CASE WHEN ucls=0 THEN concat(substr(umi0,1,9),translate(substr(umi0,10,1),'ACTG','CTGA')) WHEN ucls=1 AND cls=3 THEN 'AAAAAAAAAA' WHEN ucls=2 AND cls=4 THEN concat('N',substr(umi0,2,9)) ELSE umi0 END AS umi FROM m3)
SELECT read_id, concat('@FX:',read_id,'/1') AS name,
  concat(bc, umi, CASE WHEN cls=18 THEN concat('TGCCTCTCAG',substr(rnd,1,5)) ELSE substr(rnd,10,15) END) AS seq1,
  substr(translate(qhex,'0123456789abcdef','#+05:?DEFFFFGGHH'),1,50) AS qual1,
  concat(substr(translate(md5(concat('prot:',CAST(prot AS STRING))),'0123456789abcdef','ACTGACTGACTGACTG'),1,15), rnd, rnd) AS seq2,
  concat(translate(qhex,'0123456789abcdef','FEDC:?5+#GHIIIII'),substr(translate(qhex,'0123456789abcdef','FEDC:?5+#GHIIIII'),1,15)) AS qual2,
  suppkey, prot FROM f
""",
    "chip_mask_b": """
SELECT CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 7 = 0 THEN substr(translate(md5(concat('cid:',CAST(o_orderkey AS STRING))),'0123456789abcdef','ACTGACTGACTGACTG'),1,25)
       ELSE substr(translate(md5(concat('cid2:',CAST(o_orderkey AS STRING))),'0123456789abcdef','ACTGACTGACTGACTG'),1,25) END AS barcode,
       CAST(o_orderkey % 1024 + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS x,
       CAST(floor(o_orderkey/1024.0) AS BIGINT) AS y, CAST(o_orderkey AS BIGINT) AS rec_no
FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 5 = 0
""",
    "barcode_list": """
SELECT CAST(event_id % 3 AS INT) AS file_no, CAST(user_id % 16 AS BIGINT) AS x, CAST(floor(user_id/16.0) AS BIGINT) AS y, count(*) AS n FROM events GROUP BY 1,2,3
""",
    "protein_list": """
SELECT CAST(k AS INT) AS protein_index, substr(translate(md5(concat('prot:',CAST(k AS STRING))),'0123456789abcdef','ACTGACTGACTGACTG'),1,15) AS barcode, concat('P',CAST(k AS STRING)) AS protein_name FROM (SELECT DISTINCT l_partkey % 8 AS k FROM lineitem) d
""",
    "spot_mask": """
SELECT substr(translate(md5(concat('cid:',CAST(s_suppkey AS STRING))),'0123456789abcdef','ACTGACTGACTGACTG'),1,25) AS barcode, CAST(s_suppkey % 10 AS BIGINT) AS x, CAST(floor(s_suppkey/10.0) AS BIGINT) AS y FROM supplier
""",
    "protein_read_pairs": """
SELECT read_id, name, concat(substr(translate(md5(concat('cid:',CAST(suppkey AS STRING))),'0123456789abcdef','ACTGACTGACTGACTG'),1,25), substr(seq1,26,25)) AS seq1, qual1, seq2, qual2 FROM read_pairs
""",
}
#: Views that a view reads.
NEEDS = {"protein_read_pairs": ["read_pairs"]}
TABLES = ("orders", "lineitem", "events", "supplier")


def view(spark: SparkSession, sf_dir: str, name: str, kept: Column | None = None) -> DataFrame:
    """A fixture over the tables in ``sf_dir``, derived where it is read.

    Nothing is stored, so a query computes only the columns it reads. Spark merges no filter and no expression into
    columns that depend on the row's place; without that the view's nested expressions would be copied into
    every filter above them. ``kept``: a filter on plain columns, made before the other columns are computed.
    """
    rows = derived(spark, sf_dir, name)
    rows = rows if kept is None else rows.filter(kept)
    return rows.select(*[F.when(F.monotonically_increasing_id() >= 0, F.col(c)).alias(c) for c in rows.columns])


_HEX, _BASES = "0123456789abcdef", "ACTGACTGACTGACTG"


def _bases(key: Column, length: int) -> Column:
    """The first bases of a key's digest."""
    return mapped(F.substring(F.md5(key), 1, length), _HEX, _BASES)


def _few(prefix: str, number: Column, count: int, length: int) -> Column:
    """``_bases`` of a prefix and a number from 0 to ``count`` - 1, as literals."""
    texts = [hashlib.md5(f"{prefix}:{k}".encode()).hexdigest()[:length].translate(str.maketrans(_HEX, _BASES)) for k in range(count)]
    return F.get(F.array(*map(F.lit, texts)), number.cast("int"))


def read_pairs(lines: DataFrame, by_spot: bool = False) -> DataFrame:
    """The rows of ``SQL["read_pairs"]`` (or of ``protein_read_pairs``, by spot) from line items, whose keys are positive.

    Digests are made once, letters are mapped over whole Arrow columns, and a substitution is made where the row's class has it.
    """
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    place = lambda k: (1 + (key + line + k) % 25).cast("int")
    parts = [*[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], F.col("l_quantity").cast("int").cast("string")]
    glued = [x for p in parts for x in (F.lit(":"), p)][1:]
    rows = lines.select(
        F.concat(*glued).alias("read_id"), ((key * 7 + line) % 20).cast("int").alias("cls"), ((key + line) % 9).cast("int").alias("ucls"),
        place(0).alias("p"), place(7).alias("p2"), place(13).alias("p3"), key.alias("key"),
        F.col("l_suppkey").cast("bigint").alias("suppkey"), (F.col("l_partkey") % 8).cast("int").alias("prot"),
    )
    digest = lambda name: F.md5(F.concat(F.lit(f"{name}:"), "read_id"))
    rows = rows.withColumns({"qhex": F.concat(digest("q1"), digest("q2")), "umi0": _few("umi", F.col("key") % 16, 16, 10)})
    own = F.concat(F.lit("cid:"), F.col("suppkey" if by_spot else "key").cast("string"))
    rows = rows.withColumns(
        {
            "bc0": _bases(own, 25),
            "rnd": _bases(F.concat(F.lit("rnd:"), "read_id"), 32),
            "qual1": mapped(F.substring("qhex", 1, 50), _HEX, "#+05:?DEFFFFGGHH"),
            "q": mapped(F.col("qhex"), _HEX, "FEDC:?5+#GHIIIII"),
        }
    )
    # the three places of a row differ, so each substitution sees the letter of the whole barcode
    cls, n = F.col("cls"), F.lit("N")

    def put(text: Column, k: str, changed: tuple, lost: tuple = ()) -> Column:
        """``text`` with another letter at a place, or none, for classes of rows."""
        own = F.substr("bc0", F.col(k), F.lit(1))
        return F.overlay(text, F.when(cls.isin(*changed), F.translate(own, "ACTG", "CTGA")).when(cls.isin(*lost), n).otherwise(own), F.col(k), F.lit(1))

    barcode = put(put(put(F.col("bc0"), "p", (10, 11, 12, 13), (14, 15)), "p2", (12, 13), (15,)), "p3", (13,))
    barcode = F.when(cls == 16, F.lit("T" * 25)).when(cls == 17, F.substring("rnd", 1, 25)).when(cls.between(10, 15), barcode).otherwise(F.col("bc0"))
    ucls, umi0 = F.col("ucls"), F.col("umi0")
    umi = F.when(ucls == 0, F.concat(F.substring(umi0, 1, 9), F.translate(F.substring(umi0, 10, 1), "ACTG", "CTGA")))
    umi = umi.when((ucls == 1) & (cls == 3), F.lit("A" * 10)).when((ucls == 2) & (cls == 4), F.concat(n, F.substring(umi0, 2, 9))).otherwise(umi0)
    tail = F.when(cls == 18, F.concat(F.lit("TGCCTCTCAG"), F.substring("rnd", 1, 5))).otherwise(F.substring("rnd", 10, 15))
    return rows.select(
        "read_id",
        F.concat(F.lit("@FX:"), "read_id", F.lit("/1")).alias("name"),
        F.concat(F.col("bc0") if by_spot else barcode, umi, tail).alias("seq1"),
        "qual1",
        F.concat(_few("prot", F.col("prot"), 8, 15), "rnd", "rnd").alias("seq2"),
        F.concat("q", F.substring("q", 1, 15)).alias("qual2"),
        *([] if by_spot else ["suppkey", "prot"]),
    )


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a query over the tables in ``sf_dir``."""
    if name.endswith("read_pairs"):
        return read_pairs(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), by_spot=name.startswith("protein"))
    parts = {x: spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in TABLES if f"FROM {x}" in SQL[name]}
    parts |= {x: derived(spark, sf_dir, x) for x in NEEDS.get(name, [])}
    text = SQL[name]
    for x in parts:
        text = text.replace(f"FROM {x}", f"FROM {{{x}}}")
    return spark.sql(text, **parts)


def ctes(*names: str) -> str:
    """The WITH clause (without the word) that defines fixtures, with those they read."""
    order: list[str] = []
    for n in names:
        order += [x for x in [*NEEDS.get(n, []), n] if x not in order]
    return ",\n".join(f"{n} AS ({SQL[n].strip()})" for n in order)
