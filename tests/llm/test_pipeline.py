"""The pipeline, stage by stage and as a whole, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from spotweave.llm import neardup, quality, queries, secrets

TABLES = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_ids():
    """Null ids, an id with two texts, repeated rows, and near copies within and across ids."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(120))
    near = text(1).replace("w1x60", "changed")
    rows = [(None, text(0)), (None, text(0)), (None, text(8)), (None, None), (1, text(1)), (2, text(2)), (2, text(3)), (3, text(4)), (3, text(4))]
    rows += [(4, near), (5, text(5)), (5, text(5).upper()), (6, text(3)), (7, None), (7, None), (8, None), (9, text(6)), (9, near)]
    return [(i, t, "en", "a", len(t or "")) for i, t in rows]


def near_duplicate_brute(rows):
    """Ids and lower-cased texts that stay."""
    def shingles(t):
        w = (t or "").lower().split()
        return frozenset(zip(*[w[k:] for k in range(5)]))

    named = sorted({(i, t or "") for i, t in rows if i is not None})
    groups = []
    for row in named:
        own = shingles(row[1])
        met = [g for g in groups if any(own and 100 * len(own & s) >= 80 * len(own | s) for s in map(shingles, (r[1] for r in g)))]
        groups = [g for g in groups if g not in met] + [[row] + [r for g in met for r in g]]
    kept = [min(g, key=lambda r: r[0]) for g in groups]
    return sorted([(i, t.lower()) for i, t in kept] + [(-1, (t or "").lower()) for i, t in rows if i is None])


def test_near_duplicate_stage_with_odd_ids(spark):
    every = odd_ids()
    for rows in (every, [r for k, r in enumerate(every) if r[0] is None or r[0] not in {x[0] for x in every[:k]}]):
        got = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, SCHEMA), TABLES).collect()
        want = near_duplicate_brute([r[:2] for r in rows])
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], (r["text"] or "").lower()) for r in got) == want


def test_row_stages_with_odd_ids(spark):
    docs = spark.createDataFrame(odd_ids(), SCHEMA)
    assert sorted(map(str, corpus_pipeline.secrets_stage(spark, docs, TABLES).collect())) == sorted(map(str, docs.collect()))
    mixed = corpus_pipeline.mixing_stage(spark, docs, TABLES)
    assert mixed.columns == docs.columns and mixed.exceptAll(docs.union(docs).union(docs).union(docs).union(docs).union(docs)).count() == 0
    packed = corpus_pipeline.packing_stage(spark, docs, TABLES)
    assert packed.filter("doc_id is null").count() == 4
    assert packed.count() == docs.count()


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, TABLES).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
        if k < 4:
            assert docs.columns == columns
        if k == 2:
            assert docs.filter(F.col("text").rlike(r"(?i:token)\s*=\s*\"[0-9a-f]{16}")).count() == 0
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality_brute(docs, trusted):
    """Ids that the quality rules keep."""
    import xxhash

    def number(*parts):
        seed = 42
        for p in parts:
            seed = xxhash.xxh64(p.encode() if isinstance(p, str) else int(p).to_bytes(4, "little"), seed=seed).intdigest()
        return (seed - (1 << 64) if seed >> 63 else seed) % 10_000

    found = {i: [number(x) for x in w] + [number(2, x[-2:]) for x in w] + [number(*p) for p in zip(w, w[1:])] for i, w in ((i, words(t)) for i, (t, *_) in docs.items())}
    raw, target = Counter(), Counter()
    for i, g in found.items():
        raw.update(g)
        target.update(g if i in trusted else ())
    n_raw, n_target = sum(raw.values()) + 10_000, sum(target.values()) + 10_000
    ratio = {b: round(math.log((target[b] + 1) / n_target / ((raw[b] + 1) / n_raw)) * quality.SCALE) for b in raw}
    kept = set()
    for i, (t, *_) in docs.items():
        w = words(t)
        at = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        marked = {k + j for k in range(len(w) - 4) if at[tuple(w[k : k + 5])] > 1 for j in range(5)}
        if len(w) >= 10 and 100 * len(marked) <= 20 * len(w) and sum(ratio[x] for x in found[i]) / (len(found[i]) * quality.SCALE) >= -0.35:
            kept.add(i)
    return kept


def components_brute(texts, percent):
    """Smallest id of each id's near-duplicate component."""
    sets = {}
    for i, t in texts.items():
        w = words((t or "").translate(LOWER))
        sets[i] = frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for x in sets[i] for j in holders[x])
        for x in sets[i]:
            holders[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return {i: find(i) for i in sets}


def redacted_brute(docs):
    """Texts with secrets replaced."""
    patterns = [(re.compile(p), g, n) for _, p, g, n in secrets.BASE]
    wide = re.compile(secrets.WIDE)
    spans, holders = {}, defaultdict(set)
    for i, (t, lang, source) in docs.items():
        base = [(m.start(), k, m.end(), m[g]) for k, (p, g, n) in enumerate(patterns) for m in p.finditer(t or "") if len(m[g]) >= n]
        more = [(m.start(), 3, m.end(), m[0]) for m in wide.finditer(t or "") if not any(a <= m.start() and m.end() <= b for a, _, b, _ in base)]
        spans[i] = sorted(base + more)
        for *_, v in spans[i]:
            holders[v].add((source, f"{source}/{lang}"))
    out = {}
    for i, (t, *_) in docs.items():
        live = lambda v: len({o for o, _ in holders[v]}) < 2 and len(holders[v]) < 3
        runs = []
        for a, k, b, v in spans[i]:
            if k == 3 and not live(v):
                continue
            if runs and a < runs[-1][1]:
                runs[-1] = [runs[-1][0], max(b, runs[-1][1]), runs[-1][2] or live(v)]
            else:
                runs.append([a, b, live(v)])
        at, parts = 0, []
        for a, b, alive in runs:
            parts += [t[at:a], "<SECRET>" if alive else "<SECRET_EXAMPLE>"]
            at = b
        out[i] = "".join(parts) + (t or "")[at:] if runs else t
    return out


def copies_brute(docs):
    """Copies of each id after mixing by the square root of its source's size."""
    sizes = Counter(source for _, _, source in docs.values())
    total = sum(math.sqrt(n) for n in sizes.values())
    out = {}
    for i, (_, _, source) in docs.items():
        rate = len(docs) * math.sqrt(sizes[source]) / total / sizes[source]
        u = int(hashlib.md5(f"mix-1\x1f{i}".encode()).hexdigest()[:13], 16) / 2**52
        chance = below = math.exp(-rate)
        out[i] = 0
        while below <= u:
            out[i] += 1
            chance *= rate / out[i]
            below += chance
    return out


def test_pipeline_against_brute_force(spark):
    from tokenizers import Tokenizer

    rows = spark.read.parquet(f"{TABLES}/documents.parquet").collect()
    docs = {r["doc_id"]: (r["text"], r["lang"], r["source"] or "\x00null") for r in rows}
    assert len(docs) == len(rows)
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{TABLES}/labels.parquet").filter("quality = 1 and toxic = 0").collect()}
    good = quality_brute(docs, trusted)
    docs = {i: d for i, d in docs.items() if i in good}
    label = components_brute({i: t for i, (t, *_) in docs.items()}, 80)
    docs = {i: d for i, d in docs.items() if label[i] == i}
    text, times = redacted_brute(docs), copies_brute(docs)
    plain, want = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json")), Counter()
    for i, t in text.items():
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[(i, k, at, len(part), zlib.crc32(part.tobytes()))] += times[i]
    got = corpus_pipeline.run(spark, TABLES).collect()
    assert Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got) == +want
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        ends = [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 4096


def test_near_duplicate_recall(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = components_brute({r["doc_id"]: r["text"] for r in docs.collect()}, 80)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark, docs, percent=80).collect()}
    assert got == want and len(set(want.values())) < len(want)
