"""Language identification by interpolated Kneser-Ney character models.

Letters are lower-cased and composed, and each keeps its own UTF-16 code (two for a letter beyond
U+FFFF); everything else is one boundary symbol. An n-gram of four symbols is exactly a 64-bit
number. The counts of four-grams cover all training text; the lower orders are the Kneser-Ney
continuation counts of the order above. Counts and probabilities are DataFrames, with a row for each
n-gram that a language has; they end as sorted arrays of n-gram codes, which grow with the
vocabulary of the training text. A text gets the language with the lowest mean cross-entropy;
the scale of the scores and the limits of rejection are calibrated.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotweave.llm.common import intermediates, stored

ORDER = 4
BITS = 16
MASK = (1 << BITS) - 1
#: Text handled at once in a task, in code points.
CHUNK = 2_000_000
#: Symbols beyond which a longer text is no surer.
LONGEST = 200
#: Numbers (four bytes each) up to which tables are kept for all languages side by side.
DENSE = 40_000_000


def symbols(text: str) -> np.ndarray:
    """Symbols of a text: the UTF-16 codes of its lower-cased, composed letters; the rest is 0 and never repeated.

    Marks belong to the letter before them; without one they are no letters.
    """
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out = np.zeros(len(points), dtype=np.uint64)
    small = (points >= 97) & (points <= 122)
    out[small] = points[small]
    other = np.flatnonzero(points >= 0xAA)
    if len(other):
        kinds, back = np.unique(points[other], return_inverse=True)
        letters = np.array([p if chr(p).isalpha() else 0 for p in kinds.tolist()], dtype=np.uint64)
        out[other] = letters[back]
        marks = np.array([unicodedata.category(chr(p))[0] == "M" for p in kinds.tolist()])
        if marks.any():
            mark = np.zeros(len(points), dtype=bool)
            mark[other] = marks[back]
            base = np.maximum.accumulate(np.where(mark, 0, np.arange(len(points))))
            held = mark & (out[base] != 0)
            out[held] = points[held]
        wide = out > 0xFFFF
        if wide.any():
            at = np.cumsum(1 + wide) - 1 - wide
            full = np.zeros(len(out) + int(wide.sum()), dtype=np.uint64)
            full[at] = np.where(wide, 0xD7C0 + (out >> 10), out)
            full[at[wide] + 1] = 0xDC00 + (out[wide] & 0x3FF)
            out = full
    if not out.any():
        return out[:0]
    out = np.concatenate([[0], out, [0]]).astype(np.uint64)
    return out[np.concatenate([[True], (out[1:] != 0) | (out[:-1] != 0)])]


def grams(codes: np.ndarray) -> np.ndarray:
    """Code of the ORDER symbols that end at each symbol after the first (boundaries before the text)."""
    padded = np.concatenate([np.zeros(ORDER - 2, dtype=np.uint64), codes])
    n = len(padded) - ORDER + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(ORDER):
        out = out << BITS | padded[k : k + n]
    return out


def _count(batches: Iterator) -> Iterator:
    """Counts of four-grams by language, one set for each task and ten million symbols."""
    import pyarrow as pa

    held: dict[str, list[np.ndarray]] = {}
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def merge(lang: str) -> None:
        keys, counts = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
        if lang in sums:
            k, c = sums[lang]
            both, back = np.unique(np.concatenate([k, keys]), return_inverse=True)
            counts = np.bincount(back, weights=np.concatenate([c, counts])).astype(np.int64)
            keys = both
        sums[lang] = keys, counts

    for batch in batches:
        sizes: dict[str, int] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            got = grams(symbols(text))
            held.setdefault(lang, []).append(got)
            sizes[lang] = sizes.get(lang, 0) + len(got)
            if sizes[lang] > CHUNK:
                merge(lang)
                sizes[lang] = 0
        for lang in list(held):
            merge(lang)
    for lang, (keys, counts) in sums.items():
        for at in range(0, len(keys), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(keys[part]), "gram": keys[part].view(np.int64), "n": counts[part].astype(np.int64)}
            )


@dataclass
class Table:
    """Values of (code, language) pairs: sorted ``codes``; pairs ``first[i]`` to ``first[i + 1]`` are those of code i."""

    codes: np.ndarray
    first: np.ndarray
    langs: np.ndarray
    values: np.ndarray

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each code's pairs: place of the code in ``codes``, language, value."""
        if not len(self.codes):
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = np.flatnonzero(self.codes[at] == codes)
        begin = self.first[at[hit]]
        many = self.first[at[hit] + 1] - begin
        pair = np.arange(many.sum()) + np.repeat(begin - np.cumsum(many) + many, many)
        return np.repeat(hit, many), self.langs[pair], self.values[pair]


@dataclass
class Models:
    """Log probabilities (base 2) of n-grams for all languages.

    ``grams[k]``: for (k+1)-grams the interpolated log probability of the last symbol, where the
    language has the n-gram; ``backs[k]``: log weight of backing off from contexts of k+1 symbols;
    ``floor``: log probability of a symbol that a language doesn't have.
    """

    languages: list[str]
    grams: list[Table]
    backs: list[Table]
    floor: np.ndarray
    scale: float = 1.0
    limits: np.ndarray | None = None
    dense: list[np.ndarray] | None = None

    def plain(self) -> dict:
        """All of it as plain arrays, for a broadcast: executors may lack this package."""
        bare = lambda tables: [(t.codes, t.first, t.langs, t.values) for t in tables]
        return {**vars(self), "grams": bare(self.grams), "backs": bare(self.backs)}

    @classmethod
    def of(cls, plain: dict) -> Models:
        """Models of what ``plain`` gave."""
        whole = lambda tables: [Table(*t) for t in tables]
        return cls(**{**plain, "grams": whole(plain["grams"]), "backs": whole(plain["backs"])})

    def densified(self) -> Models:
        """With all languages' log probabilities beside every n-gram that any has, if they are at most DENSE numbers: scores are the same, found faster."""
        if sum(len(c) for c in self.codes) * len(self.languages) <= DENSE:
            self.dense = [np.concatenate([self._sparse(c[at : at + CHUNK // 4], k) for at in range(0, len(c), CHUNK // 4)]).astype(np.float32) for k, c in enumerate(self.codes)]
        return self

    @property
    def codes(self) -> list[np.ndarray]:
        """Sorted codes of the n-grams of each order."""
        return [t.codes for t in self.grams]

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of each n-gram's last symbol in each language."""
        if self.dense is None:
            return self._sparse(codes, ORDER - 1)
        out = np.zeros((len(codes), len(self.languages)))
        codes, todo = codes.astype(np.uint64), np.arange(len(codes))
        for k in range(ORDER - 1, -1, -1):
            part, table = codes[todo] & ((1 << BITS * (k + 1)) - 1), self.grams[k].codes
            at = np.minimum(np.searchsorted(table, part), len(table) - 1)
            hit = table[at] == part
            out[todo[hit]] += self.dense[k][at[hit]]
            todo, part = todo[~hit], part[~hit]
            if not len(todo):
                return out
            if k:
                row, lang, value = self.backs[k - 1].find(part >> BITS)
                out[todo[row], lang] += value
        out[todo] += self.floor
        return out

    def _sparse(self, codes: np.ndarray, order: int) -> np.ndarray:
        """The same for n-grams of ``order`` + 1 symbols, language by language from the tables."""
        out = np.zeros((len(codes), len(self.languages)))
        codes, todo = codes.astype(np.uint64), np.arange(len(codes))
        open_ = np.ones(out.shape, dtype=bool)
        for k in range(order, -1, -1):
            part = codes[todo] & ((1 << BITS * (k + 1)) - 1)
            row, lang, value = self.grams[k].find(part)
            row = todo[row]
            new = open_[row, lang]
            out[row[new], lang[new]] += value[new]
            open_[row, lang] = False
            rest = open_[todo].any(axis=1)
            todo, part = todo[rest], part[rest]
            if not len(todo):
                return out
            if k:
                row, lang, value = self.backs[k - 1].find(part >> BITS)
                row = todo[row]
                left = open_[row, lang]
                out[row[left], lang[left]] += value[left]
        return out + open_ * self.floor

    def entropies(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For each text (its symbols, some at least): mean bits of a symbol in each language, and how many symbols were judged."""
        step = max(1, CHUNK // len(self.languages))
        total, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), dtype=np.int64)
        held: list[tuple[int, np.ndarray]] = []

        def flush() -> None:
            if held:
                found = self.scores(np.concatenate([g for _, g in held]))
                starts = np.cumsum([0, *(len(g) for _, g in held[:-1])])
                np.add.at(total, [i for i, _ in held], np.add.reduceat(found, starts, axis=0))
                held.clear()

        size = 0
        for i, codes in enumerate(texts):
            every = grams(codes)
            n[i] = len(every)
            for at in range(0, len(every), step):
                part = every[at : at + step]
                if size + len(part) > step:
                    flush()
                    size = 0
                held.append((i, part))
                size += len(part)
        flush()
        return -total / np.maximum(n, 1)[:, None], n


def _table(found: DataFrame, languages: list[str]) -> Table:
    """The table of rows ``gram``, ``lang``, ``value``."""
    got = found.toArrow()
    code = got.column("gram").to_numpy().view(np.uint64)
    number = {x: i for i, x in enumerate(languages)}
    names = got.column("lang").combine_chunks().dictionary_encode() if got.num_rows else None
    lang = np.array([number[x] for x in names.dictionary.to_pylist()], dtype=np.int64)[names.indices.to_numpy()] if got.num_rows else np.zeros(0, dtype=np.int64)
    order = np.lexsort((lang, code))
    codes, first = np.unique(code[order], return_index=True)
    return Table(codes, np.append(first, len(code)), lang[order].astype(np.int32), got.column("value").to_numpy()[order].astype(np.float32))


def kneser_ney(spark: SparkSession, counted: DataFrame, discount: float = 0.75) -> Models:
    """Models from the four-gram counts (``lang``, ``gram``, ``n``).

    Orders below the highest count the distinct symbols before an n-gram. The unigrams are
    interpolated with the uniform distribution over the symbols.
    """
    lower = lambda k: F.col("gram").bitwiseAND(F.lit((1 << BITS * k) - 1))
    levels = [counted]
    for k in range(ORDER - 1, 0, -1):
        fewer = levels[0].select("lang", lower(k).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("n"))
        levels.insert(0, stored(spark, fewer, "language-counts"))
    languages = sorted(r["lang"] for r in levels[0].select("lang").distinct().collect())
    uniform, below, tables, backs, floor = 1.0 / (MASK + 1), None, [], [], np.zeros(len(languages))
    for k, level in enumerate(levels):
        level = level.withColumn("context", F.shiftrightunsigned("gram", BITS))
        sums = level.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        sums = sums.select("lang", "context", "total", (F.lit(discount) * F.col("kinds") / F.col("total")).alias("back"))
        rows, base = level.join(sums, ["lang", "context"]), F.lit(uniform)
        if below is not None:
            rows = rows.withColumn("suffix", lower(k)).join(below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("base")), ["lang", "suffix"])
            base = F.col("base")
        chance = F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total") + F.col("back") * base
        below = stored(spark, rows.select("lang", "gram", chance.alias("p")), "language-chances")
        tables.append(_table(below.select("gram", "lang", F.log2("p").cast("float").alias("value")), languages))
        weight = sums.select(F.col("context").alias("gram"), "lang", F.log2("back").cast("float").alias("value"))
        if k:
            backs.append(_table(weight, languages))
        else:
            first = {r["lang"]: r["value"] for r in weight.collect()}  # a row for each language
            floor = np.array([first[x] + np.log2(uniform) for x in languages])
    return Models(languages, tables, backs, floor).densified()


def has_letter(text: str) -> bool:
    """Whether a text has a letter of any script."""
    return any(c.isalpha() for c in text)


def judge(models: Models, texts: list[str | None]) -> list[tuple[str, float, bool, float]]:
    """Language, score from 0 to 1, whether it is rejected, and bits a symbol, of each text."""
    out: list[tuple[str, float, bool, float]] = [("und", 0.0, True, 0.0)] * len(texts)
    if not models.languages:
        return out
    rows, coded = [], []
    for i, t in enumerate(texts):
        if t is None:
            continue
        codes = symbols(t)
        if len(codes) or has_letter(t):
            rows.append(i)
            coded.append(codes if len(codes) else np.zeros(1, dtype=np.uint64))
    if not rows:
        return out
    bits, n = models.entropies(coded)
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(rows)), best]
    odds = np.exp2(-(bits - least[:, None]) * (models.scale * np.clip(n, 1, LONGEST))[:, None])
    limits = models.limits if models.limits is not None else np.full(len(models.languages), np.inf)
    for i, k, score, b in zip(rows, best.tolist(), (1 / odds.sum(axis=1)).tolist(), least.tolist(), strict=True):
        out[i] = (models.languages[k], score, bool(b > limits[k]), b)
    return out


def _judged(batches: Iterator, models: Models) -> Iterator[tuple]:
    """Record batches and what is judged of their first column, a bounded number of characters at a time."""
    for batch in batches:
        texts, found = batch.column(0).to_pylist(), []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < CHUNK // 4:
                size += len(texts[end] or "")
                end += 1
            found += judge(models, texts[at:end])
            at = end
        yield batch, found


def _calibrated(models: Models, langs: list[str], bits: np.ndarray, n: np.ndarray) -> None:
    """Set the limits, and the scale under which the scores of the sample are likeliest."""
    own = np.array([models.languages.index(x) for x in langs])
    mine = bits[np.arange(len(own)), own]
    right = bits.argmin(axis=1) == own
    limits = [mine[right & (own == k)] for k in range(len(models.languages))]
    models.limits = np.array([np.quantile(x, 0.999) + 0.5 if len(x) else np.inf for x in limits])
    apart = -(bits - mine[:, None]) * np.clip(n, 1, LONGEST)[:, None]
    loss = {scale: float(np.logaddexp2.reduce(scale * apart, axis=1).mean()) for scale in 2.0 ** np.arange(-8, 1)}
    models.scale = min(loss, key=loss.get)


def train(spark: SparkSession, docs: DataFrame, lang_col: str = "lang", text_col: str = "text", calibration: int = 200) -> Models:
    """Models of every language in ``docs`` (rows with null language or text are left out).

    Counts cover every row. The scale of the scores and each language's limit of rejection
    are calibrated on ``calibration`` distinct whole texts of each language, those with the lowest hashes:
    the limit is the 99.9th percentile of the cross-entropy in the own language, and half a bit.
    Texts are judged where they are; only entropies come to the driver.
    """
    with intermediates(spark):
        return _trained(spark, docs, lang_col, text_col, calibration)


def _trained(spark: SparkSession, docs: DataFrame, lang_col: str, text_col: str, calibration: int) -> Models:
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    counted = known.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = stored(spark, counted, "language-counts")
    if counted.limit(1).count() == 0:  # nothing to learn from: every text is und
        return Models([], [], [], np.zeros(0))
    models = kneser_ney(spark, counted)
    # hashes alone are ranked; each task keeps its lowest of a language before they meet
    hashed = known.withColumn("h", F.xxhash64("text"))
    # equal texts are one, so that copies can't fill the sample
    lowest = hashed.select("lang", "h").distinct().withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("k") <= calibration)
    lowest = lowest.groupBy("lang").agg(F.max("h").alias("cut"))
    # a row for each language is broadcast, of which the driver has a list
    chosen = hashed.join(F.broadcast(lowest), "lang").filter("h <= cut").groupBy("lang", "h").agg(F.first("text").alias("text"))
    shared = spark.sparkContext.broadcast(models.plain())

    def entropies(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held = Models.of(shared.value)
        for batch in batches:
            texts = [symbols(t) for t in batch.column("text").to_pylist()]
            some = [i for i, t in enumerate(texts) if len(t)]
            if some:
                bits, n = held.entropies([texts[i] for i in some])
                yield pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(some)), pa.array(bits.tolist(), pa.list_(pa.float64())), pa.array(n)], names=["lang", "bits", "n"])

    sample = chosen.mapInArrow(entropies, "lang string, bits array<double>, n long").collect()  # calibration rows for each language
    if sample:
        _calibrated(models, [r["lang"] for r in sample], np.array([r["bits"] for r in sample]), np.array([r["n"] for r in sample]))
    return models


def identify(spark: SparkSession, docs: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score``, ``lang_rejected`` and ``lang_bits``.

    A null text, or one without a letter, is ``und`` with score 0. A rejected text still names
    the nearest language: its cross-entropy is beyond what training texts of that language
    have. The whole text is read. Each row is judged by itself.
    """
    shared = spark.sparkContext.broadcast(models.plain())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch, found in _judged(batches, Models.of(shared.value)):
            cols = list(zip(*found, strict=True)) if found else [[], [], [], []]
            kinds = [pa.string(), pa.float64(), pa.bool_(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                names=[*batch.schema.names[1:], "lang_pred", "lang_score", "lang_rejected", "lang_bits"],
            )

    rest = [c for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_rejected", "lang_bits")]
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in rest)
    made = "lang_pred string, lang_score double, lang_rejected boolean, lang_bits double"
    return docs.select(F.col(text_col).alias("_judged_text"), *rest).mapInArrow(run, f"{schema}, {made}")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
