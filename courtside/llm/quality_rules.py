"""Quality rules: base rules, then robust multivariate outliers per language and source.

Statistics of each text that passes the base rules become a vector; a deterministic minimum-covariance-determinant
estimate for each group gives location and scatter, and vectors too far off by Mahalanobis distance are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from courtside.llm.common import hashed_words, passes, range_hashes, save, slices, utf8, word_spans

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REPEAT_WINDOW = 3
SYMBOLS = b"#*$%&|<>"

#: Groups with fewer vectors than this are estimated together.
MIN_ROWS = 200
#: Share of a group's vectors that the estimate rests on, rounded up to a whole bin of distances.
HALF = 0.75
STEPS = 6
#: Distances are binned at this many steps in a unit of their logarithm.
DISTANCE_BINS = 16
MEDIAN_BINS = 200
#: Least standard deviation of each feature: what is less never tells junk from text.
FLOORS = np.array([0.04, 0.07, 0.25, 0.1, 0.4])
FEATURES = ["log_word_length", "root_symbols", "log_dup_lines", "root_repeats", "log_words"]
# Of chi-square with 5 degrees of freedom: the quantiles at 0.975 and 1 - 1e-9, and what makes the covariance
# of the nearest 75 % and 97.5 % of normal vectors consistent.
NEAR, FAR = 12.83, 50.7
FACTOR_HALF, FACTOR_NEAR = 1.41, 1.06

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_counts(texts: list[bytes]) -> np.ndarray:
    """COUNTS of each text, in columns."""
    data, starts, ends, first = word_spans(texts)
    in_words = lambda mark: np.concatenate([[0], np.cumsum(mark)])
    characters = in_words((data & 0xC0) != 0x80)
    per_word = characters[ends] - characters[starts]
    symbols = in_words(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)))
    limits = np.cumsum([1, *(len(x) + 1 for x in texts)])
    count = np.diff(first)
    words = hashed_words(data, starts, ends, False)
    total = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[first])
    windows = np.maximum(count - REPEAT_WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(texts)), windows)
    begins = np.cumsum(windows) - windows
    at = first[:-1][owner] + np.arange(len(owner)) - begins[owner]
    hashes = range_hashes(words, at, at + REPEAT_WINDOW)
    order = np.lexsort((hashes, owner))
    same = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(owner) + 1, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    repeated = np.zeros(len(words), bool)
    for k in range(REPEAT_WINDOW):
        repeated[at[twice[:-1]] + k] = True
    duplicates = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
        duplicates[i] = len(lines) - len(set(lines))
    return np.column_stack([count, total(per_word), np.diff(symbols[limits]), duplicates, total(repeated)])


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add COUNTS and base_failed to the other columns of docs, without the text."""
    rest = [c for c in docs.columns if c not in (text, *COUNTS, "base_failed")]
    schema = T.StructType([*docs.select(rest).schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch.column(0))
            for a, b in passes(texts):
                columns = [*(x.slice(a, b - a) for x in batch.columns[1:]), *map(pa.array, text_counts(texts[a:b]).T.copy())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return docs.select(text, *rest).mapInArrow(run, schema).withColumn("base_failed", failed)


def features() -> list[Column]:
    """The vector of a text that has words."""
    words = F.col("n_words").cast("double")
    return [
        F.log(F.col("word_chars") / words), F.sqrt(F.col("n_symbols") / words), F.log1p(F.col("n_dup_lines").cast("double")),
        F.sqrt(F.col("n_repeat_words") / words), F.log(words),
    ]


_MOMENTS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
_PARAMS = "group string, start int, size long, mean array<double>, inverse array<double>, logdet double"


def _fitted(sums: pd.DataFrame, factor: float) -> pd.DataFrame:
    """Parameters from sums of vectors and of their products."""
    d, rows = len(FEATURES), []
    for r in sums.itertuples():
        mean = np.array(r.total) / r.n
        scatter = np.zeros((d, d))
        for (i, j), x in zip(_MOMENTS, r.products):
            scatter[i, j] = scatter[j, i] = x / r.n - mean[i] * mean[j]
        scatter = factor * scatter + np.diag(FLOORS**2)
        rows.append((r.group, r.start, r.size, mean.tolist(), np.linalg.inv(scatter).ravel().tolist(), float(np.linalg.slogdet(scatter)[1])))
    return pd.DataFrame(rows, columns=["group", "start", "size", "mean", "inverse", "logdet"])


def _sums() -> list[Column]:
    """Aggregates for _fitted over the column v."""
    each = lambda values: F.array(*(F.sum(x) for x in values))
    v = lambda i: F.get("v", F.lit(i))
    return [F.count("*").alias("n"), each([v(i) for i in range(len(FEATURES))]).alias("total"), each([v(i) * v(j) for i, j in _MOMENTS]).alias("products")]


def _params(sums: DataFrame, factor: float) -> DataFrame:
    return sums.mapInPandas(lambda parts: (_fitted(x, factor) for x in parts), _PARAMS)


def _distance() -> tuple[Column, Column]:
    """What v is off the mean, as a column `off`, and from it the squared Mahalanobis distance."""
    d = len(FEATURES)
    off = F.zip_with("v", "mean", lambda a, b: a - b)
    terms = [F.get("off", F.lit(i)) * F.get("off", F.lit(j)) * F.get("inverse", F.lit(i * d + j)) for i in range(d) for j in range(d)]
    return off, sum(terms[1:], terms[0])


def _measured(vectors: DataFrame, params: DataFrame) -> DataFrame:
    off, distance = _distance()
    return vectors.join(params, "group").withColumn("off", off).withColumn("distance", distance)


def _added(column: str, size: int) -> Column:
    """Element-wise sum of an array column."""
    return F.array(*(F.sum(F.get(column, F.lit(i))) for i in range(size))).alias(column)


def estimates(vectors: DataFrame) -> DataFrame:
    """Location and scatter (group, mean, inverse) for each group of (group, v) rows.

    From two starts, the medians with absolute deviations and the plain mean with covariance, concentration steps take the
    moments of the nearest HALF of a group's vectors; the start with the smaller determinant wins and is
    refitted on all vectors that are near by it. A step is one aggregation by group and bin of distance, so no
    group's vectors meet in one task.
    """
    d = len(FEATURES)
    place = F.posexplode("v").alias("i", "x")
    binned = lambda rows: rows.groupBy("group", "i", F.floor(F.col("x") * MEDIAN_BINS).alias("bin")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("group", "i").orderBy("bin")
    all_ = Window.partitionBy("group", "i")

    def medians(rows: DataFrame, name: str) -> DataFrame:
        ranked = binned(rows).withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(all_))
        middle = ranked.where(F.col("upto") * 2 >= F.col("all")).groupBy("group", "i").agg(F.min((F.col("bin") + 0.5) / MEDIAN_BINS).alias("x"))
        return middle.groupBy("group").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda y: y["x"]).alias(name))

    centre = save(medians(vectors.select("group", place), "mean"))
    off = vectors.join(centre, "group").select("group", F.posexplode(F.zip_with("v", "mean", lambda a, b: F.abs(a - b))).alias("i", "x"))
    spread = medians(off, "spread").join(centre, "group")
    plain = vectors.groupBy("group").agg(*_sums()).withColumn("size", F.col("n")).withColumn("start", F.lit(1))

    def diagonal(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in parts:
            scatters = [(1.4826 * np.array(s)) ** 2 + FLOORS**2 for s in x.spread]
            yield pd.DataFrame({
                "group": x.group, "start": 0, "size": x["size"], "mean": x["mean"],
                "inverse": [np.diag(1 / s).ravel().tolist() for s in scatters], "logdet": [float(np.log(s).sum()) for s in scatters],
            })

    first = spread.join(plain.select("group", "size"), "group").select("group", "size", "mean", "spread").mapInPandas(diagonal, _PARAMS)
    params = save(first.unionByName(_params(plain.select("group", "start", "size", "n", "total", "products"), 1.0)))
    nearer = Window.partitionBy("group", "start").orderBy("bin")
    for _ in range(STEPS):
        bins = F.floor(F.log(F.col("distance") + 1e-6) * DISTANCE_BINS).alias("bin")
        sums = _measured(vectors, params).groupBy("group", "start", "size", bins).agg(*_sums())
        inner = sums.withColumn("before", F.sum("n").over(nearer) - F.col("n")).where(F.col("before") < HALF * F.col("size"))
        whole = inner.groupBy("group", "start", "size").agg(F.sum("n").alias("n"), _added("total", d), _added("products", len(_MOMENTS)))
        params = save(_params(whole, FACTOR_HALF))
    best = Window.partitionBy("group").orderBy("logdet", "start")
    raw = params.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank")
    near = _measured(vectors, raw).where(F.col("distance") <= NEAR).groupBy("group", "start", "size").agg(*_sums())
    return save(_params(near, FACTOR_NEAR).select("group", "mean", "inverse"))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Columns of docs without the text, COUNTS, base_failed, distance and kept.

    Null texts have no words and fail the base rules; failing rows have a null distance. A null language or source is a
    group of its own. Rows of groups under MIN_ROWS are judged by the estimate over all vectors of the table.
    """
    counted = save(with_counts(docs, text))
    group = F.to_json(F.struct(lang, source))
    fine = counted.where("not base_failed").withColumn("v", F.array(*features())).withColumn("own", group)
    large = fine.groupBy("own").agg(F.count("*").alias("rows")).where(F.col("rows") >= MIN_ROWS).select("own", F.col("own").alias("group"))
    grouped = fine.join(large, "own", "left").withColumn("group", F.coalesce("group", F.lit("")))
    vectors = grouped.select("group", "v").where("group <> ''")
    if not grouped.where("group = ''").isEmpty():
        vectors = vectors.unionByName(fine.select(F.lit("").alias("group"), "v"))
    found = estimates(vectors)
    off, distance = _distance()
    rest = counted.columns
    judged = grouped.join(found, "group", "left").withColumn("off", off).withColumn("distance", distance)
    kept = F.coalesce(F.col("distance") <= FAR, F.lit(True))
    failed = counted.where("base_failed").select(*rest, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return judged.select(*rest, "distance", kept.alias("kept")).unionByName(failed)


def op4_quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance."""
    return judge(docs.select("doc_id", "text", "lang", "source")).select("doc_id", *COUNTS, "base_failed", "kept", "distance")
