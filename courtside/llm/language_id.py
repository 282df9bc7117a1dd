"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from courtside.llm.common import mix, passes, slices

#: Hash buckets of all n-grams together; with the number of languages it bounds the broadcast matrix.
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
UNKNOWN = "und"
#: Below this share of the posterior a prediction counts as rejected.
MIN_SCORE = 0.5
#: Standard deviations that a text's mean log probability may lie below that of learned texts of its language and length,
#: and how many learned texts it takes to know. Texts with a passage in another language lie at 5 to 12.
USUAL_SPREAD, USUAL_TEXTS = 12.0, 50
HELD_OUT_FOLD, FOLDS = 2, 4

_SPACE = np.uint64(32)
_LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT_FOLD


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of the n-grams by order, each text's range in them, and its number of letters.

    Letters are lower-cased; everything else counts as a space. Texts are set off by two spaces, so
    that the n-grams of a text stay its own.
    """
    codes = [_codes(x) for x in texts]
    edge = np.full(max(ORDERS) - 1, 32, np.uint32)
    flat = np.concatenate([x for c in codes for x in (edge, c)] + [edge])
    letter = _LETTER[flat]
    flat = np.where(letter, flat, 32).astype(np.uint64)
    limits = np.cumsum([0, *(len(c) + len(edge) for c in codes)])
    letters = np.diff(np.concatenate([[0], np.cumsum(letter)])[limits])
    last = limits[-1]
    value, buckets = np.zeros(last, np.uint64), []
    for n in range(1, max(ORDERS) + 1):
        value = value * np.uint64(0x1000003) + flat[n - 1 : n - 1 + last] + np.uint64(n)
        if n in ORDERS:
            buckets.append((mix(value) % np.uint64(BUCKETS)).astype(np.int32))
    return buckets, limits, letters


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int, list[str]]]:
    clean = ["" if x is None else x for x in texts]
    # A code point takes about 60 bytes in the passes below, so they hold a quarter of the usual text.
    for a, b in passes([b" " * (4 * len(x)) for x in clean]):
        yield a, b, clean[a:b]


@dataclass
class LanguageModel:
    """Languages, their log priors, and log probabilities by bucket (buckets x languages)."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language and share of the posterior of each text, and the mean log probability of its n-grams there."""
        names, scores, means = [], np.zeros(len(texts)), np.zeros(len(texts))
        for a, b, part in _parts(texts):
            buckets, limits, letters = grams(part)
            total = np.tile(self.prior, (b - a, 1))
            for k in range(len(self.languages)):
                weight = np.ascontiguousarray(self.weights[:, k])
                for x in buckets:
                    total[:, k] += np.add.reduceat(weight[x], limits[:-1])
            share = np.exp(total - total.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            known = letters > 0
            names += [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            scores[a:b] = np.where(known, share[np.arange(b - a), best], 0.0)
            means[a:b] = (total[np.arange(b - a), best] - self.prior[best]) / (len(ORDERS) * np.diff(limits))
        return names, scores, means


def count_grams(rows: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, bucket, n) over all rows; bucket -1 counts the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            langs = np.array(batch.column(1).to_pylist(), object)
            texts = batch.column(0).to_pylist()
            for a, b, part in _parts(texts):
                buckets, limits, letters = grams(part)
                for name in set(langs[a:b]):
                    own = totals.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                    mine = langs[a:b] == name
                    chosen = np.repeat(mine, np.diff(limits))
                    for x in buckets:
                        own[:-1] += np.bincount(x[chosen], minlength=BUCKETS)
                    own[-1] += int((mine & (letters > 0)).sum())
        for name, own in totals.items():
            at = np.flatnonzero(own)
            bucket = np.where(at == BUCKETS, -1, at).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(bucket), pa.array(own[at])], ["lang", "bucket", "n"])

    counted = rows.select(text, lang).mapInArrow(count, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from every row with a text and a language.

    What comes to the driver is one count per language and bucket: at most BUCKETS + 1 rows a language.
    Without any usable row the model has no language and predicts `und`.
    """
    usable = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = count_grams(usable, text, lang).toPandas()
    texts = counts[(counts.bucket < 0) & (counts.n > 0)].sort_values("lang")
    languages = texts.lang.tolist()
    if not languages:
        return LanguageModel([], np.zeros(0), np.zeros((BUCKETS, 0)))
    table = np.zeros((BUCKETS, len(languages)))
    found = counts[(counts.bucket >= 0) & counts.lang.isin(languages)]
    table[found.bucket, found.lang.map({x: i for i, x in enumerate(languages)})] = found.n
    table += SMOOTHING
    prior = np.log(texts.n.to_numpy() / texts.n.sum())
    return LanguageModel(languages, prior, np.log(table / table.sum(axis=0)))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", mean: str | None = None) -> DataFrame:
    """Add lang_pred and score to every row, and if named the mean log probability of an n-gram; other columns stay.

    Null texts and texts without a letter are `und` with score 0. Equal posteriors go to the language
    that sorts first. Columns of the same names are replaced. A text is worked on whole, in parts of bounded size with
    others; repeated rows get equal results.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    added = ["lang_pred", "score", *([mean] if mean else [])]
    rest = [c for c in docs.columns if c not in added]
    schema = docs.select(rest).schema.add("lang_pred", "string").add("score", "double")
    schema = schema.add(mean, "double") if mean else schema

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = rest.index(text)
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            none = np.zeros(len(texts))
            names, scores, means = held.value.predict(texts) if held.value.languages else ([UNKNOWN] * len(texts), none, none)
            columns = [pa.array(names, pa.string()), pa.array(scores), pa.array(means)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns[: len(added)]], [*rest, *added])

    return docs.select(rest).mapInArrow(predict, schema)


def _length_class(text: str) -> Column:
    return F.floor(F.log2(F.greatest(F.length(text), F.lit(1)))).cast("int")


def usual_means(labelled: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang") -> dict[str, dict[int, float]]:
    """The least usual mean log probability of an n-gram, by language and class of length (powers of two).

    From the learned texts whose language is found again: USUAL_SPREAD standard deviations below their mean. Classes
    with fewer than USUAL_TEXTS texts are left out. What comes to the driver is a row per language and class.
    """
    usable = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    found = identify(usable, model, mean="mean").where("lang_pred = lang")
    classes = found.groupBy("lang", _length_class("text").alias("size")).agg(F.count("*").alias("n"), F.avg("mean").alias("mean"), F.stddev("mean").alias("spread"))
    least: dict[str, dict[int, float]] = {}
    for row in classes.where(F.col("n") >= USUAL_TEXTS).collect():
        least.setdefault(row["lang"], {})[row["size"]] = row["mean"] - USUAL_SPREAD * row["spread"]
    return least


def rejected(usual: dict[str, dict[int, float]], mean: str, text: str = "text") -> Column:
    """Rows of identify that a filter should drop: no language found, none ahead of all others, or unusual in it.

    A text is unusual if the mean log probability of its n-grams is below what is usual for its language and
    length; longer texts than those known are held against the longest known, shorter ones against nothing.
    """
    low = F.lit(None).cast("double")
    for lang, classes in sorted(usual.items()):
        own = F.lit(None).cast("double")
        for size, least in sorted(classes.items()):
            own = F.when(_length_class(text) >= size, F.lit(least)).otherwise(own)
        low = F.when(F.col("lang_pred") == lang, own).otherwise(low)
    return (F.col("lang_pred") == UNKNOWN) | (F.col("score") < MIN_SCORE) | F.coalesce(F.col(mean) < low, F.lit(False))


def op10_language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the rows that are not held out."""
    rows = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = fit(rows.where("not held_out"))
    return identify(rows.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
