"""License scans: TF-IDF cosine of headers and license files to templates, then inheritance from the nearest directory.

Of every file these stretches are compared with titles, notices and whole texts of licenses: the whole file, its
header (comment lines it starts with), every paragraph, and every one to three consecutive lines. An SPDX tag says
what it says. A license file (LICENSE, COPYING or NOTICE, with any extension) speaks for its directory and all
below; a file without a license of its own takes that of its nearest ancestor directory that has one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from courtside.llm.common import save
from courtside.llm.license_texts import TEMPLATES, TEXTS, TITLES

#: Least cosine of a stretch and a template.
MIN_COSINE = 0.7
#: A stretch is compared with templates of at least this part of its words: prose that mentions a license isn't one.
LEAST_PART = 0.5
#: Share of a template's squared weights that the terms sought in a stretch may leave out.
SPARE = 0.2
#: Most consecutive lines that are compared on their own, wherever they stand.
LINES = 3
#: Consecutive doc_ids that share the digits of a path.
FILES = 20
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice)(\.[^/]*)?$"
SPDX_TAG = "SPDX-License-Identifier:"
SPDX_NAME = r"[ \t]*\(?([A-Za-z0-9.+-]+(?: (?:OR|AND|WITH) [A-Za-z0-9.+-]+)*)"
#: A line that a header may hold: without a word, or marked as a comment.
COMMENT = r"^\s*(?:#|//|/\*|\*|--|;|%|<!--)|^[^A-Za-z0-9]*$"


def templates_table(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(license, notice) rows; a license may have several."""
    rows = F.array(*(F.struct(F.lit(a).alias("license"), F.lit(b).alias("notice")) for a, b in templates))
    return spark.range(1).select(F.inline(rows))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def weights(files: DataFrame, templates: DataFrame, text: str) -> tuple[DataFrame, DataFrame, float]:
    """(term, idf) of all template terms, (license, notice, size, term, idf, weight) unit vectors, and the idf of any other term.

    The document frequencies are counted over all files. Only the template terms come to the driver.
    """
    terms = templates.select("license", F.xxhash64("license", "notice").alias("notice"), F.explode(_words(F.col("notice"))).alias("term"))
    names = [row["term"] for row in terms.select("term").distinct().orderBy("term").collect()]
    rows = files.count()
    known = F.array_intersect(_words(F.col(text)), F.array(*map(F.lit, names)))
    counts = files.select(F.explode(known).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    frequency = F.coalesce("df", F.lit(0))
    idf = terms.select("term").distinct().join(counts, "term", "left").select("term", (F.log((1 + F.lit(rows)) / (1 + frequency)) + 1).alias("idf"))
    idf = save(idf)  # bounded by the templates; the texts are read for it once
    vectors = terms.groupBy("license", "notice", "term").agg(F.count("*").alias("tf")).join(idf, "term").withColumn("raw", F.col("tf") * F.col("idf"))
    norms = vectors.groupBy("notice").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"), F.sum("tf").alias("size"))
    other = math.log(1 + rows) + 1
    return idf, vectors.join(norms, "notice").select("license", "notice", "size", "term", "idf", (F.col("raw") / F.col("norm")).alias("weight")), other


def needed_terms(vectors: DataFrame) -> list[tuple[int, int, set[str], set[str]]]:
    """(n, size, one, some): a match has, for one of them, at most size words, a term of `one`, and n of `some`.

    A cosine of MIN_COSINE needs MIN_COSINE^2 of a template's squared weights in shared terms. The first set leaves less
    outside, so one of its terms is shared; the second leaves SPARE, so at least as many as make up the rest are.
    Both take the rarest terms of each template, so that prose has few.
    """
    by_notice: dict[tuple[int, int], list[tuple[float, float, str]]] = {}
    for row in vectors.collect():  # bounded by the templates
        by_notice.setdefault((row["notice"], row["size"]), []).append((row["idf"], row["weight"], row["term"]))
    found: dict[tuple[int, int], tuple[set[str], set[str], set[int]]] = {}
    for (_, size), terms in by_notice.items():
        least = MIN_COSINE**2 - 1e-9
        left, one, some = 1.0, set(), {}
        for _, weight, term in sorted(terms, reverse=True):
            if left >= least:
                one.add(term)
            if left >= SPARE:
                some[term] = weight**2
                left -= weight**2
        n, rest = 0, least - max(left, 0.0)
        for mass in sorted(some.values(), reverse=True):
            if rest > 0:
                n, rest = n + 1, rest - mass
        most = int(size / LEAST_PART)
        sets = found.setdefault((n, most.bit_length()), (set(), set(), set()))  # like sizes together
        for own, more in zip(sets, (one, some, {most})):
            own.update(more)
    return [(n, max(sizes), one, some) for (n, _), (one, some, sizes) in sorted(found.items())]


def stretches(text: Column) -> Column:
    """Array of (line, lines, content): the stretches of a text that are compared; those that coincide are given once.

    A paragraph is a run of lines with words. Work and size grow in proportion to the text.
    """
    span = lambda at, n: F.struct(at.cast("int").alias("line"), n.cast("int").alias("lines"))

    def cut(parts: Column) -> Column:
        count = F.size(parts)
        every = F.sequence(F.lit(0), count - 1)
        worded = F.transform(parts, lambda x: x.rlike("[A-Za-z0-9]"))
        # Lines with words after, and before, one without.
        first = F.filter(F.transform(worded, lambda x, i: F.when(x & ((i == 0) | ~F.get(parts, i - 1).rlike("[A-Za-z0-9]")), i)), F.isnotnull)
        last = F.filter(F.transform(worded, lambda x, i: F.when(x & ((i == count - 1) | ~F.get(parts, i + 1).rlike("[A-Za-z0-9]")), i)), F.isnotnull)
        header = F.coalesce(F.array_position(F.transform(parts, lambda x: x.rlike(COMMENT)), False) - 1, count)
        spans = F.concat(
            F.array(span(F.lit(0), count), span(F.lit(0), F.when(header < 0, count).otherwise(header))),
            F.zip_with(first, last, lambda a, b: span(a, b - a + 1)),
            *(F.transform(every, lambda i, n=n: span(i, F.lit(n))) for n in range(1, LINES + 1)),
        )
        kept = F.filter(F.array_distinct(spans), lambda x: (x["lines"] > 0) & (x["line"] + x["lines"] <= count))
        return F.transform(kept, lambda x: F.struct(x["line"], x["lines"], F.array_join(F.slice(parts, x["line"] + 1, x["lines"]), "\n").alias("content")))

    # The lines are bound once: an expression inside a lambda is computed for every element.
    return F.get(F.transform(F.array(F.split(text, "\n")), cut), 0)


def declared(text: Column) -> tuple[Column, Column]:
    """What the first SPDX tag of a text says, else null, and the line that it stands in."""
    before = F.substring_index(text, SPDX_TAG, 1)
    name = F.regexp_extract(F.substr(text, F.length(before) + 1), "^" + SPDX_TAG + SPDX_NAME, 1)
    return F.when(name != "", name), F.when(name != "", F.size(F.split(before, "\n")) - 1)


def scan_lines(files: DataFrame, templates: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, digest, license, score, line): the best template of each text that has one, and where its stretch begins.

    Only templates of at least LEAST_PART of a stretch's words count. Ties go to the first line, then to fewer
    lines. Rows with the same path and text give one row.
    """
    idf, vectors, other = weights(files, templates, text)
    needed = needed_terms(vectors)
    cues = sorted(set().union(*(one for _, _, one, _ in needed)))
    pattern = r"(?<![a-z0-9])(" + "|".join(x.replace(".", r"\.") for x in cues) + ")(?![a-z0-9])"
    literal = lambda terms: F.array(*map(F.lit, sorted(terms)))

    def enough(words: Column) -> Column:
        found = F.lit(False)
        for n, size, one, some in needed:
            found |= (F.size(words) <= size) & F.arrays_overlap(words, literal(one)) & (F.size(F.array_intersect(words, literal(some))) >= n)
        return found

    marked = files.where(F.lower(text).rlike(pattern)).select(path, F.xxhash64(text).alias("digest"), text).distinct()
    parts = marked.select(path, "digest", F.inline(stretches(F.col(text)))).where(F.lower("content").rlike(pattern))
    names = [path, "digest", "line", "lines", "size"]
    # All groups below hold one stretch each: they are made where this puts it.
    chosen = parts.where(F.exists(F.array(_words(F.col("content"))), enough))  # binds the words once
    worded = chosen.select(*names[:4], _words(F.col("content")).alias("words"))
    placed = worded.select("*", F.size("words").alias("size")).repartition(*names)
    counted = placed.select(*names, F.explode("words").alias("term")).groupBy(*names, "term").agg(F.count("*").alias("tf"))
    use = vectors.groupBy("term").agg(F.collect_list(F.struct("notice", "license", F.col("size").alias("long"), "weight")).alias("uses"))  # bounded by the templates
    raw = F.col("tf") * F.coalesce("idf", F.lit(other))
    weighed = counted.join(F.broadcast(idf.join(use, "term")), "term", "left").withColumn("raw", raw)
    length = F.struct(F.lit(None).cast("long").alias("notice"), F.lit(None).cast("string").alias("license"), (F.col("raw") * F.col("raw")).alias("value"))
    compared = F.filter("uses", lambda x: F.col("size") * LEAST_PART <= x["long"])
    products = F.transform(compared, lambda x: F.struct(x["notice"], x["license"], (F.col("raw") * x["weight"]).alias("value")))
    values = weighed.select(*names, F.inline(F.concat(F.array(length), F.coalesce(products, F.slice(F.array(length), 1, 0)))))
    sums = values.groupBy(*names, "notice", "license").agg(F.sum("value").alias("value"))
    nearest = F.max(F.when(F.col("notice").isNotNull(), F.struct(F.round("value", 9).alias("dot"), "license"))).alias("near")
    scored = sums.groupBy(*names).agg(F.max(F.when(F.col("notice").isNull(), F.sqrt("value"))).alias("norm"), nearest)
    scored = scored.withColumn("score", F.round(F.col("near.dot") / F.col("norm"), 9)).where(F.col("score") >= MIN_COSINE)
    best = F.max(F.struct("score", (-F.col("line")).alias("before"), (-F.col("lines")).alias("shorter"), "near.license")).alias("best")
    return scored.groupBy(path, "digest").agg(best).select(path, "digest", "best.license", "best.score", (-F.col("best.before")).alias("line"))


def inherit(found: DataFrame, path: str = "path") -> DataFrame:
    """Add dir, inherited and inherited_from to (path, license, score): the nearest ancestor directory's license.

    A directory with several license files takes the best score, ties the license that sorts last. Directories
    are joined once each, however many files they hold. A null path inherits nothing.
    """
    parent = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    placed = found.withColumn("dir", parent)
    speaks = F.regexp_extract(path, r"([^/]*)$", 1).rlike(LICENSE_FILE)
    speakers = (
        placed.where(F.col("license").isNotNull() & speaks).groupBy("dir").agg(F.max(F.struct("score", "license")).alias("best"))
        .select(F.col("dir").alias("above"), F.col("best.license").alias("inherited"))
    )
    parts = F.split("dir", "/")
    upward = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    steps = placed.select("dir").where("dir is not null").distinct().select("dir", F.posexplode(upward).alias("depth", "above"))
    nearest = steps.join(speakers, "above").groupBy("dir").agg(F.max(F.struct("depth", "inherited", "above")).alias("near"))
    named = nearest.select("dir", F.col("near.inherited").alias("inherited"), F.col("near.above").alias("inherited_from"))
    return placed.join(named, "dir", "left")


def scan_licenses(files: DataFrame, templates: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """The other columns of files with own_license, score, line, dir, inherited, inherited_from and license.

    The own license is what an SPDX tag says (score 1), else the best template's; license is the own one, else the
    inherited one, else null. Null and empty texts have none of their own. Repeated rows are kept, each with the same
    result. Columns of those names are replaced.
    """
    added = ("own_license", "score", "line", "dir", "inherited", "inherited_from", "license", "digest")
    rest = [c for c in files.columns if c not in (*added, text)]
    own = save(scan_lines(files, templates, path, text)).withColumnsRenamed({path: "p", "digest": "d"})  # read three times
    tag, at = declared(F.col(text))
    rows = files.select(*rest, F.xxhash64(text).alias("digest"), F.struct(tag.alias("name"), at.alias("line")).alias("own_license"))
    joined = rows.join(own, rows[path].eqNullSafe(own["p"]) & (rows["digest"] == own["d"]), "left").select(
        *(rows[c] for c in rest), F.coalesce("own_license.name", "license").alias("license"),
        F.when(F.col("own_license.name").isNotNull(), 1.0).otherwise(F.col("score")).alias("score"),
        F.coalesce("own_license.line", "line").alias("line"),
    )
    return inherit(joined, path).select(
        *rest, F.col("license").alias("own_license"), "score", "line", "dir", "inherited", "inherited_from",
        F.coalesce("license", "inherited").alias("license"),
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """A file path for each document: its source, then the digits of doc_id div FILES as directories.

    The last of these digits is no directory; where it is 0, the document is a license file. With FILES = 20,
    document 11403 of src3 (570) is /src3/5/7/LICENSE.11403, document 11423 (571) is /src3/5/7/11423.txt. A null
    doc_id gives a null path, a null source the root.
    """
    place = F.floor(F.col("doc_id") / FILES).cast("string")
    number = F.col("doc_id").cast("string")
    above = F.array_join(F.split(F.regexp_replace(place, ".$", ""), ""), "/")
    name = F.when(place.endswith("0"), F.concat(F.lit("LICENSE."), number)).otherwise(F.concat(number, F.lit(".txt")))
    folder = F.concat_ws("/", F.lit(""), "source", F.when(above != "", above))
    return docs.withColumn("path", F.concat(folder, F.lit("/"), name))


def op2_license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, path, own_license, score, line, inherited, inherited_from, license of every document."""
    files = document_paths(docs.select("doc_id", "source", "text"))
    found = scan_licenses(files, templates_table(docs.sparkSession, TEMPLATES + TITLES + TEXTS))
    return found.select("doc_id", "path", "own_license", "score", "line", "inherited", "inherited_from", "license")
