"""Band values of lines are computed once, and only what could link is compared."""

import random

import numpy as np

from courtside.llm import line_dedup


def test_bands_are_shuffled_once(spark):
    texts = ["a line that is here twice\nand one more", "a line that is here twice\nanother line", None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    led = line_dedup._led(rows, "text")
    found = led.collect()
    final = led._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("MapInArrow") == 1 and "ReusedExchange" in final
    assert all(r.lead < r.line for r in found)


def test_normal_forms_of_lines():
    odd = ["a\x85b", " x 　y ", "a\r\nb\t", " \n \n", "a  b", "İ\n \xdf ", "\x1c\n\x1f", "a \n b", "", " A", "b "]
    for text in [*odd, "\n".join(odd)]:
        plain = [(i, y) for i, x in enumerate(text.lower().split("\n")) if (y := " ".join(x.split()))]
        assert list(zip(*line_dedup.lines_of(text))) == plain


def test_small_units_link_like_single_ones():
    """The bound leaves out most pairs, and no link."""
    rng, units = random.Random(9), []
    for n in (1, 2, 5, 12, 30):
        start = "".join(rng.choices("abcdefgh ", k=300))
        lines = []
        for _ in range(n):
            at = rng.randrange(280)
            start = start[:at] + "".join(rng.choices("ijklmnop", k=rng.choice([2, 20, 60]))) + start[at + 10 :]
            lines.append(rng.choice([start, start, start, "".join(rng.choices("abc ", k=200)), "x"]))
        part, side = np.array([rng.randrange(n) for _ in lines]), np.array([rng.randrange(2) for _ in lines])
        units += [(lines, part, side), (lines, part, np.full(n, -1)), (lines, np.arange(n), np.full(n, -1))]
    seen = {}
    links = line_dedup.small_links(units, seen)
    assert links == [line_dedup.unit_links(*x) for x in units] and sum(map(len, links)) > 20
    assert seen["compared"] < sum(len(x) * (len(x) - 1) // 2 for x, _, _ in units) // 2


def test_only_wanted_contents_are_dealt_out(spark):
    """Lines that meet no other one are not written with their contents."""
    docs = spark.createDataFrame([(i, f"line {i} of the text number {i}\nand one more {i * i}") for i in range(500)], "doc_id long, text string")
    lines = [f"line {i} of the text number {i}" for i in (3, 77)]
    wanted = spark.createDataFrame([(line_dedup.line_id(x),) for x in lines], "line long")
    found = {r.line: r.content for r in line_dedup._contents(docs, "text", wanted).collect()}
    assert {line_dedup.line_id(x): x for x in lines}.items() <= found.items() and len(found) < 100


def test_lines_of_many_pairs_are_cut_into_shingles_once(monkeypatch):
    cut, plain = [], line_dedup._shingles
    monkeypatch.setattr(line_dedup, "_shingles", lambda lines: cut.extend(lines) or plain(lines))
    lead = "a line that many other lines are compared with"
    others = [lead + end for end in ("", "!", ", some")] + ["another line"]
    assert line_dedup.alike(others, [lead] * 4).tolist() == [True, True, True, False] and sorted(cut) == sorted(others)


def test_small_units_of_many_short_lines(monkeypatch):
    """Pairs are taken in parts; what an earlier part joined isn't compared again."""
    monkeypatch.setattr(line_dedup, "BOUND_PAIRS", 2)
    rng = random.Random(4)
    units = []
    for n in (0, 1, 40, 3, 60):
        lines = ["".join(rng.choices("ab", k=rng.choice([1, 9, 10]))) for _ in range(n)]
        units.append((lines, np.arange(n), np.full(n, -1)))
    units = [x for x in units if x[0]]
    assert line_dedup.small_links(units) == [line_dedup.unit_links(*x) for x in units]


def test_bands_do_not_depend_on_the_lines_beside(monkeypatch):
    lines = ["x", "short", *(f"{i} is the number of this line, {i * i} is its square" * (1 + i % 3) for i in range(40))]
    together = line_dedup.bands(lines)
    monkeypatch.setattr(line_dedup, "FILLED_LINES", 3)
    assert (line_dedup.bands(lines) == together).all() and all((line_dedup.bands([x])[0] == y).all() for x, y in zip(lines, together))


def test_only_repeated_lines_are_dealt_out(spark):
    """Lines that come once and link to none meet no other document's lines."""
    docs = spark.createDataFrame([(i, f"line {i} of the text number {i}\nand one more {i * i}\nthe same line" if i < 9 else f"{i} times {i}") for i in range(500)], "doc_id long, text string")
    classes, texts = line_dedup.line_classes(docs, "doc_id", "text")
    found = line_dedup._repeated(texts, classes.withColumnRenamed("node", "line")).collect()
    same = line_dedup.line_id("the same line")
    assert {(r.owner, r.place) for r in found if r.line == same} == {(i, 2) for i in range(9)} and len(found) < 250
    assert {r.owner: len(r.lines) for r in texts.collect()} == {i: 3 if i < 9 else 1 for i in range(500)}


def test_rows_of_one_key_are_one_document(spark):
    texts = [("a", "one line\nand two"), ("a", "one line\nother"), ("b", "And  two\n\nlone"), ("c", "x"), ("c", " X "), ("c", "x\ny"), ("d", "y"), (None, "lone"), ("e", None), ("f", " \n")]
    rows = line_dedup.repeated_lines(spark.createDataFrame(texts, "doc_id string, text string"))
    found = {r.doc_id: (r.n_lines, r.removed) for r in rows.collect()}
    assert found == {"a": (3, []), "b": (2, [0]), "c": (2, []), "d": (1, [0])} and rows.count() == 4
    assert dict(rows.dtypes) == {"doc_id": "string", "n_lines": "bigint", "removed": "array<int>"}
