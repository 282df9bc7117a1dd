"""Text operators against brute force on small tables, with nulls, empty texts, ties and clashing columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from courtside.llm import (
    byte_bpe, common, html_extract, language_id, license_scan, line_dedup, ngram_join, packing, quality_rules, span_dedup, vector_dedup,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone light garden winter morning paper window table letter music summer forest bridge silver market".split()
SPACES = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def docs(spark, texts, lang="en", source="s"):
    return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t in enumerate(texts)], DOCS)


def sentence(rng, n=9):
    return (" ".join(rng.choice(WORDS) + rng.choice(["", "s", "ly", "ing"]) for _ in range(n)) + ".").capitalize()


def prose(rng, sentences=12):
    return " ".join(sentence(rng) for _ in range(sentences))


def edited(rng, text, share):
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split())


def smallest_reachable(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)] + [(i, i + 1) for i in range(500, 560)] + [(9, 9)]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    found = common.components(spark.createDataFrame([*links, (None, 3)], "a long, b long"))
    assert dict(found.collect()) == smallest_reachable(nodes, [x for x in links if x[0] != x[1]])
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 1 ------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><article>no</article>";</script></head><body>
<header class="site-header"><a href="/">Home page</a></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies here.</p><button>Accept all</button></div>
{main}<aside class="sidebar"><h3>More</h3><ul><li><a href="/c">Three</a></li></ul></aside>
<section id="comments"><h2>Comments</h2><div class="comment"><p>Nice words, thanks.</p></div></section>
<form><label>Name</label><input><button>Send</button></form><footer>&copy; example.com</footer></body></html>"""


def test_hidden_blocks_have_no_text():
    shown = "<article><p>Shown text.</p>{}</article>"
    for attributes in ("hidden", 'hidden=""', "HIDDEN", 'style="display: none"', "style='color:red;DISPLAY:none;'", 'style="visibility:hidden"'):
        for tag in ("div", "span", "p"):
            page = html_extract.Page(shown.format(f"<{tag} {attributes}>Unseen <b>words</b></{tag}> after"), {})
            assert [x.strip() for _, _, x, _ in page.pieces if x.strip()] == ["Shown text.", "after"], (tag, attributes)
    page = html_extract.Page(shown.format('<div class="hidden-gem" aria-hidden="false" style="display:block">Seen</div>'), {})
    assert "Seen" in [x for _, _, x, _ in page.pieces]
    assert html_extract.Page('<body style="display:none"><p>Fades in.</p></body>', {}).pieces


def test_sampled_pages_lend_words_of_the_whole_page(spark):
    tail = " ".join(f"late{i}" for i in range(600))
    pages = [(1, "u", "<p>" + "early " * 9000 + "</p><p>" + tail + "</p>"), (2, "u", None), (3, "u", "")]
    pages += [(9, "u", pages[0][2])]  # the same page again lends once
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    model = html_extract.fit(frame)
    found = {r.page_id: r for r in html_extract.extract(frame, model).collect()}
    assert found[1].text == found[9].text and found[2].text == found[3].text == "" and len(found) == 4


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(3)
    pages = [(i, "u", PAGE.format(main=f"<article><p>{prose(rng)}</p></article>")) for i in range(20)]
    return html_extract.fit(spark.createDataFrame(pages, "page_id long, url string, html string"))


def test_main_text(spark, model):
    rng = random.Random(4)
    first, second, third = prose(rng, 6), prose(rng, 5), prose(rng, 7)
    unclosed = f"<article><h1>The title</h1><p><b>{first}<br><p>{second}\n\t &amp; more&nbsp;&eacute;.</p><div class='ad'>Buy it now.</div><p>{third}"
    rows = [(0, "u", PAGE.format(main=unclosed + "</article>"), "x"), (1, None, None, None), (2, "", "", "y"), (3, "u", "<p", "z"), (4, "u", "no markup", "z")]
    found = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), model).collect()}
    assert found[0].text == f"The title {first} {second} & more é. {third}"
    assert found[0].n_chars == len(found[0].text)
    assert [(found[i].text, found[i].n_chars) for i in (1, 2, 3)] == [("", 0)] * 3
    assert html_extract.op1_html_extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("head", [
    "<head><title>t</title><body>", "<head><title>t</title>", "<head><meta charset=utf-8><script>var a='<p>';</script><link rel=x><body class=b>",
    "<head><noscript><style>p{}</style><p>no</p></noscript><template><p>no</p></template><title>t</title></head><body>", "<title>t</title>",
    "<head><noscript><link rel=x><title>t</title><body>",
])
def test_open_head_ends_where_the_body_begins(head):
    page = html_extract.Page(f"<html>{head}<article><p>First.</p><img src=x><p>Second.", {})
    assert page.tags == ["html", "article", "p", "p"]
    assert page.text(np.ones(4, bool)) == "First. Second."
    assert html_extract.Page("<head><title>t</title>\nPlain text", {}).text(np.ones(1, bool)) == "Plain text"


def test_decoding_never_keeps_what_is_inside_something_dropped():
    rng = np.random.default_rng(5)
    for _ in range(50):
        page = html_extract.Page("<div><p>a</p><ul><li>b</li><li>c</li></ul></div><div><p>d</p></div>", {})
        odds = rng.normal(size=len(page.tags))
        kept = page.keep(odds)
        assert all(kept[page.parents[i]] or not kept[i] for i in range(1, len(kept)))
        closed = [
            s for s in range(1 << len(kept)) if all(s >> page.parents[i] & 1 or not s >> i & 1 for i in range(1, len(kept)))
        ]
        best = max(sum(odds[i] if s >> i & 1 else -odds[i] for i in range(len(kept))) for s in closed)
        assert np.isclose(sum(np.where(kept, odds, -odds)), best)


# -- 2 ------------------------------------------------------------------------------------------------


def test_licenses(spark):
    rows = [
        ("/a/LICENSE", "Some text.\nReleased under the MIT License.\nMore."), ("/a/x.py", "nothing here"), ("/a/b/y.py", None),
        ("/a/c/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."), ("/a/c/d/z.py", ""),
        ("/a/c/w.py", "Licensed under CC BY-NC 4.0."), ("/q/v.py", "the river and the stone"), (None, "Released under the MIT License."),
        ("/a/LICENSE", "Some text.\nReleased under the MIT License.\nMore."),
    ]
    files = spark.createDataFrame([(*r, "old") for r in rows], "path string, text string, license string")
    found = license_scan.scan_licenses(files, license_scan.templates_table(spark)).collect()
    assert len(found) == len(rows)
    by = {r.path: (r.own_license, r.line, r.inherited, r.inherited_from, r.license) for r in found}
    assert by["/a/LICENSE"] == ("MIT", 1, "MIT", "/a", "MIT")
    assert by["/a/x.py"] == by["/a/b/y.py"] == (None, None, "MIT", "/a", "MIT")
    assert by["/a/c/d/z.py"] == (None, None, "GPL-3.0", "/a/c", "GPL-3.0")
    assert by["/a/c/w.py"] == ("CC-BY-NC-4.0", 0, "GPL-3.0", "/a/c", "CC-BY-NC-4.0")
    assert by["/q/v.py"] == (None, None, None, None, None) and by[None][0] == "MIT" and by[None][2] is None
    assert license_scan.op2_license_scan(docs(spark, [])).count() == 0


def test_license_cosines(spark):
    texts = ["Licensed under the Apache License, Version 2.0 of today", "the license of the river", "Released under the MIT License", "x"] * 2
    files = spark.createDataFrame([(f"/f{i}", t) for i, t in enumerate(texts)], "path string, text string")
    split = lambda t: re.findall(license_scan.WORD, t.lower())
    terms = {w for _, t in license_scan.TEMPLATES for w in split(t)}
    df = Counter(w for t in texts for w in set(split(t)) & terms)
    idf = lambda w: np.log((1 + len(texts)) / (1 + df[w])) + 1
    vector = lambda t: {w: n * idf(w) for w, n in Counter(split(t)).items()}
    length = lambda v: np.sqrt(sum(x * x for x in v.values()))
    expected = {}
    for i, t in enumerate(texts):
        v = vector(t)
        scores = {k: sum(x * vector(n).get(w, 0) for w, x in v.items()) / length(v) / length(vector(n)) for k, n in license_scan.TEMPLATES}
        best = max(scores, key=scores.get)
        if scores[best] >= license_scan.MIN_COSINE:
            expected[f"/f{i}"] = (best, round(scores[best], 6))
    found = license_scan.scan_lines(files, license_scan.templates_table(spark))
    assert {r.path: (r.license, round(r.score, 6)) for r in found.collect()} == expected and expected


# -- 3 ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("max_words", [0, 10, 1 << 20])
def test_byte_bpe(spark, max_words):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["Étion dans, çouelle 123 it's we'll  x", None, "", "   \n\n a b  c", "日本語 😀😀 ٣٤ ẞ <|endoftext|>", "a" * 300 + " " + "ab" * 200, "the the the", "the the the"]
    coder = byte_bpe.ByteBPE(spark, path, P.PATTERN)
    rows = docs(spark, texts).withColumn("ids", F.lit("clash"))
    coded = coder.decode(coder.encode(rows, max_words=max_words))
    assert sorted(coded.columns) == sorted([*rows.columns, "data"])
    for r in coded.collect():
        assert r.ids == own.encode_ordinary(r.text or "") and bytes(r.data) == (r.text or "").encode()
    digest = byte_bpe.op3_byte_bpe(docs(spark, texts[:1]), path, P.PATTERN).first()
    ids = own.encode_ordinary(texts[0])
    assert digest.n_tokens == len(ids) and digest.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert byte_bpe.op3_byte_bpe(docs(spark, []), path, P.PATTERN).count() == 0


# -- 4 ------------------------------------------------------------------------------------------------


def counted(text):
    words = [w.decode() for w in SPACES.findall((text or "").encode())]
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if SPACES.search(line.encode()):
            duplicates += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), duplicates, len(repeated), n < 50 or 100 * len(repeated) > 50 * n


def test_quality(spark):
    rng = random.Random(6)
    clean = [prose(rng, 8) for _ in range(300)]
    junk = [re.sub(r"(\w+)", r"\1***%%%", prose(rng, 8)) for _ in range(9)]
    odd = [None, "", "a b", "x\nx\n\nx \n", " é# $", "same words here " * 40, *clean[:3]]
    rows = docs(spark, [*clean, *junk, *odd]).withColumn("n_words", F.lit(7)).withColumn("kept", F.lit("old"))
    rows = rows.withColumn("lang", F.when((F.col("doc_id") % 50 != 0) | (F.col("doc_id") >= 300), F.col("lang")))
    found = {r.doc_id: r for r in quality_rules.op4_quality_rules(rows).collect()}
    for r in rows.collect():
        assert tuple(found[r.doc_id][c] for c in (*quality_rules.COUNTS, "base_failed")) == counted(r.text)
    assert all(found[i].kept for i in range(len(clean)))
    assert not any(found[i].kept for i in range(len(clean), len(clean) + len(junk)))
    assert not any(r.kept for r in found.values() if r.base_failed)
    assert quality_rules.op4_quality_rules(docs(spark, [])).count() == 0
    assert quality_rules.op4_quality_rules(docs(spark, clean[:5])).where("kept").count() == 5


def test_rows_of_small_groups_are_judged(spark):
    """A few rows of a rare source are judged by all vectors; so is a table that is small as a whole."""
    rng = random.Random(60)
    clean = [prose(rng, 8) for _ in range(260)]
    junk = [re.sub(r"(\w+)", r"\1***%%%", prose(rng, 8)) for _ in range(4)]
    rare = docs(spark, [*clean[240:], *junk], source="rare").withColumn("doc_id", F.col("doc_id") + 1000)
    found = {r.doc_id: r for r in quality_rules.op4_quality_rules(docs(spark, clean[:240]).unionByName(rare)).collect()}
    assert all(r.distance is not None for r in found.values()) and sorted(i for i, r in found.items() if not r.kept) == [1020, 1021, 1022, 1023]
    small = {r.doc_id: r.kept for r in quality_rules.op4_quality_rules(docs(spark, [*clean[:90], *junk])).collect()}
    assert [i for i, kept in small.items() if not kept] == [90, 91, 92, 93]


def test_quality_of_ties_and_long_texts(spark):
    text, long = prose(random.Random(61), 8), prose(random.Random(62), 3000)
    found = quality_rules.op4_quality_rules(docs(spark, [text] * 210 + [long])).collect()
    assert len({(r.distance, r.kept) for r in found if r.doc_id < 210}) == 1 and found[0].kept
    assert {r.doc_id: r.n_words for r in found}[210] == len(SPACES.findall(long.encode()))


# -- 5 ------------------------------------------------------------------------------------------------


def shingles(text):
    words = SPACES.findall((text or "").encode().translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


@pytest.mark.parametrize("task_grams", [1 << 20, 3000])
def test_ngram_join(spark, monkeypatch, task_grams):
    monkeypatch.setattr(ngram_join, "TASK_GRAMS", task_grams)
    rng = random.Random(7)
    texts = [None, "", " \n", "one two", "ONE  two", "one two three", prose(rng, 900)]
    for _ in range(12):
        base = prose(rng, rng.randrange(3, 30))
        texts += [edited(rng, base, share) for share in (0, 0, 0.01, 0.02, 0.04, 0.06)] + [base.upper(), base + " " + sentence(rng)]
    hub = prose(rng, 40)
    texts += [edited(rng, hub, 0.01) for _ in range(60)]
    texts += [prose(rng, 6) + " " + sentence(random.Random(8), 14) for _ in range(30)]
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    rows = docs(spark, texts).withColumn("component", F.lit(1)).withColumn("n", F.lit(2))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.op5_ngram_join(rows).collect()}
    reach = smallest_reachable(sets, links)
    assert found == {i: (len(sets[i]), reach[i]) for i in sets}
    if task_grams > 3000:
        twice = ngram_join.op5_ngram_join(rows.where("doc_id < 8").unionByName(rows.where("doc_id < 8").withColumn("doc_id", F.when(F.col("doc_id") > 2, F.col("doc_id")))))
        assert twice.count() == 16 and {r.component_id for r in twice.where("doc_id = 3").collect()} == {3}
        assert ngram_join.op5_ngram_join(docs(spark, [])).count() == 0


# -- 6 ------------------------------------------------------------------------------------------------


def test_patterns_hold_the_demand():
    rng = np.random.default_rng(9)
    for top in (3, 40, 5000):
        demand = np.zeros(129, np.int64)
        demand[1:65] = rng.integers(0, top, 64)  # longer pieces can leave room that nothing fills
        total = np.zeros(129, np.int64)
        used = 0
        for pattern, uses in packing.best_patterns(demand):
            assert sum(s * n for s, n in pattern.items()) <= 128
            for s, n in pattern.items():
                total[s] += n * uses
            used += uses
        assert (total == demand).all()
        assert used <= demand @ np.arange(129) / 128 * 1.02 + 130
    assert packing.best_patterns(np.zeros(129, np.int64)) == []


def test_packing(spark):
    path = P.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    rng = random.Random(10)
    texts = [None, "", "it's a.b C!'s 'S it'LL.x <|endoftext|>y", "É́ ΣΑΣ ½ 12,3\x1cq", prose(rng, 900), *(prose(rng, rng.randrange(1, 120)) for _ in range(60))]
    texts += texts[-3:]
    found = packing.op6_packing(docs(spark, texts).withColumn("kind", F.lit(1)), path).collect()
    by, filled = defaultdict(list), defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
        filled[r.sequence_id].append(r)
    for i, text in enumerate(texts):
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by[i], key=lambda r: r.start):
            piece = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(piece))
            at += r.length
        assert at == len(ids)
    for rows in filled.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert packing.op6_packing(docs(spark, []), path).count() == 0


# -- 7 ------------------------------------------------------------------------------------------------


def test_span_dedup(spark):
    rng = random.Random(11)
    passage = " ".join(sentence(rng) for _ in range(7))
    texts = [f"{prose(rng, 5)} {passage} {prose(rng, 4)}", f"{prose(rng, 3)[:-1]} {passage} ende", None, "", "Hi. Hi.", passage, passage, prose(rng, 6), f"{sentence(rng)}\n\n{passage.upper()}\nlast line"]
    rows = docs(spark, texts).withColumn("removed", F.lit(1))
    found = {r.doc_id: r for r in span_dedup.op7_span_dedup(rows).collect()}
    whole = lambda x: found[x].text == texts[x]
    assert whole(0) and whole(3) and whole(4) and whole(7) and found[2].text is None
    assert found[5].text == found[6].text == "" and found[5].n_removed == 7
    kept = passage.split(". ")[0]
    assert passage[len(kept) :] not in found[1].text and found[1].text.endswith("ende") and found[1].n_removed == 6
    assert found[8].text == texts[8].split("\n")[0] + "\n\nlast line"
    assert span_dedup.op7_span_dedup(docs(spark, [])).count() == 0
    twice = docs(spark, texts[:1]).unionByName(docs(spark, texts[:1]))
    assert all(r.text == texts[0] for r in span_dedup.op7_span_dedup(twice).collect())


def test_spans_cover_what_all_runs_cover(spark):
    rng = random.Random(24)
    plain = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(10**6)) for _ in range(n)) + "."
    texts = []
    for sizes in ([27, 10], [14, 10, 3], [9, 3, 25, 2], [3, 3, 3], [20], [4, 12, 1, 1], [30, 1, 22, 5], *([rng.randrange(1, 26) for _ in range(rng.randrange(1, 6))] for _ in range(40))):
        passage = " ".join(plain(n) for n in sizes)
        texts += [f"{plain(6)} {passage} {plain(30)}", f"{plain(9)} {passage}", f"{passage} {plain(5)} {plain(4)}"]
    texts += ["", "No.", plain(4)]
    split = [[x.split() for x in re.findall(r"[^.]+\.", t)] for t in texts]
    places = defaultdict(list)
    for d, own in enumerate(split):
        for i in range(len(own)):
            for j in range(i + 1, len(own) + 1):
                run = [w for x in own[i:j] for w in x]
                if len(run) >= 15 and j > i + 1 or len(run) >= 20 and j == i + 1:
                    places[tuple(run)].append((d, i, j))
    gone = defaultdict(set)
    for runs in places.values():
        for d, i, j in sorted(runs)[1:]:
            gone[d].update(range(i, j))
    found = {r.doc_id: r.removed for r in span_dedup.op7_span_dedup(docs(spark, texts)).collect()}
    assert found == {d: sorted(gone[d]) for d in range(len(texts))}


# -- 8 ------------------------------------------------------------------------------------------------


def test_vectors(spark):
    rng = np.random.default_rng(12)
    vectors = []
    for _ in range(40):
        base = rng.normal(size=16)
        vectors += [(base + rng.normal(size=16) * s).tolist() for s in (0, 0, 0.05, 0.2, 0.3)]
    vectors += [[0.0] * 16, None, [1.0, float("nan")] * 8, [float("inf")] * 16, [1.0, None] * 8, [], [3.0, 4.0], [30.0, 40.0], [1e-300] * 2]
    kind = "vec_id long, embedding array<float>, label int, id long"
    rows = spark.createDataFrame([(i, v, 0, 5) for i, v in enumerate(vectors)], kind)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.op8_vector_dedup(rows).collect()}
    single = [None if v is None else np.array([np.nan if x is None else x for x in v], np.float32).astype(float) for v in vectors]
    fine = {i for i, v in enumerate(single) if v is not None and len(v) and np.isfinite(v).all() and v.any()}
    cosine = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    links = [(a, b) for a in fine for b in fine if b < a and len(single[a]) == len(single[b]) and cosine(single[a], single[b]) >= 0.95]
    reach, degree = smallest_reachable(range(len(vectors)), links), Counter(x for pair in links for x in pair)
    assert found == {i: (degree[i], reach[i], reach[i] == i) for i in range(len(vectors))}
    assert vector_dedup.op8_vector_dedup(rows.limit(0)).count() == 0


def test_vectors_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "TASK_ROWS", 150)
    monkeypatch.setattr(vector_dedup, "WINDOW", 40)
    rng = np.random.default_rng(13)
    vectors = [(b + rng.normal(size=12) * 0.03).tolist() for b in rng.normal(size=(150, 12)) for _ in range(3)]
    found = {r.vec_id: r.component_id for r in vector_dedup.op8_vector_dedup(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()}
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = [(a, b) for a, b in zip(*np.nonzero(unit @ unit.T >= 0.95)) if b < a]
    reach = smallest_reachable(range(len(vectors)), links)
    assert np.mean([found[i] == reach[i] for i in found]) > 0.98


def test_dense_groups_are_compared_completely(spark, monkeypatch):
    """A third of the rows is one group, many times the window; a crowd close to it holds links below and above 0.95."""
    monkeypatch.setattr(vector_dedup, "WINDOW", 32)
    monkeypatch.setattr(vector_dedup, "BLOCK", 150)
    rng = np.random.default_rng(14)
    centre = rng.normal(size=24)
    group = centre + rng.normal(size=(500, 24)) * 0.12
    crowd = centre + rng.normal(size=(300, 24)) * 0.35
    twins = crowd[:60] + rng.normal(size=(60, 24)) * 0.02
    vectors = np.concatenate([group, crowd, twins, rng.normal(size=(640, 24)), group[:50]])
    vectors = vectors[rng.permutation(len(vectors))]
    rows = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in vector_dedup.op8_vector_dedup(rows).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    reach = smallest_reachable(range(len(vectors)), [(a, b) for a, b in zip(*np.nonzero(near)) if b < a])
    counted = np.array([found[i].n_links for i in range(len(vectors))])
    assert (counted <= near.sum(axis=1)).all() and counted.sum() >= 0.999 * near.sum() > 50_000
    assert np.mean([found[i].component_id == reach[i] for i in found]) > 0.995


def test_block_counts_and_components():
    rng = np.random.default_rng(15)
    units = rng.normal(size=(6, 8))[rng.integers(0, 6, 90)] + rng.normal(size=(90, 8)) * 0.05
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    crowds, copies = rng.integers(0, 3, (90, 4)), rng.integers(1, 4, 90)
    near = units @ units.T >= 0.95
    np.fill_diagonal(near, False)
    earlier = ((crowds[:, None, :2] == crowds[None, :, :2]) & (crowds[:, None, :2] != 0)).any(axis=2)
    for left, right in ((np.arange(90), None), (np.arange(40), np.arange(40, 90))):
        met = np.zeros((90, 90), bool)
        if right is None:
            right = left
            met[:] = True
        else:
            met[:40, 40:] = met[40:, :40] = True
        counts, label = vector_dedup._linked(units, crowds, copies, 2, left, right)
        assert (counts == (near & met & ~earlier) @ copies).all()
        reach = smallest_reachable(range(90), [(a, b) for a, b in zip(*np.nonzero(near & met)) if b < a])
        assert label.tolist() == [reach[i] for i in range(90)]


# -- 9 ------------------------------------------------------------------------------------------------


def test_line_dedup(spark):
    rng = random.Random(14)
    line = " ".join(sentence(rng) for _ in range(4))
    near = line.replace(line.split()[10], "otherword", 1)
    texts = [f"{line}\n{sentence(rng)}\n\n{sentence(rng)}", f"{near}\nshort", f"  {line.upper()}\n\nShort\n{sentence(rng)}", None, "", "\n \n", line, f"{sentence(rng)}\nab\nab"]
    rows = docs(spark, texts).withColumn("line", F.lit(1)).withColumn("removed", F.lit(2))
    found = {r.doc_id: (r.n_lines, r.n_removed, r.removed) for r in line_dedup.op9_line_dedup(rows).collect()}
    assert found == {0: (3, 0, []), 1: (2, 1, [0]), 2: (3, 2, [0, 2]), 3: (0, 0, []), 4: (0, 0, []), 5: (0, 0, []), 6: (1, 1, [0]), 7: (3, 1, [2])}
    left = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(rows).collect()}
    assert 6 not in left and left[1] == "short" and left[2] == "\n" + texts[2].split("\n")[3]
    assert [left[i] for i in (3, 4, 5)] == texts[3:6]
    assert line_dedup.op9_line_dedup(docs(spark, [])).count() == 0


def test_line_bands_and_check():
    rng = random.Random(15)
    lines = [" ".join(sentence(rng) for _ in range(5)).lower() for _ in range(200)]
    others = [edited(rng, x, 0.03) for x in lines]
    grams = lambda x: {x[i : i + 8] for i in range(max(1, len(x) - 7))}
    truth = np.array([100 * len(grams(a) & grams(b)) >= 75 * len(grams(a) | grams(b)) for a, b in zip(lines, others)])
    assert (line_dedup.alike(lines, others) == truth).all() and 20 < truth.sum()
    met = (line_dedup.bands(lines) == line_dedup.bands(others)).any(axis=1)
    assert met[truth].mean() >= 0.95
    assert line_dedup.alike(["a"], ["a"])[0] and not line_dedup.alike(["a"], ["b"])[0]


@pytest.mark.parametrize("unit_chars", [1 << 18, 1500])
def test_chains_of_lines(spark, monkeypatch, unit_chars):
    monkeypatch.setattr(line_dedup, "UNIT_CHARS", unit_chars)
    rng = random.Random(23)
    lines = []
    for _ in range(60):
        words = [rng.choice(WORDS) + rng.choice(["", "s", "ly", "ing"]) for _ in range(36)]
        for k in range(6):  # each differs from the one before in two words, few reach the first one
            words[6 * k + 1] = words[6 * k + 4] = "".join(rng.choices("abcdefgh", k=5))
            lines.append(" ".join(words))
    values = line_dedup.bands(lines)
    pairs = [(a, b) for a in range(len(lines)) for b in range(a) if (values[a] == values[b]).any()]
    linked = line_dedup.alike([lines[a] for a, _ in pairs], [lines[b] for _, b in pairs])
    reach = smallest_reachable(range(len(lines)), [x for x, y in zip(pairs, linked) if y])
    found = {r.doc_id: r.n_removed for r in line_dedup.op9_line_dedup(docs(spark, lines)).collect()}
    assert not linked.all() and found == {i: int(reach[i] != i) for i in reach}


# -- 10 -----------------------------------------------------------------------------------------------


def test_language_id(spark):
    rng = random.Random(16)
    alphabets = {"aa": "abcdefgh", "bb": "efghijklm", "cc": "жзийклмн"}
    made = [(lang, " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(30))) for lang, letters in alphabets.items() for _ in range(60)]
    rows = [(i, t, lang, "s", 0) for i, (lang, t) in enumerate(made)] + [(900, None, "aa", "s", 0), (901, "12 !? \n", "bb", "s", 0), (902, "", None, "s", 0), (903, "abc fgh", None, None, 0)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash"))
    found = {r.doc_id: r for r in language_id.op10_language_id(frame).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    held = [i for i, r in found.items() if r.held_out and i < 900]
    assert np.mean([found[i].lang_pred == made[i][0] for i in held]) >= 0.97 and held
    assert [(found[i].lang_pred, found[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert all(0 <= r.score <= 1 for r in found.values()) and found[903].lang_pred in alphabets
    nothing = language_id.op10_language_id(spark.createDataFrame(rows[-3:], DOCS).withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert language_id.op10_language_id(docs(spark, [])).count() == 0


def test_texts_unlike_any_language_are_rejected(spark):
    rng = random.Random(17)
    syllables = {"aa": "ba ce di fo gu ha".split(), "bb": "lem nor pis quo rat sel".split()}
    made = lambda lang, n: " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    clean = [(lang, made(lang, rng.choice([8, 15, 40, 200, 900]))) for lang in syllables for _ in range(400)]
    junk = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000)), " ".join("".join(rng.choice("xzvwjk") for _ in range(5)) for _ in range(300)), "ж и й " * 200]
    rows = docs(spark, []).unionByName(spark.createDataFrame(
        [(i, t, lang, "s", 0) for i, (lang, t) in enumerate(clean)] + [(9000 + i, t, None, "s", 0) for i, t in enumerate([*junk, None, "12 34", "ba"])], DOCS))
    model = language_id.fit(rows)
    usual = language_id.usual_means(rows, model)
    assert set(usual) == set(syllables) and all(len(x) >= 3 for x in usual.values())
    found = language_id.identify(rows, model, mean="m").withColumn("gone", language_id.rejected(usual, "m")).collect()
    assert sorted(r.doc_id for r in found if r.gone) == [9000, 9001, 9002, 9003, 9004]
    assert language_id.identify(rows, language_id.LanguageModel([], np.zeros(0), np.zeros((1, 0))), mean="m").where(language_id.rejected({}, "m")).count() == len(found)


def test_language_of_ties_repeated_rows_and_long_texts(spark):
    rows = docs(spark, ["ab ab"] * 8, "aa").unionByName(docs(spark, ["ab ab"] * 8, "bb")).unionByName(docs(spark, ["ab " * 700_000], None))
    learned = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 4 != 2)
    found = language_id.op10_language_id(rows.withColumn("doc_id", F.lit(learned).cast("long"))).collect()
    assert len(found) == 17 and {(r.lang_pred, round(r.score, 6)) for r in found} == {("aa", 0.5)}
