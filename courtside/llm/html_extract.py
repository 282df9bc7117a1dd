"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded from the root down.

Each block element gets features of its subtree, attributes, depth and siblings, and from the trees the log-odds
that it holds main text. The decoding chooses the most likely set of elements in which every element's parent is
chosen too, so that nothing is kept inside something dropped.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from courtside.llm.boosting import BoostedTrees, train
from courtside.llm.page_layouts import MARK, labelled_page

#: Pages whose words make the training layouts, and layouts made of them.
TRAIN_SAMPLE, TRAIN_PAGES = 200, 900
#: Consecutive words that a sampled page lends at most, from a place that its hash chooses.
LENT_WORDS = 500
SEED = 11

# Elements of HTML by their role.
TAG_KINDS = {
    "nav": ["nav", "menu"], "header": ["header"], "footer": ["footer"], "aside": ["aside"], "article": ["article"], "main": ["main"],
    "section": ["section"], "div": ["div", "center", "body", "html"], "p": ["p"], "list": ["ul", "ol", "dl"], "item": ["li", "dt", "dd"],
    "heading": ["h1", "h2", "h3", "h4", "h5", "h6"], "table": ["table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"],
    "form": ["form", "fieldset", "legend", "label", "button", "select", "option", "optgroup", "dialog", "details", "summary"],
    "quote": ["blockquote", "pre", "address"], "figure": ["figure", "figcaption"],
}
KIND_OF = {tag: kind for kind, tags in TAG_KINDS.items() for tag in tags}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = set("script style textarea title xmp iframe noembed noframes noscript template svg math object canvas audio video head".split())
CLOSES_P = set(KIND_OF) - {"label", "button", "option", "optgroup", "select", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary", "body", "html", "caption"}
#: What may stand in a head; any other element, or text, ends a head that is open.
IN_HEAD = set("base basefont bgsound link meta title style script noscript noframes template head html".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
CLOSE_STOPS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
ATTRIBUTE_KINDS = {
    "nav": "nav navigation menu navbar breadcrumb breadcrumbs pagination pager toc skip",
    "top": "header masthead banner topbar branding logo",
    "foot": "footer foot copyright colophon legal",
    "side": "sidebar side aside rail widget widgets secondary complementary",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsbygoogle dfp outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay paywall toast subscribe newsletter signup disclaimer",
    "comment": "comment comments commentlist reply replies respond discussion disqus reactions reader",
    "social": "share sharing social related recommended recommendations more tags meta byline author trending popular",
    "form": "form search login register contact input field",
    "body": "content article main post entry story body text prose page document",
    "hidden": "hidden invisible none",
}
_ATTRIBUTE_WORDS: dict[str, int] = {}
for _k, _words in enumerate(ATTRIBUTE_KINDS.values()):
    for _word in _words.split():
        _ATTRIBUTE_WORDS[_word] = _ATTRIBUTE_WORDS.get(_word, 0) | 1 << _k
_TAG_NUMBER = {kind: i for i, kind in enumerate([*TAG_KINDS, "other"])}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _attribute_kinds(text: str, seen: dict[str, int]) -> int:
    """Bits of the kinds that class, id, role, aria-label and style name; `hidden` also by the attribute itself."""
    if text not in seen:
        bits = 0
        for name, value in _ATTRIBUTE.findall(text):
            name = name.lower()
            if name in ("class", "id", "role", "aria-label", "style", "data-role"):
                for word in _NAME_WORD.findall(html.unescape(value)):
                    bits |= _ATTRIBUTE_WORDS.get(word.lower(), 0)
            elif name == "hidden":
                bits |= _ATTRIBUTE_WORDS["hidden"]
        if len(seen) > 10_000:
            seen.clear()
        seen[text] = bits
    return seen[text]


_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _unseen(text: str) -> bool:
    """Whether attributes hide an element: `hidden`, or a style that doesn't display it."""
    lower = text.lower()
    if "hidden" not in lower and "none" not in lower:
        return False
    return any(name.lower() == "hidden" or name.lower() == "style" and _UNSEEN.search(value) for name, value in _ATTRIBUTE.findall(text))


class Page:
    """Block elements in document order, and text pieces with the element and the run that hold them.

    A run is text that no block begins or ends within.
    """

    def __init__(self, source: str, seen: dict[str, int]) -> None:
        self.tags, self.parents, self.kinds, self.marks = ["html"], [-1], [0], [False]
        self.pieces: list[tuple[int, int, str, bool]] = []
        open_: list[tuple[str, int, bool]] = [("html", 0, False)]  # tag, block element, whether its text is hidden
        run = links = hidden = at = 0

        def close(k: int) -> None:
            nonlocal links, hidden, run
            for tag, _, hides in open_[k:]:
                links -= tag == "a"
                hidden -= hides
                run += tag in KIND_OF
            del open_[k:]

        def text(end: int) -> None:
            if open_[-1][0] == "head" and source[at:end].strip():
                close(len(open_) - 1)
            if end > at and not hidden:
                self.pieces.append((open_[-1][1], run, html.unescape(source[at:end]), links > 0))

        while at < len(source):
            found = _TOKEN.search(source, at)
            if not found:
                text(len(source))
                break
            text(found.start())
            at = found.end()
            ends, tag, attributes, last = found.groups()[:4] if found[2] else found.groups()[4:]
            if not tag or last != ">":  # a comment or declaration, or a tag cut off at the end
                continue
            tag = tag.lower()
            if ends:
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k][0] == tag:
                        close(k)
                        break
                continue
            if tag not in IN_HEAD:
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k][0] == "head":
                        close(k)
                        break
                    if open_[k][0] == "template" or open_[k][0] == "noscript" and tag != "body":
                        break
            if tag in VOID:
                if tag == "br" and not hidden:
                    self.pieces.append((open_[-1][1], run, " ", False))
                run += tag == "hr"
                continue
            if tag in CLOSES_P:
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k][0] == "p":
                        close(k)
                        break
                    if open_[k][0] in ("button", "table", "td", "th"):
                        break
            if tag in SAME_CLOSES:
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k][0] in SAME_CLOSES[tag]:
                        close(k)
                        if tag != "tr":
                            break
                    elif open_[k][0] in CLOSE_STOPS[tag]:
                        break
            block = open_[-1][1]
            if tag in KIND_OF and not hidden:
                if tag not in ("html", "body"):
                    block = len(self.tags)
                    self.tags.append(tag)
                    self.parents.append(open_[-1][1])
                    self.kinds.append(_attribute_kinds(attributes, seen))
                    self.marks.append(MARK in attributes)
                run += 1
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                if tag in HIDDEN:
                    at = end.start() if end else len(source)
            if not attributes.endswith("/") or tag in KIND_OF or tag in RAW:
                hides = tag in HIDDEN or tag not in ("html", "body") and _unseen(attributes)
                open_.append((tag, block, hides))
                links += tag == "a"
                hidden += hides

    def features(self) -> np.ndarray:
        """A row for each block element."""
        n = len(self.tags)
        own, linked, stops, pieces = ([0] * n for _ in range(4))
        for block, _, text, link in self.pieces:
            words = len(text.split())
            if words:
                own[block] += words
                linked[block] += words * link
                stops[block] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
                pieces[block] += 1
        parents, kinds = self.parents, self.kinds
        numbers = [_TAG_NUMBER[KIND_OF.get(t, "other")] for t in self.tags]
        paragraphs = [int(t == "p") for t in self.tags]
        items = [int(t == "li") for t in self.tags]
        controls = [int(KIND_OF[t] == "form") for t in self.tags]
        words, all_linked, all_stops, all_pieces, blocks = own[:], linked[:], stops[:], pieces[:], [1] * n
        children, longest = [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            p = parents[i]
            for values in (words, all_linked, all_stops, all_pieces, blocks, paragraphs, items, controls):
                values[p] += values[i]
            children[p] += 1
            longest[p] = max(longest[p], words[i])
        depth, above, before, index, seen, alike = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        count = 0
        tags_below: dict[tuple[int, str], int] = {}
        for i in range(n):
            before[i] = count
            count += own[i]
            if i:
                p = parents[i]
                depth[i], above[i] = depth[p] + 1, above[p] | kinds[p]
                index[i] = seen[p]
                seen[p] += 1
                tags_below[p, self.tags[i]] = tags_below.get((p, self.tags[i]), 0) + 1
        for i in range(1, n):
            alike[i] = tags_below[parents[i], self.tags[i]]
        up = np.array([max(p, 0) for p in parents])
        a = {k: np.array(v, float) for k, v in dict(own=own, words=words, linked=all_linked, stops=all_stops, pieces=all_pieces, blocks=blocks, paragraphs=paragraphs, items=items, controls=controls, depth=depth, before=before, index=index, alike=alike, children=children, longest=longest).items()}
        some, whole = np.maximum(a["words"], 1), max(words[0], 1)
        kind = (np.array(numbers)[:, None] == np.arange(len(_TAG_NUMBER))).astype(float)
        bits = np.arange(len(ATTRIBUTE_KINDS))
        own_bits, above_bits = ((np.array(x)[:, None] >> bits & 1).astype(float) for x in (kinds, above))
        return np.column_stack([
            kind, kind[up], own_bits, above_bits, np.log1p(a["words"]), a["words"] / whole, a["linked"] / some, a["stops"] / some, a["own"] / some,
            some / np.maximum(a["pieces"], 1), np.log1p(a["blocks"]), a["paragraphs"], a["items"] / a["blocks"], a["controls"] / a["blocks"],
            a["depth"], a["index"], a["children"], a["alike"], a["children"][up], a["before"] / whole, a["words"] / np.maximum(a["longest"][up], 1),
            a["words"][up] / whole, a["linked"][up] / some[up], a["paragraphs"][up],
        ])

    def labels(self) -> np.ndarray:
        """Whether each block holds marked text."""
        found = self.marks[:]
        for i in range(len(found) - 1, 0, -1):
            found[self.parents[i]] |= found[i]
        return np.array(found, float)

    def keep(self, odds: np.ndarray) -> np.ndarray:
        """The blocks whose choice is most likely as a whole if each one's parent has to be chosen too."""
        n = len(odds)
        chosen, dropped = odds.tolist(), (-odds).tolist()  # of the subtree, its root chosen or everything dropped
        for i in range(n - 1, 0, -1):
            chosen[self.parents[i]] += max(chosen[i], dropped[i])
            dropped[self.parents[i]] += dropped[i]
        kept = np.zeros(n, bool)
        for i in range(n):
            kept[i] = chosen[i] > dropped[i] and (i == 0 or kept[self.parents[i]])
        return kept

    def text(self, kept: np.ndarray) -> str:
        """Text of the kept blocks: white space within a run is one space, runs are joined by one."""
        parts, last = [], -1
        for block, run, piece, _ in self.pieces:
            if kept[block]:
                parts.append(piece if run == last else " " + piece)
                last = run
        return " ".join("".join(parts).split())


def fit(pages: DataFrame, column: str = "html") -> BoostedTrees:
    """Train on TRAIN_PAGES generated layouts filled with the words of at most TRAIN_SAMPLE pages.

    The layouts label each block as they are made. The pages, those whose html hashes lowest, only lend words, so
    that densities and lengths are like theirs: at most LENT_WORDS each, taken from the whole page.
    """
    rows = pages.where(F.length(column) > 0).select(F.xxhash64(column).alias("h"), F.col(column).alias("source"))
    last = rows.select("h").distinct().orderBy("h").limit(TRAIN_SAMPLE).agg(F.max("h").alias("h")).first()["h"]

    def lend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, source in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = [w for _, _, text, _ in Page(source.as_py(), {}).pieces for w in text.split()]
                at = h % max(1, len(words) - LENT_WORDS + 1)
                yield pa.RecordBatch.from_arrays([pa.array([h]), pa.array([words[at : at + LENT_WORDS]], pa.list_(pa.string()))], ["h", "words"])

    sample = rows.where(F.col("h") <= F.lit(last)).mapInArrow(lend, "h long, words array<string>").dropDuplicates(["h"]).orderBy("h").collect()
    words = [w for row in sample for w in row["words"]] or ["word."]
    seen: dict[str, int] = {}
    rng = np.random.default_rng(SEED)
    made = [Page(labelled_page(rng, words), seen) for _ in range(TRAIN_PAGES)]
    return train(np.concatenate([p.features() for p in made]), np.concatenate([p.labels() for p in made]))


def extract(pages: DataFrame, model: BoostedTrees, column: str = "html") -> DataFrame:
    """The other columns of pages with text and n_chars, of the whole html; null and empty html give an empty text.

    Columns of those names are replaced.
    """
    held = pages.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in pages.columns if c not in (column, "text", "n_chars")]
    schema = T.StructType([*pages.select(rest).schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for whole in batches:
            for first in range(0, whole.num_rows, 200):
                batch = whole.slice(first, 200)
                made = [Page(x or "", seen) for x in batch.column(0).to_pylist()]
                limits = np.cumsum([0, *(len(p.tags) for p in made)])
                odds = held.value.score(np.concatenate([p.features() for p in made]))
                texts = [p.text(p.keep(odds[a:b])) for p, a, b in zip(made, limits[:-1], limits[1:])]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], schema.names)

    return pages.select(column, *rest).mapInArrow(run, schema)


def op1_html_extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return extract(pages.select("page_id", "url", "html"), fit(pages)).select("page_id", "url", "text", "n_chars")
