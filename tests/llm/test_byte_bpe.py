"""Words folded in the tasks, against a plain fold, and what reaches the driver."""

import base64
import random

import public_tokenizers as P

from courtside.llm import byte_bpe


def plain_fold(word, ranks):
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_fold_merges_the_lowest_rank_leftmost_first():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    rng = random.Random(3)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for letters in ("ab", "thein ", "é日a ") for _ in range(200)]
    words += [rng.choice(list(ranks)).decode(errors="ignore") + "ing" for _ in range(200)]
    for word in words:
        assert byte_bpe.fold(word.encode(), ranks) == plain_fold(word.encode(), ranks)


def test_no_dictionary_passes_the_driver(spark):
    """The plan has no scalar subquery: it would carry the distinct words of all texts through the driver."""
    docs = spark.createDataFrame([(i, f"word{i} and another word") for i in range(50)], "doc_id long, text string")
    coded = byte_bpe.op3_byte_bpe(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "Exchange" not in plan


def test_words_of_one_length_are_folded_together(monkeypatch):
    """Few words of a batch are folded on their own, however many distinct words it has."""
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    rng = random.Random(5)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for letters in ("ab", "thein ", "é日a ") for _ in range(1500)]
    words = sorted({*words, "x" * 65, "thein" * 30, "\U0001f600" * 20})
    want = [[ranks[w.encode()]] if w.encode() in ranks else plain_fold(w.encode(), ranks) for w in words]
    alone, plain = [], byte_bpe.fold
    monkeypatch.setattr(byte_bpe, "fold", lambda word, known: alone.append(word) or plain(word, known))
    lists = byte_bpe.pa.array([[], [w for w in words], words[::-1], None], byte_bpe.pa.list_(byte_bpe.pa.string()))
    found = byte_bpe._Merges(ranks).encode(lists.slice(1, 2)).to_pylist()
    assert found == [sum(want, []), sum(want[::-1], [])]
    assert len(alone) < len(words) // 4
