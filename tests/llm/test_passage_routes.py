"""Copies and routes of the repeated passages, against plain Python."""

import random
from collections import Counter

import pytest

pytest.importorskip("quantweave.llm")
from quantweave.llm.passages import first_texts, recurring_windows, remove_repeats, routes_of, with_first  # noqa: E402


def made():
    draw = random.Random(4)
    shared = [[f"p{n}x{place}" for place in range(40)] for n in range(6)]
    texts = []
    for _ in range(80):
        words = [f"w{draw.randrange(10**6)}" for _ in range(draw.randrange(30))]
        texts.append(" ".join(words + shared[draw.randrange(6)][draw.randrange(20) :] + words[:5]))
    rows = [(draw.randrange(1000), draw.choice(texts[:40])) for _ in range(120)] + list(enumerate(texts))
    return [*rows, (3, "short copy"), (9, "short copy"), (2, None), (None, texts[0]), (None, texts[0]), (7, "")]


def windows(text):
    words = (text or "").split()
    return [tuple(words[at : at + 13]) for at in range(len(words) - 12)]


def test_copies_and_routes(spark):
    rows = made()
    owner = {}
    for doc, text in rows:
        for one in windows(text) if doc is not None else ():
            owner[one] = min(owner.get(one, doc), doc)
    want = []
    for doc, text in rows:
        words = (text or "").split()
        gone = {at + step for at, one in enumerate(windows(text)) if doc is not None and owner[one] < doc for step in range(13)}
        want.append((doc, len(words), len(gone), " ".join(word for at, word in enumerate(words) if at not in gone)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "text")
    for parts in (2, 16):
        found = remove_repeats(docs, parts=parts).select("doc_id", "n_words", "n_removed", "kept").collect()
        assert Counter(map(tuple, found)) == Counter(want)


def test_a_pair_is_routed_once_however_many_ranges(spark):
    rows = [(doc, text) for doc, text in made() if doc is not None]
    first, owner, pairs = {}, {}, set()
    for doc, text in rows:
        first[text or ""] = min(first.get(text or "", doc), doc)
    for text, doc in first.items():
        for one in windows(text):
            owner[one] = min(owner.get(one, doc), doc)
    for text, doc in first.items():
        pairs |= {(doc, owner[one]) for one in windows(text) if owner[one] != doc}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 16):
        found = routes_of(recurring_windows(first_texts(with_first(docs)), 13, parts)).collect()
        assert len(found) == len(pairs) and {(row["doc_id"], row["owner"]) for row in found} == pairs
