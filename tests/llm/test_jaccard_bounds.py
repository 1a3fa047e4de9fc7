"""Word hashes, the bound by set maps, and families of edited copies, against plain Python."""

import random
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("quantweave.llm")
from quantweave.llm import jaccard  # noqa: E402
from quantweave.llm.common import word_hashes  # noqa: E402
from quantweave.llm.jaccard import _map, jaccard_groups  # noqa: E402


@pytest.mark.parametrize("block", [1, 3, 7, 1 << 18])
@pytest.mark.parametrize("fold", [False, True])
def test_word_hashes_follow_words(block, fold):
    draw, seen = random.Random(5), {}
    for _ in range(500):
        text = bytes(draw.choice(b" \t\n\x0b\x0c\r\x1c\x85\xa0aAbBzZ[@`{0\x00") for _ in range(draw.randrange(60)))
        words = (text.lower() if fold else text).split()
        hashes = word_hashes(text, fold, block).tolist()
        assert len(hashes) == len(words)
        for word, value in zip(words, hashes):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_word_hashes_of_a_long_word():
    body = b"x" * 10_000
    assert len({int(word_hashes(one)[0]) for one in (body, body + b"x", body[1:] + b"y")}) == 3
    assert word_hashes(b"a " + body, block=64).tolist() == [*word_hashes(b"a").tolist(), *word_hashes(body).tolist()]


def test_maps_differ_in_no_more_bits_than_sets():
    draw = np.random.default_rng(3)
    for _ in range(200):
        every = draw.integers(0, 1 << 63, draw.integers(1, 3000), np.uint64)
        a, b = (np.unique(every[draw.random(len(every)) < 0.8]) for _ in "ab")
        bits = sum(int(one).bit_count() for one in (_map(a) ^ _map(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def test_family_of_edited_copies(spark):
    draw = random.Random(11)
    origin = [f"w{draw.randrange(900)}" for _ in range(150)]
    texts = []
    for doc in range(160):
        words = list(origin)
        for _ in range(doc % 7):
            words[draw.randrange(len(words))] = draw.choice(["red", "green", "blue"])
        texts.append((doc if doc else 500, " ".join(words[: len(words) - doc % 3])))
    sets = {}
    for doc, text in texts:
        own = text.split()
        sets[doc] = {tuple(own[at : at + 5]) for at in range(len(own) - 4)}
    place = {doc: doc for doc in sets}

    def top(doc):
        while place[doc] != doc:
            doc = place[doc]
        return doc

    for a in sets:
        for b in sets:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                place[high] = low
    rows = jaccard_groups(spark.createDataFrame(texts, "doc_id long, text string"), parts=3).collect()
    assert {row["doc_id"]: row["component_id"] for row in rows} == {doc: top(doc) for doc in sets}
    assert len({top(doc) for doc in sets}) > 1


def test_prefixes_follow_exact_frequencies(spark):
    """Prefixes and fragments against counts of the whole corpus, with copies spread over tasks, at two sizes."""
    draw = random.Random(6)
    passages = [" ".join(f"p{n}x{place}" for place in range(12)) for n in range(100)]
    for count in (60, 600):
        texts = [" ".join(f"w{draw.randrange(10**9)}" for _ in range(draw.randrange(4, 60))) for _ in range(count)]
        texts = [f"{text} {passages[draw.randrange(count // 6)]}" for text in texts] * 2 + ["a b c", "", passages[0]]
        texts += [f"{text} more{at % 3}" for at, text in enumerate(texts[: count // 2])]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5, "doc_id")
        sets = {frozenset(jaccard.shingles(word_hashes(text.encode(), fold=True), 5).tolist()) for text in texts} - {frozenset()}
        often = Counter(gram for one in sets for gram in one)
        want, held = set(), {}
        for one in sets:
            node = jaccard._identity(np.array(sorted(one), np.uint64))
            order = sorted(one, key=lambda gram: (often[gram], gram))
            prefix = [gram for gram in order[: len(one) - jaccard.required(len(one), 80) + 1] if often[gram] > 1]
            want |= {(np.uint64(gram).view(np.int64).item(), node, len(one)) for gram in prefix}
            if prefix:
                held[node] = {np.uint64(gram).view(np.int64).item() for gram in one if often[gram] > 1}
        ordered = jaccard.ordered_sets(jaccard.recurring_grams(docs, 5, 3), 80, 8, 3)
        times = Counter(gram for gram, _, _ in want)
        rows = jaccard.shared_prefixes(ordered, 80).collect()
        assert {(row["gram"], row["node"], row["n"]) for row in rows} == {one for one in want if times[one[0]] > 1}
        assert len(rows) == len({(row["gram"], row["node"]) for row in rows}) > 0
        found = {}
        for row in ordered.filter("part is null").collect():
            assert not found.setdefault(row["node"], set()) & set(row["grams"])
            found[row["node"]] |= set(row["grams"])
        assert found == held
