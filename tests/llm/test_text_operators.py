"""The training-text operators against brute force, on small tables with nulls, empty and long texts, ties and copies."""

import base64
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from quantweave.llm import pii  # noqa: E402
from quantweave.llm.attribution import attribute_tokens  # noqa: E402
from quantweave.llm.bpe import Vocabulary, decode, encode  # noqa: E402
from quantweave.llm.contamination import find_contamination, smith_waterman, without_contamination  # noqa: E402
from quantweave.llm.elias_fano import EliasFano  # noqa: E402
from quantweave.llm.jaccard import jaccard_groups  # noqa: E402
from quantweave.llm.neighbours import nearest  # noqa: E402
from quantweave.llm.passages import remove_repeats  # noqa: E402
from quantweave.llm.quality import select_documents  # noqa: E402
from quantweave.llm.trie import score_texts  # noqa: E402
from quantweave.llm.warc import archive, lookup, write_bundles  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
RNG = np.random.default_rng(5)
WORDS = [f"w{n}" for n in range(300)]


def prose(size):
    return " ".join(RNG.choice(WORDS, size))


@pytest.fixture(scope="module")
def corpus():
    """(doc_id, text): copies, near copies, shared passages, repeated words, a null, empty and very long texts."""
    shared, base = prose(60), prose(80).split()
    texts = [prose(int(n)) for n in RNG.integers(1, 120, 40)]
    texts += [f"{prose(20)} {shared} {prose(9)}" for _ in range(6)] + [" ".join(base)] * 4
    for _ in range(8):
        near = list(base)
        near[int(RNG.integers(0, 80))] = "edited"
        texts.append(" ".join(near))
    texts += [None, "", " \n\t ", "w1", "same " * 400, prose(6000), shared.upper(), "Ünïcode 😀 " + shared]
    return list(enumerate(texts, 10))


@pytest.fixture(scope="module")
def documents(spark, corpus):
    rows = [(doc, text, "x", 7) for doc, text in corpus] + [(None, "no key here " + prose(30), "x", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, node string, score int").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def words(text):
    return (text or "").encode().split()


def test_repeats(documents, corpus, empty):
    first = {}
    for doc, text in corpus:
        own = words(text)
        for at in range(len(own) - 12):
            first.setdefault(tuple(own[at : at + 13]), doc)
    found = {row["doc_id"]: row for row in remove_repeats(documents, parts=3, shard_docs=3).collect()}
    for doc, text in corpus:
        own = words(text)
        gone = set()
        for at in range(len(own) - 12):
            if first[tuple(own[at : at + 13])] < doc:
                gone |= set(range(at, at + 13))
        kept = b" ".join(word for at, word in enumerate(own) if at not in gone)
        row = found[doc]
        assert (row["n_words"], row["n_removed"]) == (len(own), len(gone))
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest() and row["kept"].encode() == kept
    assert found[None]["n_removed"] == 0
    assert remove_repeats(empty).count() == 0


def test_jaccard(documents, corpus, empty):
    sets = {}
    for doc, text in corpus:
        own = (text or "").encode().lower().split()
        sets[doc] = {tuple(own[at : at + 5]) for at in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)} - {()}
    place = {doc: doc for doc in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    place[a] = place[b] = min(place[a], place[b])
        if all(place[place[doc]] == place[doc] for doc in place):
            break
    rows = jaccard_groups(documents, parts=3).collect()
    got = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in rows}
    assert len(rows) == len(corpus) + 1 and got.pop(None)[1] is None
    assert got == {doc: (len(sets[doc]), place[doc]) for doc in sets}
    assert jaccard_groups(empty).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.read(RANKS)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash(vocabulary):
    assert sorted(vocabulary.slots) == list(range(len(vocabulary.tokens)))
    assert vocabulary.rank(b"not a token at all") == -1


def test_bpe(spark, documents, corpus, vocabulary, library, empty):
    more = [(1, "x" * 5000), (2, "don't  stop\n\n\t<|endoftext|> é́ 漢字 123456"), (3, "ab" * 3000)]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    texts = dict(corpus) | dict(more)
    for row in decode(encode(docs, vocabulary, public_tokenizers.PATTERN), vocabulary).collect():
        if row["doc_id"] is not None:
            assert row["ids"] == library.encode_ordinary(texts[row["doc_id"]] or "")
            assert bytes(row["decoded"]) == (texts[row["doc_id"]] or "").encode()
    assert encode(empty, vocabulary, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("rule", ["start", "majority", "share"])
def test_attribution(spark, vocabulary, library, rule):
    texts = [(1, "src", "one two\n\nthree é😀\nfour"), (2, None, ""), (3, "s", None), (4, "漢字", "漢\n字" * 5)]
    docs = spark.createDataFrame(texts, "doc_id long, source string, text string")
    rows = attribute_tokens(docs, vocabulary, public_tokenizers.PATTERN, ("source", "text"), ("text",), rule=rule).collect()
    for doc, source, text in texts:
        whole = f"{source or ''}\n{text or ''}"
        own = sorted((row["start"], row["end"], row["n_tokens"], row["n_crossing"]) for row in rows if row["doc_id"] == doc)
        assert own[0][0] == 0 and own[-1][1] == len(whole)
        ids = library.encode_ordinary(whole)
        assert math.isclose(sum(row[2] for row in own), len(ids))
        expected, at, raw = collections.Counter(), 0, whole.encode()
        for one in ids:
            size = len(library.decode_single_token_bytes(one))
            low = len(raw[: at + 1].decode("utf-8", "ignore")) if raw[at] >= 0x80 and raw[at] < 0xC0 else len(raw[:at].decode())
            starts = [n for n, row in enumerate(own) if row[0] <= low < row[1]]
            expected[starts[0] if starts else -1] += 1
            at += size
        if rule == "start" and doc != 4:
            assert [row[2] for row in own] == [expected[n] for n in range(len(own))]


def luhn(digits):
    twice = [int(one) * 2 if at % 2 else int(one) for at, one in enumerate(reversed(digits))]
    return sum(one - 9 if one > 9 else one for one in twice) % 10 == 0


def base_spans(text):
    patterns = {  # fixed values: the base rules
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for rank, (kind, pattern) in enumerate(patterns.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and any(int(part) > 255 for part in match[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((match.start(), rank, f"{kind}:{match.start()}:{match.end()}"))
    return ",".join(one[2] for one in sorted(found))


def test_pii(spark, empty):
    texts = ["a@b.c.d%x@y.z", "a@b@c.d", "x" * 3000 + "@y.z", "1.2.3.4.5 300.1.1.1 0001.2.3.255", "+1 2", None, "",
             "4111 1111-1111 1111 and 4111111111111112", "é+1 (856) 555-5105x +12345678", "1 " * 3000, "a@b..c a@-.-",
             "1.2.3.4@5.6.7.8", "12-34 5" * 100, "a@b.c@d.e", "password=abc123def", "ünï@x.y 😀 1.1.1.1", "9" * 9000]
    docs = spark.createDataFrame([(n, text, 1) for n, text in enumerate(texts)], "doc_id long, text string, candidates int")
    found = pii.candidates(docs)
    rows = pii.accepted(found, pii.train(found))
    base = F.filter("pii", lambda span: span["base"])
    for row in rows.select("text", pii.digest_text(base).alias("base"), pii.masked(F.col("text"), F.col("pii")).alias("m")).collect():
        assert row["base"] == base_spans(row["text"] or "")
        assert not row["text"] or len(row["text"]) > 500 or "[" in row["m"] or not row["base"]
    plan = rows._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    nothing = pii.candidates(empty)
    assert pii.accepted(nothing, pii.train(nothing)).count() == 0


def test_warc(spark):
    pages = [(1, "http://a", "same"), (2, "http://b\r\nX: y", "same"), (3, None, None), (4, "u", ""), (5, "é", "ü" * 5000), (None, "n", "same")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    rows = {row["page_id"]: row for row in archive(df).collect()}
    for page, _, html in pages:
        raw = (html or "").encode()
        twins = [other for other, _, more in pages if other is not None and (more or "") == (html or "")]
        row = rows[page]
        assert row["payload_bytes"] == len(raw)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = page is None or page == max(twins)
        assert row["record_type"] == ("response" if first else "revisit")
        assert row["refers_to"] == (None if first else max(twins))
        assert bytes(row["payload"]) == (raw if first else b"")
    assert archive(df.limit(0)).count() == 0


def test_warc_lookup(spark, tmp_path):
    pages = spark.createDataFrame([(n, "u", f"page {n}" * 50) for n in range(50)], "page_id long, url string, html string")
    index = write_bundles(pages, str(tmp_path / "w"), frame_bytes=2000, bundle_bytes=20_000)
    assert index.select("bundle").distinct().count() > 1 and index.agg(F.max("frame")).first()[0] > 2
    row = lookup(index, index.filter("page_id = 33").select("record_id")).collect()
    assert [bytes(one["payload"]) for one in row] == [("page 33" * 50).encode()]


def test_secrets_are_whole(spark):
    hexes = hashlib.sha1(b"x").hexdigest()
    secrets = [f'token = "{hexes}"', f"token\t=\t{hexes}", f"'api_key2': '{hexes}'", f'{{"api-key" : "{hexes}"}}', "password=" + "a1" * 250,
               f'secret = "{"b2" * 250}"', f"production_database_service_password_2={hexes}", "pwd: 'correct horse 9 battery'",
               r'secret="ab\"cd 12\\" x', f"Authorization: Bearer {hexes}", f"clientSecret := {hexes}", f"db2_key => {hexes}", f'key="{hexes}"tail9']
    values = [hexes] * 4 + ["a1" * 250, "b2" * 250, hexes, "correct horse 9 battery", r'ab\"cd 12\\', hexes, hexes, hexes, hexes + '"tail9']
    docs = spark.createDataFrame([(n, f"see {one} here") for n, one in enumerate(secrets)] + [(99, "at 10:30:45 and 12:345678")], "doc_id long, text string")
    found = pii.candidates(docs)
    rows = pii.accepted(found, pii.train(found)).select("doc_id", F.col("pii.kind").alias("kinds"), pii.masked(F.col("text"), F.col("pii")).alias("m"))
    held = {row["doc_id"]: row for row in rows.collect()}
    for n, value in enumerate(values):
        assert held[n]["kinds"] == ["secret"] and "[SECRET]" in held[n]["m"] and held[n]["m"].endswith(" here"), secrets[n]
        assert value not in held[n]["m"] and value[-6:] not in held[n]["m"]
    assert held[99]["kinds"] == []


def test_secret_beside_a_base_span(spark):
    docs = [(0, "see password=bob@example.com!x9 here"), (1, "see password=a1!bob@example.com here"), (2, "see token = 1.2.3.4/secret9 here")]
    docs += [(n, f"see secret = abc{n}def here") for n in range(10, 30)]
    found = pii.candidates(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = pii.accepted(found, pii.train(found)).select("doc_id", pii.digest_text(F.col("pii")).alias("s"), pii.masked(F.col("text"), F.col("pii")).alias("m"))
    held = {row["doc_id"]: (row["s"], row["m"]) for row in rows.collect()}
    assert all(held[n][1] == "see [SECRET] here" for n in range(3)), held
    assert held[0][0] == "secret:4:31,email:13:28" and held[2][0] == "secret:4:27,ip:12:19"


def test_quality(spark):
    good, bad = [prose(60) for _ in range(800)], [prose(60) + " vile insult" for _ in range(240)]
    poor = [" | ".join(prose(30).split()) for _ in range(240)]
    rows = [(n, text, 2) for n, text in enumerate(good + bad + poor)] + [(9000, None, 0), (9001, "", 0), (None, good[0], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tail int")
    kinds = [(1, 0)] * 800 + [(1, 1)] * 240 + [(0, 0)] * 240
    labels = [(n, *kind) for n, kind in enumerate(kinds) if n % 2] + [(2, None, 0), (None, 1, 0)]
    kept = select_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    ids = {row["doc_id"] for row in kept.collect()}
    assert kept.columns == ["doc_id", "text", "expected_grade", "tail"]
    held = [n for n in range(1280) if n % 2 == 0]
    assert sum((n in ids) == (n < 800) for n in held) >= 0.95 * len(held) and None in ids
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert select_documents(docs, none).count() == len(rows)


def test_contamination(spark, empty):
    items = [(n, prose(40)) for n in range(20)] + [(50, ""), (51, None), (52, "tiny item")]
    edited = items[3][1].split()
    edited[10], edited[25] = "other", "words"
    docs = [(1, prose(90) + " " + items[0][1].upper() + ". " + prose(20)), (2, prose(50) + " " + " ".join(edited)),
            (3, prose(4000)), (4, None), (5, ""), (6, "a tiny item"), (7, " ".join(items[7][1].split()[:8]) + " " + prose(80))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(row["doc_id"], row["item_id"]): row["score"] for row in find_contamination(df, benchmark).collect()}
    assert set(found) == {(1, 0), (2, 3), (6, 52)} and found[1, 0] == 1.0 and 0.8 < found[2, 3] < 1
    assert set(find_contamination(df, benchmark, block=5).select("doc_id", "item_id").collect()) == set(found)
    assert {row["doc_id"] for row in without_contamination(df, benchmark).collect()} == {3, 4, 5, 7}
    assert find_contamination(empty, benchmark).count() == 0
    assert find_contamination(df, benchmark.limit(0)).count() == 0


def edited_copy(rng, words, share):
    """A copy with words replaced, left out and put in."""
    out = []
    for word in words:
        kind = rng.random()
        if kind < share:
            out.append(f"e{rng.integers(10**6)}")
        elif kind >= 1.3 * share:
            out.append(word)
        if rng.random() < 0.3 * share:
            out.append(f"i{rng.integers(10**6)}")
    return out


def full_scores(items, docs):
    """Every pair that reaches 0.5 by Smith-Waterman over the whole text, but for those without two neighbouring words."""
    number = collections.defaultdict(lambda: len(number) + 1)
    coded = lambda text: np.array([number[word] for word in text.split()], np.uint64)
    expected = {}
    for doc, text in docs:
        for item, own in items:
            pairs = lambda words: set(zip(words.split(), words.split()[1:]))
            score = smith_waterman(coded(own), coded(text))[0] / (2 * len(own.split()))
            if score >= 0.5 and (pairs(own) & pairs(text) or len(own.split()) <= 8):
                expected[doc, item] = score
    return expected


def test_edited_copies_of_short_items(spark):
    rng = np.random.default_rng(11)
    items = [(n, " ".join(rng.choice(WORDS, size))) for n, size in enumerate([3, 5, 8, 9, 9, 10, 10, 12, 17, 22] * 2)]
    nine = items[3][1].split()
    docs = [(0, prose(30) + " " + " ".join(nine[:2] + ["x"] + nine[3:5] + ["y"] + nine[6:]) + " " + prose(30))]
    docs += [(n, f"{prose(15)} {' '.join(edited_copy(rng, items[n % 20][1].split(), 0.3))} {prose(15)}") for n in range(1, 200)]
    expected = full_scores(items, docs)
    found = find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(row["doc_id"], row["item_id"]): row["score"] for row in found.collect()} == expected
    assert (0, 3) in expected and len(expected) > 60


def test_copies_do_not_make_seeds_frequent(spark):
    rng = np.random.default_rng(12)
    items = [(n, " ".join(rng.choice(WORDS, size))) for n, size in enumerate([10, 17, 22])]
    exact = [(n, f"{prose(4)} {items[n % 3][1]} {prose(4)}") for n in range(1000)]
    edited = [(n, f"{prose(9)} {' '.join(edited_copy(rng, items[n % 3][1].split(), 0.35))} {prose(9)}") for n in range(1000, 1200)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for docs in (exact + edited, edited):  # the rows of a document do not depend on the other documents
        found = find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
        rows = {(row["doc_id"], row["item_id"]): row["score"] for row in found}
        assert {pair: score for pair, score in rows.items() if pair[0] >= 1000} == full_scores(items, edited)
        assert sum(pair[0] < 1000 and score == 1 for pair, score in rows.items()) == len(docs) - len(edited)


def test_smith_waterman():
    def plain(a, b):
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = max(0, table[i, j] + (2 if a[i] == b[j] else -1), table[i, j + 1] - 1, table[i + 1, j] - 1)
        return table.max()

    for _ in range(200):
        a, b = RNG.integers(0, 4, 12), RNG.integers(0, 4, 20)
        score, first, last = smith_waterman(a, b)
        assert score == plain(a, b) == plain(a, b[first:last])


def test_neighbours(spark):
    vectors = RNG.normal(size=(600, 16))
    vectors[7] = vectors[3]
    rows = [(n, [float(x) for x in one]) for n, one in enumerate(vectors)]
    rows += [(700, None), (701, [0.0] * 16), (702, [None] + [1.0] * 15), (703, [float("nan")] * 16), (704, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collections.defaultdict(list)
    for row in nearest(df, F.col("vec_id") % 50 == 0, block=200, query_block=5).orderBy("query_id", "rank").collect():
        found[row["query_id"]].append((row["vec_id"], row["score"]))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hit = 0
    for query in range(0, 600, 50):
        score = unit @ unit[query]
        score[query] = -2
        hit += len(set(np.argsort(-score)[:5]) & {one for one, _ in found[query]})
        assert len(found[query]) == 5 and all(math.isclose(value, score[one], abs_tol=1e-12) for one, value in found[query])
        assert [value for _, value in found[query]] == sorted((value for _, value in found[query]), reverse=True)
    assert set(found) == set(range(0, 600, 50)) and hit >= 0.9 * 60
    assert len(nearest(df.filter("vec_id < 3"), F.col("vec_id") == 0).collect()) == 2
    assert nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_elias_fano():
    for size, span in ((1, 5), (1000, 3000), (70_000, 2**63), (70_000, 70_000)):
        values = np.sort(RNG.integers(0, span, size, dtype=np.uint64))
        held = EliasFano(*EliasFano.arrays(values))
        assert (held.get(np.arange(size)) == values).all()
        asked = np.r_[values, RNG.integers(0, span, 500, dtype=np.uint64)]
        place, there = held.find(asked), set(values.tolist())
        assert [at >= 0 for at in place] == [int(one) in there for one in asked]
        assert (values[place[place >= 0]] == asked[place >= 0]).all()


def test_trie(documents, corpus, empty):
    tokens = {doc: [*(text or "").encode().lower().split(), b""] for doc, text in corpus}
    held = {doc: zlib.crc32(str(doc).encode()) % 7 == 2 for doc in tokens}
    rows = {row["doc_id"]: row for row in score_texts(documents, parts=3).collect()}
    train = [own for doc, own in tokens.items() if not held[doc]]
    total = rows[None]["train_tokens"]
    assert total - sum(map(len, train)) == rows[None]["n_tokens"]  # the row without a key is trained on
    for doc, own in tokens.items():
        row = rows[doc]
        assert (row["held_out"], row["n_tokens"]) == (held[doc], len(own))
        assert row["score"] < 0 and row["n_known"] <= row["n_tokens"]
    seen = [doc for doc in tokens if not held[doc]]
    assert sum(rows[doc]["score"] for doc in seen) > sum(rows[doc]["base_score"] for doc in seen)
    assert score_texts(empty).count() == 0


def test_trie_keeps_ngrams_seen_once(documents, corpus):
    from quantweave.llm.common import texts
    from quantweave.llm.trie import build, held_out

    train = texts(documents).withColumn("held", held_out(F.col("doc_id"))).filter("not held").select("body")
    model = build(train, parts=3)
    own = [[*row["body"].lower().split(), b""] for row in train.collect()]
    for size, level in enumerate(model.levels, 1):
        grams = collections.Counter(tuple(one[at : at + size]) for one in own for at in range(len(one) - size + 1))
        assert level.size == len(grams) and min(grams.values()) == 1
    # Interpolated absolute discounting, by hand, of the texts of few words.
    counts = [collections.Counter(tuple(one[at : at + size]) for one in own for at in range(len(one) - size + 1)) for size in (1, 2, 3)]
    total, vocabulary = sum(map(len, own)), len(counts[0])
    # What follows a context, so that a context of n words is shared by its successors.
    follow = [collections.Counter(gram[:-1] for gram in held) for held in counts]

    def chance(gram):
        if len(gram) == 1:
            return (counts[0][gram] + 1) / (total + vocabulary + 1)
        seen, context = counts[len(gram) - 1][gram], gram[:-1]
        lower = chance(gram[1:])
        if not follow[len(gram) - 1][context]:
            return lower
        # As the code does: the context's count is its own entry's.
        whole = counts[len(gram) - 2][context]
        kept = sum(n - 0.75 for other, n in counts[len(gram) - 1].items() if other[:-1] == context)
        return max(seen - 0.75, 0) / whole + (1 - kept / whole) * lower

    rows = {row["doc_id"]: row["score"] for row in score_texts(documents, parts=3).collect()}
    for doc, text in corpus:
        tokens = [*(text or "").encode().lower().split(), b""]
        if len(tokens) <= 40:
            exact = sum(math.log10(chance(tuple(tokens[max(0, at - 2) : at + 1]))) for at in range(len(tokens)))
            assert abs(rows[doc] - exact) <= 0.07 * len(tokens)
