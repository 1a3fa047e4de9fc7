"""Token counts by field and section: encode a document once, then give each token to the span it lies in."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantweave.llm.bpe import Vocabulary

RULES = ("start", "majority", "share")
SCHEMA = "doc_id long, field string, section int, start int, end int, n_tokens double, n_crossing long"


def token_spans(body: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points (start, end exclusive) that each token touches; a token inside one character touches it whole."""
    place = np.cumsum((np.frombuffer(body, np.uint8) & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths)
    return place[ends - lengths], place[ends - 1] + 1


def allocate(
    starts: np.ndarray, ends: np.ndarray, lows: np.ndarray, highs: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and boundary-crossing tokens of each span. Spans are in order, do not overlap and may leave gaps.

    A token that lies in one span counts there, and one that lies in a gap nowhere. A token that touches several goes
    to the first (``start``), to the one with most of its characters and of those the first (``majority``), or to all
    of them by their share of its characters inside spans (``share``).
    """
    count = len(lows)
    totals, crossing = np.zeros(count), np.zeros(count, np.int64)
    full = np.flatnonzero(highs > lows)
    if not len(full) or not len(starts):
        return totals, crossing
    low, high = lows[full], highs[full]
    first = np.searchsorted(high, starts, "right")
    last = np.searchsorted(low, ends, "left") - 1
    single = first == last
    np.add.at(totals, full[first[single]], 1.0)
    for token in np.flatnonzero(first < last):
        spans = np.arange(first[token], last[token] + 1)
        overlap = np.minimum(high[spans], ends[token]) - np.maximum(low[spans], starts[token])
        crossing[full[spans]] += 1
        if rule == "share":
            totals[full[spans]] += overlap / overlap.sum()
        else:
            totals[full[spans[overlap.argmax() if rule == "majority" else 0]]] += 1
    return totals, crossing


def attribute_tokens(
    docs: DataFrame,
    vocabulary: Vocabulary,
    pattern: str,
    fields: tuple[str, ...] = ("text",),
    sections: tuple[str, ...] = ("text",),
    key: str = "doc_id",
    rule: str = "majority",
    glue: str = "\n",
) -> DataFrame:
    """Tokens of each field, and of each line of the fields in ``sections``, when a document is encoded whole.

    The document is its fields in order, each followed by ``glue`` but the last. A field's span holds the glue after
    it, and a line's span its line feed, so the spans tile the document and counts add up to its tokens under any rule
    of :func:`allocate`. One row per field or line: ``doc_id``, ``field``, ``section`` (line number from 0; 0 for a
    field that is not cut), ``start`` and ``end`` in code points, ``n_tokens``, ``n_crossing``. A null field is empty;
    an empty field that is last has a row with no tokens. Repeated rows stay, other columns are left out.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.tokens)
    columns = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(f"f{n}") for n, name in enumerate(fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = {token: rank for rank, token in enumerate(shared.value)}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        sizes = np.array([len(token) for token in shared.value], np.int64)
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                held: list[list] = [[] for _ in range(7)]
                for doc, *values in zip(*(column.to_pylist() for column in part.columns)):
                    whole, names, numbers, bounds = "", [], [], [0]
                    values = [value + glue for value in values[:-1]] + values[-1:]
                    for name, value in zip(fields, values):
                        cut = value.split("\n") if name in sections else [value]
                        for number, line in enumerate(cut):
                            names.append(name)
                            numbers.append(number)
                            bounds.append(bounds[-1] + len(line) + (number < len(cut) - 1))
                    whole = "".join(values)
                    ids = np.array(encoding.encode_ordinary(whole), np.int64)
                    low, high = np.array(bounds[:-1]), np.array(bounds[1:])
                    spans = token_spans(whole.encode(), sizes[ids]) if len(ids) else (ids, ids)
                    totals, crossing = allocate(*spans, low, high, rule)
                    held[0] += [doc] * len(low)
                    for column, more in zip(held[1:], (names, numbers, low, high, totals, crossing)):
                        column.extend(more)
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64())
                arrays = [pa.array(column, kind) for column, kind in zip(held, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=[one.split()[0] for one in SCHEMA.split(", ")])

    return docs.select(F.col(key).cast("long").alias("doc_id"), *columns).mapInArrow(run, SCHEMA)
