"""Ranked lexical search: documents grouped by the mask of terms they match."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

TOP = 10

# The constants of the score.
SCALE = 1_000_000_000
FREQUENCY, LENGTH, FLAT, SLOPE = 1000, 8, 10, 90

# Bytes of item texts that are searched in one pass over the documents; their terms and
# weights are what the tasks are sent. More items take more passes.
ITEM_BYTES = 8_000_000

# What a task holds at once: bytes of text it splits, postings and documents it ranks.
BYTES_AT_ONCE = 8_000_000
POSTINGS_AT_ONCE = 1_000_000
DOCS_AT_ONCE = 16_384

# Shares in which an item's best documents of all tasks are first merged.
SHARES = 16

MASK_BITS = 64

# Letters A-Z in lower case, every other byte that is no part of a term a blank.
TERM_BYTES = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A
    else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80
    else 0x20
    for byte in range(256)
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a long one in pieces that end between terms."""
    text = text.translate(TERM_BYTES)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + BYTES_AT_ONCE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


@dataclass
class Items:
    """Items searched together: their terms by number, and what each is called."""

    ids: list = field(default_factory=list)
    terms: list[np.ndarray] = field(default_factory=list)
    numbers: dict[bytes, int] = field(default_factory=dict)
    size: int = 0

    def add(self, item_id, text: bytes) -> None:
        own = {term for piece in terms_of(text) for term in piece}
        numbers = self.numbers
        self.ids.append(item_id)
        self.terms.append(
            np.array(sorted(numbers.setdefault(t, len(numbers)) for t in own), np.int32)
        )
        self.size += len(text)


def _blocks(items: DataFrame) -> Iterator[Items]:
    """Items in blocks of bounded size, one block on the driver at a time."""
    block = Items()
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    for row in items.select("item_id", text).toLocalIterator():
        if block.size and block.size + len(row["text"]) > ITEM_BYTES:
            yield block
            block = Items()
        block.add(row["item_id"], bytes(row["text"]))
    if block.ids:
        yield block


def _postings(numbers: dict[bytes, int]):
    """(doc_id, n, terms, counts): a document's length and the terms of the items in it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(numbers) + 1
        for batch in batches:
            texts = batch.column("text")
            begin = 0
            while begin < batch.num_rows:
                lengths, found, places, size, at = [], [], [], 0, begin
                while at < batch.num_rows and (size < BYTES_AT_ONCE or at == begin):
                    text, length = texts[at].as_py(), 0
                    for piece in terms_of(text):
                        length += len(piece)
                        known = [numbers[t] for t in piece if t in numbers]
                        one, count = np.unique(np.array(known, np.int64), return_counts=True)
                        found.append((one + (at - begin) * width, count))
                    lengths.append(length)
                    size += len(text)
                    at += 1
                keys = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
                counts = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
                # A long text comes in pieces: its counts of one term are added up.
                keys, place = np.unique(keys, return_inverse=True)
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, place, counts)
                borders = np.searchsorted(keys, np.arange(at - begin + 1) * width)
                offsets = pa.array(borders, pa.int32())
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(begin, at - begin),
                        "n": pa.array(lengths, pa.int64()),
                        "terms": pa.ListArray.from_arrays(
                            offsets, pa.array(keys % width, pa.int32())
                        ),
                        "counts": pa.ListArray.from_arrays(
                            offsets, pa.array(total, pa.int64())
                        ),
                    }
                )
                begin = at

    return rows


class Best:
    """The best documents of an item so far."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.nameless = np.zeros(0, bool)

    def least(self) -> int:
        """What a document must reach, or tie with, to get in."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        good = scores >= self.least()
        scores = np.concatenate([self.scores, scores[good]])
        ids = np.concatenate([self.ids, ids[good]])
        nameless = np.concatenate([self.nameless, nameless[good]])
        order = np.lexsort((ids, nameless, -scores))[: self.top]
        self.scores, self.ids = scores[order], ids[order]
        self.nameless = nameless[order]


@dataclass
class Chunk:
    """Postings of some documents by term: rows, and the part of the score without weight."""

    ids: np.ndarray
    nameless: np.ndarray
    rows: np.ndarray
    parts: np.ndarray
    begins: np.ndarray
    most: np.ndarray

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        place = slice(self.begins[term], self.begins[term + 1])
        return self.rows[place], self.parts[place]


def _masks(chunk: Chunk, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents that match any term, the distinct masks of matched terms (a row of
    booleans each), and which mask each document has."""
    words = -(-len(terms) // MASK_BITS)
    masks = np.zeros((len(chunk.ids), words), np.uint64)
    for place, term in enumerate(terms):
        rows, _ = chunk.of(term)
        masks[rows, place // MASK_BITS] |= np.uint64(1 << place % MASK_BITS)
    matched = np.flatnonzero(masks.any(axis=1))
    masks = masks[matched]
    if words == 1:
        distinct, of = np.unique(masks[:, 0], return_inverse=True)
        distinct = distinct[:, None]
    else:
        distinct, of = np.unique(masks, axis=0, return_inverse=True)
    bits = np.unpackbits(
        np.ascontiguousarray(distinct.astype("<u8")).view(np.uint8), axis=1, bitorder="little"
    )
    return matched, bits[:, : len(terms)].astype(bool), of.ravel()


def _search(chunk: Chunk, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Takes the masks in order of the score that their terms can reach in this chunk,
    until no further mask can reach the last of the best."""
    matched, masks, of = _masks(chunk, terms)
    if not len(matched):
        return
    bounds = masks @ (weights[terms] * chunk.most[terms])
    order = np.argsort(-bounds, kind="stable")
    sizes = np.bincount(of, minlength=len(masks))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    turn = place[of]
    done, wanted = 0, best.top
    while done < len(order) and bounds[order[done]] >= best.least():
        # As many masks as hold the documents wanted; ever more, so that rounds are few.
        reach = np.cumsum(sizes[order[done:]])
        last = done + int(np.searchsorted(reach, wanted)) + 1
        open_masks = int(np.searchsorted(-bounds[order], -best.least(), "right"))
        last = min(last, open_masks, len(order))
        chosen = np.zeros(len(chunk.ids), bool)
        chosen[matched[(turn >= done) & (turn < last)]] = True
        scores = np.zeros(len(chunk.ids), np.int64)
        for term in terms[masks[order[done:last]].any(axis=0)]:
            rows, parts = chunk.of(term)
            hit = chosen[rows]
            scores[rows[hit]] += weights[term] * parts[hit]
        rows = np.flatnonzero(chosen)
        best.add(scores[rows], chunk.ids[rows], chunk.nameless[rows])
        done, wanted = last, wanted * 32


def _chunks(batch: pa.RecordBatch, documents: int, length: int, width: int) -> Iterator[Chunk]:
    ids = batch.column("doc_id")
    nameless = ids.is_null().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy()
    n = batch.column("n").to_numpy()
    # Beyond 64 bits only in between.
    damped = np.array([FLAT + SLOPE * int(x) * documents // length for x in n], np.int64)
    offsets = batch.column("terms").offsets.to_numpy()
    terms = batch.column("terms").values.to_numpy()
    counts = batch.column("counts").values.to_numpy()
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + POSTINGS_AT_ONCE, "right")) - 1
        end = min(max(end, begin + 1), begin + DOCS_AT_ONCE, batch.num_rows)
        own = slice(offsets[begin], offsets[end])
        rows = np.repeat(np.arange(end - begin), np.diff(offsets[begin : end + 1]))
        tf, term = counts[own], terms[own]
        parts = SCALE * tf // (FREQUENCY * tf + LENGTH * damped[begin:end][rows])
        order = np.argsort(term, kind="stable")
        most = np.zeros(width, np.int64)
        np.maximum.at(most, term, parts)
        yield Chunk(
            ids[begin:end],
            nameless[begin:end],
            rows[order],
            parts[order],
            np.searchsorted(term[order], np.arange(width + 1)),
            most,
        )
        begin = end


def _ranked(items: Items, weights: np.ndarray, documents: int, length: int, top: int):
    """(item, doc_id, score): the best documents of each item in a task's share."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in items.terms]
        for batch in batches:
            for chunk in _chunks(batch, documents, length, len(weights)):
                for own, terms in zip(best, items.terms):
                    _search(chunk, terms, weights, own)
        for number, own in enumerate(best):
            if len(own.ids):
                yield pa.RecordBatch.from_pydict(
                    {
                        "item": pa.array([number] * len(own.ids), pa.int32()),
                        "doc_id": pa.array(own.ids, pa.int64(), mask=own.nameless),
                        "score": pa.array(own.scores, pa.int64()),
                    }
                )

    return rows


def _weights(index: DataFrame, documents: int, terms: int) -> np.ndarray:
    holding = np.zeros(terms, np.int64)
    counted = index.select(F.explode("terms").alias("term")).groupBy("term").count()
    for row in counted.collect():  # at most the terms of a block of items
        holding[row["term"]] = row["count"]
    return np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in holding],
        np.int64,
    )


def _best(docs: DataFrame, items: Items, top: int) -> DataFrame:
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    index = docs.select(F.col("doc_id").cast("long"), text).mapInArrow(
        _postings(items.numbers), "doc_id long, n long, terms array<int>, counts array<long>"
    )
    index = stored(index.filter("n > 0"), "lexical-index")
    documents, length = index.agg(F.count(F.lit(1)), F.sum("n")).first()
    weights = _weights(index, documents, len(items.numbers))
    found = index.mapInArrow(
        _ranked(items, weights, documents, length or 1, top),
        "item int, doc_id long, score long",
    )
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = found.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)))
    for keys in (["item", "share"], ["item"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", rank).filter(F.col("rank") <= top)
    names = spark.createDataFrame(
        [Row(item=number, item_id=item_id) for number, item_id in enumerate(items.ids)],
        "item int, item_id long",
    )
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every row of ``items``.

    Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A
    document's score sums weight times saturated, length-damped frequency over the
    item's distinct terms, in integers; only scores above 0 count, equal ones go by
    doc_id, rows without one last.

    One pass over the texts keeps, of every document, its length and its counts of the
    items' terms; numbers of documents are summed over that. Then each task groups the
    documents of a chunk by the mask of an item's terms they match, and evaluates the
    masks in descending order of the most their terms can score there, until the next
    cannot reach the last of the item's best. The tasks' best are merged.

    A null or blank text has no terms: it counts as no document, and as an item it finds
    nothing. Rows that repeat are documents, and items, of their own. Without documents
    or items the result is empty. Texts of any length are split in pieces, items beyond
    ``ITEM_BYTES`` are searched in several passes.
    """
    found = None
    for block in _blocks(items):
        best = _best(docs, block, top)
        found = best if found is None else found.unionByName(best)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "item_id long, rank int, doc_id long, score long"
        )
    return found
