"""Token ids in directly addressable codes: any id is read without decoding others."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

END_ID = 0

# Ids of a segment, unless one document has more, and ids between two entries of a rank
# directory.
SEGMENT_IDS = 1 << 17
RANK_STEP = 512

MAGIC = b"DAC1"
HEADER = struct.Struct("<4sIQI")

# Distinct words that are encoded as one text, and texts put together at once.
WORDS_IN_TEXT = 2_000
TEXTS_AT_ONCE = 500

# Words whose ids an encoder keeps from call to call; bounds memory, not the result.
KNOWN_WORDS = 600_000


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# The format


def encode_segment(ids: np.ndarray, lengths: np.ndarray, doc_ids: list) -> bytes:
    """A segment: its documents' ids, lengths and doc_ids.

    After the header (magic, documents, ids, levels) stand the doc_ids with a byte each
    that tells whether there is one, and the running lengths. Then come the levels:
    the lowest eight bits of all ids, the next eight of those that go on, and so on.
    Each level has its chunks, a bitmap of the ids that go on, and a directory of the
    number of marked ids before every ``RANK_STEP``.
    """
    rest = ids.astype(np.uint32)
    levels = []
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_STEP // 8), np.uint8)])
        ones = np.bitwise_count(bits.reshape(-1, RANK_STEP // 8)).sum(1, dtype=np.uint32)
        before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4")[: len(ones)]
        sizes = struct.pack("<QQQ", len(rest), len(bits), len(before))
        chunks = (rest & 255).astype(np.uint8).tobytes()
        levels.append(sizes + chunks + bits.tobytes() + before.tobytes())
        if not more.any():
            break
        rest = rest[more] >> 8
    named = np.array([k is not None for k in doc_ids], np.uint8)
    names = np.array([k or 0 for k in doc_ids], "<i8")
    running = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    head = HEADER.pack(MAGIC, len(doc_ids), len(ids), len(levels))
    return b"".join(
        [head, names.tobytes(), named.tobytes(), running.tobytes(), *levels]
    )


class Segment:
    """Reader of a segment over its bytes; nothing is decoded beforehand."""

    def __init__(self, data: bytes) -> None:
        magic, self.n_docs, self.n_ids, levels = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = HEADER.size
        self._names = np.frombuffer(data, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self._named = np.frombuffer(data, np.uint8, self.n_docs, at)
        at += self.n_docs
        self.starts = np.frombuffer(data, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self._levels = []
        for _ in range(levels):
            chunks, bits, before = struct.unpack_from("<QQQ", data, at)
            at += 24
            one = np.frombuffer(data, np.uint8, chunks, at)
            two = np.frombuffer(data, np.uint8, bits, at + chunks)
            three = np.frombuffer(data, "<u4", before, at + chunks + bits)
            at += chunks + bits + 4 * before
            self._levels.append((one, two, three))

    def doc_id(self, k: int) -> int | None:
        return int(self._names[k]) if self._named[k] else None

    def token(self, i: int) -> int:
        """The id at place ``i``: a chunk of each level it has, found by rank."""
        value = 0
        for shift, (chunks, bits, before) in enumerate(self._levels):
            value |= int(chunks[i]) << 8 * shift
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            first = i // RANK_STEP * (RANK_STEP // 8)
            whole = int(np.bitwise_count(bits[first : i >> 3]).sum())
            part = (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            i = int(before[i // RANK_STEP]) + whole + part
        return value

    def ids(self) -> np.ndarray:
        """All ids, for a sequential read."""
        value = np.zeros(self.n_ids, np.uint32)
        at = np.arange(self.n_ids)
        for shift, (chunks, bits, _) in enumerate(self._levels):
            value[at] |= chunks.astype(np.uint32) << np.uint32(8 * shift)
            more = np.unpackbits(bits, count=len(chunks), bitorder="little")
            at = at[more.astype(bool)]
        return value


# Encoding of texts

class Encoder:
    """Ids of whole texts.

    A space or line feed between two characters that are no white space begins a piece
    for the tokenizer, so a text's ids are those of its words, each with what stands
    before it, one after the other. Distinct words are encoded once per call, or less often
    as their ids are kept, many in one text: there every word's first id is one that begins
    with its space or line feed, and no other does. Texts with other white space are encoded
    as they are.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        self._begins = np.zeros(max(vocabulary.values()) + 1, bool)
        # The byte-level alphabet writes a space and a line feed so.
        self._begins[[k for t, k in vocabulary.items() if t[0] in "\u0120\u010a"]] = True
        self._nothing = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64)
        self._known = self._nothing

    def _ids(self, texts: list[str]) -> list[list[int]]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [one.ids for one in found]

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each word has."""
        if not len(words):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        parts = []
        # The tokenizer's own results are large, so only a text's are held at a time.
        cuts = np.append(np.arange(0, len(words), WORDS_IN_TEXT), len(words))
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words)
        for text in pc.binary_join(lists, ""):
            parts += [np.array(x, "<u4") for x in self._ids([text.as_py()])]
        ids = np.concatenate(parts)
        begin = np.flatnonzero(self._begins[ids])
        if len(begin) != len(words):
            raise ValueError("the tokenizer does not begin a piece at every word")
        return ids, np.diff(np.append(begin, len(ids)))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids among which those of each word stand, where they start and how many."""
        known, known_ids, known_size = self._known
        place = pc.index_in(words, value_set=known)
        fresh = place.is_null().to_numpy(zero_copy_only=False)
        place = place.fill_null(0).to_numpy().astype(np.int64)
        place[fresh] = len(known) + np.arange(fresh.sum())
        new = words.filter(pa.array(fresh))
        new_ids, new_size = self._encoded(new)
        ids, size = np.append(known_ids, new_ids), np.append(known_size, new_size)
        if len(size) <= KNOWN_WORDS:
            self._known = pa.concat_arrays([known, new]), ids, size
        elif len(new) > len(words) // 2:
            self._known = self._nothing
        start = np.cumsum(size) - size
        return ids, start[place], size[place]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null counts as empty."""
        texts = pc.fill_null(texts, "").cast(pa.string())
        # A line feed begins a piece as a space does; it stays with its word.
        parted = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        count = pc.list_value_length(parted).to_numpy()
        coded = parted.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy().copy()
        first = np.cumsum(count) - count
        # Other white space beside the one that cut a word off.
        feed = pc.starts_with(words, "\n")
        core = pc.if_else(feed, pc.utf8_slice_codeunits(words, 1), words)
        odd = pc.or_(
            pc.not_equal(pc.utf8_trim_whitespace(core), core), pc.equal(core, "")
        ).to_numpy(zero_copy_only=False)
        odd_texts = np.add.reduceat(odd[code].astype(np.int64), first) > 0
        space = pc.if_else(feed, "", " ")
        spaced = pc.binary_join_element_wise(space, words, "").filter(pa.array(~odd))
        ids, spaced_start, spaced_size = self._words(spaced)
        # A text's first word has no space before it.
        heads, head = np.unique(code[first], return_inverse=True)
        own = [np.array(x, "<u4") for x in self._ids(words.take(pa.array(heads)).to_pylist())]
        size, start = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        size[~odd], start[~odd] = spaced_size, spaced_start
        size = np.append(size, [len(x) for x in own]).astype(np.int64)
        start = np.append(start, len(ids) + np.cumsum([0, *map(len, own)])[:-1])
        flat = np.concatenate([ids, *own])
        code[first] = len(words) + head
        found, end = [], np.cumsum(count)
        for a in range(0, len(end), TEXTS_AT_ONCE):
            last = min(a + TEXTS_AT_ONCE, len(end))
            part = code[first[a] : end[last - 1]]
            taken = size[part]
            at = np.arange(taken.sum()) + np.repeat(
                start[part] - np.cumsum(taken) + taken, taken
            )
            per_text = np.add.reduceat(taken, first[a:last] - first[a])
            found += np.split(flat[at], np.cumsum(per_text)[:-1])
        odd_rows = np.flatnonzero(odd_texts)
        whole = self._ids(texts.take(pa.array(odd_rows)).to_pylist())
        for row, one in zip(odd_rows, whole):
            found[row] = np.array(one, "<u4")
        return found


_ENCODERS: dict[str, Encoder] = {}

# Bytes of texts encoded together; bounds memory, not the result.
BYTES_AT_ONCE = 16_000_000


def _segments(path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(path) or Encoder(path)
        _ENCODERS[path] = encoder
        part, number, size = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        names: list = []

        def segment() -> pa.RecordBatch:
            lengths = np.array([len(ids) for ids in held], np.int64)
            data = encode_segment(np.concatenate(held), lengths, names)
            starts = np.cumsum(lengths) - lengths
            columns = {
                "part": pa.array([part], pa.int32()),
                "number": pa.array([number], pa.int64()),
                "n_ids": pa.array([int(lengths.sum())], pa.int64()),
                "doc_ids": pa.array([names], pa.list_(pa.int64())),
                "starts": pa.array([starts.tolist()], pa.list_(pa.int64())),
                "data": pa.array([data], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            share = pc.fill_null(pc.binary_length(texts), 0).to_numpy().cumsum()
            share = share // BYTES_AT_ONCE
            cuts = np.flatnonzero(np.diff(share, prepend=-1))
            for a, b in zip(cuts, np.append(cuts[1:], len(doc_ids))):
                for doc_id, ids in zip(doc_ids[a:b], encoder.encode(texts.slice(a, b - a))):
                    held.append(np.append(ids, np.uint32(END_ID)))
                    names.append(doc_id)
                    size += len(held[-1])
                    if size >= SEGMENT_IDS:
                        yield segment()
                        held, names, size, number = [], [], 0, number + 1
        if held:
            yield segment()

    return write


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            segment = Segment(batch.column("data")[row].as_py())
            raw = memoryview(segment.ids().astype("<u4")).cast("B")
            at = segment.starts
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:])]
            n = segment.n_docs
            columns = {
                "part": pa.array([batch.column("part")[row].as_py()] * n, pa.int32()),
                "number": pa.array([batch.column("number")[row].as_py()] * n, pa.int64()),
                "doc_id": pa.array([segment.doc_id(k) for k in range(n)], pa.int64()),
                "offset": pa.array(at[:-1], pa.int64()),
                "n_tokens": pa.array(np.diff(at), pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns)


# How segments are stored: as they are, each in a page of its own, so that a filter on part
# and number reads the pages of single segments and nothing is decompressed.
STORAGE = {
    "compression": "none",
    "parquet.page.row.count.limit": 1,
    "parquet.page.size.row.check.min": 1,
    "parquet.page.size.row.check.max": 1,
}


def write_segments(
    docs: DataFrame, tokenizer: str | None = None, order: Sequence[Column] = ()
) -> DataFrame:
    """The stored segments (part, number, n_ids, doc_ids, starts, data) of all documents.

    Documents stand in ``order``, or in ascending doc_id, those without one first, and end
    with id 0. A part is what one task wrote, in order. Beside its data a segment has the
    doc_ids of its documents and the places at which they start. Spark's writer commits
    the segments, so a lost executor leaves no half of one, and any store that Spark
    reaches can hold them. A null text counts as empty; repeated rows are written
    repeatedly, without ``order`` those of one doc_id in order of a hash of their text; an
    empty table gives no segment.
    """
    # The hash deals a doc_id that many rows share, null above all, over several parts.
    keys = [key.alias(f"key_{k}") for k, key in enumerate(order)] or [
        F.col("doc_id").alias("key_0"), F.xxhash64("text").alias("key_1")
    ]
    names = [f"key_{k}" for k in range(len(keys))]
    ordered = (
        docs.select("doc_id", "text", *keys)
        .repartitionByRange(*names)
        .sortWithinPartitions(*names)
    )
    schema = (
        "part int, number long, n_ids long, doc_ids array<long>, starts array<long>, data binary"
    )
    segments = ordered.mapInArrow(_segments(tokenizer or vocabulary()), schema)
    return stored(segments, "token-segments", **STORAGE)


def _segment_starts(segments: DataFrame) -> DataFrame:
    """(part, number, start): the place of a segment's first id among all ids."""
    sizes = segments.select("part", "number", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        sizes.groupBy("part")
        .agg(F.sum("n_ids").alias("ids"))
        .select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))
    )
    within = (
        Window.partitionBy("part")
        .orderBy("number")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inner")
    return (
        sizes.select("part", "number", inner)
        .join(parts, "part")
        .select("part", "number", (F.col("part_start") + F.col("inner")).alias("start"))
    )


def read_documents(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the segments alone.

    Starts are in the order in which the documents were written. Documents without a
    doc_id and repeated rows have rows of their own; no segments give no rows.
    """
    schema = (
        "part int, number long, doc_id long, offset long, n_tokens long, ids_crc32 long"
    )
    return (
        segments.select("part", "number", "data")
        .mapInArrow(_documents, schema)
        .join(_segment_starts(segments), ["part", "number"])
        .select(
            "doc_id",
            (F.col("start") + F.col("offset")).alias("start"),
            "n_tokens",
            "ids_crc32",
        )
    )


# Segments that are asked for by name; of more, all are read.
NAMED_SEGMENTS = 1_000


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, asked in zip(batch.column("data"), batch.column("asked").to_pylist()):
            segment = Segment(data.as_py())
            tokens = [segment.token(one["at"]) for one in asked]
            columns = {
                "request": pa.array([one["request"] for one in asked], pa.int64()),
                "nth": pa.array([one["nth"] for one in asked], pa.int64()),
                "token": pa.array(tokens, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns)


def _looked_up(segments: DataFrame, asked: DataFrame) -> DataFrame:
    """(request, nth, token) for (part, number, at, request, nth): the ids at these places
    of their segments. Only those segments are read, and of each id only its chunks."""
    asked = stored(asked, "token-requests")
    named = asked.select("part", "number").distinct().limit(NAMED_SEGMENTS + 1).collect()
    if len(named) <= NAMED_SEGMENTS:
        # Reaches the pages: a segment has one of its own.
        one = [(F.col("part") == p) & (F.col("number") == n) for p, n in named]
        segments = segments.filter(reduce(lambda a, b: a | b, one, F.lit(False)))
    per_segment = asked.groupBy("part", "number").agg(
        F.collect_list(F.struct("at", "request", "nth")).alias("asked")
    )
    return (
        segments.select("part", "number", "data")
        .join(per_segment, ["part", "number"])
        .select("data", "asked")
        .mapInArrow(_tokens, "request long, nth long, token long")
    )


def read_tokens(segments: DataFrame, requests: DataFrame) -> DataFrame:
    """(doc_id, place, token): the id at each ``place``, from 0, of the document ``doc_id``.

    ``requests`` has doc_id and place; those that repeat are answered once. Segments are
    found by their lists of doc_ids and the ids in them by rank, without decoding others.
    A place that no document of this doc_id has, or a null one, gets a null token;
    documents that share a doc_id give a row each.
    """
    requests = requests.select(F.col("doc_id").cast("long"), F.col("place").cast("long"))
    requests = stored(
        requests.distinct().withColumn("request", F.xxhash64("doc_id", "place")), "token-asked"
    )
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array("n_ids"))
    entries = segments.select(
        "part", "number", F.explode(F.arrays_zip("doc_ids", "starts", ends.alias("ends"))).alias("e")
    ).select("part", "number", "e.doc_ids", "e.starts", "e.ends")
    found = (
        requests.join(entries, F.col("doc_id") == F.col("doc_ids"))
        .filter((F.col("place") >= 0) & (F.col("place") < F.col("ends") - F.col("starts")))
        .select(
            "part",
            "number",
            (F.col("starts") + F.col("place")).alias("at"),
            "request",
            F.xxhash64("part", "number", "starts").alias("nth"),
        )
    )
    tokens = _looked_up(segments, found)
    return requests.join(tokens, "request", "left").select("doc_id", "place", "token")


def read_places(segments: DataFrame, places: DataFrame) -> DataFrame:
    """(place, token): the id at each ``place`` of all ids, as ``start`` counts them.

    Places that repeat are answered once; those before the first id, beyond the last, or
    null get a null token.
    """
    places = places.select(F.col("place").cast("long")).distinct()
    # Segments and places meet by a grid as wide as a usual segment.
    last = F.col("start") + F.col("n_ids") - 1
    cells = F.sequence(F.floor(F.col("start") / SEGMENT_IDS), F.floor(last / SEGMENT_IDS))
    spans = (
        segments.select("part", "number", "n_ids")
        .join(_segment_starts(segments), ["part", "number"])
        .withColumn("cell", F.explode(cells))
    )
    here = F.col("place") - F.col("start")
    found = (
        places.withColumn("cell", F.floor(F.col("place") / SEGMENT_IDS))
        .join(spans, "cell")
        .filter((here >= 0) & (here < F.col("n_ids")))
        .select(
            "part", "number", here.alias("at"), F.col("place").alias("request"),
            F.lit(0).cast("long").alias("nth"),
        )
    )
    tokens = _looked_up(segments, found)
    return places.join(tokens, F.col("place") == F.col("request"), "left").select(
        "place", "token"
    )
