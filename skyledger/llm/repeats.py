"""Removal of long repeated word sequences, found by recompression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored

WINDOW_WORDS = 35

# Rounds that name pairs. Each loses at most one symbol at either end of a window, so
# that after four of them every window without long runs still holds a whole symbol.
PAIR_ROUNDS = 4

# Words of whole documents handled together; bounds memory, not the result.
WORDS_AT_ONCE = 250_000

_U = np.uint64
_BASES = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4D))
_NEVER = 1 << 40


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


class Words:
    """Words of some documents in one array: two 64-bit hashes of each word, and sums
    from which the hash of any stretch of words follows."""

    def __init__(self, docs: list[list[bytes]]) -> None:
        size = np.fromiter(map(len, docs), np.int64, len(docs))
        self.end = np.cumsum(size)
        self.start = self.end - size
        digest = xxhash.xxh3_128_digest
        flat = b"".join([digest(w) for words in docs for w in words])
        self.hash = np.frombuffer(flat, ">u8").astype(_U).reshape(-1, 2)
        self.doc = np.repeat(np.arange(len(docs)), size)
        n = len(self.hash)
        self._sums, self._turns = [], []
        for lane, base in enumerate(_BASES):
            up, back = np.ones(n + 1, _U), np.ones(n + 1, _U)
            up[1:], back[1:] = base, _U(pow(int(base), -1, 1 << 64))
            up, back = np.multiply.accumulate(up), np.multiply.accumulate(back)
            total = np.zeros(n + 1, _U)
            np.cumsum(self.hash[:, lane] * up[:n], out=total[1:])
            self._sums.append(total)
            self._turns.append(back)

    def stretch(self, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        """Two hashes of the words from ``start`` to before ``end``."""
        return [
            _mix((total[end] - total[start]) * turn[start])
            for total, turn in zip(self._sums, self._turns)
        ]


def symbols(words: Words, rounds: int = PAIR_ROUNDS) -> tuple[np.ndarray, ...]:
    """(name, start, end, from, to) of the symbols left after ``rounds`` of naming.

    First each run of one word gets a name from the word and its length. Then each
    round splits all names into left and right ones by a hash of the name, and a left
    name followed by a right one becomes a pair, named by both. A name is a function of
    what it stands for, so every document and every task gives equal words equal names
    without a table of names. From ``from`` to ``to`` stand all words that the symbol's
    being there depends on: wherever they recur, it recurs. Ends of documents are
    none of those words, so symbols that depend on them reach beyond any window.
    """
    n = len(words.hash)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(_U), none, none, none, none
    value, doc = words.hash[:, 0], words.doc
    new = np.ones(n, bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], n)
    length = (end - start).astype(_U)
    name = np.where(
        length > 1, _mix(value[start] ^ (length * _BASES[1])), value[start]
    )
    doc = doc[start]
    low = np.where(start > words.start[doc], start - 1, -_NEVER)
    high = np.where(end < words.end[doc], end + 1, _NEVER)
    for k in range(rounds):
        m = len(name)
        is_left = (_mix(name + _U(k + 1)) >> _U(63)) == 0
        same = np.zeros(m + 1, bool)  # same[i]: symbols i - 1 and i are of one document
        same[1:m] = doc[1:] == doc[:-1]
        pair = np.zeros(m + 1, bool)  # pair[i]: symbols i - 1 and i become a pair
        pair[1:m] = same[1:m] & is_left[:-1] & ~is_left[1:]
        head = pair[1:]
        keep = ~pair[:-1]
        before_low = np.where(same[:m], np.concatenate([[0], low[:-1]]), -_NEVER)
        after_high = np.where(same[1:], np.concatenate([high[1:], [0]]), _NEVER)
        alone_low = np.where(is_left, low, np.minimum(low, before_low))
        alone_high = np.where(is_left, np.maximum(high, after_high), high)
        nxt = np.minimum(np.arange(m) + 1, m - 1)
        both = _mix(_mix(name) + name[nxt] * _BASES[0])
        name = np.where(head, both, name)[keep]
        low = np.where(head, np.minimum(low, low[nxt]), alone_low)[keep]
        high = np.where(head, np.maximum(high, high[nxt]), alone_high)[keep]
        start, end = start[keep], np.where(head, end[nxt], end)[keep]
        doc = doc[keep]
    return name, start, end, low, high


def anchors(words: Words, window: int = WINDOW_WORDS) -> dict[str, np.ndarray]:
    """Stretches of consecutive windows that chose one symbol, their anchor.

    A window chooses among the symbols that depend on its own words alone: the longest,
    of those one by hash, of equal ones the last. Windows of equal words thus choose
    symbols of one name at one distance from their start. A window that holds no such
    symbol (it is all one run, say) is its own anchor. ``first`` and ``count`` tell the
    windows, ``name`` the anchor, ``context`` hashes all words of the stretch.
    """
    name, start, end, low, high = symbols(words)
    n = len(words.hash)
    last = words.end[words.doc] - window if n else np.zeros(0, np.int64)
    doc = words.doc[start]
    left = np.maximum(high - window, words.start[doc])
    right = np.minimum(low, words.end[doc] - window)
    fits = np.flatnonzero((left <= right) & (right >= 0))
    left, right = left[fits], right[fits]
    length = np.minimum(end - start, 63)[fits].astype(_U)
    rank = (length << _U(58)) | ((name[fits] >> _U(46)) << _U(40)) | (fits + 1).astype(_U)
    span = right - left + 1
    level = np.frexp(span)[1] - 1
    tops = int(level.max()) + 1 if len(level) else 1
    best = np.zeros((tops, n + 1), _U)
    for k in range(tops):
        own = level == k
        np.maximum.at(best[k], left[own], rank[own])
        np.maximum.at(best[k], right[own] + 1 - (1 << k), rank[own])
    for k in range(tops - 1, 0, -1):
        half = 1 << (k - 1)
        np.maximum(best[k - 1], best[k], out=best[k - 1])
        np.maximum(best[k - 1][half:], best[k][:-half], out=best[k - 1][half:])
    chosen = (best[0][:n] & _U((1 << 40) - 1)).astype(np.int64) - 1
    at = np.flatnonzero(np.arange(n) <= last)
    chosen, doc = chosen[at], words.doc[at]
    new = np.ones(len(at), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (chosen[1:] < 0) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(at)))
    first, chosen, doc = at[head], chosen[head], doc[head]
    one, two = words.stretch(first, first + count - 1 + window)
    symbol = np.maximum(chosen, 0)
    away = np.where(chosen < 0, 0, start[symbol] - first) if len(start) else first
    label = np.where(chosen < 0, one, name[symbol]) if len(start) else one
    context = _mix(one + _mix(two + away.astype(_U) * _BASES[0] + count.astype(_U)))
    return {
        "name": label.view(np.int64),
        "context": context.view(np.int64),
        "doc": doc,
        "stretch": pack(first - words.start[doc], count),
    }


def pack(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A stretch of windows as one long: its first word and its windows, under 64."""
    return (first << 6) | count


# Spark side


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]]]]:
    """The batch's documents as words, a bounded number of words at once."""
    held, size, begin = [], 0, 0
    for row, text in enumerate(batch.column("text")):
        held.append(_words(text.as_py()))
        size += len(held[-1])
        if size >= WORDS_AT_ONCE:
            yield begin, held
            held, size, begin = [], 0, row + 1
    if held:
        yield begin, held


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = batch.column("key").to_numpy()
        for begin, docs in _grouped(batch):
            found = anchors(Words(docs))
            found["key"] = key[begin + found.pop("doc")]
            yield pa.RecordBatch.from_pydict(found)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stretches = batch.column("stretches")
        for begin, docs in _grouped(batch):
            words = Words(docs)
            part = stretches.slice(begin, len(docs))
            packed = part.flatten().to_numpy()
            doc = np.repeat(np.arange(len(docs)), part.value_lengths().to_numpy())
            count = packed & 63
            doc = np.repeat(doc, count)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            first = np.repeat(packed >> 6, count) + nth
            start = words.start[doc] + first
            one, two = words.stretch(start, start + WINDOW_WORDS)
            yield pa.RecordBatch.from_pydict(
                {
                    "one": one.view(np.int64),
                    "two": two.view(np.int64),
                    "key": batch.column("key").to_numpy()[begin + doc],
                    "stretch": pack(first, 1),
                }
            )


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, n_words, n_removed = [], [], []
        for text, stretches in zip(batch.column("text"), batch.column("stretches")):
            words = _words(text.as_py())
            n_words.append(len(words))
            if stretches.values is not None and len(stretches.values):
                packed = stretches.values.to_numpy()
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, packed >> 6, 1)
                np.add.at(change, (packed >> 6) + (packed & 63) + WINDOW_WORDS - 1, -1)
                stay = np.cumsum(change)[:-1] == 0
                words = [words[k] for k in np.flatnonzero(stay)]
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            n_removed.append(n_words[-1] - len(words))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept_text": pa.array(kept, pa.string()),
            }
        )


def _repeated_stretches(docs: DataFrame) -> DataFrame:
    """(key, stretch) of windows whose words also start elsewhere."""
    found = stored(
        docs.select("key", "text").mapInArrow(
            _anchor_rows, "name long, context long, stretch long, key long"
        ),
        "anchors",
    )
    # Stored, so that the join below reads its sides as they are and can split a hot name.
    names = stored(
        found.groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("context").alias("least"),
            F.max("context").alias("most"),
        )
        .filter(F.col("n") > 1)
        .select("name", (F.col("least") == F.col("most")).alias("alike")),
        "shared-names",
    )
    shared = stored(found.join(names, "name"), "shared-anchors")
    unlike = shared.filter(~F.col("alike"))
    contexts = stored(
        unlike.groupBy("name", "context").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "stretch")).alias("one")
        ),
        "contexts",
    )
    again = contexts.filter(F.col("n") > 1).select("name", "context")
    whole = shared.filter("alike").unionByName(
        unlike.join(again, ["name", "context"], "left_semi")
    )
    # Windows of anchors whose surroundings differ, one of each surrounding.
    wanted = contexts.groupBy(F.col("one.key").alias("key")).agg(
        F.collect_set("one.stretch").alias("stretches")
    )
    windows = stored(
        docs.select("key", "text")
        .join(wanted, "key")
        .mapInArrow(_window_rows, "one long, two long, key long, stretch long"),
        "windows",
    )
    twice = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"))
    twice = stored(twice.filter(F.col("n") > 1).select("one", "two"), "window-names")
    single = windows.join(twice, ["one", "two"], "left_semi")
    return whole.select("key", "stretch").unionByName(single.select("key", "stretch"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text), a row for each row of ``docs``.

    Words are separated by ASCII white space and compared as they are. A word goes if
    a window of ``WINDOW_WORDS`` consecutive words of its document covers it and the
    same words also start anywhere else, overlapping or in the same document included;
    windows are judged on the input. Kept words are joined by one space.

    Recompression finds the windows: symbols named alike by all tasks anchor every
    window (``symbols``, ``anchors``). An anchor that occurs once anchors no repeat.
    Occurrences of one anchor in equal surroundings repeat each other; surroundings
    that differ are compared window by window. Windows are told apart by 128 bits of
    hash, surroundings by 64 besides the 64 of the anchor.

    A null or blank text has no words and an empty kept text, and a text of fewer words
    than a window repeats nothing. Repeated rows, the same doc_id included, are
    documents that repeat each other. Rows are told apart by a 64-bit hash of doc_id
    and text; other columns are ignored; an empty table gives an empty result.
    """
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    found = _repeated_stretches(keyed)
    per_row = found.groupBy("key").agg(F.collect_set("stretch").alias("stretches"))
    return (
        keyed.join(per_row, "key", "left")
        .select("doc_id", "text", "stretches")
        .mapInArrow(
            _kept_rows,
            "doc_id long, n_words long, n_removed long, kept_text string",
        )
    )
