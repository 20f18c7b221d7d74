"""Secret scan: fixed patterns, and a battery of randomness tests for other strings."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored

# The base patterns, over text whose A-Z are lower-cased for the first.
ASSIGN = re.compile(
    rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
    rb"([a-z0-9+/_.=-]+)"
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

# Shortest string that is tested for randomness, the share of ordinary strings among
# those reported that is accepted, and the p-value below which a test of the battery
# speaks against a string's being random, so that parts of it are tested as well.
LEAST_RANDOM = 20
FALSE_DISCOVERIES = 0.01
SIGNIFICANCE = 0.001

# Upper ends of the length classes, each with a false-discovery control of its own.
LENGTH_CLASSES = (32, 64, 128)

# Tenths of a power of ten in which p-values are counted, and how many of them.
P_STEPS, P_BINS = 10, 400

# White space, which no string holds, and what is added to every count of two bytes.
BLANKS = b" \t\n\x0b\x0c\r"
SMOOTHING = 0.5

# Characters of whole documents handled together; bounds memory, not the result.
BYTES_AT_ONCE = 4_000_000

ALPHABETS = {
    "hex": b"0123456789abcdef",
    "hex-upper": b"0123456789ABCDEF",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": b"0123456789abcdefghijklmnopqrstuvwxyz",
    "letters": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}


def _table(*classes: tuple[bytes, int]) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for members, value in classes:
        table[np.frombuffer(members, np.uint8)] = value
    return table


_HEX = _table((b"0123456789abcdef", 1))
# The characters that long encoded strings are made of.
_INSIDE = _table(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=", 1)
)
_ALPHABET_ROWS = {}
for _name, _members in ALPHABETS.items():
    _row = np.full(256, -1, np.int64)
    _row[np.frombuffer(_members, np.uint8)] = np.arange(len(_members))
    _ALPHABET_ROWS[_name] = _row


# Pieces of a stretch in base64, in base64url and without any separator.
_PIECES = [re.compile(p) for p in (rb"[^_-]+", rb"[^+/]+", rb"[^+/_-]+")]

# Digits with letters of one case among them.
_GROUPED = re.compile(rb"[0-9]*[a-f][0-9a-f]*|[0-9]*[A-F][0-9A-F]*")


def _runs(inside: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal stretches of true values, of ``least`` and more."""
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= least
    return list(zip(start[long].tolist(), end[long].tolist()))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(string: bytes) -> tuple[str, float] | None:
    """(encoding, p) of a string: the smallest alphabet that has all its characters and
    the probability of its worst test if it were random there. None: no alphabet has."""
    body = np.frombuffer(string.rstrip(b"="), np.uint8)
    n = len(body)
    for encoding, row in _ALPHABET_ROWS.items():
        value = row[body]
        if n > 1 and (value >= 0).all():
            break
    else:
        return None
    k = len(ALPHABETS[encoding])
    # Uniform alphabet: chi-squared by its exact mean and variance for few characters.
    counts = np.bincount(value, minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    spread = math.sqrt(2 * (k - 1) * (n - 1) / n)
    uniform = 0.5 * math.erfc((chi - (k - 1)) / spread / math.sqrt(2))
    # Runs above and below the middle of the alphabet.
    high = value >= k / 2
    changes = int((high[1:] != high[:-1]).sum())
    runs = _two_sided((changes - (n - 1) / 2) / math.sqrt((n - 1) / 4))
    # Serial correlation at distance one.
    centred = value - (k - 1) / 2
    variance = (k * k - 1) / 12
    serial = _two_sided(float((centred[1:] * centred[:-1]).sum()) / variance / math.sqrt(n - 1))
    return encoding, min(1.0, 3 * min(uniform, runs, serial))


def _parts(whole: bytes, a: int, b: int) -> Iterator[tuple[int, int]]:
    """A stretch cut at every = that does not end it, which no alphabet holds."""
    last = a + len(whole[a:b].rstrip(b"="))
    for part in re.finditer(rb"[^=]+", whole[a:last]):
        end = a + part.end()
        yield a + part.start(), b if end == last else end


def _candidates(whole: bytes, a: int, b: int) -> list[tuple[int, int, bytes, str, float]]:
    """(start, end, characters, encoding, p) of the strings to control in a stretch
    without inner =.

    The stretch itself, if an alphabet has it. Where none has or a test speaks against
    it, also its longest pieces in the alphabets without some of the separators, unless
    within a piece that passes; and where no piece passes, hexadecimal groups between
    ``-`` and ``_`` put together, as in a UUID.
    """
    found: list[tuple[int, int, bytes, str, float]] = []

    def passes(start: int, end: int, body: bytes) -> bool:
        if len(body) < LEAST_RANDOM or any(f[:3] == (start, end, body) for f in found):
            return False
        tested = battery(body)
        if tested:
            found.append((start, end, body, *tested))
        return tested is not None and tested[1] >= SIGNIFICANCE

    body = whole[a:b].rstrip(b"=")
    if passes(a, b, body):
        return found
    passed: list[tuple[int, int]] = []
    for pattern in _PIECES:
        for piece in pattern.finditer(whole, a, a + len(body)):
            start, end = piece.span()
            if not any(x <= start and end <= y for x, y in passed):
                # What ends the stretch ends its last piece.
                last = b if end == a + len(body) else end
                if passes(start, last, piece[0]):
                    passed.append((start, last))
    joined = body.translate(None, b"-_")
    if not passed and _GROUPED.fullmatch(joined):
        passes(a, b, joined)
    return found


def _length_class(n: int) -> int:
    return sum(n >= end for end in LENGTH_CLASSES)


def _scan_texts(texts: list[bytes]) -> dict[str, list]:
    """Spans, in code points, and long strings of some documents."""
    whole = b"\0".join(texts) + b"\0"
    data = np.frombuffer(whole, np.uint8)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    base: list[tuple[int, int, int]] = []
    for found in ASSIGN.finditer(whole.lower()):
        if found.end(1) - found.start(1) >= LEAST_ASSIGN:
            base.append((found.start(), 0, found.end()))
    for found in ACCESS.finditer(whole):
        if found.end() - found.start() >= LEAST_ACCESS:
            base.append((found.start(), 1, found.end()))
    base += [(a, 2, b) for a, b in _runs(_HEX[data] == 1, LEAST_HEX)]
    base.sort()
    inside = _INSIDE[data]
    n = len(texts)
    out = {"spans": [[] for _ in range(n)], "strings": [[] for _ in range(n)]}

    def place(a: int, b: int) -> tuple[int, int, int]:
        doc = int(np.searchsorted(starts, a, "right")) - 1
        first = points[starts[doc]]
        return doc, int(points[a] - first), int(points[b] - first)

    for a, k, b in base:
        doc, first, last = place(a, b)
        out["spans"][doc].append({"start": first, "kind": k, "end": last})
    covered = np.zeros(len(data) + 1, np.int64)
    for a, _, b in base:
        covered[a] += 1
        covered[b] -= 1
    covered = np.cumsum(covered)
    strings = (
        string
        for stretch in _runs(inside == 1, LEAST_RANDOM)
        for a, b in _parts(whole, *stretch)
        if b - a >= LEAST_RANDOM and not covered[a:b].any()
        for string in _candidates(whole, a, b)
    )
    for a, b, body, encoding, p_random in strings:
        doc, first, last = place(a, b)
        out["strings"][doc].append(
            {
                "start": first,
                "end": last,
                "length_class": _length_class(len(body)),
                "characters": body,
                "encoding": encoding,
                "p_random": p_random,
            }
        )
    return out


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_STRING = pa.struct(
    [
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("length_class", pa.int32()),
        ("characters", pa.binary()),
        ("encoding", pa.string()),
        ("p_random", pa.float64()),
    ]
)
_SCHEMA = (
    "doc_id long, spans array<struct<start:long,kind:int,end:long>>, "
    "strings array<struct<start:long,end:long,length_class:int,characters:binary,"
    "encoding:string,p_random:double>>"
)


def _groups(texts: pa.Array) -> Iterator[list[bytes]]:
    """Texts, null as empty, as many at a time as ``BYTES_AT_ONCE`` allows."""
    begin = 0
    while begin < len(texts):
        some, size = [], 0
        while begin + len(some) < len(texts) and size < BYTES_AT_ONCE:
            some.append(texts[begin + len(some)].as_py() or b"")
            size += len(some[-1])
        yield some
        begin += len(some)


def _scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        begin = 0
        for some in _groups(batch.column("text").cast(pa.binary())):
            found = _scan_texts(some)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").slice(begin, len(some)),
                    "spans": pa.array(found["spans"], pa.list_(_SPAN)),
                    "strings": pa.array(found["strings"], pa.list_(_STRING)),
                }
            )
            begin += len(some)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often a byte follows another in a task's texts, each of which stands after a
    line feed. Not in long stretches: a secret that is copied often would look ordinary."""
    counts = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for some in _groups(batch.column("text").cast(pa.binary())):
            data = np.frombuffer(b"\n" + b"\n".join(some), np.uint8)
            words = np.ones(len(data), bool)
            for a, b in _runs(_INSIDE[data] == 1, LEAST_RANDOM):
                words[a:b] = False
            pairs = data[:-1].astype(np.int32) * 256 + data[1:]
            counts += np.bincount(pairs[words[1:]], minlength=1 << 16)
    pairs = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"pair": pa.array(pairs), "n": pa.array(counts[pairs])})


def _ordinary(docs: DataFrame) -> np.ndarray:
    """Powers of ten of the probability of a byte after another in the corpus's words; the
    last row is that of a first byte. From the pairs of bytes in the words of all
    documents, of which there are at most 65,536."""
    counts = np.zeros((256, 256))
    pairs = docs.select("text").mapInArrow(_pair_rows, "pair long, n long")
    for row in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[divmod(row["pair"], 256)] = row["n"]
    counts[:, np.frombuffer(BLANKS, np.uint8)] = 0
    counts = np.vstack([counts, counts.sum(axis=0)])
    whole = counts.sum(axis=1, keepdims=True) + 256 * SMOOTHING
    return np.log10((counts + SMOOTHING) / whole)


def _p_bin(string: dict, ordinary: np.ndarray) -> int:
    """Tenths of -log10 of a string's p-value: that it is ordinary, not random.

    Ordinary text has a string whose likelihood in the encoding, over that in the corpus's
    own characters, is x or more with a probability of at most 1 / x. The tests' joint
    p-value multiplies the likelihood, so what they speak against counts for less.
    """
    body = np.frombuffer(string["characters"], np.uint8)
    size = len(ALPHABETS[string["encoding"]])
    if not string["p_random"]:
        return 0
    corpus = ordinary[256, body[0]] + ordinary[body[:-1], body[1:]].sum()
    power = -len(body) * math.log10(size) + math.log10(string["p_random"]) - corpus
    return int(min(max(0.0, power * P_STEPS), P_BINS))


def _binned(ordinary: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = [
                [_p_bin(string, ordinary) for string in strings] if strings else []
                for strings in batch.column("strings").to_pylist()
            ]
            columns = [*batch.columns, pa.array(bins, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "bins"])

    return rows


def _least_bins(counts: list) -> dict[int, int]:
    """Per length class, the smallest bin that false-discovery control lets pass."""
    least = {}
    for length_class in {row["length_class"] for row in counts}:
        bins = sorted(
            ((r["bin"], r["n"]) for r in counts if r["length_class"] == length_class),
            reverse=True,
        )
        total, passed = sum(n for _, n in bins), 0
        for one, n in bins:
            passed += n
            if 10 ** (-one / P_STEPS) <= FALSE_DISCOVERIES * passed / total:
                least[length_class] = one
    return least


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_spans, spans), a row for each document.

    ``base_spans`` are the base patterns' matches, leftmost and non-overlapping per kind,
    as (start, kind number, end) in code points; ``spans`` also holds random strings
    (kind 3). A string is a longest stretch of ``LEAST_RANDOM`` and more letters,
    digits and ``+/_-``, with the ``=`` that end it, that no base span touches; if no
    alphabet has it or it fails the battery, parts of it are strings as well, see
    ``_candidates``. Its encoding is the smallest alphabet that has its characters.

    The battery tests it there: chi-squared uniformity of the alphabet, runs and serial
    correlation, joined in one p-value of being random. The p-value of being ordinary
    compares its likelihood in the encoding, times the battery's p-value, with that in a
    model of the corpus's own pairs of characters. A string is reported if a
    Benjamini-Hochberg control over all strings of the corpus of its length class lets
    this pass and no test speaks against its being random.

    A null or empty text has no spans. Repeated rows stay repeated; other columns are
    ignored; an empty table gives an empty result. The p-values are counted in bins, so
    what reaches the driver is bounded.
    """
    scanned = stored(
        docs.select("doc_id", "text").mapInArrow(_scan_rows, _SCHEMA), "scanned"
    ).mapInArrow(_binned(_ordinary(docs)), f"{_SCHEMA}, bins array<int>")
    paired = F.arrays_zip("strings", "bins").alias("string")
    counts = (
        scanned.filter(F.size("strings") > 0)
        .select(F.explode(paired).alias("string"))
        .groupBy(
            F.col("string.strings.length_class").alias("length_class"),
            F.col("string.bins").alias("bin"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    least = _least_bins(counts)
    limits = F.array(
        *(F.lit(least.get(k, P_BINS + 1)) for k in range(len(LENGTH_CLASSES) + 1))
    )
    random = F.transform(
        F.filter(
            F.arrays_zip("strings", "bins"),
            lambda s: (s["strings"]["p_random"] >= SIGNIFICANCE)
            & (s["bins"] >= F.get(limits, s["strings"]["length_class"])),
        ),
        lambda s: F.struct(
            s["strings"]["start"].alias("start"),
            F.lit(3).alias("kind"),
            s["strings"]["end"].alias("end"),
        ),
    )

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.col("spans").alias("base_spans"),
        F.array_sort(F.concat("spans", random)).alias("spans"),
    )


def span_text(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )
