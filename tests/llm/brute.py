"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import xxhash


def words(text):
    return (text or "").encode().split()


def without_repeats(rows, window=35):
    split = [words(text) for _, text in rows]
    starts = Counter(
        tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1)
    )
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        digest = hashlib.sha256(b" ".join(kept)).hexdigest()
        out.append((doc_id, len(w), sum(gone), digest))
    return out


def fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def linked(ids, near):
    """Smallest id reachable from each place, over the pairs of places ``near`` accepts."""
    label = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(len(ids)):
                if near(i, j) and label[j] < label[i]:
                    label[i], changed = label[j], True
    groups = {}
    for i, k in enumerate(label):
        if ids[i] is not None:
            groups[k] = min(groups.get(k, ids[i]), ids[i])
    return [groups.get(k) for k in label]


def license_places(text, phrases):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [
        i
        for phrase in phrases
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(w), len(found), min(found, default=None), max(found, default=None)


def base_spans(text):
    text = text or ""

    def either(word):
        return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)

    names = "|".join(map(either, ("password", "passwd", "secret", "token", "api_?key")))
    assign = rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [
        (m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6
    ]
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        spans += [
            (m.start(), kind, m.end())
            for m in re.finditer(pattern, text)
            if len(m[0]) >= least
        ]
    return sorted(spans)


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def without_common_lines(rows, least_chars=20, least_documents=3):
    """(doc_id, lines, lines dropped, kept text) of each (doc_id, text)."""
    lowest = float("-inf")
    split = [
        (lowest if doc_id is None else doc_id, (text or "").split("\n"))
        for doc_id, text in rows
    ]
    holders = {}
    for doc_id, lines in split:
        for line in lines:
            holders.setdefault(_lower(line.strip(" \t\n\x0b\x0c\r")), set()).add(doc_id)
    out = []
    for doc_id, lines in split:
        kept = []
        for line in lines:
            key = _lower(line.strip(" \t\n\x0b\x0c\r"))
            common = len(key) >= least_chars and len(holders[key]) >= least_documents
            if not common or doc_id == max(holders[key]):
                kept.append(line)
        name = None if doc_id == lowest else doc_id
        out.append((name, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lower(text or ""))


def ranked(docs, items, top=10):
    """(item_id, rank, doc_id, score) over (doc_id, text) and (item_id, text)."""
    split = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    split = [(doc_id, own) for doc_id, own in split if own]
    n, length = len(split), sum(sum(own.values()) for _, own in split)
    holding = Counter(term for _, own in split for term in own)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, own in split:
            m = 100 - 90 + 90 * sum(own.values()) * n // length
            score = 0
            for term in set(terms(text)):
                if tf := own[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * holding[term] + 1)))
                    score += w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        best = sorted(scored, key=lambda s: s[:3])[:top]
        out += [(item_id, k + 1, s[3], -s[0]) for k, s in enumerate(best)]
    return out


def hard_negatives(rows, is_anchor, positives=5, negatives=3):
    """The mined rows over (vec_id, label, vector)."""
    good = {
        (i, label, tuple(v))
        for i, label, v in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    }
    whole = sorted((i, label, [math.floor(256 * x) for x in v]) for i, label, v in good)
    out = []
    for anchor in (r for r in whole if is_anchor(r[0])):
        others = [
            (-sum(x * y for x, y in zip(anchor[2], r[2])), r[0], r[1])
            for r in whole
            if r is not anchor and len(r[2]) == len(anchor[2])
        ]
        others.sort(key=lambda o: o[:2])
        for score, positive, _ in [o for o in others if o[2] == anchor[1]][:positives]:
            hard = [
                o for o in others if o[2] != anchor[1] and 50 * -score <= 100 * -o[0] <= 95 * -score
            ]
            out += [
                (anchor[0], positive, k + 1, o[1], -score, -o[0])
                for k, o in enumerate(hard[:negatives])
            ]
    return out


ENCODINGS = ["0-9a-f", "0-9A-F", "a-z", "A-Z", "A-Z2-7", "0-9a-z", "A-Za-z", "A-Za-z0-9"]
ENCODINGS += ["A-Za-z0-9+/", "A-Za-z0-9_-"]


def _members(pattern):
    return sorted(c for c in map(chr, range(128)) if re.match(f"[{pattern}]", c))


def _alphabet(pattern, given):
    """Characters in the order in which the encoding numbers them."""
    members = _members(pattern)
    ranks = {"A-Za-z": 0, "A-Za-z0-9": 0, "A-Za-z0-9+/": 0, "A-Za-z0-9_-": 0, "A-Z2-7": 0}
    if pattern in ranks:
        kinds = (str.isupper, str.islower, str.isdigit, lambda c: c in "+-", lambda c: c in "/_")
        members.sort(key=lambda c: (next(k for k, f in enumerate(kinds) if f(c)), c))
    return members


def randomness(body):
    """(size of the encoding, p) by the three tests, or None."""
    for pattern in ENCODINGS:
        members = _alphabet(pattern, body)
        if set(body) <= set(members):
            break
    else:
        return None
    n, k = len(body), len(members)
    value = [members.index(c) for c in body]
    chi = sum((value.count(v) - n / k) ** 2 for v in range(k)) * k / n
    uniform = math.erfc((chi - k + 1) / math.sqrt(2 * (k - 1) * (n - 1) / n) / math.sqrt(2)) / 2
    changes = sum((a >= k / 2) != (b >= k / 2) for a, b in zip(value, value[1:]))
    runs = math.erfc(abs(changes - (n - 1) / 2) / math.sqrt((n - 1) / 4) / math.sqrt(2))
    mid = (k - 1) / 2
    product = sum((a - mid) * (b - mid) for a, b in zip(value, value[1:]))
    serial = math.erfc(abs(product / ((k * k - 1) / 12) / math.sqrt(n - 1)) / math.sqrt(2))
    return k, min(1.0, 3 * min(uniform, runs, serial))


def random_strings(texts, least=20, gate=0.001, false=0.01):
    """[(start, end), ...] of the random strings of each text."""
    pairs, first = Counter(), Counter()
    for text in texts:
        raw = b"\n" + (text or "").encode()
        # Where a long stretch stands, a blank.
        short = re.sub(rb"[A-Za-z0-9+/_=-]{%d,}" % least, lambda m: b" " * len(m[0]), raw)
        for a, b, kept in zip(raw, raw[1:], short[1:]):
            if kept not in b" \t\n\x0b\x0c\r":
                pairs[a, b] += 1
                first[b] += 1
    after = Counter()
    for (a, _), n in pairs.items():
        after[a] += n
    total = sum(first.values())
    tested = []
    for number, text in enumerate(texts):
        base = [(a, b) for a, _, b in base_spans(text)]
        for stretch in re.finditer(r"[A-Za-z0-9+/_=-]{%d,}" % least, text or ""):
            last = stretch.start() + len(stretch[0].rstrip("="))
            for part in re.finditer("[^=]+", text[stretch.start() : last]):
                a = stretch.start() + part.start()
                b = stretch.start() + part.end()
                end = stretch.end() if b == last else b
                if end - a < least or any(x < end and a < y for x, y in base):
                    continue
                tested += [(number, *one) for one in _tested(text, a, b, end, least, gate)]
    found = [[] for _ in texts]
    for low, high in ((0, 32), (32, 64), (64, 128), (128, 10**9)):
        scored = []
        for number, a, b, body, k, p in tested:
            if low <= len(body) < high:
                raw = body.encode()
                log = math.log10((first[raw[0]] + 0.5) / (total + 128))
                for x, y in zip(raw, raw[1:]):
                    log += math.log10((pairs[x, y] + 0.5) / (after[x] + 128))
                power = math.log10(p) - len(raw) * math.log10(k) - log if p else 0
                scored.append((int(min(max(0, power * 10), 400)), p, number, a, b))
        scored.sort(reverse=True)
        least_bin = None
        for one in {s[0] for s in scored}:
            passed = sum(s[0] >= one for s in scored)
            if 10 ** (-one / 10) <= false * passed / len(scored):
                least_bin = one if least_bin is None else min(least_bin, one)
        for one, p, number, a, b in scored:
            if least_bin is not None and one >= least_bin and p >= gate:
                found[number].append((a, b))
    return [sorted(own) for own in found]


def _tested(text, a, b, end, least, gate):
    out = []

    def passes(start, stop, body):
        known = randomness(body) if len(body) >= least else None
        if known is None or any(o[:3] == (start, stop, body) for o in out):
            return False
        out.append((start, stop, body, *known))
        return known[1] >= gate

    if passes(a, end, text[a:b]):
        return out
    passed = []
    for separators in ("_-", "+/", "+/_-"):
        for piece in re.finditer(f"[^{separators}]+", text[a:b]):
            start, stop = a + piece.start(), a + piece.end()
            if not any(x <= start and stop <= y for x, y in passed):
                stop = end if stop == b else stop
                if passes(start, stop, piece[0]):
                    passed.append((start, stop))
    joined = re.sub("[_-]", "", text[a:b])
    hexadecimal = set(joined) <= set("0123456789abcdef") or set(joined) <= set("0123456789ABCDEF")
    if not passed and hexadecimal and not joined.isdigit():
        passes(a, end, joined)
    return out


def license_labels(text, listed, phrases, neighbours=2):
    """(labels, score) of a text; the first ``phrases`` of ``listed`` are base phrases."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    labels, score = set(), 0.0
    for number, (label, own, gram, least) in enumerate(listed):
        hits = {}
        for at in range(len(own) - gram + 1):
            for pos in range(len(w) - gram + 1):
                if w[pos : pos + gram] == own[at : at + gram]:
                    hits.setdefault(pos - at, []).append((at, pos))
        spans, before = [], None
        for diagonal in sorted(hits):
            if before is None or diagonal - before > neighbours or number < phrases:
                spans.append([])
            spans[-1] += hits[diagonal]
            before = diagonal
        for span in spans:
            share = len({at + j for at, _ in span for j in range(gram)}) / len(own)
            places = [pos for _, pos in span]
            length = max(places) - min(places) + gram
            fits = number < phrases or length <= len(own) * 1.25 + neighbours
            if share >= least and fits:
                labels.add(label)
                score = max(score, share)
    return ",".join(sorted(labels)), score
