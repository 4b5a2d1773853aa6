"""Plain versions of the operators, written from their definitions."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(rows, window=13):
    """(id, n_words, n_removed, digest of the kept words) of (id, text) rows."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            if doc is not None:
                key = tuple(w[i:i + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        kept = [True] * len(w)
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i:i + window])] < doc:
                kept[i:i + window] = [False] * window
        out.append((doc, len(w), len(w) - sum(kept), sha(" ".join(itertools.compress(w, kept)))))
    return out


def token_rows(rows, encode, end=0):
    """(id, start, n_tokens, crc) of (id, text) rows, in ascending order of the id, null first, then of the text."""
    at, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*encode(text or ""), end]
        out.append((doc, at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        at += len(ids)
    return out


def shingle_sets(rows, n=5):
    sets = {}
    for doc, text in rows:
        w = words(text)
        sets[doc] = frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()
    return sets


def similar(rows, threshold=0.8):
    """(id, class, copy, links) of (id, text) rows with unlike ids."""
    sets = shingle_sets(rows)
    copy = {}
    for doc in sorted(sets):
        copy.setdefault(sets[doc], doc)
    members = [d for d in sorted(sets) if sets[d] and copy[sets[d]] == d]
    root, links = {d: d for d in sets}, Counter()

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    for a, b in itertools.combinations(members, 2):
        both = len(sets[a] & sets[b])
        if both and both >= threshold * (len(sets[a]) + len(sets[b]) - both):
            links.update((a, b))
            x, y = sorted((find(a), find(b)))
            root[y] = x
    out = []
    for doc in sets:
        own = copy[sets[doc]] if sets[doc] else doc
        out.append((doc, find(own), own, links[own]))
    return sorted(out)


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    triples = list(zip(w, w[1:], w[2:]))
    counts, covered = Counter(triples), set()
    for i, triple in enumerate(triples):
        if counts[triple] > 1:
            covered.update((i, i + 1, i + 2))
    n, again = len(w), len(covered)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), again,
            n < 50 or 100 * again > 50 * n)


def contamination(rows, items, window=10):
    """(id, n_words, n_hit, sorted item ids) of (id, text) rows."""
    listed = {}
    for item, text in items:
        w = ITEM_WORD.findall((text or "").translate(UPPER))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            listed.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    out = []
    for doc, text in rows:
        w = ITEM_WORD.findall((text or "").translate(UPPER))
        hit, found = set(), set()
        for n in {len(k) for k in listed}:
            for i in range(len(w) - n + 1):
                if names := listed.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    found |= names
        out.append((doc, len(w), len(hit), sorted(found)))
    return out
