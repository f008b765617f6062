"""Plain single-process versions of the contracts, on lists of rows."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = " \t\n\v\f\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def letters(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def encoding() -> tiktoken.Encoding:
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe(docs):
    plain = encoding()
    for doc_id, text in docs:
        ids = plain.encode_ordinary(text or "")
        yield doc_id, len(ids), sha(",".join(map(str, ids))), sha(text or "")


def substring(docs, window=20):
    first: dict[tuple, tuple] = {}
    split = {(i, text): words(text) for i, text in docs}
    for i, text in sorted(split, key=lambda d: (d[0], d[1] or "")):
        own = split[i, text]
        for at in range(len(own) - window + 1):
            first.setdefault(tuple(own[at : at + window]), (i, text, at))
    for i, text in docs:
        own = split[i, text]
        gone = [False] * len(own)
        for at in range(len(own) - window + 1):
            if first[tuple(own[at : at + window])] != (i, text, at):
                gone[at : at + window] = [True] * window
        yield i, len(own), sum(gone), sha(" ".join(w for w, g in zip(own, gone) if not g))


def decontamination(docs, items, window=10):
    strings: dict[tuple, set[str]] = {}
    for item, text in items:
        own = letters(text)
        n = min(window, len(own))
        for at in range(len(own) - n + 1 if n else 0):
            strings.setdefault(tuple(own[at : at + n]), set()).update([] if item is None else [str(item)])
    sizes = {len(s) for s in strings}
    for i, text in docs:
        own = letters(text)
        hit, found = [False] * len(own), set()
        for n in sizes:
            for at in range(len(own) - n + 1):
                of = strings.get(tuple(own[at : at + n]))
                if of is not None:
                    hit[at : at + n] = [True] * n
                    found |= of
        yield i, len(own), sum(hit), len(found), sha(",".join(sorted(found))), any(hit)


def line_key(line: str) -> str:
    return line.strip(SPACES).translate(UPPER)


def lines(docs, min_chars=10):
    holders: dict[str, set] = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders.setdefault(line_key(line), set()).add((i, text))
    for i, text in docs:
        own = (text or "").split("\n")
        kept = [
            line
            for line in own
            if len(key := line_key(line)) < min_chars or min(holders[key], key=lambda d: (d[0], d[1] or "")) == (i, text)
        ]
        yield i, len(own), len(own) - len(kept), sha("\n".join(kept))


def base_measures(text):
    own = words(text)
    seen: dict[tuple, list[int]] = {}
    for at in range(len(own) - 2):
        seen.setdefault(tuple(own[at : at + 3]), []).append(at)
    repeated = {at + k for places in seen.values() if len(places) > 1 for at in places for k in range(3)}
    solid = [line for line in (text or "").split("\n") if words(line)]
    n = len(own)
    return (
        n,
        sum(map(len, own)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(solid) - len(set(solid)),
        len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


def shingle_weights(text, n=5):
    from math import log2

    own = [w.translate(UPPER) for w in words(text)]
    grams = Counter(tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))) if own else {}
    return {g: 1 + log2(often) for g, often in grams.items()}


def probability_jaccard(x, y):
    """The definition, term by term."""
    every = sorted(x.keys() | y.keys())
    a, b = (np.array([w.get(g, 0.0) for g in every]) for w in (x, y))
    common = (a > 0) & (b > 0)
    return float((1 / np.maximum(a / a[common, None], b / b[common, None]).sum(axis=1)).sum())


def classes(docs, threshold=0.8):
    """Least id of each document's class, all pairs compared."""
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    first: dict[str, int] = {}
    for i, text in docs:
        same = first.setdefault(" ".join(words((text or "").translate(UPPER))) or f"none {i}", i)
        low, high = sorted((find(same), find(i)))
        root[high] = low
    weighed = [(i, shingle_weights(text)) for i, text in docs if i in first.values()]
    for k, (a, x) in enumerate(weighed):
        for b, y in weighed[:k]:
            if x and y and x.keys() & y.keys() and probability_jaccard(x, y) >= threshold:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i, _ in docs}
