"""The contract of the conversation trie, on lists of rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def order(rows):
    """Turns of each conversation; turns of one number by digest."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            by[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    return {c: [t for _, t in sorted(ts)] for c, ts in by.items()}


def rebuild(rows):
    own = order(rows)
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + mine[h:]
    return out


def trie(convs):
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children[node]
        leaves[node] = sum(leaves[k] for k in kids) or 1
        own = (len(members[node]) - 1) * words(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[k] for k in kids)
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(convs[c]) == len(node))
        yield (
            min(of),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(of),
            len(children[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        )
