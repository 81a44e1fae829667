"""Plain Python versions of the manifest and the prefix trie, for small tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

EMPTY = hashlib.sha256(b"").hexdigest()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values) -> str:
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(map(field, values)))


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str | None]]]]:
    """Root, and for each leaf its path of (side, sibling)."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for path, i in zip(paths, at):
            other = i ^ 1
            path.append(("left" if i % 2 else "right", level[other]) if other < len(level) else ("alone", None))
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def manifest(rows):
    """``rows`` of (doc_id, source, lang, n_chars, text): sorted tuples of the registered query's columns."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, held = [], []
    for g in order:
        members = sorted(groups[g], key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        subroot, paths = tree([h for h, _ in members])
        subroots.append(subroot)
        held.append((members, paths))
    if not order:
        return []
    root, upper = tree(subroots)
    out = []
    for (members, paths), subroot, top in zip(held, subroots, upper):
        for (h, r), path in zip(members, paths):
            proof = sha("".join(s for _, s in path + top if s))
            now = h
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                now = leaf((*r[:3], r[3] + 1, r[4]))
            for side, s in path + top:
                now = sha(now if s is None else s + now if side == "left" else now + s)
            out.append((r[0], h, subroot, root, proof, now, now == root))
    return out


def rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    """Conversations of (conv_id, turn, role, text) rebuilt on their bases."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            spelled = f"{len((role or '').encode())}:{role or ''}{text or ''}"
            own[c].append(((turn is not None, turn or 0, sha(spelled)[:32]), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def trie(convs: dict[int, list]) -> list[tuple]:
    """The columns of ``trie.NODE`` for every prefix."""
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(int)
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, ms in members.items():
        cost = (len(ms) - 1) * len(prefix[-1][1]) if prefix else 0
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += prefix not in children
            saved[prefix[:d]] += cost
    out = []
    for prefix, ms in members.items():
        ends = sorted(c for c in ms if len(convs[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(ms), len(prefix), parent, len(ms), children.get(prefix, 0), leaves[prefix], saved[prefix], sha(",".join(map(str, ends)))))
    return sorted(out, key=lambda r: (r[1], r[0]))
