"""Deep-shallow string sorting: multikey quicksort on eight-byte symbols down to a
shallow depth, small groups by insertion, large groups that still share a long
prefix by a blind trie."""
from __future__ import annotations

import numpy as np

SHALLOW = 32      # bytes that quicksort looks at
SMALL = 32        # groups up to this size are sorted by insertion


def deep_shallow_order(strings: list[bytes], shallow: int = SHALLOW, small: int = SMALL) -> np.ndarray:
    """The order of the strings (equal ones side by side in any order)."""
    n = len(strings)
    heads = b"".join([s[:shallow].ljust(shallow, b"\0") for s in strings])
    symbols = np.frombuffer(heads, ">u8").reshape(n, -1).astype(np.uint64) if n else np.zeros((0, 1), np.uint64)
    out: list[int] = []
    todo: list[tuple[np.ndarray, int]] = [(np.arange(n), 0)]
    while todo:
        group, depth = todo.pop()
        if len(group) <= small:
            out += sorted(group.tolist(), key=strings.__getitem__)
        elif depth == symbols.shape[1]:
            out += blind_trie_order(group.tolist(), strings)
        else:
            at = symbols[group, depth]
            pivot = np.partition(at, len(at) // 2)[len(at) // 2]
            same = at == pivot
            todo += [(group[at > pivot], depth), (group[same], depth + 1), (group[at < pivot], depth)]
    return np.array(out, np.int64)


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    n = min(len(a), len(b))
    while at < n and a[at:at + 64] == b[at:at + 64]:
        at += 64
    if at >= n:
        return n
    x = int.from_bytes(a[at:at + 64].ljust(64, b"\0"), "big") ^ int.from_bytes(b[at:at + 64].ljust(64, b"\0"), "big")
    return min(n, at + (512 - x.bit_length()) // 8)


def blind_trie_order(group: list[int], strings: list[bytes]) -> list[int]:
    """Sorts strings by a trie whose inner nodes know only the depth of the byte
    that they branch on.  A string first goes down without comparing what the
    nodes skip, is compared once with the leaf it reaches, and is then inserted
    where the first difference lies."""
    root: list = [None, [group[0]]]                  # leaf: [None, equal strings]
    for new in group[1:]:
        s = strings[new]
        path, node = [], root
        while node[0] is not None:
            path.append(node)
            node = node[1].get(_byte(s, node[0])) or next(iter(node[1].values()))
        other = strings[node[1][0]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node[1].append(new)
            continue
        above = next((k for k, p in enumerate(path) if p[0] >= depth), len(path))
        below = path[above] if above < len(path) else node
        leaf = [None, [new]]
        if below[0] == depth:
            below[1][_byte(s, depth)] = leaf
            continue
        inner = [depth, {_byte(other, depth): below, _byte(s, depth): leaf}]
        if above:
            parent = path[above - 1]
            parent[1][_byte(s, parent[0])] = inner
        else:
            root = inner
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node[0] is None:
            out += node[1]
        else:
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def _byte(s: bytes, at: int) -> int:
    return s[at] if at < len(s) else -1


def neighbour_prefixes(strings: list[bytes], order: np.ndarray, width: int, part: int = 8192) -> np.ndarray:
    """Common prefix (up to ``width``) of each string in order with the one before
    it; -1 for the first."""
    out = np.full(len(order), -1, np.int32)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    for a in range(0, len(order) - 1, part):
        own = order[a:a + part + 1]
        grid = np.frombuffer(b"".join([strings[k][:width].ljust(width, b"\0") for k in own]), np.uint8).reshape(len(own), width)
        differ = grid[1:] != grid[:-1]
        first = np.where(differ.any(1), differ.argmax(1), width)
        least = np.minimum(np.minimum(sizes[own[1:]], sizes[own[:-1]]), width)
        out[a + 1:a + len(own)] = np.minimum(first, least)
    return out
