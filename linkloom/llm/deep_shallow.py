"""Deep-shallow sorting of byte strings: order, and what neighbours have in common.

Multikey quicksort compares eight bytes at a time, down to a shallow depth. Strings that agree up
to there are put into a blind trie, which keeps only the depths at which strings part: a string
runs down it without comparisons, is compared once with the leaf it meets, and is inserted
where the two part.
"""

from __future__ import annotations

import numpy as np

_STEP = 8


def shallow_groups(strings: list[bytes], depth: int) -> list[list[int]]:
    """The indexes of strings that agree in their first ``depth`` bytes, groups in order.

    Missing bytes count as zero, so a group may hold strings of different lengths.
    """
    steps = -(-depth // _STEP)
    keys = np.frombuffer(
        b"".join(s[:depth].ljust(steps * _STEP, b"\0") for s in strings), ">u8"
    ).reshape(len(strings), steps).astype(np.uint64)
    done, todo = [], [(np.arange(len(strings)), 0)]
    while todo:
        rows, step = todo.pop()
        if step == steps or len(rows) == 1:
            done.append(rows.tolist())
            continue
        column = keys[rows, step]
        pivot = column[len(column) // 2]
        less, more = column < pivot, column > pivot
        parts = [(rows[more], step), (rows[~less & ~more], step + 1), (rows[less], step)]
        todo += [(part, at) for part, at in parts if len(part)]
    return done


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    apart = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (apart.bit_length() + 7) // 8


class _Fork:
    __slots__ = ("children", "depth")

    def __init__(self, depth: int):
        self.depth = depth
        self.children: dict[int, _Fork | list[int]] = {}


def _symbol(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def blind_trie(strings: list[bytes], rows: list[int]) -> tuple[list[int], list[int]]:
    """``rows`` in the order of their strings, and how many bytes each has in common with the
    one before it; 0 for the first. Equal strings stay in the order given."""
    top: _Fork | list[int] = [rows[0]]
    for row in rows[1:]:
        s, node = strings[row], top
        while isinstance(node, _Fork):
            nearest = node.children.get(_symbol(s, node.depth))
            node = nearest if nearest is not None else next(iter(node.children.values()))
        other = strings[node[0]]
        same = _common(s, other)
        if same == len(s) == len(other):
            node.append(row)
            continue
        parent, node = None, top
        while isinstance(node, _Fork) and node.depth < same:
            parent, node = node, node.children[_symbol(s, node.depth)]
        if isinstance(node, _Fork) and node.depth == same:
            node.children[_symbol(s, same)] = [row]
            continue
        fork = _Fork(same)
        fork.children = {_symbol(other, same): node, _symbol(s, same): [row]}
        if parent is None:
            top = fork
        else:
            parent.children[_symbol(s, parent.depth)] = fork
    order, common, todo = [], [], [(top, 0)]
    while todo:
        node, shared = todo.pop()
        if isinstance(node, _Fork):
            symbols = sorted(node.children, reverse=True)
            todo += [(node.children[x], node.depth) for x in symbols[:-1]]
            todo.append((node.children[symbols[-1]], shared))
        else:
            order += node
            common += [shared] + [len(strings[node[0]])] * (len(node) - 1)
    return order, common
