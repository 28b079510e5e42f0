"""A hierarchical index of 64-bit fingerprints in Gray order, searched for those within a few bits of each other."""

from __future__ import annotations

import numpy as np

#: Children of a node, and fingerprints of one index.
FAN, TILE = 16, 4096
#: Pairs of a query and a node that are held at once.
_FRONT = 1 << 20
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the order in which neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _ranges(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range its number, once per member, and the members."""
    owner = np.repeat(np.arange(len(starts)), counts)
    return owner, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + starts[owner]


class GrayIndex:
    """Groups of fingerprints, each in Gray order, as trees of shared bit patterns.

    Up to ``FAN`` neighbours share a node: ``mask`` has the bits in which all below agree, ``pattern`` their values. A
    node's own bits are those that its parent has not settled, so the differences on a way down add up to the distance.
    """

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        """``codes`` of all groups, one group after the other; ``sizes`` of the groups, in none of which a code repeats."""
        self.codes, self.label = codes, np.arange(len(codes))
        pattern, mask = codes, np.full(len(codes), _ALL)
        #: From the leaves up: pattern, mask, first child and number of children, nodes of each group.
        self.levels = [(pattern, mask, None, None)]
        self.first, self.sizes = np.cumsum(sizes) - sizes, sizes
        while len(sizes) and sizes.max() > FAN:
            owner, at = _ranges(np.zeros(len(sizes), np.int64), -(-sizes // FAN))
            starts = (np.cumsum(sizes) - sizes)[owner] + at * FAN
            counts = np.minimum(FAN, sizes[owner] - at * FAN)
            same = np.bitwise_and.reduceat(mask, starts)
            differing = np.bitwise_or.reduceat(pattern ^ np.repeat(pattern[starts], counts), starts)
            mask = same & ~differing
            pattern = pattern[starts] & mask
            self.levels.append((pattern, mask, starts, counts))
            sizes = -(-sizes // FAN)
        self.tops, self.top_first = sizes, np.cumsum(sizes) - sizes

    def _joined(self) -> list[np.ndarray]:
        """For each level the label that all leaves below a node have, or -1."""
        labels = [self.label]
        for _, _, starts, counts in self.levels[1:]:
            below = labels[-1]
            even = np.bitwise_and.reduceat((below == np.repeat(below[starts], counts)).astype(np.int8), starts) == 1
            labels.append(np.where(even, below[starts], -1))
        return labels

    def _link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the labels of leaves ``a`` and ``b``; a label is the least leaf of its component."""
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            root = np.arange(len(self.label))
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while True:
                above = root[root]
                if np.array_equal(above, root):
                    break
                root = above
            self.label = root[self.label]

    def join(self, queries: np.ndarray, groups: np.ndarray, most: int) -> None:
        """Join the labels of each query, a leaf number, and of the leaves of a group within ``most`` bits of it.

        Nodes all of whose leaves have the query's label already are left aside as those too far off are: they add no link.
        """
        step = max(1, _FRONT // (FAN * max(int(self.tops.max(initial=1)), 1)))
        at, taken = 0, 16
        while at < len(queries):
            self._pass(queries[at:at + taken], groups[at:at + taken], most)
            at, taken = at + taken, min(step, taken * 4)

    def _pass(self, queries: np.ndarray, groups: np.ndarray, most: int) -> None:
        labels = self._joined()
        owner, node = _ranges(self.top_first[groups], self.tops[groups])
        query = queries[owner]
        far, settled = np.zeros(len(query), np.uint8), np.zeros(len(query), np.uint64)
        for level in range(len(self.levels) - 1, -1, -1):
            pattern, mask, starts, counts = self.levels[level]
            own = mask[node]
            far = far + np.bitwise_count((self.codes[query] ^ pattern[node]) & own & ~settled)
            near = (far <= most) & (labels[level][node] != self.label[query])
            query, node, far, settled = query[near], node[near], far[near], own[near]
            if level:
                owner, node = _ranges(starts[node], counts[node])
                query, far, settled = query[owner], far[owner], settled[owner]
        self._link(query, node)

    def join_within(self, most: int) -> None:
        """Join the labels of all leaves of one group within ``most`` bits of each other."""
        self.join(np.arange(len(self.codes)), np.repeat(np.arange(len(self.sizes)), self.sizes), most)


def shared_bits(codes: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """``mask`` of the bits in which all codes agree, and their values."""
    mask = ~np.bitwise_or.reduce(codes ^ codes[0])
    return mask, codes[0] & mask
