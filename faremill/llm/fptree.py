"""A tree of documents by their terms in falling frequency, and branch-and-bound over it.

Documents of a chunk are written as their terms, the most frequent first, and sorted: equal beginnings are
neighbours and share a path. A node stands for the documents below one path; a node of at most ``LEAF`` documents is
not divided further, and small neighbouring children share a leaf. Each node knows, of every term below it,
the largest number of occurrences in one document, and the least length factor of its documents. Since a term's
contribution rises with its occurrences and falls with the length factor, these bound all scores below, in the same
whole numbers as the scores themselves.
"""

from __future__ import annotations

import numpy as np

LEAF = 64
DEPTH = 24
GAIN, STEEP, LENGTH = 1_000_000_000, 1000, 8


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (GAIN * tf) // (STEEP * tf + LENGTH * m)


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of runs of the given starts and sizes, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Board:
    """The k best documents of each item so far: score high to low, then ids, null ids last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows: list[np.ndarray] = [np.zeros((3, 0), np.int64)] * items

    def least(self, item: int) -> tuple[int, int, int]:
        """What a document must beat: (score, whether its id is null, id)."""
        rows = self.rows[item]
        return (int(rows[0, -1]), int(rows[1, -1]), int(rows[2, -1])) if rows.shape[1] == self.k else (0, 1, np.iinfo(np.int64).max)

    def add(self, item: int, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        least, _, _ = self.least(item)
        good = np.flatnonzero((scores >= least) & (scores > 0))
        if len(good):
            rows = np.concatenate([self.rows[item], np.stack([scores[good], nulls[good].astype(np.int64), ids[good]])], axis=1)
            self.rows[item] = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[: self.k]]


class Tree:
    """``terms`` (numbered from the most frequent on) and ``tf`` of documents with ``sizes`` terms each, none empty."""

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, tf: np.ndarray, m: np.ndarray, ids: np.ndarray, nulls: np.ndarray, vocabulary: int):
        self.vocabulary = vocabulary
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(np.repeat(np.arange(len(sizes)), sizes) * vocabulary + terms, kind="stable")
        terms, tf = terms[order], tf[order]
        paths = np.full((len(sizes), DEPTH), -1, np.int64)
        for d in range(DEPTH):
            has = sizes > d
            paths[has, d] = terms[starts[has] + d]
        by_path = np.lexsort(paths.T[::-1])
        self.sizes, take = sizes[by_path], _expand(starts[by_path], sizes[by_path])
        self.m, self.ids, self.nulls = m[by_path], ids[by_path], nulls[by_path]
        self.terms, self.tf = terms[take], tf[take]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.gain = saturation(self.tf, np.repeat(self.m, self.sizes))
        self._grow(paths[by_path])
        self._summarise()

    def _grow(self, paths: np.ndarray) -> None:
        """Nodes breadth first: bounds in the sorted documents, first child and number of children, levels."""
        nodes, level, self.levels = [(0, len(paths), 0)], [0], [(0, 1)]
        self.first_child, self.children = [0], [0]
        while level:
            following = []
            for node in level:
                low, high, depth = nodes[node]
                if high - low <= LEAF:
                    continue
                while depth < DEPTH and paths[low, depth] == paths[high - 1, depth]:
                    depth += 1
                if depth == DEPTH:
                    cuts = list(range(low, high, LEAF))
                else:
                    changes = np.flatnonzero(paths[low + 1 : high, depth] != paths[low : high - 1, depth]) + low + 1
                    cuts, ends = [low], [*changes.tolist(), high]
                    for start, end in zip([low, *ends[:-1]], ends, strict=True):
                        # A small child joins its small neighbours.
                        if start > cuts[-1] and end - cuts[-1] > LEAF:
                            cuts.append(start)
                self.first_child[node], self.children[node] = len(nodes), len(cuts)
                for start, end in zip(cuts, [*cuts[1:], high], strict=True):
                    following.append(len(nodes))
                    nodes.append((start, end, min(depth + 1, DEPTH) if depth < DEPTH else depth))
                    self.first_child.append(0)
                    self.children.append(0)
            level = following
            if level:
                self.levels.append((level[0], level[-1] + 1))
        self.low, self.high = np.array([n[0] for n in nodes]), np.array([n[1] for n in nodes])

    def _summarise(self) -> None:
        """Of each node its terms, their most occurrences and what these give at the node's least length factor."""
        count = len(self.low)
        terms: list[np.ndarray] = [self.terms[:0]] * count
        most: list[np.ndarray] = [self.tf[:0]] * count
        for begin, end in reversed(self.levels):
            for node in range(begin, end):
                if self.children[node]:
                    below = range(self.first_child[node], self.first_child[node] + self.children[node])
                    t, f = np.concatenate([terms[c] for c in below]), np.concatenate([most[c] for c in below])
                else:
                    own = slice(self.starts[self.low[node]], self.starts[self.high[node]])
                    t, f = self.terms[own], self.tf[own]
                order = np.argsort(t, kind="stable")
                t, f = t[order], f[order]
                at = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
                terms[node], most[node] = t[at], np.maximum.reduceat(f, at)
        self.node_starts = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
        self.node_m = np.minimum.reduceat(self.m, self.low) if count == 1 else np.array([self.m[a:b].min() for a, b in zip(self.low, self.high, strict=True)])
        self.node_terms = np.concatenate(terms)
        self.node_gain = saturation(np.concatenate(most), np.repeat(self.node_m, np.diff(self.node_starts)))

    def search(self, weights: np.ndarray, board: Board, item: int) -> int:
        """Put the item's best documents on the board; ``weights`` has its terms' weights, zero elsewhere.

        Depth first, the most promising child first. Returns the number of documents scored.
        """
        scored, stack = 0, [(int((weights[self.node_terms[: self.node_starts[1]]] * self.node_gain[: self.node_starts[1]]).sum()), 0)]
        while stack:
            bound, node = stack.pop()
            if bound < max(1, board.least(item)[0]):
                continue
            if not self.children[node]:
                low, high = self.low[node], self.high[node]
                begin, end = self.starts[low], self.starts[high]
                scores = np.add.reduceat(weights[self.terms[begin:end]] * self.gain[begin:end], self.starts[low:high] - begin)
                board.add(item, scores, self.nulls[low:high], self.ids[low:high])
                scored += int(high - low)
                continue
            first = self.first_child[node]
            last = first + self.children[node]
            begin, end = self.node_starts[first], self.node_starts[last]
            bounds = np.add.reduceat(weights[self.node_terms[begin:end]] * self.node_gain[begin:end], self.node_starts[first:last] - begin)
            reach = np.flatnonzero(bounds >= max(1, board.least(item)[0]))
            reach = reach[np.argsort(bounds[reach], kind="stable")]
            stack += zip(bounds[reach].tolist(), (first + reach).tolist(), strict=True)
        return scored
