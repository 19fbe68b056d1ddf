"""Hierarchical navigable small-world graph of one shard's unit vectors, batched in numpy.

Layers are built from the top down; a node's neighbours are picked first so that none is nearer to
an already picked one than to the node, which keeps links out of tight clusters.  Many queries walk
the graph together: each step expands the best unexpanded nodes of every query's beam.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Links of a node (twice as many in the lowest layer) and beam while building.
LINKS, BUILD_BEAM = 16, 64
#: Nodes linked to each other directly when a layer begins, nodes added at once, nodes expanded at once.
SEED_NODES, ADDED, EXPANDED = 256, 512, 4
#: Floats of work space of a batch of queries.
SPACE = 1 << 25


def spread(sims: np.ndarray, ids: np.ndarray, vectors: np.ndarray, links: int) -> np.ndarray:
    """Up to ``links`` of each row's candidates (-1: none): first those that are nearer to the row's node
    than to any picked before, nearest first; then, in what room is left, the nearest of the others."""
    order = np.argsort(-np.where(ids >= 0, sims, -np.inf), axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    found = vectors[np.maximum(ids, 0)]
    among = found @ found.transpose(0, 2, 1)
    rows, width = ids.shape
    nearest = np.full((rows, width), -np.inf, np.float32)
    taken = np.zeros((rows, width), bool)
    count = np.zeros(rows, int)
    for j in range(width):
        pick = (ids[:, j] >= 0) & (sims[:, j] > nearest[:, j]) & (count < links)
        taken[pick, j] = True
        count += pick
        nearest[pick] = np.maximum(nearest[pick], among[pick, j])
    rest = ~taken & (ids >= 0)
    taken |= rest & (np.cumsum(rest, axis=1) <= (links - count)[:, None])
    out = np.full((rows, links), -1, np.int32)
    row, column = np.nonzero(taken)
    out[row, (np.cumsum(taken, axis=1) - 1)[row, column]] = ids[row, column]
    return out


@dataclass
class Graph:
    """``layers[0]`` is the lowest; row i of a layer has node i's neighbours, -1 where there are no more."""

    vectors: np.ndarray
    layers: list[np.ndarray]
    entry: int
    reverse: tuple[np.ndarray, np.ndarray] | None = None

    def descend(self, queries: np.ndarray, down_to: int) -> np.ndarray:
        """The node each query greedily ends at above layer ``down_to``."""
        at = np.full(len(queries), self.entry)
        best = queries @ self.vectors[self.entry]
        for layer in self.layers[:down_to:-1]:
            moving = np.arange(len(queries))
            while len(moving):
                near = layer[at[moving]]
                sims = np.einsum("qd,qkd->qk", queries[moving], self.vectors[np.maximum(near, 0)])
                sims[near < 0] = -np.inf
                top = sims.argmax(axis=1)
                value = sims[np.arange(len(moving)), top]
                better = value > best[moving]
                moving, top, value, near = moving[better], top[better], value[better], near[better]
                at[moving], best[moving] = near[np.arange(len(moving)), top], value
        return at

    def beam(self, queries: np.ndarray, width: int, layer: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes met and their cosines, for each query; -1 where fewer."""
        n, links = len(self.vectors), self.layers[layer]
        rows = len(queries)
        start = self.descend(queries, layer)
        ids = np.full((rows, width), -1, np.int32)
        sims = np.full((rows, width), -np.inf, np.float32)
        ids[:, 0] = start
        sims[:, 0] = np.einsum("qd,qd->q", queries, self.vectors[start])
        seen = np.zeros((rows, n), bool)
        seen[np.arange(rows), start] = True
        done = ids < 0
        active = np.arange(rows)
        step = min(EXPANDED, width)
        while len(active):
            waiting = np.where(done[active], -np.inf, sims[active])
            at = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
            good = np.take_along_axis(waiting, at, 1) > -np.inf
            done[active[:, None], at] = True
            some = good.any(axis=1)
            active, at, good = active[some], at[some], good[some]
            if not len(active):
                break
            near = np.where(good[:, :, None], links[np.maximum(ids[active[:, None], at], 0)], -1).reshape(len(active), -1)
            near = np.where(seen[active[:, None], np.maximum(near, 0)], -1, near)
            row, column = np.nonzero(near >= 0)
            node = near[row, column]
            seen[active[row], node] = True
            # a node that two expanded ones share comes twice in a row: keep the first
            key = row.astype(np.int64) * n + node
            _, once = np.unique(key, return_index=True)
            row, node = row[once], node[once]
            value = np.einsum("pd,pd->p", queries[active[row]], self.vectors[node])
            place = np.arange(len(row)) - np.searchsorted(row, row, "left")
            extra = int(place.max(initial=-1)) + 1
            if not extra:
                continue
            new_ids = np.full((len(active), extra), -1, np.int32)
            new_sims = np.full((len(active), extra), -np.inf, np.float32)
            new_ids[row, place], new_sims[row, place] = node, value
            all_ids = np.concatenate([ids[active], new_ids], axis=1)
            all_sims = np.concatenate([sims[active], new_sims], axis=1)
            all_done = np.concatenate([done[active], new_ids < 0], axis=1)
            top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids[active] = np.take_along_axis(all_ids, top, 1)
            sims[active] = np.take_along_axis(all_sims, top, 1)
            done[active] = np.take_along_axis(all_done, top, 1)
        return ids, sims

    def incoming(self) -> tuple[np.ndarray, np.ndarray]:
        """The nodes that link to each node in the lowest layer: those of node i lie from starts[i] to starts[i + 1]."""
        if self.reverse is None:
            source, column = np.nonzero(self.layers[0] >= 0)
            target = self.layers[0][source, column]
            order = np.argsort(target, kind="stable")
            starts = np.searchsorted(target[order], np.arange(len(self.vectors) + 1))
            self.reverse = source[order], starts
        return self.reverse

    def within(self, queries: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of the nodes found with a cosine of ``least`` or more.

        From those in the beam the search goes on along the lowest layer's links, both ways, so a
        cluster larger than the beam is met whole.
        """
        n, links = len(self.vectors), self.layers[0]
        source, starts = self.incoming()
        found_q, found_n = [], []
        batch = max(16, min(ADDED, SPACE // max(1, n)))
        for first in range(0, len(queries), batch):
            part = queries[first:first + batch]
            ids, sims = self.beam(part, min(width, n))
            row, column = np.nonzero(sims >= least)
            node = ids[row, column].astype(np.int64)
            seen = np.zeros((len(part), n), bool)
            while len(row):
                seen[row, node] = True
                found_q.append(row + first)
                found_n.append(node)
                near, sizes = links[node], starts[node + 1] - starts[node]
                back = source[np.repeat(starts[node] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                row = np.concatenate([np.repeat(row, near.shape[1]), np.repeat(row, sizes)])
                node = np.concatenate([near.ravel(), back]).astype(np.int64)
                fresh = (node >= 0) & ~seen[row, np.maximum(node, 0)]
                key = np.unique(row[fresh] * n + node[fresh])
                row, node = key // n, key % n
                seen[row, node] = True
                close = np.einsum("pd,pd->p", part[row], self.vectors[node]) >= least
                row, node = row[close], node[close]
        if not found_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_q), np.concatenate(found_n)


def _joined(layer: np.ndarray, nodes: np.ndarray, picked: np.ndarray, vectors: np.ndarray) -> None:
    """Set the picked neighbours of new ``nodes`` and link back, re-picking where a node has too many."""
    links = layer.shape[1]
    layer[nodes, :picked.shape[1]] = picked
    row, column = np.nonzero(picked >= 0)
    to, source = picked[row, column], nodes[row].astype(np.int32)
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    targets, starts, counts = np.unique(to, return_index=True, return_counts=True)
    incoming = np.full((len(targets), counts.max(initial=0)), -1, np.int32)
    incoming[np.repeat(np.arange(len(targets)), counts), np.arange(len(to)) - np.repeat(starts, counts)] = source
    for first in range(0, len(targets), 128):
        part = targets[first:first + 128]
        all_ids = np.concatenate([layer[part], incoming[first:first + 128]], axis=1)
        all_ids = np.take_along_axis(all_ids, np.argsort(all_ids < 0, axis=1, kind="stable"), 1)
        all_ids = all_ids[:, :max(links, int((all_ids >= 0).sum(axis=1).max()))]
        full = (all_ids >= 0).sum(axis=1) > links
        layer[part[~full]] = all_ids[~full, :links]
        if full.any():
            sims = np.einsum("qd,qkd->qk", vectors[part[full]], vectors[np.maximum(all_ids[full], 0)])
            layer[part[full]] = spread(sims, all_ids[full], vectors, links)


def build(vectors: np.ndarray, seed: int = 3) -> Graph:
    """The graph of unit ``vectors`` (float32)."""
    n = len(vectors)
    height = (-np.log(np.random.default_rng(seed).random(n) + 1e-300) / np.log(LINKS)).astype(int)
    graph = Graph(vectors, [], int(height.argmax()) if n else 0)
    layers: list[np.ndarray] = []
    for level in range(int(height.max(initial=0)), -1, -1):
        nodes = np.flatnonzero(height >= level)
        nodes = np.concatenate([[graph.entry], nodes[nodes != graph.entry]]).astype(np.int64)
        layer = np.full((n, LINKS * (2 if level == 0 else 1)), -1, np.int32)
        layers.insert(0, layer)
        graph.layers = layers
        seeds = nodes[:SEED_NODES]
        among = vectors[seeds] @ vectors[seeds].T
        np.fill_diagonal(among, -np.inf)
        near = np.argsort(-among, axis=1)[:, :BUILD_BEAM]
        near = near[:, :max(0, len(seeds) - 1)]
        if near.shape[1]:
            _joined(layer, seeds, spread(np.take_along_axis(among, near, 1), seeds[near].astype(np.int32),
                                         vectors, LINKS), vectors)
        at = len(seeds)
        while at < len(nodes):
            added = nodes[at:at + min(ADDED, at, max(16, SPACE // n))]
            ids, sims = graph.beam(vectors[added], min(BUILD_BEAM, at))
            mates = vectors[added] @ vectors[added].T
            np.fill_diagonal(mates, -np.inf)
            best = np.argsort(-mates, axis=1)[:, :LINKS]
            ids = np.concatenate([ids, added[best].astype(np.int32)], axis=1)
            sims = np.concatenate([sims, np.take_along_axis(mates, best, 1)], axis=1)
            ids[~np.isfinite(sims)] = -1
            _joined(layer, added, spread(sims, ids, vectors, LINKS), vectors)
            at += len(added)
    return graph


def audited_width(graph: Graph, least: float, target: float, sample: int, width: int, seed: int = 11) -> tuple[int, float]:
    """The beam, doubled from ``width`` until links of sampled queries are found to ``target``; and the recall.

    A query is a node's vector turned away to a cosine just above ``least``; the links to find are
    those of a comparison with every vector of the shard.
    """
    n, size = graph.vectors.shape
    rng = np.random.default_rng(seed)
    base = graph.vectors[rng.choice(n, min(sample, n), replace=False)]
    aside = rng.normal(size=base.shape).astype(np.float32)
    aside -= np.einsum("qd,qd->q", aside, base)[:, None] * base
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-12)
    cosine = min(1.0, least + 0.2 * (1 - least))
    queries = (cosine * base + (1 - cosine ** 2) ** 0.5 * aside).astype(np.float32)
    whole = int((queries @ graph.vectors.T >= least).sum())
    while True:
        found = len(graph.within(queries, least, width)[0])
        recall = found / whole if whole else 1.0
        if recall >= target or width >= n:
            return width, recall
        width *= 2
