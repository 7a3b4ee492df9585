"""A hierarchical navigable small-world graph over the unit vectors of one shard, built and searched in batches."""

from __future__ import annotations

import pickle

import numpy as np

#: Links of a node on the upper levels; the lowest has twice as many.
LINKS = 16
BUILD_BEAM = 64
#: Nodes expanded at once by each search.
STEP = 4
BATCH = 256


class Graph:
    """``points`` are unit vectors (float32), in an order that does not depend on their values."""

    def __init__(self, points: np.ndarray):
        self.points = points
        n = len(points)
        draw = np.random.default_rng(n).random(n)
        self.level = np.minimum((-np.log(1 - draw) / np.log(LINKS)).astype(np.int64), 6)
        if n:
            self.level[0] = self.level.max()
        self.top = int(self.level.max()) if n else 0
        # Row of a node in the link table of each level, and the tables themselves (-1: no link).
        self.row = [np.where(self.level >= l, np.cumsum(self.level >= l) - 1, -1) for l in range(self.top + 1)]
        self.links = [np.full((int((self.level >= l).sum()), LINKS * (2 if l == 0 else 1)), -1, np.int64) for l in range(self.top + 1)]
        at, size = 1, 1
        while at < n:
            self._insert(np.arange(at, min(at + size, n)))
            at, size = at + size, min(2 * size, BATCH)

    def dump(self) -> bytes:
        return pickle.dumps((self.points, *([t.astype(np.int32) for t in tables] for tables in (self.row, self.links)), self.top), protocol=5)

    @classmethod
    def load(cls, raw: bytes) -> Graph:
        graph = cls.__new__(cls)
        graph.points, graph.row, graph.links, graph.top = pickle.loads(raw)
        return graph

    # --- building ---------------------------------------------------------------------------------------------------

    def _insert(self, new: np.ndarray) -> None:
        queries = self.points[new]
        entry = np.zeros((len(new), 1), np.int64)
        near = queries @ queries.T
        np.fill_diagonal(near, -2)
        for level in range(self.top, -1, -1):
            found, alike = self._beam(queries, entry, level, BUILD_BEAM if level <= self.level[new].max() else 1)
            entry = found[:, : max(1, min(8, found.shape[1]))]
            takes = np.flatnonzero(self.level[new] >= level)
            if not len(takes):
                continue
            # Nodes of the same batch are candidates too.
            others = np.argsort(-near[np.ix_(takes, takes)], axis=1, kind="stable")[:, :LINKS]
            beside, beside_alike = new[takes][others], np.take_along_axis(near[np.ix_(takes, takes)], others, 1)
            ids = np.concatenate([found[takes], np.where(beside_alike > -2, beside, -1)], axis=1)
            sims = np.concatenate([np.where(found[takes] >= 0, alike[takes], -2), beside_alike], axis=1)
            chosen = self._diverse(ids, sims, LINKS)
            table = self.links[level]
            table[self.row[level][new[takes]], :LINKS] = chosen
            self._link_back(level, np.repeat(new[takes], LINKS), chosen.ravel())

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """For each row up to ``most`` candidates, best first, that are nearer to the query than to any one chosen; the
        places left over go to the best of the others."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        valid = (ids >= 0) & (sims > -2)
        # A candidate may come twice (from the graph and as a neighbour).
        for k in range(1, ids.shape[1]):
            valid[:, k] &= ~((ids[:, :k] == ids[:, k : k + 1]) & valid[:, :k]).any(axis=1)
        points = self.points[np.maximum(ids, 0)]
        between = points @ points.transpose(0, 2, 1)
        chosen = np.zeros_like(valid)
        for k in range(ids.shape[1]):
            closer = (np.where(chosen, between[:, k], -2) > sims[:, k : k + 1]).any(axis=1)
            chosen[:, k] = valid[:, k] & ~closer & (chosen.sum(axis=1) < most)
        rank = np.where(chosen, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        first = np.argsort(rank, axis=1)[:, :most]
        out = np.where(np.take_along_axis(valid, first, 1), np.take_along_axis(ids, first, 1), -1)
        if out.shape[1] < most:
            out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
        return out

    def _link_back(self, level: int, sources: np.ndarray, targets: np.ndarray) -> None:
        keep = targets >= 0
        sources, targets = sources[keep], targets[keep]
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        nodes, begin, counts = np.unique(targets, return_index=True, return_counts=True)
        table, width = self.links[level], self.links[level].shape[1]
        for a in range(0, len(nodes), 512):
            part, first, n = nodes[a : a + 512], begin[a : a + 512], counts[a : a + 512]
            grid = first[:, None] + np.arange(n.max())
            extra = np.where(np.arange(n.max()) < n[:, None], sources[np.minimum(grid, len(sources) - 1)], -1)
            old = table[self.row[level][part]]
            ids = np.concatenate([old, extra], axis=1)
            used = max(int((ids >= 0).sum(axis=1).max()), 1)
            order = np.argsort(ids < 0, axis=1, kind="stable")[:, : max(used, 1)]
            ids = np.take_along_axis(ids, order, 1)
            if used <= width:
                table[self.row[level][part], :used] = ids
                continue
            sims = np.einsum("bd,bmd->bm", self.points[part], self.points[np.maximum(ids, 0)])
            table[self.row[level][part]] = self._diverse(ids, np.where(ids >= 0, sims, -2), width)

    # --- searching --------------------------------------------------------------------------------------------------

    def _beam(self, queries: np.ndarray, entry: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The best nodes met, best first (-1: none), and their similarities; stops when a beam has no unexpanded node."""
        count, n = len(queries), len(self.points)
        table, row = self.links[level], self.row[level]
        seen = np.zeros((count, n), dtype=bool)
        lines = np.arange(count)[:, None]
        width = max(beam, entry.shape[1])
        ids = np.full((count, width), -1, np.int64)
        sims = np.full((count, width), -2, np.float32)
        done = np.ones((count, width), dtype=bool)
        ids[:, : entry.shape[1]] = entry
        valid = entry >= 0
        sims[:, : entry.shape[1]] = np.where(valid, np.einsum("bd,bmd->bm", queries, self.points[np.maximum(entry, 0)]), -2)
        done[:, : entry.shape[1]] = ~valid
        seen[np.broadcast_to(lines, entry.shape)[valid], entry[valid]] = True
        active = np.arange(count)
        while len(active):
            open_sims = np.where(done[active], -3, sims[active])
            step = min(STEP, width)
            pick = np.argpartition(-open_sims, step - 1, axis=1)[:, :step]
            usable = np.take_along_axis(open_sims, pick, 1) > -2.5
            going = usable.any(axis=1)
            active, pick, usable = active[going], pick[going], usable[going]
            if not len(active):
                break
            done[active[:, None], pick] = True
            nodes = np.where(usable, np.take_along_axis(ids[active], pick, 1), 0)
            near = np.where(usable[:, :, None], table[row[nodes]], -1).reshape(len(active), -1)
            near = np.sort(near, axis=1)
            fresh = near >= 0
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            fresh &= ~seen[active[:, None], np.maximum(near, 0)]
            i, j = np.nonzero(fresh)
            seen[active[i], near[i, j]] = True
            # Compact the fresh nodes of each query to the left.
            per = fresh.sum(axis=1)
            most = int(per.max()) if len(per) else 0
            if not most:
                continue
            place = np.arange(len(i)) - np.repeat(np.cumsum(per) - per, per)
            more = np.full((len(active), most), -1, np.int64)
            more[i, place] = near[i, j]
            more_sims = np.full((len(active), most), -2, np.float32)
            more_sims[i, place] = np.einsum("kd,kd->k", queries[active[i]], self.points[near[i, j]])
            all_ids = np.concatenate([ids[active], more], axis=1)
            all_sims = np.concatenate([sims[active], more_sims], axis=1)
            all_done = np.concatenate([done[active], more < 0], axis=1)
            best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width] if all_sims.shape[1] > width else np.broadcast_to(np.arange(width), (len(active), width))
            ids[active], sims[active] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_sims, best, 1)
            done[active] = np.take_along_axis(all_done, best, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1)[:, :beam], np.take_along_axis(sims, order, 1)[:, :beam]

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes found for every query, best first (-1: none), and their similarities."""
        ids, sims = [], []
        for a in range(0, len(queries), BATCH):
            part = queries[a : a + BATCH]
            entry = np.zeros((len(part), 1), np.int64)
            for level in range(self.top, 0, -1):
                entry = self._beam(part, entry, level, 4)[0]
            found = self._beam(part, entry, 0, beam)
            ids.append(found[0])
            sims.append(found[1])
        if not ids:
            return np.zeros((0, beam), np.int64), np.zeros((0, beam), np.float32)
        return np.concatenate(ids), np.concatenate(sims)
