"""Sampled SentencePiece segmentations without replacement, and their decoding.

The lattice of a text holds every way to cut it into pieces of the model's vocabulary. A piece has the probability that Zipf's law
gives its rank (the model ranks its pieces by merge order), a segmentation the product of its pieces', normalised over
the lattice. A character without a piece of its own is also one edge of its UTF-8 bytes' pieces.

Sampling: `samples` distinct segmentations, as by Gumbel top-k. The whole lattice gets a Gumbel value, its largest perturbed
log-probability; a segmentation drawn top down carries it. The rest of the lattice falls into sets of segmentations that leave the
drawn one at the same unit; each set draws its largest value from a Gumbel at the set's log-mass, truncated at the value
above it. The search always takes the set with the largest value, draws its segmentation and splits the set further. So it emits the
k segmentations of the largest perturbed values, without replacement, and touches nothing else. The next value left is the
threshold; a segmentation's inclusion score is log(1 - exp(-exp(log_prob - threshold))).

No piece crosses a border before a run of spaces or around a line break (checked when the model is read), so the lattice of a text is a chain of
units, and log-partitions are worked out once per distinct unit of a batch; the loops run over characters of units and steps, never over
texts. Random numbers are hashes of the seed, the row's key, the unit and the step: equal whatever the partitions.

Defined cases: null and empty texts have one segmentation, without pieces; a text with fewer segmentations than `samples` gives them all,
with inclusion score 0; a row without key is seeded as the empty key; repeated rows get equal samples; an empty table gives an
empty result; further columns are not read; U+2581, the sign for a space, decodes as a space.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.llm.arrays import mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNIT = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
CHUNK, KEPT_UNITS = 1 << 18, 60_000
_STEP, _UNIT, _ROUND = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Pieces:
    """The vocabulary: probabilities, hashes of the strings, and bytes for decoding."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        for i in plain:
            if SPACE in names[i].lstrip(SPACE) or ("\n" in names[i] and len(names[i]) > 1):
                raise ValueError(f"piece {i} crosses a border between units")
        # Merge order is the rank; runs of spaces, which have no merge, rank last.
        scores = np.array([sp.get_score(i) for i in plain])
        rank = np.where(scores < -1e8, size, -scores)
        log = -np.log(rank + 2.0)
        self.log_prob = log - np.logaddexp.reduce(log)
        self.byte_log = float(self.log_prob.min()) - 1.0
        self.ids = np.array(plain)
        self.longest = max(len(names[i]) for i in plain)
        hashes = np.array([self._hash(names[i]) for i in plain], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.place = hashes[order], order
        # Where the hashes with given first 20 bits begin; there are hardly ever two.
        self.start = np.searchsorted(self.hashes >> np.uint64(44), np.arange((1 << 20) + 1, dtype=np.uint64)).astype(np.int32)
        self.deepest = int(np.diff(self.start).max())
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        parts = [b""] * size
        for i in plain:
            parts[i] = names[i].replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_id.tolist()):
            parts[i] = bytes([b])
        self.text = np.frombuffer(b"".join(parts), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    @staticmethod
    def _hash(name: str) -> int:
        h = 0
        for c in name:
            h = (h * 0x9FB21C651E98DF25 + ord(c) + 1) & (2**64 - 1)
        return ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) & (2**64 - 1)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places at which h is a piece's hash, and which piece's."""
        with np.errstate(over="ignore"):
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        bucket = (h >> np.uint64(44)).astype(np.int64)
        near, end = self.start[bucket], self.start[bucket + 1]
        at = np.flatnonzero(near < end)
        found, piece = [], []
        for i in range(self.deepest):
            at = at[near[at] + i < end[at]]
            same = at[self.hashes[near[at] + i] == h[at]]
            found.append(same)
            piece.append(self.place[near[same] + i])
        return np.concatenate(found), np.concatenate(piece)

    def decode(self, ids: np.ndarray) -> bytes:
        size = self.begin[ids + 1] - self.begin[ids]
        at = np.repeat(self.begin[ids] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        return self.text[at].tobytes()[1:]  # without the space put before the text


class _Growing:
    """An array that grows at its end, with room to spare."""

    def __init__(self, kind: type) -> None:
        self.data, self.size = np.zeros(1024, kind), 0

    def extend(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.data):
            wider = np.zeros(max(end, 2 * len(self.data)), self.data.dtype)
            wider[:self.size] = self.data[:self.size]
            self.data = wider
        self.data[self.size:end] = more
        self.size = end

    def values(self) -> np.ndarray:
        return self.data[:self.size]


class Lattices:
    """Lattices of distinct units: nodes are characters, edges are pieces, with the probability of each edge given its node."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self._root = _Growing(np.int32)  # first node of each unit
        self._first_edge = _Growing(np.int32)  # by node
        self._first_edge.extend(np.zeros(1))
        self._cumulative = _Growing(np.float64)  # by edge: cumulative probability in its node
        self._prob = _Growing(np.float64)
        self._rest = _Growing(np.float64)  # by edge: probability of the node's other edges
        self._to = _Growing(np.int32)
        self._id_begin, self._id_count = _Growing(np.int32), _Growing(np.int16)
        self._publish()
        self.id_flat = np.arange(len(self.pieces.begin) - 1)

    def numbers(self, units: list[str]) -> np.ndarray:
        if len(self.number) > KEPT_UNITS:
            self.clear()
        known = self.number
        new = [u for u in dict.fromkeys(units) if u not in known]
        if new:
            base = len(known)
            known.update((u, base + i) for i, u in enumerate(new))
            self._add(new)
        return np.fromiter(map(known.__getitem__, units), np.int64, len(units))

    def _add(self, units: list[str]) -> None:
        pieces = self.pieces
        lengths = np.array([len(u) for u in units])
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.uint64)
        n = len(codes)
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(n)  # characters up to the unit's end
        source, target, log, first_id, count = [], [], [], [], []
        h = np.zeros(n, np.uint64)
        alone = np.zeros(n, bool)
        at = np.arange(n)
        for size in range(1, min(pieces.longest, int(lengths.max())) + 1):
            at = at[left[at] >= size]
            with np.errstate(over="ignore"):
                h[at] = h[at] * np.uint64(0x9FB21C651E98DF25) + codes[at + size - 1] + np.uint64(1)
            hit, piece = pieces.find(h[at])
            where = at[hit]
            if size == 1:
                alone[where] = True
            source.append(where)
            target.append(np.full(len(where), size))
            log.append(pieces.log_prob[piece])
            first_id.append(pieces.ids[piece])
            count.append(np.ones(len(where), np.int64))
        # Ids of an edge are a slice of id_flat, which begins with the ids themselves.
        bare = np.flatnonzero(~alone)
        if len(bare):
            raw = [chr(c).encode("utf-8", "replace") for c in codes[bare].tolist()]
            sizes = np.array([len(b) for b in raw])
            source.append(bare)
            target.append(np.ones(len(bare), np.int64))
            log.append(pieces.byte_log * sizes)
            first_id.append(len(self.id_flat) + np.cumsum(sizes) - sizes)
            count.append(sizes)
            self.id_flat = np.concatenate([self.id_flat, pieces.byte_id[np.frombuffer(b"".join(raw), np.uint8)]])
        s, t, w, i, c = (np.concatenate(x) for x in (source, target, log, first_id, count))
        # Log-partitions from the end: edges in the order of what is left at their source.
        order = np.argsort((left[s] * n + s) * (pieces.longest + 1) + t)
        s, t, w, i, c = s[order], t[order], w[order], i[order], c[order]
        rest = left[s]
        beta = np.zeros(n + 1)
        cuts = np.searchsorted(rest, np.arange(1, int(lengths.max()) + 2))
        for r in range(len(cuts) - 1):
            a, b = cuts[r], cuts[r + 1]
            if a == b:
                continue
            src, dst = s[a:b], s[a:b] + t[a:b]
            value = w[a:b] + np.where(t[a:b] == rest[a:b], 0.0, beta[np.minimum(dst, n)])
            head = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]]))
            top = np.maximum.reduceat(value, head)
            sums = np.add.reduceat(np.exp(value - np.repeat(top, np.diff(np.append(head, b - a)))), head)
            beta[src[head]] = top + np.log(sums)
        value = w + np.where(t == left[s], 0.0, beta[np.minimum(s + t, n)])
        prob = np.exp(value - beta[s])
        order = np.argsort(s + (1.0 - prob) * 0.999, kind="stable")  # the likeliest edge of a node first
        s, t, i, c, prob = s[order], t[order], i[order], c[order], prob[order]
        # One more node per unit, its end, without edges.
        unit_of = np.repeat(np.arange(len(units)), lengths)
        node_base, edge_base = len(self.first_edge) - 1, len(self.prob)
        node = s + unit_of[s] + node_base
        head = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        sizes = np.diff(np.append(head, len(s)))
        # Node by node, so that no rounding depends on what else is in the batch.
        running, rest = prob.copy(), np.zeros(len(prob))
        for k in range(1, int(sizes.max())):
            more = head[sizes > k]
            running[more + k] += running[more + k - 1]
            rest[more] += prob[more + k]
        others = np.ones(len(prob), bool)
        others[head] = False
        rest[others] = np.repeat(running[head + sizes - 1], sizes)[others] - prob[others]
        degree = np.bincount(node - node_base, minlength=n + len(units))
        self._root.extend(node_base + ends - lengths + np.arange(len(units)))
        self._first_edge.extend(edge_base + np.cumsum(degree))
        self._cumulative.extend(running)
        self._prob.extend(prob)
        self._rest.extend(rest)
        self._to.extend(node + t)
        self._id_begin.extend(i)
        self._id_count.extend(c)
        self._publish()

    def _publish(self) -> None:
        for name in ("root", "first_edge", "cumulative", "prob", "rest", "to", "id_begin", "id_count"):
            setattr(self, name, getattr(self, f"_{name}").values())

    def walk(self, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Draw a path from each node to its unit's end: edges (path after path), begins of paths, log-probabilities, and the
        probability of all other paths."""
        owners, edges, steps = [], [], []
        keep, leave = np.ones(len(nodes)), np.zeros(len(nodes))
        owner, node, step = np.arange(len(nodes)), nodes, 0
        while len(owner):
            open_ = self.first_edge[node + 1] > self.first_edge[node]
            owner, node = owner[open_], node[open_]
            if not len(owner):
                break
            with np.errstate(over="ignore"):
                u = uniform(seeds[owner] + np.uint64(step) * _STEP)
            edge, last = self.first_edge[node], self.first_edge[node + 1] - 1
            on = np.flatnonzero((self.cumulative[edge] <= u) & (edge < last))
            while len(on):
                edge[on] += 1
                on = on[(self.cumulative[edge[on]] <= u[on]) & (edge[on] < last[on])]
            leave[owner] += keep[owner] * self.rest[edge]
            keep[owner] *= self.prob[edge]
            owners.append(owner)
            edges.append(edge)
            steps.append(np.full(len(owner), step))
            node = self.to[edge]
            step += 1
        if not owners:
            return np.zeros(0, np.int64), np.zeros(len(nodes) + 1, np.int64), np.zeros(len(nodes)), leave
        owner, edge, step = np.concatenate(owners), np.concatenate(edges), np.concatenate(steps)
        begin = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(nodes)))])
        flat = np.empty(len(edge), np.int64)
        flat[begin[owner] + step] = edge
        logs = np.bincount(owner, weights=np.log(self.prob[edge]), minlength=len(nodes))
        return flat, begin, logs, leave

    def _tails(self, path: list[int], node: int) -> list[float]:
        """For each step of a path: the probability, from there on, of all other paths. Sums of what is left, no differences."""
        nodes = [node, *(int(self.to[e]) for e in path)]
        out = [0.0] * (len(path) + 1)
        for d in range(len(path) - 1, -1, -1):
            a, b = int(self.first_edge[nodes[d]]), int(self.first_edge[nodes[d] + 1])
            out[d] = float(self.prob[path[d]]) * out[d + 1] + sum(float(self.prob[x]) for x in range(a, b) if x != path[d])
        return out

    def left_out(self, node: int, taken: list[list[int]]) -> float:
        """The probability, from a node on, of all paths but the taken ones, which are distinct."""
        total, keep, depth = 0.0, 1.0, 0
        while len(taken) > 1:
            edges = range(int(self.first_edge[node]), int(self.first_edge[node + 1]))
            heads = {path[depth] for path in taken}
            total += keep * sum(float(self.prob[e]) for e in edges if e not in heads)
            if len(heads) > 1:
                inner = {e: [path[depth + 1:] for path in taken if path[depth] == e] for e in heads}
                return total + keep * sum(float(self.prob[e]) * self.left_out(int(self.to[e]), own) for e, own in inner.items())
            edge = heads.pop()
            keep, node, depth = keep * float(self.prob[edge]), int(self.to[edge]), depth + 1
        return total + keep * (self._tails(taken[0][depth:], node)[0] if taken else 1.0)

    def other_path(self, node: int, taken: list[list[int]], seed: int) -> list[int]:
        """A path from a node on, drawn among all but the taken ones."""
        numbers, path, tails, depth = _numbers(seed), [], None, 0
        while (a := int(self.first_edge[node])) < (b := int(self.first_edge[node + 1])):
            weights = [float(x) for x in self.prob[a:b]]
            if len(taken) == 1:
                if tails is None:
                    tails, depth = self._tails(taken[0], node), 0
                weights[taken[0][depth] - a] *= tails[depth + 1]
            elif taken:
                for e in {p[0] for p in taken}:
                    weights[e - a] *= self.left_out(int(self.to[e]), [p[1:] for p in taken if p[0] == e])
            draw, at = next(numbers) * sum(weights), 0
            while at < b - a - 1 and (weights[at] <= 0 or draw >= weights[at]):
                draw -= weights[at]
                at += 1
            while weights[at] <= 0:
                at -= 1
            edge = a + at
            path.append(edge)
            if tails is not None:
                taken, depth = (taken if taken and taken[0][depth] == edge else []), depth + 1
            else:
                taken = [p[1:] for p in taken if p[0] == edge]
            node = int(self.to[edge])
        return path

    def piece_ids(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the edges, and where those of each edge begin (one more than edges)."""
        count = self.id_count[edges].astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(self.id_begin[edges] - begin[:-1], count) + np.arange(begin[-1])
        return self.id_flat[at], begin


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) hashed from 64-bit numbers."""
    with np.errstate(over="ignore"):
        return ((mix(x * _STEP + _UNIT) >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


def _numbers(seed: int) -> Iterator[float]:
    """An endless row of numbers in (0, 1) hashed from a seed."""
    while True:
        with np.errstate(over="ignore"):
            block = uniform(np.uint64(seed) + np.arange(64, dtype=np.uint64) * _STEP)
        yield from block.tolist()
        seed = (seed * 6364136223846793005 + 1442695040888963407) & (2**64 - 1)


def truncated_gumbel(location: np.ndarray, bound: float | np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values at the locations, given that they are below the bound; minus infinity at minus infinity."""
    with np.errstate(over="ignore", divide="ignore"):
        free = location - np.log(-np.log(u))
        return -np.logaddexp(-bound, -free)


class _Path:
    """A drawn segmentation: edges by unit, log-probability of each unit, and the probability of the unit's other paths."""

    def __init__(self, edges: np.ndarray, begin: np.ndarray, logs: np.ndarray, leave: np.ndarray) -> None:
        self.edges, self.begin, self.logs, self.leave = edges, begin, logs, leave

    def leaving(self, start: int = 0) -> np.ndarray:
        """Log-mass, by unit from start on, of the segmentations that follow the path up to the unit and leave it there."""
        if start >= len(self.logs):
            return np.zeros(0)
        before = np.concatenate([[0.0], np.cumsum(self.logs[:-1])])
        with np.errstate(divide="ignore"):
            return before[start:] + np.log(self.leave[start:])


def sample_text(
    lattices: Lattices, roots: np.ndarray, rounds: list[_Path], seed: int, first: float, values: np.ndarray
) -> list[tuple[np.ndarray, float, float, float]]:
    """Edges, log-probability, perturbed value and inclusion score of the segmentations of one text. rounds: an independent
    draw of all units for each sample; first: the value of the first, values: those of the sets that leave it, by unit."""
    def draws(count: int, stream: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return uniform(np.uint64(seed) + np.arange(count, dtype=np.uint64) * _UNIT + np.uint64(stream) * _ROUND)

    found: list[tuple[_Path, float]] = [(rounds[0], first)]
    sets: list[tuple[float, int, int, list[list[int]]]] = []  # value, path, unit, paths taken there

    def split(path: _Path, number: int, values: np.ndarray, start: int) -> None:
        # Only as many sets as segmentations are still wanted can matter, and one for the threshold.
        most = len(rounds) + 1
        best = np.argpartition(-values, most)[:most] if len(values) > most else np.arange(len(values))
        for i in best.tolist():
            if values[i] > -np.inf:
                unit = start + i
                sets.append((float(values[i]), number, unit, [path.edges[path.begin[unit]:path.begin[unit + 1]].tolist()]))

    split(rounds[0], 0, values, 0)
    while len(found) < len(rounds) and sets:
        sets.sort(key=lambda s: -s[0])
        value, number, unit, taken = sets.pop(0)
        parent, fresh, this = found[number][0], rounds[len(found)], len(found)
        own = lattices.other_path(int(roots[unit]), taken, (seed + 31 * this) & (2**64 - 1))
        own_log = float(np.log(lattices.prob[own]).sum())
        a, b, c = parent.begin[unit], fresh.begin[unit + 1], len(own)
        edges = np.concatenate([parent.edges[:a], np.array(own, np.int64), fresh.edges[b:]])
        begin = np.concatenate([parent.begin[:unit + 1], fresh.begin[unit + 1:] - b + a + c])
        path = _Path(
            edges, begin, np.concatenate([parent.logs[:unit], [own_log], fresh.logs[unit + 1:]]),
            np.concatenate([parent.leave[:unit], [0.0], fresh.leave[unit + 1:]]),  # at this unit, see below
        )
        found.append((path, value))
        # What is left of the set: other paths at the same unit.
        gone = [*taken, own]
        mass_left = lattices.left_out(int(roots[unit]), gone)
        if mass_left > 0:
            location = float(parent.logs[:unit].sum() + np.log(mass_left))
            again = truncated_gumbel(np.array([location]), value, draws(1, 2 * this + 2))[0]
            sets.append((float(again), number, unit, gone))
        mass = path.leaving(unit + 1)
        split(path, this, truncated_gumbel(mass, value, draws(len(mass), 2 * this + 1)), unit + 1)
    threshold = max((s[0] for s in sets), default=-np.inf)
    out = []
    for path, value in found:
        log = float(path.logs.sum())
        if threshold == -np.inf:
            score = 0.0
        else:
            gap = log - threshold
            score = gap if gap < -30 else float(np.log(-np.expm1(-np.exp(min(gap, 700.0)))))
        out.append((path.edges, log, value, score))
    return out


@functools.lru_cache(1)
def _lattices(model: bytes) -> Lattices:
    """The lattices of a worker: its tasks go on with the units that earlier ones met."""
    return Lattices(Pieces(model))


def _sampler(model: bytes, samples: int, seed: int, checked: bool):
    names = ["rec", "sample", "ids", "log_prob", "perturbed", "inclusion", *(["round_trip"] if checked else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = _lattices(model)
        for batch in batches:
            keys, texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
            row = 0
            while row < len(texts):
                last, size = row, 0
                while last < len(texts) and (last == row or size + len(texts[last] or "") <= CHUNK):
                    size += len(texts[last] or "")
                    last += 1
                cut = [UNIT.findall((SPACE + t).replace(" ", SPACE)) if t else [] for t in texts[row:last]]
                begin = np.concatenate([[0], np.cumsum([len(u) for u in cut])])
                roots_of = lattices.numbers([u for units in cut for u in units])
                roots = lattices.root[roots_of]
                seeds = np.array([
                    int.from_bytes(hashlib.blake2b(f"{seed}:{'' if k is None else k}".encode(), digest_size=8).digest(), "little")
                    for k in keys[row:last]
                ], dtype=np.uint64)
                with np.errstate(over="ignore"):
                    unit_seeds = np.repeat(seeds, np.diff(begin)) + (np.arange(begin[-1]) - np.repeat(begin[:-1], np.diff(begin))).astype(np.uint64) * _UNIT
                    drawn = [lattices.walk(roots, mix(unit_seeds + np.uint64(r + 1) * _ROUND)) for r in range(samples)]
                # The first draw of every text, its value, and the values of the sets that leave it.
                paths = [[_Path(e[s[a]:s[b]], s[a:b + 1] - s[a], lo[a:b], le[a:b]) for e, s, lo, le in drawn] for a, b in zip(begin[:-1], begin[1:])]
                counts = np.diff(begin)
                mass = np.concatenate([rounds[0].leaving() for rounds in paths])
                with np.errstate(over="ignore"):
                    firsts = -np.log(-np.log(uniform(seeds + np.uint64(999_983) * _ROUND)))
                    sets = truncated_gumbel(mass, np.repeat(firsts, counts), uniform(unit_seeds + _ROUND))
                owner, number, ids, offsets, logs, values, scores, same = [], [], [], [0], [], [], [], []
                for d in range(last - row):
                    a, b = begin[d], begin[d + 1]
                    for n, (edges, log, value, score) in enumerate(sample_text(lattices, roots[a:b], paths[d], int(seeds[d]), float(firsts[d]), sets[a:b])):
                        got, _ = lattices.piece_ids(edges)
                        owner.append(row + d)
                        number.append(n)
                        ids.append(got.astype(np.int32))
                        offsets.append(offsets[-1] + len(got))
                        logs.append(log)
                        values.append(value)
                        scores.append(score)
                        if checked:
                            same.append(lattices.pieces.decode(got) == (texts[row + d] or "").encode())
                lists = pa.ListArray.from_arrays(pa.array(np.array(offsets, np.int32)), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rec").take(pa.array(owner)), pa.array(number, pa.int32()), lists, pa.array(logs, pa.float64()),
                     pa.array(values, pa.float64()), pa.array(scores, pa.float64()), *([pa.array(same, pa.bool_())] if checked else [])],
                    names=names,
                )
                row = last

    return run


def sample_segmentations(
    docs: DataFrame, samples: int = 2, seed: int = 1, key: str = "doc_id", text: str = "text", model: str = MODEL,
    carry: dict[str, Column] | None = None, checked: bool = False,
) -> DataFrame:
    """doc_id, the columns of `carry`, sample (0 first), ids, log_prob, perturbed (falling with the sample) and inclusion
    (a log-probability): a row for each sampled segmentation of each document. `checked`: the ids are decoded where they are made, and
    round_trip tells whether that gives the text. The model file is read on the driver and sent to the tasks (half a megabyte)."""
    with open(model, "rb") as file:
        content = file.read()
    own = [F.col(key).alias("doc_id"), *[c.alias(n) for n, c in (carry or {}).items()]]
    rows = docs.select(F.struct(*own).alias("rec"), F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"rec {rows.schema['rec'].dataType.simpleString()}, sample int, ids array<int>, log_prob double, perturbed double, inclusion double"
    more = ["round_trip"] if checked else []
    sampled = rows.mapInArrow(_sampler(content, samples, seed, checked), schema + "".join(f", {c} boolean" for c in more))
    return sampled.select("rec.*", "sample", "ids", "log_prob", "perturbed", "inclusion", *more)


def _decoder(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _lattices(model).pieces
        for batch in batches:
            lists = batch.column("ids")
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            texts = [pieces.decode(flat[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("rec"), pa.array(texts, pa.binary())], names=["rec", "decoded"])

    return run


def decode_ids(rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """The rows without their ids, with the decoded text (UTF-8 bytes) instead."""
    with open(model, "rb") as file:
        content = file.read()
    packed = rows.select(F.struct(*[F.col(c) for c in rows.columns if c != ids]).alias("rec"), F.col(ids).alias("ids"))
    schema = f"rec {packed.schema['rec'].dataType.simpleString()}, decoded binary"
    return packed.mapInArrow(_decoder(content), schema).select("rec.*", "decoded")
