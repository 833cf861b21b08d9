"""SentencePiece encoding by sampling without replacement, and decoding.

Segmentations of a text are paths of its lattice; a path's probability is the product of its pieces'
Zipf weights (by merge rank), normalised.  Perturbing path log-probabilities with Gumbel noise and taking the
K largest samples K distinct paths without replacement.  The search is A-star: noise is drawn top down, so the
bound of a partial path is the exact maximum over its completions and each sample is finished
without a detour; the branches it passes join the queue with bounds drawn given their parent's.
The (K+1)-th bound is the threshold that the inclusion scores, 1 - exp(-exp(log p - threshold)), need.

No piece crosses certain character boundaries (checked against the vocabulary), so a text's lattice is a
chain of small lattices of units, each built once per worker; a chunk of texts is walked in step by
NumPy.  All noise is a hash of the row's key, the sample and the place, so results don't depend on
partitioning or retries.

Null and empty texts have one segmentation, the empty one; a text with fewer than K segmentations gives
them all; a null doc_id has key 0; rows that share a doc_id and text give the same samples.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, lean, text_batches

SAMPLES = 2
#: Units whose lattices a worker keeps, and characters walked at once.
KEPT_UNITS = 200_000
CHUNK = 250_000
#: Below this log-probability of a prefix no branch can matter: the least gap is e^-38, so its bound is above
#: e^7, while the first places with a choice, whose prefixes are likely, give the kept bounds of about one.
DEEPEST = -45.0
#: The first places of a path whose branches are compared at once: those with prefixes likelier than that.
LIKELY = -4.0
SAMPLE = "doc_id long, rank int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, inclusion double, decoded boolean"
_SPACE = "▁"
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]

#: The first 0 to 8 bytes of a word.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _mixed(x: np.ndarray, k: int, part) -> np.ndarray:
    """The hash x with an integer as its k-th part."""
    x = (x ^ (np.asarray(part).astype(np.uint64) + _C[k])) * _C[k]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _fraction(x: np.ndarray) -> np.ndarray:
    """In (0, 1), from a hash."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _uniform(key: np.ndarray, *parts) -> np.ndarray:
    """In (0, 1), from the key and integers."""
    for k, p in enumerate(parts):
        key = _mixed(key, k, p)
    return _fraction(key)


def _grown(a: np.ndarray, used: int, need: int) -> np.ndarray:
    """a, or its used part in a larger array; what follows that is not set."""
    if need <= len(a):
        return a
    whole = np.empty(max(need, 2 * len(a)), a.dtype)
    whole[:used] = a[:used]
    return whole


def shown(normalized: str) -> str:
    """normalized with spaces for the space marks, the leading one taken off."""
    text = normalized.replace(_SPACE, " ")
    return text[1:] if text.startswith(" ") else text


class _Numbers(dict):
    """Numbers of units in the order in which they are met; new lists those whose lattices are not built."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = n = len(self)
        self.new.append(unit)
        return n


class Lattices:
    """The lattices of units seen so far, as flat arrays of nodes and edges."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(k) for k in range(size)]
        special = {k for k in range(size) if self.model.is_byte(k) or self.model.is_control(k) or self.model.is_unknown(k)}
        self.byte = {int(names[k][1:-1], 16): k for k in special if self.model.is_byte(k)}
        self.bytes = [bytes([int(names[k][1:-1], 16)]) if self.model.is_byte(k) else b"" if k in special else names[k].encode() for k in range(size)]
        first = min(set(range(size)) - special)
        self.whole = np.array([x.decode().replace(_SPACE, " ") if x.isascii() or k not in special else "" for k, x in enumerate(self.bytes)], object)
        self.partial = np.array([not x.isascii() and k in special for k, x in enumerate(self.bytes)])  # a byte of a longer character
        self.pieces = {names[k]: (k, -np.log(2.0 + k - first)) for k in range(size) if k not in special}
        self.rare = -float(np.log(2.0 + size))
        self.longest = max(map(len, self.pieces))
        self.weight = np.array([self.pieces.get(names[k], (k, self.rare))[1] for k in range(size)])
        self.prefixes = {p[:k]: -1 for p in self.pieces for k in range(1, len(p))} | {p: k for p, (k, _) in self.pieces.items()}
        self.letter, self.kinds = None, None
        self.cut = self._units()
        if self.letter:
            self._kinds()
        self._trie()
        self.node, self.first, self.many = (np.empty(1 << 16, np.int32) for _ in range(3))
        self.total, self.share = np.empty(1 << 17, np.float32), np.empty(1 << 17)
        self.to, self.piece, self.next = (np.empty(1 << 17, np.int32) for _ in range(3))
        self.clear()

    def _units(self) -> re.Pattern:
        """Letters apart from other characters if no piece mixes them, but for a few characters; else runs without space."""
        odd: set[str] = set()
        for _ in range(4):
            mixed = "".join(map(re.escape, sorted(odd)))
            letter = rf"[^\W\d_{mixed}]"
            found = re.compile(rf"{_SPACE}*{letter}+|{_SPACE}*(?:(?![{_SPACE}\n])[\W\d_{mixed}])+|{_SPACE}+|\n")
            crossing = [p for p in self.pieces if len(found.findall(p)) > 1]
            if not crossing:
                self.letter = re.compile(letter)
                return found
            odd |= {c for p in crossing for c in p if re.fullmatch(letter, c)}
        found = re.compile(rf"{_SPACE}*[^{_SPACE}\n]+|{_SPACE}+|\n")
        if any(len(found.findall(p)) > 1 for p in self.pieces):
            found = re.compile(r".+", re.S)
        return found

    def _kinds(self) -> None:
        """Of the first 65,536 characters the kind (0: space mark, 1: letter, 2: other, 3: line end), above eight bits of its own (0 if it isn't plain)."""
        self.kinds = np.full(1 << 16, 2 << 8, np.uint16)
        self.kinds[[m.start() for m in self.letter.finditer("".join(map(chr, range(1 << 16))))]] = 1 << 8
        self.kinds[[ord(_SPACE), 10]] = 32, 3 << 8
        self.kinds[1:256] |= np.arange(1, 256, dtype=np.uint16)
        self.kinds[32] &= 0xFF00

    def _trie(self) -> None:
        """Transitions of the pieces' prefix tree over characters below 256 (the space mark is 0): state 0 is dead, 1 the root."""
        states = {"": 1}
        for p in self.pieces:
            code = p.replace(_SPACE, "\0")
            if "\0" not in p and max(code) < "\u0100":
                for k in range(1, len(code) + 1):
                    states.setdefault(code[:k], len(states) + 1)
        self.move = np.zeros((len(states) + 1, 256), np.int32)
        self.ends = np.full(len(states) + 1, -1, np.int32)
        for code, k in states.items():
            if code:
                self.move[states[code[:-1]], ord(code[-1])] = k
                found = self.pieces.get(code.replace("\0", _SPACE))
                self.ends[k] = found[0] if found else -1

    def clear(self) -> None:
        """Forgets the units; the arrays keep their size.  next: the first edge of an edge's target, -1 at a unit's end."""
        self.index, self.packed = _Numbers(), {}
        self.nodes = self.edges = 0

    def _build(self, units: list[str], numbers: np.ndarray) -> None:
        """Adds the units' lattices; units of plain characters, each a piece of its own, go through the prefix tree all at once."""
        joined, odd = "\n".join(units), np.zeros(len(units), bool)
        if "\0" in joined or joined.count("\n") >= len(units):
            odd |= ["\0" in u or "\n" in u for u in units]
        if not odd.any():
            text = np.frombuffer((joined.replace(_SPACE, "\0") + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
            plain = text.astype(np.uint8)
            stop = text == 10
            at, last = np.flatnonzero(~stop), np.flatnonzero(stop)
            state = self.move[1, plain[at]]
            odd[np.searchsorted(last, at[(self.ends[state] < 0) | (text[at] > 255)])] = True
            if not odd.any():
                self._matched(numbers, plain, at, state, last)
                return
        self._looked_up([units[k] for k in np.flatnonzero(odd)], numbers[odd])
        if not odd.all():
            self._build([units[k] for k in np.flatnonzero(~odd)], numbers[~odd])

    def _matched(self, numbers: np.ndarray, text: np.ndarray, at: np.ndarray, state: np.ndarray, last: np.ndarray) -> None:
        base, found, length = self.nodes, [], 1
        while len(at):
            piece = self.ends[state]
            hit = piece >= 0
            found.append((at[hit], np.full(int(hit.sum()), length), piece[hit]))
            state = self.move[state, text[at + length]] if length < self.longest else np.zeros_like(state)
            live = (state > 0) & (text[at + length] != 10)
            at, state, length = at[live], state[live], length + 1
        source, step, piece = (np.concatenate([f[k] for f in reversed(found)]) for k in range(3))
        order = np.argsort(source, kind="stable")  # presorted runs; the longest, likeliest pieces come first
        source, step, piece = source[order] + base, step[order], piece[order]
        first = np.concatenate(([0], last[:-1] + 1)) + base
        self.node[numbers] = first
        self._added(source, source + step, source + step, piece, self.weight[piece], last + base, base + len(text), [])

    def _looked_up(self, units: list[str], numbers: np.ndarray) -> None:
        base, get, most = self.nodes, self.prefixes.get, self.longest
        packed, ends, chains = [], [], []  # packed: node, length and piece of an edge
        node = base
        for unit, number in zip(units, numbers.tolist(), strict=True):
            self.node[number] = node
            n = len(unit)
            for i in range(n):
                k = get(unit[i])
                if k is None or k < 0:
                    chains.append((node + i, unit[i].encode("utf-8", "surrogatepass")))
                    if k is None:
                        continue
                else:
                    packed.append((node + i) << 27 | 1 << 20 | k)
                for j in range(i + 2, (n if n < i + most else i + most) + 1):
                    k = get(unit[i:j])
                    if k is None:
                        break
                    if k >= 0:
                        packed.append((node + i) << 27 | (j - i) << 20 | k)
            ends.append(node + n)
            node += n + 1
        packed = np.array(packed, np.int64)
        source, piece = packed >> 27, packed & (1 << 20) - 1
        to = reach = source + (packed >> 20 & 127)
        weight = self.weight[piece]
        opening, chained = [], []  # the nodes inside a character spelt in bytes lead on with certainty
        for at, raw in chains:
            inner = [node + k for k in range(len(raw) - 1)] + [at + 1]
            node += len(raw) - 1
            opening.append((at, inner[0], at + 1, self.byte[raw[0]], self.rare * len(raw)))
            chained += [(inner[k], inner[k + 1], self.byte[b]) for k, b in enumerate(raw[1:])]
        if opening:
            more = [np.array(x) for x in zip(*opening, strict=True)]
            source, to, reach, piece, weight = (np.concatenate(x) for x in zip((source, to, reach, piece, weight), more, strict=True))
        order = np.lexsort((-to, source))
        self._added(*(x[order] for x in (source, to, reach, piece, weight)), np.array(ends, np.int64), node, chained)

    def _added(self, source, to, reach, piece, weight, last, end, chained) -> None:
        """Path sums from the units' ends, one distance for all units at once, then the flat arrays; edges come by source."""
        base = self.nodes
        left = np.repeat(last, np.diff(last, prepend=base - 1))[source - base] - source
        value = np.zeros(end - base)
        order = np.argsort(left.astype(np.uint16), kind="stable") if left.max(initial=0) < 1 << 16 else np.argsort(left, kind="stable")
        of, w, goal = source[order] - base, weight[order], reach[order] - base
        levels = np.flatnonzero(np.diff(left[order], prepend=-1))
        for lo, hi in zip(levels, [*levels[1:], len(left)], strict=True):
            begin = np.flatnonzero(np.diff(of[lo:hi], prepend=-1))
            value[of[lo:hi][begin]] = np.logaddexp.reduceat(w[lo:hi] + value[goal[lo:hi]], begin)
        share = weight + value[reach - base] - value[source - base]
        if chained:
            inner = np.array(chained, np.int64)
            source, to, piece, share = np.concatenate((source, inner[:, 0])), np.concatenate((to, inner[:, 1])), np.concatenate((piece, inner[:, 2])), np.concatenate((share, np.zeros(len(inner))))
            order = np.argsort(source, kind="stable")
            source, to, piece, share = source[order], to[order], piece[order], share[order]
        begin = np.flatnonzero(np.diff(source, prepend=-1))
        many = np.diff(np.append(begin, len(source)))
        odds = np.exp(share)
        total = np.cumsum(odds)
        total -= np.repeat(total[begin] - odds[begin], many)
        total[begin + many - 1] = 2.0
        self.first, self.many = _grown(self.first, base, end), _grown(self.many, base, end)
        self.first[base:end], self.many[base:end] = -1, 0
        self.first[source[begin]], self.many[source[begin]] = self.edges + begin, many
        for name, new in (("total", total), ("share", share), ("to", to), ("piece", piece), ("next", self.first[to])):
            whole = _grown(getattr(self, name), self.edges, self.edges + len(new))
            whole[self.edges : self.edges + len(new)] = new
            setattr(self, name, whole)
        self.nodes, self.edges = end, self.edges + len(source)

    def starts(self, texts: list[str]) -> list[np.ndarray]:
        """First nodes of the units of each normalised text."""
        if self.kinds is None:
            units = [np.array([self.index[u] for u in self.cut.findall(text)], np.int32) for text in texts]
        else:
            units = self._numbered(texts)
        if new := self.index.new:
            self.node = _grown(self.node, len(self.index) - len(new), len(self.index))
            self._build(new, np.arange(len(self.index) - len(new), len(self.index)))
            self.index.new = []
        return [self.node[x] for x in units]

    def _numbered(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the units that cut finds in each text: bounds by kinds of characters, for all texts at once.  A unit of
        at most eight plain characters is looked up by these, as one integer, once for all that are equal; others by text."""
        joined = "".join(texts)
        if not joined:
            return [np.zeros(0, np.int32) for _ in texts]
        text = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), np.uint16)
        if len(text) > len(joined):
            text = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        both = self.kinds[np.minimum(text, 0xFFFF)]
        kind = (both >> 8).astype(np.uint8)
        code = np.zeros((len(text) // 8 + 2) * 8, np.uint8)
        code[: len(text)] = both & 0xFF
        if len(far := np.flatnonzero(text > 0xFFFF)):
            kind[far] = [1 if self.letter.match(joined[i]) else 2 for i in far.tolist()]
        ends = np.cumsum(list(map(len, texts)))
        last, this = kind[:-1], kind[1:]
        opens = np.ones(len(text) + 1, bool)
        opens[1:-1] = (last != this) & (last != 0) | (this == 3)
        opens[ends] = True
        begin = np.flatnonzero(opens)
        size = np.diff(begin)
        begin = begin[:-1]
        words, at, turn = code.view("<u8"), begin >> 3, (begin & 7).astype(np.uint64) << np.uint64(3)
        key = words[at] >> turn | words[at + 1] << np.uint64(1) << (np.uint64(63) - turn)
        key &= _FIRST[np.minimum(size, 8)]
        key[size > 8] = 0
        key[np.searchsorted(begin, np.flatnonzero(code[: len(text)] == 0), "right") - 1] = 0
        number = np.empty(len(begin), np.int32)
        short = np.flatnonzero(key)
        of, keys = pd.factorize(key[short])
        first = np.empty(len(keys), np.int64)
        first[of[::-1]] = short[::-1]
        names = keys.tolist()
        found = list(map(self.packed.get, names))
        for k in [k for k, n in enumerate(found) if n is None]:
            at = int(begin[first[k]])
            found[k] = self.packed[names[k]] = self.index[joined[at : at + int(size[first[k]])]]
        number[short] = np.array(found, np.int32)[of]
        rest = np.flatnonzero(key == 0)
        number[rest] = [self.index[joined[a:b]] for a, b in zip(begin[rest].tolist(), (begin[rest] + size[rest]).tolist(), strict=True)]
        return np.split(number, np.searchsorted(begin, ends[:-1]))

    def spelt(self, ids: np.ndarray) -> bytes:
        """The normalised text of the pieces."""
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """The text of the pieces, the leading space of the encoding taken off."""
        if self.partial[ids].any():
            return shown(self.spelt(ids).decode("utf-8", "surrogatepass"))
        return shown("".join(self.whole[ids].tolist()))

    def walk(self, node: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each node to the end of its unit: the edges of all walks in order, and each walk's length; key: hashes of row and sample."""
        own = _mixed(key, 1, place)
        occ, edge, e = [], [], self.first[node]
        active = np.flatnonzero(e >= 0)
        e, own = e[active], own[active]
        while len(active):
            u = _fraction(_mixed(own, 2, np.full(1, len(occ))))
            more = np.flatnonzero(self.total[e] < u)
            while len(more):
                e[more] += 1
                more = more[self.total[e[more]] < u[more]]
            occ.append(active)
            edge.append(e)
            e = self.next[e]
            live = np.flatnonzero(e >= 0)
            active, e, own = active[live], e[live], own[live]
        length = np.zeros(len(node), np.int64)
        for k, o in enumerate(occ):
            length[o] = k + 1
        begin = np.cumsum(length) - length
        edges = np.empty(length.sum(), np.int32)
        for k, (o, e) in enumerate(zip(occ, edge, strict=True)):
            edges[begin[o] + k] = e
        return edges, length


def lattices(path: str) -> Lattices:
    return held(("sampling", path), lambda: Lattices(path))


class _Path:
    """A sampled path: its edges and their log probabilities, its log bound; of its first places, as far as branches off them can
    matter (DEEPEST), the unit of each, its node, and log probability before it."""

    def __init__(self, edges, share, bound, units, sources, before) -> None:
        self.edges, self.share, self.bound, self.units, self.sources, self.before = edges, share, bound, units, sources, before


def _shallow(share: np.ndarray) -> np.ndarray:
    """Log probability before each of the first places, until it falls to DEEPEST."""
    size = 512
    while True:
        part = share[:size]
        before = np.cumsum(part) - part
        n = int(np.searchsorted(-before, -DEEPEST))
        if n < len(part) or len(part) == len(share):
            return before[:n]
        size *= 4


def _branches(lat: Lattices, paths: list[tuple[int, _Path, int]], keys: np.ndarray, sample: int, keep: int, limits: list[float]) -> dict[int, list[tuple[float, int, int, int]]]:
    """For each text the branches off its path after a place, all that are among the keep best and not above its limit: (log bound, sample,
    place, edge).  Where there is no limit yet, the likely first places give one; elsewhere a branch whose noise alone is above it is passed over."""
    ns = np.array([max(len(path.before) - start, 0) for _, path, start in paths])
    text, order, parent = (np.repeat(np.array(x), ns) for x in ([k for k, _, _ in paths], range(len(paths)), [path.bound for _, path, _ in paths]))
    place = np.concatenate([np.arange(start, start + n) for (_, _, start), n in zip(paths, ns.tolist(), strict=True)])
    before, source = (np.concatenate([getattr(path, x)[start:] for _, path, start in paths]) for x in ("before", "sources"))
    taken = np.concatenate([path.edges[start : len(path.before)] for _, path, start in paths])
    choice = np.flatnonzero(lat.many[source] > 1)
    text, order, parent, place, before, source, taken = (x[choice] for x in (text, order, parent, place, before, source, taken))
    own = _mixed(_mixed(keys[text], 0, np.full(1, 1_000 + sample)), 1, place)  # a hash a place, not one a branch
    first, many, limit = lat.first[source], lat.many[source], np.array(limits)
    out: dict[int, list[tuple[float, int, int, int]]] = {}

    def bounded(row: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        edge = first[row] + offset
        other = edge != taken[row]
        row, edge, offset = row[other], edge[other], offset[other]
        gap = -np.log(_fraction(_mixed(own[row], 2, offset))) / np.exp(lat.share[edge])
        bound = np.logaddexp(parent[row], np.log(gap) - before[row])
        finite = np.isfinite(bound)
        return row[finite], edge[finite], bound[finite]

    def found(row: np.ndarray, edge: np.ndarray, bound: np.ndarray) -> None:
        for k, b, p, e in zip(text[row].tolist(), bound.tolist(), place[row].tolist(), edge.tolist(), strict=True):
            out.setdefault(k, []).append((b, sample, p, e))

    if not len(choice):
        return out
    opening = np.zeros(len(paths))
    begin = np.flatnonzero(np.diff(order, prepend=-1))
    opening[order[begin]] = before[begin]
    near = np.isinf(limit)[order] & (before > opening[order] + LIKELY)
    at = np.flatnonzero(near)
    if len(at):
        n = many[at]
        row, edge, bound = bounded(np.repeat(at, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        best = np.lexsort((bound, order[row]))
        of = order[row[best]]
        begin = np.flatnonzero(np.diff(of, prepend=-1))
        n = np.diff(np.append(begin, len(of)))
        limit[of[begin[n >= keep]]] = bound[best[begin[n >= keep] + keep - 1]]
        best = best[np.arange(len(of)) - np.repeat(begin, n) < keep]
        found(row[best], edge[best], bound[best])
    least = np.exp(-np.exp(np.minimum(limit[order] + before, 700.0))) - 1e-12  # of the noise; less by more than its rounding
    at, rows, offsets, k = np.flatnonzero(~near), [], [], 0
    while len(at):
        rows.append(at[_fraction(_mixed(own[at], 2, np.full(1, k))) >= least[at]])
        offsets.append(np.full(len(rows[-1]), k))
        k += 1
        at = at[many[at] > k]
    if rows:
        found(*bounded(np.concatenate(rows), np.concatenate(offsets)))
    return out


def sample_paths(lat: Lattices, starts: list[np.ndarray], keys: np.ndarray, samples: int) -> list[tuple[list[_Path], float]]:
    """For each text its sampled paths, best first, and the log bound of the next one (inf if there is none)."""
    done: list[list[_Path]] = [[] for _ in starts]
    queue: list[list[tuple[float, int, int, int]]] = [[] for _ in starts]
    begins = np.log(-np.log(_uniform(keys, np.full(1, 999)))).tolist()
    live = list(range(len(starts)))
    for s in range(samples):
        nodes, firsts, spans = [], [], []
        for k in live:
            if s == 0:
                nodes.append(starts[k])
                firsts.append(0)
                spans.append((None, 0, begins[k], None))
            else:
                bound, of, place, edge = queue[k].pop(0)
                path = done[k][of]
                unit = int(path.units[place])
                nodes.append(np.concatenate((lat.to[edge : edge + 1], starts[k][unit + 1 :])))
                firsts.append(unit)
                spans.append((path, place, bound, edge))
        if not live:
            break
        sizes = np.array([len(x) for x in nodes])
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) + np.repeat(np.array(firsts) - (ends - sizes), sizes)
        opening = np.concatenate(nodes)
        edges, length = lat.walk(opening, np.repeat(_mixed(keys[live], 0, np.full(1, s)), sizes), place)
        share, units, sources = lat.share[edges], np.repeat(place.astype(np.int32), length), np.empty(len(edges), np.int32)
        sources[1:] = lat.to[edges[:-1]]
        sources[(np.cumsum(length) - length)[length > 0]] = opening[length > 0]
        cuts = np.append(0, np.cumsum(length))[np.append(0, ends)].tolist()
        found = []
        for k, lo, hi, (path, place, bound, edge) in zip(live, cuts[:-1], cuts[1:], spans, strict=True):
            e, odds = edges[lo:hi], share[lo:hi]
            if path is not None:
                e = np.concatenate((path.edges[:place], np.array([edge], np.int32), e))
                odds = np.concatenate((path.share[:place], lat.share[edge : edge + 1], odds))
            before = _shallow(odds)
            start = 0 if path is None else place + 1
            new = lo + max(len(before) - start, 0)
            unit, source = units[lo:new], sources[lo:new]
            if path is not None:
                unit = np.concatenate((path.units[: place + 1], unit))
                source = np.concatenate((path.sources[: place + 1], source))
            done[k].append(_Path(e, odds, bound, unit, source, before))
            found.append((k, done[k][-1], start))
        keep = samples - s
        limits = [queue[k][keep - 1][0] if len(queue[k]) >= keep else np.inf for k in live]
        for k, more in _branches(lat, found, keys, s, keep, limits).items():
            queue[k] = sorted(queue[k] + more)[: samples - s]
        live = [k for k in live if queue[k]]
    return [(done[k], queue[k][0][0] if queue[k] else np.inf) for k in range(len(starts))]


def _encoded(model: str, samples: int, ids: bool):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lat = lattices(model)
        for batch in batches:
            docs, texts, at = batch["doc_id"].tolist(), batch["text"].tolist(), 0
            while at < len(docs):
                if len(lat.index) > KEPT_UNITS:
                    lat.clear()
                lo, size, plain = at, 0, []
                while at < len(docs) and (not plain or size < CHUNK):
                    plain.append(lat.model.normalize(texts[at]) if texts[at] else "")
                    size += len(plain[-1])
                    at += 1
                starts = lat.starts(plain)
                keys = np.array([0 if pd.isna(d) else int(d) & (1 << 64) - 1 for d in docs[lo:at]], np.uint64) * _C[0]
                rows, owners = [], []
                for doc, text, (paths, next_bound) in zip(docs[lo:at], plain, sample_paths(lat, starts, keys, samples), strict=True):
                    wanted = shown(text)
                    for rank, path in enumerate(paths, 1):
                        found = lat.piece[path.edges]
                        value = float(path.share.sum())
                        row = (rank, len(found), zlib.crc32(found.astype("<u4").tobytes()), value, -float(path.bound), float(-np.expm1(-np.exp(value + next_bound))) if next_bound < 700 - value else 1.0, lat.decode(found) == wanted)
                        rows.append((*row, found) if ids else row)
                        owners.append(doc)
                names = [x.split()[0] for x in SAMPLE.split(", ")][1:]
                out = pd.DataFrame(rows, columns=[*names, "ids"] if ids else names)
                out.insert(0, "doc_id", pd.array(owners, "Int64"))
                yield out

    return encode


def _in_arrow(encode, ids: bool):
    """encode over Arrow batches: its arrays of ids go over whole, not a number at a time as lists, and a null doc_id leaves the others whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
        schema = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, SAMPLE.split(", "))] + ([("ids", pa.list_(pa.int32()))] if ids else []))
        for out in encode(x.to_pandas(integer_object_nulls=True) for x in batches):
            yield pa.RecordBatch.from_pandas(out, schema, preserve_index=False)

    return run


def sample(docs: DataFrame, model: str, samples: int = SAMPLES, ids: bool = True) -> DataFrame:
    """One row per text and sample, best first; ids: also the piece ids.  decoded: whether decode gives the normalised text back."""
    own = text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(lean(_in_arrow(_encoded(model, samples, ids), ids), ("sampling", model)), SAMPLE + (", ids array<int>" if ids else ""))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """encoded (with ids) and the text that the ids spell."""

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        lat = lattices(model)
        return pd.Series([None if x is None else lat.decode(np.asarray(x)) for x in ids], dtype=object)

    return encoded.withColumn("text", text("ids"))
