"""Sampled SentencePiece segmentations without replacement: Gumbel top-k by A* search over the piece lattice.

A text's lattice has a node for each character position and an edge for each piece of the vocabulary (bytes where
a character has no piece). Summing over all completions turns edge scores into conditional probabilities. Giving
every segmentation log-probability plus Gumbel noise and taking the k largest samples k distinct ones without
replacement. The search never lists them: the largest value below a node is drawn first (for the root a plain
Gumbel), the path that holds it is drawn by the conditional probabilities, and at each node on it the other edges
form one open set whose largest value is a Gumbel cut off at the path's. The best open set is taken next, one of its
edges is drawn, and so on, so the paths come out from the largest value down.

Pieces never cross a word's beginning, so a text's words are independent and all words of a batch take a step at
once in numpy. Random numbers are hashes of row key, sample and place, so a row's samples depend on nothing else.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventloom.llm.common import table

SAMPLES, SEED = 3, 42
SPACE = "▁"
TAIL = ".,!?;:\n"
BATCH_DOCS, BATCH_CHARS = 192, 1 << 21  # texts that are worked on at once: larger batches repeat fewer words, but leave the processor's caches
LOW = 1024  # characters below it are looked up in a square table
_MIX, _ONE = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64, a public mixing function."""
    x = x + _ONE
    for shift, factor in zip((30, 27), _MIX):
        x ^= x >> np.uint64(shift)
        x *= factor
    x ^= x >> np.uint64(31)
    return x


def _streams(keys: np.ndarray, stream: int) -> np.ndarray:
    """A key for each row and stream of random numbers."""
    return _mixed(keys ^ _mixed(np.full(1, stream, np.uint64)))


def _uniform(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """In (0, 1), by key and place."""
    u = (_mixed(keys + places.astype(np.uint64, copy=False)) >> np.uint64(12)).astype(np.float64)
    u += 0.5
    u /= 2.0**52
    return u


class Vocabulary:
    """Pieces and their log scores.

    ``scores``: "zipf" gives a piece -log(2 + rank), for models whose scores are ranks; "model" takes the model's."""

    def __init__(self, path: str, scores: str = "zipf", temperature: float = 1.0):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unchanged = _keeps_text(path)
        count = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(count)]
        plain = [i for i in range(count) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i))]
        rank = {i: r for r, i in enumerate(sorted(plain, key=lambda i: (-self.model.get_score(i), i)))}
        score = (lambda i: -math.log(2 + rank[i])) if scores == "zipf" else self.model.get_score
        self.scores = np.array([score(i) / temperature if i in rank else 0.0 for i in range(count)])
        self.spelled = float(min(self.scores, default=0.0)) - 1.0  # of a character in bytes
        # Products over so many characters stay far from the least and largest doubles.
        self.depth = int(600 / max(1e-9, abs(self.spelled), *np.abs(self.scores[plain])))
        self.bytes = np.full(256, self.model.unk_id())
        for i in range(count):
            if self.model.is_byte(i):
                self.bytes[int(names[i][1:-1], 16)] = i
        self.decoded = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        # By length: sorted hashes of all beginnings of pieces, and the piece with that hash (-1: a beginning only).
        known = {names[i]: i for i in plain}
        starts: dict[int, dict[str, int]] = {}
        for p in known:
            for n in range(1, len(p) + 1):
                starts.setdefault(n, {})[p[:n]] = known.get(p[:n], -1)
        self.tables = []
        for n in sorted(starts):
            marks = np.zeros(len(starts[n]), np.uint64)
            codes = np.array([[ord(c) for c in p] for p in starts[n]], np.uint64)
            for i in range(n):
                marks = _rolled(marks, codes[:, i])
            order = np.argsort(marks)
            if (np.diff(marks[order]) == 0).any():
                raise ValueError("two beginnings of pieces have one hash")
            self.tables.append(_Table(marks[order], np.fromiter(starts[n].values(), np.int64)[order]))
        self.neighbours = np.array(sorted({ord(a) << 21 | ord(b) for p in known for a, b in zip(p, p[1:])}), np.int64)
        self.close = np.zeros((LOW, LOW), bool)  # the same for characters below LOW
        first, second = self.neighbours >> 21, self.neighbours & (1 << 21) - 1
        low = (first < LOW) & (second < LOW)
        self.close[first[low], second[low]] = True

        # Where pieces never cross: before a space, and before marks that no piece has after a letter or digit.
        crossed = {b for p in known for a, b in zip(p, p[1:]) if b in TAIL and re.match(r"\w", a)}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in known):
            raise ValueError("pieces of this model span words")
        tail = "".join(c for c in TAIL if c not in crossed)
        first = f"{SPACE}*\\w+(?=[{re.escape(tail)}])|" if tail else ""
        self.split = re.compile(f"{first}{SPACE}*[^{SPACE}]+|{SPACE}+")

    def adjacent(self, codes: np.ndarray) -> np.ndarray:
        """Whether each character and the next are neighbours in some piece."""
        first, second = codes[:-1], codes[1:]
        out = self.close[np.minimum(first, LOW - 1), np.minimum(second, LOW - 1)]
        high = np.flatnonzero((first >= LOW - 1) | (second >= LOW - 1))
        out[high] = _isin(first[high] << 21 | second[high], self.neighbours)
        return out

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        return self.split.findall(SPACE + text.replace(" ", SPACE) if self.unchanged else self.model.normalize(text))

    def spell(self, found: list[np.ndarray], texts: list[bytes]) -> list[bool]:
        """Whether each sequence of ids decodes to its text (UTF-8)."""
        if not found:
            return []
        data = pa.array(self.decoded, pa.large_binary()).take(pa.array(np.concatenate(found)))
        stops = np.frombuffer(data.buffers()[1], np.int64)[np.cumsum([0, *map(len, found)])].tolist()
        whole = data.buffers()[2].to_pybytes() if len(data) else b""
        return [whole[a + (whole[a : a + 1] == b" " and a < b) : b] == text for a, b, text in zip(stops, stops[1:], texts)]

    def text(self, ids) -> str:
        """The text of a sequence of ids, without the space that encoding puts first."""
        data = b"".join(map(self.decoded.__getitem__, ids))
        return data.decode("utf-8", "replace")[1 if data[:1] == b" " else 0 :]


def _keeps_text(path: str) -> bool:
    """Whether the model's normalisation only puts a space first and writes spaces as SPACE."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    n = model.normalizer_spec
    return n.name == "identity" and not n.precompiled_charsmap and n.add_dummy_prefix and n.escape_whitespaces and not (n.remove_extra_whitespaces or model.trainer_spec.treat_whitespace_as_suffix)


class _Table:
    """Sorted hashes with the piece of each; the leading bits of a hash tell where to start looking."""

    def __init__(self, marks: np.ndarray, ids: np.ndarray):
        bits = len(marks).bit_length() + 1
        self.marks, self.ids, self.shift = np.append(marks, np.uint64(2**64 - 1)), ids, np.uint64(64 - bits)
        self.starts = np.searchsorted(marks, np.arange(1 << bits, dtype=np.uint64) << self.shift)

    def find(self, marks: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 where it is not in the table."""
        place = self.starts[marks >> self.shift]
        on = np.flatnonzero(self.marks[place] < marks)
        while len(on):
            place[on] += 1
            on = on[self.marks[place[on]] < marks[on]]
        place[(self.marks[place] != marks) | (place == len(self.ids))] = -1
        return place


@lru_cache(maxsize=1)
def vocabulary_of(path: str, scores: str, temperature: float) -> Vocabulary:
    """A worker keeps its vocabulary from task to task."""
    return Vocabulary(path, scores, temperature)


def _rolled(marks: np.ndarray, codes: np.ndarray) -> np.ndarray:
    out = marks + codes
    out += np.uint64(1)
    out *= _MIX[0]
    return out


def _isin(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


class Lattices:
    """The lattices of some distinct words in flat arrays: a node per character, and one before each further byte of
    a spelled character. A word's first node is in ``first``. A node's edges lie together, and ``cumulated`` holds node
    number + cumulated probability (no bound at a node's last edge), so edges are drawn for many nodes at once."""

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        v = vocabulary
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.cumsum(lengths) - lengths
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        n = len(codes)
        end = np.repeat(np.cumsum(lengths), lengths)  # of the word
        begin, to, piece = self._edges(v, codes, end)
        single = np.zeros(n, bool)
        single[begin[to - begin == 1]] = True
        odd = np.flatnonzero(~single)
        score = v.scores[piece] if len(piece) else np.zeros(0)
        # Edges that spell a character count as one until probabilities are known.
        begin, to, piece = np.concatenate([begin, odd]), np.concatenate([to, odd + 1]), np.concatenate([piece, np.full(len(odd), -1)])
        score = np.concatenate([score, np.full(len(odd), v.spelled)])
        order = np.argsort(begin, kind="stable")
        begin, to, piece, score = begin[order], to[order], piece[order], score[order]
        log = self._conditional(v, codes, end, begin, to, score)
        to = np.where(to == end[begin], -1, to) if n else to
        place = (np.arange(n) - (end - np.repeat(lengths, lengths))) * 4
        begin, to, piece, log, place = self._spelled(v, codes, begin, to, piece, log, place)
        self.to, self.piece, self.log, self.place = to, piece, log, np.asarray(place, np.int64).view(np.uint64)
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(begin, minlength=len(place)))]).astype(np.int64)
        total = np.concatenate([[0.0], np.cumsum(np.exp(self.log))])
        self.cumulated = np.minimum(total[1:] - total[self.begin[begin]], 1.0) + begin
        if n:
            self.cumulated[self.begin[1:] - 1] = np.inf

    @staticmethod
    def _edges(v: Vocabulary, codes: np.ndarray, end: np.ndarray):
        """From and to node and id of each piece found: all beginnings grow by a character at a time."""
        at, marks, found = np.arange(len(codes)), np.zeros(len(codes), np.uint64), []
        for n, table in enumerate(v.tables, 1):
            inside = at + n <= end[at]
            at, marks = at[inside], marks[inside]
            if not len(at):
                break
            marks = _rolled(marks, codes.view(np.uint64)[at + n - 1])
            place = table.find(marks)
            alive = place >= 0
            at, marks, own = at[alive], marks[alive], table.ids[place[alive]]
            whole = own >= 0
            found.append((at[whole], at[whole] + n, own[whole]))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*reversed(found)))  # long pieces are the likelier ones

    @staticmethod
    def _conditional(v: Vocabulary, codes, end, begin, to, score) -> np.ndarray:
        """Log of each edge's probability given its node. No piece spans two characters that are neighbours in no piece,
        so sums over completions start anew there; nodes equally far from such a cut are summed at once: as plain
        numbers near the cut, as logs further off."""
        n = len(codes)
        if not n:
            return np.zeros(0)
        cut = np.ones(n + 1, bool)  # before this character
        cut[1:n] = (end[:-1] == np.arange(1, n)) | ~v.adjacent(codes)
        cuts = np.flatnonzero(cut)
        to_cut = cuts[np.cumsum(cut[:n])] - np.arange(n)
        level = to_cut[begin]
        order = np.argsort(level.astype(np.int16) if len(level) and level.max() < 1 << 15 else level, kind="stable")
        ordered, sizes = begin[order], np.bincount(level)
        stops, log = np.cumsum(sizes), np.empty(len(begin))
        near = int(stops[min(v.depth, len(stops) - 1)])
        weight, share = np.exp(score[order[:near]]), np.empty(near)
        after = np.ones(n + 1)  # one at a cut

        def level_of(size: int, stop: int):
            own, node = order[stop - size : stop], ordered[stop - size : stop]
            heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            return slice(stop - size, stop), own, node[heads], heads, np.diff(np.append(heads, size))

        levels = [x for x in zip(sizes.tolist(), stops.tolist()) if x[0]]
        for size, stop in levels:
            if stop > near:
                break
            at, own, node, heads, count = level_of(size, stop)
            value = weight[at]
            value *= after[to[own]]
            sums = np.add.reduceat(value, heads)
            after[node] = np.where(cut[node], 1.0, sums)
            np.divide(value, np.repeat(sums, count), out=share[at])
        log[order[:near]] = np.log(share, out=share)
        after = np.log(after)
        for size, stop in levels:
            if stop <= near:
                continue
            _, own, node, heads, count = level_of(size, stop)
            value = score[own] + after[to[own]]
            top = np.maximum.reduceat(value, heads)
            sums = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, count)), heads))
            after[node] = np.where(cut[node], 0.0, sums)
            log[own] = np.minimum(value - np.repeat(sums, count), 0.0)
        return log

    @staticmethod
    def _spelled(v: Vocabulary, codes, begin, to, piece, log, place):
        """Replaces the edges that spell a character by one edge for each byte."""
        odd = np.flatnonzero(piece < 0)
        if not len(odd):
            return begin, to, piece, log, place
        extra, nodes = [], len(place)
        to, piece, more_places = to.copy(), piece.copy(), []
        for e in odd.tolist():
            spelled = v.bytes[list(chr(codes[begin[e]]).encode("utf-8", "surrogatepass"))].tolist()
            piece[e], last = spelled[0], to[e]
            for k, b in enumerate(spelled[1:], 1):
                if k == 1:
                    to[e] = nodes
                more_places.append(place[begin[e]] + k)
                extra.append((nodes, last if k + 1 == len(spelled) else nodes + 1, b))
                nodes += 1
        if extra:
            a, b, c = (np.array(x, np.int64) for x in zip(*extra))
            begin, to, piece = np.concatenate([begin, a]), np.concatenate([to, b]), np.concatenate([piece, c])
            log, place = np.concatenate([log, np.zeros(len(a))]), np.concatenate([place, more_places])
        return begin, to, piece, log, place

    def _drawn(self, nodes: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first edge of each node whose cumulated value passes ``goal``; nodes have few edges, so they are tried in turn."""
        edge = self.begin[nodes]
        on = np.flatnonzero(self.cumulated[edge] <= goal)
        at, goal = edge[on], goal[on]
        while len(on):
            at += 1
            more = self.cumulated[at] <= goal
            found = ~more
            edge[on[found]] = at[found]
            on, at, goal = on[more], at[more], goal[more]
        return edge

    def walk(self, nodes: np.ndarray, keys: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From each start node to the word's end: (start's index, node, edge) in path order. ``words`` numbers the
        words within a text and tells equal words' random numbers apart."""
        index, parts, steps = np.arange(len(nodes)), [], np.zeros(len(nodes), np.int64)
        seeds = _mixed(keys + words.astype(np.uint64))
        while len(index):
            edge = self._drawn(nodes, nodes + _uniform(seeds, self.place[nodes]))
            parts.append((index, nodes, edge))
            steps[index] = len(parts)
            to = self.to[edge]
            on = np.flatnonzero(to >= 0)
            index, nodes, seeds = index[on], to[on], seeds[on]
        starts = np.cumsum(steps) - steps
        node, edge = np.empty((2, int(steps.sum())), np.int64)
        for step, (index, nodes, edges) in enumerate(parts):
            at = starts[index] + step
            node[at], edge[at] = nodes, edges
        return np.repeat(np.arange(len(steps)), steps), node, edge


def _cut_off(location: np.ndarray, bound, u: np.ndarray) -> np.ndarray:
    """Gumbels at ``location``, conditioned to lie below ``bound``; -inf where the set is empty."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = location - np.logaddexp(location - bound, np.log(-np.log(u)))
    return np.where(np.isneginf(location), -np.inf, out)


def _rest(log: np.ndarray) -> np.ndarray:
    """log(1 - exp(log)), -inf where nothing is left."""
    with np.errstate(divide="ignore"):
        return np.where(log > -1e-12, -np.inf, np.log(-np.expm1(np.minimum(log, -1e-12))))


class _Path:
    """A drawn segmentation: word number, node and edge of each step, and the open sets beside it from step ``split``
    on, ``top`` being the largest; those before belong to the path that it left. ``log`` is the log-probability of the steps before."""

    __slots__ = ("word", "node", "edge", "value", "open", "top", "taken", "split", "log")

    def __init__(self, word, node, edge, value, split, taken, log):
        self.word, self.node, self.edge, self.value, self.split, self.taken, self.log = word, node, edge, value, split, taken, log


def sample(vocabulary: Vocabulary, texts: list[list[str]], keys: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to k distinct segmentations: ids, log-probability, perturbed value, log of the inclusion
    probability given the value that was left out first."""
    words = pa.array(list(chain.from_iterable(texts)), pa.string()).dictionary_encode()
    lattices = Lattices(vocabulary, words.dictionary.to_numpy(zero_copy_only=False).tolist())
    count = np.array([len(w) for w in texts], np.int64)
    starts = lattices.first[words.indices.to_numpy()]
    offset = np.concatenate([[0], np.cumsum(count)])
    number = np.arange(len(starts)) - np.repeat(offset[:-1], count)
    value = -np.log(-np.log(_uniform(_streams(keys, 0), np.zeros(len(keys)))))
    found: list[list[_Path]] = [[] for _ in texts]

    def opened(paths: list[_Path], owners: np.ndarray, stream: int) -> None:
        """Draws the largest value of each open set beside the paths, for all paths at once."""
        sizes = np.array([len(p.edge) - p.split for p in paths], np.int64)
        stops = np.cumsum(sizes)
        edge, node, word = (np.concatenate([getattr(p, x)[p.split :] for p in paths]) for x in ("edge", "node", "word"))
        log = lattices.log[edge]
        total = np.concatenate([[0.0], np.cumsum(log)])
        before = total[:-1] + np.repeat([p.log for p in paths] - total[stops - sizes], sizes)
        location = before + _rest(log)
        for p, start in zip(paths, (stops - sizes).tolist()):
            if p.taken:
                left = 1.0 - float(np.exp(lattices.log[list(p.taken)]).sum())
                at = p.node[p.split]
                more = lattices.begin[at + 1] - lattices.begin[at] > len(p.taken)
                location[start] = p.log + math.log(left) if left > 1e-12 and more else -np.inf
        u = _uniform(_mixed(np.repeat(_streams(owners, stream), sizes) + word.astype(np.uint64)), lattices.place[node])
        values = _cut_off(location, np.repeat([p.value for p in paths], sizes), u)
        for p, start, stop in zip(paths, (stops - sizes).tolist(), stops.tolist()):
            p.open = values[start:stop]
            p.top = float(p.open.max(initial=-np.inf))

    index, node, edge = lattices.walk(starts, np.repeat(_streams(keys, 1), count), number)
    bounds = np.searchsorted(index, offset)
    for d in range(len(texts)):
        at = slice(bounds[d], bounds[d + 1])
        found[d].append(_Path(number[index[at]], node[at], edge[at], value[d], 0, (), 0.0))
    if texts:
        opened([paths[0] for paths in found], keys, 2)
    for s in range(1, k):
        taken = []
        for d, paths in enumerate(found):
            if len(paths) < s or not count[d]:
                continue
            best = max(paths, key=lambda p: p.top)
            if np.isneginf(best.top):
                continue
            t, top = int(best.open.argmax()), best.top
            best.open[t] = -np.inf
            best.top = float(best.open.max())
            taken.append((d, best, t, top))
        if not taken:
            break
        chosen, nodes, words, heads = [x[0] for x in taken], [], [], []
        draws = _uniform(_streams(keys[chosen], 3 * s), np.array([best.split + t for _, best, t, _ in taken]))
        for (d, best, t, top), u in zip(taken, draws.tolist()):
            used = best.taken if t == 0 and best.taken else (int(best.edge[best.split + t]),)
            before = best.log + float(lattices.log[best.edge[best.split : best.split + t]].sum())
            t += best.split
            at = best.node[t]
            free = np.array([e for e in range(lattices.begin[at], lattices.begin[at + 1]) if e not in used])
            weight = np.cumsum(np.exp(lattices.log[free]))
            e = int(free[min(np.searchsorted(weight, u * weight[-1], side="right"), len(free) - 1)])
            word = int(best.word[t])
            go = ([lattices.to[e]] if lattices.to[e] >= 0 else [])
            rest = starts[offset[d] + word + 1 : offset[d + 1]]
            nodes.append(np.concatenate([go, rest]).astype(np.int64))
            words.append(np.concatenate([[word] * len(go), np.arange(word + 1, count[d])]).astype(np.int64))
            heads.append((best, t, e, top, (*used, e), before))
        sizes, place = np.array([len(n) for n in nodes]), np.concatenate(words)
        index, node, edge = lattices.walk(np.concatenate(nodes), np.repeat(_streams(keys[chosen], 3 * s + 1), sizes), place)
        bounds = np.searchsorted(index, np.concatenate([[0], np.cumsum(sizes)]))
        for i, (d, (best, t, e, top, taken, before)) in enumerate(zip(chosen, heads)):
            at = slice(bounds[i], bounds[i + 1])
            path = _Path(
                np.concatenate([best.word[: t + 1], place[index[at]]]), np.concatenate([best.node[: t + 1], node[at]]),
                np.concatenate([best.edge[:t], [e], edge[at]]), top, t, taken, before,
            )
            found[d].append(path)
        opened([found[d][s] for d in chosen], keys[chosen], 3 * s + 2)
    out = []
    for d, paths in enumerate(found):
        left_out = max((p.top for p in paths), default=-np.inf)
        rows = []
        for p in paths:
            log = float(lattices.log[p.edge].sum())
            x = log - left_out
            inclusion = 0.0 if x > 700 else x if x < -30 else math.log(-math.expm1(-math.exp(x)))
            rows.append((lattices.piece[p.edge].astype("<u4"), log, float(p.value), inclusion))
        out.append(rows)
    return out


RESULT = "doc_id long, sample int, ids binary, pieces long, log_prob double, perturbed double, log_inclusion double, round_trip boolean"


def encode_samples(docs: DataFrame, path: str, k: int = SAMPLES, seed: int = SEED, scores: str = "zipf", temperature: float = 1.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sampled segmentation: doc_id, sample (from 0, by falling perturbed value), ids (uint32 bytes),
    pieces, log_prob, perturbed, log_inclusion, round_trip (whether the ids decode to the text).

    A row's samples are distinct and depend on its id and ``seed`` only, so repeated rows get the same ones. Texts
    with fewer segmentations have all of them, with inclusion 1. Null and empty texts have one, the empty one. Texts
    are encoded whole; a null id is a key of its own. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path, scores, temperature)
        schema = pa.schema([("doc_id", pa.int64()), ("sample", pa.int32()), ("ids", pa.binary()), ("pieces", pa.int64()), ("log_prob", pa.float64()), ("perturbed", pa.float64()), ("log_inclusion", pa.float64()), ("round_trip", pa.bool_())])

        def flush(ids: list, whole: list, texts: list, keys: list) -> pa.RecordBatch:
            columns: list[list] = [[] for _ in schema]
            found = sample(vocabulary, texts, np.array(keys, np.int64).view(np.uint64), k)
            for doc_id, rows in zip(ids, found):
                for s, (pieces, log, value, inclusion) in enumerate(rows):
                    for column, x in zip(columns, (doc_id, s, pieces.tobytes(), len(pieces), log, value, inclusion)):
                        column.append(x)
            own = [text for text, rows in zip((x.encode("utf-8", "surrogatepass") for x in whole), found) for _ in rows]
            columns[-1] = vocabulary.spell([x[0] for rows in found for x in rows], own)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            ids, whole, texts, keys, size = [], [], [], [], 0
            for doc_id, text, key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py() or ""
                ids.append(doc_id)
                whole.append(text)
                texts.append(vocabulary.chunks(text))
                keys.append(key)
                size += len(text)
                if len(ids) >= BATCH_DOCS or size > BATCH_CHARS:
                    yield flush(ids, whole, texts, keys)
                    ids, whole, texts, keys, size = [], [], [], [], 0
            if ids:
                yield flush(ids, whole, texts, keys)

    doc_id = F.col(id_col).cast("long")
    chosen = docs.select(doc_id.alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(doc_id, F.lit(seed)).alias("key"))
    return chosen.mapInArrow(run, RESULT)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids (uint32 bytes) in column ``into``, which must be new; null ids give null."""
    if into in rows.columns:
        raise ValueError(f"column {into} is there already")
    at, names = rows.columns.index(ids_col), [*rows.columns, into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path, "zipf", 1.0)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [None if x is None else vocabulary.text(np.frombuffer(x, "<u4").tolist()) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names)

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(into, StringType())]))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_gumbel_pieces(spark, sf_dir: str) -> DataFrame:
    sampled = encode_samples(table(spark, sf_dir, "documents"), model_path())
    rounded = [F.round(c, 6).alias(c) for c in ("log_prob", "perturbed", "log_inclusion")]
    return sampled.select("doc_id", "sample", "pieces", F.crc32("ids").alias("ids_crc32"), *rounded, "round_trip")
