"""SentencePiece encoding by sampling without replacement, and decoding.

All ways to cut a text into pieces form a lattice.  Pieces never cross the start of a word, so the lattice of a text is
a chain of the lattices of its words; forward sums over each distinct word give the exact chance of every arc.  A
segmentation is a path of arc choices, and the paths form a tree whose root is the whole text.

Sampling is a best-first (A*) search in this tree with perturbed scores.  The root gets a Gumbel value.  The best path
in a region is an exact sample of it; the other choices along the path cut the rest of the region into smaller ones, one
per arc choice, and each of these gets a Gumbel value with its own log mass, cut off at the value of the region it comes
from.  The next region is always the one with the greatest value.  So the k emitted paths are distinct and are an exact
sample without replacement.  With the value of the best region that was not opened as threshold, each path's inclusion
score is ``log(1 - exp(-exp(log_prob - threshold)))``, the log of its chance to be among the emitted.

Random numbers are a hash of the row's key, the place in the text and the number of the path: a repeated task, another
partitioning or another batch gives the same segmentations, and the same scores up to rounding.

The vocabulary has merge ranks, not probabilities.  A piece of rank r gets the Zipf weight 1 / (r + 1), a byte piece the
weight of the last rank.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 3
SEED = 7
CHUNK = 1_000_000  # bytes of text segmented together
MARK, OWN_MARK = "▁", "\ud800"  # space in pieces; stands for a text's own U+2581, which is spelt in bytes
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
# Regions below this log mass get a value only if it can matter: none exceeds its mass by more than MOST.
FLOOR = -60.0
MOST = 37.0  # of a Gumbel value from a number of 52 bits
CODE_BITS = 21
NO_CODE = (1 << CODE_BITS) - 1  # follows the end of a word
SLOT_BITS = 18  # of the hash table of trie edges
SPREAD = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "rank int, pieces array<int>, log_prob double, perturbed double, log_inclusion double"


class Vocabulary(NamedTuple):
    """Pieces as a trie over code points: a hash table of edges ``node << 21 | code point``, their ends, pieces of nodes."""

    edges: np.ndarray  # -1: no edge in the slot
    ends: np.ndarray
    piece_at: np.ndarray
    inner: np.ndarray  # nodes that edges leave
    log_prob: np.ndarray
    byte_ids: np.ndarray
    byte_log_prob: float
    spelling: list[bytes]
    longest: int


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _followed(vocab: Vocabulary, keys: np.ndarray) -> np.ndarray:
    """The slot of each edge, or -1 where the trie has none.  Colliding edges stand in the next free slots."""
    slot = _slots(keys)
    held = vocab.edges[slot]
    off = np.flatnonzero((held != keys) & (held >= 0))
    while len(off):
        slot[off] = (slot[off] + 1) % len(vocab.edges)
        held[off] = vocab.edges[slot[off]]
        off = off[(held[off] != keys[off]) & (held[off] >= 0)]
    return np.where(held == keys, slot, -1)


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    """The vocabulary of a serialized model whose pieces start words but never cross into the next."""
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = held.get_piece_size()
    texts = [held.id_to_piece(i) for i in range(size)]
    plain = [i for i in range(size)
             if not (held.is_byte(i) or held.is_control(i) or held.is_unknown(i) or held.is_unused(i))]
    if any(not re.fullmatch(f"{MARK}*[^{MARK}]*", texts[i]) for i in plain):
        raise ValueError("a piece crosses the start of a word")
    byte_ids = np.full(256, -1, dtype=np.int64)
    for i in range(size):
        if held.is_byte(i):
            byte_ids[int(texts[i][3:5], 16)] = i
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces")
    rank = np.array([-held.get_score(i) for i in plain])
    total = np.log((1 / (rank + 1)).sum() + 256 / (rank.max() + 2))
    log_prob = np.full(size, -np.inf)
    log_prob[plain] = -np.log(rank + 1) - total
    tree: dict[int, int] = {}
    piece_of = {}
    for i in plain:
        node = 0
        for char in texts[i]:
            node = tree.setdefault(node << CODE_BITS | ord(char), len(tree) + 1)
        piece_of[node] = i
    edges, ends = np.full(1 << SLOT_BITS, -1, dtype=np.int64), np.zeros(1 << SLOT_BITS, dtype=np.int64)
    if 2 * len(tree) > len(edges):
        raise ValueError("too many pieces")
    for key, slot in zip(tree, _slots(np.array(list(tree), dtype=np.int64)).tolist()):
        while edges[slot] >= 0:
            slot = (slot + 1) % len(edges)
        edges[slot], ends[slot] = key, tree[key]
    piece_at = np.full(len(tree) + 1, -1, dtype=np.int64)
    piece_at[list(piece_of)] = list(piece_of.values())
    spelling = [texts[i].replace(MARK, " ").encode() if log_prob[i] > -np.inf else b"" for i in range(size)]
    for value, i in enumerate(byte_ids):
        spelling[i] = bytes([value])
    inner = np.zeros(len(piece_at), dtype=bool)
    inner[edges[edges >= 0] >> CODE_BITS] = True
    return Vocabulary(edges, ends, piece_at, inner, log_prob, byte_ids,
                      float(-np.log(rank.max() + 2) - total), spelling, max(len(texts[i]) for i in plain))


class Lattice(NamedTuple):
    """Arcs of all distinct words, those with the same end together; ``chosen`` sums up their chances to be the one.

    Nodes go by depth and then by word, longer words first, so the first nodes are the starts of all words.
    """

    start: np.ndarray
    only: np.ndarray  # no other arc ends where it ends
    piece: np.ndarray  # -1: the bytes of one code point
    log_choice: np.ndarray  # of the arc among those that end where it ends
    chosen: np.ndarray
    first: np.ndarray  # per node
    last: np.ndarray
    code: np.ndarray  # the code point that follows
    word_end: np.ndarray  # node of each word


def _utf32(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)


def _bytes_of(code: int) -> bytes:
    return MARK.encode() if code == ord(OWN_MARK) else chr(code).encode("utf-8", "surrogatepass")


def _shares(start, weight, first, sizes, cuts) -> np.ndarray | None:
    """Chance of each arc among those with its end, by forward sums; None where they leave the range of numbers.

    All words go together, one depth after another.
    """
    forward, share = np.ones(cuts[-1]), np.empty(len(start))
    for low, high in zip(cuts[1:-1].tolist(), cuts[2:].tolist()):
        a, b = first[low], first[high - 1] + sizes[high - 1]
        value = forward[start[a:b]] * weight[a:b]
        total = np.add.reduceat(value, first[low:high] - a)
        if total.min() < 1e-280:
            return None
        forward[low:high] = total
        share[a:b] = value / np.repeat(total, sizes[low:high])
    return share


def _shares_of_logs(start, score, first, sizes, cuts) -> np.ndarray:
    """The same from logarithms, for long words."""
    forward, share = np.zeros(cuts[-1]), np.empty(len(start))
    for low, high in zip(cuts[1:-1].tolist(), cuts[2:].tolist()):
        a, b = first[low], first[high - 1] + sizes[high - 1]
        value = forward[start[a:b]] + score[a:b]
        top = np.maximum.reduceat(value, first[low:high] - a)
        weight = np.exp(value - np.repeat(top, sizes[low:high]))
        total = np.add.reduceat(weight, first[low:high] - a)
        forward[low:high] = top + np.log(total)
        share[a:b] = weight / np.repeat(total, sizes[low:high])
    return share


def _nodes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The code point after each node, the way to the next node of its word, where each depth begins, each word's end."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes, offset = _utf32("".join(words)), np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    alive = np.cumsum(np.bincount(lengths)[::-1])[::-1]  # words with a node at each depth
    cuts = np.concatenate([[0], np.cumsum(alive)])
    place = np.arange(cuts[-1]) - np.repeat(cuts[:-1], alive)
    depth = np.repeat(np.arange(len(alive)), alive)
    ends = depth == lengths[order][place]
    code = codes[np.where(ends, 0, offset[order][place] + depth)]
    code[ends] = NO_CODE
    word_end = np.empty(len(words), dtype=np.int64)
    word_end[order] = cuts[lengths[order]] + np.arange(len(words))
    return code, np.repeat(alive, alive), cuts, word_end


def lattice(words: list[str], vocab: Vocabulary) -> Lattice:
    code, hop, cuts, word_end = _nodes(words)
    start = at = np.flatnonzero(code != NO_CODE)
    node = np.zeros(len(at), dtype=np.int64)
    found = []
    sizes = np.zeros(len(code), dtype=np.int64)
    for step in range(vocab.longest):
        place = _followed(vocab, node << CODE_BITS | code[at])
        known = place >= 0
        if step == 0:
            spelt = np.ones(len(at), dtype=bool)
        start, at, node = start[known], at[known], vocab.ends[place[known]]
        if not len(at):
            break
        at += hop[at]
        piece = vocab.piece_at[node]
        whole = piece >= 0
        found.append((start[whole], at[whole], piece[whole]))
        sizes[found[-1][1]] += 1  # no two arcs of a length end at the same node
        if step == 0:
            spelt[np.flatnonzero(known)[whole]] = False
        more = vocab.inner[node] & (code[at] != NO_CODE)
        start, at, node = start[more], at[more], node[more]
    spelt = np.flatnonzero(code != NO_CODE)[spelt]
    sizes[spelt + hop[spelt]] += 1
    found.insert(0, (spelt, spelt + hop[spelt], np.full(len(spelt), -1, dtype=np.int64)))
    first = np.cumsum(sizes) - sizes
    free = first.copy()
    start, piece = np.empty((2, int(sizes.sum())), dtype=np.int64)
    # Long pieces first: they are the likelier choices, and a choice is looked for from the first arc on.
    while found:
        low, high, taken = found.pop()
        place = free[high]
        start[place], piece[place] = low, taken
        free[high] = place + 1
    score = vocab.log_prob[piece]
    if len(spelt):
        single = np.flatnonzero(piece < 0)
        kinds, kind = np.unique(code[start[single]], return_inverse=True)
        score[single] = np.array([len(_bytes_of(c)) for c in kinds.tolist()])[kind] * vocab.byte_log_prob
    share = _shares(start, np.exp(score), first, sizes, cuts)
    if share is None:
        share = _shares_of_logs(start, score, first, sizes, cuts)
    with np.errstate(divide="ignore"):
        log_choice = np.log(share)
    chosen = np.cumsum(share)
    last = first + sizes - 1
    inner = slice(cuts[1], None)  # every node but the starts has arcs
    head = first[inner]
    chosen -= np.repeat(chosen[head] - share[head], sizes[inner])
    chosen[last[inner]] = 1.0
    return Lattice(start, np.repeat(sizes == 1, sizes), piece, np.clip(log_choice, -700.0, 0.0, out=log_choice), chosen,
                   first, last, code, word_end)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(seed: np.ndarray, path: int, step: np.ndarray | int, use: int) -> np.ndarray:
    """Numbers inside (0, 1) from the seeds of words, the path, the step inside the word and the use."""
    salt = _mixed(np.array([path * 4 + use + 1], dtype=np.uint64) * SPREAD)
    x = _mixed(seed + salt + np.asarray(step).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The whole numbers of all ranges, one range after another."""
    size = stop - start
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def _below(bound: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A Gumbel value cut off at ``bound``, from one that is not; -inf stays."""
    with np.errstate(invalid="ignore"):
        return np.where(value == -np.inf, -np.inf, -np.logaddexp(-bound, -value))


class Path(NamedTuple):
    """One path of each of some texts: its choices in order, with the values of the regions that they leave open."""

    number: int
    texts: np.ndarray
    bounds: np.ndarray  # first choice of each of the texts, and the end
    word: np.ndarray
    step: np.ndarray
    arc: np.ndarray
    before: np.ndarray  # log mass of what is fixed before the choice
    free: np.ndarray  # choices that leave a region
    open_: np.ndarray
    log_prob: np.ndarray
    value: np.ndarray


def _units(text: str) -> list[str]:
    """The units of a text, each without the mark that it begins with."""
    if not text:
        return []
    text = text.replace(MARK, OWN_MARK)
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [u[1:] for u in UNIT.findall(MARK + text.replace(" ", MARK))]
    return text.split(" ")


def _numbered(units: list[str], exact: bool) -> tuple[np.ndarray, list[str]]:
    """A number for each unit, and the distinct units; ``exact`` where they may hold the stand-in, which is no valid
    character and which pandas takes for others."""
    if exact or not units:
        table: dict[str, int] = {}
        return np.fromiter((table.setdefault(u, len(table)) for u in units), np.int64, len(units)), list(table)
    return pd.factorize(np.array(units, dtype=object))


class Sampler:
    """Searches all texts of a chunk at the same time, so that each step is one array operation."""

    def __init__(self, texts: list[str], keys: np.ndarray, vocab: Vocabulary, seed: int = SEED):
        units = [_units(t) for t in texts]
        counts = np.fromiter(map(len, units), np.int64, len(units))
        flat = [u for per in units for u in per]
        code, words = _numbered(flat, any(MARK in t for t in texts))
        self.vocab, self.lattice = vocab, lattice([MARK + w for w in words], vocab) if flat else None
        self.code, self.starts = code, np.concatenate([[0], np.cumsum(counts)])
        self.text_of = np.repeat(np.arange(len(texts)), counts)
        own = _mixed(keys.astype(np.int64).view(np.uint64) + np.array([seed], dtype=np.uint64) * SPREAD)
        place = np.arange(len(code)) - self.starts[self.text_of]
        self.seed = _mixed(own[self.text_of] ^ _mixed(place.astype(np.uint64) + np.uint64(1)))
        self.own = own
        # Per path the words of texts all of whose regions have values.
        self.valued: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(len(code), dtype=bool))

    def _walk(self, word: np.ndarray, node: np.ndarray, step: np.ndarray, path: int):
        """Sample the choices of words from a node back to the word's start."""
        net, out = self.lattice, []
        starts = len(net.word_end)
        while len(word):
            u = _uniform(self.seed[word], path, step, 0)
            arc = net.first[node]
            off = np.flatnonzero(u >= net.chosen[arc])
            while len(off):
                arc[off] += 1
                off = off[u[off] >= net.chosen[arc[off]]]
            out.append((word, step, arc))
            node, step = net.start[arc], step + 1
            on = node >= starts
            word, node, step = word[on], node[on], step[on]
        return out

    def _path(self, texts: np.ndarray, parts: list, path: int, value: np.ndarray, after: np.ndarray) -> Path:
        """Put the choices in order and open the regions that leave the path after choice ``after`` of each text."""
        word, step, arc = (np.concatenate(x) for x in zip(*parts))
        count = np.bincount(word, minlength=len(self.code))
        base = np.concatenate([[0], np.cumsum(count)])
        ordered = np.empty((3, len(arc)), dtype=np.int64)
        place = base[word] + step
        for row, values in zip(ordered, (word, step, arc)):
            row[place] = values
        word, step, arc = ordered
        bounds = base[np.append(self.starts[texts], self.starts[texts[-1] + 1])]
        total = np.concatenate([[0.0], np.cumsum(self.lattice.log_choice[arc])])
        per = np.diff(bounds)
        before = total[:-1] - np.repeat(total[bounds[:-1]], per)
        free = ~self.lattice.only[arc]
        for low, high in zip(bounds[:-1].tolist(), (bounds[:-1] + after + 1).tolist()):
            free[low:high] = False
        out = Path(path, texts, bounds, word, step, arc, before, free, np.full(len(arc), -np.inf),
                   total[bounds[1:]] - total[bounds[:-1]], value)
        self._value(out, np.flatnonzero(free & (before > FLOOR)))
        return out

    def _value(self, path: Path, at: np.ndarray) -> None:
        """Give the regions that some choices leave open their values."""
        rest = np.log(np.maximum(-np.expm1(self.lattice.log_choice[path.arc[at]]), 1e-300))
        g = _gumbel(_uniform(self.seed[path.word[at]], path.number, path.step[at], 1))
        bound = path.value[np.searchsorted(path.bounds, at, side="right") - 1]
        path.open_[at] = _below(bound, path.before[at] + rest + g)

    def _best(self, found: list[Path], size: int) -> tuple[np.ndarray, np.ndarray]:
        """Per text the greatest value of an open region, and where it is: number of the path and choice."""
        best = np.full(size, -np.inf)
        where = np.full((size, 2), -1, dtype=np.int64)
        for m, held in enumerate(found):
            top = np.maximum.reduceat(held.open_, held.bounds[:-1])
            # The first place of each text's greatest value.
            hit = np.flatnonzero(held.open_ == np.repeat(top, np.diff(held.bounds)))
            owner = np.searchsorted(held.bounds, hit, side="right") - 1
            at = np.full(len(held.texts), -1, dtype=np.int64)
            at[owner[::-1]] = hit[::-1]
            better = top > best[held.texts]
            chosen = held.texts[better]
            best[chosen] = top[better]
            where[chosen, 0], where[chosen, 1] = m, at[better]
        return best, where

    def _sure_best(self, found: list[Path], size: int) -> tuple[np.ndarray, np.ndarray]:
        """The best of all regions: where a far one could be better, all regions of the text get their values."""
        best, where = self._best(found, size)
        unsure = best < FLOOR + MOST
        filled = False
        for held in found:
            of_unsure = np.repeat(unsure[held.texts], np.diff(held.bounds))
            # Closed regions below the floor have been valued before, as has all of a text that was unsure once.
            far = np.flatnonzero(of_unsure & held.free & (held.before <= FLOOR) & (held.open_ == -np.inf))
            far = far[~self.valued[held.number][held.word[far]]]
            if len(far):
                self._value(held, far)
                filled = True
        for held in found:
            self.valued[held.number] |= unsure[self.text_of]
        return self._best(found, size) if filled else (best, where)

    def paths(self, k: int) -> tuple[list[Path], np.ndarray]:
        """Up to ``k`` paths of each text that has words, and each text's threshold (-inf if nothing is left)."""
        threshold = np.full(len(self.starts) - 1, -np.inf)
        texts = np.flatnonzero(np.diff(self.starts))
        if not len(texts):
            return [], threshold
        word = np.arange(len(self.code))
        parts = self._walk(word, self.lattice.word_end[self.code], np.zeros(len(word), dtype=np.int64), 0)
        found = [self._path(texts, parts, 0, _gumbel(_uniform(self.own[texts], 0, 0, 2)), np.full(len(texts), -1))]
        closed: list[np.ndarray] = []
        for number in range(1, k + 1):
            best, where = self._sure_best(found, len(threshold))
            if number == k:
                return found, best
            opened = np.flatnonzero(best > -np.inf)
            if not len(opened):
                break
            found.append(self._open(opened, where[opened], best[opened], found, closed, number))
        return found, threshold

    def _open(self, texts, where, value, found, closed, number) -> Path:
        """Sample the best path of one region of each text and leave the rest of the region open."""
        net = self.lattice
        source, at = where.T
        word, step, arc, first = (np.empty(len(texts), dtype=np.int64) for _ in range(4))
        before = np.empty(len(texts))
        parts = []
        for m, held in enumerate(found):
            here = np.flatnonzero(source == m)
            place = at[here]
            word[here], step[here], arc[here] = held.word[place], held.step[place], held.arc[place]
            before[here] = held.before[place]
            first[here] = held.bounds[np.searchsorted(held.texts, texts[here])]
            fixed = _ranges(first[here], place)
            parts.append((held.word[fixed], held.step[fixed], held.arc[fixed]))
        node = np.searchsorted(net.first, arc, side="right") - 1  # where the arc ends; starts of words have no arcs
        low, last = net.first[node], net.last[node]
        column, row = np.arange((last - low).max() + 1), np.arange(len(texts))
        arcs = low[:, None] + column
        share = np.where(arcs <= last[:, None], np.exp(net.log_choice[np.minimum(arcs, last[:, None])]), 0.0)
        share[row, arc - low] = 0.0
        for m, place, taken in closed:  # choices that left the same region before
            same = np.flatnonzero((m[texts] == source) & (place[texts] == at))
            share[same, taken[texts[same]] - low[same]] = 0.0
        running = np.cumsum(share, axis=1)
        u = _uniform(self.seed[word], number, step, 3)
        pick = np.minimum((running <= (u * running[:, -1])[:, None]).sum(axis=1), last - low)
        pick = np.maximum.accumulate(np.where(share > 0.0, column, 0), axis=1)[row, pick]
        share[row, pick] = 0.0
        arc = low + pick
        left = np.full((3, len(self.starts) - 1), -1, dtype=np.int64)
        left[:, texts] = source, at, arc
        closed.append(left)
        with np.errstate(divide="ignore"):
            rest = np.log(np.cumsum(share, axis=1)[:, -1])
        rest = _below(value, before + rest + _gumbel(_uniform(self.seed[word], number, step, 1)))
        for m, held in enumerate(found):
            here = source == m
            held.open_[at[here]] = rest[here]
        parts.append((word, step, arc))
        node = net.start[arc]
        on = node >= len(net.word_end)
        later = _ranges(word + 1, self.starts[texts + 1])
        parts += self._walk(np.concatenate([word[on], later]),
                            np.concatenate([node[on], net.word_end[self.code[later]]]),
                            np.concatenate([step[on] + 1, np.zeros(len(later), dtype=np.int64)]), number)
        after = at - first
        return self._path(texts, parts, number, value, after)

    def pieces(self, path: Path) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids in the order of the text, and where each text's ids begin."""
        net = self.lattice
        # Choices run backwards inside a word.
        edge = np.concatenate([[0], np.flatnonzero(path.word[1:] != path.word[:-1]) + 1, [len(path.word)]])
        size = np.diff(edge)
        arc = path.arc[np.repeat(edge[:-1] + edge[1:] - 1, size) - np.arange(len(path.arc))]
        ids, bounds = net.piece[arc], path.bounds
        spelt = np.flatnonzero(ids < 0)
        if len(spelt):
            raw = [_bytes_of(c) for c in net.code[net.start[arc[spelt]]].tolist()]
            width = np.ones(len(ids), dtype=np.int64)
            width[spelt] = [len(r) for r in raw]
            place = np.concatenate([[0], np.cumsum(width)])
            ids = np.repeat(ids, width)
            ids[ids < 0] = self.vocab.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
            bounds = place[bounds]
        return ids.astype(np.int32), bounds


def log_inclusion(log_prob: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """log(1 - exp(-exp(log_prob - threshold))), exact for very small chances too."""
    with np.errstate(over="ignore", under="ignore", divide="ignore"):
        x = log_prob - threshold
        return np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.minimum(x, 700.0)))))


def segment(texts: list[str], keys: np.ndarray, model: bytes, k: int, seed: int = SEED) -> Iterator[tuple]:
    """Per path number: texts, ids, their bounds, log_prob, perturbed value, log_inclusion."""
    sampler = Sampler(texts, keys, vocabulary(model), seed)
    found, threshold = sampler.paths(k)
    empty = np.flatnonzero(np.diff(sampler.starts) == 0)
    if len(empty):
        zero = np.zeros(len(empty))
        yield 1, empty, np.zeros(0, np.int32), np.zeros(len(empty) + 1, np.int64), zero, _gumbel(
            _uniform(sampler.own[empty], 0, 0, 2)), zero
    for number, path in enumerate(found, 1):
        ids, bounds = sampler.pieces(path)
        yield number, path.texts, ids, bounds, path.log_prob, path.value, log_inclusion(
            path.log_prob, threshold[path.texts])


def _segmented(batches: Iterator[pa.RecordBatch], model: bytes, k: int, seed: int, with_text: bool
               ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        keys = batch.column("_key").to_numpy(zero_copy_only=False)
        texts = [t or "" for t in batch.column("text").to_pylist()]
        sizes = [t if t.isascii() else t.encode("utf-8", "surrogatepass") for t in texts]
        for a, b in chunks(sizes, CHUNK):
            for number, at, pieces, bounds, log_prob, value, inclusion in segment(texts[a:b], keys[a:b], model, k, seed):
                held = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(pieces))
                columns = {"doc_id": ids.take(pa.array(at + a)),
                           "rank": pa.array(np.full(len(at), number, dtype=np.int32)), "pieces": held,
                           "log_prob": pa.array(log_prob), "perturbed": pa.array(value),
                           "log_inclusion": pa.array(inclusion)}
                if with_text:
                    columns["decoded"] = _decoded_all(held, model)
                yield pa.RecordBatch.from_pydict(columns)


def read_model(path: str = MODEL) -> bytes:
    """The model file, read by the driver and sent with the tasks; it has about half a megabyte."""
    with open(path, "rb") as file:
        return file.read()


def encode_samples(docs: DataFrame, k: int = SAMPLES, path: str = MODEL, seed: int = SEED,
                   with_text: bool = False) -> DataFrame:
    """Up to ``k`` distinct segmentations of each whole text, in the order they were drawn.

    Returns doc_id, rank from 1, piece ids, log probability, perturbed value and log inclusion score; ``with_text`` adds
    ``decoded``, the text that ``decode`` makes of the piece ids, without another way through Python.  Null and empty
    texts have one segmentation without pieces, certain to be drawn; a text with fewer than ``k`` segmentations gives
    all of them, each with inclusion score 0.  Equal rows, and rows without an id and with equal texts, get the same
    samples, as the key is the doc_id.  An empty table gives no rows; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("doc_id").alias("_key"), "text").mapInArrow(
        partial(_segmented, model=read_model(path), k=k, seed=seed, with_text=with_text),
        f"doc_id {kind}, {SCHEMA}" + (", decoded string" if with_text else ""))


def decoded(ids: np.ndarray, spelling: list[bytes]) -> str:
    """The text of piece ids: their spellings joined, without the space that stands before the first word."""
    return b"".join([spelling[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


def _spelt(ids: np.ndarray, bounds: np.ndarray, blob: np.ndarray, begin: np.ndarray, size: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of many texts from their ids, without each one's first byte, and where each begins."""
    width = size[ids]
    place = np.concatenate([[0], np.cumsum(width)])
    out = blob[np.repeat(begin[ids] - place[:-1], width) + np.arange(place[-1])]
    edge = place[bounds]
    some = edge[1:] > edge[:-1]
    keep = np.ones(len(out), dtype=bool)
    keep[edge[:-1][some]] = False
    return out[keep], edge - np.concatenate([[0], np.cumsum(some)])


def _decoded_all(pieces: pa.Array, model: bytes) -> pa.Array:
    spelling = vocabulary(model).spelling
    size = np.fromiter(map(len, spelling), np.int64, len(spelling))
    begin, blob = np.cumsum(size) - size, np.frombuffer(b"".join(spelling), np.uint8)
    ids = pieces.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(pieces.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    parts, at = [], 0
    while at < len(pieces) or not parts:
        # Rows of about CHUNK ids together; a longer row stands alone.
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK, side="right")) - 1)
        to = min(to, len(pieces))
        raw, edge = _spelt(ids[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at], blob, begin, size)
        part = pa.Array.from_buffers(pa.large_binary(), to - at, [None, pa.py_buffer(edge.astype(np.int64).tobytes()),
                                                                  pa.py_buffer(raw.tobytes())])
        try:
            parts.append(part.cast(pa.large_string()).cast(pa.string()))
        except pa.ArrowInvalid:  # ids that no text has
            parts.append(pa.array([b.decode("utf-8", "replace") for b in part.to_pylist()], pa.string()))
        at = to
    out = pa.concat_arrays(parts)
    return pc.if_else(pieces.is_valid(), out, pa.scalar(None, pa.string())) if pieces.null_count else out


def decode(column: str, path: str = MODEL):
    """Column: the text of an array of piece ids; null for null.  Bytes that are no text become U+FFFD."""
    model = read_model(path)

    def texts(pieces: pa.Array) -> pa.Array:
        return _decoded_all(pieces, model)

    return F.arrow_udf(texts, T.StringType())(column)
