"""Stretches of words that repeat with a period, found by the branching-tandem test on an enhanced suffix array.

Each word of a text is a number, and numbers of different texts differ, so one suffix array serves a whole batch: the
suffixes of a text stand together and no common prefix leaves its text.  Suffixes are sorted by prefixes of doubling
length; the ranks of all lengths give the longest common prefixes (LCP) of neighbours.

An interval of the array whose inner LCPs are at least ``depth``, one of them equal, holds all suffixes with the same first
``depth`` words, and its children those that also agree on the next word.  A suffix ``i`` and the suffix ``i + depth`` in two
children of the interval are a branching tandem: a square of period ``depth`` at ``i`` that cannot move right.  It is
enough to look from the suffixes outside the largest child, at ``i + depth`` and at ``i - depth``, by the inverse array (ISA).
Intervals and children are bounds in the array; there is no tree.

Each square is then rotated left while the words a period apart agree, which gives the run whose last square it is.  Of
squares with the same end only those not inside the run of a shorter period that divides theirs are rotated.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, codes_of

LEAST_WORDS, LEAST_PERIODS = 24, 3
CHUNK = 1_000_000  # bytes of text searched together
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_order(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse, and the LCP of each suffix with the one before it (0 for the first)."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    fresh = np.concatenate([[True], codes[order][1:] != codes[order][:-1]])
    # The rank of a group is the place of its first suffix, so it stays when other groups are split.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, width = [rank.astype(np.int32)], 1
    open_ = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))  # places in groups of two and more
    while len(open_):
        suffix = order[open_]
        after = suffix + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1) + 1
        first = rank[suffix]
        by = np.argsort(first * (n + 1) + second, kind="stable")
        suffix, first, second = suffix[by], first[by], second[by]
        order[open_] = suffix
        split = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        rank[suffix] = np.maximum.accumulate(np.where(split, open_, 0))
        levels.append(rank.astype(np.int32))
        width *= 2
        open_ = open_[~split | ~np.append(split[1:], True)]
    rank[order] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    alive = np.arange(1, n)
    for k in range(len(levels) - 1, -1, -1):
        # Suffixes with the same rank agree on at least 2**k words.
        inside = np.maximum(left, right) < n
        same = np.zeros(n - 1, bool) if n else np.zeros(0, bool)
        same[inside] = levels[k][left[inside]] == levels[k][right[inside]]
        left[same] += 1 << k
        right[same] += 1 << k
        lcp[alive[same]] += 1 << k
    return order, rank, lcp


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Children of all LCP intervals of depth 1 and more: first place, place after the last, number of the interval; depths.

    The children of an interval follow each other.
    """
    # Places with LCP 0 part the array; only the others need a stack.
    start: list[int] = []
    end: list[int] = []
    owner: list[int] = []
    depths: list[int] = []
    values = lcp.tolist()
    places = np.flatnonzero(lcp)
    # Each entry of the stack is an open interval: depth, first places of its children so far.
    stack: list[tuple[int, list[int]]] = []
    last = -1

    def close(depth: int, firsts: list[int], stop: int) -> None:
        number = len(depths)
        depths.append(depth)
        start.extend(firsts)
        end.extend(firsts[1:])
        end.append(stop)
        owner.extend([number] * len(firsts))

    for place in places.tolist():
        if place != last + 1:
            while stack:
                depth, firsts = stack.pop()
                close(depth, firsts, last + 1)
        depth = values[place]
        begin = place - 1
        while stack and stack[-1][0] > depth:
            deeper, firsts = stack.pop()
            close(deeper, firsts, place)
            begin = firsts[0]
        if stack and stack[-1][0] == depth:
            stack[-1][1].append(place)
        else:
            stack.append((depth, [begin, place]))
        last = place
    while stack:
        depth, firsts = stack.pop()
        close(depth, firsts, last + 1)
    return tuple(np.array(x, dtype=np.int64) for x in (start, end, owner, depths))


def branching_tandems(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares whose rotation to the right is no square, each once."""
    none = np.zeros(0, np.int64)
    if len(codes) < 2:
        return none, none
    n = len(codes)
    order, place, lcp = suffix_order(codes)
    start, end, owner, depths = intervals(lcp)
    if not len(depths):
        return none, none
    first_child = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    lo, hi = start[first_child], end[np.append(first_child[1:], len(owner)) - 1]
    # The largest child of each interval is left out; every suffix is then met once for each halving of its group.
    size = end - start
    by = np.lexsort((-size, owner))
    small = np.ones(len(owner), bool)
    small[by[first_child]] = False
    start, end, owner, size = start[small], end[small], owner[small], size[small]
    found = []
    step = 1 << 20
    total = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + step, side="right")))
        child = np.repeat(np.arange(at, to), size[at:to])
        suffix = order[start[child] + np.arange(len(child)) - np.repeat(np.cumsum(size[at:to]) - size[at:to], size[at:to])]
        depth, whole = depths[owner[child]], owner[child]
        for sign in (1, -1):
            other = suffix + sign * depth
            held = np.flatnonzero((other >= 0) & (other < n))
            where = place[other[held]]
            kin = child[held]
            hit = held[(where >= lo[whole[held]]) & (where < hi[whole[held]]) & ((where < start[kin]) | (where >= end[kin]))]
            found.append(np.minimum(suffix[hit], other[hit]) * (n + 1) + depth[hit])
        at = to
    # Both suffixes of a square may lie in small children.
    squares = np.unique(np.concatenate(found))
    return squares // (n + 1), squares % (n + 1)


def _rotated(codes: np.ndarray, start: int, period: int) -> int:
    """Where the squares of a period that lead to the one at ``start`` by rotation begin: slices of doubling length."""
    width = 16
    while start:
        width = min(width, start)
        differ = np.flatnonzero(codes[start - width:start] != codes[start - width + period:start + period])
        if len(differ):
            return start - width + int(differ[-1]) + 1
        start -= width
        width *= 2
    return 0


def runs(codes: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows of start, length and smallest period of all maximal periodic stretches that are long enough."""
    start, period = branching_tandems(codes)
    end = start + 2 * period
    order = np.lexsort((period, end))
    out = []
    last, known = -1, []
    for e, p in zip(end[order].tolist(), period[order].tolist()):
        if e != last:
            last, known = e, []
        if any(p % q == 0 and e - 2 * p >= begin for begin, q in known):
            continue  # a power of a shorter word
        begin = _rotated(codes, e - 2 * p, p)
        known.append((begin, p))
        if e - begin >= max(least_words, least_periods * p):
            out.append((begin, e - begin, p))
    return np.array(sorted(out, key=lambda r: (r[0], r[2])), dtype=np.int64).reshape(-1, 3)


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _found(batches: Iterator[pa.RecordBatch], least_words: int, least_periods: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for lo, hi in chunks([t or "" for t in texts], CHUNK):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo),
                                              *_searched(texts[lo:hi], least_words, least_periods)],
                                             names=["doc_id", "n_words", "runs", "collapsed"])


def _searched(texts: list[str | None], least_words: int, least_periods: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    words = [_words(t) for t in texts]
    edge = np.concatenate([[0], np.cumsum([len(row) for row in words])]).astype(np.int64)
    codes, distinct = codes_of([w for row in words for w in row])
    # A text's words are numbers of its own.
    owner = np.repeat(np.arange(len(words)), np.diff(edge))
    found = runs(codes + owner * (len(distinct) + 1), least_words, least_periods)
    text = np.searchsorted(edge, found[:, 0], side="right") - 1
    bounds = np.searchsorted(text, np.arange(len(words) + 1))
    inside = found.copy()
    inside[:, 0] -= edge[text]
    dropped = np.zeros(edge[-1] + 1, np.int64)
    np.add.at(dropped, found[:, 0] + found[:, 2], 1)
    np.add.at(dropped, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(dropped)[:-1] == 0
    collapsed = []
    for i, row in enumerate(words):
        if bounds[i] < bounds[i + 1]:
            row = [row[k] for k in np.flatnonzero(kept[edge[i]:edge[i + 1]])]
        collapsed.append(b" ".join(row).decode("utf-8", "surrogatepass"))
    return (pa.array(np.diff(edge)),
            pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                     pa.StructArray.from_arrays([pa.array(inside[:, k]) for k in range(3)], fields=list(RUN))),
            pa.array(collapsed, pa.string()))


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """Periodic runs of the words (stretches without ASCII white space) of each whole text, and the text without repeats.

    Returns per row of ``docs`` doc_id, n_words, ``runs`` (start, length, smallest period, by start and period) of at least
    ``least_words`` words and ``least_periods`` periods, and ``collapsed``: the words that no run contains after its first period, joined
    by one space.  Null, empty and blank texts have no words, no runs and an empty collapsed text.  Rows are independent,
    so repeated rows give repeated results; extra columns are ignored; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        partial(_found, least_words=least_words, least_periods=least_periods), f"doc_id {kind}, {SCHEMA}")


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), where every tenth text, by the hash of its id, repeats words from a place on.

    With h the CRC-32 of the decimal id and g = floor(h / 10), a text of n words with h a multiple of 10 goes on from word
    a = g mod n with the p = 1 + floor((n - a) / (3 + g mod 8)) words from there, again and again.  Other texts, and those without an id, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    planted = (docs.select("doc_id", "text", g.alias("_g"), F.when(h % 10 == 0, words).alias("_words"))
               .withColumn("_n", F.coalesce(F.size("_words"), F.lit(0)).cast("long"))
               .withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
               .withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int")))
    again = F.array_join(F.transform("_words", lambda w, i: F.when(i < F.col("_a"), w).otherwise(
        F.get("_words", F.col("_a") + (i - F.col("_a")) % F.col("_p")))), " ")
    return planted.select("doc_id", F.when(F.col("_n") > 0, again).otherwise(F.col("text")).alias("text"))


def strongest(runs_column: str) -> Column:
    """The run with the greatest exact length / period, among equals with the smallest start, then period; null without a run."""
    def better(held: Column, run: Column) -> Column:
        # Cross products are exact in a decimal of 38 digits.
        a, b = (x["length"].cast("decimal(19,0)") * y["period"].cast("decimal(19,0)") for x, y in ((run, held), (held, run)))
        return F.when(held.isNull() | (a > b), run).otherwise(held)

    first = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs_column, first, better)
