"""Removal of repeated byte strings by longest-previous-factor arrays over a sparse, distributed suffix order.

Every string of ``LENGTH`` bytes has an anchor, the smallest hash among its grams of ``GRAM`` bytes, so equal strings
have equal anchors at equal offsets.  Strings that start one after another and share an anchor form a context, the bytes
from the first one's start to the last one's end.  Anchors whose gram occurs once in the corpus are done.  If all
contexts of a gram are alike, all their strings repeat.  Only the remaining grams need an order of suffixes: the distinct
contexts of a gram are sorted together, previous and next smaller positions in suffix order give the longest previous
factor of each string, and previous and next greater ones the longest later factor.

No key is gathered whole: grams and contexts are counted with a map-side combine, copies of a context count as one, and a
gram with more than ``HOT`` distinct contexts is dealt out by its strings instead of going to one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.shared import written
from .common import as_bytes, chunks, row_key

LENGTH = 200
GRAM = 64
HOT = 2_000  # distinct contexts of one gram beyond which its strings are counted by their hashes
CHUNK = 1_000_000  # bytes whose anchors are found, or whose suffixes are sorted, at a time
PIECE = 1 << 22  # starts of a longer text looked at together
PLACE_BITS = np.uint64(26)
TABLE = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15


def _gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from each place on, built from halves."""
    out, width, base = TABLE[raw], 1, BASE
    while width < gram:
        out = out[:-width] * np.uint64(base) + out[width:]
        width, base = 2 * width, base * base % (1 << 64)
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def _window_min(values: np.ndarray, window: int) -> np.ndarray:
    out, width = values, 1
    while 2 * width <= window:
        out, width = np.minimum(out[:-width], out[width:]), 2 * width
    return np.minimum(out[:len(values) - window + 1], out[window - width:len(values) - width + 1])


class Anchors(NamedTuple):
    """Per context the text it is of, its first and last start, its anchor's place, hashes of gram and context."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    at: np.ndarray
    gram: np.ndarray
    context: np.ndarray


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Anchors:
    """Contexts of all strings of ``length`` bytes of some texts, which are looked at together."""
    joined = b"".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    empty = np.zeros(0, np.int64)
    if len(joined) < length:
        return Anchors(*[empty] * 6)
    hashes = _gram_hashes(np.frombuffer(joined, np.uint8), gram)
    keyed = (hashes >> PLACE_BITS << PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_window_min(keyed, length - gram + 1) & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    start = np.arange(len(anchor))
    owner = np.searchsorted(begins, start, side="right") - 1
    good = start + length <= begins[owner + 1]
    start, owner, anchor = start[good], owner[good], anchor[good]
    if not len(start):
        return Anchors(*[empty] * 6)
    cut = np.concatenate([[0], np.flatnonzero((anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])) + 1])
    ends = np.append(cut[1:], len(start)) - 1
    first, last, at, owner = start[cut], start[ends], anchor[cut], owner[cut]
    digest = xxhash.xxh3_64_intdigest
    context = np.fromiter(
        (digest(joined[f:e], a) for f, e, a in zip(first.tolist(), (last + length).tolist(), (at - first).tolist())),
        np.uint64, len(first))
    begin = begins[owner]
    return Anchors(owner, first - begin, last - begin, at - begin, hashes[at].view(np.int64), context.view(np.int64))


def _pieces(texts: list[bytes], keys: np.ndarray, length: int) -> tuple[list[bytes], list[int], list[int]]:
    """Long texts cut so that each start is in one piece, whole with its string."""
    parts, owner, shift = [], [], []
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 1), PIECE):
            parts.append(text[at:at + PIECE + length - 1])
            owner.append(i)
            shift.append(at)
    return parts, owner, shift


def _anchored(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row").to_numpy(zero_copy_only=False)
            texts = as_bytes(batch.column("text").to_pylist())
            parts, owner, shift = _pieces(texts, keys, length)
            for a, b in chunks(parts, CHUNK):
                found = anchors(parts[a:b], length, gram)
                text = found.text + a
                moved = np.array(shift, dtype=np.int64)[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[np.array(owner, dtype=np.int64)[text]], pa.int64()),
                     *[pa.array(v + moved, pa.int64()) for v in (found.first, found.last, found.at)],
                     pa.array(found.gram, pa.int64()), pa.array(found.context, pa.int64())],
                    names=["row", "first", "last", "at", "gram", "context"])
    return run


# -- suffix order ------------------------------------------------------------------------------------------------------

def suffix_order(raw: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes of a text in the order of their first ``depth`` bytes at least, and ranks at depths 1, 2, 4 ...

    Prefix doubling: the rank at twice the depth is the rank of a pair of ranks.  Suffixes equal to that depth keep the
    order of their places.
    """
    rank, ranks, width = raw.astype(np.int64) + 1, [], 1
    while True:
        ranks.append(rank)
        if width >= depth:
            return np.argsort(rank, kind="stable"), ranks
        behind = np.concatenate([rank[width:], np.zeros(min(width, len(rank)), dtype=np.int64)])
        rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + behind, return_inverse=True)[1] + 1
        width *= 2


def common_prefix(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes two suffixes share, up to twice the greatest stored depth; 0 where a place is missing (-1)."""
    out = np.zeros(len(a), dtype=np.int64)
    there = (a >= 0) & (b >= 0)
    size = len(ranks[0])
    for k in range(len(ranks) - 1, -1, -1):
        inside = there & (np.maximum(a, b) + out + (1 << k) <= size)
        at = np.flatnonzero(inside)
        same = at[ranks[k][a[at] + out[at]] == ranks[k][b[at] + out[at]]]
        out[same] += 1 << k
    return out


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """The nearest place before each that holds a smaller value, or -1: all places jump over greater runs at once."""
    out = np.arange(len(values)) - 1
    on = np.flatnonzero(out >= 0)
    while len(on):
        on = on[values[out[on]] >= values[on]]
        out[on] = out[out[on]]
        on = on[out[on] >= 0]
    return out


def _factors(order: np.ndarray, ranks: list[np.ndarray], position: np.ndarray) -> np.ndarray:
    """Longest factor of each suffix in ``order`` that also starts at a smaller position."""
    values = position[order]
    before = nearest_smaller(values)
    behind = len(order) - 1 - nearest_smaller(values[::-1])[::-1]
    behind[behind >= len(order)] = -1
    padded = np.append(order, -1)
    return np.maximum(common_prefix(ranks, order, padded[before]), common_prefix(ranks, order, padded[behind]))


def previous_and_later_factors(raw: np.ndarray, position: np.ndarray, chosen: np.ndarray, length: int
                               ) -> tuple[np.ndarray, np.ndarray]:
    """For the ``chosen`` places of a text: longest previous factor and longest later factor among them.

    ``position`` orders the places by where they stand in the corpus.
    """
    order, ranks = suffix_order(raw, length)
    keep = np.zeros(len(raw), dtype=bool)
    keep[chosen] = True
    order = order[keep[order]]
    lpf, later = np.zeros(len(raw), dtype=np.int64), np.zeros(len(raw), dtype=np.int64)
    lpf[order] = _factors(order, ranks, position)
    later[order] = _factors(order, ranks, -position)
    return lpf[chosen], later[chosen]


def _spans(hit: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edge[::2].tolist(), (edge[1::2] - 1).tolist()


def _sorted_contexts(frame: pd.DataFrame, length: int, first: bool) -> pd.DataFrame:
    """The repeated starts of contexts that stand together: spans of offsets from each context's first start."""
    raw = list(frame["bytes"])
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    begin = np.concatenate([[0], np.cumsum(size)])
    place = np.empty(len(raw), dtype=np.int64)
    place[np.lexsort((frame["first"], frame["row"], frame["doc_id"].fillna(np.iinfo(np.int64).min).astype("int64")))] = \
        np.arange(len(raw))
    owner = np.repeat(np.arange(len(raw)), size)
    offset = np.arange(begin[-1]) - begin[owner]
    chosen = np.flatnonzero(offset <= size[owner] - length)
    # A context's end is no start, so factors that run over it are of no use and cannot reach the length.
    lpf, later = previous_and_later_factors(
        np.frombuffer(b"".join(raw), np.uint8), place[owner] * (int(size.max()) + 1) + offset, chosen, length)
    hit = lpf >= length if first else np.maximum(lpf, later) >= length
    bounds = np.searchsorted(chosen, begin)
    spans = [_spans(hit[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return pd.DataFrame({"gram": frame["gram"].to_numpy(), "context": frame["context"].to_numpy(),
                         "from": [s[0] for s in spans], "to": [s[1] for s in spans]})


def _by_suffix_order(length: int, first: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            grams = frame["gram"].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(grams[1:] != grams[:-1]) + 1, [len(grams)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                # Whole grams only: a sorted chunk ends where the next gram begins.
                if size > CHUNK and held[-1]["gram"].iloc[-1] != grams[a]:
                    yield _sorted_contexts(pd.concat(held, ignore_index=True), length, first)
                    held, size = [], 0
                held.append(frame.iloc[a:b])
                size += sum(map(len, frame["bytes"].iloc[a:b]))
        if held:
            yield _sorted_contexts(pd.concat(held, ignore_index=True), length, first)
    return run


# -- the job -----------------------------------------------------------------------------------------------------------

def _cut_contexts(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = as_bytes(frame["text"])
            out = [(doc, row, c["gram"], c["context"], c["first"], c["hot"], text[c["first"]:c["last"] + length])
                   for doc, row, text, wanted in zip(frame["doc_id"], frame["row"], texts, frame["wanted"])
                   for c in wanted]
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "row", "gram", "context", "first", "hot", "bytes"]).astype(
                    {"doc_id": "Int64"})
    return run


def _string_hashes(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for doc, row, gram, context, start, raw in zip(*[frame[c] for c in (
                    "doc_id", "row", "gram", "context", "first", "bytes")]):
                keys = [hashlib.blake2b(raw[i:i + length], digest_size=16).digest()
                        for i in range(len(raw) - length + 1)]
                yield pd.DataFrame({"string": keys, "doc_id": pd.array([doc] * len(keys), "Int64"), "row": row,
                                    "start": np.arange(len(keys)) + start, "gram": gram, "context": context,
                                    "offset": np.arange(len(keys))})
    return run


def _hot_spans(strings: DataFrame, first: bool) -> DataFrame:
    """Repeated starts of hot grams: strings counted by 128-bit hashes with a map-side combine, and joined back."""
    place = F.struct("doc_id", "row", "start")
    repeated = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).where("n > 1")
    met = strings.join(repeated, "string")
    if first:
        met = met.where(place != F.col("least"))
    return met.groupBy("gram", "context").agg(F.sort_array(F.collect_list("offset")).alias("from")).select(
        "gram", "context", "from", F.col("from").alias("to"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "none") -> DataFrame:
    """Row keys with the spans (from, to) of starts whose strings repeat; to is the last start.

    ``keep="none"`` takes all copies, ``"first"`` leaves the copy with the smallest (doc_id, row key, place).
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is none or first")
    first = keep == "first"
    texts = docs.select("doc_id", row_key("doc_id", "text").alias("row"), "text")
    held = written(texts.select("row", "text").mapInArrow(
        _anchored(length, gram), "row long, first long, last long, at long, gram long, context long"), "anchors")
    grams = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("low"),
                                     F.max("context").alias("high")).where("n > 1")
    # Stored first: a join of two plain shuffles is one whose large partitions Spark can split.
    grams = written(grams.select("gram", (F.col("low") != F.col("high")).alias("mixed")), "grams")
    found = written(held.join(grams, "gram"), "repeated")
    ids = written(docs.select(row_key("doc_id", "text").alias("row"), "doc_id").join(
        found.select("row").distinct(), "row", "left_semi").distinct(), "ids")

    # One row per distinct context, with the place of its first copy.
    contexts = written(found.join(ids, "row").groupBy("gram", "context", "mixed").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "row", "first", "last")).alias("least")), "contexts")
    mixed = contexts.where("mixed")
    hot = mixed.groupBy("gram").agg((F.count(F.lit(1)) > HOT).alias("hot"))
    wanted = (mixed.join(hot, "gram").select(
        F.col("least.row").alias("row"), F.struct("least.first", "least.last", "gram", "context", "hot").alias("c"))
        .groupBy("row").agg(F.collect_list("c").alias("wanted")))
    # Rows that are alike have the same bytes; one of them is read.
    cut = written(texts.join(written(wanted, "wanted").hint("merge"), "row").dropDuplicates(["row"]).mapInPandas(
        _cut_contexts(length),
        "doc_id long, row long, gram long, context long, first long, hot boolean, bytes binary"), "cut")
    spans = "gram long, context long, `from` array<int>, `to` array<int>"
    by_order = cut.where("not hot").repartition("gram").sortWithinPartitions("gram").mapInPandas(
        _by_suffix_order(length, first), spans)
    strings = cut.where("hot").mapInPandas(
        _string_hashes(length), "string binary, doc_id long, row long, start long, gram long, context long, offset int")
    resolved = by_order.unionByName(_hot_spans(written(strings, "strings"), first))
    judged = written(contexts.join(written(resolved, "resolved"), ["gram", "context"], "left").select(
        "gram", "context", "mixed", "n", "least", "from", "to"), "judged")

    whole = F.array(F.struct(F.col("first").alias("from"), F.col("last").alias("to")))
    part = F.transform(F.arrays_zip("from", "to"), lambda s: F.struct(
        (F.col("first") + s["from"]).alias("from"), (F.col("first") + s["to"]).alias("to")))
    none = F.array().cast("array<struct<from:bigint,to:bigint>>")
    leads = (F.col("row") == F.col("least.row")) & (F.col("first") == F.col("least.first"))
    if first:
        picked = F.when(~leads, whole).when(F.col("mixed"), F.coalesce(part, none)).otherwise(none)
    else:
        picked = F.when(~F.col("mixed") | (F.col("n") > 1), whole).otherwise(F.coalesce(part, none))
    return (found.select("row", "first", "last", "gram", "context").join(judged, ["gram", "context"])
            .select("row", F.explode(picked).alias("s")).groupBy("row")
            .agg(F.array_sort(F.collect_list("s")).alias("spans")))


def _removed(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kept_all, counts = [], []
            for raw, spans in zip(as_bytes(frame["text"]), frame["spans"]):
                at, out, gone, runs, end = 0, [], 0, 0, -1
                for span in spans:
                    a, b = int(span["from"]), int(span["to"]) + length
                    if a > end:
                        out.append(raw[at:a])
                        runs += 1
                        gone += b - a
                    elif b > end:
                        gone += b - end
                    end = at = max(b, end)
                out.append(raw[at:])
                kept_all.append(b"".join(out))
                counts.append((gone, runs))
            yield pd.DataFrame({"row": frame["row"], "kept": kept_all, "n_removed": [c[0] for c in counts],
                                "n_spans": [c[1] for c in counts]})
    return run


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "none") -> DataFrame:
    """Each document with its bytes, the bytes and spans removed, and the SHA-256 of what is left.

    With ``keep="none"`` each byte goes that a string of ``length`` bytes covers which starts anywhere else too, in the
    same text or another.  Null is empty; texts shorter than ``length`` stay; repeated rows are copies of each other; an
    empty table gives no rows; other columns are ignored.
    """
    spans = written(repeated_spans(docs, length, gram, keep), "spans")
    changed = docs.select(row_key("doc_id", "text").alias("row"), "text").join(spans.hint("merge"), "row").mapInPandas(
        _removed(length), "row long, kept binary, n_removed long, n_spans long")
    # Alike rows give alike results.
    parts = written(changed.select("row", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")).distinct(),
                    "changed")
    raw = F.coalesce(F.col("text"), F.lit(""))
    same = docs.select("doc_id", row_key("doc_id", "text").alias("row"), F.octet_length(raw).cast("long").alias("n_bytes"),
                       F.sha2(F.encode(raw, "utf-8"), 256).alias("whole"))
    return same.join(parts, "row", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
