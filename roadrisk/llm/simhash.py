"""Near copies by SimHash, found with a hierarchical index over Gray-ordered fingerprints.

Two fingerprints with at most 3 differing bits agree on at least 3 of 6 blocks of bits, so they meet in at least one of
20 tables, one for each choice of 3 blocks.  The rows of a table with the same 3 blocks form a bucket.  In a bucket the
fingerprints stand in the order of their Gray ranks, where neighbours share many bits.  Leaves of 16 neighbours, groups
of 16 leaves and so on keep the bits that all their members share as (mask, value).  A search goes down from the root,
adds up the differences on the bits that each node newly fixes, and drops a whole group once the sum passes the limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.shared import written
from .common import as_bytes, own_name, row_key
from .components import components

SHINGLE = 3
SEED = 42
DISTANCE = 3
BLOCKS = (11, 11, 11, 11, 10, 10)  # bits of each block
AGREEING = 3
FAN_OUT = 16
QUERIES_AT_ONCE = 512
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64 majority bits over the hashes of all shingles; 0 for a text without words."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist())),
                         np.uint64, len(starts))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(raw) for raw in as_bytes(texts)], dtype=np.uint64).view(np.int64))


fingerprints = F.pandas_udf(_fingerprints, T.LongType())


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected binary sequence, in which neighbours differ by one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Distinct codes in Gray order under nodes that hold the bits which all codes below share."""

    def __init__(self, codes: np.ndarray, fan_out: int = FAN_OUT):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        self.fan_out = fan_out
        mask, value = np.full(len(codes), ALL), self.codes
        self.levels = [(mask, value)]
        while len(value) > 1:
            at = np.arange(0, len(value), fan_out)
            ones = np.bitwise_and.reduceat(value & mask, at)
            zeros = np.bitwise_and.reduceat(~value & mask, at)
            mask, value = ones | zeros, ones
            self.levels.append((mask, value))

    def search(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place of the query, place in ``codes``) within the distance."""
        mask, value = self.levels[-1]
        query = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        off = np.bitwise_count((queries ^ value[0]) & mask[0]).astype(np.int64)
        alive = off <= distance
        query, node, off, above = query[alive], node[alive], off[alive], mask
        for mask, value in reversed(self.levels[:-1]):
            child = (node[:, None] * self.fan_out + np.arange(self.fan_out)).ravel()
            there = child < len(value)
            query, off = np.repeat(query, self.fan_out)[there], np.repeat(off, self.fan_out)[there]
            parent, child = np.repeat(node, self.fan_out)[there], child[there]
            off = off + np.bitwise_count((queries[query] ^ value[child]) & mask[child] & ~above[parent])
            alive = off <= distance
            query, node, off, above = query[alive], child[alive], off[alive], mask
        return query, node


def linked(codes: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """For each of the distinct codes the code that stands for its group; links within the distance make groups."""
    index = GrayIndex(codes)
    lead = np.arange(len(codes))
    for at in range(0, len(codes), QUERIES_AT_ONCE):
        query, found = index.search(index.codes[at:at + QUERIES_AT_ONCE], distance)
        a, b = query + at, found
        while True:
            a, b = lead[a], lead[b]
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(lead, np.maximum(a, b), np.minimum(a, b))
            while (lead != lead[lead]).any():
                lead = lead[lead]
    return index.codes, index.codes[lead]


def _masks() -> list[int]:
    at, blocks = 0, []
    for width in BLOCKS:
        blocks.append(((1 << width) - 1) << at)
        at += width
    return [sum(chosen) for chosen in combinations(blocks, AGREEING)]


def _bucket_links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of each bucket to its groups' leads.  Buckets arrive one after another; a cut one waits for its rest."""
    held: list[pd.DataFrame] = []

    def out(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        key = frame["bucket"].to_numpy()
        turn = (key[1:] != key[:-1]) | (frame["side"].to_numpy()[1:] != frame["side"].to_numpy()[:-1])
        edges = np.concatenate([[0], np.flatnonzero(turn) + 1, [len(frame)]])
        codes = frame["code"].to_numpy().view(np.uint64)
        many = np.flatnonzero(np.diff(edges) > 1)
        found = [linked(codes[edges[i]:edges[i + 1]]) for i in many]
        if found:
            a, b = (np.concatenate(side).view(np.int64) for side in zip(*found))
            yield pd.DataFrame({"a": a[a != b], "b": b[a != b]})

    for frame in frames:
        last = frame.iloc[-1]
        open_ = ((frame["bucket"] == last["bucket"]) & (frame["side"] == last["side"])).to_numpy()
        start = len(frame) - int(np.argmin(open_[::-1])) if not open_.all() else 0
        if start:
            yield from out(pd.concat([*held, frame.iloc[:start]], ignore_index=True))
            held = []
        elif held and (held[-1].iloc[-1][["bucket", "side"]] != last[["bucket", "side"]]).any():
            yield from out(pd.concat(held, ignore_index=True))
            held = []
        held.append(frame.iloc[start:])
    if held:
        yield from out(pd.concat(held, ignore_index=True))


def near_links(codes: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct ``code`` values within the distance, without listing all pairs."""
    sides = F.array(*[F.struct(F.lit(i).alias("side"), F.col("code").bitwiseAND(
        mask - (1 << 64) if mask >> 63 else mask).alias("bucket")) for i, mask in enumerate(_masks())])
    dealt = codes.select("code", F.explode(sides).alias("s")).select("s.side", "s.bucket", "code")
    return dealt.repartition("side", "bucket").sortWithinPartitions("side", "bucket").mapInPandas(
        _bucket_links, "a long, b long")


def near_copies(docs: DataFrame) -> DataFrame:
    """Each document with its fingerprint and ``component_id``, the smallest doc_id that links of 3 bits reach.

    Words are lower-cased in A-Z and cut at ASCII white space.  Null and empty texts have fingerprint 0, linked like any
    other.  Repeated rows share a fingerprint.  Null doc_ids are ignored as names of a group: a group that has no other
    gets null.  An empty table gives no rows; other columns are ignored.  Exact copies meet as one fingerprint before
    any search, so a hot group costs one row per fingerprint.
    """
    marked = written(docs.select("doc_id", row_key("doc_id", "text").alias("row"), fingerprints("text").alias("code")),
                     "fingerprints")
    distinct = written(marked.groupBy("code").agg(F.min("doc_id").alias("least")), "codes")
    roots = components(near_links(distinct.select("code")))
    named = distinct.join(roots, distinct["code"] == roots["node"], "left").select(
        "code", "least", F.coalesce("root", "code").alias("root"))
    ids = written(named.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    groups = written(named.join(ids, "root").select("code", "component_id", "root"), "groups")
    return marked.join(groups, "code").select(
        "doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id", "row", "root")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group, with all its columns: the smallest doc_id, then the smallest row key, null ids last."""
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    row = own_name(docs, "row")
    kept = written(near_copies(docs).groupBy("root").agg(F.min_by("row", place).alias(row)).select(row), "kept")
    met = docs.withColumn(row, row_key("doc_id", "text")).join(kept, row, "left_semi")
    return met.dropDuplicates([row]).drop(row)
