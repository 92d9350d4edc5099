"""Alignment of two tokenizers over the same text, and how often token pairs meet in the corpus.

Both tokenizers spell the same bytes, so each token has a byte offset where it ends.  Offsets where tokens of both sides
end cut a text into groups; tokens of a group are linked with each other.

The groups of a batch are found on its two arrays of end offsets by skipping along diagonals.  As long as tokens match
one to one, the places ``i`` and ``j`` keep their shift ``j - i``: slices of both arrays at this shift are compared,
each twice as long as the last, and the first that differs is halved down to the end of the stretch.  There the two
places walk on to the next common end, an irregular group, and go on with the shift they then have.

Texts are cut into words at single spaces between other characters, where both tokenizers always start a new token, and
each worker remembers the tokens of the words it has met.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.shared import scratch_path
from .common import chunks, run_sums

MODEL_A, MODEL_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CHUNK = 1_000_000  # bytes of text aligned together
REMEMBERED = 600_000  # words after which a worker forgets all it knows; limits memory, not results
LINKS_AT_ONCE = 4_000_000  # links spelt out at a time
FREQUENT = 1 << 16  # at most so many pairs are counted as frequent and broadcast
ID_BITS = 21
FIRST = 8  # tokens in the first slice compared at a shift
# A space that stands alone between characters that are no white space starts a token on both sides.
CUT = re.compile(r"(?<=\S)(?= \S)")
NESTED = "array<struct<a:array<int>,b:array<int>>>"
SCHEMA = "_row long, part int, n_a long, n_b long, n_groups long, groups {}, pairs array<long>, times array<long>"


def _byte_alphabet() -> dict[str, int]:
    """Characters that byte-level vocabularies write for bytes: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


GROUPS = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))


class Words:
    """Tokens of words under both tokenizers: flat arrays of ids and widths, and the place of each word in them."""

    def __init__(self, model_a: bytes, model_b: bytes) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(model_a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        byte = _byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, number in vocab.items():
            self.bytes_a[number] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        plain = [i for i in range(len(pieces)) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        if any(not re.fullmatch(f"{MARK}*[^{MARK}]*", pieces[i]) for i in plain):
            raise ValueError("a piece crosses the start of a word")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers()
        self.fits = np.zeros(0, bool)
        self.sides = [_Grown(), _Grown()]

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of each word; new ones are tokenized together."""
        known = self.known
        out = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        if known.new:
            new, known.new = known.new, []
            raw = [w.encode() for w in new]
            size = np.fromiter(map(len, raw), np.int64, len(raw))
            whole = b"".join(raw)
            ids_a = list(chain.from_iterable(e.ids for e in self.a.encode_batch_fast(joined(new), add_special_tokens=False)))
            if b"".join(map(self.bytes_a.__getitem__, ids_a)) == whole:
                fits = self.sides[0].add(ids_a, self.bytes_a, ends=np.cumsum(size))
            else:  # one by one, to see which words differ
                rows = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)]
                fits = self._apart(0, rows, raw, self.bytes_a)
            rows = self.b.encode([w[1:] for w in new], num_threads=1)
            self.fits = np.concatenate([self.fits, fits & self._apart(1, rows, raw, self.bytes_b, whole, size)])
        return out

    def _apart(self, side: int, rows: list[list[int]], raw: list[bytes], spelt: list[bytes], whole: bytes | None = None,
               size: np.ndarray | None = None) -> np.ndarray:
        flat = list(chain.from_iterable(rows))
        width = self.sides[side].add(flat, spelt, many=np.fromiter(map(len, rows), np.int64, len(rows)))
        if whole is not None and (width == size).all() and b"".join(map(spelt.__getitem__, flat)) == whole:
            return np.ones(len(rows), bool)
        return np.array([b"".join(map(spelt.__getitem__, row)) == word for row, word in zip(rows, raw)], dtype=bool)


def joined(words: list[str], most: int = 200) -> list[str]:
    """The words in order, up to ``most`` in a string; only such are joined that the tokenizers keep apart."""
    out, held = [], []
    for word in words:
        plain = word[1:].strip() == word[1:] != ""
        if held and (not plain or len(held) == most):
            out.append("".join(held))
            held = []
        if plain:
            held.append(word)
        else:
            out.append(word)
    return [*out, "".join(held)] if held else out


class _Numbers(dict):
    """Numbers of words from 0 on; a word not met before gets the next one and is listed in ``new``."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class _Grown:
    """Rows of ids and their widths in bytes, one after another."""

    def __init__(self) -> None:
        self.ids, self.width, self.first = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, flat: list[int], spelt: list[bytes], many: np.ndarray | None = None, ends: np.ndarray | None = None
            ) -> np.ndarray:
        """Append rows of ``many`` ids each and return their bytes, or rows that end at the byte offsets ``ends``: these fit."""
        ids = np.array(flat, dtype=np.int32)
        width = np.fromiter(map(len, spelt), np.int32, len(spelt))[ids]
        last = np.cumsum(many) if ends is None else np.searchsorted(np.cumsum(width, dtype=np.int64), ends) + 1
        self.ids, self.width = np.concatenate([self.ids, ids]), np.concatenate([self.width, width])
        self.first = np.concatenate([self.first, self.first[-1] + last])
        return np.ones(len(ends), bool) if many is None else run_sums(width.astype(np.int64), np.concatenate([[0], last]))

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and end offsets of the words one after another, and how many ids each has."""
        many = self.first[words + 1] - self.first[words]
        at = np.repeat(self.first[words] - np.cumsum(many) + many, many) + np.arange(many.sum())
        return self.ids[at], np.cumsum(self.width[at], dtype=np.int64), many


@lru_cache(maxsize=1)
def _words(model_a: bytes, model_b: bytes) -> Words:
    return Words(model_a, model_b)


def words_of(text: str) -> list[str]:
    """A space and the text, cut before spaces that stand alone between other characters."""
    words = text.split(" ")
    if "" in words or list(map(str.strip, words)) != words:
        return CUT.split(" " + text)
    return [" " + word for word in words]


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group of two rising arrays with the same last entry: where it ends in either array."""
    size = ends_a.dtype.itemsize
    a, b = ends_a.tobytes(), ends_b.astype(ends_a.dtype).tobytes()
    n, m = len(ends_a), len(ends_b)
    list_a, list_b = [*ends_a.tolist(), -1], [*ends_b.tolist(), -2]  # the last entries differ, so no walk goes beyond
    i, j, begin = 0, 0, 0
    stretches: list[int] = []  # groups whose last tokens keep a shift: first place, end in either array
    while i < n:
        # Token by token at first, then slices.
        near = i + FIRST
        while list_a[i] == list_b[j] and i < near:
            i += 1
            j += 1
        if i == near:
            width, most = FIRST, min(n - i, m - j)
            while width <= most and a[i * size:(i + width) * size] == b[j * size:(j + width) * size]:
                i, j, most = i + width, j + width, most - width
                width += width
            # The first difference is in the next ``width`` tokens, or there is none: halve down to it.
            width = min(width, most)
            while width:
                if a[i * size:(i + width) * size] == b[j * size:(j + width) * size]:
                    i, j, most = i + width, j + width, most - width
                    width = min(width, most)
                else:
                    width //= 2
        stretches += (begin, i, j)
        begin = i
        if i < n:
            end_a, end_b = list_a[i], list_b[j]
            while end_a != end_b:
                if end_a < end_b:
                    i += 1
                    end_a = list_a[i]
                else:
                    j += 1
                    end_b = list_b[j]
            # The group that ends here opens the stretch at the new shift.
            begin = i
            i += 1
            j += 1
    if begin < n:
        stretches += (begin, i, j)
    start, end, other = np.array(stretches, dtype=np.int64).reshape(-1, 3).T
    length, shift = end - start, other - end
    place = np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())
    return place + 1, place + 1 + np.repeat(shift, length)


def _spread(sizes: np.ndarray) -> np.ndarray:
    """0, 1, … up to each size, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _counted(key: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their times."""
    if not len(key):
        return key, np.zeros(0, np.int64)
    if times is None:
        key = np.sort(key)
    else:
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    total = np.diff(first, append=len(key)) if times is None else np.add.reduceat(times, first)
    return key[first], total


def links_of_text(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray
                  ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct pairs ``a << ID_BITS | b`` linked in one text, rising, and their links; in blocks of bounded size."""
    many_a, many_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    group_a = np.repeat(np.arange(len(cut_a)), many_a)
    group_b = np.repeat(np.arange(len(cut_b)), many_b)
    # Ids of a group once, with their number.
    key, times_b = _counted(group_b << ID_BITS | b)
    ids_b, first_b = key & ((1 << ID_BITS) - 1), np.searchsorted(key >> ID_BITS, np.arange(len(cut_b) + 1))
    key, times_a = _counted(a.astype(np.int64) << 32 | group_a)  # in the order of the ids
    ids_a, group = key >> 32, key & ((1 << 32) - 1)
    width = first_b[group + 1] - first_b[group]
    total = np.cumsum(width)
    at = 0
    while at < len(ids_a):
        to = int(np.searchsorted(total, (total[at - 1] if at else 0) + LINKS_AT_ONCE, side="right"))
        to = max(to, at + 1)
        if to < len(ids_a):  # all entries of an id stay together
            left = int(np.searchsorted(ids_a, ids_a[to], side="left"))
            to = left if left > at else int(np.searchsorted(ids_a, ids_a[at], side="right"))
        size = width[at:to]
        entry = np.repeat(np.arange(at, to), size)
        other = np.repeat(first_b[group[at:to]], size) + _spread(size)
        yield _counted(ids_a[entry] << ID_BITS | ids_b[other], times_a[entry] * times_b[other])
        at = to


def _links(batch: "_Aligned") -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Part number, texts, and the pairs, links and bounds of these texts."""
    sizes = (batch.many_a * batch.many_b)
    text = np.repeat(np.arange(len(batch.groups)), batch.groups)
    if sizes.sum() <= LINKS_AT_ONCE:
        group = np.repeat(np.arange(len(sizes)), sizes)
        nth = _spread(sizes)
        a = batch.a[(batch.cut_a - batch.many_a)[group] + nth // batch.many_b[group]]
        b = batch.b[(batch.cut_b - batch.many_b)[group] + nth % batch.many_b[group]]
        key, times = _counted((text[group] << 2 * ID_BITS) | (a.astype(np.int64) << ID_BITS) | b)
        yield (0, np.arange(len(batch.groups)), key & ((1 << 2 * ID_BITS) - 1), times,
               np.searchsorted(key >> 2 * ID_BITS, np.arange(len(batch.groups) + 1)))
        return
    edge = np.concatenate([[0], np.cumsum(batch.groups)])
    for t in range(len(batch.groups)):
        lo, hi = edge[t], edge[t + 1]
        parts = ()
        if hi > lo:
            begin_a, begin_b = batch.cut_a[lo] - batch.many_a[lo], batch.cut_b[lo] - batch.many_b[lo]
            parts = links_of_text(batch.a[begin_a:batch.cut_a[hi - 1]], batch.b[begin_b:batch.cut_b[hi - 1]],
                                  batch.cut_a[lo:hi] - begin_a, batch.cut_b[lo:hi] - begin_b)
        part = -1
        for part, (pairs, times) in enumerate(parts):
            yield part, np.array([t]), pairs, times, np.array([0, len(pairs)])
        if part < 0:
            yield 0, np.array([t]), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(2, np.int64)


class _Aligned:
    """Tokens and groups of some texts, those of one text after those of another."""

    def __init__(self, known: Words, texts: list[str | None]) -> None:
        words = [words_of(t) if t else [] for t in texts]
        flat = known.numbers(list(chain.from_iterable(words)))
        owner = np.repeat(np.arange(len(words)), [len(row) for row in words])
        if not known.fits[flat].all():
            fitting = np.bincount(owner[~known.fits[flat]], minlength=len(words)) == 0
            flat, owner = flat[fitting[owner]], owner[fitting[owner]]
        self.a, ends_a, many_a = known.sides[0].of(flat)
        self.b, ends_b, many_b = known.sides[1].of(flat)
        self.n_a, self.n_b = (np.bincount(owner, many, len(texts)).astype(np.int64) for many in (many_a, many_b))
        # Every text ends with a common end, so all texts of the batch are aligned as one.
        self.cut_a, self.cut_b = common_ends(ends_a, ends_b)
        self.many_a, self.many_b = np.diff(self.cut_a, prepend=0), np.diff(self.cut_b, prepend=0)
        self.groups = np.diff(np.searchsorted(self.cut_a, np.cumsum(self.n_a), side="right"), prepend=0)

    def nested(self, texts: np.ndarray) -> pa.Array:
        """The groups of each of these texts, which follow each other, as lists of both sides' ids."""
        edge = np.concatenate([[0], np.cumsum(self.groups)])
        lo, hi = edge[texts[0]], edge[texts[-1] + 1]
        sides = []
        for ids, cut, many in ((self.a, self.cut_a, self.many_a), (self.b, self.cut_b, self.many_b)):
            begin = cut[lo] - many[lo] if hi > lo else 0
            ends = cut[lo:hi] - begin
            sides.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                                  pa.array(ids[begin:begin + (ends[-1] if hi > lo else 0)])))
        groups = pa.StructArray.from_arrays(sides, names=["a", "b"])
        return pa.ListArray.from_arrays(pa.array((edge[texts[0]:texts[-1] + 2] - lo).astype(np.int32)), groups)


    def written(self, texts: np.ndarray) -> pa.Array:
        """The groups of these texts, which follow each other, as in ``spelt``: built as one run of bytes."""
        ids = np.empty(len(self.a) + len(self.b), np.int32)
        sign = np.full(len(ids), ord(","), np.uint8)
        # In a group the ids of A stand before those of B.
        at_a = np.arange(len(self.a)) + np.repeat(self.cut_b - self.many_b, self.many_a)
        at_b = np.arange(len(self.b)) + np.repeat(self.cut_a, self.many_b)
        ids[at_a], ids[at_b] = self.a, self.b
        sign[at_a[self.cut_a - 1]], sign[at_b[self.cut_b - 1]] = ord("|"), ord(";")
        size, digits = _digits(1 << max(16, int(ids.max(initial=0)).bit_length()))
        width = size[ids]
        end = np.cumsum(width + 1, dtype=np.int64)
        out = np.empty(end[-1] if len(end) else 0, np.uint8)
        out[end - 1] = sign
        for back, digit in enumerate(digits):  # from the last digit to the first
            some = np.flatnonzero(width > back)
            out[end[some] - 2 - back] = digit[ids[some]]
        edge = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])]
        text = out.tobytes().decode("ascii")
        return pa.array([text[edge[t]:max(edge[t], edge[t + 1] - 1)] for t in texts.tolist()], pa.string())


@lru_cache(maxsize=2)
def _digits(many: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """How many decimal digits each number below ``many`` has, and their signs from the last on."""
    numbers = np.arange(many)
    places = [10 ** k for k in range(len(str(many - 1)))]
    size = np.maximum(1, sum((numbers >= p).astype(np.int64) for p in places))
    return size, [(numbers // p % 10 + ord("0")).astype(np.uint8) for p in places]


def _aligned(batches: Iterator[pa.RecordBatch], model_a: bytes, model_b: bytes, text: bool = False) -> Iterator[pa.RecordBatch]:
    known = _words(model_a, model_b)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for lo, hi in chunks([t or "" for t in texts], CHUNK):
            if len(known.fits) > REMEMBERED:
                known.forget()
            found = _Aligned(known, texts[lo:hi])
            for part, at, pairs, times, bounds in _links(found):
                place, bounds = pa.array(at + lo), pa.array(bounds.astype(np.int32))
                if part:
                    groups = pa.nulls(len(at), pa.string() if text else GROUPS)
                else:
                    groups = found.written(at) if text else found.nested(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(place), batch.column("_row").take(place),
                     pa.array(np.full(len(at), part, np.int32)), pa.array(found.n_a[at]), pa.array(found.n_b[at]),
                     pa.array(found.groups[at]), groups,
                     pa.ListArray.from_arrays(bounds, pa.array(pairs)), pa.ListArray.from_arrays(bounds, pa.array(times))],
                    names=["doc_id", "_row", "part", "n_a", "n_b", "n_groups", "groups", "pairs", "times"])


def _read(path: str) -> bytes:
    """A vocabulary file, read by the driver and sent with the tasks; they have one or two megabytes."""
    with open(path, "rb") as file:
        return file.read()


def align(docs: DataFrame, path_a: str = MODEL_A, path_b: str = MODEL_B, text: bool = False) -> DataFrame:
    """Tokens of both tokenizers for a space and each whole text, in groups between common ends.

    Returns per row of ``docs`` a number ``_row``, doc_id, n_a, n_b, n_groups, ``groups`` (ids of both sides, in order; with
    ``text`` in the form of ``spelt``, which is made faster here) and the distinct linked ``pairs`` (``a << 21 | b``) with their links (``times``).  A text with very many links comes in several rows,
    numbered by ``part`` from 0, each with other pairs; the groups stand in part 0.  Null and empty texts, and texts that
    either tokenizer does not spell back byte for byte, have no tokens.  Repeated rows are separate rows; extra columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    work = partial(_aligned, model_a=_read(path_a), model_b=_read(path_b), text=text)
    return numbered.mapInArrow(work, f"doc_id {kind}, {SCHEMA.format('string' if text else NESTED)}")


def pair_counts(links: DataFrame) -> DataFrame:
    """Per pair of ``links`` (_row, pair): in how many rows it is linked (``docs``), and whether no pair of its A id has more."""
    counts = links.groupBy("pair").agg(F.count(F.lit(1)).alias("docs")).withColumn("id_a", F.shiftright("pair", ID_BITS))
    best = counts.groupBy("id_a").agg(F.max("docs").alias("most"))
    return counts.join(best, "id_a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def scored(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Rows of ``align`` (groups or what is made of them may be other columns) with n_links, n_best and count_sum.

    n_best are the links whose pair is linked in as many documents as any pair of its A id, count_sum adds up the pairs'
    documents over all links.  The pairs that hold at least one ``frequent``-th of all documents' pairs, so at most ``frequent`` many, are
    looked up in a broadcast table; only the rest is shuffled to its counts, and no key of that shuffle is hot.
    """
    spark = aligned.sparkSession
    path = scratch_path(spark, "aligned")
    aligned.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(aligned.schema).parquet(path)
    links = stored.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "_row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    counted = scratch_path(spark, "pair-counts")
    pair_counts(links).write.parquet(counted)
    counts = spark.read.schema("pair long, docs long, best boolean").parquet(counted)
    total = counts.agg(F.sum("docs")).first()[0] or 0
    common = F.col("docs") * F.lit(frequent) >= F.lit(total)
    hot, rare = F.broadcast(counts.where(common)), counts.where(~common)

    def summed(joined: DataFrame) -> DataFrame:
        return joined.groupBy("_row").agg(
            F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("docs")).alias("count_sum"))

    parts = summed(links.join(hot, "pair")).unionByName(
        summed(links.join(hot, "pair", "left_anti").join(rare.hint("merge"), "pair")))
    sums = parts.groupBy("_row").agg(*[F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")])
    return stored.where("part = 0").drop("pairs", "times", "part").join(sums, "_row", "left").withColumns(
        {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_links", "n_best", "count_sum")}).drop("_row")


def spelt(groups: str) -> Column:
    """Groups as text: ids of A, ``|``, ids of B, groups apart by ``;``."""
    def ids(side: Column) -> Column:
        return F.array_join(side.cast("array<string>"), ",")

    return F.array_join(F.transform(groups, lambda g: F.concat(ids(g["a"]), F.lit("|"), ids(g["b"]))), ";")
