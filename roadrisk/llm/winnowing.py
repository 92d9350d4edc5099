"""Benchmark decontamination by winnowing, in column expressions only.

The fingerprints of a text are the smallest hashes of its word k-grams within each run of ``WINDOW_GRAMS`` grams.  A
window of 13 words holds 9 grams of 5 words, so two texts that share a window share the smallest of its grams, and a
join on fingerprints misses no shared window.  Windows one after another mostly share theirs, so a text keeps one row
per run of windows.  Each meeting is then extended to the whole window, word by word, in the document.  An item of fewer than 13 words is one gram by itself (a window of one gram).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.shared import written
from .common import own_name, row_key

SPAN = 13
GRAM = 5
WINDOW_GRAMS = SPAN - GRAM + 1
MIN_SHARE = 20  # a document is contaminated if a twentieth of its words is hit
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: str) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD))


def _places(last: Column) -> Column:
    """0 .. last, or none if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _grams(hashes: Column, length: int) -> Column:
    return F.transform(_places(F.size(hashes) - length),
                       lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(length)]))


def _smallest(grams: Column) -> Column:
    """The smallest gram of each window of a text that has at least one."""
    return F.transform(_places(F.size(grams) - WINDOW_GRAMS),
                       lambda i: F.least(*[F.get(grams, i + j) for j in range(WINDOW_GRAMS)]))


def _runs(smallest: Column) -> Column:
    """Runs of windows with the same smallest gram: first and last window, gram."""
    starts = F.filter(_places(F.size(smallest) - 1),
                      lambda i: (i == 0) | (F.get(smallest, i) != F.get(smallest, i - 1)))
    return let(starts, lambda at: F.transform(at, lambda i, k: F.struct(
        i.alias("at"), (F.coalesce(F.get(at, k + 1), F.size(smallest)) - 1).alias("last"),
        F.get(smallest, i).alias("gram"))))


def fingerprints(words: Column, short: list[int]) -> Column:
    """The fingerprints of a text with the windows they stand for, and its grams of each length in ``short``."""
    def of(hashes: Column) -> Column:
        picked = let(_grams(hashes, GRAM), lambda g: let(_smallest(g), _runs))
        more = [let(_grams(hashes, n), lambda g: F.transform(g, lambda x, i: F.struct(
            i.alias("at"), i.alias("last"), x.alias("gram")))) for n in short]
        return F.concat(picked, *more) if more else picked

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def _windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """Distinct windows with their fingerprint; windows with their items; the lengths below 13."""
    items = benchmark.select("item_id", words_of("text").alias("words")).where("size(words) > 0")
    cut = items.select(
        "item_id", "words", F.least(F.size("words"), F.lit(SPAN)).alias("length"),
        F.explode(_places(F.size("words") - F.least(F.size("words"), F.lit(SPAN)))).alias("at"))
    cut = written(cut.select("item_id", "length", F.slice("words", F.col("at") + 1, F.col("length")).alias("words")),
                  "items").withColumn("window", F.array_join("words", " "))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    # A window of 13 words is known by its smallest gram, a shorter item by itself.
    gram = let(hashes, lambda h: F.when(F.size(h) == SPAN, F.array_min(_grams(h, GRAM))).otherwise(
        F.coalesce(*[F.when(F.size(h) == n, _grams(h, n)[0]) for n in range(1, SPAN)])))
    marked = cut.dropDuplicates(["window"]).select("window", "length", gram.alias("gram"))
    # At most twelve numbers.
    short = sorted(row[0] for row in cut.where(F.col("length") < SPAN).select("length").distinct().collect())
    return (written(marked, "windows"),
            written(cut.select("window", "item_id").distinct(), "window_items"), short)


def _covered(spans: Column) -> Column:
    """How many words lie in the union of spans (at, length)."""
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("end"))
    return F.aggregate(F.array_sort(spans), start, lambda held, span: F.struct(
        (held["words"] + F.greatest(F.lit(0), span["at"] + span["length"] - F.greatest(held["end"], span["at"]))
         ).alias("words"), F.greatest(held["end"], span["at"] + span["length"]).alias("end")))["words"]


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document its words, the words hit by benchmark windows, the items found and the verdict.

    Null and empty texts have no words and are clean; so are texts of an empty benchmark.  Items without words have no
    window; items without an id hit words but are not listed.  Repeated rows and repeated items count alike.  Other
    columns are ignored.  The stored windows are broadcast only if their real size allows.
    """
    windows, items, short = _windows(benchmark)
    # Written without texts: everything but the extension works on these rows.
    marked = written(docs.select("doc_id", row_key("doc_id", "text").alias("row"), words_of("text").alias("words"))
                     .select("doc_id", "row", F.size("words").cast("long").alias("n_words"),
                             fingerprints(F.col("words"), short).alias("prints")), "fingerprints")
    met = (marked.select("row", F.explode("prints").alias("p")).select("row", "p.*")
           .join(windows, "gram")
           .select("row", F.explode(F.sequence("at", "last")).alias("at"), "length", "window"))
    meetings = written(met.groupBy("row").agg(F.collect_set(F.struct("at", "length", "window")).alias("met")), "met")

    def extended(words: Column) -> Column:
        return F.filter("met", lambda m: F.array_join(F.slice(words, m["at"] + 1, m["length"]), " ") == m["window"])

    # Always a sort-merge join: its cost follows the input, whether or not the meetings would fit into a broadcast.
    hits = written(docs.select(row_key("doc_id", "text").alias("row"), "text").join(meetings.hint("merge"), "row")
                   .select("row", let(words_of("text"), extended).alias("hits")).where("size(hits) > 0"), "hits")
    spans = hits.groupBy("row").agg(F.max(_covered(F.transform("hits", lambda h: F.struct(h["at"], h["length"])))
                                          ).alias("n_hit"))
    found = (hits.select("row", F.explode(F.array_distinct(F.transform("hits", lambda h: h["window"]))).alias("window"))
             .join(items, "window").groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))
                                                                    ).alias("items")))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return marked.drop("prints").join(spans, "row", "left").join(found, "row", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), listed.alias("items"),
        ((n_hit > 0) & (MIN_SHARE * n_hit >= F.col("n_words"))).alias("contaminated"), "row")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    row = own_name(docs, "row")
    bad = written(contamination(docs, benchmark).where("contaminated").select(F.col("row").alias(row)).distinct(),
                  "contaminated")
    return docs.withColumn(row, row_key("doc_id", "text")).join(bad, row, "left_anti").drop(row)
