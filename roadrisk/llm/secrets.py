"""Secret scans by patterns and by a battery of randomness tests, in column expressions only.

Three base patterns give spans by themselves.  Beyond them, every long run of key-like characters is tested: its
encoding is inferred from the characters it uses, and under the hypothesis that the characters are drawn evenly from
that alphabet it gets a chi-squared test of uniformity, a runs test and a test of serial correlation.  Fisher's method
combines the three p-values.  The Benjamini-Hochberg rule, applied within bands of encoding and length over the whole
corpus, then decides which runs are *not* random: words and names go, and in a band full of words the limit is strict,
while a band of mostly random runs loses few of them.  Runs too short for their alphabet to tell are never reported.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.shared import written
from .common import own_name, row_key
from .winnowing import let

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
RUN = r"[A-Za-z0-9+/_-]{20,}=*"  # an inner "=" ends a run: a name and its value are two
# Parts of a run that fits no alphabet: keys joined to names or paths, with the signs of either base64 or of neither.
PARTS = (r"[^/]{20,}", r"[^_-]{20,}", r"[^_/-]{20,}")
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 6
MASK = "*"

# Alphabets in the order of their inference, with the least length at which a word is told from a key.
ALPHABETS = (
    ("hex", "0123456789abcdef", 20),
    ("upper hex", "0123456789ABCDEF", 20),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 24),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz", 24),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 24),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 28),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 28),
)
DISCOVERY_RATE = 0.05
LEAST_P = 0.01  # of a reported run, whatever its band
BAND = 8  # characters
SPAN = "struct<start:int,end:int,n:int>"
PART = 256  # values that a fold gathers at a time
BLOCK = 1024  # code points of a text that are cut at a time
FAR = 2 ** 31 - 1
P_STEPS = 20  # steps of the p-values' scale for a factor of ten
P_SCALE = 30  # factors of ten


def _gathered(items: Column, kind: str, step: Callable[[Column, Column], Column]) -> Column:
    """The values that a fold gives off, in time linear in the items.

    ``step`` turns a state, at first 0, and an item into a struct of the next state ``at`` and a ``value``, null for none.
    Values go into parts of bounded size, since each append copies its array.  Each value waits for one step, so that no
    expression is used twice and no lambda returns what has been gathered, which would copy all of it.
    """
    begin = F.struct(F.lit(0).alias("at"), F.lit(None).cast(kind).alias("value"),
                     F.array().cast(f"array<{kind}>").alias("part"), F.array().cast(f"array<array<{kind}>>").alias("parts"))

    def merge(held: Column, item: Column) -> Column:
        next_, value = step(held["at"], item), held["value"]
        full = F.size(held["part"]) >= PART
        return F.struct(
            next_["at"].alias("at"), next_["value"].alias("value"),
            F.when(full, F.array().cast(f"array<{kind}>")).when(value.isNull(), held["part"]).otherwise(
                F.array_append(held["part"], value)).alias("part"),
            F.when(full, F.array_append(held["parts"], F.when(value.isNull(), held["part"]).otherwise(
                F.array_append(held["part"], value)))).otherwise(held["parts"]).alias("parts"))

    return F.aggregate(items, begin, merge, lambda held: F.concat(
        F.flatten(held["parts"]), held["part"], F.filter(F.array(held["value"]), lambda v: v.isNotNull())))


def _spans(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Start, end and length of the tested group of each match, leftmost and without overlap, in code points.

    The lazy gap before each match is captured as well, so positions are running sums.  The last gap ends at the end
    of the text, which keeps the search linear.
    """
    gapped = F.lit(rf"(?s)(.*?)(?:({pattern})|\z)")
    value = F.length if not value_group else None

    def located(gaps: Column, found: Column, values: Column) -> Column:
        def step(at: Column, i: Column) -> Column:
            start = at + F.length(F.get(gaps, i))
            end = start + F.length(F.get(found, i))
            span = F.struct(start.alias("start"), end.alias("end"), F.length(F.get(values, i)).alias("n"))
            return F.struct(end.alias("at"), F.when(end > start, span).alias("value"))

        return _gathered(F.sequence(F.lit(0), F.size(gaps) - 1), SPAN, step)

    group = 2 if value is not None else 2 + value_group
    every = let(F.regexp_extract_all(text, gapped, F.lit(1)), lambda gaps: let(
        F.regexp_extract_all(text, gapped, F.lit(2)), lambda found: let(
            F.regexp_extract_all(text, gapped, F.lit(group)) if group != 2 else found,
            lambda values: located(gaps, found, values))))
    return F.when(F.regexp_like(text, F.lit(pattern)), every).otherwise(F.array().cast(f"array<{SPAN}>"))


def _blocks(text: Column) -> Column:
    """The text in blocks of a fixed number of code points, so that a cut need not count from the text's start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` up to ``end``."""
    def part(i: Column) -> Column:
        low, high = F.greatest(start - i * BLOCK, F.lit(0)), F.least(end - i * BLOCK, F.lit(BLOCK))
        return F.substring(F.get(blocks, i), low + 1, high - low)

    first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
    return F.when(end > start, F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise(F.lit(""))


def _kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """All spans of the three patterns as (start, number of the kind, end), in this order."""
    assign = F.filter(_spans(text, ASSIGN, 1), lambda s: s["n"] >= MIN_VALUE)
    return F.array_sort(F.concat(_kind(assign, 0), _kind(_spans(text, ACCESS), 1), _kind(_spans(text, HEX), 2)))


# -- the battery -----------------------------------------------------------------------------------------------------

# Coefficients of a published approximation of erfc, whose relative error is below 1.2e-7 everywhere.
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587,
        -0.82215223, 0.17087277)


def upper_tail(z: Column) -> Column:
    """The chance that a standard normal value exceeds ``z``."""
    def erfc(x: Column) -> Column:
        t = 1 / (1 + F.abs(x) / 2)
        tail = t * F.exp(-x * x + reduce(lambda acc, c: acc * t + F.lit(c), reversed(ERFC[:-1]), F.lit(ERFC[-1])))
        return F.when(x >= 0, tail).otherwise(2 - tail)

    return let(z, lambda v: erfc(v / F.lit(2 ** 0.5)) / 2)


def chi_squared_tail(x: Column, freedom: Column | int) -> Column:
    """Upper tail of the chi-squared distribution by the cube-root approximation to the normal one."""
    k = F.lit(2.0 / 9.0) / freedom
    return upper_tail((F.pow(F.greatest(x, F.lit(0.0)) / freedom, F.lit(1.0 / 3.0)) - (1 - k)) / F.sqrt(k))


def _uniformity(places: Column, symbols: Column) -> Column:
    """Chi-squared test of even use, over at most n / 2 classes of neighbouring symbols so that each expects two."""
    n = F.size(places)
    classes = F.least(symbols, F.greatest(F.lit(2), F.floor(n / 2).cast("int")))

    def statistic(c: Column) -> Column:
        def cell(j: Column) -> Column:
            low, high = F.ceil(j * symbols / c), F.ceil((j + 1) * symbols / c)
            seen = F.size(F.filter(places, lambda p: (p >= low) & (p < high)))
            expected = n * (high - low) / symbols
            return (seen - expected) * (seen - expected) / expected

        cells = F.transform(F.sequence(F.lit(0), c - 1), cell)
        return chi_squared_tail(F.aggregate(cells, F.lit(0.0), lambda a, x: a + x), c - 1)

    return let(classes, statistic)


def _letter_classes(token: Column, symbols: Column, digits: Column, upper: Column, lower: Column) -> Column:
    """Chi-squared test of the shares of digits, capitals and small letters, where the alphabet has two of them."""
    n = F.length(token)

    def part(pattern: str, size: Column) -> Column:
        seen = n - F.length(F.regexp_replace(token, pattern, ""))
        expected = n * size / symbols
        return F.when(size > 0, F.try_divide((seen - expected) * (seen - expected), expected)).otherwise(F.lit(0.0))

    kinds = (digits > 0).cast("int") + (upper > 0).cast("int") + (lower > 0).cast("int")
    total = part("[0-9]", digits) + part("[A-Z]", upper) + part("[a-z]", lower)
    return F.when(kinds > 1, chi_squared_tail(total, kinds - 1)).otherwise(F.lit(1.0))


def _runs(places: Column, symbols: Column) -> Column:
    """Two-sided test of the number of runs above and below the middle of the alphabet; p is 1 if a side is empty."""
    n = F.size(places).cast("double")

    def of(high: Column) -> Column:
        turns = F.size(F.filter(F.sequence(F.lit(1), F.size(high) - 1), lambda i: F.get(high, i) != F.get(high, i - 1)))
        a = F.size(F.filter(high, lambda h: h)).cast("double")
        mean = 2 * a * (n - a) / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        return F.when(spread > 0, 2 * upper_tail(F.try_divide(F.abs(turns + 1 - mean), F.sqrt(spread)))).otherwise(F.lit(1.0))

    return let(F.transform(places, lambda p: 2 * p >= symbols), of)


def _serial(places: Column) -> Column:
    """Two-sided test of the correlation of neighbours; p is 1 if all characters are the same."""
    n = F.size(places).cast("double")

    def of(mean: Column) -> Column:
        square = F.aggregate(places, F.lit(0.0), lambda a, p: a + (p - mean) * (p - mean))
        product = F.aggregate(F.sequence(F.lit(1), F.size(places) - 1), F.lit(0.0), lambda a, i: a + (
            F.get(places, i) - mean) * (F.get(places, i - 1) - mean))
        z = (F.try_divide(product, square) + 1 / n) * F.sqrt(n)
        return F.when(square > 0, 2 * upper_tail(F.abs(z))).otherwise(F.lit(1.0))

    return let(F.aggregate(places, F.lit(0.0), lambda a, p: a + p) / n, of)


def encoding_of(token: Column) -> Column:
    """Number of the first alphabet that holds all characters of the token, padding left off; null if none does."""
    def within(alphabet: str) -> Column:
        return F.length(F.translate(token, alphabet, "")) == 0

    return F.coalesce(*[F.when(within(chars), F.lit(i)) for i, (_, chars, _) in enumerate(ALPHABETS)])


def _by_encoding(encoding: Column, values: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), encoding)


def battery(token: Column, encoding: Column) -> Column:
    """Fisher's combination of the p-values of all tests of one token in its encoding."""
    alphabets = [chars for _, chars, _ in ALPHABETS]
    symbols = _by_encoding(encoding, [len(a) for a in alphabets])
    shares = [_by_encoding(encoding, [sum(map(test, a)) for a in alphabets])
              for test in (str.isdigit, str.isupper, str.islower)]
    alphabet = _by_encoding(encoding, alphabets)
    places = F.transform(F.split(token, ""), lambda c: F.instr(alphabet, c) - 1)

    def combined(at: Column) -> Column:
        even = F.least(F.lit(1.0), 2 * F.least(_uniformity(at, symbols), _letter_classes(token, symbols, *shares)))
        tests = [even, F.least(F.lit(1.0), _runs(at, symbols)), F.least(F.lit(1.0), _serial(at))]
        logs = reduce(lambda a, b: a + b, [-2 * F.ln(F.greatest(p, F.lit(1e-300))) for p in tests])
        return chi_squared_tail(logs, 2 * len(tests))

    return let(F.filter(places, lambda p: p >= 0), combined)


def _untouched(runs: Column, base: Column) -> Column:
    """The runs that no base span touches: one pass knows the spans that begin before a run, one those that begin in it."""
    events = F.array_sort(F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("run"), s["end"].alias("end"),
                                             F.lit(0).alias("n"))),
        F.transform(runs, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("run"), s["end"].alias("end"),
                                             s["n"].alias("n")))))

    def after(at: Column, e: Column) -> Column:  # the state is the farthest end of a span
        return F.struct(F.when(e["run"] == 1, at).otherwise(F.greatest(at, e["end"])).alias("at"),
                        F.when((e["run"] == 0) | (at <= e["start"]), e).alias("value"))

    def before(at: Column, e: Column) -> Column:  # the state is FAR less the nearest start of a span
        span = F.struct(e["start"].alias("start"), e["end"].alias("end"), e["n"].alias("n"))
        return F.struct(F.when(e["run"] == 1, at).otherwise(F.greatest(at, FAR - e["start"])).alias("at"),
                        F.when((e["run"] == 1) & (FAR - at >= e["end"]), span).alias("value"))

    kept = _gathered(events, "struct<start:int,run:int,end:int,n:int>", after)
    return F.when((F.size(base) == 0) | (F.size(runs) == 0), runs).otherwise(
        F.reverse(_gathered(F.reverse(kept), SPAN, before)))


def tested_runs(text: Column, base: Column) -> Column:
    """Runs that no base span touches: start, end, encoding, band of length and combined p-value."""
    free = let(_spans(text, RUN), lambda runs: _untouched(runs, base))

    def cut(blocks: Column, s: Column) -> Column:
        def part(run: Column, p: Column) -> Column:
            token = F.rtrim(F.substring(run, p["start"] + 1, p["end"] - p["start"]), F.lit("="))
            return let(token, lambda t: F.struct(
                (s["start"] + p["start"]).alias("start"), (s["start"] + p["end"]).alias("end"), t.alias("token"),
                encoding_of(t).alias("encoding"), F.length(t).alias("n")))

        def parts(run: Column) -> Column:
            whole = F.array(F.struct(F.lit(0).alias("start"), F.length(run).alias("end"), F.length(run).alias("n")))
            split = F.array_distinct(F.concat(*[_spans(run, pattern) for pattern in PARTS]))
            return F.transform(F.when(encoding_of(F.rtrim(run, F.lit("="))).isNotNull(), whole).otherwise(split),
                               lambda p: part(run, p))

        return let(_cut(blocks, s["start"], s["end"]), parts)

    def tested(t: Column) -> Column:
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["encoding"].alias("encoding"),
                        t["n"].alias("n"), battery(t["token"], t["encoding"]).alias("p"))

    cuts = let(free, lambda runs: let(F.when(F.size(runs) > 0, _blocks(text)), lambda blocks: F.transform(
        runs, lambda s: cut(blocks, s))))
    least = [n for _, _, n in ALPHABETS]
    long = F.filter(F.flatten(cuts), lambda t: t["encoding"].isNotNull()
                    & (t["n"] >= _by_encoding(t["encoding"], least)))
    return F.transform(long, tested)


def _random_runs(tokens: DataFrame) -> DataFrame:
    """The runs that the Benjamini-Hochberg rule does not call ordered in their band.

    p-values are counted in steps of a logarithmic scale, each taken at its upper end, so the rule needs one small row
    per band and step instead of a global sort.
    """
    step = F.floor(-F.log10(F.greatest("p", F.lit(10.0 ** -P_SCALE))) * P_STEPS).cast("int")
    placed = tokens.withColumn("band", F.floor(F.col("n") / BAND)).withColumn("step", step)
    counts = placed.groupBy("encoding", "band", "step").agg(F.count(F.lit(1)).alias("k"))
    band = Window.partitionBy("encoding", "band")
    ordered = band.orderBy(F.col("step").desc())
    rates = counts.select("encoding", "band", "step", F.sum("k").over(ordered).alias("upto"),
                          F.sum("k").over(band).alias("all"))
    passed = F.pow(F.lit(10.0), -F.col("step") / P_STEPS) <= DISCOVERY_RATE * F.col("upto") / F.col("all")
    limits = written(rates.groupBy("encoding", "band").agg(F.min(F.when(passed, F.col("step"))).alias("limit")), "limits")
    return placed.join(limits, ["encoding", "band"]).where(
        (F.col("p") >= LEAST_P) & (F.col("limit").isNull() | (F.col("step") < F.col("limit"))))


def scan(docs: DataFrame) -> DataFrame:
    """Per document its base spans and all spans, each an array of (start, kind, end) in code points, end exclusive.

    Null and empty texts have no spans.  Repeated rows are scanned alike and count each in their bands.  An empty table
    gives no rows; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    both = let(text, lambda t: let(base_spans(t), lambda b: F.struct(
        b.alias("base"), tested_runs(t, b).alias("runs"))))
    marked = written(docs.select("doc_id", row_key("doc_id", "text").alias("row"), both.alias("s"))
                     .select("doc_id", "row", "s.*"), "scan")
    tokens = marked.select("row", F.explode("runs").alias("t")).select("row", "t.*")
    random = _random_runs(tokens).groupBy("row").agg(F.collect_set(F.struct(
        "start", F.lit(3).alias("kind"), "end")).alias("random"))
    return marked.join(random, "row", "left").select(
        "doc_id", "row", "base", F.when(F.col("random").isNull(), F.col("base")).otherwise(
            F.array_sort(F.concat("base", "random"))).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each character of a span replaced by ``*``; its length stays.  Spans go by their start."""
    def of(blocks: Column) -> Column:
        def step(at: Column, s: Column) -> Column:
            start, end = F.greatest(at, s["start"]), F.greatest(at, s["end"])
            return F.struct(end.alias("at"), F.concat(_cut(blocks, at, start), F.repeat(F.lit(MASK), end - start)).alias("value"))

        def rest(edge: Column) -> Column:
            return F.concat(F.array_join(_gathered(spans, "string", step), ""), _cut(blocks, edge["from"], edge["to"]))

        return let(F.struct(F.array_max(F.transform(spans, lambda s: s["end"])).alias("from"),
                            F.length(text).alias("to")), rest)

    return F.when(F.size(spans) == 0, text).otherwise(let(_blocks(text), of))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every found secret masked, all columns and rows kept."""
    row, spans = own_name(docs, "row"), own_name(docs, "spans")
    found = written(scan(docs).where("size(spans) > 0").select(F.col("row").alias(row), F.col("spans").alias(spans))
                    .dropDuplicates([row]), "secrets")
    met = docs.withColumn(row, row_key("doc_id", "text")).join(found, row, "left")
    return met.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(
        masked(F.col("text"), F.col(spans)))).drop(row, spans)
