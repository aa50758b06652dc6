"""Secret scans: fixed patterns and a battery of randomness tests.

Three patterns name the base spans: assignments to a secret's name, access keys
and long hexadecimal runs. Beside them, long tokens of letters and digits are
tested for randomness. A token's encoding is the smallest alphabet that holds
it. Three statistics are taken of its symbols in that alphabet:

* chi-squared against the uniform alphabet: writing repeats its frequent letters;
* runs of one class of characters (digits, lower case, upper case, signs):
  writing and identifiers change classes seldom;
* the serial correlation of neighbouring symbols: classes that persist, and
  sequences, correlate.

Each has a mean and a variance, by the token's length, for random tokens and
for ordinary writing. A token must pass as random in all three tests. How
unlikely ordinary writing of its length would look as random is a p-value for
each test; the three are combined by Fisher's method. The false-discovery rate
of what is reported is controlled by Benjamini and Hochberg's procedure within
each encoding and class of lengths, over the tokens of all documents: p-values
are rounded up to steps, so that a count for each step is enough.

Everything is DataFrame expressions.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.common import stored

KINDS = ("assign", "access", "hex", "random")


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c in string.ascii_lowercase else c for c in word)


#: The base patterns. Runs of a class are taken whole, so a least length may stand in the pattern itself.
ASSIGN = (
    "(" + "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
#: Characters of an assigned value at least.
LEAST_VALUE = 8

#: Tokens that are tested: so many characters at least, with a letter and a digit.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
DIGITS, LOWER, UPPER = string.digits, string.ascii_lowercase, string.ascii_uppercase


@dataclass(frozen=True)
class Encoding:
    """An alphabet and what ordinary writing in it is like."""

    pattern: str
    alphabet: str
    #: Chance that two symbols of ordinary writing are equal.
    collision: float
    #: Chance that neighbours in ordinary writing are of different classes.
    changes: float

    @property
    def excess(self) -> float:
        """What a symbol of ordinary writing adds to chi-squared."""
        return len(self.alphabet) * self.collision - 1

    @property
    def random_changes(self) -> float:
        shares = [sum(c in part for c in self.alphabet) / len(self.alphabet) for part in (DIGITS, LOWER, UPPER, "+/")]
        return 1 - sum(s * s for s in shares)


#: From the smallest alphabet on; symbols are compared in lower case where case does not matter.
ENCODINGS = (
    Encoding("^([0-9a-f]+|[0-9A-F]+)$", DIGITS + LOWER[:6], 0.1, 0.15),
    Encoding("^[A-Z2-7]+$", UPPER + DIGITS[2:8], 0.065, 0.15),
    Encoding("^([0-9a-z]+|[0-9A-Z]+)$", DIGITS + LOWER, 0.065, 0.15),
    Encoding("^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER, 0.065, 0.33),
    Encoding("", UPPER + LOWER + DIGITS + "+/", 0.065, 0.33),
)
#: Serial correlation of ordinary writing.
CORRELATION = 0.4
#: Standard deviations from the mean of random tokens within which a token passes as random.
PASS = 4.0
#: Steps of p-values in a factor of ten, and the smallest p-value that is told apart, as a power of ten.
STEPS, SMALLEST = 8, 100
#: Share of false ones among the reported tokens.
RATE = 0.01
#: Rational approximation of the normal tail.
TAIL_SCALE = 0.2316419
TAIL = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
BLOCK = 256


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _simple_sums(values: Column) -> Column:
    start = F.struct(F.lit(0).alias("total"), F.expr("cast(array() as array<int>)").alias("sums"))

    def step(state: Column, value: Column) -> Column:
        total = (state["total"] + value).cast("int")
        return F.struct(total.alias("total"), F.concat(state["sums"], F.array(total)).alias("sums"))

    return F.aggregate(values, start, step, lambda state: state["sums"])


def running_sums(values: Column) -> Column:
    """Sums of an array of ints up to and with each place; in blocks, as a state that holds an array is copied at each step."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
        lambda n: _simple_sums(F.slice(values, n * BLOCK + 1, F.lit(BLOCK))),
    )

    def joined(sums: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), _simple_sums(F.transform(sums, lambda s: F.element_at(s, -1))))
        moved = lambda s, first: F.transform(s, lambda x: x + first)
        return bind(before, lambda b: F.flatten(F.transform(sums, lambda s, n: bind(F.element_at(b, n + 1), lambda first: moved(s, first)))))

    return F.when(F.size(values) == 0, F.expr("cast(array() as array<int>)")).otherwise(bind(blocks, joined))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost matches that do not overlap: (start, end, text, value), in code points; ``value`` is the given group."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.expr("cast(array() as array<struct<start:int,end:int,text:string,value:string>>)")

    def located(texts: Column) -> Column:
        lengths = F.transform(texts, F.length)
        gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), F.lit(1), F.size(texts))
        steps = F.zip_with(gaps, F.concat(F.array(F.lit(0)), F.slice(lengths, F.lit(1), F.size(texts) - 1)), lambda a, b: a + b)
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else texts
        return F.transform(
            F.arrays_zip(running_sums(steps).alias("start"), texts.alias("text"), values.alias("value")),
            lambda m: F.struct(m["start"], (m["start"] + F.length(m["text"])).alias("end"), m["text"], m["value"]),
        )

    return bind(found, lambda texts: F.when(F.size(texts) == 0, none).otherwise(located(texts)))


def _span(kind: str) -> Callable[[Column], Column]:
    number = KINDS.index(kind)
    return lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"))


def base_spans(text: Column) -> Column:
    """(start, kind, end) of the three patterns' matches, in order."""
    assigned = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= LEAST_VALUE)
    return F.array_sort(
        F.concat(
            F.transform(assigned, _span("assign")),
            F.transform(matches(text, ACCESS), _span("access")),
            F.transform(matches(text, HEX), _span("hex")),
        )
    )


def log_tail(z: Column) -> Column:
    """Logarithm of the chance that a normal variable exceeds z."""

    def upper(x: Column) -> Column:
        t = 1 / (1 + TAIL_SCALE * x)
        series = F.lit(0.0)
        for c in reversed(TAIL):
            series = (series + c) * t
        return -x * x / 2 - math.log(2 * math.pi) / 2 + F.log(series)

    return bind(z, lambda x: F.when(x >= 0, upper(x)).otherwise(F.log(1 - F.exp(upper(-x)))))


def _by_encoding(encoding: Column, value: Callable[[Encoding], float | str]) -> Column:
    return F.array(*[F.lit(value(e)) for e in ENCODINGS])[encoding]


def tested(token: Column) -> Column:
    """(encoding, lengths, level) of a token: its alphabet, the class of its length, and its p-value in steps (0: not random)."""
    core = F.regexp_replace(token, "=+$", "")
    encoding = F.lit(len(ENCODINGS) - 1)
    for n in range(len(ENCODINGS) - 2, -1, -1):
        encoding = F.when(core.rlike(ENCODINGS[n].pattern), n).otherwise(encoding)

    def symbols(encoding: Column) -> Column:
        plain = F.translate(core, "-_", "+/")
        return F.when(encoding.isin(0, 2), F.lower(plain)).otherwise(plain)

    def of_encoding(encoding: Column) -> Column:
        return bind(symbols(encoding), lambda s: bind(F.split(s, ""), lambda chars: of_symbols(encoding, s, chars)))

    def of_symbols(encoding: Column, s: Column, chars: Column) -> Column:
        alphabet = _by_encoding(encoding, lambda e: e.alphabet)
        squares = F.aggregate(
            F.array_distinct(chars),
            F.lit(0.0),
            lambda total, c: total + F.pow((F.length(s) - F.length(F.replace(s, c, F.lit("")))).cast("double"), F.lit(2.0)),
        )
        classes = F.translate(s, LOWER + UPPER + DIGITS + "/", "a" * 26 + "A" * 26 + "0" * 10 + "+")
        runs = F.length(F.regexp_replace(classes, r"a+|A+|0+|\++", "x"))
        places = F.transform(chars, lambda c: F.position(c, alphabet).cast("double"))
        return bind(places, lambda v: judged(encoding, F.size(v).cast("double"), squares, runs.cast("double"), correlation(v)))

    def correlation(v: Column) -> Column:
        add = lambda total, x: total + x
        following = F.concat(F.slice(v, F.lit(2), F.size(v) - 1), F.slice(v, F.lit(1), F.lit(1)))
        products = F.aggregate(F.zip_with(v, following, lambda a, b: a * b), F.lit(0.0), add)
        n, total, squares = F.size(v), F.aggregate(v, F.lit(0.0), add), F.aggregate(v, F.lit(0.0), lambda t, x: t + x * x)
        return bind(
            F.struct(total.alias("s"), (n * squares).alias("q"), (n * products).alias("p")),
            lambda x: F.when(x["q"] > x["s"] * x["s"], (x["p"] - x["s"] * x["s"]) / (x["q"] - x["s"] * x["s"])).otherwise(1.0),
        )

    def judged(encoding: Column, n: Column, squares: Column, runs: Column, serial: Column) -> Column:
        free = _by_encoding(encoding, lambda e: len(e.alphabet) - 1.0)
        excess = _by_encoding(encoding, lambda e: e.excess)
        rare, often = _by_encoding(encoding, lambda e: e.changes), _by_encoding(encoding, lambda e: e.random_changes)

        def decided(x: Column) -> Column:
            steps = x["n"] - 1
            random = (
                (x["chi"] - free <= PASS * F.sqrt(2 * free))
                & (F.abs(x["changes"] - steps * often) <= PASS * F.sqrt(steps * often * (1 - often)))
                & (F.abs(x["serial"]) <= PASS / F.sqrt(x["n"]))
            )
            uniform = (free + x["n"] * excess - x["chi"]) / F.sqrt(2 * free + 4 * x["n"] * excess)
            mixed = (x["changes"] - 0.5 - steps * rare) / F.sqrt(steps * rare * (1 - rare))
            unrelated = (CORRELATION - F.abs(x["serial"])) * F.sqrt(x["n"]) / (1 - CORRELATION**2)
            fisher = bind(
                -(log_tail(uniform) + log_tail(mixed) + log_tail(unrelated)),
                lambda y: (y - F.log(1 + y + y * y / 2)) * STEPS / math.log(10),
            )
            level = F.least(F.greatest(F.floor(fisher), F.lit(0)), F.lit(STEPS * SMALLEST)).cast("int")
            return F.struct(
                encoding.alias("encoding"),
                (F.length(F.bin(x["n"].cast("long"))) - 1).alias("lengths"),
                F.when(random, level).otherwise(0).alias("level"),
            )

        chi = squares * (free + 1) / n - n
        return bind(F.struct(n.alias("n"), chi.alias("chi"), (runs - 1).alias("changes"), serial.alias("serial")), decided)

    return bind(encoding, of_encoding)


def tokens(text: Column) -> Column:
    """(start, end, encoding, lengths, level) of every token that is tested."""
    mixed = F.filter(matches(text, TOKEN), lambda m: m["text"].rlike("[0-9]") & m["text"].rlike("[A-Za-z]"))

    def with_test(m: Column) -> Column:
        return bind(tested(m["text"]), lambda t: F.struct(m["start"], m["end"], t["encoding"], t["lengths"], t["level"]))

    return F.transform(mixed, with_test)


def thresholds(counts: DataFrame, rate: float = RATE) -> DataFrame:
    """The least level that may be reported, of (encoding, lengths) that have one, out of rows (encoding, lengths, level, n).

    Of N tokens, k at a level or above: the level may stand where N times its
    p-value is at most ``rate`` times k.
    """
    stratum = Window.partitionBy("encoding", "lengths")
    above = stratum.orderBy(F.desc("level"))
    chance = F.pow(F.lit(10.0), -F.col("level") / F.lit(float(STEPS)))
    return (
        counts.withColumns({"k": F.sum("n").over(above), "all": F.sum("n").over(stratum)})
        .where((F.col("level") > 0) & (F.col("all") * chance <= rate * F.col("k")))
        .groupBy("encoding", "lengths")
        .agg(F.min("level").alias("level"))
    )


def scan_secrets(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """One row per document: doc_id, base and spans, arrays of (start, kind, end) in code points, end exclusive.

    ``kind`` counts in KINDS; both are ordered by start, then kind. ``base`` are
    the spans of the patterns, ``spans`` those and the tokens reported as random.
    A token may be both. Null, empty and blank texts have none. Rows that
    repeat an id, equal or not, are documents of their own, and the tokens of
    all of them count. An empty table gives no rows; other columns are not
    looked at. Tokens are compared with all others of the table: what is
    reported of a document can depend on the rest, the base spans cannot.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    scanned = stored(
        documents.select(F.col(id_col).alias("doc_id"), base_spans(text).alias("base"), tokens(text).alias("tokens")), "secret-scan"
    )
    counts = scanned.select(F.explode("tokens").alias("t")).groupBy("t.encoding", "t.lengths", "t.level").agg(F.count(F.lit(1)).alias("n"))
    # at most one row for each encoding and power of two
    least = thresholds(counts, rate).collect()
    reported = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    if least:
        key = lambda encoding, lengths: encoding * 64 + lengths
        levels = F.create_map(*[F.lit(x) for row in least for x in (key(row.encoding, row.lengths), row.level)])
        found = F.filter("tokens", lambda t: t["level"] >= F.try_element_at(levels, key(t["encoding"], t["lengths"])))
        reported = F.transform(found, _span("random"))
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", reported)).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
