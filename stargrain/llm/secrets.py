"""Secret scans: base patterns, and a randomness test battery over other tokens, in DataFrame functions only.

Base kinds are found by pattern.  Other long tokens become candidates: an encoding is inferred for each
(hexadecimal, decimal, base32, letters, alphanumeric, base64 and its URL form, or all these symbols
mixed), and three tests ask whether the token can still be structured text of that encoding.  A sign of
equality is part of a token only as padding at its end, so a name and its value are tokens of their own:

* chi-squared: its alphabet use is less even than random use by as much as natural text's is;
* runs: the runs above and below the alphabet's middle are too few or too many;
* serial correlation: neighbouring symbols go together.

Each is an equivalence test whose null is "structured"; a token is random only if all three nulls are
rejected, so its p-value is the largest of the three.  False discoveries are controlled by the
Benjamini-Hochberg rule within classes of encoding and length (short tokens have little power and don't
spend the long ones' budget), on p-values rounded up to bins: the counts by class and bin are all that
is gathered, whatever the corpus.

Defined results: null counts as empty; a text without matches has zero counts and empty spans; spans of
the battery that touch a base span are left out; repeated rows each get a row; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stargrain.llm.common import cut, let, q
from stargrain.llm.spans import found, joined, labelled, normal_cdf, overlaps

# The contract's base patterns (fixed values).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS = 6
ACCESS = "AKIA[A-Z0-9]{16,}"  # 20 characters and more; shorter runs can hold no longer match
HEX = "[0-9a-f]{24,}"
# 20 characters and more, '=' at the end included (no more than two of the 20; no value may follow it)
SYMBOL, PADDING = "[A-Za-z0-9+/_-]", "(?![A-Za-z0-9+/_-])"
TOKEN = f"{SYMBOL}{{20,}}+(?:=++{PADDING})?|{SYMBOL}{{19}}=++{PADDING}|{SYMBOL}{{18}}={{2,}}+{PADDING}"

FALSE_DISCOVERY = 0.05
# Concentration of natural text: the sum of squared letter shares, as used in cryptanalysis.
NATURAL_COINCIDENCE = 0.0667
LEAST_EXCESS = 0.73  # 26 letters x that, less 1
RUNS_MARGIN, SERIAL_MARGIN = 0.35, 0.7
LENGTH_CLASSES = (28, 40, 64, 128)
BINS_PER_DECADE, DECADES = 20, 12

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# encoding: the pattern a token must have (the first that fits counts), and its alphabet
ENCODINGS = (
    ("decimal", "^[0-9]+$", DIGITS),
    ("hex", "^[0-9a-f]+(-[0-9a-f]+)*$", DIGITS + "abcdef"),
    ("hex_upper", "^[0-9A-F]+(-[0-9A-F]+)*$", DIGITS + "ABCDEF"),
    ("base32", "^(?=.*[2-7])[A-Z2-7]+=*$", UPPER + "234567"),
    ("lower", "^[a-z]+$", LOWER),
    ("upper", "^[A-Z]+$", UPPER),
    ("lower_digits", "^[a-z0-9]+$", LOWER + DIGITS),
    ("alphanumeric", "^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("base64", "^[A-Za-z0-9+/]+=*$", UPPER + LOWER + DIGITS + "+/"),
    ("base64_url", "^[A-Za-z0-9_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
    ("mixed", "^[A-Za-z0-9+/_-]+=*$", UPPER + LOWER + DIGITS + "+/-_"),
)


def _encoding(value: Column) -> tuple[Column, Column]:
    """(name, alphabet) of a token; the last encoding holds every token."""
    name, alphabet = F.lit(""), F.lit("")
    for n, pattern, letters in reversed(ENCODINGS):
        name = F.when(value.rlike(pattern), F.lit(n)).otherwise(name)
        alphabet = F.when(value.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    return name, alphabet


def battery(index: Column, symbols: Column) -> Column:
    """The token's p-value: the largest of the three tests over its symbols' places (1..symbols) in the alphabet."""
    n = F.size(index).cast("double")
    k = symbols.cast("double")

    def tests(s: Column) -> Column:
        excess = F.greatest(F.lit(LEAST_EXCESS), k * NATURAL_COINCIDENCE - 1)
        chi = k / n * s["squares"] - n
        centre, spread = k - 1 + n * excess, F.sqrt(2 * (k - 1 + 2 * n * excess))
        p_chi = normal_cdf((chi - centre) / spread)
        high, low = s["high"].cast("double"), n - s["high"]
        mean = 2 * high * low / n + 1
        sd = F.sqrt(F.greatest(F.lit(1e-9), (mean - 1) * (mean - 2) / F.greatest(F.lit(1.0), n - 1)))
        p_runs = F.when((high == 0) | (low == 0), F.lit(1.0)).otherwise(
            normal_cdf((F.abs(s["changes"] + 1 - mean) - RUNS_MARGIN * n) / sd))
        variance = s["sum2"] - s["sum"] * s["sum"] / n
        r = (s["lagged"] - s["sum"] * s["sum"] / n) / F.greatest(F.lit(1e-9), variance)
        p_serial = F.when(variance <= 0, F.lit(1.0)).otherwise(normal_cdf((F.abs(r) - SERIAL_MARGIN) * F.sqrt(n)))
        return F.greatest(p_chi, p_runs, p_serial)

    zero = F.lit(0).cast("bigint")
    middle = symbols / 2
    start = F.struct(zero.alias("sum"), zero.alias("sum2"), zero.alias("lagged"), zero.alias("high"), zero.alias("changes"), zero.alias("last"))

    def add(a: Column, x: Column) -> Column:
        changed = (a["last"] > 0) & ((a["last"] > middle) != (x > middle))
        return F.struct((a["sum"] + x).alias("sum"), (a["sum2"] + x * x).alias("sum2"), (a["lagged"] + a["last"] * x).alias("lagged"),
                        (a["high"] + (x > middle).cast("bigint")).alias("high"), (a["changes"] + changed.cast("bigint")).alias("changes"),
                        x.alias("last"))

    squares = F.aggregate(F.transform(F.sequence(F.lit(1), symbols), lambda c: F.size(F.filter(index, lambda x: x == c)).cast("bigint")),
                          zero, lambda a, c: a + c * c)
    sums = F.aggregate(index, start, add)
    whole = let(F.struct(sums.alias("s"), squares.alias("squares")), lambda t: tests(_Fields(t)))
    return F.when(symbols < 2, F.lit(1.0)).otherwise(whole)


class _Fields:
    """Field access to the sums and the squares of a token."""

    def __init__(self, t: Column):
        self.t = t

    def __getitem__(self, name: str) -> Column:
        return self.t["squares"].cast("double") if name == "squares" else self.t["s"][name].cast("double")


def candidates(text: Column) -> Column:
    """``array<struct<start, end, encoding, class, bin>>`` of the tokens of a text."""

    def tested(s: Column) -> Column:
        core = F.regexp_replace(F.rtrim(s["value"], F.lit("=")), F.when(s["encoding"].startswith("hex"), F.lit("-")).otherwise(F.lit("=")), F.lit(""))
        index = F.transform(F.filter(F.split(core, ""), lambda c: c != ""), lambda c: F.instr(s["alphabet"], c).cast("bigint"))
        p = let(index, lambda i: battery(i, F.length(s["alphabet"])))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"),
                        _length_class(F.length(core)).alias("size"), _bin(p).alias("bin"))

    def inferred(s: Column) -> Column:
        name, alphabet = _encoding(s["value"])
        return let(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), name.alias("encoding"), alphabet.alias("alphabet")), tested)

    return F.transform(found(text, TOKEN), inferred)


def _length_class(n: Column) -> Column:
    out = F.lit(len(LENGTH_CLASSES))
    for i in reversed(range(len(LENGTH_CLASSES))):
        out = F.when(n < LENGTH_CLASSES[i], F.lit(i)).otherwise(out)
    return out


def _bin(p: Column) -> Column:
    """Bins of the p-value, rounded up: bin b stands for 10 ** (-b / BINS_PER_DECADE)."""
    return F.least(F.lit(BINS_PER_DECADE * DECADES), F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BINS_PER_DECADE)).cast("int")


def thresholds(counts: DataFrame, rate: float = FALSE_DISCOVERY) -> DataFrame:
    """``counts(encoding, size, bin, n)`` to the least bin discovered for each class: the largest p-value whose share
    of the class, times the class, is within ``rate`` of the tokens up to it."""
    family = Window.partitionBy("encoding", "size")
    upto = family.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("m", F.sum("n").over(family)).withColumn("rank", F.sum("n").over(upto))
    value = F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE)
    return ranked.where(value * F.col("m") <= rate * F.col("rank")).groupBy("encoding", "size").agg(F.min("bin").alias("least"))


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rate: float = FALSE_DISCOVERY) -> DataFrame:
    """Per document: doc_id, assign, access, hex and random: arrays of spans (start, end)."""
    body = F.col("text")
    own = docs.select(F.col(q(doc_id)).alias("doc_id"), F.coalesce(F.col(q(text)), F.lit("")).alias("text"))
    place = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    assign = F.filter(found(body, ASSIGN), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_CHARS)
    hits = cut(own.select("doc_id", place(assign).alias("assign"), place(found(body, ACCESS)).alias("access"),
                          place(found(body, HEX)).alias("hex"), candidates(body).alias("tokens")))
    base = F.concat("assign", "access", "hex")
    open_ = hits.withColumn("tokens", F.filter("tokens", lambda t: ~overlaps(t, base)))
    counts = open_.select(F.explode("tokens").alias("t")).groupBy("t.encoding", "t.size", "t.bin").agg(F.count(F.lit(1)).alias("n"))
    # one row for each class of encoding and length
    least = {f"{r['encoding']}:{r['size']}": r["least"] for r in thresholds(counts, rate).collect()}
    if least:
        table = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair])
        chosen = F.filter("tokens", lambda t: t["bin"] >= F.coalesce(F.try_element_at(table, F.concat_ws(":", t["encoding"], t["size"].cast("string"))),
                                                                     F.lit(BINS_PER_DECADE * DECADES + 1)))
    else:
        chosen = F.slice("tokens", 1, 0)
    return open_.select("doc_id", "assign", "access", "hex", place(chosen).alias("random"))


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    spans = scan(docs, **options)
    labels = [labelled(k, i, F.col(k)) for i, k in enumerate(("assign", "access", "hex", "random"))]
    count = lambda k: F.size(k).cast("bigint").alias(f"n_{k}")
    return spans.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(labels[:3], False), 256).alias("base_sha256"),
                        joined(labels, False).alias("spans"), count("random"))
