"""Quality rules as a bitmask ledger, in DataFrame functions only.

``ledger`` measures every text once and evaluates every rule on the measurements: one row per document
with the measurements and ``failed``, a bigint whose bit b is set if rule b fails.  It holds no
text, so it is stored (``write_ledger``) and everything that follows reads it alone.  A policy is a version's
name and the rules it asks for, that is a mask: ``apply`` keeps a document if ``failed & mask`` is 0.  ``ablation``
groups the ledger by ``failed`` (as many rows as there are combinations, added map-side) and reads off
with bit operations what each rule drops, what it alone drops, and what a policy would keep without it.

Repeated windows are found in two steps: 64-bit hashes of all windows of a text, and, only where two of them
are equal, the windows themselves, sorted as strings; so no count rests on a hash.

Defined results: null counts as empty; a text without words fails ``short`` alone (the other rules are
shares of words or lines and need some); repeated rows and ids each get a row; a null id stays null; an
empty table gives an empty ledger and an ablation of zeros; columns of the input beside id and text are not
read, whatever their names; a very long text is one row of arrays about ten times its size at most.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.llm.common import BLANK, UPPER, let, q, stored

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_upper", "n_marks")


@dataclass(frozen=True)
class Rule:
    """A rule's bit (never given to another rule), its name, and when a document fails it.  ``sql`` says the same over
    columns named as the measurements."""

    bit: int
    name: str
    sql: str

    def fails(self) -> Column:
        return F.expr(self.sql)


# Thresholds are whole-number comparisons, so that every engine decides alike.
RULES: tuple[Rule, ...] = (
    Rule(0, "short", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule(4, "word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words)"),
    Rule(5, "letters", "100 * n_letter_words < 60 * n_words"),
    Rule(6, "capitals", "100 * n_upper > 40 * word_chars"),
    Rule(7, "exclamations", "2 * n_marks > n_words"),
)
# Versions are never edited, only added; the last is the one in use.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("short", "repeated_windows"),
    "v2": ("short", "repeated_windows", "symbols", "repeated_lines"),
    "v3": ("short", "repeated_windows", "symbols", "repeated_lines", "word_length", "letters", "capitals", "exclamations"),
}
BASE = "v1"
CURRENT = "v3"


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[n] for n in set(names))


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words which stands twice or more in the text."""
    starts = F.sequence(F.lit(0), F.size(words) - window)

    def covered(at: Column) -> Column:
        # ascending starts of repeated windows: each covers what lies before the next one's start
        reach = F.transform(at, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - p, F.lit(window))))
        return F.aggregate(reach, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def exact(_: Column) -> Column:
        whole = F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i + 1, window), " ").alias("w"), i.alias("p")))

        def same(s: Column) -> Column:
            twice = F.transform(s, lambda x, i: F.when(
                x["w"].eqNullSafe(F.get(s, i - 1)["w"]) | x["w"].eqNullSafe(F.get(s, i + 1)["w"]), x["p"]))
            return let(F.sort_array(F.filter(twice, lambda p: p.isNotNull())), covered)
        return let(F.sort_array(whole), same)

    def by_hash(h: Column) -> Column:
        found = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(window)]))
        return let(found, lambda x: F.when(F.size(F.array_distinct(x)) < F.size(x), exact(x)).otherwise(F.lit(0).cast("bigint")))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > window, let(hashes, by_hash)).otherwise(F.lit(0).cast("bigint"))


def measured(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id and MEASURES, all bigint."""
    body = F.col("text")
    own = docs.select(F.col(q(doc_id)).alias("doc_id"), F.coalesce(F.col(q(text)), F.lit("")).alias("text"))
    trimmed = F.btrim(body, F.lit(BLANKS))
    split = own.select("doc_id", "text", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK)).alias("words"),
                       F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "").alias("lines"))
    found = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.translate(body, BLANKS, "")),
        "n_symbols": _without(body, SYMBOLS),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": repeated_words(F.col("words"), window),
        "n_letter_words": F.size(F.filter("words", lambda w: w.rlike("\\p{L}"))),
        "n_upper": _without(body, UPPER),
        "n_marks": _without(body, "!?"),
    }
    return split.select("doc_id", *[found[m].cast("bigint").alias(m) for m in MEASURES])


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, **options) -> DataFrame:
    """doc_id, the measurements and ``failed``: every rule evaluated once."""
    if len({r.bit for r in rules}) < len(rules) or any(not 0 <= r.bit < 63 for r in rules):
        raise ValueError("every rule needs a bit of its own, from 0 to 62")
    bits = F.lit(0).cast("bigint")
    for r in rules:
        bits = bits.bitwiseOR(F.when(r.fails(), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("bigint"))
    return measured(docs, **options).withColumn("failed", bits)


def write_ledger(docs: DataFrame, path: str | None = None, rules: Sequence[Rule] = RULES, **options) -> DataFrame:
    """The ledger as Parquet (in a fresh folder of the shared checkpoint folder unless ``path`` is given), read back."""
    made = ledger(docs, rules, **options)
    if path is None:
        return stored(made, "ledger")
    made.write.parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def kept(failed: Column, names: Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    return failed.bitwiseAND(F.lit(mask(names, rules)).cast("bigint")) == 0


def apply(ledger: DataFrame, version: str = CURRENT, policies: Mapping[str, Sequence[str]] = POLICIES,
          rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger with ``kept`` (by the version), ``failed_rules`` (names of the version's rules that fail, by bit) and
    ``only_rule`` (the one rule without which it would be kept, else null)."""
    asked = sorted((r for r in rules if r.name in policies[version]), key=lambda r: r.bit)
    hit = F.col("failed").bitwiseAND(F.lit(mask(policies[version], rules)).cast("bigint"))
    names = F.filter(F.array(*[F.when(hit.bitwiseAND(F.lit(1 << r.bit).cast("bigint")) != 0, F.lit(r.name)) for r in asked])
                     if asked else F.array().cast("array<string>"), lambda n: n.isNotNull())
    return ledger.withColumn("kept", hit == 0).withColumn("failed_rules", F.array_join(names, ",")) \
        .withColumn("only_rule", F.when(F.bit_count(hit) == 1, F.get(names, F.lit(0))))


def ablation(ledger: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """A row per version and rule of it: documents, kept, failing (the rule), only (this rule alone), kept_without it,
    and also: the OR of the bits of the version's other rules that fail together with it."""
    by_bits = ledger.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    tests = [F.struct(F.lit(v).alias("version"), F.lit(r.name).alias("rule"), F.lit(mask(names, rules)).cast("bigint").alias("mask"),
                      F.lit(1 << r.bit).cast("bigint").alias("bit"))
             for v, names in policies.items() for r in sorted(rules, key=lambda r: r.bit) if r.name in names]
    zero = F.lit(0).cast("bigint")
    # one row for each combination of failing rules, times the rules of the versions
    rows = by_bits.select("failed", "n", F.explode(F.array(*tests)).alias("t")).select("failed", "n", "t.*")
    hit, rest = F.col("failed").bitwiseAND(F.col("mask")), F.col("failed").bitwiseAND(F.col("mask").bitwiseXOR(F.col("bit")))
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    count: Callable[[Column], Column] = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), zero)
    found = rows.groupBy("version", "rule").agg(
        F.sum("n").alias("documents"), count(hit == 0).alias("kept"), count(fails).alias("failing"),
        count(fails & (rest == 0)).alias("only"), count(rest == 0).alias("kept_without"),
        F.coalesce(F.bit_or(F.when(fails, rest)), zero).alias("also"))
    every = ledger.sparkSession.range(1).select(F.explode(F.array(*tests)).alias("t")).select("t.version", "t.rule")
    return every.join(found, ["version", "rule"], "left").fillna(0)


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed, failed_rules, only_rule."""
    judged = apply(write_ledger(docs, **options))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~kept(F.col("failed"), POLICIES[BASE])).alias("base_failed"), "kept", "failed", "failed_rules", "only_rule")


def _sql() -> str:
    dropped = lambda chars: f"length(text) - length(translate(text, '{chars}', ''))"
    hit = f"(failed & {mask(POLICIES[CURRENT])})"
    asked = [r for r in RULES if r.name in POLICIES[CURRENT]]
    names = ", ".join(f"CASE WHEN {hit} & {1 << r.bit} <> 0 THEN '{r.name}' END" for r in asked)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
wins AS (SELECT r, unnest(range(len(w) - {WINDOW - 1})) AS i, w FROM s WHERE len(w) >= {WINDOW}),
keyed AS (SELECT r, i, array_to_string(w[i + 1:i + {WINDOW}], ' ') AS k FROM wins),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM keyed),
ends AS (SELECT r, least({WINDOW}, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, {WINDOW})) AS n FROM twice WHERE c > 1),
reps AS (SELECT r, sum(n)::BIGINT AS n FROM ends GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             {dropped(SYMBOLS)} AS n_symbols, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n, 0)::BIGINT AS n_repeat_words, len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}')))::BIGINT AS n_letter_words,
             {dropped(UPPER)} AS n_upper, {dropped("!?")} AS n_marks
      FROM s LEFT JOIN reps USING (r)),
f AS (SELECT *, {" | ".join(f"CASE WHEN {r.sql} THEN {1 << r.bit} ELSE 0 END" for r in RULES)} AS failed FROM m),
n AS (SELECT *, list_filter([{names}], lambda x: x IS NOT NULL) AS names FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {mask(POLICIES[BASE])}) <> 0 AS base_failed,
       {hit} = 0 AS kept, failed::BIGINT AS failed, array_to_string(names, ',') AS failed_rules,
       CASE WHEN len(names) = 1 THEN names[1] END AS only_rule
FROM n"""


REPORT_SQL = _sql()
