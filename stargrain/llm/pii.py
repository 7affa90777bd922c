"""Personal data by weak supervision, in DataFrame functions only.

Base kinds (email, ip, card, phone) are found by pattern and always reported.  The method looks at more: the
base spans and further candidates (numbers written like national ids, bank accounts, local phone numbers,
short card numbers, IPv6 addresses) are judged by labelers that vote for (1), against (-1) or not at all (0):

* pattern: the strict form of the kind (checksums, field ranges);
* gazetteer: known top-level domains, card issuers, country codes, reserved address blocks;
* context: cue words before the span that speak for its kind or for something else;
* setting: is the span a word of its own.

Expectation-maximisation over the counts of vote patterns estimates each labeler's reliability for and
against by kind, and each pattern's probability.  With those as soft labels a final span classifier (naive
Bayes over shape and context features and the votes) is trained; a further candidate is reported if
the classifier gives it 0.5 or more.  Only the table of (kind, votes, features) counts comes to the driver: at
most kinds x 3^4 x the features' values, whatever the corpus.

Defined results: null counts as empty; no match gives zero counts and empty spans; a further candidate that
touches a base span is dropped; repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.llm.common import cut, q
from stargrain.llm.spans import found, joined, labelled, overlaps

BASE = ("email", "ip", "card", "phone")
MORE = ("short_card", "local_phone", "national_id", "bank_account", "ipv6")
KINDS = BASE + MORE
CONTEXT = 24

# The contract's base patterns (fixed values), in forms that don't backtrack into long runs: a run is entered at its
# start or where the last match ended, and repeated groups are possessive.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+"
IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
FURTHER = {
    "local_phone": r"\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "bank_account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv6": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
}
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "nl", "eu", "us", "ca", "jp", "cn", "br", "ch", "at")
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6)"
COUNTRIES = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED = "^0*(?:0|127|22[4-9]|2[3-5][0-9])\\."
CUES = {
    "email": "mail|contact|write|correo|courriel", "ip": r"\bip\b|address|host|server|adresse", "card": "card|visa|master|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|handy|portable", "short_card": "card|amex|credit|karte|carte|tarjeta",
    "local_phone": "phone|tel|call|mobile|fax", "national_id": "ssn|social|security|insurance", "bank_account": "iban|bank|account|konto|compte|cuenta",
    "ipv6": r"\bip\b|address|host|server",
}
AGAINST = "version|release|isbn|issn|order|invoice|sku|part|model|chapter|section|figure|build"
LABELERS, FEATURES = ("pattern", "gazetteer", "context", "setting"), ("size", "digits", "before", "after")
ROUNDS = 30


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Does a text of digits pass the Luhn check."""
    figures = F.transform(F.filter(F.split(F.reverse(number), ""), lambda c: c != ""), lambda c: c.cast("int"))
    # every second figure from the right counts twice, its digits added
    total = F.aggregate(F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)), F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


def _spans(text: Column, runs: Column) -> dict[str, Column]:
    """Spans by kind; ``runs`` are the digit runs (CARD's matches)."""
    size = lambda s: F.length(digits(s["value"]))
    out = {
        "email": found(text, EMAIL, CONTEXT, sign="@"),
        "ip": F.filter(found(text, IP, CONTEXT), lambda s: s["value"].rlike(f"^{IP_PART}(?:\\.{IP_PART}){{3}}$")),
        "card": F.filter(runs, lambda s: size(s).between(16, 19) & luhn(digits(s["value"]))),
        "phone": F.filter(found(text, PHONE, CONTEXT, sign="+"), lambda s: size(s).between(8, 15)),
        "short_card": F.filter(runs, lambda s: size(s).between(13, 15) & luhn(digits(s["value"]))),
    }
    return out | {k: found(text, p, CONTEXT) for k, p in FURTHER.items()}


def _mod97(value: Column) -> Column:
    """The remainder of an account number's check, letters counting 10 to 35."""
    plain = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    chars = F.filter(F.split(moved, ""), lambda c: c != "")
    number = F.transform(chars, lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1)
    return F.aggregate(number, F.lit(0), lambda a, d: F.when(d > 9, (a * 100 + d) % 97).otherwise((a * 10 + d) % 97))


def _vote(yes: Column, no: Column | None = None) -> Column:
    return F.when(yes, 1).when(no if no is not None else ~yes, -1).otherwise(0)


def _votes(kind: str, s: Column) -> list[Column]:
    value, number = s["value"], digits(s["value"])
    strict = {
        "email": lambda: _vote(value.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@.+\.[A-Za-z]{2,24}$")),
        "ip": lambda: _vote(~value.rlike(r"(^|\.)0[0-9]"), value.rlike(r"(^|\.)0[0-9]")),
        "card": lambda: _vote(F.length(number) == 16, value.rlike("^0|[0-9] [0-9] [0-9] ")),
        "phone": lambda: _vote(value.rlike(r"^\+[1-9]") & F.length(number).between(10, 13), value.rlike(r"^\+0|[.]{2}|--|\(\)")),
        "short_card": lambda: _vote(F.length(number) == 15, F.length(number) == 13),
        "local_phone": lambda: _vote(value.rlike(r"^\([2-9]"), value.rlike(r"^\([01]")),
        "national_id": lambda: _vote(value.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)")),
        "bank_account": lambda: _vote(_mod97(value) == 1),
        "ipv6": lambda: _vote(~value.rlike("^(0{1,4}:){7}")),
    }[kind]()
    known = {
        "email": lambda: _vote(F.lower(F.regexp_extract(value, r"\.([A-Za-z0-9-]+)$", 1)).isin(*DOMAINS), value.rlike(r"\.[0-9-]+$")),
        "ip": lambda: _vote(value.rlike("^[1-9]") & ~value.rlike(RESERVED), value.rlike(RESERVED)),
        "card": lambda: _vote(number.rlike(ISSUERS), number.rlike("^[089]")),
        "phone": lambda: _vote(value.rlike(COUNTRIES), value.rlike(r"^\+0")),
        "short_card": lambda: _vote(number.rlike("^3[47]"), ~number.rlike("^3[04678]")),
        "local_phone": lambda: _vote(value.rlike(r"^\([2-9][0-8]"), value.rlike(r"^\([01]")),
        "national_id": lambda: F.lit(0),
        "bank_account": lambda: _vote(value.rlike("^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)")),
        "ipv6": lambda: _vote(value.rlike("^(?:2[0-9A-Fa-f]{3}|[Ff][CcDdEe])"), F.lit(False)),
    }[kind]()
    cue = F.lower(s["before"])
    context = F.when(cue.rlike(CUES[kind]), 1).when(cue.rlike(AGAINST), -1).otherwise(0)
    alone = ~(s["before"].rlike(r"[\p{L}\p{N}_]$") | s["after"].rlike(r"^[\p{L}\p{N}_]"))
    return [strict, known, context, _vote(alone)]


def _features(s: Column) -> list[Column]:
    n = F.length(s["value"])
    kinds = F.size(F.array_distinct(F.filter(F.split(digits(s["value"]), ""), lambda c: c != "")))
    side = lambda text, at: F.when(text == "", 0).when(text.rlike(at % r"\s"), 1).when(text.rlike(at % r"[\p{L}\p{N}]"), 2).otherwise(3)
    return [F.when(n < 12, 0).when(n < 18, 1).when(n < 26, 2).otherwise(3), F.when(kinds < 4, 0).when(kinds < 7, 1).otherwise(2),
            side(s["before"], "%s$"), side(s["after"], "^%s")]


def candidates(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` to doc_id and ``spans``: ``array<struct<kind, start, end, traits>>`` of all kinds;
    traits are the votes and then the features."""
    def judged(kind: str):
        return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                  F.array(*_votes(kind, s), *_features(s)).alias("traits"))

    runs = docs.select("doc_id", "text", found(F.col("text"), CARD, CONTEXT).alias("runs"))
    spans = _spans(F.col("text"), F.col("runs"))
    by_kind = cut(runs.select("doc_id", *[F.transform(spans[k], judged(k)).alias(k) for k in KINDS]))
    base = F.concat(*BASE)
    return by_kind.select("doc_id", F.concat(base, F.filter(F.concat(*MORE), lambda s: ~overlaps(s, base))).alias("spans"))


Table = dict[tuple[str, tuple[int, ...]], int]


def estimate(counts: Table, rounds: int = ROUNDS) -> tuple[dict, dict[tuple[str, tuple[int, ...]], float]]:
    """EM over vote patterns: each labeler's rates of +1, 0 and -1 for true and false spans by kind, and the
    probability of each pattern.  It starts from the mean vote; rates are smoothed."""
    n = len(LABELERS)
    belief = {key: 1 / (1 + math.exp(-1.5 * sum(key[1][:n]))) for key in counts}
    rates: dict = {}
    for _ in range(rounds):
        sums: dict = defaultdict(lambda: [[0.5, 0.5, 0.5] for _ in range(n)])
        prior: dict = defaultdict(lambda: [1.0, 1.0])
        for key, c in counts.items():
            for truth, p in ((1, belief[key]), (0, 1 - belief[key])):
                prior[key[0]][truth] += c * p
                for i, v in enumerate(key[1][:n]):
                    sums[key[0], truth][i][v + 1] += c * p
        rates = {k: [[x / sum(row) for x in row] for row in v] for k, v in sums.items()}
        rates |= {(k, "prior"): v[1] / sum(v) for k, v in prior.items()}
        for key in counts:
            odds = math.log(rates[key[0], "prior"] / (1 - rates[key[0], "prior"]))
            for i, v in enumerate(key[1][:n]):
                odds += math.log(rates[key[0], 1][i][v + 1] / rates[key[0], 0][i][v + 1])
            belief[key] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
    return rates, belief


def train(counts: Table) -> dict[str, float]:
    """The final classifier as log-odds: ``kind`` for the prior and ``kind:trait:value`` for each trait's value."""
    _, belief = estimate(counts)
    sums: dict = defaultdict(lambda: [1.0, 1.0])
    for (kind, traits), c in counts.items():
        for truth, p in ((1, belief[kind, traits]), (0, 1 - belief[kind, traits])):
            sums[kind][truth] += c * p
            for i, v in enumerate(traits):
                sums[f"{kind}:{i}:{v}"][truth] += c * p
    out = {}
    for name, (no, yes) in sums.items():
        odds = math.log(yes / no)
        kind = name.split(":")[0]
        out[name] = odds if name == kind else odds - math.log(sums[kind][1] / sums[kind][0])
    return out


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id and spans: ``array<struct<kind, start, end, score>>``; base spans whatever their score,
    others from 0.5."""
    own = docs.select(F.col(q(doc_id)).alias("doc_id"), F.coalesce(F.col(q(text)), F.lit("")).alias("text"))
    hits = candidates(own)
    counts = hits.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.traits").agg(F.count(F.lit(1)).alias("n")).collect()
    weights = train({(r["kind"], tuple(r["traits"])): r["n"] for r in counts})
    if not weights:
        return hits.select("doc_id", F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                                             F.lit(0.0).alias("score"))).alias("spans"))
    table = F.create_map(*[F.lit(x) for pair in sorted(weights.items()) for x in pair])

    def scored(s: Column) -> Column:
        terms = F.transform(s["traits"], lambda v, i: F.coalesce(F.try_element_at(table, F.concat_ws(":", s["kind"], i.cast("string"), v.cast("string"))), F.lit(0.0)))
        odds = F.aggregate(terms, F.coalesce(F.try_element_at(table, s["kind"]), F.lit(0.0)), lambda a, x: a + x)
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), (1 / (1 + F.exp(-odds))).alias("score"))

    judged = F.transform("spans", scored)
    return hits.select("doc_id", F.filter(judged, lambda s: s["kind"].isin(*BASE) | (s["score"] >= 0.5)).alias("spans"))


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more."""
    spans = scan(docs, **options)
    of = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    labels = [labelled(k, i, of(k)) for i, k in enumerate(KINDS)]
    return spans.select("doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in BASE], F.sha2(joined(labels[:len(BASE)], True), 256).alias("base_sha256"),
                        joined(labels, True).alias("spans"), F.size(F.filter("spans", lambda s: ~s["kind"].isin(*BASE))).cast("bigint").alias("n_more"))
