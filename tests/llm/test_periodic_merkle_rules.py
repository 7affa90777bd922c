"""Periodic runs, the Merkle manifest and the quality ledger against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stargrain.llm import merkle, periodic, quality_rules

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# ---------------------------------------------------------------- periodic runs

def brute_runs(w, least=12):
    """(start, length, period) of all runs: for each period, the maximal stretches of words that come again."""
    n, out = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                out.setdefault((i, j + p), p)
            i = j
    return sorted(((s, e - s, p) for (s, e), p in out.items()), key=lambda x: (x[0], x[2]))


def collapsed(w, runs):
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in dropped)


def texts_with_runs():
    rng = random.Random(3)
    out = []
    for _ in range(120):
        kinds, n = rng.choice([1, 2, 3, 5, 50]), rng.choice([0, 1, 11, 12, 13, 24, 40, 100, 300])
        w = [str(rng.randrange(kinds)) for _ in range(n)]
        if n > 30 and rng.random() < 0.6:
            a = rng.randrange(n - 10)
            p = rng.randint(1, (n - a) // 2)
            w = w[:a] + [w[a + i % p] for i in range(rng.randint(p, n - a))] + w[rng.randrange(n):]
        out.append(w)
    x, y = "a", "ab"
    while len(y) < 800:
        x, y = y, y + x
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(512))
    return out + [list(y), list(morse), ["a"] * 300 + ["b"] + ["a"] * 300, list("ab") * 200, (list("aab") * 7 + ["c"]) * 12]


@pytest.mark.parametrize("least", [2, 12, 40])
def test_runs_equal_brute_force(least):
    texts = texts_with_runs()
    batch = pa.record_batch([pa.array(["skip", *["\t ".join(w) for w in texts], None])], names=["t"]).slice(1)
    found = [r for b in periodic._found([batch], "t", "f", least) for r in b.column(1).to_pylist()]
    assert found.pop() == {"n_words": 0, "runs": [], "collapsed": ""}
    for w, got in zip(texts, found, strict=True):
        want = brute_runs(w, least)
        assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == want
        assert got["n_words"] == len(w) and got["collapsed"] == collapsed(w, want)


@pytest.mark.parametrize("size", [2, 8, 64, 128, 1024, 8192])
def test_transform_gives_exact_correlations(size):
    rng = np.random.default_rng(size)
    t = periodic.transform(size)
    length = max(1, size // 4)
    a, b = rng.integers(0, periodic.PRIME, (2, length)), rng.integers(0, periodic.PRIME, (2, size))
    x = t.spread(periodic._reduce(a.astype(float)), -1) * t.spread(periodic._reduce(b.astype(float)), 1)
    got = t.gather(periodic._reduce(x), -1, size - length + 1)
    inverse = pow(size, -1, periodic.PRIME)
    for row in range(2):
        for d in {0, 1, (size - length) // 2, size - length}:
            want = sum(int(u) * int(v) for u, v in zip(a[row], b[row, d:d + length])) % periodic.PRIME
            assert int(got[row, d]) * inverse % periodic.PRIME == want


def test_equal_numbers_modulo_the_prime_are_no_match():
    # numbers that differ by the prime square to a difference of 0 modulo it; words are compared, so no run
    numbers = np.concatenate([np.where(np.arange(64) % 2, 5, 5 + periodic.PRIME), [10 ** 9]])
    assert periodic.runs_of(numbers, np.array([0]), np.array([64])) == [(0, 0, 64, 2)]
    numbers = np.concatenate([5 + periodic.PRIME * np.arange(64), [10 ** 12]])
    assert periodic.runs_of(numbers, np.array([0]), np.array([64])) == []


def planted_words(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 or not w:
        return w
    n, g = len(w), zlib.crc32(str(doc_id).encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def check_report(docs, rows):
    for (i, text), r in zip(docs, rows, strict=True):
        w = planted_words(i, text)
        runs = brute_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(collapsed(w, runs)))
        assert tuple(r) == want, i


def test_report_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = periodic.report(docs).orderBy("doc_id").collect()
    check_report([(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()], rows)


def test_runs_of_odd_rows(spark):
    # the added column's name is taken, ids repeat or are null, texts are null, empty or blank
    rows = [(1, None, 1), (1, "", 2), (None, "a " * 30, 3), (2, " \t\n ", 4), (2, "a " * 30, 5), (2, "a " * 30, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, Periodic int")
    got = periodic.collapse(docs).collect()
    assert docs.columns == ["doc_id", "text", "Periodic"] and sorted(r["Periodic"] for r in got) == [1, 2, 3, 4, 5, 5]
    assert {r["Periodic"]: r["text"] for r in got} == {1: None, 2: "", 3: "a", 4: " \t\n ", 5: "a"}
    assert sorted(r["n_runs"] for r in periodic.report(docs).collect()) == [0, 0, 0, 1, 1, 1]
    assert periodic.report(docs.where("false")).collect() == []
    assert periodic.find(docs)[1] == "_periodic"


def test_runs_of_a_very_long_text(spark):
    rng = random.Random(1)
    w = [str(rng.randrange(500)) for _ in range(60_000)]
    w[20_000:50_000] = (w[20_000:27_000] * 5)[:30_000]
    docs = spark.createDataFrame([(7, " ".join(w)), (8, "b " * 200_000)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["periodic"] for r in periodic.find(docs)[0].collect()}
    assert [(r["length"] >= 30_000, r["period"]) for r in got[7]["runs"] if r["length"] > 1000] == [(True, 7_000)]
    assert [tuple(r) for r in got[8]["runs"]] == [(0, 200_000, 1)] and got[8]["collapsed"] == "b"


# ---------------------------------------------------------------- Merkle manifest

def digest_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout=8):
    """(root, siblings of each node by level as (left, right))."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            run = p // fanout * fanout
            paths[i].append(("".join(nodes[run:p]), "".join(nodes[p + 1:run + fanout])))
        nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        place = [p // fanout for p in place]
    return nodes[0], paths


def brute_manifest(rows, fanout=8):
    """rows (doc_id, text, lang, source, n_chars) to {leaf: set of (doc_id, leaf, subroot, root, proof, folded, verified)}."""
    def lower(t):
        return t and re.sub("[A-Z]", lambda m: m[0].lower(), t)
    groups = {}
    for i, text, lang, source, n in rows:
        tampered = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        groups.setdefault(lang, []).append((i is not None, i or 0, digest_leaf((i, source, lang, n, text)), i,
                                            digest_leaf((i, source, lang, n, lower(text) if tampered else text))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        tops[g] = climb([x[2] for x in groups[g]], fanout)
    root, over = climb([tops[g][0] for g in order], fanout)
    out = []
    for g, above in zip(order, over):
        for (_, _, leaf, i, changed), path in zip(groups[g], tops[g][1]):
            node = changed
            for left, right in path + above:
                node = sha(left + node + right)
            out.append((i, leaf, tops[g][0], root, sha("".join(a + b for a, b in path + above)), node, node == root))
    return Counter(out)


def leaves(n, seed=0):
    rng = random.Random(seed)
    langs = ["en"] * 6 + ["de", None, "", "é", "zz"]
    return [(rng.randrange(3 * n), rng.choice(["Ab c", "plain", None, "", "É x"]) if rng.random() < 0.5 else f"T{k}", rng.choice(langs),
             rng.choice(["src1", None]), rng.choice([k, None])) for k in range(n)]


@pytest.mark.parametrize("n,options", [(0, {}), (1, {}), (8, {}), (9, {}), (1200, {}), (300, {"fanout": 2, "levels": 2}), (90, {"fanout": 3, "levels": 1})])
def test_manifest_equals_brute_force(spark, n, options):
    rows = leaves(n, n)
    got = merkle.report(spark.createDataFrame(rows, DOCS), **options).collect()
    assert Counter(tuple(r) for r in got) == (brute_manifest(rows, options.get("fanout", 8)) if rows else Counter())


def test_manifest_of_one_hot_group_over_several_rounds(spark):
    # 3,000 rows of one language are six chunks: two rounds of windows; ids repeat and are null
    rows = [(k // 2 if k % 50 else None, "Same" if k % 3 else f"x{k}", "en", None, 1) for k in range(3000)] + [(1, None, "fr", None, None)]
    got = merkle.report(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter(tuple(r) for r in got) == brute_manifest(rows)
    assert {r["verified"] for r in got} == {True, False}


def test_manifest_takes_other_columns_and_names(spark):
    rows = [(str(k), k % 2, f"v{k}", k) for k in range(20)]
    docs = spark.createDataFrame(rows, "key string, part int, leaf string, grp int")
    made = merkle.manifest(docs, doc_id="key", group="part", fields=["key", "leaf"], also={"n": F.col("grp")})
    got = made.withColumn("again", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert made.columns == ["doc_id", "part", "leaf", "subroot", "root", "path", "n"]
    assert len(got) == 20 and all(r["again"] == r["root"] for r in got) and len({r["subroot"] for r in got}) == 2
    assert {r["doc_id"]: r["leaf"] for r in got} == {k: digest_leaf((k, v)) for k, _, v, _ in rows}


def test_manifest_shuffles_each_chunk_once(spark):
    nodes = spark.range(2000).selectExpr("'g' AS grp", "id AS pos", "sha2(string(id), 256) AS h")
    plan = merkle._round(nodes, [], 8, 3)._jdf.queryExecution().executedPlan().toString()
    # three levels of lag and lead share one exchange and one sort
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_manifest_of_a_very_long_text(spark):
    rows = [(1, "Ab " * 400_000, "en", None, None), (2, "x", "en", None, None)]
    got = merkle.report(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter(tuple(r) for r in got) == brute_manifest(rows)


# ---------------------------------------------------------------- quality rules

def brute_measures(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if wins[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "n_letter_words": sum(any(c.isalpha() for c in x) for x in w), "n_upper": len(re.findall("[A-Z]", text)),
            "n_marks": len(re.findall("[!?]", text))}


QUALITY = [
    None, "", " \n\t ", "one", "a b c d e f g h", "a b c d e f g h i", "x " * 9, "a b c d e f g h " * 2, "a b c d e f g h z " * 3 + "end",
    "l1\nl2\nl1\n\n \nl1 \nl2\r\nl2\r", "é😀 |x| <b> " * 10, "W! X? " * 40, "1 2 3 4 " * 20, "\x0b\x0cword\x1cstill " * 8,
    " ".join(f"w{i}" for i in range(500)), " ".join(f"w{i % 90}" for i in range(500)), "ab" * 40_000,
    " ".join(f"w{i % 45_000}" for i in range(50_000)),
]


def test_measures_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(QUALITY)], "doc_id bigint, text string, n_words string")
    got = by_id(quality_rules.measured(docs))
    for i, text in enumerate(QUALITY):
        assert {k: got[i][k] for k in quality_rules.MEASURES} == brute_measures(text), i


def test_every_rule_sets_its_own_bit(spark):
    text = "word and more of the same " * 10
    fails = {"short": "few words", "repeated_windows": text, "symbols": " ".join(f"w{i}#" for i in range(30)), "repeated_lines": "\n".join(f"l{i % 4} aa{i % 4}" for i in range(20)),
             "word_length": " ".join(f"{'longer' * 3}{i}" for i in range(30)), "letters": " ".join(f"{i}{i}" for i in range(30)),
             "capitals": " ".join(f"WORD{'ABCDEFGHIJKLMNOPQRSTUVWXYZABCDEF'[i]}" for i in range(30)), "exclamations": " ".join(f"wo{i}x!" for i in range(30))}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(fails.values())], "doc_id bigint, text string")
    got = by_id(quality_rules.ledger(docs))
    bits = {r.name: r.bit for r in quality_rules.RULES}
    for i, name in enumerate(fails):
        assert got[i]["failed"] & (1 << bits[name]), name
    clean = " ".join(f"some{chr(97 + i % 26)}word{chr(97 + i // 26)}" for i in range(100)) + "."
    assert quality_rules.report(spark.createDataFrame([(1, clean)], "doc_id bigint, text string")).first()["kept"]
    with pytest.raises(ValueError):
        quality_rules.ledger(docs, [quality_rules.Rule(0, "a", "true"), quality_rules.Rule(0, "b", "true")])


def test_policies_and_ablation(spark):
    rules = [quality_rules.Rule(b, n, "true") for b, n in ((0, "a"), (5, "b"), (62, "c"))]
    policies = {"one": ("a",), "all": ("a", "b", "c"), "none": ()}
    bits = [0, 1, 32, 33, 1 << 62, (1 << 62) | 1, 1 << 62, 0, 0]
    made = spark.createDataFrame(list(enumerate(bits)), "doc_id bigint, failed bigint")
    for version, names in policies.items():
        m = quality_rules.mask(names, rules)
        got = by_id(quality_rules.apply(made, version, policies, rules))
        for i, f in enumerate(bits):
            hit = [r.name for r in rules if f & m & (1 << r.bit)]
            assert (got[i]["kept"], got[i]["failed_rules"], got[i]["only_rule"]) == (not hit, ",".join(hit), hit[0] if len(hit) == 1 else None)
    got = {(r["version"], r["rule"]): r for r in quality_rules.ablation(made, policies, rules).collect()}
    assert set(got) == {("one", "a"), ("all", "a"), ("all", "b"), ("all", "c")}
    for (version, rule), r in got.items():
        m, bit = quality_rules.mask(policies[version], rules), 1 << next(x.bit for x in rules if x.name == rule)
        also = 0
        for f in bits:
            also |= f & m & ~bit if f & bit else 0
        assert (r["documents"], r["kept"], r["failing"], r["only"], r["kept_without"], r["also"]) == (
            len(bits), sum(not f & m for f in bits), sum(bool(f & bit) for f in bits), sum(f & m == bit for f in bits),
            sum(not f & m & ~bit for f in bits), also)
    empty = quality_rules.ablation(made.where("false"), policies, rules).collect()
    assert len(empty) == 4 and all(r["documents"] == r["kept"] == 0 for r in empty)


def test_ledger_of_odd_rows_and_the_stored_form(spark, tmp_path):
    rows = [(1, None, 3), (1, None, 3), (None, "word", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, failed int")
    path = str(tmp_path / "ledger")
    made = quality_rules.write_ledger(docs, path)
    assert "text" not in made.columns and made.count() == 3
    assert sorted(map(tuple, spark.read.parquet(path).select("doc_id", "failed").collect()), key=str) == [(1, 1), (1, 1), (None, 1)]
    assert [r["kept"] for r in quality_rules.report(docs).collect()] == [False] * 3
    assert quality_rules.report(docs.where("false")).collect() == []
