"""Language ID, mixing, decontamination, SimHash, token output and the pipeline against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.parquet
import pytest
import xxhash
from pyspark.sql import functions as F

from stargrain.llm import components, decontaminate, fm_index, language_id, mixing, simhash, textbuf, token_output

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCS)


# ---------------------------------------------------------------- words and the index

def test_word_spans_and_hashes():
    texts = ["Ab c", "", None, "é1-x", "zz"]
    data, offsets = textbuf.buffer_of(pa.array(["skip", *texts]).slice(1))
    data = textbuf.LOWER[data]
    starts, ends = textbuf.word_spans(data, offsets, textbuf.ALNUM)
    words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert words == [b"ab", b"c", "é1".encode(), b"x", b"zz"]
    assert (textbuf.word_hashes(data, starts, ends) == textbuf.hash_words(words)).all()
    long = [bytes([97 + i % 26]) * (1 + i % 7) for i in range(400_000)]
    whole = textbuf.hash_words(long)  # more than one segment
    assert (whole[-5:] == textbuf.hash_words(long[-5:])).all() and len(set(whole.tolist())) == len(set(long))


@pytest.mark.parametrize("n,kinds", [(0, 2), (1, 1), (60, 2), (2000, 3), (2000, 1)])
def test_fm_index_finds_every_occurrence(n, kinds):
    rng = np.random.default_rng(n + kinds)
    symbols = rng.integers(2, 2 + kinds, n)
    symbols[rng.random(n) < 0.05] = fm_index.SEPARATOR
    symbols = np.append(symbols, [fm_index.SEPARATOR, fm_index.END])
    index = fm_index.FMIndex(symbols)
    for size in (1, 2, 3, 7, 13):
        pattern = rng.integers(2, 2 + kinds, size)
        low, high = index.search(pattern[None, :], np.array([size]))
        got = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        assert got == [i for i in range(len(symbols) - size) if (symbols[i:i + size] == pattern).all()]


# ---------------------------------------------------------------- decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contract_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contract_report(docs, items, window=13):
    windows = {}
    for item, text in items:
        w = contract_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + window]), set()).add(str(item) if item is not None else "")
    out = {}
    for i, text in docs:
        w, hit, names = contract_words(text), set(), set()
        for k in range(len(w)):
            for size in {len(x) for x in windows}:
                found = windows.get(tuple(w[k:k + size]))
                if found and k + size <= len(w):
                    hit |= set(range(k, k + size))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out[i] = (len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def overlap_case():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ß", "漢字", "A1"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate([20, 13, 12, 5, 2, 40, 14, 1])] + [(100, None), (101, "!!"), (None, say(15)), (0, say(16))]
    docs = [(i, say(rng.randint(0, 60))) for i in range(40)]
    for k, (_, text) in enumerate(items):
        docs += [(100 + k, f"{say(30)} -- {text} {say(3)}"), (200 + k, text), (300 + k, (text or "").upper().replace(" ", ", "))]
    return docs + [(900, None), (901, ""), (902, "!?"), (903, docs[10][1] + " " + items[5][1] * 3)], items


@pytest.mark.parametrize("block_bytes", [8_000_000, 150])
def test_decontamination_equals_brute_force(spark, block_bytes):
    docs, items = overlap_case()
    want = contract_report(docs, items)
    rows = decontaminate.report(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
                                spark.createDataFrame(items, "item_id bigint, text string"), block_bytes=block_bytes).collect()
    got = {r["doc_id"]: tuple(r)[1:6] for r in rows}
    assert got == want and len(rows) == len(docs)
    text = dict(docs)
    for r in rows:
        words = [text[r["doc_id"]][int(a):int(b)] for a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert sum(len(contract_words(w)) for w in words) == r["n_hit"]


def test_several_blocks_give_the_spans_of_one(spark):
    items = [(k, " ".join(f"i{k}w{n}" for n in range(14))) for k in range(8)]
    texts = [f"é start {a} --  {b}, {c} end" for (_, a), (_, b), (_, c) in zip(items, items[1:], items[2:])] + [items[0][1] + " x " + items[1][1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    one, many = ({r["doc_id"]: tuple(r) for r in decontaminate.report(docs, benchmark, block_bytes=n).collect()} for n in (8_000_000, 150))
    assert one == many and one[0][-1] == f"8:{len(texts[0]) - 4}"
    cut = decontaminate.clean(docs, benchmark, share=0, cut_spans=True, block_bytes=150)
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {i: " x " if i == 6 else "é start  end" for i in range(7)}


def test_small_shards_find_the_same(spark):
    docs, items = overlap_case()
    patterns = decontaminate.Patterns([(str(i), t) for i, t in items])
    data, offsets = textbuf.buffer_of(pa.array([t for _, t in docs]))
    whole = decontaminate.search_texts(data, offsets, patterns)
    cut = decontaminate.search_texts(data, offsets, patterns, shard_words=29)
    assert whole[1] == cut[1] and whole[2] == cut[2] and (whole[0] == cut[0]).all()


def test_clean_keeps_columns_and_can_cut_spans(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    filler = " ".join(f"f{i}" for i in range(400))
    docs = spark.createDataFrame([(1, passage, 5), (2, f"{filler} {passage} end", 6), (3, filler, 7), (4, None, 8)], "doc_id bigint, text string, overlap int")
    items = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.clean(docs, items, cut_spans=True).collect()}
    assert cut == {2: f"{filler}  end", 3: filler, 4: None}


# ---------------------------------------------------------------- SimHash

def contract_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(ids, near):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_simhash_equals_brute_force(spark):
    rng = random.Random(6)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.randint(0, 80))) for _ in range(60)]
    texts = ["", None, " \t\n", "One", "One two", "A\x0bB\x0cC\rd", "É x​y z", "a" * 5000] + base
    for b in base[:30]:
        words = b.split()
        if len(words) > 30:
            words[rng.randrange(len(words))] = "zz"
            texts.append(" ".join(words))
    texts += base[:5]
    prints = {i: contract_print(t) for i, t in enumerate(texts)}
    near = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3]
    label = components_of(prints, near)
    got = {r["doc_id"]: r for r in simhash.report(documents(spark, [(i, t, None, None) for i, t in enumerate(texts)]).repartition(4), least_depth=3).collect()}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == label
    assert len(near) > 10


def test_links_are_complete_whatever_the_tree(spark):
    rng = np.random.default_rng(9)
    seeds = rng.integers(0, 2**63, 150, dtype=np.uint64)
    flips = [seeds]
    for _ in range(4):  # chains: each point near the one before
        flips.append(flips[-1] ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)))
    points = np.unique(np.concatenate([*flips, rng.integers(0, 2**63, 500, dtype=np.uint64), np.arange(40, dtype=np.uint64)]))
    signed = points.view(np.int64).tolist()
    near = [(signed[a], signed[b]) for a, b in zip(*np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3)) if a < b]
    label = components_of(signed, near)
    frame = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    for depth in (0, 3, 6):
        edges = simhash.links(frame, least_depth=depth, sample_points=64)
        roots = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
        assert {x: roots.get(x, x) for x in signed} == label, depth


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (101, 100)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components.connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_one_document_of_each_group_stays(spark):
    text = "the quick brown fox jumps over the lazy dog and runs away from here"
    docs = documents(spark, [(5, text, "en", "a"), (3, text, "en", "b"), (3, text, "en", "b"), (9, "something else entirely is written in this one", "en", "c"), (None, text, None, None)])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 9]


def test_one_document_stays_of_groups_with_null_and_repeated_ids(spark):
    rng = random.Random(11)
    say = lambda: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(40))
    a, b, c, d, e, f = (say() for _ in range(6))
    rows = [(None, a), (None, b), (None, c), (None, c), (7, d), (7, e), (8, e), (None, e), (9, f)]
    want = sorted([("None", a), ("None", b), ("None", c), ("7", d), ("7", e), ("9", f)])
    kept = simhash.keep_one(documents(spark, [(i, t, None, None) for i, t in rows]).repartition(3)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == want
    # ids and texts that read the same when joined
    docs = spark.createDataFrame([("x", f"y:{a}"), ("x:y", a), ("null", b), (None, c)], "doc_id string, text string")
    prints = {r["fingerprint"] for r in simhash.report(docs).collect()}
    assert simhash.keep_one(docs).count() == len(prints) == 4


# ---------------------------------------------------------------- language ID

def test_language_id_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_mixtures_are_estimated():
    rng = random.Random(8)
    alphabets = {"aa": "abcde", "bb": "efghi", "cc": "ijkla"}
    say = lambda lang, n: " ".join("".join(rng.choice(alphabets[lang]) for _ in range(rng.randint(3, 7))) for _ in range(n))
    batch = pa.RecordBatch.from_arrays([pa.array([say(k, 3000) for k in alphabets]), pa.array(list(alphabets))], names=["text", "lang"])
    counts = {}
    for out in language_id._counts(iter([batch])):
        table = np.zeros((1 << language_id.GRAM_BITS) + (1 << language_id.CONTEXT_BITS), np.int64)
        table[out.column(1).to_numpy()] = out.column(2).to_numpy()
        counts[out.column(0)[0].as_py()] = table
    model = language_id.Model(counts)
    texts = [say("aa", 70) + " " + say("bb", 30), say("cc", 50), say("aa", 40) + " " + say("bb", 30) + " " + say("cc", 30), "", "12 - !!"]
    found = language_id.letters_of(texts)
    share = language_id.infer(model.word_scores(found), found.text_words)
    assert np.allclose(share[:, 0], [0.7, 0.3, 0], atol=0.08) and np.allclose(share[:, 1], [0, 0, 1]) and np.allclose(share[:, 2], [0.4, 0.3, 0.3], atol=0.1)
    assert (share[:, 3:] == 0).all()


def plain_mixture(scores, words, start):
    """EM over one text, word by word: proportions and log-likelihood (both of likelihoods scaled to a best of 1)."""
    share = list(start)
    for _ in range(language_id.ITERATIONS):
        total = [0.0] * len(share)
        for w in words:
            joint = [s * np.exp(max(row[w] - max(r[w] for r in scores), -60)) for s, row in zip(share, scores)]
            for k, j in enumerate(joint):
                total[k] += j / sum(joint)
        share = [t / len(words) for t in total]
    log = sum(np.log(sum(s * np.exp(max(row[w] - max(r[w] for r in scores), -60)) for s, row in zip(share, scores))) for w in words)
    return share, log


def plain_infer(scores, words):
    """The languages of one text, added one by one (by their share in the mixture of all) while each pays its penalty."""
    n = len(scores)
    if not len(words):
        return [0.0] * n
    single = [sum(row[w] - max(r[w] for r in scores) for w in words) for row in scores]
    best = max(range(n), key=lambda k: single[k])
    out, reached = [float(k == best) for k in range(n)], single[best]
    cost = float(language_id.penalty(np.array(float(len(words))), n))
    if n < 2 or -reached <= cost:
        return out
    full, _ = plain_mixture(scores, words, [1 / n] * n)
    order = sorted(range(n), key=lambda k: -full[k])
    for size in range(2, n + 1):
        begin = [max(full[k], 1e-6) if k in order[:size] else 0.0 for k in range(n)]
        share, log = plain_mixture(scores, words, [b / sum(begin) for b in begin])
        if log - (size - 1) * cost <= reached:
            break
        out, reached = share, log - (size - 1) * cost
    return out


def test_inference_equals_a_plain_loop():
    rng = np.random.default_rng(8)
    sizes = [0, 1, 3, 40, 60, 0, 25, 90]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    for n_lang in (1, 2, 4):
        scores = -rng.gamma(2.0, 2.0, (n_lang, bounds[-1]))
        for t, size in enumerate(sizes):  # one main language, or two by halves
            own = [t % n_lang, (t + 1) % n_lang][: 1 + t % 2]
            for i, w in enumerate(range(bounds[t], bounds[t + 1])):
                scores[own[i % len(own)], w] += 8
        got = language_id.infer(scores.astype(np.float32), bounds)
        for t in range(len(sizes)):
            assert got[:, t] == pytest.approx(plain_infer(scores.tolist(), range(bounds[t], bounds[t + 1])), abs=2e-3), (n_lang, t)
        assert n_lang == 1 or any((got[:, t] > 0.2).sum() == 2 for t in range(len(sizes)))


def test_language_edges(spark):
    rows = [(1, "aaa bbb", "x", None), (2, None, "x", None), (3, "...", None, None), (4, "ccc", None, None), (4, "ccc", None, None), (None, "aaa", "x", None)]
    docs = documents(spark, rows).withColumn("lang_pred", F.lit("clash")).withColumn("language", F.lit(1))
    got = Counter((r["doc_id"], r["lang_pred"]) for r in language_id.report(docs).collect())
    assert got[(2, "und")] == got[(3, "und")] == 1 and got[(4, "x")] == 2
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 4]
    none = language_id.report(documents(spark, [(1, "abc", None, None)])).first()  # nothing to learn from
    assert (none["lang_pred"], none["score"]) == ("und", 0.0)
    assert language_id.report(documents(spark, [])).count() == 0


# ---------------------------------------------------------------- mixing

def water(budget, children):
    """Exact shares of (name, weight, capacity) by repeated filling, rounded down at the end."""
    left, live, out = Fraction(budget), {n: (w, c) for n, w, c in children if w > 0}, {n: 0 for n, _, _ in children}
    while live:
        total = sum(w for w, _ in live.values())
        full = [n for n, (w, c) in live.items() if c * total <= w * left]
        if not full:
            return out | {n: int(left * w / total) for n, (w, _) in live.items()}
        for n in full:
            out[n] = live[n][1]
            left -= live.pop(n)[1]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_water_filling(spark, seed):
    rng = random.Random(seed)
    families = {f"f{k}": [(f"n{i}", rng.randint(0, 4), rng.choice([0, 5, 50, 1000, 10**12])) for i in range(rng.randint(1, 8))] for k in range(6)}
    rows, want = [], {}
    for f, children in families.items():
        children = [(n, w, c if w else 0) for n, w, c in children]
        budget = min(rng.choice([0, 7, 300, 10**6]), sum(c for _, _, c in children))
        rows += [(f, n, w, c, budget) for n, w, c in children]
        want |= {(f, n): s for n, s in water(budget, children).items()}
    nodes = spark.createDataFrame(rows, "f string, n string, weight long, capacity long, budget long") \
        .select("f", "n", *[F.col(c).cast("decimal(38,0)").alias(c) for c in ("weight", "capacity", "budget")])
    assert {(r["f"], r["n"]): int(r["share"]) for r in mixing.part(nodes, ["f"], "n").collect()} == want


def test_the_plan_takes_seeded_prefixes(spark):
    rng = random.Random(11)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 30))), rng.choice(["en", "de"]), f"src{rng.randint(0, 5)}") for i in range(400)] + [(900, None, None, None), (901, "a b", None, "x")]
    options = {"weights": {"lang": {"en": 3}, "source": {"src2": 0}}, "max_epochs": 2}
    got = mixing.plan(documents(spark, rows), **options).collect()
    again = mixing.plan(documents(spark, rows[::-1]).repartition(5), **options).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    tokens = sum(len((t or "").split()) for _, t, _, _ in rows)
    taken = sum(r["tokens_taken"] for r in got)
    assert tokens - 20 <= taken <= tokens and not any(r["source"] == "src2" for r in got)
    leaves = {}
    for r in got:
        leaves.setdefault((r["domain"], r["lang"], r["source"]), []).append(r)
    for own in leaves.values():
        own.sort(key=lambda r: r["stream_start"])
        assert own[0]["stream_start"] == 0
        assert all(a["stream_start"] + a["tokens"] == b["stream_start"] and a["tokens"] == a["tokens_taken"] for a, b in zip(own, own[1:]))
    assert {(r["domain"], r["lang"]) for r in got if r["doc_id"] == 901} <= {("unknown", "unknown")}


def test_mixed_documents_hold_the_tokens_taken(spark):
    rng = random.Random(12)
    rows = [(i, "\n".join(" ".join(rng.choice("abc") for _ in range(4)) for _ in range(rng.randint(1, 9))), "en", f"src{i % 3}") for i in range(60)] * 2
    docs = documents(spark, rows).withColumn("took", F.lit("own"))
    plan = mixing.plan(docs, weights={"source": {"src1": 9}}, max_epochs=3)
    out = mixing.mixed(docs, weights={"source": {"src1": 9}}, max_epochs=3)
    assert out.columns == docs.columns
    have = Counter((r["doc_id"], len(r["text"].split())) for r in out.collect())
    assert have == Counter((r["doc_id"], r["tokens_taken"]) for r in plan.collect())
    assert mixing.mixed(documents(spark, []), weights={}).count() == 0


def test_mixing_tells_all_rows_apart(spark):
    rows = [("x", "y:a b", "en", "src1", 1), ("x:y", "a b", "en", "src1", 2), ("null", "q", "en", "src1", 3), (None, "q", "en", "src1", 4),
            ("d", "same text", "en", "src1", 5), ("d", "same text", "de", "src2", 6), ("d", "same text", "de", "src2", 7), ("e", "r", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string, n_chars bigint")
    # every token is wanted: each row comes once, with its own columns
    out = mixing.mixed(docs, weights={}, max_epochs=1)
    assert Counter(map(tuple, out.collect())) == Counter(rows)
    twice = mixing.mixed(docs, weights={}, max_epochs=2, budget=2 * sum(len(r[1].split()) for r in rows))
    assert Counter(map(tuple, twice.collect())) == Counter(rows * 2)


# ---------------------------------------------------------------- token output

ODD = ["", None, "  a  b ", "don't we'll I'd 's", "É é ﬁ ß İ ſ K", "漢字 かな 😀😀 ab", "<|endoftext|>x <|startoftext|> <|endoftext|>", "tab\tx\x0by\x1cz w v​q", "x" * 3000,
       "\r\n a\r\nb", "123 4,5 --- ... !!!", "ΑΣ Σ", "a\x00b", "Ὀδυσσεύς é́", "".join(map(chr, range(32, 256))), "x!'s y're z''ll 1²¼ª", "l'été ÀÉÎõü ÿ× ÷ñ",
       "'", "s's'", "'south 'll'm'd", "''s", "!'s", "x'", "sé'é's"]


def direct(texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(token_output.tokenizer_path())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_the_encoder_equals_the_tokenizer():
    docs = pa.parquet.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    for cache in (1_000_000, 50):
        encoder = token_output.Encoder(token_output.tokenizer_path(), cache)
        for texts in (ODD, docs[:60], ODD[::-1], [""], ODD[3:4]):
            if texts:
                ids, counts = encoder.encode(*textbuf.buffer_of(pa.array(texts, pa.string())))
                assert [x.tolist() + [1] for x in np.split(ids, np.cumsum(counts)[:-1])] == direct(texts)


def test_words_of_one_hash_keep_their_own_ids():
    # a Thue-Morse word and its complement agree in any polynomial hash modulo 2 ** 64
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    texts = [morse, morse.translate(str.maketrans("ab", "ba")), f"{morse} x {morse.translate(str.maketrans('ab', 'ba'))}"]
    hashes = textbuf.hash_words([t.encode() for t in texts[:2]])
    assert hashes[0] == hashes[1]
    ids, counts = token_output.Encoder(token_output.tokenizer_path()).encode(*textbuf.buffer_of(pa.array(texts)))
    assert [x.tolist() + [1] for x in np.split(ids, np.cumsum(counts)[:-1])] == direct(texts)


def test_other_tokenizers_get_texts_whole(spark, tmp_path):
    import json
    from tokenizers import Tokenizer
    other = token_output.tokenizer_path("byte_bpe_50k.json")
    # the known kind but for one setting
    spec = json.loads(Tokenizer.from_file(token_output.tokenizer_path()).to_str())
    spec["normalizer"]["normalizers"].pop()
    cased = tmp_path / "cased.json"
    cased.write_text(json.dumps(spec))
    assert token_output.cuts_words(Tokenizer.from_file(token_output.tokenizer_path()))
    texts = ["Two words, 42", "", None, "漢字 É", "a\n\nb"]
    for path in (other, str(cased)):
        tokenizer = Tokenizer.from_file(path)
        assert not token_output.cuts_words(tokenizer)
        docs = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
        out = str(tmp_path / f"out{len(path)}")
        token_output.write_tokens(docs, out, tokenizer=path)
        got = {r["doc_id"]: r["ids"] for r in token_output.read_tokens(spark, out).collect()}
        assert got == {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}


def test_files_are_ordered_by_their_numbers(spark):
    names = [f"part-{n:05d}-x-c000.zstd.parquet" for n in (99_999, 100_000, 100_001, 7, 10)]
    got = spark.createDataFrame([(n,) for n in names], "f string").orderBy(token_output.file_number(F.col("f"))).collect()
    assert [r["f"] for r in got] == [names[i] for i in (3, 4, 0, 1, 2)]


def test_tokens_are_written_in_order_and_read_back(spark, tmp_path):
    texts = ODD * 3
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    docs = documents(spark, [(i, texts[i], None, None) for i in order]).repartition(6)
    ids = direct(texts)
    for encoding in ("dictionary", "delta"):
        path = str(tmp_path / encoding)
        rows = sorted(token_output.report(docs, path, encoding=encoding, page_rows=10).collect(), key=lambda r: r["doc_id"])
        start = 0
        for r, x in zip(rows, ids, strict=True):
            assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
            start += len(x)
        files = sorted((tmp_path / encoding).glob("*.parquet"))
        tables = [pa.parquet.ParquetFile(f) for f in files]
        assert [i for t in tables for i in t.read(["doc_id"]).column(0).to_pylist()] == sorted(order)
        column = tables[0].metadata.row_group(0).column(2)
        assert any("DICTIONARY" in e for e in column.encodings) == (encoding == "dictionary") and column.has_column_index and column.has_offset_index
        assert any("DELTA" in e for e in column.encodings) == (encoding == "delta")
        some = token_output.read_tokens(spark, path, "doc_id between 5 and 7").collect()
        assert {r["doc_id"]: list(r["ids"]) for r in some} == {i: ids[i] for i in (5, 6, 7)}
        counts = token_output.read_counts(spark, path)
        assert "ids" not in counts._jdf.queryExecution().executedPlan().toString()


def test_token_edges(spark):
    docs = documents(spark, [(2, "b", None, None), (None, None, None, None), (1, "a", None, None), (1, "a", None, None)]).withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit(2))
    rows = token_output.report(docs).collect()
    assert sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in rows) == [(0, None, 1), (1, 1, 2), (3, 1, 2), (5, 2, 2)]
    assert token_output.report(documents(spark, [])).count() == 0


# ---------------------------------------------------------------- the pipeline

def test_each_stage_keeps_to_its_contract(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        out = stage(spark, docs, SF).collect()
        ids = {r["doc_id"] for r in out}
        assert ids <= {r["doc_id"] for r in before}
        if name == "language_id":
            assert len(out) == len(before)  # every given document has a main language
        if name == "simhash_dedup":
            prints = {r["doc_id"]: contract_print(r["text"]) for r in before}
            near = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3]
            assert ids == set(components_of(prints, near).values()) and len(out) == len(ids)
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            dirty = {i for i, r in contract_report([(r["doc_id"], r["text"]) for r in before], items).items() if r[4]}
            assert ids == {r["doc_id"] for r in before} - dirty
        docs = spark.createDataFrame(out, docs.schema)
        assert docs.columns == columns
    name, stage = corpus_pipeline.STAGES[-1]
    last = stage(spark, docs, SF).collect()
    want = {}
    for r in docs.collect():
        want.setdefault(r["doc_id"], []).append(len(direct([r["text"]])[0]))
    got = {}
    for r in last:
        got.setdefault(r["doc_id"], []).append(r["n_tokens"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_stages_take_nulls_repeats_and_empty_tables(spark, tmp_path):
    import corpus_pipeline
    rows = [(1, None, None, None, None), (1, "", "en", "src1", 0), (None, None, None, None, None), (2, "some words here and there", "en", "src1", 25),
            (2, "some words here and there", "en", "src1", 25), (None, "quelques mots pour voir", "fr", None, None), (3, " \n ", None, "src2", 3)]
    benchmark = spark.createDataFrame([("b", None), (None, "of words")], "item_id string, text string")
    for part, data in enumerate((rows, [])):
        folder = str(tmp_path / str(part))
        spark.createDataFrame(data, DOCS).write.parquet(f"{folder}/documents.parquet")
        benchmark.write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        # texts without a letter are rejected; of equal texts one stays
        assert {r["doc_id"] for r in out} == ({2, None} if data else set())
        assert all(r["n_tokens"] > 1 for r in out)


def test_run_writes_every_stage(spark):
    import corpus_pipeline
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "start", "n_tokens", "ids_crc32"}


# ---------------------------------------------------------------- empty tables, clashing columns, long texts

def test_empty_tables(spark):
    docs, none = documents(spark, []), spark.createDataFrame([], "item_id bigint, text string")
    some = documents(spark, [(1, "a b c", "en", "src1")])
    assert decontaminate.report(docs, none).count() == 0 and simhash.report(docs).count() == 0
    assert mixing.plan(docs, weights={}).count() == 0 and simhash.keep_one(docs).count() == 0
    assert [r["contaminated"] for r in decontaminate.report(some, none).collect()] == [False]
    assert decontaminate.clean(some, none).collect() == some.collect()


def test_clashing_and_nested_columns_pass_through(spark):
    text = "the quick brown fox jumps over the lazy dog"
    rows = [(1, text, "en", "src1", 9, "x", [1, 2], {"a": 1}), (2, text, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS + ", `fp` string, `row_key` array<int>, `found` map<string,int>")
    items = spark.createDataFrame([(1, "something else")], "item_id bigint, text string")
    for kept, n in ((simhash.keep_one(docs), 1), (decontaminate.clean(docs, items), 2), (language_id.keep_identified(docs), 2), (mixing.mixed(docs, weights={}), 2)):
        out = kept.collect()
        assert kept.columns == docs.columns and len(out) == n
        assert next(r for r in out if r["doc_id"] == 1)["found"] == {"a": 1}


def test_a_very_long_text(spark):
    text = " ".join(f"w{i % 997}" for i in range(300_000))  # longer than a shard of the index
    passage = " ".join(f"p{i}" for i in range(13))
    words = text.split()
    words[250_000:250_000] = passage.split()
    docs = documents(spark, [(1, " ".join(words), "en", "src1"), (2, "y" * 500_000, "en", "src1")])
    got = {r["doc_id"]: r for r in decontaminate.report(docs, spark.createDataFrame([(5, passage)], "item_id bigint, text string")).collect()}
    assert (got[1]["n_words"], got[1]["n_hit"], got[2]["n_words"]) == (300_013, 13, 1)
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in simhash.report(docs).collect()}
    assert prints == {1: contract_print(" ".join(words)), 2: contract_print("y" * 500_000)}
    assert {r["doc_id"]: r["n_tokens"] for r in token_output.report(docs).collect()} == {i: len(direct([t])[0]) for i, t in ((1, " ".join(words)), (2, "y" * 500_000))}
    assert {r["lang_pred"] for r in language_id.report(docs).collect()} == {"en"}
