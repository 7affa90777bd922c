"""Benchmark decontamination: an FM-index per training shard, searched with the benchmark's windows.

Each task cuts the words of its documents into shards of bounded size, builds an
:class:`~stargrain.llm.fm_index.FMIndex` over each, runs a backward search for all windows of the
benchmark at once, locates the occurrences by sampled suffix positions, compares them word for word
and merges them into removal spans.  Documents are never shuffled.  The benchmark is the stated
query set: it goes to the tasks in blocks of bounded size, and results of several blocks meet on a
digest of the text.

Defined results: a null or empty text has no words and is clean; an item without words has no
window; repeated document rows each get their own result row; repeated item ids count once; a null
item id counts as an item named by the empty text; empty tables give empty results (no items: every
document is clean).  Columns of ``docs`` pass through untouched, clashing names included.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stargrain.llm import textbuf
from stargrain.llm.common import free_name, in_arrow, q, stored, utf8_words
from stargrain.llm.fm_index import END, FIRST, SEPARATOR, FMIndex, fold

WINDOW = 13
# words in one shard of the index: bounds a task's memory (about 150 MB), not the input
SHARD_WORDS = 400_000
# bytes of benchmark text sent to the tasks at once (some 350,000 windows, about 100 MB in a task)
BLOCK_BYTES = 2_000_000
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def windows_of(items: list[tuple[str, str | None]], window: int = WINDOW) -> dict[tuple[bytes, ...], set[str]]:
    """Each distinct window of the items with the ids that hold it."""
    found: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        words = utf8_words(text, _WORD)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(tuple(words[i:i + window]), set()).add(item)
    return found


class Patterns:
    """The windows of a block as rows of symbols, ready for backward search."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        found = windows_of(items, window)
        self.windows, self.items = list(found), [sorted(x) for x in found.values()]
        self.lengths = np.array([len(w) for w in self.windows], dtype=np.int64)
        self.longest = int(self.lengths.max()) if len(self.windows) else 0
        vocabulary = list({w for x in self.windows for w in x})
        symbol = dict(zip(vocabulary, fold(textbuf.hash_words(vocabulary)).tolist()))
        self.symbols = np.zeros((len(self.windows), self.longest), dtype=np.int16)
        for i, x in enumerate(self.windows):
            self.symbols[i, :len(x)] = [symbol[w] for w in x]


def shard_hits(index: FMIndex, patterns: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(symbol position, window number) of every occurrence of every window."""
    low, high = index.search(patterns.symbols, patterns.lengths)
    count = high - low
    which = np.repeat(np.arange(len(count)), count)
    if not len(which):
        return which, which
    ahead = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return index.locate(low[which] + ahead), which


def search_texts(data: np.ndarray, offsets: np.ndarray, patterns: Patterns,
                 shard_words: int = SHARD_WORDS) -> tuple[np.ndarray, dict[int, list[tuple[int, int]]], dict[int, set[str]]]:
    """For the texts of a buffer: word counts, removal spans (word numbers, merged) and items by text number."""
    data = textbuf.LOWER[data]
    starts, ends = textbuf.word_spans(data, offsets, textbuf.ALNUM)
    bounds = np.searchsorted(starts, offsets)  # words of text t: bounds[t] to bounds[t + 1]
    n_words = np.diff(bounds)
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    if not len(starts) or not len(patterns.windows):
        return n_words, spans, items
    folded = fold(textbuf.word_hashes(data, starts, ends))
    text_of = np.repeat(np.arange(len(n_words)), n_words)
    # a text may end after any word: the separators are spread in between
    at = 0
    while at < len(starts):
        to = min(len(starts), at + shard_words)
        jump = text_of[at:to] - text_of[at]  # every change of text is one separator
        jump = np.concatenate([[0], np.cumsum(np.diff(jump) > 0)])
        symbols = np.full(to - at + int(jump[-1]) + 2, SEPARATOR, dtype=np.int64)
        place = np.arange(to - at) + jump
        symbols[place] = folded[at:to]
        symbols[-1] = END
        position, which = shard_hits(FMIndex(symbols), patterns)
        for p, w in zip((np.searchsorted(place, position) + at).tolist(), which.tolist()):
            window = patterns.windows[w]
            if all(data[starts[p + i]:ends[p + i]].tobytes() == x for i, x in enumerate(window)):
                text = int(text_of[p])
                first = p - int(bounds[text])
                spans.setdefault(text, []).append((first, first + len(window)))
                items.setdefault(text, set()).update(patterns.items[w])
        if to == len(starts):
            break
        at = to - (patterns.longest - 1)  # shards overlap by a window less one word
    return n_words, {t: merge(s) for t, s in spans.items()}, items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("word_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("char_spans", T.ArrayType(T.ArrayType(T.LongType()))),
])
_FOUND_ARROW = pa.struct([("n_words", pa.int64()), ("word_spans", pa.list_(pa.list_(pa.int64()))),
                          ("items", pa.list_(pa.string())), ("char_spans", pa.list_(pa.list_(pa.int64())))])


def _found(batches: Iterator[pa.RecordBatch], patterns: Patterns, text: str, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = textbuf.buffer_of(batch.column(batch.schema.get_field_index(text)))
        rows = [None] * len(batch)
        at = 0
        while at < len(batch):  # at most about 4 MB of text at once, one text at least
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (4 << 20), side="right")) - 1)
            part, own = data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
            n_words, spans, items = search_texts(part, own, patterns)
            for t, n in enumerate(n_words.tolist()):
                rows[at + t] = {"n_words": n, "word_spans": [], "items": [], "char_spans": []}
            for t, found in spans.items():
                a, b = textbuf.word_spans(textbuf.LOWER[part[own[t]:own[t + 1]]], np.array([0, own[t + 1] - own[t]]), textbuf.ALNUM)
                rows[at + t] |= {"word_spans": found, "items": sorted(items[t]),
                                 "char_spans": [(textbuf.code_point_offset(part, own[t], own[t] + a[x]),
                                                 textbuf.code_point_offset(part, own[t], own[t] + b[y - 1])) for x, y in found]}
            at = to
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, _FOUND_ARROW)],
                                         names=[*batch.schema.names, name])


def _blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark (item, text) in blocks of about ``block_bytes``, each small enough for every task."""
    items = items.select(F.coalesce(F.col(q(item_id)).cast("string"), F.lit("")).alias("item"),
                         F.col(q(text)).alias("text")).where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    return [items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def overlaps(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id",
             item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (its name is returned too): n_words, word_spans, items and
    char_spans (code points; from a span's first to its last word)."""
    name = free_name(docs.columns, "overlap")
    inner = free_name(docs.columns, "found")
    blocks = _blocks(items, item_id, item_text, block_bytes)
    spark = docs.sparkSession

    def sent_patterns(block: DataFrame):
        # a block's patterns are made on the driver and are all of the benchmark that it holds at a time
        return spark.sparkContext.broadcast(Patterns([(r["item"], r["text"]) for r in block.toLocalIterator()], window))

    def scan(frame: DataFrame, column: str, sent) -> DataFrame:
        schema = T.StructType([*frame.schema.fields, T.StructField(inner, _FOUND)])
        return in_arrow(frame, lambda batches: _found(batches, sent.value, column, inner), schema)

    if len(blocks) == 1:
        return scan(docs, text, sent_patterns(blocks[0])).withColumnRenamed(inner, name), name
    # several blocks: what each found is keyed by the text itself, so equal texts share it
    key = free_name(docs.columns, "text_key")
    digest = F.sha2(F.coalesce(F.col(q(text)), F.lit("")), 256)
    texts = docs.select(digest.alias("k"), F.coalesce(F.col(q(text)), F.lit("")).alias("t")).dropDuplicates(["k"])
    both = None
    for block in blocks:
        sent = sent_patterns(block)
        part = stored(scan(texts, "t", sent).select("k", F.col(q(inner)).alias("f")), "overlaps")
        sent.destroy()  # stored: nothing reads it again
        both = part if both is None else both.unionByName(part)

    def merged(spans):
        # (first word, end word, first character, end character), merged by word numbers as within one block
        def add(acc, s):
            last = F.element_at(acc, -1)
            joined = F.concat(F.slice(acc, 1, F.size(acc) - 1),
                              F.array(F.array(last[0], F.greatest(last[1], s[1]), last[2], F.greatest(last[3], s[3]))))
            return F.when((F.size(acc) > 0) & (s[0] <= F.get(F.get(acc, F.size(acc) - 1), F.lit(1))), joined) \
                .otherwise(F.concat(acc, F.array(s)))
        return F.aggregate(F.array_sort(spans), F.array().cast("array<array<bigint>>"), add)

    # blocks, not documents, are gathered here: as many rows for a text as the benchmark has blocks
    found = both.groupBy("k").agg(F.max("f.n_words").alias("n_words"),
                                  F.flatten(F.collect_list(F.zip_with("f.word_spans", "f.char_spans", lambda w, c: F.concat(w, c)))).alias("s"),
                                  F.flatten(F.collect_list("f.items")).alias("i")) \
        .select("k", "n_words", merged(F.col("s")).alias("s"), F.array_sort(F.array_distinct("i")).alias("items")) \
        .select(F.col("k").alias(key), F.struct("n_words", F.transform("s", lambda s: F.slice(s, 1, 2)).alias("word_spans"), "items",
                                                F.transform("s", lambda s: F.slice(s, 3, 2)).alias("char_spans")).alias(name))
    return docs.withColumn(key, digest).join(found, key, "left").drop(key).select(
        *[F.col(q(c)) for c in docs.columns], F.col(q(name))), name


def report(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
           share: int = 20, **options) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated (n_hit * share >= n_words) and spans
    (code points ``start:end`` to remove, comma-joined)."""
    found, f = overlaps(docs.select(F.col(q(doc_id)).alias("doc_id"), F.col(q(text)).alias("text")), items, **options)
    hit = F.aggregate(F.col(f"{f}.word_spans"), F.lit(0).cast("bigint"), lambda a, s: a + s[1] - s[0])
    n = F.col(f"{f}.n_words")
    return found.select(
        "doc_id", n.alias("n_words"), hit.alias("n_hit"), F.size(f"{f}.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(f"{f}.items", ","), 256).alias("items_sha256"),
        ((hit > 0) & (hit * share >= n)).alias("contaminated"),
        F.array_join(F.transform(f"{f}.char_spans", lambda s: F.concat_ws(":", s[0].cast("string"), s[1].cast("string"))), ",").alias("spans"))


def clean(docs: DataFrame, items: DataFrame, *, text: str = "text", share: int = 20, cut_spans: bool = False,
          **options) -> DataFrame:
    """``docs`` without the contaminated ones; with ``cut_spans`` the smaller overlaps of the others are cut out
    of their texts, else those stay as they are."""
    found, f = overlaps(docs, items, text=text, **options)
    hit = F.aggregate(F.col(f"{q(f)}.word_spans"), F.lit(0).cast("bigint"), lambda a, s: a + s[1] - s[0])
    kept = found.where(~((hit > 0) & (hit * share >= F.col(f"{q(f)}.n_words"))))
    if cut_spans:
        body, spans = F.col(q(text)), F.col(f"{q(f)}.char_spans")
        ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s[1]))
        starts = F.concat(F.transform(spans, lambda s: s[0]), F.array(F.length(body).cast("bigint")))
        pieces = F.zip_with(ends, starts, lambda a, b: F.substring(body, a.cast("int") + 1, (b - a).cast("int")))
        kept = kept.withColumn(text, F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(body))
    return kept.select(*[F.col(q(c)) for c in docs.columns])
