"""Periodic runs of words, by block convolution.

A run is a stretch of words that repeats with its least period q, is at least ``max(min_length, 2 * q)`` long and
cannot be extended: words q apart are equal in it.  Periods are searched by dyadic scales [2**k, 2**(k+1)).
A run of such a period holds so many positions whose word comes again q later that one aligned block of the
scale's length lies among them.  So every block is compared with the window that follows at the
scale's distances: the sum of squared differences of word numbers is a correlation, taken by a
number-theoretic transform modulo the prime 7 * 2**20 + 1.  The transforms are products with matrices of roots of unity;
residues are kept balanced, so that every sum stays below 2**53 and float64 is exact.  A sum is 0 modulo the prime
wherever a block comes again; the distances seed extensions, which compare the words themselves, so a sum that is only a
multiple of the prime seeds nothing.  Adjacent blocks with one distance are one seed, and seeds inside a run already known
of a period that divides their distance are left out, which keeps long runs of short periods cheap.

The documents of an Arrow batch are searched together, in pieces of about a megabyte of text (a longer text is
a piece of its own); no document leaves its task, and nothing is shuffled.

Defined results: null counts as empty; a text with fewer than ``min_length`` words has no runs; blanks at either
end and between words are dropped in the collapsed text; runs of different periods may overlap, and each is
reported; repeated rows and ids each get their row; an empty table gives an empty result; input columns keep their names, and
the added column takes underscores if its name is taken; a very long text needs about 200 bytes a word in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stargrain.llm import textbuf
from stargrain.llm.common import NOT_BLANK, free_name, in_arrow, q

MIN_LENGTH = 12
PRIME = 7 * (1 << 20) + 1
ROOT = 3  # generates the numbers modulo PRIME
MOST = 1 << 20  # the longest transform that PRIME allows
RADIX = 64  # transforms up to this size are one matrix product
PIECE_BYTES = 1 << 20
CHUNK = 1 << 17  # numbers of a chunk of blocks that are transformed together

WORD_BYTE = np.ones(256, dtype=bool)
WORD_BYTE[[32, *range(9, 14)]] = False


def _reduce(x: np.ndarray) -> np.ndarray:
    """``x`` modulo PRIME, in place, to about -PRIME / 2 .. PRIME / 2."""
    whole = x * (1.0 / PRIME)
    np.rint(whole, out=whole)
    whole *= PRIME
    x -= whole
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo PRIME, balanced, by doubling."""
    out = np.ones(n)
    have, step = 1, base
    while have < n:
        part = out[:min(have, n - have)] * float(step if step <= PRIME // 2 else step - PRIME)
        out[have:have + len(part)] = _reduce(part)
        have, step = 2 * have, step * step % PRIME
    return out


class _Transform:
    """Transforms of size n of the rows of a matrix.  ``spread`` takes rows in order (the rest of a short row counts as zeros) and
    gives coefficients in an order of its own; ``gather`` takes those and gives the first values of the inverse
    (times n).  ``sign`` is that of the exponent."""

    def __init__(self, n: int):
        self.n = n
        self.n1 = n if n <= RADIX else 1 << ((n.bit_length() - 1 + 1) // 2 if n <= RADIX * RADIX else RADIX.bit_length() - 1)
        self.n2 = n // self.n1
        k = np.arange(self.n1)
        self.matrix = {s: _powers(self._root(self.n1, s), self.n1)[np.outer(k, k) % self.n1] for s in (1, -1)}
        if self.n2 > 1:
            self.sub = transform(self.n2)
            exponent = np.outer(k, np.arange(self.n2)) % n
            self.twiddle = {s: _powers(self._root(n, s), n)[exponent] for s in (1, -1)}

    @staticmethod
    def _root(n: int, sign: int) -> int:
        root = pow(ROOT, (PRIME - 1) // n, PRIME)
        return root if sign > 0 else pow(root, -1, PRIME)

    def spread(self, x: np.ndarray, sign: int) -> np.ndarray:
        if self.n2 == 1:
            return _reduce(x @ self.matrix[sign][:x.shape[1]])
        rows = x.shape[1] // self.n2
        y = _reduce(np.matmul(self.matrix[sign][:, :rows], x.reshape(len(x), rows, self.n2)))
        y *= self.twiddle[sign]
        return self.sub.spread(_reduce(y).reshape(-1, self.n2), sign).reshape(len(x), self.n)

    def gather(self, x: np.ndarray, sign: int, first: int) -> np.ndarray:
        if self.n2 == 1:
            return _reduce(x @ self.matrix[sign][:, :first])
        y = self.sub.gather(x.reshape(-1, self.n2), sign, self.n2).reshape(len(x), self.n1, self.n2)
        y *= self.twiddle[sign]
        rows = -(-first // self.n2)
        return _reduce(np.matmul(self.matrix[sign][:rows], _reduce(y))).reshape(len(x), -1)[:, :first]


@lru_cache(maxsize=8)
def transform(n: int) -> _Transform:
    return _Transform(n)


def zero_mismatches(numbers: np.ndarray, squares: np.ndarray, blocks: np.ndarray, length: int, low: int,
                    distances: int) -> tuple[np.ndarray, np.ndarray]:
    """(block starts, distances) with a squared difference of 0 modulo PRIME between the ``length`` numbers at the block
    and those ``low`` .. ``low + distances - 1`` further.  ``numbers`` are balanced residues with enough
    padding behind; ``squares`` are the running sums of their squares, from 0, balanced as well."""
    size = 1 << max(1, (distances + length - 2).bit_length())
    t = transform(size)
    span = min(size, -(-(distances + length - 1) // t.n2) * t.n2)
    scale = 2 * pow(size, -1, PRIME) % PRIME
    # rows of these views are copied whole
    words, following = sliding_window_view(numbers, length), sliding_window_view(numbers, span)
    sums = sliding_window_view(squares, distances)
    at, found = [], []
    per = max(1, CHUNK // size)
    for i in range(0, len(blocks), per):
        b = blocks[i:i + per]
        pattern = t.spread(words[b], -1)
        pattern *= t.spread(following[b + low], 1)
        product = t.gather(_reduce(pattern), -1, distances)
        product *= scale
        # own squares, plus those of the words further on, less twice the products
        difference = sums[b + low + length]
        difference -= sums[b + low]
        difference += (squares[b + length] - squares[b])[:, None]
        difference -= _reduce(product)
        row, column = np.nonzero(_reduce(difference) == 0)
        at.append(b[row])
        found.append(low + column)
    none = np.zeros(0, np.int64)
    return (np.concatenate(at), np.concatenate(found)) if at else (none, none)


def _scales(longest: int, min_length: int) -> Iterator[tuple[int, int, int]]:
    """(least distance, end of distances, block length): distances of one scale, cut to what one transform takes."""
    low = 1
    while 2 * low <= longest:
        high = 4 if low == 1 else 2 * low  # the first two scales are one
        # positions in a run whose word comes again: at least this many, for any period of the scale
        repeats = min(max(min_length - p, p) for p in {low, high - 1, min(max(min_length // 2, low), high - 1), min(max(-(-min_length // 2), low), high - 1)})
        length = 1
        while 2 * (2 * length) - 1 <= repeats and 2 * length <= MOST // 4:
            length *= 2
        width = min(high - low, max(2 * length, MOST // 2 if length == MOST // 4 else 0))
        for start in range(low, high, width):
            yield start, min(start + width, high), length
        low = high


def runs_of(numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int, int]]:
    """(text, start in text, length, period) of every run, ascending.  Text t's words are ``numbers[starts[t]:ends[t]]``;
    equal words have equal numbers, and texts are parted by a number that stands nowhere else."""
    sizes = ends - starts
    longest = int(sizes.max(initial=0))
    if longest < min_length:
        return []
    padded = np.concatenate([numbers, np.full(4 * longest + 64, numbers.max() + 1)])
    residues = _reduce(padded.astype(np.float64))
    # whole numbers below 2 ** 53 however long the piece: a square is at most half of PRIME after reduction
    squares = np.zeros(len(padded) + 1)
    np.cumsum(_reduce(residues * residues), out=squares[1:])
    _reduce(squares)
    known: dict[int, dict[tuple[int, int], int]] = {}
    for low, high, length in _scales(longest, min_length):
        live = np.flatnonzero(sizes >= max(min_length, 2 * low))
        count = (sizes[live] - low) // length  # blocks that end at least the least distance before the text's end
        text_of = np.repeat(live, count)
        first = np.cumsum(count) - count
        blocks = starts[text_of] + (np.arange(len(text_of)) - np.repeat(first, count)) * length
        at, distance = zero_mismatches(residues, squares, blocks, length, low, high - low)
        if not len(at):
            continue
        order = np.lexsort((at, distance))
        at, distance = at[order], distance[order]
        text = np.searchsorted(starts, at, side="right") - 1
        # adjacent blocks with one distance are one seed
        fresh = np.ones(len(at), bool)
        fresh[1:] = (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + length) | (text[1:] != text[:-1])
        head = np.flatnonzero(fresh)
        tail = np.append(head[1:], len(at)) - 1
        a, b, d, t = at[head], at[tail] + length, distance[head], text[head]
        need = np.maximum(min_length - d, d)
        # a seed grows by less than a block on either side, within its text
        a0, b0 = np.maximum(a - length + 1, starts[t]), np.minimum(b + length - 1, ends[t] - d)
        real = b0 - a0 >= need
        a, b, d, t, a0, b0, need = (x[real] for x in (a, b, d, t, a0, b0, need))
        by_text = np.argsort(t, kind="stable")  # within a text the distances still ascend
        cuts = np.flatnonzero(np.diff(t[by_text])) + 1
        for group in np.split(by_text, cuts) if len(by_text) else []:
            _extend(padded, group, a, b, d, a0, b0, need, known.setdefault(int(t[group[0]]), {}), low)
    out = []
    for t, spans in known.items():
        out += [(t, s - int(starts[t]), e - s, p) for (s, e), p in spans.items()]
    return sorted(out, key=lambda x: (x[0], x[1], x[3]))


def _extend(padded, group, a, b, d, a0, b0, need, known: dict[tuple[int, int], int], low: int) -> None:
    """The maximal stretches around a text's seeds, added to its ``known`` runs: (start, end) to least period."""
    inside = np.zeros(len(group), bool)
    if len(group) > 1 or known:
        for (s, e), p in known.items():
            if e - s >= 2 * low:
                inside |= (a[group] >= s) & (b[group] + d[group] <= e) & (d[group] % p == 0)
    fresh: list[tuple[int, int, int]] = []
    for k in group[~inside].tolist():
        x, y, p = int(a0[k]), int(b0[k]), int(d[k])
        if any(s <= a[k] and b[k] + p <= e and p % r == 0 for s, e, r in fresh):
            continue
        wrong = np.flatnonzero(padded[x:y] != padded[x + p:y + p])
        bounds = np.concatenate([[-1], wrong, [y - x]])
        for i in np.flatnonzero(np.diff(bounds) - 1 >= need[k]).tolist():
            s, e = x + int(bounds[i]) + 1, x + int(bounds[i + 1]) + p
            known[s, e] = min(p, known.get((s, e), p))
            if p < 4:
                fresh.append((s, e, p))


def _numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each word, the words' bytes one after another, their offsets): equal words have equal numbers."""
    sizes = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    joined = data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64), joined, offsets


_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed", T.StringType())])
_RUN_ARROW = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def _piece(data: np.ndarray, offsets: np.ndarray, min_length: int) -> pa.StructArray:
    starts, ends = textbuf.word_spans(data, offsets, WORD_BYTE)
    numbers, joined, word_at = _numbered(data, starts, ends)
    bounds = np.searchsorted(starts, offsets)
    first, last, n = bounds[:-1], bounds[1:], len(offsets) - 1
    # a number of its own after each text
    placed = np.empty(len(numbers) + n, np.int64)
    place = np.arange(len(numbers)) + np.repeat(np.arange(n), last - first)
    placed[place] = numbers
    placed[last + np.arange(n)] = len(numbers) + np.arange(n)
    runs = runs_of(placed, first + np.arange(n), last + np.arange(n), min_length)
    edge = np.zeros(len(numbers) + 1, np.int64)
    for text, start, length, period in runs:
        edge[first[text] + start + period] += 1
        edge[first[text] + start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    text_of = np.searchsorted(last, kept, side="right")
    blank = np.ones(len(kept), np.int64)  # one after each kept word but a text's last
    if len(kept):
        blank[np.append(np.flatnonzero(np.diff(text_of)), len(kept) - 1)] = 0
    sizes = word_at[kept + 1] - word_at[kept]
    out_at = np.zeros(len(kept) + 1, np.int64)
    np.cumsum(sizes + blank, out=out_at[1:])
    text = np.full(int(out_at[-1]), 32, np.uint8)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text[within + np.repeat(out_at[:-1], sizes)] = joined[within + np.repeat(word_at[kept], sizes)]
    text_at = out_at[np.searchsorted(kept, bounds)].astype(np.int32)
    collapsed = pa.StringArray.from_buffers(n, pa.py_buffer(text_at), pa.py_buffer(text))
    counts = np.bincount(np.array([r[0] for r in runs], np.int64), minlength=n)
    flat = np.array([r[1:] for r in runs], np.int64).reshape(-1, 3)
    found = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_RUN_ARROW))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), found)
    return pa.StructArray.from_arrays([pa.array((last - first).astype(np.int64)), lists, collapsed], names=["n_words", "runs", "collapsed"])


def _found(batches: Iterator[pa.RecordBatch], text: str, name: str, min_length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = textbuf.buffer_of(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, side="right")) - 1)
            piece = _piece(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], min_length)
            part = batch.slice(at, to - at)
            yield pa.RecordBatch.from_arrays([*part.columns, piece], names=[*part.schema.names, name])
            at = to


def find(docs: DataFrame, *, text: str = "text", min_length: int = MIN_LENGTH) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (its name is returned too): n_words, runs (start and length in words, period;
    ascending by start, then period) and collapsed, the text with one period left of each run and one blank between words."""
    if min_length < 2:
        raise ValueError("min_length is 2 at least")
    name = free_name(docs.columns, "periodic")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, _FOUND)])
    return in_arrow(docs, lambda batches: _found(batches, text, name, min_length), schema), name


def collapse(docs: DataFrame, *, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with the texts that have runs collapsed; the others stay as they are."""
    found, name = find(docs, text=text, min_length=min_length)
    value = F.when(F.size(F.col(f"{q(name)}.runs")) > 0, F.col(f"{q(name)}.collapsed")).otherwise(F.col(q(text)))
    return found.withColumn(text, value).select(*[F.col(q(c)) for c in docs.columns])


def planted(doc_id: Column, text: Column) -> Column:
    """The text with a periodic tail where the id's crc32 ends in 0: from word a = g % n on (g: the crc32 without its last
    digit) the p = 1 + floor((n - a) / (3 + g % 8)) words from there come again and again.  Null ids change nothing."""
    h = F.crc32(doc_id.cast("string").cast("binary"))

    def grown(words: Column) -> Column:
        n, g = F.size(words), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        tail = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(words, a + i % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise(F.lit(""))

    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NOT_BLANK), F.lit(0))
    changed = F.element_at(F.transform(F.array(found), grown), 1)
    return F.when(h % 10 == 0, changed).otherwise(text)


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Of the texts with their ``planted`` tails: doc_id, n_runs, start, length, period and exponent_milli of the longest run
    (ties: least start, then period), runs_sha256, collapsed_sha256."""
    own = docs.select(F.col(q(doc_id)).alias("doc_id"), planted(F.col(q(doc_id)), F.col(q(text))).alias("text"))
    found, name = find(own, **options)
    runs = F.col(f"{name}.runs")
    # structs order by their fields: the greatest length first, then the least start and period
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    return found.select("doc_id", F.size(runs).cast("bigint").alias("n_runs"), best.alias("b"), F.sha2(listed, 256).alias("runs_sha256"),
                        F.sha2(F.col(f"{name}.collapsed"), 256).alias("collapsed_sha256")) \
        .select("doc_id", "n_runs", (-F.col("b.start")).alias("start"), F.col("b.length").alias("length"), (-F.col("b.period")).alias("period"),
                F.floor(1000 * F.col("b.length") / -F.col("b.period")).cast("bigint").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
