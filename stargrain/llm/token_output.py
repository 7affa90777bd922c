"""Token ids as Parquet list columns, with controlled encodings, row groups and page indexes.

``write_tokens`` sorts the texts by id (one range exchange of the texts), encodes them in Arrow
batches and writes one row per document: doc_id, n_tokens and the list of ids.  Ids of a bounded
vocabulary are dictionary-encoded; beyond the dictionary's size, or with ``encoding="delta"``, they are
delta-packed.  Row groups and pages have stated sizes, and the writer adds column and offset indexes, so
a reader that asks for some documents or for the counts alone touches only those pages and columns.
``read_tokens`` and ``read_counts`` are such readers; ``starts`` numbers the tokens of the whole set in
file order from the counts alone.

The tokenizer's model runs on each distinct word only once per task (a bounded cache, checked by the words'
bytes); texts with characters beyond Latin-1, and all texts if the tokenizer is not of the kind whose words
are cut here (``cuts_words``), go to it whole.  The tests compare both ways with encoding whole texts.

Defined results: null and empty texts encode to the end id alone; repeated ids are ordered by their
text's digest, equal rows arbitrarily; a null id comes first; an empty table writes an empty file set.
Other columns of the input are not written.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stargrain.llm import textbuf
from stargrain.llm.common import in_arrow, q
from stargrain.session import scratch_dir

END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# distinct words, and their bytes, kept by a task's encoder before it starts afresh: bounds memory, changes no result
CACHE_WORDS = 500_000
CACHE_BYTES = 16 << 20
# text that is encoded at once (a longer text by itself)
PIECE_BYTES = 256 << 10
ROW_GROUP_BYTES = 64 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
DICTIONARY_BYTES = 1 << 20


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# Byte classes of the plain texts (Latin-1 without controls and the no-break space), the only ones cut into words
# here: the tokenizer's normalizer changes those by lower-casing only.  The classes are those of the
# tokenizer's own word pattern: letters, single digits, runs of anything else; blanks part words.
BLANK, LETTER, NUMBER, OTHER, ODD = 0, 1, 2, 3, 4


def _class_of(c: int) -> int:
    char = chr(c)
    if char in "\t\n\r ":
        return BLANK
    if c < 32 or 127 <= c <= 160:
        return ODD
    kind = unicodedata.category(char)[0]
    return LETTER if kind == "L" else NUMBER if kind == "N" else OTHER


_ONE = np.array([_class_of(c) if c < 128 else ODD for c in range(256)], np.uint8)
# by the second byte, after the first bytes C2 and C3
_AFTER_C2 = np.array([_class_of(c) if 128 <= c < 192 else ODD for c in range(256)], np.uint8)
_AFTER_C3 = np.array([_class_of(c + 64) if 128 <= c < 192 else ODD for c in range(256)], np.uint8)
_LOWER_C3 = np.array([c + 32 if 0x80 <= c <= 0x9E and c != 0x97 else c for c in range(256)], np.uint8)
# the endings that the word pattern splits off after an apostrophe
_ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, word starts, word ends, texts that are not plain) of a buffer of texts."""
    n = len(data)
    data = textbuf.LOWER[data]
    kind = _ONE[data]
    for lead, table in ((0xC2, _AFTER_C2), (0xC3, _AFTER_C3)):
        at = np.flatnonzero(data[:-1] == lead) if n else np.zeros(0, np.int64)
        kind[at] = kind[at + 1] = table[data[at + 1]]
        if lead == 0xC3:
            data[at + 1] = _LOWER_C3[data[at + 1]]
    odd = np.flatnonzero(kind == ODD)
    marks = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)) if n else odd  # "<|" may begin a special token
    whole = np.unique(np.searchsorted(offsets, np.concatenate([odd, marks]), side="right") - 1)
    if not n:
        return data, odd, odd, whole
    # a word begins where the class changes, at a text's start, and at each number's first byte
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[0] = edge[n] = True
    edge[1:n] |= kind[1:] != kind[:-1]
    edge[:n] |= (kind == NUMBER) & ((data < 128) | (data >= 0xC0))
    bounds = np.flatnonzero(edge)
    starts, ends = bounds[:-1], bounds[1:]
    real = kind[starts] != BLANK
    starts, ends = starts[real], ends[real]
    quotes = np.flatnonzero((data[starts] == 39) & (ends == starts + 1))
    if len(quotes) and len(starts) > 1:
        quotes = quotes[quotes + 1 < len(starts)]
        after = quotes + 1
        quotes = quotes[(starts[after] == ends[quotes]) & (kind[starts[after]] == LETTER) & ~np.isin(starts[after], offsets)]
        gone = []
        starts, ends = starts.copy(), ends.copy()
        for k in quotes.tolist():
            tail = data[starts[k + 1]:min(starts[k + 1] + 2, ends[k + 1])].tobytes()
            size = next((len(x) for x in _ENDINGS if tail.startswith(x)), 0)
            if size:
                ends[k] += size
                starts[k + 1] += size
                if starts[k + 1] == ends[k + 1]:
                    gone.append(k + 1)
        starts, ends = np.delete(starts, gone), np.delete(ends, gone)
    return data, starts, ends, whole


# Settings that the word path stands in for; a tokenizer with others gets its texts whole.  Fixed values of the format:
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False,
          "byte_fallback": False, "ignore_merges": False}


def cuts_words(tokenizer) -> bool:
    """Whether a tokenizer is of the ``word_bpe`` kind: its normalizer, word pattern and model are those that
    ``plain_words`` stands in for, nothing is added after the model, and its added tokens begin with ``<|``."""
    spec = json.loads(tokenizer.to_str())
    model = spec["model"]
    return (spec["normalizer"] == _NORMALIZER and spec["pre_tokenizer"] == _PRE_TOKENIZER and spec["post_processor"] is None
            and spec["truncation"] is None and all(model.get(k) == v for k, v in _MODEL.items())
            and all(t["content"].startswith("<|") for t in spec["added_tokens"]))


class _HashCodes:
    """An open-addressing table from 64-bit word hashes to codes, filled and read in bulk."""

    def __init__(self, bits: int):
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.codes = np.full(1 << bits, -1, np.int32)

    def get(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        slot = (hashes & self.mask).astype(np.int64)
        live = np.arange(len(hashes))
        while len(live):
            code = self.codes[slot]
            hit = (self.keys[slot] == hashes[live]) & (code >= 0)
            out[live[hit]] = code[hit]
            go = ~hit & (code >= 0)
            live, slot = live[go], (slot[go] + 1) & int(self.mask)
        return out

    def add(self, hashes: np.ndarray, first: int) -> None:
        """New, distinct hashes; their codes are ``first`` and the numbers after it."""
        codes = np.arange(first, first + len(hashes), dtype=np.int32)
        slot = (hashes & self.mask).astype(np.int64)
        live = np.arange(len(hashes))
        while len(live):
            free = self.codes[slot] < 0
            self.codes[slot[free]] = codes[live[free]]  # of several at one slot the last stays
            self.keys[slot[free]] = hashes[live[free]]
            go = self.codes[slot] != codes[live]
            live, slot = live[go], (slot[go] + 1) & int(self.mask)


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    while len(array) < size:
        array = np.concatenate([array, np.zeros_like(array)])
    return array


class Encoder:
    """``tokenizers`` with a cache of the ids of words, for tokenizers of the ``word_bpe`` kind: a
    normalizer that composes, folds blanks and lower-cases, words by pattern, byte-level BPE with word ends.
    The cache finds a word by a 64-bit hash and compares its bytes with those of the word found; words whose hash is
    another word's have codes of their own.  When it is full it starts afresh.  Other tokenizers encode every text whole."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = cuts_words(self.tokenizer)
        if not self.by_words:
            return
        # the same model over words that are cut and byte-mapped already
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # both bytes of a Latin-1 character, as the byte-level step writes them
        self.byte_map = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(161, 256)}
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.cache_words, self.cache_bytes = cache_words, cache_bytes
        self._clear()

    def _clear(self) -> None:
        self.table = _HashCodes(max(12, int(np.ceil(np.log2(self.cache_words))) + 1))
        self.odd: dict[bytes, int] = {}  # words whose hash another word has
        self.n = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)  # ids of word k: start[k] to start[k + 1]
        self.text = np.zeros(1 << 16, np.uint8)
        self.at = np.zeros(1 << 14, np.int64)  # bytes of word k: at[k] to at[k + 1]

    def _model(self, words: list[str]) -> np.ndarray:
        text = " ".join(words)
        if not text.isascii():
            text = " ".join(w if w.isascii() else w.translate(self.byte_map) for w in words)
        return np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, new: list[bytes]) -> int:
        """Encode new words: many in one text, parted again after each id that ends a word.  Returns the first one's code."""
        known = self.n
        for i in range(0, len(new), 512):
            part = [w.decode() for w in new[i:i + 512]]
            ids = self._model(part)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part) or cuts[-1] != len(ids):
                pieces = [self._model([w]) for w in part]
                ids, cuts = np.concatenate(pieces), np.cumsum([len(x) for x in pieces])
            end = int(self.start[self.n])
            self.ids, self.start = _grown(self.ids, end + len(ids)), _grown(self.start, self.n + len(part) + 1)
            self.ids[end:end + len(ids)] = ids
            self.start[self.n + 1:self.n + len(part) + 1] = end + cuts
            self.n += len(part)
        text = np.frombuffer(b"".join(new), np.uint8)
        end = int(self.at[known])
        self.text, self.at = _grown(self.text, end + len(text)), _grown(self.at, self.n + 1)
        self.text[end:end + len(text)] = text
        self.at[known + 1:self.n + 1] = end + np.cumsum([len(w) for w in new])
        return known

    def _codes(self, data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The codes of the words at ``a`` to ``b``, learning those that are new."""
        hashes = textbuf.word_hashes(data, a, b)
        code = self.table.get(hashes)
        missing = np.flatnonzero(code < 0)
        if len(missing) and (self.n > self.cache_words // 2 and self.n + len(missing) > self.cache_words or self.at[self.n] > self.cache_bytes):
            self._clear()
            missing = np.arange(len(hashes))
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            if self.n + len(new) > len(self.table.keys) * 3 // 4:  # more words at once than the table was made for
                table, self.table = self.table, _HashCodes(int(np.ceil(np.log2(self.n + len(new)))) + 1)
                held = np.flatnonzero(table.codes >= 0)
                held = held[np.argsort(table.codes[held])]
                for run in np.split(held, np.flatnonzero(np.diff(table.codes[held]) != 1) + 1):
                    if len(run):
                        self.table.add(table.keys[run], int(table.codes[run[0]]))
            first = missing[first]
            known = self._learn([data[x:y].tobytes() for x, y in zip(a[first].tolist(), b[first].tolist())])
            self.table.add(new, known)
            code[missing] = self.table.get(hashes[missing])
        # a hash may be another word's: compare lengths, then bytes
        size = b - a
        other = size != self.at[code + 1] - self.at[code]
        same = np.flatnonzero(~other)
        n = size[same]
        before = np.cumsum(n) - n
        at = np.arange(int(n.sum()))
        wrong = np.flatnonzero(data[at + np.repeat(a[same] - before, n)] != self.text[at + np.repeat(self.at[code[same]] - before, n)])
        other[same[np.searchsorted(before, wrong, side="right") - 1]] = True
        for k in np.flatnonzero(other).tolist():
            word = data[a[k]:b[k]].tobytes()
            if word not in self.odd:
                self.odd[word] = self._learn([word])
            code[k] = self.odd[word]
        return code

    def _whole(self, data: np.ndarray, offsets: np.ndarray, which) -> list[np.ndarray]:
        texts = [data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in which]
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a buffer one after another, ids in each text)."""
        if not self.by_words:
            pieces = self._whole(data, offsets, range(len(offsets) - 1))
            return np.concatenate([np.zeros(0, np.uint32), *pieces]), np.array([len(p) for p in pieces], np.int64)
        lowered, starts, ends, whole = plain_words(data, offsets)
        if len(whole):
            text_of = np.searchsorted(offsets, starts, side="right") - 1
            plain = ~np.isin(text_of, whole)
            starts, ends = starts[plain], ends[plain]
        ids, count = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(starts), 1 << 16):  # so many words are known at once at least
            code = self._codes(lowered, starts[at:at + (1 << 16)], ends[at:at + (1 << 16)])
            begin, c = self.start[code], self.start[code + 1] - self.start[code]
            total = np.concatenate([[0], np.cumsum(c)])
            ids.append(self.ids[np.arange(total[-1]) + np.repeat(begin - total[:-1], c)])
            count.append(c)
        ids, total = np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(count))])
        bounds = np.searchsorted(starts, offsets)
        counts = total[bounds[1:]] - total[bounds[:-1]]
        if not len(whole):
            return ids, counts
        pieces = np.split(ids, np.cumsum(counts)[:-1])
        for i, found in zip(whole.tolist(), self._whole(data, offsets, whole.tolist())):
            pieces[i] = found
        return np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int, text: str) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path)
    for batch in batches:
        data, offsets = textbuf.buffer_of(batch.column(batch.schema.get_field_index(text)))
        keep = [i for i, c in enumerate(batch.schema.names) if c != text]
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, side="right")) - 1)
            ids, counts = encoder.encode(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
            lengths = counts + 1
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            flat = np.full(int(bounds[-1]), end_id, np.int32)
            own = np.ones(len(flat), bool)
            own[bounds[1:] - 1] = False
            flat[own] = ids
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).slice(at, to - at) for i in keep), pa.array(lengths.astype(np.int64)), lists],
                names=[*(batch.schema.names[i] for i in keep), "n_tokens", "ids"])
            at = to
        pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, text: str, path: str, end_id: int = END_ID) -> DataFrame:
    """The other columns of ``docs`` with n_tokens (the end id counts) and ids."""
    schema = T.StructType([f for f in docs.schema.fields if f.name != text]
                          + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return in_arrow(docs, lambda batches: _encoded(batches, path, end_id, text), schema)


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, encoding: str = "dictionary", row_group_bytes: int = ROW_GROUP_BYTES,
                 page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS, compression: str = "zstd") -> None:
    """Write doc_id, n_tokens, ids to ``path``, ascending by doc_id within and across files."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is 'dictionary' or 'delta'")
    texts = docs.select(F.col(q(doc_id)).alias("doc_id"), F.col(q(text)).alias("text"))
    # the digest orders repeated ids the same way at every run; it is made after the exchange
    laid = texts.repartitionByRange(F.col("doc_id").asc_nulls_first()) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    writer = encode(laid, "text", tokenizer or tokenizer_path(), end_id).write
    for key, value in {
        "compression": compression, "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows, "parquet.dictionary.page.size": DICTIONARY_BYTES,
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(), "parquet.writer.version": "v2",
    }.items():
        writer = writer.option(key, str(value))
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, where=None) -> DataFrame:
    """doc_id, n_tokens, ids of the documents for which ``where`` holds (pushed down to pages)."""
    frame = spark.read.parquet(path)
    return frame.where(where) if where is not None else frame


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and n_tokens alone: the ids' pages are not read."""
    return read_tokens(spark, path).select("doc_id", "n_tokens")


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("ids"))
        offsets = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        view = memoryview(np.ascontiguousarray(flat)).cast("B")
        crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        keep = [i for i, c in enumerate(batch.schema.names) if c != "ids"]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(crc, pa.int64())],
                                         names=[*(batch.schema.names[i] for i in keep), "ids_crc32"])


def report(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the documents' tokens (to a fresh folder of the shared checkpoint folder unless ``path`` is given) and
    return from the files: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "tokens")
    write_tokens(docs, path, **options)
    tokens = read_tokens(spark, path)
    found = tokens.select("doc_id", "n_tokens", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), "ids")
    sums = in_arrow(found, _crc, T.StructType([f for f in found.schema.fields if f.name != "ids"] + [T.StructField("ids_crc32", T.LongType())]))
    return starts(sums, read_tokens(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


def starts(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """``rows`` (with file, row and n_tokens) with ``start``: the ids of all documents before.  Files hold ascending
    ranges of documents and rows keep their order in a file, so sums by file (from the counts' column alone)
    and sums within a file are enough; one row per file meets in one task, none per document."""
    files = tokens.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.sum("n_tokens").alias("n"))
    before = files.select("file", F.coalesce(F.sum("n").over(
        Window.orderBy(file_number(F.col("file")), "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(before, "file") \
        .withColumn("start", F.col("before") + F.col("inside"))


def file_number(name):
    """The number of a part file: names have five digits at least, so they do not sort beyond 100,000 files."""
    return F.regexp_extract(name, "^part-([0-9]+)", 1).try_cast("bigint")
