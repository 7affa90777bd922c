"""Language identification by multilingual mixture inference.

A word's likelihood under a language comes from that language's character 3-grams (each letter, and the
word's end, given the two letters before), so words are the observations and a document is a mixture of
languages.  Expectation-maximisation estimates each document's proportions; the language set is the
one of greatest penalised likelihood among the best single language and the growing sets in order of
the full mixture's proportions.  A document whose best possible mixture can't repay the penalty of a
second language skips the iterations: that bound is exact, not a cutoff.

Training counts are added up by Spark over all labelled documents (or a stated number for each
language, chosen by hash); the model's size is languages x table sizes, whatever the corpus.

Defined results: null texts and texts without a letter are ``und`` with score 0 and no proportions;
nothing learned (no labelled text): every document is ``und``; ties go to the language that sorts
first; repeated rows get equal results; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stargrain.llm.common import free_name, in_arrow, q

UNDETERMINED = "und"
# hashed tables: 3-grams, and the 2-letter contexts they are conditioned on
GRAM_BITS, CONTEXT_BITS = 17, 12
SMOOTHING = 0.5
ALPHABET = 64  # letters expected after a context, for smoothing
ITERATIONS = 15
# the most labelled documents used for each language
MAX_LABELLED = 1_000_000
_CHUNK = 1 << 19  # characters worked on at once, one text at least

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Is code point c a letter, for all c."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


@dataclass
class Letters:
    """The letter positions (and word ends) of some texts: hashed 3-grams and contexts, words and texts."""

    gram: np.ndarray
    context: np.ndarray
    word_start: np.ndarray  # into gram
    text_words: np.ndarray  # words before each text, and in all


def letters_of(texts: list[str]) -> Letters:
    lowered = [t.lower() for t in texts]
    sizes = np.fromiter((len(t) + 2 for t in lowered), np.int64, len(lowered))
    code = np.frombuffer("".join(t + "  " for t in lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[code]
    x = np.where(letter, code, 0).astype(np.uint64)
    before = np.zeros(len(letter), bool)
    before[1:] = letter[:-1]
    at = np.flatnonzero(letter | before)  # a blank after a letter is the word's end
    one = x[at - 1] * (at > 0)
    two = np.where(one > 0, x[at - 2], np.uint64(0)) * (at > 1)
    pair = (two * np.uint64(0x9E3779B97F4A7C15) + one * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xD6E8FEB86659FD93)
    triple = (pair ^ (pair >> np.uint64(32)) ^ (x[at] * np.uint64(0xA0761D6478BD642F))) * np.uint64(0xE7037ED1A0B428DB)
    starts = np.flatnonzero(letter[at] & ~before[at])
    ends = np.cumsum(sizes)
    return Letters((triple >> np.uint64(64 - GRAM_BITS)).astype(np.int64), (pair >> np.uint64(64 - CONTEXT_BITS)).astype(np.int64),
                   starts, np.concatenate([[0], np.searchsorted(at[starts], ends)]))


def _texts(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in pieces of about ``_CHUNK`` characters."""
    column = batch.column(batch.schema.get_field_index(text))
    at, held, size = 0, [], 0
    for i, t in enumerate(column):
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= _CHUNK:
            yield at, held
            at, held, size = i + 1, [], 0
    if held:
        yield at, held


# ---------------------------------------------------------------- training

def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, slot, n) for a task's labelled texts; contexts take the slots after the 3-grams."""
    tables: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        for first, texts in _texts(batch, "text"):
            by: dict[str, list[str]] = {}
            for lang, t in zip(langs[first:first + len(texts)], texts):
                by.setdefault(lang, []).append(t)
            for lang, own in by.items():
                found = letters_of(own)
                table = tables.setdefault(lang, np.zeros((1 << GRAM_BITS) + (1 << CONTEXT_BITS), np.int64))
                table[:1 << GRAM_BITS] += np.bincount(found.gram, minlength=1 << GRAM_BITS)
                table[1 << GRAM_BITS:] += np.bincount(found.context, minlength=1 << CONTEXT_BITS)
    for lang, table in tables.items():
        slot = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot), pa.array(table[slot])],
                                         names=["lang", "slot", "n"])


class Model:
    """Log-likelihood tables by language, from counts."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        grams, contexts = 1 << GRAM_BITS, 1 << CONTEXT_BITS
        self.gram = np.zeros((len(self.langs), grams), np.float32)
        self.context = np.zeros((len(self.langs), contexts), np.float32)
        for i, lang in enumerate(self.langs):
            self.gram[i] = np.log(counts[lang][:grams] + SMOOTHING)
            self.context[i] = np.log(counts[lang][grams:] + SMOOTHING * ALPHABET)

    def word_scores(self, found: Letters) -> np.ndarray:
        """(languages, words) log-likelihoods."""
        if not len(found.word_start) or not self.langs:
            return np.zeros((len(self.langs), len(found.word_start)), np.float32)
        return np.stack([np.add.reduceat(self.gram[i][found.gram] - self.context[i][found.context], found.word_start)
                         for i in range(len(self.langs))])


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_labelled: int = MAX_LABELLED) -> Model:
    """A model from the rows of ``docs`` with a language and a text.  Beyond ``max_labelled`` rows of a language,
    about that many are taken by hash of id and text."""
    rows = docs.where(F.col(q(lang)).isNotNull() & F.col(q(text)).isNotNull()) \
        .select(F.col(q(doc_id)).alias("doc_id"), F.col(q(text)).alias("text"), F.col(q(lang)).cast("string").alias("lang"))
    many = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect() if r["count"] > max_labelled}
    for name, n in many.items():
        share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(max_labelled / n * (1 << 30))
        rows = rows.where((F.col("lang") != name) | share)
    sums = in_arrow(rows.select("text", "lang"), _counts, "lang string, slot bigint, n bigint") \
        .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()  # languages x table size rows at most
    names, slots, ns = (sums.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "slot", "n"))
    counts: dict[str, np.ndarray] = {}
    for name in sorted(set(names.tolist())):
        own = names == name
        counts[name] = np.zeros((1 << GRAM_BITS) + (1 << CONTEXT_BITS), np.int64)
        counts[name][slots[own].astype(np.int64)] = ns[own]
    return Model(counts)


# ---------------------------------------------------------------- inference

def _by_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=-1, dtype=np.float64)


def mixture(likelihood: np.ndarray, starts: np.ndarray, counts: np.ndarray, start_at: np.ndarray,
            iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """EM for the texts' proportions over words whose likelihoods (languages, words) are scaled to a
    largest value of 1; ``start_at`` (languages, texts).  Returns proportions and scaled log-likelihoods."""
    share = start_at.copy()
    for _ in range(iterations):
        joint = np.repeat(share.astype(np.float32), counts, axis=1) * likelihood
        joint /= joint.sum(axis=0)
        share = _by_text(joint, starts) / counts
    joint = (np.repeat(share.astype(np.float32), counts, axis=1) * likelihood).sum(axis=0)
    return share, _by_text(np.log(np.maximum(joint, 1e-30)), starts)


def penalty(words: np.ndarray, languages: int) -> np.ndarray:
    """The cost of one more language: its share (half a log of the observations) and its choice."""
    return 0.5 * np.log(words) + np.log(max(2, languages))


def infer(scores: np.ndarray, text_words: np.ndarray) -> np.ndarray:
    """Proportions (languages, texts) of the selected sets; zero columns for texts without words."""
    n_lang, n_text = scores.shape[0], len(text_words) - 1
    out = np.zeros((n_lang, n_text))
    counts = np.diff(text_words)
    own = np.flatnonzero(counts > 0)
    if not len(own) or not n_lang:
        return out
    starts, counts = text_words[own], counts[own]
    top = scores.max(axis=0)
    single = _by_text(scores - top, starts)  # scaled: 0 is the best any mixture can reach
    best = single.argmax(axis=0)
    out[best, own] = 1.0
    cost = penalty(counts, n_lang)
    reached = single[best, np.arange(len(own))]
    open_ = np.flatnonzero(-reached > cost)
    if n_lang < 2 or not len(open_):
        return out
    words = np.concatenate([np.arange(s, s + c) for s, c in zip(starts[open_], counts[open_])])
    likelihood = np.exp(np.maximum(scores[:, words] - top[words], -60)).astype(np.float32)
    counts, cost, reached, texts = counts[open_], cost[open_], reached[open_], own[open_]
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    full, _ = mixture(likelihood, starts, counts, np.full((n_lang, len(texts)), 1 / n_lang))
    rank = np.argsort(np.argsort(-full, axis=0, kind="stable"), axis=0)
    live = np.arange(len(texts))
    for size in range(2, n_lang + 1):
        at = np.concatenate([np.arange(s, s + c) for s, c in zip(starts[live], counts[live])])
        begin = np.where(rank[:, live] < size, np.maximum(full[:, live], 1e-6), 0)
        n = counts[live]
        share, log = mixture(likelihood[:, at], np.concatenate([[0], np.cumsum(n)[:-1]]), n, begin / begin.sum(axis=0))
        gain = log - (size - 1) * cost[live] > reached[live]
        won = live[gain]
        out[:, texts[won]] = share[:, gain]
        reached[won] = (log - (size - 1) * cost[live])[gain]
        live = won
        if not len(live):
            break
    return out


def _predicted(batches: Iterator[pa.RecordBatch], model: Model, text: str, name: str) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.string())])
    for batch in batches:
        langs, scores, mixes = [], [], []
        for _, texts in _texts(batch, text):
            found = letters_of(texts)
            share = infer(model.word_scores(found), found.text_words)
            for column in share.T:
                order = np.argsort(-column, kind="stable")
                known = len(order) > 0 and column[order[0]] > 0
                langs.append(model.langs[order[0]] if known else UNDETERMINED)
                scores.append(float(min(1.0, column[order[0]])) if known else 0.0)
                mixes.append(",".join(f"{model.langs[i]}:{column[i]:.3f}" for i in order if column[i] >= 0.0005))
        out = pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(mixes, pa.string())], fields=list(kind))
        yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, name])


def predict(docs: DataFrame, model: Model, *, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column (its name is returned too): lang_pred, score (the main language's
    share) and languages (``lang:share`` by falling share)."""
    name = free_name(docs.columns, "language")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("languages", T.StringType())]))])
    return in_arrow(docs, lambda batches: _predicted(batches, sent.value, text, name), schema), name


def held_out(doc_id) -> object:
    """The documents that training must not see: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """Learn from the documents that are not held out; per document doc_id, held_out, lang_pred, score, languages."""
    model = fit(docs.where(~held_out(F.col(q(doc_id)))), doc_id=doc_id, text=text, lang=lang, **options)
    found, name = predict(docs.select(F.col(q(doc_id)).alias("doc_id"), F.col(q(text)).alias("text")), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), f"{name}.*")


def keep_identified(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                    min_score: float = 1 / 3, **options) -> DataFrame:
    """``docs`` without those it rejects: no language found, or none with a share of ``min_score``."""
    model = fit(docs.where(~held_out(F.col(q(doc_id)))), doc_id=doc_id, text=text, lang=lang, **options)
    found, name = predict(docs, model, text=text)
    kept = found.where((F.col(f"{q(name)}.lang_pred") != UNDETERMINED) & (F.col(f"{q(name)}.score") >= min_score))
    return kept.select(*[F.col(q(c)) for c in docs.columns])
