"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and reduced to letters and single spaces; all n-grams of 1 to ``longest`` symbols
are hashed into ``slots``.  Training counts n-grams per language on at most ``per_language`` texts of each
language, chosen by a hash of the id (the documented bound of the classifier); priors count all
labelled rows.  The log-probability matrix, slots by languages, is broadcast, and a batch of texts is scored
at once: n-gram numbers index the matrix rows, sums run per text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import crc_mod, read
from docloom.llm.registry import query
from docloom.operators.skew import top_per_key

ROWS = 256  # rows whose texts are Python objects at a time; bounds a task's memory, not a result
NO_LETTERS = re.compile(r"[\W\d_]+")
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageOptions:
    """``longest``: symbols of an n-gram; ``slots``: hash buckets, a power of two; ``per_language``: texts
    of a language the fit may use; ``languages``: labels the matrix may hold (more is an error);
    ``alpha``: added to each count."""

    longest: int = 3
    slots: int = 1 << 16
    per_language: int = 4000
    languages: int = 512
    alpha: float = 0.5


def cleaned(text: str | None) -> str:
    """Letters in lower case, all else one space; empty if no letter is left."""
    t = NO_LETTERS.sub(" ", text.lower()).strip() if text else ""
    return t if any(map(str.isalpha, t)) else ""


def slots_of(texts: list[str], o: LanguageOptions) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of the texts and how many each text has; texts are padded with spaces."""
    runs = [f" {t} " if t else "" for t in texts]
    x = np.frombuffer("".join(runs).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(r) for r in runs], np.int64)
    number = np.repeat(np.arange(len(runs)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(x))  # symbols of this text from here on
    shift = np.uint64(64 - o.slots.bit_length() + 1)
    h = np.zeros(len(x), np.uint64)
    found, owner = [], []
    for n in range(1, o.longest + 1):
        ok = left >= n
        h[: len(x) - n + 1] = h[: len(x) - n + 1] * np.uint64(0x100000001B3) + x[n - 1 :] if len(x) >= n else 0
        at = np.flatnonzero(ok)
        found.append(((h[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int32))
        owner.append(number[at])
    slots, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return slots[order], np.bincount(owner, minlength=len(runs))


def _runs(items: list, size, limit: int = 1 << 18) -> Iterator[list]:
    run, total = [], 0
    for it in items:
        run.append(it)
        total += size(it)
        if total >= limit:
            yield run
            run, total = [], 0
    if run:
        yield run


def _counts(o: LanguageOptions):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                by_lang: dict[str, list[str]] = {}
                for lang, text in zip(b.column(0).slice(at, ROWS).to_pylist(), b.column(1).slice(at, ROWS)):
                    by_lang.setdefault(lang, []).append(cleaned(text.as_py()))
                for lang, texts in by_lang.items():
                    for part in _runs(texts, len):
                        slots, _ = slots_of(part, o)
                        total = counts.setdefault(lang, np.zeros(o.slots, np.int64))
                        total += np.bincount(slots, minlength=o.slots)
        for lang, total in counts.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["lang", "slot", "n"])

    return run


@dataclass
class Model:
    options: LanguageOptions
    languages: list[str]
    matrix: np.ndarray  # slots by languages, log probabilities
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability of each text."""
        names, scores = [], np.zeros(len(texts))
        clean = [cleaned(t) for t in texts]
        at = 0
        for part in _runs(clean, len):
            slots, n = slots_of(part, self.options)
            ends = np.cumsum(n)
            total = np.zeros((len(part), len(self.languages)))
            filled = np.flatnonzero(n)
            if len(filled) and self.languages:
                for k in range(len(self.languages)):  # one language at a time keeps the gathered row thin
                    total[filled, k] = np.add.reduceat(self.matrix[k][slots], (ends - n)[filled], dtype=np.float64)
                total += self.prior
            for i, t in enumerate(part):
                if not t or not self.languages:
                    names.append(UNKNOWN)
                    continue
                z = np.exp(total[i] - total[i].max())
                k = int(np.argmax(z))
                names.append(self.languages[k])
                scores[at + i] = z[k] / z.sum()
            at += len(part)
        return names, scores


def fit(labelled: DataFrame, options: LanguageOptions = LanguageOptions()) -> Model:
    """Fit to ``labelled(doc_id, text, lang)``, null languages left out; no rows give a model without languages."""
    o = options
    d = labelled.filter("lang is not null")
    priors = d.groupBy("lang").count().limit(o.languages + 1).collect()
    if len(priors) > o.languages:
        raise ValueError(f"more than {o.languages} languages")
    # two rounds, so that no language is ranked in one task; the chosen are at most per_language * languages rows
    chosen = top_per_key(d.select("doc_id", "lang").distinct(), ["lang"], [F.xxhash64("doc_id"), F.col("doc_id")], o.per_language)
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("c_id"), F.col("lang").alias("c_lang")))
    rows = d.join(chosen, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("lang") == F.col("c_lang")), "left_semi")
    part = rows.select("lang", "text").mapInArrow(_counts(o), "lang string, slot int, n long")
    table = part.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()  # slots by languages at most
    languages = sorted(r["lang"] for r in priors)
    counts = np.full((len(languages), o.slots), o.alpha)
    at = {lang: k for k, lang in enumerate(languages)}
    np.add.at(counts, (table["lang"].map(at).to_numpy(int), table["slot"].to_numpy(int)), table["n"].to_numpy(float))
    total = sum(r["count"] for r in priors)
    n = {r["lang"]: r["count"] for r in priors}
    prior = np.log([n[lang] / total for lang in languages]) if languages else np.zeros(0)
    matrix = np.log(counts / counts.sum(axis=1, keepdims=True)) if languages else counts
    return Model(o, languages, matrix.astype(np.float32), prior)


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                names, scores = model.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, options: LanguageOptions = LanguageOptions()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``docs(doc_id, text, lang)``.

    Learns from rows whose crc32(doc_id) mod 4 is not 2 and whose ``lang`` is not null.  A text without a
    letter (null and empty ones too) is ``und`` with score 0, and so is every text if nothing could be
    learned.  Repeated rows and null ids are rows like any other; further columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"), (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"))
    model = docs.sparkSession.sparkContext.broadcast(fit(d.filter(~F.col("held_out")).select("doc_id", "text", "lang"), options))
    return d.select("doc_id", "text", "held_out").mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")


@query("op6_language_id")
def op6_language_id(spark, sf):
    return identify(read(spark, sf, "documents"))
