"""Operator 10: language ID with n-gram filters that answer for all languages at once."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicklake.llm.common import held_out, text_batches, whole_buffers, words_at

GRAM = 4
HASHES = 2
SLOTS_LOG2 = 20
SAMPLE_DOCS = 600
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")
# ASCII bytes that are no letters read as a space; bytes of longer characters stay.
_PLAIN = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))
_FACTORS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)
_BUFFER = 1 << 21


def has_letter(text: str | None) -> bool:
    found = _LETTER.search(text) if text else None
    return bool(found) and (found[0].isalpha() or any(map(str.isalpha, text)))


def _plain(text: str | None) -> bytes:
    return b" " + (text or "").lower().encode("utf-8", "replace").translate(_PLAIN) + b" "


def _grams(buffer: bytes) -> np.ndarray:
    return np.ascontiguousarray(words_at(buffer, GRAM, "<u4"))


def _slots(grams: np.ndarray, i: int, log2: int) -> np.ndarray:
    return (grams * np.uint32(_FACTORS[i])) >> np.uint32(32 - log2)


@dataclass
class LanguageFilter:
    """Bloom filters of all languages, sliced by bit: bit l of a slot belongs to the filter of language l.

    One look-up per hash gives the languages of an n-gram as the AND of its slots. `slices` holds one array of
    slots for each 64 languages (or a narrower one for few).
    """

    langs: list[str]
    slots_log2: int = SLOTS_LOG2
    slices: list[np.ndarray] = field(default_factory=list)
    wrong: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def build(cls, grams: dict[str, np.ndarray], slots_log2: int = SLOTS_LOG2) -> LanguageFilter:
        """`grams`: the n-grams of each language, as 32-bit numbers. Order of the languages decides ties."""
        out = cls(list(grams), slots_log2)
        for start in range(0, len(out.langs), 64):
            part = out.langs[start:start + 64]
            kind = next(k for n, k in ((8, np.uint8), (16, np.uint16), (32, np.uint32), (64, np.uint64)) if len(part) <= n)
            slots = np.zeros(1 << slots_log2, kind)
            for bit, lang in enumerate(part):
                for i in range(HASHES):
                    slots[_slots(grams[lang].astype(np.uint32), i, slots_log2)] |= kind(1 << bit)
            out.slices.append(slots)
        filled = [((out.slices[i // 64] >> out.slices[i // 64].dtype.type(i % 64)) & out.slices[i // 64].dtype.type(1)).mean()
                  for i in range(len(out.langs))]
        out.wrong = np.array(filled) ** HASHES
        return out

    def counts(self, buffer: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text (texts, 1), and how many of them each language's filter contains (texts, languages)."""
        grams = _grams(buffer)
        n = np.maximum(np.diff(starts) - GRAM + 1, 0)
        hits = np.zeros((len(n), len(self.langs)))
        if not len(grams):
            return n, hits
        inside = np.ones(len(grams), bool)
        for back in range(1, GRAM):
            edge = starts[1:-1] - back
            inside[edge[(edge >= 0) & (edge < len(grams))]] = False
        at = [_slots(grams, i, self.slots_log2) for i in range(HASHES)]
        full = n > 0
        for part, slots in enumerate(self.slices):
            mask = slots[at[0]]
            for more in at[1:]:
                mask &= slots[more]
            mask *= inside
            one = mask.dtype.type(1)
            for bit in range(min(64, len(self.langs) - 64 * part)):
                has = (mask >> mask.dtype.type(bit)) & one
                hits[full, 64 * part + bit] = np.add.reduceat(has, starts[:-1][full], dtype=np.int64)
        return n, hits

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and coverage of each text.

        A filter with false-positive rate f contains about c + (n - c) f of n n-grams if the language has c of
        them, so c is estimated by (hits - n f) / (1 - f). The language with the largest estimate wins; ties go to
        the earlier language. The coverage is the winner's share of the n-grams. The score is the coverage times the
        winner's share of what the winner and the runner-up have.
        """
        langs, score, cover = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        lettered = [i for i, t in enumerate(texts) if has_letter(t)]
        if not self.langs:
            return langs, score, cover
        for first, last, buffer, starts in whole_buffers([_plain(texts[i]) for i in lettered], _BUFFER):
            n, hits = self.counts(buffer, starts)
            n = np.maximum(n, 1)[:, None]
            share = np.clip((hits - n * self.wrong) / (n * np.maximum(1 - self.wrong, 1e-9)), 0, 1)
            best = share.argmax(1)
            rows = np.array(lettered[first:last])
            top = share[np.arange(len(best)), best]
            second = np.partition(share, -2, 1)[:, -2] if share.shape[1] > 1 else np.zeros(len(best))
            cover[rows] = top
            score[rows] = np.where(top > 0, top * top / np.maximum(top + second, 1e-12), 0)
            for i, b in zip(rows, best):
                langs[i] = self.langs[b]
        return langs, score, cover


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, least_docs: int = 2, slots_log2: int = SLOTS_LOG2) -> LanguageFilter:
    """Filters from the labelled documents that are not held out.

    Of each language about `sample_docs` documents are read, picked by a hash of their id; that bounds the n-grams
    that reach the driver. An n-gram belongs to a language if it occurs in `least_docs` of them (in one, where a
    language has under ten). Only doc_id, text and lang are read.
    """
    text_batches(docs.sparkSession)
    labelled = (docs.select(F.col("doc_id").alias("id"), F.col("text").alias("body"), F.col("lang").cast("string").alias("tongue"))
                .filter(~held_out(F.col("id")) & F.col("tongue").isNotNull() & F.col("body").isNotNull()))
    totals = {r["tongue"]: r["n"] for r in labelled.groupBy("tongue").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return LanguageFilter([])
    share = F.create_map(*[x for t, n in totals.items() for x in (F.lit(t), F.lit(min(1.0, sample_docs / n)))])[F.col("tongue")]
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.filter(place < share)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch["tongue"], batch["body"]):
                grams = np.unique(_grams(_plain(text.as_py()))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(grams)), pa.array(grams)], ["tongue", "gram"])

    counted = (sample.select("tongue", "body").mapInArrow(distinct, "tongue string, gram long")
               .groupBy("tongue", "gram").agg(F.count("*").alias("n")))
    few = F.create_map(*[x for t, n in totals.items() for x in (F.lit(t), F.lit(1 if n < 10 else least_docs))])[F.col("tongue")]
    kept = counted.filter(F.col("n") >= few).select("tongue", "gram").toPandas()
    order = sorted(totals, key=lambda t: (-totals[t], t))
    return LanguageFilter.build({t: kept.loc[kept["tongue"] == t, "gram"].to_numpy(np.int64) for t in order}, slots_log2)


def identify(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, coverage) for every row of `docs` (doc_id, text, ...).

    `und` with score 0 for a null text and one without a letter, and for all texts if no language was learned.
    Repeated rows are answered each. Other columns are not read. No rows give no rows.
    """
    text_batches(docs.sparkSession)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, score, cover = model.decide(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(langs, pa.string()), pa.array(score), pa.array(cover)],
                ["doc_id", "held_out", "lang_pred", "score", "coverage"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double, coverage double"))


def known(docs: DataFrame, model: LanguageFilter, least_coverage: float) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text is in a language of the model: it has a letter, and the likeliest
    language has at least `least_coverage` of its n-grams. Without any learned language, a letter is enough."""
    text_batches(docs.sparkSession)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            langs, _, cover = model.decide(texts)
            fits = [lang != UNDETERMINED and c >= least_coverage if model.langs else has_letter(t) for lang, c, t in zip(langs, cover, texts)]
            yield batch.filter(pa.array(fits, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
