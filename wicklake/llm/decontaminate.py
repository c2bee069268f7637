"""Operator 2: benchmark passages in documents, found by the q-gram lemma in diagonal bands."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicklake.llm.common import text_batches

GRAM = 8
EDIT_RATE = 0.1
BLOCK_CHARS = 4 << 20
_FILTER_LOG2 = 22
_BUFFER = 1 << 18
_BASE = 0x9E3779B1
_SPACES = "\t\n\x0b\f\r\xa0"
_BINS = 1 << 20
# Places of a text are looked at together as long as they meet so many places of passages.
_HITS = 1 << 19
# Costs and start diagonals share a number in the alignment.
_COST = np.int64(1 << 20)


def folded(text: str | None) -> str:
    """Lower case, with white space as spaces; every character keeps its place."""
    low = (text or "").lower()
    if text and len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for space in _SPACES:
        low = low.replace(space, " ")
    return low


def _characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _gram_hashes(characters: np.ndarray, gram: int) -> np.ndarray:
    """A 32-bit polynomial hash of the characters from each place on, by doubling the length."""
    if len(characters) < gram:
        return np.zeros(0, np.uint32)
    total, length, out = None, 0, np.ascontiguousarray(characters, np.uint32) * np.uint32(0x85EBCA6B)
    width = 1
    while True:
        if gram & width:
            if total is None:
                total, length = out, width
            else:
                n = len(characters) - length - width + 1
                total = total[:n] * np.uint32(pow(_BASE, width, 2**32)) + out[length:length + n]
                length += width
        if 2 * width > gram:
            break
        out = out[:-width] * np.uint32(pow(_BASE, width, 2**32)) + out[width:]
        width *= 2
    total ^= total >> np.uint32(15)
    total *= np.uint32(0xC2B2AE35)
    return total


@dataclass
class Passages:
    """A block of distinct benchmark texts and their q-grams."""

    texts: list[str]
    gram: int
    budgets: np.ndarray
    needed: np.ndarray
    shifts: np.ndarray
    filter: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, texts: list[str], gram: int = GRAM, rate: float = EDIT_RATE) -> Passages:
        """The lemma: a text of m characters and any within k edits of it share at least m + 1 - q (k + 1) q-grams. The
        budget is rate * m edits, or as many as leave one q-gram."""
        m = np.array([len(t) for t in texts], np.int64)
        budgets = np.maximum(np.minimum((rate * m).astype(np.int64), (m // gram) - 1), 0)
        hashes = [_gram_hashes(_characters(t), gram) for t in texts]
        every = np.concatenate([*hashes, np.zeros(0, np.uint32)])
        item = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])
        offset = np.concatenate([*(np.arange(len(h)) for h in hashes), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(every, kind="stable")
        distinct, first = np.unique(every[order], return_index=True)
        present = np.zeros(1 << _FILTER_LOG2, bool)
        present[distinct >> np.uint32(32 - _FILTER_LOG2)] = True
        shifts = np.maximum(6, np.ceil(np.log2(budgets + 1))).astype(np.int64)
        return cls(texts, gram, budgets, m + 1 - gram * (budgets + 1), shifts, present, distinct,
                   np.append(first, len(every)), item[order], offset[order])

    def candidates(self, characters: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, passage, first diagonal of a band) of every band with enough shared q-grams.

        A diagonal is a place in the buffer less a place in the passage. An alignment with k edits stays on k + 1
        neighbouring diagonals; bands of 2k + 1 diagonals that begin every k + 1 hold it whole in one of them.
        Places are looked at in windows that overlap by what a band can span, so each band is whole in one of them.
        """
        hashes = _gram_hashes(characters, self.gram)
        at = np.flatnonzero(self.filter[hashes >> np.uint32(32 - _FILTER_LOG2)])
        if not len(at) or not len(self.hashes):
            return []
        slot = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        real = self.hashes[slot] == hashes[at]
        at, slot = at[real], slot[real]
        text = np.searchsorted(starts, at, side="right") - 1
        real = at + self.gram <= starts[text + 1]
        at, slot, text = at[real], slot[real], text[real]
        span = max(map(len, self.texts)) + 2 * int(self.budgets.max()) + 1
        found, windows = set(), [(0, len(at))]
        while windows:
            low, high = windows.pop()
            if high - low > 1 and self._expanded(slot[low:high], at[low:high], text[low:high]) > _HITS and at[high - 1] - at[low] > 4 * span:
                middle = (at[low] + at[high - 1]) // 2
                windows.append((low, int(np.searchsorted(at, middle + span, "right"))))
                windows.append((int(np.searchsorted(at, middle)), high))
            elif high > low:
                found.update(self._bands(at[low:high], slot[low:high], text[low:high]))
        return sorted(found)

    def _runs(self, at: np.ndarray, slot: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of one gram at neighbouring places of a text begin, and how many places they have."""
        first = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(slot) != 0) | (np.diff(text) != 0))))
        return first, np.diff(np.append(first, len(at)))

    def _expanded(self, slot: np.ndarray, at: np.ndarray, text: np.ndarray) -> int:
        """At most how many rows `_bands` makes of these places."""
        first, length = self._runs(at, slot, text)
        times = self.first[slot[first] + 1] - self.first[slot[first]]
        return int((times * (1 + -(-(length - 1) // (int(self.budgets.min()) + 1)))).sum())

    def _bands(self, at: np.ndarray, slot: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Bands with enough shared q-grams among some places.

        A run of equal grams, such as a ruler, meets each place of the passage that has the gram on an interval of diagonals. It
        stands for them by diagonals a budget's worth apart and the last one: every band, and every k + 1 neighbouring diagonals,
        that share one with the interval hold such a diagonal, so bands are found as if all places were there.
        """
        first, length = self._runs(at, slot, text)
        times = self.first[slot[first] + 1] - self.first[slot[first]]
        hit = np.repeat(first, times)
        entry = np.arange(len(hit)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(self.first[slot[first]], times)
        more = np.repeat(length - 1, times)
        samples = -(-more // (self.budgets[self.item[entry]] + 1)) + 1
        if len(hit) and samples.max() > 1:
            step = np.repeat(self.budgets[self.item[entry]] + 1, samples)
            nth = np.arange(int(samples.sum())) - np.repeat(np.cumsum(samples) - samples, samples)
            along = np.minimum(nth * step, np.repeat(more, samples))
            hit, entry = np.repeat(hit, samples), np.repeat(entry, samples)
        else:
            along = 0
        item, offset = self.item[entry], self.offset[entry]
        diagonal = at[hit] + along - offset
        # Most hits stand alone. Diagonals are counted in bins that a budget's worth of them fits in, so an alignment is in
        # one or two neighbours; bins are hashed, and a clash only adds to a count.
        bin_ = (item * 0x9E3779B1 + (diagonal >> self.shifts[item])) & (_BINS - 1)
        filled = np.bincount(bin_, minlength=_BINS)
        beside = np.maximum(filled[bin_ - 1], filled[(bin_ + 1) & (_BINS - 1)])
        dense = np.flatnonzero(filled[bin_] + beside >= self.needed[item])
        if not len(dense):
            return
        hit, item, offset, diagonal = hit[dense], item[dense], offset[dense], diagonal[dense]
        step = self.budgets[item] + 1
        band = np.floor_divide(diagonal, step)
        # A diagonal is in the band that begins at or before it, and in the one before that unless it is its last.
        earlier = diagonal - (band - 1) * step <= 2 * self.budgets[item]
        keys = np.concatenate([np.column_stack([text[hit], item, band, offset]),
                               np.column_stack([text[hit], item, band - 1, offset])[earlier]])
        keys = keys[np.lexsort(keys.T[::-1])]
        new = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
        keys = keys[new]
        head = np.append(True, (keys[1:, :3] != keys[:-1, :3]).any(axis=1))
        first = np.flatnonzero(head)
        shared = np.diff(np.append(first, len(keys)))
        good = first[shared >= self.needed[keys[first, 1]]]
        yield from ((int(t), int(i), int(b) * int(self.budgets[i] + 1)) for t, i, b in keys[good, :3])


def align(passage: np.ndarray, text: np.ndarray, first_diagonal: int, width: int) -> tuple[int, int, int]:
    """Edits, start and end of the best alignment of a whole passage with a stretch of the text, on a band of `width`
    diagonals; the leftmost start among equal ones. Places outside the text match nothing and may not be used."""
    m, diagonals = len(passage), np.arange(width, dtype=np.int64)
    place = first_diagonal + diagonals
    far = _COST * (m + width + 1)
    row = np.where((place >= 0) & (place <= len(text)), diagonals, far)
    step = diagonals * _COST
    padded = np.full(m + width, -1, np.int64)
    low, high = max(0, first_diagonal), min(len(text), first_diagonal + m + width)
    if high > low:
        padded[low - first_diagonal:high - first_diagonal] = text[low:high]
    for i in range(m):
        here = padded[i:i + width]
        moved = np.where(here >= 0, row + (here != passage[i]) * _COST, far)
        moved[:-1] = np.minimum(moved[:-1], row[1:] + _COST)
        end = place + i + 1
        moved[(end < 0) | (end > len(text))] = far
        row = np.minimum(np.minimum.accumulate(moved - step) + step, far)
        row[(end < 0) | (end > len(text))] = far
    best = int(row.argmin())
    cost, start = divmod(int(row[best]), int(_COST))
    return cost, first_diagonal + start, first_diagonal + best + m


def find(passages: Passages, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, passage, start, end, edits): for every text and passage within the budget, the best stretch."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    arrays: dict[int, np.ndarray] = {}
    for first, last, whole, starts in _buffers(texts):
        # Neighbouring bands of a uniform stretch read the same characters and align alike.
        last_read: tuple = ()
        for t, i, diagonal in passages.candidates(whole, starts):
            key, budget, passage = (first + t, i), int(passages.budgets[i]), passages.texts[i]
            if key in best and best[key][0] == 0:
                continue
            begin, text = diagonal - int(starts[t]), texts[first + t]
            exact = text.find(passage, max(0, begin), max(0, begin) + len(passage) + 3 * budget + 1)
            if exact >= 0:
                found = (0, exact, exact + len(passage))
            else:
                if i not in arrays:
                    arrays[i] = _characters(passage).astype(np.int64)
                read = (t, i, text[begin:begin + len(passage) + 2 * budget + 1]) if 0 <= begin <= len(text) - len(passage) - 2 * budget - 1 else ()
                if read and last_read[:3] == read:
                    cost, start, end = last_read[3]
                    found = cost, start + begin, end + begin
                else:
                    found = align(arrays[i], whole[starts[t]:starts[t + 1]], begin, 2 * budget + 1)
                    last_read = (*read, (found[0], found[1] - begin, found[2] - begin)) if read else ()
            if found[0] <= budget:
                best[key] = min(best.get(key, found), found)
    whole_texts: dict[str, list[int]] = {}
    for i, passage in enumerate(passages.texts):
        if len(passage) < passages.gram:
            whole_texts.setdefault(passage, []).append(i)
    if whole_texts:
        for t, text in enumerate(texts):
            for i in whole_texts.get(text.strip(" "), ()):
                begin = len(text) - len(text.lstrip(" "))
                best[t, i] = (0, begin, begin + len(passages.texts[i]))
    return [(t, i, start, end, edits) for (t, i), (edits, start, end) in sorted(best.items())]


def _buffers(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    first, size = 0, 0
    for i in range(len(texts) + 1):
        if i == len(texts) or size and size + len(texts[i]) > _BUFFER:
            if i > first:
                yield first, i, _characters("".join(texts[first:i])), np.cumsum([0, *map(len, texts[first:i])])
            first, size = i, 0
        if i < len(texts):
            size += len(texts[i])


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[list[int], str]]]:
    """Distinct passages with their item ids, in blocks of about `block_chars` characters; one block is in memory at a
    time. Null and blank passages are left out."""
    known = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("passage"))
             .filter(F.length(F.btrim("passage")) > 0))
    total = known.agg(F.sum(F.length("passage")).alias("n")).first()["n"] or 0
    n = -(-total // block_chars)
    for block in range(n):
        rows = known.filter(F.pmod(F.xxhash64("passage"), F.lit(n).cast("long")) == block).collect()
        texts: dict[str, list[int]] = {}
        for row in rows:
            passage = folded(row["passage"]).strip(" ")
            if passage:
                texts.setdefault(passage, []).append(row["item_id"])
        yield [(ids, text) for text, ids in sorted(texts.items())]


def contaminated(docs: DataFrame, benchmark: DataFrame, gram: int = GRAM, rate: float = EDIT_RATE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits): where a row of `docs` (doc_id, text, ...) has a passage of `benchmark` (item_id, text).

    A document has a passage if some stretch of it is within `rate` times the passage's length in edits, after both are
    lowered and white space is read as spaces. One row for each document and passage: the stretch with the fewest edits,
    then the leftmost; `start` and `end` count characters of the document's text. Documents are scanned where they lie,
    in one pass per block of passages; nothing is shuffled.

    Passages of fewer characters than a q-gram have no q-grams; a document has one if it is nothing else. Null and blank
    passages are in no document, a null text has no passage. Repeated rows are answered each, and equal passages under
    several ids give a row per id. Other columns are not read. No rows on either side give no rows.
    """
    text_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for block in blocks(benchmark, block_chars):
        found = _scan(plain, Passages.of([text for _, text in block], gram, rate), [ids for ids, _ in block])
        out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], _FOUND)


_FOUND = "doc_id long, item_id long, start long, end long, edits long"


def _scan(docs: DataFrame, passages: Passages, ids: list[list[int]]) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["doc_id"].to_pylist()
            rows = [(keys[t], item, start, end, edits)
                    for t, i, start, end, edits in find(passages, [folded(x) for x in batch["text"].to_pylist()]) for item in ids[i]]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "start", "end", "edits"])

    return docs.mapInArrow(scan, _FOUND)


def clean(docs: DataFrame, benchmark: DataFrame, gram: int = GRAM, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text has no passage of the benchmark.

    The text is judged where the row is read, so rows without an id and rows that share one are judged each.
    """
    text_batches(docs.sparkSession)
    out = docs
    for block in blocks(benchmark, block_chars):
        passages = Passages.of([text for _, text in block], gram, rate)

        def keep(batches: Iterator[pa.RecordBatch], passages=passages) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = {t for t, *_ in find(passages, [folded(x) for x in batch["text"].to_pylist()])}
                yield batch.filter(pa.array([i not in hit for i in range(len(batch))], pa.bool_()))

        out = out.mapInArrow(keep, out.schema)
    return out
