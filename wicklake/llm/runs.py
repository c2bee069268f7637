"""Operator 11: periodic runs of words by internal pattern matching."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicklake.llm.common import text_batches

# A run has at least so many words, and at least so many periods.
LEAST_LENGTH = 6
LEAST_EXPONENT = 4
# Blocks of the lowest level have so many words. With the two bounds above, each run holds a block and its next occurrence.
FIRST_BLOCK = 4
# Documents are searched together up to so many words; a longer one comes alone and whole.
BUFFER_WORDS = 1 << 17

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


@dataclass
class Blocks:
    """Blocks that occur more than once in their document: word position, suffix array range of their occurrences, words."""

    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray


def symbols(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, by first occurrence in its document, and where each document starts.

    No number occurs in two documents and numbers grow from document to document, so all suffixes of a document lie next to each
    other in the suffix array and no factor is found across documents.
    """
    starts = np.cumsum([0, *map(len, docs)], dtype=np.int64)
    codes = np.empty(starts[-1], np.int64)
    used = 0
    for words, start in zip(docs, starts):
        number = dict(zip(dict.fromkeys(words), count(used)))
        codes[start:start + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        used += len(number)
    return codes, starts


def suffix_array(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, Blocks]:
    """Suffix array of documents by prefix doubling, and the dyadic blocks that occur again in their document.

    Blocks of 2^k words lie half their size apart. When suffixes are sorted by their first 2^k words, those that agree stand
    together: the occurrences of each block as a range, which later rounds only order inside. Only such groups are sorted again.
    """
    n = len(codes)
    sizes = np.diff(starts)
    end, begin = np.repeat(starts[1:], sizes), np.repeat(starts[:-1], sizes)
    following = np.zeros(n, np.int64)
    following[:-1] = codes[1:] + 1
    following[starts[1:][sizes > 0] - 1] = 0
    key = codes * (n + 2) + following
    order = np.argsort(key)
    slots, width, rank = np.arange(n), 2, np.empty(n, np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    key = key[order]
    while len(slots):
        at = order[slots]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        members = np.diff(np.append(first, len(slots)))
        low = np.repeat(slots[first], members)
        rank[at] = low
        again = np.repeat(members, members)
        many = again > 1
        at, low, again, slots = at[many], low[many], again[many], slots[many]
        if width >= FIRST_BLOCK:
            on = (at - begin[at]) % (width // 2) == 0
            found.append((at[on], low[on], low[on] + again[on], np.full(np.count_nonzero(on), width, np.int64)))
        beyond = at + width
        inside = beyond < end[at]
        key = low * (n + 1)
        key[inside] += rank[beyond[inside]] + 1
        by_key = np.argsort(key)
        order[slots], key = at[by_key], key[by_key]
        width *= 2
    return order, Blocks(*map(np.concatenate, zip(*found))) if found else Blocks(*(np.zeros(0, np.int64) for _ in range(4)))


class WaveletTree:
    """Numbers below 2^bits in the order of a suffix array, cut bit by bit from the highest one.

    Each level keeps how many zeros stand before every place; numbers with a zero go to the front of the next level.
    """

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.bits, self.zeros = bits, []
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            before = np.zeros(len(values) + 1, np.int64)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate((values[~one], values[one]))

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers at places [low, high) are smaller than `bound` (below 2^bits)."""
        total = np.zeros(len(low), np.int64)
        for level, before in enumerate(self.zeros):
            one = (bound >> (self.bits - 1 - level) & 1).astype(bool)
            a, b = before[low], before[high]
            total += np.where(one, b - a, 0)
            low, high = np.where(one, before[-1] + low - a, a), np.where(one, before[-1] + high - b, b)
        return total

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The number at places [low, high) that `nth` others are smaller than; there are more than `nth`."""
        out = np.zeros(len(low), np.int64)
        for before in self.zeros:
            a, b = before[low], before[high]
            one = nth >= b - a
            nth = np.where(one, nth - (b - a), nth)
            low, high = np.where(one, before[-1] + low - a, a), np.where(one, before[-1] + high - b, b)
            out = 2 * out + one
        return out

    def successor(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The smallest number above `value`, which is one of those at places [low, high); -1 if there is none."""
        nth = self.below(low, high, value) + 1
        there = nth < high - low
        out = np.full(len(low), -1, np.int64)
        out[there] = self.smallest(low[there], high[there], nth[there])
        return out


def _distances(order: np.ndarray, blocks: Blocks, starts: np.ndarray) -> np.ndarray:
    """How far on each block occurs next in its document; 0 if it doesn't."""
    doc = np.searchsorted(starts, blocks.at, "right") - 1
    held, doc = np.unique(doc, return_inverse=True)
    sizes = starts[held + 1] - starts[held]
    moved = np.cumsum(np.append(0, sizes))
    place = np.arange(moved[-1]) - np.repeat(moved[:-1], sizes) + np.repeat(starts[held], sizes)
    tree = WaveletTree(order[place] - np.repeat(starts[held], sizes), max(1, int(sizes.max() - 1).bit_length()))
    shift, at = (moved[:-1] - starts[held])[doc], blocks.at - starts[held][doc]
    following = tree.successor(blocks.low + shift, blocks.high + shift, at)
    return np.where(following < 0, 0, following - at)


def _reach(codes: np.ndarray, at: np.ndarray, period: np.ndarray, most: np.ndarray, size: int, step: int) -> np.ndarray:
    """How many words from `at` on, in steps of `step`, equal the word a period later: up to `most`, and less than `size`."""
    far = np.arange(size)
    valid = far < most[:, None]
    place = np.where(valid, at[:, None] + step * far, 0)
    differ = ~valid | (codes[place] != codes[np.where(valid, place + period[:, None], 0)])
    differ[:, -1] = True
    return np.argmax(differ, axis=1)


def find_runs(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of at least LEAST_LENGTH words and LEAST_EXPONENT periods: document, start, length, smallest period.

    A run of period q is found at the level of blocks of B words with B/2 < q <= B (all q up to B at the lowest level). The run
    holds a block and its copy q words on, and a block of B >= q words inside the run occurs at no smaller distance, or the run
    had a smaller period. So the next occurrence in the window of B words behind a block gives the period, blocks with one
    distance that stand close make a progression, and all blocks of a run make one. What is left at its two ends is less than
    the distance of two blocks and is compared word by word.
    """
    codes, starts = symbols(docs)
    order, blocks = suffix_array(codes, starts)
    empty = np.zeros(0, np.int64)
    if not len(blocks.at):
        return empty, empty, empty, empty
    period = _distances(order, blocks, starts)
    near = (period <= blocks.size) & (period > np.where(blocks.size > FIRST_BLOCK, blocks.size // 2, 0))
    at, period, size = blocks.at[near], period[near], blocks.size[near]
    by_place = np.lexsort((at, period))
    at, period, size = at[by_place], period[by_place], size[by_place]
    doc = np.searchsorted(starts, at, "right") - 1
    if not len(at):
        return empty, empty, empty, empty
    joined = (period[1:] == period[:-1]) & (doc[1:] == doc[:-1]) & (at[1:] <= at[:-1] + size[1:])
    first = np.flatnonzero(np.concatenate(([True], ~joined)))
    last = np.append(first[1:], len(at)) - 1
    begin, stop = at[first], at[last] + size[first] + period[first]
    doc, period, size = doc[first], period[first], size[first]
    for one in np.unique(size):
        level = np.flatnonzero(size == one)
        # Not more at once than a buffer has words.
        for part in np.array_split(level, -(-len(level) * int(one) // BUFFER_WORDS)):
            left = _reach(codes, begin[part] - 1, period[part], begin[part] - starts[doc[part]], one // 2 + 1, -1)
            right = _reach(codes, stop[part] - period[part], period[part], starts[doc[part] + 1] - stop[part], one // 2 + 1, 1)
            begin[part] -= left
            stop[part] += right
    length = stop - begin
    long = np.flatnonzero(length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period))
    long = long[np.lexsort((period[long], begin[long]))]
    return doc[long], begin[long] - starts[doc[long]], length[long], period[long]


def _kept(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words that no run holds after its first period, with one space in between."""
    if not len(start):
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)])


def _buffers(docs: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    held, words = [], 0
    for doc in docs:
        if held and words + len(doc) > BUFFER_WORDS:
            yield held
            held, words = [], 0
        held.append(doc)
        words += len(doc)
    if held:
        yield held


def _searched(ids: pa.Array, texts: list[str | None], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    done = 0
    # Words are runs of anything but ASCII white space, which is what splitting bytes goes by.
    for docs in _buffers([(t or "").encode("utf-8", "replace").split() for t in texts]):
        doc, start, length, period = find_runs(docs)
        cuts = np.searchsorted(doc, np.arange(len(docs) + 1))
        runs = pa.ListArray.from_arrays(
            pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(_RUN)))
        kept = [_kept(words, start[a:b], length[a:b], period[a:b]) for words, a, b in zip(docs, cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays(
            [ids.slice(done, len(docs)), pa.array(map(len, docs), pa.int64()), runs, pa.array(kept, pa.binary()).cast(pa.string())], schema=schema)
        done += len(docs)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of `docs` (doc_id, text, ...).

    `runs` holds (start, length, period) in words, by start and then period; `collapsed` is the text of the words that no run holds
    after its first period, joined by one space. Documents are searched where they are read: nothing is shuffled, and a text of
    any length is searched whole. A null text and one without words have no runs and an empty `collapsed`. Rows with the same or
    no id are answered each; columns besides doc_id and text are not read. No rows give no rows.
    """
    text_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _searched(batch["doc_id"], batch["text"].to_pylist(), schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of, _SCHEMA)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which every tenth document by hash of its id repeats its words from some place on.

    With h the crc32 of the decimal id and g = h / 10, a document of n words with 10 | h repeats p = 1 + (n - a) / (3 + g % 8) words
    from word a = g % n on, up to its n words. Documents without words or without an id stay as they are.
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.when(hashed % 10 == 0, words).alias("words"), F.floor(hashed / 10).alias("g"))
    n, g = F.size("words"), F.col("g")
    placed = chosen.select("doc_id", "text", "words", F.when(n > 0, (g % n).cast("int")).alias("a"), n.alias("n"),
                           F.when(n > 0, (1 + F.floor((n - g % n) / (3 + g % 8))).cast("int")).alias("p"))

    def part(words: Column | str, start: Column, length: Column) -> Column:
        return F.slice(words, start, length)

    rest = F.col("n") - F.col("a")
    tail = part(F.flatten(F.array_repeat(part("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(part("words", F.lit(1), F.col("a")), tail), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))
