"""Operator 12: spelling variants grouped by generated edits, Bloom filters and an exact join."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicklake.llm.common import staged, text_batches

# Words of the vocabulary have at least so many letters and occur at least so often.
LEAST_LETTERS = 7
LEAST_COUNT = 2
# A word's form is so many times as frequent.
RATIO = 10
# Filters of so many bytes are broadcast at once; a vocabulary that needs more is probed in several passes.
FILTER_BYTES = 64 << 20
# A chunk of a filter, which one task builds, has so many blocks of 64 bits.
CHUNK_BLOCKS = 1 << 12
# From so many letters on a word has more edits than a filter of two bytes a word can hold back.
LONG = 32

# A task counts up to so many different words before it hands them on.
_COUNTED = 200_000
# Letters and edits that are looked at together.
_AT_ONCE = 1 << 16
_GATHERED = 1 << 16
_ROWS_OUT = 1 << 14
# À to ÿ are single bytes in Latin-1, where everything beyond becomes "?"; only A-Z are lower-cased.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 0xC0 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
# The base of the polynomial hash, its inverse modulo 2^64, and the multipliers of a 64-bit finalizer.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 2**64))
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_LOW = np.uint64(0xFFFFFFFF)


def word_counts(docs: DataFrame, slips: int | None = None) -> DataFrame:
    """(word, n): how often each word of at least LEAST_LETTERS letters occurs in all texts of `docs` (doc_id, text, ...).

    Words are maximal runs of a-z, A-Z and U+00C0 to U+00FF with A-Z in lower case. With `slips`, a word whose
    h = crc32("<doc_id>:<word>") is divisible by it lacks letter h % length in that document; rows without an id have no slips.
    Tasks hand on sums, so a word that is everywhere is one row a task.
    """
    text_batches(docs.sparkSession)

    def slipped(doc_id: int, found: Counter) -> Counter:
        prefix, out = crc32(b"%d:" % doc_id), Counter()
        for word, n in found.items():
            h = crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
            if h % slips == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
                if len(word) < LEAST_LETTERS:
                    continue
            out[word] += n
        return out

    def handed_on(held: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                words = (text or "").encode("latin-1", "replace").translate(_LETTERS).split()
                found = Counter([w for w in words if len(w) >= LEAST_LETTERS])
                held.update(slipped(doc_id, found) if slips and doc_id is not None else found)
                if len(held) > _COUNTED:
                    yield handed_on(held)
                    held = Counter()
        if held:
            yield handed_on(held)

    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Shard:
    """The filter of the words of one length, or blocks [first, first + len(bits)) of it."""

    blocks: int
    bits_per_key: int
    first: int
    bits: np.ndarray


def filter_size(letters: int, words: int) -> tuple[int, int]:
    """Blocks of 64 bits, and bits set a word, of the filter of `words` words of `letters` letters.

    Two bytes a word let pass about one edit in 300. Longer words have more edits, each of which repeats the word, so their
    filter grows with their length and lets pass next to none; it has an eighth of the words' own size.
    """
    return (words * -(-letters // LONG), 8) if letters >= LONG else (-(-words // 4), 4)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX[0]
    h = (h ^ (h >> np.uint64(33))) * _MIX[1]
    return h ^ (h >> np.uint64(33))


def _masks(mixed: np.ndarray, bits_per_key: int) -> np.ndarray:
    """The bits that a word sets in its block. Low bits choose them, high bits choose the block."""
    out, step = np.zeros(len(mixed), np.uint64), mixed & _LOW
    for _ in range(bits_per_key):
        out |= np.uint64(1) << (step >> np.uint64(26))
        step = step * np.uint64(0x9E3779B1) & _LOW
    return out


def _blocks(mixed: np.ndarray, blocks: int) -> np.ndarray:
    return ((mixed >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(max(0, n - 1), _BASE, np.uint64))), dtype=np.uint64)


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of equal length as a matrix of letters, and where they stand in the list; at most about _AT_ONCE letters each."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        held = np.flatnonzero(sizes == size)
        for part in np.array_split(held, -(-len(held) * int(size) // _AT_ONCE)):
            yield part, np.frombuffer(b"".join([words[i] for i in part]), np.uint8).reshape(len(part), size)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Words and counts of several batches, so that many words of one length are looked at together."""
    words, counts, size = [], [], 0
    for batch in batches:
        words += [w.encode("latin-1") for w in batch["word"].to_pylist()]
        counts += batch["n"].to_pylist()
        size += batch.nbytes
        if len(words) >= _GATHERED or size >= 64 * _GATHERED:
            yield words, counts
            words, counts, size = [], [], 0
    if words:
        yield words, counts


def _keyed(vocabulary: DataFrame, words_of: dict[int, int]) -> DataFrame:
    """(letters, chunk, mixed): where each word goes in the filters."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _ in _gathered(batches):
            for _, letters in _by_length(words):
                size = letters.shape[1]
                mixed = _mixed(((letters.astype(np.uint64) + np.uint64(1)) * _powers(size)).sum(axis=1, dtype=np.uint64))
                chunk = _blocks(mixed, filter_size(size, words_of[size])[0]) // CHUNK_BLOCKS
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mixed), size), pa.int64()), pa.array(chunk), pa.array(mixed.view(np.int64))], ["letters", "chunk", "mixed"])

    return vocabulary.select("word", "n").mapInArrow(of, "letters long, chunk long, mixed long")


def _filters(vocabulary: DataFrame, words_of: dict[int, int]) -> DataFrame:
    """(letters, chunk, bits) of all filters, each chunk built by one task from about as many words as it has blocks, or four times."""
    def build(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, chunk = key[0].as_py(), key[1].as_py()
        blocks, bits_per_key = filter_size(letters, words_of[letters])
        bits = np.zeros(min(CHUNK_BLOCKS, blocks - chunk * CHUNK_BLOCKS), np.uint64)
        for batch in batches:
            mixed = batch["mixed"].to_numpy(zero_copy_only=False).view(np.uint64)
            np.bitwise_or.at(bits, _blocks(mixed, blocks) - chunk * CHUNK_BLOCKS, _masks(mixed, bits_per_key))
        yield pa.RecordBatch.from_pylist([{"letters": letters, "chunk": chunk, "bits": bits.tobytes()}])

    return _keyed(vocabulary, words_of).groupBy("letters", "chunk").applyInArrow(build, "letters long, chunk long, bits binary")


def _passes(words_of: dict[int, int], most: int) -> Iterator[list[tuple[int, int]]]:
    """Chunks (letters, number) whose filters are broadcast together, of at most `most` bytes but one chunk at least."""
    held, size = [], 0
    for letters in sorted(words_of):
        blocks = filter_size(letters, words_of[letters])[0]
        for chunk in range(-(-blocks // CHUNK_BLOCKS)):
            more = 8 * min(CHUNK_BLOCKS, blocks - chunk * CHUNK_BLOCKS)
            if held and size + more > most:
                yield held
                held, size = [], 0
            held.append((letters, chunk))
            size += more
    if held:
        yield held


def _passing(shard: Shard, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes the filter lets pass."""
    mixed = _mixed(hashes)
    block = _blocks(mixed, shard.blocks) - shard.first
    inside = np.flatnonzero((block >= 0) & (block < len(shard.bits)))
    mask = _masks(mixed[inside], shard.bits_per_key)
    return inside[shard.bits[block[inside]] & mask == mask]


def neighbours(letters: np.ndarray, alphabet: bytes, shards: dict[int, Shard]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(row, place, letter) of the edits of a matrix of words that the filters let pass; letter -1 deletes.

    Each pair of words at one edit has exactly one edit that leads from one to the other: the longer word loses the first letter
    of a run of equal ones, or a letter is replaced by a smaller one. The hash of an edit follows from sums over the letters before it.
    """
    size = letters.shape[1]
    if size - 1 not in shards and size not in shards:
        return
    values, powers = letters.astype(np.uint64) + np.uint64(1), _powers(size)
    terms = values * powers
    sums = np.cumsum(terms, axis=1, dtype=np.uint64)
    whole = sums[:, -1:]
    if size - 1 in shards:
        first = np.ones(letters.shape, bool)
        first[:, 1:] = letters[:, 1:] != letters[:, :-1]
        row, place = np.nonzero(first)
        hashes = (sums - terms + (whole - sums) * _INVERSE)[row, place]
        found = _passing(shards[size - 1], hashes)
        yield row[found], place[found], -1
    if size in shards:
        for letter in alphabet:
            row, place = np.nonzero(letters > letter)
            if len(row):
                hashes = whole[row, 0] + (np.uint64(letter + 1) - values[row, place]) * powers[place]
                found = _passing(shards[size], hashes)
                yield row[found], place[found], letter


def _candidates(vocabulary: DataFrame, alphabet: bytes, shards: dict[int, Shard]) -> DataFrame:
    """(word, n, near): edits of the words of `vocabulary` that the filters let pass."""
    sent = vocabulary.sparkSession.sparkContext.broadcast(shards)

    def batch_of(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))], ["word", "n", "near"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, counts in _gathered(batches):
            for part, letters in _by_length(words):
                rows = []
                for found, places, letter in neighbours(letters, alphabet, sent.value):
                    put = b"" if letter < 0 else bytes([letter])
                    for i, place in zip(part[found].tolist(), places.tolist()):
                        word = words[i]
                        rows.append((word.decode("latin-1"), counts[i], (word[:place] + put + word[place + 1:]).decode("latin-1")))
                    if len(rows) * letters.shape[1] > 16 * _ROWS_OUT:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return vocabulary.select("word", "n").mapInArrow(of, "word string, n long, near string")


def near_words(vocabulary: DataFrame, most: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): each pair of words of `vocabulary` (word, n) at exactly one insertion, deletion or replacement, once.

    `vocabulary` is written already, holds each word once, and words of a-z and U+00C0 to U+00FF only. Filters of up to `most` bytes
    are broadcast; where all of them have more, the vocabulary is probed once for each set of chunks, so what is broadcast does not
    grow with it. Only edits that a filter lets pass are shuffled, to an exact join with the vocabulary, which removes what
    the filter let pass wrongly. A word joins with at most as many words as it has edits, so no key is hot.
    """
    spark = vocabulary.sparkSession
    words_of = {r.letters: r.n for r in vocabulary.groupBy(F.length("word").alias("letters")).agg(F.count("*").alias("n")).collect()}
    # At most 90 letters are there.
    seen = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).where("letter <> ''").distinct()
    alphabet = bytes(sorted(ord(r.letter) for r in seen.collect()))
    found = spark.createDataFrame([], "word string, n long, near string")
    filters = staged(_filters(vocabulary, words_of), "filters") if words_of else None
    for chunks in _passes(words_of, most):
        shards: dict[int, Shard] = {}
        low, high = (F.struct(F.lit(a).alias("letters"), F.lit(b).alias("chunk")) for a, b in (chunks[0], chunks[-1]))
        place = F.struct("letters", "chunk")
        parts = {(r.letters, r.chunk): r.bits for r in filters.where(place.between(low, high)).collect()}
        for letters in dict.fromkeys(a for a, _ in chunks):
            mine = [b for a, b in chunks if a == letters]
            blocks, bits_per_key = filter_size(letters, words_of[letters])
            empty = {b: bytes(8 * min(CHUNK_BLOCKS, blocks - b * CHUNK_BLOCKS)) for b in mine if (letters, b) not in parts}
            bits = b"".join(parts.get((letters, b)) or empty[b] for b in mine)
            shards[letters] = Shard(blocks, bits_per_key, mine[0] * CHUNK_BLOCKS, np.frombuffer(bits, np.uint64))
        found = found.unionByName(_candidates(vocabulary, alphabet, shards))
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.join(known, "near").select("word", "n", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that forms lead to, by doubling the steps until no word moves.

    Each step multiplies the count by RATIO at least, so chains are short and have no circles.
    """
    roots = staged(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not roots.where("moved").isEmpty():
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = staged(roots.drop("moved").join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
    return roots.select("word", "root")


def group_variants(docs: DataFrame, slips: int | None = None, most: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of at least LEAST_LETTERS letters that `docs` have LEAST_COUNT times.

    `form` is the near word with the largest count (of equal ones the first by code points) if that is RATIO times the
    word's or more, else null; `root` is where forms lead to in the end, or the word itself. `slips` is as in `word_counts`.
    Null and empty texts have no words; repeated rows count each; columns besides doc_id and text are not read. No words give no rows.
    """
    vocabulary = staged(word_counts(docs, slips).where(F.col("n") >= LEAST_COUNT), "vocabulary")
    pairs = near_words(vocabulary, most)
    there, back = (F.struct(F.col(a).alias("word"), F.struct((-F.col(f"{b}")).alias("fewer"), F.col(c).alias("near")).alias("best"))
                   for a, b, c in (("word", "near_n", "near"), ("near", "n", "word")))
    best = (pairs.select(F.explode(F.array(there, back)).alias("link")).select("link.*")
            .groupBy("word").agg(F.count("*").alias("n_near"), F.min("best").alias("best")))
    frequent = -F.col("best.fewer") >= RATIO * F.col("n")
    named = staged(vocabulary.join(best, "word", "left").select(
        "word", F.when(frequent, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, -F.col("best.fewer")).alias("form_n")), "forms")
    roots = _roots(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
