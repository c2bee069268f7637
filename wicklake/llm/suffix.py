"""Operator 1: removal of repeated 50-byte strings with a logarithmic family of suffix arrays."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicklake.llm.common import LAST_ID, text_batches, whole_buffers, words_at

MATCH = 50
# An anchor is the 16-byte word with the smallest hash among those inside a string of MATCH bytes.
ANCHOR = 16
# A task holds one batch or one shard, about twenty times its bytes with all arrays: for executors with 0.5 GB or more a core
# outside the heap. More memory a core allows larger batches, and so fewer.
BATCH_BYTES = 8 << 20
# A new batch of an index shard has at least so many suffixes, if there are as many.
UNIT = 1 << 16

_SPAN = MATCH - ANCHOR + 1
_POSITION_BITS = 18
_BUFFER = (1 << _POSITION_BITS) - 1
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_HASH_BYTES = 5
# Running sums are kept over so many bytes at a time.
_HASHED = 1 << 18


@dataclass
class Runs:
    """Neighbouring strings of MATCH bytes with one anchor: where in the batch they start, how many, whose they are."""

    first: np.ndarray
    n: np.ndarray
    anchor: np.ndarray
    doc: np.ndarray


def _sliding_min(values: np.ndarray, span: int) -> np.ndarray:
    width = 1
    while 2 * width <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[:len(values) - (span - width)], values[span - width:]) if span > width else values


def _runs_in(buffer: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a buffer of at most _BUFFER bytes whose texts end at `ends`: first string, how many, anchor."""
    words = np.ascontiguousarray(words_at(buffer, 8, "<u8"))
    mixed = words[:-8] * _MIX[0]
    high = words[8:] ^ (words[8:] >> np.uint64(31))
    mixed ^= high * _MIX[1]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX[2]
    mixed ^= mixed >> np.uint64(32)
    key = (mixed << np.uint64(_POSITION_BITS)) | np.arange(len(mixed), dtype=np.uint64)
    least = _sliding_min(key, _SPAN)
    new = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    starts = np.concatenate([[0], ends[:-1]])
    new[starts[starts < len(new)]] = True
    first = np.flatnonzero(new)
    stop = np.append(first[1:], len(least))
    stop = np.minimum(stop, ends[np.searchsorted(ends, first, side="right")] - MATCH + 1)
    good = stop > first
    first, stop = first[good], stop[good]
    return first, stop - first, least[first] >> np.uint64(_POSITION_BITS)


def runs(texts: list[bytes]) -> Runs:
    """Runs of all texts of a batch, by their place in the concatenation of the texts. Texts longer than a buffer are
    read in stretches that overlap by MATCH - 1 bytes, so every string is in one run."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    out: list[tuple[np.ndarray, ...]] = []
    for first, last, buffer, starts in whole_buffers(texts, _BUFFER):
        for at in range(0, max(1, len(buffer) - MATCH + 1), _BUFFER - MATCH + 1):
            part = buffer[at:at + _BUFFER]
            if len(part) < MATCH:
                continue
            edges = np.unique(np.clip(starts[1:] - at, 0, len(part)))
            where, n, anchor = _runs_in(part, edges[edges > 0])
            place = where + at + begins[first]
            out.append((place, n, anchor, np.searchsorted(begins, place, side="right") - 1))
    if not out:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none.astype(np.uint64), none)
    found = Runs(*(np.concatenate(x) for x in zip(*out)))
    # An empty text begins where the next one does.
    found.doc = np.searchsorted(begins + sizes, found.first, side="right")
    return found


@lru_cache(maxsize=8)
def _powers(base: int, log2: int) -> np.ndarray:
    """The first 2**log2 powers of a number, modulo 2**64."""
    out, step = np.ones(1, np.uint64), base
    for _ in range(log2):
        out = np.concatenate([out, out * np.uint64(step)])
        step = step * step % 2**64
    return out


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(50).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _contents(buffer: np.ndarray, found: Runs) -> np.ndarray:
    """A 64-bit hash of the bytes of each run: differences of running sums of byte values times powers."""
    out, power = np.empty(len(found.first), np.uint64), 0x5851F42D4C957F2D
    stop = found.first + found.n + MATCH - 1
    for begin in range(0, len(buffer), _HASHED):
        low, high = np.searchsorted(found.first, (begin, begin + _HASHED))
        if low == high:
            continue
        part = buffer[begin:stop[low:high].max()]
        log2 = int(len(part)).bit_length()
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_byte_values()[part] * _powers(power, log2)[:len(part)], out=sums[1:])
        first = found.first[low:high] - begin
        out[low:high] = (sums[stop[low:high] - begin] - sums[first]) * _powers(pow(power, -1, 2**64), log2)[first]
    return (out ^ (out >> np.uint64(32))) * _MIX[3] + found.anchor * _MIX[0] + found.n.astype(np.uint64)


@dataclass
class Batch:
    """The texts of one batch in ascending order, their runs, and for each run the first of equal content."""

    docs: np.ndarray
    buffer: np.ndarray
    sizes: np.ndarray
    runs: Runs
    content: np.ndarray
    first_equal: np.ndarray

    @classmethod
    def of(cls, docs: pa.Table, contents: bool = True) -> tuple[Batch, pa.Table]:
        docs = docs.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        texts = [(t or "").encode("utf-8", "replace") for t in docs["text"].to_pylist()]
        found = runs(texts)
        buffer = np.frombuffer(b"".join(texts), np.uint8)
        ids = np.array([LAST_ID if d is None else d for d in docs["doc_id"].to_pylist()], np.int64)
        content, first_equal = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if contents and len(found.first):
            content = _contents(buffer, found)
            _, first, back = np.unique(content, return_index=True, return_inverse=True)
            first_equal = first[back]
        return cls(ids, buffer, np.array([len(t) for t in texts], np.int64), found, content, first_equal), docs

    def owner(self, run: np.ndarray) -> np.ndarray:
        return self.docs[self.runs.doc[run]]


def _shard(anchor: np.ndarray, shards: int) -> np.ndarray:
    return ((anchor * _MIX[3]) >> np.uint64(40)).astype(np.int64) % shards


def _hash_bytes(anchor: np.ndarray, several: np.ndarray) -> np.ndarray:
    """Anchors as 39 bits of hash and one that says whether several documents of the batch have them."""
    packed = (anchor << np.uint64(1) | several.astype(np.uint64)) & np.uint64(2**40 - 1)
    return packed.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES]


def _hashes(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // _HASH_BYTES, 8), np.uint8)
    wide[:, :_HASH_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, _HASH_BYTES)
    return wide.view("<u8").ravel()


def _rows(batch: int, shard: np.ndarray, *columns: np.ndarray) -> list[dict]:
    """Columns cut by shard, as bytes."""
    order = np.argsort(shard, kind="stable")
    which, first = np.unique(shard[order], return_index=True)
    cuts = np.append(first, len(order))
    columns = [c[order] for c in columns]
    return [{"batch": batch, "shard": int(s), **{f"c{i}": c[a:b].tobytes() for i, c in enumerate(columns)}}
            for s, a, b in zip(which, cuts, cuts[1:])]


@dataclass
class IndexFamily:
    """Sorted arrays of the distinct suffixes of earlier batches, cut at MATCH bytes.

    A new batch is scanned against each level, then its new suffixes become a level, and levels merge while the
    one before is not clearly larger; so there are logarithmically many, and a suffix is merged that often.
    """

    levels: list[np.ndarray] = field(default_factory=list)

    def known(self, suffixes: np.ndarray) -> np.ndarray:
        """Which of the sorted suffixes are in an earlier batch."""
        found = np.zeros(len(suffixes), bool)
        for level in self.levels:
            open_ = np.flatnonzero(~found)
            at = np.searchsorted(level, suffixes[open_])
            inside = at < len(level)
            found[open_[inside]] = level[at[inside]] == suffixes[open_[inside]]
        return found

    def add(self, suffixes: np.ndarray) -> None:
        while self.levels and len(self.levels[-1]) < 2 * len(suffixes):
            suffixes = np.sort(np.concatenate([self.levels.pop(), suffixes]), kind="stable")
        if len(suffixes):
            self.levels.append(suffixes)


def _suffixes(buffer: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The MATCH bytes from each place on. Trailing zero bytes compare like the padding of numpy's byte strings, and
    all have the same length, so equal means equal."""
    windows = np.lib.stride_tricks.sliding_window_view(buffer, MATCH)
    return np.ascontiguousarray(windows[at]).view(f"S{MATCH}").ravel()


@dataclass
class Suspects:
    """Distinct runs of a batch in an index shard: their numbers, lengths, smallest ids, content hashes and bytes."""

    batch: int
    number: np.ndarray
    n: np.ndarray
    least: np.ndarray
    content: np.ndarray
    body: np.ndarray

    def only(self, mask: np.ndarray) -> Suspects:
        return Suspects(self.batch, self.number[mask], self.n[mask], self.least[mask], self.content[mask],
                        self.body[np.repeat(mask, self.n + MATCH - 1)])


def _resolve(batches: list[Suspects], unit: int) -> list[dict]:
    """What an index shard says of its runs, which come by batch.

    Gives, for stretches of strings within runs, the smallest id that has them: the least possible number if an earlier
    batch has them. Stretches whose smallest id is that of the run are left out. A run that an earlier batch has as a
    whole is answered at once and needs no suffixes.
    """
    index, out = IndexFamily(), []
    content = np.concatenate([b.content for b in batches])
    fresh = np.zeros(len(content), bool)
    fresh[np.unique(content, return_index=True)[1]] = True
    group: list[Suspects] = []
    size, at = 0, 0
    for i, one in enumerate(batches):
        mask = fresh[at:at + len(one.n)]
        at += len(one.n)
        old = one.number[~mask]
        if len(old):
            rows = np.column_stack([old, np.zeros_like(old), one.n[~mask], np.full_like(old, -LAST_ID)]).astype("<i8")
            out.append({"batch": one.batch, "answers": rows.tobytes()})
        if mask.any():
            group.append(one.only(mask))
            size += int(group[-1].n.sum())
        last = i == len(batches) - 1
        if group and (size >= unit or last):
            out += _resolve_unit(index, group, not last)
            group, size = [], 0
    return out


def _resolve_unit(index: IndexFamily, group: list[Suspects], more: bool) -> list[dict]:
    number, n, least, body = (np.concatenate([getattr(g, k) for g in group]) for k in ("number", "n", "least", "body"))
    batch = np.repeat([g.batch for g in group], [len(g.n) for g in group])
    n = n.astype(np.int64)
    run = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    begins = np.cumsum(n + MATCH - 1) - (n + MATCH - 1)
    suffixes = _suffixes(body, begins[run] + within)
    order = np.argsort(suffixes, kind="stable")
    ordered = suffixes[order]
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    first = np.flatnonzero(new)
    smallest = np.minimum.reduceat(least[run[order]], first)
    distinct = ordered[first]
    known = index.known(distinct)
    if more:
        index.add(distinct[~known])
    smallest[known] = -LAST_ID
    of_window = np.empty(len(run), np.int64)
    of_window[order] = np.repeat(smallest, np.diff(np.append(first, len(order))))
    # Stretches of one run with one answer.
    change = np.ones(len(run), bool)
    change[1:] = (run[1:] != run[:-1]) | (of_window[1:] != of_window[:-1])
    head = np.flatnonzero(change)
    length = np.diff(np.append(head, len(run)))
    told = of_window[head] < least[run[head]]
    head, length = head[told], length[told]
    rows = np.column_stack([number[run[head]], within[head], length, of_window[head]]).astype("<i8")
    whose = batch[run[head]]
    return [{"batch": int(b), "answers": rows[whose == b].tobytes()} for b in np.unique(whose)]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, kept: the text's bytes without repeats, n_bytes, n_removed, n_spans) of every row.

    A byte goes if it is covered by a string of MATCH bytes that also starts in a document with a smaller doc_id. Texts
    are read as UTF-8 (a null one as empty), strings never cross documents, and all are judged on the input.

    Documents are cut to batches by ascending doc_id. The strings of a batch are cut to runs: neighbours that share
    their anchor, the 16-byte word with the smallest hash inside. Equal strings have equal anchors, so a shuffle on
    the anchor brings them together in index shards:
    1. Anchors alone are shuffled; those that only one document has cannot lie in a repeat and are left.
    2. The bytes of the other runs are shuffled, each distinct one once per batch with its smallest id. A shard takes
       them batch after batch: a new batch gets a suffix array (cut at MATCH bytes), is merge-scanned against the
       existing levels, and joins them; equal-sized levels merge geometrically.
    3. The answers return to the batch they are about and are applied to its texts.
    A passage that a third of all documents share is a row per batch in each of its shards.

    A null doc_id counts as the largest. Rows that share an id are no repeats of each other. Texts of under MATCH bytes
    stay whole. Columns besides doc_id and text are not read. No rows give no rows.
    """
    text_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    batches, bounds = _bounds(plain)
    dealt = _batched(plain, bounds)

    def anchors(key: tuple, group: pa.Table) -> pa.Table:
        batch, _ = Batch.of(group, contents=False)
        order = np.lexsort((batch.docs[batch.runs.doc], batch.runs.anchor))
        anchor, owner = batch.runs.anchor[order], batch.owner(order)
        new = np.ones(len(anchor), bool)
        np.not_equal(anchor[1:], anchor[:-1], out=new[1:])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(anchor)) - 1
        distinct = anchor[first]
        found = _rows(key[0].as_py(), _shard(distinct, batches), _hash_bytes(distinct, owner[first] != owner[last])) if len(first) else []
        return pa.Table.from_pylist(found, pa.schema([("batch", pa.int32()), ("shard", pa.int32()), ("c0", pa.binary())]))

    def shared(group: pa.Table) -> pa.Table:
        raw = [_hashes(x) for x in group["c0"].to_pylist()]
        owner = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        every = np.concatenate(raw)
        anchor, several = every >> np.uint64(1), (every & np.uint64(1)).astype(bool)
        order = np.argsort(anchor, kind="stable")
        same = anchor[order][1:] == anchor[order][:-1]
        hit = several[order]
        hit[1:] |= same
        hit[:-1] |= same
        mask = np.zeros(len(every), bool)
        mask[order] = hit
        return pa.table({"batch": group["batch"], "c0": pa.array(_cut(anchor[mask], owner[mask], len(raw)), pa.binary())})

    def suspects(key: tuple, group: pa.Table, lists: pa.Table) -> pa.Table:
        schema = pa.schema([("batch", pa.int32()), ("shard", pa.int32()), *((f"c{i}", pa.binary()) for i in range(5))])
        if not len(group) or not len(lists):
            return schema.empty_table()
        batch, _ = Batch.of(group)
        wanted = np.sort(np.concatenate([_hashes(x) for x in lists["c0"].to_pylist()]))
        number = np.flatnonzero(batch.first_equal == np.arange(len(batch.first_equal)))
        anchor = batch.runs.anchor[number]
        masked = anchor & np.uint64(2**39 - 1)
        at = np.minimum(np.searchsorted(wanted, masked), max(len(wanted) - 1, 0))
        number = number[wanted[at] == masked] if len(wanted) else number[:0]
        if not len(number):
            return schema.empty_table()
        shard = _shard(batch.runs.anchor[number], batches)
        order = np.argsort(shard, kind="stable")
        number, shard = number[order], shard[order]
        n = batch.runs.n[number]
        width = n + MATCH - 1
        which, first = np.unique(shard, return_index=True)
        cuts = np.append(first, len(number))
        steps = np.arange(int(width.sum())) + np.repeat(batch.runs.first[number] - (np.cumsum(width) - width), width)
        body = batch.buffer[steps]
        ends = np.append(0, np.cumsum(width))
        # Runs are numbered by the first of equal content; the smallest id comes first, as texts are in order.
        least, content = batch.owner(number), batch.content[number]
        out = [{"batch": key[0].as_py(), "shard": int(s), "c0": number[a:b].astype("<i8").tobytes(), "c1": n[a:b].astype("<i4").tobytes(),
                "c2": least[a:b].astype("<i8").tobytes(), "c3": content[a:b].astype("<u8").tobytes(), "c4": body[ends[a]:ends[b]].tobytes()}
               for s, a, b in zip(which, cuts, cuts[1:])]
        return pa.Table.from_pylist(out, schema)

    def resolve(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["batch"])
        kinds = ("<i8", "<i4", "<i8", "<u8", np.uint8)
        found = [Suspects(r["batch"], *(np.frombuffer(r[f"c{i}"], kind) for i, kind in enumerate(kinds))) for r in rows]
        return pa.Table.from_pylist(_resolve(found, UNIT), pa.schema([("batch", pa.int32()), ("answers", pa.binary())]))

    def cut(key: tuple, group: pa.Table, told: pa.Table) -> pa.Table:
        batch, ordered = Batch.of(group)
        return _cut_texts(batch, ordered, [np.frombuffer(x, "<i8").reshape(-1, 4) for x in told["answers"].to_pylist()])

    hashed = dealt.groupBy("batch").applyInArrow(anchors, "batch int, shard int, c0 binary")
    lists = hashed.groupBy("shard").applyInArrow(shared, "batch int, c0 binary")
    found = (dealt.groupBy("batch").cogroup(lists.groupBy("batch"))
             .applyInArrow(suspects, "batch int, shard int, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary"))
    answers = found.groupBy("shard").applyInArrow(resolve, "batch int, answers binary")
    return (dealt.groupBy("batch").cogroup(answers.groupBy("batch"))
            .applyInArrow(cut, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"))


def _cut(anchor: np.ndarray, owner: np.ndarray, n: int) -> list[bytes]:
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(n + 1))
    packed = anchor[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES]
    return [packed[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def _bounds(docs: DataFrame) -> tuple[int, list[float]]:
    """Number of batches, and the ids they are cut at: quantiles of doc_id, so that a batch has about BATCH_BYTES."""
    total = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("size")).first()
    # Anchors of a batch go to as many shards as there are batches, so more batches than tasks need only cost rows.
    parallel = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    batches = max(1, min(total["rows"], max(parallel, -(-(total["size"] or 0) // BATCH_BYTES))))
    if batches == 1:
        return 1, []
    cuts = docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 100 * batches).alias("q")).first()["q"]
    return batches, sorted({float(q) for q in cuts or []})


def _batched(docs: DataFrame, bounds: list[float]) -> DataFrame:
    if not bounds:
        return docs.withColumn("batch", F.lit(0))
    from pyspark.ml.feature import Bucketizer

    placed = docs.withColumn("place", F.coalesce("doc_id", F.lit(LAST_ID)).cast("double"))
    cutter = Bucketizer(splits=[-float("inf"), *bounds, float("inf")], inputCol="place", outputCol="bucket")
    return cutter.transform(placed).select("doc_id", "text", F.col("bucket").cast("int").alias("batch"))


def _cut_texts(batch: Batch, ordered: pa.Table, told: list[np.ndarray]) -> pa.Table:
    run, edges = batch.runs, np.zeros(len(batch.buffer) + 1, np.int64)
    if len(run.first):
        mine = batch.docs[run.doc]
        repeat = batch.owner(batch.first_equal) < mine
        np.add.at(edges, run.first[repeat], 1)
        np.add.at(edges, run.first[repeat] + run.n[repeat] + MATCH - 1, -1)
        if told:
            rows = np.concatenate(told)
            # The other runs of that content in the document with the smallest id, besides the first, get the same answer.
            others = np.flatnonzero(~repeat)
            by_first = others[np.argsort(batch.first_equal[others], kind="stable")]
            firsts = batch.first_equal[by_first]
            low, high = np.searchsorted(firsts, rows[:, 0]), np.searchsorted(firsts, rows[:, 0], side="right")
            times = high - low
            row = np.repeat(np.arange(len(rows)), times)
            target = by_first[np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)]
            begin = run.first[target] + rows[row, 1]
            np.add.at(edges, begin, 1)
            np.add.at(edges, begin + rows[row, 2] + MATCH - 1, -1)
    gone = np.cumsum(edges[:-1]) > 0
    ends = np.cumsum(batch.sizes)
    kept, removed, spans = [], [], []
    for end, n in zip(ends, batch.sizes):
        mask = gone[end - n:end]
        kept.append(batch.buffer[end - n:end][~mask].tobytes())
        removed.append(int(mask.sum()))
        spans.append(int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum()))
    return pa.table({"doc_id": ordered["doc_id"], "kept": pa.array(kept, pa.binary()), "n_bytes": pa.array(batch.sizes),
                     "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64())})
