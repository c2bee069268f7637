"""Operator 8: token ids in byte or bit planes, written to chunk files and read back."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wicklake.llm.common import text_batches, worker_cache
from wicklake.session import fresh_dir

END_ID = 0
BLOCK = 1 << 16
CHUNK = 1 << 20
ROWS_PER_PART = 1 << 16
LEAST_ROWS_PER_PART = 512
LEVEL = 1

# The first so many pieces that a Python worker meets are remembered, in some 50 MB; others are known for a batch.
_MOST_PIECES = 1_000_000
_ENCODE_AT_ONCE = 1 << 16
# White space of two or more that a space ends: only there may a space belong to what stands before it.
_LOOSE = re.compile(r"\s ")


class PieceEncoder:
    """Encodes whole texts with a byte-level tokenizer, space by space.

    The tokenizer's own split always begins a new part at a space that follows something other than white space, or
    that stands before something other than white space. A text without white space before any of its spaces can
    therefore be encoded in pieces that begin at its spaces, and a piece met before needs no second encoding.
    Other texts are encoded whole.

    Known pieces are kept as 128 bits of hash, sorted by the first half, with the place of their ids in a pool: some 45 bytes each.
    Arrow cuts a batch and numbers its different pieces, so only those are hashed and looked up.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.n_bytes = np.zeros(size, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            # Byte-level vocabularies write each byte as one character; an added token is written as it is.
            self.n_bytes[i] = len(token)
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.at, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that each begin with a space, run together, and the number of each. Encoded as one text,
        and cut where the bytes of the tokens reach the end of a piece."""
        ids = self._encode(["".join(pieces)])[0] if pieces else np.zeros(0, np.uint32)
        ends = np.cumsum([len(p.encode("utf-8", "replace")) for p in pieces], dtype=np.int64)
        cuts = np.searchsorted(np.cumsum(self.n_bytes[ids]), ends, side="left") + 1 if pieces else np.zeros(0, np.int64)
        return ids, np.diff(cuts, prepend=0)

    def _encode_new(self, pieces: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """An order of the pieces, their ids run together in that order, and the number of each.

        Pieces that begin with white space after their space are encoded one by one: run together with the piece
        before them they could be split otherwise.
        """
        plain = [i for i, p in enumerate(pieces) if p and not p[0].isspace()]
        spaced = [i for i, p in enumerate(pieces) if not p or p[0].isspace()]
        pools, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for first in range(0, len(plain), _ENCODE_AT_ONCE):
            ids, n = self._encode_pieces([" " + pieces[i] for i in plain[first:first + _ENCODE_AT_ONCE]])
            pools.append(ids)
            lengths.append(n)
        for ids in self._encode([" " + pieces[i] for i in spaced]):
            pools.append(ids)
            lengths.append(np.array([len(ids)]))
        return [*plain, *spaced], np.concatenate(pools), np.concatenate(lengths)

    def _places(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of different pieces are in a pool, how many, and the pool. New pieces are remembered as long as there is room."""
        data = pieces.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, data)), ">u8").astype(np.uint64)
        key, check = digests[::2], digests[1::2]
        at, lengths = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        slot = np.searchsorted(self.key, key)
        there = np.flatnonzero(slot < len(self.key))
        there = there[(self.key[slot[there]] == key[there]) & (self.check[slot[there]] == check[there])]
        at[there], lengths[there] = self.at[slot[there]], self.lengths[slot[there]]
        new = np.ones(len(pieces), bool)
        new[there] = False
        new = np.flatnonzero(new)
        order, ids, n = self._encode_new([data[i].decode() for i in new])
        new = new[order]
        at[new], lengths[new] = len(self.pool) + np.cumsum(n) - n, n
        pool = np.concatenate((self.pool, ids))
        kept = new[:max(0, _MOST_PIECES - len(self.key))]
        if len(kept):
            self.pool = pool[:at[kept[-1]] + lengths[kept[-1]]]
            by_key = kept[np.argsort(key[kept])]
            before = np.searchsorted(self.key, key[by_key])
            self.key, self.check = np.insert(self.key, before, key[by_key]), np.insert(self.check, before, check[by_key])
            self.at, self.lengths = np.insert(self.at, before, at[by_key]), np.insert(self.lengths, before, lengths[by_key])
        return at, lengths, pool

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as the tokenizer gives them for the whole text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        whole = [i for i, t in enumerate(texts) if _LOOSE.search(t) or any(s in t for s in special)]
        for i, ids in zip(whole, self._encode([texts[i] for i in whole])):
            out[i] = ids
        split = [i for i, x in enumerate(out) if x is None]
        if not split:
            return out
        cut = pc.split_pattern(pa.array([texts[i] for i in split], pa.large_string()), " ")
        pieces, starts = cut.flatten(), cut.offsets.to_numpy()
        # The first piece of a text has no space before it.
        heads = self._encode(pieces.take(pa.array(starts[:-1])).to_pylist())
        tail = np.ones(len(pieces), bool)
        tail[starts[:-1]] = False
        found = pieces.filter(pa.array(tail)).dictionary_encode()
        at, lengths, pool = self._places(found.dictionary)
        number = found.indices.to_numpy()
        n, at = lengths[number], at[number]
        stops = np.cumsum(n)
        total = int(stops[-1]) if len(stops) else 0
        ids = pool[np.arange(total) + np.repeat(at - (stops - n), n)]
        ends = np.concatenate(([0], stops))[starts[1:] - np.arange(1, len(starts))]
        for i, head, first, last in zip(split, heads, np.concatenate(([0], ends)), ends):
            out[i] = np.concatenate((head, ids[first:last]))
        return out


def encoder(path: str) -> PieceEncoder:
    cache = worker_cache()
    if path not in cache:
        cache[path] = PieceEncoder(path)
    return cache[path]


def pack(ids: np.ndarray, planes: str = "byte", block: int = BLOCK) -> tuple[list[bytes], list[int]]:
    """Compressed planes of each block of `block` ids, run together by block, and the size of each plane.

    Byte plane k of a block holds byte k of its ids, bit plane k holds bit k; a plane of zeros has size 0.
    """
    press = zstandard.ZstdCompressor(level=LEVEL)
    body, sizes = [], []
    for first in range(0, len(ids), block):
        part = ids[first:first + block].astype("<u4")
        rows = part.view(np.uint8).reshape(-1, 4).T
        if planes == "bit":
            rows = np.packbits(np.unpackbits(np.ascontiguousarray(rows), axis=1).reshape(4, -1, 8)[:, :, ::-1].transpose(0, 2, 1).reshape(32, -1), axis=1)
        for row in rows:
            pressed = press.compress(row.tobytes()) if row.any() else b""
            body.append(pressed)
            sizes.append(len(pressed))
    return body, sizes


def unpack(body: bytes, sizes: list[int], n: int, planes: str = "byte", block: int = BLOCK) -> np.ndarray:
    """The ids that `pack` was given."""
    loose, out, at, k = zstandard.ZstdDecompressor(), np.zeros(n, np.uint32), 0, 0
    per_block = 32 if planes == "bit" else 4
    for first in range(0, n, block):
        m = min(block, n - first)
        width = -(-m // 8) if planes == "bit" else m
        rows = np.zeros((per_block, width), np.uint8)
        for row in rows:
            if sizes[k]:
                row[:] = np.frombuffer(loose.decompress(body[at:at + sizes[k]]), np.uint8)
            at, k = at + sizes[k], k + 1
        if planes == "bit":
            rows = np.packbits(np.unpackbits(rows, axis=1)[:, :m].reshape(4, 8, m).transpose(0, 2, 1)[:, :, ::-1], axis=2).reshape(4, m)
        out[first:first + m] = np.ascontiguousarray(rows.T).view("<u4").ravel()
    return out


# One row per chunk: its place, the compressed planes, and the chunk index (sizes of the planes; documents and their lengths).
CHUNKS = ("part int, seq int, part_start long, n_ids long, block int, planes string, plane_sizes array<int>, "
          "doc_ids array<long>, doc_tokens array<long>, body binary")


def write(docs: DataFrame, tokenizer: str, path: str, planes: str = "byte", block: int = BLOCK, chunk: int = CHUNK) -> None:
    """Token ids of all texts of `docs` (doc_id, text, ...) in ascending doc_id order, with END_ID after each document.

    The files are Parquet with one row per chunk of about `chunk` ids; a document never leaves its chunk, so a
    reader that knows a document's chunk reads nothing else. Inside, ids are cut to blocks, each transposed to
    planes that are compressed alone. Spark writes the files, so any folder it can write to will do, a lost task is
    written again and a failed one leaves nothing behind.

    Texts meet in order by one range shuffle on doc_id and a hash of the text, so rows with one id, or none, spread over tasks as
    well. Null ids come first; rows with one id are in order of that hash, then of their text. A null or empty text is END_ID alone. Other columns are not read. No rows give no chunks.
    """
    text_batches(docs.sparkSession)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        encode = encoder(tokenizer).encode
        held: list[tuple[object, np.ndarray]] = []
        size = 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate([x for _, x in held])
            body, sizes = pack(ids, planes, block)
            row = {"part": part, "seq": seq, "part_start": start, "n_ids": len(ids), "block": block, "planes": planes, "plane_sizes": sizes,
                   "doc_ids": [d for d, _ in held], "doc_tokens": [len(x) for _, x in held], "body": b"".join(body)}
            return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode(texts)):
                held.append((doc_id, np.append(ids, np.uint32(END_ID))))
                size += len(held[-1][1])
                if size >= chunk:
                    yield closed()
                    seq, start, held, size = seq + 1, start + size, [], 0
        if held:
            yield closed()

    _SCHEMA = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("part_start", pa.int64()), ("n_ids", pa.int64()), ("block", pa.int32()),
                         ("planes", pa.string()), ("plane_sizes", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())),
                         ("doc_tokens", pa.list_(pa.int64())), ("body", pa.binary())])
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    rows = plain.count()
    parts = max(1, -(-rows // ROWS_PER_PART),
                min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // LEAST_ROWS_PER_PART))
    (plain.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")
     .mapInArrow(chunks, CHUNKS).write.option("compression", "none").parquet(path))


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document in the files; ids as little-endian 32-bit numbers.

    `start` is the number of ids of all documents before it: the ids of earlier parts, which are summed over one
    row per part, those of earlier chunks of the part, and those before it in the chunk.
    """
    stored = spark.read.schema(CHUNKS).parquet(path)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["body"], row["plane_sizes"], row["n_ids"], row["planes"], row["block"]).astype("<u4")
                n = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(n)
                cut = [ids[e - m:e].tobytes() for e, m in zip(ends, n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["part_start"] + ends - n), pa.array(n),
                     pa.array([zlib.crc32(x) for x in cut], pa.int64()), pa.array(cut, pa.binary()),
                     pa.array([row["part"]] * len(n), pa.int32())],
                    ["doc_id", "within", "n_tokens", "ids_crc32", "ids", "part"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    decoded = stored.mapInArrow(documents, "doc_id long, within long, n_tokens long, ids_crc32 long, ids binary, part int")
    return (decoded.join(parts, "part")
            .select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "ids"))


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Files written to the shared folder and read back."""
    path = fresh_dir(docs.sparkSession, "tokens")
    write(docs, tokenizer, path)
    return read(docs.sparkSession, path)
