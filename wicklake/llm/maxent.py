"""Operator 13: language model scores by a hashed maximum-entropy model with a class-factored softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicklake.llm.common import staged, text_batches

# A word's probability is that of its class times that of the word in its class. The most frequent words are dealt by rank to
# classes of WIDTH words, whose members depend on the context; all others are classed by their last bytes and have the
# probability of their count there. WIDTH classes are there in all.
WIDTH = 64
HEAD_CLASSES = 24
HEAD = HEAD_CLASSES * WIDTH
ENDINGS = WIDTH - HEAD_CLASSES
# Contexts are words of the head, endings of others, and what stands before a text.
START = HEAD + ENDINGS
# Rows of weights that features are hashed to: the word before and the word before that, for words together with the class. A row
# has a weight for each class or each word of a class.
CLASS_ROWS = (1 << 11, 1 << 11)
WORD_ROWS = (1 << 13, 1 << 13)
# The counts of so many words, none longer than so many bytes, are broadcast; those of others are joined.
KNOWN = 1 << 17
KNOWN_BYTES = 64
# Every training document is learned from once, in so many rounds. After a round all tasks' gradient updates are averaged.
ROUNDS = 3
RATE = 2.0
FIRST_SQUARES = 1.0
BATCH = 1 << 13
# The updates of so many tasks meet in one, again and again until one is left.
FAN_IN = 64
END = "\n"

_COUNTED = 4_000_000
_CHUNK = 512
_CLASS_AT = np.cumsum((0, *CLASS_ROWS))
_WORD_AT = np.cumsum((_CLASS_AT[-1], *WORD_ROWS))
_CLASS_BIAS = int(_WORD_AT[-1])
_WORD_BIAS = _CLASS_BIAS + 1
ROWS = _WORD_BIAS + HEAD_CLASSES
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MOST = np.float32(60)
_TOGETHER = 64
_ONES = np.ones(BATCH, np.float32)


def in_training(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) with `held_out`: true where crc32(doc_id as text) mod 7 is 2, and where there is no id."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(hashed % 7 == 2, F.lit(True)).alias("held_out"))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch of texts, A-Z in lower case, and how many each text has. With END they are the tokens of the texts."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, of = split.flatten(), pc.list_parent_indices(split)
    # White space at either end leaves an empty word there.
    there = pc.greater(pc.binary_length(words), 0)
    return words.filter(there), np.bincount(of.filter(there).to_numpy(), minlength=len(texts))


def endings(words: pa.Array) -> np.ndarray:
    """The ending each word is classed by, a number below ENDINGS made of its last three bytes; no word is empty."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(1, np.uint8)
    code, sizes = np.zeros(len(words), np.uint64), np.diff(at)
    for back in range(1, 4):
        byte = np.where(sizes >= back, data[np.maximum(at[1:] - back, 0)], 0)
        code = code << np.uint64(8) | byte.astype(np.uint64)
    return ((code * _MIX >> np.uint64(40)) % np.uint64(ENDINGS)).astype(np.int64)


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, ending, n) of all tokens of `docs` (text, ...), END included. Tasks hand on sums over _COUNTED words at a time."""
    names = ["token", "ending", "n"]

    def handed_on(held: list[pa.Array]) -> pa.RecordBatch:
        found = pc.value_counts(pa.concat_arrays(held))
        words = found.field("values")
        return pa.RecordBatch.from_arrays([words, pa.array(endings(words), pa.int32()), found.field("counts")], names)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, texts = [], 0, 0
        for batch in batches:
            words, _ = words_of(batch["text"])
            held.append(words)
            size, texts = size + len(words), texts + batch.num_rows
            if size > _COUNTED:
                yield handed_on(held)
                held, size = [], 0
        if size:
            yield handed_on(held)
        if texts:
            end = pa.array([END])
            yield pa.RecordBatch.from_arrays([end, pa.array(endings(end), pa.int32()), pa.array([texts], pa.int64())], names)

    parts = docs.select("text").mapInArrow(of, "token string, ending int, n long")
    return parts.groupBy("token").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """The most frequent tokens, most frequent first, with their endings and counts; sums over all training tokens, and by ending
    over those beyond the head."""

    tokens: list[str]
    endings: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int
    ending_total: np.ndarray
    ending_distinct: np.ndarray

    def tail_sizes(self) -> np.ndarray:
        """What counts beyond the head are divided by: each ending keeps one place for words that are not known."""
        return self.ending_total + self.ending_distinct + 1


def _frequent(counts: DataFrame) -> DataFrame:
    """About KNOWN of the most frequent tokens, not more, and END.

    Counts are dealt to sixteenths of octaves. Those that fit are taken whole; of the first that does not, an even share by hash.
    """
    level = F.floor(16 * F.log2("n")).cast("int")
    held = counts.where((F.octet_length("token") <= KNOWN_BYTES) & (F.col("token") != END)).withColumn("level", level)
    last, left = 0, KNOWN - 1
    for r in sorted(held.groupBy("level").count().collect(), key=lambda r: -r.level):
        last = r.level
        if r["count"] > left:
            # Room for what the hash deals unevenly.
            share = max(0.0, left - 4 * left ** 0.5) / r["count"]
            break
        left -= r["count"]
    else:
        share = 1.0
    dealt = F.pmod(F.xxhash64("token"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    return held.where((F.col("level") > last) | (F.col("level") == last) & dealt).drop("level").unionByName(counts.where(F.col("token") == END))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Sums of `counts`, and its most frequent tokens: at most about KNOWN of at most KNOWN_BYTES bytes."""
    most = sorted(_frequent(counts).select("token", "ending", "n").collect(), key=lambda r: (-r.n, r.token))
    total, distinct = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
    for r in counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect():
        total[r.ending], distinct[r.ending] = r.n, r.k
    everything, kinds = int(total.sum()), int(distinct.sum())
    for r in most[:HEAD]:
        total[r.ending] -= r.n
        distinct[r.ending] -= 1
    columns = ([r.token for r in most], np.array([r.ending for r in most], np.int64), np.array([r.n for r in most], np.int64))
    return Vocabulary(*columns, everything, kinds, total, distinct)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum over each of the runs of values that have the given sizes, 0 over an empty one."""
    ends = np.cumsum(sizes)
    sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return sums[ends] - sums[ends - sizes]


def encoded(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """A row per row of `docs` (doc_id, text, held_out): number of the row, symbols of its tokens, and what counts alone say of it.

    `n_known`, `base` and `tail` sum over the tokens in `words`; `others` holds the rest (word, ending), repeats included.
    """
    sent = docs.sparkSession.sparkContext.broadcast(words)
    inner = pa.struct([("word", pa.string()), ("ending", pa.int32())])
    schema = pa.schema([
        ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base", pa.float64()), ("tail", pa.float64()), ("symbols", pa.binary()), ("others", pa.list_(inner))])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        of_words = pc.SetLookupOptions(value_set=pa.array(known.tokens, pa.string()))
        place = np.arange(len(known.tokens))
        symbol = np.where(place < HEAD, place, HEAD + known.endings).astype("<u2")
        base = np.log10((known.counts + 1) / (known.total + known.distinct + 1))
        tail = np.where(place < HEAD, 0.0, np.log10((known.counts + 1) / known.tail_sizes()[known.endings]))
        last = known.tokens.index(END) if END in known.tokens else -1
        new_end = int(endings(pa.array([END]))[0])
        # Nothing is known of the end if there is nothing to learn from.
        of_end = ((symbol[last], 1, base[last], tail[last]) if last >= 0 else
                  (HEAD + new_end, 0, -np.log10(known.total + known.distinct + 1), -np.log10(known.tail_sizes()[new_end])))
        for batch in batches:
            found, sizes = words_of(batch["text"])
            at = pc.index_in(found, options=of_words)
            unknown = at.is_null()
            others = found.filter(unknown)
            other_ending = endings(others) if len(others) else np.zeros(0, np.int64)
            new = unknown.to_numpy(zero_copy_only=False)
            old = at.drop_null().to_numpy()
            tokens = np.full(len(found) + len(sizes), of_end[0], "<u2")
            stops = np.cumsum(sizes + 1)
            inside = np.ones(len(tokens), bool)
            inside[stops - 1] = False
            own = np.empty(len(found), "<u2")
            own[~new], own[new] = symbol[old], HEAD + other_ending
            tokens[inside] = own
            n_new = _sums(new, sizes).astype(np.int64)
            cuts = np.concatenate(([0], np.cumsum(n_new)))
            listed = pa.ListArray.from_arrays(
                pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([others, pa.array(other_ending, pa.int32())], fields=list(inner)))
            data = tokens.tobytes()
            columns = [sizes + 1, sizes - n_new + of_end[1], _sums(base[old], sizes - n_new) + of_end[2], _sums(tail[old], sizes - n_new) + of_end[3],
                       [data[2 * a:2 * b] for a, b in zip((stops - sizes - 1).tolist(), stops.tolist())]]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("row", "doc_id", "held_out")), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[3:])), listed],
                schema=schema)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    return numbered.mapInArrow(
        of, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, tail double, symbols binary, "
            "others array<struct<word: string, ending: int>>")


@dataclass
class Tokens:
    """Tokens of texts with their contexts: symbol, the one before, and the one before that."""

    symbol: np.ndarray
    before: np.ndarray
    second: np.ndarray
    starts: np.ndarray

    def part(self, first: int, last: int) -> Tokens:
        return Tokens(self.symbol[first:last], self.before[first:last], self.second[first:last], self.starts)


def with_contexts(texts: list[bytes]) -> Tokens:
    """Each text has one token at least."""
    symbol = np.frombuffer(b"".join(texts), "<u2").astype(np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) // 2
    starts = np.cumsum(sizes) - sizes
    before, second = np.full(len(symbol), START, np.int64), np.full(len(symbol), START, np.int64)
    before[1:], second[2:] = symbol[:-1], symbol[:-2]
    before[starts] = second[starts] = START
    second[starts[sizes > 1] + 1] = START
    return Tokens(symbol, before, second, starts)


def _hashed(kind: int, rows: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]), kind + 1, np.uint64) * _MIX
    for part in parts:
        h = (h ^ part.astype(np.uint64)) * _MIX
        h = h ^ (h >> np.uint64(29))
    return (h % np.uint64(rows)).astype(np.int64)


def classes(symbol: np.ndarray) -> np.ndarray:
    return np.where(symbol < HEAD, symbol // WIDTH, HEAD_CLASSES + symbol - HEAD)


def features(t: Tokens) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Rows of the active features for the class of each token, those for words, and which tokens are words of the head.

    Both have the word before (2-gram) and the second word before (skip).
    """
    contexts = (t.before, t.second)
    of_class = [start + _hashed(k, n, c) for k, (start, n, c) in enumerate(zip(_CLASS_AT, CLASS_ROWS, contexts))]
    head = np.flatnonzero(t.symbol < HEAD)
    own = t.symbol[head] // WIDTH
    of_word = [start + _hashed(2 + k, n, c[head], own) for k, (start, n, c) in enumerate(zip(_WORD_AT, WORD_ROWS, contexts))]
    return [*of_class, np.full(len(t.symbol), _CLASS_BIAS)], [*of_word, _WORD_BIAS + own], head


def _softmax(weights: np.ndarray, rows: list[np.ndarray], target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural logarithm of the target's probability, and all probabilities, from the sum of the weights of the active rows."""
    z = weights.take(rows[0], axis=0)
    for more in rows[1:]:
        z += weights.take(more, axis=0)
    # Biases are logarithms of probabilities and the changes of a row add up to 0, so the sums of exponentials stay above 0.
    np.minimum(z, _MOST, out=z)
    hit = z[np.arange(len(target)), target]
    np.exp(z, out=z)
    total = z @ _ONES[:WIDTH]
    z *= (1 / total)[:, None]
    return hit - np.log(total), z


def _group_sums(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups, their sizes, and the sum of their rows of `values`.

    Large groups are summed one by one; small ones of about one size together, those that are shorter with weights of 0 at their end.
    """
    by_group = np.argsort(group.astype(np.uint16), kind="stable")
    first = np.flatnonzero(np.diff(group[by_group], prepend=-1))
    size = np.diff(np.append(first, len(group)))
    out = np.empty((len(first), values.shape[1]), np.float32)
    single = np.flatnonzero(size == 1)
    out[single] = values.take(by_group[first[single]], axis=0)
    low, width = 1, 2
    while width <= _TOGETHER:
        own = np.flatnonzero((size > low) & (size <= width))
        if len(own):
            place = first[own][:, None] + np.arange(width)
            part = values.take(by_group.take(np.minimum(place, len(group) - 1)), axis=0)
            out[own] = ((np.arange(width) < size[own][:, None]).astype(np.float32)[:, None, :] @ part)[:, 0]
        low, width = width, 2 * width
    for i in np.flatnonzero(size > low):
        out[i] = _ONES[:size[i]] @ values.take(by_group[first[i]:first[i] + size[i]], axis=0) if size[i] < len(group) else _ONES[:size[i]] @ values
    return group[by_group[first]], size, out


def log_probabilities(weights: np.ndarray, t: Tokens) -> np.ndarray:
    """Natural logarithm of each token's probability: of its class and, for the head, of the word in its class."""
    of_class, of_word, head = features(t)
    out = _softmax(weights, of_class, classes(t.symbol))[0].astype(np.float64)
    if len(head):
        out[head] += _softmax(weights, of_word, t.symbol[head] % WIDTH)[0]
    return out


class Learner:
    """Stochastic gradient updates of a copy of the weights, with a step per row that falls as its squared gradients add up."""

    def __init__(self, weights: np.ndarray, rate: float) -> None:
        self.start, self.weights, self.rate = weights, weights.copy(), rate
        self.squares = np.full(len(weights), FIRST_SQUARES, np.float32)
        self.seen = np.zeros(len(weights), np.float32)

    def _ascend(self, rows: list[np.ndarray], probabilities: np.ndarray, target: np.ndarray) -> None:
        gradient = np.negative(probabilities, out=probabilities)
        gradient[np.arange(len(target)), target] += 1
        for own in rows:
            row, size, total = _group_sums(gradient, own)
            self.squares[row] += np.einsum("ij,ij->i", total, total)
            total *= (self.rate / np.sqrt(self.squares[row]))[:, None]
            self.weights[row] += total
            self.seen[row] += size

    def learn(self, t: Tokens) -> None:
        for first in range(0, len(t.symbol), BATCH):
            part = t.part(first, first + BATCH)
            of_class, of_word, head = features(part)
            target = classes(part.symbol)
            self._ascend(of_class, _softmax(self.weights, of_class, target)[1], target)
            if len(head):
                target = part.symbol[head] % WIDTH
                self._ascend(of_word, _softmax(self.weights, of_word, target)[1], target)

    def updates(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(chunk, tokens seen by each row, change of each row) of the chunks of rows that were seen."""
        for chunk in range(-(-ROWS // _CHUNK)):
            own = slice(chunk * _CHUNK, (chunk + 1) * _CHUNK)
            if self.seen[own].any():
                yield chunk, self.seen[own].tobytes(), (self.weights[own] - self.start[own]).astype(np.float16).tobytes()


def _combined(updates: DataFrame, tasks: int) -> DataFrame:
    """(chunk, task, seen, change) with one task left: changes averaged by how often each task has seen the row.

    FAN_IN tasks meet at a time, so no group is larger however many tasks there are.
    """
    def mean(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((r["task"], r["seen"], r["change"]) for batch in batches for r in batch.to_pylist())
        seen, change = 0.0, 0.0
        for _, n, by in held:
            n = np.frombuffer(n, np.float32).astype(np.float64)
            seen, change = seen + n, change + n[:, None] * np.frombuffer(by, np.float16).reshape(len(n), WIDTH)
        change = (change / np.maximum(seen, 1)[:, None]).astype(np.float16)
        yield pa.RecordBatch.from_pylist([{"chunk": key[0].as_py(), "task": key[1].as_py(), "seen": seen.astype(np.float32).tobytes(),
                                           "change": change.tobytes()}])

    while True:
        tasks = -(-tasks // FAN_IN)
        updates = (updates.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("long"))
                   .groupBy("chunk", "task").applyInArrow(mean, "chunk long, task long, seen binary, change binary"))
        if tasks == 1:
            return updates


def initial_weights(words: Vocabulary) -> np.ndarray:
    """No features, and biases that give each token the probability of its count."""
    weights = np.zeros((ROWS, WIDTH), np.float32)
    head = np.zeros(HEAD)
    head[:min(HEAD, len(words.counts))] = words.counts[:HEAD]
    head = head.reshape(HEAD_CLASSES, WIDTH)
    of_class = np.concatenate((head.sum(axis=1), words.ending_total)) + 1
    weights[_CLASS_BIAS] = np.log(of_class / of_class.sum())
    weights[_WORD_BIAS:] = np.log((head + 1) / (head + 1).sum(axis=1, keepdims=True))
    return weights


def train(rows: DataFrame, words: Vocabulary) -> np.ndarray:
    """Weights learned from all of `rows` (row, symbols) by distributed gradient updates.

    The documents are dealt to ROUNDS by a hash of their number. In a round every task starts from the broadcast weights and goes
    through its documents of the round; changes are averaged and added. The weights have a fixed size, whatever the input.
    """
    spark = rows.sparkSession
    weights = initial_weights(words)
    tasks = rows.rdd.getNumPartitions()
    for turn in range(ROUNDS):
        sent, rate = spark.sparkContext.broadcast(weights), RATE / (1 + turn)

        def of(batches: Iterator[pa.RecordBatch], sent=sent, rate=rate) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            learner = Learner(sent.value, rate)
            for batch in batches:
                if batch.num_rows:
                    learner.learn(with_contexts(batch["symbols"].to_pylist()))
            task = TaskContext.get().partitionId()
            for chunk, seen, change in learner.updates():
                yield pa.RecordBatch.from_pylist([{"chunk": chunk, "task": task, "seen": seen, "change": change}])

        own = rows.where(F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == turn).select("symbols")
        updates = own.mapInArrow(of, "chunk long, task long, seen binary, change binary")
        weights = weights.copy()
        for r in _combined(updates, tasks).collect():
            at = r.chunk * _CHUNK
            change = np.frombuffer(r.change, np.float16).reshape(-1, WIDTH)
            weights[at:at + len(change)] += change
        sent.unpersist()
    return weights


def _scored(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """`rows` without symbols and others, but with `model`, the log10 probability of each row's symbols."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)
    plain = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "tail"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            t = with_contexts(batch["symbols"].to_pylist())
            logs = np.concatenate([log_probabilities(sent.value, t.part(i, i + BATCH)) for i in range(0, len(t.symbol), BATCH)])
            model = np.add.reduceat(logs, t.starts) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in plain), pa.array(model, pa.float64())], [*plain, "model"])

    return rows.select(*plain, "symbols").mapInArrow(
        of, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, tail double, model double")


def _of_others(rows: DataFrame, counts: DataFrame, words: Vocabulary) -> DataFrame:
    """(row, others_known, others_base, others_tail): sums over the tokens that were not broadcast, by an exact join with their counts."""
    each = rows.where(F.size("others") > 0).select("row", F.explode("others").alias("o")).select("row", F.col("o.word").alias("token"), "o.ending")
    met = each.join(counts.select("token", "n"), "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sizes = F.array(*[F.lit(int(x)) for x in words.tail_sizes()])
    size = F.element_at(sizes, F.col("ending") + 1)
    return met.groupBy("row").agg(
        F.count_if(F.col("n") > 0).alias("others_known"),
        F.sum(F.log10((F.col("n") + 1) / F.lit(words.total + words.distinct + 1))).alias("others_base"),
        F.sum(F.log10((F.col("n") + 1) / size)).alias("others_tail"))


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs` (doc_id, text, ...).

    `base_score` is the log10 probability of all tokens by their counts in training with one added, `score` that by the model.
    Rows whose crc32(doc_id as text) mod 7 is 2, and those without an id, are not learned from. A null or empty text is its end alone.
    Repeated rows count and are answered each; columns besides doc_id and text are not read. Without training rows every
    token has the same probability in `base_score`. No rows give no rows.
    """
    spark = docs.sparkSession
    text_batches(spark)
    docs = in_training(docs)
    counts = staged(token_counts(docs.where("NOT held_out")), "counts")
    words = vocabulary(counts)
    rows = staged(encoded(docs, words), "encoded")
    weights = train(rows.where("NOT held_out"), words)
    scored, others = _scored(rows, weights), _of_others(rows, counts, words)

    def plus(name: str, more: str):
        return F.col(name) + F.coalesce(more, F.lit(0))

    return scored.join(others, "row", "left").select(
        "doc_id", "held_out", "n_tokens", plus("n_known", "others_known").alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"),
        plus("base", "others_base").alias("base_score"), (F.col("model") + plus("tail", "others_tail")).alias("score"))
