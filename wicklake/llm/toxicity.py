"""Operator 6: toxicity by a lexicon that tolerates misspellings, and by the words around each hit."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicklake.llm.common import held_out, text_batches

SAMPLE_TOXIC = 4000
SAMPLE_OTHER = 16000
# Stems are beginnings of words; a stem stands for many endings.
STEM = range(4, 8)
LEAST_ENDINGS = 3
# Terms of so many characters may be misspelled by one edit.
FUZZY_FROM = 5
# Words on either side of a hit that its context is read from.
WINDOW = 6

# A feature is judged from so many documents of the sample.
LEAST_SEEN = 5

_CORE = re.compile(r"\w+")
_QUOTES = "\"'«»“”„‘’‹›"
# Fixed lists of words that report what others said, in the four languages of the test tables.
_REPORTING = frozenset("said says wrote writes called quoted quote word term sagte sagt schrieb zitat wort dit disait écrit citation mot dijo dice escribió cita palabra".split())


class Lexicon:
    """Words and stems in a trie, read by the automaton that accepts everything within one edit of them.

    A state is a set of (trie node, edits) pairs: where the trie can stand after the letters read so far. States and
    moves are made when they are first needed and kept, so that reading a letter is one look-up and most words die after
    a few letters. Insertions, deletions and substitutions count; the edit is allowed to terms of FUZZY_FROM letters only,
    and not to the first letter of a term.
    """

    def __init__(self, words: Iterable[str], stems: Iterable[str] = ()):
        self.children: list[dict[str, int]] = [{}]
        self.word: list[bool] = [False]
        self.stem: list[bool] = [False]
        self.longest: list[int] = [0]
        self.depth: list[int] = [0]
        for term, is_stem in [*((w, False) for w in words), *((s, True) for s in stems)]:
            self._add(term, is_stem)
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.answers: list[int] = []
        self.start = self._state(self._closed({(0, 0)}))

    def _add(self, term: str, is_stem: bool) -> None:
        node = 0
        self.longest[0] = max(self.longest[0], len(term))
        for letter in term:
            if letter not in self.children[node]:
                self.children[node][letter] = len(self.children)
                self.children.append({})
                self.word.append(False)
                self.stem.append(False)
                self.longest.append(0)
                self.depth.append(self.depth[node] + 1)
            node = self.children[node][letter]
            self.longest[node] = max(self.longest[node], len(term))
        (self.stem if is_stem else self.word)[node] = True

    def _closed(self, pairs: set[tuple[int, int]]) -> frozenset:
        """With the pairs that a letter missing from the text leads to; without those that can reach no term."""
        out = set(pairs)
        for node, edits in pairs:
            if edits == 0 and node:
                out |= {(child, 1) for child in self.children[node].values()}
        return frozenset(p for p in out if p[1] == 0 or self.longest[p[0]] >= FUZZY_FROM)

    def _state(self, members: frozenset) -> int:
        if members not in self.states:
            self.states[members] = len(self.members)
            self.members.append(members)
            self.moves.append({})
            # 3: a word as it is, 2: a stem as it is, 1: within an edit of either, 0: nothing.
            best = 0
            for node, edits in members:
                fits = not edits or self.depth[node] >= FUZZY_FROM
                if fits and self.word[node]:
                    best = max(best, 1 if edits else 3)
                if fits and self.stem[node]:
                    best = max(best, 1 if edits else 2)
            self.answers.append(best)
        return self.states[members]

    def _move(self, state: int, letter: str) -> int:
        to: set[tuple[int, int]] = set()
        for node, edits in self.members[state]:
            if letter in self.children[node]:
                to.add((self.children[node][letter], edits))
            if not edits and node:
                to.add((node, 1))
                to |= {(child, 1) for child in self.children[node].values()}
        found = self._state(self._closed(to))
        self.moves[state][letter] = found
        return found

    def match(self, word: str) -> int:
        """3 for a word of the lexicon, 2 for one that begins with a stem, 1 within an edit of either, 0 otherwise."""
        state, stem = self.start, 0
        for letter in word:
            answer = self.answers[state]
            if answer == 2 or answer == 1 and self._stem_near(state):
                stem = max(stem, answer)
            state = self.moves[state].get(letter, -1) if letter in self.moves[state] else self._move(state, letter)
            if not self.members[state]:
                return stem
        return max(stem, self.answers[state])

    def _stem_near(self, state: int) -> bool:
        return any(self.stem[node] and self.depth[node] >= FUZZY_FROM for node, edits in self.members[state] if edits)


@dataclass
class Model:
    words: list[str]
    stems: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))
    context: dict[str, float] = field(default_factory=dict)


FEATURES = 5


def _tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _matched(lexicon: Lexicon, tokens: Iterable[str]) -> dict[str, int]:
    """What the lexicon says of each token that it says something of: the best of the token's words."""
    out = {}
    for token in tokens:
        if token.isalpha():
            best = lexicon.match(token)
        else:
            best = max((lexicon.match(w) for w in _CORE.findall(token)), default=0)
        if best:
            out[token] = best
    return out


def hits(tokens: list[str], matched: dict[str, int]) -> list[tuple[int, int, bool]]:
    """(place, kind of match, quoted) of each hit. A hit is quoted if quotation marks enclose it within the window or a
    word of reporting stands in it."""
    if matched.keys().isdisjoint(tokens):
        return []
    out = []
    for i, token in enumerate(tokens):
        kind = matched.get(token)
        if kind:
            before, after = tokens[max(0, i - WINDOW):i], tokens[i + 1:i + 1 + WINDOW]
            opened = any(t[0] in _QUOTES for t in (*before, token)) and not any(t[-1] in _QUOTES for t in before)
            closed = any(t.rstrip(".,;:!?")[-1:] in _QUOTES for t in (token, *after) if t)
            reported = any(w in _REPORTING for t in (*before, *after) for w in (t.strip(".,;:!?" + _QUOTES),))
            out.append((i, kind, opened and closed or reported))
    return out


def context_words(tokens: list[str], found: list[tuple[int, int, bool]]) -> set[str]:
    places = {i for i, *_ in found}
    return {tokens[j].strip(".,;:!?") for i in places for j in range(max(0, i - WINDOW), min(len(tokens), i + WINDOW + 1)) if j not in places}


def features(tokens: list[str], matched: dict[str, int], context: dict[str, float]) -> np.ndarray:
    """Words met, stems met, misspelled ones, quoted ones (logs of counts), and the mean weight of the words around."""
    found = hits(tokens, matched)
    if not found:
        return np.zeros(FEATURES)
    kinds = [sum(k == kind and not quoted for _, k, quoted in found) for kind in (3, 2, 1)]
    around = [context[w] for w in context_words(tokens, found) if w in context]
    return np.array([*map(math.log1p, kinds), math.log1p(sum(q for *_, q in found)), float(np.mean(around)) if around else 0.0])


def _signature(tokens: list[str]) -> int:
    """Equal for copies and mostly for near copies: the smallest hash of five words in a row."""
    grams = (" ".join(tokens[i:i + 5]) for i in range(max(1, len(tokens) - 4)))
    return min(xxhash.xxh64_intdigest(g) for g in grams) & (2**63 - 1)


def _sample(docs: DataFrame, labels: DataFrame, toxic: int, other: int) -> DataFrame:
    """(id, label, body) of labelled documents that are not held out: at most so many of each label, the first by hash."""
    known = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & ~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label")))
    order = F.xxhash64("id")
    chosen = (known.filter("label = 1").orderBy(order, "id").limit(toxic)
              .union(known.filter("label = 0").orderBy(order, "id").limit(other)))
    body = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("body")).filter("body IS NOT NULL")
    # The sample is bounded by its parameters.
    return body.join(F.broadcast(chosen), "id")


def learn(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, other: int = SAMPLE_OTHER) -> Model:
    """Lexicon, context weights and weights of the features, from at most `toxic` and `other` labelled documents.

    Near copies in the sample count once, and so does a term with one and the same word before it. A word or stem joins the lexicon if its documents are toxic so much more often than
    the sample's that chance over all terms (or all stems of LEAST_ENDINGS such words) does not explain it, and few others have it. The features' weights are fitted on
    documents that the lexicon was not taken from (two halves, each by the lexicon of the other), by logistic regression;
    the final lexicon is that of both. Only doc_id and toxic of `labels` and doc_id and text of `docs` are read.
    """
    text_batches(docs.sparkSession)

    pair = pa.struct([("word", pa.string()), ("before", pa.string())])

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {"sign": [], "label": [], "words": []}
            for body, label in zip(batch["body"].to_pylist(), batch["label"].to_pylist()):
                tokens = _tokens(body)
                # Each word with what stands before it the first time.
                words = {w: before for before, t in reversed(list(zip(["", *tokens], tokens))) for w in _CORE.findall(t) if len(w) >= 3}
                rows["sign"].append(_signature(tokens))
                rows["label"].append(label)
                rows["words"].append([{"word": w, "before": words[w]} for w in sorted(words)])
            yield pa.RecordBatch.from_pydict(rows, pa.schema([("sign", pa.int64()), ("label", pa.int32()), ("words", pa.list_(pair))]))

    sample = _sample(docs, labels, toxic, other)
    counted = sample.mapInArrow(terms, "sign long, label int, words array<struct<word string, before string>>").groupBy("sign", "label").agg(F.min("words").alias("words"))
    counted = counted.withColumn("half", (F.col("sign") % 2).cast("int")).persist()
    sizes = {(r["label"], r["half"]): r["n"] for r in counted.groupBy("label", "half").agg(F.count("*").alias("n")).collect()}
    of = lambda label, half: F.sum(F.when((F.col("label") == label) & (F.col("half") == half), 1).otherwise(0)).alias(f"n{label}{half}")
    tallies = [of(1, 0), of(1, 1), of(0, 0), of(0, 1)]
    # Of toxic documents in which the same word stands before a term, only one counts: copies repeat a term's surroundings too.
    each = (counted.select("label", "half", F.explode("words").alias("w")).select("label", "half", "w.word", "w.before")
            .groupBy("word", "before", "label", "half").agg(F.count("*").alias("n")))
    several = lambda label, half: F.sum(F.when((F.col("label") == label) & (F.col("half") == half), F.lit(1) if label else F.col("n")).otherwise(0))
    words = each.groupBy("word").agg(*[several(label, half).alias(f"n{label}{half}") for label in (1, 0) for half in (0, 1)])
    tally = [(r["word"], False, r) for r in words.filter("n10 + n11 >= 2 AND n10 + n11 > n00 + n01").collect()]
    endings = Counter(word[:n] for word, _, _ in tally for n in STEM if len(word) > n)
    likely = sorted(s for s, k in endings.items() if k >= LEAST_ENDINGS)
    if likely:
        begins = F.flatten(F.transform("words", lambda w: F.array(*[F.substring(w["word"], 1, n) for n in STEM])))
        stems = counted.select("label", "half", F.explode(F.array_intersect(begins, F.lit(likely))).alias("stem")).groupBy("stem").agg(*tallies)
        tally += [(r["stem"], True, r) for r in stems.collect()]
    vocabulary = max(2, words.count())
    counted.unpersist()

    def lexicon(halves: tuple[int, ...]) -> tuple[list[str], list[str]]:
        pos, neg = (sum(sizes.get((label, h), 0) for h in halves) for label in (1, 0))
        kept: dict[bool, list[str]] = {False: [], True: []}
        for term, is_stem, row in tally:
            a, b = (sum(row[f"n{label}{h}"] for h in halves) for label in (1, 0))
            chance = math.log(len(likely)) + 3 if is_stem else math.log(vocabulary)
            if _evidence(a, pos, b, neg) >= chance and a * neg >= 20 * (b + 0.5) * max(pos, 1):
                kept[is_stem].append(term)
        stems = [s for s in kept[True] if not any(s != t and s.startswith(t) for t in kept[True])]
        return [w for w in kept[False] if not any(w.startswith(s) for s in stems)], stems

    halves = {0: lexicon((1,)), 1: lexicon((0,))}
    final = lexicon((0, 1))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = {h: Lexicon(*x) for h, x in halves.items()}
        for batch in batches:
            rows: dict[str, list] = {"label": [], "x": [], "around": []}
            for body, label in zip(batch["body"].to_pylist(), batch["label"].to_pylist()):
                tokens = _tokens(body)
                matched = _matched(tries[_signature(tokens) % 2], set(tokens))
                rows["label"].append(label)
                rows["x"].append(features(tokens, matched, {}).tolist())
                rows["around"].append(sorted(context_words(tokens, hits(tokens, matched)))[:1000])
            yield pa.RecordBatch.from_pydict(rows, pa.schema([("label", pa.int32()), ("x", pa.list_(pa.float64())), ("around", pa.list_(pa.string()))]))

    measured = sample.mapInArrow(measure, "label int, x array<double>, around array<string>").persist()
    points = measured.select("label", "x").collect()
    near = measured.select("label", F.explode("around").alias("word")).groupBy("word").agg(
        F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).filter("a + b >= 10").collect()
    measured.unpersist()
    with_hits = [sum(1 for p in points if any(p["x"]) and p["label"] == label) for label in (1, 0)]
    context = {r["word"]: math.log((r["a"] + 1) / (with_hits[0] + 2)) - math.log((r["b"] + 1) / (with_hits[1] + 2)) for r in near} if min(with_hits) >= 10 else {}
    x = np.array([p["x"] for p in points]).reshape(-1, FEATURES)
    return Model(*final, _logistic(x, np.array([p["label"] for p in points], float)), context)


def _evidence(a: int, n: int, b: int, m: int) -> float:
    """Log-likelihood ratio of a term's rates in n toxic and m other documents against one rate for all."""
    def term(k: float, of: float, rate: float) -> float:
        return (k * math.log(rate) if k else 0.0) + ((of - k) * math.log(1 - rate) if of > k else 0.0)

    if not n or not m or not a or a / n <= b / m:
        return 0.0
    rate = (a + b) / (n + m)
    return term(a, n, a / n) + term(b, m, b / m) - term(a, n, rate) - term(b, m, rate)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights with the constant last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        w[-1] = 0.0 if not len(y) else math.copysign(3.0, y[0] - 0.5)
        return w
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    # A kind of hit that the sample does not show says nearly as much as the kinds that it shows.
    for kind in range(3):
        if (x[:, kind] > 0).sum() < LEAST_SEEN:
            w[kind] = 0.8 * max(0.0, *(w[k] for k in range(3) if (x[:, k] > 0).sum() >= LEAST_SEEN), 0.0)
    # Hits never speak against toxicity, nor does what is quoted speak for it more than what is not.
    w[:3] = np.maximum(w[:3], 0)
    w[3] = min(w[3], w[:3].min())
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits) for every row of `docs` (doc_id, text, ...).

    The score is the probability of the label 1 given the features of the whole text; null and empty texts have none and get
    the score of a text without hits. Repeated rows are answered each; labels and other columns are not read. No rows give
    no rows.
    """
    text_batches(docs.sparkSession)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.words, model.stems)
        for batch in batches:
            texts = [_tokens(t) for t in batch["text"].to_pylist()]
            matched = _matched(lexicon, set().union(*texts))
            x = np.array([features(t, matched, model.context) for t in texts]).reshape(-1, FEATURES)
            p = 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(p), pa.array((p >= 0.5).astype(np.int32)),
                 pa.array([len(hits(t, matched)) for t in texts], pa.int64())],
                ["doc_id", "held_out", "score", "predicted", "n_hits"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(apply, "doc_id long, held_out boolean, score double, predicted int, n_hits long"))
