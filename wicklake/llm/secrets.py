"""Operator 5: secret scans with patterns, and with automata inferred from labelled credentials."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicklake.llm.common import staged, text_batches

# Fixed patterns of the contract. The keyword is in either case, ASCII only.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

# What may be a credential without a name beside it: a run of its characters with a letter and a digit in it.
LEAST_CANDIDATE = 16
SAMPLE_PER_KIND = 2000
SAMPLE_DOCS = 20_000
# State merging: two frequencies differ if they do so at this confidence (Hoeffding).
ALPHA = 0.05
# A candidate must be this many times likelier per character under a format than under plain text.
MARGIN = math.log(4.0)

_HEX_BYTE = np.array([chr(b) in "0123456789abcdef" for b in range(256)])
_CANDIDATE_BYTE = np.array([b < 128 and (chr(b).isalnum() or chr(b) in "+/_=-") for b in range(256)])


def _long_runs(raw: bytes, kind: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes of a kind, `least` or longer, as byte offsets."""
    if len(raw) < least:
        return []
    mask = kind[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    edges = np.concatenate([[0], edges, [len(mask)]])[0 if mask[0] else 1:]
    starts, ends = edges[:len(edges) // 2 * 2:2], edges[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist()))


def _points(raw: bytes, text: str, at: int) -> int:
    """Code points before a byte offset."""
    return at if len(raw) == len(text) else len(raw[:at].decode("utf-8"))


def base_spans(text: str | None) -> list[tuple[int, int, str, int, int]]:
    """(start, end, kind, start and end of the credential itself), by start, then kind as listed. Offsets count code points."""
    if not text:
        return []
    out = []
    raw = text.encode("utf-8", "replace")
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_ASSIGN:
                out.append((m.start(), m.end(), "assign", m.start(2), m.end(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                out.append((m.start(), m.end(), "access", m.start(), m.end()))
    for a, b in _long_runs(raw, _HEX_BYTE, LEAST_HEX):
        start = _points(raw, text, a)
        out.append((start, start + b - a, "hex", start, start + b - a))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


@dataclass
class Automaton:
    """A deterministic automaton with probabilities: for each state its moves by symbol (next state, probability) and
    the probability to end there."""

    moves: list[dict[str, tuple[int, float]]]
    ends: list[float]

    def likelihood(self, symbols: str, floor: float = 1e-4) -> float:
        """Mean log-probability per symbol, the end included; a move that was never seen has `floor` and stays."""
        state, total = 0, 0.0
        for s in symbols:
            state, p = self.moves[state].get(s, (state, floor))
            total += math.log(max(p, floor))
        return (total + math.log(max(self.ends[state], floor))) / (len(symbols) + 1)


@dataclass
class _Tree:
    """Prefix tree with counts, merged in place."""

    child: list[dict[str, int]] = field(default_factory=lambda: [{}])
    count: list[dict[str, int]] = field(default_factory=lambda: [{}])
    end: list[int] = field(default_factory=lambda: [0])

    def add(self, word: str, times: int) -> None:
        at = 0
        for s in word:
            self.count[at][s] = self.count[at].get(s, 0) + times
            if s not in self.child[at]:
                self.child[at][s] = len(self.child)
                self.child.append({})
                self.count.append({})
                self.end.append(0)
            at = self.child[at][s]
        self.end[at] += times

    def total(self, at: int) -> int:
        return self.end[at] + sum(self.count[at].values())


def _differ(a: int, n: int, b: int, m: int, alpha: float) -> bool:
    if not n or not m:
        return False
    return abs(a / n - b / m) > math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))


def infer(words: Counter, alpha: float = ALPHA) -> Automaton:
    """Grammar inference by state merging.

    Words become a prefix tree with counts. States are taken breadth first; each is merged into the first accepted state
    that it is statistically compatible with, that is, whose frequencies of ending and of each symbol agree within a
    Hoeffding bound, and so on down the tree; otherwise it is accepted as a state of its own. Merging folds the subtree.
    """
    tree = _Tree()
    for word in sorted(words):
        tree.add(word, words[word])

    def compatible(a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            x, y = stack.pop()
            n, m = tree.total(x), tree.total(y)
            if _differ(tree.end[x], n, tree.end[y], m, alpha):
                return False
            for s in tree.count[x].keys() | tree.count[y].keys():
                if _differ(tree.count[x].get(s, 0), n, tree.count[y].get(s, 0), m, alpha):
                    return False
                if s in tree.child[x] and s in tree.child[y]:
                    stack.append((tree.child[x][s], tree.child[y][s]))
        return True

    def fold(into: int, gone: int) -> None:
        stack = [(into, gone)]
        while stack:
            x, y = stack.pop()
            tree.end[x] += tree.end[y]
            for s, k in tree.count[y].items():
                tree.count[x][s] = tree.count[x].get(s, 0) + k
                if s in tree.child[x]:
                    stack.append((tree.child[x][s], tree.child[y][s]))
                else:
                    tree.child[x][s] = tree.child[y][s]

    accepted = [0]
    border = [(0, s) for s in sorted(tree.child[0])]
    while border:
        parent, s = border.pop(0)
        at = tree.child[parent][s]
        if at in accepted:
            continue
        match = next((a for a in accepted if compatible(a, at)), None)
        if match is None:
            accepted.append(at)
            border += [(at, t) for t in sorted(tree.child[at])]
        else:
            tree.child[parent][s] = match
            fold(match, at)
            known = set(accepted)
            border = [(a, t) for a in accepted for t in sorted(tree.child[a]) if tree.child[a][t] not in known]
    number = {a: i for i, a in enumerate(accepted)}
    moves = [{s: (number[tree.child[a][s]], k / tree.total(a)) for s, k in tree.count[a].items()} for a in accepted]
    return Automaton(moves, [tree.end[a] / max(1, tree.total(a)) for a in accepted])


@dataclass
class Formats:
    """Automata of credential formats and the frequencies of characters in plain words."""

    automata: dict[str, Automaton]
    plain: dict[str, float]
    lengths: dict[str, tuple[int, int]]

    def score(self, word: str, kind: str) -> float:
        """How much likelier a word is under a format than under plain text, per character, in natural logs."""
        plain = sum(math.log(self.plain.get(c, 1e-5)) for c in word) / (len(word) + 1)
        return self.automata[kind].likelihood(_symbols(word)) - plain

    def best(self, word: str) -> tuple[float, str] | None:
        fitting = [(self.score(word, k), k) for k, (a, b) in self.lengths.items() if a <= len(word) <= b]
        return max(fitting) if fitting else None


def _symbols(word: str) -> str:
    """Digits, hexadecimal letters, other small letters, capitals as classes; other characters as they are."""
    return "".join("9" if c.isdigit() else "f" if c in "abcdef" else "z" if c.islower() else "A" if c.isupper() else c for c in word)


def learn(docs: DataFrame, per_kind: int = SAMPLE_PER_KIND, sample_docs: int = SAMPLE_DOCS) -> Formats:
    """Formats from labelled credentials, which the base patterns give, of a bounded sample of documents.

    About `sample_docs` documents are read, picked by a hash of their id, and of each kind at most `per_kind` distinct
    credentials (the smallest by hash), with all their occurrences in the sample; that bounds what reaches the driver.
    Plain text is the characters of the sample's words outside of credentials.
    """
    text_batches(docs.sparkSession)
    n = docs.count()
    share = min(1.0, sample_docs / max(n, 1))
    sample = docs.select(F.col("doc_id").alias("id"), "text").filter(
        (F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))) & F.col("text").isNotNull())

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text in batch["text"].to_pylist():
                at, rest = 0, []
                for start, end, kind, a, b in base_spans(text):
                    found[kind, text[a:b]] += 1
                    rest.append(text[at:max(at, start)])
                    at = max(at, end)
                for c, k in Counter("".join([*rest, text[at:]])).items():
                    if c.isascii() and c.isalnum() or c in "+/_=-":
                        found["plain", c] += k
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found]), pa.array([w for _, w in found]), pa.array(list(found.values()), pa.int64())],
                                             ["kind", "word", "n"])

    counted = staged(sample.select("text").mapInArrow(labelled, "kind string, word string, n long")
                     .groupBy("kind", "word").agg(F.sum("n").alias("n")), "credentials")
    words: dict[str, Counter] = {k: Counter() for k in (*KINDS, "plain")}
    for kind in words:
        for row in counted.filter(F.col("kind") == kind).orderBy(F.xxhash64("word"), "word").limit(per_kind).collect():
            words[kind][row["word"]] += row["n"]
    total = sum(words["plain"].values())
    plain = {c: (k + 1) / (total + 128) for c, k in words["plain"].items()}
    automata, lengths = {}, {}
    for kind in KINDS:
        if words[kind]:
            symbols: Counter = Counter()
            for word in words[kind]:
                symbols[_symbols(word)] += 1
            automata[kind] = infer(symbols)
            sizes = [len(w) for w in words[kind]]
            lengths[kind] = (max(LEAST_CANDIDATE, min(sizes) // 2), 2 * max(sizes))
    return Formats(automata, plain, lengths)


def format_spans(text: str | None, formats: Formats, margin: float, taken: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """Spans of candidates that look like a credential and lie outside of `taken`."""
    raw = (text or "").encode("utf-8", "replace")
    out = []
    for a, b in _long_runs(raw, _CANDIDATE_BYTE, LEAST_CANDIDATE):
        word = raw[a:b].decode("ascii")
        if not any(c.isdigit() for c in word) or not any(c.isalpha() for c in word):
            continue
        start = _points(raw, text, a)
        if any(x < start + b - a and start < y for x, y in taken):
            continue
        best = formats.best(word)
        if best and best[0] >= margin:
            out.append((start, start + b - a, f"like_{best[1]}"))
    return out


def scan(docs: DataFrame, formats: Formats, margin: float = MARGIN) -> DataFrame:
    """(doc_id, base, spans) for every row: arrays of (kind, start, end), the base ones and all of them, by start, then kind.

    Base spans are those of the fixed patterns. The others, of kinds like_assign, like_access and like_hex, are runs of
    credential characters with a letter and a digit that the inferred automaton of that format finds `margin` times likelier per
    character (in natural logs) than plain text does. Candidates that touch a base span are left out. Null and empty texts
    have none. Repeated rows are answered each; other columns are not read. No rows give no rows.
    """
    text_batches(docs.sparkSession)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for text in batch["text"].to_pylist():
                known = base_spans(text)
                base.append([(kind, a, b) for a, b, kind, _, _ in known])
                more = format_spans(text, formats, margin, [(a, b) for a, b, *_ in known])
                every.append([(kind, a, b) for a, b, kind in sorted([*((a, b, k) for a, b, k, *_ in known), *more], key=_by_start)])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in rows], pa.list_(span)) for rows in (base, every))],
                ["doc_id", "base", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, "doc_id long, base array<struct<kind string, start long, end long>>, spans array<struct<kind string, start long, end long>>")


def _by_start(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]) if span[2] in KINDS else len(KINDS), span[1]
