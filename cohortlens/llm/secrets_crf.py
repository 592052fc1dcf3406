"""Secret scans with a linear-chain conditional random field.

Base patterns find assignments, access keys and hexadecimal runs. A CRF tags
every token of a text as beginning a secret, inside one, or outside, from the
token's shape and make-up, the words beside it, and features of the whole
text. It is trained by the likelihood of tag sequences around base spans, and
texts are decoded by Viterbi. What it tags and no base span meets is added.

A tag sequence is exact although most tokens never enter Viterbi: where a
token's margin for "outside" exceeds all that transitions on both sides can
give, every best sequence has "outside" there, so the chain falls into parts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import slices, smallest_by_hash, stage
from cohortlens.llm.spans import Covered, Span, sha256, written

KINDS = ("assign", "access", "hex")
FOUND = "crf"
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: What a text to learn from may hold: a wide form of the base patterns.
LIKELY = r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
#: Texts to learn from, at most, with and without a likely secret; longer texts are passed over; tokens on each side of a span.
ROWS, LONGEST, SIDE = 400, 20_000, 8
BITS, EPOCHS, RATE, DECAY = 18, 40, 0.1, 1e-3
#: Characters a found secret's longest token has at least.
SHORTEST = 12
TAGS = BEGIN, INSIDE, OUTSIDE = 0, 1, 2
#: Words whose scores a worker keeps.
KEPT = 500_000
_MARKS = "\"'`.,;:()[]{}<>!?*&#$%"
_QUOTES = "\"'`.,;:()[]{}<>"
_TOKEN = re.compile(r"\S+")


def base_spans(text: str) -> list[Span]:
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    return found + [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]


def _bucket(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature) & ((1 << BITS) - 1)


def shape(word: str) -> str:
    """Runs of letters, digits and other marks, each as one character, up to six."""
    s = re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", "9", word[:64]))
    s = re.sub(r"[^\W\d_A]+", "a", s)
    return s[:6]


def kind_of(word: str) -> tuple:
    """All of a token that its features depend on, but for the word itself as
    a neighbour: for a plain word its case, length and marks, else the token."""
    core = word.strip(_MARKS)
    if core.isalpha():
        case = 2 if core.isupper() else core[0].isupper()
        return case, min(len(core), 48) // 4, word[0] != core[0], word[-1:] if word[-1] != core[-1] else ""
    return (word,)


def token_features(kind: tuple) -> list[int]:
    if len(kind) > 1:
        case, length, left, right = kind
        return [_bucket(f) for f in (f"plain {case} {left} {right}", f"length {length}", f"makeup word {length}", "any token")]
    core = kind[0].strip(_MARKS)
    digits, upper = sum("0" <= c <= "9" for c in core), sum("A" <= c <= "Z" for c in core)
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(core[:200], core[1:200]))
    length = min(len(core), 48) // 4
    makeup = "hex" if re.fullmatch("[0-9a-f]+", core) else "upper" if re.fullmatch("[A-Z0-9]+", core) else "mixed"
    return [_bucket(f) for f in (f"shape {shape(kind[0])}", f"length {length}", f"makeup {makeup} {length}", f"digits {min(digits, 8)}", f"turns {min(turns, 6)}", f"upper {min(upper, 6)} {min(digits, 3)}", f"starts {core[:4].lower()}", f"equals {'=' in core} {length}", "any token")]


def beside_kind(kind: tuple, side: str) -> list[int]:
    """Features a neighbour's kind gives; those of its word come on top."""
    return [_bucket(f"{side} plain {kind[0]} {kind[3]}" if len(kind) > 1 else f"{side} shape {shape(kind[0])}")]


def beside_word(word: str, side: str) -> int:
    return _bucket(f"{side} {word.strip(_MARKS).lower()[:24]}")


def beside_features(word: str, side: str) -> list[int]:
    return [beside_word(word, side), *beside_kind(kind_of(word), side)]


def file_features(text: str, words: list[str]) -> list[int]:
    """Of the whole text: how many of its tokens hold digits, and whether it has lines, assignments, quotes."""
    n = max(1, len(words))
    return [_bucket(f"file lines {min(9, text.count(chr(10)) * 20 // n)}"), _bucket(f"file equals {min(5, text.count('=') * 50 // n)}"), _bucket(f"file quotes {min(5, text.count(chr(34)) * 50 // n)}")]


@dataclass
class Model:
    """weights: a row of tag weights per feature; moves[a, b]: a tag a before a tag b; first: at a text's start."""

    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def slack(self) -> float:
        """No choice of tags beside a token gains more than this by transitions."""
        return 2 * float(max(np.ptp(self.moves, axis=0).max(), np.ptp(self.moves, axis=1).max(), np.ptp(self.first))) + 1e-6


def viterbi(emit: np.ndarray, model: Model, at_start: bool, after_outside: bool, before_outside: bool) -> list[int]:
    """The best tags of a run, given what stands on its sides."""
    best = emit[0] + (model.first if at_start else model.moves[OUTSIDE] if after_outside else 0)
    back = []
    for e in emit[1:]:
        step = best[:, None] + model.moves
        back.append(step.argmax(0))
        best = step.max(0) + e
    tags = [int((best + (model.moves[:, OUTSIDE] if before_outside else 0)).argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


class Tagger:
    """A model with scores for the kinds of words a worker has met: of each as
    the token itself, as the word before, and as the word after. A word that
    the model knows as a neighbour has scores of its own."""

    def __init__(self, model: Model) -> None:
        self.model, self.slack = model, model.slack()
        self.weighty = model.weights.any(axis=1)
        self.place: dict[str, int] = {}
        self.kinds: dict[tuple, int] = {}
        self.scores = np.zeros((1024, 3, 3))
        self.used = 0

    def _row(self, kind: tuple, before: list[int], after: list[int]) -> int:
        if self.used >= len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        w = self.model.weights
        self.scores[self.used] = [w[token_features(kind)].sum(0), w[before + beside_kind(kind, "before")].sum(0), w[after + beside_kind(kind, "after")].sum(0)]
        self.used += 1
        return self.used - 1

    def _learn(self, words: list[str]) -> None:
        for word in words:
            kind, before, after = kind_of(word), beside_word(word, "before"), beside_word(word, "after")
            if self.weighty[before] or self.weighty[after]:
                self.place[word] = self._row(kind, [before], [after])
                continue
            if kind not in self.kinds:
                self.kinds[kind] = self._row(kind, [], [])
            self.place[word] = self.kinds[kind]

    def emissions(self, text: str, words: list[str]) -> np.ndarray:
        if len(self.place) > KEPT:
            self.place.clear()
            self.kinds.clear()
            self.used = 0
        if new := [w for w in set(words) if w not in self.place]:
            self._learn(new)
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        emit = self.scores[at, 0] + self.model.weights[file_features(text, words)].sum(0)
        emit[1:] += self.scores[at[:-1], 1]
        emit[:-1] += self.scores[at[1:], 2]
        return emit

    def tags(self, text: str, words: list[str]) -> list[tuple[int, int]]:
        """Token runs (first, end) that the best tag sequence marks as secrets."""
        emit = self.emissions(text, words)
        unsure = np.flatnonzero(emit[:, OUTSIDE] - np.maximum(emit[:, BEGIN], emit[:, INSIDE]) <= self.slack)
        found = []
        if not len(unsure):
            return found
        for run in np.split(unsure, np.flatnonzero(np.diff(unsure) > 1) + 1):
            a, b = int(run[0]), int(run[-1]) + 1
            begun = None
            for k, tag in enumerate([*viterbi(emit[a:b], self.model, a == 0, a > 0, b < len(words)), OUTSIDE], a):
                if begun is not None and tag != INSIDE:
                    found.append((begun, k))
                    begun = None
                if tag == BEGIN or (tag == INSIDE and begun is None):
                    begun = k
        return found

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        """What the tags add to the base spans: runs with a token long enough, without the marks around them."""
        words = text.split()
        runs = self.tags(text, words) if words else []
        if not runs:
            return []
        places, found, covered = [m.span() for m in _TOKEN.finditer(text)], [], Covered(base)
        for a, b in runs:
            start, end = places[a][0], places[b - 1][1]
            core = text[start:end].strip(_QUOTES)
            start += text[start:end].find(core)
            if max(len(w.strip(_QUOTES)) for w in words[a:b]) >= SHORTEST and not covered.meets(start, start + len(core)):
                found.append((start, start + len(core), FOUND))
        return found


def _windows(text: str) -> list[tuple[list[list[int]], list[int]]]:
    """Token feature lists and tags of the tokens around each base span, or of the middle if there is none."""
    places = [m.span() for m in _TOKEN.finditer(text)]
    words = [text[a:b] for a, b in places]
    if not words:
        return []
    base, tags, centres = sorted(base_spans(text)), [OUTSIDE] * len(words), []
    for a, b, _ in base:
        inside = [k for k, (c, d) in enumerate(places) if c < b and a < d]
        for n, k in enumerate(inside):
            tags[k] = INSIDE if n or tags[k] == INSIDE else BEGIN
        centres += inside[:1]
    of_file, out = file_features(text, words), []
    for c in centres[:4] or [len(words) // 2]:
        low, high = max(0, c - SIDE), min(len(words), c + SIDE + 1)
        features = [token_features(kind_of(words[k])) + of_file + (beside_features(words[k - 1], "before") if k else []) + (beside_features(words[k + 1], "after") if k + 1 < len(words) else []) for k in range(low, high)]
        out.append((features, tags[low:high]))
    return out


def fit(texts: list[str]) -> Model:
    """Maximise the likelihood of the windows' tags by Adagrad over all of them at once."""
    windows = [w for t in texts for w in _windows(t)]
    model = Model(np.zeros((1 << BITS, 3)), np.zeros((3, 3)), np.zeros(3))
    if not any(tag != OUTSIDE for _, tags in windows for tag in tags):
        model.weights[_bucket("any token"), OUTSIDE] = 1e3  # nothing to learn: nothing is found
        return model
    length = max(len(t) for _, t in windows)
    n = len(windows)
    tag, real = np.full((n, length), OUTSIDE), np.zeros((n, length), bool)
    seq, pos, feature = [], [], []
    for i, (fs, tags) in enumerate(windows):
        tag[i, : len(tags)], real[i, : len(tags)] = tags, True
        for k, f in enumerate(fs):
            seq += [i] * len(f)
            pos += [k] * len(f)
            feature += f
    cell, feature = np.array(seq) * length + np.array(pos), np.array(feature)
    order = np.argsort(cell, kind="stable")
    cell, feature = cell[order], feature[order]
    cells, starts = np.unique(cell, return_index=True)
    gold = np.eye(3)[tag] * real[..., None]
    sums = [np.zeros_like(p) for p in (model.weights, model.moves, model.first)]
    for _ in range(EPOCHS):
        emit = np.zeros((n * length, 3))
        emit[cells] = np.add.reduceat(model.weights[feature], starts)
        emit = emit.reshape(n, length, 3)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0] + model.first
        for k in range(1, length):
            step = np.logaddexp.reduce(ahead[:, k - 1, :, None] + model.moves, axis=1) + emit[:, k]
            ahead[:, k] = np.where(real[:, k, None], step, ahead[:, k - 1])
        for k in range(length - 2, -1, -1):
            step = np.logaddexp.reduce(model.moves + (emit[:, k + 1] + behind[:, k + 1])[:, None, :], axis=2)
            behind[:, k] = np.where(real[:, k + 1, None], step, 0)
        whole = np.logaddexp.reduce(ahead[:, -1], axis=1)
        likely = np.exp(ahead + behind - whole[:, None, None]) * real[..., None]
        wrong = (likely - gold).reshape(-1, 3) / n
        pair = ahead[:, :-1, :, None] + model.moves + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[:, None, None, None]
        both = real[:, 1:, None, None]
        moves = ((np.exp(np.minimum(pair, 0)) * both).sum((0, 1)) - (gold[:, :-1, :, None] * gold[:, 1:, None, :] * both).sum((0, 1))) / n
        weights = np.zeros_like(model.weights)
        spread = wrong[cell]
        for t in TAGS:
            weights[:, t] = np.bincount(feature, spread[:, t], len(weights))
        for value, step, total in zip((model.weights, model.moves, model.first), (weights, moves, (likely - gold)[:, 0].sum(0) / n), sums):
            step = step + DECAY * value
            total += step * step
            value -= RATE * step / (np.sqrt(total) + 1e-8)
    return model


def learn(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Model:
    """A model from ROWS texts with a likely secret and ROWS without, chosen by a hash of their ids; rows without an id are passed over."""
    rows = docs.where(F.col(doc_id).isNotNull() & (F.length(text) <= LONGEST)).select(F.col(text).alias("text"), F.col(doc_id).alias("id"))
    ids = rows.select("id", F.col("text").rlike(LIKELY).alias("likely")).groupBy("id").agg(F.max("likely").alias("likely"))
    chosen = stage(smallest_by_hash(ids, "likely", "id", ROWS), "secrets-sample")
    picked = rows.join(F.broadcast(chosen), "id").groupBy("id", "likely").agg(F.min("text").alias("text")).collect()  # 2 * ROWS at most
    return fit([r["text"] for r in sorted(picked, key=lambda r: (r["likely"], r["id"]))])


def secrets(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, a count for each base kind,
    base_sha256, spans (base and found, kind:start:end, comma-joined), n_crf.
    Null texts count as empty; without spans the string is empty. What is
    found never overlaps a base span."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS rows of weights

    def each(batches):
        tagger = Tagger(shared.value)
        for batch in slices(batches, 1):
            rows = []
            for t in (x or "" for x in batch.column(1).to_pylist()):
                base = base_spans(t)
                more = tagger.spans(t, base)
                rows.append((*[sum(s[2] == k for s in base) for k in KINDS], sha256(written(base, KINDS)), written(base + more, (*KINDS, FOUND)), len(more)))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]], ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_crf"])

    schema = f"doc_id long, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string, n_crf long"
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(each, schema)
