"""Byte-level BPE by speculation: propose, verify, and merge only what fails.

A text is cut into words by the vocabulary's own pattern. A worker keeps the
ids of words that it has met; words that are new to it go three steps together:

1. *Propose*: greedy longest match against the vocabulary.
2. *Verify*: a sequence of tokens is what merging by rank gives if and only if
   every two neighbours are (each token being the merge of its own bytes, which
   is checked when the vocabulary is loaded). Whether two tokens may stand side
   by side is decided for all pairs of all new words at once, in numpy: their
   merges are undone, the latest first, along the right edge of the left token
   and the left edge of the right one. If at some time the two edge tokens could
   have merged before either of them was merged away, the border was not there.
3. *Merge*: words with a border that fails are merged by rank, from their bytes.

Ids are those of the tokenizers library with ``add_special_tokens=False``:
special tokens written out in a text get their own ids. Decoding joins the
tokens' bytes and replaces what is not UTF-8.

Null texts count as empty and have no ids. Repeated rows are rows; an empty
table gives an empty table; other columns are ignored. Long texts are encoded
in windows that end where a word ends whatever follows, so neither memory nor
time depends on a text's length beyond its own ids.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import slices, texts
from cohortlens.llm.token_orc import public_vocabulary

VOCABULARY = "byte_bpe_50k.json"
#: Words whose ids a worker keeps, twice; longer words are encoded each time.
KEPT_WORDS, KEPT_LENGTH = 400_000, 40
#: Bytes of text encoded together; characters of a window of a long text.
SLICE, WINDOW = 2 << 20, 1 << 20
#: Bytes of a word up to which a list is quicker than a heap.
SHORT = 60
#: A time after all merges.
NEVER = np.iinfo(np.int64).max
#: Planes of Unicode that hold letters, numbers or white space; in the others nothing is any of these.
PLANES = (0, 1, 2, 3, 14)
_LETTER, _NUMBER, _SPACE = range(3)
_BEYOND = re.compile("[\U00010000-\U0010ffff]")


@functools.lru_cache(2)
def character_classes(path: str) -> tuple[str, str, str]:
    """Letters, numbers and white space as the vocabulary's library sees them,
    as ranges of a regular expression's set. The library is asked, because its
    tables of Unicode need not be of the version of Python's."""
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    found: list[list[int]] = [[], [], []]
    for first in (p << 16 | part for p in PLANES for part in range(0, 1 << 16, 1 << 12)):
        codes = [c for c in range(first, first + (1 << 12)) if not 0xD800 <= c < 0xE000]
        # a letter joins the a before it, a number the 1 behind it, and what is neither nor white space the mark at the end
        starts = {at for _, (at, _) in cut("".join(f"a{chr(c)}1{chr(c)}!" for c in codes))}
        for k, c in enumerate(codes):
            if 5 * k + 1 not in starts:
                found[_LETTER].append(c)
            elif 5 * k + 2 not in starts and c != 0x20:
                found[_NUMBER].append(c)
            elif 5 * k + 4 in starts or c == 0x20:
                found[_SPACE].append(c)
    return tuple(_ranges(codes) for codes in found)


def _ranges(codes: list[int]) -> str:
    at = np.asarray(codes)
    cuts = np.flatnonzero(np.diff(at) > 1)
    ends = zip(at[np.concatenate([[0], cuts + 1])].tolist(), at[np.concatenate([cuts, [len(at) - 1]])].tolist())
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ends)


def word_pattern(letters: str, numbers: str, space: str) -> re.Pattern:
    """Words of a byte-level vocabulary: contractions; letters, numbers or marks with one blank before them; white space."""
    return re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+")


def _basic(ranges: str) -> str:
    """The ranges up to U+FFFF: a set without the others is searched much faster."""
    return "".join(x for x in re.findall(r"\\U.{8}-\\U.{8}", ranges) if int(x[2:10], 16) < 1 << 16)


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in such vocabularies: visible ones for themselves, the others from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in visible)
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(others)}


class Merges:
    """The vocabulary as numbers: per token its bytes, its rank and its two halves; per pair of tokens the rank of their merge."""

    def __init__(self, spec: dict):
        model, byte_of = spec["model"], byte_characters()
        self.bytes_of = {k: bytes(map(byte_of.__getitem__, token)) for token, k in model["vocab"].items()}
        n = max(self.bytes_of) + 1
        self.rank, self.left, self.right = np.full(n, -1, np.int64), np.arange(n), np.arange(n)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right, whole = (model["vocab"][x] for x in (a, b, a + b))
            if self.rank[whole] >= 0 or max(self.rank[left], self.rank[right]) >= rank:
                raise ValueError("a token that two merges make, or that is merged before it is made")
            self.rank[whole], self.left[whole], self.right[whole] = rank, left, right
            self.merged[left, right] = rank, whole
        self.n = n
        self.pair = np.array(sorted(a * n + b for a, b in self.merged), np.int64)
        self.pair_rank = np.array([self.merged[k // n, k % n][0] for k in self.pair.tolist()], np.int64)
        self.single = {self.bytes_of[k][0]: k for k in self.bytes_of if len(self.bytes_of[k]) == 1}
        if len(self.single) < 256:
            raise ValueError("a vocabulary without a token for every byte")
        # a token may be proposed if its halves may, and nothing across their border merges before they do
        made = np.flatnonzero(self.rank >= 0)
        whole = dict(zip(made.tolist(), self.compatible(self.left[made], self.right[made], self.rank[made]).tolist()))
        for k in made[np.argsort(self.rank[made])].tolist():
            whole[k] = whole[k] and whole.get(int(self.left[k]), True) and whole.get(int(self.right[k]), True)
        self.proposed = {self.bytes_of[k]: k for k in [*self.single.values(), *(k for k, sound in whole.items() if sound)]}
        self.longest: dict[bytes, int] = {}
        for token in self.proposed:
            self.longest[token[:2]] = max(self.longest.get(token[:2], 0), len(token))

    def rank_of(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The rank at which u and v merge; NEVER if they don't."""
        key = u * self.n + v
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], NEVER) if len(self.pair) else np.full(len(key), NEVER)

    def compatible(self, left: np.ndarray, right: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """For each pair of neighbours whether the border between them stays when
        their bytes are merged by rank. With ``until``, the ranks at which the
        pairs themselves merge, whether it stays until then."""
        u, v, ok, at = left.copy(), right.copy(), np.ones(len(left), bool), np.arange(len(left))
        u_until = np.full(len(u), NEVER) if until is None else until.copy()
        v_until = np.full(len(v), NEVER) if until is None else until - 1
        while len(at):
            merge = self.rank_of(u, v)
            # of equal merges the leftmost goes first: u's own goes before this one, this one before v's own
            early = (merge < u_until) & (merge <= v_until)
            ok[at[early]] = False
            made_u, made_v = self.rank[u], self.rank[v]
            go_on = ~early & ((made_u >= 0) | (made_v >= 0))
            undo_v = made_v >= made_u
            u_until, v_until = np.where(undo_v, u_until, made_u), np.where(undo_v, made_v, v_until)
            u, v = np.where(undo_v, u, self.right[u]), np.where(undo_v, self.left[v], v)
            u, v, u_until, v_until, at = (x[go_on] for x in (u, v, u_until, v_until, at))
        return ok

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, find, longest = [], 0, self.proposed.get, self.longest.get
        while at < len(word):
            end = min(len(word), at + longest(word[at : at + 2], 1))
            while (k := find(word[at:end])) is None:
                end -= 1
            out.append(k)
            at = end
        return out

    def merge(self, word: bytes) -> list[int]:
        """Merging by rank, leftmost first among equals."""
        token = [self.single[b] for b in word]
        return self._merge_short(token) if len(token) <= SHORT else self._merge_long(token)

    def _merge_short(self, token: list[int]) -> list[int]:
        """The least rank is looked up in a list, which is quickest for few bytes."""
        none, find = (NEVER, -1), self.merged.get
        due = [find(p, none) for p in zip(token, token[1:])]
        while due and (least := min(due))[0] < NEVER:
            i = due.index(least)
            token[i : i + 2] = [least[1]]
            del due[i]
            if i:
                due[i - 1] = find((token[i - 1], token[i]), none)
            if i < len(due):
                due[i] = find((token[i], token[i + 1]), none)
        return token

    def _merge_long(self, token: list[int]) -> list[int]:
        """The least rank is kept in a heap: n log n steps."""
        after, before = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1))
        due = [(*self.merged[p], i, *p) for i, p in enumerate(zip(token, token[1:])) if p in self.merged]
        due = [(rank, i, whole, a, b) for rank, whole, i, a, b in due]
        heapq.heapify(due)
        while due:
            _, i, whole, a, b = heapq.heappop(due)
            j = after[i]
            if token[i] != a or j == len(token) or token[j] != b:  # one of them was merged meanwhile
                continue
            token[i], token[j], after[i] = whole, -1, after[j]
            if after[i] < len(token):
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(token) and (p := (token[x], token[y])) in self.merged:
                    rank, made = self.merged[p]
                    heapq.heappush(due, (rank, x, made, *p))
        return [k for k in token if k >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[list[bytes], int]:
        """The ids of each word (4 bytes each, little-endian), and how many words failed verification."""
        proposals = [self.propose(w) for w in words]
        counts = np.fromiter(map(len, proposals), np.int64, len(words))
        ids = np.fromiter((k for p in proposals for k in p), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(words)), counts)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, place = np.unique(ids[inner] * self.n + ids[inner + 1], return_inverse=True)
        sound = self.compatible(pairs // self.n, pairs % self.n)[place]
        failed = np.unique(owner[inner[~sound]])
        for k in failed.tolist():
            proposals[k] = self.merge(words[k])
        return [np.asarray(p, "<u4").tobytes() for p in proposals], len(failed)


class Codec:
    """Texts to ids and back, with a bounded memory of words."""

    def __init__(self, path: str, classes: tuple[str, str, str]):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        _check(spec)
        self.merges = Merges(spec)
        self.words = word_pattern(*classes)
        self.basic_words = word_pattern(*map(_basic, classes))
        self.cut = re.compile(rf"(?<=[{classes[_LETTER]}]) (?=[{classes[_LETTER]}])")
        special = sorted(spec["added_tokens"], key=lambda t: -len(t["content"]))
        self.special = {t["content"]: np.asarray([t["id"]], "<u4").tobytes() for t in special}
        self.split = re.compile("(" + "|".join(re.escape(t["content"]) for t in special) + ")") if special else None
        content = self.merges.bytes_of | {t["id"]: t["content"].encode() for t in special}
        sizes = np.zeros(max(content) + 1, np.int64)
        sizes[list(content)] = [len(content[k]) for k in content]
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.content = np.frombuffer(b"".join(content.get(k, b"") for k in range(len(sizes))), np.uint8)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.proposals = self.merged = 0

    def windows(self, text: str) -> Iterator[str]:
        """The text in parts; at the blank between two letters a word ends, whatever stands before or behind."""
        at = 0
        while len(text) - at > WINDOW and (m := self.cut.search(text, at + WINDOW)):
            yield text[at : m.start()]
            at = m.start()
        yield text[at:]

    def encode(self, batch: list[str]) -> list[bytes]:
        """The ids of each text, 4 bytes each, little-endian."""
        return [b"".join(self._encode(part) for part in self.windows(t)) if len(t) > WINDOW else ids for t, ids in zip(batch, self._together([t if len(t) <= WINDOW else "" for t in batch]))]

    def _encode(self, part: str) -> bytes:
        return self._together([part])[0]

    def _together(self, batch: list[str]) -> list[bytes]:
        cut: list[list[str]] = []
        for text in batch:
            find = (self.words if _BEYOND.search(text) else self.basic_words).findall
            if self.split and (parts := self.split.split(text))[1:]:  # special tokens stand at the odd places
                cut.append([w for k, x in enumerate(parts) for w in ([x] if k % 2 else find(x))])
            else:
                cut.append(find(text))
        if len(self.known) > KEPT_WORDS:  # what is not met again until the next time is forgotten
            self.known, self.older = dict(self.special), self.known
        self.known.update(self.special)
        new = set().union(*cut).difference(self.known)
        self.known.update((w, self.older[w]) for w in new.intersection(self.older))
        learnt = [w for w in new if w not in self.known]
        if learnt:
            ids, failed = self.merges.encode_words([w.encode() for w in learnt])
            self.known.update(zip(learnt, ids))
            self.proposals, self.merged = self.proposals + len(learnt), self.merged + failed
        coded = [b"".join(map(self.known.__getitem__, words)) for words in cut]
        for w in [w for w in new if len(w) > KEPT_LENGTH]:
            self.known.pop(w, None)
        return coded

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; unknown ids have none."""
        at = np.frombuffer(ids, "<u4").astype(np.int64)
        at = at[at < len(self.sizes)]
        sizes = self.sizes[at]
        begin = np.cumsum(sizes) - sizes
        where = np.repeat(self.starts[at] - begin, sizes) + np.arange(int(sizes.sum()))
        return self.content[where].tobytes().decode("utf-8", "replace")


def _check(spec: dict) -> None:
    """Refuse files with rules that are not built here."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    added = all(not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) for t in spec["added_tokens"])
    if not (plain and added and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")):
        raise ValueError("only byte-level BPE with the usual pattern, no normaliser and plain special tokens")


@functools.lru_cache(2)
def _codec(path: str, classes: tuple[str, str, str]) -> Codec:
    return Codec(path, classes)


def codec(vocabulary: str | None = None) -> Codec:
    """A codec of this process; ``vocabulary`` is the path of a tokenizer file, by default the public one."""
    path = vocabulary or public_vocabulary(VOCABULARY)
    return _codec(path, character_classes(path))


def _per_batch(vocabulary: str | None, classes: tuple[str, str, str], make):
    """``make(codec, batch)`` for slices of the rows (doc_id, content)."""

    def each(batches):
        own = _codec(vocabulary or public_vocabulary(VOCABULARY), classes)
        for batch in slices(batches, 1, SLICE):
            yield make(own, batch)

    return each


def _classes(vocabulary: str | None) -> tuple[str, str, str]:
    return character_classes(vocabulary or public_vocabulary(VOCABULARY))


def encode(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every whole text."""

    def make(own: Codec, batch):
        data = own.encode(texts(batch.column(1)))
        ends = np.cumsum([0] + [len(x) // 4 for x in data])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(data), "<i4")))
        return pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_per_batch(vocabulary, _classes(vocabulary), make), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, ids: str = "ids", doc_id: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """doc_id and the text of the ids; null ids give an empty text, null or unknown members none."""

    def make(own: Codec, batch):
        found = [own.decode(np.asarray([k for k in x or () if k is not None and k >= 0], "<u4").tobytes()) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "text"])

    def each(batches):
        own = _codec(vocabulary or public_vocabulary(VOCABULARY), classes)
        for batch in batches:
            yield make(own, batch)

    classes = _classes(vocabulary)
    rows = tokens.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<long>").alias("ids"))
    return rows.mapInArrow(each, "doc_id long, text string")


def round_trip(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of each whole text's ids and of what they decode to: encoded and decoded in one pass."""

    def make(own: Codec, batch):
        data = own.encode(texts(batch.column(1)))
        back = [hashlib.sha256(own.decode(x).encode()).hexdigest() for x in data]
        counts, sums = [len(x) // 4 for x in data], [hashlib.sha256(x).hexdigest() for x in data]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_per_batch(vocabulary, _classes(vocabulary), make), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
