"""BPE encoding and decoding with a pair occurrence index.

The distinct new words of a block of documents are laid out in one array of symbols. An index maps
each mergeable pair to all its positions; the active ranks are applied in ascending order, each to
all its positions at once, and only the lists of pairs that a merge created are updated. What a
word was encoded to is kept, so a word costs its merges once per task and a lookup after that.

The vocabulary is one of the public tokenizer files, read from its path in every task.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Characters of text that are encoded together, and encoded words that are kept; both bound memory.
BLOCK_CHARS, KEPT_WORDS = 1 << 21, 1 << 18
# str.split() also splits at these four, which the vocabulary's pattern does not
_NOT_SPACE = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\p{White_Space}+")


def _byte_letters() -> list[str]:
    """The visible character that stands for each byte: printable Latin-1 for itself, the rest from
    U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(shown))
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class PairIndex:
    """Merges of a vocabulary, applied to many words at once."""

    def __init__(self, symbols: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        letters = _byte_letters()
        self.inner = np.array([symbols[c] for c in letters], np.int32)
        self.last = np.array([symbols[c + suffix] for c in letters], np.int32)
        self.base = max(symbols.values()) + 1
        left = np.array([symbols[a] for a, _ in merges], np.int64)
        right = np.array([symbols[b] for _, b in merges], np.int64)
        made = np.array([symbols[a + b] for a, b in merges], np.int64)
        self.left, self.right, self.made = left, right, made
        keys = left * self.base + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        # one ascending pass is exact only if no merge uses a symbol that a later one makes
        born = np.full(self.base, -1, np.int64)
        born[made[::-1]] = np.arange(len(made))[::-1]
        rank = np.arange(len(made))
        if len(set(made.tolist())) != len(made) or (born[left] >= rank).any() or (born[right] >= rank).any():
            raise ValueError("the merges of this vocabulary are not in the order in which their symbols arise")

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it does not merge."""
        wanted = a.astype(np.int64) * self.base + b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], -1)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (not empty), as little-endian unsigned 32-bit integers."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        n = len(symbol)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = n
        before[ends - sizes] = -1

        pairs = np.flatnonzero(after < n)
        rank = self.ranks(symbol[pairs], symbol[pairs + 1])
        pairs, rank = pairs[rank >= 0], rank[rank >= 0]
        by_rank = np.argsort(rank, kind="stable")
        pairs, rank = pairs[by_rank], rank[by_rank]
        starts = np.flatnonzero(np.diff(rank, prepend=-1))
        index = {int(rank[s]): [pairs[s:e]] for s, e in zip(starts, [*starts[1:], len(rank)])}
        active = list(index)  # ascending, so a heap
        while active:
            r = heapq.heappop(active)
            found = index.pop(r)
            at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            a, b = self.left[r], self.right[r]
            at = at[symbol[at] == a]
            at = at[after[at] < n]
            at = at[symbol[after[at]] == b]
            if a == b and len(at) > 1:
                at = self._apart(at, after)
            if not len(at):
                continue
            gone = after[at]
            symbol[at] = self.made[r]
            symbol[gone] = -1
            following = after[gone]
            after[at] = following
            inside = following < n
            before[following[inside]] = at[inside]
            # the pairs to both sides of a merged symbol are new
            changed = np.concatenate([at[inside], before[at][before[at] >= 0]])
            new = self.ranks(symbol[changed], symbol[after[changed]])
            changed, new = changed[new >= 0], new[new >= 0]
            if len(new):
                order = np.argsort(new, kind="stable")
                changed, new = changed[order], new[order]
                starts = np.flatnonzero(np.diff(new, prepend=-1))
                for s, e in zip(starts, [*starts[1:], len(new)]):
                    to = int(new[s])
                    if to not in index:
                        index[to] = []
                        heapq.heappush(active, to)
                    index[to].append(changed[s:e])
        kept = symbol >= 0
        ids = symbol[kept].astype("<u4").tobytes()
        cuts = np.cumsum(kept)[ends - 1] * 4
        return [ids[s:e] for s, e in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

    @staticmethod
    def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of a symbol repeated in a row, every other pair from the left."""
        run_goes_on = np.concatenate([[False], after[at[:-1]] == at[1:]])
        starts = np.flatnonzero(~run_goes_on)
        place = np.arange(len(at)) - np.repeat(starts, np.diff([*starts, len(at)]))
        return at[place % 2 == 0]


class Tokenizer:
    """Encoder and decoder for a public vocabulary with word ends.

    ``special``: whether the special tokens' strings in a text become their ids, or are plain text.
    """

    def __init__(self, path: str, special: bool = True) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.merger = PairIndex(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        self.special = {t["content"]: int(t["id"]) for t in spec["added_tokens"]}
        self.shown = {i: s for s, i in (model["vocab"] | self.special).items()}
        named = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile(f"({named})") if special and named else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.piece = regex.compile(split["pattern"]["Regex"])
        # what the last blocks used, and what was used before that
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _normal(self, text: str) -> list[str]:
        """Chunks between white space, in normal form C and lower case."""
        if not text.isascii():
            # lower() would pick the final sigma by context
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        if _NOT_SPACE.search(text):
            return _SPACE.split(text.lower())
        return text.lower().split()

    def _segments(self, text: str) -> list[list[str] | int]:
        if self.cut is None or "<|" not in text:
            return [self._normal(text)]
        parts = self.cut.split(text)
        return [self.special[p] if i % 2 else self._normal(p) for i, p in enumerate(parts)]

    def _learn(self, chunks: set[str]) -> None:
        """Encode chunks that are not known yet, all their words in one index.

        When half of what may be kept is in use, it becomes the older half; what is used again
        moves on, and the rest is dropped at the next turn.
        """
        if len(self.known) > KEPT_WORDS // 2:
            self.older, self.known = self.known, {}
        new = chunks - self.known.keys()
        again = new & self.older.keys()
        self.known.update((c, self.older[c]) for c in again)
        new -= again
        pieces = {c: tuple(self.piece.findall(c)) for c in new}
        words = list(set().union(*pieces.values()))
        ids = {}
        if words:
            ids = dict(zip(words, self.merger.encode([w.encode("utf-8", "surrogatepass") for w in words])))
        for c, found in pieces.items():
            self.known[c] = ids[found[0]] if len(found) == 1 else b"".join([ids[p] for p in found])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        segments = [self._segments(t) for t in texts]
        chunks: set[str] = set()
        for s in segments:
            chunks.update(*[part for part in s if not isinstance(part, int)])
        self._learn(chunks)
        known = self.known.__getitem__
        return [
            b"".join([part.to_bytes(4, "little") if isinstance(part, int) else b"".join(map(known, part)) for part in s])
            for s in segments
        ]

    def decode(self, ids: bytes) -> str:
        """The tokens as this vocabulary shows them, with spaces between; unknown ids show nothing."""
        shown = self.shown
        return " ".join([shown[i] for i in np.frombuffer(ids, "<u4").tolist() if i in shown])


@lru_cache(maxsize=2)
def tokenizer(path: str, special: bool = True) -> Tokenizer:
    """One per Python worker."""
    return Tokenizer(path, special)


def in_blocks(batches: Iterator[pa.RecordBatch], chars: int = BLOCK_CHARS) -> Iterator[tuple[pa.Array, list[str]]]:
    """(keys, texts) of about ``chars`` characters; a longer text is a block of its own. Null is ""."""
    for batch in batches:
        texts = [t.as_py() or "" for t in batch.column(1)]
        start = size = 0
        for i, t in enumerate(texts):
            if i > start and size + len(t) > chars:
                yield batch.column(0).slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(t)
        if texts:
            yield batch.column(0).slice(start), texts[start:]


def mapped(
    docs: DataFrame, key: str, text: str, columns: dict[str, str], rows: Callable[[Tokenizer, list[str]], list[list]], vocabulary: str
) -> DataFrame:
    """Key and ``columns`` (name -> type) that ``rows`` makes of a block of texts, one list per column."""
    types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in in_blocks(batches):
            made = rows(tokenizer(vocabulary), texts)
            arrays = [pa.array(values, types[kind]) for values, kind in zip(made, columns.values())]
            yield pa.RecordBatch.from_arrays([keys, *arrays], [key, *columns])

    kind = docs.schema[key].dataType.simpleString()
    schema = ", ".join([f"`{key}` {kind}", *[f"{name} {kind}" for name, kind in columns.items()]])
    return docs.select(key, text).mapInArrow(run, schema)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per row of ``docs``: key and ``ids``, the token ids of the whole text.

    Special tokens' strings in a text become their ids. A null or empty text has no ids; a null key
    stays; repeated rows give repeated rows; rows are encoded on their own, without a shuffle. Only
    ``key`` and ``text`` are read, so other columns may have any name.
    """

    def rows(tok: Tokenizer, texts: list[str]) -> list[list]:
        return [[np.frombuffer(ids, "<u4").astype(np.int32) for ids in tok.encode(texts)]]

    return mapped(docs, key, text, {"ids": "array<int>"}, rows, vocabulary)


def decode(tokens: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per row of ``tokens``: key and ``text``, the decoded ids; null ids give ""."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocabulary)
        for batch in batches:
            texts = [tok.decode(np.array(x.as_py() or [], "<u4").tobytes()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    return tokens.select(key, ids).mapInArrow(run, f"`{key}` {tokens.schema[key].dataType.simpleString()}, text string")


def round_trip(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, with_ids: bool = False
) -> DataFrame:
    """One row per row of ``docs``: key, n_tokens, and the SHA-256 of the ids (as little-endian unsigned
    32-bit integers) and of the decoded text (UTF-8); ``with_ids`` adds the ids. Nulls and repeats as in ``encode``."""

    def rows(tok: Tokenizer, texts: list[str]) -> list[list]:
        ids = tok.encode(texts)
        return [
            [len(i) // 4 for i in ids],
            [hashlib.sha256(i).hexdigest() for i in ids],
            [hashlib.sha256(tok.decode(i).encode()).hexdigest() for i in ids],
            *([[np.frombuffer(i, "<u4").astype(np.int32) for i in ids]] if with_ids else []),
        ]

    columns = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"} | ({"ids": "array<int>"} if with_ids else {})
    return mapped(docs, key, text, columns, rows, vocabulary)
