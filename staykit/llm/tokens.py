"""Token counts by byte-pair merging with a heap and a linked list.

A word's symbols are a doubly linked list of its bytes. The adjacent pairs wait in a heap by rank; the lowest is popped,
checked to be still there, merged, and its new neighbours are pushed. A word has as many tokens as symbols minus merges.
Ranks are all that is needed, so no token identifier is ever produced.
"""

from __future__ import annotations

from functools import lru_cache
import heapq
import json

import numpy as np
import regex
from pyspark.sql import DataFrame

from staykit.llm.arrow import map_arrow

# How the vocabulary file cuts text into words. White space is Unicode's White_Space property.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# Words whose count one Python worker remembers; forgotten all at once when full.
REMEMBERED_WORDS = 300_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable Latin-1 characters for themselves, the other
    bytes in order for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    for place, b in enumerate(b for b in range(256) if b not in set(plain)):
        letters[chr(256 + place)] = b
    return letters


class MergeRanks:
    """Merge ranks of a byte-level vocabulary file. Symbols are small integers; 0 to 255 are the bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        symbols = dict(byte_letters())
        self.ranks: dict[tuple[int, int], int] = {}  # of a pair of symbols
        self.merged: list[int] = []  # symbol that a rank's pair becomes
        for rank, pair in enumerate(stored["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[symbols[left], symbols[right]] = rank
            self.merged.append(symbols.setdefault(left + right, len(symbols)))
        self.special = [t["content"] for t in stored["added_tokens"]]

    def count(self, word: bytes) -> int:
        """Tokens of one word."""
        count = len(word)
        if count == 1:
            return 1
        rank_of, symbols, end = self.ranks.get, list(word), len(word)
        # A heap entry is rank * 2**32 + place of the left symbol: the lowest rank first, the leftmost on ties.
        heap = [
            rank << 32 | i for i, rank in enumerate(map(rank_of, zip(symbols, symbols[1:]))) if rank is not None
        ]
        if not heap:
            return count
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        following, before = list(range(1, end + 1)), list(range(-1, end - 1))
        while heap:
            lowest = pop(heap)
            i, rank = lowest & 0xFFFFFFFF, lowest >> 32
            j = following[i]
            # Merged-away places hold no symbol, so an outdated pair has another rank or none.
            if j >= end or rank_of((symbols[i], symbols[j])) != rank:
                continue
            merged = symbols[i] = self.merged[rank]
            symbols[j] = -1
            count -= 1
            after = following[i] = following[j]
            if after < end:
                before[after] = i
                found = rank_of((merged, symbols[after]))
                if found is not None:
                    push(heap, found << 32 | i)
            previous = before[i]
            if previous >= 0:
                found = rank_of((symbols[previous], merged))
                if found is not None:
                    push(heap, found << 32 | previous)
        return count


class _Remembered(dict):
    """Counts by word; asks ``count`` for a word it does not hold."""

    def __init__(self, count):
        super().__init__()
        self._count = count

    def __missing__(self, word):
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        found = self[word] = self._count(word)
        return found


# Where a text can be cut: a lone space is always the first character of the word behind it.
_LONE_SPACE = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
_EDGE_SPACE = regex.compile(r"^\p{White_Space}|\p{White_Space}$")
# Stands for a chunk that is empty or has white space at an edge; it turns the sum of a text negative.
_NOT_ALONE = -(2**60)


class TokenCounter:
    """Counts of whole texts. Words, and what stands between two lone spaces, are counted once and remembered."""

    def __init__(self, path: str):
        self.ranks = MergeRanks(path)
        self.pattern = regex.compile(WORD_PATTERN)
        # Special strings inside a text count as one token each and cut it, as the vocabulary's library does by default.
        self.special = regex.compile("|".join(regex.escape(s) for s in self.ranks.special) or r"(?!)")
        self.words = _Remembered(lambda word: self.ranks.count(word.encode()))
        self.chunks = _Remembered(
            lambda chunk: self._words(" " + chunk) if chunk and not _EDGE_SPACE.search(chunk) else _NOT_ALONE
        )

    def count(self, text: str) -> int:
        if not text:
            return 0
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(self._piece(piece) for piece in pieces if piece)

    def _piece(self, text: str) -> int:
        chunks = text.split(" ")
        total = self._words(chunks[0]) + sum(map(self.chunks.__getitem__, chunks[1:]))
        if total < 0 or not chunks[0] or _EDGE_SPACE.search(chunks[0]):
            total = sum(self._words(c if i == 0 else " " + c) for i, c in enumerate(_LONE_SPACE.split(text)))
        return total

    def _words(self, text: str) -> int:
        return sum(map(self.words.__getitem__, self.pattern.findall(text)))


@lru_cache(maxsize=2)
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every whole text.

    ``vocabulary`` is the path of a byte-level file that executors can open. A NULL or empty text has 0 bytes and 0 tokens;
    repeated rows are counted each; NULL keys are kept; other columns are ignored. Memory is one batch of texts plus the
    bounded word memory, whatever the length of the corpus; nothing is shuffled.
    """

    def step(batches):
        counter = _counter(vocabulary)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            counts = np.fromiter((counter.count(t or "") for t in texts), np.int64, len(texts))
            sizes = np.fromiter((len((t or "").encode()) for t in texts), np.int64, len(texts))
            yield {key: keys, "n_bytes": sizes, "n_tokens": counts, "over_limit": counts > limit}

    kind = docs.schema[key].dataType.simpleString()
    return map_arrow(docs.select(key, text), step, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
