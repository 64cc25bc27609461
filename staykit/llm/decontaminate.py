"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton recognises every run of words that occurs inside some item. Training words are streamed through it, which
gives at each word the length of the longest run ending there that an item contains. A window is ``window`` consecutive item
words, or a whole shorter item; where the matching length reaches a window, its words are hit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from staykit.llm.arrow import in_parts, map_arrow, with_bytes
from staykit.sources.tables import Workspace

WINDOW = 13
# Words of test items in one automaton. A larger benchmark is taken in blocks of this size, each a pass over the documents.
BLOCK_WORDS = 200_000
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Maximal runs of digits, ASCII letters (lower-cased) and everything beyond ASCII."""
    return text.translate(_WORD_BYTES).split()


class SuffixAutomaton:
    """Generalised suffix automaton over items, given as lists of words.

    States are numbered from the root 0. ``moves`` maps state * vocabulary size + word to a state; ``link`` is the suffix
    link; ``length`` the longest run a state stands for.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        coded = [(key, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for key, words in items]
        self.width = max(1, len(self.vocabulary))
        self.moves: dict[int, int] = {}
        self.link, self.length = [-1], [0]
        self._out: list[set[int]] = [set()]
        for _, words in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
        del self._out
        self._mark(coded)
        pairs = {(a * self.width + b) for _, words in coded for a, b in zip(words, words[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.shortest = min((min(len(words), window) for _, words in coded if words), default=window)

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append(set())
        return len(self.length) - 1

    def _move(self, state: int, word: int, to: int) -> None:
        self.moves[state * self.width + word] = to
        self._out[state].add(word)

    def _extend(self, last: int, word: int) -> int:
        moves, width = self.moves, self.width
        known = moves.get(last * width + word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0)
        state = last
        while state >= 0 and state * width + word not in moves:
            self._move(state, word, new)
            state = self.link[state]
        if state >= 0:
            target = moves[state * width + word]
            exact = self.length[target] == self.length[state] + 1
            self.link[new] = target if exact else self._split(state, word, target)
        return new

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` for the runs not longer than ``state`` plus a word."""
        copy = self._state(self.length[state] + 1, self.link[target])
        for w in self._out[target]:
            self._move(copy, w, self.moves[target * self.width + w])
        self.link[target] = copy
        while state >= 0 and self.moves.get(state * self.width + word) == target:
            self.moves[state * self.width + word] = copy
            state = self.link[state]
        return copy

    def _mark(self, coded) -> None:
        """For each state, what ends where it is reached: ``full`` is the state of the window itself, ``short`` the states
        of whole short items among its suffixes. Items are kept with the states of their windows only."""
        self.items: dict[int, set[int]] = {}
        ends: dict[int, int] = {}  # state -> length of the short item that ends there
        for key, words in coded:
            if not words:
                continue
            state = matched = 0
            for word in words:
                state = self.moves[state * self.width + word]
                matched += 1
                if matched >= self.window:
                    self.items.setdefault(self._suffix(state, self.window), set()).add(key)
            if matched < self.window:
                own = self._suffix(state, matched)
                ends[own] = matched
                self.items.setdefault(own, set()).add(key)
        self.short: dict[int, list[tuple[int, int]]] = {}  # state -> (length, state of the short item), longest first
        if ends:
            for state in range(len(self.length)):
                chain, at = [], state
                while at > 0:
                    if at in ends:
                        chain.append((ends[at], at))
                    at = self.link[at]
                if chain:
                    self.short[state] = chain

    def _suffix(self, state: int, length: int) -> int:
        """The state of the suffix of that length."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def stream(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans [begin, end) of the windows that occur in a run of words, and the items they belong to."""
        moves, link, length, width, window = self.moves, self.link, self.length, self.width, self.window
        spans, found, state, matched = [], set(), 0, 0
        for place, word in enumerate(words):
            to = moves.get(state * width + word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = moves.get(state * width + word)
            if to is None:
                matched = 0
                continue
            state, matched = to, matched + 1
            if matched >= window:
                spans.append((place + 1 - window, place + 1))
                found |= self.items.get(self._suffix(state, window), ())
            for size, own in self.short.get(state, ()):
                if size <= matched:
                    spans.append((place + 1 - size, place + 1))
                    found |= self.items[own]
        return spans, found


@dataclass
class Matcher:
    automaton: SuffixAutomaton

    def match(self, texts: list[bytes]):
        """Per text: number of words, spans, items. Only runs in which every two neighbours also stand side by side in some
        item, and that are as long as the shortest window, can hold one; only they are streamed."""
        automaton, code = self.automaton, self.automaton.vocabulary.get
        split = [words_of(t) for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        starts = np.concatenate([[0], np.cumsum(counts)])
        total = int(starts[-1])
        known = np.fromiter((code(w, -1) for words in split for w in words), np.int64, total)
        joined = np.zeros(max(total - 1, 0), dtype=bool)
        if total > 1 and len(automaton.pairs):
            both = np.flatnonzero((known[:-1] >= 0) & (known[1:] >= 0))
            pair = known[both] * automaton.width + known[both + 1]
            at = np.minimum(np.searchsorted(automaton.pairs, pair), len(automaton.pairs) - 1)
            joined[both] = automaton.pairs[at] == pair
        inner = starts[1:-1]
        joined[inner[(inner > 0) & (inner < total)] - 1] = False
        edges = np.flatnonzero(np.concatenate([[True], ~joined, [True]])) if total else np.array([0])
        begins, ends = edges[:-1], edges[1:]
        keep = (ends - begins >= automaton.shortest) & (known[np.minimum(begins, max(total - 1, 0))] >= 0) if total else []
        spans = [[] for _ in texts]
        items = [set() for _ in texts]
        for begin, end in zip(begins[keep].tolist(), ends[keep].tolist()):
            doc = int(np.searchsorted(starts, begin, side="right")) - 1
            offset = begin - int(starts[doc])
            found_spans, found = automaton.stream(known[begin:end].tolist())
            spans[doc] += [(a + offset, b + offset) for a, b in found_spans]
            items[doc] |= found
        return counts, [merged(s) for s in spans], items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans as one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def benchmark_blocks(
    benchmark: DataFrame, work: Workspace, key: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS
) -> list[Callable[[], list[tuple]]]:
    """The items in blocks of about ``block_words`` words: one function per block that brings its items to the driver.

    The number of blocks follows from the number of words; an item's block from a hash of its key and text. Rows with a
    NULL key are no items.
    """
    items = with_bytes(benchmark.where(F.col(key).isNotNull()).select(key, text), text)
    # A word and what separates it from the next take two bytes at least.
    total = items.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(1, -(-total // (2 * block_words)))
    if blocks > 1:
        items = work.store(items.withColumn("_block", F.pmod(F.xxhash64(key, "_text"), F.lit(blocks))), "items")

    def block(number: int):
        rows = items.where(F.col("_block") == number) if blocks > 1 else items
        return lambda: [(r[0], words_of(bytes(r[1]))) for r in rows.select(key, "_text").collect()]

    return [block(number) for number in range(blocks)]


def match_benchmark(
    docs: DataFrame, benchmark: DataFrame, work: Workspace, window: int = WINDOW, text: str = "text",
    item_key: str = "item_id", block_words: int = BLOCK_WORDS, keep_text: bool = False,
) -> DataFrame:
    """``docs`` with n_words, n_hit, ``spans`` (array of begin and end word numbers, merged) and ``items`` (sorted keys).

    Columns of these names give way; the text itself is only returned with ``keep_text``. Words are compared lower-cased
    over A-Z. NULL or empty texts have no words. Repeated documents each get a row; an empty benchmark hits nothing.
    Documents are only mapped, never shuffled: one pass for each block of the benchmark, whose automaton, bounded by
    ``block_words``, is broadcast; spans of earlier blocks travel with their document.
    """
    made = ("n_words", "n_hit", "spans", "items")
    others = [c for c in docs.columns if c not in (*made, text)]
    item_kind = benchmark.schema[item_key].dataType.simpleString()
    shape = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    result = f"n_words long, spans array<struct<begin:long,end:long>>, items array<{item_kind}>"
    rows = with_bytes(docs.select(*others, text), text)
    blocks = benchmark_blocks(benchmark, work, item_key, block_words=block_words)
    for number, block in enumerate(blocks):
        last, width = number == len(blocks) - 1, len(others)
        shared = docs.sparkSession.sparkContext.broadcast(SuffixAutomaton(block(), window))
        carry = not last or keep_text

        def step(batches, shared=shared, first=number == 0, carry=carry):
            matcher = Matcher(shared.value)
            for batch in in_parts(batches):
                texts = batch.column(width)
                counts, spans, items = matcher.match([v or b"" for v in texts.to_pylist()])
                if not first:
                    before = batch.column(width + 2).to_pylist(), batch.column(width + 3).to_pylist()
                    spans = [merged(s + [(x["begin"], x["end"]) for x in b]) for s, b in zip(spans, before[0])]
                    items = [i | set(b) for i, b in zip(items, before[1])]
                yield {
                    **{c: batch.column(i) for i, c in enumerate(others)}, **({"_text": texts} if carry else {}),
                    "n_words": counts, "spans": [[{"begin": a, "end": b} for a, b in s] for s in spans],
                    "items": [sorted(i) for i in items],
                }

        columns = ", ".join(c for c in (shape, "_text binary" if carry else "", result) if c)
        rows = map_arrow(rows, step, columns)
        if not last:
            rows = work.store(rows, "block")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"])
    texts = [F.col("_text").cast("string").alias(text)] if keep_text else []
    return rows.select(*others, *texts, "n_words", hit.alias("n_hit"), "spans", "items")


def contaminated(n_words: Column, n_hit: Column, per_mille: int = 50) -> Column:
    """At least that share of the words is hit."""
    return (n_hit > 0) & (1000 * n_hit >= per_mille * n_words)


def cut_spans(matched: DataFrame, max_words: int = WINDOW - 1, per_mille: int = 50, text: str = "text") -> DataFrame:
    """Rows of ``match_benchmark(keep_text=True)`` without spans of more than ``max_words`` hit words, and without any hit
    span where the hit share reaches ``per_mille``.

    What stood between the words goes with a removed span up to its last word. Rows are kept, empty texts included.
    """
    everything = contaminated(F.col("n_words"), F.col("n_hit"), per_mille)
    gone = F.filter("spans", lambda s: everything | (s["end"] - s["begin"] > max_words))
    rows = with_bytes(matched.withColumn("_gone", gone), text)
    others = [c for c in matched.columns if c != text]
    shape = ", ".join(f"`{c}` {matched.schema[c].dataType.simpleString()}" for c in others)

    def step(batches):
        for batch in batches:
            texts, spans = batch.column(len(others)).to_pylist(), batch.column(len(others) + 1).to_pylist()
            out = [without(t, [(x["begin"], x["end"]) for x in s]) if s else t for t, s in zip(texts, spans)]
            yield {**{c: batch.column(i) for i, c in enumerate(others)}, "_text": out}

    cut = map_arrow(rows.select(*others, "_text", "_gone"), step, f"{shape}, _text binary")
    return cut.withColumn(text, F.col("_text").cast("string")).select(*matched.columns)


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of some spans."""
    inside = np.frombuffer(text.translate(_WORD_BYTES), dtype=np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    begins, ends = edge[::2], edge[1::2]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:begins[a]])
        at = int(ends[b - 1])
    return b"".join([*out, text[at:]])
