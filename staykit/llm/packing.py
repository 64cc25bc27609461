"""Hierarchical packing of documents into training windows of several lengths.

Whole windows of the longest length are cut off a document's front; what remains is routed to the shortest tier that holds
it. Tiers are packed from the longest to the shortest: a window is opened with a piece of its own tier, its gap is filled
with the largest pieces of shorter tiers that fit, and the last one is cut to size. So windows come out full, and each tier
keeps documents of about its own length. Sequences of a tier are then dealt to step groups of the same number of tokens and
about the same attention cost.

Tasks pack the documents they read; nothing is shuffled but what a task has left at its end, less than a window or two,
which a second round packs, and a few numbers per sequence.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import deque
from functools import lru_cache
import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
import regex

from staykit.llm.arrow import map_arrow
from staykit.llm.tokens import WORD_PATTERN, byte_letters
from staykit.operators.ranking import exact_rank
from staykit.sources.tables import Workspace

TIERS = (256, 512, 1024, 2048)
END_ID = 1
# Tokens of one step group.
STEP_TOKENS = 32_768
# Tokens that wait in a task before they are packed, and tokens that the second round gives one task.
WAITING_TOKENS = 2_000_000
ROUND_TOKENS = 4_000_000
# Longer texts are encoded in parts of about this size.
PART_CHARS = 100_000
# Numbers of sequences of the second round start here; below it, a task's sequences start at its number times 2**32.
_SECOND = 1 << 60

# A lone space starts the word behind it, so a text can be encoded in two parts there.
_LONE_SPACE = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")


class Encoder:
    """Token ids of texts as ``tokenizers`` gives them for a vocabulary file, special strings inside texts as its default.

    Where ``same_by_rank`` holds, ids come from ``tiktoken`` over the file's own vocabulary, which is four times as fast;
    otherwise from ``tokenizers`` itself.
    """

    def __init__(self, path: str, by_rank: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        if by_rank:
            import tiktoken

            letters, stored = byte_letters(), _stored(path)
            special = {t["content"]: t["id"] for t in stored["added_tokens"]}
            ranks = {bytes(letters[c] for c in t): i for t, i in stored["model"]["vocab"].items() if t not in special}
            found = tiktoken.Encoding("file", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self._ids = lambda text: found.encode_to_numpy(text, allowed_special="all")
        else:
            library = _library(path)
            self._ids = lambda text: np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text; a long one is taken in parts, cut at lone spaces."""
        found, begin = [], 0
        while begin < len(text):
            cut = _LONE_SPACE.search(text, begin + PART_CHARS) if len(text) - begin > PART_CHARS else None
            end = cut.start() if cut else len(text)
            found.append(self._ids(text[begin:end]))
            begin = end
        return np.concatenate(found) if found else np.zeros(0, np.uint32)


def _stored(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _library(path: str):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return library


def same_by_rank(path: str) -> bool:
    """Whether merging the adjacent pair whose joined bytes have the lowest id gives what the file's merge list gives.

    It does if the merges are listed in the order of the ids they make, and each token, encoded alone, is that one token:
    as long as nothing has been merged across the edges of a token's bytes, merges inside them go as they do for the token
    alone, where two symbols are left just once, the pair the list names. So no other pair of that token ever stands side
    by side. The words must also be cut the same way.
    """
    stored, library = _stored(path), _library(path)
    model, cutter = stored["model"], stored["pre_tokenizer"] or {}
    if model["type"] != "BPE" or stored["normalizer"] or cutter.get("type") != "ByteLevel" or not cutter.get("use_regex", True):
        return False
    if cutter.get("add_prefix_space") or model.get("ignore_merges") or any(model.get(k) for k in ("dropout", "byte_fallback")):
        return False
    vocab, special = model["vocab"], {t["content"] for t in stored["added_tokens"]}
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    tokens = [t for t in vocab if t not in special]
    alone = all(len(found := library.model.tokenize(t)) == 1 and found[0].id == vocab[t] for t in tokens)
    return made == sorted(made) and alone and not any(" " in t for t in special)


@lru_cache(maxsize=1)
def _encoder(path: str, by_rank: bool) -> Encoder:
    return Encoder(path, by_rank)


class Piece:
    """Consecutive tokens of one document."""

    __slots__ = ("doc", "start", "ids", "doc_tokens")

    def __init__(self, doc, start: int, ids: np.ndarray, doc_tokens: int):
        self.doc, self.start, self.ids, self.doc_tokens = doc, start, ids, doc_tokens

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, self.ids[:length], self.doc_tokens),
            Piece(self.doc, self.start + length, self.ids[length:], self.doc_tokens),
        )


class Pool:
    """Pieces waiting for a window, by size; those of one size first come, first served."""

    def __init__(self):
        self.sizes: list[int] = []
        self.waiting: dict[int, deque[Piece]] = {}

    def add(self, piece: Piece) -> None:
        size = len(piece.ids)
        if size not in self.waiting:
            insort(self.sizes, size)
            self.waiting[size] = deque()
        self.waiting[size].append(piece)

    def _take(self, place: int) -> Piece:
        size = self.sizes[place]
        piece = self.waiting[size].popleft()
        if not self.waiting[size]:
            del self.waiting[size], self.sizes[place]
        return piece

    def largest(self, at_most: int, above: int = 0) -> Piece | None:
        """The largest piece of more than ``above`` and no more than ``at_most`` tokens."""
        place = bisect_right(self.sizes, at_most) - 1
        return self._take(place) if place >= 0 and self.sizes[place] > above else None

    def smallest(self) -> Piece | None:
        return self._take(0) if self.sizes else None

    def rest(self) -> list[Piece]:
        return [self._take(0) for _ in range(sum(map(len, self.waiting.values())))]


class Packer:
    """Packs the documents of one task. ``done`` holds rows (piece, sequence, offset, tier) of sequences that are full."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, first: int = 0):
        self.tiers, self.pool, self.next, self.done = sorted(tiers), Pool(), first, []

    def add(self, piece: Piece) -> None:
        longest = self.tiers[-1]
        while len(piece.ids) > longest:
            whole, piece = piece.cut(longest)
            self._close([whole], longest)
        self._close([piece], longest) if len(piece.ids) == longest else self.pool.add(piece)

    def _close(self, pieces: list[Piece], tier: int) -> None:
        offset = 0
        for piece in pieces:
            self.done.append((piece, self.next, offset, tier))
            offset += len(piece.ids)
        self.next += 1

    def drain(self) -> None:
        """Packs what waits, tier by tier from the longest, as far as windows come out full."""
        for tier, below in zip(reversed(self.tiers), [*reversed(self.tiers[:-1]), 0]):
            while (opening := self.pool.largest(tier, below)) is not None:
                pieces, gap = [opening], tier - len(opening.ids)
                while gap:
                    piece = self.pool.largest(gap)
                    if piece is None:
                        piece = self.pool.smallest()
                        if piece is None:
                            break
                        piece, rest = piece.cut(gap)
                        self.pool.add(rest)
                    pieces.append(piece)
                    gap -= len(piece.ids)
                if gap:  # nothing else waits, in any tier
                    for piece in pieces:
                        self.pool.add(piece)
                    return
                self._close(pieces, tier)

    def finish(self) -> None:
        """Whatever is left becomes one last sequence, shorter than the longest tier."""
        self.drain()
        rest = self.pool.rest()
        if rest:
            self._close(rest, self.tiers[-1])


_PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, ids binary"
)


def _rows(key: str, kind: pa.DataType, placed: list[tuple], waiting: list[Piece] = ()) -> dict:
    """Columns for placed pieces, without their ids, and for those that still wait, with them."""
    pieces = [p[0] for p in placed] + list(waiting)
    data = [p.ids.astype("<u4").tobytes() for p in pieces]
    none = [None] * len(waiting)
    return {
        key: pa.array([p.doc for p in pieces], kind),
        "start": [p.start for p in pieces], "length": [len(p.ids) for p in pieces], "ids_crc32": [zlib.crc32(d) for d in data],
        "doc_tokens": [p.doc_tokens for p in pieces], "sequence_id": [p[1] for p in placed] + none,
        "offset": [p[2] for p in placed] + none, "tier": [p[3] for p in placed] + none,
        "ids": [None] * len(placed) + data[len(placed):],
    }


def pack_tasks(docs: DataFrame, vocabulary: str, tiers=TIERS, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """First round: pieces of full sequences, and what each task has left (sequence_id NULL) with its ids."""
    by_rank = same_by_rank(vocabulary)

    def step(batches):
        encoder, packer, kind = _encoder(vocabulary, by_rank), Packer(tiers, TaskContext.get().partitionId() << 32), None
        for batch in batches:
            kind, waiting = batch.column(0).type, 0
            for doc, found in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.encode(found.as_py() or ""), np.uint32(end_id))
                packer.add(Piece(doc, 0, ids, len(ids)))
                waiting += len(ids)
                if waiting > WAITING_TOKENS:
                    packer.drain()
                    yield _rows(key, kind, packer.done)
                    packer.done, waiting = [], 0
        if kind is not None:
            packer.drain()
            yield _rows(key, kind, packer.done, packer.pool.rest())

    return map_arrow(docs.select(key, text), step, f"`{key}` {docs.schema[key].dataType.simpleString()}, {_PIECES}")


def pack_rest(rest: DataFrame, tiers=TIERS, key: str = "doc_id") -> DataFrame:
    """Second round: what tasks had left, packed to the end; the last sequence of a task may be shorter than its tier."""

    def step(batches):
        packer, kind = Packer(tiers, _SECOND + (TaskContext.get().partitionId() << 32)), None
        for batch in batches:
            kind = batch.column(0).type
            for doc, start, ids, total in zip(*(batch.column(i).to_pylist() for i in range(4))):
                packer.add(Piece(doc, start, np.frombuffer(ids, "<u4"), total))
            packer.drain()
            yield _rows(key, kind, packer.done)
            packer.done = []
        if kind is not None:
            packer.finish()
            yield _rows(key, kind, packer.done)

    made = f"`{key}` {rest.schema[key].dataType.simpleString()}, {_PIECES}"
    return map_arrow(rest.select(key, "start", "ids", "doc_tokens"), step, made).drop("ids")


def balance_steps(pieces: DataFrame, work: Workspace, tiers=TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """``sequence_id`` and ``step_id`` of each sequence: groups of ``step_tokens`` tokens, all of one tier.

    Within a tier the sequences, by falling attention cost (sum of squared piece lengths), are dealt to its groups there
    and back, so groups differ by at most one sequence and cost about the same. Groups are numbered from 0 over the tiers.
    """
    length = F.col("length")
    sequences = pieces.groupBy("sequence_id").agg(F.max("tier").alias("tier"), F.sum(length * length).alias("cost"))
    sequences = work.store(sequences, "sequences")
    ranked = exact_rank(sequences, [F.col("tier"), F.col("cost").desc(), F.col("sequence_id")], work, "place")
    counts = {r["tier"]: r["count"] for r in sequences.groupBy("tier").count().collect()}  # one row per tier
    step, before, groups_before = F.lit(None).cast("long"), 0, 0
    for tier in sorted(counts):
        groups = -(-counts[tier] // max(1, step_tokens // tier))
        place = F.col("place") - 1 - before
        turn, at = F.floor(place / groups), F.pmod(place, F.lit(groups))
        dealt = F.when(turn % 2 == 0, at).otherwise(groups - 1 - at) + groups_before
        step = F.when(F.col("tier") == tier, dealt).otherwise(step)
        before, groups_before = before + counts[tier], groups_before + groups
    return ranked.select("sequence_id", step.cast("long").alias("step_id"))


def pack(
    docs: DataFrame, vocabulary: str, work: Workspace, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID,
    step_tokens: int = STEP_TOKENS, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The pieces of all documents: ``key``, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier and step_id.

    A document is its text's ids and ``end_id``; every id lies in exactly one piece. ``tiers`` are powers of two; each
    sequence is full for its tier, except the last one of each task of the second round, which is to be padded to the
    longest. ``vocabulary`` is the path of a ``tokenizers`` file that executors can open.

    A NULL or empty text is its end id alone. Repeated rows and rows without a key are packed each. A very long text is
    encoded in parts and cut into windows. Other columns are ignored, so their names do not matter. No documents, no rows.
    The first round is written before anything is built on it, so a lost executor cannot mix two packings.
    """
    first = work.store(pack_tasks(docs, vocabulary, tiers, end_id, key, text), "packed")
    waiting = first.where("sequence_id is null")
    left = waiting.agg(F.sum("length")).first()[0] or 0
    # Dealt by document and start, so that a repeated task gets the same rows; sorted, so that it packs them alike.
    dealt = waiting.repartition(-(-left // ROUND_TOKENS) or 1, key, "start").sortWithinPartitions(key, "start", "ids_crc32")
    second = work.store(pack_rest(dealt, tiers, key), "rest")
    pieces = first.where("sequence_id is not null").drop("ids").unionByName(second)
    return pieces.join(balance_steps(pieces, work, tiers, step_tokens), "sequence_id").select(
        key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_id"
    )
