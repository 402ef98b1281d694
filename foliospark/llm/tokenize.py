"""Problem 6: byte-level BPE over a whole corpus in numpy.

A text is cut into chunks and those into pieces by the vocabulary's published pattern. Pieces not met before by a worker are encoded
together: sorted by length into buckets, each bucket one padded matrix of token ids with a row per piece. Every round
all rows look their neighbouring pairs up in a hash table of merges, each row merges its leftmost pair of minimum rank,
and the matrix is compacted; rows without a merge leave it.

Defined cases: a null and an empty text get an empty list; a lone surrogate cannot occur in a Spark string; strings of
special tokens are ordinary text; a row given twice comes out twice.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: The published pre-tokenisation pattern of the byte-level vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries of a worker's memo of encoded chunks; when full it starts afresh, which changes no result.
MEMO_CHUNKS = 300_000
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)").split
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable Latin-1 stays itself, the
    other bytes follow from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in keep else next(rest)) for b in range(256)]


class PairTable:
    """Open-addressing hash table from a pair of ids to (rank, merged id), probed for whole arrays at a time."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(len(left) * 4).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.rank = np.full(size, NONE, np.int32)
        self.merged = np.zeros(size, np.int32)
        self.probes = 1
        keys = (left.astype(np.int64) << 20) | right.astype(np.int64)
        rest, at = np.arange(len(keys)), self.slot(keys)
        while len(rest):
            free = self.keys[at] < 0
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            first = first[free[first]]
            got = rest[first]
            self.keys[at[first]] = keys[got]
            self.rank[at[first]] = got
            self.merged[at[first]] = merged[got]
            left_over = np.ones(len(rest), bool)
            left_over[first] = False
            rest, at = rest[left_over], (at[left_over] + 1) & (size - 1)
            self.probes += bool(len(rest))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slots of the pairs, -1 where there is no such pair. A negative id is padding and pairs with nothing."""
        keys = (left.astype(np.int64) << 20) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        at = self.slot(keys)
        out = np.full(keys.shape, -1, np.int64)
        open_ = np.ones(keys.shape, bool)
        for _ in range(self.probes):
            seen = self.keys[at]
            hit = open_ & (seen == keys)
            out[hit] = at[hit]
            open_ &= ~hit & (seen != -1)
            if not open_.any():
                break
            at = (at + 1) & (len(self.keys) - 1)
        return out


class Spans:
    """Id lists by key, kept one after another in one array."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.used = np.zeros(4096, np.int32), 0
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)

    def add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self.index), self.used
        self.flat = room(self.flat, m + len(ids))
        self.start, self.size = room(self.start, n + len(keys)), room(self.size, n + len(keys))
        self.flat[m : m + len(ids)] = ids
        self.size[n : n + len(keys)] = sizes
        self.start[n : n + len(keys)] = m + np.cumsum(sizes) - sizes
        self.used = m + len(ids)
        self.index.update(zip(keys, range(n, n + len(keys))))

    def gather(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size, start = self.size[index], self.start[index]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(start - (ends - size), size)]
        return ids, np.concatenate([np.zeros(1, np.int64), ends])


def room(a: np.ndarray, size: int) -> np.ndarray:
    return a if size <= len(a) else np.concatenate([a, np.zeros(max(size, 2 * len(a)) - len(a), a.dtype)])


class ByteBpe:
    def __init__(self, path: str):
        import regex

        model = json.loads(open(path, encoding="utf-8").read())["model"]
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        col = lambda f: np.fromiter((f(a, b) for a, b in pairs), np.int32, len(pairs))
        self.table = PairTable(col(lambda a, b: vocab[a]), col(lambda a, b: vocab[b]), col(lambda a, b: vocab[a + b]))
        self.byte_id = np.array([vocab[c] for c in byte_letters()], np.int32)
        self.findall = regex.compile(PATTERN).findall
        self.forget()

    def forget(self) -> None:
        self.pieces = Spans()
        self.chunks = Spans()
        self.spaced: dict[str, int] = {}
        self.plain: dict[str, int] = {}

    def merge(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """rows: ids padded with -1 on the right. The rows fully merged, and their lengths."""
        n, width = rows.shape
        length = (rows >= 0).sum(1)
        alive = np.arange(n)
        work = rows.copy()
        slots = self.table.find(work[:, :-1], work[:, 1:])
        rank = np.where(slots >= 0, self.table.rank[slots], NONE)
        done = rows
        while len(alive):
            if work.shape[1] < 2:
                done[alive, : work.shape[1]] = work
                break
            best = rank.argmin(1)
            r = np.arange(len(alive))
            go = rank[r, best] != NONE
            if not go.all():
                stop = alive[~go]
                done[stop] = -1
                done[stop, : work.shape[1]] = work[~go]
                alive, work, rank, slots, best = alive[go], work[go], rank[go], slots[go], best[go]
                if not len(alive):
                    break
                r = np.arange(len(alive))
            work[r, best] = self.table.merged[slots[r, best]]
            left = np.arange(work.shape[1] - 1)[None, :] <= best[:, None]
            work = np.where(left, work[:, :-1], work[:, 1:])
            length[alive] -= 1
            slots = np.where(left[:, :-1], slots[:, :-1], slots[:, 1:])
            for off in (-1, 0):  # only the pairs at the merge are new
                j = best + off
                ok = (j >= 0) & (j < slots.shape[1])
                if ok.any():
                    slots[r[ok], j[ok]] = self.table.find(work[r[ok], j[ok]], work[r[ok], j[ok] + 1])
            rank = np.where(slots >= 0, self.table.rank[slots], NONE) if slots.shape[1] else np.zeros((len(r), 0), np.int32)
            widest = int(length[alive].max())
            if widest < work.shape[1]:
                work, slots, rank = work[:, :widest], slots[:, : max(0, widest - 1)], rank[:, : max(0, widest - 1)]
        return done, length

    def learn(self, pieces: list[str]) -> None:
        raw = [p.encode("utf-8", "replace") for p in pieces]
        order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
        at = 0
        while at < len(order):
            longest = len(raw[order[at]])
            limit = max(longest + 2, longest * 5 // 4)
            end = at
            while end < len(order) and len(raw[order[end]]) <= limit and (end - at) * limit < 2_000_000:
                end += 1
            end = max(end, at + 1)
            part = order[at:end]
            sizes = np.array([len(raw[i]) for i in part])
            width = int(sizes.max())
            rows = np.full((len(part), width), -1, np.int32)
            rows[np.arange(width)[None, :] < sizes[:, None]] = self.byte_id[np.frombuffer(b"".join(raw[i] for i in part), np.uint8)]
            done, length = self.merge(rows)
            ids = done[np.arange(width)[None, :] < length[:, None]]
            self.pieces.add([pieces[i] for i in part], ids, length)
            at = end

    def learn_chunks(self, chunks: list[str], lead: str, memo: dict[str, int]) -> None:
        cut = [self.findall(lead + c) for c in chunks]
        flat = [p for c in cut for p in c]
        if new := list(set(flat).difference(self.pieces.index)):
            self.learn(new)
        ids, offsets = self.pieces.gather(np.fromiter(map(self.pieces.index.__getitem__, flat), np.int64, len(flat)))
        ends = offsets[np.cumsum([0, *map(len, cut)])]
        base = len(self.chunks.index)
        self.chunks.add([lead + "\0" + c for c in chunks], ids, np.diff(ends))
        memo.update(zip(chunks, range(base, base + len(chunks))))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the offsets of the texts in them (one more than texts).

        A cut before a single space between two characters that are no white space never divides a piece, so texts are
        cut there first and the chunks are encoded by memo; a text with other white space beside its spaces is cut by
        the same rule with a pattern."""
        if len(self.chunks.index) > MEMO_CHUNKS:
            self.forget()
        cut: list[list[str]] = [t.split(" ") if t else [] for t in texts]
        unsafe = {c for c in set(chain.from_iterable(cut)).difference(self.spaced) if not c or c[0].isspace() or c[-1].isspace()}
        if unsafe:
            cut = [c if unsafe.isdisjoint(c) else SAFE_CUT(t) for c, t in zip(cut, texts)]
        new = list(set(chain.from_iterable(c[1:] for c in cut)).difference(self.spaced))
        if new:
            self.learn_chunks(new, " ", self.spaced)
        new = list({c[0] for c in cut if c}.difference(self.plain))
        if new:
            self.learn_chunks(new, "", self.plain)
        index: list[int] = []
        spaced, plain = self.spaced.__getitem__, self.plain
        for c in cut:
            if c:
                index.append(plain[c[0]])
                index.extend(map(spaced, c[1:]))
        ids, offsets = self.chunks.gather(np.array(index, np.int64))
        return ids, offsets[np.cumsum([0, *map(len, cut)])]


def vocabulary_path(path: str | None = None) -> str:
    return path or os.path.join(os.environ.get("FOLIOSPARK_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str, counts_only: bool = False) -> Iterator[pa.RecordBatch]:
    bpe = tokenizer(path)
    for batch in batches:
        n = batch.num_columns - 1
        texts, at = batch.column(n).to_pylist(), 0
        while at < len(texts):  # a few MB of text at a time, whatever the rows hold
            end, chars = at, 0
            while end < len(texts) and (chars < 4_000_000 or end == at):
                chars += len(texts[end] or "")
                end += 1
            ids, offsets = bpe.encode(texts[at:end])
            if counts_only:
                out = pa.array(np.diff(offsets), pa.int64())
            else:
                out = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(c.slice(at, end - at) for c in batch.columns[:n]), out], names=[*batch.schema.names[:n], "n_tokens" if counts_only else "ids"])
            at = end


def encode_corpus(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str | None = None) -> DataFrame:
    """The `keep` columns and `ids` of each row; one narrow pass, no shuffle."""
    path = vocabulary_path(path)
    picked = docs.select(*keep, text)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(lambda it: encoded(it, path), f"{kept}, ids array<int>")


def token_counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str | None = None) -> DataFrame:
    """Like encode_corpus, with `n_tokens` in place of the ids."""
    path = vocabulary_path(path)
    picked = docs.select(*keep, text)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(lambda it: encoded(it, path, True), f"{kept}, n_tokens bigint")
