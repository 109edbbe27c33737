"""Vectorised word splitting and hashing over the buffers of Arrow string arrays.

Every Python operator of this folder reads whole texts through here: a slice of a batch becomes one byte
buffer, its words become start and end offsets, and words of one length are hashed together, so that no Python object
is made for a word (but for words of more than 256 bytes). Null texts are empty texts. A text longer than a slice is a
slice of its own: a slice's arrays take up to some 60 times its bytes, so a text of 20 MB needs about a gigabyte.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
#: Bytes that separate words: 0x20 and 0x09-0x0D. Everything else is a word byte.
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Word bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ : digits, a-z and all of a multi-byte character.
PLAIN = np.zeros(256, bool)
PLAIN[0x30:0x3A] = PLAIN[0x61:0x7B] = PLAIN[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Words(NamedTuple):
    """Words of a slice: byte buffer, start and end of each word, its row, and the first word of each row (one more)."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0, one more than rows) of a string array; nulls are empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of about `most` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def split(texts: pa.Array, word_bytes: np.ndarray = SPACED, lower: bool = False) -> Words:
    """All words of the texts, in order."""
    buf, off = buffers(texts)
    if lower:
        buf = LOWER[buf]
    inside = word_bytes[buf]
    n = len(buf)
    starts, ends = inside.copy(), inside.copy()
    if n:
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edge = off[:-1][off[:-1] < n]
        starts[edge] = inside[edge]
        edge = off[1:][off[1:] > 0] - 1
        ends[edge] = inside[edge]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, off)
    first[-1] = len(start)
    return Words(buf, start, end, np.repeat(np.arange(len(texts)), np.diff(first)), first)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


# The five primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (U(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
#: Longer strings are hashed one by one.
_LONG = 256


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U(by)) | (x >> U(64 - by))


def _round(acc, lane: np.ndarray) -> np.ndarray:
    return _turned(acc + lane * _P2, 31) * _P1


def xxh64(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of each string buf[start:end]; strings of one length are hashed together, lane by lane."""
    size = end - start
    out = np.empty(len(start), U)
    short = np.minimum(size, _LONG + 1).astype(np.uint16)
    order = np.argsort(short, kind="stable")
    sorted_ = short[order]
    cuts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(order) else []
    buf = np.ascontiguousarray(buf)
    eights = np.ndarray((max(0, len(buf) - 7),), "<u8", buffer=buf, strides=(1,)) if len(buf) > 7 else None
    fours = np.ndarray((max(0, len(buf) - 3),), "<u4", buffer=buf, strides=(1,)) if len(buf) > 3 else None
    with np.errstate(over="ignore"):
        for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
            length = int(sorted_[a])
            if length > _LONG:
                view = memoryview(buf)
                for i in order[a:b].tolist():
                    out[i] = xxhash.xxh64_intdigest(view[int(start[i]) : int(end[i])], seed)
                continue
            for c in range(a, b, 1 << 16):  # runs that stay in the cache
                which = order[c : min(b, c + (1 << 16))]
                out[which] = _same_length(buf, eights, fours, start[which], length, U(seed))
    return out


def _same_length(buf, eights, fours, at: np.ndarray, length: int, seed) -> np.ndarray:
    place = 0
    if length >= 32:
        acc = [seed + _P1 + _P2, seed + _P2, seed, seed - _P1]
        while place + 32 <= length:
            for j in range(4):
                acc[j] = _round(acc[j], eights[at + place])
                place += 8
        h = _turned(acc[0], 1) + _turned(acc[1], 7) + _turned(acc[2], 12) + _turned(acc[3], 18)
        for x in acc:
            h = (h ^ _round(U(0), x)) * _P1 + _P4
        h = h + U(length)
    else:
        h = np.full(len(at), seed + _P5 + U(length))
    while place + 8 <= length:
        h = _turned(h ^ _round(U(0), eights[at + place]), 27) * _P1 + _P4
        place += 8
    if place + 4 <= length:
        h = _turned(h ^ (fours[at + place].astype(U) * _P1), 23) * _P2 + _P3
        place += 4
    while place < length:
        h = _turned(h ^ (buf[at + place].astype(U) * _P5), 11) * _P1
        place += 1
    h = (h ^ (h >> U(33))) * _P2
    h = (h ^ (h >> U(29))) * _P3
    return h ^ (h >> U(32))


def hashes(words: Words, which: int = 0) -> np.ndarray:
    """The XXH64 of each word's bytes; two values of `which` (the seed) give two hashes."""
    return xxh64(words.buf, words.start, words.end, which)


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two neighbouring windows from the hashes of each; a may be longer than b."""
    n = min(len(a), len(b))
    return mix(a[:n] * U(0xD6E8FEB86659FD93) + b[:n])


def windows(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of `length` words, whatever rows they cross, by doubling."""
    if len(h) < length:
        return np.zeros(0, U)
    done, out, piece, size = 0, None, h, 1
    while True:
        if length & size:
            out = piece if out is None else join(out, piece[done:])
            done += size
        if done == length:
            return out[: len(h) - length + 1]
        piece = join(piece, piece[size:])
        size *= 2


def inside(words: Words, length: int) -> np.ndarray:
    """For each window start of `windows`, whether the window ends in its row."""
    n = len(words.start) - length + 1
    return words.row[:n] == words.row[length - 1 :] if n > 0 else np.zeros(0, bool)


def give_back() -> None:
    """Hand freed memory back to the system: a worker outlives its task, and its next task may be another operator's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable) -> Callable:
    """run, a function over the batches of a task, with give_back() at the end of the task."""

    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def mapped(df, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, most: int = 4 << 20, column: str = "text"):
    """f over slices of all batches, by mapInArrow."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, column, most):
                out = f(part)
                if out is not None:
                    yield out

    return df.mapInArrow(released(run), schema)
