"""Packing by power-of-two decomposition.

A document's token ids, with the end id after them, are cut into pieces whose lengths are the binary digits of their
count (full sequences first, then ever shorter powers of two). Each piece is a sequence of its own, and sequences of
equal length form a bucket, from which batches are drawn: no sequence crosses documents, and none needs padding.

Tokenizing dominates, and words repeat: texts are cut at places where the tokenizer's pre-tokenizer always cuts, and
each distinct stretch is encoded once a task. Documents in which the tokenizer's special token is spelled out are
encoded whole.

Defined cases: null and empty texts have the end id alone (one piece of length 1); repeated rows are packed each; a
null doc_id stays null; an empty table gives no rows; very long texts are encoded whole, a slice each; other columns
are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitesieve.llm import shared
from sitesieve.llm import words as W

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, offset bigint, bucket int"
SPECIAL = "<|endoftext|>"

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True
_PUNCT = _PRINTED & ~_LETTER
_PUNCT[0x30:0x3A] = False
_PUNCT[0x27] = False


def stretches(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of the stretches of the texts: each text's own, and places where pre-tokens always end.

    These are a single space or line end between printed characters (before it; after a line end too) and a
    punctuation mark after a letter. Printed are 0x21-0x7E and U+00C0-U+00FF; others never make a cut."""
    n = len(buf)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        two = buf[:-1] == 0xC3  # the next byte ends one of U+00C0-U+00FF
        latin = np.zeros(n, bool)
        latin[1:] = two & (buf[1:] >= 0x80)
        printed_end = _PRINTED[buf] | latin
        printed_start = _PRINTED[buf] | (buf == 0xC3)
        letter_end = _LETTER[buf] | (latin & (buf != 0x97) & (buf != 0xB7))
        mid = buf[1:-1]
        between = printed_end[:-2] & printed_start[2:]
        cut[1 : n - 1] |= between & ((mid == 0x20) | (mid == 0x0A))
        cut[2:n] |= between & (mid == 0x0A)
        cut[1:n] |= letter_end[:-1] & _PUNCT[buf[1:]]
    cut[n] = False
    cut[off[:-1][off[:-1] < n]] = True
    # a text edge inside the three bytes looked at: the space belongs to one text only
    for shift in (-1, 0, 1):
        at = off[1:-1] + shift
        at = at[(at > 0) & (at < n)]
        cut[at] = False
    cut[off[:-1][off[:-1] < n]] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """Token ids of texts, keeping those of the distinct stretches seen (emptied when they are `most`).

    Stretches are looked up by hash and then compared byte by byte; one that differs from the stretch kept under its
    hash is encoded by itself."""

    def __init__(self, path: str, most: int = 4_000_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)  # a byte-level token has a character for each byte
        self.clear()

    def clear(self) -> None:
        self.known, self.at, self.count, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.byte_at, self.byte_count, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, h: np.ndarray, start: np.ndarray, end: np.ndarray, buf: np.ndarray) -> None:
        if len(self.known) > self.most:
            self.clear()
        whole = buf.tobytes()
        last = buf[end - 1]
        ends_well = _PRINTED[last] | ((last >= 0x80) & (buf[np.maximum(end - 2, 0)] == 0xC3) & (end - start > 1))
        chained = (buf[start] == 0x20) & ends_well & (end - start > 1)
        chained &= _PRINTED[buf[np.minimum(start + 1, len(buf) - 1)]] | (buf[np.minimum(start + 1, len(buf) - 1)] == 0xC3)
        order = np.concatenate([np.flatnonzero(chained), np.flatnonzero(~chained)])
        n = int(chained.sum())
        parts = [whole[a:b] for a, b in zip(start[order].tolist(), end[order].tolist(), strict=True)]
        runs = [b"".join(parts[i : min(n, i + 500)]).decode() for i in range(0, n, 500)]
        ids, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if runs:
            ids = np.concatenate([np.array(x, np.uint32) for x in self.plain(runs)])
            ends = np.cumsum(self.bytes_of[ids])
            to = np.searchsorted(ends, np.cumsum([len(x) for x in parts[:n]])) + 1
            counts = np.diff(np.concatenate([[0], to]))
        rest = self.plain([x.decode() for x in parts[n:]])
        flat = np.concatenate([ids, *(np.array(x, np.uint32) for x in rest)]).astype(np.uint32)
        counts = np.concatenate([counts, np.array([len(x) for x in rest], np.int64)])
        at = np.cumsum(counts) - counts + len(self.flat)
        known = np.concatenate([self.known, h[order]])
        by = np.argsort(known)
        self.known, self.at, self.count = known[by], np.concatenate([self.at, at])[by], np.concatenate([self.count, counts])[by]
        self.flat = np.concatenate([self.flat, flat])
        sizes = (end - start)[order]
        self.byte_at = np.concatenate([self.byte_at, np.cumsum(sizes) - sizes + len(self.bytes)])[by]
        self.byte_count = np.concatenate([self.byte_count, sizes])[by]
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(parts), np.uint8)])

    def _strangers(self, entry: np.ndarray, start: np.ndarray, end: np.ndarray, buf: np.ndarray) -> np.ndarray:
        """Stretches that are not the ones kept under their hashes. The stretches follow one another without gaps."""
        size = end - start
        odd = self.byte_count[entry] != size
        cuts = np.append(np.unique(np.searchsorted(start, np.arange(0, len(buf), 1 << 18))), len(start))
        for a, b in zip(cuts, cuts[1:], strict=False):  # in runs of some 256 KB: a number a byte is eight times the text
            if a == b:
                continue
            o, lo, hi = odd[a:b], int(start[a]), int(end[b - 1])
            kept = np.repeat(np.where(o, 0, self.byte_at[entry[a:b]] - start[a:b]), size[a:b]) + np.arange(lo, hi)
            kept[np.repeat(o, size[a:b])] = 0
            odd[np.searchsorted(end, np.flatnonzero(self.bytes[kept] != buf[lo:hi]) + lo, "right")] = True
        return np.flatnonzero(odd)

    def encode(self, texts: pa.Array, end_id: int | None = 0) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and each text's first place (one more than texts); end_id follows each text."""
        texts = pc.fill_null(texts, "")
        special = np.flatnonzero(pc.match_substring(texts, SPECIAL).to_numpy(zero_copy_only=False))
        buf, off = W.buffers(texts)
        start = stretches(buf, off)
        end = np.concatenate([start[1:], [len(buf)]]) if len(start) else start
        first = np.searchsorted(start, off)
        row = np.repeat(np.arange(len(texts)), np.diff(first))
        h = W.hashes(W.Words(buf, start, end, row, first))
        new, i = np.unique(h, return_index=True)
        place = np.searchsorted(self.known, new)
        missing = i if not len(self.known) else i[(place == len(self.known)) | (self.known[np.minimum(place, len(self.known) - 1)] != new)]
        if len(missing):
            cleared = len(self.known) > self.most
            if cleared:
                missing = i
            self._learn(h[missing], start[missing], end[missing], buf)
        entry = np.searchsorted(self.known, h)
        strangers = self._strangers(entry, start, end, buf) if len(h) else entry
        n = self.count[entry] if len(h) else np.zeros(0, np.int64)
        per_text = np.bincount(row, weights=n, minlength=len(texts)).astype(np.int64) if len(h) else np.zeros(len(texts), np.int64)
        which = np.repeat(np.arange(len(n)), n)
        ids = self.flat[self.at[entry][which] + (np.arange(len(which)) - (np.cumsum(n) - n)[which])] if len(h) else np.zeros(0, np.uint32)
        special = np.union1d(special, row[strangers])  # texts with a stretch of another's hash are encoded whole
        if end_id is None and not len(special):
            return ids, np.concatenate([[0], np.cumsum(per_text)])
        pieces = np.split(ids, np.cumsum(per_text)[:-1]) if len(texts) else []
        for s in special.tolist():
            pieces[s] = np.array(self.plain([texts[s].as_py()])[0], np.uint32)
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        out = [x for p in pieces for x in (p, tail)]
        sizes = np.array([len(p) + len(tail) for p in pieces], np.int64)
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder: it outlives a task, but the stretches it keeps should not (see packed)."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def decomposed(n: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and length of the pieces of rows of n ids: as many of `most` as fit, then the binary digits of the rest."""
    whole = n // most
    rows, lengths = [np.repeat(np.arange(len(n)), whole)], [np.full(int(whole.sum()), most)]
    starts = [(np.arange(len(rows[0])) - (np.cumsum(whole) - whole)[rows[0]]) * most]
    used, bit = whole * most, most // 2
    while bit:
        have = np.flatnonzero((n % most) & bit)
        rows.append(have), lengths.append(np.full(len(have), bit)), starts.append(used[have])
        used[have] += bit
        bit //= 2
    row, start, length = (np.concatenate(x) for x in (rows, starts, lengths))
    order = np.lexsort((start, row))
    return row[order], start[order], length[order]


def packed(docs: DataFrame, tokenizer_path: str, most: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket (log2 of the length).

    with_ids: the ids too, as an array."""
    if most & (most - 1):
        raise ValueError("most must be a power of two")

    def run(part: pa.RecordBatch):
        ids, first = encoder(tokenizer_path).encode(part.column("text"), end_id)
        n = np.diff(first)
        row, start, length = decomposed(n, most)
        a = first[row] + start
        raw = ids.astype("<u4").tobytes()
        crc = [zlib.crc32(raw[4 * x : 4 * (x + y)]) for x, y in zip(a.tolist(), length.tolist(), strict=True)]
        columns = [part.column("doc_id").take(pa.array(row)), *(pa.array(x.astype(np.int64)) for x in (start, length)), pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(np.zeros(len(row), np.int64)), pa.array(np.log2(length).astype(np.int32))]
        names = [x.split()[0] for x in PIECES.split(", ")]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(ids.astype(np.int32))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names)

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def task(batches):
        try:
            for batch in batches:
                for piece in W.slices(batch, most=2 << 20):
                    yield run(piece)
        finally:
            encoder(tokenizer_path).clear()  # idle workers stay, and several share an executor with the next operator

    out = given.mapInArrow(W.released(task), PIECES + (", ids array<int>" if with_ids else ""))
    shown = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"]
    return out.withColumn("sequence_id", F.monotonically_increasing_id()).select(*shown, *(["ids"] if with_ids else []))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(shared.table(spark, sf_dir, "documents"), tokenizer_path())
