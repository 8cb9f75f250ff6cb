"""Hashed word n-grams of Arrow text batches (inside tasks): CRC-32 of every run
of one to three words, joined from the words' own CRCs without building strings."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

from strata.llm.words import slices

BUCKETS = 10_000
PIECE = 4_000_000      # bytes of one text that are looked at together
SHORT = 64             # words up to so many bytes take the vectorised way
_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text, byte by byte.
IN_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)


@cache
def _crc_table() -> np.ndarray:
    """The CRC-32 register's change by one byte."""
    c = _BYTES.astype(np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit values, given as four tables of 256 entries."""
    return (tables[0][crc & np.uint32(255)] ^ tables[1][(crc >> np.uint32(8)) & np.uint32(255)]
            ^ tables[2][(crc >> np.uint32(16)) & np.uint32(255)] ^ tables[3][crc >> np.uint32(24)])


@cache
def _shift_powers() -> np.ndarray:
    """Maps of a CRC over 2**i more bytes, i from 0 (the linear part)."""
    value = np.stack([_BYTES.astype(np.uint32) << np.uint32(8 * k) for k in range(4)])
    one = _crc_table()[value & np.uint32(255)] ^ (value >> np.uint32(8))
    out = [one]
    for _ in range(30):
        out.append(_apply(out[-1], out[-1]))
    return np.stack(out)


@cache
def _shift_short() -> np.ndarray:
    """The map over n more bytes for every n up to SHORT."""
    one = _shift_powers()[0]
    out = [np.stack([_BYTES.astype(np.uint32) << np.uint32(8 * k) for k in range(4)])]
    for _ in range(SHORT):
        out.append(_apply(one, out[-1]))
    return np.stack(out)


def _shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``crc`` carried over ``length`` more bytes (their own CRC still to be added)."""
    tables = _shift_short().reshape(-1)
    row = np.minimum(length, SHORT) * 1024
    out = (tables[row + (crc & np.uint32(255))] ^ tables[row + 256 + ((crc >> np.uint32(8)) & np.uint32(255))]
           ^ tables[row + 512 + ((crc >> np.uint32(16)) & np.uint32(255))] ^ tables[row + 768 + (crc >> np.uint32(24))])
    for at in np.flatnonzero(length > SHORT):
        left, value = int(length[at]), crc[at:at + 1]
        for bit, table in enumerate(_shift_powers()):
            if left >> bit & 1:
                value = _apply(table, value)
        out[at] = value[0]
    return out


def _crc_of_words(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    table = _crc_table()
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-length, kind="stable")
    live, at, have = len(order) - np.searchsorted(np.sort(length), np.arange(1, SHORT + 1)), start[order], crc
    for j in range(SHORT):
        n = int(live[j])
        if not n:
            break
        c = have[:n]
        have[:n] = table[(c ^ data[at[:n] + j]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = ~have
    for k in np.flatnonzero(length > SHORT):
        out[k] = zlib.crc32(data[start[k]:start[k] + length[k]])
    return out


def _with_space(crc: np.ndarray) -> np.ndarray:
    c = ~crc
    return ~(_crc_table()[(c ^ np.uint32(32)) & np.uint32(255)] ^ (c >> np.uint32(8)))


def ngram_crcs(data: np.ndarray, offsets: np.ndarray, carry: tuple[int, int] | None = None):
    """CRCs of the n-grams that end at each word of the lower-cased bytes
    ``data`` of several texts (``offsets``): ``(first word of each text, uni,
    bi, tri, has_bi, has_tri)``.

    ``carry`` (for one piece of a longer text): CRCs of the unigram and the
    bigram (or -1) that end at the last word before the piece.
    """
    inside = IN_WORD[data]
    begins, ends = inside.copy(), inside.copy()
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    joined = inside[1:] & inside[:-1]
    joined[cuts - 1] = False
    begins[1:] &= ~joined
    ends[:-1] &= ~joined
    start = np.flatnonzero(begins)
    length = np.flatnonzero(ends) + 1 - start
    first = np.searchsorted(start, offsets)
    uni = _crc_of_words(data, start, length)
    n = len(uni)
    place = np.arange(n) - np.repeat(first[:-1], np.diff(first)) if n else np.empty(0, np.int64)
    before1 = np.empty(n, np.uint32)
    before1[1:] = uni[:-1]
    has_bi, has_tri = place >= 1, place >= 2
    if carry is not None and n:
        before1[0], has_bi[0], has_tri[:1] = carry[0] & 0xFFFFFFFF, True, carry[1] >= 0
        has_tri[1:2] = True
    elif n:
        before1[0] = 0
    bi = _shifted(_with_space(before1), length) ^ uni
    before2 = np.empty(n, np.uint32)
    before2[1:] = bi[:-1]
    if n:
        before2[0] = carry[1] & 0xFFFFFFFF if carry is not None and carry[1] >= 0 else 0
    tri = _shifted(_with_space(before2), length) ^ uni
    return first, uni, bi, tri, has_bi, has_tri


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """One long text cut between words, about PIECE bytes a piece."""
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and IN_WORD[data[end]]:
            step = data[end:end + PIECE]
            gap = np.flatnonzero(~IN_WORD[step])
            end += int(gap[0]) if len(gap) else len(step)
        yield data[at:end]
        at = end


def bucketed(batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets of the n-grams of the texts of a batch, block by block:
    ``(first row, rows, words a row, features a row, buckets row by row)``.
    A text longer than PIECE comes in several blocks of one row each."""
    done = 0
    for part in slices(batch, text, PIECE):
        column = part.column(text).cast(pa.large_string()).fill_null("")
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        buffers = column.buffers()
        offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
        raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.empty(0, np.uint8)
        data = LOWER[raw[offsets[0]:offsets[-1]]]
        if len(column) == 1 and len(data) > PIECE:
            carry = None
            for piece in _pieces(data):
                first, uni, bi, tri, has_bi, has_tri = ngram_crcs(piece, np.array([0, len(piece)]), carry)
                if len(uni):
                    carry = (int(uni[-1]), int(bi[-1]) if has_bi[-1] else -1)
                    yield (done, 1, *_block(first, uni, bi, tri, has_bi, has_tri))
        else:
            yield (done, len(column), *_block(*ngram_crcs(data, offsets - offsets[0])))
        done += len(column)


def _block(first, uni, bi, tri, has_bi, has_tri):
    """Words and features of each text, and the features' buckets text by text."""
    held = np.stack([np.ones(len(uni), bool), has_bi, has_tri], axis=1)
    crcs = np.stack([uni, bi, tri], axis=1)[held]
    per_word = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
    return np.diff(first), np.diff(per_word[first]), (crcs % np.uint32(BUCKETS)).astype(np.int64)
