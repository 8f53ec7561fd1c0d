"""Numbers that describe a text: hashed letter n-grams and document statistics.

Both work on whole chunks of UTF-8 bytes, in a fixed number of array passes, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pluvia.llm.columnar import offsets_of

DIMENSIONS = 4096
ROWS = 256  # texts whose n-gram counts are held at once
MIX = np.uint32(2654435761)

STATISTICS = [
    "log_bytes",
    "log_words",
    "word_length",
    "longest_word",
    "distinct_words",
    "letters",
    "upper",
    "digits",
    "sentence_marks",
    "exclamations",
    "bars",
    "symbols",
    "brackets",
    "non_ascii",
    "spaces",
    "doubled_bytes",
    "log_lines",
    "line_length",
    "distinct_lines",
    "words_ending_in_symbol",
    "capitalised_words",
    "entropy",
    "commonest_byte",
]


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_SPACE = _table(" \t\n\x0b\x0c\r")
_SETS = [
    _LETTER,
    _UPPER,
    np.array([48 <= b <= 57 for b in range(256)]),
    _table(".,;:?"),
    _table("!"),
    _table("|"),
    _table("#$%&*+=@^~_`\\/"),
    _table("()[]{}<>\"'"),
    np.array([b >= 128 for b in range(256)]),
    _SPACE,
]
_SYMBOL = _table("#$%&*+=@^~!|")
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if _LETTER[b] else 32 for b in range(256)], np.uint8)


def ngrams(data: np.ndarray, offsets: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Unit rows of square roots of counts of 2- and 3-byte sequences of letters.

    Case is folded for A-Z and Latin-1; whatever is no letter counts as one space. A text without a
    letter has a zero row.
    """
    rows = len(offsets) - 1
    folded = _FOLD[data]
    if len(folded) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        folded[1:][capital] += 0x20
    space = folded == 32
    first = np.zeros(len(folded) + 1, bool)
    first[offsets] = True
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep &= ~(space & first[:-1])
    kept = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    where, text = kept[offsets], folded[keep]
    # a space before and after each text
    row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(where) + 2)
    padded = np.full(len(row), 32, np.uint8)
    inside = np.ones(len(row), bool)
    bounds = offsets_of(np.diff(where) + 2)
    inside[bounds[:-1]] = inside[bounds[1:] - 1] = False
    padded[inside] = text
    out = np.zeros(rows * dimensions, np.float32)
    shift = np.uint32(32 - (dimensions.bit_length() - 1))
    code = padded.astype(np.uint32)
    for size in (2, 3):
        if len(code) < size:
            break
        gram = code[: len(code) - size + 1].copy()
        for k in range(1, size):
            gram = (gram << np.uint32(8)) | code[k : len(code) - size + 1 + k]
        gram = ((gram + np.uint32(size << 24)) * MIX) >> shift
        same = row[: len(gram)] == row[size - 1 :]
        out += np.bincount(row[: len(gram)][same] * np.int64(dimensions) + gram[same], minlength=len(out)).astype(np.float32)
    out = np.sqrt(out.reshape(rows, dimensions))
    out[np.diff(where) == 0] = 0
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-12)


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int32 if len(mask) < 2**31 else np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[offsets]).astype(np.float64)


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Distinct byte strings of each row; the strings are slices of ``data``."""
    if not len(starts):
        return np.zeros(n)
    bounds = np.empty(2 * len(starts) + 1, np.int32)
    bounds[0:-1:2], bounds[1::2], bounds[-1] = starts, ends, ends[-1]
    column = pa.Array.from_buffers(pa.binary(), 2 * len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    code = column.dictionary_encode().indices.to_numpy()[::2].astype(np.int64)
    pair = np.sort(rows.astype(np.int64) * (code.max() + 1) + code)
    fresh = np.ones(len(pair), bool)
    fresh[1:] = pair[1:] != pair[:-1]
    return np.bincount(pair[fresh] // (code.max() + 1), minlength=n).astype(np.float64)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text; an empty text has zeros throughout."""
    n, size = len(offsets) - 1, np.diff(offsets).astype(np.float64)
    length = np.maximum(size, 1)
    if not len(data):
        return np.zeros((n, len(STATISTICS)))
    shares = [_sums(s[data], offsets) / length for s in _SETS]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:-1]
    stop = word.copy()
    stop[:-1] &= ~word[1:] | first[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    words = np.bincount(rows, minlength=n).astype(np.float64)
    many = np.maximum(words, 1)
    longest = np.zeros(n)
    np.maximum.at(longest, rows, (ends - starts).astype(np.float64))
    line = np.ones(len(data), bool)
    line[1:] = (data[:-1] == 10) | first[1:-1]
    line_starts = np.flatnonzero(line)
    line_ends = np.append(line_starts[1:], len(data))
    line_rows = np.searchsorted(offsets, line_starts, side="right") - 1
    lines = np.bincount(line_rows, minlength=n).astype(np.float64)
    doubled = np.zeros(len(data), bool)
    doubled[1:] = (data[1:] == data[:-1]) & ~first[1:-1]
    byte_row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets)) << 8
    counts = np.bincount(byte_row | data, minlength=n << 8).reshape(n, 256) / length[:, None]
    entropy = -(counts * np.log2(np.maximum(counts, 1e-12))).sum(axis=1)
    letters = np.maximum(shares[0], 1e-9)
    columns = [
        np.log1p(size),
        np.log1p(words),
        np.bincount(rows, ends - starts, minlength=n) / many,
        np.log1p(longest),
        _distinct(data, starts, ends, rows, n) / many,
        shares[0],
        shares[1] / letters,
        *shares[2:],
        _sums(doubled, offsets) / length,
        np.log1p(lines),
        np.log1p(size / np.maximum(lines, 1)),
        _distinct(data, line_starts, line_ends, line_rows, n) / np.maximum(lines, 1),
        np.bincount(rows, _SYMBOL[data[ends - 1]], minlength=n) / many,
        np.bincount(rows, _UPPER[data[starts]], minlength=n) / many,
        entropy,
        counts.max(axis=1),
    ]
    return np.stack(columns, axis=1)
