"""Words and word shingles of many texts at once, as 64-bit hashes in flat arrays."""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SLOTS = np.array([(0xD1B54A32D192ED03 * (2 * i + 3) + 0x8CB92BA72F3D8DD7 * i) & _MASK | 1 for i in range(64)],
                  np.uint64)

BLANKS = bytes([9, 10, 11, 12, 13, 32])
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Lower case for A-Z, blanks for ASCII other than letters and digits.
PLAIN = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``; one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_CHUNK = 8
_KEPT_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(_CHUNK)] + [_MASK], np.uint64)


def flat_words(
    texts: list[bytes], table: bytes = LOWER,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts by ``table``, start and end of each word, and the text each belongs to."""
    data = np.frombuffer(b"\n".join([*texts, b""]).translate(table), np.uint8)
    blank = np.zeros(256, bool)
    blank[list(BLANKS)] = True
    wordy = np.concatenate([[False], ~blank[data], [False]])
    edges = np.flatnonzero(wordy[1:] != wordy[:-1])
    starts, ends = edges[::2], edges[1::2]
    text_starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.zeros(0, np.int64)
    return data, starts, ends, np.searchsorted(text_starts, starts, side="right") - 1


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per word: equal bytes, equal hash, wherever the word stands.

    Eight bytes at a time are mixed into what came before. Each step is one to one in either, so words of one
    length that differ in eight bytes only never collide, and no sum is taken whose terms could cancel out.
    """
    padded = np.concatenate([data, np.zeros(_CHUNK, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # at every place, unaligned
    left = ends - starts
    out = mixed(left.astype(np.uint64) * np.uint64(_BASE))
    at, own = starts, np.arange(len(starts))
    while len(own):
        chunk = eight[at] & _KEPT_BYTES[np.minimum(left, _CHUNK)]
        out[own] = mixed(out[own] ^ mixed(chunk + np.uint64(_BASE)))
        on = left > _CHUNK
        at, left, own = at[on] + _CHUNK, left[on] - _CHUNK, own[on]
    return out


def runs(words: np.ndarray, text: np.ndarray, width: int, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every run of ``width`` words; a shorter text's words are one run."""
    n = max(0, len(words) - width + 1)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total + words[k:k + n] * _SLOTS[k]
    whole = text[:n] == text[width - 1:width - 1 + n] if n else np.zeros(0, bool)
    values, owners = [mixed(total[whole])], [text[:n][whole]]
    counts = np.bincount(text, minlength=n_texts) if len(text) else np.zeros(n_texts, np.int64)
    firsts = np.cumsum(counts) - counts
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        own = words[firsts[i]:firsts[i] + counts[i]]
        one = np.append(own * _SLOTS[:len(own)], np.uint64(len(own)) * _SLOTS[63:])
        values.append(mixed(one.sum(dtype=np.uint64, keepdims=True)))
        owners.append(np.array([i]))
    return np.concatenate(values), np.concatenate(owners)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``width`` words."""
    data, starts, ends, text = flat_words(texts)
    values, owners = runs(hashed(data, starts, ends), text, width, len(texts))
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    if len(values):
        new = np.concatenate([[True], (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])])
        values, owners = values[new], owners[new]
    bounds = np.searchsorted(owners, np.arange(len(texts) + 1))
    return [values[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

