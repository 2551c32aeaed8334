"""Batch longest-common-subsequence lengths for pairs of strings (runs inside Spark tasks).

Bit-parallel LCS: for a pattern ``b`` keep one machine word ``V`` with a bit per
character of ``b``; every character ``x`` of ``a`` updates it with

    U = V & M[x];  V = (V + U) | (V - U)

where ``M[x]`` has the bits of the positions of ``x`` in ``b``.  The LCS length is the
number of zero bits among the low ``len(b)`` bits of ``V`` (Allison & Dix 1986,
Crochemore et al. 2001, Hyyrö 2004).  Carries and borrows only move upwards, so the
low bits are exact under 64-bit wrap-around; a longer ``b`` takes several words and the
carry of the addition goes from word to word.

``lcs_lengths`` vectorises this over an Arrow batch with numpy, for any Unicode text: one pass
over the character positions, not a Python loop over rows.  The batch is taken in pieces of
similar length whose tables stay within a fixed number of bytes, so neither a large alphabet
nor one long string multiplies the memory of the whole batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_WORD = 64
CHUNK_BYTES = 16 << 20  # working tables of one piece of a batch


def lcs_python(a: str, b: str) -> int:
    """Reference recurrence on Python integers (any length, any characters)."""
    if len(b) > len(a):
        a, b = b, a
    if not b:
        return 0
    masks: dict[str, int] = {}
    for j, ch in enumerate(b):
        masks[ch] = masks.get(ch, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for ch in a:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


def _char_codes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, flat code points) of a string array, in characters; nulls count as "".

    The batch's UTF-8 buffer is decoded in one call, so there is no per-string Python work.
    """
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr, "").cast(pa.large_string())
    n = len(arr)
    bufs = arr.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64, count=n + 1, offset=arr.offset * 8)
    raw = bufs[2].to_pybytes()[offsets[0]:offsets[-1]] if bufs[2] is not None else b""
    flat = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype=np.int32)
    lens = np.asarray(pc.utf8_length(arr).to_numpy(zero_copy_only=False), dtype=np.int64)
    return np.cumsum(lens) - lens, lens, flat


def _padded_codes(starts: np.ndarray, lens: np.ndarray, flat: np.ndarray, width: int) -> np.ndarray:
    """Matrix (n, width) of code points, -1 beyond each string's end."""
    if width == 0 or len(flat) == 0:
        return np.full((len(starts), width), -1, dtype=np.int32)
    pos = np.arange(width, dtype=np.int64)
    valid = pos[None, :] < lens[:, None]
    idx = np.where(valid, starts[:, None] + pos[None, :], 0)
    return np.where(valid, flat[np.minimum(idx, len(flat) - 1)], -1)


def _letters(codes: np.ndarray) -> np.ndarray:
    """Distinct code points (>= 0), ascending."""
    codes = codes[codes >= 0]
    if len(codes) and int(codes.max()) < (1 << 17):
        return np.flatnonzero(np.bincount(codes))
    return np.unique(codes)


def _chunks(p_len: np.ndarray, t_len: np.ndarray, letters: int) -> Iterator[np.ndarray]:
    """Rows in pieces of similar length whose tables stay within CHUNK_BYTES (one row at least).

    Rows are classed by the power of two of their text's length, so a long one doesn't widen the
    others.  A row costs its padded code points and, per distinct character of its piece (all
    ``letters``, or at most one per pattern character), a mask of one bit per pattern character.
    """
    size = np.frexp(np.maximum(t_len, 16))[1]
    for c in np.unique(size):
        rows = np.flatnonzero(size == c)
        wide_t, wide_p = int(t_len[rows].max()), int(p_len[rows].max())
        mask, flat = 8 * -(-wide_p // _WORD), 24 * (wide_t + wide_p)
        step = max(CHUNK_BYTES // (flat + mask * (letters + 1)),
                   min(CHUNK_BYTES // (2 * flat), int((CHUNK_BYTES / (2 * mask * max(1, wide_p))) ** 0.5)), 1)
        for at in range(0, len(rows), step):
            yield rows[at:at + step]


def lcs_lengths(a: pa.Array, b: pa.Array) -> np.ndarray:
    """LCS length of each pair ``(a[i], b[i])`` as int64 (null counts as "")."""
    n = len(a)
    out = np.zeros(n, dtype=np.int64)
    if n == 0:
        return out
    sa, la, ca = _char_codes(a)
    sb, lb, cb = _char_codes(b)
    flat = np.concatenate([ca, cb])
    sb = sb + len(ca)
    # the pattern (bit side) is the shorter string of each pair
    swap = lb > la
    ps, pl = np.where(swap, sa, sb), np.where(swap, la, lb)
    ts, tl = np.where(swap, sb, sa), np.where(swap, lb, la)
    some = np.nonzero(pl > 0)[0]
    letters = len(_letters(flat)) if len(some) else 0
    for part in _chunks(pl[some], tl[some], letters):
        idx = some[part]
        p_codes = _padded_codes(ps[idx], pl[idx], flat, int(pl[idx].max()))
        t_codes = _padded_codes(ts[idx], tl[idx], flat, int(tl[idx].max()))
        out[idx] = _lcs_words(p_codes, t_codes, pl[idx])
    return out


def _alphabet_columns(codes: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Column of each code in ``used`` (sorted), or len(used) when absent or padding (-1)."""
    k = len(used)
    top = int(codes.max()) if codes.size else -1
    if top < (1 << 17):
        lut = np.full(top + 2, k, dtype=np.int32)
        lut[used[used <= top]] = np.nonzero(used <= top)[0]
        return lut[np.where(codes >= 0, codes, top + 1)]
    pos = np.minimum(np.searchsorted(used, codes), max(k - 1, 0))
    hit = (codes >= 0) & (k > 0) & (used[pos] == codes) if k else np.zeros(codes.shape, bool)
    return np.where(hit, pos, k)


def _lcs_words(p_codes: np.ndarray, t_codes: np.ndarray, pl: np.ndarray) -> np.ndarray:
    m, width_p = p_codes.shape
    n_words = -(-width_p // _WORD)
    rows = np.arange(m)
    # compact alphabet: characters of the patterns get columns 0..k-1; anything else the
    # all-zero column k, which leaves V unchanged (so does the -1 padding)
    used = _letters(p_codes)
    masks = np.zeros((n_words, m, len(used) + 1), dtype=np.uint64)
    p_cols = _alphabet_columns(p_codes, used)
    one = np.uint64(1)
    for j in range(width_p):
        ok = p_codes[:, j] >= 0
        masks[j // _WORD, rows[ok], p_cols[ok, j]] |= one << np.uint64(j % _WORD)
    t_cols = _alphabet_columns(t_codes, used)
    v = np.full((n_words, m), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(t_codes.shape[1]):
        carry = None
        col = t_cols[:, i]
        for w in range(n_words):
            u = v[w] & masks[w, rows, col]
            total = v[w] + u
            if n_words > 1:  # the carry of the addition goes to the next word
                over = total < u
                if carry is not None:
                    total = total + carry
                    over |= total < carry
                carry = over.astype(np.uint64)
            v[w] = total | (v[w] & ~u)
    left = np.zeros(m, dtype=np.int64)
    for w in range(n_words):
        bits = np.clip(pl - w * _WORD, 0, _WORD)
        low = np.where(bits >= _WORD, np.iinfo(np.uint64).max, (one << np.minimum(bits, 63).astype(np.uint64)) - one)
        left += np.bitwise_count(v[w] & low).astype(np.int64)
    return pl - left
