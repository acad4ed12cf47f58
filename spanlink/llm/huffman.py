"""Canonical length-limited Huffman coding of integer ids, in numpy.

Codes come from lengths alone (shorter first, then smaller id), so a file stores one length per id. Blocks of BLOCK ids
are independent: the file keeps the bit offset where each starts, and decoding walks all blocks of a segment in lockstep
through one lookup table.
"""

from __future__ import annotations

import numpy as np

#: Longest code; a vocabulary may have up to 2**MAX_BITS ids.
MAX_BITS = 20
BLOCK = 512


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths under max_bits, by package-merge; 0 for ids with no occurrence."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids don't fit codes of {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, below = [], leaves
    for _ in range(max_bits):
        packages = below[: len(below) // 2 * 2].reshape(-1, 2).sum(axis=1) if levels else np.empty(0)
        weights = np.concatenate([leaves, packages])
        place = np.argsort(weights, kind="stable")
        levels.append(place < len(leaves))
        below = weights[place]
    take = 2 * len(order) - 2
    for is_leaf in reversed(levels):
        n_leaves = int(is_leaf[:take].sum())
        lengths[order[:n_leaves]] += 1
        take = 2 * (take - n_leaves)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        width = lengths[order].astype(np.int64)
        step = np.left_shift(np.uint64(1), (MAX_BITS - width).astype(np.uint64))
        start = np.concatenate([np.zeros(1, np.uint64), np.cumsum(step)[:-1].astype(np.uint64)])
        codes[order] = start >> (MAX_BITS - width).astype(np.uint64)
    return codes


def decode_table(lengths: np.ndarray) -> np.ndarray:
    """For each MAX_BITS-bit prefix: id * 32 + length of the code that it starts with."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    width = lengths[order].astype(np.int64)
    filled = np.repeat(order.astype(np.uint32) * 32 + width.astype(np.uint32), 1 << (MAX_BITS - width))
    return np.concatenate([filled, np.zeros((1 << MAX_BITS) - len(filled), np.uint32)])


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits as big-endian 32-bit words, and the bit offset of each block."""
    width = lengths[ids].astype(np.int64)
    if len(ids) and not width.all():
        raise ValueError("an id has no code")
    end = np.cumsum(width)
    at = end - width
    lane = codes[ids] << (64 - (at & 31) - width).astype(np.uint64)
    word, n = at >> 5, (int(end[-1]) + 31) // 32 + 1 if len(ids) else 1
    # lanes of one word hold different bits, so their sum, exact below 2**53, is their union
    words = np.bincount(word, (lane >> np.uint64(32)).astype(np.float64), n) + np.bincount(word + 1, (lane & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    return words.astype(">u4").tobytes(), at[::BLOCK].astype(np.uint64)


def decode(bits: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray) -> np.ndarray:
    words = np.concatenate([np.frombuffer(bits, ">u4").astype(np.uint64), np.zeros(2, np.uint64)])
    blocks = len(checkpoints)
    out = np.zeros((blocks, BLOCK), np.uint32)
    at = checkpoints.astype(np.int64)
    tail = n - (blocks - 1) * BLOCK if blocks else 0
    mask = np.uint64((1 << MAX_BITS) - 1)
    for k in range(min(n, BLOCK)):
        if k == tail:  # the last block has ended
            at = at[:-1]
        word = at >> 5
        lane = (words[word] << np.uint64(32)) | words[word + 1]
        hit = table[((lane >> (64 - MAX_BITS - (at & 31)).astype(np.uint64)) & mask).astype(np.int64)]
        out[: len(at), k] = hit >> 5
        at = at + (hit & 31)
    return out.reshape(-1)[:n]
