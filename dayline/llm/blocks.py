"""Texts of an Arrow batch as NumPy arrays, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters of texts that are worked on together.
BLOCK = 4_000_000
#: A-Z lower-cased; letters and bytes above ASCII stay, anything else becomes a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def in_blocks(texts: list[str], most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Slices of a batch whose texts have about ``most`` characters together; every text is in one."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, runs of non-letters as one space, a space at either end of a text; and their offsets."""
    parts = [b" " + t.encode("utf-8", "replace").translate(FOLD) + b" " for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    space = data == 32
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    keep[starts[starts < len(data)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], np.concatenate([kept[starts], kept[ends[-1:]]]).astype(np.int64)


def grams(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All ``n``-byte grams inside the texts as integers, first byte highest, and their offsets by text."""
    total = max(0, len(data) - n + 1)
    value = np.zeros(total, np.uint32)
    for k in range(n):
        value = (value << np.uint32(8)) | data[k : k + total]
    inside = np.ones(total, bool)
    for k in range(1, n):  # grams that run over the end of a text
        at = offsets[1:] - k
        inside[at[(at >= 0) & (at < total)]] = False
    kept = np.concatenate([[0], np.cumsum(inside)])
    return value[inside], kept[np.minimum(offsets, total)]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each text (along the first axis); 0 for a text of none."""
    zero = np.zeros((1, *values.shape[1:]), np.float64)
    total = np.concatenate([zero, np.cumsum(values, axis=0, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]
