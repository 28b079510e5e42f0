"""Anchors: places in byte strings that are chosen by content, so that equal stretches have equal anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from goldthread.llm.words import Hashed

GRAM = 32


def slice_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a large-string array and the bounds of its texts."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    if not len(texts) or raw is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by running minima of blocks from both sides."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, values.dtype)
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1:width - 1 + n])


def anchored(data: np.ndarray, bounds: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """All windows of ``length`` bytes inside texts, gathered by the anchor they choose.

    The anchor of a window is the first of its 32-byte grams with the least hash, so equal windows choose it at the
    same place. Windows that follow each other share anchors; a row is such a run: ``text``, ``start`` (of its first
    window, within the text), ``windows``, ``lead`` (bytes before the anchor), the hash of the gram, and that of the run's bytes.
    """
    hashed = Hashed(data)
    n = max(len(data) - length + 1, 0)
    places = np.arange(max(len(data) - GRAM + 1, 0))
    grams = hashed.of(places, places + GRAM)
    order = (grams & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64)
    anchor = (window_least(order, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    inside = np.flatnonzero(np.arange(n) + length <= bounds[text + 1]) if n else np.zeros(0, np.int64)
    if not len(inside):
        none = np.zeros(0, np.int64)
        return {"text": none, "start": none, "windows": none, "lead": none, "gram": none, "bytes": none, "at": none}
    new = np.ones(len(inside), bool)
    new[1:] = (anchor[inside[1:]] != anchor[inside[:-1]]) | (text[inside[1:]] != text[inside[:-1]])
    head = np.flatnonzero(new)
    first = inside[head]
    windows = np.diff(np.append(head, len(inside)))
    at = anchor[first]
    return {"text": text[first], "start": first - bounds[text[first]], "windows": windows, "lead": at - first,
            "gram": grams[at].view(np.int64), "bytes": hashed.of(first, first + windows + length - 1).view(np.int64), "at": first}
