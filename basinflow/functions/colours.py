"""Colour tables and palette PNG files."""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Anchor colours of public sequential schemes, from low to high.
SCHEMES = {
    "Reds": ("fff5f0", "fee0d2", "fcbba1", "fc9272", "fb6a4a", "ef3b2c", "cb181d", "a50f15", "67000d"),
    "Blues": ("f7fbff", "deebf7", "c6dbef", "9ecae1", "6baed6", "4292c6", "2171b5", "08519c", "08306b"),
    "Greens": ("f7fcf5", "e5f5e0", "c7e9c0", "a1d99b", "74c476", "41ab5d", "238b45", "006d2c", "00441b"),
    "viridis": ("440154", "482878", "3e4989", "31688e", "26828e", "1f9e89", "35b779", "6ece58", "b5de2b", "fde725"),
}


def colour_table(name: str, levels: int = 256) -> np.ndarray:
    """``levels`` RGB colours by linear interpolation between a scheme's anchors; an unknown name is Reds."""
    anchors = np.array([[int(c[i : i + 2], 16) for i in (0, 2, 4)] for c in SCHEMES.get(name, SCHEMES["Reds"])], float)
    at = np.linspace(0, len(anchors) - 1, levels)
    return np.stack([np.interp(at, np.arange(len(anchors)), anchors[:, k]) for k in range(3)], 1).astype(np.uint8)


def palette_png(levels: np.ndarray, valid: np.ndarray, name: str) -> bytes:
    """A palette image in which index 0 alone is transparent; ``levels`` are 0..255, folded to 255 colours."""
    height, width = levels.shape
    index = np.where(valid, 1 + (levels.astype(int) * 254 // 255), 0).astype(np.uint8)
    table = np.concatenate([np.zeros((1, 3), np.uint8), colour_table(name, 255)])

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = np.concatenate([np.zeros((height, 1), np.uint8), index], axis=1).tobytes()
    header = struct.pack(">IIBBBBB", width, height, 8, 3, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"PLTE", table.tobytes()) + chunk(b"tRNS", b"\0") + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
