"""A minimal 8-bit RGBA PNG encoder for the image-source tests."""

import struct
import zlib


def png_rgba(width: int, height: int, rgba: bytes) -> bytes:
    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)
    stride = width * 4
    raw = b"".join(b"\x00" + rgba[r * stride:(r + 1) * stride] for r in range(height))
    ihdr = struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")
