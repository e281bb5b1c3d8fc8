"""Grey TIFF images in memory: strips and tiles, uncompressed, PackBits, LZW and Deflate, with or without differences.

One function reads, one writes; both work on the bytes of one file, which a task
holds whole.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Fixed values of the TIFF 6.0 format: tags, and bytes and codes of field types.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, STRIP_ROWS, STRIP_SIZES = 256, 257, 258, 259, 262, 273, 277, 278, 279
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_SIZES = 317, 322, 323, 324, 325
FIELDS = {1: (1, "B"), 3: (2, "H"), 4: (4, "I")}
# Compressions.
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
# Fixed values of LZW in TIFF: codes that start over and end, and the longest code.
CLEAR, END, LONGEST = 256, 257, 12


def unpack_bits(data: bytes) -> bytes:
    out, at = [], 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + n + 2])
            at += n + 2
        else:
            if n > 128:
                out.append(data[at + 1 : at + 2] * (257 - n))
            at += 2 if n > 128 else 1
    return b"".join(out)


def pack_bits(data: bytes) -> bytes:
    """Runs of three or more as a count, all else as it is."""
    values = np.frombuffer(data, np.uint8)
    starts = np.concatenate(([0], np.flatnonzero(np.diff(values)) + 1, [len(values)])) if len(values) else np.zeros(1, int)
    out, plain = [], b""

    def flush() -> None:
        nonlocal plain
        for a in range(0, len(plain), 128):
            part = plain[a : a + 128]
            out.append(bytes([len(part) - 1]) + part)
        plain = b""

    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a < 3:
            plain += data[a:b]
            continue
        flush()
        for k in range(a, b, 128):
            n = min(128, b - k)
            out.append(bytes([257 - n]) + data[a : a + 1] if n > 1 else bytes([0]) + data[a : a + 1])
    flush()
    return b"".join(out)


def lzw_decode(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bits first; they grow one entry before the table would need it."""
    table: list[bytes] = []
    out, held, bits, width, before = [], 0, 0, 9, None
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == END:
            break
        if code == CLEAR:
            table, width, before = [bytes([i]) for i in range(256)] + [b"", b""], 9, None
            continue
        if before is None:
            if code >= len(table):
                raise ValueError("bad LZW code")
            entry = table[code]
        else:
            if code > len(table):
                raise ValueError("bad LZW code")
            entry = table[code] if code < len(table) else before + before[:1]
            table.append(before + entry[:1])
            if len(table) + 1 >= 1 << width and width < LONGEST:
                width += 1
        out.append(entry)
        before = entry
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    out, held, bits = bytearray(), 0, 0
    width, table = 9, {bytes([i]): i for i in range(256)}
    following = 258

    def put(code: int) -> None:
        nonlocal held, bits
        held, bits = (held << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits)
            held &= (1 << bits) - 1

    put(CLEAR)
    run = b""
    for i in range(len(data)):
        longer = run + data[i : i + 1]
        if longer in table:
            run = longer
            continue
        put(table[run])
        table[longer] = following
        following += 1
        run = data[i : i + 1]
        if following >= (1 << LONGEST) - 2:
            put(CLEAR)
            width, table, following = 9, {bytes([i]): i for i in range(256)}, 258
        elif following >= 1 << width:
            width += 1
    if run:
        put(table[run])
        following += 1
        if following >= 1 << width and width < LONGEST:
            width += 1
    put(END)
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


def _expanded(data: bytes, how: int) -> bytes:
    if how == NONE:
        return data
    if how == PACKBITS:
        return unpack_bits(data)
    if how == LZW:
        return lzw_decode(data)
    if how in (DEFLATE, OLD_DEFLATE):
        return zlib.decompressobj().decompress(data)
    raise ValueError(f"compression {how} can't be read")


def _tags(content: bytes) -> tuple[str, dict[int, tuple[int, ...]]]:
    order = {b"II": "<", b"MM": ">"}.get(content[:2])
    if not order or struct.unpack(order + "H", content[2:4])[0] != 42:
        raise ValueError("no TIFF")
    at = struct.unpack(order + "I", content[4:8])[0]
    tags = {}
    for k in range(struct.unpack_from(order + "H", content, at)[0]):
        place = at + 2 + 12 * k
        tag, kind, n = struct.unpack_from(order + "HHI", content, place)
        if kind in FIELDS:
            size, code = FIELDS[kind]
            start = place + 8 if n * size <= 4 else struct.unpack_from(order + "I", content, place + 8)[0]
            tags[tag] = struct.unpack_from(order + code * n, content, start)
    return order, tags


def read(content: bytes) -> np.ndarray:
    """The first image of a file: (h, w) of 8 or 16 bits, 0 for black. What can't be read is a ValueError."""
    order, tags = _tags(content)
    one = lambda tag, default=None: tags.get(tag, (default,))[0]
    h, w, bits = one(HEIGHT), one(WIDTH), one(BITS, 1)
    if one(SAMPLES, 1) != 1 or bits not in (8, 16) or not h or not w:
        raise ValueError("only grey images of 8 or 16 bits can be read")
    kind = np.uint8 if bits == 8 else np.dtype(order + "u2")
    tiled = TILES in tags
    ph, pw = (one(TILE_HEIGHT), one(TILE_WIDTH)) if tiled else (min(one(STRIP_ROWS, h), h), w)
    starts, sizes = (tags[TILES], tags[TILE_SIZES]) if tiled else (tags[STRIPS], tags[STRIP_SIZES])
    across, down = -(-w // pw), -(-h // ph)
    if len(starts) < across * down:
        raise ValueError("pieces are missing")
    out = np.zeros((down * ph, across * pw), np.uint8 if bits == 8 else np.uint16)
    for k in range(across * down):
        y, x = k // across * ph, k % across * pw
        rows = ph if tiled else min(ph, h - y)
        data = _expanded(content[starts[k] : starts[k] + sizes[k]], one(COMPRESSION, NONE))
        if len(data) < rows * pw * bits // 8:
            raise ValueError("a piece is too short")
        piece = np.frombuffer(data, kind, rows * pw).reshape(rows, pw).astype(out.dtype)
        if one(PREDICTOR, 1) == 2:
            piece = np.cumsum(piece, axis=1, dtype=out.dtype)
        elif one(PREDICTOR, 1) != 1:
            raise ValueError("unknown predictor")
        out[y : y + rows, x : x + pw] = piece
    out = out[:h, :w]
    return np.iinfo(out.dtype).max - out if one(PHOTOMETRIC, 1) == 0 else out


def write(image: np.ndarray, compression: int = NONE, tile: tuple[int, int] | None = None, rows: int | None = None, differences: bool = False, order: str = "<") -> bytes:
    """A file of one grey image of 8 or 16 bits, in strips of so many rows (all, if None) or tiles (h, w: multiples of 16)."""
    h, w = image.shape
    ph, pw = tile or (min(rows or h, h), w)
    pack = {NONE: bytes, PACKBITS: pack_bits, LZW: lzw_encode, DEFLATE: zlib.compress}[compression]
    kind = image.dtype.newbyteorder(order)
    pieces = []
    for y in range(0, h, ph):
        for x in range(0, w, pw):
            piece = image[y : y + ph, x : x + pw]
            if tile:
                piece = np.pad(piece, ((0, ph - piece.shape[0]), (0, pw - piece.shape[1])))
            if differences:
                piece = np.diff(piece, axis=1, prepend=np.zeros((len(piece), 1), image.dtype))
            pieces.append(pack(piece.astype(kind).tobytes()))
    places = np.cumsum([8, *[len(p) + len(p) % 2 for p in pieces]]).tolist()
    fields = {WIDTH: (w,), HEIGHT: (h,), BITS: (image.dtype.itemsize * 8,), COMPRESSION: (compression,), PHOTOMETRIC: (1,), SAMPLES: (1,), PREDICTOR: (2 if differences else 1,)}
    fields |= {TILE_WIDTH: (pw,), TILE_HEIGHT: (ph,), TILES: places[:-1], TILE_SIZES: [len(p) for p in pieces]} if tile else {STRIP_ROWS: (ph,), STRIPS: places[:-1], STRIP_SIZES: [len(p) for p in pieces]}
    end = places[-1]
    entries, more = b"", b""
    for tag, values in sorted(fields.items()):
        data = struct.pack(f"{order}{len(values)}I", *values)
        if len(values) > 1:
            data, more = struct.pack(order + "I", end + 2 + 12 * len(fields) + 4 + len(more)), more + data
        entries += struct.pack(order + "HHI", tag, 4, len(values)) + data
    head = (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, end)
    return head + b"".join(p + b"\0" * (len(p) % 2) for p in pieces) + struct.pack(order + "H", len(fields)) + entries + struct.pack(order + "I", 0) + more
