"""TIFF files: round trips of all layouts, known bytes, and what can't be read."""

import random

import numpy as np
import pytest

from lamella.kernels import masks, resample
from lamella.sources import tiff, tiles

KINDS = [tiff.NONE, tiff.PACKBITS, tiff.LZW, tiff.DEFLATE]


def _images():
    r = np.random.default_rng(1)
    flat = np.zeros((40, 70), np.uint8)
    flat[5:20, 10:60] = 9
    return [tiles.texture((50, 61)), flat, r.integers(0, 65536, (33, 47), dtype=np.uint16), r.integers(0, 3, (90, 100), dtype=np.uint8), np.full((1, 1), 7, np.uint8)]


@pytest.mark.parametrize("compression", KINDS)
@pytest.mark.parametrize("layout", [{}, {"rows": 7}, {"tile": (16, 32)}, {"tile": (16, 16), "differences": True}, {"rows": 16, "differences": True, "order": ">"}])
def test_round_trip(compression, layout):
    for image in _images():
        content = tiff.write(image, compression, **layout)
        got = tiff.read(content)
        assert got.dtype == image.dtype and (got == image).all()
        assert (tiles.decode(content) == (image >> 8 if image.dtype == np.uint16 else image)).all()


def test_known_bytes():
    # The example of the format's description of PackBits, and a hand-made LZW stream: 7 7 7 8 8 7 7 6 6.
    packed = bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA")
    assert tiff.unpack_bits(packed) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")
    assert tiff.unpack_bits(b"\x80\x00\x05") == b"\x05"
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    bits = "".join(f"{c:09b}" for c in codes)
    data = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert tiff.lzw_decode(data) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6]) and tiff.lzw_encode(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])) == data


@pytest.mark.parametrize("pack", [(tiff.pack_bits, tiff.unpack_bits), (tiff.lzw_encode, tiff.lzw_decode)])
def test_packings_of_any_bytes(pack):
    r = random.Random(3)
    for n in (0, 1, 2, 3, 127, 128, 129, 300, 5000, 20000):
        for span in (1, 2, 256):
            data = bytes(r.randrange(span) for _ in range(n))
            assert pack[1](pack[0](data)) == data


def test_white_is_zero():
    image = tiles.texture((20, 30))
    content = bytearray(tiff.write(image))
    at = content.index(b"\x06\x01\x04\x00\x01\x00\x00\x00") + 8
    content[at] = 0
    assert (tiff.read(bytes(content)) == 255 - image).all()


def test_broken_files():
    image = tiles.texture((40, 40))
    good = tiff.write(image, tiff.LZW)
    for content in (b"", b"II*\0", good[:60], b"II*\0" + b"\0" * 40, tiff.write(image, tiff.DEFLATE).replace(b"x\x9c", b"zz", 1)):
        with pytest.raises(Exception):  # noqa: B017, PT011
            tiles.decode(content)


def test_compressed_folder_with_masks(spark, tmp_path):
    """Files of each kind read by Spark, with masks; a broken one is null."""
    image = np.full((64, 64), 3, np.uint8)
    image[10:50, 12:40] = tiles.texture((40, 28)) // 2 + 120
    for k in KINDS:
        (tmp_path / f"{k}.tif").write_bytes(tiff.write(image, k, tile=(32, 16)))
    (tmp_path / "bad.tif").write_bytes(tiff.write(image, tiff.DEFLATE).replace(b"x\x9c", b"zz", 1))
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    got = {r.path.rpartition("/")[2]: r for r in tiles.load(files, scale=0.5, background=5).collect()}
    assert got.pop("bad.tif").px is None and len(got) == 4
    for r in got.values():
        assert (np.frombuffer(r.px, np.uint8).reshape(r.h, r.w) == resample.resample(image, 0.5)).all()
        assert (np.frombuffer(r.mask, bool).reshape(r.h, r.w) == resample.resample(masks.foreground(image, 5), 0.5)).all()
    assert 0 < np.frombuffer(got["5.tif"].mask, bool).mean() < 1
    assert tiles.load(files).columns == ["path", "h", "w", "px"]
