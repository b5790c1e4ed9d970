"""Images in numpy against brute force, and the page stage from bytes to texts."""

import struct
import zlib

import numpy as np
import pytest

from vellumine.operators import images, pages


def png(a, kind=0):
    """A gray PNG with one row filter all over."""
    rows, before = [], np.zeros(a.shape[1], dtype=np.int64)
    for row in a.astype(np.int64):
        left, corner = np.concatenate([[0], row[:-1]]), np.concatenate([[0], before[:-1]])
        p = left + before - corner
        near = np.where((abs(p - left) <= abs(p - before)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - before) <= abs(p - corner), before, corner))
        guess = [0, left, before, (left + before) // 2, near][kind]
        rows.append(bytes([kind]) + ((row - guess) % 256).astype(np.uint8).tobytes())
        before = row
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")


def page():
    """Lines of blobs in two columns under a title."""
    a = np.full((900, 700), 255, dtype=np.uint8)
    for x0, x1, y0, y1 in ((80, 620, 60, 110), (80, 330, 250, 820), (370, 620, 250, 820)):
        for y in range(y0, y1 - 12, 20):
            for x in range(x0, x1 - 10, 14):
                a[y : y + 12, x : x + 10] = 10
    return a


def test_decoding():
    random = np.random.default_rng(1)
    a = random.integers(0, 256, (9, 7), dtype=np.uint8)
    for kind in range(5):
        assert (images.PlainDecoder().load(png(a, kind), "x.png") == a).all()
    assert (images.PlainDecoder().load(b"P5\n# c\n7 9\n255\n" + a.tobytes(), "x.pgm") == a).all()
    color = random.integers(0, 256, (2, 3, 3), dtype=np.uint8)
    assert images.PlainDecoder().load(b"P6 3 2 255\n" + color.tobytes(), "x.ppm").shape == (2, 3)
    with pytest.raises(ValueError):
        images.PlainDecoder().load(b"GIF89a", "x.gif")


def test_contrast_and_size():
    a = np.array([[10, 20], [30, 110]], dtype=np.uint8)
    assert images.prepared(a, "light").tolist() == [[0, 26], [51, 255]] and images.prepared(a, "none") is a and images.stretched(a * 0 + 7).max() == 0
    assert images.prepared(a, "light", images.STRONGER).max() == 255
    with pytest.raises(ValueError):
        images.prepared(a, "odd")
    assert images.resized(np.full((100, 50), 9, dtype=np.uint8), 40).shape == (40, 20) and images.resized(a, 40) is a


def test_windows_and_components_by_brute_force():
    random = np.random.default_rng(2)
    for _ in range(30):
        m = random.random((12, 15)) < 0.4
        grown = images.dilated(m, 3, 5)
        want = np.zeros_like(m)
        for y, x in zip(*np.nonzero(m)):
            want[max(0, y - 1) : y + 2, max(0, x - 2) : x + 3] = True
        assert (grown == want).all() and (images.eroded(m, 3, 3) <= m).all()
        labels, seen = images.components(m), np.zeros_like(m, dtype=int)
        n = 0
        for start in zip(*np.nonzero(m)):
            if not seen[start]:
                n += 1
                todo = [start]
                while todo:
                    y, x = todo.pop()
                    if 0 <= y < 12 and 0 <= x < 15 and m[y, x] and not seen[y, x]:
                        seen[y, x] = n
                        todo += [(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        assert labels.max() == n and len({(a, b) for a, b in zip(labels[m], seen[m])}) == n
        boxes, areas = images.component_boxes(labels)
        assert len(boxes) == n and areas.sum() == m.sum()
    assert images.component_boxes(np.zeros((3, 3), dtype=int))[0] == []


@pytest.mark.parametrize("method", ["profile", "minarea"])
def test_skew(method):
    for angle in (-4.0, 3.0):
        tilted = images.turned(page(), angle)
        straight, found = images.deskewed(tilted, method)
        assert abs(found + angle) < 0.6 and straight.shape == tilted.shape
    assert images.deskewed(page(), "none")[1] == 0.0 and images.deskewed(np.full((50, 50), 255, np.uint8), method)[1] == 0.0
    with pytest.raises(ValueError):
        images.deskewed(page(), "odd")


def test_layout():
    found = images.layout(page())
    assert found == images.layout(page()) and found[0][1] < 110 and all(b[2] > b[0] and b[3] > b[1] for b in found)
    assert images.layout(np.full((300, 300), 255, np.uint8)) == []
    solid = np.full((900, 700), 255, dtype=np.uint8)
    solid[250:820, 80:330] = solid[250:820, 370:620] = 0
    assert images.title_and_columns(solid, (60, 40, 640, 840))[1:] == [(60, 216, 330, 840), (330, 216, 640, 840)]
    small = np.zeros((200, 200), dtype=bool)
    small[50:56, 50:56] = small[60:66, 60:66] = True
    assert images.holds_text((40, 40, 80, 80), small, images.components(small)) and not images.holds_text((100, 100, 140, 140), small, images.components(small))


class Counting:
    def run_blocks(self, blocks):
        return [f"block of {(b < 128).sum()} dark pixels" for b in blocks]


def test_page_stage_from_bytes(spark):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    read = spark.sparkContext.accumulator(0)
    files = spark.createDataFrame([("a.png", bytearray(png(page()))), ("b.gif", bytearray(b"GIF")), ("c.pgm", bytearray(b"P5 20 20 255\n" + b"\xff" * 400))], "path string, content binary")
    got = {r["path"]: r for r in pages.page_texts(pages.read_pages(files, images.PlainDecoder, images.BlockSegmenter, Counting, progress=read)).collect()}
    assert got["a.png"]["status"] == "ok" and got["a.png"]["ocr_text"].count("block of") == got["a.png"]["n_blocks"] > 0
    assert got["b.gif"]["status"] == "error" and "unsupported format" in got["b.gif"]["error"] and got["c.pgm"]["status"] == "empty" and read.value >= 3
