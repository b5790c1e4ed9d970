"""Page images in numpy: decoding, contrast, skew, ink and layout boxes, as plug-ins of the page stage.

Images are arrays of uint8, gray (height, width). Nothing but numpy is needed, so the page
stage runs end to end without an imaging library; a library's decoder or segmenter can take
the place of each of these. Everything works on whole arrays: sliding windows are running
sums, so a window costs the same whatever its size.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

Box = tuple[int, int, int, int]

# Decoding -------------------------------------------------------------------------------

_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _unfiltered(raw: bytes, rows: int, stride: int, step: int) -> np.ndarray:
    """The bytes of a PNG's rows with the row filters undone."""
    out = np.zeros((rows, stride), dtype=np.uint8)
    before = np.zeros(stride, dtype=np.uint8)
    for y in range(rows):
        kind, line = raw[y * (stride + 1)], np.frombuffer(raw, np.uint8, stride, y * (stride + 1) + 1).copy()
        if kind == 1:
            for c in range(step):
                line[c::step] = np.cumsum(line[c::step], dtype=np.uint64).astype(np.uint8)
        elif kind == 2:
            line += before
        elif kind in (3, 4):
            own, above = line.tolist(), before.tolist()
            for i in range(stride):
                a, b, c = own[i - step] if i >= step else 0, above[i], above[i - step] if i >= step else 0
                if kind == 3:
                    own[i] = (own[i] + (a + b) // 2) & 255
                else:
                    p = a + b - c
                    near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))
                    own[i] = (own[i] + near[2]) & 255
            line = np.array(own, dtype=np.uint8)
        elif kind:
            raise ValueError(f"unknown row filter {kind}")
        out[y] = before = line
    return out


def _png(content: bytes) -> np.ndarray:
    at, data, palette, head = 8, [], None, None
    while at + 8 <= len(content):
        size, kind = int.from_bytes(content[at : at + 4], "big"), content[at + 4 : at + 8]
        body = content[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = int.from_bytes(body[:4], "big"), int.from_bytes(body[4:8], "big"), body[8], body[9], body[12]
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data.append(body)
        at += size + 12
    if head is None:
        raise ValueError("a PNG without a header")
    width, height, depth, color, interlaced = head
    if interlaced or depth not in (1, 8) or depth == 1 and color not in (0, 3):
        raise ValueError(f"unsupported PNG: depth {depth}, color {color}, interlaced {interlaced}")
    stride = -(-width * _CHANNELS[color] * depth // 8)
    rows = _unfiltered(zlib.decompress(b"".join(data)), height, stride, max(_CHANNELS[color] * depth // 8, 1))
    if depth == 1:
        rows = np.unpackbits(rows, axis=1)[:, :width] * (255 if color == 0 else 1)
    if color == 3:
        return palette[rows]
    pixels = rows.reshape(height, width, _CHANNELS[color])
    return pixels[:, :, 0] if color in (0, 4) else pixels[:, :, :3]


def _pnm(content: bytes) -> np.ndarray:
    fields: list[bytes] = []
    at = 0
    while len(fields) < 4:
        end = at
        while end < len(content) and not content[end : end + 1].isspace():
            end += 1
        word = content[at:end]
        if word.startswith(b"#"):
            end = content.index(b"\n", at)
        elif word:
            fields.append(word)
        at = end + 1
    width, height = int(fields[1]), int(fields[2])
    channels = 1 if fields[0] == b"P5" else 3
    if int(fields[3]) != 255:
        raise ValueError("only 8 bits a sample")
    return np.frombuffer(content, np.uint8, width * height * channels, at).reshape((height, width) if channels == 1 else (height, width, 3))


class PlainDecoder:
    """PNG (8 bits, or 1 bit without colours) and binary PGM and PPM to gray images; other formats raise ValueError."""

    def load(self, content: bytes, path: str) -> np.ndarray:
        if content.startswith(b"\x89PNG\r\n\x1a\n"):
            return gray(_png(content))
        if content[:2] in (b"P5", b"P6"):
            return gray(_pnm(content))
        raise ValueError(f"unsupported format: {path}")


# Contrast -------------------------------------------------------------------------------


def gray(image: np.ndarray) -> np.ndarray:
    """Luma of a colour image, rounded; a gray one as it is."""
    if image.ndim == 2:
        return image
    return ((image[:, :, :3].astype(np.uint32) @ np.array([19595, 38470, 7471], dtype=np.uint32) + 0x8000) >> 16).astype(np.uint8)


def stretched(image: np.ndarray) -> np.ndarray:
    """Darkest to 0, brightest to 255, linear between; an even image becomes 0."""
    low, high = int(image.min()), int(image.max())
    if low == high:
        return np.zeros_like(image)
    return np.rint((image.astype(np.float64) - low) * 255 / (high - low)).astype(np.uint8)


def contrasted(image: np.ndarray, factor: float = 1.05) -> np.ndarray:
    """Distances from the mean enlarged."""
    mean = int(image.mean() + 0.5)
    return np.clip(mean + (image.astype(np.float64) - mean) * factor, 0, 255).astype(np.uint8)


#: Preparation of an image by mode: the plain one and the one that enlarges contrast too.
MODES: dict[str, Callable[[np.ndarray], np.ndarray]] = {"none": lambda x: x, "gray": gray, "light": lambda x: stretched(gray(x))}
STRONGER = MODES | {"light": lambda x: contrasted(stretched(gray(x)))}


def prepared(image: np.ndarray, mode: str = "none", modes: dict = MODES) -> np.ndarray:
    """The image in a mode of ``modes``; an unknown mode raises ValueError."""
    if mode not in modes:
        raise ValueError(f"unknown mode {mode!r}; one of {', '.join(modes)}")
    return modes[mode](image)


def resized(image: np.ndarray, longest: int) -> np.ndarray:
    """Scaled down so that the longer edge is at most ``longest``, by means of areas; smaller images as they are."""
    height, width = image.shape[:2]
    scale = longest / max(height, width)
    if scale >= 1:
        return image
    rows, columns = (np.linspace(0, n, max(1, round(n * scale)) + 1).astype(int) for n in (height, width))
    total = np.add.reduceat(np.add.reduceat(gray(image).astype(np.float64), rows[:-1], axis=0), columns[:-1], axis=1)
    return np.rint(total / np.outer(np.diff(rows), np.diff(columns))).astype(np.uint8)


# Ink ------------------------------------------------------------------------------------


def otsu(image: np.ndarray) -> int:
    """The threshold that separates the two most different classes of gray."""
    counts = np.bincount(image.ravel(), minlength=256).astype(np.float64)
    below = np.cumsum(counts)
    mass = np.cumsum(counts * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = below * above * (mass / below - (mass[-1] - mass) / above) ** 2
    return int(np.nan_to_num(apart).argmax())


def _windowed(mask: np.ndarray, height: int, width: int) -> np.ndarray:
    """The sum over a window around each pixel, its centre right of and below the middle of an even one; 0 outside the image."""
    top, left = height // 2, width // 2
    padded = np.pad(mask.astype(np.int64), ((top, height - top - 1), (left, width - left - 1)))
    total = np.pad(padded.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
    return total[height:, width:] - total[:-height, width:] - total[height:, :-width] + total[:-height, :-width]


def dilated(mask: np.ndarray, height: int, width: int) -> np.ndarray:
    """Pixels with any of the mask in their window."""
    return _windowed(mask[::-1, ::-1], height, width)[::-1, ::-1] > 0


def eroded(mask: np.ndarray, height: int, width: int) -> np.ndarray:
    """Pixels with nothing but the mask in their window; outside the image counts as mask."""
    return _windowed(~mask, height, width) == 0


def ink(image: np.ndarray) -> np.ndarray:
    """Dark pixels, single ones removed by an opening of two by two."""
    return dilated(eroded(image <= otsu(image), 2, 2), 2, 2)


def components(mask: np.ndarray) -> np.ndarray:
    """Number from 1 of the 8-connected component of each pixel, 0 outside the mask.

    Runs of a row are joined to those of the row above, so the work goes with the runs.
    """
    labels = np.zeros(mask.shape, dtype=np.int32)
    parent = [0]

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    above: list[tuple[int, int, int]] = []
    runs: list[tuple[int, int, int, int]] = []
    for y, row in enumerate(mask):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], row, [False]]).astype(np.int8)))
        own, at = [], 0
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            while at < len(above) and above[at][1] < begin:
                at += 1
            k, label = at, 0
            while k < len(above) and above[k][0] <= end:
                other = root(above[k][2])
                if not label:
                    label = other
                elif other != label:
                    parent[max(label, other)] = label = min(label, other)
                k += 1
            if not label:
                parent.append(len(parent))
                label = len(parent) - 1
            own.append((begin, end, label))
            runs.append((y, begin, end, label))
        above = own
    names: dict[int, int] = {}
    for y, begin, end, label in runs:
        labels[y, begin:end] = names.setdefault(root(label), len(names) + 1)
    return labels


def component_boxes(labels: np.ndarray) -> tuple[list[Box], np.ndarray]:
    """The box and the pixels of each component, in order of their numbers."""
    ys, xs = np.nonzero(labels)
    n = int(labels.max(initial=0))
    if not n:
        return [], np.zeros(0, dtype=np.int64)
    own = labels[ys, xs] - 1
    low, high = np.full((n, 2), 1 << 30), np.zeros((n, 2), dtype=np.int64)
    np.minimum.at(low, own, np.stack([xs, ys], axis=1))
    np.maximum.at(high, own, np.stack([xs, ys], axis=1) + 1)
    return [(int(a), int(b), int(c), int(d)) for (a, b), (c, d) in zip(low, high)], np.bincount(own, minlength=n)


# Skew -----------------------------------------------------------------------------------


def content(image: np.ndarray, pad: int = 150, least_area: int = 500, least_ink: float = 0.001) -> np.ndarray:
    """The part with ink that doesn't touch the border, with a margin; the whole image where there is none."""
    dark = image <= otsu(image)
    height, width = image.shape
    if dark.mean() < least_ink:
        return image
    boxes, areas = component_boxes(components(dark))
    kept = [b for b, n in zip(boxes, areas) if n >= least_area and b[0] > 0 and b[1] > 0 and b[2] < width and b[3] < height]
    if not kept:
        return image
    x1, y1 = max(0, min(b[0] for b in kept) - pad), max(0, min(b[1] for b in kept) - pad)
    x2, y2 = min(width, max(b[2] for b in kept) + pad), min(height, max(b[3] for b in kept) + pad)
    return image[y1:y2, x1:x2]


def skew_by_profile(image: np.ndarray, most: float, step: float = 0.1) -> float:
    """The angle in degrees at which the rows of ink are told apart best: the variance of their sums."""
    ys, xs = np.nonzero(image <= otsu(image))
    if len(xs) < 2_000:
        return 0.0

    def sharp(angle: float) -> float:
        rows = np.rint(ys - xs * np.tan(np.radians(angle))).astype(np.int64)
        return float(np.bincount(rows - rows.min()).astype(np.float64).var())

    rough = max(np.arange(-most, most + 0.5, 0.5), key=sharp)
    return float(max(np.arange(rough - 0.5, rough + 0.5 + step / 2, step), key=sharp))


def skew_by_rectangle(image: np.ndarray, most: float) -> float:
    """The angle of the smallest rectangle around the ink, between -45 and 45; 0 beyond ``most`` or with little ink."""
    ys, xs = np.nonzero(image <= otsu(image))
    if len(xs) < 2_000:
        return 0.0
    points = np.unique(np.stack([xs, ys], axis=1), axis=0)

    def half(order) -> list:
        out: list = []
        for p in order:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    rows = points.tolist()
    hull = np.array(half(rows) + half(rows[::-1]), dtype=np.float64)
    edges = np.roll(hull, -1, axis=0) - hull
    angles = np.unique(np.mod(np.arctan2(edges[:, 1], edges[:, 0]), np.pi / 2))
    turned = np.stack([np.cos(angles), np.sin(angles)], axis=1) @ hull.T, np.stack([-np.sin(angles), np.cos(angles)], axis=1) @ hull.T
    best = float(np.degrees(angles[(np.ptp(turned[0], axis=1) * np.ptp(turned[1], axis=1)).argmin()]))
    best = best - 90 if best > 45 else best
    return best if abs(best) <= most else 0.0


SKEWS: dict[str, Callable[[np.ndarray, float], float]] = {"none": lambda image, most: 0.0, "profile": skew_by_profile, "minarea": skew_by_rectangle}


def turned(image: np.ndarray, angle: float) -> np.ndarray:
    """The image turned about its centre by an angle in degrees, between pixels linear, at the border repeated."""
    height, width = image.shape
    cos, sin = np.cos(np.radians(angle)), np.sin(np.radians(angle))
    y, x = np.indices(image.shape, dtype=np.float64)
    x, y = x - width // 2, y - height // 2
    sx, sy = np.clip(cos * x - sin * y + width // 2, 0, width - 1), np.clip(sin * x + cos * y + height // 2, 0, height - 1)
    x0, y0 = sx.astype(int), sy.astype(int)
    x1, y1, fx, fy = np.minimum(x0 + 1, width - 1), np.minimum(y0 + 1, height - 1), sx - x0, sy - y0
    rows = image.astype(np.float64)
    return np.rint((rows[y0, x0] * (1 - fx) + rows[y0, x1] * fx) * (1 - fy) + (rows[y1, x0] * (1 - fx) + rows[y1, x1] * fx) * fy).astype(np.uint8)


def deskewed(image: np.ndarray, method: str = "profile", most: float = 20.0, least: float = 0.1) -> tuple[np.ndarray, float]:
    """The image turned straight and the angle; as it is and 0 below ``least`` degrees or beyond ``most``."""
    if method not in SKEWS:
        raise ValueError(f"unknown method {method!r}; one of {', '.join(SKEWS)}")
    angle = SKEWS[method](content(image), most) if method != "none" else 0.0
    if not least <= abs(angle) <= most:
        return image, 0.0
    return turned(image, angle), angle


# Layout ---------------------------------------------------------------------------------


def candidate_boxes(image: np.ndarray, least_area: int = 3_000, window: int = 101, more: float = 10.0) -> list[Box]:
    """Boxes of dark stretches: smeared ink that is darker than its surroundings, closed and widened to blocks."""
    dark = 255.0 - image

    def mean(a: np.ndarray, n: int) -> np.ndarray:
        side = n // 2
        padded = np.pad(a, side, mode="edge")
        total = np.pad(padded.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
        return (total[n:, n:] - total[:-n, n:] - total[n:, :-n] + total[:-n, :-n]) / (n * n)

    smeared = mean(mean(dark, 15), 15)  # twice a box is nearly a bell
    blocks = smeared > mean(smeared, window) + more
    closed = eroded(dilated(blocks, 25, 25), 25, 25)
    found, _ = component_boxes(components(dilated(closed, 25, 50)))
    return [b for b in found if (b[2] - b[0]) * (b[3] - b[1]) >= least_area]


@dataclass(frozen=True)
class Layout:
    """What small boxes are judged by, and when a page counts as one dominant box. Defaults are fixed values."""

    big_width: int = 100
    big_height: int = 100
    least_ink: float = 0.0018
    blob_area: int = 25
    blobs: int = 2
    inner: float = 0.08
    nested: float = 0.7
    overlap: float = 0.15
    near: int = 20
    band: float = 0.2
    order: float = 0.3
    dominant: float = 0.55


def holds_text(box: Box, dark: np.ndarray, labels: np.ndarray, c: Layout = Layout()) -> bool:
    """Whether a small box has ink enough inside its margin, in several blobs; large ones always do."""
    x1, y1, x2, y2 = box
    width, height = x2 - x1, y2 - y1
    if width > c.big_width and height > c.big_height:
        return True
    mx, my = int(c.inner * width), int(c.inner * height)
    ax, ay = min(x2 - 1, x1 + mx), min(y2 - 1, y1 + my)
    part = np.s_[ay : max(ay + 1, y2 - my), ax : max(ax + 1, x2 - mx)]
    if not dark[part].size or dark[part].mean() < c.least_ink:
        return False
    own = labels[part]
    return int((np.bincount(own[own > 0]) >= c.blob_area).sum()) >= c.blobs


def _bands(boxes: list[Box], least: float) -> list[list[Box]]:
    out: list[list[Box]] = []
    for b in sorted(boxes, key=lambda b: (b[1], b[0], b[2], b[3])):
        def fits(m: Box, b: Box = b) -> bool:
            return (min(m[3], b[3]) - max(m[1], b[1])) / max(min(m[3] - m[1], b[3] - b[1]), 1) >= least

        group = next((g for g in out if any(map(fits, g))), None)
        out.append([b]) if group is None else group.append(b)
    return out


def title_and_columns(image: np.ndarray, box: Box, title: float = 0.22, least: int = 60, valley: float = 0.75, margin: float = 0.1) -> list[Box]:
    """A dominant box as title and body, or as title and two columns where the ink below has a valley."""
    x1, y1, x2, y2 = box
    cut = y1 + min(max(least, int(title * (y2 - y1))), y2 - y1 - least)
    columns = (image[cut:y2, x1:x2] < 200).sum(axis=0)
    edge = max(5, int(margin * (x2 - x1)))
    middle = columns[edge : x2 - x1 - edge]
    if middle.size and middle.max() > 0 and middle.min() / middle.max() < valley:
        at = x1 + edge + int(middle.argmin())
        return [(x1, y1, x2, cut), (x1, cut, at, y2), (at, cut, x2, y2)]
    return [(x1, y1, x2, cut), (x1, cut, x2, y2)]


def layout(image: np.ndarray, c: Layout = Layout()) -> list[Box]:
    """The blocks of a page in reading order: candidates, nested and empty ones out, fused, one a band, a dominant one split."""
    from vellumine.functions.boxes import _fuse, _outer

    dark = ink(image)
    labels = components(dark)
    kept = [b for b in _outer(candidate_boxes(image), c.nested) if holds_text(b, dark, labels, c)]
    merged = [(min(b[0] for b in g), min(b[1] for b in g), max(b[2] for b in g), max(b[3] for b in g)) for g in _bands(_fuse(kept, c.overlap, c.near), c.band)]
    if len(merged) == 1 and (merged[0][2] - merged[0][0]) * (merged[0][3] - merged[0][1]) > c.dominant * image.size:
        merged = title_and_columns(image, merged[0])
    return [b for g in _bands(merged, c.order) for b in sorted(g)]


class BlockSegmenter:
    """A segmenter of the page stage: a gray image, turned straight once, to its blocks."""

    def __init__(self, method: str = "profile", most: float = 20.0, c: Layout = Layout()):
        self.method, self.most, self.c = method, most, c

    def process(self, image: np.ndarray) -> list[tuple[np.ndarray, Box]]:
        straight, _ = deskewed(image, self.method, self.most)
        return [(straight[y1:y2, x1:x2], (x1, y1, x2, y2)) for x1, y1, x2, y2 in layout(straight, self.c)]
