"""Image kernels, as steps over images(img_id, height, width, data).

data holds gray bytes by rows. A step looks at one image, decides whether it
needs treatment, and returns it treated or as it was. Images are independent:
they stay in their task, several steps pass over each while it is there, and
nothing shuffles. Images without pixels pass unchanged."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

Image = np.ndarray
SCHEMA = "img_id long, height int, width int, data binary"


def _stack(img: Image, size: int, mode: str = "edge") -> Image:
    """height x width x size x size: the surroundings of every pixel."""
    return np.lib.stride_tricks.sliding_window_view(np.pad(img.astype(float), size // 2, mode=mode), (size, size))


def _weigh(img: Image, kernel: Image, mode: str = "reflect") -> Image:
    return np.einsum("hwij,ij->hw", _stack(img, len(kernel), mode if min(img.shape) > len(kernel) // 2 else "edge"), kernel)


def _bell(size: int, sigma: float) -> Image:
    x = np.exp(-0.5 * ((np.arange(size) - size // 2) / sigma) ** 2)
    return np.outer(x, x) / x.sum() ** 2


def _bytes(img: Image) -> Image:
    return np.clip(np.rint(img), 0, 255).astype(np.uint8)


def laplacian(img: Image) -> Image:
    return _weigh(img, np.array([[0, 1, 0], [1, -4, 1], [0, 1, 0]], float))


def cross_gradient(img: Image) -> Image:
    """Mixed second derivative, smoothed along both axes."""
    return _weigh(img, np.array([[1, 0, -1], [0, 0, 0], [-1, 0, 1]], float))


def median_filter(img: Image, size: int) -> Image:
    return np.median(_stack(img, size), axis=(2, 3)).astype(np.uint8)


def bilateral(img: Image, size: int, color: float, space: float) -> Image:
    """A mean of the neighbours, weighted by nearness in place and in value."""
    near = _stack(img, size, "reflect" if min(img.shape) > size // 2 else "edge")
    r = np.arange(size) - size // 2
    place = np.exp(-(r[:, None] ** 2 + r[None, :] ** 2) / (2 * space**2)) * (r[:, None] ** 2 + r[None, :] ** 2 <= (size // 2) ** 2)
    w = np.exp(-((near - img[:, :, None, None]) ** 2) / (2 * color**2)) * place
    return _bytes((w * near).sum((2, 3)) / w.sum((2, 3)))


def equalize(img: Image, clip: float, grid: int = 8) -> Image:
    """Adaptive histogram equalisation: the clipped histograms of grid x grid
    tiles give maps, which are blended between tile centres."""
    h, w = img.shape
    rows, cols = np.linspace(0, h, min(grid, h) + 1).astype(int), np.linspace(0, w, min(grid, w) + 1).astype(int)
    maps = np.zeros((len(rows) - 1, len(cols) - 1, 256))
    for i in range(len(rows) - 1):
        for j in range(len(cols) - 1):
            tile = img[rows[i] : rows[i + 1], cols[j] : cols[j + 1]]
            hist = np.bincount(tile.ravel(), minlength=256).astype(float)
            limit = max(1.0, clip * tile.size / 256)
            over = np.maximum(hist - limit, 0).sum()
            maps[i, j] = np.cumsum(np.minimum(hist, limit) + over / 256) * 255 / tile.size

    def between(edges: Image, n: int) -> tuple[Image, Image, Image]:
        centre = (edges[:-1] + edges[1:] - 1) / 2
        at = np.clip(np.interp(np.arange(n), centre, np.arange(len(centre))), 0, len(centre) - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, len(centre) - 1), at - low

    (r0, r1, fr), (c0, c1, fc) = between(rows, h), between(cols, w)
    look = lambda r, c: maps[r[:, None], c[None, :], img]
    fr, fc = fr[:, None], fc[None, :]
    return _bytes((1 - fr) * ((1 - fc) * look(r0, c0) + fc * look(r0, c1)) + fr * ((1 - fc) * look(r1, c0) + fc * look(r1, c1)))


def unsharp(img: Image, radius: float, amount: float) -> Image:
    size = 2 * int(np.ceil(3 * radius)) + 1
    return _bytes(img + amount * (img - _weigh(img, _bell(size, radius))))


def rotate(img: Image, degrees: float) -> Image:
    """Turned about its centre, by linear interpolation; edges are repeated."""
    h, w = img.shape
    t = np.deg2rad(degrees)
    y, x = np.mgrid[0:h, 0:w] - np.array([h // 2, w // 2])[:, None, None]
    sx, sy = np.cos(t) * x - np.sin(t) * y + w // 2, np.sin(t) * x + np.cos(t) * y + h // 2
    x0, y0 = np.clip(np.floor(sx), 0, w - 1).astype(int), np.clip(np.floor(sy), 0, h - 1).astype(int)
    x1, y1 = np.minimum(x0 + 1, w - 1), np.minimum(y0 + 1, h - 1)
    fx, fy = np.clip(sx - x0, 0, 1), np.clip(sy - y0, 0, 1)
    return _bytes((1 - fy) * ((1 - fx) * img[y0, x0] + fx * img[y0, x1]) + fy * ((1 - fx) * img[y1, x0] + fx * img[y1, x1]))


# ---- steps -------------------------------------------------------------------


def clean(img: Image, low_std: float = 15.0, salt: float = 0.015, clip: float = 2.0) -> Image:
    """Median where many values are extreme, equalising where contrast is low
    (twice if it stays so), and sharpening by how sharp the image is."""
    if ((img <= 5) | (img >= 250)).mean() > salt:
        img = median_filter(img, 3)
    for more in (0.0, 0.5):
        if img.std() < low_std:
            img = equalize(img, clip + more)
    focus = laplacian(img).var()
    gain = 1.2 if focus < 20 or img.std() <= 25 else 1.4 if focus < 60 else 1.1
    soft = _weigh(img, np.outer([1, 2, 1], [1, 2, 1]) / 16)
    return _bytes(gain * img + (1 - gain) * soft)


def salt_pepper(img: Image) -> Image:
    """The median in place of extreme pixels, where many of them stand alone;
    not where that costs edges."""
    lo, hi = np.percentile(img, [1, 99])
    extreme = (img <= int(max(0, lo))) | (img >= int(min(255, hi)))
    alone = extreme & (_stack(extreme, 3).sum((2, 3)) <= 1)
    share, number, size = (0.06, 10, 3) if img.size < 2000 else (0.03, 20, 3) if img.size < 10_000 else (0.015, 30, 5)
    if min(img.shape) >= 50:
        size = max(size, 5)
    if not (extreme.mean() > share and alone.sum() >= number):
        return img
    out = np.where(extreme, median_filter(img, size), img).astype(np.uint8)
    edges = lambda x: np.abs(cross_gradient(x)).mean()
    return img if edges(out) < 0.85 * edges(img) else out


def smooth(img: Image, focus: float = 80.0, size: int = 9, color: float = 75.0, space: float = 75.0) -> Image:
    return bilateral(img, size, color, space) if laplacian(img).var() < focus else img


def contrast(img: Image, ranged: float = 50.0, grid: int = 8) -> Image:
    span = float(img.max()) - float(img.min())
    needed = max(30.0, 0.6 * img.var()) if span > ranged else 20.0
    return equalize(img, min(3.0, max(1.0, 0.01 * span)), grid) if img.std() < needed else img


def sharpen(img: Image) -> Image:
    var = img.var()
    if np.abs(cross_gradient(img)).mean() >= max(30.0, 0.5 * var):
        return img
    return unsharp(img, float(np.clip(var - 0.02, 0.5, 2.0)), float(np.clip(var - 0.03, 1.0, 2.0)))


def moire(img: Image, percentile: float = 99.5, notch: float = 2.0, distance: float = 200.0) -> Image:
    """Peaks of the spectrum away from its centre, and their mirror images, are
    notched out."""
    h, w = img.shape
    reach = max(50, min(300, int(distance * max(h, w) / 2000)))
    spectrum = np.fft.fftshift(np.fft.fft2(img.astype(float)))
    strength = 20 * np.log(np.abs(spectrum) + 1)
    y, x = np.mgrid[0:h, 0:w]
    far = np.hypot(y - h // 2, x - w // 2) > reach
    if not far.any():
        return img
    peaks = np.argwhere(far & (strength > np.percentile(strength[far], percentile)))
    if not len(peaks):
        return img
    radius = max(2, min(6, int(notch * img.var() / 1000 * max(h, w) / 1000)))
    hit = np.zeros((h, w), bool)
    hit[peaks[:, 0], peaks[:, 1]] = True
    hit[np.clip(2 * (h // 2) - peaks[:, 0], 0, h - 1), np.clip(2 * (w // 2) - peaks[:, 1], 0, w - 1)] = True
    disc = [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1) if a * a + b * b <= radius * radius]
    wide = np.zeros_like(hit)
    at = np.argwhere(hit)
    for a, b in disc:
        wide[np.clip(at[:, 0] + a, 0, h - 1), np.clip(at[:, 1] + b, 0, w - 1)] = True
    out = _bytes(np.fft.ifft2(np.fft.ifftshift(np.where(wide, 0, spectrum))).real)
    return bilateral(out, 5, 50, 50) if img.var() > 1000 else out


def deskew(img: Image, limit: float = 20.0, least: float = 0.15, step: float = 0.1) -> Image:
    """Turned by the angle whose projection of strong edges onto the upright axis
    is the most uneven."""
    edges = np.abs(_weigh(img, np.array([[-1, -2, -1], [0, 0, 0], [1, 2, 1]], float)))
    y, x = np.nonzero(edges > max(150.0, edges.mean() + 2 * edges.std()))
    if len(y) < 20:
        return img
    angles = np.arange(-limit + step, limit, step)
    rough = [np.square(np.bincount(np.rint(y * np.cos(t) - x * np.sin(t) + sum(img.shape)).astype(int))).sum() for t in np.deg2rad(angles)]
    best = float(angles[int(np.argmax(rough))])
    return rotate(img, best) if abs(best) > least else img


def _otsu(img: Image) -> float:
    n = np.bincount(img.ravel(), minlength=256).astype(float)
    below, mass = np.cumsum(n), np.cumsum(n * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = below * above * (mass / below - (mass[-1] - mass) / above) ** 2
    return float(np.nanargmax(np.where(np.isfinite(spread), spread, 0)))


def quality(img: Image) -> str:
    """Which binarisation suits the image."""
    std = img.std()
    n = np.bincount(img.ravel(), minlength=256).astype(float)
    p = n / n.sum()
    if std == 0:
        return "mean"
    if ((n[1:-1] > n[:-2]) & (n[1:-1] > n[2:])).sum() >= 2 and std > 30:
        return "otsu"
    if std > 20 and -(p * np.log2(p + 1e-8)).sum() > 4.5:
        return "gaussian"
    return "sauvola" if std > 10 else "mean"


def binarize(img: Image, block: int = 25, offset: float = 7.0) -> Image:
    """Ink (dark) is 255, but for sauvola, where paper is."""
    kind = quality(img)
    block = max(3, block | 1)
    if kind == "otsu":
        return np.where(img <= _otsu(img), 255, 0).astype(np.uint8)
    flat = np.full((block, block), 1 / block**2)
    if kind == "sauvola":
        mean = _weigh(img, flat, "edge")
        std = np.sqrt(np.maximum(_weigh(img.astype(float) ** 2, flat, "edge") - mean**2, 0))
        return np.where(img > mean * (1 + 0.2 * (std / 128 - 1)), 255, 0).astype(np.uint8)
    kernel = _bell(block, 0.3 * ((block - 1) * 0.5 - 1) + 0.8) if kind == "gaussian" else flat
    return np.where(img <= _weigh(img, kernel, "edge") - (offset if kind == "gaussian" else max(1.0, offset - 2)), 255, 0).astype(np.uint8)


STEPS: dict[str, Callable[[Image], Image]] = {f.__name__: f for f in (clean, deskew, moire, salt_pepper, smooth, contrast, sharpen, binarize)}


def process(images: DataFrame, steps: Sequence[str]) -> DataFrame:
    """The images after the steps, in order; unknown names are errors."""
    unknown = [s for s in steps if s not in STEPS]
    if unknown:
        raise KeyError(f"unknown steps: {', '.join(unknown)}")
    chosen = tuple(steps)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for h, w, data in zip(frame["height"], frame["width"], frame["data"], strict=True):
                if data is not None and len(data) and h * w == len(data):
                    img = np.frombuffer(data, np.uint8).reshape(int(h), int(w))
                    for s in chosen:
                        img = STEPS[s](img)
                    data = img.tobytes()
                out.append(data)
            yield frame.assign(data=out)

    return images.select("img_id", "height", "width", "data").mapInPandas(run, SCHEMA)


def crop(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """img_id, box_id, height, width, data of boxes(img_id, box_id, px1, py1, px2,
    py2), cut to the image; boxes without pixels go."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples():
                img = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width)
                part = img[max(0, r.py1) : max(0, r.py2), max(0, r.px1) : max(0, r.px2)]
                if part.size:
                    rows.append((r.img_id, r.box_id, *part.shape, part.tobytes()))
            yield pd.DataFrame(rows, columns=["img_id", "box_id", "height", "width", "data"])

    return boxes.join(images, "img_id").select("img_id", "box_id", "height", "width", "data", "px1", "py1", "px2", "py2").mapInPandas(run, "img_id long, box_id long, height int, width int, data binary")
