"""Image kernels on small images."""

import numpy as np
import pytest

from tallyline.operators import images


def text_like(h=80, w=120):
    img = np.full((h, w), 230, np.uint8)
    for y in range(10, h - 10, 14):
        img[y : y + 4, 10 : w - 10] = 40
    return img


def test_flat_images_stay_flat():
    flat = np.full((20, 30), 100, np.uint8)
    assert images.laplacian(flat).any() == images.cross_gradient(flat).any() == False  # noqa: E712
    for f in (images.median_filter(flat, 3), images.bilateral(flat, 5, 50, 50), images.rotate(flat, 7), images.unsharp(flat, 1, 1), images.salt_pepper(flat), images.deskew(flat)):
        assert (f == 100).all()


def test_median_takes_salt_out():
    img = text_like()
    salted = img.copy()
    salted[5::9, 7::11] = 255
    assert (images.median_filter(salted, 3)[5::9, 7::11] < 255).mean() > 0.9
    assert images.salt_pepper(salted).shape == img.shape


def test_equalize_widens():
    rng = np.random.default_rng(0)
    dull = rng.integers(110, 130, (64, 64)).astype(np.uint8)
    assert images.equalize(dull, 3.0).std() > 2 * dull.std() and images.contrast(dull).std() > dull.std()


def test_deskew_turns_back():
    turned = images.rotate(text_like(200, 300), 5)
    rows = lambda x: x[40:-40, 60:-60].mean(1).var()
    assert rows(images.deskew(turned)) > 3 * rows(turned)


def test_moire_notches_a_wave():
    y, x = np.mgrid[0:256, 0:256]
    wave = 40 * np.sin(2 * np.pi * x * 80 / 256)
    img = np.clip(128 + wave, 0, 255).astype(np.uint8)
    assert images.moire(img).std() < 0.3 * img.std()


def test_binarize_finds_ink():
    img = text_like()
    assert (images.binarize(img)[10:13, 20:60] == 255).all() and images.quality(np.zeros((4, 4), np.uint8)) == "mean"
    for kind in ("gaussian", "sauvola", "mean"):
        rng = np.random.default_rng(1)
        noisy = np.clip(rng.normal(128, {"gaussian": 25, "sauvola": 12, "mean": 5}[kind], (60, 60)), 0, 255).astype(np.uint8)
        assert set(np.unique(images.binarize(noisy))) <= {0, 255}


def test_process_and_crop(spark):
    img = text_like()
    rows = [(1, *img.shape, bytearray(img.tobytes())), (2, 0, 0, bytearray()), (3, None, None, None)]
    df = spark.createDataFrame(rows, images.SCHEMA)
    out = {r.img_id: r.data for r in images.process(df, list(images.STEPS)).collect()}
    assert len(out[1]) == img.size and not out[2] and out[3] is None
    with pytest.raises(KeyError):
        images.process(df, ["fragmentator"])
    boxes = spark.createDataFrame([(1, 0, -5, 0, 10, 10), (1, 1, 500, 0, 600, 10)], "img_id long, box_id long, px1 int, py1 int, px2 int, py2 int")
    got = images.crop(df, boxes).collect()
    assert [(r.box_id, r.height, r.width) for r in got] == [(0, 10, 10)]
