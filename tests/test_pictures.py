import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaloom.functions import geometry3d as g
from vistaloom.operators import images, pictures, points, qa_geometry


def filtered(picture, kinds):
    """A PNG whose rows use the given filters, written pixel by pixel."""
    h, w, c = picture.shape
    raw, flat = b"", picture.reshape(h, -1).astype(int)
    for y in range(h):
        row, up = flat[y], flat[y - 1] if y else np.zeros(w * c, int)
        left = np.concatenate([np.zeros(c, int), row[:-c]])
        corner = np.concatenate([np.zeros(c, int), up[:-c]])
        kind = kinds[y % len(kinds)]
        guess = [0 * row, left, up, (left + up) // 2, None][kind]
        if kind == 4:
            p = left + up - corner
            guess = np.array([min((abs(q - v), o, v) for o, v in enumerate((a, b, d)))[2] for q, a, b, d in zip(p, left, up, corner, strict=True)])
        raw += bytes([kind]) + ((row - guess) % 256).astype(np.uint8).tobytes()

    def chunk(name, value):
        return struct.pack(">I", len(value)) + name + value + struct.pack(">I", zlib.crc32(name + value))

    head = struct.pack(">IIBBBBB", w, h, 8, {3: 2, 4: 6}[c], 0, 0, 0)
    return pictures.SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_png_round_trips_and_filters():
    rng = np.random.default_rng(0)
    for shape, kind in (((5, 7), np.uint8), ((5, 7), np.uint16), ((4, 3, 3), np.uint8), ((2, 9, 4), np.uint8), ((3, 3, 2), np.uint16)):
        p = rng.integers(0, np.iinfo(kind).max, shape).astype(kind)
        assert (pictures.decode(pictures.encode_png(p)) == p).all()
    for c in (3, 4):
        p = rng.integers(0, 256, (10, 6, c)).astype(np.uint8)
        assert (pictures.decode(filtered(p, [0, 1, 2, 3, 4])) == p).all()
    with pytest.raises(ValueError, match="no decoder"):
        pictures.decode(b"\xff\xd8\xff\xe0")
    pictures.register(b"RAW2", lambda data: np.frombuffer(data[4:], np.uint8).reshape(2, -1))
    assert pictures.decode(b"RAW2abcd").shape == (2, 2)


def test_marks_and_sizes(spark):
    p = np.zeros((100, 200, 3), np.uint8)
    got = pictures.marked(p, [(20, 10, 59, 49)], ["red"], 3)
    red = (got == [255, 0, 0]).all(2)
    assert red.sum() == 40 * 40 - 34 * 34 and red[10, 20] and red[49, 59] and not red[13, 23] and not red[9].any()
    assert pictures.resized(np.arange(16, dtype=np.uint8).reshape(4, 4), 2, 2).tolist() == [[2, 4], [10, 12]]
    assert pictures.rgb(np.array([[[10, 0]]], np.uint8)).tolist() == [[[255, 255, 255]]]
    rows = spark.createDataFrame([(1, bytearray(pictures.encode_png(p)), [[100, 100, 295, 490]], ["blue"])], "id int, content binary, boxes array<array<int>>, colors array<string>")
    drawn = pictures.render(rows, "id").first()
    assert (drawn.width, drawn.height) == (200, 100) and (pictures.decode(bytes(drawn.content))[10, 20] == [0, 0, 255]).all()
    small = pictures.converted(rows, "id", width=20, height=10).first()
    assert pictures.decode(bytes(small.content)).shape == (10, 20, 3)


def test_masks(spark):
    ddl = "picture string, id int, tag string, runs array<struct<start:int,length:int>>, width int, height int"
    masks = spark.createDataFrame([("p", 1, "a", [(0, 10)], 10, 3), ("p", 2, "a", [(0, 9)], 10, 3), ("p", 3, "b", [(0, 10)], 10, 3), ("p", 4, "a", [(9, 11)], 10, 3), ("q", 1, "a", [(0, 10)], 10, 3)], ddl)
    px = images.pixels(masks, ["picture", "id"], "runs", "width")
    kept = images.merge_masks(masks, px, "picture", "id", "tag").collect()
    assert sorted((r.picture, r.id) for r in kept) == [("p", 1), ("p", 3), ("p", 4), ("q", 1)]
    png = {r.id: pictures.decode(bytes(r.content)) for r in pictures.mask_pictures(masks.filter("picture = 'p'"), "id").collect()}
    assert png[4].shape == (3, 10) and (np.flatnonzero(png[4]) == np.arange(9, 20)).all() and png[4].max() == 255


def test_depth_pictures_and_tone(spark):
    depth = np.array([[1000, 2000], [0, 65535]], np.uint16)
    files = spark.createDataFrame([("p", bytearray(pictures.encode_png(depth)), 1000)], "picture string, content binary, depth_scale int")
    assert {(r.u, r.v): r.depth for r in images.depth_pixels(files, "picture").collect()} == {(0, 0): 1.0, (1, 0): 2.0, (0, 1): 0.0, (1, 1): 65.535}
    light = np.full((4, 4, 3), 0.5)
    assert (pictures.tonemapped(light, np.ones((4, 4), bool)) == math.floor(0.8 * 255 + 0.5)).all()
    assert (pictures.tonemapped(light * 0, np.ones((4, 4), bool)) == 0).all()


def test_angles_of_any_convention(spark):
    conventions = [a + b + c for a in "XYZ" for b in "XYZ" for c in "XYZ" if b not in (a, c)]
    angles = [F.lit(0.4), F.lit(0.9), F.lit(-1.1)]
    row = spark.range(1).select(*[x.alias(f"{c}{n}") for c in conventions for n, x in enumerate(g.euler_by(c, g.rotation_by(c, angles)))]).first()
    assert len(conventions) == 12
    for c in conventions:
        assert np.allclose([row[f"{c}{n}"] for n in range(3)], [0.4, 0.9, -1.1]), c
    for bad in ("XXY", "XY", "XYW"):
        with pytest.raises(ValueError):
            g.euler_by(bad, g.rotation_by("XYZ", angles))


def test_nearest_and_matched_points(spark):
    rng = np.random.default_rng(2)
    a, b = rng.random((60, 3)), rng.random((80, 3))
    ddl = "pair int, u int, v int, x double, y double, z double"
    make = lambda p: spark.createDataFrame([(1, i, i + 1, *map(float, x)) for i, x in enumerate(p)], ddl)
    got = {r.a_u: (r.b_u, r.distance) for r in points.nearest_within(make(a), make(b), ["pair"], 0.15, ["u", "v"]).collect()}
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
    want = {i: (int(row.argmin()), row.min()) for i, row in enumerate(d) if row.min() <= 0.15}
    assert got.keys() == want.keys() and all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 1e-12 for i in want)
    (m,) = qa_geometry.matched_points(make(a), make(b), 3, 0.15, (100, 100)).collect()
    assert want[m.qu][0] == m.u and m.qv == m.qu + 1
    assert qa_geometry.matched_points(make(a), make(b), 3, 0.15, (100, 100), least=1000).count() == 0
