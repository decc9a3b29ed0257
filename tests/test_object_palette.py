from __future__ import annotations

import numpy as np
import pytest

from trendloom.operators import object_palette as op

P = op.PaletteParams()


def test_dynamic_pool():
    lab, count = np.array([[50.0, 0, 0], [52.0, 0, 0], [80.0, 40, 0], [20.0, -40, 0]]), np.array([100, 100, 180, 20])
    got, share = op.dynamic(lab, count, P)
    assert share.sum() == pytest.approx(1) and (np.diff(share) <= 0).all() and len(got) == 3  # the near ones merge
    assert got[0][0] == pytest.approx(51) and share[0] == pytest.approx(0.5)
    assert len(op.dynamic(lab, np.array([1, 1, 1, 1]), P)[0]) == 0
    assert len(op.dynamic(lab, np.array([960, 20, 10, 10]), P)[0]) == 1  # shares below a twentieth go


def test_hybrid_rules():
    lab = np.array([[50.0, 40, 0], [30.0, 36, 0], [70.0, 38, 2], [60.0, 0, 3], [40.0, 0, -50]])
    share = np.array([0.4, 0.04, 0.2, 0.06, 0.3])
    picks = np.array([[52.0, 42, 0], [0.0, 0, 100]])  # the second is far from all
    c = op.hybrid(lab, share, picks, 1000, 2000, P)
    # anchor takes its darker shade; the brighter one of its hue and the vivid one stand alone; the pale one is none
    assert c.anchored.tolist() == [True, False, False]
    assert c.weight == pytest.approx(np.array([0.44, 0.2, 0.3]) * 5000) and c.rest == pytest.approx(0.06 * 5000)
    assert (c.lab == lab[[0, 2, 4]]).all()
    # greedy one to one: the nearer pair wins, the other pick takes the next cluster
    two = op.hybrid(lab[:2], np.array([0.5, 0.5]), np.array([[49.0, 40, 0], [45.0, 40, 0]]), 100, 100, P)
    assert two.anchored.tolist() == [True, True] and two.lab[0][0] == 50 and two.lab[1][0] == 30
    grey = op.hybrid(np.array([[50.0, 1, 0], [20.0, 0, 1]]), np.array([0.97, 0.03]), np.zeros((0, 3)), 100, 100, P)
    assert len(grey.weight) == 1 and not grey.anchored.any() and grey.rest == pytest.approx(300)  # the largest stays for want of others
    assert len(op.hybrid(lab[:0], share[:0], picks, 1, 1, P).weight) == 0


def test_indexed():
    lab, share = np.eye(3) * 50, np.array([0.5, 0.3, 0.2])
    c = op.indexed(lab, share, [2, 0], 100, 100, P)
    assert c.weight == pytest.approx([2000, 5000]) and c.rest == pytest.approx(3000) and c.anchored.all()
    for bad in ([3], [0, 0], [-1]):
        with pytest.raises(ValueError):
            op.indexed(lab, share, bad, 100, 100, P)


def test_cap_keeps_anchors():
    c = op.Colors(np.arange(9.0).reshape(3, 3), np.array([5.0, 3, 1]), np.array([False, False, True]), 1.0)
    lab, share, cut = op.capped(c, 2)
    assert lab[:, 0].tolist() == [0, 6] and share == pytest.approx([5 / 6, 1 / 6]) and cut == pytest.approx(0.4)
    assert op.capped(op.Colors.none(2.0), 2)[2] == 1.0 and op.capped(op.Colors.none(), 2)[2] == 0.0


def test_grouped_objects():
    one = op.Colors(np.array([[10.0, 0, 0], [90.0, 0, 0]]), np.array([1.0, 3]), np.array([True, False]), 0.5)
    two = op.Colors(np.array([[12.0, 0, 0]]), np.array([1.0]), np.array([False]), 0.5)
    g = op.grouped([one, two])
    assert sorted(g.lab[:, 0].tolist()) == [11.0, 90.0] and g.rest == 1.0 and g.anchored[g.lab[:, 0] == 11.0].all() and not g.anchored[g.lab[:, 0] == 90.0].any()
    assert len(op.grouped([op.Colors.none(1.0)]).weight) == 0


def test_frames(spark):
    px = [("g", o, h, n, 1000) for o, h, n in (("a", "#FF0000", 400), ("a", "#FE0101", 100), ("a", "#0000FF", 300), ("b", "#FF0000", 200))]
    pixels = spark.createDataFrame(px, "grp string, object string, hex string, n long, frame_area long")
    picks = spark.createDataFrame([("a", ["#FF0505"]), ("b", None)], "object string, hexes array<string>")
    got = op.group_palettes(pixels, picks, "grp").orderBy("rank").collect()
    assert [r["rank"] for r in got] == [1, 2] and got[0].share == pytest.approx(0.7) and got[0].cut_off == pytest.approx(0)
    assert [round(r.share, 6) for r in op.dynamic_palettes(pixels.filter("object = 'a'"), "grp").orderBy("rank").collect()] == [0.625, 0.375]
    made = op.preset(pixels.select("hex", "n"), 2, ["#ffffff"]).collect()
    assert {r.name for r in made} == {"color_01", "color_02", "#FFFFFF"} and sum(r.weight for r in made) == 1000
    near = {r.hex: r.name for r in op.nearest_preset(pixels, op.preset(pixels.select("hex", "n"), 2)).collect()}
    assert near["#FF0000"] == near["#FE0101"] == "color_01" and near["#0000FF"] == "color_02"


def test_light():
    warm = np.tile(np.array([[200, 150, 100]]), (50, 1)) * np.linspace(0.2, 1, 50)[:, None]
    assert op.needs_correction(warm) and np.ptp(op.corrected(warm).mean(0)) < np.ptp(warm.mean(0))
    gray = np.tile(np.array([[100, 100, 100]]), (5, 1))
    assert not op.needs_correction(gray) and op.corrected(gray) is gray
