"""Palettes of photographed objects: pixels to clusters, picks as anchors, groups of objects, and a preset for all.

Arrays stand for clusters (rows of LAB, their weights, and whether a pick anchors them); a pool of pixels comes as counted
colours, so what one task holds of it is bounded by the number of different colours.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.functions import color
from trendloom.operators import palette, vision


@dataclass(frozen=True)
class PaletteParams:
    #: Clusters at first, the distance below which they merge, the least share, the least pixels of a pool.
    k: int = 5
    merge_below: float = 10.0
    least_share: float = 0.05
    least_pixels: int = 150
    #: Farthest anchor, and the rules for clusters without one.
    anchor_within: float = 28.0
    alone_share: float = 0.10
    vivid_chroma: float = 15.0
    near_hue: float = 30.0
    merge_within: float = 40.0
    chroma_ratio: float = 0.5
    fallback_share: float = 0.05
    fallback_colors: int = 3
    scale: float = 10_000.0
    least_weight: float = 1e-6
    top: int = 5


@dataclass
class Colors:
    lab: np.ndarray
    weight: np.ndarray
    anchored: np.ndarray
    #: Weight that no colour stands for.
    rest: float = 0.0

    @classmethod
    def none(cls, rest: float = 0.0) -> Colors:
        return cls(np.zeros((0, 3)), np.zeros(0), np.zeros(0, bool), rest)


def dynamic(lab: np.ndarray, count: np.ndarray, p: PaletteParams) -> tuple[np.ndarray, np.ndarray]:
    """(colours, shares), largest first: k-means over a pool of counted colours, near ones merged, small ones gone."""
    n = float(count.sum())
    if n < p.least_pixels:
        return np.zeros((0, 3)), np.zeros(0)
    centre, label = palette.kmeans(lab, count.astype(float), min(p.k, max(1, int(n) // 50)))
    weight = np.bincount(label, count, len(centre))
    centre, weight, _ = palette.merge_colors(centre[weight > 0], weight[weight > 0], [None] * int((weight > 0).sum()), p.merge_below)
    keep = weight / weight.sum() >= p.least_share
    centre, weight = centre[keep], weight[keep]
    order = np.argsort(-weight, kind="stable")
    return centre[order], weight[order] / weight.sum() if len(weight) else weight


def _weights(share: np.ndarray, pixels: int, frame_area: int, p: PaletteParams) -> np.ndarray:
    """Shares as parts of the frame."""
    return np.maximum(p.least_weight, share * pixels / frame_area * p.scale) if frame_area > 0 else np.full(len(share), p.least_weight)


def _relations(lab: np.ndarray, base: np.ndarray, p: PaletteParams):
    """Distances, lightness, chroma and nearness of hue of each cluster (rows) to each anchor (columns)."""
    far = np.sqrt(((lab[:, None] - base[None]) ** 2).sum(2))
    chroma, base_chroma = np.hypot(lab[:, 1], lab[:, 2])[:, None], np.hypot(base[:, 1], base[:, 2])[None]
    turn = np.degrees(np.abs(np.arctan2(lab[:, 2], lab[:, 1])[:, None] - np.arctan2(base[:, 2], base[:, 1])[None])) % 360
    near = (np.minimum(turn, 360 - turn) <= p.near_hue) & (chroma > 1e-6) & (base_chroma > 1e-6)
    brighter = lab[:, 0][:, None] > base[:, 0][None]
    return far, chroma, base_chroma, near, brighter


def hybrid(lab: np.ndarray, share: np.ndarray, picks: np.ndarray, pixels: int, frame_area: int, p: PaletteParams) -> Colors:
    """Clusters with picks as anchors: one pick for one cluster, picks far from all clusters fall away.

    Of the others, vivid ones and highlights of an anchor's hue stand alone if they are large; shades of an anchor (darker
    at its hue, or darker and paler) are added to the nearest; what is left has no colour. Without any colour the largest
    clusters stay.
    """
    if not len(lab):
        return Colors.none()
    weight = _weights(share, pixels, frame_area, p)
    taken = vision.match_one_to_one(lab, picks, p.anchor_within)
    anchors = [c for c, _ in sorted(taken.items(), key=lambda x: x[1])]  # in the order of the picks
    others = np.array([i for i in range(len(lab)) if i not in taken], int)
    far, chroma, base_chroma, near, brighter = _relations(lab[others], lab[anchors], p)
    alike = np.minimum(chroma, base_chroma) >= p.chroma_ratio * np.maximum(chroma, base_chroma)
    alone = (share[others] >= p.alone_share) & ((chroma[:, 0] >= p.vivid_chroma) | (near & brighter & alike).any(1))
    shade = np.where(near, ~brighter, (lab[anchors][:, 0][None] > lab[others][:, 0][:, None]) & (base_chroma > chroma)) & (far <= p.merge_within)
    total = weight.copy()
    rest = 0.0
    for row, i in enumerate(others.tolist()):
        if alone[row]:
            continue
        if shade[row].any():
            total[anchors[int(np.where(shade[row], far[row], np.inf).argmin())]] += weight[i]
        else:
            rest += weight[i]
    kept = [*anchors, *others[alone].tolist()]
    if kept:
        return Colors(lab[kept], total[kept], np.arange(len(kept)) < len(anchors), rest)
    kept = np.flatnonzero(share[: p.fallback_colors] >= p.fallback_share)
    return Colors(lab[kept], weight[kept], np.zeros(len(kept), bool), max(0.0, rest - weight[kept].sum()))


def indexed(lab: np.ndarray, share: np.ndarray, picks: list[int], pixels: int, frame_area: int, p: PaletteParams) -> Colors:
    """Clusters named by their number among the largest; a number out of range or twice is an error."""
    shown = min(len(lab), p.top)
    if not shown:
        return Colors.none()
    if any(not 0 <= i < shown for i in picks) or len(set(picks)) < len(picks):
        raise ValueError(f"cluster numbers out of range or repeated: {picks} of {shown}")
    weight = _weights(share, pixels, frame_area, p)
    return Colors(lab[picks], weight[picks], np.ones(len(picks), bool), float(np.delete(weight, picks).sum()))


def capped(c: Colors, top: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(colours, shares that sum to 1, share cut off), largest first: anchors take the places before others."""
    total = c.weight.sum() + c.rest
    if not len(c.weight) or not total > 0:
        return np.zeros((0, 3)), np.zeros(0), 1.0 if c.rest > 0 else 0.0
    order = np.lexsort((np.arange(len(c.weight)), -c.weight, ~c.anchored))[:top]
    order = order[np.argsort(-c.weight[order], kind="stable")]
    share = c.weight[order] / total
    return c.lab[order], share / share.sum(), max(0.0, 1.0 - float(share.sum()))


def grouped(objects: list[Colors]) -> Colors:
    """One set of colours for several objects: weighted k-means with as many clusters as the richest object has."""
    rest, k = sum(c.rest for c in objects), max((len(c.weight) for c in objects), default=0)
    if not k:
        return Colors.none(rest)
    lab, weight, anchored = (np.concatenate([getattr(c, n) for c in objects]) for n in ("lab", "weight", "anchored"))
    centre, label = palette.kmeans(lab, weight, k)
    total = np.bincount(label, weight, len(centre))
    has = np.bincount(label, anchored, len(centre)) > 0  # one anchor is enough
    return Colors(centre[total > 0], total[total > 0], has[total > 0], rest)


_OUT = [("rank", "integer"), ("l", "double"), ("a", "double"), ("b", "double"), ("share", "double"), ("cut_off", "double")]


def _rows(lab: np.ndarray, share: np.ndarray, cut: float) -> pd.DataFrame:
    return pd.DataFrame({"rank": np.arange(1, len(lab) + 1, dtype=np.int32), "l": lab[:, 0], "a": lab[:, 1], "b": lab[:, 2], "share": share, "cut_off": cut})


def group_palettes(pixels: DataFrame, picks: DataFrame, group: str, p: PaletteParams | None = None) -> DataFrame:
    """group, rank, l, a, b, share, cut_off from counted pixels(group, object, hex, n, frame_area) and picks(object, hexes).

    Each object gets its clusters and anchors, a group's objects share one palette. A group is one task; it holds the
    different colours of its objects, which are summed before they are sent.
    """
    p = p or PaletteParams()
    lab = color.rgb_lab(*color.hex_channels(F.col("hex")))
    counted = pixels.groupBy(group, "object", "hex").agg(F.sum("n").alias("n"), F.max("frame_area").alias("frame_area"))
    own = counted.select(group, "object", "n", "frame_area", *[c.alias(x) for c, x in zip(lab, ("l", "a", "b"), strict=True)]).join(picks, "object", "left")
    schema = own.select(group).schema
    for name, kind in _OUT:
        schema = schema.add(name, kind)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        objects = []
        for _, o in pdf.sort_values(["object", "l", "a", "b"]).groupby("object"):
            points, share = dynamic(o[["l", "a", "b"]].to_numpy(), o["n"].to_numpy(), p)
            named = o["hexes"].iloc[0]
            rgb = np.array([[int(h.lstrip("#")[i : i + 2], 16) for i in (0, 2, 4)] for h in named]) if named is not None and len(named) else np.zeros((0, 3))
            objects.append(hybrid(points, share, vision.rgb_lab(rgb) if len(rgb) else rgb, int(o["n"].sum()), int(o["frame_area"].iloc[0]), p))
        out = _rows(*capped(grouped(objects), p.top))
        out.insert(0, group, pdf[group].iloc[0])
        return out

    return own.groupBy(group).applyInPandas(run, schema)


def dynamic_palettes(pixels: DataFrame, by: str, p: PaletteParams | None = None) -> DataFrame:
    """by, rank, l, a, b, share of each pool of counted pixels(by, hex, n)."""
    p = p or PaletteParams()
    lab = color.rgb_lab(*color.hex_channels(F.col("hex")))
    own = pixels.groupBy(by, "hex").agg(F.sum("n").alias("n")).select(by, "n", *[c.alias(x) for c, x in zip(lab, ("l", "a", "b"), strict=True)])
    schema = own.select(by).schema
    for name, kind in _OUT[:-1]:
        schema = schema.add(name, kind)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["l", "a", "b"])
        out = _rows(*dynamic(pdf[["l", "a", "b"]].to_numpy(), pdf["n"].to_numpy(), p), 0.0).drop(columns="cut_off")
        out.insert(0, by, pdf[by].iloc[0])
        return out

    return own.groupBy(by).applyInPandas(run, schema)


def preset(colors: DataFrame, k: int = 35, fixed: list[str] = (), bits: int = 5) -> DataFrame:
    """name, l, a, b, weight, family: k colours for all of colors(hex, n) by weighted k-means, and fixed ones beside them.

    Colours are binned to `bits` bits a channel first, so one task gets 8 ** bits points at most, whatever the input.
    """
    step = 1 << (8 - bits)
    channels = [(F.floor(c / step) * step + (step - 1) / 2).alias(n) for c, n in zip(color.hex_channels(F.col("hex")), "rgb", strict=True)]
    binned = colors.select(*channels, "n").groupBy("r", "g", "b").agg(F.sum("n").alias("n"))
    named = [h.upper() for h in fixed]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["r", "g", "b"])
        centre, label = palette.kmeans(vision.rgb_lab(pdf[["r", "g", "b"]].to_numpy()), pdf["n"].to_numpy(float), k)
        weight = np.bincount(label, pdf["n"].to_numpy(float), len(centre))
        order = [i for i in np.argsort(-weight, kind="stable") if weight[i] > 0]
        own = pd.DataFrame({"name": [f"color_{i:02d}" for i in range(1, len(order) + 1)], "l": centre[order, 0], "a": centre[order, 1], "b": centre[order, 2], "weight": weight[order]})
        if named:
            lab = vision.rgb_lab(np.array([[int(h.lstrip("#")[i : i + 2], 16) for i in (0, 2, 4)] for h in named]))
            own = pd.concat([own, pd.DataFrame({"name": named, "l": lab[:, 0], "a": lab[:, 1], "b": lab[:, 2], "weight": 0.0})])
        return own

    def whole(batches):
        parts = list(batches)
        if parts and sum(map(len, parts)):
            yield run(pd.concat(parts))

    made = binned.repartition(1).mapInPandas(whole, "name string, l double, a double, b double, weight double")
    return made.withColumn("family", color.family(F.col("l"), F.col("a"), F.col("b")))


def nearest_preset(colors: DataFrame, presets: DataFrame) -> DataFrame:
    """hex, name, distance: the nearest preset colour of each different colour; presets are a few dozen rows."""
    lab = color.rgb_lab(*color.hex_channels(F.col("hex")))
    own = colors.select("hex").distinct().select("hex", *[c.alias(n) for c, n in zip(lab, ("x", "y", "z"), strict=True)])
    few = F.broadcast(presets.agg(F.sort_array(F.collect_list(F.struct("name", "l", "a", "b"))).alias("p")))  # one row
    far = F.transform("p", lambda c: F.struct(color.delta_e([F.col("x"), F.col("y"), F.col("z")], [c["l"], c["a"], c["b"]]).alias("d"), c["name"].alias("name")))
    best = own.crossJoin(few).select("hex", F.array_min(far).alias("m"))
    return best.select("hex", F.col("m.name").alias("name"), F.col("m.d").alias("distance"))


def needs_correction(pixels: np.ndarray, cast: float = 0.12) -> bool:
    """Whether the channels' means lie apart by more than `cast` of their mean: light has a colour."""
    mean = pixels.reshape(-1, 3).mean(0) if pixels.size else np.ones(3)
    return bool(mean.max() - mean.min() > cast * max(mean.mean(), 1e-6))


def corrected(pixels: np.ndarray, norm: float = 6.0, cast: float = 0.12) -> np.ndarray:
    """Pixels under neutral light where that was needed and helped: the correction stays only if the cast got smaller."""
    if not needs_correction(pixels, cast):
        return pixels
    new = palette.shades_of_gray(pixels, norm)
    spread = lambda x: np.ptp(x.reshape(-1, 3).mean(0)) / max(x.mean(), 1e-6)
    return new if spread(new) < spread(pixels) else pixels


