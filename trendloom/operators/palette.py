"""Palettes: greedy merging of weighted colours, and clustering of pixels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom import vocab
from trendloom.functions import color


def merge_colors(lab: np.ndarray, weight: np.ndarray, family: list[str | None], threshold: float) -> tuple[np.ndarray, np.ndarray, list[str | None]]:
    """Merges the nearest pair below the threshold until none is left; ties by place, families by weight, then by order.

    One distance matrix is kept; a merge renews one of its rows.
    """
    lab, weight, family = lab.astype(float).copy(), weight.astype(float).copy(), list(family)
    n = len(weight)
    far = np.sqrt(((lab[:, None] - lab[None]) ** 2).sum(2))
    far[np.tril_indices(n)] = np.inf
    order = {f: i for i, f in enumerate(vocab.COLOR_FAMILIES)}
    alive = np.ones(n, bool)
    while alive.sum() > 1:
        i, j = divmod(int(far.argmin()), n)
        if not far[i, j] < threshold:
            break
        heavier = min((-weight[k], order.get(family[k], len(order)), m) for m, k in enumerate((i, j)))[2]
        total = weight[i] + weight[j]
        lab[i] = (weight[i] * lab[i] + weight[j] * lab[j]) / total
        weight[i], family[i] = total, family[(i, j)[heavier]]
        alive[j] = False
        far[j, :] = far[:, j] = np.inf
        dist = np.sqrt(((lab - lab[i]) ** 2).sum(1))
        far[i, i + 1 :] = np.where(alive[i + 1 :], dist[i + 1 :], np.inf)
        far[:i, i] = np.where(alive[:i], dist[:i], np.inf)
    keep = np.flatnonzero(alive)
    return lab[keep], weight[keep], [family[k] for k in keep]


#: Sets of fewer colours are merged many at once.
SMALL = 8


def merge_many(lab: np.ndarray, weight: np.ndarray, family: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """merge_colors of many sets of n colours each, step by step for all at once; families are places in COLOR_FAMILIES, merged colours weigh 0."""
    lab, weight, family = lab.copy(), weight.copy(), family.copy()
    n = weight.shape[1]
    far = np.sqrt(((lab[:, :, None] - lab[:, None]) ** 2).sum(3))
    far[:, *np.tril_indices(n)] = np.inf
    order, at, sets = np.where(family < 0, len(vocab.COLOR_FAMILIES), family), np.arange(n), np.arange(len(weight))
    while len(sets):
        flat = far[sets].reshape(len(sets), n * n)
        near = flat.argmin(1)
        on = flat[np.arange(len(sets)), near] < threshold
        sets, (i, j) = sets[on], divmod(near[on], n)
        wi, wj = weight[sets, i], weight[sets, j]
        taken = np.where((wj > wi) | ((wj == wi) & (order[sets, j] < order[sets, i])), j, i)
        total = wi + wj
        lab[sets, i] = (wi[:, None] * lab[sets, i] + wj[:, None] * lab[sets, j]) / total[:, None]
        weight[sets, i], weight[sets, j] = total, 0
        family[sets, i], order[sets, i] = family[sets, taken], order[sets, taken]
        far[sets, j, :] = far[sets, :, j] = np.inf
        dist = np.where(weight[sets] > 0, np.sqrt(((lab[sets] - lab[sets, i][:, None]) ** 2).sum(2)), np.inf)
        far[sets, i, :] = np.where(at > i[:, None], dist, np.inf)
        far[sets, :, i] = np.where(at < i[:, None], dist, far[sets, :, i])
    return lab, weight, family


def largest(weight: np.ndarray, least: float, k: int) -> np.ndarray:
    """Places of the heaviest k whose share is at least `least`."""
    total = weight.sum()
    if not total > 0:
        return np.zeros(0, int)
    order = np.argsort(-weight, kind="stable")
    return order[weight[order] / total >= least][:k]


def binned_colors(rows: DataFrame, by: str) -> DataFrame:
    """by, hex, weight: equal colours of a group are summed first, so that a hot group shrinks before it meets one task."""
    return rows.groupBy(by, "hex").agg(F.sum("weight").alias("weight")).filter("weight > 0")


def group_palettes(rows: DataFrame, by: str, threshold: float = 10.0, least: float = 0.05, k: int = 5) -> DataFrame:
    """by, rank, family, share from rows(by, hex, weight): colours below the threshold merge, small ones go, k stay."""
    lab = color.rgb_lab(*color.hex_channels(F.col("hex")))
    own = binned_colors(rows, by).select(by, "hex", "weight", *[c.alias(n) for c, n in zip(lab, ("l", "a", "b"), strict=True)])
    own = own.withColumn("family", color.family(F.col("l"), F.col("a"), F.col("b")))

    colors = F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("w"), "hex", "l", "a", "b", "family")))  # a group's different colours
    grouped = own.groupBy(by).agg(colors.alias("colors"))
    schema = own.select(by).schema.add("rank", "integer").add("family", "string").add("l", "double").add("a", "double").add("b", "double").add("share", "double")

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        families = pa.array(vocab.COLOR_FAMILIES)
        for batch in batches:
            lists = batch.column(1)
            start, size = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py(), np.diff(lists.offsets.to_numpy())
            each = lists.flatten()
            lab_of = np.stack([each.field(c).to_numpy(zero_copy_only=False) for c in ("l", "a", "b")], 1)
            weight_of = -each.field("w").to_numpy(zero_copy_only=False)
            family_of = pc.fill_null(pc.index_in(each.field("family"), families), -1).to_numpy(zero_copy_only=False)
            out = []
            for n in np.unique(size).tolist():
                sets = np.flatnonzero(size == n)
                if n < SMALL:
                    at = start[sets][:, None] + np.arange(n)
                    lab, weight, family = merge_many(lab_of[at], weight_of[at], family_of[at], threshold)
                    heavy = np.argsort(-weight, 1, kind="stable")
                    w = np.take_along_axis(weight, heavy, 1)
                    kept = (w / w.sum(1, keepdims=True) >= least) & (w > 0) & (np.arange(n) < k)
                    share = w / np.where(kept, w, 0).sum(1, keepdims=True)
                    row, rank = np.nonzero(kept)
                    place = heavy[row, rank]
                    out.append((sets[row], rank + 1, family[row, place], lab[row, place], share[row, rank]))
                    continue
                for one in sets.tolist():
                    own = slice(start[one], start[one] + n)
                    lab, weight, family = merge_colors(lab_of[own], weight_of[own], [vocab.COLOR_FAMILIES[f] if f >= 0 else None for f in family_of[own]], threshold)
                    at = largest(weight, least, k)
                    code = np.array([vocab.COLOR_FAMILIES.index(family[x]) if family[x] else -1 for x in at], int)
                    out.append((np.full(len(at), one), np.arange(1, len(at) + 1), code, lab[at], weight[at] / weight[at].sum()))
            if out:
                row, rank, code, lab, share = (np.concatenate(x) for x in zip(*out, strict=True))
                named = families.take(pa.array(code, mask=code < 0))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(rank.astype(np.int32)), named, *map(pa.array, lab.T.copy()), pa.array(share)], names=[f.name for f in schema.fields])

    return grouped.mapInArrow(run, schema)


def kmeans(points: np.ndarray, weight: np.ndarray, k: int, rounds: int = 50, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weighted Lloyd iterations from a deterministic farthest-point start: (centres, labels); start weighs the points in it."""
    k, start = max(1, min(k, len(points))), weight if start is None else start
    centres = [points[int(start.argmax())]]
    for _ in range(k - 1):
        gap = np.min([((points - c) ** 2).sum(1) for c in centres], axis=0)
        centres.append(points[int((gap * start).argmax())])
    c = np.array(centres)
    label = np.zeros(len(points), int)
    for _ in range(rounds):
        new = np.stack([((points - x) ** 2).sum(1) for x in c], 1).argmin(1)
        c2 = np.array([np.average(points[new == i], axis=0, weights=weight[new == i]) if weight[new == i].sum() > 0 else c[i] for i in range(k)])
        if (new == label).all() and np.allclose(c2, c):
            break
        label, c = new, c2
    return c, label


def pixel_palettes(pixels: DataFrame, by: str, k: int = 5, per_cluster: int = 50) -> DataFrame:
    """by, rank, l, a, b, share: k-means over a group's pixels, with fewer clusters for few pixels.

    Equal pixels are counted before they are sent, so a task holds a group's different colours, however many its pixels; each
    colour weighs 1 in the start, as each pixel would.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["l", "a", "b"])
        pts, count = pdf[["l", "a", "b"]].to_numpy(), pdf["n"].to_numpy()
        c, label = kmeans(pts, count.astype(float), min(k, max(1, int(count.sum()) // per_cluster)), start=np.ones(len(pts)))
        n = np.bincount(label, count, len(c))
        order = np.argsort(-n, kind="stable")
        order = order[n[order] > 0]
        return pd.DataFrame({by: pdf[by].iloc[0], "rank": np.arange(1, len(order) + 1, dtype=np.int32), "l": c[order, 0], "a": c[order, 1], "b": c[order, 2], "share": n[order] / n.sum()})

    counted = pixels.groupBy(by, "l", "a", "b").agg(F.count("*").alias("n"))
    return counted.groupBy(by).applyInPandas(run, pixels.select(by).schema.add("rank", "integer").add("l", "double").add("a", "double").add("b", "double").add("share", "double"))


def frame_quality(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For mapInPandas over frames(frame_id, pixels, width): variance of the Laplacian and mean brightness, without an image library."""
    for pdf in frames:
        blur, light = [], []
        for raw, width in zip(pdf["pixels"], pdf["width"], strict=True):
            g = np.frombuffer(raw, np.uint8).reshape(-1, width).astype(float)
            lap = g[1:-1, :-2] + g[1:-1, 2:] + g[:-2, 1:-1] + g[2:, 1:-1] - 4 * g[1:-1, 1:-1] if min(g.shape) > 2 else np.zeros(1)
            blur.append(float(lap.var()))
            light.append(float(g.mean()))
        yield pd.DataFrame({"frame_id": pdf["frame_id"], "blur": blur, "brightness": light})


def shades_of_gray(pixels: np.ndarray, norm: float = 6.0) -> np.ndarray:
    """Illumination-corrected RGB pixels: channels scaled by their p-norm means."""
    mean = np.power(np.power(pixels.astype(float), norm).mean(0), 1 / norm)
    return np.clip(pixels * (mean.mean() / np.maximum(mean, 1e-6)), 0, 255)
