"""Array routines for image posts, for use inside pandas functions; models and decoders are hooks."""

from __future__ import annotations

import numpy as np

from trendloom.functions.color import EPS, KAPPA, TO_XYZ, WHITE


def rgb_lab(rgb: np.ndarray) -> np.ndarray:
    x = np.asarray(rgb, float) / 255
    linear = np.where(x > 0.04045, ((x + 0.055) / 1.055) ** 2.4, x / 12.92)
    v = linear @ np.array(TO_XYZ).T / np.array(WHITE)
    f = np.where(v > EPS, np.cbrt(v), (KAPPA * v + 16) / 116)
    return np.stack([116 * f[..., 1] - 16, 500 * (f[..., 0] - f[..., 1]), 200 * (f[..., 1] - f[..., 2])], -1)


#: A box of skin tones in LAB.
SKIN_LO, SKIN_HI = np.array([20.0, 5.0, 8.0]), np.array([90.0, 30.0, 40.0])


def drop_skin(pixels: np.ndarray, keep_above: float = 0.5, drop_above: float = 0.97) -> tuple[np.ndarray, float]:
    """Pixels without skin tones and the share of those: a part that is all skin goes, one that is mostly skin-coloured is cloth and stays."""
    if not len(pixels):
        return pixels, 0.0
    lab = rgb_lab(pixels)
    skin = ((lab >= SKIN_LO) & (lab <= SKIN_HI)).all(-1)
    share = float(skin.mean())
    if share > drop_above:
        return pixels[:0], share
    return (pixels, share) if share > keep_above else (pixels[~skin], share)


def match_one_to_one(clusters: np.ndarray, picks: np.ndarray, threshold: float) -> dict[int, int]:
    """cluster -> pick by rising distance up to the threshold, each side once; ties by the pick's order, then the cluster's."""
    if not len(clusters) or not len(picks):
        return {}
    far = np.sqrt(((clusters[:, None] - picks[None]) ** 2).sum(2))
    pick, cluster = np.meshgrid(np.arange(len(picks)), np.arange(len(clusters)))
    out: dict[int, int] = {}
    for k in np.lexsort((cluster.ravel(), pick.ravel(), far.ravel())):
        i, j = divmod(int(k), len(picks))
        if far[i, j] <= threshold and i not in out and j not in out.values():
            out[i] = j
    return out


def hue_saturation_histogram(rgb: np.ndarray, bins: int = 32) -> np.ndarray:
    x = np.asarray(rgb, float).reshape(-1, 3) / 255
    hi, lo = x.max(1), x.min(1)
    span = hi - lo
    safe = np.where(span > 0, span, 1)
    r, g, b = x.T
    hue = np.where(hi == r, (g - b) / safe % 6, np.where(hi == g, (b - r) / safe + 2, (r - g) / safe + 4)) / 6
    hue = np.where(span > 0, hue, 0)
    saturation = np.where(hi > 0, span / np.where(hi > 0, hi, 1), 0)
    return np.histogram2d(hue, saturation, bins=bins, range=[[0, 1], [0, 1.0000001]])[0]


def histogram_correlation(a: np.ndarray, b: np.ndarray) -> float:
    """1 for scenes of one colouring; constant histograms correlate only with themselves."""
    x, y = a - a.mean(), b - b.mean()
    d = np.sqrt((x**2).sum() * (y**2).sum())
    return float((x * y).sum() / d) if d > 0 else float((a == b).all())


def select_frames(quality: list[float], histograms: list[np.ndarray], k: int, same_scene: float = 0.85) -> list[int]:
    """Places of at most k good frames of different scenes, in time order; frames of quality 0 never count."""
    kept: list[int] = []
    for i in sorted((i for i, q in enumerate(quality) if q > 0), key=lambda i: (-quality[i], i)):
        if len(kept) == k:
            break
        if all(histogram_correlation(histograms[i], histograms[j]) < same_scene for j in kept):
            kept.append(i)
    return sorted(kept)


def suppress_overlaps(boxes: np.ndarray, scores: np.ndarray, limit: float = 0.5) -> list[int]:
    """Places of boxes (x, y, w, h) by falling score, without those that overlap a better one by more than the limit."""
    kept: list[int] = []
    for i in np.lexsort((np.arange(len(scores)), -scores)).tolist():
        x, y, w, h = boxes[i]
        clear = True
        for j in kept:
            a, b, c, d = boxes[j]
            inter = max(0.0, min(x + w, a + c) - max(x, a)) * max(0.0, min(y + h, b + d) - max(y, b))
            if inter > limit * (w * h + c * d - inter):
                clear = False
                break
        if clear:
            kept.append(i)
    return kept


def palette_level(pixels: int, skin_leaks: int, similar_chips: int, fallback: bool, least_pixels: int = 500) -> str:
    """`danger` for too few pixels, `warning` for leaks, near-equal chips or a fallback, else `ok`."""
    if pixels < least_pixels:
        return "danger"
    return "warning" if skin_leaks or similar_chips or fallback else "ok"


def near_equal_pairs(lab: np.ndarray, below: float = 10.0) -> int:
    if len(lab) < 2:
        return 0
    far = np.sqrt(((lab[:, None] - lab[None]) ** 2).sum(2))
    return int((far[np.triu_indices(len(lab), 1)] < below).sum())
