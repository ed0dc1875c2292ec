"""Kernels over one gray page (a NumPy array of bytes, rows first): ink, boxes, skew, contrast."""

from __future__ import annotations

import math

import numpy as np

from . import fixed as X

Box = tuple[int, int, int, int]
#: Pixels of a cell of the mask along each axis.
CELL = round(1 / X.MASK_SCALE)


def gray(pixels: bytes, width: int, height: int) -> np.ndarray:
    return np.frombuffer(pixels, np.uint8, width * height).reshape(height, width)


def ink_fraction(page: np.ndarray) -> float:
    return int(np.count_nonzero(page < X.INK_BELOW)) / page.size if page.size else 0.0


def ink_mask(page: np.ndarray) -> np.ndarray:
    """The page at a quarter of its size: a cell is set if any pixel of it is ink."""
    mask = page < X.INK_BELOW
    if not any(size % CELL for size in page.shape) and mask.size:  # equal cells: four rows, then four bytes as one number
        rows = mask.reshape(-1, CELL, page.shape[1])
        rows = rows[:, 0] | rows[:, 1] | rows[:, 2] | rows[:, 3]
        return rows.view(np.uint32) != 0
    for axis, size in enumerate(page.shape):
        cells = max(1, round(size * X.MASK_SCALE))
        mask = np.logical_or.reduceat(mask, np.floor(np.arange(cells) * (size / cells) + 0.5).astype(int), axis)
    return mask


def parts(profile: np.ndarray, gap: int, least: int) -> list[tuple[int, int]]:
    """Intervals between the middles of blank runs of ``gap`` cells or more, if ``least`` long and not blank."""
    borders = np.flatnonzero(np.diff(np.concatenate([[True], profile, [True]]).astype(np.int8)))
    runs = borders.reshape(-1, 2)
    middles = [(a + b) // 2 for a, b in runs.tolist() if b - a >= gap]
    edges = [0, *middles, len(profile)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if b - a >= least and profile[a:b].any()]


def _outwards(low: int, high: int, full: int, cells: int, margin: int) -> tuple[int, int]:
    return max(0, low * full // cells - margin), min(full, math.ceil(high * full / cells) + margin)


def boxes(page: np.ndarray, columns_only: bool = False) -> list[Box]:
    """(left, top, right, bottom) of a page's columns, or of the blocks inside them; the whole page if there are none."""
    mask = ink_mask(page)
    (height, width), (full_height, full_width) = mask.shape, page.shape
    along_x = lambda v: max(1, math.ceil(v * (width / full_width)))
    along_y = lambda v: max(1, math.ceil(v * (height / full_height)))
    columns = parts(mask.any(0), max(X.LEAST_RUN, along_x(X.GUTTER)), along_x(X.COLUMN_WIDTH)) or [(0, width)]
    margin = 0 if columns_only else X.BOX_MARGIN
    found = []
    for a, b in columns:
        rows = [(0, height)] if columns_only else parts(mask[:, a:b].any(1), along_y(X.BLOCK_GAP), along_y(X.REGION_HEIGHT))
        found += [(a, top, b, bottom) for top, bottom in rows]
    out = []
    for a, top, b, bottom in found or [(0, 0, width, height)]:
        (left, right), (up, down) = _outwards(a, b, full_width, width, margin), _outwards(top, bottom, full_height, height, margin)
        out.append((left, up, right, down))
    return out


def readable(found: list[Box], width: int, height: int) -> list[Box]:
    """Distinct boxes inside the page and high enough, by column and then from the top."""
    ok = [b for b in dict.fromkeys(found) if 0 <= b[0] < b[2] <= width and 0 <= b[1] < b[3] <= height and b[3] - b[1] >= X.REGION_HEIGHT]
    column, anchor, keyed = 0, None, []
    for b in sorted(ok, key=lambda b: b[0]):
        if anchor is None or b[0] - anchor > X.GUTTER // 2:
            column, anchor = column + 1, b[0]
        keyed.append((column, b[1], b[0], b))
    return [k[3] for k in sorted(keyed, key=lambda k: k[:3])]


def _rotation(degrees: float) -> tuple[float, float]:
    return tuple(round(f(math.radians(degrees)), 15) for f in (math.cos, math.sin))


def _between(a, b, share):
    """The value ``share`` of the way from ``a`` to ``b``; exactly ``a`` where both are equal."""
    return a + (np.subtract(b, a, dtype=float)) * share


def turned(page: np.ndarray, degrees: float, fill: int, grow: bool = False) -> np.ndarray:
    """The page turned counter-clockwise about its centre, with bilinear interpolation; ``grow`` keeps the corners."""
    height, width = page.shape
    c, s = _rotation(degrees)
    new_width, new_height = width, height
    if grow:
        xs = [x * c + y * s for x in (-width / 2, width / 2) for y in (-height / 2, height / 2)]
        ys = [y * c - x * s for x in (-width / 2, width / 2) for y in (-height / 2, height / 2)]
        new_width = math.ceil(max(xs) + width / 2) - math.floor(min(xs) + width / 2)
        new_height = math.ceil(max(ys) + height / 2) - math.floor(min(ys) + height / 2)
    x = np.arange(new_width) + 0.5 - new_width / 2
    out = np.full((new_height, new_width), fill, np.uint8)
    for low in range(0, new_height, 512):  # bands keep the temporary arrays small
        y = (np.arange(low, min(low + 512, new_height)) + 0.5 - new_height / 2)[:, None]
        from_x, from_y = x * c - y * s + width / 2, x * s + y * c + height / 2
        inside = (from_x >= 0) & (from_x < width) & (from_y >= 0) & (from_y < height)
        fx, fy = from_x[inside] - 0.5, from_y[inside] - 0.5
        x0, y0 = np.floor(fx).astype(int), np.floor(fy).astype(int)
        dx, dy = fx - x0, fy - y0
        x1, y1 = np.minimum(x0 + 1, width - 1), np.minimum(y0 + 1, height - 1)
        x0, y0 = np.maximum(x0, 0), np.maximum(y0, 0)
        upper, lower = _between(page[y0, x0], page[y0, x1], dx), _between(page[y1, x0], page[y1, x1], dx)
        out[low : low + len(y)][inside] = _between(upper, lower, dy).astype(np.uint8)
    return out


class _Turns:
    """Turns of masks of one width by one angle, from tables that do not depend on their heights.

    A row is named by its distance from the middle. Of each turned cell the tables hold where its four neighbours stand, and its value for
    each of the 16 patterns that they may form; so a turn is two look-ups for each cell. Values are those of ``turned``.
    """

    def __init__(self, width: int, odd: int, degrees: float) -> None:
        self.width, self.odd, (self.c, self.s) = width, odd, _rotation(degrees)
        self.rows, (self.at, self.values) = 0, self._made(0, 0)

    def _made(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Tables of the rows ``low`` to ``high`` below the middle."""
        w = self.width
        x = np.arange(w) + 0.5 - w / 2
        y = (np.arange(low, high) + (0 if self.odd else 0.5))[:, None]
        from_x, from_y = x * self.c - y * self.s + w / 2, x * self.s + y * self.c
        inside = (from_x >= 0) & (from_x < w)
        fx = np.where(inside, from_x - 0.5, 0.0)
        x0 = np.floor(fx)
        half = np.floor(2 * from_y)  # half rows from the middle
        dx, dy = (fx - x0)[..., None], ((from_y + (self.odd - 1) / 2) % 1.0)[..., None]
        ends = np.array([0.0, 255.0])
        pairs = _between(ends[[0, 1, 0, 1]], ends[[0, 0, 1, 1]], dx)  # left neighbour is bit 0, right one bit 1
        values = _between(pairs[..., [0, 1, 2, 3] * 4], np.repeat(pairs, 4, axis=-1), dy).astype(np.uint8)
        values[~inside] = 0
        return (half * (w + 1) + x0 + 1).astype(np.int64), values

    def grow(self, rows: int) -> None:
        """Keep tables of ``rows`` to either side of the middle."""
        lower = [self._made(-k, 256 - k) for k in range(rows, self.rows, -256)]
        upper = [self._made(k, k + 256) for k in range(self.rows, rows, 256)]
        self.at, self.values = (np.concatenate([p[n] for p in lower] + [own] + [p[n] for p in upper]) for n, own in enumerate((self.at, self.values)))
        self.rows = rows

    def sums(self, codes: np.ndarray, height: int, before: int) -> np.ndarray:
        """Sum of each turned row; ``codes`` are the patterns by half rows, ``before`` those of them above the mask."""
        out = np.empty(height)
        first = -(height // 2)
        whole = self.rows >= height // 2 + 1
        step = max(1, 65536 // self.width)  # cells at once, few enough for the processor's cache
        for k in range(0, height, step):
            n = min(step, height - k)
            if whole:
                a = self.rows + first + k
                at, values = self.at[a : a + n], self.values[a : a + n]
            else:
                at, values = self._made(first + k, first + k + n)
            # the middle lies ``height`` half rows below the mask's upper edge
            cells, turned_to = np.empty(at.shape, np.int64), np.empty(at.shape, np.uint8)
            # every place is inside; "clip" spares the copy that a check of that takes
            np.take(codes, at + (before + height) * (self.width + 1), out=cells, mode="clip")
            cells += np.arange(0, 16 * cells.size, 16).reshape(n, -1)
            np.take(values.reshape(-1), cells, out=turned_to, mode="clip")
            out[k : k + n] = turned_to.sum(1, dtype=np.uint32)
        return out


#: Bytes of tables that a worker keeps.
KEPT = 160 << 20
_turns: dict[tuple[int, int, float], _Turns] = {}


def _codes(mask: np.ndarray, guard: int) -> np.ndarray:
    """Patterns of the four neighbours about each corner of the cells, by half rows, with ``guard`` blank ones above and below."""
    p = np.pad(mask, 1, mode="edge").view(np.uint8)
    corner = p[:-1, :-1] | p[:-1, 1:] << 1 | p[1:, :-1] << 2 | p[1:, 1:] << 3
    halves = np.zeros((2 * len(mask) + 2 * guard, corner.shape[1]), np.int64)
    halves[guard : len(halves) - guard] = np.repeat(corner, 2, axis=0)[1:-1]
    return halves


def skew(page: np.ndarray, most: float = 3.0) -> float:
    """Angle to turn the page by so that its lines lie level: rows of the mask then differ most in their ink.

    Half degrees first, then a quarter degree about the best; the first of equal angles wins, 0 before all.
    """
    mask = ink_mask(page)
    height, width = mask.shape
    guard = math.ceil(2 * width * math.sin(math.radians(most + X.SKEW_FINE))) + 4
    codes, known = _codes(mask, guard), {}

    def sharpness(angle: float) -> float:
        if angle not in known:
            if angle:
                key = (width, height % 2, angle)
                turns = _turns.get(key) or _Turns(*key)
                rows = -(-(height // 2 + 1) // 256) * 256
                if turns.rows < rows and 48 * rows * width + sum(t.at.nbytes * 3 for k, t in _turns.items() if k != key) <= KEPT:
                    turns.grow(rows)
                    _turns[key] = turns
                sums = turns.sums(codes, height, guard)
            else:
                sums = mask.sum(1) * 255.0
            levels = np.floor(sums / width + 0.5)
            levels -= levels.sum() / height
            known[angle] = float((levels * levels).sum() / height)
        return known[angle]

    steps = int(most / X.SKEW_STEP)
    best = max([0.0, *[k * X.SKEW_STEP for k in range(-steps, steps + 1) if k]], key=sharpness)
    return max([best - X.SKEW_FINE, best, best + X.SKEW_FINE], key=sharpness)


def contrasted(page: np.ndarray) -> np.ndarray:
    """Gray levels stretched from 0 to 255."""
    low, high = (int(page.min()), int(page.max())) if page.size else (0, 0)
    if low >= high:
        return page
    levels = np.arange(256)
    return np.clip((levels * (255.0 / (high - low)) - low * (255.0 / (high - low))).astype(int), 0, 255).astype(np.uint8)[page]


def straightened(page: np.ndarray) -> tuple[np.ndarray, float]:
    """The page ready for recognition and the angle that it was turned by (0 if it was straight)."""
    page = contrasted(page)
    angle = skew(page)
    return (turned(page, angle, 255, True), round(angle, 2)) if abs(angle) >= X.SKEW_APPLIED else (page, 0.0)
