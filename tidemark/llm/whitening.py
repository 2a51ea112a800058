"""Whitening of vectors by their covariance, from exact products of integer digits.

Vectors are fixed-point integers.  Covariances are taken over the list of the
different vectors: with n vectors of sums S, every vector is centred as n * x - S,
which is an integer again.  Tasks split those into balanced digits of LIMB bits
and multiply digit matrices with float64 BLAS: all sums stay below 2**53, so the
products are exact.  A task puts its digit products together again as big
integers, row by row of the product; rows are summed by a shuffle, and the driver
divides by n**3, rounding once, and takes eigenvectors.

What reaches the driver: d * (d + 1) / 2 integers for vectors of d numbers,
whatever their count.  A task holds its digit products, 8 * d**2 bytes for each
of some 2 * bits / LIMB places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import small_batches, written

#: Bits of a digit; rows multiplied at once, so that products of digits stay below 2**53.
LIMB, ROWS = 8, 1 << 20
#: Fractional steps of an entry: x = floor(SCALE * c).
SCALE = 256


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Balanced digits of integers, lowest first, as float64: y = sum of digit[k] * 2**(LIMB * k)."""
    out, half, mask = [], 1 << (LIMB - 1), (1 << LIMB) - 1
    while y.any():
        low = ((y + half) & mask) - half
        out.append(low.astype(np.float64))
        y = (y - low) >> LIMB
    return out


def add_products(places: dict[int, np.ndarray], y: np.ndarray) -> None:
    """Add y.T @ y to its digit places, each an int64 matrix."""
    for at in range(0, len(y), ROWS):
        digits = limbs(y[at : at + ROWS])
        for s, a in enumerate(digits):
            for t in range(s, len(digits)):
                p = (a.T @ digits[t]).astype(np.int64)
                places[s + t] = places.get(s + t, 0) + (p if s == t else p + p.T)


def recombined(places: dict[int, np.ndarray], d: int) -> np.ndarray:
    """The big integers whose digit places are given."""
    out = np.zeros((d, d), object)
    for place, p in places.items():
        out += p.astype(object) * (1 << (LIMB * place))
    return out


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(d, places of the rows, int64 matrix) for each length of the vectors in column x."""
    x = batch.column("x")
    size = pc.list_value_length(x).to_numpy(zero_copy_only=False)
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        if d:
            yield d, at, x.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


class Fit:
    """Count and sums of the vectors of one length, later their components.

    Integers that could leave 64 bits are handled as Python's own.
    """

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.sums = n, sums
        self.vectors = self.values = None
        self.trace = 0.0
        self.error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly."""
        most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
        if self.n * most + max(map(abs, self.sums), default=0) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def decompose(self, products: list[list[int]], most: int) -> None:
        """Components from the sums of products of centred vectors; those whose variance is lost in rounding have none."""
        d = len(products)
        v = np.array([[p / self.n**3 for p in row] for row in products])
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
        self.trace = sum(products[i][i] for i in range(d)) / self.n**3
        self.values = np.where(values > self.trace * d * np.finfo(float).eps, values, 0.0)
        self.vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])

    def projected(self, y: np.ndarray) -> np.ndarray:
        """Whitened coordinates of centred vectors; not a number where a component has no variance."""
        flat = (y if y.dtype == np.int64 else y.astype(np.float64)) / self.n
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, flat @ self.vectors / np.sqrt(self.values), np.nan)


def integers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, x) of the vectors that are not null and hold finite numbers only; x: floor(SCALE * c), at the ends of a long beyond it."""
    c = F.col(vector)
    finite = c.isNotNull() & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.where(F.coalesce(finite, F.lit(False))).select(F.col(key).cast("long").alias("id"), F.transform(c, lambda e: F.floor(SCALE * e.cast("double"))).alias("x"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, n, sums in decimal digits) of a task's vectors."""
    held: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for d, at, x in matrices(batch):
            n, total = held.get(d, (0, np.zeros(d, object)))
            for place, digit in enumerate(limbs(x if x.size and max(-int(x.min()), int(x.max())) < 1 << 62 else x.astype(object))):
                total = total + digit.sum(axis=0).astype(np.int64).astype(object) * (1 << (LIMB * place))
            held[d] = n + len(at), total
    for d, (n, total) in held.items():
        yield pa.record_batch([pa.array([d]), pa.array([0]), pa.array([n]), pa.array([[str(t) for t in total]])], ["d", "i", "n", "v"])


def _products(fits: dict[int, Fit]):
    """(d, i, 0, row i of the sums of products from the diagonal on)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[int, np.ndarray]] = {}
        for batch in batches:
            for d, _, x in matrices(batch):
                add_products(held.setdefault(d, {}), fits[d].centred(x))
        for d, places in held.items():
            whole = recombined(places, d)
            for i in range(d):
                yield pa.record_batch([pa.array([d]), pa.array([i]), pa.array([0]), pa.array([[str(v) for v in whole[i, i:]]])], ["d", "i", "n", "v"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows (n, v) of each (d, i), which all come to one task."""
    held: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            n, v = held.get((r["d"], r["i"]), (0, 0))
            held[r["d"], r["i"]] = n + r["n"], v + np.array([int(x) for x in r["v"]], object)
    for (d, i), (n, v) in held.items():
        yield pa.record_batch([pa.array([d]), pa.array([i]), pa.array([n]), pa.array([[str(x) for x in v]])], ["d", "i", "n", "v"])


_ROW = "d long, i long, n long, v array<string>"


def _merged(rows: DataFrame) -> list:
    return rows.repartition("d", "i").mapInArrow(_merge, _ROW).collect()


def _spread(fits: dict[int, Fit], means: dict[int, np.ndarray] | None):
    """(d, i, j, s): sums of the whitened coordinates, or of their products once the means are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in matrices(batch):
                w = fits[d].projected(fits[d].centred(x))
                if means is not None:
                    w = w - means[d]
                held[d] = held.get(d, 0) + (w.sum(axis=0)[None] if means is None else w.T @ w)
        for d, s in held.items():
            i, j = np.indices(s.shape).reshape(2, -1)
            yield pa.record_batch([pa.array(np.full(len(i), d)), pa.array(i), pa.array(j), pa.array(s.ravel())], ["d", "i", "j", "s"])

    return run


def fitted(fit: DataFrame, components: int) -> dict[int, Fit]:
    """A Fit for each length of the different vectors x of a written table."""
    fits = {r.d: Fit(r.n, [int(v) for v in r.v]) for r in _merged(fit.mapInArrow(_sums, _ROW))}
    if not fits:
        return fits
    products = {d: [[0] * d for _ in range(d)] for d in fits}
    for r in _merged(fit.mapInArrow(_products(fits), _ROW)):
        for j, v in enumerate(map(int, r.v), r.i):
            products[r.d][r.i][j] = products[r.d][j][r.i] = v
    for d, f in fits.items():
        f.decompose(products.pop(d), components)

    def total(means):
        out = {d: np.zeros((1 if means is None else len(f.values), len(f.values))) for d, f in fits.items()}
        for r in fit.mapInArrow(_spread(fits, means), "d long, i long, j long, s double").groupBy("d", "i", "j").agg(F.sum("s").alias("s")).collect():
            out[r.d][r.i, r.j] = r.s
        return out

    spread = total({d: s[0] / fits[d].n for d, s in total(None).items()})
    for d, f in fits.items():
        some = f.values > 0
        off = np.abs(spread[d] / f.n - np.eye(len(some)))[np.ix_(some, some)]
        f.error = float(off.max()) if off.size else None
    return fits


def _coordinates(fits: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, x in matrices(batch):
                f, ids = fits[d], batch.column("id").take(pa.array(at))
                y = f.centred(x)
                small = y.dtype == np.int64 and d * max(int(y.max()), -int(y.min())) ** 2 < 1 << 63
                squares = (y * y).sum(axis=1) if small else (y.astype(object) ** 2).sum(axis=1)
                text = pa.array(list(map(str, squares.tolist())))
                deviation = pa.array(squares) if small else pa.array([s if s < 1 << 63 else None for s in squares.tolist()], pa.int64())
                w = f.projected(y)
                for c, e in enumerate(f.values.tolist()):
                    same = [pa.array([v] * len(at), t) for v, t in ((c + 1, pa.int32()), (f.n, pa.int64()), (e / f.trace if f.trace else None, pa.float64()), (f.error, pa.float64()))]
                    yield pa.record_batch([ids, same[0], same[1], deviation, text, pa.array(w[:, c], from_pandas=True), same[2], same[3]], ["id", "component", "n", "deviation", "deviation_text", "whitened", "explained", "identity_error"])

    return run


def whitened(vectors: DataFrame, key: str = "id", vector: str = "vector", components: int = 4) -> DataFrame:
    """id, component, n, deviation, deviation_text, whitened, explained, identity_error: a row for each vector and component.

    Components are the unit eigenvectors of the covariance of the different
    vectors (n of them), numbered from 1 by falling eigenvalue; the largest entry
    of each is positive.  deviation: the exact sum of squares of n * x - S, null
    where a long can't hold it; deviation_text has it in any size.  explained: the
    component's share of the variance.  identity_error: the largest absolute entry
    of the covariance of the whitened vectors, measured, minus the identity.

    Null vectors, and those with null or non-finite entries, are left out; so are
    empty ones, which have no component.  Vectors of each length are a space of
    their own, with its own n, components and error (few lengths are expected: the
    driver holds a matrix for each).  Components without variance (one vector,
    constant or dependent entries) have explained 0, or null where nothing varies,
    and whitened null, and do not count in identity_error.  Repeated rows and rows
    without an id come out as often as they stand; other columns are ignored.  An
    empty table gives no rows.
    """
    small_batches(vectors.sparkSession)
    rows = integers(vectors, key, vector)
    fits = fitted(written(rows.select("x").distinct(), "vectors"), components)
    return rows.mapInArrow(_coordinates(fits), "id long, component int, n long, deviation long, deviation_text string, whitened double, explained double, identity_error double")
