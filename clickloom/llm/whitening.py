"""Whitening of embeddings on their leading principal components, by Jacobi-Davidson.

Vectors become whole numbers, are kept in blocks of rows in the shared folder,
and only ever meet the driver as products: a job multiplies every centred row
into a few vectors and adds up the results, so neither rows nor the covariance
leave the tasks. The driver holds vectors of the dimension only.

A search space starts at random. Each step takes the leading Ritz pairs of the
space (Rayleigh-Ritz), locks those whose residual has reached double precision,
and solves for each other one the correction equation, the covariance shifted by
the Ritz value and projected off the locked and current vectors, by a few steps
of MINRES. All equations share a product per step. The corrections widen the
space, which is restarted from its best vectors when it is full. At the end all
residuals are taken anew from one more product, and pairs that fail go on.

Components are numbered by falling eigenvalue. Those without variance (an
eigenvalue of rounding size) are left out, so there can be fewer than asked for,
and none for equal vectors or a single one. Equal eigenvalues have any basis of
their plane; all rows use the same one.

Defined cases: vectors that are null or empty, or hold a null, a non-finite
value or one beyond ``MOST`` in size (whose whole number would not be exact), are
dropped; so are those that have not the most common length (of equally common
ones the longest counts). Repeated rows and ids count each, a null id is returned
as it is. ``deviation`` is null where it passes the range of a long. Further
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import cut

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
MOST = 2.0**40
BLOCK_BYTES = 4 << 20

GUARDS = 2  # further pairs that are sought with the wanted ones but not awaited
INNER_STEPS = 5
MOST_VECTORS = 96  # of the search space, before it is restarted
# Residuals against the largest eigenvalue: some units in the last place.
PRECISION = 64 * np.finfo(np.float64).eps
MOST_ROUNDS = 300
SEED = 11

BLOCKS = "ids array<long>, numbers binary"


class Moments(NamedTuple):
    """Of the whole numbers: rows, sums per dimension, greatest size."""

    n: int
    sums: list[int]
    largest: int

    @property
    def dims(self) -> int:
        return len(self.sums)


class Components(NamedTuple):
    values: np.ndarray  # falling
    vectors: np.ndarray  # one column each


def blocks_of(embeddings: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """Rows of ``BLOCKS``, each a matrix of whole numbers, and their number of dimensions."""
    vector = F.col(column).cast("array<double>")
    sound = F.forall(vector, lambda c: F.coalesce(F.abs(c) <= MOST, F.lit(False)))
    rows = embeddings.select("vec_id", vector.alias("v")).filter(sound & (F.size("v") > 0))
    lengths = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("dims")).first()
    dims = common["dims"] if common else 0
    per_block = max(BLOCK_BYTES // (8 * max(dims, 1)), 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, per_block):
                batch = whole.slice(at, per_block)
                values = batch.column("v").flatten().to_numpy(zero_copy_only=False)
                numbers = np.floor(SCALE * values).astype(np.int64) + SHIFT
                ids = batch.column("vec_id").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids], pa.list_(pa.int64())), pa.array([numbers.tobytes()])],
                    ["ids", "numbers"],
                )

    # A null is unequal, and NaN sorts above all numbers, so both fail the test above.
    kept = rows.filter(F.size("v") == dims)
    return cut(kept.mapInArrow(run, BLOCKS)), dims


def matrices(batches: Iterable[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, list]]:
    for batch in batches:
        for ids, numbers in zip(batch.column("ids"), batch.column("numbers"), strict=True):
            yield np.frombuffer(numbers.as_py(), np.int64).reshape(-1, dims), ids


def summed(blocks: DataFrame, values: Callable, n_values: int, kind: str = "double") -> np.ndarray:
    """The sum of a vector per task: ``values`` gives it for the task's batches.

    Tasks add up by place in the shuffle; the driver gets one vector.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = values(batches)
        if total is not None:
            places = pa.array(np.arange(n_values, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([places, pa.array(total)], ["place", "value"])

    rows = blocks.mapInArrow(run, f"place int, value {kind}")
    out = np.zeros(n_values, np.float64 if kind == "double" else np.int64)
    for place, value in rows.groupBy("place").agg(F.sum("value")).collect():
        out[place] = value
    return out


def moments(blocks: DataFrame, dims: int) -> Moments:
    """Exact sums: the upper and lower bits of the numbers are added up apart."""

    def run(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for x, _ in matrices(batches, dims):
            parts = [[len(x)], (x >> 26).sum(0), (x & 0x3FFFFFF).sum(0)]
            one = np.concatenate(parts)
            total = one if total is None else total + one
        return total

    found = summed(blocks, run, 1 + 2 * dims, "long").tolist()
    sums = [(high << 26) + low for high, low in zip(found[1 : dims + 1], found[dims + 1 :], strict=True)]

    def largest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max((int(np.abs(x).max()) for x, _ in matrices(batches, dims)), default=0)
        yield pa.RecordBatch.from_arrays([pa.array([most], pa.int64())], ["most"])

    most = blocks.mapInArrow(largest, "most long").agg(F.max("most")).first()[0]
    return Moments(found[0], sums, most or 0)


def differences(x: np.ndarray, of: Moments) -> np.ndarray:
    """n * x - sums, exact: whole numbers, of Python's where 64 bits do not hold them."""
    if 2 * of.n * max(of.largest, 1) < 2**62:
        return of.n * x - np.array(of.sums, np.int64)
    return of.n * x.astype(object) - np.array(of.sums, object)


def centred(x: np.ndarray, of: Moments) -> np.ndarray:
    return (differences(x, of) / of.n).astype(np.float64)


def deviations(x: np.ndarray, of: Moments) -> list[int | None]:
    """The exact sum of squares of each row's differences; None beyond a long."""
    d = differences(x, of)
    widest = 2 * of.n * max(of.largest, 1)
    if of.dims * (widest >> 24) * max(widest >> 24, 1 << 24) < 2**62:
        high, low = d >> 24, d & 0xFFFFFF
        parts = ((high * high).sum(1), (high * low).sum(1), (low * low).sum(1))
        hh, hl, ll = (p.tolist() for p in parts)
        totals = [(a << 48) + (b << 25) + c for a, b, c in zip(hh, hl, ll, strict=True)]
    else:
        totals = [int(t) for t in (d.astype(object) ** 2).sum(1)]
    return [t if t < 2**63 else None for t in totals]


def covariance_product(blocks: DataFrame, of: Moments) -> Callable[[np.ndarray], np.ndarray]:
    """Vectors (columns) to the covariance times each of them, by one job."""

    def product(vectors: np.ndarray) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
            total = None
            for x, _ in matrices(batches, of.dims):
                rows = centred(x, of)
                one = rows.T @ (rows @ vectors)
                total = one if total is None else total + one
            return None if total is None else total.ravel()

        return summed(blocks, run, vectors.size).reshape(vectors.shape) / of.n

    return product


def trace(blocks: DataFrame, of: Moments) -> float:
    def run(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
        squares = [float((centred(x, of) ** 2).sum()) for x, _ in matrices(batches, of.dims)]
        return np.array([sum(squares)]) if squares else None

    return float(summed(blocks, run, 1)[0] / of.n)


def widened(basis: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Orthonormal columns that add ``vectors`` to the orthonormal ``basis``."""
    kept = []
    for v in vectors.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        before = np.column_stack([basis, *kept])
        for _ in range(3):
            v = v - before @ (before.T @ v)
        left = np.linalg.norm(v)
        if left < 1e-10:
            continue
        v = v / left
        v = v - before @ (before.T @ v)
        kept.append(v / np.linalg.norm(v))
    return np.column_stack(kept) if kept else np.empty((len(basis), 0))


def minres(apply: Callable, right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of one symmetric system per column, a product for all per step."""
    norm = lambda x: np.linalg.norm(x, axis=0)
    over = lambda x, y: np.divide(x, y, out=np.zeros_like(x * y), where=y > 0)
    beta = norm(right)
    v_before, v = np.zeros_like(right), over(right, beta)
    w_before, w = np.zeros_like(right), np.zeros_like(right)
    eta, x = beta.copy(), np.zeros_like(right)
    cosine_before, cosine = np.ones_like(beta), np.ones_like(beta)
    sine_before, sine = np.zeros_like(beta), np.zeros_like(beta)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        image = apply(v)
        alpha = (v * image).sum(0)
        ahead = image - alpha * v - beta * v_before
        beta_ahead = norm(ahead)
        # The new column of the tridiagonal matrix, turned by the last two rotations.
        delta = cosine * alpha - cosine_before * sine * beta
        off = sine * alpha + cosine_before * cosine * beta
        far = sine_before * beta
        rho = np.hypot(delta, beta_ahead)
        cosine_before, sine_before = cosine, sine
        cosine, sine = over(delta, rho), over(beta_ahead, rho)
        w_before, w = w, over(v - far * w_before - off * w, rho)
        x = x + cosine * eta * w
        eta = -sine * eta
        v_before, v, beta = v, over(ahead, beta_ahead), beta_ahead
    return x


def leading_pairs(
    product: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int = COMPONENTS
) -> Components:
    """The ``wanted`` largest eigenpairs of a symmetric operator known by its products."""
    rng = np.random.default_rng(SEED)
    wanted = min(wanted, dims)
    block = min(wanted + GUARDS, dims)
    locked, locked_values = np.empty((dims, 0)), np.empty(0)
    space = widened(locked, rng.standard_normal((dims, block)))
    images = product(space)
    largest, checked = 0.0, False
    for _ in range(MOST_ROUNDS):
        small = space.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, images = space @ turn, images @ turn
        largest = max(largest, float(values[:1].sum()))
        awaited = wanted - locked.shape[1]
        sought = min(awaited + GUARDS, space.shape[1])
        residuals = images[:, :sought] - space[:, :sought] * values[:sought]
        sizes = np.linalg.norm(residuals, axis=0)
        # With all directions in the space, what is left is rounding.
        whole = locked.shape[1] + space.shape[1] == dims
        done = 0
        while done < min(awaited, sought) and (whole or sizes[done] <= PRECISION * largest):
            done += 1
        locked = np.column_stack([locked, space[:, :done]])
        locked_values = np.concatenate([locked_values, values[:done]])
        space, images, values = space[:, done:], images[:, done:], values[done:]
        residuals = residuals[:, done:]
        if locked.shape[1] == wanted:
            anew = np.linalg.norm(product(locked) - locked * locked_values, axis=0)
            sound = anew <= 4 * PRECISION * largest
            if sound.all() or whole or checked:
                order = np.argsort(-locked_values, kind="stable")
                return Components(locked_values[order], locked[:, order])
            checked = True
            again = np.column_stack([locked[:, ~sound], space])
            locked, locked_values = locked[:, sound], locked_values[sound]
            space = widened(locked, again)
            images = product(space)
            continue
        if space.shape[1] > MOST_VECTORS:
            space, images = space[:, : 2 * block], images[:, : 2 * block]
        shifts = values[: residuals.shape[1]]
        fixed = np.column_stack([locked, space[:, : residuals.shape[1]]])

        def projected(v: np.ndarray) -> np.ndarray:
            out = product(v) - v * shifts  # noqa: B023
            return out - fixed @ (fixed.T @ out)  # noqa: B023

        right = fixed @ (fixed.T @ residuals) - residuals
        held = np.column_stack([locked, space])
        new = widened(held, minres(projected, right, INNER_STEPS))
        if not new.shape[1] and held.shape[1] < dims:
            new = widened(held, rng.standard_normal((dims, min(block, dims - held.shape[1]))))
        if new.shape[1]:
            space = np.column_stack([space, new])
            images = np.column_stack([images, product(new)])
    raise ArithmeticError(f"no {wanted} components after {MOST_ROUNDS} rounds")


OUTPUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row of ``OUTPUT`` per usable vector and component."""
    spark = embeddings.sparkSession
    blocks, dims = blocks_of(embeddings)
    of = moments(blocks, dims) if dims else Moments(0, [], 0)
    total = trace(blocks, of) if of.n else 0.0
    if not total > 0:
        return spark.createDataFrame([], OUTPUT)
    found = leading_pairs(covariance_product(blocks, of), dims, components)
    real = found.values > dims * PRECISION * found.values[0]
    values = found.values[real]
    onto = found.vectors[:, real] / np.sqrt(values)
    k = len(values)

    def spread(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
        sums = None
        for x, _ in matrices(batches, dims):
            y = centred(x, of) @ onto
            one = np.concatenate([y.sum(0), (y.T @ y).ravel()])
            sums = one if sums is None else sums + one
        return sums

    sums = summed(blocks, spread, k + k * k) / of.n
    covariance = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])
    error = float(np.abs(covariance - np.eye(k)).max())

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, ids in matrices(batches, dims):
            m = len(x)
            deviation = pa.array(deviations(x, of), pa.int64())
            each = pa.array(np.repeat(np.arange(m), k))
            columns = [
                ids.values.take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, of.n)),
                deviation.take(each),
                pa.array((centred(x, of) @ onto).ravel()),
                pa.array(np.tile(values / total, m)),
                pa.array(np.full(m * k, error)),
            ]
            names = [field.split()[0] for field in OUTPUT.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    return blocks.mapInArrow(rows, OUTPUT)
