"""Embedding whitening by incremental eigendecomposition.

1. Each distinct integer vector is fitted once. Tasks take their vectors one by
   one as centred rank-one updates of a spectrum (``eigen_updates``).
2. The tasks' spectra are combined in rounds of FAN_IN: every axis of the one is
   a rank-one update of the other, and so is the step between their means.
3. A Rayleigh-Ritz step makes the axes exact: a distributed pass adds up the
   covariance of all fitted vectors in the basis of those axes, centred with the
   exact sums, and the eigenvectors of that small matrix turn the basis.
4. A last pass measures how far the whitened vectors' covariance is from one.

What a task or the driver holds is of the size of one covariance matrix, FAN_IN
of them while combining; the vectors themselves stay in Spark.

Defined results: rows whose vector is null or has null or non-finite entries are
left out; null and repeated ids are rows of their own; entries beyond 2^53 in
integer units are cut off there; vectors of different lengths have spaces of their
own, each fitted by itself; components without variance (equal vectors, fewer
vectors than components, empty vectors) cannot be whitened and are left out;
components of equal eigenvalue may come in any order and direction; a deviation
that no long holds is null; an empty table gives an empty result; other columns
are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.eigen_updates import Spectrum
from presslens.llm.shared import materialise

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: vectors of one task's spectrum, states put together by one task
SHARE, FAN_IN = 4096, 16
#: share of the total variance below which a component has none
NOTHING = 1e-13
LIMIT = 1 << 53
STATE = "part bigint, state binary"


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x): floor(scale * entry) + shift of every entry, of the rows that take part."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))

    def entry(c: Column) -> Column:
        scaled = F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), F.lit(float(scale)) * c.cast("double"))))
        return scaled.cast("long") + F.lit(shift).cast("long")

    # the vector is only looked at where it is known to be finite
    x = F.when(v.isNotNull() & finite, F.transform(v, entry))
    return df.select(F.col(id_col).alias("vec_id"), x.alias("x")).filter("x IS NOT NULL")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _off_centre(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly."""
    most = max(n * int(max(abs(int(x.min())), abs(int(x.max())))), *map(abs, sums)) if x.size else 0
    kind = np.int64 if 2 * most < 1 << 63 else object
    return x.astype(kind) * n - np.array(sums, dtype=kind)


def _deviations(off: np.ndarray) -> list[int | None]:
    most = max(abs(int(off.min())), abs(int(off.max()))) if off.size else 0
    if most * most * off.shape[1] < 1 << 63:
        return (off.astype(np.int64) ** 2).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in off]
    return [e if e < 1 << 63 else None for e in exact]


def _per_task(batches_to_state: Callable[[Iterator[np.ndarray]], bytes | None]):
    """A task's vectors as one row (part, state); nothing from a task without vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = batches_to_state(_matrix(b.column(0)) for b in batches if b.num_rows)
        if state is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([state], pa.binary())], ["part", "state"])

    return run


def _combined(states: DataFrame, merge: Callable[[list[bytes]], bytes], name: str) -> bytes:
    """The one state that all ``states`` come to, FAN_IN at a time in order of part."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("part").to_pylist(), table.column("state").to_pylist()))
        merged = merge([state for _, state in rows])
        return pa.table({"part": pa.array([rows[0][0] // FAN_IN], pa.int64()), "state": pa.array([merged], pa.binary())})

    states = materialise(states, name)
    parts = states.agg(F.max("part")).first()[0] + 1
    while parts > 1:
        groups = states.groupBy(F.expr(f"part div {FAN_IN}").alias("group"))
        states = materialise(groups.applyInArrow(run, STATE), name)
        parts = -(-parts // FAN_IN)
    return states.first()["state"]


def incremental_axes(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Axes of the covariance of ``fit`` (x), as columns, by falling eigenvalue."""
    # whole numbers near the mean: what tasks subtract from it is small and exact
    base = np.array([s // n for s in sums], dtype=np.int64)

    def grow(blocks: Iterator[np.ndarray]) -> bytes | None:
        spectrum = None
        for block in blocks:
            spectrum = spectrum or Spectrum(block.shape[1])
            for vector in (block - base).astype(np.float64):
                spectrum.add(vector)
        return spectrum.pack() if spectrum else None

    def merge(states: list[bytes]) -> bytes:
        first, *others = map(Spectrum.unpack, states)
        for other in others:
            first.merge(other)
        return first.pack()

    dealt = fit.repartition(-(-n // SHARE), "x")
    spectrum = Spectrum.unpack(_combined(dealt.mapInArrow(_per_task(grow), STATE), merge, "spectra"))
    # thousands of turns leave the axes short of orthogonal by their rounding
    return np.linalg.qr(spectrum.axes[:, ::-1])[0]


def projected_scatter(fit: DataFrame, n: int, sums: list[int], basis: np.ndarray, name: str) -> np.ndarray:
    """Covariance (divisor n) of the vectors of ``fit`` in ``basis``, centred before multiplying."""

    def add(blocks: Iterator[np.ndarray]) -> bytes | None:
        total = None
        for block in blocks:
            y = (_off_centre(block, n, sums).astype(np.float64) / n) @ basis
            total = y.T @ y if total is None else total + y.T @ y
        return None if total is None else total.tobytes()

    def merge(states: list[bytes]) -> bytes:
        return np.sum([np.frombuffer(s) for s in states], axis=0).tobytes()

    found = _combined(fit.mapInArrow(_per_task(add), STATE), merge, name)
    return np.frombuffer(found).reshape(basis.shape[1], basis.shape[1]) / n


def fitted(fit: DataFrame, n: int, sums: list[int], components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(basis that whitens, as columns; share of the variance of each; distance of the whitened covariance from one)."""
    axes = incremental_axes(fit, n, sums)
    values, turn = np.linalg.eigh(projected_scatter(fit, n, sums, axes, "ritz"))
    values, axes = values[::-1], axes @ turn[:, ::-1]
    total = values.sum()
    some = min(components, int((values > NOTHING * total).sum()))
    whitening = axes[:, :some] / np.sqrt(values[:some])
    if not some:
        return whitening, values[:0], 0.0
    covariance = projected_scatter(fit, n, sums, whitening, "identity")
    return whitening, values[:some] / total, float(np.abs(covariance - np.eye(some)).max())


def _whitened(n: int, sums: list[int], whitening: np.ndarray, explained: np.ndarray, error: float):
    components = len(explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            off = _off_centre(_matrix(batch.column("x")), n, sums)
            y = (off.astype(np.float64) / n) @ whitening
            rows = np.repeat(np.arange(batch.num_rows), components)
            columns = [
                batch.column("vec_id").take(pa.array(rows)),
                pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(len(rows), n, np.int64)),
                pa.array(_deviations(off), pa.int64()).take(pa.array(rows)),
                pa.array(y.ravel()),
                pa.array(np.tile(explained, batch.num_rows)),
                pa.array(np.full(len(rows), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT, components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    vectors = materialise(integer_vectors(df, id_col, vector_col, scale, shift), "vectors")
    fit = materialise(vectors.select("x").distinct(), "fit")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    kinds = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    # one row per entry of a vector, of as many lengths as there are
    entries = fit.select(F.size("x").alias("size"), F.posexplode("x"))
    sums = entries.groupBy("size", "pos").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("sum"))
    spaces: dict[int, list] = {}
    for row in sums.orderBy("size", "pos").toLocalIterator():
        spaces.setdefault(row["size"], []).append((row["n"], int(row["sum"])))
    out = df.sparkSession.createDataFrame([], kinds)
    for size, entries in spaces.items():
        n, total = entries[0][0], [s for _, s in entries]
        same = (fit, vectors) if len(spaces) == 1 else (t.filter(F.size("x") == size) for t in (fit, vectors))
        own, rows = same
        if len(spaces) > 1:
            own = materialise(own, "fit")
        whitening, explained, error = fitted(own.filter("size(x) > 0").select("x"), n, total, components)
        if len(explained):
            out = out.unionByName(rows.filter("size(x) > 0").mapInArrow(_whitened(n, total, whitening, explained, error), kinds))
    return out
