"""Embedding whitening by QDWH spectral divide and conquer.

Each usable vector's entries c become whole numbers ``x = floor(64 c) + 1000000``.

1. *Covariance.* One pass sums n and S per dimension, a second one the products of ``x - round(S / n)``: both are sums of whole numbers in the
   tasks (exact in floating point as long as a chunk stays below 2^53, which its length ensures), added up by Spark per position. So V is
   the exactly centred covariance, rounded once, whatever the partitions.
2. *Eigenvectors.* Of the d x d matrix only, on the driver: the polar factor U of ``V - shift`` (QDWH: dynamically weighted Halley steps by QR) is its matrix
   sign, ``(I + U) / 2`` the projector on the eigenvectors above the shift. Bases of its range and of the complement split the matrix into two
   diagonal blocks, which are split again until blocks are single numbers or multiples of the identity.
3. *Whitening.* S, n and the d x 32 scaled eigenvectors are broadcast (d and 32 bound their size, not the rows). A third pass measures the covariance
   of the whitened vectors, the last one returns them.

At scale: four scans of one column, no shuffle of vectors; the shuffles carry one row per task and position of a sum. Hot rows or copies are
rows like others.

Cases: a vector that is null or empty, or holds a null, NaN, infinite or greater entry than 2^56 in size (no long holds its x), is dropped; so are vectors
whose length isn't the most frequent one (ties: the longer). Null ids stay null; repeated rows and ids each count and give their rows. Components are
those whose eigenvalue is above ``d * 2^-50`` of the largest (others can't be told from zero), 32 at most: with one vector, or equal
ones, there is none and the result is empty, as with an empty table. Equal eigenvalues: any orthonormal basis of their space. A deviation beyond a long is
null. Only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import ship_package

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000

_EPS = np.finfo(float).eps
_EXACT = 2.0**53
_ROWS = 4096


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QR-based QDWH: its matrix sign."""
    m = len(a)
    x = a / np.linalg.norm(a)
    r = np.linalg.qr(x, mode="r")
    diagonal = np.abs(np.diag(r))
    low = _EPS
    if diagonal.min() > _EPS * diagonal.max():
        low = max(_EPS, 1 / np.linalg.norm(np.linalg.solve(r, np.eye(m))))  # no singular value is smaller
    low = min(low, 1.0)
    for _ in range(40):
        l2 = low * low
        d = (4 * (1 - l2) / l2**2) ** (1 / 3)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - l2) / (l2 * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(m)]))[0]
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:m] @ q[m:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if moved < _EPS ** (1 / 3) and 1 - low < 1e-12:
            break
    return x


def _shifts(a: np.ndarray):
    """Numbers between the least and the greatest eigenvalue: the median of the diagonal first."""
    d = np.sort(np.diag(a))
    yield np.median(d)
    yield d.mean()
    yield from (d[1:] + d[:-1]) / 2
    spread = np.linalg.norm(a - d.mean() * np.eye(len(a)))
    yield from (d.mean() + spread * t for t in (1e-3, -1e-3, 0.1, -0.1, 0.01, -0.01))


def split(a: np.ndarray, scale: float):
    """An orthonormal basis ``(above, below)`` of two invariant subspaces of a symmetric matrix."""
    m, best = len(a), None
    start = np.random.default_rng(m).standard_normal((m, m))
    for shift in _shifts(a):
        moved = a - shift * np.eye(m)
        if not np.linalg.norm(moved):
            continue
        projector = (polar(moved) + np.eye(m)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < m:
            continue
        above = np.linalg.qr(projector @ start[:, :k])[0]
        above = np.linalg.qr(projector @ above)[0]
        below = np.linalg.qr((np.eye(m) - projector) @ start[:, k:])[0]
        below = np.linalg.qr((np.eye(m) - projector) @ below)[0]
        q = np.linalg.qr(np.hstack([above, below]))[0]
        error = np.linalg.norm(q[:, k:].T @ a @ q[:, :k])
        if best is None or error < best[0]:
            best = (error, q[:, :k], q[:, k:])
        if error <= 10 * m * _EPS * scale:
            break
    return best


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and their unit eigenvectors (columns) of a symmetric matrix."""
    scale = float(np.linalg.norm(v))
    values, vectors = [], []
    todo = [(v, np.eye(len(v)))]
    while todo:
        a, basis = todo.pop()
        m = len(a)
        off = a - np.diag(np.diag(a))
        # a multiple of the identity, as far as doubles tell: any basis is one of eigenvectors
        if m == 1 or max(np.abs(off).max(), np.ptp(np.diag(a))) <= _EPS * scale or (found := split(a, scale)) is None:
            values += list(np.diag(a))
            vectors += list(basis.T)
            continue
        for q in found[1:]:
            part = q.T @ a @ q
            todo.append(((part + part.T) / 2, basis @ q))
    q = np.linalg.qr(np.array(vectors).T)[0] if vectors else np.zeros((0, 0))
    values = np.einsum("ij,ij->j", q, v @ q) if len(values) else np.zeros(0)
    order = np.argsort(-values, kind="stable")
    return values[order], q[:, order]


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, vector)`` of the rows with a vector of finite entries."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(2.0**56)))
    return df.select(v.alias("vector"), F.col(f"`{id_col}`").cast("long").alias("vec_id")).where((F.size("vector") > 0) & F.coalesce(good, F.lit(False)))


def _entries(batch) -> np.ndarray:
    """The x of a batch of vectors of one length, as long numbers."""
    c = batch.column(0).flatten().to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * c).astype(np.int64) + SHIFT).reshape(batch.num_rows, -1)


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _exact_sum(x: np.ndarray) -> np.ndarray:
    """Sums per column as Python ints."""
    if len(x) and float(np.abs(x).max()) * len(x) >= 2.0**62:
        return x.astype(object).sum(axis=0)
    return x.sum(axis=0).astype(object)


def _exact_products(z: np.ndarray) -> np.ndarray:
    """``z' z`` as Python ints: chunks whose sums of products doubles hold exactly."""
    most = float(np.abs(z).max(initial=0))
    if most * most >= _EXACT:
        z = z.astype(object)
        return z.T.dot(z)
    out = np.zeros((z.shape[1],) * 2, object)
    step = max(1, int(_EXACT / max(1.0, most * most)))
    for at in range(0, len(z), step):
        part = z[at:at + step].astype(float)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


_SUMS = pa.schema([("dims", pa.int64()), ("position", pa.int64()), ("value", pa.decimal128(28, 0))])
_SUMS_DDL = "dims long, position long, value decimal(28,0)"


def _rows(dims: int, values) -> pa.RecordBatch:
    values = [decimal.Decimal(int(v)) for v in values]
    return pa.record_batch([pa.array([dims] * len(values), pa.int64()), pa.array(range(len(values)), pa.int64()),
                            pa.array(values, pa.decimal128(28, 0))], schema=_SUMS)


def _summed(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("value").alias("value"))


def fit(vectors: DataFrame) -> dict | None:
    """Of the usable vectors: ``n``, ``sums``, their length, eigenvalues and eigenvectors of the covariance. None without vectors."""
    def sums(batches):
        total: dict[int, np.ndarray] = {}
        for batch in _slices(batches):
            lengths = pc.list_value_length(batch.column(0))
            for d in pc.unique(lengths).to_pylist():
                x = _entries(batch.filter(pc.equal(lengths, d)))
                found = np.append(_exact_sum(x), len(x))
                total[d] = total[d] + found if d in total else found
        for d, values in total.items():
            yield _rows(d, values)

    found: dict[int, dict[int, int]] = {}
    counted = _summed(vectors.mapInArrow(sums, _SUMS_DDL), "dims", "position")
    # the number of vectors is at the position after the entries: of different lengths only that one
    most = counted.where("position = dims").orderBy(F.desc("value"), F.desc("dims")).first()
    if most is None:
        return None
    d = most["dims"]
    found = {r["position"]: int(r["value"]) for r in counted.where(F.col("dims") == d).collect()}
    n, total = found.pop(d), [found[i] for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in total]

    def products(batches):
        middle, out, upper = np.array(centre, np.int64), np.zeros((d, d), object), np.triu_indices(d)
        for batch in _slices(batches):
            out += _exact_products(_entries(batch) - middle)
        yield _rows(d, out[upper])

    same = vectors.where(F.size("vector") == d)
    v = np.zeros((d, d))
    rest = [s - n * c for s, c in zip(total, centre, strict=True)]
    where = list(zip(*np.triu_indices(d), strict=True))
    for r in _summed(same.mapInArrow(products, _SUMS_DDL), "position").collect():  # d (d + 1) / 2 sums
        i, j = where[r["position"]]
        v[i, j] = v[j, i] = (n * int(r["value"]) - rest[i] * rest[j]) / (n * n)
    values, basis = eigen(v)
    return {"n": n, "sums": total, "dims": d, "centre": centre, "rest": rest, "values": values, "vectors": basis, "trace": float(np.trace(v))}


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    ship_package(spark)
    ddl = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors = usable(df, id_col, vector_col)
    model = fit(vectors)
    values = model["values"][:components] if model else np.zeros(0)
    k = int((values > model["dims"] * 2.0**-50 * values[0]).sum()) if len(values) and values[0] > 0 else 0
    if not k:
        return spark.createDataFrame([], ddl)
    n, d = model["n"], model["dims"]
    axes = model["vectors"][:, :k] / np.sqrt(values[:k])
    shared = spark.sparkContext.broadcast((axes, np.array(model["centre"], np.int64), np.array([float(r) for r in model["rest"]]) / n,
                                           model["rest"], values[:k] / model["trace"]))
    same = vectors.where(F.size("vector") == d)
    square = np.triu_indices(k)

    def moments(batches):
        axes, centre, rest, _, _ = shared.value
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in _slices(batches):
            w = (_entries(batch) - centre - rest) @ axes
            first += w.sum(axis=0)
            second += w.T @ w
        found = np.concatenate([first, second[square]])
        yield pa.record_batch({"position": pa.array(range(len(found)), pa.int64()), "value": pa.array(found)})

    found = {r["position"]: r["value"] for r in _summed(same.mapInArrow(moments, "position long, value double"), "position").collect()}
    mean, covariance = np.array([found[i] for i in range(k)]) / n, np.zeros((k, k))
    covariance[square] = np.array([found[k + i] for i in range(len(square[0]))]) / n
    error = float(np.abs(covariance - np.triu(np.outer(mean, mean)) - np.eye(k)).max())

    def run(batches):
        axes, centre, shift, rest, explained = shared.value
        whole = np.array(rest, object)
        for batch in _slices(batches):
            z = _entries(batch) - centre
            m = len(z)
            if (float(np.abs(z).max(initial=0)) * n + max(map(abs, rest))) ** 2 * d < 2.0**62:
                y = z * n - np.array(rest, np.int64)
                deviation = (y * y).sum(axis=1).tolist()
            else:
                deviation = [v if (v := int((y * y).sum())) < 2**63 else None for y in z.astype(object) * n - whole]
            w = (z - shift) @ axes
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.record_batch({
                "vec_id": batch.column(1).take(at), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                "n": pa.array(np.full(m * k, n)), "deviation": pa.array(deviation, pa.int64()).take(at), "whitened": pa.array(w.ravel()),
                "explained": pa.array(np.tile(explained, m)), "identity_error": pa.array(np.full(m * k, error))})

    return same.mapInArrow(run, ddl)
