"""Vector codes by product quantisation, with memoised grid cells.

Components become integers, vectors are cut into equal parts, and each part is coded by the nearest entry of its codebook. A
part falls into a coarse grid cell. For each cell a task keeps the entries that no other entry beats all over the cell's box
(the least squared distance to the box is at most the smallest of the greatest distances), and only these are compared
exactly, in integers. So codes, errors and codebooks are exact, whatever the cells are.

Vectors that are null or hold null or non-finite components take no part. Nor do those that can't be cut into these parts:
empty ones, and those whose length isn't a multiple of the number of parts or isn't the commonest such length (ties to the
longer). With fewer vectors than entries, a codebook has as many entries as vectors. Repeated ids are rows of their own,
null ids come last, rows of equal id in the order of their vectors. An empty table gives an empty one. Other columns are not
read, whatever their names. Components beyond +-LARGEST after scaling would leave exact 64-bit distances: they are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bounded_batches, keep_only, stored, table

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Side of a grid cell in scaled units, and cells that a task keeps for each part (when they are full it starts anew).
SIDE, CELLS = 32, 1 << 15
#: Numbers that a task holds at once while it compares parts or cells with entries.
CHUNK = 1 << 20
LARGEST = 1 << 26
#: Labels whose sums are broadcast.
BROADCAST_LABELS = 200_000


class CellCache:
    """Which entries of a codebook can be nearest in a grid cell, remembered by cell."""

    def __init__(self, entries: np.ndarray, side: int = SIDE, kept: int = CELLS):
        self.entries, self.side, self.kept = entries, side, kept
        self.cells: dict[bytes, np.ndarray] = {}
        self.asked = self.made = self.compared = 0

    def _undominated(self, cells: np.ndarray) -> list[np.ndarray]:
        """Entries of each cell that no other entry beats everywhere in its box, in rising order.

        Distances to the middles of cells, by one matrix product, leave out first what the ball about the box rules out; the rest meets the box itself, in integers."""
        low = cells * self.side
        out: list[np.ndarray] = []
        step = max(1, CHUNK // max(1, self.entries.size))
        e = self.entries.astype(np.float64)
        norm = (e * e).sum(1)
        radius = (self.side - 1) / 2 * np.sqrt(low.shape[1])
        for k in range(0, len(low), step):
            part = low[k : k + step]
            middle = part + (self.side - 1) / 2
            size = (middle * middle).sum(1, keepdims=True)
            away = np.sqrt(np.maximum(size - 2 * middle @ e.T + norm, 0))
            slack = 2 * radius + 1e-6 * (1 + np.sqrt(size) + np.sqrt(norm.max(initial=0)))  # more than rounding can take
            cell, entry = np.nonzero(away <= away.min(axis=1, keepdims=True) + slack)
            below = part[cell] - self.entries[entry]  # of the lower corner from the entry
            above = below + (self.side - 1)
            least = np.maximum(np.maximum(below, -above), 0)
            most = np.maximum(np.abs(below), np.abs(above))
            near, far = (least * least).sum(1), (most * most).sum(1)
            first = np.searchsorted(cell, np.arange(len(part)))
            keep = near <= np.minimum.reduceat(far, first)[cell]
            out += np.split(entry[keep], np.cumsum(np.bincount(cell[keep], minlength=len(part)))[:-1])
        return out

    def _candidates(self, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Candidates of each different cell of x, and which of these each row has."""
        cells, at = np.unique(np.floor_divide(x, self.side), axis=0, return_inverse=True)
        if len(self.cells) + len(cells) > self.kept:
            self.cells.clear()
        keys = [c.tobytes() for c in cells]
        new = [k for k, key in enumerate(keys) if key not in self.cells]
        found = self._undominated(cells[new]) if new else []
        own = {k: c for k, c in zip(new, found, strict=True)}
        if len(cells) <= self.kept:
            self.cells.update((keys[k], c) for k, c in own.items())
        self.asked, self.made = self.asked + len(x), self.made + len(new)
        return [own[k] if k in own else self.cells[key] for k, key in enumerate(keys)], at.ravel()

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every row (ties to the lower index) and its squared distance."""
        best, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        if not len(x):
            return best, error
        lists, at = self._candidates(x)
        sizes = np.array([len(c) for c in lists])
        flat, begin = np.concatenate(lists), np.concatenate([[0], np.cumsum(sizes)])
        per_row = sizes[at]
        self.compared += int(per_row.sum())
        step = max(1, CHUNK // max(1, int(per_row.max()) * x.shape[1]))
        for k in range(0, len(x), step):
            rows = slice(k, min(k + step, len(x)))
            n = per_row[rows]
            first = np.concatenate([[0], np.cumsum(n)[:-1]])
            row = np.repeat(np.arange(len(n)), n)
            entry = flat[begin[at[rows]][row] + np.arange(len(row)) - first[row]]
            away = x[rows][row] - self.entries[entry]
            distance = (away * away).sum(1)
            least = np.minimum.reduceat(distance, first)
            hit = np.flatnonzero(distance == least[row])
            _, one = np.unique(row[hit], return_index=True)
            best[rows], error[rows] = entry[hit[one]], least
        return best, error


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None, parts: int = PARTS) -> tuple[DataFrame, int]:
    """Rows (id, label, v) of vectors that take part, and their length (0: none)."""
    v = F.col(vector_col).cast("array<double>")
    label = F.lit(None).cast("int") if label_col is None else F.col(label_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), v.alias("v")).where(F.col("v").isNotNull())
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & (F.size("v") > 0) & (F.size("v") % parts == 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    width = common[0]["n"] if common else 0
    return rows.where(F.size("v") == width), width


def integers(column: pa.Array, width: int) -> np.ndarray:
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE).reshape(-1, width)
    if x.size and np.abs(x).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // SCALE}")
    return x.astype(np.int64)


def _first_books(rows: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    """Parts of the vectors with the smallest ids: (parts, entries or fewer, width of a part). At most entries rows come to the driver."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").toArrow().column(0).combine_chunks()
    return integers(first, width).reshape(-1, parts, width // parts).transpose(1, 0, 2).copy()


def _next_books(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry replaced by the floor of the mean of its parts; those without parts stay. Tasks send sums by entry, never vectors."""
    parts, entries, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        caches = [CellCache(b) for b in books]
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = integers(batch.column(0), parts * wide)
            for p, cache in enumerate(caches):
                own = x[:, p * wide : (p + 1) * wide]
                best, _ = cache.nearest(own)
                order = np.argsort(best, kind="stable")
                ids, first = np.unique(best[order], return_index=True)
                if len(ids):
                    total[p, ids] += np.add.reduceat(own[order], first)
                    count[p] += np.bincount(best, minlength=entries)
        p, e = np.nonzero(count)
        sums = pa.FixedSizeListArray.from_arrays(pa.array(total[p, e].ravel()), wide).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), sums], ["p", "e", "n", "s"])

    sums = rows.select("v").mapInArrow(run, "p int, e int, n long, s array<long>")
    exact = [F.sum(F.col("s")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(wide)]
    out = books.copy()
    for r in sums.groupBy("p", "e").agg(F.sum("n").alias("n"), *exact).collect():
        out[r["p"], r["e"]] = [int(r[f"s{k}"]) // r["n"] for k in range(wide)]
    return out


def fit_codebooks(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width of a part) over all rows of `usable`."""
    bounded_batches(rows.sparkSession)
    books = _first_books(rows, width, parts, entries)
    for _ in range(rounds):
        books = _next_books(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error): two hex digits for each part, and the squared distances of the parts to their entries."""
    bounded_batches(rows.sparkSession)
    parts, _, wide = books.shape
    digits = np.array([f"{k:02x}" for k in range(256)], "U2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        caches = [CellCache(b) for b in books]
        for batch in batches:
            x = integers(batch.column("v"), parts * wide)
            code, error = np.zeros(len(x), f"U{2 * parts}"), np.zeros(len(x), np.int64)
            for p, cache in enumerate(caches):
                best, away = cache.nearest(x[:, p * wide : (p + 1) * wide])
                code, error = np.char.add(code, digits[best]), error + away
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(code.tolist(), pa.string()), pa.array(error)], ["id", "label", "code", "error"])

    kind = dict(rows.dtypes)["label"]
    return rows.mapInArrow(run, f"id long, label {kind}, code string, error long")


def decode(codes: DataFrame, books: np.ndarray, code_col: str = "code") -> DataFrame:
    """codes with the approximate vector (array<double>) of each in the column `vector`, by lookup in the codebooks, whose size doesn't follow the data."""
    entry = lambda p: F.conv(F.substring(code_col, 2 * p + 1, 2), 16, 10).cast("int")
    tables = [F.lit((b / SCALE).tolist()) for b in books]
    return codes.withColumn("vector", F.concat(*(F.get(t, entry(p)) for p, t in enumerate(tables))))


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal with commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """codes with the errors summed over each label, nulls together. Sums are partial before the shuffle; the join is by broadcast while labels are few, else Spark splits hot labels."""
    sums = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    few = sums.count() <= BROADCAST_LABELS
    key = lambda df: df.withColumns({"_null": F.col("label").isNull(), "_label": F.coalesce(F.col("label").cast("string"), F.lit(""))})
    own = key(sums).drop("label")
    return key(codes).join(F.broadcast(own) if few else own, ["_null", "_label"]).drop("_null", "_label")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, width = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    books = fit_codebooks(rows, width) if width else np.zeros((PARTS, 0, 1), np.int64)
    codes = stored(encode(rows, books), "codes")
    return with_label_error(codes).select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same in SQL for vectors of 64 components: inner products of whole numbers are exact in doubles."""
    wide = 64 // PARTS
    text = f"""WITH k AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        x AS (SELECT r, CAST(part AS INT) AS part, v[{wide} * part + 1:{wide} * part + {wide}] AS x FROM k CROSS JOIN range({PARTS}) s(part)),
        c0 AS (SELECT part, r - 1 AS e, x AS y FROM x WHERE r <= {ENTRIES})"""
    for n in range(ROUNDS + 1):
        text += f""", a{n} AS (SELECT x.r, x.part, min(CAST(list_inner_product(x.x, x.x) - 2 * list_inner_product(x.x, c.y) + list_inner_product(c.y, c.y) AS BIGINT) * {ENTRIES} + c.e) AS m FROM x JOIN c{n} c ON c.part = x.part GROUP BY 1, 2)"""
        if n < ROUNDS:
            text += f""", m{n} AS (SELECT part, e, list(mean ORDER BY j) AS y FROM (SELECT x.part, a.m % {ENTRIES} AS e, j, floor(sum(x.x[j]) / count(*)) AS mean FROM x JOIN a{n} a ON a.r = x.r AND a.part = x.part CROSS JOIN range(1, {wide + 1}) s(j) GROUP BY 1, 2, 3) t GROUP BY 1, 2),
            c{n + 1} AS (SELECT c.part, c.e, coalesce(m.y, c.y) AS y FROM c{n} c LEFT JOIN m{n} m ON m.part = c.part AND m.e = c.e)"""
    hexed = "lower(lpad(to_hex(m % 256), 2, '0'))"
    return f"""{text}, f AS (SELECT r, string_agg({hexed}, '' ORDER BY part) AS code, CAST(sum(m // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r),
        o AS (SELECT k.vec_id, k.label, f.code, f.error FROM f JOIN k ON k.r = f.r),
        s AS (SELECT sha256(string_agg(CAST(CAST(y[j] AS BIGINT) AS VARCHAR), ',' ORDER BY part, e, j)) AS h FROM c{ROUNDS} CROSS JOIN range(1, {wide + 1}) t(j))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s.h AS codebooks_sha256 FROM o CROSS JOIN s"""


OP13_SQL = _sql()
