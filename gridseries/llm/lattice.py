"""Embedding near-duplicates by lattice hashing.

Each table projects unit vectors on random orthonormal directions, scales them, and decodes every
block of eight coordinates to the nearest point of the E8 lattice; the points of the blocks name a
cell. A vector stands in its own cell and asks in the neighbouring cells nearest to it. Vectors that
meet in a cell are verified by their cosine.

Equal vectors of one label are one class with a count, so copies are never expanded. A cell of many
classes is cut into chunks that meet two by two, so no task holds more than two chunks; a task gives
counts of links and a spanning forest of them, never its pairs. A pair that meets in several tables
is counted in the first one alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.llm.common import components, cut, usable_vector

MIN_COSINE = 0.93
#: Tables, E8 blocks of a table, scale of the projections, neighbouring cells asked per table. One setting for
#: tables of any size, so which links are found never depends on how many other vectors there are.
SETTING = (9, 2, 5.0, 16)
SETTINGS = [("any", SETTING)]
SEED = 23
#: Pairs whose cosines are taken at once.
PAIRS_AT_ONCE = 100_000
#: Classes of one chunk of a cell, on average.
CHUNK_ROWS = 512

#: The 240 shortest vectors of E8, doubled so that all coordinates are whole numbers.
MINIMAL = np.array(
    [[2 * s if k == i else 2 * t if k == j else 0 for k in range(8)] for i, j in combinations(range(8), 2) for s, t in product((1, -1), repeat=2)]
    + [list(signs) for signs in product((1, -1), repeat=8) if signs.count(-1) % 2 == 0],
    dtype=np.int64,
)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest point with whole coordinates of even sum, for each row."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    if len(odd):
        gap = x[odd] - near[odd]
        worst = np.abs(gap).argmax(axis=1)
        near[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row, doubled."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], 2 * whole, 2 * half).astype(np.int64)


def frames(dim: int, tables: int, blocks: int, seed: int = SEED) -> np.ndarray:
    """Projection (tables, dim, 8 * blocks); columns are orthonormal as far as ``dim`` allows."""
    draw = np.random.default_rng([seed, dim])
    out = []
    for _ in range(tables):
        q, _ = np.linalg.qr(draw.standard_normal((max(dim, 8 * blocks), 8 * blocks)))
        out.append(q[:dim])
    return np.stack(out)


def _mix(points: np.ndarray, seed: int) -> np.ndarray:
    """63-bit name of each row of whole numbers. Equal names of unequal cells only add pairs to verify."""
    factors = np.random.default_rng(seed).integers(1, 2**63, size=points.shape[1], dtype=np.uint64) | np.uint64(1)
    name = (points.astype(np.uint64) * factors).sum(axis=1, dtype=np.uint64)
    name ^= name >> np.uint64(29)
    return ((name * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(1)).astype(np.int64)


def cells(units: np.ndarray, tables: int, blocks: int, scale: float, probes: int) -> np.ndarray:
    """Names (row, table, 1 + probes): the home cell, then the neighbouring cells nearest to the row."""
    n, dim = units.shape
    out = np.empty((n, tables, 1 + probes), dtype=np.int64)
    # near vectors differ by about sqrt(8 * blocks / dim) of their distance in a projection
    stretch = scale * np.sqrt(max(dim, 8 * blocks) / 64)
    for t, frame in enumerate(frames(dim, tables, blocks)):
        x = (units @ frame) * stretch
        parts = [x[:, 8 * b : 8 * b + 8] for b in range(blocks)]
        points = [decode_e8(p) for p in parts]
        home = np.concatenate(points, axis=1)
        out[:, t, 0] = _mix(home, t)
        # squared distance to home + v is |r|^2 - 2 r.v + |v|^2 with |v|^2 = 2 for all v
        gains = np.concatenate([(p - q / 2) @ (MINIMAL.T / 2) for p, q in zip(parts, points, strict=True)], axis=1)
        best = np.argpartition(-gains, probes - 1, axis=1)[:, :probes] if probes else np.empty((n, 0), int)
        for k in range(probes):
            moved = home.copy()
            block, which = np.divmod(best[:, k], len(MINIMAL))
            for b in range(blocks):
                rows = np.flatnonzero(block == b)
                moved[rows, 8 * b : 8 * b + 8] += MINIMAL[which[rows]]
            out[:, t, 1 + k] = _mix(moved, t)
    return out


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that suffice to connect what all links connect."""
    parent = list(range(n))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for i, j in zip(left.tolist(), right.tolist(), strict=True):
        a, b = top(i), top(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept


def _meetings(group: np.ndarray, stands: np.ndarray, asks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (home, asker) that meet in a group, ``PAIRS_AT_ONCE`` or a few more at a time. Rows are sorted by group."""
    home, other = np.flatnonzero(stands), np.flatnonzero(asks)
    first = np.searchsorted(group[home], group[other], "left")
    count = np.searchsorted(group[home], group[other], "right") - first
    ends = np.cumsum(count)
    start = 0
    while start < len(other):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")))
        n = count[start:stop]
        asker = np.repeat(other[start:stop], n)
        within = np.arange(len(asker)) - np.repeat(np.cumsum(n) - n, n)
        yield home[np.repeat(first[start:stop], n) + within], asker
        start = stop


def _links(group, table, ids, units, stands, asks, sizes, min_cosine: float, naming) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, weight of links per row) of the rows of whole groups, sorted by ``group``.

    A group is a cell of one table, or two of its chunks. ``stands``: rows that stand in the cell (its
    home rows of the first chunk); ``asks``: rows that look for them, as +1 (from their own home, second
    chunk) or -1 (from a neighbouring cell).
    """
    weight, left, right = np.zeros(len(ids), dtype=np.int64), [], []
    coarse = units.astype(np.float32)
    for i, j in _meetings(group, stands, asks):
        # two home rows meet once, in the order of their ids
        ok = (ids[i] != ids[j]) & ((asks[j] < 0) | (ids[i] < ids[j]))
        i, j = i[ok], j[ok]
        ok = np.einsum("ij,ij->i", coarse[i], coarse[j]) >= min_cosine - 1e-4
        i, j = i[ok], j[ok]
        ok = np.einsum("ij,ij->i", units[i], units[j]) >= min_cosine
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        rows, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        names, here = naming(units[rows]), table[i]
        p, q = at[: len(i)], at[len(i) :]
        p_asks = (names[p] == names[q][:, :, :1]).any(axis=2)
        q_asks = (names[q] == names[p][:, :, :1]).any(axis=2)
        either, pair = p_asks | q_asks, np.arange(len(p))
        new = either.argmax(axis=1) == here  # counted in the first table where the two meet
        # both ask in the other's cell: counted where the smaller id stands
        both = p_asks[pair, here] & q_asks[pair, here] & (names[p, here, 0] != names[q, here, 0])
        new &= ~both | (ids[i] < ids[j])
        i, j = i[new], j[new]
        np.add.at(weight, i, sizes[j])
        np.add.at(weight, j, sizes[i])
        left.append(i)
        right.append(j)
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(left) if left else none), (np.concatenate(right) if right else none), weight


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", min_cosine: float = MIN_COSINE,
    tables: int | None = None, blocks: int | None = None, scale: float | None = None, probes: int | None = None, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors link if their labels are equal and not null and their cosine, in double precision, is
    ``min_cosine`` or more. Vectors that are null, zero or hold null or non-finite components link
    with nothing; so do rows with a null id (their component is null and they are not kept). Vectors
    meet only vectors of their own length. Tables, blocks, scale and probes that are not given come from
    ``SETTING``. Rows that repeat an id, label and vector are copies like
    any others. Other columns are ignored; an empty table gives none.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.col(label_col).cast("string").alias("label")
    )
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & usable_vector(F.col("v"))
    classes = cut(rows.where(usable).groupBy("label", "v").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    # a copy may repeat an id, so classes have numbers of their own
    classes = cut(classes.withColumn("cls", F.monotonically_increasing_id()))
    tables, blocks, scale, probes = (h if given is None else given for given, h in zip((tables, blocks, scale, probes), SETTING, strict=True))

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch.v.map(len)):
                units = np.stack(part.v.to_numpy()).astype(np.float64)
                units /= np.linalg.norm(units, axis=1, keepdims=True)
                names = cells(units, tables, blocks, scale, probes)
                yield pd.DataFrame({"cls": part.cls, "label": part.label, "dim": dim, "names": list(names.reshape(len(part), -1))})

    named = classes.select("cls", "label", "v").mapInPandas(name, "cls long, label string, dim int, names array<long>")
    named = cut(named)
    table = F.floor(F.col("k") / (1 + probes)).cast("int")
    slim = named.select("cls", "label", "dim", F.posexplode("names").alias("k", "cell")).select(
        "cls", "dim", table.alias("table"), (F.col("k") % (1 + probes) == 0).alias("home"), F.xxhash64("label", "dim", table, "cell").alias("cell")
    )
    cell = ["dim", "table", "cell"]
    # cells with nobody at home, or one row at all, have nothing to verify
    sizes = slim.groupBy(*cell).agg(F.count("*").alias("all"), F.count_if("home").alias("homes")).where("homes > 0 and all > 1")
    sizes = sizes.withColumn("g", F.ceil(F.col("all") / chunk_rows).cast("int")).drop("all", "homes")
    chunk = F.pmod(F.xxhash64("cls"), F.col("g")).cast("int")
    every = F.sequence(F.lit(0), F.col("g") - 1)
    as_home = F.transform(every, lambda j: F.struct(F.col("c").alias("i"), j.alias("j"), F.lit(1).alias("stands"), F.when(j == F.col("c"), 1).otherwise(0).alias("asks")))
    as_other = F.transform(
        F.filter(every, lambda i: ~F.col("home") | (i != F.col("c"))),
        lambda i: F.struct(i.alias("i"), F.col("c").alias("j"), F.lit(0).alias("stands"), F.when(F.col("home"), 1).otherwise(-1).alias("asks")),
    )
    dealt = (
        slim.join(sizes, cell).withColumn("c", chunk)
        .withColumn("x", F.explode(F.when(F.col("home"), F.concat(as_home, as_other)).otherwise(as_other)))
        .select(*cell, "cls", "x.*")
    )
    group = F.xxhash64("cell", "i", "j").alias("group")
    full = dealt.select("cls", "dim", "table", group, "stands", "asks").join(classes.select("cls", "v", "n"), "cls")

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        units = np.stack(pdf.v.to_numpy()).astype(np.float64)
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        ids, group = pdf.cls.to_numpy(), pdf.group.to_numpy()
        naming = lambda u: cells(u, tables, blocks, scale, probes)
        p, q, weight = _links(group, pdf.table.to_numpy(), ids, units, pdf.stands.to_numpy() > 0, pdf.asks.to_numpy(), pdf.n.to_numpy(), min_cosine, naming)
        linked = np.flatnonzero(weight)
        tree = _forest(len(ids), p, q)
        return pd.DataFrame(
            {
                "u": np.concatenate([ids[linked], ids[[i for i, _ in tree]]]).astype(np.int64),
                "v": np.concatenate([ids[linked], ids[[j for _, j in tree]]]).astype(np.int64),
                "links": np.concatenate([weight[linked], np.zeros(len(tree), dtype=np.int64)]),
            }
        )

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # groups arrive one after the other; the last one of a batch may go on in the next
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = (batch.dim == batch.dim.iat[-1]) & (batch.group == batch.group.iat[-1])
            rest = batch[last]
            for _, part in batch[~last].groupby("dim", sort=False):
                yield links(part)
        if rest is not None and len(rest):
            yield links(rest)

    placed = full.repartition("group").sortWithinPartitions("dim", "group")
    found = cut(placed.mapInPandas(verify, "u long, v long, links long"))
    counts = found.where("links > 0").groupBy("u").agg(F.sum("links").alias("links")).withColumnRenamed("u", "cls")
    roots = components(found.select("u", "v")).withColumnRenamed("node", "cls")
    of_class = (
        classes.join(counts, "cls", "left").join(roots, "cls", "left")
        .select("label", "v", "rep", F.coalesce("root", "cls").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    )
    least = of_class.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_class = of_class.join(least, "root").select(F.col("label").alias("c_label"), F.col("v").alias("c_v"), "n_links", "component_id")
    out = rows.join(
        of_class, (rows["label"] == of_class["c_label"]) & (rows["v"] == of_class["c_v"]) & rows["id"].isNotNull(), "left"
    )
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
    )


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
