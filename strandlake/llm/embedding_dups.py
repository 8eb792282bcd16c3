"""Embedding near-duplicates: inverted lists, product-quantised residuals, table-lookup distances, exact cosine rerank.

Equal vectors are first folded into one class with its number of copies, whatever their ids. Coarse centroids and the codebooks
of the residuals are fitted on a bounded sample; every class is indexed under its nearest centroid and asked
for under the centroids near it. A list is split into blocks of bounded size, so no task holds a whole hot
list. Inside a block the asymmetric distance to a code, less the stored error of that code, can only be too
small, so the filter drops no pair of a probed list; what stays is compared exactly in double precision.

A pair is counted in one block only: where both directions would find it, the one with the smaller asking class
counts. Blocks give sums of links and a spanning forest, never all pairs.

Defined cases: vectors that are null, empty or zero, or hold a null or non-finite component, link with nothing and are kept;
shorter vectors count as padded with zeros, so one that equals another but for zeros at its end is a class of its own with a cosine of 1; very long
vectors are taken whole; rows of one id are vectors of their own, which link by what they hold; rows without an id link
like others, and a component of such rows alone has no id; a cosine of exactly the threshold links; extra columns and labels are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.forest import forest
from strandlake.operators.graph import connected_components
from strandlake.runtime import cut, giving_back, joined

#: Rows fitted on (expected, picked by hash), most inverted lists, subspaces, codes of each, lists asked at most, rows of a block.
FIT_ROWS, MOST_LISTS, SUBSPACES, CODES, PROBES, BLOCK = 20_000, 4096, 8, 256, 8, 1500


@dataclass
class Index:
    centroids: np.ndarray
    books: list[np.ndarray]
    cuts: list[slice]

    def nearest(self, x: np.ndarray, reach: float, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest lists of each row and which of them lie within ``reach`` of the nearest."""
        d = np.maximum(0, 1 + (self.centroids**2).sum(1) - 2 * x @ self.centroids.T)
        most = min(most, d.shape[1])
        order = np.argpartition(d, most - 1, axis=1)[:, :most]
        near = np.take_along_axis(d, order, 1)
        rank = np.argsort(near, axis=1, kind="stable")
        order, near = np.take_along_axis(order, rank, 1), np.sqrt(np.take_along_axis(near, rank, 1))
        return order, near <= near[:, :1] + reach

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the length of what the codes leave out."""
        r = x - self.centroids[lists]
        codes, left = np.empty((len(x), len(self.books)), np.uint8), np.zeros(len(x))
        for m, (book, cut_) in enumerate(zip(self.books, self.cuts, strict=True)):
            part = r[:, cut_]
            d = (part**2).sum(1)[:, None] + (book**2).sum(1) - 2 * part @ book.T
            codes[:, m] = d.argmin(1)
            left += ((part - book[codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(left)

    def distances(self, q: np.ndarray, list_id: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances (squared) of every query to every code of one list, by table lookup."""
        r = q - self.centroids[list_id]
        out = np.zeros((len(q), len(codes)))
        for m, (book, cut_) in enumerate(zip(self.books, self.cuts, strict=True)):
            part = r[:, cut_]
            table = (part**2).sum(1)[:, None] + (book**2).sum(1) - 2 * part @ book.T
            out += table[:, codes[:, m]]
        return out


def _kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    c = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        d = (c**2).sum(1) - 2 * x @ c.T
        own = d.argmin(1)
        n = np.bincount(own, minlength=len(c))
        for j in range(x.shape[1]):
            c[:, j] = np.where(n > 0, np.bincount(own, x[:, j], len(c)) / np.maximum(n, 1), c[:, j])
    return c


def fit(x: np.ndarray, rows: int, reach: float) -> Index:
    """An index for ``rows`` unit vectors from a sample of them; no two centroids are within ``reach``, so a dense group is not cut up."""
    lists = max(1, min(MOST_LISTS, len(x) // 8, int(4 * rows**0.5)))
    centroids = _kmeans(x, lists, 1)
    own = ((centroids**2).sum(1) - 2 * x @ centroids.T).argmin(1)
    order = np.argsort(-np.bincount(own, minlength=len(centroids)), kind="stable")
    d = (centroids**2).sum(1)[:, None] + (centroids**2).sum(1) - 2 * centroids @ centroids.T
    free, kept = np.ones(len(centroids), bool), []
    for c in order:
        if free[c]:
            kept.append(c)
            free &= d[c] > reach**2
    centroids = centroids[kept]
    own = ((centroids**2).sum(1) - 2 * x @ centroids.T).argmin(1)
    residuals = x - centroids[own]
    edges = np.linspace(0, x.shape[1], min(SUBSPACES, x.shape[1]) + 1).astype(int)
    cuts = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return Index(centroids, [_kmeans(residuals[:, c], min(CODES, 256), 2) for c in cuts], cuts)


def _unit(column: pa.Array, width: int) -> np.ndarray:
    """Rows as unit vectors in double precision, padded to one width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    x = np.zeros((n, width))
    x[np.repeat(np.arange(n), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    x /= np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, probes: int = PROBES, fit_rows: int = FIT_ROWS, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row ``(vec_id, embedding)``; links are pairs found with cosine >= ``threshold``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    e = F.col("embedding")
    fine = e.isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    key = [F.when(fine, F.xxhash64("embedding")).alias("h1"), F.when(fine, F.xxhash64(F.lit(7), "embedding")).alias("h2")]
    keyed = rows.select("vec_id", *key)
    folded = rows.select("vec_id", "embedding", *key).where("h1 is not null").groupBy("h1", "h2")
    classes = folded.agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    classes = cut(classes.select(F.monotonically_increasing_id().alias("id"), "h1", "h2", "rep", "copies", "embedding"))  # written once, so an id stays
    n = classes.count()
    alone = keyed.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not n:
        return alone
    reps = classes.select("id", "copies", "embedding")
    width = reps.agg(F.max(F.size("embedding"))).first()[0]
    sample = classes.where(F.pmod("h1", F.lit(1_000_000)) < min(1.0, fit_rows / n) * 1_000_000).select("embedding").toArrow()
    if not len(sample):
        sample = reps.select("embedding").limit(1).toArrow()
    reach = (2 - 2 * threshold) ** 0.5
    shared = spark.sparkContext.broadcast(fit(_unit(sample.column("embedding"), width), n, reach))
    wide = "id bigint, copies bigint, list int, role int, home int, homes array<int>, vec binary, code binary, err double"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                x = _unit(part.column("embedding"), width)
                near, inside = idx.nearest(x, reach, probes)
                home = near[:, 0]
                codes, err = idx.encode(x, home)
                ids, copies = part.column("id").to_numpy(), part.column("copies").to_numpy()
                asked = [near[i, inside[i]].astype(np.int32) for i in range(len(x))]
                who = np.concatenate((np.arange(len(x)), np.repeat(np.arange(len(x)), [len(a) for a in asked])))
                role = np.concatenate((np.zeros(len(x), np.int32), np.ones(len(who) - len(x), np.int32)))
                lists = np.concatenate((home, *asked)).astype(np.int32)
                raw, packed = [r.tobytes() for r in x], [c.tobytes() for c in codes]
                cols = [ids[who], copies[who], lists, role, home[who].astype(np.int32)]
                arrays = [pa.array(c) for c in cols] + [
                    pa.array([asked[i] for i in who], pa.list_(pa.int32())),
                    pa.array([raw[i] for i in who], pa.binary()),
                    pa.array([packed[i] if not r else b"" for i, r in zip(who, role, strict=True)], pa.binary()),
                    pa.array(err[who]),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "copies", "list", "role", "home", "homes", "vec", "code", "err"])

    entries = cut(reps.mapInArrow(giving_back(assign), wide))
    sizes = entries.groupBy("list").agg(F.count_if(F.col("role") == 0).alias("n0"), F.count_if(F.col("role") == 1).alias("n1"))
    sizes = sizes.select("list", *[F.greatest(F.lit(1), F.ceil(F.col(f"n{r}") / block)).cast("int").alias(f"b{r}") for r in (0, 1)])
    spread = entries.join(F.broadcast(sizes), "list")  # one row for each of at most MOST_LISTS lists
    own = F.pmod(F.xxhash64("id"), F.when(F.col("role") == 0, F.col("b0")).otherwise(F.col("b1"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("role") == 0, F.col("b1")).otherwise(F.col("b0")) - 1))
    spread = spread.select("*", own.alias("own"), other.alias("other"))
    cell = F.when(F.col("role") == 0, F.struct(F.col("own").alias("i"), F.col("other").alias("q"))).otherwise(F.struct(F.col("other").alias("i"), F.col("own").alias("q")))
    spread = spread.select("id", "copies", "list", "role", "home", "homes", "vec", "code", "err", cell.alias("cell")).select("*", F.col("cell.i").alias("i"), F.col("cell.q").alias("q")).drop("cell")

    def compare(t: pa.Table) -> pa.Table:
        idx = shared.value
        role = t.column("role").to_numpy()
        y, q = t.filter(pa.array(role == 0)), t.filter(pa.array(role == 1))
        a = b = np.zeros(0, np.int64)
        if len(y) and len(q):
            vec = lambda s: np.frombuffer(b"".join(s.column("vec").to_pylist())).reshape(len(s), -1)
            yv, qv = vec(y), vec(q)
            codes = np.frombuffer(b"".join(y.column("code").to_pylist()), np.uint8).reshape(len(y), -1)
            limit = (reach + y.column("err").to_numpy() + 1e-9) ** 2
            list_id = int(t.column("list")[0].as_py())
            yi, qi, q_home = y.column("id").to_numpy(), q.column("id").to_numpy(), q.column("home").to_numpy()
            y_homes = [set(h) for h in y.column("homes").to_pylist()]
            found = []
            for lo in range(0, len(q), 256):
                close = idx.distances(qv[lo : lo + 256], list_id, codes) <= limit
                u, v = np.nonzero(close)
                u = u + lo
                keep = np.einsum("ij,ij->i", qv[u], yv[v]) >= threshold
                u, v = u[keep], v[keep]
                one = (qi[u] != yi[v]) & ((qi[u] < yi[v]) | np.array([q_home[s] not in y_homes[w] for s, w in zip(u, v, strict=True)], bool))
                found.append((u[one], v[one]))
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(a):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        count_q = np.bincount(a, y.column("copies").to_numpy()[b], len(q)).astype(np.int64)
        count_y = np.bincount(b, q.column("copies").to_numpy()[a], len(y)).astype(np.int64)
        far, near = forest(qi[a], yi[b])
        zero = np.zeros(len(far), np.int64)
        ids = np.concatenate((qi[count_q > 0], yi[count_y > 0]))
        sums = np.concatenate((count_q[count_q > 0], count_y[count_y > 0]))
        none = pa.nulls(len(ids), pa.int64())
        return pa.table({"a": pa.concat_arrays([pa.array(ids), pa.array(far)]), "b": pa.concat_arrays([none, pa.array(near)]), "links": pa.array(np.concatenate((sums, zero)))})

    found = cut(spread.groupBy("list", "i", "q").applyInArrow(compare, "a bigint, b bigint, links bigint"))
    links = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("b is not null"))
    per = classes.select("id", "h1", "h2", "rep", "copies").join(links, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
    per = cut(per.select("h1", "h2", "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("component")))
    first = per.groupBy("component").agg(F.min("rep").alias("first"))
    per = joined(per, first, "component").select("h1", "h2", "links", "first")
    out = joined(keyed, per, ["h1", "h2"], "left")
    component = F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("first"))
    kept = F.coalesce(F.col("vec_id") == component, F.col("h1").isNull())
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), kept.alias("kept"))
