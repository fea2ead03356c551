"""Near copies among embeddings: inverted lists, product codes of residuals, table look-up distances, exact cosines.

Vectors are scaled to length one, so a cosine of ``c`` is a distance of ``sqrt(2 - 2 c)``. Each stands in the list of its
nearest coarse centroid and is wanted in every list whose border it is near to. In a list a wanted vector meets product codes of the
residuals: tables of its distances to the codewords of each subspace give its distance to each decoded member, and that
less the member's own coding error bounds the true distance from below. So the codes lose no pair; what passes is
measured in double precision.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sportmart.llm.common import NO_ID, importable, staged
from sportmart.llm.components import components

THRESHOLD = 0.95
#: Distinct vectors that the index is fitted on, drawn by digest; all vectors are indexed.
SAMPLE = 16_384
#: Vectors per list aimed at, most lists, subspaces and codewords of each.
PER_LIST, MAX_LISTS = 64, 1024
SUBSPACES, CODEWORDS = 16, 64
ROUNDS = 8
#: A vector is wanted in a list if it is nearer than this to the border between that list's cell and its own: so many times the
#: spread, in one direction, of a displacement as long as the threshold allows that points anywhere. ``math.inf`` asks every
#: list that a displacement of that length can reach, which loses nothing.
SPREAD = 1.5
#: Members of a list in one block, vectors wanted there in one block, and those that meet the members at a time.
BLOCK = 2048
WANTED_BLOCK = 8192
WANTED = 64
#: Room for rounding in distances.
ROUNDING = 1e-6


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; the largest component first becomes one, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def usable(vectors: pa.ListArray) -> np.ndarray:
    """Whether a vector is there, not empty, without null or non-finite components, and not zero."""
    n = len(vectors)
    flat = vectors.flatten()
    sizes = np.nan_to_num(vectors.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(n), sizes)
    bad = np.bincount(owner, weights=~np.isfinite(values), minlength=n) > 0
    some = np.bincount(owner, weights=values != 0, minlength=n) > 0
    return ~bad & some


def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, vector as bytes of doubles and its digest; both null for a vector that links with nothing."""
    for batch in batches:
        vectors = batch.column(1)
        digests, raws = [], []
        for good, vector in zip(usable(vectors), vectors):
            raw = np.asarray(vector.values.cast(pa.float64())).astype("<f8") + 0.0 if good else None
            raws.append(None if raw is None else raw.tobytes())
            digests.append(None if raw is None else hashlib.blake2b(raws[-1], digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), pa.array(raws, pa.binary())], ["id", "digest", "raw"]
        )


def matrix(raws) -> np.ndarray:
    return unit(np.frombuffer(b"".join(raws), "<f8").reshape(len(raws), -1))


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points @ centres.T - 0.5 * np.einsum("ij,ij->i", centres, centres)).argmax(axis=1)


def fitted(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of ``points`` by Lloyd's rounds, begun at evenly spaced points. Equal points give equal centres, which does no harm."""
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(points, centres)
        sizes = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


@dataclass
class Index:
    """What all tasks know: at most ``MAX_LISTS`` + ``CODEWORDS`` centres, and in how many blocks each list's members and the vectors
    wanted there are dealt out."""

    centres: np.ndarray
    books: list[np.ndarray]
    reach: float
    slack: float
    blocks: np.ndarray | None = None
    rows: np.ndarray | None = None

    def parts(self, points: np.ndarray) -> list[np.ndarray]:
        return np.array_split(points, len(self.books), axis=1)

    def lists(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own list of each vector, and whether it is wanted in each list."""
        squares = np.einsum("ij,ij->i", self.centres, self.centres) - 2 * points @ self.centres.T
        own = squares.argmin(axis=1)
        apart = np.sqrt(np.maximum(self.apart()[own], 1e-30))
        border = (squares - squares[np.arange(len(points)), own][:, None]) / (2 * apart)
        wanted = border <= min(self.slack, self.reach)
        wanted[np.arange(len(points)), own] = True
        return own, wanted

    def apart(self) -> np.ndarray:
        if not hasattr(self, "_apart"):
            norms = np.einsum("ij,ij->i", self.centres, self.centres)
            self._apart = norms[:, None] + norms[None] - 2 * self.centres @ self.centres.T
        return self._apart

    def coded(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and how far each decoded residual is from the true one."""
        codes, error = [], np.zeros(len(residuals))
        for part, book in zip(self.parts(residuals), self.books):
            codes.append(nearest(part, book))
            error += np.square(part - book[codes[-1]]).sum(axis=1)
        return np.stack(codes, axis=1), np.sqrt(error)

    def tables(self, residuals: np.ndarray) -> list[np.ndarray]:
        """For each subspace the squared distances of wanted residuals to its codewords."""
        return [
            np.square(part).sum(axis=1)[:, None] - 2 * part @ book.T + np.square(book).sum(axis=1)
            for part, book in zip(self.parts(residuals), self.books)
        ]


def fit(sample: np.ndarray, total: int, threshold: float, spread: float, block: int) -> Index:
    """The index from a sample of unit vectors; lists and blocks from the number of all vectors."""
    k = int(np.clip(total // PER_LIST, 1, min(MAX_LISTS, max(1, len(sample) // 8))))
    centres = fitted(sample, k)
    own = nearest(sample, centres)
    residuals = sample - centres[own]
    books = [fitted(part, CODEWORDS) for part in np.array_split(residuals, min(SUBSPACES, sample.shape[1]), axis=1)]
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + ROUNDING
    index = Index(centres, books, reach, spread * reach / math.sqrt(sample.shape[1]))
    own, wanted = index.lists(sample)
    per, many = total / len(sample), np.bincount(own, minlength=len(centres))
    index.blocks = np.maximum(1, np.ceil(many * per / block)).astype(int)
    index.rows = np.maximum(1, np.ceil(wanted.sum(axis=0) * per / (WANTED_BLOCK * block / BLOCK))).astype(int)
    return index


def listed(index: Index):
    """Each vector once as a member of a block of its own list, and once wanted in every block of every list that it is near to."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["list", "block", "row", "wanted", "node", "times", "own", "near", "raw"]

        def each(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Places and numbers from 0 on, so many for each place."""
            at = np.repeat(np.arange(len(counts)), counts)
            return at, np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                node, times, raw = part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2)
                own, wanted = index.lists(matrix(raw.to_pylist()))
                place, where = np.nonzero(wanted)
                near = [np.flatnonzero(w).astype(np.int32) for w in wanted]
                # A member lies in one block and comes to all its rows, a wanted vector in one row of every block.
                member, its_row = each(index.rows[own])
                asking, its_block = each(index.blocks[where])
                lists = np.concatenate([own[member], where[asking]])
                blocks = np.concatenate([(node % index.blocks[own])[member], its_block])
                # Another digit of the node, so that rows and blocks are not alike.
                digit = node * 0x9E3779B1 % 2**31
                rows = np.concatenate([its_row, (digit[place] % index.rows[where])[asking]])
                every = np.concatenate([member, place[asking]])
                # Only members are asked which lists want them.
                lists_of = [near[i] for i in member.tolist()] + [None] * len(asking)
                yield pa.RecordBatch.from_arrays([
                    pa.array(lists.astype(np.int32)), pa.array(blocks.astype(np.int32)), pa.array(rows.astype(np.int32)),
                    pa.array(np.arange(len(every)) >= len(member)), pa.array(node[every]), pa.array(times[every]),
                    pa.array(own[every].astype(np.int32)), pa.array(lists_of, pa.list_(pa.int32())),
                    raw.take(pa.array(every)),
                ], names)

    return of


class Block:
    """Members of one list in one block, with what wanted vectors have linked so far."""

    def __init__(self, index: Index, threshold: float, rows: list[tuple]):
        self.index, self.threshold, self.at = index, threshold, rows[0][0]
        self.node = np.array([r[4] for r in rows])
        self.times = np.array([r[5] for r in rows])
        self.vectors = matrix([r[8] for r in rows])
        codes, self.error = index.coded(self.vectors - index.centres[self.at])
        self.codes = np.ascontiguousarray(codes.T)
        # Members that are wanted in another list, by that list.
        self.wanted_in: dict[int, np.ndarray] = {}
        for i, r in enumerate(rows):
            for where in r[7]:
                self.wanted_in.setdefault(where, []).append(i)
        self.links = np.zeros(len(rows), np.int64)
        self.label = self.node.copy()

    def meet(self, rows: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Nodes, numbers of links and edges of wanted vectors. A pair that two blocks find counts in the one of the lower list."""
        vectors, node = matrix([r[8] for r in rows]), np.array([r[4] for r in rows])
        squares = np.zeros((len(rows), len(self.node)))
        for table, code in zip(self.index.tables(vectors - self.index.centres[self.at]), self.codes):
            squares += table[:, code]
        near = np.sqrt(np.maximum(squares, 0)) <= self.index.reach + self.error[None]
        some, them = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(some):
            return
        linked = vectors[some] @ self.vectors[them].T >= self.threshold
        linked &= near[np.ix_(some, them)]
        own = np.array([rows[i][6] for i in some])
        for row, home in enumerate(own):
            if home == self.at:
                linked[row] &= self.node[them] > node[some[row]]
            elif self.at > home:
                other = np.zeros(len(self.node), bool)
                other[self.wanted_in.get(int(home), [])] = True
                linked[row] &= ~other[them]
        here = linked.any(axis=1)
        if not here.any():
            return
        times = np.array([rows[i][5] for i in some])
        self.links[them] += times @ linked
        counts = linked @ self.times[them]
        linked, some, counts = linked[here], some[here], counts[here]
        yield node[some], counts, np.zeros((0, 2), np.int64)
        yield from self.connect(node[some], them, linked)

    def connect(self, node: np.ndarray, them: np.ndarray, linked: np.ndarray):
        """Edges that connect what the links connect: every node leads to the least node known to be with it."""
        before = self.label[them]
        mine, theirs = node.copy(), before.copy()
        far = np.iinfo(np.int64).max
        while True:
            new = np.minimum(mine, np.where(linked, theirs[None], far).min(axis=1))
            other = np.minimum(theirs, np.where(linked, new[:, None], far).min(axis=0))
            if (new == mine).all() and (other == theirs).all():
                break
            mine, theirs = new, other
        self.label[them] = theirs
        edges = np.concatenate([np.stack([node, mine], 1), np.stack([before, theirs], 1)])
        edges = np.unique(edges[edges[:, 0] != edges[:, 1]], axis=0)
        none = np.zeros(0, np.int64)
        yield none, none, edges

    def rest(self):
        """The members' own numbers and edges."""
        have = self.links > 0
        edges = np.stack([self.node, self.label], 1)
        yield self.node[have], self.links[have], edges[edges[:, 0] != edges[:, 1]]


def searched(index: Index, threshold: float):
    """Sorted blocks in; out, numbers of links (``a`` a node, ``n`` above 0) and edges (``a``, ``b``, ``n`` 0)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, waiting, block = None, [], [], None

        def out(found) -> Iterator[pa.RecordBatch]:
            for nodes, numbers, edges in found:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([nodes, edges[:, 0]])),
                    pa.array(np.concatenate([np.zeros(len(nodes), np.int64), edges[:, 1]])),
                    pa.array(np.concatenate([numbers, np.zeros(len(edges), np.int64)])),
                ], ["a", "b", "n"])

        def asked() -> Iterator[pa.RecordBatch]:
            nonlocal block, waiting
            if members and waiting:
                block = block or Block(index, threshold, members)
                yield from out(block.meet(waiting))
            waiting = []

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(9))):
                if row[:3] != key:
                    yield from asked()
                    if block is not None:
                        yield from out(block.rest())
                    key, members, block = row[:3], [], None
                if row[3]:
                    waiting.append(row)
                    if len(waiting) == WANTED:
                        yield from asked()
                else:
                    members.append(row)
        yield from asked()
        if block is not None:
            yield from out(block.rest())

    return of


def described_vectors(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    ids = vectors.schema[id_column].dataType.simpleString()
    rows = vectors.select(F.col(id_column), F.col(column).cast("array<double>"))
    return rows.mapInArrow(described, f"id {ids}, digest binary, raw binary")


def classes_of(rows: DataFrame) -> DataFrame:
    """Equal vectors as one row: ``node`` (a number of its own), ``digest``, ``first`` (smallest id), ``times`` and ``raw``."""
    same = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min(F.coalesce("id", F.lit(NO_ID))).alias("first"), F.count(F.lit(1)).alias("times"), F.first("raw").alias("raw")
    )
    return staged(rows.sparkSession, same.withColumn("node", F.monotonically_increasing_id()), "classes")


def links_of(classes: DataFrame, size: int, total: int, threshold: float, spread: float, block: int) -> DataFrame:
    """Found links of classes whose vectors have ``size`` bytes."""
    spark = classes.sparkSession
    classes = classes.where(F.length("raw") == size)
    drawn = classes.select("digest", "raw").orderBy(F.xxhash64("digest"), "digest").limit(SAMPLE).collect()
    index = spark.sparkContext.broadcast(fit(matrix([r["raw"] for r in drawn]), total, threshold, spread, block))
    rows = classes.select("node", "times", "raw").mapInArrow(
        lambda batches: listed(index.value)(batches),
        "list int, block int, row int, wanted boolean, node long, times long, own int, near array<int>, raw binary",
    )
    rows = rows.repartition("list", "block", "row").sortWithinPartitions("list", "block", "row", "wanted")
    return rows.mapInArrow(lambda batches: searched(index.value, threshold)(batches), "a long, b long, n long")


def near_vectors(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", threshold: float = THRESHOLD,
    spread: float = SPREAD, block: int = BLOCK,
) -> DataFrame:
    """``id``, ``n_links`` (other rows whose vectors link with this one's) and ``component`` (smallest id that links reach) for each row of ``vectors``.

    Vectors link at a cosine of ``threshold`` or more in double precision, never below it, and only with vectors of as many components.
    A vector that is null, empty, zero or has a null or non-finite component links with nothing and is its own component.
    Equal vectors are one class: its rows link with one another, and it is searched once. A null id sorts behind all others; rows
    that share an id are rows of their own. No input row, no row. Other columns are not read.

    A list with many members, or that many vectors are wanted in, is cut into blocks of both that meet one another, so no group is
    larger than two blocks; numbers are summed there and edges are a forest, so near copies of one another do not leave all their pairs.
    """
    spark = vectors.sparkSession
    importable(spark)
    rows = staged(spark, described_vectors(vectors, id_column, column), "vectors")
    classes = classes_of(rows)
    sizes = classes.groupBy(F.length("raw").alias("size")).count().collect()
    found = None
    for r in sorted(sizes):
        part = links_of(classes, r["size"], r["count"], threshold, spread, block)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "a long, b long, n long")
    found = staged(spark, found, "links")
    numbers = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    roots = components(found.where("n = 0").select("a", "b"))
    known = classes.select("node", "digest", "first", "times").join(roots, "node", "left")
    known = known.withColumn("root", F.coalesce("root", "node")).join(numbers, "node", "left")
    known = staged(spark, known, "known")
    least = known.groupBy("root").agg(F.min("first").alias("component"))
    known = known.join(least, "root").select(
        "digest", "component", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links")
    )
    named = F.when(F.col("component") != NO_ID, F.col("component"))
    return rows.select("id", "digest").join(known, "digest", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("component").isNull(), F.col("id")).otherwise(named).alias("component"),
    )


def deduplicated(vectors: DataFrame, **options) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` (whether it is its own component; null ids: the component has no other id)."""
    return near_vectors(vectors, **options).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
