"""Near-duplicate embeddings: inverted lists with product-quantised residuals, exact cosine at the end."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from cdclake.llm.components import components
from cdclake.llm.tables import column, local_roots, numpy_column, shuffle_tasks, whole_groups, written
from cdclake.llm.words import mixed

SIMILARITY = 0.93
#: The index is fitted on about this many vectors; all are indexed.
SAMPLE = 16_000
MOST_LISTS = 1024
SUBSPACES, CODES = 8, 64
#: Vectors of a list, and of the queries to it, that make up a block.
BLOCK = 1024
#: Vectors that look for lists at once, and bytes of vectors that leave a task at once.
_ROWS, _BYTES = 2048, 16 << 20
_GROUP = ["label", "dim", "list", "entry_block", "query_block"]


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1), 0)


def _means(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres of k-means; the first ones are points spread over the sample."""
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        own = _squares(points, centres).argmin(1)
        count = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


@dataclass
class Index:
    """Coarse centres, and for each part of the dimensions the codewords of residuals."""

    centres: np.ndarray
    parts: list[np.ndarray]
    books: list[np.ndarray]
    radius: float

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, similarity: float) -> Index:
        centres = _means(sample, lists)
        rest = sample - centres[_squares(sample, centres).argmin(1)]
        parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        return cls(centres, parts, [_means(rest[:, p], CODES) for p in parts], float(np.sqrt(2 - 2 * similarity)))

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest list of each vector, and which lists to probe.

        Two vectors of different lists are on either side of the plane between both centres, so their
        distances from it add up to at most their own. Within the radius one of them is at most half of
        it away: lists are probed whose plane is that near, and every pair is met from one side at least.
        """
        squares = _squares(x, self.centres)
        own = squares.argmin(1)
        apart = np.sqrt(_squares(self.centres, self.centres))[own]
        # The distance from a plane is this difference divided by twice that of the centres.
        near = squares - squares[np.arange(len(x)), own][:, None] <= self.radius * apart + 1e-7
        near[np.arange(len(x)), own] = True
        return own, near

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the distance between each vector and what its codes stand for."""
        rest = x - self.centres[own]
        codes = np.stack([_squares(rest[:, p], b).argmin(1) for p, b in zip(self.parts, self.books, strict=True)], axis=1)
        lost = sum(((rest[:, p] - b[codes[:, k]]) ** 2).sum(1) for k, (p, b) in enumerate(zip(self.parts, self.books, strict=True)))
        return codes.astype(np.uint8), np.sqrt(lost)

    def near(self, queries: np.ndarray, own: int, codes: np.ndarray, lost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, entry of a list) whose asymmetric distance lets the exact one be within the radius.

        The distance between a query and an entry's codes is summed from tables. It differs from the
        exact one by at most what the codes lost, so no pair within the radius is left out.
        """
        rest = queries - self.centres[own]
        total = np.zeros((len(queries), len(codes)))
        for k, (part, book) in enumerate(zip(self.parts, self.books, strict=True)):
            total += _squares(rest[:, part], book)[:, codes[:, k]]
        return np.nonzero(np.sqrt(total) <= self.radius + lost + 1e-9)


def _units(x: np.ndarray) -> np.ndarray:
    # Squares of very large or small components would leave the range of doubles.
    x = x.astype(np.float64)
    x /= np.maximum(x.max(axis=1, keepdims=True), -x.min(axis=1, keepdims=True))
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x


def _vectors(values: pa.Array) -> np.ndarray:
    return _units(values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1))


def _postings(indexes: dict[int, Index], kind: type):
    """For each vector one row as an entry of its list and one row per list it probes.

    Components are sent as they are, as numbers of ``kind``. Only entries say what they are in the index.
    """

    def rows(batches):
        for batch in batches:
            dims = numpy_column(batch, "dim")
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                for low in range(0, part.num_rows, _ROWS):
                    yield from postings(part.slice(low, _ROWS), indexes[int(dim)], int(dim))

    def postings(part: pa.RecordBatch, index: Index, dim: int):
        values = part.column(part.schema.get_field_index("embedding"))
        raw = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)
        x = _units(raw)
        own, near = index.probes(x)
        codes, lost = index.encode(x, own)
        who, probed = np.nonzero(near)
        at = np.concatenate([np.arange(len(x)), who])
        where = np.concatenate([own, probed]).astype(np.int32)
        entry = np.arange(len(at)) < len(x)
        told = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(lost),
                pa.array([n.tobytes() for n in np.packbits(near, axis=1)], pa.binary())]
        sent = pa.array([v.tobytes() for v in raw.astype(kind)], pa.binary())
        step = max(1, _BYTES // (dim * np.dtype(kind).itemsize))
        for low in range(0, len(at), step):
            cut = slice(low, low + step)
            taken = part.take(pa.array(at[cut]))
            entries = pa.array(at[cut], mask=~entry[cut])
            yield pa.RecordBatch.from_arrays(
                [
                    *[taken.column(taken.schema.get_field_index(c)) for c in ("label", "dim", "rep", "copies")],
                    pa.array(where[cut]), pa.array(own[at[cut]].astype(np.int32)), pa.array(entry[cut]),
                    *[t.take(entries) for t in told], sent.take(pa.array(at[cut])),
                ],
                names=["label", "dim", "rep", "copies", "list", "own", "entry", "codes", "lost", "probes", "vector"],
            )

    return rows


_POSTING = """label long, dim int, rep long, copies long, list int, own int, entry boolean, codes binary, lost double,
    probes binary, vector binary"""


def _links(indexes: dict[int, Index], similarity: float, kind: type):
    def group(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        entry = numpy_column(table, "entry").astype(bool)
        rep, copies = numpy_column(table, "rep"), numpy_column(table, "copies")
        index = indexes[int(numpy_column(table, "dim")[0])]
        here = int(numpy_column(table, "list")[0])
        e, q = np.flatnonzero(entry), np.flatnonzero(~entry)
        if not len(e) or not len(q):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        unit = _units(np.frombuffer(b"".join(table.column("vector").to_pylist()), dtype=kind).reshape(len(entry), -1))
        codes, probes = (
            np.frombuffer(b"".join(table.column(c).take(pa.array(e)).to_pylist()), dtype=np.uint8).reshape(len(e), -1)
            for c in ("codes", "probes")
        )
        a, b = index.near(unit[q], here, codes, numpy_column(table, "lost")[e])
        a, b = q[a], e[b]
        # A pair that is met from both sides counts where the smaller id asks.
        own = numpy_column(table, "own")
        back = np.zeros((len(entry), len(index.centres)), dtype=bool)
        back[e] = np.unpackbits(probes, axis=1, count=len(index.centres))
        keep = (rep[a] < rep[b]) | ((rep[a] > rep[b]) & ~back[b, own[a]])
        a, b = a[keep], b[keep]
        exact = np.concatenate(
            [np.einsum("ij,ij->i", unit[a[k : k + 65536]], unit[b[k : k + 65536]]) for k in range(0, len(a), 65536)] or [np.zeros(0)]
        )
        a, b = a[exact >= similarity], b[exact >= similarity]
        # A vector may be in a group twice, as an entry and as a query: links are summed over its id.
        ids, number = np.unique(rep, return_inverse=True)
        links = np.zeros(len(ids), dtype=np.int64)
        np.add.at(links, number[a], copies[b])
        np.add.at(links, number[b], copies[a])
        root = ids[local_roots(len(ids), number[a], number[b])]
        found = links > 0
        return ids[found], links[found], root[found]

    def rows(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        parts = [group(table.slice(x, y - x)) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([p[k] for p in parts])) for k in range(3)], names=["rep", "links", "root"]
        )

    return lambda batches: whole_groups(batches, _GROUP, rows, 4 << 20)


def _fit(classes: DataFrame, similarity: float) -> dict[int, Index]:
    """One index for each number of dimensions, on a fixed choice of about ``SAMPLE`` vectors."""
    indexes = {}
    for row in classes.groupBy("dim").agg(F.count("*").alias("n")).collect():
        dim, n = row["dim"], row["n"]
        # By the vector too, as one id may be on any number of them.
        mark = F.xxhash64("rep", "embedding", F.lit(9))
        share = F.pmod(mark, F.lit(1 << 30)) / (1 << 30)
        sample = classes.filter((F.col("dim") == dim) & (share < SAMPLE / n)).orderBy("rep", mark).select("embedding").toArrow()
        if not sample.num_rows:
            sample = classes.filter(F.col("dim") == dim).orderBy("rep").limit(1).select("embedding").toArrow()
        x = _vectors(sample.column("embedding").combine_chunks())
        x = x[np.argsort(mixed(np.arange(len(x)).astype(np.uint64)))]
        indexes[dim] = Index.fit(x, int(min(max(1, np.sqrt(n)), MOST_LISTS, max(1, len(x) // 8))), similarity)
    return indexes


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per vector: ``n_links``, ``component_id`` and ``kept``.

    Two vectors are linked if their labels are equal and not null and their cosine, in double precision,
    is at least ``similarity``. ``n_links`` counts other vectors linked directly, ``component_id`` is the
    smallest id reachable by links, itself included, ``kept`` says that it is the vector's own.

    Equal vectors of a label are one class and are indexed once. The index is fitted on a bounded sample
    and holds every class: each is an entry of its nearest list and asks the lists that may hold its
    neighbours. Candidates pass a table-lookup distance, then the exact cosine. Lists, and the queries to
    them, are cut into blocks, so no list is ever in one task as a whole; only sums of links and a
    spanning forest leave a task. Lists are probed by a bound that holds for any vectors, so all links are
    found, however many lists that takes.

    Vectors that are null, empty, zero or hold null or non-finite components, and vectors of different
    dimensions, link with nothing. Rows without an id are not compared (null component, kept); rows that
    share an id are one vector: links are added up.
    """
    e = F.col("embedding")
    rows = vectors.select(
        column(vec_id).cast("long").alias("vec_id"), column(label).cast("long").alias("label"), column(embedding).alias("embedding")
    )
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists(e, lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    keys = [F.when(usable, F.xxhash64("label", "embedding")), F.when(usable, F.hash("label", "embedding"))]
    rows = rows.withColumn("h1", keys[0]).withColumn("h2", keys[1])
    classes = rows.filter("h1 IS NOT NULL").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("embedding").alias("embedding"),
    )
    classes = written(classes.withColumn("dim", F.size("embedding")), "vectors")
    indexes = _fit(classes, similarity)
    kind = np.float32 if isinstance(classes.schema["embedding"].dataType.elementType, FloatType) else np.float64

    postings = written(
        classes.select("label", "dim", "rep", "copies", "embedding").mapInArrow(_postings(indexes, kind), _POSTING), "postings"
    )
    lists = ["label", "dim", "list"]
    sizes = postings.groupBy(*lists).agg(
        F.count(F.when(F.col("entry"), 1)).alias("entries"), F.count(F.when(~F.col("entry"), 1)).alias("queries")
    )
    blocks = {k: F.greatest(F.ceil(F.col(k) / BLOCK), F.lit(1)).cast("int") for k in ("entries", "queries")}
    own = F.xxhash64("rep", F.lit(11))
    everywhere = {k: F.sequence(F.lit(0), n - 1) for k, n in blocks.items()}
    spread = (
        postings.join(sizes.filter("entries > 0"), lists)
        .withColumn("entry_block", F.explode(
            F.when(F.col("entry"), F.array(F.pmod(own, blocks["entries"]).cast("int"))).otherwise(everywhere["entries"])))
        .withColumn("query_block", F.explode(
            F.when(F.col("entry"), everywhere["queries"]).otherwise(F.array(F.pmod(own, blocks["queries"]).cast("int")))))
        .drop("entries", "queries")
        .repartition(shuffle_tasks(rows.sparkSession), *_GROUP).sortWithinPartitions(*_GROUP)
    )
    found = written(spread.mapInArrow(_links(indexes, similarity, kind), "rep long, links long, root long"), "vector_links")

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found, "rep", "root").withColumnRenamed("node", "rep")
    joined = classes.select("h1", "h2", "rep", "copies").join(links, "rep", "left").join(groups, "rep", "left")
    component = F.coalesce("component", "rep", "vec_id")
    return rows.select("vec_id", "h1", "h2").join(joined, ["h1", "h2"], "left").select(
        "vec_id", (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
