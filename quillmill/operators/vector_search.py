"""Similarity search: exact for one or many queries, and approximate over cells."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmill import schemas
from quillmill.functions import text as tx
from quillmill.functions import vectors as vec
from quillmill.session import written

# Defaults of the search
SIMILARITY_THRESHOLD = 0.7
SEARCH_LIMIT = 10
IVF_CELLS = 100

# Vectors of one block, and results that a task holds before it sends them on
QUERY_BLOCK, VECTOR_BLOCK, HELD_RESULTS = 1024, 2048, 2_000_000


def find_similar_papers(
    embeddings: DataFrame,
    papers: DataFrame,
    query: Sequence[float],
    similarity_threshold: float = SIMILARITY_THRESHOLD,
    limit_count: int = SEARCH_LIMIT,
    embedding_type: str | None = None,
    best_per_paper: bool = False,
) -> DataFrame:
    """``(paper_id, title, similarity)`` of the most similar stored vectors above the threshold.

    A paper comes once for each of its embedding types that passes, unless ``embedding_type`` or
    ``best_per_paper`` says otherwise. Only rows above the threshold reach the join.
    """
    if embedding_type is not None:
        embeddings = embeddings.filter(F.col("embedding_type") == embedding_type)
    similar = embeddings.select("paper_id", vec.similarity_to(query)("embedding").alias("similarity"))
    similar = similar.filter(F.col("similarity") > similarity_threshold)
    if best_per_paper:
        similar = similar.groupBy("paper_id").agg(F.max("similarity").alias("similarity"))
    titles = papers.select(F.col("id").alias("paper_id"), "title")
    ranked = similar.join(titles, "paper_id").orderBy(F.desc("similarity"), "paper_id").limit(limit_count)
    return ranked.select("paper_id", "title", "similarity")


def nearest_chunks(chunks: DataFrame, query: Sequence[float], limit: int = SEARCH_LIMIT) -> DataFrame:
    """Chunks by cosine distance, nearest first, those without a distance last; no threshold."""
    distance = F.round(F.lit(1.0) - vec.similarity_to(query)("embedding"), vec.SIMILARITY_DIGITS)
    return chunks.withColumn("distance", distance).orderBy(F.asc_nulls_last("distance"), "chunk_id").limit(limit)


def search_many(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = SEARCH_LIMIT,
    similarity_threshold: float | None = None,
    vector_id: str = "paper_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """``(query_id, <vector_id>, similarity, rank)``: the exact ``k`` nearest vectors of every query.

    ``queries`` has ``query_id`` and ``embedding``; ids may be of any type that can be ordered. Queries and vectors become
    blocks, a row each; every block of queries meets every block of vectors of its dimension, one matrix product a pair, and a task
    sends on its ``k`` best per query. The vectors are read once and sent nowhere while Spark can broadcast the query blocks; when they
    are too many for that, blocks of both sides are dealt out, large ones split. Vectors without a direction match nothing.
    """
    id_type, query_type = dict(vectors.dtypes)[vector_id], dict(queries.dtypes)["query_id"]
    asked = _in_blocks(queries.select(F.col("query_id").alias("id"), F.col("embedding").alias("vector")), query_type, query_block)
    asked = written(asked.withColumn("q_block", F.monotonically_increasing_id()), "query-blocks")
    numbers = [r["q_block"] for r in asked.select("q_block").collect()]  # one for each block of queries
    held = _in_blocks(vectors.select(F.col(vector_id).alias("id"), F.col(vector).alias("vector")), id_type, vector_block)
    held = held.withColumn("q_block", F.explode(F.array(*[F.lit(n) for n in numbers]).cast("array<bigint>")))
    sides = asked.select("q_block", "dim", F.col("ids").alias("query_ids"), F.col("matrix").alias("targets"))
    met = held.join(sides, ["q_block", "dim"])
    floor = -np.inf if similarity_threshold is None else similarity_threshold
    schema = f"query_id {query_type}, {vector_id} {id_type}, similarity double"
    found = met.mapInArrow(_best_of_blocks(k, floor, vec.SIMILARITY_DIGITS, schema), schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), vector_id)
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _in_blocks(rows: DataFrame, id_type: str, size: int) -> DataFrame:
    """``(dim, ids, matrix)``: vectors at length one packed into blocks of at most ``size``, by dimension."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = np.asarray(lists.value_lengths().fill_null(-1))
            for dim in np.unique(sizes[sizes > 0]):
                chosen = pa.array(sizes == dim)
                ids, flat = batch.column(0).filter(chosen), lists.filter(chosen).flatten()
                matrix = flat.cast("float64").to_numpy(zero_copy_only=False).reshape(len(ids), dim)
                lengths = np.linalg.norm(matrix, axis=1)
                usable = np.flatnonzero(np.isfinite(lengths) & (lengths > 0))
                for start in range(0, len(usable), size):
                    part = usable[start : start + size]
                    body = np.ascontiguousarray(matrix[part] / lengths[part, None])
                    listed = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), ids.take(pa.array(part)))
                    yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), listed, pa.array([body.tobytes()], pa.binary())], names=["dim", "ids", "matrix"])

    return rows.mapInArrow(pack, f"dim int, ids array<{id_type}>, matrix binary")


def _best_of_blocks(k: int, floor: float, digits: int, schema: str):
    """The ``k`` best vectors of every query among the block pairs of a task, above ``floor``; equal ones by id."""

    def keep(q, scores, ids):
        # ids of any type: their places in order stand for them
        _, place = np.unique(ids, return_inverse=True)
        order = np.lexsort((place, -scores, q))
        first = np.searchsorted(q[order], q[order], "left")
        kept = order[np.arange(len(q)) - first < k]
        return q[kept], scores[kept], ids[kept]

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        names: dict[int, pa.Array] = {}
        worst: dict[int, np.ndarray] = {}

        def told():
            for block, (q, scores, ids) in best.items():
                columns = [names[block].take(pa.array(q)), pa.array(ids.tolist(), arrow.field(1).type), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
            best.clear()
            worst.clear()

        for batch in batches:
            for row in range(batch.num_rows):
                block, dim = batch.column("q_block")[row].as_py(), batch.column("dim")[row].as_py()
                if block not in names:
                    names[block] = batch.column("query_ids")[row].values
                ids = batch.column("ids")[row].values.to_numpy(zero_copy_only=False)
                targets, held = (np.frombuffer(batch.column(c)[row].as_buffer(), dtype="float64").reshape(-1, dim) for c in ("targets", "matrix"))
                scores = np.round(targets @ held.T, digits)
                least = worst.setdefault(block, np.full(len(targets), -np.inf))
                q, r = np.nonzero((scores > floor) & (scores >= least[:, None]))
                fresh = (q, scores[q, r], ids[r])
                best[block] = keep(*(fresh if block not in best else tuple(map(np.concatenate, zip(best[block], fresh)))))
                numbers, counts = np.unique(best[block][0], return_counts=True)
                last = np.cumsum(counts) - 1
                least[numbers[counts == k]] = best[block][1][last[counts == k]]
                if sum(len(b[0]) for b in best.values()) > HELD_RESULTS:
                    yield from told()
        yield from told()

    return search


def wrong_dimension(df: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there but has not ``dim`` numbers, with ``dims`` found."""
    return df.filter(F.col(vector).isNotNull() & (F.size(vector) != dim)).withColumn("dims", F.size(vector))


# -- approximate search ---------------------------------------------------------------------------


def train_cells(vectors: DataFrame, cells: int = IVF_CELLS, vector: str = "embedding", seed: int = 42) -> KMeansModel:
    """K-means over unit vectors; all-zero and NULL vectors take no part."""
    points = vectors.select(vec.unit(F.col(vector)).alias("_unit")).filter(F.col("_unit").isNotNull())
    points = points.select(array_to_vector(F.col("_unit").cast("array<double>")).alias("point"))
    return KMeans(k=cells, seed=seed, maxIter=10, featuresCol="point", predictionCol="cell").fit(points)


def assign_cells(vectors: DataFrame, model: KMeansModel, vector: str = "embedding") -> DataFrame:
    """Vectors with their ``cell``; -1 for those that have no direction.

    Write the result partitioned by ``cell``: a search then reads only the cells it probes.
    """
    tagged = vectors.withColumn("_unit", vec.unit(F.col(vector)))
    usable = tagged.filter(F.col("_unit").isNotNull()).withColumn(
        "point", array_to_vector(F.col("_unit").cast("array<double>"))
    )
    placed = model.transform(usable).drop("point", "_unit")
    return placed.unionByName(tagged.filter(F.col("_unit").isNull()).drop("_unit").withColumn("cell", F.lit(-1)))


def nearest_cells(model: KMeansModel, query: Sequence[float], probes: int) -> list[int]:
    """The ``probes`` cells whose centres are nearest to the query's direction."""
    target = np.asarray(query, dtype="float64")
    target = target / np.linalg.norm(target)
    distances = [float(np.linalg.norm(np.asarray(c) - target)) for c in model.clusterCenters()]
    return [int(i) for i in np.argsort(distances, kind="stable")[:probes]]


def search_cells(
    placed: DataFrame,
    model: KMeansModel,
    query: Sequence[float],
    probes: int,
    k: int = SEARCH_LIMIT,
    vector_id: str = "paper_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(<vector_id>, similarity)``: the ``k`` best vectors of the probed cells, scored exactly."""
    near = placed.filter(F.col("cell").isin(nearest_cells(model, query, probes)))
    scored = near.select(vector_id, vec.similarity_to(query)(vector).alias("similarity"))
    return scored.filter(F.col("similarity").isNotNull()).orderBy(F.desc("similarity"), vector_id).limit(k)


def recall(found: DataFrame, exact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: which part of the exact results was found."""
    hit = found.select(*keys).distinct().withColumn("_hit", F.lit(1))
    marked = exact.select(*keys).distinct().join(hit, list(keys), "left")
    return marked.agg(F.try_divide(F.count("_hit"), F.count(F.lit(1))).alias("recall"))


# -- embeddings of sections ------------------------------------------------------------------------


def hash_embedder(dim: int = schemas.PAPER_VECTOR_DIM):
    """Deterministic embedder: hashed word counts at length one. Takes and gives a DataFrame."""

    def embed(df: DataFrame, text: str = "section_text") -> DataFrame:
        word_lists = df.withColumn("_words", F.split(F.lower(tx.collapse_whitespace(F.col(text))), " "))
        counted = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim).transform(word_lists)
        scaled = Normalizer(inputCol="_tf", outputCol="_unit", p=2.0).transform(counted)
        return scaled.withColumn("embedding", vector_to_array("_unit", "float32")).drop("_words", "_tf", "_unit")

    return embed


def model_embedder(load):
    """An embedder from a model: ``load()`` gives ``encode(texts) -> list of vectors or None``.

    Loaded once per task; a text the model fails on gets NULL and the rest goes on.
    """

    def embed(df: DataFrame, text: str = "section_text") -> DataFrame:
        @F.pandas_udf("array<float>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()

            def one(value):
                try:
                    return model([value])[0]
                except Exception:
                    return None

            for batch in batches:
                try:
                    yield pd.Series(list(model(list(batch))))
                except Exception:
                    yield batch.map(one)

        return df.withColumn("embedding", encode(F.col(text)))

    return embed


def embed_sections(
    section_rows: DataFrame, embedder, key: str, text: str = "section_text", among: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(key, embedding_type, embedding)`` of the sections that could be embedded, and rejects of documents for which none could.

    The embedder sees every part of a section once. A section in several parts (``part_no``) gets their mean by length, at
    length one. ``among`` has the documents that were to be embedded: those without a section are rejects as well.
    """
    weight = F.length(text).cast("double").alias("_chars")
    embedded = written(embedder(section_rows, text).select(key, "embedding_type", weight, "embedding"), "embedded")
    # what is stored, what is missing and what failed all read the vectors
    return split_embedded(written(pooled(embedded, key), "pooled"), key, among)


def pooled(parts: DataFrame, key: str) -> DataFrame:
    """One vector for each ``(key, embedding_type)``: that of the only part, or the mean of several by ``_chars``, at length one.

    Sums are made task by task, so a text of very many parts is no large group.
    """
    usable = parts.filter(F.col("embedding").isNotNull())
    mean = Summarizer.mean(array_to_vector("embedding"), F.col("_chars"))
    sums = usable.groupBy(key, "embedding_type").agg(F.count("*").alias("_n"), F.max("embedding").alias("_one"), mean.alias("_mean"))
    unit = Normalizer(inputCol="_mean", outputCol="_unit", p=2.0).transform(sums)
    one = F.when(F.col("_n") == 1, F.col("_one")).otherwise(vector_to_array("_unit", "float32"))
    missing = parts.select(key, "embedding_type").distinct().join(sums.select(key, "embedding_type"), [key, "embedding_type"], "left_anti")
    none = missing.withColumn("embedding", F.lit(None).cast("array<float>"))
    return unit.select(key, "embedding_type", one.alias("embedding")).unionByName(none)


def split_embedded(rows: DataFrame, key: str, among: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(key, embedding_type, embedding)`` of the embedded rows, and rejects of documents without any."""
    embedded = rows.select(key, "embedding_type", "embedding")
    done = embedded.filter(F.col("embedding").isNotNull())
    asked = (rows if among is None else among).select(key).distinct()
    failed = asked.join(done.select(key).distinct(), key, "left_anti")
    rejects = failed.select(
        F.lit("embed").alias("stage"), F.col(key).cast("string").alias("key"), F.lit("no_embedding").alias("reason")
    )
    return done, rejects
