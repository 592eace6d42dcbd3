"""Edits of keyed tables as DataFrames: upsert, insert, patch, delete, cascade.

Each function takes the present table and gives its next state; ``sources.tables`` writes it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.operators.dedupe import first_by_key, last_by_key
from quillmill.operators.running import assign_ids
from quillmill.session import written

PAPER_UPDATES = ["title", "year", "pdf_url", "sha256", "source"]


def _all_set(keys: Sequence[str]) -> Column:
    every = F.lit(True)
    for key in keys:
        every = every & F.col(key).isNotNull()
    return every


def latest_incoming(incoming: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key; rows with a NULL in the key conflict with nothing and all stay."""
    keyed = last_by_key(incoming.filter(_all_set(keys)), list(keys), [order])
    return keyed.unionByName(incoming.filter(~_all_set(keys)))


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    updates: Sequence[str],
    as_of: Column,
    order: str = "ord",
    id_column: str | None = "id",
    touch: bool = True,
    max_id: Column | int | None = None,
) -> DataFrame:
    """``existing`` after inserting or overwriting the ``incoming`` rows.

    * A row whose key exists overwrites the ``updates`` columns, also with NULL; other columns
      stay. ``updated_at`` is set when ``touch``.
    * Other rows are inserted with both audit columns, new ids going on after the greatest.
    * Of several incoming rows of a key the last by ``order`` counts. NULL keys never conflict.

    The present table is joined with the incoming rows only, so that a small batch is
    broadcast by Spark; ids are numbered without a one-task window.
    """
    keys = list(keys)
    keyed = last_by_key(incoming.filter(_all_set(keys)), keys, [order])
    unkeyed = incoming.filter(~_all_set(keys))
    return _updated(existing, keyed, keys, updates, as_of, touch).unionByName(
        _inserted(existing, keyed, unkeyed, keys, as_of, order, id_column, max_id)
    )


def _updated(existing, latest, keys, updates, as_of, touch) -> DataFrame:
    """The present rows; rows without a key stay out of the join."""
    changes = latest.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(c).alias(f"_new_{c}") for c in updates],
        F.lit(True).alias("_changed"),
    )
    keyed, unkeyed = existing.filter(_all_set(keys)), existing.filter(~_all_set(keys))
    same = [F.col(k) == F.col(f"_key_{k}") for k in keys]
    joined = keyed.join(changes, same, "left")

    def next_value(name: str) -> Column:
        if name in updates:
            return F.when(F.col("_changed"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
        if name == "updated_at" and touch:
            return F.when(F.col("_changed"), as_of).otherwise(F.col(name)).alias(name)
        return F.col(name)

    return joined.select(*[next_value(c) for c in existing.columns]).unionByName(unkeyed)


def _inserted(existing, keyed, unkeyed, keys, as_of, order, id_column, max_id) -> DataFrame:
    """The new rows: keyed ones whose key is not there, and all without a key, which skip the join."""
    new = keyed.join(existing.select(*keys), keys, "left_anti").unionByName(unkeyed)
    return _as_rows(existing, new, keys, as_of, order, id_column, max_id)


def _as_rows(existing, new, keys, as_of, order, id_column, max_id) -> DataFrame:
    """New rows with ids that go on after the greatest, both audit columns, and the columns of ``existing``."""
    if id_column in existing.columns and id_column not in keys and id_column not in new.columns:
        if max_id is None:
            max_id = existing.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
        new = assign_ids(new, order, id_column, max_id, ties=keys)
    types = dict(existing.dtypes)

    def first_value(name: str) -> Column:
        if name in new.columns:
            return F.col(name).cast(types[name]).alias(name)
        if name in ("created_at", "updated_at"):
            return as_of.alias(name)
        return F.lit(None).cast(types[name]).alias(name)

    return new.select(*[first_value(c) for c in existing.columns])


def resolve_paper_ids(incoming: DataFrame, papers: DataFrame) -> DataFrame:
    """Replace ``doi`` by ``paper_id``; rows of unknown papers are left out."""
    known = papers.filter(F.col("doi").isNotNull()).select("doi", F.col("id").alias("paper_id"))
    return incoming.join(known, "doi").drop("doi")


def upsert_papers(papers: DataFrame, incoming: DataFrame, as_of: Column, updates: Sequence[str] = PAPER_UPDATES, **options) -> DataFrame:
    """Papers by DOI. Pass ``updates`` with ``authors`` for sources that know them."""
    return upsert(papers, incoming, ["doi"], updates, as_of, **options)


def _upsert_child(table, incoming, papers, kind, payload, as_of, order, touch, **options) -> DataFrame:
    # one row per paper and kind before the join, so that no DOI brings many rows to it
    latest = latest_incoming(incoming, ["doi", kind], order)
    return upsert(table, resolve_paper_ids(latest, papers), ["paper_id", kind], [payload], as_of, order, touch=touch, **options)


def upsert_summaries(summaries: DataFrame, incoming: DataFrame, papers: DataFrame, as_of: Column, order: str = "ord", **options) -> DataFrame:
    """``(doi, summary_type, content)`` rows into summaries by paper and type."""
    return _upsert_child(summaries, incoming, papers, "summary_type", "content", as_of, order, True, **options)


def upsert_embeddings(embeddings: DataFrame, incoming: DataFrame, papers: DataFrame, as_of: Column, order: str = "ord", **options) -> DataFrame:
    """``(doi, embedding_type, embedding)`` rows into embeddings by paper and type."""
    return _upsert_child(embeddings, incoming, papers, "embedding_type", "embedding", as_of, order, False, **options)


def upsert_metadata(metadata: DataFrame, incoming: DataFrame, as_of: Column, order: str = "ord", **options) -> DataFrame:
    """``(paper_id, key, value)`` rows, JSON values, by paper and key."""
    return upsert(metadata, incoming, ["paper_id", "key"], ["value"], as_of, order, **options)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], as_of: Column, order: str = "ord", id_column: str | None = "id") -> DataFrame:
    """``existing`` and the incoming rows whose key it lacks; the first of several counts."""
    keys = list(keys)
    keyed = first_by_key(incoming.filter(_all_set(keys)), keys, [order])
    unkeyed = incoming.filter(~_all_set(keys))
    return existing.unionByName(_inserted(existing, keyed, unkeyed, keys, as_of, order, id_column, None))


def insert_edges(edges: DataFrame, incoming: DataFrame, as_of: Column, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """Edges after the insert, and the incoming rows in conflict with an edge or with each other.

    The present edges and the first arrival of each incoming one meet in one aggregate; the verdict comes back to the rows by key and
    arrival number, so that a pair that comes very often is no hot key, and is written once for both results.
    """
    keys = ["source_paper_id", "target_paper_id", "relationship_type"]
    keyed, unkeyed = incoming.filter(_all_set(keys)), incoming.filter(~_all_set(keys))
    there = edges.select(*keys, F.lit(None).cast(dict(incoming.dtypes)[order]).alias(order), F.lit(True).alias("_there"))
    seen = there.unionByName(keyed.select(*keys, order, F.lit(False).alias("_there"))).groupBy(*keys)
    firsts = seen.agg(F.min(order).alias(order), F.bool_or("_there").alias("_there")).filter(~F.col("_there"))
    verdicts = written(keyed.join(firsts.select(*keys, order, F.lit(True).alias("_first")), [*keys, order], "left"), "edge-verdicts")
    accepted = verdicts.filter("_first").select(*incoming.columns)
    inserted = _as_rows(edges, accepted.unionByName(unkeyed), keys, as_of, order, "id", None)
    conflicts = verdicts.filter("_first is null").select(*incoming.columns)
    return edges.unionByName(inserted), conflicts.withColumn("reason", F.lit("duplicate_edge"))


def create_rows(existing: DataFrame, incoming: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Append rows; columns the incoming rows lack, or have as NULL, get their default."""
    types = dict(existing.dtypes)

    def value(name: str) -> Column:
        default = defaults.get(name, F.lit(None)).cast(types[name])
        given = F.coalesce(F.col(name).cast(types[name]), default) if name in incoming.columns else default
        return given.alias(name)

    return existing.unionByName(incoming.select(*[value(c) for c in existing.columns]))


def stable_uuid(*parts: Column) -> Column:
    """A UUID-shaped id from the values it names, the same again when a task is repeated."""
    digest = F.md5(F.concat_ws("\x1f", *parts))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def patch_rows(existing: DataFrame, patches: DataFrame, key: str, columns: Sequence[str], order: str | None = None) -> DataFrame:
    """Overwrite the named fields of rows.

    ``patches`` has ``key``, ``fields`` (the names to set) and the new values; a field that is
    named and NULL is set to NULL. With ``order`` several patches of a row are taken one after the
    other: for each field the last patch that names it counts.
    """
    named = lambda c: F.array_contains("fields", c)
    if order is None:
        latest = patches.select(
            F.col(key).alias("_key"),
            *[F.when(named(c), F.struct(F.col(c).alias("value"))).alias(f"_set_{c}") for c in columns],
        )
    else:
        latest = patches.groupBy(F.col(key).alias("_key")).agg(*[
            F.max(F.when(named(c), F.struct(F.col(order).alias("at"), F.col(c).alias("value")))).alias(f"_set_{c}")
            for c in columns
        ])
    joined = existing.join(latest, F.col(key) == F.col("_key"), "left")
    value = lambda c: F.when(F.col(f"_set_{c}").isNotNull(), F.col(f"_set_{c}.value")).otherwise(F.col(c)).alias(c)
    return joined.select(*[value(c) if c in columns else F.col(c) for c in existing.columns])


def delete_rows(existing: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows that stay, and ``(key, existed)`` for every id asked for."""
    asked = ids.select(key).distinct()
    there = existing.select(key).distinct().withColumn("_there", F.lit(True))
    report = asked.join(there, key, "left").select(key, F.col("_there").isNotNull().alias("existed"))
    return _keeping(existing, asked, key, "left_anti"), report


def _keeping(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """A semi or anti join that leaves the columns in their order."""
    return df.join(keys, key, how).select(*df.columns)


@dataclass(frozen=True)
class Child:
    """A table that points at another one: ``table.column`` refers to ``parent``'s ``parent_key``."""

    table: str
    column: str
    parent: str
    parent_key: str


PAPER_CHILDREN = [
    Child("summaries", "paper_id", "papers", "id"),
    Child("embeddings", "paper_id", "papers", "id"),
    Child("paper_relationships", "source_paper_id", "papers", "id"),
    Child("paper_relationships", "target_paper_id", "papers", "id"),
    Child("paper_metadata", "paper_id", "papers", "id"),
]
WORK_CHILDREN = [
    Child("files", "work_id", "works", "work_id"),
    Child("chunks", "file_id", "files", "file_id"),
    Child("file_summaries", "file_id", "files", "file_id"),
    Child("ingest_queue", "file_id", "files", "file_id"),
]


def cascade_delete(tables: dict[str, DataFrame], root: str, key: str, ids: DataFrame, children: Sequence[Child]) -> dict[str, DataFrame]:
    """All tables without the deleted rows and whatever points at them.

    ``children`` stand in parent-first order. Only keys of deleted rows travel down, so a delete
    of few rows joins small key sets.
    """
    asked = ids.select(key).distinct()
    gone = {root: _keeping(tables[root], asked, key, "left_semi")}
    left = {**tables, root: _keeping(tables[root], asked, key, "left_anti")}
    for child in children:
        if child.parent not in gone:
            continue
        dead = gone[child.parent].select(F.col(child.parent_key).alias(child.column)).distinct()
        removed = _keeping(left[child.table], dead, child.column, "left_semi")
        gone[child.table] = gone[child.table].unionByName(removed) if child.table in gone else removed
        left[child.table] = _keeping(left[child.table], dead, child.column, "left_anti")
    return left


def delete_cascade(batch, root: str, key: str, ids: DataFrame, children: Sequence[Child]) -> None:
    """The same over stored tables, as edits of one ``sources.tables.Batch``.

    A table keyed by the column that points at the dead rows has only their buckets rewritten; others are
    read whole. Nothing counts before the batch commits.
    """
    gone = {root: written(_keeping(batch.read(root), ids.select(key).distinct(), key, "left_semi"), "dead")}
    parts = {}
    for child in children:
        if child.parent not in gone:
            continue
        dead = gone[child.parent].select(F.col(child.parent_key).alias(child.column)).distinct()
        removed = written(_keeping(batch.read(child.table), dead, child.column, "left_semi"), "dead")
        gone[child.table] = gone[child.table].unionByName(removed) if child.table in gone else removed
        parts.setdefault(child.table, []).append((child.column, dead))
    parts[root] = [(key, gone[root].select(key).distinct())]
    for name, dead_by in parts.items():
        for column, dead in dead_by:
            without = lambda old, asked, c=column: _keeping(old, asked, c, "left_anti")
            if list(batch.store.tables[name].keys) == [column]:
                batch.edit(name, dead, without)
            else:
                batch.replace(name, without(batch.read(name), dead))


def save_hits(works: DataFrame, search_hits: DataFrame, hits: DataFrame, topic: str, as_of: Column, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """Works and search hits after saving: one work for each DOI, old or new, and a search hit for each hit.

    Hits with a DOI share the ``work_id`` of its work; each of the others has one of its own. Ids come from what they name (the
    DOI, or the hit, its place in ``order`` and how many equal ones it follows), so that saving again after a lost task gives
    the same ones, and no two hits of a topic share one.
    """
    named = hits.select(
        F.when(F.col("doi") != "", F.col("doi")).alias("doi"), "url", F.col("source").alias("provider"),
        F.xxhash64(*hits.columns).alias("_mark"), F.to_json(F.struct(order), {"ignoreNullFields": "false"}).alias("_place"),
    )
    # equal hits are counted first, so that they are one row however many they are
    counted = named.groupBy(*named.columns).agg(F.count("*").cast("int").alias("_n"))
    each = counted.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    parts = [F.lit(topic), *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("doi", "url", "provider", "_mark", "_place", "_nth")]]
    own = each.select("doi", "url", "provider", stable_uuid(F.lit("hit"), *parts).alias("hit_id"), stable_uuid(F.lit("alone"), *parts).alias("_alone"))
    fresh = own.filter(F.col("doi").isNotNull()).select("doi").distinct().join(works.select("doi").distinct(), "doi", "left_anti")
    new_works = create_rows(works, fresh.select(stable_uuid(F.lit("work"), F.col("doi")).alias("work_id"), "doi"), {"created_at": as_of})
    known = new_works.filter(F.col("doi").isNotNull()).groupBy("doi").agg(F.min("work_id").alias("_work"))
    with_doi, without = own.filter(F.col("doi").isNotNull()), own.filter(F.col("doi").isNull())
    met = with_doi.join(known, "doi").withColumn("work_id", F.col("_work")).drop("_work")
    saved = met.unionByName(without.withColumn("work_id", F.col("_alone")))
    new_hits = saved.select("hit_id", "work_id", "url", "provider", F.lit(topic).alias("topic"))
    return new_works, create_rows(search_hits, new_hits, {})
