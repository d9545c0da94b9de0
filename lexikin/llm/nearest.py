"""Nearest vectors by cross-polytope hashing with multiprobe and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lexikin.llm.common import digest, few, ranked, written

#: Two tables, 56 of the 128 axes of 64 dimensions: a vector is moved once a table, so few
#: tables with many probes cost less than many tables for the same recall.
TABLES, PROBES, BLOCK = 2, 56, 4_096
#: Axes are dealt to so many cells a table.
CELLS = 16
SLACK = 1e-9
#: Hashes of repeated vectors (16 bytes each) that are broadcast at most.
REPEATED = 1 << 20


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, all components finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _signs(tables: int, width: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, width))


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, width, half = *x.shape, 1
    while half < width:
        pairs = x.reshape(n, -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def axes(unit: np.ndarray, tables: int, probes: int, seed: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each vector after each table's rotation.

    A rotation is three rounds of random signs and a Hadamard transform; axis j stands
    for +e_j and width + j for -e_j. The first axis is the vector's hash.
    """
    n, d = unit.shape
    width = 1 << max(0, d - 1).bit_length()
    padded = np.zeros((n, width))
    padded[:, :d] = unit
    out = np.empty((n, tables, min(probes, 2 * width)), np.int64)
    for t, rounds in enumerate(_signs(tables, width, seed)):
        x = padded
        for sign in rounds:
            x = _hadamard(x * sign)
        both = np.concatenate([x, -x], axis=1)
        out[:, t] = np.argsort(-both, axis=1, kind="stable")[:, : out.shape[2]]
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _coded(rows: DataFrame, tables: int, probes: int, seed: int, vectors: bool = True) -> DataFrame:
    """id, dim, table, cell, codes (, vec): a row for each table and cell that holds some of
    the ``probes`` nearest axes of a vector, with those axes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch.vec.map(len), sort=True):
                for at in range(0, len(part), 1024):
                    some = part.iloc[at : at + 1024]
                    found = axes(_unit(np.stack(some.vec).astype(float)), tables, probes, seed)
                    n, _, k = found.shape
                    where = np.repeat(np.arange(n * tables), k)
                    flat = found.ravel()
                    order = np.lexsort((flat, flat % CELLS, where))
                    key = where[order] * CELLS + flat[order] % CELLS
                    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                    row, table = np.divmod(key[first] // CELLS, tables)
                    made = {
                        "id": some.id.to_numpy()[row],
                        "dim": dim,
                        "table": table,
                        "cell": key[first] % CELLS,
                        "codes": np.split(flat[order], first[1:]),
                    }
                    yield pd.DataFrame(made | ({"vec": some.vec.to_numpy()[row]} if vectors else {}))

    kind = f", vec {rows.schema['vec'].dataType.simpleString()}" if vectors else ""
    return rows.mapInPandas(run, f"id long, dim int, table int, cell int, codes array<int>{kind}")


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, alike for equal rows."""
    return (_unit(a) * _unit(b)).sum(axis=1)


def _best_of_block(k: int):
    """The k best ids of a block of one cell for each query that probes an axis in it."""

    def best(asked, ids, vecs, most: int):
        """query, row and score of the best rows, and some more where ids repeat."""
        rough = _unit(asked) @ _unit(vecs).T
        n = min(most, len(ids))
        floor = -np.partition(-rough, n - 1, axis=1)[:, n - 1]
        q, r = np.nonzero(rough >= floor[:, None] - SLACK)
        return q, r, cosines(asked[q], vecs[r])

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            ids, vecs = rows.id.to_numpy(), np.stack(rows.vec).astype(float)
            most = k * int(np.unique(ids, return_counts=True)[1].max())
            code = rows.codes.str[0].to_numpy()
            for at in range(0, len(queries), 512):
                some = queries.iloc[at : at + 512]
                own, asked = some.id.to_numpy(), np.stack(some.vec).astype(float)
                who, probed = np.repeat(np.arange(len(some)), some.codes.map(len)), np.concatenate(some.codes.to_numpy())
                for c in np.unique(code):
                    mine, there = who[probed == c], np.flatnonzero(code == c)
                    if len(mine):
                        q, r, score = best(asked[mine], ids[there], vecs[there], most)
                        found.append((own[mine[q]], ids[there[r]], score))
        if not found:
            return pd.DataFrame({"query": [], "vec_id": [], "score": []}).astype({"query": "int64", "vec_id": "int64"})
        out = pd.DataFrame(dict(zip(("query", "vec_id", "score"), map(np.concatenate, zip(*found)))))
        out = out.sort_values(["query", "score", "vec_id"], ascending=[True, False, True]).drop_duplicates(["query", "vec_id"])
        return out[out.groupby("query").cumcount() < k]

    return run


def _best_in_cells(asked, counted, rows, k: int, block: int) -> DataFrame:
    """query, vec_id, score: for each query of ``asked`` the k best rows of each cell it
    meets, among the ``rows`` with one of its codes.

    Rows and queries of a cell are both cut into parts of about ``block`` by their ids, as
    counted in ``counted`` (asked and rows without vectors); no task holds more of either.
    """
    key = ["dim", "table", "cell"]
    parts = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    # a row for each cell: at most tables * CELLS for each dimension
    cuts = F.broadcast(written(parts(counted[1], "r_cuts").join(parts(counted[0], "q_cuts"), key), "cells"))
    part = lambda cuts: F.pmod(F.xxhash64("id"), F.col(cuts)).cast("int")
    every = lambda cuts: F.explode(F.sequence(F.lit(0), F.col(cuts) - 1))
    cell = [*key, "q", "r"]
    queries = asked.join(cuts, key).withColumn("q", part("q_cuts")).withColumn("r", every("r_cuts"))
    others = rows.join(cuts, key).withColumn("r", part("r_cuts")).withColumn("q", every("q_cuts"))
    return (
        queries.select(*cell, "id", "codes", "vec")
        .groupBy(*cell)
        .cogroup(others.select(*cell, "id", "codes", "vec").groupBy(*cell))
        .applyInPandas(_best_of_block(k), "query long, vec_id long, score double")
    )


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).drop("_n")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    tables: int = TABLES,
    probes: int = PROBES,
    block: int = BLOCK,
    seed: int = 71,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k nearest found by cosine.

    Every usable row of ``vectors`` is indexed in each table under the signed axis that
    its rotated unit vector is nearest to; a query looks under its ``probes`` nearest
    axes, and all rows found there are ranked by the exact cosine in double precision,
    ties to the smaller id. A query under whose axes fewer than k others lie is searched
    exactly among all rows, so each gets k rows, or all there are if there are fewer. A
    query never finds its own id. Rows and queries of a bucket are cut into parts of about
    ``block``, which meet as matrices, and only the best of a part move on. Of equal
    vectors the k + 1 smallest ids are indexed, as no others can be among the k nearest;
    equal queries are searched once.

    Null, zero and non-finite vectors and null ids take no part; only vectors of one
    length are compared. Repeated rows count once. An id on several vectors, be it of rows
    or of queries, is ranked by the best score of any of them, and is found once. No usable
    row or query: no result.
    """
    single = isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType)
    kind = "float" if single and isinstance(queries.schema[vec_col].dataType.elementType, T.FloatType) else "double"

    def clean(df: DataFrame) -> DataFrame:
        vec = F.col(vec_col).cast(f"array<{kind}>")
        return (
            df.where(F.col(id_col).isNotNull() & usable(vec))
            # 0.0 in place of -0.0, so that equal vectors have equal hashes
            .select(F.col(id_col).cast("long").alias("id"), F.transform(vec, lambda x: x + F.lit(0.0).cast(kind)).alias("vec"))
            .withColumns(dict(zip(("h1", "h2"), digest(F.col("vec")), strict=True)))
        )

    # only equal vectors are moved to choose among them
    every = clean(vectors)
    repeated = written(every.groupBy("h1", "h2").count().where("count > 1").select("h1", "h2"), "repeated")
    repeated = few(repeated, REPEATED)
    same = Window.partitionBy("h1", "h2").orderBy("id")
    first = every.join(repeated, ["h1", "h2"], "left_semi").dropDuplicates(["id", "h1", "h2"])
    first = written(first.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1), "first")
    rows = every.join(repeated, ["h1", "h2"], "left_anti").select("id", "vec").union(first.select("id", "vec"))

    asked = written(clean(queries).dropDuplicates(["id", "h1", "h2"]), "queries")
    groups = written(asked.groupBy("h1", "h2").agg(F.min(F.struct("id", "vec")).alias("one")), "query_groups")
    # a group of equal queries is named by a number, as an id may have several vectors
    groups = ranked(groups, [F.col("h1"), F.col("h2")], "group")
    one_each = groups.select(F.col("group").alias("id"), F.col("one.vec").alias("vec"))

    coded = lambda vecs: (_coded(one_each, tables, probes, seed, vecs), _coded(rows, tables, 1, seed, vecs))
    asked_codes, row_codes = coded(True)
    found = _best_in_cells(asked_codes, coded(False), row_codes, k + 1, block)
    found = found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    # k + 1 others beside the group's own rows: an own id is taken out for each query.
    top = written(_top(found, k + 1), "found")
    enough = top.groupBy("query").count().where(F.col("count") > k).select(F.col("query").alias("id"))
    short = written(one_each.join(enough, "id", "left_anti"), "short")
    if not short.isEmpty():
        whole = lambda df: df.select(
            "id", F.size("vec").alias("dim"), F.lit(0).alias("table"), F.lit(0).alias("cell"), F.array(F.lit(0)).alias("codes"), "vec"
        )
        searched = _best_in_cells(whole(short), (whole(short), whole(rows)), whole(rows), k + 1, block)
        searched = searched.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
        kept = top.join(enough.withColumnRenamed("id", "query"), "query", "left_semi")
        top = kept.unionByName(written(_top(searched, k + 1), "searched_whole"))
    members = asked.select("h1", "h2", F.col("id").alias("query_id")).distinct()
    each = (
        members.join(groups.select("h1", "h2", F.col("group").alias("query")), ["h1", "h2"])
        .join(top, "query")
        .where("vec_id <> query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        each.withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
