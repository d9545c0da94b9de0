"""Near-dedup: fast similarity sketches, banding, and a check on full shingle sets."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from lexikin.llm.common import MARKS, few, row_name, text_or_empty, without_rows, written
from lexikin.llm.graph import components

#: Rows of a band and bands. A pair of similarity 0.8 misses all bands with
#: probability (1 - 0.8 ** ROWS) ** BANDS = 1.3e-6.
ROWS, BANDS = 6, 45
TOGETHER = 256
#: So many classes outside a group's largest component are checked pair by pair.
FEW = 16
CACHED = 1 << 17
EMPTY = np.uint64(2**64 - 1)
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Words(dict):
    """64-bit hashes of words, kept for the words met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(words: list[bytes], size: int, known: Words) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` words.

    With fewer words the whole sequence is the one shingle; without words there is none.
    """
    if not words:
        return np.empty(0, U)
    h = np.fromiter(map(known.__getitem__, words), U, len(words))
    width = min(size, len(words))
    n = len(words) - width + 1
    out = np.full(n, U(width))
    for j in range(width):
        out = mixed(out * U(0x9E3779B97F4A7C15) + h[j : j + n])
    return np.unique(out)


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z lowered; only ASCII white space parts words."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def fast_sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Fast similarity sketches of non-empty sets, one row of ``size`` values each.

    Round i < size puts every element into one hashed bin with a value in [i, i + 1);
    round i >= size puts all elements into bin i - size. A bin keeps its least value, so
    a round only counts for bins that no earlier round has filled, and after 2 * size
    rounds every bin is full. Most sets are done after about size * ln(size) / |set| rounds.
    """
    lengths = [len(s) for s in sets]
    owner, items = np.repeat(np.arange(len(sets)), lengths), np.concatenate(sets)
    out = np.full(len(sets) * size, EMPTY)
    for i in range(2 * size):
        h = mixed(items + U((i + 1) * 0xD1342543DE82EF95 % 2**64))
        bins = ((h >> U(32)) * U(size) >> U(32)).astype(np.int64) if i < size else i - size
        at = owner * size + bins
        free = out[at] == EMPTY
        np.minimum.at(out, at[free], (U(i) << U(32)) | (h[free] & U(0xFFFFFFFF)))
        open_ = (out.reshape(-1, size) == EMPTY).any(axis=1)
        if not open_.any():
            break
        more = open_[owner]
        if not more.all():
            owner, items = owner[more], items[more]
    return out.reshape(-1, size)


def band_keys(sketches: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One hash for each band of ``rows`` coordinates, different for each band's number."""
    parts = sketches.reshape(len(sketches), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=U), (len(sketches), bands))
    for j in range(rows):
        keys = mixed(keys * U(0x9E3779B97F4A7C15) + parts[:, :, j])
    return keys.view(np.int64)


def _sketched(docs: DataFrame, size: int, rows: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, set_key (null for the empty set), bands, packed words, and
    text_key where ``docs`` has it."""
    more = [c for c in docs.columns if c == "text_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, packer = Words(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            # of a batch, only the texts at hand become Python strings
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                words = [words_of(t) for t in part.column("text").to_pylist()]
                sets = [shingles(w, size, known) for w in words]
                full = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                if full:
                    found = band_keys(fast_sketches([sets[i] for i in full], rows * bands), rows, bands)
                    for i, k in zip(full, found, strict=True):
                        keys[i] = k
                made = {
                    "doc_id": part.column("doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_key": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    "bands": pa.array(keys, pa.list_(pa.int64())),
                    "packed": pa.array([packer.compress(b" ".join(w)) for w in words], pa.binary()),
                    **{c: part.column(c) for c in more},
                }
                yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    schema = "doc_id string, n_shingles long, set_key binary, bands array<long>, packed binary"
    return docs.mapInArrow(run, ", ".join([schema, *(f"{c} binary" for c in more)]))


def _similarities(pairs: DataFrame, packed: DataFrame, size: int) -> DataFrame:
    """lo, hi, both, either: the exact sizes of intersection and union of each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, open_, kept = Words(), zstandard.ZstdDecompressor(), OrderedDict()

        def full(node: int, data: bytes) -> np.ndarray:
            if node not in kept:
                kept[node] = shingles(open_.decompress(data).split(), size, known)
                if len(kept) > 64:
                    kept.popitem(last=False)
            kept.move_to_end(node)
            return kept[node]

        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                both, either = [], []
                for lo, hi, a, b in zip(*(part.column(c).to_pylist() for c in ("lo", "hi", "a", "b")), strict=True):
                    x, y = full(lo, a), full(hi, b)
                    both.append(len(np.intersect1d(x, y, assume_unique=True)))
                    either.append(len(x) + len(y) - both[-1])
                counts = [pa.array(c, pa.int64()) for c in (both, either)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("lo"), part.column("hi"), *counts], names=["lo", "hi", "both", "either"]
                )

    # the texts grow with the documents: never broadcast because a small table allows it
    sides = pairs.select("lo", "hi").join(
        packed.select(F.col("node").alias("hi"), F.col("packed").alias("b")).hint("merge"), "hi"
    ).join(packed.select(F.col("node").alias("lo"), F.col("packed").alias("a")).hint("merge"), "lo")
    return written(sides.mapInArrow(run, "lo long, hi long, both long, either long"), "similarities")


def _block_links(size: int, percent: int):
    """Links between two blocks of classes, one for each two components that have some."""

    def run(few: pd.DataFrame, rest: pd.DataFrame) -> pd.DataFrame:
        known, open_, out = Words(), zstandard.ZstdDecompressor(), {}
        if len(few) and len(rest):
            sets = [shingles(open_.decompress(p).split(), size, known) for p in few.packed_]
            lengths, nodes, roots = np.array([len(s) for s in sets]), few.node_.to_numpy(), few.root_.to_numpy()
            items, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
            order = np.argsort(items, kind="stable")
            items, owner = items[order], owner[order]
            for node, root, packed in zip(rest.node, rest.root, rest.packed, strict=True):
                own = shingles(open_.decompress(packed).split(), size, known)
                first, last = np.searchsorted(items, own, "left"), np.searchsorted(items, own, "right")
                n = last - first
                at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(sets))
                good = (100 * both >= percent * (lengths + len(own) - both)) & (roots != root)
                for i in np.nonzero(good)[0].tolist():
                    out.setdefault((roots[i], root), (min(nodes[i], node), max(nodes[i], node)))
        return pd.DataFrame(list(out.values()), columns=["lo", "hi"]).astype("int64")

    return run


def _between_components(
    met: DataFrame, roots: DataFrame, packed: DataFrame, size: int, percent: int
) -> DataFrame:
    """lo, hi: links between classes that met the same class (lead, node, d) but are in
    different components.

    In each group, the classes outside its largest component (the few) are checked with
    all others. Up to FEW of them make pairs, at most FEW for each class of the group,
    less those that sizes or the triangle inequality of the Jaccard distance rule out.
    Beyond, blocks of the few meet blocks of the group, and only links come out.
    """
    placed = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = (
        placed.groupBy("lead", "root")
        .agg(F.count("*").alias("c"))
        .groupBy("lead")
        .agg(F.max(F.struct("c", "root")).alias("m"), F.sum("c").alias("all"))
        .select("lead", F.col("m.root").alias("major"), "all", (F.col("all") - F.col("m.c")).alias("few"))
        .where("few > 0")
    )
    placed = written(placed.join(groups, "lead"), "placed")
    others = placed.where("root <> major")

    pairs = (
        others.where(F.col("few") <= FEW)
        .select("lead", *(F.col(c).alias(f"_{c}") for c in ("node", "root", "d")))
        .join(placed.where(F.col("few") <= FEW), "lead")
        .where("root <> _root AND (root = major OR node < _node)")
        .where(F.abs(F.col("d") - F.col("_d")) <= 1 - percent / 100 + 1e-9)
        .select(F.least("node", "_node").alias("lo"), F.greatest("node", "_node").alias("hi"))
        .distinct()
    )
    linked = F.col("both") * 100 >= F.col("either") * percent
    links = _similarities(pairs, packed, size).where(linked).select("lo", "hi")

    f_cuts, a_cuts = F.ceil(F.col("few") / 128).cast("int"), F.ceil(F.col("all") / 256).cast("int")
    cut = lambda cuts: F.pmod(F.xxhash64("node"), cuts).cast("int")
    every = lambda cuts: F.explode(F.sequence(F.lit(0), cuts - 1))
    side = lambda df: df.where(F.col("few") > FEW).join(packed, "node")
    key = ["lead", "f", "a"]
    left = side(others).withColumn("f", cut(f_cuts)).withColumn("a", every(a_cuts))
    right = side(placed).withColumn("a", cut(a_cuts)).withColumn("f", every(f_cuts))
    columns = [*key, "node", "root", "packed"]
    blocks = (
        left.select(*(F.col(c).alias(f"{c}_") for c in columns))
        .groupBy(*(f"{c}_" for c in key))
        .cogroup(right.select(columns).groupBy(*key))
        .applyInPandas(_block_links(size, percent), "lo long, hi long")
    )
    return links.union(blocks).distinct()


def _of_nodes(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``texts`` (node, packed) whose node is one of ``nodes``.

    Texts stay where they are: nodes go to them as bits, 64 row numbers to a mask. Only
    beyond 64 * MARKS rows are the texts dealt out to their masks.
    """
    word, bit = F.shiftright("node", 6).alias("word"), F.expr("CAST(node & 63 AS INT)")
    masks = nodes.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, CAST(node & 63 AS INT))")).alias("mask"))
    masks = few(written(masks, "masks"), MARKS)
    met = texts.withColumn("word", word).join(masks, "word")
    return met.where(F.getbit("mask", bit) == 1).select(*texts.columns)


def _in_groups(texts: DataFrame, size: int, percent: int, rows: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, set_key, component_id of each row of ``texts`` (doc_id, text).

    Where ``texts`` has a ``text_key``, too, it stays, and ``first`` is the least
    (doc_id is null, doc_id, text_key) of the component.
    """
    keyed = "text_key" in texts.columns
    id_type = texts.schema["doc_id"].dataType
    texts = texts.withColumn("doc_id", F.col("doc_id").cast("string"))
    sketched = written(
        _sketched(texts, size, rows, bands)
        .withColumn("doc_id", F.col("doc_id").cast(id_type))
        .withColumn("row", F.monotonically_increasing_id()),
        "sketches",
    )
    full = sketched.where("set_key IS NOT NULL")
    classes = written(
        full.groupBy("set_key").agg(
            F.min("row").alias("node"),
            F.min("doc_id").alias("first_id"),
            F.first("bands").alias("bands"),
            *([F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")).alias("first")] if keyed else []),
        ),
        "classes",
    )
    # dealt once, for the leaders and for those who meet them: the join would add these
    # conditions to one of the two sides only, whose exchange the other couldn't read
    members = classes.select("node", F.explode("bands").alias("bucket"))
    members = members.where("node IS NOT NULL AND bucket IS NOT NULL").repartition("bucket")
    leaders = members.groupBy("bucket").agg(F.min("node").alias("lead"), F.count("*").alias("c"))
    # both sides grow with the documents: never broadcast because a small table allows it
    leaders = leaders.where("c > 1").drop("c").hint("merge")
    stars = members.join(leaders, "bucket").where("node <> lead")
    stars = written(stars.select(F.col("lead").alias("lo"), F.col("node").alias("hi")).distinct(), "stars")
    nodes = stars.select(F.col("lo").alias("node")).union(stars.select("hi")).distinct()
    packed = written(_of_nodes(full.select(F.col("row").alias("node"), "packed"), nodes), "packed")
    checked = _similarities(stars, packed, size)
    linked = F.col("both") * 100 >= F.col("either") * percent
    links = checked.where(linked).select("lo", "hi")
    roots = components(links)

    # Two classes of one bucket both met its first one. What is left are pairs of classes
    # that met the same class but are in different components.
    distance = 1 - F.col("both") / F.col("either")
    met = checked.select(F.col("lo").alias("lead"), F.col("hi").alias("node"), distance.alias("d"))
    again = written(_between_components(met, roots, packed, size, percent), "later_links")
    if not again.isEmpty():
        roots = components(links.union(again))

    first = ["first"] if keyed else []
    named = classes.select("set_key", "node", "first_id", *first).join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    firsts = named.groupBy("root").agg(F.min("first_id").alias("component_id"), *(F.min(c).alias(c) for c in first))
    named = named.select("set_key", "root").join(firsts, "root").select("set_key", "component_id", *first)
    columns = ["doc_id", "n_shingles", "set_key", *(["text_key"] if keyed else [])]
    return sketched.select(*columns).join(named, "set_key", "left")


def near_groups(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    bands: int = BANDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts are linked if 100 * |intersection| >= percent * |union| of their sets of
    ``size``-word shingles; every link that counts was checked on the full sets. Texts of
    one set form a class. Sketches propose classes that share a band. In each bucket all
    classes are checked against its first one; classes of a bucket that are then still in
    different components are checked with each other. So a bucket of near copies costs
    checks in proportion to its size, but for those that stay apart, and none is capped.

    ``component_id`` is the least id reachable over links, ``kept`` whether it is the
    row's own. Null and empty texts have no shingles and stand alone. Null ids never
    name a component unless all its ids are null; repeated rows share a component. An
    empty table gives no rows; other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return (
        _in_groups(texts, size, percent, rows, bands)
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def without_near_copies(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    bands: int = BANDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each group of ``near_groups``; all columns stay.

    The row with the smallest id stays, null ids after all others, then the one with the
    smallest hash of its text; of rows with one id and text one stays. Rows without words
    stand alone and all stay.
    """
    text_key = lambda text: F.sha2(text_or_empty(text), 256)
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        text_or_empty(text_col).alias("text"),
        F.unhex(text_key(text_col)).alias("text_key"),
    )
    first = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")
    marks = (
        _in_groups(texts, size, percent, rows, bands)
        .where("set_key IS NOT NULL")
        .withColumn("gone", ~first.eqNullSafe(F.col("first")))
        .groupBy(row_name(F.col("doc_id"), F.lower(F.hex("text_key"))).alias("name"))
        .agg(F.first("gone").alias("gone"), F.count("*").alias("c"))
    )
    return without_rows(docs, row_name(F.col(id_col), text_key(text_col)), marks)
