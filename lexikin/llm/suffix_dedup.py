"""Repeated byte strings by a sorted array of suffixes.

A *window* is a string of ``length`` bytes inside one text. A window that occurs twice or
more is removed, that is, every byte it covers. Windows next to each other nearly always
hold the same least 16-byte gram in their first half; the place of that gram is their
*anchor*, and it depends on the window's bytes alone. So equal windows have anchors at
equal offsets, and only the suffixes that start at anchors need sorting, about one in
fifty, each with the bytes that its windows reach to the right and to the left.

1. Suffixes whose first ``length / 2`` bytes occur once can't repeat; they go.
2. The others are dealt to buckets by ranges of their bytes, between sampled splitters.
3. A bucket sorts its suffixes by multikey quicksort over 8-byte characters, once to the
   right and once to the left of the anchor. Common lengths of neighbours then give, for
   each offset, the classes of equal windows.
4. Groups at the edge of a bucket may go on in the next one. Their windows are compared
   across buckets by a 128-bit fingerprint, one of each kind from a bucket.

A group of any size is spread over buckets, because ties are split by text and place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lexikin.llm.common import digest, few, text_or_empty, written

GRAM = 16
#: Bytes worked on at once; longer texts are cut with an overlap of one window.
SLICE = 1 << 21
#: Suffixes whose bytes are laid out at once.
BLOCK = 1 << 15
#: Suffixes a bucket holds, about.
BUCKET = 1 << 16
#: Repeated prefixes that are broadcast at most (8 bytes each); beyond, rows are joined.
FEW = 1 << 22
#: Repeated texts that are broadcast at most (32 bytes each).
FEW_TEXTS = 1 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mixed(x: np.ndarray, by: int) -> np.ndarray:
    x = x * _ODD[by]
    return x ^ (x >> np.uint64(31))


def _row_hash(rows: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each row of a byte matrix whose width is a multiple of 8."""
    h = np.full(len(rows), seed * 2 + 1, np.uint64)
    for word in np.ascontiguousarray(rows).view(np.uint64).T:
        h = _mixed(h ^ _mixed(word, 1), 2 * seed % 4) + np.uint64(seed)
    return _mixed(h ^ (h >> np.uint64(29)), 3)


def _gram_hash(data: np.ndarray) -> np.ndarray:
    """32 bits of a hash of the 16 bytes from each place on (shorter at the end)."""
    h = _mixed(data.astype(np.uint64) + np.uint64(1), 0)
    step = 1
    while step < GRAM:
        h[:-step] += _mixed(h[step:], step.bit_length() & 3)
        step *= 2
    return _mixed(h ^ (h >> np.uint64(33)), 3) >> np.uint64(32)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` keys from each place on, for places with so many."""
    done, out = 1, keys
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor, first and last window start, and text number of each run of windows.

    ``data`` holds texts back to back, text i from bounds[i] to bounds[i + 1].
    """
    none = tuple(np.empty(0, np.int64) for _ in range(4))
    if len(data) < length:
        return none
    reach = length // 2 + 1
    keys = (_gram_hash(data) << np.uint64(32)) | np.arange(len(data), dtype=np.uint64)
    at = (_least(keys[: len(data) - length + reach], reach) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(bounds)
    whole = np.maximum(sizes - length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), whole)
    if not len(text):
        return none
    starts = np.arange(len(text)) - np.repeat(np.cumsum(whole) - whole, whole) + bounds[text]
    at = at[starts]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([new[1:], [len(text)]]) - 1
    return at[new], starts[new], starts[last], text[new]


def _slices(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(bytes, bounds, row number, place in the row's text) of parts of a batch."""
    column = batch.column(batch.schema.get_field_index("_text")).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
    parts: list[tuple[int, int, int]] = []
    size = 0

    def given():
        blocks = [data[offsets[r] + a : offsets[r] + b] for r, a, b in parts]
        ends = np.cumsum([0] + [len(x) for x in blocks])
        rows, places = (np.array([p[k] for p in parts], np.int64) for k in (0, 1))
        return np.concatenate(blocks), ends, rows, places

    for r in range(len(column)):
        n = int(offsets[r + 1] - offsets[r])
        if n < length:
            continue
        for a in range(0, n - length + 1, SLICE):
            b = min(n, a + SLICE + length - 1)
            parts.append((r, a, b))
            size += b - a
            if size >= SLICE:
                yield given()
                parts, size = [], 0
    if parts:
        yield given()


def _prefixes(length: int):
    """Stage 1: text key, anchor and hash of the leading bytes of every run of windows."""
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
            for data, bounds, rows, places in _slices(batch, length):
                at, _, _, text = anchors(data, bounds, length)
                found = _prefix_hash(data, at, half)
                row = rows[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[0][row]),
                        pa.array(h[1][row]),
                        pa.array(at - bounds[text] + places[text]),
                        pa.array(found.view(np.int64)),
                    ],
                    names=["h1", "h2", "at", "prefix"],
                )

    return run


def _prefix_hash(data: np.ndarray, at: np.ndarray, half: int) -> np.ndarray:
    return _row_hash(_padded(np.lib.stride_tricks.sliding_window_view(data, half)[at]), 1)


def _suffixes(length: int):
    """Stage 2: one row per different suffix of a block, with the places where it stands."""
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
            wanted = batch.column(batch.schema.get_field_index("_at"))
            for data, bounds, rows, places in _slices(batch, length):
                at, first, last, text = anchors(data, bounds, length)
                row, place = rows[text], at - bounds[text] + places[text]
                if wanted.null_count < len(wanted):
                    keep = np.zeros(len(at), bool)
                    for r in np.unique(row):
                        mine = row == r
                        keep[mine] = np.isin(place[mine], wanted[int(r)].values.to_numpy())
                    at, first, last, row, place = (x[keep] for x in (at, first, last, row, place))
                padded = np.concatenate([np.zeros(half, np.uint8), data, np.zeros(length, np.uint8)])
                view = np.lib.stride_tricks.sliding_window_view(padded, half + length)
                for begin in range(0, len(at), BLOCK):
                    part = slice(begin, begin + BLOCK)
                    low, high = at[part] - last[part], at[part] - first[part]
                    named = np.stack([h[0][row[part]], h[1][row[part]], place[part]], axis=1).astype(np.int64)
                    near = view[at[part]]
                    yield _collapsed(near[:, half:].copy(), near[:, half - 1 :: -1].copy(), low, high, named)

    return run


def _collapsed(right, left, low, high, named) -> pa.RecordBatch:
    """Suffixes without bytes that no window reaches, equal ones as one row."""
    length, half = right.shape[1], left.shape[1]
    prefix = _row_hash(_padded(right[:, :half]), 1)
    right[np.arange(length) >= (length - low)[:, None]] = 0
    left[np.arange(half) >= high[:, None]] = 0
    reach = np.stack([low, high], axis=1).astype("<u4").view(np.uint8)
    whole = _padded(np.concatenate([right, left, reach], axis=1))
    _, one, of = np.unique(_row_hash(whole, 2), return_index=True, return_inverse=True)
    if (whole != whole[one][of]).any():  # two suffixes share a hash: compare all bytes
        kind = whole.view(f"V{whole.shape[1]}").ravel()
        _, one, of = np.unique(kind, return_index=True, return_inverse=True)
    order = np.argsort(of, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(of))]) * named.dtype.itemsize * named.shape[1]
    members = [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(named[order].tobytes())]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(prefix[one].view(np.int64)),
            _binary(right[one]),
            _binary(left[one]),
            pa.array(low[one].astype(np.int32)),
            pa.array(high[one].astype(np.int32)),
            pa.Array.from_buffers(pa.binary(), len(one), members),
        ],
        names=["prefix", "right", "left", "low", "high", "members"],
    )


def _padded(rows: np.ndarray) -> np.ndarray:
    """The rows of a byte matrix with zeros up to a multiple of 8."""
    out = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    out[:, : rows.shape[1]] = rows
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    ends = pa.py_buffer((np.arange(n + 1, dtype=np.int32) * width).tobytes())
    return pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _bytes(column: pa.ChunkedArray, width: int) -> np.ndarray:
    parts = [np.frombuffer(b"".join(c.to_pylist()), np.uint8) for c in column.chunks]
    return np.concatenate(parts).reshape(-1, width) if parts else np.empty((0, width), np.uint8)


def multikey_order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the rows of a byte matrix, and the length that each row shares with
    the one before it (0 for the first).

    Multikey quicksort by 8-byte characters, all segments of a depth at a time: rows that
    still tie are parted by their next character; a segment of one row is left alone.
    """
    n, width = rows.shape
    words = _padded(rows).view(">u8").astype(np.uint64)
    order, shared = np.arange(n), np.full(n, width, np.int64)
    if n:
        shared[0] = 0
    open_at = np.arange(n) if n > 1 else np.empty(0, np.int64)
    segment = np.zeros(len(open_at), np.int64)
    for depth in range(words.shape[1]):
        if not len(open_at):
            break
        word = words[order[open_at], depth]
        place = np.lexsort((word, segment))
        order[open_at] = order[open_at][place]
        word = word[place]  # segments are contiguous and keep their places
        fresh = np.concatenate([[True], segment[1:] != segment[:-1]])
        differs = np.concatenate([[False], word[1:] != word[:-1]]) & ~fresh
        bits = (word[1:] ^ word[:-1])[differs[1:]]
        shared[open_at[differs]] = depth * 8 + _leading_zero_bytes(bits)
        segment = np.cumsum(fresh | differs)
        many = np.bincount(segment)[segment] > 1
        open_at, segment = open_at[many], segment[many]
    return order, np.minimum(shared, width)


def _leading_zero_bytes(x: np.ndarray) -> np.ndarray:
    return sum(((x >> np.uint64(64 - 8 * k)) == 0).astype(np.int64) for k in range(1, 8))


def _bucket(length: int):
    """Stage 3: window starts of a bucket that repeat in it, and windows at its edges."""
    half = length // 2
    names = ["h1", "h2", "start", "stop", "f1", "f2"]

    def answer(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        right, left = _bytes(table["right"], length), _bytes(table["left"], half)
        low, high = (table[c].to_numpy() for c in ("low", "high"))
        lists = table["members"].to_pylist()
        named = np.frombuffer(b"".join(lists), np.int64).reshape(-1, 3)
        copies = np.array([len(m) for m in lists]) // 24
        begins = np.cumsum(copies) - copies
        by_right, shared = multikey_order(right)
        by_left, shared_left = multikey_order(left)
        n = len(low)
        group = np.empty(n, np.int64)
        group[by_right] = np.cumsum(shared < half)
        edge = (group == group.min()) | (group == group.max())
        again = np.bincount(group)[group] > 1
        again |= (copies > 1) | edge
        twice = np.zeros((n, half + 1), bool)
        right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
        edges: list[tuple] = []
        for o in range(half + 1):
            here = np.flatnonzero(again & (low <= o) & (o <= high))
            if not len(here):
                continue
            right_class[by_right] = np.cumsum(shared < length - o)
            left_class[by_left] = np.cumsum(shared_left < o)
            key = right_class[here] * (n + 1) + left_class[here]
            _, one, of = np.unique(key, return_index=True, return_inverse=True)
            times = np.bincount(of, weights=copies[here])[of]
            twice[here, o] = times > 1
            # at the edges: windows found once, and one of each kind found more often
            first = np.zeros(len(here), bool)
            first[one] = True
            seen = here[edge[here] & first]
            if len(seen):
                window = _padded(np.concatenate([left[seen, :o][:, ::-1], right[seen, : length - o]], axis=1))
                edges.append((o, seen, _row_hash(window, 2), _row_hash(window, 3)))
        # runs of repeated offsets become runs of window starts
        padded = np.zeros((n, half + 3), np.int8)
        padded[:, 1:-1] = twice
        turn = np.diff(padded, axis=1)
        r, begin = np.nonzero(turn == 1)
        _, end = np.nonzero(turn == -1)
        if len(r):
            times = copies[r]
            inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            parts = named[np.repeat(begins[r], times) + inner]
            yield answer(
                [
                    parts[:, 0],
                    parts[:, 1],
                    parts[:, 2] - np.repeat(end, times) + 1,
                    parts[:, 2] - np.repeat(begin, times) + length,
                    np.full(len(parts), None),
                    np.full(len(parts), None),
                ]
            )
        for o, seen, f1, f2 in edges:
            own = named[begins[seen]]
            start = own[:, 2] - o
            yield answer([own[:, 0], own[:, 1], start, start + length, f1.view(np.int64), f2.view(np.int64)])

    return run


def _removed(text: int):
    """Spans and remaining bytes; ``text`` is the place of the text in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).field(text).cast(pa.binary()).to_pylist()]
            spans, kept = [], []
            for own, ranges, whole in zip(texts, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                merged = [[0, len(own)]] if whole else []
                for r in sorted(ranges or (), key=lambda r: r["start"]):
                    if merged and r["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r["stop"])
                    else:
                        merged.append([r["start"], r["stop"]])
                spans.append([{"start": a, "stop": b} for a, b in merged])
                ends = [0, *(x for s in merged for x in s), len(own)]
                kept.append(b"".join(own[a:b] for a, b in zip(ends[::2], ends[1::2])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(spans, SPANS),
                    pa.array(kept, pa.binary()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ],
                names=["row", "n_bytes", "spans", "kept", "kept_sha256"],
            )

    return run


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
FOUND = "h1 long, h2 long, start long, stop long, f1 long, f2 long"
RANGES = "array<struct<start:bigint,stop:bigint>>"


def repeated_ranges(texts: DataFrame, length: int = 200) -> DataFrame:
    """h1, h2, start, stop: byte ranges that windows of ``length`` bytes found elsewhere cover.

    ``texts`` holds h1, h2 and _text, every text about once: of a text's copies one row is
    enough, as their windows all repeat anyway.
    """
    narrow = texts.mapInArrow(_prefixes(length), "h1 long, h2 long, at long, prefix long")
    counted = narrow.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1")
    again = written(counted, "prefixes")
    kinds, rows = again.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    again = again.select("prefix")
    whole = "prefix long, right binary, left binary, low int, high int, members binary"
    if kinds <= FEW:
        asked = texts.withColumn("_at", F.lit(None).cast("array<long>"))
        found = asked.mapInArrow(_suffixes(length), whole).join(F.broadcast(again), "prefix", "left_semi")
    else:
        places = narrow.join(again, "prefix", "left_semi").groupBy("h1", "h2").agg(F.collect_set("at").alias("_at"))
        found = texts.join(places, ["h1", "h2"]).mapInArrow(_suffixes(length), whole)
    dealt = found.repartitionByRange(max(1, -(-rows // BUCKET)), "right", "left", "members")
    out = written(dealt.mapInArrow(_bucket(length), FOUND), "ranges")
    edge = out.where("f1 IS NOT NULL")
    across = edge.groupBy("f1", "f2").count().where("count > 1").select("f1", "f2")
    inside = out.where("f1 IS NULL").select("h1", "h2", "start", "stop")
    return inside.union(edge.join(across, ["f1", "f2"], "left_semi").select("h1", "h2", "start", "stop"))


def without_repeats(docs: DataFrame, length: int = 200, text: str = "text") -> DataFrame:
    """row (all columns of ``docs`` as a struct), n_bytes, spans (start and stop in bytes of
    the removed runs, in order), kept (the remaining bytes; a cut may part a character) and
    kept_sha256, for every row of ``docs``.

    A null text counts as empty; texts shorter than ``length`` bytes keep all of theirs.
    Rows with equal texts, also repeated rows, all lose the whole text if it is long
    enough: no copy is spared. Ids may be null or repeat; they only choose which of some
    equal texts is sorted. An empty table gives an empty one.
    """
    if length < 40 or length % 8:
        raise ValueError("length must be a multiple of 8, 40 at least")
    keyed = docs.select(F.struct("*").alias("row"))
    own = text_or_empty(F.col(f"row.`{text}`"))
    h1, h2 = digest(own)
    one = F.col("row.doc_id") if "doc_id" in docs.columns else F.lit(0)
    keyed = keyed.select("row", h1.alias("h1"), h2.alias("h2"), one.alias("id"))
    copies = written(
        keyed.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("id").alias("one")).where("n > 1"), "copies"
    ).select("h1", "h2", "one", F.lit(True).alias("many"))
    marked = keyed.join(few(copies, FEW_TEXTS), ["h1", "h2"], "left")
    once = marked.where("many IS NULL")
    texts = once.union(marked.where("many AND one <=> id")).select("h1", "h2", own.alias("_text"))
    ranges = repeated_ranges(texts, length).groupBy("h1", "h2")
    ranges = written(ranges.agg(F.collect_list(F.struct("start", "stop")).alias("found")), "found")
    parts = once.join(ranges, ["h1", "h2"], "left").select("row", "found", F.lit(False).alias("whole"))
    whole = (F.octet_length(own) >= length).alias("whole")
    parts = parts.union(marked.where("many").select("row", F.lit(None).cast(RANGES).alias("found"), whole))
    schema = T.StructType([parts.schema["row"], T.StructField("n_bytes", T.LongType())])
    schema = schema.add("spans", parts.schema["found"].dataType).add("kept", "binary").add("kept_sha256", "string")
    return parts.mapInArrow(_removed(docs.columns.index(text)), schema)
