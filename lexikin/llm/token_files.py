"""Token ids in flat binary files with document offsets."""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexikin.llm.common import new_folder

#: Fixed value: the white space of the tokenizer's pattern.
WIDE = (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SPACE = r"\t-\r \x85\xa0" + "".join(map(chr, WIDE))
UNEVEN = re.compile(f"[{SPACE}][{SPACE}]|[{SPACE}]$")
SEGMENT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
CACHED = 1 << 20


def _byte_letters() -> dict[int, int]:
    """The letters that stand for bytes in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for letters from 256 on.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


class Known(dict):
    """Ids of words met lately; a new word is looked up on first use."""

    def __init__(self, ids_of):
        self.ids_of = ids_of

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.ids_of(word)
        return ids


class Encoder:
    """Library encodings of texts, one library call per new word.

    The pattern of a byte-level tokenizer never matches across the start of a
    white-space run, so a text may be cut there and the ids of the parts joined. A run of
    letters with ASCII punctuation after it is cut between the two as well; then the
    library's model is called without its splitting. All else, and all of a tokenizer
    that isn't byte-level, goes through the whole library; a text that names an added
    token does so in one piece.
    """

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.code = np.dtype(dtype).char
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        before = made["pre_tokenizer"] or {}
        self.by_space = before.get("type") == "ByteLevel" and not before["add_prefix_space"] and not made["normalizer"]
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        #: ids of parts as they are, of words that a space goes before, of punctuation
        self.plain = Known(lambda part: self._whole([part])[0])
        self.spaced = Known(self._spaced)
        self.marks = Known(lambda mark: self._whole([mark])[0])
        self.marks[""] = b""
        self.line_end = self.marks["\n"]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _word(self, space: str, word: str) -> bytes | None:
        """The ids of letters with punctuation after them, or None for other words."""
        core = word.rstrip(string.punctuation)
        if not core.isalpha():
            return None
        mark = word[len(core) :]
        if not core.isascii():
            core = core.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(space + core)]).tobytes() + self.marks[mark]

    def _spaced(self, word: str) -> bytes:
        """The ids of a space and a word, which may hold single line ends."""
        if "\n" not in word:
            ids = self._word("Ġ", word)
            return self._whole([" " + word])[0] if ids is None else ids
        first, *more = word.split("\n")
        found = [self._word("Ġ", first), *(self._word("", w) for w in more)]
        return self._whole([" " + word])[0] if None in found else self.line_end.join(found)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.plain) + len(self.spaced) > CACHED:
            self.plain.clear()
            self.spaced.clear()
        plain, spaced, out = self.plain.__getitem__, self.spaced.__getitem__, []
        for text in texts:
            if not self.by_space or any(a in text for a in self.added):
                out.append(self._whole([text])[0])
            elif UNEVEN.search(text):
                out.append(b"".join(map(plain, SEGMENT.findall(text))))
            else:
                first, *words = text.split(" ")
                out.append(plain(first) + b"".join(map(spaced, words)))
        return out


@lru_cache(maxsize=2)
def _encoder(path: str, dtype: str) -> Encoder:
    """The encoder of a file, made once in a worker process; it keeps the words met."""
    return Encoder(path, dtype)


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    url = urlparse(folder)
    if url.scheme in ("", "file"):
        return fs.LocalFileSystem(), url.path
    return fs.FileSystem.from_uri(folder)


def _put(store: fs.FileSystem, path: str, parts: Iterator[bytes], attempt: int) -> None:
    """Write a file under the attempt's name, then give it its own name."""
    with store.open_output_stream(f"{path}.{attempt}") as out:
        for part in parts:
            out.write(part)
    store.move(f"{path}.{attempt}", path)


def _get(store: fs.FileSystem, path: str, dtype: np.dtype) -> np.ndarray:
    """The file as an array: memory-mapped where it is local, else read."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    with store.open_input_stream(path) as source:
        return np.frombuffer(source.read(), dtype)


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 0,
    vocabulary: int = 50_257,
    folder: str | None = None,
) -> str:
    """Encode all texts into a folder of flat files; returns the folder.

    Part ``k`` holds the documents of the k-th range of ids, in ascending order of id
    (null ids first, equal ids by a hash of the text): ``ids-k.bin`` has their token ids one after
    the other, as little-endian unsigned integers of 16 bits if the vocabulary fits,
    else 32; ``offsets-k.bin`` has the 64-bit start of each document in the part and
    the part's end; ``docs-k.bin`` the 64-bit document ids and ``nulls-k.bin`` a byte
    per document that is 1 for a null id. ``index.json`` has the type and, for each
    part, its documents, tokens and base: the tokens of all parts before it.

    Null and empty texts give the end id alone. An empty table gives no parts. A task
    that runs again writes the same bytes under a name of its own and renames them.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token_files")
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    end = b"" if end_id is None else np.asarray([end_id], dtype).tobytes()
    store, path = _place(folder)
    store.create_dir(path, recursive=True)
    width = np.dtype(dtype).itemsize

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        where, base = _place(folder)
        encoder, sizes, ids, nulls = _encoder(tokenizer, dtype), [], [], []

        def encoded() -> Iterator[bytes]:
            for batch in batches:
                names, texts = batch.column(0), batch.column(1).to_pylist()
                ids.append(np.asarray(names.fill_null(0), "<i8"))
                nulls.append(np.asarray(names.is_null(), np.uint8))
                for at in range(0, len(texts), 256):
                    for code in encoder.encode(texts[at : at + 256]):
                        sizes.append((len(code) + len(end)) // width)
                        yield code + end

        _put(where, f"{base}/ids-{part:05d}.bin", encoded(), attempt)
        ends = np.cumsum(np.asarray([0, *sizes], "<i8"))
        rest = {"offsets": ends, "docs": np.concatenate([[], *ids]).astype("<i8"), "nulls": np.concatenate([[], *nulls]).astype(np.uint8)}
        for name, values in rest.items():
            _put(where, f"{base}/{name}-{part:05d}.bin", iter([values.tobytes()]), attempt)
        if sizes:
            yield pa.RecordBatch.from_pydict({"part": [part], "docs": [len(sizes)], "tokens": [int(ends[-1])]})

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    # ranges and their samples are of ids and hashes, not of texts
    ranges = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange("doc_id", "hash")
    parts = (
        ranges.sortWithinPartitions("doc_id", "hash", "text")
        .select("doc_id", "text")
        .mapInArrow(write, "part long, docs long, tokens long")
        .collect()
    )
    index, total = [], 0
    for row in sorted(parts, key=lambda r: r["part"]):
        index.append({**row.asDict(), "base": total})
        total += row["tokens"]
    with store.open_output_stream(f"{path}/index.json") as out:
        out.write(json.dumps({"dtype": dtype, "tokens": total, "parts": index}).encode())
    return folder


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the folder's files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; the checksum covers the
    document's ids as little-endian unsigned 32-bit integers. One task reads a part.
    """
    store, path = _place(folder)
    with store.open_input_stream(f"{path}/index.json") as source:
        index = json.loads(source.read())
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not index["parts"]:
        return spark.createDataFrame([], schema)
    dtype = np.dtype(index["dtype"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, at = _place(folder)
        for batch in batches:
            for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                name = f"-{part:05d}.bin"
                ids, offsets = _get(where, f"{at}/ids{name}", dtype), _get(where, f"{at}/offsets{name}", np.dtype("<i8"))
                docs, nulls = _get(where, f"{at}/docs{name}", np.dtype("<i8")), _get(where, f"{at}/nulls{name}", np.dtype("u1"))
                for lo in range(0, len(docs), 4096):
                    hi = min(lo + 4096, len(docs))
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.asarray(docs[lo:hi]), mask=np.asarray(nulls[lo:hi], bool)),
                            pa.array(base + np.asarray(offsets[lo:hi])),
                            pa.array(np.diff(offsets[lo : hi + 1])),
                            pa.array(crc, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    table = spark.createDataFrame([(p["part"], p["base"]) for p in index["parts"]], "part long, base long")
    return table.repartition(len(index["parts"]), "part").mapInArrow(read, schema)
