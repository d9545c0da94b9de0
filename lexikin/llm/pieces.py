"""SentencePiece encoding and decoding by a Viterbi that advances many words at once."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: Fixed values of the model format: kinds of models and pieces, and the space mark.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
MARK = "▁"
UNKNOWN_PENALTY = 10.0
START = -1
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Slots of the filter of piece hashes and of the pairs met lately, words kept, and
#: characters that advance together.
SLOT_BITS, PAIR_BITS, CACHED, TOGETHER = 20, 21, 1 << 18, 1 << 16
TOGETHER_ROWS = 256
U = np.uint64


class PieceModel:
    """A SentencePiece model file of kind unigram or BPE with the identity normaliser."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2 as schema

        model = schema.ModelProto()
        model.ParseFromString(data)
        self.kind = model.trainer_spec.model_type
        norm = model.normalizer_spec
        if self.kind not in (UNIGRAM, BPE) or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only unigram and BPE models that leave the text as it is")
        if any(p.type == USER for p in model.pieces):
            raise ValueError("models with user-defined pieces are not read")
        self.prefix = norm.add_dummy_prefix
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.piece_ids: dict[str, int] = {}
        self.scores = np.zeros(len(model.pieces))
        for i, p in enumerate(model.pieces):
            self.scores[i] = p.score
            self.bytes_of.append(p.piece.encode() if p.type == NORMAL else b"")
            if p.type == NORMAL:
                self.piece_ids[p.piece] = i
            elif p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
        if not model.trainer_spec.byte_fallback:
            self.byte_ids = {}
            self.bytes_of[self.unknown] = " ⁇ ".encode()
        self.piece_of = {i: p for p, i in self.piece_ids.items()}
        self.longest = max(map(len, self.piece_ids))
        self.crossing = any(MARK in p.lstrip(MARK) for p in self.piece_ids)
        self.worst = min((self.scores[i] for i in self.piece_ids.values()), default=0.0) - UNKNOWN_PENALTY
        self.ready = False
        #: ids of parts as they are, and of words that a mark goes before
        self.words: dict[str, bytes] = {}
        self.marked: dict[str, bytes] = {}

    def _keys(self) -> None:
        """Sorted hashes of the pieces, with their ids and letters to check a match.

        Made on the first encoding, as decoding needs none of it.
        """
        self.ready = True
        self.slot_key = np.full(1 << PAIR_BITS, -1, np.int64)
        self.slot_ok = np.zeros(1 << PAIR_BITS, bool)
        texts = list(self.piece_ids)
        letters = np.zeros((len(texts), self.longest), np.uint32)
        for row, text in enumerate(texts):
            letters[row, : len(text)] = [ord(c) for c in text]
        lengths = np.array([len(t) for t in texts])
        keys = np.zeros(len(texts), U)
        for j in range(self.longest):
            more = j < lengths
            keys[more] = keys[more] * BASE + letters[more, j].astype(U) + U(1)
        order = np.argsort(keys)
        self.keys = keys[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces with one hash")
        self.key_ids = np.array(list(self.piece_ids.values()))[order]
        self.key_letters, self.key_lengths = letters[order], lengths[order]
        self.maybe = np.zeros(1 << SLOT_BITS, bool)
        self.maybe[self.keys >> U(64 - SLOT_BITS)] = True
        self.powers = np.cumprod(np.full(self.longest, BASE))
        self.powers = np.concatenate([[U(1)], self.powers])
        if self.kind == BPE:
            self._merges()

    def _found(self, key: np.ndarray) -> np.ndarray:
        """The place of each hash among the sorted keys, or -1."""
        out = np.full(key.shape, -1, np.int64)
        at = np.nonzero(self.maybe[key >> U(64 - SLOT_BITS)])
        some = key[at]
        place = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        out[at] = np.where(self.keys[place] == some, place, -1)
        return out

    def _sums(self, letters: np.ndarray) -> np.ndarray:
        """Hashes of all beginnings of each row of letters."""
        sums = np.zeros((letters.shape[0], letters.shape[1] + 1), U)
        for i in range(letters.shape[1]):
            sums[:, i + 1] = sums[:, i] * BASE + letters[:, i] + U(1)
        return sums

    def _merged(self, text: str) -> list[str]:
        """A short text by merging the best-scored neighbours, the leftmost first."""
        parts = list(text)
        while True:
            best, at = -np.inf, -1
            for i in range(len(parts) - 1):
                found = self.piece_ids.get(parts[i] + parts[i + 1])
                if found is not None and self.scores[found] > best:
                    best, at = self.scores[found], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _merges(self) -> None:
        """Pieces by the order in which BPE makes them, and the two parts of each.

        ``made[p]`` is the rank of the merge that makes piece p (letters are made before
        all merges), ``inner[p]`` its parts. Merges of one score (runs of marks) go by
        place, not by rank; pieces that hold such a piece are ``slow``.
        """
        texts, ids = list(self.piece_ids), np.array(list(self.piece_ids.values()))
        order = np.argsort(-self.scores[ids], kind="stable")
        self.made = np.full(len(self.scores), -1, np.int64)
        self.made[ids[order]] = np.arange(len(ids))
        letters = [i for t, i in self.piece_ids.items() if len(t) == 1]
        self.made[letters] = -1
        times = Counter(self.scores[i] for t, i in self.piece_ids.items() if len(t) > 1)
        tied = [t for t, i in self.piece_ids.items() if len(t) > 1 and times[self.scores[i]] > 1]
        self.slow = np.zeros(len(self.scores), bool)
        if not set("".join(texts)) <= set(self.piece_ids):
            tied = texts  # a letter that isn't a piece has no rank
        if tied:
            some = re.compile("|".join(map(re.escape, sorted(tied, key=len))))
            self.slow[[i for t, i in self.piece_ids.items() if some.search(t)]] = True
        width = np.int64(len(self.scores))
        pairs = [
            (self.piece_ids[t[:k]] * width + self.piece_ids[t[k:]], i)
            for t, i in self.piece_ids.items()
            for k in range(1, len(t))
            if t[:k] in self.piece_ids and t[k:] in self.piece_ids
        ]
        pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.pair_keys, self.pair_made = pairs[:, 0].copy(), self.made[pairs[:, 1]]
        # a piece's last merge joins the one split whose halves BPE makes and leaves apart
        self.inner = np.full((len(self.scores), 2), -1, np.int64)
        self.formed = np.zeros(len(self.scores), bool)
        self.formed[letters] = True
        for i in np.nonzero(self.slow)[0].tolist():
            self.formed[i] = self._merged(self.piece_of[i]) == [self.piece_of[i]]
        by_length = defaultdict(list)
        for key, i in pairs.tolist():
            by_length[len(self.piece_of[i])].append((i, *divmod(key, width)))
        for _, some in sorted(by_length.items()):
            piece, left, right = np.array(some, np.int64).T
            good = self.formed[left] & self.formed[right] & ~self.slow[piece]
            good &= (self.made[left] < self.made[piece]) & (self.made[right] < self.made[piece])
            piece, left, right = piece[good], left[good], right[good]
            good = self._stay_apart(left, right, self.made[piece])
            self.inner[piece[good]] = np.stack([left[good], right[good]], axis=1)
            self.formed[piece[good]] = True

    def _stay_apart(self, left: np.ndarray, right: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether BPE leaves the two pieces of each pair side by side.

        Goes back in time along the cut: the pieces beside it come apart, the one made
        last first, and at no time may the two then beside it have joined sooner than
        either became part of its next larger piece. ``until`` is the time at which the
        two do join, for those that make a piece.
        """
        good = np.ones(len(left), bool)
        at, a, b = np.arange(len(left)), left, right
        limit = np.full(len(left), len(self.scores), np.int64) if until is None else until
        width = np.int64(len(self.scores))
        while len(at):
            key = a * width + b
            place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            joins = (self.pair_keys[place] == key) & (self.pair_made[place] < limit)
            good[at[joins]] = False
            made_a, made_b = self.made[a], self.made[b]
            more = ~joins & ((made_a >= 0) | (made_b >= 0))
            at, a, b, made_a, made_b = at[more], a[more], b[more], made_a[more], made_b[more]
            # of equal merges the left one is made first
            first = made_a > made_b
            limit = np.where(first, made_a, made_b + 1)
            a, b = np.where(first, self.inner[a, 1], a), np.where(first, b, self.inner[b, 0])
        return good

    def _may_follow(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether BPE leaves a piece beside the one before it (negative: none).

        A cut of a text is its BPE encoding if and only if that holds for each pair of
        neighbours, so each prefix has one piece at most that can end it. What was found
        lately is kept by slots.
        """
        key = (np.where(before < 0, len(self.scores), before) << 32) | piece
        slot = (key.view(U) * BASE >> U(64 - PAIR_BITS)).astype(np.int64)
        new = self.slot_key[slot] != key
        out = self.slot_ok[slot]
        if new.any():
            few, where = np.unique(key[new], return_inverse=True)
            first, second = few >> 32, few & 0xFFFFFFFF
            found, inner = self.formed[second], first < len(self.scores)
            slow = inner & self.slow[second]
            slow[inner] |= self.slow[first[inner]]
            fast = inner & ~slow
            found[fast] &= self._stay_apart(first[fast], second[fast])
            for i in np.nonzero(slow)[0].tolist():
                both = [self.piece_of[int(first[i])], self.piece_of[int(second[i])]]
                found[i] = self._merged("".join(both)) == both
            out[new] = found[where]
            self.slot_key[slot[new]] = key[new]
            # where two keys share a slot, one of them is kept, with its own answer
            kept = self.slot_key[slot[new]] == key[new]
            self.slot_ok[slot[new][kept]] = out[new][kept]
        return out

    def _pieces_in(self, letters: np.ndarray) -> np.ndarray:
        """found[size - 1, word, end]: the piece of ``size`` letters before ``end``, or -1."""
        n, length = letters.shape
        span = min(self.longest, length)
        sums = self._sums(letters)
        found = np.full((span, n, length + 1), -1, np.int32)
        for size in range(1, span + 1):
            key = sums[:, size:] - sums[:, : length + 1 - size] * self.powers[size]
            place = self._found(key)
            row, begin = np.nonzero((place >= 0) & (self.key_lengths[place] == size))
            place = place[row, begin]
            same = np.ones(len(row), bool)
            for j in range(size):
                same &= self.key_letters[place, j] == letters[row, begin + j]
            found[size - 1, row[same], begin[same] + size] = self.key_ids[place[same]]
        return found

    def _equal_length(self, words: list[str]) -> list[bytes]:
        """Ids of words of one length, all advancing by one character at a time."""
        n, length = len(words), len(words[0])
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, length)
        found = self._pieces_in(letters)
        value = np.zeros((n, length + 1))
        piece = np.full((n, length + 1), START, np.int64)
        back = np.zeros((n, length + 1), np.int64)
        every = np.arange(n)
        for end in range(1, length + 1):
            most = min(len(found), end)
            here = found[:most, :, end].T
            row, size = np.nonzero(here >= 0)
            ids, begin = here[row, size].astype(np.int64), end - 1 - size
            gain = np.full((n, most), -np.inf)
            if self.kind == BPE:
                ok = self._may_follow(piece[row, begin], ids)
                gain[row[ok], size[ok]] = 0
            else:
                gain[row, size] = value[row, begin] + self.scores[ids]
            # a character without a piece stands alone
            alone = here[:, 0] < 0
            gain[alone, 0] = 0 if self.kind == BPE else value[alone, end - 1] + self.worst
            choice = np.argmax(gain, axis=1)
            value[:, end] = gain[every, choice]
            piece[:, end] = here[every, choice]
            back[:, end] = end - 1 - choice
        ids = np.empty((n, length), "<i4")
        at, first = np.full(n, length), np.full(n, length)
        while (on := at > 0).any():
            first[on] -= 1
            ids[every[on], first[on]] = piece[every[on], at[on]]
            at[on] = back[every[on], at[on]]
        out = [ids[row, begin:].tobytes() for row, begin in enumerate(first.tolist())]
        for row in np.nonzero((ids < 0).any(axis=1) & (piece[:, 1:] < 0).any(axis=1))[0].tolist():
            spelled: list[int] = []
            end = length
            while end:
                begin = int(back[row, end])
                spelled.extend(reversed(self._spelled(words[row][begin:end], int(piece[row, end]))))
                end = begin
            out[row] = np.asarray(spelled[::-1], "<i4").tobytes()
        return out

    def _spelled(self, text: str, piece: int) -> list[int]:
        """The piece's id, or the byte pieces of a character that has none."""
        if piece >= 0:
            return [piece]
        return [self.byte_ids[b] for b in text.encode()] if self.byte_ids else [self.unknown]

    def _cut(self, text: str) -> list[str]:
        """Parts that no piece crosses, less the mark that each begins with.

        Each run of marks begins a part, and so does the text.
        """
        uneven = "  " in text or text[:1] == " " or text[-1:] == " "
        if self.crossing or not self.prefix or MARK in text or uneven:
            return []
        return text.split(" ") if text else []

    def _odd(self, text: str) -> list[str]:
        """Parts of any other text, with their marks."""
        marked = (MARK if self.prefix and text else "") + text.replace(" ", MARK)
        if self.crossing:
            return [marked] if marked else []
        return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", marked)

    def _ids_of(self, words: set[str]) -> dict[str, bytes]:
        """The ids of parts, as bytes."""
        out: dict[str, bytes] = {}
        by_length = defaultdict(list)
        for word in words:
            by_length[len(word)].append(word)
        for length, some in by_length.items():
            together = max(1, TOGETHER // length)
            for at in range(0, len(some), together):
                part = some[at : at + together]
                out.update(zip(part, self._equal_length(part), strict=True))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as 32-bit integers."""
        if not self.ready:
            self._keys()
        if len(self.words) + len(self.marked) > CACHED:
            self.words.clear()
            self.marked.clear()
        even = [self._cut(t) for t in texts]
        odd = [[] if e else self._odd(t) for e, t in zip(even, texts, strict=True)]
        known = self.marked
        new = {w for words in even for w in words if w not in known}
        self.words.update(self._ids_of({w for words in odd for w in words if w not in self.words}))
        found = self._ids_of({MARK + w for w in new})
        known.update((w, found[MARK + w]) for w in new)
        plain, marked = self.words.__getitem__, known.__getitem__
        return [
            np.frombuffer(b"".join(map(marked, e) if e else map(plain, o)), "<i4")
            for e, o in zip(even, odd, strict=True)
        ]

    def forget(self) -> None:
        """Drop the words met: an idle worker process keeps the model alone."""
        self.words, self.marked = {}, {}

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; ill-formed byte runs give replacement characters."""
        text = b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
        text = text.replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _loaded(docs: DataFrame, path: str):
    """A function that gives the task its model; the file's bytes are broadcast.

    A model file holds some MB at most, whatever the input is.
    """
    with open(path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    return lambda: _model(shared.value)


@lru_cache(maxsize=2)
def _model(data: bytes) -> PieceModel:
    """The model of a file, made once in a worker process."""
    return PieceModel(data)


def _with_column(df: DataFrame, source: str, name: str, kind: T.DataType, keep: list[str] | None, column_of):
    """``df`` with a column made from ``source``, TOGETHER_ROWS rows at a time.

    ``column_of`` gives a task its function, and one to call at the task's end.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() != name.lower()]
    # by place, so that no name meets another
    read = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate([*kept, source])))
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, forget = column_of()
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, TOGETHER_ROWS):
                    part = batch.slice(at, TOGETHER_ROWS)
                    columns = [part.column(i) for i in range(len(kept))]
                    yield pa.RecordBatch.from_arrays([*columns, made(part.column(len(kept)))], names=[*kept, name])
        finally:
            forget()

    return read.mapInArrow(run, schema)


def encoded(
    docs: DataFrame, path: str, text_col: str = "text", name: str = "ids", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with a column of the ids that the model at ``path`` gives each whole text.

    The ids are those of the SentencePiece library. A unigram model takes the cut with
    the best sum of scores. A BPE model takes the cut whose neighbours all stay apart
    under its merges, which is its encoding. Null and empty texts have no ids. ``keep``
    names the columns that stay, by default all; one named as the new one is replaced.
    """
    model = _loaded(docs, path)

    def column_of():
        known = model()

        def ids_of(texts: pa.Array) -> pa.Array:
            ids = known.encode([t or "" for t in texts.to_pylist()])
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, "<i4"), *ids])))

        return ids_of, known.forget

    return _with_column(docs, text_col, name, T.ArrayType(T.IntegerType()), keep, column_of)


def decoded(
    rows: DataFrame, path: str, ids_col: str = "ids", name: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``rows`` with the text of each list of ids; null counts as no ids.

    Decoding gives back the encoded text, but for a space in place of each literal
    space mark, as in the library. ``keep`` is as for ``encoded``.
    """
    model = _loaded(rows, path)

    def column_of():
        known = model()

        def texts_of(lists: pa.Array) -> pa.Array:
            parts = (lists[i].values for i in range(len(lists)))
            return pa.array([known.decode(np.asarray([] if p is None else p, np.int64)) for p in parts], pa.string())

        return texts_of, known.forget

    return _with_column(rows, ids_col, name, T.StringType(), keep, column_of)
