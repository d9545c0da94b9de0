import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lexikin.llm.token_files import Encoder, read_token_files, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_segments_give_the_library_s_ids():
    random.seed(8)
    signs = [*"ab1 \n\t.,'’é  \x1c\x85 日st😀", "  ", "'s", "<|endoftext|>", " \n", "'ll"]
    texts = ["".join(random.choices(signs, k=random.randrange(30))) for _ in range(4000)]
    own, plain = Encoder(PATH, "<u4"), Tokenizer.from_file(PATH)
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == want


def test_files_read_back(docs_of, odd_rows, spark):
    plain = Tokenizer.from_file(PATH)
    rows = [r for r in odd_rows if r[1] != "alone and without a name"]  # leaves one null id
    for vocabulary in (50_257, 100_000):
        folder = write_token_files(docs_of(rows), PATH, vocabulary=vocabulary)
        got = read_token_files(spark, folder).collect()
        start, want = 0, []
        for i, text in sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
            ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
            want.append((i, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
            start += len(ids)
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    # the files as another reader would take them
    place = folder.removeprefix("file://")
    ids = np.memmap(f"{place}/ids-00000.bin", "<u4", "r")
    ends = np.fromfile(f"{place}/offsets-00000.bin", "<i8")
    assert ends[0] == 0 and ends[-1] == len(ids) and (np.diff(ends) >= 1).all()


def test_no_documents(docs_of, odd_rows, spark):
    folder = write_token_files(docs_of(odd_rows).limit(0), PATH)
    assert read_token_files(spark, folder).count() == 0
