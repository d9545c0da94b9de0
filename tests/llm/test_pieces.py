import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as schema

from lexikin.llm.pieces import PieceModel, decoded, encoded

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts():
    random.seed(3)
    signs = [*"etaoinshr .,\n\té日😀▁", "  ", "the", "ing", " and"]
    made = ["".join(random.choices(signs, k=random.randrange(40))) for _ in range(1500)]
    return made + ["", " ", "   x", "x" * 6000, "▁", "<s> </s> <0x0A>", "a\x00b", "ab" * 3000 + " z"]


def test_bpe_ids_are_the_library_s(texts):
    own, plain = PieceModel(open(PATH, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = own.encode(texts)
    assert [g.tolist() for g in got] == plain.encode(texts)
    assert [own.decode(g) for g in got] == [t.replace("▁", " ") for t in texts]


def test_unigram_cuts_score_as_the_library_s(texts):
    model = schema.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.trainer_spec.model_type = schema.TrainerSpec.UNIGRAM
    random.seed(5)
    for piece in model.pieces:
        if piece.type == 1:
            piece.score = -6 - 9 * random.random()
    data = model.SerializeToString()
    own, plain = PieceModel(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    some = [t for t in texts if len(t) < 1000 and "▁" not in t]
    score = lambda ids: sum(own.scores[i] for i in ids)
    for g, w in zip(own.encode(some), plain.encode(some), strict=True):
        assert score(g.tolist()) == pytest.approx(score(w), abs=1e-3)


def test_tables(docs_of, odd_rows):
    plain = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = docs_of(odd_rows)
    ids = encoded(docs, PATH)
    assert ids.columns == [*docs.columns, "ids"]
    back = decoded(ids, PATH, name="back").collect()
    assert len(back) == len(odd_rows)
    for r in back:
        assert r.ids == plain.encode(r.text or "") and r.back == (r.text or "")
    assert encoded(docs.limit(0), PATH).count() == 0
