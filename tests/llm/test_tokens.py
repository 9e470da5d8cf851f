"""Token counts and ids against the library; round trips."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from runlens.llm.pieces import Vocabulary
from runlens.llm.sentencepiece_codec import Codec, codec, decoded, encoded
from runlens.llm.tables import read
from runlens.llm.token_counts import MODEL, token_counts, token_counts_of
from tests.conftest import SF001


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    fixed = ["", " ", "   ", "a" * 3000, "ab" * 600, " " * 70, "<s> </s> <unk> <0x0A>", "日本語テキスト 한국어", "\n\n \t", "😀 a", "=" * 200, "\x00a\x01", "ééé", "the▁end"]
    return fixed + ["".join(r.choice("ab  é\n日=▁0Zth") for _ in range(r.randint(1, 60))) for _ in range(800)]


def test_counts_are_the_librarys(library, texts):
    assert token_counts_of(texts).tolist() == [len(x) for x in library.encode(texts, num_threads=1)]


def test_ids_are_the_librarys(library, texts):
    ids, first = codec(MODEL).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == library.encode(texts, num_threads=1)


def test_unigram_vocabulary_takes_the_best_path(tmp_path, texts):
    model = proto.ModelProto()
    with open(public_tokenizers.path(MODEL), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        if p.type == 1:
            p.score = max(p.score, -40_000) / 1000 - 1
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    words = [w for x in texts for w in x.split() if "▁" not in w and len(w) < 40][:1500]
    score = lambda ids: sum(model.pieces[i].score for i in ids if model.pieces[i].type == 1)
    ids, first = Codec(Vocabulary(str(path)), None).encode(words)
    for i, want in enumerate(library.encode(words, num_threads=1)):
        got = ids[first[i] : first[i + 1]].tolist()
        assert got == want or abs(score(got) - score(want)) < 1e-3


def test_queries_on_whole_texts(spark, library):
    docs = read(spark, SF001, "documents")
    want = {r.doc_id: library.encode(r.text, num_threads=1) for r in docs.collect()}
    rows = encoded(docs)
    assert {r.doc_id: r.token_ids for r in rows.collect()} == want
    assert all(r.round_trip for r in rows.collect())
    counts = token_counts(docs, limit=500).collect()
    assert {r.doc_id: (r.n_tokens, r.over_limit) for r in counts} == {i: (len(x), len(x) > 500) for i, x in want.items()}
    assert {r.doc_id: r.text for r in decoded(rows).collect()} == {r.doc_id: r.text for r in docs.collect()}
