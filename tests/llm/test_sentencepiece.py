import random

import edge
import numpy as np
import pytest
import sentencepiece
from tideline.llm import sentencepiece_codec as S


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=S.public_model())


@pytest.fixture(scope="module")
def vocab():
    return S.load_vocabulary(S.public_model())


def encode(encoder, batch):
    ids, n = encoder.encode(batch)
    ends = np.r_[0, np.cumsum(n)]
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]


def odd_texts():
    rng = random.Random(1)
    odd = ["", " ", "  a  b\n\nc ", "日本語 テスト", "a▁b\t\x00x", "x" * 3000, "abc" * 700 + "é" * 50, "\n\n\n", "   ", "a" * 401 + " b", "𝔘𝔫𝔦 code ✓✓", "-" * 40]
    return odd + ["".join(rng.choice("abc  \néß日,.the") for _ in range(rng.randint(0, 60))) for _ in range(1500)]


def test_same_ids_as_the_library(library, vocab, monkeypatch):
    monkeypatch.setattr(S, "MAX_CHUNKS", 500)
    monkeypatch.setattr(S, "INDEX_BYTES", 3000)
    encoder, batch = S.Encoder(vocab), odd_texts()
    for i in range(0, len(batch), 300):
        part = batch[i:i + 300]
        assert encode(encoder, part) == [library.encode(t) for t in part]
    for t in batch:
        assert S.decode(library.encode(t), vocab.pieces) == t.replace(S.SPACE, " ")


def test_unigram_is_the_best_path(vocab):
    rng = random.Random(2)
    pieces = [S.SPACE.encode()] + [x.encode() for x in ("a", "b", "c", "ab", "bc", "abc", "ca", S.SPACE + "a", S.SPACE + "ab", "bca", "aaaa")]
    model = S.Vocabulary([b"?"] + pieces, [0.0] + [-rng.uniform(1, 9) for _ in pieces], list(range(1, len(pieces) + 1)), [], 0, False)
    worst = min(model.scores[1:]) - 10
    encoder = S.Encoder(model)

    def best(chunk):
        raw = chunk.replace(" ", S.SPACE)
        top = [0.0] + [-1e9] * len(raw)
        for j in range(1, len(raw) + 1):
            for i in range(j):
                sub = raw[i:j].encode()
                if sub in pieces:
                    top[j] = max(top[j], top[i] + model.scores[1 + pieces.index(sub)])
                elif j == i + 1:
                    top[j] = max(top[j], top[i] + worst)
        return top[-1]

    batch = ["".join(rng.choice("abc x") for _ in range(rng.randint(1, 25))) for _ in range(200)]
    for t, ids in zip(batch, encode(encoder, batch)):
        score = sum(model.scores[i] if i else worst for i in ids)
        assert abs(score - sum(best(c) for c in S.CHUNK.findall(" " + t))) < 1e-9, t


def test_edges(spark, library):
    docs = edge.documents(spark)
    out = S.encode_documents(docs, S.public_model(), check=True)
    rows = out.collect()
    assert len(rows) == len(edge.ROWS) and all(r.round_trip for r in rows)
    assert all(r.ids == library.encode(r.text or "") and r.n_ids == len(r.ids) for r in rows)
    assert [c for c in out.columns if c not in ("ids", "n_ids", "round_trip")] == [c for c in docs.columns if c != "ids"]
    back = S.decode_documents(out.select("ids", out["text"].alias("was")), S.public_model()).collect()
    assert all(r.text == (r.was or "") for r in back)
    assert S.encode_documents(edge.empty(spark), S.public_model()).count() == 0
