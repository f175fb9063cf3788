import random
import struct

import public_tokenizers
import pyarrow as pa
import pytest

from lodestrata.llm import sentencepiece_codec as codec

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


def odd_texts():
    r = random.Random(2)
    fixed = ["", " ", "  ", "   a  b ", "\n\n x", "\t", "<s> </s> <unk> <0x41>", "▁▁a▁b", "日本語のテスト", "emoji 😀😀", "\x00\x01", "é" * 50, " lead", "trail  ", "a" * 500]
    return fixed + ["".join(r.choice("ab ▁\n é日😀<>s/") for _ in range(r.randint(0, 40))) for _ in range(300)] + ["word " * 2000 + "end"] * 2


def test_parity_with_the_format_library():
    reference = codec._reference(MODEL)
    for texts in (odd_texts(), [], [""], ["plain words, only", "and more words"]):
        ids, trips, agrees = codec._encoded(MODEL, pa.array(texts, pa.string()), 1, True)
        assert ids.to_pylist() == reference.encode(texts)
        assert agrees.all()
        assert trips.tolist() == [a == b for a, b in zip(reference.decode(ids.to_pylist()), texts)]


def field(number, value):
    if isinstance(value, int):
        return bytes([number << 3, value])
    return bytes([number << 3 | 2, len(value)]) + value


def test_unigram_model_from_its_scores():
    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("ab", -4.0, 1), ("▁a", -3.5, 1)]
    body = b"".join(field(1, field(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s) + field(3, k)) for p, s, k in pieces)
    model = body + field(2, field(3, 1)) + field(3, field(3, 1) + field(4, 0))
    tokenizer = codec.build_tokenizer(model)
    assert tokenizer.encode("ab b", add_special_tokens=False).tokens == ["▁", "ab", "▁", "b"]
    assert tokenizer.decode(tokenizer.encode("ab b", add_special_tokens=False).ids) == "ab b"


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        codec.build_tokenizer(field(1, field(1, b"<unk>") + field(3, 2)) + field(2, field(3, 4)))


def test_rows(spark):
    texts = odd_texts()[:20] + [None]
    rows = spark.createDataFrame([(i, t, 5, True) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, _text boolean").repartition(3)
    got = codec.encode_texts(rows, MODEL)
    assert got.columns == ["doc_id", "_text", "n_tokens", "token_ids", "round_trip", "parity"]
    found = {r["doc_id"]: r for r in got.collect()}
    assert all(found[i]["token_ids"] == codec._reference(MODEL).encode(t or "") and found[i]["n_tokens"] == len(found[i]["token_ids"]) for i, t in enumerate(texts))
    back = {r["doc_id"]: r["text"] for r in codec.decode_ids(got, MODEL).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts) if found[i]["round_trip"])
    assert codec.encode_texts(rows.limit(0), MODEL).count() == 0
