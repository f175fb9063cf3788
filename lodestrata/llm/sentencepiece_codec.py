"""SentencePiece encoding and decoding on the tokenizers library, rebuilt from the model file.

The model is a protocol buffer of pieces with scores and types, a trainer section and a normaliser
section. From these come the normaliser (character map, repeated blanks, dummy prefix, the metaspace
marker), the model (unigram scores, or byte-pair merges ranked by the score of the merged piece) and
byte fallback. Batches are encoded on several threads.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import release
from .wordhash import slices

MARK = "▁"
_LINE = 256
#: field numbers and codes of the public model format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    character_map: bytes = b""
    dummy_prefix: bool = True
    collapse_blanks: bool = True
    escape_blanks: bool = True


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        elif tag & 7 == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif tag & 7 in (1, 5):
            size = 8 if tag & 7 == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"unexpected wire type {tag & 7}")
        yield tag >> 3, value


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            model.pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
            model.kind, model.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
        elif number == 3:
            rules = dict(fields(value))
            model.character_map = rules.get(2, b"")
            model.dummy_prefix, model.collapse_blanks, model.escape_blanks = (bool(rules.get(k, 1)) for k in (3, 4, 5))
    return model


def merges_of(model: Model) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, best score of the joined piece first."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind == NORMAL}
    ranked = sorted(ids, key=lambda p: (-model.pieces[ids[p]][1], ids[p]))
    return [(p[:k], p[k:]) for p in ranked for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]


@lru_cache(maxsize=2)
def build_tokenizer(data: bytes):
    """A tokenizer that gives the ids the model gives."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    model = parse_model(data)
    if any(kind == USER_DEFINED for _, _, kind in model.pieces):
        raise ValueError("models with user-defined symbols are not supported")
    unknown = next(i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN)
    if model.kind == BPE:
        vocabulary = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocabulary, merges_of(model), unk_token=model.pieces[unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    elif model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback)
    else:
        raise ValueError("only unigram and byte-pair models are supported")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.character_map)] if model.character_map else []
    if model.collapse_blanks:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape_blanks else " "))
    if model.escape_blanks:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if model.kind == BPE and not any(MARK in p.lstrip(MARK) for p, _, kind in model.pieces if kind == NORMAL):
        # No piece has a marker after another character, so no merge crosses the front of a marker.
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    parts = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(parts + [decoders.Strip(" ", 1, 0)] * model.dummy_prefix)
    return tokenizer


@lru_cache(maxsize=2)
def _reference(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


def _threads(threads: int) -> None:
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))


@lru_cache(maxsize=2)
def _by_words(data: bytes) -> bool:
    """Whether a text's ids are those of its words, one after the other.

    They are if blanks are escaped and never dropped, each word gets a marker, and no piece has a
    marker after another character.
    """
    model = parse_model(data)
    plain = model.dummy_prefix and model.escape_blanks and not model.collapse_blanks and not model.character_map
    return plain and not any(MARK in p.lstrip(MARK) for p, _, kind in model.pieces if kind == NORMAL)


def _tokens(data: bytes, texts: list[str], threads: int, verify: bool) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
    """Of each text: its ids, whether they decode to it, and whether the reference library agrees."""
    tokenizer = build_tokenizer(data)
    found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    back = tokenizer.decode_batch(found, skip_special_tokens=False)
    same = [a == b for a, b in zip(found, _reference(data).encode(texts, num_threads=threads))] if verify else [True] * len(texts)
    return found, np.array([a == b for a, b in zip(texts, back)], bool), np.array(same, bool)


@lru_cache(maxsize=2)
def _opens(data: bytes) -> np.ndarray:
    """Of each id, whether its piece begins with the marker."""
    return np.array([p.startswith(MARK) for p, _, _ in parse_model(data).pieces])


def _word_tokens(data: bytes, words: list[str], threads: int, verify: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ids of all words, how many each has, and as in ``_tokens`` whether they return and agree.

    Words go in lines of many; a marker in front of a piece begins the next word.
    """
    lines = [" ".join(words[i : i + _LINE]) for i in range(0, len(words), _LINE)]
    ids, trips, agrees = _tokens(data, lines, threads, verify)
    flat, sizes, good, same = [], [], [], []
    for i, line in enumerate(ids):
        part, line = words[i * _LINE : (i + 1) * _LINE], np.array(line, np.int32)
        heads = np.flatnonzero(_opens(data)[line])
        if trips[i] and agrees[i] and heads.size == len(part):
            count, ok, eq = np.diff(np.r_[heads, line.size]), np.ones(len(part), bool), np.ones(len(part), bool)
        else:
            each, ok, eq = _tokens(data, part, threads, verify)
            count, line = np.array([len(x) for x in each]), np.array([x for y in each for x in y], np.int32)
        for out, x in zip((flat, sizes, good, same), (line, count, ok, eq)):
            out.append(x)
    return tuple(np.concatenate([np.empty(0, t), *x]).astype(t) for x, t in ((flat, np.int32), (sizes, np.int64), (good, bool), (same, bool)))


def _encoded(data: bytes, texts: pa.Array, threads: int, verify: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """As ``_tokens``, with each distinct word of the batch encoded once.

    Texts with a marker of their own, or with blanks side by side or at an end, go whole.
    """
    odd = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, MARK))
    odd = pc.or_(pc.or_(odd, pc.starts_with(texts, " ")), pc.or_(pc.ends_with(texts, " "), pc.equal(texts, "")))
    odd = odd.to_numpy(zero_copy_only=False).astype(bool) | (not _by_words(data))
    whole, split = np.flatnonzero(odd), np.flatnonzero(~odd)
    ids, trips, agrees = _tokens(data, texts.take(pa.array(whole)).to_pylist(), threads, verify)
    lists = pc.split_pattern(texts.take(pa.array(split)), " ")
    words = lists.flatten().dictionary_encode()
    flat, sizes, word_trips, word_agrees = _word_tokens(data, words.dictionary.to_pylist(), threads, verify)
    starts = np.cumsum(sizes) - sizes
    at = words.indices.to_numpy()
    ends = np.cumsum(sizes[at])
    values = flat[np.arange(ends[-1] if at.size else 0) + np.repeat(starts[at] - (ends - sizes[at]), sizes[at])]
    bounds = lists.offsets.to_numpy()
    bounds = bounds - bounds[0] if bounds.size else np.zeros(1, np.int32)
    spans = pa.ListArray.from_arrays(pa.array(np.r_[0, ends][bounds].astype(np.int32)), pa.array(values, pa.int32()))
    per_text = lambda marks: np.logical_and.reduceat(marks[at], bounds[:-1]) if split.size else np.empty(0, bool)
    order = pa.array(np.argsort(np.r_[whole, split]))
    both = pa.concat_arrays([pa.array(ids, pa.list_(pa.int32())), spans.cast(pa.list_(pa.int32()))]).take(order)
    order = order.to_numpy()
    return both, np.r_[trips, per_text(word_trips)][order], np.r_[agrees, per_text(word_agrees)][order]


def _encode(data: bytes, threads: int, verify: bool):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        for batch in batches:
            for part in slices(batch, "_text", size=4 << 20):
                ids, trips, agrees = _encoded(data, part["_text"].cast(pa.string()), threads, verify)
                same = pa.array(agrees) if verify else pa.nulls(part.num_rows, pa.bool_())
                names = [n for n in part.schema.names if n != "_text"]
                made = [pc.list_value_length(ids).cast(pa.int64()), ids, pa.array(trips), same]
                yield pa.RecordBatch.from_arrays([part[n] for n in names] + made, names=[*names, "n_tokens", "token_ids", "round_trip", "parity"])
        release()

    return step


def encode_texts(docs: DataFrame, model: bytes, text: str = "text", threads: int = 2, verify: bool = True) -> DataFrame:
    """Every row without its text, with ``n_tokens``, ``token_ids``, ``round_trip`` and ``parity``.

    ``round_trip`` says whether the ids decode to the text again; ``parity`` whether the library of
    the model's format gives the same ids (null unless ``verify``). Null texts are empty, empty
    texts have no ids, columns of the new names are replaced, an empty table gives no rows.
    """
    made = ["n_tokens", "token_ids", "round_trip", "parity"]
    carried = [c for c in docs.columns if c != text and c not in made]
    kinds = dict(docs.dtypes)
    inner = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(carried)], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = ", ".join([*(f"_{i} {kinds[c]}" for i, c in enumerate(carried)), "n_tokens long, token_ids array<int>, round_trip boolean, parity boolean"])
    out = inner.mapInArrow(_encode(model, threads, verify), schema)
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(carried)], *made)


def _decode(data: bytes, threads: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        tokenizer = build_tokenizer(data)
        for batch in batches:
            at = batch.schema.get_field_index("_ids")
            texts = tokenizer.decode_batch([x or [] for x in batch["_ids"].to_pylist()], skip_special_tokens=False)
            yield batch.set_column(at, "text", pa.array(texts, pa.string()))

    return step


def decode_ids(rows: DataFrame, model: bytes, ids: str = "token_ids", text: str = "text", threads: int = 2) -> DataFrame:
    """Every row with its ids turned into text; null ids give an empty text."""
    carried = [c for c in rows.columns if c not in (ids, text)]
    kinds = dict(rows.dtypes)
    inner = rows.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(carried)], F.col(ids).alias("_ids"))
    schema = ", ".join([*(f"_{i} {kinds[c]}" for i, c in enumerate(carried)), "text string"])
    return inner.mapInArrow(_decode(model, threads), schema).select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(carried)], F.col("text").alias(text))
