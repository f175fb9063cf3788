"""Removal of repeated byte strings, by a distributed difference-cover suffix sort of bounded depth.

A difference cover D modulo v holds, for any two positions i and j, a shift d < v that takes both
into D. So if ``length`` bytes at i and j are equal, the ``length - v + 1`` bytes at i + d and j + d
are equal too, and both of those suffixes are sampled. The steps are those of the difference-cover
construction:

1. Sampled tuples, the ``length - v + 1`` bytes at each sampled position, are named by a 64-bit
   fingerprint and sorted. The order of names is the order of suffixes; any total order will do,
   as only equal prefixes have to be neighbours. Names that occur once are settled and discarded.
   Order is needed to ``length`` bytes only, so naming is deep enough at once and the recursion
   on names ends at its first level.
2. The remaining suffixes, those which reach a sampled suffix with a repeated name within v - 1
   bytes, are merged: named by their first ``length`` bytes and sorted.
3. Adjacent equal prefixes are repeats.

Names travel as sorted blocks of a group of documents for a range of names; the answer is one bit
per name sent. Each block holds a name at most twice, which is what "repeated" needs, so a string
that fills a third of the corpus costs no more than two names per group. Whole texts are names
too: of equal texts one group sends its merged suffixes for all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .memory import release

# Perfect difference sets, period to residues.
DIFFERENCE_COVERS = {
    1: (0,),
    7: (1, 2, 4),
    13: (0, 1, 3, 9),
    31: (1, 5, 11, 24, 25, 27),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
}
_BLOCK = 1 << 16
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_FINISH = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)
_REQUEST = "bucket long, owner long, kind int, payload binary"
_ANSWER = "owner long, bucket long, kind int, payload binary"
_NAMES, _TEXTS, _FORWARD = 0, 1, 2


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves sampled tuples of at least half the length."""
    period = max(v for v in DIFFERENCE_COVERS if 2 * v <= length or v == 1)
    return period, DIFFERENCE_COVERS[period]


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left * _MULTIPLY
    out += right
    out ^= out >> _SHIFT
    out *= _FINISH
    out ^= out >> _SHIFT
    return out


def window_names(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit name of the ``width`` bytes at each position of ``data`` that has so many."""
    count = data.size - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    if width < 8:
        names, reach = data.astype(np.uint64) + np.uint64(1), 1
    else:
        names = np.ndarray(data.size - 7, "<u8", data.tobytes(), strides=(1,)).astype(np.uint64)
        names = _join(names, np.uint64(0))
        reach = 8
    while 2 * reach <= width:
        names = _join(names[: names.size - reach], names[reach:])
        reach *= 2
    return _join(names[:count], names[width - reach : width - reach + count])


class Texts:
    """The documents of one group in one buffer, so that array operations see many at a time."""

    def __init__(self, texts: pa.ChunkedArray, length: int):
        self.length, (self.period, residues) = length, cover_for(length)
        self.tuple_width = length - self.period + 1
        self.sampled = np.zeros(self.period, bool)
        self.sampled[list(residues)] = True
        texts = pa.concat_arrays(texts.cast(pa.large_binary()).chunks) if texts.num_chunks else pa.array([], pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
        whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8) if len(texts) else np.empty(0, np.uint8)
        self.data = whole[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.sizes = np.diff(self.offsets)
        self.starts = self.offsets[:-1]

    def blocks(self) -> Iterator[tuple[int, int]]:
        for start in range(0, self.data.size, _BLOCK):
            yield start, min(start + _BLOCK, self.data.size)

    def _room(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """For the positions of a block: place within the document, and bytes up to its end."""
        at = np.arange(start, stop)
        owner = np.searchsorted(self.offsets, at, "right") - 1
        return at - self.offsets[owner], self.offsets[owner + 1] - at

    def anchors(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sampled positions and the names of their tuples, by block."""
        for start, stop in self.blocks():
            place, room = self._room(start, stop)
            take = np.flatnonzero(self.sampled[place % self.period] & (room >= self.tuple_width))
            names = window_names(self.data[start : stop + self.tuple_width - 1], self.tuple_width)
            yield start + take, names[take]

    def reaching(self, anchors: np.ndarray) -> np.ndarray:
        """A mark for each position whose window holds one of the anchors within its first period."""
        marks = np.zeros(self.data.size + 1, np.int32)
        owner = np.searchsorted(self.offsets, anchors, "right") - 1
        np.add.at(marks, np.maximum(anchors - self.period + 1, self.offsets[owner]), 1)
        np.add.at(marks, anchors + 1, -1)
        return np.cumsum(marks[:-1]) > 0

    def windows(self, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Wanted positions with a whole window, and the names of those windows, by block."""
        for start, stop in self.blocks():
            if not wanted[start:stop].any():
                continue
            _, room = self._room(start, stop)
            take = np.flatnonzero(wanted[start:stop] & (room >= self.length))
            if take.size:
                names = window_names(self.data[start : stop + self.length - 1], self.length)
                yield start + take, names[take]

    def text_names(self) -> np.ndarray:
        """A name of each whole text, from its SHA-256."""
        return np.array([int.from_bytes(hashlib.sha256(self.data[a : a + n]).digest()[:8], "little") for a, n in zip(self.starts, self.sizes)], np.uint64)


def _at_most_twice(names: np.ndarray) -> np.ndarray:
    names = np.sort(names)
    if names.size > 2:
        names = names[np.r_[True, True, names[2:] != names[:-2]]]
    return names


def _pack(names: np.ndarray) -> bytes:
    """Sorted names as differences, byte plane by byte plane: the high planes are nearly all zero."""
    steps = np.diff(names, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(payload, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _cuts(names: np.ndarray, buckets: int) -> np.ndarray:
    """Where each range of names begins in the sorted names."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.r_[0, np.searchsorted(names, edges), names.size]


def _requests(owner: int, kind: int, names: np.ndarray, buckets: int) -> list[tuple]:
    cuts = _cuts(names, buckets)
    return [(b, owner, kind, _pack(names[i:j])) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]


def _table(rows: list[tuple], names: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [pa.field(n, kinds[k]) for n, k in (x.split() for x in names.split(", "))]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)], schema=pa.schema(fields))


def _repeated(table: pa.Table) -> pa.Table:
    """Which names of a range occur more than once; of texts, also which group holds them first."""
    rows = table.to_pylist()
    out = [(r["owner"], r["bucket"], r["kind"], r["payload"]) for r in rows if r["kind"] == _FORWARD]
    for kind in (_NAMES, _TEXTS):
        sent = sorted((r["owner"], r["bucket"], r["payload"]) for r in rows if r["kind"] == kind)
        if not sent:
            continue
        blocks = [_unpack(p) for _, _, p in sent]
        ordered = np.sort(np.concatenate(blocks))
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        led = np.zeros(twice.size, bool)
        for (owner, bucket, _), names in zip(sent, blocks):
            at = np.searchsorted(twice, names)
            hit = at < twice.size
            hit[hit] = twice[at[hit]] == names[hit]
            bits = hit if kind == _NAMES else np.r_[hit, np.zeros_like(hit)]
            if kind == _TEXTS:
                bits[hit.size :][hit] = led[at[hit]]
                led[at[hit]] = True
            out.append((owner, bucket, kind, np.packbits(bits).tobytes()))
    return _table(out, _ANSWER)


def _answers(answers: list[tuple], kind: int, names: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits for the sorted names that were sent: repeated, and held by an earlier group."""
    cuts = _cuts(names, buckets)
    bits, later = np.zeros(names.size, bool), np.zeros(names.size, bool)
    for bucket, k, payload in answers:
        if k == kind:
            i, j = cuts[bucket], cuts[bucket + 1]
            got = np.unpackbits(np.frombuffer(payload, np.uint8), count=(j - i) * (1 + (kind == _TEXTS))).astype(bool)
            bits[i:j] = got[: j - i]
            if kind == _TEXTS:
                later[i:j] = got[j - i :]
    return bits, later


def _member(names: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    if not chosen.size:
        return np.zeros(names.size, bool)
    at = np.minimum(np.searchsorted(chosen, names), chosen.size - 1)
    return chosen[at] == names


class _Group:
    """What a group of documents knows after the sampled tuples have been sorted."""

    def __init__(self, table: pa.Table, answers: list[tuple], length: int, buckets: int):
        self.texts = Texts(table["text"], length)
        blocks = list(self.texts.anchors())
        sent = _at_most_twice(np.concatenate([n for _, n in blocks])) if blocks else np.empty(0, np.uint64)
        bits, _ = _answers(answers, _NAMES, sent, buckets)
        chosen = sent[bits]
        kept = [p[_member(n, chosen)] for p, n in blocks]
        self.wanted = self.texts.reaching(np.concatenate(kept) if kept else np.empty(0, np.int64))
        names = self.texts.text_names()
        ordered = _at_most_twice(names)
        bits, later = _answers(answers, _TEXTS, ordered, buckets)
        #: texts that occur again, and of those the ones that another row answers for
        self.copies = _member(names, ordered[bits])
        self.followers = _member(names, ordered[later])
        first = np.zeros(names.size, bool)
        first[np.unique(names, return_index=True)[1]] = True
        self.followers |= self.copies & ~first
        for i in np.flatnonzero(self.followers):
            a = self.texts.starts[i]
            self.wanted[a : a + self.texts.sizes[i]] = False
        self.sent = _at_most_twice(np.concatenate([np.empty(0, np.uint64), *(n for _, n in self.texts.windows(self.wanted))]))


def _rows(table: pa.Table) -> list[tuple]:
    return list(zip(*(table[c].to_pylist() for c in ("bucket", "kind", "payload"))))


def _sample_step(length: int, buckets: int):
    def step(table: pa.Table) -> pa.Table:
        owner, texts = table["owner"][0].as_py(), Texts(table["text"], length)
        names = np.concatenate([np.empty(0, np.uint64), *(n for _, n in texts.anchors())])
        rows = _requests(owner, _NAMES, _at_most_twice(names), buckets) + _requests(owner, _TEXTS, _at_most_twice(texts.text_names()), buckets)
        return _table(rows, _REQUEST)

    return step


def _merge_step(length: int, buckets: int):
    def step(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([], _REQUEST)
        owner, known = table["owner"][0].as_py(), _rows(answers)
        rows = _requests(owner, _NAMES, _Group(table, known, length, buckets).sent, buckets)
        # The answers so far go on to the last step in a bucket of their own.
        rows += [(-1 - owner, owner, _FORWARD, k.to_bytes(1, "little") + b.to_bytes(8, "little") + p) for b, k, p in known]
        return _table(rows, _REQUEST)

    return step


def _spans(mask: np.ndarray) -> np.ndarray:
    """Begin and end of each run of marks."""
    return np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8))).reshape(-1, 2)


def _removal_step(length: int, buckets: int, columns: list[str]):
    def step(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = _rows(answers)
        known = [(int.from_bytes(p[1:9], "little"), p[0], p[9:]) for _, k, p in rows if k == _FORWARD]
        group = _Group(table, known, length, buckets)
        texts = group.texts
        bits, _ = _answers([r for r in rows if r[1] == _NAMES], _NAMES, group.sent, buckets)
        chosen = group.sent[bits]
        marks = np.zeros(texts.data.size + 1, np.int32)
        for at, names in texts.windows(group.wanted):
            at = at[_member(names, chosen)]
            np.add.at(marks, at, 1)
            np.add.at(marks, at + length, -1)
        removed = np.cumsum(marks[:-1]) > 0
        found = []
        for i, (a, n) in enumerate(zip(texts.starts, texts.sizes)):
            mask = np.ones(n, bool) if group.copies[i] and n >= length else removed[a : a + n]
            spans = _spans(mask)
            kept = texts.data[a : a + n][~mask].tobytes() if spans.size else texts.data[a : a + n].tobytes()
            found.append((int(n), int(mask.sum()), len(spans), hashlib.sha256(kept).hexdigest(), spans.ravel().tolist(), kept, kept.decode("utf-8", "ignore")))
        made = pa.Table.from_arrays(
            [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary(), pa.string()))],
            names=list(_KINDS),
        )
        for c in reversed(made.column_names):
            if c not in columns:
                made = made.drop_columns([c])
        for i, c in enumerate(c for c in table.column_names if c not in ("owner", "text")):
            made = made.add_column(i, c, table[c])
        del texts, group, found
        release()
        return made

    return step


_KINDS = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string", "spans": "array<long>", "kept": "binary", "kept_text": "string"}


def remove_repeats(
    spark: SparkSession, docs: DataFrame, text: str = "text", keep: list[str] | None = None, returns: list[str] | None = None, length: int = 200, group_bytes: int = 8 << 20
) -> DataFrame:
    """Per row of ``docs``: what is left when each byte of a string repeated anywhere is removed.

    A byte goes if a string of ``length`` bytes that covers it also starts at another position of
    any text, its own included. Strings are judged on the input, and never cross rows. Null texts
    are empty, repeated rows count as occurrences of each other, and an empty table gives no rows.
    ``keep`` names columns to carry along (all but the text by default); ``returns`` the results:
    ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans`` (begin and end bytes,
    flat), ``kept`` (the remaining bytes) and ``kept_text`` (those as text, without characters that
    were cut in two). ``group_bytes`` bounds the text one task holds.
    """
    carried = [c for c in docs.columns if c != text] if keep is None else keep
    wanted = list(returns or ["n_bytes", "n_removed", "n_spans", "kept_sha256"])
    inner = [f"c{i}" for i in range(len(carried))]
    body = F.coalesce(F.col(text), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(body)).alias("n")).first()["n"] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(2 * partitions, -(-total // group_bytes))
    buckets = max(32, -(-total // (2 * group_bytes)))
    spread = F.xxhash64(*[F.col(c).cast("string") for c in carried], F.substring(body, 1, 64), F.length(body))
    rows = docs.select(*[F.col(c).alias(i) for c, i in zip(carried, inner)], body.alias("text"), F.pmod(spread, F.lit(groups)).alias("owner"))
    sampled = rows.groupBy("owner").applyInArrow(_sample_step(length, buckets), _REQUEST)
    tuples = sampled.groupBy("bucket").applyInArrow(_repeated, _ANSWER)
    merged = rows.groupBy("owner").cogroup(tuples.groupBy("owner")).applyInArrow(_merge_step(length, buckets), _REQUEST)
    windows = merged.groupBy("bucket").applyInArrow(_repeated, _ANSWER)
    schema = ", ".join([*(f"{i} {dict(rows.dtypes)[i]}" for i in inner), *(f"{c} {_KINDS[c]}" for c in _KINDS if c in wanted)])
    out = rows.groupBy("owner").cogroup(windows.groupBy("owner")).applyInArrow(_removal_step(length, buckets, wanted), schema)
    return out.select(*[F.col(i).alias(c) for c, i in zip(carried, inner)], *wanted)
