"""SentencePiece models on the tokenizers library: encoding, decoding, parity.

The model file, a protobuf, is parsed here; from it a tokenizer of the tokenizers
library is rebuilt: normaliser (character map, white space rules, marker for
blanks), unigram scores or the merges that BPE scores imply, and byte fallback.

Texts are encoded in Arrow batches. Where no piece holds a marker after another
character, and nothing is normalised away, a text falls apart into segments that
begin with markers and are encoded alone with the same result; every distinct
segment of a batch is then encoded once, by the library's threads. Each segment
is also encoded by the sentencepiece library and decoded again, so parity and round
trip are verified for every text and not for a sample.

Defined results: a null or empty text has no ids; a text that holds the marker
itself does not survive the round trip, as the marker means a blank; repeated rows
and null ids keep their rows; other columns are not touched.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
THREADS = 2

# Kinds of models and of pieces in the file format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)

# A worker holds one part's texts and ids as Python objects at a time.
PART_BYTES = 2_000_000
CACHED = 200_000
CACHED_LENGTH = 40


# --- the model file -------------------------------------------------------

@dataclass(frozen=True)
class Model:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    squeeze_blanks: bool
    escape_blanks: bool

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)

    @property
    def plain(self) -> bool:
        """Whether normalising only puts markers for blanks and one in front."""
        return not self.charsmap and not self.squeeze_blanks and self.escape_blanks and self.dummy_prefix

    @property
    def segments(self) -> bool:
        """Whether texts can be encoded segment by segment."""
        inner = any(MARK in p.lstrip(MARK) for p in self.pieces)
        return self.plain and not inner and MARK in self.pieces and USER_DEFINED not in self.kinds


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire in (1, 2, 5):
            size = {1: 8, 5: 4}.get(wire)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        else:
            raise ValueError("not a SentencePiece model")
        yield key >> 3, value


def parse_model(data: bytes) -> Model:
    """The parts of a model file that encoding and decoding need."""
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            pieces.append(dict(_fields(value)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    return Model(
        pieces=tuple(p[1].decode() for p in pieces),
        scores=tuple(struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces),
        kinds=tuple(p.get(3, NORMAL) for p in pieces),
        kind=trainer.get(3, UNIGRAM),
        byte_fallback=bool(trainer.get(35, 0)),
        charsmap=normalizer.get(2, b""),
        dummy_prefix=bool(normalizer.get(3, 1)),
        squeeze_blanks=bool(normalizer.get(4, 1)),
        escape_blanks=bool(normalizer.get(5, 1)),
    )


def read_model(path: str = MODEL_PATH) -> bytes:
    """The model file, some hundred kB, as it is shipped to the tasks."""
    with open(path, "rb") as f:
        return f.read()


# --- the tokenizer --------------------------------------------------------

def _merges(model: Model) -> list[tuple[str, str]]:
    """Merges of BPE, best score first: each way to make a piece of two pieces."""
    ids = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] in (NORMAL, USER_DEFINED)}
    found = []
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ids and right in ids:
                found.append((-model.scores[i], i, ids[left], ids[right], (left, right)))
    return [pair for *_, pair in sorted(found)]


def build_tokenizer(model: Model, normalise: bool = True):
    """A tokenizer of the tokenizers library; without normalising it takes marked text."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        core = models.Unigram(list(zip(model.pieces, model.scores)), model.unknown, model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(
            vocab={p: i for i, p in enumerate(model.pieces)}, merges=_merges(model),
            unk_token=model.pieces[model.unknown], fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError("only unigram and BPE models are read")
    tokenizer = Tokenizer(core)
    own = [p for p, k in zip(model.pieces, model.kinds) if k == USER_DEFINED]
    if own:
        tokenizer.add_tokens([AddedToken(p, normalized=True) for p in own])
    steps = []
    if normalise:
        if model.charsmap:
            steps.append(normalizers.Precompiled(model.charsmap))
        if model.squeeze_blanks:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if model.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if model.escape_blanks else " "))
        if model.escape_blanks:
            steps.append(normalizers.Replace(" ", MARK))
        tokenizer.normalizer = normalizers.Sequence(steps)
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer


class Segments:
    """Known segments with their ids, one after the other in one array.

    Unknown ids, parity and round trip are kept by segment, so that a text's are sums
    over its segments.
    """

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.offsets = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.unknown, self.unequal, self.unlike, self.used = (np.zeros(0, np.int64) for _ in range(4))

    def __len__(self) -> int:
        return len(self.index)

    def add(self, keys: list[str], ids: list[list[int]], unknown: int, unequal, unlike) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
        self.index.update(zip(keys, range(len(self.index), len(self.index) + len(keys))))
        ends = np.cumsum(sizes)
        counted = np.concatenate([[0], np.cumsum(flat == unknown)])
        self.unknown = np.concatenate([self.unknown, counted[ends] - counted[ends - sizes]])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + ends])
        self.ids = np.concatenate([self.ids, flat])
        self.unequal = np.concatenate([self.unequal, np.asarray(unequal, np.int64)])
        self.unlike = np.concatenate([self.unlike, np.asarray(unlike, np.int64)])
        self.used = np.concatenate([self.used, np.zeros(len(keys), np.int64)])

    def keep_used(self, n: int) -> None:
        """Forget all but the n most used segments."""
        places = np.sort(np.argsort(-self.used, kind="stable")[:n])
        names = list(self.index)
        self.index = {names[p]: i for i, p in enumerate(places.tolist())}
        sizes, self.ids = self.gather(places)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.unknown, self.unequal, self.unlike = (a[places] for a in (self.unknown, self.unequal, self.unlike))
        self.used = self.used[places] // 2

    def cut(self, n: int) -> None:
        """Keep what belongs to the first n segments, which the index holds."""
        self.ids, self.offsets = self.ids[:self.offsets[n]], self.offsets[:n + 1]
        self.unknown, self.unequal, self.unlike = self.unknown[:n], self.unequal[:n], self.unlike[:n]
        self.used = self.used[:n]

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each place, and all ids in a row."""
        starts, sizes = self.offsets[places], self.offsets[places + 1] - self.offsets[places]
        before = np.cumsum(sizes) - sizes
        return sizes, self.ids[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


@dataclass(frozen=True)
class Encoded:
    """The ids of some texts in a row, where each text's begin, and the checks by text."""

    offsets: np.ndarray
    ids: np.ndarray
    unknown: np.ndarray
    parity: np.ndarray
    round_trip: np.ndarray

    def lists(self) -> list[list[int]]:
        return [self.ids[a:b].tolist() for a, b in zip(self.offsets, self.offsets[1:])]


class Codec:
    """Encodes and decodes with one model; keeps a bounded table of known segments."""

    def __init__(self, data: bytes, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        self.model = model = parse_model(data)
        self.by_segment = model.segments
        self.tokenizer = build_tokenizer(model, normalise=not self.by_segment)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.known = Segments()
        self.as_bytes = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL
            else " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode()
            for p, k in zip(model.pieces, model.kinds)
        ]
        self.runs = re.compile(f"{MARK}+[^{MARK}]*")

    def _keys(self, text: str) -> list[str]:
        """The segments of a text without the marker that each begins with."""
        if not text:
            return []
        marked = text.replace(" ", MARK)
        if MARK + MARK not in marked and marked[0] != MARK:
            return marked.split(MARK)
        return [s[1:] for s in self.runs.findall(MARK + marked)]

    def _learn(self, keys: set[str]) -> None:
        """Encode segments that are not known yet, compare both libraries, and decode.

        When the table would be full, the more used half of it is kept. Long segments
        come last, so that they can be forgotten by cutting the table.
        """
        new = keys - self.known.index.keys()
        if len(self.known) + len(new) > CACHED:
            self.known.keep_used(CACHED // 2)
            new = keys - self.known.index.keys()
        new = sorted(new, key=lambda k: len(k) > CACHED_LENGTH)
        if not new:
            return
        ours = [e.ids for e in self.tokenizer.encode_batch_fast([MARK + k for k in new], add_special_tokens=False)]
        theirs = self.reference.encode(new, num_threads=1)
        mark = [self.reference.piece_to_id(MARK)]
        table = self.as_bytes
        self.known.add(
            new, ours, self.model.unknown,
            [a != (b if k else mark) for k, a, b in zip(new, ours, theirs)],
            [b"".join([table[i] for i in a]) != (" " + k.replace(MARK, " ")).encode() for k, a in zip(new, ours)],
        )

    def _forget(self) -> None:
        """Cut the table back to its bound, without long segments."""
        known = self.known
        while known.index and len(next(reversed(known.index))) > CACHED_LENGTH:
            known.index.popitem()
        known.cut(len(known))
        if len(known) > CACHED:
            known.keep_used(CACHED // 2)

    def encode(self, texts: list[str]) -> Encoded:
        """Ids of each text, whether the sentencepiece library gives the same, and the round trip."""
        if not self.by_segment:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            same = self.reference.encode(texts, num_threads=1) if texts else []
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids], dtype=np.int64)])
            return Encoded(
                offsets, np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1])),
                np.array([i.count(self.model.unknown) for i in ids], np.int64),
                np.array([a == b for a, b in zip(ids, same)], bool),
                np.array([self.decode(i) == t for i, t in zip(ids, texts)], bool),
            )
        keys = [self._keys(t) for t in texts]
        self._learn(set().union(*keys))
        known = self.known
        borders = np.concatenate([[0], np.cumsum([len(row) for row in keys], dtype=np.int64)])
        places = np.fromiter(map(known.index.__getitem__, chain.from_iterable(keys)), np.int64, int(borders[-1]))
        known.used += np.bincount(places, minlength=len(known.used))
        sizes, ids = known.gather(places)

        def by_text(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])[borders]
            return total[1:] - total[:-1]

        offsets = np.concatenate([[0], np.cumsum(sizes)])[borders]
        trip = by_text(known.unlike[places]) == 0
        for i in range(len(texts)):
            # Segments that decode to themselves join to the text, but for markers in it.
            if not trip[i] or MARK in texts[i]:
                trip[i] = self.decode(ids[offsets[i]:offsets[i + 1]].tolist()) == texts[i]
        found = Encoded(offsets, ids, by_text(known.unknown[places]), by_text(known.unequal[places]) == 0, trip)
        self._forget()
        return found

    def decode(self, ids) -> str:
        """The text of some ids."""
        table = self.as_bytes
        joined = b"".join([table[i] for i in ids])
        if self.model.dummy_prefix and joined[:1] == b" ":
            joined = joined[1:]
        return joined.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec_of(data: bytes, threads: int = THREADS) -> Codec:
    """One codec per model in a worker process."""
    return Codec(data, threads)


# --- operators ------------------------------------------------------------

def _parts(sizes: np.ndarray) -> Iterator[slice]:
    """Rows in runs of a bounded number of bytes, at least one row each."""
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if i > start and size + n > PART_BYTES:
            yield slice(start, i)
            start, size = i, 0
        size += int(n)
    if start < len(sizes):
        yield slice(start, len(sizes))


def _encoder(data: bytes, threads: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(data, threads)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for part in _parts(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
                some = texts.slice(part.start, part.stop - part.start).to_pylist()
                found = codec.encode(some)
                arrays = [
                    batch.column(0).slice(part.start, part.stop - part.start),
                    pa.ListArray.from_arrays(pa.array(found.offsets.astype(np.int32)), pa.array(found.ids)),
                    pa.array(np.diff(found.offsets).astype(np.int32)),
                    pa.array(found.unknown.astype(np.int32)),
                    pa.array(found.round_trip),
                    pa.array(found.parity),
                ]
                others = [c.slice(part.start, part.stop - part.start) for c in batch.columns[2:]]
                yield pa.RecordBatch.from_arrays(
                    arrays + others,
                    ["id", "ids", "n_tokens", "n_unknown", "round_trip", "parity", *batch.schema.names[2:]])

    return run


def encode(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    model_path: str = MODEL_PATH, threads: int = THREADS, others: tuple[str, ...] = (),
) -> DataFrame:
    """Ids of every whole text, with checks: id, ids, n_tokens, n_unknown, round_trip, parity.

    round_trip says whether the ids decode to the text, parity whether the
    sentencepiece library gives the same ids. Other columns named follow as they are.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), *others)
    kind = rows.schema["id"].dataType.simpleString()
    more = "".join(f", {n} {rows.schema[n].dataType.simpleString()}" for n in others)
    return rows.mapInArrow(
        _encoder(read_model(model_path), threads),
        f"id {kind}, ids array<int>, n_tokens int, n_unknown int, round_trip boolean, parity boolean{more}",
    ).withColumnRenamed("id", id_column)


def decoded(ids: Column, model_path: str = MODEL_PATH) -> Column:
    """The text of a column of ids; null ids give null."""
    data = read_model(model_path)

    @F.pandas_udf("string")
    def of(rows: pd.Series) -> pd.Series:
        codec = codec_of(data)
        return pd.Series([None if r is None else codec.decode(r) for r in rows], dtype=object)

    return of(ids)
