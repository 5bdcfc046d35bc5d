"""SentencePiece encoding and decoding on the tokenizers library.

The model file is read field by field from its protobuf form, and its parts are rebuilt:
the normalizer (its compiled character map, blanks, the leading blank), the metaspace mark,
unigram scores or the merges that byte-pair scores imply, and byte fallback. Batches are
encoded on all threads of the library.

Tasks read the model from its path, which every executor must reach.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, compress, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructType
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

# Tasks share their machine, so a worker does not take all of it.
os.environ.setdefault("RAYON_NUM_THREADS", "2")

MARK = "\u2581"
CUT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
# Bytes of text or ids worked on in one go, and cuts whose ids a Python worker remembers.
SLICE_BYTES = 1 << 18
REMEMBERED = 100_000
CUTS_IN_LINE = 256

# Kinds of pieces and of models, as the model file numbers them.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message: integers, and bytes of everything else."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if kind == 2:
                size, at = varint(at)
            if size is None:
                raise ValueError(f"unknown wire type {kind}")
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass(frozen=True)
class Model:
    """What the model file says. `pieces`: text, score and kind, in order of their ids."""

    pieces: tuple[tuple[str, float, int], ...]
    kind: int
    byte_fallback: bool
    charsmap: bytes
    add_dummy_prefix: bool
    remove_extra_whitespaces: bool
    escape_whitespaces: bool

    @property
    def unknown(self) -> int:
        return next(i for i, piece in enumerate(self.pieces) if piece[2] == UNKNOWN)


def parse_model(data: bytes) -> Model:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    if trainer.get(3, UNIGRAM) not in (UNIGRAM, BPE):
        raise ValueError("only unigram and byte-pair models")
    return Model(
        tuple(pieces),
        trainer.get(3, UNIGRAM),
        bool(trainer.get(35, 0)),
        normalizer.get(2, b""),
        bool(normalizer.get(3, 1)),
        bool(normalizer.get(4, 1)),
        bool(normalizer.get(5, 1)),
    )


def _merges(pieces: Sequence[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, the best-scored third first."""
    usable = {text: score for text, score, kind in pieces if kind == NORMAL}
    found = [
        (-score, text[:cut], text[cut:])
        for text, score in usable.items()
        for cut in range(1, len(text))
        if text[:cut] in usable and text[cut:] in usable
    ]
    return [(left, right) for _, left, right in sorted(found, key=lambda merge: merge[0])]


def _breaks_at_marks(pieces: Sequence[tuple[str, float, int]]) -> bool:
    """True if no piece goes on with a mark after another character, so that text can be
    cut before each run of marks."""
    texts = {text for text, _, kind in pieces if kind == NORMAL}
    return MARK in texts and not any(MARK in text.lstrip(MARK) for text in texts)


def build_tokenizer(model: Model) -> Tokenizer:
    """The model on the tokenizers library. Control pieces in a text are ordinary text."""
    vocabulary = {text: i for i, (text, _, _) in enumerate(model.pieces)}
    if model.kind == UNIGRAM:
        core = models.Unigram([(text, score) for text, score, _ in model.pieces], model.unknown, model.byte_fallback)
    else:
        core = models.BPE(
            vocabulary,
            _merges(model.pieces),
            unk_token=model.pieces[model.unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if model.escape_whitespaces and _breaks_at_marks(model.pieces):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    added = [AddedToken(text, normalized=False) for text, _, kind in model.pieces if kind == USER_DEFINED]
    tokenizer.add_tokens(added)
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.add_dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer


def _in_line(lists: Sequence[Sequence[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int32)


class Codec:
    """Encodes and decodes lists of texts with a model.

    Where no piece goes on past a mark, text is cut before each run of marks, and each
    distinct cut is encoded once, in batches on all threads; the rest is looking up. Other
    models, and those with user-defined pieces, encode whole texts.
    """

    def __init__(self, model: Model):
        self.model = model
        self.tokenizer = build_tokenizer(model)
        kinds = {kind for _, _, kind in model.pieces}
        self.cuts = model.escape_whitespaces and USER_DEFINED not in kinds and _breaks_at_marks(model.pieces)
        self.only_marks = not model.charsmap and not model.remove_extra_whitespaces
        self.known: dict[str, list[int]] = {}
        self.tokenizer_of_cuts = Tokenizer(self.tokenizer.model)
        self.core = Tokenizer(self.tokenizer.model)
        self.core.pre_tokenizer = pre_tokenizers.Metaspace(MARK, prepend_scheme="never", split=True)
        self.marked = np.array([text.startswith(MARK) for text, _, _ in model.pieces])
        written = {BYTE: lambda text: bytes([int(text[3:5], 16)]), CONTROL: lambda _: b"", UNKNOWN: lambda _: " \u2047 ".encode()}
        self.bytes = [
            written.get(kind, lambda text: text.replace(MARK, " ").encode())(text) for text, _, kind in model.pieces
        ]

    def normalize(self, text: str) -> str:
        if not self.only_marks:
            return self.tokenizer.normalizer.normalize_str(text)
        if text and self.model.add_dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def _encode_cuts(self, cuts: list[str]) -> list[list[int]]:
        """Ids of each cut. Cuts with one mark, at their start, go through the library many
        in a line; ids that start with a mark tell them apart again."""
        one_mark = [cut[0] == MARK and cut.count(MARK) == 1 for cut in cuts]
        lines = list(compress(cuts, one_mark))
        lines = ["".join(lines[i : i + CUTS_IN_LINE]) for i in range(0, len(lines), CUTS_IN_LINE)]
        ids = _in_line([one.ids for one in self.core.encode_batch_fast(lines, add_special_tokens=False)])
        bounds = [*np.flatnonzero(self.marked[ids]).tolist(), len(ids)]
        ids = ids.tolist()
        straight = iter([ids[i:j] for i, j in pairwise(bounds)])
        rest = list(compress(cuts, [not one for one in one_mark]))
        alone = iter([one.ids for one in self.tokenizer_of_cuts.encode_batch_fast(rest, add_special_tokens=False)])
        return [next(straight if one else alone) for one in one_mark]

    def _ids_of(self, cuts: list[str]) -> list[list[int]]:
        """Ids of distinct cuts. The first `REMEMBERED` ones ever met are remembered: those
        are the frequent ones, as a rule."""
        found = list(map(self.known.get, cuts))
        places = [i for i, ids in enumerate(found) if ids is None]
        new = [cuts[i] for i in places]
        encoded = self._encode_cuts(new)
        for i, ids in zip(places, encoded, strict=True):
            found[i] = ids
        self.known.update(islice(zip(new, encoded, strict=True), max(0, REMEMBERED - len(self.known))))
        return found

    def encode_flat(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a line, and where each text's ids end."""
        if not self.cuts:
            lists = [one.ids for one in self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]
            return _in_line(lists), np.cumsum(list(map(len, lists)), dtype=np.int64)
        cut = [CUT.findall(self.normalize(text)) for text in texts]
        every = list(chain.from_iterable(cut))
        place = {part: i for i, part in enumerate(dict.fromkeys(every))}
        lists = self._ids_of(list(place))
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        used = np.fromiter(map(place.__getitem__, every), np.int64, len(every))
        counts, starts = sizes[used], (np.cumsum(sizes) - sizes)[used]
        ends = np.cumsum(counts)
        ids = _in_line(lists)[np.arange(counts.sum()) + np.repeat(starts - ends + counts, counts)]
        last = np.cumsum(list(map(len, cut)), dtype=np.int64)
        return ids, np.concatenate([[0], ends])[last]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        ids, ends = self.encode_flat(texts)
        return [part.tolist() for part in np.split(ids, ends[:-1])] if len(texts) else []

    def decode(self, lists: Sequence[Sequence[int]]) -> list[str]:
        texts = []
        for ids in lists:
            data = b"".join(map(self.bytes.__getitem__, ids))
            if self.model.add_dummy_prefix and data[:1] == b" ":
                data = data[1:]
            try:
                texts.append(data.decode())
            except UnicodeDecodeError:
                texts.append(self.tokenizer.decode(list(ids), skip_special_tokens=False))
        return texts


@lru_cache(maxsize=2)
def load_codec(path: str) -> Codec:
    with open(path, "rb") as file:
        return Codec(parse_model(file.read()))


# Texts in which a rebuilt tokenizer would differ first.
PROBES = (
    "", " ", "  two  blanks ", "line\nbreak\ttab", "na\u00efve caf\u00e9", "\u6f22\u5b57\u304b\u306a\u4ea4\u3058\u308a", "emoji \U0001f642\U0001f643",
    "\u2581mark \u2581\u2581", "<s> </s> <unk> [INST]", "\u0000\u0007", "\uff11\uff12\uff13 \ufb01 \u00bd", "a" * 300,
    "don't_stop-now...", "\u0645\u0631\u062d\u0628\u0627", "e\u0301", "\u00a0nb\u00a0sp", " leading", "trailing   ",
)


def verify_parity(path: str, texts: Sequence[str] = PROBES) -> None:
    """Raise ValueError if a text is encoded otherwise than by the sentencepiece library, or
    its ids decoded otherwise, by the codec or by the whole tokenizer."""
    import sentencepiece

    codec, library = load_codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    whole = codec.tokenizer.encode_batch(list(texts), add_special_tokens=False)
    for text, encoded, own in zip(texts, whole, codec.encode(texts), strict=True):
        ids = library.encode(text)
        if not own == encoded.ids == ids:
            raise ValueError(f"{text!r}: {own} or {encoded.ids} instead of {ids}")
        if codec.decode([ids]) != [library.decode(ids)]:
            raise ValueError(f"{text!r}: decoded to {codec.decode([ids])!r}")


def _parts(batch: pa.RecordBatch, sizes: pa.Array) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `SLICE_BYTES` together, or one larger row; only a
    run at a time becomes Python objects."""
    start = total = 0
    for i, size in enumerate(sizes.fill_null(0).to_pylist()):
        if total and total + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _encoded(codec: Codec, texts: pa.Array) -> pa.ListArray:
    flat, ends = codec.encode_flat([value or "" for value in texts.to_pylist()])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))


def _decoded(codec: Codec, ids: pa.Array) -> pa.StringArray:
    return pa.array(codec.decode([value or [] for value in ids.to_pylist()]), pa.string())


def _with_columns(df: DataFrame, columns: dict[str, DataType], function) -> DataFrame:
    schema = StructType([*df.schema.fields])
    for name, kind in columns.items():
        if name in schema.names:
            raise ValueError(f"there is a column {name} already")
        schema = schema.add(name, kind)
    return df.mapInArrow(function, schema)


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """`docs` with the column `ids`: an array of the piece ids of `text`.

    Null and empty texts have no ids. An existing column `ids` is an error. All rows and
    other columns are kept as they are; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(model_path)
        for batch in batches:
            at = batch.schema.names.index(text)
            for part in _parts(batch, pc.binary_length(batch.column(at))):
                yield pa.RecordBatch.from_arrays([*part.columns, _encoded(codec, part.column(at))], [*batch.schema.names, ids])

    return _with_columns(docs, {ids: ArrayType(IntegerType())}, run)


def decode(rows: DataFrame, model_path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """`rows` with the column `text`: what the array `ids` stands for. Null and empty arrays
    give empty text, bytes that are no UTF-8 replacement characters. An existing column
    `text` is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(model_path)
        for batch in batches:
            at = batch.schema.names.index(ids)
            for part in _parts(batch, pc.multiply(pc.list_value_length(batch.column(at)), 4)):
                yield pa.RecordBatch.from_arrays([*part.columns, _decoded(codec, part.column(at))], [*batch.schema.names, text])

    return _with_columns(rows, {text: StringType()}, run)


def round_trip(
    docs: DataFrame, model_path: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded"
) -> DataFrame:
    """`docs` with what `encode` and then `decode` add, in one pass and one Python worker a
    task, so that neither texts nor ids travel twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(model_path)
        for batch in batches:
            at = batch.schema.names.index(text)
            for part in _parts(batch, pc.binary_length(batch.column(at))):
                tokens = _encoded(codec, part.column(at))
                columns = [*part.columns, tokens, _decoded(codec, tokens)]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, ids, decoded])

    return _with_columns(docs, {ids: ArrayType(IntegerType()), decoded: StringType()}, run)
