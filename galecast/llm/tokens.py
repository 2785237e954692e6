"""Token ids in directly addressable codes.

An id is cut into chunks of CHUNK_BITS bits. Level k holds, one after the other, the k-th chunk of every id that has one; a bitmap
of the level tells which ids go on to the next, and a rank directory holds the number of set bits before every RANK_BITS bits. So
token i is read with one lookup a level (its place in level k + 1 is the rank of its bit in level k), without decoding any
neighbour. Segments of whole documents in ascending doc_id order are the rows of a Parquet table, which Spark writes and commits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from galecast.llm.shared import stored
from galecast.llm.text import GAP, passes, texts, words

CHUNK_BITS = 8
RANK_BITS = 512
#: Closes every document.
END_ID = 2
#: Pieces in each of the two generations that an encoder remembers.
KEPT = 250_000
SEGMENTS = (
    "part int, first_token long, n_tokens long, doc_ids array<long>, doc_starts binary, "
    "levels array<binary>, bitmaps array<binary>, ranks array<binary>"
)
#: Fixed value: how this vocabulary's file cuts normalised text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What a byte is: white space, part of a letter, a digit, another sign, or part of an odd word. 0xC3 begins the letters from U+00C0 on.
_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[33:127] = _SIGN
_KIND[[*b"'<"]] = _ODD
_KIND[[*range(48, 58)]] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123), 0xC3]] = _LETTER
_KIND[GAP] = _SPACE
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_ENCODERS: dict[str, Encoder] = {}


def cut_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The pieces of all texts in lower case, odd words whole and as they are; which are odd; and the pieces before each text."""
    starts, ends, _ = words(data, offsets)
    kind, low = _KIND[data], _LOWER[data]
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    second &= (data >= 0x80) & (data != 0x97) & (data != 0xB7)  # the two signs among the letters
    kind[second] = _LETTER
    low[second & (data <= 0x9E)] += 0x20
    begin = np.ones(len(data), bool)
    begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    begin &= kind != _SPACE
    begin[starts] = True
    strange = np.unique(np.searchsorted(starts, np.flatnonzero(kind == _ODD), side="right") - 1)
    for a, b in zip(starts[strange].tolist(), ends[strange].tolist(), strict=True):
        begin[a + 1 : b] = False
        low[a:b] = data[a:b]
    inside = kind != _SPACE
    at = np.flatnonzero(begin)
    edges = np.append(np.cumsum(inside)[at] - 1, np.count_nonzero(inside)).astype(np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(edges), pa.py_buffer(low[inside])])
    odd = np.zeros(len(at), bool)
    odd[np.searchsorted(at, starts[strange])] = True
    return pieces, odd, np.searchsorted(at, offsets)


class Memory:
    """Two generations of remembered values: when the young one is full it becomes the old one, and what the old one held and
    nobody asked for since is forgotten. So frequent keys stay, rare ones go, and the memory is bounded."""

    def __init__(self, kept: int = KEPT):
        self.kept, self.young, self.old = kept, {}, {}

    def turn(self, coming: int) -> None:
        """Makes room for so many keys."""
        if len(self.young) + coming > self.kept:
            self.old, self.young = self.young, {}

    def forget(self) -> None:
        self.young, self.old = {}, {}


class Encoder:
    """Ids of whole texts, piece by piece.

    The vocabulary drops white space and never joins across it, so a text's ids are those of its words in turn. A word of ASCII and of
    Latin letters up to U+00FF is lower-cased and cut by the rule of PIECES, a batch at a time, and the library's model encodes each new piece;
    any other word, or one that may hold a contraction or a special token, goes through the library's whole pipeline. A file
    with other rules than the known ones has every text go through the library as it is.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        state = self.tokenizer.__getstate__().decode()
        self.by_word = '"end_of_word_suffix":"</w>"' in state and PIECES.replace("\\", "\\\\") in state and '"Lowercase"' in state
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.as_text = {b: chr(256 + i) for i, b in enumerate(others)}
        self.memory = Memory()

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def piece(self, piece: bytes) -> bytes:
        shown = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(self.as_text)
        ids = [token.id for token in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def known(self, pieces: list[bytes], odd: list[bool]) -> list[bytes]:
        """The ids of each piece, or of each odd word, from the memory or the library."""
        self.memory.turn(len(pieces))
        young, old = self.memory.young, self.memory.old
        out = []
        for raw, is_word in zip(pieces, odd, strict=True):
            ids = young.get(raw)
            if ids is None:
                ids = old.get(raw)
                if ids is None:
                    ids = self.whole(raw.decode()) if is_word else self.piece(raw)
                young[raw] = ids
            out.append(ids)
        return out

    def encode(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column, each closed by an end id, one behind the other, and how many each text has.

        Each distinct piece is looked up once; its ids are then laid out wherever it stands.
        """
        if not self.by_word:
            rows = [np.frombuffer(self.whole(text), "<u4") for text in column.fill_null("").to_pylist()]
            last = np.array([end], np.uint32)
            return np.concatenate([x for row in rows for x in (row, last)] or [last[:0]]), np.array([len(row) + 1 for row in rows], np.int64)
        data, offsets = texts(column)
        pieces, odd, bounds = cut_pieces(data, offsets)
        each = pieces.dictionary_encode()
        index = each.indices.to_numpy().astype(np.int64)
        new = np.flatnonzero(np.diff(np.maximum.accumulate(index), prepend=-1)) if len(index) else index
        ids = [*self.known(each.dictionary.to_pylist(), odd[new].tolist()), struct.pack("<I", end)]
        size = np.array([len(x) for x in ids], np.int64) >> 2
        table, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        piece = np.insert(index, bounds[1:], len(ids) - 1)
        long = size[piece]
        behind = np.cumsum(long)
        total = int(behind[-1]) if len(behind) else 0
        flat = table[np.repeat(first[piece] - behind + long, long) + np.arange(total)]
        closing = behind[bounds[1:] + np.arange(len(bounds) - 1)]
        return flat, np.diff(closing, prepend=0)

    def forget(self) -> None:
        """Gives back the memory of words, at the end of a partition: a worker lives on and serves other stages."""
        self.memory.forget()
        pa.default_memory_pool().release_unused()


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Codes(NamedTuple):
    levels: list[bytes]
    bitmaps: list[bytes]
    ranks: list[bytes]


def pack(ids: np.ndarray) -> Codes:
    """Unsigned 32-bit ids to levels, bitmaps of those that go on, and rank directories."""
    codes = Codes([], [], [])
    rest = ids.astype(np.uint32)
    while True:
        more = rest >> CHUNK_BITS
        on = more > 0
        codes.levels.append((rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8).tobytes())
        if not on.any():
            return codes
        bits = np.packbits(on, bitorder="little")
        blocks = np.add.reduceat(on, np.arange(0, len(on), RANK_BITS), dtype=np.uint32)
        codes.bitmaps.append(bits.tobytes())
        codes.ranks.append(np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype("<u4").tobytes())
        rest = more[on]


def rank(codes: Codes, level: int, i: int) -> int:
    """Set bits before bit i of a level's bitmap: the directory entry and the bits of one block."""
    i = int(i)
    block = i // RANK_BITS
    bits, directory = codes.bitmaps[level], np.frombuffer(codes.ranks[level], "<u4")
    if block >= len(directory):
        block = len(directory) - 1
    inside = int.from_bytes(bits[block * RANK_BITS // 8 : (i + 7) // 8], "little") & ((1 << (i - block * RANK_BITS)) - 1)
    return int(directory[block]) + inside.bit_count()


def token(codes: Codes, i: int) -> int:
    """Token i, by one lookup a level."""
    value, shift = 0, 0
    for level, chunk in enumerate(codes.levels):
        value |= chunk[i] << shift
        shift += CHUNK_BITS
        if level == len(codes.bitmaps) or not codes.bitmaps[level][i >> 3] >> (i & 7) & 1:
            break
        i = rank(codes, level, i)
    return value


def tokens(codes: Codes, a: int, b: int) -> np.ndarray:
    """Tokens a to b (exclusive): a contiguous range of every level, found by the rank of its two ends."""
    out = np.zeros(b - a, np.uint32)
    at = np.arange(b - a)
    for level, chunk in enumerate(codes.levels):
        out[at] |= np.frombuffer(chunk, np.uint8)[a:b].astype(np.uint32) << np.uint32(level * CHUNK_BITS)
        if level == len(codes.bitmaps) or a == b:
            break
        low = a >> 3
        on = np.unpackbits(np.frombuffer(codes.bitmaps[level], np.uint8)[low : (b + 7) >> 3], bitorder="little")[a - 8 * low : b - 8 * low]
        a, b = rank(codes, level, a), rank(codes, level, b)
        at = at[on.astype(bool)]
    return out


def write_tokens(docs: DataFrame, path: str, end: int = END_ID) -> DataFrame:
    """The token table of docs (doc_id, text): segments in ascending doc_id order, null ids first, equal ids by text hash.

    A null text is an empty one: it has the end id alone. part numbers the ranges of doc_id; first_token counts from the start of
    its part, doc_starts (unsigned 64-bit) from the start of its segment. Equal rows are written as often as they occur; an
    empty table gives an empty one. What stays in a task is one segment and the memory of known words.
    """
    slim = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
    ordered = slim.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").withColumn("part", F.spark_partition_id())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, first = encoder(path), 0
        for batch in batches:
            for part in passes(batch):
                ids, sizes = code.encode(part.column("text"), end)
                starts = np.concatenate([[0], np.cumsum(sizes)])
                codes = pack(ids)
                values = [part.column("part")[0].as_py(), first, int(starts[-1]), part.column("doc_id").to_pylist(), starts[:-1].astype("<u8").tobytes(), *map(list, codes)]
                first += int(starts[-1])
                yield pa.RecordBatch.from_pydict({name: [value] for name, value in zip(names, values, strict=True)}, schema=schema)
        code.forget()

    names = [column.split()[0] for column in SEGMENTS.split(", ")]
    schema = pa.schema(zip(names, (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), *[pa.list_(pa.binary())] * 3), strict=True))
    return stored(ordered.mapInArrow(write, SEGMENTS), "tokens", compression="none", **{"parquet.block.size": str(32 << 20)})


def read_documents(table: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in a token table, from its codes.

    The number of tokens before each part, one number a range of doc_id, goes through the driver.
    """
    sizes = {row["part"]: row["n"] for row in table.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(sizes):
        before[part], total = total, total + sizes[part]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                codes = Codes(one["levels"], one["bitmaps"], one["ranks"])
                n, starts = one["n_tokens"], np.frombuffer(one["doc_starts"], "<u8").astype(np.int64)
                ids = tokens(codes, 0, n).astype("<u4").tobytes()
                ends = np.append(starts[1:], n)
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)]
                first = before[one["part"]] + one["first_token"]
                columns = [pa.array(one["doc_ids"], pa.int64()), pa.array(starts + first), pa.array(ends - starts), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return table.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def encoded_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The documents written to a token table and read back."""
    return read_documents(write_tokens(docs, path or vocabulary()))
