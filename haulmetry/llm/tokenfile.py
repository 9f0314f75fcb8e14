"""Token ids in binary files whose document boundaries are Elias-Fano encoded.

One shard is one file: a header, the ids of all its documents one after the other, the boundaries.

    offset  bytes  what
    0       8      magic
    8       4 x 8  documents n, ids u, low bits l, bytes per id (little-endian)
    40      u * w  ids, little-endian
    ...            low bits of the n + 1 boundaries, packed
    ...            high bits of the boundaries in unary, packed
    ...            samples: place of every 256th set high bit, 32 bits each

A boundary is the number of ids before a document. It is split into ``l`` low bits, stored as they
are, and the rest, stored as one set bit at ``rest + rank`` of a bit array. That takes about
``2 + log2(u / n)`` bits a document. ``select`` finds the k-th set bit from the nearest sample.

Shards hold ascending, disjoint ranges of documents; a manifest row a shard carries its counts, from
which the ids before each shard follow.
"""

from __future__ import annotations

import operator
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmetry.llm.common import file_system, new_path, parts_for, slices, staged

MAGIC = b"TOKENEF1"
HEADER = struct.Struct("<8sQQQQ")
SAMPLE = 256
#: Documents whose boundaries a reader decodes at a time.
RANGE = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: Megabytes of text a shard holds, as a goal.
SHARD_MB = 24.0

#: Unicode's white space, at which the vocabulary's pattern cuts texts.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: The pattern never joins what lies on two sides of white space, but for one space before a word.
#: So each of these pieces is encoded alike alone and inside its text.
#: The first character after the Latin blocks.
_BEYOND = "\u0250"
_PIECE = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


# Encoding


class Recent(dict):
    """A bounded memory in two halves: what is asked for again moves from the old half to the new one."""

    def __init__(self, make, half: int):
        super().__init__()
        self.make, self.half, self.old = make, half, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


_id = operator.attrgetter("id")


class Encoder:
    """Ids of whole texts, as bytes. Pieces that occur again are looked up, not encoded again."""

    def __init__(self, path: str, width: int, half: int = 300_000):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = {2: "H", 4: "I"}[width]
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.model, self.cut = self.tokenizer.model, self.tokenizer.pre_tokenizer.pre_tokenize_str
        # In Latin texts the vocabulary's own pattern cuts a word, and a table writes its bytes as letters.
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.letters = {c: self.cut(chr(c))[0][0] for c in range(ord(_BEYOND))}
        # A word of ASCII is cut by the same pattern, spelt for ASCII: it has no white space inside.
        self.cut_ascii = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^A-Za-z0-9\s]+").findall
        self.blank, self.marks = self.letters[32], {t[0] for t in self.special}
        self.words = Recent(self._word, half)
        self.pieces = Recent(self._piece, half)

    def _ids(self, letters: str) -> bytes:
        return array(self.kind, map(_id, self.model.tokenize(letters))).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._ids(piece.translate(self.letters))

    def _word(self, word: str) -> bytes:
        if not self.marks.isdisjoint(word) and any(t in word for t in self.special):
            return array(self.kind, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if word.isascii():
            bare = word[1:] if word[0] == " " else word
            if bare.isalpha():  # one piece, whose letters stand for themselves
                return self._ids(word if bare is word else self.blank + bare)
            if bare and bare[-1] != " " and bare.isprintable():  # not white space alone
                return b"".join([self.pieces[p] for p in self.cut_ascii(word)])
        return self._mixed(word)

    def _mixed(self, word: str) -> bytes:
        if max(word) < _BEYOND:
            if (word[1:] if word[0] == " " else word).isalpha():
                return self._piece(word)
            return b"".join([self.pieces[p] for p in self.split(word)])
        return b"".join([self._ids(p) for p, _ in self.cut(word)])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        get = self.words.__getitem__
        return [b"".join(map(get, _PIECE.findall(t))) if t else b"" for t in texts]


@cache
def encoder(path: str, width: int) -> Encoder:
    """One encoder for all tasks of a worker, so that what it has looked up serves them all."""
    return Encoder(path, width)


# Elias-Fano


def _pack(values: np.ndarray, bits: int) -> bytes:
    if not bits:
        return b""
    planes = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def encode_boundaries(bounds: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Low bits per value, low part, high part and samples of ascending numbers that start at 0."""
    n, last = len(bounds), int(bounds[-1])
    low = max(0, (last // n).bit_length() - 1) if last else 0
    bounds = bounds.astype(np.uint64)
    places = (bounds >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros((int(places[-1]) >> 3) + 1 << 3, np.uint8)
    high[places] = 1
    lows = _pack(bounds & np.uint64((1 << low) - 1), low)
    return low, lows, np.packbits(high, bitorder="little").tobytes(), places[::SAMPLE].astype("<u4").tobytes()


_ONES = np.array([bin(x).count("1") for x in range(256)], dtype=np.uint8)


class Boundaries:
    """Random access to encoded boundaries: no table of 64-bit offsets is kept."""

    def __init__(self, n: int, low: int, data: bytes):
        split = (n * low + 7) // 8
        samples = 4 * -(-n // SAMPLE)
        self.n, self.low = n, low
        self.lows = np.frombuffer(data, np.uint8, split)
        self.high = np.frombuffer(data, np.uint8, len(data) - split - samples, split)
        self.samples = np.frombuffer(data, "<u4", -(-n // SAMPLE), len(data) - samples)

    def select(self, k: int) -> int:
        """Place of the k-th set bit."""
        place = int(self.samples[k // SAMPLE])
        left = k % SAMPLE
        byte, bit = place >> 3, place & 7
        ahead = int(self.high[byte]) >> bit << bit
        while (ones := int(_ONES[ahead])) <= left:
            left -= ones
            byte += 1
            ahead = int(self.high[byte])
        for _ in range(left):
            ahead &= ahead - 1
        return (byte << 3) + (ahead & -ahead).bit_length() - 1

    def __getitem__(self, k: int) -> int:
        at = k * self.low
        part = int.from_bytes(self.lows[at >> 3 : (at + self.low + 7) >> 3].tobytes(), "little") >> (at & 7)
        return (self.select(k) - k << self.low) | (part & ((1 << self.low) - 1))

    def span(self, first: int, end: int) -> np.ndarray:
        """Boundaries ``first`` up to, not including, ``end``: two selects, and the bits between them."""
        if first >= end:
            return np.zeros(0, np.int64)
        begin, last = self.select(first), self.select(end - 1)
        places = np.flatnonzero(np.unpackbits(self.high[begin >> 3 : (last >> 3) + 1], bitorder="little")) + (begin >> 3 << 3)
        places = places[(places >= begin) & (places <= last)]
        high = (places - np.arange(first, end)) << self.low
        if not self.low:
            return high
        at = first * self.low
        bits = np.unpackbits(self.lows[at >> 3 : (end * self.low + 7) >> 3], bitorder="little")[at & 7 :]
        bits = bits[: (end - first) * self.low].reshape(end - first, self.low)
        return high + bits.astype(np.int64) @ (1 << np.arange(self.low, dtype=np.int64))

    def all(self) -> np.ndarray:
        """Every boundary, decoded at once."""
        return self.span(0, self.n)


# Files


def shard_head(n: int, ids: int, low: int, width: int) -> bytes:
    return HEADER.pack(MAGIC, n, ids, low, width)


class Shard:
    """An open shard: boundaries in memory, ids read as they are asked for."""

    def __init__(self, file):
        self.file = file
        magic, self.n, self.ids, low, self.width = HEADER.unpack(file.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        file.seek(HEADER.size + self.ids * self.width)
        self.bounds = Boundaries(self.n + 1, low, file.read())

    def document(self, k: int) -> np.ndarray:
        start, end = self.bounds[k], self.bounds[k + 1]
        self.file.seek(HEADER.size + start * self.width)
        return np.frombuffer(self.file.read((end - start) * self.width), f"<u{self.width}").astype("<u4")

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """First id's number and the ids of each document, read in order."""
        self.file.seek(HEADER.size)
        for at in range(0, self.n, RANGE):
            bounds = self.bounds.span(at, min(at + RANGE, self.n) + 1)
            for start, n in zip(bounds[:-1].tolist(), np.diff(bounds).tolist(), strict=True):
                yield start, np.frombuffer(self.file.read(n * self.width), f"<u{self.width}").astype("<u4")


def _written(folder: str, vocabulary: str, width: int, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Writes the documents of one task as one shard; ids pass through in pieces, only boundaries stay."""
    context = TaskContext.get()
    name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}.tok"
    end = np.array([end_id], f"<u{width}").tobytes()
    made, doc_ids, bounds = None, [], [0]
    for batch in slices(batches, 128):
        if made is None:
            made = encoder(vocabulary, width)
            fs, path = file_system(folder)
            fs.create_dir(path, recursive=True)
            # Ids go first and the header says how many, so they wait beside it until all are known.
            body = fs.open_output_stream(f"{path}/{name}.ids")
        doc_ids += batch.column(0).to_pylist()
        for ids in made.encode(batch.column(1).to_pylist()):
            body.write(ids + end)
            bounds.append(bounds[-1] + len(ids) // width + 1)
    if made is None:
        return
    body.close()
    low, lows, high, samples = encode_boundaries(np.array(bounds, np.int64))
    with fs.open_output_stream(f"{path}/{name}") as file:
        file.write(shard_head(len(doc_ids), bounds[-1], low, width))
        with fs.open_input_stream(f"{path}/{name}.ids") as body:
            while part := body.read(1 << 22):
                file.write(part)
        file.write(lows + high + samples)
    fs.delete_file(f"{path}/{name}.ids")
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([context.partitionId()], pa.int64()),
            pa.array([name]),
            pa.array([len(doc_ids)], pa.int64()),
            pa.array([bounds[-1]], pa.int64()),
            pa.array([doc_ids], pa.list_(pa.int64())),
        ],
        ["shard", "file", "documents", "ids", "doc_ids"],
    )


def write_tokens(
    docs: DataFrame,
    folder: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    width: int | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Write all texts, ascending by id, and return the manifest: ``shard``, ``path``, ``start``, ``documents``, ``ids``, ``doc_ids``.

    A null or empty text is its end id alone. Null ids come first; rows of one id stand together,
    ordered by text. ``width`` is 2 bytes an id where the vocabulary allows it, else 4. A file that a
    lost or repeated attempt left behind is in no manifest row.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    if width is None:
        width = 2 if max(Tokenizer.from_file(vocabulary).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    source = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"))
    size = source.agg(F.sum(F.length("text"))).first()[0] or 0
    # Rows of one id are dealt by their text's hash too, so that an id of a third of all rows isn't one shard.
    source = source.withColumn("h", F.xxhash64("text"))
    ordered = (
        source.repartitionByRange(parts_for(spark, size / 1e6, SHARD_MB), "doc_id", "h")
        .sortWithinPartitions("doc_id", "h", "text")
        .select("doc_id", "text")
    )
    made = staged(
        ordered.mapInArrow(
            partial(_written, folder, vocabulary, width, end_id),
            "shard bigint, file string, documents bigint, ids bigint, doc_ids array<bigint>",
        ),
        "manifest",
    )
    # One row a shard; its documents' ids stay out of the window.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = made.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("bigint").alias("start"))
    return made.join(starts, "shard").select(
        "shard", F.concat(F.lit(f"{folder}/"), "file").alias("path"), "start", "documents", "ids", "doc_ids"
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            fs, path = file_system(row["path"])
            with fs.open_input_file(path) as file:
                shard = Shard(file)
                if (shard.n, shard.ids) != (row["documents"], row["ids"]):
                    raise ValueError(f"{row['path']} is not the file of its manifest row")
                found = [(start, len(ids), zlib.crc32(ids)) for start, ids in shard.documents()]
            starts, counts, sums = (np.array(c, np.int64) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"]), pa.array(counts), pa.array(sums)],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Per document from the files: ids before it, its ids with the end id, and their checksum as 32-bit numbers."""
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(parts, "shard").mapInArrow(
        _read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
