"""Token ids as fixed-width bit-packed binary files.

Every id takes the minimum number of bits for its vocabulary.  A file is a
sequence of frames, each followed by one line feed:

    magic "TIDB", u16 version, u16 bits, u32 shard, u32 frame number,
    u32 documents, u32 blocks, u32 ids per block, u64 ids, u64 frame bytes,
    i64 document ids[documents], u64 document ends[documents],
    u64 block offsets[blocks + 1], packed blocks

(little-endian; document ends count ids within the frame, block offsets bytes
behind the header).  Blocks start at byte borders and ids have a fixed width,
so id i lies in block i // size at a known bit and a numpy shift-and-mask reads
whole blocks at once.  Documents never cross frames; shards, frames and
documents are in ascending id order.

Writing: texts are encoded where they are read, the packed ids are shuffled
once into id ranges, sorted there, framed in a stream, and written by Spark's
own text sink (raw bytes, one frame per row), so writes are committed like any
Spark job and survive lost executors.  Reading goes through Spark's
``binaryFile`` source; files hold a bounded number of frames.

Edge cases: a null text has only the end id; a null document id is stored as
the largest 64-bit integer, so it comes last, and is read back as null;
repeated ids are ordered by their packed content; an empty table writes no
frame and reads back empty; a long document makes one long frame; extra input
columns are ignored.
"""

from __future__ import annotations

import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unitcast.llm import common

MAGIC = b"TIDB"
VERSION = 1
HEAD = struct.Struct("<4sHHIIIIIQQ")
BLOCK_IDS = 4096             # ids per block; a multiple of 8, so blocks end at byte borders
FRAME_IDS = 1 << 18          # a frame is closed once it holds so many ids
FRAMES_PER_FILE = 32
CACHE_WORDS = 350_000        # words that a worker remembers at least


def width(vocabulary: int) -> int:
    """Bits needed for ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


#: Widths that are whole machine words: fields are a plain array.
ALIGNED = {8: np.dtype("<u1"), 16: np.dtype("<u2"), 32: np.dtype("<u4")}


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits``-wide little-endian fields, padded with zeros to a byte."""
    if bits in ALIGNED:
        return np.asarray(ids).astype(ALIGNED[bits]).tobytes()
    n = len(ids)
    lanes = np.zeros(-(-n // 8) * 8, dtype=np.uint64)
    lanes[:n] = ids
    lanes = lanes.reshape(-1, 8)
    out = np.zeros((len(lanes), bits), dtype=np.uint8)
    for lane in range(8):
        at, shift = divmod(lane * bits, 8)
        field = lanes[:, lane] << np.uint64(shift)
        for k in range((shift + bits + 7) // 8):
            out[:, at + k] |= ((field >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8)
    return out.tobytes()[:-(-n * bits // 8)]


def unpack(data, bits: int, count: int, start: int = 0) -> np.ndarray:
    """``count`` ids from id ``start`` on (uint32)."""
    if bits in ALIGNED:
        return np.frombuffer(data, ALIGNED[bits], count, start * bits // 8).astype(np.uint32)
    first = start // 8
    rows = -(-(start + count) // 8) - first
    raw = np.zeros(rows * bits, dtype=np.uint8)
    part = np.frombuffer(data, dtype=np.uint8)[first * bits:(first + rows) * bits]
    raw[:len(part)] = part
    raw = raw.reshape(-1, bits)
    out = np.empty((rows, 8), dtype=np.uint32)
    for lane in range(8):
        at, shift = divmod(lane * bits, 8)
        field = np.zeros(rows, dtype=np.uint64)
        for k in range((shift + bits + 7) // 8):
            field |= raw[:, at + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (field >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.reshape(-1)[start - 8 * first:][:count]


class Frame:
    """One frame of a file; ids are unpacked when asked for."""

    def __init__(self, data, offset: int = 0):
        (magic, version, self.bits, self.shard, self.number, docs, blocks, self.block_ids, self.n_ids,
         self.length) = HEAD.unpack_from(data, offset)
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"no frame at byte {offset}")
        view = memoryview(data)[offset:offset + self.length]
        at = HEAD.size
        self.doc_ids = np.frombuffer(view, "<i8", docs, at)
        self.ends = np.frombuffer(view, "<u8", docs, at + 8 * docs).astype(np.int64)
        self.offsets = np.frombuffer(view, "<u8", blocks + 1, at + 16 * docs)
        self.payload = view[at + 16 * docs + 8 * (blocks + 1):]

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start .. stop of the frame; only the blocks that hold them are read."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if stop <= start:
            return np.empty(0, dtype=np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        part = self.payload[int(self.offsets[first]):int(self.offsets[last + 1])]
        return unpack(part, self.bits, stop - start, start - first * self.block_ids)


def frames(data) -> Iterator[tuple[int, Frame]]:
    """(byte offset, frame) of each frame of a file."""
    at = 0
    while at < len(data):
        frame = Frame(data, at)
        yield at, frame
        at += frame.length + 1


def frame_bytes(shard: int, number: int, doc_ids: list[int], docs: list[np.ndarray], bits: int,
                block_ids: int = BLOCK_IDS) -> bytes:
    return _framed(shard, number, doc_ids, [len(d) for d in docs], pack(np.concatenate(docs) if docs else np.empty(0, np.uint32), bits),
                   bits, block_ids)


def _joined(packed: list[bytes], counts: list[int], bits: int) -> bytes:
    """Packed documents as one run of fields."""
    if bits % 8 == 0:
        return b"".join(packed)
    return pack(np.concatenate([unpack(p, bits, n) for p, n in zip(packed, counts)]), bits)


def _framed(shard: int, number: int, doc_ids: list[int], counts: list[int], payload: bytes, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    ends = np.cumsum(counts, dtype=np.int64)
    n_ids = int(ends[-1]) if len(ends) else 0
    blocks = -(-n_ids // block_ids)
    offsets = np.minimum(np.arange(blocks + 1, dtype=np.int64) * (block_ids * bits // 8), len(payload))
    body = (np.array(doc_ids, "<i8").tobytes() + ends.astype("<u8").tobytes() + offsets.astype("<u8").tobytes()
            + payload)
    return HEAD.pack(MAGIC, VERSION, bits, shard, number, len(counts), blocks, block_ids, n_ids, HEAD.size + len(body)) + body


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if
    it is printable, else the next one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


_LETTERS = _byte_letters()
_SIGNS = frozenset(".,;:!?)|")      # a piece of their own behind letters
_PROBES = ("word", "Word", "été", "ÀÉÎ", "straße", "ñandú", "internationalization", "ªº", "µ", "xyzzyqwrt")


class _Words(common.Recent):
    """Ids of words without blanks, as little-endian fields of ``size`` bytes."""

    def __init__(self, tokenizer, size: int = 4):
        super().__init__()
        self.tokenizer, self.merge = tokenizer, tokenizer.model.tokenize
        self.fields = [i.to_bytes(size, "little") for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
        # letters go straight to the vocabulary's merges if that gives the same ids
        self.direct = all(self._merged(w.lower()) == self._whole(w) for w in _PROBES)

    def entries(self) -> int:
        return CACHE_WORDS

    def _whole(self, word: str) -> bytes:
        return b"".join([self.fields[i] for i in self.tokenizer.encode(word, add_special_tokens=False).ids])

    def _merged(self, low: str) -> bytes:
        if not low.isascii():
            low = "".join([_LETTERS[b] for b in low.encode("utf-8")])
        fields = self.fields
        return b"".join([fields[t.id] for t in self.merge(low)])

    def compute(self, word: str) -> bytes:
        if self.direct and (word.isascii() or max(word) < "\u0130"):
            if word.isalpha():
                low = word.lower()
                return self._merged(low) if low == word else self[low]
            if word[-1:] in _SIGNS and word[:-1].isalpha():
                return self[word[:-1]] + self[word[-1]]
        return self._whole(word)


class WordCoder:
    """Ids by a ``tokenizers`` file whose pieces never contain white space, so
    each word between blanks or line breaks is encoded once and remembered.  A
    text that holds the string of an added token goes to the library whole.

    ``bits``: width of the fields that ``packed`` gives; a byte-aligned width
    is remembered as it is written."""

    def __init__(self, data: bytes, bits: int = 32):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(data.decode("utf-8"))
        self.bits = bits
        self.kind = ALIGNED.get(bits, ALIGNED[32])
        self.words = _Words(self.tokenizer, self.kind.itemsize)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def fields(self, text: str) -> bytes:
        """Ids as fields of ``kind``."""
        if "<" in text or any("<" not in a for a in self.added):
            low = text.lower()
            if any(a in low for a in self.added):
                return self.words._whole(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.fields(text), dtype=self.kind).astype(np.uint32)

    def packed(self, text: str, end_id: int) -> tuple[bytes, int]:
        """(ids and the end id in ``bits``-wide fields, their number)."""
        data = self.fields(text) + end_id.to_bytes(self.kind.itemsize, "little")
        n = len(data) // self.kind.itemsize
        return (data if self.bits in ALIGNED else pack(np.frombuffer(data, self.kind), self.bits)), n


@functools.lru_cache(maxsize=2)
def coder(data: bytes, bits: int = 32) -> WordCoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
    return WordCoder(data, bits)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def write_ids(docs: DataFrame, path: str, end_id: int, tokenizer: str | None = None, id_col: str = "doc_id",
              text_col: str = "text", frame_ids: int = FRAME_IDS, shards: int | None = None) -> None:
    """Encode every text, append ``end_id``, and write the files to ``path``."""
    spark = docs.sparkSession
    with open(tokenizer or default_tokenizer(), "rb") as f:
        data = f.read()
    bits = width(max(coder(data).vocabulary, end_id + 1))
    shared = spark.sparkContext.broadcast(data)
    plain = common.texts(docs, id_col, text_col)
    edges = np.array(common.id_cuts(plain.select("_id"), "_id", shards or common.shuffle_partitions(spark)), "int64")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = coder(shared.value, bits)
        for batch in common.slices(batches):
            packed, counts = zip(*[tool.packed(text.as_py(), end_id) for text in batch.column(1)])
            shard = np.searchsorted(edges, batch.column(0).to_numpy(zero_copy_only=False), side="right")
            yield pa.record_batch([pa.array(shard.astype("int32")), batch.column(0), pa.array(counts, pa.int64()),
                                   pa.array(packed, pa.binary())], names=["shard", "_id", "n", "packed"])

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, number, held, ids, counts, fields = None, 0, 0, [], [], []

        def closed():
            value = _framed(at, number, ids, counts, _joined(fields, counts, bits), bits)
            return pa.record_batch([pa.array([value], pa.binary())], names=["value"])

        for batch in common.slices(batches):
            for shard, i, n, packed in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if ids and (shard != at or held >= frame_ids):
                    yield closed()
                    number, held, ids, counts, fields = number + 1, 0, [], [], []
                if shard != at:
                    at, number = shard, 0
                ids.append(i)
                counts.append(n)
                fields.append(packed)
                held += n
        if ids:
            yield closed()

    (plain.mapInArrow(encode, "shard int, _id long, n long, packed binary")
     .repartitionById(len(edges) + 1, F.col("shard"))
     .sortWithinPartitions("shard", "_id", "packed")
     .mapInArrow(frame, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", FRAMES_PER_FILE).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def frame_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per frame: file, byte offset, shard, frame number, first and
    last document, counts, and ``start`` (ids in all frames before it)."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p, at, f.shard, f.number, int(f.doc_ids[0]), int(f.doc_ids[-1]), len(f.doc_ids), f.n_ids)
                    for p, data in zip(batch.column(0).to_pylist(), batch.column(1))
                    for at, f in frames(data.as_buffer())]
            names = ["path", "offset", "shard", "frame", "first_doc", "last_doc", "n_docs", "n_ids"]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 4]
            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    found = _files(spark, path).select("path", "content").mapInArrow(
        heads, "path string, offset long, shard int, frame int, first_doc long, last_doc long, n_docs long, n_ids long")
    return common.running_starts(common.stored(found, "frame-index"), "shard", "frame", "n_ids", "start")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens,
    and its ids as little-endian unsigned 32-bit integers."""

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                for _, f in frames(data.as_buffer()):
                    ids, begins = f.ids(), np.concatenate([[0], f.ends[:-1]]).astype(np.int64)
                    n = len(begins)
                    yield pa.record_batch(
                        [pa.array(np.full(n, f.shard, "int32")), pa.array(np.full(n, f.number, "int32")),
                         pa.array(f.doc_ids), pa.array(begins), pa.array(f.ends - begins),
                         pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(begins, f.ends)], pa.binary())],
                        names=["_shard", "_frame", "_id", "_at", "n_tokens", "ids"])

    rows = _files(spark, path).select("content").mapInArrow(
        docs, "_shard int, _frame int, _id long, _at long, n_tokens long, ids binary")
    starts = frame_index(spark, path).select("shard", "frame", "start")
    return (rows.join(starts, (F.col("_shard") == F.col("shard")) & (F.col("_frame") == F.col("frame")))
            .select(common.id_of("_id").alias("doc_id"), (F.col("start") + F.col("_at")).alias("start"), "n_tokens", "ids"))
