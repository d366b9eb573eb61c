"""Token ids in packed binary shards, and their random access.

File format, little-endian throughout::

    magic | blocks | block offsets u64[n_blocks + 1] | doc ids i64[n_docs]
          | null ids, one bit a document | doc starts u64[n_docs + 1] | trailer

A block packs ``block_ids`` ids (the last one fewer) at the fixed width that the
largest id of the vocabulary needs, least significant bit first, padded to a byte.
Block offsets are byte positions in the file, doc starts are ids from the start of
the shard. The trailer holds n_ids, n_docs, n_blocks, block_ids, bits and the
position of the block offsets, then the magic again. Any range of ids is read by
fetching its blocks and unpacking them with numpy.

Shards hold the documents in ascending order of doc_id (null first; rows that
share a doc_id in the order of their texts' hashes). Rows are dealt to shards by
range, so no task sees more than its share, and a task keeps one block of ids and
its document index in memory. A shard's file name carries the task attempt, and
only files of committed attempts get into the manifest, so tasks that are lost and
run again do no harm.

Defined cases: null and empty texts encode to the end id alone; repeated rows are
repeated; an empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import partitions

MAGIC = b"FFTOKB1\n"
TRAILER = struct.Struct("<6Q8s")
BLOCK_IDS = 8192
END_ID = 0
#: Words of a generation whose ids a worker remembers; it remembers two generations.
MEMORY_WORDS = 400_000

# How the byte-level vocabulary cuts a text into words, for texts of
# the characters that both regular-expression engines class alike.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_WORD = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+|'(?:[sdmt]|ll|ve|re)| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_OTHER = re.compile("[^\t\n\x0b\x0c\r\x20-\x7eÀ-ɏ‐-‧]")
_USUAL_ASCII = bytes([9, 10, 11, 12, 13, *range(32, 127)])
_BYTE_LEVEL_CUT = ("ByteLevel", False, True)


def _odd(text: str) -> bool:
    """Whether a text has a character that the engines may class differently."""
    return bool(text.encode().translate(None, _USUAL_ASCII)) if text.isascii() else bool(_OTHER.search(text))


def _byte_alphabet() -> dict[int, int]:
    """Byte-level vocabularies write each byte as a printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


class Encoder:
    """A tokenizer of the tokenizers library, with the ids of words that it has met.

    The library encodes whole texts. For byte-level vocabularies a text's ids are
    its words' ids in a row, so a word needs the library's model once. Texts that hold
    an added token go to the library whole, which gives that token its own id.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_word = self._cuts_like_us()
        self.alphabet = _byte_alphabet()
        self.known = _Known(self)

    def _cuts_like_us(self) -> bool:
        import json

        told = json.loads(self.tokenizer.to_str())
        cut = told.get("pre_tokenizer") or {}
        return told.get("normalizer") is None and told["model"]["type"] == "BPE" and (
            (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == _BYTE_LEVEL_CUT
        )

    def encode(self, text: str) -> np.ndarray:
        if not self.by_word or _odd(text) or any(t in text for t in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if len(self.known) > MEMORY_WORDS:
            self.known.age()
        return np.frombuffer(b"".join(map(self.known.__getitem__, _WORD.findall(text))), dtype="<u4")


class _Known(dict):
    """Ids of a word as bytes; a word that is missing goes through the library's model.

    When a generation is full, it becomes the old one, and words that are met again
    move on from there; so frequent words stay and rare ones are forgotten.
    """

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.tokenize = encoder.tokenizer.model.tokenize
        self.alphabet = encoder.alphabet
        self.old: dict[str, bytes] = {}

    def age(self) -> None:
        self.old = dict(self)
        self.clear()

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            tokens = self.tokenize(word.encode().decode("latin-1").translate(self.alphabet))
            ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        self[word] = ids
        return ids


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def width(vocabulary: int) -> int:
    """Bits that the largest id of a vocabulary needs."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    return np.packbits(np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=count).astype("<u4")
    wide = np.zeros((count, 32), dtype=np.uint8)
    wide[:, :bits] = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class ShardWriter:
    def __init__(self, stream: pa.NativeFile, bits: int, block_ids: int = BLOCK_IDS) -> None:
        self.stream, self.bits, self.block_ids = stream, bits, block_ids
        self.stream.write(MAGIC)
        self.offsets, self.at = [len(MAGIC)], len(MAGIC)
        self.doc_ids: list[int | None] = []
        self.starts = [0]
        self.pending: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.starts[-1] + len(ids))
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= 32 * self.block_ids:
            self._flush(whole=True)

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.empty(0, "<u4")
        upto = len(ids) // self.block_ids * self.block_ids if whole else len(ids)
        for a in range(0, upto, self.block_ids):
            data = pack(ids[a : min(a + self.block_ids, upto)], self.bits)
            self.stream.write(data)
            self.at += len(data)
            self.offsets.append(self.at)
        self.pending = [ids[upto:].copy()]
        self.held = len(ids) - upto

    def close(self) -> None:
        self._flush(whole=False)
        null = np.array([d is None for d in self.doc_ids], dtype=np.uint8)
        self.stream.write(np.array(self.offsets, dtype="<u8").tobytes())
        self.stream.write(np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes())
        self.stream.write(np.packbits(null, bitorder="little").tobytes())
        self.stream.write(np.array(self.starts, dtype="<u8").tobytes())
        self.stream.write(TRAILER.pack(self.starts[-1], len(self.doc_ids), len(self.offsets) - 1, self.block_ids, self.bits, self.at, MAGIC))
        self.stream.close()


class ShardReader:
    """Random access to one shard's ids and documents."""

    def __init__(self, path: str) -> None:
        store, at = pyarrow.fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(at)
        size = self.file.size()
        n_ids, n_docs, n_blocks, self.block_ids, self.bits, footer, magic = TRAILER.unpack(self._read(size - TRAILER.size, TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no shard of token ids")
        self.n_ids, self.n_docs = n_ids, n_docs
        rest = memoryview(self._read(footer, size - TRAILER.size - footer))
        a, b, c = 8 * (n_blocks + 1), 8 * n_docs, (n_docs + 7) // 8
        self.offsets = np.frombuffer(rest[:a], dtype="<u8").astype(np.int64)
        self.doc_ids = np.frombuffer(rest[a : a + b], dtype="<i8")
        self.null = np.unpackbits(np.frombuffer(rest[a + b : a + b + c], dtype=np.uint8), count=n_docs, bitorder="little").astype(bool)
        self.starts = np.frombuffer(rest[a + b + c :], dtype="<u8").astype(np.int64)

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``, of the shard."""
        if stop <= start:
            return np.empty(0, "<u4")
        a, b = start // self.block_ids, (stop - 1) // self.block_ids + 1
        data = memoryview(self._read(int(self.offsets[a]), int(self.offsets[b] - self.offsets[a])))
        out = []
        for k in range(a, b):
            count = min(self.block_ids, self.n_ids - k * self.block_ids)
            x = int(self.offsets[k] - self.offsets[a])
            out.append(unpack(data[x : int(self.offsets[k + 1] - self.offsets[a])], count, self.bits))
        return np.concatenate(out)[start - a * self.block_ids : stop - a * self.block_ids]

    def spans(self, most: int = 1 << 18) -> Iterator[tuple[int, np.ndarray]]:
        """(document, a run of its ids), runs of at most ``most`` ids, in order."""
        doc = 0
        for a in range(0, self.n_ids, most):
            b = min(self.n_ids, a + most)
            got = self.ids(a, b)
            while doc < self.n_docs and self.starts[doc] < b:
                x, y = max(a, int(self.starts[doc])), min(b, int(self.starts[doc + 1]))
                yield doc, got[x - a : y - a]
                if self.starts[doc + 1] > b:
                    break
                doc += 1


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Writes ``docs`` (doc_id, text) as shards below ``path``; returns their manifest.

    The manifest (shard, file, n_docs, n_ids, first_id) lists the committed files in
    order; ``first_id`` counts the ids of all shards before.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{path}/shard-{task.partitionId():06d}-{task.taskAttemptId()}.tok"
        encode = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4")
        writer = None
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if writer is None:
                    store, at = pyarrow.fs.FileSystem.from_uri(name)
                    store.create_dir(at.rpartition("/")[0], recursive=True)
                    writer = ShardWriter(store.open_output_stream(at), width(encode.vocabulary), block_ids)
                writer.add(doc_id, np.concatenate([encode.encode(text.as_py() or ""), end]))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([task.partitionId()], pa.int32()), "file": [name], "n_docs": pa.array([len(writer.doc_ids)], pa.int64()), "n_ids": pa.array([writer.starts[-1]], pa.int64())})

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tie = F.xxhash64("text")
    sorted_docs = plain.repartitionByRange(partitions(spark), "doc_id", tie).sortWithinPartitions("doc_id", tie)
    schema = "shard int, file string, n_docs long, n_ids long"
    sorted_docs.mapInArrow(run, schema).write.parquet(f"{path}/manifest")
    shards = spark.read.schema(schema).parquet(f"{path}/manifest")
    # One row a shard, so one task is enough for the running sum.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_shards(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """One row per document of the shards: doc_id, start, n_tokens, ids_crc32 and ids.

    ``ids`` is left out on demand; then memory is bounded however long a document is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents(ShardReader(row["file"]), row["first_id"], with_ids)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    n = partitions(manifest.sparkSession)
    dealt = manifest.withColumn("deal", F.pmod(F.col("shard"), F.lit(n))).repartitionById(n, "deal")
    return dealt.select("file", "first_id").mapInArrow(run, schema)


def _documents(shard: ShardReader, first_id: int, with_ids: bool, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    crc = np.zeros(shard.n_docs, dtype=np.int64)
    runs: list[np.ndarray] = []
    done = 0

    def batch(upto: int) -> pa.RecordBatch:
        n = np.diff(shard.starts[done : upto + 1])
        columns = [
            pa.array(shard.doc_ids[done:upto], mask=shard.null[done:upto]),
            pa.array(shard.starts[done:upto] + first_id),
            pa.array(n),
            pa.array(crc[done:upto]),
        ]
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        if with_ids:
            flat = np.concatenate(runs) if runs else np.empty(0, "<u4")
            columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat.astype(np.int32))))
            names.append("ids")
            runs.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    held = 0
    for doc, ids in shard.spans():
        if doc - done >= rows or (with_ids and held >= 1 << 20 and doc > done):
            yield batch(doc)
            done, held = doc, 0
        crc[doc] = zlib.crc32(np.ascontiguousarray(ids).data, int(crc[doc]))
        if with_ids:
            runs.append(ids)
            held += len(ids)
    if done < shard.n_docs:
        yield batch(shard.n_docs)
