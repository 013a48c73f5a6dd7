"""Token ids as binary files, with document boundaries in Elias-Fano code.

Every whole text is encoded and its ids get the end id. Documents are dealt out
by ranges of their id, so file after file holds them in ascending order. A file
is one block of at most about ``IDS`` ids (or one longer document):

* header: magic, version, bytes of an id, partition, number in the partition,
  documents, of these without an id, ids, least document id, bytes of the two
  codes;
* Elias-Fano code of the document ids less the least one (those without an
  id come first and have no entry);
* Elias-Fano code of the documents' ends in the id array;
* all ids, as unsigned little-endian integers of 2 or 4 bytes, by vocabulary.

The code of ``n`` ascending numbers up to ``u`` keeps the ``log2(u / n)`` low bits of each
as they are and the rest in unary, ``2 + log2(u / n)`` bits a number; the place
of every ``SAMPLE``-th one bit (32 bits) lets ``select`` find any number without
reading those before it. There is no table of 64-bit offsets.

Files go through Spark's text writer, one row and a newline a file, so they are
committed with the tasks that wrote them, and are read as binary files by any
path that Spark can read.

A null or empty text is the end id alone. Null ids (also those that are no
integer) come first. Documents of equal id are ordered by a hash of the text;
repeated rows are documents of their own. An empty table has no file. Other
columns are left alone.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb
from riskloom.llm.running import running
from riskloom.llm.segments import ByteLevel, Kept, for_worker
from riskloom.llm.shared import stored

MODEL = "byte_bpe_50k.json"
END = 0
IDS = 1 << 22  # ids of a file
DOCS = 1 << 18
CHUNK = 1 << 21  # bytes encoded at once
SAMPLE = 256
HEADER = "<4sBBHqqqqqqqq"
CODE = "<qBxxxxxxxqq"
MAGIC = b"EFID"


class EliasFano:
    """An ascending sequence of non-negative integers in near-minimal space."""

    def __init__(self, raw: bytes):
        self.n, self.low_bits, self.n_low, self.n_high = struct.unpack_from(CODE, raw)
        at = struct.calcsize(CODE)
        self.low = np.frombuffer(raw, np.uint8, self.n_low + 8, at)
        self.high = np.frombuffer(raw, np.uint8, self.n_high, at + self.n_low + 8)
        self.sample = np.frombuffer(raw, "<u4", -(-self.n // SAMPLE), at + self.n_low + 8 + self.n_high)

    @staticmethod
    def pack(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return struct.pack(CODE, 0, 0, 0, 0) + bytes(8)
        bits = min(56, max(0, int(values[-1] // n).bit_length() - 1))  # a place's low bits fit 8 bytes from any bit on
        ones = (values >> bits) + np.arange(n)
        high = np.zeros(int(ones[-1]) // 8 + 1, np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        rest = ((values[:, None] >> np.arange(bits)) & 1).astype(np.uint8)
        low = np.packbits(rest.ravel(), bitorder="little").tobytes()
        return b"".join([struct.pack(CODE, n, bits, len(low), len(high)), low, bytes(8), high.tobytes(), ones[::SAMPLE].astype("<u4").tobytes()])

    def select(self, i: np.ndarray) -> np.ndarray:
        """Numbers at places ``i``."""
        i = np.asarray(i, np.int64)
        high = np.zeros(len(i), np.int64)
        by = np.argsort(i // SAMPLE, kind="stable")
        blocks, begin = np.unique(i[by] // SAMPLE, return_index=True)
        for b, x, y in zip(blocks.tolist(), begin.tolist(), np.append(begin, len(i))[1:].tolist(), strict=True):
            a = int(self.sample[b])
            end = int(self.sample[b + 1]) if b + 1 < len(self.sample) else 8 * len(self.high)
            ones = np.flatnonzero(np.unpackbits(self.high[a >> 3: (end + 7) >> 3], bitorder="little")) + (a >> 3 << 3)
            mine = by[x:y]
            high[mine] = ones[np.searchsorted(ones, a) + i[mine] % SAMPLE] - i[mine]
        if not self.low_bits:
            return high
        at = i * self.low_bits
        word = np.zeros(len(i), np.uint64)
        for k in range(8):
            word |= self.low[(at >> 3) + k].astype(np.uint64) << np.uint64(8 * k)
        low = (word >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)
        return (high << self.low_bits) | low.astype(np.int64)


def block(part: int, number: int, doc_ids: list, ends: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    """A file's bytes. Document ids ascend, with nulls first; ``ends`` are the documents' ends in ``ids``."""
    known = [x for x in doc_ids if x is not None]
    least = known[0] if known else 0
    plain = bool(known) and known[-1] - least >= 1 << 62  # such a span has no code of 63 bits
    by_id = np.array(known, "<i8").tobytes() if plain else EliasFano.pack(np.array([x - least for x in known], np.int64))
    by_end = EliasFano.pack(ends)
    head = struct.pack(HEADER, MAGIC, 1, width, plain, part, number, len(doc_ids), len(doc_ids) - len(known), len(ids), least, len(by_id), len(by_end))
    return b"".join([head, by_id, by_end, np.asarray(ids).astype(f"<u{width}").tobytes()])


def unblock(raw: bytes):
    """Partition, number, document ids, ends and ids of a file's bytes."""
    magic, version, width, plain, part, number, n, without, n_ids, least, size_id, size_end = struct.unpack_from(HEADER, raw)
    if magic != MAGIC or version != 1:
        raise ValueError("not a file of token ids")
    at = struct.calcsize(HEADER)
    if plain:
        known = np.frombuffer(raw, "<i8", n - without, at).tolist()
    else:
        known = (EliasFano(raw[at: at + size_id]).select(np.arange(n - without)) + least).tolist()
    ends = EliasFano(raw[at + size_id: at + size_id + size_end]).select(np.arange(n))
    return part, number, [None] * without + known, ends, np.frombuffer(raw, f"<u{width}", n_ids, at + size_id + size_end)


def _block_rows(model: str, end_id: int, size: int):
    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tb.lean()
        part = TaskContext.get().partitionId()
        kept = for_worker(f"ids_{hash(model)}", lambda: Kept(ByteLevel(model, plain_specials=False)))
        width = 2 if len(kept.library.table) <= 1 << 16 else 4
        doc_ids, counts, parts, held, number = [], [], [], 0, 0

        def flushed():
            raw = block(part, number, doc_ids, np.cumsum(np.concatenate(counts)), np.concatenate(parts), width)
            return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["value"])

        for b in batches:
            of = b.column(0).to_pylist()
            for r0, r1, data, offsets in tb.chunks(b.column(1), CHUNK):
                ids, first, _ = kept.encode(data, offsets)
                count = np.diff(first)
                out = np.full(len(ids) + r1 - r0, end_id, f"<u{width}")
                out[np.arange(len(ids)) + np.repeat(np.arange(r1 - r0), count)] = ids
                doc_ids += of[r0:r1]
                counts.append(count + 1)
                parts.append(out)
                held += len(out)
                if held >= size or len(doc_ids) >= DOCS:
                    yield flushed()
                    doc_ids, counts, parts, held, number = [], [], [], 0, number + 1
        if doc_ids:
            yield flushed()
    return run


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
          end_id: int = END, size: int = IDS) -> None:
    """Encode all texts and write the files below ``path``, which must not be there."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(MODEL)
    with open(vocabulary, encoding="utf-8") as f:
        model = f.read()  # 1.5 MB; goes to the tasks, which need no file
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    given = docs.select(F.col(f"`{id_col}`").try_cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    dealt = given.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    rows = dealt.mapInArrow(_block_rows(model, end_id, size), "value binary")
    rows.select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def _document_rows(batches):
    tb.lean()
    names = ["part", "number", "doc_id", "local", "n_tokens", "ids"]
    for b in batches:
        for raw in b.column(0):
            part, number, doc_ids, ends, ids = unblock(raw.as_py())
            starts = np.concatenate([[0], ends[:-1]])
            a = 0
            while a < len(doc_ids):
                z = min(len(doc_ids), max(a + 1, int(np.searchsorted(ends, starts[a] + (1 << 20), "right"))))
                body = pa.py_buffer(ids[starts[a]: ends[z - 1]].astype("<u4"))
                offsets = pa.py_buffer((4 * (np.append(starts[a:z], ends[z - 1]) - starts[a])).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(z - a, part)), pa.array(np.full(z - a, number)), pa.array(doc_ids[a:z], pa.int64()), pa.array(starts[a:z]),
                     pa.array(ends[a:z] - starts[a:z]), pa.Array.from_buffers(pa.binary(), z - a, [None, offsets, body])], names=names)
                a = z


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: ``part, number`` (the file), ``doc_id``, ``local`` (its start there), ``n_tokens``, ``ids`` (32-bit little-endian)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_document_rows, "part long, number long, doc_id long, local long, n_tokens long, ids binary")


def with_starts(rows: DataFrame) -> DataFrame:
    """Rows of ``read``, stored, with ``start``: ids of all documents before."""
    totals = stored(rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n")), "file-totals")
    bases = running(totals, [], ["part", "number"], {"upto": "n"}, "file-starts").select("part", "number", (F.col("upto") - F.col("n")).alias("base"))
    return rows.join(bases, ["part", "number"]).withColumn("start", F.col("base") + F.col("local")).drop("base")
