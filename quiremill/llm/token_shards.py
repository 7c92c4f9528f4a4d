"""Training-order materialisation of token ids.

1. Each task encodes whole texts, ends each with an end-of-text id, and cuts the stream of its
   documents into sequences of ``seq_len`` ids, staged once in the shared folder.
2. A sequence's index is its file's offset plus its row in the file.  A keyed Feistel network over
   the least even-bit power of two that holds all N indices permutes them; a value of N or more is
   sent through the network again until it is below N (cycle walking), so the result is a
   permutation of exactly 0 .. N-1: the slot.  Nothing is sorted or sampled to shuffle the corpus.
3. Slots are cut into ranges, one partition and one file per range, so sequences are shuffled once,
   compressed, straight to their place.  A shard is a header and records of fixed stride: the
   sequence at a slot is at a known offset, and a reader resumes at any slot by a seek.  A writer
   that runs again in a folder takes the sequences that are complete and keeps each shard whose size
   and header (key, number of slots, marks of sequences and vocabulary) are as they would be.

Each step reads a staged table, so a lost executor repeats tasks, not the encoding of the corpus.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiremill.llm.common import new_folder, split_hint, table

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The usual pattern that parts a text into pieces for byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = 50256
MAGIC = b"QMSHARD1"
#: Magic, ids a record, bytes an id, first slot, slots, key, slots of all shards, marks of the sequences and of the vocabulary.
HEADER = "<8sIIQQQQQ8s"
#: At most so many partitions write shards; one writes several in a row if there are more.
WRITERS = 20_000
HEADER_SIZE = struct.calcsize(HEADER)
_encoders: dict[str, object] = {}


def _encoder(path: str):
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


# -- the permutation --------------------------------------------------------------------------


def _round(half: np.ndarray, key: int, number: int) -> np.ndarray:
    u = np.uint64
    x = half + u((key ^ (number + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
    return x ^ (x >> u(31))


def feistel(x: np.ndarray, half_bits: int, key: int, rounds: int = 6, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of the numbers of ``2 * half_bits`` bits."""
    u = np.uint64
    mask = u((1 << half_bits) - 1)
    a, b = x.astype(u) >> u(half_bits), x.astype(u) & mask
    for r in range(rounds):
        if inverse:
            a, b = b ^ (_round(a, key, rounds - 1 - r) & mask), a
        else:
            a, b = b, a ^ (_round(b, key, r) & mask)
    return a << u(half_bits) | b


def permute(x: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of 0 .. n-1, by cycle walking; fewer than four steps on average."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    y = feistel(x, half, key, inverse=inverse)
    while len(out := np.flatnonzero(y >= n)):
        y[out] = feistel(y[out], half, key, inverse=inverse)
    return y


# -- the steps --------------------------------------------------------------------------------


def _pack(vocabulary: str, seq_len: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        parts: list[np.ndarray] = []
        owners: list[tuple[int, int | None]] = []  # (end of the document in what is held, id)
        held = 0

        def cut(k: int) -> Iterator[pa.RecordBatch]:
            """Emit k sequences from what is held, the last one filled up with ``end``."""
            nonlocal parts, owners, held
            flat = np.concatenate(parts)
            used = min(held, k * seq_len)
            full = np.full(k * seq_len, end, np.uint16)
            full[:used] = flat[:used]
            ends = np.array([e for e, _ in owners])
            ids = pa.array([i for _, i in owners], pa.int64())
            lo = np.searchsorted(ends, np.arange(k) * seq_len, "right")
            hi = np.searchsorted(ends, np.minimum((np.arange(k) + 1) * seq_len, used), "left") + 1
            at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi, strict=True)])
            docs = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(hi - lo))).astype(np.int32)), ids.take(pa.array(at)))
            n = np.minimum(seq_len, used - np.arange(k) * seq_len)
            yield pa.RecordBatch.from_arrays([pa.array([full[i * seq_len : (i + 1) * seq_len].tobytes() for i in range(k)], pa.binary()), pa.array(n.astype(np.int32)), docs], ["tokens", "n_tokens", "doc_ids"])
            parts, held = ([flat[used:]] if used < held else []), held - used
            owners = [(e - used, i) for e, i in owners if e > used]

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                ids = encoder.encode_to_numpy(text)
                if len(ids) and ids.max() > 0xFFFF:
                    raise ValueError(f"id {ids.max()} doesn't fit two bytes")
                parts.append(np.append(ids, end).astype(np.uint16))
                held += len(ids) + 1
                owners.append((held, doc))
                if held >= 64 * seq_len:
                    yield from cut(held // seq_len)
        if held:
            yield from cut(-(-held // seq_len))

    return run


def encode_sequences(docs: DataFrame, folder: str, id_col: str, text_col: str, vocabulary: str, seq_len: int, end: int) -> DataFrame:
    rows = split_hint(docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t")))
    out = rows.mapInArrow(_pack(vocabulary, seq_len, end), "tokens binary, n_tokens int, doc_ids array<long>")
    files, root = fs.FileSystem.from_uri(folder)
    if files.get_file_info(f"{root}/_SUCCESS").type == fs.FileType.NotFound:
        out.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(out.schema).parquet(folder)


def with_slots(seqs: DataFrame, key: int) -> tuple[DataFrame, int, int]:
    """Staged sequences with their ``slot``, ids compressed; how many there are; and a mark of their files."""
    named = seqs.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = named.groupBy("file").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    offsets = files.select("file", before.alias("before"), "n")
    n_files, total, mark = offsets.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.bit_xor(F.xxhash64("file", "before")), F.lit(0))).first()
    # one row per file: a broadcast only while that is a few MB
    joined = named.join(F.broadcast(offsets) if n_files <= 50_000 else offsets, "file").select((F.col("before") + F.col("row")).alias("i"), "tokens", "n_tokens", "doc_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            slot = permute(batch.column(0).to_numpy().astype(np.uint64), total, key).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array([squeeze(x) for x in batch.column(1).to_pylist()], pa.binary()), batch.column(2), batch.column(3)], ["slot", "z", "n_tokens", "doc_ids"])

    return split_hint(joined).mapInArrow(run, "slot long, z binary, n_tokens int, doc_ids array<long>"), int(total), int(mark) & (2**64 - 1)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


class _Shards:
    """Takes records in the order of slots and writes the shards that aren't whole yet."""

    def __init__(self, folder: str, seq_len: int, per_shard: int, total: int, marks: tuple[int, int, bytes], attempt: int):
        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.seq_len, self.per_shard, self.total, self.marks, self.attempt = seq_len, per_shard, total, marks, attempt
        self.out, self.next, self.end = None, -1, -1
        self.files.create_dir(self.root, recursive=True)

    def _begin(self, shard: int) -> None:
        self.next = shard * self.per_shard
        count = min(self.per_shard, self.total - self.next)
        self.end, self.name = self.next + count, f"{self.root}/{shard_name(shard)}"
        key, mark, vocabulary = self.marks
        header = struct.pack(HEADER, MAGIC, self.seq_len, 2, self.next, count, key & (2**64 - 1), self.total, mark, vocabulary)
        if self.files.get_file_info(self.name).size == HEADER_SIZE + count * 2 * self.seq_len:
            with self.files.open_input_file(self.name) as f:
                if f.read(HEADER_SIZE) == header:
                    return
        self.temp = f"{self.name}.{self.attempt}.tmp"
        self.out = self.files.open_output_stream(self.temp, compression=None)
        self.out.write(header)

    def add(self, slot: int, record: bytes) -> None:
        if self.next == self.end:
            self._begin(slot // self.per_shard)
        if slot != self.next:
            raise ValueError(f"slot {self.next} is missing before {slot}")
        if self.out:
            self.out.write(record)
        self.next += 1
        if self.next == self.end and self.out:
            self.out.close()
            self.files.move(self.temp, self.name)
            self.out = None

    def close(self) -> None:
        if self.next != self.end:
            raise ValueError(f"slot {self.next} is missing")


def _write(folder: str, seq_len: int, per_shard: int, total: int, marks: tuple[int, int, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shards = _Shards(folder, seq_len, per_shard, total, marks, TaskContext.get().taskAttemptId())
        open_up = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            at, sums = batch.column(0).to_numpy(), []
            for slot, z in zip(at.tolist(), batch.column(1).to_pylist(), strict=True):
                record = open_up(z)
                sums.append(int(np.frombuffer(record, np.uint16).astype(np.int64).sum()))
                shards.add(slot, record)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(at // per_shard), pa.array(HEADER_SIZE + at % per_shard * 2 * seq_len), batch.column(2), batch.column(3), pa.array(sums, pa.int64())], ["slot", "shard", "byte_offset", "n_tokens", "doc_ids", "id_sum"])
        shards.close()

    return run


def corpus_mark(docs: DataFrame, id_col: str, text_col: str) -> str:
    """A digest of the ids and texts of all rows, in whatever order they come."""
    h = [F.xxhash64(F.lit(seed), id_col, text_col).cast("decimal(20,0)") for seed in ("one", "two")]
    return "|".join(map(str, docs.agg(F.count("*"), *[F.coalesce(F.sum(x), F.lit(0)) for x in h]).first()))


def write_shards(docs: DataFrame, folder: str, key: int, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, seq_len: int = 2048, end: int = END_OF_TEXT, shard_bytes: int = 16 << 20) -> DataFrame:
    """Write shards to ``folder`` (a uri all executors reach); one row per sequence, in no order.

    Columns: ``slot``, ``shard``, ``byte_offset`` in its file, ``n_tokens`` (without filling),
    ``doc_ids`` (documents in the sequence, in order) and ``id_sum`` (sum of the stored ids).
    Documents with a null or empty text are in no sequence; a null id is kept as null; repeated
    rows are encoded as often as they occur.  Only a task's last sequence is filled up, with
    ``end``.  No documents give no shards.  Ids have two bytes: one over 65,535 is an error.

    A folder belongs to one corpus (ids and texts), vocabulary (its bytes), ``seq_len`` and ``end``; with others it is an error.
    The vocabulary's path must be readable on driver and executors.
    A second call goes on where the first one stopped; with another key it replaces the shards.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        vocabulary_mark = hashlib.file_digest(f, "md5").hexdigest()
    about = hashlib.md5(f"{vocabulary_mark}|{seq_len}|{end}|{corpus_mark(docs, id_col, text_col)}".encode()).hexdigest()
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    if files.get_file_info(f"{root}/parameters").type == fs.FileType.NotFound:
        with files.open_output_stream(f"{root}/parameters", compression=None) as f:
            f.write(about.encode())
    with files.open_input_stream(f"{root}/parameters", compression=None) as f:
        if f.read().decode() != about:
            raise ValueError(f"{folder} was written with another corpus, vocabulary, length or end")
    seqs = encode_sequences(docs, f"{folder}/sequences", id_col, text_col, vocabulary, seq_len, end)
    placed, total, mark = with_slots(seqs, key)
    per_shard = max(1, shard_bytes // (2 * seq_len))
    shards = max(1, -(-total // per_shard))
    in_a_row = -(-shards // WRITERS)
    ranged = placed.repartitionById(-(-shards // in_a_row), (F.col("slot") / (per_shard * in_a_row)).cast("int")).sortWithinPartitions("slot")
    write = _write(f"{folder}/shards", seq_len, per_shard, total, (key, mark, bytes.fromhex(about)[:8]))
    rows = ranged.mapInArrow(write, "slot long, shard long, byte_offset long, n_tokens int, doc_ids array<long>, id_sum long")
    rows.write.mode("overwrite").parquet(f"{folder}/index")
    return spark.read.schema(rows.schema).parquet(f"{folder}/index")


def read_slots(folder: str, start: int, stop: int) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, ids) from ``start`` up to ``stop`` in order, by one seek per shard."""
    files, root = fs.FileSystem.from_uri(f"{folder}/shards")
    slot = start
    per_shard = None
    while slot < stop:
        if per_shard is None:
            with files.open_input_file(f"{root}/{shard_name(0)}") as f:
                per_shard = struct.unpack(HEADER, f.read(HEADER_SIZE))[4]
        with files.open_input_file(f"{root}/{shard_name(slot // per_shard)}") as f:
            magic, seq_len, width, first, count, *_ = struct.unpack(HEADER, f.read(HEADER_SIZE))
            if magic != MAGIC:
                raise ValueError("not a shard")
            f.seek(HEADER_SIZE + (slot - first) * seq_len * width)
            last = min(stop, first + count)
            while slot < last:
                yield slot, np.frombuffer(f.read(seq_len * width), np.uint16)
                slot += 1
            if slot < stop and count < per_shard:
                return


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_shards(table(spark, sf_dir, "documents"), new_folder(spark, "shards"), key=20260101)
