"""Materialise the order in which a training run reads its sequences.

Texts are tokenised into one stream, each followed by an end token, and the
stream is cut into sequences of equal length. A keyed Feistel permutation gives
sequence i its slot among all N: it permutes the next power of four, and a
result beyond N is permuted again until it falls below (cycle walking). So
every sequence has a slot, no two share one, and neither a sort nor a table of
random numbers is needed. Slots are dense: shard s holds the slots from
``s * shard_slots`` on, one after the other, each with the same number of
bytes. A reader finds a slot by arithmetic and can stop and go on anywhere.

Texts are tokenised once. Tasks write the tokens, compressed, as stretches that
know their place within their input partition; their sizes give every partition
its place in the stream. Then each stretch is cut into sequences, wherever it is
read, and each sequence goes to the partition of its shard. One that crosses
stretches arrives as fragments. The input is evaluated once, so it may be any
frame.

A writer puts its shard into a new file and reports it when it is closed, so a
task that ran twice leaves an unused file and nothing else.

Edge cases: NULL and empty texts consist of the end token. The last sequence is
filled with end tokens. A text of any length spans as many sequences as it
needs; repeated rows are texts like others. An empty table has no sequences. Of
the input only id and text are used, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.arrow import raw_texts, released, slices
from cairn.llm.scratch import discard, stored
from cairn.llm.text import quoted
from cairn.llm.tokens import TYPE, encode, forget
from cairn.llm.warc import opened
from cairn.session import scratch_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
LENGTH = 2048
SHARD_SLOTS = 4096
KEY = 20_240_601
ROUNDS = 6
# Text that is tokenised at once in a task.
PART_BYTES = 4 << 20

# Tokens of a stretch, and how hard stretches and fragments are compressed: long pieces gain by more work.
STRETCH, STRETCH_LEVEL, FRAGMENT_LEVEL = 1 << 17, 9, 3
# Stretches in one file section: readers hold no more of them at once.
SECTION_BYTES = 16 << 20

TOKENS = "part long, at long, n int, tokens binary, doc_ids array<long>, sizes array<int>"
FRAGMENT = "sequence long, slot long, at int, n int, tokens binary, doc_ids array<long>"
KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
# Rows that a task sends at once.
STRETCHES, FRAGMENTS = 32, 256
MANIFEST = (
    "slot long, sequence long, shard long, offset long, n_tokens long, doc_ids array<long>, sha256 string, file string"
)


class Permutation:
    """A keyed permutation of the numbers below ``size``."""

    def __init__(self, size: int, key: int = KEY):
        self.size = size
        self.half = np.uint64(max(1, ((max(size, 2) - 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        digests = (hashlib.blake2b(f"{key}:{r}".encode(), digest_size=8).digest() for r in range(ROUNDS))
        self.keys = [np.uint64(int.from_bytes(d, "little")) for d in digests]

    def _round(self, value: np.ndarray, key: np.uint64) -> np.ndarray:
        mixed = (value ^ key) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return (mixed ^ (mixed >> np.uint64(32))) & self.mask

    def _forth(self, value: np.ndarray) -> np.ndarray:
        left, right = value >> self.half, value & self.mask
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return (left << self.half) | right

    def _back(self, value: np.ndarray) -> np.ndarray:
        left, right = value >> self.half, value & self.mask
        for key in reversed(self.keys):
            left, right = right ^ self._round(left, key), left
        return (left << self.half) | right

    def _walk(self, step, values: np.ndarray) -> np.ndarray:
        out = step(np.asarray(values).astype(np.uint64))
        while len(beyond := np.flatnonzero(out >= self.size)):
            out[beyond] = step(out[beyond])
        return out.astype(np.int64)

    def slots(self, sequences: np.ndarray) -> np.ndarray:
        return self._walk(self._forth, sequences)

    def sequences(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(self._back, slots)


def tokenised(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Id and tokens of each text, the end token included."""
    for batch in batches:
        for part in slices(batch, "text", PART_BYTES):
            ids, found = part.column("doc_id").to_pylist(), encode(raw_texts(part.column("text")), vocabulary)
            for doc_id, tokens in zip(ids, found, strict=True):
                yield doc_id, np.append(tokens, np.uint16(END))


def stretches(texts: Iterator[tuple[int | None, np.ndarray]]) -> Iterator[tuple]:
    """A partition's stream in pieces: where each begins, its tokens, and the texts and how many tokens they have in it."""
    held, ids, size, at = [], [], 0, 0
    for doc_id, tokens in texts:
        done = 0
        while done < len(tokens):
            part = tokens[done : done + STRETCH - size]
            held.append(part)
            ids.append(doc_id)
            size, done = size + len(part), done + len(part)
            if size == STRETCH:
                yield at, np.concatenate(held), ids, [len(h) for h in held]
                held, ids, size, at = [], [], 0, at + size
    if held:
        yield at, np.concatenate(held), ids, [len(h) for h in held]


def fragments(start: int, tokens: np.ndarray, ids: list, sizes: list[int], length: int, order: Permutation) -> Iterator[tuple]:
    """The parts of sequences that a stretch makes up, from its place in the stream on."""
    first, stop, ends = start // length, start + len(tokens), np.cumsum(sizes)
    slots = order.slots(np.arange(first, -(-stop // length))).tolist()
    for sequence, slot in enumerate(slots, first):
        a, b = max(start, sequence * length) - start, min(stop, (sequence + 1) * length) - start
        inside = ids[int(np.searchsorted(ends, a, "right")) : int(np.searchsorted(ends, b, "left")) + 1]
        yield sequence, slot, (start + a) % length, tokens[a:b], list(dict.fromkeys(i for i in inside if i is not None))


def _batches(rows: Iterator[tuple], schema: str, most: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most that many each."""
    fields = [f.split() for f in schema.split(", ")]
    while some := list(islice(rows, most)):
        columns = [pa.array([r[i] for r in some], KINDS[kind]) for i, (_, kind) in enumerate(fields)]
        yield pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def _packed(tokens: np.ndarray, level: int) -> bytes:
    return pa.Codec("zstd", level).compress(tokens.tobytes(), asbytes=True)


def _unpacked(packed: bytes, n: int) -> bytes:
    return pa.Codec("zstd").decompress(packed, n * np.dtype(TYPE).itemsize, asbytes=True)


def materialise(
    docs: DataFrame,
    folder: str,
    id_column: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    shard_slots: int = SHARD_SLOTS,
    key: int = KEY,
    vocabulary: str = VOCABULARY,
    table: bool = True,
) -> DataFrame:
    """Write the shards below the folder; the manifest, a row per slot.

    ``table`` tells whether the input is a table scan; it makes no difference.
    """
    chosen = docs.select(F.col(quoted(id_column)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        found = stretches(tokenised(batches, vocabulary))
        rows = ((part, at, len(t), _packed(t, STRETCH_LEVEL), ids, sizes) for at, t, ids, sizes in found)
        yield from _batches(rows, TOKENS, STRETCHES)
        forget()

    held = stored(chosen.mapInArrow(released(tokenise), TOKENS), "order-tokens", **{"parquet.block.size": SECTION_BYTES})
    manifest = _placed(held, folder, length, shard_slots, key)
    discard(held)
    return manifest


def _placed(held: DataFrame, folder: str, length: int, shard_slots: int, key: int) -> DataFrame:
    """Cut the stream, whose stretches are written, and write the shards."""
    starts, total = {}, 0
    # Two numbers for each partition of the input.
    for part, n in sorted(held.groupBy("part").agg(F.sum("n")).collect()):
        starts[part] = total
        total += n
    n_sequences = -(-total // length)
    order = Permutation(n_sequences, key)
    shared = held.sparkSession.sparkContext.broadcast(starts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                for part, at, n, packed, ids, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    tokens = np.frombuffer(_unpacked(packed, n), TYPE)
                    for sequence, slot, place, own, who in fragments(shared.value[part] + at, tokens, ids, sizes, length, order):
                        yield sequence, slot, place, len(own), _packed(own, FRAGMENT_LEVEL), who

        yield from _batches(found(), FRAGMENT, FRAGMENTS)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(folder)
        files.create_dir(path)
        rows = (row for batch in batches for row in batch.to_pylist())
        for shard, members in groupby(rows, key=lambda r: r["slot"] // shard_slots):
            found, name = [], f"shard-{shard:08d}-{uuid.uuid4().hex}.bin"
            with files.open_output_stream(f"{path}/{name}", compression=None) as out:
                for slot, parts in groupby(members, key=lambda r: r["slot"]):
                    pieces = list(parts)
                    data = b"".join(_unpacked(p["tokens"], p["n"]) for p in pieces)
                    filled = data + np.full(length - len(data) // 2, END, np.uint16).tobytes()
                    out.write(filled)
                    ids = list(dict.fromkeys(i for p in pieces for i in p["doc_ids"]))
                    digest = hashlib.sha256(filled).hexdigest()
                    offset = slot % shard_slots * 2 * length
                    found.append((slot, pieces[0]["sequence"], shard, offset, len(data) // 2, ids, digest, name))
            kinds = [*[pa.int64()] * 5, pa.list_(pa.int64()), pa.string(), pa.string()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in MANIFEST.split(", ")])

    frame = held.mapInArrow(released(cut), FRAGMENT)
    n_shards = max(1, -(-n_sequences // shard_slots))
    dealt = frame.repartitionById(n_shards, F.floor(F.col("slot") / shard_slots).cast("int"))
    return stored(dealt.sortWithinPartitions("slot", "at").mapInArrow(released(write), MANIFEST), "order-manifest")


def read_slots(manifest: DataFrame, folder: str, first: int = 0, length: int = LENGTH) -> DataFrame:
    """Slot and tokens from a slot on; each shard is read in one go."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(folder)
        name, source = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != name:
                    name = row["file"]
                    source = files.open_input_file(f"{path}/{name}")
                tokens = np.frombuffer(source.read_at(2 * length, row["offset"]), np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["slot"]], pa.int64()), pa.array([tokens.tolist()], pa.list_(pa.int32()))],
                    names=["slot", "tokens"],
                )

    wanted = manifest.where(F.col("slot") >= first).select("file", "slot", "offset")
    return wanted.repartition("file").sortWithinPartitions("slot").mapInArrow(read, "slot long, tokens array<int>")


def shard_folder(docs: DataFrame) -> str:
    """A new folder for shards in the shared folder."""
    return scratch_dir(docs.sparkSession, "shards")
