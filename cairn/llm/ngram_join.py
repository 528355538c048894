"""N-gram Jaccard join: documents whose word-shingle sets are at least 0.8 alike.

Texts become sets of 64-bit hashes of five-word shingles; a set is named by a
128-bit digest, and texts with equal sets are one node from then on.

1. Shared shingles. A document linked with a different one shares at least 0.8
   of its shingles. Tasks deal the low 24 bits of all hashes to buckets, each
   bucket counts in how many documents each occurs, and the counts return per
   document. Hash collisions add candidates, never lose one. Most documents
   drop out here; only the others' texts are read again.
2. Global order. The remaining distinct sets deal their whole hashes to buckets,
   which return the exact document frequency of the shared ones. Shingles are
   ordered by frequency, rare first, then hash. Those of one set only stand
   first and match nothing.
3. Blocks. Linked sets have a shingle in common within the first
   ``size - ceil(0.8 size) + 1``. Sets connected by such shingles form a block.
4. Prefix-tree join. A block is searched by a prefix tree (``prefix_tree``). One
   with more than ``CHUNK`` sets is cut into chunks, which are searched with the
   block's first sets in each, so that copies of one text meet. Sets that share
   a prefix shingle and are still unconnected are then searched piece by piece,
   among the sets of each such shingle, or of the block where that is cheaper:
   those outside the largest component against all. As most of these pairs are
   no links, their overlaps are counted for all at once (``overlaps``), and a
   piece holds as many sets as memory allows, so that few are sent twice.
5. Components of all links; a component's id is its smallest document id.

Hashes travel packed, an array per task and bucket, so a shingle costs a few
bytes and no row. Documents are named by their distance from the entry before,
and numbers are laid out byte by byte, so that the bytes that are zero vanish in
compression: an entry takes about four bytes, however many buckets a larger
input has. Every bucket has the same share of hashes, and a shingle that
very many documents have adds one entry for each, as any other does.

Edge cases: texts without words have an empty set and link with nothing; texts
of fewer words than a shingle are one shingle. Repeated rows and equal sets have
one component id. Rows without id belong to a component but never name it unless
it has no other. Long texts are hashed whole. Empty tables give empty results.
Only id and text are used, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.arrow import batch_of, mapped, raw_texts, released, released_after, slices
from cairn.llm.components import components
from cairn.llm.hashes import MIX, mixed
from cairn.llm.overlaps import connected
from cairn.llm.prefix_tree import Member, connect
from cairn.llm.scratch import discard, stored, stored_as
from cairn.llm.text import fresh, quoted, text_bytes
from cairn.operators.bitmap import PART_BITS, bit_is_set

SHINGLE = 5
# Text whose hashes one bucket holds, text hashed at once in a task, and hashes dealt at once.
BUCKET_BYTES, PART_BYTES, DEALT = 8 << 20, 2 << 20, 1 << 20
CHUNK, BRIDGES = 64, 4
# Most sets of a side, and most of their shingles, in a piece of the second search; pieces that a large unit has at least.
PIECE, PIECE_TOKENS, LEAST_PIECES = 2048, 1 << 19, 8
# Pairs whose overlap is counted in the time that sending one set takes.
PAIRS_PER_SET = 1024
# Bits of a hash that tell shingles of a bucket apart in the first count.
LOW_BITS = np.uint64((1 << 24) - 1)


def shingles(text: bytes) -> np.ndarray:
    """The sorted set of a text's shingle hashes."""
    h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, text.lower().split())), ">u8").astype(np.uint64)
    width = min(SHINGLE, len(h))
    if not width:
        return h
    runs = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        runs = mixed(runs * MIX + h[i : len(h) - width + 1 + i])
    runs.sort()
    return runs[starts(runs)]


def starts(ordered: np.ndarray) -> np.ndarray:
    """Where each value begins in a sorted array."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1])))


def new_part() -> int:
    """A name for what is dealt together."""
    return random.SystemRandom().getrandbits(63)


def digest(hashes: np.ndarray) -> str:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).hexdigest()


def at_least(size: Column) -> Column:
    """The least overlap of a set with one that is linked to it."""
    return F.ceil(F.lit(4) * size / F.lit(5))


# --- hashes to buckets and back -------------------------------------------------------------------------------------


def planes(numbers: np.ndarray) -> bytes:
    """Numbers as their lowest bytes, then their next ones, and so on."""
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def steps(ascending: np.ndarray) -> bytes:
    """Ascending places as distances, in planes."""
    return planes(np.diff(ascending, prepend=0).astype(np.int32))


def from_steps(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.int32), dtype=np.int32)


def dealt(sets: list[np.ndarray], buckets: int, whole: bool) -> Iterator[tuple[int, bytes, bytes]]:
    """Bucket, hashes and their documents' places, packed; the places of a bucket ascend."""
    if not sets:
        return
    hashes = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    # Numbers of 16 bits are sorted by their digits.
    kind = np.uint16 if buckets <= 1 << 16 else np.int32
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(kind)
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    hashes, owner = hashes[order] if whole else (hashes[order] & LOW_BITS).astype(np.uint32), owner[order]
    for b, (start, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
        if end > start:
            yield b, planes(hashes[start:end]), steps(owner[start:end])


def frequencies(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs, in place."""
    if keys.itemsize == 4:
        both = np.sort(keys.astype(np.uint64) << np.uint64(32) | np.arange(len(keys), dtype=np.uint64))
        place, keys = both.astype(np.uint32), both >> np.uint64(32)
    else:
        place = np.argsort(keys)
        keys = keys[place]
    many = np.diff(starts(keys), append=len(keys))
    counts = np.empty(len(keys), np.int64)
    counts[place] = np.repeat(many, many)
    return counts


RAW = "bucket int, part long, place int, doc_id long, size long, digest string, hashes binary, owners binary"


def hashed(docs: DataFrame, buckets: int) -> DataFrame:
    """All documents' set sizes and digests, and all hashes, as one table.

    Rows with bucket -1 are documents, the others packed hashes. ``part`` and
    ``place`` name a document; they hold because the table is written once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, ids = [], []

        def packed() -> pa.RecordBatch:
            names, name = [digest(s) if len(s) else None for s in sets], new_part()
            rows = [(-1, name, i, ids[i], len(s), names[i], None, None) for i, s in enumerate(sets)]
            rows += [(b, name, None, None, None, None, k, o) for b, k, o in dealt(sets, buckets, False)]
            sets.clear()
            ids.clear()
            return batch_of(rows, RAW)

        size = 0
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                new = [shingles(t) for t in raw_texts(part.column("text"))]
                sets.extend(new)
                ids.extend(part.column("doc_id").to_pylist())
                size += sum(map(len, new))
                if size >= DEALT:
                    size = 0
                    yield packed()
        if sets:
            yield packed()

    return docs.mapInArrow(released(run), RAW)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    return pa.Table.from_batches([batch_of(rows, schema)])


ANSWER = "part long, owners binary, hashes binary, counts binary"


def _shared_in_bucket(whole: bool):
    """For each packed row of a bucket: the entries whose hash others have too."""
    kind = np.uint64 if whole else np.uint32

    def run(group: pa.Table) -> pa.Table:
        parts = group.column("part").to_pylist()
        hashes = [from_planes(x, kind) for x in group.column("hashes").to_pylist()]
        owners = [from_steps(x) for x in group.column("owners").to_pylist()]
        counts = np.split(frequencies(np.concatenate(hashes)), np.cumsum([len(h) for h in hashes])[:-1])
        rows = []
        for part, h, o, n in zip(parts, hashes, owners, counts, strict=True):
            found = np.flatnonzero(n > 1)
            if not len(found):
                continue
            if whole:
                rows.append((part, steps(o[found]), planes(h[found]), planes(n[found].astype(np.int64))))
            else:
                begin = starts(o[found])
                many = np.diff(begin, append=len(found))
                rows.append((part, steps(o[found][begin]), None, planes(many.astype(np.int32))))
        return _table(rows, ANSWER)

    return run


def _shared_per_document(group: pa.Table) -> pa.Table:
    part = group.column("part")[0].as_py()
    who = np.concatenate([from_steps(x) for x in group.column("owners").to_pylist()])
    many = np.concatenate([from_planes(x, np.int32) for x in group.column("counts").to_pylist()])
    total = np.bincount(who, weights=many)
    return _table([(part, int(i), int(total[i])) for i in np.flatnonzero(total)], "part long, place int, shared long")


def _ordered_per_document(group: pa.Table) -> pa.Table:
    """Shared hashes of each document in the global order."""
    part = group.column("part")[0].as_py()
    unpacked = (("owners", from_steps), ("hashes", lambda x: from_planes(x, np.uint64)), ("counts", lambda x: from_planes(x, np.int64)))
    columns = {name: np.concatenate([read(x) for x in group.column(name).to_pylist()]) for name, read in unpacked}
    order = np.lexsort((columns["hashes"], columns["counts"], columns["owners"]))
    owner, hashes, counts = (columns[c][order] for c in ("owners", "hashes", "counts"))
    starts = np.flatnonzero(np.diff(np.concatenate(([-1], owner))))
    ends = [*starts[1:], len(owner)]
    rows = [
        (part, int(owner[s]), hashes[s:e].tobytes(), counts[s:e].tobytes()) for s, e in zip(starts, ends, strict=True)
    ]
    return _table(rows, "part long, place int, hashes binary, counts binary")


# Sets dealt at once, and the columns of the table they are dealt through.
PACKED_SETS = 1000
PACKED = "bucket int, part long, hashes binary, owners binary, place int, digest string, size long"


# A filter has this many bits for each value, and never more than these in all:
# 16 MB. A fuller filter lets more rows through, which an exact join then sorts out.
VALUE_BITS, MOST_BITS = 16, 1 << 27


def filter_size(values: int) -> int:
    """Bits of a filter for that many values: a power of two."""
    return max(PART_BITS, min(MOST_BITS, 1 << (VALUE_BITS * values).bit_length()))


def filter_place(value: Column | str, bits: int) -> Column:
    """The filter bit of a value; all NULLs share one."""
    value = F.col(value) if isinstance(value, str) else value
    return F.pmod(F.xxhash64(F.coalesce(value.cast("string"), F.lit(""))), F.lit(bits))


def bitmaps(frame: DataFrame, column: str, bits: int) -> DataFrame:
    """The filter of all values of a column: ``bucket`` and the bitmap of its ``PART_BITS`` bits."""
    place = frame.select(filter_place(column, bits).alias("p"))
    return place.groupBy(F.floor(F.col("p") / PART_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("p") % PART_BITS).alias("bitmap")
    )


# --- candidates -----------------------------------------------------------------------------------------------------


def likely_sets(table: DataFrame) -> DataFrame:
    """Digests of sets that may be linked with another, each with the least id that has it."""
    people = table.where("bucket < 0")
    shared = (
        table.where("bucket >= 0")
        .groupBy("bucket")
        .applyInArrow(released_after(_shared_in_bucket(False)), ANSWER)
        .groupBy("part")
        .applyInArrow(released_after(_shared_per_document), "part long, place int, shared long")
    )
    likely = people.join(shared, ["part", "place"]).where(F.col("shared") >= at_least(F.col("size")))
    # One row per set and one document to take its text from; copies alone are no candidates.
    return stored(likely.groupBy("digest").agg(F.min("doc_id").alias("id")), "join-likely")


def candidate_sets(docs: DataFrame, likely: DataFrame, buckets: int) -> DataFrame:
    """Distinct sets that may be linked with another: digest, size, shared hashes in order."""
    digests = likely.select("digest")
    size = filter_size(likely.count())
    placed = docs.select("text", filter_place("doc_id", size).alias("place"))
    listed = F.broadcast(bitmaps(likely, "id", size))
    placed = placed.join(listed, F.floor(F.col("place") / PART_BITS) == F.col("bucket"))
    texts = placed.where(bit_is_set(F.col("bitmap"), F.col("place") % PART_BITS)).select("text")
    schema = "digest string, size long, set binary"

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                sets = [shingles(t) for t in raw_texts(part.column("text"))]
                yield batch_of([(digest(s), len(s), s.tobytes()) for s in sets if len(s)], schema)

    sets = texts.mapInArrow(released(rebuild), schema).join(digests, "digest", "left_semi").groupBy("digest")
    sets = stored(sets.agg(F.first("size").alias("size"), F.first("set").alias("set")), "join-sets")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PACKED_SETS):
                rows = batch.slice(start, PACKED_SETS).to_pylist()
                part = new_part()
                found = [np.frombuffer(r["set"], np.uint64) for r in rows]
                out = [(-1, part, None, None, i, r["digest"], r["size"]) for i, r in enumerate(rows)]
                out += [(b, part, k, o, None, None, None) for b, k, o in dealt(found, buckets, True)]
                yield batch_of(out, PACKED)

    # Written once, so that both kinds of rows name the same parts.
    both = stored(sets.mapInArrow(released(pack), PACKED), "join-packed")
    answers = both.where("bucket >= 0").groupBy("bucket").applyInArrow(released_after(_shared_in_bucket(True)), ANSWER)
    ordered = answers.groupBy("part").applyInArrow(
        released_after(_ordered_per_document), "part long, place int, hashes binary, counts binary"
    )
    who = both.where("bucket < 0").select("part", "place", "digest", "size")
    found = who.join(ordered, ["part", "place"]).withColumn("shared", (F.length("hashes") / 8).cast("long"))
    likely_linked = found.where(F.col("shared") >= at_least(F.col("size")))
    found = stored(likely_linked.select("digest", "size", "shared", "hashes", "counts"), "join-candidates")
    discard(sets, both)
    return found


def prefixes(candidates: DataFrame) -> DataFrame:
    """Digest and each shared hash within its prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, tokens = [], []
            for name, size, shared, hashes in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                length = size - -(-4 * size // 5) + 1 - (size - shared)
                found = np.frombuffer(hashes, np.int64)[: max(0, length)].tolist()
                names += [name] * len(found)
                tokens += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(tokens, pa.int64())], names=["digest", "token"]
            )

    return candidates.select("digest", "size", "shared", "hashes").mapInArrow(run, "digest string, token long")


def _search(group: pa.Table) -> pa.Table:
    """Links within a group, by the prefix tree."""
    rows = {r["digest"]: r for r in group.to_pylist()}
    hashes = [np.frombuffer(r["hashes"], np.uint64) for r in rows.values()]
    counts = [np.frombuffer(r["counts"], np.int64) for r in rows.values()]
    found, first, place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    rank = np.empty(len(found), np.int64)
    rank[np.lexsort((found, np.concatenate(counts)[first]))] = np.arange(len(found))
    tokens = np.split(rank[place], np.cumsum([len(h) for h in hashes])[:-1])
    members = [Member(name, r["size"], t.tolist()) for (name, r), t in zip(rows.items(), tokens, strict=True)]
    return _table(connect(members, []), "a string, b string")


def _counted(group: pa.Table) -> pa.Table:
    """Links within a group that connect different roots, by counting all overlaps."""
    _, component = np.unique(np.array(group.column("root").to_pylist()), return_inverse=True)
    sets = [np.frombuffer(h, np.uint64) for h in group.column("hashes").to_pylist()]
    found = connected(group.column("digest").to_pylist(), group.column("size").to_numpy(), component, sets)
    return _table(found, "a string, b string")


def links(candidates: DataFrame) -> DataFrame:
    """Links between candidate sets that connect all that are linked."""
    tokens = stored(prefixes(candidates), "join-prefixes")
    heads = tokens.groupBy("token").agg(F.min("digest").alias("head"), F.max("digest").alias("tail"))
    heads = stored(heads.where("head < tail").select("token", "head"), "join-heads")
    related = tokens.join(heads, "token").select("digest", "head").distinct()
    blocks = components(related).withColumnRenamed("node", "digest").withColumnRenamed("root", "block")
    sizes = blocks.groupBy("block").agg(F.count("*").alias("n"))
    placed = stored(blocks.join(stored(sizes, "join-sizes"), "block"), "join-blocks")

    chunks = F.ceil(F.col("n") / CHUNK)
    own = F.pmod(F.xxhash64("digest"), chunks)
    first = stored(
        placed.where(F.col("n") > CHUNK)
        .withColumn("row", F.row_number().over(Window.partitionBy("block").orderBy("digest")))
        .where(F.col("row") <= BRIDGES)
        .select("digest", "block", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk")),
        "join-bridges",
    )
    groups = placed.select("digest", "block", own.alias("chunk")).union(first).distinct()
    sets = candidates.select("digest", "size", "hashes", "counts")
    found = stored(
        groups.join(sets, "digest")
        .groupBy("block", "chunk")
        .applyInArrow(released_after(_search), "a string, b string"),
        "join-links",
    )
    return found.union(_remaining(tokens, placed, candidates, found))


def pieces(sets: Column, tokens: Column, least: int) -> Column:
    """Pieces for that many sets with that many shingles: ``least`` or more, but none of fewer than ``CHUNK`` sets."""
    fit = F.greatest(F.ceil(sets / PIECE), F.ceil(tokens / PIECE_TOKENS), F.lit(least))
    return F.least(F.ceil(sets / CHUNK), fit)


def _remaining(tokens: DataFrame, placed: DataFrame, candidates: DataFrame, found: DataFrame) -> DataFrame:
    """Links between chunks of a block that the first search left unconnected.

    Two linked sets share a prefix shingle, so it is enough to search among the
    sets of each shingle that sets of different components have; shingles that
    the same sets have count once. Where few sets are outside the largest
    component, searching them in the whole block sends fewer sets: each block
    takes the cheaper way.
    """
    large = placed.where(F.col("n") > CHUNK).select("digest", "block")
    roots = components(found).withColumnRenamed("node", "digest")
    large = large.join(candidates.select("digest", "shared"), "digest").join(roots, "digest", "left")
    large = stored(large.select("digest", "block", "shared", F.coalesce("root", "digest").alias("root")), "join-large")
    posted = tokens.join(large, "digest")
    low = F.lit((1 << 40) - 1).cast("long")
    same = [F.sum(F.xxhash64("digest", F.lit(i)).bitwiseAND(low)).alias(f"same{i}") for i in range(2)]
    held = posted.groupBy("block", "token").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"), *same
    )
    mixed_tokens = stored(held.where("low < high").select("block", "token", "n", "same0", "same1"), "join-mixed")
    different = mixed_tokens.groupBy("block", "n", "same0", "same1").agg(F.min("token").alias("token")).select("token")
    in_block = posted.join(mixed_tokens.select("token"), "token").select("block", F.lit(0).cast("long").alias("unit"), "digest", "root", "shared")
    by_token = posted.join(different, "token").select("block", F.col("token").alias("unit"), "digest", "root", "shared")
    ways = [_units(in_block.distinct(), "join-active"), _units(by_token, "join-active-tokens")]
    costs = [way.select("block", "unit", "cost").distinct().groupBy("block").agg(F.sum("cost").alias("cost")) for way in ways]
    cheaper = stored(
        costs[0].join(costs[1].withColumnRenamed("cost", "by_token"), "block").select("block", (F.col("by_token") < F.col("cost")).alias("split")),
        "join-ways",
    )
    known = ways[0].join(cheaper.where("not split"), "block").union(ways[1].join(cheaper.where("split"), "block"))
    minor, every = F.col("minor"), F.col("every")
    spread = F.xxhash64("digest")
    asked = known.where("root <> main").select(
        "digest", "block", "unit", "root", F.pmod(spread, minor).alias("x"), F.explode(F.sequence(F.lit(0), every - 1)).alias("y")
    )
    answering = known.where("all > most").select(
        "digest", "block", "unit", "root", F.explode(F.sequence(F.lit(0), minor - 1)).alias("x"), F.pmod(spread, every).alias("y")
    )
    searched = stored(asked.union(answering).distinct(), "join-searched")
    sent = searched.join(candidates.select("digest", "size", "hashes"), "digest")
    return sent.groupBy("block", "unit", "x", "y").applyInArrow(released_after(_counted), "a string, b string")


def _units(active: DataFrame, label: str) -> DataFrame:
    """Sets to search in each unit, with the unit's largest component, sizes and pieces, and the cost of the search."""
    active = stored(active, label)
    ranked = active.groupBy("block", "unit", "root").agg(F.count("*").alias("n"), F.sum("shared").alias("tokens"))
    sizes = ranked.groupBy("block", "unit").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"),
        F.sum("n").alias("all"),
        F.max("n").alias("most"),
        F.sum("tokens").alias("tokens"),
        F.max_by("tokens", F.struct("n", "root")).alias("main_tokens"),
    )
    rest = F.col("all") - F.col("most")
    sizes = sizes.withColumn("every", pieces(F.col("all"), F.col("tokens"), LEAST_PIECES))
    sizes = sizes.withColumn("minor", pieces(rest, F.col("tokens") - F.col("main_tokens"), 1))
    cost = F.col("minor") * F.col("all") + F.col("every") * rest + F.col("all") * rest / PAIRS_PER_SET
    sizes = sizes.withColumn("cost", cost).drop("tokens", "main_tokens")
    return active.join(stored(sizes, f"{label}-sizes"), ["block", "unit"])


# --- results --------------------------------------------------------------------------------------------------------


def joined(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, size, digest) and classes (digest, component_id, keeper).

    Classes hold the digests with several rows or a link; ``keeper`` is the
    digest of the document that gives the component its id.
    """
    docs = docs.select(F.col(quoted(id_column)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    buckets = 1 + text_bytes(docs) // BUCKET_BYTES
    table = stored(hashed(docs, buckets), "join-hashes")
    likely = likely_sets(table)
    people = stored(table.where("bucket < 0").select("doc_id", "size", "digest"), "join-people")
    discard(table)
    found = stored(links(candidate_sets(docs, likely, buckets)), "join-found")
    roots = components(found).withColumnRenamed("node", "digest")
    own = people.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    own = stored(
        own.join(roots, "digest", "left").where("n > 1 or root is not null").withColumn("root", F.coalesce("root", "digest")),
        "join-classes",
    )
    named = own.groupBy("root").agg(
        F.min("low").alias("component_id"), F.min(F.struct(F.col("low").isNull(), "low", "digest"))["digest"].alias("keeper")
    )
    classes = stored(own.select("digest", "root").join(stored(named, "join-named"), "root").drop("root"), "join-ids")
    return people, classes


def component_ids(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    people, classes = joined(docs, id_column, text)
    return people.join(classes, "digest", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("keeper").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, the one with the smallest id, and all rows without words.

    A bounded filter of the ids of rows that may go tells the other rows apart,
    which pass as they are. Only texts of listed ids are hashed again, and
    joined with what was decided on id and digest.
    """
    people, classes = joined(docs, id_column, text)
    rows = people.join(classes, "digest").groupBy("doc_id", "digest")
    fate = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.first((F.col("digest") == F.col("keeper")) & F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("keeper"),
    )
    # A keeper that comes once stays like any other row.
    fate = stored(fate.where("n > 1 or not keeper"), "join-fate")
    size = filter_size(fate.count())
    taken = list(docs.columns)
    names = {}
    for name in ("digest", "place", "bucket", "bitmap", "fate_id", "fate_digest", "fate_n", "fate_keeper"):
        names[name] = fresh(f"cairn_{name}", taken)
        taken.append(names[name])
    own = [F.col(quoted(c)) for c in docs.columns]
    listed = bitmaps(fate, "doc_id", size).toDF(names["bucket"], names["bitmap"])
    long_id = F.col(quoted(id_column)).cast("long")
    placed = docs.withColumn(names["place"], filter_place(long_id, size))
    placed = placed.join(F.broadcast(listed), F.floor(F.col(names["place"]) / PART_BITS) == F.col(names["bucket"]), "left")
    at = F.col(names["place"]) % PART_BITS
    hit = F.coalesce(bit_is_set(F.col(names["bitmap"]), at), F.lit(False))

    schema = T.StructType([*docs.schema.fields, T.StructField(names["digest"], T.StringType())])
    text_place = docs.columns.index(text)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, PART_BYTES):
                sets = [shingles(t) for t in raw_texts(part.column(text_place))]
                found = [digest(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], names=schema.names)

    tagged = mapped(placed.where(hit).select(*own), tag, schema)
    shown = fate.select(*[F.col(c).alias(names[f"fate_{c.removeprefix('doc_')}"]) for c in ("doc_id", "digest", "n", "keeper")])
    same = (F.col(names["digest"]) == F.col(names["fate_digest"])) & long_id.eqNullSafe(F.col(names["fate_id"]))
    decided = tagged.join(shown, same, "left")
    unknown = F.col(names["fate_digest"]).isNull()
    stay = stored_as(decided.where(unknown | F.col(names["fate_keeper"])), "join-stay")
    once = stay.where(~unknown).dropDuplicates([names["digest"]])
    return placed.where(~hit).select(*own).union(stay.where(unknown).select(*own)).union(once.select(*own))
