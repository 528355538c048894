"""A bigram language model by deleted interpolation.

The probability of a token mixes three maximum-likelihood estimates: of the
bigram, of the token alone, and 1 / (vocabulary + 1) for anything. The mixture
weights depend on how often the context occurs, in octaves. They are learnt by
expectation-maximisation on held-out counts: a part of the training documents
is deleted, estimates come from the retained ones, and the weights maximise the
likelihood of the deleted. The final estimates use both.

Counts live in buckets of token and bigram hashes. Tasks read their texts in
parts and ask the buckets for the distinct tokens and bigrams of a part; an
answer is the total counts in the order of the question. So counts of the whole
corpus reach every part, and no task, and not the driver, holds all of them. A
token that is everywhere is asked for once per part, like any other.

Texts are read three times: to ask, to learn the weights (deleted documents
only), and to score. File splits are held fixed meanwhile, so that a part is the
same each time; answers whose lengths do not fit stop the job. The input must
therefore be a table scan, else pass ``table=False``.

Tokens and bigrams are told apart by 64-bit hashes.

Edge cases: a NULL or empty text is one end token. Documents without id are
training documents. Without training documents every estimate is the uniform
one; without deleted documents the weights are equal. Long texts are a part of
their own; repeated rows count as often as they occur; an empty table gives an
empty result. Only id and text are used, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.arrow import batch_of, raw_texts
from cairn.llm.hashes import MIX, WordHashes, mixed
from cairn.llm.scratch import stored
from cairn.llm.splits import fixed_splits
from cairn.llm.text import quoted, text_bytes

# Text per part, and text whose distinct bigrams one bucket counts.
PART_BYTES, BUCKET_BYTES = 12 << 20, 24 << 20
TOKEN_LEVEL, BIGRAM_LEVEL = 1, 2
SCORED, RETAINED, DELETED = 0, 1, 2
END = b""
CONTEXTS = 48  # octaves of context frequency, 0 for contexts never seen
STEP, BINS = 4, 256  # histogram bins of likelihood ratios: quarter octaves
ROUNDS = 60

ASKED = "level int, bucket int, part string, keys binary, retained binary, deleted binary"
ANSWER = (
    "part string, level int, bucket int, retained binary, deleted binary, "
    "n_retained long, n_deleted long, v_retained long, v_all long"
)
PART = "part string, doc_ids binary, known_ids binary, held_out binary, lengths binary, stream binary"
SCORE = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 1)


def unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


class Part:
    """Texts of one role set: distinct tokens and bigrams, and the stream of both.

    Tokens and bigrams are in the order of their buckets, as they are asked for.
    """

    def __init__(self, texts: list[bytes], known: WordHashes, buckets: int):
        end, runs = known[END], []
        for text in texts:
            words = text.lower().split()
            runs.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        self.lengths = np.array([len(r) + 1 for r in runs], np.int64)
        hashes = np.concatenate([x for r in runs for x in (r, np.array([end], np.uint64))])
        self._number(hashes, buckets)

    def _number(self, hashes: np.ndarray, buckets: int) -> None:
        keys, token = np.unique(hashes, return_inverse=True)
        self.keys, self.key_ends, place = _by_bucket(keys, max(1, buckets // 4))
        self.token = place[token]
        # A text's first context is the end of the one before: both are the end token.
        self.context = np.concatenate((self.token[-1:], self.token[:-1]))
        pairs, bigram = np.unique(self.context * len(keys) + self.token, return_inverse=True)
        left, right = np.divmod(pairs, len(keys))
        hashed = mixed(mixed(self.keys[left] * MIX) + self.keys[right] * MIX)
        self.bigrams, self.bigram_ends, place = _by_bucket(hashed, buckets)
        self.bigram = place[bigram]

    def counts(self, roles: np.ndarray, level: int) -> list[np.ndarray]:
        """Retained and deleted occurrences of each token or bigram."""
        role = np.repeat(roles, self.lengths)
        number, n = (self.token, len(self.keys)) if level == TOKEN_LEVEL else (self.bigram, len(self.bigrams))
        return [np.bincount(number[role == r], minlength=n).astype(np.uint32) for r in (RETAINED, DELETED)]


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in bucket order, the end of each bucket, and the new place of each key."""
    bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    return keys[order], np.cumsum(np.bincount(bucket, minlength=buckets)), place


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list, list[int], list[bytes]]]:
    """Name, ids, roles and texts of each part of an input partition.

    Deleted documents form parts of their own, so that a pass that reads only
    them finds the same parts.
    """
    task = TaskContext.get().partitionId()
    open_parts: dict[bool, list] = {True: [0, 0, [], [], []], False: [0, 0, [], [], []]}

    def close(deleted: bool) -> tuple:
        part = open_parts[deleted]
        name = f"{'deleted' if deleted else 'others'}-{task}-{part[0]}"
        open_parts[deleted] = [part[0] + 1, 0, [], [], []]
        return name, part[2], part[3], part[4]

    for batch in batches:
        rows = zip(batch.column("doc_id").to_pylist(), batch.column("role").to_pylist(), raw_texts(batch.column("text")))
        for doc_id, role, text in rows:
            part = open_parts[role == DELETED]
            if part[2] and part[1] + len(text) > PART_BYTES:
                yield close(role == DELETED)
                part = open_parts[role == DELETED]
            part[1] += len(text)
            for values, value in zip(part[2:], (doc_id, role, text), strict=True):
                values.append(value)
    for deleted in (True, False):
        if open_parts[deleted][2]:
            yield close(deleted)


# --- counts ---------------------------------------------------------------------------------------------------------


def _ask(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for name, _, roles, texts in parts(batches):
            part = Part(texts, known, buckets)
            for level, keys, ends in (
                (TOKEN_LEVEL, part.keys, part.key_ends),
                (BIGRAM_LEVEL, part.bigrams, part.bigram_ends),
            ):
                retained, deleted = part.counts(np.array(roles), level)
                rows = [
                    (level, b, name, keys[s:e].tobytes(), packed(retained[s:e]), packed(deleted[s:e]))
                    for b, (s, e) in enumerate(zip([0, *ends[:-1]], ends, strict=True))
                    if e > s
                ]
                yield batch_of(rows, ASKED)

    return run


def _answer(group: pa.Table) -> pa.Table:
    """Total counts of a bucket's keys, to every part that asked."""
    rows = group.to_pylist()
    keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = []
    for name in ("retained", "deleted"):
        own = np.concatenate([unpacked(r[name], np.uint32) for r in rows])
        totals.append(np.bincount(place, weights=own, minlength=len(distinct)).astype(np.int64))
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    level, bucket = rows[0]["level"], rows[0]["bucket"]
    out = [
        (r["part"], level, bucket, packed(totals[0][at]), packed(totals[1][at]), None, None, None, None)
        for r, at in zip(rows, np.split(place, cuts), strict=True)
    ]
    both = totals[0] + totals[1]
    sums = (int(totals[0].sum()), int(totals[1].sum()), int((totals[0] > 0).sum()), int((both > 0).sum()))
    out.append(("", level, bucket, None, None, *sums))
    return pa.Table.from_batches([batch_of(out, ANSWER)])


# --- weights --------------------------------------------------------------------------------------------------------


@dataclass
class Totals:
    """Tokens and distinct tokens of the retained and of all training documents."""

    n_retained: int = 0
    v_retained: int = 0
    n_all: int = 0
    v_all: int = 0


def octave(counts: np.ndarray) -> np.ndarray:
    """0 for none, else 1 plus the whole part of the binary logarithm."""
    return np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))) + 1, 0).astype(np.int64)


def estimates(bigram, context, token, n: int, v: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Bigram, token and uniform probabilities."""
    return bigram / np.maximum(context, 1), token / max(n, 1), 1 / (v + 1)


def _counts_of(name: str, part: Part, answers: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Retained and deleted totals of a part's tokens and bigrams."""
    found = {}
    rows = sorted(answers.to_pylist(), key=lambda r: (r["level"], r["bucket"]))
    for level, asked in ((TOKEN_LEVEL, part.keys), (BIGRAM_LEVEL, part.bigrams)):
        own = [r for r in rows if r["level"] == level]
        both = [np.concatenate([unpacked(r[k], np.int64) for r in own] or [[]]) for k in ("retained", "deleted")]
        if len(both[0]) != len(asked):
            raise RuntimeError(f"part {name} has changed since it asked; pass table=False")
        found[level] = (both[0], both[1])
    return found


HISTOGRAM = "context int, bigram int, token int, n long"


def _held_out_counts(totals: Totals, buckets: int):
    """Histogram of the deleted documents' bigrams by context octave and likelihood ratios."""

    def run(key, part_rows: pa.Table, answers: pa.Table) -> pa.Table:
        name, stream = _rebuilt(part_rows, buckets)
        if stream is None:
            return pa.Table.from_batches([batch_of([], HISTOGRAM)])
        part, _ = stream
        counts = _counts_of(name, part, answers)
        tokens, bigrams = counts[TOKEN_LEVEL][0], counts[BIGRAM_LEVEL][0]
        context = tokens[part.context]
        p2, p1, p0 = estimates(bigrams[part.bigram], context, tokens[part.token], totals.n_retained, totals.v_retained)
        bins = [np.clip(np.round(STEP * np.log2(np.maximum(p / p0, 2.0**-20)) + 80), 0, BINS - 1) for p in (p2, p1)]
        place = (octave(context) * BINS + bins[0].astype(np.int64)) * BINS + bins[1].astype(np.int64)
        seen, n = np.unique(place, return_counts=True)
        rows = [(int(s // BINS**2), int(s // BINS % BINS), int(s % BINS), int(c)) for s, c in zip(seen, n, strict=True)]
        return pa.Table.from_batches([batch_of(rows, HISTOGRAM)])

    return run


def learnt(histogram: np.ndarray) -> np.ndarray:
    """Weights of bigram, token and uniform estimate per context octave, by EM.

    Rows are context octave, ratio bins of bigram and token estimate to the
    uniform one, and how often.
    """
    weights = np.full((CONTEXTS, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    if not len(histogram):
        return weights
    context = np.minimum(histogram[:, 0], CONTEXTS - 1)
    ratios = np.where(histogram[:, 1:3] > 0, 2.0 ** ((histogram[:, 1:3] - 80) / STEP), 0.0)
    likelihood = np.column_stack([ratios, np.ones(len(histogram))])
    for _ in range(ROUNDS):
        share = weights[context] * likelihood
        share *= (histogram[:, 3] / share.sum(1))[:, None]
        sums = np.array([np.bincount(context, weights=share[:, i], minlength=CONTEXTS) for i in range(3)]).T
        total = sums.sum(1)
        weights[total > 0] = sums[total > 0] / total[total > 0][:, None]
    # No estimate is ever impossible, also where the held-out part never needed it.
    floor = np.array([0.0, 1e-6, 1e-6])
    weights = np.maximum(weights, floor)
    return weights / weights.sum(1, keepdims=True)


# --- parts and scores -----------------------------------------------------------------------------------------------


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each part as one row: ids, flags and the hashed stream with its dictionary."""
    known = WordHashes()
    for name, ids, roles, texts in parts(batches):
        runs = [text.lower().split() for text in texts]
        numbers: dict[bytes, int] = {}
        stream = [numbers.setdefault(w, len(numbers)) for words in runs for w in (*words, END)]
        keys = np.fromiter((known[w] for w in numbers), np.uint64, len(numbers))
        data = packed(np.array(stream, np.uint32)), keys.tobytes()
        lengths = np.array([len(r) + 1 for r in runs], np.int64)
        row = (
            name,
            packed(np.array([0 if i is None else i for i in ids], np.int64)),
            packed(np.array([i is not None for i in ids], np.bool_)),
            packed(np.array(roles, np.int8)),
            packed(lengths),
            len(data[0]).to_bytes(8, "little") + data[0] + data[1],
        )
        yield batch_of([row], PART)


def _rebuilt(rows: pa.Table, buckets: int):
    """Name, part and its document columns from a stored row; None if no part came."""
    if not rows.num_rows:
        return "", None
    row = rows.to_pylist()[0]
    size = int.from_bytes(row["stream"][:8], "little")
    numbers = unpacked(row["stream"][8 : 8 + size], np.uint32)
    keys = np.frombuffer(row["stream"][8 + size :], np.uint64)
    part = Part.__new__(Part)
    part.lengths = unpacked(row["lengths"], np.int64)
    part._number(keys[numbers], buckets)
    ids, known = unpacked(row["doc_ids"], np.int64), unpacked(row["known_ids"], np.bool_)
    return row["part"], (part, (ids, known, unpacked(row["held_out"], np.int8)))


def _scores(totals: Totals, weights: np.ndarray, buckets: int):
    def run(key, part_rows: pa.Table, answers: pa.Table) -> pa.Table:
        name, stream = _rebuilt(part_rows, buckets)
        if stream is None:
            return _scored([], totals)
        part, (ids, known, roles) = stream
        counts = _counts_of(name, part, answers)
        tokens, bigrams = (sum(counts[level]) for level in (TOKEN_LEVEL, BIGRAM_LEVEL))
        token, context = tokens[part.token], tokens[part.context]
        p2, p1, p0 = estimates(bigrams[part.bigram], context, token, totals.n_all, totals.v_all)
        mix = weights[np.minimum(octave(context), CONTEXTS - 1)]
        logs = np.log10(mix[:, 0] * p2 + mix[:, 1] * p1 + mix[:, 2] * p0)
        base = np.log10((token + 1) / (totals.n_all + totals.v_all + 1))
        starts = np.cumsum(part.lengths) - part.lengths
        sums = [np.add.reduceat(x, starts).tolist() for x in ((token > 0).astype(np.int64), base, logs)]
        named = [i if k else None for i, k in zip(ids.tolist(), known.tolist(), strict=True)]
        return _scored(
            list(zip(named, (roles == SCORED).tolist(), part.lengths.tolist(), sums[0], sums[1], sums[2], strict=True)),
            totals,
        )

    return run


def _scored(rows: list[tuple], totals: Totals) -> pa.Table:
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    columns.insert(4, pa.array([totals.n_all] * len(rows), pa.int64()))
    return pa.Table.from_arrays(columns, names=[c.split()[0] for c in SCORE.split(", ")])


def score(
    docs: DataFrame, id_column: str, text: str, held_out, deleted, table: bool = True
) -> tuple[DataFrame, np.ndarray]:
    """Scores of all documents, and the mixture weights.

    ``held_out`` and ``deleted`` are conditions on the input: documents that are
    scored only, and those of the rest that the weights are learnt from.
    """
    role = F.when(F.coalesce(held_out, F.lit(False)), SCORED).when(F.coalesce(deleted, F.lit(False)), DELETED)
    docs = docs.select(
        F.col(quoted(id_column)).cast("long").alias("doc_id"),
        F.col(quoted(text)).alias("text"),
        role.otherwise(RETAINED).alias("role"),
    )
    docs = docs if table else stored(docs, "lm-input")
    spark = docs.sparkSession
    buckets = 1 + text_bytes(docs) // BUCKET_BYTES
    with fixed_splits(spark):
        answers = stored(docs.mapInArrow(_ask(buckets), ASKED).groupBy("level", "bucket").applyInArrow(_answer, ANSWER), "lm-counts")
        sums = answers.where("part = ''").where(F.col("level") == TOKEN_LEVEL)
        n, d, v, every = sums.agg(*[F.sum(c) for c in ("n_retained", "n_deleted", "v_retained", "v_all")]).first()
        totals = Totals(n or 0, v or 0, (n or 0) + (d or 0), every or 0)
        replies = answers.where("part <> ''").select("part", "level", "bucket", "retained", "deleted")

        held = docs.where(F.col("role") == DELETED).mapInArrow(_stream, PART).groupBy("part")
        asked_by = replies.where(F.startswith("part", F.lit("deleted"))).groupBy("part")
        histogram = (
            held.cogroup(asked_by)
            .applyInArrow(_held_out_counts(totals, buckets), HISTOGRAM)
            .groupBy("context", "bigram", "token")
            .agg(F.sum("n"))
            .collect()  # at most one row per octave and pair of bins
        )
        weights = learnt(np.array([tuple(r) for r in histogram], np.float64).reshape(-1, 4).astype(np.int64))
        streams = docs.mapInArrow(_stream, PART).groupBy("part")
        scored = streams.cogroup(replies.groupBy("part")).applyInArrow(_scores(totals, weights, buckets), SCORE)
        return stored(scored, "lm-scores"), weights
