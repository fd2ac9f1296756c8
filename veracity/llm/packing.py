"""Sum-of-squares packing of tokenised documents into sequences.

Documents become token ids with a separator at the end; only those longer
than a sequence are cut. Pieces are then packed: a piece goes where the sum
over all gaps of ``count(open bins with that gap) ** 2`` becomes smallest, a
new bin included. Pieces come in decreasing length, which the rule leaves
free, so the many short ones at the end fill what the long ones left.

Pieces are dealt to groups of ``group_pieces`` regardless of their ids, which
keeps the groups even for any key, and a group is packed by itself with one
counter per gap. The share of sequences that this can cost falls with the
group's size. No token leaves the task that made it: only lengths move.

Defined results: a null or empty text is a piece with the separator alone;
repeated rows are packed each; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.base import arrow_batches, arrow_rows
from veracity.session import materialize

CAPACITY = 2048
SEPARATOR = 0
GROUP_PIECES = 65_536
VOCABULARY = "byte_bpe_50k"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Tokenizer:
    """Ids of ``<vocabulary>.json`` as the tokenizers library gives them.

    The same vocabulary is also there as ranks, which a second library
    encodes four times as fast, id for id the same. Texts that hold a special
    token's string go to the first, since only that one knows it."""

    def __init__(self, vocabulary: str = VOCABULARY, folder: str | None = None):
        import public_tokenizers
        import tiktoken

        place = (lambda name: os.path.join(folder, name)) if folder else public_tokenizers.path
        self.file, self.full = place(f"{vocabulary}.json"), None
        with open(self.file, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        with open(place(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        if self.full is None:
            import tokenizers

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            self.full = tokenizers.Tokenizer.from_file(self.file)
        return self.full.encode(text, add_special_tokens=False).ids


@cache
def tokenizer(vocabulary: str, folder: str | None) -> Tokenizer:
    """One for each worker process."""
    return Tokenizer(vocabulary, folder)


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces; the first one takes the remainder."""
    first = length % capacity
    bounds = ([0, first] if first else [0]) + list(range(first + capacity, length + 1, capacity))
    return [(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, folder: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """The pieces of all documents, with their tokens if ``with_ids``."""
    fields = PIECES + (", ids array<int>" if with_ids else "")
    schema = pa.schema([(c, pa.int32() if c == "piece" else pa.int64()) for c in (x.split()[0] for x in PIECES.split(", "))]
                       + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches):
        encode = tokenizer(vocabulary, folder)

        def out():
            for doc_id, text in arrow_rows(batches, "doc_id", "text"):
                ids = np.array(encode(text or "") + [SEPARATOR], "<u4")
                for n, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start:start + length]
                    row = doc_id, n, start, length, zlib.crc32(part.tobytes())
                    yield row + (part.astype(np.int32),) * with_ids, 4 * length * with_ids
        yield from arrow_batches(out(), schema)

    return docs.select("doc_id", "text").mapInArrow(run, fields)


def place(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sum-of-squares packing in the order given: bin and offset of each piece.

    Putting a piece of length s into a bin of gap g takes one from count[g]
    and adds one to count[g - s]: the sum of squares changes by
    ``2 * (count[g - s] - count[g]) + 2``, with gap 0 not counted; a new bin
    changes it by ``2 * count[capacity - s] + 1``. Ties go to the smaller gap."""
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, n = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        fresh = 2 * count[capacity - s] + 1 if s < capacity else 0
        gap = capacity
        if s < capacity:
            change = 2 * (count[:capacity - s] - count[s:capacity]) + 2
            change[0] -= 2 * count[0] + 1  # a full bin isn't counted
            change[count[s:capacity] == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            if change[best] <= fresh:
                gap = best + s
        if gap == capacity:
            where, n = n, n + 1
        else:
            where = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = where, capacity - gap
        if gap > s:
            open_bins[gap - s].append(where)
            count[gap - s] += 1
    return bins, offsets


def pack(rows: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows of :func:`pieces`."""
    rows = materialize(rows)  # dealt out by place: a task that runs again must see the same rows
    groups = max(1, -(-rows.count() // group_pieces))

    def run(batches):
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if held:
            group = pa.Table.from_batches(held)
            group = group.take(pc.sort_indices(group, [("length", "descending"), *((c, "ascending") for c in ("doc_id", "piece", "start", "ids_crc32"))]))
            bins, offsets = place(group["length"].to_numpy(), capacity)
            group = group.append_column("sequence_id", pa.array((TaskContext.get().partitionId() << 40) + bins))
            yield from group.append_column("offset", pa.array(offsets)).to_batches(max_chunksize=10_000)

    own = rows.drop("sequence_id", "offset")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    return own.repartition(groups).mapInArrow(run, fields + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the token sequences of pieces with ``ids``.

    A group has at most ``capacity`` pieces."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda x: x["ids"])).alias("ids"))
