"""Packing token sequences into as few sequences of bounded length as possible, by swap-based local search.

Texts are encoded; those longer than a sequence are cut so that all pieces but the first fill a sequence.
Full pieces need no packing. The others are dealt by number into shards of about ``shard_rows`` pieces, whatever
their source or length, and each shard is packed on its own: pieces go, largest first, into the bin they fit
best, and then a local search works on the bins that are not full. It moves a piece into a fuller bin, exchanges one
piece for another, or two for one, whenever that raises the sum of squared fills; so fuller bins get fuller, and
the emptiest ones run out of pieces. The bins that stay clearly underfull after that are taken apart, and the pieces of
many shards are packed once more together, about ``shard_rows`` at a time, so that the last, half-empty bin of each shard does not stay.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.llm.common import cut, importable, map_rows, table

# Characters that every version of Unicode classes alike: texts of these alone take the faster library.
SETTLED = re.compile(r"[\t\n\r\x20-\x7e\xa0-ɏ‐-‧€]*\Z")
# White space beyond this is too much for the faster library, whose pattern tries all ways to end it.
LONG_BLANK = re.compile(r"\s{2000}")


def settled(text: str) -> bool:
    """Whether the faster library may take this text."""
    return SETTLED.match(text) is not None and LONG_BLANK.search(text) is None


# The ids of these two files are the same, and this is the only special token.
END_OF_TEXT = "<|endoftext|>"


class Ids:
    """The ids of texts as the ``tokenizers`` library gives them, without adding special tokens.

    ``ranks`` may name the same vocabulary as a rank file; its library is several times faster and is used for
    texts on which the two cannot differ.
    """

    def __init__(self, path: str, ranks: str | None):
        self.path = path
        self.fast = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as file:
                known = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}
            )

    @cached_property
    def slow(self):
        """Loaded when a text first needs it."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and END_OF_TEXT not in text and settled(text):
            return self.fast.encode_to_numpy(text).astype("<u4", copy=False)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=2)
def ids_of(path: str, ranks: str | None) -> Ids:
    """One per worker process."""
    return Ids(path, ranks)


def pieces(texts: DataFrame, key: str, text: str, path: str, ranks: str | None, limit: int, end_id: int) -> DataFrame:
    """The pieces of each text: key, piece, start, length and the CRC-32 of their ids."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        encode = ids_of(path, ranks)
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("key", "piece", "start", "length", "ids_crc32")}
            for k, t in zip(batch["key"], batch["text"], strict=True):
                ids = np.append(encode(t or ""), np.array([end_id], "<u4")).astype("<u4", copy=False)
                first = (len(ids) - 1) % limit + 1
                starts = [0, *range(first, len(ids), limit)]
                for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    for n, v in zip(out, (k, i, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                        out[n].append(v)
            yield out

    kind = texts.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_rows(texts.select(F.col(key).alias("key"), F.col(text).alias("text")), work, schema)


class Bins:
    """Bins of one shard: each a list of pieces, sorted by length."""

    def __init__(self, lengths: np.ndarray, limit: int):
        self.lengths, self.limit = lengths, limit
        self.bins: list[list[tuple[int, int]]] = []  # (length, piece)
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Largest first, each piece into the fullest bin that has room for it."""
        rooms: list[tuple[int, int]] = []  # (room, bin), sorted
        for piece in np.argsort(-self.lengths, kind="stable").tolist():
            length = int(self.lengths[piece])
            at = bisect_left(rooms, (length, -1))
            if at < len(rooms):
                room, b = rooms.pop(at)
            else:
                room, b = self.limit, len(self.bins)
                self.bins.append([])
                self.fill.append(0)
            self.bins[b].append((length, piece))
            self.fill[b] += length
            if room > length:
                insort(rooms, (room - length, b))
        for pieces_of in self.bins:
            pieces_of.sort()

    def shift(self, source: int, gone: list[tuple[int, int]], target: int, back: list[tuple[int, int]]) -> None:
        """Pieces ``gone`` go from source to target, pieces ``back`` the other way."""
        for a, b, moved in ((source, target, gone), (target, source, back)):
            for piece in moved:
                self.bins[a].remove(piece)
                insort(self.bins[b], piece)
                self.fill[a] -= piece[0]
                self.fill[b] += piece[0]

    def step(self, source: int, target: int) -> bool:
        """The exchange between two underfull bins, the target at least as full as the source, that fills the
        target most. Any gain raises the squared fill: what the fuller bin gains, the emptier one loses."""
        room = self.limit - self.fill[target]
        best: tuple[int, list, list] = (0, [], [])
        ours, theirs = self.bins[source], self.bins[target]
        at = bisect_right(ours, (room, 1 << 60))
        if at:
            best = (ours[at - 1][0], [ours[at - 1]], [])

        def against(gain_of: int, gone: list[tuple[int, int]]) -> None:
            nonlocal best
            # The shortest of their pieces that makes enough room leaves the target fullest.
            i = bisect_left(theirs, (gain_of - room, -1))
            if i < len(theirs) and best[0] < gain_of - theirs[i][0]:
                best = (gain_of - theirs[i][0], gone, [theirs[i]])

        for piece in ours:
            if best[0] == room:
                break
            against(piece[0], [piece])
        for i, one in enumerate(ours):
            if best[0] == room:
                break
            for other in ours[i + 1 :]:
                if one[0] + other[0] <= room:
                    if best[0] < one[0] + other[0]:
                        best = (one[0] + other[0], [one, other], [])
                else:
                    against(one[0] + other[0], [one, other])
        if not best[0]:
            return False
        self.shift(source, best[1], target, best[2])
        return True

    def search(self) -> None:
        """Work on the emptiest bins against the fuller underfull ones, until nothing changes. All are tried. It
        ends, as each exchange raises the sum of squared fills; all bins stay valid at any time."""
        least = -(-int(self.lengths.sum()) // self.limit)
        changed = True
        while changed and sum(f > 0 for f in self.fill) > least:
            under = sorted((b for b, f in enumerate(self.fill) if 0 < f < self.limit), key=self.fill.__getitem__)
            changed = False
            for source in under:
                for target in reversed(under):
                    if not self.fill[source]:
                        break
                    if source == target or self.fill[target] == self.limit or self.fill[target] < self.fill[source]:
                        continue
                    while self.fill[source] and self.fill[target] < self.limit and self.step(source, target):
                        changed = True
                        if self.fill[target] < self.fill[source]:
                            break


def pack(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece, and its offset there."""
    bins = Bins(lengths, limit)
    bins.best_fit()
    bins.search()
    of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, content in enumerate(bins.bins):
        at = 0
        for length, piece in content:
            of[piece], offset[piece] = b, at
            at += length
    return of, offset


def pack_texts(
    texts: DataFrame,
    key: str,
    text: str,
    path: str,
    ranks: str | None = None,
    limit: int = 1024,
    end_id: int = 2,
    shard_rows: int = 4096,
    regroup: int = 64,
    underfull: float = 0.98,
) -> DataFrame:
    """Pack all texts into sequences of at most ``limit`` tokens.

    A text is its ids by the ``tokenizers`` file at ``path``, then ``end_id``; only longer ones are cut, into
    pieces of ``limit`` tokens of which the first may be shorter. One row per piece: ``key``, ``piece``, ``start``,
    ``length``, ``ids_crc32``, ``sequence_id``, ``offset``. A null text counts as empty (one token); repeated rows
    and null keys are packed like others; an empty table gives no rows; other columns are not looked at.
    Sequences of full pieces have negative ids, the others non-negative ones.
    """
    importable(texts.sparkSession)
    kind = texts.schema[key].dataType.simpleString()
    columns = f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    # Encoded once; everything below reads these short rows.
    all_pieces = cut(pieces(texts, key, text, path, ranks, limit, end_id))
    full = all_pieces.where(F.col("length") == limit).select(
        *all_pieces.columns,
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    partial = all_pieces.where(F.col("length") < limit)
    shards = max(1, -(-partial.count() // shard_rows))
    def packed(first: int):
        def work(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            of, offset = pack(rows["length"].to_numpy(np.int64), limit)
            fill = np.bincount(of, weights=rows["length"])
            return rows.assign(
                sequence_id=first + group[0] * (1 << 32) + of, offset=offset, open=fill[of] < underfull * limit
            ).drop(columns="shard")

        return work

    schema = f"{columns}, sequence_id bigint, offset bigint, open boolean"
    # By number, which tells even equal rows apart; the rows are stored, so it is the same whenever it is asked for.
    number = F.xxhash64(F.monotonically_increasing_id())
    shard = F.pmod(number, F.lit(shards))
    # Each shard is packed once: what its bins give decides which rows are packed again.
    once = cut(partial.withColumn("shard", shard).groupBy("shard").applyInPandas(packed(0), schema))
    kept = once.where("NOT open").drop("open")
    left = once.where("open").select(*all_pieces.columns)
    # The search tries all bins of a group with each other, so its groups are no larger than the shards.
    groups = max(-(-shards // regroup), -(-left.count() // shard_rows))
    again = left.withColumn("shard", F.pmod(number, F.lit(groups)))
    again = again.groupBy("shard").applyInPandas(packed(1 << 60), schema).drop("open")
    return full.unionByName(kept).unionByName(again).withColumnRenamed("key", key)


def op1_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` packed into sequences of 1024 tokens."""
    import public_tokenizers

    return pack_texts(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        "doc_id",
        "text",
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )
