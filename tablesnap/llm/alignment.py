"""Aligning the tokens of two tokenizers over the same bytes, and finding each token's usual partners.

Texts are worked on as Arrow columns, many at a time, in tasks that Spark deals out:

* The ids of all texts are flattened; the parent indices tell the text of each token, and a running sum of the tokens'
  sizes, restarted at each text, gives the byte where each token ends.
* One Acero full outer join on (text, end) keys merges the ends of both sides. Every distinct end closes an elementary
  range, which one token of each side covers: the one whose end comes next. So the rows of the join, each side filled
  backward, are all pairs of overlapping tokens, and where both sides end, a group ends.
* ``group_by`` counts a text's distinct pairs, and over a block of texts in how many of these each pair stands. Spark
  merges these partial counts, and each block gets the totals of its own pairs back.

A block is a run of texts of a partition that is closed at a fixed number of pairs, so neither a frequent pair nor a
frequent text makes a task longer than others. Texts with their pairs are written as a table between the two passes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.llm.common import ROWS_AT_ONCE, importable, ready_checkpoints, small_batches, table
from tablesnap.llm.packing import settled

# No token of either side reaches over a single space between visible characters.
CUT = re.compile(r"(?<=\S) (?=\S)")
LOOSE = re.compile(r"\s | \s|\A | \Z")  # a space of another kind
SPACE = "▁"  # stands for a space in the pieces

LETTERS_AT_ONCE = 1_000_000
WORDS_KNOWN, WORDS_AT_ONCE = 250_000, 256  # remembered by a worker; encoded in one text
BLOCK_PAIRS = 1_000_000  # distinct pairs of texts, summed over the texts of a block
END_BITS, ID_BITS = 32, 32

STORED = "block bigint, whole boolean, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
PAIRS = "a array<int>, b array<int>, times array<int>"


class Sides:
    """Both tokenizers, and the bytes that their ids stand for."""

    def __init__(self, path_a: str, ranks_a: str | None, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # the text of a special token is ordinary text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = pa.array(self.level_bytes(), pa.binary())
        self.bytes_b = pa.array([self.piece_bytes(i) for i in range(self.b.get_piece_size())], pa.binary())
        self.sizes_a, self.sizes_b = (
            pc.binary_length(t).to_numpy().astype(np.int64) for t in (self.bytes_a, self.bytes_b)
        )
        self.fast = self.rank_encoding(ranks_a) if ranks_a else None
        self.forget()

    def level_bytes(self) -> list[bytes]:
        """The byte-level entries decoded: printable bytes stand for themselves, the others follow from 256 on."""
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        byte_of = {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}
        entries = [self.a.id_to_token(i) for i in range(self.a.get_vocab_size())]
        return [bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else b"" for entry in entries]

    def piece_bytes(self, piece: int) -> bytes:
        if self.b.is_byte(piece):
            return bytes([int(self.b.id_to_piece(piece)[3:-1], 16)])
        return b"" if self.b.is_control(piece) else self.b.id_to_piece(piece).replace(SPACE, " ").encode()

    @staticmethod
    def rank_encoding(ranks: str):
        """The same vocabulary in a library that is faster, for words on which the two cannot differ."""
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as file:
            known = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def encoded(self, words: list[str]) -> tuple[pa.ListArray, pa.ListArray, np.ndarray]:
        """For each word, with a space before it, the ids of both sides, and whether both give its bytes."""
        texts = [" ".join(words[i : i + WORDS_AT_ONCE]) for i in range(0, len(words), WORDS_AT_ONCE)]
        wanted = [b" " + word.encode() for word in words]
        ends = np.cumsum([len(w) for w in wanted])
        ids_b = self.b.encode(texts, num_threads=1)
        a = cut_at(as_flat(map(self.ids_of, texts)), self.sizes_a, ends)
        b = cut_at(as_flat(ids_b), self.sizes_b, ends)
        if a is None or b is None:
            # Some word has other bytes, so where one ends is not known.
            a = as_lists([self.ids_of(word) for word in words])
            b = as_lists(self.b.encode(words, num_threads=1))
        return a, b, gives(a, self.bytes_a, self.sizes_a, wanted) & gives(b, self.bytes_b, self.sizes_b, wanted)

    def ids_of(self, text: str) -> Sequence[int]:
        if self.fast is not None and settled(text):
            return self.fast.encode_to_numpy(" " + text)
        return self.a.encode(" " + text, add_special_tokens=False).ids

    def slots(self, words: list[str]) -> np.ndarray:
        """The place of each of the distinct words in what is remembered; unknown ones are encoded together."""
        missing = [w for w in words if w not in self.slot_of]
        if len(self.slot_of) + len(missing) > WORDS_KNOWN:
            self.forget()
            missing = words
        # Joined by spaces, words without white space at their ends keep their tokens; the others, and those that the
        # faster library may see otherwise, are encoded apart.
        kinds: dict[object, list[str]] = {True: [], False: []}
        for word in missing:
            if word and word.strip() == word:
                kinds[settled(word)].append(word)
            else:
                kinds[word] = [word]
        for group in filter(None, kinds.values()):
            a, b, same = self.encoded(group)
            self.slot_of.update(zip(group, range(len(self.same), len(self.same) + len(group)), strict=True))
            self.ids_a, self.ids_b = pa.concat_arrays([self.ids_a, a]), pa.concat_arrays([self.ids_b, b])
            self.same = np.concatenate([self.same, same])
        return np.fromiter(map(self.slot_of.__getitem__, words), np.int64, len(words))

    def forget(self) -> None:
        self.slot_of: dict[str, int] = {}
        self.ids_a = self.ids_b = as_lists([])
        self.same = np.zeros(0, bool)

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, pa.ListArray, pa.ListArray]:
        """Which texts both sides can tell, and the ids of these by each side, a list per text. A text that they
        cannot tell has no ids."""
        parts = [words_of(text) if text else [] for text in texts]
        ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        words = pa.array(chain.from_iterable(parts), pa.string()).dictionary_encode()
        of_word = self.slots(words.dictionary.to_pylist())[words.indices.to_numpy()]
        failed = np.concatenate([[0], np.cumsum(~self.same[of_word])])
        whole = (failed[ends[1:]] == failed[ends[:-1]]) & (ends[1:] > ends[:-1])
        of_word = pa.array(of_word[np.repeat(whole, np.diff(ends))])
        at = np.concatenate([[0], np.cumsum(np.where(whole, np.diff(ends), 0))])

        def side(known: pa.ListArray) -> pa.ListArray:
            lists = known.take(of_word)
            return pa.ListArray.from_arrays(pa.array(lists.offsets.to_numpy()[at], pa.int32()), lists.flatten())

        return whole, side(self.ids_a), side(self.ids_b)


def words_of(text: str) -> list[str]:
    """The text in words: with a space before each they are the text with a space before it, and no token of either
    side reaches over a word's end."""
    if not LOOSE.search(text):
        return text.split(" ")
    parts = CUT.split(" " + text)
    return [parts[0][1:], *parts[1:]]


def as_flat(ids: Iterable[Sequence[int]]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int32), *[np.asarray(i, np.int32) for i in ids]])


def cut_at(ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> pa.ListArray | None:
    """The ids in lists that end after these numbers of bytes; None if no id ends at one of them."""
    total = np.cumsum(sizes[ids])
    at = np.searchsorted(total, ends)
    if not len(total) or total[-1] != ends[-1] or not np.array_equal(total[at], ends):
        return None
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], at + 1]), pa.int32()), pa.array(ids))


def as_lists(ids: list[Sequence[int]]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def gives(lists: pa.ListArray, tokens: pa.Array, sizes: np.ndarray, wanted: list[bytes]) -> np.ndarray:
    """Whether the tokens of each list, one after the other, are the wanted bytes."""
    ids, ends = lists.flatten(), lists.offsets.to_numpy()
    total = np.concatenate([[0], np.cumsum(sizes[ids.to_numpy()])])[ends]
    same = np.diff(total) == np.array([len(w) for w in wanted], np.int64)
    found = memoryview(tokens.take(ids).buffers()[2] or b"")[: total[-1]]
    if same.all() and found == b"".join(wanted):
        return same
    return same & np.array([bytes(found[a:b]) == w for a, b, w in zip(total, total[1:], wanted, strict=False)], bool)


@lru_cache(maxsize=2)
def sides_of(path_a: str, ranks_a: str | None, path_b: str) -> Sides:
    """One per worker process."""
    return Sides(path_a, ranks_a, path_b)


def token_ends(lists: pa.ListArray, sizes: np.ndarray, name: str) -> pa.Table:
    """The tokens of all texts with the key (text, byte after the token): a running sum, restarted at each text."""
    ids, parents = lists.flatten(), pc.list_parent_indices(lists)
    total = pc.cumulative_sum(pa.array(sizes[ids.to_numpy()]))
    offsets = lists.offsets.to_numpy()
    before = np.concatenate([[0], total.to_numpy()])[offsets[:-1]]
    ends = pc.subtract(total, pa.array(before).take(parents))
    key = pc.add(pc.shift_left(parents.cast(pa.int64()), END_BITS), ends)
    return pa.table({"key": key, name: ids})


def overlaps(a: pa.ListArray, b: pa.ListArray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> pa.Table:
    """All pairs of tokens of a text whose byte ranges overlap, in order: ``text``, ``a``, ``b``, and whether a
    token ``a_ends`` or ``b_ends`` there. Both sides must cover the same bytes."""
    one, other = token_ends(a, sizes_a, "a"), token_ends(b, sizes_b, "b")
    both = one.join(other, "key", join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
    ids_a, ids_b = both["a"].combine_chunks(), both["b"].combine_chunks()
    return pa.table(
        {
            "text": pc.shift_right(both["key"], END_BITS).cast(pa.int32()),
            "a": pc.fill_null_backward(ids_a),
            "b": pc.fill_null_backward(ids_b),
            "a_ends": ids_a.is_valid(),
            "b_ends": ids_b.is_valid(),
        }
    )


def group_texts(links: pa.Table, texts: int) -> list[str]:
    """The groups of each text: ``a1,a2|b1;a3|b2,b3``."""
    a_ends, b_ends = links["a_ends"].to_numpy(), links["b_ends"].to_numpy()
    closed = a_ends & b_ends
    group = np.concatenate([[0], np.cumsum(closed)])[:-1]
    group_a, group_b = group[a_ends], group[b_ends]
    n = int(closed.sum())
    up_to_a, up_to_b = np.cumsum(np.bincount(group_a, minlength=n)), np.cumsum(np.bincount(group_b, minlength=n))
    ids_a, ids_b = links["a"].filter(pa.array(a_ends)), links["b"].filter(pa.array(b_ends))

    def marked(ids: pa.ChunkedArray, of: np.ndarray, mark: str) -> pa.Array:
        last = pa.array(np.append(of[1:] != of[:-1], True))
        return pc.binary_join_element_wise(ids.cast(pa.string()).combine_chunks(), pc.if_else(last, mark, ","), "")

    if not n:
        return [""] * texts
    # A group's tokens of the first side stand before those of the second.
    place_a = np.arange(len(group_a)) + np.concatenate([[0], up_to_b])[group_a]
    place_b = np.arange(len(group_b)) + up_to_a[group_b]
    order = np.empty(len(place_a) + len(place_b), np.int64)
    order[place_a], order[place_b] = np.arange(len(place_a)), np.arange(len(place_a), len(order))
    words = pa.concat_arrays([marked(ids_a, group_a, "|"), marked(ids_b, group_b, ";")]).take(pa.array(order))
    text = links["text"].to_numpy()
    sizes = np.bincount(text[a_ends], minlength=texts) + np.bincount(text[b_ends], minlength=texts)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), words)
    return [t[:-1] for t in pc.binary_join(lists, "").to_pylist()]


def pair_ids(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (pair >> ID_BITS).astype(np.int32), (pair & ((1 << ID_BITS) - 1)).astype(np.int32)


def pair_counts(links: pa.Table) -> pa.Table:
    """How often each pair stands in each text: ``text``, ``pair``, ``times``, ordered by text."""
    pair = pc.bit_wise_or(pc.shift_left(links["a"].cast(pa.int64()), ID_BITS), links["b"].cast(pa.int64()))
    found = pa.table({"text": links["text"], "pair": pair}).group_by(["text", "pair"], use_threads=False)
    found = found.aggregate([([], "count_all")]).rename_columns(["text", "pair", "times"])
    return found.sort_by("text")


class Block:
    """The texts of a partition, cut into blocks, with the partial counts of the open block."""

    def __init__(self, partition: int, limit: int):
        self.id, self.limit, self.size = partition << END_BITS, limit, 0
        self.parts: list[pa.Table] = []

    def add(self, counts: pa.Table) -> None:
        part = counts.group_by("pair", use_threads=False).aggregate([([], "count_all")])
        self.parts.append(part.rename_columns(["pair", "times"]))
        self.size += counts.num_rows
        if len(self.parts) > 16:
            self.parts = [self.total()]

    def total(self) -> pa.Table:
        """The partial counts of all texts so far."""
        found = pa.concat_tables(self.parts).group_by("pair", use_threads=False).aggregate([("times", "sum")])
        return found.rename_columns(["pair", "times"])

    def closed(self) -> tuple[int, pa.Table]:
        done = self.id, self.total()
        self.id, self.size, self.parts = self.id + 1, 0, []
        return done


def stored_pairs(texts: DataFrame, path_a: str, ranks_a: str | None, path_b: str, block_pairs: int) -> DataFrame:
    """The first pass over ``texts`` (``key``, ``text``): a row per text with its distinct pairs, and a row per block
    (``whole``) with those of all its texts and how many hold each."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = texts.schema["key"].dataType.simpleString()
    schema = texts.sparkSession.createDataFrame([], f"key {kind}, {STORED}, {PAIRS}").schema
    arrow = to_arrow_schema(schema)
    lists = pa.list_(pa.int32())

    def rows(block: Block, keys: pa.Array, texts: list[str], sides: Sides) -> pa.RecordBatch:
        told, a, b = sides.ids(texts)
        links = overlaps(a, b, sides.sizes_a, sides.sizes_b)
        counts = pair_counts(links)
        block.add(counts)
        n, text = len(texts), links["text"].to_numpy()
        closed = links["a_ends"].to_numpy() & links["b_ends"].to_numpy()
        groups = group_texts(links, n)
        sums = [hashlib.sha256(g.encode()).hexdigest() if t else "" for g, t in zip(groups, told, strict=True)]
        at = np.concatenate([[0], np.cumsum(np.bincount(counts["text"].to_numpy(), minlength=n))])
        of_a, of_b = pair_ids(counts["pair"].to_numpy())
        columns = {
            "key": keys,
            "block": np.full(n, block.id),
            "whole": np.zeros(n, bool),
            "n_a": np.diff(a.offsets.to_numpy()),
            "n_b": np.diff(b.offsets.to_numpy()),
            "n_groups": np.bincount(text[closed], minlength=n),
            "n_links": np.bincount(text, minlength=n),
            "groups_sha256": sums,
            **{
                name: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))
                for name, values in (("a", of_a), ("b", of_b), ("times", counts["times"].to_numpy()))
            },
        }
        return pa.RecordBatch.from_arrays([as_type(columns[f.name], f.type) for f in arrow], schema=arrow)

    def as_type(values, kind: pa.DataType) -> pa.Array:
        return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)

    def block_row(block: int, counts: pa.Table) -> pa.RecordBatch:
        of_a, of_b = pair_ids(counts["pair"].to_numpy())
        values = {"block": [block], "whole": [True]} | {
            name: pa.array([column], lists) for name, column in (("a", of_a), ("b", of_b), ("times", counts["times"].to_numpy()))
        }
        return pa.RecordBatch.from_arrays(
            [as_type(values.get(f.name, [None]), f.type) for f in arrow], schema=arrow
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sides = sides_of(path_a, ranks_a, path_b)
        block = Block(TaskContext.get().partitionId(), block_pairs)
        for batch in batches:
            keys, column = batch.column("key"), batch.column("text")
            size = np.cumsum(pc.fill_null(pc.utf8_length(column), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                # As many texts as make up a number of letters, at least one.
                limit = (size[at - 1] if at else 0) + LETTERS_AT_ONCE
                stop = min(max(int(np.searchsorted(size, limit, "right")), at + 1), at + ROWS_AT_ONCE)
                part = column.slice(at, stop - at).to_pylist()
                yield rows(block, keys.slice(at, stop - at), part, sides)
                at = stop
                if block.size >= block.limit:
                    yield block_row(*block.closed())
        if block.parts:
            yield block_row(*block.closed())
        pa.default_memory_pool().release_unused()

    return texts.mapInArrow(work, schema)


def aligned(
    texts: DataFrame,
    key: str,
    text: str,
    path_a: str,
    path_b: str,
    ranks_a: str | None = None,
    block_pairs: int = BLOCK_PAIRS,
) -> tuple[DataFrame, DataFrame]:
    """Each text's alignment, and the table of all token pairs.

    The first has ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``; the second
    ``a``, ``b``, ``count`` (the texts that hold the pair linked) and ``best`` (no other pair of that ``a`` has more).
    ``path_a`` is a byte-level file of the ``tokenizers`` library, which gets a space before each text, ``path_b`` a
    model of ``sentencepiece``, which adds it; ``ranks_a`` may name the first one's vocabulary as a rank file.

    Texts that are null or empty, or that one side cannot give back byte by byte, have no tokens: their numbers are
    zero and ``groups_sha256`` is empty. Repeated rows are texts of their own, and count as such. Null keys are kept; an
    empty table gives no rows; other columns are not looked at.
    """
    spark = texts.sparkSession
    importable(spark)
    small_batches(spark)
    ready_checkpoints(spark)
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    folder = f"{spark.sparkContext.getCheckpointDir()}/pairs-{uuid.uuid4().hex}"
    stored_pairs(rows, path_a, ranks_a, path_b, block_pairs).write.parquet(folder)
    stored = spark.read.parquet(folder)
    zipped = F.explode(F.arrays_zip("a", "b", "times"))
    partial = stored.where("whole").select("block", zipped.alias("p")).select("block", "p.a", "p.b", "p.times")
    counts = partial.groupBy("a", "b").agg(F.sum("times").alias("count"))
    most = counts.groupBy(F.col("a").alias("of")).agg(F.max("count").alias("most"))
    totals = counts.join(most, F.col("a") == F.col("of")).select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    # Blocks ask for the totals of their own pairs.
    told = partial.select("block", "a", "b").join(totals, ["a", "b"])
    kind = texts.schema[key].dataType.simpleString()
    own = spark.read.parquet(folder).where("NOT whole").drop("whole")
    schema = f"key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"

    def summed(docs: pa.Table, facts: pa.Table) -> pa.Table:
        flat = {n: pc.list_flatten(docs[n]) for n in ("a", "b", "times")}
        links = pa.table({"text": pc.list_parent_indices(docs["a"].combine_chunks()), **flat})
        links = links.join(facts.drop_columns(["block"]), ["a", "b"], use_threads=False)
        count = pc.multiply(links["times"].cast(pa.int64()), links["count"])
        best = pc.if_else(links["best"], links["times"].cast(pa.int64()), 0)
        sums = pa.table({"text": links["text"], "count": count, "best": best}).group_by("text", use_threads=False)
        sums = sums.aggregate([("count", "sum"), ("best", "sum")])
        out = {n: np.zeros(docs.num_rows, np.int64) for n in ("best", "count")}
        for n, values in out.items():
            values[sums["text"].to_numpy()] = sums[f"{n}_sum"].to_numpy()
        return pa.table(
            {
                **{n: docs[n] for n in ("key", "n_a", "n_b", "n_groups", "n_links")},
                "n_best": out["best"],
                "count_sum": out["count"],
                "groups_sha256": docs["groups_sha256"],
            }
        )

    # Each block's texts meet the facts about their pairs; both are bounded by the block's size.
    found = own.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(summed, schema)
    return found.withColumnRenamed("key", key), totals


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of both given vocabularies aligned over every whole text of ``documents``."""
    import public_tokenizers as given

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    paths = given.path("byte_bpe_50k.json"), given.path("piece_bpe_32k.model"), given.path("byte_bpe_50k.tiktoken")
    return aligned(docs, "doc_id", "text", *paths)[0]
