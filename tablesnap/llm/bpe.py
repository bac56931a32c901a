"""Byte-pair encoding and decoding by prefix sharing.

The distinct words of a set of texts are inserted into a trie. In a byte-pair encoding, the tokens of a prefix
are the tokens of a shorter prefix and one last token, and there is exactly one last token that fits: it ends the
prefix, and it stays as it is when the merges are applied to it together with the token before it. So each
node keeps the last token of its prefix only. Going down depth first, a node's last token is found from those
of the nodes above it, and a prefix that many words share is encoded once. The tokens of a word are read off
backwards, from node to node.

Each Spark task builds tries of the words it has not seen. Its memory is bounded by the size of its word cache
and by one text.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import count

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tablesnap.llm.common import map_rows, table
from tablesnap.llm.tokens import ChunkCache, Recent, chunks_of, special_tokens

PAIRS_KEPT = 1_000_000
NO_RANK = 1 << 60  # of two letters or tokens that are not merged


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for themselves,
    the others take the code points from 256 on, in order."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    other = count(256)
    return [chr(b if b in shown else next(other)) for b in range(256)]


def shared_prefix(one: str, other: str) -> int:
    """How many letters two words begin with alike."""
    low, high = 0, min(len(one), len(other))
    if one[:high] == other[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if one[low:middle] == other[low:middle]:
            low = middle
        else:
            high = middle
    return low


class TrieEncoder:
    """Encodes words, written in byte letters, with the vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.ids: dict[str, int] = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.longest = max(map(len, self.ids))
        self.fits: defaultdict[str, dict[str, bool]] = defaultdict(dict)
        self.kept = 0
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        self.packed = {t: i.to_bytes(4, "little") for t, i in self.ids.items()}
        self.bytes = {self.packed[t]: bytes(byte[c] for c in t) for t in self.ids if all(c in byte for c in t)}

    def merged(self, word: str) -> list[str]:
        """The tokens of a short word, merge by merge."""
        parts, rank = list(word), self.rank.get
        # The ranks of neighbours go along with the parts: a merge changes those beside it only.
        ranks = [rank(p, NO_RANK) for p in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) < NO_RANK:
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), NO_RANK)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), NO_RANK)
        return parts

    def stays(self, before: str, token: str) -> bool:
        """Whether the two tokens stay as they are side by side; ``before`` may be empty."""
        # Tokens that merge side by side cannot stay, whatever else is merged first.
        stays = token in self.ids and (before, token) not in self.rank
        stays = stays and self.merged(before + token) == ([before, token] if before else [token])
        if self.kept >= PAIRS_KEPT:
            self.kept = 0
            for row in self.fits.values():
                row.clear()
        self.kept += 1
        self.fits[before][token] = stays
        return stays

    def encode(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """The ids of each of the distinct words, as little-endian 32-bit integers, and the bytes they decode to.

        Sorted words are the paths of their trie in depth-first order: a word leaves the path of the one before
        it at the node that both share, and goes down from there. Only the states of the path are held.
        """
        found: list[tuple[bytes, bytes]] = [(b"", b"")] * len(words)
        packed, raw, fits, longest = self.packed, self.bytes, self.fits, self.longest
        before = ""
        lasts, rows = [""], [fits[""]]  # for each node of the path: its last token, and what is known to fit that
        for end in sorted(range(len(words)), key=words.__getitem__):
            word = words[end]
            size = len(word)
            shared = shared_prefix(before, word)
            del lasts[shared + 1 :], rows[shared + 1 :]
            for depth in range(shared + 1, size + 1):
                for start in range(depth - 1, depth - longest - 1 if depth > longest else -1, -1):
                    token = word[start:depth]
                    stays = rows[start].get(token)
                    if stays or stays is None and self.stays(lasts[start], token):
                        lasts.append(token)
                        rows.append(fits[token])
                        break
                else:
                    raise ValueError(f"The vocabulary has no token for {word[depth - 1]!r}")
            tokens, at = [], size
            while at:
                token = lasts[at]
                tokens.append(token)
                at -= len(token)
            ids = [packed[t] for t in reversed(tokens)]
            found[end] = b"".join(ids), b"".join([raw[i] for i in ids])
            before = word
        return found


# Texts of letters that every version of Unicode has, and of ASCII marks, digits, spaces and line ends, are cut into words
# without the library.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-/:-@\[-`{-~"
OTHER = re.compile(rf"[^\n -~{LETTERS}]")
WORDS = re.compile(
    rf" ?[{LETTERS}]+| ?[!-&(-/:-@\[-`{{-~][{MARKS}]*| ?[0-9]+|'(?:[sdmt]|ll|ve|re)| ?[{MARKS}]+|\s+(?!\S)|\s+"
)


def pieces_of(text: str) -> list[str]:
    """The words of a plain text, the chunks of others. A word is a chunk that is cut no further."""
    return chunks_of(text) if OTHER.search(text) else WORDS.findall(text)


class TextCodec:
    """Encodes whole texts, and decodes the ids again."""

    def __init__(self, path: str, cache: int = 250_000):
        from tokenizers import Tokenizer

        self.encoder = TrieEncoder(path)
        self.cut_words = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.space, self.line = byte_letters()[ord(" ")], byte_letters()[ord("\n")]
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        special = {t: (np.array([i], "<u4").tobytes(), t.encode()) for t, i in special_tokens(path).items()}
        self.words = Recent(self.encoder.encode, cache)
        self.cache = ChunkCache(self.encode_chunks, special, cache, pieces_of)

    def words_of(self, chunk: str) -> list[str]:
        """The words of a chunk, in byte letters."""
        if OTHER.search(chunk):
            return [w for w, _ in self.cut_words(chunk)]
        words = WORDS.findall(chunk)
        if chunk.isascii():
            return [w.replace(" ", self.space).replace("\n", self.line) for w in words]
        return [w.encode().decode("latin-1").translate(self.letters) for w in words]

    def encode_chunks(self, chunks: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids and decoded bytes of each chunk."""
        cut = [self.words_of(c) for c in chunks]
        # Chunks of one word are as distinct as their words, and the only ones to be remembered for these.
        alone = iter(self.encoder.encode([ws[0] for ws in cut if len(ws) == 1]))
        several, known = [ws for ws in cut if len(ws) > 1], self.words
        known.load({w for words in several for w in words if w not in known}, several)
        return [
            next(alone) if len(ws) == 1 else (b"".join([known[w][0] for w in ws]), b"".join([known[w][1] for w in ws]))
            for ws in cut
        ]

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[bytes, str]]:
        """For each text its packed ids, and the text decoded from them."""
        for found in self.cache.values(texts):
            ids, raw = zip(*found, strict=True) if found else ((), ())
            yield b"".join(ids), b"".join(raw).decode("utf-8", "replace")


@contextmanager
def uncollected() -> Iterator[None]:
    """Without the collector of cycles, which would go through all cached chunks again and again: encoding leaves no
    cycles behind, and what it drops is freed at once."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


@lru_cache(maxsize=2)
def codec(path: str) -> TextCodec:
    """One per worker process and tokenizer file."""
    return TextCodec(path)


def encode_texts(texts: DataFrame, key: str, text: str, path: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode the ``text`` column with the byte-level tokenizer file at ``path``.

    One row per row: ``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and with ``with_ids`` also the
    packed ``ids`` (little-endian 32-bit) and the ``decoded`` text. A null text counts as empty and has no
    tokens. Repeated rows and null keys give a row each; other columns are not looked at.
    """

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        encode = codec(path).encode
        for batch in batches:
            with uncollected():
                both = list(encode(t or "" for t in batch["text"]))
            out = {
                "key": batch["key"],
                "n_tokens": [len(i) // 4 for i, _ in both],
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i, _ in both],
                "decoded_sha256": [hashlib.sha256(d.encode()).hexdigest() for _, d in both],
            }
            if with_ids:
                out |= {"ids": [i for i, _ in both], "decoded": [d for _, d in both]}
            yield out

    kind = texts.schema[key].dataType
    schema = StructType(
        [
            StructField("key", kind),
            StructField("n_tokens", LongType()),
            StructField("ids_sha256", StringType()),
            StructField("decoded_sha256", StringType()),
        ]
    )
    if with_ids:
        schema = schema.add("ids", "binary").add("decoded", "string")
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_rows(rows, work, schema).withColumnRenamed("key", key)


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded."""
    import public_tokenizers

    return encode_texts(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        "doc_id",
        "text",
        public_tokenizers.path("byte_bpe_50k.json"),
    )
