"""Token alignment against a plain walk over both token lists."""

import hashlib
from collections import Counter, defaultdict
from functools import cache

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablesnap.llm import alignment

NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@cache
def level_bytes(entry):
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in visible}
    for b in (b for b in range(256) if b not in visible):
        byte_of[chr(256 + len(byte_of) - len(visible))] = b
    return bytes(byte_of[c] for c in entry)


def ends(tokens):
    out, at = [], 0
    for token in tokens:
        at += len(token)
        out.append(at)
    return out


def plain(texts):
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows, links = [], []
    for text in texts:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = other.encode(text) if text else []
        a_bytes = [level_bytes(one.id_to_token(i)) for i in a]
        pieces = [other.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if other.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            rows.append([0, 0, 0, 0, ""])
            links.append([])
            continue
        a_ends, b_ends = ends(a_bytes), ends(b_bytes)
        pairs, groups, i, j, left, right = [], [], 0, 0, 0, 0
        while i < len(a):
            pairs.append((a[i], b[j]))
            step = a_ends[i] - b_ends[j]
            i, j = i + (step <= 0), j + (step >= 0)
            if step == 0:
                groups.append(",".join(map(str, a[left:i])) + "|" + ",".join(map(str, b[right:j])))
                left, right = i, j
        rows.append([len(a), len(b), len(groups), len(pairs), hashlib.sha256(";".join(groups).encode()).hexdigest()])
        links.append(pairs)
    count = Counter(pair for pairs in links for pair in set(pairs))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [
        (*row[:4], sum(count[p] == most[p[0]] for p in pairs), sum(count[p] for p in pairs), row[4])
        for row, pairs in zip(rows, links)
    ], count


def align(spark, texts, **more):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")
    # Columns of names that are used inside.
    df = df.select("*", *[F.lit(1).alias(c) for c in ("key", "block", "a", "times", "whole")]).repartition(3)
    paths = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken")]
    found, pairs = alignment.aligned(df, "n", "text", *paths, **more)
    return [tuple(r[n] for n in NAMES) for r in found.orderBy("n").collect()], pairs


ODD = [
    "a  b   c\n \n  d ", " leading", "trailing ", "   ", "\n", "tab\there", "no break", "▁ stands for a space", "x▁y",
    "<|endoftext|> and <s> and </s> and <unk> <0x41>", "日本語のテキスト😀 é́", "İstanbul ſecret", "ﬁ ½ é", "1234567890 " * 30,
    "word", "word", "word word word", "a" * 5000, "it's don't we'll", "Ωmega ❤️‍🔥", "\x00\x01 control", "zero​width x", "\r\n\r\n",
]


def test_alignment_equals_a_plain_walk(spark, texts):
    every = [t for _, t in texts] + ODD
    found, pairs = align(spark, every, block_pairs=500)
    wanted, count = plain(every)
    assert found == wanted
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == count


def test_one_block_or_many_give_the_same(spark):
    every = ["the same words again and again " * n for n in (1, 2, 50)] * 20
    assert align(spark, every, block_pairs=3)[0] == align(spark, every)[0] == plain(every)[0]


def test_very_long_text(spark):
    long = "some words that stand here, " * 60_000
    (row,), _ = align(spark, [long])
    assert row == plain([long])[0][0]


def test_no_rows(spark):
    assert align(spark, [])[0] == []


def test_query(spark, corpus, texts):
    from tablesnap.llm.queries import QUERIES

    found = QUERIES["op12_token_alignment"](spark, corpus)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == sorted([(k, *row) for (k, _), row in zip(texts, plain([t for _, t in texts])[0])], key=repr)
