"""The Merkle manifest against trees built by plain recursion."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tablesnap.llm import merkle
from tablesnap.llm.queries import ORACLES, QUERIES

NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    shown = [None if v is None else str(v) for v in row]
    return digest(*["-" if v is None else f"{len(v.encode())}:{v}" for v in shown])


def tree(leaves):
    """The last node, and for each leaf what stands left and right of it on each level."""
    paths = [[] for _ in leaves]
    at, nodes = list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for n, path in enumerate(paths):
            i = at[n]
            run = i - i % 8
            path.append((nodes[run:i], nodes[i + 1 : run + 8]))
            at[n] = i // 8
        nodes = [digest(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain(rows):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf_of(r))))
        trees[lang] = tree([leaf_of(r) for r in by_lang[lang]])
    root, tops = tree([trees[v][0] for v in langs]) if langs else (None, [])
    out = []
    for lang, top in zip(langs, tops):
        for row, path in zip(by_lang[lang], trees[lang][1]):
            whole = path + top
            changed = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                changed = (*row[:4], row[4].translate(LOWER))
            node = leaf_of(changed)
            for left, right in whole:
                node = digest(*left, node, *right)
            proof = digest(*[d for left, right in whole for d in left + right])
            out.append((row[0], leaf_of(row), trees[lang][0], root, proof, node, node == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def stored(spark, folder, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.select("*", *[F.lit(7).alias(n) for n in ("key", "row", "tree", "size", "pos", "digest", "kind")])
    df.repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def rows_of(sizes):
    n = 0
    for lang, size in sizes.items():
        for _ in range(size):
            yield n * 7 - 5, None if n % 5 == 0 else f"s{n % 3}", lang, None if n % 4 == 0 else n, None if n % 11 == 0 else f"Text É {n % 13}"
            n += 1


SHAPES = {
    "runs of all lengths": {"en": 75, "de": 8, "fr": 9, "es": 1, None: 64, "": 65, "é": 7},
    "one row": {"en": 1},
    "one group": {"en": 20},
    "many groups": {f"l{i}": 1 + i % 3 for i in range(70)},
    "a hot group": {"en": 5000, "x": 2},
}


@pytest.mark.parametrize("shape", SHAPES)
def test_equals_plain_recursion(spark, tmp_path, shape, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 64)
    rows = list(rows_of(SHAPES[shape]))
    found = QUERIES["op13_merkle_manifest"](spark, stored(spark, str(tmp_path), rows))
    assert found.columns == NAMES
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)


def test_repeated_and_null_keys(spark, tmp_path):
    rows = [(3, "s", "en", 1, t) for t in ("b", "a", "a", None, "", "A" * 100_000)] * 4
    rows += [(None, None, None, None, None)] * 12 + [(None, "s", "en", 2, "c")]
    found = QUERIES["op13_merkle_manifest"](spark, stored(spark, str(tmp_path), rows))
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)


def test_null_is_not_empty(spark, tmp_path):
    one = stored(spark, str(tmp_path / "a"), [(1, None, "en", 1, "x")])
    other = stored(spark, str(tmp_path / "b"), [(1, "", "en", 1, "x")])
    roots = [QUERIES["op13_merkle_manifest"](spark, f).first().root for f in (one, other)]
    assert roots[0] != roots[1]


def test_no_rows(spark, empty):
    assert QUERIES["op13_merkle_manifest"](spark, empty).collect() == []


def test_sql_twin(spark, tmp_path):
    folder = stored(spark, str(tmp_path), list(rows_of(SHAPES["runs of all lengths"])))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    wanted = con.sql(ORACLES["op13_merkle_manifest"])
    assert wanted.columns == NAMES
    found = QUERIES["op13_merkle_manifest"](spark, folder).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(wanted.fetchall(), key=repr)
