import hashlib
import zlib

import pytest
from corpus import clashing, empty, frame, rows, same
from pyspark.sql import functions as F

from sensorlake.llm import merkle
from sensorlake.llm.merkle import build, decode, fold, leaf, tree_of

NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def lower(t):
    return t if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def leaf_of(r, text):
    i, _, lang, source, n = r
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        n = levels[-1]
        levels.append([H("".join(n[i : i + 16])) for i in range(0, len(n), 16)])
    return levels


def siblings(levels, i):
    for run in levels[:-1]:
        first = i // 16 * 16
        yield run[first:i], run[i + 1 : first + 16]
        i //= 16


def brute(data):
    groups = {}
    for r in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1]))):
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([leaf_of(r, r[1]) for r in groups[s]]) for s in order}
    top = climb([trees[s][-1][0] for s in order])
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            x = leaf_of(r, lower(r[1]) if tampered else r[1])
            proof = ""
            for before, after in [*siblings(trees[s], i), *siblings(top, k)]:
                x = H("".join([*before, x, *after]))
                proof += "".join(before + after)
            yield r[0], leaf_of(r, r[1]), trees[s][-1][0], top[-1][0], H(proof), x


def leaves(df):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.select(
        tree_of("source").alias("tree"),
        F.col("doc_id").alias("key"),
        leaf(*NAMES).alias("digest"),
        F.when(tampered, leaf(*NAMES[:-1], small)).alias("tampered"),
    )


def proofs(manifest):
    return manifest.proofs("tampered").select("key", "leaf", "subroot", "root", "proof", "folded").collect()


@pytest.fixture(params=[1, 3])
def block_levels(request, monkeypatch):
    """Blocks of 16 leaves make several tables of nodes."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", request.param)
    monkeypatch.setattr(merkle, "BLOCK", 16**request.param)


def many(n, sources):
    return [(i, f"Text {i * 7 % 31} É", "en", None if i % sources == 0 else f"s{i % sources}", i) for i in range(n)]


def test_awkward_rows(spark, block_levels):
    df = clashing(frame(spark), "tree", "key", "pos", "n", "digest", "block")
    same(proofs(build(leaves(df))), brute(rows()))


def test_several_levels_and_a_hot_source(spark, block_levels):
    data = many(900, 40) + [(10_000 + i, "hot", None, "hot", None) for i in range(600)]
    same(proofs(build(leaves(spark.createDataFrame(data, frame(spark).schema).repartition(5)))), brute(data))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_sizes_around_runs(spark, block_levels, n):
    data = [(i, "A" * (i % 3), "en", "one", i) for i in range(n)]
    same(proofs(build(leaves(spark.createDataFrame(data, frame(spark).schema)))), brute(data))


def test_witnesses_lead_to_the_root(spark):
    manifest = build(leaves(frame(spark)))
    got = manifest.witnesses().collect()
    assert len(got) == len(rows())
    assert {fold(r["digest"], decode(r["witness"])) for r in got} == {manifest.root}


def test_append_equals_building_anew(spark, block_levels):
    schema = frame(spark).schema
    first, second = many(300, 6), [(i + 300, *r[1:]) for i, r in enumerate(many(170, 9))]
    manifest = build(leaves(spark.createDataFrame(first, schema))).append(leaves(spark.createDataFrame(second, schema)))
    same(proofs(manifest), brute(first + second))
    assert manifest.root == build(leaves(spark.createDataFrame(first + second, schema))).root


def test_append_fills_blocks_exactly(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    data = [(i, "t", "en", "one", i) for i in range(80)]
    parts = [spark.createDataFrame(data[a:b], frame(spark).schema) for a, b in ((0, 32), (32, 33), (33, 80))]
    manifest = build(leaves(parts[0]))
    for p in parts[1:]:
        manifest = manifest.append(leaves(p))
    same(proofs(manifest), brute(data))


def test_empty_table(spark):
    manifest = build(leaves(empty(spark)))
    assert manifest.root is None and proofs(manifest) == []
