"""Manifests against hashes computed plainly, all levels at hand."""

import hashlib
import zlib

from pyspark.sql import functions as F

from gridmend.llm import merkle

from compare import connect, differences

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, position int, digest string, salt int, height int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def prove(nodes):
    """(root, for each node its siblings left and right by level)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            start = p - p % 16
            paths[i].append(("".join(nodes[start:p]), "".join(nodes[p + 1 : start + 16])))
        nodes = [h("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at = [p // 16 for p in at]
    return nodes[0], paths


def brute_force(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append((r, leaf(r, r[1])))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = prove([d for _, d in by_source[s]])
    root, over = prove([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, over):
        for (r, d), path in zip(by_source[s], trees[s][1]):
            now = r[1]
            if r[0] is not None and now is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                now = "".join(c.lower() if "A" <= c <= "Z" else c for c in now)
            folded = leaf(r, now)
            for left, right in path + above:
                folded = h(left + folded + right)
            out.append((r[0], d, trees[s][0], root, h("".join(a + b for a, b in path + above)), folded, folded == root))
    return sorted(out, key=str)


def found(spark, rows):
    table = spark.createDataFrame([(*r, "t", 1, "d", 2, 3) for r in rows], SCHEMA).repartition(3)
    table = table.withColumn("tampered", merkle.tampered(F.col("doc_id"), F.col("text")))
    return sorted((tuple(r) for r in merkle.manifest(table).collect()), key=str)


def test_agrees_with_sql(spark):
    problem, rows = differences(spark, connect(SMALL), SMALL, "op12_merkle_manifest")
    assert problem is None and rows > 0


def test_odd_rows(spark):
    rows = [(1, "Ab É", "en", "s", 4), (2, None, None, None, None), (None, "X", "en", None, 1), (None, "X", "en", None, 1), (3, "", "", "", 0), (4, "ÀZ" * 50_000, "fr", "é", 2),
            (5, "Same", "en", "z", 4), (5, "Same", "en", "z", 4), (5, "same", "en", "z", 4), (-7, "NEG", "en", "s", 3)]
    assert found(spark, rows) == brute_force(rows)


def test_trees_of_every_height(spark):
    """Sources of many sizes, so that levels end within, at and after the stored ones."""
    sizes = [1, 2, 16, 17, 256, 257, 4097]
    rows = [(i, f"Text {i}", "en", f"s{n}", i) for n in sizes for i in range(n)]
    assert found(spark, rows) == brute_force(rows)


def test_many_sources(spark):
    rows = [(i, f"Text {i}", "en", f"s{i % 300}", i) for i in range(700)]
    assert found(spark, rows) == brute_force(rows)


def test_without_tampered_texts_and_without_rows(spark):
    table = spark.createDataFrame([(1, "A", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.verified for r in merkle.manifest(table).collect()] == [True]
    assert merkle.manifest(table.limit(0)).collect() == []
