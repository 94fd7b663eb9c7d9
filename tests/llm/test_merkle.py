"""The manifest against a plain tree: hot and tiny groups, ties, nulls, repeated rows, and trees of several storeys."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gristmill.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, at_ string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def tree(nodes):
    """The root, and the siblings of each node, by building every level whole."""
    levels = []
    top = nodes
    while len(top) > 1:
        levels.append(top)
        top = [digest(*top[i : i + 16]) for i in range(0, len(top), 16)]
    paths = []
    for k in range(len(nodes)):
        path, i = [], k
        for level in levels:
            run = level[i // 16 * 16 : i // 16 * 16 + 16]
            path.append((run[: i % 16], run[i % 16 + 1 :]))
            i //= 16
        paths.append(path)
    return top[0], paths


def plain(rows):
    value = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: digest(*map(value, (r[0], r[3], r[2], r[4], t)))
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[g] = tree([leaf(r, r[1]) for r in groups[g]])
    root, upper = tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, upper, strict=True):
        for r, path in zip(groups[g], trees[g][1], strict=True):
            node = leaf(r, r[1])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                node = leaf(r, r[1].translate(LOW))
            for left, right in path + top:
                node = digest(*left, node, *right)
            siblings = [x for left, right in path + top for x in left + right]
            out.append((r[0], leaf(r, r[1]), trees[g][0], root, digest(*siblings), node, node == root))
    return sorted(out, key=str)


def ask(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, merkle.report(df).collect()), key=str)


def test_against_a_plain_tree(spark):
    rng = random.Random(3)
    text = lambda i: rng.choice(["A b", "x", "É Z", None, "", f"Q{i}"])
    rows = [(i, text(i), rng.choice(["en", None]), rng.choice(["hot"] * 5 + ["a", "b", None, "", "é"]), i % 11 or None) for i in range(900)]
    rows += [(5, "dup", "en", "hot", 3)] * 300 + [(5, "Other", "en", "hot", 3), (None, "n", "en", "z", 1), (None, "N", "en", "z", 1), (-3, "Ü" * 100_000, "en", "z", 1)]
    rows += [(i, "q", "en", f"s{i}", 1) for i in range(300)]  # more groups than one block of the upper tree
    got = ask(spark, rows)
    assert got == plain(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4097])
def test_sizes(spark, n):
    rows = [(i, f"T{i}", "en", "s", i) for i in range(n)]
    assert ask(spark, rows) == plain(rows)


def test_many_storeys(spark, monkeypatch):
    """Blocks of one level: a group of 300 rows has three storeys."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = [(i, f"T{i}", "en", "ab"[i % 7 == 0], i) for i in range(330)]
    assert ask(spark, rows) == plain(rows)


def test_traversal_holds_two_runs_a_level():
    leaves = [digest(str(i)) for i in range(300)]
    root, paths = tree(leaves)
    got = list(merkle.traversed(leaves, merkle.height_of(300)))
    assert got == [[("".join(a), "".join(b)) for a, b in path] for path in paths]
    assert merkle.root_of(leaves, merkle.height_of(300)) == root
    level = merkle.Level(1)
    for k, leaf in enumerate(leaves):
        level.add(leaf, k == 299)
        assert sum(map(len, level.stack.runs)) < 16
        if k % 256 == 255:
            level.turn()


def test_empty_table_and_clashes(spark):
    assert ask(spark, [], 1) == []
    with pytest.raises(ValueError):
        merkle.manifest(spark.createDataFrame([(1, "s", "l", "p")], "o long, s string, leaf string, Path string"), "s", "o")
    made = merkle.manifest(spark.createDataFrame([(1, "s", "x", 5)], "o long, s string, leaf string, g int"), "s", "o")
    assert made.columns == ["o", "s", "leaf", "g", "at", "subroot", "root", "path"]
    assert made.select("subroot", "root", F.size("path")).first()[:] == ("x", "x", 0)
