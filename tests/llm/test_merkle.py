import hashlib
import random
import zlib

from pyspark.sql import functions as F

from routeledger.llm import merkle

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KIND = "doc_id long, source string, lang string, n_chars long, text string, tree string, place int, n int, hash string, block int, path int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    out = ""
    for v in (row[0], row[1], row[2], row[3], text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def climb(hashes):
    """Root, and for each node the siblings on its way up."""
    path = [[] for _ in hashes]
    above = list(range(len(hashes)))
    while len(hashes) > 1:
        for i, at in enumerate(above):
            low = at - at % 8
            run = hashes[low:low + 8]
            path[i].append((run[:at - low], run[at - low + 1:]))
            above[i] = at // 8
        hashes = [sha("".join(hashes[a:a + 8])) for a in range(0, len(hashes), 8)]
    return hashes[0], path


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r, r[4])), r) for r in rows if r[2] == lang)
        trees.append(([r for _, r in own], *climb([k[2] for k, _ in own])))
    root, tops = climb([t[1] for t in trees])
    out = []
    for (own, subroot, paths), top in zip(trees, tops):
        for row, path in zip(own, paths):
            new = first = leaf(row, row[4])
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                new = leaf(row, row[4].translate(FOLD))
            proof, node = "", new
            for left, right in path + top:
                proof += "".join(left + right)
                node = sha("".join(left) + node + "".join(right))
            out.append((row[0], first, subroot, root, sha(proof), node, node == root))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "h", 3, 4) for r in rows], KIND)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_many_leaves_and_languages_equal_brute_force(spark):
    """Trees of three stages, lone leaves, and more languages than a block holds."""
    rnd = random.Random(3)
    rows = [(i * 3 - 500, "s", "big", i, f"Text {rnd.random()}") for i in range(1100)]
    rows += [(i, None, f"l{i % 530}", None, rnd.choice(["A", "b", "", None, "ÄÖ x"])) for i in range(600)]
    rnd.shuffle(rows)
    assert result(merkle.manifest(table(spark, rows))) == plain(rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "s", None, 1, "A"), (None, "s", None, 1, "B"), (2, "", "", 0, ""),
            (3, "s", "é", 5, "X" * 50_000), (3, "s", "é", 5, "X" * 50_000), (3, "s", "é", 6, "other"), (7, "s", "z", 1, "ONE")]
    assert result(merkle.manifest(table(spark, rows))) == plain(rows)
    assert result(merkle.manifest(table(spark, rows[-1:]))) == plain(rows[-1:])
    assert merkle.manifest(table(spark, [])).count() == 0


def test_a_version_copies_its_ancestors_only(spark):
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(600)]
    tree = merkle.Manifest(merkle.leaves(table(spark, rows)))
    versions = tree.versions()
    changed = versions.where("changed is not null")
    assert changed.where(F.size("copies") != 4).count() == 0 and changed.count() > 100
    assert versions.where("changed is null and copies is not null").count() == 0
    assert [len(stage.collect()) for stage in tree.stages.nodes] == [600, 2, 1]


def test_equal_rows_do_not_share_one_range(spark):
    rows = [(5, "s", "en", 1, "same")] * 3000
    ranked = merkle.ranked(merkle.leaves(table(spark, rows)), ["doc_id", "hash"])
    assert sorted(r.place for r in ranked.collect()) == list(range(3000))
    parts = ranked.sparkSession.read.parquet(ranked.inputFiles()[0].rsplit("/", 1)[0]).groupBy("part").count().collect() \
        if ranked.inputFiles() else []
    assert all(r["count"] < 2000 for r in parts)
