import zlib
from hashlib import sha256

from tessera.llm import merkle
from tessera.llm.common import read

from .cases import empty, odd, odd_rows, plain, table


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows):
    """doc_id, source, lang, n_chars, text of each row in any order; whole levels of one tree after another, proofs from them."""

    def leaf(r, text):
        return H(field(r[0]), field(r[1]), field(r[2]), field(r[3]), field(text))

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
        return levels

    def siblings(levels, k):
        out = []
        for level in levels[:-1]:
            first = k // 3 * 3
            out.append((level[first:k], level[k + 1 : first + 3]))
            k //= 3
        return out

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    per = {s: sorted(((r[0] is not None, r[0] or 0, leaf(r, r[4]), r) for r in rows if r[1] == s), key=lambda x: x[:3]) for s in sources}
    trees = {s: climb([x[2] for x in per[s]]) for s in sources}
    top = climb([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (*_, own, r) in enumerate(per[s]):
            steps = siblings(trees[s], i) + siblings(top, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            at = leaf(r, r[4].replace("\n", "")) if tampered else own
            for before, after in steps:
                at = H(*before, at, *after)
            root = top[-1][0]
            out.append((r[0], own, trees[s][-1][0], root, H(*[x for b, a in steps for x in b + a]), at, at == root))
    return sorted(out, key=repr)


def test_table_against_whole_levels(spark, sf):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in table(sf, "documents")]
    assert plain(merkle.verified(read(spark, sf, "documents"))) == brute(rows)


def test_odd_rows_and_empty_table(spark):
    assert plain(merkle.verified(odd(spark))) == brute([(r[0], r[3], r[2], r[4], r[1]) for r in odd_rows()])
    assert merkle.verified(empty(spark)).count() == 0
    one = spark.createDataFrame([(7, "a\nb", None, "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    assert plain(merkle.verified(one)) == brute([(7, "s", None, 3, "a\nb")])


def test_small_blocks_and_many_rounds(spark):
    """Blocks of nine nodes: three rounds for the large source, two for the sources themselves."""
    rows = [(i, f"s{i}" if i % 4 == 0 else "hot", None, i, f"text {i}\nmore") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert plain(merkle.verified(docs, height=2)) == brute(rows)
    each = spark.createDataFrame([(i, f"s{i}", "x", 1, "a\nb") for i in range(30)], docs.schema)
    assert plain(merkle.verified(each, height=2)) == brute([(i, f"s{i}", "x", 1, "a\nb") for i in range(30)])


def test_versions_copy_ancestors_only(spark):
    """A version has one new node on each level of its leaf's way up, and none elsewhere."""
    rows = [(i, "s", None, i, f"t{i}\n") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    from pyspark.sql import functions as F

    found = {r.doc_id: r for r in merkle.versions(docs, F.lit("other"), F.col("doc_id") == 5).collect()}
    assert len(found[5].copies) == len(found[5].proof) == 4 and found[5].copies[-1] != found[5].root
    assert all(r.version == r.leaf and r.copies[-1] == r.root for i, r in found.items() if i != 5)
    shared = {d for i in found if i != 5 for d in found[i].copies}
    assert not set(found[5].copies) & shared
