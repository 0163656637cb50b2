import random

import duckdb
import pytest
from pyspark.sql import functions as F

from weft.functions import similarity, text

#: Pairs with their Jaro-Winkler similarity.
JARO = [
    ("martha", "marhta", 0.961111), ("dwayne", "duane", 0.84), ("dixon", "dicksonx", 0.813333), ("abcd", "abxy", 0.666667), ("aaaaaaaa", "aaaabbbb", 0.666667),
    ("abcdefgh", "abcdefgx", 0.95), ("", "", 0.0), ("", "a", 0.0), ("é", "è", 0.666667), ("éa", "èa", 0.8),
]


@pytest.mark.parametrize(("a", "b", "expected"), JARO)
def test_jaro_winkler_vectors(a, b, expected):
    assert similarity.jaro_winkler_arrays([a.encode()], [b.encode()])[0] == pytest.approx(expected, abs=1e-6)


def test_similarities_equal_another_engine(spark):
    random.seed(1)
    alphabet = "abcde éñ "
    pairs = [("".join(random.choices(alphabet, k=random.randint(0, 12))), "".join(random.choices(alphabet, k=random.randint(0, 12)))) for _ in range(800)]
    a, b = F.col("a"), F.col("b")
    ours = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").select(
        "i", similarity.jaro_winkler(a, b).alias("jw"), similarity.levenshtein_ratio(a, b).alias("lev"), similarity.byte_jaccards(a, b, b, a)["second"].alias("jac")
    )
    con = duckdb.connect()
    for row in ours.collect():
        x, y = pairs[row.i]
        jw, lev = con.execute("select jaro_winkler_similarity(?, ?), levenshtein(?, ?)", [x, y, x, y]).fetchone()
        assert row.jw == pytest.approx(jw, abs=1e-9)
        assert row.lev == pytest.approx(1 - lev / max(len(x), len(y)) if x or y else 1.0, abs=1e-9)
        if x and y:
            assert row.jac == pytest.approx(con.execute("select jaccard(?, ?)", [x, y]).fetchone()[0], abs=1e-9)
        else:
            assert row.jac == 0


def test_text_functions(spark):
    one = spark.range(1).select(
        text.strip_accents(F.lit("Café Ñandú ø ß ł Å ı İ")).alias("accents"),
        text.strip_accents(F.lit("कि का ガ й ё 한국")).alias("marks"),
        text.normalise(F.lit("  Café & Co., Ltd!  ")).alias("norm"),
        text.normalise(F.lit(None).cast("string")).alias("null"),
        text.without_legal(F.lit("acme co ltd inc pvt")).alias("legal"),
        text.digits(F.lit("ab12 cd034 12")).alias("digits"),
        text.tokens(F.lit("a bb bb ccc")).alias("tokens"),
    ).first()
    assert one.accents == "Cafe Nandu ø ß ł A ı I"
    assert one.marks == "क क カ и е 한국"
    assert (one.norm, one.null, one.legal) == ("cafe co ltd", "", "acme pvt")
    assert one.digits == ["12", "034"] and one.tokens == ["bb", "ccc"]


def test_tables_of_a_scope_are_deleted_at_its_end(spark):
    from pathlib import Path

    from weft.session import cut, scope

    def folder(df):
        return Path(df.inputFiles()[0].removeprefix("file://")).parent

    with scope(spark):
        gone, kept = cut(spark.range(3).groupBy("id").count()), cut(spark.range(4), keep=True)
        folders = folder(gone), folder(kept)
        assert all(f.exists() for f in folders)
    assert [f.exists() for f in folders] == [False, True] and kept.count() == 4


def test_values_lent_in_a_scope_are_deleted_at_its_end(spark):
    """broadcasts of a step don't stay on the disks until the session ends."""
    from pathlib import Path

    from weft.session import lent, scope

    with scope(spark):
        value = lent(spark, b"abc" * 1000)
        file = Path(value._path)
        assert spark.sparkContext.parallelize([1]).map(lambda _: len(value.value)).first() == 3000 and file.exists()
    assert not file.exists()


def test_matching_by_bits_equals_matching_by_places():
    """F7, F8: texts of up to 64 bytes are matched by the bits of a number; longer ones as before."""
    import random

    import numpy as np

    from weft.functions import similarity

    random.seed(7)
    for low, high in ((0, 3), (0, 30), (60, 64)):
        left = ["".join(random.choice("abc \0é") for _ in range(random.randint(low, high))).encode()[:64] for _ in range(400)]
        right = [t[1:] + t[:1] if random.random() < 0.5 else "".join(random.choice("abc \0é") for _ in range(random.randint(low, high))).encode()[:64] for t in left]
        la, lb = (np.array([len(t) for t in side]) for side in (left, right))
        a, b = similarity._matrix(left, max(1, la.max())), similarity._matrix(right, max(1, lb.max()))
        window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
        for x, y in zip(similarity._matched(a, b, la, lb, window), similarity._matched_by_bits(a, b, la, lb, window), strict=True):
            assert (x == y).all()
        mixed = similarity.jaro_winkler_arrays([*left, b"a" * 70], [*right, b"a" * 69])
        assert (mixed[:-1] == similarity.jaro_winkler_arrays(left, right)).all() and 0.99 < mixed[-1] < 1
