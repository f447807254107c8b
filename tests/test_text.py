import unicodedata

from pyspark.sql import functions as F

from lexloom.functions import text


def _one_edit(a, b):
    if a == b:
        return True
    edits = {a[:i] + a[i + 1:] for i in range(len(a))}
    edits |= {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in set(b)} | {a[:i] + c + a[i + 1:] for i in range(len(a)) for c in set(b)}
    edits |= {a[:i] + a[i + 1] + a[i] + a[i + 2:] for i in range(len(a) - 1)}
    return b in edits


def test_strip_takes_every_kind_of_white_space(spark):
    cases = [chr(c) for c in range(0x3100) if chr(c).isspace()] + [" \t x y  ", "", " 　", None]
    df = spark.createDataFrame([(c if c is None else c + "a" + c,) for c in cases], "s string").select("s", text.strip(F.col("s")).alias("t"))
    for row in df.collect():
        assert row.t == (None if row.s is None else row.s.strip())


def test_name_key_is_that_of_unicode(spark):
    cases = ["Étoile", "ｗｉｄｅ", "ﬃx", "áb", "Straße", "X™", "½", "𝔄bc", "İst", "", "—", "日本", None, "Ångström-7 K"]
    want = [None if c is None else "".join(x for x in unicodedata.normalize("NFKD", c).lower() if x.isascii() and x.isalnum()) for c in cases]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s string").select("i", text.name_key(F.col("s")).alias("k"))
    assert [r.k for r in df.orderBy("i").collect()] == want


def test_one_edit(spark):
    words = ["figma", "figmaa", "figm", "figna", "ifgma", "fimga", "igmaz", "gfima", "figma", "", "f", "if", "fi"]
    pairs = [(a, b) for a in words for b in words]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", text.within_one_edit(F.col("a"), F.col("b")).alias("near"))
    for row in df.collect():
        assert row.near == _one_edit(row.a, row.b), row


def test_deletions(spark):
    df = spark.createDataFrame([("abca",), ("aa",), ("x",), ("",), (None,)], "s string").select("s", text.deletions(F.col("s")).alias("d"))
    found = {r.s: r.d for r in df.collect()}
    assert set(found["abca"]) == {"bca", "aca", "aba", "abc"} and found["aa"] == ["a"] and found["x"] == [""] and found[""] == []


def test_letters_and_digits(spark):
    df = spark.createDataFrame([("  “Ab-C é” 7™",), ("",), (None,)], "s string").select(text.letters_and_digits(F.col("s")).alias("t"))
    assert [r.t for r in df.collect()] == ["abcé7", "", None]


def test_all_forms_of_letters_are_known():
    import sys
    import unicodedata

    from lexloom.functions import text

    beyond = (chr(c) for c in range(text.END_OF_LETTERS, sys.maxunicode + 1))
    assert not [c for c in beyond if any(x.isascii() and x.isalnum() for x in unicodedata.normalize("NFKD", c))]
