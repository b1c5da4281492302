import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from listwright import functions as fn
from listwright.operators import dedupe, emails


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in df.select("i", function("v").alias("out")).orderBy("i").collect()]


def plain(value):
    """The name rule, in Python, for text without letters beyond Latin-1."""
    if value is None:
        return ""
    value = value.strip().lower().replace("ß", "ss").replace("æ", "ae").replace("\xa0", " ")
    value = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
    value = re.sub(r"[^a-z0-9_.\- ]", "", value)
    return re.sub(r"\s+", " ", value).strip()


def test_normalize_name_cases(spark):
    values = ["User1", "user2", "USER3", "user_4", "user-5", "user.6", "user 7", "üsér8", "user9!"]
    assert apply(spark, fn.normalize_name, values) == [
        "user1", "user2", "user3", "user_4", "user-5", "user.6", "user 7", "user8", "user9",
    ]
    values = ["a\tb", "a   b", "\xa0a\xa0", "Straße", "Ñandú", "œuf", None, "", "!!!", "a \t b"]
    assert apply(spark, fn.normalize_name, values) == [
        "ab", "a b", "a", "strasse", "nandu", "oeuf", "", "", "", "a b",
    ]


def test_normalize_name_on_random_text(spark):
    rng = random.Random(7)
    letters = "abZ019_.- \t\n\xa0!@#,éÄßñæÇ"
    values = ["".join(rng.choices(letters, k=rng.randrange(12))) for _ in range(2000)]
    got = apply(spark, fn.normalize_name, values)
    assert got == [plain(v) for v in values]
    assert all(re.fullmatch(r"[a-z0-9_.\- ]*", g) for g in got)
    assert apply(spark, fn.normalize_name, got) == got


def test_white_space_is_that_of_unicode(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert apply(spark, fn.trim_all, [s + "x" + s for s in spaces]) == ["x"] * len(spaces)
    assert apply(spark, fn.collapse, ["a" + s + s + "b" for s in spaces]) == ["a b"] * len(spaces)


def test_to_ascii(spark):
    values = ["Łódź", "Þór", "façade", "é", "日本", "Đỗ", "plain", "ĳs", "x—y…"]
    assert apply(spark, fn.to_ascii, values) == [
        "Lodz", "Thor", "facade", "e", "日本", "Do", "plain", "ijs", "x--y...",
    ]
    assert apply(spark, lambda c: fn.to_ascii(c, {"д": "d", "а": "a", "щ": "shch"}), ["даща"]) == [
        "dashcha"
    ]


def test_normalize_names_drops_what_is_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("!!!",), ("A b",)], "original string")
    assert [r.nick for r in dedupe.normalize_names(df).collect()] == ["a b"]


def test_strict_mode(spark):
    values = ["x" * 33, "x" * 32, "ok_1", "a b", " Été "]
    df = spark.createDataFrame([(v,) for v in values], "original string")
    named = dedupe.normalize_names(df, mode="strict")
    assert sorted(r.nick for r in named.collect()) == ["ete", "ok_1", "x" * 32]
    with pytest.raises(ValueError):
        dedupe.normalize_names(df, mode="other")


def test_parse_emails(spark):
    values = ["A.B@x@y.org", "@x", "x@", "no-at", None, " É b@q.R ", "!@x"]
    df = spark.createDataFrame([(v,) for v in values], "original string")
    rows = {tuple(r) for r in emails.parse_emails(df).collect()}
    assert rows == {("a.b@x@y.org", "a.b", "x@y.org"), ("é b@q.r", "e b", "q.r")}


def test_kinds(spark):
    values = ["user@x.org", "abc", "abcdefg", "abc defg", "user@x", " ", "abcdef\n"]
    assert apply(spark, fn.kinds, values) == [
        ["email"], ["name"], ["name", "token"], ["name"], [], [], ["name"],
    ]


def test_pick_name_column(spark):
    for names, chosen in (
        (["a", "username"], "username"),
        (["name", "nick"], "nick"),
        (["b", "firstname"], "firstname"),
        (["unknown", "other"], "unknown"),
        (["Name", "x"], "Name"),
    ):
        assert fn.pick_name_column(spark.createDataFrame([(1, 2)], names)) == chosen


def test_link_names(spark):
    lines = [
        "- [Names](http://a.b/c) and [more](https://d.e)",
        "[two words](https://x.y)",
        "[local](file.txt)",
        "[Été](https://x.y)",
    ]
    df = spark.createDataFrame([(v,) for v in lines], "original string")
    assert sorted(r.nick for r in dedupe.link_names(df).collect()) == ["ete", "names"]


def test_file_names(spark):
    names = ["a<b.txt", " x. ", "y" * 300 + ".csv", "...", "ok.txt", "z" * 300, "", "q ."]
    repaired = apply(spark, fn.name_repair, names)
    assert repaired == [
        "a_b.txt", "x", "y" * 250 + ".csv", "unnamed_file", "ok.txt", "z" * 255, "unnamed_file", "q ",
    ]
    assert apply(spark, fn.name_valid, names) == [
        False, False, False, False, True, False, True, False,
    ]


def test_path_parts_and_categories(spark):
    paths = ["x/y.TAR.gz", ".bashrc", "a/b.", "f.CSV", "dir/"]
    assert [tuple(p) for p in apply(spark, fn.path_parts, paths)] == [
        ("y.TAR.gz", "y.TAR", ".gz"), (".bashrc", ".bashrc", ""), ("b.", "b.", ""),
        ("f.CSV", "f", ".csv"), ("", "", ""),
    ]
    assert apply(spark, fn.file_category, [".gz", "svg", ".md", ".yml", ".list", ".py", ""]) == [
        "archives", "images", "documents", "structured", "text", "others", "others",
    ]
    assert apply(spark, fn.is_data_file, ["a.TXT", ".a.txt", "a.md"]) == [True, False, False]


def test_binary_content(spark):
    contents = [b"abc\0", b"abc", b"\xff\xfe", b"a" * 1023 + "é".encode(), b"x" * 1020 + b"\xff" * 9]
    df = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(contents)], "i int, c binary")
    rows = df.select("i", fn.is_binary_content("c").alias("b")).orderBy("i").collect()
    assert [r.b for r in rows] == [True, False, True, False, True]


def test_no_python_in_the_default_path(spark):
    df = spark.range(1).select(F.lit("x").alias("original"))
    plan = dedupe.normalize_names(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_letters_of_other_scripts_and_forms(spark):
    values = ["Иван", "Γιώργος", "ａｂｃ", "𝐚𝐛𝑐", "½", "Ⅳ", "ﬁsh", "a b", "a　b", "Щука", "ψυχή",
              "x²", "ǆ", "№", "объект", "Ёж", "日本", "ⓐ"]
    assert apply(spark, fn.normalize_name, values) == [
        "ivan", "giorgos", "abc", "abc", "12", "iv", "fish", "a b", "a b", "shchuka", "psukhe",
        "x2", "dz", "", "obekt", "iozh", "", "a",
    ]
