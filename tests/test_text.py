"""Cleaning rules on hand-made texts, and against the same rules in Python."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from checks.views import LOOKUP
from tidepost.functions import text as t
from tidepost.operators import lookup as lookup_module
from tidepost.operators.lookup import normalize_tokens_join


def scanned(text, lookup):
    """Cleaning by a scan over the characters and their Unicode categories."""
    text = text or ""

    def is_word(i):
        return text[i] == "_" or unicodedata.category(text[i])[0] in "LN"

    def address(i):
        """End of a web address that begins here, else None."""
        for head in ("http://", "https://"):
            end = i + len(head)
            if text.startswith(head, i) and end < len(text) and not text[end].isspace():
                while end < len(text) and not text[end].isspace():
                    end += 1
                return end
        return None

    def word_end(i):
        while i < len(text) and is_word(i) and address(i) is None:
            i += 1
        return i

    out, i = [], 0
    while i < len(text):
        if address(i) is not None:
            out.append(" url ")
            i = address(i)
        elif text[i] == "@" and word_end(i + 1) > i + 1:
            out.append(" user ")
            i = word_end(i + 1)
        else:
            if not (text[i] == "#" and word_end(i + 1) > i + 1):
                out.append(text[i] if is_word(i) or text[i] in ".,?!" else " ")
            i += 1
    words = "".join(out).lower().split()
    return " ".join(lookup.get(w, w) for w in words).strip()


CASES = {
    "": "",
    None: "",
    "   \t\r\n ": "",
    "Look https://x.com/a?b=1, now": "look url now",
    "(http://a.b)end HTTP://UP": "url http up",
    "hi @user_1! @é": "hi user ! user",
    "#tag ##tag # a#b": "tag tag ab",
    "a b c\u0085d\x1ce": "a b c d e",
    "Ünïcode ñ ß": "ünïcode ñ ß",
    "ok 👍🏽 é": "ok e",
    "wow... really?! 50%": "wow... really?! 50",
    "the and": "this",
    "this the, THE": "that the, this",
    "a and b": "a  b",
    "and x and": "x",
}


def test_clean_text_cases(column):
    got = column(list(CASES), t.clean_text("x", LOOKUP))
    assert got == list(CASES.values())


def test_clean_text_without_dictionary(column):
    assert column(["The AND"], t.clean_text("x")) == ["the and"]
    assert column(["The AND"], t.clean_text("x", {})) == ["the and"]


def random_texts(n):
    rng = random.Random(7)
    pieces = ["the", "and", "of", "@bob", "#tag", "##x", "http://a.b/c#d", "https://", "é", "ñandú"]
    pieces += list(" \t\n\r  　.,?!_-/#@:()'\"") + ["👍", "é", "中文", "١٢", "½", "ª"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_clean_text_equals_python_on_random_texts(column):
    texts = random_texts(3000)
    assert column(texts, t.clean_text("x", LOOKUP)) == [scanned(x, LOOKUP) for x in texts]


@pytest.mark.parametrize("table, name", [("documents", "text"), ("pages", "html")])
def test_clean_text_equals_python_on_tables(spark, table, name):
    rows = spark.read.parquet(f"/root/testdata/sf0.01/{table}.parquet")
    got = rows.select(name, t.clean_text(name, LOOKUP).alias("clean")).collect()
    assert got and all(r["clean"] == scanned(r[name], LOOKUP) for r in got)


def test_fused_pattern_equals_single_steps(column):
    texts = random_texts(1000)
    steps = t.unwrap_hashtags(t.replace_mentions(t.replace_urls("x")))
    steps = F.lower(t.squeeze(t.replace_symbols(steps)))
    assert column(texts, steps) == column(texts, t.clean_text("x"))


def test_dictionary_of_many_entries_and_join_form(spark, column, monkeypatch):
    lookup = {f"w{i}": f"v{i}" if i % 7 else "" for i in range(500)}
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(700)}" for _ in range(20)) for _ in range(200)] + ["", "w0"]
    wanted = [" ".join(lookup.get(x, x) for x in s.split(" ")).strip() for s in texts]
    assert column(texts, t.normalize_tokens("x", lookup)) == wanted
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    table = spark.createDataFrame(list(lookup.items()), "token string, form string")
    for limit in (lookup_module.BROADCAST_BYTES, 0):
        monkeypatch.setattr(lookup_module, "BROADCAST_BYTES", limit)
        joined = normalize_tokens_join(df, "x", table).orderBy("i").collect()
        assert [r["x"] for r in joined] == wanted


def test_light_and_duplicate_forms(column):
    texts = ["See https://a.b #Tag @me  NOW!", " #only @mentions http://x ", None]
    assert column(texts, t.clean_light("x")) == [
        "See URL Tag USER NOW!",
        "only USER URL",
        None,
    ]
    assert column(texts, t.normalize_for_dup("x")) == ["see now!", None, None]


def test_tokens_and_counts(column):
    assert column(["Hello, the world's #tag été that", None], t.tokenize("x", ["that"])) == [
        ["hello", "world"],
        [],
    ]
    assert column(["", "a  b c", "a"], t.token_count("x")) == [1, 3, 1]
    words = column([None, "", "  ", "a b\n c ", "one"], t.word_count("x"))
    assert words == [0, 0, 0, 3, 1]
    assert column([None, "añ👍"], t.text_length("x")) == [0, 3]


def test_keywords(column):
    texts = ["A Theme", "the end", "été", "to the", None, "pre_the"]
    assert column(texts, t.contains_any("x", ["the"])) == [True, True, False, True, None, True]
    assert column(texts, t.contains_word("x", ["the"])) == [False, True, False, True, None, False]
    assert column(["éthe", "a.b", "axb"], t.contains_word("x", ["the", "a.b"])) == [
        False,
        True,
        False,
    ]
    assert column(texts, t.contains_any("x", [])) == [False] * 6
    assert column([None, "STOP it", "stopped"], t.mentions("x", ["stop i", "halt"])) == [
        False,
        True,
        False,
    ]
