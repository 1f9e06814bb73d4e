"""Times in many forms."""

import pytest
from pyspark.sql import functions as F

from tidepost.functions.times import ZONES, is_lost, parse_time
from tidepost.plans.export import export_losses

AT = "2023-11-24 17:49:36"
FORMS = {
    "2023-11-24 17:49:36": AT,
    "2023-11-24T17:49:36Z": AT,
    "2023-11-24T17:49:36.250+07:00": "2023-11-24 10:49:36.25",
    " 2023-11-24 ": "2023-11-24 00:00:00",
    "2023/11/24 17:49:36": AT,
    "2023.11.24 17:49": "2023-11-24 17:49:00",
    "2023-1-2 3:04": "2023-01-02 03:04:00",
    "20231124": "2023-11-24 00:00:00",
    "20231124T174936Z": AT,
    "20231124174936": AT,
    "202311241749": "2023-11-24 17:49:00",
    "Fri Nov 24 17:49:36 +0000 2023": AT,
    "Fri Nov 24 17:49:36 -0330 2023": "2023-11-24 21:19:36",
    "Fri, 24 Nov 2023 17:49:36 GMT": AT,
    "Fri, 24 Nov 2023 17:49:36 +0530 (IST)": "2023-11-24 12:19:36",
    "24 Nov 2023 17:49:36 EST": "2023-11-24 22:49:36",
    "24 nov. 2023": "2023-11-24 00:00:00",
    "24th November, 2023": "2023-11-24 00:00:00",
    "24-Nov-2023": "2023-11-24 00:00:00",
    "Friday 24 November 2023 10:00:00": "2023-11-24 10:00:00",
    "Nov 24, 2023": "2023-11-24 00:00:00",
    "November 24, 2023 at 5:49:36 pm WIB": "2023-11-24 10:49:36",
    "Sept. 3rd, 2023 12:05 a.m.": "2023-09-03 00:05:00",
    "Thurs, Nov 23, 2023 12:05 PM": "2023-11-23 12:05:00",
    "11/24/2023": "2023-11-24 00:00:00",
    "24/11/2023 17:49": "2023-11-24 17:49:00",
    "11/10/2023 01:02:03 AM": "2023-11-10 01:02:03",
    "2024-02-29 00:00:00 utc+1": "2024-02-28 23:00:00",
    "2023-11-24 17:49:36,5": "2023-11-24 17:49:36.5",
}
BAD = ["", "  ", "yesterday", "2023-13-01", "31 Feb 2023", "25/13/2023", "2023-11-24 25:00", "13:00 pm",
       "Nov 24", "24 Nov 23", "Friday", "Nov 24, 2023 13:00 pm", "2023-11/24", "24 Nov 2023 10:00 XYZ",
       "2023-11-24 10:00 +99:00", "2023112", "Fri Nov 24 2023 x"]


@pytest.mark.parametrize("wrapped", [False, True])
def test_forms(column, wrapped):
    texts = list(FORMS)
    parsed = parse_time("x").cast("string")
    got = column(texts, F.coalesce(parsed, F.lit("-")) if wrapped else parsed)
    wrong = [(t, g, FORMS[t]) for t, g in zip(texts, got, strict=True) if g != FORMS[t]]
    assert not wrong


def test_bad_text_is_null_and_counted(column):
    assert column([*BAD, None], parse_time("x").cast("string")) == [None] * (len(BAD) + 1)
    lost = column([*BAD, None, AT], is_lost("x", parse_time("x")))
    assert lost == [bool(t.strip()) for t in BAD] + [False, False]


def test_case_does_not_matter(column):
    texts = [t.upper() for t in FORMS if "T" not in t.replace("th", "")] + [t.lower() for t in FORMS]
    wanted = [FORMS[t] for t in FORMS if "T" not in t.replace("th", "")] + list(FORMS.values())
    assert column(texts, parse_time("x").cast("string")) == wanted


def test_zones_of_every_name(column):
    names = [z for z in ZONES if z != "z"]
    got = column([f"24 Nov 2023 12:00 {z.upper()}" for z in names], F.unix_seconds(parse_time("x")))
    noon = 1700827200
    assert got == [noon - ZONES[z] * 60 for z in names]


def test_own_forms_come_first(column):
    assert column(["03/04/2023"], parse_time("x", ["dd/MM/yyyy"]).cast("string")) == ["2023-04-03 00:00:00"]
    assert column(["03/04/2023"], parse_time("x").cast("string")) == ["2023-03-04 00:00:00"]


def test_text_is_taken_apart_once(spark):
    df = spark.createDataFrame([("x",)], "x string").select(parse_time("x").alias("t"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("year0") <= 2  # the group in the pattern and in what replaces it


def test_losses_by_column(frame):
    rows = [("1", "x", "24 Nov 2023"), ("n", "true", "soon"), (None, " ", ""), ("2.7", "0", None)]
    df = frame(rows, "like_count string, is_reply string, created_at string")
    got = {r["column"]: (r["filled"], r["lost"]) for r in export_losses(df).collect()}
    assert got == {"like_count": (3, 1), "is_reply": (3, 1), "created_at": (2, 1)}
