import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from herald.operators.names import clean_last_name

STEPS = ["step1_remove_titles", "step2_remove_parens", "step3_normalized", "clean_last_name"]
# Names and what each stage makes of them.
CASES = [
    ("Harries, MA", "Harries", "Harries", "harries", "harries"),
    ("Smith PhD", "Smith PhD", "Smith PhD", "smith phd", "phd"),
    ("de la Cruz", "de la Cruz", "de la Cruz", "de la cruz", "cruz"),
    ("ZHANG", "ZHANG", "ZHANG", "zhang", "zhang"),
    ("Lee, CPA", "Lee", "Lee", "lee", "lee"),
    ("Van der Linde", "Van der Linde", "Van der Linde", "van der linde", "linde"),
    (" wang ", " wang ", " wang ", "wang", "wang"),
    ("Chen (CPA)", "Chen (CPA)", "Chen ", "chen", "chen"),
    ("Lee (a) Van (b) Linde", "Lee (a) Van (b) Linde", "Lee  Linde", "lee  linde", "linde"),
    ("Ng (x\ny) Li", "Ng (x\ny) Li", "Ng  Li", "ng  li", "li"),
    ("", "", "", "", ""),
    (",MA", "", "", "", ""),
    ("\tTab", "\tTab", "\tTab", "\ttab", "\ttab"),
    (None, None, None, None, None),
]


def names_frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                                 "id INT, last_name STRING")


def test_printed_stages(spark):
    df = clean_last_name(names_frame(spark, [c[0] for c in CASES]), keep_steps=True)
    got = [tuple(r) for r in df.orderBy("id").select("last_name", *STEPS).collect()]
    assert got == CASES


def test_result_is_stable(spark):
    once = clean_last_name(names_frame(spark, [c[0] for c in CASES]))
    twice = clean_last_name(once.select("id", once.clean_last_name.alias("last_name")))
    assert (sorted(once.select("id", "clean_last_name").collect())
            == sorted(twice.select("id", "clean_last_name").collect()))


def test_titles_can_be_stripped(spark):
    df = clean_last_name(names_frame(spark, ["Smith PhD", "Lee Phd MD", "phd", "Mc.PhD"]),
                         strip_titles=["PhD", "MD"])
    assert [r.clean_last_name for r in df.orderBy("id").collect()] == ["smith", "lee", "phd", "mc.phd"]


def by_hand(name):
    cut = re.sub(r"(?s)\(.*\)", "", name.split(",")[0]).lower().strip(" ")
    return cut.split(" ")[-1]


@settings(max_examples=5, deadline=None, database=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aB ,()\n-'é", max_size=20), min_size=30, max_size=60))
def test_random_names(spark, values):
    df = clean_last_name(names_frame(spark, values)).orderBy("id")
    assert [r.clean_last_name for r in df.collect()] == [by_hand(v) for v in values]


def test_plan_is_one_projection(spark):
    from plans import physical
    text = physical(clean_last_name(names_frame(spark, ["a"])))
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("keep", [True, False])
def test_columns(spark, keep):
    df = clean_last_name(names_frame(spark, ["a"]), keep_steps=keep)
    assert df.columns == ["id", "last_name", *(STEPS if keep else STEPS[-1:])]
