import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from varzea.functions import fuzzy, hours, scalars


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "function, text, want",
    [
        (scalars.fold_key, "  São   João ", "sao joao"),
        (scalars.normalize_name, "arraial d'ajuda", "Arraial D'Ajuda"),
        (scalars.slug, "Praia do Forte!", "praia-do-forte"),
        (scalars.slug, "!!!", "sem-nome"),
        (scalars.state_to_uf, "State of São Paulo", "SP"),
        (scalars.state_to_uf, "nowhere", None),
        (scalars.mask_phone, "+5571987654321", "+5571*****21"),
        (scalars.whatsapp_candidate, "(71) 98765-4321", "+5571*****21"),
        (scalars.whatsapp_candidate, "+1 202 555 0100", None),
        (scalars.phone_e164, "7133334444", "+557133334444"),
        (scalars.tourism_category, "b", "Turistico"),
        (scalars.scrub, "call +55 71 98765-4321 now", "call [redacted] now"),
        (scalars.redact, "", ""),
        (scalars.instagram_handle, "https://www.instagram.com/casa/?x=1", "@casa"),
        (scalars.instagram_handle, "http://instagram.com/@casa/", "@casa"),
        (scalars.instagram_handle, "https://notinstagram.com/p", None),
        (scalars.instagram_handle, "https://instagram.com/", None),
        (scalars.phone_e164, "+1 415-555-2671", "+14155552671"),
        (scalars.phone_e164, "+351 912 345 678", "+351912345678"),
        (scalars.phone_e164, "5573999990001", "+5573999990001"),
        (scalars.phone_e164, "12345", None),
        (scalars.scrub, "11987654321", "[redacted]"),
        (scalars.scrub, "(73) 9 9999-0001", "([redacted]"),
        (scalars.scrub, "+55 73 9 9999-0001", "[redacted]"),
        (scalars.scrub, "73\t3222\t1111 x", "[redacted] x"),
        (scalars.scrub, "room 12-34", "room 12-34"),
        (scalars.source_of_key, "places:BA:1", "places"),
        (scalars.fold_key, None, None),
    ],
)
def test_text(spark, function, text, want):
    assert one(spark, text, function) == want


def test_distance_of_two_cities(spark):
    km = spark.range(1).select(scalars.haversine_km(F.lit(-23.55), F.lit(-46.63), F.lit(-22.91), F.lit(-43.17))).first()[0]
    assert 355 < km < 365


def test_cosine_of_a_zero_vector(spark):
    assert spark.range(1).select(scalars.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))).first()[0] == 0.0


def test_score_is_weighted_and_routed(spark):
    row = spark.createDataFrame([(65.0, 90.0, 100.0, 100.0, 100.0)], "origin double, completeness double, corroboration double, recency double, human double")
    score, _ = scalars.reliability()
    got = row.select(score.alias("s")).select("s", scalars.route(F.col("s")).alias("r")).first()
    assert (got["s"], got["r"]) == (87.5, "mar")


@pytest.mark.parametrize(
    "line, want", [("9:00 AM – 5:00 PM", {"daily": "09:00-17:00"}), ("Closed", {"daily": "closed"}), ("Open 24 hours", {"daily": "open_24h"}), ("25:00 – 26:00", None)]
)
def test_equal_days(spark, line, want):
    days = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()
    df = spark.createDataFrame([([f"{d}: {line}" for d in days],)], "lines array<string>")
    assert df.select(hours.hours_map(F.col("lines"))).first()[0] == want


def test_a_missing_day_gives_null(spark):
    assert spark.createDataFrame([(["Monday: Closed"],)], "lines array<string>").select(hours.hours_map(F.col("lines"))).first()[0] is None


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@given(st.text("abcd ", max_size=30), st.text("abcd ", max_size=30))
def test_indel_is_the_longest_common_subsequence(a, b):
    want = 100.0 if not a and not b else 0.0 if not a or not b else 200.0 * lcs(a, b) / (len(a) + len(b))
    assert fuzzy.indel(a, b) == pytest.approx(want)


def test_token_ratios():
    assert fuzzy.sort_ratio("casa azul", "azul casa") == 100.0
    assert fuzzy.set_ratio("casa azul", "casa azul grande") == 100.0
    assert fuzzy.partial_set_ratio("museu", "museu do mar") == 100.0
    assert fuzzy.set_ratio(None, "x") == 0.0


@pytest.mark.parametrize(
    "text, mobile, landline",
    [
        ("+55 73 99999-0001", "+5573999990001", None), ("+55 27 3329-0420", None, "+552733290420"), ("73999990001", "+5573999990001", None), ("+1 415 555 0123", None, "+1 415 555 0123"),
        ("+1 491 555 2671", None, "+1 491 555 2671"), ("12345", None, "12345"), ("", None, None), (None, None, None), ("no number", None, None),
    ],
)
def test_split_phone(spark, text, mobile, landline):
    row = spark.createDataFrame([(text,)], "x string").select(scalars.split_phone(F.col("x")).alias("p")).first()["p"]
    assert (row["mobile"], row["landline"]) == (mobile, landline)
