"""Edge cases of the column functions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ebbtide.functions import bands, dates, decode, numbers, text


def test_clip_keeps_null(column):
    assert column([-3, 0, 5, None], "int", numbers.floor_at_zero) == [0, 0, 5, None]


def test_to_number(column):
    given = ["12", " 3.5 ", "1e2", ".5", "x", "", "12d", "NaN", None]
    assert column(given, "string", numbers.to_number) == [12.0, 3.5, 100.0, 0.5, None, None, None, None, None]


def test_comma_number(column):
    assert column(["12,5", "1.234,56", None], "string", numbers.comma_number) == [12.5, None, None]


def test_age_band(column):
    got = column([9, 10, 69, 70, -1, None], "int", bands.AGE.label)
    assert got == ["0 a 9", "10 a 19", "60 a 69", "70+", None, None]


def test_tenure_band(column):
    got = column([0.0, 6.0, 7.0, 12.0, 13.0, 24.0, 25.0, -1.0], "double", bands.TENURE.ord)
    assert got == [1, 1, 2, 2, 3, 3, 4, None]


def test_tenure_class(column):
    got = column([None, -2, 6, 7, 240, 241], "int", bands.tenure_class)
    assert [g[0] for g in got] == ["7", "1", "1", "2", "6", "7"]


def test_age_class(column):
    got = column([None, -1, 0, 69, 70], "int", bands.age_class)
    assert [g[:2] for g in got] == ["08", "08", "01", "07", "08"]


def test_day_part_is_right_closed(column):
    got = column([0, 6, 7, 12, 18, 23, None], "int", bands.DAY_PART.label)
    assert got == ["madrugada", "madrugada", "manhã", "manhã", "tarde", "noite", None]


def test_score_band_and_colour_differ(column):
    scores = [24.9, 25.0, 75.5, 100.0, 76.0]
    assert column(scores, "double", bands.SCORE.ord) == [1, 2, 4, 4, 4]
    assert column(scores, "double", bands.score_colour) == ["#D85A30", "#D85A30", "#378ADD", "#1D9E75", "#1D9E75"]


def test_boundary_counts(column):
    to = F.lit(date(2024, 2, 1))
    assert column([date(2024, 1, 31), date(2024, 2, 1)], "date", lambda c: dates.months_crossed(c, to)) == [1, 0]
    to = F.lit(date(2024, 1, 1))
    assert column([date(2023, 12, 31)], "date", lambda c: dates.years_crossed(c, to)) == [1]


def test_end_date(column):
    as_of = date(2024, 5, 5)
    got = column(["        ", "19000101", "20240203"], "string", lambda c: dates.or_today(dates.lenient_date(c), as_of))
    assert got == [as_of, as_of, date(2024, 2, 3)]


def test_lenient_date(column):
    assert column(["20251301", "", "20240229", "20230229"], "string", dates.lenient_date) == [
        None,
        None,
        date(2024, 2, 29),
        None,
    ]


def test_strict_date_fails_on_bad_text(column):
    with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed"):
        column(["20251301"], "string", dates.strict_date)


def test_month_start(column):
    given = ["jan/2024", "set/2024", "2024-02-15", "2024-02-15 10:00:00", "02/2024", "15/02/2024", "02/15/2024"]
    bad = ["??", None, "xyz/2024", "JAN/x", "13/2024"]
    jan, sep, feb = date(2024, 1, 1), date(2024, 9, 1), date(2024, 2, 1)
    assert column(given + bad, "string", dates.month_start) == [jan, sep] + [feb] * 5 + [None] * 5


def test_cycle():
    assert dates.cycle_start(date(2024, 3, 25)) == date(2024, 2, 26)
    assert dates.cycle_start(date(2024, 3, 26)) == date(2024, 3, 26)
    assert dates.cycle_start(date(2024, 1, 5)) == date(2023, 12, 26)


def test_cycle_month(column):
    given = [date(2024, 1, 26), date(2024, 2, 25), date(2024, 2, 26), date(2023, 12, 26)]
    assert column(given, "date", dates.cycle_month) == [
        date(2024, 2, 1),
        date(2024, 2, 1),
        date(2024, 3, 1),
        date(2024, 1, 1),
    ]


def test_cycles_and_semesters():
    cycles = dates.monthly_cycles(date(2025, 1, 1), 15)
    assert (cycles[0].start, cycles[0].end, cycles[0].label) == (date(2024, 12, 26), date(2025, 1, 25), "Jan-2025")
    assert cycles[-1].label == "Mar-2026" and cycles[-1].end == date(2026, 3, 25)
    halves = dates.semesters(cycles)
    assert [p.label for p in halves] == ["S1-2025", "S2-2025", "S1-2026"]
    assert (halves[1].start, halves[1].end) == (date(2025, 6, 26), date(2025, 12, 25))


def test_bounds():
    assert dates.parse_bound("05/03/2024") == dates.parse_bound("20240305") == date(2024, 3, 5)
    with pytest.raises(ValueError):
        dates.parse_bound("2024035")


def test_seller_code(column):
    assert column(["12", "12.0", "x", "1234567", None], "string", text.seller_code) == [
        "000012",
        "000012",
        None,
        "1234567",
        None,
    ]


def test_strip_and_title(column):
    assert column(["\t a \n", None], "string", text.strip) == ["a", None]
    given = ["  porto de AREIA ", "d'ávila x-y", "são paulo"]
    assert column(given, "string", text.title_case) == [s.strip().title() for s in given]


def test_percent_rounds_half_to_even(column):
    got = column([1, 3, 5, 0], "int", lambda c: numbers.percent(c, F.lit(800)))
    assert got == [round(100 * n / 800, 1) for n in (1, 3, 5, 0)] == [0.1, 0.4, 0.6, 0.0]
    assert column([1], "int", lambda c: numbers.percent(c, F.lit(0))) == [None]


def test_money_texts(column):
    given = [1234567.5, 0.125, 2.675, None]
    assert column(given, "double", text.money_text) == ["R$ 1.234.567,50", "R$ 0,12", "R$ 2,68", None]
    assert column(given[:2], "double", text.plain_money_text) == ["R$ 1234567.50", "R$ 0.12"]


def test_whole_and_count_texts(column):
    assert column([42.5, 43.5, None], "double", lambda c: text.whole_text(c, " anos")) == ["42 anos", "44 anos", None]
    assert column([7.9, None], "double", text.count_text) == ["7", "—"]
    assert column([1234567], "bigint", text.thousands) == ["1.234.567"]


def test_progress_bar(column):
    got = column([0.0, 69.0, 70.0, 100.0, 120.0], "double", text.progress_bar)
    assert got == ["⬜" * 10 + " 0%", "🟨" * 6 + "⬜" * 4 + " 69%", "🟩" * 7 + "⬜" * 3 + " 70%", "🟦" * 10 + " 100%", "🟦" * 12 + " 120%"]


def test_progress_phrase(column):
    got = column([None, 10.0, 10.0, 0.0], "double", lambda g: text.progress_phrase(g, F.lit(12.0)))
    assert got == ["sem meta definida", "✅ Meta batida! Superou em 2 vida(s)"] + [
        "✅ Meta batida! Superou em 2 vida(s)",
        "✅ Meta batida! Superou em 12 vida(s)",
    ]
    assert column([20.0], "double", lambda g: text.progress_phrase(g, F.lit(12.0))) == [
        "faltam 8 vidas para alcançar a meta"
    ]


def test_attainment_and_score_texts(column):
    assert column([66.7, None], "double", text.attainment_text) == ["66.7%", "—"]
    assert column([75.5, None], "double", text.score_text) == ["75.5 pts", "—"]


def test_bar_width(column):
    assert column([120.0, 0.0, 33.3], "double", lambda c: text.bar_width(c, F.lit(False))) == [100.0, None, 33.3]
    assert column([50.0], "double", lambda c: text.bar_width(c, F.lit(True))) == [None]


def test_plan_decoding(spark):
    df = spark.createDataFrame([(1, "0001"), (3, "0008 "), (3, "0009"), (0, "x"), (None, "x")], "m int, c string")
    got = [r[0] for r in df.select(decode.plan_modality(F.col("m"), F.col("c"))).collect()]
    assert got == ["Modality 1", "Modality 3 special", "Modality 3", "Outros", "Outros"]


def test_class_keeps_raw_value(column):
    assert column([" 1 ", "VER", "Q ", None], "string", decode.plan_class) == ["1 - Classe 1", "VIP", "Q ", None]


def test_billed_customer(spark):
    rows = [("1", "a", "1", "b"), ("2", "a", "1 ", "b"), (None, "a", None, "b")]
    df = spark.createDataFrame(rows, "l1 string, c1 string, l2 string, c2 string")
    picked = decode.billed_customer((F.col("l1"), F.col("c1")), (F.col("l2"), F.col("c2")))
    assert [r[0] for r in df.select(picked).collect()] == ["a", "b", None]


def test_team_type(column):
    given = ["Pré-Vendas 2", "Suporte", "Televendas", "Vendas Diretas", "x", None]
    assert column(given, "string", decode.team_type) == ["sdr", "sdr", "televendas", "vendas_diretas", "outras", "outras"]
