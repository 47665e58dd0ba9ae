"""Hand-written tables, edge frames and properties of the operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plumbline.checks import chain_queries
from plumbline.columns import col
from plumbline.functions import calendar as cal
from plumbline.functions import categories as cat
from plumbline.functions import convert, predicates, text
from plumbline.operators import clean, impute, ordered, profile, rules, series, stats
from plumbline.operators.ordered import Layout
from plumbline.operators.rules import Constraint
from plumbline.plans import accidents, air, energy, weather

CUT = Layout(True, 7)
D = dt.date


def days(*numbers):
    return [D(2024, 1, n) for n in numbers]


# Imputation of series


def gapped(spark):
    values = [None, None, 2.0, None, None, 8.0, None]
    rows = [("a", i, v) for i, v in enumerate(values)] + [("b", i, None) for i in range(2)] + [(None, 0, 1.0), (None, 1, None)]
    return spark.createDataFrame(rows, "s string, t int, v double")


@pytest.mark.parametrize("layout", [ordered.WHOLE, CUT, None])
def test_gap_is_filled_by_the_midpoint_however_long(spark, rows, layout):
    filled = impute.interpolate(gapped(spark), ["t"], ["v"], ["s"], layout=layout)
    expected = [("a", i, v) for i, v in enumerate([2.0, 2.0, 2.0, 5.0, 5.0, 8.0, 8.0])]
    assert rows(filled) == sorted(expected + [("b", 0, None), ("b", 1, None), (None, 0, 1.0), (None, 1, 1.0)], key=repr)


@pytest.mark.parametrize("layout", [ordered.WHOLE, CUT])
def test_series_end_takes_the_last_value_as_next(spark, rows, layout):
    frame = spark.createDataFrame([(0, 1.0), (1, None), (2, 3.0), (3, 9.0), (4, None)], "t int, v double")
    filled = impute.interpolate(frame, ["t"], fallback=0, next_anchor="series_end", layout=layout)
    assert rows(filled) == [(0, 1.0), (1, 5.0), (2, 3.0), (3, 9.0), (4, 9.0)]
    nearest = impute.interpolate(frame, ["t"], fallback=0, layout=layout)
    assert rows(nearest) == [(0, 1.0), (1, 2.0), (2, 3.0), (3, 9.0), (4, 9.0)]


def test_empty_series_takes_the_fallback(spark, rows):
    frame = spark.createDataFrame([(0, None), (1, None)], "t int, v int")
    assert rows(impute.interpolate(frame, ["t"], fallback=0)) == [(0, 0.0), (1, 0.0)]


def random_series(spark, seed, n=400):
    rng = random.Random(seed)
    data = [
        (rng.choice("aaaaaab"), i, rng.choice([None, round(rng.uniform(-5, 5), 2)]), rng.choice([None, None, rng.randint(0, 9)]))
        for i in range(n)
    ]
    rng.shuffle(data)
    return spark.createDataFrame(data, "s string, t int, v double, k int")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_forms_equal_plain_forms(spark, rows, seed):
    frame = random_series(spark, seed)
    whole = impute.interpolate(frame, ["t"], ["v", "k"], ["s"], layout=ordered.WHOLE)
    assert rows(whole) == rows(impute.interpolate(frame, ["t"], ["v", "k"], ["s"], layout=CUT))
    dense = frame.withColumn("v", F.coalesce("v", F.lit(0.0)))
    plain = series.detect_outliers(dense, ["v"], ["t"], ["s"], window=9, factor=0.5, layout=ordered.WHOLE)
    cut = series.detect_outliers(dense, ["v"], ["t"], ["s"], window=9, factor=0.5, layout=CUT, block_rows=11)
    assert rows(plain) == rows(cut)
    assert 0 < plain.filter("is_outlier_v").count() < 200
    numbered = ordered.number_rows(frame, ["t"], ["s"], layout=ordered.WHOLE)
    assert rows(numbered) == rows(ordered.number_rows(frame, ["t"], ["s"], layout=CUT))
    late = ordered.order_violations(frame.withColumn("h", F.floor(F.col("t") / 3)), "h", ["s"], ["t"], layout=ordered.WHOLE)
    cut = ordered.order_violations(frame.withColumn("h", F.floor(F.col("t") / 3)), "h", ["s"], ["t"], layout=CUT)
    assert rows(late) == rows(cut)


@pytest.mark.parametrize("seed", [4, 5])
def test_filling_leaves_values_and_rows_alone(spark, rows, seed):
    frame = random_series(spark, seed)
    filled = impute.interpolate(frame, ["t"], ["v"], ["s"])
    known = frame.filter("v is not null").select("s", "t", "v")
    assert filled.count() == frame.count()
    assert rows(known) == rows(filled.join(known.select("s", "t"), ["s", "t"], "left_semi").select("s", "t", "v"))
    assert rows(filled) == rows(impute.interpolate(frame.repartition(13), ["t"], ["v"], ["s"]))


# Other imputation


def test_mode_counts_null_as_a_level_and_breaks_ties_by_value(spark, rows):
    frame = spark.createDataFrame(
        [("x", None, "b", None), ("y", None, "a", None), (None, "q", "b", None), ("x", None, "a", None)],
        "a string, b string, c string, d string",
    )
    filled = rows(impute.impute_mode(frame))
    assert filled == sorted([("x", "unknown", "b", "unknown"), ("y", "unknown", "a", "unknown"), ("x", "q", "b", "unknown"),
                             ("x", "unknown", "a", "unknown")], key=repr)
    tie = spark.createDataFrame([("b",), ("a",), (None,)], "a string")
    assert rows(impute.impute_mode(tie)) == [("a",), ("a",), ("b",)]


def test_mode_and_median_by_group(spark, rows):
    frame = spark.createDataFrame(
        [("g", "x", 1), ("g", "x", 5), ("g", None, None), ("h", "y", 7), ("h", None, None), ("h", "y", 9), (None, None, 2)],
        "g string, c string, n int",
    )
    done = impute.impute_numeric(impute.impute_mode(frame, by=["g"]), by=["g"])
    assert rows(done) == sorted([("g", "x", 1.0), ("g", "x", 5.0), ("g", "x", 1.0), ("h", "y", 7.0), ("h", "y", 7.0),
                                 ("h", "y", 9.0), (None, "unknown", 2.0)], key=repr)


def test_empty_numeric_column_takes_the_default_and_ints_become_doubles(spark, rows):
    frame = spark.createDataFrame([(None, 1), (None, None)], "a double, n int")
    assert rows(impute.impute_numeric(frame, default=-1.0)) == [(-1.0, 1.0), (-1.0, 1.0)]
    assert rows(impute.impute_numeric(frame, strategy="mean")) == [(0.0, 1.0), (0.0, 1.0)]
    assert dict(impute.impute_numeric(frame).dtypes)["n"] == "double"
    with pytest.raises(ValueError):
        impute.impute_numeric(frame, strategy="max")


def test_group_without_a_value_stays_null(spark, rows):
    frame = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0), ("b", None)], "g string, v double")
    assert rows(impute.impute_group_mean(frame, ["v"], ["g"])) == [("a", 1.0), ("a", 1.5), ("a", 2.0), ("b", None)]


# Rules


def test_flags_and_ratios_in_three_valued_logic(spark, rows):
    frame = spark.createDataFrame([(1, 5), (2, None), (-1, 5), (3, -2)], "a int, b int")
    checks = [Constraint("a_pos", col("a") >= 0, ("a",)), Constraint("b_pos", col("b") >= 0, ("b",))]
    flagged = rules.add_flags(frame, checks).select("a", "check_a_pos", "check_b_pos", "all_valid")
    assert rows(flagged) == sorted([(1, True, True, True), (2, True, None, None), (-1, False, True, False), (3, True, False, False)], key=repr)
    assert rules.consistency(frame, checks).first().asDict() == {"rows": 4, "valid_rows": 1, "consistency": 0.25}
    report = {r["constraint"]: (r.satisfied, r.unknown, r.ratio) for r in rules.constraint_report(frame, checks).collect()}
    assert report == {"a_pos": (3, 0, 0.75), "b_pos": (2, 1, 0.5)}
    assert rows(rules.enforce_filter(frame, checks)) == [(1, 5)]
    repaired = rules.enforce_null(frame, checks)
    assert rows(repaired) == sorted([(1, 5), (2, None), (None, 5), (3, None)], key=repr)
    assert rules.add_flags(repaired, checks).filter("check_a_pos = false or check_b_pos = false").count() == 0


def test_later_rules_see_earlier_repairs(spark, rows):
    frame = spark.createDataFrame([(9, 1)], "a int, b int")
    chain = [Constraint("a_small", col("a") < 5, ("a",)), Constraint("b_with_a", col("a").isNotNull(), ("b",))]
    assert rows(rules.enforce_null(frame, chain)) == [(None, None)]


def test_membership_with_null_in_the_list_is_never_false(spark, rows):
    frame = spark.createDataFrame([("M",), ("Q",), (None,)], "sex string")
    flags = frame.select("sex", predicates.one_of_or_unknown("sex", ["M"]), predicates.one_of_or_missing("sex", ["M"]))
    assert rows(flags) == sorted([("M", True, True), ("Q", None, False), (None, None, True)], key=repr)


def test_sum_is_recomputed_only_with_all_columns(spark, rows):
    frame = spark.createDataFrame([(9.0, 1.0, 2.0), (9.0, None, 2.0)], "nox double, no double, no2 double")
    assert rows(rules.recompute_sum(frame, "nox", ["no", "no2"]), "nox") == [(3.0,), (None,)]
    assert rows(rules.recompute_sum(frame.drop("no2"), "nox", ["no", "no2"]), "nox") == [(9.0,), (9.0,)]


def test_text_codes_that_are_no_numbers_give_null(spark, rows):
    frame = spark.createDataFrame([("101",), ("x",), ("22",), (None,)], "code string")
    assert rows(frame.select(predicates.integer_between("code", 100, 999))) == sorted([(True,), (None,), (False,), (None,)], key=repr)


def test_plan_rules_cover_the_stated_limits(spark):
    assert [c.name for c in accidents.rules()][:2] == ["valid_report_date", "valid_time_format"] and len(accidents.rules()) == 11
    assert len(energy.rules()) == 5 and len(weather.rules()) == 4
    frame = spark.createDataFrame([], "datetime_iso timestamp, station string, pm25 double, pm10 double")
    assert {c.name for c in air.rules(frame)} == {"pos_params", "PM_cons", "pm25_realistic", "pm10_realistic", "non_null_row"}


# Text, time and categories


def test_null_tokens_touch_text_only(spark, rows):
    frame = spark.createDataFrame([("NA", 1.0), ("na", 2.0), ("", 3.0), (None, 4.0)], "s string, v double")
    expected = [(None, 1.0), ("na", 2.0), (None, 3.0), (None, 4.0)]
    assert rows(text.nullify_tokens(frame, text.OBSERVATION_NULLS)) == sorted(expected, key=repr)
    spaced = spark.createDataFrame([("  A  b\t c ",)], "s string")
    assert text.normalize_text(spaced, lower=True).first()[0] == "a_b_c"
    padded = spark.createDataFrame([("\t x y  ",)], "s string")
    assert text.strip_all(padded).first()[0] == "x y"
    assert text.snake_case("sensorsId") == "sensors_id" and text.snake_case("Lat") == "lat"


def test_malformed_dates_and_numbers_are_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    row = spark.range(1).select(
        convert.parse_date(F.lit("20241301"), convert.COMPACT_DATE),
        convert.parse_date(F.lit("2024-02-30")),
        convert.parse_offset_timestamp(F.lit("yesterday")),
        convert.at_clock(F.lit("2024-01-01").cast("date"), F.lit("25:00")),
        F.lit("1.5x").try_cast("double"),
    ).first()
    assert list(row) == [None] * 5
    good = spark.range(1).select(convert.parse_offset_timestamp(F.lit("2025-04-04T09:00:00-08:00")).cast("string")).first()[0]
    assert good == "2025-04-04 17:00:00"


def test_week_closes_on_monday(spark):
    stamps = ["2024-01-01 23:59:00", "2024-01-02 00:00:00", "2024-01-08 00:00:00"]
    weeks = [spark.range(1).select(cal.week_ending_monday(F.lit(s).cast("timestamp"))).first()[0] for s in stamps]
    assert weeks == days(1, 8, 8)


@pytest.mark.parametrize("age,label", [(-1, None), (0, "Minor"), (16, "Minor"), (17, "Young Adult"), (25, "Adult"), (60, "Senior"), (None, None)])
def test_age_bins_are_left_closed(spark, age, label):
    frame = spark.createDataFrame([(age,)], "age int")
    assert frame.select(cal.bin_numeric(col("age"), cal.AGE_EDGES, cal.AGE_LABELS)).first()[0] == label


@pytest.mark.parametrize("hour,part", [(0, "Night"), (5, "Night"), (6, "Morning"), (12, "Afternoon"), (17, "Evening"), (20, "Late Evening"), (23, "Late Evening")])
def test_parts_of_the_day(spark, hour, part):
    assert spark.range(1).select(cal.part_of_day(F.lit(hour))).first()[0] == part


def test_first_code_of_a_group_wins(spark, rows):
    frame = spark.createDataFrame([(["0400", "3026", "3024"],), ([],), (None,), (["9999"],)], "codes array<string>")
    label = cat.first_group_label(col("codes"), cat.MO_CODE_GROUPS["Injury_Level"])
    assert rows(frame.select(label)) == [("Complaint of Injury",), ("unknown",), ("unknown",), ("unknown",)]
    assert sum(len(g) for g in cat.MO_CODE_GROUPS.values()) == 103 and len(cat.MO_CODE_GROUPS) == 16


# Metrics and cleaning


def odd_names(spark):
    data = [(1, "x", 1.0), (1, None, float("nan")), (2, "x", None)]
    return spark.createDataFrame(data, "`a-b` int, `c d` string, `e.f` double")


def test_profile_of_odd_column_names(spark):
    report = {r.column: r for r in profile.profile(odd_names(spark)).collect()}
    assert (report["a-b"].distinct_values, report["c d"].distinct_values, report["e.f"].distinct_values) == (2, 2, 3)
    assert report["a-b"].max == 2.0 and report["c d"].mean is None and report["e.f"].non_null == 2
    approx = {r.column: r.distinct_values for r in profile.profile(odd_names(spark), distinct="approx").collect()}
    assert approx == {"a-b": 2, "c d": 2, "e.f": 3}
    none = profile.profile(odd_names(spark), distinct="none").collect()
    assert {r.distinct_values for r in none} == {None}


def test_nan_is_a_value_and_not_a_null(spark):
    missing = {r.column: r.missing_ratio for r in profile.column_completeness(odd_names(spark)).collect()}
    assert missing == pytest.approx({"a-b": 0.0, "c d": 1 / 3, "e.f": 1 / 3})
    assert profile.relation_completeness(odd_names(spark)).first()[0] == pytest.approx(1 / 3)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "t date, v double, s string")
    assert profile.column_completeness(empty).count() == 0
    assert profile.relation_completeness(empty).first()[0] == 0.0
    assert profile.redundancy(empty, ["t"]).first().asDict() == {"rows": 0, "keys": 0, "redundancy": None}
    assert profile.missing_dates(empty, "t").count() == 0
    assert profile.constant_columns(empty).count() == 0
    assert impute.impute_numeric(impute.impute_mode(empty)).count() == 0
    assert impute.interpolate(empty, ["t"]).count() == 0
    assert stats.histogram(empty, "v", 3).count() == 0
    assert rules.consistency(empty, [Constraint("x", col("v") > 0)]).first().consistency is None


def test_constant_columns_count_null_as_a_level(spark, rows):
    frame = spark.createDataFrame([(1, None, "k", None), (2, "x", "k", None)], "a int, b string, c string, d string")
    assert rows(profile.constant_columns(frame)) == [("c", "k"), ("d", None)]
    assert clean.drop_constant_columns(frame, keep=["c"]).columns == ["a", "b", "c"]


def test_thresholds_are_exclusive_for_columns(spark):
    frame = spark.createDataFrame([(1, None, None), (1, 2, None), (1, 2, None), (1, 2, 3), (1, 2, 3)], "a int, b int, c int")
    assert clean.drop_sparse_columns(frame, 0.2).columns == ["a", "b"]
    assert clean.drop_sparse_columns(frame, 0.6).columns == ["a", "b", "c"]


def test_sparse_rows_at_the_limit_are_dropped(spark, rows):
    frame = spark.createDataFrame([(1, None), (None, None), (1, 2)], "a int, b int")
    assert rows(clean.drop_sparse_rows(frame, 0.5)) == [(1, 2)]


def test_row_filter_and_column_report_stay_plannable(spark, plan):
    wide = spark.range(10).select(*[F.when(F.col("id") > i, F.col("id")).alias(f"c{i}") for i in range(30)])
    assert len(plan(clean.sparse_columns(clean.drop_sparse_rows(wide), 0.5))) > 0


def test_unstable_bound_holds_even_with_fewer_rows(spark):
    frame = spark.createDataFrame([(d, None if i < 3 else 1.0) for i, d in enumerate(days(*range(1, 11)))], "t date, v double")
    assert clean.drop_unstable_columns(frame, "t", recent=10, share=0.2).columns == ["t"]
    assert clean.drop_unstable_columns(frame, "t", recent=20, share=0.2).columns == ["t", "v"]
    assert clean.drop_unstable_columns(frame, "t", recent=5, share=0.2).columns == ["t", "v"]


def test_unknown_columns(spark):
    frame = spark.createDataFrame([("unknown", "unknown"), ("unknown", "x"), ("y", "x")], "a string, b string")
    assert clean.drop_token_columns(frame).columns == ["b"]


def test_dedup_is_idempotent_ordered_and_limited_before_the_shuffle(spark, rows, plan):
    frame = spark.createDataFrame([(1, 5), (1, 3), (2, None), (2, 1), (None, 4), (None, 9)], "k int, v int")
    once = clean.dedup(frame, ["k"], ["v"])
    assert rows(once) == sorted([(1, 3), (2, None), (None, 4)], key=repr)
    assert rows(clean.dedup(once, ["k"], ["v"])) == rows(once)
    text_of = plan(once)
    assert text_of.index("Exchange") < text_of.index("Partial")


def test_calendar_gaps_per_series(spark, rows):
    frame = spark.createDataFrame([("a", d) for d in days(1, 2, 5)] + [("b", d) for d in days(3, 4)], "s string, d date")
    assert rows(profile.missing_dates(frame, "d", ["s"])) == [("a", D(2024, 1, 3)), ("a", D(2024, 1, 4))]
    coverage = {r.s: (r.expected, r.present, r.missing, r.is_complete) for r in profile.date_coverage(frame, "d", ["s"]).collect()}
    assert coverage == {"a": (5, 3, 2, False), "b": (2, 2, 0, True)}


def test_timeliness_scores(spark):
    frame = spark.createDataFrame([(D(2024, 1, 1), 1, None), (D(2023, 12, 31), 2, 5)], "t date, a int, b int")
    as_of = F.lit("2024-01-01").cast("date")
    scores = {r.attribute: r.timeliness for r in profile.timeliness(frame, "t", as_of, 12).collect()}
    assert scores["a"] == scores["b"] == pytest.approx((1 + 1 / 13) / 2)
    only = {r.attribute: r.timeliness for r in profile.timeliness(frame, "t", as_of, 12, non_null_only=True).collect()}
    assert only["b"] == pytest.approx(1 / 13)


# Statistics


def test_weeks_empty_everywhere_are_absent_unless_filled(spark, rows):
    frame = spark.createDataFrame([("a", D(2024, 1, 1)), ("b", D(2024, 1, 16))], "g string, d date")
    assert rows(stats.weekly_counts(frame, "d", "g"), "n", "g") == [(0, "a"), (0, "b"), (1, "a"), (1, "b")]
    filled = stats.weekly_counts(frame, "d", "g", fill_gaps=True)
    assert filled.count() == 8 and filled.agg(F.sum("n")).first()[0] == 2


def test_histogram_puts_the_maximum_into_the_last_bin(spark, rows):
    frame = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, 9.0, 10.0, None)], "v double")
    assert [r.n for r in stats.histogram(frame, "v", 5).orderBy("bin").collect()] == [2, 1, 0, 0, 2]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r.n for r in stats.histogram(same, "v", 2).orderBy("bin").collect()] == [2, 0]


def test_density_integrates_to_about_one(spark):
    frame = spark.createDataFrame([(float(v),) for v in range(100)], "v double")
    grid = stats.density(frame, "v").orderBy("point").collect()
    step = grid[1].x - grid[0].x
    assert len(grid) == 100 and 0.8 < sum(r.density for r in grid) * step < 1.0


def test_correlation_is_symmetric(spark):
    frame = spark.createDataFrame([(1, 2.0, 5), (2, 4.0, 3), (3, 6.0, None)], "a int, b double, c int")
    found = {(r.a, r.b): r.corr for r in stats.correlations(frame, ["a", "b", "c"]).collect()}
    assert len(found) == 9 and found["a", "b"] == pytest.approx(1.0) and found["a", "c"] == found["c", "a"] == pytest.approx(-1.0)


def test_reports_of_a_prediction(spark, rows):
    frame = spark.createDataFrame([("x", "x"), ("x", "y"), ("y", "y"), ("z", "x")], "label string, guess string")
    report = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in stats.classification_report(frame, "label", "guess").collect()}
    assert report == {"x": (0.5, 0.5, 0.5, 2), "y": (0.5, 1.0, pytest.approx(2 / 3), 1), "z": (0.0, 0.0, 0.0, 1)}
    assert rows(stats.confusion_matrix(frame, "label", "guess")) == [("x", 1, 1, 0), ("y", 0, 1, 0), ("z", 1, 0, 0)]
    assert stats.accuracy(frame, "label", "guess").first()[0] == 0.5
    weights = {r["class"]: r.weight for r in stats.class_weights(frame, "label").collect()}
    assert weights == pytest.approx({"x": 4 / 6, "y": 4 / 3, "z": 4 / 3})


def test_standardize_leaves_a_constant_column_at_zero(spark, rows):
    frame = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    assert rows(stats.standardize(frame, ["a", "b"])) == [(-1.0, 0.0), (1.0, 0.0)]


def test_chronological_split_truncates(spark):
    frame = spark.range(19).select(F.col("id"), F.col("id").alias("t"))
    parts = [r.part for r in ordered.chronological_split(frame, "t", ["id"]).orderBy("id").collect()]
    assert parts == ["train"] * 16 + ["validation"] * 2 + [None]


def test_pivot_takes_the_first_value_by_tie_break(spark, rows):
    frame = spark.createDataFrame([(1, "x", 9.0, 2), (1, "x", 5.0, 1), (1, "y", 7.0, 3), (2, "z", 1.0, 1)], "i int, k string, v double, o int")
    assert rows(series.pivot_wide(frame, ["i"], "k", "v", ["o"], ["x", "y", "w"])) == [(1, 5.0, 7.0, None), (2, None, None, None)]
    assert series.pivot_wide(frame, ["i"], "k", "v", ["o"]).columns == ["i", "x", "y", "z"]


@pytest.mark.parametrize("layout", [ordered.WHOLE, CUT])
def test_odd_column_names_pass_through_every_operator(spark, rows, layout):
    frame = spark.createDataFrame(
        [("g h", 0, 1.0, "x"), ("g h", 1, None, None), ("g h", 2, 3.0, "x"), ("g h", 2, 3.0, "x")],
        "`s t` string, `t-t` int, `v.v` double, `c c` string",
    )
    unique = clean.dedup(frame, ["s t", "t-t"], ["v.v"])
    assert unique.count() == 3
    filled = impute.interpolate(unique, ["t-t"], ["v.v"], ["s t"], layout=layout)
    assert [r[2] for r in filled.orderBy(col("t-t")).collect()] == [1.0, 2.0, 3.0]
    flagged = series.detect_outliers(filled, ["v.v"], ["t-t"], ["s t"], window=2, layout=layout, block_rows=3)
    assert flagged.columns == [*filled.columns, "increase_v.v", "is_outlier_v.v"]
    assert [r.total_outliers for r in series.outliers_per_column(flagged, ["v.v"]).collect()] == [0]
    assert rows(impute.impute_mode(unique, by=["s t"]), col("c c")) == [("x",)] * 3
    assert rows(impute.impute_numeric(unique, ["v.v"], "mean"), col("v.v")) == [(1.0,), (2.0,), (3.0,)]
    assert rows(impute.impute_group_mean(unique, ["v.v"], ["s t"]), col("v.v")) == [(1.0,), (2.0,), (3.0,)]
    assert rows(ordered.order_violations(unique, "t-t", ["s t"], layout=layout), "ordered") == [(None,), (True,), (True,)]
    assert stats.standardize(filled, ["v.v"]).columns == filled.columns
    assert profile.missing_dates(unique.withColumn("d d", F.lit("2024-01-01").cast("date")), "d d", ["s t"]).count() == 0
    assert rules.enforce_null(unique, [Constraint("big", col("v.v") > 2, ("v.v", "c c"))]).filter(col("c c").isNull()).count() == 2


def test_result_does_not_depend_on_partitions_or_input_order(spark, rows):
    frame = random_series(spark, 9).withColumn("c", F.when(F.col("k") < 5, "low").when(F.col("k") > 6, "high"))
    shuffled = frame.orderBy(F.desc("t")).repartition(11)
    for build in (
        lambda f: impute.impute_mode(f, ["c"], by=["s"]),
        lambda f: impute.impute_numeric(f, ["v", "k"], by=["s"]),
        lambda f: clean.dedup(f, ["s", "k"], ["t"]),
        lambda f: ordered.latest(f, 7, "t", ["s"]),
        lambda f: ordered.chronological_split(f, "t", [], ["s"]),
        lambda f: profile.profile(f, ["s", "k", "c"]).withColumn("stddev", F.round("stddev", 9)),
    ):
        assert rows(build(frame)) == rows(build(shuffled))


def test_all_null_and_single_row_frames(spark, rows):
    empty = spark.createDataFrame([(1, None, None)], "t int, v double, c string")
    assert rows(impute.impute_mode(impute.interpolate(empty, ["t"], fallback=0))) == [(1, 0.0, "unknown")]
    flagged = series.detect_outliers(empty, ["v"], ["t"])
    assert rows(flagged, "increase_v", "is_outlier_v") == [(0.0, False)]
    report = profile.profile(empty).orderBy("column").collect()
    assert [(r.column, r.non_null, r.distinct_values, r.stddev) for r in report] == [
        ("c", 0, 1, None),
        ("t", 1, 1, None),
        ("v", 0, 1, None),
    ]


# Rows that must not get lost


def test_latest_breaks_ties_by_all_columns(spark, rows):
    frame = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c"), (0, "z")], "t int, v string")
    for n, expected in ((1, ["a"]), (2, ["a", "b"])):
        for parts in (1, 3):
            assert [r[1] for r in rows(ordered.latest(frame.repartition(parts), n, "t"))] == expected


def test_unstable_columns_of_a_table_without_any(spark):
    frame = spark.createDataFrame([(1, "s")], "t int, s string")
    assert clean.unstable_columns(frame, "t", ["s"]).count() == 0


def test_weekly_counts_leave_null_groups_out(spark, rows):
    frame = spark.sql("SELECT * FROM VALUES (DATE'2024-01-01', 'a'), (DATE'2024-01-09', 'b'), (DATE'2024-01-09', NULL) AS t(d, g)")
    found = rows(stats.weekly_counts(frame, "d", "g"))
    assert [(str(w), g, n) for w, g, n in found] == [
        ("2024-01-01", "a", 1), ("2024-01-01", "b", 0), ("2024-01-15", "a", 0), ("2024-01-15", "b", 1)
    ]


def test_confusion_matrix_counts_what_is_outside_the_given_classes(spark, rows):
    frame = spark.createDataFrame([("x", "x"), ("x", "z"), (None, "y"), ("w", None)], "label string, guess string")
    found = stats.confusion_matrix(frame, "label", "guess", ["x", "y"])
    assert found.columns == ["label", "x", "y", "other"]
    assert rows(found) == sorted([("x", 1, 0, 1), (None, 0, 1, 0), ("w", 0, 0, 1)], key=repr)


def test_trusted_weather_does_not_depend_on_the_partitions(spark, rows):
    days = [(f"2024-01-{d:02d}", t) for d in range(1, 6) for t in (20.0 + d, 40.0)] + [("2024-01-06", None)]
    frame = spark.createDataFrame([("s", d, t, 1.0, 0.0) for d, t in days], "station string, d string, TMAX double, TMIN double, PRCP double")
    frame = frame.select("station", F.to_date("d").alias("datetime_iso"), "TMAX", "TMIN", "PRCP")
    found = [rows(weather.trust_weather(frame.repartition(n)).data) for n in (1, 3, 8)]
    assert found[0] == found[1] == found[2]
    assert [r[2] for r in found[0]] == [21.0, 22.0, 23.0, 24.0, 25.0]


def test_correlations_skip_missing_values_pair_by_pair(spark):
    frame = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, None, 0.0), (4.0, 8.0, 5.0)], "a double, b double, c double")
    found = {(r.a, r.b): r["corr"] for r in stats.correlations(frame, ["a", "b", "c"]).collect()}
    assert found[("a", "b")] == pytest.approx(1.0) and found[("b", "c")] == pytest.approx(1.0)
    assert len(found) == 9 and found[("a", "c")] == found[("c", "a")]


def test_texts_are_cleaned_once(spark, plan, rows):
    """A cleaned text is compared with the tokens and kept: one replacement per column, and the same texts."""
    frame = spark.createDataFrame([(" a  b ", "NA"), ("", None), (" N/A ", "x")], "a string, b string")
    done = text.normalize_text(frame.filter("a IS NOT NULL"), tokens=text.EVENT_NULLS)
    assert rows(done) == sorted([("a_b", None), (None, None), (None, "x")], key=repr)
    assert plan(done).count("regexp_replace") == 2


def test_formatted_accidents_are_read_once(spark, plan, monkeypatch):
    """The reports, the rules and the copies read written rows, not the formatting again."""
    seen = []
    assess = accidents.assess
    monkeypatch.setattr(accidents, "assess", lambda df, *rest: seen.append(plan(df)) or assess(df, *rest))
    chain_queries.view_event_weather_chain(spark, "/root/testdata/sf0.001")
    assert seen and "regexp_replace" not in seen[0]
