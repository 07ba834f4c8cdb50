"""Cleaning of the four inputs: the rules, and the decisions about unclear cases."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql.types import StructType

from filingstrata import schemas
from filingstrata.plans import silver
from helpers import frame, rows


def _stamped(schema: StructType, *extra: tuple[str, str]) -> StructType:
    result = StructType(list(schema.fields))
    for name, kind in (*extra, ("year", "integer"), ("quarter", "integer")):
        result = result.add(name, kind)
    return result


TAG = _stamped(schemas.TAG_SCHEMA)
PRE = _stamped(schemas.PRE_SCHEMA, ("negating", "string"))
NUM = _stamped(schemas.NUM_SCHEMA, ("segments", "string"), ("is_value_incomplete", "boolean"))
SUB = _stamped(schemas.SUB_SCHEMA)

TAG_COLUMNS = "tag version custom abstract datatype iord crdr tlabel doc year quarter".split()
TAG_ROWS = [
    ("Goodwill", "ext/a", 1, False, "shares", "D", "D", "goodwill, gross", "first wording", 2021, 3),
    ("Cover", "base/b", 0, True, None, None, None, "a heading", None, 2021, 3),
    ("Goodwill", "ext/a", 1, False, "shares", "I", "D", "goodwill, net", "second wording", 2021, 3),
    ("Nameless", None, 1, False, "pure", "D", "C", "no version", "goes first", 2021, 3),
    ("Debt", "base/b", 0, False, "perShare", "I", "C", "debt", "what is owed", 2021, 3),
]


class TestTags:
    def test_all_copies_numbered_before_abstract_rows_go(self, spark):
        tags = silver.clean_tags(frame(spark, TAG, TAG_COLUMNS, TAG_ROWS), dedup=False)
        assert tags.columns == schemas.TAGS
        # Cover has the number 1.
        assert rows(tags) == [
            (2, "Debt", "BASE/B", "perShare", "I", "debt", "what is owed"),
            (3, "Goodwill", "EXT/A", "shares", "D", "goodwill, gross", "first wording"),
            (4, "Goodwill", "EXT/A", "shares", "I", "goodwill, net", "second wording"),
        ]

    def test_latest_definition_wins(self, spark):
        later = ("Debt", "BASE/B", 0, False, "perShare", "I", "C", "liabilities", "reworded", 2022, 1)
        tags = silver.clean_tags(frame(spark, TAG, TAG_COLUMNS, [*TAG_ROWS, later]))
        assert rows(tags, "tag_id", "tag", "tlabel") == [(2, "Debt", "liabilities"), (3, "Goodwill", "goodwill, net")]

    def test_abstract_null_is_dropped(self, spark):
        unknown = ("Z", "q", 1, None, "pure", "D", "D", "z", "z", 2021, 3)
        assert silver.clean_tags(frame(spark, TAG, TAG_COLUMNS, [unknown])).count() == 0

    def test_versions_upper_case_and_present(self, spark):
        tags = silver.clean_tags(frame(spark, TAG, TAG_COLUMNS, TAG_ROWS))
        assert {row.version for row in tags.collect()} == {"BASE/B", "EXT/A"}

    def test_equal_copies_keep_their_number_of_rows(self, spark):
        tags = silver.clean_tags(frame(spark, TAG, TAG_COLUMNS, TAG_ROWS * 3), dedup=False)
        assert sorted(row.tag_id for row in tags.collect()) == list(range(4, 13))


PRE_COLUMNS = "adsh report line stmt inpth rfile tag version plabel negating year quarter".split()
PRE_ROWS = [
    ("f-1", 4, 2, "CI", True, "H", "  Sales", "b/1  ", "Total sales  ", "0", 2019, 2),
    ("  f-2  ", 4, 7, None, True, "H", "Costs", "b/1", "Costs", "1", 2019, 2),
    ("f-3", 1, 1, "  CP  ", False, "X", "Name", "B/2", "  ", None, 2020, 4),
    ("f-4", 9, 3, "UN", False, "X", None, None, None, "0", None, None),
]


class TestPresentations:
    def test_trimmed_and_without_missing_statements(self, spark):
        cleaned = silver.clean_presentations(frame(spark, PRE, PRE_COLUMNS, PRE_ROWS))
        assert cleaned.columns == schemas.PRESENTATIONS
        assert rows(cleaned) == [
            ("f-1", 4, 2, "CI", "Sales", "b/1", "Total sales"),
            ("f-3", 1, 1, "CP", "Name", "B/2", ""),
            ("f-4", 9, 3, "UN", None, None, None),
        ]

    def test_statement_by_tag_mode_then_unclassifiable(self, spark):
        data = [
            ("1", "A", "BS"), ("2", "A", "IS"), ("3", "A", "IS"), ("4", "A", None),
            ("5", "B", None),
            ("6", "C", "IS"), ("7", "C", "BS"), ("8", "C", None),
            ("9", None, None), ("10", None, "CF"),
        ]
        filled = silver.impute_pre_statements(frame(spark, PRE, ["adsh", "tag", "stmt"], data))
        found = {row.adsh: row.stmt for row in filled.collect()}
        # Ties go to the smallest value; a missing tag belongs to no group.
        assert found["4"] == "IS" and found["5"] == "UN" and found["8"] == "BS" and found["9"] == "UN"
        assert filled.columns == PRE.names and len(found) == len(data)

    def test_labels_from_tag_names(self, spark):
        data = [("1", "NetIncomeLoss", None), ("2", "IFRSNetIncomeEPS2", None), ("3", "Tag", "Kept As Is")]
        filled = silver.impute_pre_labels(frame(spark, PRE, ["adsh", "tag", "plabel"], data))
        assert [row.plabel for row in filled.orderBy("adsh").collect()] == [
            "Net Income Loss", "Ifrsnet Income Eps2", "Kept As Is",
        ]


NUM_COLUMNS = "adsh tag version ddate qtrs uom segments coreg value footnote year quarter".split()


def _value(text):
    return None if text is None else Decimal(text)


class TestNumbers:
    def test_years_out_of_range_and_missing_keys(self, spark):
        data = [
            ("f-1", "Sales", "b/1", "21090930", 0, "CHF", "east", None, _value("-3.5"), None, 2019, 2),
            ("f-2", "Costs", "B/1", "18990930", 3, None, None, "sub", _value("0"), "see text", 2020, 4),
            ("f-3", "Costs", "b/1", "20190630", 1, "CHF", None, None, None, None, 2019, 2),
            ("f-4", "Costs", None, "20190630", 1, "CHF", None, None, _value("8"), None, 2019, 2),
        ]
        cleaned = silver.clean_numbers(frame(spark, NUM, NUM_COLUMNS, data), max_year=2025)
        assert cleaned.columns == schemas.NUMBERS
        assert rows(cleaned.drop("is_value_incomplete")) == [
            ("f-1", "Sales", "B/1", date(2019, 9, 30), 0, "CHF", _value("-3.5000")),
            ("f-2", "Costs", "B/1", date(2020, 9, 30), 3, None, _value("0.0000")),
        ]

    @pytest.mark.parametrize("missing", ["adsh", "tag", "version", "value"])
    def test_required_columns(self, spark, missing):
        complete = {
            "adsh": "1", "tag": "T", "version": "v", "ddate": "20220101", "qtrs": 1, "value": _value("1"),
        }
        data = [tuple(None if name == missing else value for name, value in complete.items())]
        assert silver.clean_numbers(frame(spark, NUM, list(complete), data)).count() == 0

    @pytest.mark.parametrize(
        ("qtrs", "kept"), [(4, True), (5, False), (0, True), (-1, True), (None, False)]
    )
    def test_durations_below_five_quarters(self, spark, qtrs, kept):
        data = [("1", "T", "v", "20220101", qtrs, _value("1"), 2022)]
        columns = ["adsh", "tag", "version", "ddate", "qtrs", "value", "year"]
        assert silver.clean_numbers(frame(spark, NUM, columns, data)).count() == int(kept)

    @pytest.mark.parametrize(
        ("ddate", "year", "expected"),
        [
            ("20220101", 2020, date(2022, 1, 1)),
            ("20090101", 2020, date(2009, 1, 1)),
            ("20081231", 2020, date(2020, 12, 31)),
            ("20230101", 2023, date(2023, 1, 1)),
            ("20080229", 2021, None),
            ("20220231", 2020, None),
            (None, 2020, None),
            ("garbage!", 2020, None),
        ],
    )
    def test_dates_repaired_by_partition_year(self, spark, ddate, year, expected):
        data = [("1", "T", "v", ddate, 1, _value("1"), year)]
        columns = ["adsh", "tag", "version", "ddate", "qtrs", "value", "year"]
        # Rows whose date stays unknown are kept.
        cleaned = silver.clean_numbers(frame(spark, NUM, columns, data), max_year=2022)
        assert [row.ddate for row in cleaned.collect()] == [expected]

    def test_last_plausible_year_defaults_to_the_clock(self, spark):
        this_year = date.today().year
        data = [
            (str(year), "T", "v", f"{year}0101", 1, _value("1"), 2015)
            for year in (this_year, this_year + 1)
        ]
        columns = ["adsh", "tag", "version", "ddate", "qtrs", "value", "year"]
        cleaned = silver.clean_numbers(frame(spark, NUM, columns, data))
        assert rows(cleaned, "ddate") == [(date(2015, 1, 1),), (date(this_year, 1, 1),)]

    @pytest.mark.parametrize("sketch", [None, 10_000])
    def test_medians_and_flag(self, spark, sketch):
        sub = frame(spark, SUB, ["adsh", "cik"], [("a", 1), ("b", 1), ("c", 2), ("n", None)])
        data = [
            ("a", "T", "USD", _value("1")), ("a", "T", "USD", _value("4")), ("b", "T", "USD", _value("9")),
            ("b", "T", "USD", _value("20")), ("b", "T", "USD", None),
            ("c", "T", "USD", None),
            ("a", "T", None, _value("7")), ("b", "T", None, None),
            ("n", "T", "USD", _value("5")), ("zz", "T", "USD", _value("6")),
        ]
        num = frame(spark, NUM, ["adsh", "tag", "uom", "value"], data).drop("is_value_incomplete")
        filled = silver.impute_num_values(num, sub, sketch)
        assert filled.columns == [*num.columns, "is_value_incomplete"]
        assert rows(filled, "adsh", "uom", "value", "is_value_incomplete") == sorted(
            [
                ("a", "USD", _value("1"), False), ("a", "USD", _value("4"), False),
                ("b", "USD", _value("9"), False), ("b", "USD", _value("20"), False),
                # Lower of the two middle values of the company's group.
                ("b", "USD", _value("4"), False),
                # No value in the group.
                ("c", "USD", None, True),
                # No unit, no company, no submission: flagged even with a value.
                ("a", None, _value("7"), True), ("b", None, None, True),
                ("n", "USD", _value("5"), True), ("zz", "USD", _value("6"), True),
            ],
            key=lambda row: [(v is not None, v if v is not None else 0) for v in row],
        )


SUB_CORE = "adsh cik name sic countryba stprba cityba zipba baph fye form period fy fp filed accepted instance".split()


class TestSubmissions:
    def test_trimmed_dated_and_delayed(self, spark):
        data = [
            ("f-1", 77, "  Lake Ferries AG", 4400, "CH  ", None, "  Thun", " 3600 ", "+41 (0)33 12-34", "0331",
             "20-F ", "20190331", 2018, "FY", "20190629", datetime(2019, 6, 30, 7, 5), "lf  "),
            ("f-2", 78, None, 4400, "CH", None, "Bern", "3000", None, "1231", "6-K", "20190630", 2019, "Q2",
             "20190630", datetime(2019, 6, 30), "x"),
            ("f-3", 79, "Alp", 1, None, None, None, None, "none", "1231", "6-K", "20190631", 2019, "Q2",
             "20190701", datetime(2019, 7, 1), None),
        ]
        cleaned = silver.clean_submissions(frame(spark, SUB, SUB_CORE, data))
        assert cleaned.columns == schemas.SUBMISSIONS
        assert rows(cleaned) == [
            ("f-1", 77, "Lake Ferries AG", 4400, "CH", None, "Thun", "3600", "410331234", "0331", "20-F",
             date(2019, 3, 31), 2018, "FY", date(2019, 6, 29), 90, datetime(2019, 6, 30, 7, 5), "lf"),
            # There is no 31 June, so there is no delay either.
            ("f-3", 79, "Alp", 1, None, None, None, None, "", "1231", "6-K",
             None, 2019, "Q2", date(2019, 7, 1), None, datetime(2019, 7, 1), None),
        ]

    @pytest.mark.parametrize("missing", ["adsh", "cik", "name", "sic"])
    def test_required_columns(self, spark, missing):
        complete = {"adsh": "1", "cik": 1, "name": "n", "sic": 1}
        data = [tuple(None if name == missing else value for name, value in complete.items())]
        assert silver.clean_submissions(frame(spark, SUB, list(complete), data)).count() == 0

    def test_malformed_dates_become_null(self, spark):
        columns = ["adsh", "cik", "name", "sic", "period", "filed"]
        data = [("1", 1, "n", 1, "20240101", "20240120"), ("2", 1, "n", 1, "2.0240101E7", "20240120")]
        cleaned = silver.clean_submissions(frame(spark, SUB, columns, data))
        assert rows(cleaned, "adsh", "delay_days") == [("1", 19), ("2", None)]

    def test_modes_then_overall_mode_after_filling(self, spark):
        data = [
            ("1", 1, 10, "US"), ("2", 1, 10, None), ("3", 1, None, None), ("4", 1, None, None),
            ("5", 2, 20, "CA"), ("6", 2, 20, "CA"), ("7", 2, 20, "CA"),
            ("8", 3, None, None), ("9", None, None, None),
        ]
        sub = frame(spark, SUB, ["adsh", "cik", "sic", "countryba"], data)
        filled = silver.impute_sub_categories(sub)
        found = {row.adsh: (row.sic, row.countryba) for row in filled.collect()}
        # sic 10 occurs twice and 20 three times, but after the group filling 10 occurs four times.
        assert found["3"] == (10, "US") and found["8"] == (10, "US") and found["9"] == (10, "US")
        assert found["5"] == (20, "CA") and len(found) == len(data)

    def test_overall_mode_of_an_empty_column_leaves_it_empty(self, spark):
        sub = frame(spark, SUB, ["adsh", "cik", "countryba"], [("1", 1, "US"), ("2", 2, None)])
        assert rows(silver.impute_sub_categories(sub), "adsh", "sic", "countryba") == [
            ("1", None, "US"), ("2", None, "US"),
        ]

    def test_blanks_tell_values_apart_before_trimming(self, spark):
        data = [("1", 1, " US"), ("2", 1, " US"), ("3", 1, "US"), ("4", 1, None)]
        sub = frame(spark, SUB, ["adsh", "cik", "countryba"], data)
        filled = silver.impute_sub_categories(sub).filter("adsh = '4'")
        assert filled.first().countryba == " US"

    def test_dates_by_group_then_defaults_in_order(self, spark):
        columns = ["adsh", "cik", "fye", "fy", "fp", "period", "filed"]
        data = [
            ("1", 1, "0630", 2020, "Q1", "20200331", "20200501"),
            ("2", 1, "0630", 2020, "FY", "20200630", "20200801"),
            ("3", 1, "1231", 2021, "FY", "20210331", "20210501"),
            ("4", 1, None, None, None, None, "20210801"),
            ("5", 2, None, None, None, None, "20190115"),
            ("6", None, "0930", None, None, None, "20180115"),
        ]
        filled = silver.impute_sub_dates(frame(spark, SUB, columns, data))
        found = {row.adsh: (row.fye, row.fy, row.fp, row.period) for row in filled.collect()}
        assert found["4"] == ("0630", 2020, "FY", "20200630")
        assert found["5"] == ("1231", 2019, "FY", "20191231")
        assert found["6"] == ("0930", 2018, "FY", "20180930")
        assert found["1"] == ("0630", 2020, "Q1", "20200331")

    def test_a_year_of_too_many_digits_gives_no_period(self, spark):
        columns = ["adsh", "cik", "fye", "fy", "period", "filed"]
        data = [
            ("1", 1, "1231", 300_000, None, "20190115"),
            ("2", 2, "1231", 300_000, "20181231", "20190115"),
            ("3", 3, "1231", 2**31 - 1, None, "20190115"),
            ("4", 4, "1231", -7, None, "20190115"),
        ]
        filled = silver.impute_sub_dates(frame(spark, SUB, columns, data))
        assert rows(filled, "adsh", "period") == [("1", None), ("2", "20181231"), ("3", None), ("4", None)]

    def test_one_join_gives_the_same_as_both_steps(self, spark):
        columns = ["adsh", "cik", "sic", "countryba", "fye", "fy", "fp", "period", "filed"]
        data = [
            (
                str(i), i % 7 or None,
                None if i % 3 == 0 else i % 4, None if i % 5 == 0 else "C" + str(i % 3),
                None if i % 4 == 0 else "1231", None if i % 6 == 0 else 2000 + i % 3,
                None if i % 5 == 1 else "Q" + str(i % 4), None if i % 7 == 1 else f"2000{1 + i % 9:02d}01",
                "20010101",
            )
            for i in range(120)
        ]
        sub = frame(spark, SUB, columns, data).drop("accepted")
        apart = silver.impute_sub_dates(silver.impute_sub_categories(sub))
        assert rows(silver.impute_submissions(sub), *columns) == rows(apart, *columns)
