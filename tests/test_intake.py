"""The list split into rows that can be read and rows that can't, with reasons."""

from datetime import date

import pytest

from brandtrack.operators.conversion import clean_list
from brandtrack.sources.intake import read_delivered, take_in
from brandtrack.sources.sample_tables import sample_list

HEADER = "more,Division,Series,UPC,Group Number,brand,productname,Hierarchy Level 3 Code,Hierarchy Level 2 Code,Date,level_flag"
GOOD = "x,Dairy,New,{upc},{group},b,Milk,1,100,{day},3"


def line(upc="4119000001", group="30", day="2001-01-05"):
    return GOOD.format(upc=upc, group=group, day=day)


def test_every_line_is_typed_or_rejected_with_its_reason(spark, tmp_path):
    lines = [
        line(), line(), line("12.0"), line("", ""), line("4119000001", "30", ""),
        line("12.7"), line("n/a", "28.5"), line("123456789012345678901"), line("1", "99999999999"), line(day="5.1.2001"),
        "x,Dairy,New,1", line() + ",one,more", line("0x1"), line("0x1"),
    ]
    path = tmp_path / "list.csv"
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    split = take_in(read_delivered(spark, str(path)), str(tmp_path / "intake"))
    found = {(r["line"], r["column_name"]): (r["value"], r["reason"], r["n_rows"]) for r in split.report().collect()}
    cut = lambda text: text.removeprefix("x,")
    assert found == {
        (cut(line("12.7")), "UPC"): ("12.7", "not a whole number", 1),
        (cut(line("n/a", "28.5")), "UPC"): ("n/a", "no number", 1),
        (cut(line("n/a", "28.5")), "Group Number"): ("28.5", "not a whole number", 1),
        (cut(line("123456789012345678901")), "UPC"): ("123456789012345678901", "does not fit", 1),
        (cut(line("1", "99999999999")), "Group Number"): ("99999999999", "does not fit", 1),
        (cut(line(day="5.1.2001")), "Date"): ("5.1.2001", "no date", 1),
        ("x,Dairy,New,1", "_corrupt_record"): ("x,Dairy,New,1", "the line has not one cell per column", 1),
        (line() + ",one,more", "_corrupt_record"): (line() + ",one,more", "the line has not one cell per column", 1),
        (cut(line("0x1")), "UPC"): ("0x1", "no number", 2),
    }
    typed = sorted(((r["UPC"], r["Group Number"], r["Date"]) for r in split.typed.collect()), key=repr)
    day = date(2001, 1, 5)
    assert typed == sorted([(4119000001, 30, day)] * 2 + [(12, 30, day), (None, None, day), (4119000001, 30, None)], key=repr)
    assert split.counts().first().asDict() == {"delivered_rows": 14, "typed_rows": 5, "rejected_rows": 9}


def test_typed_rows_give_the_list_that_the_report_would_read(spark, tmp_path):
    raw = sample_list(spark, "/root/testdata/sf0.001")
    split = take_in(raw, str(tmp_path / "intake"))
    assert split.typed.count() + split.rejected.count() == raw.count()
    whole = set(map(tuple, clean_list(raw, 28).collect()))
    typed = set(map(tuple, clean_list(split.typed, 28).collect()))
    assert typed < whole and all(row[2] is None for row in whole - typed)


def test_missing_columns_are_named(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text("UPC,brand\n1,b\n")
    with pytest.raises(ValueError, match="lacks the columns Division, Series, Group Number"):
        read_delivered(spark, str(path))
