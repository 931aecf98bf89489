"""A whole run through the public names: files in, written tables and summary out."""

import re
from datetime import date
from pathlib import Path

import pytest

from brandtrack import BrandReport, ReportParams, site_list, tables_from
from brandtrack.params import LISTED_STORES
from brandtrack.sources.conversion_list import read_conversion_list
from brandtrack.sources.publish import write_summary
from star_data import SCHEMAS, checked, duck, spark_rows
from test_random_stars import random_star

HEADER = (
    "Division,Series,UPC,Group Number,brand,productname,"
    "Hierarchy Level 3 Code,Hierarchy Level 2 Code,Date,level_flag"
)


def test_run_from_files_to_summary(spark, tmp_path):
    rows = random_star(11)
    sites = list(LISTED_STORES[:5])
    rows["touchpoint"] = [
        (key, network, str(sites[key]) if key < 5 else site)
        for key, network, site in rows["touchpoint"]
    ]
    rows["listed_sites"] = [(str(s),) for s in LISTED_STORES]
    lines = [
        ",".join("" if v is None else str(v) for v in (d, s, u, g, b, p, h3, h2, day, level))
        for d, s, u, g, b, p, h3, h2, day, level in rows["conv"]
    ]
    lines += lines[:3] + ["Dairy,New,n/a,28,b,Tea,1,100,2001-01-05,3"]
    listing = tmp_path / "list.csv"
    listing.write_text("\n".join([HEADER, *lines]) + "\n")
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows[name], schema).write.parquet(str(tmp_path / name))
    spark.createDataFrame(rows["loyal_fact"], SCHEMAS["fact"]).write.parquet(str(tmp_path / "loyal_lines"))

    def read(name):
        return spark.read.parquet(str(tmp_path / name))

    tables = tables_from(read, site_list(spark, LISTED_STORES), {"loyal_fact": "loyal_lines"})
    params = ReportParams.for_week("20010630", brand_flag=None)
    assert params.stop_yago == date(2000, 7, 1)
    report = BrandReport(tables, read_conversion_list(spark, str(listing)), params)
    assert report.publish_weeks().publish_weeks().upload_list() is report
    folder = Path(report.folder)
    assert (folder / "loyal_weeks" / "_SUCCESS").exists() and (folder / "inferred_weeks" / "_SUCCESS").exists()

    con = duck(rows)
    assert spark_rows(report.total_metrics()) == checked(con, "total_metrics")
    assert spark_rows(report.key_metrics_table()) == checked(con, "key_metrics_table")

    summary = report.summary()
    write_summary(summary, str(tmp_path / "summary"))
    again = spark.read.option("header", True).csv(str(tmp_path / "summary"))
    assert again.columns == summary.columns
    assert again.count() == summary.count() == 7
    with report:
        pass
    assert not any((folder / table).exists() for table in BrandReport.WRITTEN)


def test_a_folder_of_another_run_is_refused(spark, tmp_path):
    from star_data import report

    rows = random_star(13)
    first = report(spark, rows, tmp_path / "run")
    first.publish_weeks()
    with pytest.raises(ValueError, match="another run"):
        report(spark, rows, tmp_path / "run")
    expected = spark_rows(first.total_metrics())
    first.close()
    again = report(spark, rows, tmp_path / "run")
    assert spark_rows(again.total_metrics()) == expected


def test_a_run_reads_the_lines_once_per_pull(spark, monkeypatch):
    """All outputs of a run, and every table it writes: two scans of the lines."""
    from brandtrack import report as module
    from brandtrack.sample_queries import sample_report
    from star_data import plan_of

    scans = []

    def counted(df):
        return len(re.findall(r"Location: .*lineitem\.parquet", plan_of(df)))

    def publish(df, path):
        scans.append(counted(df))
        return written(df, path)

    written = module.publish
    monkeypatch.setattr(module, "publish", publish)
    made = sample_report(spark, "/root/testdata/sf0.001")
    outputs = [
        *made.loyal_banner_weekly(), *made.inferred_brand_weekly(), made.weekly_trend(), made.banner_metrics(),
        made.latest_week_share(), made.total_metrics(), made.headed_table(), made.summary(),
    ]
    assert sum(scans) + sum(map(counted, outputs)) == 2


def test_one_brand_gives_the_same_figures_as_all(spark, tmp_path):
    from star_data import report

    rows = random_star(12)
    rows["conv"] = [(*r[:4], "b" if r[3] % 2 else "p", *r[5:]) for r in rows["conv"]]
    con = duck(rows)
    whole = report(spark, rows, tmp_path / "all")
    raw = whole.conv.selectExpr(
        "division AS Division",
        "series AS Series",
        "CAST(upc AS string) AS UPC",
        "CAST(grpnum AS string) AS `Group Number`",
        "brand",
        "productname",
        "CAST(hierl3cd AS string) AS `Hierarchy Level 3 Code`",
        "CAST(hierl2cd AS string) AS `Hierarchy Level 2 Code`",
        "convdate AS Date",
        "CAST(levelflag AS string) AS level_flag",
    )
    params = ReportParams.for_week("20010630", brand_flag="p")
    part = BrandReport(whole.tables, raw, params, str(tmp_path / "part"))
    got = spark_rows(part.total_metrics())
    everything = checked(con, "total_metrics")
    assert 0 < len(got) < len(everything)
    assert set(got) < set(everything)
