"""First rows in file order and rejected rows, over several small CSV files."""

import pytest
from pyspark.sql import functions as F

from unitcast.plans import frames
from unitcast.sources import csvscan, files, tpch

HEADER = "item_id,date,date_block_num,shop_id,item_price,item_cnt_day\n"      # not the schema's order


@pytest.fixture
def path(tmp_path):
    d = tmp_path / "sales"
    d.mkdir()
    n = 0
    for name, rows in (("b.csv", 5), ("a.csv", 3), ("c.csv", 0), ("d.csv", 400)):
        lines = []
        for _ in range(rows):
            lines.append(f"{n},{n % 28 + 1:02d}.03.2014,{14},{900 - n},{n}.5,1\n")
            n += 1
        (d / name).write_text(HEADER + "".join(lines))
    return str(d)


def ids(df):
    return sorted(r.item_id for r in df.collect())


def test_first_rows_in_file_order(spark, path):
    order = [5, 6, 7, 0, 1, 2, 3, 4, *range(8, 408)]        # a.csv, b.csv, d.csv
    for n in (0, 1, 3, 4, 8, 9, 100, 408, 5000):
        assert ids(files.read_sales(spark, path, rows_read=n)) == sorted(order[:n])
    one = files.read_sales(spark, path, rows_read=4).filter("item_id = 6").first()
    assert (str(one.date), one.shop_id, one.item_price) == ("2014-03-07", 894, 6.5)
    assert files.read_sales(spark, path, rows_read=2).columns == [f.name for f in files.SALES_SCHEMA.fields]


def test_splits_of_one_file_keep_their_order(spark, path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        rows = csvscan.numbered(csvscan.scan(spark, csvscan.listed(spark, path))).cache()
        assert rows.select("_file", "_block").distinct().count() > 10
        assert [int(r.item_id) for r in rows.filter(F.col("_file").endswith("d.csv")).orderBy("_record").collect()] == list(range(8, 408))
        assert ids(files.read_sales(spark, path, rows_read=50)) == sorted([*range(8), *range(8, 50)])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_later_files_are_not_read(spark, path, monkeypatch):
    scanned = []
    monkeypatch.setattr(csvscan, "scan", lambda s, p, f=csvscan.scan: scanned.extend(p) or f(s, p))
    files.read_sales(spark, path, rows_read=4).collect()
    assert [p.rsplit("/", 1)[-1] for p in scanned] == ["a.csv", "b.csv", "c.csv"]


def test_rejected_rows_and_accepted_rows_are_all_rows(spark, path, tmp_path):
    with open(f"{path}/b.csv", "a") as f:
        f.write("x1,01.03.2014,14,1,2.0,1\n"            # a malformed number
                "77,31.02.2014,14,1,two,1\n"            # no such day, and a malformed price
                "7800,01.03.2014,14,1,,1\n"               # an empty cell is null, not malformed
                "79,01.03.2014,14\n"                    # too few fields
                "80,01.03.2014,14,1,2.0,1,9,9\n")       # too many
    accepted = files.read_sales_checked(spark, path, str(tmp_path / "bad"))
    bad = {(r.file.rsplit("/", 1)[-1], r.record): r.reason for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert set(bad) == {("b.csv", k) for k in (6, 7, 9, 10)}
    assert bad["b.csv", 6] == "item_id=x1" and bad["b.csv", 7].startswith("date=31.02.2014") and "item_price=two" in bad["b.csv", 7]
    assert bad["b.csv", 9].startswith("fields: 79,") and bad["b.csv", 10].startswith("fields: 80,")
    assert ids(accepted) == [*range(408), 7800]
    assert accepted.count() + len(bad) == 408 + 5
    assert accepted.filter("item_id = 7800").first().item_price is None


def test_no_files(spark, tmp_path):
    with pytest.raises(Exception):
        csvscan.read_checked(spark, str(tmp_path), {"a": "int"})


def test_tables_with_limit_and_rejects(spark, tmp_path):
    texts = {"items.csv": "item_id,item_name,item_category_id\n1,bolt,1\nx,nut,1\n", "item_categories.csv": "item_category_id,item_category_name\n1,Parts\n",
             "shops.csv": "shop_id,shop_name\n1,Alpha\n", "test.csv": "ID,shop_id,item_id\n0,1,1\n",
             "sales_train.csv": "date,date_block_num,shop_id,item_id,item_price,item_cnt_day\n" + "".join(f"0{k}.01.2013,0,1,1,{k},1\n" for k in range(1, 9))}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    t = files.read_csv_tables(spark, str(tmp_path), rows_read=3, rejects=str(tmp_path / "bad"))
    assert sorted(r.item_price for r in t["sales"].collect()) == [1, 2, 3] and t["items"].count() == 1
    assert [(r.record, r.reason) for r in spark.read.parquet(str(tmp_path / "bad" / "items")).collect()] == [(2, "item_id=x")]
    assert t["sales"].dtypes == files.read_csv_tables(spark, str(tmp_path))["sales"].dtypes


def test_larger_sales_are_written_as_more_files(spark, smoke_dir, monkeypatch):
    rows = tpch.sales(spark, smoke_dir).select(*frames.CSV_COLS)
    monkeypatch.setattr(frames, "ROWS_PER_FILE", 500, raising=False)
    path = frames._written(spark, rows)
    per_file = spark.read.csv(path, header=True).groupBy(F.input_file_name()).count()
    assert per_file.agg(F.sum("count")).first()[0] == rows.count()
    assert per_file.count() > 4 and per_file.agg(F.max("count")).first()[0] < 1000
