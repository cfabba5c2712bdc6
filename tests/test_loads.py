import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from parcelwise.schemas import FEATURES, RAW_TABLES
from parcelwise.plans import late_delivery
from parcelwise.session import remove_scratch, scratch_dir
from parcelwise.sources import files, layers


def write(path, content, encoding="utf-8"):
    path.write_text(content, encoding=encoding)
    return str(path)


def test_reviews_with_quoted_line_breaks_commas_and_quotes(spark, tmp_path):
    header = ",".join(RAW_TABLES["order_reviews"].columns)
    body = (
        'r1,o1,5,"Bom, ""mesmo""","linha um\nlinha dois",2018-01-01 00:00:00,2018-01-02 10:00:00\n'
        "r2,o2,bad,,NA,not a date,\n"
    )
    path = write(tmp_path / "x_order_reviews_dataset.csv", f"{header}\n{body}")
    rows = {row.review_id: row for row in files.read_typed_csv(spark, path, "order_reviews").collect()}
    assert rows["r1"].review_comment_title == 'Bom, "mesmo"'
    assert rows["r1"].review_comment_message == "linha um\nlinha dois"
    assert rows["r1"].review_score == 5
    assert (rows["r2"].review_score, rows["r2"].review_comment_message, rows["r2"].review_creation_date) == (None, None, None)


def test_byte_order_mark_and_missing_final_newline(spark, tmp_path):
    content = "product_category_name,product_category_name_english\nbeleza_saude,health_beauty\npcs,computers"
    path = write(tmp_path / "product_category_name_translation.csv", content, "utf-8-sig")
    rows = files.read_typed_csv(spark, path, "category_translation")
    assert rows.columns == ["product_category_name", "product_category_name_english"]
    assert sorted(map(tuple, rows.collect())) == [("beleza_saude", "health_beauty"), ("pcs", "computers")]


def test_prefix_keeps_its_zero_and_repeated_rows_go(spark, tmp_path):
    header = ",".join(RAW_TABLES["geolocation"].columns)
    path = write(tmp_path / "g.csv", f"{header}\n01037,-23.5,-46.6,sao paulo,SP\n01037,-23.5,-46.6, sao paulo ,SP\n01037,-23.6,-46.6,sao paulo,SP\n")
    rows = files.read_typed_csv(spark, path, "geolocation")
    assert rows.count() == 2
    assert {row[0] for row in rows.collect()} == {"01037"}
    assert dict(rows.dtypes)["geolocation_lat"] == "double"


def test_torn_row_aborts(spark, tmp_path):
    path = write(tmp_path / "s.csv", "seller_id,zip,city,state\ns1,1,a,SP\ns2,2\n")
    with pytest.raises(Py4JJavaError, match="MALFORMED_CSV_RECORD"):
        files.read_text_csv(spark, path, RAW_TABLES["sellers"]).collect()


def test_only_matching_files_are_read(spark, tmp_path):
    header = ",".join(RAW_TABLES["sellers"].columns)
    write(tmp_path / "a_sellers_dataset.csv", f"{header}\ns1,1,a,SP\n")
    write(tmp_path / "a_customers_dataset.csv", f"{header}\ns2,1,a,SP\n")
    rows = files.read_text_csv(spark, str(tmp_path), RAW_TABLES["sellers"], RAW_TABLES["sellers"].file_glob)
    assert [row.seller_id for row in rows.collect()] == ["s1"]


def test_columns_map_by_position(frame):
    renamed = files.by_position(frame("a string, b string", ("x", "y")), RAW_TABLES["category_translation"])
    assert renamed.columns == list(RAW_TABLES["category_translation"].columns)
    with pytest.raises(ValueError, match="expected 2 columns"):
        files.by_position(frame("a string", ("x",)), RAW_TABLES["category_translation"])


def test_loading_twice_equals_loading_once(spark, tmp_path, frame):
    rows = frame("a int", (1,), (2,))
    for _ in range(2):
        path = layers.write_snapshot(rows, str(tmp_path), "t")
    assert spark.read.parquet(path).count() == 2


def test_landing_is_dated_and_rerunnable(spark, tmp_path, frame):
    folder = str(tmp_path)
    layers.land(frame("a int", (1,)), folder, "t", "2026-01-01")
    for _ in range(2):
        path = layers.land(frame("a int", (2,), (3,)), folder, "t", "2026-01-02")
    counts = {str(row.dt): row["count"] for row in spark.read.parquet(path).groupBy("dt").count().collect()}
    assert counts == {"2026-01-01": 1, "2026-01-02": 2}


def test_missing_tables_follow_the_policy(spark, tmp_path, frame):
    layers.write_csv(frame("a int", (1,)), str(tmp_path / "orders"))
    expected = ("orders", "sellers")
    assert files.require_tables(spark, str(tmp_path), "skip", expected) == ["orders"]
    with pytest.raises(FileNotFoundError, match="sellers"):
        files.require_tables(spark, str(tmp_path), "fail", expected)


def test_row_audit_totals(frame):
    audit = files.row_audit({"a": frame("x int", (1,), (2,)), "b": frame("x int", (1,))})
    assert {row.table_name: row.row_count for row in audit.collect()} == {"a": 2, "b": 1, "total": 3}


def test_feature_scan_names(frame):
    upper = frame("ORDER_ID string, IS_LATE boolean, " + ", ".join(f"{name.upper()} double" for name in FEATURES))
    assert late_delivery.feature_scan(upper).columns == ["order_id", "is_late", *FEATURES]
    with pytest.raises(ValueError, match="distance_km"):
        late_delivery.feature_scan(upper.drop("DISTANCE_KM"))


def test_metrics_json_nests_under_the_model(spark, tmp_path, frame):
    path = layers.write_metrics(frame("model string, accuracy double", ("m", 0.5)), str(tmp_path / "metrics"))
    row = spark.read.json(path).first()
    assert (row.model, row.metrics.accuracy) == ("m", 0.5)
    long = layers.long_metrics(frame("model string, accuracy double", ("m", 0.5)))
    assert [tuple(r) for r in long.collect()] == [("m", "accuracy", 0.5)]


def test_scratch_follows_the_cluster_setting(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_load_nulls_touches_text_only(frame):
    rows = files.load_nulls(frame("a string, b int", ("NULL", 1), ("x", None)))
    assert [tuple(r) for r in rows.orderBy(F.col("b").asc_nulls_last()).collect()] == [(None, 1), ("x", None)]


def test_tables_land_flat_or_nested_under_either_name(spark, tmp_path):
    header = ",".join(RAW_TABLES["sellers"].columns)
    for k, place in enumerate(("x_sellers_dataset.csv", "sellers.csv", "sellers/part-0.csv", "sellers/sellers.csv", "deep/sellers/any.csv")):
        (tmp_path / place).parent.mkdir(parents=True, exist_ok=True)
        write(tmp_path / place, f"{header}\ns{k},1,a,SP\n")
    write(tmp_path / "customers.csv", "a\nb\n")
    paths = files.table_paths(spark, str(tmp_path))
    assert sorted(paths) == ["customers", "sellers"] == sorted(files.require_tables(spark, str(tmp_path), "skip"))
    rows = files.read_text_csv(spark, paths["sellers"], RAW_TABLES["sellers"]).collect()
    assert sorted(row.seller_id for row in rows) == ["s0", "s1", "s2", "s3", "s4"]


def test_features_by_name_with_decimals(spark, tmp_path):
    names = ["extra", *reversed(FEATURES), "IS_LATE", "order_id"]
    values = {name: f"{k}.25" for k, name in enumerate(FEATURES)}
    row = ["x", *[values[name] for name in reversed(FEATURES)], "True", "o1"]
    odd = ["x", *["" if name == "distance_km" else "bad" for name in reversed(FEATURES)], "", "o2"]
    path = write(tmp_path / "f.csv", "\n".join(map(",".join, (names, row, odd))) + "\n")
    found = {r.order_id: r for r in files.read_features_csv(spark, path).collect()}
    assert [found["o1"][name] for name in FEATURES] == [k + 0.25 for k in range(len(FEATURES))] and found["o1"].is_late is True
    assert all(found["o2"][name] is None for name in (*FEATURES, "is_late"))
    with pytest.raises(ValueError, match="distance_km"):
        files.read_features_csv(spark, write(tmp_path / "g.csv", "order_id\no1\n"))


def test_predictions_from_csv(spark, tmp_path):
    path = write(tmp_path / "p.csv", "a,b,c,d,e,f\no1,late,NULL,on_time,v,2026-01-01 10:00:00.5\no2,late,late,late,v,never\n")
    rows = files.read_predictions_csv(spark, path).orderBy("order_id").collect()
    assert rows[0].predicted_label_hardcode is None and rows[0].predicted_at.microsecond == 500_000
    assert rows[1].predicted_at is None


def test_csv_keeps_fractions_of_seconds(spark, tmp_path):
    rows = spark.sql("select timestamp_ntz'2020-01-01 00:00:00.25' a, timestamp_ntz'2020-01-01 00:00:01' b")
    found = spark.read.option("header", True).csv(layers.write_csv(rows, str(tmp_path / "t"))).first()
    assert tuple(found) == ("2020-01-01 00:00:00.25", "2020-01-01 00:00:01")


def test_scratch_folders_can_be_removed(spark, tmp_path, frame):
    path = layers.write_snapshot(frame("a int", (1,)), scratch_dir(spark, "x"), "t")
    assert spark.read.parquet(path).count() == 1
    remove_scratch(spark, path)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError, match="not a scratch folder"):
        remove_scratch(spark, str(tmp_path))


def test_bad_rows_are_reported_by_file(spark, tmp_path):
    spec = RAW_TABLES["order_payments"]
    width = len(spec.columns)
    row = lambda key, n: ",".join([key, *["1"] * (n - 1)])
    header = ",".join(spec.columns)
    (tmp_path / "a.csv").write_text("\n".join([header, row("a1", width), *[row(f"long{k}", width + 1) for k in range(4)]]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([header, row("short", width - 1), row("b1", width)]) + "\n")
    (tmp_path / "c.csv").write_text("\n".join([header, row("c1", width)]) + "\n")
    bad = files.bad_rows(spark, str(tmp_path), spec)
    assert {r.key for r in bad.collect()} == {"short", *[f"long{k}" for k in range(4)]}
    report = {r.file.rsplit("/", 1)[-1]: (r.bad_rows, r.records) for r in files.bad_row_report(bad, 2).collect()}
    assert report == {"a.csv": (4, [row("long0", width + 1), row("long1", width + 1)]), "b.csv": (1, [row("short", width - 1)])}
    assert files.bad_row_report(files.bad_rows(spark, str(tmp_path / "c.csv"), spec)).collect() == []
