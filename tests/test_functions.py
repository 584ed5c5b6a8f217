import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    FULL_LOAD_START,
    check_range,
    composite_id,
    concat_blank,
    effective_start,
    elapsed_seconds,
    parse_time,
    row_hash,
    run_id,
    safe_key,
    with_defaults,
)


@pytest.mark.parametrize("given, used", [
    ("1900-01-01", FULL_LOAD_START),
    (dt.date(1900, 1, 1), FULL_LOAD_START),
    ("1900-01-01 00:00:01", dt.datetime(1900, 1, 1, 0, 0, 1)),
    ("2024-01-01", dt.datetime(2024, 1, 1)),
])
def test_start_sentinel(given, used):
    assert effective_start(given) == used


def test_start_sentinel_on_a_column(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'1900-01-01'), (TIMESTAMP_NTZ'2024-01-01') AS t(s)")
    got = [r[0] for r in df.select(effective_start(F.col("s"))).collect()]
    assert got == [FULL_LOAD_START, dt.datetime(2024, 1, 1)]


def test_window_that_ends_before_it_starts():
    with pytest.raises(ValueError):
        check_range("2024-02-01", "2024-01-01")
    check_range("2024-02-01", None)


def test_ids_skip_or_blank_nulls(spark):
    df = spark.sql("SELECT 5L AS k, CAST(NULL AS INT) AS rev UNION ALL SELECT 6L, 2")
    got = {(r[0], r[1]) for r in df.select(composite_id("k", "rev"), concat_blank("k", "rev")).collect()}
    assert got == {("5", "5"), ("6~2", "62")}


def test_defaults_keep_type_and_order(spark):
    df = with_defaults(spark.sql("SELECT CAST(NULL AS INT) AS rev, 'a' AS x"), {"rev": 0})
    assert df.columns == ["rev", "x"] and df.first()[0] == 0
    assert df.schema["rev"].dataType.simpleString() == "int"


def test_keys_of_another_type(spark):
    df = spark.sql("SELECT * FROM VALUES ('100'), ('x') AS t(k)").select(safe_key("k"))
    assert [r[0] for r in df.collect()] == [100, None]


def test_bad_time_text_fails_or_is_null(spark):
    df = spark.sql("SELECT 'invalid-date' AS t")
    assert df.select(parse_time("t", "yyyy-MM-dd", strict=False)).first()[0] is None
    with pytest.raises(Exception):
        df.select(parse_time("t", "yyyy-MM-dd")).collect()


def test_elapsed_and_run_ids(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00' AS a, TIMESTAMP'2024-01-01 00:05:00.9' AS b")
    assert df.select(elapsed_seconds("a", "b")).first()[0] == 300
    assert run_id() != run_id()


HASHED = "1~0~100~1000.00~2019-07-01 10:00:00.500000"


def hash_row(spark):
    return spark.sql("SELECT 1L AS k, 0 AS rev, 100L AS p, CAST(1000 AS DECIMAL(18,2)) AS a, "
                     "TIMESTAMP_NTZ'2019-07-01 10:00:00.5' AS t")


@pytest.mark.parametrize("bits, digest", [(256, hashlib.sha256), (512, hashlib.sha512)])
def test_hash_equals_hashlib(spark, bits, digest):
    df = hash_row(spark)
    assert df.select(row_hash(df, df.columns, bits)).first()[0] == digest(HASHED.encode()).hexdigest()


def test_hash_in_0x_style(spark):
    df = hash_row(spark)
    got = df.select(row_hash(df, df.columns, style="0x")).first()[0]
    assert got == "0x" + hashlib.sha512(HASHED.encode()).hexdigest().upper() and len(got) == 130


def test_whole_table_512_hashes_equal_hashlib(spark):
    from tests.conftest import SMALL
    from tidemark.plans.registered import _hash_lines

    for r in _hash_lines(spark, SMALL, 512, "0x").collect():
        parts = [r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, r.amount, r.kind, r.category,
                 r.l_shipdate.strftime("%Y-%m-%d %H:%M:%S.%f")]
        text = "~".join(str(p) for p in parts if p is not None)
        assert r.HashValue == "0x" + hashlib.sha512(text.encode()).hexdigest().upper()


def test_hashes_of_another_system(spark):
    df = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ'2024-03-10 02:30:00.5' AS t, 'ü' AS s")
    got = df.select(row_hash(df, ["k", "t", "s"], time_digits=7, encoding="UTF-16LE")).first()[0]
    assert got == hashlib.sha512("1~2024-03-10 02:30:00.5000000~ü".encode("utf-16-le")).hexdigest()
    with pytest.raises(ValueError):
        row_hash(df, ["k"], time_digits=3)


def test_neighbouring_nulls_collide_unless_marked(spark):
    df = spark.sql("SELECT 'x' AS a, CAST(NULL AS STRING) AS b UNION ALL SELECT NULL, 'x'")
    assert df.select(row_hash(df, ["a", "b"])).distinct().count() == 1
    assert df.select(row_hash(df, ["a", "b"], nulls="mark")).distinct().count() == 2


def test_hash_does_not_depend_on_the_session_zone(spark, conf):
    df = spark.sql("SELECT TIMESTAMP'2024-03-10 02:30:00Z' AS t, TIMESTAMP_NTZ'2024-03-10 02:30:00' AS n")
    seen = set()
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        conf(spark_sql_session_timeZone=zone)
        seen.add(tuple(df.select(row_hash(df, ["t"]), row_hash(df, ["n"])).first()))
    assert len(seen) == 1


def test_hash_refuses_doubles_and_unknown_columns(spark):
    df = spark.sql("SELECT 1.0D AS d")
    with pytest.raises(TypeError, match="column d"):
        row_hash(df, ["d"])
    with pytest.raises(ValueError, match="nope"):
        row_hash(df, ["nope"])


def test_exact_amounts_and_date_bounds_survive_parquet(spark, tmp_path):
    df = spark.sql("SELECT CAST('999999999.99' AS DECIMAL(18,2)) AS a, TIMESTAMP_NTZ'1700-01-01' AS t "
                   "UNION ALL SELECT CAST('-1500.75' AS DECIMAL(18,2)), TIMESTAMP_NTZ'9999-12-31'")
    df.write.parquet(str(tmp_path / "x"))
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "x")).collect()}
    assert got == {(Decimal("999999999.99"), dt.datetime(1700, 1, 1)),
                   (Decimal("-1500.75"), dt.datetime(9999, 12, 31))}
