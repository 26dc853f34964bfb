"""Scans, validation and cleaning helpers."""
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from txlens.functions.clean import drop_all_null_columns, handle_missing_values
from txlens.sources.readers import load_raw_transactions
from txlens.sources.schema import EXPECTED_COLUMNS, validate_dataframe


def test_load_raw_reads_every_csv_and_validates(spark, tx_pdf):
    d = tempfile.mkdtemp(prefix="txlens-raw-")
    tx_pdf.iloc[:60].to_csv(os.path.join(d, "a.csv"), index=False)
    tx_pdf.iloc[60:].to_csv(os.path.join(d, "b.csv"), index=False)
    open(os.path.join(d, "notes.txt"), "w").write("ignored")
    df = load_raw_transactions(spark, d)
    assert df.count() == 100
    assert dict(df.dtypes)["product_amount"] == "double"
    assert validate_dataframe(df, EXPECTED_COLUMNS)
    with pytest.raises(ValueError):
        validate_dataframe(df.drop("cashback"), EXPECTED_COLUMNS, mode="strict")
    assert validate_dataframe(df.drop("cashback"), EXPECTED_COLUMNS, mode="warn") is False


def test_load_raw_without_csv_fails(spark):
    with pytest.raises(FileNotFoundError):
        load_raw_transactions(spark, tempfile.mkdtemp(prefix="txlens-empty-"))


def test_missing_value_strategies(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 5.0), (4, float("nan"))], "i long, v double")
    assert [r.v for r in handle_missing_values(df, "zero").orderBy("i").collect()] == [1.0, 0.0, 5.0, 0.0]
    assert [r.v for r in handle_missing_values(df, "median").orderBy("i").collect()] == [1.0, 3.0, 5.0, 3.0]
    assert handle_missing_values(df, "drop").count() == 2
    with pytest.raises(ValueError):
        handle_missing_values(df, "bogus")


def test_drop_all_null_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    assert drop_all_null_columns(df).columns == ["a"]
