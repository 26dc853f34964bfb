import os
import sys
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from txlens.session import checkpoint_dir, ship_package  # noqa: E402

AS_OF = "2024-02-01 00:00:00"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("txlens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    ship_package(s)
    yield s
    s.stop()


def synthetic_transactions(n: int = 100, users: int = 20, seed: int = 42, null_every: int = 0) -> pd.DataFrame:
    """The reference's unit-test fixture shape, with a fixed date window."""
    rng = np.random.default_rng(seed)
    start = datetime(2024, 1, 1)
    df = pd.DataFrame({
        "transaction_id": [f"tx_{i:03d}" for i in range(n)],
        "user_id": [f"user_{u:03d}" for u in rng.integers(0, users, n)],
        "transaction_date": [(start + timedelta(minutes=int(m))).strftime("%Y-%m-%d %H:%M:%S")
                             for m in rng.integers(0, 30 * 24 * 60, n)],
        "product_category": rng.choice(["Electronics", "Food", "Clothing", "Travel", "Entertainment"], n),
        "product_amount": np.round(rng.exponential(100, n), 2),
        "transaction_fee": np.round(rng.uniform(0, 5, n), 2),
        "cashback": np.round(rng.exponential(2, n), 2),
        "loyalty_points": rng.poisson(10, n).astype(float),
        "payment_method": rng.choice(["Credit Card", "Debit Card", "Wallet", "Bank Transfer"], n),
        "device_type": rng.choice(["Mobile", "Desktop", "Tablet"], n),
        "location": rng.choice(["Paris", "Lyon", "Marseille", "Lille", "Bordeaux"], n),
    })
    mask = rng.random(n) < 0.1
    df.loc[mask, "cashback"] = np.nan
    mask = rng.random(n) < 0.1
    df.loc[mask, "loyalty_points"] = np.nan
    if null_every:
        df.loc[df.index % null_every == 0, "product_amount"] = np.nan
    return df


@pytest.fixture(scope="session")
def tx_pdf():
    return synthetic_transactions()


@pytest.fixture(scope="session")
def tx(spark, tx_pdf):
    from txlens.sources.schema import TX_SCHEMA
    pdf = tx_pdf[[f.name for f in TX_SCHEMA.fields]]
    return spark.createDataFrame(pdf.astype(object).where(pd.notna(pdf), None), TX_SCHEMA)
