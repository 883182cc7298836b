import os

import pytest
from helpers import rows

from parity.queries import load_layers
from tillwork.operators.columns import UPDATE_STAMP
from tillwork.operators.quality import QualityFailure
from tillwork.plans import layers

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def content(spark, names, table):
    return rows(spark.table(f"{names.refined}.{table}").drop(UPDATE_STAMP))


def test_refining_again_changes_nothing(spark, tmp_path):
    names = load_layers(spark, SF_DIR, "again")
    layers.refine(spark, names)
    tables = ("sil_store", "sil_daily_sales", "sil_budget")
    before = {t: content(spark, names, t) for t in tables}
    results = layers.refine(spark, names, report_path=str(tmp_path / "dq"), check_merged=True)
    assert {t: content(spark, names, t) for t in tables} == before
    # 33 checks and 8 verdicts; only the category list does not fit these articles.
    failed = results.where("not passed").select("table_name", "expectation_type")
    assert results.count() == 41 and rows(failed) == [
        ("sil_product", "expect_column_distinct_values_to_contain_set"),
        ("sil_product", "overall"),
    ]

    built = layers.build_star(spark, names, as_of="1999-12-31",
                              partitions={"fact_budget": ["commerce_period"]})
    assert built == [f"{names.star}.{t}" for t in layers.STAR_TABLES]
    assert "commerce_period=" in spark.table(built[-1]).inputFiles()[0]
    days = spark.table(f"{names.star}.fact_sales_store_daily")
    assert days.agg({"date_key": "max"}).first()[0] <= 19991231
    # The cutoff applies to both sides; returned goods have no ticket.
    balances = layers.balance_layers(spark, names, as_of="1999-12-31")
    assert [r.passed for r in balances.collect()] == [True, True, True, True]
    with pytest.raises(QualityFailure, match="category"):
        layers.gate(results, balances, str(tmp_path / "dq"))
    assert not layers.gate(results, balances, stop=False).first().passed


def test_missing_landing_tables(spark, schema):
    with pytest.raises(ValueError, match="no landing table"):
        layers.refine(spark, layers.Layers(schema, schema, schema))
